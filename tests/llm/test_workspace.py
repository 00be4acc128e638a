import os
import subprocess
import sys
from pathlib import Path

import pytest

from tallgrass.llm import workspace


def test_intermediate_tables_can_be_cleared(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    table = workspace.stage(spark.range(5), "numbers")
    assert table.count() == 5 and spark.conf.get(key) == before
    workspace.clear(spark)
    with pytest.raises(Exception, match="numbers"):
        table.count()
    assert workspace.stage(spark.range(2), "numbers").count() == 2


def test_names_that_no_column_has(spark):
    df = spark.createDataFrame([(1, 2, 3)], "Later int, later_ int, x int")
    assert workspace.unused(df, "later") == "later__" and workspace.unused(df, "y") == "y"


SCRIPT = """
import sys
from pyspark.sql import SparkSession
from tallgrass.llm import workspace
spark = SparkSession.builder.master(sys.argv[1]).config("spark.ui.enabled", "false").getOrCreate()
assert spark.conf.get("spark.checkpoint.dir", None) is None
try:
    table = workspace.stage(spark.range(5), "numbers")
except RuntimeError as error:
    print("refused:", error)
else:
    print("staged", table.count(), workspace.own_folder(spark) == workspace.own_folder(spark), table.inputFiles()[0])
"""


@pytest.mark.parametrize(("master", "said"), [("local[2]", "staged 5 True file:///"), ("local-cluster[1,1,1024]", "refused: spark.checkpoint.dir")])
def test_a_session_without_the_folder(tmp_path, master, said):
    """In one process it makes a folder of its own; a cluster has to name one. A real session, in a process where nothing sets the folder."""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": str(Path(__file__).resolve().parents[2])}
    ran = subprocess.run([sys.executable, "-c", SCRIPT, master], env=env, capture_output=True, text=True, timeout=300, check=False)
    assert said in ran.stdout, ran.stdout + ran.stderr[-2000:]
