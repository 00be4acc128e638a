"""Folders whose content is replaced as a whole: a version is written beside the old one and named by a manifest, which is swapped at the end.

Readers take the version that the manifest names, old or new. A run that breaks off leaves the manifest as it was; what it wrote is deleted, or, where
the process was killed, by the next one that gets through. The version before stays, for those who still read it. Paths are those of any file system that Spark knows.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

MANIFEST = "manifest.json"


def files_of(spark: SparkSession, path: str):
    """Spark's package of file systems, the path in it, and the path's file system."""
    fs = spark._jvm.org.apache.hadoop.fs
    place = fs.Path(path)
    return fs, place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def manifest(spark: SparkSession, path: str) -> dict | None:
    """What was said when the current version was published; none where there is none."""
    fs, place, system = files_of(spark, f"{path}/{MANIFEST}")
    if not system.exists(place):
        return None
    stream = system.open(place)
    try:
        return json.loads(bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode())
    finally:
        stream.close()


def current(spark: SparkSession, path: str) -> str | None:
    """The folder of the current version."""
    said = manifest(spark, path)
    return f"{path}/{said['version']}" if said else None


def publish(spark: SparkSession, path: str, write: Callable[[str], dict | None]) -> dict:
    """Calls ``write`` with a new folder and makes it the current version; what it returns goes into the manifest beside ``version`` and ``before``."""
    old, version = manifest(spark, path) or {}, f"v-{uuid.uuid4().hex}"
    fs, top, system = files_of(spark, path)
    try:
        said = (write(f"{path}/{version}") or {}) | {"version": version, "before": old.get("version")}
        fresh = fs.Path(f"{path}/.{MANIFEST}-{version}")
        out = system.create(fresh, True)
        try:
            out.write(json.dumps(said).encode())
        finally:
            out.close()
        rename = getattr(fs, "Options$Rename")
        how = spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        context = fs.FileContext.getFileContext(system.makeQualified(top).toUri(), spark._jsc.hadoopConfiguration())
        context.rename(fresh, fs.Path(f"{path}/{MANIFEST}"), how)
    except BaseException:
        for name in (version, f".{MANIFEST}-{version}"):
            system.delete(fs.Path(f"{path}/{name}"), True)
        raise
    for found in system.listStatus(top):
        name = found.getPath().getName()
        if name.startswith(("v-", f".{MANIFEST}-")) and name not in (version, old.get("version")):
            system.delete(found.getPath(), True)
    return said
