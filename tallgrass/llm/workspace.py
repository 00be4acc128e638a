"""What the operators share: intermediate tables, and expressions on texts and columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallgrass.staging import BATCH_ROWS, clear, own_folder, shared_folder, stage

__all__ = ["BATCH_ROWS", "ascii_lower", "clear", "own_folder", "shared_folder", "stage", "unused", "words_in"]


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (in any case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words_in(text: Column) -> Column:
    """Number of runs of characters other than space, tab, line feed, vertical tab, form feed and carriage return."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased, every other character as it is, null as empty."""
    text = F.coalesce(text, F.lit(""))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, upper.lower()))
