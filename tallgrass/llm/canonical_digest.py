"""Fingerprints of documents: an exact digest of the canonical text, with DataFrame and SQL functions only.

A text becomes canonical by compatibility normalisation, case folding, normalisation again, and single spaces for runs of
white space. Two independent 64-bit xxhashes of it name a bucket. The texts of buckets with more than one member are
compared as bytes; where they differ, a number in the order of the bytes follows the hashes, so that fingerprints are equal
exactly where the canonical texts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.workspace import stage

#: Sampled identifiers for each range of the order by identifier.
OVERSAMPLING = 24
#: Members of shared buckets that are looked up by broadcast; beyond it all texts are compared, combined before they are shuffled.
BROADCAST_MEMBERS = 200_000
BITS = 64


def canonical(text: Column) -> Column:
    """The canonical form of a text; null is empty. Spark's own Unicode library, called by its SQL function ``reflect``, does what has no function yet."""
    text = F.coalesce(text, F.lit(""))
    normal = lambda c: F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))
    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), normal(text), F.lit(True))
    # ASCII is normal already.
    form = F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(normal(folded))
    return F.trim(F.regexp_replace(form, r"[\s\p{Z}\x{85}]+", " "))


def wide_hash(form: Column, bits: int = BITS) -> Column:
    """Two xxhashes from different beginnings, as 32 hexadecimal digits; fewer bits are for tests of what happens when they collide."""
    parts = [F.xxhash64(F.lit(seed), form) for seed in (1, 2)]
    return F.concat(*[F.lpad(F.hex(F.lit(0) if bits <= 0 else F.shiftrightunsigned(p, 64 - bits)), 16, "0") for p in parts])


def fingerprints(rows: DataFrame, key: list[str], columns: list[str], bits: int = BITS) -> DataFrame:
    """``key`` and, in ``<column>_fingerprint``, the fingerprint of each text column, all of one space. ``key`` tells rows apart; ``rows`` is read twice."""
    hashes = stage(rows.select(*key, *[wide_hash(canonical(F.col(c)), bits).alias(c) for c in columns]), "hashes")
    members = hashes.select(*key, F.posexplode(F.array(*columns)).alias("which", "hash"))
    shared = members.groupBy("hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    wanted = stage(members.join(shared.select("hash"), "hash", "left_semi").groupBy(*key).agg(F.collect_set("which").alias("which")), "members")
    texts = rows.select(*key, F.array(*columns).alias("texts"))
    if wanted.limit(BROADCAST_MEMBERS + 1).count() <= BROADCAST_MEMBERS:
        texts = texts.join(F.broadcast(wanted), key).select(F.explode(F.transform("which", lambda i: F.get("texts", i))).alias("text"))
    else:
        texts = texts.select(F.explode("texts").alias("text"))
    forms = texts.select(canonical(F.col("text")).alias("form")).select("form", wide_hash(F.col("form"), bits).alias("hash"))
    # A set for each bucket: its distinct texts, which is one, or a few where hashes collide. Tasks combine before texts are shuffled.
    collided = forms.groupBy("hash").agg(F.collect_set("form").alias("forms")).filter(F.size("forms") > 1)
    collided = stage(collided.select("hash", F.array_sort("forms").alias("forms")), "collided")
    if collided.isEmpty():
        return hashes.select(*key, *[F.col(c).alias(f"{c}_fingerprint") for c in columns])
    found = rows.select(*key, *[F.struct(wide_hash(canonical(F.col(c)), bits).alias("hash"), canonical(F.col(c)).alias("form")).alias(c) for c in columns])
    for c in columns:
        found = found.join(collided.select(F.col("hash").alias("__hash"), F.col("forms").alias("__forms")), F.col(c)["hash"] == F.col("__hash"), "left")
        number = F.when(F.col("__forms").isNotNull(), F.concat(F.lit("-"), F.array_position("__forms", F.col(c)["form"]).cast("string"))).otherwise("")
        found = found.withColumn(f"{c}_fingerprint", F.concat(F.col(c)["hash"], number)).drop("__hash", "__forms")
    return found.select(*key, *[f"{c}_fingerprint" for c in columns])


def digest(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``df``: the identifier, ``n_chars`` (code points) and ``fingerprint``.

    Texts have equal fingerprints exactly where their canonical forms are equal. Null counts as empty; whole texts of any length count. Identifiers
    may be null or repeated; other columns are not read; an empty table gives an empty result.
    """
    rows = stage(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text")), "texts", codec="zstd")
    found = rows.select("row", "id", F.length("text").cast("long").alias("n_chars")).join(fingerprints(rows, ["row"], ["text"]), "row")
    return found.select(F.col("id").alias(id_col), "n_chars", F.col("text_fingerprint").alias("fingerprint"))


def _ranged(rows: DataFrame, ranges: int) -> tuple[DataFrame, int]:
    """Adds ``range``: sampled identifiers cut the rows into about equal ranges, ascending, null identifiers in the first; a range is a partition."""
    sample = rows.filter("id IS NOT NULL").select("id").orderBy(F.xxhash64("id")).limit(ranges * OVERSAMPLING).select("id").collect()
    keys = sorted(r.id for r in sample)
    splitters = list(dict.fromkeys(keys[len(keys) * i // ranges] for i in range(1, ranges))) if keys else []
    if not splitters:
        return rows.withColumn("range", F.lit(0)), 1
    # The splitters travel as one row, and are searched in two steps.
    width = max(1, round(len(splitters) ** 0.5))
    groups = [splitters[i : i + width] for i in range(0, len(splitters), width)]
    kind = rows.schema["id"].dataType.simpleString()
    table = rows.sparkSession.createDataFrame([([g[0] for g in groups], groups)], f"heads array<{kind}>, nested array<array<{kind}>>")
    at_most = lambda found: F.size(F.filter(found, lambda s: s <= F.col("id")))
    rows = rows.join(F.broadcast(table)).withColumn("group", at_most("heads"))
    place = F.when(F.col("group") == 0, 0).otherwise((F.col("group") - 1) * width + at_most(F.element_at("nested", F.greatest("group", F.lit(1)))))
    return rows.withColumn("range", F.coalesce(place, F.lit(0)).cast("int")).drop("heads", "nested", "group"), len(splitters) + 1


def with_next(df: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """Rows in descending order of the identifier: ``range`` and ``place`` (which tell rows apart), ``id``, ``text`` and ``head``, and the ranges' numbers of rows.

    ``head`` are the first floor(n / 3) characters, or all, of the row that follows, n being the characters of the row's own text; the first row follows the last.
    Null identifiers come last; rows of one identifier are in the order of their texts.
    """
    rows = df.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    rows, ranges = _ranged(rows, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = Window.partitionBy("range").orderBy(F.desc_nulls_last("id"), "text")
    third = F.floor(F.length("text") / 3).cast("int")
    rows = rows.repartitionById(ranges, "range").withColumns({"place": F.row_number().over(order), "next": F.lead("text").over(order)})
    rows = rows.select("range", "place", "id", "text", F.substring("next", F.lit(1), third).alias("head"), F.col("next").isNull().alias("last"))
    rows = stage(rows, "ordered", codec="zstd")
    # The last row of a range is followed by the first one of the range below: a row a range.
    sizes = sorted((r.range, r.n) for r in rows.groupBy("range").agg(F.max("place").alias("n")).collect())
    below = [(r, sizes[i - 1][0], n, sum(m for _, m in sizes[i + 1 :])) for i, (r, n) in enumerate(sizes)]
    table = df.sparkSession.createDataFrame(below, "range int, below int, n int, before long")
    firsts = rows.filter("place = 1").select(F.col("range").alias("below"), F.col("text").alias("next"))
    ends = rows.filter("last").drop("head").join(F.broadcast(table.select("range", "below")), "range").join(firsts, "below")
    ends = ends.withColumn("head", F.substring("next", F.lit(1), third))
    names = ["range", "place", "id", "text", "head"]
    return rows.filter("NOT last").select(names).union(ends.select(names)), table


def edited_text(text: Column, head: Column) -> Column:
    """The text with its last third replaced by ``head``."""
    return F.concat(F.substring(text, F.lit(1), F.length(text) - F.floor(F.length(text) / 3).cast("int")), head)


def edited(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of ``df``: the identifier, ``n_chars`` and ``edited_sha256`` of the edited text; the part of ``compare_edits`` without fingerprints."""
    rows, _ = with_next(df, id_col, text_col)
    return rows.select(F.col("id").alias(id_col), F.length("text").cast("long").alias("n_chars"), F.sha2(edited_text(F.col("text"), F.col("head")), 256).alias("edited_sha256"))


def compare_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """A row for each row of ``df``: what an edit, and another document, do to its fingerprint.

    Gives the identifier, ``n_chars`` (code points), ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, and ``near_edited`` and ``near_next``, the
    likeness of the fingerprint to the edited text's and to the next document's: 1 where they are equal, else 0, as a digest has nothing between. The
    edited text has its last floor(n_chars / 3) characters replaced by the first as many, or all, of the next document by descending
    identifier; the last one is followed by the first. Null texts count as empty. Null identifiers come last, and rows of one identifier
    in the order of their texts; each has a row. Other columns are not read; an empty table gives an empty result.
    """
    rows, table = with_next(df, id_col, text_col)
    key = ["range", "place"]
    texts = rows.select(*key, "text", edited_text(F.col("text"), F.col("head")).alias("edited"))
    base = rows.select(*key, "id", F.length("text").cast("long").alias("n_chars"), F.sha2(edited_text(F.col("text"), F.col("head")), 256).alias("edited_sha256"))
    marks = stage(fingerprints(texts, key, ["text", "edited"], bits), "fingerprints")
    ids = marks.join(F.broadcast(table), "range").withColumn("i", F.col("before") + F.col("place"))
    total = sum(r.n for r in table.collect())  # a row a range
    following = ids.select(F.when(F.col("i") == 1, F.lit(total)).otherwise(F.col("i") - 1).alias("i"), F.col("text_fingerprint").alias("next"))
    found = base.join(ids.join(following, "i").select(*key, "text_fingerprint", "edited_fingerprint", "next"), key)
    like = lambda c: (F.col("fingerprint") == F.col(c)).cast("double")
    found = found.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", F.col("text_fingerprint").alias("fingerprint"), "edited_fingerprint", "next")
    return found.withColumns({"near_edited": like("edited_fingerprint"), "near_next": like("next")}).drop("next")


#: The rows of ``edited`` in DuckDB.
EDITED_SQL = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, length(coalesce(text, '')) // 3 AS m FROM documents),
f AS (SELECT *, coalesce(lead(text) OVER (ORDER BY doc_id DESC), first_value(text) OVER (ORDER BY doc_id DESC)) AS next FROM d)
SELECT doc_id, n AS n_chars, sha256(concat(substr(text, 1, n - m), substr(next, 1, m))) AS edited_sha256 FROM f
"""
