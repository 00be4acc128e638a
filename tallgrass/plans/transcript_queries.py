"""Transcript queries: turns of conversations stand for segments, a second a word; documents and pages for text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass.functions import text as T
from tallgrass.operators import chapters, topics, transcripts
from tallgrass.plans.registry import query, table
from tallgrass.sources import markdown

_WS = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"
_SEGMENTS = f"""WITH c AS (SELECT conv_id, turn, text, {_WS} AS t FROM conversations), w AS (SELECT *, len(string_split(t, ' ')) AS n FROM c WHERE t <> ''),
q AS (SELECT conv_id, turn, text, t, n, sum(n + turn % 4) OVER (PARTITION BY conv_id ORDER BY turn) - n AS s FROM w), seg AS (SELECT conv_id, turn, text, t, n, s::DOUBLE AS s, (s + n)::DOUBLE AS e FROM q) """


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment lasts a second a word; before it is a pause of turn % 4 seconds."""
    rows = table(spark, sf_dir, "conversations").withColumn("t", T.squeeze(F.coalesce("text", F.lit("")))).filter("t <> ''").withColumn("n", F.size(F.split("t", " ")))
    line = Window.partitionBy("conv_id").orderBy("turn").rowsBetween(Window.unboundedPreceding, 0)
    start = F.sum(F.col("n") + F.col("turn") % 4).over(line) - F.col("n")
    return rows.select("conv_id", "turn", "text", start.cast("double").alias("start"), (start + F.col("n")).cast("double").alias("end"))


@query("""WITH d AS (SELECT doc_id, text AS s FROM documents UNION ALL SELECT -1, repeat('x', 130) UNION ALL SELECT -2, repeat('. ', 120) UNION ALL SELECT -3, repeat('hej ', 25) UNION ALL SELECT -4, 'ja ' || repeat('Ab', 70) UNION ALL SELECT -5, repeat('- ', 60) || repeat('Å', 10) || repeat('å', 10)),
m AS (SELECT doc_id, s, regexp_extract_all(lower(s), '[a-zåäö]+') AS w FROM d),
t AS (SELECT doc_id, max(n) AS top FROM (SELECT doc_id, x, count(*) AS n FROM (SELECT doc_id, unnest(w) AS x FROM m) GROUP BY ALL) GROUP BY doc_id),
f AS (SELECT m.doc_id, len(w) AS words, coalesce(top, 0) AS top, length(s) AS chars, len(regexp_extract_all(lower(s), '[^a-zåäö\\s]')) AS marks, s FROM m LEFT JOIN t USING (doc_id))
SELECT doc_id, words, top, array_to_string(list_filter([CASE WHEN words >= 20 AND top >= 0.7 * words THEN 'dominant_token_loop' END, CASE WHEN words <= 3 AND chars >= 120 AND len(list_filter(list_distinct(string_split(lower(s), '')), lambda c: c <> chr(10) AND contains(lower(s), repeat(c, 20)))) > 0 THEN 'character_noise_loop' END, CASE WHEN words = 0 AND chars >= 120 AND marks >= 100 THEN 'punctuation_noise_loop' END], lambda z: z IS NOT NULL), ',') AS reasons FROM f""")
def artifact_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = spark.createDataFrame([(-1, "x" * 130), (-2, ". " * 120), (-3, "hej " * 25), (-4, "ja " + "Ab" * 70), (-5, "- " * 60 + "Å" * 10 + "å" * 10)], "doc_id long, text string")
    rows = table(spark, sf_dir, "documents").select("doc_id", "text").union(extra)
    rows, words = rows.withColumn("w", T.swedish_words(F.col("text"))), F.col("w")
    return rows.select("doc_id", F.size(words).cast("long").alias("words"), T.most_frequent(words).cast("long").alias("top"), F.array_join(T.artifact_reasons(F.col("text"), words), ",").alias("reasons"))


#: Phrases that some turns end with; the rest of a turn's text is as it is.
_SAID = {0: "Dags för Sommar i P1", 1: "Det var sommar i P1", 2: "alla sommarprogram finns nu i vår app", 3: "Producent: Anna"}
_SAYS = "text || chr(10) || CASE turn % 7 " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in _SAID.items()) + " ELSE 'hon sommarpratade 2010' END"


def _said(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with a phrase of the programme on a line of its own behind the text."""
    k = F.col("turn") % 7
    phrase = F.coalesce(*[F.when(k == i, F.lit(v)) for i, v in _SAID.items()], F.lit("hon sommarpratade 2010"))
    return _segments(spark, sf_dir).withColumn("text", F.concat("text", F.lit("\n"), phrase))


def _found(patterns: tuple, place: str) -> str:
    return ", ".join(f"CASE WHEN {place} AND regexp_matches(said, '(?i)' || $p${p}$p$) THEN '{r}' END" for r, p in patterns)


_FLAGS = _SEGMENTS + f""", m AS (SELECT *, {_SAYS} AS said, max(e) OVER (PARTITION BY conv_id) AS d FROM seg),
r AS (SELECT conv_id, turn, list_filter([{_found(T.OPENING, "s <= 45")}, {_found(T.CLOSING, "d > 0 AND e >= d - 120")}], lambda z: z IS NOT NULL) AS l FROM m) """


@query(_FLAGS + "SELECT conv_id, turn, array_to_string(list_sort(list_distinct(l)), ',') AS reasons FROM r")
def boilerplate_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = transcripts.flag_segments(_said(spark, sf_dir), "conv_id")
    return flagged.select("conv_id", "turn", F.array_join(F.array_sort("boilerplate_reasons"), ",").alias("reasons"))


@query(_SEGMENTS + f""", m AS (SELECT *, split_part({_SAYS}, chr(10), -1) AS said, max(e) OVER (PARTITION BY conv_id) AS d FROM seg),
k AS (SELECT conv_id, coalesce(max(CASE WHEN s >= d - 180 AND regexp_matches(said, '(?i)' || $p${T.PRODUCTION_CREDIT}$p$) THEN s END), min(CASE WHEN s >= d - 180 AND regexp_matches(said, '(?i)' || $p${T.RECOMMENDATION_CUE}$p$) THEN s END)) AS cut FROM m GROUP BY conv_id)
SELECT m.conv_id, turn, s AS start FROM m JOIN k USING (conv_id) WHERE cut IS NULL OR s < cut""")
def trailing_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Credits and cues are looked for in the last line of a turn."""
    rows = _said(spark, sf_dir).withColumn("text", F.element_at(F.split("text", "\n"), -1))
    kept = transcripts.trailing_cut(rows, T.matches(F.col("text"), T.PRODUCTION_CREDIT), T.matches(F.col("text"), T.RECOMMENDATION_CUE), "conv_id")
    return kept.select("conv_id", "turn", "start")


@query(_SEGMENTS + "SELECT conv_id, turn, greatest(0, coalesce(s - lag(e) OVER (PARTITION BY conv_id ORDER BY turn), 0)) AS pause_before FROM seg")
def pause_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.pauses(_segments(spark, sf_dir), "conv_id", "turn").select("conv_id", "turn", "pause_before")


_UNITS = (
    _SEGMENTS.replace("WITH c", "WITH RECURSIVE c") + """, o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i FROM seg),
f AS (SELECT conv_id, turn, i, s, e, n, 0 AS u, n AS acc FROM o WHERE i = 1
 UNION ALL SELECT o.conv_id, o.turn, o.i, o.s, o.e, o.n, f.u + (f.acc >= 24 AND (f.acc >= 80 OR o.s - f.e >= 1.5))::INT, CASE WHEN f.acc >= 24 AND (f.acc >= 80 OR o.s - f.e >= 1.5) THEN o.n ELSE f.acc + o.n END FROM f JOIN o ON o.conv_id = f.conv_id AND o.i = f.i + 1),
l AS (SELECT *, max(u) OVER (PARTITION BY conv_id) AS lu, lag(e) OVER (PARTITION BY conv_id ORDER BY i) AS pe FROM f),
g AS (SELECT conv_id, sum(n) AS tw, arg_min(greatest(0, s - pe), i) AS tg FROM l WHERE u = lu GROUP BY conv_id),
z AS (SELECT l.*, CASE WHEN u = lu AND lu > 0 AND tw < 24 AND tg < 1.5 THEN u - 1 ELSE u END AS unit_index FROM l JOIN g USING (conv_id)) """
)


@query(_UNITS + """SELECT conv_id, unit_index, min(s) AS start_seconds, max(e) AS end_seconds, sum(n)::BIGINT AS word_count, count(*) AS segment_count FROM z GROUP BY conv_id, unit_index""")
def unit_builder(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transcripts.valid_segments(_segments(spark, sf_dir), "conv_id", "turn")
    return transcripts.build_units(rows, "conv_id", "turn").select("conv_id", "unit_index", "start_seconds", "end_seconds", "word_count", "segment_count")


@query(_UNITS + """, x AS (SELECT z.conv_id, z.unit_index, z.i, z.s, z.e, z.n, c.t FROM z JOIN q c ON c.conv_id = z.conv_id AND c.turn = z.turn), g2 AS (SELECT conv_id, unit_index, min(s) AS start_seconds, arg_max(e, i) AS end_seconds, string_agg(t, ' ' ORDER BY i) AS text, sum(n)::BIGINT AS word_count FROM x GROUP BY conv_id, unit_index)
SELECT conv_id, unit_index, text, word_count, greatest(0, coalesce(start_seconds - lag(end_seconds) OVER (PARTITION BY conv_id ORDER BY unit_index), 0)) AS pause_before_seconds, conv_id || ':u' || lpad(unit_index::VARCHAR, 4, '0') || ':' || substr(sha256(text), 1, 12) AS unit_id FROM g2""")
def unit_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = transcripts.build_units(transcripts.valid_segments(_segments(spark, sf_dir), "conv_id", "turn"), "conv_id", "turn")
    return rows.select("conv_id", "unit_index", "text", "word_count", "pause_before_seconds", "unit_id")


@query(_FLAGS + """SELECT 'boilerplate' AS kind, reason, count(*) AS n FROM (SELECT unnest(list_distinct(l)) AS reason FROM r) GROUP BY reason UNION ALL SELECT 'segments', CASE WHEN len(l) > 0 THEN 'removed' ELSE 'kept' END, count(*) FROM r GROUP BY 2""")
def audit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transcripts.audit(transcripts.flag_segments(_said(spark, sf_dir), "conv_id"))


@query("SELECT doc_id, doc_id || ':c' || CASE WHEN doc_id % 12000 < 10000 THEN lpad((doc_id % 12000)::VARCHAR, 4, '0') ELSE (doc_id % 12000)::VARCHAR END || ':' || substr(sha256(text), 1, 12) AS chunk_id FROM documents")
def content_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.content_id(F.col("doc_id"), "c", F.col("doc_id") % 12000, F.col("text")).alias("chunk_id"))


@query("SELECT doc_id, trim(regexp_replace(regexp_replace(translate(lower(text), 'åäáàâãéèêëíìîïóòôöõúùûüñç', 'aaaaaaeeeeiiiiooooouuuunc'), '[^\\x00-\\x7f]', '', 'g'), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM documents")
def slug(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.simple_slug(F.col("text")).alias("slug"))


@query("SELECT doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) AS text FROM documents")
def whitespace_norm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", T.squeeze(F.col("text")).alias("text"))


_LINES = "x AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), y AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS line, unnest(l) AS text FROM x)"


@query(f"""WITH {_LINES}, h AS (SELECT *, CASE WHEN length(text) < 40 AND text <> '' THEN text END AS head FROM y)
SELECT doc_id, line, last_value(head IGNORE NULLS) OVER (PARTITION BY doc_id ORDER BY line ROWS UNBOUNDED PRECEDING) AS heading FROM h""")
def heading_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short lines stand for headings, carried forward over the lines below."""
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text"))
    filled = markdown.carry_headings(lines, F.when((F.length("text") < 40) & (F.col("text") != ""), F.col("text")), "line", ["doc_id"])
    return filled.select("doc_id", F.col("line").cast("long").alias("line"), "heading")


@query("""WITH p AS (SELECT p_partkey, p_brand AS file, p_name, p_type, p_size, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS line FROM part), e AS (SELECT file, min(line) AS stop FROM p WHERE p_partkey % 10 = 0 GROUP BY file)
SELECT p.file, line, p_name AS label, p_type AS description, p_size || ',' || p_partkey AS raw_topic_ids FROM p LEFT JOIN e USING (file) WHERE (stop IS NULL OR line < stop) AND p_partkey % 7 <> 0""")
def markdown_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts of a brand stand for the lines of a catalogue: every tenth is a heading that ends it, every seventh a row without ids."""
    key, line = F.col("p_partkey"), F.row_number().over(Window.partitionBy("p_brand").orderBy("p_partkey"))
    row = F.concat(F.lit("| "), "p_name", F.lit(" | "), "p_type", F.lit(" | "), F.when(key % 7 == 0, "-").otherwise(F.concat("p_size", F.lit(", "), key.cast("string"))), F.lit(" |"))
    lines = table(spark, sf_dir, "part").select(F.col("p_brand").alias("file"), line.alias("line"), F.when(key % 10 == 0, F.lit("## End")).otherwise(row).alias("text"))
    rows = markdown.topic_rows(lines)
    return rows.select("file", F.col("line").cast("long").alias("line"), "label", "description", F.array_join(F.col("raw_topic_ids").cast("array<string>"), ",").alias("raw_topic_ids"))


_STOP = ("the", "of", "and", "la", "de", "der", "und")


@query(f"""WITH d AS (SELECT source, list_filter(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{M}}\\p{{N}}_]{{2,}}'), lambda x: x NOT IN {_STOP}) AS l FROM documents), w AS (SELECT source, unnest(l) AS term FROM d UNION ALL SELECT source, unnest(list_transform(range(1, len(l)), lambda i: l[i] || ' ' || l[i + 1])) FROM d),
c AS (SELECT source, term, count(*) AS tf FROM w GROUP BY ALL), o AS (SELECT term, sum(tf)::BIGINT AS f, count(*) AS df FROM c GROUP BY term HAVING count(*) >= 3),
s AS (SELECT source, sum(tf) AS words FROM c GROUP BY source), a AS (SELECT avg(words) AS average FROM s), z AS (SELECT c.source, c.term, tf, f, df, sqrt(tf / words) * greatest(ln(1 + (average - f + 0.5) / (f + 0.5)), 0) AS w FROM c JOIN o USING (term) JOIN s USING (source) CROSS JOIN a),
r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY round(w, 9) DESC, term) AS rank FROM z) SELECT source, term, tf, f, df, round(w, 6) AS weight, rank FROM r WHERE rank <= 12""")
def ctfidf_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twelve heaviest words and pairs of words of each source, without stop words."""
    docs = table(spark, sf_dir, "documents")
    found = topics.term_weights(topics.terms_of(docs, "source", "text", _STOP), "source", "term", topics.least_groups(docs.count()))
    order = Window.partitionBy("source").orderBy(F.desc(F.round("weight", 9)), "term")
    return found.withColumn("rank", F.row_number().over(order)).filter("rank <= 12").withColumn("weight", F.round("weight", 6))


@query("WITH w AS (SELECT source, lower(unnest(regexp_extract_all(lower(text), '[a-z]+'))) AS term FROM documents), c AS (SELECT source, term, count(*) AS n FROM w GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, term) AS k FROM c), l AS (SELECT source, list(term ORDER BY k) AS words FROM r WHERE k <= 8 GROUP BY source) SELECT source, array_to_string(words, ' ') AS keywords, len(list_intersect(words, ['the', 'la', 'of', 'and', 'de', 'der', 'is'])) >= 3 AS low_quality FROM l")
def low_quality_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources stand for topics; common words are put in the place of programme framing."""
    words = table(spark, sf_dir, "documents").select("source", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("[a-z]+"), 0)).alias("term"))
    counts = words.groupBy("source", "term").agg(F.count(F.lit(1)).alias("n"))
    best = counts.withColumn("k", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "term"))).filter("k <= 8")
    lists = best.groupBy("source").agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "term"))), lambda x: x["term"]).alias("words"))
    framing = F.create_map(*[F.lit(x) for pair in zip(("the", "la", "of", "and", "de", "der", "is"), topics.FRAMING, strict=True) for x in pair])
    return lists.select("source", F.array_join("words", " ").alias("keywords"), topics.low_quality(F.transform("words", lambda w: F.coalesce(framing[w], w))).alias("low_quality"))


def _anchors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, sf_dir, "conversations")
    last = F.reverse(F.slice(F.reverse(T.word_list(F.col("text"))), 1, 6))
    asked = rows.filter("turn % 3 = 2").select("conv_id", F.array_join(last, " ").alias("anchor"))
    return rows.select("conv_id", F.col("turn").cast("int").alias("segment_index"), "text"), asked


@query()
def anchor_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments, asked = _anchors(spark, sf_dir)
    return chapters.match_anchors(segments, asked, "conv_id")


_GREEDY = """WITH RECURSIVE b AS (SELECT conv_id, turn AS i, length(text) % 100 / 100.0 AS score FROM conversations), u AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY i, score) AS r FROM b WHERE score >= 0.64 AND i >= 3),
f AS (SELECT conv_id, r, [{'i': i, 's': score}] AS kept FROM u WHERE r = 1 UNION ALL
 SELECT u.conv_id, u.r, CASE WHEN u.i - kept[-1].i >= 3 THEN list_append(kept, {'i': u.i, 's': u.score}) WHEN u.score > kept[-1].s THEN list_append(kept[:-2], {'i': u.i, 's': u.score}) ELSE kept END FROM f JOIN u ON u.conv_id = f.conv_id AND u.r = f.r + 1),
z AS (SELECT conv_id, unnest(kept) AS k FROM (SELECT conv_id, arg_max(kept, r) AS kept FROM f GROUP BY conv_id)), a AS (SELECT conv_id, k.i AS segment_index, k.s::DOUBLE AS score FROM z) """


def _accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.struct(F.col("turn").cast("long").alias("segment_index"), (F.length("text") % 100 / 100.0).alias("score")).alias("b"))
    lists = rows.groupBy("conv_id").agg(chapters.accept_boundaries(F.collect_list("b")).alias("kept"))
    return lists.select("conv_id", F.explode("kept").alias("k")).select("conv_id", "k.segment_index", "k.score")


@query(_GREEDY + "SELECT conv_id, segment_index, score FROM a")
def greedy_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _accepted(spark, sf_dir)


@query(_GREEDY + """, n AS (SELECT conv_id, count(*) - 1 AS e FROM conversations GROUP BY conv_id), l AS (SELECT conv_id, segment_index AS e FROM a UNION SELECT conv_id, e FROM n),
q AS (SELECT conv_id, coalesce(lag(e) OVER (PARTITION BY conv_id ORDER BY e) + 1, 0) AS first, e AS last FROM l) SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY last) - 1 AS chapter_index, first, last FROM q WHERE first <= last""")
def chapter_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.count(F.lit(1)).alias("segments"))
    return chapters.chapter_ranges(_accepted(spark, sf_dir), counts, "conv_id").withColumn("chapter_index", F.col("chapter_index").cast("long"))
