"""Topic and neighbour queries over ``embeddings``: vectors stand for chunks, ``vec_id % 50`` for their episode, ``100 + vec_id % 400`` for their words, labels for topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass.functions import vectors as V
from tallgrass.operators import cells, density, export, incremental, layout, linkage, neighbours, search, segment, taxonomy, topics
from tallgrass.plans.registry import query, table

RULES = topics.Thresholds(min_similarity=0.35, min_winner_margin=0.02, accept_ambiguous_above=0.5, supporting_min=0.2, supporting_margin=0.01)
LOOSE = topics.Thresholds(min_similarity=0.2, min_winner_margin=0.0, supporting_min=0.1, supporting_margin=0.0, secondary_min=0.1, secondary_max_gap=0.2)


def chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return rows.select(F.col("vec_id").alias("chunk_id"), (F.col("vec_id") % 50).alias("sr_episode_id"), (100 + F.col("vec_id") % 400).alias("word_count"), (F.col("vec_id") * 10).alias("start_seconds"), "label", "embedding")


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = V.mean_vectors(table(spark, sf_dir, "embeddings"), ["label"], "embedding")
    return means.select(F.col("label").alias("topic_id"), V.unit(F.col("embedding")).alias("embedding"))


_DIMS = """
x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, generate_subscripts(embedding, 1) AS i FROM embeddings),
"""
_TOPICS = (
    _DIMS
    + """
tm AS (SELECT label, i, avg(v) AS m FROM x GROUP BY label, i),
tv AS (SELECT label AS topic_id, list(m ORDER BY i) AS raw FROM tm GROUP BY label),
topics AS (SELECT topic_id, list_transform(raw, lambda q: q / sqrt(list_dot_product(raw, raw))) AS tvec FROM tv),
c AS (SELECT vec_id AS chunk_id, vec_id % 50 AS sr_episode_id, 100 + vec_id % 400 AS word_count, vec_id * 10 AS start_seconds, label, embedding::DOUBLE[] AS e FROM embeddings),
sims AS (SELECT c.*, topic_id, list_dot_product(e, tvec) AS sim FROM c CROSS JOIN topics),
ranked AS (SELECT *, row_number() OVER (PARTITION BY chunk_id ORDER BY sim DESC, topic_id) AS r FROM sims),
top2 AS (SELECT a.chunk_id, a.sr_episode_id, a.word_count, a.start_seconds, a.label, a.e, a.topic_id AS best, a.sim AS bs, b.topic_id AS runner, b.sim AS rs, a.sim - b.sim AS margin
  FROM ranked a JOIN ranked b ON a.chunk_id = b.chunk_id AND a.r = 1 AND b.r = 2)
"""
)


def _decided(required: str, margin: str, ambiguous: str, smin: str, smargin: str) -> str:
    return f"""
, f AS (SELECT *, margin >= {margin} OR bs >= {ambiguous} AS pm FROM top2),
g AS (SELECT *, bs >= {required} AND pm AS strong FROM f),
h AS (SELECT *, NOT strong AND bs >= {smin} AND margin >= {smargin} AS supporting FROM g),
decisions AS (SELECT *, strong OR supporting AS accepted, CASE WHEN strong THEN 'strong' WHEN supporting THEN 'supporting' END AS evidence_tier,
  CASE WHEN bs < {smin} THEN 'below_supporting_threshold' WHEN NOT pm AND NOT supporting THEN 'ambiguous_winner' WHEN NOT (strong OR supporting) THEN 'below_topic_threshold' END AS rejection_reason FROM h)
"""


_STRICT = "WITH " + _TOPICS + _decided("0.35", "0.02", "0.5", "0.2", "0.01")
_LOOSE = "WITH " + _TOPICS + _decided("0.2", "0.0", "0.56", "0.1", "0.0")
_ROLL = (
    _LOOSE
    + """
, a AS (SELECT chunk_id, sr_episode_id, word_count, start_seconds, best AS topic_id, bs AS similarity, 1 AS chunk_topic_rank, margin AS winner_margin, evidence_tier FROM decisions WHERE accepted
 UNION ALL SELECT chunk_id, sr_episode_id, word_count, start_seconds, runner, rs, 2, -margin, 'secondary' FROM decisions WHERE accepted AND rs >= 0.2 AND margin <= 0.2)
"""
)


@query("WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings)," + _DIMS.replace("embedding)::DOUBLE", "embedding)::DOUBLE") + """
u AS (SELECT x.vec_id, x.i, x.v / sqrt(list_dot_product(n.e, n.e)) AS v FROM x JOIN n USING (vec_id)),
m AS (SELECT i, avg(v) AS m FROM u GROUP BY i),
k AS (SELECT vec_id, list(v ORDER BY i) AS raw, list(v - m ORDER BY i) AS cen FROM u JOIN m USING (i) GROUP BY vec_id),
s AS (SELECT a.vec_id, b.vec_id AS related_id, list_dot_product(a.cen, b.cen) / sqrt(list_dot_product(a.cen, a.cen)) / sqrt(list_dot_product(b.cen, b.cen)) AS s, list_dot_product(a.raw, b.raw) AS r FROM k a JOIN k b ON a.vec_id <> b.vec_id),
t AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, related_id) AS rank FROM s)
SELECT vec_id, related_id, round(s, 5) AS similarity, round(r, 5) AS raw_similarity, rank FROM t WHERE rank <= 8""")
def related_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 8)
    return found.withColumns({"similarity": F.round("similarity", 5), "raw_similarity": F.round("raw_similarity", 5)})


@query("""WITH n AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
s AS (SELECT a.vec_id, b.vec_id AS related_id, list_dot_product(a.e, b.e) / sqrt(list_dot_product(a.e, a.e)) / sqrt(list_dot_product(b.e, b.e)) AS s FROM n a JOIN n b ON a.vec_id <> b.vec_id),
t AS (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY s DESC, related_id) AS rank FROM s)
SELECT vec_id, related_id, round(s, 5) AS similarity, rank FROM t WHERE rank <= 6""")
def raw_cosine_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neighbours.neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 6, centred=False)
    return found.select("vec_id", "related_id", F.round("similarity", 5).alias("similarity"), "rank")


@query("WITH " + _DIMS.strip().rstrip(",") + " SELECT label, i - 1 AS position, round(sum(v * (100 + vec_id % 400)) / sum(100 + vec_id % 400), 6) AS mean FROM x GROUP BY label, i")
def topic_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    means = V.mean_vectors(rows, ["label"], "embedding", 100 + F.col("vec_id") % 400)
    return means.select("label", F.posexplode("embedding").alias("position", "mean")).withColumn("mean", F.round("mean", 6)).withColumn("position", F.col("position").cast("long"))


@query(_STRICT + "SELECT chunk_id, best AS best_topic_id, round(bs, 5) AS best_similarity, runner AS runner_up_topic_id, round(rs, 5) AS runner_up_similarity, round(margin, 5) AS winner_margin, accepted, evidence_tier, rejection_reason FROM decisions")
def assign_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topics.decide(chunks(spark, sf_dir), catalogue(spark, sf_dir), RULES)
    number = {c: F.round(c, 5) for c in ("best_similarity", "runner_up_similarity", "winner_margin")}
    return found.withColumns(number).select("chunk_id", "best_topic_id", "best_similarity", "runner_up_topic_id", "runner_up_similarity", "winner_margin", "accepted", "evidence_tier", "rejection_reason")


@query(_STRICT + "SELECT chunk_id, sr_episode_id, best AS topic_id, round(bs, 5) AS similarity, evidence_tier FROM decisions WHERE accepted")
def assign_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topics.assignments(topics.decide(chunks(spark, sf_dir), catalogue(spark, sf_dir), RULES), RULES)
    return found.select("chunk_id", "sr_episode_id", "topic_id", F.round("similarity", 5).alias("similarity"), "evidence_tier")


def _loose(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.assignments(topics.decide(chunks(spark, sf_dir), catalogue(spark, sf_dir), LOOSE), LOOSE)


@query(_ROLL + "SELECT chunk_id, topic_id, round(similarity, 5) AS similarity, chunk_topic_rank, round(winner_margin, 5) AS winner_margin, evidence_tier FROM a")
def assign_secondary(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _loose(spark, sf_dir)
    return found.select("chunk_id", "topic_id", F.round("similarity", 5).alias("similarity"), "chunk_topic_rank", F.round("winner_margin", 5).alias("winner_margin"), "evidence_tier")


@query("WITH " + _TOPICS + """, negs AS (SELECT label AS topic_id, embedding::DOUBLE[] AS ne FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY vec_id) AS q FROM embeddings) WHERE q <= 2),
nn AS (SELECT t.chunk_id, t.best, t.bs, max(list_dot_product(t.e, n.ne)) AS ns FROM top2 t JOIN negs n ON n.topic_id = t.best GROUP BY ALL)
SELECT chunk_id, best AS best_topic_id, round(ns, 5) AS negative_similarity, round(bs - ns, 5) AS negative_margin, bs >= 0.2 AND (bs - ns) >= 0.05 AS accepted FROM nn""")
def negative_veto(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two first vectors of a label stand for its negative examples."""
    first = Window.partitionBy("label").orderBy("vec_id")
    negatives = table(spark, sf_dir, "embeddings").withColumn("q", F.row_number().over(first)).filter("q <= 2").select(F.col("label").alias("topic_id"), "embedding")
    rules = topics.Thresholds(min_similarity=0.2, min_winner_margin=0.0, supporting_min=None, min_negative_margin=0.05)
    found = topics.decide(chunks(spark, sf_dir), catalogue(spark, sf_dir), rules, negatives=negatives)
    return found.select("chunk_id", "best_topic_id", F.round("negative_similarity", 5).alias("negative_similarity"), F.round("negative_margin", 5).alias("negative_margin"), "accepted")


_RAW = """WITH c AS (SELECT vec_id AS chunk_id, vec_id % 50 AS ep, 100 + vec_id % 400 AS w, vec_id * 10 AS st, label AS topic_id FROM embeddings),
g AS (SELECT ep AS sr_episode_id, topic_id, count(*) AS chunk_count, sum(w)::BIGINT AS word_count, arg_min(chunk_id, st) AS representative_chunk_id, min(st) AS st FROM c GROUP BY ep, topic_id),
r AS (SELECT *, word_count / greatest(sum(word_count) OVER (PARTITION BY sr_episode_id), 1) AS share FROM g),
q AS (SELECT *, row_number() OVER (PARTITION BY sr_episode_id ORDER BY share DESC, topic_id) AS rank FROM r) """


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.raw_rollup(chunks(spark, sf_dir).withColumnRenamed("label", "topic_id"))


@query(_RAW + "SELECT sr_episode_id, topic_id, chunk_count, word_count, representative_chunk_id, round(share, 4) AS share, rank FROM q")
def episode_topic_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).select("sr_episode_id", "topic_id", "chunk_count", "word_count", "representative_chunk_id", F.round("share", 4).alias("share"), "rank")


@query(_RAW + "SELECT sr_episode_id, topic_id, round(share, 4) AS share, rank FROM q WHERE rank <= 5")
def top_topics_per_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _raw(spark, sf_dir).filter("rank <= 5").select("sr_episode_id", "topic_id", F.round("share", 4).alias("share"), "rank")


@query("""WITH c AS (SELECT vec_id AS chunk_id, vec_id % 50 AS ep, 100 + vec_id % 400 AS w, label AS topic_id FROM embeddings)
SELECT topic_id, count(*) AS chunk_count, count(DISTINCT ep) AS episode_count, sum(w)::BIGINT AS word_count FROM c GROUP BY topic_id""")
def topic_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.topic_summary(chunks(spark, sf_dir).withColumnRenamed("label", "topic_id"))


@query(_RAW + """, d AS (SELECT *, row_number() OVER (PARTITION BY sr_episode_id ORDER BY (topic_id = 0)::INT, word_count DESC, st, topic_id) AS k FROM q)
SELECT sr_episode_id, topic_id AS dominant_topic_id, word_count FROM d WHERE k = 1""")
def dominant_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.dominant_topics(_raw(spark, sf_dir), outlier=0)


@query(_ROLL + """, tot AS (SELECT vec_id % 50 AS sr_episode_id, sum(100 + vec_id % 400) AS ew FROM embeddings GROUP BY 1),
ev AS (SELECT sr_episode_id, topic_id, count(*) AS chunk_count, sum((evidence_tier <> 'supporting')::INT)::BIGINT AS strong_chunk_count, sum(word_count)::BIGINT AS evidence_words,
  sum(similarity * word_count) / sum(word_count) AS mean_similarity, max(similarity) AS max_similarity FROM a GROUP BY ALL),
k AS (SELECT ev.*, evidence_words / greatest(ew, 1) AS coverage FROM ev JOIN tot USING (sr_episode_id)),
z AS (SELECT *, coverage * mean_similarity AS score FROM k WHERE (strong_chunk_count >= 1 AND evidence_words >= 140 AND coverage >= 0.03 AND (chunk_count >= 2 OR max_similarity >= 0.515)) OR (chunk_count >= 2 AND evidence_words >= 250 AND coverage >= 0.08))
SELECT sr_episode_id, topic_id, chunk_count, strong_chunk_count, evidence_words, round(coverage, 4) AS coverage, round(mean_similarity, 5) AS mean_similarity, round(max_similarity, 5) AS max_similarity, round(score, 5) AS score,
 row_number() OVER (PARTITION BY sr_episode_id ORDER BY score DESC, topic_id) AS rank FROM z""")
def episode_topic_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = chunks(spark, sf_dir).groupBy("sr_episode_id").agg(F.sum("word_count").alias("episode_words"))
    found = topics.curated_rollup(_loose(spark, sf_dir), totals)
    return found.select("sr_episode_id", "topic_id", "chunk_count", "strong_chunk_count", "evidence_words", F.round("coverage", 4).alias("coverage"), *[F.round(c, 5).alias(c) for c in ("mean_similarity", "max_similarity", "score")], "rank")


_BANDS = "CASE WHEN bs < 0 THEN NULL WHEN bs < 0.48 THEN 0 WHEN bs < 0.50 THEN 1 WHEN bs < 0.52 THEN 2 WHEN bs < 0.54 THEN 3 WHEN bs < 0.56 THEN 4 WHEN bs < 1.0 THEN 5 END"


@query("WITH " + _TOPICS + f""", b AS (SELECT chunk_id, best, bs, {_BANDS} AS band FROM top2),
p AS (SELECT *, row_number() OVER (PARTITION BY best, band ORDER BY bs, chunk_id) - 1 AS pos, count(*) OVER (PARTITION BY best, band) AS n FROM b WHERE band IS NOT NULL)
SELECT chunk_id, best AS best_topic_id, band, round(bs, 5) AS best_similarity FROM p WHERE pos = 0 OR pos = n - 1""")
def calibration_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topics.calibration_sample(topics.decide(chunks(spark, sf_dir), catalogue(spark, sf_dir), RULES), per_band=2)
    return found.select("chunk_id", "best_topic_id", "band", F.round("best_similarity", 5).alias("best_similarity"))


@query("""WITH r AS (SELECT d.source AS topic, d.n_chars AS score, l.quality = 1 AS relevant FROM documents d JOIN labels l USING (doc_id)),
t AS (SELECT *, sum(relevant::INT) OVER w AS good, count(*) OVER w AS n FROM r WINDOW w AS (PARTITION BY topic ORDER BY score DESC RANGE UNBOUNDED PRECEDING))
SELECT topic, coalesce(min(CASE WHEN good / n >= 0.85 AND good >= 2 THEN score::DOUBLE END), 0.53) AS threshold FROM t GROUP BY topic""")
def threshold_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    reviews = table(spark, sf_dir, "documents").join(table(spark, sf_dir, "labels"), "doc_id")
    reviews = reviews.select(F.col("source").alias("topic"), F.col("n_chars").cast("double").alias("score"), (F.col("quality") == 1).alias("relevant"))
    return topics.thresholds(reviews, "topic", "score", "relevant")


_SEG = """WITH b AS (SELECT vec_id % 50 AS ep, vec_id // 50 AS idx, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT ep, idx, unnest(list_transform(e, lambda q: q / sqrt(list_dot_product(e, e)))) AS v, generate_subscripts(e, 1) AS i FROM b),
w AS (SELECT *, avg(v) OVER (PARTITION BY ep, i ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS l, avg(v) OVER (PARTITION BY ep, i ORDER BY idx ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING) AS r FROM d),
s AS (SELECT ep, idx, greatest(0, 1 - sum(l * r) / greatest(sqrt(sum(l * l)), 1e-12) / greatest(sqrt(sum(r * r)), 1e-12)) AS dist FROM w WHERE idx > 0 GROUP BY ep, idx),
q AS (SELECT ep, quantile_cont(dist, 0.25) AS lo, quantile_cont(dist, 0.9) AS hi FROM s GROUP BY ep),
z AS (SELECT s.ep, idx, dist, least(greatest((dist - lo) / greatest(hi - lo, 1e-6), 0), 1.5) AS sem, (idx * 7 % 9)::DOUBLE AS pause FROM s JOIN q ON s.ep = q.ep),
y AS (SELECT *, least(ln(1 + pause) / ln(4), 1.5) AS ps FROM z) """


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    index = F.expr("vec_id div 50").cast("int")
    return rows.select(
        (F.col("vec_id") % 50).alias("sr_episode_id"), index.alias("unit_index"), (index * 7 % 9).cast("double").alias("pause_before_seconds"), (60 + F.col("vec_id") % 240).alias("word_count"), (index * 40.0).alias("start_seconds"), (index * 40.0 + 30).alias("end_seconds"), F.concat(F.lit("unit "), F.col("vec_id").cast("string")).alias("text"), "embedding"
    )


@query(_SEG + """SELECT ep AS sr_episode_id, idx AS boundary_index, round(dist, 5) AS semantic_distance, round(sem, 4) AS semantic_score, round(ps, 5) AS pause_score,
 round(CASE WHEN pause >= 5 THEN greatest(0.82 * sem + 0.18 * ps, 1.8) ELSE 0.82 * sem + 0.18 * ps END, 4) AS boundary_score, pause >= 5 AS likely_music_break FROM y""")
def rolling_context_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = segment.score_boundaries(_units(spark, sf_dir))
    return found.select("sr_episode_id", F.col("boundary_index").cast("long").alias("boundary_index"), F.round("semantic_distance", 5).alias("semantic_distance"), F.round("semantic_score", 4).alias("semantic_score"), F.round("pause_score", 5).alias("pause_score"), F.round("boundary_score", 4).alias("boundary_score"), "likely_music_break")


@query()
def boundary_dp(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _units(spark, sf_dir)
    return segment.select_boundaries(units, segment.score_boundaries(units))


@query()
def semantic_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    units = _units(spark, sf_dir)
    return segment.materialise(units, segment.select_boundaries(units, segment.score_boundaries(units)))


@query("""WITH old AS (SELECT vec_id FROM embeddings WHERE vec_id % 3 <> 0), now AS (SELECT vec_id, label FROM embeddings WHERE vec_id % 7 <> 0)
SELECT n.vec_id, n.label, CASE WHEN o.vec_id IS NULL THEN 'computed' ELSE 'cached' END AS origin FROM now n LEFT JOIN old o USING (vec_id)""")
def cache_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    cache = rows.filter("vec_id % 3 <> 0").select("vec_id", "embedding")
    now = rows.filter("vec_id % 7 <> 0").select("vec_id", "label")
    return incremental.upsert(now, cache, "vec_id", lambda missing: missing.join(rows.select("vec_id", "embedding"), "vec_id").select("vec_id", "embedding")).select("vec_id", "label", "origin")


@query("""WITH p AS (SELECT vec_id, embedding[1]::DOUBLE AS x, embedding[2]::DOUBLE AS y FROM embeddings), b AS (SELECT min(x) AS x0, greatest(max(x) - min(x), 1e-9) AS xs, min(y) AS y0, greatest(max(y) - min(y), 1e-9) AS ys FROM p),
s AS (SELECT vec_id, (x - x0) / xs * 640 AS px, (y - y0) / ys * 480 AS py FROM p CROSS JOIN b), q AS (SELECT i AS click, i * 64.0 AS cx, i * 48.0 AS cy FROM range(0, 10) t(i)),
d AS (SELECT click, vec_id, sqrt((px - cx) * (px - cx) + (py - cy) * (py - cy)) AS dist FROM q CROSS JOIN s)
SELECT click, arg_min(vec_id, (dist, vec_id)) AS vec_id, round(min(dist), 4) AS distance FROM d WHERE dist < 12 GROUP BY click""")
def nearest_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding")[0].cast("double").alias("x"), F.col("embedding")[1].cast("double").alias("y"))
    clicks = spark.range(10).select(F.col("id").alias("click"), (F.col("id") * 64.0).alias("cx"), (F.col("id") * 48.0).alias("cy"))
    found = search.nearest_points(clicks, search.to_canvas(points, 640, 480), "click", "vec_id", 12.0)
    return found.withColumn("distance", F.round("distance", 4))


@query(_RAW + """, m AS (SELECT sr_episode_id, coalesce(max(CASE WHEN topic_id IN (2, 5) AND rank <= 5 THEN share END), 0) AS m FROM q GROUP BY sr_episode_id)
SELECT sr_episode_id, round(m, 4) AS topic_match, row_number() OVER (ORDER BY m DESC, sr_episode_id DESC) AS position FROM m""")
def topic_match_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    lists = _raw(spark, sf_dir).filter("rank <= 5").groupBy("sr_episode_id").agg(F.collect_list(F.struct("topic_id", "share")).alias("topics"))  # five a row
    match = search.topic_match(F.col("topics"), [2, 5])
    rows = lists.select("sr_episode_id", match.alias("m")).withColumn("place", F.struct((-F.col("m")).alias("m"), (-F.col("sr_episode_id")).alias("e")))
    return rows.join(incremental.numbered(rows, "place"), "place").select("sr_episode_id", F.round("m", 4).alias("topic_match"), (F.col("position") + 1).alias("position"))


@query()
def kmeans_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.cluster(table(spark, sf_dir, "embeddings"), "embedding", k=10).select("vec_id", "label", "topic_id")


@query()
def related_by_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Neighbours by the inverted file: what ``related_topk`` finds, but for those in cells that are not looked into."""
    return cells.search(cells.build(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")).withColumnsRenamed({"id": "vec_id", "related_id": "related_vec_id"})


@query()
def density_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of at least five vectors, and outliers."""
    return density.density_clusters(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 5, 3)


@query("""WITH RECURSIVE v AS (SELECT vec_id, embedding, list_transform(embedding::DOUBLE[], lambda x: x / greatest(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 1e-12)) AS u FROM embeddings),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, CASE WHEN a.embedding = b.embedding THEN 1 ELSE round(list_dot_product(a.u, b.u), 12) END AS s FROM v a JOIN v b ON a.vec_id <> b.vec_id),
k AS (SELECT a, s AS core FROM (SELECT a, s, row_number() OVER (PARTITION BY a ORDER BY s DESC) AS r FROM s) WHERE r = 3),
f AS (SELECT min(vec_id) AS id FROM v GROUP BY embedding),
m AS (SELECT s.a, s.b, greatest(sqrt(greatest(2 - 2 * least(s, x.core, y.core), 0)), 1e-6) AS d FROM s JOIN k x ON x.a = s.a JOIN k y ON y.a = s.b WHERE s.a IN (FROM f) AND s.b IN (FROM f)),
p AS (SELECT 0 AS step, id, CASE WHEN id = (SELECT min(id) FROM f) THEN 0.0::DOUBLE ELSE 9.0::DOUBLE END AS d, false AS done, 0.0::DOUBLE AS took FROM f
 UNION ALL SELECT step + 1, q.id, CASE WHEN q.id = q.next THEN q.d ELSE least(q.d, m.d) END, done OR q.id = q.next, q.least
  FROM (SELECT *, first_value(id) OVER o AS next, first_value(d) OVER o AS least, bool_and(done) OVER () AS every FROM p WINDOW o AS (ORDER BY done, d, id)) q LEFT JOIN m ON m.a = q.next AND m.b = q.id WHERE NOT every)
SELECT round(took, 5) AS distance, count(*) AS edges FROM (SELECT DISTINCT step, took FROM p WHERE step > 1) GROUP BY ALL""")
def reachability_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lengths of the spanning tree under the clusters, which are the same in every such tree; the statement grows it row by row."""
    tree = density.tree_edges(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 3)
    return tree.groupBy(F.round("distance", 5).alias("distance")).agg(F.count(F.lit(1)).alias("edges"))


@query()
def pca_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.map_2d(table(spark, sf_dir, "embeddings"), "embedding").select("vec_id", "x", "y")


@query()
def neighbourhood_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topics.neighbourhood_map(table(spark, sf_dir, "embeddings"), "vec_id", "embedding").select("vec_id", "x", "y")


@query("""WITH v AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x / greatest(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 1e-12)) AS u FROM embeddings),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, greatest(1 - round(list_dot_product(a.u, b.u), 12), 0) AS d, row_number() OVER (PARTITION BY a.vec_id ORDER BY round(list_dot_product(a.u, b.u), 12) DESC, b.vec_id) AS r FROM v a JOIN v b ON a.vec_id <> b.vec_id)
SELECT least(a, b) AS a, greatest(a, b) AS b, count(*) AS ends, bool_or(r = 1) AS nearest FROM s WHERE r <= 15 GROUP BY ALL""")
def fuzzy_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map's links: how many of their ends name them, and whether one names them first, which gives them a weight of 1."""
    near = neighbours.neighbours(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", 15, centred=False).withColumnRenamed("vec_id", "id")
    links = layout.fuzzy_links(near)
    ends = near.groupBy(F.least("id", "related_id").alias("a"), F.greatest("id", "related_id").alias("b")).agg(F.count(F.lit(1)).alias("ends"))
    return links.join(ends, ["a", "b"]).select("a", "b", "ends", (F.col("weight") >= 1 - 1e-12).alias("nearest"))


@query()
def topic_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Average-linkage tree over the mean vectors of the labels."""
    return linkage.merge_tree(V.mean_vectors(table(spark, sf_dir, "embeddings"), ["label"], "embedding"), "label", "embedding")


@query("""WITH n AS (SELECT label, list(vec_id ORDER BY vec_id)[1:2] AS v FROM embeddings GROUP BY label) SELECT label AS topic_id, generate_subscripts(v, 1) - 1 AS example, unnest(v) AS vec_id FROM n""")
def negative_examples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two first vectors of a topic stand for its negative examples, flattened with their places."""
    first = Window.partitionBy("label").orderBy("vec_id")
    rows = table(spark, sf_dir, "embeddings").withColumn("q", F.row_number().over(first)).filter("q <= 2")
    flat = topics.negative_pairs(rows, "label", "vec_id", "q").select(F.col("label").alias("topic_id"), F.posexplode("pair").alias("example", "vec_id"))
    return flat.withColumn("example", F.col("example").cast("long"))


@query("""WITH c AS (SELECT vec_id % 50 AS sr_episode_id, label AS topic_id, vec_id, 100 + vec_id % 400 AS w FROM embeddings), r AS (SELECT *, row_number() OVER (PARTITION BY sr_episode_id, topic_id ORDER BY w DESC, vec_id) AS k FROM c)
SELECT sr_episode_id, topic_id, vec_id AS representative, w AS words FROM r WHERE k = 1""")
def longest_representative(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest chunk of an episode's topic stands for it; of equally long ones the first."""
    return taxonomy.longest_representative(chunks(spark, sf_dir).withColumnRenamed("label", "topic_id"), ["sr_episode_id", "topic_id"])


@query("""WITH u AS (SELECT vec_id % 50 AS ep, vec_id // 50 AS i, 60 + vec_id % 240 AS w, vec_id FROM embeddings), c AS (SELECT *, sum((i > 0 AND i % 3 = 0)::INT) OVER (PARTITION BY ep ORDER BY i) AS k FROM u)
SELECT ep AS sr_episode_id, k::BIGINT AS chunk_index, sum(w)::BIGINT AS word_count, count(*) AS unit_count, min(i)::INT AS unit_start_index, max(i)::INT + 1 AS unit_end_index, string_agg('unit ' || vec_id, ' ' ORDER BY i) AS text, ep || ':c' || lpad(k::VARCHAR, 4, '0') || ':' || substr(sha256(string_agg('unit ' || vec_id, ' ' ORDER BY i)), 1, 12) AS chunk_id FROM c GROUP BY ep, k""")
def chunk_materialise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks between boundaries that are given: here every third."""
    units = _units(spark, sf_dir)
    cuts = units.filter("unit_index > 0").select("sr_episode_id", F.col("unit_index").alias("boundary_index"), (F.col("unit_index") % 3 == 0).alias("selected"), F.lit(1.0).alias("boundary_score"))
    return segment.materialise(units, cuts).select("sr_episode_id", F.col("chunk_index").cast("long").alias("chunk_index"), "word_count", "unit_count", "unit_start_index", "unit_end_index", "text", "chunk_id")


@query("""WITH s AS (SELECT label AS topic_id, count(*) AS n FROM embeddings GROUP BY label), e AS (SELECT label AS topic_id, vec_id, row_number() OVER (PARTITION BY label ORDER BY vec_id % 3, vec_id % 50, vec_id) AS r FROM embeddings WHERE vec_id % 3 < 2)
SELECT s.topic_id, n AS chunk_count, '## Topic ' || s.topic_id || ' (' || n || ')' || chr(10) || string_agg('- chunk ' || vec_id, chr(10) ORDER BY r) AS section FROM s JOIN e ON e.topic_id = s.topic_id AND r <= 5 GROUP BY s.topic_id, n""")
def report_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown of the topics with up to five examples each, of rank 0 and 1 here."""
    rows = chunks(spark, sf_dir)
    summary = rows.groupBy(F.col("label").alias("topic_id")).agg(F.count(F.lit(1)).alias("chunk_count")).withColumn("label", F.concat(F.lit("Topic "), F.col("topic_id").cast("string")))
    examples = rows.select(F.col("label").alias("topic_id"), (F.col("chunk_id") % 3).alias("rank"), F.struct(F.col("sr_episode_id"), "chunk_id").alias("sr_episode_id"), F.concat(F.lit("chunk "), F.col("chunk_id").cast("string")).alias("excerpt")).filter("rank < 2")
    return export.report_lines(summary, examples)
