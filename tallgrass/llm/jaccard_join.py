"""N-gram Jaccard self-join by token-combination prefixes, and its connected components.

Tokens are hashed five-word shingles. If two sets reach the threshold, the first tokens of both in one common order (their
prefixes) must share some; extended prefixes must share more. The join is exact, in these steps:

1. equal sets become one class; only its first document goes on;
2. in extended prefixes, tokens that no other class has are counted out: most documents cannot have a partner;
3. whole sets of the rest, exact document frequencies, and prefixes with rare tokens first;
4. stars: in the groups of a few tokens everyone is verified against the most central document, linear work that joins nearly
   all members of large groups of near copies into components;
5. what is left, pairs in different components, is found through single rare tokens and through combinations of two
   frequent tokens, and verified in blocks of whole sets of like sizes;
6. links are counted inside the components, where all of them are, again in blocks: a block gives a number for each of
   its sets, not a row for each pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.llm.components import components
from tallgrass.llm.textops import Chunk, chunks, mix64, per_row, release, window_hashes
from tallgrass.llm.workspace import stage, unused

SHINGLE = 5
#: Share of a set by which prefixes are extended in step 2, and which they must then share.
EXTENSION = 0.1
#: Documents sampled for tokens that are frequent everywhere, and in how many of them such a token is.
SAMPLE_DOCS, SAMPLE_HITS = 4096, 10
#: Tokens in more sets than this are the frequent class: indexed by combinations of two.
RARE_DF = 48
#: Sets in a block when what is left of a family is compared.
BLOCK_SETS = 256
#: Tables of keys up to this number of rows are broadcast; larger ones are joined.
BROADCAST_ROWS = 500_000
_U = np.uint64


def shingle_sets(chunk: Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes, ascending within each row, and the edges of the rows."""
    hashes, rows, _ = window_hashes(chunk.words(lower=True), SHINGLE, True)
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    if len(rows):
        new = np.ones(len(rows), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
        hashes, rows = hashes[new], rows[new]
    return hashes, np.searchsorted(rows, np.arange(chunk.rows + 1))


def _least(n):
    """Tokens that a partner must share at least: three quarters, rounded up."""
    return (3 * n + 3) // 4


def _heavy_tokens(rows: DataFrame) -> np.ndarray:
    """Tokens of SAMPLE_HITS of the SAMPLE_DOCS documents whose identifiers hash lowest. They only set an order."""
    by_hash = F.xxhash64("id")
    cut = rows.select(by_hash.alias("x")).orderBy("x").limit(SAMPLE_DOCS).agg(F.max("x")).first()[0]
    if cut is None:
        return np.zeros(0, np.uint64)

    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(0)):
                found, number = np.unique(shingle_sets(chunk)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(number)], ["t", "n"])

    sample = rows.filter(by_hash <= F.lit(cut)).limit(2 * SAMPLE_DOCS).select("text").mapInArrow(tokens, "t long, n long")
    heavy = sample.groupBy("t").agg(F.sum("n").alias("n")).filter(F.col("n") >= SAMPLE_HITS).select("t").toPandas()["t"]
    return np.sort(heavy.to_numpy(np.int64).view(np.uint64))


def _signatures(rows: DataFrame, kind: str) -> DataFrame:
    """``id``, ``n``, a fingerprint of the set, and for step 2: how many shared tokens are needed, the frequent ones in the prefix, its other tokens."""
    heavy = rows.sparkSession.sparkContext.broadcast(_heavy_tokens(rows))  # tokens of a bounded sample

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = heavy.value
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                token, edges = shingle_sets(chunk)
                n = np.diff(edges)
                row = np.repeat(np.arange(chunk.rows), n)
                f1, f2 = (per_row(mix64(token ^ _U(c)).view(np.int64), edges) for c in (0x5851F42D4C957F2D, 0x14057B7EF767814F))
                need = np.maximum(1, np.ceil(EXTENSION * n).astype(np.int64))
                take = np.minimum(n, n - _least(n) + need)
                late = np.isin(token, known)
                order = np.lexsort((token, late, row))
                first = (np.arange(len(row)) - edges[row]) < take[row]
                token, late, row = token[order][first], late[order][first], row[first]
                often = np.bincount(row[late], minlength=chunk.rows)
                rest, of = token[~late].view(np.int64), row[~late]
                lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(chunk.rows + 1)).astype(np.int32)), pa.array(rest))
                ids = batch.column(0).slice(chunk.first, chunk.rows)
                yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(f1), pa.array(f2), pa.array(need), pa.array(often), lists], ["id", "n", "f1", "f2", "need", "often", "prefix"])

    return rows.mapInArrow(sign, f"id {kind}, n long, f1 long, f2 long, need long, often long, prefix array<long>")


def _small(table: DataFrame) -> DataFrame:
    """``table`` (staged), marked for broadcast where its number of rows allows it."""
    return F.broadcast(table) if table.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else table


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of ``pairs`` (a member ``a`` and its leader ``b``) whose whole sets reach the threshold: 7 * shared >= 3 * (sizes together).

    A leader's members come in blocks, so a leader's set is sent once a block, and no task gets all members of a leader.
    """
    kind = pairs.schema["a"].dataType.simpleString()
    number = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks"))
    members = pairs.join(number, "b").select("a", "b", F.pmod(F.xxhash64("a"), F.col("blocks")).alias("x")).join(sets.select(F.col("node").alias("a"), "tokens"), "a")
    leaders = number.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("x")).join(sets.select(F.col("node").alias("b"), "tokens"), "b")

    def check(part: pa.Table) -> pa.Table:
        names, tokens = part.column("a").to_pylist(), part.column("tokens").combine_chunks()
        edges, flat = tokens.offsets.to_numpy(), tokens.values.to_numpy()
        lead = next(i for i, name in enumerate(names) if name is None)
        leader = flat[edges[lead] : edges[lead + 1]]
        at = np.minimum(np.searchsorted(leader, flat), len(leader) - 1)
        shared = per_row((leader[at] == flat).astype(np.int64), edges)
        size = np.diff(edges)
        good = 7 * shared >= 3 * (size + len(leader))
        good[lead] = False
        return pa.table({"a": part.column("a").filter(pa.array(good)), "b": part.column("b").filter(pa.array(good))})

    both = members.unionByName(leaders.withColumn("a", F.lit(None).cast(kind)))
    return both.groupBy("b", "x").applyInArrow(check, f"a {kind}, b {kind}")


def _fits(n1: str, s1: str, n2: str, s2: str):
    """Sizes, and numbers of tokens that others have as well, with which the threshold can be reached."""
    return 7 * F.least(s1, s2) >= 3 * (F.col(n1) + F.col(n2))


def _index(sets: DataFrame) -> DataFrame:
    """``node``, ``t``, ``df``, ``n``, ``shared``, ``place`` of the prefixes, rare tokens first, extended by one token."""
    occurs = sets.select("node", "n", F.explode("tokens").alias("t"))
    df = occurs.groupBy("t").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.count(F.lit(1)).alias("df")).filter("lo <> hi").select("t", "df")
    occurs = stage(occurs.join(df, "t"), "shared-tokens")
    shared = occurs.groupBy("node").agg(F.count(F.lit(1)).alias("shared"), F.first("n").alias("n")).filter("4 * shared >= 3 * n").drop("n")
    order = Window.partitionBy("node").orderBy("df", "t")
    placed = occurs.join(shared, "node").withColumn("place", F.row_number().over(order))
    # Tokens that nobody else has stand before all others in the order and take up part of the prefix.
    length = F.col("n") - F.floor((3 * F.col("n") + 3) / 4) + 2
    placed = placed.filter(F.col("n") - F.col("shared") + F.col("place") <= length)
    last = F.max("place").over(Window.partitionBy("node"))
    return stage(placed.withColumn("from_end", last - F.col("place")), "prefix-index")


def _stars(index: DataFrame) -> DataFrame:
    """Pairs of every member of some tokens' groups with the member that has the most tokens in common with others."""
    some = index.filter("place <= 4 or from_end < 8")
    leaders = some.groupBy("t").agg(F.max(F.struct((F.col("shared") / F.col("n")).alias("share"), "node", "n", "shared")).alias("l"))
    pairs = some.join(leaders, "t").filter(F.col("node") != F.col("l.node"))
    pairs = pairs.select(F.col("node").alias("a"), F.col("l.node").alias("b"), "n", "shared", F.col("l.n").alias("n2"), F.col("l.shared").alias("shared2"))
    return pairs.filter(_fits("n", "shared", "n2", "shared2")).select("a", "b").distinct()


def _mixed(rows: DataFrame, key: str) -> DataFrame:
    """Keys whose rows are in more than one component."""
    return rows.groupBy(key).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo <> hi").select(key)


def _families(index: DataFrame, groups: DataFrame) -> DataFrame:
    """``node``, ``c`` (its component) and ``family``: candidates in different components, gathered through their keys.

    Two sets that reach the threshold share a rare token or two frequent ones in their prefixes, so they are in one
    family. Each key links its members with its smallest one: as many edges as members.
    """
    rows = index.join(groups, "node", "left").withColumn("c", F.coalesce("component", "node")).drop("component")
    rows = stage(rows.join(_mixed(rows, "t"), "t").select("node", "c", "t", "df"), "mixed-tokens")
    single = rows.filter(F.col("df") <= RARE_DF).select("node", "c", F.col("t").alias("key"))
    often = rows.filter(F.col("df") > RARE_DF).groupBy("node", "c").agg(F.array_sort(F.collect_list("t")).alias("ts"))
    two = F.expr("flatten(transform(ts, (x, i) -> transform(slice(ts, i + 2, size(ts)), y -> xxhash64(x, y))))")
    double = often.filter(F.size("ts") > 1).select("node", "c", F.explode(two).alias("key"))
    keyed = stage(single.union(double), "keys")
    keyed = keyed.join(_mixed(keyed, "key"), "key")
    heads = keyed.groupBy("key").agg(F.min("node").alias("head"))
    edges = keyed.join(heads, "key").filter("node <> head").select(F.col("node").alias("a"), F.col("head").alias("b"))
    families = components(edges, local=True).withColumnRenamed("component", "family")
    return stage(keyed.select("node", "c").distinct().join(families, "node"), "families")


def join_sets(left: list[np.ndarray], right: list[np.ndarray], columns: int = 4096) -> np.ndarray:
    """Sizes of all intersections of two lists of sets: products of membership matrices, some tokens at a time."""
    x, y = np.concatenate(left), np.concatenate(right)
    rows_x, rows_y = np.repeat(np.arange(len(left)), [len(v) for v in left]), np.repeat(np.arange(len(right)), [len(v) for v in right])
    both = np.intersect1d(x, y)
    shared = np.zeros((len(left), len(right)), np.float32)
    at_x, at_y = np.searchsorted(both, x), np.searchsorted(both, y)
    in_x = at_x < len(both)
    in_x[in_x] = both[at_x[in_x]] == x[in_x]
    in_y = at_y < len(both)
    in_y[in_y] = both[at_y[in_y]] == y[in_y]
    for first in range(0, len(both), columns):
        some = []
        for at, found, rows, n in ((at_x, in_x, rows_x, len(left)), (at_y, in_y, rows_y, len(right))):
            here = found & (at >= first) & (at < first + columns)
            matrix = np.zeros((n, columns), np.float32)
            matrix[rows[here], at[here] - first] = 1
            some.append(matrix)
        shared += some[0] @ some[1].T
    return shared.astype(np.int64)


def _links_of_block(part: pa.Table) -> pa.Table:
    """Verified links between a block of outsiders and a block of the family that join components not yet joined."""
    asks = np.array(part.column("asks").to_pylist(), bool)
    nodes, comps = part.column("node").to_pylist(), part.column("c").to_pylist()
    sets = [np.asarray(t, np.int64) for t in part.column("tokens").to_numpy(zero_copy_only=False)]
    mine, theirs = np.flatnonzero(asks), np.flatnonzero(~asks)
    found: list[tuple] = []
    if len(mine) and len(theirs):
        shared = join_sets([sets[i] for i in mine], [sets[i] for i in theirs])
        sizes = np.array([len(t) for t in sets])
        linked = 7 * shared >= 3 * (sizes[mine][:, None] + sizes[theirs][None, :])
        above = {c: c for c in comps}

        def top(c):
            while above[c] != c:
                above[c] = above[above[c]]
                c = above[c]
            return c

        for i, j in zip(*np.nonzero(linked), strict=True):
            a, b = top(comps[mine[i]]), top(comps[theirs[j]])
            if a != b:
                above[max(a, b)] = min(a, b)
                found.append((nodes[mine[i]], nodes[theirs[j]]))
    kind = part.schema.field("node").type
    release()
    return pa.table({"a": pa.array([f[0] for f in found], kind), "b": pa.array([f[1] for f in found], kind)})


def _like_sized(rows: DataFrame, group: str, mine: Column) -> DataFrame:
    """``rows`` (``node``, ``n``, ``group``) dealt to blocks: those for which ``mine`` holds (``asks``) meet all rows of the group of like size.

    Sizes are cut into steps of a fifth; sets that reach the threshold differ by a third at most, so by two steps. A
    row that asks goes to as many blocks as there are of like size, any other to as many as ask.
    """
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    hashed = lambda c, seed: F.pmod(F.xxhash64("node", F.lit(seed)), F.col(c))
    rows = rows.withColumn("step", F.floor(F.log("n") / F.log(F.lit(1.2))).cast("int")).withColumn("mine", mine)
    sizes = rows.groupBy(group, "step").agg(F.ceil(F.count(F.lit(1)) / BLOCK_SETS).alias("blocks"), F.ceil(F.count_if("mine") / BLOCK_SETS).alias("asking"))
    near = sizes.select(group, F.col("step").alias("other"), F.col("blocks").alias("of"), F.col("asking").alias("ask_of")).withColumn("step", F.explode(F.transform(F.sequence(F.lit(-2), F.lit(2)), lambda i: F.col("other") + i)))
    rows = rows.join(sizes, [group, "step"]).join(near, [group, "step"])
    ask = rows.filter("mine").select("*", F.col("step").alias("s1"), F.col("other").alias("s2"), hashed("asking", 1).alias("x"), upto("of").alias("y"), F.lit(True).alias("asks"))
    have = rows.filter("ask_of > 0").select("*", F.col("other").alias("s1"), F.col("step").alias("s2"), upto("ask_of").alias("x"), hashed("blocks", 2).alias("y"), F.lit(False).alias("asks"))
    return ask.unionByName(have).drop("step", "mine", "other", "blocks", "asking", "of", "ask_of")


def _links_across(families: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between components of a family that the stars have missed, as far as they join components.

    The members outside the family's largest component are compared with all of its members of like size, block by block.
    No pairs are made into rows: a block gives at most as many links as it has components.
    """
    most = families.groupBy("family", "c").agg(F.count(F.lit(1)).alias("k")).groupBy("family").agg(F.max(F.struct("k", "c"))["c"].alias("main"))
    rows = families.join(most, "family").join(sets.select("node", "n"), "node")
    dealt = _like_sized(rows, "family", F.col("c") != F.col("main"))
    kind = sets.schema["node"].dataType.simpleString()
    whole = dealt.join(sets.select("node", "tokens"), "node").select("family", "s1", "x", "s2", "y", "node", "c", "asks", "tokens")
    return whole.groupBy("family", "s1", "x", "s2", "y").applyInArrow(_links_of_block, f"a {kind}, b {kind}")


def _numbers_of_block(part: pa.Table) -> pa.Table:
    """For each set that asks in a block, the number of other sets of the block that it links with."""
    asks = np.array(part.column("asks").to_pylist(), bool)
    nodes = np.array(part.column("node").to_pylist(), object)
    sets = [np.asarray(t, np.int64) for t in part.column("tokens").to_numpy(zero_copy_only=False)]
    mine, theirs = np.flatnonzero(asks), np.flatnonzero(~asks)
    if not len(mine) or not len(theirs):
        return pa.table({"node": pa.array([], part.schema.field("node").type), "links": pa.array([], pa.int64())})
    sizes = np.array([len(t) for t in sets])
    linked = 7 * join_sets([sets[i] for i in mine], [sets[i] for i in theirs]) >= 3 * (sizes[mine][:, None] + sizes[theirs][None, :])
    release()
    number = linked.sum(axis=1) - (nodes[mine][:, None] == nodes[theirs][None, :]).sum(axis=1)
    return pa.table({"node": pa.array(nodes[mine].tolist(), part.schema.field("node").type), "links": pa.array(number.astype(np.int64))})


def _numbers(groups: DataFrame, sets: DataFrame) -> DataFrame:
    """``node`` and ``n_links``, the number of other sets that it links with: all of them are in its component."""
    rows = groups.join(sets.select("node", "n"), "node")
    kind = sets.schema["node"].dataType.simpleString()
    whole = _like_sized(rows, "component", F.lit(True)).join(sets.select("node", "tokens"), "node").select("component", "s1", "x", "s2", "y", "node", "asks", "tokens")
    found = whole.groupBy("component", "s1", "x", "s2", "y").applyInArrow(_numbers_of_block, f"node {kind}, links long")
    return found.groupBy("node").agg(F.sum("links").alias("n_links"))


def join_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True) -> DataFrame:
    """One row per row of ``docs``: identifier, ``n_shingles``, ``component_id``, the smallest identifier reachable by links, ``n_copies`` and ``n_links``.

    ``n_links`` is the number of other shingle sets, each however many documents have it, that the document's set links with (left
    out without ``count_links``: it costs work in the square of a component's sets); ``n_copies`` the number of rows with
    the document's set, itself included (1 where it is empty). Documents link where their sets of lower-cased (A-Z) five-word shingles have a Jaccard similarity of 0.75 at least.
    Texts with fewer words are one shingle; texts without words (and nulls) have none and link with nothing. Copies
    are one class, however many. Rows that share an identifier count as one document. A row with a null identifier
    gets the component of its copies, and null where it has none. An empty table gives an empty result.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    signed = stage(_signatures(rows, kind), "signatures")

    # Equal sets: only classes of several documents need a join.
    copies = signed.filter("n > 0").groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("m")).filter("m > 1")
    copies = stage(copies, "classes")
    signed = signed.join(_small(copies), ["f1", "f2"], "left").withColumn("rep", F.when(F.col("n") > 0, F.coalesce("rep", "id")).otherwise(F.col("id")))

    heads = signed.filter("n > 0 and id = rep").select(F.col("id").alias("node"), "need", "often", "prefix")
    # Tokens of very many documents are not in these prefixes, so a token has few rows: one exchange, where an aggregate and a join would take two.
    spread = Window.partitionBy("t")
    hits = heads.select("node", F.explode("prefix").alias("t")).select("node", (F.min("node").over(spread) != F.max("node").over(spread)).alias("hit"))
    hits = hits.filter("hit").groupBy("node").agg(F.count(F.lit(1)).alias("hits"))
    alive = heads.select("node", "need", "often").join(hits, "node", "left").filter("often + coalesce(hits, 0) >= need").select("node").distinct()
    alive = stage(alive, "candidates")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                token, edges = shingle_sets(chunk)
                lists = pa.ListArray.from_arrays(pa.array(edges.astype(np.int32)), pa.array(token.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(chunk.first, chunk.rows), pa.array(np.diff(edges)), lists], ["node", "n", "tokens"])

    wanted = rows.join(_small(alive.withColumnRenamed("node", "id")), "id", "left_semi")
    sets = stage(wanted.mapInArrow(whole, f"node {kind}, n long, tokens array<long>").filter("n > 0"), "sets")
    index = _index(sets)
    links = stage(verify(_stars(index), sets), "star-links")
    groups = stage(components(links, local=True), "star-groups")
    more = stage(_links_across(_families(index, groups), sets), "links")
    groups = stage(components(links.union(more), local=True), "groups") if more.limit(1).count() else groups
    found = stage(groups.join(_numbers(groups, sets), "node", "left"), "numbers") if count_links else groups
    # All copies of a text have one representative: where its table is small they are not brought together for it.
    out = signed.select("id", "n", "rep", "m").join(_small(found.withColumnRenamed("node", "rep")), "rep", "left")
    columns = [F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.coalesce("component", "rep").alias("component_id"), F.coalesce("m", F.lit(1).cast("long")).alias("n_copies")]
    return out.select(*columns, *([F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")] if count_links else []))


def first_of_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that have the smallest identifier of their component, or no identifier.

    Null, empty and blank texts link with nothing and stay. Rows that repeat an identifier stay or go together. An empty
    table gives none. Columns may have any names.
    """
    found = join_documents(docs, id_col, text_col, count_links=False)
    other = unused(docs, "later")
    later = stage(found.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias(other)), "later-copies")
    return docs.join(_small(later), docs[id_col] == F.col(other), "left_anti")


#: The same rows by DuckDB, for tables of a few thousand documents: all pairs that share a shingle.
SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS l FROM documents),
s AS (SELECT doc_id, CASE WHEN len(l) = 0 THEN [] WHEN len(l) < 5 THEN [array_to_string(l, ' ')] ELSE list_distinct(list_transform(range(1, len(l) - 3), lambda i: array_to_string(l[i:i + 4], ' '))) END AS t FROM w),
n AS (SELECT doc_id, len(t) AS n FROM s), x AS (SELECT doc_id, unnest(t) AS g FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b, k = na.n AND k = nb.n AS same FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 75 * (na.n + nb.n - k)),
c AS (SELECT n.doc_id, least(n.doc_id, coalesce(min(b), n.doc_id)) AS class, count(b) + 1 AS n_copies FROM n LEFT JOIN e ON e.a = n.doc_id AND same GROUP BY n.doc_id),
l AS (SELECT a AS doc_id, count(DISTINCT class) AS n_links FROM e JOIN c ON c.doc_id = e.b WHERE NOT same GROUP BY a),
r(doc_id, least) AS (SELECT doc_id, doc_id FROM n UNION SELECT e.b, r.least FROM r JOIN e ON e.a = r.doc_id WHERE r.least < e.b)
SELECT n.doc_id, n.n AS n_shingles, min(r.least) AS component_id, any_value(n_copies) AS n_copies, coalesce(any_value(n_links), 0) AS n_links FROM n JOIN r USING (doc_id) JOIN c USING (doc_id) LEFT JOIN l USING (doc_id) GROUP BY ALL
"""
