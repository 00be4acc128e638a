"""Mixing sources to target weights by min-cost flow, then by seeded selection of documents.

Documents are aggregated by membership pattern (the set of sources that they belong to). A flow network leads from the
patterns, whose tokens can be used once, twice or three times at rising cost, to the sources and their quotas. The flow
fixes how many tokens of each pattern the mix takes; which documents supply them follows a seeded hash.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallgrass.llm.workspace import stage, words_in

MAX_REPEATS = 3
#: Cost of a token's first, second and third use: convex, so that fresh tokens go first.
REPEAT_COST = (0, 1, 3)
#: Tables with a row for each pattern or source are broadcast up to this number of rows, and joined beyond it.
BROADCAST_PATTERNS = 100_000
#: Ranges of the selection hash in which token counts are summed before one range is cut document by document.
SLOTS = 4096


def quotas(sizes: dict[str | None, int], weights: Sequence[float] = (1, 2, 3), cap: float = MAX_REPEATS) -> dict[str | None, float]:
    """Targets: weights repeat over the sources by code point, null last; together all tokens; at most ``cap`` times a source's size.

    What is above a cap is shared again by weight among the other sources until none is above.
    """
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target: dict[str | None, float] = {}
    left, open_ = float(sum(sizes.values())), list(names)
    while open_:
        unit = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * unit > cap * sizes[s]]
        if not full:
            return target | {s: weight[s] * unit for s in open_}
        for s in full:
            target[s] = float(cap * sizes[s])
            left -= target[s]
            open_.remove(s)
    return target


def min_cost_flow(patterns: dict[tuple, int], target: dict[str | None, float]) -> dict[tuple, dict[str | None, float]]:
    """Tokens routed from each pattern to each of its sources: successive shortest paths over the residual network.

    Nodes: the patterns and the sources. A pattern supplies its tokens ``MAX_REPEATS`` times at ``REPEAT_COST``; only the
    next layer that is not full is on offer, which is right since the costs are convex. Paths may run back over routed
    flow. Ties go to the earlier pattern, so the flow is the same in every run.
    """
    flow = {p: dict.fromkeys(p, 0.0) for p in patterns}
    eps = 1e-9 * max(1.0, sum(target.values()))
    serves: dict[str | None, list[tuple]] = {}
    for p in sorted(patterns, key=repr):
        for s in p:
            serves.setdefault(s, []).append(p)
    for goal in sorted(target, key=repr):
        need = target[goal]
        while need > eps:
            # From the source that lacks tokens back to a pattern with spare ones.
            best: dict[str | None, tuple[float, tuple | None, str | None]] = {goal: (0.0, None, None)}
            heap: list = [(0.0, 0, goal)]
            end, tick, done = None, 0, set()
            while heap:
                cost, _, s = heapq.heappop(heap)
                if s in done:
                    continue
                done.add(s)
                for p in serves.get(s, ()):
                    used = sum(flow[p].values())
                    layer = int(used / patterns[p] + 1e-12) if patterns[p] else MAX_REPEATS
                    if layer < MAX_REPEATS and patterns[p] * (layer + 1) - used > eps:
                        if end is None or cost + REPEAT_COST[layer] < end[0]:
                            end = (cost + REPEAT_COST[layer], p, s, patterns[p] * (layer + 1) - used)
                    for t in p:
                        if t not in done and flow[p][t] > eps and (t not in best or cost < best[t][0]):
                            tick += 1
                            best[t] = (cost, p, s)
                            heapq.heappush(heap, (cost, tick, t))
            if end is None:
                break
            _, p, s, room = end
            path, amount = [(p, s)], min(need, room)
            while s != goal:  # ``q`` gives up tokens for ``s`` and serves ``s`` of the step before
                _, q, nearer = best[s]
                path.append((q, s, nearer))
                amount, s = min(amount, flow[q][s]), nearer
            flow[path[0][0]][path[0][1]] += amount
            for q, was, now in path[1:]:
                flow[q][was] -= amount
                flow[q][now] += amount
            need -= amount
    return flow


def mix(df: DataFrame, sources: Column, size: Column, id_col: str = "doc_id", weights: Sequence[float] = (1, 2, 3), seed: int = 17) -> DataFrame:
    """One row per row of ``df``: identifier, ``sources``, ``size``, ``repeats`` (0 to 3) and ``taken`` = repeats x size.

    ``sources`` is an array (a null entry is a source of its own; an empty or null array belongs to none and is never
    taken). Null sizes count as 0. A pattern whose flow is r and a fraction times its tokens takes every document r
    times, and documents in the order of a seeded hash of (id, size) once more as far as they fit into the fraction, until
    none that is left does; rows that repeat an identifier count as rows of their own. Documents of size 0 are never taken. Reruns agree. Empty tables give
    empty results. ``sources_target`` comes from ``quotas``.
    """
    rows = stage(_hashed(df.select(F.col(id_col).alias("id"), sources.alias("sources"), size.alias("size")), seed).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    out = rows.join(_planned(rows, weights), F.col("sources").eqNullSafe(F.col("of"))).withColumn("repeats", _repeats(F.col("row")))
    return out.select(F.col("id").alias(id_col), "sources", "size", "repeats", (F.col("size") * F.col("repeats")).alias("taken"))


def _hashed(rows: DataFrame, seed: int = 17) -> DataFrame:
    """``rows`` with ``sources`` in order and ``size`` as a number, and where the seeded hash of (``id``, ``size``) puts them: ``at``, ``slot``."""
    pattern = F.array_sort(F.array_distinct(F.coalesce("sources", F.array().cast("array<string>"))))
    rows = rows.withColumns({"sources": pattern, "size": F.coalesce(F.col("size").cast("long"), F.lit(0).cast("long"))})
    return rows.withColumn("at", F.xxhash64(F.col("id").cast("string"), "size", F.lit(seed))).withColumn("slot", F.pmod("at", F.lit(SLOTS)))


def _planned(rows: DataFrame, weights: Sequence[float] = (1, 2, 3)) -> DataFrame:
    """For each pattern (``of``) how often all of its documents are taken (``times``), and the ``bounds`` of those that are taken once more."""
    totals = rows.groupBy("sources").agg(F.sum("size").alias("tokens")).collect()  # a row for each pattern: the network is on the driver
    patterns = {tuple(r["sources"]): r["tokens"] for r in totals}
    sizes: dict[str | None, int] = {}
    for p, tokens in patterns.items():
        for s in p:
            sizes[s] = sizes.get(s, 0) + tokens
    whole = sum(t for p, t in patterns.items() if p)
    target = quotas(sizes, weights) if sizes else {}
    scale = whole / sum(target.values()) if target and sum(target.values()) > whole else 1.0
    target = {s: t * scale for s, t in target.items()}
    flow = min_cost_flow({p: t for p, t in patterns.items() if p}, target)
    plan = []
    for p, tokens in patterns.items():
        want = sum(flow.get(p, {}).values())
        times = min(MAX_REPEATS, int(want / tokens + 1e-9)) if tokens else 0
        plan.append((list(p), times, max(0.0, want - times * tokens)))
    bounds = _bounds(rows, {tuple(p): rest for p, _, rest in plan})
    return _of_patterns(rows.sparkSession, [(p, times, bounds[tuple(p)]) for p, times, _ in plan], f"of array<string>, times int, bounds {_BOUNDS}")


def _of_patterns(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A table with a row for each pattern, broadcast where they are few."""
    table = spark.createDataFrame(rows, schema)
    return F.broadcast(table) if len(rows) <= BROADCAST_PATTERNS else table


_BOUNDS = "array<struct<most:double,slot:long,at:long,row:long>>"


def _within(bounds: Column, row: Column) -> Column:
    """Whether a row was taken in one of the rounds: not too large for what was lacking, and not behind the round's last document."""
    place = F.struct(F.col("slot").cast("long"), "at", row)
    return (F.col("size") > 0) & F.exists(bounds, lambda b: (F.col("size") <= b["most"]) & (place <= F.struct(b["slot"], b["at"], b["row"])))


def _repeats(row: Column) -> Column:
    """How often a row is taken, by ``times`` and ``bounds`` of its pattern."""
    more = _within(F.col("bounds"), row).cast("int")
    return F.when(F.col("size") == 0, F.lit(0)).otherwise(F.least(F.col("times") + more, F.lit(MAX_REPEATS)))


def _cuts(left: DataFrame, column: str) -> dict[tuple, tuple]:
    """For each pattern its tokens, and the value ``at`` of ``column`` in whose rows the gap is passed, with the tokens ``below`` it; None where it is not passed."""
    sums = left.groupBy("of", "gap", column).agg(F.sum("size").alias("tokens"))
    sums = sums.withColumn("below", F.sum("tokens").over(Window.partitionBy("of").orderBy(column)) - F.col("tokens"))  # SLOTS rows a pattern at most
    cut = (F.col("below") <= F.col("gap")) & (F.col("gap") < F.col("below") + F.col("tokens"))
    found = sums.groupBy("of").agg(F.sum("tokens").alias("all"), F.max(F.when(cut, F.struct(F.col(column).cast("long").alias("at"), "below"))).alias("cut"))
    return {tuple(r["of"]): (r["all"], r["cut"]) for r in found.collect()}  # a row a pattern


def _bounds(rows: DataFrame, rest: dict[tuple, float]) -> dict[tuple, list[tuple]]:
    """For each pattern the rounds in which documents are taken in the order of the hash, until none that is left fits.

    A round passes over the documents that are larger than what is lacking at its start, and ends before the first one that
    no longer fits. So a later round lacks less than the size of that document.
    """
    spark, gap = rows.sparkSession, {p: r for p, r in rest.items() if p and r > 0}
    bounds: dict[tuple, list[tuple]] = {p: [] for p in rest}
    while gap:
        state = _of_patterns(spark, [(list(p), g, bounds[p]) for p, g in gap.items()], f"of array<string>, gap double, bounds {_BOUNDS}")
        left = rows.join(state, F.col("sources") == F.col("of")).filter((F.col("size") > 0) & (F.col("size") <= F.col("gap")) & ~_within(F.col("bounds"), F.col("row")))
        # Tokens by slot of the hash show in which slot the rest runs out, those by a second hash in which part of the slot;
        # only that part's documents are summed one by one.
        cuts = _cuts(left, "slot")
        ends: dict[tuple, tuple[int, int, float]] = {}
        if inside := [(list(p), c["at"], float(c["below"])) for p, (_, c) in cuts.items() if c]:
            cut = _of_patterns(spark, inside, "cut_of array<string>, cut_slot long, start double")
            slot = left.join(cut, (F.col("of") == F.col("cut_of")) & (F.col("slot") == F.col("cut_slot"))).withColumn("gap", F.col("gap") - F.col("start"))
            slot = slot.drop("cut_of", "cut_slot", "start").withColumn("part", F.shiftright("at", 52))  # ascending with ``at``
            parts = {p: c for p, (_, c) in _cuts(slot, "part").items() if c}
            # All parts before the cut one are in.
            ends = {p: ((c["at"] << 52) - 1, (1 << 63) - 1, float(c["below"])) if c["at"] > -2048 else (-1 << 63, -1, 0.0) for p, c in parts.items()}
            cut = _of_patterns(spark, [(list(p), c["at"], float(c["below"])) for p, c in parts.items()], "cut_of array<string>, cut_part long, start double")
            last = slot.join(cut, (F.col("of") == F.col("cut_of")) & (F.col("part") == F.col("cut_part")))
            upto = Window.partitionBy("of").orderBy("at", "row").rowsBetween(Window.unboundedPreceding, 0)
            last = last.withColumn("upto", F.col("start") + F.sum("size").over(upto)).filter(F.col("upto") <= F.col("gap"))
            ends |= {tuple(r["of"]): (r["end"]["at"], r["end"]["row"], r["upto"]) for r in last.groupBy("of").agg(F.max(F.struct("at", "row")).alias("end"), F.max("upto").alias("upto")).collect()}
        lacking = {}
        for p, (_, cut) in cuts.items():
            if cut is None:  # all that fit one by one fit together, and what is left is larger
                bounds[p].append((gap[p], SLOTS, 0, 0))
                continue
            at, row, taken = ends.get(p, ((1 << 63) - 1, (1 << 63) - 1, gap[p] - cut["below"]))
            bounds[p].append((gap[p], cut["at"], at, row))
            lacking[p] = gap[p] - cut["below"] - taken
        gap = lacking
    return bounds


def sources_target(mixed: DataFrame, weights: Sequence[float] = (1, 2, 3)) -> DataFrame:
    """``source``, ``source_size`` and ``target`` of a mixed table, a row for each source."""
    spark = mixed.sparkSession
    rows = mixed.select("size", F.explode("sources").alias("source")).groupBy("source").agg(F.sum("size").alias("n")).collect()  # a row for each source
    sizes = {r["source"]: r["n"] for r in rows}
    target = quotas(sizes, weights) if sizes else {}
    return _of_patterns(spark, [(s, n, float(target[s])) for s, n in sizes.items()], "source string, source_size long, target double")


def mix_documents(docs: DataFrame) -> DataFrame:
    """Mix ``documents`` by their ``source``, sizes in words: ``doc_id``, ``source``, ``size``, ``source_size``, ``target``, ``repeats``, ``taken``, a row for each row.

    Null and empty texts have size 0 and are never taken; rows without a source are a source of their own; repeated rows
    count as rows of their own; null identifiers are chosen like others. An empty table gives none. No other column is read.
    """
    mixed = mix(docs, F.array(F.col("source").cast("string")), words_in(F.col("text")))
    goal = sources_target(mixed)
    one = mixed.withColumn("source", F.element_at("sources", 1))
    out = one.join(goal.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
    return out.select("doc_id", "source", "size", "source_size", "target", "repeats", "taken")


def take_mix(docs: DataFrame) -> DataFrame:
    """The documents of the mix, all columns: each as often as it is taken, in the sense of ``mix_documents``.

    Every row is looked at where it is, by the bounds of its source: no text is moved. Of repeated rows (same identifier, source and
    size) the selection may end between two; then those whose texts hash highest are taken more often, and only such rows are brought
    together, at most those of one document for each round of a source. An empty table gives none. Columns may have any names.
    """
    whole = F.struct(*[docs[c] for c in docs.columns]).alias("doc")
    rows = docs.select(whole, docs["doc_id"].alias("id"), F.array(docs["source"].cast("string")).alias("sources"), words_in(docs["text"]).alias("size"))
    sizes = stage(_hashed(rows.drop("doc")).withColumn("row", F.monotonically_increasing_id()), "mix-sizes")
    plan, first = _planned(sizes), F.lit(0).cast("long")
    of_plan = lambda rows: rows.join(plan, F.col("sources").eqNullSafe(F.col("of")))

    # The number of a row counts only where a round ends between repeated rows: elsewhere any number gives the same.
    same = lambda a, b: a["id"].eqNullSafe(b["own_id"]) & a["sources"].eqNullSafe(b["own_sources"]) & (a["size"] == b["own_size"])
    keys = [F.col(c).alias(f"own_{c}") for c in ("id", "sources", "size")]
    counted = of_plan(sizes).withColumn("repeats", _repeats(F.col("row")))
    split = stage(counted.filter(F.col("repeats") != _repeats(first)).select(*keys).distinct(), "mix-split")
    taken = of_plan(_hashed(rows)).withColumn("repeats", _repeats(first)).filter("repeats > 0")
    if split.limit(1).count():
        split = F.broadcast(split)  # a document for each round of a source, but for equal hashes of 64 bits
        taken = taken.join(split, same(taken, split), "left_anti").select("doc", "repeats")
        numbers = counted.join(split, same(counted, split)).groupBy("own_id", "own_sources", "own_size", "repeats").agg(F.count(F.lit(1)).alias("n"))
        upto = Window.partitionBy("own_id", "own_sources", "own_size").orderBy("repeats").rowsBetween(Window.unboundedPreceding, 0)
        numbers = numbers.withColumn("upto", F.sum("n").over(upto)).withColumn("below", F.col("upto") - F.col("n"))
        mine = _hashed(rows)
        mine = mine.join(split, same(mine, split), "left_semi")
        mine = mine.withColumn("number", F.row_number().over(Window.partitionBy("id", "sources", "size").orderBy(F.xxhash64("doc.text"))))
        found = mine.join(F.broadcast(numbers), same(mine, numbers) & (F.col("number") > F.col("below")) & (F.col("number") <= F.col("upto")))
        taken = taken.unionByName(found.filter("repeats > 0").select("doc", "repeats"))
    each = taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("repeats"))))
    return each.select(*[F.col("doc").getField(c).alias(c) for c in docs.columns])
