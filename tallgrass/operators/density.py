"""Density clusters: a hierarchy of mutual reachability, condensed, and cut where clusters last longest.

Distances are between vectors of length 1. Equal vectors are one point with a number of copies. A minimum spanning tree grows by
Borůvka rounds: the neighbour table gives most parts their shortest way out, and only points whose list is too short to prove it are
compared with all others, block against block. The tree's edges are then taken in ascending bands of bounded size. A band is one task that
joins clusters, condenses them (a side with fewer rows than ``min_cluster`` falls out as noise or fringe of the other) and
adds up their stability; between bands only labels move, by joins. So neither the driver nor a task ever holds the tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallgrass.functions import vectors as V
from tallgrass.operators.incremental import numbered
from tallgrass.operators.neighbours import block_pairs, neighbours
from tallgrass.staging import stage

#: Edges of the tree that one task joins. Edges of one length are never parted, so a band can be larger by those of its last length.
BAND_EDGES = 1_000_000
#: Parts whose links may be followed on the driver; more are followed by joins.
LOCAL_PARTS = 100_000
#: Points of a block where lists are too short, and those that are multiplied at a time.
BLOCK_ROWS, PART_ROWS = 8192, 2048
#: Distances count as this much at least, so that equal points are not infinitely dense.
LEAST_DISTANCE = 1e-6
NOISE = -1


def _distance(cosine: Column) -> Column:
    """The distance of two vectors of length 1 from their cosine."""
    return F.greatest(F.sqrt(F.greatest(2 - 2 * cosine, F.lit(0.0))), F.lit(LEAST_DISTANCE))


def points_of(df: DataFrame, id_col: str, vector: str) -> DataFrame:
    """``id`` (the smallest of those with an equal vector), ``copies`` and the vector ``v`` of length 1."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("raw")).filter("id IS NOT NULL AND raw IS NOT NULL")
    return rows.groupBy("raw").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("copies")).select("id", "copies", V.unit(F.col("raw")).alias("v"), "raw")


def core_similarity(points: DataFrame, near: DataFrame, min_samples: int) -> DataFrame:
    """Adds ``core``, the cosine to the row that is ``min_samples``-th nearest, copies counted, and ``edge``, the last cosine of the point's list.

    With fewer rows it is the farthest one's; a point alone has a core of 1. A list that holds all points has no edge: nothing is beyond it.
    """
    order = Window.partitionBy("id").orderBy("rank")
    lists = near.join(points.select(F.col("id").alias("related_id"), "copies"), "related_id").withColumn("sofar", F.sum("copies").over(order))
    lists = lists.groupBy("id").agg(F.collect_list(F.struct("rank", "similarity", "sofar")).alias("list"))  # as many as ``near`` has ranks
    rows = points.join(lists, "id", "left").withColumn("list", F.array_sort(F.coalesce("list", F.array().cast(lists.schema["list"].dataType))))
    enough = F.filter("list", lambda x: x["sofar"] + F.col("copies") - 1 >= min_samples)
    farthest = F.coalesce(F.get(F.transform("list", lambda x: x["similarity"]), F.size("list") - 1), F.lit(1.0))
    core = F.when(F.col("copies") > min_samples, 1.0).otherwise(F.coalesce(F.get(enough, F.lit(0))["similarity"], farthest))
    return rows.select("id", "copies", "v", core.alias("core"), farthest.alias("edge"))


def _pack(rows: DataFrame, blocks: int) -> DataFrame:
    """A row for each block of points: identifiers, parts, cores and vectors as bytes."""

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        return pd.DataFrame({"own": part["own"].iloc[:1], "ids": [part["id"].to_numpy(np.int64).tobytes()], "parts": [part["part"].to_numpy(np.int64).tobytes()], "cores": [part["core"].to_numpy().tobytes()], "vs": [np.stack(part["v"].tolist()).tobytes()]})

    rows = rows.withColumn("own", F.pmod(F.xxhash64("id"), F.lit(blocks)).cast("int"))
    return rows.select("own", "id", "part", "core", "v").groupBy("own").applyInPandas(pack, "own int, ids binary, parts binary, cores binary, vs binary")


def _ways_out(pair: pd.DataFrame) -> pd.DataFrame:
    """For each point of the first block the best point of another part in the second one."""
    if len(pair) < 2:  # no point of the first block is open
        return pd.DataFrame({"a": np.zeros(0, np.int64), "b": np.zeros(0, np.int64), "s": np.zeros(0)})
    mine, theirs = ([np.frombuffer(row.ids, np.int64), np.frombuffer(row.parts, np.int64), np.frombuffer(row.cores), np.frombuffer(row.vs)] for row in pair.sort_values("side").itertuples())
    own, other, out = mine[3].reshape(len(mine[0]), -1), theirs[3].reshape(len(theirs[0]), -1), []
    for at in range(0, len(own), PART_ROWS):
        part = slice(at, at + PART_ROWS)
        found, best = np.full(len(own[part]), -np.inf), np.zeros(len(own[part]), np.int64)
        for first in range(0, len(other), PART_ROWS):
            there = slice(first, first + PART_ROWS)
            s = own[part] @ other[there].T
            np.minimum(np.minimum(np.round(s, 12, out=s), mine[2][part, None], out=s), theirs[2][None, there], out=s)
            s[mine[1][part, None] == theirs[1][None, there]] = -np.inf
            top = s.argmax(axis=1)
            s = s[np.arange(len(top)), top]
            better = s > found
            found[better], best[better] = s[better], first + top[better]
        fine = np.isfinite(found)
        out.append(pd.DataFrame({"a": mine[0][part][fine], "b": theirs[0][best[fine]], "s": found[fine]}))
    return pd.concat(out)


def _roots(links: DataFrame) -> tuple[DataFrame, int]:
    """``part`` and ``root`` from one link (``part``, ``to``) for each part, and the number of roots: two parts that name each other are one, under the smaller name."""
    if links.limit(LOCAL_PARTS + 1).count() <= LOCAL_PARTS:
        rows = np.array(links.select("part", "to").collect(), np.int64).reshape(-1, 2)  # LOCAL_PARTS at most
        rows = rows[np.argsort(rows[:, 0])]
        above = np.searchsorted(rows[:, 0], rows[:, 1])
        own = np.arange(len(rows))
        above = np.where((above[above] == own) & (own < above), own, above)
        while (above[above] != above).any():
            above = above[above]
        return links.sparkSession.createDataFrame(pd.DataFrame({"part": rows[:, 0], "root": rows[above, 0]}), "part long, root long"), len(np.unique(above))
    back = links.select(F.col("part").alias("to"), F.col("to").alias("back"))
    links = stage(links.join(back, "to").select("part", F.when((F.col("back") == F.col("part")) & (F.col("part") < F.col("to")), F.col("part")).otherwise(F.col("to")).alias("root")), "links")
    while True:
        further = stage(links.join(links.select(F.col("part").alias("root"), F.col("root").alias("top")), "root").select("part", F.col("top").alias("root"), (F.col("top") != F.col("root")).alias("moved")), "links")
        if further.filter("moved").isEmpty():
            return further.select("part", "root"), further.filter("part = root").count()
        links = further.select("part", "root")


def spanning_tree(points: DataFrame, near: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Edges ``a`` < ``b`` with ``s``: a spanning tree of the largest sum of mutual reachability, in cosines: the least of the two's own and their cores.

    ``points`` have ``id``, ``core``, ``edge`` and ``v``; ``near`` is their neighbour table. What a list does not show has the cosine of its last
    entry at most: a part's way out is proved where it is at least as good as that for all of its points.
    """
    cores = points.select("id", "core")
    edges = near.select(F.col("id").alias("a"), F.col("related_id").alias("b"), "similarity")
    edges = edges.join(cores.select(F.col("id").alias("a"), F.col("core").alias("ca")), "a").join(cores.select(F.col("id").alias("b"), F.col("core").alias("cb")), "b")
    edges = edges.select("a", "b", F.least("similarity", "ca", "cb").alias("s"))
    edges = stage(edges.union(edges.select("b", "a", "s")).distinct(), "near-edges")
    now = stage(points.select("id", F.col("id").alias("part"), "core", F.least("edge", "core").alias("most"), "v"), "parts")
    number, tree = now.count(), []
    blocks = max(1, -(-number // block_rows))
    while number > 1:
        part_of = now.select("id", "part")
        joined = lambda e: e.join(part_of.select(F.col("id").alias("a"), F.col("part").alias("pa")), "a").join(part_of.select(F.col("id").alias("b"), F.col("part").alias("pb")), "b").filter("pa <> pb")  # noqa: B023, E731
        if number > LOCAL_PARTS:
            edges = stage(joined(edges).select("a", "b", "s"), "near-edges")  # what is inside a part is of no use any more
        pick = F.max(F.struct("s", (-F.least("a", "b")).alias("lo"), (-F.greatest("a", "b")).alias("hi"), "pb")).alias("e")
        best = joined(edges).groupBy("pa").agg(pick)
        # The largest part, of equally large ones the first, waits where it is open: the others' ways out are enough, and most points are in it when lists no longer lead out of it.
        largest = now.groupBy("part").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", (-F.col("part")).alias("p"))).alias("m")).select(-F.col("m.p")).first()[0]
        open_ = now.join(best.select(F.col("pa").alias("part"), F.col("e.s").alias("s")), "part", "left").filter("s IS NULL OR most > s")
        waits = not open_.filter(F.col("part") == largest).isEmpty()
        pairs = block_pairs(_pack(open_.filter(F.col("part") != largest), blocks), _pack(now, blocks), blocks)
        beyond = stage(pairs.applyInPandas(_ways_out, "a long, b long, s double"), "ways-out")
        # Of a point's ways out into all blocks the best is enough; a part's are compared with those of the lists.
        beyond = beyond.groupBy("a").agg(F.max(F.struct("s", (-F.col("b")).alias("nb"))).alias("e")).select("a", (-F.col("e.nb")).alias("b"), F.col("e.s").alias("s"))
        every = joined(edges.union(beyond).union(beyond.select("b", "a", "s")))
        if waits:
            every = every.filter(F.col("pa") != largest)
        chosen = stage(every.groupBy("pa").agg(pick).select(F.col("pa").alias("part"), F.col("e.pb").alias("to"), (-F.col("e.lo")).alias("a"), (-F.col("e.hi")).alias("b"), F.col("e.s").alias("s")), "chosen")
        tree.append(chosen.select("a", "b", "s").distinct())
        links = chosen.select("part", "to")
        if waits:
            links = links.union(points.sparkSession.createDataFrame([(largest, largest)], "part long, to long"))
        roots, number = _roots(links)
        now = stage(now.join(roots, "part").select("id", F.col("root").alias("part"), "core", "most", "v"), "parts")
    out = points.sparkSession.createDataFrame([], "a long, b long, s double")
    for some in tree:
        out = out.union(some)
    return out


#: What is known of a cluster while the tree is climbed: its rows, its label (-1 while it has too few rows for one), the sum of its rows'
#: densities so far, and the stability of the best choice among the clusters that ended in it.
_STATE = {"size": "long", "label": "long", "dense": "double", "below": "double"}
_STEP = "kind string, a long, b long, size long, dense double, below double, flag boolean"


def _climb(min_cluster: int, band: int):
    """Joins the clusters of a band, whose rows are edges with their length ``d`` and both sides' names and states.

    Gives ``label`` rows (a label that ended, the one it ended in, whether it is chosen before what is below it), ``fell`` rows (a small cluster and the label that
    it was part of), ``moved`` rows (a cluster and the one that it is now) and ``state`` rows.
    """

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        names, first = np.unique(np.concatenate([rows["x"], rows["y"]]), return_index=True)
        x, y = np.searchsorted(names, rows["x"]), np.searchsorted(names, rows["y"])
        size, label, dense, below = (np.concatenate([rows["x_" + f], rows["y_" + f]])[first].tolist() for f in _STATE)
        above, members, out, born = list(range(len(names))), [[i] for i in range(len(names))], [], 0

        def top(i: int) -> int:
            while above[i] != i:
                above[i] = above[above[i]]
                i = above[i]
            return i

        order = np.argsort(rows["d"].to_numpy(), kind="stable")
        lengths = rows["d"].to_numpy()[order]
        cuts = np.flatnonzero(np.diff(lengths, prepend=-1.0, append=np.inf))
        for begin, end in zip(cuts, cuts[1:], strict=False):  # edges of one length join at once
            joined: dict[int, list[int]] = {}
            for e in order[begin:end]:
                i, j = top(x[e]), top(y[e])
                if i == j:  # copies of one point
                    joined.setdefault(i, [i])
                    continue
                a, b = joined.pop(i, [i]), joined.pop(j, [j])
                small, large, sides = (i, j, b + a) if len(a) <= len(b) else (j, i, a + b)
                above[small] = large
                joined[large] = sides
            level = 1 / float(lengths[begin])
            for root, sides in joined.items():
                big, small = [i for i in sides if label[i] >= 0], [i for i in sides if label[i] < 0]
                total, found, sums, inner = sum(size[i] for i in sides), -1, 0.0, 0.0
                if len(big) == 1:
                    found, sums, inner = label[big[0]], dense[big[0]] + sum(size[i] for i in small) * level, below[big[0]]
                elif total >= min_cluster:  # a cluster is born, of small ones or of those that end here
                    found, sums, born = (band << 32) + born, total * level, born + 1
                    for i in big:
                        stable = dense[i] - size[i] * level
                        out.append(("label", label[i], found, size[i], stable, below[i], stable >= below[i]))
                        inner += max(stable, below[i])
                if found >= 0:
                    out += [("fell", names[m], found, 0, 0.0, 0.0, False) for i in small for m in members[i]]
                kept = [m for i in small for m in members[i]] if found < 0 else []
                size[root], label[root], dense[root], below[root], members[root] = total, found, sums, inner, kept
        for i in range(len(names)):
            t = top(i)
            out.append(("moved", names[i], names[t], 0, 0.0, 0.0, False))
            if t == i:
                out.append(("state", names[i], label[i], size[i], dense[i], below[i], False))
        return pd.DataFrame(out, columns=[f.split()[0] for f in _STEP.split(", ")])

    return run


def condense(points: DataFrame, tree: DataFrame, min_cluster: int, band_edges: int = BAND_EDGES) -> tuple[DataFrame, DataFrame]:
    """The condensed tree: ``label``, ``parent`` and ``chosen`` (more stable than the best choice below it), and the ``label`` that each point fell out of.

    ``points`` have ``id``, ``copies`` and ``core``, ``tree`` the edges ``a``, ``b`` and ``s``. The root has no row among the labels: it is no cluster.
    Points of a corpus without any cluster have no label.
    """
    copied = points.filter("copies > 1").select(F.col("id").alias("x"), F.col("id").alias("y"), _distance(F.col("core")).alias("d"))  # copies join at their core
    edges = stage(tree.select(F.col("a").alias("x"), F.col("b").alias("y"), _distance(F.col("s")).alias("d")).union(copied), "edges")
    number = edges.count()
    bands = max(1, -(-number // band_edges))
    cuts = sorted(set(edges.approxQuantile("d", [i / bands for i in range(1, bands)], 0.1 / bands))) if bands > 1 else []
    states = points.select(F.col("id").alias("node"), F.col("copies").alias("size"), F.lit(-1).cast("long").alias("label"), F.lit(0.0).alias("dense"), F.lit(0.0).alias("below"))
    where = points.select("id", F.col("id").alias("node"), F.lit(None).cast("long").alias("label"))
    labels = None
    for band, (low, high) in enumerate(zip([-1.0, *cuts], [*cuts, float("inf")], strict=True)):
        now = edges.filter((F.col("d") > low) & (F.col("d") <= high))
        for side in ("x", "y"):
            now = now.join(states.select(F.col("node").alias(side), *[F.col(f).alias(f"{side}_{f}") for f in _STATE]), side)
        steps = stage(now.withColumn("band", F.lit(band)).groupBy("band").applyInPandas(_climb(min_cluster, band), _STEP), "steps")
        ended = steps.filter("kind = 'label'").select(F.col("a").alias("label"), F.col("b").alias("parent"), F.col("flag").alias("chosen"))
        labels = ended if labels is None else labels.union(ended)
        fell = steps.filter("kind = 'fell'").select(F.col("a").alias("node"), F.col("b").alias("into"))
        moved = steps.filter("kind = 'moved'").select(F.col("a").alias("node"), F.col("b").alias("to"))
        where = where.join(fell, "node", "left").join(moved, "node", "left").select("id", F.coalesce("to", "node").alias("node"), F.coalesce("label", "into").alias("label"))
        if band < len(cuts):
            where = stage(where, "where")
            fresh = steps.filter("kind = 'state'").select(F.col("a").alias("node"), "size", F.col("b").alias("label"), "dense", "below")
            states = stage(states.join(moved, "node", "left_anti").union(fresh), "states")
            edges = edges.filter(F.col("d") > high)
            for side in ("x", "y"):
                edges = edges.join(moved.withColumnRenamed("node", side), side, "left").withColumn(side, F.coalesce("to", side)).drop("to")
            edges = stage(edges.select("x", "y", "d"), "edges")
    return labels, where.select("id", "label")


def _selected(labels: DataFrame) -> DataFrame:
    """``label`` and ``cluster``: the topmost chosen label on the way from a label to the root, by doubling the steps upwards."""
    rows = stage(labels.select("label", F.when(F.col("chosen"), F.col("label")).alias("cluster"), F.col("parent").alias("up")), "selected")
    while not rows.filter("up IS NOT NULL").isEmpty():
        higher = rows.select(F.col("label").alias("up"), F.col("cluster").alias("better"), F.col("up").alias("further"))
        rows = stage(rows.join(higher, "up", "left").select("label", F.coalesce("better", "cluster").alias("cluster"), F.col("further").alias("up")), "selected")
    return rows.filter("cluster IS NOT NULL").select("label", "cluster")


def reachability(df: DataFrame, id_col: str, vector: str, min_samples: int = 10, spare: int = 5, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Points with their cores, the spanning tree of mutual reachability, and which point's copy each row is (``id``, ``point``)."""
    rows = stage(points_of(df, id_col, vector), "points")
    near = stage(neighbours(rows, "id", "v", min_samples + spare, centred=False), "near").select("id", "related_id", "similarity", "rank")
    points = stage(core_similarity(rows, near, min_samples), "cores")
    own = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("raw")).join(rows.select("raw", F.col("id").alias("point")), "raw")
    return points, stage(spanning_tree(points, near, block_rows), "tree"), own.select("id", "point")


def tree_edges(df: DataFrame, id_col: str, vector: str, min_samples: int = 10) -> DataFrame:
    """The spanning tree's edges ``a``, ``b`` and their ``distance`` of mutual reachability; equal vectors are one point, under the smallest identifier."""
    _, tree, _ = reachability(df, id_col, vector, min_samples)
    return tree.select("a", "b", _distance(F.col("s")).alias("distance"))


def density_clusters(df: DataFrame, id_col: str, vector: str, min_cluster: int = 15, min_samples: int | None = None, band_edges: int = BAND_EDGES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``id_col`` and ``topic_id``: clusters from 0, the largest first, of equally large ones that with the smallest identifier; -1 for outliers.

    Clusters are those of the condensed tree with the largest excess of mass; the whole corpus is none. ``min_samples`` (as many as ``min_cluster`` if
    not given) neighbours, copies included, make up a row's core. Rows without an identifier or vector are outliers. Repeated rows count as
    copies; the result has a row for each.
    """
    if min_cluster < 2:
        raise ValueError("a cluster has two rows at least")
    points, tree, own = reachability(df, id_col, vector, min_samples or min_cluster, block_rows=block_rows)
    labels, fell = condense(points, tree, min_cluster, band_edges)
    found = stage(fell.join(_selected(labels), "label").select(F.col("id").alias("point"), "cluster"), "found")
    sizes = found.join(points.select(F.col("id").alias("point"), "copies"), "point").groupBy("cluster").agg(F.struct((-F.sum("copies")).alias("size"), F.min("point").alias("first")).alias("key"))
    names = sizes.join(numbered(sizes, "key", "topic_id"), "key").select("cluster", "topic_id")
    of = own.distinct().join(found, "point").join(names, "cluster").select(F.col("id").alias("__id"), F.col("topic_id").cast("long").alias("topic_id"))
    rows = df.select(F.col(id_col), F.col(id_col).cast("long").alias("__id"))
    return rows.join(of, "__id", "left").select(id_col, F.coalesce("topic_id", F.lit(NOISE).cast("long")).alias("topic_id"))
