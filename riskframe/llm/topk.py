"""Exact top-k inner products by a dual-tree search over cover trees.

Candidates and queries are each routed to the nearest of a few hundred centres, the
top level of the tree, so that a node is the rows of one centre in one block of
bounded size. Each query group first searches the nodes with the largest bounds,
which gives every query a kth score; a node is then paired with a group only if
its bound, from centres and covering radii, reaches the group's worst kth score.
Within a pair the search goes on down both blocks' cover trees in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.sources.tables import stored

#: Rows the centres are taken from, and the most centres: bounded whatever the table.
SAMPLE, CENTRES = 20_000, 128
#: Queries go to the first few of the centres, which cover the space more coarsely: every
#: group is sent to the nodes it may match, so fewer groups mean fewer copies of a node.
GROUPS = 16
#: Aimed-at rows of one node's block; a centre with more rows has several.
BLOCK = 4_096
#: Rows of a leaf of the trees within a block.
LEAF = 64
#: Nodes each query group searches first.
FIRST = 3


def whole_vectors(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """(id, vec) with every component x as floor(scale * x); unusable vectors left out.

    Left out are nulls and vectors with null or non-finite components. Shorter
    vectors count as padded with zeros.
    """
    x = F.col(f"`{vector}`")
    usable = x.isNotNull() & F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    whole = F.transform(x, lambda c: F.floor(c.cast("double") * scale).cast("double"))
    return df.where(F.coalesce(usable, F.lit(False)) & F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").alias("id"), whole.alias("vec"))


def _matrix(vectors, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width))
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def choose_centres(sample: np.ndarray, most: int) -> np.ndarray:
    """Centres by farthest-first traversal, as the levels of a cover tree are chosen."""
    if not len(sample):
        return sample
    chosen, far = [0], np.linalg.norm(sample - sample[0], axis=1)
    while len(chosen) < min(most, len(sample)) and far.max() > 0:
        chosen.append(int(far.argmax()))
        far = np.minimum(far, np.linalg.norm(sample - sample[chosen[-1]], axis=1))
    return sample[chosen]


class CoverTree:
    """Nested balls over the rows of one block: (centre, radius, rows, children)."""

    def __init__(self, points: np.ndarray):
        self.points, self.order = points, np.arange(len(points))
        self.nodes: list[tuple[np.ndarray, float, int, int, tuple[int, ...]]] = []
        self.root = self._build(0, len(points))

    def _build(self, start: int, end: int) -> int:
        rows = self.order[start:end]
        own = self.points[rows]
        centre = own[0]
        away = np.linalg.norm(own - centre, axis=1)
        radius, children = float(away.max()), ()
        if end - start > LEAF and radius > 0:
            other = own[int(away.argmax())]  # the farthest row opens the other ball
            nearer = np.linalg.norm(own - other, axis=1) < away
            self.order[start:end] = np.concatenate([rows[~nearer], rows[nearer]])
            middle = end - int(nearer.sum())
            children = (self._build(start, middle), self._build(middle, end))
        self.nodes.append((centre, radius, start, end, children))
        return len(self.nodes) - 1


def score_bound(a: np.ndarray, ra: float, b: np.ndarray, rb: float) -> float:
    """No inner product of a point within ra of a and one within rb of b is larger."""
    na, nb = float(np.linalg.norm(a)), float(np.linalg.norm(b))
    return float(a @ b) + ra * nb + rb * na + ra * rb + 1e-6 * (na + ra) * (nb + rb) + 1e-6


class Best:
    """The k best of each query so far, ties to the smaller id."""

    def __init__(self, query_ids: np.ndarray, k: int, floor: np.ndarray):
        self.ids, self.k, self.floor = query_ids, k, floor
        self.found: list[list[tuple[float, int]]] = [[] for _ in query_ids]

    def worst(self, rows: np.ndarray) -> float:
        return float(self.floor[rows].min())

    def add(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        for at, row in enumerate(rows):
            good = np.flatnonzero((scores[at] >= self.floor[row]) & (ids != self.ids[row]))
            if len(good) > self.k:  # keep all that tie with the kth
                kth = np.partition(scores[at, good], len(good) - self.k)[len(good) - self.k]
                good = good[scores[at, good] >= kth]
            if len(good):
                own = self.found[row] + [(-float(scores[at, g]), int(ids[g])) for g in good]
                own = sorted(own)[:self.k]
                self.found[row] = own
                if len(own) == self.k:
                    self.floor[row] = max(self.floor[row], -own[-1][0])


def search_pair(queries: CoverTree, data: CoverTree, data_ids: np.ndarray, best: Best) -> None:
    """Walk both trees, largest bound first at each split; prune what cannot reach the
    worst kth score of the query node."""
    def bound(q: int, d: int) -> float:
        a, b = queries.nodes[q], data.nodes[d]
        return score_bound(a[0], a[1], b[0], b[1])

    todo = [(queries.root, data.root)]
    while todo:
        q, d = todo.pop()
        qn, dn = queries.nodes[q], data.nodes[d]
        rows = queries.order[qn[2]:qn[3]]
        if bound(q, d) < best.worst(rows):
            continue
        if not qn[4] and not dn[4]:
            own = data.order[dn[2]:dn[3]]
            best.add(rows, queries.points[rows] @ data.points[own].T, data_ids[own])
        else:
            split_query = bool(qn[4]) and (not dn[4] or qn[1] > dn[1])
            pairs = [(c, d) for c in qn[4]] if split_query else [(q, c) for c in dn[4]]
            todo += sorted(pairs, key=lambda p: bound(*p))


def top_inner_products(queries: DataFrame, data: DataFrame, key: str, vector: str, k: int = 5,
                       scale: int = 256) -> DataFrame:
    """(query_id, rank, id, score): each query's k largest integer inner products.

    Ties go to the smaller id, a row is no candidate for its own id, and queries
    with fewer than k candidates return them all. Ids must be whole numbers; rows
    with a null id or an unusable vector take no part. Of repeated ids the row with
    the smallest vector, compared component by component, stays; the others take no
    part, as queries and as candidates. Scores must stay below 2**53.
    """
    spark = data.sparkSession
    points, asked = (stored(whole_vectors(df, key, vector, scale).groupBy("id").agg(F.min("vec").alias("vec")), name)
                     for df, name in ((data, "topk-points"), (queries, "topk-asked")))
    shape = points.agg(F.max(F.size("vec")).alias("w"), F.count("*").alias("n")).first()
    asked_shape = asked.agg(F.max(F.size("vec")).alias("w"), F.count("*").alias("n")).first()
    out = "query_id long, rank int, id long, score long"
    if not shape["n"] or not asked_shape["n"]:
        return spark.createDataFrame([], out)
    width = max(shape["w"], asked_shape["w"], 1)
    sample = points.orderBy(F.xxhash64("id"), "id").limit(SAMPLE if shape["n"] > SAMPLE else shape["n"])
    centres = choose_centres(_matrix([r["vec"] for r in sample.select("vec").collect()], width), CENTRES)

    def routed(own: np.ndarray):
        def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                x = _matrix(b["vec"], width)
                d2 = (own * own).sum(1)[None, :] - 2 * x @ own.T
                near = d2.argmin(1) if len(x) else np.zeros(0, int)
                away = np.linalg.norm(x - own[near], axis=1)
                yield pd.DataFrame({"id": b["id"], "vec": list(x), "centre": near.astype("int32"),
                                    "away": away})
        return route

    layout = "id long, vec array<double>, centre int, away double"

    def nodes(df: DataFrame, kind: str, most: int) -> DataFrame:
        sizes = stored(df.mapInPandas(routed(centres[:most]), layout), f"topk-{kind}")
        blocks = sizes.groupBy("centre").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("int").alias("_blocks"))
        return sizes.join(F.broadcast(blocks), "centre").withColumn(  # one row per centre
            "block", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int")).drop("_blocks")

    held, groups = nodes(points, "data", CENTRES), nodes(asked, "queries", GROUPS)
    held_sums = held.groupBy("centre", "block").agg(F.max("away").alias("radius"))
    group_sums = groups.groupBy("centre", "block").agg(F.max("away").alias("radius"))
    bounds = _bounds(spark, group_sums, held_sums, centres)
    first_rank = Window.partitionBy("q_centre", "q_block").orderBy(F.desc("bound"), "d_centre", "d_block")
    ranked = stored(bounds.withColumn("_nth", F.row_number().over(first_rank)), "topk-bounds")
    empty = groups.select(F.col("centre").alias("q_centre"), F.col("block").alias("q_block"), "id",
                          F.lit(float("-inf")).alias("floor"))
    begun = stored(_searched(ranked.where(F.col("_nth") <= FIRST), groups, held, empty, k, width), "topk-first")
    kth = (_kept(begun, k).groupBy("query_id").agg(F.min("score").alias("kth"), F.count("*").alias("n"))
           .select(F.col("query_id").alias("_q"), F.when(F.col("n") == k, F.col("kth").cast("double")).alias("_kth")))
    floors = stored(empty.join(kth, F.col("id") == F.col("_q"), "left").select(
        "q_centre", "q_block", "id", F.coalesce("_kth", "floor").alias("floor")), "topk-floors")
    worst = floors.groupBy("q_centre", "q_block").agg(F.min("floor").alias("worst"))
    rest = (ranked.where(F.col("_nth") > FIRST).join(worst, ["q_centre", "q_block"])
            .where(F.col("bound") >= F.col("worst")))
    more = _searched(rest, groups, held, floors, k, width)
    return _kept(begun.unionByName(more), k)


def _kept(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))


def _bounds(spark, groups: DataFrame, held: DataFrame, centres: np.ndarray) -> DataFrame:
    """Every (query group, node) pair's bound. Groups and nodes are summaries of blocks;
    the groups are dealt out and each meets the nodes of one centre at a time."""
    by_centre = held.groupBy(F.col("centre").alias("d_centre")).agg(
        F.collect_list(F.struct("block", "radius")).alias("nodes"))

    def bound(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for c, blk, r, dc, ns in zip(b["centre"], b["block"], b["radius"], b["d_centre"], b["nodes"]):
                rows += [(c, blk, dc, n["block"], score_bound(centres[c], r, centres[dc], n["radius"])) for n in ns]
            yield pd.DataFrame(rows, columns=["q_centre", "q_block", "d_centre", "d_block", "bound"])

    every = F.explode(F.sequence(F.lit(0), F.lit(len(centres) - 1))).alias("d_centre")
    return groups.select("*", every).join(by_centre, "d_centre").mapInPandas(
        bound, "q_centre int, q_block int, d_centre int, d_block int, bound double")


def _searched(pairs: DataFrame, groups: DataFrame, held: DataFrame, floors: DataFrame, k: int,
              width: int) -> DataFrame:
    """The k best of every pair of a query group and a node. Both sides are blocks of
    bounded size, so a task holds one block of each at a time."""
    packed = F.collect_list(F.struct("id", "vec")).alias("rows")
    limits = floors.groupBy("q_centre", "q_block").agg(F.collect_list(F.struct("id", "floor")).alias("floors"))
    left = (groups.groupBy(F.col("centre").alias("q_centre"), F.col("block").alias("q_block"))
            .agg(packed).withColumnRenamed("rows", "q_rows").join(limits, ["q_centre", "q_block"]))
    right = (held.groupBy(F.col("centre").alias("d_centre"), F.col("block").alias("d_block"))
             .agg(packed).withColumnRenamed("rows", "d_rows"))
    met = pairs.select("q_centre", "q_block", "d_centre", "d_block").join(
        left, ["q_centre", "q_block"]).join(right.hint("merge"), ["d_centre", "d_block"])  # blocks of all data: never broadcast

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for q_rows, floors, d_rows in zip(b["q_rows"], b["floors"], b["d_rows"]):
                ids = np.array([r["id"] for r in q_rows], np.int64)
                low = {r["id"]: r["floor"] for r in floors}
                d_ids = np.array([r["id"] for r in d_rows], np.int64)
                best = Best(ids, k, np.array([low[i] for i in ids.tolist()]))
                search_pair(CoverTree(_matrix([r["vec"] for r in q_rows], width)),
                            CoverTree(_matrix([r["vec"] for r in d_rows], width)), d_ids, best)
                rows += [(int(q), i, int(-s)) for q, own in zip(ids, best.found) for s, i in own]
            yield pd.DataFrame(rows, columns=["query_id", "id", "score"]).astype("int64")

    return met.select("q_rows", "floors", "d_rows").mapInPandas(search, "query_id long, id long, score long")
