"""Exact k nearest neighbours between two tables.

Distance is Euclidean over the coordinates both rows have, scaled by
(coordinates / shared coordinates); ties go to the smaller donor key.

How it stays exact without comparing every pair:

1. The donors are cut into cells by median splits learned on a bounded sample.
   The sample only shapes the cells. Each cell holds rows with the same missing
   coordinates and is summarised by its row count and bounding box. These cells are
   bounded in number; one that holds too many rows is cut again, by splits learned
   from its own rows, and the boxes of these inner cells are a table: a query meets
   those of a cell only when it has to search that cell.
2. Each query first searches the cells nearest to it that together hold k
   donors. The k-th distance found bounds the answer.
3. It then searches every other cell whose box is not farther than that bound.

A search ships query rows and donor rows to (cell, donor chunk, query chunk)
groups. Both chunk counts come from counted rows, so a crowded cell is spread
over many groups and no group outgrows its size. In step 3 a group is a pack of cells, so that a
query with many cells to search is sent once for a pack. A query that looks for donors of several
coordinates goes to a group once, with its targets; of coordinates that the same rows lack
one is looked for. A group returns only the k best
donors of each query and target within its bound, never its pairs, and their numbers
instead of their coordinates, which are joined to the final ones. Of donors with equal coordinates only the
k with the smallest keys can be an answer, so the others are left out first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.keyed_random import uniform
from riskframe.sources.tables import stored

CELL_ROWS = 2_048       # wanted donors per cell
MAX_CELLS = 4_096       # outer cells are summarised on the driver, so they are bounded
SAMPLE_ROWS = 32_768    # donors sampled to place the splits
CHUNK_ROWS = 16_384     # most rows of either side in one group
INNER_SAMPLE = 8        # donors sampled for each inner cell
MIXED = "mixed"         # the pattern of the rare patterns together
BLOCK_PAIRS = 262_144   # distances a task works out at once, so that they stay in a core's cache
EXACT_PAIRS = 262_144   # pairs whose distance is worked out exactly at once

# Executors get these helpers with the task, they need no copy of the package.
cloudpickle.register_pickle_by_value(__import__("sys").modules[__name__])


@dataclass(frozen=True)
class DonorIndex:
    """Donors with their cell, and the summary of the cells."""

    donors: DataFrame            # donor_id (number of the row), donor_key, x0.., cell, sub
    dims: int
    k: int
    splits: tuple                # per inner node: coordinate, value
    boxes: dict                  # arrays: name, mixed, has, all, n, lo, hi
    centre: tuple                # stands in for missing coordinates when placing a row
    inner: DataFrame | None = None   # cell, sub, n, lo, hi, all of the cells that are cut again
    masks: tuple | None = None       # the patterns of all donors; none if there are too many


def _xs(dims):
    return [f"x{i}" for i in range(dims)]


def _pattern(dims):
    """Which coordinates a row has, as a text of 0 and 1."""
    return F.concat(*(F.when(F.col(f"x{i}").isNotNull(), "1").otherwise("0") for i in range(dims)))


def build_index(df: DataFrame, key: str, cols: Sequence[str], k: int,
                cell_rows: int = CELL_ROWS, seed: int = 42) -> DonorIndex:
    """Cut the donor table into cells. ``key`` must identify a row."""
    dims = len(cols)
    if not dims:
        raise ValueError("at least one coordinate is needed")
    xs = _xs(dims)
    rows = df.select(F.col(key).alias("donor_key"),
                     *(_clean(F.col(c)).alias(x) for c, x in zip(cols, xs)))
    # written before it is filtered: what a filter on many derived columns implies for
    # each of them would be worked out at length by the optimizer
    rows = stored(rows.withColumn("mask", _pattern(dims)), "donor-rows")
    copies = Window.partitionBy(*xs).orderBy("donor_key")
    rows = rows.filter(F.contains("mask", F.lit("1"))).withColumn("copy", F.row_number().over(copies)) \
        .filter(F.col("copy") <= k).drop("copy")
    masked = stored(rows.withColumn("donor_id", F.monotonically_increasing_id()), "donors")
    rows = masked.drop("mask")
    common = masked.groupBy("mask").count().orderBy(F.desc("count"), "mask") \
        .limit(MAX_CELLS // 4 + 1).collect()
    total = sum(r["count"] for r in common)
    every = tuple(r["mask"] for r in common) if len(common) <= MAX_CELLS // 4 else None
    if len(common) > MAX_CELLS // 4:
        total, common = masked.count(), common[:-1]
    masks = [r["mask"] for r in common]
    # every leaf has a cell for each pattern, and one for the rare patterns together
    wanted = min(MAX_CELLS // (len(masks) + 1), max(1, total // cell_rows))
    depth = max(0, math.floor(math.log2(max(1, wanted))))
    sample = np.empty((0, dims))
    if depth:
        share = min(1.0, SAMPLE_ROWS / total)
        picked = rows.filter(uniform(seed, "sample", F.col("donor_key")) < share).select(*xs) \
            .limit(2 * SAMPLE_ROWS).toPandas()
        sample = picked.to_numpy(dtype="float64", na_value=np.nan)
    centre, splits = _place_splits(sample, depth, dims)
    # rows with rare patterns of missing coordinates share one cell per leaf
    pattern = F.when(F.col("mask").isin(masks), F.col("mask")).otherwise(MIXED)
    leaf = _leaf_of(splits, centre)(*(F.col(x) for x in xs)) if splits else F.lit(0)
    placed = masked.withColumn("pattern", pattern).withColumn("leaf", leaf)
    cells = placed.groupBy("pattern", "leaf").agg(
        F.count("*").alias("n"), *(F.min(x).alias(f"lo_{x}") for x in xs),
        *((F.count(x) == F.count("*")).alias(f"all_{x}") for x in xs),
        *(F.max(x).alias(f"hi_{x}") for x in xs)).collect()
    cells = sorted(cells, key=lambda r: (r["pattern"] != MIXED, r["pattern"], r["leaf"]))
    boxes = _boxes([f"{r['pattern']}:{r['leaf']}" for r in cells], [r["n"] for r in cells],
                   [[_nan(r[f"lo_{x}"]) for x in xs] for r in cells],
                   [[_nan(r[f"hi_{x}"]) for x in xs] for r in cells],
                   [[r[f"all_{x}"] for x in xs] for r in cells], dims)
    donors = placed.select("donor_id", "donor_key", *xs, F.concat_ws(":", "pattern", "leaf").alias("cell"))
    crowded = {name: int(n) for name, n in zip(boxes["name"], boxes["n"]) if n > 2 * cell_rows}
    if not crowded:
        return DonorIndex(donors.withColumn("sub", F.lit(0)), dims, k, splits, boxes, centre, None, every)
    donors, inner = _cut_again(donors, crowded, dims, cell_rows, centre, seed)
    return DonorIndex(donors, dims, k, splits, boxes, centre, inner, every)


def _cut_again(donors: DataFrame, crowded: dict, dims: int, cell_rows: int, centre, seed: int):
    """Donors with their inner cell, and the boxes of the inner cells as a table.

    A crowded cell's splits come from a keyed sample of its own rows. Its rows are placed
    in chunks, so that no task holds a cell.
    """
    spark, xs = donors.sparkSession, _xs(dims)
    shape = [(c, max(1, math.ceil(math.log2(n / cell_rows))), math.ceil(n / CHUNK_ROWS), n) for c, n in crowded.items()]
    small = F.broadcast(spark.createDataFrame(shape, "cell string, depth int, chunks int, held long"))  # MAX_CELLS rows
    mine = donors.join(small, "cell")
    share = F.least(F.lit(1.0), INNER_SAMPLE * F.pow(F.lit(2.0), "depth") / F.col("held"))
    sample = mine.filter(uniform(seed, "inner", F.col("donor_key")) < share).select("cell", "depth", "chunks", *xs)

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        found = _place_splits(part[xs].to_numpy(dtype="float64", na_value=np.nan), int(part["depth"].iloc[0]), dims, centre)[1]
        return pd.DataFrame({"cell": part["cell"].iloc[:1], "chunks": part["chunks"].iloc[:1],
                             "axis": [[int(a) for a, _ in found]], "cut": [[float(c) for _, c in found]]})
    learned = sample.groupBy("cell").applyInPandas(learn, "cell string, chunks int, axis array<int>, cut array<double>")
    plans = learned.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    dealt = mine.withColumn("chunk", F.pmod(F.xxhash64("donor_key"), F.col("chunks")).cast("int")) \
        .select("donor_id", "donor_key", *xs, "cell", "chunk")

    def place(rows: pd.DataFrame, plan: pd.DataFrame) -> pd.DataFrame:
        sub = np.zeros(len(rows), dtype="int32")
        if len(plan):
            x = rows[xs].to_numpy(dtype="float64", na_value=np.nan)
            sub = _leaves(x, np.asarray(plan["axis"].iloc[0]), np.asarray(plan["cut"].iloc[0]), np.array(centre))
        return rows[["donor_id", "donor_key", *xs, "cell"]].assign(sub=sub)
    layout = T.StructType([*donors.schema.fields, T.StructField("sub", T.IntegerType())])
    cut = dealt.groupBy("cell", "chunk").cogroup(plans.groupBy("cell", "chunk")).applyInPandas(place, layout)
    rest = donors.join(small.select("cell"), "cell", "left_anti").select(*donors.columns).withColumn("sub", F.lit(0))
    refined = stored(cut.unionByName(rest), "donor-cells")
    arrays = {"lo": F.min, "hi": F.max, "all": lambda x: F.count(x) == F.count("*")}
    inner = refined.join(small.select("cell"), "cell", "left_semi").groupBy("cell", "sub").agg(
        F.count("*").alias("n"), *(F.array(*(f(x) for x in xs)).alias(name) for name, f in arrays.items()))
    return refined, stored(inner, "inner-boxes")


def _boxes(names: Sequence[str], n, lo, hi, every, dims: int) -> dict:
    """Cells as arrays. ``has`` tells which coordinates a cell's pattern has."""
    patterns = [str(name).rsplit(":", 1)[0] for name in names]
    return {"name": np.array(names, dtype=object), "n": np.array(n, dtype="int64"),
            "mixed": np.array([p == MIXED for p in patterns], dtype=bool),
            "has": np.array([[p != MIXED and c == "1" for c in p.rjust(dims, "0")[:dims]] for p in patterns], dtype=bool).reshape(-1, dims),
            "lo": np.array(lo, dtype="float64").reshape(-1, dims), "hi": np.array(hi, dtype="float64").reshape(-1, dims),
            "all": np.array(every, dtype=bool).reshape(-1, dims)}


def _nan(value):
    return float("nan") if value is None else value


def _clean(c):
    c = c.cast("double")
    return F.when(~F.isnan(c), c)


def _place_splits(sample: np.ndarray, depth: int, dims: int, centre=None):
    """Median splits of the widest coordinate, level by level."""
    if not len(sample):
        return tuple([0.0] * dims), ()
    if centre is None:
        with np.errstate(all="ignore"):
            centre = [np.median(c[~np.isnan(c)]) if (~np.isnan(c)).any() else 0.0 for c in sample.T]
    centre = np.array(centre)
    full = np.where(np.isnan(sample), centre, sample)
    scale = full.std(axis=0)
    scale[scale == 0] = 1.0
    splits, parts = [], [full]
    for _ in range(depth):
        halves = []
        for part in parts:
            axis = int(np.argmax((part / scale).std(axis=0))) if len(part) else 0
            cut = float(np.median(part[:, axis])) if len(part) else 0.0
            if len(part) and cut == part[:, axis].min():    # most rows have the least value: part them from the others
                cut = float(part[:, axis].min(initial=np.inf, where=part[:, axis] > cut))
            splits.append((axis, cut))
            right = part[:, axis] >= cut
            halves += [part[~right], part[right]]
        parts = halves
    return tuple(float(c) for c in centre), tuple(splits)


def _leaf_of(splits, centre):
    axis = np.array([a for a, _ in splits])
    cut = np.array([c for _, c in splits])
    centre = np.array(centre)

    @F.pandas_udf("int")
    def leaf(*xs: pd.Series) -> pd.Series:
        rows = np.column_stack([x.to_numpy(dtype="float64", na_value=np.nan) for x in xs])
        return pd.Series(_leaves(rows, axis, cut, centre))
    return leaf


def _leaves(rows: np.ndarray, axis: np.ndarray, cut: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """The leaf each row falls into, going down the splits level by level."""
    rows = np.where(np.isnan(rows), centre, rows)
    at = np.zeros(len(rows), dtype="int64")
    for level in range(int(math.log2(len(axis) + 1))):
        node = (1 << level) - 1 + at
        at = 2 * at + (rows[np.arange(len(rows)), axis[node]] >= cut[node])
    return at.astype("int32")


def _box_distance(queries: np.ndarray, boxes: dict):
    """Smallest possible distance of each query to each cell; inf if they share no coordinate.

    In a cell of mixed patterns only the coordinates all its rows have count; its
    rows share at most as many coordinates with the query as the query has, which
    bounds the factor from below.
    """
    dims = queries.shape[1]
    acc = np.zeros((len(queries), len(boxes["n"])))
    shared = np.zeros_like(acc)
    mixed = boxes["mixed"]
    for i in range(dims):
        q = queries[:, i][:, None]
        gap = np.maximum(np.maximum(boxes["lo"][:, i] - q, q - boxes["hi"][:, i]), 0.0)
        both = ~np.isnan(gap) & (boxes["all"][:, i] | ~mixed)[None, :]
        acc += np.where(both, gap * gap, 0.0)
        shared += both
    with np.errstate(divide="ignore", invalid="ignore"):
        near = np.where(shared > 0, acc * (dims / shared), np.inf)
    own = np.maximum(1, (~np.isnan(queries)).sum(axis=1))
    near[:, mixed] = acc[:, mixed] * (dims / own)[:, None]
    return near


def _serving(near: np.ndarray, targets: np.ndarray, boxes: dict) -> np.ndarray:
    """The distances with inf where a cell has no donor of the target."""
    lacks = (targets >= 0)[:, None] & ~boxes["has"].T[np.maximum(targets, 0)]
    near[lacks & ~boxes["mixed"][None, :]] = np.inf
    return near


def _choose(near: np.ndarray, counts: np.ndarray, k: int):
    """Cells by distance: their order, which can serve the query, and which are home, the
    nearest that hold k rows by ``counts``."""
    order = np.argsort(near, axis=1, kind="stable")
    usable = np.isfinite(np.take_along_axis(near, order, 1))
    held = counts[order] * usable
    return order, usable, usable & (np.cumsum(held, axis=1) - held < k)


#: Most rows of (query, cell) that a task puts together at once.
VISITS_ONCE = 16_384
_ASKED = "targets array<int>, reach array<double>, home array<boolean>"


def _packs(boxes: dict) -> np.ndarray:
    """Cells in succession as packs of at most ``CHUNK_ROWS`` donors: the pack of each cell."""
    pack, filled, out = 0, 0, []
    for n in boxes["n"].tolist():
        if filled and filled + n > CHUNK_ROWS:
            pack, filled = pack + 1, 0
        filled += n
        out.append(pack)
    return np.array(out, dtype="int64")


def _visits(index: DonorIndex, first: bool, query_type: str):
    """Rows to send where: each query once per cell it has to search, with its targets there.

    First round: the nearest cells that surely hold k usable donors. Second
    round: the cells the bound (``reach``) does not rule out and that are not
    home, or that are home but were searched in part. Where boxes rule out little these are
    nearly all cells, so a query goes there once for a whole pack of them, and ``cells``
    names the cell of each target; cells that are cut again are no packs.
    """
    dims, k, boxes = index.dims, index.k, index.boxes
    xs = _xs(dims)
    again = index.inner is not None
    packed = not first and not again
    unit_of = _packs(boxes) if packed else np.arange(len(boxes["n"]))
    names = unit_of.astype(str).astype(object) if packed else boxes["name"]
    step = max(1, 500_000 // max(1, len(boxes["n"])))
    lists = ["targets", "reach", "home", *(["cells"] if packed else [])]

    def plan(batches):
        for batch in batches:
            for start in range(0, len(batch), step):
                part = batch.iloc[start:start + step]
                q = part[xs].to_numpy(dtype="float64", na_value=np.nan)
                asker = np.repeat(np.arange(len(part)), [len(t) for t in part["targets"]])
                target = np.concatenate(part["targets"].tolist()).astype("int64")
                near = _serving(_box_distance(q, boxes)[asker], target, boxes)
                order, usable, home = _choose(near, np.where(boxes["mixed"], 0, boxes["n"]), k)
                take = home
                reach = np.full(len(target), np.inf)
                if not first:
                    reach = np.concatenate(part["reach"].tolist()).astype("float64")
                    inside = usable & (np.take_along_axis(near, order, 1) <= reach[:, None])
                    take = inside if again else inside & ~home
                ask, col = np.nonzero(take)
                cell, home = order[ask, col], home[ask, col]
                by = np.lexsort((ask, cell, asker[ask]))
                ask, cell, home = ask[by], cell[by], home[by]
                of, unit = asker[ask], unit_of[cell]
                edge = np.flatnonzero(np.diff(of, prepend=-1) | np.diff(unit, prepend=-1))
                ends = np.append(edge[1:], len(ask))
                values = {"targets": target[ask].astype("int32"), "reach": reach[ask], "home": home, "cells": cell.astype("int32")}
                for at in range(0, len(edge), VISITS_ONCE):
                    a, b = edge[at:at + VISITS_ONCE], ends[at:at + VISITS_ONCE]
                    out = part.iloc[of[a]][["query_key", *xs]].reset_index(drop=True)
                    for name in lists:
                        out[name] = pd.Series([values[name][i:j] for i, j in zip(a.tolist(), b.tolist())], dtype=object)
                    out["cell"] = names[cell[a]]
                    yield out[["query_key", *xs, *lists, "cell"]]
    schema = f"query_key {query_type}, " + ", ".join(f"{x} double" for x in xs) + f", {_ASKED}" \
        + (", cells array<int>" if packed else "") + ", cell string"
    return plan, schema


def _inner_visits(index: DonorIndex, visits: DataFrame, first: bool) -> DataFrame:
    """Visits with the inner cells to search; cells that are not cut have the one.

    In the first round the nearest inner cells of a home cell that hold k rows, in the
    second those within reach that the first has not seen.
    """
    dims, k, xs = index.dims, index.k, _xs(index.dims)
    spark = visits.sparkSession
    visits = visits.withColumn("asked", F.explode(F.arrays_zip("targets", "reach", "home"))).select(
        "query_key", F.col("asked.targets").alias("target"), *xs, F.col("asked.reach").alias("reach"), "cell",
        F.col("asked.home").alias("home"))
    cells = index.inner.select("cell").distinct()                              # outer cells
    asked = visits.join(F.broadcast(cells), "cell", "left_semi").groupBy("cell").agg(
        F.ceil(F.count("*") / F.lit(CHUNK_ROWS)).cast("int").alias("chunks"))
    asked = F.broadcast(spark.createDataFrame(asked.collect(), asked.schema))  # at most MAX_CELLS rows
    dealt = visits.join(asked, "cell").withColumn("chunk", F.pmod(F.xxhash64("query_key"), F.col("chunks")).cast("int")) \
        .select(*visits.columns, "chunk")
    boxes = index.inner.join(asked, "cell").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))) \
        .drop("chunks")
    columns = ["query_key", "target", *xs, "reach", "cell"]

    def plan(queries: pd.DataFrame, subs: pd.DataFrame) -> pd.DataFrame:
        subs = subs.sort_values("sub", kind="stable")
        held = _boxes(subs["cell"].tolist(), subs["n"].tolist(), [[_nan(v) for v in r] for r in subs["lo"]],
                      [[_nan(v) for v in r] for r in subs["hi"]], subs["all"].tolist(), dims)
        number, found = subs["sub"].to_numpy(), []
        step = max(1, 4_000_000 // max(1, len(subs)))
        for start in range(0, len(queries), step):
            part = queries.iloc[start:start + step]
            q = part[xs].to_numpy(dtype="float64", na_value=np.nan)
            near = _serving(_box_distance(q, held), part["target"].to_numpy(), held)
            order, usable, nearest = _choose(near, held["n"], k)
            nearest &= part["home"].to_numpy(dtype=bool)[:, None]
            if first:
                take = nearest
            else:
                reach = part["reach"].to_numpy(dtype="float64", na_value=np.inf)
                take = usable & ~nearest & (np.take_along_axis(near, order, 1) <= reach[:, None])
            # a row for each query here, one for each of its inner cells after the task
            found.append(part[columns].assign(subs=[number[o[t]] for o, t in zip(order, take)]))
        return pd.concat(found) if found else pd.DataFrame({c: [] for c in [*columns, "subs"]})
    layout = T.StructType([*(visits.schema[c] for c in columns), T.StructField("subs", T.ArrayType(T.IntegerType()))])
    cut = dealt.groupBy("cell", "chunk").cogroup(boxes.groupBy("cell", "chunk")).applyInPandas(plan, layout) \
        .withColumn("sub", F.explode("subs")).drop("subs")
    rest = visits.join(F.broadcast(cells), "cell", "left_anti")
    if not first:
        rest = rest.where(~F.col("home"))
    return cut.unionByName(rest.select(*columns, F.lit(0).alias("sub"))).withColumns(
        {"targets": F.array("target"), "reach": F.array("reach")}).drop("target")


def _exact(q: np.ndarray, d: np.ndarray, row: np.ndarray, pos: np.ndarray) -> np.ndarray:
    """The scaled distances of pairs, summed coordinate by coordinate; inf if they share none."""
    dims = q.shape[1]
    near, shared = np.zeros(len(row)), np.zeros(len(row), dtype="int16")
    with np.errstate(all="ignore"):
        for i in range(dims):
            gap = q[row, i] - d[pos, i]
            both = ~np.isnan(gap)
            near += np.where(both, gap * gap, 0.0)
            shared += both
        return np.where(shared > 0, near * (dims / shared), np.inf)


def _near_blocks(q: np.ndarray, d: np.ndarray):
    """Blocks of query rows with their distances to all donors, and how far each row's may be off.

    The distances are products of matrices, so they are fast but not exact in the last digits.
    Coordinates too large for that, or infinite, are worked out exactly.
    """
    dims = q.shape[1]
    hq, hd = ~np.isnan(q), ~np.isnan(d)
    step = max(1, BLOCK_PAIRS // len(d))
    if max(np.abs(q[hq]).max(initial=0.0), np.abs(d[hd]).max(initial=0.0)) > 1e150:
        every = np.arange(len(d))
        for at in range(0, len(q), step):
            rows = np.arange(at, min(at + step, len(q)))
            near = _exact(q, d, np.repeat(rows, len(d)), np.tile(every, len(rows)))
            yield rows, near.reshape(len(rows), len(d)), np.zeros(len(rows))
        return
    centre = np.where(hd, d, 0.0).sum(0) / np.maximum(1, hd.sum(0))
    qz, dz = np.where(hq, q - centre, 0.0), np.where(hd, d - centre, 0.0)
    dd = dz * dz
    most, rounding = dd.sum(1).max(), 16 * (dims + 4) * np.finfo(float).eps
    alike = bool((hd == hd[0]).all())
    order = np.lexsort(np.packbits(hq, axis=1).T)    # rows that lack the same side by side
    right, of = None, None
    for at in range(0, len(q), step):
        rows = order[at:at + step]
        h, z = hq[rows], qz[rows]
        zz = z * z
        slack = rounding * (zz.sum(1) + most) + 1e-300
        if not alike:
            if right is None:
                right = np.concatenate([dz, hd, dd], axis=1).T
            near = np.concatenate([-2 * z, zz, h], axis=1) @ right
            shared = h.astype(float) @ hd.T.astype(float)
            near = np.where(shared > 0, near * (dims / np.maximum(shared, 1.0)), np.inf)
            yield rows, near, slack * dims
            continue
        both = h & hd[0]
        shared = both.sum(1)
        factor = dims / np.maximum(shared, 1)
        whole = (zz * both).sum(1)[:, None]
        if (h == h[0]).all():
            if of is None or (of != h[0]).any():
                of, use = h[0], np.flatnonzero(both[0])
                right = np.concatenate([dz[:, use], dd[:, use].sum(1)[:, None], np.ones((len(d), 1))], axis=1).T
            left = np.concatenate([-2 * z[:, use], np.ones((len(rows), 1)), whole], axis=1)
        else:
            of, right = None, np.concatenate([dz, dd, np.ones((len(d), 1))], axis=1).T
            left = np.concatenate([-2 * z, h, whole], axis=1)
        near = (left * factor[:, None]) @ right
        near[shared == 0] = np.inf
        yield rows, near, slack * factor


def _nearest(q: np.ndarray, d: np.ndarray, of: np.ndarray, target: np.ndarray, reach: np.ndarray, k: int):
    """The k best donors of each ask within its reach: ask, donor, distance, sorted by them.

    Ask i is query row ``of[i]`` (rising) for donors with ``target[i]``. Fast distances leave out
    the donors that cannot be among the k best; those of the others are worked out exactly.
    Of equal distances the first donors win.
    """
    has = ~np.isnan(d)
    full = has.all(0)
    first, last = (np.searchsorted(of, np.arange(len(q)), side) for side in ("left", "right"))
    held, done, waiting = [], [], 0

    def settle() -> None:
        ask, pos = (np.concatenate([h[i] for h in held]) for i in range(2))
        held.clear()
        dist = np.concatenate([_exact(q, d, of[ask[i:i + EXACT_PAIRS]], pos[i:i + EXACT_PAIRS])
                               for i in range(0, len(ask), EXACT_PAIRS)] or [np.zeros(0)])
        near = np.flatnonzero((dist <= reach[ask]) & np.isfinite(dist))
        near = near[np.lexsort((pos[near], dist[near], ask[near]))]
        ask = ask[near]
        best = np.arange(len(ask)) - np.searchsorted(ask, ask) < k
        done.append((ask[best], pos[near][best], dist[near][best]))

    for rows, near, slack in _near_blocks(q, d):
        count = last[rows] - first[rows]
        at = np.repeat(np.arange(len(rows)), count)
        asks = np.arange(len(at)) + np.repeat(first[rows] - np.cumsum(count) + count, count)
        wants = target[asks]
        for t in np.unique(wants):
            mine = wants == t
            ask, row = asks[mine], at[mine]
            cols = None if t < 0 or full[t] else np.flatnonzero(has[:, t])
            some = near if len(row) == len(rows) and (np.diff(row) == 1).all() else near[row]
            if cols is not None:
                some = some[:, cols]
            n = some.shape[1]
            far = reach[ask] + slack[row]
            keep = some <= far[:, None]
            if n >= 16 * k and np.count_nonzero(keep) > 4 * k * len(row):
                # the k-th smallest of the minima of parts is not below the k-th smallest of all
                parts = max(4 * k, n // 16)
                least = some[:, :n // parts * parts].reshape(len(row), n // parts, parts).min(1)
                kth = np.partition(least, k - 1, axis=1)[:, k - 1]
                keep = some <= np.minimum(far, kth + 2 * slack[row])[:, None]
            flat = np.flatnonzero(keep)
            row = flat // max(1, n)
            pos = flat - row * n
            held.append((ask[row], pos if cols is None else cols[pos]))
            waiting += len(flat)
        if waiting >= EXACT_PAIRS:
            settle()
            waiting = 0
    if held:
        settle()
    ask, pos, dist = (np.concatenate([f[i] for f in done]) for i in range(3))
    by = np.argsort(ask, kind="stable")
    return ask[by], pos[by], dist[by]


def _best_donors(k: int, dims: int, lead: np.ndarray):
    """The k best donors of each query and target within one group, none beyond its reach.

    Targets with one ``lead`` have the same donors, which are looked for and returned once.
    """
    xs = _xs(dims)

    def best(queries, donors):
        donors = donors.sort_values("donor_key", kind="stable")
        q, d = (np.ascontiguousarray(side[xs].to_numpy(dtype="float64", na_value=np.nan)) for side in (queries, donors))
        of = np.repeat(np.arange(len(queries)), [len(t) for t in queries["targets"]])
        target = np.concatenate(queries["targets"].tolist()).astype("int64")
        target = np.where(target < 0, -1, lead[target])
        reach = np.concatenate(queries["reach"].tolist()).astype("float64")
        packed = "cells" in queries.columns
        cell = np.concatenate(queries["cells"].tolist()).astype("int64") if packed else np.zeros(len(of), "int64")
        lies = donors["at"].to_numpy() if packed else np.zeros(len(d), "int64")
        # one ask for a query, lead and cell
        by = np.lexsort((target, of, cell))
        new = np.ones(len(by), bool)
        new[1:] = (np.diff(cell[by]) != 0) | (np.diff(of[by]) != 0) | (np.diff(target[by]) != 0)
        of, target, reach, cell = (x[by[new]] for x in (of, target, reach, cell))
        parts = []
        for c in np.unique(cell):
            asks, held = slice(*np.searchsorted(cell, [c, c + 1])), np.flatnonzero(lies == c)
            if not len(held):
                continue
            some, row = np.unique(of[asks], return_inverse=True)
            ask, pos, dist = _nearest(q[some], d[held], row, target[asks], reach[asks], k)
            parts.append((of[asks][ask], target[asks][ask], held[pos], dist))
        row, target, pos, dist = (np.concatenate([p[i] for p in parts] or [np.zeros(0, "int64")]) for i in range(4))
        if len(parts) > 1:
            by = np.lexsort((pos, dist, target, row))
            row, target, pos, dist = (x[by] for x in (row, target, pos, dist))
            ask = row * (dims + 1) + target + 1
            keep = np.arange(len(ask)) - np.searchsorted(ask, ask) < k
            row, target, pos, dist = (x[keep] for x in (row, target, pos, dist))
        return pd.DataFrame({"query_key": queries["query_key"].to_numpy()[row], "target": target,
                             "donor_key": donors["donor_key"].to_numpy()[pos], "dist2": dist,
                             "donor_id": donors["donor_id"].to_numpy()[pos]})

    def search(queries: pd.DataFrame, donors: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(donors):
            return pd.DataFrame({c: [] for c in ["query_key", "target", "donor_key", "dist2", "donor_id"]})
        return best(queries, donors)
    return search


def _chunked_outer(donors: DataFrame, held: dict, visits: DataFrame):
    """Both sides with their chunks, and how many groups; the cells are bounded in number."""
    asked = visits.groupBy("cell").count().collect()
    shape = {r["cell"]: (math.ceil(held[r["cell"]] / CHUNK_ROWS), math.ceil(r["count"] / CHUNK_ROWS)) for r in asked}
    groups = sum(d * q for d, q in shape.values())
    if all(s == (1, 1) for s in shape.values()):
        one = {"dc": F.lit(0), "qc": F.lit(0)}
        return visits.withColumns(one), donors.withColumns(one), groups
    rows = [(c, 0, d, q) for c, (d, q) in shape.items()]
    plan = F.broadcast(visits.sparkSession.createDataFrame(rows, "cell string, sub int, ndc int, nqc int"))
    return *_dealt(visits, donors, plan), groups


def _in_packs(index: DonorIndex):
    """The donors with their pack as cell and their cell's number, and the rows of the packs."""
    packs = _packs(index.boxes)
    rows = [(str(name), str(p), i) for i, (name, p) in enumerate(zip(index.boxes["name"], packs.tolist()))]
    plan = F.broadcast(index.donors.sparkSession.createDataFrame(rows, "cell string, pack string, at int"))   # MAX_CELLS rows
    donors = index.donors.join(plan, "cell").drop("cell").withColumnRenamed("pack", "cell")
    return donors, {str(p): int(n) for p, n in enumerate(np.bincount(packs, index.boxes["n"]))}


def _chunked(visits: DataFrame, donors: DataFrame):
    """The same for inner cells, whose number grows with the donors: their sizes are a table."""
    rows = [F.ceil(F.count("*") / F.lit(CHUNK_ROWS)).cast("int").alias(n) for n in ("nqc", "ndc")]
    plan = stored(visits.groupBy("cell", "sub").agg(rows[0]).join(
        donors.groupBy("cell", "sub").agg(rows[1]), ["cell", "sub"]), "inner-chunks")
    groups = plan.agg(F.sum(F.col("ndc") * F.col("nqc")).alias("n")).first()["n"] or 0
    return *_dealt(visits, donors, plan), groups


def _dealt(visits: DataFrame, donors: DataFrame, plan: DataFrame):
    cell = ["cell", "sub"]
    sent = (visits.join(plan, cell)
            .withColumn("qc", F.pmod(F.xxhash64("query_key"), F.col("nqc")).cast("int"))
            .withColumn("dc", F.explode(F.sequence(F.lit(0), F.col("ndc") - 1))).drop("ndc", "nqc"))
    held = (donors.join(plan, cell)
            .withColumn("dc", F.pmod(F.xxhash64("donor_key"), F.col("ndc")).cast("int"))
            .withColumn("qc", F.explode(F.sequence(F.lit(0), F.col("nqc") - 1))).drop("ndc", "nqc"))
    return sent, held


def _round(index: DonorIndex, queries: DataFrame, first: bool, lead: np.ndarray) -> DataFrame:
    k = index.k
    query_type = queries.schema["query_key"].dataType
    donor_type = index.donors.schema["donor_key"].dataType
    plan, schema = _visits(index, first, query_type.simpleString())
    visits = stored(queries.mapInPandas(plan, schema), "visits" if first else "pack-visits" if index.inner is None else "visits-again")
    if index.inner is not None:
        visits = stored(_inner_visits(index, visits, first), "inner-visits")
        sent, donors, groups = _chunked(visits, index.donors)
    else:
        donors, held = (index.donors, dict(zip(index.boxes["name"], index.boxes["n"].tolist()))) if first else _in_packs(index)
        sent, donors, groups = _chunked_outer(donors, held, visits.drop("home").withColumn("sub", F.lit(0)))
    out = T.StructType([T.StructField("query_key", query_type),
                        T.StructField("target", T.IntegerType()),
                        T.StructField("donor_key", donor_type),
                        T.StructField("dist2", T.DoubleType()),
                        T.StructField("donor_id", T.LongType())])
    search = _best_donors(k, index.dims, lead)
    # the work of a group is far larger than its bytes, so the groups are not
    # packed by size: one task each, or a few where there are many
    cores = queries.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(groups, max(4 * cores, groups // 8)))
    group = ["cell", "sub", "dc", "qc"]
    sent, donors = sent.repartition(parts, *group), donors.repartition(parts, *group)
    return (sent.groupBy(*group).cogroup(donors.groupBy(*group))
            .applyInPandas(lambda q, d: search(q, d), out))


def _top(found: DataFrame, k: int, drop_self: bool = False) -> DataFrame:
    if drop_self:
        found = found.filter(F.col("donor_key") != F.col("query_key"))
    order = Window.partitionBy("query_key", "target").orderBy("dist2", "donor_key")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _leads(index: DonorIndex, queries: DataFrame) -> list[int]:
    """For each coordinate the first that the same donors have and the same queries look for.

    Both have the same neighbours. Where patterns are too many to compare, each is its own.
    """
    wanted = queries.select("targets").distinct().limit(MAX_CELLS // 4 + 1).collect() if index.masks else []
    if not index.masks or len(wanted) > MAX_CELLS // 4:
        return list(range(index.dims))
    sets = [set(r["targets"]) for r in wanted]
    seen: dict = {}
    return [seen.setdefault((tuple(m[i] for m in index.masks), tuple(i in s for s in sets)), i) for i in range(index.dims)]


def knn(index: DonorIndex, df: DataFrame, key: str, cols: Sequence[str],
        target: str | None = None, drop_self: bool = False) -> DataFrame:
    """The nearest donors of each row of ``df``.

    ``target`` names a column holding the position of a coordinate the donor must have, -1 for
    none, or an array of positions to look for one by one; of an array those with the same
    donors come once. With ``drop_self`` a row is not its own
    neighbour; the index must then be built with one more neighbour than wanted.

    Result: query_key, target, rank from 1, donor_key, dist2 (squared
    distance) and the donor's coordinates dx0, dx1, ...; for an array also ``targets``, the
    positions a line stands for if its query looks for them.
    """
    xs = _xs(index.dims)
    several = target is not None and isinstance(df.schema[target].dataType, T.ArrayType)
    asked = F.col(target).cast("array<int>") if several else F.array((F.col(target) if target else F.lit(-1)).cast("int"))
    queries = df.select(F.col(key).alias("query_key"), asked.alias("targets"),
                        *(_clean(F.col(c)).alias(x) for c, x in zip(cols, xs)))
    lead = _leads(index, queries) if several else list(range(index.dims))
    led = queries
    if several:
        first = F.array(*(F.lit(i) for i in lead))
        led = queries.withColumn("targets", F.array_distinct(F.transform(
            "targets", lambda t: F.when(t < 0, t).otherwise(F.get(first, t)))))
    want = index.k - 1 if drop_self else index.k
    found = _round(index, queries if index.inner is None else led, True, np.array(lead))
    if len(index.boxes["n"]) > 1 or index.inner is not None:
        found = stored(found, "near")
        bound = _top(found, index.k).groupBy("query_key", "target").agg(
            F.max("dist2").alias("far"), F.count("*").alias("n")).filter(F.col("n") >= index.k)
        bound = bound.groupBy("query_key").agg(F.map_from_entries(F.collect_list(F.struct("target", "far"))).alias("far"))
        reach = led.join(bound, "query_key", "left").withColumn("reach", F.transform(
            "targets", lambda t: F.coalesce(F.element_at("far", t), F.lit(float("inf"))))).drop("far")
        found = found.unionByName(_round(index, reach, False, np.array(lead)))
    coords = index.donors.select("donor_id", *(F.col(x).alias(f"d{x}") for x in xs))
    near = _top(found, want, drop_self).join(coords, "donor_id").drop("donor_id")
    if several:
        alike = F.array(*(F.array(*(F.lit(j) for j, l in enumerate(lead) if l == i)).cast("array<int>") for i in range(index.dims)))
        near = near.withColumn("targets", F.get(alike, F.col("target")))
    return near
