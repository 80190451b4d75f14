"""Spark ML's forests and boosted trees for tables of many rows with few different ones.

A row takes part in a tree through its bin codes, label and weight alone. Rows of equal ones
are a cell, and a cell needs only the number of its rows each tree draws: one pass over the
rows counts them for all trees, and the trees grow over the cells. Splits, stopping, merged
leaves and votes are those of Spark ML, and the result is its model. The draws are not its
own: rows are drawn by a hash of (seed, tree, row) and features by (seed, tree, level), so a
seed gives one model under any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import (GBTClassificationModel, GBTClassifier, RandomForestClassificationModel,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.operators.boosting import COUNTS, ROWS_EACH, _coded, _each, _read, partitions_for, quantile_cuts
from riskframe.sources.tables import scratch_path, stored

#: Trees of a forest that grow in one task.
TREES_EACH = 8


@dataclass(frozen=True)
class TreeParams:
    """``drawn`` holds the chances that a tree draws a row at most 0, 1, 2... times. ``take``
    features are drawn for each node; ``rate`` is the step of boosting, none for a forest."""

    trees: int
    depth: int
    least: int
    gain: float
    take: int
    drawn: tuple[float, ...]
    bins: int
    seed: int
    rate: float | None = None


def params_of(classifier, width: int) -> TreeParams | None:
    """The settings of a Spark ML classifier, none if it has one that is not known here."""
    forest = isinstance(classifier, RandomForestClassifier)
    if not forest and not isinstance(classifier, GBTClassifier):
        return None
    share = classifier.getSubsamplingRate()
    takes = {"all": width, "sqrt": math.ceil(math.sqrt(width)), "auto": math.ceil(math.sqrt(width)) if forest else width}
    take = takes.get(classifier.getFeatureSubsetStrategy())
    trees = classifier.getNumTrees() if forest else classifier.getMaxIter()
    plain = classifier.getMinWeightFractionPerNode() == 0 and classifier.getImpurity() == ("gini" if forest else "variance")
    odd = [] if forest else [classifier.validationIndicatorCol]
    if (not plain or not take or not 1 <= classifier.getMaxDepth() <= 12 or not 2 <= classifier.getMaxBins() <= 254
            or classifier.isDefined(classifier.thresholds) or any(map(classifier.isDefined, odd))):
        return None
    if forest and classifier.getBootstrap():
        chances = np.cumsum([math.exp(-share) * share ** k / math.factorial(k) for k in range(24)])
        drawn = tuple(float(x) for x in chances if x < 1.0 - 1e-15)
    else:
        drawn = (1.0 - share,) if share < 1.0 else ()
    return TreeParams(trees, classifier.getMaxDepth(), classifier.getMinInstancesPerNode(), classifier.getMinInfoGain(),
                      take, drawn, classifier.getMaxBins(), classifier.getSeed(),
                      None if forest else classifier.getStepSize())


def cuts_of(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """Rising cuts for each feature: between all its values if these are at most ``bins``, else at even quantiles."""
    about = df.agg(*(F.approx_count_distinct(c) for c in features)).first()
    few = [c for c, n in zip(features, about) if n <= 2 * bins]
    values = df.agg(*(F.sort_array(F.collect_set(c)).alias(c) for c in few)).first() if few else {}
    exact = {c: [(a + b) / 2 for a, b in zip(values[c], values[c][1:])] for c in few if len(values[c]) <= bins}
    rest = [c for c in features if c not in exact]
    exact.update(zip(rest, quantile_cuts(df, rest, bins) if rest else []))
    return [exact[c] for c in features]


def times_drawn(draws: np.ndarray, tree: int, p: TreeParams) -> np.ndarray:
    """How often a tree draws each row, by a mix of its hash with (seed, tree)."""
    out = np.zeros(len(draws), np.uint8)
    if not p.drawn:
        return out + np.uint8(1)
    with np.errstate(over="ignore"):
        x = draws + np.uint64(p.seed % 2 ** 32 * 2_654_435_761 + tree + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    steps = np.array([int(c * 2.0 ** 64) for c in p.drawn], np.uint64)
    for step in steps[:4]:
        out += x >= step
    if len(steps) > 4:
        rare = np.flatnonzero(out == 4)
        out[rare] = np.searchsorted(steps, x[rare], side="right")
    return out


_COUNTED = "part int, codes binary, label binary, weight binary, times binary"


def _counted(coded: DataFrame, width: int, parts: int, p: TreeParams) -> DataFrame:
    """The cells with the rows of each that every tree draws, a few trees to a row. Rows of a
    cell of many rows are dealt to several tasks, and what these count is added up later."""
    cell, each = ["codes", "label", "weight"], max(1, ROWS_EACH // 4)
    large = coded.groupBy(*cell).agg(F.ceil(F.count("*") / each).alias("tasks")).where("tasks > 1")
    dealt = coded.join(F.broadcast(large), cell, "left").withColumn(  # one row for each ROWS_EACH / 4 at most
        "task", F.when(F.col("tasks").isNull(), 0).otherwise(F.pmod("draw", "tasks")))
    together = p.trees if p.rate is not None else TREES_EACH

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [_read(batch, width) for batch in batches if batch.num_rows]
        if not held:
            return
        draws, codes, label, weight = (np.concatenate(c) for c in zip(*held))
        whole = _whole(codes, label, weight)
        _, number = np.unique(whole, return_inverse=True)
        order = np.lexsort((draws, number))
        draws, number = draws[order], number[order]
        # alike rows of one hash draw apart, each by its place among them
        new = np.r_[True, (draws[1:] != draws[:-1]) | (number[1:] != number[:-1])]
        place = np.arange(len(draws)) - np.maximum.accumulate(np.where(new, np.arange(len(draws)), 0))
        draws = draws + place.astype(np.uint64) * np.uint64(0xD1342543DE82EF95)
        starts = np.flatnonzero(np.r_[True, number[1:] != number[:-1]])
        one = order[starts]
        for part, first in enumerate(range(0, p.trees, together)):
            lines = range(first, min(first + together, p.trees))
            times = np.stack([np.add.reduceat(times_drawn(draws, t, p), starts, dtype=np.uint32) for t in lines])
            columns = [codes[one], label[one].astype(float), weight[one].astype(float), times]
            yield pa.record_batch([pa.array([part], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                                  names=["part", "codes", "label", "weight", "times"])
    return dealt.repartition(parts, *cell, "task").select("draw", *cell).mapInArrow(gather, _COUNTED)


def _whole(codes: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    joined = np.concatenate([codes, *(x.astype(float).view(np.uint8).reshape(-1, 8) for x in (label, weight))], axis=1)
    return np.ascontiguousarray(joined).view(f"V{joined.shape[1]}").ravel()


@dataclass
class Grown:
    """A tree as arrays over heap positions, the root at 0: ``stats`` are rows drawn, then the
    sums that Spark ML keeps; ``feature`` is below 0 where a node is a leaf."""

    feature: np.ndarray
    cut: np.ndarray
    gain: np.ndarray
    stats: np.ndarray
    node: np.ndarray


def impurity(sums: np.ndarray, forest: bool) -> tuple[np.ndarray, np.ndarray]:
    """Weight and impurity of sums [weights of both classes] or [weight, sum, sum of squares]."""
    with np.errstate(divide="ignore", invalid="ignore"):
        if forest:
            total = sums[0] + sums[1]
            return total, 1.0 - (sums[0] / total) ** 2 - (sums[1] / total) ** 2
        return sums[0], (sums[2] - sums[1] * sums[1] / sums[0]) / sums[0]


def grow(codes: np.ndarray, stats: np.ndarray, tree: int, p: TreeParams) -> Grown:
    """One tree over cells with their ``stats``. Of equal gains the first feature, then the lowest cut."""
    forest, width, bins, size = p.rate is None, codes.shape[1], p.bins, (2 << p.depth) - 1
    grown = Grown(np.full(size, -1, np.int32), np.zeros(size, np.int32), np.full(size, -1.0), np.zeros((len(stats), size)),
                  np.zeros(len(codes), np.int64))
    grown.stats[:, 0] = stats.sum(1)
    live, rows = np.array([0]), np.arange(len(codes))
    for level in range(p.depth):
        first, place = (1 << level) - 1, np.full(size, -1)
        place[live] = np.arange(len(live))
        rows = rows[place[grown.node[rows]] >= 0]
        at = place[grown.node[rows]]
        if p.take < width:
            chosen = np.random.default_rng([p.seed % 2 ** 32, tree, level]).random((1 << level, width)).argsort(1)
            chosen = np.sort(chosen[live - first, :p.take], axis=1)
        else:
            chosen = np.tile(np.arange(width), (len(live), 1))
        left, own = np.empty((len(stats), len(live), p.take, bins)), stats[:, rows]
        for j in range(p.take):
            cell = at * bins + codes[rows, chosen[at, j]]
            for i, x in enumerate(own):
                left[i, :, j] = np.bincount(cell, x, len(live) * bins).reshape(len(live), bins)
        left = left.cumsum(3)
        total = grown.stats[:, live][:, :, None, None]
        right = total - left
        (w, all_), (wl, il), (wr, ir) = (impurity(x[1:], forest) for x in (total, left, right))
        with np.errstate(divide="ignore", invalid="ignore"):
            gain = all_ - wl / w * il - wr / w * ir
        able = (left[0] >= p.least) & (right[0] >= p.least) & (gain >= p.gain)
        gain = np.where(able, gain, -np.inf).reshape(len(live), -1)
        best = gain.argmax(1)
        most = gain[np.arange(len(live)), best]
        splits = most > 0
        node = live[splits]
        if not len(node):
            break
        grown.feature[node] = chosen[splits, best[splits] // bins]
        grown.cut[node], grown.gain[node] = best[splits] % bins, most[splits]
        rows = rows[grown.feature[grown.node[rows]] >= 0]
        held = grown.node[rows]
        grown.node[rows] = 2 * held + 1 + (codes[rows, grown.feature[held]] > grown.cut[held])
        children = np.concatenate([2 * node + 1, 2 * node + 2])
        for i, x in enumerate(stats):
            grown.stats[i, children] = np.bincount(grown.node[rows], x[rows], size)[children]
        live = np.sort(children[impurity(grown.stats[1:, children], forest)[1] > 1e-15])
        if not len(live):
            break
    return grown


def predictions(grown: Grown, forest: bool) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return (grown.stats[2] > grown.stats[1]) * 1.0 if forest else grown.stats[2] / grown.stats[1]


def records(grown: Grown, tree: int, cuts: Sequence[Sequence[float]], forest: bool) -> list[dict]:
    """The nodes in order of a walk from the root, numbered. Two leaves of one prediction are one, as in Spark ML."""
    told, worth = predictions(grown, forest), impurity(grown.stats[1:], forest)[1]
    feature = grown.feature.copy()
    for node in np.flatnonzero(feature >= 0)[::-1].tolist():
        low, high = 2 * node + 1, 2 * node + 2
        if feature[low] < 0 and feature[high] < 0 and told[low] == told[high]:
            feature[node] = -1
    out: list[dict] = []

    def walk(node: int) -> int:
        inner = feature[node] >= 0
        me = {"treeID": tree, "id": len(out), "prediction": float(told[node]), "impurity": float(worth[node]),
              "impurityStats": grown.stats[1:, node].tolist(), "rawCount": int(grown.stats[0, node]),
              "gain": float(grown.gain[node]) if inner else -1.0, "leftChild": -1, "rightChild": -1,
              "featureIndex": int(feature[node]) if inner else -1,
              "threshold": [float(cuts[feature[node]][grown.cut[node]])] if inner else []}
        out.append(me)
        if inner:
            me["leftChild"], me["rightChild"] = walk(2 * node + 1), walk(2 * node + 2)
        return me["id"]
    walk(0)
    return out


_NODES = ("treeID int, id int, prediction double, impurity double, impurityStats array<double>, rawCount long, gain double, "
          "leftChild int, rightChild int, featureIndex int, threshold array<double>")


def _trees(counted: DataFrame, width: int, cuts: Sequence[Sequence[float]], p: TreeParams) -> DataFrame:
    """The nodes of all trees. A forest's trees grow a few to a task, a boosted model's in one."""
    forest = p.rate is None
    together = TREES_EACH if forest else p.trees

    def tables(rows: list[dict]) -> tuple[np.ndarray, ...]:
        """All cells of some trees, in an order of their own."""
        label, weight = (np.concatenate([np.frombuffer(r[c]) for r in rows]) for c in ("label", "weight"))
        codes = np.concatenate([np.frombuffer(r["codes"], np.uint8).reshape(-1, width) for r in rows])
        times = np.concatenate([np.frombuffer(r["times"], np.uint32).reshape(-1, len(r["label"]) // 8) for r in rows], axis=1)
        _, one, number = np.unique(_whole(codes, label, weight), return_index=True, return_inverse=True)
        times = np.stack([np.bincount(number, t, len(one)) for t in times])
        return codes[one], label[one], weight[one], times

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[dict]] = {}
        for row in _each(batches):
            held.setdefault(row["part"], []).append(row)
        for part in sorted(held):
            codes, label, weight, times = tables(held.pop(part))
            margin, sign = np.zeros(len(label)), 2.0 * label - 1.0
            for i, n in enumerate(times):
                tree, w = part * together + i, weight * n
                if forest:
                    grown = grow(codes, np.stack([n, w * (1.0 - label), w * label]), tree, p)
                else:
                    target = sign if i == 0 else 4.0 * sign / (1.0 + np.exp(2.0 * sign * margin))
                    grown = grow(codes, np.stack([n, w, w * target, w * target * target]), tree, p)
                    margin = margin + (1.0 if i == 0 else p.rate) * predictions(grown, forest)[grown.node]
                nodes = records(grown, tree, cuts, forest)
                yield pa.RecordBatch.from_pylist(nodes, schema=_arrow())
    parts = -(-p.trees // together)
    return counted.repartition(parts, "part").mapInArrow(run, _NODES)


def _arrow() -> pa.Schema:
    some = {"treeID": pa.int32(), "id": pa.int32(), "prediction": pa.float64(), "impurity": pa.float64(),
            "impurityStats": pa.list_(pa.float64()), "rawCount": pa.int64(), "gain": pa.float64(), "leftChild": pa.int32(),
            "rightChild": pa.int32(), "featureIndex": pa.int32(), "threshold": pa.list_(pa.float64())}
    return pa.schema(list(some.items()))


def fit_cells(classifier, rows: DataFrame, told_by: Sequence[str]):
    """Spark ML's model of ``classifier`` for rows with assembled features, grown over cells; none if the
    rows have too many cells, labels that are not both 0 and 1, or settings that are not known here.
    Draws hash the columns ``told_by``, which should tell rows apart: the key and the inputs as given."""
    label, weight = classifier.getLabelCol(), classifier.getWeightCol() if classifier.isDefined("weightCol") else None
    examples = [rows.where(F.col(label) == y).select(label, *([weight] if weight else []), classifier.getFeaturesCol())
                .limit(1) for y in (0, 1)]
    first = [e.first() for e in examples]
    if not all(first):
        return None
    width = first[0][classifier.getFeaturesCol()].size
    p = params_of(classifier, width)
    if p is None:
        return None
    names = [f"f{i}" for i in range(width)]
    flat = rows.select(F.xxhash64(*told_by).alias("_row"), F.col(label).cast("double").alias("_label"),
                       (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("_weight"),
                       vector_to_array(classifier.getFeaturesCol()).alias("_x"))
    flat = stored(flat.select("_row", "_label", "_weight", *(F.col("_x")[i].alias(n) for i, n in enumerate(names))), "cells-rows")
    seen = flat.agg(F.count("*").alias("n"), F.count_if(~F.coalesce(
        F.col("_label").isin(0.0, 1.0) & (F.col("_weight") > 0) & (F.col("_weight") < math.inf), F.lit(False))).alias("odd")).first()
    if seen["odd"]:
        return None
    cuts = cuts_of(flat, names, p.bins)
    coded = stored(_coded(flat, names, "_label", "_weight", "_row", cuts), "cells-codes")
    different = coded.agg(F.approx_count_distinct(F.struct("codes", "label", "weight"))).first()[0]
    if different > min(ROWS_EACH, COUNTS // p.trees):
        return None
    counted = stored(_counted(coded, width, partitions_for(seen["n"]), p), "cells-counts")
    return _as_model(classifier, rows.sparkSession.createDataFrame(first, examples[0].schema), _trees(counted, width, cuts, p))


def _as_model(classifier, two: DataFrame, nodes: DataFrame):
    """A Spark ML model with these nodes: one fitted to two rows is saved, and its nodes are replaced."""
    kind = RandomForestClassificationModel if isinstance(classifier, RandomForestClassifier) else GBTClassificationModel
    base = scratch_path(two.sparkSession, "cells-model")
    classifier.fit(two).write().save(base)
    split = F.struct("featureIndex", F.col("threshold").alias("leftCategoriesOrThreshold"), F.lit(-1).alias("numCategories"))
    node = F.struct("id", "prediction", "impurity", "impurityStats", "rawCount", "gain", "leftChild", "rightChild",
                    split.alias("split"))
    nodes.select("treeID", node.alias("nodeData")).write.mode("overwrite").parquet(f"{base}/data")
    return kind.load(base)
