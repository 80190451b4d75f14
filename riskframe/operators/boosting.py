"""Second-order boosted trees with leaf and split penalties.

Every round fits one tree to the gradients and hessians of the weighted logistic loss.
Features are cut into quantile bins once; a level of the tree needs one aggregate, the
sums of gradients and hessians by (node, feature, bin). From these sums come the split
gains, less ``gamma``, and the leaf weights, soft-thresholded by ``l1`` and shrunk by ``l2``.

The sums are whole numbers (gradients in fixed point), so they do not depend on the
order or the number of partitions: a table gives the same model on any cluster. Rows of
a round are drawn by a hash of (seed, round, key), features per tree by the seed.

A row's gradient follows from its bin codes, label and weight alone. Where a large table
has few different ones, its cells, the rows of a cell that each round draws are counted in
one pass, and the rounds need the cells and these counts instead of the rows.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.functions.columns import known
from riskframe.sources.tables import stored

#: Training rows of one partition.
ROWS_EACH = 200_000
#: Rows of one block of codes, and rounds after which the rows' margins are written anew.
BLOCK, KEEP = 65_536, 5
#: Counts of drawn rows, by cell and round, that one task holds.
COUNTS = 60_000_000
MISSING = 255


@dataclass(frozen=True)
class BoostingParams:
    """``rows`` and ``columns`` are the shares drawn for each tree; a split must gain at least
    ``gamma`` and leave at least ``least_hessian`` on both sides."""

    rounds: int = 300
    depth: int = 4
    rate: float = 0.05
    rows: float = 0.8
    columns: float = 0.8
    gamma: float = 1.0
    l1: float = 0.5
    l2: float = 1.0
    least_hessian: float = 1.0
    bins: int = 64
    seed: int = 42

    def __post_init__(self):
        if not 1 <= self.depth <= 12 or not 2 <= self.bins <= 254 or self.rounds < 0:
            raise ValueError("depth must be 1 to 12, bins 2 to 254, rounds 0 or more")


def soft(g, l1: float):
    """A gradient sum pulled towards 0 by the L1 penalty."""
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0.0)


class Tree:
    """A binary tree as arrays over heap positions, the root at 1. A row goes right if its
    bin is above ``cut``; a missing value goes where ``missing_right`` says."""

    def __init__(self, depth: int):
        size = 2 << depth
        self.depth = depth
        self.feature = np.full(size, -1, np.int32)
        self.cut = np.zeros(size, np.int32)
        self.missing_right = np.zeros(size, bool)
        self.gain = np.zeros(size)
        self.g, self.h = np.zeros(size), np.zeros(size)
        self.exists = np.zeros(size, bool)
        self.exists[1] = True

    def route(self, codes: np.ndarray) -> np.ndarray:
        """Each row's node, as far down as the tree goes."""
        node = np.ones(len(codes), np.int32)
        row = np.arange(len(codes))
        for _ in range(self.depth):
            feature = self.feature[node]
            inner = feature >= 0
            if not inner.any():
                break
            code = codes[row, np.where(inner, feature, 0)]
            right = np.where(code == MISSING, self.missing_right[node], code > self.cut[node])
            node = np.where(inner, 2 * node + right, node).astype(np.int32)
        return node

    def values(self, p: BoostingParams) -> np.ndarray:
        """The step each leaf adds to a margin."""
        return np.where(self.exists & (self.feature < 0), -p.rate * soft(self.g, p.l1) / (self.h + p.l2), 0.0)

    def split(self, level: int, sums: np.ndarray, columns: Sequence[int], scale: float, p: BoostingParams) -> None:
        """Split the nodes of a level. ``sums`` is [g or h, node, column, bin], the last bin
        that of missing values. Of equal gains the first column, then the lowest cut, then
        missing values to the right."""
        first = 1 << level
        g, h = sums / scale
        for node in range(first, 2 * first):
            if not self.exists[node]:
                continue
            at = node - first
            if level == 0:
                self.g[node], self.h[node] = g[at, 0].sum(), h[at, 0].sum()
            total_g, total_h = self.g[node], self.h[node]
            left_g, left_h = g[at, :, :-1].cumsum(1), h[at, :, :-1].cumsum(1)
            both_g = np.stack([left_g, left_g + g[at, :, -1:]], -1)
            both_h = np.stack([left_h, left_h + h[at, :, -1:]], -1)
            rest_g, rest_h = total_g - both_g, total_h - both_h

            def worth(a, b):
                return soft(a, p.l1) ** 2 / (b + p.l2)
            gain = worth(both_g, both_h) + worth(rest_g, rest_h) - worth(total_g, total_h)
            able = (both_h >= p.least_hessian) & (rest_h >= p.least_hessian)
            gain = np.where(able, gain, -np.inf)
            best = int(gain.argmax())
            column, cut, side = np.unravel_index(best, gain.shape)
            if not gain.flat[best] >= max(p.gamma, 1e-6):
                continue
            self.feature[node], self.cut[node] = columns[column], cut
            self.missing_right[node], self.gain[node] = side == 0, gain.flat[best]
            for child, cg, ch in ((2 * node, both_g, both_h), (2 * node + 1, rest_g, rest_h)):
                self.exists[child], self.g[child], self.h[child] = True, cg.flat[best], ch.flat[best]


@dataclass
class Block:
    """Some training rows in memory, with the margins they have so far; or some cells with
    ``times``, the rows each round draws of each (one line if every round draws all)."""

    draws: np.ndarray
    codes: np.ndarray
    label: np.ndarray
    weight: np.ndarray
    margin: np.ndarray
    times: np.ndarray | None = None
    round: int = -1

    def advance(self, trees: Sequence[Tree], p: BoostingParams) -> None:
        for tree in trees:
            self.margin = self.margin + tree.values(p)[tree.route(self.codes)]

    def measure(self, round_: int, tree: Tree, level: int, columns: Sequence[int], scale: float,
                p: BoostingParams) -> np.ndarray:
        """The sums of the level's nodes over this block's rows, in fixed point."""
        if self.round != round_:
            self.round = round_
            chance = 1.0 / (1.0 + np.exp(-self.margin))
            self.g = np.rint(self.weight * (chance - self.label) * scale)
            self.h = np.rint(self.weight * chance * (1.0 - chance) * scale)
            if self.times is None:
                drawn = _drawn(self.draws, round_, p)
                self.g, self.h = np.where(drawn, self.g, 0.0), np.where(drawn, self.h, 0.0)
            else:
                times = self.times[round_ % len(self.times)].astype(np.int64)
                self.g, self.h = self.g.astype(np.int64) * times, self.h.astype(np.int64) * times
        first, bins = 1 << level, p.bins + 1
        node = tree.route(self.codes) - first
        rows = np.flatnonzero((node >= 0) & tree.exists[node + first] & (self.h + np.abs(self.g) > 0))
        node, g, h = node[rows], self.g[rows], self.h[rows]
        out = np.zeros((2, first, len(columns), bins), np.int64)
        for i, c in enumerate(columns):
            code = self.codes[rows, c]
            cell = node * bins + np.where(code == MISSING, bins - 1, code)
            for j, x in enumerate((g, h)):
                out[j, :, i] = _totals(cell, x, first * bins).reshape(first, bins)
        return out


def _totals(cell: np.ndarray, x: np.ndarray, cells: int) -> np.ndarray:
    """Sums of whole numbers by cell. Those of many rows together may be too large for a
    sum of doubles to be exact, so their halves are summed."""
    if x.dtype != np.int64:
        return np.bincount(cell, x, cells).astype(np.int64)
    low, high = (np.bincount(cell, half, cells).astype(np.int64) for half in (x & 0x7FFFFFFF, x >> 31))
    return low + (high << 31)


def _drawn(draws: np.ndarray, round_: int, p: BoostingParams) -> np.ndarray:
    """Which rows a round uses: a mix of each row's hash with (seed, round) against the share."""
    if p.rows >= 1.0:
        return np.ones(len(draws), bool)
    with np.errstate(over="ignore"):
        x = draws + np.uint64(p.seed % 2 ** 32 * 2_654_435_761 + round_ + 1) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) * 2.0 ** -53 < p.rows


def grow(measure: Callable[..., np.ndarray], n_features: int, scale: float, p: BoostingParams,
         after: Callable[[list[Tree]], None] = lambda trees: None) -> list[Tree]:
    """The trees of all rounds. ``measure(trees, tree, level, columns)`` gives a level's sums over
    all rows, wherever they are; ``after`` is told of every finished tree."""
    trees: list[Tree] = []
    take = max(1, round(p.columns * n_features))
    for round_ in range(p.rounds):
        columns = sorted(np.random.default_rng([p.seed, round_]).permutation(n_features)[:take].tolist())
        tree = Tree(p.depth)
        for level in range(p.depth):
            if tree.exists[1 << level:2 << level].any():
                tree.split(level, measure(trees, tree, level, columns), columns, scale, p)
        trees.append(tree)
        after(trees)
    return trees


def nodes_of(trees: Sequence[Tree], cuts: Sequence[Sequence[float]], p: BoostingParams) -> list[dict]:
    """One record per node: tree, node (heap position), feature and threshold (none for a
    leaf), whether missing values go right, gain, hessian sum, step. A split that parts
    known from missing values has an infinite threshold."""
    bounds = [[*own, math.inf] for own in cuts]
    out = []
    for t, tree in enumerate(trees):
        values = tree.values(p)
        for node in np.flatnonzero(tree.exists).tolist():
            feature = int(tree.feature[node])
            inner = feature >= 0
            out.append({"tree": t, "node": node, "feature": feature if inner else None,
                        "threshold": float(bounds[feature][min(tree.cut[node], len(cuts[feature]))]) if inner else None,
                        "missing_right": bool(tree.missing_right[node]) if inner else None,
                        "gain": float(tree.gain[node]), "hessian": float(tree.h[node]),
                        "step": None if inner else float(values[node])})
    return out


def quantile_cuts(df: DataFrame, features: Sequence[str], bins: int) -> list[list[float]]:
    """At most bins - 1 rising cuts for each feature, values of the table at even quantiles,
    all features in one aggregate. A row's bin is the number of cuts below its value, so
    a cut at the largest value would part nothing and is left out."""
    probs = [i / bins for i in range(1, bins)]
    row = df.agg(*(F.struct(F.percentile_approx(known(df, c).cast("double"), probs, 10_000).alias("q"),
                            F.max(known(df, c).cast("double")).alias("most")).alias(f"c{i}")
                   for i, c in enumerate(features))).first()
    return [sorted({x for x in row[i]["q"] or [] if x < row[i]["most"]}) for i in range(len(features))]


def partitions_for(rows: int) -> int:
    """Partitions for a training table: by its counted rows alone, never by cores."""
    return max(1, -(-rows // ROWS_EACH))


_LAYOUT = "draws binary, codes binary, label binary, weight binary, margin binary, times binary"


def _pack(block: Block) -> pa.RecordBatch:
    times = np.zeros(0, np.uint16) if block.times is None else block.times
    columns = [block.draws, block.codes, block.label, block.weight, block.margin, times]
    return pa.record_batch([*(pa.array([c.tobytes()], pa.binary()) for c in columns)],
                           names=["draws", "codes", "label", "weight", "margin", "times"])


def _blocks(rows: Iterable, n_features: int, p: BoostingParams) -> Iterator[Block]:
    for r in rows:
        label, times = np.frombuffer(r["label"]), None
        if r["times"]:
            lines = p.rounds if p.rows < 1.0 else 1
            kind = np.uint16 if len(r["times"]) == 2 * lines * len(label) else np.uint32
            times = np.frombuffer(r["times"], kind).reshape(lines, -1)
        yield Block(np.frombuffer(r["draws"], np.uint64), np.frombuffer(r["codes"], np.uint8).reshape(-1, n_features),
                    label, np.frombuffer(r["weight"]), np.frombuffer(r["margin"]), times)


def _each(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of Arrow batches one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _coded(rows: DataFrame, features: Sequence[str], label: str, weight: str | None, key: str,
           cuts: Sequence[Sequence[float]]) -> DataFrame:
    """(draw, codes, label, weight) of every row, a byte of ``codes`` for each feature."""
    own = rows.select(F.xxhash64(key).alias("draw"), F.col(label).cast("double").alias("label"),
                      (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight"),
                      *(known(rows, c).cast("double").alias(f"f{i}") for i, c in enumerate(features)))

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.empty((batch.num_rows, len(cuts)), np.uint8)
            for i, own_cuts in enumerate(cuts):
                x = batch.column(3 + i).to_numpy(zero_copy_only=False).astype(float)
                codes[:, i] = np.where(np.isnan(x), MISSING, np.searchsorted(own_cuts, x))
            packed = pa.array(codes.view(f"V{len(cuts)}").ravel().tolist(), pa.binary())
            yield pa.record_batch([batch.column(0), packed, batch.column(1), batch.column(2)],
                                  names=["draw", "codes", "label", "weight"])
    return own.mapInArrow(code, "draw long, codes binary, label double, weight double")


def _read(batch: pa.RecordBatch, width: int) -> list[np.ndarray]:
    codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, width)
    return [batch.column(0).to_numpy().view(np.uint64), codes, batch.column(2).to_numpy(), batch.column(3).to_numpy()]


def _row_blocks(coded: DataFrame, width: int, parts: int) -> DataFrame:
    """The rows as blocks."""
    def block(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                draws, codes, label, weight = _read(batch.slice(at, BLOCK), width)
                yield _pack(Block(draws, codes, label, weight, np.zeros(len(label))))
    return coded.repartition(parts, "draw").mapInArrow(block, _LAYOUT)


def _cell_blocks(coded: DataFrame, width: int, parts: int, p: BoostingParams) -> DataFrame:
    """The cells as blocks. Rows of a cell of many rows are dealt to several tasks; what
    these count stays apart, as sums over all blocks are all the rounds need."""
    cell, each = ["codes", "label", "weight"], max(1, ROWS_EACH // 4)
    large = coded.groupBy(*cell).agg(F.ceil(F.count("*") / each).alias("tasks")).where("tasks > 1")
    dealt = coded.join(F.broadcast(large), cell, "left").withColumn(  # one row for each ROWS_EACH / 4 at most
        "task", F.when(F.col("tasks").isNull(), 0).otherwise(F.pmod("draw", "tasks")))

    def count(held: list[list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        draws, codes, label, weight = (np.concatenate(c) for c in zip(*held))
        whole = np.concatenate([codes, *(x.astype(float).view(np.uint8).reshape(-1, 8) for x in (label, weight))], axis=1)
        _, one, number = np.unique(whole.view(f"V{whole.shape[1]}").ravel(), return_index=True, return_inverse=True)
        lines = range(p.rounds) if p.rows < 1.0 else range(1)
        times = np.stack([np.bincount(number[_drawn(draws, r, p)], minlength=len(one)) for r in lines])
        step = max(1, min(BLOCK, COUNTS // 4 // len(lines)))
        for at in range(0, len(one), step):
            some, part = one[at:at + step], times[:, at:at + step]
            part = part.astype(np.uint16 if part.max(initial=0) < 65_536 else np.uint32)
            yield _pack(Block(draws[:0], codes[some], label[some], weight[some], np.zeros(len(some)), part))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        for batch in batches:
            held.append(_read(batch, width))
            if sum(len(h[0]) for h in held) >= ROWS_EACH:
                yield from count(held)
                held = []
        if held:
            yield from count(held)
    return dealt.repartition(parts, *cell, "task").select("draw", *cell).mapInArrow(gather, _LAYOUT)


@dataclass(frozen=True)
class BoostedTrees:
    """Fitted trees: ``nodes`` as of :func:`nodes_of`, features by position in ``features``."""

    features: tuple[str, ...]
    params: BoostingParams
    nodes: tuple[dict, ...]

    def to_json(self) -> str:
        return json.dumps({"features": self.features, "params": asdict(self.params), "nodes": self.nodes})

    @staticmethod
    def from_json(text: str) -> BoostedTrees:
        read = json.loads(text)
        return BoostedTrees(tuple(read["features"]), BoostingParams(**read["params"]), tuple(read["nodes"]))


def fit_boosted(train: DataFrame, features: Sequence[str], label: str, key: str, weight: str | None = None,
                params: BoostingParams | None = None, partitions: int | None = None) -> BoostedTrees:
    """Fit boosted trees on numeric ``features`` with missing values as they are.

    Rows with a null key, label (0 or 1) or weight, or a weight of 0 or less, take no part.
    ``partitions`` follows the counted rows (``ROWS_EACH``). The rows are stored once as
    blocks of bin codes, those of more than one partition as cells if these are few enough.
    What is one partition, or cells, lies in one task and the rounds run inside it; else
    each level is one job over all blocks, and the margins are written every ``KEEP``
    rounds. All give the same trees.
    """
    p = params or BoostingParams()
    spark = train.sparkSession
    usable = F.col(key).isNotNull() & F.col(label).isNotNull()
    if weight:
        usable = usable & (known(train, weight) > 0)
    used = list(dict.fromkeys([key, *features, label, *([weight] if weight else [])]))
    rows = stored(train.where(usable).select(*used), "boosting-rows")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    size = rows.agg(F.count("*").alias("n"), F.sum(w).alias("total"), F.max(w).alias("most")).first()
    if not size["n"] or not features or not p.rounds:
        return BoostedTrees(tuple(features), p, ())
    cuts = quantile_cuts(rows, features, p.bins)
    parts = partitions or partitions_for(size["n"])
    scale = 2.0 ** math.floor(min(30, 61 - math.log2(size["total"] + 1), 52 - math.log2(BLOCK * size["most"] + 1)))
    width = len(features)
    coded = _coded(rows, features, label, weight, key, cuts)
    cells = False
    if parts > 1:
        coded = stored(coded, "boosting-codes")
        different = coded.agg(F.approx_count_distinct(F.struct("codes", "label", "weight"))).first()[0]
        cells = different <= min(ROWS_EACH, COUNTS // (p.rounds if p.rows < 1.0 else 1))
    blocks = _cell_blocks(coded, width, parts, p) if cells else _row_blocks(coded, width, parts)
    blocks = stored(blocks.coalesce(parts), "boosting-blocks")
    if parts == 1 or cells:
        def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = list(_blocks(_each(batches), width, p))

            def measure(trees: list[Tree], tree: Tree, level: int, columns: list[int]) -> np.ndarray:
                if level == 0:
                    for block in held:
                        block.advance(trees[-1:], p)
                return sum(block.measure(len(trees), tree, level, columns, scale, p) for block in held)
            trees = grow(measure, width, scale, p)
            yield pa.record_batch([pa.array([json.dumps(nodes_of(trees, cuts, p))])], names=["nodes"])
        found = blocks.coalesce(1).mapInArrow(whole, "nodes string").collect()
        return BoostedTrees(tuple(features), p, tuple(json.loads(found[0]["nodes"])))

    # blocks come to the tasks a few at a time, and a level is a job without a plan of its own
    held, kept = blocks.rdd, 0

    def measure(trees: list[Tree], tree: Tree, level: int, columns: list[int]) -> np.ndarray:
        since, done, first = trees[kept:], len(trees), 1 << level

        def partial(rows: Iterator) -> Iterator[np.ndarray]:
            total = np.zeros((2, first, len(columns), p.bins + 1), np.int64)
            for block in _blocks(rows, width, p):
                block.advance(since, p)
                total += block.measure(done, tree, level, columns, scale, p)
            yield total

        return held.mapPartitions(partial).treeReduce(np.add)  # nodes x features x bins, whatever the rows

    def keep(trees: list[Tree]) -> None:
        nonlocal blocks, held, kept
        if len(trees) - kept < KEEP or len(trees) == p.rounds:
            return
        since = trees[kept:]

        def advance(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(_each(batches), width, p):
                block.advance(since, p)
                yield _pack(block)
        blocks = stored(blocks.mapInArrow(advance, _LAYOUT), "boosting-blocks")
        held, kept = blocks.rdd, len(trees)

    trees = grow(measure, width, scale, p, keep)
    return BoostedTrees(tuple(features), p, tuple(nodes_of(trees, cuts, p)))


def score_boosted(model: BoostedTrees, df: DataFrame, key: str) -> DataFrame:
    """key, prediction, risk_probability, risk_band for every row, missing features included.

    Whole Arrow batches go down each tree at once. Small models can be written out as
    expressions instead, see ``plans.compiled``.
    """
    p, depth = model.params, model.params.depth
    count = 1 + max((n["tree"] for n in model.nodes), default=-1)
    size = 2 << depth
    feature, threshold = np.full((count, size), -1, np.int32), np.zeros((count, size))
    missing_right, step = np.zeros((count, size), bool), np.zeros((count, size))
    for n in model.nodes:
        at = n["tree"], n["node"]
        if n["feature"] is None:
            step[at] = n["step"]
        else:
            feature[at], threshold[at], missing_right[at] = n["feature"], n["threshold"], n["missing_right"]
    own = df.select(F.col(key).alias("_key"), *(known(df, c).cast("double").alias(f"f{i}")
                                                for i, c in enumerate(model.features)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.empty((batch.num_rows, max(1, len(model.features))))
            for i in range(len(model.features)):
                x[:, i] = batch.column(1 + i).to_numpy(zero_copy_only=False).astype(float)
            margin, row = np.zeros(len(x)), np.arange(len(x))
            for t in range(count):
                node = np.ones(len(x), np.int32)
                for _ in range(depth):
                    f = feature[t][node]
                    value = x[row, np.maximum(f, 0)]
                    right = np.where(np.isnan(value), missing_right[t][node], value > threshold[t][node])
                    node = np.where(f >= 0, 2 * node + right, node)
                margin += step[t][node]
            yield pa.record_batch([batch.column(0), pa.array(1.0 / (1.0 + np.exp(-margin))), pa.array((margin > 0).astype(float))],
                                  names=["_key", "p", "y"])
    scored = own.mapInArrow(run, f"_key {df.schema[key].dataType.simpleString()}, p double, y double")
    band = F.when(F.col("y") == 1, "HIGH RISK").otherwise("LOW RISK")
    return scored.select(F.col("_key").alias(key), F.col("y").alias("prediction"), F.col("p").alias("risk_probability"),
                         band.alias("risk_band"))
