"""Hard negatives of anchors by a vertical scan over dimensions.

Rows are held in blocks, column by column. For one anchor a block's columns are read in
descending order of the anchor's magnitudes; the least and most that the unread columns
can still add bound every row's score from both sides, and a bitmap drops the rows that
can no longer matter. First the rows of the anchor's own label are searched for its
positives. Their scores open windows, and the rows of other labels are searched until
every window's best rows are exact.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskframe.llm.topk import whole_vectors
from riskframe.sources.tables import stored

#: Aimed-at rows of a block and anchors of a group; one task holds one of each.
BLOCK, GROUP = 16_384, 1_024
#: Columns read between two looks at the bounds.
STRIDE = 8


class Columns:
    """Some rows' vectors, one array for each dimension, with the range of each."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        order = np.argsort(labels, kind="stable")
        self.ids, self.labels = ids[order], labels[order]
        self.columns = np.ascontiguousarray(vectors[order].T)
        self.least = self.columns.min(axis=1, initial=0.0)
        self.most = self.columns.max(axis=1, initial=0.0)

    def of_label(self, label: int) -> np.ndarray:
        """A bitmap of the rows with a label; they lie side by side."""
        alive = np.zeros(len(self.ids), bool)
        alive[np.searchsorted(self.labels, label):np.searchsorted(self.labels, label, "right")] = True
        return alive

    def scan(self, anchor: np.ndarray, alive: np.ndarray, needed) -> tuple[np.ndarray, np.ndarray]:
        """Rows that stay, and their exact scores. ``needed(low, high)`` tells from the bounds
        of the rows still there which of them may matter."""
        order = np.argsort(-np.abs(anchor), kind="stable")
        ends = np.stack([anchor * self.least, anchor * self.most])[:, order]
        after_least = ends.min(axis=0)[::-1].cumsum()[::-1]
        after_most = ends.max(axis=0)[::-1].cumsum()[::-1]
        rows = np.flatnonzero(alive)
        partial = np.zeros(len(rows))
        for at in range(0, len(order), STRIDE):
            if at:
                keep = needed(partial + after_least[at], partial + after_most[at])
                if not keep.all():
                    rows, partial = rows[keep], partial[keep]
            if not len(rows):
                break
            every = len(rows) == len(self.ids)
            for d in order[at:at + STRIDE]:
                if anchor[d]:
                    column = self.columns[d]
                    partial += anchor[d] * (column if every else column[rows])
        return rows, partial


def best_of_label(held: Columns, own: int, label: int, anchor: np.ndarray, k: int):
    """(id, score) of the k best rows of the anchor's label other than itself."""
    alive = held.of_label(label) & (held.ids != own)

    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        if len(low) <= k:
            return np.ones(len(low), bool)
        return high >= np.partition(low, len(low) - k)[len(low) - k]
    rows, scores = held.scan(anchor, alive, needed)
    best = np.lexsort((held.ids[rows], -scores))[:k]
    return [(int(held.ids[rows[i]]), int(scores[i])) for i in best]


def best_in_windows(held: Columns, label: int, anchor: np.ndarray, windows: list[tuple[int, int]], k: int):
    """For each window of scores, (id, score) of the k best rows of other labels inside it."""
    if not any(lo <= hi for lo, hi in windows):
        return [[] for _ in windows]

    def needed(low: np.ndarray, high: np.ndarray) -> np.ndarray:
        keep = np.zeros(len(low), bool)
        for lo, hi in windows:
            if lo > hi:
                continue
            floor = lo
            sure = low[(low >= lo) & (high <= hi)]
            if len(sure) >= k:
                floor = max(lo, np.partition(sure, len(sure) - k)[len(sure) - k])
            keep |= (high >= floor) & (low <= hi)
        return keep
    rows, scores = held.scan(anchor, ~held.of_label(label), needed)
    out = []
    for lo, hi in windows:
        inside = np.flatnonzero((scores >= lo) & (scores <= hi))
        best = inside[np.lexsort((held.ids[rows[inside]], -scores[inside]))[:k]]
        out.append([(int(held.ids[rows[i]]), int(scores[i])) for i in best])
    return out


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    out = np.zeros((len(column), width))
    for i, v in enumerate(column):
        v = v.values.to_numpy(zero_copy_only=False)
        out[i, :len(v)] = v
    return out


def _columns(table: pa.Table, width: int) -> Columns:
    return Columns(table["id"].to_numpy(), table["label"].to_numpy(), _matrix(table["vec"], width))


def labelled(df: DataFrame, key: str, vector: str, label: str, scale: int) -> DataFrame:
    """(id, label, vec), one row for each id: of repeated ids the smallest (label, vector)
    stays. Rows without id or label or with an unusable vector are left out."""
    named = df.select(F.struct(F.col(f"`{key}`").alias("k"), F.col(f"`{label}`").cast("long").alias("y")).alias("_both"),
                      F.col(f"`{vector}`").alias("_vector")).where(F.col("_both.k").isNotNull() & F.col("_both.y").isNotNull())
    whole = whole_vectors(named, "_both", "_vector", scale)
    one = F.min(F.struct(F.col("id.y").alias("label"), "vec")).alias("_one")
    return whole.groupBy(F.col("id.k").cast("long").alias("id")).agg(one).select("id", "_one.label", "_one.vec")


def hard_negatives(df: DataFrame, anchors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                   label: str = "label", positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
                   scale: int = 256) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Scores are inner products of the components as floor(scale * x), higher first, ties
    to the smaller id. An anchor's positives are its first ``positives`` other rows of its
    label; of each, the first ``negatives`` rows of other labels that score from ``low`` to
    ``high`` percent of the positive's score. A positive of negative score has no such
    rows; a positive without any is not listed.

    ``anchors`` holds ids in a column named ``key`` and is looked up among the usable rows
    of ``df``; ids are whole numbers. Left out are rows with a null id or label, a null
    vector, or a null or non-finite component; shorter vectors count as padded with
    zeros; of repeated ids the smallest (label, vector) stays. Empty tables give an empty
    result. Scores must stay below 2**53.
    """
    spark = df.sparkSession
    points = stored(labelled(df, key, vector, label, scale), "negatives-rows")
    shape = points.agg(F.max(F.size("vec")).alias("w"), F.count("*").alias("n")).first()
    asked = anchors.select(F.col(f"`{key}`").cast("long").alias("id")).where("id is not null").distinct()
    asked = stored(points.join(asked, "id", "left_semi"), "negatives-anchors")
    n_asked, width = asked.count(), max(shape["w"] or 0, 1)
    out = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not n_asked:
        return spark.createDataFrame([], out)
    blocks, groups = -(-shape["n"] // BLOCK), -(-n_asked // GROUP)

    def dealt(side: DataFrame, own: str, n_own: int, other: str, n_other: int) -> DataFrame:
        part = F.pmod(F.xxhash64("id"), F.lit(n_own)).cast("int").alias(own)
        return side.select("*", part, F.explode(F.sequence(F.lit(0), F.lit(n_other - 1))).alias(other)) \
            .groupBy("_block", "_group")

    held = dealt(points, "_block", blocks, "_group", groups)

    def first(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, data = [], _columns(right, width)
        for a, y, v in zip(left["id"].to_pylist(), left["label"].to_pylist(), _matrix(left["vec"], width)):
            rows += [(a, i, s) for i, s in best_of_label(data, a, y, v, positives)]
        return _table(rows, ["anchor_id", "id", "score"])

    found = dealt(asked, "_group", groups, "_block", blocks).cogroup(held).applyInArrow(
        first, "anchor_id long, id long, score long")
    best = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    chosen = (found.withColumn("_nth", F.row_number().over(best)).where(F.col("_nth") <= positives)
              .groupBy(F.col("anchor_id").alias("id")).agg(F.collect_list(F.struct("id", "score")).alias("positives")))
    opened = stored(asked.join(chosen, "id"), "negatives-windows")

    def second(left: pa.Table, right: pa.Table) -> pa.Table:
        rows, data = [], _columns(right, width)
        for a, y, v, own in zip(left["id"].to_pylist(), left["label"].to_pylist(), _matrix(left["vec"], width),
                                left["positives"].to_pylist()):
            windows = [(-(-low * p["score"] // 100), high * p["score"] // 100) for p in own]
            for p, inside in zip(own, best_in_windows(data, y, v, windows, negatives)):
                rows += [(a, p["id"], i, p["score"], s) for i, s in inside]
        return _table(rows, ["anchor_id", "positive_id", "negative_id", "positive_score", "negative_score"])

    met = dealt(opened, "_group", groups, "_block", blocks).cogroup(held).applyInArrow(
        second, "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long")
    hardest = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id")
    return (met.withColumn("rank", F.row_number().over(hardest)).where(F.col("rank") <= negatives)
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def _table(rows: list[tuple], names: list[str]) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in names]
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})
