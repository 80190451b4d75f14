"""Splitting, replicating and reordering rows, repeatable from the row key.

``key`` must identify a row. All draws are hashes of it (see
``functions.keyed_random``), so a lost task that is run again, or another
partitioning, selects the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.keyed_random import normal, uniform
from riskframe.operators.clean import _replace, class_counts
from riskframe.operators.quantiles import FETCH_ROWS


def stratified_split(df: DataFrame, label: str, key: str, test_frac: float = 0.2, seed: int = 42,
                     exact: bool = False) -> tuple[DataFrame, DataFrame]:
    """Train and test rows, each class split in the same proportion.

    By default a row is a test row when its draw is below ``test_frac``: a pure
    filter, proportional within each class in expectation. ``exact=True`` gives
    each class exactly ``round(test_frac * rows)`` test rows, those with the
    smallest draws.
    """
    test = test_side(df, label, key, test_frac, seed, exact)
    return df.filter(~test), df.filter(test)


def test_side(df: DataFrame, label: str, key: str, test_frac: float = 0.2, seed: int = 42,
              exact: bool = False) -> Column:
    """Boolean column: is this a test row."""
    draw = uniform(seed, F.col(key))
    if not exact:
        return draw < test_frac
    if df.filter(F.col(key).isNull()).limit(1).count():
        raise ValueError(f"an exact split needs a key in every row; {key} has nulls")
    counts = class_counts(df, label)
    wanted = {k: int(test_frac * n + 0.5) for k, n in counts.items()}
    return smallest_draws(df, label, key, draw, wanted, counts)


test_side.__test__ = False


def smallest_draws(df: DataFrame, label: str, key: str, draw: Column, wanted: Mapping,
                   counts: Mapping) -> Column:
    """Boolean column, true for the ``wanted[class]`` rows with the smallest
    (draw, key) of each class. ``counts`` holds the rows per class.

    The cut value is found by counting passes, not by sorting or ranking, so no
    task ever holds a class.
    """
    sized = {k: n for k, n in wanted.items() if n > 0}
    drawn = df.select(F.col(label).alias("y"), F.col(key).alias("k"), draw.alias("u"))
    cuts = _cut_draws(drawn, sized, counts) if sized else {}
    chosen = F.lit(False)
    for k, (u, last) in cuts.items():
        mine = F.col(label).eqNullSafe(F.lit(k))
        # equal draws of different keys are all but impossible; the key decides them
        chosen = chosen | (mine & ((draw < u) | ((draw == u) & (F.col(key) <= F.lit(last)))))
    return chosen


def _cut_draws(drawn: DataFrame, wanted: Mapping, counts: Mapping) -> dict:
    """Per class the (draw, key) of its ``wanted``-th row in the order of draws.

    Draws are spread evenly, so each counting pass leaves a thin slice of
    [0, 1) around the cut, and the last pass lists a slice of bounded size.
    """
    slices = {k: (0.0, 1.0, 0, counts[k]) for k in wanted}      # from, to, rows before, inside

    def inside(k):
        lo, hi, _, _ = slices[k]
        return F.col("y").eqNullSafe(F.lit(k)) & F.col("u").between(lo, hi)

    while wide := [k for k, (lo, hi, _, n) in slices.items() if n > FETCH_ROWS and lo < hi]:
        most = max(16, 65_536 // len(wide))     # over all classes together
        bins = {k: min(most, 16 + slices[k][3] // 1_000) for k in wide}
        place = F.lit(None).cast("struct<c:int,b:int>")
        for i, k in enumerate(wide):
            lo, hi, _, _ = slices[k]
            at = F.floor((F.col("u") - lo) / (hi - lo) * bins[k]).cast("int")
            place = F.when(inside(k), F.struct(F.lit(i).alias("c"),
                                               F.least(at, F.lit(bins[k] - 1)).alias("b"))) \
                .otherwise(place)
        rows = (drawn.select(place.alias("p"), "u").filter(F.col("p").isNotNull())
                .groupBy("p.c", "p.b").agg(F.count("*").alias("n"), F.min("u").alias("lo"),
                                           F.max("u").alias("hi")).collect())
        for i, k in enumerate(wide):
            before = slices[k][2]
            for r in sorted((r for r in rows if r["c"] == i), key=lambda r: r["b"]):
                if wanted[k] <= before + r["n"]:
                    slices[k] = (r["lo"], r["hi"], before, r["n"])
                    break
                before += r["n"]
    near = F.lit(False)
    for k in slices:
        near = near | inside(k)
    # counted by key, so that rows sharing a key stay one entry
    rows = drawn.filter(near).groupBy("y", "u", "k").count().collect()
    cuts = {}
    for k, (_, _, before, _) in slices.items():
        for u, key, n in sorted((r["u"], r["k"], r["count"]) for r in rows if r["y"] == k):
            before += n
            if before >= wanted[k]:
                cuts[k] = (u, key)
                break
    return cuts


def random_split(df: DataFrame, test_frac: float = 0.2, seed: int = 42) \
        -> tuple[DataFrame, DataFrame]:
    """Spark's own random split. Depends on partitioning; prefer
    :func:`stratified_split`, which does not."""
    train, test = df.randomSplit([1 - test_frac, test_frac], seed=seed)
    return train, test


def coverage(train: DataFrame, test: DataFrame, label: str) -> DataFrame:
    """Rows per class on both sides: label, n_train, n_test."""
    sides = train.select(label, F.lit(1).alias("train"), F.lit(0).alias("test")).unionByName(
        test.select(label, F.lit(0).alias("train"), F.lit(1).alias("test")))
    return sides.groupBy(label).agg(F.sum("train").alias("n_train"), F.sum("test").alias("n_test"))


def check_coverage(train: DataFrame, test: DataFrame, label: str) -> None:
    """Raise unless every class is on both sides."""
    lacking = coverage(train, test, label).filter("n_train = 0 or n_test = 0").limit(10).collect()
    if lacking:
        raise ValueError(f"classes missing from one side: {[tuple(r) for r in lacking]}")


def replicate(df: DataFrame, n: int, column: str = "copy") -> DataFrame:
    """``n`` copies of every row, numbered from 1 in ``column``."""
    return df.withColumn(column, F.explode(F.sequence(F.lit(1), F.lit(n))))


def shuffle_rows(df: DataFrame, key: str, seed: int = 42,
                 partitions: int | None = None) -> DataFrame:
    """Rows in random order, the order of a keyed draw.

    The draws are spread evenly, so each row's partition follows from its draw.
    That saves the extra run of the input by which a range sort finds its ranges.
    There are as many partitions as the input has, or the session's number if that
    is more; the order does not depend on it.
    """
    n = partitions or max(df.rdd.getNumPartitions(),
                          int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    drawn = df.withColumn("_draw", uniform(seed, F.lit("order"), F.col(key)))
    placed = drawn.repartitionById(n, F.floor(F.col("_draw") * n).cast("int"))
    return placed.sortWithinPartitions("_draw", key).drop("_draw")


def append_rows(df: DataFrame, extra: DataFrame) -> DataFrame:
    """Rows of both, matched by column name; columns ``extra`` lacks become null."""
    return df.unionByName(extra, allowMissingColumns=True)


def add_noise(df: DataFrame, cols, key: str, sd: float = 0.03, seed: int = 42) -> DataFrame:
    """Add N(0, sd) to each cell of ``cols``, drawn from key and column name."""
    return _replace(df, {c: F.col(c).cast("double") + F.lit(float(sd)) * normal(seed, F.col(key), c)
                         for c in cols})
