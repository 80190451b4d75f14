"""Profiles of a table. Results are bounded by columns, classes and bins."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.functions.columns import known, value_map
from riskframe.operators.clean import MAX_CLASSES, class_counts, classes_of, split_feature_columns
from riskframe.operators.quantiles import ACCURACY, OVERALL, exact_quantiles


def overview(df: DataFrame, label: str, categorical: Iterable[str] = (),
             exclude: Iterable[str] = ()) -> DataFrame:
    """One row: rows, numeric and categorical features, positives, the rest."""
    numeric, cats = split_feature_columns(df, label, categorical, exclude)
    positives = F.coalesce(F.sum(F.col(label).cast("long")), F.lit(0))
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(numeric)).alias("n_numeric"),
                  F.lit(len(cats)).alias("n_categorical"), positives.alias("n_positive"),
                  (F.count("*") - positives).alias("n_negative"))


def describe_numeric(df: DataFrame, cols: Iterable[str], exact: bool = False,
                     digits: int = 2) -> DataFrame:
    """Per column: count, mean, sd, min, quartiles, max, rounded.

    Quartiles come from a sketch by default; ``exact=True`` finds them by
    counting passes and interpolates.
    """
    cols = list(cols)
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75]) if exact else None

    def line(c):
        v = known(df, c).cast("double")
        if exact:
            q = [F.lit(x).cast("double") for x in quartiles[OVERALL, c]]
        else:
            sketch = F.percentile_approx(v, [0.25, 0.5, 0.75], ACCURACY)
            q = [sketch[i] for i in range(3)]
        named = {"mean": F.avg(v), "std": F.stddev_samp(v), "min": F.min(v), "q25": q[0],
                 "q50": q[1], "q75": q[2], "max": F.max(v)}
        return F.struct(F.lit(c).alias("feature"), F.count(v).alias("n"),
                        *(F.round(e, digits).alias(n) for n, e in named.items()))
    return df.agg(F.array(*map(line, cols)).alias("r")).select(F.inline("r"))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value, most frequent first, ties by value; nulls left out."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count("*").alias("n_rows"))
            .orderBy(F.desc("n_rows"), col))


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed.

    Columns: bin (from 1), low, high, n_rows. Empty bins are listed.
    """
    value = known(df, col).cast("double")
    lo, hi = df.agg(F.min(value), F.max(value)).first()
    spark = df.sparkSession
    numbers = spark.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
    if lo is None:
        return numbers.limit(0).selectExpr("bin", "0D low", "0D high", "0L n_rows")
    if lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    width = (hi - lo) / bins
    # the bucket function numbers the maximum itself one past the last bin
    bucket = F.when(value.isNotNull(), F.least(
        F.width_bucket(value, F.lit(lo), F.lit(hi), F.lit(bins)), F.lit(bins)))
    counts = (df.select(bucket.cast("int").alias("bin")).filter("bin is not null")
              .groupBy("bin").agg(F.count("*").alias("n_rows")))
    empty = numbers.select("bin", F.lit(0).cast("long").alias("n_rows"))
    return (counts.unionByName(empty).groupBy("bin").agg(F.sum("n_rows").alias("n_rows"))
            .select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("low"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("high"), "n_rows"))


def correlation(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Pearson matrix in long form (a, b, r), pairwise complete, both triangles.

    One aggregate for all pairs; null where a column is constant.
    """
    cols = list(cols)
    values = df.select(*(known(df, c).cast("double").alias(c) for c in cols))

    def lines(a, b):
        # over the rows that have both; a constant column gives null
        r = F.try_divide(F.regr_sxy(a, b), F.sqrt(F.regr_sxx(a, b) * F.regr_syy(a, b)))
        one = F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"))
        other = F.struct(F.lit(b).alias("a"), F.lit(a).alias("b"), r.alias("r"))
        return [one] if a == b else [one, other]

    cells = [x for a, b in combinations_with_replacement(cols, 2) for x in lines(a, b)]
    return values.agg(F.array(*cells).alias("m")).select(F.inline("m"))


def class_balance(df: DataFrame, label: str, names: Mapping[int, str] | None = None) -> DataFrame:
    """Rows per label value in label order, with the class name."""
    text = F.col(label).cast("string")
    named = value_map(F.col(label), names or {}, text)
    return (df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n_rows"))
            .select(label, named.alias("class_name"), "n_rows").orderBy(label))


def crosstab(df: DataFrame, col: str, label: str) -> DataFrame:
    """Rows per category and class, one column per class; nulls left out."""
    both = df.filter(F.col(col).isNotNull() & F.col(label).isNotNull())
    classes = [r[0] for r in classes_of(both, label).limit(MAX_CLASSES + 1).collect()]
    if len(classes) > MAX_CLASSES:
        raise ValueError(f"{label} has more than {MAX_CLASSES} values; it is no class label")
    return both.groupBy(col).pivot(label, sorted(classes)).count().na.fill(0)


def class_share(df: DataFrame, label: str) -> DataFrame:
    """Rows and percent of all rows per class, from one pass over the table; refuses a
    label with too many values."""
    counts = class_counts(df, label)
    total = sum(counts.values())
    kind = T.StructType([df.select(label).schema[0], T.StructField("n_rows", T.LongType(), False),
                         T.StructField("percent", T.DoubleType(), True)])
    return df.sparkSession.createDataFrame([(c, n, n * 100.0 / total) for c, n in counts.items()], kind)


def melt(df: DataFrame, numeric: Iterable[str], categorical: Iterable[str],
         ids: Iterable[str] = ()) -> DataFrame:
    """Long table: feature, value as text, and whether it is numeric or categorical."""
    ids, numeric, categorical = list(ids), list(numeric), list(categorical)
    texts = df.select(*ids, *(F.col(c).cast("string").alias(c) for c in numeric + categorical))
    kind = F.when(F.col("feature").isin(numeric), "numeric").otherwise("categorical")
    return texts.unpivot(ids, numeric + categorical, "feature", "value").withColumn("kind", kind)
