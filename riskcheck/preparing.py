"""Queries: sources, cleaning, imputation, features."""

from __future__ import annotations

from pyspark.ml.feature import StandardScaler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from riskcheck.registry import (EVENTS_RAW, LABELLED_DOCS, MESSY_EVENTS, RISK_EVENTS,
                                RISK_LINEITEM, events_raw, labelled_docs, messy_events, query,
                                risk_events, risk_lineitem, rounded, sql_vectors, table,
                                vectors)
from riskframe.operators.dictionary import fit_dictionary
from riskframe.operators import clean, features, impute
from riskframe.plans import Preparation
from riskframe.sources import conform, frame_from_records, read_table, replace_table, scratch_path, trim_headers, write_table
from riskframe.spec import DatasetSpec

# ---- sources --------------------------------------------------------------------------------


@query("a1_scan_csv", f"""WITH {EVENTS_RAW}
SELECT CAST(event_id AS INTEGER) AS event_id, y, value, k, event_type FROM raw""")
def _(spark, sf):
    path = scratch_path(spark, "events-csv")
    write_table(events_raw(spark, sf), path, "csv")
    return read_table(spark, path)


@query("a2_trim_headers", "SELECT event_id, event_type, value FROM events")
def _(spark, sf):
    padded = table(spark, sf, "events").select("event_id", "event_type", "value")
    return trim_headers(padded.toDF(*(f"  {c} " for c in padded.columns)))


@query("a5_sink_table", f"WITH {RISK_EVENTS} SELECT * FROM risk")
def _(spark, sf):
    path = write_table(risk_events(spark, sf), scratch_path(spark, "risk"))
    return read_table(spark, path, fmt="parquet")


@query("a5_replace_input", f"""WITH {RISK_EVENTS}
SELECT event_id, y, value * 2 AS value, k, event_type FROM risk WHERE k IS NOT NULL""")
def _(spark, sf):
    """A table that is read, changed and written over itself."""
    path = write_table(risk_events(spark, sf), scratch_path(spark, "risk"))
    known = read_table(spark, path, fmt="parquet").where("k is not null")
    return read_table(spark, replace_table(known.withColumn("value", F.col("value") * 2), path), fmt="parquet")


@query("a8_frame_from_records", """SELECT n_nationkey, n_name, CAST(n_regionkey AS DOUBLE) AS n_regionkey,
  CAST(NULL AS VARCHAR) AS absent FROM nation""")
def _(spark, sf):
    records = [r.asDict() for r in table(spark, sf, "nation").selectExpr(
        "n_nationkey", "n_name", "double(n_regionkey) n_regionkey", "1 as surplus").collect()]
    return frame_from_records(spark, records,
                              "n_nationkey int, n_name string, n_regionkey double, absent string")


@query("a8_conform", f"""WITH {EVENTS_RAW}
SELECT event_id, value, CAST(k AS DOUBLE) AS k, CAST(NULL AS DOUBLE) AS weight FROM raw""")
def _(spark, sf):
    return conform(events_raw(spark, sf), "event_id long, value double, k double, weight double")


# ---- cleaning -------------------------------------------------------------------------------


@query("b1_normalize_categoricals", f"""WITH {MESSY_EVENTS}
SELECT event_id, lower(trim(cat)) AS cat, CAST(value > 60 AS VARCHAR) AS is_high FROM messy""")
def _(spark, sf):
    df = messy_events(spark, sf).select("event_id", "cat", (F.col("value") > 60).alias("is_high"))
    return clean.normalize_categoricals(df, ["cat", "is_high", "absent"])


@query("b2_drop_if_present", "SELECT event_id, ts, event_type, value FROM events")
def _(spark, sf):
    return clean.drop_if_present(table(spark, sf, "events"), ["user_id", "props", "absent"])


@query("b3_binarize_label", f"""WITH {LABELLED_DOCS}
SELECT doc_id, n_chars, CASE WHEN quality > 0 THEN 1 ELSE 0 END AS quality FROM docs""")
def _(spark, sf):
    return clean.binarize_label(labelled_docs(spark, sf), "quality")


@query("b3_binarize_label_drop", f"""WITH {LABELLED_DOCS}
SELECT doc_id, n_chars, CASE WHEN quality > 0 THEN 1 ELSE 0 END AS quality FROM docs
WHERE quality IS NOT NULL""")
def _(spark, sf):
    return clean.binarize_label(labelled_docs(spark, sf), "quality", null_label="drop")


@query("b4_cast_label", """SELECT event_id, CAST(props->>'$.k' AS INTEGER) AS num,
TRY_CAST(event_type AS INTEGER) AS txt FROM events""")
def _(spark, sf):
    df = table(spark, sf, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("num"), F.col("event_type").alias("txt"))
    return clean.cast_label(clean.cast_label(df, "num"), "txt", lenient=True)


@query("b5_zero_to_null", """SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS l_discount,
nullif(l_tax, 0) AS l_tax FROM lineitem""")
def _(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    return clean.zero_to_null(df, ["l_discount", "l_tax", "absent"])


@query("b6_select_numeric", f"WITH {RISK_EVENTS} SELECT event_id, value, k, y FROM risk")
def _(spark, sf):
    return clean.select_numeric(risk_events(spark, sf), "y")


@query("b7_detect_target", f"""WITH {RISK_EVENTS}
SELECT event_id, y AS label, value, k, event_type FROM risk""")
def _(spark, sf):
    return clean.detect_target(risk_events(spark, sf))


@query("b8_split_feature_cols", f"""WITH {RISK_EVENTS}
SELECT event_id, y, value, k, event_type FROM risk""")
def _(spark, sf):
    df = risk_events(spark, sf).withColumn("flag", F.col("value") > 60)
    return clean.feature_frame(df, "y", ["event_type"], key="event_id")


@query("b8_boolean_features", f"""WITH {RISK_EVENTS}
SELECT event_id, y, value, k, CAST(value > 60 AS INTEGER) AS flag, event_type FROM risk""")
def _(spark, sf):
    df = risk_events(spark, sf).withColumn("flag", F.col("value") > 60)
    return clean.feature_frame(df, "y", ["event_type"], key="event_id", booleans_as_int=True)


@query("b9_filter_class", f"WITH {RISK_EVENTS} SELECT * FROM risk WHERE y = 1")
def _(spark, sf):
    return clean.filter_class(risk_events(spark, sf), "y", 1)


@query("b10_head_sample", "SELECT * FROM events ORDER BY event_id LIMIT 10")
def _(spark, sf):
    return clean.head_sample(table(spark, sf, "events"), 10, key="event_id")


@query("b11_distinct_classes", "SELECT DISTINCT quality FROM labels")
def _(spark, sf):
    return clean.classes_of(table(spark, sf, "labels"), "quality")


# ---- imputation -----------------------------------------------------------------------------


@query("c1_class_median_impute", f"""WITH {RISK_EVENTS},
med AS (SELECT y, quantile_cont(k, 0.5) AS m FROM risk GROUP BY y)
SELECT event_id, y, value, coalesce(CAST(k AS DOUBLE), m) AS k, event_type
FROM risk JOIN med USING (y)""")
def _(spark, sf):
    df = risk_events(spark, sf)
    return impute.ClassMedianImputer(("k",), "y", exact=True).fit(df).transform(df)


@query("c1_class_median_lineitem", f"""WITH {RISK_LINEITEM},
med AS (SELECT y, quantile_cont(l_discount, 0.5) AS d, quantile_cont(l_tax, 0.5) AS t
  FROM risk GROUP BY y)
SELECT y, l_quantity, l_extendedprice, coalesce(l_discount, d) AS l_discount,
  coalesce(l_tax, t) AS l_tax, l_linestatus FROM risk JOIN med USING (y)""")
def _(spark, sf):
    df = risk_lineitem(spark, sf)
    return impute.ClassMedianImputer(("l_discount", "l_tax"), "y", exact=True).fit(df).transform(df)


@query("c2_mean_impute", f"""WITH {RISK_EVENTS}
SELECT event_id, y, value, coalesce(CAST(k AS DOUBLE), (SELECT round_even(avg(k), 4) FROM risk)) AS k,
  event_type FROM risk""")
def _(spark, sf):
    df = risk_events(spark, sf)
    return impute.MeanImputer(exclude=("event_id", "y")).fit(df).transform(df)


@query("c2_mean_impute_truncated", f"""WITH {RISK_EVENTS}
SELECT event_id, y, value, coalesce(k, (SELECT CAST(trunc(avg(k)) AS INTEGER) FROM risk)) AS k,
  event_type FROM risk""")
def _(spark, sf):
    df = risk_events(spark, sf)
    return impute.MeanImputer(exclude=("event_id", "y")).fit(df).transform(df, keep_type=True)


@query("c3_mode_impute", f"""WITH {MESSY_EVENTS},
mode AS (SELECT cat FROM messy WHERE cat IS NOT NULL GROUP BY cat ORDER BY count(*) DESC, cat LIMIT 1)
SELECT event_id, coalesce(cat, (SELECT cat FROM mode)) AS cat FROM messy""")
def _(spark, sf):
    df = messy_events(spark, sf).select("event_id", "cat")
    return impute.ModeImputer(("cat",)).fit(df).transform(df)


@query("c4_median_impute", f"""WITH {RISK_LINEITEM},
med AS (SELECT quantile_cont(l_discount, 0.5) AS d, quantile_cont(l_tax, 0.5) AS t FROM risk)
SELECT l_quantity, l_extendedprice, coalesce(l_discount, d) AS l_discount,
  coalesce(l_tax, t) AS l_tax FROM risk, med""")
def _(spark, sf):
    df = risk_lineitem(spark, sf).drop("y", "l_linestatus")
    return impute.MedianImputer(exact=True).fit(df).transform(df)


@query("c5_knn_impute", f"""WITH {RISK_EVENTS},
pairs AS (SELECT q.event_id, d.k, row_number() OVER (PARTITION BY q.event_id
    ORDER BY (q.value - d.value) * (q.value - d.value) * 2 / 1, d.event_id) AS rn
  FROM risk q, risk d WHERE q.k IS NULL AND d.k IS NOT NULL),
fill AS (SELECT event_id, avg(k) AS f FROM pairs WHERE rn <= 5 GROUP BY event_id)
SELECT event_id, y, round(value, 6) AS value, round(coalesce(CAST(k AS DOUBLE), f), 6) AS k
FROM risk LEFT JOIN fill USING (event_id)""")
def _(spark, sf):
    df = risk_events(spark, sf).drop("event_type")
    return rounded(impute.KnnImputer(("value", "k"), "event_id").fit(df).transform(df))


def _gap(i, name="vec_id"):
    """Which cells of coordinate i are taken away: every fifth row, another for each."""
    return f"({name} * 7 + {3 * i}) % 5 = 0"


DIMS = 64
KNN_DIST = " + ".join(f"coalesce((q.e{i} - d.e{i}) * (q.e{i} - d.e{i}), 0)" for i in range(DIMS))
KNN_SHARED = " + ".join(f"CAST(q.e{i} IS NOT NULL AND d.e{i} IS NOT NULL AS INTEGER)" for i in range(DIMS))


@query("c5_knn_impute_vectors", f"""WITH {sql_vectors(DIMS)},
gappy AS MATERIALIZED (SELECT vec_id, {", ".join(f"CASE WHEN NOT {_gap(i)} THEN e{i} END AS e{i}" for i in range(DIMS))} FROM vecs),
pairs AS MATERIALIZED (SELECT q.vec_id AS q_id, d.vec_id AS d_id, ({KNN_DIST}) * ({DIMS}.0 / ({KNN_SHARED})) AS dist
  FROM gappy q, gappy d WHERE {KNN_SHARED} > 0),
cells AS (SELECT vec_id, unnest(range({DIMS})) AS i, unnest([{", ".join(f"e{i}" for i in range(DIMS))}]) AS e FROM gappy),
near AS (SELECT m.vec_id, m.i, c.e, row_number() OVER (PARTITION BY m.vec_id, m.i ORDER BY dist, d_id) AS rn
  FROM cells m JOIN pairs ON m.vec_id = q_id JOIN cells c ON c.vec_id = d_id AND c.i = m.i
  WHERE m.e IS NULL AND c.e IS NOT NULL),
fill AS (SELECT vec_id, {", ".join(f"avg(e) FILTER (i = {i}) AS f{i}" for i in range(DIMS))} FROM near WHERE rn <= 5 GROUP BY vec_id)
SELECT vec_id, {", ".join(f"round(coalesce(e{i}, f{i}), 6) + 0.0 AS e{i}" for i in range(DIMS))}
FROM gappy LEFT JOIN fill USING (vec_id)""")
def _(spark, sf):
    """All coordinates with gaps in each: many patterns, several targets, scaled distances."""
    df = vectors(spark, sf, DIMS).select("vec_id", *(F.expr(f"case when not {_gap(i)} then e{i} end").alias(f"e{i}")
                                               for i in range(DIMS)))
    filled = impute.KnnImputer(tuple(f"e{i}" for i in range(DIMS)), "vec_id").fit(df).transform(df)
    return rounded(filled)


EVENT_FIELDS = {"value": impute.FieldRange(48.5, 0.0, 200.0), "k": impute.FieldRange(50, 1, 90),
                "cat": impute.FieldRange("View", options=("View", "Click", "Purchase"))}


@query("c6_default_fill", f"""WITH {MESSY_EVENTS}
SELECT event_id, value, coalesce(k, 50) AS k, coalesce(lower(trim(cat)), 'view') AS cat FROM messy""")
def _(spark, sf):
    df = messy_events(spark, sf).select("event_id", "value", "k", "cat")
    df = clean.normalize_categoricals(df, ["cat"])
    return impute.apply_defaults(df, ["value", "k", "cat"], EVENT_FIELDS)


@query("c6_range_report", f"""WITH {MESSY_EVENTS}
SELECT 'value' AS feature, count(*) - count(value) AS n_missing,
  count(*) FILTER (value BETWEEN 0 AND 200) AS n_inside,
  count(*) FILTER (NOT value BETWEEN 0 AND 200) AS n_outside FROM messy
UNION ALL SELECT 'k', count(*) - count(k), count(*) FILTER (k BETWEEN 1 AND 90),
  count(*) FILTER (NOT k BETWEEN 1 AND 90) FROM messy
UNION ALL SELECT 'cat', count(*) - count(cat),
  count(*) FILTER (lower(trim(cat)) IN ('view', 'click', 'purchase')),
  count(*) FILTER (lower(trim(cat)) NOT IN ('view', 'click', 'purchase')) FROM messy""")
def _(spark, sf):
    return impute.range_report(messy_events(spark, sf), ["value", "k", "cat"], EVENT_FIELDS)


# ---- features -------------------------------------------------------------------------------


@query("d1_interactions", f"""WITH {RISK_LINEITEM}
SELECT l_quantity, l_tax, round(l_quantity * l_tax, 6) AS l_quantity_x_l_tax,
  round(l_extendedprice * l_discount, 6) AS l_extendedprice_x_l_discount FROM risk""")
def _(spark, sf):
    df, added = features.add_interactions(risk_lineitem(spark, sf), [
        ("l_quantity", "l_tax"), ("l_extendedprice", "l_discount"), ("l_tax", "absent")])
    return rounded(df.select("l_quantity", "l_tax", *added))


@query("d2_log1p", f"""WITH {RISK_EVENTS}
SELECT event_id, round(ln(value + 1), 6) AS value_log, round(ln(k + 1), 6) AS k_log FROM risk""")
def _(spark, sf):
    df, added = features.add_log1p(risk_events(spark, sf), ["value", "k"])
    return rounded(df.select("event_id", *added))


@query("d3_ratios", f"""WITH {EVENTS_RAW}
SELECT event_id, CASE WHEN k <> 0 THEN value / k END AS value_k FROM raw""")
def _(spark, sf):
    df = features.add_ratios(events_raw(spark, sf), {"value_k": ("value", "k")})
    return df.select("event_id", "value_k")


@query("d4_powers", f"WITH {RISK_EVENTS} SELECT event_id, round(value * value, 6) AS value_sq FROM risk")
def _(spark, sf):
    df = features.add_powers(risk_events(spark, sf), {"value_sq": ("value", 2)})
    return rounded(df.select("event_id", "value_sq"))


@query("d5_threshold_flags", f"""WITH {RISK_EVENTS}
SELECT event_id, CAST(value > 140 AS INTEGER) AS high_value,
  CAST(coalesce(k < 12, false) AS INTEGER) AS low_k FROM risk""")
def _(spark, sf):
    df = features.add_flags(risk_events(spark, sf), {"high_value": ("value", ">", 140),
                                                     "low_k": ("k", "<", 12)})
    return df.select("event_id", "high_value", "low_k")


@query("d6_class_weights", f"""WITH {RISK_EVENTS},
n AS (SELECT y, count(*) AS c FROM risk GROUP BY y)
SELECT event_id, y, round((SELECT sum(c) FROM n) / ((SELECT count(*) FROM n) * c), 6) AS _class_weight
FROM risk JOIN n USING (y)""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "y")
    return rounded(features.ClassWeights("y").fit(df).transform(df))


@query("d6_class_weights_null_label", f"""WITH {LABELLED_DOCS},
n AS (SELECT quality, count(*) AS c FROM docs WHERE quality IS NOT NULL GROUP BY quality)
SELECT doc_id, quality, round(coalesce((SELECT sum(c) FROM n) / ((SELECT count(*) FROM n) * c), 1), 6)
  AS _class_weight
FROM docs LEFT JOIN n USING (quality)""")
def _(spark, sf):
    df = labelled_docs(spark, sf).select("doc_id", "quality")
    return rounded(features.ClassWeights("quality").fit(df).transform(df))


INDEXED = MESSY_EVENTS + """,
ranked AS (SELECT cat, row_number() OVER (ORDER BY count(*) DESC, cat) - 1 AS idx
  FROM messy WHERE cat IS NOT NULL GROUP BY cat),
indexed AS (SELECT event_id, m.cat, CAST(coalesce(idx, (SELECT count(*) FROM ranked)) AS DOUBLE)
  AS cat_idx FROM messy m LEFT JOIN ranked r ON m.cat = r.cat)"""


@query("d7_string_index", f"WITH {INDEXED} SELECT event_id, cat, cat_idx FROM indexed")
def _(spark, sf):
    return features.string_index(messy_events(spark, sf).select("event_id", "cat"), "cat")


#: Line items with a tag of as many values as orders, one of which holds a third of all rows.
TAGGED = """tagged AS (SELECT l_orderkey * 8 + l_linenumber AS line_id, l_linenumber,
  CASE WHEN l_linenumber <= 2 THEN 'hot' WHEN l_linenumber < 7 THEN CAST(l_orderkey AS VARCHAR) END AS tag FROM lineitem),
numbers AS (SELECT tag, row_number() OVER (ORDER BY count(*) DESC, tag) - 1 AS idx
  FROM tagged WHERE l_linenumber <= 4 AND tag IS NOT NULL GROUP BY tag)"""


def tagged_lines(spark, sf):
    """The tagged lines, and the dictionary of the tags of some of them."""
    number = F.col("l_linenumber")
    lines = table(spark, sf, "lineitem").select(
        (F.col("l_orderkey") * 8 + number).alias("line_id"), number,
        F.when(number <= 2, "hot").when(number < 7, F.col("l_orderkey").cast("string")).alias("tag"))
    return lines.drop("l_linenumber"), fit_dictionary(lines.where(number <= 4), "tag")


@query("d7_string_index_wide", f"""WITH {TAGGED}
SELECT line_id, tag, coalesce(idx, (SELECT count(*) FROM numbers)) AS tag_idx FROM tagged LEFT JOIN numbers USING (tag)""")
def _(spark, sf):
    lines, dictionary = tagged_lines(spark, sf)
    return dictionary.transform(lines)


@query("d8_one_hot_wide", f"""WITH {TAGGED}, size AS (SELECT count(*) AS n FROM numbers)
SELECT line_id, n + 1 AS width, coalesce(idx, n) AS slot, 1.0::DOUBLE AS value FROM tagged CROSS JOIN size LEFT JOIN numbers USING (tag)""")
def _(spark, sf):
    lines, dictionary = tagged_lines(spark, sf)
    hot = F.col("tag_ohe")
    return dictionary.one_hot(lines).select("line_id", hot["size"].alias("width"), F.explode(
        F.arrays_zip(hot["indices"], hot["values"])).alias("z")).select("line_id", "width", F.col("z.indices").alias("slot"),
                                                                        F.col("z.values").alias("value"))


@query("d8_one_hot", f"""WITH {INDEXED}
SELECT event_id, CAST(cat_idx AS INTEGER) AS hot_slot,
  CAST((SELECT count(*) + 1 FROM ranked) AS INTEGER) AS width, 1.0::DOUBLE AS total FROM indexed""")
def _(spark, sf):
    df = features.one_hot(messy_events(spark, sf).select("event_id", "cat"), "cat")
    slots = vector_to_array("cat_ohe")
    return df.select("event_id", (F.array_position(slots, F.lit(1.0)) - 1).cast("int")
                     .alias("hot_slot"), F.size(slots).alias("width"),
                     F.aggregate(slots, F.lit(0.0), lambda a, x: a + x).alias("total"))


@query("d9_assemble", f"""WITH {RISK_EVENTS}
SELECT event_id, value AS slot0, CAST(k AS DOUBLE) AS slot1 FROM risk
WHERE value IS NOT NULL AND k IS NOT NULL""")
def _(spark, sf):
    slots = vector_to_array("raw_features")
    return features.assemble(risk_events(spark, sf), ["value", "k"]).select(
        "event_id", slots[0].alias("slot0"), slots[1].alias("slot1"))


@query("d9_incomplete_rows", f"""WITH {RISK_EVENTS}
SELECT count(k) AS n_kept, count(*) - count(k) AS n_skipped FROM risk""")
def _(spark, sf):
    return features.incomplete_rows(risk_events(spark, sf), ["value", "k"])


@query("d10_standardize", f"""WITH {RISK_EVENTS},
m AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(k) AS mk, stddev_samp(k) AS sk FROM risk)
SELECT event_id, round((value - mv) / sv, 6) + 0.0 AS value_std, round((k - mk) / sk, 6) + 0.0 AS k_std
FROM risk, m""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "value", "k")
    return rounded(features.Standardizer(("value", "k")).fit(df).transform(df).drop("value", "k"))


@query("d10_standardize_population", f"""WITH {RISK_EVENTS},
m AS (SELECT avg(value) AS mv, stddev_pop(value) AS sv, avg(k) AS mk, stddev_pop(k) AS sk FROM risk)
SELECT event_id, round((value - mv) / sv, 6) + 0.0 AS value_std, round((k - mk) / sk, 6) + 0.0 AS k_std
FROM risk, m""")
def _(spark, sf):
    df = risk_events(spark, sf).select("event_id", "value", "k")
    return rounded(features.Standardizer(("value", "k"), ddof=0).fit(df).transform(df)
                   .drop("value", "k"))


@query("d10_scaled_vector", f"""WITH {RISK_EVENTS}, whole AS (SELECT * FROM risk WHERE k IS NOT NULL),
m AS (SELECT avg(value) AS mv, stddev_samp(value) AS sv, avg(k) AS mk, stddev_samp(k) AS sk FROM whole)
SELECT event_id, round((value - mv) / sv, 6) + 0.0 AS slot0, round((k - mk) / sk, 6) + 0.0 AS slot1
FROM whole, m""")
def _(spark, sf):
    df = features.assemble(risk_events(spark, sf), ["value", "k"])
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    slots = vector_to_array("features")
    return rounded(scaler.fit(df).transform(df).select(
        "event_id", slots[0].alias("slot0"), slots[1].alias("slot1")))


# ---- the whole preparation ------------------------------------------------------------------

EVENT_SPEC = DatasetSpec(label="y", key="event_id", zero_as_missing=("k",), drop=("event_type",),
                         interactions=(("value", "k"),), log_columns=("value",))
CATEGORY_SPEC = DatasetSpec(label="y", key="event_id", zero_as_missing=("k",),
                            categorical=("cat",), drop=("event_type",),
                            interactions=(("value", "k"),), log_columns=("value",))

PREPARED = """med AS (SELECT y, quantile_cont(k, 0.5) AS m FROM risk GROUP BY y),
filled AS (SELECT event_id, y, value, coalesce(CAST(k AS DOUBLE), m) AS k FROM risk JOIN med USING (y)),
n AS (SELECT y, count(*) AS c FROM risk GROUP BY y)"""


@query("prepare_table", f"""WITH {RISK_EVENTS}, {PREPARED}
SELECT event_id, y, value, k, round(value * k, 6) AS value_x_k, round(ln(value + 1), 6) AS value_log,
  round((SELECT sum(c) FROM n) / ((SELECT count(*) FROM n) * c), 6) AS _class_weight
FROM filled JOIN n USING (y)""")
def _(spark, sf):
    df = events_raw(spark, sf)
    model = Preparation(EVENT_SPEC, class_medians=True, exact=True).fit(df)
    return rounded(model.transform(df))


@query("prepare_then_balance", f"""WITH {RISK_EVENTS}, {PREPARED}
SELECT y, any_value(CASE y WHEN 0 THEN 'Negative' ELSE 'Positive' END) AS class_name,
  count(*) AS n_rows, round(avg(k), 4) AS mean_k, round(sum(c0.w), 2) AS total_weight
FROM filled JOIN (SELECT y, (SELECT sum(c) FROM n) / ((SELECT count(*) FROM n) * c) AS w FROM n) c0
USING (y) GROUP BY y""")
def balance(spark, sf):
    df = events_raw(spark, sf)
    ready = Preparation(EVENT_SPEC, class_medians=True, exact=True).fit(df).transform(df)
    named = F.when(F.col("y") == 0, EVENT_SPEC.label_names[0]).otherwise(EVENT_SPEC.label_names[1])
    return ready.groupBy("y").agg(
        F.min(named).alias("class_name"), F.count("*").alias("n_rows"),
        F.round(F.avg("k"), 4).alias("mean_k"),
        F.round(F.sum("_class_weight"), 2).alias("total_weight"))
