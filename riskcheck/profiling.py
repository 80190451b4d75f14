"""Queries: profiles and evaluation."""

from __future__ import annotations

from riskcheck.registry import (JUDGED_EVENTS, MESSY_EVENTS, RISK_EVENTS, RISK_LINEITEM,
                                judged_events, messy_events, query, risk_events, risk_lineitem,
                                rounded)
from riskframe.operators import evaluate, profile

# ---- profiles -------------------------------------------------------------------------------


@query("p1_overview", f"""WITH {RISK_EVENTS}
SELECT count(*) AS n_rows, 2 AS n_numeric, 1 AS n_categorical, CAST(sum(y) AS BIGINT) AS n_positive,
  CAST(count(*) - sum(y) AS BIGINT) AS n_negative FROM risk""")
def _(spark, sf):
    return profile.overview(risk_events(spark, sf), "y", ["event_type"], exclude=["event_id"])


def _describe(c):
    return f"""SELECT '{c}' AS feature, count({c}) AS n, round(avg({c}), 2) AS mean,
  round(stddev_samp({c}), 2) AS std, round(CAST(min({c}) AS DOUBLE), 2) AS min,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 2) AS q25,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 2) AS q50,
  round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 2) AS q75,
  round(CAST(max({c}) AS DOUBLE), 2) AS max FROM risk"""


@query("p2_describe", f"WITH {RISK_EVENTS} " + " UNION ALL ".join(map(_describe, ["value", "k"])))
def _(spark, sf):
    return profile.describe_numeric(risk_events(spark, sf), ["value", "k"], exact=True)


@query("p2_describe_lineitem", f"WITH {RISK_LINEITEM} " + " UNION ALL ".join(
    map(_describe, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])))
def _(spark, sf):
    return profile.describe_numeric(
        risk_lineitem(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], exact=True)


@query("p2_describe_approximate")
def _(spark, sf):
    return profile.describe_numeric(
        risk_lineitem(spark, sf), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("p3_value_counts", f"""WITH {MESSY_EVENTS}
SELECT cat, count(*) AS n_rows FROM messy WHERE cat IS NOT NULL GROUP BY cat""")
def _(spark, sf):
    return profile.value_counts(messy_events(spark, sf), "cat")


@query("p4_histogram", f"""WITH {RISK_EVENTS},
b AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 30 AS w FROM risk),
h AS (SELECT least(CAST(floor(30 * (value - lo) / (hi - lo)) AS INTEGER) + 1, 30) AS bin,
  count(*) AS n FROM risk, b WHERE value IS NOT NULL GROUP BY 1)
SELECT CAST(i AS INTEGER) AS bin, round(lo + (i - 1) * w, 6) AS low, round(lo + i * w, 6) AS high,
  coalesce(n, 0) AS n_rows FROM b, range(1, 31) t(i) LEFT JOIN h ON h.bin = i""")
def _(spark, sf):
    return rounded(profile.histogram(risk_events(spark, sf), "value"))


PAIRS = [("value", "value"), ("value", "k"), ("value", "y"), ("k", "value"), ("k", "k"), ("k", "y"),
         ("y", "value"), ("y", "k"), ("y", "y")]


@query("p5_correlation", f"WITH {RISK_EVENTS} " + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM risk" for a, b in PAIRS))
def _(spark, sf):
    return rounded(profile.correlation(risk_events(spark, sf), ["value", "k", "y"]))


@query("p6_class_balance", f"""WITH {RISK_EVENTS}
SELECT y, CASE y WHEN 0 THEN 'No Error' WHEN 1 THEN 'Error' END AS class_name, count(*) AS n_rows
FROM risk GROUP BY y""")
def _(spark, sf):
    return profile.class_balance(risk_events(spark, sf), "y", {0: "No Error", 1: "Error"})


@query("p7_crosstab", f"""WITH {MESSY_EVENTS}
SELECT cat, count(*) FILTER (y = 0) AS "0", count(*) FILTER (y = 1) AS "1" FROM messy
WHERE cat IS NOT NULL GROUP BY cat""")
def _(spark, sf):
    return profile.crosstab(messy_events(spark, sf), "cat", "y")


@query("p8_train_distribution", f"""WITH {RISK_EVENTS}
SELECT y, count(*) AS n_rows, round(count(*) * 100.0 / (SELECT count(*) FROM risk), 6) AS percent
FROM risk GROUP BY y""")
def _(spark, sf):
    return rounded(profile.class_share(risk_events(spark, sf), "y"))


@query("p9_melt_features", f"""WITH {RISK_EVENTS}
SELECT event_id, 'k' AS feature, CAST(k AS VARCHAR) AS value, 'numeric' AS kind FROM risk
UNION ALL SELECT event_id, 'y', CAST(y AS VARCHAR), 'numeric' FROM risk
UNION ALL SELECT event_id, 'event_type', event_type, 'categorical' FROM risk""")
def _(spark, sf):
    return profile.melt(risk_events(spark, sf), ["k", "y"], ["event_type"], ids=["event_id"])


# ---- evaluation -----------------------------------------------------------------------------

PER_CLASS = JUDGED_EVENTS + """,
conf AS (SELECT CAST(y AS DOUBLE) AS l, prediction AS p, count(*) AS n FROM judged GROUP BY ALL),
per AS (SELECT cls, sum(n) FILTER (l = cls) AS support, sum(n) FILTER (p = cls) AS claimed,
    coalesce(sum(n) FILTER (l = cls AND p = cls), 0) AS hits
  FROM conf, (SELECT l AS cls FROM conf UNION SELECT p FROM conf) GROUP BY cls),
scores AS (SELECT cls, coalesce(support, 0) AS support, hits,
  coalesce(hits / nullif(claimed, 0), 0) AS pr, coalesce(hits / nullif(support, 0), 0) AS re,
  coalesce(2.0 * hits / (coalesce(claimed, 0) + coalesce(support, 0)), 0) AS f FROM per)"""


@query("e1_classification_metrics", f"""WITH {PER_CLASS}
SELECT round(sum(hits) / sum(support), 6) AS accuracy, round(sum(f * support) / sum(support), 6) AS f1,
  round(sum(pr * support) / sum(support), 6) AS weighted_precision,
  round(sum(re * support) / sum(support), 6) AS weighted_recall,
  count(*) FILTER (support > 0) AS n_classes, CAST(sum(support) AS BIGINT) AS n_rows FROM scores""")
def _(spark, sf):
    return rounded(evaluate.evaluate(judged_events(spark, sf), "y"))


@query("e2_auc_roc", f"""WITH {JUDGED_EVENTS},
per AS (SELECT score, count(*) FILTER (y = 1) AS p, count(*) FILTER (y = 0) AS n FROM judged GROUP BY score),
run AS (SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS under FROM per)
SELECT round(CAST(sum(p * (under + n / 2.0)) AS DOUBLE) / (sum(p) * sum(n)), 6) AS auc_roc FROM run""")
def _(spark, sf):
    value = evaluate.auc(judged_events(spark, sf), "y", "score")
    return rounded(spark.createDataFrame([(value,)], "auc_roc double"))


@query("e2_auc_pr", f"""WITH {JUDGED_EVENTS},
per AS (SELECT score, count(*) FILTER (y = 1) AS p, count(*) AS n FROM judged GROUP BY score),
run AS (SELECT score, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS seen,
  (SELECT sum(p) FROM per) AS pos FROM per),
curve AS (SELECT score, tp / pos AS recall, tp / seen AS prec,
  coalesce(lag(tp / pos) OVER w, 0) AS r0, coalesce(lag(tp / seen) OVER w, tp / seen) AS p0
  FROM run WINDOW w AS (ORDER BY score DESC))
SELECT round(sum((recall - r0) * (prec + p0) / 2), 6) AS auc_pr FROM curve""")
def _(spark, sf):
    value = evaluate.auc(judged_events(spark, sf), "y", "score", curve="pr")
    return rounded(spark.createDataFrame([(value,)], "auc_pr double"))


@query("e3_label_presence", f"WITH {JUDGED_EVENTS} SELECT y, count(*) AS n_rows FROM judged GROUP BY y")
def _(spark, sf):
    return evaluate.label_presence(judged_events(spark, sf), "y")


@query("e4_classification_report", f"""WITH {PER_CLASS}
SELECT CAST(CAST(cls AS INTEGER) AS VARCHAR) AS row, round(pr, 6) AS precision, round(re, 6) AS recall,
  round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM scores
UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6),
  round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'macro avg', round(avg(pr), 6), round(avg(re), 6), round(avg(f), 6),
  CAST(sum(support) AS BIGINT) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(pr * support) / sum(support), 6),
  round(sum(re * support) / sum(support), 6), round(sum(f * support) / sum(support), 6),
  CAST(sum(support) AS BIGINT) FROM scores""")
def _(spark, sf):
    return rounded(evaluate.classification_report(judged_events(spark, sf), "y"))


@query("e5_accuracy", f"""WITH {JUDGED_EVENTS}
SELECT round(avg(CAST(y = prediction AS INTEGER)), 6) AS accuracy FROM judged""")
def _(spark, sf):
    return rounded(evaluate.accuracy(judged_events(spark, sf), "y"))
