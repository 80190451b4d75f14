"""Queries: the whole jobs, trial chain and explore view, over the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from riskcheck.modelling import MODEL_SPEC, model_events
from riskcheck.registry import RISK_EVENTS, query, risk_events
from riskframe.operators.features import add_flags, add_powers, add_ratios
from riskframe.plans.explore import explore
from riskframe.plans.trial import run_trial


def derived(df):
    df = add_ratios(df, {"value_by_k": ("value", "k")})
    return add_flags(add_powers(df, {"value_sq": ("value", 2)}), {"high": ("value", ">", 60)})


def trial(spark, sf):
    return run_trial(risk_events(spark, sf), "event_id", "y", derived)


@query("trial_chain")
def _(spark, sf):
    return trial(spark, sf).report


@query("trial_chain_rows", f"""WITH {RISK_EVENTS},
sized AS (SELECT y, count(*) AS n, CAST(floor(0.2 * count(*) + 0.5) AS BIGINT) AS tested FROM risk GROUP BY y)
SELECT 'test' AS side, y, tested AS n_rows FROM sized
UNION ALL SELECT 'train', y, (SELECT max(n - tested) FROM sized) FROM sized""")
def _(spark, sf):
    """Rows by side and class: the test side as it is, the training side balanced."""
    done = trial(spark, sf)
    count = lambda df, side: df.groupBy("y").agg(F.count("*").alias("n_rows")).select(F.lit(side).alias("side"), "y", "n_rows")
    return count(done.training, "train").unionByName(count(done.predictions, "test"))


@query("explore_view", """WITH ev AS (SELECT *, CAST(event_type = 'error' AS INTEGER) AS y, lower(dayname(ts)) AS weekday FROM events)
SELECT 'rows' AS part, '' AS name, '' AS class, count(*) AS n_rows FROM ev
UNION ALL SELECT 'class', '', CAST(y AS VARCHAR), count(*) FROM ev GROUP BY y
UNION ALL SELECT 'weekday', weekday, '', count(*) FROM ev GROUP BY weekday
UNION ALL SELECT 'weekday', weekday, CAST(y AS VARCHAR), count(*) FROM ev GROUP BY weekday, y""")
def _(spark, sf):
    """The counts of the view: rows, classes, categories, categories by class."""
    seen = explore(model_events(spark, sf), MODEL_SPEC)
    line = lambda df, part, name, cls, n: df.select(
        F.lit(part).alias("part"), name.cast("string").alias("name"), cls.cast("string").alias("class"), n.alias("n_rows"))
    none = F.lit("")
    crossed = seen.breakdown("weekday")
    classes = [c for c in crossed.columns if c != "weekday"]
    return (line(seen.overview(), "rows", none, none, F.col("n_rows"))
            .unionByName(line(seen.balance(), "class", none, F.col("y"), F.col("n_rows")))
            .unionByName(line(seen.distribution("weekday"), "weekday", F.col("weekday"), none, F.col("n_rows")))
            .unionByName(line(crossed.unpivot("weekday", classes, "cls", "n").where("n > 0"), "weekday",
                              F.col("weekday"), F.col("cls"), F.col("n"))))
