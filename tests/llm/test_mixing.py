"""Rates run to their end with the defaults."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm.mixing import fit_rates

DOMAINS = ["a", "b", "c", "d"]


def members_of(spark):
    rng = random.Random(6)
    rows = []
    for _ in range(1500):
        raw = [rng.gammavariate(s, 1.0) + 1e-3 for s in rng.choice([(4, 1, .5, .3), (1, 3, .3, .5), (.6, .6, 1, .8)])]
        rows.append((rng.randint(20, 800), [x / sum(raw) for x in raw]))
    return rows, spark.createDataFrame(rows, "tokens long, posteriors array<double>").coalesce(2)


def totals_of(members, rates):
    got = members.select("tokens", "posteriors", rates.of(F.col("posteriors")).alias("r")).collect()
    return np.array([sum(x["r"] * x["tokens"] * x["posteriors"][d] for x in got) for d in range(4)])


def test_defaults_meet_reachable_targets(spark):
    _, members = members_of(spark)
    rates = fit_rates(members, dict(zip(DOMAINS, (0.4, 0.4, 0.1, 0.1))), DOMAINS)
    totals = totals_of(members, rates)
    assert rates.met and rates.reached == pytest.approx(totals.tolist())
    assert abs(totals - np.array(rates.wanted)).max() <= 1e-4 * sum(rates.wanted)


def test_defaults_end_no_worse_than_a_long_plain_gradient(spark):
    rows, members = members_of(spark)
    with pytest.warns(UserWarning, match="not met"):
        rates = fit_rates(members, dict(zip(DOMAINS, (0.5, 0.5, 0.0, 0.0))), DOMAINS)
    tokens, p = np.array([t for t, _ in rows], float), np.array([q for _, q in rows])
    have, want, r = tokens @ p, np.array(rates.wanted), np.ones(len(rows))
    for _ in range(5_000):
        r = np.maximum(0.0, r - p @ (((r * tokens) @ p - want) / have))
    assert not rates.met
    loss = lambda totals: float(((totals - want) ** 2 / have).sum())
    assert loss(totals_of(members, rates)) <= loss((r * tokens) @ p)
