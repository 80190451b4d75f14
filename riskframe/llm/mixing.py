"""Soft-membership mixing of documents to target domain weights.

A naive Bayes classifier fitted on a labelled table gives each document the
posterior of every domain. Least squares projected to rates r >= 0 then finds the
document rates nearest to 1 whose expected tokens by domain, sum of r * tokens *
posterior, meet the targets. Such rates are one step from 1 along a gradient of one
number per domain, cut off at 0; Newton's method finds those numbers. It needs their
sums and products from one pass over the narrow table of posteriors each time, so the
driver only holds those.
"""

from __future__ import annotations

import math
import warnings
from collections.abc import Callable, Mapping, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import ascii_lower, words_of
from riskframe.sources.tables import stored

#: Words and shapes the classifier keeps, those that tell the domains apart most clearly.
VOCABULARY, SLOTS = 2_000, 16_384
#: At most this many labelled rows are used for fitting, those with the smallest key hashes.
LABELLED = 50_000
#: Documents' worth of belief that a feature is equally common in every domain.
SHRINK = 10.0
#: Evidence of a feature counts from this many standard deviations and documents on.
CLEAR, SEEN = 4.0, 5
#: A feature must be this much commoner in some domain than overall. Common words, which
#: hang together and would be counted as evidence many times over, stay out.
LIFT = 2.5


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def features_of(text: Column) -> Column:
    """The distinct words (letters, A-Z lower-cased) of a text, and its shape: size, share
    of different words, of letters, of symbols."""
    filled = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(ascii_lower(filled), "[^\\p{L}]+"), lambda w: w != "")
    symbols = F.length(F.regexp_replace(filled, "[^#*$%&|<>]+", ""))

    def with_shape(words: Column) -> Column:
        def shaped(different: Column) -> Column:
            size, chars = F.size(words) + F.lit(1.0), F.length(filled) + F.lit(1.0)
            return F.concat(different, F.array(
                _shape("size", F.log2(size)), _shape("symbols", F.lit(40.0) * symbols / chars),
                _shape("kinds", F.lit(10.0) * F.size(different) / size + F.lit(20.0) * F.floor(F.log10(size))),
                _shape("words", F.lit(40.0) * size / chars)))
        return bound(F.array_distinct(words), shaped)
    return bound(words, with_shape)


def _shape(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}="), value.cast("int").cast("string"))


class DomainModel:
    """Naive Bayes over clear features. ``posteriors`` is a plain expression."""

    def __init__(self, domains: Sequence[str], priors: Sequence[float],
                 weights: Mapping[str, tuple[int, Sequence[float]]]):
        self.domains, self.priors, self.weights = list(domains), list(priors), dict(weights)

    def posteriors(self, text: Column) -> Column:
        """An array of one probability per domain, in order."""
        if not self.weights:
            return _softmax(F.array(*map(F.lit, self.priors)))
        known = F.filter(features_of(text), lambda f: f.isin(*self.weights))

        def scored(features: Column) -> Column:
            return F.array(*(F.aggregate(features, F.lit(float(prior)), self._adding(d))
                             for d, prior in enumerate(self.priors)))
        return _softmax(bound(known, scored))

    def _adding(self, domain: int) -> Callable[[Column, Column], Column]:
        values = ["0"] * SLOTS
        for (slot, weights) in self.weights.values():
            values[slot] = f"{weights[domain]:.3f}"
        table = F.split(F.lit(" ".join(values)), " ").cast("array<double>")
        return lambda total, feature: total + F.get(table, _slot(feature))


def _slot(feature: Column) -> Column:
    return F.pmod(F.xxhash64(feature), F.lit(SLOTS)).cast("int")


def _softmax(scores: Column) -> Column:
    def shared(raised: Column) -> Column:
        return bound(F.aggregate(raised, F.lit(0.0), lambda a, x: a + x),
                     lambda total: F.transform(raised, lambda e: e / total))
    return bound(scores, lambda given: bound(F.array_max(given), lambda top: bound(
        F.transform(given, lambda s: F.exp(s - top)), shared)))


def fit_domains(df: DataFrame, labels: DataFrame, domains: Sequence[str], key: str = "doc_id",
                text: str = "text", label: str = "domain", labelled: int = LABELLED) -> DomainModel:
    """Fits on the rows of ``df`` whose key is in ``labels`` (key, label).

    Labels that are null or not in ``domains`` are left out. At most ``labelled``
    labelled rows are used, so their list may be broadcast. A domain without
    examples gets the smallest prior and no evidence.
    """
    chosen = (labels.where(F.col(label).isin(*domains) & F.col(key).isNotNull())
              .select(F.col(key).alias("_k"), F.col(label).alias("_d"))
              .orderBy(F.xxhash64("_k"), "_k", "_d").limit(labelled))
    shown = df.select(F.col(f"`{key}`").alias("_k"), F.col(f"`{text}`").alias("_t")).join(
        F.broadcast(chosen), "_k")  # at most `labelled` rows
    held = shown.select("_d", F.explode(F.concat(F.array(F.lit("")), features_of(F.col("_t")))).alias("_f"))
    seen = [F.coalesce(F.sum(F.when(F.col("_d") == d, F.col("_n"))), F.lit(0)) for d in domains]
    counts = (held.groupBy("_d", "_f").agg(F.count("*").alias("_n")).groupBy("_f")
              .agg(F.array(*seen).alias("seen"), F.sum("_n").alias("all")))
    first = counts.where("_f = ''").select("seen").first()
    sizes = first["seen"] if first else [0] * len(domains)
    total = sum(sizes)
    clear, lift = F.lit(0.0), F.lit(0.0)
    for i, size in enumerate(sizes):
        share, seen = F.col("all") / F.lit(float(max(1, total))), F.col("seen")[i]
        clear = F.greatest(clear, F.abs(seen - share * size) / F.sqrt(share * size + 1))
        lift = F.greatest(lift, (seen + SHRINK * share) / (size + SHRINK) / share)
    kept = (counts.where((F.col("_f") != "") & (F.col("all") >= SEEN)).withColumn("clear", clear)
            .where((F.col("clear") > CLEAR) & (lift > LIFT)).orderBy(F.desc("clear"), "_f").limit(VOCABULARY)
            .withColumn("slot", _slot(F.col("_f"))).collect())
    weights, priors = {}, [math.log((s + 1) / (total + len(sizes))) for s in sizes]
    for r in {r["slot"]: r for r in reversed(kept)}.values():  # of features in one slot, the clearest
        rates = [min(0.9999, (n + SHRINK * r["all"] / total) / (size + SHRINK))
                 for n, size in zip(r["seen"], sizes)]
        weights[r["_f"]] = r["slot"], [math.log(x / (1 - x)) for x in rates]
        priors = [p + math.log(1 - x) for p, x in zip(priors, rates)]  # a missing feature counts too
    return DomainModel(domains, priors, weights)


class Rates:
    """Fitted rates: the steps taken from rate 1, each projected to stay at 0 or above.

    ``wanted`` and ``reached`` are the tokens by domain, in order, and ``met`` tells
    whether they agree within the tolerance.
    """

    def __init__(self, steps: list[list[float]], wanted: Sequence[float] = (), reached: Sequence[float] = (),
                 met: bool = True):
        self.steps, self.wanted, self.reached, self.met = steps, list(wanted), list(reached), met

    def of(self, posteriors: Column, start: Column | None = None, since: int = 0) -> Column:
        rate = F.lit(1.0) if start is None else start
        for step in self.steps[since:]:
            moved = rate
            for d, g in enumerate(step):
                moved = moved - F.lit(g) * F.get(posteriors, F.lit(d))
            rate = F.greatest(F.lit(0.0), moved)
        return rate


def fit_rates(members: DataFrame, targets: Mapping[str, float], domains: Sequence[str],
              total: float | None = None, spare: float = 1.02, rounds: int = 200,
              tolerance: float = 1e-4) -> Rates:
    """Rates for ``members`` (tokens, posteriors), read once per round; give a stored table.

    ``targets`` are weights of the domains and ``total`` the tokens wanted; by
    default enough that no wanted domain has to shrink, times ``spare``. Squared
    errors count relative to what a domain holds. A price on leaving rate 1 is
    lowered until the targets are met within ``tolerance`` of the total, or, where
    no rates meet them, until a tenth of the price moves no domain's tokens by more
    than that. Targets that are not met are told with a warning.
    """
    n = len(domains)
    pairs = [(d, e) for d in range(n) for e in range(d, n)]

    def at(step: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Half the sum of squared rates, the tokens by domain, and their slopes, at a step."""
        rate = Rates([(-step).tolist()]).of(F.col("posteriors"))
        p, tokens = [F.get("posteriors", F.lit(d)) for d in range(n)], F.col("tokens").cast("double")
        rated = members.select(tokens.alias("t"), rate.alias("r"), *(c.alias(f"p{d}") for d, c in enumerate(p)))
        row = [float(x or 0.0) for x in rated.agg(
            F.sum(F.expr("t * r * r / 2")), *(F.sum(F.expr(f"t * r * p{d}")) for d in range(n)),
            *(F.sum(F.expr(f"if(r > 0, t * p{d} * p{e}, 0D)")) for d, e in pairs)).first()]
        slopes = np.zeros((n, n))
        for (d, e), x in zip(pairs, row[1 + n:]):
            slopes[d, e] = slopes[e, d] = x
        return row[0], np.array(row[1:1 + n]), slopes

    weight = sum(targets.get(d, 0.0) for d in domains)
    if weight <= 0 or min(targets.values()) < 0:
        raise ValueError("give weights of 0 or more, one of them above 0, for known domains")
    share = np.array([targets.get(d, 0.0) / weight for d in domains])
    step = np.zeros(n)
    here = at(step)
    have = here[1]
    if total is None:
        total = spare * max(h / s for h, s in zip(have, share) if s > 0)
    want, scale = total * share, np.where(have > 0, have, 1.0)
    if not have.sum():
        return Rates([], want, have, bool(max(abs(want)) <= tolerance * total))
    close, price, before, used = tolerance * total, 0.1, have, 1
    while max(abs(here[1] - want)) > close:
        def cost(step: np.ndarray, seen: tuple) -> float:
            return seen[0] + price * float(scale @ (step * step)) / 2 - float(want @ step)
        while used < rounds:
            slope = here[1] + price * scale * step - want
            if max(abs(slope)) <= close / 10:
                break
            move = -np.linalg.solve(here[2] + price * np.diag(scale), slope)
            size, gain = 1.0, float(slope @ move)
            while used < rounds:
                there, used = at(step + size * move), used + 1
                if cost(step + size * move, there) <= cost(step, here) + 1e-4 * size * gain + 1e-12 * total:
                    break
                size /= 2
            step, here = step + size * move, there
        if used >= rounds or max(abs(here[1] - before)) <= close or price < 1e-9:
            break
        before, price = here[1], price / 10
    met = bool(max(abs(here[1] - want)) <= close)
    if not met:
        told = ", ".join(f"{d} {r:.6g} of {w:.6g}" for d, r, w in zip(domains, here[1], want))
        warnings.warn(f"mixing targets are not met after {used} passes; tokens reached: {told}", stacklevel=2)
    return Rates([(-step).tolist()] if step.any() else [], want, here[1], met)


def mixing_rates(df: DataFrame, labels: DataFrame, targets: Mapping[str, float], domains: Sequence[str],
                 key: str = "doc_id", text: str = "text") -> tuple[DomainModel, Rates, DataFrame]:
    """The fitted classifier and rates, and the stored table (key, tokens, posteriors) of
    ``df`` they were fitted on. Classifier and rates also apply to any text as expressions."""
    model = fit_domains(df, labels, domains, key, text)
    members = stored(df.select(F.col(f"`{key}`").alias(key),
                               F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("tokens"),
                               model.posteriors(F.col(f"`{text}`")).alias("posteriors")), "members")
    return model, fit_rates(members, targets, domains), members


def copies_of(rate: Column, key: Column, seed: int = 42) -> Column:
    """How often to take a document: the rate, its fraction decided by the key's hash."""
    draw = (F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 11).cast("double") / F.lit(float(2 ** 53)))
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def mix(df: DataFrame, labels: DataFrame, targets: Mapping[str, float], domains: Sequence[str],
        key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, each as many times as its rate says, with the columns of ``df``.

    Null and empty texts have no tokens and the prior's posteriors, so they count for
    nothing and follow their domains' rates; a null key draws like any other value.
    """
    model = fit_domains(df, labels, domains, key, text)
    held = stored(df.select(F.struct("*").alias("_row"), F.col(f"`{key}`").alias("_k"),
                            F.size(words_of(F.col(f"`{text}`"))).cast("long").alias("tokens"),
                            model.posteriors(F.col(f"`{text}`")).alias("posteriors")), "rated")
    rates = fit_rates(held.select("tokens", "posteriors"), targets, domains)
    taken = held.select("_row", copies_of(rates.of(F.col("posteriors")), F.col("_k")).alias("_n"))
    return (taken.where("_n > 0").select("_row", F.explode(F.array_repeat(F.lit(0), F.col("_n").cast("int"))))
            .select("_row.*"))
