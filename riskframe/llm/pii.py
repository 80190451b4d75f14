"""Personal data by weak supervision, with DataFrame functions only.

Base kinds are patterns with checks. Weaker candidates (long numbers, titled names,
spelled-out addresses) and the base ones are judged by labelers that vote yes, no or
nothing: strict form, usual shape, a gazetteer, words before, and signs against.
Expectation-maximisation over the table of vote patterns estimates how far each
labeler can be trusted, and its beliefs train a logistic classifier on the
candidates' plain features, which decides about the weaker ones.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.mixing import bound
from riskframe.sources.tables import stored

#: Base kinds and their patterns. Possessive forms match the same as greedy
#: ones here, since what follows cannot start inside, and take no stack.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?+[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: Weaker candidates.
WEAK = {
    "number": r"(?<![0-9])[0-9]{8,19}(?![0-9])",
    "name": r"(?:\b(?:Mr|Mrs|Ms|Dr|Prof)\.? |\b(?:Herr|Frau|Monsieur|Madame|Señor|Señora) )\p{Lu}\p{L}+(?: \p{Lu}\p{L}+)?",
    "spelled": r"[A-Za-z0-9._%+-]{1,64} ?[\[(](?:at|AT)[\])] ?[A-Za-z0-9-]{1,64}(?: ?[\[(](?:dot|DOT)[\])] ?[A-Za-z0-9-]{1,64})+",
}
KINDS = [*BASE, *WEAK]
#: What a text must contain for a pattern to be tried.
NEEDS = {"email": "@", "phone": "+"}
#: The same as a pattern, where one is needed.
ASKED = {"name": r"\.? \p{Lu}", "spelled": r"[\[(](?:at|AT)[\])]"}
#: Gazetteer of mail and site endings, and given names.
ENDINGS = "com|org|net|edu|gov|io|de|fr|es|uk|eu"
NAMES = "Anna|Maria|Peter|Hans|Jean|Marie|Pierre|Juan|Jose|Carlos|John|Mary|James|David|Paul|Laura"
#: Words before personal data, and before other numbers.
BEFORE = r"(?i)(?:call|tel|phone|fax|mobile|mail|e-mail|email|contact|card|visa|account|iban|ssn|ip|address|write to|sincerely)\W{0,4}(?:\w{1,8}\W{0,3})?$"
AGAINST = r"(?i)(?:version|order|item|page|part|isbn|id|no|nr|#|\$|€|v)[.:# ]{0,3}$"
LABELERS = 5


def found_spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, match) of a pattern, in code points, leftmost first."""
    def laid(both: Column) -> Column:
        pairs = F.zip_with(F.slice(both["gaps"], F.lit(1), F.size(both["hits"])), both["hits"],
                           lambda g, h: F.struct(F.length(g).cast("long").alias("gap"), h.alias("hit")))
        empty = F.struct(F.lit(0).cast("long").alias("at"),
                         F.array().cast("array<struct<start:bigint,end:bigint,hit:string>>").alias("out"))

        def put(acc: Column, x: Column) -> Column:
            start = acc["at"] + x["gap"]
            end = start + F.length(x["hit"])
            return F.struct(end.alias("at"), F.concat(acc["out"], F.array(F.struct(
                start.alias("start"), end.alias("end"), x["hit"].alias("hit")))).alias("out"))
        return F.aggregate(pairs, empty, put, lambda acc: acc["out"])
    return bound(F.struct(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("hits"),
                          F.split(text, pattern, -1).alias("gaps")), laid)


def luhn(digits: Column) -> Column:
    """Whether a run of digits passes the check sum."""
    backward = F.transform(F.split(F.reverse(digits), ""), lambda d: F.try_to_number(d, F.lit("9")).cast("int"))
    each = F.transform(F.filter(backward, lambda d: d.isNotNull()), lambda d, i: F.when(i % 2 == 0, d).otherwise(
        F.when(d > 4, 2 * d - 9).otherwise(2 * d)))
    return F.aggregate(each, F.lit(0), lambda a, d: a + d) % 10 == 0


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


#: Whether a match of a base pattern counts.
VALID: dict[str, Callable[[Column], Column]] = {
    "email": lambda h: F.lit(True),
    "ip": lambda h: h.rlike(r"^(?:0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.|$)){4}$"),
    "card": lambda h: F.length(_digits(h)).between(14, 19) & luhn(_digits(h)),
    "phone": lambda h: F.length(_digits(h)).between(10, 15),
}


def _of_kind(text: Column, kind: str) -> Column:
    """(start, order, end, kind, hit) of the valid matches of one kind."""
    spans = found_spans(text, BASE.get(kind) or WEAK[kind])
    if kind in VALID:
        spans = F.filter(spans, lambda s: VALID[kind](s["hit"]))
    told = F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("order"), s["end"].alias("end"),
        F.lit(kind).alias("kind"), s["hit"].alias("hit")))
    tried = F.contains(text, F.lit(NEEDS[kind])) if kind in NEEDS else (
        text.rlike(ASKED.get(kind, "[0-9]")))
    return F.when(tried, told).otherwise(F.array().cast(
        "array<struct<start:bigint,order:int,end:bigint,kind:string,hit:string>>"))


def _judged(text: Column, span: Column) -> Column:
    """A candidate with its votes (1, -1, 0) and plain features."""
    kind, hit = span["kind"], span["hit"]
    back = F.least(span["start"], F.lit(32).cast("long")).cast("int")
    before = F.substr(text, (span["start"] - back + 1).cast("int"), back)
    strict = F.when(kind.isin(*BASE), F.lit(1)).when((kind == "number") & (F.length(hit) >= 14), F.when(luhn(hit), 1).otherwise(-1)).otherwise(0)
    shape = (F.when((kind == "number") & ~F.length(hit).isin(9, 10, 11, 15, 16), -1)
             .when((kind == "card") & (F.length(_digits(hit)) == 16), 1)
             .when((kind == "phone") & hit.rlike(r"[ ().-]"), 1)
             .when(kind == "spelled", 1).otherwise(0))
    listed = (F.when(kind.isin("email", "spelled"), F.when(hit.rlike(rf"[.\])] ?(?:{ENDINGS})$"), 1).otherwise(-1))
              .when(kind == "name", F.when(hit.rlike(rf" (?:{NAMES})\b"), 1).otherwise(0)).otherwise(0))
    near = F.when(before.rlike(BEFORE), 1).otherwise(0)
    against = F.when(before.rlike(AGAINST), -1).otherwise(0)
    return F.struct(
        span["start"].alias("start"), span["order"].alias("order"), span["end"].alias("end"), kind.alias("kind"),
        F.array(strict, shape, listed, near, against).alias("votes"),
        F.least(F.lit(5), F.floor(F.length(hit) / 4).cast("int")).alias("size"),
        F.when(F.length(before) == 0, 0).when(before.rlike(r"[ \n]$"), 1).otherwise(2).alias("edge"))


def candidates(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, spans) with every candidate of every row, by start and kind."""
    own = df.select(F.col(f"`{key}`").alias(key), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    every = own.select(key, "_text", F.concat(*(_of_kind(F.col("_text"), k) for k in KINDS)).alias("_spans"))
    return every.select(key, F.array_sort(F.transform("_spans", lambda s: _judged(F.col("_text"), s))).alias("spans"))


def reliabilities(patterns: Sequence[tuple[tuple[int, ...], int]], rounds: int = 60):
    """(prior, [(P(yes | personal), P(yes | other))], belief by pattern) by EM over vote patterns."""
    belief = {v: min(0.95, max(0.05, 0.5 + 0.2 * sum(v))) for v, _ in patterns}
    prior, trust = 0.5, [(0.7, 0.3)] * LABELERS
    for _ in range(rounds):
        total = sum(n for _, n in patterns)
        yes = sum(n * belief[v] for v, n in patterns)
        prior = min(0.99, max(0.01, yes / max(1, total)))
        trust = []
        for j in range(LABELERS):
            cast = [(v, n) for v, n in patterns if v[j]]
            true = sum(n * belief[v] for v, n in cast)
            false = sum(n * (1 - belief[v]) for v, n in cast)
            up_true = sum(n * belief[v] for v, n in cast if v[j] > 0)
            up_false = sum(n * (1 - belief[v]) for v, n in cast if v[j] > 0)
            # a labeler starts with the trust of a few right votes
            trust.append(((up_true + 7) / (true + 10), (up_false + 3) / (false + 10)))
        for v, _ in patterns:
            odds = math.log(prior / (1 - prior))
            for vote, (t, f) in zip(v, trust):
                if vote:
                    odds += math.log(t / f) if vote > 0 else math.log((1 - t) / (1 - f))
            belief[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
    return prior, trust, belief


def train_spans(rows: Sequence[tuple[tuple[str, ...], float, int]], rounds: int = 300) -> dict[str, float]:
    """Logistic weights of named features from (features, belief, count)."""
    weights = dict.fromkeys({f for features, _, _ in rows for f in features}, 0.0)
    total = max(1, sum(n for _, _, n in rows))
    for _ in range(rounds):
        step = dict.fromkeys(weights, 0.0)
        for features, belief, n in rows:
            score = sum(weights[f] for f in features)
            off = belief - 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))
            for f in features:
                step[f] += n * off / total
        for f in weights:
            weights[f] += 2.0 * step[f] - 0.0005 * weights[f]
    return weights


def _features(span) -> tuple[str, ...]:
    return (f"kind={span['kind']}", f"size={span['size']}", f"edge={span['edge']}",
            f"kind+near={span['kind']}{span['near']}", f"against={span['against']}")


def find_personal(df: DataFrame, key: str = "doc_id", text: str = "text", sure: float = 0.5) -> DataFrame:
    """(key, spans) of every row; spans: array of (kind, start, end), by start and kind.

    Base spans always stay; weaker candidates stay if the classifier gives them
    ``sure`` or more and they are not inside a base span. Null and empty texts have
    none. Repeated rows give repeated results; extra columns are not read. The driver
    sees one row per combination of votes and features, a few thousand at most.
    """
    held = stored(candidates(df, key, text), "personal")
    seen = held.select(F.explode("spans").alias("s")).groupBy(
        "s.kind", "s.votes", "s.size", "s.edge").agg(F.count("*").alias("n")).collect()
    counts: dict[tuple[int, ...], int] = {}
    for r in seen:
        counts[tuple(r["votes"])] = counts.get(tuple(r["votes"]), 0) + r["n"]
    _, _, belief = reliabilities(sorted(counts.items()))
    weights = train_spans([(_features({**r.asDict(), "near": r["votes"][3], "against": r["votes"][4]}),
                            belief[tuple(r["votes"])], r["n"]) for r in seen])
    spans = F.filter("spans", lambda s: s["kind"].isin(*BASE) | (_score(s, weights) >= math.log(sure / (1 - sure))))
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    free = bound(F.struct(spans.alias("all"), base.alias("base")), lambda b: F.filter(
        b["all"], lambda s: s["kind"].isin(*BASE) | ~F.exists(
            b["base"], lambda x: (x["start"] < s["end"]) & (s["start"] < x["end"]))))
    return held.select(key, F.transform(free, lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"))).alias("spans"))


def _score(span: Column, weights: dict[str, float]) -> Column:
    def table(name: str, value: Column) -> Column:
        out = F.lit(0.0)
        for feature, weight in sorted(weights.items()):
            left, _, right = feature.partition("=")
            if left == name:
                out = F.when(value.cast("string") == right, weight).otherwise(out)
        return out
    near = F.concat(span["kind"], F.get(span["votes"], F.lit(3)).cast("string"))
    return (table("kind", span["kind"]) + table("size", span["size"]) + table("edge", span["edge"])
            + table("kind+near", near) + table("against", F.get(span["votes"], F.lit(4))))


def masked(text: Column, spans: Column) -> Column:
    """A text with every span replaced by its kind in brackets; overlaps by the first."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def put(acc: Column, s: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        return F.when(s["start"] >= acc["at"], F.struct(s["end"].alias("at"), F.concat(
            acc["out"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("out"))).otherwise(acc)
    return F.aggregate(spans, start, put, lambda acc: F.concat(
        acc["out"], F.substr(text, (acc["at"] + 1).cast("int"))))
