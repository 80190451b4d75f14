"""Near duplicates among many texts that share one passage but little else."""

import random

import pytest

from riskframe.llm import neardup


def words(rng, n):
    return ["".join(rng.choice("abcdefghijklmnop") for _ in range(5)) for _ in range(n)]


def crowd_texts():
    rng = random.Random(3)
    passage = words(rng, 40)
    texts = [" ".join(passage + words(rng, 40)) for _ in range(400)]
    for i in range(0, 60, 3):  # a near copy of a few
        own = texts[i].split()
        own[50 + i % 20] = "other"
        texts.append(" ".join(own))
    return texts


def plain_components(texts, size=4):
    sets = [{tuple(w[j:j + size]) for j in range(max(1, len(w) - size + 1))} for w in (t.split() for t in texts)]
    top = list(range(len(texts)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i
    for i in range(len(texts)):
        for j in range(i):
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                top[max(a, b)] = min(a, b)
    return {i: find(i) for i in range(len(texts))}


@pytest.fixture
def written(monkeypatch):
    counts, stored = {}, neardup.stored

    def counted(df, name):
        out = stored(df, name)
        counts[name] = out.count()
        return out
    monkeypatch.setattr(neardup, "stored", counted)
    return counts


def test_a_crowd_is_not_paired_out(spark, written):
    texts = crowd_texts()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r["component"] for r in neardup.near_duplicates(df, shingle=4).collect()}
    assert got == plain_components(texts)
    assert written["crowds"] > 100
    assert written["proposed"] < 8 * len(texts)  # pairing out proposes 27097


def test_the_rarest_shingles_lose_no_pair(spark):
    """Without hubs every similar pair is proposed, also for a key with two texts."""
    rng = random.Random(5)
    texts = []
    for _ in range(4):
        core = words(rng, 30)
        for _ in range(12):
            own = list(core)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = words(rng, 1)[0]
            texts.append(" ".join(own))
    texts += ["one two", "one two"]
    rows = [*enumerate(texts), (0, texts[13])]
    df = spark.createDataFrame(rows, "key long, text string")
    members = df.select("key", df["key"].alias("hub"), df["key"].alias("component")).distinct()
    found = {tuple(r) for r in neardup._of_crowds(members, df, 0.8, 4).collect()}
    sets = [(k, {tuple(t.split()[j:j + 4]) for j in range(max(1, len(t.split()) - 3))}) for k, t in rows]
    similar = {(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 80 * len(x | y)}
    assert similar and similar <= found
