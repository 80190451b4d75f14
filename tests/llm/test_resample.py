"""Importance resampling against plain code."""

import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskframe.llm.queries import QUERIES
from riskframe.llm.resample import collapsed, draw, features, resample

WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_features(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lower)
    grams = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(g.encode()) % 10_000 for g in grams]


def plain(docs, target):
    held = [(k, *plain_features(t)) for k, t in docs]
    s, t = Counter(), Counter()
    for _, _, f in held:
        s.update(f)
    for text in target:
        t.update(plain_features(text)[1])
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s_all + 10_000) / ((s[b] + 1) * (t_all + 10_000)))) for b in range(10_000)]
    rows = []
    for k, n, f in held:
        h = int(hashlib.sha256(f"42:{'' if k is None else k}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([k, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for i, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = i + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.mark.parametrize("text", ["", None, "  ", "one", "One two", "a-b_c'd e9 É日本 x\x7fy\x00z   ſK", "a a a a a", "x " * 500])
def test_one_scan_finds_every_run(text):
    n, found = features(collapsed(text), 10_000)
    want = plain_features(text)
    assert (n, sorted(found)) == (want[0], sorted(want[1]))


def test_rows_and_edges(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho sigma tau upsilon phi".split()
    docs = [(i, " ".join(words[(i * 7 + j) % 21] for j in range(18 + i % 9))) for i in range(200)]
    docs += [(3, docs[3][1]), (None, docs[9][1]), (500, None), (501, ""), (502, "!! ??"), (503, "long words " * 30_000)]
    target = ["alpha beta gamma", None, "", "delta epsilon " * 50]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("_key", "_words", "score", "rank")})
    goal = spark.createDataFrame([(t,) for t in target], "text string").withColumn("_nothing", F.lit("clash"))
    got = resample(df, goal)
    assert sorted(map(tuple, got.collect()), key=repr) == plain(docs, target)
    assert resample(df.limit(0), goal).count() == 0
    assert sorted(map(tuple, resample(df, goal.limit(0)).collect()), key=repr) == plain(docs, [])
    taken = draw(df, goal)
    assert taken.columns == df.columns and 0 < taken.count() < 20 and draw(df.limit(0), goal).count() == 0
    with pytest.raises(ValueError, match="buckets"):
        resample(df, goal, buckets=100_000)


def test_query_against_plain_code(spark, sf_dir):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    got = QUERIES["op13_importance_resampling"](spark, sf_dir).collect()
    assert sorted(map(tuple, got), key=repr) == plain(docs, target)
