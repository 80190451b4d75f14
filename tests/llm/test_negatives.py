"""Hard negatives against plain code: ties, repeated ids, unusable rows, empty tables."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import negatives
from riskframe.llm.negatives import Columns, best_in_windows, best_of_label, hard_negatives
from riskframe.llm.queries import QUERIES

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, anchors, positives=5, wanted=3, low=50, high=95):
    kept = {}
    for i, v, y in rows:
        if i is None or v is None or y is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        whole = [int(np.floor(256 * x)) for x in v]
        kept[i] = min(kept.get(i, (y, whole)), (y, whole))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a in sorted(set(anchors) & set(kept)):
        y, v = kept[a]
        scored = sorted((-dot(v, w), i, z) for i, (z, w) in kept.items() if i != a)
        for s, p, _ in [x for x in scored if x[2] == y][:positives]:
            inside = [x for x in scored if x[2] != y and low * -s <= 100 * -x[0] <= high * -s]
            out += [(a, p, n + 1, i, -s, -t) for n, (t, i, _) in enumerate(inside[:wanted])]
    return sorted(out)


def made(n, dims, seed):
    rng = random.Random(seed)
    return [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 1.0, 1.5]) for _ in range(dims)], rng.randrange(3)) for i in range(n)]


@pytest.mark.parametrize("block, group", [(16_384, 1_024), (64, 4)])
def test_against_plain_code(spark, monkeypatch, block, group):
    monkeypatch.setattr(negatives, "BLOCK", block)
    monkeypatch.setattr(negatives, "GROUP", group)
    rows = made(400, 20, 1) + [(7, [9.0] * 20, 2), (7, [9.0] * 20, 2), (20, [0.1], 1), (401, None, 1), (402, [1.0, None], 1),
                               (403, [float("nan")], 1), (404, [float("inf")], 1), (405, [1.0], None), (None, [1.0], 1), (406, [], 0)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in ("id", "vec", "k", "_block", "score")})
    anchors = [*range(0, 400, 20), 7, 401, 402, 405, 406, 9999]
    asked = spark.createDataFrame([(a,) for a in [*anchors, 0, None]], "vec_id long")
    got = hard_negatives(df, asked)
    want = plain(rows, anchors)
    assert sorted(map(tuple, got.collect())) == want and len(want) > 50
    assert hard_negatives(df.limit(0), asked).count() == 0 and hard_negatives(df, asked.limit(0)).count() == 0


def test_one_label_has_no_negatives(spark):
    df = spark.createDataFrame([(i, v, 1) for i, v, _ in made(30, 4, 2)], SCHEMA)
    assert hard_negatives(df, df).count() == 0


def test_scan_drops_rows_and_keeps_exact_scores():
    rng = np.random.default_rng(3)
    data = np.floor(256 * rng.normal(size=(5000, 64)) / (1 + np.arange(64)))
    held = Columns(np.arange(5000), rng.integers(0, 4, 5000), data)
    anchor, label = data[17], int(rng.integers(0, 4))
    seen = []
    scan = Columns.scan

    class Watched(Columns):
        def scan(self, a, alive, needed):
            def watched(low, high):
                keep = needed(low, high)
                seen.append(int(keep.sum()))
                return keep
            return scan(self, a, alive, watched)
    watched = Watched(np.arange(5000), held.labels[np.argsort(held.ids)], data)
    scores = data @ anchor
    want = sorted((-scores[i], i) for i in range(5000) if watched.labels[np.argsort(watched.ids)][i] == label and i != 17)[:5]
    assert best_of_label(watched, 17, label, anchor, 5) == [(i, int(-s)) for s, i in want]
    assert seen[-1] < 100  # most rows are dropped before their last columns
    top = -want[0][0]
    windows = [(int(top * 0.5), int(top * 0.95)), (5, 4)]
    inside = sorted((-s, i) for i, s in enumerate(scores) if windows[0][0] <= s <= windows[0][1]
                    and watched.labels[np.argsort(watched.ids)][i] != label)[:3]
    assert best_in_windows(watched, label, anchor, windows, 3) == [[(i, int(-s)) for s, i in inside], []]


def test_query_against_plain_code(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"])
            for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = QUERIES["op11_bond_negatives"](spark, sf_dir).collect()
    assert sorted(map(tuple, got)) == plain(rows, [r[0] for r in rows if r[0] % 50 == 0])
