import random
import re
import zlib

import numpy as np
import pytest

from riskframe.llm.packing import ALIKE, LONG, Encoder, _best_fit, pack_documents, plan_bins

P = pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(P.path("byte_bpe_50k.json"))


def test_encoder_equals_tokenizer(tokenizer):
    texts = ["", " ", "a  b", " lead", "trail ", "q\n z", "u \n v", "don't  x's", "a'\tb c\n", "é ü",
             "a  b", "x" * 500 + " y", "<|endoftext|> a <|endoftext|>b"]
    want = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    encoder = Encoder(P.path("byte_bpe_50k.json"))
    assert list(encoder.encode(texts)) == want
    assert list(encoder.encode(texts[::-1])) == want[::-1]


def test_faster_merges_equal_the_tokenizer(tokenizer):
    encoder = Encoder(P.path("byte_bpe_50k.json"))
    assert encoder.fast is not None
    inside = [c for c in map(chr, range(0x10000)) if re.match(f"[{ALIKE}]", c) and c != "<"]
    assert len(inside) > 20_000
    texts = [f"a{c}b {c}c {c}{c}1{c}1 {c}\n{c} 's{c}'t  {c}  " for c in inside]
    rng = random.Random(8)
    texts += ["".join(rng.choice(pool) for _ in range(rng.randint(1, 300))) for _ in range(400)
              for pool in ("abcdefghijklmnopqrstuvwxyz  ", " \n\t\x0b\x85\xa0ab1.'s", "".join(rng.sample(inside, 40)))]
    texts += sorted(tokenizer.get_vocab())[:50_000:7]  # spelled tokens
    texts += [tokenizer.decode([i]) for i in range(0, 50_256, 5)]
    texts += ["x" * (LONG + d) + " y" for d in (0, 1)] + ["a" + " " * (LONG + d) + "b" for d in (0, 3)]
    texts += ["ab " * 40_000, "xyz" * 50_000, " " * 50_000, "a < b", "<|endoftext|>"]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    got = list(encoder.encode(texts))
    assert [t for t, a, b in zip(texts, got, want) if a != b] == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_holds_every_piece_and_wastes_little(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(512, rng.lognormal(4.5, 1, 3000).astype(int) + 1)
    histogram = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
    plan, held = plan_bins(histogram, 512), {}
    for config, bins in plan:
        assert bins > 0 and sum(n * k for n, k in config) <= 512
        for n, k in config:
            held[n] = held.get(n, 0) + k * bins
    assert held == histogram
    assert sum(b for _, b in plan) <= -(-lengths.sum() // 512) * 1.01 + 1


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("pieces", [40, 900, 60_000])
def test_plan_never_needs_more_than_best_fit(seed, pieces):
    rng = np.random.default_rng(100 + seed)
    lengths = np.minimum(2048, rng.lognormal(5.5, 0.4 + 0.2 * seed, pieces).astype(int) + 1)
    counts = np.bincount(lengths, minlength=2049)
    plan = plan_bins({int(n): int(counts[n]) for n in np.flatnonzero(counts)}, 2048)
    needed = sum(b for _, b in plan)
    assert -(-lengths.sum() // 2048) <= needed <= sum(b for _, b in _best_fit(counts.copy(), 2048))


def test_plan_edges():
    assert plan_bins({}, 8) == []
    assert sum(b for _, b in plan_bins({8: 3, 5: 2, 3: 2}, 8)) == 5
    with pytest.raises(ValueError):
        plan_bins({9: 1}, 8)


def test_packed_documents(spark, tokenizer):
    rows = [(1, "one two three " * 40, 5), (2, None, 6), (3, "", 7), (None, "no key", 8), (4, "same", 9),
            (4, "same", 9), (5, "word " * 700, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length long")
    got = pack_documents(df, P.path("byte_bpe_50k.json"), capacity=64, with_ids=True).collect()
    whole = {}
    for r in sorted(got, key=lambda r: (r["doc_id"] or 0, r["piece"])):
        assert len(r["ids"]) == r["length"] <= 64
        assert zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"]
        whole.setdefault(r["doc_id"], []).extend(r["ids"])
    for key, text, _ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        assert whole[key] == ids * (2 if key == 4 else 1)
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for spans in places.values():
        end = 0
        for offset, length in sorted(spans):
            assert offset == end
            end += length
        assert end <= 64
    assert all(r["piece"] == 0 or r["start"] > 0 for r in got)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(df, P.path("byte_bpe_50k.json")).count() == 0
