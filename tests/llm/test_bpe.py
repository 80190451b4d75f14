"""Encoding and decoding against the tokenizers library."""

import hashlib
import json
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from riskframe.llm import bpe
from riskframe.llm.bpe import Coder, Decoder, PrefixTable, Remembered, decode_ids, encode_texts
from riskframe.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.json")
EDGES = ["", " ", "  ", " a", "a ", "a  b", " a\n b", "a\n\n b", "x<|endoftext|>y z <|endoftext|>", "<|endoftext|>",
         "<|endoftext|><|endoftext|> <|endof", "a" * 300, "aaa aaaa aaaaa", "don't we'll'llx I'VE", "  x \x1c y", "\x85 a",
         "日本語 テキスト 🙂🙂 é", "՘ ֋ a꟎ 𐡀", "a\x00b c", " x 　 y", "lorem ipsum " * 5000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return np.array(library.encode(text or "", add_special_tokens=False).ids, "<u4").tobytes()


def test_coder_is_the_library(library):
    rng = random.Random(1)
    texts = list(EDGES)
    texts += ["".join(rng.choice("aab  tthe\n'sé日🙂1200__--!!\t ſß\x1c") for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0xd7ff), rng.randint(0xe000, 0x10ffff), 32, 97])) for _ in range(30))
              for _ in range(500)]
    texts += [library.decode([rng.randrange(50256) for _ in range(8)]) for _ in range(1500)]
    coder, decoder = Coder(PATH), Decoder(PATH)
    for text, got in zip(texts, coder.encode(texts), strict=True):
        assert got == ids(library, text), text
        assert decoder.decode(got) == library.decode(np.frombuffer(got, "<u4").tolist(), skip_special_tokens=False)


def test_every_token_is_its_own_encoding():
    with open(PATH, encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    table = Coder.at(PATH).table
    assert all(table.ids(name) == [token] for name, token in vocabulary.items())


def test_unreachable_tokens_and_ties():
    """'abc' comes from ('a', 'bc'), but 'ab' is merged first: it never appears."""
    names = ["a", "b", "c", "ab", "bc", "abc", "aa", "aaa"]
    vocabulary = {n: i for i, n in enumerate(names)}
    merges = [("a", "b"), ("b", "c"), ("a", "bc"), ("a", "a"), ("aa", "a")]
    table = PrefixTable(vocabulary, merges)

    def plain(word):
        parts = list(word)
        while True:
            pairs = [(merges.index(p), i) for i, p in enumerate(zip(parts, parts[1:])) if p in merges]
            if not pairs:
                return [vocabulary[p] for p in parts]
            _, i = min(pairs)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
    rng = random.Random(2)
    for _ in range(2000):
        word = "".join(rng.choice("aabc") for _ in range(rng.randint(1, 12)))
        assert table.ids(word) == plain(word), word


def test_memory_stays_bounded(library, monkeypatch):
    coder = Coder(PATH)
    coder.words, coder.chunks, coder.table.pairs = Remembered(50), Remembered(50), Remembered(50)
    rng = random.Random(4)
    for _ in range(20):
        texts = [" ".join("".join(rng.choice("abcdeht") for _ in range(6)) for _ in range(20)) for _ in range(5)]
        assert list(coder.encode(texts)) == [ids(library, t) for t in texts]
        assert len(coder.chunks.young) + len(coder.chunks.old) < 400
        assert len(coder.table.pairs.young) <= 51


def test_rows(spark, library):
    rows = [(1, "a b"), (1, "a b"), (None, "x"), (2, None), (3, ""), *((10 + i, t) for i, t in enumerate(EDGES))]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit("clash") for c in ("ids", "_text", "decoded")})
    coded = encode_texts(df, PATH)
    assert coded.columns == ["doc_id", "ids"]
    got = decode_ids(coded, PATH).collect()
    assert sorted((r["doc_id"] or 0, bytes(r["ids"]), r["decoded"]) for r in got) == \
        sorted((k or 0, ids(library, t), t or "") for k, t in rows)
    assert encode_texts(df.limit(0), PATH).count() == 0
    with pytest.raises(ValueError, match="already"):
        decode_ids(coded.withColumn("decoded", F.lit(1)), PATH)
    odd = spark.createDataFrame([(None,), (np.array([50256, 99999, 220], "<u4").tobytes(),), (np.array([130], "<u4").tobytes(),)], "ids binary")
    assert [r["decoded"] for r in decode_ids(odd, PATH).collect()] == [None, "<|endoftext|> ", "�"]


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="byte-level"):
        Coder(public_tokenizers.path("word_bpe_49k.json"))


def test_query_against_the_library(spark, library, sf_dir, monkeypatch):
    monkeypatch.setattr(bpe, "ROWS", 64)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = QUERIES["op12_prefix_bpe"](spark, sf_dir).collect()
    assert len(got) == len(docs)
    for r in got:
        text = docs[r["doc_id"]]
        want = ids(library, text)
        assert (r["n_tokens"], r["ids_sha256"]) == (len(want) // 4, hashlib.sha256(want).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((text or "").encode()).hexdigest()
