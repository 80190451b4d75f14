"""Grams with more contexts than a block holds."""

import random
import uuid
from collections import Counter

import pytest

from riskframe.llm import substrings
from tests.llm.test_brute_force import plain_spans


@pytest.mark.parametrize("block", [500, 6_000])
def test_no_block_outgrows_its_bound(spark, monkeypatch, tmp_path, block):
    rng = random.Random(9)
    text = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    quoted, runs = text(150), text(30)
    texts = [text(rng.randint(0, 90)) + quoted + text(rng.randint(0, 90)) for _ in range(150)]
    texts += [runs * 4 + text(20) + quoted[:rng.randint(35, 140)] + text(9) for _ in range(20)]
    texts += [texts[5], texts[5] + "x", quoted, "x" * 300, None]
    blocks, seen = substrings._blocks, str(tmp_path)

    def watched(length):
        solve = blocks(length)

        def run(batches):
            held, sizes = list(batches), Counter()
            for batch in held:
                for gram, data in zip(batch.column(0).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                    sizes[gram] += len(data) + 1
            with open(f"{seen}/{uuid.uuid4().hex}", "w") as out:
                out.write(str(max(sizes.values(), default=0)))
            yield from solve(iter(held))
        return run
    monkeypatch.setattr(substrings, "BLOCK", block)
    monkeypatch.setattr(substrings, "_blocks", watched)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: (sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), r["kept_sha256"])
           for r in substrings.repeated_spans(df, length=40).collect()}
    assert got == dict(enumerate(plain_spans(texts, 40)))
    most = max(int(p.read_text()) for p in tmp_path.iterdir())
    assert 0 < most <= block


def test_places_told_apart_are_not_sorted_again(monkeypatch):
    """After the first sort only places that are still equal to others take part."""
    import numpy as np

    from riskframe.llm import substrings
    rng = np.random.default_rng(2)
    contexts = [bytes(rng.integers(97, 123, 200).astype(np.uint8)) for _ in range(20)]
    contexts += [contexts[3][40:160] + b"x" * 30]
    text = np.frombuffer(b"".join(c + b"\xff" for c in contexts), np.uint8)
    sizes, real = [], np.argsort
    monkeypatch.setattr(np, "argsort", lambda a, **more: sizes.append(len(a)) or real(a, **more))
    order = substrings._sorted_suffixes(text, 100)
    assert sizes[0] == len(text) and sum(sizes[1:]) < len(text)
    padded = text.tobytes() + b"\0" * 100
    starts = [padded[i:i + 100] for i in order]
    assert starts == sorted(starts)
    assert substrings.shared_windows(contexts, 100) == [[]] * 20 + [[(0, 20)]]
