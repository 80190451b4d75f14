"""Boilerplate lines leave the texts that are kept."""

from pyspark.sql import functions as F

from riskframe.llm.quality import judge_quality, keep_good


def prose(i):
    return " ".join(f"word{chr(97 + j % 26)}{chr(97 + i)}{chr(97 + j // 26)}" for j in range(60))


def test_kept_texts_lose_frequent_lines(spark):
    rows = [(i, f"{prose(i)}\nAccept  cookies {i % 10}\n\nend of {prose(i)[:9]}", "a") for i in range(21)]
    rows += [(100 + i, f"{prose(i)}\nfew of these", "a") for i in range(3)]
    rows += [(200, f"{prose(0)}\naccept cookies 7", "b"), (300, "accept cookies 7\n" * 20, "a"), (400, None, "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("n_chars", F.lit(-1))
    got = {r["doc_id"]: r for r in keep_good(df, length="n_chars").collect()}
    assert sorted(got) == [*range(21), 100, 101, 102, 200]
    for i, text, _ in rows:
        if i < 21:
            want = f"{prose(i)}\n\nend of {prose(i)[:9]}"
            assert (got[i]["text"], got[i]["n_chars"]) == (want, len(want))
        elif i in got:
            assert (got[i]["text"], got[i]["n_chars"]) == (text, -1)
    assert keep_good(df).columns == df.columns


def test_lines_of_every_length_count(spark):
    for size in (200, 201, 5000):
        notice = ("read this notice " * size)[:size].strip() + "!"
        rows = [(i, f"{prose(i)}\n{notice}", "a") for i in range(25)]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        got = judge_quality(df).collect()
        assert {len(r["frequent_lines"]) for r in got} == {1}
        assert {r["lost_chars"] for r in got} == {len("".join(notice.split()))}
        if size < 300:
            assert {r["text"] for r in keep_good(df).collect()} == {prose(i) for i in range(25)}


def test_repeated_words_equal_plain_code(spark):
    import random
    rng = random.Random(9)
    texts = [" ".join(rng.choice("abcdefgh"[:n]) for _ in range(size)) for n in (2, 4, 8) for size in (0, 2, 3, 9, 60, 700)]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    for r in judge_quality(df).collect():
        w = texts[r["doc_id"]].split()
        seen, covered = {}, set()
        for i in range(len(w) - 2):
            seen.setdefault(tuple(w[i:i + 3]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                covered.update(j for i in at for j in (i, i + 1, i + 2))
        assert r["n_repeat_words"] == len(covered)
