"""Nulls, empty and long texts, repeated rows, empty tables and clashing column names."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from riskframe.llm.mixing import mix
from riskframe.llm.neardup import keep_one, near_duplicates
from riskframe.llm.pii import find_personal
from riskframe.llm.quality import judge_quality, keep_good
from riskframe.llm.secrets import mask_secrets, scan_secrets
from riskframe.llm.sharding import shard_records, write_shards
from riskframe.llm.substrings import repeated_spans
from riskframe.llm.topk import top_inner_products
from riskframe.llm.urls import judge_urls

LONG = "lorem ipsum dolor " * 30_000
PROSE = " ".join(f"word{i * 7919 % 1009} and{i}" for i in range(60))
ROWS = [(1, PROSE, "en", "a", 1), (1, PROSE, "en", "a", 1), (2, None, None, None, None), (None, PROSE + " x", "en", "a", 3),
        (3, "", "en", None, 0), (4, LONG, "en", "b", 5), (5, " \n\t ", "en", "b", 5), (None, None, None, None, None)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names the operators use themselves.
CLASHES = ["key", "_text", "_row", "component", "kept", "n_words", "shard", "slot", "spans", "_k", "tokens", "_n", "bands"]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark):
    return spark.createDataFrame([(1, "good"), (4, "poor"), (5, None), (None, "good")], "doc_id long, domain string")


OPERATORS = {
    "quality": judge_quality, "near": near_duplicates, "secrets": scan_secrets, "personal": find_personal,
    "substrings": repeated_spans, "shards": lambda d: shard_records(d, "doc_id", {0: 1.0, 1: 2.0})}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_row(docs, nothing, name):
    got = OPERATORS[name](docs).collect()
    assert sorted(r["doc_id"] or 0 for r in got) == sorted(r[0] or 0 for r in ROWS)
    assert OPERATORS[name](nothing).collect() == []


FILTERS = {"keep_good": keep_good, "keep_one": keep_one, "mask": mask_secrets,
           "mix": lambda d: mix(d, labels(d.sparkSession), {"good": 1.0, "poor": 1.0}, ["good", "poor"])}


@pytest.mark.parametrize("name", FILTERS)
def test_filters_keep_columns(docs, nothing, name):
    got = FILTERS[name](docs)
    assert got.columns == docs.columns and got.count() >= 1
    assert FILTERS[name](nothing).count() == 0


def test_defined_results(docs):
    near = {(r["doc_id"], r["n_shingles"]): r for r in near_duplicates(docs).collect()}
    assert near[(2, 0)]["component"] == 2 and near[(5, 0)]["kept"]
    assert near[(None, 0)]["component"] is None and near[(None, 0)]["kept"]
    verdict = {r["doc_id"]: r for r in judge_quality(docs).collect() if r["doc_id"]}
    assert verdict[2]["n_words"] == 0 and verdict[2]["base_failed"] and not verdict[2]["kept"]
    assert verdict[4]["n_words"] == 90_000 and verdict[4]["n_repeat_words"] == 90_000 and verdict[1]["kept"]
    spans = {r["doc_id"]: r for r in repeated_spans(docs).collect() if r["doc_id"]}
    assert spans[4]["spans"][0]["start"] == 18 and spans[4]["spans"][0]["end"] == len(LONG)
    assert spans[2]["n_bytes"] == 0 and spans[2]["kept_sha256"] == hashlib.sha256(b"").hexdigest()
    assert spans[1]["spans"][0]["end"] >= len(PROSE) - 1  # the text without an id comes first


def test_url_edges(spark):
    rows = [(1, None), (2, "no scheme"), (3, "http://"), (4, "HTTP://A.B.COM/x?y"), (4, "HTTP://A.B.COM/x?y"),
            (None, "http://bad.org/p/"), (5, "http://sub.bad.net/es/1"), (6, "http://www.bad.org/p#q"), (7, "http://bad.org")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("clash"))
    listed = spark.createDataFrame([("bad.org/p",), (None,)], "canonical string")
    got = judge_urls(pages, listed, [("com/", "allow"), ("net/es/", "block"), ("bad.net/es/", "allow")]).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == len(rows)
    assert (by[1]["host"], by[1]["path"], by[1]["verdict"]) == ("", "", "allow") and by[2]["host"] == ""
    assert (by[4]["host"], by[4]["rule"]) == ("a.b.com", "com/")
    assert by[5]["rule"] == "bad.net/es/" and by[5]["verdict"] == "allow"
    assert by[6]["listed"] and by[6]["verdict"] == "block" and by[None]["verdict"] == "block"
    assert not by[7]["listed"] and by[7]["verdict"] == "allow"
    assert judge_urls(pages.limit(0), listed, []).count() == 0
    one = judge_urls(pages, listed, [], blocks=1).collect()  # a full filter lets everything through
    assert sorted(r["verdict"] for r in one) == sorted(
        "block" if r["canonical"] == "bad.org/p" else "allow" for r in one)


def test_shards_grow_only_into_the_new_one(spark, tmp_path):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    one = {r["doc_id"]: r for r in shard_records(df, "doc_id", dict.fromkeys(range(8), 1.0)).collect()}
    two = {r["doc_id"]: r for r in shard_records(df, "doc_id", dict.fromkeys(range(9), 1.0)).collect()}
    moved = [k for k in one if one[k]["shard"] != two[k]["shard"]]
    assert all(two[k]["shard"] == 8 for k in moved) and 200 < len(moved) < 500
    for shard in range(8):
        slots = sorted(r["slot"] for r in one.values() if r["shard"] == shard)
        assert slots == list(range(len(slots)))
    heavy = shard_records(df, "doc_id", {0: 1.0, 1: 3.0}).groupBy("shard").count().collect()
    assert 2.5 < max(r["count"] for r in heavy) / min(r["count"] for r in heavy) < 3.6
    write_shards(df, str(tmp_path / "out"), "doc_id", {0: 1.0, 1: 1.0}, files_each=2)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3000


def test_top_k_edges(spark):
    rng = random.Random(5)
    rows = [(i, [float(rng.randint(-3, 3)) for _ in range(4)]) for i in range(300)]
    rows += [(1000, None), (1050, [1.0, None]), (1100, [float("nan"), 1.0]), (1150, [float("inf")]), (1200, []),
             (None, [1.0]), (1250, [2.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("centre", F.lit("clash"))
    got = top_inner_products(df.where("vec_id % 50 = 0"), df, "vec_id", "embedding", 5)
    good = {i: [int(x * 256) for x in v] for i, v in rows
            if i is not None and v is not None and all(x is not None and abs(x) < 1e9 for x in v)}
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    want = []
    for q in (i for i in good if i % 50 == 0):
        best = sorted((-dot(good[q], good[i]), i) for i in good if i != q)[:5]
        want += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert top_inner_products(df.limit(0), df, "vec_id", "embedding").count() == 0
    few = df.where("vec_id in (0, 1)")
    assert top_inner_products(few, few, "vec_id", "embedding").count() == 2


def test_pipeline_stages(spark):
    sf_dir = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.stored(stage(spark, docs, sf_dir), name)
        assert docs.count() > 0
        if name != "packing":
            assert docs.columns == columns
        if name in ("quality", "near_duplicates"):
            assert docs.exceptAll(before).count() == 0
        if name == "secrets":
            assert docs.count() == before.count()
            left = re.compile(r'token = "[0-9a-f]{24,}"')
            assert not any(left.search(r["text"]) for r in docs.collect())
            assert docs.where("n_chars <> length(text)").count() == 0
        if name == "mixing":
            toxic = corpus_pipeline.table(spark, sf_dir, "labels").where("toxic = 1 and quality = 1")
            had, has = (d.join(toxic, "doc_id").select("doc_id").distinct().count() for d in (before, docs))
            assert has <= 0.5 * had
            clean = corpus_pipeline.table(spark, sf_dir, "labels").where("toxic = 0 and quality = 1")
            had, has = (d.join(clean, "doc_id").select("doc_id").distinct().count() for d in (before, docs))
            assert has >= 0.9 * had
        if name == "packing":
            assert {r["doc_id"] for r in docs.collect()} == {r["doc_id"] for r in before.collect()}
    empty = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, sf_dir)
        assert empty.count() == 0


def test_spelled_addresses_in_capitals_are_candidates(spark):
    from riskframe.llm.pii import _of_kind
    texts = ["WRITE JOHN.DOE [AT] EXAMPLE [DOT] COM", "write john.doe (at) example (dot) com", "LATE", "at (a) t", "", None]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select(_of_kind(F.col("t"), "spelled").alias("s"))
    assert [len(r["s"]) for r in found.collect()] == [1, 1, 0, 0, 0, 0]


def test_top_k_takes_a_repeated_id_once(spark):
    df = spark.createDataFrame([(0, [2.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 1.0]), (1, [1.0, 1.0]), (2, [0.5, 3.0])],
                               "vec_id long, embedding array<double>")
    got = top_inner_products(df.where("vec_id = 0"), df, "vec_id", "embedding", 5)
    assert sorted(tuple(r) for r in got.collect()) == [(0, 1, 1, 65536), (0, 2, 2, 32768)]


def test_near_duplicates_take_rows_of_one_key_as_one_document(spark):
    other = " ".join(f"else{i}" for i in range(80))
    df = spark.createDataFrame([(1, PROSE), (1, other), (2, other + " tail"), (3, PROSE), (4, "quite different words in here")],
                               "doc_id long, text string")
    got = {(r["doc_id"], r["component"]) for r in near_duplicates(df).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4)}
