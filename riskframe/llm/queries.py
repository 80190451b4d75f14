"""The registered queries: each operator over its whole table, reduced to the agreed columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskframe.llm.bpe import encode_texts
from riskframe.llm.common import table, words_of
from riskframe.llm.mixing import copies_of, mixing_rates
from riskframe.llm.neardup import near_duplicates
from riskframe.llm.negatives import hard_negatives
from riskframe.llm.packing import pack_documents
from riskframe.llm.pii import find_personal
from riskframe.llm.quality import judge_quality
from riskframe.llm.resample import resample
from riskframe.llm.secrets import scan_secrets
from riskframe.llm.sharding import rendezvous, shard_records
from riskframe.llm.substrings import repeated_spans
from riskframe.llm.topk import top_inner_products
from riskframe.llm.urls import canonical, host_of, judge_urls, path_of
from riskframe.llm.oracles import URL_LISTED_HOSTS, oracles

URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]
SHARDS = {n: 1.0 for n in range(16)}


def span_digest(spans: Column, kinds: list[str]) -> list[Column]:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    def told(some: Column) -> Column:
        return F.array_join(F.transform(some, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def of(*some: str) -> Column:
        return F.filter(spans, lambda s: s["kind"].isin(*some))
    base = of(*kinds)
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in kinds]
    return [*counts, F.sha2(told(base), 256).alias("base_sha256"), told(spans).alias("spans")]


DOMAINS = ["good", "poor", "toxic_good", "toxic_poor"]
TARGETS = {"good": 0.85, "poor": 0.15, "toxic_good": 0.0, "toxic_poor": 0.0}


def domain_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, domain) of the labelled documents: their quality, and whether toxic."""
    return table(spark, sf_dir, "labels").select("doc_id", F.concat(
        F.when(F.col("toxic") == 1, "toxic_").otherwise(""),
        F.when(F.col("quality") == 1, "good").when(F.col("quality") == 0, "poor")).alias("domain"))


def op1_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    _, rates, members = mixing_rates(docs, domain_labels(spark, sf_dir), TARGETS, DOMAINS)
    rate = rates.of(F.col("posteriors"))
    return members.select("doc_id", "tokens", *(F.get("posteriors", F.lit(i)).alias(f"p_{d}") for i, d in enumerate(DOMAINS)),
                          rate.alias("rate"), copies_of(rate, F.col("doc_id")).alias("copies"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page judged. The list: canonical URLs of the pages of known spam hosts."""
    pages = table(spark, sf_dir, "pages")
    host = host_of(F.col("url"))
    listed = (pages.where(host.rlike(f"({'|'.join(URL_LISTED_HOSTS)})[.]"))
              .select(canonical(host, path_of(F.col("url"))).alias("canonical")))
    judged = judge_urls(pages, listed, URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "canonical", "listed")


def op3_bwt_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeated_spans(table(spark, sf_dir, "documents"), length=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                        "kept_sha256")


def op4_rendezvous_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    placed = shard_records(docs, "doc_id", SHARDS)
    grown = rendezvous(F.col("doc_id"), {**SHARDS, 16: 1.0})
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                         grown.alias("grown_shard"))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_digest(F.col("spans"), ["assign", "access", "hex"]))


def op6_weak_supervision_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *span_digest(F.col("spans"), ["email", "ip", "card", "phone"]))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "lost_chars", "base_failed", "kept")


def op8_hyperminhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=4, threshold=0.8)
    return found.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "kept")


def op9_dual_tree_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    found = top_inner_products(vectors.where(F.col("vec_id") % 50 == 0), vectors, "vec_id", "embedding", 5)
    return found.select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op10_configuration_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


def op11_bond_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, rows.where(F.col("vec_id") % 50 == 0))


def op12_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = encode_texts(table(spark, sf_dir, "documents"), path, decoded="decoded")
    return coded.select("doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (op1_soft_mixing, op2_url_filter, op3_bwt_substrings, op4_rendezvous_shards, op5_secret_scan,
                                  op6_weak_supervision_pii, op7_quality_rules, op8_hyperminhash_neardup, op9_dual_tree_topk, op10_configuration_packing,
                                  op11_bond_negatives, op12_prefix_bpe, op13_importance_resampling)}
ORACLES = {k: v for k, v in oracles().items() if k in QUERIES}
