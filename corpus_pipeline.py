"""The corpus pipeline: quality rules, near duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes every
stage's table to the shared scratch folder and reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskframe.llm.common import table
from riskframe.llm.mixing import mix
from riskframe.llm.neardup import keep_one
from riskframe.llm.packing import pack_documents
from riskframe.llm.quality import keep_good
from riskframe.llm.queries import DOMAINS, TARGETS, domain_labels
from riskframe.llm.secrets import mask_secrets
from riskframe.sources.tables import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the rest lose their boilerplate lines, n_chars following. An
    empty table stays empty."""
    return keep_good(docs, length="n_chars")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five words, 0.8) the smallest doc_id stays.

    Documents without words or without an id are in no group and stay.
    """
    return keep_one(docs, shingle=5, threshold=0.8)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is masked in its text; n_chars follows the masked text. Null texts stay null."""
    return mask_secrets(docs, length="n_chars")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents leave, stay or repeat as their fitted rates say.

    The total is large enough that no wanted domain shrinks in tokens; documents that may
    be toxic leave, and cleaner ones of their domain repeat for them.
    """
    return mix(docs, domain_labels(spark, sf_dir), TARGETS, DOMAINS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of at most 2048 tokens. A repeated document is packed
    as often as it is listed."""
    import public_tokenizers
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets),
          ("mixing", mixing), ("packing", packing)]

#: SQL cannot confirm secrets, fit the mixture or tokenise; tests compare the stages with plain code.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
