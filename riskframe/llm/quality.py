"""Quality rules: counts within each document, and line frequency across documents.

Lines are normalised and hashed; for each host the distinct texts that hold a line
are counted, lines above the limit are boilerplate, and a document that loses too
much of itself to them is rejected; the others lose those lines. Lines of every
length count. Exact copies count as one text, so a page is not turned into
boilerplate by its own copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.common import SPACES, ascii_lower, words_of
from riskframe.sources.tables import stored

SYMBOLS = "#*$%&|<>"
#: A line held by more distinct texts of one host than this is boilerplate.
MAX_TEXTS = 20
#: Rejected if more than this share of the word characters stood in such lines.
MAX_LOST = 0.5
#: Tasks that the texts holding one line are spread over.
SPLITS = 16

_INDEX_BITS = (1 << 28) - 1  # a word's place in its text; the rest of the long holds a hash


def line_hash(line: Column) -> Column:
    """64 bits of a line without case, with digits as 0 and runs of white space as one blank."""
    plain = F.regexp_replace(ascii_lower(F.btrim(line, F.lit(SPACES))), "[ \\t\\x0B\\f\\r]+", " ")
    return F.xxhash64(F.regexp_replace(plain, "[0-9]", "0"))


def _hashed(lines: Column) -> Column:
    """(hash, chars) of each line."""
    return F.transform(lines, lambda x: F.struct(
        line_hash(x).alias("line"),
        F.length(F.regexp_replace(x, "[ \\t\\x0B\\f\\r]+", "")).alias("chars")))


def text_counts(df: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep`` plus n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and lines.

    Repeated 3-word windows are found within the row: window hashes, each with its
    place in the low bits, are sorted as plain longs; those whose hash bits equal a
    neighbour's are sorted again by their words, and neighbours are compared by those.
    """
    filled = F.coalesce(text, F.lit(""))
    one = df.select(*keep, words_of(text).alias("_w"), F.filter(
        F.split(filled, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "").alias("_l"))
    joined = F.array_join("_w", "")
    two = one.select(
        *[c for c in one.columns if c not in ("_w", "_l")],
        F.size("_w").cast("long").alias("n_words"),
        F.length(joined).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(joined, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"),
        _hashed(F.col("_l")).alias("lines"),
        F.transform("_w", lambda w: F.xxhash64(w)).alias("_h"))
    fixed = [c for c in two.columns if c != "_h"]
    high, low = F.lit(~_INDEX_BITS), F.lit(_INDEX_BITS)
    starts = F.slice("_h", F.lit(1), F.greatest(F.size("_h") - 2, F.lit(0)))
    packed = F.transform(starts, lambda h, i: F.xxhash64(h, F.get("_h", i + 1), F.get("_h", i + 2))
                         .bitwiseAND(high).bitwiseOR(i.cast("long")))
    three = two.select(*fixed, "_h", F.sort_array(packed).alias("_s"))

    def close(a: Column, b: Column) -> Column:
        return F.coalesce(a.bitwiseXOR(b).bitwiseAND(high) == 0, F.lit(False))
    four = three.select(*fixed, "_h", F.filter("_s", lambda v, i: close(v, F.get("_s", i + 1))
                                               | close(v, F.get("_s", i - 1))).alias("_s"))

    def worded(v: Column) -> Column:
        at = v.bitwiseAND(low).cast("int")
        return F.struct(F.get("_h", at).alias("a"), F.get("_h", at + 1).alias("b"),
                        F.get("_h", at + 2).alias("c"), at.cast("long").alias("at"))

    def equal(x: Column, y: Column) -> Column:
        return F.coalesce((x["a"] == y["a"]) & (x["b"] == y["b"]) & (x["c"] == y["c"]), F.lit(False))
    five = four.select(*fixed, F.sort_array(F.transform("_s", worded)).alias("_s"))
    six = five.select(*fixed, F.sort_array(F.transform(
        F.filter("_s", lambda v, i: equal(v, F.get("_s", i + 1)) | equal(v, F.get("_s", i - 1))),
        lambda v: v["at"])).alias("_p"))
    gaps = F.transform("_p", lambda p, i: F.least(F.lit(3).cast("long"),
                                                  F.coalesce(F.get("_p", i + 1) - p, F.lit(3).cast("long"))))
    return six.select(*fixed, F.aggregate(gaps, F.lit(0).cast("long"), lambda a, g: a + g)
                       .alias("n_repeat_words"))


def judge_quality(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
                  max_texts: int = MAX_TEXTS, max_lost: float = MAX_LOST) -> DataFrame:
    """One row for each row of ``df``: the counts, ``lost_chars``, ``frequent_lines``
    (hashes of its boilerplate lines), ``base_failed`` and ``kept``.

    Null texts have no words and fail; null hosts are one host of their own.
    Repeated rows get the same verdict each, and count as one text. Other columns are
    not read. Texts are read once; the line table is grouped by (host, line) after
    each text's lines are made distinct, so a hot host or line is summed up before
    it is shuffled, and the texts of a line meet it in SPLITS tasks.
    """
    own = df.select(F.col(f"`{key}`").alias("_key"), F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("\0")).alias("_host"),
                    F.col(f"`{text}`").alias("_text"))
    counted = stored(text_counts(own, F.col("_text"), [
        F.col("_key"), F.col("_host"), F.md5(F.coalesce(F.col("_text"), F.lit(""))).alias("_print")]), "quality")
    texts = (counted.where(F.size("lines") > 0).groupBy("_host", "_print")
             .agg(F.first("lines").alias("lines")))
    held = texts.select("_host", F.explode(F.array_distinct(F.transform("lines", lambda x: x["line"]))).alias("_line"))
    frequent = held.groupBy("_host", "_line").count().where(F.col("count") > max_texts).select(
        "_host", "_line", F.explode(F.sequence(F.lit(0), F.lit(SPLITS - 1))).alias("_split"))
    each = texts.select("_host", "_print", F.explode("lines").alias("_x")).select(
        "_host", "_print", F.col("_x.line").alias("_line"), F.col("_x.chars").alias("_chars"),
        F.pmod(F.hash("_print"), F.lit(SPLITS)).alias("_split"))
    lost = (each.join(frequent, ["_host", "_line", "_split"]).groupBy("_host", "_print")
            .agg(F.sum("_chars").alias("lost_chars"), F.collect_set("_line").alias("frequent_lines")))
    judged = counted.drop("lines").join(lost, ["_host", "_print"], "left")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    lost_chars = F.coalesce("lost_chars", F.lit(0)).cast("long")
    return judged.select(
        F.col("_key").alias(key), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        lost_chars.alias("lost_chars"),
        F.coalesce("frequent_lines", F.array().cast("array<bigint>")).alias("frequent_lines"),
        failed.alias("base_failed"),
        (~failed & (lost_chars <= max_lost * F.col("word_chars"))).alias("kept"),
        F.col("_host"), F.col("_print"))


def keep_good(df: DataFrame, key: str = "doc_id", text: str = "text", host: str = "source",
              length: str | None = None, **limits: float) -> DataFrame:
    """The rows of ``df`` that pass, with all their columns, without their boilerplate lines.

    All else is as it was, and so are texts without such lines. ``length`` names a
    column that is to hold the new text's code points where the text changed. The
    verdict depends on host and text alone, so it is joined on them: rows with the
    same or no key are told apart.
    """
    verdicts = (judge_quality(df, key, text, host, **limits).where("kept")
                .select(F.col("_host").alias("_vh"), F.col("_print").alias("_vp"), F.col("frequent_lines").alias("_lines"))
                .dropDuplicates(["_vh", "_vp"]))
    mine = df.select(F.struct("*").alias("_row"), F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("\0")).alias("_vh"),
                     F.md5(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("_vp"))
    old = F.col("_row").getField(text)
    kept = mine.join(verdicts, ["_vh", "_vp"]).select("_row", F.when(
        F.size("_lines") > 0, without_frequent_lines(old, F.col("_lines"))).otherwise(old).alias("_new"))

    def column(name: str) -> Column:
        value = F.col("_row").getField(name)
        if name == text:
            value = F.col("_new")
        elif name == length:
            value = F.when(F.col("_new") != old, F.length("_new").cast(df.schema[name].dataType)).otherwise(value)
        return value.alias(name)
    return kept.select(*map(column, df.columns))


def without_frequent_lines(text: Column, frequent: Column) -> Column:
    """A text without its lines whose hash is in ``frequent`` (see judge_quality)."""
    return F.array_join(F.filter(F.split(text, "\n"), lambda x: ~F.array_contains(
        frequent, line_hash(x))), "\n")
