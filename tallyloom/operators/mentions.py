"""How many articles mention each keyword, and which ones.

A vocabulary is a table ``(keyword, position)`` that stays on Spark, or a short list
in the program. There is one plan for tables of every size: articles are scanned and
split once, tokens that no keyword can equal are dropped by a bitmap of bounded
size, and what is left meets the keywords themselves. A list is a constant of the
plan, which each article is compared with; give a vocabulary of thousands as a table.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.tokens import checked_vocabulary, mentioned, mentions, tokens
from tallyloom.operators.bags import BAG_BYTES, BAG_SIZE, bag_of, bags_for, in_bags, profile, shuffled_size
from tallyloom.plans.storage import materialize, tasks_for


class CheckedVocabulary(NamedTuple):
    """``(keyword, position)`` without null, empty or repeated keywords, and the list it came from if it did."""

    rows: DataFrame
    listed: list[str] | None


Vocabulary = Sequence[str] | DataFrame | CheckedVocabulary

# Bits of the bitmap of keywords. It is broadcast as rows of 64 bits, so it takes
# 4 MiB at most whatever the size of the vocabulary, and tens of bytes for a few words.
BITMAP_BITS = 1 << 24


def occurrences(articles: DataFrame, keyword: str) -> DataFrame:
    """One row ``(keyword, n)``: the number of articles mentioning ``keyword``; 0 on no input."""
    return articles.where(mentions(F.col("text"), keyword)).agg(
        F.lit(keyword).alias("keyword"), F.count(F.lit(1)).alias("n")
    ).select("keyword", "n")


def check_vocabulary(spark: SparkSession, vocabulary: Vocabulary) -> CheckedVocabulary:
    """A vocabulary as a table; null, empty and repeated keywords are refused with a ValueError.

    A table has the columns ``keyword`` and ``position``. It is written once, so that
    what follows reads what was checked, and Spark knows its size when it chooses
    between joins.
    """
    if isinstance(vocabulary, CheckedVocabulary):
        return vocabulary
    if not isinstance(vocabulary, DataFrame):
        listed = checked_vocabulary(vocabulary)
        rows = spark.createDataFrame([(k, i) for i, k in enumerate(listed)], "keyword string, position long")
        return CheckedVocabulary(rows, listed)
    rows = materialize(
        vocabulary.select(F.col("keyword").cast("string").alias("keyword"), F.col("position").cast("long").alias("position")),
        "vocabulary",
    )
    wrong = rows.groupBy("keyword").agg(F.count(F.lit(1)).alias("n")).where("n > 1 OR keyword IS NULL OR keyword = ''")
    if (first := wrong.first()) is not None:
        raise ValueError(f"the vocabulary repeats a keyword or has an empty one: {first.keyword!r}")
    return CheckedVocabulary(rows, None)


def numbered_vocabulary(keywords: DataFrame) -> DataFrame:
    """``(keyword, position)`` of the distinct non-empty values of the first column, numbered in their order.

    Numbered within sorted ranges from the counts of the ranges before, so that
    no task sees all of them.
    """
    name = keywords.columns[0]
    words = keywords.select(F.col(name).cast("string").alias("keyword")).where("keyword <> ''").distinct()
    ranged = materialize(
        words.orderBy("keyword").select("keyword", F.monotonically_increasing_id().alias("at")), "vocabulary-order"
    ).withColumn("range", F.shiftright("at", 33))
    # A row per range, as many as there are partitions.
    sizes = ranged.groupBy("range").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.selectExpr("range", "sum(n) OVER (ORDER BY range) - n AS before")
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return ranged.join(F.broadcast(before), "range").select("keyword", (F.col("before") + inside).alias("position"))


def _bit(keyword: Column) -> tuple[Column, Column]:
    """The row of the bitmap and the bit in it that a keyword sets."""
    at = F.pmod(F.xxhash64(keyword), F.lit(BITMAP_BITS))
    return F.shiftright(at, 6), at.bitwiseAND(F.lit(63)).cast("int")


def _bitmap(words: DataFrame) -> DataFrame:
    """``(__part, __bits)``: the bits that keywords set, in at most BITMAP_BITS / 64 rows."""
    part, bit = _bit(F.col("keyword"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))
    return words.select(part.alias("__part"), bit.alias("bit")).groupBy("__part").agg(F.bit_or(one).alias("__bits"))


def _possible(articles: DataFrame, words: CheckedVocabulary, columns: Sequence[str]) -> DataFrame:
    """``(keyword, columns...)`` for the distinct tokens of each article that may be keywords.

    Of a list these are its keywords. Of a table they are the tokens that have their
    bit set: all keywords, and a share of other tokens that grows with the table.
    Narrow, and the only scan of the articles.
    """
    if words.listed is not None:
        return articles.select(F.explode(mentioned(F.col("text"), words.listed)).alias("keyword"), *columns)
    found = articles.select(F.explode(F.array_distinct(tokens(F.col("text")))).alias("keyword"), *columns)
    part, bit = _bit(F.col("keyword"))
    marked = found.withColumn("__part", part).join(F.broadcast(_bitmap(words.rows)), "__part")
    return marked.where(F.getbit("__bits", bit) == 1).select("keyword", *columns)


def index_articles(
    articles: DataFrame, vocabulary: Vocabulary, columns: Sequence[str] = ("title", "text")
) -> DataFrame:
    """Inverted index in long form: one row ``(keyword, columns...)`` per mention.

    Keywords without a mention have no row. With a list this is narrow: articles are
    not shuffled. Possible mentions of a table's keywords are joined with these: Spark
    broadcasts them where their size allows, and then no article is shuffled either;
    otherwise it shuffles both sides, and splits a keyword that half of the articles
    mention.
    """
    words = check_vocabulary(articles.sparkSession, vocabulary)
    possible = _possible(articles, words, columns)
    return possible if words.listed is not None else possible.join(words.rows.select("keyword"), "keyword")


def bag_index(
    index: DataFrame,
    columns: Sequence[str] = ("title", "text"),
    bag_size: int = BAG_SIZE,
    bag_bytes: int = BAG_BYTES,
) -> DataFrame:
    """Inverted index in nested form: ``(keyword, bag, n, articles)`` with bounded arrays.

    ``articles`` holds ``struct(columns..., copies)`` and stands for ``n`` rows.
    Articles are shuffled once, to their bags; how many bags a keyword needs comes
    from a pass over digests, and only keywords with several bags are looked up.
    """
    columns = list(columns)
    profiled = profile(index, "keyword", columns)
    bags = bags_for(F.count(F.lit(1)), F.sum("bytes"), bag_size, bag_bytes)
    hot = materialize(profiled.groupBy("keyword").agg(bags.alias("bags")).where("bags > 1"), "hot-keywords")
    dealt = index.select("keyword", *columns).join(hot, "keyword", "left")
    dealt = dealt.withColumn("bag", F.coalesce(bag_of(F.struct(*columns), "bags"), F.lit(0).cast("long")))
    return (
        in_bags(dealt, profiled, ["keyword", "bag"], columns, tasks_for(index.sparkSession, *shuffled_size(profiled)))
        .groupBy("keyword", "bag")
        .agg(F.sum("copies").alias("n"), F.collect_list(F.struct(*columns, "copies")).alias("articles"))
    )


def rank_by_count(articles: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(keyword, n)`` by falling count, then keyword; keywords without a mention are absent.

    Only keywords and partial counts are shuffled.
    """
    words = check_vocabulary(articles.sparkSession, vocabulary)
    return _ranked_found(_count_all(_possible(articles, words, ()), words))


def rank_found(found: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rank_by_count`` from rows that each mention the ``keyword`` they hold."""
    return _ranked_found(_count_all(found, check_vocabulary(found.sparkSession, vocabulary)))


def _ranked_found(counted: DataFrame) -> DataFrame:
    return counted.where("n > 0").select("keyword", "n").orderBy(F.desc("n"), "keyword")


def rank_all(articles: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``(keyword, n)`` for the whole vocabulary, zeros included.

    By falling count; among equal counts the later keyword comes first.
    """
    words = check_vocabulary(articles.sparkSession, vocabulary)
    return _ranked_all(_count_all(_possible(articles, words, ()), words))


def rank_all_found(found: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``rank_all`` from rows that each mention the ``keyword`` they hold."""
    return _ranked_all(_count_all(found, check_vocabulary(found.sparkSession, vocabulary)))


def _ranked_all(counted: DataFrame) -> DataFrame:
    return counted.orderBy(F.desc("n"), F.desc("position"), "keyword").select("keyword", "n")


def _count_all(found: DataFrame, words: CheckedVocabulary) -> DataFrame:
    """``(keyword, position, n)`` for every keyword, in one shuffle.

    The vocabulary joins the mentions as rows that weigh nothing, which keeps
    keywords without a mention, and drops tokens that are none, without a join.
    Only keywords are shuffled, summed up before.
    """
    mentions_found = found.select(
        "keyword", F.lit(None).cast("long").alias("position"), F.lit(1).alias("weight")
    )
    listed = words.rows.select("keyword", "position", F.lit(0).alias("weight"))
    return (
        mentions_found.unionByName(listed)
        .groupBy("keyword")
        .agg(F.max("position").alias("position"), F.sum("weight").alias("n"), F.min("weight").alias("least"))
        .where("least = 0")
    )


def rank_by_index(index: DataFrame) -> DataFrame:
    """The ranking of ``rank_by_count`` from an index in long or nested form."""
    n = F.sum("n") if "bag" in index.columns else F.count(F.lit(1))
    return index.groupBy("keyword").agg(n.alias("n")).orderBy(F.desc("n"), "keyword")
