"""Articles ``(title, text)`` from lines of the form ``<page><title> T</title><text>X  </text></page>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.checks import holds_or_fails
from tallyloom.sources.split import Split, split_by_reason

# The line format.
TITLE_START = 14
DELIMITER = "</title><text>"
TAIL_LENGTH = 16


def _located(lines: DataFrame) -> DataFrame:
    """Each line with the 1-based place of its first delimiter (0 if there is none)."""
    return lines.select("value", F.instr("value", DELIMITER).alias("at"))


def _text_length() -> Column:
    return F.length("value") - TAIL_LENGTH - (F.col("at") - 1 + len(DELIMITER))


def _well_formed() -> Column:
    return (F.col("at") > TITLE_START) & (_text_length() >= 0)


def parse_articles(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Parse lines (column ``value``) into ``(title, text)``.

    Strict fails the job on a malformed line; otherwise such lines are left to
    ``article_rejects``.
    """
    well_formed = _well_formed()
    kept = holds_or_fails(well_formed, "malformed article line") if strict else well_formed
    return _located(lines).where(kept).select(*_parts())


def _parts() -> list[Column]:
    return [
        F.substring("value", F.lit(TITLE_START + 1), F.col("at") - 1 - TITLE_START).alias("title"),
        F.substring("value", F.col("at") + len(DELIMITER), _text_length()).alias("text"),
    ]


def split_articles(lines: DataFrame) -> Split:
    """The results of a non-strict ``parse_articles`` and of ``article_rejects`` from one pass over the lines, with reasons."""
    reason = (
        F.when(F.col("value").isNull(), "no line")
        .when(F.col("at") == 0, "no delimiter")
        .when(F.col("at") <= TITLE_START, "no title")
        .when(_text_length() < 0, "text cut off")
    )
    return split_by_reason(_located(lines).select("*", *_parts()), reason, ["title", "text"], "articles")


def article_rejects(lines: DataFrame) -> DataFrame:
    """The lines a non-strict ``parse_articles`` leaves out."""
    return _located(lines).where(~F.coalesce(_well_formed(), F.lit(False))).select("value")


def read_articles(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_articles(spark.read.text(path), strict)


def article_lines(articles: DataFrame) -> DataFrame:
    """Lines (column ``value``) that ``parse_articles`` reads back; line breaks become blanks."""
    def one_line(name: str) -> Column:
        return F.replace(F.replace(F.col(name), F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))

    return articles.select(
        F.concat(
            F.lit("<page><title> "), one_line("title"),
            F.lit(DELIMITER), one_line("text"),
            F.lit("  </text></page>"),
        ).alias("value")
    )
