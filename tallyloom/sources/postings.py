"""Postings from comma-separated lines without header or quotes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.checks import holds_or_fails
from tallyloom.sources.split import Split, split_by_reason

SCHEMA = T.StructType([
    T.StructField("posting_type", T.IntegerType()),
    T.StructField("id", T.LongType()),
    T.StructField("accepted_answer", T.LongType()),
    T.StructField("parent_id", T.LongType()),
    T.StructField("score", T.IntegerType()),
    T.StructField("tags", T.StringType()),
])
REQUIRED = {"posting_type", "id", "score"}


def _field(position: int) -> Column:
    """Raw field text; NULL where it is empty or the line is too short."""
    return F.nullif(F.get(F.col("fields"), F.lit(position)), F.lit(""))


def _typed(position: int, field: T.StructField) -> Column:
    raw = _field(position)
    return raw if isinstance(field.dataType, T.StringType) else raw.try_cast(field.dataType)


def _split(lines: DataFrame) -> DataFrame:
    """Lines with their typed fields, and whether every field could be read.

    Fields after the sixth are ignored. A field that is there but is no number
    makes the line bad; so does a missing required field.

    The one-element ``explode`` keeps the optimizer from moving the filter on
    ``good`` below the split, which would then split each line 16 times.
    """
    fields = lines.select("value", F.explode(F.array(F.split("value", ","))).alias("fields"))
    typed = fields.select(
        "value",
        *[_field(i).alias(f"raw_{f.name}") for i, f in enumerate(SCHEMA)],
        *[_typed(i, f).alias(f.name) for i, f in enumerate(SCHEMA)],
    )
    good = F.lit(True)
    for f in SCHEMA:
        present = F.col(f.name).isNotNull()
        good = good & (present if f.name in REQUIRED else present | F.col(f"raw_{f.name}").isNull())
    return typed.withColumn("good", good)


def parse_postings(lines: DataFrame, strict: bool = True) -> DataFrame:
    """Parse lines (column ``value``) into postings.

    Strict fails the job on a line that cannot be read; otherwise such lines
    are left to ``posting_rejects``.
    """
    good = F.col("good")
    kept = holds_or_fails(good, F.concat(F.lit("malformed posting line: "), F.col("value"))) if strict else good
    return _split(lines).where(kept).select(*SCHEMA.fieldNames())


def posting_rejects(lines: DataFrame) -> DataFrame:
    """The lines a non-strict ``parse_postings`` leaves out."""
    return _split(lines).where(~F.col("good")).select("value")


def split_postings(lines: DataFrame) -> Split:
    """The results of a non-strict ``parse_postings`` and of ``posting_rejects`` from one pass over the lines.

    The reason names the first field that is missing or no number.
    """
    wrong = []
    for f in SCHEMA:
        raw = F.col(f"raw_{f.name}")
        if f.name in REQUIRED:
            wrong.append(F.when(raw.isNull(), F.lit(f"{f.name} is missing")))
        wrong.append(F.when(raw.isNotNull() & F.col(f.name).isNull(), F.lit(f"{f.name} is no number")))
    return split_by_reason(_split(lines), F.coalesce(*wrong), SCHEMA.fieldNames(), "postings")


def read_postings(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    return parse_postings(spark.read.text(path), strict)


def posting_lines(postings: DataFrame) -> DataFrame:
    """Lines (column ``value``) that ``parse_postings`` reads back."""
    fields = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in SCHEMA.fieldNames()]
    return postings.select(F.concat_ws(",", *fields).alias("value"))
