"""Survey CSV files whose header line decides the schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.checks import holds_or_fails, present_or_fails, quoted


def header_names(spark: SparkSession, path: str) -> list[str]:
    """Column names from the first line; reads no further than that line."""
    first = spark.read.text(path).first()
    if first is None:
        raise ValueError(f"no header line in {path}")
    return first.value.split(",")


def survey_schema(names: Sequence[str]) -> T.StructType:
    """First column STRING, all others DOUBLE, none nullable."""
    head, *tail = names
    return T.StructType(
        [T.StructField(head, T.StringType(), False)]
        + [T.StructField(name, T.DoubleType(), False) for name in tail]
    )


def read_survey(
    spark: SparkSession, path: str, check_whole_rows: bool = True
) -> tuple[list[str], DataFrame]:
    """Column names and rows of a survey file or folder of files.

    Every file has its own header, which must name the same columns. A cell that
    is missing or no number fails the job, whatever columns are used. Without
    ``check_whole_rows`` a cell is checked only when its column is used, and unused
    columns are not even parsed. The first column is text and may be empty.
    """
    names = header_names(spark, path)
    rows = spark.read.csv(
        path,
        schema=survey_schema(names),
        header=True,
        enforceSchema=False,
        mode="FAILFAST",
        quote="",
    )
    head, *numbers = names
    if check_whole_rows and numbers:
        complete = F.expr(" AND ".join(f"{quoted(name)} IS NOT NULL" for name in numbers))
        rows = rows.where(holds_or_fails(complete, "survey row with a missing cell"))
    return names, rows.selectExpr(
        f"coalesce({quoted(head)}, '') AS {quoted(head)}", *[present_or_fails(name) for name in numbers]
    )
