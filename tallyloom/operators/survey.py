"""Hours per activity class, averaged by working status, sex and age group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.checks import present_or_fails, quoted
from tallyloom.functions.survey import (
    ActivityColumns, age_group, employable, hours, sex, working_status,
)

KEYS = ("working", "sex", "age")
MEASURES = ("primaryNeeds", "work", "other")
VIEW = "summed"

ROW_SCHEMA = T.StructType(
    [T.StructField(name, T.StringType()) for name in KEYS]
    + [T.StructField(name, T.DoubleType()) for name in MEASURES]
)


def summarize(survey: DataFrame, columns: ActivityColumns) -> DataFrame:
    """One row per employable person: ``working, sex, age`` and hours per activity class."""
    return survey.where(employable(F.col("telfs"))).select(
        working_status(F.col("telfs")).alias("working"),
        sex(F.col("tesex")).alias("sex"),
        age_group(F.col("teage")).alias("age"),
        hours(columns.primary_needs).alias("primaryNeeds"),
        hours(columns.work).alias("work"),
        hours(columns.other).alias("other"),
    )


def grouped(summary: DataFrame) -> DataFrame:
    """Average hours per group, rounded to one decimal, sorted by the group."""
    averages = [F.round(F.avg(name), 1).alias(name) for name in MEASURES]
    return summary.groupBy(*KEYS).agg(*averages).orderBy(*KEYS)


def grouped_query(view: str = VIEW) -> str:
    """SQL text equal to ``grouped`` over the view of that name."""
    keys = ", ".join(KEYS)
    averages = ", ".join(f"round(avg({name}), 1) AS {name}" for name in MEASURES)
    return f"SELECT {keys}, {averages} FROM {quoted(view)} GROUP BY {keys} ORDER BY {keys}"


def grouped_sql(summary: DataFrame, view: str = VIEW) -> DataFrame:
    """``grouped`` through SQL; leaves the summary registered as a temporary view."""
    summary.createOrReplaceTempView(quoted(view))
    return summary.sparkSession.sql(grouped_query(view))


def as_rows(summary: DataFrame) -> DataFrame:
    """The columns of ``ROW_SCHEMA``, picked by name.

    A missing column or another type is refused at once, a NULL number when
    the row is read.
    """
    found = {f.name: f.dataType for f in summary.schema}
    for f in ROW_SCHEMA:
        if found.get(f.name) != f.dataType:
            raise TypeError(f"column {f.name} must be {f.dataType.simpleString()}, not {found.get(f.name)}")
    return summary.selectExpr(*KEYS, *[present_or_fails(name) for name in MEASURES])


def grouped_typed(rows: DataFrame) -> DataFrame:
    """``grouped`` with the schema checked on both sides."""
    return as_rows(grouped(as_rows(rows))).orderBy(*KEYS)
