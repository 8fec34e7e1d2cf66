"""The library's input shapes, derived from the bundled test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def articles(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select(F.col("doc_id").cast("string").alias("title"), "text")


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as questions tagged with their priority, order lines as their answers."""
    nothing = F.lit(None).cast("bigint")
    questions = table(spark, folder, "orders").select(
        F.lit(1).alias("posting_type"),
        F.col("o_orderkey").alias("id"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey") * 10 + 1).alias("accepted_answer"),
        nothing.alias("parent_id"),
        F.lit(0).alias("score"),
        F.col("o_orderpriority").alias("tags"),
    )
    answers = table(spark, folder, "lineitem").select(
        F.lit(2).alias("posting_type"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        nothing.alias("accepted_answer"),
        F.col("l_orderkey").alias("parent_id"),
        (F.col("l_quantity").cast("int") - 25).alias("score"),
        F.lit(None).cast("string").alias("tags"),
    )
    return questions.unionByName(answers)


def survey(spark: SparkSession, folder: str) -> DataFrame:
    """Order lines as survey rows: the id as text, everything else as doubles."""
    numbers = {
        "telfs": F.col("l_linenumber"),
        "tesex": F.col("l_partkey") % 2,
        "teage": F.col("l_suppkey") % 100,
        "t010101": F.col("l_quantity"),
        "t030101": F.col("l_extendedprice"),
        "t050101": F.col("l_discount") * 1000,
        "t020101": F.col("l_tax") * 1000,
        "t040101": F.col("l_quantity"),
    }
    return table(spark, folder, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("id"),
        *[value.cast("double").alias(name) for name, value in numbers.items()],
    )
