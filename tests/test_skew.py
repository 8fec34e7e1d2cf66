"""One key holds a third of all rows: Spark must be able to split it in every join."""

import pytest
from helpers import plan
from pyspark.sql import functions as F

from tallyloom.operators import bags, mentions, postings

SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skewed(spark, tmp_path):
    """9,000 postings: 3,000 questions, 3,000 answers to them, and 3,000 answers to question 7."""
    ids = spark.range(0, 3000, 1, 6)

    def rows(posting_type, posting_id, parent, score, tags):
        return ids.select(
            F.lit(posting_type).alias("posting_type"), posting_id.cast("bigint").alias("id"),
            F.lit(None).cast("bigint").alias("accepted_answer"), parent.cast("bigint").alias("parent_id"),
            score.cast("int").alias("score"), tags.cast("string").alias("tags"),
        )

    i, nothing = F.col("id"), F.lit(None)
    path = str(tmp_path / "postings")
    rows(1, i, nothing, F.lit(0), F.lit("Java")).unionByName(
        rows(2, i + 10_000, i, i % 50, nothing)
    ).unionByName(
        rows(2, i + 20_000, F.lit(7), i % 50, nothing)
    ).write.parquet(path)
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield spark.read.parquet(path)
    for key in SETTINGS:
        spark.conf.unset(key)


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def test_pairs_split_the_hot_question(skewed):
    df = postings.pair_postings(skewed)
    assert "skew=true" in final_plan(df)
    assert df.count() == 6000 and df.where("qid = 7").count() == 3001


def test_grouping_splits_the_hot_question_and_keeps_every_pair(skewed):
    df = postings.group_postings(skewed, bag_size=100)
    assert "skew=true" in final_plan(df)
    rows = df.groupBy().agg(F.sum("n"), F.max(F.size("pairs")), F.expr("count_if(qid = 7)")).first()
    assert rows[0] == 6000 and rows[1] < 200 and rows[2] > 20


def test_copies_of_a_question_make_no_further_bags(skewed):
    copied = skewed.unionByName(skewed.where("posting_type = 1").withColumn("id", F.lit(7).cast("bigint")))
    df = postings.group_postings(copied, bag_size=100)
    text = final_plan(df)
    assert "skew=true" in text and text.count("ReusedExchange") >= 2
    hot = df.where("qid = 7").agg(F.sum("n"), F.count("bag"), F.max(F.size("pairs")), F.sum(F.size("pairs"))).first()
    assert hot[0] == 3001 * 3001 and 20 < hot[1] <= 31 and hot[2] < 200 and hot[3] == 3001


def test_scoring_shuffles_one_row_per_question(skewed):
    df = postings.score_postings(skewed)
    text = final_plan(df)
    assert "SortMergeJoin" in text and "skew=true" not in text
    assert df.count() == 3000 and df.where("id = 7").first().high_score == 49


def test_scoring_splits_an_id_that_a_third_of_all_questions_share(skewed):
    shared = skewed.where("posting_type = 1").withColumn("score", F.col("id").cast("int")).withColumn("id", F.lit(7).cast("bigint"))
    df = postings.score_postings(skewed.unionByName(shared))
    assert "skew=true" in final_plan(df)
    # The shared question with score 0 is a copy of the one that was there.
    assert df.count() == 5999 and df.where("id = 7 AND high_score = 49").count() == 3000


@pytest.fixture()
def hot_index(spark, tmp_path):
    texts = spark.range(0, 3000, 1, 6).select(F.col("id").cast("string").alias("title"), F.concat_ws(" ", F.lit("the"), F.col("id"), F.when(F.col("id") % 3 == 0, "la")).alias("text"))
    path = str(tmp_path / "texts")
    texts.write.parquet(path)
    return mentions.index_articles(spark.read.parquet(path), ["the", "la", "zzz"])


def test_bags_of_a_hot_keyword(skewed, hot_index):
    """Here the keywords with several bags may not be broadcast: Spark splits the hot one where it is looked up."""
    bags = mentions.bag_index(hot_index, bag_size=100)
    assert "skew=true" in final_plan(bags)
    rows = bags.groupBy("keyword").agg(F.sum("n"), F.max(F.size("articles")), F.count("bag")).collect()
    assert {r[0]: r[1] for r in rows} == {"the": 3000, "la": 1000}
    assert all(r[2] < 200 for r in rows) and all(r[3] >= r[1] / 100 for r in rows)


def test_an_article_is_shuffled_once_into_its_bag(hot_index):
    """By default the few keywords with several bags are broadcast."""
    text = final_plan(mentions.bag_index(hot_index, bag_size=100))
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text and "BroadcastHashJoin" in text


def test_a_crowd_is_counted_before_it_is_shuffled(spark, monkeypatch):
    monkeypatch.setattr(bags, "CROWD", 50)
    rows = [("copy", "the same")] * 2000 + [(str(i), f"the {i % 700}") for i in range(1400)] + [("twice", "the x")] * 2
    index = mentions.index_articles(spark.createDataFrame(rows, "title string, text string").repartition(4), ["the"])
    df = mentions.bag_index(index, bag_size=100)
    found = {(a["title"], a["text"]): a["copies"] for r in df.collect() for a in r["articles"]}
    assert found == {("copy", "the same"): 2000, ("twice", "the x"): 2} | {(str(i), f"the {i % 700}"): 1 for i in range(1400)}
    assert df.agg(F.sum("n"), F.sum(F.size("articles"))).first()[:] == (3402, 1402)
    # Of the crowd each task sends one row.
    assert "partial_count" in plan(df)
