"""Tables laid out for joins, and how long intermediate tables live."""

import os

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from tallyloom.operators import postings
from tallyloom.plans import layout, storage


@pytest.fixture()
def hot(spark):
    """Question 7 has a third of all answers; question 8 occurs three times, question 9 has no answer."""
    columns = "posting_type int, id long, accepted_answer long, parent_id long, score int, tags string"
    rows = [(1, k, None, None, 0, "x") for k in [*range(100), 8, 8]]
    rows += [(2, 1000 + k, None, k % 100, k % 40 - 5, None) for k in range(400) if k % 100 != 9]
    rows += [(2, 5000 + k, None, 7, k % 40, None) for k in range(200)] + [(2, 9000, None, 12345, 1, None)]
    return spark.createDataFrame(rows, columns).repartition(6)


@pytest.mark.parametrize("part_rows", [10, 1_000_000])
def test_placed_pairs_are_all_pairs_without_a_shuffle(spark, hot, part_rows):
    questions, answers = postings.place_pairs(hot, 5, part_rows=part_rows)
    pairs = postings.pair_placed(questions, answers)
    assert "Exchange" not in plan(pairs) and "SortMergeJoin" in plan(pairs)
    assert sorted(tuples(pairs)) == sorted(tuples(postings.pair_postings(hot)))
    counted = postings.count_placed(questions, answers)
    below = plan(counted).split("SortMergeJoin")[1]
    assert "Exchange" not in below and plan(counted).count("Exchange") == 1
    assert sorted(tuples(counted)) == sorted(
        tuples(postings.pair_postings(hot).groupBy("qid").agg(F.count(F.lit(1)), F.greatest(F.max("answer.score"), F.lit(0))))
    )


def test_a_hot_question_lies_in_several_buckets(hot):
    questions, answers = postings.place_pairs(hot, 5, part_rows=10)
    parts = {r["part"]: r["count"] for r in answers.where("qid = 7").groupBy("part").count().collect()}
    assert len(parts) > 15 and max(parts.values()) < 40
    assert questions.where("qid = 7").count() == 21 and questions.where("qid = 3").count() == 1
    files = answers.where("qid = 7").select(F.input_file_name()).distinct().count()
    assert files > 1
    with pytest.raises(ValueError):
        postings.place_pairs(hot, 0)
    with pytest.raises(ValueError):
        postings.place_pairs(hot, 5, part_rows=0)


def test_partitions_of_bags_grow_with_the_postings(spark, hot, monkeypatch):
    """What a task collects stays as it is when there are more postings than the session's partitions should hold."""
    grouped = sorted(tuples(postings.ungroup_postings(postings.group_postings(hot, bag_size=3))))
    monkeypatch.setattr(storage, "TASK_ROWS", 20, raising=False)
    bags = postings.group_postings(hot, bag_size=3)
    sizes = [r["count"] for r in bags.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 40
    assert sorted(tuples(postings.ungroup_postings(bags))) == grouped
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"


def test_buckets_grow_with_the_postings(spark, hot, monkeypatch):
    """A task sorts no more when there are more postings than the buckets asked for should hold."""
    monkeypatch.setattr(postings, "BUCKET_ROWS", 20, raising=False)
    questions, answers = postings.place_pairs(hot, 5, part_rows=10)
    sizes = [r["count"] for r in answers.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 20 and max(sizes) < 80
    pairs = postings.pair_placed(questions, answers)
    assert "Exchange" not in plan(pairs) and sorted(tuples(pairs)) == sorted(tuples(postings.pair_postings(hot)))


def files_under(folder):
    return [name for _, _, names in os.walk(folder) for name in names]


@pytest.fixture()
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr(storage, "shared_folder", lambda spark: str(tmp_path))
    return tmp_path


def test_a_scope_deletes_what_was_written_in_it(spark, hot, folder):
    before = {t.name for t in spark.catalog.listTables()}
    with storage.scope(spark):
        rows = storage.materialize(spark.range(10), "rows")
        with storage.scope(spark):
            pairs = postings.pair_placed(*postings.place_pairs(hot, 3))
            assert pairs.count() == postings.pair_postings(hot).count() and files_under(folder)
        assert rows.count() == 10  # of the outer scope
        assert {t.name for t in spark.catalog.listTables()} == before
    assert files_under(folder) == [] and os.listdir(folder) == []


def test_a_scope_deletes_after_a_failure(spark, folder):
    with pytest.raises(ZeroDivisionError), storage.scope(spark):
        layout.bucketed(spark.range(10), "rows", ["id"], 2)
        storage.materialize(spark.range(10), "rows")
        1 / 0
    assert files_under(folder) == []


def test_without_a_scope_tables_stay(spark, folder):
    assert storage.materialize(spark.range(10), "rows").count() == 10
    with storage.scope(spark):
        pass
    assert files_under(folder)


def test_a_flow_leaves_nothing(spark, folder, tmp_path_factory):
    from tallyloom.plans import flows
    from tallyloom.sources.articles import article_lines

    lines = article_lines(spark.createDataFrame([("a", "Java and Scala"), ("b", "Java")], "title string, text string"))
    path = str(tmp_path_factory.mktemp("articles") / "lines")
    lines.write.text(path)
    with storage.scope(spark):
        ranked = flows.rank_articles(spark, path, ["Java", "Scala", "PHP"])
        assert tuples(ranked.by_count) == [("Java", 2), ("Scala", 1)] and len(tuples(ranked.all_keywords)) == 3
        assert files_under(folder)
    assert files_under(folder) == []
