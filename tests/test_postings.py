import random

import pytest
from helpers import JOB_FAILS, plan, tuples
from pyspark.sql import functions as F

from tallyloom.functions.tokens import LANGUAGES
from tallyloom.operators import postings
from tallyloom.operators.bags import in_every_bag
from tallyloom.sources.postings import parse_postings, posting_lines, posting_rejects, read_postings

LINES = """\
1,10,,,3,Java
2,11,,10,7
2,12,,10,-4
1,20,,,0,Fortran
2,21,,20,-2
1,30,,,5,Scala
2,40,,99,8
1,50,,,1,
2,51,,50,2,""".split("\n")


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def parsed(spark, values):
    return parse_postings(lines(spark, values))


def test_fields(spark):
    rows = tuples(parsed(spark, ["1,10,12,,3,Java,more,fields", "2,11,,10,-7", "1,9999999999,,,1,", '1,1,,,+1,"a']))
    assert rows == [
        (1, 10, 12, None, 3, "Java"),
        (2, 11, None, 10, -7, None),
        (1, 9999999999, None, None, 1, None),
        (1, 1, None, None, 1, '"a'),
    ]


BAD = ["", "x", "1,10", "1,10,,,", "1,10,,,x,Java", "1,,,,3,Java", "1,10,y,,3", "2,10,,1.5,3", "1,10,,,99999999999", None]


@pytest.mark.parametrize("bad", BAD)
def test_malformed_line_fails_the_job(spark, bad):
    with pytest.raises(JOB_FAILS):
        parsed(spark, [*LINES, bad]).select("posting_type").collect()


def test_malformed_line_fails_the_job_without_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(JOB_FAILS):
            parsed(spark, [*LINES, BAD[4]]).count()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_permissive_parse_and_rejects_split_the_input(spark):
    mixed = lines(spark, [*LINES, *BAD])
    assert parse_postings(mixed, strict=False).count() == len(LINES)
    assert [r.value for r in posting_rejects(mixed).collect()] == BAD


def test_each_line_is_split_once(spark):
    assert plan(parsed(spark, LINES)).count("split(") == 1


def test_round_trip_through_a_file(spark, tmp_path):
    path = str(tmp_path / "postings")
    posting_lines(parsed(spark, LINES)).write.text(path)
    assert sorted(map(str, tuples(read_postings(spark, path)))) == sorted(map(str, tuples(parsed(spark, LINES))))


def pairs(df):
    return sorted((r.qid, r.question.id, r.answer.id) for r in df.collect())


def test_pairs_leave_out_unanswered_questions_and_orphan_answers(spark):
    assert pairs(postings.pair_postings(parsed(spark, LINES))) == [(10, 10, 11), (10, 10, 12), (20, 20, 21), (50, 50, 51)]


def test_answer_without_parent_belongs_to_key_0(spark):
    df = parsed(spark, ["1,0,,,1,Java", "2,5,,,3"])
    assert pairs(postings.pair_postings(df)) == [(0, 0, 5)]
    assert [r.high_score for r in postings.score_postings(df).collect()] == [3]


@pytest.mark.parametrize("operator", [
    postings.pair_postings, postings.score_postings, postings.group_postings,
    lambda df: postings.place_by_key(df, 4),
    lambda df: postings.vectorize(postings.score_postings(df)).select("y"),
])
def test_unknown_posting_type_fails_the_job(spark, operator, tmp_path):
    """From a file too, where the filters on the type reach the scan."""
    df = parsed(spark, [*LINES, "3,60,,,1,Java"])
    path = str(tmp_path / "postings")
    df.write.parquet(path)
    for source in (df, spark.read.parquet(path)):
        with pytest.raises(JOB_FAILS):
            operator(source).collect()


def test_unknown_posting_type_can_be_left_out(spark):
    df = parsed(spark, [*LINES, "3,60,,10,99,Java"])
    scores = {r.id: r.high_score for r in postings.score_postings(df, strict=False).collect()}
    assert scores == {10: 7, 20: 0, 50: 2}
    assert len(pairs(postings.pair_postings(df, strict=False))) == 4


def test_best_score_is_at_least_0_and_equal_questions_collapse(spark):
    scored = postings.score_postings(parsed(spark, [*LINES, LINES[0], "1,10,,,3,Scala"]))
    assert sorted((r.id, r.tags or "", r.high_score) for r in scored.collect()) == [
        (10, "Java", 7), (10, "Scala", 7), (20, "Fortran", 0), (50, "", 2),
    ]


def test_vectors(spark):
    scored = postings.score_postings(parsed(spark, LINES))
    assert sorted(tuples(postings.vectorize(scored))) == [(10, 50000, 7), (20, 0, 0), (50, 0, 2)]
    assert tuples(postings.vectorize(scored, unmatched="drop")) == [(10, 50000, 7)]
    assert LANGUAGES.index("Java") == 1


def test_vector_settings_are_checked(spark):
    scored = postings.score_postings(parsed(spark, LINES))
    for bad in ({"unmatched": "other"}, {"spread": 0}, {"languages": []}, {"spread": 2**30}):
        with pytest.raises(ValueError):
            postings.vectorize(scored, **bad)


def random_lines(seed):
    """A third of all lines answer one question, and a third are copies of one question."""
    rng = random.Random(seed)
    few = [f"1,{rng.randrange(60)},,,{rng.randrange(3)},{rng.choice(['Java', 'Scala', '', 'x'])}" for _ in range(150)]
    few += [f"2,{1000 + i},,{rng.choice(['', *range(80)])},{rng.randrange(-5, 30)}" for i in range(150)]
    hot = [f"2,{5000 + i},,7,{rng.randrange(-5, 30)}" for i in range(300)]
    return few + hot + ["1,7,,,1,Java"] * 300


def brute_force(values):
    rows = [(v.split(",") + [""])[:6] for v in values]
    answers = [(r[3] or "0", r) for r in rows if r[0] == "2"]
    questions = [r for r in rows if r[0] == "1"]
    return [(q, a) for q in questions for key, a in answers if key == q[1]]


def test_pairs_scores_and_bags_agree_with_brute_force(spark):
    values = random_lines(3)
    df = parsed(spark, values)
    expected = brute_force(values)
    best = {}
    for q, a in expected:
        best[tuple(q)] = max(best.get(tuple(q), 0), int(a[4]))
    wanted = sorted((int(q[1]), int(q[4]), q[5], s) for q, s in best.items())

    def scores(scored):
        return sorted((r.id, r.score, r.tags or "", r.high_score) for r in scored.collect())

    paired = postings.pair_postings(df)
    assert pairs(paired) == sorted((int(q[1]), int(q[1]), int(a[1])) for q, a in expected)
    assert scores(postings.score_postings(df)) == wanted
    assert scores(postings.score_pairs(paired)) == wanted
    grouped = postings.group_postings(df, bag_size=50)
    assert scores(postings.score_pairs(postings.ungroup_postings(grouped))) == wanted
    bags = grouped.collect()
    assert sum(b.n for b in bags) == len(expected)
    assert max(len(b.pairs) for b in bags) < 100
    assert sum(b.qid == 7 for b in bags) > 1


def test_bags_of_an_id_that_many_questions_share_are_bounded(spark):
    values = [f"1,7,,,{i},Java" for i in range(900)] + ["2,1,,7,5", "2,1,,7,5", "2,2,,7,6"]
    bags = postings.group_postings(parsed(spark, values), bag_size=100).collect()
    assert sum(b.n for b in bags) == 2700 and sum(len(b.pairs) for b in bags) == 1800
    assert max(len(b.pairs) for b in bags) < 300
    assert len({b.bag for b in bags}) == len(bags) > 8


def test_a_row_goes_into_every_bag_once(spark):
    df = spark.createDataFrame([(1, 1), (2, 3), (3, 4096), (4, 4097), (5, 10_000)], "id int, bags bigint")
    dealt = in_every_bag(df, "bags", "bag").groupBy("id", "bags").agg(F.count_distinct("bag"), F.count("bag"), F.min("bag"), F.max("bag"))
    assert sorted(tuples(dealt)) == [(i, n, n, n, 0, n - 1) for i, n in sorted(tuples(df))]


def test_placing_keeps_every_row_and_splits_a_hot_key(spark):
    values = random_lines(4)
    placed = postings.place_by_key(parsed(spark, values), 8)
    assert placed.count() == len(values)
    assert placed.rdd.getNumPartitions() == 8
    ids = placed.where("key = 7 AND posting_type = 2").selectExpr("spark_partition_id() AS p").distinct().count()
    assert ids > 1


def test_scoring_reduces_both_sides_before_the_join(spark):
    text = plan(postings.score_postings(parsed(spark, LINES)))
    join = text.index("Join")
    assert text.count("HashAggregate", join) == 4 and "HashAggregate" not in text[:join]
    assert "partial_max" in text and "Python" not in text
