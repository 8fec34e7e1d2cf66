import random

import pytest
from helpers import JOB_FAILS, plan, tuples
from pyspark.sql import types as T

from tallyloom.functions.survey import classify_columns, hours
from tallyloom.operators import survey
from tallyloom.plans import flows
from tallyloom.sources.survey import header_names, read_survey, survey_schema

CSV = """\
id,telfs,tesex,teage,t010101,t020101,t050101,t170101,t180101,t180201,t180501
a,1,1,22,60,30,120,999,60,30,60
b,2,1,18,180,30,0,999,0,30,0
c,4,2,14,60,60,0,999,0,0,0
d,5,1,40,60,60,60,999,0,0,0
"""
SUMMARY = [
    ("working", "male", "young", 2.0, 3.0, 1.0),
    ("working", "male", "young", 3.0, 0.0, 1.0),
    ("not working", "female", "elder", 1.0, 0.0, 1.0),
]
GROUPED = [("not working", "female", "elder", 1.0, 0.0, 1.0), ("working", "male", "young", 2.5, 1.5, 1.0)]


def written(tmp_path, text, name="survey.csv"):
    path = tmp_path / name
    path.write_text(text)
    return str(path)


def summary(spark, path):
    names, rows = read_survey(spark, path)
    return survey.summarize(rows, classify_columns(names))


def test_schema_from_names():
    schema = survey_schema(["tucaseid", "a", "b"])
    assert [f.dataType for f in schema] == [T.StringType(), T.DoubleType(), T.DoubleType()]
    assert not any(f.nullable for f in schema)


def test_read(spark, tmp_path):
    names, rows = read_survey(spark, written(tmp_path, CSV))
    assert names == CSV.split("\n")[0].split(",") == rows.columns
    assert tuples(rows)[0] == ("a", 1.0, 1.0, 22.0, 60.0, 30.0, 120.0, 999.0, 60.0, 30.0, 60.0)
    assert [f.dataType for f in rows.schema] == [f.dataType for f in survey_schema(names)]


def test_every_file_of_a_folder_has_its_header(spark, tmp_path):
    written(tmp_path, CSV, "1.csv")
    written(tmp_path, CSV, "2.csv")
    assert read_survey(spark, str(tmp_path))[1].count() == 8


def test_another_header_in_a_folder_fails_the_job(spark, tmp_path):
    written(tmp_path, CSV, "1.csv")
    written(tmp_path, CSV.replace("telfs,tesex", "tesex,telfs"), "2.csv")
    with pytest.raises(JOB_FAILS):
        read_survey(spark, str(tmp_path))[1].collect()
    with pytest.raises(JOB_FAILS):
        summary(spark, str(tmp_path)).collect()


def test_empty_file_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError):
        header_names(spark, written(tmp_path, ""))


def test_quotes_are_plain_characters(spark, tmp_path):
    rows = read_survey(spark, written(tmp_path, 'id,v\n"x,1\n"y",2\n'))[1]
    assert tuples(rows) == [('"x', 1.0), ('"y"', 2.0)]


@pytest.mark.parametrize("bad", [
    "e,1,1,22,60,30,120,999,60,30,",
    "e,1,1,22,60,30,120,999,60,30",
    "e,1,1,22,60,30,,999,60,30,60",
    "e,1,1,22,60,text,120,999,60,30,60",
])
def test_a_bad_row_fails_the_job(spark, tmp_path, bad):
    path = written(tmp_path, CSV + bad + "\n")
    with pytest.raises(JOB_FAILS):
        read_survey(spark, path)[1].collect()
    with pytest.raises(JOB_FAILS):
        read_survey(spark, path, check_whole_rows=True)[1].select("telfs").count()
    with pytest.raises(JOB_FAILS):
        summary(spark, path).collect()


def test_the_first_column_may_be_empty(spark, tmp_path):
    path = written(tmp_path, CSV + ",1,1,22,60,30,120,999,60,30,60\n")
    for whole in (False, True):
        assert read_survey(spark, path, whole)[1].where("id = ''").count() == 1


def test_a_survey_of_hundreds_of_columns(spark, tmp_path):
    names = ["id", "telfs", "tesex", "teage"] + [f"{p}{i:04d}" for p in ("t01", "t05", "t02") for i in range(130)]
    row = ["1", "1", "1", "30"] + ["2"] * 130 + ["3"] * 130 + ["6"] * 130
    averages = flows.average_time_use(spark, written(tmp_path, "\n".join([",".join(names)] + [",".join(row)] * 50) + "\n"))
    assert all(tuples(df) == [("working", "male", "active", 4.3, 6.5, 13.0)] for df in averages)


def test_unused_columns_are_not_read(spark, tmp_path):
    text = plan(summary(spark, written(tmp_path, CSV)))
    assert "telfs" in text and "t170101" not in text[text.index("ReadSchema"):].split("\n")[0]


def test_columns_are_classified_by_prefix_in_order():
    names = ["t180499", "tucaseid", "t1801a", "t01", "t03x", "t0x", "t05b", "t1805", "t1803", "t11", "t18", "t02", "t04",
             "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16", "t17", "t50", "teage", "xt01"]
    classes = classify_columns(names)
    assert classes.primary_needs == ["t1801a", "t01", "t03x", "t1803", "t11"]
    assert classes.work == ["t05b", "t1805"]
    assert classes.other == ["t180499", "t18", "t02", "t04", "t06", "t07", "t08", "t09", "t10", "t12", "t13", "t14", "t15", "t16"]


def test_hours_add_from_left_to_right(spark):
    names = [f"c{i}" for i in range(300)] + ["odd`name.x"]
    rng = random.Random(1)
    values = [rng.uniform(0, 1e6) for _ in names]
    df = spark.createDataFrame([("x", *values)], survey_schema(["id", *names]))
    total = 0.0
    for v in values:
        total += v
    assert df.select(hours(names)).first()[0] == total / 60
    with pytest.raises(ValueError):
        hours([])


def test_summary(spark, tmp_path):
    assert tuples(summary(spark, written(tmp_path, CSV))) == SUMMARY


@pytest.mark.parametrize("telfs, tesex, teage, expected", [
    (1, 1, 15, ("working", "male", "young")), (2.9, 2, 22, ("working", "female", "young")),
    (3, 1, 22.5, ("not working", "male", "elder")), (4, 0, 23, ("not working", "female", "active")),
    (0.5, 1.5, 55, ("not working", "female", "active")), (1, 1, 14, ("working", "male", "elder")),
    (1, 1, 55.1, ("working", "male", "elder")), (4.5, 1, 30, None), (5, 1, 30, None),
])
def test_groups_of_persons(spark, telfs, tesex, teage, expected):
    names = ["telfs", "tesex", "teage", "t01", "t05", "t02"]
    df = spark.createDataFrame([(float(telfs), float(tesex), float(teage), 1.0, 1.0, 1.0)], names)
    rows = tuples(survey.summarize(df, classify_columns(names)))
    assert [r[:3] for r in rows] == ([expected] if expected else [])


def test_three_interfaces_agree(spark, tmp_path):
    averages = flows.average_time_use(spark, written(tmp_path, CSV))
    assert all(tuples(df) == GROUPED for df in averages)


def test_sql_uses_the_view_it_is_given(spark, tmp_path):
    df = summary(spark, written(tmp_path, CSV))
    assert tuples(survey.grouped_sql(df, "my view`s name")) == GROUPED
    assert "`other_view`" in survey.grouped_query("other_view")


def test_averaging_averages_changes_nothing(spark, tmp_path):
    once = survey.grouped(summary(spark, written(tmp_path, CSV)))
    assert tuples(survey.grouped_typed(survey.as_rows(survey.grouped_sql(once)))) == tuples(once)


def test_rounding_is_half_up(spark):
    rows = [("w", "m", "y", 2.25, -0.05, 0.04)]
    df = spark.createDataFrame(rows, survey.ROW_SCHEMA)
    assert tuples(survey.grouped(df)) == [("w", "m", "y", 2.3, -0.1, 0.0)]


def test_rows_are_checked_against_the_schema(spark):
    df = spark.createDataFrame([("w", "m", "y", 1.0, 2.0, 3.0, 9)], "working string, sex string, age string, primaryNeeds double, work double, other double, extra int")
    assert survey.as_rows(df).columns == survey.ROW_SCHEMA.fieldNames()
    for bad in (df.drop("work"), df.withColumn("work", df.work.cast("int")), df.withColumn("sex", df.work)):
        with pytest.raises(TypeError):
            survey.as_rows(bad)
    missing = spark.createDataFrame([("w", "m", "y", 1.0, None, 3.0)], survey.ROW_SCHEMA)
    with pytest.raises(JOB_FAILS):
        survey.as_rows(missing).collect()
