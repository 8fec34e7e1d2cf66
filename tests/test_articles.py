import pytest
from helpers import JOB_FAILS, tuples

from tallyloom.sources.articles import article_lines, article_rejects, parse_articles, read_articles

GOOD = "<page><title> Foo</title><text> a b c  </text></page>"
# Both delimiters are in the text; only the first one counts.
TWICE = "<page><title> T</title><text>x</title><text>y  </text></page>"
EMPTY = "<page><title> </title><text>  </text></page>"
BAD = ["no delimiter at all", "<title>x</title><text>starts too early to hold a title", "<page><title> T</title><text>short"]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_title_and_text_are_cut_out(spark):
    rows = tuples(parse_articles(lines(spark, [GOOD, TWICE, EMPTY])))
    assert rows == [("Foo", " a b c"), ("T", "x</title><text>y"), ("", "")]


@pytest.mark.parametrize("bad", [*BAD, None])
def test_malformed_line_fails_the_job(spark, bad):
    with pytest.raises(JOB_FAILS):
        parse_articles(lines(spark, [GOOD, bad])).select("title").collect()


def test_malformed_line_fails_even_a_count(spark):
    with pytest.raises(JOB_FAILS):
        parse_articles(lines(spark, [GOOD, BAD[0]])).count()


def test_permissive_parse_and_rejects_split_the_input(spark):
    mixed = lines(spark, [GOOD, *BAD, TWICE, None])
    assert parse_articles(mixed, strict=False).count() == 2
    assert [r.value for r in article_rejects(mixed).collect()] == [*BAD, None]


def test_round_trip_through_a_file(spark, tmp_path):
    articles = spark.createDataFrame([("ä", "one\ntwo\r\nthree"), ("", ""), ("𝄞", " 𝄞 x ")], "title string, text string")
    path = str(tmp_path / "articles")
    article_lines(articles).write.text(path)
    assert sorted(tuples(read_articles(spark, path))) == [("", ""), ("ä", "one two  three"), ("𝄞", " 𝄞 x ")]
