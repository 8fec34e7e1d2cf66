"""Rows and rejects of one pass."""

import shutil

from helpers import plan, tuples

from tallyloom.sources.articles import article_lines, article_rejects, parse_articles, split_articles
from tallyloom.sources.postings import parse_postings, posting_rejects, split_postings

LINES = {
    None: "no line", "": "no delimiter", "just text": "no delimiter", "</title><text>x  </text></page>": "no title",
    "<page><title> T</title><text>": "text cut off",
}


def lines_of(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string").repartition(3)


def test_articles_and_rejects_with_reasons(spark):
    articles = [("T", "a b"), ("T", "a b"), ("", ""), ("U", "x=1/y: %")]
    good = article_lines(spark.createDataFrame(articles, "title string, text string"))
    lines = good.unionByName(lines_of(spark, [*LINES, "just text"]))
    split = split_articles(lines)
    assert sorted(tuples(split.rows)) == sorted(articles) == sorted(tuples(parse_articles(lines, strict=False)))
    assert sorted(tuples(split.rejects), key=repr) == sorted([*LINES.items(), ("just text", "no delimiter")], key=repr)
    assert sorted(tuples(split.rejects.select("value")), key=repr) == sorted(tuples(article_rejects(lines)), key=repr)


def test_postings_and_rejects_with_reasons(spark):
    bad = {
        "": "posting_type is missing", "x,1,,,3,": "posting_type is no number", "1,,,,3,": "id is missing", "1,y,,,3,t": "id is no number",
        "1,2,z,,3,": "accepted_answer is no number", "2,2,,q,3,": "parent_id is no number", "1,2,,,,t": "score is missing",
        "1,2,,,n/a,t": "score is no number", "1,99999999999999999999,,,3,": "id is no number",
    }
    good = ["1,2,,,3,Java", "2,3,,2,-4,", "2,3,,2,-4", "1,5,6,,0,a,b,c"]
    lines = lines_of(spark, [*bad, *good])
    split = split_postings(lines)
    assert sorted(tuples(split.rejects)) == sorted(bad.items())
    assert sorted(tuples(split.rows), key=repr) == sorted(tuples(parse_postings(lines, strict=False)), key=repr) and split.rows.count() == 4
    assert sorted(tuples(posting_rejects(lines))) == sorted((v,) for v in bad)


def test_lines_are_read_once(spark, tmp_path):
    path = tmp_path / "lines"
    article_lines(spark.createDataFrame([("T", "a b")], "title string, text string")).unionByName(lines_of(spark, ["bad"])).write.text(str(path))
    split = split_articles(spark.read.text(str(path)))
    shutil.rmtree(path)
    assert tuples(split.rows) == [("T", "a b")] and tuples(split.rejects) == [("bad", "no delimiter")]
    for part in split:
        assert "PartitionFilters: [isnotnull(__good" in plan(part) or "PartitionFilters: [__good" in plan(part) or "PartitionFilters: [NOT __good" in plan(part)


def test_no_lines_and_no_rejects(spark):
    none = lines_of(spark, [])
    assert all(part.isEmpty() for part in (*split_articles(none), *split_postings(none)))
