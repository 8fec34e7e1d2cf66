import random
import re

import pytest
from helpers import plan, tuples
from pyspark.sql import functions as F

from tallyloom.functions.tokens import LANGUAGES
from tallyloom.operators import mentions

TOOLS = ["saw", "drill", "file", "rasp", "plane", "chisel", "vice"]


def shop_notes(n):
    """Note i holds every tool whose place divides it, between other words; every fourth note comes twice."""
    notes = []
    for i in range(1, n + 1):
        held = [tool for place, tool in enumerate(TOOLS, 2) if i % place == 0]
        notes += [(f"note {i}", " ".join(["we", *held, "bring", str(i), *held[:1]]))] * (2 if i % 4 == 0 else 1)
    return notes


NOTES = shop_notes(40)


def articles(spark, rows):
    return spark.createDataFrame(rows, "title string, text string")


def occurrences(spark, texts, keyword):
    return mentions.occurrences(articles(spark, [("t", text) for text in texts]), keyword).first().n


@pytest.mark.parametrize("text, hit", [
    ("Java Jaguar", 1), ("Jaguar Java", 1), ("Java", 1), ("a Java b", 1), ("Java Java", 1), ("  Java  ", 1),
    ("Java,", 0), ("JavaScript", 0), ("java", 0), ("", 0), ("a\nJava", 0), ("Java\tb", 0), ("xJava", 0),
])
def test_a_keyword_is_a_whole_token_between_blanks(spark, text, hit):
    assert occurrences(spark, [text], "Java") == hit
    assert mentions.rank_by_count(articles(spark, [("Java", text)]), ["Java"]).count() == hit


def test_occurrences_of_absent_keyword_and_empty_input(spark):
    assert occurrences(spark, ["Java Jaguar", "Java Jaguar"], "PHP") == 0
    assert occurrences(spark, [], "Java") == 0


def test_title_is_not_searched(spark):
    assert mentions.index_articles(articles(spark, [("Java", "none")]), ["Java"]).isEmpty()


def test_rankings_of_notes(spark):
    expected = sorted(((-n, k) for k, n in brute_force(NOTES, TOOLS).items()))
    expected = [(k, -n) for n, k in expected]
    assert tuples(mentions.rank_by_index(mentions.index_articles(articles(spark, NOTES), TOOLS))) == expected
    assert tuples(mentions.rank_by_count(articles(spark, NOTES), TOOLS)) == expected


def test_only_the_full_ranking_keeps_zeros_and_later_keywords_lead_ties(spark):
    vocabulary = ["forge", "bring", "we", "rasp", "anvil"]
    n = brute_force(NOTES, vocabulary)
    ranked = tuples(mentions.rank_all(articles(spark, NOTES), vocabulary))
    assert ranked == [("we", len(NOTES)), ("bring", len(NOTES)), ("rasp", n["rasp"]), ("anvil", 0), ("forge", 0)]
    assert tuples(mentions.rank_by_count(articles(spark, NOTES), vocabulary)) == [("bring", len(NOTES)), ("we", len(NOTES)), ("rasp", n["rasp"])]
    assert tuples(mentions.rank_all(articles(spark, []), vocabulary)) == [(k, 0) for k in reversed(vocabulary)]


def test_index_keeps_equal_articles_and_whole_texts(spark):
    index = mentions.index_articles(articles(spark, NOTES), TOOLS)
    assert sorted(tuples(index)) == sorted((k, *note) for note in NOTES for k in TOOLS if k in note[1].split(" "))
    assert "Exchange" not in plan(index)


def test_vocabulary_is_checked(spark):
    for vocabulary in (["Java", "Java"], ["Java", ""]):
        for rank in (mentions.rank_all, mentions.rank_by_count, mentions.index_articles):
            with pytest.raises(ValueError):
                rank(articles(spark, NOTES), vocabulary)


def test_keyword_with_a_blank_is_never_found(spark):
    assert occurrences(spark, ["Visual Basic"], "Visual Basic") == 0
    assert tuples(mentions.rank_all(articles(spark, [("t", "Visual Basic")]), ["Visual Basic", "Basic"])) == [("Basic", 1), ("Visual Basic", 0)]
    assert tuples(mentions.rank_all(articles(spark, [("t", "  ")]), ["Visual Basic"])) == [("Visual Basic", 0)]


@pytest.fixture()
def random_articles():
    rng = random.Random(7)
    words = [*LANGUAGES, "x", "", "java", "Java,"]
    return [(str(i), " ".join(rng.choice(words) for _ in range(rng.randrange(12)))) for i in range(300)]


def brute_force(rows, vocabulary):
    return {k: sum(k in text.split(" ") for _, text in rows) for k in vocabulary}


def as_table(spark, keywords):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keywords)], "keyword string, position int")


@pytest.mark.parametrize("bits", [None, 64, 1 << 10, 1 << 24])
def test_all_rankings_agree_with_brute_force(spark, random_articles, monkeypatch, bits):
    """Of a list, and of a table whose bitmap lets all tokens, some or none pass that are no keywords."""
    df = articles(spark, random_articles)
    listed = [*LANGUAGES, "Cobol", "Two Words"]
    if bits:
        monkeypatch.setattr(mentions, "BITMAP_BITS", bits)
    vocabulary = as_table(spark, listed) if bits else listed
    expected = brute_force(random_articles, listed)
    index = mentions.index_articles(df, vocabulary)
    some = {k: n for k, n in expected.items() if n}
    rankings = {
        "all": (mentions.rank_all(df, vocabulary), expected),
        "count": (mentions.rank_by_count(df, vocabulary), some),
        "index": (mentions.rank_by_index(index), some),
        "bags": (mentions.rank_by_index(mentions.bag_index(index, bag_size=7)), some),
    }
    for ranked, wanted in rankings.values():
        rows = tuples(ranked)
        assert dict(rows) == wanted
        assert [n for _, n in rows] == sorted((n for _, n in rows), reverse=True)
    assert tuples(rankings["all"][0]) == sorted(expected.items(), key=lambda r: (-r[1], -listed.index(r[0])))


def test_a_table_is_checked_like_a_list(spark):
    for keywords in (["Java", "Java"], ["Java", ""], ["Java", None]):
        with pytest.raises(ValueError):
            mentions.rank_all(articles(spark, NOTES), as_table(spark, keywords))
    assert mentions.rank_all(articles(spark, NOTES), as_table(spark, [])).isEmpty()
    assert mentions.index_articles(articles(spark, NOTES), as_table(spark, [])).isEmpty()


def test_a_vocabulary_is_numbered_in_its_order(spark):
    words = spark.range(0, 5000, 1, 16).select((F.col("id") % 1777).cast("string").alias("word"))
    rows = words.unionByName(spark.createDataFrame([("",), (None,)], "word string"))
    assert sorted(tuples(mentions.numbered_vocabulary(rows))) == [(k, i) for i, k in enumerate(sorted(map(str, range(1777))))]


def shape(df) -> list[str]:
    """Operators of a plan from the top, without what Spark adds for whole stages."""
    return re.findall(r"(?m)^[\s:+\-*()0-9]*([A-Z]\w+)", plan(df))


def test_a_table_of_any_size_has_one_plan(spark, tmp_path):
    """20 and 2,000,000 keywords: the same operators, one scan and one split of the articles, a bitmap of bounded size."""
    path = str(tmp_path / "articles")
    articles(spark, NOTES).write.parquet(path)
    plans = {}
    for n in (20, 2_000_000):
        keywords = spark.range(n).select(F.concat(F.lit("w"), "id").alias("keyword"), F.col("id").alias("position"))
        known = keywords.unionByName(as_table(spark, TOOLS).withColumn("position", F.col("position") + n))
        words = mentions.check_vocabulary(spark, known)
        df = spark.read.parquet(path)
        ranked, index = mentions.rank_by_count(df, words), mentions.index_articles(df, words)
        assert dict(tuples(ranked)) == brute_force(NOTES, TOOLS)
        assert index.count() == sum(brute_force(NOTES, TOOLS).values())
        fresh = [rank(df, words) for rank in (mentions.rank_by_count, mentions.rank_all)]
        plans[n] = [shape(f) for f in fresh]
        for f in (*fresh, mentions.index_articles(df, words)):
            assert plan(f).count("split(text") == 1 and "LocalTableScan" not in plan(f)
        assert mentions._bitmap(words.rows).count() <= mentions.BITMAP_BITS // 64
    assert plans[20] == plans[2_000_000]


def test_bags_are_bounded_and_whole(spark):
    """A third of all articles are copies, and one keyword is in every article."""
    rows = [("copy", "Java and Scala")] * 1000 + [(str(i), f"Java {i}") for i in range(2000)]
    bags = mentions.bag_index(mentions.index_articles(articles(spark, rows), ["Java", "Scala"]), bag_size=100).collect()
    assert max(len(b.articles) for b in bags) < 200
    assert sum(b.n for b in bags if b.keyword == "Java") == 3000
    scala = [b for b in bags if b.keyword == "Scala"]
    assert [(b.n, [tuple(a) for a in b.articles]) for b in scala] == [(1000, [("copy", "Java and Scala", 1000)])]
    assert sum(len(b.articles) for b in bags) == 2002


def test_bags_of_long_articles_are_bounded_in_bytes(spark):
    rows = [(str(i), "Java " + "x" * 10_000) for i in range(200)] + [("long", "Java " + "y" * 500_000)]
    index = mentions.index_articles(articles(spark, rows), ["Java"])
    bags = mentions.bag_index(index, bag_bytes=100_000).collect()
    assert sum(b.n for b in bags) == 201
    sizes = [sum(len(a.text) for a in b.articles) for b in bags]
    assert max(sizes) < 800_000 and sum(sizes) > 2_500_000
    assert len(mentions.bag_index(index).collect()) == 1
    with pytest.raises(ValueError):
        mentions.bag_index(index, bag_bytes=0)
