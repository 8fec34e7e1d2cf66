
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyloom.functions.survey import ActivityColumns, classify_columns
from tallyloom.operators import bounded, clusters, mentions, nearest, postings, quantiles, sampling, survey
from tallyloom.plans import flows
from tallyloom.plans.storage import new_path
from tallyloom.sources import tables
from tallyloom.sources.articles import article_lines, article_rejects, parse_articles, read_articles, split_articles
from tallyloom.sources.postings import parse_postings, posting_lines, posting_rejects, read_postings, split_postings
from tallyloom.sources.survey import read_survey

KEYWORD = "the"
VOCABULARY = ("the", "The", "und", "la", "C++", "zzz")
SETTINGS = clusters.ClusterSettings(
    languages=("1-URGENT", "2-HIGH", "3-MEDIUM"), kernels=9, eta=1.0
)
# Start means sampled without regard to language.
NARROW = clusters.ClusterSettings(languages=SETTINGS.languages, spread=100, kernels=9, eta=1.0)
# More than Spark's limit for cutting windows short.
MANY_PER_LANGUAGE = 2_000
# Small enough that questions and keywords of the test tables fill several bags.
BAG_SIZE = 3
FIXED_MEANS = [(0, 3), (0, 12), (0, 20), (50_000, 5), (50_000, 12), (50_000, 19), (100_000, 12), (100_000, 24), (400_000, 0)]
NUM_PARTITIONS = 8
# Small enough that questions of the test tables are dealt into several parts.
PART_ROWS = 3
SAMPLE_SIZE = 9
FRACTIONS = (0.0, 0.01, 0.25, 0.5, 0.9, 0.999, 1.0)
ACTIVITIES = ActivityColumns(["t010101", "t030101"], ["t050101"], ["t020101", "t040101"])


def entry(spark: SparkSession) -> DataFrame:
    return mentions.rank_by_count(tables.articles(spark, "/root/testdata/sf0.001"), VOCABULARY)


# -- mentions ---------------------------------------------------------------


def _written_lines(lines: DataFrame, name: str) -> str:
    """Path of a text file in the shared folder with the given lines."""
    path = new_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


def article_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = article_lines(tables.articles(spark, sf))
    return read_articles(spark, _written_lines(lines, "articles"))


def _mixed_article_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A file with English documents as article lines, all others as bare text."""
    documents = tables.table(spark, sf, "documents")
    good = documents.where("lang = 'en'").select(F.col("doc_id").cast("string").alias("title"), "text")
    bad = documents.where("lang IS DISTINCT FROM 'en'").select(F.translate("text", "\r\n", "  ").alias("value"))
    return spark.read.text(_written_lines(article_lines(good).unionByName(bad), "articles"))


def article_parse_permissive(spark: SparkSession, sf: str) -> DataFrame:
    return parse_articles(_mixed_article_lines(spark, sf), strict=False)


def article_parse_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return article_rejects(_mixed_article_lines(spark, sf))


def article_split(spark: SparkSession, sf: str) -> DataFrame:
    """Articles, and the lines that are none with the reason, from one pass."""
    good, bad = split_articles(_mixed_article_lines(spark, sf))
    nothing = F.lit(None).cast("string")
    rejects = bad.select(nothing.alias("title"), nothing.alias("text"), "value", "reason")
    return good.select("title", "text", nothing.alias("value"), nothing.alias("reason")).unionByName(rejects)


def mention_occurrences(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.occurrences(tables.articles(spark, sf), KEYWORD)


def mention_index(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.index_articles(tables.articles(spark, sf), VOCABULARY)


def mention_index_bags(spark: SparkSession, sf: str) -> DataFrame:
    bags = mentions.bag_index(mentions.index_articles(tables.articles(spark, sf), VOCABULARY), bag_size=BAG_SIZE)
    return bags.select("keyword", F.explode("articles").alias("a")).select("keyword", "a.*")


def rank_naive(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.rank_all(tables.articles(spark, sf), VOCABULARY)


def rank_index(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.rank_by_index(mentions.index_articles(tables.articles(spark, sf), VOCABULARY))


def rank_index_bags(spark: SparkSession, sf: str) -> DataFrame:
    index = mentions.index_articles(tables.articles(spark, sf), VOCABULARY)
    return mentions.rank_by_index(mentions.bag_index(index, bag_size=BAG_SIZE))


def _large_vocabulary(spark: SparkSession, sf: str) -> DataFrame:
    """All words of the benchmark table, numbered in their order."""
    words = tables.table(spark, sf, "benchmark").select(F.explode(F.split("text", " ")).alias("word"))
    return mentions.numbered_vocabulary(words.where("NOT contains(word, '\\n')"))


def rank_large(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.rank_by_count(tables.articles(spark, sf), _large_vocabulary(spark, sf))


def rank_large_zeros(spark: SparkSession, sf: str) -> DataFrame:
    never = spark.range(1).select(F.lit("never found").alias("keyword"), F.lit(-1).cast("long").alias("position"))
    return mentions.rank_all(tables.articles(spark, sf), _large_vocabulary(spark, sf).unionByName(never))


def index_large(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.index_articles(tables.articles(spark, sf), _large_vocabulary(spark, sf), columns=("title",))


def mention_bag_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Per keyword what its bags hold in all, and how many bags say something else than they hold."""
    index = mentions.index_articles(tables.articles(spark, sf), VOCABULARY)
    bags = mentions.bag_index(index, bag_size=BAG_SIZE, bag_bytes=4096)
    held = F.aggregate("articles", F.lit(0).cast("bigint"), lambda total, a: total + a["copies"])
    return bags.groupBy("keyword").agg(
        F.sum("n").alias("n"),
        F.sum(F.size("articles")).alias("distinct_articles"),
        F.sum((held != F.col("n")).cast("int")).alias("wrong"),
    )


def ranks_from_files(spark: SparkSession, sf: str) -> DataFrame:
    lines = article_lines(tables.articles(spark, sf))
    rankings = flows.rank_articles(spark, _written_lines(lines, "articles"), VOCABULARY)
    named = [ranked.select(F.lit(name).alias("ranking"), "keyword", "n") for name, ranked in zip(rankings._fields, rankings)]
    return named[0].unionByName(named[1]).unionByName(named[2])


def rank_reduce(spark: SparkSession, sf: str) -> DataFrame:
    return mentions.rank_by_count(tables.articles(spark, sf), VOCABULARY)


# -- postings ---------------------------------------------------------------


def postings_parse(spark: SparkSession, sf: str) -> DataFrame:
    lines = posting_lines(tables.postings(spark, sf))
    return read_postings(spark, _written_lines(lines, "postings"))


def _mixed_posting_lines(spark: SparkSession, sf: str) -> DataFrame:
    """A file with orders as posting lines; a pending order has no number for its score."""
    orders = tables.table(spark, sf, "orders")
    score = F.when(F.col("o_orderstatus") == "P", "n/a").otherwise("0")
    lines = orders.select(F.concat_ws(",", F.lit("1"), "o_orderkey", F.lit(""), F.lit(""), score, "o_orderpriority").alias("value"))
    return spark.read.text(_written_lines(lines, "postings"))


def postings_parse_permissive(spark: SparkSession, sf: str) -> DataFrame:
    return parse_postings(_mixed_posting_lines(spark, sf), strict=False).select("posting_type", "id", "score", "tags")


def postings_parse_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return posting_rejects(_mixed_posting_lines(spark, sf))


def postings_split(spark: SparkSession, sf: str) -> DataFrame:
    """Postings, and the lines that are none with the reason, from one pass."""
    good, bad = split_postings(_mixed_posting_lines(spark, sf))
    nothing = F.lit(None).cast("string")
    good = good.select(F.col("id"), "score", "tags", nothing.alias("value"), nothing.alias("reason"))
    return good.unionByName(bad, allowMissingColumns=True)


def postings_placed(spark: SparkSession, sf: str) -> DataFrame:
    return postings.place_by_key(tables.postings(spark, sf), NUM_PARTITIONS)


def postings_placement(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, partitions, and how many partitions begin before the one ahead of them ends."""
    placed = postings.place_by_key(tables.postings(spark, sf), NUM_PARTITIONS)
    place = F.struct("key", "id")
    ranges = placed.select(F.spark_partition_id().alias("part"), place.alias("place")).groupBy("part").agg(
        F.min("place").alias("low"), F.max("place").alias("high"), F.count(F.lit(1)).alias("n")
    )
    ahead = F.lag("high").over(Window.orderBy("part"))  # a row per partition
    return ranges.withColumn("overlaps", F.coalesce(F.col("low") <= ahead, F.lit(False)).cast("int")).agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("partitions"), F.sum("overlaps").alias("overlaps")
    )


def postings_join(spark: SparkSession, sf: str) -> DataFrame:
    return postings.pair_postings(tables.postings(spark, sf)).select(
        "qid",
        *[F.col(f"{side}.{name}").alias(f"{side}_{name}") for side in ("question", "answer") for name in postings.COLUMNS],
    )


def postings_join_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    questions, answers = postings.place_pairs(tables.postings(spark, sf), NUM_PARTITIONS, part_rows=PART_ROWS)
    return postings.pair_placed(questions, answers).select(
        "qid",
        *[F.col(f"{side}.{name}").alias(f"{side}_{name}") for side in ("question", "answer") for name in postings.COLUMNS],
    )


def postings_counted_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    return postings.count_placed(*postings.place_pairs(tables.postings(spark, sf), NUM_PARTITIONS, part_rows=PART_ROWS))


def postings_grouped(spark: SparkSession, sf: str) -> DataFrame:
    grouped = postings.group_postings(tables.postings(spark, sf), bag_size=BAG_SIZE)
    return postings.ungroup_postings(grouped).select(
        "qid",
        F.col("question.tags").alias("tags"),
        F.col("answer.id").alias("answer_id"),
        F.col("answer.score").alias("answer_score"),
        "copies",
    )


def postings_bag_shapes(spark: SparkSession, sf: str) -> DataFrame:
    """Per question what its bags hold in all, and how many bags say something else than they hold."""
    bags = postings.group_postings(tables.postings(spark, sf), bag_size=BAG_SIZE, bag_bytes=256)
    held = F.aggregate("pairs", F.lit(0).cast("bigint"), lambda total, p: total + p["copies"])
    return bags.groupBy("qid").agg(
        F.sum("n").alias("n"),
        F.sum(F.size("pairs")).alias("distinct_pairs"),
        F.sum((held != F.col("n")).cast("int")).alias("wrong"),
    )


def postings_scored(spark: SparkSession, sf: str) -> DataFrame:
    return postings.score_postings(tables.postings(spark, sf))


def postings_scored_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return postings.score_pairs(postings.pair_postings(tables.postings(spark, sf)))


def postings_vectors(spark: SparkSession, sf: str) -> DataFrame:
    return postings.vectorize(postings_scored(spark, sf), SETTINGS.languages, SETTINGS.spread)


def postings_vectors_matched(spark: SparkSession, sf: str) -> DataFrame:
    return postings.vectorize(postings_scored(spark, sf), SETTINGS.languages, SETTINGS.spread, unmatched="drop")


# -- sampling and clustering ------------------------------------------------


def sample_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_sample(postings_vectors(spark, sf), SETTINGS.per_language)


def sample_stratified_large(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.stratified_sample(postings_vectors(spark, sf), MANY_PER_LANGUAGE)


def sample_exact(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.exact_sample(postings_vectors(spark, sf), SAMPLE_SIZE)


def nearest_center(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.assign(postings_vectors(spark, sf), FIXED_MEANS)


def nearest_center_many(spark: SparkSession, sf: str) -> DataFrame:
    """The finished order nearest to each customer by customer number and money: thousands of centres from a table."""
    orders = tables.table(spark, sf, "orders").where("o_orderstatus = 'F'")
    centers = orders.select(F.col("o_orderkey").alias("idx"), F.col("o_custkey").alias("cx"), F.floor("o_totalprice").alias("cy"))
    customers = tables.table(spark, sf, "customer")
    points = customers.select("c_custkey", F.col("c_custkey").alias("x"), F.floor(F.col("c_acctbal") * 30).alias("y"))
    return nearest.assign_nearest(points, nearest.index_centers(centers, points))


def kmeans_step(spark: SparkSession, sf: str) -> DataFrame:
    points = clusters.weigh_points(postings_vectors(spark, sf))
    return clusters.means_frame(spark, clusters.move_means(points, FIXED_MEANS))


def kmeans_means(spark: SparkSession, sf: str) -> DataFrame:
    return flows.cluster_questions(postings_vectors(spark, sf), SETTINGS).clustering.means_frame(spark)


def kmeans_small_spread(spark: SparkSession, sf: str) -> DataFrame:
    vectors = postings.vectorize(postings_scored(spark, sf), NARROW.languages, NARROW.spread)
    return flows.cluster_questions(vectors, NARROW).clustering.means_frame(spark)


def kmeans_history(spark: SparkSession, sf: str) -> DataFrame:
    return flows.cluster_questions(postings_vectors(spark, sf), SETTINGS).clustering.history_frame(spark)


def kmeans_bounded_means(spark: SparkSession, sf: str) -> DataFrame:
    return flows.cluster_questions(postings_vectors(spark, sf), SETTINGS, bounded.kmeans).clustering.means_frame(spark)


def kmeans_bounded_history(spark: SparkSession, sf: str) -> DataFrame:
    return flows.cluster_questions(postings_vectors(spark, sf), SETTINGS, bounded.kmeans).clustering.history_frame(spark)


def cluster_summary(spark: SparkSession, sf: str) -> DataFrame:
    return flows.cluster_questions(postings_vectors(spark, sf), SETTINGS).summary


def clusters_from_files(spark: SparkSession, sf: str) -> DataFrame:
    path = _written_lines(posting_lines(tables.postings(spark, sf)), "postings")
    return flows.cluster_postings(spark, path, SETTINGS).summary


def cluster_report(spark: SparkSession, sf: str) -> DataFrame:
    return clusters.format_report(cluster_summary(spark, sf))


def cluster_medians(spark: SparkSession, sf: str) -> DataFrame:
    """Median order price in cents per priority: values wide enough for both halves of the median."""
    orders = tables.table(spark, sf, "orders")
    cents = orders.select("o_orderpriority", F.round(F.col("o_totalprice") * 100).cast("int").alias("cents"))
    points = cents.groupBy("o_orderpriority", "cents").agg(F.count(F.lit(1)).alias("w"))
    return clusters.exact_median(points, "o_orderpriority", "cents", "w")


def order_price_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of order prices per status, as they are: doubles."""
    return quantiles.exact_quantiles(tables.table(spark, sf, "orders"), "o_orderstatus", "o_totalprice", FRACTIONS)


def line_key_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of order keys per line number: 64-bit integers, each several times."""
    return quantiles.exact_quantiles(tables.table(spark, sf, "lineitem"), "l_linenumber", "l_orderkey", FRACTIONS)


# -- survey -----------------------------------------------------------------


def survey_read(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "survey")
    tables.survey(spark, sf).write.csv(path, header=True)
    return read_survey(spark, path, check_whole_rows=True)[1]


def survey_classified(spark: SparkSession, sf: str) -> DataFrame:
    """Minutes per class and column over the whole survey, by the classification of its column names."""
    rows = tables.survey(spark, sf)
    classes = classify_columns(rows.columns)
    named = [(label, name) for label, names in zip(classes._fields, classes) for name in names]
    sums = rows.agg(*[F.sum(name).alias(name) for _, name in named])
    return sums.select(F.explode(F.array(*[
        F.struct(F.lit(label).alias("class"), F.lit(name).alias("name"), F.round(F.col(name), 0).alias("minutes"))
        for label, name in named
    ])).alias("c")).select("c.*")


def survey_summary(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.survey(spark, sf)
    return survey.summarize(rows, classify_columns(rows.columns))


def survey_grouped(spark: SparkSession, sf: str) -> DataFrame:
    return survey.grouped(survey_summary(spark, sf))


def survey_grouped_sql(spark: SparkSession, sf: str) -> DataFrame:
    return survey.grouped_sql(survey_summary(spark, sf))


def survey_grouped_typed(spark: SparkSession, sf: str) -> DataFrame:
    return survey.grouped_typed(survey.as_rows(survey_summary(spark, sf)))


def survey_from_files(spark: SparkSession, sf: str) -> DataFrame:
    path = new_path(spark, "survey")
    tables.survey(spark, sf).write.csv(path, header=True)
    return flows.average_time_use(spark, path).grouped


def _llm():
    """The queries of the subpackage ``llm``, or None where it is not installed."""
    try:
        import tallyloom.llm.queries as found
    except ImportError as error:
        if error.name not in ("tallyloom.llm", "tallyloom.llm.queries", "corpus_pipeline"):
            raise
        return None
    return found


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    more = _llm()
    return _own_queries() | (more.queries() if more else {})


def _own_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {query.__name__: query for query in (
        article_parse, article_parse_permissive, article_parse_rejects, article_split,
        mention_occurrences, mention_index, mention_index_bags,
        rank_naive, rank_index, rank_index_bags, rank_reduce, rank_large, rank_large_zeros,
        index_large, mention_bag_shapes, ranks_from_files,
        postings_parse, postings_parse_permissive, postings_parse_rejects, postings_split,
        postings_placed, postings_placement, postings_join, postings_join_bucketed, postings_counted_bucketed,
        postings_grouped, postings_bag_shapes,
        postings_scored, postings_scored_pairs, postings_vectors, postings_vectors_matched,
        sample_stratified, sample_stratified_large, sample_exact, nearest_center, nearest_center_many,
        kmeans_step, kmeans_means, kmeans_small_spread, kmeans_history,
        kmeans_bounded_means, kmeans_bounded_history,
        cluster_summary, cluster_report, cluster_medians, order_price_quantiles, line_key_quantiles, clusters_from_files,
        survey_read, survey_classified, survey_summary,
        survey_grouped, survey_grouped_sql, survey_grouped_typed, survey_from_files,
    )}


# -- the same in SQL --------------------------------------------------------


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


# Iterations written out for DuckDB; the test tables need fewer, and the means
# do not move after the last one they need (eta is below 1, means are integers).
UNROLLED = 25

_ONE_LINE = r"regexp_replace(text, '[\r\n]', ' ', 'g')"
_ARTICLES = "articles AS (SELECT CAST(doc_id AS VARCHAR) AS title, text FROM documents)"
_WORDS = "words AS (SELECT * FROM (VALUES " + ", ".join(f"({_text(k)}, {i})" for i, k in enumerate(VOCABULARY)) + ") v(keyword, position))"
_HITS = f"""{_ARTICLES}, {_WORDS},
hits AS (SELECT keyword, title, text FROM words JOIN articles ON list_contains(string_split(text, ' '), keyword))"""
_RANKED = f"WITH {_HITS} SELECT keyword, count(*) AS n FROM hits GROUP BY keyword ORDER BY n DESC, keyword"

_LARGE = f"""{_ARTICLES},
words AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS keyword FROM benchmark),
large AS (SELECT keyword FROM words WHERE keyword <> '' AND NOT contains(keyword, chr(10))),
told AS (SELECT DISTINCT title, text, unnest(string_split(text, ' ')) AS keyword FROM articles),
counted AS (SELECT keyword, count(*) AS n FROM told JOIN large USING (keyword) GROUP BY keyword)"""

_POSTINGS = """questions AS (
  SELECT CAST(1 AS INTEGER) AS posting_type, o_orderkey AS id,
         CASE WHEN o_orderstatus = 'F' THEN o_orderkey * 10 + 1 END AS accepted_answer,
         CAST(NULL AS BIGINT) AS parent_id, CAST(0 AS INTEGER) AS score, o_orderpriority AS tags
  FROM orders),
answers AS (
  SELECT CAST(2 AS INTEGER) AS posting_type, l_orderkey * 10 + l_linenumber AS id,
         CAST(NULL AS BIGINT) AS accepted_answer, l_orderkey AS parent_id,
         CAST(l_quantity AS INTEGER) - 25 AS score, CAST(NULL AS VARCHAR) AS tags
  FROM lineitem)"""
_QUESTION = ", ".join(f"q.{name}" for name in postings.COLUMNS)
_SCORED = f"""{_POSTINGS},
scored AS (
  SELECT {_QUESTION}, greatest(max(a.score), 0) AS high_score
  FROM questions q JOIN answers a ON q.id = a.parent_id GROUP BY {_QUESTION})"""
_POSITION = f"coalesce(list_position({_list(SETTINGS.languages)}, tags), 0)"


def _vectors(spread: int) -> str:
    return f"""{_SCORED},
vectors AS (
  SELECT id AS qid, CAST(greatest({_POSITION} - 1, 0) * {spread} AS INTEGER) AS x, high_score AS y
  FROM scored)"""


_VECTORS = _vectors(SETTINGS.spread)
_ORDER = f"md5(concat('{sampling.SEED}:', qid))"


def _sampled(per_language: int) -> str:
    return f"""sampled AS (
  SELECT * FROM (SELECT qid, x, y, row_number() OVER (PARTITION BY x ORDER BY {_ORDER}, y) AS rn FROM vectors) s
  WHERE rn <= {per_language})"""


_SAMPLED = _sampled(SETTINGS.per_language)
_SAMPLED_EXACT = f"""sampled AS (
  SELECT * FROM (SELECT qid, x, y, row_number() OVER (ORDER BY {_ORDER}, x, y) AS rn FROM vectors) s
  WHERE rn <= {NARROW.kernels})"""
_FIXED_MEANS = "m AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, {x}, {y})" for i, (x, y) in enumerate(FIXED_MEANS)) + ") v(idx, cx, cy))"


def _assigned(rows: str, means: str, columns: str) -> str:
    """SQL for the nearest mean of each row; ties go to the lowest index."""
    distance = "(CAST(x - cx AS DOUBLE) * (x - cx) + CAST(y - cy AS DOUBLE) * (y - cy))"
    return (
        f"SELECT {columns}, CAST(arg_min(idx, {{'d': {distance}, 'i': idx}}) AS INTEGER) AS cluster "
        f"FROM {rows}, {means} GROUP BY {columns}"
    )


def _moved(means: str) -> str:
    """SQL for one iteration; an empty cluster keeps its mean."""
    return f"""SELECT CAST(m.idx AS INTEGER) AS idx, CAST(coalesce(a.cx, m.cx) AS BIGINT) AS cx, CAST(coalesce(a.cy, m.cy) AS BIGINT) AS cy
  FROM {means} m LEFT JOIN (
    SELECT cluster, CAST(sum(x * w) AS BIGINT) // CAST(sum(w) AS BIGINT) AS cx,
           CAST(sum(y * w) AS BIGINT) // CAST(sum(w) AS BIGINT) AS cy
    FROM ({_assigned('points', means, 'x, y, w')}) c GROUP BY cluster) a ON a.cluster = m.idx"""


_WEIGHED = "points AS MATERIALIZED (SELECT x, y, count(*) AS w FROM vectors GROUP BY x, y)"
_POINTS = f"{_VECTORS}, {_WEIGHED}"


def _clustered(points: str, sampled: str, order: str) -> str:
    return ",\n".join(
        [f"{points}, {sampled}",
         f"m0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY {order}) - 1 AS INTEGER) AS idx, x AS cx, y AS cy FROM sampled)"]
        + [f"m{i + 1} AS MATERIALIZED ({_moved(f'm{i}')})" for i in range(UNROLLED)]
    )


_CLUSTERED = _clustered(_POINTS, _SAMPLED, "x, rn")
_CLUSTERED_NARROW = _clustered(f"{_vectors(NARROW.spread)}, {_WEIGHED}", _SAMPLED_EXACT, "rn")
_HISTORY = " UNION ALL ".join(
    f"""SELECT CAST({i + 1} AS INTEGER) AS iteration, o.idx, CAST(o.cx AS BIGINT) AS old_x, CAST(o.cy AS BIGINT) AS old_y,
  n.cx AS new_x, n.cy AS new_y, CAST((o.cx - n.cx) * (o.cx - n.cx) + (o.cy - n.cy) * (o.cy - n.cy) AS DOUBLE) AS distance
  FROM m{i} o JOIN m{i + 1} n ON o.idx = n.idx""" for i in range(UNROLLED)
)
_SUMMARY = f"""{_CLUSTERED},
assigned AS ({_assigned('vectors', f'm{UNROLLED}', 'qid, x, y')}),
by_x AS (SELECT cluster, x, count(*) AS n FROM assigned GROUP BY cluster, x),
dominant AS (SELECT cluster, arg_max(x, {{'n': n, 'low': -x}}) AS x, max(n) AS n FROM by_x GROUP BY cluster),
whole AS (SELECT cluster, count(*) AS size, CAST(trunc(median(y)) AS INTEGER) AS median FROM assigned GROUP BY cluster),
summary AS (
  SELECT {_list(SETTINGS.languages)}[CAST(x // {SETTINGS.spread} AS INTEGER) + 1] AS lang,
         CAST((n // size) * 100 AS DOUBLE) AS pct_int, n * 100 / size AS pct, size, median
  FROM dominant JOIN whole USING (cluster))"""

_SURVEY = """survey AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS id, CAST(l_linenumber AS DOUBLE) AS telfs,
         CAST(l_partkey % 2 AS DOUBLE) AS tesex, CAST(l_suppkey % 100 AS DOUBLE) AS teage,
         CAST(l_quantity AS DOUBLE) AS t010101, CAST(l_extendedprice AS DOUBLE) AS t030101,
         CAST(l_discount * 1000 AS DOUBLE) AS t050101, CAST(l_tax * 1000 AS DOUBLE) AS t020101,
         CAST(l_quantity AS DOUBLE) AS t040101
  FROM lineitem)"""
_SUMMED = f"""{_SURVEY},
summed AS (
  SELECT CASE WHEN telfs >= 1 AND telfs < 3 THEN 'working' ELSE 'not working' END AS working,
         CASE WHEN tesex = 1 THEN 'male' ELSE 'female' END AS sex,
         CASE WHEN teage BETWEEN 15 AND 22 THEN 'young' WHEN teage BETWEEN 23 AND 55 THEN 'active' ELSE 'elder' END AS age,
         ({' + '.join(ACTIVITIES.primary_needs)}) / 60 AS "primaryNeeds",
         ({' + '.join(ACTIVITIES.work)}) / 60 AS work,
         ({' + '.join(ACTIVITIES.other)}) / 60 AS other
  FROM survey WHERE telfs <= 4)"""
_AVERAGED = f"""WITH {_SUMMED}
SELECT working, sex, age, round(avg("primaryNeeds"), 1) AS "primaryNeeds", round(avg(work), 1) AS work, round(avg(other), 1) AS other
FROM summed GROUP BY working, sex, age ORDER BY working, sex, age"""


def _quantiles(table: str, group: str, value: str) -> str:
    """SQL for the value at the place of each fraction among a group's sorted values."""
    fractions = ", ".join(f"(CAST({f!r} AS DOUBLE))" for f in FRACTIONS)
    return f"""WITH sorted AS (
  SELECT {group}, {value} AS quantile, row_number() OVER (PARTITION BY {group} ORDER BY {value}) AS place, count(*) OVER (PARTITION BY {group}) AS n
  FROM {table} WHERE {value} IS NOT NULL)
SELECT {group}, fraction, quantile, n FROM sorted JOIN (VALUES {fractions}) f(fraction) ON place = greatest(CAST(ceil(n * fraction) AS BIGINT), 1)"""


def oracle_sql() -> dict[str, str]:
    more = _llm()
    return _own_sql() | (more.oracle_sql() if more else {})


def _own_sql() -> dict[str, str]:
    scored = f"WITH {_SCORED} SELECT * FROM scored"
    side = {name: ", ".join(f"{name[0]}.{c} AS {name}_{c}" for c in postings.COLUMNS) for name in ("question", "answer")}
    means = f"WITH {_CLUSTERED} SELECT idx, cx, cy FROM m{UNROLLED}"
    history = f"""WITH {_CLUSTERED}, steps AS ({_HISTORY}),
last AS (SELECT min(iteration) AS iteration FROM (SELECT iteration FROM steps GROUP BY iteration HAVING sum(distance) < {SETTINGS.eta}) s)
SELECT steps.* FROM steps, last WHERE steps.iteration <= last.iteration"""
    return {
        "article_parse": f"SELECT CAST(doc_id AS VARCHAR) AS title, {_ONE_LINE} AS text FROM documents",
        "article_parse_permissive": f"SELECT CAST(doc_id AS VARCHAR) AS title, {_ONE_LINE} AS text FROM documents WHERE lang = 'en'",
        "article_parse_rejects": f"SELECT {_ONE_LINE} AS value FROM documents WHERE lang IS DISTINCT FROM 'en'",
        "article_split": f"""SELECT CAST(doc_id AS VARCHAR) AS title, {_ONE_LINE} AS text, NULL AS value, NULL AS reason FROM documents WHERE lang = 'en'
UNION ALL SELECT NULL, NULL, {_ONE_LINE}, 'no delimiter' FROM documents WHERE lang IS DISTINCT FROM 'en'""",
        "postings_split": """SELECT o_orderkey AS id, CAST(0 AS INTEGER) AS score, o_orderpriority AS tags, NULL AS value, NULL AS reason FROM orders WHERE o_orderstatus <> 'P'
UNION ALL SELECT NULL, NULL, NULL, concat('1,', o_orderkey, ',,,n/a,', o_orderpriority), 'score is no number' FROM orders WHERE o_orderstatus = 'P'""",
        "mention_occurrences": f"SELECT {_text(KEYWORD)} AS keyword, count(*) AS n FROM documents WHERE list_contains(string_split(text, ' '), {_text(KEYWORD)})",
        "mention_index": f"WITH {_HITS} SELECT keyword, title, text FROM hits",
        "mention_index_bags": f"WITH {_HITS} SELECT keyword, title, text, count(*) AS copies FROM hits GROUP BY keyword, title, text",
        "rank_naive": f"""WITH {_HITS}
SELECT w.keyword, count(h.title) AS n FROM words w LEFT JOIN hits h ON w.keyword = h.keyword
GROUP BY w.keyword, w.position ORDER BY n DESC, w.position DESC""",
        "rank_index": _RANKED,
        "rank_index_bags": _RANKED,
        "rank_reduce": _RANKED,
        "rank_large": f"WITH {_LARGE} SELECT keyword, n FROM counted",
        "rank_large_zeros": f"WITH {_LARGE} SELECT keyword, coalesce(n, 0) AS n FROM (SELECT keyword FROM large UNION ALL SELECT 'never found') LEFT JOIN counted USING (keyword)",
        "index_large": f"WITH {_LARGE} SELECT keyword, title FROM told JOIN large USING (keyword)",
        "mention_bag_shapes": f"""WITH {_HITS}
SELECT keyword, count(*) AS n, count(DISTINCT (title, text)) AS distinct_articles, CAST(0 AS BIGINT) AS wrong FROM hits GROUP BY keyword""",
        "ranks_from_files": f"""WITH {_ARTICLES.replace(" text FROM", f" {_ONE_LINE} AS text FROM")}, {_HITS.removeprefix(_ARTICLES + ", ")},
found AS (SELECT keyword, count(*) AS n FROM hits GROUP BY keyword)
SELECT 'all_keywords' AS ranking, keyword, coalesce(n, 0) AS n FROM words LEFT JOIN found USING (keyword)
UNION ALL SELECT 'by_index', keyword, n FROM found UNION ALL SELECT 'by_count', keyword, n FROM found""",
        "postings_parse": f"WITH {_POSTINGS} SELECT * FROM questions UNION ALL SELECT * FROM answers",
        "postings_parse_permissive": "SELECT CAST(1 AS INTEGER) AS posting_type, o_orderkey AS id, CAST(0 AS INTEGER) AS score, o_orderpriority AS tags FROM orders WHERE o_orderstatus <> 'P'",
        "postings_parse_rejects": "SELECT concat('1,', o_orderkey, ',,,n/a,', o_orderpriority) AS value FROM orders WHERE o_orderstatus = 'P'",
        "postings_placed": f"WITH {_POSTINGS} SELECT id AS key, * FROM questions UNION ALL SELECT coalesce(parent_id, 0) AS key, * FROM answers",
        "postings_placement": f"WITH {_POSTINGS} SELECT (SELECT count(*) FROM questions) + (SELECT count(*) FROM answers) AS n, CAST({NUM_PARTITIONS} AS BIGINT) AS partitions, CAST(0 AS BIGINT) AS overlaps",
        "postings_bag_shapes": f"""WITH {_POSTINGS}
SELECT q.id AS qid, count(*) AS n, count(DISTINCT (q, a)) AS distinct_pairs, CAST(0 AS BIGINT) AS wrong
FROM questions q JOIN answers a ON q.id = a.parent_id GROUP BY q.id""",
        "postings_join": f"WITH {_POSTINGS} SELECT q.id AS qid, {side['question']}, {side['answer']} FROM questions q JOIN answers a ON q.id = a.parent_id",
        "postings_join_bucketed": f"WITH {_POSTINGS} SELECT q.id AS qid, {side['question']}, {side['answer']} FROM questions q JOIN answers a ON q.id = a.parent_id",
        "postings_counted_bucketed": f"""WITH {_POSTINGS}
SELECT q.id AS qid, count(*) AS pairs, greatest(max(a.score), 0) AS high_score FROM questions q JOIN answers a ON q.id = a.parent_id GROUP BY q.id""",
        "postings_grouped": f"""WITH {_POSTINGS}
SELECT q.id AS qid, q.tags, a.id AS answer_id, a.score AS answer_score, count(*) AS copies
FROM questions q JOIN answers a ON q.id = a.parent_id GROUP BY q.id, q.tags, a.id, a.score""",
        "postings_scored": scored,
        "postings_scored_pairs": scored,
        "postings_vectors": f"WITH {_VECTORS} SELECT qid, x, y FROM vectors",
        "postings_vectors_matched": f"""WITH {_SCORED}
SELECT id AS qid, CAST(({_POSITION} - 1) * {SETTINGS.spread} AS INTEGER) AS x, high_score AS y FROM scored WHERE {_POSITION} > 0""",
        "sample_stratified": f"WITH {_VECTORS}, {_SAMPLED} SELECT qid, x, y, CAST(rn AS INTEGER) AS rn FROM sampled",
        "sample_stratified_large": f"WITH {_VECTORS}, {_sampled(MANY_PER_LANGUAGE)} SELECT qid, x, y, CAST(rn AS INTEGER) AS rn FROM sampled",
        "sample_exact": f"WITH {_VECTORS} SELECT qid, x, y FROM vectors ORDER BY {_ORDER}, x, y LIMIT {SAMPLE_SIZE}",
        "nearest_center": f"WITH {_VECTORS}, {_FIXED_MEANS} {_assigned('vectors', 'm', 'qid, x, y')}",
        "nearest_center_many": """WITH points AS (SELECT c_custkey, c_custkey AS x, CAST(floor(c_acctbal * 30) AS BIGINT) AS y FROM customer),
centers AS (SELECT o_orderkey AS idx, o_custkey AS cx, CAST(floor(o_totalprice) AS BIGINT) AS cy FROM orders WHERE o_orderstatus = 'F')
SELECT c_custkey, x, y, arg_min(idx, {'d': CAST(x - cx AS DOUBLE) * (x - cx) + CAST(y - cy AS DOUBLE) * (y - cy), 'i': idx}) AS cluster
FROM points, centers GROUP BY c_custkey, x, y""",
        "kmeans_step": f"WITH {_POINTS}, {_FIXED_MEANS} {_moved('m')}",
        "kmeans_means": means,
        "kmeans_bounded_means": means,
        "kmeans_small_spread": f"WITH {_CLUSTERED_NARROW} SELECT idx, cx, cy FROM m{UNROLLED}",
        "kmeans_history": history,
        "kmeans_bounded_history": history,
        "cluster_summary": f"WITH {_SUMMARY} SELECT * FROM summary ORDER BY median, lang, size",
        "cluster_report": f"WITH {_SUMMARY} SELECT printf({_text(clusters.REPORT_LINE)}, median, lang, pct_int, size) AS line, CAST(row_number() OVER (ORDER BY median, lang, size, pct) AS INTEGER) AS position FROM summary",
        "clusters_from_files": f"WITH {_SUMMARY} SELECT * FROM summary ORDER BY median, lang, size",
        "cluster_medians": "SELECT o_orderpriority, CAST(trunc(median(CAST(round(o_totalprice * 100) AS INTEGER))) AS INTEGER) AS median FROM orders GROUP BY o_orderpriority",
        "order_price_quantiles": _quantiles("orders", "o_orderstatus", "o_totalprice"),
        "line_key_quantiles": _quantiles("lineitem", "l_linenumber", "l_orderkey"),
        "survey_read": f"WITH {_SURVEY} SELECT * FROM survey",
        "survey_classified": f"WITH {_SURVEY} " + " UNION ALL ".join(
            f"SELECT {_text(label)} AS class, {_text(name)} AS name, round(sum({name}), 0) AS minutes FROM survey"
            for label, names in zip(ACTIVITIES._fields, ACTIVITIES) for name in names
        ),
        "survey_summary": f"WITH {_SUMMED} SELECT * FROM summed",
        "survey_grouped": _AVERAGED,
        "survey_grouped_sql": _AVERAGED,
        "survey_grouped_typed": _AVERAGED,
        "survey_from_files": _AVERAGED,
    }
