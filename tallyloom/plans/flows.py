"""The three analyses from file to result."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyloom.functions.survey import classify_columns
from tallyloom.functions.tokens import LANGUAGES
from tallyloom.operators import clusters, mentions, postings, survey
from tallyloom.plans.storage import materialize
from tallyloom.sources.articles import read_articles
from tallyloom.sources.postings import read_postings
from tallyloom.sources.survey import read_survey


class Rankings(NamedTuple):
    all_keywords: DataFrame
    by_index: DataFrame
    by_count: DataFrame


def rank_articles(spark: SparkSession, path: str, vocabulary: mentions.Vocabulary = LANGUAGES) -> Rankings:
    """The three rankings of keywords over an article file.

    The file is read and split once: its mentions are written, and the rankings
    read them.
    """
    vocabulary = mentions.check_vocabulary(spark, vocabulary)
    index = mentions.index_articles(read_articles(spark, path), vocabulary, columns=())
    found = materialize(index, "mentions")
    return Rankings(
        mentions.rank_all_found(found, vocabulary),
        mentions.rank_by_index(found),
        mentions.rank_found(found, vocabulary),
    )


class ClusteredQuestions(NamedTuple):
    points: DataFrame
    clustering: clusters.Clustering
    summary: DataFrame


def cluster_questions(
    scored_vectors: DataFrame,
    settings: clusters.ClusterSettings = clusters.ClusterSettings(),
    kmeans: Callable[..., clusters.Clustering] = clusters.kmeans,
) -> ClusteredQuestions:
    """Sample, cluster and summarise points.

    The points are written once: both the sample and the weights read them, and
    the join behind them should run once. ``bounded.kmeans`` gives the same clusters
    with fewer comparisons.
    """
    vectors = materialize(scored_vectors, "vectors")
    start = clusters.initial_means(vectors, settings)
    points = materialize(clusters.weigh_points(vectors), "points")
    clustering = kmeans(points, start, settings.eta, settings.max_iterations)
    return ClusteredQuestions(
        points, clustering, clusters.summarize_clusters(points, clustering.means, settings)
    )


def cluster_postings(
    spark: SparkSession, path: str, settings: clusters.ClusterSettings = clusters.ClusterSettings()
) -> ClusteredQuestions:
    """Clusters of the answered questions in a postings file.

    The lines are parsed once, into a table by type, of which questions and
    answers are a part each.
    """
    parsed = materialize(read_postings(spark, path), "postings", ("posting_type",))
    scored = postings.score_postings(parsed)
    return cluster_questions(postings.vectorize(scored, settings.languages, settings.spread), settings)


class SurveyAverages(NamedTuple):
    grouped: DataFrame
    grouped_sql: DataFrame
    grouped_typed: DataFrame


def average_time_use(spark: SparkSession, path: str) -> SurveyAverages:
    """Average hours per group of persons, through each of the three interfaces.

    The wide file is read once, into a summary of six columns that is written.
    """
    names, rows = read_survey(spark, path)
    summary = materialize(survey.summarize(rows, classify_columns(names)), "summary")
    return SurveyAverages(
        survey.grouped(summary),
        survey.grouped_sql(summary),
        survey.grouped_typed(survey.as_rows(summary)),
    )
