"""Questions matched with their answers, scored, and turned into points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.postings import ANSWER, QUESTION, language_position, posting_key
from tallyloom.functions.tokens import LANGUAGES
from tallyloom.operators.bags import (
    BAG_BYTES, BAG_SIZE, bag_of, bags_for, in_bags, in_every_bag, profile, shuffled_size,
)
from tallyloom.operators.skew import shuffled_for_join
from tallyloom.plans.layout import bucketed
from tallyloom.plans.storage import materialize, shuffled_into, tasks_for
from tallyloom.sources.postings import SCHEMA

COLUMNS = SCHEMA.fieldNames()
# Fixed value: distance on the x axis between two neighbouring languages.
SPREAD = 50_000
INT_MAX = 2**31 - 1
# Answers of one question that a bucket takes before they are dealt into several.
PART_ROWS = 1_000_000
# Postings to a bucket: a task sorts and merges one.
BUCKET_ROWS = 250_000


def keyed(postings: DataFrame) -> DataFrame:
    """Postings with the ``key`` that questions and their answers share."""
    key = posting_key(F.col("posting_type"), F.col("id"), F.col("parent_id"))
    return postings.select(key.alias("key"), *COLUMNS)


def place_by_key(postings: DataFrame, num_partitions: int) -> DataFrame:
    """Keyed postings range-partitioned so that a question lies near its answers.

    For laying out a table that is written. The id is part of the range, so a
    question with very many answers spans several partitions instead of filling
    one. Joins cannot use ranges that were sampled apart; ``place_pairs`` lays
    tables out for these.
    """
    return keyed(postings).repartitionByRange(num_partitions, "key", "id")


def questions_of(postings: DataFrame) -> DataFrame:
    return postings.where(F.col("posting_type") == QUESTION).select(*COLUMNS)


def answers_of(postings: DataFrame, strict: bool = True) -> DataFrame:
    """Answers with their ``key``.

    Strict takes everything that is not a question, so that a posting of
    unknown type reaches the key, which nothing can prune, and fails the job.
    """
    posting_type = F.col("posting_type")
    if strict:
        return keyed(postings.where(~posting_type.eqNullSafe(QUESTION)))
    return keyed(postings.where(posting_type == ANSWER))


def _posting(side: str = "") -> Column:
    return F.struct(*[F.col(side + name).alias(name) for name in COLUMNS])


def _sides(postings: DataFrame, strict: bool) -> tuple[DataFrame, DataFrame]:
    """Questions and answers as ``(qid, question)`` and ``(qid, answer)`` structs."""
    return (
        questions_of(postings).select(F.col("id").alias("qid"), _posting().alias("question")),
        answers_of(postings, strict).select(F.col("key").alias("qid"), _posting().alias("answer")),
    )


def pair_postings(postings: DataFrame, strict: bool = True) -> DataFrame:
    """Every question with every answer to it: ``(qid, question, answer)`` structs.

    Unanswered questions and answers to unknown questions drop out.
    """
    questions, answers = _sides(postings, strict)
    return questions.join(answers, "qid")


def place_pairs(
    postings: DataFrame, buckets: int, strict: bool = True, part_rows: int = PART_ROWS
) -> tuple[DataFrame, DataFrame]:
    """Questions and answers as ``(qid, part, question)`` and ``(qid, part, answer)``, in tables that join without a shuffle.

    For postings that are matched more than once: the shuffle is paid here. The
    answers of a question with more than ``part_rows`` of them are dealt into
    parts by a hash, and the question goes into each part, so that no bucket
    holds all of a hot question. There are ``buckets`` buckets, or more, so that none
    has more than ``BUCKET_ROWS`` postings on average.
    """
    questions, answers = _sides(postings, strict)
    if part_rows < 1:
        raise ValueError("part_rows must be positive")
    if buckets < 1:
        raise ValueError("at least one bucket is needed")
    rows = postings.count()
    buckets = max(buckets, -(-rows // BUCKET_ROWS))
    parts = F.ceil(F.count(F.lit(1)) / part_rows).cast("long")
    hot = shuffled_for_join(answers.groupBy("qid").agg(parts.alias("parts")).where("parts > 1"))
    known = F.coalesce("parts", F.lit(1)).cast("long")
    dealt = answers.join(hot, "qid", "left").select("qid", bag_of(F.col("answer"), "parts").alias("part"), "answer")
    dealt = dealt.withColumn("part", F.coalesce("part", F.lit(0)).cast("long"))
    spread = in_every_bag(questions.join(hot, "qid", "left").withColumn("parts", known), "parts", "part")
    spread = spread.select("qid", F.col("part").cast("long").alias("part"), "question")
    keys = ["qid", "part"]
    spark = postings.sparkSession
    with shuffled_into(spark, tasks_for(spark, rows)):
        return bucketed(spread, "questions", keys, buckets), bucketed(dealt, "answers", keys, buckets)


def pair_placed(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """The pairs of ``pair_postings`` from tables of ``place_pairs``: a merge of sorted buckets, no shuffle."""
    return questions.join(answers.hint("merge"), ["qid", "part"]).select("qid", "question", "answer")


def count_placed(questions: DataFrame, answers: DataFrame) -> DataFrame:
    """``(qid, pairs, high_score)`` per answered question id, from the same tables; only what is summed per part is shuffled."""
    pairs = questions.join(answers.hint("merge"), ["qid", "part"])
    by_part = pairs.groupBy("qid", "part").agg(F.count(F.lit(1)).alias("pairs"), F.max("answer.score").alias("best"))
    best = F.greatest(F.max("best"), F.lit(0)).alias("high_score")
    return by_part.groupBy("qid").agg(F.sum("pairs").alias("pairs"), best)


def group_postings(
    postings: DataFrame, bag_size: int = BAG_SIZE, strict: bool = True, bag_bytes: int = BAG_BYTES
) -> DataFrame:
    """Pairs nested per question: ``(qid, bag, n, pairs)`` with bounded arrays.

    ``pairs`` holds ``struct(question, answer, copies)`` and stands for ``n``
    pairs. A salted join: the answers of a question are dealt out to its bags,
    and the question goes into each of them. (The other way round as well, for
    an id that very many different questions share.) So the pairs are made where
    they are collected, and those of a hot question in many tasks. Questions and
    answers are shuffled once, to these bags; how many there are comes from a
    pass over digests, and only ids with several bags are looked up. Where the
    session's partitions would hold too much, the bags are laid out in more buckets.
    """
    spark = postings.sparkSession
    questions, answers = _sides(postings, strict)
    first_tasks = tasks_for(spark, postings.count())
    with shuffled_into(spark, first_tasks):
        asked_rows, answered_rows = profile(questions, "qid", ["question"]), profile(answers, "qid", ["answer"])
    asked, answered = F.col("asked"), F.col("answered")
    per_bag = F.least(asked, F.lit(bag_size))
    # Of the pairs of a question bag: its questions once per answer, and the other way round.
    paired = answered * F.least(F.col("asked_bytes"), F.lit(bag_bytes)) + per_bag * F.col("answered_bytes")
    bags = (
        asked_rows.groupBy("qid").agg(F.count(F.lit(1)).alias("asked"), F.sum("bytes").alias("asked_bytes"))
        .join(
            answered_rows.groupBy("qid").agg(F.count(F.lit(1)).alias("answered"), F.sum("bytes").alias("answered_bytes")),
            "qid",
        )
        .select(
            "qid",
            bags_for(asked, F.col("asked_bytes"), bag_size, bag_bytes).alias("question_bags"),
            bags_for(answered * per_bag, paired, bag_size, bag_bytes).alias("answer_bags"),
            "asked", "answered", "asked_bytes", "answered_bytes",
        )
        .where("question_bags > 1 OR answer_bags > 1")
        # Beyond once each: the rows that go into several bags, and their bytes.
        .withColumns({
            f"more_{name}": F.expr(f"asked{of} * (answer_bags - 1) + answered{of} * (question_bags - 1)")
            for name, of in (("rows", ""), ("bytes", "_bytes"))
        })
        .drop("asked", "answered", "asked_bytes", "answered_bytes")
    )
    with shuffled_into(spark, first_tasks):
        bags = materialize(bags, "hot-questions")
    more = bags.agg(F.sum("more_rows"), F.sum("more_bytes")).first()
    tasks = tasks_for(spark, *[once + (again or 0) for once, again in zip(shuffled_size(asked_rows, answered_rows), more)])
    bags = bags.drop("more_rows", "more_bytes")

    def looked_up(side: DataFrame) -> DataFrame:
        found = side.join(bags, "qid", "left")
        return found.withColumns({name: F.coalesce(name, F.lit(1).cast("long")) for name in ("question_bags", "answer_bags")})

    key = ["qid", "question_bag", "answer_bag"]
    dealt_questions = in_every_bag(
        looked_up(questions).withColumn("question_bag", bag_of(F.col("question"), "question_bags")), "answer_bags", "answer_bag"
    )
    dealt_answers = in_every_bag(
        looked_up(answers).withColumn("answer_bag", bag_of(F.col("answer"), "answer_bags")), "question_bags", "question_bag"
    )
    dealt_questions = in_bags(dealt_questions, asked_rows, key, ["question"], tasks).withColumnRenamed("copies", "question_copies")
    dealt_answers = in_bags(dealt_answers, answered_rows, key, ["answer"], tasks)
    copies = F.col("question_copies") * F.col("copies")
    nested = (
        dealt_questions.join(dealt_answers, key)
        .groupBy(*key)
        .agg(F.sum(copies).alias("n"), F.collect_list(F.struct("question", "answer", copies.alias("copies"))).alias("pairs"))
    )
    # A number per bag of the question: both parts are below 2**31, as many bags would hold all ints.
    return nested.select("qid", (F.shiftleft("question_bag", 32) + F.col("answer_bag")).alias("bag"), "n", "pairs")


def ungroup_postings(grouped: DataFrame) -> DataFrame:
    """Nested pairs as rows ``(qid, question, answer, copies)``."""
    return grouped.select("qid", F.explode("pairs").alias("pair")).select("qid", "pair.*")


def _high_score(score: str) -> Column:
    """Best score, at least 0."""
    return F.greatest(F.max(score), F.lit(0)).alias("high_score")


def score_postings(postings: DataFrame, strict: bool = True) -> DataFrame:
    """Answered questions with the best score among their answers: six columns and ``high_score``.

    Answers are reduced to one score per question, and equal questions to one
    row, before either is shuffled for the join: a question with a third of all
    answers costs each task one row. The pairs are never built.
    """
    questions = questions_of(postings).distinct()
    best = shuffled_for_join(answers_of(postings, strict).groupBy("key").agg(_high_score("score")))
    return questions.join(best, questions.id == best.key).select(*COLUMNS, "high_score")


def score_pairs(pairs: DataFrame) -> DataFrame:
    """The scores of ``score_postings``, from pairs that exist already."""
    return pairs.groupBy("question").agg(_high_score("answer.score")).select("question.*", "high_score")


def vectorize(
    scored: DataFrame,
    languages: Sequence[str] = LANGUAGES,
    spread: int = SPREAD,
    unmatched: str = "first",
) -> DataFrame:
    """Scored questions as integer points ``(qid, x, y)``: language position times spread, score.

    A question whose tag is missing or not listed counts for the first language,
    or is left out with ``unmatched="drop"``.
    """
    if unmatched not in ("first", "drop"):
        raise ValueError('unmatched must be "first" or "drop"')
    if spread <= 0:
        raise ValueError("spread must be positive, or x no longer tells the language")
    if not languages or (len(languages) - 1) * spread > INT_MAX:
        raise ValueError("languages must not be empty, and their x values must fit an INT")
    position = language_position(F.col("tags"), languages)
    if unmatched == "first":
        position = F.coalesce(position, F.lit(0))
    else:
        scored = scored.where(position.isNotNull())
    return scored.select(
        F.col("id").alias("qid"),
        (position * spread).cast("int").alias("x"),
        F.col("high_score").cast("int").alias("y"),
    )
