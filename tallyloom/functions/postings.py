"""Expressions over question and answer postings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The two posting types.
QUESTION = 1
ANSWER = 2

# Key of an answer that names no parent.
NO_PARENT_KEY = 0


def posting_key(posting_type: Column, posting_id: Column, parent_id: Column) -> Column:
    """The question id a posting belongs to; any third posting type fails the job."""
    return (
        F.when(posting_type == QUESTION, posting_id)
        .when(posting_type == ANSWER, F.coalesce(parent_id, F.lit(NO_PARENT_KEY)))
        .otherwise(F.raise_error(F.concat(F.lit("unknown posting type: "), F.coalesce(posting_type.cast("string"), F.lit("NULL")))))
    )


def language_position(tag: Column, languages: Sequence[str]) -> Column:
    """0-based position of the tag in ``languages``; NULL if it is missing or not listed."""
    position = F.array_position(F.array(*[F.lit(name) for name in languages]), tag)
    return F.when(position > 0, position - 1)
