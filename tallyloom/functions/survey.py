"""Expressions over a time-use survey: one row per person, one column per activity."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyloom.functions.checks import quoted

# Column name prefixes of the three activity classes.
PRIMARY_NEEDS_PREFIXES = ("t01", "t03", "t11", "t1801", "t1803")
WORK_PREFIXES = ("t05", "t1805")
OTHER_PREFIXES = (
    "t02", "t04", "t06", "t07", "t08", "t09", "t10",
    "t12", "t13", "t14", "t15", "t16", "t18",
)
MINUTES_PER_HOUR = 60


class ActivityColumns(NamedTuple):
    primary_needs: list[str]
    work: list[str]
    other: list[str]


def classify_columns(names: Sequence[str]) -> ActivityColumns:
    """Sort column names into activity classes by prefix, keeping their order.

    The first two classes take precedence, so "other" gets what is left of
    ``t18``. Columns of no class are left out. Runs no job.
    """
    primary = [n for n in names if n.startswith(PRIMARY_NEEDS_PREFIXES)]
    work = [n for n in names if n.startswith(WORK_PREFIXES)]
    taken = {*primary, *work}
    other = [n for n in names if n.startswith(OTHER_PREFIXES) and n not in taken]
    return ActivityColumns(primary, work, other)


def hours(names: Sequence[str]) -> Column:
    """Sum of minute columns in hours, added left to right for stable doubles."""
    if not names:
        raise ValueError("an activity class needs at least one column")
    return F.expr(" + ".join(quoted(n) for n in names)) / MINUTES_PER_HOUR


def working_status(telfs: Column) -> Column:
    return F.when((telfs >= 1) & (telfs < 3), "working").otherwise("not working")


def sex(tesex: Column) -> Column:
    return F.when(tesex == 1, "male").otherwise("female")


def age_group(teage: Column) -> Column:
    """Below 15, and between 22 and 23, counts as elder like everything above 55."""
    return (
        F.when(teage.between(15, 22), "young")
        .when(teage.between(23, 55), "active")
        .otherwise("elder")
    )


def employable(telfs: Column) -> Column:
    return telfs <= 4
