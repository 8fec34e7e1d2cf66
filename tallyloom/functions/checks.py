"""Data checks that stay inside the plan."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def holds_or_fails(condition: Column, message: Column | str) -> Column:
    """True where ``condition`` is true; the job fails where it is false or NULL.

    Meant for ``where``: a filter on every row cannot be pruned away, while a
    check inside a projected column disappears with the column.
    """
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(message))


def present_or_fails(name: str) -> str:
    """SQL for a column; the job fails where it is NULL and somebody uses it."""
    message = f"missing value in column {name}".replace("\\", "\\\\").replace("'", "\\'")
    return f"coalesce({quoted(name)}, raise_error('{message}')) AS {quoted(name)}"


def quoted(name: str) -> str:
    """Column name safe in SQL and for ``F.col`` whatever characters it holds."""
    return "`" + name.replace("`", "``") + "`"
