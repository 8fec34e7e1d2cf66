"""What several test files use."""

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

# A failed task comes as the latter when Spark has no Python class for its cause.
JOB_FAILS = (PySparkException, Py4JJavaError)


def plan(df) -> str:
    """The physical plan as text."""
    return df._jdf.queryExecution().executedPlan().toString()


def tuples(df) -> list[tuple]:
    return [tuple(row) for row in df.collect()]
