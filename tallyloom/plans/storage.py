"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import contextvars
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Where that is unset, the checkpoint folder of the context, or else a
    temporary folder, which only a local session gets: executors on other
    machines could not read it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    folder = tempfile.mkdtemp(prefix="tallyloom-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


@dataclass
class Scope:
    """What was written while the scope was open, and what to run when it closes."""

    paths: list[str] = field(default_factory=list)
    statements: list[str] = field(default_factory=list)


_OPEN: contextvars.ContextVar[Scope | None] = contextvars.ContextVar("tallyloom_scope", default=None)


@contextmanager
def scope(spark: SparkSession) -> Iterator[Scope]:
    """Owns the intermediate tables written inside, and deletes them when it ends, also after a failure.

    Results are read from these tables, so they have to be collected or written
    elsewhere before. A scope within another ends first and takes its own tables only. Threads have
    their own scopes. Without a scope, tables stay until someone deletes them.
    """
    opened = Scope()
    token = _OPEN.set(opened)
    try:
        yield opened
    finally:
        _OPEN.reset(token)
        for statement in opened.statements:
            spark.sql(statement)
        for path in opened.paths:
            delete(spark, path)


def at_end(spark: SparkSession, statement: str) -> None:
    """Have the open scope, if there is one, run a statement when it ends."""
    if (opened := _OPEN.get()) is not None:
        opened.statements.append(statement)


def delete(spark: SparkSession, path: str) -> None:
    """Delete a file or folder in whatever store it is; none is no error."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def new_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; it belongs to the open scope, if there is one."""
    path = f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    if (opened := _OPEN.get()) is not None:
        opened.paths.append(path)
    return path


#: Spark's setting for dropping the shuffle files of a query when it ends.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(FILE_CLEANUP, "false")
    spark.conf.set(FILE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(FILE_CLEANUP, before)


#: Rows that a task takes after a shuffle, and bytes of them.
TASK_ROWS, TASK_BYTES = 250_000, 32 * 1024 * 1024
PARTITIONS, READ_PARTITIONS = "spark.sql.shuffle.partitions", "spark.sql.files.minPartitionNum"
MERGED = "spark.sql.adaptive.coalescePartitions.enabled"


def tasks_for(spark: SparkSession, rows: int, size: int = 0) -> int:
    """Partitions for so many rows, of so many bytes in all: those of the session, or more, so that a task's share stays bounded."""
    return max(int(spark.conf.get(PARTITIONS)), -(-rows // TASK_ROWS), -(-size // TASK_BYTES))


@contextmanager
def shuffled_into(spark: SparkSession, tasks: int) -> Iterator[None]:
    """What is written inside is shuffled into so many partitions.

    Where these are more than the session's, files are read in about as many, and Spark does not
    merge partitions by their compressed size, which says little of the rows in them.
    """
    settings = {PARTITIONS: str(tasks)}
    if tasks > int(spark.conf.get(PARTITIONS)):
        settings |= {READ_PARTITIONS: str(tasks), MERGED: "false"}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def written(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write the rows to a path once and read them back, with the lineage cut.

    Whatever comes after is safe from lost executors: it reads the files again
    instead of running the joins behind them again. The shuffle files of the
    write go when it ends.
    """
    with _shuffles_dropped(df.sparkSession):
        df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def materialize(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """``written`` to a new path in the shared folder, which the open scope owns if there is one."""
    return written(df, new_path(df.sparkSession, name), partition_by)
