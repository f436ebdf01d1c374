"""Logs as streams: the latest row of each key, and results that are recorded once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def log_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int = 64) -> DataFrame:
    """New files of a log folder; at most so many at once, which bounds what is in flight."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(path)


def latest(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The row of largest order of each key, for update or complete mode. State is one row a key."""
    rest = [c for c in stream.columns if c != key]
    return stream.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("r")).select(key, "r.*")


def once(stream: DataFrame, key: str) -> DataFrame:
    """The first row of each key; keys are content hashes, so a repeated result is the same one."""
    return stream.dropDuplicates([key])


def each_file(paths: list[str], work) -> list[tuple[str, str | None]]:
    """(path, error or None): work on every file; one that fails leaves the others alone."""
    out = []
    for path in paths:
        try:
            work(path)
            out.append((path, None))
        except Exception as error:  # noqa: BLE001  (whatever it was, it is that file's status)
            out.append((path, f"{type(error).__name__}: {error}"[:500]))
    return out
