"""A breaker over a stream of results: open after so many failures in a row, for each run by itself.

Each run's state is two values in Spark's state store, so runs break apart, results of many runs are
counted in many tasks, and a stream that starts over goes on where it was. What is ordered in one task is
one run's results within one micro-batch, never the micro-batch.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StructField, StructType

LIMIT = 64
_STORE = "spark.sql.streaming.stateStore.providerClass"


class _Run(StatefulProcessor):
    """One run: failures in a row, and whether it has broken."""

    def __init__(self, run: str, order: str, limit: int) -> None:
        self.run, self.order, self.limit = run, order, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("failures", StructType([StructField("n", LongType()), StructField("open", BooleanType())]))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        n, broken = self.state.get() if self.state.exists() else (0, False)
        frame = pd.concat(list(rows)).sort_values(self.order, kind="stable")
        failures, opened = [], []
        for ok in frame["ok"].tolist():
            n = 0 if ok else n + 1
            broken = broken or n >= self.limit
            failures.append(n)
            opened.append(broken)
        self.state.update((int(n), bool(broken)))
        yield frame.assign(failures=failures, open=opened)

    def close(self) -> None:
        pass


def with_state_store(spark: SparkSession) -> SparkSession:
    """The session with a state store that keeps values of several names, unless one is chosen already."""
    if not spark.conf.get(_STORE, "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    return spark


def broken_runs(stream: DataFrame, run: str, order: str, limit: int = LIMIT) -> DataFrame:
    """The stream's rows (``run``, ``order``, a boolean ``ok``, and others) with ``failures``, how many in a row
    at this one, and ``open``: some run of failures at or before it has reached ``limit``. Once open it stays so."""
    with_state_store(stream.sparkSession)
    schema = ", ".join(f"`{c}` {kind}" for c, kind in stream.dtypes) + ", failures long, open boolean"
    return stream.groupBy(run).transformWithStateInPandas(_Run(run, order, limit), schema, "append", "none")


def halting(keep: Callable[[DataFrame, int], None], run: str) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that keeps the batch and then stops the stream if all runs in it have broken:
    what was in flight is recorded, and nothing new is begun."""

    def take(batch: DataFrame, number: int) -> None:
        batch.persist()  # its state is counted once
        try:
            keep(batch, number)
            left = batch.groupBy(run).agg(F.bool_or("open").alias("open")).agg(F.count(F.lit(1)).alias("runs"), F.count_if("open").alias("broken")).first()
        finally:
            batch.unpersist()
        if left["runs"] and left["runs"] == left["broken"]:
            raise RuntimeError("stopped: every run of the batch has broken")

    return take
