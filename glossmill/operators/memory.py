"""Translation memory: replay of logs, pending work, filling and merging.

The sides that change, such as logs, may be as large as the corpus: every join here is an equi-join
that Spark may shuffle; none asks for a broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glossmill.operators.quality import assert_none


def last_wins(log: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The latest row of each key, by one aggregation with partial sums on the map side."""
    rest = [c for c in log.columns if c not in keys]
    picked = log.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))


def first_wins(log: DataFrame, keys: list[str], order: str, valid: Column | None = None) -> DataFrame:
    """The first valid row of each key."""
    rows = log if valid is None else log.where(valid)
    rest = [c for c in rows.columns if c not in keys]
    picked = rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"))
    return picked.select(*keys, *(F.col(f"_row.{c}").alias(c) for c in rest))


def known_sources(log: DataFrame, sources: DataFrame, keys: list[str]) -> DataFrame:
    """Log rows whose source still exists."""
    return log.join(sources.select(*keys), keys, "left_semi")


def pending(rows: DataFrame, memory: DataFrame, keys: list[str]) -> DataFrame:
    """Rows that the memory doesn't hold."""
    return rows.join(memory.select(*keys), keys, "left_anti")


def fill(rows: DataFrame, memory: DataFrame, keys: list[str], target: str = "translation", valid: Column | None = None) -> DataFrame:
    """Empty targets filled from the memory (column ``remembered``); others are left alone.

    ``valid`` may use the columns of the rows and ``remembered``. Adds ``filled``.
    """
    held = memory.select(*keys, F.col(target).alias("remembered"))
    joined = rows.join(held, keys, "left")
    empty = F.coalesce(F.col(target), F.lit("")) == ""
    usable = F.col("remembered").isNotNull() & (F.lit(True) if valid is None else F.coalesce(valid, F.lit(False)))
    filled = empty & usable
    new = F.when(filled, F.col("remembered")).otherwise(F.coalesce(F.col(target), F.lit("")))
    return joined.withColumn("filled", filled).withColumn(target, new).drop("remembered")


def merged_existing_wins(existing: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows and those of a finished batch whose keys are new."""
    return existing.unionByName(batch.join(existing.select(*keys), keys, "left_anti"))


def merged_later_wins(first: DataFrame, later: DataFrame, keys: list[str]) -> DataFrame:
    return later.unionByName(first.join(later.select(*keys), keys, "left_anti"))


def conflicts(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Keys with several values in two dictionaries, and how many."""
    return a.select(key, value).union(b.select(key, value)).distinct().groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def merged_or_conflict(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Union of two dictionaries; a key with two values is an error."""
    assert_none(conflicts(a, b, key, value), "keys with two values")
    return a.select(key, value).union(b.select(key, value)).distinct()


def strictest_context(rows: DataFrame) -> DataFrame:
    """For each source the location whose rules are strictest: one that may not reflow first."""
    order = F.struct("may_reflow", "tbl", "field")
    return rows.groupBy("source").agg(F.min_by(F.struct("tbl", "field", "may_reflow"), order).alias("context")).select("source", "context.*")


def missing_tables(source: DataFrame, target: DataFrame, table: str = "tbl") -> DataFrame:
    """Tables of the source that the target lacks altogether."""
    return source.select(table).distinct().join(target.select(table).distinct(), table, "left_anti")


def coverage(rows: DataFrame, *keys: str, target: str = "translation") -> DataFrame:
    done = F.count_if(F.coalesce(F.col(target), F.lit("")) != "")
    return rows.groupBy(*keys).agg(done.cast("long").alias("translated"), F.count(F.lit(1)).alias("total"))
