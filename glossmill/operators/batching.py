"""Order-preserving batches, samples, representatives and runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.operators import folds


def greedy_batches(rows: DataFrame, group: str, order: str, size: str, max_rows: int, max_size: int) -> DataFrame:
    """Rows with ``batch``, counted from 0 in each group.

    A batch closes when it has max_rows rows, or when the next row would take it over max_size; a
    single row above max_size stands alone. A group of any size is folded block by block, in many tasks.
    """
    one = "_one"
    return folds.greedy(rows.withColumn(one, F.lit(1)), group, [order], {one: max_rows, size: max_size}, max_rows).drop(one)


def two_lane_batches(rows: DataFrame, group: str, order: str, size: str, short: Column, caps: dict[str, int], max_size: int) -> DataFrame:
    """Greedy batches of each group, short rows and others in lanes of their own."""
    laned = rows.withColumn("lane", F.when(short, F.lit("short")).otherwise(F.lit("normal"))).withColumn("_key", F.concat_ws("\x1f", F.col(group).cast("string"), "lane"))
    parts = [greedy_batches(laned.where(F.col("lane") == lane), "_key", order, size, cap, max_size) for lane, cap in caps.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.drop("_key")


def packed_parts(rows: DataFrame, group: str, order: str, part: str, max_rows: int, max_size: int, size: str) -> DataFrame:
    """Whole parts (rows of one ``part`` value) packed greedily within a group: adds ``batch`` and
    ``parts``, how many the batch holds."""
    parts = rows.groupBy(group, part).agg(F.min(order).alias("_first"), F.count(F.lit(1)).alias("_rows"), F.sum(size).alias("_size"))
    packed = folds.greedy(parts, group, ["_first"], {"_rows": max_rows, "_size": max_size}, max_rows)
    alone = packed.groupBy(group, "batch").agg(F.count(F.lit(1)).alias("parts"))
    return rows.join(packed.select(group, part, "batch").join(alone, [group, "batch"]), [group, part])


def fixed_chunks(rows: DataFrame, group: str, order: str, n: int) -> DataFrame:
    """Rows with ``chunk``, from 0: n rows of a group at a time, by ``order``; a long group is numbered in many tasks."""
    placed = folds.positions(rows, group, [order], "_at", folds.longest(rows, group))
    return placed.withColumn("chunk", F.floor(F.col("_at") / n).cast("long")).drop("_at")


def ranked(rows: DataFrame, order: list[str], at: str) -> DataFrame:
    """Adds ``at``, from 1: the place of each row among all. Rows are dealt by ranges of the order and
    numbered range by range; no task sees all."""
    every = rows.withColumn("_all", F.lit(1))
    placed = folds.positions(every, "_all", order, at, folds.LONG + 1)
    return placed.withColumn(at, F.col(at) + 1).drop("_all")


def first_of_each(rows: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    """The first n rows of each key; Spark keeps no more than n of a key before the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("at", F.row_number().over(w)).where(F.col("at") <= n)


def representatives(rows: DataFrame, signature: list[str], order: str) -> DataFrame:
    """The first row of each signature with ``aliases``, the number of rows that it stands for."""
    rest = [c for c in rows.columns if c not in signature]
    picked = rows.groupBy(*signature).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_row"), (F.count(F.lit(1)) - 1).alias("aliases"))
    return picked.select(*signature, *(F.col(f"_row.{c}").alias(c) for c in rest), "aliases")


def failure_runs(rows: DataFrame, run: str, order: str, ok: Column, limit: int = 64) -> DataFrame:
    """Every completion with the length of the failure run it stands in, and whether the breaker
    is open: some run of failures before or at it has reached ``limit``."""
    w = Window.partitionBy(run).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    island = F.sum(F.when(ok, 1).otherwise(0)).over(w)
    rows = rows.withColumn("island", island)
    inside = Window.partitionBy(run, "island").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("failures", F.sum(F.when(ok, 0).otherwise(1)).over(inside).cast("long"))
    return rows.withColumn("open", F.max(F.col("failures") >= limit).over(w)).drop("island")


def neighbours(rows: DataFrame, group: str, order: str, *columns: str) -> DataFrame:
    """Adds ``neighbors``: the rows before and after in the group, as structs."""
    w = Window.partitionBy(group).orderBy(order)
    here = F.struct(*columns)
    return rows.withColumn("neighbors", F.array_compact(F.array(F.lag(here).over(w), F.lead(here).over(w))))
