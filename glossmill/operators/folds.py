"""Greedy batches of groups of any size, in built-in functions.

Where a batch ends depends on where it began, so the fold over a group looks sequential. But a batch has
at most ``most`` rows, so all that a block of rows needs to know of what came before is how many of its
first rows belong to the batch that is open: its gap, below ``most``. A block is hence a small table from gap
to gap, with the batches begun in between, whatever precedes it. Tables of neighbouring blocks are
composed, blocks of blocks again, up to the group; then each group's gap 0 is handed down to its blocks
and rows. One group of a thousand million rows takes four levels, each dealt by (group, block).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glossmill.session import cut

BLOCK = 512
#: Groups of more rows are put in order by ranges rather than in one task.
LONG = 1_000_000


def positions(rows: DataFrame, group: str, order: list[str | Column], at: str, largest: int) -> DataFrame:
    """Adds ``at``, from 0: the place of each row in its group."""
    if largest <= LONG:
        number = F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long")
        return rows.withColumn(at, number - 1)
    named = rows.withColumns({f"_order{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)})
    keys = [group, *(f"_order{i}" for i in range(len(order)))]
    n = max(2, 2 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # What sampled ranges give is kept: places must be those of one run.
    ranged = cut(named.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_id", F.monotonically_increasing_id()))
    part = F.struct(group, F.shiftright("_id", 33).alias("part"))
    firsts = ranged.groupBy(part.alias("_part"), F.struct(group).alias("_g")).agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("_g").orderBy("_first")) - F.col("_n")  # a group lies in at most n ranges
    placed = ranged.withColumn("_part", part).join(firsts.select("_part", "_first", before.alias("_before")), "_part")
    return placed.withColumn(at, F.col("_before") + F.col("_id") - F.col("_first")).select(*rows.columns, at)


def longest(rows: DataFrame, group: str) -> int:
    """Rows of the largest group."""
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.max("n").alias("n")).first()["n"] or 0


def _lengths(weights: dict[str, int], most: int) -> Column:
    """For each own row of a block, how many rows a batch takes that begins there. ``items``: the block's
    rows in order and those after it; ``own``: how many are the block's."""
    fits = " AND ".join(f"a.w{i} + x.w{i} <= {cap}" for i, cap in enumerate(weights.values()))
    sums = lambda sign: ", ".join(f"{sign(i)} AS w{i}" for i in range(len(weights)))
    none = f"named_struct('k', 0, 'more', true, {', '.join(f"'w{i}', 0L" for i in range(len(weights)))})"
    add = f"struct(a.k + 1 AS k, true AS more, {sums(lambda i: f'a.w{i} + x.w{i}')})"
    stop = f"struct(a.k AS k, false AS more, {sums(lambda i: f'a.w{i}')})"
    run = f"aggregate(slice(items, i, {most}), {none}, (a, x) -> if(a.more AND (a.k = 0 OR ({fits})), {add}, {stop}), a -> a.k)"
    return F.expr(f"transform(sequence(1, own), i -> {run})")


#: What a row does to (gap, batches begun so far): a gap closes by one, else a batch begins.
_ROW = "if(a.gap = 0, struct(x - 1 AS gap, a.n + 1 AS n), struct(a.gap - 1 AS gap, a.n AS n))"
_BLOCK = "struct(x.ends[a.gap].gap AS gap, a.n + x.ends[a.gap].n AS n)"


def _table(items: str, step: str, most: int) -> Column:
    """For each gap at the start: the gap at the end and the batches begun."""
    return F.expr(f"transform(sequence(0, {most - 1}), e -> aggregate({items}, struct(e AS gap, 0L AS n), (a, x) -> {step}))")


def _once(frame: DataFrame, keep: list[str], /, **columns: Column) -> DataFrame:
    """The kept columns and new ones, which are computed once for a row: the optimizer moves what a lambda
    uses into it, where it would be computed for each element, but not through an explode."""
    made = frame.select(*keep, F.explode(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))).alias("_made"))
    return made.select(*keep, *(F.col(f"_made.{n}").alias(n) for n in columns))


def greedy(rows: DataFrame, group: str, order: list[str], weights: dict[str, int], most: int) -> DataFrame:
    """Rows with ``batch``, counted from 0 in each group by ``order``.

    A batch closes when the next row would take one of its sums over the cap in ``weights``; every row is
    put somewhere, if need be alone. No batch has more than ``most`` rows, which the weights must see to:
    with a weight of at least 1 for a row, and ``most`` as its cap. Null weights count as 0.
    """
    largest = longest(rows, group)
    size = max(BLOCK, most)
    own = {f"w{i}": F.coalesce(F.col(c).cast("long"), F.lit(0).cast("long")) for i, c in enumerate(weights)}
    placed = positions(rows, group, [*order, *weights], "_at", largest)
    held = placed.select(F.struct(group).alias("_g"), "_at", F.struct(F.col("_at").alias("at"), *(w.alias(c) for c, w in own.items())).alias("_w"), F.struct(*rows.columns).alias("_row"))
    # The first rows of a block are also what the block before it looks ahead to.
    block = F.floor(F.col("_at") / size).cast("long")
    early = (F.col("_at") % size < most) & (block > 0)
    sent = held.withColumn("_b", F.explode(F.when(early, F.array(block, block - 1)).otherwise(F.array(block))))
    mine = F.when(F.floor(F.col("_at") / size) == F.col("_b"), F.struct("_at", "_row"))
    gathered = sent.groupBy("_g", "_b").agg(F.collect_list("_w").alias("items"), F.collect_list(mine).alias("rows"))
    # By place: the numbers before it are all that decides, as places differ.
    by_place = "(x, y) -> CAST(x._at - y._at AS INT)"
    blocks = _once(gathered, ["_g", "_b"], items=F.sort_array("items"), rows=F.expr(f"array_sort(rows, {by_place})"))
    blocks = _once(blocks.withColumn("own", F.size("rows")), ["_g", "_b", "rows"], lengths=_lengths(weights, most))

    levels, n = [_once(blocks, ["_g", "_b"], ends=_table("lengths", _ROW, most))], -(-largest // size)
    while n > 1:
        below = levels[-1].withColumn("_up", F.floor(F.col("_b") / BLOCK).cast("long"))
        n = -(-n // BLOCK)
        inner = below.groupBy("_g", F.col("_up").alias("_b")).agg(F.collect_list(F.struct("_b", "ends")).alias("inner"))
        inner = _once(inner, ["_g", "_b"], inner=F.expr("array_sort(inner, (x, y) -> CAST(x._b - y._b AS INT))"))
        levels.append(_once(inner, ["_g", "_b", "inner"], ends=_table("inner", _BLOCK, most)))
    begin = F.struct(F.lit(0).alias("gap"), F.lit(0).cast("long").alias("n"))
    if len(levels) == 1:
        known = blocks.withColumn("_s", begin)
    else:
        states = levels[-1].select("_g", "_b", "inner", begin.alias("_s"))
        for level in reversed(levels[:-1]):
            told = f"aggregate(inner, struct(_s AS s, array() :: array<struct<b: bigint, s: struct<gap: int, n: bigint>>> AS out), (a, x) -> struct({_BLOCK.replace('a.', 'a.s.')} AS s, concat(a.out, array(struct(x._b AS b, a.s AS s))) AS out), a -> a.out)"
            states = states.select("_g", F.explode(F.expr(told)).alias("_x")).select("_g", F.col("_x.b").alias("_b"), F.col("_x.s").alias("_s"))
            if "inner" in level.columns:
                states = level.select("_g", "_b", "inner").join(states, ["_g", "_b"])
        known = blocks.join(states, ["_g", "_b"])
    # The batch of a row is the last begun with it: the first row of a batch begins one more.
    scan = f"aggregate(lengths, struct(_s AS s, array() :: array<bigint> AS out), (a, x) -> struct({_ROW.replace('a.', 'a.s.')} AS s, concat(a.out, array(a.s.n - if(a.s.gap = 0, 0, 1))) AS out), a -> a.out)"
    out = known.select(F.explode(F.arrays_zip("rows", F.expr(scan).alias("batch"))).alias("_x"))
    return out.select("_x.rows._row.*", F.col("_x.batch").alias("batch"))
