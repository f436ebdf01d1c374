"""Operator 7: nearest neighbours by low-dimensional stable projections in a kd-tree.

Largest inner product becomes smallest distance: candidates of a norm group are scaled by the
group's largest norm M and get one more component that makes them unit vectors, queries are scaled
to unit length and get a 0, so that distance squared = 2 - 2 <x, q> / (M |q|). Both are projected on
a few Gaussian directions (2-stable: a projected distance squared over the true one is chi-square
distributed). Norm groups keep M close to each norm: with one M for all, short vectors would all
lie equally far away.

Equal vectors are one class with its smallest ids, as many as can matter. Classes are dealt to
shards; a shard's groups, largest norms first, each have a kd-tree over its projections, built once.
Every block of queries meets every shard once (the stated query set against all rows, in blocks).
A query takes a tree's points in order of their projected distance, some hundred at a time, and
verifies them by inner product in double precision. It leaves a tree once the chi-square test says
that a vector beyond the projected distance reached would, at ``confidence``, not be nearer than
the k-th found, and the shard once norms are too short for any. The shards' lists are then merged.

Edge cases: null, zero or non-finite vectors take no part as query or candidate; a query's
candidates are the vectors of its own length; fewer candidates than k give all; ties go to the
smaller id; equal rows (id and vector) count once; rows of one id with different vectors are rows of
their own, as queries and as candidates, also of each other; rows without an id are left out. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glossmill.llm.frames import cut, pieces
from glossmill.llm.vectors import lengths, matrix, rows_of

K = 20
DIRECTIONS = 16  # even
CONFIDENCE = 0.95
SHARD_ROWS = 16_384
#: A shard has fewer rows if its vectors are long.
SHARD_BYTES = 16 << 20
#: The shortest norm of a group by its longest.
NORM_RATIO = 0.9
QUERY_ROWS = 4_096
#: Points verified at a time, between two tests.
STEP = 512
_BOX = 64


def chi_square(x: np.ndarray, m: int) -> np.ndarray:
    """Distribution function of chi-square with an even number m of degrees."""
    half = x / 2
    term, total = np.ones_like(half), np.ones_like(half)
    for i in range(1, m // 2):
        term = term * half / i
        total = total + term
    return 1 - np.exp(-half) * total


def chi_square_at(p: float, m: int) -> float:
    """Where the distribution function reaches p."""
    low, high = 0.0, 64.0 * m
    for _ in range(80):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(np.array(middle), m) < p else (low, middle)
    return high


class KdTree:
    """Boxes of at most _BOX points each: order of the points, and sizes of the boxes."""

    def __init__(self, points: np.ndarray) -> None:
        done: list[np.ndarray] = []
        todo = [np.arange(len(points))]
        while todo:
            at = todo.pop()
            if len(at) <= _BOX:
                done.append(at)
                continue
            axis = int(np.ptp(points[at], axis=0).argmax())
            half = len(at) // 2
            order = np.argpartition(points[at, axis], half)
            todo += [at[order[half:]], at[order[:half]]]
        self.order = np.concatenate(done)
        self.sizes = np.array([len(a) for a in done])


class Shard:
    """Vectors in the order of their boxes, and the boxes of each norm group's tree."""

    def __init__(self, vectors: np.ndarray, shadows: np.ndarray, boxes: np.ndarray, largest: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> None:
        """largest: the longest norm in each row's group, which tells groups apart."""
        self.vectors, self.shadows, self.ids, self.bounds = vectors, shadows, ids, bounds
        first = np.flatnonzero(np.r_[True, boxes[1:] != boxes[:-1]])
        self.cuts = np.r_[first, len(boxes)]
        self.low, self.high = np.minimum.reduceat(shadows, first), np.maximum.reduceat(shadows, first)
        longest = largest[first]
        begins = np.flatnonzero(np.r_[True, longest[1:] != longest[:-1]])
        self.groups, self.largest = np.r_[begins, len(first)], longest[begins]

    @staticmethod
    def placed(vectors: np.ndarray, stable: np.ndarray, ratio: float) -> tuple[np.ndarray, ...]:
        """Order of the vectors by groups and boxes, and in that order their projections, boxes and
        the largest norms of their groups."""
        norms = np.linalg.norm(vectors, axis=1)
        by_norm = np.argsort(-norms, kind="stable")
        sorted_norms, d = norms[by_norm], vectors.shape[1]
        order, shadows, boxes, largest, done, n_boxes = [], [], [], [], 0, 0
        while done < len(by_norm):
            top = sorted_norms[done]
            own = by_norm[done : done + int(np.count_nonzero(sorted_norms[done:] >= ratio * top))]
            scaled = vectors[own] / top
            lift = np.sqrt(np.maximum(0, 1 - (scaled * scaled).sum(axis=1)))
            points = scaled @ stable[:d] + lift[:, None] * stable[d]
            tree = KdTree(points)
            order.append(own[tree.order])
            shadows.append(points[tree.order])
            boxes.append(np.repeat(np.arange(len(tree.sizes)) + n_boxes, tree.sizes))
            largest.append(np.full(len(own), top))
            done, n_boxes = done + len(own), n_boxes + len(tree.sizes)
        return tuple(np.concatenate(x) for x in (order, shadows, boxes, largest))

    def search(self, query: np.ndarray, shadow: np.ndarray, length: float, k: int, beyond: float, step: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Rows that may be among the k best, their inner products, and how many were verified.

        Rows that tie with the k-th stay, so that ids can decide. beyond: where chi-square reaches
        the confidence.
        """
        rows, scores, verified = np.zeros(0, np.int64), np.zeros(0), 0
        for g, largest in enumerate(self.largest.tolist()):
            if len(scores) >= k and scores.min() > largest * length * (1 + 1e-12):
                break  # no vector of this or a later group is long enough
            first, last = self.groups[g], self.groups[g + 1]
            gap = np.maximum(self.low[first:last] - shadow, 0) + np.maximum(shadow - self.high[first:last], 0)
            away = (gap * gap).sum(axis=1)
            nearest = np.argsort(away, kind="stable")
            away = np.append(away[nearest], np.inf)
            opened, left, far = 0, np.zeros(0, np.int64), np.zeros(0)
            taken = 0
            while True:
                wanted = max(step, taken // 4)
                while opened < len(nearest) and np.count_nonzero(far <= away[opened]) < wanted:
                    more = nearest[opened : opened + max(16, opened)] + first
                    sizes = self.cuts[more + 1] - self.cuts[more]
                    new = np.repeat(self.cuts[more + 1] - np.cumsum(sizes), sizes) + np.arange(sizes.sum())
                    off = self.shadows[new] - shadow
                    left, far = np.r_[left, new], np.r_[far, np.einsum("ij,ij->i", off, off)]
                    opened = min(opened + len(more), len(nearest))
                if not len(left):
                    break
                if len(left) > wanted:
                    part = np.argpartition(far, wanted - 1)
                    now, left, far = left[part[:wanted]], left[part[wanted:]], far[part[wanted:]]
                else:
                    now, left, far = left, left[:0], far[:0]
                verified, taken = verified + len(now), taken + len(now)
                rows, scores = self._better(query, now, rows, scores, k)
                if len(scores) >= k:
                    reach = 2 - 2 * scores.min() / (largest * length)  # true distance squared of the k-th
                    next_ = min(far.min(initial=np.inf), away[opened])
                    if reach <= 0 or next_ >= beyond * reach:
                        break
        return rows, scores, verified

    def _better(self, query: np.ndarray, now: np.ndarray, rows: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        rough = self.vectors[now] @ query
        bar = scores.min() if len(scores) >= k else -np.inf
        if len(now) > k:
            bar = max(bar, np.partition(rough, len(rough) - k)[len(rough) - k])
        now = now[rough >= bar - 1e-9 * (1 + abs(bar))] if np.isfinite(bar) else now
        # Summed from the first component on, so that a score never depends on a library's blocking.
        exact = np.cumsum(self.vectors[now] * query, axis=1)[:, -1] if len(now) else np.zeros(0)
        rows, scores = np.r_[rows, now], np.r_[scores, exact]
        if len(scores) > k:
            keep = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
            rows, scores = rows[keep], scores[keep]
        return rows, scores


def nearest(
    table: DataFrame,
    queries: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    k: int = K,
    directions: int = DIRECTIONS,
    confidence: float = CONFIDENCE,
    shard_rows: int = SHARD_ROWS,
    norm_ratio: float = NORM_RATIO,
    query_rows: int = QUERY_ROWS,
    step: int = STEP,
    seed: int = 11,
    report: bool = False,
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k candidates of largest inner product found.

    ``queries`` has the same columns as ``table``; a query's own row is no candidate of it. With
    ``report`` also ``verified``: how many classes of equal vectors were verified for the query.
    """
    rows, asked = rows_of(table, vec_id, vector), rows_of(queries, vec_id, vector)
    schema = "query_id long, rank int, vec_id long, score double" + (", verified long" if report else "")
    out = table.sparkSession.createDataFrame([], schema)
    for d in lengths(asked):
        own, wanted = rows.where(F.size("v") == d), asked.where(F.size("v") == d)
        out = out.unionByName(_of_length(own, wanted, d, k, directions, confidence, shard_rows, norm_ratio, query_rows, step, seed, report).select(*out.columns))
    return out


def _of_length(rows: DataFrame, asked: DataFrame, d: int, k: int, directions: int, confidence: float, shard_rows: int, norm_ratio: float, query_rows: int, step: int, seed: int, report: bool) -> DataFrame:
    few = k + 1
    ids = rows.dropDuplicates(["vec_id", "v"]).withColumn("at", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("at") <= few)
    classes = cut(ids.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids")))  # at most k + 1 each
    n_shards = pieces(classes.count(), max(_BOX, min(shard_rows, SHARD_BYTES // (8 * d))))
    single = cut(asked.dropDuplicates(["vec_id", "v"]))
    kinds = cut(single.select("v").distinct().withColumn("query", F.monotonically_increasing_id()))  # numbers of one run
    n_blocks = pieces(kinds.count(), query_rows)
    stable = np.random.default_rng(seed).standard_normal((d + 1, directions))
    beyond = chi_square_at(confidence, directions)

    def build(group: pa.Table) -> pa.Table:
        group = group.sort_by("least")
        order, shadows, boxes, largest = Shard.placed(matrix(group["v"], d), stable, norm_ratio)
        group = group.take(order)
        shadow = pa.FixedSizeListArray.from_arrays(pa.array(shadows.ravel()), directions).cast(pa.list_(pa.float64()))
        return pa.table([group["shard"], group["v"].cast(pa.list_(pa.float64())), group["ids"].cast(pa.list_(pa.int64())), shadow, pa.array(boxes.astype(np.int32)), pa.array(largest)], ["shard", "v", "ids", "shadow", "box", "largest"])

    shard = F.pmod(F.xxhash64("v"), F.lit(n_shards)).cast("int")
    block = F.pmod(F.xxhash64("query", F.lit(1)), F.lit(n_blocks)).cast("int")
    index = classes.select(shard.alias("shard"), "v", "ids", F.get("ids", F.lit(0)).alias("least")).groupBy("shard").applyInArrow(build, "shard int, v array<double>, ids array<long>, shadow array<double>, box int, largest double")
    left = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    right = kinds.select(F.explode(F.sequence(F.lit(0), F.lit(n_shards - 1))).alias("shard"), block.alias("block"), "query", "v")

    def search(built: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], [], []]
        if built.num_rows and wanted.num_rows:
            built = built.append_column("least", pc.list_element(built["ids"], 0)).sort_by([("box", "ascending"), ("least", "ascending")]).combine_chunks()
            members = built["ids"].combine_chunks()
            bounds = np.r_[0, np.cumsum(pc.list_value_length(members).to_numpy())]
            shard = Shard(matrix(built["v"], d), matrix(built["shadow"], directions), built["box"].to_numpy(), built["largest"].to_numpy(), members.flatten().to_numpy(), bounds)
            asked = matrix(wanted["v"], d)
            sizes = np.linalg.norm(asked, axis=1)
            shadows = (asked / sizes[:, None]) @ stable[:d]
            for q, query, size, shadow in zip(wanted["query"].to_pylist(), asked, sizes.tolist(), shadows):
                found, scores, verified = shard.search(query, shadow, size, few, beyond, step)
                first = np.lexsort((shard.ids[shard.bounds[found]], -scores))[:few]
                equal = (shard.vectors[found] == query).all(axis=1)
                best = sorted((-scores[i], v, bool(equal[i])) for i in first.tolist() for v in shard.ids[shard.bounds[found[i]] : shard.bounds[found[i] + 1]].tolist())[:few]
                out[0] += [q] * len(best)
                out[1] += [v for _, v, _ in best]
                out[2] += [-s for s, _, _ in best]
                out[4] += [e for _, _, e in best]
                out[3] += [verified] + [0] * (len(best) - 1)
        kinds = (pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.bool_())
        return pa.table({name: pa.array(x, t) for name, x, t in zip(("query", "vec_id", "score", "verified", "equal"), out, kinds)})

    found = left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block")).applyInArrow(search, "query long, vec_id long, score double, verified long, equal boolean")
    # The k + 1 best of each distinct query, so that every row of it can leave itself out.
    ranked = F.row_number().over(Window.partitionBy("query").orderBy(F.col("score").desc(), "vec_id"))
    best = found.select("query", "vec_id", "score", "equal").withColumn("at", ranked).where(F.col("at") <= few)
    merged = best.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("away"), "vec_id", "equal"))).alias("best"))
    if report:
        merged = merged.join(found.groupBy("query").agg(F.sum("verified").alias("verified")), "query")
    everyone = single.select(F.col("vec_id").alias("query_id"), "v").join(kinds, "v").select("query_id", "query")
    kept = F.slice(F.filter("best", lambda x: ~(x["equal"] & (x["vec_id"] == F.col("query_id")))), 1, k)
    listed = everyone.join(merged, "query").withColumn("best", kept)
    also = ["verified"] if report else []
    return listed.select("query_id", *also, F.posexplode("best").alias("at", "x")).select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.vec_id").alias("vec_id"), (-F.col("x.away")).alias("score"), *also
    )


def query(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(table, table.where(F.col("vec_id") % 20 == 0))


ORACLE = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
), u AS (
  SELECT vec_id, e FROM v WHERE list_dot_product(e, e) > 0 AND isfinite(list_dot_product(e, e)) AND list_count(e) = len(e)
), w AS (
  SELECT DISTINCT vec_id, e FROM u
), s AS (
  SELECT q.vec_id AS query_id, q.e AS qe, c.vec_id, list_dot_product(q.e, c.e) AS score
  FROM w q JOIN w c ON (q.vec_id, q.e) <> (c.vec_id, c.e) WHERE q.vec_id % 20 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id, qe ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 20
"""
