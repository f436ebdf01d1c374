"""Operator 3: embedding near-dedup by a forest of random-projection trees.

Equal vectors are one class first, however many rows share them. Where classes lie dense, trees
would part near copies at every level, so dense places have cells of their own, whose links are
found exactly: leaders are vectors of the sample with many near ones there, a class is at home with
the closest leader that it links with, and a cell holds the classes at home with its leader and as
visitors all others within twice the threshold's angle, so any class that one at home can link
with. Those within half the angle all link with one another, which sums tell; other pairs of a cell
are compared block by block, each pair of blocks in a task of its own. Pairs of two classes without
a home are left to the trees. Each tree splits these classes
recursively: a random direction, the median of the projections on it, and two children that
overlap by ``spill`` of the rows on either side of the median, so that near pairs seldom part.
The upper levels are fitted on a bounded sample (``sample_rows``) and every such class is routed
through them; leaves that hold more than ``most_rows`` are then grown further, each on a sample of its
own rows, level by level, so leaves stay small however large the table is.
Within a leaf all pairs are compared in double precision, block by block. A pair that meets in
several leaves counts in the first of them alone, which both rows' leaf lists tell, so leaves give
sums of links and spanning edges but no pairs. Components are the union of the edges.

Edge cases: null, zero or non-finite vectors link with nothing (n_links 0, a component of their
own); vectors link only with those of their own length; a null vec_id is left out; each row of a
repeated vec_id counts as a vector, and the id gets the most links and the smallest component of
its rows. An empty table gives no rows.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.bytewords import mix
from glossmill.llm.components import components
from glossmill.llm.frames import cut
from glossmill.llm.vectors import lengths, matrix, rows_of

TREES = 12
SPILL = 0.06
LEAF = 600
SAMPLE_ROWS = 32_768
#: The sample has fewer rows if its vectors are long.
SAMPLE_BYTES = 64 << 20
#: Leaves with more rows are split further, on so many of their rows.
MOST_ROWS, SPLIT_ROWS = 4_800, 4_096
_ROUTED = 50_000  # rows of one leaf that a task routes
_LEVELS = 12
_BLOCK = 1024
_FOUND = "rep long, links long, hub long"
_CELL_BLOCK = 256  # a cell of m classes is compared in blocks of sqrt(256 m) of them, so in m / 256 pairs of blocks


class Tree:
    """Splits of one tree as arrays: direction, where the right child begins and the left ends."""

    def __init__(self, sample: np.ndarray, leaf: int, spill: float, rng: np.random.Generator) -> None:
        self.ways: list[np.ndarray] = []
        self.lows: list[float] = []
        self.highs: list[float] = []
        self.kids: list[tuple[int, int]] = []  # child number, or -1 - leaf
        self.n_leaves = 0
        self.root = self._grow(sample, leaf, spill, rng)

    def _grow(self, rows: np.ndarray, leaf: int, spill: float, rng: np.random.Generator) -> int:
        if len(rows) > leaf:
            for _ in range(4):
                way = rng.standard_normal(rows.shape[1])
                along = rows @ way
                low, high = np.quantile(along, [0.5 - spill, 0.5 + spill])
                left, right = along <= high, along >= low
                if left.sum() < 0.8 * len(rows) and right.sum() < 0.8 * len(rows):
                    at = len(self.ways)
                    self.ways.append(way)
                    self.lows.append(low)
                    self.highs.append(high)
                    self.kids.append((0, 0))
                    self.kids[at] = (self._grow(rows[left], leaf, spill, rng), self._grow(rows[right], leaf, spill, rng))
                    return at
        self.n_leaves += 1
        return -self.n_leaves

    def route(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and leaves, a row once for each leaf that it falls in."""
        out: list[tuple[np.ndarray, np.ndarray]] = []
        todo = [(self.root, np.arange(len(rows)))]
        while todo:
            node, at = todo.pop()
            if node < 0 or not len(at):
                out.append((at, np.full(len(at), -1 - min(node, -1), np.int32)))
                continue
            along = rows[at] @ self.ways[node]
            todo.append((self.kids[node][0], at[along <= self.highs[node]]))
            todo.append((self.kids[node][1], at[along >= self.lows[node]]))
        return np.concatenate([a for a, _ in out]), np.concatenate([b for _, b in out])


def _first_meeting(lists: list[np.ndarray], i: np.ndarray, j: np.ndarray, tree: int, leaf: int) -> np.ndarray:
    """Which pairs meet in no leaf before this one. lists[t]: (rows, width) leaves, -1 for none."""
    alive = np.arange(len(i))
    for t in range(tree + 1):
        if not len(alive):
            break
        a, b = lists[t][i[alive]], lists[t][j[alive]]
        same = (a[:, :, None] == b[:, None, :]) & (a >= 0)[:, :, None]
        if t == tree:
            same &= (a < leaf)[:, :, None]
        alive = alive[~same.any(axis=(1, 2))]
    return alive


def _leaders(sample: np.ndarray, threshold: float, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Leaders of dense places, and the rows of the sample that are at home with none.

    A row is dense if ``least`` rows of the sample link with it; the densest lead, and every dense
    row leads or links with a leader."""
    near = sample.astype(np.float32)
    n = np.concatenate([(near[at : at + _BLOCK] @ near.T >= threshold).sum(axis=1) for at in range(0, len(near), _BLOCK)] or [np.zeros(0, np.int64)])
    homeless = np.ones(len(sample), bool)
    leaders = []
    for i in np.argsort(-n, kind="stable"):
        if n[i] <= least:
            break
        if homeless[i]:
            leaders.append(i)
            homeless &= sample @ sample[i] < threshold
            homeless[i] = False
    return sample[leaders], sample[homeless]


def _unite(root: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest row that these links reach, over and over."""
    while True:
        low = np.minimum(root[x], root[y])
        before = root.copy()
        np.minimum.at(root, x, low)
        np.minimum.at(root, y, low)
        np.minimum.at(root, before[x], low)
        np.minimum.at(root, before[y], low)
        root = root[root]
        if np.array_equal(before, root):
            return root


def _in_cells(classes: DataFrame, leaders: np.ndarray, d: int, threshold: float) -> tuple[DataFrame, DataFrame]:
    """Links and edges of all pairs with a class at home in some cell, and the classes without a home.

    A pair counts in the home of lower number, so no class visits a cell of higher number than its
    own home's."""
    half = np.sqrt((1 + threshold) / 2) + 1e-7  # so near the leader, two rows surely link
    far = 2 * threshold * threshold - 1 - 1e-7 if threshold > 0 else -2.0
    shared = classes.sparkSession.sparkContext.broadcast(leaders)
    n_cells = len(leaders)

    def place(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                unit = matrix(part.column(0), d)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                close = unit @ shared.value.T
                home = close.argmax(axis=1)
                top = close[np.arange(len(home)), home]
                home[top < threshold] = -1
                visits = (close >= far) & (np.arange(n_cells) < np.where(home < 0, n_cells, home)[:, None])
                bounds = np.r_[0, np.cumsum(visits.sum(axis=1))].astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.nonzero(visits)[1].astype(np.int32)))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(home.astype(np.int32)), pa.array(top >= half), cells], ["v", "rep", "n", "home", "core", "visits"])

    placed = cut(classes.mapInArrow(place, "v array<double>, rep long, n long, home int, core boolean, visits array<int>"))
    at_home = F.when(F.col("core"), 0).otherwise(1).alias("part")
    here = placed.where("home >= 0").select("v", "rep", "n", F.col("home").alias("cell"), at_home)
    here = here.unionByName(placed.select("v", "rep", "n", F.explode("visits").alias("cell"), F.lit(2).alias("part")))
    blocks = np.zeros((n_cells, 3), np.int64)  # of the core, of the others at home, of visitors
    for r in here.groupBy("cell", "part").agg(F.count(F.lit(1)).alias("m")).collect():
        blocks[r["cell"], r["part"]] = max(1, round(np.sqrt(r["m"] / _CELL_BLOCK)))

    def deal(batches):
        for batch in batches:
            cell, part, salt = (batch.column(k).to_numpy() for k in (3, 4, 5))
            count = blocks[cell]
            first = np.c_[np.zeros(len(cell), np.int64), np.cumsum(count, axis=1)]
            own = first[np.arange(len(cell)), part] + salt % np.maximum(count[np.arange(len(cell)), part], 1)
            low = np.where(part == 0, first[:, 1], 0)  # the core meets all but itself, visitors all but visitors
            high = np.where(part == 2, first[:, 2], first[:, 3])
            times = high - low
            for at in range(0, len(cell), 1024):
                who = np.repeat(np.arange(at, min(at + 1024, len(cell))), times[at : at + 1024])
                if len(who):
                    begin = np.cumsum(times[at : at + 1024]) - times[at : at + 1024]
                    other = low[who] + np.arange(len(who)) - begin[who - at]
                    a, b = np.minimum(own[who], other), np.maximum(own[who], other)
                    v, rep, n = (batch.column(k).take(pa.array(who)) for k in range(3))
                    yield pa.RecordBatch.from_arrays([*map(pa.array, (cell[who].astype(np.int32), a.astype(np.int32), b.astype(np.int32), own[who] != a)), v, rep, n], ["cell", "a", "b", "second", "v", "rep", "n"])

    def compare(group: pa.Table) -> pa.Table:
        group = group.sort_by([("second", "ascending"), ("rep", "ascending")])
        rep, n = group["rep"].to_numpy(), group["n"].to_numpy()
        unit = matrix(group["v"], d)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        m = len(rep)
        whole = group["a"][0].as_py() == group["b"][0].as_py()
        side = 0 if whole else m - int(np.count_nonzero(group["second"].to_numpy()))
        links, root = np.zeros(m, np.int64), np.arange(m)
        for a in range(0, m if whole else side, _BLOCK):
            x = np.arange(a, min(a + _BLOCK, m if whole else side))
            for b in range(a if whole else side, m, _BLOCK):
                y = np.arange(b, min(b + _BLOCK, m))
                near = unit[x] @ unit[y].T >= threshold
                if whole and a == b:
                    near = np.triu(near, 1)
                if near.any():
                    links[x] += (near @ n[y].astype(np.float64)).astype(np.int64)
                    links[y] += (n[x].astype(np.float64) @ near).astype(np.int64)
                    i, j = np.nonzero(near & (root[x][:, None] != root[y][None, :]))
                    if len(i):
                        root = _unite(root, x[i], y[j])
        seen = links > 0
        return pa.table({"rep": rep[seen], "links": links[seen], "hub": rep[root[seen]]})

    salted = here.select("v", "rep", "n", "cell", "part", F.pmod(F.xxhash64("rep"), F.lit(1 << 30)).alias("salt"))
    dealt = salted.mapInArrow(deal, "cell int, a int, b int, second boolean, v array<double>, rep long, n long")
    found = dealt.groupBy("cell", "a", "b").applyInArrow(compare, _FOUND)
    core = placed.where("home >= 0 AND core").select("rep", "n", "home")
    whole = core.groupBy("home").agg(F.sum("n").alias("all"), F.min("rep").alias("hub"))
    inner = core.join(F.broadcast(whole), "home").select("rep", (F.col("all") - F.col("n")).alias("links"), "hub")
    return found.unionByName(inner), placed.where("home < 0").select("v", "rep", "n")


def _grown(classes: DataFrame, routed: DataFrame, d: int, leaf: int, spill: float, most_rows: int, seed: int) -> DataFrame:
    """(rep, leaves) with every leaf of more than ``most_rows`` rows split further.

    A leaf's rows are routed in salted tasks, its splits are fitted in one on a bounded sample of
    them. Numbers of new leaves are hashes; should two be equal, their rows are compared together.
    """

    def fit(group: pa.Table) -> pa.Table:
        code, count = group["code"][0].as_py(), group["count"][0].as_py()
        group = group.sort_by("rep")
        unit = matrix(group["v"], d)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        stop = max(24, int(leaf * min(1.0, len(unit) / count)))
        tree = Tree(unit, stop, spill, np.random.default_rng([seed, code >> 32, code & 0xFFFFFFFF]))
        return pa.table({"code": pa.array([code]), "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    def split(rows: pa.Table, trees: pa.Table) -> pa.Table:
        if not rows.num_rows or not trees.num_rows:
            return pa.table({"rep": pa.array([], pa.int64()), "code": pa.array([], pa.int64()), "new": pa.array([], pa.int64())})
        unit = matrix(rows["v"], d)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        who, leaves = pickle.loads(trees["tree"][0].as_py()).route(unit)
        code = rows["code"][0].as_py()
        below = mix(np.full(len(leaves), code, np.uint64) ^ mix(leaves.astype(np.uint64) + np.uint64(1))) & np.uint64(0x7FFFFFFF)
        new = (code >> 32 << 32) + (below | np.uint64(0x80000000)).astype(np.int64)
        return pa.table({"rep": rows["rep"].to_numpy()[who], "code": np.full(len(who), code), "new": new})

    for _ in range(_LEVELS):
        sizes = routed.select(F.explode("leaves").alias("code")).groupBy("code").agg(F.count(F.lit(1)).alias("count"))
        big = cut(sizes.where(F.col("count") > most_rows))
        if big.isEmpty():
            break
        held = routed.select("rep", F.explode("leaves").alias("code")).join(big, "code").join(classes.select("rep", "v"), "rep")
        some = F.pmod(F.xxhash64("rep", "code"), F.lit(1 << 30)) < F.least(F.lit(1.0), F.lit(float(SPLIT_ROWS)) / F.col("count")) * (1 << 30)
        trees = cut(held.where(some).groupBy("code").applyInArrow(fit, "code long, tree binary"))
        tasks = F.ceil(F.col("count") / _ROUTED).cast("int")
        rows = held.select("code", F.pmod(F.xxhash64("rep"), tasks).cast("int").alias("salt"), "rep", "v")
        given = trees.join(big, "code").select("code", F.explode(F.sequence(F.lit(0), tasks - 1)).alias("salt"), "tree")
        moved = rows.groupBy("code", "salt").cogroup(given.groupBy("code", "salt")).applyInArrow(split, "rep long, code long, new long")
        moved = moved.groupBy("rep").agg(F.collect_set("code").alias("old"), F.collect_set("new").alias("new"))  # a row is in few leaves
        leaves = F.when(F.col("new").isNull(), F.col("leaves")).otherwise(F.array_sort(F.concat(F.array_except("leaves", "old"), F.col("new"))))
        routed = cut(routed.join(moved, "rep", "left").select("rep", leaves.alias("leaves")))
    return routed


def near_duplicates(
    table: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.9,
    trees: int = TREES,
    spill: float = SPILL,
    leaf: int = LEAF,
    sample_rows: int = SAMPLE_ROWS,
    most_rows: int = MOST_ROWS,
    seed: int = 7,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept (see the module for edge cases)."""
    everyone = table.select(F.col(vec_id).cast("long").alias("vec_id")).where("vec_id IS NOT NULL").groupBy("vec_id").agg(F.count(F.lit(1)).alias("times"))
    rows = rows_of(table, vec_id, vector)
    linked = table.sparkSession.createDataFrame([], "vec_id long, n_links long, component_id long")
    for d in lengths(rows):
        own = rows.where(F.size("v") == d)
        linked = linked.unionByName(own.join(_of_length(own, d, threshold, trees, spill, leaf, sample_rows, most_rows, seed), "v").drop("v"))
    linked = linked.groupBy("vec_id").agg(F.max("n_links").alias("n_links"), F.min("component_id").alias("component_id"))
    out = everyone.join(linked, "vec_id", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id")
    )
    return out.withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _of_length(rows: DataFrame, d: int, threshold: float, trees: int, spill: float, leaf: int, sample_rows: int, most_rows: int, seed: int) -> DataFrame:
    """(v, n_links, component_id) of each class of equal vectors, all of d components."""
    classes = cut(rows.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("n")))
    n_classes = classes.count()
    sample_rows = min(sample_rows, max(1024, SAMPLE_BYTES // (8 * d)))
    rate = min(1.0, sample_rows / n_classes)
    spread = F.pmod(F.xxhash64("rep", F.lit(seed)), F.lit(1 << 30)) < int(rate * (1 << 30)) + 1
    sample = matrix(classes.where(spread).select("v").limit(2 * sample_rows).toArrow()["v"], d)
    sample /= np.linalg.norm(sample, axis=1, keepdims=True)
    rng = np.random.default_rng(seed)
    stop = max(24, int(leaf * rate))
    leaders, sample = _leaders(sample, threshold, max(8, stop // 3))
    forest = [Tree(sample, stop, spill, rng) for _ in range(trees)]
    shared = rows.sparkSession.sparkContext.broadcast(forest)  # at most trees x 2 sample_rows / 12 directions

    def route(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                unit = matrix(part.column(0), d)
                unit /= np.linalg.norm(unit, axis=1, keepdims=True)
                routed = [tree.route(unit) for tree in shared.value]
                who = np.concatenate([r for r, _ in routed])
                code = np.concatenate([leaves.astype(np.int64) + (t << 32) for t, (_, leaves) in enumerate(routed)])
                order = np.lexsort((code, who))
                bounds = np.searchsorted(who[order], np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(1), pa.ListArray.from_arrays(pa.array(bounds), pa.array(code[order]))], ["rep", "leaves"])

    def compare(group: pa.Table) -> pa.Table:
        code = group["leaf"][0].as_py()
        tree, own = code >> 32, code & 0xFFFFFFFF
        group = group.sort_by("rep")
        rep, n = group["rep"].to_numpy(), group["n"].to_numpy()
        unit = matrix(group["v"], d)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        m = len(rep)
        leaves = group["leaves"].to_pylist()
        lists = []
        for t in range(tree + 1):
            each = [[x & 0xFFFFFFFF for x in ls if x >> 32 == t] for ls in leaves]
            width = max(map(len, each))
            lists.append(np.array([e + [-1] * (width - len(e)) for e in each], np.int64).reshape(m, width))
        links = np.zeros(m, np.int64)
        root = np.arange(m)
        for a in range(0, m, _BLOCK):
            for b in range(a, m, _BLOCK):
                i, j = np.nonzero(unit[a : a + _BLOCK] @ unit[b : b + _BLOCK].T >= threshold)
                i, j = i + a, j + b
                i, j = i[i < j], j[i < j]
                for c in range(0, len(i), 200_000):
                    x, y = i[c : c + 200_000], j[c : c + 200_000]
                    first = _first_meeting(lists, x, y, tree, own)
                    links += np.bincount(x[first], weights=n[y[first]], minlength=m).astype(np.int64) + np.bincount(y[first], weights=n[x[first]], minlength=m).astype(np.int64)
                    root = _unite(root, x, y)
        seen = (links > 0) | (root != np.arange(m))
        return pa.table({"rep": rep[seen], "links": links[seen], "hub": rep[root[seen]]})

    classes = classes.select("v", "rep", "n")
    dense, homeless = _in_cells(classes, leaders, d, threshold) if len(leaders) else (None, classes)
    homeless = homeless.select("v", "rep", "n")
    routed = _grown(homeless, cut(homeless.mapInArrow(route, "rep long, leaves array<long>")), d, leaf, spill, most_rows, seed)
    dealt = homeless.join(routed, "rep").select(F.explode("leaves").alias("leaf"), "rep", "n", "v", "leaves")
    found = dealt.groupBy("leaf").applyInArrow(compare, _FOUND)
    found = cut(found.unionByName(dense) if dense is not None else found)
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    united = components(found.select(F.col("rep").alias("a"), F.col("hub").alias("b")))
    return (
        classes.join(links, "rep", "left")
        .join(united.select(F.col("node").alias("rep"), F.col("component")), "rep", "left")
        .select("v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )


def query(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


ORACLE = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE embedding IS NOT NULL
), u AS (
  SELECT vec_id, e FROM v WHERE sqrt(list_dot_product(e, e)) > 0 AND isfinite(list_dot_product(e, e)) AND list_count(e) = len(e)
), link AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.vec_id <> b.vec_id
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= 0.9
), reach AS (
  WITH RECURSIVE r(x, y) AS (SELECT vec_id, vec_id FROM u UNION SELECT r.x, link.y FROM r JOIN link ON r.y = link.x)
  SELECT x, min(y) AS c FROM r GROUP BY x
), n AS (SELECT x, count(*) AS k FROM link GROUP BY x)
SELECT e.vec_id, CAST(coalesce(n.k, 0) AS BIGINT) AS n_links, coalesce(r.c, e.vec_id) AS component_id,
       coalesce(r.c, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN n ON n.x = e.vec_id LEFT JOIN reach r ON r.x = e.vec_id
"""
