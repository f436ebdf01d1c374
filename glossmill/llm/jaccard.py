"""Operator 4: n-gram Jaccard join by prefix trees.

1. Shingles of all documents are counted in a table of fixed size. Counts give every shingle its
   place in one global order, rare before frequent: sets become ordered sequences. (Any order
   gives the same links; a good one keeps common lines out of prefixes.)
2. Documents of equal sets are one class. A class sends the first n - ceil(t n) + 1 members of its
   sequence to buckets, and learns which of them other classes of a fitting size sent too: two
   sets of similarity t must share one. For those it sends a parity signature of its whole set.
   Signatures differ in no more bits than sets differ in members, so pairs whose signatures lie
   too far apart are no links; what remains chains into clusters, which no link crosses. Buckets
   answer with edges that span their part of a cluster, never with pairs. The list of a token that more
   than LIST_CLASSES classes sent is cut into parts, which meet each other in tasks of their own.
3. The sets of a cluster meet in blocks of bounded size (by size class where a cluster is larger
   than a block). A block stores its sequences in a trie; each set walks it, carrying the overlap
   that a path shares, and leaves a subtree once the members left cannot reach the threshold.
   Overlaps are counted exactly. Sets that links have joined already are not compared again, as
   the result is components.

Edge cases: null, empty and blank texts have no set: n_shingles 0, linked with nothing. A text with
fewer words than a shingle is one shingle. A null doc_id keeps its row and gets a null component.
Rows that share an id count as one document: their links are joined. An empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glossmill.llm.bytewords import Block, mix, slices, window_hashes
from glossmill.llm.components import components
from glossmill.llm.frames import IdFilter, cut, pieces

COUNTERS = 1 << 19
BLOCK_SETS = 1500
BLOCK_SHINGLES = 3_000_000
LIST_CLASSES = 8192
_SALTS = 64


def _shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Hash and document of every shingle, documents in order, and how many documents."""
    block = Block.of(texts, lower=True)
    at, hashes = block.windows(k)
    doc = block.doc_of_word()[at]
    for n in range(1, k):
        short = np.flatnonzero(block.n_words == n)
        if len(short):
            doc = np.r_[doc, short]
            hashes = np.r_[hashes, window_hashes(block.hashes(), block.word_bounds[:-1][short], n)]
    return hashes, doc, block.n_docs


def _sequences(texts: pa.Array, k: int, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ordered distinct keys of all documents end to end, and where each document's begin."""
    hashes, doc, n_docs = _shingles(texts, k)
    often = np.frexp(counts[(hashes & np.uint64(len(counts) - 1)).astype(np.int64)].astype(np.float64))[1].astype(np.uint64)
    keys = (often << np.uint64(58)) | (mix(hashes) >> np.uint64(6))
    order = np.lexsort((keys, doc))
    keys, doc = keys[order], doc[order]
    new = np.r_[True, (keys[1:] != keys[:-1]) | (doc[1:] != doc[:-1])] if len(keys) else np.zeros(0, bool)
    keys, doc = keys[new], doc[new]
    return keys, np.searchsorted(doc, np.arange(n_docs + 1))


def _fingerprints(keys: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit sums over each set, whatever its order."""
    return tuple(
        np.diff(np.r_[np.uint64(0), np.cumsum(mix(keys ^ np.uint64(salt)), dtype=np.uint64)][bounds]).view(np.int64)
        for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)
    )


def _width(n: int) -> int:
    """Bits of a signature of n members: a power of two, so that a wide one folds to a narrow one."""
    return 1 << max(8, (2 * max(n, 1) - 1).bit_length())


def _signature(keys: np.ndarray, width: int) -> np.ndarray:
    """The parity of how many members fall on each bit."""
    return np.packbits(np.bincount((keys & np.uint64(width - 1)).astype(np.int64), minlength=width) & 1).view(np.uint64)


def _apart(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """In how many bits signatures differ at least, after folding the wider ones."""
    while many.shape[1] > len(one):
        many = many[:, : many.shape[1] // 2] ^ many[:, many.shape[1] // 2 :]
    return np.bitwise_count(many ^ one).sum(axis=1, dtype=np.int64)


def _count(docs: DataFrame, k: int) -> np.ndarray:
    """How often shingles fall on each of COUNTERS counters, over all documents."""

    def run(batches):
        counts = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for part in slices(batch, 1, 2 << 20):
                hashes, _, _ = _shingles(part.column(1), k)
                counts += np.bincount((hashes & np.uint64(COUNTERS - 1)).astype(np.int64), minlength=COUNTERS)
        parts = counts.reshape(32, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(32), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c, np.int64) for c in group["counts"].to_pylist())
        return pa.table({"part": pa.array([group["part"][0].as_py()], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "part int, counts binary"
    rows = docs.mapInArrow(run, schema).groupBy("part").applyInArrow(add, schema).collect()  # 4 MB whatever the input
    counts = np.zeros((32, COUNTERS // 32), np.int64)
    for r in rows:
        counts[r["part"]] = np.frombuffer(r["counts"], np.int64)
    return counts.ravel()


class Trie:
    """Ordered sequences of a block. A node spans places start..end of the rows lo..hi."""

    def __init__(self, rows: list[np.ndarray]) -> None:
        self.rows = rows
        self.sizes = np.array([len(r) for r in rows])
        common = np.zeros(len(rows), np.int64)  # places shared with the row before
        for i in range(1, len(rows)):
            n = min(len(rows[i - 1]), len(rows[i]))
            differ = rows[i - 1][:n] != rows[i][:n]
            at = int(differ.argmax()) if n else 0
            common[i] = at if n and differ[at] else n
        self.common = common

    def children(self, lo: int, hi: int, depth: int):
        """(lo, hi, depth up to which the rows agree) of the branches below ``depth``."""
        cuts = [lo, *(lo + 1 + np.flatnonzero(self.common[lo + 1 : hi] <= depth)).tolist(), hi]
        for a, b in zip(cuts, cuts[1:]):
            yield a, b, int(self.common[a + 1 : b].min()) if b - a > 1 else len(self.rows[a])


def _link_block(keys: list[np.ndarray], side: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Order and root of each set in a block, after joining all pairs of similarity num / den.

    side: 0 and 1 in a block of two parts, whose pairs inside a part are other blocks' work.
    """
    as_text = [k.astype(">u8").tobytes() for k in keys]
    order = np.array(sorted(range(len(keys)), key=as_text.__getitem__))
    flat = np.concatenate([keys[i] for i in order])
    _, dense = np.unique(flat, return_inverse=True)  # keeps the global order
    cuts = np.cumsum([0, *(len(keys[i]) for i in order)])
    rows = [dense[a:b] for a, b in zip(cuts, cuts[1:])]
    side = side[order]
    across = bool(side.any())
    trie = Trie(rows)
    sizes = trie.sizes
    m = len(rows)
    width = _width(int(sizes.max()))
    signature = np.array([_signature(keys[i], width) for i in order])
    root = np.arange(m)
    member = np.zeros(len(flat) + 1, bool)
    for a in range(1 if not across else 0, m):
        fits = (sizes * den >= num * sizes[a]) & (sizes[a] * den >= num * sizes) & (root != root[a])
        fits &= (side != side[a]) if across else (np.arange(m) < a)
        if across and side[a]:
            continue
        at = np.flatnonzero(fits)
        if not len(at):
            continue
        apart = _apart(signature[a], signature[at])
        at = at[apart * (num + den) <= (den - num) * (sizes[at] + sizes[a])]
        if not len(at):
            continue
        alive = np.zeros(m + 1, np.int64)
        alive[at + 1] = 1
        alive = np.cumsum(alive)
        own, n = rows[a], int(sizes[a])
        member[own] = True
        todo = [(lo, hi, 0, end, 0) for lo, hi, end in trie.children(0, m, 0)]
        while todo:
            lo, hi, depth, end, overlap = todo.pop()
            if alive[hi] == alive[lo] or (hi - lo == 1 and root[lo] == root[a]):
                continue
            small, large = int(sizes[lo:hi].min()), int(sizes[lo:hi].max())
            need = -(-num * (n + small) // (num + den))
            path = rows[lo]
            while depth < end:
                stop = min(end, depth + 128)
                overlap += int(np.count_nonzero(member[path[depth:stop]]))
                depth = stop
                left = n - int(np.searchsorted(own, path[depth - 1], side="right"))
                if overlap + min(left, large - depth) < need:
                    break
            else:
                if small == end and root[lo] != root[a] and alive[lo + 1] > alive[lo] and den * overlap >= num * (n + small - overlap):
                    x, y = sorted((root[a], root[lo]))
                    root[root == y] = x
                if hi - lo > 1:
                    # A row that ends here sorts first, and has been dealt with.
                    lo += int(sizes[lo] == end)
                    todo += [(c, d, depth, e, overlap) for c, d, e in trie.children(lo, hi, depth)] if lo < hi else []
        member[own] = False
    return order, root


def _chain_list(own: np.ndarray, side: np.ndarray, sizes: np.ndarray, marks: list[np.ndarray], root: np.ndarray, num: int, den: int) -> None:
    """Join in ``root`` the classes of one list, in order of size, that signatures don't tell apart.

    side: 0 and 1 in a list of two parts, whose pairs inside a part are other lists' work.
    """
    n = sizes[own]
    across = bool(side.any())
    for width in {len(marks[i]) for i in own}:
        low = np.flatnonzero([len(marks[i]) == width for i in own])
        reach = np.flatnonzero([width <= len(marks[i]) for i in own])
        table = np.array([np.bitwise_xor.reduce(marks[i].reshape(-1, width)) for i in own[reach]])
        for x in low.tolist():
            fits = (reach > x) & (n[x] * den >= num * n[reach]) & (root[own[reach]] != root[own[x]])
            if across:
                fits &= side[reach] != side[x]
            if not fits.any():
                continue
            at = np.flatnonzero(fits)
            apart = _apart(marks[own[x]], table[at])
            for y in own[reach[at[apart * (num + den) <= (den - num) * (n[x] + n[reach[at]])]]]:
                a, b = sorted((int(root[own[x]]), int(root[y])))
                if a != b:
                    root[root == b] = a


def similar_documents(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    words: int = 5,
    percent: int = 80,
    block_sets: int = BLOCK_SETS,
    block_shingles: int = BLOCK_SHINGLES,
    list_classes: int = LIST_CLASSES,
) -> DataFrame:
    """doc_id, n_shingles, component_id: documents whose shingle sets overlap by ``percent`` of
    their union are linked; component_id is the smallest doc_id that links reach."""
    num, den = percent // math.gcd(percent, 100), 100 // math.gcd(percent, 100)
    if not 0 < num <= den:
        raise ValueError("percent lies in 1..100")
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    counts = spark.sparkContext.broadcast(_count(docs, words))

    def profile(batches):
        for batch in batches:
            for part in slices(batch, 1, 2 << 20):
                keys, bounds = _sequences(part.column(1), words, counts.value)
                n = np.diff(bounds)
                s1, s2 = _fingerprints(keys, bounds)
                first = [keys[a : a + c - -(-num * c // den) + 1].tobytes() if c else b"" for a, c in zip(bounds.tolist(), n.tolist())]
                marks = [_signature(keys[a : a + c], _width(c)).tobytes() if c else b"" for a, c in zip(bounds.tolist(), n.tolist())]
                columns = [part.column(0), pa.array(n, pa.int64()), pa.array(s1), pa.array(s2), pa.array(first, pa.binary()), pa.array(marks, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "s1", "s2", "prefix", "marks"])

    profiles = cut(docs.mapInArrow(profile, "doc_id long, n long, s1 long, s2 long, prefix binary, marks binary"))
    # A class may be a third of all rows: its members are reduced to one row a salt, and meet it there.
    salted = profiles.select("doc_id", "n", "s1", "s2", F.pmod(F.xxhash64("doc_id"), F.lit(_SALTS)).cast("int").alias("salt"))
    by_salt = salted.where("n > 0 AND doc_id IS NOT NULL").groupBy("s1", "s2", "n", "salt").agg(F.min("doc_id").alias("rep"))
    classes = by_salt.groupBy("s1", "s2", "n").agg(F.min("rep").alias("rep"))
    # Sets whose sizes admit no other size but their own can only equal each other, as classes do.
    grows = (F.floor(F.col("n") * den / num) > F.col("n")) | (F.ceil(F.col("n") * num / den) < F.col("n"))
    chosen = classes.where(grows).select("s1", "s2", F.col("rep").alias("doc_id"))
    size = profiles.agg(F.coalesce(F.sum(F.length("prefix")), F.lit(0)).alias("prefix"), F.coalesce(F.sum(F.length("marks")), F.lit(0)).alias("marks")).first()
    n_chunks, n_buckets = pieces(size["prefix"] + size["marks"], 2 << 20), pieces(2 * size["prefix"], 16 << 20, 48)
    heads = profiles.join(chosen, ["doc_id", "s1", "s2"]).withColumn("chunk", F.pmod(F.xxhash64("doc_id", "s1"), F.lit(n_chunks)).cast("int"))
    heads = heads.select("chunk", "doc_id", "n", "s1", "prefix", "marks").repartition("chunk")

    def postings(group: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """A chunk's classes in order, and its postings bucket by bucket: token and class."""
        group = group.sort_by([("doc_id", "ascending"), ("s1", "ascending")])
        same = np.r_[False, (np.diff(group["doc_id"].to_numpy()) == 0) & (np.diff(group["s1"].to_numpy()) == 0)] if group.num_rows > 1 else np.zeros(group.num_rows, bool)
        group = group.filter(pa.array(~same))
        first = group["prefix"].to_pylist()
        tokens = np.frombuffer(b"".join(first), np.uint64)
        which = np.repeat(np.arange(len(first)), [len(f) // 8 for f in first])
        bucket = ((mix(tokens) >> np.uint64(33)) % np.uint64(n_buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cuts = np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        return group, tokens[order], which[order], cuts, np.flatnonzero(np.diff(cuts))

    def ask(group: pa.Table) -> pa.Table:
        chunk = group["chunk"][0].as_py()
        group, tokens, which, cuts, used = postings(group)
        sizes = group["n"].to_numpy().astype(np.int32)[which]
        columns = [pa.array([x[cuts[b] : cuts[b + 1]].tobytes() for b in used], pa.binary()) for x in (tokens, sizes)]
        return pa.table([pa.array([chunk] * len(used), pa.int32()), pa.array(used, pa.int32()), *columns], ["chunk", "bucket", "tokens", "sizes"])

    def tell(group: pa.Table) -> pa.Table:
        """Which postings have another of a fitting size next to them in their token's list; the tokens whose
        lists are long, and the parts that each is cut into."""
        rows = group["tokens"].to_pylist()
        ends = np.cumsum([0, *(len(r) // 8 for r in rows)])
        tokens, sizes = np.frombuffer(b"".join(rows), np.uint64), np.frombuffer(b"".join(group["sizes"].to_pylist()), np.int32).astype(np.int64)
        order = np.lexsort((sizes, tokens))
        near = (tokens[order][1:] == tokens[order][:-1]) & (sizes[order][:-1] * den >= num * sizes[order][1:])
        met = np.zeros(len(tokens), bool)
        met[order[1:]] |= near
        met[order[:-1]] |= near
        bits = [np.packbits(met[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
        listed, length = np.unique(tokens[met], return_counts=True)
        long = listed[length > list_classes]
        parts = -(-length[length > list_classes] // list_classes)
        own = [np.isin(long, tokens[a:b]) if len(long) else np.zeros(0, bool) for a, b in zip(ends, ends[1:])]
        columns = [pa.array(bits, pa.binary()), pa.array([long[o].tobytes() for o in own], pa.binary()), pa.array([parts[o].astype(np.int32).tobytes() for o in own], pa.binary())]
        return pa.table([group["chunk"], group["bucket"], *columns], ["chunk", "bucket", "bits", "long", "parts"])

    def offer(group: pa.Table, told: pa.Table) -> pa.Table:
        """A chunk's postings that met others. Those of a long list are dealt to its parts by class, and each
        part goes to the tasks in which it meets itself and every other part."""
        out: list[tuple] = []
        if group.num_rows and told.num_rows:
            group, tokens, which, cuts, _ = postings(group)
            reps, sizes, marks = group["doc_id"].to_numpy(), group["n"].to_numpy(), group["marks"].to_pylist()

            def send(bucket: int, at: np.ndarray, *task: int) -> None:
                classes, own = np.unique(which[at], return_inverse=True)
                out.append((bucket, *task, tokens[at].tobytes(), own.astype(np.int32).tobytes(), reps[classes].tobytes(), sizes[classes].tobytes(), b"".join(marks[c] for c in classes)))

            for b, bits, long, parts in zip(*(told[c].to_pylist() for c in ("bucket", "bits", "long", "parts"))):
                at = cuts[b] + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=cuts[b + 1] - cuts[b]))
                long, parts = np.frombuffer(long, np.uint64), np.frombuffer(parts, np.int32)
                whole = at[~np.isin(tokens[at], long)] if len(long) else at
                if len(whole):
                    send(b, whole, 0, -1, -1, 0)
                for token, k in zip(long, parts.tolist()):
                    mine = at[tokens[at] == token]
                    part = (mix(reps[which[mine]].astype(np.uint64)) % np.uint64(k)).astype(np.int64)
                    for i in np.unique(part).tolist():
                        for j in range(k):
                            send(b, mine[part == i], int(token.astype(np.int64)), min(i, j), max(i, j), int(i > j))
        columns = list(zip(*out)) or [()] * 10
        kinds = [pa.int32(), pa.int64(), *[pa.int32()] * 3, *[pa.binary()] * 5]
        return pa.table([pa.array(c, kind) for c, kind in zip(columns, kinds)], ["bucket", "token", "x", "y", "side", "tokens", "own", "reps", "sizes", "marks"])

    def chain(group: pa.Table) -> pa.Table:
        tokens, own, side, reps, sizes, marks, seen = [], [], [], [], [], [], 0
        for part, t, o, r, n, m in zip(*(group[c].to_pylist() for c in ("side", "tokens", "own", "reps", "sizes", "marks"))):
            tokens.append(np.frombuffer(t, np.uint64))
            own.append(np.frombuffer(o, np.int32).astype(np.int64) + seen)
            side.append(np.full(len(own[-1]), part, np.int8))
            reps.append(np.frombuffer(r, np.int64))
            sizes.append(np.frombuffer(n, np.int64))
            at = 0
            for k in sizes[-1].tolist():
                marks.append(np.frombuffer(m, np.uint64, _width(k) // 64, at))
                at += _width(k) // 8
            seen += len(reps[-1])
        tokens, own, side, reps, sizes = (np.concatenate(x) for x in (tokens, own, side, reps, sizes))
        order = np.lexsort((reps[own], sizes[own], tokens))
        tokens, own, side = tokens[order], own[order], side[order]
        root = np.arange(len(reps))
        cuts = np.r_[0, np.flatnonzero(tokens[1:] != tokens[:-1]) + 1, len(tokens)]
        for a, b in zip(cuts.tolist(), cuts[1:].tolist()):
            if b - a > 1:
                _chain_list(own[a:b], side[a:b], sizes, marks, root, num, den)
        nodes = reps[root]
        apart = nodes != reps
        return pa.table({"a": reps[apart], "b": nodes[apart]})

    asked = heads.groupBy("chunk").applyInArrow(ask, "chunk int, bucket int, tokens binary, sizes binary")
    told = asked.groupBy("bucket").applyInArrow(tell, "chunk int, bucket int, bits binary, long binary, parts binary")
    sent = "bucket int, token long, x int, y int, side int, tokens binary, own binary, reps binary, sizes binary, marks binary"
    offered = heads.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(offer, sent)
    edges = offered.groupBy("bucket", "token", "x", "y").applyInArrow(chain, "a long, b long")
    clusters = components(edges).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))
    members = cut(profiles.select("doc_id", "n", "s1", "s2").join(chosen, ["doc_id", "s1", "s2"]).distinct().join(clusters, "doc_id"))
    linked = components(_linked(docs, members, counts, words, num, den, block_sets, block_shingles))

    # Classes find their component before their members find them, so that no key holds more than a salt's share of rows.
    placed = classes.join(linked.select(F.col("node").alias("rep"), "component"), "rep", "left")
    of_salt = by_salt.drop("rep").join(placed, ["s1", "s2", "n"])
    keyed = salted.join(of_salt, ["s1", "s2", "n", "salt"], "left")
    joined = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id"))
    return keyed.select("doc_id", F.col("n").alias("n_shingles"), joined.alias("component_id"))


def _linked(docs: DataFrame, members: DataFrame, counts, words: int, num: int, den: int, block_sets: int, block_shingles: int) -> DataFrame:
    """Edges (a, b) that span the links inside each cluster."""

    def sets(batches):
        for batch in batches:
            for part in slices(batch, 1, 2 << 20):
                keys, bounds = _sequences(part.column(1), words, counts.value)
                s1, _ = _fingerprints(keys, bounds)
                same = np.flatnonzero(s1 == part.column(2).to_numpy())
                taken = part.take(pa.array(same))
                each = [keys[bounds[i] : bounds[i + 1]].tobytes() for i in same]
                yield pa.RecordBatch.from_arrays([taken.column(0), pa.array(each, pa.binary()), *taken.columns[3:]], ["rep", "keys", "cluster", "tasks"])

    def share(kind: str, at) -> F.Column:
        whole = F.ceil(F.greatest(F.col(f"{kind}_sets") / block_sets, F.col(f"{kind}_shingles") / block_shingles)).cast("int")
        return F.coalesce(whole, F.lit(0))

    # Sizes that fit each other lie in the same size class or in neighbouring ones.
    step = math.log(den / num) if num < den else 1.0
    sized = members.withColumn("size_class", F.floor(F.log("n") * (1 - 1e-9) / step).cast("int"))
    per_class = sized.groupBy("cluster", "size_class").agg(F.count(F.lit(1)).alias("own_sets"), F.sum("n").alias("own_shingles"))
    per_cluster = per_class.groupBy("cluster").agg(F.sum("own_sets").alias("all_sets"), F.sum("own_shingles").alias("all_shingles"))
    below = per_class.select("cluster", (F.col("size_class") + 1).alias("size_class"), F.col("own_sets").alias("below_sets"), F.col("own_shingles").alias("below_shingles"))
    above = per_class.select("cluster", (F.col("size_class") - 1).alias("size_class"), F.col("own_sets").alias("above_sets"), F.col("own_shingles").alias("above_shingles"))
    dealt = cut(per_class.join(per_cluster, "cluster").join(below, ["cluster", "size_class"], "left").join(above, ["cluster", "size_class"], "left"))
    placed = sized.join(dealt, ["cluster", "size_class"])
    own, low, high = share("own", 0), share("below", 0), share("above", 0)
    salt = F.pmod(F.xxhash64("doc_id"), own).cast("int")

    def task(class_a, salt_a, class_b, salt_b, side) -> F.Column:
        return F.struct(class_a.cast("int").alias("x1"), salt_a.cast("int").alias("x2"), class_b.cast("int").alias("y1"), salt_b.cast("int").alias("y2"), side.cast("int").alias("side"))

    def upto(n) -> F.Column:
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    c, s, zero = F.col("size_class"), F.col("salt"), F.lit(0)
    inside = F.transform(upto(F.col("k_own")), lambda j: task(c, F.least(s, j), c, F.greatest(s, j), (s > j)))
    upward = F.transform(upto(F.col("k_high")), lambda j: task(c, s, c + 1, j, zero))
    downward = F.transform(upto(F.col("k_low")), lambda j: task(c - 1, j, c, s, F.lit(1)))
    small = (F.col("all_sets") <= block_sets) & (F.col("all_shingles") <= block_shingles)
    tasks = F.when(small, F.array(task(zero, zero, zero, zero, zero))).otherwise(F.concat(inside, upward, downward))
    placed = placed.select("doc_id", "s1", "cluster", "size_class", "all_sets", "all_shingles", own.alias("k_own"), low.alias("k_low"), high.alias("k_high"), salt.alias("salt"))
    placed = placed.select("doc_id", "s1", "cluster", tasks.alias("tasks"))

    kind = "array<struct<x1:int,x2:int,y1:int,y2:int,side:int>>"
    # Few documents lie in clusters: only their texts are shuffled.
    met = IdFilter(members, "doc_id").passing(docs).join(placed, "doc_id").select("doc_id", "text", "s1", "cluster", "tasks")
    met = met.mapInArrow(sets, f"rep long, keys binary, cluster long, tasks {kind}").select("rep", "keys", "cluster", F.explode("tasks").alias("t"))
    met = met.select("rep", "keys", "cluster", "t.x1", "t.x2", "t.y1", "t.y2", "t.side")

    def join(group: pa.Table) -> pa.Table:
        group = group.sort_by("rep")
        reps = group["rep"].to_numpy()
        keys = [np.frombuffer(k, np.uint64) for k in group["keys"].to_pylist()]
        if len(keys) < 2:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        order, root = _link_block(keys, group["side"].to_numpy(), num, den)
        own = root != np.arange(len(root))
        return pa.table({"a": reps[order][own], "b": reps[order][root[own]]})

    return met.groupBy("cluster", "x1", "x2", "y1", "y2").applyInArrow(join, "a long, b long")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return similar_documents(docs, words=3, percent=90)


ORACLE = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(words) < 3 THEN array_to_string(words, ' ') ELSE array_to_string(words[i:i + 2], ' ') END AS sh
  FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 1, 2))) AS i FROM w WHERE len(words) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2
), link AS (
  SELECT x, y FROM common JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * k >= 90 * (p.n + q.n - k)
), reach AS (
  WITH RECURSIVE r(x, y) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.x, link.y FROM r JOIN link ON r.y = link.x)
  SELECT x, min(y) AS c FROM r GROUP BY x
)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, coalesce(reach.c, w.doc_id) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN reach ON reach.x = w.doc_id
"""
