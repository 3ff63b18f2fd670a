"""Approximate nearest neighbours: a hierarchical k-means tree with best-bin-first traversal.

The tree is fitted on a sample of at most `sample` vectors (documented bound; the first in the order of a hash of the id) and
broadcast; every row is then indexed: it goes down to the nearest centre of each level into a leaf.  A query opens leaves by a
priority queue over the distances to centres met so far.  How many leaves it opens is calibrated: on queries drawn from the
sample, against brute force over the sample, leaf visits are widened until the recall of the k nearest reaches `recall`.

A sample can't split leaves that hold few of its vectors, so leaves that turn out too large once all rows are placed are split
again: each by k-means over a bounded draw of its own rows, in one task a leaf, until none is (or its vectors are all alike).

Queries meet the rows of their leaves in blocks: neighbouring leaves form groups (four leaves each, once there are over 128
leaves), a group's rows and queries are dealt into chunks, a task multiplies, leaf by leaf, one chunk of rows with one chunk of
queries and keeps k for each query, with exact cosines in double precision; the best of all blocks are the result.  A leaf that a
third of all rows fall into is many chunks.

Scale: leaves hold at most about 8 * sqrt(rows) rows and the broadcast tree about sqrt(rows) centres, so a query's k results of
each leaf it opens grow slower than the rows; a row is sent once for each chunk of its group's queries, a query once for each
chunk of rows in the groups it opens.

Cases: vectors that are null, zero or hold null or non-finite components, vectors of another length than most of the sample,
and rows with a null id take no part, as candidates or queries.  Ties go to the smaller id; repeated ids are candidates each,
and none for the query of their own id.  With fewer than k candidates all found are returned.  An empty table gives an empty
result.  Other columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, vectors


class Tree:
    """Nodes in arrays: centre, first child and number of children (0: a leaf, numbered in `leaf`)."""

    def __init__(self, unit: np.ndarray, rows: int, branch: int = 8, leaf_rows: int = 512, seed: int = 3):
        self.rng = np.random.default_rng(seed)
        self.branch = branch
        centres, first, many, leaf = [np.zeros(unit.shape[1])], [0], [0], [-1]
        queue = [(0, np.arange(len(unit)))]
        self.leaves = 0
        while queue:
            node, at = queue.pop()
            groups = []
            if len(at) * rows / max(1, len(unit)) > leaf_rows and len(at) >= 4 * branch:
                c, group = self._means(unit[at])
                groups = [(c[g], at[group == g]) for g in range(len(c)) if (group == g).any()]
            if len(groups) < 2:
                leaf[node] = self.leaves
                self.leaves += 1
                continue
            first[node], many[node] = len(centres), len(groups)
            for c, members in groups:
                queue.append((len(centres), members))
                centres.append(c)
                first.append(0)
                many.append(0)
                leaf.append(-1)
        self.centres, self.first, self.many, self.leaf = np.array(centres), np.array(first), np.array(many), np.array(leaf)

    def _means(self, m: np.ndarray, rounds: int = 12) -> tuple[np.ndarray, np.ndarray]:
        c = m[self.rng.choice(len(m), self.branch, replace=False)]
        group = np.zeros(len(m), np.int64)
        for _ in range(rounds):
            new = self._nearest(m, c)
            if (new == group).all() and _:
                break
            group = new
            c = np.array([m[group == g].mean(0) if (group == g).any() else m[self.rng.integers(len(m))] for g in range(len(c))])
        return c, self._nearest(m, c)

    def split(self, centres: dict[int, np.ndarray]) -> None:
        """Gives the leaves named the centres as children."""
        node_of = {int(n): i for i, n in enumerate(self.leaf.tolist()) if n >= 0}
        new, at = [self.centres], len(self.first)
        for leaf, c in sorted(centres.items()):
            node = node_of[leaf]
            self.first[node], self.many[node], self.leaf[node] = at, len(c), -1
            numbers = [leaf, *range(self.leaves, self.leaves + len(c) - 1)]
            new.append(c)
            self.first = np.append(self.first, np.zeros(len(c), np.int64))
            self.many = np.append(self.many, np.zeros(len(c), np.int64))
            self.leaf = np.append(self.leaf, numbers)
            self.leaves, at = self.leaves + len(c) - 1, at + len(c)
        self.centres = np.concatenate(new)
        # leaves are numbered anew in the order of the tree, so that neighbours have neighbouring numbers
        order, stack = [], [0]
        while stack:
            n = stack.pop()
            if self.many[n]:
                stack += range(int(self.first[n] + self.many[n]) - 1, int(self.first[n]) - 1, -1)
            else:
                order.append(n)
        self.leaf[np.array(order)] = np.arange(len(order))

    @staticmethod
    def _nearest(m: np.ndarray, c: np.ndarray) -> np.ndarray:
        return ((c * c).sum(1)[None, :] - 2 * (m @ c.T)).argmin(1)

    def place(self, unit: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        node = np.zeros(len(unit), np.int64)
        while True:
            inner = np.flatnonzero(self.many[node] > 0)
            if not len(inner):
                return self.leaf[node]
            for n in np.unique(node[inner]).tolist():
                at = inner[node[inner] == n]
                a = self.first[n]
                node[at] = a + self._nearest(unit[at], self.centres[a : a + self.many[n]])

    def open(self, q: np.ndarray) -> Iterator[int]:
        """Leaves in the order of a priority queue on distance to the centres."""
        heap, found = [(0.0, 0)], 0
        while heap:
            _, n = heapq.heappop(heap)
            while self.many[n]:
                a, b = self.first[n], self.first[n] + self.many[n]
                d = ((self.centres[a:b] - q) ** 2).sum(1)
                best = int(d.argmin())
                for i in range(b - a):
                    if i != best:
                        heapq.heappush(heap, (float(d[i]), int(a + i)))
                n = int(a + best)
            found += 1
            yield int(self.leaf[n])


def calibrate(tree: Tree, unit: np.ndarray, k: int, recall: float, queries: int = 256) -> tuple[int, float]:
    """(leaves to open, recall reached over the sample)."""
    at = np.linspace(0, len(unit) - 1, min(queries, len(unit))).astype(int)
    k = min(k, len(unit) - 1)
    if k < 1:
        return tree.leaves, 1.0
    leaf = tree.place(unit)
    near = unit[at] @ unit.T
    near[np.arange(len(at)), at] = -2
    kth = np.partition(near, -k, axis=1)[:, -k]
    order = [list(tree.open(unit[i])) for i in at]
    rank = np.empty((len(at), tree.leaves), np.int64)
    for i, o in enumerate(order):
        rank[i, o] = np.arange(len(o))
    true = near >= kth[:, None] - 1e-12
    need = np.sort(np.concatenate([np.sort(rank[i, leaf[true[i]]])[:k] for i in range(len(at))]))  # leaves to open for each hit
    visits = 1
    while (reached := np.searchsorted(need, visits - 1, side="right") / len(need)) < recall and visits < tree.leaves:
        visits = min(tree.leaves, visits + max(1, visits // 8))
    return visits, float(reached)


def sub_centres(branch: int):
    """(leaf, centres) of a leaf's drawn rows: k-means as in the tree; none if they can't be told apart."""

    def run(table):
        import pyarrow as pa

        unit = vectors.unit(vectors.matrix(table.column("vector").combine_chunks()))
        tree = Tree(unit, len(unit), branch, max(1, len(unit) // 2))
        kids = tree.centres[tree.first[0] : tree.first[0] + tree.many[0]]
        return pa.table({"leaf": pa.array([table.column("leaf")[0].as_py()] * len(kids), pa.int64()), "centre": pa.array(kids.tolist(), pa.list_(pa.float64()))})

    return run


def block(k: int):
    """For each query of a chunk the k nearest among a chunk's rows that lie in the leaves it opens."""

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks()
        query = np.asarray(table.column("query").to_numpy(zero_copy_only=False), bool)
        ids = table.column("id").to_numpy()
        m = np.stack(table.column("vector").to_numpy(zero_copy_only=False)).astype(np.float64)
        m = m / np.abs(m).max(1, keepdims=True)
        size = np.sqrt((m * m).sum(1))
        at, rows = np.flatnonzero(query), np.flatnonzero(~query)
        leaf = table.column("leaf").to_numpy()
        rows = rows[np.argsort(leaf[rows], kind="stable")]
        base, own = m[rows] / size[rows, None], leaf[rows]
        best: dict[int, list[tuple[float, int]]] = {}
        for n in np.unique(leaf[at]).tolist():
            lo, hi = np.searchsorted(own, n), np.searchsorted(own, n, side="right")
            asked = at[leaf[at] == n]
            for a in range(0, len(asked) if hi > lo else 0, 256):
                some = asked[a : a + 256]
                near = (m[some] / size[some, None]) @ base[lo:hi].T
                near[ids[some][:, None] == ids[rows[lo:hi]][None, :]] = -2
                kth = np.partition(near, -k, axis=1)[:, -k] if hi - lo > k else np.full(len(some), -1.5)
                for i, q in enumerate(some.tolist()):
                    c = rows[lo:hi][near[i] >= max(kth[i] - 1e-9, -1.5)]
                    score = (m[c] * m[q]).sum(1) / (size[c] * size[q])  # row by row, so equal vectors get equal scores
                    top = np.lexsort((ids[c], -score))[:k]
                    best.setdefault(int(ids[q]), []).extend(zip((-score[top]).tolist(), ids[c][top].tolist(), strict=True))
        out = [(q, i, -s) for q, found in best.items() for s, i in sorted(found)[:k]]
        a, b, s = zip(*out, strict=True) if out else ((), (), ())
        return pa.table({"query_id": pa.array(a, pa.int64()), "vec_id": pa.array(b, pa.int64()), "score": pa.array(s, pa.float64())})

    return run


def search(df: DataFrame, is_query: F.Column, k: int = 5, recall: float = 0.97, sample: int = 20_000, leaf_rows: int | None = None, chunk: int = 4096, groups: int = 32, id_column: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score, sample_recall) of the k nearest found for each row that is_query picks; sample_recall is
    what the calibration reached over its sample."""
    spark = df.sparkSession
    scratch = common.Scratch(spark)
    rows = df.filter(vectors.usable(vector) & F.col(id_column).isNotNull()).select(F.col(id_column).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks"))
    drawn = rows.select("id", "vector").orderBy(F.xxhash64("id", F.lit(17)), "id").limit(sample).toPandas()  # at most `sample` vectors
    sizes = drawn["vector"].map(len)
    dim = int(sizes.mode()[0]) if len(sizes) else 1
    unit = vectors.unit(np.stack(drawn["vector"][sizes == dim].to_numpy())) if len(sizes) else np.zeros((0, dim))
    rows = rows.filter(F.size("vector") == dim)
    n = rows.count()
    most = leaf_rows or max(512, round(4 * n**0.5))
    tree = Tree(unit, n, leaf_rows=most)

    def placing(sent):
        def place(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for whole in batches:
                for b in common.batches(iter([whole]), 4096):
                    leaf = pa.array(sent.value.place(vectors.unit(vectors.matrix(b.column("vector")))), pa.int64())
                    yield pa.RecordBatch.from_arrays([b.column("id"), b.column("vector"), b.column("asks"), leaf], ["id", "vector", "asks", "leaf"])

        return place

    while True:
        sent = spark.sparkContext.broadcast(tree)
        placed = scratch.table(rows.mapInArrow(placing(sent), "id long, vector array<double>, asks boolean, leaf long"), "placed")
        held = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count("*").alias("n")).collect()}  # a row a leaf of the tree
        over = {leaf: c for leaf, c in held.items() if c > 2 * most}
        if not over:
            break
        share = F.create_map(*[F.lit(x) for leaf, c in over.items() for x in (leaf, int(2**30 * min(1.0, 1024 / c)))])
        drawn_here = placed.filter(F.col("leaf").isin(*over)).filter(F.pmod(F.xxhash64("id", F.lit(31)), F.lit(2**30)) < share[F.col("leaf")])
        found = drawn_here.select("leaf", "vector").groupBy("leaf").applyInArrow(sub_centres(8), "leaf long, centre array<double>")
        kids: dict[int, list] = {}
        for r in found.collect():  # at most 8 rows a leaf
            kids.setdefault(r["leaf"], []).append(r["centre"])
        kids = {leaf: np.array(c) for leaf, c in kids.items() if len(c) > 1}
        if not kids:
            break
        before = tree.leaves
        tree.split(kids)
        scratch.drop(placed)
        if tree.leaves == before:
            break
    visits, reached = calibrate(tree, unit, k, recall)
    groups = min(tree.leaves, max(groups, tree.leaves // 4))
    group = F.floor(F.col("leaf") * groups / F.lit(tree.leaves))  # neighbouring leaves of the tree

    def opened(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for whole in batches:
            for b in common.batches(iter([whole]), 512):
                ids, vs, leaves = [], [], []
                for i, u in enumerate(vectors.unit(vectors.matrix(b.column("vector")))):
                    seen = 0
                    for n, leaf in enumerate(sent.value.open(u)):
                        if n >= visits and seen > k:
                            break
                        seen += held.get(leaf, 0)
                        if leaf in held:
                            ids.append(i)
                            leaves.append(leaf)
                yield pa.RecordBatch.from_arrays([b.column("id").take(pa.array(ids, pa.int64())), b.column("vector").take(pa.array(ids, pa.int64())), pa.array(leaves, pa.int64())], ["id", "vector", "leaf"])

    asked = scratch.table(placed.filter("asks").select("id", "vector").mapInArrow(opened, "id long, vector array<double>, leaf long"), "asked")
    chunks = lambda df, name: df.groupBy(group.alias("g")).agg(F.ceil(F.count("*") / chunk).alias(name))
    parts = scratch.table(chunks(placed, "row_chunks").join(chunks(asked, "query_chunks"), "g"), "chunks")
    mine = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    known = F.broadcast(parts)  # a row a group
    left = placed.withColumn("g", group).join(known, "g").select("g", "leaf", "id", "vector", F.lit(False).alias("query"), mine("row_chunks").alias("r"), each("query_chunks").alias("q"))
    right = asked.withColumn("g", group).join(known, "g").select("g", "leaf", "id", "vector", F.lit(True).alias("query"), each("row_chunks").alias("r"), mine("query_chunks").alias("q"))
    found = left.unionByName(right).groupBy("g", "r", "q").applyInArrow(block(k), "query_id long, vec_id long, score double")
    found = scratch.table(found, "found")
    scratch.drop(placed, asked)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", F.lit(reached).alias("sample_recall"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(common.documents(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)
