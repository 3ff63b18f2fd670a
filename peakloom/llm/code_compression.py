"""Vector code compression: product codes by dual-tree Lloyd over integer parts.

A component becomes floor(scale * x); vectors are cut into consecutive parts, and each part position has a codebook of its own.
Tasks take blocks of vectors and build, for each position, a tree over the block's parts: nodes are halved along their widest
side, down to `leaf` parts, and each has its box and the sum of its parts.  The trees are written once and read each round.

A round sends the codebooks to the tasks, which build a tree over the entries and go down both trees together.  Between the box
of a node of parts and that of a node of entries the least and the greatest distance are integers; a node of entries farther
than the least of the greatest distances can't hold the nearest entry of any part, so the combination is pruned.  A node of
parts with one entry left gives that entry its cached sum as a whole.  What is still open in a leaf is settled by the
integer distances of its parts to the entries left there.  Bounds prune only what is strictly farther, so ties go to the lower
index, and every result is an exact integer, whatever the blocks are.

Scale: vectors are not shuffled.  A round reads the trees and sends at most parts * entries * width sums a task to an
aggregation, and as many in all to the driver.  Sums over labels reach rows by a broadcast of the labels that hold more than a
thousandth of all rows (so at most 1,000) and by an equi-join for the others.

Cases: rows whose vector is null or holds null or non-finite components are dropped, and so are those of another length than
the vector of the smallest kept id.  A length that parts don't divide is filled up with zeros at the end.  Integers beyond
2 ** 27 stop there.  With fewer kept rows than entries, codebooks have as many entries as there are rows.  Null ids come last;
equal ids are ordered by their vectors.  Null labels are one label.  Repeated rows are rows each.  An empty table gives an
empty result.  Other columns pass through; the added ones replace like-named ones.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

PARTS, ENTRIES, SCALE, ROUNDS = 8, 16, 4096, 6
MOST = 1 << 27
#: Parts in a leaf, and vectors in a block.
LEAF, BLOCK = 16, 16_384
FAR = np.iinfo(np.int64).max


def finite(column: str) -> Column:
    fine = F.forall(column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(F.col(column).isNotNull() & fine, F.lit(False))


def integers(column: str, scale: int) -> Column:
    def one(x: Column) -> Column:
        y = F.greatest(F.least(x.cast("double") * scale, F.lit(float(MOST))), F.lit(float(-MOST)))
        return F.floor(y).cast("int")

    return F.transform(column, one)


class Tree:
    """Halved nodes over points, level by level; points, boxes and sums are in the order of the nodes."""

    def __init__(self, points: np.ndarray, leaf: int):
        n = len(points)
        depth = max(0, (n // leaf).bit_length() - 1)
        self.order, self.starts = np.arange(n), self.bounds(n, depth)
        for s in self.starts[:-1]:
            p = points[self.order]
            side = (np.maximum.reduceat(p, s) - np.minimum.reduceat(p, s)).argmax(1)
            node = np.repeat(np.arange(len(s)), np.diff(np.append(s, n)))
            self.order = self.order[np.lexsort((p[np.arange(n), side[node]], node))]
        self.points = points[self.order]
        last = self.starts[-1]
        self.low, self.high, self.sums = ([f.reduceat(self.points, last)] for f in (np.minimum, np.maximum, np.add))
        for _ in range(depth):
            for levels, f in ((self.low, np.minimum), (self.high, np.maximum), (self.sums, np.add)):
                levels.insert(0, f(levels[0][0::2], levels[0][1::2]))

    @staticmethod
    def bounds(n: int, depth: int) -> list[np.ndarray]:
        """First points of the nodes of each level."""
        out = [np.zeros(1, np.int64)]
        for _ in range(depth):
            s = out[-1]
            middle = (s + np.append(s[1:], n)) // 2
            out.append(np.stack([s, middle], 1).ravel())
        return out

    def packed(self) -> tuple[bytes, bytes, bytes, bytes]:
        box = np.concatenate([*self.low, *self.high])
        return self.points.astype("<i4").tobytes(), self.order.astype("<i4").tobytes(), box.astype("<i4").tobytes(), np.concatenate(self.sums).astype("<i8").tobytes()

    @classmethod
    def unpacked(cls, points: bytes, order: bytes | None, box: bytes, sums: bytes, width: int) -> Tree:
        self = cls.__new__(cls)
        self.points = np.frombuffer(points, "<i4").reshape(-1, width).astype(np.int64)
        self.order = None if order is None else np.frombuffer(order, "<i4")
        box, sums = np.frombuffer(box, "<i4").reshape(2, -1, width).astype(np.int64), np.frombuffer(sums, "<i8").reshape(-1, width)
        depth = len(sums).bit_length() - 1  # nodes are 2 ** (depth + 1) - 1
        self.starts = cls.bounds(len(self.points), depth)
        at = [(1 << d) - 1 for d in range(depth + 2)]
        self.low, self.high, self.sums = ([x[a:b] for a, b in zip(at, at[1:], strict=False)] for x in (box[0], box[1], sums))
        return self


def entry_levels(entries: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(low, high, parent) of the nodes over the entries, from the root to the entries themselves in the order of their index."""
    tree = Tree(entries, 1)
    out = [(low, high, np.arange(len(low)) // 2) for low, high in zip(tree.low, tree.high, strict=True)]
    leaf = np.repeat(np.arange(len(tree.starts[-1])), np.diff(np.append(tree.starts[-1], len(entries))))
    parent = np.empty(len(entries), np.int64)
    parent[tree.order] = leaf
    return [*out, (entries, entries, parent)]


def still_possible(low: np.ndarray, high: np.ndarray, entry_low: np.ndarray, entry_high: np.ndarray, may: np.ndarray) -> np.ndarray:
    """Which nodes of entries may hold the nearest entry of a part in a box; may: those that were left before."""
    low, high = low[:, None, :], high[:, None, :]
    gap = np.maximum(np.maximum(entry_low - high, low - entry_high), 0)
    reach = np.maximum(high - entry_low, entry_high - low)
    least, greatest = (gap * gap).sum(2), (reach * reach).sum(2)
    return may & (least <= np.where(may, greatest, FAR).min(1, keepdims=True))


def lloyd(tree: Tree, entries: np.ndarray, code: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray | None]:
    """Sums and numbers of the parts nearest to each entry; with code, also each part's entry in the order of the tree."""
    n, k = len(tree.points), len(entries)
    sums, numbers = np.zeros_like(entries), np.zeros(k, np.int64)
    codes = np.empty(n, np.int64) if code else None
    levels = entry_levels(entries)
    nodes, may, e = np.zeros(1, np.int64), np.ones((1, 1), bool), 0
    for level, starts in enumerate(tree.starts):
        if level:
            nodes, may = np.stack([2 * nodes, 2 * nodes + 1], 1).ravel(), np.repeat(may, 2, axis=0)
        last = level == len(tree.starts) - 1
        for _ in range(max(1, len(levels) - 1 - e) if last else 1):  # both trees a level down; in the last level down to the entries
            if e < len(levels) - 1:
                e, may = e + 1, may[:, levels[e + 1][2]]
            may = still_possible(tree.low[level][nodes], tree.high[level][nodes], levels[e][0], levels[e][1], may)
        if e < len(levels) - 1:
            continue
        ends = np.append(starts[1:], n)
        one = may.sum(1) == 1
        to = may[one].argmax(1)
        np.add.at(sums, to, tree.sums[level][nodes[one]])
        np.add.at(numbers, to, (ends - starts)[nodes[one]])
        if code:
            size = (ends - starts)[nodes[one]]
            codes[spans(starts[nodes[one]], size)] = np.repeat(to, size)
        nodes, may = nodes[~one], may[~one]
    size = (np.append(tree.starts[-1][1:], n) - tree.starts[-1])[nodes]
    at, which = spans(tree.starts[-1][nodes], size), np.repeat(np.arange(len(nodes)), size)
    for a in range(0, len(at), 4096):
        some = at[a : a + 4096]
        difference = tree.points[some][:, None, :] - entries[None, :, :]
        to = np.where(may[which[a : a + 4096]], (difference * difference).sum(2), FAR).argmin(1)
        np.add.at(sums, to, tree.points[some])
        numbers += np.bincount(to, minlength=k)
        if code:
            codes[some] = to
    return sums, numbers, codes


def spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers from each start, as many as its size."""
    first = np.cumsum(sizes) - sizes
    return np.repeat(starts - first, sizes) + np.arange(int(sizes.sum()))


def filled(vectors: np.ndarray, parts: int) -> np.ndarray:
    """Vectors with zeros at the end, so that parts of equal width cover them."""
    n, d = vectors.shape
    width = max(1, -(-d // parts))
    return np.concatenate([vectors, np.zeros((n, width * parts - d), vectors.dtype)], 1).reshape(n, parts, width)


def trees(rows: DataFrame, parts: int, leaf: int = LEAF, block: int = BLOCK) -> DataFrame:
    """rows: (row, ints).  A row a block: the rows, and the packed trees of its parts by position."""

    def packed(rows, vectors: list[np.ndarray]):
        import pyarrow as pa

        p = filled(np.concatenate(vectors), parts).astype(np.int64)
        made = [Tree(p[:, i], leaf).packed() for i in range(parts)]
        whole = pa.concat_arrays(rows)
        columns = [pa.array([list(c)], pa.list_(pa.binary())) for c in zip(*made, strict=True)]
        return pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole), *columns], ["rows", "points", "orders", "boxes", "sums"])

    def run(batches: Iterator) -> Iterator:
        held, vectors, n = [], [], 0
        for whole in batches:
            for b in common.batches(iter([whole]), block):
                v = b.column("ints").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                held.append(b.column("row"))
                vectors.append(v)
                n += b.num_rows
                if n >= block:
                    yield packed(held, vectors)
                    held, vectors, n = [], [], 0
        if n:
            yield packed(held, vectors)

    kind = rows.schema["row"].dataType.simpleString()
    return rows.mapInArrow(run, f"rows array<{kind}>, points array<binary>, orders array<binary>, boxes array<binary>, sums array<binary>")


def round_sums(blocks: DataFrame, books: np.ndarray) -> dict[tuple[int, int], tuple[int, list[int]]]:
    """Number and componentwise sum of the parts nearest to each (position, entry) that has any."""
    parts, _, width = books.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total, number = np.zeros_like(books), np.zeros(books.shape[:2], np.int64)
        for b in batches:
            for points, boxes, sums in zip(*(b.column(c) for c in ("points", "boxes", "sums")), strict=True):
                for i in range(parts):
                    tree = Tree.unpacked(points[i].as_py(), None, boxes[i].as_py(), sums[i].as_py(), width)
                    s, n, _ = lloyd(tree, books[i])
                    total[i] += s
                    number[i] += n
        i, e, c = (x.ravel() for x in np.indices(books.shape))
        columns = [i, e, c, np.repeat(number.ravel(), width), total.ravel()]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], ["part", "entry", "component", "n", "total"])

    found = blocks.select("points", "boxes", "sums").mapInArrow(run, "part long, entry long, component long, n long, total long")
    out: dict[tuple[int, int], tuple[int, list[int]]] = {}
    sums = found.groupBy("part", "entry", "component").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).filter("n > 0")
    with common.settings(blocks.sparkSession, common.CLEAN_SHUFFLES, common.ARROW_BYTES):
        for r in sums.collect():  # as many rows as the codebooks have components
            out.setdefault((r["part"], r["entry"]), (r["n"], [0] * width))[1][r["component"]] = r["total"]
    return out


def coded(blocks: DataFrame, books: np.ndarray) -> DataFrame:
    """(row, code, error) of each vector."""
    parts, _, width = books.shape

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            for at in range(b.num_rows):
                rows = b.column("rows").slice(at, 1).flatten()
                codes, error = np.empty((len(rows), parts), np.uint8), np.zeros(len(rows), np.int64)
                for i in range(parts):
                    tree = Tree.unpacked(*(b.column(c)[at][i].as_py() for c in ("points", "orders", "boxes", "sums")), width)
                    to = lloyd(tree, books[i], code=True)[2]
                    codes[tree.order, i] = to
                    difference = tree.points - books[i][to]
                    error[tree.order] += (difference * difference).sum(1)
                text = codes.tobytes().hex()
                step = 2 * parts
                for a in range(0, len(rows), 4096):
                    z = min(a + 4096, len(rows))
                    made = [text[j * step : (j + 1) * step] for j in range(a, z)]
                    yield pa.RecordBatch.from_arrays([rows.slice(a, z - a), pa.array(made, pa.string()), pa.array(error[a:z])], ["row", "code", "error"])

    kind = blocks.schema["rows"].dataType.elementType.simpleString()
    return blocks.mapInArrow(run, f"row {kind}, code string, error long")


def compress(df: DataFrame, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE, rounds: int = ROUNDS, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """Codes and codebooks: a row a kept vector with df's columns but the vector, and code, error and label_error; and integers
    by position, entry and component.  entries is 256 at most."""
    scratch = common.Scratch(df.sparkSession)
    rest = [c for c in df.columns if c not in (vector, "code", "error", "label_error")]
    kept = df.filter(finite(vector)).select(F.struct(*rest).alias("row"), integers(vector, scale).alias("ints"), F.col(id_column).alias("id"))
    first = [r["ints"] for r in kept.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()]
    d = len(first[0]) if first else 0
    same = kept.filter(F.size("ints") == d)
    if any(len(v) != d for v in first):
        first = [r["ints"] for r in same.orderBy(F.col("id").asc_nulls_last(), "ints").limit(entries).select("ints").collect()]
    books = filled(np.array(first, np.int64).reshape(len(first), d), parts).transpose(1, 0, 2).copy()
    blocks = scratch.table(trees(same.select("row", "ints"), parts, block=block), "trees")
    for _ in range(rounds if first else 0):
        for (i, e), (n, total) in round_sums(blocks, books).items():
            books[i, e] = [s // n for s in total]
    codes = scratch.table(coded(blocks, books), "codes")
    scratch.drop(blocks)
    name = F.col("row").getField(label)
    sums = scratch.table(codes.groupBy(name.alias("_label")).agg(F.sum("error").alias("label_error"), F.count("*").alias("_n")), "label-errors")
    total = codes.count()
    hot = sums.filter(F.col("_n") * 1000 > total).select("_label", "label_error", F.lit(True).alias("_hot"))
    marked = codes.join(F.broadcast(hot), name.eqNullSafe(F.col("_label")), "left")
    rare = sums.filter(F.col("_n") * 1000 <= total).select(F.col("_label").alias("_rare"), F.col("label_error").alias("_rare_error"))
    columns = ["row.*", "code", "error", "label_error"]
    cold = marked.filter("_hot is null").select("row", "code", "error").join(rare, name.eqNullSafe(F.col("_rare"))).withColumn("label_error", F.col("_rare_error"))
    return marked.filter("_hot").select(*columns).unionByName(cold.select(*columns)), books


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def decoded(codes: DataFrame, books: np.ndarray, dimension: int, scale: int = SCALE, code: str = "code", to: str = "embedding") -> DataFrame:
    """codes with the vectors that they stand for: the middles of the integers' ranges, cut to the dimension."""
    parts, entries, _ = books.shape
    values = F.lit(((books + 0.5) / scale).reshape(parts * entries, -1).tolist()) if entries else F.array()

    def one(i: Column) -> Column:
        return F.get(values, F.conv(F.substring(F.col(code), 2 * i + 1, F.lit(2)), 16, 10).cast("int") + i * entries)

    return codes.withColumn(to, F.slice(F.flatten(F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), one)), 1, dimension))


def op11_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = compress(common.documents(spark, sf_dir, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def sql(rounds: int = ROUNDS, parts: int = PARTS, entries: int = ENTRIES, scale: int = SCALE) -> str:
    """DuckDB SQL for the same, over vectors whose length the parts divide."""
    ctes = [
        f"k AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v FROM embeddings"
        " WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)",
        f"p AS MATERIALIZED (SELECT r, vec_id, label, i AS part, v[i * (len(v) // {parts}) + 1 : (i + 1) * (len(v) // {parts})] AS x FROM k, range({parts}) t(i))",
        f"b0 AS MATERIALIZED (SELECT part, r - 1 AS e, x AS c FROM p WHERE r <= {entries})",
    ]
    for n in range(rounds + 1):
        ctes.append(
            f"a{n} AS MATERIALIZED (SELECT r, p.part, vec_id, label, x, min(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT * {entries} + e) AS m"
            f" FROM p JOIN b{n} b ON b.part = p.part GROUP BY r, p.part, vec_id, label, x)"
        )
        if n < rounds:
            ctes.append(f"u{n} AS (SELECT part, (m % {entries})::BIGINT AS e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM a{n})")
            ctes.append(f"w{n} AS (SELECT part, e, j, (sum(y) - ((sum(y) % count(*)) + count(*)) % count(*)) // count(*) AS y FROM u{n} GROUP BY part, e, j)")
            ctes.append(f"g{n} AS (SELECT part, e, list(y::BIGINT ORDER BY j) AS c FROM w{n} GROUP BY part, e)")
            ctes.append(f"b{n + 1} AS MATERIALIZED (SELECT b.part, b.e, coalesce(g.c, b.c) AS c FROM b{n} b LEFT JOIN g{n} g ON g.part = b.part AND g.e = b.e)")
    ctes.append(f"s AS (SELECT r, vec_id, label, string_agg(printf('%02x', (m % {entries})::BIGINT), '' ORDER BY part) AS code, sum(m // {entries})::BIGINT AS error FROM a{rounds} GROUP BY r, vec_id, label)")
    ctes.append(f"h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b{rounds})")
    return "WITH " + ",\n".join(ctes) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM s, h"


SQL = sql()
