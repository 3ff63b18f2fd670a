"""Embedding near-dedup: random-hyperplane sign hashing in several tables, exact cosines, connected components.

A vector has one signature a table: the signs of its products with `planes` random hyperplanes, which come from a seed.
Vectors of one label with one signature form a bucket; pairs are compared inside buckets only, in double precision.

Inside a bucket no pairs are emitted.  A bucket is cut into cells of at most `cell` vectors; each pair of cells is one block
that a task multiplies as matrices, and what leaves it is a count for each vector and a spanning forest of the block's links.
A pair that meets in several tables is counted in the first of them alone, since every row carries all its signatures.  So
the links are counted once each, and edges stay linear in the vectors of a block.

Equal vectors of a label are one row with a count before anything is compared, however many there are: they link with each
other and have the same other links.

Scale: a row is sent once a table and cell pair, so a bucket of m vectors sends about m * m / cell rows.  Buckets are kept
below `cell` by the number of planes, which follows the number of rows of the largest label (see planes_for): labels part the
rows already, and each plane more asks for more tables.  A row takes its vector and the signatures of the tables before, packed;
it is sent once to its block, as only buckets of several cells are looked up, in a broadcast table of a row each.

Cases: null vectors, zero vectors and those with null or non-finite components, and rows with a null label, link with
nothing and are kept.  Vectors of different lengths never link.  Repeated ids with equal rows are copies; with
different rows they are one vertex of the components and each row has its copies' and the vertex's links.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, vectors


def planes_for(rows: int, least: int = 5, per_bucket: int = 4096) -> int:
    """Enough planes that an even spread would leave about per_bucket rows in a bucket."""
    return max(least, math.ceil(math.log2(max(1, rows / per_bucket))))


def tables_for(planes: int, cosine: float, miss: float) -> int:
    """Tables by which a pair at the threshold is missed with probability `miss` at most."""
    p = (1 - math.acos(cosine) / math.pi) ** planes
    return max(1, math.ceil(math.log(miss) / math.log(1 - p)))


def packed_kind(planes: int) -> np.dtype:
    return np.dtype(np.int16 if planes < 16 else np.int32 if planes < 32 else np.int64)


def signatures(df: DataFrame, tables: int, planes: int, seed: int) -> DataFrame:
    """(rep, label, embedding) plus `sigs`, an array of a signature for each table, and `packed`, the same as bytes."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        normals: dict[int, np.ndarray] = {}
        for whole in batches:
            for b in common.batches(iter([whole]), 4096):
                sizes = b.column("embedding").value_lengths().to_numpy(zero_copy_only=False)
                sigs = np.zeros((b.num_rows, tables), np.int64)
                for n in np.unique(sizes).tolist():
                    at = np.flatnonzero(sizes == n)
                    if n not in normals:
                        normals[n] = np.random.default_rng([seed, n]).standard_normal((n, tables * planes))
                    m = vectors.unit(vectors.matrix(b.column("embedding").take(pa.array(at))))
                    signs = (m @ normals[n] > 0).reshape(len(at), tables, planes)
                    sigs[at] = (signs * (1 << np.arange(planes, dtype=np.int64))).sum(2)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, sigs.size + 1, tables, dtype=np.int32)), pa.array(sigs.ravel()))
                packed = pa.array([row.tobytes() for row in sigs.astype(packed_kind(planes))], pa.binary())
                yield pa.RecordBatch.from_arrays([*b.columns, lists, packed], [*b.schema.names, "sigs", "packed"])

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    return df.mapInArrow(run, f"{kind}, sigs array<long>, packed binary")


def block_links(cosine: float, planes: int):
    """For one block of a table's bucket: counts of links (weighted by copies) and a spanning forest."""

    def run(table):
        import pyarrow as pa

        t = int(table.column("t")[0].as_py())
        i, j = int(table.column("i")[0].as_py()), int(table.column("j")[0].as_py())
        table = table.combine_chunks()
        cell = table.column("cell").to_numpy()
        rep, copies = table.column("rep").to_numpy(), table.column("copies").to_numpy()
        sigs = np.frombuffer(b"".join(table.column("packed").to_pylist()), packed_kind(planes)).reshape(len(rep), t)  # of earlier tables
        v = vectors.unit(np.stack(table.column("embedding").to_numpy(zero_copy_only=False)).astype(np.float64))
        left = np.flatnonzero(cell == i)
        right = left if i == j else np.flatnonzero(cell == j)
        counts = np.zeros(len(rep), np.int64)
        parent = np.arange(len(rep))

        def root(x: int) -> int:
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        edges: list[tuple[int, int]] = []
        step = max(1, (1 << 21) // max(1, len(right)))
        for at in range(0, len(left), step):
            some = left[at : at + step]
            link = v[some] @ v[right].T >= cosine
            if i == j:
                link &= some[:, None] != right[None, :]
            x, y = np.nonzero(link)
            x, y = some[x], right[y]
            for s in range(t):  # pairs that have met in an earlier table
                new = sigs[x, s] != sigs[y, s]
                x, y = x[new], y[new]
            np.add.at(counts, x, copies[y])
            if i != j:
                np.add.at(counts, y, copies[x])
            for one, two in zip(x.tolist(), y.tolist(), strict=True):
                a, b = root(one), root(two)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    edges.append((int(rep[one]), int(rep[two])))
        has = np.flatnonzero(counts)
        n = len(edges)
        return pa.table({"a": pa.array([*rep[has].tolist(), *[x for x, _ in edges]], pa.int64()), "b": pa.array([*[None] * len(has), *[y for _, y in edges]], pa.int64()), "n": pa.array([*counts[has].tolist(), *[0] * n], pa.int64())})

    return run


def links(df: DataFrame, cosine: float = 0.93, miss: float = 1e-4, cell: int = 8192, seed: int = 5, id_column: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, n_links, component_id, kept), a row a vector."""
    spark = df.sparkSession
    scratch = common.Scratch(spark)
    rows = df.select(F.col(id_column).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("embedding"), F.col(label).alias("label"))
    rows = rows.withColumn("ok", F.coalesce(vectors.usable("embedding") & F.col("label").isNotNull() & F.col("vec_id").isNotNull(), F.lit(False)))
    # -0.0 and 0.0 are one value
    rows = rows.withColumn("embedding", F.transform("embedding", lambda x: x + F.lit(0.0)))
    ids = scratch.table(rows.select("vec_id", "label", "embedding", "ok", F.when(F.col("ok"), F.sha2(F.to_json(F.struct("label", "embedding")), 256)).alias("same")), "vectors")
    # one row for equal vectors, under the smallest of their ids
    reps = ids.filter("ok").groupBy("same").agg(F.count("*").alias("copies"), F.min("vec_id").alias("rep"), F.first("label").alias("label"), F.first("embedding").alias("embedding"))
    reps = scratch.table(reps, "classes")
    largest = reps.groupBy("label", F.size("embedding")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    planes = planes_for(largest)
    tables = tables_for(planes, cosine, miss)
    signed = scratch.table(signatures(reps.select("rep", "label", "embedding", "copies"), tables, planes, seed), "signed")
    signed = signed.withColumn("dim", F.size("embedding"))
    member = signed.select("*", F.posexplode("sigs").alias("t", "sig"))
    key = ["t", "label", "dim", "sig"]
    sizes = signed.select("label", "dim", F.posexplode("sigs").alias("t", "sig")).groupBy(*key).agg(F.ceil(F.count("*") / cell).alias("cells"))
    # a row a bucket of several cells, so rows * tables / cell at most: broadcast, vectors are not moved for it
    member = member.join(F.broadcast(sizes.filter("cells > 1")), key, "left").withColumn("cells", F.coalesce("cells", F.lit(1).cast("long")))
    member = member.withColumn("cell", F.pmod(F.xxhash64("rep"), F.col("cells")))
    earlier = F.substring("packed", F.lit(1), F.col("t") * packed_kind(planes).itemsize).alias("packed")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1))
    member = member.select("rep", "label", "dim", "embedding", "copies", earlier, "t", "sig", "cell", other.alias("other"))
    member = member.select("*", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"))
    # dealt by block, or all blocks of a hot bucket would stay in the task that the join left them in
    member = member.repartition(common.shuffle_partitions(spark), *key, "i", "j")
    found = scratch.table(member.groupBy(*key, "i", "j").applyInArrow(block_links(cosine, planes), "a long, b long, n long"), "links")
    counts = found.filter("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    comps = common.components(found.filter("b is not null").select("a", "b"), scratch)
    known = reps.select("rep", "same", "copies").join(counts, "rep", "left").join(comps.withColumnRenamed("id", "rep"), "rep", "left")
    known = scratch.table(known.select("same", (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"), "copies"), "known")
    # copies may be a third of all rows: the class is salted to reach them
    parts = common.shuffle_partitions(spark)
    salt = F.pmod(F.xxhash64("vec_id"), F.lit(parts).cast("long"))
    hot = known.withColumn("_salt", F.explode(F.when(F.col("copies") > 64, F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).otherwise(F.array(F.lit(-1).cast("long")))))
    marked = ids.select("vec_id", "same").join(known.filter("copies > 64").select("same", F.lit(True).alias("_hot")), "same", "left")
    marked = marked.withColumn("_salt", F.when(F.col("_hot"), salt).otherwise(F.lit(-1).cast("long")))
    out = marked.join(hot, ["same", "_salt"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(F.col("vec_id").alias(id_column), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return links(common.documents(spark, sf_dir, "embeddings"), 0.93)


SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
u AS (SELECT *, label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0 AS ok FROM v),
p AS MATERIALIZED (SELECT a.vec_id AS a, b.vec_id AS b FROM (SELECT * FROM u WHERE ok) a JOIN (SELECT * FROM u WHERE ok) b ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
n AS (SELECT a, count(*)::BIGINT AS n FROM p GROUP BY a),
r AS (SELECT vec_id AS a, vec_id AS c FROM u UNION SELECT p.a, r.c FROM p JOIN r ON p.b = r.a),
c AS (SELECT a, min(c) AS component_id FROM r GROUP BY a)
SELECT u.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, u.vec_id = component_id AS kept FROM u JOIN c ON c.a = u.vec_id LEFT JOIN n ON n.a = u.vec_id
"""


#: Steps by which embedding_near_copies moves a vector: the first two link, as do the last two, the first and the last mostly don't.
STEPS = (0, 2, 5)


def embedding_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """links() over each vector of `embeddings` and two moved copies of it, so that there are links, copies' chains included.

    All copies move along one direction, so a plane that parts one pair parts many; the tables are as many as a miss of 1e-9 asks.
    """
    e = common.documents(spark, sf_dir, "embeddings").withColumn("k", F.explode(F.array(*[F.lit(k) for k in STEPS])))
    moved = F.transform("embedding", lambda x, i: x.cast("double") + F.col("k") * 0.018 * (i % 3 - 1))
    return links(e.select((F.col("vec_id") * 10 + F.col("k")).alias("vec_id"), moved.alias("embedding"), "label"), 0.93, miss=1e-9)


_MOVED = f"""(SELECT vec_id * 10 + k AS vec_id, label, list_transform(range(1, len(embedding) + 1), lambda i: embedding[i]::DOUBLE + k * 0.018::DOUBLE * ((i - 1) % 3 - 1)) AS embedding
  FROM embeddings, (VALUES {", ".join(f"({k})" for k in STEPS)}) t(k))"""
NEAR_COPIES_SQL = SQL.replace("FROM embeddings)", f"FROM {_MOVED})")
