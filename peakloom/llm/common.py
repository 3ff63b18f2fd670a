"""Shared pieces of the operators: scratch tables, Arrow helpers, word tables, connected components."""

from __future__ import annotations

import contextlib
import contextvars
import json
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spark removes an execution's shuffle files when it ends; every execution here ends in a written table.
CLEAN_SHUFFLES = ("spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true")
#: Batches that go to Python hold at most so many bytes (or a single row), so that long rows don't add up.
ARROW_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
_local_dir: str | None = None
#: The lists that open recording() blocks of this thread or task note paths in.
_recording: contextvars.ContextVar[tuple[list[str], ...]] = contextvars.ContextVar("recording", default=())


def documents(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or, on a local master that has none, a local one."""
    global _local_dir
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if _local_dir is None:
        _local_dir = tempfile.mkdtemp(prefix="peakloom-")
    return f"file://{_local_dir}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


class Scratch:
    """Tables written to the shared folder.  They cut lineage and outlive lost executors; drop() frees one early."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, str] = {}

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        with settings(self.spark, CLEAN_SHUFFLES, ARROW_BYTES):
            df.write.option("compression", "zstd").parquet(path)
        for noted in _recording.get()[-1:]:
            noted.append(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch = path  # keeps the id from being reused while the table is known
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            if path := self.paths.pop(id(t), None):
                delete(self.spark, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextlib.contextmanager
def recording(paths: list[str]):
    """Notes the scratch tables made inside, for whoever deletes them once what was made of them is written."""
    token = _recording.set((*_recording.get(), paths))
    try:
        yield
    finally:
        _recording.reset(token)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextlib.contextmanager
def settings(spark: SparkSession, *conf: tuple[str, str]):
    """Session settings that hold inside the block."""
    was = [(k, spark.conf.get(k, None)) for k, _ in conf]
    for k, v in conf:
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in was:
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def literal_table(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small table of the driver's, as one JSON literal."""
    return spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")).alias("x")).select("x.*")


def text_bytes(column: str = "text") -> F.Column:
    """A text as UTF-8 bytes; null counts as empty."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b"").cast("binary"))


#: ASCII letters to lower case, as a bytes.translate table.
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


class WordHashes(dict):
    """64-bit hash of a word, remembered; bounded, since it starts anew when full."""

    def __init__(self, seed: int = 0, most: int = 400_000):
        from xxhash import xxh3_64_intdigest

        super().__init__()
        self.of, self.seed, self.most = xxh3_64_intdigest, seed, most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        h = self[word] = self.of(word, self.seed)
        return h

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


U64 = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (public splitmix64 constants)."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def batches(it: Iterator, rows: int) -> Iterator:
    """Arrow batches cut to at most so many rows, so that long texts don't add up."""
    for b in it:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def components(edges: DataFrame, scratch: Scratch, most_rounds: int = 60) -> DataFrame:
    """Connected components of the edges (a, b) by alternating large-star and small-star steps.

    Returns (id, component): every id that an edge names with the smallest id it reaches.  A round is two min-aggregates
    (combined before the shuffle) and two equi-joins, and the edge list never grows beyond the number of edges; rounds
    grow with the logarithm of the largest component.  Self-edges give a component of one.
    """
    e = scratch.table(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    alone = e.filter("u = v").select("u", "v")
    now = e.filter("u <> v")
    before, previous = None, None
    for _ in range(most_rounds):
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        # u > v here: u points to m, and so does every other smaller neighbour of u
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        nxt = scratch.table(small, "stars")
        stat = nxt.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if previous is not None:
            scratch.drop(previous)
        if stat == before:
            now = nxt
            break
        before, previous, now = stat, nxt, nxt
    else:
        raise RuntimeError(f"components: no end after {most_rounds} rounds")
    roots = now.select(F.col("v").alias("id"), F.col("v").alias("component"))
    lone = alone.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).union(roots).union(lone).groupBy("id").agg(F.min("component").alias("component"))


#: Hadoop's names of file systems that pyarrow knows by another name.
SCHEMES = {"s3a": "s3", "s3n": "s3", "abfs": "abfss", "viewfs": "hdfs"}


def local_path(uri: str) -> tuple[object, str]:
    """A pyarrow file system and path for a URI of the shared folder: file:, or a scheme of pyarrow or of SCHEMES."""
    from pyarrow import fs

    if "://" not in uri:
        return fs.FileSystem.from_uri("file://" + os.path.abspath(uri.removeprefix("file:")))
    scheme, rest = uri.split("://", 1)
    return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}://{rest}")
