"""Token-id files of directly addressable codes.

A file holds the ids of some documents in order.  An id is split into chunks of CHUNK bits.  Level 0 has the low chunk of
every id and a bitmap that says which ids go on; level 1 the next chunks of those that do; and so on.  A rank directory
(the number of set bits before each block of BLOCK bits) leads from an id's place in one level to its place in the next, so
any single id is read without decoding others.

Layout, little-endian: MAGIC, uint32 length of a JSON header, the header, then the parts it names with their places:
doc_id (int64), doc_null (uint8), n_tokens (int64), and per level chunks (uint8), bits (uint8, least bit first), ranks (uint64).

Writing: documents are range-sorted by id; each task rolls files at `roll_ids` ids, writes under a temporary name, renames,
and returns a manifest row.  Only files that the manifest names count, so a task that runs twice does no harm.

Cases: a null or empty text has the end id alone.  Null ids come first.  Repeated ids are written each, in the order of
their texts.  An empty table gives no files.  Other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common, pieces

MAGIC, CHUNK, BLOCK = b"DACIDS01", 8, 512
MANIFEST = "part int, file int, path string, n_docs long, n_ids long"


def pack(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bits, ranks) of each level."""
    levels = []
    rest = ids.astype(np.uint32)
    while True:
        low, rest = (rest & 0xFF).astype(np.uint8), rest >> CHUNK
        on = rest > 0
        bits = np.packbits(on, bitorder="little")
        blocks = np.add.reduceat(on.astype(np.uint64), np.arange(0, len(on), BLOCK)) if len(on) else np.zeros(0, np.uint64)
        levels.append((low, bits, np.concatenate([[0], np.cumsum(blocks)]).astype(np.uint64)))
        if not on.any():
            return levels
        rest = rest[on]


def unpack(levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros(0, np.uint32)
    for low, bits, _ in reversed(levels):
        now = low.astype(np.uint32)
        on = np.unpackbits(bits, count=len(low), bitorder="little").astype(bool)
        now[on] |= out << CHUNK
        out = now
    return out


def to_bytes(doc_ids: list, counts: np.ndarray, ids: np.ndarray) -> bytes:
    parts = [("doc_id", np.array([x or 0 for x in doc_ids], np.int64)), ("doc_null", np.array([x is None for x in doc_ids], np.uint8)), ("n_tokens", counts.astype(np.int64))]
    levels = pack(ids)
    for i, level in enumerate(levels):
        parts += [(f"{name}{i}", x) for name, x in zip(("chunks", "bits", "ranks"), level, strict=True)]
    head, at, blobs = {"levels": len(levels), "n_ids": len(ids), "parts": {}}, 0, []
    for name, x in parts:
        head["parts"][name] = [at, x.dtype.str, len(x)]
        blobs.append(x.tobytes())
        at += len(blobs[-1])
    text = json.dumps(head).encode()
    return b"".join([MAGIC, len(text).to_bytes(4, "little"), text, *blobs])


class TokenFile:
    """Reads a file's bytes; ids[i] and document(k) touch only what they need."""

    def __init__(self, data: bytes):
        if data[:8] != MAGIC:
            raise ValueError("not a token-id file")
        n = int.from_bytes(data[8:12], "little")
        self.head = json.loads(data[12 : 12 + n])
        base = 12 + n
        self.part = {k: np.frombuffer(data, np.dtype(kind), size, base + at) for k, (at, kind, size) in self.head["parts"].items()}
        self.levels = [tuple(self.part[f"{name}{i}"] for name in ("chunks", "bits", "ranks")) for i in range(self.head["levels"])]
        self.starts = np.concatenate([[0], np.cumsum(self.part["n_tokens"])])

    def __len__(self) -> int:
        return self.head["n_ids"]

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < len(self):
            raise IndexError(i)
        out = 0
        for level, (chunks, bits, ranks) in enumerate(self.levels):
            out |= int(chunks[i]) << (CHUNK * level)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            within = bits[block * BLOCK >> 3 : (i >> 3) + 1].copy()
            within[-1] &= (1 << (i & 7)) - 1
            i = int(ranks[block]) + int(np.bitwise_count(within).sum())
        return out

    def all_ids(self) -> np.ndarray:
        return unpack(self.levels)

    def document(self, k: int) -> list[int]:
        return [self[i] for i in range(self.starts[k], self.starts[k + 1])]

    def doc_ids(self) -> list:
        return [None if null else int(x) for x, null in zip(self.part["doc_id"], self.part["doc_null"], strict=True)]


_ready: dict = {}


def _byte_letters() -> str:
    """The characters that byte-level vocabularies write bytes as; each stands for one byte."""
    from tokenizers.pre_tokenizers import ByteLevel

    return "".join(ByteLevel.alphabet())


def tokenizer_cache(path: str) -> pieces.PieceCache:
    if path not in _ready:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.no_padding()
        t.no_truncation()
        if t.normalizer is not None or "ByteLevel" not in type(t.pre_tokenizer).__name__:
            raise ValueError("only byte-level vocabularies without a normalizer can be encoded part by part")
        letters = {c: i for i, c in enumerate(_byte_letters())}
        size = np.zeros(t.get_vocab_size(), np.int64)  # bytes of each token, by which a joined text's ids are told apart
        for token, i in t.get_vocab().items():
            size[i] = len(token) if all(c in letters for c in token) else len(token.encode())

        def parts(some: list[str]) -> list[bytes]:
            ids = np.array(t.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, np.uint32)
            at = pieces.regroup(np.cumsum(size[ids]), np.array([len(p.encode()) + 1 for p in some], np.int64)).tolist()
            return [ids[a:b].tobytes() for a, b in zip(at[:-1], at[1:], strict=True)]

        def texts(some: list[str]) -> list[bytes]:
            return [np.array(e.ids, np.uint32).tobytes() for e in t.encode_batch_fast(some, add_special_tokens=False)]

        _ready[path] = pieces.PieceCache(parts, texts, added=tuple(x.content for x in t.get_added_tokens_decoder().values()))
    return _ready[path]


def put(uri: str, name: str, data: bytes) -> str:
    """Writes under a temporary name, then renames; returns the final URI."""
    fs, folder = common.local_path(uri)
    fs.create_dir(folder, recursive=True)
    temporary = f"{folder}/_{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary, compression=None) as f:
        f.write(data)
    fs.move(temporary, f"{folder}/{name}")
    return f"{uri}/{name}"


def write(df: DataFrame, folder: str, tokenizer: str, end_id: int, roll_ids: int = 1 << 21, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Writes the files under `folder` (a URI) and returns the manifest as a written table."""
    spark = df.sparkSession
    tail = np.array([end_id], np.uint32).tobytes()

    def run(batches: Iterator) -> Iterator:
        import os

        import pyarrow as pa
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        cache, part, file = tokenizer_cache(tokenizer), TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[bytes] = []
        size = 0

        def roll() -> pa.RecordBatch:
            nonlocal doc_ids, held, size, file
            data = to_bytes(doc_ids, np.array([len(x) // 4 for x in held]), np.frombuffer(b"".join(held), np.uint32))
            path = put(folder, f"ids-{part:06d}-{file:06d}-{uuid.uuid4().hex[:8]}.dac", data)
            row = pa.RecordBatch.from_pylist([{"part": part, "file": file, "path": path, "n_docs": len(held), "n_ids": size // 4}], pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())]))
            doc_ids, held, size, file = [], [], 0, file + 1
            return row

        for whole in batches:
            for b in pieces.by_bytes(whole, "_text"):
                for d, x in zip(b.column("_id").to_pylist(), cache.ids([t.decode("utf-8", "replace") for t in b.column("_text").to_pylist()]), strict=True):
                    doc_ids.append(d)
                    held.append(x + tail)
                    size += len(x) + 4
                if size >= 4 * roll_ids:
                    yield roll()
        if held:
            yield roll()

    rows = df.select(F.col(id_column).cast("long").alias("_id"), common.text_bytes(text).alias("_text"))
    rows = rows.repartitionByRange(common.shuffle_partitions(spark), "_id").sortWithinPartitions("_id", "_text")
    return common.Scratch(spark).table(rows.mapInArrow(run, MANIFEST), "manifest")


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with `start`: the number of ids in all files before.  Windows run within a part, then over parts."""
    parts = manifest.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    before = parts.select("part", (F.sum("_n").over(Window.orderBy("part")) - F.col("_n")).alias("_before"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("file")) - F.col("n_ids")
    return manifest.withColumn("_inside", inside).join(before, "part").withColumn("start", F.col("_before") + F.col("_inside")).drop("_before", "_inside")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of each document, read from the files."""

    def run(frames: Iterator) -> Iterator:
        import pandas as pd

        for frame in frames:
            for path, start in zip(frame["path"], frame["start"], strict=True):
                fs, place = common.local_path(path)
                with fs.open_input_stream(place, compression=None) as f:
                    t = TokenFile(f.read())
                ids = t.all_ids().astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(t.starts[:-1], t.starts[1:], strict=True)]
                yield pd.DataFrame({"doc_id": pd.array(t.doc_ids(), "Int64"), "start": start + t.starts[:-1], "n_tokens": t.part["n_tokens"], "ids_crc32": np.array(crc, np.int64)})

    spread = with_starts(manifest).select("path", "start").repartition(common.shuffle_partitions(manifest.sparkSession))
    return spread.mapInPandas(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


END_ID = 2


def op6_token_files(spark: SparkSession, sf_dir: str, tokenizer: str | None = None) -> DataFrame:
    import public_tokenizers as P

    return read(write(common.documents(spark, sf_dir), common.scratch_path(spark, "token-ids"), tokenizer or P.path("byte_bpe_50k.json"), END_ID))
