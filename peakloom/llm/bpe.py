"""Byte-level BPE encoding and decoding on padded numpy matrices.

Words (the matches of the word pattern) are encoded once per batch: their byte ids are laid into matrices by length, padded
with -1.  In each round every row merges its leftmost pair of least rank; pairs are looked up in an open-addressed hash
table, the row is closed up, and rows without a pair in the table leave the matrix.  Words over LONGEST bytes, which would
take as many rounds, merge by a heap in the same order.

Scale: a map over the documents without any shuffle; the vocabulary (about a megabyte) is read from its file by each
worker; what a worker remembers is bounded.

Cases: a null or empty text has no tokens; bytes that are not UTF-8 are read as U+FFFD.  Repeated rows give repeated rows.
An empty table gives an empty result.  Columns of the table other than id and text are left to the caller.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from . import common, pieces

WIDTHS = (4, 8, 16, 32, 64, 128)
LONGEST = WIDTHS[-1]
NONE = np.int32(2**31 - 1)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class PairTable:
    """(left id, right id) -> id of the joined token, which is also the pair's rank; NONE if the vocabulary has no such token."""

    def __init__(self, ranks: dict[bytes, int]):
        found = [(ranks[t[:i]], ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        a, b, to = (np.array(x, np.int64) for x in zip(*found, strict=True))
        self.bits = max(4, int(len(to) * 3).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.to = np.full(1 << self.bits, NONE, np.int32)
        key, slot = (a << 32) | b, self._slot(a, b)
        self.probes = 0
        while len(key):  # each round, one key takes each free slot; the others go one further
            self.probes += 1
            free = self.keys[slot] == -1
            taken, first = np.unique(slot[free], return_index=True)
            won = np.flatnonzero(free)[first]
            self.keys[taken], self.to[taken] = key[won], to[won]
            rest = np.ones(len(key), bool)
            rest[won] = False
            key, to, slot = key[rest], to[rest], (slot[rest] + 1) & ((1 << self.bits) - 1)

    def _slot(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        h = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        return ((h * np.uint64(0xFF51AFD7ED558CCD)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        a, b = a.astype(np.int64), b.astype(np.int64)
        out = np.full(a.shape, NONE, np.int32)
        open_ = np.flatnonzero((a >= 0) & (b >= 0))
        a, b, flat = a.ravel()[open_], b.ravel()[open_], out.ravel()
        key, slot = (a << 32) | b, self._slot(a, b)
        for _ in range(self.probes):
            here = self.keys[slot]
            hit = here == key
            flat[open_[hit]] = self.to[slot[hit]]
            on = ~hit & (here != -1)
            if not on.any():
                break
            open_, key, slot = open_[on], key[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return flat.reshape(out.shape)


class Encoder:
    def __init__(self, path: str, pattern: str):
        import regex

        self.ranks = read_ranks(path)
        self.words = regex.compile(pattern)
        self.pairs = PairTable(self.ranks)
        self.byte_id = np.array([self.ranks[bytes([i])] for i in range(256)], np.int32)
        self.token = {r: t for t, r in self.ranks.items()}
        self.decimal = {r: str(r) for r in self.token}

    def _matrix(self, words: list[bytes], width: int) -> list[bytes]:
        n = len(words)
        size = np.fromiter(map(len, words), np.int64, n)
        m = np.full((n, width), -1, np.int32)
        m[np.arange(width) < size[:, None]] = self.byte_id[np.frombuffer(b"".join(words), np.uint8)]
        rank = np.full((n, width), NONE, np.int32)
        rank[:, :-1] = self.pairs.get(m[:, :-1], m[:, 1:])
        out: list[bytes] = [b""] * n
        row, columns = np.arange(n), np.arange(width)

        def leave(done: np.ndarray) -> None:
            left = (m[done] >= 0).sum(1)
            for i, k, ids in zip(row[done].tolist(), left.tolist(), m[done], strict=True):
                out[i] = ids[:k].tobytes()

        while len(row):
            at = rank.argmin(1)
            every = np.arange(len(row))
            best = rank[every, at]
            done = best == NONE
            if done.any():
                leave(np.flatnonzero(done))
                on = ~done
                m, rank, row, at, best = m[on], rank[on], row[on], at[on], best[on]
                every = np.arange(len(row))
                if not len(row):
                    break
            m[every, at] = best
            source = np.minimum(columns + (columns > at[:, None]), width - 1)
            m, rank = np.take_along_axis(m, source, 1), np.take_along_axis(rank, source, 1)
            m[:, -1], rank[:, -1] = -1, NONE
            after = np.where(at + 1 < width, m[every, np.minimum(at + 1, width - 1)], -1)
            rank[every, at] = self.pairs.get(best, after)
            some = at > 0
            rank[every[some], at[some] - 1] = self.pairs.get(m[every[some], at[some] - 1], best[some])
        return out

    def _long(self, word: bytes) -> bytes:
        ids: list = self.byte_id[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        token, ranks = self.token, self.ranks

        def pair(i: int) -> int | None:
            j = after[i]
            return None if j < 0 else ranks.get(token[ids[i]] + token[ids[j]])

        heap = [(r, i, ids[i], ids[i + 1]) for i in range(n - 1) if (r := pair(i)) is not None]
        heapq.heapify(heap)
        while heap:
            r, i, a, b = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = r, None, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (q := pair(k)) is not None:
                    heapq.heappush(heap, (q, k, ids[k], ids[after[k]]))
        return np.array([x for x in ids if x is not None], np.int32).tobytes()

    def words_to_ids(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word as little-endian uint32 bytes."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        low = 0
        for width in WIDTHS:
            at = np.flatnonzero((sizes > low) & (sizes <= width)).tolist()
            for i in range(0, len(at), 16384):
                some = at[i : i + 16384]
                for k, ids in zip(some, self._matrix([words[k] for k in some], width), strict=True):
                    out[k] = ids
            low = width
        for k in np.flatnonzero(sizes > LONGEST).tolist():
            out[k] = self._long(words[k])
        return out

    def texts_to_ids(self, texts: list[str]) -> list[bytes]:
        found = [self.words.findall(t) for t in texts]
        own = list({w for f in found for w in f})
        ids = dict(zip(own, self.words_to_ids([w.encode() for w in own]), strict=True))
        return [b"".join(map(ids.__getitem__, f)) for f in found]

    def parts_to_ids(self, parts: list[str]) -> list[bytes]:
        found = self.words.findall(" " + " ".join(parts))
        own = list(set(found))
        ids = dict(zip(own, self.words_to_ids([w.encode() for w in own]), strict=True))
        ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        at = pieces.regroup(ends, np.fromiter(map(len, parts), np.int64, len(parts)) + 1).tolist()
        return [b"".join(map(ids.__getitem__, found[a:b])) for a, b in zip(at[:-1], at[1:], strict=True)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


_ready: dict = {}


def encoder(path: str, pattern: str) -> tuple[Encoder, pieces.PieceCache]:
    """One for each worker process."""
    if (path, pattern) not in _ready:
        e = Encoder(path, pattern)
        _ready[path, pattern] = e, pieces.PieceCache(e.parts_to_ids, e.texts_to_ids)
    return _ready[path, pattern]


def encode(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, ids): each text's token ids as an array."""
    from pyspark.sql import functions as F

    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        _, cache = encoder(path, pattern)
        for whole in batches:
            for b in pieces.by_bytes(whole, "_text"):
                found = cache.ids([t.decode("utf-8", "replace") for t in b.column("_text").to_pylist()])
                offsets = np.concatenate([[0], np.cumsum([len(x) // 4 for x in found])]).astype(np.int32)
                flat = np.frombuffer(b"".join(found), np.int32)
                yield pa.RecordBatch.from_arrays([b.column("_id"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["_id", "ids"])

    return df.select(F.col(id_column).alias("_id"), common.text_bytes(text).alias("_text")).mapInArrow(run, f"_id {kind}, ids array<int>").withColumnRenamed("_id", id_column)


def decode(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """(id, text as bytes) of what encode() returns."""
    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        e, _ = encoder(path, pattern)
        for whole in batches:
            for b in common.batches(iter([whole]), 256):
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array([e.decode(x or []) for x in b.column(1).to_pylist()], pa.binary())], ["_id", "bytes"])

    return df.select(id_column, "ids").mapInArrow(run, f"_id {kind}, bytes binary").withColumnRenamed("_id", id_column)


def digests(df: DataFrame, path: str, pattern: str, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): encode and decode without a list of ids leaving the worker."""
    from pyspark.sql import functions as F

    kind = df.schema[id_column].dataType.simpleString()

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        e, cache = encoder(path, pattern)
        for whole in batches:
            for b in pieces.by_bytes(whole, "_text"):
                n, coded, decoded = [], [], []
                for x in cache.ids([t.decode("utf-8", "replace") for t in b.column("_text").to_pylist()]):
                    ids = np.frombuffer(x, np.int32).tolist()
                    n.append(len(ids))
                    coded.append(hashlib.sha256(",".join(map(e.decimal.__getitem__, ids)).encode()).hexdigest())
                    decoded.append(hashlib.sha256(e.decode(ids)).hexdigest())
                yield pa.RecordBatch.from_arrays([b.column("_id"), pa.array(n, pa.int64()), pa.array(coded, pa.string()), pa.array(decoded, pa.string())], ["_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return df.select(F.col(id_column).alias("_id"), common.text_bytes(text).alias("_text")).mapInArrow(run, f"_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string").withColumnRenamed("_id", id_column)


def op5_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    import public_tokenizers as P

    return digests(common.documents(spark, sf_dir), vocabulary or P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
