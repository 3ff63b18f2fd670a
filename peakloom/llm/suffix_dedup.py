"""Suffix-array dedup: repeated strings of a fixed length, by blockwise construction with a difference cover.

A byte is removed if a `length`-byte string that covers it also starts earlier (in an earlier document, or earlier in the same
one).  Deciding that takes the order of suffixes up to `length` bytes only, and of equal ones only which comes first.  So:

 1. Documents are range-sorted by id and packed into blocks of about BLOCK bytes; whole copies of an earlier text are marked
    and left out (all of their bytes go).  Block and place give every suffix its rank in the order of the input.
 2. Cover samples: the suffixes at places whose residue mod v lies in a difference cover D are sorted by their first
    length - v + 1 bytes, bucket by bucket, and those of equal rank kept.  For any two places there is a shift below v that
    puts both on the cover, so two equal `length`-byte strings hold equal samples at one of these shifts.  Suffixes without
    a sample of shared rank behind them are told apart already and drop out.
 3. The suffixes left are sorted one set of buckets at a time: each round takes the buckets of one residue, so that the
    bytes in flight stay below `share` of the text.  In a bucket, suffixes that tie over `length` bytes form a run, and all
    but the first of the run start a repeat.
 4. Repeats meet their blocks again and become spans.

Buckets and order within them follow a 64-bit fingerprint of the prefix, not the letters: only ties and first places matter
here.  Fingerprints of samples may collide without harm, as samples only thin out what is compared.  Those of step 3 are not
trusted: every place that is said to repeat is compared with the place it repeats, byte for byte, in long stretches; places
whose strings differ are sorted again by another fingerprint until none is left, so the result is exact.

Scale: a suffix never travels with its text.  Samples are 6/31 of the places at about 6 bytes, later suffixes are those near
repeats at about 9 bytes.  A block sends each fingerprint once (twice for samples), so a string that fills a third of the corpus adds one
entry a block.  Buckets hold about a million entries at every size.  A document must fit into a task's memory.

Cases: a null or empty text has no bytes.  Rows with equal ids count in the order of their texts' digests, null ids first; a
repeated row is a copy of the first.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import U64, mix

BLOCK = 2 << 20
#: Stretches asked of a block in one chunk, or four times the mean of all blocks if that is more.
ASKED = 256
#: Bytes of stretches that are compressed together (one that is longer goes alone).
PARCEL = 4 << 20
ROW = "bucket int, block long, marks binary, places binary"


def difference_cover(v: int) -> list[int]:
    """A smallest set of residues whose differences are all residues mod v."""
    size = math.ceil((1 + math.sqrt(4 * v - 3)) / 2)
    while True:
        stack = [([0, 1], {0, 1, v - 1})]
        while stack:
            cover, seen = stack.pop()
            if len(seen) == v:
                return cover
            more = size - len(cover)
            if not more or len(seen) + sum(2 * (len(cover) + i) for i in range(more)) < v:
                continue
            stack += [([*cover, x], seen | {(x - y) % v for y in cover} | {(y - x) % v for y in cover}) for x in range(v - 1, cover[-1], -1)]
        size += 1


def modulus(length: int) -> int:
    return max(3, length * 31 // 100)


_BASE = 0x9E3779B97F4A7C15


@functools.cache
def letters(seed: int) -> tuple[np.ndarray, int]:
    """Random values of the 256 bytes and an odd base; a family of fingerprints, one for each seed."""
    rng = np.random.default_rng(20240501 + seed)
    values = rng.integers(1 << 62, 1 << 63, 256, dtype=np.uint64) | U64(1)
    return values, _BASE if not seed else int(rng.integers(1 << 62, 1 << 63, dtype=np.uint64)) | 1


def window_hashes(text: np.ndarray, width: int, at: np.ndarray | None = None, seed: int = 0) -> np.ndarray:
    """64-bit fingerprints of the width-byte strings that start at each place (or at the places `at`)."""
    n = len(text) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    values, base = letters(seed)
    cur, size = values[text], 1
    out, done = None, 0
    rest = width
    while rest:
        if rest & 1:
            last = rest == 1
            part = cur[done : done + n] if at is None else cur[at + done]
            out = part.copy() if out is None else out * U64(base) + part
            done += size
            if last:
                break
        rest >>= 1
        cur = cur[: len(cur) - size] * U64(base) + cur[size:]
        size, base = 2 * size, base * base & 0xFFFFFFFFFFFFFFFF
    return mix(out)


def same_bytes(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: int) -> np.ndarray:
    """Whether the strings at a and b are equal, byte for byte."""
    window = np.lib.stride_tricks.sliding_window_view(text, length)
    out = np.ones(len(a), bool)
    for i in range(0, len(a), 20_000):
        out[i : i + 20_000] = (window[a[i : i + 20_000]] == window[b[i : i + 20_000]]).all(1)
    return out


def put_places(x: np.ndarray) -> bytes:
    """Rising places as differences, byte planes apart, compressed."""
    import pyarrow as pa

    d = np.diff(x.astype(np.int64), prepend=0).astype("<u4")
    return len(d).to_bytes(4, "little") + pa.compress(np.ascontiguousarray(d.view(np.uint8).reshape(-1, 4).T).tobytes(), "zstd", asbytes=True)


def get_places(data: bytes) -> np.ndarray:
    import pyarrow as pa

    n = int.from_bytes(data[:4], "little")
    if not n:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(pa.decompress(data[4:], 4 * n, "zstd", asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64))


def blocks(docs: DataFrame, length: int, scratch: common.Scratch, id_column: str, text: str, row: str | None) -> DataFrame:
    """(block, ids, rows, sizes, copies, text): packed documents in order; a copy's text is left out."""
    spark = docs.sparkSession
    body = common.text_bytes(text)
    rows = docs.select(F.col(id_column).cast("long").alias("id"), F.unhex(F.sha2(body, 256)).alias("digest"), body.alias("text"), (F.lit(None) if row is None else F.col(row)).cast("long").alias("row"))
    same = rows.filter(F.length("text") >= length).groupBy("digest").agg(F.min(F.coalesce("id", F.lit(-(2**63)))).alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    later = rows.filter(F.length("text") >= length).select("id", "digest").join(scratch.table(same, "same"), "digest").filter("id > first").select("id", "digest").distinct()
    later = scratch.table(later, "copies")
    null = F.lit(None).cast("binary")
    both = rows.select("id", "digest", F.lit(1).alias("kind"), "text", "row").unionByName(later.select("id", "digest", F.lit(0).alias("kind"), null.alias("text"), F.lit(None).cast("long").alias("row")))
    both = both.repartitionByRange(common.shuffle_partitions(spark), "id", "digest").sortWithinPartitions("id", "digest", "kind", "row")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, number, copy, last = TaskContext.get().partitionId(), 0, None, None
        ids, own, sizes, copies, held, size = [], [], [], [], [], 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, own, sizes, copies, held, size, number
            row = {"block": (part << 32) + number, "ids": ids, "rows": own, "sizes": sizes, "copies": copies, "text": b"".join(held)}
            ids, own, sizes, copies, held, size, number = [], [], [], [], [], 0, number + 1
            return pa.RecordBatch.from_pylist([row], pa.schema([("block", pa.int64()), ("ids", pa.list_(pa.int64())), ("rows", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())), ("copies", pa.list_(pa.bool_())), ("text", pa.binary())]))

        for whole in batches:
            for b in common.batches(iter([whole]), 64):
                for i, digest, kind, t, number_ in zip(*[b.column(c).to_pylist() for c in ("id", "digest", "kind", "text", "row")], strict=True):
                    if kind == 0:
                        copy = (i, digest)
                        continue
                    again = len(t) >= length and (copy == (i, digest) or last == (i, digest))
                    last = (i, digest)
                    ids.append(i)
                    own.append(number_)
                    sizes.append(len(t))
                    copies.append(again)
                    if not again:
                        held.append(t)
                        size += len(t)
                    if size >= BLOCK or len(ids) >= 50_000:
                        yield flush()
        if ids:
            yield flush()

    out = scratch.table(both.mapInArrow(run, "block long, ids array<long>, rows array<long>, sizes array<long>, copies array<boolean>, text binary"), "blocks")
    scratch.drop(later)
    return out


def bounds(sizes: list[int], copies: list[bool]) -> np.ndarray:
    """Where each document's text ends in its block (copies have none)."""
    return np.cumsum(np.where(np.array(copies, bool), 0, np.array(sizes, np.int64)))


def room(ends: np.ndarray, n: int) -> np.ndarray:
    """Bytes from each place to the end of its document."""
    return np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)


def ship(block: int, marks: np.ndarray, places: np.ndarray, bucket: np.ndarray, dtype: str, known: np.ndarray, buckets: int):
    """One row for each bucket, and one (marks null) with the places already known to repeat."""
    import pyarrow as pa

    small = bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32)
    order = np.argsort(small, kind="stable")
    bucket, marks, places = bucket[order], marks[order], places[order]
    cuts = np.flatnonzero(np.diff(bucket)) + 1
    rows: list[tuple] = []
    if len(bucket):
        rows = [(int(bucket[a]), block, marks[a:z].astype(dtype).tobytes(), put_places(places[a:z])) for a, z in zip([0, *cuts], [*cuts, len(bucket)], strict=True)]
    if len(known):
        rows.append((int(mix(np.array([block], np.uint64))[0] % U64(buckets)), block, None, put_places(np.sort(known))))
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows, strict=True) if rows else ((), (), (), ()), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)], ["bucket", "block", "marks", "places"])


def sample(rows: DataFrame, length: int, v: int, buckets: int) -> DataFrame:
    """Cover samples by bucket, with 32 bits of their fingerprint beside the bucket's."""
    cover, width = difference_cover(v), length - v + 1

    def run(batches: Iterator) -> Iterator:
        on = np.zeros(v, bool)
        on[cover] = True
        for b in batches:
            for block, sizes, copies, data in zip(*[b.column(c).to_pylist() for c in ("block", "sizes", "copies", "text")], strict=True):
                text = np.frombuffer(data, np.uint8)
                left = room(bounds(sizes, copies), len(text))
                at = np.flatnonzero((left >= width) & np.resize(on, len(text)))
                if not len(at):
                    continue
                h = window_hashes(text, width, at)
                order = np.argsort(h, kind="stable")
                h, at = h[order], at[order]
                third = np.zeros(len(h), bool)
                third[2:] = h[2:] == h[:-2]
                known = at[third]
                h, at = h[~third], at[~third]
                order = np.argsort(at)
                h, at = h[order], at[order]
                yield ship(block, h, at, ((h >> U64(32)) % U64(buckets)).astype(np.int64), "<u4", known, buckets)

    return rows.select("block", "sizes", "copies", "text").mapInArrow(run, ROW)


def settle(dtype: str, first_too: bool):
    """Places of a bucket whose mark occurs elsewhere: all of them (first_too), or all but the first in the input's order."""

    def run(table):
        import pyarrow as pa

        table = table.sort_by("block")
        block, marks, places = (table.column(c).to_pylist() for c in ("block", "marks", "places"))
        out_b, out_p = [b for b, m in zip(block, marks, strict=True) if m is None], [p for p, m in zip(places, marks, strict=True) if m is None]
        block, places = [b for b, m in zip(block, marks, strict=True) if m is not None], [get_places(p) for p, m in zip(places, marks, strict=True) if m is not None]
        mark = np.concatenate([np.zeros(0, dtype), *[np.frombuffer(m, dtype) for m in marks if m is not None]])
        order = np.argsort(mark, kind="stable")
        x = mark[order]
        as_last = np.zeros(len(x), bool)
        as_last[1:] = x[1:] == x[:-1]
        hit = as_last.copy()
        if first_too and len(x):
            hit[:-1] |= as_last[1:]
        repeats = np.zeros(len(x), bool)
        repeats[order[hit]] = True
        at = 0
        for b, p in zip(block, places, strict=True):
            found = p[repeats[at : at + len(p)]]
            at += len(p)
            if len(found):
                out_b.append(b)
                out_p.append(put_places(found))
        return pa.table({"block": pa.array(out_b, pa.int64()), "places": pa.array(out_p, pa.binary())})

    return run


def meet(rows: DataFrame, places: DataFrame, run, schema: str) -> DataFrame:
    """Blocks with the places found for them: run(block row, sorted places) yields Arrow batches."""
    null = lambda kind: F.lit(None).cast(kind)
    said = places.select("block", F.lit(0).alias("kind"), "places", null("array<long>").alias("ids"), null("array<long>").alias("rows"), null("array<long>").alias("sizes"), null("array<boolean>").alias("copies"), null("binary").alias("text"))
    own = rows.select("block", F.lit(1).alias("kind"), null("binary").alias("places"), "ids", "rows", "sizes", "copies", "text")
    both = said.unionByName(own).repartition(common.shuffle_partitions(rows.sparkSession), "block").sortWithinPartitions("block", "kind")

    def stream(batches: Iterator) -> Iterator:
        held: list[np.ndarray] = []
        for whole in batches:
            for b in common.batches(iter([whole]), 32):
                for r in b.to_pylist():
                    if r["kind"] == 0:
                        held.append(get_places(r["places"]))
                    else:
                        yield from run(r, np.sort(np.concatenate([np.zeros(0, np.int64), *held])))
                        held = []

    return both.mapInArrow(stream, schema)


def zones(length: int, v: int):
    """The stretches of a block whose suffixes have a sample of shared rank within v places, with the text they need."""

    def run(r: dict, at: np.ndarray) -> Iterator:
        import pyarrow as pa

        if not len(at):
            return
        text = np.frombuffer(r["text"], np.uint8)
        ends = bounds(r["sizes"], r["copies"])
        step = np.zeros(len(text) + 1, np.int32)
        np.add.at(step, np.maximum(at - v + 1, 0), 1)
        np.add.at(step, at + 1, -1)
        on = (np.cumsum(step[:-1]) > 0) & (room(ends, len(text)) >= length)
        edge = np.flatnonzero(np.diff(np.concatenate([[False], on, [False]]).astype(np.int8)))
        start, stop = edge[::2], edge[1::2]
        # a stretch may run on into the next document; the place where a document begins cuts it
        if len(start):
            pieces = b"".join(r["text"][a : z + length - 1] for a, z in zip(start.tolist(), stop.tolist(), strict=True))
            yield pa.RecordBatch.from_pylist([{"block": r["block"], "start": start.tolist(), "size": (stop - start).tolist(), "text": pieces}], pa.schema([("block", pa.int64()), ("start", pa.list_(pa.int64())), ("size", pa.list_(pa.int64())), ("text", pa.binary())]))

    return run


def suffixes(rows: DataFrame, length: int, buckets: int, rounds: int, turn: int, seed: int = 0, bits: int = 64) -> DataFrame:
    """The suffixes of the buckets whose turn it is, by bucket, with so many bits of fingerprint.

    A suffix whose string an earlier one of the block holds, byte for byte, is known to repeat and stays at home.
    """

    def run(batches: Iterator) -> Iterator:
        for b in batches:
            for block, start, size, data in zip(*[b.column(c).to_pylist() for c in ("block", "start", "size", "text")], strict=True):
                text, start, size = np.frombuffer(data, np.uint8), np.array(start, np.int64), np.array(size, np.int64)
                inside = np.cumsum(size + length - 1) - (size + length - 1)
                k = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
                spot = np.repeat(inside, size) + k
                h = window_hashes(text, length, None, seed)[spot] >> U64(64 - bits)
                at = np.repeat(start, size) + k
                bucket = ((mix(h + U64(_BASE)) >> U64(24)) % U64(buckets)).astype(np.int64)
                if rounds > 1:
                    mine = bucket % rounds == turn
                    h, at, bucket, spot = h[mine], at[mine], bucket[mine], spot[mine]
                order = np.argsort(h, kind="stable")
                x = h[order]
                again = np.zeros(len(x), bool)
                again[1:] = x[1:] == x[:-1]
                first = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(x))))]
                later = order[again]
                known = np.zeros(len(x), bool)
                known[later[same_bytes(text, spot[later], spot[first[again]], length)]] = True
                yield ship(block, h[~known], at[~known], bucket[~known], "<u8", at[known], buckets)

    return rows.mapInArrow(run, ROW)


def squeezed(x: np.ndarray) -> bytes:
    import pyarrow as pa

    return pa.compress(x.tobytes(), "zstd", asbytes=True)


def claims(table):
    """Of each run of equal fingerprints in a bucket, all but the first with that one's block and place: (block, places, ref_blocks,
    ref_places); places that are known to repeat have no reference."""
    import pyarrow as pa

    table = table.sort_by("block")
    block, marks, places = (table.column(c).to_pylist() for c in ("block", "marks", "places"))
    known = [(b, p) for b, m, p in zip(block, marks, places, strict=True) if m is None]
    rows = [(b, np.frombuffer(m, np.uint64), get_places(p)) for b, m, p in zip(block, marks, places, strict=True) if m is not None]
    mark = np.concatenate([np.zeros(0, np.uint64), *[m for _, m, _ in rows]])
    place = np.concatenate([np.zeros(0, np.int64), *[p for _, _, p in rows]])
    of = np.repeat(np.array([b for b, _, _ in rows], np.int64), [len(p) for _, _, p in rows])
    order = np.argsort(mark, kind="stable")
    x = mark[order]
    again = np.zeros(len(x), bool)
    again[1:] = x[1:] == x[:-1]
    first = np.empty(len(x), np.int64)
    first[order] = order[np.maximum.accumulate(np.where(again, 0, np.arange(len(x))))]
    repeats = np.zeros(len(x), bool)
    repeats[order[again]] = True
    out, at = [(b, p, None, None) for b, p in known], 0
    for b, m, p in rows:
        mine = at + np.flatnonzero(repeats[at : at + len(m)])
        at += len(m)
        if len(mine):
            out.append((b, put_places(place[mine]), squeezed(of[first[mine]]), squeezed(place[first[mine]].astype("<u4"))))
    kinds = (pa.int64(), pa.binary(), pa.binary(), pa.binary())
    return pa.table({n: pa.array(c, k) for n, c, k in zip(("block", "places", "ref_blocks", "ref_places"), zip(*out, strict=True) if out else ((), (), (), ()), kinds, strict=True)})


def diagonals(table):
    """A block's claims as stretches: the n strings from `at` on are said to equal those from `start` on in the block `ref`."""
    import pyarrow as pa

    at, ref, start = [], [], []
    for p, b, q in zip(*[table.column(c).to_pylist() for c in ("places", "ref_blocks", "ref_places")], strict=True):
        at.append(get_places(p))
        n = len(at[-1])
        ref.append(np.frombuffer(pa.decompress(b, 8 * n, "zstd", asbytes=True), np.int64))
        start.append(np.frombuffer(pa.decompress(q, 4 * n, "zstd", asbytes=True), "<u4").astype(np.int64))
    at, ref, start = np.concatenate(at), np.concatenate(ref), np.concatenate(start)
    order = np.argsort(at, kind="stable")
    at, ref, start = at[order], ref[order], start[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) != 1) | (np.diff(ref) != 0) | (np.diff(start) != 1)
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(at)))
    block = table.column("block")[0].as_py()
    return pa.table({"block": pa.array([block] * len(first), pa.int64()), "at": pa.array(at[first], pa.int64()), "ref": pa.array(ref[first], pa.int64()), "start": pa.array(start[first], pa.int64()), "n": pa.array(n, pa.int64())})


def beside(rows: DataFrame, asked: DataFrame, run, schema: str) -> DataFrame:
    """run(text of the block, what is asked of it, a batch at a time) -> rows, where asked (written) names blocks in `key`.

    A block's text comes before what is asked of it, so only the text is held.  A block of which much is asked (the first to hold
    a passage that many share) is several chunks, each with the text: no more than a quarter of the text again in all.
    """
    most = max(ASKED, math.ceil(4 * asked.count() / max(1, rows.count())))
    hot = asked.groupBy("key").agg(F.ceil(F.count("*") / most).alias("_chunks")).filter("_chunks > 1")
    last = F.coalesce("_chunks", F.lit(1)) - 1
    text = rows.select(F.col("block").alias("key"), "text").join(hot, "key", "left")
    text = text.select("key", F.lit(0).alias("_kind"), F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("_chunk"), "text")
    dealt = asked.join(hot, "key", "left").withColumns({"_kind": F.lit(1), "_chunk": F.pmod(F.xxhash64(*asked.columns), last + 1)}).drop("_chunks")
    both = text.unionByName(dealt, allowMissingColumns=True)
    both = both.repartition(common.shuffle_partitions(rows.sparkSession), "key", "_chunk").sortWithinPartitions("key", "_chunk", "_kind")

    def stream(batches: Iterator) -> Iterator:
        held: bytes = b""
        for b in batches:
            kind = b.column("_kind").to_numpy()
            for a, z in stretches(kind):
                if kind[a] == 0:
                    held = b.column("text")[z - 1].as_py()
                    continue
                key, some = b.column("key").slice(a, z - a).to_numpy(), b.slice(a, z - a)
                yield run(held, int(key[0]), some)

    return both.mapInArrow(stream, schema)


def stretches(kind: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of equal values."""
    cuts = np.flatnonzero(np.diff(kind)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(kind)], strict=True)) if len(kind) else []


def parcels(block: np.ndarray, size: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of one block in a sorted array, cut where another PARCEL bytes are full."""
    full = np.cumsum(size) // PARCEL
    cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(full) != 0)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(block)], strict=True)) if len(block) else []


def fetched(length: int):
    """(key, at, size, bytes): the bytes that a block's stretches are said to repeat, addressed to that block.

    Stretches for one block travel together, those from one place side by side, compressed: a passage that many share is asked
    for as often, and would fill the shuffle if each answer were a row of its own.
    """

    def run(text: bytes, key: int, b):
        import pyarrow as pa

        block, at, start = (b.column(c).to_numpy() for c in ("block", "at", "start"))
        size = b.column("n").to_numpy() + length - 1
        order = np.lexsort((start, block))
        block, at, start, size = block[order], at[order], start[order], size[order]
        out: dict[str, list] = {"key": [], "at": [], "size": [], "bytes": []}
        for a, z in parcels(block, size):
            data = b"".join(text[s : s + n] for s, n in zip(start[a:z].tolist(), size[a:z].tolist(), strict=True))
            for c, x in zip(out, (int(block[a]), at[a:z], size[a:z], pa.compress(data, "zstd", asbytes=True)), strict=True):
                out[c].append(x)
        kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in zip(out, kinds, strict=True)], list(out))

    return run


def differing(length: int):
    """(block, places) of strings that differ from the bytes they are said to equal."""

    def run(text: bytes, key: int, b):
        import pyarrow as pa

        out = []
        for ats, sizes, data in zip(*[b.column(c).to_pylist() for c in ("at", "size", "bytes")], strict=True):
            whole, to = pa.decompress(data, sum(sizes), "zstd", asbytes=True), 0
            for at, n in zip(ats, sizes, strict=True):
                own, said, to = text[at : at + n], whole[to : to + n], to + n
                if own != said:
                    wrong = np.frombuffer(own, np.uint8) != np.frombuffer(said, np.uint8)
                    out.append(put_places(at + np.flatnonzero(np.convolve(wrong, np.ones(length, np.int64), "valid") > 0)))
        return pa.RecordBatch.from_arrays([pa.array([key] * len(out), pa.int64()), pa.array(out, pa.binary())], ["block", "places"])

    return run


def without(table):
    """A block's places but for those of its rows marked as taken out."""
    import pyarrow as pa

    rows = list(zip(table.column("places").to_pylist(), table.column("out").to_pylist(), strict=True))
    kept, gone = (np.concatenate([np.zeros(0, np.int64), *[get_places(p) for p, o in rows if o == k]]) for k in (False, True))
    return pa.table({"block": pa.array([table.column("block")[0].as_py()], pa.int64()), "places": pa.array([put_places(np.setdiff1d(kept, gone))], pa.binary())})


def verified(packed: DataFrame, found: DataFrame, length: int, scratch: common.Scratch) -> DataFrame:
    """The places of found whose string differs from the one they are said to repeat: (block, places).

    Bytes are compared in long stretches: each is cut from the block it is said to repeat and sent to its own block.
    """
    asked = found.filter("ref_blocks is not null").groupBy("block").applyInArrow(diagonals, "block long, at long, ref long, start long, n long")
    asked = scratch.table(asked.withColumnRenamed("ref", "key"), "asked")
    said = scratch.table(beside(packed, asked, fetched(length), "key long, at array<long>, size array<long>, bytes binary"), "said")
    out = scratch.table(beside(packed, said, differing(length), "block long, places binary"), "differing")
    scratch.drop(asked, said)
    return out


def exactly(length: int):
    """The stretches of a block's places given, with their text."""

    def run(r: dict, at: np.ndarray) -> Iterator:
        import pyarrow as pa

        at = np.unique(at)
        if not len(at):
            return
        first = np.flatnonzero(np.append(True, np.diff(at) != 1))
        start, size = at[first], np.diff(np.append(first, len(at)))
        text = b"".join(r["text"][a : a + n + length - 1] for a, n in zip(start.tolist(), size.tolist(), strict=True))
        yield pa.RecordBatch.from_pylist([{"block": r["block"], "start": start.tolist(), "size": size.tolist(), "text": text}], pa.schema([("block", pa.int64()), ("start", pa.list_(pa.int64())), ("size", pa.list_(pa.int64())), ("text", pa.binary())]))

    return run


OUT = "id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, row long"


def cut(length: int, with_text: bool):
    """Per document of a block: what goes and what stays."""

    def run(r: dict, at: np.ndarray) -> Iterator:
        import pyarrow as pa

        data = r["text"]
        step = np.zeros(len(data) + 1, np.int32)
        np.add.at(step, at, 1)
        np.add.at(step, np.minimum(at + length, len(data)), -1)
        gone = np.cumsum(step[:-1]) > 0
        out: dict[str, list] = {c: [] for c in ("id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "row", "kept_text", "spans")}
        ends = bounds(r["sizes"], r["copies"]).tolist()
        text = np.frombuffer(data, np.uint8)
        for i, number, n, copy, end in zip(r["ids"], r["rows"], r["sizes"], r["copies"], ends, strict=True):
            if copy:
                spans, kept, removed = [[0, n]], b"", n
            else:
                g = gone[end - n : end]
                edge = np.flatnonzero(np.diff(np.concatenate([[False], g, [False]]).astype(np.int8)))
                spans = np.stack([edge[::2], edge[1::2]], 1).tolist()
                removed = int(g.sum())
                kept = data[end - n : end] if not removed else text[end - n : end][~g].tobytes()
            for c, x in zip(out, (i, n, removed, len(spans), hashlib.sha256(kept).hexdigest(), number, kept.decode(errors="ignore") if with_text else None, spans), strict=True):
                out[c].append(x)
        kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()] + [pa.string(), pa.list_(pa.list_(pa.int64()))] * with_text
        yield pa.RecordBatch.from_arrays([pa.array(out[c], k) for c, k in zip(out, kinds, strict=False)], list(out)[: len(kinds)])

    return run


def dedup(docs: DataFrame, length: int = 100, share: float = 0.9, with_text: bool = False, verify: bool = True, bits: int = 64, id_column: str = "doc_id", text: str = "text", row: str | None = None) -> DataFrame:
    """(id, n_bytes, n_removed, n_spans, kept_sha256), a row a document; with_text adds kept_text (parts of
    characters at the cuts left out) and spans ([from, to) pairs in bytes), row a column of integers that names rows.
    verify compares the bytes of strings that share a fingerprint (its first kind has so many bits); without it these decide."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    packed = blocks(docs, length, scratch, id_column, text, row)
    total = packed.agg(F.sum(F.length("text"))).first()[0] or 0
    v = modulus(length)
    near = total * len(difference_cover(v)) / v
    buckets = max(common.shuffle_partitions(spark), math.ceil(near / 1e6))
    shared = scratch.table(sample(packed, length, v, buckets).groupBy("bucket").applyInArrow(settle("<u4", True), "block long, places binary"), "samples")
    left = scratch.table(meet(packed, shared, zones(length, v), "block long, start array<long>, size array<long>, text binary"), "zones")
    scratch.drop(shared)
    n = left.agg(F.sum(F.aggregate("size", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    rounds = max(1, math.ceil(n * 9.5 / max(1.0, share * total)))
    buckets = rounds * max(common.shuffle_partitions(spark), math.ceil(n / rounds / 1e6))
    found = None
    kinds = "block long, places binary, ref_blocks binary, ref_places binary"
    for turn in range(rounds):  # one set of suffix buckets at a time
        now = scratch.table(suffixes(left, length, buckets, rounds, turn, 0, bits).groupBy("bucket").applyInArrow(claims, kinds), "repeats")
        found = now if found is None else found.unionByName(now)
    scratch.drop(left)
    settled, seed = None, 0
    while verify:
        wrong = verified(packed, found, length, scratch)
        if wrong.isEmpty():
            break
        # strings that share a fingerprint and differ: these places are sorted again, by another fingerprint
        both = found.select("block", "places", F.lit(False).alias("out")).unionByName(wrong.withColumn("out", F.lit(True)))
        good = scratch.table(both.groupBy("block").applyInArrow(without, "block long, places binary"), "settled")
        settled, seed = good if settled is None else settled.unionByName(good), seed + 1
        left = scratch.table(meet(packed, wrong, exactly(length), "block long, start array<long>, size array<long>, text binary"), "open")
        found = scratch.table(suffixes(left, length, buckets, 1, 0, seed).groupBy("bucket").applyInArrow(claims, kinds), "repeats")
        scratch.drop(left, wrong)
    found = found.select("block", "places")
    if settled is not None:
        found = found.unionByName(settled)
    schema = OUT + (", kept_text string, spans array<array<long>>" if with_text else "")
    out = meet(packed, found, cut(length, with_text), schema).withColumnRenamed("id", id_column)
    return out.drop("row") if row is None else out.withColumnRenamed("row", row)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(common.documents(spark, sf_dir), length=100)
