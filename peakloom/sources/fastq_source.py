"""FASTQ as a Spark data source that reads plain files by byte ranges.

A range owns the records whose header line begins inside it.  It starts at the first line that begins at or after its first byte
and finds the first record by its shape: a line with '@' and, two lines on, one with '+'.  A quality line may begin with either
letter, but the line two after a quality line is a sequence, which begins with neither, so only headers have that shape.  The
range's last record is read to its end, beyond the range, so no record is cut and none is read twice.

Memory is a chunk and a record, whatever the size of the file.  A compressed file (by its name) is one range.  Files are opened
by pyarrow under the path's scheme, on the executors; the driver only lists them.

Up to TASKS ranges are a task each.  More are dealt to tasks in stretches of neighbours, to TASKS tasks or as many as hold
taskBytes each, so that tasks grow with the bytes and not with the number of ranges.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "read_id string, seq string, qual string"
COMPRESSED = (".gz", ".bgz", ".bz2", ".zst", ".lz4")
CHUNK = 1 << 20
TASKS = 512
TAIL = 4096
"""Bytes read with a short range for the end of its last record."""


@dataclass
class Range(InputPartition):
    path: str
    first: int
    end: int | None
    """One past the last byte; None for a compressed file, read as a whole."""


@dataclass
class Stretch(InputPartition):
    """A task's part: bytes of files in order, each to be read in ranges of `split` bytes."""

    parts: list[Range]
    split: int

    def ranges(self) -> Iterator[Range]:
        for p in self.parts:
            if p.end is None:
                yield p
            else:
                yield from (Range(p.path, at, min(at + self.split, p.end)) for at in range(p.first, p.end, self.split))


class FastqSource(DataSource):
    """spark.read.format("fastq").option("splitBytes", n).load(path): a file, a folder of files, or several joined by commas."""

    @classmethod
    def name(cls) -> str:
        return "fastq"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FastqReader:
        split = int(self.options.get("splitBytes", 128 << 20))
        return FastqReader(self.options["path"].split(","), split, int(self.options.get("taskBytes", 128 << 20)))


class FastqReader(DataSourceReader):
    def __init__(self, paths: list[str], split: int, task_bytes: int = 128 << 20):
        self.paths, self.split, self.task_bytes = paths, max(1, split), task_bytes

    def partitions(self) -> list[Stretch]:
        found = [(name, size, name.endswith(COMPRESSED)) for path in self.paths for name, size in files(path)]
        number = sum(1 if whole else -(-size // self.split) for _, size, whole in found)
        tasks = max(1, TASKS, -(-sum(size for _, size, _ in found) // max(1, self.task_bytes)))
        step = -(-number // tasks) * self.split  # bytes of a task, in whole ranges
        out, left = [], 0
        for name, size, whole in found:
            if whole:
                out.append(Stretch([Range(name, 0, None)], self.split))
                left = 0
                continue
            at = 0
            while at < size:
                if left <= 0:
                    out.append(Stretch([], self.split))
                    left = step
                end = min(size, at + left)
                out[-1].parts.append(Range(name, at, end))
                left -= -(-(end - at) // self.split) * self.split
                at = end
        return out or [Stretch([], self.split)]

    def read(self, partition: Stretch) -> Iterator:
        for part in partition.ranges():
            yield from self.batches(part)

    def batches(self, part: Range) -> Iterator:
        import pyarrow as pa

        for head, seq, qual in records(part):
            columns = [pa.array(x, pa.binary()).cast(pa.string()) for x in ([(h.split(None, 1) or [b""])[0] for h in head], seq, qual)]
            yield pa.RecordBatch.from_arrays(columns, ["read_id", "seq", "qual"])


def system(path: str):
    """A pyarrow file system and the path in it."""
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem(), os.path.abspath(path.removeprefix("file:"))
    scheme, rest = path.split("://", 1)
    return fs.FileSystem.from_uri(f"{ {'s3a': 's3', 's3n': 's3', 'abfs': 'abfss'}.get(scheme, scheme)}://{rest}")


def files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files below a folder, or of the file itself; hidden and bookkeeping names are left out."""
    from pyarrow import fs

    where, inner = system(path)
    info = where.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    prefix = path.removesuffix(inner) if path.endswith(inner) else ""
    if info.type == fs.FileType.File:
        return [(path, info.size)]
    found = where.get_file_info(fs.FileSelector(inner, recursive=True))
    return sorted((prefix + f.path, f.size) for f in found if f.type == fs.FileType.File and not f.base_name.startswith(("_", ".")))


def records(part: Range) -> Iterator[tuple[list[bytes], list[bytes], list[bytes]]]:
    """Header (without '@'), sequence and quality lines of the range's records, chunk by chunk."""
    where, inner = system(part.path)
    if part.end is None:
        stream, at = where.open_input_stream(inner, compression="detect"), 0
    else:
        stream = where.open_input_file(inner)
        at = max(0, part.first - 1)  # a line that begins at the range's first byte follows a line end
        stream.seek(at)
    chunk = CHUNK if part.end is None else min(CHUNK, part.end - at + TAIL)
    with stream:
        rest, synced, ended = b"", part.first == 0, False
        if not synced:
            while (cut := rest.find(b"\n")) < 0 and (more := stream.read(chunk)):
                rest += more
            if cut < 0:
                return
            rest, at = rest[cut + 1 :], at + cut + 1
        if part.end is not None and at >= part.end:
            return
        while not ended:
            more = stream.read(chunk)
            ended = not more
            buffer = rest + more
            if ended and buffer and not buffer.endswith(b"\n"):
                buffer += b"\n"
            lines = buffer.split(b"\n")
            rest = lines.pop()  # what follows the last line end
            if not synced:
                if len(lines) < 7 and not ended:  # a record begins in the first four lines and has four
                    rest = buffer
                    continue
                skip = next((i for i in range(min(4, len(lines) - 3)) if lines[i][:1] == b"@" and lines[i + 2][:1] == b"+"), None)
                if skip is None:
                    if ended:
                        return
                    if not b"".join(lines[4:]).strip():  # blank lines, perhaps to the file's end
                        rest = buffer
                        continue
                    raise ValueError(f"no FASTQ record after byte {at} of {part.path}")
                at += sum(map(len, lines[:skip])) + skip
                lines, synced = lines[skip:], True
            if ended:
                lines = without_blank_end(lines)
            n = len(lines) // 4 * 4
            while n and not b"".join(lines[n - 4 : n]).strip():  # blank lines wait for what follows
                n -= 4
            if ended and n < len(lines):
                raise ValueError(f"a FASTQ record is cut off at the end of {part.path}")
            rest = b"\n".join([*lines[n:], rest])
            head, seq, plus, qual = lines[0:n:4], lines[1:n:4], lines[2:n:4], lines[3:n:4]
            if part.end is not None:
                keep, place = 0, at
                for a, b, c, d in zip(head, seq, plus, qual, strict=True):
                    if place >= part.end:
                        ended = True
                        break
                    place += len(a) + len(b) + len(c) + len(d) + 4
                    keep += 1
                head, seq, plus, qual, at = head[:keep], seq[:keep], plus[:keep], qual[:keep], place
            head, seq, plus, qual = ([x[:-1] if x[-1:] == b"\r" else x for x in column] for column in (head, seq, plus, qual))
            for h, s, p, q in zip(head, seq, plus, qual, strict=True):
                if h[:1] != b"@" or p[:1] != b"+" or len(s) != len(q):
                    raise ValueError(f"not a FASTQ record in {part.path}: {h[:80]!r}")
            if head:
                yield [h[1:] for h in head], seq, qual


def without_blank_end(lines: list[bytes]) -> list[bytes]:
    """Lines without blank ones after the last record; those of an empty read stay."""
    while lines and not lines[-1].strip() and (len(lines) % 4 or not b"".join(lines[-4:]).strip()):
        lines = lines[:-1]
    return lines
