"""WARC files: a deterministic sharded writer and a reader.

Writing: records are range-sorted by page id; each task writes members of one gzip stream a record, rolls to a new file when
the compressed size passes `roll_bytes`, writes under a temporary name, renames, and returns manifest rows.  Headers are made
from the rows alone (record ids are name-based UUIDs, the date is a parameter), so a rerun writes the same bytes.  Only files
that the manifest names count; a task that runs twice does no harm.

Of records with equal payloads of at least `least` bytes the one with the largest page id is a response, the others are
revisits of it.  That is settled on (page id, digest, size) alone; payloads move once, in the range sort.  A digest that a
third of all pages share is counted before the shuffle, and its rows reach the join in salted parts.

Cases: a null payload is empty.  A null page id sorts first, is never the largest unless all are null, and is written without
the page-id field.  Rows that repeat the largest page id with the same payload are responses each.  Empty and small payloads
are responses each.  Control characters in a URL are percent-encoded in the header.  An empty table writes no files.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

NAMES = uuid.UUID("7d3fcb1e-55a4-4a6e-9b57-0f3c8f6f5b10")
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "part int, file int, path string, records long, bytes long"
SALTS = 32


def decide(pages: DataFrame, least: int, id_column: str = "page_id", payload: str = "html") -> DataFrame:
    """(page_id, digest, refers_to) of the records that are revisits."""
    body = common.text_bytes(payload)
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.sha1(body).alias("digest"), F.length(body).alias("n")).filter(F.col("n") >= least)
    last = rows.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).filter("n > 1").drop("n")
    last = last.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("page_id"), F.lit(SALTS).cast("long")))
    return rows.join(last, ["digest", "salt"]).filter(F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))).select("page_id", "digest", "refers_to").distinct()


def record_id(page_id: int | None, digest: str, url: str | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMES, f'{page_id}|{digest}' if page_id is not None else f'|{digest}|{url}')}>"


def safe(url: str | None) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url or "")


def base32(sha1_hex: str) -> str:
    return "sha1:" + base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id, digest, url)}", f"WARC-Date: {date}", f"WARC-Target-URI: {safe(url)}"]
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to, digest, None)}", f"X-Refers-To-Page-Id: {refers_to}"]
    head += [f"WARC-Payload-Digest: {base32(digest)}", f"WARC-Block-Digest: {base32(hashlib.sha1(block).hexdigest())}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def info(date: str) -> bytes:
    body = b"format: WARC File Format 1.1\r\n"
    head = f"WARC/1.1\r\nWARC-Type: warcinfo\r\nWARC-Record-ID: <urn:uuid:{uuid.uuid5(NAMES, 'warcinfo')}>\r\nWARC-Date: {date}\r\nContent-Type: application/warc-fields\r\nContent-Length: {len(body)}\r\n\r\n"
    return head.encode() + body + b"\r\n\r\n"


def member(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def write(pages: DataFrame, folder: str, least: int = 1000, roll_bytes: int = 64 << 20, date: str = "2000-01-01T00:00:00Z", level: int = 6, id_column: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """Writes the archive under `folder` (a URI) and returns its manifest as a written table."""
    spark = pages.sparkSession
    scratch = common.Scratch(spark)
    revisits = scratch.table(decide(pages, least, id_column, payload), "revisits")
    body = common.text_bytes(payload)
    rows = pages.select(F.col(id_column).cast("long").alias("page_id"), F.sha1(body).alias("digest"), F.lit(1).alias("kind"), F.col(url).alias("url"), body.alias("payload"), F.lit(None).cast("long").alias("refers_to"))
    said = revisits.select("page_id", "digest", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "refers_to")
    rows = rows.unionByName(said).repartitionByRange(common.shuffle_partitions(spark), "page_id", "digest").sortWithinPartitions("page_id", "digest", "kind", "url")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        part, file, held, size, records, last = TaskContext.get().partitionId(), 0, [], 0, 0, (None, None, None)

        def roll() -> pa.RecordBatch:
            nonlocal file, held, size, records
            path = put(folder, f"pages-{part:06d}-{file:06d}.warc.gz", held)
            row = {"part": part, "file": file, "path": path, "records": records, "bytes": size}
            file, held, size, records = file + 1, [], 0, 0
            return pa.RecordBatch.from_pylist([row], pa.schema([("part", pa.int32()), ("file", pa.int32()), ("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())]))

        for whole in batches:
            for b in common.batches(iter([whole]), 128):
                for r in b.to_pylist():
                    if r["kind"] == 0:
                        last = (r["page_id"], r["digest"], r["refers_to"])
                        continue
                    refers_to = last[2] if (r["page_id"], r["digest"]) == last[:2] else None
                    if not held:
                        held.append(member(info(date), level))
                        size = len(held[0])
                    held.append(member(record(r["page_id"], r["url"], r["payload"], r["digest"], refers_to, date), level))
                    size, records = size + len(held[-1]), records + 1
                    if size >= roll_bytes:
                        yield roll()
        if held:
            yield roll()

    out = scratch.table(rows.mapInArrow(run, MANIFEST), "manifest")
    scratch.drop(revisits)
    return out


def put(uri: str, name: str, parts: list[bytes]) -> str:
    fs, place = common.local_path(uri)
    fs.create_dir(place, recursive=True)
    temporary = f"{place}/_{name}.{uuid.uuid4().hex}"
    with fs.open_output_stream(temporary, compression=None) as f:
        for p in parts:
            f.write(p)
    fs.move(temporary, f"{place}/{name}")
    return f"{uri}/{name}"


def members(stream, chunk: int = 1 << 18) -> Iterator[bytes]:
    """The records of a .warc.gz stream, one at a time."""
    rest, d, out = b"", zlib.decompressobj(31), []
    while True:
        data = rest or stream.read(chunk)
        if not data:
            break
        out.append(d.decompress(data))
        rest = d.unused_data
        if d.eof:
            yield b"".join(out)
            d, out = zlib.decompressobj(31), []
    if out and any(out):
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if "WARC-Block-Digest" in fields and fields["WARC-Block-Digest"] != base32(hashlib.sha1(block).hexdigest()):
        raise ValueError(f"wrong block digest: {fields['WARC-Record-ID']}")
    return fields, block


def read(manifest: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload) from the files; a revisit's payload is null."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        kind = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])
        for b in batches:
            for path in b.column("path").to_pylist():
                fs, place = common.local_path(path)
                rows = []
                with fs.open_input_stream(place, compression=None) as f:
                    for data in members(f):
                        fields, block = parse(data)
                        if fields["WARC-Type"] == "warcinfo":
                            continue
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                        revisit = fields["WARC-Type"] == "revisit"
                        if not revisit and hashlib.sha1(payload).hexdigest() != digest:
                            raise ValueError(f"wrong payload digest: {fields['WARC-Record-ID']}")
                        n = int(http.decode().rsplit("Content-Length: ", 1)[1].split("\r\n")[0])
                        number = lambda k: int(fields[k]) if k in fields else None  # noqa: E731, B023
                        rows.append({"page_id": number("X-Page-Id"), "url": fields["WARC-Target-URI"], "payload_bytes": n, "payload_digest": digest, "record_type": fields["WARC-Type"], "refers_to": number("X-Refers-To-Page-Id"), "payload": None if revisit else payload})
                        if len(rows) == 256:
                            yield pa.RecordBatch.from_pylist(rows, kind)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, kind)

    spread = manifest.select("path").repartition(common.shuffle_partitions(manifest.sparkSession))
    return spread.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary")


LEAST = 1000


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write(common.documents(spark, sf_dir, "pages"), common.scratch_path(spark, "warc"), LEAST)
    return read(manifest).drop("payload", "url")


SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS payload_digest FROM pages),
b AS (SELECT page_id, strlen(body)::BIGINT AS payload_bytes, payload_digest FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM b)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= {LEAST} AND page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= {LEAST} AND page_id < last THEN last END AS refers_to FROM m
"""
