"""Importance resampling to a target distribution, by hashed n-grams.

A 256-byte table lower-cases A-Z and blanks the separators in a text's UTF-8 bytes, split() gives the words, and the crc32 of a
word is the seed that the next word extends to the pair's crc32, so n-grams are never joined.  An n-gram's bucket is its crc32
modulo the buckets.  Tasks count buckets of all their texts in one Counter, which leaves the task as at most `buckets` rows.

A bucket's gain is the floored log ratio of its shares in the target and in the corpus (thousandths, one added to each count),
a document's weight the floored mean of its features' gains.  Adding Gumbel noise, from a hash of its id, and taking the
highest scores draws documents without replacement with chances in proportion to exp(weight / 1000).

Scale: two passes over the texts and no shuffle of them.  Counts are a row a bucket in the driver and in every task.  Drawing
ranks the scores by range partitions and the sums of ranges before, so no task sorts all documents.

Cases: null and empty texts have no features and weight 0.  A null id counts as an empty one for the noise and comes last among
ties.  Repeated rows are documents each; rows equal in score and id are interchangeable.  An empty table gives an empty result,
an empty target makes the corpus alone decide.  Other columns pass through; the added ones replace like-named ones.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

N, BUCKETS, SEED, LEAST_WORDS, PERCENT = 2, 10_000, 7, 20, 25
#: Bytes of words, A-Z lower-cased, and spaces for all other bytes.
WORDS = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def grams(text: bytes, n: int, buckets: int) -> tuple[int, np.ndarray]:
    """Words in the text, and the buckets of its runs of 1 to n words, repeats included."""
    words = text.translate(WORDS).split()
    seeds = list(map(crc32, words))
    found = seeds[:]
    after = [b" " + w for w in words] if n > 1 else []
    for k in range(1, n):
        seeds = list(map(crc32, after[k:], seeds))
        found += seeds
    return len(words), np.fromiter(found, np.uint32, len(found)) % np.uint32(buckets)


def counts(texts: DataFrame, n: int, buckets: int, text: str = "text") -> np.ndarray:
    """Features of all texts by bucket."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        total: Counter = Counter()
        for whole in batches:
            for b in common.batches(iter([whole]), 256):
                for t in b.column(0):
                    total.update(grams(t.as_py(), n, buckets)[1].tolist())
        yield pa.RecordBatch.from_arrays([pa.array(list(total.keys()), pa.int64()), pa.array(list(total.values()), pa.int64())], ["bucket", "n"])

    found = texts.select(common.text_bytes(text).alias("text")).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    with common.settings(texts.sparkSession, common.CLEAN_SHUFFLES, common.ARROW_BYTES):
        for r in found.collect():  # a row a bucket at most
            out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Floored thousandths of the log of (t + 1) * (S + buckets) / ((s + 1) * (T + buckets))."""
    b = len(corpus)
    whole, wanted = float(int(corpus.sum()) + b), float(int(target.sum()) + b)
    return np.array([math.floor(1000 * math.log((t + 1.0) * whole / ((s + 1.0) * wanted))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def noise(of: bytes, seed: int) -> int:
    """Floored thousandths of a Gumbel variable."""
    h = int(hashlib.sha256(b"%d:" % seed + of).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scores(docs: DataFrame, gain: np.ndarray, n: int, seed: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(row, _row, n_words, n_features, weight, score): row is a struct of all columns but the text."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)
    rest = F.struct(*[c for c in docs.columns if c not in (text, "n_words", "n_features", "weight", "score", "rank")])
    # ids of any type count by their text
    name = F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")
    rows = docs.select(rest.alias("row"), F.monotonically_increasing_id().alias("_row"), name.alias("id"), common.text_bytes(text).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        gain = sent.value
        for whole in batches:
            for b in common.batches(iter([whole]), 256):
                made = []
                for i, t in zip(b.column("id"), b.column("text"), strict=True):
                    n_words, at = grams(t.as_py(), n, len(gain))
                    weight = int(gain[at].sum()) // len(at) if len(at) else 0
                    made.append((n_words, len(at), weight, weight + noise(i.as_py(), seed)))
                columns = [pa.array(c, pa.int64()) for c in zip(*made, strict=True)] if made else [pa.array([], pa.int64())] * 4
                yield pa.RecordBatch.from_arrays([b.column("row"), b.column("_row"), *columns], ["row", "_row", "n_words", "n_features", "weight", "score"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, _row long, n_words long, n_features long, weight long, score long")


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS, n: int = N, buckets: int = BUCKETS, seed: int = SEED, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of docs with its columns but the text, and n_words, n_features, weight, score and rank (null: not drawn)."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    gain = gains(counts(docs, n, buckets, text), counts(target, n, buckets, text))
    scored = scratch.table(scores(docs, gain, n, seed, id_column, text), "scored")
    may = scored.filter(F.col("n_words") >= least_words)
    drawn = percent * may.count() // 100
    order = [F.col("score").desc(), F.col("_id").asc_nulls_last(), F.col("_row")]
    ranged = may.withColumn("_id", F.col("row").getField(id_column)).repartitionByRange(common.shuffle_partitions(spark), *order)
    ranged = scratch.table(ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    sums = ranged.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sums.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row a range
    rank = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) + F.col("_before")
    ranked = ranged.join(before, "_part").withColumn("rank", rank.cast("long")).withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    columns = ["row.*", "n_words", "n_features", "weight", "score", "rank"]
    rest = scored.filter(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    return ranked.select(*columns).unionByName(rest.select(*columns))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resample(common.documents(spark, sf_dir), common.documents(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


# The crc32 of each different feature is computed from its bytes by the usual table of 256 remainders.
SQL = r"""
WITH RECURSIVE steps AS (SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM steps WHERE k < 8),
remainders AS (SELECT list(c ORDER BY i) AS t FROM steps WHERE k = 8),
texts AS (SELECT 0 AS kind, row_number() OVER () AS r, doc_id, text FROM documents UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark),
words AS MATERIALIZED (SELECT kind, r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
f AS MATERIALIZED (SELECT kind, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS g FROM words),
h AS (SELECT g, hex(encode(g)) AS x FROM (SELECT DISTINCT g FROM f)),
b AS MATERIALIZED (SELECT g, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(0, len(x) // 2), lambda i: ('0x' || substr(x, 2 * i::INTEGER + 1, 2))::BIGINT)),
  lambda c, y: xor(c // 256, t[xor(c % 256, y) + 1])), 4294967295) % 10000 AS bucket FROM h, remainders),
n AS (SELECT bucket, (count(*) FILTER (kind = 0))::DOUBLE AS s, (count(*) FILTER (kind = 1))::DOUBLE AS t FROM f JOIN b USING (g) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln((t + 1) * ((SELECT sum(s) FROM n) + 10000) / ((s + 1) * ((SELECT sum(t) FROM n) + 10000))))::BIGINT AS gain FROM n),
m AS (SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight FROM f JOIN b USING (g) JOIN gains USING (bucket) WHERE kind = 0 GROUP BY r),
d AS (SELECT doc_id, r, len(w) AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
  coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM words LEFT JOIN m USING (r) WHERE kind = 0),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM d WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 25 * (SELECT count(*) FROM k) // 100 THEN rank END AS rank FROM d LEFT JOIN k USING (r)
"""
