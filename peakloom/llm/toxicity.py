"""Toxicity by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

Words are runs of bytes other than white space and ASCII punctuation, A-Z lower-cased.  Features are the distinct hashed
words and their beginnings, pairs of neighbours, and pairs around one word, in 2^BITS slots.  Training is FTRL-proximal with a rate for each
coordinate and an L1 term, which leaves few weights other than 0; these are broadcast.  A document's score is the logistic
of the bias and the sum of the weights of its features, so words without a weight never dilute a long text.

Bound of the training sample (documented parameter): `sample_per_class` rows of each label, the first in the order of a
hash of the id.  One task trains on it.  Everything else covers all rows.

Scale: scoring is a map without a shuffle.  The sampled ids (at most twice the bound) are broadcast to pick their texts;
the weights are at most 2^BITS and in practice some thousands.

Cases: a null or empty text has only the bias, and so a score.  Labels with a null id or label are left out; an id labelled
twice takes the larger label.  Without labels of both kinds every score is 0.  Repeated rows are scored each.  An empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common
from .common import U64

BITS = 21
#: Bytes that end a word: white space and ASCII punctuation; the rest with A-Z lower-cased.
_WORDS = bytes(32 if c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 else common.LOWER[c] for c in range(256))
BIAS = 1 << BITS
#: Words longer than so many bytes also count by that beginning, so that inflected forms share what is learnt.
STEMS = (4, 6)


def features(text: bytes, hashes: common.WordHashes) -> np.ndarray:
    """Slots of all word, neighbour and skip features in the text, with repeats."""
    words = text.translate(_WORDS).split()
    h = hashes.array(words)
    stems = np.concatenate([hashes.array([w[:n] for w in words if len(w) > n]) + U64(n) for n in STEMS])
    pairs = h[:-1] * U64(0x9E3779B97F4A7C15) + h[1:]
    skips = h[:-2] * U64(0xC2B2AE3D27D4EB4F) + h[2:] + U64(1)
    return (common.mix(np.concatenate([h, stems, pairs, skips])) >> U64(64 - BITS)).astype(np.int64)


class Ftrl:
    """FTRL-proximal (McMahan et al. 2013) for features that are present or not."""

    def __init__(self, alpha: float = 0.4, beta: float = 1.0, l1: float = 2.0, l2: float = 0.1):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(BIAS + 1), np.zeros(BIAS + 1)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == BIAS, 0.0, self.l1)
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def learn(self, at: np.ndarray, label: int) -> None:
        w = self.weights(at)
        g = logistic(w.sum()) - label
        n = self.n[at]
        self.z[at] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[at] = n + g * g


def logistic(x: float) -> float:
    return float(1.0 / (1.0 + np.exp(-np.clip(x, -35.0, 35.0))))


def train(docs: DataFrame, labels: DataFrame, scratch: common.Scratch, label: str = "toxic", id_column: str = "doc_id", text: str = "text", sample_per_class: int = 3000, epochs: int = 6) -> dict[str, np.ndarray]:
    """Weights other than 0 as {"at", "weight"}.  labels: (id, label) rows to learn from."""
    known = labels.filter(F.col(id_column).isNotNull() & F.col(label).isin(0, 1)).groupBy(id_column).agg(F.max(label).cast("int").alias("_label"))
    order = F.xxhash64(F.col(id_column), F.lit(7))
    picked = [known.filter(F.col("_label") == y).orderBy(order, id_column).limit(sample_per_class) for y in (0, 1)]
    ids = scratch.table(picked[0].unionByName(picked[1]), "labelled")  # at most 2 * sample_per_class rows
    sample = docs.select(id_column, common.text_bytes(text).alias("_text")).join(F.broadcast(ids), id_column)
    rows = sample.select(F.xxhash64(F.col(id_column), F.lit(11)).alias("_order"), "_text", "_label").repartition(1).sortWithinPartitions("_order", "_text")

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        hashes, model = common.WordHashes(), Ftrl()
        seen = []
        for whole in batches:
            for b in common.batches(iter([whole]), 64):
                for t, y in zip(b.column("_text").to_pylist(), b.column("_label").to_pylist(), strict=True):
                    seen.append((np.append(np.unique(features(t, hashes)), BIAS).astype(np.int32), y))
        import pyarrow as pa

        if len({y for _, y in seen}) < 2:
            return
        for _ in range(epochs):
            for at, y in seen:
                model.learn(at, y)
        every = np.arange(BIAS + 1)
        w = model.weights(every)
        keep = np.flatnonzero(w)
        yield pa.RecordBatch.from_pandas(pd.DataFrame({"at": keep, "weight": w[keep]}), preserve_index=False)

    found = scratch.table(rows.mapInArrow(run, "at long, weight double"), "weights").toPandas()
    return {"at": found["at"].to_numpy(np.int64), "weight": found["weight"].to_numpy(np.float64)}


def score(docs: DataFrame, weights: dict[str, np.ndarray], keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """(row, score) for each document: row is a struct of the columns in `keep`."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    rows = docs.select(F.struct(*keep).alias("row"), common.text_bytes(text).alias("text"))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        dense = np.zeros(BIAS + 1)
        dense[sent.value["at"]] = sent.value["weight"]
        some = dense != 0
        bias, none = dense[BIAS], len(sent.value["at"]) == 0
        hashes = common.WordHashes()
        for whole in batches:
            for b in common.batches(iter([whole]), 256):
                out = []
                for t in b.column("text").to_pylist():
                    at = features(t, hashes)
                    at = np.unique(at[some[at]])
                    out.append(0.0 if none else logistic(bias + dense[at].sum()))
                yield pa.RecordBatch.from_arrays([b.column("row"), pa.array(out, pa.float64())], ["row", "score"])

    return rows.mapInArrow(run, f"row {rows.schema['row'].dataType.simpleString()}, score double")


def held_out(id_column: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % 3 == 1


THRESHOLD = 0.7


def fit(spark: SparkSession, sf_dir: str) -> dict[str, np.ndarray]:
    labels = common.documents(spark, sf_dir, "labels").select("doc_id", "toxic").filter(~held_out())
    return train(common.documents(spark, sf_dir).select("doc_id", "text"), labels, common.Scratch(spark))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = score(common.documents(spark, sf_dir), fit(spark, sf_dir)).select("row.doc_id", "score")
    return out.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
