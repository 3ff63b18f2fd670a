"""Read-level jobs: quality profile and trimming."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ADAPTERS = ("CTGTCTCTTATA", "AGATCGGAAGAGC")


def position_profile(reads: DataFrame) -> DataFrame:
    """Mean quality, N count and base composition by position.  Positions are exploded, then combined before the shuffle."""
    x = reads.select(F.posexplode(F.split("seq", "")).alias("position", "base"), "qual").filter("base <> ''")
    x = x.withColumn("q", F.ascii(F.substring("qual", F.col("position") + 1, F.lit(1))) - 33)
    base = [F.count_if(F.col("base") == b).alias(f"n_{b.lower()}") for b in "ACGTN"]
    return x.groupBy("position").agg(
        F.count("*").alias("reads"), F.round(F.avg("q"), 6).alias("mean_quality"), F.percentile("q", F.lit(0.25)).alias("q25"),
        F.percentile("q", F.lit(0.5)).alias("q50"), F.percentile("q", F.lit(0.75)).alias("q75"), *base
    )


def read_profile(reads: DataFrame) -> DataFrame:
    """Distribution of length and GC percent with N and adapter counts: a row for each (length, gc)."""
    n = F.length("seq")
    gc = F.length(F.regexp_replace("seq", "[^GC]", ""))
    adapter = F.lit(False)
    for a in ADAPTERS:
        adapter = adapter | F.contains("seq", F.lit(a))
    return reads.groupBy(n.cast("long").alias("length"), F.when(n > 0, F.floor(100 * gc / n)).alias("gc_percent")).agg(
        F.count("*").alias("reads"), F.sum(F.length(F.regexp_replace("seq", "[^N]", ""))).alias("n_bases"), F.count_if(adapter).alias("with_adapter")
    )


def duplication_levels(reads: DataFrame) -> DataFrame:
    per = reads.groupBy("seq").agg(F.count("*").alias("level"))
    return per.groupBy("level").agg(F.count("*").alias("sequences"))


def padded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bytes by read and position, 0 after the end; lengths) of a batch of reads."""
    raw = [t.encode() for t in texts]
    sizes = np.array([len(t) for t in raw], np.int64)
    wide = max(1, int(sizes.max(initial=0)))
    return np.frombuffer(b"".join(t.ljust(wide, b"\0") for t in raw), np.uint8).reshape(len(raw), wide), sizes


def quality_cut(quals: np.ndarray, sizes: np.ndarray, cutoff: int) -> np.ndarray:
    """Lengths to keep: cut where the sum of (cutoff - quality) from the 3' end is greatest (first met from there), as far as it
    has not fallen below 0."""
    width = quals.shape[1]
    at = np.arange(width)
    gain = np.where(at < sizes[:, None], cutoff - (quals.astype(np.int64) - 33), 0)[:, ::-1]
    total = np.cumsum(gain, 1)
    alive = np.cumsum(total < 0, 1) == 0
    best = np.where(alive, total, 0)
    top = best.max(1, initial=0)
    return np.where(top > 0, width - 1 - best.argmax(1), sizes)


def adapter_cut(seqs: np.ndarray, sizes: np.ndarray, adapter: str, overlap: int) -> np.ndarray:
    """Where the adapter, or a beginning of it of at least `overlap` bases at the read's end, starts: the first such place."""
    pattern, width = np.frombuffer(adapter.encode(), np.uint8), seqs.shape[1]
    at = np.arange(width)
    inside = at < sizes[:, None]
    fits = inside & (sizes[:, None] - at >= overlap)
    for i, base in enumerate(pattern.tolist()):
        shifted = np.zeros_like(seqs)
        if i < width:
            shifted[:, : width - i] = seqs[:, i:]
        fits &= (shifted == base) | (at + i >= sizes[:, None])
    return np.where(fits.any(1), fits.argmax(1), sizes)


def detect_adapter(reads: DataFrame) -> str:
    counts = reads.agg(*[F.count_if(F.contains("seq", F.lit(a))).alias(f"a{i}") for i, a in enumerate(ADAPTERS)]).first()
    return max(zip(counts, ADAPTERS, strict=True), key=lambda x: x[0])[1]


def trim(reads: DataFrame, adapter: str, cutoff: int = 20, overlap: int = 1, least: int = 20) -> DataFrame:
    """Trimmed reads; a read shorter than `least` takes its mates (same sample_key and read_id) with it."""
    kind = reads.schema

    def run(frames: Iterator) -> Iterator:
        for f in frames:
            quals, sizes = padded(f["qual"].tolist())
            keep = quality_cut(quals, sizes, cutoff)
            keep = adapter_cut(padded(f["seq"].tolist())[0], keep, adapter, overlap).tolist()
            yield f.assign(seq=[s[:k] for s, k in zip(f["seq"], keep, strict=True)], qual=[q[:k] for q, k in zip(f["qual"], keep, strict=True)])

    out = reads.mapInPandas(run, kind)
    short = out.filter(F.length("seq") < least).select("sample_key", "read_id").distinct()
    return out.join(short, ["sample_key", "read_id"], "left_anti")
