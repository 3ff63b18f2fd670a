"""Enriched-interval calling on pileups."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals as iv
from . import stats

S, E = iv.S, iv.E


def shifted(reads_: DataFrame, shift: int = -75, size: int = 150) -> DataFrame:
    """Single-end pseudo-fragments: the 5' end moved by `shift` along the read, then `size` bp in its direction."""
    plus = F.col("strand") != "-"
    s = F.when(plus, F.col(S) + shift).otherwise(F.col(E) - shift - size)
    return reads_.withColumn("_s", F.greatest(F.lit(0), s)).withColumns({E: F.greatest(F.col("_s") + 1, s + size), S: F.col("_s")}).drop("_s")


def upper_tail(k: np.ndarray, lam: np.ndarray) -> np.ndarray:
    """-log10 P(X >= k) for Poisson variables of mean lam, all at once: the tail's terms relative to its first one are summed."""
    distinct, at = np.unique(np.maximum(k, 0), return_inverse=True)
    log_factorial = np.array([math.lgamma(x + 1) for x in distinct.tolist()])[at]
    log_first = k * np.log(lam) - lam - log_factorial
    total, term, j = np.ones(len(k)), np.ones(len(k)), k.astype(float)
    open_ = np.flatnonzero(k > 0)
    while len(open_):
        j[open_] += 1
        term[open_] *= lam[open_] / j[open_]
        total[open_] += term[open_]
        open_ = open_[(term[open_] >= 1e-12 * total[open_]) | (j[open_] <= lam[open_])]
    return np.where(k > 0, np.maximum(0.0, -(log_first + np.log(total)) / math.log(10)), 0.0)


def poisson_tail(df: DataFrame, n: str = "depth", rate: str = "lam") -> DataFrame:
    """Adds score = -log10 P(X >= n) at the rate rounded to 3 digits, by Arrow batches beside the other columns."""

    @F.pandas_udf("double")
    def score(k: pd.Series, lam: pd.Series) -> pd.Series:
        return pd.Series(upper_tail(k.to_numpy(np.int64), np.maximum(lam.to_numpy(float), 1e-9)))

    return df.withColumn("score", score(F.col(n).cast("long"), F.round(rate, 3)))


def paired_segments(treated: DataFrame, control: DataFrame, keys: list[str], tile: int = iv.TILE) -> DataFrame:
    """Segments between neighbouring boundaries of either side with depth and control_depth, where depth is above 0.

    One sweep: both sides' boundaries are summed by position inside tiles, so the pileups meet without a join of segments."""

    def events(df: DataFrame, own: int, other: int) -> DataFrame:
        step = lambda c, sign: F.struct(F.col(c).alias("pos"), F.lit(sign * own).cast("long").alias("d"), F.lit(sign * other).cast("long").alias("c"))
        return iv.cut_at_tiles(df.select(*keys, S, E), tile).select(
            *keys, "_tile", F.explode(F.array(step(S, 1), step(E, -1))).alias("x")
        ).select(*keys, "_tile", "x.*")

    sums = events(treated, 1, 0).unionByName(events(control, 0, 1)).groupBy(*keys, "_tile", "pos").agg(F.sum("d").alias("d"), F.sum("c").alias("c"))
    by = Window.partitionBy(*keys, "_tile").orderBy("pos")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    run = sums.withColumns({"depth": F.sum("d").over(so_far), "control_depth": F.sum("c").over(so_far), E: F.lead("pos").over(by)})
    return run.filter(F.col("depth") > 0).select(*keys, F.col("pos").alias(S), E, "depth", "control_depth")


def control_units(units: DataFrame, controls: DataFrame, key: str = "sample_key") -> DataFrame:
    """Units of the control of each sample under that sample's key.  controls: (sample_key, control_key), a row a sample."""
    pairs = controls.filter("control_key is not null").select(F.col(key).alias("_treated"), F.col("control_key").alias(key))
    return units.join(F.broadcast(pairs), key).withColumn(key, F.col("_treated")).drop("_treated")


def rates(units: DataFrame, genome_size: float, local: int = 10_000, control: DataFrame | None = None, small: int = 1_000) -> DataFrame:
    """Pileup segments (depth, control_depth) of a sample with lam, the rate that a depth is held against.

    It is the most of the sample's mean over the genome and of local means.  With a control (units under the sample's key, see
    control_units()), the local means are the control's: its depth there and its means in windows of `small` and `local` bp, all
    times the ratio of the two numbers of units.  Samples without control units take their own mean in windows of `local` bp.
    """
    by = ["sample_key", "chrom"]
    mean = units.groupBy("sample_key").agg((F.sum(F.col(E) - F.col(S)) / F.lit(float(genome_size))).alias("genome_mean"), F.count("*").alias("_n"))

    def background(df: DataFrame, width: int, name: str) -> DataFrame:
        bins = iv.cut_at_tiles(df.select(*by, S, E), width)
        return bins.groupBy(*by, F.col("_tile").alias(f"_{name}_bin")).agg((F.sum(F.col(E) - F.col(S)) / F.lit(float(width))).alias(name))

    def near(seg: DataFrame, df: DataFrame, width: int, name: str) -> DataFrame:
        at = F.floor((F.col(S) + F.col(E)) / 2 / width)
        return seg.withColumn(f"_{name}_bin", at).join(background(df, width, name), [*by, f"_{name}_bin"], "left").drop(f"_{name}_bin")

    none = F.lit(0.0)
    if control is None:
        pile = iv.depth_segments(units.select(*by, S, E), by).withColumn("control_depth", F.lit(None).cast("long"))
        seg = near(pile, units, local, "_own").join(F.broadcast(mean), "sample_key")  # a row a sample
        return seg.withColumn("lam", F.greatest("genome_mean", F.coalesce("_own", none))).drop("_own", "_n", "genome_mean")
    number = control.groupBy("sample_key").agg(F.count("*").alias("_m"))
    mean = mean.join(number, "sample_key", "left").withColumn("_ratio", F.col("_n") / F.col("_m")).drop("_n", "_m")
    seg = paired_segments(units, control, by).join(F.broadcast(mean), "sample_key")  # a row a sample
    seg = near(near(near(seg, control, small, "_small"), control, local, "_large"), units, local, "_own")
    scaled = F.col("_ratio") * F.greatest(F.col("control_depth").cast("double"), F.coalesce("_small", none), F.coalesce("_large", none))
    lam = F.greatest("genome_mean", F.when(F.col("_ratio").isNotNull(), scaled).otherwise(F.coalesce("_own", none)))
    return seg.withColumn("lam", lam).drop("_small", "_large", "_own", "_ratio", "genome_mean")


def scored_segments(
    units: DataFrame, genome_size: float, local: int = 10_000, control: DataFrame | None = None, keep: Callable[[DataFrame, str], DataFrame] | None = None
) -> DataFrame:
    """rates() with score, -log10 of the Poisson tail, and q-values in -log10.

    Benjamini-Hochberg weighs a score by the base pairs that have it.  keep(df, name) may write the scores, which are read twice.
    """
    scored = poisson_tail(rates(units, genome_size, local, control))
    if keep is not None:
        scored = keep(scored, "scored")
    hist = scored.groupBy("sample_key", F.round("score", 3).alias("_sc")).agg(F.sum(F.col(E) - F.col(S)).alias("_bp"))
    down, all_ = Window.partitionBy("sample_key").orderBy(F.col("_sc").desc()), Window.partitionBy("sample_key")
    raw = F.col("_sc") + F.log10(F.sum("_bp").over(down)) - F.log10(F.greatest(F.sum("_bp").over(all_).cast("double"), F.lit(float(genome_size))))
    q = hist.withColumn("_q", raw).withColumn(
        "q", F.greatest(F.lit(0.0), F.max("_q").over(Window.partitionBy("sample_key").orderBy("_sc")))
    ).select("sample_key", "_sc", "q")
    return scored.withColumn("_sc", F.round("score", 3)).join(q, ["sample_key", "_sc"]).select("sample_key", "chrom", S, E, "depth", "lam", "score", "q")


def call(segments: DataFrame, cutoff: float = 0.05, gap: int = 150, least: int = 150, tile: int = iv.TILE) -> DataFrame:
    """Narrow peaks: segments with q at least the cutoff, gaps up to `gap` closed, shorter ones dropped; summit of the deepest segment.

    Segments are gathered inside tiles; what lies within `gap` of a tile's border is gathered once more over the borders.
    """
    by, best = ["sample_key", "chrom"], ["signal", "pvalue", "qvalue"]

    def gathered(x: DataFrame, keys: list[str]) -> DataFrame:
        w = Window.partitionBy(*keys).orderBy(S)
        x = x.withColumn("_new", F.when(F.col(S) - F.lag(E).over(w) <= gap, 0).otherwise(1)).withColumn("_p", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return x.groupBy(*keys, "_p").agg(F.min(S).alias(S), F.max(E).alias(E), *[F.max(c).alias(c) for c in best], F.max("top").alias("top")).drop("_p")

    good = segments.filter(F.col("q") >= -math.log10(cutoff)).select(
        *by, S, E, F.col("depth").alias("signal"), F.col("score").alias("pvalue"), F.col("q").alias("qvalue"),
        F.struct("depth", (-F.col(S)).alias("at"), F.floor((F.col(S) + F.col(E)) / 2).alias("mid")).alias("top")
    )
    pieces = gathered(good.withColumn("_tile", F.floor(F.col(S) / tile)), [*by, "_tile"]).drop("_tile")
    near = (F.col(S) % tile <= gap) | (F.pmod(-F.col(E), F.lit(tile)) <= gap) | (F.floor(F.col(S) / tile) != F.floor((F.col(E) - 1) / tile))
    out = pieces.filter(~near).unionByName(gathered(pieces.filter(near), by))
    return out.select(*by, S, E, *best, F.col("top.mid").alias("summit")).filter(F.col(E) - F.col(S) >= least)


def call_broad(segments: DataFrame, cutoff: float = 0.05, broad_cutoff: float = 0.1, gap: int = 600, least: int = 150) -> DataFrame:
    """Weaker regions linked over wider gaps that hold at least one strong peak; n_strong counts them."""
    strong = call(segments, cutoff, gap // 4, 1)
    weak = call(segments, broad_cutoff, gap, least).withColumn("peak_id", F.concat_ws(":", "sample_key", "chrom", S, E))
    hits = iv.overlap_join(weak, strong.select("sample_key", "chrom", S, E), ("sample_key", "chrom")).groupBy("peak_id").agg(F.count("*").alias("n_strong"))
    return weak.join(hits, "peak_id").drop("peak_id", "summit")


def with_zero_peaks(samples: DataFrame, peaks: DataFrame, allow_zero: bool = True) -> DataFrame:
    """Peak counts of every sample, 0 where none was called; an error for those if zero is not allowed."""
    n = samples.select("sample_key").join(peaks.groupBy("sample_key").agg(F.count("*").alias("n_peaks")), "sample_key", "left")
    zero = F.lit(0) if allow_zero else F.raise_error(F.concat(F.lit("no peaks called for "), "sample_key")).cast("long")
    return n.withColumn("n_peaks", F.coalesce("n_peaks", zero).cast("long"))


def differential_by_recount(
    mates: DataFrame, peaks: DataFrame, depth: DataFrame, conditions: dict[str, str], order: list[str], half: int = 100,
    blocks: dict[str, dict[str, str]] | None = None
) -> DataFrame:
    """Consensus of all samples, summit windows, recount of eligible samples, library-size factors, the shared model
    `~ [block +] condition`; stats.report() makes the report of it."""
    from . import counting

    regions = iv.consensus(peaks, ["chrom"], "sample_key")
    windows = iv.merge(iv.recentre(regions, depth, half), ["chrom"])
    fixed = iv.region_ids(windows)
    counts = counting.union_counts(mates, fixed)
    sizes = {r.sample_key: float(r.n) for r in mates.groupBy("sample_key").agg(F.count_distinct("qname").alias("n")).collect()}  # a row a sample
    mean = sum(sizes[s] for s in conditions) / len(conditions)
    return stats.nb_fit(counts, {s: sizes[s] / mean for s in conditions}, conditions, order, blocks)


def mismatched_plan(plan: DataFrame, results: DataFrame, key: str = "comparison_id") -> DataFrame:
    """Planned comparisons without result and results without plan."""
    a, b = plan.select(key).distinct(), results.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("planned only")).unionByName(b.join(a, key, "left_anti").withColumn("side", F.lit("result only")))


def volcano_label(sig: Column) -> Column:
    return F.when(sig, "significant").otherwise("not significant")
