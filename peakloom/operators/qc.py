"""Quality-control metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import counting, reads, selection
from . import intervals as iv

S, E = iv.S, iv.E
#: Fragment-length classes in bp.  Fixed values.
CLASSES = {"nucleosome_free_1_100": (1, 100), "mononucleosome_180_247": (180, 247), "dinucleosome_315_473": (315, 473), "trinucleosome_558_615": (558, 615)}


def share(n: Column, d: Column) -> Column:
    return F.when(d != 0, n / d)


def mapq_bins(df: DataFrame) -> DataFrame:
    q = F.col("mapq")
    return df.groupBy("sample_key").agg(
        F.count_if(q == 0).alias("mapq_0"), F.count_if((q >= 1) & (q <= 9)).alias("mapq_1_9"), F.count_if((q >= 10) & (q <= 29)).alias("mapq_10_29"),
        F.count_if(q >= 30).alias("mapq_30"), F.count_if("has_xs").alias("xs_tagged")
    )


def mito_percent(df: DataFrame) -> DataFrame:
    m, n = F.count_if(reads.is_mito()), F.count("*")
    return df.groupBy("sample_key").agg(m.alias("mito_reads"), n.alias("total_reads"), F.round(F.when(n > 0, 100 * m / n), 2).alias("mito_percent"))


def reads_per_mb(df: DataFrame, sizes: DataFrame) -> DataFrame:
    return df.groupBy("sample_key", "chrom").agg(F.count("*").alias("n")).join(sizes, "chrom").select(
        "sample_key", "chrom", "n", (F.col("n") / F.col("size") * 1e6).alias("per_mb")
    )


def peak_stats(peaks: DataFrame) -> DataFrame:
    """(sample_key, peak_type, n_peaks, median_width, max_signal); the medians are selected in rounds when this is called."""
    by = ["sample_key", "peak_type"]
    widths = selection.quantiles(peaks.select(*by, (F.col(E) - F.col(S)).alias("width")), by, "width", [0.5])
    sums = peaks.groupBy(*by).agg(F.count("*").alias("n_peaks"), F.greatest(F.max("signal"), F.lit(0.0)).alias("max_signal"))
    same = sums["sample_key"].eqNullSafe(widths["sample_key"]) & sums["peak_type"].eqNullSafe(widths["peak_type"])
    joined = sums.join(F.broadcast(widths), same, "left")  # a row a sample and type
    return joined.select(sums["sample_key"], sums["peak_type"], "n_peaks", F.col("q0").alias("median_width"), "max_signal")


def frip(records: DataFrame, peaks: DataFrame, ids: list[str]) -> DataFrame:
    """Reads in a sample's merged peaks as a share of its mapped reads, 4 digits, null without reads."""
    marked = iv.with_flag(records, peaks, ids, "_hit", ("sample_key", "chrom"))
    out = marked.groupBy("sample_key").agg(F.count("*").alias("mapped"), F.count_if("_hit").alias("in_peaks"))
    return out.withColumn("frip", F.round(share(F.col("in_peaks"), F.col("mapped")), 4))


def frip_by_peak_set(records: DataFrame, sets: dict[str, DataFrame], ids: list[str]) -> DataFrame:
    """sample_key, mapped and frip_<name> for each peak set (narrow, broad, consensus), in one pass over the records.

    A set without sample_key, such as a consensus, holds for every sample.  A sample without any peak of a set of its own has null.
    """
    marked, own = records, records.select("sample_key").distinct()
    for name, peaks in sets.items():
        keys = ("sample_key", "chrom") if "sample_key" in peaks.columns else ("chrom",)
        marked = iv.with_flag(marked, peaks, ids, f"_{name}", keys)
        if len(keys) == 2:
            own = own.join(peaks.groupBy("sample_key").agg(F.lit(True).alias(f"_has_{name}")), "sample_key", "left")
        else:
            own = own.withColumn(f"_has_{name}", F.lit(True))
    out = marked.groupBy("sample_key").agg(F.count("*").alias("mapped"), *[F.count_if(f"_{n}").alias(f"_{n}") for n in sets]).join(own, "sample_key")
    return out.select("sample_key", "mapped", *[
        F.when(F.col(f"_has_{n}"), F.round(share(F.col(f"_{n}"), F.col("mapped")), 4)).alias(f"frip_{n}") for n in sets
    ])


def duplication(df: DataFrame) -> DataFrame:
    return df.groupBy("sample_key").agg(
        F.count("*").alias("examined"), F.count_if("is_dup").alias("duplicates"),
        F.round(100 * F.count_if("is_dup") / F.count("*"), 2).alias("percent_duplication")
    )


def alignment_stats(df: DataFrame) -> DataFrame:
    bit = lambda n: F.col("flag").bitwiseAND(F.lit(n)) != 0
    return df.groupBy("sample_key").agg(
        F.count("*").alias("total"), F.count_if(~bit(4)).alias("mapped"), F.count_if(bit(1)).alias("paired"), F.count_if(bit(2)).alias("proper"),
        F.count_if(bit(1024)).alias("duplicates"), F.count_if(bit(256)).alias("secondary"), F.count_if(bit(2048)).alias("supplementary"),
        F.round(F.avg(F.when(bit(2), F.abs("tlen"))), 4).alias("mean_insert")
    )


def length_histogram(df: DataFrame, longest: int = 1000) -> DataFrame:
    """Counts for every length 1..longest, and the sample's total and overflow on each row."""
    x = reads.fragment_lengths(df)
    hist = x.groupBy("sample_key", "length").agg(F.count("*").alias("n"))  # a row a length
    total = hist.groupBy("sample_key").agg(
        F.sum("n").alias("total"), F.coalesce(F.sum(F.when(F.col("length") > longest, F.col("n"))), F.lit(0)).alias("overflow")
    )
    grid = total.withColumn("length", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(longest).cast("long"))))
    return grid.join(hist, ["sample_key", "length"], "left").select(
        "sample_key", "length", F.coalesce("n", F.lit(0)).cast("long").alias("n"), "total", "overflow"
    )


def periodicity(hist: DataFrame) -> DataFrame:
    """The 16 nucleosome metrics as (sample_key, metric, value); a ratio over 0 is null."""
    n, length = F.col("n"), F.col("length")
    within = lambda a, b: F.coalesce(F.sum(F.when(length.between(a, b), n)), F.lit(0))
    top = lambda a, b: F.max_by(F.when(length.between(a, b) & (n > 0), length), F.when(length.between(a, b) & (n > 0), F.struct(n, -length)))
    out = hist.groupBy("sample_key").agg(
        F.max("total").alias("total"), F.max("overflow").alias("overflow"), *[within(a, b).alias(c) for c, (a, b) in CLASSES.items()],
        top(150, 260).alias("mono"), top(300, 500).alias("di")
    )
    c = [F.col(k) for k in CLASSES]
    d = lambda x: x.cast("double")
    metrics = [("proper_pair_fragments", d(F.col("total"))), ("fragments_above_plot_max", d(F.col("overflow")))]
    for k, x in zip(CLASSES, c, strict=True):
        metrics += [(f"{k}_count", d(x)), (f"{k}_fraction", share(x, F.col("total")))]
    spacing = F.col("di") - F.col("mono")
    metrics += [
        ("nfr_to_mononucleosome_ratio", share(c[0], c[1])), ("periodic_fragment_fraction", share(c[1] + c[2] + c[3], F.col("total"))),
        ("mononucleosome_local_peak_bp", d(F.col("mono"))), ("dinucleosome_local_peak_bp", d(F.col("di"))),
        ("mono_to_di_peak_spacing_bp", d(spacing)), ("mono_to_di_spacing_deviation_from_200_bp", d(F.abs(spacing - 200)))
    ]
    return out.select("sample_key", F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), v.alias("value")) for m, v in metrics])))


def short_mono_ratio(df: DataFrame) -> DataFrame:
    x = reads.fragment_lengths(df)
    return x.groupBy("sample_key").agg(
        share(F.count_if(F.col("length").between(50, 100)), F.count_if(F.col("length").between(150, 200))).alias("short_mononucleosomal_ratio")
    )


def tss_profile(units: DataFrame, genes: DataFrame, blacklist: DataFrame, reach: int = 1000) -> DataFrame:
    """Coverage by units at each strand-oriented position around autosomal TSSs outside the blacklist: (sample_key, position, n).

    A unit adds one at its first position in the window and takes it back after its last; running sums over the 2 * reach + 1
    positions of a sample give the coverage, so no base is exploded.
    """
    t = iv.tss(genes).filter(F.col("chrom").rlike("^chr[0-9]+$")).select("gene_id", "chrom", "tss", "strand")
    spot = t.withColumns({S: F.col("tss"), E: F.col("tss") + 1})
    t = iv.with_any(spot, blacklist, ["gene_id"], anti=True)
    window = t.withColumns({S: F.col("tss") - reach, E: F.col("tss") + reach + 1})
    pairs = iv.overlap_join(units.select("sample_key", "chrom", S, E), window.select("chrom", S, E, "tss", "strand"))
    first, last = F.greatest(S, "r_start") - F.col("tss"), F.least(E, "r_end") - 1 - F.col("tss")
    minus = F.col("strand") == "-"
    events = F.array(
        F.struct(F.when(minus, -last).otherwise(first).alias("position"), F.lit(1).alias("d")),
        F.struct((F.when(minus, -first).otherwise(last) + 1).alias("position"), F.lit(-1).alias("d"))
    )
    steps = pairs.select("sample_key", F.explode(events).alias("x")).groupBy("sample_key", F.col("x.position").alias("position")).agg(F.sum("x.d").alias("d"))
    every = steps.select("sample_key").distinct().withColumn("position", F.explode(F.sequence(F.lit(-reach).cast("long"), F.lit(reach).cast("long"))))
    run = Window.partitionBy("sample_key").orderBy("position").rowsBetween(Window.unboundedPreceding, 0)
    return every.join(steps, ["sample_key", "position"], "left").select("sample_key", "position", F.sum(F.coalesce("d", F.lit(0))).over(run).alias("n"))


def tss_enrichment(profile: DataFrame, reach: int = 1000, flank: int = 100) -> DataFrame:
    """Coverage at the TSS over the mean coverage of the outer flanks on both sides."""
    p = F.col("position")
    back = F.sum(F.when(F.abs(p) > reach - flank, F.col("n"))) / (2 * flank)
    return profile.groupBy("sample_key").agg(F.round(F.when(back > 0, F.sum(F.when(p == 0, F.col("n"))) / back), 6).alias("tss_enrichment"))


def fingerprint(bins: DataFrame) -> DataFrame:
    """Lorenz curve of bin counts (zero bins left out) from a histogram: (sample_key, n, bins_share, reads_share)."""
    hist = bins.filter("n > 0").groupBy("sample_key", "n").agg(F.count("*").alias("k"))
    up, all_ = Window.partitionBy("sample_key").orderBy("n"), Window.partitionBy("sample_key")
    return hist.select(
        "sample_key", "n", (F.sum("k").over(up) / F.sum("k").over(all_)).alias("bins_share"),
        (F.sum(F.col("k") * F.col("n")).over(up) / F.sum(F.col("k") * F.col("n")).over(all_)).alias("reads_share")
    )


def fingerprint_metrics(curve: DataFrame) -> DataFrame:
    """Area under the curve (trapezoids from the origin), elbow (greatest gap below the diagonal) and where reads first pass 1 %."""
    w = Window.partitionBy("sample_key").orderBy("n")
    px, py = F.coalesce(F.lag("bins_share").over(w), F.lit(0.0)), F.coalesce(F.lag("reads_share").over(w), F.lit(0.0))
    x = curve.withColumn("_a", (F.col("bins_share") - px) * (F.col("reads_share") + py) / 2)
    gap = F.col("bins_share") - F.col("reads_share")
    return x.groupBy("sample_key").agg(
        F.round(F.sum("_a"), 6).alias("auc"), F.round(F.max(gap), 6).alias("elbow_gap"),
        F.round(F.min(F.when(F.col("reads_share") >= 0.01, F.col("bins_share"))), 6).alias("x_intercept")
    )


def centre_matrix(cov: DataFrame, regions: DataFrame, reach: int = 2000, width: int = 10) -> DataFrame:
    """Mean depth in `width`-bp bins around region centres: (region_id, sample_key, bin, value); regions without signal are absent."""
    mid = F.floor((F.col(S) + F.col(E)) / 2)
    window = regions.select("region_id", "chrom", mid.alias("centre")).withColumns({S: F.col("centre") - reach, E: F.col("centre") + reach})
    pairs = iv.overlap_join(cov, window.select("chrom", S, E, "region_id", "centre"))
    piece = pairs.withColumns({"_s": F.greatest(S, "r_start") - F.col("r_start"), "_e": F.least(E, "r_end") - F.col("r_start")})
    bins = F.explode(F.sequence(F.floor(F.col("_s") / width), F.floor((F.col("_e") - 1) / width)))
    x = piece.withColumn("bin", bins)
    over = F.least(F.col("_e"), (F.col("bin") + 1) * width) - F.greatest(F.col("_s"), F.col("bin") * width)
    return x.groupBy("region_id", "sample_key", "bin").agg((F.sum(over * F.col("depth")) / width).alias("value"))


def profile(matrix: DataFrame) -> DataFrame:
    """Average over the regions that have any signal in the sample."""
    n = matrix.groupBy("sample_key").agg(F.count_distinct("region_id").alias("regions"))
    return matrix.groupBy("sample_key", "bin").agg(F.sum("value").alias("s")).join(F.broadcast(n), "sample_key").select("sample_key", "bin", (F.col("s") / F.col("regions")).alias("mean"))


def heatmap_order(matrix: DataFrame, prefix: int = 8) -> DataFrame:
    """Regions by mean signal, strongest first and then by id, with their global rank.

    Regions of one power of two of signal (cut finer by 16) whose ids begin alike are ranked together, so the many without signal
    are as well dealt as the others; ids of region_ids() share their first 8 letters with 999 others."""
    means = matrix.groupBy("region_id").agg(F.round(F.avg("value"), 9).alias("mean_signal"))
    order = [-F.col("mean_signal"), F.col("region_id")]
    # between equal buckets of signal the order is not by id alone, so only those of equal signal are cut by the id's beginning
    alike = F.when(F.col("mean_signal") == 0, F.substring(F.col("region_id").cast("string"), 1, prefix)).otherwise("")
    return iv.number(means, order, [-F.floor(16 * F.log2(F.col("mean_signal") + 1e-9)), alike])


def summary(stats: DataFrame) -> DataFrame:
    """qc_status from peak counts (n_narrow, n_broad)."""
    few = (F.col("n_narrow") < 200) & (F.col("n_broad") < 200)
    return stats.withColumn("qc_status", F.when((F.col("n_narrow") == 0) & (F.col("n_broad") == 0), "NO_PEAKS").when(few, "POOR").otherwise("PASS"))


#: Columns of the summary row, in order.  Fixed values.
SUMMARY = [
    "sample_id", "assay", "bam_file", "total_reads", "duplication_pct", "bl_filtered_reads", "mito_reads", "mito_pct", "n_narrow_peaks",
    "n_broad_peaks", "peak_width_median", "peak_max_signal", "frip_narrow", "frip_broad", "qc_status", "notes"
]


def summary_rows(records: DataFrame, peaks: DataFrame, sheet: DataFrame, ids: list[str], folder: str = "filtered") -> DataFrame:
    """The 16 columns of SUMMARY, a row a sample of the sheet (sample_key, assay).

    records carry is_dup; mapped ones count.  Median width and greatest signal are those of the sample's narrow peaks.  A sample
    without records has 0 reads, without peaks 0 peaks, and null where there is nothing to divide or measure.
    """
    mapped = F.col("flag").bitwiseAND(F.lit(4)) == 0
    reads_ = records.groupBy("sample_key").agg(
        F.count_if(mapped).alias("total_reads"), F.round(100 * F.count_if("is_dup") / F.count("*"), 2).alias("duplication_pct"),
        F.count_if(mapped & reads.is_mito()).alias("mito_reads")
    )
    narrow, broad = (peaks.filter(F.col("peak_type") == k) for k in ("narrow", "broad"))
    n = peak_stats(narrow).select(
        "sample_key", F.col("n_peaks").alias("n_narrow"), F.col("median_width").alias("peak_width_median"),
        F.col("max_signal").alias("peak_max_signal")
    )
    b = broad.groupBy("sample_key").agg(F.count("*").alias("n_broad"))
    shares = frip_by_peak_set(records.filter(mapped), {"narrow": narrow, "broad": broad}, ids).drop("mapped")
    out = sheet.select("sample_key", "assay")
    for part in (reads_, n, b, shares):
        out = out.join(part, "sample_key", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("total_reads", "mito_reads", "n_narrow", "n_broad")}
    out = summary(out.withColumns(zero)).withColumns(
        {
            "mito_pct": F.round(100 * share(F.col("mito_reads"), F.col("total_reads")), 2), "bl_filtered_reads": F.col("total_reads"),
            "bam_file": F.concat(F.lit(f"{folder}/"), "sample_key", F.lit(".sam")), "notes": F.lit("")
        }
    )
    return out.withColumnsRenamed({"sample_key": "sample_id", "n_narrow": "n_narrow_peaks", "n_broad": "n_broad_peaks"}).select(*SUMMARY)


def warnings(stats: DataFrame) -> DataFrame:
    """(sample_key, warning, value, threshold) for every rule that a sample breaks."""
    atac = reads.is_atac()
    none = (F.col("n_narrow") == 0) & (F.col("n_broad") == 0)
    mito = F.floor("mito_percent")
    text = lambda c: F.col(c).cast("string")
    rules = [
        ("LOW_READS", F.col("total_reads") < 1_000_000, text("total_reads"), "1000000"),
        ("HIGH_DUPLICATION", F.floor("dup_percent") > 80, text("dup_percent"), "80"),
        ("HIGH_MITO_ATAC", atac & (mito >= 25), text("mito_percent"), "25"),
        ("ELEVATED_MITO_ATAC", atac & (mito >= 10) & (mito < 25), text("mito_percent"), "10"), ("ZERO_PEAKS", none, F.lit("0"), "1"),
        ("FEW_PEAKS", ~none & (F.col("n_narrow") < 200) & (F.col("n_broad") < 200), text("n_narrow"), "200"),
        ("LOW_FRIP_NARROW", (F.col("n_narrow") > 0) & (F.bround(F.col("frip_narrow") * 100, 0) < 1), text("frip_narrow"), "0.01")
    ]
    rows = F.array(*[
        F.when(F.coalesce(test, F.lit(False)), F.struct(F.lit(n).alias("warning"), v.alias("value"), F.lit(t).alias("threshold"))) for n, test, v,
        t in rules
    ])
    return stats.select("sample_key", F.inline(F.filter(rows, lambda x: x.isNotNull())))


def contig_report(df: DataFrame, genome: str = "hg38") -> DataFrame:
    return df.groupBy("sample_key", "chrom").agg(F.count("*").alias("n")).withColumn("kept", reads.is_canonical(genome))


def library_summary(units: DataFrame, counts: DataFrame, factors: DataFrame, eligible: DataFrame | None = None) -> DataFrame:
    """sample_key, canonical_signal, assigned, size_factor and assigned_fraction; with eligible (sample_key) also whether the
    sample is in the differential model."""
    total = units.groupBy("sample_key").agg(F.count("*").alias("canonical_signal"))
    assigned = counts.groupBy("sample_key").agg(F.sum("n").alias("assigned"))
    out = total.join(assigned, "sample_key", "left").join(factors.select("sample_key", "size_factor"), "sample_key", "left")
    out = out.withColumn("assigned_fraction", F.col("assigned") / F.col("canonical_signal"))
    if eligible is None:
        return out
    known = eligible.select("sample_key").distinct().withColumn("_in", F.lit(True))
    return out.join(known, "sample_key", "left").withColumn("differential_model_eligible", F.coalesce("_in", F.lit(False))).drop("_in")


def dashboard(tables: list[DataFrame]) -> DataFrame:
    """All metrics of a sample in one row: tables with a row a sample side by side; a sample that any table names has a row, and
    null where a table lacks it."""
    out = tables[0]
    for t in tables[1:]:
        out = out.join(t, "sample_key", "full")  # a row a sample
    return out


def wide(metrics: DataFrame, names: list[str]) -> DataFrame:
    """(sample_key, metric, value) as one row a sample."""
    return metrics.groupBy("sample_key").pivot("metric", names).agg(F.first("value"))


rpkm = counting.rpkm
