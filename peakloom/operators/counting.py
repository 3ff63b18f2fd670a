"""Region x sample counting, size factors, scales, coverage and its normalised tracks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals as iv
from . import selection

S, E = iv.S, iv.E


def overlap_counts(
    units: DataFrame, regions: DataFrame, bin_width: int = 2000, salt: bool | None = None, by: tuple[str, ...] = ("sample_key",)
) -> DataFrame:
    """(region_id, by, n): a unit counts in every region it overlaps."""
    pairs = iv.overlap_join(units.select(*by, "chrom", S, E), regions.select("region_id", "chrom", S, E), bin_width=bin_width, salt=salt)
    return pairs.groupBy("region_id", *by).agg(F.count("*").alias("n"))


def policy_counts(units: DataFrame, regions: DataFrame, policies: dict[str, tuple[int, bool]]) -> DataFrame:
    """overlap_counts() for several policies (least MAPQ, whether duplicates go) by one join: units (with mapq and is_dup) meet the
    regions once, and a count says in a column a policy whether it keeps them.  of_policy() adds up those of one policy."""
    keeps = {name: (F.col("mapq") >= q) & ~(F.lit(drops) & F.col("is_dup")) for name, (q, drops) in policies.items()}
    return overlap_counts(units.withColumns(keeps), regions, by=("sample_key", *keeps))


def of_policy(counts: DataFrame, name: str) -> DataFrame:
    return counts.filter(F.col(name)).groupBy("region_id", "sample_key").agg(F.sum("n").alias("n"))


def union_counts(mates: DataFrame, regions: DataFrame, bin_width: int = 2000, salt: bool | None = None) -> DataFrame:
    """A read or pair counts only if its aligned ranges overlap exactly one region."""
    pairs = iv.overlap_join(mates.select("sample_key", "qname", "chrom", S, E), regions.select("region_id", "chrom", S, E), bin_width=bin_width, salt=salt)
    per = pairs.groupBy("sample_key", "qname").agg(F.min("region_id").alias("region_id"), F.max("region_id").alias("_max")).filter("region_id = _max")
    return per.groupBy("region_id", "sample_key").agg(F.count("*").alias("n"))


def complete(counts: DataFrame, regions: DataFrame, samples: DataFrame) -> DataFrame:
    """Zeros for region and sample pairs without hits.  The sample sheet is explicit and small, so it is an array in the plan's rows."""
    keys = [r[0] for r in samples.select("sample_key").distinct().collect()]  # the sample sheet
    grid = regions.select("region_id").withColumn("sample_key", F.explode(F.array(*[F.lit(k) for k in sorted(keys)])))
    return grid.join(counts, ["region_id", "sample_key"], "left").select("region_id", "sample_key", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def nonzero_regions(counts: DataFrame) -> DataFrame:
    keep = counts.groupBy("region_id").agg(F.sum("n").alias("_s")).filter("_s > 0").select("region_id")
    return counts.join(keep, "region_id", "left_semi")


def poscounts_factors(counts: DataFrame) -> DataFrame:
    """Median ratios to a geometric mean over positive counts, scaled to geometric mean 1.  The medians are selected in rounds, so
    this runs when called and its result is a table of a row a sample."""
    n = F.lit(counts.select("sample_key").distinct().count())
    pos = counts.filter("n > 0").withColumn("l", F.ln("n"))
    lg = pos.groupBy("region_id").agg((F.sum("l") / n).alias("lg"))
    ratios = pos.join(lg, "region_id").select("sample_key", (F.col("l") - F.col("lg")).alias("r"))
    raw = selection.quantiles(ratios, ["sample_key"], "r", [0.5]).select("sample_key", F.exp("q0").alias("f"))
    return raw.withColumn("size_factor", F.col("f") / F.exp(F.avg(F.ln("f")).over(Window.partitionBy(F.lit(1))))).drop("f")  # a row a sample


def scales(counts: DataFrame) -> DataFrame:
    """sample_key, size_factor, column_sum, deseq2_consensus_scale, robust_library_size, robust_cpm_scale, geometric_mean_sum."""
    sums = counts.groupBy("sample_key").agg(F.sum("n").alias("column_sum"))
    one = Window.partitionBy(F.lit(1))  # a row a sample
    out = poscounts_factors(counts).join(sums, "sample_key").withColumn("geometric_mean_sum", F.exp(F.avg(F.ln("column_sum")).over(one)))
    lib = F.col("size_factor") * F.col("geometric_mean_sum")
    return out.withColumns({"deseq2_consensus_scale": 1 / F.col("size_factor"), "robust_library_size": lib, "robust_cpm_scale": 1e6 / lib})


def normalised(counts: DataFrame, factors: DataFrame) -> DataFrame:
    """Adds size_factor and value = n / size_factor.  A sample without a factor is an error when read, not a loss of rows."""
    factors = F.broadcast(factors.select("sample_key", F.col("size_factor").alias("_factor")))  # a row a sample
    missing = F.raise_error(F.concat(F.lit("no size factor for sample "), F.coalesce("sample_key", F.lit("null")))).cast("double")
    out = counts.join(factors, "sample_key", "left").withColumn("size_factor", F.coalesce("_factor", missing)).drop("_factor")
    return out.withColumn("value", F.col("n") / F.col("size_factor"))


def spike_scale(target: Column, ratio: Column, count: Column) -> Column:
    """target * ratio / count; anything not above 0 is an error."""
    good = (target > 0) & (ratio > 0) & (count > 0)
    return F.when(good, target * ratio / count).otherwise(F.raise_error(F.lit("spike-in target, ratio and count must be positive")).cast("double"))


SPIKE_LIMITS = {"low_count": 10_000, "minimum": 1, "low_fraction": 0.001, "high_fraction": 0.5}


def spike_qc(df: DataFrame, target: float = 1e6) -> DataFrame:
    """Rows (sample_key, host, spike, spike_q0, ratio) with fraction, scales and an array of warnings."""
    frac = F.col("spike") / (F.col("host") + F.col("spike"))
    warn = F.filter(
        F.array(
            F.when(F.col("spike") < SPIKE_LIMITS["low_count"], "low_dm6_count"), F.when(frac < SPIKE_LIMITS["low_fraction"], "low_dm6_fraction"),
            F.when(frac > SPIKE_LIMITS["high_fraction"], "high_dm6_fraction")
        ),
        lambda x: x.isNotNull()
    )
    checked = F.when(F.col("spike") < SPIKE_LIMITS["minimum"], F.raise_error(F.lit("too few spike-in observations")).cast("double")).otherwise(F.lit(1.0))
    return df.withColumns({
        "fraction": frac, "low_mapq": F.col("spike_q0") - F.col("spike"), "scale": spike_scale(F.lit(target), F.col("ratio"), F.col("spike")),
        "raw_scale": checked, "cpm_scale": 1e6 / F.col("spike"), "warnings": warn
    })


def snapped(units: DataFrame, width: int) -> DataFrame:
    """Units widened to whole bins."""
    return units.withColumns({S: F.floor(F.col(S) / width) * width, E: (F.floor((F.col(E) - 1) / width) + 1) * width})


def coverage(units: DataFrame, width: int = 10, tile: int = iv.TILE, sizes: DataFrame | None = None, by: tuple[str, ...] = ("sample_key",)) -> DataFrame:
    """Units over each bin, equal neighbours as one: (by, chrom, start_pos, end_pos, depth).  No bin is exploded.

    With sizes (chrom, size), the last bin ends at the chromosome's end.
    """
    tile = max(width, tile // width * width)
    keys = [*by, "chrom"]
    out = iv.same_depth(iv.depth_segments(snapped(units, width).select(*keys, S, E), keys, tile), keys, "depth", tile)
    if sizes is None:
        return out
    return out.join(sizes, "chrom").withColumn(E, F.least(E, "size")).filter(f"{S} < {E}").drop("size")


def bin_counts(units: DataFrame, width: int, keys: tuple[str, ...] = ("sample_key", "chrom")) -> DataFrame:
    bins = F.explode(F.sequence(F.floor(F.col(S) / width), F.floor((F.col(E) - 1) / width)))
    return units.select(*keys, bins.alias("bin")).groupBy(*keys, "bin").agg(F.count("*").alias("n"))


def cpm_scales(units: DataFrame) -> DataFrame:
    return units.groupBy("sample_key").agg(F.count("*").alias("signal_count")).withColumn("scale", 1e6 / F.col("signal_count"))


def cpm_record(units: DataFrame, layout: str = "PE", genome: str = "hg38", bin_size: int = 10) -> DataFrame:
    """A row a sample that says how its CPM track was made: what is counted, how many, which contigs, and the files."""
    contigs = F.array_join(F.array_sort(F.collect_set("chrom")), ",")  # contigs are few
    out = units.groupBy("sample_key").agg(F.count("*").alias("normalization_count"), contigs.alias("canonical_contigs"))
    fixed = {"genome": genome, "layout": layout, "signal_unit": "fragments" if layout == "PE" else "reads", "normalization": "CPM"}
    out = out.withColumns({k: F.lit(v) for k, v in fixed.items()} | {"bin_size": F.lit(bin_size).cast("long"), "sample": F.col("sample_key")})
    files = {"bigwig_file": F.concat("sample_key", F.lit("_CPM.bw")), "bedgraph_file": F.concat("sample_key", F.lit("_CPM.bedGraph"))}
    return out.withColumns(files).select("sample", *fixed, "normalization_count", "bin_size", "canonical_contigs", *files)


def tracks(cov: DataFrame, scale_table: DataFrame) -> DataFrame:
    """Every track family as one table: coverage x (sample_key, family, scale).  The scale table is a row a sample and family."""
    return cov.join(F.broadcast(scale_table), "sample_key").select("family", "sample_key", "chrom", S, E, (F.col("depth") * F.col("scale")).alias("score"))


#: Track families and the set of units that each covers.  Fixed values.
FAMILIES = {
    "CPM": "stringent",
    "DESeq2Consensus": "stringent",
    "DESeq2RobustCPM_Permissive": "permissive",
    "DESeq2RobustCPM_Intermediate": "intermediate",
    "DESeq2RobustCPM_Stringent": "stringent",
    "SpikeInDM6_Stringent": "stringent",
    "dm6_StringentRaw": "spike",
    "dm6_StringentCPM": "spike",
    "Merged_CPM": "merged",
}


def family_scales(sets: dict[str, DataFrame], scale_tables: dict[str, DataFrame], spike_target: float = 1e6, ratios: DataFrame | None = None) -> DataFrame:
    """(unit_set, family, sample_key, scale) of every family that the sets and tables allow; a row a sample and family.

    sets: units by name (stringent, permissive, intermediate, spike, merged); scale_tables: scales() of a policy's own counts by
    the policy's name; ratios: (sample_key, ratio) of samples with a spike-in.  CPM scales are a million over the set's units.
    """
    tables = []

    def add(family: str, table: DataFrame, scale: Column) -> None:
        tables.append(table.select(F.lit(FAMILIES[family]).alias("unit_set"), F.lit(family).alias("family"), "sample_key", scale.cast("double").alias("scale")))

    for family, name in (("CPM", "stringent"), ("dm6_StringentCPM", "spike"), ("Merged_CPM", "merged")):
        if name in sets:
            add(family, cpm_scales(sets[name]), F.col("scale"))
    if "spike" in sets:
        n = sets["spike"].groupBy("sample_key").agg(F.count("*").alias("n"))
        add("dm6_StringentRaw", n, F.lit(1.0))
        if ratios is not None:
            add("SpikeInDM6_Stringent", n.join(ratios, "sample_key"), spike_scale(F.lit(spike_target), F.col("ratio"), F.col("n")))
    for name, table in scale_tables.items():
        add(f"DESeq2RobustCPM_{name.capitalize()}", table, F.col("robust_cpm_scale"))
        if name == "stringent":
            add("DESeq2Consensus", table, F.col("deseq2_consensus_scale"))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def track_families(sets: dict[str, DataFrame], scale_table: DataFrame, width: int = 10) -> DataFrame:
    """All families as one table (family, sample_key, chrom, start_pos, end_pos, score): the sets are swept together, each once
    however many families cover it, and meet the scales by a join with a row a sample and family."""
    units = None
    for name, df in sets.items():
        tagged = df.select(F.lit(name).alias("unit_set"), "sample_key", "chrom", S, E)
        units = tagged if units is None else units.unionByName(tagged)
    cov = coverage(units, width, by=("unit_set", "sample_key"))
    return cov.join(F.broadcast(scale_table), ["unit_set", "sample_key"]).select(
        "family", "sample_key", "chrom", S, E, (F.col("depth") * F.col("scale")).alias("score")
    )


def rpkm(units: DataFrame, width: int = 100_000) -> DataFrame:
    total = units.groupBy("sample_key").agg(F.count("*").alias("total"))
    return bin_counts(units, width).join(F.broadcast(total), "sample_key").withColumn("score", F.col("n") * 1e9 / (F.col("total") * width)).drop("total")


def karyogram(scores: DataFrame) -> DataFrame:
    """score as a share of the sample's maximum and of the maximum over all samples (a maximum of 0 counts as 1)."""
    per = scores.groupBy("sample_key").agg(F.max("score").alias("_own"))
    per = per.withColumn("_all", F.max("_own").over(Window.partitionBy(F.lit(1))))  # a row a sample
    safe = lambda c: F.when(F.col(c) > 0, F.col(c)).otherwise(1.0)
    return scores.join(F.broadcast(per), "sample_key").withColumns(
        {"own_share": F.col("score") / safe("_own"), "global_share": F.col("score") / safe("_all")}
    ).drop("_own", "_all")


def checksum(regions: DataFrame) -> DataFrame:
    """One order-free checksum of a region set, in one row: equal sets, equal sums.  Rows are summed as the first 60 bits of their MD5."""
    row = F.conv(F.substring(F.md5(F.concat_ws(":", "chrom", F.col(S).cast("string"), F.col(E).cast("string"))), 1, 15), 16, 10).cast("decimal(38,0)")
    return regions.agg(F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.coalesce(F.sum(row), F.lit(0)).cast("string")), 256).alias("checksum"))


#: Columns of the normalisation record, in order.  Fixed values.
RECORD = [
    "key", "policy", "source_bam_stage", "duplicate_policy", "bowtie2_reporting", "minimum_mapq", "secondary_alignments", "supplementary_alignments",
    "genome", "layout", "signal_unit", "signal_count", "mapq_0", "mapq_1_9", "mapq_10_29", "mapq_30_plus", "consensus_sha256", "consensus_count_sum",
    "cohort_geometric_mean_column_sum", "deseq2_size_factor", "deseq2_consensus_scale", "deseq2_robust_cpm_scale"
]


def normalisation_record(
    kept: DataFrame, scale_table: DataFrame, regions: DataFrame, sheet: DataFrame, policy: str, min_mapq: int, drops_duplicates: bool,
    layout: str = "PE", genome: str = "hg38"
) -> DataFrame:
    """A row a sample of the sheet (sample_key, sheet_order) with the columns of RECORD: how a policy's tracks were made.

    kept are the policy's signal units with mapq; scale_table is scales() of their counts; the checksum is that of the regions,
    which all policies share.  A sample without units has zeros and null scales.
    """
    q = F.col("mapq")
    bins = kept.groupBy("sample_key").agg(
        F.count("*").alias("signal_count"), F.count_if(q == 0).alias("mapq_0"), F.count_if((q >= 1) & (q <= 9)).alias("mapq_1_9"),
        F.count_if((q >= 10) & (q <= 29)).alias("mapq_10_29"), F.count_if(q >= 30).alias("mapq_30_plus")
    )
    scale = scale_table.select(
        "sample_key", F.col("column_sum").alias("consensus_count_sum"), F.col("geometric_mean_sum").alias("cohort_geometric_mean_column_sum"),
        F.col("size_factor").alias("deseq2_size_factor"), "deseq2_consensus_scale", F.col("robust_cpm_scale").alias("deseq2_robust_cpm_scale")
    )
    out = sheet.select("sample_key", "sheet_order").join(bins, "sample_key", "left").join(scale, "sample_key", "left").crossJoin(
        F.broadcast(checksum(regions).withColumnRenamed("checksum", "consensus_sha256"))
    )  # one row
    fixed = {
        "policy": policy, "source_bam_stage": "dedup" if drops_duplicates else "aligned",
        "duplicate_policy": "removed" if drops_duplicates else "retained", "bowtie2_reporting": "one_primary_default", "minimum_mapq": min_mapq,
        "secondary_alignments": "excluded", "supplementary_alignments": "excluded", "genome": genome, "layout": layout,
        "signal_unit": "fragments" if layout == "PE" else "reads"
    }
    out = out.withColumns({k: F.lit(v) for k, v in fixed.items()} | {
        c: F.coalesce(c, F.lit(0)).cast("long") for c in ("signal_count", "mapq_0", "mapq_1_9", "mapq_10_29", "mapq_30_plus")
    })
    return out.withColumnRenamed("sample_key", "key").select(*RECORD, "sheet_order")


def in_sheet_order(*tables: DataFrame) -> DataFrame:
    """Union of per-sample tables (one a policy), by sheet_order and then in the order given; a table lacking a column is an error."""
    out = None
    for i, t in enumerate(tables):
        t = t.withColumn("_table", F.lit(i))
        out = t if out is None else out.unionByName(t)
    return out.orderBy("_table", "sheet_order").drop("_table", "sheet_order")


def guarded(df: DataFrame, what: str) -> DataFrame:
    """df, or an error if it has no rows (no fragments, no canonical contigs, all peaks filtered)."""
    if df.isEmpty():
        raise ValueError(f"no {what}")
    return df


def empty_samples(counts: DataFrame, samples: DataFrame) -> DataFrame:
    """Samples of the sheet without any count: (sample_key, total) with total 0."""
    total = counts.groupBy("sample_key").agg(F.sum("n").alias("total"))
    return samples.select("sample_key").join(total, "sample_key", "left").withColumn("total", F.coalesce("total", F.lit(0)).cast("long")).filter("total = 0")
