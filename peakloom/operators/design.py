"""Sample sheet, cohorts, comparison plans and validation rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import readers
from . import reads

#: Columns and allowed values of a sample sheet.  Fixed values.
CORE = [
    "sample_id", "fastq_1", "fastq_2", "layout", "genome", "assay", "factor", "condition", "treatment", "cell_type", "replicate", "tech_replicate",
    "is_control", "control_id", "macs2_mode", "blacklist", "output_prefix"
]
OLD = "chipqc_annotation"
SPIKE = ["spikein_genome", "spikein_to_host_ratio", "spikein_stage"]
ALLOWED = {
    "layout": ["PE", "SE"], "genome": ["hg38", "mm39"], "macs2_mode": ["narrow", "broad", "both", "none"],
    "is_control": ["TRUE", "FALSE", "true", "false", "1", "0", "yes", "no"]
}
SPIKE_GENOME, SPIKE_STAGE = "dm6", "pre_tagmentation_nuclei"
TRUE = ("true", "1", "yes")
GROUP = ["layout", "genome", "assay", "factor", "condition", "treatment", "cell_type", "is_control", "control_id", "macs2_mode", "blacklist", "output_prefix"]
KEY = ["sample_id", "replicate", "tech_replicate"]
POOL = ["factor", "condition", "treatment", "cell_type"]


def variant(columns: list[str]) -> str:
    """`18` for a sheet with the old annotation column, else `17`, with `+3` if all spike-in columns are there."""
    return ("18" if OLD in columns else "17") + ("+3" if set(SPIKE) <= set(columns) else "")


def check_columns(columns: list[str]) -> list[str]:
    """Missing required columns and partial spike-in columns, as messages."""
    out = [f"missing column {c}" for c in CORE if c not in columns]
    have = [c for c in SPIKE if c in columns]
    return out + ([f"missing column {c}" for c in SPIKE if c not in have] if have else [])


def clean(column: str) -> Column:
    """A cell without blanks around it; null counts as blank."""
    return F.coalesce(F.trim(F.col(column)), F.lit(""))


def is_control(column: str = "is_control") -> Column:
    return F.lower(clean(column)).isin(*TRUE)


def sample_key() -> Column:
    return F.concat(clean("sample_id"), F.lit("_bioR"), clean("replicate"))


def violations(sheet: DataFrame) -> DataFrame:
    """(row, level, message) of domain rules.  sheet has row and the core columns as strings."""
    is_blank = lambda c: clean(c) == ""
    seen = {"layout": F.upper(clean("layout")), "genome": clean("genome"), "macs2_mode": F.lower(clean("macs2_mode")), "is_control": clean("is_control")}
    whole = lambda c: clean(c).rlike("^[+-]?[0-9]+$")
    error, warning = F.lit("error"), F.lit("warning")
    bad = [(error, f"invalid {c}", ~seen[c].isin(*v)) for c, v in ALLOWED.items()]
    bad += [(error, f"{c} is not an integer", ~whole(c)) for c in ("replicate", "tech_replicate")]
    bad += [
        (error, "fastq_1 is empty", is_blank("fastq_1")),
        (error, "paired-end row without fastq_2", (seen["layout"] == "PE") & is_blank("fastq_2")),
        (warning, "single-end row with fastq_2", (seen["layout"] == "SE") & ~is_blank("fastq_2")),
        (warning, "control with control_id", is_control() & ~is_blank("control_id")),
        (warning, "control with a peak mode", is_control() & (seen["macs2_mode"] != "none")),
        (warning, "non-ATAC sample without control", ~is_control() & ~F.coalesce(reads.is_atac(), F.lit(False)) & is_blank("control_id")),
    ]
    if set(SPIKE) <= set(sheet.columns):
        genome, stage = F.lower(clean("spikein_genome")), F.lower(clean("spikein_stage"))
        ratio = clean("spikein_to_host_ratio").try_cast("double")
        positive = F.coalesce((ratio > 0) & ~F.isnan(ratio) & (ratio < float("inf")), F.lit(False))
        declared = genome == SPIKE_GENOME
        bad += [
            (error, "unknown spike-in genome", ~genome.isin("", SPIKE_GENOME)),
            (error, "unknown spike-in stage", ~stage.isin("", SPIKE_STAGE)),
            (error, "spike-in ratio must be finite and above 0", declared & ~positive),
            (error, f"spike-in stage must be {SPIKE_STAGE}", declared & (stage != SPIKE_STAGE)),
            (error, "spike-in fields without a genome", ~declared & (~is_blank("spikein_to_host_ratio") | (stage != ""))),
        ]
    rows = F.array(*[F.when(test, F.struct(level.alias("level"), F.lit(m).alias("message"))) for level, m, test in bad])
    return sheet.select("row", F.inline(F.filter(rows, lambda x: x.isNotNull())))


def repeated_keys(sheet: DataFrame, keys: list[str] = KEY) -> DataFrame:
    """(row, first_row): rows whose composite key an earlier row has already."""
    first = F.min("row").over(Window.partitionBy(*[clean(k) for k in keys]))
    return sheet.select("row", first.alias("first_row")).filter("row > first_row")


def too_few_samples(sheet: DataFrame, least: int = 2, by: list[str] | None = None) -> DataFrame:
    """Cohorts (one, or one for each value of `by`) with fewer than `least` biological samples: (by, samples, required)."""
    n = F.count_distinct(F.when(~is_control(), sample_key()))
    cohorts = sheet.groupBy(*(by or [])).agg(n.alias("samples"))
    return cohorts.withColumn("required", F.lit(least).cast("long")).filter("samples < required")


def duplicate_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1")


def inconsistent_groups(sheet: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column) of metadata that differs inside a technical group."""
    counts = sheet.groupBy(*keys).agg(*[F.count_distinct(F.coalesce(F.col(c).cast("string"), F.lit("\x00"))).alias(c) for c in columns])
    rows = F.array(*[F.when(F.col(c) > 1, F.lit(c)) for c in columns])
    return counts.select(*keys, F.explode(F.filter(rows, lambda x: x.isNotNull())).alias("column"))


def orphans(df: DataFrame, column: str, known: DataFrame, known_column: str) -> DataFrame:
    """Rows whose reference names nothing in `known`; blanks refer to nothing."""
    named = df.filter(F.col(column).isNotNull() & (F.trim(column) != ""))
    return named.join(known.select(F.col(known_column).alias(column)).distinct(), column, "left_anti")


def uniform_cohort(df: DataFrame, columns: tuple[str, ...] = ("layout", "genome")) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(c) for c in columns])


def mixed_cohorts(df: DataFrame, by: list[str], columns: tuple[str, ...] = ("layout", "genome")) -> DataFrame:
    """(by, column, found): cohorts that mix values of a column which must be the same throughout."""
    sets = df.groupBy(*by).agg(*[F.array_sort(F.collect_set(clean(c))).alias(c) for c in columns])  # layouts and genomes are few
    rows = F.array(*[F.when(F.size(c) > 1, F.struct(F.lit(c).alias("column"), F.array_join(c, ",").alias("found"))) for c in columns])
    return sets.select(*by, F.inline(F.filter(rows, lambda x: x.isNotNull())))


def both_peak_types(sheet: DataFrame) -> DataFrame:
    """Biological samples (no controls) whose first row by `row` doesn't ask for both peak types; later rows of a sample don't
    count.  Ids and modes are read without blanks around them and modes in any case."""
    own = sheet.filter(~is_control()).select(
        clean("sample_id").alias("sample_id"), clean("replicate").alias("replicate"),
        F.struct("row", F.lower(clean("macs2_mode")).alias("mode")).alias("_first")
    )
    return own.groupBy("sample_id", "replicate").agg(F.min("_first").alias("_first")).filter("_first.mode <> 'both'").select("sample_id", "replicate")


def resolve_controls(sheet: DataFrame, controls: DataFrame, any_replicate: bool = True) -> DataFrame:
    """Adds control_key: the control's same replicate, else its first (any_replicate), else an error when read; null without one."""
    c = controls.select(F.col("sample_id").alias("control_id"), "replicate").distinct()
    same = c.withColumn("_same", F.lit(True))
    first = c.groupBy("control_id").agg(F.min("replicate").alias("_first"))
    out = sheet.join(same, ["control_id", "replicate"], "left").join(first, "control_id", "left")
    rep = F.when(F.col("_same"), F.col("replicate")).when(F.lit(any_replicate), F.col("_first")).cast("string")
    missing = F.raise_error(F.concat(F.lit("control without a replicate: "), "control_id"))
    key = F.when(clean("control_id") == "", None).when(rep.isNull(), missing).otherwise(F.concat("control_id", F.lit("_bioR"), rep))
    return out.withColumn("control_key", key).drop("_same", "_first")


def with_inputs(samples: DataFrame, inputs: DataFrame, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(samples that have inputs, (sample_key, message) of those dropped); strict: reading a sample without inputs is an error."""
    have = inputs.select("sample_key").distinct().withColumn("_have", F.lit(True))
    marked = samples.join(have, "sample_key", "left")
    if strict:
        error = F.raise_error(F.concat(F.lit("no input for sample "), "sample_key")).cast("boolean")
        return marked.withColumn("_have", F.coalesce("_have", error)).filter("_have").drop("_have"), marked.limit(0).select("sample_key", F.lit("").alias("message"))
    warned = marked.filter("_have is null").select("sample_key", F.lit("dropped: no input").alias("message"))
    return marked.filter("_have").drop("_have"), warned


def pooled_groups(sheet: DataFrame) -> DataFrame:
    """Pools of biological samples by factor, condition, treatment, cell type, genome and layout: (group_id, members, n_samples,
    mode); members that ask for different peak modes make it `both`.  Controls take no part."""
    first = reads.first_per_key(sheet.filter(~is_control()), ["sample_id", "replicate"], "row")
    by = F.concat_ws("__", *[clean(c) for c in [*POOL, "genome", "layout"]])
    mode = F.lower(clean("macs2_mode"))
    members = F.array_join(F.array_sort(F.collect_set(sample_key())), ",")
    return first.groupBy(by.alias("group_id")).agg(
        members.alias("members"), F.count("*").alias("n_samples"), F.when(F.count_distinct(mode) > 1, "both").otherwise(F.max(mode)).alias("mode")
    )


def sample_table(sheet: DataFrame, peaks: DataFrame, peak_type: str, controls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(table, dropped samples) for the recount model: one row a biological sample that has peaks of the type, with its resolved
    control (first replicate of the named control) and PeakCaller `narrow`, or `bed` for broad peaks."""
    own = reads.first_per_key(sheet.filter(~is_control()), ["sample_id", "replicate"], "row").withColumn("sample_key", sample_key())
    first = controls.groupBy(clean("sample_id").alias("_control")).agg(F.min_by(clean("replicate"), "row").alias("_rep"))
    own = own.join(first, clean("control_id") == F.col("_control"), "left")
    control = F.when(clean("control_id") != "", F.concat(clean("control_id"), F.lit("_bioR"), F.coalesce("_rep", clean("replicate"))))
    kept, dropped = with_inputs(own.withColumn("ControlID", control), peaks.filter(F.col("peak_type") == peak_type))
    columns = {
        "SampleID": "sample_key", "Tissue": "cell_type", "Factor": "factor", "Condition": "condition", "Treatment": "treatment",
        "Replicate": "replicate", "ControlID": "ControlID"
    }
    return kept.select(*[F.col(c).alias(n) for n, c in columns.items()], F.lit("bed" if peak_type == "broad" else "narrow").alias("PeakCaller")), dropped


def spikein_samples(sheet: DataFrame) -> DataFrame:
    """One row for each biological sample that declares a spike-in, with the ratio as a number.

    Technical rows that disagree, an unknown genome or stage, and a ratio that is not finite and above 0 are errors when read.
    """
    values = {
        "layout": F.upper(clean("layout")), "host_genome": clean("genome"), "host_blacklist": clean("blacklist"),
        "spikein_genome": F.lower(clean("spikein_genome")), "spikein_to_host_ratio": clean("spikein_to_host_ratio"),
        "spikein_stage": F.lower(clean("spikein_stage")), "is_control": F.lower(clean("is_control"))
    }
    rows = sheet.select("row", clean("sample_id").alias("sample_id"), clean("replicate").alias("replicate"), *[c.alias(n) for n, c in values.items()])
    per = rows.groupBy("sample_id", "replicate").agg(
        F.count_distinct(F.struct(*values)).alias("_kinds"), F.min_by(F.struct(*values), "row").alias("_v")
    ).select("sample_id", "replicate", "_kinds", "_v.*")
    ratio = F.col("spikein_to_host_ratio").try_cast("double")
    good = F.coalesce((ratio > 0) & ~F.isnan(ratio) & (ratio < float("inf")), F.lit(False))
    key = F.concat("sample_id", F.lit("_bioR"), "replicate")
    stop = lambda text: F.raise_error(F.concat(F.lit(text), key))
    checked = (
        F.when(F.col("_kinds") > 1, stop("inconsistent spike-in metadata for "))
        .when(F.col("spikein_genome") == "", F.lit(""))
        .when(F.col("spikein_genome") != SPIKE_GENOME, stop("unknown spike-in genome for "))
        .when(~good, stop("spike-in ratio must be positive for "))
        .when(F.col("spikein_stage") != SPIKE_STAGE, stop(f"spike-in stage must be {SPIKE_STAGE} for "))
        .otherwise(key)
    )
    out = per.withColumn("key", checked).filter("key <> ''").withColumn("spikein_to_host_ratio", ratio)
    return out.select("key", "sample_id", "replicate", *values)


def eligibility(samples: DataFrame, least: int = 2) -> DataFrame:
    n = F.count_distinct("sample_key")
    return samples.groupBy("condition").agg(n.alias("replicates"), F.min("sheet_order").alias("first_seen"), (n >= least).alias("eligible")).withColumn(
        "reason", F.when(F.col("eligible"), "eligible").otherwise(F.concat(F.lit("fewer than "), F.lit(str(least)), F.lit(" replicates")))
    )


def condition_order(conditions: DataFrame, requested: tuple[str, ...] = (), reference: str | None = None) -> DataFrame:
    """(condition, ord): the reference, then requested names, then first appearance.  Duplicates and unknown names are errors."""
    if len(set(requested)) < len(requested):
        raise ValueError("a condition is named twice")
    seen = {r[0] for r in conditions.select("condition").collect()}  # conditions of a sheet
    if unknown := [c for c in (*requested, *([reference] if reference else [])) if c not in seen]:
        raise ValueError(f"unknown conditions: {unknown}")
    pos = F.lit(None).cast("int")
    for i, c in enumerate(requested):
        pos = F.when(F.col("condition") == c, i).otherwise(pos)
    first = F.when(F.col("condition") == reference, 0).otherwise(1) if reference else F.lit(1)
    w = Window.orderBy("_f", F.coalesce("_p", F.lit(1 << 20)), "first_seen")  # a row a condition
    return conditions.withColumns({"_f": first, "_p": pos}).withColumn("ord", F.row_number().over(w)).drop("_f", "_p")


def comparison_plan(ordered: DataFrame) -> DataFrame:
    """All pairs of eligible conditions; the later one is the numerator."""
    e = ordered.filter("eligible").select("condition", "ord")
    a, b = e.select(F.col("condition").alias("reference"), F.col("ord").alias("i")), e.select(F.col("condition").alias("numerator"), F.col("ord").alias("j"))
    pairs = a.join(b, F.col("i") < F.col("j"))
    n = F.row_number().over(Window.orderBy("i", "j"))  # a row a pair of conditions
    return pairs.select(
        F.concat(
            F.lpad(n.cast("string"), 3, "0"), F.lit("_"), reads.safe_token(F.col("numerator")), F.lit("_vs_"), reads.safe_token(F.col("reference"))
        ).alias("comparison_id"),
        "numerator", "reference"
    )


def merge_groups(sheet: DataFrame, fields: list[str], least: int = 2) -> DataFrame:
    """Replicate groups of at least `least` samples; a group with two layouts has layouts > 1."""
    return sheet.groupBy(F.concat_ws("__", *fields).alias("group_id")).agg(
        F.count_distinct("sample_key").alias("n_samples"), F.count_distinct("layout").alias("layouts"),
        F.array_join(F.array_sort(F.collect_set("sample_key")), ",").alias("members"),
        F.when(F.count_distinct("macs2_mode") > 1, "both").otherwise(F.max("macs2_mode")).alias("mode")
    ).filter(F.col("n_samples") >= least)


def comparison_summary(results: DataFrame, sig: Column) -> DataFrame:
    up, down = sig & (F.col("log2_fc") > 0), sig & (F.col("log2_fc") < 0)
    return results.groupBy("contrast").agg(
        F.count_if(F.col("padj").isNotNull()).alias("tested_sites"), F.count_if(sig).alias("significant_sites"),
        F.count_if(up).alias("higher_in_numerator"), F.count_if(down).alias("higher_in_reference")
    )


def rollup_status(df: DataFrame, keys: tuple[str, ...] = ("module", "peak_type")) -> DataFrame:
    return df.rollup(*keys).agg(
        F.count("*").alias("planned"), F.count_if(F.col("status") == "SUCCESS").alias("ok"), F.count_if(F.col("status") == "FAILED").alias("failed")
    )


#: Columns of the comparison summary, in order.  Fixed values.
SUMMARY = [
    "module", "peak_type", "comparison_id", "numerator", "reference", "numerator_replicates", "reference_replicates", "consensus_regions",
    "tested_sites", "significant_sites", "higher_in_numerator", "higher_in_reference", "alpha", "min_abs_log2fc", "status", "results_all",
    "results_significant", "summary_file", "message"
]


def comparison_status(
    plan: DataFrame, conditions: DataFrame, results: DataFrame, failures: DataFrame, module: str, peak_type: str, consensus_regions: int,
    alpha: float, min_lfc: float
) -> DataFrame:
    """The 19 columns of SUMMARY, a row for each planned comparison, or one SKIPPED row if none is planned.

    plan: comparison_id, numerator, reference; conditions: condition, replicates; results: comparison_id, log2_fc, padj;
    failures: comparison_id, message.  A comparison with a failure is FAILED whatever its results, one without results too;
    the others are SUCCESS.  One that fails leaves the others alone.
    """
    sig = F.coalesce((F.col("padj") <= alpha) & (F.abs("log2_fc") >= min_lfc), F.lit(False))
    sums = comparison_summary(results.withColumnRenamed("comparison_id", "contrast"), sig).withColumnRenamed("contrast", "comparison_id")
    sums = sums.withColumn("_seen", F.lit(True))
    n = lambda side: conditions.select(F.col("condition").alias(side), F.col("replicates").cast("long").alias(f"{side}_replicates"))
    broken = failures.groupBy("comparison_id").agg(F.min("message").alias("_failure"))
    out = plan.join(n("numerator"), "numerator", "left").join(n("reference"), "reference", "left").join(sums, "comparison_id", "left").join(broken, "comparison_id", "left")
    failed = F.col("_failure").isNotNull() | F.col("_seen").isNull()
    message = F.when(failed, F.coalesce("_failure", F.lit("no results"))).otherwise("")
    out = out.withColumns({"status": F.when(failed, "FAILED").otherwise("SUCCESS"), "message": message, "consensus_regions": F.lit(consensus_regions).cast("long")})
    out = out.withColumns({c: F.when(~failed, F.col(c)) for c in ("tested_sites", "significant_sites", "higher_in_numerator", "higher_in_reference")})
    name = lambda kind: F.when(~failed, F.concat("comparison_id", F.lit(kind)))
    out = out.withColumns({"results_all": name(".all.tsv"), "results_significant": name(".significant.tsv"), "summary_file": name(".summary.txt")})
    out = out.withColumns({"module": F.lit(module), "peak_type": F.lit(peak_type), "alpha": F.lit(alpha), "min_abs_log2fc": F.lit(min_lfc)}).select(*SUMMARY)
    skipped = {
        "module": F.lit(module), "peak_type": F.lit(peak_type), "consensus_regions": F.lit(consensus_regions).cast("long"), "alpha": F.lit(alpha),
        "min_abs_log2fc": F.lit(min_lfc), "status": F.lit("SKIPPED"), "message": F.lit("fewer than two conditions have enough replicates")
    }
    none = plan.agg(F.count("*").alias("_n")).filter("_n = 0")
    return out.unionByName(none.select(*[skipped.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in out.schema]))


def check_counts(counts: DataFrame, regions: DataFrame, samples: DataFrame) -> DataFrame:
    """One row: cells missing from the full matrix, negative and fractional ones."""
    want = regions.select("region_id").distinct().count() * samples.select("sample_key").distinct().count()
    return counts.agg(
        (F.lit(want) - F.count("*")).alias("missing"), F.count_if(F.col("n") < 0).alias("negative"),
        F.count_if(F.col("n") != F.floor("n")).alias("fractional"), F.count_if(F.col("n").isNull()).alias("null_cells")
    )


def check_ccre(df: DataFrame, expected: int | None = None, genome: str = "hg38") -> DataFrame:
    """One row: records, those off the canonical chromosomes, with bad coordinates, or with a class outside the vocabulary."""
    good = F.forall(F.split(F.col("ccre_class"), "[;,]"), lambda c: c.isin(*readers.CLASSES))
    out = df.agg(
        F.count("*").alias("records"), F.count_if(~reads.is_canonical(genome)).alias("noncanonical"),
        F.count_if((F.col("start_pos") < 0) | (F.col("end_pos") <= F.col("start_pos"))).alias("bad_coordinates"),
        F.count_if(~good).alias("unknown_class")
    )
    return out.withColumn("count_matches", F.lit(True) if expected is None else F.col("records") == expected)
