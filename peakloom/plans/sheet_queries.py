"""Queries over sample sheets, comparisons, normalisation records, reads and text files, each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate, counting, design, fastq, peaks, qc, reads, stats
from ..operators import intervals as iv
from ..sources import readers, writers
from . import fixture as fx
from . import queries as q
from .queries import query

S, E = iv.S, iv.E
SHEET = fx.cte("sheet")
CLEAN = (
    "c AS (SELECT row, coalesce(trim(sample_id), '') AS sid, trim(replicate) AS rep, trim(tech_replicate) AS tech, upper(layout) AS lay, "
    "lower(macs2_mode) AS mode, lower(is_control) IN ('true', '1', 'yes') AS control, trim(coalesce(spikein_genome, '')) AS sg, "
    "spikein_to_host_ratio AS sr, lower(trim(spikein_stage)) AS ss, * FROM sheet)"
)


def sheet(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "sheet")


# --- sheets

RULES = [
    ("error", "invalid layout", "lay NOT IN ('PE', 'SE')"), ("error", "invalid genome", "genome NOT IN ('hg38', 'mm39')"),
    ("error", "invalid macs2_mode", "mode NOT IN ('narrow', 'broad', 'both', 'none')"), (
        "error", "invalid is_control", "is_control NOT IN ('TRUE', 'FALSE', 'true', 'false', '1', '0', 'yes', 'no')"
    ),
    ("error", "replicate is not an integer", "try_cast(rep AS INT) IS NULL"), ("error", "tech_replicate is not an integer", "try_cast(tech AS INT) IS NULL"),
    ("error", "fastq_1 is empty", "fastq_1 = ''"), ("error", "paired-end row without fastq_2", "lay = 'PE' AND fastq_2 = ''"),
    ("warning", "single-end row with fastq_2", "lay = 'SE' AND fastq_2 <> ''"), ("warning", "control with control_id", "control AND control_id <> ''"),
    ("warning", "control with a peak mode", "control AND mode <> 'none'"), (
        "warning", "non-ATAC sample without control", "NOT control AND NOT starts_with(lower(assay), 'atac') AND control_id = ''"
    ),
    ("error", "unknown spike-in genome", "sg NOT IN ('', 'dm6')"), ("error", "unknown spike-in stage", "ss NOT IN ('', 'pre_tagmentation_nuclei')"),
    (
        "error", "spike-in ratio must be finite and above 0",
        "sg = 'dm6' AND NOT coalesce(try_cast(sr AS DOUBLE) > 0 AND isfinite(try_cast(sr AS DOUBLE)), false)"
    ),
    (
        "error", "spike-in stage must be pre_tagmentation_nuclei", "sg = 'dm6' AND ss <> 'pre_tagmentation_nuclei'"
    ), ("error", "spike-in fields without a genome", "sg <> 'dm6' AND (sr <> '' OR ss <> '')"),
]
query(
    "v4_sheet_violations",
    f"{SHEET}, {CLEAN} " + " UNION ALL ".join(f"SELECT row, '{level}' AS level, '{m}' AS message FROM c WHERE {test}" for level, m, test in RULES)
)(lambda spark, d: design.violations(sheet(spark, d)))
query("v3_repeated_keys",
    f"{SHEET}, {CLEAN} SELECT row, first_row FROM (SELECT row, min(row) OVER (PARTITION BY sid, rep, tech) AS first_row FROM c) WHERE row > "
    "first_row"
)(lambda spark, d: design.repeated_keys(sheet(spark, d)))
query("v2_duplicate_runs",
    f"{SHEET} SELECT {', '.join(c for c in design.CORE if c not in ('output_prefix', 'sample_id'))}, count(*) AS n FROM sheet GROUP BY ALL HAVING "
    "count(*) > 1"
)(lambda spark, d: design.duplicate_rows(sheet(spark, d), [c for c in design.CORE if c not in ("output_prefix", "sample_id")]))
query("v7_mixed_cohorts",
    f"{SHEET}, {CLEAN} SELECT factor, 'layout' AS \"column\", array_to_string(list_sort(list(DISTINCT layout)), ',') AS found FROM c GROUP BY 1 "
    "HAVING count(DISTINCT layout) > 1 UNION ALL SELECT factor, 'genome', array_to_string(list_sort(list(DISTINCT genome)), ',') FROM c GROUP BY "
    "1 HAVING count(DISTINCT genome) > 1"
)(lambda spark, d: design.mixed_cohorts(sheet(spark, d), ["factor"]))
query("v10_missing_peak_types",
    f"{SHEET}, {CLEAN} SELECT sid AS sample_id, rep AS replicate FROM (SELECT *, row_number() OVER (PARTITION BY sid, rep ORDER BY row) AS k FROM "
    "c WHERE NOT control) WHERE k = 1 AND trim(mode) <> 'both'"
)(lambda spark, d: design.both_peak_types(sheet(spark, d)))
query("v11_too_few_samples",
    f"{SHEET}, {CLEAN} SELECT factor, condition, count(DISTINCT sid || '_bioR' || rep) FILTER (NOT control) AS samples, 30::BIGINT AS required "
    "FROM c GROUP BY 1, 2 HAVING samples < 30"
)(lambda spark, d: design.too_few_samples(sheet(spark, d), 30, ["factor", "condition"]))
query(
    "v5_sheet_groups",
    f"{SHEET} " + " UNION ALL ".join(
        f"SELECT sample_id, replicate, '{c}' AS \"column\" FROM sheet GROUP BY 1, 2 HAVING count(DISTINCT {c}) > 1" for c in ("layout", "genome", "assay", "factor")
    )
)(lambda spark, d: design.inconsistent_groups(sheet(spark, d), ["sample_id", "replicate"], ["layout", "genome", "assay", "factor"]))
query("v6_unknown_controls", f"{SHEET}, {CLEAN} SELECT row, control_id FROM c WHERE control_id <> '' AND control_id NOT IN (SELECT sid FROM c)")(
    lambda spark,
    d: design.orphans(sheet(spark, d), "control_id", sheet(spark, d).select(F.trim("sample_id").alias("known")), "known").select("row", "control_id")
)
query("d1_first_rows", f"{SHEET} SELECT sample_id, replicate, min(row) AS row FROM sheet GROUP BY 1, 2")(
    lambda spark, d: reads.first_per_key(sheet(spark, d), ["sample_id", "replicate"], "row").select("sample_id", "replicate", "row")
)
POOLED = f"{SHEET}, {CLEAN}, f AS (SELECT * FROM c WHERE NOT control QUALIFY row_number() OVER (PARTITION BY sample_id, replicate ORDER BY row) = 1)"
query("a14_pooled_groups",
    f"{POOLED} SELECT concat_ws('__', factor, condition, treatment, cell_type, genome, layout) AS group_id, "
    "array_to_string(list_sort(list(DISTINCT sid || '_bioR' || rep)), ',') AS members, count(*) AS n_samples, CASE WHEN count(DISTINCT mode) > 1 "
    "THEN 'both' ELSE max(mode) END AS mode FROM f GROUP BY 1"
)(lambda spark, d: design.pooled_groups(sheet(spark, d)))
query("a13_replicate_groups",
    f"{POOLED} SELECT concat_ws('__', factor, condition, treatment, cell_type) AS group_id, count(DISTINCT sid || '_bioR' || rep) AS n_samples, "
    "count(DISTINCT layout) AS layouts, array_to_string(list_sort(list(DISTINCT sid || '_bioR' || rep)), ',') AS members, CASE WHEN "
    "count(DISTINCT macs2_mode) > 1 THEN 'both' ELSE max(macs2_mode) END AS mode FROM f GROUP BY 1 HAVING n_samples >= 2"
)(
    lambda spark, d: design.merge_groups(reads.first_per_key(sheet(spark, d).filter(~design.is_control()), ["sample_id", "replicate"], "row").withColumn("sample_key", design.sample_key()), design.POOL))


@query("q12_spikein_samples",
    f"{SHEET}, {CLEAN} SELECT sid || '_bioR' || rep || '_' || row AS key, lay AS layout, genome AS host_genome, 0.5::DOUBLE AS "
    "spikein_to_host_ratio, ss AS spikein_stage FROM c WHERE sg = 'dm6' AND sr = '0.5' AND ss = 'pre_tagmentation_nuclei'"
)
def spikein_samples(spark, d):
    """Runs with a whole declaration, each taken as a sample of its own (rows of a sample disagree in this sheet)."""
    apart = sheet(spark, d).withColumn("replicate", F.concat_ws("_", "replicate", F.col("row").cast("string")))
    wrong = design.violations(apart).filter(F.col("message").contains("spike-in")).select("row").distinct()
    return design.spikein_samples(apart.join(wrong, "row", "left_anti")).select("key", "layout", "host_genome", "spikein_to_host_ratio", "spikein_stage")


@query("j10_resolved_controls",
    f"{SHEET}, {CLEAN}, k AS (SELECT DISTINCT sid, rep FROM c WHERE control), f AS (SELECT sid, min(rep) AS first_rep FROM k GROUP BY 1) SELECT "
    "row, CASE WHEN control_id = '' THEN NULL ELSE control_id || '_bioR' || CASE WHEN k.rep IS NOT NULL THEN c.rep ELSE first_rep END END AS "
    "control_key FROM c LEFT JOIN k ON k.sid = control_id AND k.rep = c.rep LEFT JOIN f ON f.sid = control_id WHERE control_id = '' OR first_rep "
    "IS NOT NULL"
)
def resolved_controls(spark, d):
    s = sheet(spark, d).withColumns({"sample_id": F.trim("sample_id"), "replicate": F.trim("replicate")})
    controls = s.filter(design.is_control())
    known = s.filter("control_id <> ''").join(controls.select(F.col("sample_id").alias("control_id")).distinct(), "control_id", "left_semi")
    return design.resolve_controls(s.filter("control_id = ''").unionByName(known.select(*s.columns)), controls).select("row", "control_key")


INPUTS = (
    "i AS (SELECT DISTINCT concat('S', CAST(o_custkey % 499 AS VARCHAR), '_bioR', CAST(o_custkey % 3 + 1 AS VARCHAR)) AS sample_key FROM orders "
    "WHERE o_orderstatus <> 'P')"
)


def inputs(spark, d):
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.selectExpr(
        "concat('S', CAST(o_custkey % 499 AS STRING), '_bioR', CAST(o_custkey % 3 + 1 AS STRING)) AS sample_key",
        "CASE WHEN o_orderstatus <> 'P' THEN 'narrow' ELSE 'broad' END AS peak_type"
    )


query("q11_sample_table",
    f"{POOLED}, {INPUTS}, k AS (SELECT sid, arg_min(rep, row) AS r FROM c WHERE control GROUP BY 1) SELECT f.sid || '_bioR' || f.rep AS "
    "\"SampleID\", cell_type AS \"Tissue\", factor AS \"Factor\", condition AS \"Condition\", treatment AS \"Treatment\", replicate AS "
    "\"Replicate\", CASE WHEN control_id <> '' THEN control_id || '_bioR' || coalesce(k.r, f.rep) END AS \"ControlID\", 'narrow' AS "
    "\"PeakCaller\" FROM f JOIN i ON i.sample_key = f.sid || '_bioR' || f.rep LEFT JOIN k ON k.sid = control_id"
)(lambda spark, d: design.sample_table(sheet(spark, d), inputs(spark, d), "narrow", sheet(spark, d).filter(design.is_control()))[0])
query("f11_dropped_samples",
    f"{POOLED}, {INPUTS} SELECT f.sid || '_bioR' || f.rep AS sample_key, 'dropped: no input' AS message FROM f WHERE f.sid || '_bioR' || f.rep NOT "
    "IN (SELECT sample_key FROM i)"
)(lambda spark, d: design.sample_table(sheet(spark, d), inputs(spark, d), "narrow", sheet(spark, d).filter(design.is_control()))[1])

# --- conditions and comparisons

query("a10_condition_order",
    f"{fx.cte('samples')}, {q.fx.cte('peaks').removeprefix('WITH ')}, e AS (SELECT condition, count(DISTINCT p.sample_key) AS replicates, "
    "min(sheet_order) AS o FROM peaks p JOIN samples USING (sample_key) GROUP BY 1) SELECT condition, replicates, row_number() OVER (ORDER BY "
    "condition <> 'Day4', CASE condition WHEN 'solo' THEN 0 WHEN 'prolif' THEN 1 ELSE 9 END, o) AS ord FROM e"
)(
    lambda spark, d: design.condition_order(design.eligibility(q.sheet(spark, d)), ("solo", "prolif"), "Day4").select("condition", "replicates", F.col("ord").cast("long").alias("ord")))
PLAN = [("001_prolif_vs_stem", "prolif", "stem"), ("002_Day4_vs_stem", "Day4", "stem"), ("003_Day4_vs_prolif", "Day4", "prolif")]
#: Comparisons that orders are read as results of: two planned ones and one that is not planned.
RESULT_IDS = [PLAN[0][0], PLAN[1][0], "009_extra"]
RESULTS = (
    f"res AS (SELECT {RESULT_IDS}[(o_orderkey % 3 + 1)::INT] AS comparison_id, ((o_orderkey * 7919) % 10007 + 1) / 10008.0::DOUBLE AS padj,"
    " (o_custkey % 9 - 4) / 2.0::DOUBLE AS log2_fc FROM orders)"
)


def results(spark, d):
    key = F.element_at(F.array(*[F.lit(x) for x in RESULT_IDS]), (F.col("o_orderkey") % 3 + 1).cast("int"))
    o = spark.read.parquet(f"{d}/orders.parquet")
    return o.select(
        key.alias("comparison_id"), (((F.col("o_orderkey") * 7919) % 10007 + 1) / F.lit(10008.0)).alias("padj"),
        ((F.col("o_custkey") % 9 - 4) / F.lit(2.0)).alias("log2_fc")
    )


SIG = "padj <= 0.05 AND abs(log2_fc) >= 1"
SUMS = (
    f"comparison_id, count(*) AS tested_sites, count(*) FILTER ({SIG}) AS significant_sites, count(*) FILTER ({SIG} AND log2_fc > 0) AS "
    f"higher_in_numerator, count(*) FILTER ({SIG} AND log2_fc < 0) AS higher_in_reference"
)
query("a11_comparison_summary", f"WITH {RESULTS} SELECT {SUMS} FROM res GROUP BY 1")(
    lambda spark,
    d: design.comparison_summary(
        results(spark, d).withColumnRenamed("comparison_id", "contrast"), stats.significant(0.05, 1.0)
    ).withColumnRenamed("contrast", "comparison_id")
)


@query("x4_comparison_status",
    f"{fx.cte('samples')}, {fx.cte('peaks').removeprefix('WITH ')}, {RESULTS}, {q.CONSENSUS}, e AS (SELECT condition, count(DISTINCT p.sample_key) "
    "AS n FROM peaks p JOIN samples USING (sample_key) GROUP BY 1), pl(comparison_id, numerator, reference) AS (VALUES "
    f"{', '.join(map(str, PLAN))}), su AS (SELECT {SUMS} FROM res GROUP BY 1 HAVING comparison_id = '{PLAN[0][0]}') SELECT 'model' AS module, "
    "'narrow' AS peak_type, comparison_id, numerator, reference, a.n AS numerator_replicates, b.n AS reference_replicates, (SELECT count(*) FROM "
    "regions) AS consensus_regions, tested_sites::DOUBLE AS tested_sites, significant_sites::DOUBLE AS significant_sites, "
    "higher_in_numerator::DOUBLE AS higher_in_numerator, higher_in_reference::DOUBLE AS higher_in_reference, 0.05::DOUBLE AS alpha, 1.0::DOUBLE "
    "AS min_abs_log2fc, CASE WHEN tested_sites IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN tested_sites IS NOT NULL THEN "
    "comparison_id || '.all.tsv' END AS results_all, CASE WHEN tested_sites IS NOT NULL THEN comparison_id || '.significant.tsv' END AS "
    "results_significant, CASE WHEN tested_sites IS NOT NULL THEN comparison_id || '.summary.txt' END AS summary_file, CASE WHEN comparison_id = "
    f"'{PLAN[1][0]}' THEN 'did not converge' WHEN tested_sites IS NULL THEN 'no results' ELSE '' END AS message FROM pl JOIN e a ON a.condition = "
    "numerator JOIN e b ON b.condition = reference LEFT JOIN su USING (comparison_id)"
)
def comparison_status(spark, d):
    conditions = design.eligibility(q.sheet(spark, d))
    plan = design.comparison_plan(design.condition_order(conditions))
    failures = results(spark, d).filter(F.col("comparison_id") == PLAN[1][0]).select("comparison_id", F.lit("did not converge").alias("message"))
    out = design.comparison_status(plan, conditions, results(spark, d), failures, "model", "narrow", q.regions(spark, d).count(), 0.05, 1.0)
    return out.withColumns({c: F.col(c).cast("double") for c in ("tested_sites", "significant_sites", "higher_in_numerator", "higher_in_reference")})


@query("x5b_contrast_manifest",
    f"WITH {RESULTS}, pl(comparison_id) AS (VALUES {', '.join(f'({p[0]!r})' for p in PLAN)}) SELECT comparison_id, 'planned only' AS side FROM pl "
    "WHERE comparison_id NOT IN (SELECT comparison_id FROM res) UNION ALL SELECT DISTINCT comparison_id, 'result only' FROM res WHERE "
    "comparison_id NOT IN (SELECT comparison_id FROM pl)"
)
def contrast_manifest(spark, d):
    plan = design.comparison_plan(design.condition_order(design.eligibility(q.sheet(spark, d))))
    return peaks.mismatched_plan(plan, results(spark, d))


ISOLATED = (
    f"{fx.cte('samples')}, {fx.cte('peaks').removeprefix('WITH ')}, e AS (SELECT condition, count(DISTINCT p.sample_key) AS n, min(sheet_order) AS o FROM peaks p JOIN samples USING (sample_key) GROUP BY 1),"
    " w AS (SELECT *, row_number() OVER (ORDER BY o) AS i FROM e), pl AS (SELECT lpad((row_number() OVER (ORDER BY a.i, b.i))::VARCHAR, 3, '0') || '_' || b.condition || '_vs_' || a.condition AS comparison_id,"
    " b.condition AS numerator, a.condition AS reference, b.n AS numerator_replicates, a.n AS reference_replicates FROM w a JOIN w b ON a.i < b.i)"
)


@query("x4_isolated_comparisons",
    f"{ISOLATED} SELECT *, CASE WHEN least(numerator_replicates, reference_replicates) < 2 THEN 'FAILED' ELSE 'SUCCESS' END AS status, CASE WHEN "
    "numerator_replicates < 2 THEN 'condition ' || numerator || ' is not in the model' WHEN reference_replicates < 2 THEN 'condition ' || "
    "reference || ' is not in the model' ELSE '' END AS message FROM pl"
)
def isolated_comparisons(spark, d):
    """All pairs are planned, with the condition of one sample too, which the model leaves out: its comparisons fail, those of the
    others are fitted."""
    conditions = design.eligibility(q.sheet(spark, d))
    plan = design.comparison_plan(design.condition_order(conditions.withColumn("eligible", F.lit(True))))
    counts, factors, used, order = q.model_counts(spark, d)
    pairs = {r.comparison_id: (r.numerator, r.reference) for r in plan.collect()}  # a row a pair of conditions
    fitted, failures = stats.completed(stats.nb_comparisons(counts, factors, stats.model(used, order), pairs))
    table = stats.bh(fitted).select(F.col("contrast").alias("comparison_id"), "log2_fc", "padj")
    out = design.comparison_status(plan, conditions, table, failures.withColumnRenamed("contrast", "comparison_id"), "model", "narrow", 0, 0.05, 1.0)
    return out.select("comparison_id", "numerator", "reference", "numerator_replicates", "reference_replicates", "status", "message")


# --- regions

query("i4_single_sample", f"{fx.cte('peaks')}, one AS (SELECT * FROM peaks WHERE sample_key = 'solo_bioR1') SELECT * FROM {q.merged_sql('one', 'chrom')}")(
    lambda spark,
    d: iv.consensus_or_single(fx.table(spark, d, "peaks").filter("sample_key = 'solo_bioR1'"), ["chrom"], "sample_key", allow_single=True)
)
query(
    "f12_nonzero_regions",
    f"{q.BASE} SELECT region_id, sample_key, n FROM counts WHERE region_id IN (SELECT region_id FROM counts GROUP BY 1 HAVING sum(n) > 0)"
)(lambda spark, d: counting.nonzero_regions(q.matrix(spark, d)))
query(
    "v16_empty_samples", f"{q.BASE} SELECT sample_key, 0::BIGINT AS total FROM counts GROUP BY 1 HAVING sum(n) = 0"
)(lambda spark, d: counting.empty_samples(q.matrix(spark, d), fx.samples(spark)))
query("j9_annotated_results",
    f"{q.ANNOTATION} SELECT region_id, (end_pos - start_pos)::BIGINT AS width, gene_context, ccre_primary_class FROM ctx LEFT JOIN c1 USING "
    "(region_id)"
)(lambda spark, d: annotate.join_annotations(q.regions(spark, d).select("region_id", (F.col(E) - F.col(S)).alias("width")), q.annotated(spark, d)).select("region_id", "width", "gene_context", "ccre_primary_class"))
query("v15_results_outside",
    f"{fx.cte('peaks')}, {q.CONSENSUS} SELECT DISTINCT printf('peak_%06d', o_orderkey) AS region_id FROM orders WHERE printf('peak_%06d', "
    "o_orderkey) NOT IN (SELECT region_id FROM regions)"
)(lambda spark, d: design.orphans(spark.read.parquet(f"{d}/orders.parquet").select(F.format_string("peak_%06d", F.col("o_orderkey")).alias("region_id")).distinct(), "region_id", q.regions(spark, d), "region_id"))
query("flagship",
    f"{q.BASE}, {q.FACTORS}, cs AS (SELECT sample_key, sum(n)::BIGINT AS s FROM counts GROUP BY 1), k AS (SELECT sample_key, round(size_factor, 9) "
    "AS size_factor, round(1e6 / (size_factor * exp(avg(ln(s)) OVER ())), 6) AS robust_cpm_scale FROM sf JOIN cs USING (sample_key)) SELECT "
    "region_id, sample_key, n, size_factor, robust_cpm_scale FROM counts JOIN k USING (sample_key)"
)(
    lambda spark, d: q.flagship(spark, d).withColumns({"size_factor": F.round("size_factor", 9), "robust_cpm_scale": F.round("robust_cpm_scale", 6)}))

# --- quality control

HIT = (
    "EXISTS (SELECT 1 FROM peaks p WHERE {t} p.sample_key = f.sample_key AND p.chrom = f.chrom AND p.start_pos < f.end_pos AND f.start_pos < "
    "p.end_pos)"
)
NARROW, BROAD = HIT.format(t="p.peak_type = 'narrow' AND"), HIT.format(t="p.peak_type = 'broad' AND")
SHARES = (
    "fr AS (SELECT sample_key, count(*) AS mapped, round(count(*) FILTER (n) / count(*), 4) AS frip_narrow, round(count(*) FILTER (b) / count(*), "
    f"4) AS frip_broad FROM (SELECT f.sample_key, {NARROW} AS n, {BROAD} AS b FROM frag f WHERE (flag & 4) = 0) GROUP BY 1)"
)


@query("a6_frip_sets",
    f"{fx.cte('frag', 'peaks')}, {q.CONSENSUS}, {SHARES}, co AS (SELECT sample_key, round(count(*) FILTER (hit) / count(*), 4) AS frip_consensus "
    "FROM (SELECT f.sample_key, EXISTS (SELECT 1 FROM regions r WHERE r.chrom = f.chrom AND r.start_pos < f.end_pos AND f.start_pos < r.end_pos) "
    "AS hit FROM frag f WHERE (flag & 4) = 0) GROUP BY 1) SELECT sample_key, mapped, frip_narrow, frip_broad, frip_consensus FROM fr JOIN co "
    "USING (sample_key)"
)
def frip_sets(spark, d):
    p = fx.table(spark, d, "peaks")
    sets = {
        "narrow": p.filter("peak_type = 'narrow'"), "broad": p.filter("peak_type = 'broad'"),
        "consensus": iv.consensus(q.called(spark, d), ["chrom"], "sample_key")
    }
    return qc.frip_by_peak_set(q.frag(spark, d).filter(F.col("flag").bitwiseAND(F.lit(4)) == 0), sets, ["qname"])


@query("q1_summary_rows",
    f"{fx.cte('frag', 'peaks')}, {q.DUP}, {SHARES}, r AS (SELECT sample_key, count(*) FILTER ((flag & 4) = 0) AS total, round(100.0 * count(*) "
    "FILTER (is_dup) / count(*), 2)::DOUBLE AS dup, count(*) FILTER ((flag & 4) = 0 AND chrom IN ('chrM', 'MT', 'M')) AS mito FROM dup GROUP BY "
    "1), p AS (SELECT sample_key, count(*) FILTER (peak_type = 'narrow') AS nn, count(*) FILTER (peak_type = 'broad') AS nb, "
    "quantile_cont(end_pos - start_pos, 0.5) FILTER (peak_type = 'narrow') AS w, greatest(max(signal) FILTER (peak_type = 'narrow'), 0.0) AS m "
    "FROM peaks GROUP BY 1) SELECT sample_key AS sample_id, 'ATAC-seq' AS assay, 'filtered/' || sample_key || '.sam' AS bam_file, total AS "
    "total_reads, dup AS duplication_pct, total AS bl_filtered_reads, mito AS mito_reads, round(100 * mito / total, 2) AS mito_pct, nn AS "
    "n_narrow_peaks, nb AS n_broad_peaks, w AS peak_width_median, m AS peak_max_signal, frip_narrow, frip_broad, CASE WHEN nn = 0 AND nb = 0 THEN "
    "'NO_PEAKS' WHEN nn < 200 AND nb < 200 THEN 'POOR' ELSE 'PASS' END AS qc_status, '' AS notes FROM r JOIN p USING (sample_key) JOIN fr USING "
    "(sample_key)"
)
def summary_rows(spark, d):
    return qc.summary_rows(reads.mark_duplicates(q.frag(spark, d)), fx.table(spark, d, "peaks"), q.sheet(spark, d).withColumn("assay", F.lit("ATAC-seq")), ["qname"])


# --- normalisation records

CHECK = (
    "ck AS (SELECT sha256(concat_ws(':', count(*)::VARCHAR, coalesce(sum(('0x' || substr(md5(concat_ws(':', chrom, start_pos::VARCHAR, "
    "end_pos::VARCHAR)), 1, 15))::BIGINT::HUGEINT), 0)::VARCHAR)) AS sum FROM regions)"
)
BINS = (
    "count(*) AS signal_count, count(*) FILTER (mapq = 0) AS mapq_0, count(*) FILTER (mapq BETWEEN 1 AND 9) AS mapq_1_9, count(*) FILTER (mapq "
    "BETWEEN 10 AND 29) AS mapq_10_29, count(*) FILTER (mapq >= 30) AS mapq_30_plus"
)


def records(spark, d, policies: list[tuple[str, int, bool]]) -> list[DataFrame]:
    """A record table a policy; duplicates are marked and units meet the regions once for all of them."""
    f, r = q.marked(spark, d), q.regions(spark, d)
    units = reads.signal_units(f.filter(reads.policy("sensitivity", "PE", 0) & reads.is_canonical()), "PE")
    joined = fx.kept(counting.policy_counts(units, r, {p: (m, x) for p, m, x in policies}), "counts")
    out = []
    for policy, min_mapq, drops in policies:
        kept = units.filter((F.col("mapq") >= min_mapq) & ~(F.lit(drops) & F.col("is_dup")))
        counts = fx.kept(counting.complete(counting.of_policy(joined, policy), r, fx.samples(spark)), "counts")
        out.append(counting.normalisation_record(kept, counting.scales(counts), r, q.sheet(spark, d), policy, min_mapq, drops))
    return out


POLICIES = [("permissive", 0, False), ("intermediate", 0, True), ("stringent", 30, True)]
KEPT = "SELECT * FROM dup WHERE (flag & 2) = 2 AND (flag & 2828) = 0 AND (flag & 66) = 66 AND " + q.CANON


@query("u3_policy_records", f"{fx.cte('frag', 'peaks')}, {q.CONSENSUS}, {q.DUP}, {CHECK}, k AS ({KEPT}) " + " UNION ALL ".join((
    f"SELECT sample_key AS key, '{p}' AS policy, {m}::INT AS minimum_mapq, {BINS}, (SELECT sum FROM ck) AS consensus_sha256 FROM k WHERE mapq >= "
    f"{m} {'AND NOT is_dup' if x else ''} GROUP BY 1"
) for p, m, x in POLICIES))
def policy_records(spark, d):
    union = counting.in_sheet_order(*records(spark, d, POLICIES))
    return union.select("key", "policy", "minimum_mapq", "signal_count", "mapq_0", "mapq_1_9", "mapq_10_29", "mapq_30_plus", "consensus_sha256")


@query("n11_normalisation_record",
    f"{fx.cte('frag', 'peaks', 'samples')}, {q.CONSENSUS}, {q.DUP}, {CHECK}, units AS ({KEPT} AND mapq >= 30 AND NOT is_dup), {q.COUNTS}, "
    f"{q.FACTORS}, cs AS (SELECT sample_key, sum(n)::BIGINT AS s FROM counts GROUP BY 1), u AS (SELECT sample_key, {BINS} FROM units GROUP BY 1) "
    "SELECT sample_key AS key, 'stringent' AS policy, 'dedup' AS source_bam_stage, 'removed' AS duplicate_policy, 'one_primary_default' AS "
    "bowtie2_reporting, 30::INT AS minimum_mapq, 'excluded' AS secondary_alignments, 'excluded' AS supplementary_alignments, 'hg38' AS genome, "
    "'PE' AS layout, 'fragments' AS signal_unit, signal_count, mapq_0, mapq_1_9, mapq_10_29, mapq_30_plus, (SELECT sum FROM ck) AS "
    "consensus_sha256, s AS consensus_count_sum, round(exp(avg(ln(s)) OVER ()), 6) AS cohort_geometric_mean_column_sum, round(size_factor, 6) AS "
    "deseq2_size_factor, round(1 / size_factor, 6) AS deseq2_consensus_scale, round(1e6 / (size_factor * exp(avg(ln(s)) OVER ())), 6) AS "
    "deseq2_robust_cpm_scale FROM u JOIN cs USING (sample_key) JOIN sf USING (sample_key)"
)
def normalisation_record(spark, d):
    r = records(spark, d, POLICIES[2:])[0]
    return r.select(*[F.round(c, 6).alias(c) if c.startswith(("cohort", "deseq2")) else F.col(c) for c in counting.RECORD])


# --- reads

ADAPTER = fastq.ADAPTERS[0]
LENGTH = "length(seq)"


def fq(spark, d):
    return fx.table(spark, d, "reads")


query("q13_position_profile", (
    f"{fx.cte('reads')}, b AS (SELECT unnest(range(0, length(seq))) AS position, seq, qual FROM reads), x AS (SELECT position, substr(seq, "
    "position + 1, 1) AS base, ascii(substr(qual, position + 1, 1)) - 33 AS q FROM b) SELECT position, count(*) AS reads, round(avg(q), 6) AS "
    "mean_quality, quantile_cont(q, 0.25) AS q25, quantile_cont(q, 0.5) AS q50, quantile_cont(q, 0.75) AS q75, "
) + ", ".join(f"count(*) FILTER (base = '{b}') AS n_{b.lower()}" for b in "ACGTN") + " FROM x GROUP BY 1")(lambda spark, d: fastq.position_profile(fq(spark, d)).withColumn("position", F.col("position").cast("long")))
query("q13_read_profile",
    f"{fx.cte('reads')} SELECT length(seq) AS length, CAST(floor(100 * length(regexp_replace(seq, '[^GC]', '', 'g')) / length(seq)) AS BIGINT) AS "
    "gc_percent, count(*) AS reads, sum(length(regexp_replace(seq, '[^N]', '', 'g')))::BIGINT AS n_bases, count(*) FILTER "
    f"({' OR '.join(f'contains(seq, {a!r})' for a in fastq.ADAPTERS)}) AS with_adapter FROM reads GROUP BY 1, 2"
)(lambda spark, d: fastq.read_profile(fq(spark, d)))
query(
    "q13_duplication_levels",
    f"{fx.cte('reads')} SELECT level, count(*) AS sequences FROM (SELECT seq, count(*) AS level FROM reads GROUP BY 1) GROUP BY 1"
)(lambda spark, d: fastq.duplication_levels(fq(spark, d)))
ENDS = " ".join(f"WHEN length(s) >= {n} AND right(s, {n}) = '{ADAPTER[:n]}' THEN length(s) - {n}" for n in range(len(ADAPTER) - 1, 0, -1))
query("q14_trimmed_reads",
    f"{fx.cte('reads')}, a AS (SELECT *, CASE WHEN right(qual, 5) = '#####' THEN left(seq, length(seq) - 5) ELSE seq END AS s FROM reads), t AS "
    f"(SELECT *, left(s, CASE WHEN contains(s, '{ADAPTER}') THEN strpos(s, '{ADAPTER}') - 1 {ENDS} ELSE length(s) END) AS cut FROM a) SELECT "
    "sample_key, read_id, mate, cut AS seq, left(qual, length(cut)) AS qual FROM t WHERE (sample_key, read_id) NOT IN (SELECT (sample_key, "
    "read_id) FROM t WHERE length(cut) < 20)"
)(lambda spark, d: fastq.trim(fq(spark, d), ADAPTER))

# --- text files: written from the tables, read by the library's readers


def written(spark: SparkSession, lines: DataFrame, name: str, partition: str | None = None) -> str:
    path = fx.folder(spark, name)
    (lines.write if partition is None else lines.write.partitionBy(partition)).text(path)
    return path


def tabbed(*columns: str) -> F.Column:
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value")


@query("s1_samplesheet",
    f"{SHEET} SELECT count(*) AS rows, count(DISTINCT sample_id) AS samples, count(*) FILTER (layout = 'PE') AS paired, count(*) FILTER (fastq_2 "
    "<> '') AS with_mate FROM sheet"
)
def read_sheet(spark, d):
    path = fx.folder(spark, "sheet")
    sheet(spark, d).drop("row").coalesce(1).write.option("header", True).option("quoteAll", True).csv(path)
    s = readers.samplesheet(spark, path)
    return s.agg(
        F.count_distinct("row").alias("rows"), F.count_distinct("sample_id").alias("samples"), F.count_if(F.col("layout") == "PE").alias("paired"),
        F.count_if(F.col("fastq_2") != "").alias("with_mate")
    )


@query("s2_alignments",
    f"{fx.cte('frag')} SELECT qname, flag::INT AS flag, chrom, start_pos, start_pos + 50 AS reference_end, mapq::INT AS mapq, tlen::BIGINT AS "
    "tlen, CASE WHEN has_xs THEN '-1' END AS xs FROM frag"
)
def read_alignments(spark, d):
    f = q.frag(spark, d).withColumns(
        {
            "pos": F.col(S) + 1, "cigar": F.lit("30M5I20M4S"), "mate": F.col(E) - 49, "eq": F.lit("="), "seq": F.lit("A"), "q": F.lit("I"),
            "tag": F.when(F.col("has_xs"), "XS:i:-1").otherwise("NM:i:0")
        }
    )
    a = readers.alignments(spark, written(
        spark, f.select(tabbed("qname", "flag", "chrom", "pos", "mapq", "cigar", "eq", "mate", "tlen", "seq", "q", "tag")), "sam"
    ))
    return a.select(
        "qname", "flag", "chrom", "start_pos", readers.reference_end().alias("reference_end"), "mapq", "tlen",
        F.get(F.filter(F.map_values(F.map_filter("tags", lambda k, v: k == "XS")), lambda v: v.isNotNull()), F.lit(0)).alias("xs")
    )


query("s3_bed", f"{fx.cte('peaks')} SELECT chrom, start_pos, end_pos, peak_no::VARCHAR AS name FROM peaks")(
    lambda spark, d: readers.bed(spark, written(spark, fx.table(spark, d, "peaks").select(tabbed("chrom", S, E, "peak_no")), "bed"))
)


@query("s4_peaks", f"{fx.cte('peaks')} SELECT sample_key, peak_type, chrom, start_pos, end_pos, peak_no::VARCHAR AS name FROM peaks")
def read_peaks(spark, d):
    p = fx.table(spark, d, "peaks").withColumns(
        {
            "file": F.concat("sample_key", F.lit("_peaks."), "peak_type", F.lit("Peak")), "score": F.lit(0), "dot": F.lit("."), "one": F.lit(1.0),
            "top": F.lit(-1)
        }
    )
    path = written(spark, p.select("file", tabbed("chrom", S, E, "peak_no", "score", "dot", "signal", "one", "one", "top")), "peaks", "file")
    return readers.peaks(spark, f"{path}/*/*").select("sample_key", "peak_type", "chrom", S, E, "name")


query("s5_bedgraph", f"{fx.cte('frag')}, {q.UNITS}, {q.COVER} SELECT chrom, start_pos, end_pos, depth::DOUBLE AS score FROM cov")(
    lambda spark, d: readers.bedgraph(spark, written(spark, counting.coverage(q.units(spark, d)).select(tabbed("chrom", S, E, "depth")), "bedgraph"))
)


@query("s6_gtf_tss",
    f"{fx.cte('genes')} SELECT chrom, CASE WHEN strand = '-' THEN end_pos - 1 ELSE start_pos END AS tss, strand, arg_min(gene_name, gene_id) AS "
    "name FROM genes GROUP BY 1, 2, 3"
)
def read_gtf(spark, d):
    """Each gene stands twice in the file, the second time under a smaller name: the name first seen counts."""
    g = fx.table(spark, d, "genes").withColumns({"first": F.col(S) + 1, "x": F.lit("x"), "kind": F.lit("gene"), "dot": F.lit(".")})
    g = g.withColumn("name", F.explode(F.array("gene_name", F.concat(F.lit("A"), "gene_name")))).withColumn(
        "a", F.format_string('gene_id "%s"; gene_name "%s";', F.col("gene_id"), F.col("name"))
    )
    lines = g.orderBy("gene_id", F.col("name").desc()).select(tabbed("chrom", "x", "kind", "first", E, "dot", "strand", "dot", "a"))
    return readers.tss_bed(readers.gtf(spark, written(spark, lines, "gtf")))


@query("s7_ccre",
    f"{fx.cte('ccre')} SELECT chrom, start_pos, end_pos, ccre_id, CASE WHEN ccre_class = 'PLS' THEN 'PLS;CTCF-bound' ELSE ccre_class END AS "
    f"ccre_class FROM ccre WHERE {q.CANON}"
)
def read_ccre(spark, d):
    return readers.ccre(spark, written(spark, ccre_lines(spark, d).select(tabbed("chrom", S, E, "ccre_id", "other", "label")), "ccre"), reads.is_canonical())


def ccre_lines(spark, d):
    return fx.table(spark, d, "ccre").withColumns(
        {"other": F.lit("x"), "label": F.when(F.col("ccre_class") == "PLS", "PLS,CTCF-bound").otherwise(F.col("ccre_class"))}
    )


@query("s7_numbered_ccre",
    f"{fx.cte('ccre')} SELECT chrom, start_pos, end_pos, 'ccre_' || row_number() OVER (ORDER BY CAST(substr(ccre_id, 3) AS BIGINT)) AS ccre_id "
    f"FROM ccre WHERE {q.CANON}"
)
def read_numbered_ccre(spark, d):
    """Elements without ids get their number among the kept rows of the file."""
    lines = ccre_lines(spark, d).orderBy(F.substring("ccre_id", 3, 20).cast("long")).withColumn("ccre_id", F.lit(""))
    return readers.ccre(
        spark, written(spark, lines.select(tabbed("chrom", S, E, "ccre_id", "other", "label")), "ccre"), reads.is_canonical()
    ).drop("ccre_class")


query("s8_chrom_sizes", f"{fx.cte('frag')} SELECT chrom, max(end_pos) AS size FROM frag GROUP BY 1")(
    lambda spark,
    d: readers.chrom_sizes(spark, written(spark, q.frag(spark, d).groupBy("chrom").agg(F.max(E).alias("size")).select(tabbed("chrom", "size")), "sizes"))
)


@query("s9_count_matrix", f"{q.BASE} SELECT chrom, start_pos, end_pos, sample_key, n FROM counts JOIN regions USING (region_id)")
def read_matrix(spark, d):
    path = fx.folder(spark, "matrix")
    writers.tsv(writers.wide_matrix(q.matrix(spark, d), q.regions(spark, d), fx.KEYS).drop("region_id"), path)
    return readers.count_matrix(spark, path, fx.KEYS)


@query("s10_keyed_table", f"{q.BASE}, {q.FACTORS} SELECT sample_key AS key, round(size_factor, 6) AS value FROM sf")
def read_factors(spark, d):
    path = fx.folder(spark, "factors")
    writers.tsv(counting.poscounts_factors(q.matrix(spark, d)).select(F.col("sample_key").alias("key"), F.round("size_factor", 6).alias("size_factor")), path)
    return readers.keyed_value(spark, path, "size_factor")


def fastq_folder(spark, d) -> str:
    lines = F.concat_ws("\n", F.concat(F.lit("@"), "read_id", F.lit(" x")), "seq", F.lit("+"), "qual").alias("value")
    return written(spark, fq(spark, d).select(lines), "fastq")


READS = f"{fx.cte('reads')} SELECT read_id, 1::INT AS mate, seq, qual FROM reads"
query("s13_fastq", READS)(lambda spark, d: readers.fastq(spark, fastq_folder(spark, d)))
query("s13_fastq_ranges", READS)(lambda spark, d: readers.fastq(spark, fastq_folder(spark, d), split_bytes=64 << 10))
