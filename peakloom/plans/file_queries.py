"""Queries over track families, sinks that are read back, metric files and whole reports, each with DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import counting, design, qc, reads, stats
from ..operators import intervals as iv
from ..sources import readers, writers
from . import fixture as fx
from . import queries as q
from . import sheet_queries as sq
from .queries import query

S, E = iv.S, iv.E

# --- track families

HOST = f"(flag & 2) = 2 AND (flag & 2828) = 0 AND (flag & 66) = 66 AND {q.CANON} AND NOT is_spike"
SPIKE_LIST = "prolif_bioR1", "prolif_bioR2", "Day4_bioR1"
SETS_SQL = (
    f"SELECT 'permissive' AS unit_set, sample_key, chrom, start_pos, end_pos FROM dup WHERE {HOST}"
    f" UNION ALL SELECT 'intermediate', sample_key, chrom, start_pos, end_pos FROM dup WHERE {HOST} AND NOT is_dup"
    f" UNION ALL SELECT 'stringent', sample_key, chrom, start_pos, end_pos FROM dup WHERE {HOST} AND NOT is_dup AND mapq >= 30"
    f" UNION ALL SELECT 'merged', regexp_extract(sample_key, '^(.*)_bioR', 1), chrom, start_pos, end_pos FROM dup WHERE {HOST} AND NOT is_dup AND mapq >= 30"
    " UNION ALL SELECT 'spike', sample_key, 'dm6__chr2L', start_pos, end_pos FROM dup WHERE (flag & 66) = 66 AND (flag & 4) = 0 AND is_spike AND NOT is_dup AND mapq >= 30"
)
SNAPPED = (
    "(SELECT unit_set, sample_key, chrom, CAST(floor(start_pos / 10) AS BIGINT) * 10 AS start_pos,"
    " (CAST(floor((end_pos - 1) / 10) AS BIGINT) + 1) * 10 AS end_pos FROM sets)"
)
RUNS = "PARTITION BY unit_set, sample_key, chrom ORDER BY start_pos"
FAMILY_COVER = (
    f"sgm AS {q.segments_sql(SNAPPED, 'unit_set, sample_key, chrom')}, rl AS (SELECT *, sum(fresh) OVER ({RUNS}) AS run FROM (SELECT *,"
    f" CASE WHEN lag(end_pos) OVER w = start_pos AND lag(depth) OVER w = depth THEN 0 ELSE 1 END AS fresh FROM sgm WINDOW w AS ({RUNS}))),"
    " cov AS (SELECT unit_set, sample_key, chrom, min(start_pos) AS start_pos, max(end_pos) AS end_pos, any_value(depth) AS depth"
    " FROM rl GROUP BY unit_set, sample_key, chrom, run)"
)
POLICY_SCALES = (
    "cnt AS (SELECT unit_set, region_id, sample_key, count(*) AS n FROM regions r JOIN sets u ON u.chrom = r.chrom AND u.start_pos < r.end_pos"
    " AND r.start_pos < u.end_pos WHERE unit_set IN ('permissive', 'intermediate', 'stringent') GROUP BY 1, 2, 3),"
    " lg AS (SELECT unit_set, region_id, sum(ln(n)) / 7 AS lg FROM cnt GROUP BY 1, 2),"
    " raw AS (SELECT unit_set, sample_key, exp(quantile_cont(ln(n) - lg, 0.5)) AS f FROM cnt JOIN lg USING (unit_set, region_id) GROUP BY 1, 2),"
    " sf AS (SELECT unit_set, sample_key, f / exp(avg(ln(f)) OVER (PARTITION BY unit_set)) AS size_factor FROM raw),"
    " cs AS (SELECT unit_set, sample_key, sum(n) AS s FROM cnt GROUP BY 1, 2),"
    " sz AS (SELECT unit_set, sample_key, size_factor, exp(avg(ln(s)) OVER (PARTITION BY unit_set)) AS g FROM sf JOIN cs USING (unit_set, sample_key)),"
    " tot AS (SELECT unit_set, sample_key, count(*) AS u FROM sets GROUP BY 1, 2)"
)
FAMILY_SCALES = (
    "sc AS (SELECT unit_set, 'CPM' AS family, sample_key, 1e6 / u AS scale FROM tot WHERE unit_set = 'stringent'"
    " UNION ALL SELECT unit_set, 'dm6_StringentCPM', sample_key, 1e6 / u FROM tot WHERE unit_set = 'spike'"
    " UNION ALL SELECT unit_set, 'Merged_CPM', sample_key, 1e6 / u FROM tot WHERE unit_set = 'merged'"
    " UNION ALL SELECT unit_set, 'dm6_StringentRaw', sample_key, 1.0 FROM tot WHERE unit_set = 'spike'"
    f" UNION ALL SELECT 'stringent', 'SpikeInDM6_Stringent', sample_key, 1e6 * 0.5 / u FROM tot WHERE unit_set = 'spike' AND sample_key IN {SPIKE_LIST}"
    " UNION ALL SELECT unit_set, 'DESeq2RobustCPM_' || upper(unit_set[1]) || unit_set[2:], sample_key, 1e6 / (size_factor * g) FROM sz"
    " UNION ALL SELECT unit_set, 'DESeq2Consensus', sample_key, 1 / size_factor FROM sz WHERE unit_set = 'stringent')"
)


def unit_sets(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """Units of the three policies, of the spike-in and of the merged replicates of a condition."""
    f = q.marked(spark, d)
    host = f.filter(reads.policy("sensitivity", "PE", 0) & reads.is_canonical() & ~F.col("is_spike"))
    kept = {"permissive": host, "intermediate": host.filter(~F.col("is_dup")), "stringent": host.filter(~F.col("is_dup") & (F.col("mapq") >= 30))}
    kept["merged"] = kept["stringent"].withColumn("sample_key", F.regexp_extract("sample_key", "^(.*)_bioR", 1))
    kept["spike"] = f.filter(F.col("is_spike") & ~F.col("is_dup") & (F.col("mapq") >= 30)).withColumn("chrom", F.lit("dm6__chr2L"))
    return {name: reads.signal_units(u, "PE") for name, u in kept.items()}


@query(
    "n10_all_families",
    f"{fx.cte('frag', 'peaks')}, {q.CONSENSUS}, {q.DUP}, sets AS ({SETS_SQL}), {FAMILY_COVER}, {POLICY_SCALES}, {FAMILY_SCALES}"
    " SELECT family, sample_key, count(*) AS segments, round(sum((end_pos - start_pos) * depth * scale), 3) AS area"
    " FROM cov JOIN sc USING (unit_set, sample_key) GROUP BY 1, 2",
)
def all_families(spark, d):
    t = family_tracks(spark, d)
    return t.groupBy("family", "sample_key").agg(F.count("*").alias("segments"), F.round(F.sum((F.col(E) - F.col(S)) * F.col("score")), 3).alias("area"))


def family_tracks(spark, d) -> DataFrame:
    sets, r = unit_sets(spark, d), q.regions(spark, d)
    tables, policies = {}, {"permissive": (0, False), "intermediate": (0, True), "stringent": (30, True)}
    joined = fx.kept(counting.policy_counts(sets["permissive"], r, policies), "counts")
    for name in policies:
        counts = fx.kept(counting.complete(counting.of_policy(joined, name), r, fx.samples(spark)), "counts")
        tables[name] = counting.scales(counts)
    ratios = fx.samples(spark).filter(F.col("sample_key").isin(*SPIKE_LIST)).select("sample_key", F.lit(0.5).alias("ratio"))
    return counting.track_families(sets, counting.family_scales(sets, tables, ratios=ratios))


CPM_FIELDS = (
    "'hg38' AS genome, 'PE' AS layout, 'fragments' AS signal_unit, 'CPM' AS normalization, count(*) AS normalization_count, 10::BIGINT AS bin_size,"
    " array_to_string(list_sort(list(DISTINCT chrom)), ',') AS canonical_contigs, sample_key || '_CPM.bw' AS bigwig_file, sample_key || '_CPM.bedGraph' AS bedgraph_file"
)
query("n2b_cpm_record", f"{fx.cte('frag')}, {q.UNITS} SELECT sample_key AS sample, {CPM_FIELDS} FROM units GROUP BY sample_key")(
    lambda spark, d: counting.cpm_record(q.units(spark, d))
)

# --- correlations without empty rows

BIN_PAIRS = q.PAIRS.format(v="n", t="grid").replace("region_id", "bin_id")
BINNED = (
    "b AS (SELECT sample_key, chrom || ':' || bin AS bin_id, count(*) AS n FROM (SELECT sample_key, chrom, unnest(range(CAST(floor(start_pos / 10000) AS BIGINT),"
    " CAST(floor((end_pos - 1) / 10000) AS BIGINT) + 1)) AS bin FROM units) GROUP BY 1, 2), grid AS (SELECT i.bin_id, s.sample_key, coalesce(b.n, 0) AS n"
    " FROM (SELECT DISTINCT bin_id FROM b) i CROSS JOIN samples s LEFT JOIN b ON b.bin_id = i.bin_id AND b.sample_key = s.sample_key)"
)


@query("x7_pearson_of_bins", f"{fx.cte('frag', 'samples')}, {q.UNITS}, {BINNED}, {BIN_PAIRS} SELECT a, b, round(r, 6) AS r FROM pr")
def pearson_of_bins(spark, d):
    """All bins of the genome are the grid; those without reads in any sample are skipped."""
    u = q.units(spark, d)
    counts = counting.bin_counts(u, 10_000).withColumn("region_id", F.concat_ws(":", "chrom", "bin")).select("region_id", "sample_key", "n")
    sizes = u.groupBy("chrom").agg(F.max(E).alias("size"))
    grid = sizes.select(
        "chrom", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("size") / 10_000))).alias("bin")
    ).select(F.concat_ws(":", "chrom", "bin").alias("region_id"))
    return stats.pearson(counting.complete(counts, grid, fx.samples(spark)), skip_zeros=True).withColumn("r", F.round("r", 6))


query(
    "x7_pearson_skip_zeros",
    f"{q.BASE}, seen AS (SELECT * FROM counts WHERE region_id IN (SELECT region_id FROM counts GROUP BY 1 HAVING sum(n) > 0)), {q.PAIRS.format(v='n', t='seen')}"
    " SELECT a, b, round(r, 6) AS r FROM pr",
)(lambda spark, d: stats.pearson(q.matrix(spark, d), skip_zeros=True).withColumn("r", F.round("r", 6)))

# --- samples


@query(
    "a8_eligible_libraries",
    f"{q.BASE}, {q.FACTORS}, u AS (SELECT sample_key, count(*) AS canonical_signal FROM units GROUP BY 1), a AS (SELECT sample_key, sum(n)::BIGINT AS assigned FROM counts GROUP BY 1),"
    " e AS (SELECT condition FROM samples GROUP BY 1 HAVING count(*) >= 2) SELECT sample_key, canonical_signal, assigned, round(size_factor, 6) AS size_factor,"
    " round(assigned / canonical_signal, 6) AS assigned_fraction, condition IN (SELECT condition FROM e) AS differential_model_eligible"
    " FROM u JOIN a USING (sample_key) JOIN sf USING (sample_key) JOIN samples USING (sample_key)",
)
def eligible_libraries(spark, d):
    c, sheet = q.matrix(spark, d), q.sheet(spark, d)
    eligible = sheet.join(design.eligibility(sheet).filter("eligible").select("condition"), "condition")
    out = qc.library_summary(q.units(spark, d), c, counting.poscounts_factors(c), eligible)
    return out.withColumns({x: F.round(x, 6) for x in ("size_factor", "assigned_fraction")})


METRICS = [
    "proper_pair_fragments", "fragments_above_plot_max", *[f"{c}_{kind}" for c in qc.CLASSES for kind in ("count", "fraction")], "nfr_to_mononucleosome_ratio",
    "periodic_fragment_fraction", "mononucleosome_local_peak_bp", "dinucleosome_local_peak_bp", "mono_to_di_peak_spacing_bp", "mono_to_di_spacing_deviation_from_200_bp",
]
WIDE = ", ".join(f"max(value) FILTER (metric = '{m}') AS {m}" for m in METRICS)
DASHBOARD = (
    f"SELECT * FROM (SELECT sample_key, {WIDE} FROM ({q.SQL['q4_periodicity']}) GROUP BY 1) JOIN ({q.SQL['q1_qc_summary']}) USING (sample_key)"
    f" JOIN ({q.SQL['q5_tss_enrichment']}) USING (sample_key) JOIN ({q.SQL['q6_short_mono_ratio']}) USING (sample_key)"
)


@query("q15_whole_dashboard", DASHBOARD)
def whole_dashboard(spark, d):
    """Every metric of a sample: periodicity, reads, duplicates, contigs, peaks, shares in peaks, TSS enrichment, short to mono."""
    periodicity = qc.wide(qc.periodicity(qc.length_histogram(q.units(spark, d))).withColumn("value", F.round("value", 6)), METRICS)
    return qc.dashboard([periodicity, q.QUERIES["q1_qc_summary"](spark, d), qc.tss_enrichment(q.tss_profile(spark, d)), q.QUERIES["q6_short_mono_ratio"](spark, d)])


@query("f15_transliterated_words",
    r"SELECT DISTINCT w AS word, CASE WHEN t = '' THEN 'condition' ELSE substr(t, 1, 60) END AS token FROM (SELECT w, "
    r"regexp_replace(regexp_replace(strip_accents(replace(replace(replace(w, 'ß', 'ss'), 'œ', 'oe'), 'æ', 'ae')), '[^A-Za-z0-9._-]+', '_', 'g'), "
    r"'^_+|_+$', '', 'g') AS t FROM (SELECT unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS w FROM documents))"
)
def transliterated_words(spark, d):
    words = spark.read.parquet(f"{d}/documents.parquet").select(
        F.explode(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))).alias("word")
    ).distinct()
    return words.withColumn("token", reads.safe_token(F.col("word")))


# --- sinks that are read back


@query("k4_sorted_tracks", q.SQL["n2_cpm_track"])
def sorted_tracks(spark, d):
    path = fx.folder(spark, "bedgraph")
    writers.bedgraph(q.QUERIES["n2_cpm_track"](spark, d), path, 12)
    return readers.bedgraph(spark, path)


@query("k4_track_manifest",
    "SELECT family, sample_key, count(*) AS rows, min(chrom) AS first_chrom, max(chrom) AS last_chrom, true AS in_order FROM "
    f"({q.SQL['n2_cpm_track']}) GROUP BY 1, 2"
)
def track_manifest(spark, d):
    """The manifest by track: files in the order of their parts hold consecutive places."""
    m = writers.bedgraph(q.QUERIES["n2_cpm_track"](spark, d), fx.folder(spark, "bedgraph"), 12)
    parts = F.array_sort(
        F.collect_list(F.struct("part", F.struct("first_chrom", "first_start").alias("f"), F.struct("last_chrom", "last_end").alias("l")))
    )  # a row a file
    x = m.groupBy("family", "sample_key").agg(
        F.sum("rows").alias("rows"), F.min("first_chrom").alias("first_chrom"), F.max("last_chrom").alias("last_chrom"), parts.alias("p")
    )
    follows = F.forall(F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p")), lambda a, b: a["l"] <= b["f"]), lambda ok: ok)
    return x.withColumn("in_order", F.when(F.size("p") < 2, True).otherwise(follows)).drop("p")


@query("k2_csv_round_trip", "SELECT p_partkey::VARCHAR AS p_partkey, p_name, CASE WHEN p_size % 5 = 0 THEN 'NA' ELSE p_size::VARCHAR END AS p_size FROM part")
def csv_round_trip(spark, d):
    part = spark.read.parquet(f"{d}/part.parquet").select("p_partkey", "p_name", F.when(F.col("p_size") % 5 != 0, F.col("p_size")).alias("p_size"))
    path = fx.folder(spark, "csv")
    writers.csv(part, path)
    return spark.read.option("header", True).csv(path)


@query("k5_bed_round_trip", f"{fx.cte('peaks')}, {q.CONSENSUS} SELECT chrom, start_pos, end_pos, region_id AS name FROM regions")
def bed_round_trip(spark, d):
    path = fx.folder(spark, "bed")
    writers.bed(q.regions(spark, d), path, "region_id")
    return readers.bed(spark, path)


@query("k7_differential_totals",
    f"WITH {sq.RESULTS}, s AS (SELECT {sq.SUMS} FROM res GROUP BY 1) SELECT count(*) AS analysis_rows, count(*) FILTER (comparison_id <> "
    f"'{sq.RESULT_IDS[2]}') AS completed, sum(significant_sites) FILTER (comparison_id <> '{sq.RESULT_IDS[2]}')::BIGINT AS significant_calls FROM s"
)
def differential_totals(spark, d):
    """Totals of the summary of all comparisons, of which the unplanned one counts as failed."""
    s = q.QUERIES["a11_comparison_summary"](spark, d)
    status = F.when(F.col("comparison_id") == sq.RESULT_IDS[2], "FAILED").otherwise("SUCCESS")
    return writers.differential_totals(s.withColumns({"status": status, "significant_sites": F.col("significant_sites").cast("string")}))


@query("k10_provenance",
    f"{fx.cte('peaks')}, x AS (SELECT concat_ws('|', sample_key, chrom, start_pos::VARCHAR, end_pos::VARCHAR) AS t FROM peaks) SELECT 'formula' AS "
    "field, 'count' AS value UNION ALL SELECT 'version', '1' UNION ALL SELECT 'input_checksum', sha256(concat_ws(':', count(*)::VARCHAR, "
    "coalesce(sum(('0x' || substr(md5(t), 1, 15))::BIGINT::HUGEINT), 0)::VARCHAR)) FROM x"
)
def provenance(spark, d):
    return writers.provenance(fx.table(spark, d, "peaks").select("sample_key", "chrom", S, E), {"version": "1", "formula": "count"})


# --- metric files


@query("s11_duplication_files", f"SELECT sample_key, percent_duplication FROM ({q.SQL['d2_duplicate_removal']})")
def duplication_files(spark, d):
    """A metrics file a sample, with its share of duplicates to six digits, read back in percent."""
    m = qc.duplication(reads.mark_duplicates(q.frag(spark, d)))
    share = F.format_string("%.6f", F.col("duplicates") / F.col("examined"))
    lines = F.concat(
        F.lit("## METRICS\nLIBRARY\tREADS\tPERCENT_DUPLICATION\n"), F.concat_ws("\t", "sample_key", F.col("examined").cast("string"), share),
        F.lit("\n\n## HISTOGRAM\n")
    )
    path = fx.folder(spark, "duplication")
    m.select("sample_key", lines.alias("value")).repartition("sample_key").write.partitionBy("sample_key").text(path)
    out = readers.duplication_metrics(spark, path)
    return out.select(F.regexp_extract("path", "sample_key=([^/]*)/", 1).alias("sample_key"), "percent_duplication")


JSON_SQL = (
    f"{fx.cte('frag')}, x AS (SELECT sample_key, count(*) AS n, count(*) FILTER (chrom = 'chrM') AS m, max(tlen) AS t FROM frag GROUP BY 1)"
    " SELECT sample_key, unnest(['metrics.tss_coverage', 'metrics.libraries[0].fragment_length.longest', 'metrics.libraries[1].duplicates']) AS path, unnest([n, t, m])::VARCHAR AS value FROM x"
    " UNION ALL SELECT sample_key, 'mitochondrial.reads', m::VARCHAR FROM x"
)


@query("s12_metrics_json", JSON_SQL)
def metrics_files(spark, d):
    """A JSON file a sample, with objects in lists, lists of numbers and names that aren't kept."""
    x = q.frag(spark, d).groupBy("sample_key").agg(F.count("*").alias("n"), F.count_if(F.col("chrom") == "chrM").alias("m"), F.max("tlen").alias("t"))
    text = F.format_string(
        '{"mitochondrial": {"reads": %d, "none": null}, "other": 5,\n "metrics": {"tss_coverage": %d, "tss_list": [1, 2], "libraries": [{"fragment_length": {"longest": %d}}, {"duplicates": %d}, 7]}}',
        "m", "n", "t", "m"
    )
    path = fx.folder(spark, "json")
    x.select("sample_key", text.alias("value")).repartition("sample_key").write.partitionBy("sample_key").text(path)
    return readers.metrics_json(spark, path).select(F.regexp_extract("file", "sample_key=([^/]*)/", 1).alias("sample_key"), "path", "value")


@query("u4_discovered_summaries",
    f"WITH {sq.RESULTS}, s AS (SELECT {sq.SUMS} FROM res GROUP BY 1) SELECT comparison_id, tested_sites::VARCHAR AS tested_sites, 'NA' AS note, "
    "'a' AS source FROM s UNION ALL SELECT comparison_id, significant_sites::VARCHAR, 'x', 'b' FROM s"
)
def discovered_summaries(spark, d):
    """Summaries of two modules with their columns in another order, and one that only the second has."""
    s, root = q.QUERIES["a11_comparison_summary"](spark, d), fx.folder(spark, "summaries")
    name = "differential_accessibility_comparisons.tsv"
    a = s.select("comparison_id", "tested_sites")
    b = s.select(F.lit("x").alias("note"), F.col("significant_sites").alias("tested_sites"), "comparison_id")
    for folder, table in (("a", a), ("b", b)):
        writers.tsv(table.coalesce(1), f"{root}/{folder}/{name}")  # a row a comparison
    out = readers.discover(spark, [root], "*.csv", ("comparison_id", "tested_sites"))
    return out.select("comparison_id", "tested_sites", "note", F.regexp_extract("source_table", f"/([ab])/{name}/", 1).alias("source"))


# --- rules that find something in these tables

query(
    "v5_sample_metadata",
    f"{sq.SHEET} " + " UNION ALL ".join(f"SELECT sample_id, '{c}' AS \"column\" FROM sheet GROUP BY 1 HAVING count(DISTINCT {c}) > 1" for c in design.GROUP)
)(
    lambda spark, d: design.inconsistent_groups(sq.sheet(spark, d), ["sample_id"], design.GROUP)
)
query(
    "v6_controls_that_are_none",
    f"{sq.SHEET}, {sq.CLEAN} SELECT row, control_id FROM c WHERE control_id <> '' AND control_id NOT IN (SELECT sid FROM c WHERE control)"
)(
    lambda spark, d: design.orphans(
        sq.sheet(spark, d), "control_id", sq.sheet(spark, d).filter(design.is_control()).select(F.trim("sample_id").alias("known")), "known"
    ).select("row", "control_id")
)
query(
    "f5_single_end_units",
    f"{fx.cte('frag')} SELECT sample_key, count(*) AS units, sum(end_pos - start_pos)::BIGINT AS bases FROM frag WHERE (flag & 3844) = 0 GROUP BY 1"
)(
    lambda spark, d: reads.signal_units(
        q.frag(spark, d).filter(reads.flags_pass(*reads.POLICIES["stringent", "SE"])), "SE"
    ).groupBy("sample_key").agg(F.count("*").alias("units"), F.sum(F.col(E) - F.col(S)).alias("bases"))
)


@query("s10_required_keys",
    f"{q.BASE}, {q.FACTORS} SELECT sample_key AS key, round(size_factor, 6) AS value FROM sf WHERE sample_key IN (SELECT sample_key FROM peaks "
    "WHERE peak_type = 'broad')"
)
def required_keys(spark, d):
    path = fx.folder(spark, "factors")
    writers.tsv(counting.poscounts_factors(q.matrix(spark, d)).select(F.col("sample_key").alias("key"), F.round("size_factor", 6).alias("size_factor")), path)
    wanted = fx.table(spark, d, "peaks").filter("peak_type = 'broad'").select(F.col("sample_key").alias("key"))
    return readers.keyed_value(spark, path, "size_factor", wanted)
