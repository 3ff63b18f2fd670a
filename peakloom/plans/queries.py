"""One query for each operator or close group of operators, over the given tables read as sequencing tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import annotate, counting, design, peaks, qc, reads, stats
from ..operators import intervals as iv
from ..sources import readers, writers
from . import fixture as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
S, E = iv.S, iv.E
CANON = fx.canonical_sql()
CLASS_NAMES = "|".join(readers.CLASSES)
KEEP = f"(flag & 2) = 2 AND (flag & 3852) = 0 AND {CANON}"
STRINGENT = f"{KEEP} AND mapq >= 30"


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def put(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql
        return f

    return put


def frag(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "frag")


def units(spark: SparkSession, d: str, min_mapq: int = 30) -> DataFrame:
    return reads.signal_units(frag(spark, d).filter(reads.policy("stringent", "PE", min_mapq) & reads.is_canonical()), "PE")


def marked(spark: SparkSession, d: str) -> DataFrame:
    """Fragments with is_dup, which several unit sets and policies are taken from."""
    columns = ["sample_key", "qname", "chrom", S, E, "tlen", "flag", "mapq", "is_spike", "is_dup"]
    return fx.shared(spark, d, "marked", ("lineitem",), lambda: reads.mark_duplicates(frag(spark, d)).select(*columns))


def called(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "peaks").filter(reads.is_canonical())


def sheet(spark: SparkSession, d: str) -> DataFrame:
    """The sample sheet of the samples that peaks name, in the order of their numbers."""
    p = fx.table(spark, d, "peaks").groupBy("sample_key").agg(F.min(F.col("peak_no") % 7).cast("int").alias("sheet_order"))
    return p.select(
        "sheet_order", "sample_key", F.regexp_extract("sample_key", "^(.*)_bioR[0-9]+$", 1).alias("condition"),
        F.regexp_extract("sample_key", "([0-9]+)$", 1).cast("int").alias("replicate")
    )


def made_regions(spark: SparkSession, d: str) -> DataFrame:
    """Consensus regions with ids; numbering reads its rows twice, so they are written first."""
    return iv.region_ids(fx.kept(iv.consensus(called(spark, d), ["chrom"], "sample_key"), "consensus"))


def regions(spark: SparkSession, d: str) -> DataFrame:
    return fx.shared(spark, d, "regions", ("orders",), lambda: made_regions(spark, d))


def matrix(spark: SparkSession, d: str) -> DataFrame:
    r = regions(spark, d)
    return fx.shared(spark, d, "counts", ("orders", "lineitem"), lambda: counting.complete(counting.overlap_counts(units(spark, d), r), r, fx.samples(spark)))


def flagship(spark: SparkSession, d: str) -> DataFrame:
    counts = matrix(spark, d)
    return counts.join(F.broadcast(counting.scales(counts).select("sample_key", "size_factor", "robust_cpm_scale")), "sample_key")  # a row a sample


def merged_sql(source: str, keys: str) -> str:
    """Overlapping and book-ended intervals of a key as one.  Starts are unique before the windows: two windows may order ties unlike."""
    w = f"PARTITION BY {keys} ORDER BY start_pos"
    return (
        f"(SELECT {keys}, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM (SELECT *, sum(fresh) OVER ({w} ROWS UNBOUNDED PRECEDING) AS "
        f"island FROM (SELECT {keys}, start_pos, end_pos, CASE WHEN start_pos <= max(end_pos) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 "
        f"PRECEDING) THEN 0 ELSE 1 END AS fresh FROM (SELECT {keys}, start_pos, max(end_pos) AS end_pos FROM {source} GROUP BY {keys}, start_pos))) "
        f"GROUP BY {keys}, island)"
    )


def segments_sql(source: str, keys: str) -> str:
    w = f"PARTITION BY {keys} ORDER BY pos"
    return (
        f"(SELECT {keys}, pos AS start_pos, nxt AS end_pos, depth FROM (SELECT {keys}, pos, sum(d) OVER ({w})::BIGINT AS depth, lead(pos) OVER "
        f"({w}) AS nxt FROM (SELECT {keys}, pos, sum(d) AS d FROM (SELECT {keys}, start_pos AS pos, 1 AS d FROM {source} UNION ALL SELECT {keys}, "
        f"end_pos, -1 FROM {source}) GROUP BY {keys}, pos)) WHERE depth > 0)"
    )


RANK = "CASE WHEN chrom = 'chrX' THEN 1001 WHEN chrom = 'chrY' THEN 1002 ELSE CAST(replace(chrom, 'chr', '') AS INT) END"
CONSENSUS = (
    f"cp AS (SELECT * FROM peaks WHERE {CANON}), mp AS {merged_sql('cp', 'sample_key, chrom')}, sg AS {segments_sql('mp', 'chrom')}, hi AS (SELECT "
    f"* FROM sg WHERE depth >= 2), cons AS {merged_sql('hi', 'chrom')}, regions AS (SELECT *, printf('peak_%06d', row_number() OVER (ORDER BY "
    f"{RANK}, start_pos)) AS region_id FROM cons)"
)
UNITS = f"units AS (SELECT * FROM frag WHERE {STRINGENT})"
COUNTS = (
    "cnt AS (SELECT region_id, sample_key, count(*) AS n FROM regions r JOIN units u ON u.chrom = r.chrom AND u.start_pos < r.end_pos AND "
    "r.start_pos < u.end_pos GROUP BY 1, 2), counts AS (SELECT r.region_id, s.sample_key, coalesce(n, 0)::BIGINT AS n FROM regions r CROSS JOIN "
    "samples s LEFT JOIN cnt c ON c.region_id = r.region_id AND c.sample_key = s.sample_key)"
)
BASE = f"{fx.cte('frag', 'peaks', 'samples')}, {CONSENSUS}, {UNITS}, {COUNTS}"
FACTORS = (
    "pos AS (SELECT *, ln(n) AS l FROM counts WHERE n > 0), lg AS (SELECT region_id, sum(l) / 7 AS lg FROM pos GROUP BY 1), raw AS (SELECT "
    "sample_key, exp(quantile_cont(l - lg, 0.5)) AS f FROM pos JOIN lg USING (region_id) GROUP BY 1), sf AS (SELECT sample_key, f / exp(avg(ln(f)) "
    "OVER ()) AS size_factor FROM raw)"
)

# --- filters, flags and species

query("f1_flag_policies",
    f"{fx.cte('frag')} SELECT sample_key, count(*) FILTER ((flag & 2) = 2 AND (flag & 3852) = 0) AS stringent, count(*) FILTER ((flag & 2) = 2 AND "
    "(flag & 2828) = 0) AS sensitivity, count(*) FILTER ((flag & 3844) = 0) AS stringent_se, count(*) FILTER (mapq >= 30) AS mapq30 FROM frag "
    "GROUP BY 1"
)(
    lambda spark, d: frag(spark, d).groupBy("sample_key").agg(*[F.count_if(reads.flags_pass(*reads.POLICIES[k])).alias(n) for n, k in (("stringent", ("stringent", "PE")), ("sensitivity", ("sensitivity", "PE")), ("stringent_se", ("stringent", "SE")))], F.count_if(F.col("mapq") >= 30).alias("mapq30")))
query(
    "f3_canonical_contigs", f"{fx.cte('frag')} SELECT sample_key, chrom, count(*) AS n, {CANON} AS kept FROM frag GROUP BY 1, 2"
)(lambda spark, d: qc.contig_report(frag(spark, d)))
query("f5_signal_units",
    f"{fx.cte('frag')} SELECT sample_key, count(*) AS units, sum(tlen)::BIGINT AS bases FROM frag WHERE (flag & 66) = 66 AND (flag & 4) = 0 GROUP "
    "BY 1"
)(
    lambda spark, d: reads.signal_units(frag(spark, d), "PE").groupBy("sample_key").agg(F.count("*").alias("units"), F.sum(F.col(E) - F.col(S)).alias("bases")))
query(
    "f6_inferred_layout", f"{fx.cte('frag')} SELECT sample_key, CASE WHEN max(flag & 1) = 1 THEN 'PE' ELSE 'SE' END AS layout FROM frag GROUP BY 1"
)(lambda spark, d: reads.inferred_layout(frag(spark, d)))


@query("f8_species_split",
    f"{fx.cte('frag')} SELECT sample_key, CASE WHEN is_spike THEN 'spike' ELSE 'host' END AS species, count(*) AS n, count(*) FILTER (mapq >= 30) "
    f"AS n_q30 FROM frag WHERE is_spike OR {CANON} GROUP BY 1, 2"
)
def species(spark, d):
    mixed = frag(spark, d).withColumn("chrom", F.when(F.col("is_spike"), "dm6__chr2L").otherwise(F.col("chrom")))
    return reads.split_species(mixed).groupBy("sample_key", "species").agg(F.count("*").alias("n"), F.count_if(F.col("mapq") >= 30).alias("n_q30"))


query("f9_harmonised_names", f"{fx.cte('frag', 'blacklist')} SELECT chrom, count(*) AS n FROM frag GROUP BY 1")(
    lambda spark, d: reads.harmonise(frag(spark, d).withColumn("chrom", F.regexp_replace("chrom", "^chr", "")), fx.table(spark, d, "blacklist")).groupBy("chrom").agg(F.count("*").alias("n")))
query("f15_safe_tokens",
    "SELECT DISTINCT p_name, CASE WHEN t = '' THEN 'condition' ELSE substr(t, 1, 60) END AS token FROM (SELECT p_name, "
    "regexp_replace(regexp_replace(p_name, '[^A-Za-z0-9._-]+', '_', 'g'), '^_+|_+$', '', 'g') AS t FROM part)"
)(
    lambda spark, d: spark.read.parquet(f"{d}/part.parquet").select("p_name", reads.safe_token(F.col("p_name")).alias("token")).distinct())

# --- duplicates, pairs, funnel, policies

DUP = (
    "dup AS (SELECT *, row_number() OVER (PARTITION BY sample_key, chrom, start_pos, end_pos, strand ORDER BY quality DESC, qname) > 1 AS is_dup "
    "FROM frag)"
)
query("d2_duplicate_removal",
    f"{fx.cte('frag')}, {DUP} SELECT sample_key, count(*) AS examined, count(*) FILTER (is_dup) AS duplicates, round(100.0 * count(*) FILTER "
    "(is_dup) / count(*), 2)::DOUBLE AS percent_duplication FROM dup GROUP BY 1"
)(lambda spark, d: qc.duplication(reads.mark_duplicates(frag(spark, d))))
query("d2_retained_records", f"{fx.cte('frag')}, {DUP} SELECT sample_key, qname FROM dup WHERE NOT is_dup")(
    lambda spark, d: reads.mark_duplicates(frag(spark, d)).filter("not is_dup").select("sample_key", "qname")
)


@query("d4_filter_funnel",
    f"{fx.cte('frag', 'blacklist')}, b AS (SELECT f.*, EXISTS (SELECT 1 FROM blacklist k WHERE k.chrom = f.chrom AND k.start_pos < f.end_pos AND "
    "f.start_pos < k.end_pos) AS hit FROM frag f) SELECT sample_key, count(*) AS total, count(*) FILTER ((flag & 2) = 2 AND (flag & 3852) = 0 AND "
    f"mapq >= 30) AS after_flags, count(*) FILTER ({STRINGENT}) AS after_contigs, count(*) FILTER ({STRINGENT} AND NOT hit) AS after_blacklist "
    "FROM b GROUP BY 1"
)
def funnel(spark, d):
    f = iv.with_flag(frag(spark, d), fx.table(spark, d, "blacklist"), ["qname"], "hit")
    return reads.funnel(f, [("after_flags", reads.policy("stringent", "PE")), ("after_contigs", reads.is_canonical()), ("after_blacklist", ~F.col("hit"))])


@query("d5_pair_repair",
    f"{fx.cte('frag', 'blacklist')}, m AS (SELECT sample_key, qname, chrom, start_pos, start_pos + least(50, tlen) AS end_pos FROM frag UNION ALL "
    "SELECT sample_key, qname, chrom, end_pos - least(50, tlen), end_pos FROM frag), k AS (SELECT * FROM m WHERE NOT EXISTS (SELECT 1 FROM "
    "blacklist b WHERE b.chrom = m.chrom AND b.start_pos < m.end_pos AND m.start_pos < b.end_pos)), p AS (SELECT sample_key, qname FROM k GROUP "
    "BY 1, 2 HAVING count(*) = 2) SELECT sample_key, count(*) AS pairs FROM p GROUP BY 1"
)
def pair_repair(spark, d):
    m = reads.mates(frag(spark, d))
    left = iv.with_any(m, fx.table(spark, d, "blacklist"), ["qname", "mate"], anti=True)
    return reads.complete_pairs(left).filter("mate = 1").groupBy("sample_key").agg(F.count("*").alias("pairs"))


query("d7_filtering_policies",
    f"{fx.cte('frag')}, {DUP}, p(policy, drops, q) AS (VALUES ('permissive', false, 0), ('intermediate', true, 0), ('stringent', true, 30)) SELECT "
    f"policy, sample_key, count(*) AS n FROM dup, p WHERE {CANON} AND (flag & 2) = 2 AND (flag & 2828) = 0 AND mapq >= q AND NOT (drops AND "
    "is_dup) GROUP BY 1, 2"
)(
    lambda spark, d: reads.filtering_policies(reads.mark_duplicates(frag(spark, d)), reads.is_canonical(), F.col("is_dup")).groupBy("policy", "sample_key").agg(F.count("*").alias("n")))

# --- intervals

query(
    "i1_merged_peaks", f"{fx.cte('peaks')} SELECT * FROM {merged_sql('peaks', 'sample_key, chrom')}"
)(lambda spark, d: iv.merge(fx.table(spark, d, "peaks"), ["sample_key", "chrom"]))
query("i2_disjoint_support",
    f"{fx.cte('peaks')}, mp AS {merged_sql('peaks', 'sample_key, chrom')} SELECT chrom, start_pos, end_pos, depth AS support FROM "
    f"{segments_sql('mp', 'chrom')}"
)(lambda spark, d: iv.disjoin(fx.table(spark, d, "peaks"), ["chrom"], "sample_key").select("chrom", S, E, "support"))
query(
    "i3_consensus", f"{fx.cte('peaks')}, {CONSENSUS} SELECT region_id, chrom, start_pos, end_pos FROM regions"
)(lambda spark, d: made_regions(spark, d).select("region_id", "chrom", S, E))


@query("i5_supporting_samples",
    f"{fx.cte('peaks', 'samples')}, {CONSENSUS} SELECT region_id, count(DISTINCT p.sample_key) AS n_samples, "
    "array_to_string(list_sort(list(DISTINCT p.sample_key)), ',') AS supporting FROM regions r JOIN cp p ON p.chrom = r.chrom AND p.start_pos < "
    "r.end_pos AND r.start_pos < p.end_pos GROUP BY 1"
)
def supporting(spark, d):
    pairs = iv.overlap_join(called(spark, d).select("sample_key", "chrom", S, E), regions(spark, d).select("region_id", "chrom", S, E))
    return pairs.groupBy("region_id").agg(
        F.count_distinct("sample_key").alias("n_samples"), F.array_join(F.array_sort(F.collect_set("sample_key")), ",").alias("supporting")
    )


query("i8_promoters",
    f"{fx.cte('genes')} SELECT gene_id, chrom, greatest(0, CASE WHEN strand = '-' THEN end_pos - 1 - 500 ELSE start_pos - 2000 END) AS start_pos, "
    "CASE WHEN strand = '-' THEN end_pos - 1 + 2001 ELSE start_pos + 501 END AS end_pos FROM genes"
)(lambda spark, d: iv.promoters(fx.table(spark, d, "genes")).select("gene_id", "chrom", S, E))
query("i9_unique_tss",
    f"{fx.cte('genes')} SELECT chrom, CASE WHEN strand = '-' THEN end_pos - 1 ELSE start_pos END AS tss, strand, min(gene_name) AS name FROM genes "
    "GROUP BY 1, 2, 3"
)(lambda spark, d: iv.tss(fx.table(spark, d, "genes")).groupBy("chrom", "tss", "strand").agg(F.min("gene_name").alias("name")))


@query("i10_summit_windows",
    f"{fx.cte('frag', 'peaks')}, {CONSENSUS}, {UNITS}, pile AS {segments_sql('units', 'chrom')}, x AS (SELECT r.chrom, r.start_pos, r.end_pos, "
    "depth, greatest(r.start_pos, p.start_pos) AS s, least(r.end_pos, p.end_pos) AS e FROM cons r JOIN pile p ON p.chrom = r.chrom AND "
    "p.start_pos < r.end_pos AND r.start_pos < p.end_pos), t AS (SELECT *, row_number() OVER (PARTITION BY chrom, start_pos, end_pos ORDER BY "
    "depth DESC, s) AS k FROM x) SELECT chrom, greatest(0, CAST(floor((s + e - 1) / 2) AS BIGINT) - 100) AS start_pos, CAST(floor((s + e - 1) / "
    "2) AS BIGINT) + 101 AS end_pos, CAST(floor((s + e - 1) / 2) AS BIGINT) AS summit FROM t WHERE k = 1"
)
def summits(spark, d):
    return iv.recentre(iv.consensus(called(spark, d), ["chrom"], "sample_key"), iv.whole_segments(units(spark, d), ["chrom"])).select("chrom", S, E, "summit")


query("i11_narrow_broad_union", f"{fx.cte('peaks')} SELECT * FROM {merged_sql('peaks', 'chrom')}")(
    lambda spark,
    d: iv.merge(fx.table(spark, d, "peaks").filter("peak_type = 'narrow'").unionByName(fx.table(spark, d, "peaks").filter("peak_type = 'broad'")), ["chrom"])
)


@query("i12_prefilter_manifest",
    f"{fx.cte('peaks', 'blacklist')}, x AS (SELECT *, {CANON} AS canon, EXISTS (SELECT 1 FROM blacklist b WHERE b.chrom = p.chrom AND b.start_pos "
    "< p.end_pos AND p.start_pos < b.end_pos) AS hit FROM peaks p) SELECT sample_key, peak_type, count(*) AS input, count(*) FILTER (canon AND "
    "NOT hit) AS retained, count(*) FILTER (NOT canon) AS noncanonical, count(*) FILTER (canon AND hit) AS blacklisted FROM x GROUP BY 1, 2"
)
def prefilter(spark, d):
    x = iv.with_flag(fx.table(spark, d, "peaks"), fx.table(spark, d, "blacklist"), ["peak_no"], "hit").withColumn("canon", reads.is_canonical())
    kept, lost = F.count_if(F.col("canon") & ~F.col("hit")), F.count_if(F.col("canon") & F.col("hit"))
    return x.groupBy("sample_key", "peak_type").agg(
        F.count("*").alias("input"), kept.alias("retained"), F.count_if(~F.col("canon")).alias("noncanonical"), lost.alias("blacklisted")
    )


# --- joins

query("j1_region_counts", f"{BASE} SELECT region_id, sample_key, n FROM cnt")(lambda spark, d: counting.overlap_counts(units(spark, d), regions(spark, d)))
query("j2_union_counts",
    f"{BASE}, m AS (SELECT sample_key, qname, chrom, start_pos, start_pos + least(50, tlen) AS end_pos FROM units UNION ALL SELECT sample_key, "
    "qname, chrom, end_pos - least(50, tlen), end_pos FROM units), h AS (SELECT DISTINCT sample_key, qname, region_id FROM m JOIN regions r ON "
    "m.chrom = r.chrom AND m.start_pos < r.end_pos AND r.start_pos < m.end_pos), o AS (SELECT sample_key, qname, min(region_id) AS region_id FROM "
    "h GROUP BY 1, 2 HAVING count(*) = 1) SELECT region_id, sample_key, count(*) AS n FROM o GROUP BY 1, 2"
)(lambda spark, d: counting.union_counts(reads.mates(units(spark, d)), regions(spark, d)))
# the same joins with hot bins cut, whatever the size
query("j1_salted_counts", SQL["j1_region_counts"])(lambda spark, d: counting.overlap_counts(units(spark, d), regions(spark, d), salt=True))
query("j2_salted_union_counts", SQL["j2_union_counts"])(
    lambda spark, d: counting.union_counts(reads.mates(units(spark, d)), regions(spark, d), salt=True))
query("j3_frip",
    f"{fx.cte('frag', 'peaks')}, f AS (SELECT * FROM frag WHERE (flag & 4) = 0) SELECT sample_key, count(*) AS mapped, count(*) FILTER (hit) AS "
    "in_peaks, round(count(*) FILTER (hit) / count(*), 4) AS frip FROM (SELECT f.*, EXISTS (SELECT 1 FROM peaks p WHERE p.sample_key = "
    "f.sample_key AND p.chrom = f.chrom AND p.start_pos < f.end_pos AND f.start_pos < p.end_pos) AS hit FROM f) GROUP BY 1"
)(lambda spark, d: qc.frip(frag(spark, d).filter(F.col("flag").bitwiseAND(F.lit(4)) == 0), fx.table(spark, d, "peaks"), ["qname"]))
query("j4_blacklist_removal",
    f"{fx.cte('peaks', 'blacklist')} SELECT peak_no, chrom, start_pos, end_pos FROM peaks p WHERE NOT EXISTS (SELECT 1 FROM blacklist b WHERE "
    "b.chrom = p.chrom AND b.start_pos < p.end_pos AND p.start_pos < b.end_pos)"
)(lambda spark, d: iv.with_any(fx.table(spark, d, "peaks"), fx.table(spark, d, "blacklist"), ["peak_no"], anti=True).select("peak_no", "chrom", S, E))
TSS = "t AS (SELECT gene_id, gene_name, chrom, strand, CASE WHEN strand = '-' THEN end_pos - 1 ELSE start_pos END AS tss FROM genes)"
NEAR = (
    "near AS (SELECT region_id, gene_id AS nearest_gene_id, gene_name AS nearest_gene_name, ((CAST(floor((start_pos + 1 + end_pos) / 2) AS BIGINT) "
    "- (tss + 1)) * CASE WHEN strand = '-' THEN -1 ELSE 1 END)::BIGINT AS nearest_tss_distance_bp, gap::BIGINT AS edge_distance FROM (SELECT "
    "r.region_id, r.start_pos, r.end_pos, t.*, CASE WHEN tss < r.start_pos THEN r.start_pos - tss WHEN tss >= r.end_pos THEN tss - r.end_pos + 1 "
    "ELSE 0 END AS gap, row_number() OVER (PARTITION BY region_id ORDER BY CASE WHEN tss < r.start_pos THEN r.start_pos - tss WHEN tss >= "
    "r.end_pos THEN tss - r.end_pos + 1 ELSE 0 END, tss, gene_id) AS k FROM regions r JOIN t ON t.chrom = r.chrom) WHERE k = 1)"
)
query(
    "j7_nearest_tss", f"{fx.cte('peaks', 'genes')}, {CONSENSUS}, {TSS}, {NEAR} SELECT * FROM near"
)(lambda spark, d: annotate.nearest_tss(regions(spark, d), fx.table(spark, d, "genes")))


@query("j8_scaled_counts", f"{BASE}, {FACTORS} SELECT region_id, sample_key, n, round(n / size_factor, 6) AS value FROM counts JOIN sf USING (sample_key)")
def scaled(spark, d):
    c = matrix(spark, d)
    return counting.normalised(c, counting.poscounts_factors(c)).select("region_id", "sample_key", "n", F.round("value", 6).alias("value"))


@query("j11_comparison_plan",
    f"{fx.cte('samples')}, e AS (SELECT condition, min(sheet_order) AS o FROM samples GROUP BY 1 HAVING count(DISTINCT sample_key) >= 2) SELECT "
    "printf('%03d', row_number() OVER (ORDER BY a.o, b.o)) || '_' || b.condition || '_vs_' || a.condition AS comparison_id, b.condition AS "
    "numerator, a.condition AS reference FROM e a JOIN e b ON a.o < b.o"
)
def plan(spark, d):
    return design.comparison_plan(design.condition_order(design.eligibility(sheet(spark, d))))


query("j12_complete_matrix", f"{BASE} SELECT * FROM counts")(matrix)


@query("j13_centre_profile",
    f"{BASE}, cov AS "
    f"{segments_sql('(SELECT sample_key, chrom, CAST(floor(start_pos / 10) AS BIGINT) * 10 AS start_pos, (CAST(floor((end_pos - 1) / 10) AS BIGINT) + 1) * 10 AS end_pos FROM units)', 'sample_key, chrom')}, "
    "w AS (SELECT region_id, chrom, CAST(floor((start_pos + end_pos) / 2) AS BIGINT) - 2000 AS ws FROM regions), p AS (SELECT region_id, "
    "sample_key, greatest(start_pos, ws) - ws AS s, least(end_pos, ws + 4000) - ws AS e, depth FROM cov JOIN w ON w.chrom = cov.chrom AND "
    "start_pos < ws + 4000 AND end_pos > ws), b AS (SELECT *, unnest(range(CAST(floor(s / 10) AS BIGINT), CAST(floor((e - 1) / 10) AS BIGINT) + "
    "1)) AS bin FROM p), m AS (SELECT region_id, sample_key, bin, sum((least(e, (bin + 1) * 10) - greatest(s, bin * 10)) * depth) / 10 AS v FROM "
    "b GROUP BY 1, 2, 3), k AS (SELECT sample_key, count(DISTINCT region_id) AS regions FROM m GROUP BY 1) SELECT m.sample_key, bin, round(sum(v) "
    "/ any_value(regions), 6) AS mean FROM m JOIN k ON k.sample_key = m.sample_key GROUP BY 1, 2"
)
def centre_profile(spark, d):
    m = qc.centre_matrix(counting.coverage(units(spark, d)), regions(spark, d))
    return qc.profile(m).select("sample_key", "bin", F.round("mean", 6).alias("mean"))


# --- aggregates and windows

query(
    "a1_signal_counts",
    f"{fx.cte('frag')} SELECT sample_key, count(*) AS signal_count, round(1e6 / count(*), 6) AS scale FROM frag WHERE {STRINGENT} GROUP BY 1"
)(lambda spark, d: counting.cpm_scales(units(spark, d)).withColumn("scale", F.round("scale", 6)))
query("a2_mapq_bins",
    f"{fx.cte('frag')} SELECT sample_key, count(*) FILTER (mapq = 0) AS mapq_0, count(*) FILTER (mapq BETWEEN 1 AND 9) AS mapq_1_9, count(*) "
    "FILTER (mapq BETWEEN 10 AND 29) AS mapq_10_29, count(*) FILTER (mapq >= 30) AS mapq_30, count(*) FILTER (has_xs) AS xs_tagged FROM frag "
    "GROUP BY 1"
)(lambda spark, d: qc.mapq_bins(frag(spark, d)))
query("a3_mito_percent",
    f"{fx.cte('frag')} SELECT sample_key, count(*) FILTER (chrom IN ('chrM', 'MT', 'M')) AS mito_reads, count(*) AS total_reads, round(100 * "
    "count(*) FILTER (chrom IN ('chrM', 'MT', 'M')) / count(*), 2) AS mito_percent FROM frag GROUP BY 1"
)(lambda spark, d: qc.mito_percent(frag(spark, d)))
query("a4_reads_per_mb",
    f"{fx.cte('frag')}, sz AS (SELECT chrom, max(end_pos) AS size FROM frag GROUP BY 1) SELECT sample_key, chrom, count(*) AS n, round(count(*) / "
    "any_value(size) * 1e6, 6) AS per_mb FROM frag JOIN sz USING (chrom) GROUP BY 1, 2"
)(lambda spark, d: qc.reads_per_mb(frag(spark, d), frag(spark, d).groupBy("chrom").agg(F.max(E).alias("size"))).withColumn("per_mb", F.round("per_mb", 6)))
query("a5_peak_stats",
    f"{fx.cte('peaks')} SELECT sample_key, peak_type, count(*) AS n_peaks, quantile_cont(end_pos - start_pos, 0.5) AS median_width, "
    "greatest(max(signal), 0.0) AS max_signal FROM peaks GROUP BY 1, 2"
)(lambda spark, d: qc.peak_stats(fx.table(spark, d, "peaks")))
query("a7_column_sums",
    f"{BASE}, {FACTORS}, cs AS (SELECT sample_key, sum(n)::BIGINT AS column_sum FROM counts GROUP BY 1) SELECT sample_key, column_sum, "
    "round(size_factor, 6) AS size_factor, round(exp(avg(ln(column_sum)) OVER ()), 6) AS geometric_mean_sum, round(1 / size_factor, 6) AS "
    "deseq2_consensus_scale, round(1e6 / (size_factor * exp(avg(ln(column_sum)) OVER ())), 6) AS robust_cpm_scale FROM cs JOIN sf USING "
    "(sample_key)"
)(
    lambda spark, d: counting.scales(matrix(spark, d)).select("sample_key", "column_sum", *[F.round(c, 6).alias(c) for c in ("size_factor", "geometric_mean_sum", "deseq2_consensus_scale", "robust_cpm_scale")]))


@query("a8_library_summary",
    f"{BASE}, {FACTORS}, u AS (SELECT sample_key, count(*) AS canonical_signal FROM units GROUP BY 1), a AS (SELECT sample_key, sum(n)::BIGINT AS "
    "assigned FROM counts GROUP BY 1) SELECT sample_key, canonical_signal, assigned, round(size_factor, 6) AS size_factor, round(assigned / "
    "canonical_signal, 6) AS assigned_fraction FROM u JOIN a USING (sample_key) JOIN sf USING (sample_key)"
)
def library(spark, d):
    c = matrix(spark, d)
    return qc.library_summary(units(spark, d), c, counting.poscounts_factors(c)).withColumns({k: F.round(k, 6) for k in ("size_factor", "assigned_fraction")})


query("a9_condition_eligibility",
    f"{fx.cte('samples')} SELECT condition, count(DISTINCT sample_key) AS replicates, min(sheet_order) AS first_seen, count(DISTINCT sample_key) "
    ">= 2 AS eligible, CASE WHEN count(DISTINCT sample_key) >= 2 THEN 'eligible' ELSE 'fewer than 2 replicates' END AS reason FROM samples JOIN "
    "(SELECT DISTINCT CAST(o_orderkey % 7 AS INT) AS sheet_order FROM orders) USING (sheet_order) GROUP BY 1"
)(
    lambda spark, d: design.eligibility(sheet(spark, d)))
query("a13_merge_groups",
    f"{fx.cte('frag', 'samples')} SELECT condition, count(*) AS n, count(DISTINCT sample_key) AS n_samples FROM frag JOIN samples USING "
    "(sample_key) GROUP BY 1 HAVING count(DISTINCT sample_key) >= 2"
)(
    lambda spark, d: frag(spark, d).join(F.broadcast(fx.samples(spark)), "sample_key").groupBy("condition").agg(F.count("*").alias("n"), F.count_distinct("sample_key").alias("n_samples")).filter("n_samples >= 2"))
query("a17_genome_bins",
    f"{fx.cte('frag')}, {UNITS} SELECT sample_key, chrom, bin, count(*) AS n FROM (SELECT sample_key, chrom, unnest(range(CAST(floor(start_pos / "
    "10000) AS BIGINT), CAST(floor((end_pos - 1) / 10000) AS BIGINT) + 1)) AS bin FROM units) GROUP BY 1, 2, 3"
)(lambda spark, d: counting.bin_counts(units(spark, d), 10_000))
query("a18_alignment_stats",
    f"{fx.cte('frag')} SELECT sample_key, count(*) AS total, count(*) FILTER ((flag & 4) = 0) AS mapped, count(*) FILTER ((flag & 1) <> 0) AS "
    "paired, count(*) FILTER ((flag & 2) <> 0) AS proper, count(*) FILTER ((flag & 1024) <> 0) AS duplicates, count(*) FILTER ((flag & 256) <> 0) "
    "AS secondary, count(*) FILTER ((flag & 2048) <> 0) AS supplementary, round(avg(tlen) FILTER ((flag & 2) <> 0), 4) AS mean_insert FROM frag "
    "GROUP BY 1"
)(lambda spark, d: qc.alignment_stats(frag(spark, d)))
PVALUES = "pv AS (SELECT o_orderkey AS id, ((o_orderkey * 7919) % 10007 + 1) / 10008.0::DOUBLE AS p FROM orders)"


def pvalues(spark, d):
    return spark.read.parquet(f"{d}/orders.parquet").select(
        F.col("o_orderkey").alias("id"), (((F.col("o_orderkey") * 7919) % 10007 + 1) / F.lit(10008.0)).alias("p")
    )


query("w4_bh_adjustment",
    f"WITH {PVALUES}, r AS (SELECT p, count(*) AS k FROM pv GROUP BY 1), q AS (SELECT p, p * sum(k) OVER () / sum(k) OVER (ORDER BY p) AS q FROM "
    "r), a AS (SELECT p, least(1.0, min(q) OVER (ORDER BY p DESC)) AS padj FROM q) SELECT id, round(p, 9) AS p, round(padj, 9) AS padj FROM pv "
    "JOIN a USING (p)"
)(lambda spark, d: stats.bh(pvalues(spark, d), "p").select("id", F.round("p", 9).alias("p"), F.round("padj", 9).alias("padj")))
BINS = (
    "bins AS (SELECT sample_key, chrom, bin, count(*) AS n FROM (SELECT sample_key, chrom, unnest(range(CAST(floor(start_pos / 500) AS BIGINT), "
    "CAST(floor((end_pos - 1) / 500) AS BIGINT) + 1)) AS bin FROM frag WHERE mapq >= 20) GROUP BY 1, 2, 3)"
)
CURVE = (
    "h AS (SELECT sample_key, n, count(*) AS k FROM bins GROUP BY 1, 2), curve AS (SELECT sample_key, n, sum(k) OVER u / sum(k) OVER a AS x, sum(k "
    "* n) OVER u / sum(k * n) OVER a AS y FROM h WINDOW u AS (PARTITION BY sample_key ORDER BY n), a AS (PARTITION BY sample_key))"
)


def curve(spark, d):
    return qc.fingerprint(counting.bin_counts(frag(spark, d).filter("mapq >= 20"), 500))


query(
    "w5_fingerprint_curve",
    f"{fx.cte('frag')}, {BINS}, {CURVE} SELECT sample_key, n, round(x, 6) AS bins_share, round(y, 6) AS reads_share FROM curve"
)(lambda spark, d: curve(spark, d).withColumns({c: F.round(c, 6) for c in ("bins_share", "reads_share")}))
query("q10_fingerprint_metrics",
    f"{fx.cte('frag')}, {BINS}, {CURVE}, z AS (SELECT *, (x - coalesce(lag(x) OVER w, 0)) * (y + coalesce(lag(y) OVER w, 0)) / 2 AS a FROM curve "
    "WINDOW w AS (PARTITION BY sample_key ORDER BY n)) SELECT sample_key, round(sum(a), 6) AS auc, round(max(x - y), 6) AS elbow_gap, "
    "round(min(x) FILTER (y >= 0.01), 6) AS x_intercept FROM z GROUP BY 1"
)(lambda spark, d: qc.fingerprint_metrics(curve(spark, d)))
query("w7_heatmap_order",
    f"{BASE}, m AS (SELECT region_id, round(avg(n), 9) AS mean_signal FROM counts GROUP BY 1) SELECT region_id, mean_signal, row_number() OVER "
    "(ORDER BY mean_signal DESC, region_id) AS rank FROM m"
)(lambda spark, d: qc.heatmap_order(matrix(spark, d).withColumnRenamed("n", "value")).select("region_id", "mean_signal", F.col("rank").cast("long").alias("rank")))

# --- sets

query("u1_union_of_runs",
    f"{fx.cte('frag')} SELECT sample_key, count(*) AS n FROM (SELECT * FROM frag WHERE strand = '+' UNION ALL SELECT * FROM frag WHERE strand = "
    "'-') GROUP BY 1"
)(lambda spark, d: frag(spark, d).filter("strand = '+'").unionByName(frag(spark, d).filter("strand = '-'")).groupBy("sample_key").agg(F.count("*").alias("n")))
# contigs that a sample has reads on and no peak, and windows of a contig with reads and no peak of any sample
query("u5_contigs_without_peaks", f"{fx.cte('frag', 'peaks')} SELECT sample_key, chrom FROM frag EXCEPT SELECT sample_key, chrom FROM peaks")(
    lambda spark, d: frag(spark, d).select("sample_key", "chrom").subtract(fx.table(spark, d, "peaks").select("sample_key", "chrom")))
WINDOW = f"CAST(floor({S} / 1000) AS BIGINT)"
query("u5_windows_without_peaks", f"{fx.cte('frag', 'peaks')} SELECT chrom, {WINDOW} AS window_no FROM frag EXCEPT SELECT chrom, {WINDOW} FROM peaks")(
    lambda spark, d: frag(spark, d).selectExpr("chrom", f"{WINDOW} AS window_no").subtract(fx.table(spark, d, "peaks").selectExpr("chrom", f"{WINDOW} AS window_no")))
query(
    "u5_contigs_outside_blacklist", f"{fx.cte('frag', 'blacklist')} SELECT DISTINCT chrom FROM frag EXCEPT SELECT chrom FROM blacklist"
)(lambda spark, d: frag(spark, d).select("chrom").distinct().exceptAll(fx.table(spark, d, "blacklist").select("chrom").distinct()))
query(
    "u6_shared_contigs", f"{fx.cte('frag', 'blacklist')} SELECT DISTINCT chrom FROM frag INTERSECT SELECT chrom FROM blacklist"
)(lambda spark, d: frag(spark, d).select("chrom").intersect(fx.table(spark, d, "blacklist").select("chrom")))

# --- coverage and normalisation

SNAP = (
    "(SELECT sample_key, chrom, CAST(floor(start_pos / 10) AS BIGINT) * 10 AS start_pos, (CAST(floor((end_pos - 1) / 10) AS BIGINT) + 1) * 10 AS "
    "end_pos FROM units)"
)
COVER = (
    f"sgm AS {segments_sql(SNAP, 'sample_key, chrom')}, rl AS (SELECT *, sum(fresh) OVER (PARTITION BY sample_key, chrom ORDER BY start_pos) AS "
    "run FROM (SELECT *, CASE WHEN lag(end_pos) OVER w = start_pos AND lag(depth) OVER w = depth THEN 0 ELSE 1 END AS fresh FROM sgm WINDOW w AS "
    "(PARTITION BY sample_key, chrom ORDER BY start_pos))), cov AS (SELECT sample_key, chrom, min(start_pos) AS start_pos, max(end_pos) AS "
    "end_pos, any_value(depth) AS depth FROM rl GROUP BY sample_key, chrom, run)"
)
query("n1_binned_coverage", f"{fx.cte('frag')}, {UNITS}, {COVER} SELECT * FROM cov")(lambda spark, d: counting.coverage(units(spark, d)))
query("n2_cpm_track",
    f"{fx.cte('frag')}, {UNITS}, {COVER}, c AS (SELECT sample_key, 1e6 / count(*) AS scale FROM units GROUP BY 1) SELECT 'CPM' AS family, "
    "sample_key, chrom, start_pos, end_pos, round(depth * scale, 6) AS score FROM cov JOIN c USING (sample_key)"
)(
    lambda spark, d: counting.tracks(counting.coverage(units(spark, d)), counting.cpm_scales(units(spark, d)).select("sample_key", F.lit("CPM").alias("family"), "scale")).withColumn("score", F.round("score", 6)))
query("n2b_cpm_metadata",
    f"{fx.cte('frag')}, {UNITS} SELECT sample_key, count(*) AS normalisation_count, array_to_string(list_sort(list(DISTINCT chrom)), ',') AS "
    "contigs, 10::BIGINT AS bin_size FROM units GROUP BY 1"
)(lambda spark, d: units(spark, d).groupBy("sample_key").agg(F.count("*").alias("normalisation_count"), F.array_join(F.array_sort(F.collect_set("chrom")), ",").alias("contigs"), F.lit(10).cast("long").alias("bin_size")))
RPKM = (
    "tot AS (SELECT sample_key, count(*) AS total FROM units GROUP BY 1), rp AS (SELECT sample_key, chrom, bin, count(*) AS n, count(*) * 1e9 / "
    "(any_value(total) * 100000) AS score FROM (SELECT sample_key, chrom, unnest(range(CAST(floor(start_pos / 100000) AS BIGINT), "
    "CAST(floor((end_pos - 1) / 100000) AS BIGINT) + 1)) AS bin FROM units) JOIN tot USING (sample_key) GROUP BY 1, 2, 3)"
)
query(
    "n3_rpkm_bins", f"{fx.cte('frag')}, {UNITS}, {RPKM} SELECT sample_key, chrom, bin, n, round(score, 6) AS score FROM rp"
)(lambda spark, d: counting.rpkm(units(spark, d)).withColumn("score", F.round("score", 6)))
query("q16_karyogram",
    f"{fx.cte('frag')}, {UNITS}, {RPKM} SELECT sample_key, chrom, bin, round(score / max(score) OVER (PARTITION BY sample_key), 9) AS own_share, "
    "round(score / max(score) OVER (), 9) AS global_share FROM rp"
)(lambda spark, d: counting.karyogram(counting.rpkm(units(spark, d))).select("sample_key", "chrom", "bin", F.round("own_share", 9).alias("own_share"), F.round("global_share", 9).alias("global_share")))
query("n4_size_factors", f"{BASE}, {FACTORS} SELECT sample_key, round(size_factor, 9) AS size_factor FROM sf")(
    lambda spark, d: counting.poscounts_factors(matrix(spark, d)).withColumn("size_factor", F.round("size_factor", 9))
)


@query("n8_spikein_scale",
    f"{fx.cte('frag')}, x AS (SELECT sample_key, count(*) FILTER (NOT is_spike AND {CANON} AND mapq >= 30) AS host, count(*) FILTER (is_spike AND "
    "mapq >= 30) AS spike, count(*) FILTER (is_spike) AS spike_q0 FROM frag GROUP BY 1) SELECT sample_key, host, spike, round(spike / (host + "
    "spike), 6) AS fraction, spike_q0 - spike AS low_mapq, round(1e6 * 0.5 / spike, 6) AS scale, round(1e6 / spike, 6) AS cpm_scale, "
    "concat_ws(',', CASE WHEN spike < 10000 THEN 'low_dm6_count' END, CASE WHEN spike / (host + spike) < 0.001 THEN 'low_dm6_fraction' END, CASE "
    "WHEN spike / (host + spike) > 0.5 THEN 'high_dm6_fraction' END) AS warnings FROM x"
)
def spikein(spark, d):
    x = frag(spark, d).groupBy("sample_key").agg(
        F.count_if(~F.col("is_spike") & reads.is_canonical() & (F.col("mapq") >= 30)).alias("host"),
        F.count_if(F.col("is_spike") & (F.col("mapq") >= 30)).alias("spike"), F.count_if("is_spike").alias("spike_q0")
    )
    q = counting.spike_qc(x.withColumn("ratio", F.lit(0.5)))
    return q.select(
        "sample_key", "host", "spike", F.round("fraction", 6).alias("fraction"), "low_mapq", F.round("scale", 6).alias("scale"),
        F.round("cpm_scale", 6).alias("cpm_scale"), F.array_join("warnings", ",").alias("warnings")
    )


@query("n10_track_families",
    f"{BASE}, {COVER}, {FACTORS}, cs AS (SELECT sample_key, sum(n) AS s FROM counts GROUP BY 1), sc AS (SELECT sample_key, unnest(['CPM', "
    "'DESeq2Consensus', 'DESeq2RobustCPM']) AS family, unnest([1e6 / u, 1 / size_factor, 1e6 / (size_factor * g)]) AS scale FROM (SELECT "
    "sample_key, size_factor, exp(avg(ln(s)) OVER ()) AS g FROM sf JOIN cs USING (sample_key)) JOIN (SELECT sample_key, count(*) AS u FROM units "
    "GROUP BY 1) USING (sample_key)) SELECT family, sample_key, count(*) AS segments, round(sum((end_pos - start_pos) * depth * scale), 3) AS "
    "area FROM cov JOIN sc USING (sample_key) GROUP BY 1, 2"
)
def families(spark, d):
    sc, cpm = counting.scales(matrix(spark, d)), counting.cpm_scales(units(spark, d)).select("sample_key", F.lit("CPM").alias("family"), "scale")
    table = cpm.unionByName(
        sc.select("sample_key", F.lit("DESeq2Consensus").alias("family"), F.col("deseq2_consensus_scale").alias("scale"))
    ).unionByName(sc.select("sample_key", F.lit("DESeq2RobustCPM").alias("family"), F.col("robust_cpm_scale").alias("scale")))
    t = counting.tracks(counting.coverage(units(spark, d)), table)
    return t.groupBy("family", "sample_key").agg(F.count("*").alias("segments"), F.round(F.sum((F.col(E) - F.col(S)) * F.col("score")), 3).alias("area"))


query("n11_consensus_checksum",
    f"{fx.cte('peaks')}, {CONSENSUS} SELECT sha256(concat_ws(':', count(*)::VARCHAR, coalesce(sum(('0x' || substr(md5(concat_ws(':', chrom, "
    "start_pos::VARCHAR, end_pos::VARCHAR)), 1, 15))::BIGINT::HUGEINT), 0)::VARCHAR)) AS checksum FROM regions"
)(lambda spark, d: counting.checksum(regions(spark, d)))

# --- statistics

PAIRS = (
    "pr AS (SELECT a.sample_key AS a, b.sample_key AS b, corr(a.{v}, b.{v}) AS r, sqrt(sum((a.{v} - b.{v}) ** 2)) AS distance FROM {t} a JOIN {t} "
    "b ON a.region_id = b.region_id AND a.sample_key < b.sample_key GROUP BY 1, 2)"
)
query(
    "x7_pearson", f"{BASE}, {PAIRS.format(v='n', t='counts')} SELECT a, b, round(r, 6) AS r FROM pr"
)(lambda spark, d: stats.pearson(matrix(spark, d)).withColumn("r", F.round("r", 6)))
query("x8_spearman",
    f"{BASE}, rk AS (SELECT region_id, sample_key, avg(k) OVER (PARTITION BY sample_key, n) AS rank FROM (SELECT *, row_number() OVER (PARTITION "
    f"BY sample_key ORDER BY n) AS k FROM counts)), {PAIRS.format(v='rank', t='rk')} SELECT a, b, round(r, 6) AS r FROM pr"
)(lambda spark, d: stats.spearman(matrix(spark, d)).withColumn("r", F.round("r", 6)))
VST = (
    "vs AS (SELECT region_id, sample_key, log2((1 + 2.0 + 2 * 0.1 * n / size_factor + 2 * sqrt(0.1 * n / size_factor * (1 + 2.0 + 0.1 * n / "
    "size_factor))) / (4 * 0.1)) AS v FROM counts JOIN sf USING (sample_key))"
)


def vst_values(spark, d):
    c = matrix(spark, d)
    return counting.normalised(c, counting.poscounts_factors(c)).withColumn("v", stats.vst(F.col("value"), 0.1, 2.0))


query("x6_vst", f"{BASE}, {FACTORS}, {VST} SELECT sample_key, round(avg(v), 6) AS mean_vst, round(max(v), 6) AS max_vst FROM vs GROUP BY 1")(
    lambda spark, d: vst_values(spark, d).groupBy("sample_key").agg(F.round(F.avg("v"), 6).alias("mean_vst"), F.round(F.max("v"), 6).alias("max_vst"))
)
query(
    "x9_sample_distance", f"{BASE}, {FACTORS}, {VST}, {PAIRS.format(v='v', t='vs')} SELECT a, b, round(distance, 6) AS distance FROM pr"
)(lambda spark, d: stats.euclidean(vst_values(spark, d), value="v").withColumn("distance", F.round("distance", 6)))


def model_conditions() -> tuple[dict[str, str], list[str]]:
    """The conditions with replicates of the samples that have one, and their order."""
    order = ["stem", "prolif", "Day4"]
    return {k: c for k, c in zip(fx.KEYS, fx.CONDITIONS, strict=True) if c in order}, order


def fitted_vst(spark, d):
    c = matrix(spark, d)
    sizes = counting.poscounts_factors(c)
    a0, a1 = stats.dispersion_trend(c, {x.sample_key: x.size_factor for x in sizes.collect()}, *model_conditions())  # a row a sample
    return counting.normalised(c, sizes).withColumn("v", stats.vst(F.col("value"), a0, a1))


# SQL can't fit the trend, so these are tested against brute force
query("x6_vst_fitted")(lambda spark, d: fitted_vst(spark, d).groupBy("sample_key").agg(
    F.round(F.avg("v"), 6).alias("mean_vst"), F.round(F.max("v"), 6).alias("max_vst")
))
query("x9_sample_distance_fitted")(lambda spark, d: stats.euclidean(fitted_vst(spark, d), value="v").withColumn("distance", F.round("distance", 6)))


@query("x10_pca")
def pca(spark, d):
    names, at, share = stats.pca(fitted_vst(spark, d).select("region_id", "sample_key", "v"), value="v")
    return spark.createDataFrame(
        [(s, i + 1, float(at[k, i]), float(share[i])) for k, s in enumerate(names) for i in range(2)],
        "sample_key string, component int, coordinate double, percent_variance double"
    )


def fitted(spark, d):
    return stats.nb_fit(*model_counts(spark, d))


query("x1_differential_model")(fitted)


def replicate_blocks() -> dict[str, dict[str, str]]:
    """Replicates of a number as one block: the design `~ replicate + condition`."""
    return {"replicate": {k: k[-1] for k in fx.KEYS}}


def model_counts(spark, d) -> tuple[DataFrame, dict[str, float], dict[str, str], list[str]]:
    """Counts and size factors of the samples of model_conditions(), the conditions and their order."""
    used, order = model_conditions()
    r = regions(spark, d)
    c = fx.shared(
        spark, d, "model-counts", ("orders", "lineitem"),
        lambda: counting.complete(counting.union_counts(reads.mates(units(spark, d)), r), r, fx.samples(spark)).filter(F.col("sample_key").isin(*used)),
    )
    return c, {x.sample_key: x.size_factor for x in counting.poscounts_factors(c).collect()}, used, order  # a row a sample


@query("x1_blocked_model")
def blocked(spark, d):
    return stats.nb_fit(*model_counts(spark, d), replicate_blocks())


@query("x11_ma_table")
def ma_table(spark, d):
    table = fx.kept(blocked(spark, d), "fitted")
    parts = [stats.bh(table.filter(F.col("contrast") == name)) for name in ("prolif|stem", "Day4|stem", "Day4|prolif")]
    return stats.ma_table(parts[0].unionByName(parts[1]).unionByName(parts[2]))


@query("x3_differential_results")
def differential(spark, d):
    out = None
    table = fx.kept(fitted(spark, d), "fitted")
    for name in ("prolif|stem", "Day4|stem", "Day4|prolif"):
        part, _ = stats.independent_filter(table.filter(F.col("contrast") == name), 0.05)
        num, ref = name.split("|")
        part = stats.volcano(part.withColumns({"significant": stats.significant(0.05), "direction": stats.direction(num, ref)}))
        out = part if out is None else out.unionByName(part)
    return out


def recounted(spark, d, blocks=None):
    used, order = model_conditions()
    depth = iv.depth_segments(units(spark, d), ["chrom"])
    return peaks.differential_by_recount(reads.mates(units(spark, d)), called(spark, d), depth, used, order, blocks=blocks)


query("x5_recount_model")(recounted)
query("x5_blocked_report")(lambda spark, d: stats.report(fx.kept(recounted(spark, d, replicate_blocks()), "recounted"), 1.0, 0.5))


SEGMENTS = 26 * 200_000.0
query("x12_narrow_peaks")(lambda spark, d: peaks.call(peaks.scored_segments(units(spark, d, 0), SEGMENTS)))
CONTROL = "solo_bioR1"


def controlled(spark, d) -> tuple[DataFrame, DataFrame]:
    """Units of all samples but the control, and the control's under each sample's key."""
    u = units(spark, d, 0)
    pairs = fx.samples(spark).filter(F.col("sample_key") != CONTROL).select("sample_key", F.lit(CONTROL).alias("control_key"))
    return u.filter(F.col("sample_key") != CONTROL), peaks.control_units(u, pairs)


def score_sql(depth: str, lam: str) -> str:
    """-log10 of the Poisson tail up to 7, from the terms below the depth."""
    below = f"list_sum(list_transform(range({depth}), lambda i: exp(i * ln({lam}) - {lam} - lgamma(i + 1))))"
    return f"round(least(7.0, -log10(greatest(1e-7, 1 - {below}))), 4)"


def window_sql(source: str, width: int) -> str:
    """Mean depth of windows that a table's units touch."""
    return (
        f"(SELECT sample_key, chrom, bin, sum(least(end_pos, (bin + 1) * {width}) - greatest(start_pos, bin * {width})) / {width}.0::DOUBLE AS mean FROM (SELECT *, unnest(range("
        f"CAST(floor(start_pos / {width}) AS BIGINT), CAST(floor((end_pos - 1) / {width}) AS BIGINT) + 1)) AS bin FROM {source}) GROUP BY 1, 2, 3)"
    )


CONTROLLED = (
    f"{fx.cte('frag')}, u AS (SELECT sample_key, chrom, start_pos, end_pos FROM frag WHERE {KEEP}), t AS (SELECT * FROM u WHERE sample_key <> '{CONTROL}'),"
    f" k AS (SELECT DISTINCT sample_key FROM t), c AS (SELECT k.sample_key, chrom, start_pos, end_pos FROM u, k WHERE u.sample_key = '{CONTROL}'),"
    " ev AS (SELECT sample_key, chrom, pos, sum(a) AS a, sum(b) AS b FROM (SELECT sample_key, chrom, start_pos AS pos, 1 AS a, 0 AS b FROM t UNION ALL SELECT sample_key, chrom, end_pos, -1, 0 FROM t"
    " UNION ALL SELECT sample_key, chrom, start_pos, 0, 1 FROM c UNION ALL SELECT sample_key, chrom, end_pos, 0, -1 FROM c) GROUP BY 1, 2, 3),"
    " sg AS (SELECT sample_key, chrom, pos AS start_pos, lead(pos) OVER w AS end_pos, (sum(a) OVER w)::BIGINT AS depth, (sum(b) OVER w)::BIGINT AS control_depth FROM ev WINDOW w AS (PARTITION BY sample_key, chrom ORDER BY pos)),"
    f" ra AS (SELECT sample_key, x.n / (SELECT count(*) FROM u WHERE sample_key = '{CONTROL}') AS ratio, x.bases / 5200000.0::DOUBLE AS mean FROM (SELECT sample_key, count(*) AS n, sum(end_pos - start_pos) AS bases FROM t GROUP BY 1) x),"
    f" w1 AS {window_sql('c', 1000)}, w2 AS {window_sql('c', 10000)}, la AS (SELECT sg.*, round(greatest(ra.mean, ratio * greatest(control_depth, coalesce(w1.mean, 0), coalesce(w2.mean, 0))), 6) AS lam"
    " FROM sg JOIN ra USING (sample_key) LEFT JOIN w1 ON w1.sample_key = sg.sample_key AND w1.chrom = sg.chrom AND w1.bin = CAST(floor((start_pos + end_pos) / 2 / 1000) AS BIGINT)"
    " LEFT JOIN w2 ON w2.sample_key = sg.sample_key AND w2.chrom = sg.chrom AND w2.bin = CAST(floor((start_pos + end_pos) / 2 / 10000) AS BIGINT) WHERE depth > 0)"
)


@query(
    "x12_control_scores",
    f"{CONTROLLED} SELECT sample_key, chrom, start_pos, end_pos, depth, control_depth, lam, {score_sql('depth', 'round(lam, 3)')} AS score FROM la"
)
def control_scores(spark, d):
    treated, control = controlled(spark, d)
    scored = peaks.poisson_tail(peaks.rates(treated, SEGMENTS, control=control).withColumn("lam", F.round("lam", 6)))
    return scored.select("sample_key", "chrom", S, E, "depth", "control_depth", "lam", F.round(F.least("score", F.lit(7.0)), 4).alias("score"))


@query("x12_control_peaks")
def control_peaks(spark, d):
    treated, control = controlled(spark, d)
    return peaks.call(peaks.scored_segments(treated, SEGMENTS, control=control))


query("x12_single_end_peaks")(
    lambda spark,
    d: peaks.call(peaks.scored_segments(peaks.shifted(frag(spark, d).filter(reads.policy("stringent", "SE", 0) & reads.is_canonical())), SEGMENTS))
)
query("x12_broad_peaks")(lambda spark, d: peaks.call_broad(fx.kept(peaks.scored_segments(units(spark, d, 0), SEGMENTS, keep=fx.kept), "segments")))
query("x13_shifted_reads",
    f"{fx.cte('frag')} SELECT qname, chrom, greatest(0, CASE WHEN strand = '-' THEN end_pos - 75 ELSE start_pos - 75 END) AS start_pos, "
    "greatest(greatest(0, CASE WHEN strand = '-' THEN end_pos - 75 ELSE start_pos - 75 END) + 1, CASE WHEN strand = '-' THEN end_pos + 75 ELSE "
    "start_pos + 75 END) AS end_pos FROM frag"
)(lambda spark, d: peaks.shifted(frag(spark, d)).select("qname", "chrom", S, E))
query("x14_zero_peak_samples",
    f"{fx.cte('peaks', 'samples')} SELECT sample_key, count(chrom) AS n_peaks FROM samples LEFT JOIN (SELECT * FROM peaks WHERE {CANON} AND "
    "peak_type = 'broad') p USING (sample_key) GROUP BY 1"
)(
    lambda spark, d: peaks.with_zero_peaks(fx.samples(spark), called(spark, d).filter("peak_type = 'broad'")))
query(
    "x14_sample_peak_counts",
    f"{fx.cte('peaks', 'samples')} SELECT sample_key, count(chrom) AS n_peaks FROM samples LEFT JOIN peaks USING (sample_key) GROUP BY 1"
)(lambda spark, d: peaks.with_zero_peaks(fx.samples(spark), fx.table(spark, d, "peaks")))

# --- quality control

HIST = (
    f"l AS (SELECT sample_key, tlen AS length FROM frag WHERE {STRINGENT}), tot AS (SELECT sample_key, count(*) AS total, count(*) FILTER (length "
    "> 1000) AS overflow FROM l GROUP BY 1)"
)
query("q3_length_histogram",
    f"{fx.cte('frag')}, {HIST}, g AS (SELECT sample_key, total, overflow, unnest(range(1, 1001)) AS length FROM tot) SELECT sample_key, length, "
    "count(l.length) AS n, total, overflow FROM g LEFT JOIN l USING (sample_key, length) GROUP BY sample_key, length, total, overflow"
)(lambda spark, d: qc.length_histogram(units(spark, d)))
_C = "count(*) FILTER (length BETWEEN {} AND {})"
_N, _M, _D, _T = (_C.format(*x) for x in qc.CLASSES.values())
query("q4_periodicity",
    f"{fx.cte('frag')}, {HIST}, h AS (SELECT sample_key, length, count(*) AS n FROM l GROUP BY 1, 2), mo AS (SELECT sample_key, arg_max(length, n "
    "* 10000 - length) AS mono FROM h WHERE length BETWEEN 150 AND 260 GROUP BY 1), di AS (SELECT sample_key, arg_max(length, n * 10000 - length) "
    "AS di FROM h WHERE length BETWEEN 300 AND 500 GROUP BY 1), c AS (SELECT sample_key, count(*) AS total, count(*) FILTER (length > 1000) AS "
    f"over, {_N} AS n, {_M} AS m, {_D} AS d, {_T} AS t FROM l GROUP BY 1), x AS (SELECT * FROM c LEFT JOIN mo USING (sample_key) LEFT JOIN di "
    "USING (sample_key)) SELECT sample_key, unnest(['proper_pair_fragments', 'fragments_above_plot_max', 'nucleosome_free_1_100_count', "
    "'nucleosome_free_1_100_fraction', 'mononucleosome_180_247_count', 'mononucleosome_180_247_fraction', 'dinucleosome_315_473_count', "
    "'dinucleosome_315_473_fraction', 'trinucleosome_558_615_count', 'trinucleosome_558_615_fraction', 'nfr_to_mononucleosome_ratio', "
    "'periodic_fragment_fraction', 'mononucleosome_local_peak_bp', 'dinucleosome_local_peak_bp', 'mono_to_di_peak_spacing_bp', "
    "'mono_to_di_spacing_deviation_from_200_bp']) AS metric, round(unnest([total::DOUBLE, over, n, n / total, m, m / total, d, d / total, t, t / "
    "total, CASE WHEN m > 0 THEN n / m END, (m + d + t) / total, mono, di, di - mono, abs(di - mono - 200)]), 6) AS value FROM x"
)(
    lambda spark, d: qc.periodicity(qc.length_histogram(units(spark, d))).withColumn("value", F.round("value", 6)))
TSSP = (
    f"{TSS}, tt AS (SELECT * FROM t WHERE regexp_matches(chrom, '^chr[0-9]+$') AND NOT EXISTS (SELECT 1 FROM blacklist b WHERE b.chrom = t.chrom"
    " AND b.start_pos <= tss AND tss < b.end_pos)), pr AS (SELECT sample_key, tt.strand, greatest(u.start_pos, tss - 1000) - tss AS a, least(u.end_pos, tss + 1001) - 1 - tss AS z"
    " FROM units u JOIN tt ON tt.chrom = u.chrom AND u.start_pos <= tss + 1000 AND u.end_pos > tss - 1000), ev AS (SELECT sample_key, position, sum(d) AS d FROM ("
    "SELECT sample_key, CASE WHEN strand = '-' THEN -z ELSE a END AS position, 1 AS d FROM pr UNION ALL SELECT sample_key, CASE WHEN strand = '-' THEN -a ELSE z END + 1, -1 FROM pr) GROUP BY 1, 2),"
    " ps AS (SELECT sample_key, unnest(range(-1000, 1001)) AS position FROM (SELECT DISTINCT sample_key FROM ev)), pf AS (SELECT sample_key, position,"
    " sum(coalesce(d, 0)) OVER (PARTITION BY sample_key ORDER BY position)::BIGINT AS n FROM ps LEFT JOIN ev USING (sample_key, position))"
)


def tss_profile(spark, d):
    return qc.tss_profile(units(spark, d), fx.table(spark, d, "genes"), fx.table(spark, d, "blacklist"))


query("q5_tss_profile", f"{fx.cte('frag', 'genes', 'blacklist')}, {UNITS}, {TSSP} SELECT sample_key, position, n FROM pf")(tss_profile)
query("q5_tss_enrichment",
    f"{fx.cte('frag', 'genes', 'blacklist')}, {UNITS}, {TSSP}, z AS (SELECT sample_key, sum(n) FILTER (abs(position) > 900) / 200 AS back, sum(n) "
    "FILTER (position = 0) AS mid FROM pf GROUP BY 1) SELECT sample_key, round(CASE WHEN back > 0 THEN mid / back END, 6) AS tss_enrichment FROM z"
)(lambda spark, d: qc.tss_enrichment(tss_profile(spark, d)))
query("q6_short_mono_ratio",
    f"{fx.cte('frag')} SELECT sample_key, round(count(*) FILTER (tlen BETWEEN 50 AND 100) / nullif(count(*) FILTER (tlen BETWEEN 150 AND 200), 0), "
    f"6) AS short_mononucleosomal_ratio FROM frag WHERE {STRINGENT} GROUP BY 1"
)(lambda spark, d: qc.short_mono_ratio(units(spark, d)).withColumn("short_mononucleosomal_ratio", F.round("short_mononucleosomal_ratio", 6)))
QC = (
    f"{fx.cte('frag', 'peaks')}, {DUP}, f AS (SELECT sample_key, count(*) AS total_reads, round(100.0 * count(*) FILTER (is_dup) / count(*), "
    "2)::DOUBLE AS dup_percent, round(100 * count(*) FILTER (chrom = 'chrM') / count(*), 2) AS mito_percent FROM dup GROUP BY 1), p AS (SELECT "
    "sample_key, count(*) FILTER (peak_type = 'narrow') AS n_narrow, count(*) FILTER (peak_type = 'broad') AS n_broad FROM peaks GROUP BY 1), fr "
    "AS (SELECT sample_key, round(count(*) FILTER (hit) / count(*), 4) AS frip_narrow FROM (SELECT x.sample_key, EXISTS (SELECT 1 FROM peaks q "
    "WHERE q.peak_type = 'narrow' AND q.sample_key = x.sample_key AND q.chrom = x.chrom AND q.start_pos < x.end_pos AND x.start_pos < q.end_pos) "
    "AS hit FROM frag x) GROUP BY 1), st AS (SELECT * FROM f LEFT JOIN p USING (sample_key) LEFT JOIN fr USING (sample_key))"
)


def qc_stats(spark, d):
    f = frag(spark, d)
    dup = qc.duplication(reads.mark_duplicates(f)).select(
        "sample_key", F.col("examined").alias("total_reads"), F.col("percent_duplication").alias("dup_percent")
    )
    p = fx.table(spark, d, "peaks")
    n = p.groupBy("sample_key").agg(F.count_if(F.col("peak_type") == "narrow").alias("n_narrow"), F.count_if(F.col("peak_type") == "broad").alias("n_broad"))
    fr = qc.frip(f, p.filter("peak_type = 'narrow'"), ["qname"]).select("sample_key", F.col("frip").alias("frip_narrow"))
    return dup.join(qc.mito_percent(f).select("sample_key", "mito_percent"), "sample_key").join(n, "sample_key", "left").join(fr, "sample_key", "left").withColumn("assay", F.lit("ATAC-seq"))


query("q1_qc_summary",
    f"{QC} SELECT *, CASE WHEN n_narrow = 0 AND n_broad = 0 THEN 'NO_PEAKS' WHEN n_narrow < 200 AND n_broad < 200 THEN 'POOR' ELSE 'PASS' END AS "
    "qc_status FROM st"
)(lambda spark, d: qc.summary(qc_stats(spark, d)).drop("assay"))
query("q2_qc_warnings",
    f"{QC} SELECT sample_key, 'LOW_READS' AS warning, total_reads::VARCHAR AS value, '1000000' AS threshold FROM st WHERE total_reads < 1000000 "
    "UNION ALL SELECT sample_key, 'HIGH_DUPLICATION', dup_percent::VARCHAR, '80' FROM st WHERE floor(dup_percent) > 80 UNION ALL SELECT "
    "sample_key, 'HIGH_MITO_ATAC', mito_percent::VARCHAR, '25' FROM st WHERE floor(mito_percent) >= 25 UNION ALL SELECT sample_key, "
    "'ELEVATED_MITO_ATAC', mito_percent::VARCHAR, '10' FROM st WHERE floor(mito_percent) BETWEEN 10 AND 24 UNION ALL SELECT sample_key, "
    "'ZERO_PEAKS', '0', '1' FROM st WHERE n_narrow = 0 AND n_broad = 0 UNION ALL SELECT sample_key, 'FEW_PEAKS', n_narrow::VARCHAR, '200' FROM st "
    "WHERE n_narrow < 200 AND n_broad < 200 AND n_narrow + n_broad > 0 UNION ALL SELECT sample_key, 'LOW_FRIP_NARROW', frip_narrow::VARCHAR, "
    "'0.01' FROM st WHERE n_narrow > 0 AND frip_narrow <= 0.005"
)(lambda spark, d: qc.warnings(qc_stats(spark, d)))


@query("q15_dashboard",
    f"{fx.cte('frag')}, {HIST} SELECT sample_key, round({_N}::DOUBLE, 6) AS nucleosome_free_1_100_count, round({_N} / count(*), 6) AS "
    "nucleosome_free_1_100_fraction, round(count(*)::DOUBLE, 6) AS proper_pair_fragments FROM l GROUP BY 1"
)
def dashboard(spark, d):
    names = ["nucleosome_free_1_100_count", "nucleosome_free_1_100_fraction", "proper_pair_fragments"]
    return qc.wide(qc.periodicity(qc.length_histogram(units(spark, d))).withColumn("value", F.round("value", 6)).filter(F.col("metric").isin(names)), names)


# --- annotation

FLAGS = f"pm AS (SELECT chrom, greatest(0, CASE WHEN strand = '-' THEN end_pos - 501 ELSE start_pos - 2000 END) AS start_pos, CASE WHEN strand = '-' THEN end_pos + 2000 ELSE start_pos + 501 END AS end_pos FROM genes), fl AS (SELECT r.*, EXISTS (SELECT 1 FROM pm x WHERE x.chrom = r.chrom AND x.start_pos < r.end_pos AND r.start_pos < x.end_pos) AS promoter_overlap, EXISTS (SELECT 1 FROM exons x WHERE x.chrom = r.chrom AND x.start_pos < r.end_pos AND r.start_pos < x.end_pos) AS exon_overlap, EXISTS (SELECT 1 FROM genes x WHERE x.chrom = r.chrom AND x.start_pos < r.end_pos AND r.start_pos < x.end_pos) AS gene_body_overlap FROM regions r), ctx AS (SELECT *, gene_body_overlap AND NOT exon_overlap AND NOT promoter_overlap AS intron_overlap, CASE WHEN promoter_overlap THEN 'promoter' WHEN exon_overlap THEN 'exon' WHEN gene_body_overlap THEN 'intron' ELSE 'distal_intergenic' END AS gene_context FROM fl)"
CCRE = (
    "ch AS (SELECT region_id, ccre_id, ccre_class, least(r.end_pos, c.end_pos) - greatest(r.start_pos, c.start_pos) AS width FROM regions r JOIN "
    "ccre c ON c.chrom = r.chrom AND c.start_pos < r.end_pos AND r.start_pos < c.end_pos), c1 AS (SELECT region_id, ccre_id AS ccre_primary_id, "
    "ccre_class AS ccre_primary_class FROM (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY width DESC, CASE ccre_class WHEN 'PLS' "
    "THEN 1 WHEN 'pELS' THEN 2 WHEN 'dELS' THEN 3 WHEN 'CA-CTCF' THEN 4 ELSE 10 END, ccre_id) AS k FROM ch) WHERE k = 1), ca AS (SELECT region_id, "
    "array_to_string(list_sort(list(DISTINCT ccre_id)), ';') AS ccre_all_ids, array_to_string(list_sort(list(DISTINCT ccre_class)), ';') AS "
    "ccre_all_classes FROM ch GROUP BY 1)"
)
ANNOTATION = f"{fx.cte('peaks', 'genes', 'exons', 'ccre')}, {CONSENSUS}, {FLAGS}, {CCRE}, {TSS}, {NEAR}"


def gene_table(spark, d):
    return fx.table(spark, d, "genes")


def annotated(spark, d):
    g = gene_table(spark, d)
    return annotate.annotate(regions(spark, d), g, fx.exons(g), fx.table(spark, d, "ccre"))


query("j5_feature_flags",
    f"{fx.cte('peaks', 'genes', 'exons')}, {CONSENSUS}, {FLAGS} SELECT region_id, promoter_overlap, exon_overlap, intron_overlap, "
    "gene_body_overlap, gene_context FROM ctx"
)(
    lambda spark, d: annotate.feature_flags(regions(spark, d), gene_table(spark, d), fx.exons(gene_table(spark, d))).select("region_id", "promoter_overlap", "exon_overlap", "intron_overlap", "gene_body_overlap", "gene_context"))
query("j6_ccre_hits", f"{fx.cte('peaks', 'ccre')}, {CONSENSUS}, {CCRE} SELECT region_id, ccre_id, ccre_class, width FROM ch")(
    lambda spark, d: annotate.ccre_hits(regions(spark, d), fx.table(spark, d, "ccre")).select("region_id", "ccre_id", "ccre_class", "width")
)
query("w2_primary_ccre", f"{fx.cte('peaks', 'ccre')}, {CONSENSUS}, {CCRE} SELECT * FROM c1")(
    lambda spark, d: annotate.primary_ccre(annotate.ccre_hits(regions(spark, d), fx.table(spark, d, "ccre")))
)
query("q8_region_annotation",
    f"{ANNOTATION} SELECT region_id, chrom, start_pos, end_pos, promoter_overlap, exon_overlap, gene_body_overlap, intron_overlap, gene_context, "
    "nearest_gene_id, nearest_gene_name, nearest_tss_distance_bp, ccre_primary_id, ccre_primary_class, ccre_all_ids, ccre_all_classes, "
    "'TSS-2000/+500bp' AS promoter_definition, ccre_primary_id IS NOT NULL AS ccre_overlap, coalesce(regexp_matches(ccre_all_classes, "
    "'(^|;)(pELS|dELS)(;|$)'), false) AS enhancer_like FROM ctx LEFT JOIN near USING (region_id) LEFT JOIN c1 USING (region_id) LEFT JOIN ca "
    "USING (region_id)"
)(lambda spark, d: annotated(spark, d).drop("ccre_source"))
query("a12_annotation_summary",
    f"{ANNOTATION}, x AS (SELECT gene_context, ccre_primary_class FROM ctx LEFT JOIN c1 USING (region_id)) SELECT 'gene_context' AS "
    "annotation_type, gene_context AS category, count(*) AS significant_sites FROM x GROUP BY 2 UNION ALL SELECT 'ccre_primary_class', "
    "coalesce(ccre_primary_class, 'unannotated'), count(*) FROM x GROUP BY 2"
)(lambda spark, d: annotate.annotation_summary(annotated(spark, d)))

# --- sheets, checks and sinks' tables

query("v13_ccre_check",
    f"{fx.cte('ccre')} SELECT count(*) AS records, count(*) FILTER (NOT {CANON}) AS noncanonical, count(*) FILTER (start_pos < 0 OR end_pos <= "
    "start_pos) AS bad_coordinates, count(*) FILTER (NOT regexp_full_match(ccre_class, "
    f"'({CLASS_NAMES})([;,]({CLASS_NAMES}))*')) "
    "AS unknown_class, count(*) = (SELECT count(*) FROM customer) AS count_matches FROM ccre"
)(lambda spark, d: design.check_ccre(fx.table(spark, d, "ccre"), spark.read.parquet(f"{d}/customer.parquet").count()))
query("v14_matrix_check",
    f"{BASE} SELECT ((SELECT count(*) FROM regions) * 7 - count(*))::BIGINT AS missing, count(*) FILTER (n < 0) AS negative, count(*) FILTER (n <> "
    "floor(n)) AS fractional, count(*) FILTER (n IS NULL) AS null_cells FROM counts"
)(lambda spark, d: design.check_counts(matrix(spark, d), regions(spark, d), fx.samples(spark)))
query(
    "v2_duplicate_rows", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"
)(lambda spark, d: design.duplicate_rows(spark.read.parquet(f"{d}/lineitem.parquet"), ["l_orderkey", "l_linenumber"]))
query("v5_inconsistent_groups",
    "SELECT o_custkey, 'o_orderstatus' AS \"column\" FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderstatus) > 1 UNION ALL SELECT o_custkey, "
    "'o_orderpriority' FROM orders GROUP BY 1 HAVING count(DISTINCT o_orderpriority) > 1"
)(lambda spark, d: design.inconsistent_groups(spark.read.parquet(f"{d}/orders.parquet"), ["o_custkey"], ["o_orderstatus", "o_orderpriority"]))
query("v6_orphans", "SELECT DISTINCT l_orderkey FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')")(
    lambda spark,
    d: design.orphans(
        spark.read.parquet(f"{d}/lineitem.parquet").select(F.col("l_orderkey").cast("string").alias("l_orderkey")).distinct(), "l_orderkey",
        spark.read.parquet(f"{d}/orders.parquet").filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").cast("string").alias("o_orderkey")),
        "o_orderkey"
    ).select(F.col("l_orderkey").cast("long").alias("l_orderkey"))
)
query("k3_wide_matrix",
    f"{BASE} SELECT region_id, chrom, start_pos, end_pos, {', '.join(f'max(n) FILTER (sample_key = {k!r}) AS {k}' for k in fx.KEYS)} FROM counts "
    "JOIN regions USING (region_id) GROUP BY 1, 2, 3, 4"
)(lambda spark, d: writers.wide_matrix(matrix(spark, d), regions(spark, d), fx.KEYS))
query("a15_rollup",
    f"{fx.cte('peaks')}, x AS (SELECT sample_key AS module, peak_type, CASE WHEN signal > 100 THEN 'SUCCESS' ELSE 'FAILED' END AS status FROM "
    "peaks) SELECT module, peak_type, count(*) AS planned, count(*) FILTER (status = 'SUCCESS') AS ok, count(*) FILTER (status = 'FAILED') AS "
    "failed FROM x GROUP BY ROLLUP (module, peak_type)"
)(lambda spark, d: design.rollup_status(fx.table(spark, d, "peaks").select(F.col("sample_key").alias("module"), "peak_type", F.when(F.col("signal") > 100, "SUCCESS").otherwise("FAILED").alias("status"))))
query("k6_track_lines",
    f"{fx.cte('frag')} SELECT 'track type=bigWig name=\"' || n || '\" description=\"run counts per million: ' || n || '\" bigDataUrl=http://x/' || "
    "n || '.bw visibility=full autoScale=on alwaysZero=on color=40,90,180' AS line FROM (SELECT DISTINCT sample_key || '_CPM' AS n FROM frag)"
)(lambda spark, d: frag(spark, d).select(F.concat("sample_key", F.lit("_CPM")).alias("n")).distinct().select(writers.track_line(F.col("n"), "run", "http://x").alias("line")))
