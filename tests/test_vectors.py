"""Literal vectors and brute force."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from peakloom.operators import annotate, counting, design, fastq, peaks, qc, reads, stats
from peakloom.operators import intervals as iv
from peakloom.sources import readers, writers


def frame(spark, rows, columns):
    return spark.createDataFrame(rows, columns)


def spans(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def random_intervals(n, seed, top=4000, longest=60):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        s = rng.randrange(top)
        out.append((i, f"s{rng.randrange(3)}", rng.choice(["chr1", "chr2"]), s, s + 1 + rng.randrange(longest if rng.random() < 0.95 else 3000)))
    return out


def test_canonical_mouse_contigs(spark):
    rows = [("chr1",), ("chr19",), ("chr20",), ("chrX",), ("chrY",), ("chrM",), ("chrUn_A",)]
    kept = frame(spark, rows, "chrom string").filter(reads.is_canonical("mm39"))
    assert [r[0] for r in kept.collect()] == ["chr1", "chr19", "chrX", "chrY"]


def test_consensus_of_three_samples(spark):
    rows = [("A", "chr1", 0, 50), ("A", "chr1", 100, 150), ("B", "chr1", 24, 75), ("B", "chr1", 200, 250), ("C", "chr1", 39, 60), ("C", "chr1", 300, 350)]
    df = frame(spark, rows, "sample_key string, chrom string, start_pos long, end_pos long")
    for tile in (16, 1 << 20):
        assert spans(iv.consensus(df, ["chrom"], "sample_key", 2, tile), "start_pos", "end_pos") == [(24, 60)]
    assert iv.consensus_or_single(df.filter("sample_key = 'A'"), ["chrom"], "sample_key").count() == 0
    assert iv.consensus_or_single(df.filter("sample_key = 'A'"), ["chrom"], "sample_key", allow_single=True).count() == 2


@pytest.mark.parametrize("tile", [50, 1 << 20])
def test_merge_and_disjoin_by_brute_force(spark, tile):
    rows = random_intervals(300, 1)
    df = frame(spark, rows, "id int, sample_key string, chrom string, start_pos long, end_pos long")
    want, support = set(), set()
    for c in ("chr1", "chr2"):
        merged = {}
        for k in ("s0", "s1", "s2"):
            out = []
            for s, e in sorted((s, e) for _, kk, cc, s, e in rows if cc == c and kk == k):
                if out and s <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], e)
                else:
                    out.append([s, e])
            merged[k] = out
            want |= {(k, c, s, e) for s, e in out}
        points = sorted({p for m in merged.values() for x in m for p in x})
        for a, b in zip(points[:-1], points[1:], strict=True):
            n = sum(any(s <= a and b <= e for s, e in m) for m in merged.values())
            if n:
                support.add((c, a, b, n))
    assert set(spans(iv.merge(df, ["sample_key", "chrom"], tile), "sample_key", "chrom", "start_pos", "end_pos")) == want
    assert set(spans(iv.disjoin(df, ["chrom"], "sample_key", tile), "chrom", "start_pos", "end_pos", "support")) == support


def test_overlap_join_by_brute_force(spark):
    a, b = random_intervals(200, 2), random_intervals(200, 3)
    schema = "id int, sample_key string, chrom string, start_pos long, end_pos long"
    left, right = frame(spark, a, schema), frame(spark, b, schema).select(F.col("id").alias("rid"), "chrom", "start_pos", "end_pos")
    want = sorted((x[0], y[0]) for x in a for y in b if x[2] == y[2] and x[3] < y[4] and y[3] < x[4])
    assert spans(iv.overlap_join(left, right, bin_width=20, coarse=8), "id", "rid") == want
    assert {r[0] for r in iv.with_any(left, right, ["id"], anti=True, bin_width=20).select("id").collect()} == {x[0] for x in a} - {x for x, _ in want}


def test_nearest_by_brute_force(spark):
    rows = random_intervals(100, 4)
    points = [(f"g{i}", random.Random(i).choice(["chr1", "chr2"]), random.Random(i * 7).randrange(7000)) for i in range(40)]
    got = iv.nearest(frame(spark, rows, "id int, k string, chrom string, start_pos long, end_pos long"), frame(spark, points, "name string, chrom string, at long"), "id", "at", "name")
    want = {}
    for i, _, c, s, e in rows:
        gap = lambda p, s=s, e=e: s - p if p < s else max(0, p - e + 1)
        best = min(((gap(p), p, g) for g, cc, p in points if cc == c), default=None)
        want[i] = best and best[0]
    assert {r.id: r.distance for r in got.collect()} == want


def test_pair_and_single_read_counting(spark):
    region = frame(spark, [("r", "chr1", 0, 100)], "region_id string, chrom string, start_pos long, end_pos long")
    pair = frame(spark, [("s", "q", "chr1", 9, 29), ("s", "q", "chr1", 59, 79)], "sample_key string, qname string, chrom string, start_pos long, end_pos long")
    assert counting.union_counts(pair, region).first().n == 1
    assert counting.union_counts(pair.withColumn("qname", F.col("start_pos").cast("string")), region).first().n == 2


def test_mapq_bins(spark):
    rows = [("s", q, x) for q, x in zip([0, 0, 5, 6, 12, 20, 30, 31, 40, 42], [True, True] + [False] * 8, strict=True)]
    r = qc.mapq_bins(frame(spark, rows, "sample_key string, mapq int, has_xs boolean")).first()
    assert (r.mapq_0, r.mapq_1_9, r.mapq_10_29, r.mapq_30, r.xs_tagged) == (2, 2, 2, 4, 2)


def test_scales_and_spikein(spark):
    f = lambda r, n: counting.spike_scale(F.lit(1e6), F.lit(r), F.lit(n))
    assert spark.range(1).select(f(1.0, 2000), f(0.5, 2000)).first()[:] == (500.0, 250.0)
    with pytest.raises(PySparkException):
        spark.range(1).select(f(1.0, 0)).collect()
    q = counting.spike_qc(frame(spark, [("s", 8000, 2000, 2100, 1.0)], "sample_key string, host long, spike long, spike_q0 long, ratio double")).first()
    assert (q.scale, q.raw_scale, q.cpm_scale, q.low_mapq, q.warnings) == (500.0, 1.0, 500.0, 100, ["low_dm6_count"])


def test_pair_order_and_excluded_singleton(spark):
    rows = [(0, "a1", "stem"), (1, "a2", "stem"), (2, "b1", "prolif"), (3, "b2", "prolif"), (4, "c1", "Day4"), (5, "c2", "Day4"), (6, "x", "solo")]
    e = design.eligibility(frame(spark, rows, "sheet_order int, sample_key string, condition string"))
    plan = [tuple(r)[1:] for r in design.comparison_plan(design.condition_order(e)).orderBy("comparison_id").collect()]
    assert plan == [("prolif", "stem"), ("Day4", "stem"), ("Day4", "prolif")]
    with pytest.raises(ValueError):
        design.condition_order(e, ("stem", "stem"))
    with pytest.raises(ValueError):
        design.condition_order(e, ("nothing",))


def test_null_padj_is_not_significant(spark):
    rows = [(None, 1.0), (0.01, 1.0), (0.2, 1.0)]
    assert [r[0] for r in frame(spark, rows, "padj double, log2_fc double").select(stats.significant(0.05)).collect()] == [False, True, False]


def test_bh_by_brute_force(spark):
    p = [0.5, 0.01, 0.01, 0.04, 0.9, None, 1e-12, 0.3]
    got = {r.i: r.padj for r in stats.bh(frame(spark, list(enumerate(p)), "i int, p double"), "p").collect()}
    x = sorted((v, i) for i, v in enumerate(p) if v is not None)
    low, want = 1.0, {5: None}
    for rank in range(len(x), 0, -1):
        low = min(low, x[rank - 1][0] * len(x) / rank)
        want[x[rank - 1][1]] = low
    for i in want:
        assert got[i] is None if want[i] is None else got[i] == pytest.approx(want[i])


def test_model_finds_planted_changes_only(spark):
    rng = np.random.default_rng(320)
    mu, size = 120.0, 15.0
    k = rng.negative_binomial(size, size / (size + mu), (400, 4))
    names = ["a1", "a2", "b1", "b2"]
    cond = dict(zip(names, ["a", "a", "b", "b"], strict=True))

    def hits(m):
        rows = [(f"r{i:03d}", s, int(v)) for i, r in enumerate(m) for s, v in zip(names, r, strict=True)]
        fit = stats.nb_fit(frame(spark, rows, "region_id string, sample_key string, n long"), dict.fromkeys(names, 1.0), cond, ["a", "b"])
        return {r.region_id: r.log2_fc for r in stats.bh(fit, "pvalue").filter(stats.significant(0.05)).collect()}

    assert not hits(k)
    planted = k.copy()
    planted[:80, 2:] *= 12
    found = hits(planted)
    assert len([r for r in found if int(r[1:]) < 80]) >= 70 and all(found[r] > 2 for r in found if int(r[1:]) < 80)
    with pytest.raises(ValueError):
        stats.nb_fit(frame(spark, [("r", "a1", 1)], "region_id string, sample_key string, n long"), {"a1": 1.0}, {"a1": "a"}, ["a", "b"])


def test_planted_peak_is_called(spark):
    rng = random.Random(9)
    rows = [("s", "chr1", s, s + 150) for s in (rng.randrange(1_000_000) for _ in range(2000))] + [("s", "chr1", 500_000 + rng.randrange(100), 500_150 + rng.randrange(100)) for _ in range(80)]
    schema = "sample_key string, chrom string, start_pos long, end_pos long"
    found = peaks.call(peaks.scored_segments(frame(spark, rows, schema), 1_000_000)).collect()
    assert any(r.start_pos < 500_125 < r.end_pos for r in found) and len(found) <= 3


def test_sheet_rules(spark):
    base = dict.fromkeys(design.CORE, "") | {"layout": "PE", "genome": "hg38", "assay": "ATAC", "macs2_mode": "both", "is_control": "FALSE", "replicate": "1", "tech_replicate": "1", "fastq_1": "w", "fastq_2": "x"}
    bad = [base | {"row": 1}, base | {"row": 2, "layout": "XX"}, base | {"row": 3, "fastq_2": ""}, base | {"row": 4, "replicate": "one"}]
    got = {(r.row, r.message) for r in design.violations(spark.createDataFrame(bad)).collect()}
    assert got == {(2, "invalid layout"), (3, "paired-end row without fastq_2"), (4, "replicate is not an integer")}
    assert design.check_columns([*design.CORE, "spikein_genome"]) == ["missing column spikein_to_host_ratio", "missing column spikein_stage"]
    mixed = frame(spark, [("PE", "hg38"), ("SE", "hg38")], "layout string, genome string")
    assert tuple(design.uniform_cohort(mixed).first()) == (2, 1)


def test_read_sheets_pass_the_rules(spark, tmp_path):
    """Sheets of each shape, read from text and checked: the old annotation column, the core, and a spike-in declaration."""
    cells = {"sample_id": "A", "fastq_1": "a_1.fq.gz", "fastq_2": "a_2.fq.gz", "layout": "PE", "genome": "hg38", "assay": "ATAC-seq", "factor": "ATAC", "condition": "stem", "treatment": "none", "cell_type": "k", "replicate": "1", "tech_replicate": "1", "is_control": "FALSE", "control_id": "", "macs2_mode": "both", "blacklist": "b.bed", "output_prefix": "A"}
    spike = {"spikein_genome": "dm6", "spikein_to_host_ratio": "0.5", "spikein_stage": "pre_tagmentation_nuclei"}

    def read(name, *rows):
        text = [",".join(rows[0]), *[",".join(f'"{v}"' if v else v for v in r.values()) for r in rows]]
        (tmp_path / name).write_text("\n".join(text) + "\n")
        return readers.samplesheet(spark, str(tmp_path / name))

    old, core = read("old.csv", cells | {"chipqc_annotation": "x"}), read("core.csv", cells)
    calibrated = read("spike.csv", cells | spike, cells | {"replicate": "2"} | {k: "" for k in spike}, cells | {"replicate": "3"} | spike | {"spikein_stage": "pre_tagmentation"}, cells | {"replicate": "4"} | spike | {"spikein_to_host_ratio": "inf"}, cells | {"replicate": "5", "spikein_genome": "", "spikein_to_host_ratio": "1", "spikein_stage": ""})
    assert [design.variant(x.columns) for x in (old, core, calibrated)] == ["18", "17", "17+3"]
    assert all(design.check_columns(x.columns) == [] for x in (old, core, calibrated))
    assert design.violations(old).count() == design.violations(core).count() == 0 and core.first().row == 2
    got = {(r.row, r.message) for r in design.violations(calibrated).collect()}
    assert got == {(4, "unknown spike-in stage"), (4, "spike-in stage must be pre_tagmentation_nuclei"), (5, "spike-in ratio must be finite and above 0"), (6, "spike-in fields without a genome")}
    assert [(r.key, r.spikein_to_host_ratio) for r in design.spikein_samples(calibrated.filter("row < 4")).collect()] == [("A_bioR1", 0.5)]
    for row in (4, 5):
        with pytest.raises(PySparkException):
            design.spikein_samples(calibrated.filter(f"row = {row}")).collect()
    with pytest.raises(PySparkException):
        design.spikein_samples(calibrated.filter("row < 4").withColumn("replicate", F.lit("1"))).collect()
    assert [tuple(r) for r in design.repeated_keys(core.unionByName(core.withColumn("row", F.lit(9)))).collect()] == [(9, 2)]
    assert design.too_few_samples(core).first().samples == 1 and design.too_few_samples(calibrated).count() == 0
    assert tuple(design.pooled_groups(core.unionByName(core.withColumns({"replicate": F.lit("2"), "macs2_mode": F.lit("narrow")}))).first()) == ("ATAC__stem__none__k__hg38__PE", "A_bioR1,A_bioR2", 2, "both")


def test_comparisons_have_a_status_each(spark):
    plan = frame(spark, [("001", "b", "a"), ("002", "c", "a"), ("003", "c", "b")], "comparison_id string, numerator string, reference string")
    conditions = frame(spark, [("a", 2), ("b", 3), ("c", 2)], "condition string, replicates int")
    results = frame(spark, [("001", 2.0, 0.01), ("001", -2.0, 0.01), ("001", 3.0, None), ("002", 1.0, 0.01)], "comparison_id string, log2_fc double, padj double")
    failures = frame(spark, [("002", "did not converge")], "comparison_id string, message string")
    out = {r.comparison_id: r for r in design.comparison_status(plan, conditions, results, failures, "M", "narrow", 9, 0.05, 1.0).collect()}
    assert {k: (r.status, r.tested_sites, r.higher_in_numerator, r.message) for k, r in out.items()} == {"001": ("SUCCESS", 2, 1, ""), "002": ("FAILED", None, None, "did not converge"), "003": ("FAILED", None, None, "no results")}
    none = design.comparison_status(plan.limit(0), conditions, results, failures, "M", "narrow", 9, 0.05, 1.0).collect()
    assert [(r.status, r.module, r.consensus_regions) for r in none] == [("SKIPPED", "M", 9)] and len(none[0]) == 19


def test_missing_factors_and_inputs_are_errors(spark):
    counts, factors = frame(spark, [("r", "a", 4), ("r", "b", 4)], "region_id string, sample_key string, n long"), frame(spark, [("a", 2.0)], "sample_key string, size_factor double")
    assert counting.normalised(counts.filter("sample_key = 'a'"), factors).first().value == 2.0
    with pytest.raises(PySparkException):
        counting.normalised(counts, factors).collect()
    samples = counts.select("sample_key")
    kept, dropped = design.with_inputs(samples, factors)
    assert [r[0] for r in kept.collect()] == ["a"] and [r[0] for r in dropped.collect()] == ["b"]
    with pytest.raises(PySparkException):
        design.with_inputs(samples, factors, strict=True)[0].collect()
    with pytest.raises(ValueError, match="no fragments"):
        counting.guarded(counts.limit(0), "fragments")
    assert [tuple(r) for r in counting.empty_samples(counts.filter("sample_key = 'a'"), samples).collect()] == [("b", 0)]


def test_existence_and_ranks_in_small_tiles(spark):
    import random

    rng = random.Random(3)
    spans = [(rng.randrange(3000), rng.choice([5, 60, 900, 5000])) for _ in range(150)]
    left = frame(spark, [(i, "c", s, s + n) for i, (s, n) in enumerate(spans)], "id int, chrom string, start_pos long, end_pos long")
    holes = [(rng.randrange(9000), rng.randrange(1, 40)) for _ in range(20)]
    right = frame(spark, [("c", s, s + n) for s, n in holes], "chrom string, start_pos long, end_pos long")
    got = {r.id: r.hit for r in iv.with_flag(left, right, ["id"], "hit", width=16, coarse=8).collect()}
    assert got == {i: any(s < a + k and a < s + n for a, k in holes) for i, (s, n) in enumerate(spans)}
    ranks = {r.id: r["rank"] for r in iv.number(left, [F.col("start_pos"), F.col("id")], [F.floor(F.col("start_pos") / 100)]).collect()}
    assert [i for i, _ in sorted(ranks.items(), key=lambda x: x[1])] == sorted(range(150), key=lambda i: (spans[i][0], i))
    segments = [("s", "c", 90, 99, 5, 1.0, 3.0), ("s", "c", 105, 130, 9, 2.0, 3.0), ("s", "c", 300, 420, 7, 2.0, 3.0), ("s", "c", 425, 520, 8, 2.5, 3.0)]
    df = frame(spark, segments, "sample_key string, chrom string, start_pos long, end_pos long, depth long, score double, q double")
    called = [tuple(r)[2:] for r in peaks.call(df, gap=10, least=20, tile=100).orderBy("start_pos").collect()]
    assert called == [tuple(r)[2:] for r in peaks.call(df, gap=10, least=20).orderBy("start_pos").collect()] == [(90, 130, 9, 2.0, 3.0, 117), (300, 520, 8, 2.5, 3.0, 472)]


def test_ccre_checks(spark):
    rows = [("chr1", 0, 10, "PLS"), ("chr1", 0, 10, "unknown-class"), ("chrM", 5, 2, "pELS;dELS")]
    r = design.check_ccre(frame(spark, rows, "chrom string, start_pos long, end_pos long, ccre_class string"), 3).first()
    assert tuple(r) == (3, 1, 1, 1, True)
    assert frame(spark, [("CA-CTCF,CTCF-bound",), ("",), (" other ",)], "c string").select(readers.normal_class(F.col("c"))).collect()[0][0] == "CA-CTCF;CTCF-bound"
    order = frame(spark, [("CA",), ("PLS;CA",), ("zzz",)], "c string").select(annotate.class_priority("c"))
    assert [r[0] for r in order.collect()] == [10, 1, 999]


def test_readers(spark, tmp_path):
    def put(name, text):
        (tmp_path / name).write_text(text)
        return str(tmp_path / name)

    sam = put("a.sam", "@HD\tVN:1\nq1\t99\tchr1\t11\t42\t5M2D3M\t=\t50\t60\tACGT\tIIII\tXS:i:-3\tNM:i:0\n")
    a = readers.alignments(spark, sam).withColumn("ref_end", readers.reference_end()).first()
    assert (a.start_pos, a.ref_end, a.tags["XS"], a.tlen) == (10, 20, "-3", 60)
    assert readers.bed(spark, put("b.bed", "#x\nchr1\t5\t9\tn\nchr1\t9\t3\n"), strict=False).count() == 1
    with pytest.raises(PySparkException):
        readers.bed(spark, str(tmp_path / "b.bed")).collect()
    p = readers.peaks(spark, put("s_bioR1_peaks.narrowPeak", "chr1\t1\t9\tp\t100\t.\t5.5\t3\t2\t4\n")).first()
    assert (p.sample_key, p.peak_type, p.signal, p.summit) == ("s_bioR1", "narrow", 5.5, 4)
    g = readers.gtf(spark, put("g.gtf", '#h\nchr1\tx\tgene\t11\t20\t.\t-\t.\tgene_id "G1"; gene_name "N 1"; tag "a"; tag "b";\n'))
    assert (g.first().attributes["tag"], readers.tss_bed(g).first().tss, readers.tss_bed(g).first().name) == ("a", 19, "N_1")
    c = readers.ccre(spark, put("c.bed", "chr1\t1\t9\tid1\tx\tPLS,CTCF-bound\nchr1\tbad\t9\nchr2\t3\t9\t\ty\t\n")).orderBy("chrom").collect()
    assert [(r.ccre_id, r.ccre_class) for r in c] == [("id1", "PLS;CTCF-bound"), ("ccre_2", "unclassified")]
    m = readers.count_matrix(spark, put("m.tsv", "#'chr'\t'start'\t'end'\t's1'\t's2'\nchr1\t0\t9\t3\t4.0\n"), ["s1", "s2"])
    assert sorted((r.sample_key, r.n) for r in m.collect()) == [("s1", 3), ("s2", 4)]
    assert readers.duplication_metrics(spark, put("d.txt", "## x\nLIBRARY\tA\tPERCENT_DUPLICATION\nlib\t1\t0.2375\n")).first().percent_duplication == 23.75
    k = put("k.tsv", "key\tsize_factor\na\t0.8\nb\t0\n")
    assert readers.keyed_value(spark, k, "size_factor").filter("key = 'a'").first().value == 0.8
    with pytest.raises(PySparkException):
        readers.keyed_value(spark, k, "size_factor").collect()
    j = readers.metrics_json(spark, put("j.json", '{"a": {"tss_x": 1.5, "z": 2}, "l": [{"tss_y": 3}, 4]}'))
    assert sorted((r.path, r.value) for r in j.collect()) == [("a.tss_x", "1.5"), ("l[0].tss_y", "3")]
    f = readers.fastq(spark, put("r.fastq", "@r1 x\nACGT\n+\nIIII\n@r2\nACGN\n+\n@@II\n"))
    assert sorted((r.read_id, r.seq, r.qual) for r in f.collect()) == [("r1", "ACGT", "IIII"), ("r2", "ACGN", "@@II")]
    assert readers.bedgraph(spark, put("x.bedgraph", "track x\nchr1\t0\t10\t1.5\nchr1 5\n")).first().score == 1.5
    assert readers.chrom_sizes(spark, put("z.sizes", "chr1\t100\n")).first().size == 100
    assert readers.samplesheet(spark, put("s.csv", 'sample_id,layout\n " a ",PE\n')).first().layout == "PE"


def test_writers(spark, tmp_path):
    df = frame(spark, [("a", None), ("b", 2)], "k string, v int")
    writers.tsv(df.coalesce(1), str(tmp_path / "t"))
    text = "".join(p.read_text() for p in sorted((tmp_path / "t").glob("part*")))
    assert "a\tNA" in text and text.startswith("k\tv")
    writers.tsv(df.limit(0), str(tmp_path / "e"))
    assert "".join(p.read_text() for p in (tmp_path / "e").glob("part*")).strip() == "k\tv"
    s = frame(spark, [("m<", "SUCCESS", "3"), ("n", "FAILED", "9")], "module string, status string, significant_sites string")
    assert tuple(writers.differential_totals(s).first()) == (2, 1, 3)
    assert "m&lt;" in writers.differential_html(s, ["module", "status"])


def test_reads_are_trimmed_in_pairs(spark):
    rows = [("s", "r1", 1, "ACGTACGTACGTACGTACGTACGTCTGTCTCTTATA", "I" * 36), ("s", "r1", 2, "ACGTACGTACGTACGTACGTACGT", "I" * 20 + "####"), ("s", "r2", 1, "ACGT", "IIII"), ("s", "r2", 2, "A" * 30, "I" * 30)]
    df = frame(spark, rows, "sample_key string, read_id string, mate int, seq string, qual string")
    assert fastq.detect_adapter(df) == "CTGTCTCTTATA"
    out = {(r.read_id, r.mate): r.seq for r in fastq.trim(df, "CTGTCTCTTATA").collect()}
    assert out == {("r1", 1): "ACGTACGTACGTACGTACGTACGT", ("r1", 2): "ACGTACGTACGTACGTACGT"}
    p = {r.position: r for r in fastq.position_profile(df).collect()}
    assert p[0].reads == 4 and p[0].n_a == 4 and p[3].n_t == 3


def test_funnel_and_policies_are_ordered(spark):
    from peakloom.plans import fixture

    f = reads.mark_duplicates(fixture.table(spark, "/root/testdata/sf0.001", "frag"))
    n = {r.policy: r["count"] for r in reads.filtering_policies(f, reads.is_canonical(), F.col("is_dup")).groupBy("policy").count().collect()}
    assert n["permissive"] >= n["intermediate"] >= n["stringent"] > 0


def test_zero_peaks_and_blacklist_over_whole_tables(spark):
    from conftest import TEST_DATA
    from peakloom.plans import fixture, queries

    n = {r.sample_key: r.n_peaks for r in queries.QUERIES["x14_sample_peak_counts"](spark, TEST_DATA).collect()}
    assert set(n) == set(fixture.KEYS) and sum(n.values()) == spark.read.parquet(f"{TEST_DATA}/orders.parquet").count()
    known = {r.chrom for r in fixture.table(spark, TEST_DATA, "blacklist").collect()}
    read = {r.chrom for r in fixture.table(spark, TEST_DATA, "frag").select("chrom").distinct().collect()}
    assert {r.chrom for r in queries.QUERIES["u5_contigs_outside_blacklist"](spark, TEST_DATA).collect()} == read - known
    sheet = frame(spark, [("a",), ("b",)], "sample_key string")
    some = frame(spark, [("a", "chr2", 900_000, 900_100)], "sample_key string, chrom string, start_pos long, end_pos long")
    assert sorted(map(tuple, peaks.with_zero_peaks(sheet, some).collect())) == [("a", 1), ("b", 0)]
    with pytest.raises(PySparkException):
        peaks.with_zero_peaks(sheet, some, allow_zero=False).collect()


def brute_trend(k, groups):
    """Dispersion trend of counts with equal size factors: means of a group are fitted means then."""
    from math import lgamma, log

    u, disp = [], []
    for row in k:
        mu = np.zeros(len(row))
        for g in set(groups):
            at = [i for i, x in enumerate(groups) if x == g]
            mu[at] = row[at].mean()
        best = None
        for a in stats.GRID:
            ll = sum(lgamma(y + 1 / a) - lgamma(1 / a) - (y + 1 / a) * log(1 + a * m) + y * log(a * m) for y, m in zip(row, mu, strict=True))
            ll -= 0.5 * sum(log(sum(mu[i] / (1 + a * mu[i]) for i, x in enumerate(groups) if x == g)) for g in set(groups))
            best = max(best or (ll, a), (ll, a))
        u.append(1 / row.mean())
        disp.append(best[1])
    u, disp = (np.array(x)[np.array(disp) > 1e-5] for x in (u, disp))
    slope = max(0.0, np.cov(u, disp, bias=True)[0, 1] / u.var())
    return max(1e-4, disp.mean() - slope * u.mean()), slope


def test_vst_follows_the_fitted_trend(spark):
    rng = np.random.default_rng(7)
    mu = np.geomspace(8, 800, 150)[:, None]
    size = 1 / (0.04 + 4 / mu)
    k = np.maximum(rng.negative_binomial(size, size / (size + mu), (150, 8)), 1)
    names = [f"{g}{i}" for g in "ab" for i in range(4)]
    cond = {n: n[0] for n in names}
    counts = frame(spark, [(f"r{i:03d}", n, int(v)) for i, r in enumerate(k) for n, v in zip(names, r, strict=True)], "region_id string, sample_key string, n long")
    a0, a1 = stats.dispersion_trend(counts, dict.fromkeys(names, 1.0), cond, ["a", "b"])
    assert (a0, a1) == pytest.approx(brute_trend(k.astype(float), [n[0] for n in names]), rel=1e-4)
    assert 0.01 < a0 < 0.1 and 1 < a1 < 8


def test_vst_queries_take_the_trend_of_the_counts(spark):
    from conftest import TEST_DATA
    from peakloom.plans import queries

    c = queries.matrix(spark, TEST_DATA)
    sizes = {r.sample_key: r.size_factor for r in counting.poscounts_factors(c).collect()}
    a, b = stats.dispersion_trend(c, sizes, *queries.model_conditions())
    rows, names = c.collect(), sorted(sizes)
    ids = sorted({r.region_id for r in rows})
    n = {(r.region_id, r.sample_key): r.n / sizes[r.sample_key] for r in rows}
    x = np.array([[n[i, s] for s in names] for i in ids])
    v = np.log2((1 + b + 2 * a * x + 2 * np.sqrt(a * x * (1 + b + a * x))) / (4 * a))
    got = {r.sample_key: (r.mean_vst, r.max_vst) for r in queries.QUERIES["x6_vst_fitted"](spark, TEST_DATA).collect()}
    for j, s in enumerate(names):
        assert got[s] == pytest.approx((v[:, j].mean(), v[:, j].max()), abs=2e-6)
    for r in queries.QUERIES["x9_sample_distance_fitted"](spark, TEST_DATA).collect():
        assert r.distance == pytest.approx(np.linalg.norm(v[:, names.index(r.a)] - v[:, names.index(r.b)]), abs=2e-6)
    top = v[np.argsort(-v.var(1, ddof=1), kind="stable")[:500]]
    w = np.linalg.svd(top - top.mean(1, keepdims=True), compute_uv=False)
    share = {r.component: r.percent_variance for r in queries.QUERIES["x10_pca"](spark, TEST_DATA).collect()}
    assert [share[1], share[2]] == pytest.approx(list(100 * w[:2] ** 2 / (w**2).sum()), rel=1e-6)


def test_plan_follows_the_samples_of_the_tables(spark, tmp_path):
    from conftest import TEST_DATA
    from peakloom.plans import queries

    assert sorted(map(tuple, queries.sheet(spark, TEST_DATA).collect())) == sorted(map(tuple, queries.fx.samples(spark).collect()))
    spark.read.parquet(f"{TEST_DATA}/orders.parquet").filter("o_orderkey % 7 in (0, 1, 4, 5, 2)").write.parquet(str(tmp_path / "orders.parquet"))
    plan = queries.QUERIES["j11_comparison_plan"](spark, str(tmp_path)).collect()
    assert [(r.numerator, r.reference) for r in plan] == [("Day4", "stem")]
    assert {r.condition: r.replicates for r in queries.QUERIES["a9_condition_eligibility"](spark, str(tmp_path)).collect()} == {"stem": 2, "prolif": 1, "Day4": 2}
