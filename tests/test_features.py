"""Splits of files, skewed bins, designs with blocks, isolated comparisons, selection of quantiles, controls."""

from __future__ import annotations

import gzip
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TEST_DATA
from peakloom.operators import counting, design, peaks, qc, reads, selection, stats
from peakloom.operators import intervals as iv
from peakloom.plans import fixture, registry
from peakloom.sources import fastq_source, readers

COUNTS = "region_id string, sample_key string, n long"


def fastq_text(n, line="\n", last=True, blank=0, empty=False):
    rng = random.Random(n)
    records, text = [], []
    for i in range(n):
        size = rng.randrange(0 if empty else 1, 60)
        seq, qual = "".join(rng.choices("ACGTN", k=size)), "".join(rng.choices("@+I#5", k=size))
        qual = "@" + qual[1:] if size and i % 2 else qual
        records.append((f"r{i}", seq, qual))
        text.append(line.join([f"@r{i} @x", seq, f"+{f'r{i}' if i % 3 == 0 else ''}", qual]))
    return line.join(text) + line * (last + blank), records


@pytest.mark.parametrize("how", [{}, {"line": "\r\n"}, {"last": False}, {"blank": 3}, {"blank": 5}, {"empty": True}, {"empty": True, "line": "\r\n", "blank": 2}])
def test_fastq_ranges(monkeypatch, tmp_path, how):
    """Every split and chunk size gives the records of the file once, in order, whatever letters quality lines begin with."""
    text, expected = fastq_text(40, **how)
    path = tmp_path / "a.fastq"
    path.write_bytes(text.encode())
    for split in (1, 2, 7, 50, 64, 111, 500, 1 << 20):
        for chunk in (5, 17, 1 << 20):
            monkeypatch.setattr(fastq_source, "CHUNK", chunk)
            reader = fastq_source.FastqReader([str(path)], split)
            got = [tuple(r.values()) for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
            assert got == expected, (split, chunk)


def test_fastq_files(spark, tmp_path):
    text, expected = fastq_text(3000)
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.fastq").write_text(text)
    with gzip.open(tmp_path / "in" / "b.fastq.gz", "wt") as f:
        f.write(text)
    (tmp_path / "in" / "_SUCCESS").write_text("")
    (tmp_path / "in" / "empty.fastq").write_text("")
    got = readers.fastq(spark, str(tmp_path / "in"), mate=2, split_bytes=4096)
    assert got.rdd.getNumPartitions() > 40
    assert sorted(tuple(r) for r in got.collect()) == sorted((i, 2, s, q) for i, s, q in expected * 2)
    assert readers.fastq(spark, f"file://{tmp_path}/in/a.fastq").count() == 3000
    for bad, message in (("@a\nAC\n+\nII\n@b\nAC\n+\n", "cut off"), ("@a\nAC\n+\nI\n", "not a FASTQ record")):
        (tmp_path / "c.fastq").write_text(bad)
        with pytest.raises(Exception, match=message):
            readers.fastq(spark, str(tmp_path / "c.fastq")).collect()


def test_order_in_files(spark, tmp_path):
    """First seen holds over splits of a few bytes: names of TSSs, numbers of regulatory elements."""
    (tmp_path / "g").mkdir()
    lines = [f'chr1\tx\tgene\t{100 * (i % 500) + 1}\t{100 * (i % 500) + 50}\t.\t+\t.\tgene_id "g{i}"; gene_name "{"ZYX"[i // 500]}{i}";' for i in range(1500)]
    (tmp_path / "g" / "a.gtf").write_text("\n".join(lines[:700]) + "\n")
    (tmp_path / "g" / "b.gtf").write_text("\n".join(lines[700:]) + "\n")
    elements = [f"chr1\t{10 * i}\t{10 * i + 5}\t{'' if i % 3 else f'id{i}'}\tx\tPLS" for i in range(2000)]
    (tmp_path / "c.bed").write_text("\n".join(elements) + "\n")
    was = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("777", "128m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            tss = readers.tss_bed(readers.gtf(spark, str(tmp_path / "g"))).collect()
            assert {r.tss: r.name for r in tss} == {100 * i: f"Z{i}" for i in range(500)}
            c = readers.ccre(spark, str(tmp_path / "c.bed")).collect()
            assert {r.start_pos: r.ccre_id for r in c} == {10 * i: f"ccre_{i + 1}" if i % 3 else f"id{i}" for i in range(2000)}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", was)
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_discovered_tables(spark, tmp_path):
    """Each table is read by its own header; what one lacks is NA; a required column is asked of each."""
    for name, text in (("a", "module\tstatus\nm1\tSUCCESS\n"), ("b", "status\tmodule\textra\nFAILED\tm2\t7\n\nSUCCESS\t \t\n")):
        (tmp_path / name).mkdir()
        (tmp_path / name / "differential_accessibility_comparisons.tsv").write_text(text)
    got = readers.discover(spark, [str(tmp_path)], required=("module", "status")).collect()
    assert sorted((r.module, r.status, r.extra, r.source_table.split("/")[-2]) for r in got) == [("NA", "SUCCESS", "NA", "b"), ("m1", "SUCCESS", "NA", "a"), ("m2", "FAILED", "7", "b")]
    with pytest.raises(ValueError, match="extra"):
        readers.discover(spark, [str(tmp_path)], required=("extra",))


def test_peak_types_by_first_row(spark):
    rows = [(1, " S1", "1", "no", "Both "), (2, "S1", "1", "no", "narrow"), (3, "S2", "1", "no", "narrow"), (4, "S2 ", "1", "no", "both"), (5, "S3", "1", "TRUE", "none"), (6, "S4", "1", "no", "Broad")]
    sheet = spark.createDataFrame(rows, "row long, sample_id string, replicate string, is_control string, macs2_mode string")
    assert sorted(r.sample_id for r in design.both_peak_types(sheet).collect()) == ["S2", "S4"]


@pytest.fixture(scope="module")
def crowded(spark):
    """Units of which a third lie in one bin, many of them equal, and regions."""
    units = spark.range(60_000).select(F.lit("s1").alias("sample_key"), F.concat(F.lit("q"), "id").alias("qname"), F.lit("chr1").alias("chrom"), F.when(F.col("id") % 3 == 0, 5000 + F.col("id") % 40).otherwise((F.col("id") * 7919) % 4_000_000).alias("start_pos"))
    units = units.withColumn("end_pos", F.col("start_pos") + 100)
    regions = spark.range(2000).select(F.format_string("r%d", "id").alias("region_id"), F.lit("chr1").alias("chrom"), (F.col("id") * 2000 + 300).alias("start_pos"), (F.col("id") * 2000 + 600).alias("end_pos"))
    return units, regions.unionByName(regions.limit(1).select(F.lit("hot").alias("region_id"), "chrom", F.lit(5010).cast("long").alias("start_pos"), F.lit(5020).cast("long").alias("end_pos")))


def test_hot_bins_are_cut(spark, crowded):
    units, regions = crowded
    bins = units.withColumn("_bin", F.floor(F.col("start_pos") / 2000))
    rows = regions.withColumn("_bin", F.floor(F.col("start_pos") / 2000))
    hot = iv.hot_keys(bins.select("_bin"), ["_bin"], 16).collect()
    assert len(hot) == 1 and hot[0]["_bin"] == 2 and hot[0]["_pieces"] > 20

    def tasks(df, by):
        was = spark.conf.get("spark.sql.adaptive.enabled")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        try:
            return sorted(r["n"] for r in df.repartition(16, *by).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect())
        finally:
            spark.conf.set("spark.sql.adaptive.enabled", was)

    left, right = iv.salted(bins, rows, ["_bin"], 16)
    plain, cut = tasks(bins, ["_bin"]), tasks(left, ["_bin", "_salt"])
    assert plain[-1] > 5 * plain[len(plain) // 2] and cut[-1] < 4 * cut[len(cut) // 2]
    assert right.count() == rows.count() + hot[0]["_pieces"] - 1 + (hot[0]["_pieces"] - 1) * rows.filter("_bin = 2").count() - (hot[0]["_pieces"] - 1)


def test_salted_joins_give_the_same(crowded):
    units, regions = crowded
    for f in (counting.overlap_counts, counting.union_counts):
        a, b = ({(r.region_id, r.sample_key): r.n for r in f(units, regions, salt=s).collect()} for s in (False, True))
        assert a == b and a["hot", "s1"] > 10_000
    flags = [sorted((r.qname, r.hit) for r in iv.with_flag(units, regions, ["qname"], "hit", salt=s).select("qname", "hit").collect()) for s in (False, True)]
    assert flags[0] == flags[1]


def test_selected_quantiles(spark):
    rng = np.random.default_rng(5)
    sets = {"a": rng.normal(size=3001), "b": np.repeat([1.0, 2.0], [700, 900]), "c": rng.lognormal(0, 40, 2500), "d": np.array([4.0]), None: np.array([-1e308, 1e308, 3.0, 3.0]), "e": np.concatenate([np.zeros(5000), rng.normal(size=11)])}
    rows = [(k, float(x)) for k, v in sets.items() for x in v] + [("a", None), ("a", float("nan")), ("f", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    shares = [0.0, 0.1, 0.5, 0.77, 1.0]
    for few, cells in ((50_000, 1024), (40, 64)):
        got = {r[0]: list(r)[1:] for r in selection.quantiles(df, ["g"], "x", shares, few, cells).collect()}
        assert set(got) == set(sets)
        for k, v in sets.items():
            v = np.sort(v)
            at = [q * (len(v) - 1) for q in shares]
            expected = [v[int(a)] + (v[int(np.ceil(a))] - v[int(a)]) * (a - int(a)) for a in at]
            assert got[k] == expected, k
    assert list(selection.quantiles(df.filter("g = 'd'"), [], "x", [0.5]).first()) == [4.0]
    assert selection.quantiles(df.filter("g = 'f'"), [], "x", [0.5]).count() == 0


def negative_binomial(rng, mean, size=20):
    return rng.negative_binomial(size, size / (size + mean))


def test_block_term(spark):
    """Four donors that differ tenfold: the paired design finds the planted twofold change, the plain one misses it."""
    rng, donors = np.random.default_rng(11), ["p", "q", "r", "s"]
    names = [f"{c}{d}" for c in ("ctl", "trt") for d in donors]
    rows, planted = [], set()
    for i in range(240):
        level = rng.permutation([30.0, 90.0, 270.0, 600.0])
        change = 2.5 if i < 40 else 1.0
        planted |= {f"r{i}"} if i < 40 else set()
        for j, s in enumerate(names):
            rows.append((f"r{i}", s, int(negative_binomial(rng, level[j % 4] * (change if j >= 4 else 1.0)))))
    counts = spark.createDataFrame(rows, COUNTS)
    factors, conditions = dict.fromkeys(names, 1.0), {s: s[:3] for s in names}
    found = {}
    for key, blocks in (("plain", None), ("paired", {"donor": {s: s[3:] for s in names}})):
        fit = stats.nb_fit(counts, factors, conditions, ["ctl", "trt"], blocks)
        found[key] = {r.region_id for r in stats.report(fit, 0.05, 0.5).collect()}
    assert len(found["plain"] & planted) < 10
    assert len(found["paired"] & planted) > 30 and len(found["paired"] - planted) < 8


def test_designs():
    of = {"a1": "a", "a2": "a", "b1": "b", "b2": "b"}
    d = stats.design(list(of), {"donor": {"a1": "x", "a2": "y", "b1": "x", "b2": "y"}, "condition": of}, {"condition": ["b", "a"]})
    assert d.columns == ["(intercept)", "donor:y", "condition:a"] and d.contrast("condition", "a", "b").tolist() == [0, 0, 1] and d.contrast("condition", "b", "a").tolist() == [0, 0, -1]
    with pytest.raises(ValueError, match="condition:b follow"):
        stats.design(list(of), {"donor": {k: v + "!" for k, v in of.items()}, "condition": of})
    with pytest.raises(ValueError, match="not in the model"):
        d.contrast("condition", "c", "b")
    with pytest.raises(ValueError, match="no donor for"):
        stats.design(list(of), {"donor": {}, "condition": of})


def test_failing_comparisons_leave_the_others_alone(spark):
    rng = np.random.default_rng(3)
    names = [f"{c}{i}" for c in "abc" for i in (1, 2, 3)]
    rows = [(f"r{i}", s, int(negative_binomial(rng, 200.0 * (4 if s[0] == "b" and i < 20 else 1)))) for i in range(120) for s in names]
    of = stats.model({s: s[0] for s in names}, ["a", "b", "c"])
    plan = {"1": ("b", "a"), "2": ("c", "a"), "3": ("ghost", "a")}

    tested = stats.nb_comparisons(spark.createDataFrame(rows, COUNTS), dict.fromkeys(names, 1.0), of, plan)
    results, failures = stats.completed(tested)
    assert {r.contrast: r.n for r in results.groupBy("contrast").agg(F.count("*").alias("n")).collect()} == {"1": 120, "2": 120}
    assert [tuple(r) for r in failures.collect()] == [("3", "condition ghost is not in the model")]
    assert {r.region_id for r in stats.report(results.filter("contrast = '1'").withColumn("contrast", F.lit("b|a")), 0.01, 1.0).collect()} >= {f"r{i}" for i in range(20)}
    # a batch whose covariance is broken for one contrast only
    beta, cov = np.zeros((2, 3)), np.stack([np.diag([1.0, 1.0, np.nan])] * 2)
    with pytest.raises(ValueError, match="standard error"):
        stats.wald(beta, cov, np.array([0.0, 0.0, 1.0]))


def test_status_of_isolated_comparisons(spark):
    out = {r.comparison_id: r for r in registry.queries()["x4_isolated_comparisons"](spark, TEST_DATA).collect()}
    assert sorted(r.status for r in out.values()) == ["FAILED"] * 3 + ["SUCCESS"] * 3
    assert all(("solo" in r.comparison_id) == (r.status == "FAILED") and ("not in the model" in r.message) == (r.status == "FAILED") for r in out.values())


def test_ma_table(spark):
    rows = [("r1", 100.0, 7.0, 0.01), ("r2", 10.0, -6.0, 0.2), ("r3", 0.0, 1.0, 0.01), ("r4", 5.0, None, None), ("r5", 5.0, 1.0, None)]
    got = {r.region_id: (r.log10_mean, r.shown_lfc, r.beyond, r.significant) for r in stats.ma_table(spark.createDataFrame(rows, "region_id string, base_mean double, log2_fc double, padj double")).collect()}
    assert got["r1"] == (2.0, 5.0, "above", True) and got["r2"] == (1.0, -5.0, "below", False) and set(got) == {"r1", "r2", "r5"} and got["r5"][2:] == (None, False)


def test_peaks_of_the_control_are_not_called(spark):
    """Two piles in the treated sample; the one that the control has as well is no peak.  The control is three times as deep."""
    rng = random.Random(4)
    spread = lambda n, sample: [(sample, "chr1", s, s + 150) for s in (rng.randrange(1_000_000) for _ in range(n))]
    pile = lambda at, n, sample: [(sample, "chr1", at + i % 60, at + i % 60 + 150) for i in range(n)]
    schema = "sample_key string, chrom string, start_pos long, end_pos long"
    treated = spark.createDataFrame(spread(1500, "t") + pile(300_000, 120, "t") + pile(700_000, 120, "t"), schema)
    control = spark.createDataFrame(spread(4500, "c") + pile(700_000, 360, "c"), schema)
    control = peaks.control_units(control, spark.createDataFrame([("t", "c"), ("u", None)], "sample_key string, control_key string"))
    near = lambda found: {round(r.start_pos, -5) for r in found.collect() if r.signal > 50}
    assert near(peaks.call(peaks.scored_segments(treated, 1e6))) == {300_000, 700_000}
    assert near(peaks.call(peaks.scored_segments(treated, 1e6, control=control))) == {300_000}
    assert near(peaks.call(peaks.scored_segments(treated, 1e6, control=control.filter("false")))) == {300_000, 700_000}


def test_paired_segments(spark):
    schema = "k string, start_pos long, end_pos long"
    a, b = [("x", 0, 10), ("x", 5, 25), ("y", 3, 4)], [("x", 8, 12), ("x", 20, 40), ("z", 1, 2)]
    got = sorted(tuple(r) for r in peaks.paired_segments(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema), ["k"], tile=7).collect())
    depth = lambda rows, k, p: sum(s <= p < e for key, s, e in rows if key == k)
    covered = {(k, p): (d, c) for k, s, e, d, c in got for p in range(s, e)}
    assert covered == {(k, p): (depth(a, k, p), depth(b, k, p)) for k in "xyz" for p in range(50) if depth(a, k, p)}


def test_required_keys_and_heatmap_order(spark, tmp_path):
    (tmp_path / "f.tsv").write_text("key\tsize_factor\na\t0.5\nb\t2\n")
    ask = lambda *keys: readers.keyed_value(spark, str(tmp_path / "f.tsv"), "size_factor", spark.createDataFrame([(k,) for k in keys], "key string"))
    assert {r.key: r.value for r in ask("a").collect()} == {"a": 0.5}
    with pytest.raises(Exception, match="no value for c"):
        ask("a", "c").collect()
    rows = [(f"peak_{i:06d}", "s", float(i % 7 if i % 3 else 0)) for i in range(3000)]
    ranked = qc.heatmap_order(spark.createDataFrame(rows, "region_id string, sample_key string, value double")).collect()
    assert [r.region_id for r in sorted(ranked, key=lambda r: r["rank"])] == [k for k, _, _ in sorted(rows, key=lambda r: (-r[2], r[0]))]


def test_transliteration(spark):
    words = {"Straße": "Strasse", "déjà vu": "deja_vu", "Ærø": "AEro", "naïve-Ñandú_1.2": "naive-Nandu_1.2", "Łódź": "Lodz", "e\u0301": "e", "日本": "condition", "_x_": "x", "ß" * 40: "ss" * 30}
    df = spark.createDataFrame([(w,) for w in words], "w string")
    assert {r.w: r.t for r in df.select("w", reads.safe_token(F.col("w")).alias("t")).collect()} == words
