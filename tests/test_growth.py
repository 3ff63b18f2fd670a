"""Work grows with the bytes of the input and no faster."""

from __future__ import annotations

from peakloom.llm import embedding_dedup
from peakloom.operators import counting, peaks
from peakloom.sources import fastq_source

U = "start_pos long, end_pos long, mapq int, is_dup boolean"


def test_short_fastq_ranges_share_tasks(monkeypatch, tmp_path):
    """Many short ranges are a bounded number of tasks, each byte is in one, and no range reads far beyond its end."""
    record = b"@r\nACGT\n+\nIIII\n"
    for i in range(3):
        (tmp_path / f"{i}.fastq").write_bytes(record * (1000 + i))
    monkeypatch.setattr(fastq_source, "TASKS", 7)
    reader = fastq_source.FastqReader([str(tmp_path)], 64)
    parts = reader.partitions()
    assert len(parts) <= 8
    ranges = [r for p in parts for r in p.ranges()]
    assert len(ranges) > 600 and all(r.end - r.first <= 64 for r in ranges)
    assert sum(b.num_rows for p in parts for b in reader.read(p)) == 3003
    assert len(fastq_source.FastqReader([str(tmp_path)], 64, task_bytes=1000).partitions()) > 40


def test_planes_follow_the_largest_label(spark, monkeypatch):
    """Labels part the rows already, so more labels ask for no more planes, and with them for no more tables."""
    asked, own = [], embedding_dedup.planes_for
    monkeypatch.setattr(embedding_dedup, "planes_for", lambda rows, *a: asked.append(rows) or own(rows, *a))
    rows = [(i, [float(i % 7 + 1), float(i)], i % 10) for i in range(50)]
    assert embedding_dedup.links(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.93).count() == 50
    assert asked == [5]


def test_policies_share_one_join(spark):
    """Counts by policy from one join are those of a join for each policy."""
    units = spark.createDataFrame([("a", "chr1", i * 7, i * 7 + 40, i % 50, i % 3 == 0) for i in range(200)], f"sample_key string, chrom string, {U}")
    regions = spark.createDataFrame([(f"r{i}", "chr1", i * 90, i * 90 + 100) for i in range(12)], "region_id string, chrom string, start_pos long, end_pos long")
    joined = counting.policy_counts(units, regions, {"all": (0, False), "good": (30, True)})
    for name, rule in (("all", "true"), ("good", "mapq >= 30 and not is_dup")):
        expected = counting.overlap_counts(units.filter(rule), regions)
        assert sorted(map(tuple, counting.of_policy(joined, name).collect())) == sorted(map(tuple, expected.collect()))


def test_scores_are_kept_once(spark):
    """Scores, which are read twice, are handed to keep() once, and peaks are the same with it."""
    units = spark.createDataFrame([("a", "chr1", 5000 + i % 40, 5200 + i % 60, 0, False) for i in range(300)], f"sample_key string, chrom string, {U}")
    asked = []
    kept = peaks.scored_segments(units, 1e6, keep=lambda df, name: asked.append(name) or df.localCheckpoint())
    assert asked == ["scored"] and kept.count() > 0
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, peaks.scored_segments(units, 1e6).collect()))
