"""Queries against DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

from conftest import TEST_DATA, same
from peakloom.plans import registry

CHECKED = [
    "f1_flag_policies", "f8_species_split", "f9_harmonised_names", "f15_safe_tokens", "d2_duplicate_removal", "d4_filter_funnel", "d5_pair_repair",
    "d7_filtering_policies", "i1_merged_peaks", "i2_disjoint_support", "i3_consensus", "i5_supporting_samples", "i10_summit_windows",
    "i12_prefilter_manifest", "j1_region_counts", "j2_union_counts", "j3_frip", "j4_blacklist_removal", "j7_nearest_tss", "j11_comparison_plan",
    "n1_binned_coverage", "n4_size_factors", "n8_spikein_scale", "w4_bh_adjustment", "q2_qc_warnings", "q4_periodicity", "q5_tss_enrichment",
    "q8_region_annotation", "x8_spearman", "x13_shifted_reads", "a15_rollup", "v4_sheet_violations", "v3_repeated_keys", "v7_mixed_cohorts",
    "a14_pooled_groups", "q12_spikein_samples", "j10_resolved_controls", "q11_sample_table", "f11_dropped_samples", "a10_condition_order",
    "x4_comparison_status", "x5b_contrast_manifest", "a6_frip_sets", "q1_summary_rows", "n11_consensus_checksum", "q13_position_profile",
    "q14_trimmed_reads", "s1_samplesheet", "s2_alignments", "s4_peaks", "s6_gtf_tss", "s7_ccre", "s13_fastq", "n10_all_families", "s13_fastq_ranges",
    "s7_numbered_ccre", "x12_control_scores", "k4_sorted_tracks", "k4_track_manifest", "k10_provenance", "s10_required_keys", "s11_duplication_files",
    "s12_metrics_json", "u4_discovered_summaries", "f15_transliterated_words", "v5_sample_metadata", "v10_missing_peak_types", "j1_salted_counts",
    "x7_pearson_of_bins", "q15_whole_dashboard",
]


@pytest.mark.parametrize("name", CHECKED)
def test_matches_duckdb(spark, duck, name):
    assert same(registry.queries()[name](spark, TEST_DATA), duck.execute(registry.oracle_sql()[name]))


def test_entry_runs(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
