"""Merged intervals in SQL where many rows tie: repeated peaks change no merged interval, region or what rests on them."""

from __future__ import annotations

import duckdb
import pytest

from conftest import TABLES, TEST_DATA, same
from peakloom.plans import registry

CHECKED = [
    "i11_narrow_broad_union", "i1_merged_peaks", "i2_disjoint_support", "i3_consensus", "i4_single_sample", "j6_ccre_hits",
    "j7_nearest_tss", "j9_annotated_results", "k3_wide_matrix", "k5_bed_round_trip", "n11_consensus_checksum", "q8_region_annotation",
    "s9_count_matrix",
]


@pytest.fixture(scope="module")
def repeated():
    """The smallest tables, each order 300 times."""
    con = duckdb.connect()
    for t in TABLES:
        times = ", range(300)" if t == "orders" else ""
        con.execute(f"CREATE VIEW {t} AS SELECT t.* FROM read_parquet('{TEST_DATA}/{t}.parquet') t{times}")
    return con


@pytest.mark.parametrize("name", CHECKED)
def test_repeated_peaks(spark, repeated, name):
    assert same(registry.queries()[name](spark, TEST_DATA), repeated.execute(registry.oracle_sql()[name]))
