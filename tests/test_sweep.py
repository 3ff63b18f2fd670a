"""Merged intervals, their support and consensus against a sweep in plain Python, where many rows tie: says which side is right."""

from __future__ import annotations

from collections import Counter, defaultdict

import duckdb
import pytest

from conftest import TEST_DATA
from peakloom.plans import fixture as fx
from peakloom.plans import registry

CANONICAL = [*(f"chr{i}" for i in range(1, 23)), "chrX", "chrY"]


def merged(rows):
    out = []
    for s, e in sorted(rows):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


def segments(rows):
    change = Counter()
    for s, e in rows:
        change[s] += 1
        change[e] -= 1
    at, depth, out = sorted(change), 0, []
    for a, b in zip(at, [*at[1:], None], strict=True):
        depth += change[a]
        if depth:
            out.append((a, b, depth))
    return out


@pytest.fixture(scope="module")
def repeated():
    """Orders of the smallest table, each 300 times."""
    con = duckdb.connect()
    con.execute(f"CREATE VIEW orders AS SELECT t.* FROM read_parquet('{TEST_DATA}/orders.parquet') t, range(300)")
    return con


@pytest.fixture(scope="module")
def swept(repeated):
    peaks, chroms = defaultdict(list), defaultdict(list)
    for k, c, s, e in repeated.execute(f"{fx.cte('peaks')} SELECT sample_key, chrom, start_pos, end_pos FROM peaks").fetchall():
        peaks[k, c].append((s, e))
    by = {key: merged(rows) for key, rows in peaks.items()}
    for (_, c), rows in by.items():
        chroms[c] += rows
    support = {c: segments(rows) for c, rows in chroms.items()}
    regions = [(c, *x) for c in CANONICAL for x in merged((s, e) for s, e, n in support.get(c, []) if n >= 2)]
    return {
        "i1_merged_peaks": [(k, c, s, e) for (k, c), rows in by.items() for s, e in rows],
        "i2_disjoint_support": [(c, *x) for c, rows in support.items() for x in rows],
        "i3_consensus": [(f"peak_{i:06d}", *x) for i, x in enumerate(regions, 1)],
        "i4_single_sample": [(c, s, e) for (k, c), rows in by.items() if k == "solo_bioR1" for s, e in rows],
    }


CHECKED = ["i1_merged_peaks", "i2_disjoint_support", "i3_consensus", "i4_single_sample"]


@pytest.mark.parametrize("name", CHECKED)
def test_sql_by_sweep(repeated, swept, name):
    assert Counter(repeated.execute(registry.oracle_sql()[name]).fetchall()) == Counter(swept[name])


@pytest.mark.parametrize("name", CHECKED)
def test_query_by_sweep(spark, swept, name):
    rows = registry.queries()[name](spark, TEST_DATA).collect()
    assert Counter(map(tuple, rows)) == Counter(swept[name])
