"""What rests on the consensus regions against plain Python over swept regions, where many peaks tie: says which side is right."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import pytest

from conftest import TABLES, TEST_DATA
from peakloom.plans import fixture as fx
from peakloom.plans import registry
from test_sweep import CANONICAL, merged, segments

EXPECTED = {}


def expects(name):
    def put(f):
        EXPECTED[name] = f
        return f

    return put


@pytest.fixture(scope="module")
def repeated():
    """The smallest tables, each order 300 times."""
    con = duckdb.connect()
    for t in TABLES:
        times = ", range(300)" if t == "orders" else ""
        con.execute(f"CREATE VIEW {t} AS SELECT t.* FROM read_parquet('{TEST_DATA}/{t}.parquet') t{times}")
    return con


@pytest.fixture(scope="module")
def t(repeated):
    """Rows of the tables read as sequencing tables, and the regions of a sweep over sorted peaks."""
    read = lambda name, columns, *more: repeated.execute(f"{fx.cte(name, *more)} SELECT {columns} FROM {(more or (name,))[-1]}").fetchall()
    peaks, chroms = defaultdict(list), defaultdict(list)
    for k, c, s, e in read("peaks", "sample_key, chrom, start_pos, end_pos"):
        peaks[k, c].append((s, e))
    for (_, c), rows in peaks.items():
        chroms[c] += merged(rows)
    found = [(c, *x) for c in CANONICAL for x in merged((s, e) for s, e, n in segments(chroms[c]) if n >= 2)]
    return SimpleNamespace(
        regions=[(f"peak_{i:06d}", *x) for i, x in enumerate(found, 1)],
        genes=read("genes", "chrom, start_pos, end_pos, gene_id, gene_name, strand"), exons=read("genes", "chrom, start_pos, end_pos", "exons"),
        ccre=read("ccre", "chrom, start_pos, end_pos, ccre_id, ccre_class"),
        frag=read("frag", "chrom, start_pos, end_pos, sample_key, flag, mapq")
    )


def over(rows, region):
    _, chrom, start, end = region
    return [r for r in rows if r[0] == chrom and r[1] < end and start < r[2]]


def agree(expected, columns, rows):
    order = sorted(expected[0])
    assert sorted(columns) == order
    at = [columns.index(c) for c in order]
    assert Counter(tuple(r[i] for i in at) for r in rows) == Counter(tuple(r[c] for c in order) for r in expected)


@expects("j6_ccre_hits")
def hits(t):
    return [
        {"region_id": r[0], "ccre_id": i, "ccre_class": k, "width": min(e, r[3]) - max(s, r[2])} for r in t.regions for _, s, e, i, k in over(t.ccre, r)
    ]


def closest(t, region):
    """Smallest distance, then position, then id: (distance, position, id, name, strand), or None."""
    _, chrom, start, end = region
    tss = [(e - 1 if strand == "-" else s, i, name, strand) for c, s, e, i, name, strand in t.genes if c == chrom]
    return min(((max(start - p, p - end + 1, 0), p, i, name, strand) for p, i, name, strand in tss), default=None)


@expects("j7_nearest_tss")
def nearest(t):
    out = []
    for r in t.regions:
        if x := closest(t, r):
            gap, position, i, name, strand = x
            signed = ((r[2] + 1 + r[3]) // 2 - (position + 1)) * (-1 if strand == "-" else 1)
            out.append({"region_id": r[0], "nearest_gene_id": i, "nearest_gene_name": name, "nearest_tss_distance_bp": signed, "edge_distance": gap})
    return out


def flags(t, region):
    bounds = [(c, e - 501, e + 2000) if strand == "-" else (c, s - 2000, s + 501) for c, s, e, _, _, strand in t.genes]
    promoter, exon, body = (bool(over(x, region)) for x in (bounds, t.exons, t.genes))
    context = "promoter" if promoter else "exon" if exon else "intron" if body else "distal_intergenic"
    return {"promoter_overlap": promoter, "exon_overlap": exon, "gene_body_overlap": body, "intron_overlap": context == "intron", "gene_context": context}


def primary(t, region):
    """(id, class) of the widest element, then by class, then id."""
    rank = {k: i for i, k in enumerate(["PLS", "pELS", "dELS", "CA-CTCF", "CA"])}
    found = [(max(s, region[2]) - min(e, region[3]), rank[k], i, k) for _, s, e, i, k in over(t.ccre, region)]
    return min(found)[2:] if found else (None, None)


@expects("j9_annotated_results")
def results(t):
    return [
        {"region_id": r[0], "width": r[3] - r[2], "gene_context": flags(t, r)["gene_context"], "ccre_primary_class": primary(t, r)[1]} for r in t.regions
    ]


def counts(t):
    """Of each region, the units of each sample that overlap it."""
    units = [f for f in t.frag if f[0] in CANONICAL and f[5] >= 30 and f[4] & 2 and not f[4] & 3852]
    return [(r, Counter(u[3] for u in over(units, r))) for r in t.regions]


@expects("k3_wide_matrix")
def wide(t):
    return [{"region_id": i, "chrom": c, "start_pos": s, "end_pos": e} | {k: n[k] for k in fx.KEYS} for (i, c, s, e), n in counts(t)]


@expects("k5_bed_round_trip")
def bed(t):
    return [{"chrom": c, "start_pos": s, "end_pos": e, "name": i} for i, c, s, e in t.regions]


@expects("n11_consensus_checksum")
def checksum(t):
    parts = sum(int(hashlib.md5(f"{c}:{s}:{e}".encode()).hexdigest()[:15], 16) for _, c, s, e in t.regions)
    return [{"checksum": hashlib.sha256(f"{len(t.regions)}:{parts}".encode()).hexdigest()}]


@expects("q8_region_annotation")
def annotation(t):
    out, near = [], {x["region_id"]: x for x in nearest(t)}
    for r in t.regions:
        elements, (best, kind) = over(t.ccre, r), primary(t, r)
        ids, kinds = (sorted({x[i] for x in elements}) for i in (3, 4))
        out.append(dict(zip(["region_id", "chrom", "start_pos", "end_pos"], r, strict=True)) | flags(t, r) | {
            **{c: near.get(r[0], {}).get(c) for c in ("nearest_gene_id", "nearest_gene_name", "nearest_tss_distance_bp")},
            "ccre_primary_id": best, "ccre_primary_class": kind, "ccre_all_ids": ";".join(ids) or None, "ccre_all_classes": ";".join(kinds) or None,
            "promoter_definition": "TSS-2000/+500bp", "ccre_overlap": bool(elements), "enhancer_like": bool({"pELS", "dELS"} & set(kinds))
        })
    return out


@expects("s9_count_matrix")
def long_matrix(t):
    return [{"chrom": c, "start_pos": s, "end_pos": e, "sample_key": k, "n": n[k]} for (_, c, s, e), n in counts(t) for k in fx.KEYS]


@pytest.mark.parametrize("name", EXPECTED)
def test_sql_by_sweep(repeated, t, name):
    done = repeated.execute(registry.oracle_sql()[name])
    agree(EXPECTED[name](t), [c[0] for c in done.description], done.fetchall())


@pytest.mark.parametrize("name", EXPECTED)
def test_query_by_sweep(spark, t, name):
    df = registry.queries()[name](spark, TEST_DATA)
    agree(EXPECTED[name](t), df.columns, df.collect())
