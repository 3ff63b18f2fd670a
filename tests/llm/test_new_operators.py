"""Code compression, importance resampling and sharding: brute force, nulls, empties, ties, repeated rows, clashing columns."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TEST_DATA
from peakloom.llm import code_compression, common, registry, resampling, sharding

DOC = "doc_id long, text string, source string, size long, score string"
VEC = "vec_id long, embedding array<float>, label int, code string"


@pytest.mark.parametrize("name", ["op11_code_compression", "op12_resampling"])
def test_matches_duckdb(spark, duck, name):
    got = registry.queries()[name](spark, TEST_DATA)
    cursor = duck.execute(registry.oracle_sql()[name])
    expected = cursor.fetchall()
    assert sorted(got.columns) == sorted(c[0] for c in cursor.description)
    assert sorted(map(str, (tuple(r) for r in got.select(*[c[0] for c in cursor.description]).collect()))) == sorted(map(str, expected))


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """(vec_id, code, error, label_error), codebooks; rows: (vec_id, vector, label) that are kept, with integer components."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    v = np.array([r[1] for r in rows], np.int64).reshape(len(rows), parts, -1)
    books = [v[:entries, i].copy() for i in range(parts)]
    for n in range(rounds + 1):
        d = [((v[:, i, None, :] - books[i][None]) ** 2).sum(2) for i in range(parts)]
        to = [x.argmin(1) for x in d]
        for i in range(parts if n < rounds else 0):
            for e in set(to[i].tolist()):
                books[i][e] = v[to[i] == e, i].sum(0) // (to[i] == e).sum()
    error = sum(x.min(1) for x in d)
    by_label = Counter()
    for r, e in zip(rows, error.tolist(), strict=True):
        by_label[r[2]] += e
    codes = ["".join(f"{to[i][j]:02x}" for i in range(parts)) for j in range(len(rows))]
    return sorted(((r[0], c, e, by_label[r[2]]) for r, c, e in zip(rows, codes, error.tolist(), strict=True)), key=str), np.array(books)


def vectors(n, dims, spread=1.0, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dims)) * spread
    return [(centres[i % 12] + rng.normal(size=dims) * 0.1).astype(np.float32).tolist() for i in range(n)]


@pytest.mark.parametrize("n,dims,block", [(3, 16, 100), (900, 16, 100), (900, 20, 250), (40, 8, 7)])
def test_codes(spark, n, dims, block):
    v = vectors(n, dims)
    rows = [(i, x, i % 4 if i % 5 else None, "clash") for i, x in enumerate(v)]
    rows += [(2, v[2], 2, "clash"), (None, v[1], 1, "clash")] + [(7, v[0], 3, "clash")] * 30
    bad = [(1, None, 1, "x"), (2, [float("nan")] * dims, 1, "x"), (3, [float("inf")] * dims, 1, "x"), (4, [None] * dims, 1, "x"), (5, [1.0] * (dims + 1), 1, "x")]
    codes, books = code_compression.compress(spark.createDataFrame(rows + bad, VEC), block=block)
    width = -(-dims // 8) * 8
    whole = [(i, [math.floor(4096 * x) for x in e] + [0] * (width - dims), label) for i, e, label, _ in rows]
    expected, expected_books = brute_codes(whole)
    got = sorted((tuple(r) for r in codes.select("vec_id", "code", "error", "label_error").collect()), key=str)
    assert got == expected and np.array_equal(books, expected_books)
    back = {r.vec_id: r.embedding for r in code_compression.decoded(codes, books, dims).filter("vec_id is not null").collect()}
    error = {r.vec_id: r.error for r in codes.collect()}
    i = max(error, key=lambda i: (i is not None and i > 7, 0))
    assert len(back[i]) == dims and abs(sum((a - b) ** 2 for a, b in zip(back[i], rows[i][1], strict=True)) - error[i] / 4096**2) < 0.01 + error[i] / 4096**2


def test_codes_of_nothing(spark):
    codes, books = code_compression.compress(spark.createDataFrame([(1, None, 1, "x")], VEC))
    assert codes.columns == ["vec_id", "label", "code", "error", "label_error"] and codes.count() == 0 and books.size == 0
    assert code_compression.digest(books) == hashlib.sha256(b"").hexdigest()


def test_extreme_components(spark):
    """Components that no integer holds stop at the limit."""
    codes, books = code_compression.compress(spark.createDataFrame([(1, [3e38] * 8, 1, "x"), (2, [-3e38] * 8, 1, "x")], VEC))
    assert {r.error for r in codes.collect()} == {0} and int(books.max()) == code_compression.MOST


def test_trees_prune_and_keep_sums():
    """Whole nodes take most parts where clusters are apart, and the sums are those of all distances."""
    rng = np.random.default_rng(1)
    entries = rng.integers(-50_000, 50_000, (16, 4))
    points = np.repeat(entries, 300, axis=0) + rng.integers(-40, 40, (4800, 4))
    for p, e in ((points, entries), (points, entries[:1]), (points, entries[[3, 3, 3, 5, 5]]), (points[:5], entries), (np.zeros((400, 4), np.int64), np.array([[1, 0, 0, 0], [0, 1, 0, 0], [-1, 0, 0, 0]]))):
        tree = code_compression.Tree(p.astype(np.int64), 16)
        again = code_compression.Tree.unpacked(*tree.packed(), 4)
        assert all(np.array_equal(a, b) for a, b in zip(tree.sums + tree.low + tree.high, again.sums + again.low + again.high, strict=True))
        sums, numbers, codes = code_compression.lloyd(again, e, code=True)
        to = ((tree.points[:, None] - e[None]) ** 2).sum(2).argmin(1)
        assert np.array_equal(codes, to) and np.array_equal(numbers, np.bincount(to, minlength=len(e)))
        assert np.array_equal(sums, np.array([tree.points[to == k].sum(0) for k in range(len(e))]))


def prose(seed, n, words=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def texts():
    base = prose(1, 120)
    out = [(1, base), (2, base.upper()), (3, base), (4, prose(2, 90)), (5, None), (6, ""), (7, "two words"), (8, "two words"), (9, "  \t "), (10, "Straße é" * 70 + prose(3, 40)), (11, "a-b_c" * 400), (12, prose(4, 30_000)), (4, prose(2, 90)), (None, base), (None, base)]
    return out + [(100 + i, prose(50 + i, 15 + i)) for i in range(20)] + [(200 + i, base) for i in range(150)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "s", 7, "clash") for i, t in texts()], DOC)


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def features(text):
    w = words(text)
    return [zlib.crc32(x.encode()) % 10_000 for x in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def test_resampling(spark, docs):
    target = [prose(1, 120), None, "benchmark text", prose(77, 60)]
    got = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"))
    s, t = (Counter(f for x in rows for f in features(x)) for rows in ([x for _, x in texts()], target))
    whole, wanted = sum(s.values()) + 10_000, sum(t.values()) + 10_000
    made = []
    for i, x in texts():
        f = features(x)
        gain = [math.floor(1000 * math.log((t[b] + 1) * whole / ((s[b] + 1) * wanted))) for b in f]
        weight = sum(gain) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        made.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(words(x))))
    may = sorted((m for m in made if m[4] >= 20), key=lambda m: (-m[3], m[0] is None, m[0] or 0))
    drawn = Counter((*m[:4], k) for k, m in enumerate(may[: 25 * len(may) // 100], 1))
    rest = Counter((*m[:4], None) for m in made) - Counter((*k[:4], None) for k in drawn)
    assert Counter(tuple(r) for r in got.select("doc_id", "n_features", "weight", "score", "rank").collect()) == drawn + rest
    assert got.columns == ["doc_id", "source", "size", "n_words", "n_features", "weight", "score", "rank"]


def test_resampling_of_nothing(spark, docs):
    none = docs.filter("false")
    assert resampling.resample(none, docs).count() == 0
    assert resampling.resample(docs, none).filter("rank is not null").count() > 0


def check_shards(rows, texts_of, shards):
    """rows: (doc_id, size, crc, shard, slot).  The laws: all rows, gapless slots, near equal bytes, groups that fit stay whole."""
    assert Counter(r[:3] for r in rows) == Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in texts_of)
    by = defaultdict(list)
    for r in rows:
        by[r[3]].append(r)
    assert all(0 <= s < shards for s in by) and all(sorted(r[4] for r in x) == list(range(len(x))) for x in by.values())
    share = sum(r[1] for r in rows) / shards
    groups = defaultdict(list)
    for r in rows:
        groups[r[1:3]].append(r)
    for members in groups.values():
        if sum(r[1] for r in members) <= share:
            assert len({r[3] for r in members}) == 1
    return {s: sum(r[1] for r in by.get(s, [])) for s in range(shards)}, share


COLUMNS = ["doc_id", "size", "text_crc32", "shard", "slot"]


def test_shards(spark):
    """A group with a third of all bytes is spread, small groups stay together, and bytes are nearly equal."""
    rows = [(i, prose(i, 20 + i % 50)) for i in range(3000)] + [(5000 + i, prose(9000 + i // 6, 40)) for i in range(600)] + [(7000 + i, prose(1, 60)) for i in range(1500)] + [(None, "x"), (None, None), (6, ""), (6, ""), (6, "")]
    df = spark.createDataFrame([(i, t, "s", 7, "clash") for i, t in rows], DOC)
    out = sharding.shard(df, 10)
    assert out.columns == ["doc_id", "source", "score", "size", "text_crc32", "shard", "slot"]
    got = [tuple(r) for r in out.select(*COLUMNS).collect()]
    loads, share = check_shards(got, rows, 10)
    assert max(loads.values()) - min(loads.values()) < share / 32
    assert len({r[3] for r in got if r[2] == zlib.crc32(prose(1, 60).encode())}) > 3
    assert sorted(got, key=str) == sorted((tuple(r) for r in sharding.shard(df, 10).select(*COLUMNS).collect()), key=str)


def test_few_and_long_rows_in_shards(spark, docs):
    got = [tuple(r) for r in sharding.shard(docs, 8).select(*COLUMNS).collect()]
    loads, share = check_shards(got, texts(), 8)
    assert max(loads.values()) == len(prose(4, 30_000)) + 16  # that text alone is more than a share
    assert sharding.shard(docs.filter("false"), 8).count() == 0
    one = sharding.shard(docs.limit(1), 8).collect()
    assert [(r.shard, r.slot) for r in one] == [(0, 0)]


def test_query_holds_the_laws(spark):
    out = registry.queries()["op13_sharding"](spark, TEST_DATA)
    got = [tuple(r) for r in out.select(*COLUMNS).collect()]
    loads, share = check_shards(got, [tuple(r) for r in common.documents(spark, TEST_DATA).select("doc_id", "text").collect()], 40)
    longest = max(r[1] for r in got)
    assert max(loads.values()) <= max(longest, 1.1 * share) and out.filter("law <> 'bytes' or grown_shard is not null").count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "ExistingRDD" not in plan


def test_shards_are_written(spark, docs, tmp_path):
    sharding.write(docs, str(tmp_path / "out"), rows_per_file=25, shards=4)
    back = spark.read.parquet(str(tmp_path / "out")).withColumn("file", F.input_file_name())
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(texts())
    assert back.groupBy("file").count().agg(F.max("count")).first()[0] <= 25
    files = back.groupBy("file").agg(F.countDistinct("shard").alias("s"), (F.max("slot") - F.min("slot") + 1 - F.count("*")).alias("gap"))
    assert files.filter("s <> 1 or gap <> 0").count() == 0
