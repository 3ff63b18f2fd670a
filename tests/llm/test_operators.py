"""Operators on small fixtures: brute force, round trips, nulls, empties, ties, repeated rows, clashing columns."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import TEST_DATA, same
from peakloom.llm import bpe, common, embedding_dedup, mixing, neighbours, ngram_join, partenum, pieces, registry, suffix_dedup, token_files, toxicity, url_filter, warc

P = pytest.importorskip("public_tokenizers")
DOC = "doc_id long, text string, source string, size long, digest string"


def prose(seed, n, words=300):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}" for _ in range(n))


def texts():
    base = prose(1, 120)
    near = base.replace("w7 ", "w7x ", 1)
    return [(1, base), (2, near), (3, base), (4, prose(2, 90)), (5, None), (6, ""), (7, "two words"), (8, "two words"), (9, "  \t "), (10, "é" * 70 + prose(3, 40) + base[50:400]), (11, "a" * 400), (12, prose(4, 3000)), (4, prose(2, 90)), (None, base)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "s", 7, "clash") for i, t in texts()], DOC)


@pytest.mark.parametrize("name", ["op2_mixing", "op8_warc", "op9_embedding_dedup", "embedding_near_copies", "op10_url_filter"])
def test_matches_duckdb(spark, duck, name):
    assert same(registry.queries()[name](spark, TEST_DATA), duck.execute(registry.oracle_sql()[name]))


def brute_repeats(rows, length):
    seen, out = set(), []
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.sha256((r[1] or "").encode()).digest()))
    for i, t in order:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            s = b[p : p + length]
            if s in seen:
                gone[p : p + length] = True
            seen.add(s)
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("length", [20, 100])
def test_repeats(docs, length):
    got = sorted((tuple(r) for r in suffix_dedup.dedup(docs, length).collect()), key=str)
    assert got == brute_repeats(texts(), length)


def test_repeats_in_rounds_and_empty(spark, docs):
    assert sorted((tuple(r) for r in suffix_dedup.dedup(docs, 50, share=0.3).collect()), key=str) == brute_repeats(texts(), 50)
    assert suffix_dedup.dedup(docs.limit(0), 50).count() == 0
    kept = {r.doc_id: r for r in suffix_dedup.dedup(docs.filter("doc_id in (1, 2)"), 50, with_text=True).collect()}
    assert kept[1].spans == [] and kept[1].kept_text == texts()[0][1] and kept[2].spans


@pytest.mark.parametrize("bits", [1, 8])
def test_repeats_with_colliding_fingerprints(spark, docs, bits, monkeypatch):
    """First fingerprints of a few bits, so that their runs mix different strings: bytes decide."""
    monkeypatch.setattr(suffix_dedup, "ASKED", 2)
    got = sorted((tuple(r) for r in suffix_dedup.dedup(docs, 20, bits=bits).collect()), key=str)
    assert got == brute_repeats(texts(), 20)
    hashed = sorted((tuple(r) for r in suffix_dedup.dedup(docs, 20, bits=bits, verify=False).collect()), key=str)
    assert hashed != got  # the bits do mix strings here


@pytest.mark.parametrize("v", [7, 31, 48])
def test_difference_cover(v):
    d = suffix_dedup.difference_cover(v)
    assert {(a - b) % v for a in d for b in d} == set(range(v))


def test_mixing_targets_and_whole_epochs(spark):
    rng = random.Random(5)
    rows = [(i, prose(i, rng.randrange(1, 40)), rng.choice(["a", "b", "c", None])) for i in range(400)] + [(1000, None, "d"), (1001, "", None), (1002, "x y", "a"), (1002, "x y", "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"size": F.lit("clash"), "weight": F.lit(1), "_key": F.lit(2), "n_docs": F.lit(3)})
    out = mixing.mix(df, [5, 2, 1], 1.5, 2).collect()
    assert len(out) == len(rows)
    total = sum(r.size for r in out)
    by = {}
    for r in out:
        assert r.taken % max(1, r.size) == 0 and r.taken <= 2 * r.size
        by.setdefault(r.source, []).append(r)
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * total)
    for v in by.values():
        assert abs(sum(r.taken for r in v) - v[0].target) <= max(r.size for r in v)
        assert v[0].target <= 2 * v[0].source_size
    again = mixing.mix(df.repartition(3), [5, 2, 1], 1.5, 2)
    assert sorted(map(tuple, again.select("doc_id", "taken").collect())) == sorted((r.doc_id, r.taken) for r in out)
    assert mixing.epochs(again).groupBy().agg(F.sum("size")).first()[0] == sum(r.taken for r in out)
    assert mixing.mix(df.limit(0), [1]).count() == 0


def test_mixing_weights_change_the_order(spark):
    rows = [(i, "a b c d", "s") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("q", F.when(F.col("doc_id") < 150, 9.0).otherwise(1.0))
    out = mixing.mix(df, [1], 0.4, 2, quality=F.col("q"))
    assert out.filter("taken > 0 and doc_id < 150").count() > 2 * out.filter("taken > 0 and doc_id >= 150").count()


def test_unweighted_mixing_matches_duckdb(spark, duck):
    assert same(registry.queries()["mixing_unweighted"](spark, TEST_DATA), duck.execute(registry.oracle_sql()["mixing_unweighted"]))


def test_pipeline_takes_better_texts_more_often(spark):
    import corpus_pipeline

    good, bad = "the cat sat on a mat " * 3, "BUY!! NOW$$ 100%% OFF&& " * 3
    docs = spark.createDataFrame([(i, good if i % 2 else bad, "b") for i in range(400)] + [(i, good, "a") for i in range(400, 800)], "doc_id long, text string, source string")
    taken = {r.doc_id for r in corpus_pipeline.sources_are_mixed(spark, docs, TEST_DATA).collect()}
    left = set(range(400)) - taken
    assert left and all(i % 2 == 0 for i in left)


def test_mixing_ranges_are_even_for_any_weight(spark):
    for w in ("1e-6", "-1.0", "null", "1.0"):
        docs = spark.range(4000).selectExpr("id AS _id", "'s' AS _source", f"coalesce(cast({w} as double) <= 0, true) AS _last", f"-ln((id + 0.5) / 4000) / abs(coalesce(cast({w} as double), 1.0)) AS _key", "1L AS size", "id AS _row")
        most = mixing.in_ranges(docs, 16).groupBy("_range").count().agg(F.max("count")).first()[0]
        assert most < 4000 / 16 * 3
    rows = [(i, "a b c", "s") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = [r.doc_id for r in mixing.mix(df, [1], 0.25, 2, quality=F.lit(0.0)).filter("taken > 0").collect()]
    assert len(taken) == 50 and max(taken) > 100  # not the smallest ids


def recall_at_5(found, vectors_):
    ids = np.array(sorted(vectors_))
    unit = np.stack([np.array(vectors_[i], float) for i in ids.tolist()])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    hits = total = 0
    for q in sorted({r.query_id for r in found}):
        near = unit @ unit[np.searchsorted(ids, q)]
        near[np.searchsorted(ids, q)] = -2
        best = np.sort(near)[-5:]
        mine = [r.score for r in found if r.query_id == q]
        hits, total = hits + sum(s >= best[0] - 1e-12 for s in mine), total + 5
    return hits / total


def test_registered_neighbours_reach_the_recall(spark):
    """The registered query on the given table against brute force."""
    rows = common.documents(spark, TEST_DATA, "embeddings").collect()
    usable = {r.vec_id: r.embedding for r in rows if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding) and any(r.embedding)}
    out = registry.queries()["op3_neighbours"](spark, TEST_DATA).collect()
    assert {r.query_id for r in out} == {i for i in usable if i % 50 == 0}
    assert recall_at_5(out, usable) >= 0.9 and all(r.sample_recall >= 0.9 for r in out)


def test_large_leaves_are_split_again(spark):
    """A small sample leaves large leaves, which all rows then split; repeated ids are candidates each."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 12))
    m = centres[rng.integers(0, 30, 3000)] + 0.2 * rng.normal(size=(3000, 12))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(m)], "vec_id long, embedding array<double>")
    out = neighbours.search(df, F.col("vec_id") % 50 == 0, sample=40, leaf_rows=60).collect()
    assert len(out) == 300 and recall_at_5(out, dict(enumerate(m.tolist()))) >= 0.6
    twice = df.filter("vec_id < 4").unionByName(df.filter("vec_id = 1"))
    assert sorted(r.vec_id for r in neighbours.search(twice, F.col("vec_id") == 0).collect()) == [1, 1, 2, 3]


def test_neighbours_against_brute_force(spark):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((600, 16))
    v[100:110] = v[50]
    rows = [(i, x.tolist(), 9) for i, x in enumerate(v)] + [(700, None, 1), (701, [0.0] * 16, 1), (702, [float("nan")] * 16, 1), (703, [1.0], 1), (750, [None] * 16, 1), (None, v[3].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int")
    got = neighbours.search(df, F.col("vec_id") % 50 == 0, k=5, leaf_rows=40, chunk=100, groups=4).collect()
    n = v / np.linalg.norm(v, axis=1, keepdims=True)
    s, hits = n @ n.T, 0
    for q in range(0, 600, 50):
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        assert all(abs(r.score - s[q, r.vec_id]) < 1e-12 for r in mine)
        want = [i for i in np.lexsort((np.arange(600), -np.round(s[q], 12))) if i != q][:5]
        hits += len({r.vec_id for r in mine} & set(want))
        if q == 50:
            assert [r.vec_id for r in mine] == want == [100, 101, 102, 103, 104]
    assert hits >= 0.9 * 5 * 12 and {r.query_id for r in got} == set(range(0, 600, 50))
    assert neighbours.search(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert neighbours.search(df.filter("vec_id in (0, 1, 2)"), F.col("vec_id") == 0).count() == 2


def brute_components(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, []).append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set()))
    ids = [i for i in sets if i is not None]
    comp = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a in ids:
            for b in ids:
                if comp[a] != comp[b] and any(x and y and 100 * len(x & y) >= percent * len(x | y) for x in sets[a] for y in sets[b]):
                    low = min(comp[a], comp[b])
                    old = {comp[a], comp[b]}
                    comp = {k: low if v in old else v for k, v in comp.items()}
                    changed = True
    return comp, {i: [len(x) for x in s] for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(spark, width, percent):
    rng = random.Random(width)
    rows = list(texts())
    for i in range(60):  # families at all distances, sizes from tiny up
        base = prose(100 + i % 9, 4 + 13 * (i % 9)).split()
        for _ in range(rng.randrange(4)):
            base[rng.randrange(len(base))] = f"edit{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(base).upper() if i % 5 == 0 else " ".join(base)))
    out = ngram_join.join(spark.createDataFrame([(i, t, 1, 2) for i, t in rows], "doc_id long, text string, n long, component_id long"), width, percent).collect()
    comp, sizes = brute_components(rows, width, percent)
    assert len(out) == len(rows)
    for r in out:
        assert r.component_id == (None if r.doc_id is None else comp[r.doc_id]) and r.n_shingles in sizes[r.doc_id]


def test_ngram_join_crowd(spark):
    """Near copies that share signatures but don't link, one chain of links among them."""
    base = prose(8, 200, 10**6).split()
    rows = []
    for i in range(40):
        w = list(base)
        for k in range(14):
            w[(i * 31 + k * 13) % 200] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    rows.append((90, rows[17][1] + " tail"))
    out = {r.doc_id: r.component_id for r in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 90).collect()}
    assert out == brute_components(rows, 3, 90)[0] and out[90] == 17
    assert ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").limit(0), 3, 90).count() == 0


def brute_links(rows, width, percent):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())))
    return sorted((i, sum(bool(x and y and k != j and b is not None and 100 * len(x & y) >= percent * len(x | y)) for j, (b, y) in enumerate(sets))) for k, (i, x) in enumerate(sets) if i is not None)


@pytest.mark.parametrize(("width", "percent", "lengths"), [(1, 80, (10, 100)), (1, 50, (10, 40)), (1, 90, (10, 100)), (5, 80, (300, 900))])
def test_ngram_join_counts_every_link(spark, monkeypatch, width, percent, lengths):
    """Families of copies with few and many changes, in small cells, so that clusters are several blocks."""
    monkeypatch.setattr(ngram_join, "CELL", 700)
    monkeypatch.setattr(ngram_join, "CROWD", 5)
    rng = random.Random(percent)
    rows, at = [], 0
    for f in range(12):
        base = [f"f{f}w{k}" for k in range(rng.randrange(*lengths))]
        for _ in range(rng.randrange(1, 14)):
            w = list(base)
            for _ in range(rng.randrange(0, max(2, len(base) * (100 - percent) // 70 // width))):
                w[rng.randrange(len(w))] = f"n{rng.random()}"
            rows.append((at, " ".join(w)))
            at += 1
    rows += [(None, rows[0][1]), (500, rows[0][1]), (501, rows[0][1].upper()), (502, ""), (503, None)]
    out = ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), width, percent).collect()
    assert sorted((r.doc_id, r.n_links) for r in out if r.doc_id is not None) == brute_links(rows, width, percent)
    comp = brute_components(rows, width, percent)[0]
    assert {r.doc_id: r.component_id for r in out if r.doc_id is not None} == comp


@pytest.mark.parametrize("percent", [50, 80, 90])
def test_partenum_bounds(percent):
    """Parts, signatures and slots stay in proportion to a set, and linked sets share a signature."""
    bands = partenum.Bands(percent)
    bands.of(np.array([30_000]))
    for low, before in zip(bands.all[1:], bands.all, strict=False):
        assert low.signatures() <= max(1.5 * before.low + 10, low.k + 1) and low.groups * low.parts <= max(3 * before.low + 20, low.k + 1)
    rng = np.random.default_rng(percent)
    for n in [*range(10, 101, 3), 400, 2000]:
        x = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        most = n * (100 - percent) // 100
        y = np.concatenate([x[most // 2 :], rng.integers(0, 1 << 63, most // 2, dtype=np.uint64)])
        shared = len(np.intersect1d(x, y))
        if 100 * shared >= percent * (len(x) + len(y) - shared):
            d, g = partenum.signatures(np.concatenate([x, y]), np.array([len(x), len(y)]), bands)
            assert len(x) == len(y) == shared or set(g[d == 0].tolist()) & set(g[d == 1].tolist())


def test_bpe_like_tiktoken(spark, docs):
    import tiktoken

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ref = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(path), special_tokens={})
    odd = ["", " ", "  a  b ", "a　b \n c", "x" * 3000, "ab" * 500 + "!!!  \t z", "don't  we'll 123  45", "\x1c a \x85b", " lead", "trail ", "a\n\nb", "naïve übergroß ñandú 你好 мир 🙂🙂", "<|endoftext|>"]
    e, cache = bpe.encoder(path, P.PATTERN)
    cache.most = 20
    for _ in range(3):
        assert [np.frombuffer(x, np.int32).tolist() for x in cache.ids(odd)] == [ref.encode_ordinary(t) for t in odd]
    assert e._long(b"ab" * 300) == e.words_to_ids([b"ab" * 60])[0] * 0 + np.array(ref.encode_ordinary("ab" * 300), np.int32).tobytes()
    coded = bpe.encode(docs, path, P.PATTERN)
    back = {(r.doc_id, bytes(r.bytes)) for r in bpe.decode(coded, path, P.PATTERN).collect()}
    assert back == {(i, (t or "").encode()) for i, t in texts()}
    assert bpe.digests(docs.limit(0), path, P.PATTERN).count() == 0


def test_token_files(spark, docs, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    m = token_files.write(docs, f"file://{tmp_path}", P.path("byte_bpe_50k.json"), 2, roll_ids=500)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in token_files.read(m).collect())
    start = 0
    for i, x in sorted(((i, x or "") for i, x in texts()), key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode())):
        ids = [*t.encode(x, add_special_tokens=False).ids, 2]
        assert (start, i, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) in got
        start += len(ids)
    assert len(got) == len(texts()) and m.count() > 2
    assert token_files.write(docs.limit(0), f"file://{tmp_path}/e", P.path("byte_bpe_50k.json"), 2).count() == 0


def test_special_tokens_in_texts_are_encoded_as_the_library_does():
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    some = [x.content for x in t.get_added_tokens_decoder().values() if x.special]
    assert some
    odd = [f"one two{s}three four" for s in some] + [f"one two {s} three four" for s in some] + ["one two three four"]
    got = [np.frombuffer(x, "<u4").tolist() for x in token_files.tokenizer_cache(path).ids(odd)]
    assert got == [t.encode(x, add_special_tokens=False).ids for x in odd]


def test_addressable_codes():
    ids = np.random.default_rng(1).integers(0, 2**32, 5000, dtype=np.uint32) >> np.random.default_rng(2).integers(0, 32, 5000).astype(np.uint32)
    f = token_files.TokenFile(token_files.to_bytes([5, None], np.array([1000, 4000]), ids))
    assert (f.all_ids() == ids).all() and [f[i] for i in range(0, 5000, 7)] == ids[::7].tolist()
    assert f.document(0) == ids[:1000].tolist() and f.doc_ids() == [5, None]
    assert len(token_files.TokenFile(token_files.to_bytes([], np.zeros(0), np.zeros(0, np.uint32))).all_ids()) == 0


def test_toxicity_held_out(spark):
    rng = random.Random(3)
    rows, labels = [], []
    for i in range(1500):
        bad = i % 6 == 0
        w = prose(i, rng.randrange(5, 60)).split()
        if bad:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(["Stupid", "idiot,", "loser!", "moron"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (5000, None), (None, "idiot moron loser")], "doc_id long, text string").withColumn("score", F.lit("clash"))
    lab = spark.createDataFrame([*labels, (None, 1), (3, None)], "doc_id long, toxic int").filter(~toxicity.held_out())
    w = toxicity.train(docs, lab, common.Scratch(spark), sample_per_class=500)
    out = {r.doc_id: r.score for r in toxicity.score(docs, w, ("doc_id", "score")).select("row.doc_id", "score").collect()}
    test = [(out[i], y) for i, y in labels if zlib.crc32(str(i).encode()) % 3 == 1]
    assert all(s < 0.7 for s, y in test if not y)
    assert sum(s >= 0.7 for s, y in test if y) >= 0.9 * sum(y for _, y in test)
    assert out[None] > 0.7 and 0 <= out[5000] < 0.7
    none = toxicity.train(docs, lab.limit(0), common.Scratch(spark))
    assert {r.score for r in toxicity.score(docs, none).collect()} == {0.0}


def test_warc_round_trip(spark, tmp_path):
    big = "<p>" + "x" * 2000
    rows = [(3, "http://a/1", big), (1, "http://a/2", big), (2, None, "small"), (9, "http://a/ü \n", "small"), (4, "http://a/4", None), (5, "http://a/5", ""), (7, "http://a/7", big), (7, "http://a/7", big), (None, "http://a/n", big)]
    pages = spark.createDataFrame([(*r, "clash", 1) for r in rows], "page_id long, url string, html string, digest string, kind int")
    m = warc.write(pages, f"file://{tmp_path}", roll_bytes=900)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in warc.read(m).collect()), key=str)
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    want = sorted(((i, len((t or "").encode()), sha(t), *(("revisit", 7) if t == big and i != 7 else ("response", None))) for i, _, t in rows), key=str)
    assert got == want and m.count() >= 2
    again = warc.write(pages.repartition(2), f"file://{tmp_path}/again", roll_bytes=900)
    read = lambda x: sorted(common.local_path(p.path)[0].open_input_stream(common.local_path(p.path)[1], compression=None).read() for p in x.collect())
    assert read(m) == read(again)
    assert warc.write(pages.limit(0), f"file://{tmp_path}/e").count() == 0


def test_embedding_links(spark):
    rng = np.random.default_rng(4)
    v = rng.standard_normal((60, 24))
    rows = [(i, x.tolist(), i % 2) for i, x in enumerate(v)]
    rows += [(100 + i, (v[0] + 0.03 * rng.standard_normal(24)).tolist(), 0) for i in range(30)]
    rows += [(200 + i, (v[1] * (i + 1)).tolist(), 1) for i in range(4)] + [(300 + i, v[1].tolist(), 1) for i in range(80)] + [(400, v[1].tolist(), 0)]
    rows += [(500, None, 1), (501, [0.0] * 24, 1), (502, [float("inf")] * 24, 1), (503, [None] * 24, 1), (504, v[0].tolist(), None), (505, [1.0], 1)]
    out = {r.vec_id: r for r in embedding_dedup.links(spark.createDataFrame([(*r, 5) for r in rows], "vec_id long, embedding array<double>, label int, copies int"), 0.93, cell=16).collect()}
    m, lab, ids = np.array([r[1] for r in rows[:-6]]), [r[2] for r in rows[:-6]], [r[0] for r in rows[:-6]]
    n = m / np.linalg.norm(m, axis=1, keepdims=True)
    link = (n @ n.T >= 0.93) & (np.array(lab)[:, None] == np.array(lab)[None, :])
    np.fill_diagonal(link, False)
    reach = link | np.eye(len(ids), dtype=bool)
    for _ in range(6):
        reach = reach @ reach
    for i, k in enumerate(ids):
        assert out[k].n_links == link[i].sum() and out[k].component_id == min(np.array(ids)[reach[i]]) and out[k].kept == (out[k].component_id == k)
    for k in range(500, 506):
        assert (out[k].n_links, out[k].component_id, out[k].kept) == (0, k, True)


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(100, 180)] + [(5, i) for i in range(200, 300)] + [(7, 7)]
    random.Random(1).shuffle(edges)
    got = {r.id: r.component for r in common.components(spark.createDataFrame(edges, "a long, b long"), common.Scratch(spark)).collect()}
    assert got == {**{i: 100 for i in range(100, 181)}, **{i: 5 for i in range(200, 300)}, 5: 5, 7: 7}
    assert common.components(spark.createDataFrame([], "a long, b long"), common.Scratch(spark)).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://Net/", "http://a.NET/x", "http://xnet/", "http://example.net/en/1", "http://a.example.net/en", "https://b.example.com/de/?q", "http://example.com/fr/de/", "http://x.org/fr/", "http://org", "http://a.b.c.net#f", "ftp://example.net/en/?x#y", "http://net?/", "http:///net/"]
    df = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(df, url_filter.RULES).collect()}

    def brute(u):
        rest = (u or "").partition("://")[2]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        fits = [(len(h + p), h + p, v) for v, h, p in url_filter.RULES if (host.lower() == h or host.lower().endswith("." + h)) and path.startswith(p)]
        return (max(fits)[1], max(fits)[2]) if fits else (None, "allow")

    assert got == {i: brute(u) for i, u in enumerate(urls)}
    with pytest.raises(ValueError, match="two verdicts"):
        url_filter.judge(df, [*url_filter.RULES, ("allow", "net", "/")])
    assert url_filter.judge(df.limit(0), url_filter.RULES).count() == 0 and url_filter.judge(df, []).count() == len(urls) * 2


def test_a_long_list_takes_several_pieces(spark, monkeypatch):
    monkeypatch.setattr(url_filter, "PIECE", 4)
    df = spark.range(3000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://h"), "id", F.lit(".org/x")).alias("url"))
    rules = [("block" if i % 3 else "allow", f"h{i}.org", "/") for i in range(0, 3000, 7)]
    got = {r.page_id: r.rule for r in url_filter.judge(df, rules).collect()}
    assert got == {i: f"h{i}.org/" if i % 7 == 0 else None for i in range(3000)}


def test_lists_beyond_the_limit_are_sliced(spark):
    """Rules as a table; levels of 64 bytes at most, so the keys take several cascades, and the result is the same."""
    df = spark.range(4000).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a.h"), "id", F.lit(".org/x")).alias("url"))
    rules = spark.range(0, 4000, 5).select(F.when(F.col("id") % 3 == 0, "block").otherwise("allow").alias("verdict"), F.concat(F.lit("h"), "id", F.lit(".org")).alias("host"), F.when(F.col("id") % 2 == 0, "/").otherwise("/x").alias("path"))
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(df, rules, default="none", max_filter_bytes=64).collect()}
    assert got == {i: (f"h{i}.org/{'x' * (i % 2)}", "allow" if i % 3 else "block") if i % 5 == 0 else (None, "none") for i in range(4000)}


def test_cascade_is_exact(spark):
    listed = spark.range(0, 300).select(F.concat(F.lit("k"), "id").alias("key"))
    universe = spark.range(0, 6000).select(F.concat(F.lit("k"), "id").alias("key"))
    c = url_filter.Cascade.build(listed, universe)
    assert len(c.levels) > 1 and universe.filter(c.has(F.col("key"))).count() == 300
    assert listed.filter(~c.has(F.col("key"))).count() == 0


def test_parts_are_cut_where_the_pattern_never_joins():
    assert pieces.regroup(np.array([2, 3, 7]), np.array([3, 4])).tolist() == [0, 2, 3]
    assert pieces.plain("a") and not pieces.plain("") and not pieces.plain("\na")
