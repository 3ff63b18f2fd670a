"""N-gram Jaccard join by PartEnum signatures.

A document's set holds its distinct w-word shingles (with fewer words, the whole sequence).  Sets are joined when 100 *
intersection >= percent * union, exactly; documents get the number of their links and the components that these form.

 1. Equal sets, however many, are one class from the start.
 2. A set of which more than 100 - percent % of the shingles are found in no other set can't link; such sets are left out.
    Shingles of a part of the hash domain are looked at, so that sets go of which more than two fifths is their own.
 3. The sets that stay sign (see partenum); sets with a common signature form a group.  Sharing one proves nothing.
 4. Sketches (how many shingles fall into each of PARTS parts of the domain) bound the difference of two sets from below.  Each
    set is held against the smallest member of each of its groups, then the members of a group that are still apart against each
    other.  Pairs that the bound lets pass put their sets into one cluster, so every linked pair lies inside a cluster.
 5. A cluster is cut into cells of bounded size, and each pair of cells is one block: a task counts all its intersections as
    a product of incidence matrices and gives each set's number of links and a spanning forest of the links.

No pairs of a group or cluster are emitted: what leaves a task is a pair a member and centre, a forest, or a count a set.

Scale: the look for lonely shingles sends 6 bytes for each of them looked at.  Signatures travel as arrays, 6 bytes each, one
row for each block of documents and bucket; buckets hold about a million entries at every size.  A group or cluster of any
size is cut into blocks, and a block's rows are dealt to tasks by the pair of cells; a cluster of m sets sends each
set once for each of its cells.  Work inside a cluster is quadratic in its different sets, as counting their links is.

Cases: a null or empty text has size 0 and links with nothing, its component is its own id.  A null id takes no part: its
component is null, its links are 0.  Rows that repeat an id are one vertex for the components; each has the
links of its own text.  An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common, pieces
from .common import U64, mix
from .partenum import GOLD, Bands, ranges, signatures

CELL, CROWD, PARTS, SEVERAL, SALTS = 1_000_000, 4096, 256, 0xFFFF, 8


def shingles(texts: list[bytes], width: int, hashes: common.WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """(document number, shingle hash) of the distinct shingles, sorted by both.  At most 65,536 texts."""
    words = [hashes.array(t.translate(common.LOWER).split()) for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    h = np.concatenate([np.zeros(0, np.uint64), *words])
    n = len(h)
    s = np.zeros(max(0, n - width + 1), np.uint64)
    for i in range(width):
        s = s * GOLD + h[i : i + len(s)]
    doc = np.repeat(np.arange(len(texts)), sizes)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)  # words from here to the document's end
    fits = left[: len(s)] >= width
    short = np.flatnonzero((sizes > 0) & (sizes < width))
    whole = np.array([int(np.bitwise_xor.reduce(mix(words[d] + np.arange(1, len(words[d]) + 1, dtype=np.uint64) * GOLD))) ^ len(words[d]) for d in short], np.uint64)
    s, d = np.concatenate([mix(s[fits]), whole]), np.concatenate([doc[: len(fits)][fits], short]).astype(np.uint16)
    order = np.argsort(s)
    order = order[np.argsort(d[order], kind="stable")]
    s, d = s[order], d[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    return d[new].astype(np.int64), s[new]


def digests(s: np.ndarray, sizes: np.ndarray) -> list[bytes | None]:
    from xxhash import xxh3_128_digest

    return [xxh3_128_digest(s[e - n : e].tobytes()) if n else None for e, n in zip(np.cumsum(sizes).tolist(), sizes.tolist(), strict=True)]


def small_ints(x: np.ndarray) -> bytes:
    return zlib.compress(np.diff(x, prepend=np.int64(0)).tobytes(), 1)


def from_small_ints(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.int64))


def stretches(key: np.ndarray) -> list[tuple[int, int]]:
    """(from, to) of the runs of equal keys."""
    cuts = np.flatnonzero(np.diff(key)) + 1
    return list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(key)], strict=True)) if len(key) else []


def scan(docs: DataFrame, width: int, share: float, buckets: int, id_column: str, text: str, block: int = 8 << 20) -> DataFrame:
    """Rows of three kinds: a document's (doc_id, n, digest); a block's ids (block, ids); its shingles of a bucket (bucket, block,
    marks, places), of the part `share` of the domain: places are those in ids, or SEVERAL for a shingle of several sets of the block."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        schema = pa.schema([("bucket", pa.int32()), ("block", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int64()), ("digest", pa.binary()), ("ids", pa.binary()), ("marks", pa.binary()), ("places", pa.binary())])

        def rows(**columns) -> pa.RecordBatch:
            n = max(map(len, columns.values()))
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in schema], schema=schema)

        hashes, limit = common.WordHashes(), U64(min(2**64 - 1, int(share * 2.0**64)))
        number, bytes_, ids, marks = TaskContext.get().partitionId() << 32, 0, [], []
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> Iterator:
            nonlocal number, bytes_, ids, marks, held
            first: dict = {}
            for k, (i, x) in enumerate(zip(ids, marks, strict=True)):
                if i is not None and x is not None and (x not in first or i < ids[first[x]]):
                    first[x] = k
            keep = np.zeros(len(ids) + 1, bool)
            keep[list(first.values())] = True
            d, s = np.concatenate([np.zeros(0, np.int64), *[a for a, _ in held]]), np.concatenate([np.zeros(0, np.uint64), *[b for _, b in held]])
            d, s = d[keep[d]], s[keep[d]]
            order = np.argsort(s, kind="stable")
            d, s = d[order], s[order]
            new = np.ones(len(s), bool)
            new[1:] = s[1:] != s[:-1]
            alone = new.copy()
            alone[:-1] &= new[1:]
            s, place = s[new], np.where(alone, d, SEVERAL)[new].astype(np.uint16)
            bucket = (mix(s) % U64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            s, place, bucket = s[order].astype(np.uint32), place[order], bucket[order]
            cuts = stretches(bucket)
            if cuts:
                yield rows(block=[number], ids=[small_ints(np.array([i or 0 for i in ids], np.int64))])
                yield rows(bucket=[int(bucket[a]) for a, _ in cuts], block=[number] * len(cuts), marks=[s[a:z].tobytes() for a, z in cuts], places=[place[a:z].tobytes() for a, z in cuts])
            number, bytes_, ids, marks, held = number + 1, 0, [], [], []

        for whole in batches:
            for b in pieces.by_bytes(whole, "_text", 2 << 20):
                for part in common.batches(iter([b]), 8192):
                    texts, own = part.column("_text").to_pylist(), part.column("_id").to_pylist()
                    doc, s = shingles(texts, width, hashes)
                    sizes = np.bincount(doc, minlength=len(own))
                    found = digests(s, sizes)
                    yield rows(doc_id=own, n=sizes, digest=found)
                    seen = mix(s ^ GOLD) <= limit
                    held.append((doc[seen] + len(ids), s[seen]))
                    ids, marks, bytes_ = ids + own, marks + found, bytes_ + sum(map(len, texts))
                    if bytes_ >= block or len(ids) > 50_000:
                        yield from flush()
        yield from flush()

    rows = docs.select(F.col(id_column).cast("long").alias("_id"), common.text_bytes(text).alias("_text"))
    return rows.mapInArrow(run, "bucket int, block long, doc_id long, n long, digest binary, ids binary, marks binary, places binary")


def lonely(table):
    """(block, places) of a bucket's shingles that no other set holds."""
    import pyarrow as pa

    marks = [np.frombuffer(m, np.uint32) for m in table.column("marks").to_pylist()]
    place = np.concatenate([np.frombuffer(p, np.uint16) for p in table.column("places").to_pylist()])
    mark = np.concatenate(marks)
    order = np.argsort(mark, kind="stable")
    new = np.ones(len(mark), bool)
    new[1:] = mark[order[1:]] != mark[order[:-1]]
    new[:-1] &= new[1:]
    alone = np.zeros(len(mark), bool)
    alone[order[new]] = True
    alone &= place != SEVERAL
    at, out = 0, []
    for m in marks:
        out.append(place[at : at + len(m)][alone[at : at + len(m)]].tobytes())
        at += len(m)
    return pa.table({"block": table.column("block"), "places": pa.array(out, pa.binary())})


def counted(table):
    """(doc_id, lonely) of a block from its ids and its lonely shingles."""
    import pyarrow as pa

    ids = np.concatenate([from_small_ints(i) for i in table.column("ids").to_pylist() if i is not None])
    n = np.zeros(len(ids), np.int64)
    for p in table.column("places").to_pylist():
        if p is not None:
            n += np.bincount(np.frombuffer(p, np.uint16), minlength=len(ids))
    return pa.table({"doc_id": pa.array(ids, pa.int64()), "lonely": pa.array(n, pa.int64())})


def sets_of(docs: DataFrame, wanted: DataFrame, width: int, id_column: str, text: str) -> DataFrame:
    """(id, size, weight, set, counts) of the classes of `wanted` (id, rep, digest, weight): shingle hashes and the sketch."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        hashes = common.WordHashes()
        for whole in batches:
            for b in pieces.by_bytes(whole, "_text", 2 << 20):
                doc, s = shingles(b.column("_text").to_pylist(), width, hashes)
                sizes = np.bincount(doc, minlength=b.num_rows)
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                place = doc * PARTS + (mix(s ^ GOLD) % U64(PARTS)).astype(np.int64)
                counts = np.minimum(np.bincount(place, minlength=b.num_rows * PARTS), 255).astype(np.uint8).reshape(-1, PARTS)
                columns = [b.column("id"), pa.array(sizes, pa.int64()), b.column("weight"), pa.ListArray.from_arrays(pa.array(ends), pa.array(s.astype(np.int64))), pa.array([x.tobytes() for x in counts], pa.binary())]
                same = [x == y for x, y in zip(digests(s, sizes), b.column("digest").to_pylist(), strict=True)]  # repeated ids have several
                yield pa.RecordBatch.from_arrays(columns, ["id", "size", "weight", "set", "counts"]).filter(pa.array(same, pa.bool_()))

    rows = docs.select(F.col(id_column).cast("long").alias("rep"), common.text_bytes(text).alias("_text"))
    return rows.join(wanted.select("id", "rep", "digest", "weight").hint("merge"), "rep").select("id", "weight", "digest", "_text").mapInArrow(run, "id long, size long, weight long, set array<long>, counts binary")


def sign(sets: DataFrame, percent: int, buckets: int) -> DataFrame:
    """The signatures of the sets of a batch that fall into a bucket: (bucket, ids, sigs, places)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        bands = Bands(percent)
        for whole in batches:
            for b in common.batches(iter([whole]), 60_000):
                lists = b.column("set")
                d, g = signatures(lists.flatten().to_numpy().astype(np.uint64), lists.value_lengths().to_numpy().astype(np.int64), bands)
                ids = b.column("id").to_numpy()
                bucket = ((g >> U64(32)) % U64(buckets)).astype(np.int64)
                order = np.lexsort((d, bucket))
                d, g, bucket = d[order], g[order], bucket[order]
                out: dict[str, list] = {"bucket": [], "ids": [], "sigs": [], "places": []}
                for a, z in stretches(bucket):
                    who, place = np.unique(d[a:z], return_inverse=True)
                    out["bucket"].append(int(bucket[a]))
                    out["ids"].append(small_ints(ids[who]))
                    out["sigs"].append(g[a:z].astype(np.uint32).tobytes())
                    out["places"].append(place.astype(np.uint16).tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(out["bucket"], pa.int32()), *[pa.array(out[c], pa.binary()) for c in ("ids", "sigs", "places")]], ["bucket", "ids", "sigs", "places"])

    return sets.select("id", "set").mapInArrow(run, "bucket int, ids binary, sigs binary, places binary")


def groups(table):
    """The groups of sets that share a signature of the bucket, each distinct group once: (gid, id, centre, n), centre the smallest id."""
    import pyarrow as pa

    sig, who = [], []
    for i, s, p in zip(table.column("ids").to_pylist(), table.column("sigs").to_pylist(), table.column("places").to_pylist(), strict=True):
        sig.append(np.frombuffer(s, np.uint32))
        who.append(from_small_ints(i)[np.frombuffer(p, np.uint16)])
    sig, who = np.concatenate(sig), np.concatenate(who)
    order = np.lexsort((who, sig))
    sig, who = sig[order], who[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    other = new.copy()
    other[1:] |= who[1:] != who[:-1]
    sig, who, new = sig[other], who[other], new[other]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(sig)))
    gid = np.add.reduceat(mix(who.astype(np.uint64) * GOLD + U64(1)), start) if len(start) else np.zeros(0, np.uint64)
    gid = mix(gid + size.astype(np.uint64)).astype(np.int64)
    some = np.flatnonzero(size > 1)
    some = some[np.unique(gid[some], return_index=True)[1]]
    of = lambda x: pa.array(np.repeat(x[some], size[some]), pa.int64())
    return pa.table({"gid": of(gid), "id": pa.array(who[ranges(start[some], size[some])], pa.int64()), "centre": of(who[start]), "n": of(size)})


def near_centre(percent: int):
    """The pairs (a, b) of each centre, whose sketch comes first of its chunk, with the sets that follow, as far as the bound lets them pass."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        centre, mine, own = None, None, 0
        for whole in batches:
            for t in common.batches(iter([whole]), 4096):
                a, b, size = (t.column(c).to_numpy() for c in ("a", "id", "size"))
                counts = np.frombuffer(b"".join(t.column("counts").to_pylist()), np.uint8).reshape(-1, PARTS)
                out: list[tuple[np.ndarray, np.ndarray]] = []
                for start, stop in stretches(np.cumsum(a == b)):
                    if a[start] == b[start]:
                        centre, mine, own, start = a[start], counts[start].astype(np.int16), size[start], start + 1
                    if stop > start and a[start] == centre:
                        apart = np.abs(counts[start:stop] - mine).sum(1, dtype=np.int64)
                        passes = apart * (100 + percent) <= (size[start:stop] + own) * (100 - percent)
                        out.append((a[start:stop][passes], b[start:stop][passes]))
                a, b = (np.concatenate([np.zeros(0, np.int64), *[x[k] for x in out]]) for k in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


def merged(label: np.ndarray, x: int, others: np.ndarray) -> list[int]:
    """Gives the trees of `others` the label of x; one member of each tree that was another (a link to it joins the trees)."""
    known, first = np.unique(label[others], return_index=True)
    new = known != label[x]
    if new.any():
        label[np.isin(label, known[new])] = label[x]
    return others[first[new]].tolist()


def near_members(percent: int):
    """For the members of groups (or of two cells of one) that lie in different components: a forest (a, b) of the pairs that the bound lets pass."""

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks().sort_by([("gid", "ascending"), ("i", "ascending"), ("j", "ascending")])
        key = np.stack([table.column(c).to_numpy() for c in ("gid", "i", "j")])
        ids, comp, size = (table.column(c).to_numpy() for c in ("id", "comp", "size"))
        counts = np.frombuffer(b"".join(table.column("counts").to_pylist()), np.uint8).reshape(-1, PARTS)
        edges = np.flatnonzero((np.diff(key, axis=1) != 0).any(0)) + 1
        out: list[tuple[int, int]] = []
        for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)], strict=True):
            label = np.unique(comp[a:z], return_inverse=True)[1]
            own, mine = size[a:z], counts[a:z].astype(np.int16)
            # the pairs inside the largest component are settled; all others have a member among the rest
            for x in np.flatnonzero(label != np.bincount(label).argmax()).tolist():
                apart = np.abs(mine - mine[x]).sum(1, dtype=np.int64)
                near = np.flatnonzero((apart * (100 + percent) <= (own + own[x]) * (100 - percent)) & (label != label[x]))
                out += [(int(ids[a + x]), int(ids[a + y])) for y in merged(label, x, near)]
        x, y = zip(*out, strict=True) if out else ((), ())
        return pa.table({"a": pa.array(x, pa.int64()), "b": pa.array(y, pa.int64())})

    return run


def block_links(ids: np.ndarray, weight: np.ndarray, flat: np.ndarray, sizes: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """(weights of the sets linked with each, a spanning forest of the links) between the sets `left` and `right`, or within one list."""
    within = len(left) == len(right) and bool((left == right).all())
    word = np.unique(flat, return_inverse=True)[1]
    often = np.bincount(word)
    doc = np.repeat(np.arange(len(ids)), sizes)
    doc, word = doc[often[word] > 1], word[often[word] > 1]
    dense = often[word] >= max(8, len(ids) // 64)  # by matrix products; the rest by postings
    name = np.full(len(often), -1)
    every = np.unique(word[dense])
    name[every] = np.arange(len(every))
    place = np.full(len(ids), -1)
    place[right] = np.arange(len(right))
    rare_d, rare_w, dense_d, dense_w = doc[~dense], word[~dense], doc[dense], name[word[dense]]
    order = np.argsort(rare_w, kind="stable")
    order = order[place[rare_d[order]] >= 0]
    post_w, post = rare_w[order], place[rare_d[order]]
    begin = np.searchsorted(post_w, rare_w)
    n = np.searchsorted(post_w, rare_w, side="right") - begin
    load = np.bincount(rare_d, weights=n, minlength=len(ids))[left]  # postings that a set meets
    steps = np.maximum(np.cumsum(load) // 1_000_000, np.arange(len(left)) // 512)
    label, links, forest = np.arange(len(ids)), np.zeros(len(ids), np.int64), []
    for some in np.split(left, np.flatnonzero(np.diff(steps)) + 1):
        mine = np.full(len(ids), -1)
        mine[some] = np.arange(len(some))
        shared = np.zeros((len(some), len(right)), np.float32)
        for c in range(0, len(every), 2048):
            of = (dense_w >= c) & (dense_w < c + 2048)
            wide = min(2048, len(every) - c)
            x, y = np.zeros((len(some), wide), np.float32), np.zeros((len(right), wide), np.float32)
            m, r = of & (mine[dense_d] >= 0), of & (place[dense_d] >= 0)
            x[mine[dense_d[m]], dense_w[m] - c] = 1
            y[place[dense_d[r]], dense_w[r] - c] = 1
            shared += x @ y.T
        m = mine[rare_d] >= 0
        at = np.repeat(mine[rare_d[m]], n[m]) * len(right) + post[ranges(begin[m], n[m])]
        shared += np.bincount(at, minlength=shared.size).reshape(shared.shape).astype(np.float32)
        shared = shared.astype(np.int64)
        link = shared * 100 >= (sizes[some][:, None] + sizes[right][None, :] - shared) * percent
        link &= some[:, None] != right[None, :]
        links[some] += link @ weight[right]
        if not within:
            links[right] += weight[some] @ link
        for k in np.flatnonzero(link.any(1)).tolist():
            x = int(some[k])
            forest += [(int(ids[x]), int(ids[y])) for y in merged(label, x, right[link[k]])]
    return links, forest


def links_of(percent: int):
    """The blocks of a task: (a, b, links) with a link of a spanning forest, or with a set's number of links and b null."""

    def run(table):
        import pyarrow as pa

        table = table.combine_chunks().sort_by([("cluster", "ascending"), ("i", "ascending"), ("j", "ascending")])
        key = np.stack([table.column(c).to_numpy() for c in ("cluster", "i", "j")])
        ids, weight, cell = (table.column(c).to_numpy() for c in ("id", "weight", "cell"))
        lists = table.column("set").combine_chunks()
        sizes, flat = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), lists.flatten().to_numpy()
        ends = np.concatenate([[0], np.cumsum(sizes)])
        edges = np.flatnonzero((np.diff(key, axis=1) != 0).any(0)) + 1
        out_a, out_b, out_n = [], [], []
        for a, z in zip([0, *edges.tolist()], [*edges.tolist(), len(ids)], strict=True):
            i, j = key[1, a], key[2, a]
            left, right = np.flatnonzero(cell[a:z] == i), np.flatnonzero(cell[a:z] == j)
            if not len(left) or not len(right):
                continue
            n, forest = block_links(ids[a:z], weight[a:z], flat[ends[a] : ends[z]], sizes[a:z], left, right, percent)
            some = np.flatnonzero(n)
            out_a += [x for x, _ in forest] + ids[a:z][some].tolist()
            out_b += [y for _, y in forest] + [None] * len(some)
            out_n += [None] * len(forest) + n[some].tolist()
        return pa.table({"a": pa.array(out_a, pa.int64()), "b": pa.array(out_b, pa.int64()), "links": pa.array(out_n, pa.int64())})

    return run


def in_cells(df: DataFrame, keep: list[str]) -> DataFrame:
    """Rows with a number of cells, once for each pair (i, j) of cells that holds their own."""
    df = df.withColumn("cell", F.pmod(F.xxhash64("id"), F.col("cells")))
    df = df.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    return df.select(*keep, "cell", F.least("cell", "other").alias("i"), F.greatest("cell", "other").alias("j"))


def salted(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """left join right by a key that may be hot on the left; right has a row a key."""
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    return left.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(SALTS))).join(right.withColumn("_salt", salts), [key, "_salt"]).drop("_salt")


def near_pairs(member: DataFrame, sketches: DataFrame, percent: int, partitions: int) -> DataFrame:
    """(a, b): sets and the centres of their groups, as far as the bound lets them pass.  A centre with many pairs is several chunks."""
    pairs = member.filter("id <> centre").select(F.col("centre").alias("a"), F.col("id").alias("b")).distinct()
    load = pairs.groupBy("a").agg(F.ceil(F.count("*") / 256).alias("chunks"))
    spread = salted(pairs.withColumnRenamed("b", "id"), load, "a").select("a", "id", F.pmod(F.xxhash64("id"), F.col("chunks")).alias("chunk"))
    own = load.select("a", F.col("a").alias("id"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"))
    rows = spread.unionByName(own).join(sketches.select("id", "size", "counts").hint("merge"), "id").select("a", "id", "chunk", "size", "counts")
    rows = rows.repartition(partitions, "a", "chunk").sortWithinPartitions("a", "chunk", F.col("id") != F.col("a"), "id")
    return rows.mapInArrow(near_centre(percent), "a long, b long")


def join(docs: DataFrame, width: int, percent: int, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, n_shingles, component_id, n_links), a row a document; n_links counts the other documents linked with it directly."""
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    partitions = common.shuffle_partitions(spark)
    total = docs.agg(F.sum(F.length(common.text_bytes(text)))).first()[0] or 0
    share = min(1.0, (100 - percent) / 40)
    buckets = max(partitions, math.ceil(total / 6 * share / 1e6))
    scanned = scratch.table(scan(docs, width, share, buckets, id_column, text), "scanned")
    sized = scratch.table(scanned.filter("n is not null").select("doc_id", "n", "digest"), "sized")
    alone = scanned.filter("bucket is not null").select("bucket", "block", "marks", "places").groupBy("bucket").applyInArrow(lonely, "block long, places binary")
    names = scanned.filter("ids is not null").select("block", F.lit(None).cast("binary").alias("places"), "ids")
    own = alone.withColumn("ids", F.lit(None).cast("binary")).unionByName(names).groupBy("block").applyInArrow(counted, "doc_id long, lonely long")
    own = scratch.table(own.groupBy("doc_id").agg(F.min("lonely").alias("lonely")), "lonely")
    scratch.drop(scanned)
    # a row a class of equal sets, numbered; the document with the smallest id stands for it
    classes = sized.filter("digest is not null and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.count("*").alias("weight"))
    classes = scratch.table(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    may = classes.join(own, classes.rep == own.doc_id, "left").filter((F.col("n") - F.coalesce("lonely", F.lit(0))) * 100 >= F.col("n") * percent)
    may = scratch.table(may.select("id", "rep", "digest", "n", "weight"), "may-link")
    sets = sets_of(docs, may, width, id_column, text)
    if not sized.groupBy("doc_id", "digest").count().filter("count > 1 and doc_id is not null").isEmpty():
        sets = sets.dropDuplicates(["id"])  # repeated rows give the set of their class once
    sets = scratch.table(sets, "sets")
    buckets = max(partitions, math.ceil((may.agg(F.sum("n")).first()[0] or 0) * 3 / 1e6))
    member = sign(sets, percent, buckets).groupBy("bucket").applyInArrow(groups, "gid long, id long, centre long, n long")
    member = scratch.table(member.distinct(), "members")
    near = scratch.table(near_pairs(member, sets, percent, partitions), "near-centres")
    comp = scratch.table(common.components(near, scratch), "components")
    placed = member.join(comp, "id", "left").select("gid", "id", "n", F.coalesce("component", "id").alias("comp"))
    state = placed.groupBy("gid").agg(F.min("comp").alias("_a"), F.max("comp").alias("_b")).filter("_a < _b").select("gid")
    apart = scratch.table(in_cells(salted(placed, state, "gid").withColumn("cells", F.ceil(F.col("n") / CROWD)), ["gid", "id", "comp"]), "apart")
    scratch.drop(member)
    tasks = max(partitions, math.ceil(apart.count() / 20_000))
    apart_sketches = apart.join(sets.select("id", "size", "counts").hint("merge"), "id").withColumn("task", F.pmod(F.xxhash64("gid", "i", "j"), F.lit(tasks)))
    more = scratch.table(apart_sketches.groupBy("task").applyInArrow(near_members(percent), "a long, b long").distinct(), "near-members")
    comp = scratch.table(common.components(near.union(more), scratch).withColumnRenamed("component", "cluster"), "clusters")
    crowd = comp.join(sets.select("id", "size", "weight"), "id")
    cells = crowd.groupBy("cluster").agg(F.ceil(F.sum("size") / CELL).alias("cells"))
    crowd = scratch.table(in_cells(salted(crowd, cells, "cluster"), ["cluster", "id", "weight", "size"]), "cells")
    tasks = max(partitions, math.ceil((crowd.agg(F.sum("size")).first()[0] or 0) / CELL))
    blocks = crowd.drop("size").join(sets.select("id", "set").hint("merge"), "id").withColumn("task", F.pmod(F.xxhash64("cluster", "i", "j"), F.lit(tasks)))
    found = scratch.table(blocks.groupBy("task").applyInArrow(links_of(percent), "a long, b long, links long"), "links")
    scratch.drop(sets, crowd, near, more, apart)
    linked = found.filter("b is not null").select("a", "b")
    several = sized.filter("doc_id is not null and digest is not null").groupBy("doc_id").agg(F.min("digest").alias("_a"), F.max("digest").alias("_b")).filter("_a <> _b").select("doc_id")
    several = scratch.table(several.join(sized, "doc_id").join(classes.select("digest", "id"), "digest").select("doc_id", "id"), "several-texts")
    linked = linked.union(several.join(several.groupBy("doc_id").agg(F.min("id").alias("a")), "doc_id").select("a", F.col("id").alias("b")))
    comp = scratch.table(common.components(linked, scratch), "linked")
    first = comp.join(classes.select("id", "rep"), "id").groupBy("component").agg(F.min("rep").alias("component_id"))
    named = salted(comp, first, "component").select("id", "component_id")
    counts = found.filter("b is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    known = classes.join(named, "id", "left").join(counts, "id", "left")
    known = scratch.table(known.select("digest", F.coalesce("component_id", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links")), "known")
    scratch.drop(found, classes, comp)
    # documents without words look up a key of their own, so they don't meet in one task
    out = sized.withColumn("digest", F.coalesce("digest", F.concat(F.lit("document "), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))).join(known, "digest", "left")
    has_id = F.col("doc_id").isNotNull()
    component = F.when(has_id, F.coalesce("component_id", "doc_id"))
    links = F.when(has_id, F.coalesce("n_links", F.lit(0))).otherwise(0).cast("long")
    return out.select(F.col("doc_id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), links.alias("n_links"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(common.documents(spark, sf_dir), width=3, percent=90)
