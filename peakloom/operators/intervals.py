"""Interval algebra on half-open (start_pos, end_pos) columns: merge, disjoin, support, overlap, nearest.

Joins are equi-joins on bins, never theta joins.  Windows over positions run inside tiles, so no task holds a chromosome.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

S, E = "start_pos", "end_pos"
TILE = 1 << 20


def cut_at_tiles(df: DataFrame, tile: int, s: str = S, e: str = E) -> DataFrame:
    """Each interval in pieces that lie in one tile, with the tile's number."""
    last = F.floor((F.col(e) - 1) / tile)
    out = df.withColumn("_tile", F.explode(F.sequence(F.floor(F.col(s) / tile), F.greatest(F.floor(F.col(s) / tile), last))))
    return out.withColumns({s: F.greatest(F.col(s), F.col("_tile") * tile), e: F.least(F.col(e), (F.col("_tile") + 1) * tile)})


def _islands(df: DataFrame, keys: list[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(S, E)
    reach = F.max(E).over(w.rowsBetween(Window.unboundedPreceding, -1))
    new = df.withColumn("_new", F.when(F.col(S) <= reach, 0).otherwise(1))
    island = new.withColumn("_island", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return island.groupBy(*keys, "_island").agg(F.min(S).alias(S), F.max(E).alias(E)).drop("_island")


def merge(df: DataFrame, keys: list[str], tile: int = TILE) -> DataFrame:
    """Overlapping and book-ended intervals of a key as one.  Tiles are merged apart; pieces at their borders once more."""
    pieces = _islands(cut_at_tiles(df.select(*keys, S, E), tile), [*keys, "_tile"]).drop("_tile")
    at_border = (F.col(S) % tile == 0) | (F.col(E) % tile == 0)
    return pieces.filter(~at_border).unionByName(_islands(pieces.filter(at_border), keys)).select(*keys, S, E)


def depth_segments(df: DataFrame, keys: list[str], tile: int = TILE, weight: Column | None = None) -> DataFrame:
    """Segments between neighbouring boundaries with the number (or summed weight) of intervals over them; tile borders cut too."""
    w = F.lit(1).cast("long") if weight is None else weight
    cut = cut_at_tiles(df.withColumn("_w", w).select(*keys, S, E, "_w"), tile)
    events = cut.select(
        *keys, "_tile",
        F.explode(F.array(F.struct(F.col(S).alias("pos"), F.col("_w").alias("d")), F.struct(F.col(E).alias("pos"), (-F.col("_w")).alias("d")))).alias("x")
    ).select(*keys, "_tile", "x.*")
    sums = events.groupBy(*keys, "_tile", "pos").agg(F.sum("d").alias("d"))
    by = Window.partitionBy(*keys, "_tile").orderBy("pos")
    run = sums.withColumns({"depth": F.sum("d").over(by.rowsBetween(Window.unboundedPreceding, 0)), E: F.lead("pos").over(by)})
    return run.filter(F.col("depth") != 0).filter(F.col(E).isNotNull()).select(*keys, F.col("pos").alias(S), E, "depth")


def same_depth(df: DataFrame, keys: list[str], value: str, tile: int = TILE) -> DataFrame:
    """Run-length merge: touching segments of equal value as one, within tiles and then over their borders."""

    def runs(x: DataFrame, by: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(S)
        new = F.when((F.lag(E).over(w) == F.col(S)) & (F.lag(value).over(w) == F.col(value)), 0).otherwise(1)
        x = x.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
        return x.groupBy(*by, "_run").agg(F.min(S).alias(S), F.max(E).alias(E), F.first(value).alias(value)).drop("_run")

    within = runs(df.withColumn("_tile", F.floor(F.col(S) / tile)), [*keys, "_tile"]).drop("_tile")
    at_border = (F.col(S) % tile == 0) | (F.col(E) % tile == 0)
    return within.filter(~at_border).unionByName(runs(within.filter(at_border), keys)).select(*keys, S, E, value)


def whole_segments(df: DataFrame, keys: list[str], tile: int = TILE) -> DataFrame:
    """depth_segments without the cuts that tile borders make where no interval begins or ends."""
    segments = depth_segments(df, keys, tile)
    real = df.select(*keys, F.explode(F.array(S, E)).alias("_at")).filter(F.col("_at") % tile == 0).distinct()
    border = (F.col(S) % tile == 0) | (F.col(E) % tile == 0)
    marked = segments.filter(border).join(real.withColumn("_real", F.lit(True)).withColumnRenamed("_at", S), [*keys, S], "left")
    w = Window.partitionBy(*keys).orderBy(S)  # two segments a tile at most
    new = F.when((F.lag(E).over(w) == F.col(S)) & F.col("_real").isNull() & (F.lag("depth").over(w) == F.col("depth")), 0).otherwise(1)
    run = marked.withColumn("_new", new).withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = run.groupBy(*keys, "_run").agg(F.min(S).alias(S), F.max(E).alias(E), F.first("depth").alias("depth")).drop("_run")
    return segments.filter(~border).unionByName(joined)


def disjoin(df: DataFrame, keys: list[str], sample: str, tile: int = TILE) -> DataFrame:
    """Atomic segments with `support`, the number of distinct samples over each; boundaries are those of the samples' merged intervals."""
    return whole_segments(merge(df, [*keys, sample], tile), keys, tile).withColumnRenamed("depth", "support")


def consensus(df: DataFrame, keys: list[str], sample: str, least: int = 2, tile: int = TILE) -> DataFrame:
    """Stretches that at least `least` samples support, book-ended ones merged."""
    support = depth_segments(merge(df, [*keys, sample], tile), keys, tile)
    return merge(support.filter(F.col("depth") >= least), keys, tile)


def consensus_or_single(df: DataFrame, keys: list[str], sample: str, least: int = 2, allow_single: bool = False, tile: int = TILE) -> DataFrame:
    """With one sample, its merged intervals if that is allowed and none otherwise."""
    if df.select(sample).distinct().count() >= 2:
        return consensus(df, keys, sample, least, tile)
    return merge(df, keys, tile) if allow_single else merge(df, keys, tile).limit(0)


def overlap_width(s1: str, e1: str, s2: str, e2: str) -> Column:
    return F.greatest(F.least(F.col(e1), F.col(e2)) - F.greatest(F.col(s1), F.col(s2)), F.lit(0))


#: From this estimated size of the left side on, joins look for hot bins.
SALT_FROM = 1 << 30


def estimated_bytes(df: DataFrame) -> int:
    """The optimiser's estimate of a table's size; 0 where it can't be asked."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().toString())
    except AttributeError:
        return 0


def hot_keys(df: DataFrame, by: list[str], tasks: int) -> DataFrame:
    """(by, _pieces): keys that hold more than 1 / (4 * tasks) of all rows, so 4 * tasks keys at most, and into how many pieces of
    that size each is to be cut.  All rows are counted, with the partial sums of an aggregation; a sample would not say the same
    for both sides of a join when a task runs again."""
    counts = df.groupBy(*by).agg(F.count("*").alias("_n"))
    total = df.agg(F.count("*").alias("_all"))
    piece = F.col("_all") / (4 * tasks)
    return counts.crossJoin(F.broadcast(total)).filter(F.col("_n") > piece).select(*by, F.ceil(F.col("_n") / piece).alias("_pieces"))  # one row beside each


def salted(left: DataFrame, right: DataFrame, by: list[str], tasks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Both sides with _salt, to join by [*by, "_salt"] instead of by: left's rows of a hot key are dealt to its pieces, right's
    rows of it are copied to each.  Other keys have the salt 0.  Copies are rows of right times pieces, and pieces are 8 * tasks in
    all at most."""
    tasks = tasks or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = F.broadcast(hot_keys(left.select(*by), by, tasks))  # 4 * tasks rows at most
    # equal rows of different tasks part as well; a task that runs again deals alike
    plain = [c for c, kind in left.dtypes if "map<" not in kind]  # maps can't be hashed
    deal = F.pmod(F.xxhash64(*plain, F.spark_partition_id()), F.col("_pieces"))
    dealt = left.join(hot, by, "left").withColumn("_salt", F.coalesce(deal, F.lit(0))).drop("_pieces")
    copies = F.sequence(F.lit(0).cast("long"), F.coalesce("_pieces", F.lit(1)) - 1)
    return dealt, right.join(hot, by, "left").withColumn("_salt", F.explode(copies)).drop("_pieces")


def overlap_join(
    left: DataFrame, right: DataFrame, keys: tuple[str, ...] = ("chrom",), bin_width: int = 2000, coarse: int = 64, salt: bool | None = None
) -> DataFrame:
    """All pairs of overlapping intervals, once each; right's other columns must not clash, its interval is (r_start, r_end).

    Intervals over 8 bins long use bins `coarse` times wider, so a long one does not explode; each pair meets on one resolution
    (0: both short, 1: right long, 2: left long) and in the bin of the later start.  salt: whether hot bins of left are cut (see
    salted()); by default if left is estimated at SALT_FROM bytes or more.
    """
    wide = bin_width * coarse

    def bins(s: str, e: str, width: int) -> Column:
        return F.sequence(F.floor(F.col(s) / width), F.greatest(F.floor((F.col(e) - 1) / width), F.floor(F.col(s) / width)))

    def spread(df: DataFrame, s: str, e: str, short: list[tuple[int, int]], long: list[tuple[int, int]]) -> DataFrame:
        def at(level: int, width: int) -> Column:
            return F.transform(bins(s, e, width), lambda b: F.struct(F.lit(level).alias("_level"), b.alias("_bin")))

        pick = lambda levels: F.flatten(F.array(*[at(*x) for x in levels]))
        return df.withColumn(
            "_x", F.explode(F.when(F.col(e) - F.col(s) <= 8 * bin_width, pick(short)).otherwise(pick(long)))
        ).select(*df.columns, "_x._level", "_x._bin")

    right = right.withColumnsRenamed({S: "r_start", E: "r_end"})
    a = spread(left, S, E, [(0, bin_width), (1, wide)], [(2, wide)])
    b = spread(right, "r_start", "r_end", [(0, bin_width), (2, wide)], [(1, wide), (2, wide)])
    by = [*keys, "_level", "_bin"]
    if salt or (salt is None and estimated_bytes(left) >= SALT_FROM):
        a, b = salted(a, b, by)
        both = a.join(b, [*by, "_salt"]).drop("_salt")
    else:
        both = a.join(b, by)
    width = F.when(F.col("_level") == 0, bin_width).otherwise(wide)
    meet = F.floor(F.greatest(F.col(S), F.col("r_start")) / width)
    return both.filter((F.col(S) < F.col("r_end")) & (F.col("r_start") < F.col(E)) & (F.col("_bin") == meet)).drop("_level", "_bin")


def with_flag(
    left: DataFrame, right: DataFrame, ids: list[str], flag: str, keys: tuple[str, ...] = ("chrom",), width: int = 2000, coarse: int = 64,
    salt: bool | None = None
) -> DataFrame:
    """Adds whether a row of left overlaps any interval of right; ids tell left's rows apart.  salt: as in overlap_join().

    Right is merged, and each bin lists the merged intervals that reach it or the bin after it: a row no longer than a bin finds
    all it needs in the bin of its start, so left is neither exploded nor joined back, and a small right side is broadcast by its
    size.  Longer rows use bins `coarse` times wider; those longer still (rare) take the join on bins.  The longest row, asked for
    when this is called, says which of these are planned.
    """
    merged = merge(right.select(*keys, S, E), list(keys))
    longest = left.agg(F.max(F.col(E) - F.col(S))).first()[0] or 0
    levels = [(i, width * coarse**i) for i in range(2 if longest > width else 1)]

    def bins(number: int, w: int) -> Column:
        near = F.sequence(F.floor(F.col(S) / w) - 1, F.floor((F.col(E) - 1) / w))
        return F.transform(near, lambda b: F.struct(F.lit(number).alias("_level"), b.alias("_bin")))

    spread = F.flatten(F.array(*[bins(*x) for x in levels]))
    lists = merged.select(*keys, F.explode(spread).alias("_x"), F.struct(F.col(S).alias("s"), F.col(E).alias("e")).alias("_i"))
    lists = lists.groupBy(*keys, F.col("_x._level").alias("_level"), F.col("_x._bin").alias("_bin")).agg(F.collect_list("_i").alias("_list"))
    span = F.col(E) - F.col(S)
    level = F.when(span <= width, 0).otherwise(1)
    short = left.withColumns({"_level": level, "_bin": F.when(level == 0, F.floor(F.col(S) / width)).otherwise(F.floor(F.col(S) / (width * coarse)))})
    by = [*keys, "_level", "_bin"]
    if longest > width * coarse:
        short = short.filter(span <= width * coarse)
    if salt or (salt is None and estimated_bytes(left) >= SALT_FROM):
        short, lists = salted(short, lists, by)
        by = [*by, "_salt"]
    found = short.join(lists, by, "left")
    found = found.withColumn(flag, F.coalesce(F.exists("_list", lambda i: (i["s"] < F.col(E)) & (i["e"] > F.col(S))), F.lit(False)))
    if longest <= width * coarse:
        return found.select(*left.columns, flag)
    long = left.filter(span > width * coarse)
    hit = overlap_join(long.select(*dict.fromkeys([*ids, *keys, S, E])), merged, keys, width).select(*ids).distinct().withColumn(flag, F.lit(True))
    rest = long.join(hit, ids, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return found.select(*left.columns, flag).unionByName(rest.select(*left.columns, flag))


def with_any(left: DataFrame, right: DataFrame, ids: list[str], keys: tuple[str, ...] = ("chrom",), anti: bool = False, bin_width: int = 2000) -> DataFrame:
    """Rows of left that overlap (or, anti, don't overlap) any of right.  ids tell left's rows apart."""
    marked = with_flag(left, right, ids, "_any", keys, bin_width)
    return marked.filter(~F.col("_any") if anti else F.col("_any")).drop("_any")


def nearest(points: DataFrame, targets: DataFrame, point_id: str, position: str, name: str, key: str = "chrom", tile: int = TILE) -> DataFrame:
    """For each interval the nearest target point (distance 0 if the point lies in it), ties to the smallest (position, name).

    Windows run inside tiles over targets and interval starts together: the last target at or before the start, the first one
    after it; where a tile has none, that of the nearest tile which has, from a table of a row a tile.
    """
    kind = targets.select(F.struct(F.col(position), F.col(name)).alias("_t")).schema["_t"].dataType
    t = targets.groupBy(key, position).agg(F.min(name).alias(name)).select(
        key, F.col(position).alias("_at"), F.lit(0).alias("_kind"), F.struct(F.col(position), F.col(name)).alias("_t")
    )
    t = t.withColumns({point_id: F.lit(None).cast(points.schema[point_id].dataType), S: F.lit(None).cast("long"), E: F.lit(None).cast("long")})
    p = points.select(
        key, F.col(S).alias("_at"), F.lit(1).alias("_kind"), F.lit(None).cast(kind).alias("_t"), point_id, F.col(S).cast("long").alias(S),
        F.col(E).cast("long").alias(E)
    )
    both = t.unionByName(p).withColumn("_tile", F.floor(F.col("_at") / tile))
    tiles = both.groupBy(key, "_tile").agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"))
    over = Window.partitionBy(key).orderBy("_tile")  # a row a tile
    earlier, later = over.rowsBetween(Window.unboundedPreceding, -1), over.rowsBetween(1, Window.unboundedFollowing)
    carried = tiles.select(
        key, "_tile", F.last("_last", ignorenulls=True).over(earlier).alias("_before"),
        F.first("_first", ignorenulls=True).over(later).alias("_after")
    )
    # what tiles before and after have stands as a row at a tile's begin and end
    row = lambda at, kind, t: F.struct((at * tile).alias("_at"), F.lit(kind).alias("_kind"), F.col(t).alias("_t"))
    ends = carried.select(key, "_tile", F.inline(F.array(row(F.col("_tile"), -1, "_before"), row(F.col("_tile") + 1, 2, "_after"))))
    both = both.unionByName(ends.filter("_t is not null"), allowMissingColumns=True)
    inside = Window.partitionBy(key, "_tile").orderBy("_at", "_kind")
    # targets at the start itself count as before, so what follows lies strictly after it
    x = both.withColumns(
        {
            "_b": F.last("_t", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0)),
            "_a": F.first("_t", ignorenulls=True).over(inside.rowsBetween(0, Window.unboundedFollowing))
        }
    ).filter("_kind = 1")
    gap_b = F.when(F.col("_b").isNotNull(), F.col(S) - F.col(f"_b.{position}"))
    gap_a = F.when(F.col("_a").isNotNull(), F.greatest(F.lit(0), F.col(f"_a.{position}") - (F.col(E) - 1)))
    take_b = F.col("_b").isNotNull() & (F.col("_a").isNull() | (gap_b <= gap_a))
    best = x.select(key, point_id, S, E, F.when(take_b, F.col("_b")).otherwise(F.col("_a")).alias("_n"), F.when(take_b, gap_b).otherwise(gap_a).alias("distance"))
    return best.select(key, point_id, S, E, F.col(f"_n.{position}").alias(position), F.col(f"_n.{name}").alias(name), "distance")


def chrom_rank(column: str = "chrom", autosomes: int = 22) -> Column:
    """1..autosomes, X, Y, M in natural order; others after them."""
    core = F.regexp_replace(F.col(column), "^chr", "")
    return F.when(
        core.rlike("^[0-9]+$"), core.try_cast("int") if hasattr(core, "try_cast") else core.cast("int")
    ).when(core == "X", 1001).when(core == "Y", 1002).when(core.isin("M", "MT"), 1003).otherwise(2000)


def number(df: DataFrame, order: list[Column], bucket: list[Column]) -> DataFrame:
    """A global rank from 1 without a window over all rows: ranked inside buckets, then shifted by the counts of the buckets before.

    bucket must rise with order; being a function of the row alone, it is the same whenever a partition is made again.  Only the
    table of a row a bucket is sorted in one task.
    """
    cols, by = {f"_o{i}": c for i, c in enumerate(order)}, {f"_k{i}": c for i, c in enumerate(bucket)}
    dealt = df.withColumns(cols | by)
    counts = dealt.groupBy(*by).agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy(*by)) - F.col("_n")).drop("_n")
    inside = F.row_number().over(Window.partitionBy(*by).orderBy(*cols))
    return dealt.join(before, list(by)).withColumn("rank", F.col("_before") + inside).drop("_before", *by, *cols)


def region_ids(regions: DataFrame, prefix: str = "peak", autosomes: int = 22, tile: int = TILE) -> DataFrame:
    """Adds region_id `<prefix>_000001` in canonical chromosome order, then start."""
    rank = chrom_rank("chrom", autosomes)
    ranked = number(regions, [rank, F.col("chrom"), F.col(S), F.col(E)], [rank, F.col("chrom"), F.floor(F.col(S) / tile)])
    text = F.col("rank").cast("string")
    return ranked.withColumn("region_id", F.concat(F.lit(f"{prefix}_"), F.when(F.length(text) >= 6, text).otherwise(F.lpad(text, 6, "0")))).drop("rank")


def tss(genes: DataFrame) -> DataFrame:
    """Adds tss, the 0-based position of the strand-aware start."""
    return genes.withColumn("tss", F.when(F.col("strand") == "-", F.col(E) - 1).otherwise(F.col(S)))


def promoters(genes: DataFrame, up: int = 2000, down: int = 500) -> DataFrame:
    """Promoter windows around the TSS, clipped at the chromosome's first base."""
    t = tss(genes)
    plus = F.col("strand") != "-"
    s = F.when(plus, F.col("tss") - up).otherwise(F.col("tss") - down)
    e = F.when(plus, F.col("tss") + down + 1).otherwise(F.col("tss") + up + 1)
    return t.withColumns({S: F.greatest(F.lit(0), s).cast("long"), E: e.cast("long")})


def recentre(regions: DataFrame, depth: DataFrame, half: int = 100) -> DataFrame:
    """Windows of 2 * half + 1 bp around the position of greatest depth in each region; ties to the leftmost segment."""
    pairs = overlap_join(regions.select("chrom", S, E), depth.select("chrom", S, E, "depth"))
    inner = pairs.withColumns({"_s": F.greatest(S, "r_start"), "_e": F.least(E, "r_end")})
    top = inner.groupBy("chrom", S, E).agg(F.max_by(F.struct("_s", "_e"), F.struct(F.col("depth"), -F.col("_s"))).alias("t"))
    mid = F.floor((F.col("t._s") + F.col("t._e") - 1) / 2)
    return top.select("chrom", F.greatest(F.lit(0), mid - half).alias(S), (mid + half + 1).alias(E), mid.alias("summit"))
