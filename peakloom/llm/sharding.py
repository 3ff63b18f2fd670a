"""Sharding by sampled splitters, in DataFrame functions only: shards of nearly equal bytes, equal texts together.

Records are ordered by a hash of their text, so equal texts (a group) stand side by side.
1. Keys are drawn with chances in proportion to their rows' sizes, `samples` for each range on average.
2. The draws' quantiles are the splitters of max(per_shard * shards, shuffle partitions) ranges.  A splitter is a key, so no
   group lies in two ranges.
3. Bytes are summed by group.  A range of more than twice the mean is overfull and is subdivided: where its prefix sums pass
   a multiple of the mean, and around each group larger than the mean, which becomes a range of its own.
4. Such a group is numbered in pieces of about the mean, by a hash of its rows' ids.  If it is larger than a shard's share its
   pieces are dealt one by one, else all of them go to one shard.
5. Ranges go to the shard that has the fewest bytes so far, largest first.

So a shard's bytes differ from the share by about a small range (share / per_shard / 2 or less), unless one record alone is
larger; a group that fits a shard is never cut.  Slots number a shard's rows range by range, then by key, id and row.

Scale: rows are shuffled once, without their texts, by range and piece.  What meets in the driver are splitters and the sums
of ranges and pieces: numbers in proportion to the ranges, not to the rows.  No task gets more than twice the mean range.
Splitters come from hashes of ids and keys, so a rerun on the same table gives the same shards.

Cases: a null text has no bytes (crc32 0) and stands with the empty ones.  Null and repeated ids are rows like others.  An
empty table gives an empty result.  Other columns pass through; the added ones replace like-named ones.
"""

from __future__ import annotations

import heapq
from bisect import bisect_right

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

SHARDS, OVERHEAD = 40, 16
LEAST = -(1 << 63)


def draws(rows: DataFrame, total: int, wanted: int) -> DataFrame:
    """(_key, n): n draws of a row, size / total * wanted on average."""
    x = F.col("size") * F.lit(wanted / max(total, 1))
    u = F.pmod(F.xxhash64("_key", "_id", "_row", F.lit(13)), F.lit(1 << 32)) / float(1 << 32)
    return rows.select("_key", (F.floor(x) + (u < x - F.floor(x)).cast("long")).alias("n")).filter("n > 0").groupBy("_key").agg(F.sum("n").alias("n"))


def splitters(rows: DataFrame, total: int, ranges: int, samples: int) -> list[int]:
    """First keys of the ranges but the first, ascending: quantiles of the draws."""
    before = F.sum("n").over(Window.orderBy("_key").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")
    cut = draws(rows, total, ranges * samples).withColumn("q", F.floor(before / samples))  # a sample of bounded size in one task
    return sorted(r["k"] for r in cut.groupBy("q").agg(F.min("_key").alias("k")).filter("q > 0").collect())


def with_range(rows: DataFrame, starts: list[tuple[int, int]]) -> DataFrame:
    """Adds _unit, the number of the range a key is in, and _cuts.  starts: (first key, pieces) ascending, the first with LEAST.

    Ranges are found by an equi-join on the key's leading bits with a table of at most twice as many rows as ranges.
    """
    bits = max(1, (len(starts) - 1).bit_length())
    keys = [k for k, _ in starts]
    cells = []
    for c in range(-(1 << bits - 1), 1 << bits - 1):
        low = c << 64 - bits
        at = bisect_right(keys, low) - 1
        inside = range(at + 1, bisect_right(keys, low + (1 << 64 - bits) - 1))
        cells.append({"_cell": c, "at": at, "cuts": starts[at][1], "inside": [{"k": starts[i][0], "n": starts[i][1]} for i in inside]})
    table = common.literal_table(rows.sparkSession, cells, "_cell: bigint, at: int, cuts: bigint, inside: array<struct<k: bigint, n: bigint>>")
    hit = F.filter("inside", lambda s: s["k"] <= F.col("_key"))
    found = rows.withColumn("_cell", F.shiftright("_key", 64 - bits)).join(F.broadcast(table), "_cell").withColumn("_hit", hit)
    found = found.withColumn("_unit", F.col("at") + F.size("_hit")).withColumn("_cuts", F.coalesce(F.try_element_at("_hit", F.lit(-1))["n"], F.col("cuts")))
    return found.drop("_cell", "at", "cuts", "inside", "_hit")


def subdivided(rows: DataFrame, starts: list[tuple[int, int]], mean: float) -> list[tuple[int, int]]:
    """starts with those added that cut overfull ranges; a group larger than the mean stands alone, with its pieces."""
    groups = with_range(rows, starts).groupBy("_unit", "_key").agg(F.sum("size").alias("bytes"))
    inside = Window.partitionBy("_unit").orderBy("_key")
    whole = F.sum("bytes").over(Window.partitionBy("_unit"))
    piece = F.floor((F.sum("bytes").over(inside) - F.col("bytes")) / F.lit(mean))
    big = F.col("bytes") > F.lit(mean)
    cut = groups.select("_unit", "_key", "bytes", whole.alias("whole"), piece.alias("piece"), big.alias("big")).filter(F.col("whole") > F.lit(2 * mean))
    new = F.col("big") | F.coalesce(F.lag("big").over(inside), F.lit(False)) | (F.col("piece") != F.coalesce(F.lag("piece").over(inside), F.lit(-1)))
    found = cut.withColumn("new", new).filter("new").select("_key", F.when(F.col("big"), F.ceil(F.col("bytes") / F.lit(mean))).otherwise(1).alias("n")).collect()
    return sorted((dict(starts) | {r["_key"]: r["n"] for r in found}).items())


def dealt(pieces: list[tuple[int, int, int, int, int]], shards: int) -> list[dict]:
    """The shard of each piece and the slot of its first row.  pieces: (unit, cut, cuts, bytes, rows).

    The largest goes first, each to the shard with the fewest bytes; pieces of a group that fits a shard go together.
    """
    share = sum(p[3] for p in pieces) / shards
    size: dict[int, int] = {}
    for unit, _, _, n_bytes, _ in pieces:
        size[unit] = size.get(unit, 0) + n_bytes
    bundles: dict[tuple, list] = {}
    for p in sorted(pieces):
        bundles.setdefault((p[0], p[1] if size[p[0]] > share else -1), []).append(p)
    loads = [(0, s) for s in range(shards)]
    shard_of = {}
    for key, members in sorted(bundles.items(), key=lambda x: (-sum(p[3] for p in x[1]), x[0])):
        load, s = heapq.heappop(loads)
        heapq.heappush(loads, (load + sum(p[3] for p in members), s))
        shard_of |= {p[:2]: s for p in members}
    filled, out = [0] * shards, []
    for unit, cut, _, _, rows in sorted(pieces):
        s = shard_of[unit, cut]
        out.append({"_unit": unit, "_piece": cut, "shard": s, "first": filled[s]})
        filled[s] += rows
    return out


def shard(df: DataFrame, shards: int = SHARDS, id_column: str = "doc_id", text: str = "text", overhead: int = OVERHEAD, per_shard: int = 32, samples: int = 16) -> DataFrame:
    """One row per row of df, with its columns but for `text`, and size, text_crc32, shard and slot."""
    spark = df.sparkSession
    scratch = common.Scratch(spark)
    rest = [c for c in df.columns if c not in (text, "size", "text_crc32", "shard", "slot")]
    body = common.text_bytes(text)
    rows = df.select(F.struct(*rest).alias("_rest"), F.col(id_column).alias("_id"), (F.octet_length(body) + overhead).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.xxhash64(body).alias("_key"), F.monotonically_increasing_id().alias("_row"))
    rows = scratch.table(rows, "sized")
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = max(per_shard * shards, common.shuffle_partitions(spark))
    starts = [(LEAST, 1)] + [(k, 1) for k in splitters(rows, total, ranges, samples) if k > LEAST]
    starts = subdivided(rows, starts, max(total, 1) / ranges)
    piece = F.pmod(F.xxhash64("_id", "_row"), "_cuts")
    ranged = scratch.table(with_range(rows, starts).withColumn("_piece", piece), "ranged")
    sums = ranged.groupBy("_unit", "_piece", "_cuts").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()  # a row a piece
    places = common.literal_table(spark, dealt([tuple(r) for r in sums], shards), "_unit: int, _piece: bigint, shard: int, first: bigint")
    inside = F.row_number().over(Window.partitionBy("_unit", "_piece").orderBy("_key", "_id", "_row")) - 1
    out = ranged.withColumn("_inside", inside).join(F.broadcast(places), ["_unit", "_piece"])
    return out.select("_rest.*", "size", "text_crc32", "shard", (F.col("first") + F.col("_inside")).cast("long").alias("slot"))


def write(df: DataFrame, path: str, rows_per_file: int = 100_000, **how: object) -> None:
    """Writes df's rows, texts included, as Parquet under path, a folder shard=N for each shard and in it a file for so many slots."""
    spark = df.sparkSession
    scratch = common.Scratch(spark)
    numbered = scratch.table(df.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    places = shard(numbered, **how).select("__row", "shard", "slot")
    whole = numbered.join(places, "__row").drop("__row")
    chunk = F.floor(F.col("slot") / rows_per_file)
    dealt_out = whole.repartition(common.shuffle_partitions(spark), "shard", chunk).sortWithinPartitions("shard", "slot")
    dealt_out.write.partitionBy("shard").option("maxRecordsPerFile", rows_per_file).parquet(path)
    scratch.drop(numbered)


def op13_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of nearly equal bytes, so no row has a grown shard."""
    out = shard(common.documents(spark, sf_dir), SHARDS)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
