"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

Each document gets a key -ln(u) / w with u uniform in (0, 1) from a hash of its id and text, and w its quality weight.
Sorted by key, a source's documents are a weighted sample without replacement of any length.  A source's target in words
is first met by whole epochs (every document once each); the rest goes to documents in key order, up to the prefix whose
sum is nearest to what is missing.

Targets: the total times `share`, split by the sources' weights; a target stops at `most_epochs` times its source's size
and the excess is shared again by weight among the others, until none is above.

Scale: sorting a source in one task would not do when one source holds a third of all rows.  Rows are range-partitioned by
source and key, at sampled quantiles, so ranges are even whatever the weights are; prefix sums run inside a range, then
over a source's ranges.  No task gets more than a range or a source's list of ranges.  Sums are of integers, so results
depend neither on where ranges are cut nor on the order in which tasks end.

Cases: a null or empty text has size 0 and is never taken.  A null source is a source of its own, last in the order.  A
null weight, or one not above 0, sends a document to the end of its source's order; there -ln(u) orders.  Repeated rows
(same id, same text) are documents each; their keys tie, ties are broken by size, and rows equal in all of these are
interchangeable.  An empty table gives an empty result.  Other columns pass through; the added ones replace like-named ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import common

WORD = r"[^\x20\x09-\x0D]+"
#: What quality() does not count: all but letters that are not upper case, marks and white space.
OTHER = r"[^\p{Ll}\p{Lo}\p{Lm}\p{M}\x20\x09-\x0D]+"


def quality(text: str = "text") -> F.Column:
    """A text's weight: the share of its characters that are letters (not upper case), marks or white space, to the power 8.

    Prose has about 0.7, shouting or words with symbols 0 to 0.1.  Null for an empty or null text.
    """
    return F.pow(F.try_divide(F.length(F.regexp_replace(text, F.lit(OTHER), F.lit(""))), F.length(text)), F.lit(8.0))


#: The same in DuckDB SQL.
QUALITY_SQL = f"pow(length(regexp_replace(text, '{OTHER}', '', 'g')) / nullif(length(text), 0), 8)"


def uniform(*columns: str, seed: int = 0) -> F.Column:
    """In (0, 1), from the first 48 bits of an MD5."""
    digest = F.md5(F.concat_ws("\x01", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("\x02")) for c in columns]))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def target_table(sizes: DataFrame, weights: list[int], share: float, most_epochs: int, scratch: common.Scratch) -> DataFrame:
    """sizes: (source, source_size, n_docs), a row a source.  Adds the weight by rank of the source's code points and the target."""
    n = common.shuffle_partitions(sizes.sparkSession)
    ranked = scratch.table(sizes.withColumn("_null", F.col("source").isNull()).repartitionByRange(n, "_null", "source").withColumn("_part", F.spark_partition_id()), "sources")
    counts = ranked.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))  # a row a partition
    rank = F.col("_before") + F.row_number().over(Window.partitionBy("_part").orderBy("_null", "source")) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod(rank, F.lit(len(weights))) + 1).cast("int"))
    out = scratch.table(ranked.join(before, "_part").select("source", "source_size", "n_docs", weight.cast("long").alias("weight"), (F.col("source_size") * most_epochs).alias("cap")), "weights")
    total = out.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0  # words for a unit of weight
    capped = None
    while True:
        full = (F.col("cap") == 0) | (F.col("cap") <= F.lit(level) * F.col("weight"))
        r = out.agg(F.sum(F.when(full, F.col("cap"))), F.sum(F.when(~full, F.col("weight"))), F.count_if(full)).first()
        if r[2] == capped or not r[1]:
            break
        capped, level, left, units = r[2], (share * total - (r[0] or 0)) / r[1], share * total - (r[0] or 0), r[1]
    if capped is None:
        left, units = 0.0, 1
    target = F.when(full, F.col("cap").cast("double")).otherwise(F.lit(float(left)) * F.col("weight") / F.lit(float(units)))
    return scratch.table(out.select("source", "source_size", "n_docs", "weight", target.alias("target")), "targets")


def in_ranges(docs: DataFrame, n: int) -> DataFrame:
    """Adds _range, growing with source, key, id and size; rows equal in all of these are dealt by their number."""
    return docs.repartitionByRange(n, "_source", "_last", "_key", "_id", "size", "_row").withColumn("_range", F.spark_partition_id())


def mix(df: DataFrame, weights: list[int], share: float = 1.5, most_epochs: int = 2, id_column: str = "doc_id", text: str = "text", source: str = "source", quality: F.Column | None = None, seed: int = 0) -> DataFrame:
    """One row per row of df with its columns and size, source_size, target and taken (words, repeats counted); see epochs().

    Rows' long texts take no part in the shuffles: the result has the columns of df but for `text`.
    """
    spark = df.sparkSession
    scratch = common.Scratch(spark)
    rest = [c for c in df.columns if c not in (text, "size", "source_size", "target", "taken")]
    w = F.lit(1.0) if quality is None else quality.cast("double")
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    # the rows' own columns travel in one struct, so none of their names can clash
    docs = df.select(F.struct(*rest).alias("_rest"), F.col(id_column).alias("_id"), size.alias("size"), (-F.log(uniform(id_column, text, seed=seed))).alias("_key"), w.alias("_w"), F.col(source).alias("_source"), F.monotonically_increasing_id().alias("_row"))
    docs = docs.withColumn("_last", ~F.coalesce((F.col("_w") > 0) & ~F.isnan("_w"), F.lit(False)))
    docs = scratch.table(docs.withColumn("_key", F.when(F.col("_last"), F.col("_key")).otherwise(F.try_divide("_key", "_w"))).drop("_w"), "sized")
    sizes = docs.groupBy(F.col("_source").alias("source")).agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    targets = target_table(sizes, weights, share, most_epochs, scratch).withColumnRenamed("source", "_s")
    ranged = scratch.table(in_ranges(docs, common.shuffle_partitions(spark)), "ranges")
    spread = ranged.withColumn("_salt", F.pmod(F.xxhash64("_key"), F.lit(64)))
    copies = targets.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(63).cast("long"))))
    docs = spread.join(copies, F.col("_source").eqNullSafe(F.col("_s")) & (spread._salt == copies._salt)).drop("_s", "_salt")
    sums = ranged.groupBy("_source", "_range").agg(F.sum("size").alias("_sum"))
    before = sums.select(F.col("_source").alias("_s"), F.col("_range").alias("_r"), (F.sum("_sum").over(Window.partitionBy("_source").orderBy("_range")) - F.col("_sum")).alias("_before"))
    inside = Window.partitionBy("_source", "_range").orderBy("_last", "_key", "_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    docs = docs.withColumn("_inside", F.sum("size").over(inside) - F.col("size"))
    docs = docs.join(before, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_range") == F.col("_r")))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    missing = F.col("target") - whole * F.col("source_size")
    once_more = (F.col("_before") + F.col("_inside") + F.col("size") / 2 <= missing).cast("long")
    taken = F.when(F.col("size") > 0, (whole + once_more) * F.col("size")).otherwise(0).cast("long")
    return docs.withColumn("taken", taken).select("_rest.*", "size", "source_size", "target", "taken")


def epochs(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as it is taken (the epoch in `epoch`, from 0), rows not taken left out."""
    n = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return mixed.filter(n > 0).withColumn("epoch", F.explode(F.sequence(F.lit(0), n - 1)))


WEIGHTS, SHARE, MOST_EPOCHS = [5, 2, 1], 1.5, 2


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys scaled by quality(), so better documents are taken before others."""
    return mix(common.documents(spark, sf_dir), WEIGHTS, SHARE, MOST_EPOCHS, quality=quality()).select("doc_id", "size", "source_size", "target", "taken")


def mixing_unweighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with every weight 1."""
    return mix(common.documents(spark, sf_dir), WEIGHTS, SHARE, MOST_EPOCHS).select("doc_id", "size", "source_size", "target", "taken")


def mix_sql(docs: str, columns: str, quality: str | None = None) -> str:
    """DuckDB SQL for mix() over a table or subquery of documents."""
    if quality is not None:
        weighted = f"(SELECT *, {quality} AS w FROM {docs})"
        plain = mix_sql(weighted, columns)
        return plain.replace("ORDER BY k, doc_id", "ORDER BY coalesce(w > 0, false) DESC, CASE WHEN w > 0 THEN k / w ELSE k END, doc_id")
    caps = f"cap = 0 OR cap <= level * weight"
    return f"""
WITH RECURSIVE d AS (SELECT *, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
  -ln((('0x' || substr(md5('0' || chr(1) || coalesce(doc_id::VARCHAR, chr(2)) || chr(1) || coalesce(text, chr(2))), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0) AS k FROM {docs}),
s AS (SELECT source, sum(size)::BIGINT AS source_size, (CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END)::BIGINT AS weight, sum(size)::BIGINT * 2 AS cap FROM d GROUP BY source),
fill AS (SELECT 0 AS round, 0.0::DOUBLE AS level, 0.0::DOUBLE AS remaining, 1.0::DOUBLE AS units UNION ALL
  SELECT round + 1, remaining2 / greatest(units2, 1), remaining2, units2 FROM (SELECT f.round,
    (SELECT 1.5 * sum(source_size)::DOUBLE - coalesce(sum(cap) FILTER ({caps}), 0)::DOUBLE FROM s) AS remaining2,
    (SELECT coalesce(sum(weight) FILTER (NOT ({caps})), 0)::DOUBLE FROM s) AS units2 FROM fill f WHERE round < 60)),
l AS (SELECT * FROM fill ORDER BY round DESC LIMIT 1),
t AS (SELECT s.*, CASE WHEN {caps} THEN cap::DOUBLE ELSE remaining * weight::DOUBLE / units END AS target FROM s, l),
x AS (SELECT d.*, t.source_size, t.target, CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
  sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id, d.size ROWS UNBOUNDED PRECEDING) - d.size AS prefix FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
y AS (SELECT *, (CASE WHEN size > 0 THEN (whole + CASE WHEN prefix + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END) * size ELSE 0 END)::BIGINT AS taken FROM x)
SELECT {columns} FROM y"""


SQL = mix_sql("documents", "doc_id, size, source_size, target, taken", QUALITY_SQL)
UNWEIGHTED_SQL = mix_sql("documents", "doc_id, size, source_size, target, taken")
