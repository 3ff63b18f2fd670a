"""Alignment-record policies: flags, MAPQ, contigs, signal units, duplicates, pair repair and the filter funnel."""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: (include, exclude) flag masks.  Fixed values of the policies.
POLICIES = {("stringent", "PE"): (2, 3852), ("stringent", "SE"): (0, 3844), ("sensitivity", "PE"): (2, 2828), ("sensitivity", "SE"): (0, 2820)}
AUTOSOMES = {"hg38": 22, "mm39": 19}
MITO = ("chrM", "MT", "M")
FILTERING = [("permissive", "aligned", False, 0), ("intermediate", "aligned", True, 0), ("stringent", "filtered", True, 30)]


def canonical_names(genome: str = "hg38") -> list[str]:
    names = [*[str(i) for i in range(1, AUTOSOMES[genome] + 1)], "X", "Y"]
    return [f"chr{n}" for n in names] + names


def flags_pass(include: int, exclude: int, flag: str = "flag") -> Column:
    return (F.col(flag).bitwiseAND(F.lit(include)) == include) & (F.col(flag).bitwiseAND(F.lit(exclude)) == 0)


def policy(name: str, layout: str, min_mapq: int = 30) -> Column:
    return flags_pass(*POLICIES[name, layout]) & (F.col("mapq") >= min_mapq)


def is_canonical(genome: str = "hg38", chrom: str = "chrom") -> Column:
    return F.col(chrom).isin(canonical_names(genome))


def is_mito(chrom: str = "chrom") -> Column:
    return F.col(chrom).isin(*MITO)


def signal_units(df: DataFrame, layout: str) -> DataFrame:
    """PE: first mates of proper pairs over the whole insert; SE: mapped reads over their aligned span (ref_end)."""
    mapped = F.col("flag").bitwiseAND(F.lit(4)) == 0
    if layout == "PE":
        return df.filter((F.col("flag").bitwiseAND(F.lit(66)) == 66) & mapped).withColumn("end_pos", F.col("start_pos") + F.abs("tlen"))
    if layout == "SE":
        return df.filter(mapped)
    raise ValueError(f"unknown layout {layout}")


def inferred_layout(df: DataFrame) -> DataFrame:
    return df.groupBy("sample_key").agg(F.when(F.max(F.col("flag").bitwiseAND(F.lit(1))) == 1, "PE").otherwise("SE").alias("layout"))


def fragment_lengths(df: DataFrame) -> DataFrame:
    return df.withColumn("length", F.abs(F.col("tlen").try_cast("long"))).filter("length > 0")


def split_species(df: DataFrame, prefix: str = "dm6__", genome: str = "hg38") -> DataFrame:
    """species: spike for prefixed contigs (prefix stripped), host for canonical ones; others go."""
    spike = F.col("chrom").startswith(prefix)
    out = df.withColumn("species", F.when(spike, "spike").when(is_canonical(genome), "host"))
    return out.filter("species is not null").withColumn("chrom", F.regexp_replace("chrom", f"^{prefix}", ""))


def missing_contigs(df: DataFrame, wanted: list[str]) -> list[str]:
    """Configured contigs that no record names; the list of names is the caller's."""
    seen = {r[0] for r in df.select("chrom").filter(F.col("chrom").isin(wanted)).distinct().collect()}
    return [c for c in wanted if c not in seen]


def harmonise(df: DataFrame, reference: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Adds or strips `chr` if, and only if, the two tables share no contig name.  Contig names are few."""
    ours, theirs = df.select(chrom).distinct(), reference.select(chrom).distinct()
    if not ours.intersect(theirs).isEmpty():
        return df
    prefixed = theirs.filter(F.col(chrom).startswith("chr")).limit(1).count() == 1
    if prefixed:
        return df.withColumn(chrom, F.when(F.col(chrom).startswith("chr"), F.col(chrom)).otherwise(F.concat(F.lit("chr"), chrom)))
    return df.withColumn(chrom, F.regexp_replace(chrom, "^chr", ""))


def first_per_key(df: DataFrame, keys: list[str], *order: str) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def mark_duplicates(
    df: DataFrame, keys: tuple[str, ...] = ("sample_key", "chrom", "start_pos", "end_pos", "strand"), quality: str = "quality", name: str = "qname"
) -> DataFrame:
    """is_dup: not the best of its key (5' ends and strands), ties by read name.  Unmapped records are never duplicates."""
    w = Window.partitionBy(*keys).orderBy(F.col(quality).desc(), name)
    return df.withColumn("is_dup", (F.row_number().over(w) > 1) & (F.col("flag").bitwiseAND(F.lit(4)) == 0))


def complete_pairs(df: DataFrame, keys: tuple[str, ...] = ("sample_key", "qname"), least: int = 2) -> DataFrame:
    """Drops pairs that have lost a mate."""
    return df.withColumn("_n", F.count("*").over(Window.partitionBy(*keys))).filter(F.col("_n") == least).drop("_n")


def mates(df: DataFrame, read_length: int = 50) -> DataFrame:
    """The two aligned ranges of each pair, not the gap between them."""
    n = F.least(F.lit(read_length), F.abs("tlen"))
    pair = F.array(
        F.struct(F.lit(1).alias("mate"), F.col("start_pos").alias("s"), (F.col("start_pos") + n).alias("e")),
        F.struct(F.lit(2).alias("mate"), (F.col("end_pos") - n).alias("s"), F.col("end_pos").alias("e"))
    )
    rest = [c for c in df.columns if c not in ("start_pos", "end_pos")]
    return df.withColumn("_m", F.explode(pair)).select(
        *rest, F.col("_m.mate").alias("mate"), F.col("_m.s").cast("long").alias("start_pos"), F.col("_m.e").cast("long").alias("end_pos")
    )


def funnel(df: DataFrame, stages: list[tuple[str, Column]], key: str = "sample_key") -> DataFrame:
    """Records left after each stage, in one pass; a stage counts what all stages up to it keep."""
    passed, out = F.lit(True), [F.count("*").alias("total")]
    for name, test in stages:
        passed = passed & test
        out.append(F.count_if(passed).alias(name))
    return df.groupBy(key).agg(*out)


def filtering_policies(df: DataFrame, canonical: Column, dup: Column) -> DataFrame:
    """Each record once for every policy that keeps it: MAPQ threshold and duplicate rule by policy."""
    spark = df.sparkSession
    table = F.broadcast(spark.createDataFrame([(n, d, q) for n, _, d, q in FILTERING], "policy string, drop_dups boolean, min_mapq int"))  # three rows
    kept = df.filter(canonical & flags_pass(*POLICIES["sensitivity", "PE"])).withColumn("_dup", dup)
    return kept.join(table, (F.col("mapq") >= F.col("min_mapq")) & ~(F.col("drop_dups") & F.col("_dup"))).drop("_dup", "drop_dups", "min_mapq")


#: Letters that have no ASCII base letter, as transliteration writes them.  Fixed values.
LETTERS = {
    "ß": "ss", "Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "Ø": "O", "ø": "o", "Đ": "D", "đ": "d", "Ð": "D", "ð": "d", "Þ": "TH", "þ": "th", "Ł": "L",
    "ł": "l", "ı": "i"
}


def base_letters() -> dict[str, str]:
    """ASCII letters of the Latin letters that are one with marks, by their compatibility decomposition without marks."""
    out = {}
    for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]):
        plain = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if len(plain) == 1 and plain.isascii() and plain.isalpha():
            out[c] = plain
    return out


def ascii_letters(value: Column) -> Column:
    """Latin letters without their marks, loose marks dropped, and LETTERS spelled out; what has no such form stays."""
    table = base_letters()
    out = F.translate(F.regexp_replace(value, r"\p{Mn}+", ""), "".join(table), "".join(table.values()))
    for letter, text in LETTERS.items():
        out = F.replace(out, F.lit(letter), F.lit(text))
    return out


def safe_token(value: Column) -> Column:
    """ASCII letters, digits, dots, hyphens and underscores, 60 at most; `condition` if none is left."""
    token = F.regexp_replace(ascii_letters(value), r"[^A-Za-z0-9._-]+", "_")
    token = F.regexp_replace(token, r"^_+|_+$", "")
    return F.when(token == "", "condition").otherwise(F.substring(token, 1, 60))


def is_atac(assay: str = "assay") -> Column:
    return F.lower(assay).startswith("atac")


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)
