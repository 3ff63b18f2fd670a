"""The given tables read as sequencing tables: fragments, peaks, genes, exons, regulatory elements, blacklist, samples.

The expressions are integer arithmetic that Spark and DuckDB evaluate alike, so each table is also available as a CTE.
"""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

CONDITIONS = ["stem", "stem", "prolif", "prolif", "Day4", "Day4", "solo"]
KEYS = [f"{c}_bioR{1 + CONDITIONS[:i].count(c)}" for i, c in enumerate(CONDITIONS)]


def chrom(k: str) -> str:
    return (
        f"CASE WHEN {k} % 26 < 22 THEN concat('chr', CAST({k} % 26 + 1 AS STRING)) WHEN {k} % 26 = 22 THEN 'chrX' WHEN {k} % 26 = 23 THEN 'chrY' "
        f"WHEN {k} % 26 = 24 THEN 'chrM' ELSE 'chrUn_A' END"
    )


def sample_key(n: str) -> str:
    return "CASE " + " ".join(f"WHEN {n} % 7 = {i} THEN '{k}'" for i, k in enumerate(KEYS)) + " END"


_START = "((l_partkey * 1000) % 200000 + CAST(floor(l_quantity) AS BIGINT) * 7)"
_TLEN = "(20 + (l_orderkey * 31 + l_linenumber * 17) % 700)"
_MAPQ = "((CAST(floor(l_tax * 100 + 0.5) AS BIGINT) * 5) % 43)"
TABLES: dict[str, tuple[str, list[str]]] = {
    "frag": ("lineitem", [
        f"{sample_key('l_suppkey')} AS sample_key",
        (
            "concat_ws(':', CAST(l_orderkey AS STRING), CAST(l_linenumber AS STRING), CAST(l_partkey AS STRING), CAST(l_suppkey AS STRING), "
            "CAST(CAST(floor(l_quantity) AS BIGINT) AS STRING), CAST(CAST(floor(l_extendedprice * 100 + 0.5) AS BIGINT) AS STRING)) AS qname"
        ),
        f"{chrom('l_partkey')} AS chrom", f"{_START} AS start_pos", f"{_START} + {_TLEN} AS end_pos", f"{_TLEN} AS tlen", f"{_MAPQ} AS mapq",
        (
            "CASE WHEN l_linestatus = 'O' THEN 99 ELSE 83 END + CASE WHEN l_returnflag = 'R' AND l_linenumber = 1 THEN 1024 ELSE 0 END + CASE WHEN "
            "l_linenumber = 7 THEN 256 ELSE 0 END AS flag"
        ),
        "CASE WHEN l_linestatus = 'O' THEN '+' ELSE '-' END AS strand", "(l_orderkey % 5 = 0) AS has_xs", "CAST(floor(l_extendedprice) AS BIGINT) AS quality",
        "(l_partkey % 13 = 0) AS is_spike"]),
    "peaks": ("orders", [
        f"{sample_key('o_orderkey')} AS sample_key", f"{chrom('o_custkey')} AS chrom",
        "(o_custkey * 1000) % 200000 + (o_orderkey % 5) * 50 AS start_pos", "(o_custkey * 1000) % 200000 + (o_orderkey % 5) * 50 + 200 + o_orderkey % 300 AS end_pos",
        "o_totalprice / 1000 AS signal", "CASE WHEN o_orderstatus <> 'P' THEN 'narrow' ELSE 'broad' END AS peak_type", "o_orderkey AS peak_no"]),
    "genes": ("part", [
        "p_partkey AS gene_id", "concat('G', CAST(p_partkey AS STRING)) AS gene_name", f"{chrom('p_partkey')} AS chrom", "(p_partkey * 1000) % 200000 + 300 AS start_pos",
        "(p_partkey * 1000) % 200000 + 300 + 200 * CAST(p_size AS BIGINT) AS end_pos", "CASE WHEN p_partkey % 2 = 0 THEN '+' ELSE '-' END AS strand"]),
    "ccre": ("customer", [
        "concat('cc', CAST(c_custkey AS STRING)) AS ccre_id", f"{chrom('(c_custkey * 7)')} AS chrom", "(c_custkey * 911) % 200000 AS start_pos", "(c_custkey * 911) % 200000 + 150 + c_custkey % 200 AS end_pos",
        (
            "CASE c_mktsegment WHEN 'BUILDING' THEN 'PLS' WHEN 'AUTOMOBILE' THEN 'pELS' WHEN 'MACHINERY' THEN 'dELS' WHEN 'HOUSEHOLD' THEN "
            "'CA-CTCF' ELSE 'CA' END AS ccre_class"
        )]),
    # a sheet of runs: mostly in order, with rows that break each rule
    "sheet": ("customer", [
        "CAST(c_custkey AS BIGINT) AS row", "concat(' S', CAST(c_custkey % 997 AS STRING)) AS sample_id", "CAST(c_custkey % 3 + 1 AS STRING) AS replicate",
        "CASE WHEN c_custkey % 103 = 0 THEN 'one' ELSE CAST(c_custkey % 2 + 1 AS STRING) END AS tech_replicate",
        "CASE WHEN c_custkey % 113 = 0 THEN '' ELSE 'a.fq' END AS fastq_1", "CASE WHEN c_custkey % 5 = 0 THEN '' ELSE 'b.fq' END AS fastq_2",
        "CASE WHEN c_custkey % 101 = 0 THEN 'XX' WHEN c_nationkey % 7 = 0 THEN 'se' ELSE 'PE' END AS layout",
        "CASE WHEN c_custkey % 89 = 0 THEN 'hg19' ELSE 'hg38' END AS genome", "CASE WHEN c_mktsegment = 'BUILDING' THEN 'ATAC-seq' ELSE 'ChIP-seq' END AS assay",
        "lower(c_mktsegment) AS factor", "concat('c', CAST(c_nationkey AS STRING)) AS condition", "'none' AS treatment", "concat('k', CAST(c_custkey % 4 AS STRING)) AS cell_type",
        "CASE WHEN c_custkey % 11 = 0 THEN 'TRUE' WHEN c_custkey % 211 = 0 THEN 'maybe' ELSE 'no' END AS is_control",
        "CASE WHEN c_custkey % 4 = 0 THEN concat('S', CAST((c_custkey * 7) % 997 AS STRING)) ELSE '' END AS control_id",
        "CASE c_custkey % 4 WHEN 0 THEN 'narrow' WHEN 1 THEN 'Broad' WHEN 2 THEN 'both' ELSE 'none' END AS macs2_mode",
        "'x.bed' AS blacklist", "concat('p', CAST(c_custkey AS STRING)) AS output_prefix",
        "CASE WHEN c_custkey % 6 = 0 THEN 'dm6' WHEN c_custkey % 307 = 0 THEN 'dm3' ELSE NULL END AS spikein_genome",
        (
            "CASE WHEN c_custkey % 30 = 0 THEN 'nan' WHEN c_custkey % 6 = 0 THEN '0.5' WHEN c_custkey % 311 = 0 THEN '1' ELSE '' END AS "
            "spikein_to_host_ratio"
        ),
        "CASE WHEN c_custkey % 42 = 0 THEN 'pre_tagmentation' WHEN c_custkey % 6 = 0 THEN ' Pre_tagmentation_nuclei' ELSE '' END AS spikein_stage"]),
    "reads": ("lineitem", [
        f"{sample_key('l_orderkey')} AS sample_key", "CAST(l_orderkey AS STRING) AS read_id", "CAST(l_linenumber AS INT) AS mate",
        (
            f"substr('{'ACGTTGCAAGCTTACGNACGGATCGGCATTAGCCATCTGTCTCTTATACACATCTGGATTACA' * 2}', CAST(1 + l_orderkey % 55 AS INT), CAST(16 + "
            "l_linenumber * 5 AS INT)) AS seq"
        ),
        (
            "concat(repeat('I', CAST(11 + l_linenumber * 5 AS INT)), CASE WHEN CAST(floor(l_quantity) AS BIGINT) % 2 = 1 THEN '#####' ELSE 'IIIII' "
            "END) AS qual"
        )]),
    "blacklist": (
        "supplier",
        [f"{chrom('(s_suppkey * 3)')} AS chrom", "(s_suppkey * 1777) % 200000 AS start_pos", "(s_suppkey * 1777) % 200000 + 500 AS end_pos"]
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = TABLES[name]
    return spark.read.parquet(f"{sf_dir}/{source}.parquet").selectExpr(*columns)


_local: str | None = None


def folder(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, or below a local folder that goes with the process, for a local master only."""
    global _local
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not shared and _local is None:
        _local = tempfile.mkdtemp(prefix="peakloom-")
        atexit.register(shutil.rmtree, _local, ignore_errors=True)
    return os.path.join(shared or _local, f"{name}-{uuid.uuid4().hex}")


def kept(df: DataFrame, name: str) -> DataFrame:
    """df as a written table, for results that several parts of a query read: planned and made once, and its size is known."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Folder and schema of the tables that shared() wrote in this application, by name and by what they were made of.
_shared: dict[tuple, tuple[str, StructType]] = {}


def shared(spark: SparkSession, sf_dir: str, name: str, sources: tuple[str, ...], build: Callable[[], DataFrame]) -> DataFrame:
    """A written table that several queries of an application read, made by the first that asks.

    It is made again if a source's files are others than they were (by path, length and time), or if its folder is gone."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def files(path: str) -> tuple:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        return tuple((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(p)) if fs.exists(p) else ()

    key = (spark.sparkContext.applicationId, name, *(files(f"{sf_dir}/{t}.parquet") for t in sources))
    if key not in _shared or not files(_shared[key][0]):
        df, path = build(), folder(spark, name)
        df.write.parquet(path)
        _shared[key] = path, df.schema
    path, schema = _shared[key]
    return spark.read.schema(schema).parquet(path)


def exons(genes: DataFrame) -> DataFrame:
    third, sixth = F.floor((F.col("end_pos") - F.col("start_pos")) / 3), F.floor((F.col("end_pos") - F.col("start_pos")) / 6)
    e = genes.withColumn("i", F.explode(F.array(*[F.lit(x).cast("long") for x in range(3)])))
    return e.select(
        "gene_id", "chrom", (F.col("start_pos") + F.col("i") * third).alias("start_pos"),
        (F.col("start_pos") + F.col("i") * third + F.greatest(sixth, F.lit(1))).alias("end_pos")
    )


def samples(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        [(i, k, c, int(k[-1])) for i, (k, c) in enumerate(zip(KEYS, CONDITIONS, strict=True))],
        "sheet_order int, sample_key string, condition string, replicate int"
    ).coalesce(1)


def cte(*names: str) -> str:
    """CTE text for DuckDB, with `WITH`; `samples` and `exons` are known as well."""
    out = []
    for n in names:
        if n == "samples":
            rows = ", ".join(f"({i}, '{k}', '{c}', {int(k[-1])})" for i, (k, c) in enumerate(zip(KEYS, CONDITIONS, strict=True)))
            out.append(f"samples(sheet_order, sample_key, condition, replicate) AS (VALUES {rows})")
        elif n == "exons":
            out.append(
                "exons AS (SELECT gene_id, chrom, start_pos + i * CAST(floor((end_pos - start_pos) / 3) AS BIGINT) AS start_pos, start_pos + i * "
                "CAST(floor((end_pos - start_pos) / 3) AS BIGINT) + greatest(CAST(floor((end_pos - start_pos) / 6) AS BIGINT), 1) AS end_pos FROM "
                "genes, (VALUES (0), (1), (2)) t(i))"
            )
        else:
            source, columns = TABLES[n]
            out.append(f"{n} AS (SELECT {', '.join(columns)} FROM {source})")
    return "WITH " + ", ".join(out)


def canonical_sql(column: str = "chrom", autosomes: int = 22) -> str:
    return f"{column} IN ({', '.join(repr(c) for c in [*[f'chr{i}' for i in range(1, autosomes + 1)], 'chrX', 'chrY'])})"
