"""Sinks: delimited tables, matrices, bedGraph, BED, track lines and summaries."""

from __future__ import annotations

import html

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def tsv(df: DataFrame, path: str, compression: str = "none", sep: str = "\t") -> None:
    """Header, NA for null; an empty result still has a header (one empty partition is written)."""
    out = df if not df.isEmpty() else df.coalesce(1)
    out.write.option("sep", sep).option("nullValue", "NA").option("emptyValue", "").option("compression", compression).csv(path, header=True, mode="overwrite")


def csv(df: DataFrame, path: str) -> None:
    tsv(df, path, sep=",")


def wide_matrix(counts: DataFrame, regions: DataFrame, keys: list[str], value: str = "n") -> DataFrame:
    """Region columns and a column a sample, in sheet order."""
    return regions.select("region_id", "chrom", "start_pos", "end_pos").join(
        counts.groupBy("region_id").pivot("sample_key", keys).agg(F.first(value)), "region_id"
    )


def bedgraph(tracks: DataFrame, path: str, parts: int | None = None) -> DataFrame:
    """Sorted tracks in folders family=.../sample_key=..., and the manifest of their files.

    Rows are range-partitioned by family, sample, chromosome and start, so a long track is several files and no task holds a
    chromosome; files of a folder hold consecutive ranges in the order of their names, and joined in that order they are one
    sorted bedGraph.  The manifest has for each file its rows and its first and last place.
    """
    spark = tracks.sparkSession
    order = ["family", "sample_key", "chrom", "start_pos"]
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = tracks.select(*order, "end_pos", "score").repartitionByRange(n, *order).sortWithinPartitions(*order)
    rows.write.partitionBy("family", "sample_key").option("sep", "\t").csv(path, mode="overwrite")
    back = spark.read.option("sep", "\t").schema("chrom string, start_pos long, end_pos long, score double, family string, sample_key string").csv(path)
    place, end = F.struct("chrom", "start_pos"), F.struct("chrom", "end_pos")
    by = back.groupBy("family", "sample_key", F.col("_metadata.file_name").alias("file"))
    found = by.agg(F.count("*").alias("rows"), F.min(place).alias("f"), F.max(end).alias("l"))
    part = F.row_number().over(Window.partitionBy("family", "sample_key").orderBy("file"))  # a row a file
    return found.select(
        "family", "sample_key", part.alias("part"), "file", "rows", F.col("f.chrom").alias("first_chrom"), F.col("f.start_pos").alias("first_start"),
        F.col("l.chrom").alias("last_chrom"), F.col("l.end_pos").alias("last_end")
    )


def bed(df: DataFrame, path: str, name: str | None = None) -> None:
    df.select("chrom", "start_pos", "end_pos", *([name] if name else [])).write.option("sep", "\t").csv(path, mode="overwrite")


#: Track kinds by name: a pattern, a description and a colour; the first that fits.  Fixed values.
TRACKS = [
    ("_dm6_StringentRaw$", "raw stringent dm6 coverage", "90,90,90"), ("_dm6_StringentCPM$", "dm6 CPM profile control", "40,140,90"),
    ("_SpikeInDM6_Stringent$", "dm6-calibrated stringent host coverage", "210,110,20"), ("_DESeq2RobustCPM($|_)", "DESeq2 robust CPM", "120,50,160"),
    ("_DESeq2Consensus$", "DESeq2 consensus-peak normalized", "180,50,50"), ("_CPM$", "counts per million", "40,90,180")
]


def track_line(name: Column, prefix: str, url_base: str = "") -> Column:
    text, colour = F.lit("bigWig"), F.lit("80,80,80")
    for pattern, t, c in reversed(TRACKS):
        text, colour = F.when(name.rlike(pattern), t).otherwise(text), F.when(name.rlike(pattern), c).otherwise(colour)
    base = url_base.rstrip("/") + "/" if url_base else ""
    return F.format_string(
        f'track type=bigWig name="%s" description="{prefix} %s: %s" bigDataUrl={base}%s.bw visibility=full autoScale=on alwaysZero=on color=%s', name,
        text, name, name, colour
    )


def differential_totals(summary: DataFrame) -> DataFrame:
    ok = F.col("status") == "SUCCESS"
    return summary.agg(
        F.count("*").alias("analysis_rows"), F.count_if(ok).alias("completed"),
        F.coalesce(
            F.sum(F.when(ok, F.coalesce(F.floor(F.col("significant_sites").try_cast("double")), F.lit(0)))), F.lit(0)
        ).cast("long").alias("significant_calls")
    )


def differential_html(summary: DataFrame, columns: list[str]) -> str:
    """The summary (a row a comparison) as an HTML table with escaped cells."""
    t = differential_totals(summary).first()
    rows = "".join("<tr>" + "".join(f"<td>{html.escape('NA' if v is None else str(v))}</td>" for v in r) + "</tr>" for r in summary.select(*columns).collect())
    head = "".join(f"<th>{html.escape(c)}</th>" for c in columns)
    return f"<html><body><p>{t.analysis_rows} rows, {t.completed} completed, {t.significant_calls} significant calls</p><table><tr>{head}</tr>{rows}</table></body></html>"


def row_checksum(*columns: str) -> Column:
    """Order-free checksum of a table's rows: their number and the sum of the first 60 bits of their MD5."""
    text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("NA")) for c in columns])
    bits = F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("decimal(38,0)")
    return F.sha2(F.concat_ws(":", F.count("*").cast("string"), F.coalesce(F.sum(bits), F.lit(0)).cast("string")), 256)


def provenance(df: DataFrame, fields: dict[str, str]) -> DataFrame:
    """(field, value) rows of parameters with a checksum of the input's rows."""
    total = df.agg(row_checksum(*df.columns).alias("value")).select(F.lit("input_checksum").alias("field"), "value")
    return df.sparkSession.createDataFrame(sorted(fields.items()), "field string, value string").unionByName(total)
