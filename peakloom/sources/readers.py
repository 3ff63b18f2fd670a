"""Readers of the domain's text formats.  All parsing is columnar; nothing is collected except where noted as tiny."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .fastq_source import FastqSource

#: Regulatory class names in the order they are tried.  Fixed values.
CLASSES = ["PLS", "pELS", "dELS", "DNase-H3K4me3", "CA-CTCF", "CA-H3K4me3", "CA-TF", "CTCF-only", "CTCF-bound", "CA", "TF"]
#: Parts of metric names that are kept from nested metrics.  Fixed values.
METRIC_TOKENS = ["tss", "short_mononucleosomal", "fragment_length", "duplicate", "mitochondri"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).withColumn("value", F.regexp_replace("value", "\r$", ""))


def _placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with _place, which orders them by file path, then as they stand in the file, however files are split: the block that
    a split begins at, then the line's number in the task, which rises inside a block."""
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    return spark.read.text(path).select(F.regexp_replace("value", "\r$", "").alias("value"), place.alias("_place"))


def _numbered(df: DataFrame) -> DataFrame:
    """Adds _no, from 1 in the order of _place: the row's number in its block and the rows of the blocks before.  Only the table
    of a row a block is sorted in one task."""
    by = {"_file": F.col("_place.file"), "_block": F.col("_place.block")}
    df = df.withColumns(by)
    counts = df.groupBy(*by).agg(F.count("*").alias("_n"))
    before = counts.select(*by, (F.sum("_n").over(Window.orderBy("_file", "_block")) - F.col("_n")).alias("_before"))
    inside = F.row_number().over(Window.partitionBy("_file", "_block").orderBy("_place.line"))
    return df.withColumn("_inside", inside).join(before, ["_file", "_block"]).withColumn("_no", F.col("_before") + F.col("_inside")).drop("_file", "_block", "_before", "_inside")


def _fields(df: DataFrame, sep: str = "\t") -> DataFrame:
    return df.withColumn("f", F.split("value", sep))


def samplesheet(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV, blanks and quotes stripped: columns as the header names them, all strings (null for an empty cell), and row.

    row counts the file's lines from 2, the first after the header.  A sheet has a row a sequencing run, so one task numbers it.
    """
    df = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    row = F.row_number().over(Window.orderBy(F.monotonically_increasing_id())) + 1
    return df.select(row.cast("long").alias("row"), *[F.trim(F.regexp_replace(F.col(f"`{c}`"), '^"|"$', "")).alias(c.strip().strip('"')) for c in df.columns])


def alignments(spark: SparkSession, path: str) -> DataFrame:
    """SAM text: the 11 fixed columns and a map of tags; positions 0-based."""
    f = _fields(_lines(spark, path).filter(~F.col("value").startswith("@") & (F.col("value") != "")))
    c = lambda i: F.col("f")[i]
    tag = lambda t: F.struct(F.substring(t, 1, 2).alias("k"), F.regexp_replace(t, "^..:.:", "").alias("v"))
    tags = F.map_from_entries(F.transform(F.slice("f", F.lit(12), F.greatest(F.size("f") - 11, F.lit(0))), tag))
    return f.select(
        c(0).alias("qname"), c(1).cast("int").alias("flag"), c(2).alias("chrom"), (c(3).cast("long") - 1).alias("start_pos"),
        c(4).cast("int").alias("mapq"), c(5).alias("cigar"), c(6).alias("rnext"), (c(7).cast("long") - 1).alias("pnext"),
        c(8).try_cast("long").alias("tlen"), c(9).alias("seq"), c(10).alias("qual"), tags.alias("tags")
    )


def reference_end(cigar: str = "cigar", start: str = "start_pos") -> Column:
    """Start plus the reference bases that the CIGAR consumes."""
    ops = F.regexp_extract_all(F.col(cigar), F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.col(start) + F.aggregate(ops, F.lit(0).cast("long"), lambda a, x: a + x.cast("long"))


def bed(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """BED3+; comments, track and blank lines skipped.  Strict: bad coordinates are an error when read; else such rows go."""
    f = _fields(_lines(spark, path).filter(~F.col("value").rlike("^(#|track|browser)") & (F.trim("value") != "")))
    s, e = F.get("f", F.lit(1)).try_cast("long"), F.get("f", F.lit(2)).try_cast("long")
    good = F.coalesce((s >= 0) & (e > s), F.lit(False))
    out = f.withColumns({"_good": good, "start_pos": s, "end_pos": e})
    if strict:
        out = out.withColumn("start_pos", F.when(F.col("_good"), F.col("start_pos")).otherwise(F.raise_error(F.concat(F.lit("bad BED row: "), "value")).cast("long")))
    else:
        out = out.filter("_good")
    return out.select(F.col("f")[0].alias("chrom"), "start_pos", "end_pos", F.get("f", F.lit(3)).alias("name"))


def peaks(spark: SparkSession, path: str) -> DataFrame:
    """narrowPeak and broadPeak files; sample_key and peak_type come from file (or folder) names `<sample_key>_peaks.<type>Peak`."""
    f = _fields(spark.read.text(path).select("value", F.col("_metadata.file_path").alias("p")).filter(~F.col("value").rlike("^(#|track)") & (F.trim("value") != "")))
    g = lambda i: F.get("f", F.lit(i))
    return f.select(
        F.regexp_extract("p", r"([^/=]+?)(_peaks)?\.(narrow|broad)Peak", 1).alias("sample_key"),
        F.regexp_extract("p", r"\.(narrow|broad)Peak", 1).alias("peak_type"), g(0).alias("chrom"), g(1).cast("long").alias("start_pos"),
        g(2).cast("long").alias("end_pos"), g(3).alias("name"), g(4).cast("int").alias("score"), g(5).alias("strand"),
        g(6).cast("double").alias("signal"), g(7).cast("double").alias("pvalue"), g(8).cast("double").alias("qvalue"),
        g(9).cast("int").alias("summit")
    )


def bedgraph(spark: SparkSession, path: str) -> DataFrame:
    """chrom, start_pos, end_pos and score, after the columns that folders name (family=.../sample_key=...)."""
    f = _fields(_lines(spark, path).filter(~F.col("value").rlike("^(#|track)")), r"\s+").filter(F.size("f") >= 4)
    c = lambda i: F.col("f")[i]
    folders = [x for x in f.columns if x not in ("value", "f")]
    return f.select(*folders, c(0).alias("chrom"), c(1).cast("long").alias("start_pos"), c(2).cast("long").alias("end_pos"), c(3).cast("double").alias("score"))


def gtf(spark: SparkSession, path: str) -> DataFrame:
    """Nine columns with an attribute map (first value of a repeated key); positions half-open and 0-based; _place orders rows as
    they stand in the files."""
    f = _fields(_placed_lines(spark, path).filter(~F.col("value").startswith("#"))).filter(F.size("f") == 9)
    c = lambda i: F.col("f")[i]
    pairs = F.transform(
        F.split(c(8), ";"),
        lambda a: F.struct(
            F.regexp_extract(F.trim(a), r"^(\S+)", 1).alias("k"),
            F.regexp_replace(F.regexp_replace(F.trim(a), r"^\S+\s*", ""), '^"|"$', "").alias("v")
        )
    )
    pairs = F.filter(pairs, lambda p: p["k"] != "")
    first = F.filter(pairs, lambda p, i: F.array_position(F.transform(pairs, lambda q: q["k"]), p["k"]) == i + 1)
    return f.select(
        c(0).alias("chrom"), c(1).alias("source"), c(2).alias("feature"), (c(3).cast("long") - 1).alias("start_pos"),
        c(4).cast("long").alias("end_pos"), c(6).alias("strand"), F.map_from_entries(first).alias("attributes"), "_place"
    )


def tss_bed(features: DataFrame) -> DataFrame:
    """Unique TSSs of transcript rows, or of gene rows if there are none, each with the name of its first row by _place."""
    wanted = "transcript" if not features.filter("feature = 'transcript'").isEmpty() else "gene"
    x = features.filter((F.col("feature") == wanted) & F.col("strand").isin("+", "-"))
    at = F.when(F.col("strand") == "+", F.col("start_pos")).otherwise(F.col("end_pos") - 1)
    a = lambda k: F.nullif(F.col("attributes")[k], F.lit(""))
    x = x.withColumn("tss", at)
    name = F.coalesce(a("gene_name"), a("transcript_id"), a("gene_id"), F.concat_ws("_", F.lit("TSS"), "chrom", (F.col("tss") + 1).cast("string"), "strand"))
    return x.groupBy("chrom", "tss", "strand").agg(F.min_by(F.regexp_replace(name, r"\s+", "_"), "_place").alias("name"))


def class_tokens(raw: Column) -> Column:
    """The class names that a cell holds, each once, in the cell's order; names are cut at anything but letters, digits and hyphens."""
    words = F.split(F.coalesce(raw, F.lit("")), "[^A-Za-z0-9-]+")
    return F.array_distinct(F.filter(words, lambda w: w.isin(*CLASSES)))


def normal_class(raw: Column) -> Column:
    """Known class names joined by `;`, else the trimmed cell, `unclassified` for a blank one."""
    text = F.trim(F.coalesce(raw, F.lit("")))
    names = class_tokens(raw)
    return F.when(text == "", "unclassified").when(F.size(names) > 0, F.array_join(names, ";")).otherwise(text)


def ccre(spark: SparkSession, path: str, canonical: Column | None = None) -> DataFrame:
    """Lenient: rows with bad coordinates (or, given a test, off the canonical contigs) go; a missing id becomes ccre_<n>, n the
    number of the kept row by file order; the class column is the one, from the fourth on, in which most rows hold a class name
    (the first of several)."""
    f = _fields(_placed_lines(spark, path))
    s, e = F.get("f", F.lit(1)).try_cast("long"), F.get("f", F.lit(2)).try_cast("long")
    f = f.withColumns({"chrom": F.col("f")[0], "start_pos": s, "end_pos": e}).filter("start_pos >= 0 and end_pos > start_pos")
    if canonical is not None:
        f = f.filter(canonical)
    hits = f.select(F.posexplode("f").alias("at", "cell")).filter((F.col("at") >= 3) & (F.size(class_tokens(F.col("cell"))) > 0))
    best = hits.groupBy("at").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "at").first()  # a row a column of the file
    raw = F.lit(None).cast("string") if best is None else F.get("f", F.lit(best["at"]))
    f = _numbered(f)
    name = F.coalesce(F.nullif(F.trim(F.get("f", F.lit(3))), F.lit("")), F.concat(F.lit("ccre_"), F.col("_no").cast("string")))
    return f.select("chrom", "start_pos", "end_pos", name.alias("ccre_id"), normal_class(raw).alias("ccre_class"))


def chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    f = _fields(_lines(spark, path).filter("trim(value) <> ''"), r"\s+")
    return f.select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("size"))


def count_matrix(spark: SparkSession, path: str, samples: list[str]) -> DataFrame:
    """Wide TSV to (chrom, start_pos, end_pos, sample_key, n); every sample is required; counts must be complete and not negative."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    df = df.toDF(*[c.replace("#", "").replace("'", "").replace('"', "").strip() for c in df.columns])
    if missing := [s for s in samples if s not in df.columns]:
        raise ValueError(f"samples not in the matrix: {missing}")
    chrom, s, e = df.columns[:3]
    long = df.select(
        F.col(chrom).alias("chrom"), F.col(s).cast("long").alias("start_pos"), F.col(e).cast("long").alias("end_pos"),
        *[F.col(f"`{k}`").try_cast("double").alias(k) for k in samples]
    ).unpivot(["chrom", "start_pos", "end_pos"], samples, "sample_key", "n")
    good = F.coalesce(F.col("n") >= 0, F.lit(False))
    return long.withColumn("n", F.when(good, F.round("n").cast("long")).otherwise(F.raise_error(F.lit("a count is missing or negative")).cast("long")))


def keyed_value(spark: SparkSession, path: str, column: str, required: DataFrame | None = None) -> DataFrame:
    """(key, value) from a header TSV; a value that is not a positive number is an error when read.  With required (key), those
    keys alone, and one that the table lacks is an error too."""
    df = spark.read.option("sep", "\t").option("header", True).csv(path)
    if missing := [c for c in ("key", column) if c not in df.columns]:
        raise ValueError(f"columns not in the table: {missing}")
    stop = lambda text: F.raise_error(F.concat(F.lit(text), "key")).cast("double")
    v = F.col(column).try_cast("double")
    out = df.select("key", F.when(v > 0, v).otherwise(stop("not a positive number for ")).alias("value"))
    if required is None:
        return out
    found = required.select("key").distinct().join(out.withColumn("_there", F.lit(True)), "key", "left")
    return found.select("key", F.when(F.col("_there"), F.col("value")).otherwise(stop("no value for ")).alias("value"))


def duplication_metrics(spark: SparkSession, path: str) -> DataFrame:
    """PERCENT_DUPLICATION by header name, in percent, from whole metric files (some lines each)."""
    f = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.split("value", "\r?\n").alias("l"))
    at = F.array_position(F.transform("l", lambda x: x.startswith("LIBRARY\t")), F.lit(True))
    head, row = F.split(F.get("l", (at - 1).cast("int")), "\t"), F.split(F.get("l", at.cast("int")), "\t")
    i = F.array_position(head, F.lit("PERCENT_DUPLICATION"))
    return f.filter(at > 0).select("path", F.round(100 * F.get(row, (i - 1).cast("int")).cast("double"), 2).alias("percent_duplication"))


def metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """Scalars of nested JSON files as (file, path, value); some names are kept.

    Objects are opened level by level as VARIANT: `a.b` for a member, `a[i]` for an object in a list; a list's scalars and lists
    are left out.  As many rounds as the deepest file has levels.
    """
    level = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.lit("").alias("path"), F.parse_json("value").alias("v"))
    found = None
    while True:
        opened = "SELECT file, path, t.pos, t.key, t.value AS v, schema_of_variant(t.value) AS kind, schema_of_variant(level.v) LIKE 'ARRAY%' AS listed"
        below = spark.sql(f"{opened} FROM {{level}} AS level, LATERAL variant_explode(level.v) AS t", level=level)
        name = F.when(F.col("listed"), F.format_string("%s[%d]", "path", "pos")).when(F.col("path") == "", F.col("key")).otherwise(F.concat_ws(".", "path", "key"))
        inner = F.col("kind").startswith("OBJECT") | (F.col("kind").startswith("ARRAY") & ~F.col("listed"))
        below = below.select("file", name.alias("path"), "v", inner.alias("inner"), "kind", "listed")
        scalars = below.filter(
            ~F.col("inner") & ~F.col("listed") & ~F.col("kind").startswith("ARRAY") & (F.col("kind") != "VOID")
        ).select("file", "path", F.col("v").cast("string").alias("value"))
        found = scalars if found is None else found.unionByName(scalars)
        level = below.filter("inner").select("file", "path", "v")
        if level.isEmpty():
            break
    return found.filter(F.regexp_replace(F.lower("path"), "[^a-z0-9]+", "_").rlike("|".join(METRIC_TOKENS)))


def fastq(spark: SparkSession, path: str, mate: int = 1, split_bytes: int | None = None) -> DataFrame:
    """(read_id, mate, seq, qual) from records of four lines, by ranges of split_bytes (spark.sql.files.maxPartitionBytes).  Many
    short ranges share a task, of spark.sql.files.maxPartitionBytes at most."""
    spark.dataSource.register(FastqSource)
    most = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    rows = spark.read.format("fastq").option("splitBytes", split_bytes or most).option("taskBytes", most).load(path)
    return rows.select("read_id", F.lit(mate).alias("mate"), "seq", "qual")


def discover(spark: SparkSession, folders: list[str], pattern: str = "differential_accessibility_comparisons.tsv", required: tuple[str, ...] = ()) -> DataFrame:
    """All tables of that name under the folders, with source_table; blanks are NA.

    Each table is read by its own header, so columns may stand in any order, and the result has the columns of all of them (NA
    where a table lacks one).  A required column that a table lacks is an error that names the table.  Cells are matched to names
    row by row beside the file's header line, one plan for any number of tables; headers are short and few.
    """
    at = F.col("_metadata.file_path")
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", pattern).text(folders)
    lines = text.select(
        F.regexp_replace("value", "\r$", "").alias("value"), at.alias("source_table"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line")
    )
    # the header is the first line of the file's first block: ids rise with a partition's lines
    first = lines.filter("_block = 0").groupBy("source_table").agg(F.min_by("value", "_line").alias("_header"), F.min("_line").alias("_head"))
    headers = {r["source_table"]: r["_header"].split("\t") for r in first.collect()}  # a row a table
    for table, names in headers.items():
        names = [n.strip() for n in names]
        if missing := [c for c in required if c not in names]:
            raise ValueError(f"columns not in {table}: {missing}")
        if len(set(names)) < len(names):
            raise ValueError(f"a column of {table} is named twice")
    columns = list(dict.fromkeys(n.strip() for names in headers.values() for n in names))
    rows = lines.join(F.broadcast(first), "source_table").filter((F.col("_line") != F.col("_head")) & (F.trim("value") != ""))
    names = F.transform(F.split("_header", "\t"), F.trim)
    cells = F.split("value", "\t")
    cell = F.map_from_arrays(names, F.transform(names, lambda _, i: F.get(cells, i)))
    blank = lambda c: F.coalesce(F.nullif(F.trim(F.col("_cells")[c]), F.lit("")), F.lit("NA"))
    return rows.withColumn("_cells", cell).select(*[blank(c).alias(c) for c in columns], "source_table")
