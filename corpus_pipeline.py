"""Corpus pipeline: toxic documents go, one document of each near-duplicate group stays, repeated passages go, sources are
mixed to target weights, and what is left becomes token ids.

Each stage takes the rows its predecessor kept and all but the last return the columns of documents (extra columns stay).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from peakloom.llm import bpe, common, mixing, ngram_join, suffix_dedup, toxicity

#: Near duplicates: words in a shingle and the least Jaccard similarity in percent.  Repeats: bytes.
SHINGLE_WORDS, SIMILARITY, REPEAT_BYTES = 5, 80, 100


#: Where a stage's result names the scratch tables that it was made of: in the metadata of its first column, which Parquet keeps.
MADE_OF = "scratch"


def stage(f: Callable) -> Callable:
    """The scratch tables that docs were made of go before a stage runs, unless docs read them still: docs that were written and
    reread don't.  A result notes its own tables in its schema, so stages of other runs, or two results open at once, don't meet."""

    @functools.wraps(f)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        made_of = [path for field in docs.schema for path in field.metadata.get(MADE_OF, [])]
        read = docs.inputFiles() if made_of else []
        if not any(path in file for file in read for path in made_of):
            for path in made_of:
                common.delete(spark, path)
        made: list[str] = []
        with common.recording(made):
            out = f(spark, docs, sf_dir)
        first, *rest = out.columns
        return out.select(F.col(first).alias(first, metadata={MADE_OF: made}), *rest)

    return run_stage


@stage
def toxic_documents_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose score is below the threshold.  The model learns from the labelled rows outside the held-out third."""
    scored = toxicity.score(docs, toxicity.fit(spark, sf_dir), keep=tuple(docs.columns))
    return scored.filter(F.col("score") < toxicity.THRESHOLD).select("row.*")


def numbered(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows with a number of their own (__row), written, so that ids may be null or repeated in what follows."""
    return common.Scratch(spark).table(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")


@stage
def one_of_each_group_stays(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each component of the n-gram Jaccard join: the one with the smallest id (null ids last; rows of one
    id by their texts' digests).  Rows without words are in no group and stay.
    """
    rows = numbered(spark, docs)
    groups = common.Scratch(spark).table(ngram_join.join(rows, SHINGLE_WORDS, SIMILARITY, id_column="__row").filter("n_links > 0"), "groups")
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("digest"), "__row")
    members = rows.select("__row", key.alias("key")).join(groups.select("__row", "component_id"), "__row")
    best = members.groupBy("component_id").agg(F.min("key").alias("best"))
    stay = common.Scratch(spark).table(best.select(F.col("best.__row").alias("__row")), "stay")
    gone = groups.select("__row").join(stay, "__row", "left_anti")
    return rows.join(gone, "__row", "left_anti").select(*docs.columns)


@stage
def repeated_passages_go(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every byte that a string of REPEAT_BYTES covers which also starts earlier; parts of characters at the cuts go as well.

    Rows count in the order of their ids, null ids first, then of their texts' digests.  Documents of which nothing but white
    space is left go.  n_chars follows the text.
    """
    rows = numbered(spark, docs)
    made: list[str] = []
    with common.recording(made):
        cut = suffix_dedup.dedup(rows, REPEAT_BYTES, with_text=True, row="__row").filter("n_removed > 0")
    cut = common.Scratch(spark).table(cut.select("__row", F.col("kept_text").alias("__kept")), "cut")
    for path in made:  # the blocks and places of which the cut texts came
        common.delete(spark, path)
    changed = F.col("__kept").isNotNull()
    out = rows.join(cut, "__row", "left").withColumn("text", F.coalesce("__kept", "text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.filter(~changed | (F.regexp_count("text", F.lit(mixing.WORD)) > 0)).select(*docs.columns)


@stage
def sources_are_mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: rows as often as they are taken, those of better texts first."""
    rows = numbered(spark, docs)
    mixed = mixing.mix(rows, mixing.WEIGHTS, mixing.SHARE, mixing.MOST_EPOCHS, quality=mixing.quality())
    times = common.Scratch(spark).table(mixing.epochs(mixed).select("__row"), "times")
    return rows.join(times, "__row").select(*docs.columns)


@stage
def texts_become_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the text decoded from them, a row for each row of the mix."""
    import public_tokenizers as P

    return bpe.digests(docs, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)


STAGES = [
    ("toxicity", toxic_documents_go),
    ("n-gram Jaccard join", one_of_each_group_stays),
    ("suffix-array dedup", repeated_passages_go),
    ("mixing", sources_are_mixed),
    ("byte-level BPE", texts_become_tokens),
]

#: SQL can't express the training, so run() is tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage.  The others' rows are written to the shared folder; each goes when the next is written."""
    docs, before = common.documents(spark, sf_dir), None
    for name, function in STAGES[:-1]:
        path = common.scratch_path(spark, name.replace(" ", "-"))
        rows = function(spark, docs, sf_dir)
        with common.settings(spark, common.CLEAN_SHUFFLES, common.ARROW_BYTES):
            rows.write.option("compression", "zstd").parquet(path)
        if before is not None:
            common.delete(spark, before)
        docs, before = spark.read.schema(rows.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
