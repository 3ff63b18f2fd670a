"""Gene context, regulatory elements and nearest TSS of regions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import intervals as iv

S, E = iv.S, iv.E
#: Priority of regulatory classes; others rank 999.  Fixed values.
CLASS_PRIORITY = {"PLS": 1, "pELS": 2, "dELS": 3, "CA-CTCF": 4, "CTCF-only": 5, "CTCF-bound": 6, "DNase-H3K4me3": 7, "CA-H3K4me3": 8, "CA-TF": 9, "CA": 10, "TF": 11}


def class_priority(column: str) -> Column:
    first = F.regexp_replace(F.col(column), ";.*$", "")
    known = F.create_map(*[F.lit(x) for kv in CLASS_PRIORITY.items() for x in kv])
    return F.coalesce(known[first], F.lit(999))


#: Kinds of gene features and the flags they give.
FEATURES = {"promoter": "promoter_overlap", "exon": "exon_overlap", "gene": "gene_body_overlap"}


def tagged_features(genes: DataFrame, exons: DataFrame, up: int, down: int) -> DataFrame:
    parts = {"promoter": iv.promoters(genes, up, down), "exon": exons, "gene": genes}
    out = None
    for tag, df in parts.items():
        df = df.select("chrom", S, E, F.lit(tag).alias("tag"))
        out = df if out is None else out.unionByName(df)
    return out


def with_context(df: DataFrame) -> DataFrame:
    """Adds intron_overlap and gene_context to the three flags; null flags count as false."""
    out = df.withColumns({n: F.coalesce(n, F.lit(False)) for n in FEATURES.values()})
    out = out.withColumn("intron_overlap", F.col("gene_body_overlap") & ~F.col("exon_overlap") & ~F.col("promoter_overlap"))
    context = F.when(F.col("promoter_overlap"), "promoter").when(F.col("exon_overlap"), "exon").when(F.col("intron_overlap"), "intron").when(F.col("gene_body_overlap"), "other_gene_body").otherwise("distal_intergenic")
    return out.withColumn("gene_context", context)


def feature_flags(regions: DataFrame, genes: DataFrame, exons: DataFrame, up: int = 2000, down: int = 500) -> DataFrame:
    """promoter_overlap, exon_overlap, gene_body_overlap, intron_overlap and gene_context from one join on tagged features."""
    pairs = iv.overlap_join(regions.select("region_id", "chrom", S, E), tagged_features(genes, exons, up, down))
    hit = pairs.groupBy("region_id").agg(*[F.max(F.col("tag") == t).alias(n) for t, n in FEATURES.items()])
    return with_context(regions.join(hit, "region_id", "left"))


def joined(values: Column) -> Column:
    """Distinct values, sorted and joined by ';' (blank and null ones left out); null if none."""
    kept = F.array_sort(F.filter(F.collect_set(values), lambda x: x != ""))
    return F.when(F.size(kept) > 0, F.array_join(kept, ";"))


def ccre_hits(regions: DataFrame, ccre: DataFrame) -> DataFrame:
    pairs = iv.overlap_join(regions.select("region_id", "chrom", S, E), ccre.select("chrom", S, E, "ccre_id", "ccre_class"))
    return pairs.withColumn("width", iv.overlap_width(S, E, "r_start", "r_end"))


def primary_ccre(hits: DataFrame) -> DataFrame:
    """One element a region: widest overlap, then class priority, then id."""
    w = Window.partitionBy("region_id").orderBy(F.col("width").desc(), class_priority("ccre_class"), "ccre_id")
    return hits.withColumn("_n", F.row_number().over(w)).filter("_n = 1").select(
        "region_id", F.col("ccre_id").alias("ccre_primary_id"), F.col("ccre_class").alias("ccre_primary_class")
    )


def nearest_tss(regions: DataFrame, genes: DataFrame) -> DataFrame:
    """Nearest TSS ignoring strand; the signed distance is the region's midpoint minus the TSS in 1-based terms, negated on '-'."""
    t = iv.tss(genes).groupBy("chrom", "tss").agg(F.min(F.struct("gene_id", "gene_name", "strand")).alias("g"))
    near = iv.nearest(regions.select("region_id", "chrom", S, E), t, "region_id", "tss", "g")
    mid = F.floor((F.col(S) + 1 + F.col(E)) / 2)
    signed = (mid - (F.col("tss") + 1)) * F.when(F.col("g.strand") == "-", -1).otherwise(1)
    return near.filter("g is not null").select(
        "region_id", F.col("g.gene_id").alias("nearest_gene_id"), F.col("g.gene_name").alias("nearest_gene_name"),
        signed.cast("long").alias("nearest_tss_distance_bp"), F.col("distance").alias("edge_distance")
    )


def annotate(regions: DataFrame, genes: DataFrame, exons: DataFrame, ccre: DataFrame, up: int = 2000, down: int = 500, source: str | None = None) -> DataFrame:
    """The full annotation table of a region universe: one join on bins with gene features and regulatory elements together, one
    aggregation of its pairs by region, and the nearest TSS.  regions are read more than once, so give a written table."""
    none = F.lit(None).cast("string")
    elements = ccre.select("chrom", S, E, F.lit("element").alias("tag"), "ccre_id", "ccre_class")
    features = tagged_features(genes, exons, up, down).withColumns({"ccre_id": none, "ccre_class": none})
    pairs = iv.overlap_join(regions.select("region_id", "chrom", S, E), features.unionByName(elements))
    # widest overlap, then class priority, then id
    best = F.struct((-iv.overlap_width(S, E, "r_start", "r_end")).alias("width"), class_priority("ccre_class").alias("priority"), "ccre_id", "ccre_class")
    first = F.min(F.when(F.col("tag") == "element", best))
    flags = [F.max(F.col("tag") == t).alias(n) for t, n in FEATURES.items()]
    found = pairs.groupBy("region_id").agg(
        *flags, first.alias("_first"), joined(F.col("ccre_id")).alias("ccre_all_ids"), joined(F.col("ccre_class")).alias("ccre_all_classes")
    )
    primary = {"ccre_primary_id": F.col("_first.ccre_id"), "ccre_primary_class": F.col("_first.ccre_class")}
    out = with_context(
        regions.join(found.withColumns(primary).drop("_first"), "region_id", "left")
    ).join(nearest_tss(regions, genes).drop("edge_distance"), "region_id", "left")
    return out.withColumns({
        "promoter_definition": F.lit(f"TSS-{up}/+{down}bp"), "ccre_overlap": F.col("ccre_primary_id").isNotNull(),
        "enhancer_like": F.coalesce(F.col("ccre_all_classes").rlike("(^|;)(pELS|dELS)(;|$)"), F.lit(False)), "ccre_source": F.lit(source)
    })


def join_annotations(results: DataFrame, annotations: DataFrame) -> DataFrame:
    """Results with their annotation; a result without one is an error."""
    kept = annotations.drop("chrom", S, E).withColumn("_known", F.lit(True))
    out = results.join(kept, "region_id", "left")
    checked = F.when(F.col("_known"), F.col("region_id")).otherwise(
        F.raise_error(F.lit("a result row has no annotation")).cast(results.schema["region_id"].dataType)
    )
    return out.withColumn("region_id", checked).drop("_known")


def annotation_summary(table: DataFrame) -> DataFrame:
    """Significant sites by gene context and by primary class; blanks are `unannotated`."""
    long = table.select(
        F.explode(F.array(
            *[F.struct(
                F.lit(t).alias("annotation_type"), F.coalesce(F.nullif(F.col(t), F.lit("")), F.lit("unannotated")).alias("category")
            ) for t in ("gene_context", "ccre_primary_class")]
        )).alias("x")
    ).select("x.*")
    return long.groupBy("annotation_type", "category").agg(F.count("*").alias("significant_sites"))
