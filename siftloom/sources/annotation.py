"""Gene annotations in GTF and GFF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

COLUMNS = ("contig", "source", "feature", "start", "end", "score", "strand", "frame", "attributes")
#: Lines of a range in which names are carried on by one task, as a power of two.
RANGE_BITS = 14


def gtf_attribute(attributes: Column, name: str) -> Column:
    """The quoted value of an attribute, or ''; of several the last."""
    found = F.regexp_extract_all(attributes, F.lit(f'(?:^|;) *{name} +"([^"]*)"'), F.lit(1))
    return F.coalesce(F.try_element_at(found, F.lit(-1)), F.lit(""))


def gff_attribute(attributes: Column, name: str) -> Column:
    """The value of `name=value`, or ''; of several the last."""
    found = F.filter(F.split(attributes, ";"), lambda p: F.startswith(p, F.lit(f"{name}=")))
    return F.coalesce(F.substring(F.try_element_at(found, F.lit(-1)), len(name) + 2, 1 << 30), F.lit(""))


def fields(lines: DataFrame) -> DataFrame:
    """line_no and the nine columns of lines (line_no, value), without comments and blank lines."""
    kept = lines.filter(~F.startswith("value", F.lit("#")) & (F.trim("value") != ""))
    parts = F.split("value", "\t")
    cols = [F.get(parts, k).alias(c) for k, c in enumerate(COLUMNS)]
    return kept.select("line_no", *cols).withColumns({"start": F.col("start").try_cast("int"), "end": F.col("end").try_cast("int")})


def gtf(lines: DataFrame) -> DataFrame:
    """The annotation of GTF lines (line_no, value). Records without a gene name are left out; a
    transcript goes by its id, which is its name too."""
    rows = fields(lines)
    for name in ("gene_id", "gene_name", "transcript_id"):
        rows = rows.withColumn(name, gtf_attribute(F.col("attributes"), name))
    return rows.withColumn("transcript_name", F.col("transcript_id")).drop("attributes").filter("gene_name <> ''")


def gff(lines: DataFrame) -> DataFrame:
    """The annotation of GFF lines (line_no, value). Gene and transcript names are those of the last
    gene and transcript line above, within a region; a line of feature region starts one. A transcript
    without a name has that of the last one above that has any.

    What stands last is a running maximum of line numbers, within ranges of lines and, before each, over
    the ranges ahead; so neither a region nor a file is held by one task.
    """
    rows = fields(lines)
    rows = rows.withColumns({"_id": gff_attribute(F.col("attributes"), "ID"), "_name": gff_attribute(F.col("attributes"), "Name"), "_range": F.shiftright("line_no", RANGE_BITS)})
    is_gene = F.col("feature").isin("gene", "pseudogene")
    is_transcript = F.col("feature").isin("mRNA", "transcript", "ncRNA", "rRNA", "tRNA", "lnc_RNA")
    at = lambda when, *columns: F.when(when, F.struct("line_no", *columns))
    marks = {
        "_region": at(F.col("feature") == "region"),
        "_gene": at(is_gene, "_id", F.when(F.col("_name") == "", F.col("_id")).otherwise(F.col("_name")).alias("_name")),
        "_tx": at(is_transcript, "_id"),
        "_named": at(is_transcript & (F.col("_name") != ""), "_name"),
    }
    rows = rows.withColumns(marks)
    ahead = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    last = rows.groupBy("_range").agg(*(F.max(m).alias(m) for m in marks))
    last = last.select(F.col("_range").alias("_of"), *(F.max(m).over(ahead).alias(f"{m}_ahead") for m in marks))  # a row for each range
    above = Window.partitionBy("_range").orderBy("line_no")
    rows = rows.withColumns({m: F.max(m).over(above) for m in marks}).join(last, F.col("_range") == F.col("_of"))
    rows = rows.withColumns({m: F.coalesce(m, f"{m}_ahead") for m in marks})
    # what stands above the last start of a region is forgotten
    after = lambda m: F.col(f"{m}.line_no") > F.coalesce("_region.line_no", F.lit(-1))
    told = lambda m, c: F.coalesce(F.when(after(m), F.col(f"{m}.{c}")), F.lit(""))
    fresh = after("_tx") & (F.col("_tx.line_no") >= F.coalesce(F.when(after("_gene"), F.col("_gene.line_no")), F.lit(-1))) & ~is_gene
    rows = rows.withColumns({"gene_id": told("_gene", "_id"), "gene_name": told("_gene", "_name"), "transcript_id": F.when(fresh, told("_tx", "_id")).otherwise(""), "transcript_name": F.when(fresh, told("_named", "_name")).otherwise("")})
    return rows.drop("attributes", "_id", "_name", "_range", "_of", *marks, *(f"{m}_ahead" for m in marks)).filter("gene_name <> ''")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """line_no, value of a text file. The order of lines is that of Spark's partitions and rows of it,
    which for one file is the file's own."""
    return spark.read.text(path).select(F.monotonically_increasing_id().alias("line_no"), "value")


def read_annotation(spark: SparkSession, path: str) -> DataFrame:
    """The annotation of a .gtf or .gff file."""
    if path.endswith(".gtf"):
        return gtf(read_lines(spark, path))
    if path.endswith(".gff"):
        return gff(read_lines(spark, path))
    raise ValueError(f"{path} is neither .gtf nor .gff")
