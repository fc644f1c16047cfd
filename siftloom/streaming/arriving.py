"""Expression of reads that keep arriving.

The batch operators are the reference point; this counts the same way as files of reads land in a
folder. A fragment position is unique by its first arrival within the watermark, so it is meant for
one sequencing run at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.reads import marker
from ..operators import assign, filters


def arriving(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    """A stream of the Parquet files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def unique_reads(reads: DataFrame, min_mapq: int = 10, arrival: str | None = None, late: str = "1 day") -> DataFrame:
    """Primary reads of sufficient quality, each fragment position and barcode once. arrival: a column
    of times, by which positions are forgotten after the time late; without it all are kept as state."""
    good = filters.with_names(reads.filter(filters.primary(F.col("hi")) & filters.included(F.col("contig")) & (F.col("mapq") >= min_mapq)))
    keyed = good.withColumn("marker", marker(F.col("pos"), F.col("mpos"), F.col("isize")))
    if arrival is None:
        return keyed.dropDuplicates(["contig", "marker", "cb"])
    return keyed.withWatermark(arrival, late).dropDuplicatesWithinWatermark(["contig", "marker", "cb"])


def gene_overlaps(reads: DataFrame, genes: DataFrame) -> DataFrame:
    """Rows of reads and the genes that each overlaps, without state; for counts by gene and barcode."""
    return assign.gene_rows(reads, genes, 2)


def overlap_counts(reads: DataFrame, genes: DataFrame) -> DataFrame:
    """Running counts of reads by barcode and gene, of all genes in whose exons and strand a read lies."""
    named = reads.select("file_idx", "rec_idx", "contig", "pos", "cigar", "flag", "cb")
    rows = assign.gene_rows(named, genes, 2, keep=("cb",))
    return rows.filter("f = 5 and same").groupBy(F.col("cb").alias("barcode"), "gene").agg(F.count(F.lit(1)).alias("reads"))
