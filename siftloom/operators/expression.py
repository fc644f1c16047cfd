"""Counts of unique reads by contig, barcode and gene."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.reads import marker
from ..schemas import READ_ID


def by_position(reads: DataFrame, scope: str = "contig") -> DataFrame:
    """contig, barcode, gene, umi_cnt of annotated reads, each fragment position and barcode once, for
    the gene of its first read. Partial aggregates meet, so a hot position is no hot task."""
    keys = [*(["contig"] if scope == "contig" else []), marker(F.col("pos"), F.col("mpos"), F.col("isize")).alias("_marker"), "cb"]
    first = reads.groupBy(*keys).agg(F.min(F.struct(*READ_ID, "ge", F.col("contig").alias("_contig"))).alias("r"))
    return first.groupBy(F.col("r._contig").alias("contig"), F.col("cb").alias("barcode"), F.col("r.ge").alias("gene")).agg(F.count(F.lit(1)).alias("umi_cnt"))


def by_identifier(roots: DataFrame) -> DataFrame:
    """contig, barcode, gene, umi_cnt (clusters) and read_cnt (their reads) of corrected identifiers."""
    kept = roots.filter("gene <> 'NOGENE' and umi = root_umi")
    return kept.groupBy("contig", "barcode", "gene").agg(F.count(F.lit(1)).alias("umi_cnt"), F.sum("cluster_cnt").alias("read_cnt"))


def across_contigs(expression: DataFrame) -> DataFrame:
    """barcode, gene and sums of all counts over contigs."""
    sums = [F.sum(c).alias(c) for c in ("umi_cnt", "read_cnt") if c in expression.columns]
    return expression.groupBy("barcode", "gene").agg(*sums)


def barcode_totals(expression: DataFrame) -> DataFrame:
    return expression.groupBy("barcode").agg(F.sum("umi_cnt").alias("total"))
