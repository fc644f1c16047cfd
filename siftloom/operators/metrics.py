"""One-row summaries and histograms of a run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.reads import rate
from .assign import CONFIDENT


def _count(when: Column) -> Column:
    return F.count(F.when(when, 1))


def summary(total: DataFrame) -> DataFrame:
    """From reads with flags passed, annotated and is_unique: their numbers and rates of failure. The
    duplication rate is that of annotated reads."""
    n = total.agg(F.count(F.lit(1)).alias("total"), _count(F.col("passed")).alias("pass_filter"), _count(F.col("annotated")).alias("annotated"), _count(F.col("is_unique")).alias("unique"))
    lost = lambda of, what: F.round(rate(F.col(of) - F.col(what), F.col(of)), 4)
    return n.withColumns({"fail_filter_rate": lost("total", "pass_filter"), "fail_annotate_rate": lost("pass_filter", "annotated"), "duplication_rate": lost("annotated", "unique")})


def strand_metrics(annotated: DataFrame) -> DataFrame:
    """Rules 0 and 1: reads, and those counted by strand."""
    return annotated.agg(
        F.count(F.lit(1)).alias("total_reads"), _count(F.col("wrong")).alias("reads_wrong_strand"), _count(F.col("right")).alias("reads_right_strand"),
        _count(F.col("fixed")).alias("read_ambiguous_gene_fixed"), _count(F.col("rejected")).alias("ambiguous_reads_rejected"),
    )


def region_metrics(annotated: DataFrame) -> DataFrame:
    """Rule 2: reads by region. All but antisense count confident reads; intergenic includes reads of
    any confidence that overlap no gene."""
    sure = F.col("mapq") >= CONFIDENT
    exonic, intronic, intergenic = (sure & (F.col("xf") == x) for x in ("EXONIC", "INTRONIC", "INTERGENIC"))
    n = annotated.agg(
        F.count(F.lit(1)).alias("total_reads"), _count(sure).alias("map"), _count(exonic).alias("exonic"), _count(intronic).alias("intronic"),
        (_count(intergenic) + _count(F.col("nogene"))).alias("intergenic"), _count(exonic & F.col("right")).alias("transcriptome"), _count(F.col("wrong")).alias("antisense"),
    )
    return n.withColumns({f"{c}_pct": F.round(rate(F.col(c), F.col("total_reads")), 4) for c in ("map", "exonic", "intronic", "intergenic", "transcriptome", "antisense")})


def identifier_totals(roots: DataFrame) -> DataFrame:
    """Groups, different identifiers, and those left after correction; groups without a gene included."""
    n = roots.groupBy("contig", "barcode", "gene").agg(F.count(F.lit(1)).alias("raw"), _count(F.col("umi") == F.col("root_umi")).alias("kept"))
    n = n.agg(F.count(F.lit(1)).alias("barcode_gene_num"), F.coalesce(F.sum("raw"), F.lit(0)).alias("umi_cnt_raw"), F.coalesce(F.sum("kept"), F.lit(0)).alias("umi_cnt_dedup"))
    return n.withColumns({"raw_pct": F.round(rate(F.col("umi_cnt_raw"), F.col("barcode_gene_num")), 4), "dedup_pct": F.round(rate(F.col("umi_cnt_dedup"), F.col("barcode_gene_num")), 4)})


def _differences(roots: DataFrame) -> DataFrame:
    """position, type of each place at which a collapsed identifier differs from its root."""
    away = roots.filter("umi <> root_umi").select("umi", "root_umi", F.explode(F.sequence(F.lit(1), F.length("umi"))).alias("position"))
    base = lambda c: F.substring(c, F.col("position"), F.lit(1))
    return away.withColumns({"_a": base(F.col("umi")), "_b": base(F.col("root_umi"))}).filter("_a <> _b").select("position", F.concat_ws("_", "_a", "_b").alias("type"))


def mismatch_positions(roots: DataFrame, length: int) -> DataFrame:
    """Differences by place, from 1 to length, and their share."""
    return _shares(_differences(roots), "position", roots.sparkSession.range(1, length + 1).select(F.col("id").cast("int").alias("position")))


def mismatch_types(roots: DataFrame) -> DataFrame:
    """Differences by bases, of the collapsed identifier and of its root, and their share."""
    pairs = [(f"{a}_{b}",) for a in "ACTG" for b in "ACTG"]
    return _shares(_differences(roots), "type", roots.sparkSession.createDataFrame(pairs, "type string"))


def _shares(differences: DataFrame, by: str, bins: DataFrame) -> DataFrame:
    counts = F.broadcast(bins).join(differences.groupBy(by).agg(F.count(F.lit(1)).alias("cnt")), by, "left")  # 16 bins, or an identifier's length
    total = differences.agg(F.count(F.lit(1)).alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select(by, F.coalesce("cnt", F.lit(0)).alias("cnt"), F.round(rate(F.coalesce("cnt", F.lit(0)), F.col("_all")), 4).alias("pct"))  # one row
