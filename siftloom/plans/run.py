"""The whole way from reads and an annotation to expression, metrics, saturation and matrix."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..operators import assign, dedup, density, expression, filters, matrix, metrics, saturation
from ..schemas import READ_ID
from ..session import settled


@dataclass
class Result:
    """reads: output rows with tags, flags and status. summaries: small tables by section."""

    reads: DataFrame
    expression: DataFrame
    summaries: dict[str, DataFrame] = field(default_factory=dict)
    saturation: DataFrame | None = None
    matrix: tuple[DataFrame, DataFrame, DataFrame] | None = None


def prepared(reads: DataFrame, config: Config) -> DataFrame:
    """Primary reads of included contigs with names parsed and passed, whether quality holds."""
    kept = reads.filter(filters.primary(F.col("hi")))
    if config.scope == "contig":
        kept = kept.filter(filters.included(F.col("contig")))
    return filters.with_names(kept, config.barcode_source).withColumn("passed", F.col("mapq") >= config.min_mapq)


def annotated(reads: DataFrame, genes: DataFrame, config: Config) -> DataFrame:
    """Passed reads (of which identifiers are clear, where they matter) with genes and metrics' flags."""
    good = reads.filter("passed")
    if config.umi:
        good = good.filter(filters.clear_identifier(F.col("ur")))
    return assign.annotate(good, genes, config.mode)


def run(reads: DataFrame, genes: DataFrame, config: Config | None = None) -> Result:
    """reads as READS, genes as GENES. Reads are annotated once, to a table; the rest runs when the
    tables of the result are used, but for choices that need a size."""
    config = config or Config()
    base = prepared(reads, config)
    named = settled(annotated(base, genes, config))  # outputs and summaries all read it
    with_gene = named.filter("ge is not null")
    result = Result(*(_by_identifier if config.umi else _by_position)(base, named, with_gene, config))
    result.summaries["ANNOTATION METRICS"] = metrics.region_metrics(named) if config.mode == 2 else metrics.strand_metrics(named)
    result.expression = settled(result.expression)
    firsts = result.expression.agg(F.coalesce(F.sum("umi_cnt"), F.lit(0)).alias("u")) if not config.umi else dedup.by_identifier(with_gene, scope=config.scope).agg(F.count(F.lit(1)).alias("u"))
    counts = base.agg(F.count(F.lit(1)).alias("total"), F.count(F.when(F.col("passed"), 1)).alias("pass_filter")).crossJoin(with_gene.agg(F.count(F.lit(1)).alias("annotated"))).crossJoin(firsts)  # one row each
    rate = lambda of, what: F.round(F.coalesce(F.try_divide((F.col(of) - F.col(what)) * 100.0, F.col(of)), F.lit(0.0)), 4)
    result.summaries["FILTER & DEDUPLICATION METRICS"] = counts.withColumnRenamed("u", "unique").withColumns({"fail_filter_rate": rate("total", "pass_filter"), "fail_annotate_rate": rate("pass_filter", "annotated"), "duplication_rate": rate("annotated", "unique")})
    if config.matrix:
        table = result.expression
        if config.filter_matrix:
            result.expression = table = matrix.filtered(table, density.barcode_threshold(expression.barcode_totals(table)))
        result.matrix = matrix.triplets(table)
    return result


def _rest(base: DataFrame, named: DataFrame, config: Config) -> DataFrame:
    """Rows of the output that take no part in deduplication: of low quality, and without a gene."""
    plain = named.filter("ge is null").withColumn("status", F.lit("keep"))
    if not config.keep_low_quality:
        return plain
    low = filters.quality(base.filter("not passed"), config.min_mapq, keep=True)
    return plain.unionByName(low, allowMissingColumns=True)


def _by_position(base: DataFrame, named: DataFrame, with_gene: DataFrame, config: Config):
    rows = dedup.by_position(with_gene, config.keep_duplicates, config.scope).unionByName(_rest(base, named, config), allowMissingColumns=True)
    return _tidy(rows), expression.by_position(with_gene, config.scope)


def _by_identifier(base: DataFrame, named: DataFrame, with_gene: DataFrame, config: Config):
    # identifiers of reads of low quality and without a gene count under NOGENE
    counted = named.select("contig", "cb", "ge", "ur").unionByName(base.filter("not passed").select("contig", "cb", F.lit(None).cast("string").alias("ge"), "ur"))
    roots = settled(dedup.correct_identifiers(dedup.identifier_counts(counted, config.scope), config.umi_min_num, config.umi_mismatch))
    first = base.select(F.length("ur").alias("n")).first()
    rows = dedup.by_both(with_gene, roots, config.keep_duplicates, config.scope)
    summaries = {"UMI METRICS": metrics.identifier_totals(roots), "UMI MISMATCH POSITIONS": metrics.mismatch_positions(roots, first["n"] if first and first["n"] else 0), "UMI MISMATCH TYPES": metrics.mismatch_types(roots)}
    kept = roots.filter("cluster_cnt > 0").select("barcode", "gene", "umi", F.col("cluster_cnt").alias("cnt"))
    curve = saturation.saturation(kept, coordinates=not config.matrix) if config.saturation else None
    return _tidy(rows.unionByName(_rest(base, named, config), allowMissingColumns=True)), expression.by_identifier(roots), summaries, curve


def _tidy(rows: DataFrame) -> DataFrame:
    kept = [c for c in ("ub",) if c in rows.columns]
    return rows.select(*READ_ID, "qname", "flag", "contig", "pos", "mapq", "cigar", "mpos", "isize", "seq", "qual", "hi", "tags", "cb", "ur", "uy", "xf", "ge", "gs", *kept, "status") if "seq" in rows.columns else rows


def output_order(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    """rows by contig, then file, then place in the file."""
    return rows.join(F.broadcast(contigs.select("contig", "contig_idx")), "contig", "left").orderBy("contig_idx", "file_idx", "rec_idx").drop("contig_idx")  # a header's contigs: thousands
