"""python -m siftloom: a run over BAM files and an annotation."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .config import Config
from .operators import filters, genemodel
from .plans.run import output_order, run
from .session import ship
from .sources import annotation, bam, sinks


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="siftloom", description="Assigns aligned reads to genes, drops repeated ones and counts expression.")
    p.add_argument("--reads", required=True, help="BAM files, separated by commas, or a folder of Parquet with the same columns")
    p.add_argument("--annotation", required=True, help="a .gtf or .gff file")
    p.add_argument("--out", required=True, help="folder for the results")
    p.add_argument("--min-mapq", type=int, default=10)
    p.add_argument("--keep-low-quality", action="store_true")
    p.add_argument("--keep-duplicates", action="store_true")
    p.add_argument("--mode", type=int, default=2, choices=(0, 1, 2))
    p.add_argument("--umi", action="store_true")
    p.add_argument("--umi-min-num", type=int, default=5)
    p.add_argument("--umi-mismatch", type=int, default=1)
    p.add_argument("--saturation", action="store_true")
    p.add_argument("--matrix", action="store_true")
    p.add_argument("--no-filter-matrix", action="store_true")
    p.add_argument("--barcode-source", default="qname", choices=("qname", "tags"))
    p.add_argument("--scope", default="contig", choices=("contig", "whole"))
    p.add_argument("--bam", action="store_true", help="write the reads as BAM shards, not as Parquet by contig")
    return p


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    config = Config(a.min_mapq, a.keep_low_quality, a.keep_duplicates, a.mode, a.umi, a.umi_min_num, a.umi_mismatch, a.saturation, a.matrix, not a.no_filter_matrix, a.barcode_source, a.scope)
    spark = SparkSession.builder.appName("siftloom").getOrCreate()
    ship(spark)
    bam.register(spark)
    files = a.reads.endswith(".bam")
    reads = spark.read.format("bam").load(a.reads) if files else spark.read.parquet(a.reads)
    if a.barcode_source == "qname":
        filters.check_names(reads, a.umi)
    genes = genemodel.gene_model(annotation.read_annotation(spark, a.annotation))
    result = run(reads, genes, config)
    if a.bam and files:
        contigs = bam.contigs(spark, a.reads)
        added = [c for c in ("cb", "ur", "uy", "xf", "ge", "gs", "ub") if c in result.reads.columns]
        tags = F.map_filter(F.map_concat(F.coalesce("tags", F.create_map().cast("map<string,string>")), F.create_map(*(x for c in added for x in (F.lit(c.upper()), F.col(c))))), lambda _, v: v.isNotNull())
        rows = output_order(result.reads.withColumn("tags", tags).drop(*added, "status"), contigs)
        rows.write.format("bam").mode("append").option("contigs", ",".join(f"{c.contig}:{c.length}" for c in contigs.orderBy("contig_idx").collect())).save(f"{a.out}/reads")
    else:
        result.reads.write.mode("overwrite").partitionBy("contig").parquet(f"{a.out}/reads")
    sinks.write_expression(result.expression, f"{a.out}/expression", reads=a.umi)
    text = spark.createDataFrame([(sinks.summary_text(result.summaries),)], "value string")
    text.coalesce(1).write.mode("overwrite").text(f"{a.out}/summary")
    if result.saturation is not None:
        sinks.write_saturation(result.saturation, f"{a.out}/saturation")
    if result.matrix is not None:
        sinks.write_matrix(*result.matrix, f"{a.out}/matrix")


if __name__ == "__main__":
    main()
