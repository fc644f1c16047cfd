"""From annotation lines to genes with their transcripts and exons."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def contig_runs(annotation: DataFrame) -> DataFrame:
    """annotation with run: a gene name on several contigs is a gene for each stretch of lines on one."""
    by_name = Window.partitionBy("gene_name").orderBy("line_no")
    new = F.coalesce(F.col("contig") != F.lag("contig").over(by_name), F.lit(True))
    return annotation.withColumn("_new", new.cast("int")).withColumn("run", F.sum("_new").over(by_name).cast("int")).drop("_new")


def gene_extents(runs: DataFrame) -> DataFrame:
    """One row per gene run: extent, first id and strand, and order of appearance."""
    return runs.groupBy("gene_name", "run").agg(
        F.min("line_no").alias("gene_ord"),
        F.min_by("contig", "line_no").alias("contig"),
        F.min_by("gene_id", "line_no").alias("gene_id"),
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        (F.min_by("strand", "line_no") == "-").alias("neg_strand"),
        F.count_distinct("gene_id").alias("n_ids"),
    )


def transcript_models(runs: DataFrame) -> DataFrame:
    """One row per transcript that has exons: its bounds, its coding bounds (those of the transcript
    where it has none), and exons in order, touching ones merged; whether two overlap, and whether
    one ends before it starts."""
    exon, cds = F.col("feature") == "exon", F.col("feature") == "CDS"
    grouped = runs.filter("feature <> 'gene' and transcript_id <> ''").groupBy("gene_name", "run", "transcript_id").agg(
        F.sort_array(F.collect_list(F.when(exon, F.struct("start", "end")))).alias("exons"),
        F.min(F.when(cds, F.col("start"))).alias("_cs"),
        F.max(F.when(cds, F.col("end"))).alias("_ce"),
    )
    bounds = grouped.filter(F.size("exons") > 0).withColumns({"tx_start": F.array_min(F.transform("exons", lambda e: e["start"])), "tx_end": F.array_max(F.transform("exons", lambda e: e["end"]))})
    crossing = F.exists(F.sequence(F.lit(1), F.size("exons")), lambda i: F.coalesce(F.get("exons", i - 1)["end"] > F.get("exons", i)["start"], F.lit(False)))
    backward = F.exists("exons", lambda e: e["start"] > e["end"])
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def joined(a, e):
        last = F.get(a, F.size(a) - 1)
        return F.when(last["end"] >= e["start"], F.concat(F.slice(a, F.lit(1), F.size(a) - 1), F.array(F.struct(last["start"].alias("start"), F.greatest(last["end"], e["end"]).alias("end"))))).otherwise(F.concat(a, F.array(e)))

    return bounds.select(
        "gene_name", "run", F.col("transcript_id").alias("transcript_key"), "tx_start", "tx_end",
        F.coalesce("_cs", "tx_start").alias("cds_start"), F.coalesce("_ce", "tx_end").alias("cds_end"),
        crossing.alias("crossing"), backward.alias("backward"), F.aggregate("exons", empty, joined).alias("exons"),
    )


def repeated_names(runs: DataFrame) -> DataFrame:
    """gene_name of the genes of which two transcripts, by id, of a run have one name; a transcript is named
    by its first line."""
    named = runs.filter("feature <> 'gene' and transcript_id <> ''").groupBy("gene_name", "run", "transcript_id").agg(F.min_by("transcript_name", "line_no").alias("_name"))
    several = named.groupBy("gene_name", "run", "_name").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return several.select("gene_name").distinct()


def validation(annotation: DataFrame) -> DataFrame:
    """gene_name with what is wrong with it, one column a rule; a name is invalid if one of its runs is."""
    runs = contig_runs(annotation)
    extents = gene_extents(runs)
    stated = runs.filter("feature = 'gene'").join(extents.select("gene_name", "run", F.col("start").alias("_s"), F.col("end").alias("_e")), ["gene_name", "run"])
    off = stated.groupBy("gene_name").agg(F.max(((F.col("start") != F.col("_s")) | (F.col("end") != F.col("_e"))).cast("int")).alias("extent_differs"))
    lines = runs.groupBy("gene_name").agg(F.max(((F.col("feature") != "gene") & (F.col("transcript_id") == "")).cast("int")).alias("no_transcript_id"))
    models = transcript_models(runs)
    shapes = models.groupBy("gene_name").agg(F.max(F.col("crossing").cast("int")).alias("exons_overlap"), F.max(F.col("backward").cast("int")).alias("exon_backward"))
    per_run = extents.join(models.groupBy("gene_name", "run").agg(F.count(F.lit(1)).alias("_n")), ["gene_name", "run"], "left")
    ids = per_run.groupBy("gene_name").agg(F.max((F.col("n_ids") > 1).cast("int")).alias("several_ids"), F.max(F.col("_n").isNull().cast("int")).alias("no_transcripts"))
    rules = ["several_ids", "extent_differs", "no_transcript_id", "no_transcripts", "name_repeated", "exon_backward", "exons_overlap"]
    names = repeated_names(runs).withColumn("name_repeated", F.lit(1))
    out = ids.join(off, "gene_name", "left").join(lines, "gene_name", "left").join(shapes, "gene_name", "left").join(names, "gene_name", "left")
    out = out.select("gene_name", *(F.coalesce(r, F.lit(0)).alias(r) for r in rules))
    return out.withColumn("invalid", F.greatest(*rules))


def gene_model(annotation: DataFrame) -> DataFrame:
    """GENES of all valid gene names. A name that breaks a rule is left out with all its runs."""
    runs = contig_runs(annotation)
    bad = validation(annotation).filter("invalid = 1").select("gene_name")
    shape = F.struct("transcript_key", "tx_start", "tx_end", "cds_start", "cds_end", "exons")
    transcripts = transcript_models(runs).groupBy("gene_name", "run").agg(F.sort_array(F.collect_list(shape)).alias("transcripts"))
    genes = gene_extents(runs).join(transcripts, ["gene_name", "run"]).join(bad, "gene_name", "left_anti")
    return genes.select("gene_ord", "contig", "gene_name", "gene_id", "start", "end", "neg_strand", "transcripts")
