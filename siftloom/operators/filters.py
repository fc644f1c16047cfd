"""Selecting reads: by contig, range, hit index, mapping quality and identifier."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.reads import name_part, name_parts, plain_name, with_flag
from ..schemas import EXCLUDED_CONTIGS, QC_FAIL


def primary(hi: Column) -> Column:
    """A read of several hits counts by its first."""
    return hi.isNull() | (hi == 1)


def included(contig: Column) -> Column:
    return contig.isNotNull() & ~contig.isin(*EXCLUDED_CONTIGS)


def on_contig(reads: DataFrame, contig: str) -> DataFrame:
    """All reads of a contig; none of an excluded one. Prunes partitions of tables stored by contig."""
    return reads.filter((F.col("contig") == contig) & included(F.col("contig")))


def in_range(reads: DataFrame, contig: str, begin: int, end: int, length: Column, longest: int | None = None) -> DataFrame:
    """Reads of a contig that overlap the half-open range of 0-based places; length is theirs on the
    reference. longest: what no read's length exceeds, if that is known; with it the range is bounded on both
    sides by the position alone, which a source that is sorted can be searched for."""
    out = reads.filter((F.col("contig") == contig) & (F.col("pos") < end) & (F.col("pos") + length > begin))
    return out if longest is None else out.filter(F.col("pos") > begin - longest)


def first_read(reads: DataFrame, contigs: DataFrame) -> DataFrame:
    """The first read of the first included contig that has reads."""
    return reads.filter(included(F.col("contig"))).join(F.broadcast(contigs), "contig").orderBy("contig_idx", "file_idx", "rec_idx").limit(1)  # a header's contigs: thousands


def union_files(files: Sequence[DataFrame]) -> DataFrame:
    """All files' reads, file_idx being the place of each in the list."""
    return reduce(DataFrame.unionByName, [f.withColumn("file_idx", F.lit(k)) for k, f in enumerate(files)])


def same_contigs(headers: Sequence[DataFrame]) -> None:
    """Raises unless all files have the same contigs in the same order."""
    first = headers[0].orderBy("contig_idx").collect()
    for h in headers[1:]:
        if h.orderBy("contig_idx").collect() != first:
            raise ValueError("the headers of the input files differ")


def with_names(reads: DataFrame, source: str = "qname") -> DataFrame:
    """reads with cb, ur and uy (barcode, identifier and its qualities), and a plain qname. From tags,
    reads that lack one of the first two are left out."""
    if source == "tags":
        tag = lambda t: F.try_element_at("tags", F.lit(t))
        return reads.withColumns({"cb": tag("CB"), "ur": tag("UR"), "uy": F.coalesce(tag("UY"), F.lit(""))}).filter("cb is not null and ur is not null")
    parts = F.col("_parts")  # a column, so that a name is split once
    out = reads.withColumn("_parts", name_parts(F.col("qname")))
    return out.withColumns({"cb": name_part(parts, "CB"), "ur": name_part(parts, "UR"), "uy": name_part(parts, "UY"), "qname": plain_name(F.col("qname"))}).drop("_parts")


def check_names(reads: DataFrame, umi: bool) -> None:
    """Raises if the first read has no barcode, or no identifier where identifiers are wanted."""
    first = with_names(reads).select("cb", "ur").first()
    if first is not None and (not first["cb"] or (umi and not first["ur"])):
        raise ValueError("reads carry no barcode" if not first["cb"] else "reads carry no identifier")


def quality(reads: DataFrame, min_mapq: int, keep: bool) -> DataFrame:
    """reads with status keep or lowq. Reads of low quality are flagged if kept, else dropped."""
    good = F.col("mapq") >= min_mapq
    out = reads.withColumn("status", F.when(good, "keep").otherwise("lowq"))
    return out.withColumn("flag", F.when(good, F.col("flag")).otherwise(with_flag(F.col("flag"), QC_FAIL))) if keep else out.filter(good)


def clear_identifier(umi: Column) -> Column:
    return ~F.contains(umi, F.lit("N"))
