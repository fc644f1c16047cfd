"""Where aligned blocks lie in a gene, by arithmetic on intervals instead of bases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import CODING, INTERGENIC, INTRONIC, NONE, UTR


def width(start: Column, end: Column) -> Column:
    return F.greatest(F.lit(0), end - start + 1)


def total(items: Column, of) -> Column:
    return F.aggregate(items, F.lit(0), lambda n, x: n + of(x))


def overlap(s1: Column, e1: Column, s2: Column, e2: Column) -> Column:
    """Whether two closed intervals meet."""
    return (s1 <= e2) & (s2 <= e1)


def _end(b: Column) -> Column:
    return b["ref_start"] + b["len"] - 1


def exon_bases(b: Column, t: Column) -> Column:
    """Bases of block b in the exons of transcript t, which do not overlap."""
    return total(t["exons"], lambda e: width(F.greatest(b["ref_start"], e["start"]), F.least(_end(b), e["end"])))


def clipped(b: Column, t: Column) -> Column:
    return width(F.greatest(b["ref_start"], t["tx_start"]), F.least(_end(b), t["tx_end"]))


def coding_bases(b: Column, t: Column) -> Column:
    return total(t["exons"], lambda e: width(F.greatest(b["ref_start"], e["start"], t["cds_start"]), F.least(_end(b), e["end"], t["cds_end"])))


def block_function(b: Column, t: Column) -> Column:
    """The highest function that a base of block b has in transcript t."""
    return F.when(coding_bases(b, t) > 0, CODING).when(exon_bases(b, t) > 0, UTR).when(clipped(b, t) > 0, INTRONIC).otherwise(INTERGENIC)


def gene_function(blocks: Column, transcripts: Column) -> Column:
    """The highest function over all blocks and transcripts."""
    return F.coalesce(F.array_max(F.transform(blocks, lambda b: F.array_max(F.transform(transcripts, lambda t: block_function(b, t))))), F.lit(INTERGENIC))


def gene_counts(blocks: Column, transcripts: Column) -> Column:
    """struct<exon, intron>: over blocks, the sums of the transcript with the most exon bases, of
    equals the most intron bases."""
    none = F.struct(F.lit(0).alias("exon"), F.lit(0).alias("intron"))

    def best(b: Column) -> Column:
        found = F.transform(transcripts, lambda t: F.struct(exon_bases(b, t).alias("exon"), clipped(b, t).alias("all")))
        each = F.transform(found, lambda x: F.struct(x["exon"].alias("exon"), (x["all"] - x["exon"]).alias("intron")))
        return F.greatest(none, F.coalesce(F.array_max(each), none))

    return F.aggregate(F.transform(blocks, best), none, lambda a, x: F.struct((a["exon"] + x["exon"]).alias("exon"), (a["intron"] + x["intron"]).alias("intron")))


def count_function(exon: Column, intron: Column, length: Column) -> Column:
    """The function that counts of bases stand for: half of the aligned bases, rounded down, in exons
    are exonic."""
    return F.when(exon >= F.floor(length * 0.5), CODING).when(intron > 0, INTRONIC).otherwise(INTERGENIC)


def combined(functions: Column, conservative: bool = False) -> Column:
    """One function for an array of them: the highest, or NONE if conservative and they differ;
    intergenic if there are none."""
    top = F.coalesce(F.array_max(functions), F.lit(INTERGENIC))
    return F.when(F.array_min(functions) != F.array_max(functions), NONE).otherwise(top) if conservative else top


def touches_exon(b: Column, transcripts: Column) -> Column:
    """Whether block b meets an exon of a transcript."""
    return F.exists(transcripts, lambda t: F.exists(t["exons"], lambda e: overlap(b["ref_start"], _end(b), e["start"], e["end"])))


def label(rank: Column) -> Column:
    from ..schemas import LOCUS

    out = F.lit(None).cast("string")
    for k, name in LOCUS.items():
        out = F.when(rank == k, name).otherwise(out)
    return out
