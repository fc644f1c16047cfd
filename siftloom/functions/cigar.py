"""Alignment operations as arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def operations(cigar: Column) -> Column:
    """array<struct<len, op>> of a CIGAR string; none for '*'."""
    found = F.regexp_extract_all(cigar, F.lit("(\\d+[MIDNSHP=X])"), F.lit(1))
    return F.transform(found, lambda t: F.struct(F.substring(t, F.lit(1), F.length(t) - 1).cast("int").alias("len"), F.right(t, F.lit(1)).alias("op")))


def reference_length(ops: Column) -> Column:
    """Bases of the reference that the operations go over."""
    return F.aggregate(ops, F.lit(0), lambda n, o: n + F.when(o["op"].isin("M", "D", "N", "=", "X"), o["len"]).otherwise(0))


def blocks(ops: Column, start: Column) -> Column:
    """array<struct<read_start, ref_start, len>> of the stretches aligned base to base; start is
    1-based, and so are all places."""
    kind = "array<struct<read_start:int,ref_start:int,len:int>>"
    begin = F.struct(start.alias("ref"), F.lit(1).alias("rd"), F.array().cast(kind).alias("b"))

    def step(a: Column, o: Column) -> Column:
        aligned = o["op"].isin("M", "=", "X")
        ref = a["ref"] + F.when(aligned | o["op"].isin("D", "N"), o["len"]).otherwise(0)
        rd = a["rd"] + F.when(aligned | o["op"].isin("I", "S"), o["len"]).otherwise(0)
        one = F.array(F.struct(a["rd"].alias("read_start"), a["ref"].alias("ref_start"), o["len"].alias("len")))
        return F.struct(ref.alias("ref"), rd.alias("rd"), F.when(aligned, F.concat(a["b"], one)).otherwise(a["b"]).alias("b"))

    return F.aggregate(ops, begin, step, lambda a: a["b"])
