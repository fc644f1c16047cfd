"""Sequencing saturation: how much is new in growing samples of the reads.

A read stands for itself, so counts are exploded; each has a place in a random or given order, and a level
takes the places up to its share. Levels grow, so a read belongs to the first level that takes it and to all
later ones, and something is new at the first level that has it. So nothing is repeated by level: reads are
told their first level where they are read, by the eleven reads at which levels end; distinct things are
counted at the least level of their reads; and the counts are added up over levels, unit by unit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reads import barcode_column, barcode_row
from ..schemas import NO_GENE
from ..session import settled
from .ranking import placed

# The shares of the reads that are sampled, and the side of a spatial bin.
LEVELS = (0.05, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
BIN_SIDE = 150
#: Bits of an order of 62 that tell its ranges apart: 65,536 of them.
RANGE_SHIFT = 46


def exploded(counts: DataFrame) -> DataFrame:
    """barcode, gene, umi, once for each read of counts (with cnt), and _k, from 1."""
    return counts.filter("cnt > 0").withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("cnt").cast("bigint")))).drop("cnt")


def spatial_bin(barcode: Column) -> Column:
    """The bin of a barcode that ends in _row_column, as text: the row's bin and the column's."""
    return F.concat_ws("_", F.floor(barcode_row(barcode) / BIN_SIDE).cast("string"), F.floor(barcode_column(barcode) / BIN_SIDE).cast("string"))


def ends(reads: DataFrame, by: list[str]) -> list[tuple | None]:
    """For each level the values of by of its last read in their order, None if it takes no read; by begins
    with _o, a whole number from 0 to 2**62.

    Reads are counted by range of _o, and only those of the at most eleven ranges in which a level ends are
    put in order. The driver gets eleven rows.
    """
    sizes = reads.groupBy(F.shiftright("_o", RANGE_SHIFT).alias("r")).agg(F.count(F.lit(1)).alias("n"))
    sizes = settled(sizes.withColumn("upto", F.sum("n").over(Window.orderBy("r"))), "ranges")  # 65,536 rows at most
    total = sizes.agg(F.max("upto")).first()[0] or 0
    takes = [int(x * total) for x in LEVELS]
    marks = F.array(*(F.lit(m).cast("long") for m in sorted({*takes} - {0}))).cast("array<long>")
    inside = F.filter(marks, lambda m: (m <= F.col("upto")) & (m > F.col("upto") - F.col("n")))
    met = sizes.select("*", F.explode(inside).alias("m")).orderBy("m").collect()  # 11 rows
    behind, places, last = 0, {}, None
    for row in met:
        if row.r != last:
            behind, last = behind + (held if last is not None else 0), row.r
        held = row.n
        places[behind + row.m - (row.upto - row.n)] = row.m
    found = {}
    if places:
        ordered = placed(reads.filter(F.shiftright("_o", RANGE_SHIFT).isin([row.r for row in met])).select(*by), by, "_rn")
        found = {places[r["_rn"]]: tuple(r[c] for c in by) for r in ordered.filter(F.col("_rn").isin(list(places))).collect()}
    return [found.get(m) for m in takes]


def leveled(reads: DataFrame, order: Column) -> DataFrame:
    """reads with level, the place in LEVELS (from 0) of the first that takes them, by an order from 0 to
    2**62; equals go by the other columns, and what is equal in all of them is taken together. Reads are read
    twice for the ends of levels, and not shuffled."""
    others = [c for c in reads.columns if c != "_key"]
    keyed = reads.withColumn("_o", order)
    by = ["_o", *others]
    level = F.lit(None).cast("int")
    for k, end in reversed(list(enumerate(ends(keyed, by)))):
        if end is not None:
            last = F.struct(*(F.lit(v).cast(keyed.schema[c].dataType).alias(c) for c, v in zip(by, end, strict=True)))
            level = F.when(F.struct(*by) <= last, k).otherwise(level)
    return keyed.select(*others, level.alias("level")).filter("level is not null")


def first_seen(reads: DataFrame, unit: str = "barcode") -> DataFrame:
    """By unit, gene and umi the level at which it is first seen, and n0, n1, ..., how many of its reads are
    first taken at each. reads: with level, or a table like this one by a finer unit."""
    again = "n0" in reads.columns
    first = F.min("first" if again else "level").alias("first")
    n = [F.sum(f"n{k}") if again else F.count_if(F.col("level") == k) for k in range(len(LEVELS))]
    return reads.groupBy(unit, "gene", "umi").agg(first, *(c.alias(f"n{k}") for k, c in enumerate(n)))


def curve(seen: DataFrame, unit: str, x: str = "x", y1: str = "y1", y2: str = "y2") -> DataFrame:
    """By sample: reads per unit (barcode or bin), the share of repeated reads among those with a gene, and
    the median number of genes of a unit; of first_seen by that unit. A sample without reads has no row."""
    levels = range(len(LEVELS))
    known = F.col("gene") != NO_GENE
    genes = seen.groupBy(unit, "gene").agg(F.min("first").alias("first"), *(F.sum(f"n{k}").alias(f"n{k}") for k in levels), *(F.count_if(F.col("first") == k).alias(f"u{k}") for k in levels))
    sums = {f"n{k}": F.sum(f"n{k}") for k in levels}
    sums |= {f"s{k}": F.sum(F.when(known, F.col(f"n{k}")).otherwise(0)) for k in levels}
    sums |= {f"u{k}": F.sum(F.when(known, F.col(f"u{k}")).otherwise(0)) for k in levels}
    sums |= {f"g{k}": F.count_if(known & (F.col("first") == k)) for k in levels}
    own = genes.groupBy(unit).agg(*(c.alias(name) for name, c in sums.items()))

    def upto(name: str, k: int) -> Column:
        return sum((F.col(f"{name}{j}") for j in range(1, k + 1)), F.col(f"{name}0"))

    each = [F.struct(F.lit(x).alias("sample"), upto("n", k).alias("reads"), upto("s", k).alias("sat"), upto("u", k).alias("uniq"), upto("g", k).alias("genes")) for k, x in enumerate(LEVELS)]
    per = own.select(F.inline(F.array(*each))).filter("reads > 0")
    # the median from a histogram, which is no longer than a unit's genes are many
    hist = per.groupBy("sample", "genes").agg(F.count(F.lit(1)).alias("units"), *(F.sum(c).alias(c) for c in ("reads", "sat", "uniq")))
    whole, so_far = Window.partitionBy("sample"), Window.partitionBy("sample").orderBy("genes")
    hist = hist.withColumns({"_c": F.sum("units").over(so_far), **{f"_{c}": F.sum(c).over(whole) for c in ("units", "reads", "sat", "uniq")}})
    out = hist.filter(F.col("_c") > F.floor(F.col("_units") / 2)).groupBy("sample").agg(F.min("genes").alias(y2), *(F.first(f"_{c}").alias(c) for c in ("units", "reads", "sat", "uniq")))
    return out.select("sample", F.floor(F.col("reads") / F.col("units")).alias(x), F.round(1 - F.try_divide(F.col("uniq"), F.col("sat")), 6).alias(y1), y2)


def saturation(counts: DataFrame, coordinates: bool, order: Column | None = None, seed: int = 1) -> DataFrame:
    """bar_x, bar_y1, bar_y2 by sample, and bin_x, bin_y1, bin_y2 if barcodes have coordinates. Without
    an order, reads go by a hash of what they are, so that a task that runs again agrees."""
    drawn = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "barcode", "gene", "umi", "_k"), 2)
    seen = first_seen(leveled(exploded(counts), drawn if order is None else order))
    if not coordinates:
        return curve(seen, "barcode", "bar_x", "bar_y1", "bar_y2")
    seen = settled(seen, "seen")
    bins = first_seen(seen.withColumn("bin", spatial_bin(F.col("barcode"))), "bin")
    return curve(seen, "barcode", "bar_x", "bar_y1", "bar_y2").join(curve(bins, "bin", "bin_x", "bin_y1", "bin_y2"), "sample")
