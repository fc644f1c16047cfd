"""Places of rows in a global order, without one task that holds them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import settled

#: Bits of a generated id that count rows within a partition.
WITHIN = 33


def placed(rows: DataFrame, by: list[str], as_: str) -> DataFrame:
    """rows with their places from 1 in ascending order of by, as a table.

    Rows are dealt into ranges whose bounds Spark samples from them, so ranges are about equal whatever the
    values look like, and sorted there; a row's place is the one in its range after all rows of the ranges
    before. Only the ranges' sizes, a row for each partition, are added up in one task. Rows that are equal
    in all of by stand together, in any order.
    """
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id())
    dealt = settled(dealt, "places").withColumn("_part", F.shiftright("_id", WITHIN))
    sizes = dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")
    sizes = sizes.select(F.col("_part").alias("_of"), before.alias("_before"))
    out = dealt.join(F.broadcast(sizes), F.col("_part") == F.col("_of"))  # a row for each partition
    within = F.col("_id").bitwiseAND((1 << WITHIN) - 1)
    return out.withColumn(as_, F.col("_before") + within + 1).drop("_id", "_part", "_of", "_before")
