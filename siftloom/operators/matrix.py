"""The sparse matrix of barcodes and genes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .expression import across_contigs, barcode_totals
from .ranking import placed


def filtered(expression: DataFrame, threshold: float) -> DataFrame:
    """expression without the barcodes whose counts sum to less than the threshold."""
    low = barcode_totals(expression).filter(F.col("total") < threshold).select("barcode")
    return expression.join(low, "barcode", "left_anti")


def indexed(names: DataFrame, column: str, as_: str) -> DataFrame:
    """The distinct names with their places from 1 in the order of names."""
    return placed(names.select(column).distinct(), [column], as_).withColumn(as_, F.col(as_).cast("int"))


def triplets(expression: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(i, j, cnt), and the dictionaries (barcode, i) and (gene, j), from 1, barcodes as rows."""
    whole = across_contigs(expression)
    rows, cols = indexed(whole, "barcode", "i"), indexed(whole, "gene", "j")
    return whole.join(rows, "barcode").join(cols, "gene").select("i", "j", F.col("umi_cnt").alias("cnt")), rows, cols
