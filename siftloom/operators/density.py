"""A threshold between background and cells from the density of barcodes' counts.

Totals become a histogram on the cluster, and the histogram's mass is divided among the cells of a fixed
grid there too. The driver gets a row of sizes and at most as many rows as the grid has cells, whatever
the totals are, and estimates the density from them.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import settled

# Bandwidth in log10 units, cells of the grid, and points that the density is read at.
BANDWIDTH, GRID, POINTS = 0.1, 16_384, 10_000
#: Used where no threshold is found, or one out of range.
SAFE, LEAST, MOST = 500.0, 100.0, 100_000.0


def mode(histogram: DataFrame) -> DataFrame:
    """value: the most frequent total, of equals the largest; the least if none repeats."""
    top = histogram.agg(F.max(F.struct("n", "total")).alias("t"), F.min("total").alias("least"))
    return top.select(F.when(F.col("t.n") > 1, F.col("t.total")).otherwise(F.col("least")).alias("value"))


def histogram(totals: DataFrame) -> DataFrame:
    """total, n of barcodes."""
    return totals.groupBy("total").agg(F.count(F.lit(1)).alias("n"))


def grid(x_min: float, x_max: float) -> tuple[float, float]:
    """Where the grid begins, four bandwidths before the least value, and how wide its cells are."""
    low, high = x_min - 4 * BANDWIDTH, x_max + 4 * BANDWIDTH
    return low, (high - low) / (GRID - 1)


def binned(hist: DataFrame, low: float, step: float, weight: float) -> DataFrame:
    """cell, mass: that of a histogram (total, n; each counts n * weight), divided between the two cells next to
    the logarithm of a total in proportion to how near they are."""
    at = hist.select(((F.log10("total") - low) / step).alias("at"), (F.col("n") * weight).alias("w")).withColumn("cell", F.floor("at").cast("int"))
    part = F.col("at") - F.col("cell")
    both = F.array(F.struct("cell", (F.col("w") * (1 - part)).alias("mass")), F.struct((F.col("cell") + 1).alias("cell"), (F.col("w") * part).alias("mass")))
    return at.select(F.inline(both)).groupBy("cell").agg(F.sum("mass").alias("mass"))


def smoothed(mass: np.ndarray, low: float, step: float, x_min: float, x_max: float) -> tuple[np.ndarray, np.ndarray]:
    """Places and a Gaussian density at them, of the mass in the cells of a grid: it is convolved with the
    kernel by Fourier transforms."""
    mass = np.concatenate([mass, np.zeros(2 * GRID - len(mass))])
    apart = np.minimum(np.arange(2 * GRID), 2 * GRID - np.arange(2 * GRID)) * step
    kernel = np.exp(-0.5 * (apart / BANDWIDTH) ** 2) / (BANDWIDTH * math.sqrt(2 * math.pi))
    density = np.fft.irfft(np.fft.rfft(mass) * np.fft.rfft(kernel), 2 * GRID)[:GRID].clip(0)
    places = np.linspace(x_min, x_max, POINTS)
    return places, np.interp(places, low + step * np.arange(GRID), density)


def minima(y: np.ndarray) -> np.ndarray:
    """Indices of the local minima; where there are two turns at most, of those."""
    up = np.diff(y) > 0
    turns = np.flatnonzero(up[1:] != up[:-1]) + 1
    return turns if len(turns) <= 2 else turns[1 if up[0] else 0 :: 2]


def cells(totals: DataFrame) -> tuple[DataFrame, tuple[float, float]] | None:
    """The grid's cells with mass (cell, mass) of the totals from three below the mode on, and the least and the
    greatest logarithm of these; None where there are fewer than two values."""
    hist = settled(histogram(totals), "histogram")
    top = mode(hist).first()  # one row
    if top is None or top["value"] is None:
        return None
    kept = hist.filter(F.col("total") > top["value"] - 3)
    size = kept.agg(F.count(F.lit(1)).alias("values"), F.sum("n").alias("n"), F.log10(F.min("total")).alias("low"), F.log10(F.max("total")).alias("high")).first()  # one row
    if size["values"] < 2:
        return None
    return binned(kept, *grid(size["low"], size["high"]), 1 / size["n"]), (size["low"], size["high"])


def barcode_threshold(totals: DataFrame) -> float:
    """The total below which a barcode is background; the safe one where none is found, or one out of range,
    or where there are fewer than two values. totals: positive."""
    held = cells(totals)
    if held is None:
        return SAFE
    mass = np.zeros(GRID + 1)
    for row in held[0].collect():  # a row for each cell of the grid at most
        mass[row["cell"]] = row["mass"]
    places, y = smoothed(mass, *grid(*held[1]), *held[1])
    found = 0.0
    for i in minima(y)[::-1]:
        if i >= POINTS // 5 and (places[-1] - places[i] > 0.5 or places[i] < places[-1] / 2):
            found = 10 ** places[i]
            break
    return float(found) if LEAST <= found <= MOST else SAFE
