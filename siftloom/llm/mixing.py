"""Mixing sources to target weights by hash thresholds found from histograms.

A document is taken when its hash lies below its source's threshold, so the choice needs no order
and a larger budget takes all that a smaller one does. Where a threshold lies is found from sums of
tokens by source and hash bucket; only the bucket in which a budget ends is looked at more closely,
bit by bit of the hash. Nothing is sorted, and the hot source is summed before any exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, word_count

#: Bits of the hash that one level of the histogram tells apart, and the levels that make up the hash.
BITS, LEVELS = 8, 7
#: Sources that one mix may have: a list of them, with their sizes, is held by the driver.
MOST_SOURCES = 10_000


def targets(sizes: dict[str | None, int], share: float = 1.5, weights: Sequence[float] = (5, 2, 1), most: float = 2.0) -> dict[str | None, float]:
    """Target of each source: share of all sizes, dealt by weights that repeat over the sources in
    order of code points, null last. No target is above most times its source's size; what is above
    goes to the others by weight until none is."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, out = share * sum(sizes.values()), [*order], {}
    while open_:
        total = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / total > most * sizes[s]]
        if not full:
            return out | {s: left * weight[s] / total for s in open_}
        for s in full:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in full)
        open_ = [s for s in open_ if s not in out]
    return out


def thresholds(docs: DataFrame, budgets: dict[str | None, float]) -> dict[str | None, int]:
    """The threshold of each source: its documents whose hash is below it have as many words as the
    budget, as nearly as the document at which the budget ends lets them.

    docs has _source, _hash and size. Each level sums it by source and bucket, after the first only
    within the buckets in which a budget ends, until there is one document in such a bucket, or
    copies that share a hash. The driver sees a row for each source and bucket.
    """
    spark = docs.sparkSession
    out: dict[str | None, int] = {}
    ends = {s: (0, b) for s, b in budgets.items()}  # the bits above the bucket, and what of the budget ends in it
    for level in range(LEVELS):
        if not ends:
            break
        rest = BITS * (LEVELS - level - 1)
        looked = docs
        if level:
            at = spark.createDataFrame([(s, p) for s, (p, _) in ends.items()], "_s string, _p long")
            looked = docs.join(F.broadcast(at), F.col("_source").eqNullSafe(F.col("_s")) & (F.shiftright("_hash", rest + BITS) == F.col("_p")), "left_semi")
        bucket = F.shiftright("_hash", rest).bitwiseAND((1 << BITS) - 1)
        sums: dict[str | None, list[tuple[int, int, int]]] = {}
        for r in looked.groupBy("_source", bucket.alias("_b")).agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("n")).collect():
            sums.setdefault(r["_source"], []).append((r["_b"], r["size"], r["n"]))
        for s, (prefix, left) in [*ends.items()]:
            for b, size, n in sorted(sums.get(s, [])):
                if size <= left:
                    left -= size
                    continue
                here = (prefix << BITS) + b
                if n == 1 or level + 1 == LEVELS:
                    out[s] = (here + (2 * left >= size)) << rest
                else:
                    ends[s] = here, left
                break
            else:
                out[s] = (prefix + 1) << (rest + BITS)
        ends = {s: v for s, v in ends.items() if s not in out}
    return out


def _hash(key: str, text: str) -> Column:
    """The first bits of the MD5 of key and text, a number that is not negative."""
    whole = F.concat(F.coalesce(F.col(key).cast("string"), F.lit("")), F.lit("\x1f"), F.coalesce(text, F.lit("")))
    return F.conv(F.left(F.md5(whole.cast("binary")), F.lit(BITS * LEVELS // 4)), 16, 10).cast("long")


def plan(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), most: float = 2.0, text: str = "text", key: str = "doc_id", source: str = "source") -> tuple[DataFrame, DataFrame]:
    """_key, _source, size and _hash of every row of docs, and the mix's table of sources: _source,
    source_size, target, how often the source is taken whole, and its threshold for once more."""
    base = cut(docs.select(F.col(key).alias("_key"), F.col(source).cast("string").alias("_source"), word_count(F.col(text)).alias("size"), _hash(key, text).alias("_hash")))
    found = base.groupBy("_source").agg(F.sum("size").alias("size")).take(MOST_SOURCES + 1)
    if len(found) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources")
    sizes = {r["_source"]: r["size"] for r in found}
    goal = {s: round(x, 6) for s, x in targets(sizes, share, weights, most).items()}
    whole = {s: min(int(goal[s] // n), int(most)) if n else 0 for s, n in sizes.items()}
    below = thresholds(base, {s: b for s, n in sizes.items() if (b := goal[s] - whole[s] * n) > 0.5})
    rows = [(s, n, float(goal[s]), whole[s], below.get(s, 0)) for s, n in sizes.items()]
    return base, docs.sparkSession.createDataFrame(rows, "_name string, source_size long, target double, _whole int, _below long")


def _timed(rows: DataFrame, table: DataFrame) -> DataFrame:
    """rows (with _source and _hash) joined to their source, and _times, how often the mix takes each."""
    out = rows.join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("_name")), "left")  # a row for each source, MOST_SOURCES at most
    return out.withColumn("_times", F.col("_whole") + (F.col("_hash") < F.col("_below")).cast("int"))


def mix(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), most: float = 2.0, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """key, source, size, source_size, target and taken of every document.

    size is the number of words, 0 for null. taken is size times the number of times that the mix
    takes the document: a source whose target is above its size is taken whole, and again as far as
    its threshold reaches. The hash covers key and text, so rows repeated whole go together; reruns
    agree. Null sources are a source of their own, the last. An empty table gives an empty one.
    """
    base, table = plan(docs, share, weights, most, text, key, source)
    return _timed(base, table).select(F.col("_key").alias(key), F.col("_source").alias(source), "size", "source_size", "target", (F.col("size") * F.col("_times")).alias("taken"))


def mix_rows(docs: DataFrame, share: float = 1.5, weights: Sequence[float] = (5, 2, 1), most: float = 2.0, text: str = "text", key: str = "doc_id", source: str = "source") -> DataFrame:
    """docs with _times, how often the mix takes each row; see mix()."""
    _, table = plan(docs, share, weights, most, text, key, source)
    rows = docs.withColumns({"_source": F.col(source).cast("string"), "_hash": _hash(key, text)})
    return _timed(rows, table.drop("source_size", "target")).select(*docs.columns, "_times")
