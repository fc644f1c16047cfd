"""Exact deduplication over an extendible-hash index on files in the shared folder.

The index is keyed by a 64-bit hash of the text, and a bucket is the range of hashes that share their
leading bits. The directory starts with as many bits as the texts' number asks for. The task that
owns a range receives the texts of its buckets, chains those whose hashes collide by comparing their
bytes, and writes its buckets to files, an entry for each link of a chain. Buckets with more entries
than their capacity are then split: the directory doubles, and their files are written anew as two
buckets, told apart by the next bit, until none is overfull. Documents find their bucket through the
directory and read their entry there.

Texts go over the network once, to their bucket's owner. Only hashes with very many copies are
combined where they are read first, so that no owner gets a hot text in full.

Everything here is DataFrame operations.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import ascii_lower, cut, maybe_broadcast, new_folder

#: Entries that a bucket may hold before it is split.
CAPACITY = 2_000
#: Copies of one hash beyond which they are combined before they are sent to the bucket's owner.
HOT = 10_000


def bucket_of(h: Column, depth: int) -> Column:
    """The bucket of a hash in a directory of so many bits: its leading ones."""
    return F.shiftrightunsigned(h, 64 - depth) if depth else F.lit(0).cast("long")


def chained(entries: DataFrame) -> DataFrame:
    """_bucket, _h, _chain, _sha, keep_id and group_size of entries (_bucket, _h, _norm, _keep, _n).

    The owner of a bucket goes through the texts of a hash in order and compares each with the one
    before, byte by byte; equal ones are one link of the hash's chain.
    """
    w = Window.partitionBy("_bucket", "_h").orderBy("_norm")
    before = F.lag("_norm").over(w)
    linked = entries.repartition("_bucket").withColumn("_new", F.when(before == F.col("_norm"), 0).otherwise(1))
    linked = linked.withColumn("_chain", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return linked.groupBy("_bucket", "_h", "_chain").agg(F.max(F.sha2("_norm", 256)).alias("_sha"), F.max("_keep").alias("keep_id"), F.sum("_n").alias("group_size"))


def _written(buckets: DataFrame, folder: str, depth: int) -> DataFrame:
    """The files of a level of the index: buckets of so many bits, each in one file, in order."""
    spark, at = buckets.sparkSession, f"{folder}/depth={depth}"
    buckets.sortWithinPartitions("_bucket", "_h", "_chain").write.parquet(at)
    return spark.read.schema(buckets.schema).parquet(at)


def build_index(entries: DataFrame, depth: int, capacity: int = CAPACITY) -> tuple[DataFrame, list[tuple[int, DataFrame]]]:
    """The index of entries (_h, _norm, _keep, _n): its buckets (_depth, _bucket and what chained()
    gives), and the directory: by level the buckets of so many bits that were split further."""
    folder = new_folder(entries.sparkSession, "index")
    level = _written(chained(entries.withColumn("_bucket", bucket_of(F.col("_h"), depth))), folder, depth)
    settled, directory = [], []
    while depth < 64:
        sizes = level.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n"), F.min("_h").alias("a"), F.max("_h").alias("b"))
        over = cut(sizes.filter((F.col("n") > capacity) & (F.col("a") < F.col("b"))).select("_bucket"))  # one hash alone can't be split
        if not (n := over.count()):
            break
        over = maybe_broadcast(over, n)
        directory.append((depth, over))
        settled.append(level.join(over, "_bucket", "left_anti").withColumn("_depth", F.lit(depth)))
        depth += 1
        halves = level.join(over, "_bucket", "left_semi").withColumn("_bucket", bucket_of(F.col("_h"), depth))
        level = _written(halves.select(*level.columns).repartition("_bucket"), folder, depth)
    settled.append(level.withColumn("_depth", F.lit(depth)))
    return reduce(DataFrame.unionByName, settled), directory


def located(rows: DataFrame, depth: int, directory: list[tuple[int, DataFrame]]) -> DataFrame:
    """rows (with _h) and the _depth and _bucket at which the directory has them."""
    out = rows.withColumns({"_depth": F.lit(depth), "_bucket": bucket_of(F.col("_h"), depth)})
    for level, split in directory:
        here = split.select(F.col("_bucket").alias("_was"), F.lit(level).alias("_at"))
        out = out.join(here, (F.col("_bucket") == F.col("_was")) & (F.col("_depth") == F.col("_at")), "left")
        deeper = F.col("_was").isNotNull()
        out = out.withColumns({"_bucket": F.when(deeper, bucket_of(F.col("_h"), level + 1)).otherwise(F.col("_bucket")), "_depth": F.when(deeper, F.lit(level + 1)).otherwise(F.col("_depth"))}).drop("_was", "_at")
    return out


def exact_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", capacity: int = CAPACITY, hot: int = HOT, hashed: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """key, keep_id, group_size, kept and text_sha256 of every document.

    Texts are equal when they are after lowering A to Z; null counts as empty. Of equal texts the
    row with the largest key stays; a null key is below all others. Of rows that repeat both key
    and text one stays. Other columns of docs, whatever their names, are left out. An empty table
    gives an empty one. hashed: the hash of a text, a bigint.
    """
    norm = ascii_lower(F.coalesce(F.col(text), F.lit("")))
    base = docs.select(F.col(key).alias("_key"), norm.alias("_norm")).withColumn("_h", hashed(F.col("_norm")))
    rows = cut(base.select("_key", "_h", F.sha2("_norm", 256).alias("_sha"), F.monotonically_increasing_id().alias("_id")))
    sizes = cut(rows.groupBy("_h").agg(F.count(F.lit(1)).alias("_c")))
    n_hashes = sizes.count()
    frequent = cut(sizes.filter(F.col("_c") > hot).select("_h"))
    n_hot = frequent.count()  # at most a row for each so many rows of docs

    entries = base.select("_h", "_norm", F.col("_key").alias("_keep"), F.lit(1).cast("long").alias("_n"))
    if n_hot:
        some = maybe_broadcast(frequent, n_hot)
        combined = entries.join(some, "_h", "left_semi").groupBy("_h", "_norm").agg(F.max("_keep").alias("_keep"), F.sum("_n").alias("_n"))
        entries = entries.join(some, "_h", "left_anti").unionByName(combined)
    depth = max(0, math.ceil(math.log2(max(1, n_hashes) / capacity)))
    index, directory = build_index(entries, depth, capacity)

    at = ["_depth", "_bucket", "_h", "_sha"]
    found = located(rows, depth, directory)
    out = found.join(index.drop("_chain"), at) if not n_hot else (
        found.join(some, "_h", "left_anti").join(index.drop("_chain"), at).unionByName(found.join(maybe_broadcast(index.join(some, "_h", "left_semi").drop("_chain"), n_hot), at))
    )
    kept = F.col("_key").eqNullSafe(F.col("keep_id"))
    again = cut(rows.groupBy("_key", "_sha").agg(F.min("_id").alias("_one"), F.count(F.lit(1)).alias("_c")).filter("_c > 1").select(F.col("_key").alias("_k"), F.col("_sha").alias("_s"), "_one"))
    if n_again := again.count():
        out = out.join(maybe_broadcast(again, n_again), F.col("_key").eqNullSafe(F.col("_k")) & (F.col("_sha") == F.col("_s")), "left")
        kept = kept & (F.col("_one").isNull() | (F.col("_one") == F.col("_id")))
    return out.select(F.col("_key").alias(key), "keep_id", "group_size", kept.alias("kept"), F.col("_sha").alias("text_sha256"))
