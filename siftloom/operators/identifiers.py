"""Correcting identifiers of large groups: near pairs by deletion variants, roots by rounds.

Two identifiers within m places of each other share a variant in which m places are blanked, so pairs are
found by an equality join on variants, of which a key holds few (an alphabet to the power of m), never by
comparing a group with itself. Who is whose root is then a matter of these pairs alone: an identifier is a
root if no earlier one next to it is. In every round those with no undecided earlier neighbour become
roots, and their later neighbours are decided with them.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.reads import hamming
from ..session import settled
from .ranking import placed

#: Undecided pairs of a group that one task may hold to decide them in order.
LEFT = 200_000


def variants(text: Column, length: Column, blanks: int) -> Column:
    """Array of text's first length characters with each choice of places blanked; one of '' if there are not
    that many places."""

    def rest(done: Column, at: Column, blanks: int) -> Column:
        if not blanks:
            return F.array(F.concat(done, F.substring(text, at, length - at + 1)))
        each = F.transform(F.sequence(at, length - (blanks - 1)), lambda i: rest(F.concat(done, F.substring(text, at, i - at), F.lit("\0")), i + 1, blanks - 1))
        return F.flatten(each)

    return F.when(length < blanks, F.array(F.lit(""))).otherwise(rest(F.lit(""), F.lit(1), blanks))


def near_pairs(names: DataFrame, mismatch: int, id_: str = "id", group: str = "group", name: str = "name") -> DataFrame:
    """(x, r): all pairs of ids of a group, r < x, of which the names are within mismatch places of each
    other; as hamming counts, by x's places: where r has ended they differ, and what r has beyond x does
    not count. names: unique ids, group, name.

    Names of one length, as is usual, are keyed by their variants once. Of a longer r, its beginnings of the
    lengths that its group has are keyed as well; of a longer x, its beginning that is as long as r.
    """
    lengths = names.groupBy(F.col(group).alias("_g")).agg(F.collect_set(F.length(name)).alias("_lens"))
    rows = names.select(F.col(id_).alias("id"), F.col(group).alias("g"), F.col(name).alias("name"))
    # a group has no more lengths than its longest name has characters
    rows = rows.join(lengths, F.col("g") == F.col("_g")).drop("_g").withColumn("n", F.length("name"))
    later, earlier = [], []

    def keyed(at: DataFrame, short: int, as_: str) -> DataFrame:
        each = F.explode(variants(F.col("name"), F.col("size"), mismatch - short))
        return at.withColumn("key", each).select(F.col("id").alias(as_), F.col("name").alias(f"{as_}n"), "g", F.lit(short).alias("short"), "size", "key")

    for short in range(mismatch + 1):
        x = rows.withColumn("size", F.col("n") - short)
        later.append(keyed(x.filter(F.array_contains("_lens", F.col("size"))), short, "x"))
        if short:
            r = rows.filter(F.array_contains("_lens", F.col("n") + short)).withColumn("size", F.col("n"))
        else:
            r = rows.withColumn("size", F.explode(F.filter("_lens", lambda k: k <= F.col("n"))))
        earlier.append(keyed(r, short, "r"))
    every = later[0], earlier[0]
    for a, b in zip(later[1:], earlier[1:], strict=True):
        every = every[0].unionByName(a), every[1].unionByName(b)
    met = every[0].join(every[1], ["g", "short", "size", "key"]).filter((F.col("r") < F.col("x")) & (hamming(F.col("xn"), F.col("rn")) <= mismatch))
    return met.select("g", "x", "r").distinct()


def _in_order(frame: pd.DataFrame) -> pd.DataFrame:
    """Which x of pairs of a group are no roots, going through them in order."""
    gone: set[int] = set()
    frame = frame.sort_values(["x", "r"])
    for x, r in zip(frame["x"].tolist(), frame["r"].tolist(), strict=True):
        if x not in gone and r not in gone:
            gone.add(x)
    return pd.DataFrame({"id": sorted(gone)}, dtype="int64")


def collapsed(pairs: DataFrame, left: int = LEFT) -> DataFrame:
    """(x, root) of all x that are no roots, by pairs (g, x, r): the first r before it that is one.

    Rounds go on while a group has more undecided pairs than left; what then remains is decided in order,
    a group in a task. A round's pairs are written, and fewer than those of the round before. As many rounds
    are needed as the longest row of identifiers in which each waits for the one before: with equally
    frequent ones at most three times their length, usually a handful.
    """
    rest, gone = pairs, []
    while True:
        sizes = rest.groupBy("g").agg(F.count(F.lit(1)).alias("n")).agg(F.max("n")).first()
        if sizes[0] is None:
            break
        if sizes[0] <= left:
            gone.append(rest.select("g", "x", "r").groupBy("g").applyInPandas(_in_order, "id bigint"))
            break
        later = rest.select(F.col("x").alias("id")).distinct()
        roots = rest.select(F.col("r").alias("id")).distinct().join(later, "id", "left_anti")
        hit = settled(rest.join(roots, F.col("r") == F.col("id"), "left_semi").select(F.col("x").alias("id")).distinct(), "decided")
        gone.append(hit)
        rest = rest.join(hit, F.col("x") == F.col("id"), "left_anti").join(hit.withColumnRenamed("id", "_id"), F.col("r") == F.col("_id"), "left_anti")
        rest = settled(rest, "undecided")
    if not gone:
        return pairs.select("x", F.col("r").alias("root")).limit(0)
    out = gone[0]
    for more in gone[1:]:
        out = out.unionByName(more)
    out = settled(out, "decided")
    alive = pairs.join(out.withColumnRenamed("id", "_id"), F.col("r") == F.col("_id"), "left_anti")
    return alive.join(out, F.col("x") == F.col("id"), "left_semi").groupBy("x").agg(F.min("r").alias("root"))


def rooted(counts: DataFrame, mismatch: int, left: int = LEFT) -> DataFrame:
    """counts (contig, barcode, gene, umi, cnt; unique but for cnt) with root_umi: of each group's
    identifiers, the most frequent first and equals by name, the first root before it within mismatch
    places, or itself."""
    keys = ["contig", "barcode", "gene"]
    groups = placed(counts.select(*keys).distinct(), keys, "g").select(*(F.col(k).alias(f"_{k}") for k in keys), "g")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    rows = counts.join(groups, same[0] & same[1] & same[2]).withColumn("_o", -F.col("cnt"))
    rows = settled(placed(rows, ["_o", "umi", "g"], "id").select("id", "g", *keys, "umi", "cnt"), "identifiers")
    pairs = settled(near_pairs(rows, mismatch, "id", "g", "umi"), "pairs")
    found = collapsed(pairs, left)
    names = rows.select(F.col("id").alias("root"), F.col("umi").alias("_root"))
    met = found.join(names, "root").select(F.col("x").alias("id"), "_root")
    return rows.join(met, "id", "left").select(*keys, "umi", "cnt", F.coalesce("_root", "umi").alias("root_umi"))
