"""A Merkle manifest of a table: digests of rows, of groups of rows and of the whole, with proofs.

Nodes of a group stand in order; every three in a row have a parent, whose preimage is their digests one
after the other. The preimage is what is kept of a parent: a leaf finds its siblings at a level by cutting
its own 64 characters out of its ancestor's preimage there, and a changed leaf is folded to the root by
putting the new digest into that place and hashing what results, level by level.

Levels are worked off in tiers of five: 243 consecutive nodes are gathered into one row, which holds the
preimages of the up to five levels above them, and whose root is a node of the next tier. So a table of n
rows takes log243(n) shuffles, each 243 times smaller than the one before, and a row is never more than 243
nodes. Downwards each tier's blocks meet the block above, one join a tier, and leaves read their ancestors
from the block they stand in.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_mod, cut, in_arrow, maybe_broadcast, schema_and

FAN, TIER = 3, 5
#: Nodes of a block.
BLOCK = FAN**TIER
#: The fields of a leaf.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(*fields: Column) -> Column:
    """sha256 of the fields, each its length in UTF-8 bytes, a colon and itself, or - if it is null."""
    texts = [c.cast("string") for c in fields]
    sized = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*sized).cast("binary"), 256)


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """rows with _i, their place from 0 in their group by order, and _n, the group's size, as a table.

    rows is read twice, for the bounds of the ranges and to be dealt. Rows are dealt by range of (group, order) and counted within their partition, then moved on by what
    the group has in the partitions before; a group with most of the rows is spread over most of the
    partitions, and so are rows that are equal throughout.
    """
    dealt = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.col(group).asc_nulls_first(), *(F.col(c).asc_nulls_first() for c in order), F.col("_tie")]
    dealt = dealt.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie")
    at = dealt.columns.index(group)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, n = TaskContext.get().partitionId(), None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            names, places = batch.column(at), []
            runs = pc.run_end_encode(names)
            start = 0
            for name, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist(), strict=True):
                n = n if last is not None and last[0] == name else 0
                last = (name,)
                places.extend(range(n, n + end - start))
                n, start = n + end - start, end
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([part] * batch.num_rows, pa.int32()), pa.array(places, pa.int64())], names=[*batch.schema.names, "_part", "_i"])

    placed = cut(in_arrow(dealt, count, schema_and(dealt, _part="int", _i="bigint")))
    # of a group there are at most as many rows here as it has partitions
    sizes = placed.groupBy(F.col(group).alias("_group"), F.col("_part").alias("_of")).agg(F.count(F.lit(1)).alias("_size"))
    ahead, whole = Window.partitionBy("_group").orderBy("_of"), Window.partitionBy("_group")
    sizes = cut(sizes.select("_group", "_of", (F.sum("_size").over(ahead) - F.col("_size")).alias("_ahead"), F.sum("_size").over(whole).alias("_n")))
    met = placed.join(maybe_broadcast(sizes, sizes.count()), F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return met.withColumn("_i", F.col("_i") + F.col("_ahead")).drop("_part", "_group", "_of", "_ahead")


def levels(n: Column) -> Column:
    """How many levels stand above n nodes: the least k with FAN^k >= n."""
    powers = [FAN**k for k in range(40)]
    return sum(((n > p).cast("int") for p in powers), F.lit(0))


def preimages(nodes: Column, depth: Column) -> Column:
    """For an array of digests, array of depth arrays: the preimages of the level above, of the one above
    that, and so on; for one node and no depth, none."""

    def up(below: Column) -> Column:
        starts = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / FAN).cast("int"))
        return F.transform(starts, lambda k: F.array_join(F.slice(below, k * FAN + 1, FAN), ""))

    def step(so_far: Column, _k: Column) -> Column:
        last = F.when(F.size(so_far) == 0, nodes).otherwise(F.transform(F.element_at(so_far, -1), digest))
        return F.concat(so_far, F.array(up(last)))

    return F.aggregate(F.slice(F.array(*(F.lit(k) for k in range(TIER))), F.lit(1), depth), F.array().cast("array<array<string>>"), step)


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def tiers(nodes: DataFrame, group: str, more: list[str] = ()) -> list[DataFrame]:
    """Blocks of BLOCK consecutive nodes, tier by tier, until every group has a single root.

    nodes: group, _i (place), _n (size of the group), digest. A tier's table has group, block, _depth (levels
    within its blocks), nodes (array of struct(_i, digest, and on the lowest tier the columns more)), pre
    (preimages by level), root, and _left, the levels above it. Each is written to the shared folder.
    """
    found, rest = [], nodes.withColumn("_left", levels(F.col("_n"))).drop("_n")
    while True:
        entry = F.struct("_i", "digest", *(more if not found else ()))
        block = F.floor(F.col("_i") / BLOCK).cast("long")
        rows = rest.groupBy(group, block.alias("block"), "_left").agg(F.array_sort(F.collect_list(entry)).alias("nodes"))
        rows = rows.withColumn("_depth", F.least("_left", F.lit(TIER))).withColumn("pre", preimages(F.col("nodes.digest"), F.col("_depth")))
        top = F.when(F.col("_depth") == 0, F.col("nodes.digest")[0]).otherwise(digest(F.element_at(F.col("pre"), -1)[0]))
        rows = cut(rows.withColumn("root", top).withColumn("_left", F.col("_left") - F.col("_depth")))
        found.append(rows)
        if not rows.filter("_left > 0").take(1):
            return found
        rest = rows.filter("_left > 0").select(group, F.col("block").alias("_i"), F.col("root").alias("digest"), "_left")


#: An ancestor as a leaf sees it: the preimage, and the place of the node below in it.
STEP = "array<struct<pre: string, at: int>>"


def climb(place: Column, pre: Column) -> Column:
    """Array of steps from the node at a place of a block up to the block's root."""
    return F.transform(pre, lambda level, k: _step(level, place, k))


def _step(level: Column, place: Column, k: Column) -> Column:
    below = F.floor(place / F.pow(F.lit(float(FAN)), k)).cast("int")
    return F.struct(level[F.floor(below / FAN).cast("int")].alias("pre"), (below % FAN).alias("at"))


def with_paths(found: list[DataFrame], group: str) -> DataFrame:
    """The lowest tier's blocks with above, the steps from their root to their group's, and top, that
    root's digest."""
    upper = None
    for k, rows in reversed(list(enumerate(found))):
        if upper is None:
            rows = rows.withColumn("above", F.array().cast(STEP)).withColumn("top", F.col("root"))
        else:
            met = rows.join(upper, F.col(group).eqNullSafe(F.col("_group")) & (F.col("block") == F.col("_block")), "left")
            none = F.col("_block").isNull()  # a group that ended in this tier
            rows = met.withColumn("above", F.when(none, F.array().cast(STEP)).otherwise(F.col("_above"))).withColumn("top", F.when(none, F.col("root")).otherwise(F.col("_top")))
            rows = rows.drop("_group", "_block", "_above", "_top")
        if k == 0:
            return rows
        each = rows.select(group, "above", "top", "pre", F.explode("nodes._i").alias("_block"))
        upper = each.select(F.col(group).alias("_group"), "_block", F.concat(climb((F.col("_block") % BLOCK).cast("int"), F.col("pre")), "above").alias("_above"), F.col("top").alias("_top"))
        upper = cut(upper)
    raise ValueError("no tier")


def siblings(steps: Column) -> Column:
    """The digests beside a leaf and its ancestors, level by level, left to right, as one text."""
    rest = F.transform(steps, lambda s: F.concat(F.substring(s["pre"], F.lit(1), s["at"] * 64), F.substring(s["pre"], s["at"] * 64 + 65, F.lit(64 * FAN))))
    return F.array_join(rest, "")


def folded(leaf: Column, steps: Column) -> Column:
    """The root that a leaf's digest gives with the siblings of its steps."""

    def put(below: Column, s: Column) -> Column:
        return digest(F.concat(F.substring(s["pre"], F.lit(1), s["at"] * 64), below, F.substring(s["pre"], s["at"] * 64 + 65, F.lit(64 * FAN))))

    return F.aggregate(steps, leaf, put)


def merkle_proofs(rows: DataFrame, group: str, order: list[str], also: list[str] = ()) -> DataFrame:
    """Each of rows (group, the columns of order, digest, and also) with subroot, root and steps, its way up:
    first within its group, then among the groups' subroots in order of the groups' bytes, null first."""
    kept = list(dict.fromkeys([*order, *also]))
    placed = numbered(rows.select(group, "digest", *kept), group, [*order, "digest"])
    lower = tiers(placed, group, kept)
    blocks = with_paths(lower, group)
    subroots = blocks.filter("block = 0").select(F.col(group).alias("_name"), F.lit(True).alias("_all"), F.col("top").alias("digest"))
    upper = tiers(numbered(subroots, "_all", ["_name"]), "_all", ["_name"])
    tops = with_paths(upper, "_all").select(F.explode("nodes").alias("_e"), "pre", "above", "top")
    tops = tops.select(F.col("_e._name").alias("_name"), F.concat(climb((F.col("_e._i") % BLOCK).cast("int"), F.col("pre")), "above").alias("_more"), F.col("top").alias("_root"))
    tops = cut(tops)
    # a row of these has 200 bytes a level
    met = blocks.join(maybe_broadcast(tops, tops.count(), 10_000), F.col(group).eqNullSafe(F.col("_name"))).drop("_name")
    each = met.select(group, F.col("top").alias("subroot"), F.col("_root").alias("root"), "pre", F.concat("above", "_more").alias("_more"), F.explode("nodes").alias("_e"))
    steps = F.concat(climb((F.col("_e._i") % BLOCK).cast("int"), F.col("pre")), "_more")
    return each.select(group, *(F.col(f"_e.{c}").alias(c) for c in kept), F.col("_e.digest").alias("digest"), "subroot", "root", steps.alias("steps"))


def manifest(docs: DataFrame) -> DataFrame:
    """docs (FIELDS; other columns are not read) as leaves with subroot, root, proof_sha256 (of all siblings),
    folded_root and verified.

    Tampering: rows of which the crc32 of the id is even are read again without the line feeds of their
    text. folded_root is what the leaf as read again gives with the siblings as they were, so verified is
    false just where something went. Rows stand by id within their source, a null id (text and crc32 as for
    an empty one) first, rows of one id by leaf digest; repeated rows are leaves of their own. Null and empty
    differ in a leaf. A single row is its subroot and, with no other source, the root; its proof is empty.
    Texts are hashed where they are read and never shuffled. An empty table gives no rows.
    """
    fields = [F.col(c) for c in FIELDS]
    again = [*fields[:-1], F.when(crc_mod(F.col("doc_id"), 2) == 0, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))]
    leaves = docs.select("doc_id", "source", leaf_digest(*fields).alias("digest"), leaf_digest(*again).alias("_again"))
    found = merkle_proofs(cut(leaves), "source", ["doc_id"], ["_again"])
    found = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", digest(siblings(F.col("steps"))).alias("proof_sha256"), folded(F.col("_again"), F.col("steps")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
