"""Join of similar documents by the Jaccard similarity of their word n-grams, with an R-tree over
count vectors.

A document's n-grams are hashed into groups. Its counts by group are a point, and two points'
summed coordinate minima are at least as large as their sets' overlap; so is the sum against the
upper corner of an R-tree's box, for all points in the box. Boxes and points that cannot reach the
overlap that a link needs are passed over, the rest is verified on the sets.

To spread this over tasks, documents are first divided so that no link is lost: sets that differ in
d elements at most, dealt into more than d groups, agree on all groups but d, so each document sends a
hash of each group's content, and those that share enough of them are kept together. Of a document's hashes, as many
as a link may spoil and a few more are sent, cut short and beside a hash of the document's set; it must share as many as
are sent more. They are sent in slices, one after the other, so that disk holds the shuffle of one of them; what is wide
(all hashes, texts) is never shuffled to find out which of it is wanted. What hangs together that way
is compared by the R-tree, large parts by blocks: first each block by itself with a few documents that
all have, then what is not connected with the most, in blocks of its own, against all blocks, each pair of
blocks by itself. Copies are collapsed before
all that, and links within what is already connected are not looked for, as only connection counts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from fractions import Fraction
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, byte_slices, cut, drop_tables, give_back, in_arrow, maybe_broadcast, newest_table, tables_so_far, words_of
from .components import components

#: Groups that count vectors have.
DIMS_BITS = 8
#: Points of a leaf and leaves of an inner node.
FANOUT = 16
#: Documents of a block, about, and documents that all blocks of a part have, about. A task holds the
#: sets of two blocks at once.
BLOCK, PIVOTS = 96, 4
#: Documents of a sixteenth of all from which on a key that they share is combined before it is sent.
HOT = 128
#: How often documents that share too few keys are left out.
LOOKS = 2
#: Bits of a key that are sent, and bits of a document's number that tell its size class.
SHORT, CLASS_BITS = 48, 7
#: Keys that are sent beyond those of which a link leaves one, and slices in which keys are sent.
MORE, SLICES = 32, 4
#: Documents of which a task tells copies, so as to send the keys of one.
SEEN = 100_000
_K1, _K2, _K3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every bit of x bears on every bit of the result."""
    x = (x ^ (x >> np.uint64(30))) * _K2
    x = (x ^ (x >> np.uint64(27))) * _K3
    return x ^ (x >> np.uint64(31))


def shingle_sets(texts: pa.Array, width: int) -> list[np.ndarray]:
    """Hashes of each text's distinct word n-grams, sorted. A text with fewer words than width has
    its whole sequence as its one; one without words has none."""
    words, sizes = words_of(texts)
    coded = words.dictionary_encode()
    known = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], dtype=np.uint64)
    h = known[coded.indices.to_numpy()] if len(words) else np.zeros(0, dtype=np.uint64)
    seq = _mix(h + _K1)
    for k in range(1, width):
        seq = _mix(seq[: max(0, len(h) - k)] * _K3 + h[k:])
    out, start = [], 0
    for n in sizes.tolist():
        if n >= width:
            out.append(np.unique(seq[start : start + n - width + 1]))
        elif n:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[start : start + n].tobytes(), seed=n)], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
        start += n
    return out


@lru_cache(maxsize=4)
def _classes(t: Fraction) -> list[tuple[int, int, int, int]]:
    """Size classes: the first and the last size, the most elements in which two linked sets differ
    of which the larger one is in the class, and the groups they are dealt into."""
    out, low = [], 1
    while low < 1 << 40:
        after = max(low + 1, -(-low * 7 // 5))
        most = int(2 * (after - 1) * (1 - t) / (1 + t))
        out.append((low, after - 1, most, most + 1 + (max(2, most // 5) if most else 0)))
        low = after
    return out


def class_keys(own: np.ndarray, t: Fraction) -> list[tuple[np.ndarray, int]]:
    """Keys of a set by size class, with how many of them it shares with any set that it is linked with.

    A pair meets in the class of its larger set, so a set has keys for its own class and for those
    that a larger partner may be in. It differs from a partner in so many elements at most, each of
    which spoils one group; the other groups that are not empty are shared. If there may be none,
    the empty ones count as well.
    """
    classes, n = _classes(t), len(own)
    k = max(i for i, c in enumerate(classes) if c[0] <= n)
    out = []
    for c in range(k, len(classes)):
        low, last, most, groups = classes[c]
        if c > k and n < t * low:
            break
        differ = min(most, int((n + min(n / t, last)) * (1 - t) / (1 + t)))
        seed = np.uint64(c * int(_K1) % 2**64)
        g = ((_mix(own ^ seed) >> np.uint64(33)) * np.uint64(groups)) >> np.uint64(31)
        order = np.argsort(g, kind="stable")
        at = g[order]
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
        sums = np.add.reduceat(_mix(own[order] + seed), first)
        keys = _mix(sums ^ _mix(at[first] + seed))
        if len(first) <= differ:
            gone = np.setdiff1d(np.arange(groups, dtype=np.uint64), at[first])
            keys = np.concatenate([keys, _mix(_mix(gone + seed) + _K2)])
        out.append((keys, max(1, len(first) - differ)))
    return out


def group_keys(own: np.ndarray, t: Fraction) -> np.ndarray:
    """Keys of a set such that any two sets of similarity t or more share one."""
    return np.concatenate([keys for keys, _ in class_keys(own, t)])


class CountTree:
    """An R-tree over the count vectors of sets, packed by size."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        shift, dims = np.uint64(64 - DIMS_BITS), 1 << DIMS_BITS
        self.sizes = np.array([len(s) for s in sets], dtype=np.int64)
        self.points = np.zeros((len(sets), dims), dtype=np.int32)
        for row, s in zip(self.points, sets, strict=True):
            row += np.bincount((_mix(s) >> shift).astype(np.int64), minlength=dims)
        self.order = np.lexsort((self.points[:, 0], self.sizes))
        self.levels = []  # from the leaves up: upper corners and least sizes
        corners, least = self.points[self.order], self.sizes[self.order]
        while len(corners) > FANOUT or not self.levels:
            first = np.arange(0, len(corners), FANOUT)
            corners, least = np.maximum.reduceat(corners, first), np.minimum.reduceat(least, first)
            self.levels.append((corners, least))

    def near(self, q: int, t: Fraction, among: np.ndarray) -> np.ndarray:
        """Sets that may be linked with set q: the bound on the overlap reaches what a link needs.
        among: which sets are wanted."""
        point, n = self.points[q], self.sizes[q]
        up, down = t.numerator, t.numerator + t.denominator
        nodes = np.arange(len(self.levels[-1][0]))
        for corners, least in reversed(self.levels):
            bound = np.minimum(corners[nodes], point).sum(axis=1)
            nodes = nodes[down * bound >= up * (n + least[nodes])]
            nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
            below = self._below(corners)
            nodes = nodes[nodes < below]
        found = self.order[nodes]
        found = found[among[found]]
        bound = np.minimum(self.points[found], point).sum(axis=1)
        return found[down * bound >= up * (n + self.sizes[found])]

    def _below(self, corners: np.ndarray) -> int:
        k = next(i for i, level in enumerate(self.levels) if level[0] is corners)
        return len(self.levels[k - 1][0]) if k else len(self.order)


def linked(a: np.ndarray, b: np.ndarray, t: Fraction) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    both = int((b[at] == a).sum())
    return t.denominator * both >= t.numerator * (len(a) + len(b) - both)


def tree_links(nodes: list, sets: list[np.ndarray], t: Fraction, labels: np.ndarray | None = None, own: np.ndarray | None = None, asks: np.ndarray | None = None, asking: np.ndarray | None = None) -> list[tuple]:
    """Links that connect what the links among these sets connect.

    labels: what is known to be connected. Sets in asks are looked up among those in own. asking: sets
    that are looked up here or elsewhere; of two such, the later one is. Without these masks, all are.
    """
    tree, out, every = CountTree(sets), [], np.ones(len(sets), dtype=bool)
    top = np.arange(len(sets)) if labels is None else labels.copy()
    own, asks, asking = (every if m is None else m for m in (own, asks, asking))
    for q in np.flatnonzero(asks):
        other = own & (top != top[q])
        other[q:] &= ~asking[q:]
        for k in tree.near(q, t, other):
            if top[k] != top[q] and linked(sets[q], sets[k], t):
                out.append((nodes[q], nodes[k]))
                top[top == top[k]] = top[q]
    return out


def _of_several(keys: DataFrame) -> DataFrame:
    """keys (_key, k and more) that more than one document has, and _low, the least that has it. Keys
    are combined before they are sent, and adaptive execution splits the join of one that very many
    share."""
    seen = keys.groupBy("k").agg(F.min("_key").alias("_low"), F.max("_key").alias("_high")).filter("_low < _high").select("k", "_low")
    return keys.join(seen, "k")


def _shared_keys(keys: DataFrame) -> DataFrame:
    """_of_several(keys), each once, of a table in which most keys are of one document, with each key sent once.

    Keys that very many share, as those of a sixteenth of the documents tell, are combined; the
    others meet by a window. Which way a key goes does not bear on the result. A slice of keys is
    done and its shuffle gone before the next one begins.
    """
    some = keys.filter(F.pmod(F.xxhash64("_key", F.lit(3)), F.lit(16)) == 0)
    hot = cut(some.groupBy("k").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= HOT).select("k"))
    by_key, n_hot, found = Window.partitionBy("k"), hot.count(), []
    for k in range(SLICES):
        own = keys.filter(F.pmod("k", F.lit(SLICES)) == k)
        cold = own.join(maybe_broadcast(hot, n_hot), "k", "left_anti") if n_hot else own
        cold = cold.select("_key", "k", F.min("_key").over(by_key).alias("_low"), F.max("_key").over(by_key).alias("_high")).filter("_low < _high").drop("_high")
        if n_hot:
            cold = cold.unionByName(_of_several(own.join(maybe_broadcast(hot, n_hot), "k", "left_semi").distinct()))
        found.append(cut(cold.distinct()))
    return reduce(DataFrame.unionByName, found)


def first_keys(single: DataFrame, more: int = 0) -> DataFrame:
    """_key (a document's _id and size class) and k (a key, cut short) of the keys by which documents meet.

    A document that differs from a linked one in so many groups at most has with any that many and one of its
    groups one that the two agree on; the first group that they agree on is therefore within that many and one
    of each, and the next ones within as many more. Keys are in the order of groups, so the first ones are enough:
    all but those that must be shared, one and more.
    """
    of = F.transform("_keys", lambda x, c: F.struct(_class_of(F.col("_id"), c).alias("at"), F.slice(x["keys"], F.lit(1), F.size(x["keys"]) - x["need"] + 1 + more).alias("keys")))
    each = single.select(F.explode(of).alias("_of")).select(F.col("_of.at").alias("_key"), F.explode("_of.keys").alias("k"))
    return each.withColumn("k", F.shiftrightunsigned("k", 64 - SHORT))


def _class_of(number: Column, c: Column) -> Column:
    return F.shiftleft(number, CLASS_BITS).bitwiseOR(c.cast("long"))


def similar_groups(docs: DataFrame, width: int = 3, threshold: Fraction = Fraction(90, 100), text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_shingles and component_id, the smallest key reachable by links, of every row of docs.

    Rows without words are linked with nothing; so are rows with a null key, whose component_id is
    null. Rows that share a key are one document that has the links of each. Repeated rows stay.
    """
    t = Fraction(threshold)
    kind = docs.schema[key].dataType.simpleString()

    kinds = pa.list_(pa.struct([("need", pa.int32()), ("keys", pa.list_(pa.int64()))]))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            for start, rows in byte_slices(batch.column(1)):
                sets = shingle_sets(batch.column(1).slice(start, rows), width)
                ids = batch.column(0).slice(start, rows)
                one = np.array([_mix(s).sum(dtype=np.uint64) for s in sets]).view(np.int64)
                two = np.array([np.bitwise_xor.reduce(_mix(s + _K2)) if len(s) else 0 for s in sets], dtype=np.uint64).view(np.int64)
                keys = []
                for s, same, there in zip(sets, zip(one.tolist(), two.tolist(), strict=True), ids.is_valid().to_pylist(), strict=True):
                    sent = len(s) and there and same not in seen
                    keys.append([{"need": need, "keys": found.view(np.int64)} for found, need in class_keys(s, t)] if sent else [])
                    if sent and len(seen) < SEEN:
                        seen.add(same)
                cols = [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(one), pa.array(two), pa.array(keys, kinds)]
                yield pa.RecordBatch.from_arrays(cols, names=["_key", "n_shingles", "_d1", "_d2", "_keys"])
        give_back()

    since, same = tables_so_far(), ["_d1", "_d2", "n_shingles"]
    number = F.shiftright(F.shiftleft(F.xxhash64(*same), CLASS_BITS), CLASS_BITS)
    rows = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    wide = cut(in_arrow(rows, scan, f"_key {kind}, n_shingles bigint, _d1 bigint, _d2 bigint, _keys array<struct<need: int, keys: array<bigint>>>"))
    base, kept = cut(wide.drop("_keys")), [newest_table()]
    firsts = cut(base.filter("n_shingles > 0 and _key is not null").groupBy(*same).agg(F.min("_key").alias("_first")))
    kept.append(newest_table())

    # what shares keys with other documents; one that shares fewer than its links would share has
    # none, and those left are looked at again without it
    numbered = wide.select(number.alias("_id"), "_keys")
    needs = numbered.select("_id", F.posexplode("_keys.need").alias("_c", "_need")).select(_class_of(F.col("_id"), F.col("_c")).alias("_key"), F.least("_need", F.lit(1 + MORE)).alias("need")).distinct()
    live = cut(_shared_keys(first_keys(numbered, MORE)).join(needs, "_key"))
    for _ in range(LOOKS):
        enough = live.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"), F.min("need").alias("_least")).filter("_n >= _least").select("_key")
        live = cut(_of_several(live.drop("_low").join(enough, "_key", "left_semi")))
    plain = lambda c: F.shiftright(c, CLASS_BITS)
    shared = live.select(plain("_key").alias("a"), plain("_low").alias("b")).filter("a <> b").distinct()
    parts = cut(components(shared))
    kept.append(newest_table())
    drop_tables(since, but=kept)

    sizes = parts.groupBy("component").agg(F.count(F.lit(1)).alias("_m"))
    blocks = F.ceil(F.col("_m") / BLOCK).cast("int")
    pivot = (F.col("node") == F.col("component")) | (F.pmod(F.xxhash64("node", F.lit(1)), F.col("_m")) < PIVOTS)
    named = parts.join(sizes, "component").join(firsts.select(number.alias("node"), F.col("_first").alias("_key")), "node")
    members = cut(named.select("_key", "component", blocks.alias("_blocks"), F.pmod(F.xxhash64("node"), blocks).cast("int").alias("_block"), pivot.alias("_pivot")))

    def compared(dealt: DataFrame) -> DataFrame:
        """Links within each (component, _of, _group) of _key, _label (an id, or null), _own, _asks,
        _asking, _text."""

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def done() -> pa.RecordBatch:
                nodes, labels, own, asks, asking, sets = zip(*part, strict=True)
                known = {x: k for k, x in enumerate(dict.fromkeys(labels))}
                tops = np.arange(len(nodes)) if labels[0] is None else np.array([known[x] for x in labels])
                found = tree_links([*nodes], [*sets], t, tops, *map(np.array, (own, asks, asking)))
                return pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], kinds[0]) for k in (0, 1)], names=["a", "b"])

            part, at, kinds = [], None, []
            for batch in batches:
                kinds = [batch.schema.field("_key").type]
                for start, n in byte_slices(batch.column("_text")):
                    rows = batch.slice(start, n)
                    sets = shingle_sets(rows.column("_text"), width)
                    for *group, key, label, own, asks, asking, found in zip(*(rows.column(c).to_pylist() for c in (*by_group, "_key", "_label", "_own", "_asks", "_asking")), sets, strict=True):
                        if at != group:
                            if len(part) > 1:
                                yield done()
                            part, at = [], group
                        part.append((key, label, own, asks, asking, found))
            if len(part) > 1:
                yield done()
            part.clear()
            give_back()

        by_group = ["component", "_of", "_group"]
        dealt = dealt.repartition(*by_group).sortWithinPartitions(*by_group, "_key")
        return in_arrow(dealt, work, f"a {kind}, b {kind}")

    def by_parts(wanted: DataFrame, n: int, deal: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Links of compared(deal(wanted, n of them, with their texts)), so many parts at a time that wanted
        ones are few enough to be broadcast, and only their texts are sent."""
        times = -(-4 * n // (3 * BROADCAST_ROWS)) or 1
        found = []
        for k in range(times):
            some = wanted.filter(F.pmod(F.xxhash64("component"), F.lit(times)) == k) if times > 1 else wanted
            found.append(cut(compared(deal(rows.join(maybe_broadcast(some, some.count() if times > 1 else n), "_key")))))
        return reduce(DataFrame.unionByName, found)

    # first each block by itself, with a few documents of its part that all its blocks have
    everywhere = F.sequence(F.lit(0), F.col("_blocks") - 1)
    group = F.explode(F.when(F.col("_pivot"), everywhere).otherwise(F.array("_block"))).alias("_group")
    true = F.lit(True)
    first = by_parts(members, members.count(), lambda texts: texts.select("_key", "component", group, F.lit(0).alias("_of"), F.lit(None).cast(kind).alias("_label"), true.alias("_own"), true.alias("_asks"), true.alias("_asking"), "_text"))
    found = cut(components(first))

    # of parts that this leaves in several pieces, what is not of the largest meets all blocks
    named = members.filter("_blocks > 1").join(found.withColumnRenamed("component", "_label"), F.col("_key") == F.col("node"), "left")
    named = cut(named.select("_key", "component", "_blocks", "_block", F.coalesce("_label", "_key").alias("_label")))
    by_piece = named.groupBy("component", "_label").agg(F.count(F.lit(1)).alias("_n"))
    pieces = by_piece.groupBy("component").agg(F.max_by("_label", F.struct("_n", "_label")).alias("_largest"), (F.sum("_n") - F.max("_n")).alias("_rest")).filter("_rest > 0")
    asking, askers = F.col("_label") != F.col("_largest"), F.ceil(F.col("_rest") / BLOCK).cast("int")
    left = cut(named.join(pieces, "component").select("_key", "component", "_blocks", "_block", "_label", asking.alias("_asking"), askers.alias("_askers"), F.pmod(F.xxhash64("_key", F.lit(2)), askers).cast("int").alias("_asker")))
    links, n_left = found.select(F.col("node").alias("a"), F.col("component").alias("b")), left.count()
    if n_left:
        # a document is one of its own block for each block of askers, and asks with its own one in every block
        owned = F.transform(F.sequence(F.lit(0), F.col("_askers") - 1), lambda k: F.struct(k.alias("_of"), F.col("_block").alias("_group"), true.alias("_own"), (F.col("_asking") & (k == F.col("_asker"))).alias("_asks")))
        asked = F.when(F.col("_asking"), F.transform(F.filter(everywhere, lambda k: k != F.col("_block")), lambda k: F.struct(F.col("_asker").alias("_of"), k.alias("_group"), F.lit(False).alias("_own"), true.alias("_asks"))))
        dealt = F.explode(F.concat(owned, F.coalesce(asked, F.array().cast("array<struct<_of: int, _group: int, _own: boolean, _asks: boolean>>")))).alias("_at")
        second = by_parts(left, n_left, lambda texts: texts.select("_key", "component", dealt, "_label", "_asking", "_text").select("_key", "component", "_at.*", "_label", "_asking", "_text"))
        links = links.unionByName(second)
    several = base.filter("n_shingles > 0 and _key is not null").select("_key", *same).distinct().groupBy("_key").count().filter("count > 1").select("_key")
    if several.take(1):  # rows of one document are linked through it
        links = links.unionByName(base.join(several, "_key", "left_semi").join(firsts, same).select(F.col("_key").alias("a"), F.col("_first").alias("b")))
        n_left = 1
    if n_left:
        found = components(links)
    named = firsts.join(found, F.col("_first") == F.col("node"), "left").select(*same, F.coalesce("component", "_first").alias("_component"))
    out = base.join(named, same, "left")
    return out.select(F.col("_key").alias(key), "n_shingles", F.when(F.col("_key").isNull(), F.lit(None)).otherwise(F.coalesce("_component", "_key")).cast(kind).alias("component_id"))
