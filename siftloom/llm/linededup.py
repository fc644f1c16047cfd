"""Dropping lines that an earlier line repeats, exactly or but for one edit.

Two lines are one edit apart if they are equal once a character at the same place is taken out of
both, or if one is the other without a character. So each line emits the hash of what is left when
each of its characters is deleted, with the place, and its own hash; equal ones are joined, the
edit distance is verified, and what has an earlier partner goes. Of the lines that share a variant
and a place any two are within one edit, and so are a line and those that have it as a variant, so
each line is compared with the earliest of its group only and no pairs are lost.

Most lines are near no other, and need no variants: an edit leaves one half of a line as it is, and
all but one of its blocks. Lines that share no half with another line, and then blocks that are not
the only difference to one, are left out first.

Everything here is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, cut, maybe_broadcast

#: Least length of a block of a line, in characters; of long lines it is the root of the length.
BLOCK = 32
ID = ["_h1", "_h2"]
#: What tells documents apart: the key, which may be null or shared, and two hashes of the text.
DOC = ["_k", "_t1", "_t2"]


def _text_hashes(text: str) -> list[Column]:
    return [F.xxhash64(text).alias("_t1"), F.xxhash64(F.lit(1), text).alias("_t2")]


def _lines(docs: DataFrame, text: str, key: str, min_words: int, fuzzy_chars: int) -> DataFrame:
    """DOC, _n, _line and its two hashes, of all lines of at least min_words words or, without the
    white space at both ends, fuzzy_chars characters."""
    words = f"[^{BLANK}]+" + f"[{BLANK}]+[^{BLANK}]+" * (min_words - 1)
    rows = docs.select(F.col(key).alias("_k"), *_text_hashes(text), F.posexplode(F.split(F.col(text), "\n")).alias("_n", "_line")).filter(F.col("_line").rlike(words) | (F.length(F.btrim("_line", F.lit(" \t\n\x0b\f\r"))) >= fuzzy_chars))
    return rows.withColumns({"_h1": F.xxhash64("_line"), "_h2": F.xxhash64(F.md5("_line"))})


def _place() -> Column:
    """A line's place in the order of the corpus: by key, nulls last, then by the text's hashes, then
    within the text."""
    return F.struct(F.col("_k").isNull().alias("a"), F.col("_k").alias("k"), F.col("_t1").alias("t1"), F.col("_t2").alias("t2"), F.col("_n").alias("n"))


def _halves(line: Column) -> Column:
    """Four keys such that lines within one edit share one: of the lengths that the shorter one of a
    pair may have, the line's own and one less, the first half and the last."""
    n = F.length(line)
    keys = []
    for side, m in (("o", n), ("l", n - 1)):
        half = F.floor(m / 2).cast("int")
        keys += [F.xxhash64(F.lit("p"), m, F.left(line, half)), F.xxhash64(F.lit("s"), m, F.right(line, m - half))]
    return F.array(*keys)


def _xor(hashes: Column) -> Column:
    return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a.bitwiseXOR(x))


def _blocked(lines: DataFrame) -> DataFrame:
    """lines (ID, _first, _line) with, for the line less one character (x) and as it is (w): the
    length _mx or _mw, block length, and by block the combined hash of all other blocks."""
    n = F.length("_line")

    def sized(m: Column) -> tuple[Column, Column]:
        b = F.greatest(F.lit(BLOCK), F.ceil(F.sqrt(m))).cast("int")
        return b, F.greatest(F.lit(1), F.ceil(m / b)).cast("int")

    (bx, cx), (bw, cw) = sized(n - 1), sized(n)
    out = lines.select(*ID, "_first", "_line", (n - 1).alias("_mx"), n.alias("_mw"), bx.alias("_bx"), cx.alias("_cx"), bw.alias("_bw"), cw.alias("_cw"))

    def hashes(count: str, size: str, m: str, shift: int) -> Column:
        return F.transform(F.sequence(F.lit(0), F.col(count) - 1), lambda k: F.xxhash64(k, F.substring(F.col("_line"), k * F.col(size) + 1 + shift, F.least(F.col(size), F.col(m) - k * F.col(size)))))

    # blocks before the deleted character stand as they are, those after it one place further
    out = out.withColumns({"_pre": hashes("_cx", "_bx", "_mx", 0), "_post": hashes("_cx", "_bx", "_mx", 1), "_own": hashes("_cw", "_bw", "_mw", 0)})
    return out.withColumns({
        "_x": F.transform("_pre", lambda _, j: _xor(F.slice("_pre", F.lit(1), j)).bitwiseXOR(_xor(F.slice("_post", j + 2, F.col("_cx"))))),
        "_t": _xor(F.col("_own")),
    }).withColumn("_w", F.transform("_own", lambda h: h.bitwiseXOR(F.col("_t"))))


def _near(lines: DataFrame) -> DataFrame:
    """ID of the lines (ID, _first, _line) that an earlier one is one edit from."""
    blocked = cut(_blocked(lines).drop("_pre", "_post", "_own"))

    def keyed(kind: str) -> DataFrame:
        return blocked.select(*ID, F.lit(kind).alias("_kind"), F.posexplode(f"_{kind}").alias("_j", "_rest"), F.col(f"_m{kind}").alias("_m")).withColumn("_key", F.xxhash64("_m", "_j", "_rest"))

    keys = keyed("x").unionByName(keyed("w"))
    live = keys.groupBy("_key").agg(F.count(F.lit(1)).alias("_all"), F.count(F.when(F.col("_kind") == "x", 1)).alias("_xs")).filter("_all > 1 and _xs > 0").select("_key")
    kept = cut(keys.join(live, "_key").select(*ID, "_kind", "_j", "_rest"))

    x = kept.filter("_kind = 'x'").join(blocked.select(*ID, "_first", "_line", "_mx", "_bx", "_cx"), ID)
    left = F.col("_mx") - F.col("_j") * F.col("_bx")
    last = F.col("_j") == F.col("_cx") - 1
    x = x.select(*ID, "_first", "_mx", "_j", "_bx", "_rest", F.substring("_line", F.col("_j") * F.col("_bx") + 1, F.least(F.col("_bx"), left) + 1).alias("_b"), F.when(last, left + 1).otherwise(F.col("_bx")).alias("_offs"))
    x = x.withColumn("_o", F.explode(F.sequence(F.lit(0), F.col("_offs") - 1)))
    variant = F.xxhash64("_j", F.concat(F.left(F.col("_b"), F.col("_o")), F.substring(F.col("_b"), F.col("_o") + 2, F.length("_b"))))
    x = x.select(*ID, "_first", (F.col("_j") * F.col("_bx") + F.col("_o")).alias("_p"), F.xxhash64("_mx", F.col("_rest").bitwiseXOR(variant)).alias("_v"))
    w = kept.filter("_kind = 'w'").select(*ID).distinct().join(blocked.select(*ID, "_first", "_mw", "_t"), ID).select(*ID, "_first", F.lit(-1).alias("_p"), F.xxhash64("_mw", "_t").alias("_v"))

    one = F.struct("_first", *ID)
    emitted = x.unionByName(w)
    by_variant, by_place = Window.partitionBy("_v"), Window.partitionBy("_v", "_p")
    whole = F.min(F.when(F.col("_p") < 0, one)).over(by_variant)
    parted = F.min(F.when(F.col("_p") >= 0, one)).over(by_variant)
    found = emitted.withColumns({"_whole": whole, "_parted": parted, "_same": F.min(one).over(by_place)})
    found = found.select(*ID, "_first", F.explode(F.when(F.col("_p") < 0, F.array("_parted")).otherwise(F.array("_whole", "_same"))).alias("_by"))
    pairs = found.filter(F.col("_by._first") < F.col("_first")).select(*ID, F.col("_by._h1").alias("_b1"), F.col("_by._h2").alias("_b2")).distinct()
    texts = blocked.select(*ID, "_line")
    pairs = pairs.join(texts, ID).join(texts.select(F.col("_h1").alias("_b1"), F.col("_h2").alias("_b2"), F.col("_line").alias("_earlier")), ["_b1", "_b2"])
    return pairs.filter(F.levenshtein("_line", "_earlier", 1).between(0, 1)).select(*ID).distinct()


def dropped_lines(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 2, fuzzy_chars: int = 20) -> DataFrame:
    """DOC, _drop of the documents that lose lines: the numbers of those lines, from 0."""
    occurring = _lines(docs, text, key, min_words, fuzzy_chars)
    long = F.length("_line") >= fuzzy_chars
    halves = F.when(long, _halves(F.col("_line")))
    seen = occurring.select(*DOC, "_n", *ID, *(F.get(halves, k).alias(f"_s{k}") for k in range(4)))
    lines = cut(seen.groupBy(*ID).agg(F.min(_place()).alias("_first"), F.count(F.lit(1)).alias("_c"), *(F.max(f"_s{k}").alias(f"_s{k}") for k in range(4))))

    keys = lines.filter("_s0 is not null").select(*ID, "_first", F.explode(F.array(*(f"_s{k}" for k in range(4)))).alias("_key"))
    live = keys.groupBy("_key").count().filter("count > 1").select("_key")
    alike = cut(keys.join(live, "_key").select(*ID, "_first").distinct())
    texts = occurring.join(maybe_broadcast(alike, alike.count()), ID).filter(_place() == F.col("_first")).select(*ID, "_first", "_line")
    near = cut(_near(texts))

    marked = lines.select(*ID, "_first", "_c").join(maybe_broadcast(near.withColumn("_near", F.lit(True)), near.count()), ID, "left")
    bad = cut(marked.filter("_c > 1 or _near").select(*ID, "_first", F.coalesce("_near", F.lit(False)).alias("_near")))
    hit = occurring.drop("_line").join(maybe_broadcast(bad, bad.count()), ID).filter(F.col("_near") | (_place() != F.col("_first")))
    return hit.groupBy(*DOC).agg(F.collect_set("_n").alias("_drop"))


def line_dedup(docs: DataFrame, text: str = "text", key: str = "doc_id", min_words: int = 2, fuzzy_chars: int = 20) -> DataFrame:
    """docs with the lines left in each text, and n_lines and n_dropped.

    A line of at least min_words words, or at least fuzzy_chars characters as in prose without spaces
    and long addresses, goes if an earlier line of the corpus equals it or, for lines
    of at least fuzzy_chars characters, is one edit from it, whether that one stays or not. Earlier is
    by key, nulls last, then by a hash of the text, and then by place. Rows that share key and text
    are one document, so rows repeated whole keep the same lines; rows that share a key (or have none)
    with other texts are documents of their own. Shorter lines and empty ones stay. A null text stays null with 0
    lines. Columns of docs named like the new ones give way to them.
    """
    kept = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    drop = cut(dropped_lines(docs, text, key, min_words, fuzzy_chars))
    t1, t2 = _text_hashes(text)
    same = F.col(key).eqNullSafe(F.col("_k")) & (t1 == F.col("_t1")) & (t2 == F.col("_t2"))
    out = docs.select(*kept).join(maybe_broadcast(drop, drop.count()), same, "left")
    lines = F.split(F.col(text), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
    gone = F.array_intersect(F.sequence(F.lit(0), F.size(lines) - 1), F.col("_drop"))
    cleaned = F.when(F.col("_drop").isNull() | F.col(text).isNull(), F.col(text)).otherwise(F.array_join(F.transform(F.array(F.struct(lines.alias("l"), stay.alias("s"))), lambda x: F.array_join(F.transform(x["s"], lambda k: F.get(x["l"], k)), "\n")), ""))
    count = F.when(F.col(text).isNull(), F.lit(0)).otherwise(F.size(lines))
    lost = F.when(F.col("_drop").isNull() | F.col(text).isNull(), F.lit(0)).otherwise(F.size(gone))
    return out.select(*(cleaned.alias(c) if c == text else F.col(c) for c in kept), count.cast("long").alias("n_lines"), lost.cast("long").alias("n_dropped"))
