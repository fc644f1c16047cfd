"""How filters overlap: what each removes in any order, alone, and by Shapley's share.

Every document gets a flag for each filter it fails. For each of the 2^k sets of filters the documents
that fail all of them are counted, as sums of products of flags: one aggregate by part, combined before
its shuffle. All else is read off these joint counts. Documents that pass a set P are the alternating sum
of the joint counts of P's subsets (Möbius inversion); what filter f removes after P is survivors of P less
those of P with f. The game "removed by P" has the joint count of S with sign (-1)^(|S|+1) as Harsanyi
dividend of S, so f's Shapley value is the sum over the sets with f of dividend / |S|.
"""

from __future__ import annotations

import json
from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANK, WORD, cut, maybe_broadcast

#: Filters of text_flags, in the order of their letters.
FILTERS = "ABCDE"


def text_flags(text: Column) -> dict[str, Column]:
    """Failures that a text shows by itself: A few words, B few distinct words, C many capitals, D odd
    symbols. Null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    words = F.regexp_count(t, F.lit(WORD))
    distinct = F.size(F.array_except(F.split(t, f"[{BLANK}]+"), F.array(F.lit(""))))
    return {
        "A": words < 50,
        "B": 100 * distinct.cast("long") < 65 * words.cast("long"),
        "C": 100 * F.regexp_count(t, F.lit("[A-Z]")).cast("long") > 5 * F.length(t).cast("long"),
        "D": t.rlike("[#$%&*|]"),
    }


def flagged(docs: DataFrame, part: str = "source", key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (key, part, A..E, n): how many rows of docs have this key, part and these failures. E: a row
    with a smaller key has the same text, anywhere in the table.

    Equal texts are told by sha256. No text is shuffled, only its digest and flags, and equal rows are
    counted before the shuffle. The first row of a text is found by its smallest key, and met again by
    (digest, key), so a text with very many copies is spread by key.
    """
    flags = text_flags(F.col(text))
    digest = F.unhex(F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256))
    rows = docs.select(digest.alias("_d"), F.col(key).alias("key"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), *(c.alias(f) for f, c in flags.items()))
    rows = cut(rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n")))
    first = rows.filter("key is not null").groupBy(F.col("_d").alias("_of")).agg(F.min("key").alias("_key"))
    found = rows.join(first, (F.col("_d") == F.col("_of")) & (F.col("key") == F.col("_key")), "left")
    return found.select("key", "part", *flags, (F.col("key").isNotNull() & F.col("_of").isNull()).alias("E"), "n")


def joint_counts(rows: DataFrame, filters: str, weights: dict[str, Column]) -> DataFrame:
    """By part, for each weight an array of 2^k sums: element S is the weight of the rows that fail all
    filters whose bits S has. rows: part and a boolean column for each filter."""
    flags = [F.col(f).cast("long") for f in filters]
    sums = []
    for name, weight in weights.items():
        for s in range(1 << len(filters)):
            product = reduce(lambda a, b: a * b, (flags[i] for i in range(len(filters)) if s >> i & 1), weight)
            sums.append(F.sum(product).alias(f"{name}{s}"))
    return rows.groupBy("part").agg(*sums).select("part", *(F.array(*(F.col(f"{name}{s}") for s in range(1 << len(filters)))).alias(name) for name in weights))


def survivors(joint: Column, k: int) -> Column:
    """Array of 2^k: element P is the weight that passes all filters of P, by Möbius inversion of the joint
    failures."""
    subsets = lambda p: (u for u in range(p + 1) if u & p == u)
    return F.array(*(reduce(lambda a, b: a + b, (joint[u] * (-1) ** u.bit_count() for u in subsets(p))) for p in range(1 << k)))


def shapley(joint: Column, k: int) -> Column:
    """Array of k: each filter's Shapley value times k!, whole numbers as |S| divides k!."""
    dividend = {s: joint[s] * ((-1) ** (s.bit_count() + 1) * factorial(k) // s.bit_count()) for s in range(1, 1 << k)}
    return F.array(*(reduce(lambda a, b: a + b, (d for s, d in dividend.items() if s >> i & 1)) for i in range(k)))


def interactions(rows: DataFrame, filters: str, weights: dict[str, Column]) -> DataFrame:
    """The audit by part, order of the filters and step (from 1; its filter is that letter): kept, removed,
    redundant (fail it, removed earlier), unique_fails (fail it alone) and shapley (removed by it, over all
    orders in sum) of the weight n; and removed as <name>_lost for each other weight. Zeros are given too.

    rows: part, a boolean for each filter and what the weights read. All k! orders are listed, so filters are
    few; the k * k! steps are a literal, and nothing is joined. No rows, no parts, an empty result.
    """
    k = len(filters)
    full, steps = (1 << k) - 1, []
    for order in permutations(range(k)):
        before = 0
        for step, f in enumerate(order, 1):
            steps.append({"o": "".join(filters[i] for i in order), "s": step, "f": f, "p": before, "q": before | 1 << f})
            before |= 1 << f
    found = joint_counts(rows, filters, weights)
    found = found.select("part", F.col("n").alias("_joint"), shapley(F.col("n"), k).alias("_shapley"), *(survivors(F.col(w), k).alias(w) for w in weights))
    listed = F.from_json(F.lit(json.dumps(steps)), "array<struct<o string, s int, f int, p int, q int>>")
    each = found.withColumn("_e", F.explode(listed)).select("*", "_e.*")

    def removed(w: str) -> Column:
        return F.get(w, F.col("p")) - F.get(w, F.col("q"))

    alone = F.expr("shiftleft(1, f)")
    return each.select(
        "part",
        F.col("o").alias("filter_order"),
        F.col("s").alias("step"),
        F.get("n", F.col("q")).alias("kept"),
        removed("n").alias("removed"),
        (F.get("_joint", alone) - removed("n")).alias("redundant"),
        (F.get("n", F.lit(full) - alone) - F.get("n", F.lit(full))).alias("unique_fails"),
        *(removed(w).alias(f"{w}_lost") for w in weights if w != "n"),
        F.get("_shapley", F.col("f")).alias("shapley"),
    )


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """interactions of the five filters over docs (doc_id, text, source) by source, with good_lost and
    toxic_lost by labels (doc_id, quality, toxic).

    Null text counts as empty, null source as the empty string (which a source of that name shares). A
    null id has no smaller one and no label; rows that repeat an id are documents of their own, each with
    the id's labels; of several labels of an id, one that says 1 is enough. Of equal texts all rows with
    the smallest id pass E. Columns of docs other than these three are not read. An empty table gives no
    rows.
    """
    marks = labels.filter("doc_id is not null and (quality = 1 or toxic = 1)").groupBy(F.col("doc_id").alias("_id"))
    marks = cut(marks.agg(F.max((F.coalesce("quality", F.lit(0)) == 1).cast("long")).alias("_good"), F.max((F.coalesce("toxic", F.lit(0)) == 1).cast("long")).alias("_toxic")))
    rows = flagged(docs)
    # equal ids of a part and pattern are one row before they meet their labels
    rows = rows.groupBy("key", "part", *FILTERS).agg(F.sum("n").alias("n"))
    rows = rows.join(maybe_broadcast(marks, marks.count()), F.col("key") == F.col("_id"), "left")
    n = F.col("n")
    return interactions(rows, FILTERS, {"n": n, "good": n * F.coalesce("_good", F.lit(0)), "toxic": n * F.coalesce("_toxic", F.lit(0))})
