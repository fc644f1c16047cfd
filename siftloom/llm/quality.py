"""Quality rules whose cutoffs come with a bound on how many good documents they reject.

Labelled documents are dealt in two. A quarter orders a stratum's cutoffs, of all rules together,
into one path from the one that would reject fewest good documents to the one that would reject most,
each rule's from the mildest on. The rest, the holdout, tests the path: with each step one more
cutoff takes effect, and a step holds when the exact (Clopper-Pearson) upper bound of the rate at which
all cutoffs so far reject good documents of the holdout is within the limit. The first step that
fails ends the path, so steps need no correction among each other; the error level is divided among
the strata that have labels enough to show anything. So with the stated confidence no stratum loses
more than the limit of the good documents that pass the base rule. Where labels are too few, nothing
is shown and nothing is rejected.

Everything here is DataFrame operations; the driver sees the strata's numbers of labels.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BLANK, cut, maybe_broadcast

#: rule -> the measure, of which high values are bad; and the cutoffs of each from the mildest on.
RULES: dict[str, str] = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "dup_lines": "n_dup_lines / greatest(n_lines, 1)",
    "repeats": "n_repeat_words / greatest(n_words, 1)",
}
CUTS = tuple(round(0.9 * 0.85**k, 4) for k in range(32))


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def _covered(windows: Column) -> Column:
    """Words in windows of five that occur twice or more; windows: their hashes in order."""
    both = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    twice = _let(both, lambda s: F.filter(s, lambda x, j: F.coalesce(F.get(s, j - 1)["h"] == x["h"], F.lit(False)) | F.coalesce(F.get(s, j + 1)["h"] == x["h"], F.lit(False))))
    places = F.sort_array(F.transform(twice, lambda x: x["i"]))
    start = F.struct(F.lit(-5).alias("last"), F.lit(0).alias("n"))
    return F.aggregate(places, start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(5), p - a["last"])).alias("n")), lambda a: a["n"])


def measures(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs without its text, with n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words and base_failed. A null text has no words; repeated rows and ids stay.
    Columns of docs named like the new ones give way to them."""
    new = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "base_failed")
    kept = [c for c in docs.columns if c not in (text, *new)]
    x = F.coalesce(F.col(text), F.lit(""))
    inner = F.btrim(x, F.lit(" \t\n\x0b\f\r"))
    lines = F.filter(F.split(x, "\n"), lambda s: s.rlike(f"[^{BLANK}]"))
    one = docs.select(
        *kept,
        F.when(inner == "", F.array().cast("array<string>")).otherwise(F.split(inner, f"[{BLANK}]+")).alias("_w"),
        F.length(F.regexp_replace(x, f"[{BLANK}]+", "")).cast("long").alias("word_chars"),
        F.length(F.regexp_replace(x, "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
        lines.alias("_l"),
    )
    w = F.col("_w")
    windows = F.when(F.size(w) < 5, F.array().cast("array<bigint>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(F.size(w) - 5, F.lit(0))), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(5)))))
    two = one.select(*kept, "word_chars", "n_symbols", F.size("_w").cast("long").alias("n_words"), F.size("_l").cast("long").alias("n_lines"), (F.size("_l") - F.size(F.array_distinct("_l"))).cast("long").alias("n_dup_lines"), windows.alias("_h"))
    repeated = F.when(F.size("_h") == F.size(F.array_distinct("_h")), F.lit(0)).otherwise(_covered(F.col("_h"))).cast("long")
    three = two.select(*kept, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", repeated.alias("n_repeat_words"))
    return three.withColumn("base_failed", (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words")))


def _at_most(k: int, n: int, p: float) -> float:
    """The probability of k or fewer of n at a rate p: the incomplete beta function of 1 - p at
    n - k and k + 1, by its continued fraction."""
    if k >= n or p <= 0:
        return 1.0
    if p >= 1:
        return 0.0
    a, b, x = n - k, k + 1, 1 - p
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x))
    if x < (a + 1) / (a + b + 2):
        return front * _fraction(a, b, x) / a
    return 1 - front * _fraction(b, a, 1 - x) / b


def _fraction(a: float, b: float, x: float) -> float:
    tiny = 1e-300
    c, d = 1.0, 1 / ((1 - (a + b) * x / (a + 1)) or tiny)
    out, m = d, 0
    while True:
        m += 1
        before = out
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 / ((1 + top * d) or tiny)
            c = (1 + top / c) or tiny
            out *= c * d
        if abs(out - before) <= 1e-15 * abs(out):
            return out


def upper_bound(k: int, n: int, error: float) -> float:
    """The rate at which k or fewer of n are seen with probability error."""
    if k >= n:
        return 1.0
    low, high = k / n, 1.0
    for _ in range(60):
        p = (low + high) / 2
        low, high = (p, high) if _at_most(k, n, p) > error else (low, p)
    return high


def most_allowed(n: int, limit: float, error: float) -> int:
    """The largest k of n whose upper bound is within the limit; -1 if not even 0 is."""
    low, high = -1, n
    while high - low > 1:
        k = (low + high) // 2
        low, high = (k, high) if _at_most(k, n, limit) <= error else (low, k)
    return low


def _first_below(value: Column) -> Column:
    """The place of the first cutoff that value is above; their number if there is none."""
    return F.size(F.filter(F.array(*map(F.lit, CUTS)), lambda c: c >= value))


def cutoffs(measured: DataFrame, labels: DataFrame, stratum: str, key: str = "doc_id", limit: float = 0.03, error: float = 0.05) -> DataFrame:
    """_s and, named after the rules, the strictest cutoff shown for each (null: none), of every
    stratum of which any is.

    labels has key and quality; a document labelled more than once is good if any label says so, and
    null labels do not count. Which documents order the path is settled by a hash of the key.
    """
    spark = measured.sparkSession
    good = labels.filter("quality is not null").groupBy(key).agg(F.max("quality").alias("_q")).filter("_q = 1").select(F.col(key).alias("_key"))
    met = [_first_below(F.expr(measure)).alias(rule) for rule, measure in RULES.items()]
    orders = F.substring(F.md5(F.col(key).cast("string").cast("binary")), 1, 1).isin("0", "4", "8", "c")
    rows = measured.filter(~F.col("base_failed")).join(good, F.col(key) == F.col("_key"), "left_semi")
    rows = cut(rows.select(F.col(stratum).cast("string").alias("_s"), orders.alias("_orders"), *met).groupBy("_s", "_orders", *RULES).agg(F.count(F.lit(1)).alias("_n")))

    sizes = cut(rows.filter("not _orders").groupBy("_s").agg(F.sum("_n").alias("_all")))
    enough = sizes.filter(F.col("_all") * math.log1p(-limit) <= math.log(error))
    n_strata = max(1, enough.count())
    allowed = [(r["_all"], most_allowed(r["_all"], limit, error / n_strata)) for r in enough.select("_all").distinct().collect()]
    budget = enough.join(F.broadcast(spark.createDataFrame(allowed, "_all long, _most long")), "_all").select("_s", "_most")  # a row for each size

    each = F.explode(F.array(*(F.struct(F.lit(rule).alias("_rule"), F.lit(k).alias("_k")) for rule in RULES for k in range(len(CUTS))))).alias("_c")
    steps = budget.select(F.col("_s").alias("_of"), each).select("_of", "_c.*")
    ordering = rows.filter("_orders").select("_s", "_n", F.explode(F.array(*(F.struct(F.lit(rule).alias("r"), F.col(rule).alias("k")) for rule in RULES))).alias("_m")).groupBy("_s", "_m").agg(F.sum("_n").alias("_n"))
    steps = steps.join(ordering, F.col("_of").eqNullSafe(F.col("_s")) & (F.col("_rule") == F.col("_m.r")) & (F.col("_k") == F.col("_m.k")), "left").select("_of", "_rule", "_k", F.coalesce("_n", F.lit(0)).alias("_n"))
    lost = F.sum("_n").over(Window.partitionBy("_of", "_rule").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0))
    place = F.row_number().over(Window.partitionBy("_of").orderBy("_lost", "_k", "_rule"))
    path = cut(steps.withColumn("_lost", lost).withColumn("_step", place).select("_of", "_rule", "_k", "_step"))

    # the step at which each document of the holdout is first rejected, if at any
    places = path.groupBy("_of").agg(F.map_from_entries(F.collect_list(F.struct(F.concat("_rule", F.col("_k").cast("string")), "_step"))).alias("_at"))
    held = rows.filter("not _orders").join(places, F.col("_s").eqNullSafe(F.col("_of")))
    step = F.least(*(F.try_element_at("_at", F.concat(F.lit(rule), F.col(rule).cast("string"))) for rule in RULES))
    sums = held.select("_of", "_n", step.alias("_step")).filter("_step is not null").groupBy("_of", "_step").agg(F.sum("_n").alias("_n"))
    sums = sums.withColumn("_lost", F.sum("_n").over(Window.partitionBy("_of").orderBy("_step").rowsBetween(Window.unboundedPreceding, 0)))
    failed = sums.join(budget, F.col("_of").eqNullSafe(F.col("_s"))).filter(F.col("_lost") > F.col("_most")).groupBy("_s").agg(F.min("_step").alias("_fail"))
    none = budget.filter("_most < 0").select(F.col("_s").alias("_x"), F.lit(True).alias("_none"))
    open_ = path.join(failed, F.col("_of").eqNullSafe(F.col("_s")), "left").join(none, F.col("_of").eqNullSafe(F.col("_x")), "left").filter("_none is null and (_fail is null or _step < _fail)")
    value = F.get(F.array(*map(F.lit, CUTS)), F.col("_k"))
    return open_.groupBy(F.col("_of").alias("_s")).agg(*(F.min(F.when(F.col("_rule") == rule, value)).alias(f"_{rule}") for rule in RULES))


def quality_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", text: str = "text", key: str = "doc_id", limit: float = 0.03, error: float = 0.05) -> DataFrame:
    """measures() of docs with kept: false where base_failed, or where a rule's measure is above the
    cutoff of the document's stratum. Null is a stratum too. An empty table gives an empty one."""
    measured = cut(measures(docs.select(key, stratum, text), text))
    table = cut(cutoffs(measured, labels, stratum, key, limit, error))
    out = measured.join(maybe_broadcast(table, table.count()), F.col(stratum).cast("string").eqNullSafe(F.col("_s")), "left")
    above = F.lit(False)
    for rule, measure in RULES.items():
        above = above | F.coalesce(F.expr(measure) > F.col(f"_{rule}"), F.lit(False))
    return out.withColumn("kept", ~F.col("base_failed") & ~above).drop("_s", *(f"_{rule}" for rule in RULES))
