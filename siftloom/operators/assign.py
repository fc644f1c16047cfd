"""Assigning each read the gene it comes from, by one of three rules.

A row for each read and overlapping gene carries what the rules need: the gene's function for the
read, counts of bases, whether the strands match, and which blocks meet an exon. A read gets its genes as
a list, and the rules are expressions of it. Of reads longer than a bin of lists, they are aggregates of
rows by read, which combine before they are sent. Both give the same. What is told depends on nothing but
where a read lies, so it is found once for each distinct place, however many reads lie there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cigar import blocks, operations, reference_length
from ..functions.locus import count_function, gene_counts, gene_function, label, touches_exon
from ..functions.reads import negative_strand
from ..schemas import CODING, INTERGENIC, INTRONIC, READ_ID, REVERSE, UTR
from ..session import settled
from .overlap import BROADCAST_BYTES, _bytes, overlap_join, overlap_lists

#: All functions that a gene may have for a read.
FUNCTIONS = (INTERGENIC, INTRONIC, UTR, CODING)
#: What a read has besides its own columns while its genes are a list.
_PLACED = ["_read", "begin", "stop", "_p"]
#: Reads of at least this mapping quality are confident, for the metrics of rule 2.
CONFIDENT = 255
#: What tells places of reads apart; reads of a place beyond which it is broadcast.
PLACE, OFTEN = ["contig", "pos", "cigar", "flag"], 10_000


def with_places(reads: DataFrame) -> DataFrame:
    """reads with begin and stop (1-based, closed) and blocks."""
    ops = operations(F.col("cigar"))
    out = reads.withColumns({"begin": F.col("pos") + 1, "_ops": ops})
    return out.withColumns({"stop": F.col("pos") + reference_length(F.col("_ops")), "blocks": blocks(F.col("_ops"), F.col("begin"))}).drop("_ops")


def gene_rows(reads: DataFrame, genes: DataFrame, mode: int, broadcast: bool | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """READ_ID with, for each overlapping gene, g_ord, g_start, gene, g_neg, f (its function), same
    (strand), exon, intron (bases, rule 2) and hits (which blocks meet an exon, rules 0 and 1); and the
    columns of reads to keep."""
    g = genes.select("contig", F.col("gene_ord").alias("g_ord"), F.col("gene_name").alias("gene"), F.col("start").alias("g_start"), F.col("end").alias("g_end"), F.col("neg_strand").alias("g_neg"), "transcripts")
    r = with_places(reads.select(*READ_ID, "contig", "pos", "cigar", "flag", *keep))
    pairs = overlap_join(r, g, broadcast=broadcast, key="g_ord", also=("gene", "g_neg", "transcripts"))
    same = F.col("g_neg") == negative_strand(F.col("flag"))
    base = [*READ_ID, *keep, "g_ord", "g_start", "gene", "g_neg", same.alias("same")]
    if mode == 2:
        length = F.aggregate("blocks", F.lit(0), lambda n, b: n + b["len"])
        pairs = pairs.withColumns({"_c": gene_counts(F.col("blocks"), F.col("transcripts")), "_len": length})
        return pairs.select(*base, F.col("_c.exon").alias("exon"), F.col("_c.intron").alias("intron"), count_function(F.col("_c.exon"), F.col("_c.intron"), F.col("_len")).alias("f"))
    hits = F.transform("blocks", lambda b: touches_exon(b, F.col("transcripts")))
    return pairs.select(*base, gene_function(F.col("blocks"), F.col("transcripts")).alias("f"), hits.alias("hits"))


def _strand(neg: Column) -> Column:
    return F.when(neg, "-").otherwise("+")


def rule2(rows: DataFrame) -> DataFrame:
    """The gene with the highest function if only one has it, else of all genes the one with the most
    exon, then intron bases, then the first. No gene is given where the pick is intergenic."""
    told = ["gene", "g_neg", "same"]
    most = F.struct("exon", "intron", (-F.col("g_start")).alias("s"), (-F.col("g_ord")).alias("o"), "f", *told)
    many = [F.count_if(F.col("f") == f).alias(f"_n{f}") for f in FUNCTIONS]
    # aggregates alone, which combine before they are sent and hold no list
    picked = rows.groupBy(*READ_ID).agg(F.max(F.struct("f", *told)).alias("_t"), F.max(most).alias("_m"), *many)
    n_top = F.coalesce(*(F.when(F.col("_t.f") == f, F.col(f"_n{f}")) for f in FUNCTIONS))
    picked = picked.withColumn("_one", n_top == 1)
    pick = lambda c: F.when(F.col("_one"), F.col(f"_t.{c}")).otherwise(F.col(f"_m.{c}"))
    out = picked.select(*READ_ID, pick("f").alias("f"), pick("gene").alias("gene"), pick("g_neg").alias("g_neg"), pick("same").alias("same"))
    return _given(out, READ_ID)


def _given(out: DataFrame, keep: list[str]) -> DataFrame:
    """What rule 2 gives by f, gene, g_neg and same of the pick."""
    given = F.col("f") > INTERGENIC
    return out.select(*keep, label(F.col("f")).alias("xf"), F.when(given, F.col("gene")).alias("ge"), F.when(given, _strand(F.col("g_neg"))).alias("gs"), F.col("same").alias("right"), (~F.col("same")).alias("wrong"), F.lit(False).alias("fixed"), F.lit(False).alias("rejected"), "f")


def _by_strand(g: DataFrame, n_same: Column, n_other: Column, one: Column, keep: list[str] = READ_ID) -> DataFrame:
    """The gene that is given of candidates counted by strand; one: the candidate on the read's strand, of
    g with _top."""
    g = g.withColumns({"_n": n_same, "_o": n_other, "_one": one})
    wrong, rejected, fixed = (F.col("_n") == 0) & (F.col("_o") > 0), F.col("_n") > 1, (F.col("_n") == 1) & (F.col("_o") > 0)
    only = lambda c: F.when(F.col("_n") == 1, F.col(f"_one.{c}"))
    top = F.coalesce("_top", F.lit(INTERGENIC))
    return g.select(*keep, label(top).alias("xf"), only("gene").alias("ge"), F.when(F.col("_n") == 1, _strand(only("g_neg"))).alias("gs"), (~wrong & ~rejected).alias("right"), wrong.alias("wrong"), fixed.alias("fixed"), rejected.alias("rejected"), top.alias("f"))


def rule0(rows: DataFrame) -> DataFrame:
    """The gene whose exons are met by any block, if it is the only one, its function is exonic or UTR and it
    is on the read's strand. Aggregates alone, which combine before they are sent."""
    hit = F.exists("hits", lambda h: h)
    g = rows.groupBy(*READ_ID).agg(F.count_if(hit).alias("_hit"), F.max(F.when(hit, F.struct("g_ord", "gene", "g_neg", "same", "f"))).alias("_g"), F.max(F.when(F.col("same"), F.col("f"))).alias("_top"))
    fits = (F.col("_hit") == 1) & (F.col("_g.f") >= UTR)
    return _by_strand(g, (fits & F.col("_g.same")).cast("long"), (fits & ~F.col("_g.same")).cast("long"), F.col("_g"))


def rule1(rows: DataFrame) -> DataFrame:
    """Of the genes that every block meets which meets one, after the last block that shares none with those
    before, those whose function is exonic or UTR; the one on the read's strand is given if it is alone.

    Which genes a block keeps depends on nothing but which blocks each gene meets. So genes of a read are
    counted by that pattern of blocks, before they are sent, and the blocks are gone through on patterns.
    """
    pattern = F.array_join(F.transform("hits", lambda h: F.when(h, "1").otherwise("0")), "")
    fits = F.col("f") >= UTR
    by = rows.groupBy(*READ_ID, pattern.alias("blocks")).agg(F.count_if(fits & F.col("same")).alias("same"), F.count_if(fits & ~F.col("same")).alias("other"), F.max(F.when(fits & F.col("same"), F.struct("g_ord", "gene", "g_neg"))).alias("one"), F.max("f").alias("_top"))
    g = by.groupBy(*READ_ID).agg(F.collect_list(F.struct("blocks", "same", "other", "one")).alias("p"), F.max("_top").alias("_top"))
    meet = lambda k: F.transform(F.filter("p", lambda x: F.substring(x["blocks"], k, F.lit(1)) == "1"), lambda x: x["blocks"])
    n = F.length(F.get("p", 0)["blocks"])
    none = F.array().cast("array<string>")
    each = F.when(n > 0, F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), meet)).otherwise(F.array().cast("array<array<string>>"))
    left = F.aggregate(each, none, lambda a, t: F.when((F.size(a) > 0) & (F.size(t) > 0), F.array_intersect(a, t)).otherwise(t))
    g = g.withColumn("_left", left).withColumn("_c", F.filter("p", lambda x: F.array_contains("_left", x["blocks"])))
    total = lambda c: F.aggregate("_c", F.lit(0).cast("long"), lambda a, x: a + x[c])
    return _by_strand(g, total("same"), total("other"), F.array_max(F.transform("_c", lambda x: x["one"])))


def _list_rule2(reads: DataFrame) -> DataFrame:
    """rule2 of reads with _p, the genes of each."""
    reads = reads.withColumn("_most", F.array_max(F.transform("_p", lambda x: x["f"])))
    reads = reads.withColumn("_tops", F.filter("_p", lambda x: x["f"] == F.col("_most")))
    reads = reads.withColumn("_pick", F.when(F.size("_tops") == 1, F.get("_tops", 0)).otherwise(F.array_max("_p")))
    return _given(reads.withColumns({c: F.col(f"_pick.{c}") for c in ("f", "gene", "g_neg", "same")}), _PLACED)


def _list_rule0(reads: DataFrame) -> DataFrame:
    hit = F.filter("_p", lambda x: F.exists(x["hits"], lambda h: h))
    g = reads.withColumns({"_hits": hit, "_top": F.array_max(F.transform(F.filter("_p", lambda x: x["same"]), lambda x: x["f"]))}).withColumn("_g", F.array_max("_hits"))
    fits = (F.size("_hits") == 1) & (F.col("_g.f") >= UTR)
    return _by_strand(g, F.coalesce((fits & F.col("_g.same")).cast("long"), F.lit(0)), F.coalesce((fits & ~F.col("_g.same")).cast("long"), F.lit(0)), F.col("_g"), _PLACED)


def _list_rule1(reads: DataFrame) -> DataFrame:
    none = F.array().cast("array<bigint>")
    met = lambda k: F.transform(F.filter("_p", lambda x: F.get(x["hits"], k)), lambda x: x["g_ord"])
    each = F.when(F.size("blocks") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.size("blocks"), F.lit(1)) - 1), met)).otherwise(F.array().cast("array<array<bigint>>"))
    left = F.aggregate(each, none, lambda a, t: F.when((F.size(a) > 0) & (F.size(t) > 0), F.array_intersect(a, t)).otherwise(t))
    g = reads.withColumns({"_left": left, "_top": F.array_max(F.transform("_p", lambda x: x["f"]))})
    g = g.withColumn("_c", F.filter("_p", lambda x: (x["f"] >= UTR) & F.array_contains(F.col("_left"), x["g_ord"])))
    one = F.filter("_c", lambda x: x["same"])
    return _by_strand(g, F.size(one).cast("long"), (F.size("_c") - F.size(one)).cast("long"), F.array_max(one), _PLACED)


def _annotated(reads: DataFrame, genes: DataFrame, mode: int, broadcast: bool | None) -> DataFrame:
    """What annotate gives, each read by itself."""
    g = genes.select("contig", F.col("gene_ord").alias("g_ord"), F.col("gene_name").alias("gene"), F.col("start").alias("g_start"), F.col("end").alias("g_end"), F.col("neg_strand").alias("g_neg"), "transcripts")
    placed = with_places(reads.select(F.struct(*reads.columns).alias("_read"), "contig", "pos", "cigar", "flag"))
    placed, short, size = overlap_lists(placed, g, ("g_ord", "gene", "g_neg", "transcripts"), "_g", broadcast=broadcast)
    met = F.filter("_g", lambda x: (x["g_start"] <= F.col("stop")) & (x["g_end"] >= F.col("begin")))
    same = lambda x: (x["g_neg"] == negative_strand(F.col("flag"))).alias("same")
    if mode == 2:
        counted = F.transform(met, lambda x: F.struct(gene_counts(F.col("blocks"), x["transcripts"]).alias("c"), x["g_start"].alias("s"), x["g_ord"].alias("o"), x["gene"].alias("gene"), x["g_neg"].alias("g_neg"), same(x)))
        length = F.aggregate("blocks", F.lit(0), lambda n, b: n + b["len"])
        placed = placed.withColumns({"_p": counted, "_len": length})  # counts once, to be used thrice
        seen = lambda x: F.struct(x["c"]["exon"].alias("exon"), x["c"]["intron"].alias("intron"), (-x["s"]).alias("s"), (-x["o"]).alias("o"), count_function(x["c"]["exon"], x["c"]["intron"], F.col("_len")).alias("f"), x["gene"].alias("gene"), x["g_neg"].alias("g_neg"), x["same"].alias("same"))
        placed = placed.withColumn("_p", F.transform("_p", seen))
    else:
        hits = lambda x: F.transform("blocks", lambda b: touches_exon(b, x["transcripts"])).alias("hits")
        placed = placed.withColumn("_p", F.transform(met, lambda x: F.struct(x["g_ord"].alias("g_ord"), x["gene"].alias("gene"), x["g_neg"].alias("g_neg"), same(x), gene_function(F.col("blocks"), x["transcripts"]).alias("f"), hits(x))))
    placed = placed.withColumn("_p", F.when(F.size("_p") > 0, F.col("_p")))
    told = (_list_rule0, _list_rule1, _list_rule2)[mode](placed)
    names = [c for c in told.columns if c not in _PLACED]
    longer = with_places(reads).filter(F.col("stop").cast("long") - F.col("begin") > size).select(*reads.columns)
    some = bool(longer.select("pos").take(1))
    once = F.monotonically_increasing_id() >= 0  # true; keeps filters on what is told from repeating all that it takes
    out = (told.filter(short) if some else told).select("_read.*", *(F.when(F.col("_p").isNotNull() & once, F.col(c)).alias(c) for c in names))
    if some:
        found = (rule0, rule1, rule2)[mode](gene_rows(longer, genes, mode, broadcast))
        out = out.unionByName(longer.join(found, READ_ID, "left").select(*out.columns))
    out = out.withColumn("nogene", F.col("f").isNull())
    return out.withColumns({c: F.coalesce(c, F.lit(False)) for c in ("right", "wrong", "fixed", "rejected")})


def annotate(reads: DataFrame, genes: DataFrame, mode: int = 2, broadcast: bool | None = None) -> DataFrame:
    """reads with xf (function), ge, gs (gene and its strand), all null where no gene overlaps or is
    given, and what the metrics count: nogene, right, wrong, fixed, rejected and f.

    The distinct places (of the flag the strand) are annotated as if they were reads, and reads are told by place.
    Grouping also deals this work evenly, in however few parts reads are read."""
    strand = F.col("flag").bitwiseAND(REVERSE)
    places = reads.groupBy(*PLACE[:-1], strand.alias("flag")).agg(F.count(F.lit(1)).alias("_n"))
    # numbered once they are written, when a number stays with its place
    places = settled(places.select(F.lit(0).alias("file_idx"), F.monotonically_increasing_id().alias("rec_idx"), *PLACE, "_n"), "places")
    told = _annotated(places, genes, mode, broadcast)
    names = [c for c in told.columns if c not in places.columns]
    told = settled(told.select(*(F.col(c).alias(f"_{c}") for c in PLACE), *names, "_n"), "told")
    met = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in PLACE[:-1]] + [strand.eqNullSafe(F.col("_flag"))]
    keys = [f"_{c}" for c in PLACE]
    if broadcast or broadcast is None and _bytes(told) <= BROADCAST_BYTES:
        return reads.join(F.broadcast(told.drop("_n")), met).drop(*keys)
    often = told.filter(F.col("_n") > OFTEN)
    if not often.take(1):
        return reads.join(told.drop("_n"), met).drop(*keys)
    # places of very many reads are told before the shuffle, which then deals these reads by their ids
    found = reads.join(F.broadcast(often.select(*keys, F.struct(*names).alias("_often"))), met, "left").drop(*keys)
    found = found.withColumn("_deal", F.when(F.col("_often").isNotNull(), F.xxhash64(*READ_ID)))
    rest = told.filter(F.col("_n") <= OFTEN).select(*keys, F.struct(*names).alias("_rest"), F.lit(None).cast("bigint").alias("_none"))
    found = found.join(rest, [*met, F.col("_deal").eqNullSafe(F.col("_none"))], "left")
    return found.select(*reads.columns, F.inline(F.array(F.coalesce("_often", "_rest"))))
