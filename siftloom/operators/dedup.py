"""Dropping repeated reads, by fragment position or by molecular identifier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.reads import hamming, marker, with_flag
from ..schemas import DUPLICATE, NO_GENE, READ_ID
from ..session import settled
from .identifiers import rooted

#: Identifiers of a group up to which the correction is an expression; larger groups go by pairs.
FOLD = 200


def _firsts(reads: DataFrame, keys: list[Column]) -> DataFrame:
    """reads with _one, whether they are the first of their keys. The firsts are minima, which combine before
    they are sent, and are told to the reads by id, so a key with very many reads is no hot task."""
    first = reads.groupBy(*(k.alias(f"_k{i}") for i, k in enumerate(keys))).agg(F.min(F.struct(*READ_ID)).alias("_f"))
    first = first.select(*(F.col(f"_f.{c}").alias(f"_{c}") for c in READ_ID))
    found = reads.join(first, [F.col(c) == F.col(f"_{c}") for c in READ_ID], "left")
    return found.withColumn("_one", F.col(f"_{READ_ID[0]}").isNotNull()).drop(*(f"_{c}" for c in READ_ID))


def by_position(reads: DataFrame, keep: bool = False, scope: str = "contig") -> DataFrame:
    """reads (annotated ones) with status keep for the first of each fragment position and barcode, and
    dup for others, which are flagged if kept and dropped if not. scope whole disregards the contig."""
    keys = [marker(F.col("pos"), F.col("mpos"), F.col("isize")), F.col("cb")]
    out = _firsts(reads, [F.col("contig"), *keys] if scope == "contig" else keys)
    return _settled(out, keep, DUPLICATE)


def by_identifier(reads: DataFrame, keep: bool = False, scope: str = "contig") -> DataFrame:
    """reads with status keep for the first of each contig (not for scope whole), barcode, gene and
    identifier, dup for others."""
    keys = [F.col(c) for c in ("cb", "ge", "ur")]
    return _settled(_firsts(reads, [F.col("contig"), *keys] if scope == "contig" else keys), keep, DUPLICATE)


def _settled(marked: DataFrame, keep: bool, bit: int) -> DataFrame:
    if not keep:
        return marked.filter("_one").drop("_one").withColumn("status", F.lit("keep"))
    return marked.withColumns({"status": F.when(F.col("_one"), "keep").otherwise("dup"), "flag": F.when(F.col("_one"), F.col("flag")).otherwise(with_flag(F.col("flag"), bit))}).drop("_one")


def identifier_counts(reads: DataFrame, scope: str = "contig") -> DataFrame:
    """contig (* for scope whole), barcode, gene, umi, cnt of all reads; those without a gene count under
    NOGENE."""
    contig = F.col("contig") if scope == "contig" else F.lit("*")
    return reads.groupBy(contig.alias("contig"), F.col("cb").alias("barcode"), F.coalesce("ge", F.lit(NO_GENE)).alias("gene"), F.col("ur").alias("umi")).agg(F.count(F.lit(1)).alias("cnt"))


def _fold(l: Column, mismatch: int) -> Column:
    """Each identifier (umi, cnt; most frequent first) with its root: the first before it that is a
    root and differs in at most mismatch places, or itself."""
    start = F.array().cast("array<struct<umi:string,root:string,cnt:bigint>>")

    def step(a: Column, x: Column) -> Column:
        near = F.filter(a, lambda r: (r["umi"] == r["root"]) & (hamming(x["umi"], r["umi"]) <= mismatch))
        return F.concat(a, F.array(F.struct(x["umi"].alias("umi"), F.coalesce(F.get(near, 0)["umi"], x["umi"]).alias("root"), x["cnt"].alias("cnt"))))

    return F.aggregate(l, start, step)


def correct_identifiers(counts: DataFrame, min_num: int = 5, mismatch: int = 1, fold: int = FOLD) -> DataFrame:
    """counts with root_umi and cluster_cnt, the summed count of the root's cluster (of a collapsed
    identifier 0). Groups of fewer than min_num identifiers, and those without a gene, stay as they are.
    Equally frequent identifiers go by name. Groups of more than fold identifiers are spread over tasks."""
    keys = ["contig", "barcode", "gene"]
    counts = settled(counts, "identifiers")  # read by each way
    sized = counts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    sized = sized.withColumn("_way", F.when((F.col("_n") < min_num) | (F.col("gene") == NO_GENE), "as is").when(F.col("_n") <= fold, "fold").otherwise("large"))
    marked = settled(counts.join(sized, keys), "identifiers")
    same = marked.filter("_way = 'as is'").select(*keys, "umi", "cnt", F.col("umi").alias("root_umi"))
    item = F.struct((-F.col("cnt")).alias("o"), "umi", "cnt")
    folded = marked.filter("_way = 'fold'").groupBy(*keys).agg(F.sort_array(F.collect_list(item)).alias("l")).select(*keys, F.explode(_fold(F.col("l"), mismatch)).alias("e"))
    small = folded.select(*keys, F.col("e.umi").alias("umi"), F.col("e.cnt").alias("cnt"), F.col("e.root").alias("root_umi"))
    out = same.unionByName(small)
    large = marked.filter("_way = 'large'").select(*keys, "umi", "cnt")
    if large.take(1):
        out = out.unionByName(rooted(large, mismatch))
    total = F.sum("cnt").over(Window.partitionBy(*keys, "root_umi"))
    return out.withColumn("cluster_cnt", F.when(F.col("umi") == F.col("root_umi"), total).otherwise(F.lit(0)))


def by_corrected(reads: DataFrame, roots: DataFrame, keep: bool = False, scope: str = "contig") -> DataFrame:
    """reads (by_identifier's, status keep) of which those whose identifier was collapsed are dropped, or
    get ub, its root, and the duplicate flag."""
    r = roots.select("contig", F.col("barcode").alias("cb"), F.col("gene").alias("ge"), F.col("umi").alias("ur"), "root_umi", "cluster_cnt")
    keys = ["cb", "ge", "ur"]
    out = reads.join(r if scope == "contig" else r.drop("contig"), ["contig", *keys] if scope == "contig" else keys, "left").withColumn("_one", F.col("ge").isNull() | (F.col("root_umi") == F.col("ur")))
    out = out.withColumn("ub", F.when(~F.col("_one"), F.col("root_umi")))
    if not keep:
        return out.filter("_one").drop("_one", "root_umi")
    change = F.when(F.col("_one"), F.col("flag")).otherwise(with_flag(F.col("flag"), DUPLICATE))
    return out.withColumns({"status": F.when(F.col("_one"), F.col("status")).otherwise("collapsed"), "flag": change}).drop("_one", "root_umi")


def by_both(reads: DataFrame, roots: DataFrame, keep: bool = False, scope: str = "contig") -> DataFrame:
    """by_identifier and then by_corrected of its firsts, all reads in one table. Firsts meet their roots before
    they are told to the reads, so reads are sent once."""
    keys = [*(["contig"] if scope == "contig" else []), "cb", "ge", "ur"]
    firsts = reads.groupBy(*keys).agg(F.min(F.struct(*READ_ID)).alias("_f"))
    r = roots.select("contig", F.col("barcode").alias("cb"), F.col("gene").alias("ge"), F.col("umi").alias("ur"), "root_umi", "cluster_cnt")
    # an identifier that is null meets no root, but has a first
    told = firsts.join(r.select(*keys, "root_umi", "cluster_cnt"), keys, "left").select(*(F.col(f"_f.{c}").alias(f"_{c}") for c in READ_ID), "root_umi", "cluster_cnt")
    found = reads.join(told, [F.col(c) == F.col(f"_{c}") for c in READ_ID], "left")
    first, root = F.col(f"_{READ_ID[0]}").isNotNull(), F.coalesce(F.col("root_umi") == F.col("ur"), F.lit(False))
    out = found.withColumns({"ub": F.when(first & ~root, F.col("root_umi")), "status": F.when(~first, "dup").when(root, "keep").otherwise("collapsed")})
    out = out.drop(*(f"_{c}" for c in READ_ID), "root_umi")
    if not keep:
        return out.filter("status = 'keep'")
    return out.withColumn("flag", F.when(F.col("status") == "keep", F.col("flag")).otherwise(with_flag(F.col("flag"), DUPLICATE)))
