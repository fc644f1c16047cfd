"""Operators on large groups and skewed keys, against plain loops, and what their plans hold."""

import random

import pytest
from pyspark.sql import functions as F

from siftloom.operators import identifiers, matrix, overlap, saturation
from siftloom.operators.dedup import correct_identifiers
from siftloom.operators.ranking import WITHIN, placed


def hamming(a, b):
    return sum(k >= len(b) or b[k] != c for k, c in enumerate(a))


def loop(group, mismatch):
    """Name -> root of (name, count) of a group."""
    out = {}
    for name, _ in sorted(group, key=lambda g: (-g[1], g[0])):
        out[name] = next((r for r in out if out[r] == r and hamming(name, r) <= mismatch), name)
    return out


def names_of(rng, n, lengths, letters="ACGT"):
    return list({"".join(rng.choice(letters) for _ in range(rng.choice(lengths))) for _ in range(n)})


@pytest.mark.parametrize("mismatch", [0, 1, 2])
@pytest.mark.parametrize("lengths", [[5], [1, 2, 4, 5]])
def test_near_pairs_are_all_near_pairs(spark, mismatch, lengths):
    rng = random.Random(mismatch)
    rows = [(k * 1000 + i, f"g{k}", n) for k in range(2) for i, n in enumerate(names_of(rng, 90, lengths))]
    got = identifiers.near_pairs(spark.createDataFrame(rows, "id long, group string, name string"), mismatch).collect()
    want = {(g, x, r) for x, g, a in rows for r, h, b in rows if g == h and r < x and hamming(a, b) <= mismatch}
    assert len(got) == len(want)
    assert {(p.g, p.x, p.r) for p in got} == want


@pytest.mark.parametrize("left", [0, 40, 10**6])
def test_roots_are_those_of_the_loop(spark, left):
    rng = random.Random(left)
    rows, want = [], {}
    for k, lengths in enumerate(([4], [6], [3, 4, 5])):
        group = [(n, rng.choice([1, 1, 2, 3, 9, 40])) for n in names_of(rng, 250, lengths)]
        rows += [("c", "b" if k else None, f"g{k}", n, c) for n, c in group]
        want |= {(f"g{k}", n): r for n, r in loop(group, 1).items()}
    counts = spark.createDataFrame(rows, "contig string, barcode string, gene string, umi string, cnt long")
    got = identifiers.rooted(counts, 1, left).collect()
    assert {(r.gene, r.umi): r.root_umi for r in got} == want and len(got) == len(rows)


def test_a_chain_is_settled_in_order(spark):
    pairs = spark.createDataFrame([("g", k + 1, k) for k in range(40)], "g string, x long, r long")
    for left in (0, 100):
        got = {r.x: r.root for r in identifiers.collapsed(pairs, left).collect()}
        assert got == {k: k - 1 for k in range(1, 41, 2)}
    assert identifiers.collapsed(pairs.limit(0)).count() == 0


def test_a_large_group_takes_many_tasks_and_no_comparison_of_all(spark):
    n = 4000
    counts = spark.range(n).select(F.lit("c").alias("contig"), F.lit("b").alias("barcode"), F.lit("g").alias("gene"), F.translate(F.lpad(F.conv((F.col("id") * 7).cast("string"), 10, 4), 9, "0"), "0123", "ACGT").alias("umi"), (F.col("id") % 5 + 1).alias("cnt"))
    got = correct_identifiers(counts)
    rows = [(r.umi, r.cnt) for r in counts.collect()]
    assert {r.umi: r.root_umi for r in got.collect()} == loop(rows, 1)
    plan = identifiers.near_pairs(placed(counts, ["umi"], "id").withColumnsRenamed({"gene": "group", "umi": "name"}), 1)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan and "InPandas" not in plan


def test_places_of_names_that_begin_alike(spark):
    n = 20_000
    names = spark.range(n).select(F.format_string("41_16_%d_%d", F.col("id") % 977, F.col("id")).alias("barcode")).repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = matrix.indexed(names, "barcode", "i").collect()
        dealt = names.repartitionByRange("barcode").withColumn("_id", F.monotonically_increasing_id())
        sizes = [r["count"] for r in dealt.groupBy(F.shiftright("_id", WITHIN).alias("p")).count().collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {r.barcode: r.i for r in got} == {b: k for k, b in enumerate(sorted(r.barcode for r in got), 1)}
    assert len(sizes) == 16 and max(sizes) < 2 * n / 16
    assert matrix.indexed(names.limit(0), "barcode", "i").count() == 0


def plain_curve(reads, unit):
    """By level, of reads (barcode, gene, umi) in order: reads per unit, repeated share, upper median of genes."""
    out = {}
    for x in saturation.LEVELS:
        units = {}
        for r in reads[: int(x * len(reads))]:
            units.setdefault(unit(r[0]), []).append(r)
        if not units:
            continue
        known = [r for r in reads[: int(x * len(reads))] if r[1] != "NOGENE"]
        uniq = len({(unit(r[0]), r[1], r[2]) for r in known})
        genes = sorted(len({r[1] for r in rs if r[1] != "NOGENE"}) for rs in units.values())
        out[x] = (sum(map(len, units.values())) // len(units), round(1 - uniq / len(known), 6) if known else None, genes[len(genes) // 2])
    return out


@pytest.mark.parametrize("n", [3, 40, 700])
def test_levels_of_an_order_that_is_not_spread(spark, n):
    """Most reads have equal keys, all of one range; equals go by the other columns."""
    rng = random.Random(n)
    rows = [(f"1_2_{rng.randrange(4) * 100}_{rng.randrange(3) * 100}", rng.choice(["NOGENE", "a", "b", "c"]), f"u{rng.randrange(5)}", rng.choice([0, 0, 0, 5, 2**61]), k) for k in range(n)]
    reads = spark.createDataFrame(rows, "barcode string, gene string, umi string, _key long, k long").select("k", "barcode", "gene", "umi", "_key")
    leveled = saturation.leveled(reads.repartition(5), F.col("_key"))
    ordered = sorted(rows, key=lambda r: (r[3], r[4]))
    seen = saturation.first_seen(leveled)
    side = saturation.BIN_SIDE
    for unit, table in (("barcode", seen), ("bin", saturation.first_seen(seen.withColumn("bin", saturation.spatial_bin(F.col("barcode"))), "bin"))):
        of = (lambda b: b) if unit == "barcode" else (lambda b: f"{int(b.split('_')[2]) // side}_{int(b.split('_')[3]) // side}")
        got = {r.sample: (r.x, r.y1, r.y2) for r in saturation.curve(table, unit).collect()}
        assert got == plain_curve([r[:3] for r in ordered], of)


def test_reads_are_not_repeated_by_level(spark):
    n = 5000
    counts = spark.range(n).selectExpr("concat('b', id % 7) AS barcode", "concat('g', id % 50) AS gene", "concat('u', id) AS umi", "CAST(2 AS BIGINT) AS cnt")
    reads = saturation.exploded(counts)
    leveled = saturation.leveled(reads, F.shiftrightunsigned(F.xxhash64("barcode", "gene", "umi", "_k"), 2))
    assert leveled.count() == 2 * n
    assert "Exchange" not in leveled._jdf.queryExecution().executedPlan().toString()
    sent = saturation.first_seen(leveled)
    plan = sent._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and sent.count() == n  # one shuffle, of at most a row for each read
    assert {tuple(r) for r in leveled.groupBy("level").count().collect()} == {(k, int(b * 2 * n) - int(a * 2 * n)) for k, (a, b) in enumerate(zip((0, *saturation.LEVELS), saturation.LEVELS, strict=False))}


GENE = "contig string, gene_ord long, g_start int, g_end int"


def plain_near(reads, genes, within):
    return {(r[0], g[1], max(0, g[2] - r[3], r[2] - g[3])) for r in reads for g in genes if r[1] == g[0] and max(0, g[2] - r[3], r[2] - g[3]) <= within}


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("within", [0, 1, 300, 50_000])
def test_near_and_nearest(spark, within, broadcast):
    rng = random.Random(within)
    reads = [(k, rng.choice(["c1", "c2", "none", None]), b := rng.randrange(1, 400_000), b + rng.choice([0, 90, 40_000])) for k in range(120)]
    genes = [(rng.choice(["c1", "c2"]), k, s := rng.randrange(1, 400_000), s + rng.choice([0, 10, 30_000])) for k in range(40)]
    genes += [("c1", 900, genes[0][2], genes[0][3]), ("c1", 901, 1, 400_000 if within == 1 else 5)]
    r, g = spark.createDataFrame(reads, "id int, contig string, begin int, stop int"), spark.createDataFrame(genes, GENE)
    near = overlap.near_join(r, g, within, broadcast=broadcast)
    want = plain_near(reads, genes, within)
    rows = near.collect()
    assert {(x.id, x.gene_ord, x.distance) for x in rows} == want and len(rows) == len(want)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    best = {}
    start = {g[1]: g[2] for g in genes}
    for i, o, d in want:
        best[i] = min(best.get(i, (d, start[o], o)), (d, start[o], o))
    got = overlap.nearest_join(r, g, within, ["id"], broadcast=broadcast).collect()
    assert {x.id: (x.distance, x.g_start, x.gene_ord) for x in got} == best and len(got) == len(best)


def test_a_hot_bin_is_divided(spark):
    reads = spark.range(6000).selectExpr("id", "'c1' AS contig", "CAST(100 + id % 50 AS INT) AS begin", "CAST(200 + id % 50 AS INT) AS stop")
    reads = reads.unionByName(spark.createDataFrame([(-1, "c1", 90_000, 90_100), (-2, "c2", 100, 110)], "id long, contig string, begin int, stop int"))
    genes = spark.createDataFrame([("c1", 1, 1, 120), ("c1", 2, 240, 20_000), ("c1", 3, 80_000, 95_000), ("c2", 4, 1, 500)], GENE)
    got = overlap.overlap_join(reads, genes, broadcast=False, hot=500).select("id", "gene_ord").collect()
    want = overlap.overlap_join(reads, genes, broadcast=True).select("id", "gene_ord").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    dealt, load = overlap.divided(reads.withColumn("_bin", F.floor(F.col("begin") / overlap.BIN)), 500)
    assert [tuple(r) for r in load.collect()] == [("c1", 0, 12)]
    sizes = [r["count"] for r in dealt.filter("contig = 'c1' and _bin = 0").groupBy("_part").count().collect()]
    assert len(sizes) == 12 and max(sizes) < 700


def test_what_is_broadcast_is_bound_by_bytes(spark, monkeypatch):
    """Transcripts do not go into bins, and a table beyond the bound is shuffled."""
    reads = spark.createDataFrame([(1, "c1", 10, 20)], "id long, contig string, begin int, stop int")
    genes = spark.createDataFrame([("c1", k, 1, 500_000, "x" * 1000) for k in range(50)], GENE + ", text string")

    def plan(limit):
        monkeypatch.setattr(overlap, "BROADCAST_BYTES", limit)
        out = overlap.overlap_join(reads, genes, key="gene_ord", also=("text",))
        assert out.count() == 50
        return out._jdf.queryExecution().optimizedPlan().toString().count("strategy=broadcast")

    # 31 bins of 50 genes at some 100 bytes, and 50 texts of 1,000
    assert plan(1 << 20) == 2
    assert plan(100_000) == 1
    assert plan(10_000) == 0


@pytest.mark.parametrize("turned", [False, True])
def test_nearest_makes_no_pairs_of_dense_genes(spark, monkeypatch, turned):
    """Each read meets one row, however many genes it overlaps; rows that end before they start are told too."""
    rng = random.Random(7)
    reads = [(k, rng.choice(["c1", "c2"]), b := rng.randrange(1, 300_000), b + rng.choice([-1, 0, 90])) for k in range(150)]
    genes = [(rng.choice(["c1", "c2"]), k, s := rng.randrange(1, 300_000), s + rng.choice([0, 900, 60_000])) for k in range(400)]
    if turned:
        reads, genes = [*reads, (900, "c1", 70_000, 69_000)], [*genes, ("c2", 900, 150_000, 149_500)]
    else:
        monkeypatch.setattr(overlap, "near_join", None)
    best, start = {}, {g[1]: g[2] for g in genes}
    for i, c, b, e in reads:
        near = [(d, gs, o) for gc, o, gs, ge in genes if gc == c and (d := max(0, gs - e, b - ge)) <= 2000]
        if near:
            best[i] = min(near)
    r, g = spark.createDataFrame(reads, "id int, contig string, begin int, stop int"), spark.createDataFrame(genes, GENE)
    got = overlap.nearest_join(r, g, 2000, ["id"]).collect()
    assert {x.id: (x.distance, x.g_start, x.gene_ord) for x in got} == best and len(got) == len(best)
    assert all(start[x.gene_ord] == x.g_start for x in got)


def test_near_genes_meet_each_place_once(spark):
    """Reads of a place follow each other with the same genes, repeated rows and rows without a place as in near_join."""
    reads = spark.createDataFrame([(k, None if k == 7 else f"chr{k % 2}", None if k == 8 else k % 5 * 900, k % 5 * 900 + 40 + k % 3) for k in [*range(300), 5]], "rec_idx long, contig string, begin int, stop int")
    genes = spark.createDataFrame([(k, f"chr{k % 3}", k * 35, k * 35 + 20) for k in range(120)], "gene_ord long, contig string, g_start int, g_end int")
    wanted = ["rec_idx", "gene_ord", "distance"]
    got = overlap.near_by_place(reads, genes, 300).select(*wanted, "contig", "begin", "stop").coalesce(1).collect()
    assert sorted(tuple(r[c] for c in wanted) for r in got) == sorted(map(tuple, overlap.near_join(reads, genes, 300).select(*wanted).collect()))
    places = [tuple(r[3:]) for r in got]
    assert sum(a != b for a, b in zip(places, places[1:])) + 1 == len(set(places)) > 10
