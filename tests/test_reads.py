import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftloom.config import Config
from siftloom.functions import cigar, locus
from siftloom.functions import reads as names
from siftloom.operators import assign, dedup, density, filters, genemodel, matrix, metrics, overlap, saturation
from siftloom.plans.run import output_order, run
from siftloom.schemas import GENES, READS
from siftloom.sources import annotation, bam, sinks

NAME = "V3|||CB:Z:39_19_58583_28608|||UR:Z:TTGGCGGGT|||UY:Z:E*5)<E0+("


def read(k, cig="100M", pos=0, flag=0, contig="chr1", mapq=255, qname=NAME, hi=None, mpos=0, isize=0, file_idx=0):
    return (file_idx, k, qname, flag, contig, pos, mapq, cig, mpos, isize, "*", "*", hi, {})


def gene(k, start, end, exons, neg=False, contig="chr1", cds=None, name=None):
    lo, hi = min(e[0] for e in exons), max(e[1] for e in exons)
    return (k, contig, name or f"g{k}", f"E{k}", start, end, neg, [("t", lo, hi, *(cds or (lo, hi)), exons)])


def one(df):
    return df.first()


def test_names(spark):
    r = filters.with_names(spark.createDataFrame([read(1)], READS)).withColumns({"row": names.barcode_row(F.col("cb")), "col": names.barcode_column(F.col("cb")), "bin": saturation.spatial_bin(F.col("cb"))}).first()
    assert (r["qname"], r["cb"], r["ur"], r["uy"], r["row"], r["col"], r["bin"]) == ("V3", "39_19_58583_28608", "TTGGCGGGT", "E*5)<E0+(", 58583, 28608, "390_190")
    twice = filters.with_names(spark.createDataFrame([read(1, qname="x|||CB:Z:a|||CB:Z:b")], READS)).first()
    assert (twice["cb"], twice["ur"]) == ("b", "")


@pytest.mark.parametrize(("text", "blocks", "length"), [("10S50M200N50M", [(11, 101, 50), (61, 351, 50)], 300), ("5H3M2I4D7M1P", [(1, 101, 3), (6, 108, 7)], 14), ("*", [], 0)])
def test_cigar(spark, text, blocks, length):
    r = spark.range(1).select(cigar.operations(F.lit(text)).alias("o")).select(cigar.reference_length(F.col("o")).alias("n"), cigar.blocks(F.col("o"), F.lit(101)).alias("b")).first()
    assert r["n"] == length and [tuple(b) for b in r["b"]] == blocks


def test_markers(spark):
    rows = [(100, 0, 0), (100, 0, 200), (0, 100, -200), (1, 0, 22), (0, 3, -9)]
    got = [r[0] for r in spark.createDataFrame(rows, "pos int, mpos int, isize int").select(names.marker(F.col("pos"), F.col("mpos"), F.col("isize"))).collect()]
    assert got[:3] == ["100100", "100300", "300100"] and got[3] == "123"


def test_hit_index_and_quality(spark):
    rows = spark.createDataFrame([read(1), read(2, hi=1, mapq=9), read(3, hi=2), read(4, mapq=10)], READS).filter(filters.primary(F.col("hi")))
    assert [(r["rec_idx"], r["status"], r["flag"]) for r in filters.quality(rows, 10, keep=True).orderBy("rec_idx").collect()] == [(1, "keep", 0), (2, "lowq", 512), (4, "keep", 0)]
    assert filters.quality(rows, 10, keep=False).count() == 2


def test_checks():
    for bad in ({"mode": 3}, {"saturation": True}, {"filter_matrix": False}, {"min_mapq": -1}, {"barcode_source": "x"}):
        with pytest.raises(ValueError):
            Config(**bad)


def test_first_read_must_have_names(spark):
    with pytest.raises(ValueError, match="barcode"):
        filters.check_names(spark.createDataFrame([read(1, qname="x")], READS), umi=False)
    with pytest.raises(ValueError, match="identifier"):
        filters.check_names(spark.createDataFrame([read(1, qname="x|||CB:Z:a")], READS), umi=True)


# ---- assignment ---------------------------------------------------------------------------


def assigned(spark, reads, genes, mode):
    got = assign.annotate(spark.createDataFrame(reads, READS), spark.createDataFrame(genes, GENES), mode)
    return {r["rec_idx"]: r for r in got.collect()}


def test_half_of_the_bases_make_a_read_exonic(spark):
    got = assigned(spark, [read(1, pos=150), read(2, pos=151), read(3, pos=400)], [gene(1, 101, 400, [(101, 200), (301, 400)])], 2)
    assert [(got[k]["xf"], got[k]["ge"]) for k in (1, 2, 3)] == [("EXONIC", "g1"), ("INTRONIC", "g1"), (None, None)]
    assert got[3]["nogene"] and got[1]["right"]


def test_ties_look_at_all_genes(spark):
    a, b, c = gene(1, 900, 1250, [(900, 950), (1200, 1250)]), gene(2, 800, 1350, [(800, 850), (1300, 1350)]), gene(3, 1061, 1300, [(1061, 1300)])
    got = assigned(spark, [read(1, pos=1000)], [a, b, c], 2)[1]
    assert (got["xf"], got["ge"]) == ("INTERGENIC", None)
    got = assigned(spark, [read(1, pos=1000)], [a, c], 2)[1]
    assert (got["xf"], got["ge"]) == ("INTRONIC", "g1")


@pytest.mark.parametrize(("mode", "flag", "want"), [(0, 0, ("EXONIC", None, True, False)), (1, 0, ("EXONIC", "g1", True, False)), (0, 16, ("INTERGENIC", None, True, False)), (1, 16, ("EXONIC", None, False, True))])
def test_two_genes_under_two_blocks(spark, mode, flag, want):
    got = assigned(spark, [read(1, cig="50M150N50M", pos=100, flag=flag)], [gene(1, 50, 400, [(50, 400)]), gene(2, 90, 200, [(90, 200)])], mode)[1]
    assert (got["xf"], got["ge"], got["right"], got["wrong"]) == want


def test_functions_by_intervals_are_those_by_bases(spark):
    rng = random.Random(3)
    rows = []
    for _ in range(300):
        edges = sorted(rng.sample(range(1, 120), 6))
        exons = [(edges[0], edges[1]), (edges[2], edges[3]), (edges[4], edges[5])]
        cds = sorted(rng.sample(range(edges[0], edges[5] + 1), 2))
        start, n = rng.randint(1, 110), rng.randint(1, 40)
        rows.append((exons, cds, start, n))
    block = F.struct(F.lit(1).alias("read_start"), F.col("s").alias("ref_start"), F.col("n").alias("len"))
    kind = "e array<struct<start:int,end:int>>, ts int, te int, cs int, ce int, s int, n int"
    df = spark.createDataFrame([(e, e[0][0], e[-1][1], c[0], c[1], s, n) for e, c, s, n in rows], kind)
    t = F.array(F.struct(F.lit("t").alias("transcript_key"), F.col("ts").alias("tx_start"), F.col("te").alias("tx_end"), F.col("cs").alias("cds_start"), F.col("ce").alias("cds_end"), F.col("e").alias("exons")))
    got = df.withColumns({"b": F.array(block), "t": t}).select(locus.gene_counts(F.col("b"), F.col("t")).alias("c"), locus.gene_function(F.col("b"), F.col("t")).alias("f")).collect()
    for (exons, cds, s, n), r in zip(rows, got, strict=True):
        inside = [p for p in range(s, s + n) if exons[0][0] <= p <= exons[-1][1]]
        in_exon = [p for p in inside if any(a <= p <= b for a, b in exons)]
        f = max([1, *(5 if p in in_exon and cds[0] <= p <= cds[1] else 4 if p in in_exon else 3 for p in inside)])
        assert (r["c"]["exon"], r["c"]["intron"], r["f"]) == (len(in_exon), len(inside) - len(in_exon), f)


def test_binned_join_is_the_plain_one(spark):
    rng = random.Random(4)
    reads = spark.createDataFrame([(k, rng.choice(["a", "b"]), s := rng.randint(1, 80_000), s + rng.randint(0, 40_000)) for k in range(200)], "k int, contig string, begin int, stop int")
    genes = spark.createDataFrame([(k, rng.choice(["a", "b"]), s := rng.randint(1, 80_000), s + rng.randint(0, 40_000)) for k in range(100)], "g int, contig string, g_start int, g_end int")
    want = {(r["k"], g["g"]) for r in reads.collect() for g in genes.collect() if r["contig"] == g["contig"] and r["begin"] <= g["g_end"] and g["g_start"] <= r["stop"]}
    for broadcast in (True, False, None):
        got = [(r["k"], r["g"]) for r in overlap.overlap_join(reads, genes, broadcast=broadcast).collect()]
        assert len(got) == len(want) and set(got) == want


# ---- annotation ---------------------------------------------------------------------------


def lines(spark, rows):
    return spark.createDataFrame(list(enumerate(rows)), "line_no long, value string")


def gtf(feature, start, end, attributes, contig="chr1", strand="+"):
    return f"{contig}\tx\t{feature}\t{start}\t{end}\t.\t{strand}\t.\t{attributes}"


def transcript(name, exons, gid="E", tid="T", contig="chr1"):
    a = f'gene_id "{gid}"; gene_name "{name}"; transcript_id "{tid}";'
    lo, hi = min(e[0] for e in exons), max(e[1] for e in exons)
    return [gtf("gene", lo, hi, f'gene_id "{gid}"; gene_name "{name}";', contig), gtf("transcript", lo, hi, a, contig), *(gtf("exon", s, e, a, contig) for s, e in exons)]


def test_attributes(spark):
    got = annotation.gtf(lines(spark, ["# note", "", gtf("exon", 1, 2, 'gene_id "E1"; gene_name "DDX"; transcript_id "T1";'), gtf("exon", 1, 2, 'gene_id "E1";')])).collect()
    assert [(r["gene_id"], r["gene_name"], r["transcript_id"], r["start"]) for r in got] == [("E1", "DDX", "T1", 1)]


def test_gff_names_are_carried(spark):
    rows = ["r\tx\tregion\t1\t9\t.\t+\t.\tID=r", "r\tx\tgene\t1\t9\t.\t+\t.\tID=a;Name=A", "r\tx\tmRNA\t1\t9\t.\t+\t.\tID=t", "r\tx\texon\t1\t9\t.\t+\t.\tID=e", "r\tx\tregion\t1\t9\t.\t+\t.\tID=r", "r\tx\texon\t1\t9\t.\t+\t.\tID=e"]
    got = annotation.gff(lines(spark, rows)).orderBy("line_no").collect()
    assert [(r["line_no"], r["gene_name"], r["transcript_id"]) for r in got] == [(1, "A", ""), (2, "A", "t"), (3, "A", "t")]


def test_gff_regions_are_counted_by_range(spark, monkeypatch):
    one = ["region ID=r", "exon ID=e", "gene ID=a;Name=A", "mRNA ID=t", "exon ID=e"]
    rows = ["r\tx\t{}\t1\t9\t.\t+\t.\t{}".format(*r.split()) for r in one * 20]
    monkeypatch.setattr(annotation, "RANGE_BITS", 2, raising=False)
    got = annotation.gff(lines(spark, rows))
    assert [(r["line_no"], r["transcript_id"]) for r in got.orderBy("line_no").collect()] == [(5 * k + n, tx) for k in range(20) for n, tx in ((2, ""), (3, "t"), (4, "t"))]
    assert "windowspecdefinition(line_no" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_paths_of_annotations(spark):
    with pytest.raises(ValueError, match="neither"):
        annotation.read_annotation(spark, "x.gff3")


def test_runs_of_contigs(spark):
    rows = [gtf("exon", 1, 2, 'gene_id "E"; gene_name "N"; transcript_id "T";', c) for c in ("chr1", "chr1", "chrX", "chr1")]
    assert [r["run"] for r in genemodel.contig_runs(annotation.gtf(lines(spark, rows))).orderBy("line_no").collect()] == [1, 1, 2, 3]


def test_gene_models(spark):
    rows = [*transcript("ok", [(1, 10), (10, 20)]), *transcript("crossing", [(1, 10), (9, 20)], "F", "U"), *transcript("ids", [(1, 5)], "G", "V"), gtf("exon", 1, 5, 'gene_id "H"; gene_name "ids"; transcript_id "V";'), gtf("gene", 1, 3, 'gene_id "I"; gene_name "extent";'), gtf("exon", 1, 5, 'gene_id "I"; gene_name "extent"; transcript_id "W";'), *transcript("noid", [(1, 5)], "J", "X"), gtf("exon", 1, 5, 'gene_id "J"; gene_name "noid";')]
    a = annotation.gtf(lines(spark, rows))
    bad = {r["gene_name"]: r for r in genemodel.validation(a).collect()}
    assert (bad["crossing"]["exons_overlap"], bad["ids"]["several_ids"], bad["extent"]["extent_differs"], bad["noid"]["no_transcript_id"], bad["ok"]["invalid"]) == (1, 1, 1, 1, 0)
    got = genemodel.gene_model(a).collect()
    assert [g["gene_name"] for g in got] == ["ok"]
    assert [tuple(e) for e in got[0]["transcripts"][0]["exons"]] == [(1, 20)]


# ---- identifiers --------------------------------------------------------------------------

UMIS = [("AAAA", 10), ("AAAT", 4), ("AATT", 3), ("ATTT", 2), ("GGGG", 2), ("GGGC", 1)]


def counts(spark, gene="G"):
    return spark.createDataFrame([("c", "b", gene, u, n) for u, n in UMIS], "contig string, barcode string, gene string, umi string, cnt long")


@pytest.mark.parametrize("fold", [200, 0])
def test_identifiers_collapse_to_roots(spark, fold):
    roots = dedup.correct_identifiers(counts(spark), 5, 1, fold)
    assert {r["umi"]: r["cluster_cnt"] for r in roots.collect() if r["umi"] == r["root_umi"]} == {"AAAA": 14, "AATT": 5, "GGGG": 3}
    assert one(metrics.identifier_totals(roots))[:3] == (1, 6, 3)
    assert {r["position"]: r["cnt"] for r in metrics.mismatch_positions(roots, 4).collect()} == {1: 0, 2: 1, 3: 0, 4: 2}
    assert {r["type"]: r["cnt"] for r in metrics.mismatch_types(roots).collect() if r["cnt"]} == {"T_A": 2, "C_G": 1}


def test_small_groups_and_those_without_a_gene_stay(spark):
    for c, n in ((counts(spark), 7), (counts(spark, "NOGENE"), 5)):
        assert all(r["umi"] == r["root_umi"] for r in dedup.correct_identifiers(c, n).collect())


@settings(max_examples=8, deadline=None)
@given(umis=st.dictionaries(st.text("ACGT", min_size=3, max_size=4), st.integers(1, 9), min_size=5, max_size=25))
def test_both_ways_of_correction_agree_with_a_loop(spark, umis):
    order = sorted(umis, key=lambda u: (-umis[u], u))
    roots = {}
    for u in order:
        near = [r for r in order[: order.index(u)] if roots[r] == r and sum(a != b for a, b in zip(u, r.ljust(len(u)), strict=False)) <= 1]
        roots[u] = near[0] if near else u
    c = spark.createDataFrame([("c", "b", "G", u, n) for u, n in umis.items()], "contig string, barcode string, gene string, umi string, cnt long")
    for fold in (200, 0):
        assert {r["umi"]: r["root_umi"] for r in dedup.correct_identifiers(c, 5, 1, fold).collect()} == roots


# ---- saturation, matrix, density ----------------------------------------------------------


def test_saturation_of_all_reads(spark):
    rows = [("b1", "g1", "u1", 3), ("b1", "g1", "u2", 1), ("b1", "NOGENE", "u9", 2), ("b2", "g2", "u1", 2)]
    curve = saturation.saturation(spark.createDataFrame(rows, "barcode string, gene string, umi string, cnt long"), coordinates=False)
    got = {r["sample"]: r for r in curve.collect()}
    assert tuple(got[1.0])[1:] == (4, 0.5, 1)
    assert len(got) <= 11


def test_a_run_that_is_repeated_samples_the_same_reads(spark):
    rows = [(f"b{k % 3}", f"g{k % 4}", f"u{k}", 2) for k in range(40)]
    table = spark.createDataFrame(rows, "barcode string, gene string, umi string, cnt long")
    one, two = (saturation.saturation(t, coordinates=False).orderBy("sample").collect() for t in (table, table.repartition(7)))
    assert one == two


def test_matrix_of_frequent_barcodes(spark, tmp_path):
    e = spark.createDataFrame([("c1", "b1", "g1", 2), ("c2", "b1", "g1", 3), ("c1", "b2", "g1", 1)], "contig string, barcode string, gene string, umi_cnt long")
    cells, rows, cols = matrix.triplets(matrix.filtered(e, 2))
    assert [tuple(r) for r in cells.collect()] == [(1, 1, 5)]
    sinks.write_matrix(cells, rows, cols, f"{tmp_path}/m")
    assert [r[0] for r in spark.read.text(f"{tmp_path}/m/matrix.mtx").collect()][-2:] == ["1 1 1", "1 1 5"] or spark.read.text(f"{tmp_path}/m/matrix.mtx").count() == 4
    sinks.write_expression(e, f"{tmp_path}/e")
    assert sorted(r["umi_cnt"] for r in sinks.read_expression(spark, f"{tmp_path}/e").collect()) == [1, 2, 3]


def totals_of(spark, values):
    return spark.createDataFrame([(float(v),) for v in values], "total double")


def test_density_thresholds(spark):
    for few in ([], [7], [7, 7, 7], [3, 3, 5]):
        assert density.barcode_threshold(totals_of(spark, few)) == 500
    rng = np.random.default_rng(1)
    totals = np.concatenate([10 ** rng.normal(1.3, 0.15, 4000), 10 ** rng.normal(3.6, 0.15, 900)]).round()
    # the value of the same steps over all distinct totals in one array
    assert density.barcode_threshold(totals_of(spark, totals)) == pytest.approx(310.77993648224225, rel=1e-6)


def test_mass_in_cells_is_that_of_an_array(spark):
    rng = np.random.default_rng(2)
    totals = (10 ** rng.normal(2, 0.6, 3000)).round() + 1
    held, (low_x, high_x) = density.cells(totals_of(spark, totals))
    values, n = np.unique(totals, return_counts=True)
    top = values[n == n.max()].max()
    values, n = values[values > top - 3], n[values > top - 3]
    x = np.log10(values)
    assert (low_x, high_x) == pytest.approx((x.min(), x.max()))
    low, step = density.grid(low_x, high_x)
    at = (x - low) / step
    want = np.zeros(density.GRID + 1)
    np.add.at(want, at.astype(int), n / n.sum() * (1 - at % 1))
    np.add.at(want, at.astype(int) + 1, n / n.sum() * (at % 1))
    got = np.zeros(density.GRID + 1)
    for r in held.collect():
        got[r.cell] = r.mass
    assert np.allclose(got, want, atol=1e-9) and got.sum() == pytest.approx(1)


# ---- BAM and whole runs -------------------------------------------------------------------


def test_bam_reads_back(spark, tmp_path):
    bam.register(spark)
    rng = random.Random(5)
    rows = [read(k, cig="3S7M", pos=k * 3, contig=rng.choice(["chr1", "chr2", None]), hi=rng.choice([None, 1, 2]))[:10] + ("".join(rng.choice("ACGTN") for _ in range(10)), "I" * 10, None, {"XX": "v" * (k % 50)}) for k in range(3000)]
    df = spark.createDataFrame(rows, READS).repartition(3)
    df.write.format("bam").mode("append").option("contigs", "chr1:100000,chr2:50000").save(str(tmp_path / "b"))
    paths = sorted(str(p) for p in (tmp_path / "b").glob("*.bam"))
    assert bam.header(paths[0])[0] == [("chr1", 100000), ("chr2", 50000)]
    cols = ["qname", "flag", "contig", "pos", "mapq", "cigar", "seq", "qual", "hi", "tags"]
    key = lambda rs: sorted(str([r[c] for c in cols]) for r in rs)
    whole = spark.read.format("bam").load(",".join(paths)).collect()
    assert key(whole) == key(df.collect())
    split = spark.read.format("bam").option("splitBytes", "5000").load(",".join(paths)).collect()
    assert sorted((r["file_idx"], r["rec_idx"]) for r in split) == sorted((r["file_idx"], r["rec_idx"]) for r in whole)


def world(spark):
    rng = random.Random(6)
    genes = [gene(k, k * 300 + 1, k * 300 + 250, [(k * 300 + 1, k * 300 + 100), (k * 300 + 151, k * 300 + 250)], neg=k % 3 == 0) for k in range(20)]
    bases = lambda n: "".join(rng.choice("ACGT") for _ in range(n))
    reads = [read(k, cig="50M", pos=rng.randint(0, 6300), flag=rng.choice([0, 16]), mapq=rng.choice([3, 60, 255]), qname=f"r{k}|||CB:Z:1_2_{rng.randint(0, 3)}_{rng.randint(0, 300)}|||UR:Z:{bases(2)}{'N' if k % 40 == 0 else 'A'}", hi=rng.choice([None, 1, 2]), contig=rng.choice(["chr1", "chr1", "chrU"])) for k in range(800)]
    return spark.createDataFrame(reads, READS), spark.createDataFrame(genes, GENES)


@pytest.mark.parametrize("mode", [0, 1, 2])
def test_runs_by_position(spark, mode):
    reads, genes = world(spark)
    dropped = run(reads, genes, Config(mode=mode))
    flagged = run(reads, genes, Config(mode=mode, keep_low_quality=True, keep_duplicates=True))
    status = {r["status"]: r["count"] for r in flagged.reads.groupBy("status").count().collect()}
    assert dropped.reads.count() == status["keep"]
    s = one(flagged.summaries["FILTER & DEDUPLICATION METRICS"])
    assert s["total"] == sum(status.values()) and s["total"] - s["pass_filter"] == status["lowq"]
    assert s["annotated"] - s["unique"] == status.get("dup", 0)
    assert dropped.expression.agg(F.sum("umi_cnt")).first()[0] == s["unique"]


def test_runs_by_identifier(spark):
    reads, genes = world(spark)
    got = run(reads, genes, Config(umi=True, saturation=True, keep_duplicates=True, umi_min_num=2))
    assert {"UMI METRICS", "UMI MISMATCH POSITIONS", "UMI MISMATCH TYPES"} <= set(got.summaries)
    kept = got.reads.filter("status = 'keep' and ge is not null").count()
    assert got.expression.agg(F.sum("umi_cnt")).first()[0] == kept
    assert {r["sample"] for r in got.saturation.collect()} == set(saturation.LEVELS)
    text = sinks.summary_text(got.summaries)
    assert text.startswith("## UMI METRICS\nBARCODE_GENE_NUM\t")


def test_runs_with_a_matrix(spark):
    reads, genes = world(spark)
    got = run(reads, genes, Config(matrix=True, filter_matrix=False))
    assert got.matrix[0].agg(F.sum("cnt")).first()[0] == got.expression.agg(F.sum("umi_cnt")).first()[0]
    contigs = spark.createDataFrame([(0, "chr1", 9)], "contig_idx int, contig string, length long")
    places = [(r["file_idx"], r["rec_idx"]) for r in output_order(got.reads, contigs).collect()]
    assert places == sorted(places)


def test_headers_must_agree(spark):
    a = spark.createDataFrame([(0, "x", 1)], "contig_idx int, contig string, length long")
    filters.same_contigs([a, a])
    with pytest.raises(ValueError):
        filters.same_contigs([a, a.withColumn("length", F.lit(2).cast("bigint"))])


def test_arriving_reads_count_once(spark, tmp_path):
    from siftloom.streaming import arriving

    reads, genes = world(spark)
    reads.repartition(4).write.parquet(f"{tmp_path}/in")
    stream = arriving.unique_reads(arriving.arriving(spark, f"{tmp_path}/in", READS, 2))
    q = stream.writeStream.format("memory").queryName("arrived").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    q.stop()
    batch = arriving.unique_reads(reads)
    assert spark.table("arrived").count() == batch.count()
    counted = arriving.overlap_counts(filters.with_names(reads), genes)
    assert counted.columns == ["barcode", "gene", "reads"] and counted.count() > 0


def test_identifiers_across_contigs(spark):
    reads, genes = world(spark)
    wide = run(reads, genes, Config(umi=True, scope="whole", umi_min_num=2))
    assert {r["contig"] for r in wide.expression.select("contig").distinct().collect()} == {"*"}
    assert wide.expression.agg(F.sum("umi_cnt")).first()[0] == wide.reads.filter("status = 'keep' and ge is not null").count()


def test_command_line(spark, tmp_path):
    from siftloom.__main__ import main

    reads, _ = world(spark)
    reads.write.parquet(f"{tmp_path}/reads")
    text = [x for k in range(20) for x in transcript(f"g{k}", [(k * 300 + 1, k * 300 + 100), (k * 300 + 151, k * 300 + 250)], f"E{k}", f"T{k}")]
    (tmp_path / "a.gtf").write_text("\n".join(text) + "\n")
    main(["--reads", f"{tmp_path}/reads", "--annotation", f"{tmp_path}/a.gtf", "--out", f"{tmp_path}/out", "--umi", "--saturation", "--matrix", "--no-filter-matrix"])
    assert spark.read.parquet(f"{tmp_path}/out/reads").count() > 0
    assert sinks.read_expression(spark, f"{tmp_path}/out/expression", reads=True).count() > 0
    assert spark.read.text(f"{tmp_path}/out/summary").count() > 8
    assert spark.read.text(f"{tmp_path}/out/saturation").count() == 12


def test_a_gene_of_transcripts_that_share_a_name_is_left_out(spark):
    """Names are those of a transcript's own line, or the last above; a region forgets them."""
    lines = [
        "c1\tx\tregion\t1\t999\t.\t+\t.\tID=r", "c1\tx\tgene\t1\t90\t.\t+\t.\tID=1;Name=A",
        "c1\tx\tmRNA\t1\t90\t.\t+\t.\tID=a;Name=same", "c1\tx\texon\t1\t40\t.\t+\t.\tParent=a", "c1\tx\tmRNA\t1\t90\t.\t+\t.\tID=b;Name=same", "c1\tx\texon\t50\t90\t.\t+\t.\tParent=b",
        "c1\tx\tgene\t100\t190\t.\t+\t.\tID=2;Name=B", "c1\tx\tmRNA\t100\t190\t.\t+\t.\tID=c;Name=one", "c1\tx\texon\t100\t140\t.\t+\t.\tParent=c", "c1\tx\tmRNA\t100\t190\t.\t+\t.\tID=d;Name=two", "c1\tx\texon\t150\t190\t.\t+\t.\tParent=d",
        "c1\tx\tgene\t200\t290\t.\t+\t.\tID=3;Name=C", "c1\tx\tmRNA\t200\t290\t.\t+\t.\tID=e;Name=three", "c1\tx\texon\t200\t240\t.\t+\t.\tParent=e", "c1\tx\tmRNA\t200\t290\t.\t+\t.\tID=f", "c1\tx\texon\t250\t290\t.\t+\t.\tParent=f",
    ]
    rows = annotation.gff(spark.createDataFrame(list(enumerate(lines)), "line_no long, value string"))
    assert {r.gene_name for r in genemodel.repeated_names(genemodel.contig_runs(rows)).collect()} == {"A", "C"}
    assert {r.gene_name: r.name_repeated for r in genemodel.validation(rows).collect()} == {"A": 1, "B": 0, "C": 1}
    assert [r.gene_name for r in genemodel.gene_model(rows).collect()] == ["B"]


@pytest.mark.parametrize("mode", [0, 1, 2])
def test_genes_as_lists_are_as_genes_in_rows(spark, mode):
    """Reads get their genes as a list and no pair is sent; reads longer than a bin, and lists that are
    shuffled, tell the same as aggregates of rows."""
    rng = random.Random(mode)
    genes = [gene(k, s, s + 900, [(s, s + 200), (s + 500, s + 900)]) for k in range(60) for s in [rng.randrange(1, 30_000)]]
    reads = [read(k, cig=rng.choice(["100M", "50M200N50M", "30M1000N70M", "40M9000N60M"]), pos=rng.randrange(0, 30_000), flag=rng.choice([0, 16])) for k in range(200)]
    r, g = spark.createDataFrame(reads, READS), spark.createDataFrame(genes, GENES)
    rows = {x["rec_idx"]: x for x in (assign.rule0, assign.rule1, assign.rule2)[mode](assign.gene_rows(r, g, mode)).collect()}
    told = ("xf", "ge", "gs", "right", "wrong", "fixed", "rejected", "f")
    for broadcast in (None, True, False):
        got = assign.annotate(r, g, mode, broadcast)
        held = {x["rec_idx"]: x for x in got.collect()}
        assert len(held) == len(reads)
        for k, x in held.items():
            assert x["nogene"] == (k not in rows)
            assert k not in rows or [x[c] for c in told] == [rows[k][c] for c in told]
    short = assign.annotate(r.filter("cigar = '100M'"), g, mode)
    plan = short._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in plan.split("BroadcastExchange")[0] and "Exchange hashpartitioning(file_idx" not in plan


def test_a_name_is_split_once(spark):
    named = filters.with_names(spark.createDataFrame([read(1)], READS))
    assert named._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1


@pytest.mark.parametrize("mode", [0, 1, 2])
@pytest.mark.parametrize("way", ["broadcast", "shuffled", "often"])
def test_places_are_annotated_once(spark, monkeypatch, mode, way):
    """Reads of one place and strand are told what one of them is, whatever else they hold; genes are looked at
    by place only."""
    rng = random.Random(mode)
    genes = [gene(k, s, s + 900, [(s, s + 200), (s + 500, s + 900)], neg=k % 2 == 0) for k in range(20) for s in [rng.randrange(1, 9000)]]
    places = [(rng.choice(["100M", "50M200N50M", "40M9000N60M", "*", None]), rng.randrange(0, 9000), rng.choice([0, 16]), rng.choice(["chr1", "chr1", "chr2", None])) for _ in range(30)]
    reads = []
    for k in range(300):
        cig, pos, flag, contig = places[min(rng.randrange(40), 29)]
        reads.append(read(k, cig=cig, pos=pos, flag=flag | rng.choice([0, 1, 1024]), contig=contig, mapq=rng.choice([3, 255])))
    r, g = spark.createDataFrame(reads, READS), spark.createDataFrame(genes, GENES)
    want = assign._annotated(r, g, mode, None)
    if way != "broadcast":
        monkeypatch.setattr(assign, "BROADCAST_BYTES", 0)
    if way == "often":
        monkeypatch.setattr(assign, "OFTEN", 20)
    got = assign.annotate(r, g, mode)
    assert got.columns == want.columns and "lambda" not in got._jdf.queryExecution().optimizedPlan().toString()
    by_id = lambda df: sorted((tuple(str(v) for v in x) for x in df.collect()), key=lambda x: int(x[1]))
    assert by_id(got) == by_id(want)


@pytest.mark.parametrize("keep", [True, False])
@pytest.mark.parametrize("scope", ["contig", "whole"])
def test_firsts_meet_their_roots_in_one_pass(spark, keep, scope):
    rng = random.Random(4)
    rows = [(0, k, rng.choice([0, 16]), rng.choice(["c1", "c2"]), f"b{rng.randrange(2)}", f"g{rng.randrange(2)}", "".join(rng.choice("ACGT") for _ in range(3))) for k in range(400)]
    reads = spark.createDataFrame(rows, "file_idx int, rec_idx long, flag int, contig string, cb string, ge string, ur string")
    roots = dedup.correct_identifiers(dedup.identifier_counts(reads, scope), 5, 1)
    firsts = dedup.by_identifier(reads, keep, scope)
    want = dedup.by_corrected(firsts.filter("status = 'keep'"), roots, keep, scope)
    if keep:
        want = want.unionByName(firsts.filter("status = 'dup'"), allowMissingColumns=True)
    got = dedup.by_both(reads, roots, keep, scope)
    told = lambda df: {tuple(x) for x in df.select("rec_idx", "status", "flag", "ub", "cluster_cnt").collect()}
    assert told(got) == told(want) and got.count() == want.count() and set(got.columns) == set(want.columns)
