"""The BAM source: decoding by column, pushed conditions, ranges read, and commits."""

import random
import struct

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In, LessThan

from siftloom.functions import cigar
from siftloom.operators import filters
from siftloom.schemas import READS
from siftloom.sources import bam, bamcodec

CONTIGS = [("chr1", 5_000_000), ("chr2", 5_000_000), ("chrU", 1000)]


def rows(n, seed=1, start=0):
    rng = random.Random(seed)
    out = []
    for k in range(n):
        size = rng.choice([0, 1, 7, 50, 51])
        seq = "".join(rng.choice("ACGTN=") for _ in range(size)) or "*"
        qual = "*" if seq == "*" or rng.random() < 0.1 else "".join(chr(33 + rng.randrange(94)) for _ in range(size))
        tags = {t: "v" * rng.randrange(40) for t in rng.sample(["XX", "CB", "UR", "Zq"], rng.randrange(4))}
        out.append((0, start + k, f"r{start + k}" + "n" * rng.randrange(20), rng.choice([0, 16, 1040]), rng.choice(["chr1", "chr1", "chr2", None]), rng.randrange(5_000_000), rng.choice([0, 3, 60, 255]), rng.choice(["*", "50M", "3S7M", "10M200N5M2I3D1M"]), rng.randrange(-1, 300), rng.randrange(-500, 500), seq, qual, rng.choice([None, 1, 2]), tags))
    return out


def write_file(path, records, by_place, blocks=9000):
    """A file of one sorted or unsorted run of rows, in small blocks that records cross."""
    text = f"@HD\tVN:1.6\tSO:{'coordinate' if by_place else 'unsorted'}\n"
    data = b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(CONTIGS))
    data += b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in CONTIGS)
    index = {c: k for k, (c, _) in enumerate(CONTIGS)}
    if by_place:
        records = sorted(records, key=lambda r: (index.get(r[4], 99), r[5]))
    made = type("Row", (), {})
    for r in records:
        row = made()
        row.__dict__.update(zip(READS.names, r, strict=True))
        data += bamcodec.packed(row, index)
    with open(path, "wb") as f:
        for k in range(0, len(data), blocks):
            f.write(bamcodec.compressed(data[k : k + blocks]))
        f.write(bamcodec.EOF_BLOCK)


def plain(batches):
    return [tuple(r.values()) for b in batches for r in b.to_pylist()]


def essence(r):
    return (*r[2:13], tuple(sorted(dict(r[13]).items())))


@pytest.mark.parametrize("by_place", [False, True])
@pytest.mark.parametrize("split", [700, 5000, 20_000, 1 << 26])
def test_splits_of_all_sizes_read_every_record_once(tmp_path, by_place, split):
    made = rows(1500)
    write_file(tmp_path / "a.bam", made, by_place)
    reader = bam.BamReader({"path": str(tmp_path / "a.bam"), "splitBytes": str(split)})
    got = [r for part in reader.partitions() for r in plain(reader.read(part))]
    assert sorted(map(str, map(essence, got))) == sorted(map(str, map(essence, made)))
    assert len({r[1] for r in got}) == len(got)
    assert [r[1] for r in got] == sorted(r[1] for r in got)


def test_every_kind_of_tag(tmp_path):
    """Tags that the writer does not make, as text; of a repeated tag the last; a record longer than a block."""
    tags = b"NHC\x02" + b"XAAq" + b"XcC" + bytes([200]) + b"Xdc\xff" + b"Xes" + struct.pack("<h", -3) + b"XfS" + struct.pack("<H", 40_000) + b"XgI" + struct.pack("<I", 3_000_000_000) + b"Xif" + struct.pack("<f", 0.5) + b"XjH1F\0" + b"XkBs" + struct.pack("<ihh", 2, -1, 5) + b"HIi" + struct.pack("<i", 2) + b"NHC\x07"
    body = bamcodec.FIXED.pack(0, 5, 2, 60, 4680, 0, 0, 0, 0, 0, 0) + b"q\0" + tags
    long = bamcodec.FIXED.pack(-1, -1, 2, 0, 4680, 0, 4, 0, -1, -1, 0) + b"p\0" + b"XXZ" + b"y" * 50_000 + b"\0"
    head = b"BAM\1" + struct.pack("<ii", 0, 1) + struct.pack("<i", 5) + b"chr1\0" + struct.pack("<i", 100)
    data = head + b"".join(struct.pack("<i", len(b)) + b for b in (body, long, body))
    (tmp_path / "t.bam").write_bytes(b"".join(bamcodec.compressed(data[k : k + 3000]) for k in range(0, len(data), 3000)) + bamcodec.EOF_BLOCK)
    reader = bam.BamReader({"path": str(tmp_path / "t.bam")})
    a, b, c = [r for part in reader.partitions() for r in plain(reader.read(part))]
    assert a[12] == c[12] == 2 and b[12] is None and b[4] is None
    assert dict(a[13]) == {"NH": "7", "XA": "q", "Xc": "200", "Xd": "-1", "Xe": "-3", "Xf": "40000", "Xg": "3000000000", "Xi": "0.5", "Xj": "1F", "Xk": "s,-1,5"}
    assert dict(b[13]) == {"XX": "y" * 50_000}


class Counted:
    """A file that counts what is read of it."""

    def __init__(self, f, total):
        self.f, self.total = f, total

    def __enter__(self):
        self.f.__enter__()
        return self

    def __exit__(self, *a):
        return self.f.__exit__(*a)

    def read(self, n):
        got = self.f.read(n)
        self.total[0] += len(got)
        return got

    def __getattr__(self, name):
        return getattr(self.f, name)


def counting(monkeypatch):
    total, real = [0], bam._open

    class System:
        def __init__(self, system):
            self.system = system

        def open_input_file(self, path):
            return Counted(self.system.open_input_file(path), total)

        def __getattr__(self, name):
            return getattr(self.system, name)

    monkeypatch.setattr(bam, "_open", lambda path: (lambda s, p: (System(s), p))(*real(path)))
    return total


def test_a_range_of_a_sorted_file_reads_what_holds_it(tmp_path, monkeypatch):
    made = rows(40_000, seed=2)
    path = tmp_path / "s.bam"
    write_file(path, made, True, blocks=60_000)
    total = counting(monkeypatch)
    size, split = path.stat().st_size, 64 << 10

    def scan(*conditions):
        reader = bam.BamReader({"path": str(path), "splitBytes": str(split)})
        assert list(reader.pushFilters(list(conditions))) == []
        parts = reader.partitions()
        total[0] = 0
        return parts, [r for p in parts for r in plain(reader.read(p))]

    whole, everything = scan()
    assert len(everything) == len(made) and len(whole) == -(-size // split) and len(whole) > 15
    for contig, low, high in (("chr2", 1_000_000, 1_100_000), ("chr1", 0, 50_000), ("chr1", 4_990_000, 6_000_000), ("chrU", 0, 100)):
        parts, got = scan(EqualTo(("contig",), contig), GreaterThan(("pos",), low), LessThan(("pos",), high))
        want = [r for r in everything if r[4] == contig and low < r[5] < high]
        assert got == want
        assert len(parts) <= 3
        assert total[0] < 6 * (split + (1 << 17))
    parts, got = scan(In(("contig",), ("chr2", "chrU", "none")))
    assert got == [r for r in everything if r[4] == "chr2"]
    assert len(parts) < 0.5 * len(whole)
    assert scan(EqualTo(("contig",), "none")) == ([], [])


def test_pushed_scans_are_the_unpushed_ones(spark, tmp_path):
    made = rows(6000, seed=3)
    write_file(tmp_path / "a.bam", made[:3000], True)
    write_file(tmp_path / "b.bam", made[3000:], False)
    bam.register(spark)
    paths = f"{tmp_path}/a.bam,{tmp_path}/b.bam"
    all_rows = spark.read.format("bam").load(paths).collect()
    assert len(all_rows) == 6000
    length = cigar.reference_length(cigar.operations(F.col("cigar")))
    for split in ("9000", "40000", "100000000"):
        reads = spark.read.format("bam").option("splitBytes", split).load(paths)
        scans = (reads.filter("contig = 'chr2' and pos >= 1000 and pos < 2000000 and mapq > 3"), filters.in_range(reads, "chr1", 2_000_000, 2_400_000, length, longest=300), filters.on_contig(reads, "chr2"))
        tests = (lambda r: r.contig == "chr2" and 1000 <= r.pos < 2_000_000 and r.mapq > 3, lambda r: r.contig == "chr1" and r.pos < 2_400_000 and r.pos + {"*": 0, "50M": 50, "3S7M": 7, "10M200N5M2I3D1M": 219}[r.cigar] > 2_000_000, lambda r: r.contig == "chr2")
        for scan, test in zip(scans, tests, strict=True):
            assert sorted(map(str, scan.collect())) == sorted(str(r) for r in all_rows if test(r))
    plan = reads.filter("contig = 'chr2' and pos < 2000")._jdf.queryExecution().executedPlan().toString()
    assert " Filter " not in plan


def test_only_named_columns_are_decoded(spark, tmp_path, monkeypatch):
    made = rows(300, seed=4)
    write_file(tmp_path / "a.bam", made, True)
    bam.register(spark)
    got = spark.read.format("bam").schema("contig string, pos int").load(str(tmp_path / "a.bam")).collect()
    assert sorted(map(str, got)) == sorted(f"Row(contig={r[4]!r}, pos={r[5]})" for r in made)
    with pytest.raises(Exception, match="no column"):
        spark.read.format("bam").schema("place int").load(str(tmp_path / "a.bam")).collect()


def test_contig_table(spark, tmp_path):
    for name in "ab":
        write_file(tmp_path / f"{name}.bam", [], True)
    got = bam.contigs(spark, f"{tmp_path}/a.bam,{tmp_path}/b.bam")
    assert [tuple(r) for r in got.orderBy("contig_idx").collect()] == [(k, c, n) for k, (c, n) in enumerate(CONTIGS)]


def test_a_failed_write_leaves_nothing_and_a_retried_one_no_copies(spark, tmp_path):
    bam.register(spark)
    out = tmp_path / "out"
    df = spark.createDataFrame(rows(400, seed=5), READS).repartition(4)
    broken = df.withColumn("pos", F.when(F.spark_partition_id() == 2, F.lit(None)).otherwise(F.col("pos")))
    opts = {"contigs": ",".join(f"{c}:{n}" for c, n in CONTIGS)}
    with pytest.raises(Exception):  # noqa: B017
        broken.write.format("bam").mode("append").options(**opts).save(str(out))
    assert not list(out.rglob("*.bam")) and not list(out.glob("_attempts*"))
    df.write.format("bam").mode("append").options(**opts).save(str(out))
    files = sorted(map(str, out.glob("*.bam")))
    assert len(files) == 4 and not list(out.glob("_attempts*"))
    assert spark.read.format("bam").load(",".join(files)).count() == 400
    df.write.format("bam").mode("append").options(**opts).save(str(out))
    files = sorted(map(str, out.glob("*.bam")))
    assert spark.read.format("bam").load(",".join(files)).count() == 800
    df.write.format("bam").mode("overwrite").options(**opts).save(str(out))
    files = sorted(map(str, out.glob("*.bam")))
    assert spark.read.format("bam").load(",".join(files)).count() == 400


def test_commit_takes_one_attempt_of_each_task(tmp_path):
    """As when a task is lost after it has written, and runs again."""
    writer = bam.BamWriter({"path": str(tmp_path / "out"), "contigs": "chr1:100"})
    _, _, attempts = writer._folders()
    (tmp_path / "out").mkdir()
    for name in ("00000-1.bam", "00000-7.bam", "00001-2.bam"):
        p = tmp_path / "out" / attempts.rpartition("/")[2]
        p.mkdir(exist_ok=True)
        (p / name).write_bytes(name.encode())
    writer.commit([bam.Written("00000-7.bam", 0), bam.Written("00001-2.bam", 1)])
    left = sorted((tmp_path / "out").rglob("*.bam"))
    assert [p.read_text() for p in left] == ["00000-7.bam", "00001-2.bam"]
