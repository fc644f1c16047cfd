"""Piece ids against the library; manifest and audit against plain Python."""

import hashlib
import random
import zlib
from itertools import permutations

import pytest
from pyspark.sql import functions as F

from siftloom.llm import queries
from siftloom.llm.audit import filter_audit
from siftloom.llm.merkle import manifest, merkle_proofs
from siftloom.llm.pieces import decode_pieces, encode_pieces, round_trip

public_tokenizers = pytest.importorskip("public_tokenizers")

ODD = [None, "", " ", "  a", "a  b   ", "\n\n", "▁", "▁a ▁▁b", "日本語 テスト", "\x00a", "a\tb\r\n c", "</s> <s> <unk> <0x41>", "é ﬁ Ⅳ", "a" * 3000, " " * 50 + "x" + " " * 33, "😀" * 40, "x\n y\n  z", "ab " * 40_000]


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def odd_texts():
    rnd = random.Random(1)
    return ODD + ["".join(rnd.choice("ab ▁\n\té日😀<>s/0x‍﻿.") for _ in range(rnd.randrange(60))) for _ in range(1500)]


def test_pieces_are_the_librarys(spark, docs, library):
    table = docs(odd_texts()).withColumn("ids", F.lit("clash"))
    got = round_trip(table).collect()
    texts = {r.doc_id: r.text for r in table.collect()}
    assert len(got) == len(texts)
    for r in got:
        want = [*library.encode(texts[r.doc_id] or ""), library.eos_id()]
        assert list(r.ids) == want
        assert r.decoded == library.decode(want)


def test_pieces_op_over_its_table(spark, data, library):
    got = {r.doc_id: r for r in queries.op11_pieces(spark, data).collect()}
    rows = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = [*library.encode(r.text or ""), library.eos_id()]
        said = library.decode(ids)
        want = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(said.encode()).hexdigest())
        assert tuple(got[r.doc_id])[1:] == want


def test_any_ids_decode_as_the_library_does(spark, library):
    rnd = random.Random(2)
    lists = [[rnd.choice([rnd.randrange(32_000), rnd.randrange(3, 259), 1, 2, 0]) for _ in range(rnd.randrange(12))] for _ in range(3000)]
    rows = [(k, ids) for k, ids in enumerate(lists)] + [(-1, None)]
    got = {r.k: r.text for r in decode_pieces(spark.createDataFrame(rows, "k int, ids array<int>")).collect()}
    assert got.pop(-1) is None
    assert got == {k: library.decode(ids) for k, ids in enumerate(lists)}
    with pytest.raises(Exception, match="outside the vocabulary"):
        decode_pieces(spark.createDataFrame([(0, [32_000])], "k int, ids array<int>")).collect()


def test_pieces_of_an_empty_table(docs):
    assert encode_pieces(docs([])).columns == ["doc_id", "lang", "source", "n_chars", "ids"]
    assert round_trip(docs([])).count() == 0


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = [row.doc_id, row.source, row.lang, row.n_chars, text]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def plain_manifest(rows):
    """Row -> (doc_id, leaf, subroot, root, proof, folded, verified) by building the tree in lists."""

    def tree(nodes):
        found = [nodes]
        while len(found[-1]) > 1:
            last = found[-1]
            found.append([h(*last[k : k + 3]) for k in range(0, len(last), 3)])
        return found

    def walk(built, place, digest):
        sib = []
        for level in built[:-1]:
            run = place - place % 3
            beside = level[run : run + 3]
            sib += beside[: place % 3] + beside[place % 3 + 1 :]
            digest = h(*beside[: place % 3], digest, *beside[place % 3 + 1 :])
            place //= 3
        return sib, digest

    groups = {}
    for r in rows:
        groups.setdefault(r.source, []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made, out = {}, []
    for s in names:
        groups[s].sort(key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text)))
        made[s] = tree([leaf(r, r.text) for r in groups[s]])
    top = tree([made[s][-1][0] for s in names])
    for at, s in enumerate(names):
        for k, r in enumerate(groups[s]):
            even = zlib.crc32(b"" if r.doc_id is None else str(r.doc_id).encode()) % 2 == 0
            again = leaf(r, r.text.replace("\n", "") if even and r.text is not None else r.text)
            one, sub = walk(made[s], k, again)
            two, root = walk(top, at, sub)
            out.append((r.doc_id, made[s][0][k], made[s][-1][0], top[-1][0], h(*one, *two), root, root == top[-1][0]))
    return out


def same(got, want):
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_manifest_of_odd_rows(docs):
    rows = [(k, f"text {k}\nline" if k % 3 else f"text {k}", "en", f"s{k % 4}") for k in range(60)]
    rows += [(None, "a\nb", None, None), (None, "", "en", None), (7, None, "en", None), (7, None, "en", None), (8, "é\n😀", "fr", "É"), (9, "-", "en", "")]
    rows += [(3, "again\n", "en", "hot")] * 5 + [(2**53 + k, "x" * 200_000 + "\n", "en", "hot") for k in range(800)]
    table = docs(rows).withColumn("digest", F.lit("clash")).withColumn("root", F.lit(1))
    got = manifest(table.repartition(7)).collect()
    want = plain_manifest(table.collect())
    same(got, want)
    assert 0 < sum(r.verified for r in got) < len(got)


def test_manifest_of_few_rows(docs):
    assert manifest(docs([])).count() == 0
    (one,) = manifest(docs(["alone"])).collect()
    assert one.leaf == one.subroot == one.root == one.folded_root
    assert one.proof_sha256 == h()


@pytest.mark.parametrize("n", [3, 4, 81, 243, 244, 730])
def test_manifest_at_the_edges_of_a_block(docs, n):
    table = docs([(k, f"t{k}\n", "en", "s") for k in range(n)])
    same(manifest(table).collect(), plain_manifest(table.collect()))


def test_paths_hold_every_ancestor(spark):
    rows = spark.range(1000).select(F.lit("g").alias("g"), "id", F.sha2(F.col("id").cast("string").cast("binary"), 256).alias("digest"))
    got = merkle_proofs(rows, "g", ["id"]).collect()
    assert {len(r.steps) for r in got} == {7}
    for r in got[:50]:
        for k, step in enumerate(r.steps):
            assert step.at == r.id // 3**k % 3
        assert r.steps[0].pre[64 * r.steps[0].at :][:64] == r.digest
        assert h(r.steps[-1].pre) == r.root


def test_manifest_op_over_its_table(spark, data):
    same(queries.op12_merkle_manifest(spark, data).collect(), plain_manifest(spark.read.parquet(f"{data}/documents.parquet").collect()))


def plain_audit(rows, labels):
    import re

    good, toxic = ({r[0] for r in labels if r[1 + k] == 1 and r[0] is not None} for k in range(2))
    smallest = {}
    for r in rows:
        if r.doc_id is not None:
            smallest[r.text or ""] = min(smallest.get(r.text or "", r.doc_id), r.doc_id)
    parts = {}
    for r in rows:
        t = r.text or ""
        words = re.findall("[^\x20\x09-\x0d]+", t)
        fails = {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t)}
        fails |= {"D": bool(re.search("[#$%&*|]", t)), "E": r.doc_id is not None and smallest[t] < r.doc_id}
        parts.setdefault(r.source or "", []).append(({f for f in fails if fails[f]}, r.doc_id in good, r.doc_id in toxic))
    out = []
    for part, found in parts.items():
        steps, total = [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = found
            for k, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                total[f] += len(gone)
                fail = [d for d in found if f in d[0]]
                steps.append((f, (part, "".join(order), k, len(left), len(gone), len(fail) - len(gone), sum(d[0] == {f} for d in fail), sum(d[1] for d in gone), sum(d[2] for d in gone))))
        out += [(*row, total[f]) for f, row in steps]
    return out


LABELS = "doc_id long, quality int, toxic int"


def test_audit_of_odd_rows(spark, docs):
    rnd = random.Random(3)
    pool = ["", None, "few words", "ABC def " * 30, "one $ two " * 10, " ".join(f"w{k}" for k in range(60)), " ".join(f"w{k}" for k in range(60)) + " #", "\n\t x", "É" * 70, "W " * 200_000]
    rows = [(rnd.choice([None, *range(40), 2**53 + 1, 2**53 + 2]), rnd.choice(pool), "en", rnd.choice(["a", "b", None, ""])) for _ in range(400)]
    rows += [rows[0]] * 3
    table = docs(rows).withColumn("n", F.lit(5)).withColumn("part", F.lit("clash"))
    labels = [(k, rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for k in range(0, 40, 2)] + [(2, 1, 1), (2, 0, 0), (None, 1, 1)]
    got = filter_audit(table.repartition(5), spark.createDataFrame(labels, LABELS)).collect()
    same(got, plain_audit(table.collect(), labels))
    assert len(got) == 3 * 600


def test_audit_of_nothing(spark, docs):
    assert filter_audit(docs([]), spark.createDataFrame([], LABELS)).count() == 0
    got = filter_audit(docs([None]), spark.createDataFrame([], LABELS)).collect()
    assert len(got) == 600
    assert {r.removed for r in got if r.filter_order[r.step - 1] == "A"} == {1}


def test_audit_op_over_its_table(spark, data):
    rows = spark.read.parquet(f"{data}/documents.parquet").collect()
    labels = [tuple(r) for r in spark.read.parquet(f"{data}/labels.parquet").select("doc_id", "quality", "toxic").collect()]
    same(queries.op13_filter_audit(spark, data).collect(), plain_audit(rows, labels))
