import random
from collections import Counter
from fractions import Fraction

import corpus_pipeline as pipe
import pytest
from test_text_ops import _brute_groups, _brute_lines

from siftloom.llm import mixing

WORDS = {"en": "the of and that with it for was on are", "fr": "les une dans être où des que pour sur pas", "de": "der und nicht für ist das ein mit auf von"}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    shared = [" ".join(rng.choice(WORDS["en"].split()) + str(rng.randrange(99)) for _ in range(12)) for _ in range(5)]
    out = []
    for k in range(240):
        lang = rng.choice([*WORDS])
        text = "\n".join(" ".join(rng.choice(WORDS[lang].split()) + rng.choice("abcdef") * rng.randrange(3) for _ in range(30)) for _ in range(rng.randint(1, 3)))
        out.append((k, text + (f"\n{rng.choice(shared)}" if k % 7 == 0 else ""), lang, rng.choice(["hot", "hot", "b", None])))
    out += [(300 + k, out[k][1] + " more", "en", "b") for k in range(20)]  # near copies
    out += [(400, None, None, "b"), (401, "", "en", "b"), (402, "12 ?!", "en", "hot"), (None, out[1][1] + " no id here", "en", "b"), out[3], (403, out[5][1].split("\n")[0], "en", "b")]
    return out


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    top = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{top}/documents.parquet")
    return top


@pytest.fixture(scope="module")
def steps(spark, folder):
    """What each stage returns on what the one before it kept."""
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), []
    for k, (_, stage) in enumerate(pipe.STAGES):
        stage(spark, docs, folder).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
        out.append([r.asDict() for r in docs.collect()])
        if k < 4:
            assert docs.columns == pipe.COLUMNS
    return out


def _key(r):
    return (r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "")


def test_language_rejects_what_has_no_letters(rows, steps):
    kept = Counter(r["doc_id"] for r in steps[0])
    assert kept == Counter(r[0] for r in rows if r[0] not in (400, 401, 402))


def test_lines_are_those_of_brute_force(steps):
    before = sorted(steps[0], key=_key)
    own = [(k, r["text"]) for k, r in enumerate(before)]
    # the repeated row is one document with its first
    first = {}
    want = _brute_lines([(first.setdefault((r["doc_id"], r["text"]), k), r["text"]) for k, r in enumerate(before) if (r["doc_id"], r["text"]) not in first or r["doc_id"] is None])
    expected = Counter((r["doc_id"], want[first.get((r["doc_id"], r["text"]), k)]) for k, r in enumerate(before))
    expected = Counter({k: n for k, n in expected.items() if k[1].split()})
    assert len(own) == len(before)
    assert Counter((r["doc_id"], r["text"]) for r in steps[1]) == expected
    assert all(r["n_chars"] == len(r["text"]) for r in steps[1])


def test_one_of_each_group_stays(steps):
    with_id = [(r["doc_id"], r["text"]) for r in steps[1] if r["doc_id"] is not None]
    groups = _brute_groups(with_id, 5, Fraction(8, 10))
    assert sorted(r["doc_id"] for r in steps[2] if r["doc_id"] is not None) == sorted({c for _, c in groups.values()})
    assert sum(r["doc_id"] is None for r in steps[2]) == 1


def test_rows_that_share_an_id_or_have_none(spark, docs, folder):
    a, b, c, d, e = (" ".join(f"{x}{k}" for k in range(40)) for x in "abcde")
    # shared id with other texts; repeats, near ones too, under null and other ids; whole repeats; no words
    given = [(1, a), (1, b), (4, b + " more"), (None, c), (None, c + " more"), (None, c), (2, d), (2, d), (None, e), (None, ""), (None, " "), (3, "")]
    got = Counter((r["doc_id"], r["text"][:2]) for r in pipe.similar(spark, docs(given), folder).collect())
    assert got == Counter([(1, "a0"), (1, "b0"), (None, "c0"), (2, "d0"), (None, "e0"), (None, ""), (None, " "), (3, "")])


def test_mixture_comes_near_its_targets(steps):
    size = lambda r: len(r["text"].split())
    sizes, taken = Counter(), Counter()
    for r in steps[2]:
        sizes[r["source"]] += size(r)
    for r in steps[3]:
        taken[r["source"]] += size(r)
    goal = mixing.targets(dict(sizes))
    assert all(abs(taken[s] - goal[s]) <= 100 for s in sizes)
    assert max(Counter((r["doc_id"], r["text"]) for r in steps[3]).values()) <= 2


def test_all_taken_documents_are_packed(spark, folder, steps):
    assert Counter(r["doc_id"] for r in steps[4] if r["piece"] == 0) == Counter(r["doc_id"] for r in steps[3])
    end = {}
    for r in sorted(steps[4], key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == end.get(r["sequence_id"], 0)
        end[r["sequence_id"]] = r["offset"] + r["length"]
    assert max(end.values()) <= 2048
    whole = pipe.run(spark, folder)
    key = lambda r: (r["doc_id"] or -1, r["piece"], r["start"], r["length"], r["ids_crc32"])
    assert sorted(map(key, whole.collect())) == sorted(map(key, steps[4]))


def test_an_empty_table_runs_through(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    assert pipe.run(spark, str(tmp_path)).count() == 0
