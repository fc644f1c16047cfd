import hashlib
import random
import re
import time
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftloom.llm import chat, exactdedup, jaccard, langid, linededup, lm, mixing, quality
from siftloom.llm.common import cut, maybe_broadcast
from siftloom.llm.components import components


# ---- language id --------------------------------------------------------------------------

WORDS = {"en": "the of and that with", "fr": "les une dans être où", "de": "der und nicht für ist"}


@pytest.fixture(scope="module")
def speech():
    rng = random.Random(1)
    return [(k, " ".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randint(3, 40))), lang) for k, lang in enumerate(random.Random(2).choices([*WORDS], k=300))]


def test_language_of_held_out_texts(spark, docs, speech):
    table = docs([*speech, (900, "the the", None), (901, None, "fr")])
    model = langid.fit(table, train=F.col("doc_id") % 5 != 0)
    assert model.langs == ["de", "en", "fr"]
    assert (model.weights == 0).mean() > 0.9
    got = langid.predict(table.filter("doc_id % 5 = 0").withColumnRenamed("n_chars", "score"), model).collect()
    told = [r for r in got if r["text"] is not None and r["lang"] is not None]
    assert np.mean([r["lang_pred"] == r["lang"] for r in told]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_of_odd_texts(spark, docs, speech):
    model = langid.fit(docs(speech))
    odd = docs([None, "", "12 34 !!", "\n", "der und " * 200_000, "é"])
    got = [r["lang_pred"] for r in langid.predict(odd, model).orderBy("doc_id").collect()]
    assert got[:5] == ["und", "und", "und", "und", "de"]
    assert langid.predict(docs([]), model).count() == 0
    nothing = langid.fit(docs([]))
    assert langid.predict(docs(["the"]), nothing).first()["lang_pred"] == "und"


@given(st.lists(st.sampled_from(["a", "É", " ", "12", "\n", "Σ", "ς", "ß", "İ", "梦", "...", "th"]), max_size=60).map("".join), st.integers(1, 9))
@settings(max_examples=200, deadline=None)
def test_long_texts_have_the_same_features_in_parts(text, step):
    if text:
        whole, parts = langid.features(text), langid.features(text, step)
        assert (whole is None) == (parts is None)
        assert whole is None or (whole == parts).all()


def test_features_are_counts_of_ngrams():
    # edge, a, b, edge: four n-grams of one, three of two, two of three
    assert langid.features("Ab").sum() == langid.features("1 ab !!").sum() == 4 + 3 + 2
    text = "Être ou ne pas être, " * 20_000
    assert len(text) > langid.STEP
    assert (langid.features(text) == langid.features(text, len(text))).all()


def test_many_languages_are_learned_and_copies_do_not_crowd_out_others(spark, docs, monkeypatch):
    rng = random.Random(8)
    letters = [chr(0x4E00 + k) for k in range(230)]
    rows = [(k, letters[k % 230] * 3 + " " + "".join(rng.choice(letters[k % 230]) for _ in range(8)) + chr(0x61 + k // 230), f"l{k % 230:03}") for k in range(230 * 4)]
    model = langid.fit(docs(rows))
    assert len(model.langs) == 230
    got = langid.predict(docs(rows[:230]), model).select("lang", "lang_pred").collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.9
    hot = docs([(k, "same text all over", "x") for k in range(500)] + [(1000 + k, f"other {'abcdefghij'[k]} text", "x") for k in range(10)] + [(2000, "der und nicht", "y")])
    picked, sizes = langid._sample(hot.select(F.col("text").alias("_text"), F.col("lang").alias("_lang")), 5)
    found = picked.collect()
    assert [(r["_lang"], r["rows"], r["texts"]) for r in sizes] == [("x", 510, 11), ("y", 1, 1)]
    assert Counter(r["_lang"] for r in found) == {"x": 5, "y": 1}
    assert len({r["_text"] for r in found}) == 6
    monkeypatch.setattr(langid, "MOST_LANGS", 1)
    with pytest.raises(ValueError, match="more than 1 languages"):
        langid.fit(hot)


# ---- language model -----------------------------------------------------------------------


def test_scores_match_counts_and_learn_context(spark, docs):
    import math

    rng = random.Random(3)
    rows = [" ".join(rng.choice(("red green blue", "one two three")).split() * rng.randint(2, 9)) for _ in range(300)] + ["Une ÉTÉ unseen" + "x" * 100, None, ""]
    table = docs(rows)
    got = {r["doc_id"]: r for r in lm.lm_scores(table, train=F.col("doc_id") % 4 != 0).collect()}
    tokens = [(x or "").encode().lower().split() + [b""] for x in rows]
    c = Counter(w for k, t in enumerate(tokens) if k % 4 for w in t)
    n, v = sum(c.values()), len(c)
    for k, t in enumerate(tokens):
        r = got[k]
        assert r["base_score"] == pytest.approx(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), rel=1e-9)
        assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["held_out"]) == (len(t), sum(c[w] > 0 for w in t), n, k % 4 == 0)
    assert sum(r["score"] for k, r in got.items() if r["held_out"]) > sum(r["base_score"] for k, r in got.items() if r["held_out"])


def test_scores_are_those_of_the_parameters(spark, docs):
    """Every score from the trained parameters by plain sums: softmax over all outputs, then a word's share
    of its class."""
    import math

    rng = random.Random(8)
    names = [f"w{k}" for k in range(1500)]
    texts = [" ".join(rng.choices(names, weights=[1 / (k + 1) for k in range(1500)], k=rng.randrange(30))) for _ in range(400)] + ["", None, "unknownword w1", "W1 été"]
    table, train = docs(texts), F.col("doc_id") % 3 != 0
    got = {r["doc_id"]: r["score"] for r in lm.lm_scores(table, train).collect()}
    frame = table.filter(train).select(F.col("doc_id").alias("_key"), F.col("text").alias("_text"))
    counts = lm.gather(frame)
    model = lm.train_model(frame, counts)
    c = {r["word"]: r["c"] for r in counts.words.collect()}
    place = {w: k for k, w in enumerate(counts.head.to_pylist()[: lm.WORDS])}
    context, target, scale, bias = model.parts
    for k in [*range(0, 400, 23), 400, 401, 402, 403]:
        words = [w.decode() for w in (texts[k] or "").encode().lower().split()]
        out = [place[w] if w in place else lm.WORDS + zlib.crc32(w[-3:].encode()) % lm.CLASSES for w in words] + [lm.END]
        seen, total = [lm.START] * lm.CONTEXT, 0.0
        for i, o in enumerate(out):
            q = sum(context[seen[-1 - j]].astype(float) * scale[j] for j in range(lm.CONTEXT))
            s = target.astype(float) @ q + bias
            total += s[o] - s.max() - math.log(np.exp(s - s.max()).sum())
            if lm.WORDS <= o < lm.END:
                total += math.log((c.get(words[i], 0) + 0.5) / counts.class_mass[o - lm.WORDS])
            seen.append(o)
        assert got[k] == pytest.approx(total / math.log(10), rel=1e-4, abs=1e-4)


def test_what_is_learned_does_not_depend_on_the_split(spark):
    """The gain over the base on held-out documents is the same in 4 and in 64 partitions."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    gain = []
    for n in (4, 64):
        r = lm.lm_scores(table.repartition(n), F.col("doc_id") % 5 != 1).filter("held_out").agg(F.sum("score") - F.sum("base_score"), F.sum("n_tokens")).first()
        gain.append(r[0] / r[1])
    assert gain[0] > 0.02 and gain[1] == pytest.approx(gain[0], rel=1e-3)
    assert [lm.shards(n) for n in (0, 10**6, 5 * 10**6, 10**9, 10**12)] == [1, 1, 2, 64, 7812]


def test_probabilities_of_all_outputs_sum_to_one():
    model = lm.LogBilinear(np.full(lm.END + 1, 1 / (lm.END + 1)))
    whole = np.full(lm.CONTEXT + 1, lm.START, dtype=np.int16)
    total = 0.0
    for w in range(lm.END + 1):
        whole[-1] = w
        total += float(np.exp(model.log_probs(whole, np.array([lm.CONTEXT]))[0]))
    assert total == pytest.approx(1, abs=1e-4)


def test_class_expression_is_the_workers(spark):
    words = ["a", "ab", "abc", "abcd", "été", "x梦y", "tion."]
    import pyarrow as pa

    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(lm.class_of(F.col("w"))).collect()]
    assert [lm.WORDS + k for k in got] == lm.Outputs(pa.array([], pa.string())).classes(pa.array(words)).tolist()


def test_scores_of_empty_tables(spark, docs):
    assert lm.lm_scores(docs([]), train=F.lit(True)).count() == 0
    assert lm.lm_scores(docs(["a b"]), train=F.lit(False)).first()["n_known"] == 0


# ---- mixing -------------------------------------------------------------------------------


def test_targets_are_capped_and_reshared():
    t = mixing.targets({"a": 100, "b": 10, "c": 1000, None: 50}, share=1.5, weights=(5, 2, 1))
    assert sum(t.values()) == pytest.approx(1.5 * 1160)
    assert all(t[s] <= 2 * n + 1e-9 for s, n in {"a": 100, "b": 10, "c": 1000, None: 50}.items())
    assert t["a"] == 200 and t["b"] == 20


def test_mix_comes_near_its_targets(spark, docs):
    rng = random.Random(4)
    rows = [(k, " ".join(["w"] * rng.randint(0, 30)) if k % 50 else None, "en", rng.choice(["hot", "hot", "b", "c", None])) for k in range(3000)]
    got = mixing.mix(docs(rows).withColumnRenamed("n_chars", "size")).collect()
    sums, target = defaultdict(int), {}
    for r in got:
        assert r["size"] == len((rows[r["doc_id"]][1] or "").split()) and r["taken"] in (0, r["size"], 2 * r["size"])
        sums[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    assert all(abs(sums[s] - target[s]) <= 15 for s in sums)  # half a document
    again = mixing.mix(docs(rows)).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}
    times = {r["doc_id"]: r["_times"] for r in mixing.mix_rows(docs(rows).withColumnRenamed("n_chars", "target")).collect()}
    assert all(r["taken"] == r["size"] * times[r["doc_id"]] for r in got)


def test_larger_budgets_take_all_that_smaller_ones_do(spark, docs):
    rows = [(k, "a b c", "en", "s") for k in range(500)]
    base = docs(rows).select(F.col("source").alias("_source"), F.shiftrightunsigned(F.xxhash64("doc_id"), 8).alias("_hash"), F.lit(3).cast("bigint").alias("size"))
    small, large = (mixing.thresholds(base, {"s": b})["s"] for b in (300.0, 900.0))
    assert 0 < small < large < 2**56


def test_mix_of_odd_tables(spark, docs):
    assert mixing.mix(docs([])).count() == 0
    got = mixing.mix(docs([(1, None, "en", None), (1, "", "en", None)])).collect()
    assert [r["taken"] for r in got] == [0, 0]


# ---- line dedup ---------------------------------------------------------------------------


def _brute_lines(rows, min_words=2, fuzzy=20):
    def near(a, b):
        if abs(len(a) - len(b)) > 1:
            return False
        if len(a) > len(b):
            a, b = b, a
        k = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
        return a[k:] == b[k + 1 :] or (len(a) == len(b) and a[k + 1 :] == b[k + 1 :])

    seen, out = [], {}
    for k, text in rows:
        if text is None:
            out[k] = None
            continue
        kept = []
        for line in text.split("\n"):
            if len(line.split()) >= min_words:
                if any(line == s or (len(line) >= fuzzy and len(s) >= fuzzy and near(line, s)) for s in seen):
                    seen.append(line)
                    continue
                seen.append(line)
            kept.append(line)
        out[k] = "\n".join(kept)
    return out


def test_lines_one_edit_apart_go(spark, docs):
    rng = random.Random(5)
    base = [" ".join(rng.choice(["alpha", "beta", "gamma", "d"]) for _ in range(rng.choice([2, 6, 14, 60, 400]))) for _ in range(40)]

    def changed(s):
        k, c = rng.randrange(len(s)), rng.choice("xyé ")
        return rng.choice([s, s[:k] + s[k + 1 :], s[:k] + c + s[k + 1 :], s[:k] + c + s[k:], s + c, c + s, s[:k] + c + s[k:] + c])

    rows = [(k, "\n".join(changed(rng.choice(base)) for _ in range(rng.randint(1, 8))) + rng.choice(["", "\n", "\n\none\none"])) for k in range(120)]
    got = {r["doc_id"]: r for r in linededup.line_dedup(docs(rows)).collect()}
    want = _brute_lines(rows)
    assert {k: r["text"] for k, r in got.items()} == want
    assert all(r["n_dropped"] == r["n_lines"] - (len(want[k].split("\n")) if want[k] or r["n_dropped"] < r["n_lines"] else 0) for k, r in got.items())


def test_lines_of_odd_rows(spark, docs):
    rows = [(3, "one two\none two"), (1, None), (2, ""), (None, "one two\nlast one"), (3, "one two\none two")]
    got = linededup.line_dedup(docs(rows).withColumnRenamed("n_chars", "n_lines")).collect()
    by = defaultdict(list)
    for r in got:
        by[r["doc_id"]].append(r["text"])
    assert by == {3: ["one two"] * 2, 1: [None], 2: [""], None: ["last one"]}
    assert linededup.line_dedup(docs([])).count() == 0


def test_lines_of_rows_that_share_a_key_are_apart(spark, docs):
    rows = [(1, "alpha beta"), (None, "alpha beta\ngamma delta"), (None, "one two\nthree four"), (7, "alpha beta\nfive six"), (7, "seven eight\nnine ten")]
    got = linededup.line_dedup(docs(rows)).collect()
    assert Counter((r["doc_id"], r["text"]) for r in got) == Counter([(1, "alpha beta"), (None, "gamma delta"), (None, "one two\nthree four"), (7, "five six"), (7, "seven eight\nnine ten")])
    # equal lines at the same place of two such rows: the first keeps its, and a whole repeat agrees with it
    for key in (None, 5):
        got = linededup.line_dedup(docs([(key, "same head\nown a"), (key, "same head\nown b"), (key, "same head\nown b")])).collect()
        heads = {r["text"].split("\n")[-1]: r["n_lines"] - r["n_dropped"] for r in got}
        assert sorted(heads.values()) == [1, 2] and len({r["text"] for r in got}) == 2


def test_repeated_long_lines_without_spaces_go(spark, docs):
    prose, url, short = "数据处理系统必须保留所有文档并且不能丢失任何一行内容", "https://example.org/" + "a" * 40, " " * 30 + "kurz"
    rows = [(1, f"{prose}\n{url}\n{short}"), (2, f"{short}\n{prose}\nnew line"), (3, f"{url}\n{' ' * 40}\nfrei"), (4, f"{' ' * 40}\nfrei")]
    got = {r["doc_id"]: r["text"] for r in linededup.line_dedup(docs(rows)).collect()}
    assert got == {1: rows[0][1], 2: f"{short}\nnew line", 3: f"{' ' * 40}\nfrei", 4: rows[3][1]}


# ---- exact dedup --------------------------------------------------------------------------


@pytest.mark.parametrize("how", [{}, {"capacity": 5, "hot": 20, "hashed": lambda c: F.pmod(F.xxhash64(c), F.lit(40))}])
def test_exact_copies(spark, docs, how):
    rng = random.Random(6)
    rows = [(k, rng.choice(["A b", "a B", "É", "é", "", None, "x" * 300_000 if k % 40 == 0 else "x", f"own {k}"])) for k in range(400)]
    got = exactdedup.exact_dedup(docs(rows).withColumnRenamed("n_chars", "kept").withColumnRenamed("lang", "group_size").withColumnRenamed("source", "_h"), **how).collect()
    groups = defaultdict(list)
    for k, t in rows:
        groups[(t or "").encode().lower()].append(k)
    want = {k: (max(g), len(g), k == max(g), hashlib.sha256(t).hexdigest()) for t, g in groups.items() for k in g}
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in got} == want


def test_repeated_rows_and_null_ids(spark, docs):
    got = exactdedup.exact_dedup(docs([(5, "t"), (5, "t"), (None, "t"), (None, "u"), (None, "u")])).collect()
    assert sum(r["kept"] for r in got) == 2
    assert exactdedup.exact_dedup(docs([])).count() == 0


def test_full_buckets_are_split_on_files_and_collisions_are_chained(spark):
    # 600 texts; a fifth of them share one hash, so their chain can't be split
    texts = spark.range(1200).select((F.col("id") % 600).cast("string").alias("_norm"), F.col("id").alias("_keep"), F.lit(1).cast("long").alias("_n"))
    entries = texts.withColumn("_h", F.when(F.col("_norm").cast("int") % 5 == 0, F.lit(-5).cast("long")).otherwise(F.xxhash64("_norm")))
    index, directory = exactdedup.build_index(entries, depth=2, capacity=20)
    assert len(directory) > 3 and [level for level, _ in directory] == list(range(2, 2 + len(directory)))
    found = index.collect()
    assert sorted((r["_sha"], r["keep_id"], r["group_size"]) for r in found) == sorted((hashlib.sha256(str(k).encode()).hexdigest(), k + 600, 2) for k in range(600))
    assert sorted(r["_chain"] for r in found if r["_h"] == -5) == list(range(1, 121))
    assert all(r["_bucket"] == (r["_h"] % 2**64) >> (64 - r["_depth"]) for r in found)
    held = Counter((r["_depth"], r["_bucket"]) for r in found if r["_h"] != -5)
    assert max(held.values()) <= 20 and len({d for d, _ in held}) > 1
    places = {(r["_h"], r["_depth"], r["_bucket"]) for r in found}
    rows = entries.select("_h").distinct()
    assert {(r["_h"], r["_depth"], r["_bucket"]) for r in exactdedup.located(rows, 2, directory).collect()} == places


# ---- quality rules ------------------------------------------------------------------------


def _measured(text):
    text = text or ""
    w = [x for x in re.split("[\x20\x09-\x0d]+", text) if x]
    five = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if five[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


def test_measures(spark, docs):
    rng = random.Random(7)
    texts = [None, "", " \n\t", "a b c", "one", "# a\n# a\n\n \nb"] + [" ".join(rng.choice(["a", "b", "é", "#\n", "c d"]) for _ in range(rng.randint(0, 60))) for _ in range(80)]
    got = quality.measures(docs(texts).withColumnRenamed("n_chars", "n_words")).collect()
    assert all(tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")) == _measured(texts[r["doc_id"]]) for r in got)


def test_upper_bound_is_exact():
    import math

    assert quality.upper_bound(0, 100, 0.05) == pytest.approx(1 - 0.05 ** (1 / 100), abs=1e-9)
    assert quality.upper_bound(5, 5, 0.05) == 1.0
    for n, k, p in ((7, 3, 0.2), (500, 9, 0.03), (500, 40, 0.03), (4000, 100, 0.03), (30, 0, 0.5)):
        want = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality._at_most(k, n, p) == pytest.approx(want, rel=1e-9)
    for n in (50, 98, 99, 144, 500, 5000, 10**8):
        k = quality.most_allowed(n, 0.03, 0.05)
        assert (k < 0) == (n < 99) and (k < 0 or quality.upper_bound(k, n, 0.05) <= 0.03 < quality.upper_bound(k + 1, n, 0.05))


def test_each_rule_rejects_in_several_strata_within_the_limit(spark, docs):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    prose = lambda n: "\n".join(" ".join(word() for _ in range(12)) for _ in range(n))
    kinds = {"symbols": lambda: prose(2) + " " + " ".join("#$%&" for _ in range(12)), "dup_lines": lambda: prose(7) + "\nmenu\nhome" * 4, "repeats": lambda: prose(8) + "\n" + "a b c d e " * 3}
    rows, what = [], {}
    for k in range(3000):
        stratum, kind = rng.choice(["en", "de", None]), "good" if k % 4 else rng.choice([*kinds])
        odd = kind == "good" and rng.random() < 0.005  # a few good documents look like bad ones
        what[k] = kind, stratum
        rows.append((k, kinds[rng.choice([*kinds])]() if odd else prose(8) if kind == "good" else kinds[kind](), stratum))
    rows += [(5000 + k, "### ### " * 9, "rare") for k in range(50)]
    labels = spark.createDataFrame([(k, int(kind == "good")) for k, (kind, _) in what.items()] + [(1, None), (9_999, 1)] + [(5000 + k, k % 2) for k in range(50)], "doc_id long, quality int")
    got = {r["doc_id"]: r for r in quality.quality_rules(docs(rows).withColumnRenamed("source", "_n"), labels).collect()}
    for stratum in ("en", "de", None):
        of = lambda kind: [got[k]["kept"] for k, w in what.items() if w == (kind, stratum)]  # noqa: E731, B023
        for kind in kinds:
            assert np.mean(of(kind)) < 0.05, (kind, stratum)
        assert np.mean(of("good")) >= 0.97
    assert all(r["kept"] != r["base_failed"] for k, r in got.items() if k >= 5000)  # too few labels to show anything
    assert all(r["kept"] != r["base_failed"] for r in quality.quality_rules(docs(rows), labels.limit(0)).collect())
    assert quality.quality_rules(docs([]), labels).count() == 0


# ---- chat formatting ----------------------------------------------------------------------

TALK = st.lists(st.sampled_from(["<s>", "</s>", "[INST]", "<<SYS>>", "\\", "<", "[", "/s>", "<|endoftext|>", "ok ", "é", "\n", "<\\s>", "[ROLE]"]), max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(turns=st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool", ""]), TALK), max_size=5))
def test_rendering_reads_back(turns):
    text, spans = chat.render(turns)
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


def test_chat_digests(spark):
    rows = [(1, 0, "user", "hi </s>"), (1, 1, "assistant", "yo 😀 <s>"), (1, 2, None, None), (1, 3, "assistant", None), (2, 0, "assistant", "\n é"), (None, 1, "tool", "x"), (None, 1, "tool", "x")]
    talks = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.chat_format(talks)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert (got[1]["n_turns"], got[1]["loss_chars"], got[1]["loss_sha256"]) == (4, 8, sha("yo 😀 <s>"))
    assert got[1]["turns_sha256"] == sha("user\nhi </s>\nassistant\nyo 😀 <s>\n\n\nassistant\n\n")
    assert got[2]["loss_sha256"] == sha("\n é") and got[None]["n_turns"] == 2
    assert chat.read_back(chat.chat_format(talks.limit(0))).count() == 0


# ---- n-gram Jaccard -----------------------------------------------------------------------


def _brute_groups(rows, width, t):
    sets = {}
    for k, text in rows:
        w = (text or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    top = {k: k for k in sets}

    def root(x):
        while top[x] != x:
            x = top[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                top[y] = x
    return {k: (len(sets[k]), root(k)) for k in sets}


@pytest.mark.parametrize(("width", "t"), [(3, Fraction(9, 10)), (5, Fraction(8, 10))])
def test_similar_groups(spark, docs, monkeypatch, width, t):
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(8)
    base = [[rng.choice("abcdefghijklmnop") + str(rng.randrange(9)) for _ in range(n)] for n in (1, 2, 3, 12, 30, 60, 120, 200)]
    rows = [(0, None), (1, ""), (2, "  ")]
    for k in range(3, 160):
        w = [*rng.choice(base)]
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 6])):
            w[rng.randrange(len(w))] = rng.choice("xyz")
        rows.append((k, rng.choice([" ", "\n"]).join(w).title()))
    got = jaccard.similar_groups(docs(rows).withColumnRenamed("n_chars", "component_id"), width, t).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == _brute_groups(rows, width, t)


def test_a_part_of_many_pieces_by_pairs_of_blocks(spark, docs, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 3)
    monkeypatch.setattr(jaccard, "PIVOTS", 1)
    monkeypatch.setattr(jaccard, "LOOKS", 0)
    rng = random.Random(12)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(90):  # all share a good deal, few are near enough to link
        w = [*base]
        for i in rng.sample(range(60), rng.choice([1, 2, 4])):
            w[i] = rng.choice("xyz")
        rows.append((k, " ".join(w)))
    t = Fraction(8, 10)
    got = jaccard.similar_groups(docs(rows), 3, t).collect()
    want = _brute_groups(rows, 3, t)
    assert 5 < len({c for _, c in want.values()}) < 85
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want


def test_components_with_hubs(spark, monkeypatch):
    monkeypatch.setattr("siftloom.llm.components.HUB", 3)
    star, path = [(50, k) for k in range(51, 90)], [(k, k + 1) for k in range(100, 120)]
    links = spark.createDataFrame([*star, *path, (5, 51), (200, 200)], "a long, b long")
    got = {r["node"]: r["component"] for r in components(links).collect()}
    assert got == {5: 5, **{k: 5 for k in range(50, 90)}, **{k: 100 for k in range(100, 121)}}


def test_similar_groups_of_odd_tables(spark, docs):
    assert jaccard.similar_groups(docs([])).count() == 0
    a, b = "one two three four", "five six seven eight"
    got = jaccard.similar_groups(docs([(None, a), (7, a), (7, b), (3, b), (3, b)])).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0) for r in got) == [(0, 0), (3, 3), (3, 3), (7, 3), (7, 3)]


def test_tree_bounds_lose_no_link():
    rng = np.random.default_rng(9)
    t = Fraction(8, 10)
    sets = []
    for _ in range(60):
        s = np.unique(rng.integers(0, 2**63, size=rng.integers(1, 80), dtype=np.uint64))
        sets += [s, np.unique(np.concatenate([s[rng.random(len(s)) > 0.07], rng.integers(0, 2**63, size=2, dtype=np.uint64)]))]
    tree = jaccard.CountTree(sets)
    every = np.ones(len(sets), dtype=bool)
    for q in range(len(sets)):
        near = set(tree.near(q, t, every).tolist())
        for k in range(len(sets)):
            if jaccard.linked(sets[q], sets[k], t):
                assert k in near
                assert set(jaccard.group_keys(sets[q], t).tolist()) & set(jaccard.group_keys(sets[k], t).tolist())


def test_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(50, 40), (60, 50), (7, 7)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(31)} | {40: 40, 50: 40, 60: 40}


def test_keys_sent_at_first_lose_no_link(spark):
    """Linked sets share one of the keys by which documents meet at first, which are fewer and shorter."""
    rng, t, sets, pairs = np.random.default_rng(3), Fraction(8, 10), [], []
    for n in [1, 2, 3, 5, 9, 14, 40, 97, 300, 301, 700] * 6:
        own = rng.integers(0, 2**63, n).astype(np.uint64)
        both = own[int(rng.integers(0, n // 9 + 1)) :]  # the other has some of its own, as many as a link allows
        more = len(both) * t.denominator // t.numerator - n if n * t.numerator <= len(both) * t.denominator else 0
        pairs.append((len(sets), len(sets) + 1))
        sets += [np.unique(own), np.unique(np.concatenate([both, rng.integers(0, 2**63, max(0, more)).astype(np.uint64)]))]
    linked = [p for p in pairs if jaccard.linked(sets[p[0]], sets[p[1]], t)]
    assert len(linked) > 40
    rows = [(i, [(need, keys.view(np.int64).tolist()) for keys, need in jaccard.class_keys(s, t)]) for i, s in enumerate(sets)]
    sent = jaccard.first_keys(spark.createDataFrame(rows, "_id long, _keys array<struct<need: int, keys: array<bigint>>>")).collect()
    held = {}
    for r in sent:
        held.setdefault(r["_key"] >> jaccard.CLASS_BITS, set()).add(r["k"])
    assert all(held[a] & held[b] for a, b in linked)
    assert len(sent) < 0.9 * sum(len(keys) for _, found in rows for _, keys in found) and max(r["k"] for r in sent) < 2**jaccard.SHORT


def test_a_written_table_leaves_no_shuffle(spark):
    """What a table between steps took to make does not stay on disk beside it."""
    held = lambda: sum("shuffle_" in f for f in str(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")).split("\n"))
    name, before = "spark.sql.classic.shuffleDependency.fileCleanup.enabled", held()
    was = spark.conf.get(name, None)
    made = cut(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    began = time.time()
    while held() > before and time.time() - began < 10:
        time.sleep(0.2)
    assert held() <= before and spark.conf.get(name, None) == was
    assert len(made.collect()) == 7


def test_many_similar_documents_are_sent_by_parts(spark, docs, monkeypatch):
    """Documents beyond what may be broadcast are looked up part by part, so that texts are not shuffled to be looked up."""
    joined = []
    monkeypatch.setattr(jaccard, "BROADCAST_ROWS", 40)
    monkeypatch.setattr(jaccard, "maybe_broadcast", lambda df, n: joined.append((set(df.columns), n)) or maybe_broadcast(df, n))
    rng = random.Random(5)
    base = [[rng.choice("abcdefgh") + str(rng.randrange(99)) for _ in range(40)] for _ in range(30)]
    rows = []
    for k in range(150):
        w = [*base[k % 30]]
        for i in rng.sample(range(40), rng.choice([0, 1, 2])):
            w[i] = "x" + str(k)
        rows.append((k, " ".join(w)))
    got = jaccard.similar_groups(docs(rows), 3, Fraction(8, 10)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == _brute_groups(rows, 3, Fraction(8, 10))
    with_texts = [n for c, n in joined if "component" in c]
    assert len(with_texts) > 2 and max(with_texts) <= 60 and not any("_keys" in c or "_d1" in c for c, _ in joined)
