"""Language identification by sparse multinomial logistic regression on TF-IDF character n-grams.

Document frequencies are counted over all training documents. The weights are fitted by
follow-the-regularised-leader with elastic-net penalties on a sample of a stated number of documents
per language, and a temperature, fitted on documents of the sample that the weights have not seen,
calibrates the probabilities.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_slices, cut, give_back, in_arrow, schema_and

#: Buckets that n-grams of one to three characters are hashed to.
BITS = 15
#: Characters looked at together, which bounds the memory that a long text takes.
STEP = 1 << 18
#: Distinct labelled texts that weights and temperature are fitted on, at most: per language, and of
#: all languages together, which is what the driver holds.
SAMPLE, ALL_SAMPLES = 1_500, 30_000
#: Languages that one model may have; its weights are 128 KB of every task for each of them.
MOST_LANGS = 2_000
UND = "und"
_KNUTH = np.uint64(0x9E3779B97F4A7C15)


def _letters() -> np.ndarray:
    """For each code point, itself if it is a letter, else 0."""
    global _TABLE
    if _TABLE is None:
        _TABLE = np.fromiter((c if chr(c).isalpha() else 0 for c in range(0x110000)), dtype=np.uint32, count=0x110000)
    return _TABLE


_TABLE: np.ndarray | None = None


def features(text: str, step: int = STEP) -> np.ndarray | None:
    """Counts by bucket of the n-grams of the whole text; None if it has no letter. All that is not
    a letter counts as the edge of a word, however much of it there is. step: characters looked at
    together; the last two of a step go before the next, so the result is the same for all."""
    counts, any_letter = np.zeros(1 << BITS, dtype=np.int64), False
    letters, shift = _letters(), np.uint64(64 - BITS)
    carried = np.zeros(1, dtype=np.uint64)  # the edge before the text; its own n-gram counts too
    fresh = 0  # from where on codes have not been counted
    for start in range(0, len(text) + step, step):
        part = text[start : start + step].lower().replace("\u03c2", "\u03c3")  # a final sigma, for a step may end within a word
        codes = letters[np.frombuffer(part.encode("utf-32-le", "surrogatepass"), dtype="<u4")].astype(np.uint64)
        if start >= len(text):
            codes = np.zeros(1, dtype=np.uint64)  # the edge after it
        any_letter |= bool(codes.any())
        codes = np.concatenate([carried, codes])
        kept = np.ones(len(codes), dtype=bool)
        kept[len(carried) :] = (codes[len(carried) :] != 0) | (codes[len(carried) - 1 : -1] != 0)
        codes = codes[kept]
        one = (codes + np.uint64(1)) * _KNUTH
        two = (one[:-1] ^ (codes[1:] << np.uint64(21))) * _KNUTH
        three = (two[:-1] ^ (codes[2:] << np.uint64(13))) * _KNUTH
        for grams, before in ((one, 0), (two, 1), (three, 2)):
            grams = grams[max(0, fresh - before) :]
            counts += np.bincount((grams >> shift).astype(np.int64), minlength=1 << BITS)
        carried = codes[-2:]
        fresh = len(carried)
    return counts if any_letter else None


@dataclass
class Model:
    langs: list[str]
    idf: np.ndarray  # by bucket
    weights: np.ndarray  # bucket x language
    bias: np.ndarray
    temperature: float = 1.0

    def vector(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets and values of a text's TF-IDF vector of length 1."""
        at = np.flatnonzero(counts)
        values = np.log1p(counts[at]) * self.idf[at]
        return at, values / max(np.sqrt((values**2).sum()), 1e-12)

    def scores(self, at: np.ndarray, values: np.ndarray) -> np.ndarray:
        return values @ self.weights[at] + self.bias

    def predict(self, text: str | None) -> tuple[str, float]:
        counts = features(text) if text else None
        if counts is None or not self.langs:
            return UND, 0.0
        p = _softmax(self.scores(*self.vector(counts)) / self.temperature)
        k = int(p.argmax())
        return self.langs[k], min(1.0, float(p[k]))


def _softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max())
    return e / e.sum()


def ftrl(vectors: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, model: Model, epochs: int = 4, alpha: float = 2.0, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02) -> None:
    """Fit the model's weights, a document at a time, by follow-the-regularised-leader. l1 keeps most
    weights at exactly 0. The bias is a feature of every document, without penalties."""
    n_langs = len(model.langs)
    z, n = (np.zeros((1 << BITS, n_langs), dtype=np.float64 if n_langs <= 100 else np.float32) for _ in range(2))
    zb, nb = np.zeros(n_langs), np.zeros(n_langs)
    order = np.random.default_rng(7)

    def solved(z: np.ndarray, n: np.ndarray) -> np.ndarray:
        return np.where(np.abs(z) > l1, (np.sign(z) * l1 - z) / ((beta + np.sqrt(n)) / alpha + l2), 0.0)

    for _ in range(epochs):
        for d in order.permutation(len(vectors)):
            at, x = vectors[d]
            w, bias = solved(z[at], n[at]), -zb / ((beta + np.sqrt(nb)) / alpha)
            miss = _softmax(x @ w + bias)
            miss[labels[d]] -= 1
            g = x[:, None] * miss
            z[at] += g - (np.sqrt(n[at] + g**2) - np.sqrt(n[at])) / alpha * w
            n[at] += g**2
            zb += miss - (np.sqrt(nb + miss**2) - np.sqrt(nb)) / alpha * bias
            nb += miss**2
    for k in range(0, 1 << BITS, 1024):
        model.weights[k : k + 1024] = solved(z[k : k + 1024], n[k : k + 1024])
    model.bias = -zb / ((beta + np.sqrt(nb)) / alpha)


def calibrate(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature that makes the labels most likely, by golden-section search over its log."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        s = scores / math.exp(log_t)
        top = s.max(axis=1)
        return float((np.log(np.exp(s - top[:, None]).sum(axis=1)) + top - s[np.arange(len(s)), labels]).mean())

    low, high, cut = math.log(0.25), math.log(5.0), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - cut * (high - low), low + cut * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return math.exp((low + high) / 2)


def _frequencies(train: DataFrame) -> DataFrame:
    """bucket, df over all rows of train (column _text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1 << BITS, dtype=np.int64)
        for batch in batches:
            for k, n in byte_slices(batch.column(0)):
                for text in batch.column(0).slice(k, n).to_pylist():
                    if text and (counts := features(text)) is not None:
                        df += counts > 0
        at = np.flatnonzero(df)
        give_back()
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["bucket", "df"])

    return in_arrow(train.select("_text"), work, "bucket long, df long").groupBy("bucket").agg(F.sum("df").alias("df"))


def _vectors(sample: DataFrame) -> DataFrame:
    """_lang, _held, at, tf of the sampled rows; at and tf as bytes of 32-bit numbers, which the driver
    holds in a tenth of the memory that lists of numbers take."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, n in byte_slices(batch.column(2)):
                langs, held, at, tf = [], [], [], []
                part = batch.slice(k, n)
                for lang, aside, text in zip(*(c.to_pylist() for c in part.columns), strict=True):
                    if text and (counts := features(text)) is not None:
                        langs.append(lang)
                        held.append(aside)
                        found = np.flatnonzero(counts)
                        at.append(found.astype("<i4").tobytes())
                        tf.append(np.minimum(counts[found], 2**31 - 1).astype("<i4").tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(held, pa.bool_()), pa.array(at, pa.binary()), pa.array(tf, pa.binary())], names=["_lang", "_held", "at", "tf"])

    return in_arrow(sample.select("_lang", "_held", "_text"), work, "_lang string, _held boolean, at binary, tf binary")


def _sample(rows: DataFrame, most: int) -> tuple[DataFrame, list]:
    """_lang, _held, _text of at most so many distinct texts of each language, and the languages with
    their numbers of rows. Texts are taken by their hashes, the lowest of a language first, and of five
    one is held, so neither copies nor the order of rows bear on the choice. Copies are combined
    before they are sent anywhere."""
    hashed = rows.withColumn("_h", F.xxhash64("_text"))
    texts = cut(hashed.groupBy("_lang", "_h").agg(F.count(F.lit(1)).alias("_n")))
    sizes = texts.groupBy("_lang").agg(F.sum("_n").alias("rows"), F.count(F.lit(1)).alias("texts")).orderBy("_lang").take(MOST_LANGS + 1)
    if len(sizes) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} languages")
    if not sizes:
        return texts, sizes
    most = min(most, max(1, ALL_SAMPLES // len(sizes)))
    # of each language so many low hashes that most of them are among these, to be ranked
    share = rows.sparkSession.createDataFrame([(r["_lang"], min(1.0, (most + 5 * most**0.5 + 5) / r["texts"])) for r in sizes], "_lang string, _share double")
    low = F.shiftrightunsigned("_h", 33).cast("double") / 2**31 < F.col("_share")
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy(F.shiftrightunsigned("_h", 1), "_h"))
    ranked = texts.join(F.broadcast(share), "_lang").filter(low).withColumn("_rank", rank).filter(F.col("_rank") <= most)
    picked = cut(ranked.select("_lang", "_h", (F.col("_rank") % 5 == 0).alias("_held")))
    found = hashed.join(F.broadcast(picked), ["_lang", "_h"])  # ALL_SAMPLES rows at most
    return found.groupBy("_lang", "_h").agg(F.min("_text").alias("_text"), F.min("_held").alias("_held")).select("_lang", "_held", "_text"), sizes


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", train: Column | None = None, sample: int = SAMPLE) -> Model:
    """Fit a model on the rows of docs for which train holds and text and lang are not null.

    All languages are learned. Document frequencies are of all rows, repeated ones too; weights are
    fitted on at most sample distinct texts of each language (fewer where ALL_SAMPLES is shared by
    many languages), a fifth of which sets the temperature instead. Rows repeated whole, ties between languages and extra columns do not bear on the choice.
    Without any such row, as in an empty table, the model has no language.
    """
    rows = docs if train is None else docs.filter(train)
    rows = rows.select(F.col(text).alias("_text"), F.col(lang).cast("string").alias("_lang")).filter("_text is not null and _lang is not null")
    picked, sizes = _sample(rows, sample)
    langs = [r["_lang"] for r in sizes]
    total = sum(r["rows"] for r in sizes)
    df = np.zeros(1 << BITS)
    for r in _frequencies(rows).collect():
        df[r["bucket"]] = r["df"]
    model = Model(langs, np.log((1 + total) / (1 + df)) + 1, np.zeros((1 << BITS, len(langs)), dtype=np.float32), np.zeros(len(langs)))
    if not langs:
        return model
    found = [(r["_held"], r["_lang"], bytes(r["at"]), bytes(r["tf"])) for r in _vectors(picked).collect()]
    code = {x: k for k, x in enumerate(langs)}
    found.sort(key=lambda r: (r[0], r[1], len(r[2]), r[2], r[3]))
    sets: dict[bool, tuple[list, list]] = {True: ([], []), False: ([], [])}
    for held, name, at, tf in found:
        buckets = np.frombuffer(at, dtype="<i4")
        values = np.log1p(np.frombuffer(tf, dtype="<i4")) * model.idf[buckets]
        sets[held][0].append((buckets, (values / np.sqrt((values**2).sum())).astype(np.float32)))
        sets[held][1].append(code[name])
    ftrl(*_pair(sets[False] if sets[False][0] else sets[True]), model)
    vectors, labels = _pair(sets[True])
    model.temperature = calibrate(np.array([model.scores(*v) for v in vectors]), labels)
    del found, sets, vectors
    give_back()
    return model


def _pair(found: tuple[list, list]) -> tuple[list, np.ndarray]:
    return found[0], np.array(found[1], dtype=np.int64)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """docs with lang_pred and score, the calibrated probability of lang_pred.

    A text that is null or has no letter is `und`, with score 0, and so are all if the model has
    learned no language. Columns of docs named like the new ones give way to them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score", text)] + [text]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for batch in batches:
            for k, n in byte_slices(batch.column(batch.num_columns - 1)):
                part = batch.slice(k, n)
                langs, scores = [], []
                for x in part.column(part.num_columns - 1).to_pylist():
                    name, p = own.predict(x)
                    langs.append(name)
                    scores.append(p)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())], names=[*kept, "lang_pred", "score"])

    frame = docs.select(*kept)
    return in_arrow(frame, work, schema_and(frame, lang_pred="string", score="double"))
