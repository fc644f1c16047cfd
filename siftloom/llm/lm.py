"""Language-model scoring: a log-bilinear model trained with noise-contrastive estimation.

Words are counted over all training documents. The most frequent words are the model's outputs; all
other words share outputs by their last three characters, and within such a class a word has the
share of its count. Training documents are dealt into shards of some two million tokens by a hash, so
how files are split does not matter, and into rounds. In a round each shard goes on from the same
parameters and step sizes with its documents of that round, and the results are averaged by tokens. All
documents are trained on once, and the driver sees one set of parameters a round.
At scoring, one matrix product gives a block of positions their scores over all outputs, which are
normalised in full.

Words outside a bounded head list are joined to their counts by a shuffle; the frequent words that
would skew it are in the list.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_slices, cut, in_arrow, words_of

#: Outputs: single words, classes of the other words, and the end.
WORDS, CLASSES = 191, 64
END, START = WORDS + CLASSES, WORDS + CLASSES + 1
#: Words before a position that its score looks at, and numbers that stand for a word.
CONTEXT, WIDTH = 4, 16
#: Noise samples of a block of positions, and positions of a block.
NOISE, BLOCK = 32, 2048
#: Positions that are scored at once, few enough that their scores over all outputs stay in a cache.
SCORED = 512
#: Tokens of a shard, shards until which it stays at that, and rounds of averaging.
SHARD, SHARDS, ROUNDS = 2_000_000, 64, 4
#: Words that every task holds with their counts, and the longest of them.
HEAD, HEAD_CHARS = 1 << 17, 64


@dataclass
class Counts:
    """What training documents hold: a table of words and counts, and what is known of it."""

    words: DataFrame  # word, c; the end is the empty word
    n: int
    v: int
    head: pa.Array
    head_counts: np.ndarray
    class_mass: np.ndarray  # of each class, its words' counts, each with 0.5


def count_words(train: DataFrame) -> DataFrame:
    """word, c over all rows of train (column _text); the empty word counts the ends."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, rows in byte_slices(batch.column(0), 8 << 20):
                found = pc.value_counts(words_of(batch.column(0).slice(start, rows))[0])
                words = pa.concat_arrays([found.field(0), pa.array([""])])
                yield pa.RecordBatch.from_arrays([words, pa.concat_arrays([found.field(1).cast(pa.int64()), pa.array([rows], pa.int64())])], names=["word", "c"])

    return in_arrow(train.select("_text"), work, "word string, c long").groupBy("word").agg(F.sum("c").alias("c"))


def class_of(word: Column) -> Column:
    return (F.crc32(F.encode(F.right(word, F.lit(3)), "UTF-8")) % CLASSES).cast("int")


def gather(train: DataFrame) -> Counts:
    words = cut(count_words(train))
    total = words.agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("v")).first()
    # the least count of which no more than HEAD words are: counts by their logarithm, a few hundred rows
    short = words.filter(F.length("word") <= HEAD_CHARS)
    level = F.floor(F.log2("c") * 16).cast("int")
    least, some = math.inf, 0
    for r in sorted(short.groupBy(level.alias("l")).agg(F.count(F.lit(1)).alias("n"), F.min("c").alias("c")).collect(), key=lambda r: -r["l"]):
        some += r["n"]
        if some > HEAD:
            break
        least = r["c"]
    found = sorted(short.filter(F.col("c") >= (least if least < math.inf else 2**62)).collect(), key=lambda r: (-r["c"], r["word"]))
    own = [r["word"] for r in found if r["word"]][:WORDS]
    rest = words.filter((F.col("word") != "") & ~F.col("word").isin(own))
    mass = np.full(CLASSES, 0.5)  # of a word of the class that training has not
    for r in rest.groupBy(class_of(F.col("word")).alias("k")).agg(F.sum(F.col("c") + 0.5).alias("m")).collect():
        mass[r["k"]] += r["m"]
    # the head's first words are the outputs
    listed = own + [r["word"] for r in found if r["word"]][WORDS:]
    counts = {r["word"]: r["c"] for r in found}
    return Counts(words, total["n"] or 0, total["v"], pa.array(listed, pa.string()), np.array([counts[w] for w in listed], dtype=np.int64), mass)


class Outputs:
    """Numbers of words as outputs, by a head list and the classes."""

    def __init__(self, head: pa.Array) -> None:
        self.head = head
        self.of_head = np.concatenate([np.arange(min(WORDS, len(head))), self.classes(head[WORDS:])]).astype(np.int16)

    def classes(self, words: pa.Array) -> np.ndarray:
        ends = pc.utf8_slice_codeunits(words, -3).dictionary_encode()
        known = np.array([zlib.crc32(x.encode()) % CLASSES for x in ends.dictionary.to_pylist()], dtype=np.int16)
        return WORDS + known[ends.indices.to_numpy()] if len(words) else np.zeros(0, dtype=np.int16)

    def look(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        """Of each word its place in the head (-1: none) and its output, and the words without."""
        at = pc.fill_null(pc.index_in(words, self.head), -1).to_numpy()
        out = self.of_head[at] if len(self.head) else np.zeros(len(at), dtype=np.int16)
        others = words.filter(pa.array(at < 0))
        out[at < 0] = self.classes(others)
        return at, out, others

    @staticmethod
    def laid(out: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Texts one after the other, each as starts, its words and an end; and where words and ends are."""
        begin = np.cumsum(sizes + 1 + CONTEXT) - (sizes + 1 + CONTEXT)
        whole = np.full(int((sizes + 1 + CONTEXT).sum()), START, dtype=np.int16)
        first = np.cumsum(sizes) - sizes
        at = np.arange(len(out)) + np.repeat(begin + CONTEXT - first, sizes)
        whole[at] = out
        ends = begin + CONTEXT + sizes
        whole[ends] = END
        return whole, np.sort(np.concatenate([at, ends]))


class LogBilinear:
    """Score of output w after c1..cn: w's vector times the sum of the context's vectors, each scaled
    by the place it stands at, and w's bias."""

    def __init__(self, unigram: np.ndarray) -> None:
        rng = np.random.default_rng(11)
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        # outputs begin as they are frequent, whatever stands before them
        self.parts = [draw(START + 1, WIDTH), np.zeros((END + 1, WIDTH), dtype=np.float32), np.full((CONTEXT, WIDTH), 1 / CONTEXT, dtype=np.float32), np.log(unigram).astype(np.float32)]
        self.noise = unigram

        #: Sums of squared steps, from which step sizes are taken.
        self.squares = [np.full(p.shape, 1e-4) for p in self.parts]

    def flat(self) -> np.ndarray:
        return np.concatenate([p.ravel() for p in (*self.parts, *self.squares)])

    def fill(self, flat: np.ndarray) -> None:
        at = 0
        for parts in (self.parts, self.squares):
            for k, p in enumerate(parts):
                parts[k] = flat[at : at + p.size].reshape(p.shape).astype(p.dtype)
                at += p.size

    def predicted(self, whole: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        context, _, scale, _ = self.parts
        seen = [whole[at - k - 1] for k in range(CONTEXT)]
        q = context[seen[0]] * scale[0]
        for k in range(1, CONTEXT):
            q += context[seen[k]] * scale[k]
        return q, seen

    def log_probs(self, whole: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Natural log-probabilities of the outputs at the places at, normalised over all outputs.

        The product of matrices adds the bias and takes off a bound of each row's scores, so that no score is
        too large for its exponential; rows of which the bound lies too high to tell go by their own largest."""
        _, target, _, bias = self.parts
        out, held = np.empty(len(at)), np.empty((SCORED, END + 1), dtype=np.float32)
        turned = np.vstack([target.T, bias, np.ones_like(bias)]).astype(np.float32)
        longest, highest = np.sqrt((target * target).sum(axis=1)).max(), bias.max()
        ones = np.ones((SCORED, 1), dtype=np.float32)
        for k in range(0, len(at), SCORED):
            part = at[k : k + SCORED]
            q, s = self.predicted(whole, part)[0], held[: len(part)]
            bound = np.sqrt((q * q).sum(axis=1)) * longest + highest
            np.matmul(np.hstack([q, ones[: len(part)], -bound[:, None]]), turned, out=s)
            here = s[np.arange(len(part)), whole[part]].astype(np.float64)
            np.exp(s, out=s)
            total = s.sum(axis=1)
            if (total < 1e-20).any():
                for i in np.flatnonzero(total < 1e-20):
                    own = q[i].astype(np.float64) @ target.T + bias
                    here[i], total[i] = own[whole[part[i]]] - own.max(), np.exp(own - own.max()).sum()
            out[k : k + SCORED] = here - np.log(total)
        return out

    def train(self, whole: np.ndarray, at: np.ndarray, rng: np.random.Generator, rate: float = 0.15) -> None:
        """One pass of noise-contrastive estimation with adaptive steps: each true output is told
        from noise drawn for its block."""
        context, target, scale, bias = self.parts
        chance = np.log(NOISE * self.noise)
        ahead = np.cumsum(self.noise)
        dims = np.arange(WIDTH)
        spread = lambda index, rows, size: np.bincount((index[:, None] * WIDTH + dims).ravel(), rows.ravel(), size * WIDTH).reshape(size, WIDTH)
        for k in range(0, len(at), BLOCK):
            part = at[k : k + BLOCK]
            true = whole[part].astype(np.int64)
            noise = np.minimum(np.searchsorted(ahead, rng.random(NOISE)), END)
            q, seen = self.predicted(whole, part)
            yes = (q * target[true]).sum(axis=1) + bias[true] - chance[true]
            no = q @ target[noise].T + (bias[noise] - chance[noise]).astype(np.float32)
            up = 1 / (1 + np.exp(np.clip(yes, -30, 30)))
            down = 1 / (1 + np.exp(np.clip(-no, -30, 30)))
            dq = up[:, None] * target[true] - down @ target[noise]
            steps = [np.zeros_like(context), spread(true, up[:, None] * q, END + 1), np.zeros_like(scale), np.bincount(true, up, END + 1)]
            np.subtract.at(steps[1], noise, down.T @ q)
            np.subtract.at(steps[3], noise, down.sum(axis=0))
            for c in range(CONTEXT):
                steps[0] += spread(seen[c].astype(np.int64), dq * scale[c], START + 1)
                steps[2][c] = (dq * context[seen[c]]).sum(axis=0)
            for p, g, s in zip(self.parts, steps, self.squares, strict=True):
                g = g / len(part)
                s += g * g
                p += rate * g / np.sqrt(s + 1e-8)


def shards(tokens: int) -> int:
    """How many shards so many training tokens are dealt into: of SHARD tokens each up to SHARDS of them,
    which then grow to SHARDS times as much before there are more."""
    return max(1, min(SHARDS, tokens // SHARD), tokens // (SHARDS * SHARD))


def untrained(counts: Counts) -> LogBilinear:
    """The model before training: outputs have their share of the training tokens as bias."""
    sums = np.full(END + 1, 0.5)
    own = min(WORDS, len(counts.head))
    sums[:own] += counts.head_counts[:own]
    sums[WORDS:END] += counts.class_mass
    ends = counts.words.filter("word = ''").first()
    sums[END] += ends["c"] if ends else 0
    return LogBilinear(sums / sums.sum())


def train_model(train: DataFrame, counts: Counts) -> LogBilinear:
    """One pass over all rows of train (columns _key and _text) in ROUNDS rounds.

    Rows are dealt by a hash of key and text (a null key counts by the row's place, so that copies are not
    dealt together) and taken in its order, so the result depends on the rows alone. Texts are numbered
    once, two bytes a token, and these numbers are what is shuffled.
    """
    model, spark = untrained(counts), train.sparkSession
    words = spark.sparkContext.broadcast(counts.head)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        outputs = Outputs(words.value)
        for batch in batches:
            for start, rows in byte_slices(batch.column(1)):
                part = batch.slice(start, rows)
                found, sizes = words_of(part.column(1))
                raw = outputs.look(found)[1].astype("<i2").tobytes()
                edges = (2 * np.concatenate([[0], np.cumsum(sizes)])).tolist()
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([raw[a:b] for a, b in zip(edges, edges[1:], strict=False)], pa.binary())], names=["h", "ids"])

    who = F.coalesce(F.col("_key").cast("string"), F.concat(F.lit(" "), F.monotonically_increasing_id().cast("string")))
    dealt = cut(in_arrow(train.select(F.xxhash64(who, "_text").alias("h"), "_text"), number, "h long, ids binary"))
    n = shards(counts.n)
    for k in range(ROUNDS):
        part = dealt.filter(F.pmod(F.shiftright("h", 40), F.lit(ROUNDS)) == k).withColumn("_shard", F.pmod("h", F.lit(n)))
        found = _round(part.repartition(n, "_shard").sortWithinPartitions("h", "ids").select("ids"), model, k)
        if found:
            flat = np.zeros(len(found))
            for r in found:
                flat[r["i"]] = r["x"]
            model.fill(flat)
    return model


def _round(dealt: DataFrame, model: LogBilinear, k: int) -> list:
    """Parameters and squares (i, x) after each partition has gone on from the model, averaged by tokens."""
    shared = dealt.sparkSession.sparkContext.broadcast((model.noise, model.flat()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        noise, flat = shared.value
        own, seen = LogBilinear(noise), 0
        own.fill(flat)
        rng = np.random.default_rng([5, k, TaskContext.get().partitionId()])
        for batch in batches:
            ids = batch.column(0)
            sizes = pc.binary_length(ids).to_numpy().astype(np.int64) // 2
            out = np.frombuffer(b"".join(ids.to_pylist()), dtype="<i2")
            whole, at = Outputs.laid(out, sizes)
            own.train(whole, at, rng)
            seen += len(at)
        if seen:
            flat = own.flat().astype(np.float64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat))), pa.array(flat * seen), pa.array(np.full(len(flat), float(seen)))], names=["i", "x", "w"])

    out = in_arrow(dealt, work, "i long, x double, w double").groupBy("i").agg((F.sum("x") / F.sum("w")).alias("x")).collect()  # parameters alone
    shared.unpersist()
    return out


def lm_scores(docs: DataFrame, train: Column, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, held_out (not train), n_tokens, n_known, train_tokens, base_score and score of every row.

    base_score is the smoothed unigram's log10 probability of the text, score the model's; both
    cover the words and one end. A null text is empty: an end alone. Texts of any length are scored whole.
    Repeated rows and ids stay. Of equally frequent words the first by name are outputs. Columns of docs other
    than these two, whatever their names, are read for train alone. An empty table gives an empty one.
    """
    frame = docs.select(F.col(key).alias("_key"), (~train).alias("_held"), F.col(text).alias("_text"))
    learned = frame.filter(~F.col("_held"))
    counts = gather(learned)
    model = train_model(learned, counts)
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((model, counts.head, np.log10(counts.head_counts + 0.5), np.log10(counts.class_mass)))
    ends = counts.words.filter("word = ''").first()
    end_count = ends["c"] if ends else 0

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        model, head, head_logs, class_logs = shared.value
        outputs, row = Outputs(head), TaskContext.get().partitionId() << 40
        for batch in batches:
            for start, rows in byte_slices(batch.column(2)):
                part = batch.slice(start, rows)
                words, sizes = words_of(part.column(2))
                at, out, others = outputs.look(words)
                whole, places = outputs.laid(out, sizes)
                logs = model.log_probs(whole, places) / math.log(10)
                own = np.repeat(np.arange(rows), sizes)
                known = at >= 0
                listed = head_logs[at[known]] if len(head_logs) else np.zeros(0)
                classed = (out >= WORDS) & (out < END)
                total = lambda index, x: np.bincount(index, x, rows)
                score = total(np.repeat(np.arange(rows), sizes + 1), logs) - total(own[classed], class_logs[out[classed] - WORDS]) + total(own[known & classed], listed[classed[known]])
                base = total(own[known], listed) + math.log10(end_count + 0.5)
                n_known = np.bincount(own[known], minlength=rows) + (end_count > 0)
                ids = row + np.arange(rows)
                row += rows
                # a row for each text, under a word that no text has, and one for each of its words outside the head
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array([f" {i}" for i in ids.tolist()]), pa.array(np.zeros(rows, dtype=np.int64)), part.column(0), part.column(1), pa.array(sizes + 1), pa.array(n_known), pa.array(base), pa.array(score)], names=names
                )
                if len(others):
                    grouped = pa.table({"_row": ids[own[~known]], "word": others}).group_by(["_row", "word"], use_threads=False).aggregate([([], "count_all")])
                    for b in grouped.to_batches():
                        nothing = [pa.nulls(b.num_rows, t) for t in (part.column(0).type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                        cols = dict(zip(b.schema.names, b.columns, strict=True))
                        yield pa.RecordBatch.from_arrays([cols["_row"], cols["word"], cols["count_all"], *nothing], names=names)

    names = ["_row", "word", "_n", "_key", "_held", "n_tokens", "n_known", "base_score", "score"]
    kind = frame.schema["_key"].dataType.simpleString()
    rows = in_arrow(frame, work, f"_row long, word string, _n long, _key {kind}, _held boolean, n_tokens long, n_known long, base_score double, score double")
    found = rows.join(counts.words, "word", "left")
    log = F.col("_n") * F.log10(F.coalesce("c", F.lit(0)) + 0.5)
    sums = found.groupBy("_row").agg(*(F.max(c).alias(c) for c in ("_key", "_held", "n_tokens", "n_known", "base_score", "score")), F.sum(log).alias("_log"), F.sum(F.when(F.col("c") > 0, F.col("_n")).otherwise(0)).alias("_more"))
    whole = math.log10(counts.n + 0.5 * (counts.v + 1))
    return sums.select(
        F.col("_key").alias(key), F.col("_held").alias("held_out"), "n_tokens", (F.col("n_known") + F.col("_more")).alias("n_known"), F.lit(counts.n).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.col("_log") - F.col("n_tokens") * F.lit(whole)).alias("base_score"), (F.col("score") + F.col("_log")).alias("score"),
    )
