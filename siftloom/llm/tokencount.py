"""Exact token counts at every prefix of a text, by dynamic programming over a piece vocabulary.

A byte-pair encoding has one last piece at each prefix. The piece t that ends prefix p is the one for
which the piece before it, the last one of p without t, and t stay apart when the two are encoded
together. So one table (prefix -> count, last piece) gives the count of every prefix, and questions
about truncation and budgets are read off it: nothing is encoded again.

No piece reaches over the start of a word or over a character outside the vocabulary, so the table
is kept by word and shared among all texts of a Python worker.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, byte_slices, give_back, in_arrow, schema_and

SPACE = "▁"
#: Entries of a task's tables of prefixes and of pairs of pieces, some 150 and 60 MB; a full table starts
#: anew, which costs time but changes no count.
PREFIXES, PAIRS = 700_000, 400_000


class PrefixCounter:
    """Counts for one sentencepiece BPE model with byte fallback and a dummy space before the text."""

    def __init__(self, model: str) -> None:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.scores = {sp.id_to_piece(i): sp.get_score(i) for i in range(sp.vocab_size()) if not (sp.is_unknown(i) or sp.is_control(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.scores):
            raise ValueError("a piece of this model reaches over the start of a word")
        sizes: dict[str, set[int]] = {}
        for piece in self.scores:
            sizes.setdefault(piece[-2:], set()).add(len(piece))
        #: The lengths of the pieces that end in these one or two characters, longest first.
        self.sizes = {end: sorted(found, reverse=True) for end, found in sizes.items()}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.spines: dict[str, tuple[list, list] | None] = {}
        self.states: dict[str, tuple[int, str | None]] = {"": (0, None)}
        self.spaced, self.bare = Recent(lambda word: self.last(SPACE + word)), Recent(self.last)

        marked = [p for p in self.scores if p[0] in "<[" and len(p) > 2]
        for probe in ("a  b", " a", "a ", "\ta\n\nb", "\ufb01\u2163\uff21", "e\u0301", "\x00\x7f\u200b", *marked):
            if self.count(probe) != len(sp.encode(probe)):
                raise ValueError(f"this model changes texts before it cuts them, as {probe!r} shows")

    def merged(self, text: str, least: int = 1) -> list[str]:
        """Pieces of a short text: the best-scored neighbours merge first, of equals the leftmost.
        Stops when no more than the least number of parts is left."""
        parts = list(text)
        while len(parts) > least:
            best = max(((s, -i) for i in range(len(parts) - 1) if (s := self.scores.get(parts[i] + parts[i + 1])) is not None), default=None)
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def spine(self, piece: str) -> tuple[list, list] | None:
        """What stands at the left and at the right edge of a piece while it is put together, each
        with the score of the merge that takes it up; None if the piece does not encode to itself."""
        if piece not in self.spines:
            self.spines[piece] = self._spine(piece)
        return self.spines[piece]

    def _spine(self, piece: str) -> tuple[list, list] | None:
        if len(piece) == 1:
            return [(piece, None)], [(piece, None)]
        if self.merged(piece) != [piece]:
            return None
        if piece[-1] == SPACE:
            return [(piece, None)], [(piece, None)]
        one, two = self.merged(piece, 2)
        own, left, right = self.scores[piece], self.spine(one), self.spine(two)
        if not left or not right or any(own >= self.scores.get(x, 0) for x in (one, two) if len(x) > 1):
            raise ValueError("a piece of this model scores above its own parts")
        return [*left[0][:-1], (one, own), (piece, None)], [*right[1][:-1], (two, own), (piece, None)]

    def apart(self, before: str | None, piece: str) -> bool:
        """Whether before and piece stay as they are when encoded together."""
        if before is None:
            return self.spine(piece) is not None
        if (known := self.pairs.get((before, piece))) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[before, piece] = self._apart(before, piece)
        return known

    def _apart(self, before: str, piece: str) -> bool:
        if before[-1] == SPACE or piece[-1] == SPACE:  # runs of spaces all have one score
            return self.merged(before + piece) == [before, piece]
        a, b = self.spine(before), self.spine(piece)
        if a is None or b is None:
            return False
        (one, two), i, j = (a[1], b[0]), 0, 0
        while True:
            x, x_goes = one[i]
            y, y_goes = two[j]
            met = self.scores.get(x + y)
            if met is not None and (x_goes is None or met > x_goes) and (y_goes is None or met >= y_goes):
                return False
            if x_goes is None and y_goes is None:
                return True
            if y_goes is None or (x_goes is not None and x_goes >= y_goes):
                i += 1
            else:
                j += 1

    def state(self, word: str, end: int) -> tuple[int, str | None]:
        """Count and last piece of word[:end]; those of all shorter prefixes are known."""
        for size in self.sizes.get(word[max(0, end - 2) : end], ()):
            if size <= end and (piece := word[end - size : end]) in self.scores:
                count, before = self.states[word[: end - size]]
                if self.apart(before, piece):
                    return count + 1, piece
        if (piece := word[end - 1]) in self.scores:
            count, before = self.states[word[: end - 1]]
            return count + 1, piece
        return self.states[word[: end - 1]][0] + len(piece.encode()), None

    def prefixes(self, word: str) -> list[int]:
        """Counts of word[:1], word[:2], ... up to the whole word, which starts a run of pieces."""
        if len(self.states) + len(word) > PREFIXES:
            self.states = {"": (0, None)}
        states = self.states
        out = []
        for end in range(1, len(word) + 1):
            if (known := states.get(word[:end])) is None:
                known = states[word[:end]] = self.state(word, end)
            out.append(known[0])
        return out

    def last(self, word: str) -> int:
        """The count of the whole word; only the prefixes not met before are worked out."""
        if len(word) > 256:  # not kept: prefixes of so long a word would fill the table
            return self._long(word)
        if len(self.states) + len(word) > PREFIXES:
            self.states = {"": (0, None)}
        states, known = self.states, len(word)
        while word[:known] not in states:
            known -= 1
        scores, sizes, pairs = self.scores, self.sizes, self.pairs
        for end in range(known + 1, len(word) + 1):  # as state(), without its calls
            for size in sizes.get(word[end - 2 : end] if end > 1 else word[:1], ()):
                if size <= end and (piece := word[end - size : end]) in scores:
                    count, before = states[word[: end - size]]
                    if (apart := pairs.get((before, piece))) is None:
                        apart = self.apart(before, piece)
                    if apart:
                        states[word[:end]] = count + 1, piece
                        break
            else:
                states[word[:end]] = self.state(word, end)
        return states[word][0]

    def _walk(self, word: str) -> Iterator[int]:
        """As prefixes(), with a table by position: time and memory grow with the length alone."""
        counts, lasts = [0], [None]
        for end in range(1, len(word) + 1):
            last = word[end - 1]
            n, piece = (counts[-1] + 1, last) if last in self.scores else (counts[-1] + len(last.encode()), None)
            for size in self.sizes.get(word[max(0, end - 2) : end], ()):
                if size <= end and (found := word[end - size : end]) in self.scores and self.apart(lasts[end - size], found):
                    n, piece = counts[end - size] + 1, found
                    break
            counts.append(n)
            lasts.append(piece)
            yield n

    def _long(self, word: str) -> int:
        count = 0
        for count in self._walk(word):  # noqa: B007
            pass
        return count

    def words(self, text: str) -> Iterator[tuple[str, int]]:
        """The words of a text as the model sees them, spaces marked, each with the characters of the
        text it covers."""
        if not text:
            return
        text = SPACE + text.replace(" ", SPACE)
        start = 0
        for at in range(1, len(text)):
            if text[at] == SPACE and text[at - 1] != SPACE:
                yield text[start:at], at - start - (start == 0)
                start = at
        yield text[start:], len(text) - start - (start == 0)

    def count(self, text: str) -> int:
        """Tokens of the whole text."""
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        lines = text.split("\n")
        newlines = len(lines) - 1
        total = newlines  # a line feed is outside the vocabulary, one byte
        for k, line in enumerate(lines):
            parts = line.split(" ")
            if "" in parts[1:] or (k == 0 and parts[0] == ""):
                total += sum(self.last(w) for w in _runs(line if k else " " + line))
            elif k == 0:
                total += sum(map(self.spaced.__getitem__, parts))
            else:
                if parts[0]:
                    total += self.bare[parts[0]]
                total += sum(map(self.spaced.__getitem__, parts[1:]))
        return total

    def unit(self, text: str) -> int:
        """Tokens of what stands between two single spaces of a text, the first one included."""
        first, *rest = text.split("\n")
        return self.spaced[first] + sum(self.bare[x] + 1 if x else 1 for x in rest)

    def batch(self, texts: pa.Array) -> np.ndarray:
        """count() of each text; each distinct word among them is looked up once."""
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        units = lists.flatten().dictionary_encode()
        words = units.dictionary.to_pylist()
        odd = np.array([w == "" or SPACE in w for w in words], dtype=bool)  # next to it a run of spaces, or no word at all
        each = np.array([0 if o else self.unit(w) for w, o in zip(words, odd, strict=True)], dtype=np.int64)
        at = units.indices.to_numpy()
        edges = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])
        sums = np.concatenate([[0], np.cumsum(each[at])])
        odds = np.concatenate([[0], np.cumsum(odd[at])])
        out = sums[edges[1:]] - sums[edges[:-1]]
        for k in np.flatnonzero(odds[edges[1:]] - odds[edges[:-1]]):
            out[k] = self.count(texts[int(k)].as_py())
        return out

    def counts(self, text: str) -> list[int]:
        """counts(text)[k] is the exact number of tokens of text[:k], for every k from 0."""
        out, done = [0], 0
        for word, covered in self.words(text):
            inner = self.prefixes(word) if len(word) <= 256 else list(self._walk(word))
            out.extend(done + n for n in inner[len(inner) - covered :])
            done += inner[-1]
        return out

    def forget(self) -> None:
        """Let go of what was kept for a task, as the worker outlives it."""
        self.spaced.forget()
        self.bare.forget()
        self.pairs.clear()
        self.states = {"": (0, None)}
        give_back()

    def fits(self, text: str, budget: int) -> int:
        """Characters of the longest prefix of at most budget tokens."""
        best = at = done = 0
        for word, covered in self.words(text):
            inner = self.prefixes(word) if len(word) <= 256 else list(self._walk(word))
            for n in inner[len(inner) - covered :]:
                at += 1
                if done + n <= budget:
                    best = at
            done += inner[-1]
            # a longer prefix may have fewer tokens than a shorter one, but only within one word
            if done - len(word) * 4 > budget:
                break
        return best


def _runs(line: str) -> list[str]:
    """Words of a line with its runs of spaces, as the model sees them."""
    import re

    return re.findall(f"{SPACE}+[^{SPACE}]*|^[^{SPACE}]+", line.replace(" ", SPACE))


@lru_cache(maxsize=2)
def counter(model: str) -> PrefixCounter:
    return PrefixCounter(model)


def model_path(name: str) -> str:
    """Where this machine keeps a vocabulary file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", limit: int = 4096, text: str = "text") -> DataFrame:
    """docs without its text, with n_bytes, n_tokens and over_limit (n_tokens > limit).

    Null texts count as empty: 0 bytes, 0 tokens. Rows are neither dropped nor merged, so repeated
    rows and ids stay. Columns of docs named like the new ones give way to them.
    """
    new = ["n_bytes", "n_tokens"]
    kept = [c for c in docs.columns if c not in (text, *new, "over_limit")]
    schema = schema_and(docs.select(*kept), n_bytes="bigint", n_tokens="bigint")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(model_path(model))
        try:
            for batch in batches:
                texts = batch.column(batch.num_columns - 1)
                sizes = pc.fill_null(pc.binary_length(texts), 0).cast(pa.int64())
                tokens = np.concatenate([table.batch(texts.slice(k, n)) for k, n in byte_slices(texts)] or [[]])
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], sizes, pa.array(tokens, pa.int64())], names=[*kept, *new])
        finally:
            table.forget()

    out = in_arrow(docs.select(*kept, F.col(text).alias("_text")), work, schema)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """docs with prefix_tokens, an array: element k is the token count of the first k characters.

    A null or empty text has [0].
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(model_path(model))
        try:
            for batch in batches:
                for k, n in byte_slices(batch.column(batch.num_columns - 1), 256 << 10):
                    part = batch.slice(k, n)
                    got = [table.counts(x or "") for x in part.column(part.num_columns - 1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(got, pa.list_(pa.int32()))], names=[*names, "prefix_tokens"])
        finally:
            table.forget()

    names = [c for c in docs.columns if c not in (text, "prefix_tokens")] + [text]
    frame = docs.select(*names)
    return in_arrow(frame, work, schema_and(frame, prefix_tokens="array<int>"))


def truncate(docs: DataFrame, budget: int, model: str = "piece_bpe_32k.model", text: str = "text") -> DataFrame:
    """docs with each text cut to its longest prefix of at most budget tokens; null stays null."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = counter(model_path(model))
        try:
            for batch in batches:
                for k, n in byte_slices(batch.column(batch.num_columns - 1)):
                    part = batch.slice(k, n)
                    got = [x if x is None else x[: table.fits(x, budget)] for x in part.column(part.num_columns - 1).to_pylist()]
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(got, pa.string())], names=names)
        finally:
            table.forget()

    names = [c for c in docs.columns if c != text] + [text]
    frame = docs.select(*names)
    return in_arrow(frame, work, frame.schema).select(*docs.columns)
