"""Packing token sequences: best fit, improved by swapping a bin's smallest document for two.

Texts are tokenised and cut where they are read; only numbers go further. The pieces are dealt at
random into packing groups of a few thousand, so that the groups, not the tasks, grow with the
input, and each group is packed by itself: the last bin or so of each is not quite full.
"""

from __future__ import annotations

import gc
import json
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, byte_slices, cut, give_back, in_arrow, schema_and
from .tokencount import model_path

PIECES = ("piece int", "start bigint", "length bigint", "ids_crc32 bigint")
#: MB of the words that a task keeps with their ids.
TABLE_MB = 96
#: Bytes of the texts that are encoded at once; their words and ids take many times that.
SLICE = 512 << 10
#: Pieces of a packing group, about.
GROUP = 2_500


#: Printable words of Latin letters, whose normal form is known without the tokenizer.
PLAIN = re.compile(r"[!-~\u00a1-\u00ff]+")
#: Where bytes stand in a byte-level vocabulary: printable ones for themselves, others from 256 on.
SHOWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
BYTE_CHARS = {b: chr(b) for b in SHOWN} | {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in {*SHOWN})}


class _Ids:
    """Ids of words, as little-endian unsigned 32-bit numbers.

    A word of Latin letters is split here as the tokenizer's own rule does, and each part's ids are
    kept, so that words that differ by case or a full stop share them. Other words, and those that
    may hold a special token, go through the tokenizer as they are.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        splits, normal = (json.loads(x.__getstate__()) for x in (self.tokenizer.pre_tokenizer, self.tokenizer.normalizer))
        rule = next(x["pattern"]["Regex"] for x in splits["pretokenizers"] if x["type"] == "Split")
        kinds = [x["type"] for x in normal["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"]:
            raise ValueError(f"words of a tokenizer that normalises by {kinds} can't be told apart")
        self.split = regex.compile(rule).findall
        self.special = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        #: A character of every special token, so that words without it hold none; '' if there is no such.
        self.mark = min(set.intersection(*map(set, self.special)), default="") if self.special else "\0"
        self.model = self.tokenizer.model
        self.words, self.parts = Recent(self.word), Recent(self.part)
        #: Signs that are a part of their own after letters.
        self.tails = {c for c in map(chr, range(33, 127)) if not c.isalnum() and self.split("ab" + c) == ["ab", c]}

    def word(self, text: str) -> bytes:
        if PLAIN.fullmatch(text) and (self.mark not in text or not any(x in text for x in self.special)):
            return b"".join(map(self.parts.__getitem__, self.split(text.lower())))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def mixed(self, text: str) -> bytes:
        """Ids of a word that is not of letters alone; of letters and a sign its parts' are put together."""
        if text[-1:] in self.tails and (body := text[:-1]).isascii() and body.isalpha():
            return self.parts[body.lower()] + self.parts[text[-1]]
        return self.words[text]

    def encode(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """Ids of each text, without an end."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = lists.flatten().dictionary_encode()
        found, low = (x.to_numpy(zero_copy_only=False).tolist() for x in (words.dictionary, pc.ascii_lower(words.dictionary)))
        letters = pc.ascii_is_alpha(words.dictionary).to_numpy(zero_copy_only=False).tolist()  # these are one part
        parts, mixed = self.parts, self.mixed
        ids = [parts[lower] if one else mixed(word) for word, lower, one in zip(found, low, letters, strict=True)]
        at = words.indices.to_numpy()
        sizes = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        starts = np.cumsum(sizes) - sizes
        ends = np.cumsum(sizes[at])
        flat = np.frombuffer(b"".join(ids), dtype="<u4")[np.repeat(starts[at] - ends + sizes[at], sizes[at]) + np.arange(ends[-1] if len(ends) else 0)]
        ends = np.concatenate([[0], ends])
        edges = ends[np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())])]
        for a, b in zip(edges, edges[1:], strict=False):
            yield flat[a:b]

    def part(self, text: str) -> bytes:
        shown = text if text.isascii() else "".join(map(BYTE_CHARS.__getitem__, text.encode()))
        return array("I", [x.id for x in self.model.tokenize(shown)]).tobytes()

    def room(self, mb: int) -> None:
        """Keep about so many MB of words, twice, and of their parts half of that or 12 MB."""
        self.words.most, self.parts.most = mb << 20, max(12, mb // 2) << 20


def token_pieces(docs: DataFrame, capacity: int, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, text: str = "text", key: str = "doc_id", table_mb: int = TABLE_MB) -> DataFrame:
    """One row per piece: key, piece, start, length, ids_crc32.

    A document is its text's ids and end_id; the tokenizer drops white space, so a text's ids are
    those of its words. Null texts count as empty and make a piece of one id. Documents longer
    than capacity are cut every capacity ids. A key named like one of the other columns is refused.
    """
    if key in {c.split()[0] for c in PIECES} | {"sequence_id", "offset"}:
        raise ValueError(f"the key is named like a column of the result: {key}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, end = _Ids(model_path(tokenizer)), np.array([end_id], dtype="<u4").tobytes()
        table.room(table_mb)
        try:
            for batch in batches:
                for k, n in byte_slices(batch.column(1), SLICE):
                    rows: list[list[int]] = [[], [], [], [], []]
                    for at, ids in enumerate(table.encode(batch.column(1).slice(k, n)), k):
                        for p, start in enumerate(range(0, len(ids) + 1, capacity)):
                            part = ids[start : start + capacity]
                            more = len(part) < capacity  # the end comes after the last id
                            found = (at, p, start, len(part) + more, zlib.crc32(end if more else b"", zlib.crc32(part.tobytes())))
                            for col, v in zip(rows, found, strict=True):
                                col.append(v)
                    cols = [batch.column(0).take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int32()), *(pa.array(c, pa.int64()) for c in rows[2:])]
                    yield pa.RecordBatch.from_arrays(cols, names=["_key", *(c.split()[0] for c in PIECES)])
        finally:
            del table  # the worker outlives the task
            gc.collect()
            give_back()

    frame = docs.select(F.col(key).alias("_key"), F.col(text).alias("_text"))
    schema = ", ".join((f"_key {frame.schema['_key'].dataType.simpleString()}", *PIECES))
    return in_arrow(frame, work, schema).withColumnRenamed("_key", key)


class _Pool:
    """Lengths not packed yet, with their rows; taken by length."""

    def __init__(self, lengths: np.ndarray, capacity: int) -> None:
        self.rows: list[list[int]] = [[] for _ in range(capacity + 1)]
        for i in range(len(lengths) - 1, -1, -1):
            self.rows[lengths[i]].append(i)
        self.there = [n for n in range(capacity + 1) if self.rows[n]]

    def largest(self, most: int) -> int:
        """The largest length of at most most, or -1."""
        k = bisect_left(self.there, most + 1)
        return self.there[k - 1] if k else -1

    def take(self, n: int) -> int:
        i = self.rows[n].pop()
        if not self.rows[n]:
            del self.there[bisect_left(self.there, n)]
        return i

    def put(self, n: int, i: int) -> None:
        if not self.rows[n]:
            insort(self.there, n)
        self.rows[n].append(i)

    def two(self, gap: int, least: int) -> tuple[int, int] | None:
        """Two lengths whose sum is the largest of at most gap and more than least."""
        best, found, hi = least, None, len(self.there) - 1
        for a in self.there:
            if a * 2 > gap:
                break
            while hi >= 0 and a + self.there[hi] > gap:
                hi -= 1
            k = hi
            if k >= 0 and self.there[k] == a and len(self.rows[a]) < 2:
                k -= 1
            if k >= 0 and self.there[k] >= a and a + self.there[k] > best:
                best, found = a + self.there[k], (a, self.there[k])
                if best == gap:
                    break
        return found


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, none above capacity.

    A bin starts with the largest length left and takes the largest that still fits, again and
    again. If room is left, its smallest is put back when two others fit the gap so widened more
    tightly. Equal lengths are taken in their order.
    """
    pool = _Pool(lengths, capacity)
    bins, offsets = np.zeros(len(lengths), dtype=np.int64), np.zeros(len(lengths), dtype=np.int64)
    number = 0
    while pool.there:
        own: list[tuple[int, int]] = []
        gap = capacity
        while (n := pool.largest(gap)) >= 0 and gap:
            own.append((n, pool.take(n)))
            gap -= n
        if gap and len(own) > 1:
            n, i = own[-1]
            if pair := pool.two(gap + n, n):
                own.pop()
                own += [(m, pool.take(m)) for m in sorted(pair, reverse=True)]
                pool.put(n, i)
        at = 0
        for n, i in own:
            bins[i], offsets[i] = number, at
            at += n
        number += 1
    return bins, offsets


def pack(pieces: DataFrame, capacity: int, key: str = "doc_id") -> DataFrame:
    """pieces (of token_pieces) with sequence_id and offset.

    Groups are dealt by a hash of a piece's place in the written table, so they are equally large
    whatever repeats, and a task that runs again agrees. Only lengths are worked with; keys and all
    else pass through as they are. Of equal lengths the order is that of key (null last), piece, start
    and ids. An empty table gives an empty one.
    """
    pieces = cut(pieces)
    groups = max(1, pieces.count() // GROUP)
    order = [("length", "descending"), *((c, "ascending") for c in (key, "piece", "start", "ids_crc32"))]
    schema = schema_and(pieces, offset="bigint", sequence_id="bigint")
    names = schema.names

    def work(group: tuple, frame: pa.Table) -> pa.Table:
        frame = frame.take(pc.sort_indices(frame, order)).combine_chunks()
        bins, offsets = best_two_fit(frame["length"].to_numpy(), capacity)
        frame = frame.append_column("offset", pa.array(offsets)).append_column("sequence_id", pa.array(bins + (group[0].as_py() << 32)))
        return frame.select(names)

    dealt = pieces.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(work, schema)


def best_fit_packing(docs: DataFrame, capacity: int = 2048, tokenizer: str = "word_bpe_49k.json", end_id: int = 0, text: str = "text", key: str = "doc_id", table_mb: int = TABLE_MB) -> DataFrame:
    """Pack all documents into sequences of at most capacity tokens.

    Returns a row per piece: key, piece, start, length, ids_crc32, sequence_id, offset. A sequence
    is gapless from offset 0. Repeated rows are packed each; null keys are kept as null. A text longer
    than the capacity is cut into full pieces and a rest; an empty or null one is its end id alone. Other
    columns of docs are not read, whatever their names; an empty table gives an empty one. table_mb: what a
    task may keep of words that it has met, which bears on time and memory alone.
    """
    return pack(token_pieces(docs, capacity, tokenizer, end_id, text, key, table_mb), capacity, key)
