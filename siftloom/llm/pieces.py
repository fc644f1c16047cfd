"""Encoding to the ids of a sentencepiece byte-pair model, and decoding, exactly as the library does.

A byte-pair encoding has one last piece at every prefix of a text: of the pieces that end there, the one that
stays apart from the last piece of what stands before it. An automaton over all pieces names those that end
at a place, the test of pairs picks the one, and the table of last pieces, read backwards from the end, gives
the ids. Nothing is merged and no queue of merges is kept.

Tables are kept by word, as no piece reaches over the start of one (see tokencount, whose test of pairs this
is). Distinct words of a slice of texts are worked out once; their ids are laid out in numpy.
"""

from __future__ import annotations

import codecs
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Recent, byte_slices, give_back, in_arrow, schema_and
from .tokencount import SPACE, PrefixCounter, _runs, model_path

#: Pairs of pieces of which a task keeps whether they stay apart; a full table starts anew.
PAIRS = 600_000
#: A byte that is no part of a character is one U+FFFD, and so is each of several.
codecs.register_error("each_byte", lambda e: ("�" * (e.end - e.start), e.end))


class PieceCodec:
    """One sentencepiece BPE model with byte fallback and a dummy space before the text."""

    def __init__(self, model: str) -> None:
        import ahocorasick
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        self.rule = PrefixCounter(model)
        self.end = sp.eos_id()
        self.names = [sp.id_to_piece(i) for i in range(sp.vocab_size())]
        ids = {piece: i for i, piece in enumerate(self.names)}
        self.byte = [ids[f"<0x{b:02X}>"] for b in range(256)]
        self.sizes = [len(p) for p in self.names]
        self.found = ahocorasick.Automaton()
        for piece in self.rule.scores:
            self.found.add_word(piece, ids[piece])
        self.found.make_automaton()
        self.pairs: dict[int, bool] = {}
        self.spaced, self.bare = Recent(lambda word: self.word(SPACE + word)), Recent(self.word)
        #: What each id stands for in a decoded text; an end or start stands for nothing.
        said = [b"" if sp.is_control(i) else " ⁇ ".encode() if sp.is_unknown(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(self.names)]
        for b, i in enumerate(self.byte):
            said[i] = bytes([b])
        opens = [p.startswith(SPACE) for p in self.names]
        # and, after these, what it stands for at the start of a text, where the space before the text goes
        self.said = pa.array([*said, *(b[1:] if o else b for b, o in zip(said, opens, strict=True))], pa.binary())
        self.silent = np.array([sp.is_control(i) for i in range(len(said))])
        self.opens = np.array(opens)

    def apart(self, before: int, piece: int) -> bool:
        """Whether two pieces (before: -1 for none) stay as they are next to each other."""
        at = before * len(self.names) + piece
        if (known := self.pairs.get(at)) is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[at] = self.rule.apart(None if before < 0 else self.names[before], self.names[piece])
        return known

    def lasts(self, word: str) -> list[int]:
        """The last piece of word[:1], word[:2], ... after a first entry for no prefix; -1 where the last
        character is outside the vocabulary."""
        out, sizes, done = [-1] * (len(word) + 1), self.sizes, 0
        pairs, v = self.pairs, len(self.names)
        for at, piece in self.found.iter(word):  # the pieces that end at a place come longest first
            if done == at + 1:
                continue
            before = out[at + 1 - sizes[piece]]
            if (fits := pairs.get(before * v + piece)) is None:
                fits = self.apart(before, piece)
            if fits or sizes[piece] == 1:  # where no longer piece fits, the character stands alone
                out[at + 1], done = piece, at + 1
        return out

    def word(self, word: str) -> bytes:
        """Ids of a word, as the bytes of 32-bit integers: read off the table from its end."""
        table, ids, at = self.lasts(word), array("i"), len(word)
        while at:
            if (piece := table[at]) < 0:
                at -= 1
                ids.extend(self.byte[b] for b in reversed(word[at].encode()))
            else:
                ids.append(piece)
                at -= self.sizes[piece]
        ids.reverse()
        return ids.tobytes()

    def unit(self, text: str) -> bytes:
        """Ids of what stands between two single spaces, the first one included."""
        if "\n" not in text:
            return self.spaced[text]
        first, *rest = text.split("\n")
        feed = array("i", [self.byte[10]]).tobytes()
        return self.spaced[first] + b"".join(feed + self.bare[x] if x else feed for x in rest)

    def encode(self, text: str) -> bytes:
        """Ids of a whole text, without an end."""
        if not text:
            return b""
        feed, out = array("i", [self.byte[10]]).tobytes(), []
        for k, line in enumerate(text.split("\n")):
            words = _runs(line if k else " " + line)
            out.append(b"".join(self.bare[w] if len(w) <= 64 else self.word(w) for w in words))
        return feed.join(out)

    def encode_all(self, texts: pa.Array) -> pa.ListArray:
        """Ids of each text and one end; each distinct word among the texts is looked up once."""
        texts = pc.fill_null(texts, "")
        lists = pc.split_pattern(texts, " ")
        units = lists.flatten().dictionary_encode()
        words = units.dictionary.to_numpy(zero_copy_only=False).tolist()
        odd = np.array([w == "" or SPACE in w for w in words], dtype=bool)  # next to it a run of spaces, or no word
        known = [b"" if o else self.unit(w) for w, o in zip(words, odd, strict=True)]
        size = np.array([len(b) >> 2 for b in known], dtype=np.int64)
        flat = np.frombuffer(b"".join(known), dtype=np.int32)
        start = np.cumsum(size) - size
        at = units.indices.to_numpy()
        edge = np.concatenate([[0], np.cumsum(lists.value_lengths().to_numpy())]).astype(np.int64)
        # ids of all units one after the other, those of odd texts left empty
        whole = np.concatenate([[0], np.cumsum(odd[at])])
        strange = (whole[edge[1:]] - whole[edge[:-1]]) > 0
        n = np.where(np.repeat(strange, np.diff(edge)), 0, size[at])
        upto = np.concatenate([[0], np.cumsum(n)])
        out = flat[np.repeat(start[at] - upto[:-1], n) + np.arange(upto[-1])]
        each = np.split(out, upto[edge[1:-1]]) if len(texts) else []
        for k in np.flatnonzero(strange):
            each[k] = np.frombuffer(self.encode(texts[int(k)].as_py()), dtype=np.int32)
        lengths = np.array([len(x) + 1 for x in each], dtype=np.int64)
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        ids = np.full(offsets[-1], self.end, dtype=np.int32)
        for x, a in zip(each, offsets[:-1], strict=True):
            ids[a : a + len(x)] = x
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))

    def decode_all(self, lists: pa.ListArray) -> pa.Array:
        """The text of each list of ids; a null list stays null."""
        ids = lists.flatten()
        if ids.null_count or (len(ids) and (pc.min(ids).as_py() < 0 or pc.max(ids).as_py() >= len(self.names))):
            raise ValueError("an id is outside the vocabulary")
        sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy().astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        said = ids.to_numpy().copy()
        first = offsets[:-1][sizes > 0]
        said[first] += len(self.names) * self.opens[said[first]]
        texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), self.said.take(pa.array(said))), b"")
        late = self._late(ids.to_numpy(), offsets)
        try:
            got = texts.cast(pa.string())
        except pa.ArrowInvalid:
            got = None
        if got is None or late:
            out = [b.decode("utf-8", "each_byte") for b in texts.to_pylist()]
            for k in late:
                out[k] = self.decode(lists[k].as_py())
            got = pa.array(out, pa.string())
        return pc.if_else(lists.is_valid(), got, pa.scalar(None, pa.string())) if lists.null_count else got

    def _late(self, ids: np.ndarray, offsets: np.ndarray) -> list[int]:
        """Lists with a control before their last id, as no encoded text has; decoded one by one."""
        silent = np.concatenate([[0], np.cumsum(self.silent[ids])])
        last = np.maximum(offsets[1:] - 1, offsets[:-1])
        return np.flatnonzero(silent[last] > silent[offsets[:-1]]).tolist()

    def decode(self, ids: list[int]) -> str:
        """The text of one list of ids. Bytes on both sides of a control make no character together."""
        parts, opening = [[]], True
        for i in ids:
            if self.silent[i]:
                parts.append([])
            else:
                parts[-1].append(self.said[i + opening * len(self.names)].as_py())
                opening = False
        return "".join(b"".join(part).decode("utf-8", "each_byte") for part in parts)

    def forget(self) -> None:
        """Let go of what was kept for a task, as the worker outlives it."""
        self.spaced.forget()
        self.bare.forget()
        self.pairs.clear()
        self.rule.forget()
        give_back()


@lru_cache(maxsize=2)
def codec(model: str) -> PieceCodec:
    return PieceCodec(model)


def _added(docs: DataFrame, model: str, read: str, new: list[str], types: dict[str, str]) -> DataFrame:
    """docs without read, with the columns new: ids of the text, or the text of the ids, or both."""
    kept = [c for c in docs.columns if c not in (read, *new)]
    frame = docs.select(*kept, F.col(read).alias("_read"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = codec(model_path(model))
        try:
            for batch in batches:
                slices = byte_slices(batch.column(batch.num_columns - 1)) if "ids" in types else [(0, batch.num_rows)]
                for k, n in slices:
                    part = batch.slice(k, n)
                    got = [part.column(part.num_columns - 1)]
                    if "ids" in types:
                        got.append(table.encode_all(got[-1]))
                    if "text" in types:
                        got.append(table.decode_all(got[-1]))
                    yield pa.RecordBatch.from_arrays([*part.columns[:-1], *got[1:]], names=[*kept, *new])
        finally:
            table.forget()

    kinds = {"ids": "array<int>", "text": "string"}
    return in_arrow(frame, work, schema_and(docs.select(*kept), **{types[t]: kinds[t] for t in kinds if t in types}))


def encode_pieces(docs: DataFrame, model: str = "piece_bpe_32k.model", text: str = "text", ids: str = "ids") -> DataFrame:
    """docs without its text, with the array ids: the model's ids of the whole text and an end id.

    Null text counts as empty: the end alone. Texts of any length are encoded whole; rows are neither dropped
    nor merged, and an empty table gives an empty one. A column of docs named like ids gives way to it.
    """
    return _added(docs, model, text, [ids], {"ids": ids})


def decode_pieces(docs: DataFrame, model: str = "piece_bpe_32k.model", ids: str = "ids", text: str = "text") -> DataFrame:
    """docs without its ids, with the text they stand for: bytes that form no character are U+FFFD each, ends
    and starts are silent, null ids a null text. Fails for an id outside the vocabulary. A column of docs
    named like text gives way to it."""
    return _added(docs, model, ids, [text], {"text": text})


def round_trip(docs: DataFrame, model: str = "piece_bpe_32k.model", text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """encode_pieces, with the text decoded from the ids beside them, in one pass over the texts."""
    return _added(docs, model, text, [ids, decoded], {"ids": ids, "text": decoded})
