"""Chat formatting with loss masks aligned to token offsets.

A conversation is rendered whole, with markers around each turn, and encoded once. Markers are
single tokens of their own; a text that holds one's string has it escaped by a backslash after the
first character, which reading back takes out again. The turns' places in the rendered text are
known from rendering, and a binary search over the tokens' offsets finds those in each.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_arrow
from .tokencount import model_path

#: role -> the markers before and after its text; any other role is named before a user's markers.
MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
ROLE = ("[ROLE]", "[/ROLE]")
CONTROL = [*(m for pair in (*MARKS.values(), ROLE) for m in pair), "<|endoftext|>"]
_REST = "(?=\\\\*(?:" + "|".join(re.escape(c[1:]) for c in CONTROL) + "))"
_BARE, _ESCAPED = re.compile(r"([<\[])" + _REST), re.compile(r"([<\[])\\" + _REST)
_TURN = re.compile("(?:" + re.escape(ROLE[0]) + "(.*?)" + re.escape(ROLE[1]) + ")?(?:" + "|".join(f"{re.escape(a)}(.*?){re.escape(b)}" for a, b in MARKS.values()) + ")", re.DOTALL)

FORMATTED = "formatted string, ids array<int>, starts array<int>, ends array<int>, loss array<boolean>, spans array<struct<start: int, end: int>>"


def escape(text: str) -> str:
    return _BARE.sub(r"\1\\", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The text of a conversation, and where its assistants' texts lie in it."""
    parts, at, spans = [], 0, []
    for role, text in turns:
        before, after = MARKS.get(role, MARKS["user"])
        if role not in MARKS:
            before = ROLE[0] + escape(role) + ROLE[1] + before
        text = escape(text)
        if role == "assistant":
            spans.append((at + len(before), at + len(before) + len(text)))
        parts += [before, text, after]
        at += len(before) + len(text) + len(after)
    return "".join(parts), spans


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a rendered conversation."""
    out = []
    for m in _TURN.finditer(formatted):
        named, *texts = m.groups()
        k = next(k for k, t in enumerate(texts) if t is not None)
        out.append(([*MARKS][k] if named is None else unescape(named), unescape(texts[k])))
    return out


def masked(starts: np.ndarray, ends: np.ndarray, spans: list[tuple[int, int]]) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Which tokens meet one of the spans, and the characters that both cover, by span. Tokens are in
    order of their places, and so are the spans."""
    loss = np.zeros(len(starts), dtype=bool)
    covered = []
    for a, b in spans:
        first, last = np.searchsorted(ends, a, side="right"), np.searchsorted(starts, b, side="left")
        if a < b and first < last:
            loss[first:last] = True
            covered.append((max(a, int(starts[first])), min(b, int(ends[last - 1]))))
        else:
            covered.append((a, a))
    return loss, covered


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import AddedToken, Tokenizer

    t = Tokenizer.from_file(path)
    t.add_special_tokens([AddedToken(c, normalized=False, special=True) for c in CONTROL])
    return t


def chat_format(conversations: DataFrame, tokenizer: str = "byte_bpe_50k.json", key: str = "conv_id") -> DataFrame:
    """One row per conversation: key, formatted, its token ids with starts and ends in characters,
    loss (whether a token belongs to an assistant's text) and spans (the loss characters, one span
    for each assistant turn).

    conversations has key, turn, role and text. Turns go by turn, then role and text, nulls first;
    repeated rows stay. A null text or role counts as empty; a null key is a conversation like others.
    """
    rows = conversations.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))).alias("_turns"))
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, {FORMATTED}"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _tokenizer(model_path(tokenizer)).encode
        for batch in batches:
            for k in range(0, batch.num_rows, 64):
                part = batch.slice(k, 64)
                out: list[list] = [[] for _ in range(6)]
                for turns in part.column(1).to_pylist():
                    text, spans = render([(t["role"], t["text"]) for t in turns])
                    e = encode(text, add_special_tokens=False)
                    places = np.array(e.offsets, dtype=np.int32).reshape(-1, 2)
                    loss, covered = masked(places[:, 0], places[:, 1], spans)
                    for col, v in zip(out, (text, e.ids, places[:, 0], places[:, 1], loss, [{"start": a, "end": b} for a, b in covered]), strict=True):
                        col.append(v)
                yield pa.RecordBatch.from_arrays([part.column(0), *map(pa.array, out, kinds)], names=[key, *names])

    ints = pa.list_(pa.int32())
    kinds = [pa.string(), ints, ints, ints, pa.list_(pa.bool_()), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))]
    names = ["formatted", "ids", "starts", "ends", "loss", "spans"]
    return in_arrow(rows, work, schema)


def read_back(formatted: DataFrame, key: str = "conv_id") -> DataFrame:
    """What chat_format wrote, as digests: n_turns, turns_sha256, loss_chars, loss_sha256 and
    formatted_chars. The loss text is what tokens under the mask cover within the spans."""
    schema = f"`{key}` {formatted.schema[key].dataType.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in range(5)]
            for k in range(batch.num_rows):
                text, starts, ends, loss, spans = (batch.column(c)[k].as_py() if c in (1, 5) else batch.column(c)[k].values.to_numpy(zero_copy_only=False) for c in range(1, 6))
                turns = parse(text)
                on_starts, on_ends = starts[loss], ends[loss]
                said = []
                for s in spans:
                    a, b = np.searchsorted(on_ends, s["start"], side="right"), np.searchsorted(on_starts, s["end"], side="left")
                    at, piece = s["start"], []
                    for x, y in zip(on_starts[a:b], on_ends[a:b], strict=True):
                        x, y = max(at, int(x)), min(int(y), s["end"])
                        if x < y:
                            piece.append(text[x:y])
                            at = y
                    said.append(unescape("".join(piece)))
                told = "".join(said)
                turned = "".join(f"{role}\n{t}\n" for role, t in turns)
                for col, v in zip(out, (len(turns), hashlib.sha256(turned.encode()).hexdigest(), len(told), hashlib.sha256(told.encode()).hexdigest(), len(text)), strict=True):
                    col.append(v)
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, out, kinds)], names=[key, "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return in_arrow(formatted.select(key, "formatted", "starts", "ends", "loss", "spans"), work, schema)
