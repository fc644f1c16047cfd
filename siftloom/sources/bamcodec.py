"""The bytes of BAM files: blocks, headers and records, decoded by column.

A stretch of uncompressed data is decoded as a whole: the fixed parts of its records become one numpy
array, and names, bases, qualities and tags are gathered by their places and lengths, not record by record.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Fixed values of the format.
BASES, OPS = "=ACMGRSVTWYHKDBN", "MIDNSHP=X"
MAGIC, EXTRA = b"\x1f\x8b\x08\x04", b"BC\x02\x00"
EOF_BLOCK = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")
SCALARS = {"c": "b", "C": "B", "s": "h", "S": "H", "i": "i", "I": "I", "f": "f"}
FIXED = struct.Struct("<iiBBHHHiiii")
FIELDS = np.dtype([("ref", "<i4"), ("pos", "<i4"), ("n_name", "u1"), ("mapq", "u1"), ("bin", "<u2"), ("n_ops", "<u2"), ("flag", "<u2"), ("n", "<i4"), ("mref", "<i4"), ("mpos", "<i4"), ("isize", "<i4")])
#: Both bases of a packed byte.
TWO = np.array([[ord(BASES[b >> 4]), ord(BASES[b & 15])] for b in range(256)], dtype=np.uint8)
#: Columns that stand in the fixed part of a record; rows can be chosen by these before the rest is decoded.
NUMBERS = ("flag", "pos", "mapq", "mpos", "isize")


class Blocks:
    """The blocks of an open file from a place on, each as (where it begins, its content). Reads ahead by
    more and more, up to a MB, but not far over the end that is wanted."""

    def __init__(self, f, at: int, end: int) -> None:
        self.f, self.at, self.end, self.ahead = f, at, end, 1 << 16
        self.held, self.base = b"", at

    def _bytes(self, n: int) -> bytes:
        """n bytes from the place on, or what there is."""
        k = self.at - self.base
        if k + n > len(self.held):
            self.held, self.base = self.held[k:], self.at
            self.f.seek(self.base + len(self.held))
            want = max(n - len(self.held), min(self.ahead, max(self.end - self.at, 1 << 16)))
            self.held += self.f.read(want)
            self.ahead, k = min(2 * self.ahead, 1 << 20), 0
        return self.held[k : k + n]

    def __iter__(self) -> Iterator[tuple[int, bytes]]:
        return self

    def __next__(self) -> tuple[int, bytes]:
        head = self._bytes(18)
        if len(head) < 18 or head[:4] != MAGIC or head[12:16] != EXTRA:
            raise StopIteration
        size = struct.unpack_from("<H", head, 16)[0] + 1
        whole = self._bytes(size)
        start, self.at = self.at, self.at + size
        return start, zlib.decompress(whole[18 : size - 8], -15)


def compressed(data: bytes) -> bytes:
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    packed = c.compress(data) + c.flush()
    return MAGIC + bytes(5) + b"\xff\x06\x00" + EXTRA + struct.pack("<H", len(packed) + 25) + packed + struct.pack("<II", zlib.crc32(data), len(data))


def first_block(f, at: int, size: int) -> int:
    """Where the first block at or after a place begins; size if there is none."""
    f.seek(at)
    seen = f.read(min(1 << 17, size - at))
    k = seen.find(MAGIC)
    while k >= 0:
        if seen[k + 12 : k + 16] == EXTRA:
            try:
                here = Blocks(f, at + k, at + k)
                next(here)
                if here.at >= size or next(here, None) is not None:
                    return at + k
            except zlib.error:
                pass
        k = seen.find(MAGIC, k + 1)
    return size


def plausible(data: bytes, k: int, contigs: int) -> int:
    """The end of the record at k if it may be one, else -1; 0 if data ends before that is known."""
    if k + 36 > len(data):
        return 0
    size, (ref, pos, name, _, _, ops, _, bases, mate, _, _) = struct.unpack_from("<i", data, k)[0], FIXED.unpack_from(data, k + 4)
    if not (32 < size < 1 << 28 and -1 <= ref < contigs and -1 <= mate < contigs and pos >= -1 and name > 0 and bases >= 0 and 32 + name + 4 * ops + (bases + 1) // 2 + bases <= size):
        return -1
    end = k + 36 + name
    return 0 if end > len(data) else (k + 4 + size if data[end - 1] == 0 else -1)


def aligned(data: bytes, contigs: int, last: bool) -> int | None:
    """The first place in data from which eight records follow one another; None if there is none, as more
    data is needed. If data is the last of its file, fewer do that end where it ends."""
    exact = None
    for k in range(len(data)):
        at, seen = k, 0
        while 0 < (at := plausible(data, at, contigs)) <= len(data):
            seen += 1
            if seen == 8:
                return k
            if at == len(data):
                exact = k if exact is None else exact
                break
    return (len(data) if exact is None else exact) if last else None


def starts(data: bytes, k: int) -> tuple[list[int], int]:
    """Where the whole records in data from k on begin, and where the first that is not whole does."""
    out, n, size = [], len(data), struct.Struct("<i").unpack_from
    while k + 4 <= n:
        end = k + 4 + size(data, k)[0]
        if end > n:
            break
        out.append(k)
        k = end
    return out, k


def _gather(buf: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of buf at places, n of each, in a row; and where each begins in them, with an end."""
    upto = np.concatenate([[0], np.cumsum(n)])
    return buf[np.repeat(at - upto[:-1], n) + np.arange(upto[-1])], upto


def _texts(flat: np.ndarray, upto: np.ndarray) -> pa.Array:
    if len(flat) and flat.max() > 127:  # not plain; what is no UTF-8 is replaced
        raw, edges = flat.tobytes(), upto.tolist()
        return pa.array([raw[a:b].decode(errors="replace") for a, b in zip(edges, edges[1:], strict=False)], pa.string())
    return pa.StringArray.from_buffers(len(upto) - 1, pa.py_buffer(upto.astype(np.int32)), pa.py_buffer(flat.astype(np.uint8)))


def _or_star(texts: pa.Array, none: np.ndarray) -> pa.Array:
    return pc.if_else(pa.array(none), "*", texts) if none.any() else texts


def _cigars(buf: np.ndarray, at: np.ndarray, n: np.ndarray) -> pa.Array:
    flat, _ = _gather(buf, at, 4 * n)
    found, which = np.unique(flat.view("<u4"), return_inverse=True)
    said = pa.array([f"{o >> 4}{OPS[o & 15]}" for o in found.tolist()], pa.string())
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32()), said.take(pa.array(which.reshape(-1))))
    return _or_star(pc.binary_join(lists, ""), n == 0)


def _values(buf: np.ndarray, kind: str, at: np.ndarray, zeros: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The values of tags of one kind, as text, and how many bytes each takes."""
    if kind in "ZH":
        n = zeros[np.searchsorted(zeros, at)] - at
        return _texts(*_gather(buf, at, n)), n + 1
    if kind == "A":
        return _texts(*_gather(buf, at, np.ones(len(at), dtype=np.int64))), np.ones(len(at), dtype=np.int64)
    if kind == "B":
        out, n = [], []
        for k in at.tolist():
            of, count = np.dtype("<" + SCALARS[chr(buf[k])]), int(buf[k + 1 : k + 5].view("<i4")[0])
            values = np.frombuffer(buf[k + 5 : k + 5 + count * of.itemsize].tobytes(), of)
            out.append(",".join([chr(buf[k]), *map(str, values.tolist())]))
            n.append(5 + count * of.itemsize)
        return pa.array(out, pa.string()), np.array(n, dtype=np.int64)
    of = np.dtype("<" + SCALARS[kind])
    values = buf[at[:, None] + np.arange(of.itemsize)].view(of).reshape(-1)
    texts = pa.array([str(v) for v in values.tolist()], pa.string()) if kind == "f" else pa.array(values).cast(pa.string())
    return texts, np.full(len(at), of.itemsize, dtype=np.int64)


def _tags(buf: np.ndarray, at: np.ndarray, end: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """HI, and a map of the other tags, of records whose tags stand from at to end. All records' first tags
    are read together, then all second ones, and so on."""
    total, zeros = len(at), np.flatnonzero(buf == 0)
    at, alive = at.copy(), np.flatnonzero(at + 3 <= end)
    rows, codes, values = [], [], []
    while len(alive):
        p = at[alive]
        code, kinds = buf[p].astype(np.int64) << 8 | buf[p + 1], buf[p + 2]
        size = np.zeros(len(alive), dtype=np.int64)
        for kind in np.unique(kinds):
            of = np.flatnonzero(kinds == kind)
            texts, size[of] = _values(buf, chr(kind), p[of] + 3, zeros)
            rows.append(alive[of])
            codes.append(code[of])
            values.append(texts)
        at[alive] += 3 + size
        alive = alive[at[alive] + 3 <= end[alive]]
    if not rows:
        return pa.nulls(total, pa.int32()), pa.MapArray.from_arrays(pa.array(np.zeros(total + 1), pa.int32()), pa.array([], pa.string()), pa.array([], pa.string()))
    row, code, value = np.concatenate(rows), np.concatenate(codes), pa.concat_arrays(values)
    order = np.argsort(row, kind="stable")
    row, code = row[order], code[order]
    if len(np.unique(row << 16 | code)) < len(row):  # of a tag that a record repeats the last one counts
        last = {key: k for k, key in enumerate((row << 16 | code).tolist())}
        keep = np.array(sorted(last.values()))
        order, row, code = order[keep], row[keep], code[keep]
    value = value.take(pa.array(order))
    is_hi = code == (ord("H") << 8 | ord("I"))
    hi = np.full(total, -1, dtype=np.int64)
    hi[row[is_hi]] = np.flatnonzero(is_hi)
    his = value.take(pa.array(hi, mask=hi < 0)).cast(pa.int32())
    rest = np.flatnonzero(~is_hi)
    found, which = np.unique(code[rest], return_inverse=True)
    names = pa.array([chr(c >> 8) + chr(c & 255) for c in found.tolist()], pa.string())
    edges = np.concatenate([[0], np.cumsum(np.bincount(row[rest], minlength=total))])
    return his, pa.MapArray.from_arrays(pa.array(edges, pa.int32()), names.take(pa.array(which.reshape(-1))), value.take(pa.array(rest)))


def fixed_fields(data: bytes, at: np.ndarray) -> np.ndarray:
    """The fixed parts of the records at places in data."""
    buf = np.frombuffer(data, dtype=np.uint8)
    return buf[at[:, None] + np.arange(4, 36)].view(FIELDS).reshape(-1)


def columns(data: bytes, at: np.ndarray, fixed: np.ndarray, contigs: pa.Array, names: list[str]) -> dict[str, pa.Array]:
    """The columns of READS that are named and stand in the records at places in data, of which fixed holds
    the fixed parts. Only what the named columns need is decoded."""
    buf = np.frombuffer(data, dtype=np.uint8)
    n_name, n_ops, n = (fixed[c].astype(np.int64) for c in ("n_name", "n_ops", "n"))
    ops_at = at + 36 + n_name
    seq_at = ops_at + 4 * n_ops
    qual_at = seq_at + (n + 1) // 2
    out: dict[str, pa.Array] = {c: pa.array(fixed[c].astype(np.int32)) for c in NUMBERS if c in names}
    if "contig" in names:
        out["contig"] = contigs.take(pa.array(fixed["ref"], mask=fixed["ref"] < 0))
    if "qname" in names:
        out["qname"] = _texts(*_gather(buf, at + 36, n_name - 1))
    if "cigar" in names:
        out["cigar"] = _cigars(buf, ops_at, n_ops)
    if "seq" in names:
        packed, upto = _gather(buf, seq_at, (n + 1) // 2)
        out["seq"] = _or_star(_texts(*_gather(TWO[packed].reshape(-1), 2 * upto[:-1], n)), n == 0)
    if "qual" in names:
        flat, upto = _gather(buf, qual_at, n)
        none = n == 0
        none[~none] = buf[qual_at[~none]] == 255
        out["qual"] = _or_star(_texts(np.minimum(flat, 93) + 33, upto), none)
    if "hi" in names or "tags" in names:
        end = at + 4 + buf[at[:, None] + np.arange(4)].view("<i4").reshape(-1).astype(np.int64)
        out["hi"], out["tags"] = _tags(buf, qual_at + n, end)
    return out


def packed(row, contigs: dict[str, int]) -> bytes:
    """A record's bytes, with its size."""
    name = row.qname.encode() + b"\0"
    ops, n = [], ""
    for c in row.cigar if row.cigar != "*" else "":
        if c.isdigit():
            n += c
        else:
            ops.append(int(n) << 4 | OPS.index(c))
            n = ""
    seq = "" if row.seq in (None, "*") else row.seq
    codes = [BASES.find(c) if c in BASES else 15 for c in seq] + [0]
    bases = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(seq), 2))
    qual = b"\xff" * len(seq) if row.qual in (None, "*") else bytes(ord(c) - 33 for c in row.qual)
    ref = contigs.get(row.contig, -1) if row.contig is not None else -1
    body = FIXED.pack(ref, row.pos, len(name), row.mapq, 4680, len(ops), row.flag, len(seq), ref, row.mpos, row.isize)
    body += name + struct.pack(f"<{len(ops)}I", *ops) + bases + qual
    if row.hi is not None:
        body += b"HIi" + struct.pack("<i", row.hi)
    for tag, value in sorted((row.tags or {}).items()):
        body += tag.encode() + b"Z" + value.encode() + b"\0"
    return struct.pack("<i", len(body)) + body
