"""Aligned reads in BAM files, as a Spark data source.

After ``register(spark)``, ``spark.read.format("bam").load(paths)`` reads files, separated by commas. A file
is read in ranges of compressed blocks, so a large one is many tasks; a range begins at the first block whose
start can be told, and at the first record that is plausible together with those after it. rec_idx is a
record's virtual offset, which orders a file's records. ``.schema(...)`` with some of the columns of READS
reads those alone.

Conditions on contig, pos, mapq, flag, mpos and isize are pushed into the source. Rows that they rule out are
dropped before names, bases and tags are decoded. In a file whose header says that it is sorted by
coordinate, conditions on contig and pos also rule out ranges: the first and the last range that can hold
such a record are found by bisection over the first records of ranges, so a region of a file of n ranges
costs 2 log2(n) small reads at planning and then the ranges that hold it.

Writing gives a folder of BAM files, one a task, each with the header given as option ``contigs``
(name:length, separated by commas) and, if ``sorted`` is true, the claim that it is sorted. Tasks write
attempts into a folder of their own, of which the commit moves those that count into place; a job that fails
leaves nothing. Paths are those that Arrow's file systems open.
"""

from __future__ import annotations

import struct
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, IsNotNull, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from ..schemas import CONTIGS, READS
from .bamcodec import EOF_BLOCK, FIXED, NUMBERS, Blocks, aligned, columns, compressed, first_block, fixed_fields, packed, starts

#: Bytes of a file that a task reads, and of uncompressed data that it decodes at once.
SPLIT, STRETCH = 64 << 20, 2 << 20
#: Where unmapped records stand among contigs: after all.
UNMAPPED = 1 << 31
Key = tuple[int, int]


def _open(path: str):
    from pyarrow import fs

    if path.startswith("file:/") and not path.startswith("file://"):
        path = path[5:]
    system, inner = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    return system, inner


@dataclass
class Header:
    """contigs with their lengths, the virtual offset of the first record, and whether records are said to
    be sorted by contig and position."""

    contigs: list[tuple[str, int]]
    first: int
    by_place: bool


def read_header(path: str) -> Header:
    system, inner = _open(path)
    with system.open_input_file(inner) as f:
        data, begins, blocks = b"", [], Blocks(f, 0, 0)

        def need(n: int) -> None:
            nonlocal data
            while len(data) < n:
                found = next(blocks, None)
                if found is None:
                    raise ValueError(f"{path} ends within its header")
                begins.append((len(data), found[0]))
                data += found[1]

        need(8)
        if data[:4] != b"BAM\1":
            raise ValueError(f"{path} is not a BAM file")
        k = 8 + struct.unpack_from("<i", data, 4)[0]
        need(k + 4)
        lines = data[8:k].decode(errors="replace").splitlines()
        n, k = struct.unpack_from("<i", data, k)[0], k + 4
        out = []
        for _ in range(n):
            need(k + 4)
            m = struct.unpack_from("<i", data, k)[0]
            need(k + 8 + m)
            out.append((data[k + 4 : k + 3 + m].decode(), struct.unpack_from("<i", data, k + 4 + m)[0]))
            k += 8 + m
        begin, block = max(((b, a) for b, a in begins if b <= k), default=(0, 0))
        first = (blocks.at << 16) if k == len(data) else (block << 16) | (k - begin)
        return Header(out, first, any(line.startswith("@HD") and "SO:coordinate" in line.split("\t") for line in lines))


def header(path: str) -> tuple[list[tuple[str, int]], int]:
    """The contigs of a file with their lengths, and the virtual offset of its first record."""
    found = read_header(path)
    return found.contigs, found.first


def contigs(spark: SparkSession, paths: str) -> DataFrame:
    """CONTIGS of files, separated by commas: contig_idx, contig and length, as their headers have them. Raises
    unless all files have the same. A header is read by the driver, as it holds thousands of contigs at most."""
    heads = [read_header(p.strip()).contigs for p in paths.split(",")]
    if any(h != heads[0] for h in heads):
        raise ValueError("the headers of the input files differ")
    return spark.createDataFrame([(k, c, n) for k, (c, n) in enumerate(heads[0])], CONTIGS)


def files(folder: str) -> str:
    """The files that were written to a folder, as load() takes them."""
    from pyarrow import fs

    system, inner = _open(folder)
    found = sorted(f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.path.endswith(".bam"))
    return ",".join(folder.rstrip("/") + "/" + p.rpartition("/")[2] for p in found)


@dataclass
class Range(InputPartition):
    path: str
    file_idx: int
    start: int
    end: int


@dataclass
class Wanted:
    """What pushed conditions leave: tests of rows, and the first and last place of a sorted file that a
    row may have."""

    tests: list[tuple[str, str, object]] = field(default_factory=list)

    SIGNS = {EqualTo: "=", LessThan: "<", LessThanOrEqual: "<=", GreaterThan: ">", GreaterThanOrEqual: ">=", In: "in"}

    def take(self, f: Filter) -> bool:
        """Whether the condition is one that the source sees to wholly."""
        if isinstance(f, IsNotNull) and f.attribute[0] in (*NUMBERS, "contig"):
            if f.attribute == ("contig",):
                self.tests.append(("contig", "there", None))
            return True
        sign = self.SIGNS.get(type(f))
        if sign is None or len(f.attribute) != 1 or f.value is None:
            return False
        (name,) = f.attribute
        if name in NUMBERS and sign != "in" or name == "contig" and sign in ("=", "in"):
            self.tests.append((name, sign, f.value))
            return True
        return False

    def rows(self, fixed: np.ndarray, names: list[str]) -> np.ndarray:
        """Which records of these fixed parts hold."""
        out = np.ones(len(fixed), dtype=bool)
        for name, sign, value in self.tests:
            if name == "contig":
                ref = fixed["ref"]
                out &= ref >= 0 if sign == "there" else np.isin(ref, self._contigs(sign, value, names))
            else:
                x = fixed[name]
                out &= {"=": x == value, "<": x < value, "<=": x <= value, ">": x > value, ">=": x >= value}[sign]
        return out

    @staticmethod
    def _contigs(sign: str, value, names: list[str]) -> list[int]:
        named = {value} if sign == "=" else set(value)
        return [k for k, c in enumerate(names) if c in named]

    def span(self, names: list[str]) -> tuple[Key, Key] | None:
        """The first and the last (contig, pos) that may hold; None if none may."""
        found, low, high = set(range(len(names))) | {UNMAPPED}, -1, UNMAPPED
        for name, sign, value in self.tests:
            if name == "contig":
                found &= set(range(len(names)) if sign == "there" else self._contigs(sign, value, names))
            elif name == "pos":
                low = max(low, {"=": value, ">": value + 1, ">=": value}.get(sign, low))
                high = min(high, {"=": value, "<": value - 1, "<=": value}.get(sign, high))
        return ((min(found), low), (max(found), high)) if found and low <= high else None


class BamReader(DataSourceReader):
    def __init__(self, options: dict, schema: StructType = READS) -> None:
        self.paths = [p.strip() for p in options["path"].split(",")]
        self.split = int(options.get("splitBytes", SPLIT))
        self.names = schema.names
        if unknown := set(self.names) - set(READS.names):
            raise ValueError(f"reads have no column {', '.join(sorted(unknown))}")
        self.wanted = Wanted()

    @cached_property
    def heads(self) -> list[Header]:
        with ThreadPoolExecutor(16) as pool:
            heads = list(pool.map(read_header, self.paths))
        if any(h.contigs != heads[0].contigs for h in heads):
            raise ValueError("the headers of the input files differ")
        return heads

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def partitions(self) -> list[Range]:
        with ThreadPoolExecutor(16) as pool:
            return [r for found in pool.map(self._ranges, range(len(self.paths))) for r in found]

    def _ranges(self, k: int) -> list[Range]:
        """The ranges of a file that may hold what is wanted."""
        path, head = self.paths[k], self.heads[k]
        system, inner = _open(path)
        size = system.get_file_info(inner).size
        all_ranges = [Range(path, k, at, min(size, at + self.split)) for at in range(0, size, self.split)]
        span = self.wanted.span([c for c, _ in head.contigs])
        if span is None:
            return []
        if not head.by_place or len(all_ranges) < 2:
            return all_ranges
        with system.open_input_file(inner) as f:
            key = lambda r: self._first_key(f, r.start, head)
            # a range's records stand between its own first one and the next range's
            begin = bisect_left(all_ranges, span[0], lo=1, key=key) - 1
            end = bisect_right(all_ranges, span[1], lo=begin + 1, key=key)
        return all_ranges[begin:end]

    @staticmethod
    def _begin(f, start: int, head: Header) -> tuple[int, int]:
        """The first block of a range, and what of it to skip; -1 where that is yet to be found."""
        if start <= head.first >> 16:
            return head.first >> 16, head.first & 0xFFFF
        return first_block(f, start, f.size()), -1

    def _first_key(self, f, start: int, head: Header) -> Key:
        """The place of the first record that begins at or after a place of a sorted file."""
        at, skip = self._begin(f, start, head)
        data, blocks = b"", Blocks(f, at, at)
        while True:
            found = next(blocks, None)
            data += found[1] if found else b""
            k = skip if skip >= 0 else aligned(data, len(head.contigs), found is None)
            if k is not None and k + 36 <= len(data):
                ref, pos = FIXED.unpack_from(data, k + 4)[:2]
                return (ref if ref >= 0 else UNMAPPED, pos)
            if found is None:
                return (UNMAPPED + 1, 0)

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        """The records that begin in blocks that begin in the range, as Arrow batches."""
        head = read_header(part.path)
        names = [c for c, _ in head.contigs]
        span, by_name = self.wanted.span(names), pa.array(names, pa.string())
        system, inner = _open(part.path)
        with system.open_input_file(inner) as f:
            at, skip = self._begin(f, part.start, head)
            if at >= part.end or span is None:
                return
            blocks = Blocks(f, at, part.end)
            data, begins, places = b"", [], []  # where blocks begin in data, and in the file
            done = False
            while not done:
                parts, size = [data], len(data)
                while size < STRETCH or len(parts) == 1:
                    # beyond the range only what its last record still needs is read
                    if blocks.at >= part.end and len(parts) > 1 and (skip >= 0 or size > 1 << 18):
                        break
                    found = next(blocks, None)
                    if found is None:
                        done = True
                        break
                    begins.append(size)
                    places.append(found[0])
                    parts.append(found[1])
                    size += len(found[1])
                data = b"".join(parts)
                if skip < 0:
                    if (k := aligned(data, len(names), done)) is None:
                        continue
                    skip = k
                whole, rest = starts(data, max(skip, 0))
                skip = 0
                offsets = np.array(whole, dtype=np.int64)
                begin, place = np.array(begins, dtype=np.int64), np.array(places, dtype=np.int64)
                block = np.searchsorted(begin, offsets, side="right") - 1
                inside = place[block] < part.end if len(offsets) else np.zeros(0, dtype=bool)
                if len(offsets) and not inside.all():
                    done = True
                offsets, block = offsets[inside], block[inside]
                if len(offsets):
                    fixed = fixed_fields(data, offsets)
                    if head.by_place:
                        last = fixed[-1]
                        done |= (int(last["ref"]) if last["ref"] >= 0 else UNMAPPED, int(last["pos"])) > span[1]
                    keep = self.wanted.rows(fixed, names)
                    if keep.any():
                        index = place[block[keep]] << 16 | (offsets[keep] - begin[block[keep]])
                        yield self._batch(part, data, offsets[keep], fixed[keep], index, by_name)
                # the next stretch begins with the record that is not whole, in the block it begins in
                held = max(int(np.searchsorted(begin, rest, side="right")) - 1, 0)
                done |= blocks.at >= part.end and (rest >= len(data) or not places or places[held] >= part.end)
                begins, places = [b - rest for b in begins[held:]], places[held:]
                data = data[rest:]
                if not data:
                    begins, places = [], []

    def _batch(self, part: Range, data: bytes, offsets: np.ndarray, fixed: np.ndarray, index: np.ndarray, contigs: pa.Array) -> pa.RecordBatch:
        found = columns(data, offsets, fixed, contigs, self.names)
        found |= {"file_idx": pa.array(np.full(len(offsets), part.file_idx, dtype=np.int32)), "rec_idx": pa.array(index)}
        return pa.RecordBatch.from_arrays([found[c] for c in self.names], names=self.names)


@dataclass
class Written(WriterCommitMessage):
    name: str
    part: int


class BamWriter(DataSourceWriter):
    def __init__(self, options: dict, overwrite: bool = False) -> None:
        self.path, self.overwrite, self.id = options["path"], overwrite, uuid.uuid4().hex
        self.contigs = [(c.rpartition(":")[0], int(c.rpartition(":")[2])) for c in options["contigs"].split(",")]
        self.order = "coordinate" if options.get("sorted", "false").lower() == "true" else "unknown"

    def _folders(self):
        """The file system, where the files belong, and where attempts are written."""
        system, inner = _open(self.path)
        return system, inner, f"{inner}/_attempts-{self.id}"

    def write(self, rows: Iterator) -> WriterCommitMessage:
        from pyspark import TaskContext

        context = TaskContext.get()
        system, _, attempts = self._folders()
        system.create_dir(attempts, recursive=True)
        text = f"@HD\tVN:1.6\tSO:{self.order}\n" + "".join(f"@SQ\tSN:{c}\tLN:{n}\n" for c, n in self.contigs)
        head = b"BAM\1" + struct.pack("<i", len(text)) + text.encode() + struct.pack("<i", len(self.contigs))
        head += b"".join(struct.pack("<i", len(c) + 1) + c.encode() + b"\0" + struct.pack("<i", n) for c, n in self.contigs)
        index = {c: k for k, (c, _) in enumerate(self.contigs)}
        name = f"{context.partitionId():05d}-{context.taskAttemptId()}.bam"
        with system.open_output_stream(f"{attempts}/{name}") as out:
            for k in range(0, len(head), 60_000):
                out.write(compressed(head[k : k + 60_000]))
            held = b""
            for row in rows:
                one = packed(row, index)
                if held and len(held) + len(one) > 60_000:
                    out.write(compressed(held))
                    held = b""
                held += one
                while len(held) > 60_000:
                    out.write(compressed(held[:60_000]))
                    held = held[60_000:]
            if held:
                out.write(compressed(held))
            out.write(EOF_BLOCK)
        return Written(name, context.partitionId())

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        """Move the attempts that count into place. Files of another write stay, unless they are to be
        overwritten; attempts that failed or came second go with their folder."""
        from pyarrow import fs

        system, inner, attempts = self._folders()
        system.create_dir(inner, recursive=True)
        old = [f.path for f in system.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File and f.path.endswith(".bam")] if self.overwrite else []
        for m in messages:
            if m is not None:
                system.move(f"{attempts}/{m.name}", f"{inner}/part-{m.part:05d}-{self.id}.bam")
        for path in old:
            system.delete_file(path)
        self._clear(system, attempts)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        system, _, attempts = self._folders()
        self._clear(system, attempts)

    @staticmethod
    def _clear(system, attempts: str) -> None:
        from pyarrow import fs

        if system.get_file_info(attempts).type != fs.FileType.NotFound:
            system.delete_dir(attempts)


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> StructType:
        return READS

    def reader(self, schema: StructType) -> BamReader:
        return BamReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> BamWriter:
        return BamWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Let this session read and write the format bam, with conditions pushed into the reader, which Spark
    leaves off for Python sources unless told."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)
