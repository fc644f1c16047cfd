"""Helpers shared by the corpus operators."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

#: The white space between words, and a run of anything else.
BLANK = "\\x20\\x09-\\x0D"
WORD = f"[^{BLANK}]+"
#: Rows a side may have before it is no longer broadcast.
BROADCAST_ROWS = 400_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between steps: the cluster's ``spark.checkpoint.dir``. Only where that is
    unset and all runs on one machine, as in tests, a temporary one is made."""
    sc = spark.sparkContext
    if (folder := sc.getCheckpointDir()) is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="siftloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
        folder = sc.getCheckpointDir()
    return folder


#: Folders of the tables written so far, and how to delete one.
_TABLES: list[str] = []
_DELETE: list[Callable[[str], None]] = []


def new_folder(spark: SparkSession, name: str = "table") -> str:
    """A folder for a table between steps, which is deleted when the process ends if not before."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
    if not _DELETE:
        conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs

        def delete(folder: str) -> None:
            path = hadoop.Path(folder)
            path.getFileSystem(conf).delete(path, True)

        def last() -> None:
            with contextlib.suppress(Exception):  # the session may be gone, and its folder with it
                drop_tables(0)

        _DELETE.append(delete)
        atexit.register(last)
    _TABLES.append(folder)
    return folder


def tables_so_far() -> int:
    return len(_TABLES)


def newest_table() -> str:
    return _TABLES[-1]


def drop_tables(since: int, but: str | Collection[str] = ()) -> None:
    """Delete the tables written since then (a number from tables_so_far), for a caller that has
    written out what was made of them; but: those to keep."""
    kept = {but} if isinstance(but, str) else {*but}
    for folder in _TABLES[since:]:
        if folder not in kept:
            _DELETE[0](folder)
    _TABLES[since:] = [folder for folder in _TABLES[since:] if folder in kept]


@contextlib.contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Within this, what a query has shuffled is deleted as soon as the query ends, and not when the
    driver next collects its garbage, before which the shuffles of several queries add up."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """Write df as a table to the shared folder and go on from that, without its history."""
    folder = new_folder(df.sparkSession)
    with shuffles_end(df.sparkSession):
        df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def maybe_broadcast(df: DataFrame, rows: int, most: int = BROADCAST_ROWS) -> DataFrame:
    """Mark df, counted to have so many narrow rows, for broadcast if that is few enough; beyond
    that the join shuffles both sides and adaptive execution splits what is skewed."""
    return F.broadcast(df) if rows <= most else df.hint("merge")


def ascii_lower(c: Column) -> Column:
    """c with only A to Z lowered."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, upper, lower))


def word_count(c: Column) -> Column:
    """Number of words of c, 0 for null."""
    return F.coalesce(F.regexp_count(c, F.lit(WORD)), F.lit(0)).cast("long")


def crc_mod(c: Column, n: int) -> Column:
    """crc32 of c as text, modulo n; null ids count as the empty string."""
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % n


#: The most bytes of a batch that goes to a Python worker, unless the session sets its own; and Spark's default.
BATCH, DEFAULT_BATCH = "1048576b", "67108864b"


def in_arrow(df: DataFrame, work, schema) -> DataFrame:
    """df.mapInArrow, in batches of a MB: both the executor and its worker hold one at a time."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if conf.get(name) == DEFAULT_BATCH:
        conf.set(name, BATCH)
    return df.mapInArrow(work, schema)


def byte_slices(column, most: int = 512 << 10):
    """(start, rows) of consecutive slices of an Arrow string column, each of one row or at most
    most bytes. What Arrow held for the slice before is given back to the system."""
    start, size = 0, 0
    for k, n in enumerate(pc.fill_null(pc.binary_length(column), 0).to_pylist()):
        if k > start and size + n > most:
            yield start, k - start
            pa.default_memory_pool().release_unused()
            start, size = k, 0
        size += n
    if len(column) > start:
        yield start, len(column) - start


def give_back() -> None:
    """Return what a task's Python worker has freed to the system; the worker itself goes on."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only the GNU library has it
        ctypes.CDLL("libc.so.6").malloc_trim(0)


class Recent(dict):
    """What was worked out for short texts lately, in two tables of so many bytes each: when the newer
    one is full the older one goes, and what is asked for again moves to the newer one."""

    def __init__(self, make: Callable[[str], bytes | int], most: int = 96 << 20) -> None:
        self.make, self.most, self.held, self.old = make, most, 0, {}

    def __missing__(self, text: str) -> bytes | int:
        value = self.old.pop(text, None)
        if value is None:
            value = self.make(text)
        if len(text) <= 64:
            self.held += 240 + 2 * len(text)  # a string, a value and their place in the table
            if self.held > self.most:
                self.old, self.held = self.copy(), 0
                self.clear()
            self[text] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.old, self.held = {}, 0


def schema_and(df: DataFrame, **more: str) -> StructType:
    """df's schema and more columns after it."""
    return StructType([*df.schema.fields, *(StructField(c, _parse(kind)) for c, kind in more.items())])


def _parse(kind: str) -> DataType:
    return StructType.fromDDL(f"c {kind}")["c"].dataType


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of all texts in a row, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    sizes = lists.value_lengths().to_numpy().astype(np.int64)
    words = lists.flatten()
    there = pc.not_equal(words, "")  # white space at either end leaves an empty word
    text = np.repeat(np.arange(len(sizes)), sizes)
    return words.filter(there), np.bincount(text[there.to_numpy(zero_copy_only=False)], minlength=len(sizes))
