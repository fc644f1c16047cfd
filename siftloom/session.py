"""Getting this package to the executors."""

from __future__ import annotations

import atexit
import contextlib
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let the executors of this session import the package; Spark hands it to those that join later
    or replace a lost one. Does nothing the second time."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    top = Path(__file__).resolve().parent
    folder = tempfile.mkdtemp(prefix="siftloom-code-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    with zipfile.ZipFile(f"{folder}/siftloom_code.zip", "w") as z:
        for p in sorted(top.rglob("*.py")):
            z.write(p, p.relative_to(top.parent))
    sc.addPyFile(f"{folder}/siftloom_code.zip")
    _SHIPPED.add(sc.applicationId)


def shared_folder(spark: SparkSession) -> str:
    """The folder for tables between steps: the cluster's ``spark.checkpoint.dir``. Only where that is
    unset and all runs on one machine, as in tests, a temporary one is made."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
                raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="siftloom-")
            atexit.register(shutil.rmtree, folder, ignore_errors=True)
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


#: Folders of tables that were written between steps, oldest first, and how to delete one.
_FOLDERS: list[str] = []
_DELETE: list[Callable[[str], None]] = []


def new_folder(spark: SparkSession, name: str = "table") -> str:
    """A folder in the shared one, which is deleted when the process ends if drop_folders has not."""
    folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4()}"
    if not _DELETE:
        conf, hadoop = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs

        def delete(folder: str) -> None:
            path = hadoop.Path(folder)
            path.getFileSystem(conf).delete(path, True)

        def last() -> None:
            with contextlib.suppress(Exception):  # the session may be gone, and its folder with it
                drop_folders(0)

        _DELETE.append(delete)
        atexit.register(last)
    _FOLDERS.append(folder)
    return folder


def folders_so_far() -> int:
    return len(_FOLDERS)


def drop_folders(since: int, but: str | None = None) -> None:
    """Delete the tables written since then (a number from folders_so_far), for a caller that has written
    out what was made of them; but: one to keep."""
    for folder in _FOLDERS[since:]:
        if folder != but:
            _DELETE[0](folder)
    _FOLDERS[since:] = [folder for folder in _FOLDERS[since:] if folder == but]


def settled(df: DataFrame, name: str = "reads") -> DataFrame:
    """df written once to the shared folder, for plans that read it several times or that end its history."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
