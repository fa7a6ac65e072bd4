"""Tables in the folder that driver and executors share: how long plans cut their lineage."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

#: Folders of stashed tables, in the order they were written.
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is what the session names in ``spark.checkpoint.dir``, else the context's checkpoint
    folder. Only a session of one machine (a local test) that names none gets a folder of
    its own; on a cluster that is an error, since each executor would write to its own disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", "") or spark.sparkContext.getCheckpointDir() or ""
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="textmill-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", named)
    return named


def stash(df: DataFrame, label: str) -> DataFrame:
    """Cut the lineage: write ``df`` to the shared folder and read it back.

    Unlike a local checkpoint this survives the loss of any executor. What nothing will
    read again goes by ``discard``; the rest goes when the session ends.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/textmill-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    _file_system(spark, folder).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def _file_system(spark: SparkSession, path: object) -> object:
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def discard(*tables: DataFrame) -> None:
    """Delete the files of stashed tables that nothing will read again."""
    for df in tables:
        spark = df.sparkSession
        for f in df.inputFiles()[:1]:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f).getParent()
            if path.getName().startswith("textmill-"):
                _file_system(spark, path).delete(path, True)
                _written[:] = [p for p in _written if not p.endswith(f"/{path.getName()}")]


def settle(make: Callable[[], DataFrame], spark: SparkSession, label: str) -> DataFrame:
    """Stash what ``make`` gives and delete the tables that it stashed on its way."""
    before = len(_written)
    out = stash(make(), label)
    for path in _written[before:-1]:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        _file_system(spark, folder).delete(folder, True)
    del _written[before:-1]
    return out


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of any Hadoop file system; what was there is replaced."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = _file_system(spark, target).create(target, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def matches(spark: SparkSession, pattern: str) -> list[str]:
    """The paths of any Hadoop file system that a glob finds, in order."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    return sorted(f.getPath().toString() for f in _file_system(spark, target).globStatus(target) or [])
