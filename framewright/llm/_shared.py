"""The shared working folder and file access from tasks."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from framewright import ship_to_workers


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors share.  Where
    it is unset, which only a local master may leave so, a folder that goes
    when this process ends."""
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    own = tempfile.mkdtemp(prefix="framewright-")
    atexit.register(shutil.rmtree, own, ignore_errors=True)
    sc.setCheckpointDir(f"file://{own}")
    return f"file://{own}"


def work_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


_STORED: list[str] = []


def stored(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write a table to the shared folder and read it: its lineage ends there,
    and a lost executor costs no recomputation of what went before.  ``kept``:
    only ``forget`` by name deletes it."""
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    if not kept:
        _STORED.append(path)
    table = spark.read.schema(df.schema).parquet(path)
    table.stored_at = path
    return table


def forget(spark: SparkSession, *tables: DataFrame) -> None:
    """Delete stored tables that nothing will read again; all, if none is named."""
    paths = [t.stored_at for t in tables] if tables else list(_STORED)
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        if path in _STORED:
            _STORED.remove(path)
    trim()


BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def prepared(spark: SparkSession) -> None:
    """Ship the package to the workers, and let Arrow batches of wide rows have
    some megabytes, unless the session says otherwise than Spark's default."""
    ship_to_workers(spark)
    if spark.conf.get(BATCH, None) == "67108864b":
        spark.conf.set(BATCH, str(BATCH_BYTES))


def tidy(run: Callable, encodes: bool = False) -> Callable:
    """A function for mapInArrow that gives its memory back to the system at
    the end of a task, as the worker is used again.  Words that tokenizers
    remember stay for other tasks that encode."""

    def tidied(batches):
        import sys

        if not encodes and "framewright.llm._tokens" in sys.modules:
            sys.modules["framewright.llm._tokens"].release()
        try:
            yield from run(batches)
        finally:
            trim()

    return tidied


def trim() -> None:
    """Give unused memory of this process back to the system."""
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    give = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give:
        give(0)


def filesystem(uri: str):
    """(file system, path) of a URI, for reading and writing from tasks."""
    from pyarrow import fs

    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), os.path.abspath(uri)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


@contextmanager
def task_file(folder: str, name: str) -> Iterator:
    """A binary file that appears under its name only when it is complete, so
    that a task lost half-way or run twice leaves one whole file."""
    system, root = filesystem(folder)
    system.create_dir(root, recursive=True)
    context = TaskContext.get()
    part = f"{root}/.{name}.{context.taskAttemptId() if context else uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        yield out
    system.move(part, f"{root}/{name}")
