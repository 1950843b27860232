"""Shared helpers: the folder all executors share, written intermediates, column checks."""

from __future__ import annotations

import ctypes
import gc
import sys
import tempfile
import types
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


HEAVY = 10_000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Only a local session (tests) may leave it unset: it gets a temporary folder."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tidelog-")
        spark.sparkContext.setCheckpointDir(root)
    return root


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/tidelog-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet in the shared folder and read again: lineage ends here and lost executors cost nothing."""
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The same, and the folder, for callers that can tell when nothing reads it any more (``drop_path``)."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    if _PASSING:
        _PASSING[-1].append(path)
    return spark.read.schema(df.schema).parquet(path), path


_PASSING: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """What is ``written`` within goes at the end; what the yielded function writes, and results need, stays."""
    mine: list[str] = []

    def kept(df: DataFrame, name: str) -> DataFrame:
        found, path = written_at(df, name)
        mine.remove(path)
        return found

    _PASSING.append(mine)
    try:
        yield kept
    finally:
        _PASSING.remove(mine)
        for path in mine:
            drop_path(spark, path)
        # Spark frees shuffle files, broadcasts and plans of frames that nobody holds once the driver's collectors have run.
        gc.collect()
        spark.sparkContext._jvm.System.gc()


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or the like that ``df`` doesn't have as a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def join_by_size(rows: DataFrame, found: DataFrame, key: str, count: str) -> DataFrame:
    """``rows`` joined with ``found`` (unique in ``key``) where ``count`` says how many of the rows have a key.

    Keys that over a ``HEAVY``-th of all rows have are broadcast, so there are fewer than HEAVY of them at any size; the
    rest is shuffled, and no task gets more than that share for one key. Both tables should be written ones."""
    bound = (found.agg(F.sum(count)).first()[0] or 0) / HEAVY
    heavy, light = found.where(F.col(count) > bound), found.where(F.col(count) <= bound)
    hot = rows.join(F.broadcast(heavy), key)
    return hot.unionByName(rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key).select(hot.columns))


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove an intermediate that no lazily read result needs any more."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _state() -> dict[str, Any]:
    return sys.modules.setdefault("tidelog_worker_state", types.ModuleType("tidelog_worker_state")).__dict__.setdefault("held", {})


def held(name: str, make: Callable[[], Any]) -> Any:
    """``make()``'s result, made once a Python process and kept for its later tasks: functions travel by value, so a global of theirs lives for one task only. Only the last few names are kept."""
    state = _state()
    if name not in state:
        while len(state) >= 4:
            state.pop(next(iter(state)))
        state[name] = make()
    return state[name]


def give_back() -> None:
    """Memory that a Python process has freed goes back to the system: Arrow's pool and the C library keep it otherwise."""
    import pyarrow as pa  # the native operators load none

    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)


def lean(run: Callable[[Iterator[Any]], Iterator[Any]]) -> Callable[[Iterator[Any]], Iterator[Any]]:
    """``run`` for mapInArrow in a stage that holds nothing. A worker outlives its tasks, and its memory is the executor's,
    also while stages without Python run: what earlier stages ``held`` goes first, what the task has freed at its end."""

    def task(batches: Iterator[Any]) -> Iterator[Any]:
        _state().clear()
        yield from run(batches)
        give_back()

    return task


def text_bytes(column) -> F.Column:
    """The text's UTF-8 bytes; null counts as empty."""
    return F.encode(F.coalesce(column, F.lit("")), "UTF-8")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
