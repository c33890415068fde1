"""What the operators share: the cluster's shared folder, Arrow mapping, skew-safe lookups."""

from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterable, Iterator
from typing import Any

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side that is broadcast holds at most this many bytes, measured before it is sent.
BROADCAST_LIMIT_BYTES = 64 << 20
#: A class of rows is hot if it holds at least one row in HOT_SHARE; so there are at most HOT_SHARE of them.
HOT_SHARE = 500

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()


def shared_root(spark: SparkSession) -> str:
    """spark.checkpoint.dir of the session; where it is unset, a temporary folder if all runs in one process, as in tests, else an error."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir is not set: executors on other machines need a shared folder")
        root = "file://" + os.path.join(tempfile.gettempdir(), "quadrille-shared")
    return root.rstrip("/")


def spare(taken: Iterable[str], name: str) -> str:
    """A column name that none of the names is, whatever their case."""
    have = {x.lower() for x in taken}
    while name.lower() in have:
        name += "_"
    return name


def shared_folder(spark: SparkSession, label: str) -> str:
    """The URI of a new folder under the shared root, that all executors see."""
    return f"{shared_root(spark)}/quadrille/{label}-{uuid.uuid4().hex[:12]}"


def prepare(spark: SparkSession) -> None:
    """Arrow batches of few rows, as single texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")


def stored(df: DataFrame, label: str) -> DataFrame:
    """df, written to the shared folder and read back: it cuts the lineage, and survives lost executors."""
    spark = df.sparkSession
    path = shared_folder(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def open_fs(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI, on the driver or an executor."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("/") else os.path.abspath(uri))


def write_atomically(uri: str, chunks: Iterable[bytes]) -> int:
    """Writes under another name, then renames, so that a retried or doubled task leaves one whole file."""
    fs, path = open_fs(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    part = f"{path}.{uuid.uuid4().hex[:8]}.part"
    size = 0
    with fs.open_output_stream(part, compression=None) as out:
        for x in chunks:
            out.write(x)
            size += len(x)
    fs.move(part, path)
    return size


_KEPT: dict[Hashable, Any] = {}
_USED: set[Hashable] = set()


def kept(key: Hashable, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task, until a task ends that did not ask for it: workers outlive stages and queries."""
    _USED.add(key)
    if key not in _KEPT:
        _KEPT[key] = make()
    return _KEPT[key]


def give_back() -> None:
    """Drops what this task did not use, and returns a process's free memory to the system: workers live on between stages, and their free pages count beside the JVM's."""
    for key in _KEPT.keys() - _USED:
        del _KEPT[key]
    _USED.clear()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have none
        ctypes.CDLL(None).malloc_trim(0)


def map_arrow(df: DataFrame, each: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    prepare(df.sparkSession)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from each(batches)
        finally:
            give_back()

    return df.mapInArrow(task, schema)


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def null_safe_id(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("\x00"))


def lookup(rows: DataFrame, classes: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """rows left-joined with classes, one row per key, of which column `size` counts the rows.

    Classes of at least total / HOT_SHARE rows are at most HOT_SHARE in number, and are broadcast;
    so in the shuffled join no key holds more than that share. Null keys match nothing."""
    floor = max(1000, total // HOT_SHARE)
    hot = classes.where(F.col(size) >= floor)
    cold = classes.where(F.col(size) < floor)
    values = [c for c in classes.columns if c != key]
    k, h = spare([*rows.columns, *values], "_k"), spare([*rows.columns, *values], "_hot")
    kept = [F.col(f"`{c}`") for c in rows.columns]
    found = rows.join(F.broadcast(hot.select(F.col(key).alias(k), F.struct(*values).alias(h))), F.col(key) == F.col(k), "left").drop(k)
    missed = found.where(F.col(h).isNull()).drop(h).join(cold.select(F.col(key).alias(k), *values), F.col(key) == F.col(k), "left").drop(k)
    return found.where(F.col(h).isNotNull()).select(*kept, *[F.col(f"{h}.{v}").alias(v) for v in values]).unionByName(missed.select(*kept, *values))
