"""Helpers that the corpus operators share."""

from __future__ import annotations

import contextlib
import ctypes
import sys
import tempfile
import uuid
from types import ModuleType

import numpy as np
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of ASCII white space that separate words: ``[\x20\x09-\x0D]``.
SPACE_BYTES = b" \t\n\x0b\x0c\r"
SPACE_CHARS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only a session on one machine (tests) may have none; it gets a local folder.
    On a cluster a folder of the driver's is of no use to executors: an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        path = "file://" + tempfile.mkdtemp(prefix="kinlink-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


_made: list[list[str]] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs no recomputation of what is
    stored, and a plan that reads it twice does not run twice.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    if _made:
        _made[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(make, name: str, spark: SparkSession) -> DataFrame:
    """What ``make()`` gives, stored; everything that was stored on the way is deleted."""
    _made.append([])
    try:
        out = make()
        path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        out.write.option("compression", "zstd").parquet(path)
    finally:
        for used in _made.pop():
            at = spark._jvm.org.apache.hadoop.fs.Path(used)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return spark.read.schema(out.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only; ``lower`` would also change other letters."""
    return F.when(F.length(c) == F.octet_length(c), F.lower(c)).otherwise(F.translate(c, UPPER, UPPER.lower()))


def count_partitions(rows: int, each: int, least: int = 1) -> int:
    return max(least, -(-rows // each))


def packed(a: np.ndarray) -> bytes:
    """A list of integers in few bytes: by byte planes, compressed."""
    a = np.asarray(a, dtype="<i8")
    return zstandard.ZstdCompressor(level=1).compress(a.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(b: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), dtype=np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<i8").ravel()


def kept_in_worker(name: str, make):
    """An object that a Python worker keeps from one task to the next; functions pickled by value have no globals that last."""
    held = sys.modules.setdefault("kinlink_worker_state", ModuleType("kinlink_worker_state")).__dict__
    if name not in held:
        held[name] = make()
    return held[name]


def given_back() -> None:
    """Return what a Python worker no longer uses to the system, for the JVM beside it."""
    import pyarrow as pa

    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)
