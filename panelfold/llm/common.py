"""Shared helpers: tables, staged results and byte-bounded Arrow batches."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelfold.session import scratch_dir, stage

__all__ = ["as_schema", "by_bytes", "discard", "fold", "importable", "key_bitmap", "may_hold", "read", "settle", "stage", "scratch_dir", "temp_name", "text_of"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it.

    For local sessions; a cluster has the package installed or given with ``--py-files``, and a folder that
    a worker does not have is passed over.
    """
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in known:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, known)])


def text_of(column: str) -> Column:
    """The whole text; NULL counts as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("string"), F.lit(""))


def temp_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base = f"_{base}"
    return base


_KINDS = {"int": T.IntegerType, "long": T.LongType, "double": T.DoubleType, "string": T.StringType, "binary": T.BinaryType, "boolean": T.BooleanType}


def as_schema(*fields: tuple[str, str]) -> T.StructType:
    return T.StructType([T.StructField(n, _KINDS[t]()) for n, t in fields])


def fold(column: str, parts: int) -> Column:
    """The fold of an id: crc32 of its text, modulo ``parts``."""
    return F.crc32(F.col(f"`{column}`").cast("string").cast("binary")) % F.lit(parts)


def by_bytes(batches, column: int, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of Arrow batches whose texts hold about ``limit`` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, done + limit, "right")))
            yield batch.slice(at, to - at)
            at = to


_SLOTS = 28  # bits of a bitmap's address at most: 32 MB, an eighth full with 2^25 keys
_SLICE = 1 << 16  # words of a bitmap that travel in one row


def key_bitmap(table: DataFrame, key: str = "key") -> np.ndarray:
    """Which leading bits of the 64-bit keys occur, as words of 64; there are about eight places a key, up to a bound."""
    slots = min(_SLOTS, max(16, (8 * table.count()).bit_length()))

    def marked(batches):
        bits = np.zeros(1 << (slots - 6), np.uint64)
        for batch in batches:
            slot = np.unique(batch.column(0).drop_null().to_numpy().view(np.uint64) >> np.uint64(64 - slots))
            at = slot >> np.uint64(6)
            starts = np.flatnonzero(np.diff(at, prepend=~at[:1]))
            if len(slot):
                bits[at[starts]] |= np.bitwise_or.reduceat(np.uint64(1) << (slot & np.uint64(63)), starts)
        for at in range(0, len(bits), _SLICE):
            if bits[at : at + _SLICE].any():
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([bits[at : at + _SLICE].tobytes()], pa.binary())], names=["at", "bits"])

    def merged(batches):
        at, bits = None, None
        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = np.frombuffer(b.as_py(), np.uint64)
                if at is not None and a != at:
                    yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([bits.tobytes()], pa.binary())], names=["at", "bits"])
                at, bits = a, words if a != at else bits | words
        if at is not None:
            yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), pa.array([bits.tobytes()], pa.binary())], names=["at", "bits"])

    slices = table.select(key).mapInArrow(marked, "at long, bits binary").repartition("at").sortWithinPartitions("at")
    out = np.zeros(1 << (slots - 6), np.uint64)
    found = slices.mapInArrow(merged, "at long, bits binary").toArrow()
    for at, bits in zip(found["at"].to_pylist(), found["bits"].to_pylist()):
        out[at : at + _SLICE] = np.frombuffer(bits, np.uint64)
    return out


def may_hold(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each 64-bit key may be one of the bitmap's; no key of its own is ruled out."""
    slot = keys.view(np.uint64) >> np.uint64(58 - (len(bitmap) - 1).bit_length())
    return (bitmap[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def settle(df: DataFrame, label: str) -> DataFrame:
    """``stage``, after which nothing before it is needed: the driver drops shuffles no plan refers to any more."""
    out = stage(df, label)
    gc.collect()  # plans that only cycles of Python objects refer to
    df.sparkSession.sparkContext._jvm.System.gc()
    return out


def discard(staged: DataFrame) -> None:
    """Delete a staged table once all that was made of it is staged itself."""
    spark = staged.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
