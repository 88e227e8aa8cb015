"""Small helpers of the training-data operators."""

from __future__ import annotations

import ctypes
import gc

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


_HELD: dict = {}


def release() -> None:
    """Drop what :func:`held` keeps and hand free memory back to the system.

    A Python worker serves one stage after another beside the executor's JVM;
    pages that allocators keep for later would add up from stage to stage.
    """
    _HELD.clear()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim is not None:
        trim(0)


def held(key, make):
    """``make()``, kept by this Python worker until another key is asked for.

    Workers outlive their tasks.  One slot for all operators keeps a model or a
    memory of words from lying beside the next stage's.
    """
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def most_frequent(counts: DataFrame, column: str, k: int) -> list[tuple[str, int]]:
    """The about k most frequent values of a (value, n) table, at most k, by n and value.

    A plain top-k would send k rows of every partition to the driver.  Here a
    histogram of the counts' logarithms (a few thousand bins whatever the
    input) finds the count where k values are reached, and only values above
    it are collected; ties in the last bin are cut by hash.
    """
    bins = counts.withColumn("bin", F.floor(F.log2(F.col("n").cast("double")) * 64).cast("int"))
    hist = sorted(((r["bin"], r["count"]) for r in bins.groupBy("bin").count().collect()),
                  reverse=True)
    whole, share, left = 1 << 30, 0.0, k
    for b, n in hist:
        if n > left:
            share = left / n
            break
        whole, left = b, left - n
    edge = max((b for b, _ in hist if b < whole), default=whole)
    unit = 1_000_000
    part = F.pmod(F.xxhash64(column), F.lit(unit)) < int(share * unit)
    rows = bins.where((F.col("bin") >= whole) | ((F.col("bin") == edge) & part)).select(
        column, "n").collect()
    return sorted(((r[0], r[1]) for r in rows), key=lambda x: (-x[1], x[0]))[:k]
