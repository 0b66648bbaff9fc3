"""Shared pieces of the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written

#: A word is a run of characters other than space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"
#: Members of a block; a task holds two blocks at most.
BLOCK = 1 << 14


def word_count(col) -> Column:
    """Number of words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(col, F.lit(WORD)), F.lit(0)).cast("long")


def text_of(col) -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def pieces(batches, keys: int, size: int):
    """Rows sorted by their first ``keys`` columns -> (key, record batch) with rows of one key, ``size`` rows or fewer.

    A key with up to ``size`` rows comes whole, however the rows are spread over Arrow batches.
    """
    import numpy as np
    import pyarrow as pa

    held, held_key, rows = [], None, 0

    def out():
        return held_key, pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        change = np.zeros(batch.num_rows - 1, bool)
        for c in columns:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for a, z in zip(cuts, cuts[1:]):
            key = tuple(int(c[a]) for c in columns)
            while a < z:
                if held and (key != held_key or rows >= size):
                    yield out()
                    held, rows = [], 0
                take = min(z - a, size - rows)
                held.append(batch.slice(a, take))
                held_key, rows, a = key, rows + take, a + take
    if held:
        yield out()


def paired_blocks(members: DataFrame, key: str, weight: str, row: str, cap: int = BLOCK) -> DataFrame:
    """members(key, weight, row, ...) -> the same rows with (i, j, side): every two rows of a key meet in one task.

    A key whose weights add up to ``cap`` or less is one block (0, 0). A heavier one is dealt to as many blocks as it
    needs, by a hash of the row, and each block goes to every pair of blocks (i, j), i <= j, that it is in: so a task
    holds two blocks, not the key. side is 0 for block i and 1 for block j; in (i, i) there is side 0 only.
    """
    heavy = written(
        members.groupBy(key).agg(F.sum(weight).alias("__w")).where(F.col("__w") > cap).select(F.col(key).alias("__key"), F.ceil(F.col("__w") / cap).cast("int").alias("__g")),
        "heavy",
    )
    dealt = (
        members.join(heavy, F.col(key) == F.col("__key"), "left")
        .drop("__key")
        .withColumn("__g", F.coalesce("__g", F.lit(1)))
        .withColumn("__b", F.pmod(F.xxhash64(row), F.col("__g")).cast("int"))
        .withColumn("__o", F.explode(F.sequence(F.lit(0), F.col("__g") - 1)))
    )
    return (
        dealt.withColumn("i", F.least("__b", "__o"))
        .withColumn("j", F.greatest("__b", "__o"))
        .withColumn("side", F.when(F.col("__b") > F.col("__o"), 1).otherwise(0))
        .drop("__g", "__b", "__o")
    )


def give_back() -> None:
    """Return this Python process's free memory to the system, where its C library can (glibc)."""
    gc.collect()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def tidied(f):
    """A task's function of batches, after which an idle worker holds no memory of the task."""

    def run(batches):
        try:
            yield from f(batches)
        finally:
            give_back()

    return run


def release(spark) -> None:
    """Collect the driver's garbage now, Python's first, so that Spark's cleaner deletes the shuffle files of jobs that are over."""
    give_back()
    for _ in range(3):  # references from Python's side are let go between collections
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)
