"""Greedy perceptual de-duplication: an ordered fold over the frames that may affect each other.

In order of i, a frame is compared with the kept ones; the first within ``threshold`` bits (strictly less) goes if the
frame is at least as large, else the frame goes. A kept frame whose equal hash is overwritten goes untracked: it stays.

The order matters, but only among frames that links of less than ``threshold`` bits connect. So links are found first,
by bands of bits of which close hashes share one, and each component is folded by itself: a large group is as many
tasks as it has components. From ``BANDED`` bits on bands would be too short to tell anything apart, and a group is one
fold.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .components import connected_components

BANDED = 6


def fold(h: np.ndarray, z: np.ndarray, threshold: int) -> list[int]:
    """Positions that go, of frames in order with hashes h and sizes z."""
    hashes, at, there = np.zeros(len(h), np.uint64), np.zeros(len(h), np.int64), np.zeros(len(h), bool)
    n, gone = 0, []
    for k, x in enumerate(h):
        near = np.flatnonzero(there[:n] & (np.bitwise_count(hashes[:n] ^ x) < threshold))
        if len(near) and z[k] < z[at[near[0]]]:
            gone.append(k)
            continue
        if len(near):
            gone.append(int(at[near[0]]))
            there[near[0]] = False
        same = np.flatnonzero(there[:n] & (hashes[:n] == x))
        place = same[0] if len(same) else n
        hashes[place], at[place], there[place] = x, k, True
        n = max(n, int(place) + 1)
        if n > 1024 and 2 * there[:n].sum() < n:  # close the gaps, in order
            kept = np.flatnonzero(there[:n])
            hashes[: len(kept)], at[: len(kept)] = hashes[kept], at[kept]
            there[:n], n = False, len(kept)
            there[:n] = True
    return gone


def _near(threshold: int):
    """Rows (key, node, h) sorted by key -> links (a, b) that connect close hashes of a key, at most one for each."""

    def links(nodes, h):
        label = np.arange(len(h))
        for k in range(len(h) - 1):
            js = k + 1 + np.flatnonzero((np.bitwise_count(h[k + 1 :] ^ h[k]) < threshold) & (label[k + 1 :] != label[k]))
            if len(js):
                old, first = np.unique(label[js], return_index=True)
                yield from ((nodes[k], nodes[j]) for j in js[first])
                to = np.arange(len(h))
                to[old] = label[k]
                label = to[label]

    def run(batches):
        held = None
        for batch in [*batches, None]:
            got = [batch.column(k).to_numpy() for k in range(3)] if batch is not None else [np.zeros(0, np.int64)] * 3
            if held is not None:
                got = [np.concatenate(x) for x in zip(held, got)]
            keys = got[0]
            if not len(keys):
                continue
            cuts = np.flatnonzero(np.diff(keys)) + 1
            bounds = [0, *cuts, len(keys)]
            done = bounds if batch is None else bounds[:-1]  # the last key may go on
            held = [x[done[-1] :] for x in got]
            found = [pair for a, z in zip(done, done[1:]) if z - a > 1 for pair in links(got[1][a:z], got[2][a:z].view(np.uint64))]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([int(x[k]) for x in found], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def removed_by_fold(frames: DataFrame, group: list[str], threshold: int) -> DataFrame:
    """frames(*group, i, h, z) -> (*group, i) of frames that go."""
    item = [F.col(c).cast("long").alias(c) for c in ("i", "h", "z")]
    rows = frames.select(*group, *item)
    kinds = dict(frames.dtypes)
    schema = ", ".join([*[f"`{g}` {kinds[g]}" for g in group], "i long"])
    if threshold <= 0:
        return rows.limit(0).select(*group, "i")
    if threshold > BANDED:
        rows = rows.withColumn("part", F.lit(0).cast("long"))
    else:
        hashes = written(rows.groupBy(*group, "h").agg(F.count(F.lit(1)).alias("n")).withColumn("node", F.monotonically_increasing_id()), "hashes")
        width = -(-64 // threshold)  # of two hashes that differ in threshold - 1 bits or less, one band is equal
        bands = F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.shiftrightunsigned("h", k * width).bitwiseAND((1 << width) - 1 if width < 64 else -1).alias("bits")) for k in range(threshold)]))
        keyed = hashes.select(*group, "node", "h", bands.alias("x")).select(F.xxhash64(*group, "x.k", "x.bits").alias("key"), "node", "h")
        # two groups whose keys collide would only be folded together, and are told apart below
        links = keyed.repartition("key").sortWithinPartitions("key", "node").mapInArrow(_near(threshold), "a long, b long")
        parts = connected_components(links)
        known = hashes.join(parts, "node", "left").where("component IS NOT NULL OR n > 1")
        on = [rows[c].eqNullSafe(known[c]) for c in [*group, "h"]]
        rows = rows.join(known, reduce(Column.__and__, on)).select(*[rows[c] for c in [*group, "i", "h", "z"]], F.coalesce("component", "node").alias("part"))

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["i", "h", "z"], kind="stable")
        gone = fold(pdf["h"].to_numpy(np.int64).view(np.uint64), pdf["z"].to_numpy(np.int64), threshold)
        return pdf.iloc[gone][[*group, "i"]]

    return rows.groupBy(*group, "part").applyInPandas(run, schema)


def greedy_dedup(frames: DataFrame, group: list[str], threshold: int) -> DataFrame:
    """Frames that stay, with all their columns. A negative threshold turns the step off."""
    if threshold < 0:
        return frames
    gone = removed_by_fold(frames, group, threshold)
    on = [frames[c].eqNullSafe(gone[c]) for c in [*group, "i"]]
    return frames.join(gone, reduce(Column.__and__, on), "left_anti")
