"""Temporal matching: interval candidates, scoring, the best candidate, and monotone order."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import ncc_prepared, unit_centred
from ..params import Params


def window_of(duration: Column, p: Params = Params()) -> Column:
    """Half width of the candidate window: a share of the duration; the default width without a duration."""
    known = F.when(duration > 0, duration)
    if p.window_share <= 0:
        return F.coalesce(known, F.lit(1800.0)) * 0.0
    return F.coalesce(known, F.lit(p.default_window / p.window_share)) * p.window_share


def bucketed(lr: DataFrame, hr: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``__b``, their bucket of time, which is as wide as the video's widest window; equal times where that is 0."""
    widths = lr.groupBy("video").agg(F.max("w").alias("__w"))
    bucket = lambda ts: F.when(F.col("__w") > 0, F.floor(ts / F.col("__w"))).otherwise(F.xxhash64(ts)).cast("long")
    side = lambda df, ts: df.where(F.col(ts).isNotNull()).join(widths, "video").withColumn("__b", bucket(F.col(ts)))
    return side(lr, "lr_ts"), side(hr, "hr_ts")


def _around(rows: DataFrame) -> DataFrame:
    """Rows sent to their own bucket and its two neighbours."""
    three = F.sequence(F.col("__b") - 1, F.col("__b") + 1)
    return rows.withColumn("__b", F.explode(F.when(F.col("__w") > 0, three).otherwise(F.array("__b"))))


def interval_join(lr: DataFrame, hr: DataFrame) -> DataFrame:
    """lr(video, lr_frame, lr_ts, w, ...) with every hr(video, hr_frame, hr_ts, ...) at most w away, ends included.

    An lr row goes to its bucket of time and the two neighbouring ones, an hr row to its own, so the join is an equi-join
    on (video, bucket) with a range left over. That spreads one long video over many tasks, which a join on the video
    alone would not.
    """
    left, right = bucketed(lr, hr)
    left, right = _around(left).drop("__w"), right.drop("__w")
    on = (
        (left["video"] == right["video"])
        & (left["__b"] == right["__b"])
        & right["hr_ts"].between(left["lr_ts"] - left["w"], left["lr_ts"] + left["w"])
    )
    return left.join(right, on).drop(right["video"]).drop("__b")


#: LR frames that a task holds at once.
HELD = 64


def _rows(column) -> np.ndarray:
    """Pixels as bytes, or as lists of numbers -> matrix of doubles."""
    if pa.types.is_binary(column.type):
        raw = column.to_pylist()
        return np.frombuffer(b"".join(raw), np.uint8).reshape(len(raw), -1).astype(np.float64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _units(m: np.ndarray) -> np.ndarray:
    """Rows centred and of length one; flat ones stay zero."""
    m = m - m.mean(1, keepdims=True)
    n = np.sqrt(np.einsum("nd,nd->n", m, m))
    return m / np.where(n > 0, n, 1.0)[:, None]


def _score(batches):
    """Rows (key, side, video, frame, ts, w, px) sorted by key and side: LR frames are held, HR ones stream past -> best of each.

    One matrix product scores a block. Scores that are equal but for rounding are computed again, pair by pair, so
    that equal images tie, whatever their place in a block.
    """
    key, held = None, None

    def out():
        video, frame, ts, _, _, best = held
        found = [(v, f, t, *b) for v, f, t, b in zip(video, frame, ts, best) if b]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in found], t) for k, t in enumerate((pa.string(), pa.string(), pa.float64(), pa.string(), pa.float64(), pa.float64()))],
            names=["video", "lr_frame", "lr_ts", "hr_frame", "hr_ts", "score"],
        )

    for batch in batches:
        keys, sides = batch.column("key").to_numpy(), batch.column("side").to_numpy()
        cuts = np.flatnonzero((np.diff(keys) != 0) | (np.diff(sides) != 0)) + 1 if len(keys) else []
        for a, z in zip([0, *cuts], [*cuts, len(keys)]):
            if a == z:
                continue
            part = batch.slice(a, z - a)
            video, frame = part.column("video").to_pylist(), part.column("frame").to_pylist()
            ts, w, px = part.column("ts").to_numpy(), part.column("w").to_numpy(), _units(_rows(part.column("px")))
            if sides[a] == 0:
                if keys[a] != key:
                    if held:
                        yield out()
                    key, held = keys[a], (video, frame, list(ts), w, px, [None] * len(video))
                else:  # the same block, in the next batch
                    held = (held[0] + video, held[1] + frame, held[2] + list(ts), np.r_[held[3], w], np.r_[held[4], px], held[5] + [None] * len(video))
                continue
            if keys[a] != key:
                continue
            own_video, _, own_ts, own_w, own, best = held
            scores = own @ px.T
            flat_own, flat = ~own.any(1), ~px.any(1)
            t = np.array(own_ts)[:, None]
            near = (ts[None, :] >= t - own_w[:, None]) & (ts[None, :] <= t + own_w[:, None])
            for i in np.flatnonzero(near.any(1)):
                at = np.flatnonzero(near[i])
                at = at[[video[j] == own_video[i] for j in at]]
                if not len(at):
                    continue
                top = scores[i, at].max()
                for j in at if flat_own[i] else at[scores[i, at] >= top - 1e-9]:
                    s = 1.0 if flat_own[i] else 0.0 if flat[j] else float(np.dot(own[i], px[j]))
                    if best[i] is None or (-s, frame[j]) < (-best[i][2], best[i][0]):
                        best[i] = (frame[j], float(ts[j]), s)
    if held:
        yield out()


def best_candidates(lr: DataFrame, hr: DataFrame) -> DataFrame:
    """lr(video, lr_frame, lr_ts, w, lr_pixels), hr(video, hr_frame, hr_ts, hr_pixels) -> each LR frame's best candidate.

    Pixels are bytes or arrays of numbers. LR frames stay where their bucket is, at most about ``HELD`` to a task's block;
    HR frames go to the blocks of their bucket and its neighbours. So a frame's pixels move a few times, never once a
    candidate, and only the best of each LR frame leaves the task. Frames without pixels take no part.
    """
    left, right = bucketed(lr.where("lr_pixels IS NOT NULL"), hr.where("hr_pixels IS NOT NULL"))
    size = lambda c: (F.length(c) if dict(lr.dtypes)["lr_pixels"] == "binary" else F.size(c)).alias("__n")
    left, right = left.select("*", size(F.col("lr_pixels"))), right.select("*", size(F.col("hr_pixels")))
    blocks = left.groupBy("video", "__b", "__n").agg(F.ceil(F.count(F.lit(1)) / HELD).cast("int").alias("__blocks"))
    place = ["video", "__b", "__n"]
    a = left.join(blocks, place).withColumn("__s", F.pmod(F.xxhash64("lr_frame"), F.col("__blocks")).cast("int"))
    b = _around(right).join(blocks, place).withColumn("__s", F.explode(F.sequence(F.lit(0), F.col("__blocks") - 1)))
    row = lambda df, side, pre, w: df.select(
        F.xxhash64(*place, "__s").alias("key"), F.lit(side).alias("side"), F.col("video").cast("string").alias("video"),
        F.col(f"{pre}_frame").alias("frame"), F.col(f"{pre}_ts").cast("double").alias("ts"), w.cast("double").alias("w"), F.col(f"{pre}_pixels").alias("px"),
    )
    both = row(a, 0, "lr", F.col("w")).unionByName(row(b, 1, "hr", F.lit(0.0)))
    found = both.repartition("key").sortWithinPartitions("key", "side").mapInArrow(
        _score, "video string, lr_frame string, lr_ts double, hr_frame string, hr_ts double, score double"
    )
    return found.withColumn("video", F.col("video").cast(dict(lr.dtypes)["video"]))


def best_match(scored: DataFrame, keys=("video", "lr_frame")) -> DataFrame:
    """Highest score of each key; of equal ones the first by name."""
    by = Window.partitionBy(*keys).orderBy(F.desc("score"), "hr_frame")
    return scored.withColumn("__r", F.row_number().over(by)).where("__r = 1").drop("__r")


def monotone(matches: DataFrame, start: float = -1.0) -> DataFrame:
    """Matches whose hr_ts is not before that of any earlier match that stays, in order of lr_ts.

    What goes lies below the running maximum, so the maximum over all earlier rows is that over those which stay.
    """
    by = Window.partitionBy("video").orderBy("lr_ts", "lr_frame").rowsBetween(Window.unboundedPreceding, -1)
    top = F.greatest(F.lit(start), F.coalesce(F.max("hr_ts").over(by), F.lit(start)))
    return matches.withColumn("__top", top).where("hr_ts >= __top").drop("__top")


def score(candidates: DataFrame, lr_col="lr_pixels", hr_col="hr_pixels", prepared=False) -> DataFrame:
    """Candidates with their score, in column expressions."""
    a, b = (F.col(lr_col), F.col(hr_col)) if prepared else (unit_centred(lr_col), unit_centred(hr_col))
    return candidates.withColumn("score", ncc_prepared(a, b))


def temporal_match(lr: DataFrame, hr: DataFrame, p: Params = Params()) -> DataFrame:
    """lr(video, lr_frame, lr_ts, duration, lr_pixels), hr(video, hr_frame, hr_ts, hr_pixels) -> the matched pairs."""
    found = best_candidates(lr.withColumn("w", window_of(F.col("duration"), p)), hr)
    return monotone(found.where(F.col("score") >= p.match_threshold))


def tracked_match(lr: DataFrame, hr: DataFrame, p: Params = Params()) -> DataFrame:
    """Opt-in: after a first match the window follows the last one's offset, ``tracked_window`` seconds to each side.

    Sequential inside a video by definition, so each video is folded on its own in Arrow batches.
    """
    import pandas as pd

    def fold(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        out, last = [], None
        b = b.dropna(subset=["hr_ts"]).sort_values("hr_frame")
        for r in a.dropna(subset=["lr_ts"]).sort_values(["lr_ts", "lr_frame"]).itertuples():
            d = r.duration if r.duration and r.duration > 0 else p.default_window / p.window_share
            middle, width = (r.lr_ts, d * p.window_share) if last is None else (last[1] + r.lr_ts - last[0], p.tracked_window)
            near = b[(b.hr_ts >= middle - width) & (b.hr_ts <= middle + width)]
            best = None
            x = np.asarray(r.lr_pixels, float)
            x = x - x.mean()
            for c in near.itertuples():
                y = np.asarray(c.hr_pixels, float)
                y = y - y.mean()
                s = 1.0 if not x.any() else 0.0 if not y.any() else float(x @ y / np.sqrt((x @ x) * (y @ y)))
                if best is None or s > best[2]:
                    best = (c.hr_frame, c.hr_ts, s)
            if best and best[2] >= p.match_threshold:
                last = (r.lr_ts, best[1])
                out.append((r.video, r.lr_frame, r.lr_ts, *best))
        return pd.DataFrame(out, columns=["video", "lr_frame", "lr_ts", "hr_frame", "hr_ts", "score"])

    kind = dict(lr.dtypes)["video"]
    schema = f"video {kind}, lr_frame string, lr_ts double, hr_frame string, hr_ts double, score double"
    return lr.groupBy("video").cogroup(hr.groupBy("video")).applyInPandas(fold, schema)
