"""The whole curation as one composition of frames: from image rows and times to aligned batches.

Stages are functions from frame to frame; nothing is written between them unless the caller asks for it. The order is
fixed: content fix, border crop of both sides, low-information filter, temporal match, perceptual de-duplication,
batches. External tools (probe, extraction, alignment) are functions that the caller passes in.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pixels as X
from ..functions import text as T
from ..functions.pixels import array_of, crop
from ..operators import batching, clean, dedup, match
from ..params import Params

IMAGE = ["data", "height", "width", "channels"]


def content_fix(frames: DataFrame, p: Params = Params()) -> DataFrame:
    """frames(side, video, frame_name, *IMAGE, ...): of twins whose aspects differ, the side that holds the other is cropped.

    Twins share video and frame name. Frames without a readable twin stay as they are.
    """
    keys = ["video", "frame_name"]
    side = lambda s, pre: frames.where(F.col("side") == s).select(*keys, *[F.col(c).alias(f"{pre}_{c}") for c in IMAGE])
    twins = side("LR", "l").join(side("HR", "h"), keys).where(clean.aspect_differs("l_width", "l_height", "h_width", "h_height", p))
    scored = twins.withColumn("s", X.contest_scores(p)(*[F.col(f"{pre}_{c}") for pre in "lh" for c in IMAGE]))
    won = scored.select(
        *keys, clean.contest("s.hr_in_lr", "s.lr_in_hr", p).alias("winner"), F.col("s.hr_box").alias("hr_box"), F.col("s.lr_box").alias("lr_box")
    ).where("winner != 'none'")

    @F.pandas_udf("data binary, height int, width int")
    def cut(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series, box: pd.Series) -> pd.DataFrame:
        rows = []
        for d, a, b, k, x in zip(data, h, w, c, box):
            if d is None or x is None:
                rows.append((d, a, b))
                continue
            y = crop(array_of(bytes(d), int(a), int(b), int(k)), (x[0], x[1], x[0] + x[2], x[1] + x[3]))
            rows.append((np.ascontiguousarray(y).tobytes(), y.shape[0], y.shape[1]))
        return pd.DataFrame(rows, columns=["data", "height", "width"]).astype({"height": "Int32", "width": "Int32"})

    box = F.when((F.col("side") == "HR") & (F.col("winner") == "crop_hr"), F.col("hr_box")).when(
        (F.col("side") == "LR") & (F.col("winner") == "crop_lr"), F.col("lr_box")
    )
    fixed = frames.join(won, keys, "left").withColumn("box", box)
    new = fixed.withColumn("new", cut("data", "height", "width", "channels", "box"))
    return new.select(*[F.col(f"new.{c}").alias(c) if c in ("data", "height", "width") else F.col(c) for c in frames.columns])


def border_crop(frames: DataFrame, p: Params = Params()) -> DataFrame:
    new = frames.withColumn("new", X.cropped_image(p)(*IMAGE))
    return new.select(*[F.col(f"new.{c}").alias(c) if c in ("data", "height", "width") else F.col(c) for c in frames.columns])


def drop_low_info(frames: DataFrame, p: Params = Params()) -> DataFrame:
    """Both twins of low-information frames go; a video without HR frames stays whole."""
    keys = ["video", "frame_name"]
    rated = frames.select(*keys, "side", X.gray_variance(*IMAGE).alias("v"))
    lr = rated.where("side = 'LR'").select(*keys, F.col("v").alias("lr_var"))
    hr = rated.where("side = 'HR'").select(*keys, F.col("v").alias("hr_var"))
    videos = hr.select("video").distinct()
    low = lr.join(hr, keys, "left").join(videos, "video", "left_semi").where(clean.low_info("lr_var", "hr_var", p))
    return clean.cascade(frames, low, keys)


def matched(frames: DataFrame, times: DataFrame, p: Params = Params()) -> DataFrame:
    """times(side, video, frame_name, ts, duration): pairs of frames that are still there."""
    timed = frames.join(times, ["side", "video", "frame_name"])
    grey = timed.withColumn("pixels", X.match_pixels(p.match_width, p.match_height)(*IMAGE)).where("pixels IS NOT NULL")
    lr = grey.where("side = 'LR'").select("video", F.col("frame_name").alias("lr_frame"), F.col("ts").alias("lr_ts"), "duration", F.col("pixels").alias("lr_pixels"))
    hr = grey.where("side = 'HR'").select("video", F.col("frame_name").alias("hr_frame"), F.col("ts").alias("hr_ts"), F.col("pixels").alias("hr_pixels"))
    return match.temporal_match(lr, hr, p).select("video", "lr_frame", "lr_ts", "hr_frame", "hr_ts", "score")


def deduplicated(matches: DataFrame, frames: DataFrame, p: Params = Params()) -> DataFrame:
    """Matched pairs after the greedy fold over their LR images, in order of name; size is the file's length."""
    lr = frames.where("side = 'LR'").select("video", F.col("frame_name").alias("lr_frame"), X.image_phash(*IMAGE).alias("h"), F.col("length").alias("z"))
    rows = matches.join(lr, ["video", "lr_frame"])
    known = rows.where("h IS NOT NULL").withColumn("i", F.row_number().over(Window.partitionBy("video").orderBy("lr_frame")))
    return dedup.greedy_dedup(known, ["video"], p.phash_threshold).drop("i", "h", "z").unionByName(rows.where("h IS NULL").drop("h", "z"))


def curate(frames: DataFrame, times: DataFrame, p: Params = Params()) -> dict[str, DataFrame]:
    """Every stage's result by name, nothing run yet."""
    fixed = content_fix(frames, p) if p.attempt_content_fix else frames
    cropped = border_crop(fixed, p) if p.crop_black or p.crop_white else fixed
    kept = drop_low_info(cropped, p) if p.low_info_filter else cropped
    pairs = matched(kept, times, p)
    unique = deduplicated(pairs, kept, p)
    named = unique.withColumn("name", T.matched_name("video", "lr_frame"))
    return {"fixed": fixed, "cropped": cropped, "kept": kept, "matched": pairs, "unique": unique, "batches": batching.batches(named, p=p)}
