"""Scene selection and the reconciliation of frames with logged times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import col, pts_time
from ..params import Params


def scene_score(mafd: Column, before: Column) -> Column:
    """Score from a frame's mean difference and that of the frame before."""
    return F.least(F.greatest(F.least(mafd, F.abs(mafd - before)) / 100, F.lit(0.0)), F.lit(1.0))


def scene_cuts(frames: DataFrame, video="video", order=("ts",), mafd="mafd", p: Params = Params()) -> DataFrame:
    """Frames that begin a scene: score strictly above the threshold; the first frame has 0 before it."""
    by = Window.partitionBy(video).orderBy(*order)
    scored = frames.withColumn("scene", scene_score(F.col(mafd), F.lag(mafd, 1, 0.0).over(by)))
    return scored.where(F.col("scene") > p.scene_threshold)


def reconcile(names, times) -> Column:
    """One time a frame: too many are cut, too few are padded with the last; null (failure) without any of either."""
    names, times = col(names), col(times)
    n, m = F.size(names), F.size(times)
    padded = F.concat(times, F.array_repeat(F.element_at(times, -1), F.greatest(n - m, F.lit(0))))
    return F.when((n > 0) & (m > 0), F.slice(padded, F.lit(1), n))


def name_times(names, times) -> Column:
    return F.map_from_arrays(col(names), col(times))


def extracted(videos: DataFrame, run) -> DataFrame:
    """videos(side, video, path, chain) -> (side, video, frame_name, ts, status), a row a frame.

    ``run(path, chain) -> (frame names, log)`` calls the external extractor; it is any function, so a test needs no
    tool. Times come from the log's lines and are reconciled with the frames. A video that fails, or gives no frame or
    no time, has one row with null frame and its status, instead of being taken for done.
    """
    import pandas as pd

    def call(batches):
        for pdf in batches:
            names, logs, status = [], [], []
            for path, chain in zip(pdf["path"], pdf["chain"]):
                try:
                    got, log = run(path, chain)
                    names.append(list(got))
                    logs.append(log)
                    status.append("ok")
                except Exception as e:
                    names.append([])
                    logs.append("")
                    status.append(f"failed: {type(e).__name__}")
            yield pd.DataFrame({"side": pdf["side"], "video": pdf["video"], "names": names, "log": logs, "status": status})

    raw = videos.select("side", "video", "path", "chain").mapInPandas(call, "side string, video string, names array<string>, log string, status string")
    lines = F.filter(F.transform(F.split("log", "\n"), pts_time), lambda t: t.isNotNull())
    known = raw.withColumn("names", F.array_sort("names")).withColumn("times", reconcile("names", lines))
    failed = F.when(F.col("status") != "ok", F.col("status")).when(F.col("times").isNull(), "no frames or times").otherwise("ok")
    return known.select("side", "video", F.explode_outer(F.arrays_zip("names", "times")).alias("f"), failed.alias("status")).select(
        "side", "video", F.when(F.col("status") == "ok", F.col("f.names")).alias("frame_name"), F.col("f.times").alias("ts"), "status"
    ).distinct()
