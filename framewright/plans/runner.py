"""The whole run, from two folders of videos to aligned sets of images, resumable after a kill.

Three stages go through the videos in chunks: extract, match, align. A chunk is one distributed job, and its videos are
logged when it is done, so a run that was killed begins with the first chunk that was not. Every step can be repeated: a
video's frames are replaced, files are overwritten under the same names, an aligner's folder is emptied before use.

External tools work on paths, so all folders have to be mounted alike on every machine.
"""

from __future__ import annotations

import os
import shutil
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import batching, extract, pairing, progress, tools
from ..params import Params
from ..sources import media, sinks
from ..sources.tables import written
from . import pipeline

EXTRACTED, MATCHED, ALIGNED, LOG, TIMES = "1_EXTRACTED", "2_MATCHED", "3_ALIGNED", "progress", "times"
TIMES_KIND = "side string, video string, frame_name string, ts double, duration double"
CHUNK = 32


def _chunks(spark: SparkSession, items: DataFrame, out: str, stage: str, key: str, size: int):
    """Yields a frame of at most ``size`` items that the stage hasn't logged, and logs them when the caller comes back."""
    log = f"{out}/{LOG}"
    state = progress.read_log(spark, log)
    if progress.state(state).where((F.col("stage") == stage) & F.col("completed")).count():
        return
    todo = progress.pending(items, state, stage, key)
    numbered = written(todo.withColumn("__chunk", F.floor((F.row_number().over(Window.orderBy(key)) - 1) / size).cast("int")), "todo")
    for chunk in range((numbered.agg(F.max("__chunk")).first()[0] if numbered.count() else -1) + 1):
        mine = numbered.where(F.col("__chunk") == chunk).drop("__chunk")
        yield mine
        seq = F.unix_micros(F.current_timestamp())
        progress.append_log(mine.select(F.lit(stage).alias("stage"), F.col(key).alias("item"), F.lit(False).alias("completed"), seq.alias("seq")), log)
    done = spark.sql("SELECT unix_micros(current_timestamp()) AS seq").select(F.lit(stage).alias("stage"), F.lit(None).cast("string").alias("item"), F.lit(True).alias("completed"), "seq")
    progress.append_log(done, log)


def video_pairs(spark: SparkSession, lr_folder: str, hr_folder: str) -> DataFrame:
    """(video, name, lr_path, hr_path) of videos whose stems are on both sides; the LR file's stem names the video."""
    one = lambda folder, side: pairing.last_by_stem(media.videos(spark, folder, side))
    lr = one(lr_folder, "LR").select("stem_key", F.col("path").alias("lr_path"), "name", T.stem("name").alias("video"))
    hr = one(hr_folder, "HR").select("stem_key", F.col("path").alias("hr_path"))
    return pairing.pair(lr, hr, ["stem_key"]).drop("stem_key")


def _local(path):
    return F.regexp_replace(path, "^file:(//)?", "")


def extract_side(videos: DataFrame, side: str, out: str, probe: str, tool: str, p: Params) -> DataFrame:
    """videos(video, path) -> (side, video, frame_name, ts, duration, status); frames are written on the way."""
    files = videos.select(F.lit(side).alias("side"), "video", _local("path").alias("path"))
    probed = written(media.probe(files, tools.prober(probe, tool, p)), "probed")
    chained = probed.withColumn("chain", T.filter_chain("side", "interlaced", "hdr", p.scene_threshold, p))
    folder_of = lambda path: f"{out}/{EXTRACTED}/{side}/{os.path.splitext(os.path.basename(path))[0]}"
    # a side's frames lie under the LR file's stem, as videos are paired without case
    named = {r["path"]: r["video"] for r in files.select("path", "video").collect()} if side == "HR" else None  # a chunk's rows
    place = folder_of if named is None else lambda path: f"{out}/{EXTRACTED}/{side}/{named[path]}"
    got = written(extract.extracted(chained, tools.extractor(tool, place, p)), "extracted")
    return got.join(probed.select("side", "video", "duration"), ["side", "video"])


def preprocess(spark, lr_folder: str, hr_folder: str, out: str, probe: str, tool: str, p: Params = Params(), size: int = CHUNK) -> None:
    for chunk in _chunks(spark, video_pairs(spark, lr_folder, hr_folder), out, "preprocess", "name", size):
        lr = extract_side(chunk.select("video", F.col("lr_path").alias("path")), "LR", out, probe, tool, p)
        well = lr.where("status = 'ok'").select("video").distinct()
        # no HR frames for a video whose LR side failed
        hr = extract_side(chunk.join(well, "video").select("video", F.col("hr_path").alias("path")), "HR", out, probe, tool, p)
        times = lr.unionByName(hr).where("status = 'ok'").select("side", "video", "frame_name", "ts", "duration")
        times.write.mode("append").json(f"{out}/{TIMES}")


def times_of(spark: SparkSession, out: str) -> DataFrame:
    """Logged times; those of a chunk that was killed before its log come twice."""
    return spark.read.schema(TIMES_KIND).json(f"{out}/{TIMES}").dropDuplicates(["side", "video", "frame_name"])


def match_videos(spark, out: str, p: Params = Params(), size: int = CHUNK) -> None:
    if not os.path.isdir(f"{out}/{TIMES}"):
        return
    times = times_of(spark, out)
    both = pairing.common(times.where("side = 'LR'"), times.where("side = 'HR'"), ["video"])
    for chunk in _chunks(spark, both, out, "match", "video", size):
        own = times.join(chunk, "video")
        sides = []
        for side in ("LR", "HR"):
            folder = f"{out}/{EXTRACTED}/{side}"
            pixels = media.images(spark, folder).select("path", "height", "width", "channels", "data")
            listed = media.frames(spark, folder, side).join(chunk, "video")
            bare = lambda df: df.withColumn("path", _local("path"))
            sides.append(bare(listed).join(bare(pixels), "path").drop("path"))
        # written, so that images are decoded once
        frames = written(sides[0].unionByName(sides[1]).drop("name"), "frames")
        got = pipeline.curate(frames, own, p)
        pairs, kept = written(got["unique"], "unique"), got["kept"]
        for side, column in (("LR", "lr_frame"), ("HR", "hr_frame")):
            rows = pairs.select("video", F.col(column).alias("frame_name"), T.matched_name("video", "lr_frame").alias("name"))
            images = kept.where(F.col("side") == side).join(rows, ["video", "frame_name"]).select("name", "height", "width", "channels", "data")
            os.makedirs(f"{out}/{MATCHED}/{side}", exist_ok=True)
            sinks.write_files(sinks.encoded(images), f"{out}/{MATCHED}/{side}")


def aligner(tool: str, out: str, p: Params = Params()):
    """For ``batching.aligned``: one batch's pairs through the tool, its results moved to the final sets."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        video, batch, suffix = pdf["video"].iloc[0], int(pdf["batch"].iloc[0]), pdf["suffix"].iloc[0]
        work = f"{out}/{ALIGNED}/__temp_{video}{suffix}_{uuid.uuid4().hex[:8]}"
        images: list[str] = []
        moved = skipped = 0
        try:
            for side in ("LR", "HR"):
                os.makedirs(f"{work}/{side}")
                for name in pdf["name"]:
                    shutil.copy2(f"{out}/{MATCHED}/{side}/{name}", f"{work}/{side}/{name}")
            os.makedirs(f"{work}/out")
            see = lambda line: images.append(line) if line.endswith(".png") and not any(x in line.lower() for x in ("warning", "error")) else None
            ok, last = batching.supervised(batching.command(tool, f"{work}/LR", f"{work}/HR", f"{work}/out", p), p.align_timeout_hours * 3600, see, not p.show_warnings)
            if ok:
                done = f"{work}/out/Output"
                bad = set()
                if os.path.isfile(f"{done}/Artifacts.txt"):
                    with open(f"{done}/Artifacts.txt") as f:
                        bad = {os.path.splitext(os.path.basename(x.strip()))[0] for x in f if x.strip()}
                for name in sorted(os.listdir(f"{done}/LR")) if os.path.isdir(f"{done}/LR") else ():
                    if os.path.splitext(name)[0] in bad:
                        skipped += 1
                        continue
                    for side in ("LR", "HR", "Overlay"):
                        if os.path.isfile(f"{done}/{side}/{name}"):
                            os.replace(f"{done}/{side}/{name}", f"{out}/{ALIGNED}/{side}/{name}")
                    moved += 1
        finally:
            shutil.rmtree(work, ignore_errors=True)
        return pd.DataFrame([(video, batch, bool(ok), moved, skipped, len(images), "\n".join(last))], columns=["video", "batch", "ok", "moved", "skipped", "images", "last"])

    return run


ALIGNED_KIND = "video string, batch int, ok boolean, moved int, skipped int, images int, last string"


def align_videos(spark, out: str, tool: str, p: Params = Params(), size: int = CHUNK) -> None:
    if not os.path.isdir(f"{out}/{MATCHED}/LR"):
        return
    for side in ("LR", "HR", "Overlay"):
        os.makedirs(f"{out}/{ALIGNED}/{side}", exist_ok=True)
    listed = lambda side: media.list_files(spark, f"{out}/{MATCHED}/{side}").where(T.is_image("name")).select("name")
    pairs = listed("LR").withColumn("video", T.video_of("name")).where("video IS NOT NULL")
    for chunk in _chunks(spark, pairs.select("video").distinct(), out, "align", "video", size):
        ready = pairing.existing(batching.batches(pairs.join(chunk, "video"), p=p), listed("HR"), ["name"])
        done = batching.aligned(ready, aligner(tool, out, p), ALIGNED_KIND)
        done.write.mode("append").json(f"{out}/aligned-batches")


def run(spark: SparkSession, lr_folder: str, hr_folder: str, out: str, probe: str, extract_tool: str, align_tool: str | None, p: Params = Params(), size: int = CHUNK) -> dict[str, int]:
    """All stages; what was done before is not done again. Counts of matched and aligned pairs."""
    os.makedirs(out, exist_ok=True)
    preprocess(spark, lr_folder, hr_folder, out, probe, extract_tool, p, size)
    match_videos(spark, out, p, size)
    if align_tool:
        align_videos(spark, out, align_tool, p, size)
    count = lambda folder: len([n for n in os.listdir(folder) if n.endswith(".png")]) if os.path.isdir(folder) else 0
    return {"matched": count(f"{out}/{MATCHED}/LR"), "aligned": count(f"{out}/{ALIGNED}/LR")}
