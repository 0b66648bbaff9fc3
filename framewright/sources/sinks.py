"""Sinks: PNG files, metadata, matched and aligned sets. Outputs are overwritten whole, so a run can be repeated."""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import matched_name


def png(bgr: np.ndarray) -> bytes:
    """An image as PNG, without an imaging library."""
    h, w = bgr.shape[:2]
    channels = 1 if bgr.ndim == 2 else bgr.shape[2]
    rows = bgr.reshape(h, w, channels)[..., ::-1] if channels == 3 else bgr.reshape(h, w, channels)
    raw = np.concatenate([np.zeros((h, 1), np.uint8), np.ascontiguousarray(rows).reshape(h, -1)], axis=1).tobytes()
    part = lambda kind, data: struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))
    head = struct.pack(">IIBBBBB", w, h, 8, 2 if channels == 3 else 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + part(b"IHDR", head) + part(b"IDAT", zlib.compress(raw)) + part(b"IEND", b"")


def encoded(images: DataFrame) -> DataFrame:
    """images(name, height, width, channels, data) -> (name, png)."""
    @F.pandas_udf("binary")
    def encode(data: pd.Series, h: pd.Series, w: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([None if d is None else png(np.frombuffer(bytes(d), np.uint8).reshape(int(a), int(b), int(k))) for d, a, b, k in zip(data, h, w, c)])

    return images.select("name", encode("data", "height", "width", "channels").alias("png"))


def write_files(named: DataFrame, folder: str) -> None:
    """named(name, png): a file a row. The folder is a path or URI that all executors share (file, hdfs, s3)."""

    def put(rows):
        from pyarrow import fs

        store, root = fs.FileSystem.from_uri(folder) if "://" in folder else (fs.LocalFileSystem(), folder)
        store.create_dir(root, recursive=True)
        for r in rows:
            with store.open_output_stream(f"{root}/{r['name']}") as f:
                f.write(bytes(r["png"]))

    named.where("png IS NOT NULL").foreachPartition(put)


def write_metadata(frames: DataFrame, folder: str) -> None:
    """frames(side, video, duration, frame_name, ts) -> JSON partitioned by side and video; empty sets write nothing."""
    rows = frames.groupBy("side", "video", "duration").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("frame_name", "ts")))).alias("timestamps"))
    rows.write.mode("overwrite").partitionBy("side", "video").json(folder)


def matched_set(matches: DataFrame) -> DataFrame:
    """matches(video, lr_frame, hr_frame) -> (side, video, source, name): both sides take the LR frame's name."""
    name = matched_name("video", "lr_frame")
    side = lambda s, c: matches.select(F.lit(s).alias("side"), "video", F.col(c).alias("source"), name.alias("name"))
    return side("LR", "lr_frame").unionByName(side("HR", "hr_frame"))


def write_set(rows: DataFrame, folder: str) -> None:
    """Any set of frames as Parquet, partitioned by side."""
    rows.write.mode("overwrite").partitionBy("side").parquet(folder)


def counters(**frames: DataFrame) -> DataFrame:
    """(counter, n) of each frame given."""
    parts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("counter"), "n") for k, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
