"""Sources: listings, images, metadata, probe output, artifact lists. Pixels are read only where they are asked for."""

from __future__ import annotations

import shutil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T

#: The image endings in any case, as a glob.
IMAGE_GLOB = "*.{[pP][nN][gG],[jJ][pP][gG],[jJ][pP][eE][gG]}"
METADATA = "duration double, timestamps map<string,double>, _bad string"


def list_files(spark: SparkSession, folder: str, recursive: bool = False) -> DataFrame:
    """(path, name, length), content not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower()).load(folder)
    return files.select("path", T.file_name("path").alias("name"), "length")


def videos(spark: SparkSession, folder: str, side: str) -> DataFrame:
    """(side, path, name, stem_key, length) of files with a video's ending, in any case."""
    files = list_files(spark, folder).where(T.is_video("name"))
    return files.select(F.lit(side).alias("side"), "path", "name", T.stem_key("name").alias("stem_key"), "length")


def frames(spark: SparkSession, folder: str, side: str) -> DataFrame:
    """(side, video, frame_name, path, length) of <folder>/<video>/<frame>.png."""
    files = list_files(spark, folder, True).where(F.col("name").endswith(".png"))
    return files.select(
        F.lit(side).alias("side"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("video"), F.col("name").alias("frame_name"), "path", "length"
    )


def images(spark: SparkSession, folder: str, drop_invalid: bool = False) -> DataFrame:
    """(path, name, height, width, channels, data) in BGR bytes; unreadable files have null data, or are dropped."""
    reader = spark.read.format("image").option("recursiveFileLookup", "true").option("pathGlobFilter", IMAGE_GLOB)
    rows = reader.option("dropInvalid", str(drop_invalid).lower()).load(folder)
    i = F.col("image")
    good = i["height"] > 0
    return rows.select(
        i["origin"].alias("path"),
        T.file_name(i["origin"]).alias("name"),
        F.when(good, i["height"]).alias("height"),
        F.when(good, i["width"]).alias("width"),
        F.when(good, i["nChannels"]).alias("channels"),
        F.when(good, i["data"]).alias("data"),
    )


def metadata(spark: SparkSession, folder: str) -> DataFrame:
    """(video, duration, frame_name, ts) from <folder>/<video>/metadata.json; bad or incomplete files give no rows."""
    rows = (
        spark.read.schema(METADATA)
        .option("multiLine", "true")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_bad")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "metadata.json")
        .json(folder)
        .select("*", F.col("_metadata.file_path").alias("file"))
    )
    kept = rows.where("_bad IS NULL AND timestamps IS NOT NULL")
    return kept.select(F.regexp_extract("file", r"([^/]+)/[^/]+$", 1).alias("video"), "duration", F.explode("timestamps").alias("frame_name", "ts"))


def artifacts(spark: SparkSession, path: str) -> DataFrame:
    """Names in an artifact list, blank lines dropped."""
    return spark.read.text(path).select(F.trim("value").alias("name")).where("name != ''")


def probe(files: DataFrame, run) -> DataFrame:
    """Files with what an external probe says of them: ``run(path) -> (duration, streams, field log)`` as texts or None.

    A probe that raises or times out gives nulls; rules on the texts are column expressions.
    """
    import pandas as pd

    def call(batches):
        for pdf in batches:
            out = []
            for path in pdf["path"]:
                try:
                    out.append(tuple(run(path)))
                except Exception:
                    out.append((None, None, None))
            yield pd.concat([pdf.reset_index(drop=True), pd.DataFrame(out, columns=["duration_text", "streams_text", "field_log"], dtype=object)], axis=1)

    kinds = ", ".join(f"`{k}` {v}" for k, v in files.dtypes)
    probed = files.mapInPandas(call, f"{kinds}, duration_text string, streams_text string, field_log string")
    counts = T.interlace_counts("field_log")
    return probed.select(
        *files.columns,
        T.duration("duration_text").alias("duration"),
        T.is_hdr("streams_text").alias("hdr"),
        T.is_interlaced(counts["tff"], counts["bff"], counts["progressive"]).alias("interlaced"),
    )


def find_tool(name: str, configured: str | None = None) -> str | None:
    """A configured path that is there, else the one on PATH."""
    return shutil.which(configured) if configured and shutil.which(configured) else shutil.which(name)
