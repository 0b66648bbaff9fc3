"""Pairing, set and membership joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def last_by_stem(videos: DataFrame, key="stem_key", path="path", by=()) -> DataFrame:
    """One video a stem: the last by path."""
    w = Window.partitionBy(*by, key).orderBy(F.desc(path))
    return videos.withColumn("__r", F.row_number().over(w)).where("__r = 1").drop("__r")


def stem_quality(videos: DataFrame, key="stem_key", by=()) -> DataFrame:
    """Count against distinct stems: files that share a stem."""
    return videos.groupBy(*by).agg(F.count(F.lit(1)).alias("files"), F.count_distinct(key).alias("stems"))


def pair(lr: DataFrame, hr: DataFrame, keys: list[str]) -> DataFrame:
    return lr.join(hr, keys)


def unmatched(lr: DataFrame, hr: DataFrame, keys: list[str]) -> DataFrame:
    """Keys of one side only, with the side."""
    a, b = lr.select(*keys).distinct().withColumn("__l", F.lit(1)), hr.select(*keys).distinct().withColumn("__h", F.lit(1))
    both = a.join(b, keys, "full_outer")
    return both.where("__l IS NULL OR __h IS NULL").select(*keys, F.when(F.col("__l").isNull(), "HR").otherwise("LR").alias("side"))


def common(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(*keys).intersect(b.select(*keys))


def existing(rows: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(there, keys, "left_semi")


def missing(rows: DataFrame, there: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(there, keys, "left_anti")


def optional(rows: DataFrame, extra: DataFrame, keys: list[str]) -> DataFrame:
    return rows.join(extra, keys, "left")
