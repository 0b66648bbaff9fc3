"""Curation by complexity, brightness and uniqueness of a feature vector (our own definition)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.vectors import mean, median_hash, var_pop
from .dedup import greedy_dedup


def curate(frames: DataFrame, vector="features", group=("video",), min_complexity=0.0, brightness=(-1e9, 1e9), threshold=24) -> DataFrame:
    """frames(*group, i, z, vector): rows complex and bright enough, then the greedy fold on their median hashes."""
    rated = (
        frames.withColumn("brightness", F.round(mean(vector), 6) + 0.0)
        .withColumn("complexity", F.round(var_pop(vector), 6) + 0.0)
        .where((F.col("complexity") >= min_complexity) & F.col("brightness").between(*brightness))
        .withColumn("h", median_hash(vector))
    )
    return greedy_dedup(rated, list(group), threshold)
