"""The resumable stage log: append-only calls, their latest state, and what is still to do."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "stage string, item string, completed boolean, seq long"


def state(log: DataFrame) -> DataFrame:
    """log(stage, item, completed, seq) -> (stage, items, completed).

    A call may carry an item, completed = true, or both. One with an item and without completed resets the flag; one
    with neither changes nothing but makes the stage known.
    """
    says = F.col("item").isNotNull() | F.coalesce("completed", F.lit(False))
    return log.groupBy("stage").agg(
        F.array_sort(F.collect_set("item")).alias("items"),
        F.coalesce(F.max_by(F.when(says, F.coalesce("completed", F.lit(False))), F.when(says, F.col("seq"))), F.lit(False)).alias("completed"),
    )


def pending(items: DataFrame, log: DataFrame, stage: str, key: str) -> DataFrame:
    """Items that the stage has not logged."""
    done = log.where((F.col("stage") == stage) & F.col("item").isNotNull()).select(F.col("item").alias("__done")).distinct()
    return items.join(done, F.col(key) == F.col("__done"), "left_anti")


def read_log(spark, path: str) -> DataFrame:
    """The log, empty where there is none."""
    from pyspark.errors import AnalysisException

    try:
        return spark.read.schema(SCHEMA).json(path)
    except AnalysisException:
        return spark.createDataFrame([], SCHEMA)


def append_log(calls: DataFrame, path: str) -> None:
    calls.select("stage", "item", "completed", "seq").write.mode("append").json(path)


def summary(log: DataFrame) -> DataFrame:
    return log.where("item IS NOT NULL").groupBy("stage").agg(F.count_distinct("item").alias("items"))
