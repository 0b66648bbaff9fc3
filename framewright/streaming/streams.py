"""Streaming forms: interval join, heartbeat windows, tagged log lines, and a resumable stage.

``drain`` runs a streaming frame over what its source holds and returns the result as a table, with its state and
output in the session's shared checkpoint folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import is_image_line
from ..operators import progress
from ..sources.tables import new_path


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Everything the stream returns for what is there now, read from the files it wrote."""
    spark = stream.sparkSession
    path = new_path(spark, "stream")

    def put(batch: DataFrame, number: int) -> None:
        # a batch that is run again after a failure replaces its own output
        batch.write.mode("overwrite").parquet(f"{path}/out/batch={number}")

    query = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{path}/state").foreachBatch(put).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{path}/out").select(*stream.columns)


def events_stream(spark: SparkSession, path: str) -> DataFrame:
    """Files of the table as a stream, with an instant for watermarks."""
    schema = spark.read.parquet(path).schema
    folder, _, name = path.rpartition("/")
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true")
    # one file is read through its folder and its name, a folder of files by itself
    single = name.endswith(".parquet") and not _is_folder(spark, path)
    source = stream.option("pathGlobFilter", name).parquet(folder) if single else stream.parquet(path)
    return source.withColumn("at", F.col("ts").cast("timestamp"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def interval_join_stream(spark: SparkSession, path: str, hours: int = 6) -> DataFrame:
    """Views and clicks of a user at most ``hours`` apart; both sides' state ends with their watermarks."""
    side = lambda kind, name: (
        events_stream(spark, path)
        .where(F.col("event_type") == kind)
        .select(F.col("user_id").alias(f"{name}_user"), F.col("event_id").alias(f"{name}_event"), F.col("at").alias(f"{name}_at"))
        .withWatermark(f"{name}_at", "1 day")
    )
    near = F.expr(f"lr_user = hr_user AND hr_at BETWEEN lr_at - INTERVAL {hours} HOURS AND lr_at + INTERVAL {hours} HOURS")
    return drain(side("view", "lr").join(side("click", "hr"), near).select(F.col("lr_user").alias("user_id"), "lr_event", "hr_event"))


def grouped_counts_stream(spark: SparkSession, path: str) -> DataFrame:
    rows = events_stream(spark, path).groupBy(F.col("user_id").alias("video")).agg(F.min("event_id").alias("first_event"), F.count(F.lit(1)).alias("n"))
    return drain(rows, "complete")


def heartbeat(lines: DataFrame, at: str = "at", every: str = "30 seconds", late: str = "1 minute", value: str = "value") -> DataFrame:
    """Counts of a tool's lines, of those that name an image, and of errors, in tumbling windows; for a stream or a table."""
    return (
        lines.withWatermark(at, late)
        .groupBy(F.window(at, every))
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.count_if(is_image_line(value)).alias("images"),
            F.count_if(F.col(value).rlike("(?i)error")).alias("errors"),
        )
    )


def tagged(lines: DataFrame, value: str = "value", keep=()) -> DataFrame:
    """Log lines as (*keep, kind, text): 'error' where the line says so, else 'line'."""
    return lines.select(*keep, F.when(F.col(value).rlike("(?i)error"), "error").otherwise("line").alias("kind"), F.col(value).alias("text"))


def resumable(stream: DataFrame, stage: str, key: str, log_path: str, work: Callable[[DataFrame], None], checkpoint: str):
    """Start a stage on a stream: each batch's items that the log lacks are worked on, then logged."""

    def step(batch: DataFrame, number: int) -> None:
        todo = progress.pending(batch, progress.read_log(batch.sparkSession, log_path), stage, key).persist()
        try:
            work(todo)
            calls = todo.select(F.lit(stage).alias("stage"), F.col(key).cast("string").alias("item"), F.lit(False).alias("completed"), F.lit(number).cast("long").alias("seq"))
            progress.append_log(calls, log_path)
        finally:
            todo.unpersist()

    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
