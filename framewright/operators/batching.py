"""Batches for an external aligner, its command line, and the collection of its results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import stem
from ..params import Params


def batches(images: DataFrame, video="video", name="name", p: Params = Params()) -> DataFrame:
    """Images with batch (from 0), batches and output suffix, by name order in each video. A batch size of 0 is no limit."""
    by = Window.partitionBy(video)
    at = F.row_number().over(by.orderBy(name)) - 1
    numbered = images.withColumn("batch", (F.floor(at / p.align_batch) if p.align_batch > 0 else F.lit(0)).cast("int"))
    counted = numbered.withColumn("batches", (F.max("batch").over(by) + 1).cast("int"))
    return counted.withColumn(
        "suffix", F.when(F.col("batches") > 1, F.concat(F.lit("_batch_"), (F.col("batch") + 1).cast("string"))).otherwise("")
    )


def command(tool: str, lr: str, hr: str, out: str, p: Params = Params()) -> list[str]:
    """The aligner's arguments."""
    args = [tool, "-s", str(p.align_scale), "-m", "0", "-g", hr, "-l", lr, "-c", "-j", "-ai", "-o", out]
    return args + (["-i", "1"] if p.align_color_copy else [])


def aligned(pairs: DataFrame, aligner: Callable, schema: str) -> DataFrame:
    """Runs ``aligner`` on one pandas frame a (video, batch); a batch has at most ``align_batch`` rows.

    The aligner is any function from pandas frame to pandas frame, so a test needs no external tool. Spark's task
    retries replace the tool's own.
    """
    return pairs.groupBy("video", "batch").applyInPandas(aligner, schema)


def supervised(cmd: list[str], timeout: float, on_line: Callable[[str], None] = lambda line: None, quiet: bool = False) -> tuple[bool, list[str]]:
    """Run a tool, pass on its lines; terminate, then kill it after ``timeout`` seconds. (ended well, last 10 lines).

    quiet: a tool in Python is told to keep its warnings to itself.
    """
    import os
    import subprocess
    import threading
    from collections import deque

    last: deque[str] = deque(maxlen=10)
    try:
        proc = subprocess.Popen(cmd, stdout=subprocess.PIPE, stderr=subprocess.STDOUT, text=True, errors="replace", env=os.environ | ({"PYTHONWARNINGS": "ignore"} if quiet else {}))
    except OSError as e:
        return False, [str(e)]

    def read(lines: Iterator[str]) -> None:
        for line in lines:
            last.append(line.rstrip("\n"))
            on_line(last[-1])

    reader = threading.Thread(target=read, args=(proc.stdout,), daemon=True)
    reader.start()
    try:
        code = proc.wait(timeout)
    except subprocess.TimeoutExpired:
        proc.terminate()
        try:
            proc.wait(2)
        except subprocess.TimeoutExpired:
            proc.kill()
            proc.wait()
        code = -1
    reader.join(2)
    return code == 0, list(last)


def collect_results(outputs: DataFrame, artifacts: DataFrame, hr: DataFrame, overlay: DataFrame) -> DataFrame:
    """outputs(name) without artifacts(name), each with its HR and overlay where there is one."""
    bad = artifacts.where(F.trim("name") != "").select(stem(F.trim("name")).alias("__stem")).distinct()
    kept = outputs.withColumn("__stem", stem("name")).join(bad, "__stem", "left_anti").drop("__stem")
    mark = lambda df, c: df.select("name").distinct().withColumn(c, F.lit(True))
    return (
        kept.join(mark(hr, "has_hr"), "name", "left")
        .join(mark(overlay, "has_overlay"), "name", "left")
        .select("name", F.coalesce("has_hr", F.lit(False)).alias("has_hr"), F.coalesce("has_overlay", F.lit(False)).alias("has_overlay"))
    )
