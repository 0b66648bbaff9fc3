"""Tables that cut lineage: written to the folder that driver and executors share, and read again.

A lost executor then costs the part of one job that it held, never a longer lineage, and Spark knows each table's size.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: ContextVar[list | None] = ContextVar("scratch", default=None)


def shared_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder. Where ``spark.checkpoint.dir`` is unset, a temporary folder, once, and on one machine only."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        own = sc.getConf().get("spark.checkpoint.dir")
        if own is None:
            if not sc.master.split("[")[0] == "local":
                raise RuntimeError(f"set spark.checkpoint.dir to a folder that all machines share (master: {sc.master})")
            own = tempfile.mkdtemp(prefix="framewright-")
            atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
    return sc.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it again."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._framewright_path = path
    held = _SCRATCH.get()
    if held is not None:
        held.append(out)
    return out


def dropped(df: DataFrame) -> None:
    """Delete the files behind a frame that ``written`` returned and that nothing reads any more."""
    path = getattr(df, "_framewright_path", None)
    if path is None:
        return
    sc = df.sparkSession.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def recorded():
    """Gives a list that takes up the tables written inside, for whoever is to delete them."""
    held: list = []
    token = _SCRATCH.set(held)
    try:
        yield held
    finally:
        _SCRATCH.reset(token)
