"""A corpus pipeline of five stages, each by one of the training-data operators.

Every stage is written as Parquet to the session's shared checkpoint folder and read again as the next one's input. The
tables that a stage works with are deleted when the next stage begins: by then its result has to be written, as run()
does it. All stages but the last return the columns of ``documents``;
the last returns the packed texts: bin, place in it, document, piece and the piece's text. Packing and a trained score
aren't SQL, so there is no ORACLE_SQL; tests hold run() against plain Python versions of the stages.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from framewright.llm import mixing, near_copies, packing, pii, toxicity
from framewright.llm.common import release
from framewright.sources.tables import dropped, recorded, written

#: Tables that the stage before works with.
_LEFT: list[DataFrame] = []


def stage(f):
    @wraps(f)
    def begin(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        while _LEFT:
            dropped(_LEFT.pop())
        release(spark)
        with recorded() as held:
            out = f(spark, docs, sf_dir)
        _LEFT.extend(held)
        return out

    return begin


@stage
def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score 0.7 or more for toxicity go."""
    return toxicity.reject(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: SimHash of five-word shingles, links confirmed at a similarity of 0.8."""
    return near_copies.keep_one(docs)


@stage
def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data are replaced by their kind."""
    return pii.redact(docs)


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources come to their target weights: whole passes over a document, and the words of blocks taken once more."""
    return mixing.mix(docs)


@stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document gets a bin and a place in it."""
    return packing.packed_texts(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("pii", redact_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        after = written(step(spark, docs, sf_dir), f"stage-{name}")
        dropped(docs)  # the input itself is no such table and stays
        docs = after
    while _LEFT:
        dropped(_LEFT.pop())
    return docs
