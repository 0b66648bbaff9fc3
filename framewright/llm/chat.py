"""Chat formatting by multi-party perspective rotation. DataFrame functions only.

For every participant of a dialogue the whole dialogue is rendered once with that speaker as assistant and the others
as named users; system turns stay system turns. Only the assistant's own words and end marks are trained on: ``mask``
lists their character spans in the rendered text.

Whole dialogues are the default at every length. A dialogue that is too long for one row can be asked for in parts of
``part`` messages: parts joined in order are the whole dialogue, and no task holds more than a part.

Nulls and edge cases: order is by turn (null first), then speaker, then text; rows that repeat all three are said as
often as they come; a null role is the speaker 'unknown'; a null text is empty; rows with a null conv_id are one
dialogue; a dialogue of system turns alone has no participant and no rows; an empty table gives an empty table. Template
marks inside a text or a name are broken up ("<|" becomes "< |"), and white space and control characters in a name
become "_", so that neither can forge a turn. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written


def safe(col: Column) -> Column:
    return F.replace(col, F.lit("<|"), F.lit("< |"))


def safe_name(col: Column) -> Column:
    return F.regexp_replace(safe(col), r"[\x00-\x20\x7f]+", "_")


def _numbered(said: DataFrame) -> DataFrame:
    """said with ``at``, the message's place in its dialogue, counted by ranges that may divide a dialogue."""
    key, words = ["none", "conv"], ["turn", "speaker", "content"]
    ranged = written(said.repartitionByRange(*key, *words).withColumn("range", F.spark_partition_id()), "ranges")
    counts = ranged.groupBy(*key, "range").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("before", F.sum("n").over(Window.partitionBy(*key).orderBy("range")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy(*key, "range").orderBy(*words)) - 1
    return ranged.withColumn("place", place).join(counts, [*key, "range"]).withColumn("at", F.col("before") + F.col("place")).drop("range", "before", "place")


def rotate(turns: DataFrame, conv_col="conv_id", turn_col="turn", speaker_col="role", text_col="text", system=("system",), part: int | None = None) -> DataFrame:
    """(conv_id, perspective, part, messages, rendered, mask), a row for each participant (and part, where asked for).

    messages: array of (role, name, content, trained); mask: array of (first, end) in characters of rendered.
    """
    said = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(speaker_col).cast("string"), F.lit("unknown")).alias("speaker"),
        safe(F.coalesce(F.col(text_col), F.lit(""))).alias("content"),
    )
    turn = F.struct("turn", "speaker", "content")
    people = lambda names: F.array_except(F.array_distinct(names), F.array(*map(F.lit, system)))
    if part is None:
        # sort_array puts a null turn first
        whole = said.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns")).withColumn("part", F.lit(0).cast("long"))
        seen = whole.withColumn("perspective", F.explode(people(F.col("turns.speaker"))))
    else:
        # a null conv_id is a key like any other: joins go by (is null, value)
        keyed = said.withColumn("none", F.col("conv_id").isNull()).withColumn("conv", F.coalesce(F.col("conv_id").cast("string"), F.lit("")))
        cut = _numbered(keyed).withColumn("part", F.floor(F.col("at") / part).cast("long"))
        parts = cut.groupBy("none", "conv", "conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
        speakers = keyed.where(~F.col("speaker").isin(*system)).select("none", "conv", F.col("speaker").alias("perspective")).distinct()
        seen = parts.join(speakers, ["none", "conv"])
    role = lambda t: (
        F.when(t["speaker"].isin(*system), F.lit("system")).when(t["speaker"] == F.col("perspective"), F.lit("assistant")).otherwise(F.lit("user"))
    )
    seen = seen.withColumn(
        "messages",
        F.transform(
            "turns",
            lambda t: F.struct(
                role(t).alias("role"),
                F.when(role(t) == "user", safe_name(t["speaker"])).alias("name"),
                t["content"].alias("content"),
                (t["speaker"] == F.col("perspective")).alias("trained"),
            ),
        ),
    )
    head = lambda m: F.concat(F.lit("<|im_start|>"), m["role"], F.coalesce(F.concat(F.lit(" name="), m["name"]), F.lit("")), F.lit("\n"))
    pieces = F.transform("messages", lambda m: F.concat(head(m), m["content"], F.lit("<|im_end|>\n")))
    tail, end = len("<|im_end|>\n"), len("<|im_end|>")
    # messages' lengths first, so that a step of the running sum touches numbers only
    sizes = F.transform("messages", lambda m: F.struct(F.length(head(m)).alias("h"), F.length(m["content"]).alias("c"), m["trained"].alias("t")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<first:int,end:int>>").alias("spans"))

    def step(acc, m):
        first = acc["at"] + m["h"]
        stop = first + m["c"]
        span = F.array(F.struct(first.alias("first"), (stop + end).alias("end")))
        return F.struct((stop + tail).alias("at"), F.when(m["t"], F.concat(acc["spans"], span)).otherwise(acc["spans"]).alias("spans"))

    return seen.select(
        "conv_id",
        "perspective",
        "part",
        "messages",
        F.array_join(pieces, "").alias("rendered"),
        F.aggregate(sizes, start, step, lambda acc: acc["spans"]).alias("mask"),
    )


def op2_chat(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return rotate(turns).select(
        "conv_id",
        "perspective",
        F.size("messages").cast("long").alias("n_messages"),
        "rendered",
        F.array_join(F.transform("mask", lambda s: F.concat_ws("-", s["first"], s["end"])), ",").alias("mask"),
    )


SQL = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS speaker, replace(coalesce(text, ''), '<|', '< |') AS content,
         regexp_replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '[\x00-\x20\x7f]+', '_', 'g') AS shown FROM conversations),
people AS (SELECT DISTINCT conv_id, speaker AS perspective FROM said WHERE speaker <> 'system'),
m AS (
  SELECT s.*, p.perspective, s.speaker = p.perspective AS trained,
         '<|im_start|>' || CASE WHEN speaker = 'system' THEN 'system' WHEN speaker = perspective THEN 'assistant'
           ELSE 'user name=' || shown END || chr(10) AS head
  FROM said s JOIN people p ON s.conv_id IS NOT DISTINCT FROM p.conv_id),
placed AS (
  SELECT *, head || content || '<|im_end|>' || chr(10) AS piece,
         row_number() OVER w AS n,
         coalesce(sum(length(head) + length(content) + 11) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos FROM m
  WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, content))
SELECT conv_id, perspective, count(*) AS n_messages, string_agg(piece, '' ORDER BY n) AS rendered,
       coalesce(string_agg(CAST(pos + length(head) AS BIGINT) || '-' || CAST(pos + length(head) + length(content) + 10 AS BIGINT), ','
         ORDER BY n) FILTER (WHERE trained), '') AS mask
FROM placed GROUP BY conv_id, perspective
"""
