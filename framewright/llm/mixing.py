"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks. DataFrame functions only.

1. Sources in code point order (null last) weigh 3, 1, 2, repeating, and share 150 % of all words. A target stops
   at twice its source's size; what is over is shared again by weight. In closed form: target = least(2 * size,
   weight * level), where the level comes from one pass over the sources ordered by 2 * size / weight.
2. Blocks of ``BLOCK`` words are seats: the sources get them by highest quotients target / (2 j - 1), then each
   source's groups of shards by their sizes, then each group's shards. No step ranks more than the sources, a source's
   groups (one for every ``GROUP`` * ``SHARD`` words) or a group's shards. Each starts from a rounding that is proven to
   be at most one seat a member too low (divisor V / (Q - k/2)), so only about three quotients a member are ranked, not
   all seats. Sources whose target is under ``LEAST`` blocks share theirs in blocks of one word, or a block's size
   would decide whether they get anything.
3. A shard's documents lie in a seeded order on one tape, cut into blocks. A quota q over n blocks takes every
   block q div n times and q mod n of them once more, evenly spaced from a seeded start. That has a closed form,
   so the words taken from a document come from its two tape positions alone.

Rows of one id, text and source are one class, counted before anything is ordered, so a group of copies costs one row
on the tape; its copies follow each other there. A hot source has as many shards as its size asks for, by a hash of id,
text and source; no step gathers a source.
Nulls and edge cases: a null text has size 0; documents without words take 0; a null id is ordered by its text;
a null source is a source of its own; repeated rows are documents of their own. An empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import WORD, word_count

BLOCK = 64
LEAST = 16
SHARD = 1 << 18
GROUP = 1024
#: Copies of a class that one task writes out.
COPIES = 4096
SEED = "mix-1"


def _draw(*cols: Column) -> Column:
    """A seeded number of 52 bits from md5, the same in other engines."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(SEED), *cols)), 1, 13), 16, 10).cast("long")


def sainte_lague(members: DataFrame, group: list[str], order: str, votes: str, seats: str) -> DataFrame:
    """members with a column ``quota``: the seats of each group by highest quotients votes / (2 j - 1), ties by ``order``.

    ``seats`` is the same in all rows of a group. Members without votes get none.
    """
    by = Window.partitionBy(*group)
    m = (
        members.withColumn("__v", F.sum(F.col(votes)).over(by))
        .withColumn("__k", F.count(F.lit(1)).over(by))
        .withColumn("__share", F.when(F.col("__v") > 0, F.col(votes) / F.col("__v")).otherwise(0.0))
        .withColumn("__low", F.floor(F.greatest(F.col("__share") * (F.col(seats) - F.col("__k") / 2), F.lit(0.0)) + 0.5))
        .withColumn("__high", F.floor(F.col("__share") * (F.col(seats) + F.col("__k") / 2) + 0.5) + 1)
        .withColumn("__left", F.col(seats) - F.sum("__low").over(by))
    )
    asked = (
        m.where((F.col("__left") > 0) & (F.col(votes) > 0))
        .withColumn("__j", F.explode(F.expr("sequence(__low + 1, __high)")))
        .withColumn("__q", F.col(votes) / (2 * F.col("__j") - 1))
        .withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy(F.desc("__q"), order, "__j")))
        .where("__r <= __left")
        .groupBy(*group, order)
        .agg(F.count(F.lit(1)).alias("__more"))
    )
    return (
        m.join(asked, [*group, order], "left")
        .withColumn("quota", (F.col("__low") + F.coalesce("__more", F.lit(0))).cast("long"))
        .drop("__v", "__k", "__share", "__low", "__high", "__left", "__more")
    )


def targets(sized: DataFrame, weights=(3, 1, 2)) -> DataFrame:
    """sized(source, size, copies) -> (no, source, source_size, target, width, seats, shards), a row a source."""
    everything = Window.partitionBy("one")
    by_ratio = everything.orderBy("ratio", "no")
    return (
        sized.groupBy("source")
        .agg(F.sum(F.col("size") * F.col("copies")).alias("source_size"))
        .withColumn("one", F.lit(1))
        .withColumn("no", F.row_number().over(everything.orderBy(F.asc_nulls_last("source"))))
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), ((F.col("no") - 1) % len(weights) + 1).cast("int")))
        .withColumn("ratio", 2 * F.col("source_size") / F.col("weight"))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("before", F.coalesce(F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        .withColumn("rest", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
        .withColumn("level", (3 * F.col("total") - 4 * F.col("before")) / (2 * F.col("rest")))
        .withColumn("first", F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "no", "level"))).over(everything))
        .withColumn(
            "target",
            F.least(2.0 * F.col("source_size"), F.coalesce(F.col("weight") * F.col("first.level"), 2.0 * F.col("source_size"))),
        )
        .withColumn("width", F.when(F.col("target") >= LEAST * BLOCK, BLOCK).otherwise(1).cast("long"))
        .withColumn("seats", F.floor(F.round(F.sum("target").over(Window.partitionBy("width")), 3) / F.col("width") + 0.5).cast("long"))
        .withColumn("shards", F.greatest(F.ceil(F.col("source_size") / SHARD), F.lit(1)).cast("long"))
        .select("no", "source", "source_size", "target", "width", "seats", "shards")
    )


def _copies(classes: DataFrame) -> DataFrame:
    """A row (``copy`` from 0) for each of a class's ``copies``; many copies are written out by many tasks."""
    few = classes.where(F.col("copies") <= COPIES).withColumn("copy", F.explode(F.expr("sequence(0L, copies - 1)")))
    many = (
        classes.where(F.col("copies") > COPIES)
        .withColumn("chunk", F.explode(F.expr(f"sequence(0L, (copies - 1) div {COPIES})")))
        .repartition("key", "chunk")
        .withColumn("copy", F.explode(F.expr(f"sequence(chunk * {COPIES}, least(copies, (chunk + 1) * {COPIES}) - 1)")))
        .drop("chunk")
    )
    return few.unionByName(many)


def _numbered(sized: DataFrame, row: str) -> DataFrame:
    """(key, copy, row): the rows of each key numbered from 0, counted by the scan's parts, which divide a hot key."""
    chunked = sized.select("key", row, F.shiftright(row, 33).alias("chunk"))
    counts = chunked.groupBy("key", "chunk").agg(F.count(F.lit(1)).alias("n"))
    counts = counts.select("key", "chunk", (F.sum("n").over(Window.partitionBy("key").orderBy("chunk")) - F.col("n")).alias("before"))
    own = chunked.withColumn("place", F.row_number().over(Window.partitionBy("key", "chunk").orderBy(row)) - 1)
    return own.join(counts, ["key", "chunk"]).select("key", (F.col("before") + F.col("place")).cast("long").alias("copy"), row)


def plan(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source", weights=(3, 1, 2), row: str | None = None) -> DataFrame:
    """(doc_id, key, copy, source, size, source_size, target, width, base, extra, blocks, start, at, taken), a row a document.

    ``at`` is the document's first word on its shard's tape; ``base``, ``extra``, ``blocks`` (of ``width`` words) and
    ``start`` say how often the shard's blocks are taken. ``key`` names the class. ``row``: a column with
    monotonically increasing ids, written before, that is to come along.
    """
    sized = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.concat(
                F.coalesce(F.col(id_col).cast("string"), F.lit("")),
                F.lit("|"),
                F.md5(F.coalesce(F.col(text_col), F.lit(""))),
                F.lit("|"),
                F.coalesce(F.concat(F.lit("s"), F.col(source_col)), F.lit("n")),
            ).alias("key"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size"),
            *([row] if row else []),
        ),
        "sizes",
    )
    classes = written(sized.groupBy("key", "doc_id", "source", "size").agg(F.count(F.lit(1)).alias("copies")), "classes")
    sources = written(sainte_lague(targets(classes, weights), ["width"], "no", "target", "seats"), "sources")
    placed = (
        classes.join(sources, classes.source.eqNullSafe(sources.source))
        .select("doc_id", "key", classes.source, "size", "copies", "source_size", "target", "width", "no", F.col("quota").alias("source_quota"), "shards")
        .withColumn("draw", _draw(F.col("key")))
        .withColumn("shard", F.pmod("draw", "shards"))
    )
    lengths = placed.where("size > 0").groupBy("no", "shard", "width", "source_quota").agg(F.sum(F.col("size") * F.col("copies")).alias("length"))
    lengths = written(lengths.withColumn("grp", F.expr(f"shard div {GROUP}")), "shards")
    groups = sainte_lague(lengths.groupBy("no", "grp", "source_quota").agg(F.sum("length").alias("length")), ["no"], "grp", "length", "source_quota")
    shards = lengths.join(groups.select("no", "grp", F.col("quota").alias("group_quota")), ["no", "grp"])
    quotas = (
        sainte_lague(shards, ["no", "grp"], "shard", "length", "group_quota")
        .withColumn("blocks", F.ceil(F.col("length") / F.col("width")).cast("long"))
        .withColumn("quota", F.least(F.col("quota"), 2 * F.col("blocks")))
        .select(
            "no",
            "shard",
            "blocks",
            F.expr("quota div blocks").alias("base"),
            F.expr("quota % blocks").alias("extra"),
            F.pmod(_draw(F.lit("start"), F.col("no").cast("string"), F.col("shard").cast("string")), F.col("blocks")).alias("start"),
        )
    )
    tape = Window.partitionBy("no", "shard").orderBy("draw", "key").rowsBetween(Window.unboundedPreceding, -1)
    worded = placed.where("size > 0").withColumn("first", F.coalesce(F.sum(F.col("size") * F.col("copies")).over(tape), F.lit(0)))
    got = (
        _copies(worded.join(quotas, ["no", "shard"]))
        .withColumn("at", F.col("first") + F.col("copy") * F.col("size"))
        .withColumn("taken", F.col("base") * F.col("size") + _extra_before(F.col("at") + F.col("size")) - _extra_before(F.col("at")))
    )
    names = ["doc_id", "key", "copy", "source", "size", "source_size", "target", "width", "base", "extra", "blocks", "start", "at", "taken"]
    empty = _copies(placed.where("size = 0"))
    none = empty.select(*[F.col(x) if x in empty.columns else F.lit(0).cast("long").alias(x) for x in names])
    out = got.select(*names).unionByName(none)
    return out.join(_numbered(sized, row), ["key", "copy"]) if row else out


def _chosen_before(block: Column, start="start", extra="extra", blocks="blocks") -> Column:
    """How many of the blocks before this one are taken once more."""
    s, e, n = (F.col(c) if isinstance(c, str) else c for c in (start, extra, blocks))
    return F.floor((block + s) * e / n) - F.floor(s * e / n)


def _extra_before(word: Column) -> Column:
    """Words that the extra pass takes from the tape before this position."""
    width = F.col("width")
    block = F.floor(word / width)
    return (_chosen_before(block) * width + (_chosen_before(block + 1) - _chosen_before(block)) * (word - block * width)).cast("long")


def mix(docs: DataFrame, id_col="doc_id", text_col="text", source_col="source") -> DataFrame:
    """The mix itself, with the columns of ``docs``: a row for each whole pass over a document, and one with the words
    of its blocks that are taken once more, white space between them kept. Documents of which nothing is taken go."""
    # rows are numbered in a written table, so that each meets its own part of the plan, whatever its id
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()), "rows")
    words_of = ["size", "width", "base", "extra", "blocks", "start", "at", "taken"]
    found = plan(rows, id_col, text_col, source_col, row="__row").where("taken > 0").select(
        "__row", F.struct(*words_of).alias("__plan")
    )
    p = {c: F.col(f"__plan.{c}") for c in words_of}
    chosen = lambda b: _chosen_before(b, p["start"], p["extra"], p["blocks"])
    a, z = F.floor(p["at"] / p["width"]), F.floor((p["at"] + p["size"] - 1) / p["width"])
    pieces = F.transform(
        F.filter(F.sequence(a, z), lambda b: chosen(b + 1) > chosen(b)),
        lambda b: F.struct(
            F.greatest(b * p["width"] - p["at"], F.lit(0)).alias("a"), F.least((b + 1) * p["width"] - p["at"], p["size"]).alias("z")
        ),
    )
    more = p["taken"] - p["base"] * p["size"]
    words = F.regexp_extract_all(F.col(text_col), F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    some = F.array_join(
        F.flatten(F.transform("__pieces", lambda x: F.slice(F.col("__words"), (x["a"] + 1).cast("int"), (x["z"] - x["a"]).cast("int")))), ""
    )
    passes = F.sequence(F.lit(1).cast("long"), p["base"] + F.when(more > 0, 1).otherwise(0))
    out = (
        rows.join(found, "__row")
        .withColumn("__pass", F.explode(passes))
        .withColumn("__part", (F.col("__pass") > p["base"]) & (more < p["size"]))
        .withColumn("__pieces", F.when(F.col("__part"), pieces))
        .withColumn("__words", F.when(F.col("__part"), words))
        .withColumn(text_col, F.when(F.col("__part"), some).otherwise(F.col(text_col)))
    )
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("__part"), F.length(text_col).cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return plan(docs).select("doc_id", "size", "source_size", "target", "taken", "source")


def _apportioned(name: str, rows: str, by: str, order: str, votes: str, seats: str) -> str:
    """SQL of ``sainte_lague``: ``name`` has the columns of ``rows`` and the quota."""
    n, keys = name, ", ".join(x for x in (by, order) if x)
    part = f"PARTITION BY {by}" if by else ""
    same = " AND ".join(f"m.{k} = p.{k}" for k in keys.split(", "))
    return f"""
{n}_1 AS (SELECT *, sum({votes}) OVER ({part}) AS v, count(*) OVER ({part}) AS k FROM {rows}),
{n}_2 AS (SELECT *, CASE WHEN v > 0 THEN {votes}::DOUBLE / v ELSE 0 END AS share FROM {n}_1),
{n}_3 AS (SELECT *, CAST(floor(greatest(share * ({seats} - k::DOUBLE / 2), 0) + 0.5) AS BIGINT) AS low,
         CAST(floor(share * ({seats} + k::DOUBLE / 2) + 0.5) AS BIGINT) + 1 AS high FROM {n}_2),
{n}_4 AS (SELECT *, {seats} - CAST(sum(low) OVER ({part}) AS BIGINT) AS remaining FROM {n}_3),
{n}_5 AS (SELECT {keys}, remaining, {votes} AS vote, unnest(range(low + 1, high + 1)) AS j FROM {n}_4 WHERE remaining > 0 AND {votes} > 0),
{n}_6 AS (SELECT *, row_number() OVER ({part} ORDER BY vote::DOUBLE / (2 * j - 1) DESC, {order}, j) AS r FROM {n}_5),
{n}_7 AS (SELECT {keys}, count(*) AS more FROM {n}_6 WHERE r <= remaining GROUP BY ALL),
{n} AS (SELECT p.* EXCLUDE (v, k, share, low, high, remaining), low + coalesce(more, 0) AS quota FROM {n}_4 p LEFT JOIN {n}_7 m ON {same})"""


def sql(block: int = BLOCK, shard: int = SHARD, group: int = GROUP) -> str:
    return f"""
WITH sized AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, '')) || '|' || coalesce('s' || source, 'n') AS key, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
  FROM documents),
s1 AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
s2 AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS no FROM s1),
s3 AS (SELECT *, [3, 1, 2][(no - 1) % 3 + 1] AS weight, CAST(sum(source_size) OVER () AS BIGINT) AS total FROM s2),
s4 AS (SELECT *, CAST(2 * source_size AS DOUBLE) / weight AS ratio FROM s3),
s5 AS (SELECT *, CAST(coalesce(sum(source_size) OVER (ORDER BY ratio, no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before,
         CAST(sum(weight) OVER (ORDER BY ratio, no ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS rest FROM s4),
s6 AS (SELECT *, CAST(3 * total - 4 * before AS DOUBLE) / (2 * rest) AS level FROM s5),
s7 AS (SELECT *, (SELECT i.level FROM s6 i WHERE i.ratio > i.level ORDER BY i.ratio, i.no LIMIT 1) AS lev FROM s6),
s8 AS (SELECT no, source, source_size, least(2.0::DOUBLE * source_size, coalesce(weight * lev, 2.0::DOUBLE * source_size)) AS target FROM s7),
s9 AS (SELECT *, CASE WHEN target >= {LEAST * block} THEN {block} ELSE 1 END AS width,
         CAST(greatest(ceil(source_size::DOUBLE / {shard}), 1) AS BIGINT) AS shards FROM s8),
s10 AS (SELECT *, CAST(floor(round(sum(target) OVER (PARTITION BY width), 3) / width + 0.5) AS BIGINT) AS seats FROM s9),
{_apportioned("sources", "s10", "width", "no", "target", "seats")},
placed AS (SELECT d.doc_id, d.key, d.source, d.size, s.source_size, s.target, s.width, s.no, s.quota AS source_quota, s.shards,
         CAST('0x' || substr(md5('{SEED}|' || d.key), 1, 13) AS BIGINT) AS draw
  FROM sized d JOIN sources s ON d.source IS NOT DISTINCT FROM s.source),
p2 AS (SELECT *, draw % shards AS shard FROM placed),
b0 AS (SELECT no, shard, shard // {group} AS grp, width, source_quota, CAST(sum(size) AS BIGINT) AS length FROM p2 WHERE size > 0 GROUP BY ALL),
g0 AS (SELECT no, grp, source_quota, CAST(sum(length) AS BIGINT) AS length FROM b0 GROUP BY ALL),
{_apportioned("groups_", "g0", "no", "grp", "length", "source_quota")},
b1 AS (SELECT b0.*, g.quota AS group_quota FROM b0 JOIN groups_ g ON b0.no = g.no AND b0.grp = g.grp),
{_apportioned("b2", "b1", "no, grp", "shard", "length", "group_quota")},
b8 AS (SELECT no, shard, width, quota, CAST(ceil(length::DOUBLE / width) AS BIGINT) AS blocks FROM b2),
quotas AS (SELECT no, shard, blocks, least(quota, 2 * blocks) // blocks AS base, least(quota, 2 * blocks) % blocks AS extra,
         CAST('0x' || substr(md5('{SEED}|start|' || no || '|' || shard), 1, 13) AS BIGINT) % blocks AS start FROM b8),
tape AS (SELECT *, row_number() OVER () AS row,
         CAST(coalesce(sum(size) OVER (PARTITION BY no, shard ORDER BY draw, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS pos
  FROM p2 WHERE size > 0),
ends AS (SELECT t.*, q.base, q.extra, q.blocks, q.start, unnest([pos, pos + size]) AS word, unnest([-1, 1]) AS sign
  FROM tape t JOIN quotas q ON t.no = q.no AND t.shard = q.shard),
e2 AS (SELECT *, word // width AS block FROM ends),
e3 AS (SELECT *, ((block + start) * extra) // blocks - (start * extra) // blocks AS c0,
         ((block + 1 + start) * extra) // blocks - (start * extra) // blocks AS c1 FROM e2),
got AS (SELECT row, doc_id, source, size, source_size, target,
         CAST(any_value(base) * size + sum(sign * (c0 * width + (c1 - c0) * (word - block * width))) AS BIGINT) AS taken
  FROM e3 GROUP BY row, doc_id, source, size, source_size, target)
SELECT doc_id, size, source_size, target, taken, source FROM got
UNION ALL
SELECT doc_id, size, source_size, target, CAST(0 AS BIGINT), source FROM p2 WHERE size = 0
"""


SQL = sql()
