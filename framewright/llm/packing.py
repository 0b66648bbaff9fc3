"""Best-fit packing into variable capacities.

Several sequence lengths are permitted. Documents longer than the largest are cut into whole sequences of that length
and a rest; rests are dealt to shards by a hash of id and row, about ``SHARD`` to a shard, and each shard is packed by
itself with best-fit decreasing: a rest goes to the open bin that it leaves fullest. Where none has room, a bin of the
least-cost capacity is opened: the one with the lowest price for each word that it can be expected to hold, given the
rests still to come. The permitted lengths are optimised jointly: a shard is packed once with each prefix of the
lengths as what may be opened, and the packing of the lowest total price is kept. Finally every bin is downsized to
the smallest length that holds its contents.

``best_fit`` moves ids and sizes only; ``packed_texts`` adds each piece's text. Words are the unit; ``size_col`` takes
any other count, tokens say. Nulls and edge cases: a null or empty text has no words and goes to no bin (bin_id and
capacity null); a null id is packed like any other; repeated rows and ids are packed each, told apart by their row; an
empty table gives an empty table.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import WORD, word_count

LENGTHS = (256, 512, 1024, 2048, 4096)
SHARD = 8192
#: Price of a bin: its length and a fixed part, here 16 words' worth, for what a sequence costs by itself.
FIXED = 16


def _fill(sizes: list[int], upto: np.ndarray, total: np.ndarray, lengths: tuple) -> list[list[int]]:
    """Bins of positions in ``sizes`` (descending). total[k]: words of sizes[k:], upto: first position of a size <= x."""
    room: list[tuple[int, int]] = []  # (free, bin), sorted
    bins: list[list[int]] = []
    n = len(sizes)
    for k, s in enumerate(sizes):
        at = bisect_left(room, (s, -1))
        if at < len(room):
            free, b = room.pop(at)
            bins[b].append(k)
            if free > s:
                insort(room, (free - s, b))
            continue
        best = None
        for c in lengths:
            if c < s:
                continue
            to_come = int(total[max(k + 1, int(upto[c - s]))]) if k + 1 < n else 0
            rate = (c + FIXED) / (s + min(c - s, to_come))
            if best is None or rate < best[0]:
                best = (rate, c)
        bins.append([k])
        if best[1] > s:
            insort(room, (best[1] - s, len(bins) - 1))
    return bins


def pack(sizes: list[int], lengths: tuple = LENGTHS) -> list[tuple[int, list[int]]]:
    """(capacity, positions) of bins for ``sizes``, none above the largest length. Ties keep the given order."""
    lengths = tuple(sorted(lengths))
    if not sizes:
        return []
    order = sorted(range(len(sizes)), key=lambda k: -sizes[k])
    down = [sizes[k] for k in order]
    total = np.concatenate([np.cumsum(down[::-1])[::-1], [0]])
    negative = -np.array(down)
    upto = np.searchsorted(negative, -np.arange(lengths[-1] + 1))  # first position whose size is at most x
    best = None
    for k in range(len(lengths)):
        if lengths[k] < down[0] and k + 1 < len(lengths):
            continue
        bins = _fill(down, upto, total, lengths[: k + 1])
        held = [sum(down[x] for x in b) for b in bins]
        caps = [lengths[bisect_left(lengths, h)] for h in held]
        price = sum(caps) + FIXED * len(caps)
        if best is None or price < best[0]:
            best = (price, [(c, [order[x] for x in b]) for c, b in zip(caps, bins)])
    return best[1]


def best_fit(docs: DataFrame, id_col="doc_id", text_col="text", size_col=None, lengths: tuple = LENGTHS, row: str | None = None) -> DataFrame:
    """(doc_id, row, piece, first, length, bin_id, capacity, bin_offset), a row a piece of a document.

    row: a column that numbers the rows, written before; else they are numbered here.
    """
    lengths = tuple(sorted(lengths))
    top = lengths[-1]
    size = F.col(size_col).cast("long") if size_col else word_count(F.col(text_col))
    rows = written(
        docs.select(
            F.col(id_col).alias("doc_id"), F.coalesce(size, F.lit(0)).alias("size"), F.col(row).alias("row") if row else F.monotonically_increasing_id().alias("row")
        ),
        "sizes",
    )
    rest = rows.select("doc_id", "row", (F.col("size") % top).alias("length"), F.expr(f"size div {top}").alias("piece")).where("length > 0")
    shards = max(1, -(-rest.count() // SHARD))
    dealt = rest.withColumn("shard", F.pmod(F.xxhash64("doc_id", "row"), F.lit(shards)))

    def place(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "doc_id", "piece", "row"], ascending=[False, True, True, True], na_position="first")
        got = pack(pdf["length"].tolist(), lengths)
        sizes = pdf["length"].to_numpy()
        at = np.concatenate([b for _, b in got]).astype(int)
        counts = [len(b) for _, b in got]
        held = sizes[at]
        ends = np.cumsum(held)
        first = np.repeat(np.concatenate([[0], ends])[np.cumsum([0, *counts[:-1]])], counts)
        shard = int(pdf["shard"].iloc[0])
        own = pdf.iloc[at]
        return pd.DataFrame(
            {
                "doc_id": own["doc_id"].astype("Int64"),
                "row": own["row"],
                "piece": own["piece"],
                "first": own["piece"] * top,
                "length": held,
                "bin_id": np.repeat([f"{shard}-{k}" for k in range(len(got))], counts),
                "capacity": np.repeat([c for c, _ in got], counts),
                "bin_offset": ends - held - first,
            }
        )

    schema = "doc_id long, row long, piece long, first long, length long, bin_id string, capacity long, bin_offset long"
    packed = dealt.groupBy("shard").applyInPandas(place, schema)
    whole = rows.where(F.col("size") >= top).select(
        F.col("doc_id").cast("long").alias("doc_id"), "row", F.explode(F.expr(f"sequence(0L, size div {top} - 1)")).alias("piece")
    )
    whole = whole.select(
        "doc_id",
        "row",
        "piece",
        (F.col("piece") * top).alias("first"),
        F.lit(top).cast("long").alias("length"),
        F.concat_ws("-", F.lit("whole"), "row", "piece").alias("bin_id"),
        F.lit(top).cast("long").alias("capacity"),
        F.lit(0).cast("long").alias("bin_offset"),
    )
    none = rows.where("size <= 0").selectExpr(
        "cast(doc_id as long) doc_id", "row", "0L piece", "0L first", "0L length", "cast(null as string) bin_id", "cast(null as long) capacity", "cast(null as long) bin_offset"
    )
    return packed.unionByName(whole).unionByName(none)


def packed_texts(docs: DataFrame, id_col="doc_id", text_col="text", lengths: tuple = LENGTHS) -> DataFrame:
    """``best_fit`` with ``text``: a piece's words and the white space after each. A whole document's text is as it was."""
    rows = written(docs.select(id_col, text_col).withColumn("__row", F.monotonically_increasing_id()), "rows")
    placed = best_fit(rows, id_col, text_col, lengths=lengths, row="__row")
    names = ["piece", "first", "length", "bin_id", "capacity", "bin_offset"]
    # a document's pieces meet its text once
    pieces = placed.groupBy("row").agg(F.collect_list(F.struct(*names)).alias("pieces"))
    words = F.regexp_extract_all(F.col("text"), F.lit(rf"{WORD}[\x20\x09-\x0D]*"), F.lit(0))
    met = rows.select("__row", F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).join(pieces, F.col("__row") == F.col("row"))
    cut = met.withColumn("words", F.when(F.size("pieces") > 1, words)).withColumn("p", F.explode("pieces"))
    own = F.when(F.col("words").isNull(), F.col("text")).otherwise(
        F.array_join(F.slice("words", (F.col("p.first") + 1).cast("int"), F.col("p.length").cast("int")), "")
    )
    return cut.select("p.bin_id", "p.capacity", "p.bin_offset", "doc_id", "row", *[f"p.{c}" for c in names[:3]], own.alias("text"))


def op10_packing(spark, sf_dir: str) -> DataFrame:
    return best_fit(spark.read.parquet(f"{sf_dir}/documents.parquet"))
