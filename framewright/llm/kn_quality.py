"""Quality by an interpolated modified Kneser-Ney model of character n-grams, trained on trusted text.

The alphabet is open: a 4-gram is four characters of any script, as a string, and what is counted grows with the corpus.
No table of the model is ever whole in one place.

1. Documents are dealt to blocks of about ``CHARS`` characters by a hash of id and text, compressed, with the
   trusted ids that may be theirs. A task goes through a block once and sends each different 4-gram once, with its count in
   trusted texts: that is what the block needs to know, and what it adds to the counts.
2. The counts of orders 4 to 1 are tables sharded by n-gram. Continuation counts, the three discounts of an order (from
   counts of counts), history weights and interpolation are joins and aggregations over shards, for every 4-gram that
   some document has. Under order 1 all code points are alike.
3. The probabilities go back to the blocks that asked, by a join on the n-gram. A task holds its block's, and goes
   through the block's texts once more.

Asking by block, not by document, is what keeps the joins small: a document's 4-grams, sent one by one, would be several
times its text. A text's perplexity is over all its characters. Thresholds are quantiles by language over trusted texts
that are kept out of training (a tenth, by a hash of the id), exact on perplexities rounded to a thousandth of their
logarithm; a language without any uses those of all languages.

Nulls and edge cases: a null or empty text has no perplexity (null) and isn't kept; a null language is a language of
its own; ids that the labels repeat count once, trusted only if all their rows say so; a null doc_id is never
trusted; repeated rows are scored each. Characters that are no text (U+0000, lone surrogates) count as U+FFFD. Without any
held-out trusted text every text with a character is kept. An empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import pieces, release, text_of

ORDER = 4
#: Stands before a text.
PAD = 2
#: Size of the alphabet under order 1.
POINTS = 0x110000
QUANTILE = 0.99
HELD = 10
#: Characters of a block, and of what a task works on at once.
CHARS, AT_ONCE = 1 << 25, 1 << 22
#: An id's rows go to as many blocks at most.
SALTS = 4
_TEXTS = pa.schema([("doc_id", pa.int64()), ("lang", pa.string()), ("text", pa.string())])


# ---- n-grams of many texts at once


def _relabelled(codes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(different codes, ascending; each code's place among them); codes are under ``size``."""
    if size > 1 << 26:
        return np.unique(codes, return_inverse=True)
    there = np.zeros(size, bool)
    there[codes] = True
    different = np.flatnonzero(there)
    place = np.zeros(size, np.int32)
    place[different] = np.arange(len(different))
    return different, place[codes]


def grams_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(different 4-grams as strings, the 4-gram that ends at each character of each text, lengths of the texts)."""
    points = [np.frombuffer(x.encode("utf-32-le", "surrogatepass"), np.uint32) for x in texts]
    lengths = np.array([len(p) for p in points], np.int64)
    pad = np.full(ORDER - 1, PAD, np.uint32)
    line = np.concatenate([y for p in points for y in (pad, p)]).astype(np.int64)
    line[(line == 0) | ((line >= 0xD800) & (line < 0xE000))] = 0xFFFD
    letters, line = _relabelled(line, POINTS)
    pairs, line = _relabelled(line[:-1].astype(np.int64) * len(letters) + line[1:], len(letters) ** 2)
    first = np.cumsum(lengths + len(pad)) - lengths - len(pad)  # a text's first 4-gram begins at its pads
    at = np.repeat(first - (np.cumsum(lengths) - lengths), lengths) + np.arange(int(lengths.sum()))
    quads, which = _relabelled(line[at].astype(np.int64) * len(pairs) + line[at + 2], len(pairs) ** 2)
    two = np.stack([pairs // len(letters), pairs % len(letters)], 1)
    four = letters[np.concatenate([two[quads // len(pairs)], two[quads % len(pairs)]], 1)].astype(np.uint32)
    return np.ascontiguousarray(four).view("<U4").ravel(), which, lengths


def _some(rows: list, size) -> list[list]:
    """Rows in order, cut where their sizes add up to ``AT_ONCE``."""
    out, total = [], AT_ONCE
    for r in rows:
        if total >= AT_ONCE:
            out.append([])
            total = 0
        out[-1].append(r)
        total += size(r)
    return out


# ---- blocks


def _packed(batches):
    """(block, doc_id, lang, text) -> (block, blob): the rows of a block in a batch, compressed."""
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    for batch in batches:
        blocks = batch.column(0).to_numpy()
        order = np.argsort(blocks, kind="stable")
        cuts = np.flatnonzero(np.diff(blocks[order])) + 1
        for at in np.split(order, cuts) if len(order) else ():
            for some in _some(at.tolist(), lambda r: len(batch.column(3)[r].as_buffer()) if batch.num_rows < 64 else AT_ONCE // 256):
                part = pa.RecordBatch.from_arrays(batch.take(pa.array(some)).columns[1:], schema=_TEXTS)
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, _TEXTS, options=options) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([int(blocks[some[0]])], pa.int32()), pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["block", "blob"])


def _rows(blobs: pa.Array) -> list[tuple]:
    """(doc_id, lang, text) of blobs."""
    out = []
    for x in blobs:
        for batch in pa.ipc.open_stream(x.as_buffer()):
            out += zip(*(c.to_pylist() for c in batch.columns))
    return out


def _block_of(id_, salt, n: int):
    return F.pmod(F.xxhash64(id_, salt), F.lit(n)).cast("int")


def blocked(docs: DataFrame, n: int, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(block, blob) of all documents."""
    digest = F.xxhash64(text_of(text_col))
    id_ = F.col(id_col).cast("long")
    block = _block_of(F.coalesce(id_, digest), F.pmod(digest, F.lit(SALTS)), n)
    return docs.select(block.alias("block"), id_.alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), text_of(text_col).alias("text")).mapInArrow(
        _packed, "block int, blob binary"
    )


def _counted(batches):
    """Rows (block, side, id, blob) sorted by the first two: ids to train on, then texts -> (block, gram, c)."""

    def added(held):
        grams, which = np.unique(np.concatenate([g for g, _ in held]), return_inverse=True)
        return grams, np.bincount(which, np.concatenate([c for _, c in held])).astype(np.int64)

    def out(block, held):
        grams, c = added(held)
        for a in range(0, len(grams), 1 << 16):
            g = pa.array(grams[a : a + (1 << 16)].tolist(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([block] * len(g), pa.int32()), g, pa.array(c[a : a + (1 << 16)])], names=["block", "gram", "c"])

    now, ids, held = None, [], []
    for (block, side), part in pieces(batches, 2, 8):
        if block != now:
            if held:
                yield from out(now, held)
            now, ids, held = block, [], []
        if side == 0:
            ids.append(part.column("id").to_numpy())
            continue
        known = np.unique(np.concatenate(ids)) if ids else np.zeros(0, np.int64)
        ids = [known]
        for some in _some(_rows(part.column("blob")), lambda r: len(r[2])):
            grams, which, lengths = grams_of([t for _, _, t in some])
            own = np.array([i is not None for i, _, _ in some])
            own &= np.isin(np.array([i or 0 for i, _, _ in some], np.int64), known)
            held.append((grams, np.bincount(which[np.repeat(own, lengths)], minlength=len(grams))))
            if sum(len(g) for g, _ in held) > 1 << 20:
                held = [added(held)]
    if held:
        yield from out(now, held)


def _scored(batches):
    """Rows (block, side, gram, logp, blob) sorted by the first two: the block's 4-grams, then texts -> (doc_id, lang, perplexity)."""
    now, tables, known, logp = None, [], None, None
    for (block, side), part in pieces(batches, 2, 1 << 14):
        if block != now:
            now, tables, known = block, [], None
        if side == 0:
            tables.append((np.array(part.column("gram").to_pylist(), "<U4"), part.column("logp").to_numpy()))
            continue
        if known is None:
            known, logp = (np.concatenate(x) for x in zip(*tables)) if tables else (np.zeros(0, "<U4"), np.zeros(0))
            order = np.argsort(known)
            known, logp, tables = known[order], logp[order], []
        for blob in range(part.num_rows):
            for some in _some(_rows(part.column("blob").slice(blob, 1)), lambda r: len(r[2])):
                grams, which, lengths = grams_of([t for _, _, t in some])
                at = np.searchsorted(known, grams)
                if len(grams) and (at.max() >= len(known) or (known[at] != grams).any()):
                    raise RuntimeError("a block's texts are not the ones it was asked for")
                ends = np.r_[0, np.cumsum(logp[at][which])][np.r_[0, np.cumsum(lengths)]]
                with np.errstate(invalid="ignore", divide="ignore"):
                    each = np.exp(-np.diff(ends) / lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i for i, _, _ in some], pa.int64()),
                        pa.array([x for _, x, _ in some], pa.string()),
                        pa.array(each, pa.float64(), mask=lengths == 0),
                    ],
                    names=["doc_id", "lang", "perplexity"],
                )


# ---- the model


def _discounts(n: list[float]) -> tuple[float, float, float]:
    """Modified discounts D1, D2, D3 of an order, from its counts of counts n[1] to n[4]."""
    if not all(n[1:4]):
        return 0.5, 0.75, 0.9
    y = n[1] / (n[1] + 2 * n[2])
    raw = 1 - 2 * y * n[2] / n[1], 2 - 3 * y * n[3] / n[2], 3 - 4 * y * n[4] / n[3]
    return tuple(min(max(d, 0.05), k - 0.05) for k, d in enumerate(raw, 1))


def probabilities(asked: DataFrame, counts: DataFrame) -> DataFrame:
    """asked(gram), counts(gram, c) -> (gram, p): the probability of the last character after the others, for every gram asked for."""
    wanted, seen = [written(asked.select("gram").distinct(), "asked")], [written(counts, "counts")]
    for k in range(ORDER - 1, 0, -1):  # lower orders count the different characters before them
        shorter = F.substring("gram", 2, k).alias("gram")
        wanted.append(written(wanted[-1].select(shorter).distinct(), "asked"))
        seen.append(written(seen[-1].groupBy(shorter).agg(F.count(F.lit(1)).alias("c")), "counts"))
    below = None
    for k, (ask, c) in enumerate(zip(reversed(wanted), reversed(seen)), 1):
        sums = c.agg(F.sum("c"), *[F.count_if(F.col("c") == x) for x in (1, 2, 3, 4)]).first()
        d = _discounts([0.0, *map(float, sums[1:])])
        off = F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])
        history = F.substring("gram", 1, k - 1) if k > 1 else F.lit("")
        rated = c.select("gram", "c", history.alias("h"), off.alias("off"))
        if k == 1:  # one history: its sums are two numbers
            total = float(sums[0] or 0)
            left = float(rated.agg(F.sum("off")).first()[0] or 0) / total if total else 1.0
            own = rated.select("gram", ((F.col("c") - F.col("off")) / total).alias("own")) if total else rated.select("gram", F.lit(0.0).alias("own"))
            below = ask.join(own, "gram", "left").select("gram", (F.coalesce("own", F.lit(0.0)) + left / POINTS).alias("p"))
        else:
            sides = rated.groupBy("h").agg(F.sum("c").alias("total"), (F.sum("off") / F.sum("c")).alias("left"))
            own = rated.select("gram", (F.col("c") - F.col("off")).alias("own"))
            met = (
                ask.select("gram", history.alias("h"), F.substring("gram", 2, k - 1).alias("s"))
                .join(own, "gram", "left")
                .join(sides, "h", "left")
                .join(below.select(F.col("gram").alias("s"), "p"), "s")
            )
            p = F.coalesce(F.col("own") / F.col("total"), F.lit(0.0)) + F.coalesce("left", F.lit(1.0)) * F.col("p")
            below = met.select("gram", p.alias("p"))
        below = written(below, "probabilities")
    return below


def perplexities(docs: DataFrame, training: DataFrame, id_col="doc_id", text_col="text", lang_col="lang") -> DataFrame:
    """training(__id): ids of the texts to train on, each once -> (doc_id, lang, perplexity), a row a document."""
    n = max(1, -(-(docs.agg(F.sum(F.length(text_col))).first()[0] or 0) // CHARS))
    texts = blocked(docs, n, id_col, text_col, lang_col)
    ids = training.select("__id", F.explode(F.array(*[F.lit(s).cast("long") for s in range(SALTS)])).alias("salt"))
    ids = ids.select(_block_of("__id", F.col("salt"), n).alias("block"), F.lit(0).alias("side"), F.col("__id").alias("id"), F.lit(None).cast("binary").alias("blob"))
    both = ids.unionByName(texts.select("block", F.lit(1).alias("side"), F.lit(None).cast("long").alias("id"), "blob"))
    found = written(
        both.repartition("block").sortWithinPartitions("block", "side").mapInArrow(_counted, "block int, gram string, c long"), "block-grams"
    )
    release(docs.sparkSession)
    counts = found.where("c > 0").groupBy("gram").agg(F.sum("c").alias("c"))
    p = probabilities(found, counts)
    answers = found.select("block", "gram").join(p, "gram").select("block", F.lit(0).alias("side"), "gram", F.log("p").alias("logp"), F.lit(None).cast("binary").alias("blob"))
    asked = texts.select("block", F.lit(1).alias("side"), F.lit(None).cast("string").alias("gram"), F.lit(None).cast("double").alias("logp"), "blob")
    scored = answers.unionByName(asked).repartition("block").sortWithinPartitions("block", "side")
    return scored.mapInArrow(_scored, "doc_id long, lang string, perplexity double")


def thresholds(scored: DataFrame, quantile=QUANTILE) -> DataFrame:
    """scored(lang, perplexity) -> (lang, limit), and a row with is_all for all languages together."""
    step = F.round(F.log("perplexity"), 3).alias("x")
    bins = scored.where("perplexity IS NOT NULL").groupBy("lang", step).count()
    bins = bins.withColumn("is_all", F.lit(False)).unionByName(
        bins.groupBy("x").agg(F.sum("count").alias("count")).select(F.lit(None).cast("string").alias("lang"), "x", "count", F.lit(True).alias("is_all"))
    )
    by = Window.partitionBy("is_all", "lang")
    ranked = bins.withColumn("upto", F.sum("count").over(by.orderBy("x"))).withColumn("n", F.sum("count").over(by))
    return ranked.where(F.col("upto") >= quantile * F.col("n")).groupBy("is_all", "lang").agg(F.exp(F.min("x") + 0.0005).alias("limit"))


def quality(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", lang_col="lang", label_col="quality", quantile=QUANTILE) -> DataFrame:
    """(doc_id, lang, perplexity, threshold, kept), a row a document."""
    trusted = written(
        labels.where(F.col(id_col).isNotNull())
        .groupBy(F.col(id_col).cast("long").alias("__id"))
        .agg(F.min(F.coalesce(F.col(label_col), F.lit(0))).alias("__y"))
        .where("__y = 1")
        .select("__id", (F.crc32(F.col("__id").cast("string")) % HELD == 0).alias("held")),
        "trusted",
    )
    scored = written(perplexities(docs, trusted.where("NOT held"), id_col, text_col, lang_col), "perplexities")
    limits = thresholds(scored.join(trusted.where("held"), scored.doc_id == trusted["__id"], "left_semi"), quantile)
    by_lang = limits.where("NOT is_all").select(F.col("lang").alias("l"), "limit")
    pooled = [r["limit"] for r in limits.where("is_all").collect()]  # one row at most
    found = scored.join(by_lang, scored.lang.eqNullSafe(by_lang.l), "left")
    limit = F.coalesce("limit", F.lit(pooled[0] if pooled else float("inf")))
    return found.select("doc_id", "lang", "perplexity", limit.alias("threshold"), F.coalesce(F.col("perplexity") <= limit, F.lit(False)).alias("kept"))


def op6_quality(spark, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
