"""Toxicity: subword-bag embeddings averaged into a linear softmax, trained jointly in numpy.

A word's vector is the mean of its hashed character n-gram vectors (and its own), a passage's vector the mean of
its words' vectors; a two-class softmax stands on that. Vectors and softmax are fitted together by AdaGrad on a
bounded, documented sample of labelled rows (``PER_CLASS``, by a hash of the id). Misspellings that
were never seen share n-gram vectors with words that were.

The fitted model is linear in the words, so a word needs one number, kept in a bounded table in each task. Every
word of every text counts, as often as it comes, and a text's bag is the same in training and scoring.

Nulls and edge cases: a null or empty text scores as a bag without words (the softmax of the bias). Words are runs
without white space, lower-cased, punctuation around them dropped; one without letters is a zero vector. A null
doc_id is held out or not as crc32 of the empty string says and never trains. Ids that labels repeat count as toxic
if any row says so. Without labelled rows of both classes every score is 0. Rows are scored one by one, so repeated
ones get equal scores; of rows that repeat a labelled id the one with the smallest digest of its text trains. An empty
table gives an empty table. Columns other than id and text are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import dropped, written
from .common import give_back, text_of, tidied

BUCKETS = 1 << 16
DIM = 8
GRAMS = (3, 4, 5, 6)
#: A bucket takes part if that many of the sample's texts have it.
SPREAD = 5
#: Weight decay of the embeddings that a step touches.
DECAY = 0.003
#: A bag's mean is small, as a few words in a hundred carry the class: it enters the network this many times its size.
GAIN = 150.0
#: Weights are kept as half floats, this many times their size.
SCALE = 1024
#: Zero vectors in every mean, so that a few odd words decide nothing.
PAD = 20
#: The training sample's bound: rows of class 0 and of class 1.
PER_CLASS = (4000, 2000)
EPOCHS, BATCH = 8, 32
THRESHOLD = 0.7
AROUND = " \t.,;:!?\"'()[]{}<>|%&$#*+=/\\~_^`-«»„“”‘’…"
#: Look-alike digits and signs inside a word, read as letters.
LOOKALIKE = str.maketrans("013457@$", "oieastas")
CACHE = 1 << 18


def tokens_of(text: str) -> list[str]:
    return text.lower().split()


def grams(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(token's position, bucket) of every character n-gram of every token that has a letter, edge marks included."""
    words = [t.strip(AROUND).translate(LOOKALIKE) for t in tokens]
    words = [f"<{w}>" if any(map(str.isalpha, w)) else "" for w in words]
    a = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = np.fromiter(map(len, words), np.int64, len(words))
    of = np.repeat(np.arange(len(words)), n)
    left = np.repeat(np.cumsum(n), n) - np.arange(len(a))  # characters to the word's end
    h, where, bucket = a.copy(), [], []
    for size in range(2, max(GRAMS) + 1):
        h = h[:-1] * np.uint64(0x9E3779B97F4A7C15) + a[size - 1 :]
        if size in GRAMS:
            ok = left[: len(h)] >= size
            x = h[ok]
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            where.append(of[: len(h)][ok])
            bucket.append((x >> np.uint64(40)) % np.uint64(BUCKETS))
    return np.concatenate(where), np.concatenate(bucket).astype(np.int64)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of a text and SCALE times their weights in the mean of its words' means; four bytes a bucket."""
    tokens = tokens_of(text)
    if not tokens:
        return np.zeros(0, np.uint16), np.zeros(0, np.float16)
    words, counts = np.unique(np.array(tokens, object), return_counts=True)
    where, bucket = grams(words.tolist())
    size = np.bincount(where, minlength=len(words))
    weights = np.bincount(bucket, (counts / np.maximum(size, 1))[where], BUCKETS)
    at = np.flatnonzero(weights)
    return at.astype(np.uint16), (weights[at] / (len(tokens) + PAD) * SCALE).astype(np.float16)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], toxic: np.ndarray, prior: float, seed: int = 7):
    """(u, bias): u holds each bucket's share in the log-odds of class 1. Embeddings and softmax are fitted jointly."""
    if not len(bags) or toxic.min() == toxic.max() or not sum(len(x[0]) for x in bags):
        return None
    spread = np.zeros(BUCKETS, np.int64)
    for at, _ in bags:
        spread[at] += 1  # a bag has a bucket once
    known = spread >= SPREAD
    rng = np.random.default_rng(seed)
    e = rng.normal(0, 0.1, (BUCKETS, DIM))
    w = rng.normal(0, 0.1, (DIM, 2))
    b = np.zeros(2)
    se, sw, sb = np.full(BUCKETS, 1e-6), np.full(w.shape, 1e-6), np.full(2, 1e-6)
    for epoch in range(EPOCHS):
        rate = 0.5 * (1 - epoch / EPOCHS)
        order = rng.permutation(len(bags))
        for part in np.array_split(order, max(1, len(order) // BATCH)):
            doc = np.repeat(np.arange(len(part)), [len(bags[k][0]) for k in part])
            idx = np.concatenate([bags[k][0] for k in part]).astype(np.int64)
            val = np.concatenate([bags[k][1] for k in part]).astype(float) * (GAIN / SCALE)
            ok = known[idx]
            if not ok.any():
                continue
            u, at = np.unique(idx[ok], return_inverse=True)  # only rows that the batch has are touched
            x = np.zeros((len(part), len(u)))
            x[doc[ok], at] = val[ok]
            h = x @ e[u]
            z = h @ w + b
            p = np.exp(z - z.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(part)), toxic[part]] -= 1
            g = p / len(part)
            ge, gw, gb = x.T @ (g @ w.T), h.T @ g, g.sum(0)
            se[u] += (ge**2).mean(1)
            sw += gw**2
            sb += gb**2
            e[u] -= rate * (ge / np.sqrt(se[u])[:, None] + DECAY * e[u])
            w -= rate * gw / np.sqrt(sw)
            b -= rate * gb / np.sqrt(sb)
    u = np.where(known, e @ (w[:, 1] - w[:, 0]) * GAIN, 0.0)
    share = toxic.mean()
    bias = float(b[1] - b[0]) + math.log(prior / (1 - prior)) - math.log(share / (1 - share))
    return u, bias


class WordScores(dict):
    """Word -> its term in the log-odds of a bag that holds it alone; emptied when full."""

    def __init__(self, u):
        self.u = u

    def learn(self, tokens) -> None:
        new = [t for t in tokens if t not in self]
        if len(self) + len(new) > CACHE:
            self.clear()
            new = list(tokens)
        if new:
            where, bucket = grams(new)
            size = np.bincount(where, minlength=len(new))
            got = np.bincount(where, self.u[bucket], len(new)) / np.maximum(size, 1)
            self.update(zip(new, got.tolist()))


def log_odds(texts, words: WordScores, bias: float) -> np.ndarray:
    """texts: a list or an Arrow array, of which a few at a time become Python's."""
    out = np.full(len(texts), bias)
    for a in range(0, len(texts), 64):
        lists = [tokens_of((x if isinstance(x, str) else x and x.as_py()) or "") for x in texts[a : a + 64]]
        words.learn(set().union(*lists))
        for k, tokens in enumerate(lists, a):
            if not tokens:
                continue
            out[k] += np.fromiter(map(words.__getitem__, tokens), float, len(tokens)).sum() / (len(tokens) + PAD)
    return out


def probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -700, 700)))


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 3 == 1


def train(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", label_col="toxic", per_class=PER_CLASS):
    """The model from at most ``per_class[y]`` labelled, not held out rows of class y: the smallest hashes of ids."""
    known = (
        labels.where(F.col(id_col).isNotNull() & F.col(label_col).isin(0, 1) & ~held_out(id_col))
        .groupBy(F.col(id_col).cast("long").alias("__id"))
        .agg(F.max(label_col).cast("int").alias("__y"))
    )
    counts = {r["__y"]: r["count"] for r in known.groupBy("__y").count().collect()}
    if len(counts) < 2:
        return None
    picked = [known.where(F.col("__y") == y).orderBy(F.xxhash64("__id"), "__id").limit(per_class[y]) for y in (0, 1)]
    ids = [tuple(r) for r in picked[0].unionByName(picked[1]).collect()]  # sum(per_class) rows at most
    few = docs.sparkSession.createDataFrame(ids, "__id long, __y int")

    def bags(batches):
        for batch in batches:
            got = [tuple(x.tobytes() for x in bag(t.as_py())) for t in batch.column(1)]
            digests = pa.array([hashlib.md5(a + w).digest() for a, w in got], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), digests, *(pa.array([x[c] for x in got], pa.binary()) for c in (0, 1))], names=["y", "digest", "at", "weight"]
            )

    own = docs.select(F.col(id_col).cast("long").alias("__id"), text_of(text_col).alias("__text"))
    rows = written(
        own.join(F.broadcast(few), "__id")
        .groupBy("__id", "__y")
        .agg(F.min(F.struct(F.md5("__text"), F.col("__text").alias("text"))).alias("least"))
        .select("__y", "least.text")
        .mapInArrow(tidied(bags), "y int, digest binary, at binary, weight binary"),
        "bags",
    )
    # sum(per_class) rows at most, four bytes for each of a row's buckets; a file's part at a time passes the JVM
    got = [(r["y"], bytes(r["digest"]), bytes(r["at"]), bytes(r["weight"])) for r in rows.toLocalIterator()]
    dropped(rows)
    got.sort(key=lambda x: x[:2])  # the order must not depend on the run
    y = np.array([x[0] for x in got], np.int64)
    sample = [(np.frombuffer(x[2], np.uint16), np.frombuffer(x[3], np.float16)) for x in got]
    model = fit(sample, y, counts[1] / (counts[0] + counts[1]))
    del got, sample
    give_back()
    return model


def score(docs: DataFrame, model, id_col="doc_id", text_col="text") -> DataFrame:
    """(doc_id, score) of every row."""

    def compute(batches):
        words = WordScores(model[0]) if model else None
        for batch in batches:
            out = np.zeros(batch.num_rows)
            if model:
                out = probability(log_odds(batch.column(1), words, model[1]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], names=["doc_id", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text")).mapInArrow(
        tidied(compute), "doc_id long, score double"
    )


def reject(docs: DataFrame, labels: DataFrame, id_col="doc_id", text_col="text", threshold=THRESHOLD) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; all columns stay."""
    model = train(docs, labels, id_col, text_col)
    if model is None:
        return docs
    u, bias = model

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = WordScores(u)
        for texts in batches:
            yield pa.array(probability(log_odds(texts, words, bias)))
        words.clear()
        give_back()

    return docs.where(scored(F.col(text_col)) < threshold)


def op7_toxicity(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(docs, train(docs, labels)).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
