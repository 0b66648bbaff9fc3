"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Components become integers floor(SCALE x). A block of candidates is indexed by impact: the postings (dimension, vector,
value) fall into segments by magnitude, halving from the largest; a segment has one posting list a dimension. Lists are
processed segment by segment in descending impact, each posting being added to the accumulators of all queries still at
work. What a candidate's unprocessed postings can add to a query is at most |query| times the norm of its unprocessed
part (Cauchy-Schwarz), so after each segment a candidate whose upper bound is under the k-th best score proven so far is
out. A query stops only on that proof: when few candidates are possible members, these are rescored exactly in integers;
otherwise it goes on, down to the last segment, after which scores are exact anyway.

Queries go in blocks of about ``QUERIES``, candidates in slots by a hash of their row; a task holds one block of
queries and streams a slot's candidates in sub-blocks, so thresholds rise as it goes. Each task returns k rows a
query, and a window over those gives the result.

Nulls and edge cases: vectors that are null, empty or hold null or non-finite components take no part, nor do rows with a
null id; vectors of other lengths are no candidates. Finite components of any size take part: where products leave
the range in which doubles are exact, scores come from integers instead (``exact_scores``), and a score beyond a
long's range is returned as that range's end. Queries are rows: each row of a repeated id is asked by itself, and only
that row is no candidate for it. Ties go to the smaller id. An empty table gives an empty table.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import written
from .common import pieces
from .ego_join import matrices

SCALE = 256
K = 5
EVERY = 50
QUERIES, BLOCK, TILE = 16384, 4096, 256
SLOT = 1 << 17
TOP = (1 << 63) - 1


def _integers(batches):
    """(id, vector) -> (id, dim, wide, integers as doubles) of the rows that take part.

    wide 0: sums of products of such rows are exact in doubles. 1: they may not be. 2: SCALE x itself is no finite
    double, and x is kept.
    """
    for batch in batches:
        ids = batch.column(0).to_pylist()
        keep, dims, wide, out = [], [], [], []
        for rows, m in matrices(batch.column(1)):
            finite = np.isfinite(m).all(1)
            with np.errstate(over="ignore", invalid="ignore"):
                q = np.floor(SCALE * m)
            top = np.abs(q).max(1)
            kind = np.where(top <= math.isqrt((1 << 53) // m.shape[1]), 0, np.where(np.isfinite(top), 1, 2))
            for r in np.flatnonzero(finite).tolist():
                if ids[rows[r]] is not None:
                    keep.append(ids[rows[r]])
                    dims.append(m.shape[1])
                    wide.append(int(kind[r]))
                    out.append((m[r] if kind[r] == 2 else q[r]).astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(keep, pa.int64()), pa.array(dims, pa.int32()), pa.array(wide, pa.int32()), pa.array(out, pa.binary())],
            names=["vec_id", "dim", "wide", "q"],
        )


def whole(values: np.ndarray, wide: int) -> list[int]:
    """A row's integers, of any size."""
    if wide < 2:
        return [int(x) for x in values]
    with np.errstate(over="ignore"):
        return [math.floor(SCALE * x) if math.isfinite(SCALE * x) else int(x) * SCALE for x in values.tolist()]


def exact_scores(a: np.ndarray, wide_a: np.ndarray, b: np.ndarray, wide_b: np.ndarray) -> np.ndarray:
    """(rows of a, rows of b) scores by integers, kept within a long's range."""
    if not wide_a.any() and not wide_b.any():
        return (a @ b.T).astype(np.int64)  # exact in doubles
    if max(wide_a.max(initial=0), wide_b.max(initial=0)) < 2 and float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1] < 2.0**62:
        return a.astype(np.int64) @ b.T.astype(np.int64)
    x, y = ([whole(v, w) for v, w in zip(m, wide)] for m, wide in ((a, wide_a), (b, wide_b)))
    return np.array([[max(-TOP, min(TOP, sum(map(int.__mul__, u, v)))) for v in y] for u in x], np.int64).reshape(len(a), len(b))


class Segments:
    """A block of candidates (not wide), its postings in segments of descending impact."""

    def __init__(self, rows: np.ndarray, values: np.ndarray):
        self.rows, self.values = rows, values
        size = np.abs(values)
        #: a segment: posting lists (dimension, vectors, values)
        self.segments: list[list[tuple[int, np.ndarray, np.ndarray]]] = []
        self.rest: list[np.ndarray] = []
        top, left = float(size.max(initial=0)), size > 0
        while left.any():
            top = top // 2
            now = left & (size > top)
            left &= ~now
            if now.any():
                dims, vectors = np.nonzero(now.T)
                cuts = np.flatnonzero(np.diff(dims)) + 1
                lists = zip(dims[np.r_[0, cuts]].tolist(), np.split(vectors, cuts))
                self.segments.append([(d, v, values[v, d]) for d, v in lists])
                self.rest.append(np.sqrt((np.where(left, values, 0) ** 2).sum(1)))
        self.postings = [sum(len(v) for _, v, _ in s) for s in self.segments]


def search(block: Segments, rows: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int = K):
    """(query position, candidate position) of every possible member of a query's k best, and the postings added up.

    floor: for each query a score that k candidates of other blocks are known to reach, or minus infinity. No query is wide.
    """
    n = len(block.rows)
    work, found_i, found_j = 0, [], []
    at = np.arange(len(queries))
    norm = np.sqrt((queries**2).sum(1))
    score = np.zeros((n, len(queries)))
    score[block.rows[:, None] == rows[None, :]] = -np.inf
    last = len(block.segments) - 1
    if last < 0:  # nothing but zeros
        i, j = np.nonzero((score >= floor[None, :]).T & (score.T == 0))
        return i, j, 0
    for s, (lists, rest) in enumerate(zip(block.segments, block.rest)):
        q = queries[at].T
        for d, vectors, values in lists:
            score[vectors] += values[:, None] * q[d]
        work += block.postings[s] * len(at)
        slack = rest[:, None] * (norm[at] * (1 + 1e-9))[None, :]
        bar = floor[at]
        if n > k:
            bar = np.maximum(bar, np.partition(score - slack, n - k, axis=0)[n - k])
        possible = (score + slack >= bar[None, :]) & (score > -np.inf)
        stop = np.ones(len(at), bool) if s == last else possible.sum(0) <= 4 * k
        if stop.any():
            j, i = np.nonzero(possible[:, stop])
            found_i.append(at[stop][i])
            found_j.append(j)
            if stop.all():
                break
            at, score = at[~stop], np.ascontiguousarray(score[:, ~stop])
    return np.concatenate(found_i), np.concatenate(found_j), work


def _best(i, ids, scores, k):
    """The k best rows of each query: by score, then smaller id."""
    order = np.lexsort((ids, -scores, i))
    i, ids, scores = i[order], ids[order], scores[order]
    first = np.r_[True, i[1:] != i[:-1]] if len(i) else np.zeros(0, bool)
    rank = np.arange(len(i)) - np.maximum.accumulate(np.where(first, np.arange(len(i)), 0)) if len(i) else np.zeros(0, int)
    return i[rank < k], ids[rank < k], scores[rank < k]


def _columns(part: pa.RecordBatch):
    raw = part.column("q").to_pylist()
    values = np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)
    return part.column("row").to_numpy(), part.column("vec_id").to_numpy(), part.column("wide").to_numpy(), values


def _block(best, queries, candidates, k: int):
    """The queries' k best so far, after a block of candidates. queries, candidates: (rows, ids, wide, values)."""
    qrows, _, qwide, q = queries
    rows, ids, wide, c = candidates
    floor = np.full(len(qrows), -np.inf)
    full = np.bincount(best[0], minlength=len(qrows)) >= k
    low = np.full(len(qrows), TOP)
    np.minimum.at(low, best[0], best[2])
    floor[full] = np.nextafter(low[full].astype(float), -np.inf)
    got = [best]
    plain, asked = np.flatnonzero(wide == 0), np.flatnonzero(qwide == 0)
    block = Segments(rows[plain], c[plain])
    for t in range(0, len(asked), TILE):
        tile = asked[t : t + TILE]
        i, j, _ = search(block, qrows[tile], q[tile], floor[tile], k)
        scores = np.einsum("nd,nd->n", q[tile[i]], block.values[j]).astype(np.int64)
        got.append((tile[i], ids[plain[j]], scores))
    # pairs with a wide side, by integers
    for some, others in ((np.flatnonzero(qwide), np.arange(len(rows))), (asked, np.flatnonzero(wide))):
        for t in range(0, len(some), TILE):
            tile = some[t : t + TILE]
            if len(others):
                scores = exact_scores(q[tile], qwide[tile], c[others], wide[others])
                i, j = np.nonzero(qrows[tile][:, None] != rows[others][None, :])
                got.append((tile[i], ids[others[j]], scores[i, j]))
    return _best(*(np.concatenate([g[x] for g in got]) for x in range(3)), k)


def _answer(k: int):
    """Rows (block, dim, slot, side, row, vec_id, wide, q) sorted by the first four: side 0 queries, side 1 candidates."""

    def out(queries, best):
        i, ids, scores = best
        return pa.RecordBatch.from_arrays(
            [pa.array(queries[0][i]), pa.array(queries[1][i]), pa.array(ids), pa.array(scores)], names=["row", "query_id", "vec_id", "score"]
        )

    def run(batches):
        now, held, queries, best = None, [], None, None
        for (b, d, s, side), part in pieces(batches, 4, BLOCK):
            if (b, d, s) != now:
                if best is not None and len(best[0]):
                    yield out(queries, best)
                now, held, queries, best = (b, d, s), [], None, None
            if side == 0:
                held.append(_columns(part))
            elif held:
                if queries is None:
                    queries = tuple(np.concatenate(x) for x in zip(*held))
                    best = (np.zeros(0, np.int64),) * 3
                best = _block(best, queries, _columns(part), k)
        if best is not None and len(best[0]):
            yield out(queries, best)

    return run


def top_k(vectors: DataFrame, is_query, id_col="vec_id", vector_col="embedding", k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): each query row's k best candidates by integer inner product."""
    rows = written(
        vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
        .mapInArrow(_integers, "vec_id long, dim int, wide int, q binary")
        .withColumn("row", F.monotonically_increasing_id()),
        "integers",
    )
    n, nq = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    blocks = max(1, -(-nq // QUERIES))
    slots = max(rows.sparkSession.sparkContext.defaultParallelism, -(-n // SLOT))
    every = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    queries = rows.where(is_query).withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int")).withColumn("slot", every(slots)).withColumn("side", F.lit(0))
    candidates = rows.withColumn("slot", F.pmod(F.xxhash64("row"), F.lit(slots)).cast("int")).withColumn("block", every(blocks)).withColumn("side", F.lit(1))
    names = ["block", "dim", "slot", "side", "row", "vec_id", "wide", "q"]
    found = (
        queries.select(*names)
        .unionByName(candidates.select(*names))
        .repartition("block", "dim", "slot")
        .sortWithinPartitions("block", "dim", "slot", "side", "vec_id")
        .mapInArrow(_answer(k), "row long, query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("row", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op9_topk(spark, sf_dir: str) -> DataFrame:
    return top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


SQL = f"""
WITH e AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
v AS (
  SELECT r, vec_id, list_transform(embedding, lambda x: floor({SCALE}::DOUBLE * CAST(x AS DOUBLE))) AS q FROM e
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.r, a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.r <> b.r AND len(a.q) = len(b.q) WHERE a.vec_id % {EVERY} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM r WHERE n <= {K}
"""
