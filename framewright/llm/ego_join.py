"""Embedding near-duplicates by an epsilon grid order join.

Cosine of at least ``COSINE`` between unit vectors is a distance of at most eps = sqrt(2 - 2 COSINE). Vectors are
projected on leading principal dimensions (from a bounded sample; any orthonormal basis gives the same links, as a
projection never lengthens a distance), and sorted by label and grid cell of side eps. That order is cut into sequence
intervals. The join goes down a tree of intervals, ``FAN`` to a node: a pair of nodes whose bounding boxes are farther
apart than eps is dropped with all below it, any other gives its children's pairs. The tree's leaves are blocks of at
most ``BYTES``; a task holds one block, streams up to ``PARTNERS`` others, and goes on recursively inside each pair, by
halves, down to ``LEAF`` vectors, which are compared exactly, in double precision.

Equal vectors of a label are one class before anything is compared, so a group of copies costs one row. A task returns
per class how many vectors it is linked with and, for reachability, at most one edge a vector and leaf; pairs
themselves are not written.

Nulls and edge cases: vectors that are null, empty, zero or hold null or non-finite components, and vectors with a
null label or a null vec_id, link with nothing; vectors of different lengths do not link. Such rows are returned with
0 links. Rows that repeat a vec_id are vectors of their own, and what one of them reaches the id reaches: the nodes
are ids, so all rows of an id have one component. A row with a null id is its own and kept. An empty table gives an
empty table; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.components import connected_components
from ..sources.tables import written
from .common import pieces

COSINE = 0.93
LEAF = 256
BYTES = 1 << 25
FAN, PARTNERS = 16, 8
LEADING = 6
SAMPLE = 4096


def block_rows(dim: int) -> int:
    """Vectors of a block."""
    return max(LEAF, BYTES // (8 * max(1, dim)))


def matrices(column: pa.Array):
    """Yields (row positions, matrix of doubles) for each length of list in the column; null items become NaN."""
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    starts = np.cumsum(lengths) - lengths
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        yield rows, flat[starts[rows][:, None] + np.arange(n)]


def _prepare(batches):
    """(id, label, vector) -> (id, label, dim, digest, unit); digest is null for vectors that take no part."""
    for batch in batches:
        n = batch.num_rows
        dims, digests, units = np.zeros(n, np.int32), [None] * n, [None] * n
        ids, labels = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for rows, m in matrices(batch.column(2)):
            top = np.abs(m).max(1)
            for r, x, t in zip(rows.tolist(), m, top):
                if labels[r] is None or ids[r] is None or not np.isfinite(t) or t == 0:
                    continue
                x = x / t + 0.0  # no overflow, no negative zero
                units[r] = (x / np.sqrt(x @ x)).astype("<f8").tobytes()
                digests[r] = hashlib.blake2b(units[r], key=hashlib.blake2b(labels[r].encode(), digest_size=16).digest(), digest_size=16).digest()
                dims[r] = len(x)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(dims), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
            names=["vec_id", "label", "dim", "digest", "unit"],
        )


def stacked(units: pa.Array) -> np.ndarray:
    """Binary column of equally long vectors -> matrix."""
    raw = units.to_pylist()
    return np.frombuffer(b"".join(raw), "<f8").reshape(len(raw), -1)


def _boxes_apart(a: np.ndarray, b: np.ndarray, eps: float) -> bool:
    """Whether the bounding boxes of two sets of projected vectors are farther apart than eps."""
    gap = np.maximum(0, np.maximum(a.min(0) - b.max(0), b.min(0) - a.max(0)))
    return float(gap @ gap) > eps * eps


def join_runs(a, pa_, b, pb, same: bool, eps: float, cosine: float):
    """Yields (rows of a, rows of b, links as a boolean matrix) of leaves that hold a link; same: a is b, i < j only."""
    stack = [(0, len(a), 0, len(b))]
    while stack:
        i, j, k, m = stack.pop()
        if same and m <= i:
            continue  # the mirrored half
        if _boxes_apart(pa_[i:j], pb[k:m], eps):
            continue
        if j - i > LEAF or m - k > LEAF:
            if j - i >= m - k:
                h = (i + j) // 2
                stack += [(i, h, k, m), (h, j, k, m)]
            else:
                h = (k + m) // 2
                stack += [(i, j, k, h), (i, j, h, m)]
            continue
        links = a[i:j] @ b[k:m].T >= cosine
        if same:
            links &= np.arange(i, j)[:, None] < np.arange(k, m)
        if links.any():
            yield slice(i, j), slice(k, m), links


def _labels(links: np.ndarray, na: np.ndarray, nb: np.ndarray):
    """Least node reachable inside a leaf, for rows and columns that have a link."""
    big = np.iinfo(np.int64).max
    la, lb = np.where(links.any(1), na, big), np.where(links.any(0), nb, big)
    while True:
        ma = np.minimum(la, np.where(links, lb, big).min(1))
        mb = np.minimum(lb, np.where(links, ma[:, None], big).min(0))
        if (ma == la).all() and (mb == lb).all():
            return la, lb
        la, lb = ma, mb


def _compare(bases: dict, eps: float, cosine: float):
    """Rows (a, g, side, b, cid, rep, copies, unit) sorted by the first four: side 0 is block a, side 1 its partners b."""

    def project(m):
        return m @ bases[m.shape[1]] if m.shape[1] in bases else m[:, :LEADING]

    def emitted(kind, x, y):
        n = len(x)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(n, kind, np.int32)), pa.array(np.asarray(x, np.int64)), pa.array(np.asarray(y, np.int64))], names=["kind", "x", "y"]
        )

    def run(batches):
        own = None
        for (a, _, side, b), part in pieces(batches, 4, 1 << 62):  # a block at a time
            unit = stacked(part.column("unit"))
            here = (unit, project(unit), *(part.column(c).to_numpy() for c in ("cid", "rep", "copies")))
            if side == 0:
                own = here
                continue
            ua, ja, cid_a, rep_a, copies_a = own
            ub, jb, cid_b, rep_b, copies_b = here
            na, nb = np.zeros(len(ua), np.int64), np.zeros(len(ub), np.int64)
            for i, k, links in join_runs(ua, ja, ub, jb, a == b, eps, cosine):
                na[i] += links @ copies_b[k]
                nb[k] += copies_a[i] @ links
                la, lb = _labels(links, rep_a[i], rep_b[k])
                ga, gb = links.any(1), links.any(0)
                yield emitted(1, np.r_[rep_a[i][ga], rep_b[k][gb]], np.r_[la[ga], lb[gb]])
            for cid, n in ((cid_a, na), (cid_b, nb)):
                if n.any():
                    yield emitted(0, cid[n > 0], n[n > 0])

    return run


def _number_blocks(batches):
    """Sorted rows (label, dim, ...) -> the same rows with a block number; a block has rows of one label and dim."""
    part = TaskContext.get().partitionId() << 32
    block, rows, last = -1, 0, None
    for batch in batches:
        labels, dims = batch.column("label").to_pylist(), batch.column("dim").to_pylist()
        numbers = np.zeros(batch.num_rows, np.int64)
        for k, key in enumerate(zip(labels, dims)):
            if key != last or rows >= block_rows(key[1]):
                block, rows, last = block + 1, 0, key
            numbers[k] = part + block
            rows += 1
        yield pa.RecordBatch.from_arrays([pa.array(numbers), *batch.columns], names=["block", *batch.schema.names])


_LOW, _HIGH = [f"lo{k}" for k in range(LEADING)], [f"hi{k}" for k in range(LEADING)]


def block_pairs(boxes: DataFrame, eps: float) -> DataFrame:
    """boxes(label, dim, block, lo.., hi..) -> (a, b) of blocks, a before or equal to b, not provably farther apart than eps.

    Boxes are the nodes' of a tree over each label's sequence; pairs are followed from the top down.
    """
    key = ["label", "dim"]
    place = F.row_number().over(Window.partitionBy(*key).orderBy("block")) - 1
    leaves = written(boxes.withColumn("node", place.cast("long")), "leaves")
    most = leaves.agg(F.max("node")).first()[0]
    levels, wide = [leaves.drop("block")], most
    while wide is not None and wide >= FAN:
        up = levels[-1].withColumn("node", F.expr(f"node div {FAN}")).groupBy(*key, "node")
        levels.append(written(up.agg(*[F.min(c).alias(c) for c in _LOW], *[F.max(c).alias(c) for c in _HIGH]), "level"))
        wide //= FAN
    gaps = [F.greatest(F.lit(0.0), F.col(f"s.lo{k}") - F.col(f"t.hi{k}"), F.col(f"t.lo{k}") - F.col(f"s.hi{k}")) for k in range(LEADING)]
    near = sum((g * g for g in gaps[1:]), gaps[0] * gaps[0]) <= eps * eps
    # above the top is one node for each label
    pairs = levels[-1].select(*key).distinct().withColumn("a", F.lit(0).cast("long")).withColumn("b", F.lit(0).cast("long"))
    for level in reversed(levels):
        up = F.expr(f"node div {FAN}") if level is not levels[-1] else F.lit(0).cast("long")
        s = level.withColumn("a", up).alias("s")
        t = level.withColumn("b", up).alias("t")
        down = pairs.join(s, [*key, "a"]).join(t, [*key, "b"]).where((F.col("s.node") <= F.col("t.node")) & near)
        pairs = written(down.select(*key, F.col("s.node").alias("a"), F.col("t.node").alias("b")), "pairs")
    named = lambda c: leaves.select(*key, F.col("node").alias(c), F.col("block").alias(f"block_{c}"))
    return pairs.join(named("a"), [*key, "a"]).join(named("b"), [*key, "b"]).select(
        F.col("block_a").alias("a"), F.col("block_b").alias("b"), F.expr(f"b div {PARTNERS}").alias("g")
    )


def near_vectors(vectors: DataFrame, id_col="vec_id", vector_col="embedding", label_col="label", cosine=COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept), a row a vector."""
    eps = float(np.sqrt(max(0.0, 2 - 2 * cosine))) * (1 + 1e-9) + 1e-9
    rows = written(
        vectors.select(
            F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("v")
        ).mapInArrow(_prepare, "vec_id long, label string, dim int, digest binary, unit binary"),
        "vectors",
    )
    live = rows.where("digest IS NOT NULL")
    classes = written(
        live.groupBy("digest")
        .agg(
            F.min("vec_id").alias("rep"),
            F.count(F.lit(1)).alias("copies"),
            F.first("label").alias("label"),
            F.first("dim").alias("dim"),
            F.first("unit").alias("unit"),
        )
        .withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    # at most SAMPLE rows
    sample = [bytes(r["unit"]) for r in classes.orderBy(F.xxhash64("digest"), "digest").limit(SAMPLE).select("unit").collect()]
    bases: dict[int, np.ndarray] = {}
    for d in {len(x) // 8 for x in sample}:
        m = np.stack([np.frombuffer(x, "<f8") for x in sample if len(x) == 8 * d])
        bases[d] = np.ascontiguousarray(np.linalg.eigh(m.T @ m)[1][:, ::-1][:, :LEADING])

    def project(batches):
        for batch in batches:
            out = np.zeros((batch.num_rows, LEADING))
            units, dims = batch.column("unit"), batch.column("dim").to_numpy()
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                m = stacked(units.take(pa.array(at)))
                p = m @ bases[d] if d in bases else m[:, :LEADING]
                out[at, : p.shape[1]] = p
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(out[:, k]) for k in range(LEADING)]], names=[*batch.schema.names, *[f"p{k}" for k in range(LEADING)]]
            )

    leading = ", ".join(f"p{k} double" for k in range(LEADING))
    slim = classes.select("label", "dim", "cid", "rep", "copies", "unit")
    kinds = "label string, dim int, cid long, rep long, copies long, unit binary, "
    order = ["label", "dim", *[F.floor(F.col(f"p{k}") / eps) for k in range(LEADING)], "cid"]
    n = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = written(
        slim.mapInArrow(project, kinds + leading)
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_number_blocks, "block long, " + kinds + leading),
        "blocks",
    )
    boxes = blocks.groupBy("label", "dim", "block").agg(
        *[f(f"p{k}").alias(f"{name}{k}") for k in range(LEADING) for name, f in (("lo", F.min), ("hi", F.max))]
    )
    pairs = written(block_pairs(boxes, eps), "block-pairs")
    what = ["cid", "rep", "copies", "unit"]
    held = pairs.select("a", "g").distinct().join(blocks, F.col("a") == F.col("block")).select("a", "g", F.lit(0).alias("side"), F.col("a").alias("b"), *what)
    partners = pairs.join(blocks, F.col("b") == F.col("block")).select("a", "g", F.lit(1).alias("side"), "b", *what)
    found = written(
        held.unionByName(partners)
        .repartition("a", "g")
        .sortWithinPartitions("a", "g", "side", "b", "cid")
        .mapInArrow(_compare(bases, eps, cosine), "kind int, x long, y long"),
        "links",
    )
    counts = found.where("kind = 0").groupBy(F.col("x").alias("cid")).agg(F.sum("y").alias("others"))
    known = written(
        classes.join(counts, "cid", "left").select("digest", "rep", (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")), "known"
    )
    counted = written(live.select("vec_id", "digest").join(known, "digest").select("vec_id", "rep", "n_links"), "counted")
    # an id's rows may lie in several classes: ids are the nodes, and a copy's id is tied to its class's
    edges = found.where("kind = 1").select("x", "y").unionByName(counted.where("vec_id != rep").select(F.col("vec_id").alias("x"), F.col("rep").alias("y")))
    parts = connected_components(edges, "x", "y")
    dead = rows.where("digest IS NULL AND vec_id IS NOT NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"))
    named = counted.select("vec_id", "n_links").unionByName(dead).join(parts, F.col("vec_id") == F.col("node"), "left")
    named = named.select("vec_id", F.col("n_links").cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id"))
    lone = rows.where("vec_id IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return named.unionByName(lone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def op8_ego_join(spark, sf_dir: str) -> DataFrame:
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


SQL = f"""
WITH RECURSIVE e AS (SELECT row_number() OVER () AS r, vec_id, label, embedding FROM embeddings),
v AS (
  SELECT r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM e
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
u AS (SELECT *, sqrt(list_inner_product(e, e)) AS norm FROM v),
links AS (
  SELECT a.r, a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON a.label = b.label AND a.r <> b.r
  WHERE len(a.e) = len(b.e) AND list_inner_product(a.e, b.e) / (a.norm * b.norm) >= {COSINE}),
reach AS (
  SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT e.vec_id, coalesce(n.n, 0) AS n_links, least(e.vec_id, coalesce(c.m, e.vec_id)) AS component_id,
       coalesce(e.vec_id <= coalesce(c.m, e.vec_id), true) AS kept
FROM e LEFT JOIN (SELECT r, count(*) AS n FROM links GROUP BY r) n ON n.r = e.r
LEFT JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) c ON c.x = e.vec_id
"""
