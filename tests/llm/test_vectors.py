"""Vector operators against brute force and SQL."""

import math
import os

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from framewright.llm import ego_join, topk_impact

SF = "/root/testdata/sf0.001"
KIND = "vec_id long, embedding array<float>, label int"


def planted(seed=0, n=300, d=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, d))
    rows = []
    for k in range(n):
        v = centres[rng.integers(30)] + rng.normal(0, rng.choice([0.05, 0.4]), d)
        rows.append((k, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    rows += [(n + k, rows[k][1], rows[k][2]) for k in range(20)] + [(n + 20 + k, rows[0][1], rows[0][2]) for k in range(40)]
    odd = [
        (5000, None, 1), (5001, [], 1), (5002, [0.0] * d, 1), (5003, [None] * d, 1), (5004, [float("nan")] * d, 1), (5005, [float("inf")] + [0.0] * (d - 1), 1),
        (5006, rows[0][1], None), (5007, rows[0][1][:5], rows[0][2]), (5008, [x * 1e-20 for x in rows[1][1]], rows[1][2]), (None, rows[0][1], rows[0][2]),
    ]
    return rows, odd


def brute_links(rows):
    good = [(i, np.array(v, float), y) for i, v, y in rows if i is not None and v and y is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: set() for i, *_ in good}
    for i, v, y in good:
        for j, w, z in good:
            if i != j and y == z and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= ego_join.COSINE:
                links[i].add(j)
    return links


def test_ego_join_equals_brute_force(spark, monkeypatch):
    for name, value in (("LEAF", 8), ("BYTES", 8 * 16 * 8), ("FAN", 2), ("PARTNERS", 2)):
        monkeypatch.setattr(ego_join, name, value)
    rows, odd = planted()
    df = spark.createDataFrame(rows + odd, KIND).withColumn("unit", F.lit(1)).withColumn("block", F.lit("clash"))
    got = {r["vec_id"]: r for r in ego_join.near_vectors(df).collect()}
    links = brute_links(rows + odd)
    assert sum(map(len, links.values())) > 500 and len(got) == len(rows + odd)

    def component(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links.get(todo.pop(), ()):
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        return min(seen)

    for i, *_ in rows + odd:
        if i is None:
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (0, None, True)
        else:
            want = (len(links.get(i, ())), component(i))
            assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (*want, want[1] == i)
    assert ego_join.near_vectors(df.limit(0)).count() == 0


def test_far_boxes_are_skipped():
    a, b = np.zeros((4, 2)), np.full((4, 2), 3.0)
    assert ego_join._boxes_apart(a, b, 1.0) and not ego_join._boxes_apart(a, b, 5.0)
    assert list(ego_join.join_runs(a, a, b, b, False, 1.0, 0.9)) == []


def test_ids_that_repeat_share_a_component(spark):
    near = lambda k, turn=0.0: [float(np.cos(k + turn)), float(np.sin(k + turn))]
    rows = [(3, near(0), 1), (5, near(0, 0.1), 1), (5, near(2), 1), (9, near(2, 0.1), 1), (9, near(2, 0.1), 1), (7, near(4), 1), (7, None, 1)]
    got = sorted(tuple(r) for r in ego_join.near_vectors(spark.createDataFrame(rows, KIND)).collect())
    assert got == [(3, 1, 3, True), (5, 1, 3, False), (5, 2, 3, False), (7, 0, 7, True), (7, 0, 7, True), (9, 2, 3, False), (9, 2, 3, False)]


def test_the_tree_prunes_clustered_vectors(spark):
    """Of clusters far apart only neighbouring blocks are joined."""
    n, eps = 400, 0.3
    boxes = spark.range(n).selectExpr("'a' label", "2 dim", "id block", *[f"{'id * 2.0' if k == 0 else '0.0'} lo{k}" for k in range(6)], *[f"{'id * 2.0 + 1' if k == 0 else '0.0'} hi{k}" for k in range(6)])
    got = {(r["a"], r["b"]) for r in ego_join.block_pairs(boxes, eps).collect()}
    assert got == {(k, k) for k in range(n)}
    got = {(r["a"], r["b"]) for r in ego_join.block_pairs(boxes, 1.0).collect()}
    assert got == {(k, m) for k in range(n) for m in (k, k + 1) if m < n}


def exact_top(every, k=5):
    good = [(r, i, [math.floor(256 * x) for x in np.array(v, np.float32).astype(float).tolist()]) for r, (i, v, _) in enumerate(every) if i is not None and v and None not in v and np.isfinite(np.array(v, np.float32)).all()]
    want = []
    for r, i, v in good:
        if i % 50 == 0:
            best = sorted((-max(-topk_impact.TOP, min(topk_impact.TOP, sum(map(int.__mul__, v, w)))), j) for s, j, w in good if s != r and len(v) == len(w))[:k]
            want += [(i, n, j, -s) for n, (s, j) in enumerate(best, 1)]
    return sorted(want)


@pytest.mark.parametrize("block", [7, 4096])
def test_top_k_equals_brute_force(spark, monkeypatch, block):
    """Components of any size, repeated ids and vectors, odd rows."""
    monkeypatch.setattr(topk_impact, "BLOCK", block)
    rows, odd = planted(3, 200, 12)
    wide = [(7000, [1e6] * 12, 1), (7001, [-1e6] * 11 + [3.4e37], 1), (7050, [300000.0] + [1.0] * 11, 1), (7100, [3e38] * 12, 1)]
    every = rows + odd + wide + [(0, rows[5][1], 0), (0, rows[0][1], 0), (50, rows[9][1], 2)]
    df = spark.createDataFrame(every, KIND).withColumn("score", F.lit(1)).withColumn("dim", F.lit("clash")).withColumn("row", F.lit(1))
    got = topk_impact.top_k(df, F.col("vec_id") % 50 == 0)
    assert sorted(tuple(r) for r in got.select("query_id", "rank", "vec_id", "score").collect()) == exact_top(every)
    assert topk_impact.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_numbers_beyond_doubles_are_whole():
    assert topk_impact.whole(np.array([1e308, -2.5, 0.0]), 2) == [int(1e308) * 256, -640, 0]
    got = topk_impact.exact_scores(np.array([[1e300, 1.0]]), np.array([1]), np.array([[-1e300, 2.0], [1e-3, 2.0]]), np.array([1, 0]))
    assert got.tolist() == [[-topk_impact.TOP, 2]]


def test_search_stops_early_and_stays_exact():
    rng = np.random.default_rng(9)
    centres = rng.integers(-120, 120, (300, 32)).astype(float)
    c = np.concatenate([centres + rng.integers(-9, 9, centres.shape) for _ in range(10)])
    q = centres[:20]
    block = topk_impact.Segments(np.arange(3000), c)
    assert sum(block.postings) == np.count_nonzero(c)
    i, j, work = topk_impact.search(block, np.full(20, -1), q, np.full(20, -np.inf))
    assert len(i) <= 20 * 4 * topk_impact.K and work < 0.8 * 20 * sum(block.postings)
    for k in range(20):
        assert set(np.argsort(-(q[k] @ c.T), kind="stable")[:5]) <= set(j[i == k])


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("query, sql", [(ego_join.op8_ego_join, ego_join.SQL), (topk_impact.op9_topk, topk_impact.SQL)])
def test_queries_equal_sql(spark, query, sql):
    c = duckdb.connect()
    c.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    key = lambda d: sorted(map(tuple, d[sorted(d.columns)].astype(str).values.tolist()))
    assert key(query(spark, SF).toPandas()) == key(c.execute(sql).df())
