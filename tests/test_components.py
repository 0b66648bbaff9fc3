"""Connected components against union-find; shared folders."""

import numpy as np
import pytest

from framewright.operators import components
from framewright.sources import tables


def test_components_equal_union_find(spark):
    rng = np.random.default_rng(3)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 120, (90, 2))] + [(200 + k, 201 + k) for k in range(30)] + [(500, 500 + k) for k in range(40)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    linked = {x for a, b in edges if a != b for x in (a, b)}
    got = components.connected_components(spark.createDataFrame(edges + [(None, 3)], "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {x: find(x) for x in linked} and len(got) == len(linked)
    assert components.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_no_machine_local_folder_on_a_cluster():
    class Conf:
        def get(self, key):
            return None

    class Context:
        master = "spark://somewhere:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(Conf)

    class Session:
        sparkContext = Context

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        tables.shared_dir(Session)


def test_recorded_tables_are_named_and_dropped(spark):
    with tables.recorded() as held:
        df = tables.written(spark.range(3).toDF("x"), "t")
    assert [x is df for x in held] == [True] and df.count() == 3
    tables.dropped(df)
    with pytest.raises(Exception):
        spark.read.parquet(df._framewright_path).count()
