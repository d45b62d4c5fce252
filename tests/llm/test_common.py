import random

import pytest
from pyspark.sql import functions as F

from eventide.llm import common as C


def brute(edges):
    up = {}

    def root(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x
    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {x: root(x) for x in up}


@pytest.mark.parametrize("edges", [
    [], [(5, 5)], [(1, 2)], [(i, i + 1) for i in range(40)], [(i + 1, i) for i in range(17)][::-1], [(0, i) for i in range(1, 30)],
    [(99, i) for i in range(30)] + [(3, 200), (200, 150)]])
def test_components_of_shapes(spark, edges):
    got = {r["id"]: r["component"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {k: v for k, v in brute(edges).items() if any(k in e and e[0] != e[1] for e in edges)}
    assert got == want


def test_components_of_random_graphs(spark):
    rng = random.Random(2)
    for n, m in ((30, 20), (60, 70)):
        edges = [(rng.randrange(n), rng.randrange(n)) for _ in range(m)]
        got = {r["id"]: r["component"] for r in C.components(spark.createDataFrame(edges, "a long, b long")).collect()}
        want = brute([e for e in edges if e[0] != e[1]])
        assert got == want


def test_word_bounds_and_hashes():
    import pyarrow as pa
    texts = ["a b", "", "  ", "xy", "z z end", "\tb\n"]
    data, off = C.utf8(pa.array(texts))
    starts, ends, before = C.word_bounds(data, off)
    words = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    assert words == ["a", "b", "xy", "z z", "end", "b"] and before.tolist() == [0, 2, 2, 2, 3, 5, 6]
    h = C.word_hashes(data, starts, ends)
    assert h[1] == h[5] and len(set(h.tolist())) == 5


def test_order_rank(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("é",)], "s string")
    got = {r["s"]: r["rank"] for r in C.order_rank(df, [F.col("s").asc_nulls_last()]).collect()}
    assert got == {"a": 0, "b": 1, "é": 2, None: 3}
