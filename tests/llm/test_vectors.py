import numpy as np
import pytest

from eventide.llm import grid_join as G
from eventide.llm import rotated_codes as R

SCHEMA = "vec_id long, embedding array<float>, label int, copies int"


def table(spark, vectors, labels, parts=5):
    rows = [(i, None if v is None else [None if x is None else float(x) for x in v], l, 9) for i, (v, l) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def good(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v) and any(x != 0 for x in v)


def cos(a, b):
    a, b = np.array(a, np.float32).astype(float), np.array(b, np.float32).astype(float)
    return float(a @ b / np.sqrt(a @ a) / np.sqrt(b @ b))


def clustered(n, dim, seed, spread):
    g = np.random.default_rng(seed)
    centres = g.standard_normal((max(2, n // 12), dim))
    x = centres[g.integers(0, len(centres), n)] + spread * g.standard_normal((n, dim))
    return [v.tolist() for v in x]


def odd_rows(dim):
    return [None, [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] + [1.0] * (dim - 1), [None] + [1.0] * (dim - 1), [], [1.0, 2.0]]


def brute_links(vectors, labels, at_least):
    n = len(vectors)
    up, links = list(range(n)), [0] * n

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i in range(n):
        for j in range(i):
            if labels[i] is not None and labels[i] == labels[j] and good(vectors[i]) and good(vectors[j]) and len(vectors[i]) == len(vectors[j]) \
                    and cos(vectors[i], vectors[j]) >= at_least:
                links[i] += 1
                links[j] += 1
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (links[i], root(i), root(i) == i) for i in range(n)}


@pytest.mark.parametrize("seed,block", [(1, 512), (2, 7), (3, 3)])
def test_grid_join_equals_all_pairs(spark, seed, block):
    g = np.random.default_rng(seed)
    vectors = clustered(130, 6, seed, 0.35)
    vectors += [vectors[int(k)] for k in g.integers(0, 130, 40)] + [[2 * x for x in vectors[0]]] + odd_rows(6)
    labels = [None if k == 4 else int(k) for k in g.integers(0, 5, len(vectors))]
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"])
           for r in G.near_vectors(table(spark, vectors, labels), block_rows=block).collect()}
    want = brute_links(vectors, labels, G.COSINE)
    assert got == want and sum(x[0] for x in want.values()) > 100


def test_grid_join_skips_distant_blocks(spark):
    """Two far clusters: the recursion keeps no pair of blocks across them."""
    rows = [(0, 3, k, [0.0 + (k // 4) * 5, 0.0], [0.3 + (k // 4) * 5, 0.2]) for k in range(8)]
    short = spark.createDataFrame(rows, "label int, dim int, block long, lo array<double>, hi array<double>")
    pairs = {(r["i"], r["j"]) for r in G._meeting_blocks(short, 0.4).collect()}
    assert pairs == {(i, j) for i in range(8) for j in range(i, 8) if i // 4 == j // 4}


def test_grid_join_small_tables(spark):
    assert G.near_vectors(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = G.near_vectors(table(spark, odd_rows(3), [1] * 7)).collect()
    assert len(rows) == 7 and all(r["n_links"] == 0 and r["kept"] for r in rows)


def test_nearest_recall_and_scores(spark):
    vectors = clustered(1500, 64, 5, 0.8) + odd_rows(64)
    vectors[200] = vectors[150]                    # a tie at the top
    got = {}
    for r in R.nearest(table(spark, vectors, [0] * len(vectors)), query_step=50, slab_rows=300).collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    x = np.array(vectors[:1500], np.float32).astype(float)
    x /= np.linalg.norm(x, axis=1)[:, None]
    hit = total = 0
    for q in range(0, 1500, 50):
        s = x @ x[q]
        s[q] = -2
        best = np.lexsort((np.arange(1500), -s))[:5]
        assert sorted(got[q]) == [1, 2, 3, 4, 5]
        hit += len(set(best.tolist()) & {v for v, _ in got[q].values()})
        total += 5
        scores = [got[q][k] for k in range(1, 6)]
        assert scores == sorted(scores, key=lambda t: (-t[1], t[0]))
        for v, score in scores:
            assert score == pytest.approx(cos(vectors[q], vectors[v]), abs=1e-12) and v != q
    assert hit / total >= 0.9 and set(got) == set(range(0, 1500, 50))


def test_error_bounds_hold():
    g = np.random.default_rng(3)
    x = g.standard_normal((2000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    centre, turn = x.mean(axis=0), R.rotation(64, 1)
    codes, length, own = R.encode(x, centre, turn)
    value, error = R.estimate(codes, length, own, x @ centre, x[:40], centre, turn, R.WIDTH)
    outside = np.abs(value - x[:40] @ x.T) > error
    assert codes.shape == (2000, 8) and outside.mean() < 0.02


def test_nearest_with_few_candidates(spark):
    assert R.nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    rows = R.nearest(table(spark, [[1.0, 0.0], [0.0, 1.0], [1.0, 1.0]] + odd_rows(2)[:5], [1] * 8)).collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in sorted(rows, key=lambda r: r["rank"])] == [(0, 1, 2), (0, 2, 1)]
    alone = R.nearest(table(spark, [[1.0, 0.0]], [1])).collect()
    assert alone == []


def under_broadcasts(df):
    """The executed plan's lines below each broadcast, joined."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0].splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            out.append("\n".join(lines[i + 1:end]))
    return out


def test_queries_of_all_slabs_are_not_broadcast(spark):
    """The queries take 4 KB, and 150 times that once each slab has them: Spark sizes them as before."""
    vectors = clustered(1500, 16, 7, 0.8)
    key = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(key)
    spark.conf.set(key, "64k")
    try:
        df = R.nearest(table(spark, vectors, [0] * len(vectors)), slab_rows=10)
        assert len(df.collect()) == 150
        assert not any("explode(" in plan for plan in under_broadcasts(df))
    finally:
        spark.conf.set(key, old)


def brute_nearest(rows, step, k=5):
    found = []
    for q, v in rows:
        if q is not None and q % step == 0 and good(v):
            near = sorted((-round(cos(v, w), 9), i) for i, w in rows if i is not None and i != q and good(w) and len(w) == len(v))
            found += [(q, i, -s) for s, i in near[:k]]
    return sorted(found)


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest_among_copies_in_small_blocks(spark, monkeypatch, kind):
    """Many copies of some vectors, ids that occur three times, two dimension counts, a null id; all
    queries meet all slabs in blocks of a few rows, and bounds so wide that every cosine is computed."""
    for name, value in (("QUERY_ROWS", 3), ("CODE_ROWS", 8), ("PAIR_CELLS", 32), ("SLABS", 3)):
        monkeypatch.setattr(R, name, value, raising=False)
    g = np.random.default_rng(9)
    base = [np.float32(v).tolist() for v in clustered(60, 6, 3, 0.5) + clustered(20, 9, 4, 0.5)]
    vectors = base + [base[0]] * 40 + [base[7]] * 25 + [base[65]] * 15 + odd_rows(6)
    ids = g.permutation(len(vectors)).tolist()
    rows = [*zip(ids, vectors)] + [(4, base[0])] * 2 + [(5, base[0])] * 2 + [(None, base[0])]
    rows = [(i, v) for i, v in rows if i is None or i % 4 or sum(i == x for x, _ in rows) == 1]
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(4)
    got = sorted((r["query_id"], r["vec_id"], round(r["score"], 9)) for r in R.nearest(df, query_step=4, width=50.0, slab_rows=5).collect())
    assert got == brute_nearest(rows, 4)
