import random
import re
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from eventide.llm import mixing as M

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes, weights=(3, 1, 2), share=Fraction(3, 2), most=2):
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, total, full = set(order), share * sum(sizes.values()), {}
    while True:
        weight = sum(w[s] for s in left)
        rest = total - sum(full.values())
        goals = {s: rest * w[s] / weight for s in left} if weight else {}
        over = [s for s in left if goals[s] > most * sizes[s]]
        if not over:
            return {**goals, **full}
        for s in over:
            left.discard(s)
            full[s] = Fraction(most * sizes[s])


def seats_by_quotients(parties, seats):
    """{name: (weight, cap)} -> Sainte-Laguë by handing out one seat at a time."""
    got = {p: 0 for p in parties}
    for _ in range(seats):
        open_ = [p for p in parties if got[p] < parties[p][1] and parties[p][0] > 0]
        if not open_:
            break
        best = min(open_, key=lambda p: (-Fraction(parties[p][0]) / (2 * got[p] + 1), p))
        got[best] += 1
    return got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_apportionment_equals_highest_quotients(spark, seed):
    rng = random.Random(seed)
    groups = {g: {f"p{i:02d}": (rng.choice([0, 1, 5, 5, 40, 300]), 10**6) for i in range(rng.randint(1, 12))} for g in "abc"}
    seats = {g: rng.choice([0, 1, 7, 200]) for g in groups}
    rows = [(g, p, w, c, seats[g]) for g, ps in groups.items() for p, (w, c) in ps.items()]
    df = spark.createDataFrame(rows, "g string, p string, w long, c long, n long")
    got = M.apportion(df, ["g"], F.col("w"), F.col("n"), F.col("c"), ["p"], "q").collect()
    for g, ps in groups.items():
        assert {r["p"]: r["q"] for r in got if r["g"] == g} == seats_by_quotients(ps, seats[g])


def corpus(seed):
    rng = random.Random(seed)
    docs = []
    for i in range(300):
        source = rng.choice(["a", "a", "a", "b", "ç", None, "Z"])
        text = rng.choice([None, "", " \n", "w " * rng.randint(1, 200), "é\u00a0ü x\ty" * rng.randint(1, 30)])
        docs.append((i, text, source, 5, "clash"))
    return docs


@pytest.mark.parametrize("shard_words", [100, 1 << 18])
def test_plan(spark, shard_words):
    docs = corpus(4)
    df = spark.createDataFrame(docs, "doc_id long, text string, source string, size long, target string").repartition(6)
    first, again = (sorted(map(str, M.plan(d, shard_words=shard_words).drop("_row").collect())) for d in (df, df.repartition(3)))
    assert first == again
    rows = {r["doc_id"]: r for r in M.plan(df, shard_words=shard_words).collect()}
    sizes, by = {}, {}
    for i, text, source, *_ in docs:
        n = len(WORDS.findall(text or ""))
        assert rows[i]["size"] == n and 0 <= rows[i]["taken"] <= 2 * n
        sizes[source] = sizes.get(source, 0) + n
        by[source] = by.get(source, 0) + rows[i]["taken"]
    goals = brute_targets(sizes)
    for i, _t, source, *_ in docs:
        assert rows[i]["source_size"] == sizes[source] and rows[i]["target"] == pytest.approx(float(goals[source]))
    shards = max(1, sum(sizes.values()) // shard_words)
    for s in sizes:
        assert abs(by[s] - goals[s]) <= 2 * M.BLOCK_WORDS * (1 + shards)


def test_the_mix_holds_what_the_plan_takes(spark):
    docs = corpus(5)
    df = spark.createDataFrame([(i, t, s, 1) for i, t, s, *_ in docs], "doc_id long, text string, source string, size long")
    taken = {r["doc_id"]: r["taken"] for r in M.plan(df, block_words=7, shard_words=500).collect()}
    out = M.mixed(df, block_words=7, shard_words=500)
    assert out.columns == df.columns
    words, texts = {}, dict((i, t) for i, t, *_ in docs)
    for r in out.collect():
        got = WORDS.findall(r["text"])
        words[r["doc_id"]] = words.get(r["doc_id"], 0) + len(got)
        whole = WORDS.findall(texts[r["doc_id"]])
        at = 0
        for w in got:                      # in order, from the document
            at = whole.index(w, at) + 1
    assert words == {i: n for i, n in taken.items() if n}


def test_empty_and_wordless_tables(spark):
    schema = "doc_id long, text string, source string"
    assert M.plan(spark.createDataFrame([], schema)).count() == 0
    rows = M.plan(spark.createDataFrame([(1, None, "a"), (2, " ", None), (2, " ", None)], schema)).collect()
    assert len(rows) == 3 and all(r["taken"] == 0 and r["target"] == 0 for r in rows)


def test_columns_named_like_those_of_the_plan_come_out_as_they_are(spark):
    names = ("_row", "_copy", "_copies", "_doc", "_size", "_from", "_times", "_r", "_p", "_n", "size")
    docs = corpus(6)
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in names)
    df = spark.createDataFrame([(i, t, s, *[f"{c} of {i}" for c in names]) for i, t, s, *_ in docs], schema)
    out = M.mixed(df, block_words=7, shard_words=500)
    plain = M.mixed(df.select("doc_id", "text", "source"), block_words=7, shard_words=500)
    rows = out.collect()
    assert out.columns == df.columns and rows and all(r[c] == f"{c} of {r['doc_id']}" for r in rows for c in names)
    key = lambda r: (r["doc_id"], r["text"])
    assert sorted(map(key, rows)) == sorted(map(key, plain.collect()))


def test_a_very_long_text_is_mixed_whole(spark):
    long = " ".join(f"v{k}" for k in range(150_000))
    df = spark.createDataFrame([(1, long, "a"), (2, "x y z", "b"), (3, "p q", "a")], "doc_id long, text string, source string")
    taken = {r["doc_id"]: r["taken"] for r in M.plan(df).collect()}
    got = {}
    for r in M.mixed(df).collect():
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + len(r["text"].split())
    assert got == {i: n for i, n in taken.items() if n} and taken[1] > 150_000
