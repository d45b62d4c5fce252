import itertools
import random
import zlib

import numpy as np
import pytest

from eventide.llm import toxic_spans as T


def all_paths(emit, trans):
    """Marginals by adding up every state sequence."""
    n = len(emit)
    total, hot = 0.0, np.zeros(n)
    for path in itertools.product((0, 1), repeat=n):
        w = sum(emit[i] for i in range(n) if path[i]) + sum(trans[a][b] for a, b in zip(path, path[1:]))
        total += np.exp(w)
        for i in range(n):
            hot[i] += np.exp(w) * path[i]
    return hot / total


def test_marginals_equal_all_paths():
    rng = np.random.default_rng(2)
    sizes = [0, 1, 2, 7, 0, 9, 10]
    before = np.concatenate([[0], np.cumsum(sizes)])
    emit, trans = rng.normal(0, 2, before[-1]), rng.normal(0, 1, (2, 2))
    got = T.marginals(emit, before, trans)
    want = np.concatenate([all_paths(emit[a:b], trans) for a, b in zip(before[:-1], before[1:]) if b > a])
    assert np.allclose(got, want, atol=1e-9)


def test_blocks_do_not_show(monkeypatch):
    rng = np.random.default_rng(3)
    before = np.array([0, 5, 205, 205, 400])
    emit, trans = rng.normal(0, 2, 400), rng.normal(0, 1, (2, 2))
    one = T.marginals(emit, before, trans)
    monkeypatch.setattr(T, "BLOCK", 7)
    assert np.allclose(one, T.marginals(emit, before, trans), atol=1e-9)


def corpus(n, seed):
    rng = random.Random(seed)
    calm, rude = [f"calm{k}" for k in range(300)], ["brute", "zonkhead", "zonkface", "zonklet", "grobble"]
    docs, labels = [], []
    for i in range(n):
        words = [rng.choice(calm) for _ in range(rng.randint(3, 120))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(rng.randint(1, 4)):
                words[rng.randrange(len(words))] = rng.choice(rude).title() + rng.choice(["", ",", "!"])
        docs.append((i, rng.choice([" ", "\n"]).join(words), "x", 0.5))
        if i % 3 != 1:
            labels.append((i, int(toxic), 1))
    return docs, labels, {i: t for i, t, _ in labels}


def test_held_out_accuracy_spans_and_odd_texts(spark):
    docs, labels, truth = corpus(900, 1)
    odd = [(10_000, None, "x", 1.0), (10_001, "", "x", 1.0), (10_002, "é zonkling x zonkhead! ok", "x", 1.0), (10_003, "calm1 " * 50_000, "x", 1.0),
           (None, "calm1 calm2", "x", 1.0)]
    df = spark.createDataFrame(docs + odd, "doc_id long, text string, lang string, score double").repartition(4)
    labels_df = spark.createDataFrame(labels + [(None, 1, 1), (7, None, 1)], "doc_id long, toxic int, quality int")
    model = T.fit(df, labels_df)
    rows = {r["doc_id"]: r for r in T.score(df, model).collect()}
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    right = np.mean([rows[i]["predicted"] == truth[i] for i in held])
    assert right >= 0.97 and len(held) > 80 and all(0 <= r["score"] <= 1 for r in rows.values())
    text = odd[2][1]
    assert [text[s["start"]:s["end"]] for s in rows[10_002]["spans"]] [-1].startswith("zonkhead")
    assert rows[10_000]["score"] == rows[10_001]["score"] < 0.5 and rows[10_003]["predicted"] == 0
    kept = T.clean(df, model)
    assert kept.columns == df.columns
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == {i for i, r in rows.items() if not r["predicted"]}


def test_scores_do_not_depend_on_other_columns_or_partitions(spark):
    docs, labels, _ = corpus(200, 2)
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    model = T.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    one = sorted((r["doc_id"], r["score"]) for r in T.score(df.coalesce(1), model).collect())
    two = sorted((r["doc_id"], r["score"]) for r in T.score(df.withColumn("doc_id", df.doc_id + 0).repartition(7), model).collect())
    assert [i for i, _ in one] == [i for i, _ in two]
    assert [x for _, x in one] == pytest.approx([x for _, x in two])


def test_without_labels_and_on_an_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = T.fit(docs, none)
    assert T.score(docs, model).first()["score"] < 1e-6
    assert T.score(docs.limit(0), T.fit(docs.limit(0), none)).count() == 0


def test_whole_table(spark, sf):
    rows = T.op3_toxic_spans(spark, sf).collect()
    docs = {r["doc_id"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert {r["doc_id"] for r in rows} == docs and len(rows) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)


def test_a_long_text_keeps_no_other_out_of_the_sample(spark):
    """A toxic text of 12 MB comes first in hash order."""
    docs, labels, truth = corpus(400, 5)
    marked = {i for i, toxic, _ in labels if toxic and zlib.crc32(str(i).encode()) % 5}
    first = next(r["id"] for r in spark.range(400).orderBy(T.F.xxhash64(T.F.lit(4), "id")).collect() if r["id"] in marked)
    # ids before it in hash order have no label
    order = [r["id"] for r in spark.range(400).orderBy(T.F.xxhash64(T.F.lit(4), "id")).collect()]
    labels = [x for x in labels if x[0] not in order[:order.index(first)]]
    docs = [(i, "calm1 " * 2_000_000 if i == first else t, *rest) for i, t, *rest in docs]
    df = spark.createDataFrame(docs, "doc_id long, text string, lang string, score double")
    model = T.fit(df, spark.createDataFrame(labels, "doc_id long, toxic int, quality int"))
    rows = {r["doc_id"]: r["predicted"] for r in T.score(df, model).collect()}
    assert np.mean([rows[i] == truth[i] for i in truth if i != first]) >= 0.97
