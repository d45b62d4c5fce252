import hashlib
import random

import numpy as np
import pytest

from eventide.llm import suffix_dedup as S


def brute(docs, length):
    """docs in corpus order: (id, bytes or None) -> rows by plain dictionaries."""
    seen, out = set(), []
    for i, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p:p + length]
            if w in seen:
                gone[p:p + length] = True
            seen.add(w)
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def sample(seed, n=60):
    rng = random.Random(seed)
    alphabet = "ab" if seed % 2 else "abcdeé \n"
    shared = ["".join(rng.choice(alphabet) for _ in range(rng.randint(5, 60))) for _ in range(6)]
    docs = []
    for i in range(n):
        kind = rng.random()
        if kind < 0.1:
            text = None
        elif kind < 0.15:
            text = ""
        elif kind < 0.3 and docs:
            text = rng.choice(docs)[1]
        elif kind < 0.35:
            text = "a" * rng.randint(1, 80)
        else:
            text = "".join(rng.choice(shared) if rng.random() < 0.4 else "".join(
                rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(rng.randint(1, 8)))
        docs.append((i, text))
    return docs


@pytest.mark.parametrize("seed,crowd", [(1, 1000), (2, 1000), (3, 0), (4, 0)])
def test_equals_brute_force(spark, seed, crowd):
    docs = sample(seed)
    mixed = docs[:]
    random.Random(seed).shuffle(mixed)
    df = spark.createDataFrame([(i, t, 7) for i, t in mixed], "doc_id long, text string, slab int").repartition(5)
    got = S.without_repeats(df, length=16, gram=6, bucket_bytes=400, crowd=crowd)
    rows = sorted((r["id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept"]) for r in got.collect())
    assert rows == brute(docs, 16)


def test_repeated_and_null_ids(spark):
    text = "the same passage of the text " * 2
    df = spark.createDataFrame([(None, text), (3, text), (3, text), (1, "x"), (None, None)], "doc_id long, text string").coalesce(1)
    got = S.without_repeats(df, length=40, gram=10, with_text=True).collect()
    kept = sorted((str(r["id"]), r["kept"]) for r in got)
    assert kept == [("1", "x"), ("3", ""), ("3", first_copy(text)), ("None", ""), ("None", "")]


def first_copy(text):
    """What brute force leaves of the first copy."""
    b, seen, gone = text.encode(), set(), set()
    for p in range(len(b) - 39):
        w = b[p:p + 40]
        if w in seen:
            gone.update(range(p, p + 40))
        seen.add(w)
    return bytes(x for k, x in enumerate(b) if k not in gone).decode()


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.without_repeats(df).count() == 0


def test_two_stage_order_is_the_suffix_order():
    rng = np.random.default_rng(5)
    for size, letters in ((1, 2), (7, 1), (200, 2), (400, 5), (300, 256)):
        data = rng.integers(0, letters, size).astype(np.uint8) + (97 if letters < 100 else 0)
        data = data.astype(np.uint8)
        order = S.suffix_order(data, np.ones(size, bool), size + 8)
        raw = data.tobytes()
        assert order.tolist() == sorted(range(size), key=lambda i: raw[i:])


def test_adjacent_prefixes():
    data = np.frombuffer(b"abcdefghijkabcdefghixyz", np.uint8)
    assert S.adjacent_prefixes(data, np.array([0, 11]), 12).tolist() == [0, 9]


def test_whole_table_equals_brute_force(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    docs = [(r["doc_id"], r["text"]) for r in df.orderBy("doc_id").collect()]
    rows = sorted((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in S.op1_suffix_dedup(spark, sf).collect())
    assert rows == brute(docs, 100)


def test_stretches_of_a_text_over_16_mib():
    """A passage before and behind place 2^24 gives the same stretches; pieces change nothing."""
    data = np.random.default_rng(4).integers(0, 256, (1 << 24) + 5000, np.uint8)
    passage, near, far = data[100:700].copy(), 100, (1 << 24) + 2000
    data[far:far + 600] = passage
    first, stop, anchor, content = S.stretches(data, np.array([0, len(data)]))
    assert first[0] == 0 and stop[-1] == len(data)
    inside = lambda lo: {(a - lo, e - lo, h, c) for a, e, h, c in zip(*(x[(first > lo) & (stop < lo + 600)].tolist() for x in (first, stop, anchor, content)))}
    assert inside(near) == inside(far) and len(inside(near)) > 5


def test_anchors_do_not_depend_on_pieces(monkeypatch):
    data = np.random.default_rng(5).integers(97, 100, 20_000, np.uint8)
    whole = S.stretches(data, np.array([0, 9000, 20_000]))
    monkeypatch.setattr(S, "PIECE", 777, raising=False)
    assert all(np.array_equal(x, y) for x, y in zip(whole, S.stretches(data, np.array([0, 9000, 20_000]))))
