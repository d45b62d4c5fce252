import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import weighted_minhash as W


def shingles(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute(docs, similarity=0.8):
    """Components of all pairs of exact weighted Jaccard similarity."""
    sets = {i: shingles(t) for i, t in docs}
    n, df = len(docs), Counter(k for s in sets.values() for k in s)
    idf = {k: 1 + np.log(n / v) / np.log(max(n, 2)) for k, v in df.items()}
    weight = {i: sum(v * idf[k] for k, v in s.items()) for i, s in sets.items()}
    up = {i: i for i, _ in docs}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = [i for i, _ in docs]
    for x in range(len(ids)):
        for y in range(x):
            a, b = sets[ids[x]], sets[ids[y]]
            if a and b:
                low = sum(min(v, b[k]) * idf[k] for k, v in a.items() if k in b)
                if low >= similarity * (weight[ids[x]] + weight[ids[y]] - low) - 1e-9:
                    p, q = root(ids[x]), root(ids[y])
                    up[max(p, q)] = min(p, q)
    return {i: root(i) for i in ids}


def corpus(seed, groups=12, size=12):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(400)]
    docs = []
    for _ in range(groups):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 60, 150, 300]))]
        for _ in range(rng.randint(1, size)):
            words = base[:]
            for _ in range(rng.choice([0, 0, 1, 2, 6, 30])):
                words[rng.randrange(len(words))] = rng.choice(vocab)
            docs.append(rng.choice([" ", "\n ", "\t"]).join(words).replace("w1", rng.choice(["w1", "W1"])))
    docs += [None, "", "  \n", "one", "ONE", "x " * 20000]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, seed):
    docs = corpus(seed)
    df = spark.createDataFrame([(i, t, 1, "z") for i, t in docs], "doc_id long, text string, class_id int, id string").repartition(5)
    got = {r["doc_id"]: (r["class_id"], r["kept"]) for r in W.near_duplicates(df).collect()}
    want = brute(docs)
    assert got == {i: (c, c == i) for i, c in want.items()} and len(set(want.values())) < len(docs)


def test_a_chain_of_near_copies_is_one_class(spark):
    """Neighbours are similar, the ends are not: no link may be lost."""
    words = [f"t{k}" for k in range(200)]
    docs = []
    for i in range(30):
        docs.append((i, " ".join(words)))
        words = words[6:] + [f"n{i}_{k}" for k in range(6)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    want = brute(docs)
    assert {r["doc_id"]: r["class_id"] for r in W.near_duplicates(df).collect()} == want and len(set(want.values())) == 1


def test_null_and_repeated_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, "a b c d e f"), (5, "a b c d e f"), (5, "q r s t u v"), (3, "q r s t u v"), (None, None)],
                               "doc_id long, text string")
    rows = sorted((str(r["doc_id"]), str(r["class_id"]), r["kept"]) for r in W.near_duplicates(df).collect())
    # the texts of id 5 are one document, so both of its classes are
    assert rows == [("3", "3", True), ("5", "3", False), ("5", "3", False), ("None", "None", True), ("None", "None", True)]
    assert W.near_duplicates(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_a_repeated_id_ties_classes_it_does_not_lead(spark):
    texts = [" ".join(f"{x}{k}" for k in range(12)) for x in "pqr"]
    df = spark.createDataFrame([(1, texts[0]), (2, texts[1]), (7, texts[0]), (7, texts[1]), (8, texts[2]), (8, texts[2])],
                               "doc_id long, text string")
    rows = sorted((r["doc_id"], r["class_id"], r["kept"]) for r in W.near_duplicates(df).collect())
    assert rows == [(1, 1, True), (2, 1, False), (7, 1, False), (7, 1, False), (8, 8, True), (8, 8, True)]


def test_samples_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    a = np.arange(60, dtype=np.uint64) * np.uint64(7919)
    wa, wb = rng.gamma(2, 1, 60).astype(np.float32), rng.gamma(2, 1, 60).astype(np.float32)
    wb[20:] = wa[20:]
    want = np.minimum(wa, wb).sum() / np.maximum(wa, wb).sum()
    order = np.argsort(W.mix64(a) & W._MASK)
    keys = (W.mix64(a) & W._MASK)[order]
    one = W.samples(keys, wa[order], np.array([0]), 3000, 1)
    two = W.samples(keys, wb[order], np.array([0]), 3000, 1)
    assert abs((one == two).mean() - want) < 0.04


def test_shingles_of_odd_texts():
    keys, counts = W.shingle_counts(pa.array(["", "a b", "A B", "a b c d e a b c d e a", "x"]))
    doc = (keys >> np.uint64(W.HASH_BITS)).astype(int)
    per = {d: sorted(counts[doc == d].tolist()) for d in range(5)}
    assert per == {0: [], 1: [1], 2: [1], 3: [1, 1, 1, 2, 2], 4: [1]}
    low = keys & W._MASK
    assert low[doc == 1].tolist() == low[doc == 2].tolist()
