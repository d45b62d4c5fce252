import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from eventide.llm import attention_lm as A
from eventide.llm.packing import encoder, vocabulary


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low) + [None]


def base_scores(docs):
    """By plain counting; documents of the held-out fold don't count."""
    out, c = {}, Counter()
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in docs}
    for i, t in docs:
        if not held[i]:
            c.update(words(t))
    n, v = sum(c.values()), len(c)
    for i, t in docs:
        w = words(t)
        out[i] = held[i], len(w), sum(c[x] > 0 for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)
    return out


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    d, c, w = A.WIDTH, A.CLASSES, A.WINDOW
    par = {k: rng.normal(0, 0.4, s) for k, s in dict(E=(9, d), P=(w, d), Q=(d, d), K=(d, d), V=(d, d), O=(d, d), C=(d, c), b=(c,)).items()}
    par["mask"] = np.triu(np.full((w, w), -1e9), 1)
    z, target, scored = rng.integers(0, 9, (3, w)), rng.integers(0, c, (3, w)), rng.random((3, w)) < 0.7
    _, grad = A.gradients(par, z, target, scored)
    for name in "EPQKVOCb":
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in par[name].shape)
            kept, eps = par[name][at], 1e-5
            par[name][at] = kept + eps
            up = A.gradients(par, z, target, scored)[0]
            par[name][at] = kept - eps
            down = A.gradients(par, z, target, scored)[0]
            par[name][at] = kept
            assert grad[name][at] == pytest.approx((up - down) / 2 / eps, rel=1e-4, abs=1e-8)


def test_later_ids_do_not_change_earlier_scores():
    rng = np.random.default_rng(1)
    d, c, w = A.WIDTH, A.CLASSES, A.WINDOW
    par = {k: rng.normal(0, 0.4, s).astype(np.float32) for k, s in dict(E=(50, d), P=(w, d), Q=(d, d), K=(d, d), V=(d, d), O=(d, d), C=(d, c), b=(c,)).items()}
    par["mask"] = np.triu(np.full((w, w), -1e9, np.float32), 1)
    z = rng.integers(0, 50, (2, w))
    changed = z.copy()
    changed[:, 10:] = 3
    one, two = A.forward(par, z)[0], A.forward(par, changed)[0]
    assert np.allclose(one[:, :10], two[:, :10], atol=1e-6) and not np.allclose(one[:, 10:], two[:, 10:])
    live = np.ones(z.shape, bool)
    value, begin = A.place_scores(par, z, live, np.zeros(live.sum(), int))
    assert np.allclose(value, one[:, :, 0].ravel(), atol=1e-4)
    assert np.allclose(begin, np.log(np.exp(one[:, :, :A.BEGIN]).sum(axis=2)).ravel(), atol=1e-4)


def test_every_id_is_scored_once():
    for lengths in ([1], [2, 24, 25, 44, 45, 300], [7] * 5):
        n = np.array(lengths)
        z, end, skip = A.windows(n)
        seen = Counter()
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        for a, e, s in zip(z, end, skip):
            seen.update(range(a + s + 1, min(a + A.WINDOW, e - 1) + 1))
        want = Counter({int(f) + k: 1 for f, m in zip(first, n) for k in range(1, m)})
        assert seen == want


def test_spelling_lays_out_words():
    enc = encoder(vocabulary())
    texts = ["Hello the WORLD", "", "é x 中文-ok!", " \n"]
    ids, n, (h, before, is_end), size = A.spelled(pa.array(texts), enc)
    at = 0
    for k, t in enumerate(texts):
        part = ids[at:at + n[k]].tolist()
        at += n[k]
        assert part[0] == part[-1] == A.END
        assert enc.decode(part[1:-1]).split(" ")[1:] == words(t)[:-1]
        assert is_end[before[k]:before[k + 1]].tolist() == [False] * (len(words(t)) - 1) + [True]
    assert size.sum() + len(texts) == len(ids) and (h[is_end] == 0).all()


@pytest.fixture(scope="module")
def scored(spark):
    rng = random.Random(5)
    tongues = [[f"{a}{b}" for a in s for b in s] for s in (["ka", "lo", "mi", "tu"], ["stra", "ent", "gel", "usch"])]
    docs = [(i, " ".join(rng.choice(tongues[i % 2])[:99] + rng.choice(["", "", ".", "X"]) for _ in range(rng.randint(1, 80)))) for i in range(400)]
    docs += [(1000, None), (1001, ""), (1002, "new1 new2 new3"), (1003, "kalo " * 20000), (1004, "KALO\tkalo\nKaLo")]
    df = spark.createDataFrame([(i, t, 1, 2.0) for i, t in docs], "doc_id long, text string, n_tokens int, score double").repartition(6)
    training = df.filter(~A.held_out(df.doc_id)).select(df.doc_id.alias("id"), A.text_column(df).alias("text"))
    fitted = A.fit(training)
    rows = {r["doc_id"]: r for r in A.score(df, fitted).collect()}
    return docs, df, fitted, rows


def test_base_scores_by_counting(scored):
    docs, _df, _f, rows = scored
    want = base_scores(docs)
    assert set(rows) == set(want)
    for i, (_held, n, known, train, base) in want.items():
        r = rows[i]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, train)
        assert r["base_score"] == pytest.approx(base, rel=1e-9)


def test_model_beats_the_base_on_held_out_texts(scored):
    docs, _df, _f, rows = scored
    held = [i for i, _ in docs if i < 1000 and zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(rows[i]["score"] for i in held) > sum(rows[i]["base_score"] for i in held)
    assert rows[1000]["score"] == rows[1001]["score"] < 0 and all(math.isfinite(r["score"]) for r in rows.values())


def test_rare_words_score_as_frequent_ones(spark, scored, monkeypatch):
    """The join path for rare words gives what the hot table gives."""
    docs, df, fitted, rows = scored
    model, rare, h, c, tokens, distinct, texts = fitted
    few = c > np.sort(c)[-10]
    moved = spark.createDataFrame([(int(x), int(y)) for x, y in zip(h[~few], c[~few])], "h long, c long").unionByName(rare)
    got = {r["doc_id"]: r for r in A.score(df, (model, moved, h[few], c[few], tokens, distinct, texts)).collect()}
    for i in rows:
        for col in ("n_known", "base_score", "score"):
            assert got[i][col] == pytest.approx(rows[i][col], rel=1e-6), (i, col)


def test_probabilities_of_words_add_up(scored):
    """Known words and their spellings never get more than 1 at a word's beginning."""
    model = scored[2][0]
    mass = model.mass[1:A.BEGIN]
    free = np.minimum(1, A.DISCOUNT * model.kinds[1:A.BEGIN] / np.maximum(mass, 1))
    own = (mass - A.DISCOUNT * model.kinds[1:A.BEGIN]) / np.maximum(mass, 1)
    assert (own + free <= 1 + 1e-9).all() and mass.sum() > 0
    for k in range(A.CLASSES):
        inside = np.exp(model.inside[model.klass == k].astype(float)).sum()
        assert inside <= 1 + 1e-3


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    fitted = A.fit(df.select(df.doc_id.alias("id"), "text"))
    assert A.score(df, fitted).count() == 0
    lone = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    row = A.score(lone, fitted).first()
    assert row["train_tokens"] == 0 and row["base_score"] == 0 and row["score"] < 0


def test_spelling_counts_are_over_all_words(spark, monkeypatch):
    """However few words travel with the tasks, the model is the same."""
    texts = [" ".join(["often"] * 9 + [f"rare{i}x{k}" for k in range(i % 5)]) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    whole = A.fit(df)[0]
    monkeypatch.setattr(A, "HOT_WORDS", 1)
    few = A.fit(df)[0]
    assert np.allclose(few.inside, whole.inside) and np.allclose(few.par["b"], whole.par["b"])
    assert np.array_equal(few.mass, whole.mass) and np.array_equal(few.kinds, whole.kinds)


def test_a_long_text_keeps_no_other_out_of_the_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(A, "SAMPLE_BYTES", 2000)
    monkeypatch.setattr(A, "train", lambda texts, *rest, real=A.train: (seen.append(sorted(texts)), real(texts, *rest, steps=1))[1])
    order = [r["id"] for r in spark.range(20).orderBy(A.F.xxhash64(A.F.lit(1), "id")).collect()]
    texts = {i: f"short text {i}" for i in order}
    texts[order[0]] = "long " * 1000
    A.fit(spark.createDataFrame(list(texts.items()), "id long, text string"))
    A.fit(spark.createDataFrame([(1, "long " * 1000)], "id long, text string"))
    assert seen == [sorted(texts[i] for i in order[1:]), ["long " * 100]]


def test_scores_do_not_depend_on_what_else_is_scored(spark):
    """The same texts alone, among others, and over other partitions: the same bits."""
    texts = [" ".join(f"w{(i * k) % 17}" for k in range(i)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    fitted = A.fit(df.select(df.doc_id.alias("id"), "text"))
    got = [{r["id"] if "id" in r else r["doc_id"]: r["score"] for r in A.score(d, fitted).collect()}
           for d in (df.repartition(1), df.repartition(7), df.filter("doc_id % 3 = 0").coalesce(1))]
    assert got[0] == got[1] and all(got[0][i] == v for i, v in got[2].items())


def test_windows_without_a_place_to_score(spark):
    df = spark.createDataFrame([(1, "a b c")], "id long, text string")
    model = A.fit(df)[0]
    z, live = np.zeros((2, A.WINDOW), int), np.zeros((2, A.WINDOW), bool)
    assert [len(x) for x in A.place_scores(model.par, z, live, np.empty(0, int))] == [0, 0]


def test_the_layer_learns_from_every_training_text(spark, monkeypatch):
    """However few texts the layer starts from: classes and weights come from all of them, and reruns agree."""
    starts, before = [], {}
    monkeypatch.setattr(A, "SAMPLE_DOCS", 1)
    monkeypatch.setattr(A, "train", lambda texts, *rest, real=A.train: (starts.append(texts), real(texts, *rest, steps=1))[1])
    monkeypatch.setattr(A, "learned", lambda model, *rest, real=A.learned: (
        before.update({k: v.copy() for k, v in model.par.items()}), real(model, *rest))[1])
    texts = [" ".join(f"{w}{i}" for w in ("stone", "river", "cloud") for _ in range(9)) for i in range(40)] + ["", None]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3, "id")
    known = [t for t in texts if t]
    par = [A.fit(df)[0].par for _ in range(2)]
    model = A.fit(df)[0]
    assert [len(t) for t in starts] == [1, 1, 1]
    ids, n, _, _ = A.spelled(pa.array(known), encoder(vocabulary()))
    units = np.unique(model.unit[ids])
    assert len(units) > 20 and (model.par["E"][units] != before["E"][units]).any(axis=1).all()
    assert all((model.par[k] != before[k]).any() for k in "PQKVOCb")
    assert all(np.array_equal(p[k], model.par[k]) for p in par for k in p)


def test_neighbours_by_counting(spark, monkeypatch):
    monkeypatch.setattr(A, "UNITS", 6)
    texts = ["a b a c d e f g", "b b b", "", "g f e d c a"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(2)
    counts = np.zeros(A.END + 1)
    laid = []
    for t in texts:
        ids = A.spelled(pa.array([t]), encoder(vocabulary()))[0]
        np.add.at(counts, ids[1:], 1)
        laid.append(ids)
    order, unit = A.units_of(counts)
    m = len(order) + 1
    want = np.zeros((m, 2 * m))
    for ids in laid:
        for a, b in zip(unit[ids[:-1]], unit[ids[1:]]):
            want[b, a] += 1
            want[a, m + b] += 1
    assert m == 6 and np.array_equal(A.neighbours(A.text_ids(df), order, unit), want)


def layer(rng, n_units, kind=np.float32):
    d, c, w = A.WIDTH, A.CLASSES, A.WINDOW
    par = {k: rng.normal(0, 0.4, s).astype(kind) for k, s in dict(E=(n_units, d), P=(w, d), Q=(d, d), K=(d, d), V=(d, d), O=(d, d), C=(d, c), b=(c,)).items()}
    par["mask"] = np.triu(np.full((w, w), -1e9, kind), 1)
    return par


def test_a_step_reuses_its_arrays():
    """No array of a whole batch is made anew, and what the last step left there does not matter."""
    import tracemalloc
    rng = np.random.default_rng(2)
    par = layer(rng, 300)
    room = A.Room(par, A.BATCH)

    def batch(n):
        shape = n, A.WINDOW
        return rng.integers(0, 300, shape), rng.integers(0, A.CLASSES, shape), rng.random(shape) < 0.8

    A.gradients(par, *batch(A.BATCH), room)
    whole = batch(A.BATCH)
    tracemalloc.start()
    A.gradients(par, *whole, room)
    A.place_scores(par, whole[0], whole[2], whole[1][whole[2]], room)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < A.BATCH * A.WINDOW * A.CLASSES * 4
    for n in (1, 5, A.BATCH):
        part = batch(n)
        loss, grad = A.gradients(par, *part, room)
        alone, want = A.gradients(par, *part)
        assert loss == alone and all(np.array_equal(grad[k], want[k]) for k in want)
        z, scored = part[0], part[2]
        value, begin = A.place_scores(par, z, scored, part[1][scored], room)
        ln = A.forward(par, z)[0][scored]
        assert np.allclose(value, ln[np.arange(len(ln)), part[1][scored]], atol=1e-4)
        assert np.allclose(begin, np.log(np.exp(ln[:, :A.BEGIN]).sum(axis=1)), atol=1e-4)


def test_adam_steps():
    rng = np.random.default_rng(3)
    par = {"a": rng.normal(size=(3, 2)), "mask": np.zeros(2), "b": rng.normal(size=4)}
    want = {k: v.copy() for k, v in par.items()}
    m, v = ({k: 0.0 for k in "ab"} for _ in range(2))
    adam = A.Adam(par)
    for t in range(1, 6):
        g = {k: rng.normal(size=par[k].shape) for k in "ab"}
        adam.step(g, 0.1 / t)
        for k in "ab":
            m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.99 * v[k] + 0.01 * g[k] ** 2
            want[k] = want[k] - 0.1 / t * m[k] / (1 - 0.9 ** t) / (np.sqrt(v[k] / (1 - 0.99 ** t)) + 1e-7)
    assert all(np.allclose(par[k], want[k]) for k in par)


def test_stored_texts_are_the_texts(spark):
    """Whatever is spelled once and stored comes back: no words, more than 2^16 different ones, one of many ids."""
    enc = encoder(vocabulary())
    texts = ["", None, "Hello the WORLD", " ".join(f"{i:x}" for i in range(70000)), "é x 中文-ok! \n" + "kq0z" * 70000, " \t", "x"]
    df = spark.createDataFrame([(i, t, i != 4) for i, t in enumerate(texts)], "doc_id long, text string, learns boolean").coalesce(1)
    stored = A.text_ids(df, "doc_id", learns=df.learns)
    seen = {}
    for row in stored.toArrow().to_batches():
        for k, keys, (words, codes, size, sub) in zip(row.column("round").to_pylist(), row.column("keys").to_pylist(), A._stored_texts(row)):
            ids, n, before, order, sizes = A.laid(words, codes, size, sub)
            h = A.joined_hashes(*A.id_sums(enc), sub, size).view(np.int64)
            at = 0
            for i, key in enumerate(keys):
                part = slice(before[i], before[i + 1])
                seen[key["id"]] = k >= 0, ids[at:at + n[i]].tolist(), np.append(h, 0)[order[part]].tolist(), sizes[part].tolist()
                at += n[i]
    assert set(seen) == set(range(len(texts)))
    for i, t in enumerate(texts):
        ids, _, (h, _, _), size = A.spelled(pa.array([t or ""]), enc)
        assert seen[i] == (i != 4, ids.tolist(), h.tolist(), size.tolist())


def test_texts_stored_once_serve_learning_and_scoring(spark, scored):
    """From one stored spelling of all texts, held-out ones included, the counts and base scores of the plain way."""
    docs, df, _fitted, rows = scored
    learns = ~A.held_out(df.doc_id)
    ids = A.text_ids(df, "doc_id", learns=learns)
    fitted = A.fit(df.filter(learns).select(df.doc_id.alias("id"), A.text_column(df).alias("text")), ids=ids)
    got = {r["doc_id"]: r for r in A.score(df, fitted, ids=ids).collect()}
    assert set(got) == set(rows)
    for i, r in rows.items():
        assert all(got[i][c] == r[c] for c in ("n_tokens", "n_known", "train_tokens")), i
        assert got[i]["base_score"] == pytest.approx(r["base_score"], rel=1e-12)
    held = [i for i, _ in docs if zlib.crc32(str(i).encode()) % 7 == 2]
    assert sum(got[i]["score"] for i in held) > sum(got[i]["base_score"] for i in held)


def test_remembered_spellings_change_nothing(monkeypatch):
    enc = encoder(vocabulary())
    texts = [pa.array([" ".join(f"Word{i}x{i * k}" for i in range(50 * k))]) for k in range(1, 5)]
    first = [A.spelled(t, enc) for t in texts]
    monkeypatch.setattr(A, "spellings", lambda own, words, enc: (np.diff((made := A.spell(words(np.arange(len(own))), enc))[1]), made[0]))
    for t, (ids, n, (h, _, _), size) in zip(texts, first):
        plain = A.spelled(t, enc)
        assert np.array_equal(ids, plain[0]) and np.array_equal(n, plain[1]) and np.array_equal(h, plain[2][0]) and np.array_equal(size, plain[3])
