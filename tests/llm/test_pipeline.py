import re

import numpy as np
import pytest
from test_suffix_dedup import brute as cut_repeats
from test_weighted_minhash import brute as classes_of

import corpus_pipeline as C
from eventide.llm import toxic_spans


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Every stage's rows, each written as Parquet and read again."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    out.append(docs)
    for name, f in C.STAGES:
        path = str(tmp_path_factory.mktemp(name.replace(" ", "-")) / "rows")
        f(spark, docs, sf).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs)
    return out


def pairs(df):
    return sorted((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_stages_and_columns(stages):
    assert [n for n, _ in C.STAGES] == ["toxicity", "near duplicates", "repeated passages", "mix", "pack"]
    for df in stages[1:-1]:
        assert df.columns == stages[0].columns
        assert [f.dataType for f in df.schema] == [f.dataType for f in stages[0].schema]


def test_toxicity_keeps_clean_documents(spark, sf, stages):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxic_spans.score(stages[0], toxic_spans.fit(stages[0], labels)).collect()
    assert {i for i, _ in pairs(stages[1])} == {r["doc_id"] for r in rows if r["score"] < 0.5}


def test_near_duplicates_equal_all_pairs(stages):
    docs = pairs(stages[1])
    want = classes_of(docs)
    assert pairs(stages[2]) == [(i, t) for i, t in docs if want[i] == i]


def test_repeated_passages_equal_brute_force(stages):
    docs = pairs(stages[2])
    want = {i: gone for i, _n, gone, _s, _h in cut_repeats(docs, 100)}
    for i, t in docs:
        kept = dict(pairs(stages[3]))[i]
        if not want[i]:
            assert kept == t
        assert len((t or "").encode()) - want[i] - 3 * 40 <= len(kept.encode()) <= len((t or "").encode()) - want[i]
    assert all(r["n_chars"] == len(r["text"]) for r in stages[3].collect())


def test_mix_takes_words_of_its_documents(stages):
    word = re.compile(r"[^\x20\x09-\x0D]+")
    before, after = dict(pairs(stages[3])), pairs(stages[4])
    taken = {}
    for i, t in after:
        taken[i] = taken.get(i, 0) + len(word.findall(t))
        assert set(word.findall(t)) <= set(word.findall(before[i]))
    sizes = {i: len(word.findall(t)) for i, t in before.items()}
    assert all(n <= 2 * sizes[i] for i, n in taken.items())
    assert sum(taken.values()) == pytest.approx(1.5 * sum(sizes.values()), rel=0.01)


def test_packed_ids_are_the_documents(stages):
    rows = stages[5].collect()
    assert sum(r["length"] for r in rows) == sum(r["doc_tokens"] for r in rows if r["start"] == 0)
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in by.values():
        pieces.sort()
        ends = np.cumsum([n for _, n in pieces])
        assert [o for o, _ in pieces] == [0, *ends[:-1].tolist()] and ends[-1] <= 2048


def test_run_gives_the_last_stage(spark, sf, stages):
    got = C.run(spark, sf)
    assert got.columns == stages[5].columns
    total = lambda df: df.groupBy().sum("length").first()[0]
    assert total(got) == total(stages[5])
