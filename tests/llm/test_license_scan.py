"""License scan against a look at every place of every text."""

import random
import re
from collections import Counter

import pytest

from eventide.llm import license_scan as L

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
SCHEMA = "doc_id long, text string"


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(rows, phrases=L.PHRASES, templates=L.TEMPLATES, asked=L.ASKED):
    texts = [words_of(t) for _, t in rows]
    made = [(label, words_of(notice), [words_of(p) for p in must]) for label, notice, must in templates]
    files = Counter(w for t in texts for w in set(t))
    out = []
    for (doc, _), words in zip(rows, texts):
        base = sorted((i, label) for p, label in phrases for i in range(len(words)) if words[i:i + len(words_of(p))] == words_of(p))
        found, score = set(), 0.5 if base else 0.0
        for label, notice, must in made:
            mine = sorted({w for w in words if w in notice and w not in L.COMMON}, key=lambda w: (files[w], w))[:asked]
            need = min(2, sum(w not in L.COMMON for w in notice))
            for start in range(-len(notice), len(words)):
                at = lambda k: words[start + k] if 0 <= start + k < len(words) else None  # noqa: B023, E731
                same = [at(k) == w for k, w in enumerate(notice)]
                agree = sum(s and w in mine for s, w in zip(same, notice))
                places = [next(i for i in range(len(notice)) if notice[i:i + len(p)] == p) for p in must]
                if agree >= need and all(all(same[i:i + len(p)]) for i, p in zip(places, must)):
                    found.add(label)
                    score = max(score, sum(same) / len(notice))
        own = {label for _, label in base}
        out.append((doc, len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                    ",".join(sorted(own)), ",".join(sorted(own | found)), score))
    return sorted(out, key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"], r["score"])
                   for r in df.collect()), key=str)


def corpus(seed, n=120):
    rng = random.Random(seed)
    parts = [t for _, t, _ in L.TEMPLATES] + ["the work is", "MIT", "license", "general public", "Version 2.0", "hello", "été", "CC BY", "0"]
    rows = []
    for i in range(n):
        words = " ".join(rng.choice(parts) for _ in range(rng.randint(0, 4))).split()
        for _ in range(rng.randint(0, 3)):      # cut, change and turn words
            if words:
                k = rng.randrange(len(words))
                words[k:k + rng.randint(0, 2)] = rng.choice([[], ["x"], ["MIT"], ["License,"]])
        rows.append((i, rng.choice([" ", "\n", " - "]).join(words)))
    return rows


def test_like_brute_force(spark):
    rows = corpus(1) + [(500, None), (501, ""), (502, "MIT License"), (503, "mit-license MIT LICENSE apache  License"), (None, "mit license"),
                        (504, "mit licenſe Kind apacKe"), (505, "Licensed under CC BY-NC 4.0" * 2), (506, "!!!")]
    rows += rows[:4]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(L.scan(df)) == brute(rows)


@pytest.mark.parametrize("asked", [1, 2, 9])
def test_few_words_asked_for(spark, asked):
    rows = corpus(2 + asked, 60)
    templates = (("p", "red green blue apache license of the blue", ("green blue",)), ("q", "license red red license", ("red red", "license")))
    rows += [(900 + i, t) for i, t in enumerate(["red green blue apache license", "x green blue y", "license red red license red red license",
                                                "green blue apache license of the blue", "Red, green; BLUE apache"])]
    phrases = (("license red", "a"), ("red", "b"), ("license", "a"))
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(L.scan(df, phrases, templates, asked)) == brute(rows, phrases, templates, asked)


def test_long_text_other_columns_and_no_rows(spark):
    rows = [(1, "the word " * 30000 + "Released under the MIT License. " * 3000 + "license " * 5000), (2, "permission")]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS file", "2 AS words", "'x' AS label", "3 AS found", "4 AS base", "5 AS pos")
    (one, two) = got(L.scan(df))
    assert one == (1, 60000 + 15000 + 5000, 3000, 60003, 60003 + 5 * 2999, "mit", "mit", 1.0) and two[-2:] == ("", 0.0)
    assert L.scan(df.limit(0)).collect() == []


def test_places_of_notices(spark):
    df = spark.createDataFrame([(1, "x Licensed under CC BY-NC 4.0 y BY-NC cc by nc 4"), (2, "under CC BY-SA 4.0")], SCHEMA)
    found = {(r["label"], r["begins"], round(r["share"], 3)) for r in L.notices(L.license_words(df)).collect()}
    assert found == {("cc-by-nc", 1, 1.0), ("cc-by-nc", 9, round(4 / 7, 3)), ("cc-by-sa", -1, round(6 / 7, 3))}


def test_bad_templates_are_refused(spark):
    df = spark.createDataFrame([(1, "a")], SCHEMA)
    for templates in ((("x", "red green", ("blue",)),), (("x", "the of", ("the",)),), (("x", "été license", ("license",)),)):
        with pytest.raises(ValueError):
            L.scan(df, templates=templates)


def test_whole_table_without_python(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    df = L.op13_license_scan(spark, sf)
    assert got(df) == brute(rows)
    assert not any(x in df._jdf.queryExecution().executedPlan().toString() for x in ("Python", "Pandas", "Arrow"))
