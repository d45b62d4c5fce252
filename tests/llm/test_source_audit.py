"""Source audit against a direct computation over all terms and pairs."""

import random
import re
from collections import Counter, defaultdict

import pytest

from eventide.llm import source_audit

SCHEMA = "doc_id long, text string, lang string, source string"
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def brute(rows, min_docs, top):
    docs = [((lang or ""), (source or ""), re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER)))
            for _, text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(t for d in mine for t in set(d[2]))
        kept = {t for t, n in df.items() if n >= min_docs}
        count = defaultdict(Counter)
        for _, source, words in mine:
            count[source].update(w for w in words if w in kept)

        def shares(c):
            below = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 10**9 * (c[t] + 5) // below for t in kept}
        p, q = {s: shares(c) for s, c in count.items()}, shares(sum(count.values(), Counter()))
        for s in p:
            pairs = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in p if o != s))
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(pairs, 1)]
            terms = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if count[s][t] and p[s][t] > q[t])[:top]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(terms, 1)]
    return sorted(out)


def found(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


def corpus(seed, n=160):
    rng = random.Random(seed)
    words = ["a", "Ab", "ÄB", "äb", "naïve", "x1y", "日本", "zz", "q-r", "Z", "été", "the", "of"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 25))) for _ in range(30)]
    rows = [(i, rng.choice(texts), rng.choice(["en", "en", "fr", None, ""]),
             rng.choice(["s1", "s1", "s1", "s2", "é3", "z", None])) for i in range(n)]
    rows += [(900, None, "en", "empty"), (901, "", "de", "x"), (902, "only", "de", "y"), (903, "!!! 123", "en", "s2")]
    return rows + rows[:5]      # repeated rows


@pytest.mark.parametrize("min_docs, top", [(5, 3), (1, 50), (1000, 50)])
def test_like_brute_force(spark, min_docs, top):
    rows = corpus(min_docs)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(source_audit.audit(df, min_docs, top)) == brute(rows, min_docs, top)


def test_hot_text_and_source_in_small_parts(spark, monkeypatch):
    """Copies met over many tasks, sums handed on after each text, lists cut into stretches."""
    rows = corpus(3) + [(2000 + i, "the hot hot text", "en", f"s{i % 40}") for i in range(300)]
    for name, value in (("COLLAPSE_BYTES", 64), ("PENDING", 3), ("PAIR_CELLS", 50)):
        monkeypatch.setattr(source_audit, name, value)
    df = spark.createDataFrame(rows, SCHEMA).repartition(7)
    assert found(source_audit.audit(df, 4, 5)) == brute(rows, 4, 5)


def test_other_columns_and_no_rows(spark):
    rows = corpus(8, 40)
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS term", "2 AS n", "'x' AS h", "3 AS id", "4 AS rank", "5 AS value", "6 AS V")
    assert found(source_audit.audit(df, 2, 5)) == brute(rows, 2, 5)
    assert source_audit.audit(df.limit(0), 2, 5).collect() == []


def under_broadcasts(df):
    """The plan's lines below each broadcast, joined."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = [len(line) - len(line.lstrip(" :+-")) for line in lines]
    out = []
    for i, line in enumerate(lines):
        if "BroadcastExchange" in line:
            end = next((j for j in range(i + 1, len(lines)) if depth[j] <= depth[i]), len(lines))
            out.append("\n".join(lines[i + 1:end]))
    return out


@pytest.mark.parametrize("group_bytes", [4 << 20, 0])
def test_terms_are_not_broadcast(spark, monkeypatch, group_bytes):
    """A term's list of sources is many rows, which Spark sizes as one."""
    monkeypatch.setattr(source_audit, "GROUP_BYTES", group_bytes, raising=False)
    rows = corpus(6)
    df = source_audit.audit(spark.createDataFrame(rows, SCHEMA).repartition(3), 2, 5)
    sent = under_broadcasts(df)
    assert bool(sent) == bool(group_bytes) and not any("inline(" in plan for plan in sent)
    assert found(df) == brute(rows, 2, 5)


def test_shares_of_large_counts_are_exact(spark):
    from pyspark.sql import functions as F
    cases = [(0, 0, 1), (9 * 10**14, 9 * 10**15, 10**5), (123456789012, 999999999999, 777), (7, 3 * 10**14 + 1, 12345)]
    got = spark.createDataFrame(cases, "c long, n long, v long").select(
        "c", "n", "v", source_audit._share(F.col("c"), F.col("n"), F.col("v")).alias("p")).collect()
    assert [r["p"] for r in got] == [1 + 10**9 * (r["c"] + 5) // (r["n"] + 5 * r["v"]) for r in got]


def test_terms_are_the_contracts():
    text = "Ab-cD été_X É日本9q\x00z\x7f\x80"
    assert [t.decode() for t in source_audit.terms_of(text.encode())] == re.findall(
        r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(LOWER))
