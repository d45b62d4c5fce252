"""Source divergence audit: how far apart the sources of a language are in their words.

Duplicate-text collapse: equal texts of a language become one text with the number of
its copies in each source, first within a task, then over all tasks (keyed by SHA-256,
so a text that a third of all rows hold is one row a task in the shuffle). Each
distinct text is split into terms once; its terms count as often as its copies,
for the document frequencies of the language and for the occurrences in each source.

Smoothed shares, in whole numbers: a group (language, source) gives a kept term with
``c`` occurrences ``p = 1 + floor(SCALE * (c + SMOOTH) / (N + SMOOTH * V))``. Most terms
do not occur in most sources, so two sources are compared from what does occur.
With ``b`` the share of a term that a source lacks, the distance of s and t is

    V |b_s - b_t|
    + sum over terms of s (|p_s - b_t| - |b_s - b_t|)
    + sum over terms of t (|p_t - b_s| - |b_s - b_t|)
    + sum over terms of both (|p_s - p_t| - |p_s - b_t| - |p_t - b_s| + |b_s - b_t|).

The one-sided sums need only how many terms of a source occur c times, once for each c. The
last sum runs over the lists of sources by term, which tasks reduce to one row per pair.
"""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import map_arrow, stored, table, written

MIN_DOCS = 30           # documents of a language that hold a kept term
SMOOTH = 5              # added to every count
SCALE = 1_000_000_000   # shares are whole numbers of 1 / SCALE
TOP_TERMS = 50
COLLAPSE_BYTES = 16 << 20      # texts that one task holds while it looks for copies
PENDING = 300_000              # (source, term) sums that a task holds before it hands them on
PAIR_CELLS = 1 << 20           # pair differences that are computed at once
GROUP_BYTES = 4 << 20          # (language, source) groups that are broadcast; more are joined by sorting

#: Letters of ASCII in lower case and all bytes of other characters; the rest separates terms.
_TERM_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def terms_of(text: bytes) -> list[bytes]:
    """Runs of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]`` in UTF-8 bytes, A-Z lower-cased."""
    return text.translate(_TERM_BYTES).split()


def _collapse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Equal texts of a language within a task, at most ``COLLAPSE_BYTES`` at a time."""
    kept: dict[tuple, list] = {}
    size = 0

    def flush():
        keys = list(kept)
        return pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.binary()),
            pa.array([kept[k][0] for k in keys], pa.binary()),
            pa.array([list(kept[k][1]) for k in keys], pa.list_(pa.string())),
            pa.array([list(kept[k][1].values()) for k in keys], pa.list_(pa.int64())),
        ], names=["lang", "h", "text", "sources", "copies"])

    for batch in batches:
        for lang, source, text in zip(*[batch.column(c).to_pylist() for c in ("lang", "source", "text")]):
            key = (lang, hashlib.sha256(text).digest())
            if key in kept:
                kept[key][1][source] += 1
                continue
            kept[key] = [text, Counter({source: 1})]
            size += len(text)
            if size > COLLAPSE_BYTES:
                yield flush()
                kept, size = {}, 0
    if kept:
        yield flush()


def _term_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (lang, h): every run of copies is split into terms once, and its
    terms are added with the copies' weights. Sums are handed on in parts."""
    count: dict[tuple, Counter] = defaultdict(Counter)
    docs: dict[tuple, Counter] = defaultdict(Counter)

    def flush():
        keys = [(k, t) for k, terms in count.items() for t in terms]
        out = pa.RecordBatch.from_arrays([
            pa.array([k[0] for k, _ in keys], pa.string()), pa.array([k[1] for k, _ in keys], pa.string()),
            pa.array([t.decode() for _, t in keys], pa.string()),
            pa.array([count[k][t] for k, t in keys], pa.int64()),
            pa.array([docs[k][t] for k, t in keys], pa.int64())], names=["lang", "source", "term", "n", "docs"])
        count.clear()
        docs.clear()
        return out

    def add(lang, text, copies):
        words = terms_of(text)
        for source, k in copies.items():
            into, seen = count[lang, source], docs[lang, source]
            if k == 1:
                into.update(words)
                seen.update(set(words))
            else:
                for term, n in Counter(words).items():
                    into[term] += n * k
                    seen[term] += k

    now, text, copies = None, b"", Counter()
    for batch in batches:
        for lang, h, value, sources, counts in zip(*[batch.column(c).to_pylist() for c in ("lang", "h", "text", "sources", "copies")]):
            if (lang, h) != now:
                if now is not None:
                    add(now[0], text, copies)
                    if sum(map(len, count.values())) > PENDING:
                        yield flush()
                now, text, copies = (lang, h), value, Counter()
            for source, k in zip(sources, counts):
                copies[source] += k
    if now is not None:
        add(now[0], text, copies)
    if count:
        yield flush()


def _share(count: Column, size: Column, kept: Column) -> Column:
    """``1 + floor(SCALE * (count + SMOOTH) / (size + SMOOTH * kept))`` in BIGINT, by long
    division of three digits at a time: exact up to 9 * 10^15 terms. Without kept terms no share
    is used (one is computed by 1 instead of 0)."""
    rest, below = count + F.lit(SMOOTH), F.greatest(size + F.lit(SMOOTH) * kept, F.lit(1))
    out = F.lit(0).cast("long")
    for _ in range(3):
        rest = rest * F.lit(1000)
        out = out * F.lit(1000) + F.call_function("div", rest, below)
        rest = rest % below
    return F.lit(1) + out


def _shared_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The last sum of the module's formula: one row per pair of sources of a language
    and part, from lists ``(id, p, b)`` of the sources that hold a term."""
    sums: dict[tuple, int] = defaultdict(int)

    def flush():
        keys = list(sums)
        out = pa.RecordBatch.from_arrays([
            pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
            pa.array([k[2] for k in keys], pa.int64()), pa.array([sums[k] for k in keys], pa.int64())],
            names=["lang", "i", "j", "both"])
        sums.clear()
        return out

    def add(lang, i, j, values):
        width = int(max(i.max(), j.max())) + 1
        code, at = np.unique(i * width + j, return_inverse=True)
        total = np.zeros(len(code), np.int64)
        np.add.at(total, at, values)
        for c, v in zip(code.tolist(), total.tolist()):
            sums[lang, c // width, c % width] += v

    for batch in batches:
        langs = batch.column("lang").to_pylist()
        lists = batch.column("held")
        off = lists.offsets.to_numpy()
        flat = lists.flatten()
        off = off - off[0]
        ids, p, b = (flat.field(n).to_numpy(zero_copy_only=False) for n in ("id", "p", "b"))
        sizes = np.diff(off)
        groups = defaultdict(list)
        for row, (lang, k) in enumerate(zip(langs, sizes.tolist())):
            if k > 1:
                groups[lang, k].append(row)
        for (lang, k), rows in groups.items():
            # terms with equally long lists together; a long list by stretches of its sources
            step = max(1, PAIR_CELLS // (k * k))
            for at in range(0, len(rows), step):
                idx = off[rows[at:at + step]][:, None] + np.arange(k)
                order = np.argsort(ids[idx], axis=1)
                idx = np.take_along_axis(idx, order, 1)
                high = max(1, PAIR_CELLS // (k * len(idx)))
                for lo in range(0, k, high):
                    a = idx[:, lo:lo + high, None]
                    o = idx[:, None, :]
                    values = (np.abs(p[a] - p[o]) - np.abs(p[a] - b[o]) - np.abs(b[a] - p[o]) + np.abs(b[a] - b[o]))
                    pair = np.broadcast_to(ids[a] < ids[o], values.shape)
                    if pair.any():
                        add(lang, np.broadcast_to(ids[a], values.shape)[pair], np.broadcast_to(ids[o], values.shape)[pair],
                            values[pair])
                    if len(sums) > PENDING:
                        yield flush()
    if sums:
        yield flush()


def postings(docs: DataFrame) -> DataFrame:
    """``(lang, term, docs, n, held)`` for every term: documents of the language that hold it, its
    occurrences there, and ``held`` the list of ``(source, n)`` of the sources it occurs in. Null
    text, lang and source are empty.

    One shuffle brings the copies of a text together, one the sums of a term; both carry at most
    a row per task and key."""
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    rows = rows.withColumn("text", F.col("text").cast("binary"))
    texts = map_arrow(rows, _collapse, "lang string, h binary, text binary, sources array<string>, copies array<bigint>")
    met = texts.repartition("lang", "h").sortWithinPartitions("lang", "h")
    sums = map_arrow(met, _term_sums, "lang string, source string, term string, n long, docs long")
    by_source = sums.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return by_source.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"),
                                                 F.collect_list(F.struct("source", "n")).alias("held"))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``.

    ``pair``: every other source of the language, by the distance of their smoothed shares
    over the kept terms (those in at least ``min_docs`` documents of the language; 0 if there are
    none). ``term``: the ``top_terms`` kept terms of the source whose share is most above
    the language's. Ranks fall by value, ties by the UTF-8 of the item.

    Null and empty texts have no terms, but their groups are there: a group without kept
    terms is compared by its smoothing alone. Null lang and source count as empty names. Repeated
    rows count each. Other columns of ``docs`` are not read. Empty input gives no rows. A task holds at most
    ``COLLAPSE_BYTES`` of texts and ``PENDING`` sums; the list of sources of one term is read whole, as
    the result has a row for each pair of sources of a language anyway. Terms are never broadcast: Spark sizes
    the rows of their lists by the file, many times too low, so the joins are set by the groups' measured size.
    """
    kept = written(postings(docs).filter(F.col("docs") >= min_docs).select("lang", "term", F.col("n").alias("all"), "held"), "audit-terms")
    used = kept.select("lang", "term", "all", F.inline("held"))
    names = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    size = used.groupBy("lang", "source").agg(F.sum("n").alias("size"))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("V"), F.sum("all").alias("lang_size"))
    groups = (names.join(size.hint("merge"), ["lang", "source"], "left").join(langs, "lang", "left")
              .select("lang", "source", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("size", "V", "lang_size")]))
    groups = groups.withColumn("id", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long"))
    # V = 0: no term is kept in the language and every distance is 0
    some = F.col("V") > 0
    groups = stored(groups.withColumn("b", F.when(some, _share(F.lit(0).cast("long"), F.col("size"), F.col("V"))).otherwise(F.lit(0).cast("long"))))

    few = groups.agg(F.sum(F.octet_length("lang") + F.octet_length("source") + F.lit(64)).alias("bytes")).first()["bytes"] or 0
    shares = used.join(groups.select("lang", "source", "id", "b", "size", "V", "lang_size")
                       .hint("broadcast" if few <= GROUP_BYTES else "merge"), ["lang", "source"])
    shares = shares.withColumn("p", _share(F.col("n"), F.col("size"), F.col("V")))
    above = (shares.withColumn("value", F.col("p") - _share(F.col("all"), F.col("lang_size"), F.col("V")))
             .filter("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value"))
    best = _ranked(above).filter(F.col("rank") <= top_terms)

    lists = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("id", "p", "b")).alias("held")).filter("size(held) > 1")
    both = (map_arrow(lists.select("lang", "held"), _shared_terms, "lang string, i long, j long, both long")
            .groupBy("lang", "i", "j").agg(F.sum("both").alias("both")))
    levels = shares.groupBy("lang", "id", "b", "p").agg(F.count(F.lit(1)).alias("terms"))
    other = groups.select("lang", F.col("id").alias("o_id"), F.col("b").alias("o_b"))
    one_sided = (levels.join(other, "lang").filter("id <> o_id")
                 .groupBy("lang", F.least("id", "o_id").alias("i"), F.greatest("id", "o_id").alias("j"))
                 .agg(F.sum(F.col("terms") * (F.abs(F.col("p") - F.col("o_b")) - F.abs(F.col("b") - F.col("o_b")))).alias("own")))
    left = groups.select("lang", "V", F.col("id").alias("i"), F.col("source").alias("i_source"), F.col("b").alias("i_b"))
    right = groups.select("lang", F.col("id").alias("j"), F.col("source").alias("j_source"), F.col("b").alias("j_b"))
    pairs = (left.join(right, "lang").filter("i < j").join(one_sided, ["lang", "i", "j"], "left")
             .join(both, ["lang", "i", "j"], "left"))
    value = (F.col("V") * F.abs(F.col("i_b") - F.col("j_b")) + F.coalesce("own", F.lit(0)) + F.coalesce("both", F.lit(0))).cast("long")
    both_ways = F.explode(F.array(F.struct(F.col("i_source").alias("source"), F.col("j_source").alias("item")),
                                  F.struct(F.col("j_source").alias("source"), F.col("i_source").alias("item"))))
    apart = (pairs.select("lang", value.alias("value"), both_ways.alias("s"))
             .select("lang", "s.source", F.lit("pair").alias("part"), "s.item", "value"))
    return _ranked(apart).unionByName(best)


def _ranked(rows: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), F.asc("item"))
    return rows.withColumn("rank", F.row_number().over(order))


def op12_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
w AS (
  SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
k AS (
  SELECT lang, term, CAST(count(*) AS BIGINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS size FROM k GROUP BY lang),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN k ON w.lang = k.lang AND w.term = k.term GROUP BY ALL),
g AS (
  SELECT s.lang, s.source, coalesce(sum(c.n), 0) AS size
  FROM (SELECT DISTINCT lang, source FROM d) s LEFT JOIN c ON c.lang = s.lang AND c.source = s.source GROUP BY ALL),
p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
    CAST(1 + (1000000000 * (CAST(coalesce(c.n, 0) AS HUGEINT) + 5)) // (CAST(g.size AS HUGEINT) + 5 * l.v) AS BIGINT) AS p,
    CAST(1 + (1000000000 * (CAST(k.n AS HUGEINT) + 5)) // (CAST(l.size AS HUGEINT) + 5 * l.v) AS BIGINT) AS q
  FROM g JOIN l ON l.lang = g.lang JOIN k ON k.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
f AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(pairs.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, p - q FROM p WHERE n > 0 AND p > q),
z AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM f)
SELECT lang, source, part, item, value, rank FROM z WHERE part = 'pair' OR rank <= 50
"""
