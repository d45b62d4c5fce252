"""Near-duplicate documents by improved consistent weighted sampling.

A document is its set of five-word shingles, each weighted by its count in the
document times a mild inverse document frequency, 1 + ln(N / df) / ln N (from 1
for a shingle of every document to 2). Document frequencies are
counted over all documents in 2^20 hash buckets, so the table has a fixed size.
``bands * rows`` consistent weighted samples are drawn per document (Gamma(2, 1)
and uniform draws that depend on shingle and sample number only): two documents
draw the same sample with probability equal to their weighted Jaccard similarity.
Documents that agree in all samples of a band meet; each meeting that can change
the result is verified by the exact weighted Jaccard similarity.

Documents with equal shingle counts are one class from the start. A bucket of
many classes is not expanded into pairs. First all its members are compared with
the one that meets most others, and what links is joined. Of the members
still apart, those are dropped that cannot link with anybody: two texts share at most the
weight of the shingles that either has in common with any other text. The
meetings across classes that this bound allows are compared, each once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import (components, grouped_arrow, map_arrow, mix64, per_process, stored, table, text_column, utf8,
                                 word_bounds, word_hashes)
from eventide.session import scratch_path

SHINGLE_WORDS, SIMILARITY = 5, 0.8
BANDS, ROWS, SEED = 8, 3, 5
HASH_BITS, DF_BITS, DF_PARTS = 44, 20, 64
SLICE_BYTES = 1 << 20

_MASK = np.uint64((1 << HASH_BITS) - 1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def shingle_counts(texts: pa.Array, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``document index << 44 | shingle hash`` of a slice of texts,
    sorted, and how often each occurs. Words are runs without ASCII white
    space, A-Z lower-cased; a text of fewer than ``width`` words is one shingle."""
    data, off = utf8(texts)
    starts, ends, before = word_bounds(data, off)
    words = word_hashes(_LOWER[data] if len(data) else data, starts, ends)
    n = np.diff(before)
    total = np.zeros(len(words), np.uint64)
    doc = np.repeat(np.arange(len(n), dtype=np.int64), n)
    place = np.arange(len(words)) - np.repeat(before[:-1], n)
    left = np.repeat(n, n) - place
    for k in range(width):
        factor = np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64))
        part = words[k:] * factor
        total[:len(words) - k] += np.where(left[:len(words) - k] > k, part, np.uint64(0)) if k else part
    whole = (left >= width) | ((place == 0) & (left < width))
    keys = (doc[whole].astype(np.uint64) << np.uint64(HASH_BITS)) | (mix64(total[whole]) & _MASK)
    keys.sort()
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.empty(0, np.int64)
    return keys[first], np.diff(np.append(first, len(keys)))


def slices(column: pa.Array, most: int = SLICE_BYTES):
    """``(from, to)`` runs of a text column of about ``most`` bytes."""
    _, off = utf8(column)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(off, off[at] + most, "right")) - 1)
        to = min(to, len(column), at + (1 << 19))
        yield at, to
        at = to


def frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Weight of every hash bucket and the number of documents. Tasks add up
    their documents first; the table has 2^20 numbers at any corpus size."""
    def run(batches):
        seen, n = np.zeros(1 << DF_BITS, np.int64), 0
        for batch in batches:
            col = batch.column(0)
            for a, b in slices(col):
                keys, _ = shingle_counts(col.slice(a, b - a))
                doc_bucket = keys >> np.uint64(HASH_BITS - DF_BITS)
                fresh = np.concatenate([[True], doc_bucket[1:] != doc_bucket[:-1]]) if len(keys) else np.empty(0, bool)
                seen += np.bincount((doc_bucket[fresh] & np.uint64((1 << DF_BITS) - 1)).astype(np.int64), minlength=1 << DF_BITS)
                n += b - a
        parts = seen.reshape(DF_PARTS, -1)
        yield pa.RecordBatch.from_arrays([pa.array(range(DF_PARTS), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary()),
                                          pa.array([n] * DF_PARTS, pa.int64())], names=["part", "df", "n"])

    def add(key, t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in t.column("df").to_pylist())
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "df": pa.array([total.tobytes()], pa.binary()),
                         "n": pa.array([sum(t.column("n").to_pylist())], pa.int64())})

    schema = "part int, df binary, n long"
    # one row per part of the table from each task, added part by part; 8 MB reach the driver
    table_ = grouped_arrow(map_arrow(docs.select("text"), run, schema), ["part"], add, schema).toArrow().sort_by("part")
    n = max(table_.column("n").to_pylist(), default=0)
    df = np.maximum(np.frombuffer(b"".join(table_.column("df").to_pylist()), np.int64), 1)
    if not len(df):
        df = np.ones(1 << DF_BITS, np.int64)
    weight = 1 + np.log(np.maximum(n, 1) / np.minimum(df, max(n, 1))) / np.log(max(n, 2))
    return weight.astype(np.float32), n


def weights_of(keys: np.ndarray, counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    bucket = (keys >> np.uint64(HASH_BITS - DF_BITS)) & np.uint64((1 << DF_BITS) - 1)
    return counts.astype(np.float32) * idf[bucket.astype(np.int64)]


def draws(seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """2^16 seeded draws each of r ~ Gamma(2, 1), ln c with c ~ Gamma(2, 1), and
    beta ~ U(0, 1). A hash of shingle and sample number picks one of each by bits of its own,
    so 2^48 different triples are drawn from."""
    g = np.random.default_rng(seed)
    return (g.gamma(2, 1, 1 << 16).astype(np.float32) + np.float32(1e-6),
            np.log(g.gamma(2, 1, 1 << 16) + 1e-12).astype(np.float32), g.random(1 << 16, np.float32))


def samples(keys: np.ndarray, weight: np.ndarray, starts: np.ndarray, count: int, seed: int) -> np.ndarray:
    """Consistent weighted samples, one row per sample number and one column
    per document (``starts``: its first key): the shingle of least ln a, with its
    quantised level t."""
    r_of, c_of, beta_of = per_process(("draws", seed), lambda: draws(seed))
    hashes, log_w = keys & _MASK, np.log(weight)
    number = np.arange(len(keys), dtype=np.uint64)
    out = np.empty((count, len(starts)), np.uint64)
    base, low = hashes + np.uint64(seed) << np.uint64(20), np.uint64(0xFFFF)
    for k in range(count):
        pick = mix64(base + np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
        r = r_of[(pick >> np.uint64(48)).astype(np.int64)]
        beta = beta_of[(pick >> np.uint64(32) & low).astype(np.int64)]
        t = np.floor(log_w / r + beta)
        ln_a = c_of[(pick >> np.uint64(16) & low).astype(np.int64)] - r * (t - beta + 1)
        bits = ln_a.view(np.uint32)
        order = np.where(bits >> 31, ~bits, bits | np.uint32(0x80000000)).astype(np.uint64)
        won = (np.minimum.reduceat(order << np.uint64(32) | number, starts) & np.uint64(0xFFFFFFFF)).astype(np.int64)
        out[k] = mix64(hashes[won] * np.uint64(0x9E3779B97F4A7C15) + t[won].astype(np.int64).astype(np.uint64))
    return out


def signatures(docs: DataFrame, idf: np.ndarray, bands: int, rows: int, seed: int) -> DataFrame:
    """``(id, f1, f2, bands, weight)``: the class fingerprint (128 bits over
    shingle counts), null for texts without words, one hash per band and the
    total weight."""
    share = docs.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        for batch in batches:
            col = batch.column(1)
            for a, b in slices(col):
                keys, counts = shingle_counts(col.slice(a, b - a))
                doc = (keys >> np.uint64(HASH_BITS)).astype(np.int64)
                f1, f2 = np.zeros(b - a, np.uint64), np.zeros(b - a, np.uint64)
                band = np.zeros((b - a, bands), np.uint64)
                has, total = np.zeros(b - a, bool), np.zeros(b - a)
                if len(keys):
                    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
                    at = doc[starts]
                    has[at] = True
                    one = mix64((keys & _MASK) * np.uint64(3) + counts.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
                    f1[at] = np.add.reduceat(one, starts)
                    f2[at] = np.add.reduceat(mix64(one + np.uint64(0x9E3779B97F4A7C15)), starts)
                    weight = weights_of(keys, counts, share.value)
                    total[at] = np.add.reduceat(weight.astype(np.float64), starts)
                    drawn = samples(keys, weight, starts, bands * rows, seed)
                    for j in range(bands):
                        h = np.full(len(at), j, np.uint64)
                        for i in range(rows):
                            h = mix64(h * np.uint64(0xBF58476D1CE4E5B9) + drawn[j * rows + i])
                        band[at, j] = h
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (b - a) * bands + 1, bands), pa.int32()),
                                                 pa.array(band.ravel().view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(a, b - a), pa.array(f1.view(np.int64), mask=~has), pa.array(f2.view(np.int64), mask=~has), lists,
                     pa.array(total)], names=["id", "f1", "f2", "bands", "weight"])

    return map_arrow(docs.select("id", "text"), run, "id long, f1 long, f2 long, bands array<long>, weight double")


def verified(pairs: DataFrame, texts: DataFrame, idf: np.ndarray, similarity: float) -> DataFrame:
    """``(a, b, ok)``: whether the exact weighted Jaccard similarity of each pair's texts
    reaches ``similarity``."""
    share = pairs.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        for batch in batches:
            left, right = batch.column(2), batch.column(3)
            ok = np.zeros(batch.num_rows, bool)
            _, off = utf8(left)
            _, off2 = utf8(right)
            both = off + off2
            at = 0
            while at < batch.num_rows:
                to = min(batch.num_rows, max(at + 1, int(np.searchsorted(both, both[at] + SLICE_BYTES, "right")) - 1))
                k1, c1 = shingle_counts(left.slice(at, to - at))
                k2, c2 = shingle_counts(right.slice(at, to - at))
                w1, w2 = weights_of(k1, c1, share.value).astype(np.float64), weights_of(k2, c2, share.value).astype(np.float64)
                pos = np.minimum(np.searchsorted(k2, k1), max(len(k2) - 1, 0))
                same = (k2[pos] == k1) if len(k2) else np.zeros(len(k1), bool)
                n = to - at
                d1, d2 = (k1 >> np.uint64(HASH_BITS)).astype(np.int64), (k2 >> np.uint64(HASH_BITS)).astype(np.int64)
                low = np.bincount(d1[same], np.minimum(w1[same], w2[pos[same]]), n)
                total = np.bincount(d1, w1, n) + np.bincount(d2, w2, n) - low
                ok[at:to] = (low >= similarity * total - 1e-9) & (total > 0)
                at = to
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ok)], names=["a", "b", "ok"])

    joined = (pairs.join(texts.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
              .join(texts.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b").select("a", "b", "ta", "tb"))
    return map_arrow(joined, run, "a long, b long, ok boolean")


def lone_weight(texts: DataFrame, idf: np.ndarray) -> DataFrame:
    """``(rep, lone)``: the weight of each text's shingles that no other text of
    ``texts`` has; texts without any are left out."""
    share = texts.sparkSession.sparkContext.broadcast(idf)

    def run(batches):
        for batch in batches:
            col, ids = batch.column(1), batch.column(0).to_numpy()
            for a, b in slices(col):
                keys, counts = shingle_counts(col.slice(a, b - a))
                doc = (keys >> np.uint64(HASH_BITS)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array((keys & _MASK).view(np.int64)), pa.array(ids[a + doc]),
                     pa.array(weights_of(keys, counts, share.value).astype(np.float64))], names=["f", "rep", "w"])

    rows = map_arrow(texts.select("id", "text"), run, "f long, rep long, w double")
    once = rows.groupBy("f").agg(F.count(F.lit(1)).alias("n"), F.min("rep").alias("rep"), F.min("w").alias("w")).filter("n = 1")
    return once.groupBy("rep").agg(F.sum("w").alias("lone"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
                    bands: int = BANDS, rows: int = ROWS, seed: int = SEED) -> DataFrame:
    """One row per input row: ``id``, ``class_id`` (the smallest id of its class) and
    ``kept`` (it is that one). Classes are the connected components of
    verified links.

    Null, empty and wordless texts and null ids stand alone. A repeated id
    names one document: all its texts are in one class. Texts are used whole;
    other columns are not read. A pair at the threshold 0.8 meets with probability
    1 - (1 - 0.8^3)^8 = 0.997, a closer one more surely.
    """
    spark = docs.sparkSession
    base = docs.select(F.col(id_col).cast("long").alias("id"), text_column(docs, text_col).alias("text"))
    idf, _ = frequencies(base)
    signed = stored(signatures(base, idf, bands, rows, seed))
    live = signed.filter("id is not null and f1 is not null")
    classes = live.groupBy("f1", "f2").agg(F.min("id").alias("rep"), F.min("bands").alias("bands"), F.min("weight").alias("weight"))
    meets = (classes.select("rep", "weight", "bands", F.posexplode("bands").alias("band", "h"))
             .groupBy("rep", "band", "h").agg(F.min("weight").alias("weight"), F.min("bands").alias("bands")))
    crowded = meets.groupBy("band", "h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    meets = stored(meets.join(crowded, ["band", "h"]).select("band", "h", "rep", "weight", "bands", "n"))
    involved = meets.select(F.col("rep").alias("id")).distinct()
    place = scratch_path(spark, "texts")
    # one text per id is enough: equal ids are one class anyway
    base.join(involved, "id").write.parquet(place)
    texts = spark.read.schema("id long, text string").parquet(place)
    # stars: every member of a bucket against the member that meets most others
    popular = meets.groupBy("rep").agg(F.sum("n").alias("met"))
    ranked = meets.join(popular, "rep")
    lead = ranked.groupBy("band", "h").agg(F.min_by("rep", F.struct(-F.col("met"), F.col("rep"))).alias("lead"))
    pairs = (meets.join(lead, ["band", "h"]).filter("rep <> lead")
             .select(F.least("rep", "lead").alias("a"), F.greatest("rep", "lead").alias("b")).distinct())
    links = stored(verified(pairs, texts, idf, similarity).filter("ok").select("a", "b"))
    comp = components(links)
    # buckets whose members are still apart
    tagged = (meets.join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
              .select("band", "h", "rep", "weight", "bands", F.coalesce("component", "rep").alias("c")))
    apart = tagged.groupBy("band", "h").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi")
    tagged = stored(tagged.join(apart.select("band", "h"), ["band", "h"]))
    # two texts share at most what either shares with any other text, which rules most members out
    asked = texts.join(tagged.select(F.col("rep").alias("id")).distinct(), "id")
    least = tagged.groupBy("band", "h").agg(F.min("weight").alias("least"))
    able = (tagged.join(lone_weight(asked, idf), "rep", "left").join(least, ["band", "h"])
            .withColumn("shared", F.col("weight") - F.coalesce("lone", F.lit(0.0)) + 1e-6 * F.col("weight"))
            .filter(F.col("shared") * (1 + similarity) >= similarity * (F.col("weight") + F.col("least"))))
    able = stored(able.select("band", "h", "rep", "c", "weight", "shared", "bands"))
    other = able.select("band", "h", *[F.col(c).alias(f"{c}2") for c in ("rep", "c", "weight", "shared", "bands")])
    # a pair that meets in several bands is taken in the first of them
    first_band = F.array_position(F.zip_with("bands", "bands2", lambda x, y: x == y), True) - 1
    rest = (able.join(other, ["band", "h"])
            .filter((F.col("c") < F.col("c2")) & (F.least("shared", "shared2") * (1 + similarity)
                                                  >= similarity * (F.col("weight") + F.col("weight2")))
                    & (first_band == F.col("band")))
            .select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct())
    more = stored(verified(rest, texts, idf, similarity).filter("ok").select("a", "b"))
    # a repeated id ties the classes of its texts
    tied = live.select("id", "f1", "f2").join(classes.select("f1", "f2", "rep"), ["f1", "f2"])
    tied = (tied.groupBy("id").agg(F.min("rep").alias("a"), F.collect_set("rep").alias("reps"))
            .filter(F.size("reps") > 1).select("a", F.explode("reps").alias("b")))
    comp = components(more.unionByName(comp.select(F.col("id").alias("a"), F.col("component").alias("b"))).unionByName(tied))
    per_class = classes.select("f1", "f2", "rep").join(comp.select(F.col("id").alias("rep"), "component"), "rep", "left")
    per_class = per_class.select("f1", "f2", F.coalesce("component", "rep").alias("class"))
    out = live.select("id", "f1", "f2").join(per_class, ["f1", "f2"]).select("id", "class")
    alone = signed.filter("id is null or f1 is null").select("id", F.col("id").alias("class"))
    return out.unionByName(alone).select(F.col("id").alias(id_col), F.col("class").alias("class_id"),
                                         F.col("id").eqNullSafe(F.col("class")).alias("kept"))


def op8_weighted_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))
