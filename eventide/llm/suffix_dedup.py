"""Removal of repeated byte strings with distributed suffix arrays.

A byte goes when a string of ``length`` bytes that covers it also starts
earlier in the corpus. Equal strings are brought together without sorting every
suffix of the corpus at once:

1. Every window of ``length`` bytes has an anchor, the ``gram``-byte string of
   least hash in it; equal windows have equal anchors. Neighbouring windows with one
   anchor make a stretch. Tasks list their stretches by the hash of the anchor and of
   the stretch, keep the first of equal ones (the others are known to
   repeat) and deal the rest by anchor into buckets.
2. In a bucket, of equal stretches all but the first repeat. An anchor with
   one stretch only is done. The first stretches of the other anchors
   are fetched as bytes.
3. A bucket's stretches are laid end to end and their suffix array is built in
   two stages: the suffixes smaller than their successors are sorted directly, all
   others are induced by one scan over the buckets of first bytes. Adjacent
   common prefixes of at least ``length`` bytes tie equal windows; all but the
   first in the corpus repeat.
4. A document's repeated spans are united and cut out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.llm.common import (INVERSE, ODD, cogrouped_arrow, first_powers, grouped_arrow, map_arrow, mix64, per_process,
                                 powers_at, stored, table, text_column, utf8)
from eventide.llm.weighted_minhash import slices

LENGTH, GRAM = 100, 24
BUCKET_BYTES, SLICE_BYTES, FLUSH_STRETCHES = 8 << 20, 1 << 20, 300_000
#: Windows whose anchors are sought at once; with the bytes of a window less than 2^24 places.
PIECE = 1 << 22
#: An anchor with more different stretches than this is resolved window by window.
CROWD = 20_000


def running_sum(data: np.ndarray) -> np.ndarray:
    """Prefix sums from which any substring's hash follows."""
    value = per_process("byte weights", lambda: mix64(np.arange(1, 257, dtype=np.uint64)))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(value[data] * first_powers(ODD, len(data)), out=total[1:])
    return total


def span_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix64((total[end] - total[start]) * powers_at(INVERSE, start) + (end - start).astype(np.uint64))


def _anchors(h: np.ndarray, windows: int, span: int) -> np.ndarray:
    """The place of the leftmost of the least hashes among the ``span`` from each
    window's start, in pieces of ``PIECE`` windows, as a place has 24 bits."""
    at = np.empty(windows, np.int64)
    for lo in range(0, windows, PIECE):
        hi = min(lo + PIECE, windows)
        # hash above, place in the piece below
        low = h[lo:hi + span - 1] & np.uint64(0xFFFFFFFFFF000000)
        low |= np.arange(len(low), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        if width < span:
            gap = span - width
            low = np.minimum(low[:len(low) - gap], low[gap:])
        at[lo:hi] = (low & np.uint64(0xFFFFFF)).astype(np.int64) + lo
    return at


def stretches(data: np.ndarray, off: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``(start, end, anchor hash, stretch hash)`` of every stretch of the
    texts: bytes ``start`` to ``end`` are the windows that share an anchor."""
    n = len(data)
    none = np.empty(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    total = running_sum(data)
    h = total[gram:] - total[:-gram]
    h *= first_powers(INVERSE, len(h))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    at = _anchors(h, n - length + 1, length - gram + 1)
    # a window must end within its text
    size = np.diff(off)
    inside = np.zeros(n + 1, np.int8)
    long = size >= length
    np.add.at(inside, off[:-1][long], 1)
    np.add.at(inside, off[1:][long] - length + 1, -1)
    inside = np.cumsum(inside[:len(at)]).astype(bool)
    change = np.empty(len(at), bool)
    change[0] = True
    change[1:] = at[1:] != at[:-1]
    text_start = off[:-1][long]
    change[text_start[text_start < len(at)]] = True
    first = np.flatnonzero(change & inside)
    stop = np.flatnonzero(inside & np.append((change | ~inside)[1:], True))
    anchor = at[first]
    return first, stop + length, span_hash(total, anchor, anchor + gram), span_hash(total, first, stop + length)


def _blob(x: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(x, dtype=kind).tobytes()


def _join(column: pa.ChunkedArray, kind) -> np.ndarray:
    """Numbers of all cells of a binary column, one after another."""
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x), kind)


def _doc_ids(column: pa.Array) -> np.ndarray:
    """Ids as numbers, null last."""
    return column.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False).astype(np.int64)


#: A list of stretches or windows: anchor, content hash, document, row, start, end; and spans known to repeat.
LISTED = "bucket long, h binary, c binary, d binary, r binary, a binary, e binary, known binary"
#: Spans of one slab of documents as (row, start, end), and stretches to fetch as (row, start, end, anchor, crowded).
SPANS = "slab long, spans binary, fetch binary"


def _listed_rows(h, c, d, r, a, e, buckets: int, known: list[np.ndarray], home: int):
    """Rows of LISTED, one per bucket. Of equal (h, c) only the first in the
    corpus is listed; the others are known to repeat and go along with ``home``."""
    both = mix64(h * np.uint64(0xD6E8FEB86659FD93) + c)
    order = np.lexsort((a, r, d, both))
    first = np.ones(len(order), bool)
    first[1:] = (h[order][1:] != h[order][:-1]) | (c[order][1:] != c[order][:-1])
    rest = order[~first]
    known = [*known, np.stack([r[rest], a[rest], e[rest]], 1)]
    keep = order[first]
    b = (h[keep] % np.uint64(buckets)).astype(np.int64)
    by = np.argsort(b, kind="stable")
    keep, b = keep[by], b[by]
    at, cuts = np.unique(b, return_index=True)
    cuts = np.append(cuts, len(b))
    rows = [(int(k), _blob(h[x], "u8"), _blob(c[x], "u8"), _blob(d[x], "i8"), _blob(r[x], "i8"), _blob(a[x], "i8"), _blob(e[x], "i8"), None)
            for k, x in zip(at, (keep[i:j] for i, j in zip(cuts[:-1], cuts[1:])))]
    spans = np.concatenate(known)
    if len(spans):
        rows.append((home % buckets, b"", b"", b"", b"", b"", b"", _blob(spans, "i8")))
    return rows


def _batch(rows: list[tuple], names: str) -> pa.RecordBatch:
    fields = [x.split(" ") for x in names.split(", ")]
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array([row[i] for row in rows], kinds[k]) for i, (_, k) in enumerate(fields)],
                                      names=[n for n, _ in fields])


def _list_stretches(docs: DataFrame, buckets: int, length: int, gram: int) -> DataFrame:
    """Step 1 over whole documents; a task's lists are bounded by its share of the
    input and flushed at FLUSH_STRETCHES."""
    def run(batches):
        from pyspark import TaskContext
        home = TaskContext.get().partitionId()
        parts, held = [], 0

        def flush():
            return _batch(_listed_rows(*[np.concatenate(x) for x in zip(*parts)], buckets, [], home), LISTED)

        for batch in batches:
            col, ids, rows = batch.column(2), _doc_ids(batch.column(1)), batch.column(0).to_numpy()
            for x, y in slices(col, SLICE_BYTES):
                data, off = utf8(col.slice(x, y - x))
                a, e, h, c = stretches(data, off, length, gram)
                doc = np.searchsorted(off, a, "right") - 1
                # texts of no bytes share an offset with the next: the last of them starts there
                parts.append((h, c, ids[x + doc], rows[x + doc], a - off[doc], e - off[doc]))
                held += len(h)
            if held > FLUSH_STRETCHES:
                yield flush()
                parts, held = [], 0
        if parts:
            yield flush()

    return map_arrow(docs.select("r", "id", "text"), run, LISTED)


def _slab_rows(slabs: int, spans: np.ndarray, fetch: np.ndarray) -> list[tuple]:
    """Rows of SPANS, one per slab of documents that the spans belong to."""
    def split(x):
        k = _slab_of(x[:, 0], slabs)
        o = np.argsort(k, kind="stable")
        at, cuts = np.unique(k[o], return_index=True)
        return {int(s): x[o[i:j]] for s, i, j in zip(at, cuts, np.append(cuts[1:], len(o)))}
    one, two = split(spans), split(fetch)
    return [(s, _blob(one[s], "i8") if s in one else None, _blob(two[s], "i8") if s in two else None) for s in sorted({*one, *two})]


def _slab_of(r: np.ndarray, slabs: int) -> np.ndarray:
    """The slab of a row: rows of one task go round the slabs."""
    return (r ^ (r >> 33)) % slabs


def slab_of(r: Column, slabs: int) -> Column:
    """:func:`_slab_of` as an expression."""
    return F.pmod(r.bitwiseXOR(F.shiftright(r, 33)), F.lit(slabs)).cast("long")


def _match_stretches(listed: DataFrame, slabs: int, crowd: int) -> DataFrame:
    """Step 2, bucket by bucket."""
    def run(key, t: pa.Table) -> pa.Table:
        h, c, d, r, a, e = (_join(t.column(n), k) for n, k in zip("hcdrae", ("u8", "u8", "i8", "i8", "i8", "i8")))
        o = np.lexsort((a, r, d, c, h))
        h, c, r, a, e = h[o], c[o], r[o], a[o], e[o]
        new_h = np.concatenate([[True], h[1:] != h[:-1]]) if len(h) else np.empty(0, bool)
        first = new_h | np.concatenate([[True], c[1:] != c[:-1]]) if len(h) else new_h
        group = np.cumsum(new_h) - 1
        kinds = np.bincount(group, first).astype(np.int64)[group] if len(h) else np.empty(0, np.int64)
        repeated, ask = ~first, first & (kinds > 1)
        known = _join(t.column("known"), "i8").reshape(-1, 3)
        spans = np.concatenate([known, np.stack([r[repeated], a[repeated], e[repeated]], 1)])
        fetch = np.stack([r[ask], a[ask], e[ask], h[ask].view(np.int64), (kinds[ask] > crowd).astype(np.int64)], 1)
        return pa.Table.from_batches([_batch(_slab_rows(slabs, spans, fetch), SPANS)])

    return grouped_arrow(listed, ["bucket"], run, SPANS)


#: Fetched stretches: anchor, document, row, start, end and bytes; and spans known to repeat.
FETCHED = "bucket long, d binary, r binary, a binary, e binary, bytes binary, known binary"


def _fetch(docs: DataFrame, asked: DataFrame, buckets: int, length: int) -> DataFrame:
    """The bytes of the stretches that step 3 needs, dealt by anchor. Stretches of a
    crowded anchor go window by window, dealt by the window's hash, and of
    equal windows of a slab only the first goes."""
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        fetch = _join(right.column("fetch"), "i8").reshape(-1, 5)
        if not len(fetch) or not left.num_rows:
            return pa.Table.from_batches([_batch([], FETCHED)])
        left = left.combine_chunks()
        data, off = utf8(left.column("text").combine_chunks())
        rows, ids = left.column("r").to_numpy(), _doc_ids(left.column("id").combine_chunks())
        by = np.argsort(rows)
        doc = by[np.searchsorted(rows[by], fetch[:, 0])]
        plain, known = fetch[:, 4] == 0, []
        d, r, a, e = ids[doc], fetch[:, 0], fetch[:, 1], fetch[:, 2]
        bucket = (fetch[:, 3].view(np.uint64) % np.uint64(buckets)).astype(np.int64)
        if not plain.all():
            x = np.flatnonzero(~plain)
            n = e[x] - a[x] - length + 1
            of = np.repeat(x, n)
            start = np.repeat(a[x], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = off[doc[of]] + start
            w = span_hash(running_sum(data), at, at + length)
            o = np.lexsort((start, r[of], d[of], w))
            again = np.concatenate([[False], w[o][1:] == w[o][:-1]])
            # equal hashes are compared byte by byte before anything is called known
            same = np.flatnonzero(again)
            if len(same):
                p, q = at[o[same]], at[o[same - 1]]
                equal = np.ones(len(p), bool)
                for i in range(length):
                    equal &= data[p + i] == data[q + i]
                again[same] = equal
            gone, stay = o[again], o[~again]
            known.append(np.stack([r[of][gone], start[gone], start[gone] + length], 1))
            keep = np.flatnonzero(plain)
            doc = np.concatenate([doc[keep], doc[of[stay]]])
            d, r = np.concatenate([d[keep], d[of[stay]]]), np.concatenate([r[keep], r[of[stay]]])
            a, e = np.concatenate([a[keep], start[stay]]), np.concatenate([e[keep], start[stay] + length])
            bucket = np.concatenate([bucket[keep], (w[stay] % np.uint64(buckets)).astype(np.int64)])
        o = np.argsort(bucket, kind="stable")
        at, cuts = np.unique(bucket[o], return_index=True)
        out = []
        for b, i, j in zip(at, cuts, np.append(cuts[1:], len(o))):
            x = o[i:j]
            n = e[x] - a[x]
            place = np.repeat(off[doc[x]] + a[x] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            out.append((int(b), _blob(d[x], "i8"), _blob(r[x], "i8"), _blob(a[x], "i8"), _blob(e[x], "i8"), data[place].tobytes(), None))
        if known and len(known[0]):
            out.append((key[0].as_py() % buckets, b"", b"", b"", b"", b"", _blob(known[0], "i8")))
        return pa.Table.from_batches([_batch(out, FETCHED)])

    return cogrouped_arrow(docs, asked, "slab", run, FETCHED)


def words_at(data: np.ndarray) -> np.ndarray:
    """The eight bytes from every place on as one number that orders like them."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)]).astype(np.uint64)
    out = padded.copy()
    width = 1
    while width < 8:
        out = (out[:len(out) - width] << np.uint64(8 * width)) | out[width:]
        width *= 2
    return out[:len(data) + 1]


def sort_directly(word: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """Places ``at`` in order of the ``length`` bytes from them on: by eight
    bytes, then ties by the next eight, and so on."""
    at = at[np.argsort(word[at], kind="stable")]
    key = word[at]
    group = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(at) else np.empty(0, np.int64)
    last = len(word) - 1
    for depth in range(8, length, 8):
        size = np.bincount(group) if len(group) else np.empty(0, np.int64)
        tied = np.flatnonzero(size[group] > 1) if len(group) else np.empty(0, np.int64)
        if not len(tied):
            break
        key = word[np.minimum(at[tied] + depth, last)]
        o = np.lexsort((key, group[tied]))
        at[tied] = at[tied][o]
        key, g = key[o], group[tied]
        cut = np.concatenate([[False], (key[1:] != key[:-1]) & (g[1:] == g[:-1])])
        step = np.zeros(len(group), np.int64)
        step[tied] = cut
        group = group + np.cumsum(step)
    return at


def suffix_order(data: np.ndarray, need: np.ndarray, length: int) -> np.ndarray:
    """The suffixes of ``data`` at the places ``need`` in order of their first
    ``length`` bytes, by two-stage sorting. ``need`` must go on to a suffix that
    is smaller than its successor, or to the end.

    Suffixes smaller than their successors are sorted directly. Any
    other stands behind its successor: a scan over the buckets of first bytes,
    from the least, finds each suffix's predecessor in order and appends it to its bucket.
    """
    n = len(data)
    text = data.astype(np.int16)
    sign = np.sign(np.append(text[1:] - text[:-1], -1)).astype(np.int8)
    ahead = np.where(sign != 0, np.arange(n), n)
    ahead = np.minimum.accumulate(ahead[::-1])[::-1]
    smaller = sign[np.minimum(ahead, n - 1)] > 0
    word = words_at(data)
    direct = sort_directly(word, np.flatnonzero(need & smaller), length)
    starts = np.searchsorted(data[direct], np.arange(257))
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    if n and need[n - 1]:
        induced[data[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(256):
        front = np.concatenate(induced[c]) if induced[c] else np.empty(0, np.int64)
        bucket = [front]
        while len(front):
            p = front[front > 0] - 1
            front = p[need[p] & ~smaller[p] & (data[p] == c)]
            bucket.append(front)
        bucket.append(direct[starts[c]:starts[c + 1]])
        whole = np.concatenate(bucket)
        out.append(whole)
        p = whole[whole > 0] - 1
        p = p[need[p] & ~smaller[p] & (data[p] > c)]
        if len(p):
            p = p[np.argsort(data[p], kind="stable")]
            at, cuts = np.unique(data[p], return_index=True)
            for b, i, j in zip(at.tolist(), cuts, np.append(cuts[1:], len(p))):
                induced[b].append(p[i:j])
    return np.concatenate(out)


def adjacent_prefixes(data: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to
    ``length`` bytes, which all must have; 0 for the first. Eight bytes
    are compared at a time."""
    word = words_at(data)
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for i in range(0, length, 8):
        differ = word[order[live] + i] ^ word[order[live - 1] + i]
        same = sum((differ < np.uint64(1 << 8 * k)).astype(np.int64) for k in range(8))
        out[live] = np.minimum(i + same, length)
        live = live[same == 8]
    return out


def repeated_windows(data: np.ndarray, off: np.ndarray, length: int) -> np.ndarray:
    """Places of windows of ``length`` bytes, none across two of the stretches
    that start at ``off``, whose bytes also stand at an earlier window."""
    n = len(data)
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, off[:-1], 1)
    np.add.at(inside, np.maximum(off[1:] - length + 1, off[:-1]), -1)
    window = np.cumsum(inside[:n]) > 0
    # each run of windows needs the suffixes up to the next one that is sorted directly
    text = data.astype(np.int16)
    sign = np.sign(np.append(text[1:] - text[:-1], -1))
    ahead = np.minimum.accumulate(np.where(sign != 0, np.arange(n), n - 1)[::-1])[::-1]
    smaller = sign[ahead] > 0
    stop = np.where(smaller, np.arange(n), n - 1)
    stop = np.minimum.accumulate(stop[::-1])[::-1]
    need = window.copy()
    ends = np.flatnonzero(window & ~np.append(window[1:], False))
    reach = np.zeros(n + 1, np.int64)
    np.add.at(reach, ends, 1)
    np.add.at(reach, stop[ends] + 1, -1)
    need |= np.cumsum(reach[:n]) > 0
    order = suffix_order(data, need, length)
    order = order[window[order]]
    if not len(order):
        return order
    group = np.cumsum(adjacent_prefixes(data, order, length) < length) - 1
    least = np.full(group[-1] + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, order)
    return np.sort(order[order > least[group]])


def _suffix_spans(fetched: DataFrame, slabs: int, length: int) -> DataFrame:
    """Step 3, bucket by bucket."""
    def run(key, t: pa.Table) -> pa.Table:
        d, r, a, e = (_join(t.column(n), "i8") for n in "drae")
        data = np.frombuffer(b"".join(x for x in t.column("bytes").to_pylist() if x), np.uint8)
        spans = [_join(t.column("known"), "i8").reshape(-1, 3)]
        if len(a) > 1:
            # laid end to end in corpus order; a window lies in one stretch only
            o = np.lexsort((a, r, d))
            n = e - a
            begin = np.cumsum(n) - n
            place = np.repeat(begin[o] - (np.cumsum(n[o]) - n[o]), n[o]) + np.arange(n.sum())
            data, r, a, e, n = data[place], r[o], a[o], e[o], n[o]
            off = np.concatenate([[0], np.cumsum(n)])
            at = repeated_windows(data, off, length)
            if len(at):
                of = np.searchsorted(off, at, "right") - 1
                start = at - off[of] + a[of]
                new = np.concatenate([[True], (of[1:] != of[:-1]) | (at[1:] != at[:-1] + 1)])
                end = np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)
                spans.append(np.stack([r[of][new], start[new], start[end] + length], 1))
        return pa.Table.from_batches([_batch(_slab_rows(slabs, np.concatenate(spans), np.empty((0, 5), np.int64)), SPANS)])

    return grouped_arrow(fetched, ["bucket"], run, SPANS)


def _cut(docs: DataFrame, spans: DataFrame, with_text: bool, carry: Sequence[str]) -> DataFrame:
    """Step 4: per document the removed bytes and runs, and the hash or text of
    what is left. A character that a cut tears apart goes from the text."""
    extra = [f"_c{i}" for i in range(len(carry))]
    def run(key, left: pa.Table, right: pa.Table) -> pa.Table:
        left = left.combine_chunks()
        data, off = utf8(left.column("text").combine_chunks())
        s = _join(right.column("spans"), "i8").reshape(-1, 3) if right.num_rows else np.empty((0, 3), np.int64)
        rows = left.column("r").to_numpy()
        by = np.argsort(rows)
        doc = by[np.searchsorted(rows[by], s[:, 0])] if len(s) else np.empty(0, np.int64)
        edge = np.zeros(len(data) + 1, np.int32)
        np.add.at(edge, off[doc] + s[:, 1], 1)
        np.add.at(edge, off[doc] + s[:, 2], -1)
        gone = np.cumsum(edge[:len(data)]) > 0
        start = gone & ~np.concatenate([[False], gone[:-1]]) if len(data) else gone
        first = off[:-1][off[:-1] < len(data)]
        start[first] = gone[first]
        removed, runs = (np.concatenate([[0], np.cumsum(x)])[off] for x in (gone, start))
        left_over = [data[off[i]:off[i + 1]][~gone[off[i]:off[i + 1]]].tobytes() if removed[i + 1] > removed[i]
                     else data[off[i]:off[i + 1]].tobytes() for i in range(len(off) - 1)]
        kept = (pa.array([x.decode("utf-8", "ignore") for x in left_over], pa.string()) if with_text
                else pa.array([hashlib.sha256(x).hexdigest() for x in left_over], pa.string()))
        return pa.Table.from_arrays(
            [left.column("id"), pa.array(np.diff(off)), pa.array(np.diff(removed)), pa.array(np.diff(runs)), kept,
             *[left.column(c) for c in extra]], names=["id", "n_bytes", "n_removed", "n_spans", "kept", *extra])

    schema = "id long, n_bytes long, n_removed long, n_spans long, kept string" + "".join(
        f", {c} {docs.schema[c].dataType.simpleString()}" for c in extra)
    return cogrouped_arrow(docs, spans, "slab", run, schema).withColumnsRenamed(dict(zip(extra, carry)))


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
                    bucket_bytes: int = BUCKET_BYTES, crowd: int = CROWD, with_text: bool = False,
                    carry: Sequence[str] = ()) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)`` per document, and the columns
    ``carry``; ``kept`` is the SHA-256 of the remaining bytes, or with ``with_text``
    the remaining text.

    Null and empty texts have no bytes. Of equal ids the row read first comes first, null
    ids come last. Texts are used whole; no other columns are read. A bucket or slab holds about
    ``bucket_bytes`` of text, so their number grows with the corpus.
    """
    base = docs.select(F.monotonically_increasing_id().alias("r"), F.col(id_col).cast("long").alias("id"),
                       text_column(docs, text_col).alias("text"),
                       *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)])
    total = docs.agg(F.sum(F.octet_length(text_column(docs, text_col)))).first()[0] or 0
    slabs = max(4, -(-total // (bucket_bytes // 2)))
    buckets = max(4, -(-total // bucket_bytes))
    matched = stored(_match_stretches(_list_stretches(base, buckets, length, gram), slabs, crowd))
    asked = matched.agg(F.sum(F.octet_length("fetch"))).first()[0] or 0
    # a request is 40 bytes and stands for about 140 bytes of text
    rounds = max(4, -(-asked * 4 // (bucket_bytes // 4)))
    dealt = base.withColumn("slab", slab_of(F.col("r"), slabs))
    fetched = _fetch(dealt, matched.filter("fetch is not null").select("slab", "fetch"), rounds, length)
    more = _suffix_spans(fetched, slabs, length)
    spans = matched.filter("spans is not null").select("slab", "spans").unionByName(more.select("slab", "spans"))
    return _cut(dealt, spans, with_text, carry)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = without_repeats(table(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.col("kept").alias("kept_sha256"))
