import random
import zlib

import numpy as np
import pytest

from eventide.llm import packing as P


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def check(rows, texts, tokenizer, length):
    """Every id of every document in exactly one piece; sequences gapless and
    without padding."""
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_seq.setdefault(r["sequence_id"], []).append(r)
    assert set(by_doc) == set(texts)
    for i, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and r["length"] > 0
            at += r["length"]
        assert at == length or at < length and at & (at - 1) == 0


@pytest.mark.parametrize("length,batch", [(2048, 1 << 20), (64, 300)])
def test_pieces_and_sequences(spark, tokenizer, length, batch):
    rng = random.Random(3)
    texts = {i: rng.choice([None, "", "one", "<|endoftext|> x", "word é 中文 " * rng.randint(1, 300), "a" * 3000]) for i in range(60)}
    df = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, length long").repartition(3)
    check(P.pack(df, length=length, batch_tokens=batch).collect(), texts, tokenizer, length)


def test_parts_go_descending_to_the_cheapest_sequence_with_room():
    sizes = np.array([5, 3, 8, 2, 6, 8])
    pieces = P.place(sizes, 8, 1.0, 1.0)
    room, cost = P.capacities(32, 8).tolist(), [0.0] * 4
    parts = sorted(((n, d, 0) for d, n in enumerate(sizes.tolist())), key=lambda x: (-x[0], x[1]))
    want = []
    for n, d, a in parts:
        while n:
            fit = [s for s in range(4) if room[s] >= n]
            s = min(fit, key=lambda s: cost[s]) if fit else max(range(4), key=lambda s: room[s])
            take = min(n, room[s])
            want.append((d, a, take, s, 8 - room[s]))
            room[s] -= take
            cost[s] += take + take * take
            a, n = a + take, n - take
    assert pieces == want and room == [0] * 4


def test_costs_are_balanced():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 600, 3000)
    cost = {}
    for _d, _a, n, s, _o in P.place(sizes, 2048, 1.0, 1 / 2048):
        cost[s] = cost.get(s, 0) + n + n * n / 2048
    full = [cost[s] for s in range(int(sizes.sum()) // 2048)]
    assert max(full) < 1.25 * min(full)


def test_capacities_need_no_padding():
    for n in (0, 1, 7, 64, 100, 129, 4096 + 700):
        room = P.capacities(n, 64)
        assert room.sum() == n and all(x == 64 or x & (x - 1) == 0 for x in room.tolist())


def test_empty_table_and_repeated_rows(spark, tokenizer):
    schema = "doc_id long, text string"
    assert P.pack(spark.createDataFrame([], schema)).count() == 0
    rows = P.pack(spark.createDataFrame([(1, "same"), (1, "same"), (None, "x")], schema).coalesce(1)).collect()
    assert sorted(str(r["doc_id"]) for r in rows if r["start"] == 0) == ["1", "1", "None"]


def test_whole_table(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    check(P.op10_pack(spark, sf).collect(), {r["doc_id"]: r["text"] for r in docs}, tokenizer, 2048)


def test_added_tokens_are_those_of_the_tokenizer_in_its_default_setting(spark, tmp_path):
    import public_tokenizers
    from tokenizers import Tokenizer
    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = {i: t for i, t in enumerate([f"a {end} b", end, f"{end}{end}x", f"  {end}  \n", "<|endoftext|", f"{end[:-1]} |>{end}é", None])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    check(P.op10_pack(spark, str(tmp_path)).collect(), texts, plain, 2048)
