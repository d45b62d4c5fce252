"""Conversation repair against a search from the end and against all edits of short conversations."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from eventide.llm import turn_repair as T

SCHEMA = "conv_id long, turn long, role string, text string"


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def from_the_end(rows):
    """(cost, letters, lines): the best of each state from the last turn backwards."""
    marks = faults(rows)
    step = {"E": ("U", "user"), "S": ("U", "user"), "U": ("A", "assistant"), "A": ("U", "user")}

    def insert(best):
        for _ in range(3):
            for s, (to, role) in step.items():
                if to in best:
                    c, a, t = best[to]
                    best[s] = min(best.get(s, (10**9, "", ())), (c + 5, "I" + a, (f"{role}:",) + t))
        return best

    best = insert({"E": (0, "", ()), "A": (0, "", ())})
    for (_, role, text), mark in zip(reversed(rows), reversed(marks)):
        new = {}
        for s in "ESUA":
            c, a, t = best[s]
            options = [(c + 2, "D" + a, t)]
            if mark not in ("blank", "duplicate"):
                more = 5 if mark == "truncated" else 0
                if s == "E" and role[:1] == "s":
                    c, a, t = best["S"]
                    options.append((c + more, "K" + a, (f"{role}:{text}",) + t))
                to, wanted = step[s]
                c, a, t = best[to]
                if role[:1] == wanted[0]:
                    options.append((c + more, "K" + a, (f"{role}:{text}",) + t))
                options.append((c + 1 + more, "R" + a, (f"{wanted}:{text}",) + t))
            new[s] = min(options)
        best = insert(new)
    return best["E"]


def of_all_edits(rows):
    """The same by trying every sequence of edits with up to two inserts at a place."""
    marks = faults(rows)
    inserts = [()] + [p for n in (1, 2) for p in itertools.product(("user", "assistant"), repeat=n)]

    @lru_cache(None)
    def choices(i):
        _, role, text = rows[i]
        out = [(2, "D", ())]
        if marks[i] not in ("blank", "duplicate"):
            more = 5 if marks[i] == "truncated" else 0
            out += [(more, "K", ((role, text),)), (1 + more, "R", (("user", text),)), (1 + more, "R", (("assistant", text),))]
        return out

    best = None
    for edits in itertools.product(*[choices(i) for i in range(len(rows))]):
        for places in itertools.product(inserts, repeat=len(rows) + 1):
            cost, letters, lines = 5 * sum(map(len, places)), "I" * len(places[0]), [(r, "") for r in places[0]]
            for (c, letter, line), more in zip(edits, places[1:]):
                cost, letters = cost + c, letters + letter + "I" * len(more)
                lines += [*line, *((r, "") for r in more)]
            if re.fullmatch("(s?(ua)+)?", "".join(r[:1] or "-" for r, _ in lines)):
                mine = (cost, letters, tuple(f"{r}:{t}" for r, t in lines))
                best = mine if best is None or mine < best else best
    return best


def search(rows):
    """``Repair`` on rows, with the most edits it ever held."""
    run, edits, most = T.Repair(), [], 0
    for row, mark in zip(rows, faults(rows)):
        edits += run.push((row[0], row[1], mark), row[1], row[2], mark)
        most = max(most, held(run.root))
    edits += run.end()
    cost = sum({"K": 0, "R": 1, "D": 2, "I": 5}[e[0]] + (5 if e[1] and e[1][2] == "truncated" and e[0] != "D" else 0) for e in edits)
    return (cost, "".join(e[0] for e in edits), tuple(f"{e[2]}:{e[3]}" for e in edits if e[0] != "D")), most


def held(root):
    n, todo = 0, [root]
    while todo:
        n += 1
        todo += todo.pop().after
    return n


def conversation(rng, n, roles=("user", "assistant", "system", "user", "assistant", "tool", " ", "")):
    return [(i, rng.choice(roles), rng.choice(["a.", "b!", "c", "", " \n", f"x{i}.", f"y{i}?", f"z{i}"])) for i in range(n)]


def test_like_all_edits():
    rng = random.Random(4)
    for n in (0, 1, 2, 3):
        for _ in range(12 if n == 3 else 40):
            rows = conversation(rng, n)
            assert search(rows)[0] == of_all_edits(rows) == from_the_end(rows), rows


@pytest.mark.parametrize("roles", [("user", "assistant"), ("user",), ("tool",), ("system", "user"), ("assistant",),
                                   ("user", "assistant", "system", "tool", "", "ustad", "a")])
def test_like_search_from_the_end(roles):
    rng = random.Random(len(roles))
    for _ in range(250):
        rows = conversation(rng, rng.randint(0, 14), roles)
        assert search(rows)[0] == from_the_end(rows), rows


def test_ties_over_long_stretches():
    """Turns that fit no role leave "IRRR..." and "RRR...I" equally dear to the end."""
    rows = [(i, "tool", f"t{i}.") for i in range(301)]
    assert search(rows)[0] == from_the_end(rows)
    rows += [(400, "assistant", "done.")]
    assert search(rows)[0] == from_the_end(rows)


def test_edits_are_settled_early():
    rng = random.Random(9)
    rows = [(i, "user" if (i % 2 == 0) ^ (rng.random() < 0.1) else "assistant", f"t{i}" + rng.choice(["", ".", ".", ".", "."])) for i in range(4000)]
    result, most = search(rows)
    assert result == from_the_end(rows) and most < 100
    rows = [(i, "user", " ") for i in range(4000)]       # all deleted: the empty beginning stays the best
    result, most = search(rows)
    assert result == (8000, "D" * 4000, ()) and most < 20


def brute_query(rows):
    """The registered query's rows by hand."""
    convs = {}
    for conv, turn, role, text in rows:
        mine = convs.setdefault(conv, [])
        s = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{s(conv)}:{s(turn)}".encode()) % 20
        role, text = ("user" if kind == 4 else s(role)), ("" if kind == 1 else re.sub("[.!?]", "", s(text)) if kind == 2 else s(text))
        mine += [(turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    out = []
    for conv, mine in convs.items():
        mine.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        marks, turns = faults(mine), {r[0] for r in mine} - {None}
        cost, letters, lines = from_the_end(mine)
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"), marks.count("duplicate"),
                    marks.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(mine)),
                    cost, letters, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0))


def found(df):
    names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=lambda r: (r[0] is not None, r[0] or 0))


def table_of(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS fault", "1 AS _last", "2 AS edit", "3 AS step").repartition(6).write.parquet(
        str(tmp_path / "conversations.parquet"))
    return str(tmp_path)


def test_query_with_odd_rows(spark, tmp_path):
    rng = random.Random(12)
    rows = []
    for conv in [*range(150), None]:
        for turn in [*range(rng.randint(0, 9)), None]:
            if rng.random() < 0.8:
                rows.append((conv, turn, rng.choice(["user", "assistant", "system", "tool", None, ""]),
                             rng.choice(["Yes.", "No!", "cut", None, "", " ", "end. ", "é?\t", f"t{turn}."])))
    rows += [(7, 3, "user", "same.")] * 5 + [(8, 10**12, "user", "long. " * 40000)] + [(990, t, "user", "a.") for t in range(-3, 3)]
    assert found(T.op11_turn_repair(spark, table_of(spark, rows, tmp_path))) == brute_query(rows)


def test_whole_table(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(T.op11_turn_repair(spark, sf)) == brute_query(rows)


def test_no_rows_and_dropped_conversations(spark, tmp_path):
    empty = spark.createDataFrame([], SCHEMA)
    assert T.repair(empty).collect() == [] and T.digest(T.repair(empty)).collect() == []
    gone = [(c, t, "user", "x.") for c in range(200) for t in range(1) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0]
    got = found(T.op11_turn_repair(spark, table_of(spark, gone, tmp_path)))
    assert gone and got == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c, *_ in gone]


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "assistant", "a."), (1, 2, "assistant", "b."), (1, 3, "user", " "), (2, 0, "user", "q?")]
    got = [(r["conv_id"], r["step"], r["edit"], r["role"], r["text"]) for r in T.repair(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got) == [(1, 0, "K", "system", "s."), (1, 1, "R", "user", "a."), (1, 2, "K", "assistant", "b."), (1, 3, "D", None, None),
                           (2, 0, "D", None, None)]
