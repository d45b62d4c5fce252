"""Conversation structure repair: the cheapest edits that make the roles of a conversation
read ``system? (user assistant)+``, or leave nothing.

A Viterbi search over four states: nothing kept yet (E), a system turn last (S), a user
turn last (U), an assistant turn last (A); E and A may end. Turns are kept (K), given the other role (R)
or deleted (D), and empty turns are inserted (I). Each state keeps one survivor: the
cheapest edits that lead to it, of equally cheap ones those whose initials come first in ASCII.

Survivors share their beginnings, so they are the leaves of a tree of back pointers in which
every edit counts the edits and survivors that refer to it. An edit that nothing refers
to any more goes, and with it what only it referred to; once all survivors
descend from one edit, that edit is settled, handed on and forgotten. A survivor that can only
end dearer than another goes too, or the empty beginning would stay beside every
other one for ever. Memory is thus the stretch that is still open, not the conversation.

Ties are settled by the whole open stretches of the tied survivors. Their order is
kept from turn to turn: survivors whose edits differ keep the rank that the first difference gave
them, and only where one is the beginning of another the letters after it are kept too.
A tie that each further turn leaves open (turns that fit neither role, one after another)
keeps the stretch open, in memory as well, but costs no second look at it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventide.llm.common import map_arrow, table

SPACES = " \t\n\x0b\x0c\r"
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5      # costs; the last for a truncated turn that stays
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"
EDITS = ("conv_id {id}, step long, edit string, turn long, old_role string, fault string, role string, text string")
DIGEST = ("conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")
OUT_ROWS, OUT_BYTES = 5000, 4 << 20

E, S, U, A = range(4)
USER, ASSISTANT = "user", "assistant"
#: A turn of user or assistant may follow these states, and leads to the second.
_NEXT = {E: (U, USER), S: (U, USER), U: (A, ASSISTANT), A: (U, USER)}
#: What one state's best end may cost more than another's: whoever may still take a system turn
#: deletes it instead (2); after an assistant turn all is allowed that is after a system turn.
_DEARER = ((E, A, DELETE), (S, A, 0))


class _Edit:
    """One edit of the tree, with the edits that follow it and the survivors that end in it."""

    __slots__ = ("before", "after", "ends", "letter", "row", "role", "text")

    def __init__(self, before, letter, row=None, role=None, text=None):
        self.before, self.letter, self.row, self.role, self.text = before, letter, row, role, text
        self.after, self.ends = [], 0
        if before is not None:
            before.after.append(self)


class Repair:
    """The search over one conversation. ``push`` takes its turns one after another and ``end``
    ends it; both give the edits that are settled, as ``(letter, row, role, text)``."""

    def __init__(self):
        self.root = _Edit(None, "")
        self.best = {E: (0, (0, ""), self.root)}     # state: cost, (rank, letters), last edit
        self.root.ends = 1
        self._insert()

    def push(self, row, role: str, text: str, fault: str | None) -> list[tuple]:
        offers: dict[int, tuple] = {}

        def offer(state, cost, order, *edit):
            if state not in offers or (cost, order) < offers[state][:2]:
                offers[state] = (cost, order, edit)

        initial, extra = role[:1], TRUNCATED if fault == CUT else 0
        for state, (cost, (rank, letters), last) in self.best.items():
            offer(state, cost + DELETE, (rank, letters + "D"), last, "D", row, None, None)
            if fault in (BLANK, DUPLICATE):
                continue
            if state == E and initial == "s":
                offer(S, cost + KEEP + extra, (rank, letters + "K"), last, "K", row, role, text)
            to, wanted = _NEXT[state]
            if initial == wanted[0]:
                offer(to, cost + KEEP + extra, (rank, letters + "K"), last, "K", row, role, text)
            else:
                offer(to, cost + REROLE + extra, (rank, letters + "R"), last, "R", row, wanted, text)
        was = [last for _, _, last in self.best.values()]
        self.best = {state: (cost, order, _Edit(*edit)) for state, (cost, order, edit) in offers.items()}
        for _, _, last in self.best.values():
            last.ends += 1
        for last in was:
            self._leave(last)
        self._insert()
        for dear, cheap, more in _DEARER:
            if dear in self.best and cheap in self.best and self.best[cheap][0] + more < self.best[dear][0]:
                self._leave(self.best.pop(dear)[2])
        self._rank()
        return self._settled()

    def end(self) -> list[tuple]:
        for state in (S, U):
            if state in self.best:
                self._leave(self.best.pop(state)[2])
        if len(self.best) > 1:
            worse = max(self.best, key=lambda s: self.best[s][:2])
            self._leave(self.best.pop(worse)[2])
        out = self._settled()
        return out

    def _insert(self) -> None:
        """Empty turns after the last edit, where they make a state cheaper (or as cheap
        with earlier letters). No state gains by more than two of them."""
        for state in (E, S, A, U):
            if state not in self.best:
                continue
            cost, (rank, letters), last = self.best[state]
            to, role = _NEXT[state]
            mine = (cost + INSERT, (rank, letters + "I"))
            if to not in self.best or mine < self.best[to][:2]:
                old = self.best.get(to)
                new = _Edit(last, "I", None, role, "")
                new.ends = 1
                self.best[to] = (*mine, new)
                if old:
                    self._leave(old[2])

    def _leave(self, edit: _Edit) -> None:
        """A survivor leaves ``edit``; it and what came before go as far as nothing else refers to them."""
        edit.ends -= 1
        while not edit.ends and not edit.after and edit is not self.root:
            before = edit.before
            before.after.remove(edit)
            edit.before, edit = None, before

    def _rank(self) -> None:
        """Ranks anew: survivors whose letters differ get ranks of their own, those of which one
        is the beginning of the other share one and keep the letters after that beginning."""
        order = sorted((order, state) for state, (_, order, _) in self.best.items())
        ranks, at = {}, 0
        while at < len(order):
            (rank, start), _ = order[at]
            upto = at
            while upto < len(order) and order[upto][0][0] == rank and order[upto][0][1].startswith(start):
                ranks[order[upto][1]] = (at, order[upto][0][1][len(start):])
                upto += 1
            at = upto
        self.best = {state: (cost, ranks[state], last) for state, (cost, _, last) in self.best.items()}

    def _settled(self) -> list[tuple]:
        out = []
        while not self.root.ends and len(self.root.after) == 1:
            self.root = self.root.after[0]
            self.root.before = None
            out.append((self.root.letter, self.root.row, self.root.role, self.root.text))
        return out


def _repair_rows(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Turns sorted by conversation and place; see ``repair``."""
    out: list[tuple] = []
    size = 0
    now, search, step, none = None, None, 0, object()
    now = none

    def take(edits):
        nonlocal step, size
        for letter, row, role, text in edits:
            turn, old, fault = row or (None, None, None)
            out.append((now, step, letter, turn, old, fault, role, text))
            size += len(text or "")
            step += 1

    def flush():
        nonlocal out, size
        cols = list(zip(*out))
        types = (id_type, pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4)
        names = ("conv_id", "step", "edit", "turn", "old_role", "fault", "role", "text")
        out, size = [], 0
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    for batch in batches:
        for conv, turn, role, text, fault in zip(*[batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "fault")]):
            if search is None or conv != now:
                if search is not None:
                    take(search.end())
                now, search, step = conv, Repair(), 0
            take(search.push((turn, role, fault), role, text, fault))
            if len(out) >= OUT_ROWS or size >= OUT_BYTES:
                yield flush()
    if search is not None:
        take(search.end())
    if out:
        yield flush()


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, fault)``; null role and text are one space. The first
    fault of a turn counts: ``blank`` (only white space), ``duplicate`` (role and text
    are those of an earlier turn of the conversation), ``truncated`` (the last other character is none of ``.!?``).
    Turns of equal number go by role and text."""
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])
    body = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.withColumn("_last", F.right(body, F.lit(1)))
    # all turns of a conversation are in one task from here on: their order and the running hash need that
    rows = rows.repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    fault = (F.when(F.col("_last") == "", F.lit(BLANK)).when(F.row_number().over(same) > 1, F.lit(DUPLICATE))
             .when(~F.col("_last").isin(".", "!", "?"), F.lit(CUT)))
    return rows.select("conv_id", "turn", "role", "text", fault.alias("fault"))


def repair(conversations: DataFrame) -> DataFrame:
    """One row per edit, in order: ``(conv_id, step, edit, turn, old_role, fault, role, text)``.
    ``edit`` is K, R, D or I; ``role`` and ``text`` are those of the repaired turn, null where it
    is deleted; ``turn``, ``old_role`` and ``fault`` are those of the turn edited, null where one is
    inserted. The rows of a task are sorted by conversation and step.

    Null role and text are one space, null turn comes first, null conv_id is a conversation of its own.
    A role counts by its first character; any that is not s, u or a can only be changed or deleted.
    Blank and duplicate turns are always deleted. Very long texts are held while their edit is
    open. Repeated rows are duplicates; other columns are not read; no rows give none. The turns of
    a conversation pass through one task in order, one after another; only the open stretch is held.
    """
    rows = turns_of(conversations).sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
    kind = rows.schema["conv_id"].dataType
    schema = EDITS.format(id=kind.simpleString())
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = to_arrow_type(kind)
    return map_arrow(rows, lambda batches: _repair_rows(batches, arrow), schema)


def _digest_rows(batches: Iterator[pa.RecordBatch], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    now: dict | None = None

    def close():
        gaps = now["high"] - now["low"] + 1 - now["turns"] if now["turns"] else 0
        out.append((now["id"], gaps, now[BLANK], now[DUPLICATE], now[CUT], now["illegal"], now["cost"],
                    "".join(now["audit"]), now["hash"].hexdigest()))

    def flush():
        nonlocal out
        cols = list(zip(*out))
        types = (id_type, *[pa.int64()] * 6, pa.string(), pa.string())
        names = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
        out = []
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names=names)

    for batch in batches:
        names = ("conv_id", "step", "edit", "turn", "old_role", "fault", "role", "text")
        for conv, step, edit, turn, old, fault, role, text in zip(*[batch.column(c).to_pylist() for c in names]):
            if step == 0:
                if now:
                    close()
                    if len(out) >= OUT_ROWS:
                        yield flush()
                now = {"id": conv, "low": None, "high": None, "turns": 0, BLANK: 0, DUPLICATE: 0, CUT: 0, "illegal": 0,
                       "cost": 0, "audit": [], "hash": hashlib.sha256(), "initial": None, "any": False}
            now["audit"].append(edit)
            now["cost"] += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit]
            if edit != "I":
                if fault:
                    now[fault] += 1
                    now["cost"] += TRUNCATED if fault == CUT and edit != "D" else 0
                if turn is not None and turn != now["high"]:
                    now["low"] = turn if now["low"] is None else now["low"]
                    now["high"] = turn
                    now["turns"] += 1
                if now["initial"] is not None and now["initial"] + old[:1] not in ("su", "ua", "au"):
                    now["illegal"] += 1
                now["initial"] = old[:1]
            if edit != "D":
                now["hash"].update((("\n" if now["any"] else "") + f"{role}:{text}").encode())
                now["any"] = True
    if now:
        close()
    if out:
        yield flush()


def digest(edits: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s rows, in whose order the task reads them: faults by kind,
    ``gaps`` (numbers between the lowest and the highest turn that no turn has), ``illegal`` (adjacent turns
    whose initials are not su, ua or au), the cost and initials of the edits, and the SHA-256 of the repaired
    ``role:text`` lines."""
    kind = edits.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type
    arrow = to_arrow_type(kind)
    return map_arrow(edits, lambda batches: _digest_rows(batches, arrow), DIGEST.format(id=kind.simpleString()))


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows of the registered query: by ``crc32("conv_id:turn") % 20`` a turn is dropped (0), emptied (1), loses
    its ``.!?`` (2), comes twice (3) or becomes the user's (4). Nulls are one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn"))) % 20
    rows = conversations.select("conv_id", "turn", space("role").alias("role"), space("text").alias("text"), kind.alias("_kind"))
    rows = rows.filter("_kind <> 0").select(
        "conv_id", "turn", F.when(F.col("_kind") == 4, F.lit(USER)).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, F.lit("")).when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("_kind") == 3, F.lit(2)).otherwise(F.lit(1)))).alias("_copy"))
    return rows.drop("_copy")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    done = digest(repair(damaged(rows)))
    ids = rows.select(F.col("conv_id").alias("_id")).distinct()
    all_ = ids.join(done, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return all_.select(F.col("_id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
                       F.coalesce("audit", F.lit("")).alias("audit"),
                       F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))


#: The search from the last turn backwards: the best edits that lead from each state to the end.
OP11_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END) AS v
    FROM range(256) r(i))),
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
                   lambda x: CAST(ord(x) AS BIGINT)) AS codes FROM conversations),
h AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(list_concat([4294967295], codes),
    lambda x, b: xor(x // 256, tab[1 + xor(x, b) % 256])), 4294967295) % 20 AS kind FROM c, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM h WHERE kind <> 0),
n AS (
  SELECT conv_id, turn, role, text, rtrim(text, E' \t\n\x0b\x0c\r') AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM d),
f AS (
  SELECT *, left(role, 1) AS x, row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) AS k,
    CASE WHEN body = '' THEN 'blank' WHEN seen > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    coalesce(lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) NOT IN ('su', 'ua', 'au'), false) AS wrong FROM n),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
    count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated,
    count(*) FILTER (WHERE wrong) AS illegal, count(*) AS rows FROM f GROUP BY conv_id),
v AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, {'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS e,
    {'c': CAST(10 AS BIGINT), 'a': 'II', 't': ['user:', 'assistant:']} AS s,
    {'c': CAST(5 AS BIGINT), 'a': 'I', 't': ['assistant:']} AS u, {'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])} AS a FROM sums
  UNION ALL
  SELECT conv_id, k,
    list_min([re, {'c': ru.c + 5, 'a': 'I' || ru.a, 't': list_prepend('user:', ru.t)},
      {'c': ra.c + 10, 'a': 'II' || ra.a, 't': list_prepend('user:', list_prepend('assistant:', ra.t))}]),
    list_min([rs, {'c': ru.c + 5, 'a': 'I' || ru.a, 't': list_prepend('user:', ru.t)},
      {'c': ra.c + 10, 'a': 'II' || ra.a, 't': list_prepend('user:', list_prepend('assistant:', ra.t))}]),
    list_min([ru, {'c': ra.c + 5, 'a': 'I' || ra.a, 't': list_prepend('assistant:', ra.t)}]),
    list_min([ra, {'c': ru.c + 5, 'a': 'I' || ru.a, 't': list_prepend('user:', ru.t)}])
  FROM (
    SELECT f.conv_id, f.k,
      list_min([{'c': v.e.c + 2, 'a': 'D' || v.e.a, 't': v.e.t}, CASE
        WHEN fault IN ('blank', 'duplicate') THEN NULL
        WHEN x = 's' AND v.s.c <= v.u.c + 1 THEN {'c': v.s.c + m, 'a': 'K' || v.s.a, 't': list_prepend(role || ':' || text, v.s.t)}
        WHEN x = 'u' THEN {'c': v.u.c + m, 'a': 'K' || v.u.a, 't': list_prepend(role || ':' || text, v.u.t)}
        ELSE {'c': v.u.c + 1 + m, 'a': 'R' || v.u.a, 't': list_prepend('user:' || text, v.u.t)} END]) AS re,
      list_min([{'c': v.s.c + 2, 'a': 'D' || v.s.a, 't': v.s.t}, CASE
        WHEN fault IN ('blank', 'duplicate') THEN NULL
        WHEN x = 'u' THEN {'c': v.u.c + m, 'a': 'K' || v.u.a, 't': list_prepend(role || ':' || text, v.u.t)}
        ELSE {'c': v.u.c + 1 + m, 'a': 'R' || v.u.a, 't': list_prepend('user:' || text, v.u.t)} END]) AS rs,
      list_min([{'c': v.u.c + 2, 'a': 'D' || v.u.a, 't': v.u.t}, CASE
        WHEN fault IN ('blank', 'duplicate') THEN NULL
        WHEN x = 'a' THEN {'c': v.a.c + m, 'a': 'K' || v.a.a, 't': list_prepend(role || ':' || text, v.a.t)}
        ELSE {'c': v.a.c + 1 + m, 'a': 'R' || v.a.a, 't': list_prepend('assistant:' || text, v.a.t)} END]) AS ru,
      list_min([{'c': v.a.c + 2, 'a': 'D' || v.a.a, 't': v.a.t}, CASE
        WHEN fault IN ('blank', 'duplicate') THEN NULL
        WHEN x = 'u' THEN {'c': v.u.c + m, 'a': 'K' || v.u.a, 't': list_prepend(role || ':' || text, v.u.t)}
        ELSE {'c': v.u.c + 1 + m, 'a': 'R' || v.u.a, 't': list_prepend('user:' || text, v.u.t)} END]) AS ra
    FROM v JOIN (SELECT *, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS m FROM f) f
      ON f.conv_id IS NOT DISTINCT FROM v.conv_id AND f.k = v.k + 1))
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(v.e.c, 0) AS cost, coalesce(v.e.a, '') AS audit,
  sha256(coalesce(array_to_string(v.e.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN v ON v.conv_id IS NOT DISTINCT FROM o.conv_id AND v.k = sums.rows
"""
