"""Conversation structure repair: a Viterbi search whose survivors emit their edits where they coalesce."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.llm.common import kept, query, table

SPACES = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States of roles kept so far: nothing, a system turn, a user turn that waits for its answer, a whole exchange.
START, SYSTEM, USER, WHOLE = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: WHOLE, WHOLE: USER}  # where an inserted turn, or one given another role, leads
ROLE = {USER: "user", WHOLE: "assistant"}
BY_INITIAL = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, WHOLE: USER}, "a": {USER: WHOLE}}
MOST_INSERTS = 2  # more would only come back to the same state
#: at most so much more lets a survivor in the first state do what one in the second will do
CATCH_UP = {(WHOLE, START): DELETE, (USER, START): INSERT + DELETE, (WHOLE, SYSTEM): 0, (USER, SYSTEM): INSERT, (START, SYSTEM): 0, (WHOLE, USER): INSERT,
            (START, USER): INSERT, (SYSTEM, USER): INSERT, (USER, WHOLE): INSERT, (START, WHOLE): 0}


def _moves(initial: str, must_go: bool, truncated: bool) -> list[list[tuple[int, int, str]]]:
    """For each state reached: (state left, cost, edits) of one row, inserted turns before it included."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    for start in range(4):
        state, edits = start, ""
        for _ in range(MOST_INSERTS + 1):
            base = INSERT * len(edits)
            ways = [(state, base + DELETE, edits + "D")]
            if not must_go:
                extra = base + (TRUNCATED if truncated else 0)
                ways.append((NEXT[state], extra + REROLE, edits + "R"))
                if state in BY_INITIAL.get(initial, {}):
                    ways.append((BY_INITIAL[initial][state], extra, edits + "K"))
            for to, cost, e in ways:
                if (cost, e) < best.get((start, to), (1 << 60, "")):
                    best[start, to] = cost, e
            state, edits = NEXT[state], edits + "I"
    return [[(p, *best[p, to]) for p in range(4) if (p, to) in best] for to in range(4)]


_MOVES = {(i, g, t): _moves(i, g, t) for i in "sua-" for g in (False, True) for t in (False, True)}


def _extended(relation, x: str, y: str):
    """How two edit strings compare once x and y are appended: -1 or 1 where they differ, else what either has left over."""
    if isinstance(relation, int):
        return relation
    a, b = relation[0] + x, relation[1] + y
    k = 0
    while k < len(a) and k < len(b) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    return (-1 if a < b else 1) if a and b else (a, b)


class _Node:
    """One edit of the backpointer tree; ``held`` counts the survivors that end here."""

    __slots__ = ("edit", "line", "parent", "children", "held")

    def __init__(self, edit: str, line, parent):
        self.edit, self.line, self.parent, self.children, self.held = edit, line, parent, [], 0
        if parent is not None:
            parent.children.append(self)


class Repair:
    """Finds the cheapest edits of one conversation, row by row.

    Each state has one survivor: the cheapest edits that lead there, the ASCII-least of equally cheap ones. Survivors are leaves
    of a tree of edits; a node that no survivor and no child refers to is freed, and what all survivors share is emitted and
    forgotten. Equal costs are decided by the complete edits not yet shared; as all extend what they had, how two survivors
    compare is carried from row to row. A survivor goes where another can surely do the same for less.
    """

    def __init__(self) -> None:
        self.root = self.base = _Node("", None, None)
        self.base.held = 1
        self.tips: dict[int, tuple[int, _Node]] = {START: (0, self.base)}
        self.relation: dict[tuple[int, int], object] = {}
        self.audit: list[str] = []
        self.sha, self.lines, self.cost, self.most_pending, self.pending = hashlib.sha256(), 0, 0, 0, 0

    def _compare(self, p: int, q: int, x: str, y: str):
        return _extended(("", "") if p == q else self.relation[p, q], x, y)

    def _best(self, ways: list[tuple[int, int, str]]) -> tuple[int, int, str] | None:
        """(state left, total cost, edits) of the cheapest, then ASCII-least, way."""
        best = None
        for p, cost, edits in ways:
            if p not in self.tips:
                continue
            total = self.tips[p][0] + cost
            if best is None or total < best[1] or (total == best[1] and self._compare(p, best[0], edits, best[2]) == -1):
                best = p, total, edits
        return best

    def _grown(self, p: int, edits: str, role: str, text: str) -> _Node:
        node, state = self.tips[p][1], p
        for e in edits:
            if e == "D":
                line = None
            elif e == "K":
                state, line = BY_INITIAL[role[:1]][state], (role, text)
            else:
                state = NEXT[state]
                line = (ROLE[state], "" if e == "I" else text)
            node = _Node(e, line, node)
            self.pending += 1
        return node

    def _release(self, node: _Node) -> None:
        node.held -= 1
        while node is not self.base and not node.held and not node.children:
            parent = node.parent
            parent.children.remove(node)
            node.parent = None
            self.pending -= 1
            node = parent

    def _emit(self, node: _Node) -> None:
        self.audit.append(node.edit)
        if node.line is not None:
            self.sha.update((("\n" if self.lines else "") + node.line[0] + ":" + node.line[1]).encode())
            self.lines += 1

    def _advance(self, survivors: dict[int, tuple[int, int, str]], role: str, text: str) -> None:
        grown = {to: (cost, self._grown(p, edits, role, text)) for to, (p, cost, edits) in survivors.items()}
        self.relation = {(s, t): self._compare(survivors[s][0], survivors[t][0], survivors[s][2], survivors[t][2])
                         for s in survivors for t in survivors if s != t}
        for _, node in grown.values():
            node.held += 1
        old, self.tips = self.tips, grown
        for _, node in old.values():
            self._release(node)
        for (q, p), more in CATCH_UP.items():
            if p in self.tips and q in self.tips:
                gap = self.tips[p][0] - self.tips[q][0] - more
                if gap > 0 or (gap == 0 and more == 0 and self.relation[q, p] == -1):
                    self._release(self.tips.pop(p)[1])
        self.most_pending = max(self.most_pending, self.pending)
        while len(self.base.children) == 1 and not self.base.held:
            child = self.base.children[0]
            self._emit(child)
            child.parent, self.base = None, child
            self.pending -= 1

    def row(self, role: str, text: str, must_go: bool, truncated: bool) -> None:
        initial = role[:1] if role[:1] in ("s", "u", "a") else "-"
        survivors = {}
        for to, ways in enumerate(_MOVES[initial, must_go, truncated]):
            best = self._best(ways)
            if best is not None:
                survivors[to] = best
        self._advance(survivors, role, text)

    def finish(self) -> tuple[int, str, str]:
        """Cost, edits and digest of the whole; turns may be inserted at the end."""
        ways, to = [], {}
        for p in self.tips:
            state, edits = p, ""
            for _ in range(MOST_INSERTS + 1):
                if state in (START, WHOLE):
                    ways.append((p, INSERT * len(edits), edits))
                    break
                state, edits = NEXT[state], edits + "I"
        best = self._best(ways)
        self._advance({WHOLE: best}, "", "")
        while self.base.children:  # one survivor is left
            child = self.base.children[0]
            self._emit(child)
            self.base = child
        return best[1], "".join(self.audit), self.sha.hexdigest()


def repaired(role_texts: list[tuple[str, str]]) -> dict:
    """The columns of ``repair`` for one conversation given as (role, text) in order, turns aside."""
    c = _Conversation()
    seen = set()
    for role, text in role_texts:
        c.add(None, role, text, (role, text) not in seen)
        seen.add((role, text))
    return c.result()


class _Conversation:
    def __init__(self) -> None:
        self.repair, self.rows, self.last_role = Repair(), 0, None
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal = 0
        self.low = self.high = None
        self.turns = 0

    def add(self, turn: int | None, role: str, text: str, first: bool) -> None:
        end = text.rstrip(SPACES)
        fault = "blank" if not end else "duplicate" if not first else "truncated" if end[-1] not in ".!?" else None
        if fault:
            self.faults[fault] += 1
        if self.rows and self.last_role + role[:1] not in ("su", "ua", "au"):
            self.illegal += 1
        if turn is not None:
            if turn != self.high:
                self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows, self.last_role = self.rows + 1, role[:1]
        self.repair.row(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> dict:
        cost, audit, digest = self.repair.finish()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return {"gaps": gaps, **self.faults, "illegal": self.illegal, "cost": cost, "audit": audit, "repaired_sha256": digest,
                "most_pending": self.repair.most_pending}


def damaged(conversations: DataFrame, parts: int = 20) -> DataFrame:
    """``conv_id, turn, role, text`` with planted faults, by the crc32 of ``conv_id:turn`` (null: one space) modulo ``parts``.

    0 drops a row, 1 empties its text, 2 removes its sentence ends, 3 repeats it, 4 makes it a user's. Null roles and texts are one
    space.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % parts
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace(spaced("text"), "[.!?]", "")).otherwise(spaced("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(spaced("role"))
    return (conversations.select("conv_id", "turn", "role", "text", kind.alias("_kind")).where("_kind <> 0")
            .withColumn("_copy", F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", role.alias("role"), text.alias("text")))


def repair(rows: DataFrame, every: DataFrame | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256, most_pending`` of each conversation.

    ``rows`` has ``conv_id, turn, role, text`` (other columns play no part); ``every`` has further ``conv_id`` values, which
    get a row even without turns. Rows go by turn, nulls first, then role, then the text's digest; repeated rows are turns of
    their own. Null roles and texts are one space, a null ``conv_id`` is a conversation like any other. A conversation
    without rows has zeros, an empty audit and the digest of the empty string; an empty table gives no rows.

    Faults: blank, duplicate (role and text seen earlier), truncated (no sentence end); the first that holds counts. Edits
    cost: keep 0, another role 3, delete 4, insert an empty turn 3, and 3 for a truncated row that stays. The roles that
    remain are an optional system turn and exchanges of user and assistant, or none.

    First occurrences are found by a grouping on digests and sent along as rows, so texts move once. A conversation
    is streamed through one task, sorted by Spark, for its digest is one sequence; a task holds a batch and the edits its
    survivors do not yet share (``most_pending`` at most), not the conversation.
    """
    def spaced(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    conv_type = rows.schema["conv_id"].dataType
    base = kept(rows.select(F.col("conv_id").cast("string").alias("conv_id"), F.col("turn").cast("long").alias("turn"), spaced("role").alias("role"),
                            spaced("text").alias("text"), F.monotonically_increasing_id().alias("uid")), "turns")
    keyed = base.withColumn("key", F.md5("text"))
    firsts = keyed.groupBy("conv_id", "role", "key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("some"), "turn", "uid")).alias("at")).select(
        "conv_id", F.col("at.turn").alias("turn"), "role", "key", F.col("at.uid").alias("uid"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("text"))
    stream = keyed.select("conv_id", "turn", "role", "key", "uid", F.lit(2).alias("kind"), "text").unionByName(firsts)
    known = base.select("conv_id") if every is None else base.select("conv_id").unionByName(every.select(F.col("conv_id").cast("string").alias("conv_id")))
    marks = known.groupBy("conv_id").agg(F.lit(0).alias("kind")).select(
        "conv_id", F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.lit("").alias("key"), F.lit(-1).cast("long").alias("uid"), "kind",
        F.lit(None).cast("string").alias("text"))
    order = [F.col("conv_id").asc_nulls_first(), (F.col("kind") > 0).asc(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("key"), F.col("uid"), F.col("kind")]
    ordered = stream.unionByName(marks).repartition("conv_id").sortWithinPartitions(*order).select(
        "conv_id", F.col("turn").cast("string").alias("turn"), "role", F.col("uid").alias("uid"), "kind", "text")

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, first, open_ = None, None, False
        conversation = None
        for pdf in batches:
            done = []
            for conv, turn, role, uid, kind, text in zip(*(pdf[c].tolist() for c in ("conv_id", "turn", "role", "uid", "kind", "text")), strict=True):
                if kind == 0:
                    if open_:
                        done.append({"conv_id": current, **conversation.result()})
                    current, conversation, open_ = conv, _Conversation(), True
                elif kind == 1:
                    first = uid
                else:
                    conversation.add(None if turn is None else int(turn), role, text, first == uid)
            if done:
                yield pd.DataFrame(done)
        if open_:
            yield pd.DataFrame([{"conv_id": current, **conversation.result()}])

    out = ordered.mapInPandas(walk, "conv_id string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
                                    "repaired_sha256 string, most_pending bigint")
    return out.withColumn("conv_id", F.col("conv_id").cast(conv_type))


OP13_SQL = r"""
WITH RECURSIVE bits AS (SELECT range AS v, CAST(range AS BIGINT) AS c, 0 AS k FROM range(256)
  UNION ALL SELECT v, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY v) AS t FROM bits WHERE k = 8),
c AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
d AS (
  SELECT c.*, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(name, ''), lambda s: CAST(ascii(s) AS BIGINT))),
           lambda h, x: xor(h // 256, t[xor(h, x) % 256 + 1]))) % 20 AS kind
  FROM c CROSS JOIN crc),
e AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM d CROSS JOIN (SELECT unnest([0, 1]) AS copy) WHERE kind <> 0 AND (kind = 3 OR copy = 0)),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i FROM e),
f AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS is_again,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS is_cut,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair FROM o),
r AS (SELECT *, is_blank OR is_again AS must_go, is_cut AND NOT is_blank AND NOT is_again AS cut FROM f),
ins AS (SELECT * FROM (VALUES
  (0, 0, '', CAST([] AS VARCHAR[])), (0, 2, 'I', ['user:']), (0, 3, 'II', ['user:', 'assistant:']), (1, 1, '', []), (1, 2, 'I', ['user:']),
  (1, 3, 'II', ['user:', 'assistant:']), (2, 2, '', []), (2, 3, 'I', ['assistant:']), (2, 2, 'II', ['assistant:', 'user:']), (3, 3, '', []),
  (3, 2, 'I', ['user:']), (3, 3, 'II', ['user:', 'assistant:'])) AS t(a, b, ie, il)),
op AS (SELECT * FROM (VALUES (0, 0, 'D', NULL, NULL), (1, 1, 'D', NULL, NULL), (2, 2, 'D', NULL, NULL), (3, 3, 'D', NULL, NULL),
  (0, 2, 'R', NULL, 'user'), (1, 2, 'R', NULL, 'user'), (2, 3, 'R', NULL, 'assistant'), (3, 2, 'R', NULL, 'user'),
  (0, 1, 'K', 's', NULL), (0, 2, 'K', 'u', NULL), (1, 2, 'K', 'u', NULL), (3, 2, 'K', 'u', NULL), (2, 3, 'K', 'a', NULL)) AS t(b, z, oe, initial, new_role)),
move AS (SELECT * FROM ins JOIN op USING (b)),
w AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, 0 AS state, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS v FROM conversations
  UNION ALL
  SELECT w.conv_id, w.i + 1, m.z, min({
    'cost': w.v.cost + 3 * len(m.ie) + CASE m.oe WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN r.cut AND m.oe <> 'D' THEN 3 ELSE 0 END,
    'audit': w.v.audit || m.ie || m.oe,
    'lines': list_concat(list_concat(w.v.lines, m.il), CASE m.oe WHEN 'D' THEN [] WHEN 'R' THEN [m.new_role || ':' || r.text] ELSE [r.role || ':' || r.text] END)})
  FROM w JOIN r ON w.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = w.i + 1 JOIN move AS m ON m.a = w.state
  WHERE (m.oe = 'D' OR NOT r.must_go) AND (m.oe <> 'K' OR m.initial = left(r.role, 1))
  GROUP BY w.conv_id, w.i + 1, m.z),
n AS (SELECT conv_id, max(i) AS i FROM w GROUP BY conv_id),
g AS (
  SELECT w.conv_id, min({'cost': w.v.cost + 3 * len(ins.ie), 'audit': w.v.audit || ins.ie, 'lines': list_concat(w.v.lines, ins.il)}) AS v
  FROM w JOIN n ON w.conv_id IS NOT DISTINCT FROM n.conv_id AND w.i = n.i JOIN ins ON ins.a = w.state WHERE ins.b IN (0, 3) GROUP BY w.conv_id),
s AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, sum(CAST(is_blank AS INT)) AS blank,
         sum(CAST(is_again AND NOT is_blank AS INT)) AS duplicate, sum(CAST(cut AS INT)) AS truncated,
         sum(CASE WHEN pair NOT IN ('su', 'ua', 'au') THEN 1 ELSE 0 END) AS illegal FROM r GROUP BY conv_id)
SELECT g.conv_id, CAST(coalesce(s.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(s.blank, 0) AS BIGINT) AS blank, CAST(coalesce(s.duplicate, 0) AS BIGINT) AS duplicate,
       CAST(coalesce(s.truncated, 0) AS BIGINT) AS truncated, CAST(coalesce(s.illegal, 0) AS BIGINT) AS illegal, CAST(g.v.cost AS BIGINT) AS cost, g.v.audit AS audit,
       sha256(array_to_string(g.v.lines, chr(10))) AS repaired_sha256
FROM g LEFT JOIN s ON g.conv_id IS NOT DISTINCT FROM s.conv_id
"""


@query("op13_survivor_repair", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair(damaged(conversations), conversations.select("conv_id")).drop("most_pending")
