"""Conversation structure repair by aligning turns to an alternating grammar.

Method.  A well-formed conversation has the role initials ``(s?(ua)+)?``.  The
turns are aligned to each feasible length of that grammar string by
Wagner-Fischer tables: keep a turn (0), give it another role (2), delete it
(3), insert an empty one (2); a truncated turn that stays costs 1 more, blank
and repeated turns must go.  A length is feasible while the turns it must
delete or insert cost no more than the incumbent (the least cost so far), and
its table is filled only in the Ukkonen band that the incumbent allows.  Of
every length that reaches the least cost the audit (the edits' initials) is
traced back, and the ASCII-least of them is kept.

Scale.  Only digests and flags of the turns are sorted for the alignment; the
texts are moved once, to be hashed in order.  Both passes stream: a
conversation is read as sorted rows and never held as a group.  What is
remembered of it is a few bytes a turn, as the audit that has to be
returned.  Turns are aligned in segments of ``SEGMENT``: for each state of the
grammar before and after it, a segment has its least cost and audit, and the
segments' tables join exactly (a segment ends with an edit that takes a turn,
so no audit is the beginning of another).  A conversation of any length thus
costs time in proportion to its turns.  Repeated turns are found by a
window over digests, which spills.

Defined cases: a null role or text counts as one space; a null conv_id is a
conversation; turns of one number are ordered by role, then by digest; null
turns come first; repeated rows are duplicates; a conversation without turns has
an empty audit; an empty table gives an empty result; extra columns are
ignored by ``repair`` and pass through ``damage``.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chaintally.llm.common import stage, table

REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
SEGMENT = 16
# States of the grammar: nothing yet, after s, after u, after a.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (NOTHING, AFTER_A)
NAMES = {"u": "user", "a": "assistant"}
LEGAL = ("su", "ua", "au")
FAR = 1 << 60

# A turn as the alignment sees it: its role's initial, whether it must go, whether it is truncated.
Turn = tuple[str, bool, bool]


def target(state: int, with_s: bool, length: int) -> str:
    """The grammar string of ``length`` that follows a state."""
    first, then = ("s", "ua") if with_s else ("", "au" if state == AFTER_U else "ua")
    return (first + then * (length // 2 + 1))[:length]


def state_after(state: int, goal: str) -> int:
    return {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[goal[-1]] if goal else state


def align(turns: tuple[Turn, ...], goal: str, most: int, last: bool) -> tuple[int, str]:
    """Least cost of turning ``turns`` into ``goal``, and its ASCII-least audit; (FAR, "") if above ``most``.

    One Wagner-Fischer table, from the ends of both: cell (i, j) is the cost of the turns from i and the goal from
    j on.  ``last``: insertions may stand after the last turn.
    """
    n, m = len(turns), len(goal)
    # a path off this band deletes or inserts more than ``most`` allows
    over, under = max(0, n - m), max(0, m - n)
    slack = max(0, (most - DELETE * over - INSERT * under) // (DELETE + INSERT))
    down, up = slack + over, slack + under
    rows: list[dict[int, int]] = [{} for _ in range(n + 1)]
    rows[n] = {j: INSERT * (m - j) if goal[j:j + 1] != "s" else FAR for j in range(max(0, n - down), m + 1) if last or j == m}
    for i in range(n - 1, -1, -1):
        initial, goes, cut = turns[i]
        here, below = rows[i], rows[i + 1]
        for j in range(min(m, i + up), max(0, i - down) - 1, -1):
            best = below.get(j, FAR) + DELETE
            if j < m:
                if not goes:
                    if goal[j] == initial:
                        best = min(best, below.get(j + 1, FAR) + CUT * cut)
                    elif goal[j] != "s":
                        best = min(best, below.get(j + 1, FAR) + REROLE + CUT * cut)
                if goal[j] != "s":
                    best = min(best, here.get(j + 1, FAR) + INSERT)
            here[j] = best
    cost = rows[0].get(0, FAR)
    if cost > most or cost >= FAR:
        return FAR, ""
    audit, i, j = [], 0, 0
    while i < n or j < m:
        left = rows[i][j]
        if i < n and rows[i + 1].get(j, FAR) + DELETE == left:
            audit.append("D")
            i += 1
        elif j < m and goal[j] != "s" and rows[i].get(j + 1, FAR) + INSERT == left:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if goal[j] == turns[i][0] else "R")
            i, j = i + 1, j + 1
    return cost, "".join(audit)


@lru_cache(maxsize=1 << 12)
def best_paths(turns: tuple[Turn, ...], state: int, last: bool) -> dict[int, tuple[int, str]]:
    """For each state after the turns: the least cost from ``state`` and its ASCII-least audit.

    Of the last segment only the states in which a conversation may end count.
    """
    found: dict[int, tuple[int, str]] = {}
    must_go = sum(t[1] for t in turns)
    stay = len(turns) - must_go
    # the goals by falling promise: the lengths nearest to the turns that may stay come first
    goals = [(with_s, length) for length in range(2 * len(turns) + 4) for with_s in ((False, True) if state == NOTHING else (False,))
             if length or not with_s]
    goals.sort(key=lambda g: (abs(g[1] - stay), g[1], g[0]))
    for with_s, length in goals:
        goal = target(state, with_s, length)
        end = state_after(state, goal)
        if last and end not in ENDS:
            continue
        least = DELETE * must_go + (DELETE * (stay - length) if length < stay else INSERT * (length - stay))
        # one incumbent for the end of a conversation, one for each state within it
        key = AFTER_A if last else end
        incumbent = found.get(key, (DELETE * len(turns) + INSERT * length, ""))[0]
        if least > incumbent:
            continue
        cost, audit = align(turns, goal, incumbent, last)
        if cost < FAR and (key not in found or (cost, audit) < found[key]):
            found[key] = (cost, audit)
    return found


class Repair:
    """Aligns the turns of one conversation as they come."""

    def __init__(self) -> None:
        self.turns: list[Turn] = []
        self.tables: list[dict[int, dict[int, tuple[int, str]]]] = []

    def add(self, turn: Turn) -> None:
        if len(self.turns) == SEGMENT:
            self._close(False)
        self.turns.append(turn)

    def _close(self, last: bool) -> None:
        before = range(4) if self.tables else (NOTHING,)
        turns = tuple(self.turns)
        self.tables.append({s: best_paths(turns, s, last) for s in before})
        self.turns = []

    def end(self) -> tuple[int, str]:
        """Least cost and ASCII-least audit of the whole conversation."""
        self._close(True)
        # cost from each state before a segment to the end
        left = [{} for _ in self.tables] + [{AFTER_A: 0}]
        for k in range(len(self.tables) - 1, -1, -1):
            for state, paths in self.tables[k].items():
                left[k][state] = min((cost + left[k + 1].get(after, FAR) for after, (cost, _) in paths.items()), default=FAR)
        state, audit = NOTHING, []
        for k, of_state in enumerate(self.tables):
            text, state = min((text, after) for after, (cost, text) in of_state[state].items()
                              if cost + left[k + 1].get(after, FAR) == left[k][state])
            audit.append(text)
        return left[0][NOTHING], "".join(audit)


def damage(conversations: DataFrame) -> DataFrame:
    """The rows damaged by crc32 of ``conv_id:turn``: dropped (kept with ``gone``), emptied, cut, repeated, given another role."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return (conversations
            .withColumn("text", F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text))
            .withColumn("role", F.when(kind == 4, F.lit("user")).otherwise(role))
            .withColumn("gone", kind == 0)
            .withColumn("gone", F.explode(F.when(kind == 3, F.array("gone", "gone")).otherwise(F.array("gone")))))


_ORDER = ("turn", "role", "digest")
# Characters that are no ASCII white space (fixed value of the contract).
_SOLID = r"[^\x20\x09-\x0D]"


def with_faults(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, digest, gone, nth of its like, fault (blank, duplicate, truncated, none) of every row."""
    blank, cut = ~F.rlike("text", F.lit(_SOLID)), ~F.rlike("text", F.lit(r"[.!?][\x20\x09-\x0D]*\z"))
    slim = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", _digest().alias("digest"), "gone",
                       blank.alias("blank"), cut.alias("cut"))
    alike = Window.partitionBy("conv_id", "gone", "role", "digest").orderBy(F.col("turn").asc_nulls_first())
    return slim.withColumn("nth", F.row_number().over(alike)).withColumn(
        "fault", F.when(F.col("blank"), "blank").when(F.col("nth") > 1, "duplicate")
        .when(F.col("cut"), "truncated").otherwise("none")).drop("blank", "cut")


def _digest():
    return F.unhex(F.md5(F.col("text").cast("binary")))


def _streams(rows: DataFrame, *order: str) -> DataFrame:
    """Rows dealt by conversation and sorted in each task."""
    return rows.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order])


class _Report:
    """The figures of one conversation, row by row."""

    def __init__(self) -> None:
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "none": 0}
        self.illegal = self.turns = 0
        self.first = self.last = None
        self.before: str | None = None
        self.repair = Repair()

    def add(self, turn: int | None, role: str, fault: str) -> None:
        initial = role[:1]
        self.counts[fault] += 1
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last = turn
            self.turns += 1
        self.repair.add((initial, fault in ("blank", "duplicate"), fault == "truncated"))

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        cost, audit = self.repair.end()
        return gaps, self.counts["blank"], self.counts["duplicate"], self.counts["truncated"], self.illegal, cost, audit


AUDIT = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def audits(faulty: DataFrame) -> DataFrame:
    """One row per conversation: its counts, least cost and audit, from rows with faults."""
    id_type = faulty.schema["conv_id"].dataType
    schema = AUDIT.format(id=id_type.simpleString())
    names = [f.split()[0] for f in schema.split(", ")]
    dealt = _streams(faulty, "gone", *_ORDER, "nth").select("conv_id", "turn", "role", "fault", "gone")

    def run(batches):
        report, now, begun, kind = _Report(), None, False, None
        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            for conv, turn, role, fault, gone in zip(*(c.to_pylist() for c in batch.columns)):
                if begun and conv != now:
                    done.append((now, *report.row()))
                    report = _Report()
                now, begun = conv, True
                if not gone:
                    report.add(turn, role, fault)
            if done:
                yield _batch(done, names, kind)
        if begun:
            yield _batch([(now, *report.row())], names, kind)

    return dealt.mapInArrow(run, schema)


def _batch(rows: list[tuple], names: list[str], id_type: pa.DataType) -> pa.RecordBatch:
    arrays = [pa.array([r[0] for r in rows], type=id_type)]
    for k in range(1, len(names)):
        arrays.append(pa.array([r[k] for r in rows], type=pa.string() if names[k] in ("audit", "repaired_sha256") else pa.int64()))
    return pa.RecordBatch.from_arrays(arrays, names=names)


class Repaired:
    """Follows an audit over the turns of a conversation: the repaired rows, one by one."""

    def __init__(self, audit: str):
        self.audit, self.at, self.state = audit, 0, NOTHING

    def _emit(self, role: str | None, text: str) -> tuple[str, str]:
        if role is None:
            role = NAMES["a" if self.state == AFTER_U else "u"]
        self.state = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}[role[:1]]
        return role, text

    def inserted(self):
        while self.audit.startswith("I", self.at):
            self.at += 1
            yield self._emit(None, "")

    def turn(self, role: str, text: str):
        """The rows that come of the next turn: those inserted before it, then it as it stays."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != "D":
            yield self._emit(role if edit == "K" else None, text)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of damaged ``rows``: counts, cost, audit, and the hash of the repaired turns."""
    found = stage(audits(with_faults(rows)), "repair-audits")
    counts = [c for c in found.columns if c != "conv_id"]
    schema = T.StructType([*found.schema, T.StructField("repaired_sha256", T.StringType())])
    # the audit of a conversation comes first, then its turns
    heads = found.select("conv_id", F.lit(None).cast("long").alias("turn"), F.lit(None).cast("string").alias("role"),
                         F.lit(None).cast("binary").alias("digest"), F.lit(None).cast("string").alias("text"), F.struct(*counts).alias("head"))
    texts = rows.where(~F.col("gone")).select(
        "conv_id", F.col("turn").cast("long").alias("turn"), "role", _digest().alias("digest"), "text",
        F.lit(None).cast(heads.schema["head"].dataType).alias("head"))
    both = heads.withColumn("body", F.lit(0)).unionByName(texts.withColumn("body", F.lit(1)))
    dealt = _streams(both, "body", *_ORDER).select("conv_id", "role", "text", "head")
    names = schema.names

    def run(batches):
        conv = head = after = digest = None
        first = True

        def put(made):
            nonlocal first
            for role, text in made:
                digest.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False

        def closed():
            put(after.inserted())
            return (conv, *(head[c] for c in counts), digest.hexdigest())

        kind = None
        for batch in batches:
            done, kind = [], batch.schema.field(0).type
            for c, role, text, own in zip(*(x.to_pylist() for x in batch.columns)):
                if own is not None:
                    if head is not None:
                        done.append(closed())
                    conv, head, after, digest, first = c, own, Repaired(own["audit"]), hashlib.sha256(), True
                else:
                    put(after.turn(role, text))
            if done:
                yield _batch(done, names, kind)
        if head is not None:
            yield _batch([closed()], names, kind)

    return dealt.mapInArrow(run, schema)


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair(damage(table(spark, sf_dir, "conversations")))


OP12_SQL = r"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
  FROM conversations),
c AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(key, ''), lambda x: CAST(unicode(x) AS BIGINT))),
                lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))),
                4294967295::BIGINT) % 20 AS kind
  FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END))
  FROM c WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM d),
f AS (
  SELECT *, left(role, 1) AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), nth) AS pos
  FROM o),
g AS (
  SELECT *, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
         NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) AS before
  FROM f),
h AS (SELECT *, blank OR nth > 1 AS goes, NOT blank AND nth = 1 AND cut AS truncated FROM g),
n AS (SELECT conv_id, max(pos) AS n FROM h GROUP BY conv_id),
moves(state, initial, name, after) AS (
  VALUES ('E', 's', NULL, 'S'), ('E', 'u', 'user', 'U'), ('S', 'u', 'user', 'U'), ('U', 'a', 'assistant', 'A'), ('A', 'u', 'user', 'U')),
inserts AS (
  SELECT state, state AS after, 0 AS cost, '' AS edits, CAST([] AS VARCHAR[]) AS made FROM (VALUES ('E'), ('S'), ('U'), ('A')) t(state)
  UNION ALL SELECT state, after, 2, 'I', [name || ':'] FROM moves WHERE name IS NOT NULL
  UNION ALL SELECT a.state, b.after, 4, 'II', [a.name || ':', b.name || ':']
  FROM moves a JOIN moves b ON b.state = a.after WHERE a.name IS NOT NULL AND b.name IS NOT NULL),
walk(conv_id, pos, state, cost, audit, made) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 'E', CAST(0 AS BIGINT), '', CAST([] AS VARCHAR[]) FROM n
  UNION ALL
  SELECT conv_id, pos, state, min(cost), arg_min(audit, (cost, audit)), arg_min(made, (cost, audit))
  FROM (
    SELECT w.conv_id, h.pos, m.after AS state, w.cost + m.cost AS cost, w.audit || m.edits AS audit, list_concat(w.made, m.made) AS made
    FROM walk w JOIN h ON h.conv_id IS NOT DISTINCT FROM w.conv_id AND h.pos = w.pos + 1,
    LATERAL (
      -- up to two turns inserted before the row, then the row deleted, kept or given another role
      SELECT i.after, i.cost + 3 AS cost, i.edits || 'D' AS edits, i.made AS made FROM inserts i WHERE i.state = w.state
      UNION ALL
      SELECT v.after, i.cost + CASE WHEN v.initial = h.initial THEN 0 ELSE 2 END + CAST(h.truncated AS INTEGER),
             i.edits || CASE WHEN v.initial = h.initial THEN 'K' ELSE 'R' END,
             list_append(i.made, CASE WHEN v.initial = h.initial THEN h.role ELSE v.name END || ':' || h.text)
      FROM inserts i JOIN moves v ON v.state = i.after
      WHERE i.state = w.state AND NOT h.goes AND (v.initial = h.initial OR v.name IS NOT NULL)) m)
  GROUP BY conv_id, pos, state),
e AS (
  SELECT w.conv_id, min(w.cost + i.cost) AS cost, arg_min(w.audit || i.edits, (w.cost + i.cost, w.audit || i.edits)) AS audit,
         arg_min(list_concat(w.made, i.made), (w.cost + i.cost, w.audit || i.edits)) AS made
  FROM walk w JOIN n ON n.conv_id IS NOT DISTINCT FROM w.conv_id AND w.pos = n.n JOIN inserts i ON i.state = w.state AND i.after IN ('E', 'A')
  GROUP BY w.conv_id),
r AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
         count_if(NOT blank AND nth > 1) AS duplicate, count_if(truncated) AS truncated,
         count_if(before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM h GROUP BY conv_id)
SELECT a.conv_id, CAST(coalesce(r.gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(r.blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(r.duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(r.truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(r.illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(e.cost, 0) AS BIGINT) AS cost,
       coalesce(e.audit, '') AS audit, sha256(coalesce(array_to_string(e.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
LEFT JOIN e ON e.conv_id IS NOT DISTINCT FROM a.conv_id
"""
