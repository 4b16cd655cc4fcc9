"""Repair of conversation structure: the cheapest edits that make role initials read (s?(ua)+)?, by A* on the edit lattice.

A node is (rows consumed, state of the output).  Keep costs 0, Rerole to user or assistant 2, Delete 3 (the only edit of a
blank or duplicate row), Insert of an empty user or assistant turn 2; a truncated row that stays adds 1.  The heuristic is
the suffix sum of what no path escapes: 3 for each row that must go, 1 for each truncated one.  The queue is keyed by
(cost + heuristic, audit), so of equally cheap repairs the one whose audit is least in ASCII comes first.  Of two paths to
one node at one cost neither audit begins with the other (the longer one would have paid for more inserts), so each node
is final when first taken.

A conversation is a stream: its rows come sorted by turn to one task, for the digest of its repaired text is sequential.  The
search runs on segments of at most SEGMENT rows or SEGMENT_CHARS characters; what goes on is, for each of the four states, the cost, the
audit since the states' audits part, and a running digest.  So memory holds one segment, whatever the conversation's length;
only the audit, which is a result, grows with it.  Whether a row repeats an earlier one is found before, from the first turn of each digest of
(role, text) in its conversation, aggregated where the rows are read.

Defined results: rows are taken by turn, nulls first, and rows of one turn by role, then text; a null conv_id is a conversation
of its own; null text, role, conv_id (in the damage's key) and turn (there too) read as one space; a role's initial is its first
character, and an empty role has none that may be kept; repeated rows are duplicates; an empty table gives no rows; other
columns play no part.
"""

from __future__ import annotations

import hashlib
import heapq
import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
SEGMENT = 256
SEGMENT_CHARS = 1 << 20
SPACES = " \t\n\x0b\x0c\r"
# Output states: nothing yet, after a system turn, after a user turn, after an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = {(EMPTY, "s"): SYSTEM, (EMPTY, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
LEGAL = {"su", "ua", "au"}
FINAL = (EMPTY, ASSISTANT)


def new_role(state: int) -> str:
    """The role that an inserted or rewritten turn takes after a state."""
    return "assistant" if state == USER else "user"


def search(sources: dict[int, tuple[int, str]], rows: list[tuple[str, bool, bool]], goals: tuple[int, ...] | None) -> dict[int, tuple[int, str, int]]:
    """A* over rows (initial, must go, truncated) from states with (cost, audit): for states after the last row (cost, audit, source).

    goals: stop at the first of them; None: all states that can be reached.
    """
    left = [0] * (len(rows) + 1)
    for i in range(len(rows) - 1, -1, -1):
        _, gone, cut = rows[i]
        left[i] = left[i + 1] + (DELETE if gone else CUT if cut else 0)
    queue = [(cost + left[0], audit, 0, state, state) for state, (cost, audit) in sources.items()]
    heapq.heapify(queue)
    done, ends = set(), {}
    while queue:
        total, audit, i, state, source = heapq.heappop(queue)
        if (i, state) in done:
            continue
        done.add((i, state))
        cost = total - left[i]
        if i == len(rows):
            ends[state] = (cost, audit, source)
            if len(ends) == 4 or goals and state in goals:
                break
        then = FOLLOWS[state, "a" if state == USER else "u"]
        if (i, then) not in done:
            heapq.heappush(queue, (total + INSERT, audit + "I", i, then, source))
        if i == len(rows):
            continue
        initial, gone, cut = rows[i]
        rest = cost + left[i + 1]
        if (i + 1, state) not in done:
            heapq.heappush(queue, (rest + DELETE, audit + "D", i + 1, state, source))
        if not gone:
            kept = FOLLOWS.get((state, initial))
            if kept is not None and (i + 1, kept) not in done:
                heapq.heappush(queue, (rest + KEEP + cut * CUT, audit + "K", i + 1, kept, source))
            if (i + 1, then) not in done:
                heapq.heappush(queue, (rest + REROLE + cut * CUT, audit + "R", i + 1, then, source))
    return ends if goals is None else {s: e for s, e in ends.items() if s in goals}


def replay(edits: str, state: int, rows: list[tuple[str, str]]) -> Iterator[str]:
    """The repaired lines `role:text` that edits make of rows (role, text) after a state, each with a newline before it unless it is the first of all."""
    i = 0
    for edit in edits:
        if edit != "D":
            role = rows[i][0] if edit == "K" else new_role(state)
            line = f"{role}:{'' if edit == 'I' else rows[i][1]}"
            yield line if state == EMPTY else "\n" + line
            state = FOLLOWS[state, role[0]]
        i += edit != "I"


class Conversation:
    """One conversation's rows as they stream by."""

    def __init__(self, key, segment: int = SEGMENT):
        self.key, self.segment = key, segment
        self.least = self.last = self.turns = None
        self.n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.before: tuple | None = None
        self.audit: list[str] = []
        self.live = {EMPTY: (0, "", hashlib.sha256())}
        self.facts: list[tuple[str, bool, bool]] = []
        self.rows: list[tuple[str, str]] = []
        self.chars = 0

    def add(self, turn, role: str, text: str, first_turn_later: bool) -> None:
        """first_turn_later: the same role and text stand in an earlier turn."""
        if turn is not None and turn != self.last:
            self.least, self.turns, self.last = turn if self.least is None else self.least, (self.turns or 0) + 1, turn
        own = (turn, role, text)
        body = text.rstrip(SPACES)
        fault = "blank" if not body else "duplicate" if first_turn_later or own == self.before else "truncated" if body[-1] not in ".!?" else None
        if fault:
            self.n[fault] += 1
        if self.before is not None and self.before[1][:1] + role[:1] not in LEGAL:
            self.n["illegal"] += 1
        self.before = own
        self.facts.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
        self.rows.append((role, text))
        self.chars += len(text)
        if len(self.rows) >= self.segment or self.chars >= SEGMENT_CHARS:
            self.flush(None)

    def flush(self, goals: tuple[int, ...] | None) -> None:
        """Search the segment and move on; what all states' audits share is settled."""
        ends = search({s: (cost, audit) for s, (cost, audit, _) in self.live.items()}, self.facts, goals)
        live = {}
        for state, (cost, audit, source) in ends.items():
            digest = self.live[source][2].copy()
            for line in replay(audit[len(self.live[source][1]) :], source, self.rows):
                digest.update(line.encode())
            live[state] = (cost, audit, digest)
        shared = os.path.commonprefix([audit for _, audit, _ in live.values()])
        self.audit.append(shared)
        self.live = {s: (cost, audit[len(shared) :], digest) for s, (cost, audit, digest) in live.items()}
        self.facts, self.rows, self.chars = [], [], 0

    def result(self) -> tuple:
        self.flush(FINAL)
        [(cost, _, digest)] = self.live.values()
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return self.key, gaps, *self.n.values(), cost, "".join(self.audit), digest.hexdigest()


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text): rows damaged by crc32(`conv_id:turn`) % 20; a dropped row stays with null role and text.

    0 drops a row, 1 empties its text, 2 takes [.!?] out, 3 repeats it, 4 makes its role user.
    """
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), fault.alias("fault"))
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("fault") == 4, "user").otherwise(F.col("role"))
    rows = rows.select("conv_id", "turn", F.when(F.col("fault") > 0, role).alias("role"), F.when(F.col("fault") > 0, text).alias("text"), F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))).alias("copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("copies").alias("copy")).drop("copy")


def repair(rows: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row for each conversation of rows (conv_id, turn, role, text), where a null role marks a row that isn't there.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    rows = rows.select("conv_id", "turn", "role", "text", F.md5(F.concat_ws("\n", F.length("role"), "role", "text")).alias("digest"))
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))  # nulls first
    firsts = rows.filter("role IS NOT NULL").groupBy("conv_id", "digest").agg(F.min(turn).alias("first"), F.count("*").alias("n")).filter("n > 1")
    firsts = firsts.select(F.col("conv_id").alias("of"), F.col("digest").alias("same"), "first")
    joined = rows.join(firsts, rows["conv_id"].eqNullSafe(firsts["of"]) & (rows["digest"] == firsts["same"]), "left")
    joined = joined.select("conv_id", "turn", "role", "text", F.coalesce(turn > F.col("first"), F.lit(False)).alias("again"))

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = None
        at: Conversation | None = None
        for batch in batches:
            kinds = kinds or pa.schema([("conv_id", batch.schema.field("conv_id").type), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("repaired_sha256", pa.string())])
            out = []
            for key, turn, role, text, again in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "again")), strict=True):
                if at is None or key != at.key:
                    if at is not None:
                        out.append(at.result())
                    at = Conversation(key, segment)
                if role is not None:
                    at.add(turn, role, text, again)
            if out:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds.types, strict=True)], schema=kinds)
        if at is not None:
            yield pa.record_batch([pa.array([v], k) for v, k in zip(at.result(), kinds.types, strict=True)], schema=kinds)

    kind = rows.schema["conv_id"].dataType.simpleString()
    # by a struct: Spark leaves out a repartition by a column that the input seems to have already, and may change the input's own later
    sorted_rows = joined.repartition(F.struct("conv_id")).sortWithinPartitions("conv_id", "turn", "role", "text")
    return sorted_rows.mapInArrow(each, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def sql() -> str:
    """The damage and the repair in DuckDB's SQL: crc32 from its table, and the lattice row by row over four states."""
    step = "t"
    for _ in range(8):
        step = f"list_transform([{step}], lambda t: CASE WHEN t & 1 = 1 THEN xor(t >> 1, 3988292384) ELSE t >> 1 END)[1]"
    # (state, inserted turns, their audit and text) -> state; two inserts from EMPTY or SYSTEM are the most that can pay
    ways = []
    for state in range(4):
        at, audit, text = state, "", ""
        for n in range(3):
            ways.append(f"({state}, {at}, {INSERT * n}, '{audit}', '{text}')")
            text += ("" if at == EMPTY else "\n") + new_role(at) + ":"
            at, audit = FOLLOWS[at, "a" if at == USER else "u"], audit + "I"
    keeps = ", ".join(f"({state}, '{initial}', {to})" for (state, initial), to in FOLLOWS.items())
    return f"""
WITH RECURSIVE crc(t) AS (SELECT list_transform(range(0, 256), lambda t: {step})),
raw AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)), lambda a, b: xor(a >> 8, crc.t[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS fault
  FROM conversations, crc
), rows AS (
  SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE WHEN fault = 3 THEN [1, 2] ELSE [1] END) FROM raw WHERE fault > 0)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, left(role, 1) AS initial, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM rows
), facts AS (
  SELECT *, CASE WHEN body = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
  FROM placed
), sums AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (illegal) AS illegal FROM facts GROUP BY conv_id
), way(source, state, cost, audit, text) AS (VALUES {", ".join(ways)}), keep(state, initial, target) AS (VALUES {keeps}),
walk(conv_id, i, state, cost, audit, text) AS (
  SELECT conv_id, 0::BIGINT, 0, 0, '', '' FROM sums
  UNION ALL
  SELECT conv_id, next, target, cost, audit, text FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, target ORDER BY cost, audit) AS place FROM (
      SELECT k.conv_id, f.i AS next, e.target, k.cost + w.cost + e.cost AS cost, k.audit || w.audit || e.edit AS audit, k.text || w.text || e.line AS text
      FROM walk k JOIN facts f ON f.conv_id IS NOT DISTINCT FROM k.conv_id AND f.i = k.i + 1 JOIN way w ON w.source = k.state,
      LATERAL (
        SELECT w.state AS target, {DELETE} AS cost, 'D' AS edit, '' AS line
        UNION ALL
        SELECT CASE w.state WHEN {USER} THEN {ASSISTANT} ELSE {USER} END, {REROLE} + (f.fault IS NOT NULL)::INT, 'R', CASE w.state WHEN {EMPTY} THEN '' ELSE chr(10) END || CASE w.state WHEN {USER} THEN 'assistant:' ELSE 'user:' END || f.text
        WHERE f.fault IS NULL OR f.fault = 'truncated'
        UNION ALL
        SELECT keep.target, (f.fault IS NOT NULL)::INT, 'K', CASE w.state WHEN {EMPTY} THEN '' ELSE chr(10) END || f.role || ':' || f.text FROM keep
        WHERE keep.state = w.state AND keep.initial = f.initial AND (f.fault IS NULL OR f.fault = 'truncated')
      ) e
    )
  ) WHERE place = 1
), ends AS (
  SELECT k.conv_id, k.cost + w.cost AS cost, k.audit || w.audit AS audit, k.text || w.text AS text, row_number() OVER (PARTITION BY k.conv_id ORDER BY k.cost + w.cost, k.audit || w.audit) AS place
  FROM walk k JOIN sums s ON k.conv_id IS NOT DISTINCT FROM s.conv_id AND k.i = s.n JOIN way w ON w.source = k.state AND w.state IN {FINAL}
)
SELECT c.conv_id, coalesce(s.gaps, 0)::BIGINT AS gaps, coalesce(s.blank, 0)::BIGINT AS blank, coalesce(s.duplicate, 0)::BIGINT AS duplicate, coalesce(s.truncated, 0)::BIGINT AS truncated, coalesce(s.illegal, 0)::BIGINT AS illegal,
  coalesce(e.cost, 0)::BIGINT AS cost, coalesce(e.audit, '') AS audit, sha256(coalesce(e.text, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN sums s ON s.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.place = 1
"""
