r"""Operator 12: repair of conversation structure, by checkpointed dynamic programming.

A repaired conversation's role initials read ``(s?(ua)+)?``.  Keeping a row
costs 0, giving it the role user or assistant 2, deleting it 3, inserting an
empty user or assistant row anywhere 2; a truncated row that is not deleted
adds 1; blank and duplicate rows must be deleted.  The audit is the initials
of the cheapest edits in order (D, I, K, R); of equal cost, the ASCII-least.

Rows are ordered by turn (NULLs first), then role, then SHA-256 of the text.
The programme runs over light rows, one for each distinct (turn, role, text),
whose only fields are the place and a code; a repeated row is deleted right
after its first.  No task and no group holds a whole conversation:

1. light rows are range-partitioned in order and cut into blocks; the k-th
   block of a conversation in a partition has ``STEP`` * k rows, so n rows
   make O(sqrt n) blocks of O(sqrt n) rows.  A block keeps its codes and the
   least costs between the four states at its two ends;
2. a backward walk over the blocks' cost tables leaves the state-cost vector
   at each checkpoint (block end), and nothing in between;
3. blocks meet their checkpoint, recompute the vectors inside, and walk forward
   from each of the four states, taking the ASCII-least tight edit;
4. the rows stream by conversation in order, each block's edits before its
   rows; the state at a block's start picks one of its four walks.

Texts are shuffled once, in step 4, which hashes them as they pass (SHA-256 of
a conversation is one chain, so its rows pass one task, a batch at a time).

Cases: NULL conv_id, turn, role or text count as one space in the damage key
and in the texts, and NULL ids are one conversation; a role of no letters has
no initial, so it cannot be kept and is illegal beside any other; repeated
rows count each (all but the first are duplicates); a conversation without
rows after the damage gives zeros, an empty audit and the hash of nothing; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from hopgraph.llm.common import table, written

STEP = 64
WHITE = " \t\n\x0b\x0c\r"
DAMAGE = 20
KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
NEVER = 1 << 40

# states: nothing yet, after s, after u, after a; a conversation may end in the first and the last
NOTHING, S, U, A = range(4)
OPEN = {"s": {NOTHING: S}, "u": {NOTHING: U, S: U, A: U}, "a": {U: A}}
#: the role that must come next in each state, if it is not s
NEXT = {NOTHING: U, S: U, U: A, A: U}
ROLE = {U: "user", A: "assistant"}
# row codes: role initial (0 other, 1 s, 2 u, 3 a) + 4 if truncated, or FORCED
FORCED = 8


# ------------------------------------------------------------------ damage and faults (native)


def damage(conversations: DataFrame) -> DataFrame:
    """(``conv_id``, ``turn``, ``role``, ``text``) after the damage; the key decides what happens to a row."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"),
                                F.coalesce("text", space).alias("text"),
                                (F.crc32(key.cast("binary")) % DAMAGE).alias("fate")).where("fate <> 0")
    text = (F.when(F.col("fate") == 1, F.lit(""))
            .when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    times = F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return (rows.select("conv_id", "turn", F.when(F.col("fate") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                        text.alias("text"), F.explode(times).alias("copy")).drop("copy"))


def _keyed(rows: DataFrame) -> DataFrame:
    """Rows with a conversation key that is never NULL, and the digest that orders and compares texts."""
    key = F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit(""))
    return rows.select(key.alias("conv"), F.col("turn").cast("long").alias("turn"), "role",
                       F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "text")


def _last(text: Column) -> Column:
    return F.right(F.rtrim(text, F.lit(WHITE)), F.lit(1))


def light_rows(keyed: DataFrame) -> DataFrame:
    """One row for each distinct (``conv``, ``turn``, ``role``, ``digest``) with its ``code``."""
    last = _last(F.col("text"))
    initial = F.left("role", F.lit(1))
    kind = F.when(initial == "s", 1).when(initial == "u", 2).when(initial == "a", 3).otherwise(0)
    code = F.when(last == "", FORCED).when(last.isin(".", "!", "?"), kind).otherwise(kind + 4)
    light = (keyed.select("conv", "turn", "role", "digest", code.alias("code"))
             .groupBy("conv", "turn", "role", "digest").agg(F.max("code").alias("code")))
    light = written(light, "conv-light")
    # seen earlier: the same role and text in a smaller turn; a NULL turn is the smallest
    first = light.groupBy("conv", "role", "digest").agg(
        F.min("turn").alias("first"), F.max(F.col("turn").isNull()).alias("open"))
    early = F.when(F.col("open"), F.col("turn").isNull()).otherwise(F.col("turn") == F.col("first"))
    return (light.join(first, ["conv", "role", "digest"])
            .select("conv", "turn", "role", "digest", F.when(early, F.col("code")).otherwise(FORCED).alias("code")))


# ------------------------------------------------------------------ the programme over codes


def relaxed(v: list[int]) -> list[int]:
    """Costs to the end after any insertions at this place."""
    n, s, u, a = v
    u, a = min(u, INSERT + a), min(a, INSERT + u)
    return [min(n, INSERT + u), min(s, INSERT + u), u, a]


END = relaxed([0, NEVER, NEVER, 0])


def _take(code: int, state: int) -> tuple[tuple[str, int, int], ...]:
    """(edit, cost, next state) of the edits that use up a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if code != FORCED:
        cut = CUT if code >= 4 else 0
        to = OPEN.get(" sua"[code % 4], {}).get(state)
        if to is not None:
            out.append(("K", KEEP + cut, to))
        out.append(("R", REROLE + cut, NEXT[state]))
    return tuple(out)


TAKE = [[_take(code, state) for state in range(4)] for code in range(FORCED + 1)]


def before(code: int, after: list[int]) -> list[int]:
    """State-cost vector before a row, from the one after it."""
    return relaxed([min(cost + after[to] for _, cost, to in TAKE[code][state]) for state in range(4)])


@lru_cache(maxsize=1 << 14)
def cost_table(codes: bytes) -> tuple[int, ...]:
    """Least cost from each state before the rows (16 numbers, by row) to each state after them."""
    columns = []
    for end in range(4):
        v = relaxed([0 if q == end else NEVER for q in range(4)])
        for code in reversed(codes):
            v = before(code, v)
        columns.append(v)
    return tuple(min(columns[q][p], NEVER) for p in range(4) for q in range(4))


@lru_cache(maxsize=1 << 14)
def walks(codes: bytes, after: tuple[int, ...], final: bool) -> tuple[tuple[str, int], ...]:
    """From each state before the rows: the ASCII-least tight edits and the state they end in.

    The vectors inside the block are recomputed from the checkpoint ``after``.
    """
    vectors = [list(after)]
    for code in reversed(codes):
        vectors.append(before(code, vectors[-1]))
    vectors.reverse()
    out = []
    for state in range(4):
        audit, i = [], 0
        while i < len(codes) or final:
            left = vectors[i][state]
            if i == len(codes):
                if left == 0:
                    break
                audit.append("I")
                state = NEXT[state]
                continue
            tight = {e: to for e, cost, to in TAKE[codes[i]][state] if cost + vectors[i + 1][to] == left}
            if "D" not in tight and INSERT + vectors[i][NEXT[state]] == left:
                audit.append("I")
                state = NEXT[state]
                continue
            edit = min(tight)
            audit.append(edit)
            state, i = tight[edit], i + 1
        out.append(("".join(audit), state))
    return tuple(out)


# ------------------------------------------------------------------ Spark steps


BLOCKS = "conv string, part int, block long, turn long, role string, digest string, codes binary, costs array<long>"


def blocks(light: DataFrame) -> DataFrame:
    """Blocks of ordered light rows, with the place of their first row."""
    n = int(light.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["conv", "turn", "role", "digest"]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, number, out = TaskContext.get().partitionId(), None, 0, []
        start, codes, room, k = None, bytearray(), 0, 0

        def close() -> None:
            out.append((conv, part, number, *start, bytes(codes), list(cost_table(bytes(codes)))))

        for b in batches:
            for c, turn, role, digest, code in zip(*(b.column(x).to_pylist() for x in (*order, "code")), strict=True):
                if c != conv or not room:
                    if codes:
                        close()
                        number += 1
                    k = 1 if c != conv else k + 1
                    conv, start, codes, room = c, (turn, role, digest), bytearray(), STEP * k
                codes.append(code)
                room -= 1
            if out:
                yield _batch(out, light_schema)
                out = []
        if codes:
            close()
            yield _batch(out, light_schema)

    light_schema = pa.schema([("conv", pa.string()), ("part", pa.int32()), ("block", pa.int64()), ("turn", pa.int64()),
                              ("role", pa.string()), ("digest", pa.string()), ("codes", pa.binary()),
                              ("costs", pa.list_(pa.int64()))])
    ordered = light.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return written(ordered.mapInArrow(cut, BLOCKS), "conv-blocks")


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(col, f.type) for col, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def checkpoints(cut: DataFrame) -> DataFrame:
    """(``part``, ``block``, ``after``, ``final``): the state-cost vector at each block's end.

    One conversation's cost tables pass one task, last block first; only one vector is held.
    """
    schema = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("after", pa.list_(pa.int64())), ("final", pa.bool_())])

    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, v = None, END
        for b in batches:
            out = []
            for c, part, block, costs in zip(*(b.column(x).to_pylist() for x in ("conv", "part", "block", "costs")), strict=True):
                final = c != conv
                if final:
                    conv, v = c, END
                out.append((part, block, v, final))
                v = [min(costs[4 * p + q] + v[q] for q in range(4)) for p in range(4)]
            yield _batch(out, schema)

    light = cut.select("conv", "part", "block", "costs").repartition("conv")
    back_first = light.sortWithinPartitions("conv", F.desc("part"), F.desc("block"))
    return back_first.mapInArrow(back, "part int, block long, after array<long>, final boolean")


def block_walks(cut: DataFrame) -> DataFrame:
    """Blocks with the four walks: (``conv``, place, ``part``, ``block``, ``codes``, ``audits``, ``ends``)."""
    schema = pa.schema([("conv", pa.string()), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.string()),
                        ("part", pa.int32()), ("block", pa.int64()), ("codes", pa.binary()),
                        ("audits", pa.list_(pa.string())), ("ends", pa.list_(pa.int32()))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ("conv", "turn", "role", "digest", "part", "block", "codes", "after", "final")
        for b in batches:
            out = []
            for *place, codes, after, final in zip(*(b.column(x).to_pylist() for x in names), strict=True):
                four = walks(codes, tuple(after), final)
                out.append((*place, codes, [a for a, _ in four], [s for _, s in four]))
            if out:
                yield _batch(out, schema)

    joined = cut.drop("costs").join(checkpoints(cut), ["part", "block"])
    return joined.mapInArrow(walk, "conv string, turn long, role string, digest string, part int, block long, "
                                   "codes binary, audits array<string>, ends array<int>")


class Report:
    """What is known of one conversation while its rows pass."""

    def __init__(self, conv: str):
        self.conv, self.state, self.waiting = conv, NOTHING, deque()
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = self.turns = self.kept = 0
        self.low = self.high = self.turn = self.place = self.initial = None
        self.audit, self.sha = [], hashlib.sha256()
        self.codes, self.edits, self.row, self.edit = b"", "", 0, 0

    def add_block(self, codes: bytes, audits: list[str], ends: list[int]) -> None:
        self.waiting.append((codes, audits, ends))

    def say(self, role: str, text: str) -> None:
        self.sha.update((("\n" if self.kept else "") + f"{role}:{text}").encode())
        self.kept += 1

    def insert(self) -> None:
        self.audit.append("I")
        self.cost += INSERT
        self.state = NEXT[self.state]
        self.say(ROLE[self.state], "")

    def _next_code(self) -> int:
        while self.row == len(self.codes):                    # the block before is used up
            codes, audits, _ = self.waiting.popleft()
            self.codes, self.edits, self.row, self.edit = codes, audits[self.state], 0, 0
        self.row += 1
        return self.codes[self.row - 1]

    def add_row(self, turn: int | None, role: str, digest: str, text: str) -> None:
        if turn is not None:
            self.turns += self.turn != turn
            self.turn = turn
            self.low = turn if self.low is None else self.low
            self.high = turn
        initial = role[:1]
        self.illegal += self.initial is not None and self.initial + initial not in ("su", "ua", "au")
        self.initial = initial
        blank = not text.strip(WHITE)
        if self.place == (turn, role, digest):                # a repeated row
            code, edit = FORCED, "D"
        else:
            self.place = (turn, role, digest)
            code = self._next_code()
            while self.edits[self.edit] == "I":
                self.insert()
                self.edit += 1
            edit = self.edits[self.edit]
            self.edit += 1
        self.audit.append(edit)
        if code == FORCED:
            self.blank += blank
            self.duplicate += not blank
        self.truncated += FORCED > code >= 4
        if edit == "D":
            self.cost += DELETE
            return
        self.cost += (REROLE if edit == "R" else KEEP) + (CUT if code >= 4 else 0)
        self.state = NEXT[self.state] if edit == "R" else OPEN[initial][self.state]
        self.say(ROLE[self.state] if edit == "R" else role, text)

    def result(self) -> tuple:
        for _ in self.edits[self.edit:]:                      # insertions after the last row
            self.insert()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost,
                "".join(self.audit), self.sha.hexdigest())


NUMBERS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def repair(conversations: DataFrame) -> DataFrame:
    """One row per ``conv_id``: the faults found, the cost, the audit and the hash of the repaired rows."""
    keyed = _keyed(damage(conversations))
    found = block_walks(blocks(light_rows(keyed)))
    schema = pa.schema([("conv", pa.string()), *[(n, pa.int64()) for n in NUMBERS], ("audit", pa.string()),
                        ("repaired_sha256", pa.string())])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []
        names = ("conv", "turn", "role", "digest", "text", "codes", "audits", "ends")
        for b in batches:
            for conv, turn, role, digest, text, codes, audits, ends in zip(
                    *(b.column(x).to_pylist() for x in names), strict=True):
                if now is None or conv != now.conv:
                    if now is not None:
                        out.append(now.result())
                    now = Report(conv)
                if codes is not None:
                    now.add_block(codes, audits, ends)
                else:
                    now.add_row(turn, role, digest, text)
            if len(out) >= 1000:
                yield _batch(out, schema)
                out = []
        if now is not None:
            out.append(now.result())
        if out:
            yield _batch(out, schema)

    rows = keyed.selectExpr("conv", "turn", "role", "digest", "text", "CAST(NULL AS int) AS part",
                            "CAST(NULL AS long) AS block", "CAST(NULL AS binary) AS codes",
                            "CAST(NULL AS array<string>) AS audits", "CAST(NULL AS array<int>) AS ends", "1 AS kind")
    marks = found.withColumn("text", F.lit(None).cast("string")).withColumn("kind", F.lit(0))
    both = rows.unionByName(marks).repartition("conv").sortWithinPartitions("conv", "turn", "role", "digest", "kind",
                                                                          "part", "block")
    done = both.mapInArrow(emit, "conv string, " + ", ".join(f"{n} long" for n in NUMBERS)
                           + ", audit string, repaired_sha256 string")
    all_ids = conversations.select("conv_id").distinct().withColumn(
        "conv", F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")))
    nothing = hashlib.sha256().hexdigest()
    return all_ids.join(done, "conv", "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in NUMBERS],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))


def op12_conversation_repair(spark, sf_dir) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))


#: forward over the rows: the cheapest and ASCII-least edits into each state, at most one insertion before a row
#: (a second one would bring back the state or cost more) and at most two after the last
SQL = r"""
WITH RECURSIVE crc_bits AS (
  SELECT i::BIGINT AS i, i::BIGINT AS c, 0 AS k FROM range(256) r(i)
  UNION ALL
  SELECT i, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, k + 1 FROM crc_bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY i) AS t FROM crc_bits WHERE k = 8),
hashed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(
           list_transform(range(octet_length(encode(key))),
             lambda j: (instr('123456789ABCDEF', substr(hex(encode(key)), 2 * j + 1, 1)) * 16
                        + instr('123456789ABCDEF', substr(hex(encode(key)), 2 * j + 2, 1)))::BIGINT),
           lambda c, b: xor(c // 256, t[(xor(c, b) % 256) + 1]), 4294967295::BIGINT), 4294967295) % 20 AS fate
  FROM (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations), crc),
damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN fate = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE fate <> 0),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i,
         right(rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM damaged),
faults AS (
  SELECT *, left(role, 1) AS ini,
         CASE WHEN last = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS prev
  FROM ordered),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM faults GROUP BY conv_id),
next(state, ini, role) AS (
  VALUES ('', 's', NULL), ('', 'u', 'user'), ('s', 'u', 'user'), ('a', 'u', 'user'), ('u', 'a', 'assistant')),
dp AS (
  SELECT conv_id, 0::BIGINT AS i, '' AS state, {'cost': 0, 'audit': '', 'said': []::VARCHAR[]} AS best FROM counts
  UNION ALL
  SELECT conv_id, i + 1, state, min(best) FROM (
    SELECT d.conv_id, d.i, e.state, {'cost': d.best.cost + e.cost, 'audit': d.best.audit || e.audit,
                                     'said': list_concat(d.best.said, e.said)} AS best
    FROM (
      SELECT conv_id, i, state, best FROM dp
      UNION ALL
      SELECT dp.conv_id, dp.i, n.ini, {'cost': best.cost + 2, 'audit': best.audit || 'I',
                                       'said': list_append(best.said, n.role || ':')}
      FROM dp JOIN next n ON n.state = dp.state AND n.role IS NOT NULL) d
    JOIN faults f ON f.conv_id IS NOT DISTINCT FROM d.conv_id AND f.i = d.i + 1,
    LATERAL (
      SELECT d.state AS state, 3 AS cost, 'D' AS audit, []::VARCHAR[] AS said
      UNION ALL
      SELECT n.ini, (f.fault = 'truncated')::INT, 'K', [f.role || ':' || f.text] FROM next n
      WHERE n.state = d.state AND n.ini = f.ini AND f.fault IN ('', 'truncated')
      UNION ALL
      SELECT n.ini, 2 + (f.fault = 'truncated')::INT, 'R', [n.role || ':' || f.text] FROM next n
      WHERE n.state = d.state AND n.role IS NOT NULL AND f.fault IN ('', 'truncated')) e)
  GROUP BY conv_id, i, state),
ends AS (
  SELECT dp.conv_id, min({'cost': best.cost + CASE state WHEN 's' THEN 4 WHEN 'u' THEN 2 ELSE 0 END,
                          'audit': best.audit || CASE state WHEN 's' THEN 'II' WHEN 'u' THEN 'I' ELSE '' END,
                          'said': list_concat(best.said, CASE state WHEN 's' THEN ['user:', 'assistant:']
                                                         WHEN 'u' THEN ['assistant:'] ELSE [] END)}) AS best
  FROM dp JOIN counts c ON c.conv_id IS NOT DISTINCT FROM dp.conv_id AND c.n = dp.i GROUP BY dp.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.cost, 0)::BIGINT AS cost,
       coalesce(best.audit, '') AS audit, sha256(coalesce(array_to_string(best.said, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""
