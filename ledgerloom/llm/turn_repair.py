"""Conversation structure repair by a Viterbi search with coalescing survivors (operator 12).

A repaired conversation's role initials follow ``(s?(ua)+)?``.  The rows of a conversation come in order,
and for each state of that grammar the cheapest edits so far survive (Keep, Rerole, Delete, Insert; equal
costs by their initials in ASCII order).  The survivors' edits form a tree of back pointers in which each
node counts what hangs on it: a node that no survivor needs goes, and what all survivors share is emitted
at once and goes too.  So a task holds the rows whose edits are still open, not the conversation.

Two survivors of equal cost are compared over all their open edits.  That takes no walk over them: once
two have differed they stay in that order, and until then one is the other with inserts behind, so the
order of each pair of survivors is carried on from row to row (``_Order``).

Survivors that can't win any more go, too: everything that can follow the start, or a system row alone,
can follow a finished pair as well, except for the system row itself, which costs 3 at most.

Rows are ordered by turn (nulls first), then role, then text; equal rows stay side by side.  Null role or
text is one space.  Whether a text has come before in its conversation is found by an aggregation over
hashes, not by what a task remembers.  A conversation is one stream through one task, in sorted order, as
its digest (a hash over its whole text) is one.
"""

from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ledgerloom.llm.common import quoted, slices
from ledgerloom.storage import stored

SPACES = " \t\n\x0b\x0c\r"
FAULTS = ("blank", "duplicate", "truncated")
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
# States: nothing yet, after a system row, after a user row, after an assistant row.
_AFTER = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT = (2, 2, 3, 2)  # state after the user or assistant row that each state asks for
_FINAL = (0, 3)
_ROLES = ("user", "user", "assistant", "user")  # what each state asks for

_Order = tuple[int, int]  # (-1 or 1, 0): they differ, in that order; (0, m): the second is the first with m inserts behind


def _compare(order: _Order, left: str, right: str) -> _Order:
    """Order of two edit strings from the order of their beginnings and what each has got since."""
    sign, more = order
    if sign:
        return order
    if more > 0:
        right = "I" * more + right
    else:
        left = "I" * -more + left
    for a, b in zip(left, right):
        if a != b:
            return (-1 if a < b else 1), 0
    return 0, len(right) - len(left)


class _Edit:
    """A node of the back pointer tree: one edit, held by survivors and by the edits that follow it."""

    __slots__ = ("parent", "letter", "children", "held")

    def __init__(self, parent: _Edit | None, letter: str):
        self.parent, self.letter, self.children, self.held = parent, letter, [], 0
        if parent is not None:
            parent.children.append(self)


class Repair:
    """One conversation: takes its rows in order and gives the edits as soon as they stand fast."""

    def __init__(self) -> None:
        self.root = _Edit(None, "")
        self.rows: deque = deque()  # rows whose edits are still open
        self.emitted = 0  # state after the emitted edits
        self.costs: list[int | None] = [0, None, None, None]
        self.tips: list[_Edit | None] = [self.root, None, None, None]
        self.root.held = 1
        self.order: list[list[_Order]] = [[(0, 0)] * 4 for _ in range(4)]
        self._settle([(0, 0, ""), None, None, None])

    def _better(self, new: tuple[int, int, str], old: tuple[int, int, str] | None) -> bool:
        if old is None or new[0] != old[0]:
            return old is None or new[0] < old[0]
        return _compare(self.order[new[1]][old[1]], new[2], old[2]) < (0, 0)

    def add(self, row: tuple, initial: str, must_go: bool, truncated: bool) -> Iterator[tuple[str, int, tuple | None]]:
        """Take the next row; gives (edit, state before, row) of what stands fast since."""
        self.rows.append(row)
        best: list[tuple[int, int, str] | None] = [None] * 4  # cost, survivor that it goes on from, its new edits
        for state, cost in enumerate(self.costs):
            if cost is None:
                continue
            options = [(state, cost + DELETE, "D")]
            if not must_go:
                kept = _AFTER.get((state, initial))
                if kept is not None:
                    options.append((kept, cost + KEEP + TRUNCATED * truncated, "K"))
                options.append((_NEXT[state], cost + REROLE + TRUNCATED * truncated, "R"))
            for to, total, letter in options:
                if self._better((total, state, letter), best[to]):
                    best[to] = (total, state, letter)
        self._settle(best)
        yield from self._firm()

    def _settle(self, best: list[tuple[int, int, str] | None]) -> None:
        """Inserts, then the survivors of each state."""
        for state in (0, 1, 3, 2):  # more than one insert at a place: only from the start, or after a system row
            if best[state] is not None:
                cost, source, letters = best[state]
                new, to = (cost + INSERT, source, letters + "I"), _NEXT[state]
                if self._better(new, best[to]):
                    best[to] = new
        whole = best[3]
        for state, gain in ((0, DELETE), (1, 0)):
            if best[state] is not None and whole is not None and best[state][0] > whole[0] + gain:
                best[state] = None
        order = [[(0, 0)] * 4 for _ in range(4)]
        nodes: dict[tuple[int, str], _Edit] = {}
        tips: list[_Edit | None] = [None] * 4
        for state, found in enumerate(best):
            if found is None:
                continue
            _, source, letters = found
            at = self.tips[source]
            for i in range(len(letters)):
                made = nodes.get((source, letters[: i + 1]))
                if made is None:
                    made = nodes[source, letters[: i + 1]] = _Edit(at, letters[i])
                at = made
            tips[state] = at
            for other in range(state):
                if best[other] is not None:
                    sign, more = _compare(self.order[best[other][1]][source], best[other][2], letters)
                    order[other][state], order[state][other] = (sign, more), (-sign, -more)
        for tip in tips:
            if tip is not None:
                tip.held += 1
        for tip in self.tips:
            if tip is not None:
                self._release(tip)
        self.tips, self.order = tips, order
        self.costs = [None if b is None else b[0] for b in best]

    def _release(self, node: _Edit) -> None:
        node.held -= 1
        while not node.held and not node.children and node is not self.root:
            parent = node.parent
            parent.children.remove(node)
            node = parent

    def _firm(self) -> Iterator[tuple[str, int, tuple | None]]:
        """Edits that all survivors share leave the tree."""
        while not self.root.held and len(self.root.children) == 1:
            self.root = self.root.children[0]
            self.root.parent = None
            yield self._emit(self.root.letter)

    def _emit(self, letter: str) -> tuple[str, int, tuple | None]:
        row, state = None if letter == "I" else self.rows.popleft(), self.emitted
        if letter == "K":
            self.emitted = _AFTER[state, row[1][:1]]
        elif letter != "D":
            self.emitted = _NEXT[state]
        return letter, state, row

    def open_edits(self) -> int:
        """Nodes of the tree that have not been emitted."""
        seen, todo = 0, list(self.root.children)
        while todo:
            node = todo.pop()
            seen += 1
            todo += node.children
        return seen

    def end(self) -> Iterator[tuple[str, int, tuple | None]]:
        """The rest of the cheapest edits."""
        winner: int | None = None
        for state in _FINAL:
            if self.costs[state] is not None and (
                winner is None or self._better((self.costs[state], state, ""), (self.costs[winner], winner, ""))
            ):
                winner = state
        letters, node = [], self.tips[winner]
        while node is not self.root:
            letters.append(node.letter)
            node = node.parent
        for letter in reversed(letters):
            yield self._emit(letter)


def _fault(text: str, seen: bool) -> str | None:
    rest = text.rstrip(SPACES)
    return "blank" if not rest else "duplicate" if seen else "truncated" if rest[-1] not in ".!?" else None


def _batches(rows: Iterator[tuple], schema: pa.Schema, text_at: int, most_rows: int = 5000, most_chars: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += len(row[text_at] or "")
        if len(held) == most_rows or chars > most_chars:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)


def _ordered(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, seen) by conversation, each in order; ``seen``: role and text stand at an earlier turn."""
    text = F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text")
    keyed = rows.withColumn("key", F.unhex(F.sha2(text, 256)))
    repeats = keyed.groupBy("conv_id", "key").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).where("n > 1")
    repeats = stored(repeats.select(F.col("conv_id").alias("of"), F.col("key").alias("text_key"), "first"), "repeats")
    joined = keyed.join(repeats, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("text_key")), "left")
    seen = F.col("first").isNotNull() & ~F.col("first.turn").eqNullSafe(F.col("turn"))
    order = ["conv_id", "turn", "role", "text"]
    return joined.select(*order, seen.alias("seen")).repartition("conv_id").sortWithinPartitions(*order)


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per edit: (conv_id, turn, before, role, text, edit, fault, cost), each conversation's edits in order.

    ``edit`` is K, R, D or I; ``before`` the role that the row came with (null: inserted), ``role`` the role it
    has now (null: deleted); an inserted row has no turn and an empty text.  The rows with a role are the
    repaired conversation.  ``fault`` is the first of blank, duplicate, truncated that is true of the row.
    """
    space = F.lit(" ")
    rows = conversations.select(
        quoted(conv_col).alias("conv_id"), quoted(turn_col).cast("long").alias("turn"),
        F.coalesce(quoted(role_col), space).alias("role"), F.coalesce(quoted(text_col), space).alias("text"),
    )
    schema = T.StructType([
        T.StructField("conv_id", rows.schema["conv_id"].dataType), T.StructField("turn", T.LongType()), T.StructField("before", T.StringType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()), T.StructField("edit", T.StringType()),
        T.StructField("fault", T.StringType()), T.StructField("cost", T.LongType()),
    ])

    def edits(conv_id, found: Iterator[tuple[str, int, tuple | None]]) -> Iterator[tuple]:
        for letter, state, row in found:
            if row is None:
                yield conv_id, None, None, _ROLES[state], "", "I", None, INSERT
                continue
            turn, before, text, fault = row
            role = {"K": before, "R": _ROLES[state], "D": None}[letter]
            cost = DELETE if letter == "D" else (REROLE if letter == "R" else KEEP) + TRUNCATED * (fault == "truncated")
            yield conv_id, turn, before, role, text, letter, fault, cost

    def all_edits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, repairing, last = None, None, None
        for batch in slices(batches, 3):
            for conv_id, turn, role, text, seen in zip(*(c.to_pylist() for c in batch.columns)):
                if repairing is None or conv_id != current:
                    if repairing is not None:
                        yield from edits(current, repairing.end())
                    current, repairing, last = conv_id, Repair(), None
                fault = _fault(text, seen or (turn, role, text) == last)
                last = (turn, role, text)
                yield from edits(conv_id, repairing.add((turn, role, text, fault), role[:1], fault in FAULTS[:2], fault == "truncated"))
        if repairing is not None:
            yield from edits(current, repairing.end())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(all_edits(batches), to_arrow_schema(schema), 4)

    return _ordered(rows).mapInArrow(run, schema)


def digest(edits: DataFrame) -> DataFrame:
    """One row per conversation of :func:`repair`'s rows, which must come as that gives them: faults, cost, audit and hash."""
    schema = T.StructType([
        edits.schema["conv_id"], *[T.StructField(n, T.LongType()) for n in ("gaps", *FAULTS, "illegal", "cost")],
        T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType()),
    ])

    def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        current, open_ = None, False
        for batch in batches:
            for conv_id, turn, before, role, text, edit, fault, cost in zip(*(c.to_pylist() for c in batch.columns)):
                if not open_ or conv_id != current:
                    if open_:
                        yield current, *summary(), "".join(audit), sha.hexdigest()
                    current, open_ = conv_id, True
                    low = high = last = None
                    turns = illegal = total = 0
                    counts, audit, sha = dict.fromkeys(FAULTS, 0), [], hashlib.sha256()
                    first = True

                    def summary() -> tuple:
                        gaps = high - low + 1 - turns if turns else 0
                        return gaps, *counts.values(), illegal, total

                audit.append(edit)
                total += cost
                if fault:
                    counts[fault] += 1
                if edit != "I":
                    if turn is not None and turn != high:  # in order, so a new turn is greater than all before
                        low, high, turns = turn if low is None else low, turn, turns + 1
                    illegal += last is not None and last + before[:1] not in ("su", "ua", "au")
                    last = before[:1]
                if role is not None:
                    sha.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
        if open_:
            yield current, *summary(), "".join(audit), sha.hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(conversations(batches), to_arrow_schema(schema), 7)

    return edits.mapInArrow(run, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with the contract's damage; rows that it drops are gone."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind, role, text = F.col("kind"), F.coalesce("role", space), F.coalesce("text", space)
    rows = conversations.select("conv_id", "turn", "role", "text", (F.crc32(key) % 20).alias("kind")).where(kind != 0)
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.explode(F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def report(conversations: DataFrame) -> DataFrame:
    """The contract's columns for every conv_id of the undamaged rows; null conv_ids are one conversation."""
    found = digest(repair(damaged(conversations)))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    numbers = ["gaps", *FAULTS, "illegal", "cost"]
    return every.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("id").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def sql() -> str:
    """:func:`report` of table ``conversations`` in DuckDB SQL: the same search, one row of each conversation after the other."""
    dear = "{'c': 1000000000, 'a': ''}"

    def edit(state: str, cost: str, letter: str) -> str:
        return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}'}}"

    def keep(state: str, initial: str) -> str:
        return f"CASE WHEN NOT gone AND initial = '{initial}' THEN {edit(state, 'cut', 'K')} ELSE {dear} END"

    def rerole(state: str) -> str:
        return f"CASE WHEN NOT gone THEN {edit(state, '2 + cut', 'R')} ELSE {dear} END"

    def least(*options: str) -> str:
        return f"list_sort([{', '.join(options)}])[1]"

    into_two = [f(s) for s in ("s0", "s1", "s3") for f in (lambda s: keep(s, "u"), rerole)]
    inserts = f"""
      SELECT id, i, n0 AS s0, n1 AS s1, two AS s2, {least("n3", edit("two", "2", "I"))} AS s3 FROM (
        SELECT *, {least("n2", *(edit(n, "2", "I") for n in ("n0", "n1", "n3")))} AS two FROM"""
    return rf"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(list_prepend(k, range(8)), lambda c, bit: CASE WHEN c % 2 = 1 THEN xor(c // 2, {0xEDB88320}) ELSE c // 2 END) ORDER BY k) AS entries
  FROM range(256) t(k)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS h
  FROM conversations
), kinds AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
      list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: CAST('0x' || substr(h, 2 * i + 1, 2) AS BIGINT))),
      lambda c, byte: xor(c // 256, entries[1 + xor(c % 256, byte)])
    ), 4294967295) % 20 AS kind
  FROM keyed, crc
), rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kinds WHERE kind <> 0
), ids AS (
  SELECT conv_id, row_number() OVER () AS id FROM (SELECT DISTINCT conv_id FROM conversations)
), numbered AS (
  SELECT id, turn, role, text, left(role, 1) AS initial, regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS rest,
    row_number() OVER (PARTITION BY id ORDER BY turn NULLS FIRST, role, text) AS i
  FROM rows JOIN ids ON rows.conv_id IS NOT DISTINCT FROM ids.conv_id
), faults AS (
  SELECT *, CASE WHEN rest = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(rest, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY id ORDER BY i) AS previous
  FROM numbered
), flagged AS (
  SELECT *, fault IN ('blank', 'duplicate') AS gone, CAST(fault = 'truncated' AS INTEGER) AS cut FROM faults
), search AS (
  {inserts} (SELECT id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': ''}} AS n0, {dear} AS n1, {dear} AS n2, {dear} AS n3 FROM ids))
  UNION ALL
  {inserts} (
    SELECT s.id, f.i, {edit("s0", "3", "D")} AS n0, {least(edit("s1", "3", "D"), keep("s0", "s"))} AS n1,
      {least(edit("s2", "3", "D"), *into_two)} AS n2, {least(edit("s3", "3", "D"), keep("s2", "a"), rerole("s2"))} AS n3
    FROM search s JOIN flagged f ON f.id = s.id AND f.i = s.i + 1))
), counts AS (
  SELECT id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (previous || initial NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM flagged GROUP BY id
), best AS (
  SELECT s.id, {least("s0", "s3")} AS b FROM search s JOIN counts c ON c.id = s.id AND c.n = s.i
), letters AS (
  SELECT id, pos, substr(b.a, pos, 1) AS letter FROM (SELECT id, b, unnest(range(1, length(b.a) + 1)) AS pos FROM best)
), placed AS (
  SELECT *, CASE WHEN letter <> 'I' THEN count(*) FILTER (letter <> 'I') OVER w END AS i, count(*) FILTER (letter <> 'D') OVER w AS place
  FROM letters WINDOW w AS (PARTITION BY id ORDER BY pos ROWS UNBOUNDED PRECEDING)
), said AS (
  SELECT p.id, p.pos, p.letter, p.place, f.role, f.text,
    max(CASE WHEN p.place = 1 AND p.letter = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY p.id) AS system
  FROM placed p LEFT JOIN flagged f ON f.id = p.id AND f.i = p.i
), lines AS (
  SELECT id, pos, CASE WHEN letter = 'K' THEN role WHEN (place - system) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, '') AS line
  FROM said WHERE letter <> 'D'
), repaired AS (
  SELECT id, string_agg(line, chr(10) ORDER BY pos) AS whole FROM lines GROUP BY id
)
SELECT conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.a, '') AS audit,
  sha256(coalesce(whole, '')) AS repaired_sha256
FROM ids LEFT JOIN counts USING (id) LEFT JOIN best USING (id) LEFT JOIN repaired USING (id)"""
