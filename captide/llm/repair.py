"""Repair of conversation structure: the cheapest edits that give proper turns.

A repaired conversation has the role initials ``(s?(ua)+)?``.  Rows are read in order and
may be kept, given another role, deleted, or have an empty row put before them.  The
initials are followed by an automaton of four states, and per row and state only the best
list of edits is held.

Lists share their beginnings: an edit is a node linked to the one before it.  Of equally
cheap lists the one least in ASCII order is wanted.  Each node has its ancestors at
distances of powers of two and a rolling hash of the whole list, so the place where two
lists part is found by a search over hashes in logarithmic time; that the shared part is
the same is verified, and lists whose hashes collide are compared letter by letter.

Edits change neither a list's cost nor its length behind its back: given its letters, a
list's states and cost are fixed.  So two different lists of equal cost over the same rows
are never one the beginning of the other, and the better of two stays the better whatever
follows, which makes one list per state enough.

Work is dealt to tasks by conversation.  The search sees a few bytes per row, never the
texts; a second pass over the sorted rows takes the edits and hashes the repaired text as
it streams by, so texts are held for one batch only, however long a conversation is.
Only its audit, one letter per edit, is a value as long as the conversation.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby, islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from captide.llm.common import row_slices

# White space.
_BLANKS = " \t\n\x0b\f\r"
# Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
DAMAGES = 20

# States: nothing yet, after a system row, after a user row, after an assistant row.
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = 4
# The state that a kept row of a role initial leads to.
_NEXT = {
    (_START, "s"): _SYSTEM,
    (_START, "u"): _USER,
    (_SYSTEM, "u"): _USER,
    (_ASSISTANT, "u"): _USER,
    (_USER, "a"): _ASSISTANT,
}
# The state that a row of whichever role fits leads to: a user's, after a user an assistant's.
_FITTING = (_USER, _USER, _ASSISTANT, _USER)
_ROLES = {_USER: "user", _ASSISTANT: "assistant"}
_LEGAL = {"su", "ua", "au"}

_BASE = 1_000_003
_MODULUS = (1 << 61) - 1

BLANK, DUPLICATE, WHOLE, CUT = range(4)

# Results handed over together.
_RESULTS = 1000


# -- lists of edits -------------------------------------------------------------------


class Edit:
    """The last edit of a list, linked to the list before it."""

    __slots__ = ("letter", "depth", "hash", "up")

    def __init__(self, before: Edit | None, letter: str):
        self.letter = letter
        if before is None:
            self.depth, self.hash, self.up = 0, 0, ()
            return
        self.depth = before.depth + 1
        self.hash = (before.hash * _BASE + ord(letter)) % _MODULUS
        up = [before]
        while len(up) <= len(up[-1].up):
            up.append(up[-1].up[len(up) - 1])
        self.up = up

    def at(self, depth: int) -> Edit:
        node, k = self, len(self.up) - 1
        while node.depth > depth:
            k = min(k, len(node.up) - 1, (node.depth - depth).bit_length() - 1)
            node = node.up[k]
        return node

    def letters(self) -> str:
        found, node = [], self
        while node.depth:
            found.append(node.letter)
            node = node.up[0]
        return "".join(reversed(found))


def _same(a: Edit, b: Edit) -> bool:
    """Whether two lists of one length have the same letters; shared nodes end the walk."""
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(a: Edit, b: Edit) -> bool:
    """Whether list ``a`` is less than list ``b`` in ASCII order."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x.hash == y.hash:
        if _same(x, y):
            return a.depth < b.depth
        return a.letters() < b.letters()
    for k in range(len(x.up) - 1, -1, -1):
        if k < len(x.up) and x.up[k].hash != y.up[k].hash:
            x, y = x.up[k], y.up[k]
    if x.letter != y.letter and _same(x.up[0], y.up[0]):
        return x.letter < y.letter
    return a.letters() < b.letters()


class Search:
    """Best edits of one conversation, row by row."""

    def __init__(self):
        # Per state its cost, the list before the last edit, and that edit; None: out of reach.
        self._best: list[tuple[int, Edit] | None] = [None] * _STATES
        self._best[_START] = (0, Edit(None, ""))
        self._insert()

    @staticmethod
    def _offer(best: list, state: int, cost: int, before: Edit, letter: str) -> bool:
        held = best[state]
        if held is not None and held[0] < cost:
            return False
        edit = Edit(before, letter)
        if held is not None and held[0] == cost and not less(edit, held[1]):
            return False
        best[state] = (cost, edit)
        return True

    def _insert(self) -> None:
        """Rows put in after the last one, as long as that helps; each costs, so this ends."""
        changed = True
        while changed:
            changed = False
            for state in range(_STATES):
                if (held := self._best[state]) is not None:
                    changed |= self._offer(self._best, _FITTING[state], held[0] + INSERT, held[1], "I")

    def row(self, initial: str, fault: int) -> None:
        best: list[tuple[int, Edit] | None] = [None] * _STATES
        left = TRUNCATED if fault == CUT else 0
        for state, held in enumerate(self._best):
            if held is None:
                continue
            cost, edits = held
            self._offer(best, state, cost + DELETE, edits, "D")
            if fault in (WHOLE, CUT):
                self._offer(best, _FITTING[state], cost + left + REROLE, edits, "R")
                if (state, initial) in _NEXT:
                    self._offer(best, _NEXT[state, initial], cost + left, edits, "K")
        self._best = best
        self._insert()

    def result(self) -> tuple[int, str]:
        ends = [x for x in (self._best[_START], self._best[_ASSISTANT]) if x is not None]
        cost, edits = min(ends, key=lambda x: x[0])
        for other_cost, other in ends:
            if other_cost == cost and less(other, edits):
                edits = other
        return cost, edits.letters()


class Rebuilt:
    """The repaired conversation, hashed as its rows come by."""

    def __init__(self, audit: str):
        self._audit, self._at, self._state = audit, 0, _START
        self._hash, self._any = hashlib.sha256(), False

    def _line(self, role: str, text: str) -> None:
        if self._any:
            self._hash.update(b"\n")
        self._hash.update(f"{role}:{text}".encode())
        self._any = True

    def _inserted(self) -> None:
        while self._audit[self._at : self._at + 1] == "I":
            self._state, self._at = _FITTING[self._state], self._at + 1
            self._line(_ROLES[self._state], "")

    def row(self, role: str, text: str) -> None:
        self._inserted()
        letter, self._at = self._audit[self._at], self._at + 1
        if letter == "R":
            self._state = _FITTING[self._state]
            self._line(_ROLES[self._state], text)
        elif letter == "K":
            self._state = _NEXT[self._state, role[:1]]
            self._line(role, text)

    def digest(self) -> str:
        self._inserted()
        return self._hash.hexdigest()


# -- over tables ----------------------------------------------------------------------


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, present`` of damaged rows, told by a checksum of id and turn.

    Null roles and texts are one space, as are null ids and turns in the checksum.  Of 20
    remainders, 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 gives the
    row twice, and 4 makes it the user's.  A dropped row stays with ``present`` false, so
    that its conversation is known.
    """
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.pmod(F.crc32(key.cast("binary")), F.lit(DAMAGES))
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    damaged = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), kind.alias("kind"))
    return damaged.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "")
        .when(F.col("kind") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        (F.col("kind") != 0).alias("present"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """Rows by their first value, as they come sorted; a conversation may span batches."""
    parts = (part for batch in batches for part in row_slices(batch, column=batch.num_columns - 1))
    rows = (row for part in parts for row in zip(*[c.to_pylist() for c in part.columns], strict=True))
    return groupby(rows, key=lambda row: row[0])


def _batched(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while held := list(islice(rows, _RESULTS)):
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _examined(conv: object, rows: Iterator[tuple]) -> tuple:
    """Faults and best edits of one conversation from its rows' facts."""
    search, seen, turns = Search(), set(), 0
    low = high = last_turn = None
    found = {BLANK: 0, DUPLICATE: 0, CUT: 0}
    illegal, before = 0, None
    for _, turn, initial, blank, cut, digest, present in rows:
        if not present:
            continue
        if turn is not None:
            turns += turn != last_turn
            low, high, last_turn = turn if low is None else low, turn, turn
        fault = BLANK if blank else DUPLICATE if digest in seen else CUT if cut else WHOLE
        seen.add(digest)
        if fault != WHOLE:
            found[fault] += 1
        illegal += before is not None and before + initial not in _LEGAL
        before = initial
        search.row(initial, fault)
    cost, audit = search.result()
    gaps = high - low + 1 - turns if turns else 0
    return conv, gaps, found[BLANK], found[DUPLICATE], found[CUT], illegal, cost, audit


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, edits and digest of the repaired text, one row per ``conv_id``.

    ``rows`` has ``conv_id, turn, role, text`` and may have ``present``; a conversation all of whose rows are
    not present has zeros, an empty audit and the empty string's hash.  Null roles and
    texts are one space; an empty role has a space as its initial, which fits nowhere.
    Rows go by turn, nulls first; rows of one turn go by role, then by the SHA-256 of
    their text.  A null id is a conversation of its own, rows without a role that fits are
    given one or deleted, repeated rows are duplicates, and the length of a text does not
    matter.  An empty table gives an empty result.  Other columns are not read.
    """
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    lines = rows.select(
        F.col("conv_id").alias("conv"),
        F.col("turn").cast("long").alias("turn"),
        role.alias("role"),
        text.alias("text"),
        present.alias("present"),
    ).withColumn("digest", F.sha2("text", 256))
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("digest")]
    kind = lines.schema["conv"].dataType.simpleString()

    last = F.right(F.rtrim("text", F.lit(_BLANKS)), F.lit(1))
    initial = F.when(F.col("role") == "", " ").otherwise(F.substring("role", 1, 1))
    facts = lines.select(
        "conv",
        "turn",
        "role",
        initial.alias("initial"),
        (last == "").alias("blank"),
        (~last.isin(".", "!", "?")).alias("cut"),
        "digest",
        "present",
    )
    sorted_facts = facts.repartition("conv").sortWithinPartitions(*order)
    same = F.unhex(F.sha2(F.concat_ws(":", F.length("role"), "role", "digest"), 256)).alias("same")
    schema = (
        f"conv {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    )
    examined_type = to_arrow_schema(StructType.fromDDL(schema))

    def examine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((_examined(c, r) for c, r in _conversations(batches)), examined_type)

    examined = sorted_facts.select("conv", "turn", "initial", "blank", "cut", same, "present").mapInArrow(examine, schema)

    # Each conversation's edits come before its rows.
    results = examined.withColumns(
        {"step": F.lit(0), "turn": F.lit(None).cast("long"), "role": F.lit(""), "digest": F.lit(""), "text": F.lit("")}
    )
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    texts = lines.where("present").select(
        "conv",
        *[F.lit(None).cast("string" if c == "audit" else "long").alias(c) for c in counts],
        F.lit(1).alias("step"),
        "turn",
        "role",
        "digest",
        "text",
    )
    both = results.select(*texts.columns).union(texts).repartition("conv")
    in_order = both.sortWithinPartitions(order[0], "step", *order[1:])
    final = f"{schema}, repaired_sha256 string"
    final_type = to_arrow_schema(StructType.fromDDL(final))

    def rebuild(conv: object, rows: Iterator[tuple]) -> tuple:
        head = next(rows)
        rebuilt = Rebuilt(head[7])
        for row in rows:
            rebuilt.row(row[8], row[9])
        return (*head[:8], rebuilt.digest())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batched((rebuild(c, r) for c, r in _conversations(batches)), final_type)

    return in_order.select("conv", *counts, "role", "text").mapInArrow(run, final).withColumnRenamed("conv", "conv_id")

