"""Repair of conversations by the cheapest edits, streamed turn by turn.

A repaired conversation has role initials ``(s?(ua)+)?``: nothing, or an optional system
turn and then user and assistant in turn.  A row is kept (K, 0), gets another role (R, 3)
or is deleted (D, 4); empty user and assistant turns are inserted (I, 3) anywhere.  Blank
and duplicate rows have to go; a truncated row that stays costs 3 more.

Rows are dealt to tasks by conversation once.  Two sorts of a task's own rows follow, each
streamed through Arrow batches with a state of a few numbers carried from one batch to the
next, so that neither a conversation nor a batch has to fit in memory:

1. from the last turn to the first: the least costs from each of four states of the grammar
   to the end.  What is best at a row from each state is its backpointer: eight bits.
2. from the first turn to the last: the backpointers are followed, and edits come out.

Backpointers travel as a column beside their rows, so Spark's sort between the two passes
spills them for giant conversations, on the task's own disk, to be done again elsewhere if
the executor is lost.  Going backwards makes ties easy: the edits open at a row have
different letters, so the first letter alone decides which audit is least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cowrie.llm.slices import bounded

#: What counts as white space: a space and \x09 to \x0D.
SPACES = " \t\n\x0b\x0c\r"
ENDS = ".!?"

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
NO_FAULT, BLANK, DUPLICATE, TRUNCATED = range(4)
FAULTS = (None, "blank", "duplicate", "truncated")

# States of the grammar: nothing yet, after s, after u, after a.
EMPTY, AFTER_S, AFTER_U, AFTER_A = range(4)
_KEPT = {(EMPTY, "s"): AFTER_S, (EMPTY, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U,
         (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: The state after an inserted turn or one with a new role: both are what the grammar wants.
_WANTED = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
_ROLES = {AFTER_U: "user", AFTER_A: "assistant"}
_LETTERS = "DIKR"  # in ASCII order
_NEVER = 1 << 60
#: Least costs from each state where no row is left: user and assistant, assistant or nothing.
_END = (0, 2 * INSERT, INSERT, 0)


def _with_inserts(rest: list[int], letters: list[int]) -> tuple[tuple[int, ...], int]:
    """Costs and letters once a turn may be inserted before what ``rest`` does from each state."""
    costs, code = [], 0
    for state in range(4):
        # after an insertion the wanted state's own choice follows: two in a row never pay
        # but from nothing or a system turn, where the state after them is A
        wanted = _WANTED[state]
        there = min(rest[wanted], INSERT + rest[_WANTED[wanted]])
        cost, letter = min((rest[state], letters[state]), (INSERT + there, 1))
        costs.append(cost)
        code |= letter << 2 * state
    return tuple(costs), code


def stepped(costs: tuple[int, ...], initial: str, fault: int) -> tuple[tuple[int, ...], int]:
    """Least costs before a row, given those after it, and its backpointer: two bits a state."""
    rest, letters = [], []
    extra = CUT if fault == TRUNCATED else 0
    for state in range(4):
        best = (DELETE + costs[state], 0)
        if fault not in (BLANK, DUPLICATE):
            kept = _KEPT.get((state, initial))
            if kept is not None:
                best = min(best, (KEEP + extra + costs[kept], 2))
            best = min(best, (REROLE + extra + costs[_WANTED[state]], 3))
        rest.append(best[0])
        letters.append(best[1])
    return _with_inserts(rest, letters)


def _spaced(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(" "))


def damaged(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, lost``: a fixed share of the rows of ``turns`` is damaged.

    crc32 of ``conv_id:turn`` modulo 20 decides: 0 marks a row as lost, 1 empties its text,
    2 takes its ``.``, ``!`` and ``?`` out, 3 repeats it, 4 makes its role user.  Nulls
    count as one space, in that key and as role and text.
    """
    key = F.concat(
        F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
        F.coalesce(F.col("turn").cast("string"), F.lit(" ")),
    )
    fate = F.crc32(key) % 20
    rows = turns.select("conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), fate.alias("_fate"))
    kind = F.col("_fate")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ENDS, "")).otherwise(F.col("text"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"), (kind == 0).alias("lost"), F.explode(copies).alias("_copy"),
    ).drop("_copy")


class _Changes:
    """Tells rows of another conversation from those of the one before."""

    def __init__(self) -> None:
        self.now: object = self

    def __call__(self, conversation: object) -> bool:
        if conversation == self.now and self.now is not self:
            return False
        self.now = conversation
        return True


def _pointed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first pass, from the last row: adds each row's backpointer as ``_best``."""
    new, costs = _Changes(), _END
    known: dict[tuple, tuple] = {}  # few differences of costs occur, so steps repeat
    for batch in batches:
        best = []
        columns = (batch.column(c).to_pylist() for c in ("conv_id", "_initial", "_fault", "lost"))
        for conversation, initial, fault, lost in zip(*columns):
            if new(conversation):
                costs = _END
            if lost:
                best.append(0)
                continue
            least = min(costs)
            key = (*(c - least for c in costs), initial if initial in ("s", "u", "a") else "", fault)
            if key not in known:
                known[key] = stepped(key[:4], key[4], fault)
            step, code = known[key]
            costs = tuple(c + least for c in step)
            best.append(code)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(best, pa.int16())], names=[*batch.schema.names, "_best"]
        )


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The second pass, from the first row: lists of (conversation, step, edit, cost, fault, turn, was, role, text).

    A conversation whose rows are all lost gives one row whose edit is None.
    """
    new, state, step, begun = _Changes(), EMPTY, 0, False
    conversation = None

    def inserted() -> tuple:
        nonlocal state, step
        state, step = _WANTED[state], step + 1
        return (conversation, step - 1, "I", INSERT, None, None, None, _ROLES[state], "")

    def ended() -> Iterator[tuple]:
        while state not in (EMPTY, AFTER_A):
            yield inserted()
        if begun and not step:
            yield (conversation, 0, None, 0, None, None, None, None, None)

    for part in bounded(batches, "text"):
        rows: list[tuple] = []
        columns = (part.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "_initial", "_fault", "lost", "_best"))
        for this, turn, was, text, initial, fault, lost, best in zip(*columns):
            if new(this):
                rows.extend(ended())
                conversation, state, step, begun = this, EMPTY, 0, True
            if lost:
                continue
            while (letter := _LETTERS[best >> 2 * state & 3]) == "I":
                rows.append(inserted())
            if letter == "D":
                cost, role = DELETE, None
            else:
                cost = CUT if fault == TRUNCATED else 0
                if letter == "K":
                    state, role = _KEPT[state, initial], was
                else:
                    state, cost = _WANTED[state], cost + REROLE
                    role = _ROLES[state]
            rows.append((this, step, letter, cost, FAULTS[fault], turn, was, role, None if role is None else text))
            step += 1
        yield rows
    yield list(ended())


def _ordered(turns: DataFrame, lost: str | None) -> DataFrame:
    """Rows in ascending order within whole conversations, each with fault and backpointer."""
    gone = F.lit(False) if lost is None else F.coalesce(F.col(lost), F.lit(False))
    rows = turns.select(
        "conv_id", "turn", _spaced("role").alias("role"), _spaced("text").alias("text"), gone.alias("lost")
    ).repartition("conv_id")
    # same role and text: by digest, so that the sort doesn't compare whole texts
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    alike = Window.partitionBy("conv_id", "lost", "_said").orderBy(F.col("turn").asc_nulls_first())
    body = F.rtrim("text", F.lit(SPACES))
    fault = (
        F.when(body == "", BLANK).when(F.col("_nth") > 1, DUPLICATE)
        .when(~F.right(body, F.lit(1)).isin(*ENDS), TRUNCATED).otherwise(NO_FAULT)
    )
    marked = (
        rows.withColumn("_said", said).withColumn("_nth", F.row_number().over(alike)).drop("_said")
        .withColumns({"_initial": F.left("role", F.lit(1)), "_fault": fault})
    )
    order = ["turn", "role", "text", "_nth"]
    last_first = marked.sortWithinPartitions(
        "conv_id", F.col("turn").desc_nulls_last(), *(F.col(c).desc() for c in order[1:])
    )
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in marked.schema)
    pointed = last_first.mapInArrow(_pointed, f"{schema}, _best short")
    return pointed.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), *order[1:])


def _fields(turns: DataFrame) -> dict[str, str]:
    return {c: turns.schema[c].dataType.simpleString() for c in ("conv_id", "turn")}


def _arrow(turns: DataFrame, *columns: tuple[str, pa.DataType]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    kinds = {"conv_id": turns.schema["conv_id"].dataType, "turn": turns.schema["turn"].dataType}
    return pa.schema([(n, k if k is not None else to_arrow_type(kinds[n])) for n, k in columns])


def repair(turns: DataFrame, lost: str | None = None) -> DataFrame:
    """The edits of every conversation of ``turns (conv_id, turn, role, text)``, one row each.

    Columns: ``conv_id, step`` (from 0), ``edit`` (K, R, D, I), ``cost``, ``fault`` (blank,
    duplicate, truncated or null), ``turn``, ``was`` (the row's role; null if inserted),
    ``role`` and ``text`` after the repair (null if deleted).  The rows that aren't
    deleted, by step, are the repaired conversation.

    Edits are the cheapest, among those the ones whose letters are ASCII-least.  Rows go by
    turn, nulls first, ties by role and text.  Null roles and texts count as one space; rows
    with a null ``conv_id`` are one conversation.  Of equal rows all but the first are
    duplicates.  Rows where the column ``lost`` is true only name their conversation; one
    without other rows gives one row of nulls, step 0 and cost 0.  An empty table gives no
    rows.  Columns beyond these are not read.
    """
    schema = _arrow(
        turns, ("conv_id", None), ("step", pa.int64()), ("edit", pa.string()), ("cost", pa.int64()),
        ("fault", pa.string()), ("turn", None), ("was", pa.string()), ("role", pa.string()), ("text", pa.string()),
    )

    def edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _edited(batches):
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    own = _fields(turns)
    return _ordered(turns, lost).mapInArrow(
        edits,
        f"conv_id {own['conv_id']}, step long, edit string, cost long, fault string, turn {own['turn']}, "
        "was string, role string, text string",
    )


class _Digest:
    """What is known of a conversation after the edits so far: numbers, a hash and its letters."""

    def __init__(self, conversation: object) -> None:
        self.conversation = conversation
        self.first = self.last = self.before = None
        self.turns = self.illegal = self.cost = self.lines = 0
        self.faults = dict.fromkeys(FAULTS[1:], 0)
        self.audit, self.sha = bytearray(), hashlib.sha256()

    def add(self, edit: str, cost: int, fault: str | None, turn: int | None, was: str | None, role: str | None, text: str | None) -> None:
        self.audit += edit.encode()
        self.cost += cost
        if fault:
            self.faults[fault] += 1
        if edit != "I":
            if self.before is not None and self.before + was[:1] not in ("su", "ua", "au"):
                self.illegal += 1
            self.before = was[:1]
            if turn is not None and turn != self.last:
                self.first = turn if self.first is None else self.first
                self.last, self.turns = turn, self.turns + 1
        if role is not None:
            self.sha.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
            self.lines += 1

    def row(self) -> tuple:
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conversation, gaps, *self.faults.values(), self.illegal, self.cost, self.audit.decode(), self.sha.hexdigest())


def digests(turns: DataFrame, lost: str | None = None) -> DataFrame:
    """One row for every conversation, computed from the edits of ``repair`` as they are made.

    ``gaps`` (turns missing between the first and the last), ``blank, duplicate,
    truncated`` (rows by their first fault), ``illegal`` (neighbouring rows whose role
    initials aren't su, ua or au), ``cost``, ``audit`` (the edits' letters) and
    ``repaired_sha256`` (of the repaired ``role:text``, joined by newlines).  Nulls, ties,
    repeated rows, lost rows, empty tables and other columns count as in ``repair``; a
    conversation without rows has zeros, no letters and the hash of nothing.
    """
    long = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = _arrow(
        turns, ("conv_id", None), *((c, pa.int64()) for c in long), ("audit", pa.string()), ("repaired_sha256", pa.string())
    )

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        new, digest = _Changes(), None
        for rows in _edited(batches):
            done = []
            for conversation, _, edit, *rest in rows:
                if new(conversation):
                    if digest:
                        done.append(digest.row())
                    digest = _Digest(conversation)
                if edit is not None:
                    digest.add(edit, *rest)
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*done), schema)], schema=schema)
        if digest:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(digest.row(), schema)], schema=schema)

    kinds = ", ".join(f"{c} long" for c in long)
    return _ordered(turns, lost).mapInArrow(
        summed, f"conv_id {_fields(turns)['conv_id']}, {kinds}, audit string, repaired_sha256 string"
    )
