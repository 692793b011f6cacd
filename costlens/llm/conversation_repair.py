"""Conversation structure repair by iterative-deepening A*.

A conversation is well formed if the initials of its roles give
``(s?(ua)+)?``. Its rows, in order, are kept, given another role, or deleted,
and empty messages are inserted; the cheapest edits win, of equally cheap ones
those whose initials (D, I, K, R) come first in ASCII order.

The search is depth first in ASCII edit order under a cost bound. A state is
(row, place in the pattern); a table holds, per state, a cost that is known not
to suffice from there (at first what each row ahead costs at least), grows when a
state fails, and prunes whatever comes back to it with less. If the root
fails, its entry is the next bound. So the first path that is accepted is cheapest,
and first in ASCII order among the cheapest.

Long conversations are searched in blocks of rows from the last to the first,
each from all places of the pattern, with the costs of the blocks behind it as
the costs at its end. An insertion belongs to the row that follows, so the edits
of a block from one place are no beginning of others, and the first in ASCII
order, block by block, are the first of the whole. Time grows in proportion to
the rows, and a conversation needs a few bytes a row.

Spark finds each row's fault, shuffles rows without their texts to
the search, sorted by conversation and turn, and then the texts once more to
where the edits are applied. Both tasks read a sorted stream; what they hold of
a conversation is one byte a row and the edits, whose string is a value of the
result anyway, never its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import repeat

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Costs of the edits; a truncated row that stays costs TRUNCATED more.
RENAME, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
BLOCK_ROWS = 64

# Places in the pattern: at the start, after s, after u, after a. From each, the
# one role initial besides s that may follow, and the place behind it.
ROLE_AFTER = ("user", "user", "assistant", "user")
NEXT = (2, 2, 3, 2)
INITIALS = "sua"  # any other initial has the class 3
SOUND, CUT, LOST = 0, 1, 2  # kinds of rows: as it should be, truncated, to be deleted
_KEPT = {(0, 0): 1, (0, 1): 2, (1, 1): 2, (3, 1): 2, (2, 2): 3}  # (place, class) -> place


def _moves(code: int, place: int) -> list[tuple[str, int, int, int]]:
    """(initial, cost, next place, rows consumed) of the edits at a row, in ASCII order."""
    kind, initial = divmod(code, 4)
    more = TRUNCATED if kind == CUT else 0
    moves = [("D", DELETE, place, 1), ("I", INSERT, NEXT[place], 0)]
    if kind != LOST:
        if (place, initial) in _KEPT:
            moves.append(("K", more, _KEPT[place, initial], 1))
        moves.append(("R", RENAME + more, NEXT[place], 1))
    return moves


MOVES = [[_moves(code, place) for place in range(4)] for code in range(12)]
LEAST = [min(min(c for e, c, _, _ in MOVES[code][place] if e != "I") for place in range(4)) for code in range(12)]
_CLASS_OF = bytes(c & 3 for c in range(256))
_LEGAL = (b"\0\1", b"\1\2", b"\2\1")  # adjacent classes: su, ua, au
AT_END = [[("I", INSERT, NEXT[place], 0)] for place in range(4)]
#: Cost from each place to an accepted end by insertions alone.
END_COST = [0, 2 * INSERT, INSERT, 0]


def _deepen(codes: bytes, place: int, table: list[int], last: bool) -> tuple[int, str, int]:
    """(cost, edits, place at the end) of the cheapest path from ``place`` at the first row.

    ``table`` has a cost known not to be undercut per row and place, the exact
    cost at the end; it is raised here, for this and later searches of the block.
    """
    end = 4 * len(codes)
    while True:
        # Frames: state, its moves, move taken, cost left, least cost found necessary.
        stack = [[place, MOVES[codes[0]][place] if codes else AT_END[place], -1, table[place], 1 << 60]]
        bound = table[place]
        while stack:
            frame = stack[-1]
            state, moves, at, left, need = frame
            if state >= end and (not last or state - end in (0, 3)):
                return bound, "".join(f[1][f[2]][0] for f in stack[:-1]), state - end
            at += 1
            while at < len(moves):
                _, cost, to, rows = moves[at]
                child = (state & ~3) + 4 * rows + to
                if cost + table[child] <= left:
                    break
                need = min(need, cost + table[child])
                at += 1
            if at < len(moves):
                frame[2], frame[4] = at, need
                stack.append([child, MOVES[codes[child >> 2]][to] if child < end else AT_END[to], -1, left - cost, 1 << 60])
                continue
            table[state] = max(table[state], need)
            stack.pop()
            if stack:
                above = stack[-1]
                above[4] = min(above[4], above[1][above[2]][1] + table[state])


def cheapest_edits(codes: bytes, block_rows: int = BLOCK_ROWS) -> tuple[int, str]:
    """(cost, initials of the edits) for rows given as ``4 * kind + class`` bytes."""
    starts = list(range(0, len(codes), block_rows)) or [0]
    behind, blocks = END_COST, []
    for start in reversed(starts):
        rows, last = codes[start : start + block_rows], start == starts[-1]
        table = [0] * (4 * len(rows)) + behind
        ahead = min(behind)
        for i in range(len(rows) - 1, -1, -1):
            ahead += LEAST[rows[i]]
            table[4 * i : 4 * i + 4] = [ahead] * 4
        found = [_deepen(rows, place, table, last) for place in (range(4) if start else (0,))]
        behind = [cost for cost, _, _ in found]
        blocks.append([(edits, place) for _, edits, place in found])
    place, edits = 0, []
    for block in reversed(blocks):
        part, place = block[place]
        edits.append(part)
    return behind[0], "".join(edits)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_AUDIT = ", ".join(f"{name} long" for name in _COUNTS) + ", audit string"


class _Conversation:
    """What the search needs of one conversation: a byte per row and a few counts."""

    def __init__(self) -> None:
        self.codes, self.counts = bytearray(), [0, 0, 0]
        self.turns, self.low, self.high = 0, None, None

    def add(self, turn: int | None, code: int, copies: int, first: bool) -> None:
        if copies < 1:
            return
        if turn is not None and turn != self.high:  # turns arrive in order
            self.low, self.high, self.turns = turn if self.low is None else self.low, turn, self.turns + 1
        kind, initial = divmod(code, 4)
        again = 0 if kind == LOST else copies - first
        self.codes += bytes([code]) * (copies - again) + bytes([4 * LOST + initial]) * again
        self.counts[0] += copies if kind == LOST else 0
        self.counts[1] += again
        self.counts[2] += copies - again if kind == CUT else 0

    def result(self) -> list:
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        initials = self.codes.translate(_CLASS_OF)
        legal = sum(map(initials.count, _LEGAL))
        cost, audit = cheapest_edits(bytes(self.codes))
        return [gaps, *self.counts, max(0, len(initials) - 1) - legal, cost, audit]


def _by_conversation(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(is first row of its conversation, *row) of a stream sorted by its first column."""
    before = object()
    for batch in batches:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            yield row[0] != before, *row
            before = row[0]


def _in_batches(rows: Iterator[list], schema: pa.Schema, most_rows: int = 2048, most_chars: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= most_rows or chars >= most_chars:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in held], schema)


_ARROW_AUDIT = [*((name, pa.int64()) for name in _COUNTS), ("audit", pa.string())]


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def results() -> Iterator[list]:
        conv_id, conversation = None, None
        for new, key, turn, code, copies, first in _by_conversation(batches):
            if new:
                if conversation:
                    yield [conv_id, *conversation.result()]
                conv_id, conversation = key, _Conversation()
            conversation.add(turn, code, copies, first)
        if conversation:
            yield [conv_id, *conversation.result()]

    yield from _in_batches(results(), pa.schema([("conv_id", pa.int64()), *_ARROW_AUDIT]))


def rows_of(conversations: DataFrame, copies: Column | None = None) -> DataFrame:
    """(conv_id, turn, role, text, copies) as the other functions take them; null role or text becomes one space."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text"))
    many = F.lit(1) if copies is None else copies
    return conversations.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), role, text, many.cast("long").alias("copies"))


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256))


def audits(rows: DataFrame) -> DataFrame:
    """Per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit.

    ``rows`` as of ``rows_of``; a row counts ``copies`` times, one after the other, and a
    conversation whose rows all have none is still returned. Rows of one turn follow
    each other by role, then by the hash of their text. A null conv_id is
    a conversation like any other.
    """
    initial = F.substring("role", 1, 1)
    of_class = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    bare = F.rtrim(F.col("text"), F.lit(BLANKS))
    kind = F.when(bare == "", LOST).when(F.substring(bare, -1, 1).isin(".", "!", "?"), SOUND).otherwise(CUT)
    coded = rows.select("conv_id", "turn", "role", _digest().alias("digest"), (4 * kind + of_class).cast("int").alias("code"), "copies")
    lines = coded.groupBy("conv_id", "turn", "role", "digest", "code").agg(F.sum("copies").alias("copies"))
    # A line comes first if no earlier turn has its role and text; nulls are the earliest turn.
    when = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    seen = lines.where("copies > 0").groupBy("conv_id", "role", "digest").agg(F.min(when).alias("first"))
    l, s = lines.alias("l"), seen.alias("s")
    same = F.col("l.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("l.role") == F.col("s.role")) & (F.col("l.digest") == F.col("s.digest"))
    first = F.coalesce(F.col("l.turn").eqNullSafe(F.col("s.first.turn")), F.lit(False))
    found = l.join(s, same, "left").select("l.*", first.alias("first"))
    ordered = found.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.select("conv_id", "turn", "code", "copies", "first").mapInArrow(_search, f"conv_id long, {_AUDIT}")


def _replayed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list | None, str, str]]:
    """(conv_id, counts and audit, "", "") for each conversation, then (conv_id, None, role, text) of its repaired messages."""
    conv_id, edits, at, place = None, "", 0, 0

    def inserted() -> Iterator[tuple]:
        nonlocal at, place
        while edits[at : at + 1] == "I":
            yield conv_id, None, ROLE_AFTER[place], ""
            at, place = at + 1, NEXT[place]

    for new, key, *audit, role, text, copies in _by_conversation(batches):
        if new:
            yield from inserted()
            conv_id, edits, at, place = key, audit[-1], 0, 0
            yield conv_id, audit, "", ""
            continue
        for _ in repeat(None, copies):
            yield from inserted()
            edit, at = edits[at], at + 1
            if edit == "K":
                yield conv_id, None, role, text
                place = _KEPT[place, INITIALS.index(role[0])]
            elif edit == "R":
                yield conv_id, None, ROLE_AFTER[place], text
                place = NEXT[place]
    yield from inserted()


def _messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[list]:
        position = 0
        for conv_id, head, role, text in _replayed(batches):
            position = 0 if head else position + 1
            if not head:
                yield [conv_id, position, role, text]

    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    yield from _in_batches(rows(), schema)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[list]:
        row, total, started = None, hashlib.sha256(), False
        for conv_id, head, role, text in _replayed(batches):
            if head:
                if row:
                    yield [*row, total.hexdigest()]
                row, total, started = [conv_id, *head], hashlib.sha256(), False
                continue
            total.update(f"{chr(10) if started else ''}{role}:{text}".encode())
            started = True
        if row:
            yield [*row, total.hexdigest()]

    yield from _in_batches(rows(), pa.schema([("conv_id", pa.int64()), *_ARROW_AUDIT, ("repaired_sha256", pa.string())]))


def _apply(rows: DataFrame, audited: DataFrame, apply: Callable, schema: str) -> DataFrame:
    names = [*_COUNTS, "audit"]
    heads = audited.select("conv_id", *names, F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"), F.lit(0).cast("long").alias("copies"),
                           F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit(None).cast("binary").alias("digest"))
    kinds = dict(audited.dtypes)
    body = rows.where("copies > 0").select("conv_id", *(F.lit(None).cast(kinds[c]).alias(c) for c in names), "role", "text", "copies",
                                           F.lit(1).alias("kind"), "turn", _digest().alias("digest"))
    both = heads.unionByName(body).repartition("conv_id")
    ordered = both.sortWithinPartitions("conv_id", "kind", F.asc_nulls_first("turn"), "role", "digest")
    return ordered.select("conv_id", *names, "role", "text", "copies").mapInArrow(apply, schema)


def repaired_messages(rows: DataFrame, audited: DataFrame | None = None) -> DataFrame:
    """(conv_id, position, role, text) of the repaired conversations, positions from 1."""
    return _apply(rows, audits(rows) if audited is None else audited, _messages, "conv_id long, position long, role string, text string")


def repair(rows: DataFrame) -> DataFrame:
    """``audits`` with ``repaired_sha256``: of the repaired ``role:text`` lines, joined by newlines.

    Without rows left: zeros, an empty audit and the hash of the empty string. An empty
    table gives no rows.
    """
    return _apply(rows, audits(rows), _digests, f"conv_id long, {_AUDIT}, repaired_sha256 string")


def damage(conversations: DataFrame) -> DataFrame:
    """``rows_of`` the table with every fifth row or so damaged, by ``crc32(conv_id:turn) % 20``.

    0 drops the row (no copies), 1 empties its text, 2 removes its ``.!?``, 3 repeats it, 4
    makes it the user's. Nulls are one space, in the hashed text too.
    """
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.pmod(F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn")).cast("binary")), F.lit(20))
    rows = rows_of(conversations, F.when(how == 0, 0).when(how == 3, 2).otherwise(1)).withColumn("how", how)
    text = F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), "copies")
