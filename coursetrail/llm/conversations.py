"""Repairing the structure of conversations by weighted CYK interval parsing.

A sound conversation has role initials `(s?(ua)+)?`. Each row may be kept, given the role that fits, or deleted, and empty rows may be
inserted; the cheapest edits are looked for, of equally cheap ones those whose initials (D, I, K, R) come first in ASCII.

Grammar. The four states of the pattern's automaton give Chomsky normal form: the nonterminal N[p, q] derives what leads from
state p to q. Rules: N[p, q] -> N[p, r] N[r, q]; N[p, q] -> one row with an edit, or a run of deleted copies; insertions are rules without
a row. They are folded into the cells beforehand (insertion closure), so no cell needs an empty span. The start symbol is N[0, 0] or N[0, 3].

Cells. A span of rows has a cell: the least (cost, audit) of every nonterminal, minimal over states r in the middle. Audits of one span with
equal cost are never one the other's beginning (they hold as many rows, and each further insertion costs), so the order of two of them
stays when something is put before or behind both: least parts make least wholes. N[p, q] is there for every span, so every split of
a span gives the same cell, and one split is enough: spans grow from the bottom up by doubling their length, n - 1 products of cells for n rows.

Scale. A text that a conversation repeats goes once with its words; further copies are counted per turn before they are shuffled and go without
words. Rows are dealt into ranges of (conversation, turn), so a conversation of any size spreads over many tasks. A short conversation that
lies within one task ends there. Others leave a cell and the rows of each `CHUNK` rows, and these are put together from left to right by their cells.
That last pass is a stream: it holds four open parses, which soon agree on all but their ends, and the running SHA-256 of each. The digest of
a text is a sequential thing, so this one pass over the rows of a very long conversation is one task's.

Defined results. Nulls: a null role or text counts as one space, a null conversation is one of its own, null turns come first. Rows of one
turn stand in the order of role, then of the text's MD5. An empty table gives an empty result. Further columns play no part.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from os.path import commonprefix

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coursetrail.llm.order import parts
from coursetrail.session import stored

CHUNK = 256  # rows
CHUNK_CHARS = 1 << 20
SPACE = " \t\n\v\f\r"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
# States: nothing yet, after the system's turn, after the user's, after the assistant's.
STATES, FINAL = range(4), (0, 3)
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
EXPECTED = ("user", "user", "assistant", "user")  # what is inserted, or what a row is made, in a state
LEGAL = frozenset(("su", "ua", "au"))

Cell = dict[tuple[int, int], tuple[int, str]]


def _least(cell: Cell, pair: tuple[int, int], value: tuple[int, str]) -> None:
    if pair not in cell or value < cell[pair]:
        cell[pair] = value


def product(left: Cell, right: Cell) -> Cell:
    """The cell of a span from those of its two parts."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            after = right.get((r, q))
            if after is not None:
                _least(out, (p, q), (cost + after[0], audit + after[1]))
    return out


def _insertions() -> Cell:
    """The cell of the empty span: nothing, or rows put in."""
    cell: Cell = {(p, p): (0, "") for p in STATES}
    for p in STATES:
        q, letters = p, ""
        for _ in STATES:
            q, letters = NEXT[q, EXPECTED[q][0]], letters + "I"
            _least(cell, (p, q), (INSERT * len(letters), letters))
    return cell


NOTHING = _insertions()


def closed(cell: Cell) -> Cell:
    """The cell with insertions before and behind."""
    return product(product(NOTHING, cell), NOTHING)


def deleted(copies: int) -> Cell:
    """The cell of rows that have to go."""
    return closed({(p, p): (DELETE * copies, "D" * copies) for p in STATES})


def row_cell(initial: str, truncated: bool) -> Cell:
    """The cell of a row that may stay."""
    cell: Cell = {(p, p): (DELETE, "D") for p in STATES}
    for p in STATES:
        _least(cell, (p, NEXT[p, EXPECTED[p][0]]), (REROLE + TRUNCATED * truncated, "R"))
        if (p, initial) in NEXT:
            _least(cell, (p, NEXT[p, initial]), (KEEP + TRUNCATED * truncated, "K"))
    return closed(cell)


KEPT = {(x, t): row_cell(x, t) for x in ("s", "u", "a", "") for t in (False, True)}
GONE = deleted(1)


def parsed(cells: list[Cell]) -> Cell:
    """The cell of a whole span; neighbouring spans are put together, of doubling length."""
    if not cells:
        return NOTHING
    while len(cells) > 1:
        cells = [product(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0]


@dataclass
class Chunk:
    """Some rows in a row: counts, their cell, and what is needed to write them out."""

    conv: object
    turns: int = 0
    low: int | None = None
    high: int | None = None
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    first: str | None = None  # initial of the first row
    last: str | None = None
    rows: list[tuple[str, str, int]] = field(default_factory=list)  # (role, text, 0), or (initial, '', copies that have to go)
    cell: Cell | None = None
    chars: int = 0
    cells: list[Cell] = field(default_factory=list)

    def _follow(self, initial: str, copies: int) -> None:
        if self.last is not None:
            self.illegal += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.illegal += copies - 1  # a row beside its copy
        self.last = initial

    def turn(self, turn: int | None) -> None:
        if turn is not None and turn != self.high:
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn

    def keep(self, role: str, text: str, truncated: bool) -> None:
        initial = role[:1]
        self._follow(initial, 1)
        self.truncated += truncated
        self.rows.append((role, text, 0))
        self.chars += len(role) + len(text)
        self.cells.append(KEPT[initial if initial in "sua" else "", truncated])

    def drop(self, role: str, copies: int, blank: bool) -> None:
        self._follow(role[:1], copies)
        if blank:
            self.blank += copies
        else:
            self.duplicate += copies
        self.rows.append(("", "", copies))
        self.cells.append(GONE if copies == 1 else deleted(copies))

    def end(self) -> Chunk:
        self.cell, self.cells = parsed(self.cells), []
        return self

    def written(self) -> str:
        cell = [[p, q, cost, audit] for (p, q), (cost, audit) in self.cell.items()]
        return json.dumps([self.turns, self.low, self.high, self.blank, self.duplicate, self.truncated, self.illegal, self.first, self.last, self.rows, cell])

    @classmethod
    def read(cls, conv: object, data: str) -> Chunk:
        *counts, rows, cell = json.loads(data)
        return cls(conv, *counts, [tuple(r) for r in rows], {(p, q): (cost, audit) for p, q, cost, audit in cell})


def repaired(state: int, audit: str, rows: list[tuple[str, str, int]]) -> Iterator[str]:
    """The rows after the edits of an audit that begins in a state, each `role:text`."""
    at = iter(rows)
    left = 0  # copies still to be deleted
    for letter in audit:
        role, text = "", ""
        if letter != "I":
            if not left:
                role, text, left = next(at)
            if letter == "D":
                left = max(0, left - 1)
                continue
        if letter != "K":
            role = EXPECTED[state]
        state = NEXT[state, role[0]]
        yield f"{role}:{text}"


@dataclass
class Open:
    """A parse from the start of a conversation to a state."""

    cost: int
    audit: str  # since the part that all open parses share
    digest: object
    any: bool = False

    def extended(self, state: int, cost: int, audit: str, rows: list[tuple[str, str, int]]) -> Open:
        digest, some = self.digest.copy(), self.any
        for line in repaired(state, audit, rows):
            digest.update(b"\n" * some + line.encode())
            some = True
        return Open(self.cost + cost, self.audit + audit, digest, some)


class Conversation:
    """Chunks of one conversation put together from left to right."""

    def __init__(self, conv: object):
        self.conv, self.settled = conv, []
        self.sum = Chunk(conv)
        self.open: dict[int, Open] = {0: Open(0, "", hashlib.sha256())}

    def add(self, chunk: Chunk) -> None:
        s = self.sum
        s.turns += chunk.turns - (s.high is not None and s.high == chunk.low)
        s.low, s.high = chunk.low if s.low is None else s.low, s.high if chunk.high is None else chunk.high
        s.blank, s.duplicate, s.truncated = s.blank + chunk.blank, s.duplicate + chunk.duplicate, s.truncated + chunk.truncated
        s.illegal += chunk.illegal
        if chunk.first is not None:
            s.illegal += s.last is not None and s.last + chunk.first not in LEGAL
            s.last = chunk.last
        if not chunk.rows:
            return
        found: dict[int, tuple[tuple[int, str], int]] = {}
        for p, o in self.open.items():
            for q in STATES:
                if (p, q) in chunk.cell:
                    cost, audit = chunk.cell[p, q]
                    value = (o.cost + cost, o.audit + audit)
                    if q not in found or value < found[q][0]:
                        found[q] = value, p
        self.open = {q: self.open[p].extended(p, *chunk.cell[p, q], chunk.rows) for q, (_, p) in found.items()}
        shared = commonprefix([o.audit for o in self.open.values()])
        self.settled.append(shared)
        for o in self.open.values():
            o.audit = o.audit[len(shared):]

    def result(self) -> tuple:
        best = min((self.open[q] for q in FINAL if q in self.open), key=lambda o: (o.cost, o.audit))
        return _result(self.sum, best.cost, "".join(self.settled) + best.audit, best.digest.hexdigest())


def _result(chunk: Chunk, cost: int, audit: str, digest: str) -> tuple:
    gaps = chunk.high - chunk.low + 1 - chunk.turns if chunk.turns else 0
    return chunk.conv, gaps, chunk.blank, chunk.duplicate, chunk.truncated, chunk.illegal, cost, audit, digest


def whole(chunk: Chunk) -> tuple:
    """The result of a conversation that is one chunk."""
    cost, audit = min(chunk.cell[0, q] for q in FINAL if (0, q) in chunk.cell)
    return _result(chunk, cost, audit, hashlib.sha256("\n".join(repaired(0, audit, chunk.rows)).encode()).hexdigest())


# ---------------------------------------------------------------- rows


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies): rows with faults planted by CRC-32 of their place; copies 0: the row is gone."""
    def spaced(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))

    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return rows.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
                       text.alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def _events(rows: DataFrame) -> DataFrame:
    """What a conversation consists of: the first row of each role and text, with the text; copies of a row in a turn, counted and without it."""
    keyed = rows.select("*", F.md5("text").alias("digest"), (F.btrim("text", F.lit(SPACE)) == "").alias("blank"))
    none = F.lit(None).cast("string")
    firsts = (keyed.where("copies > 0 AND NOT blank").groupBy("conv_id", "role", "digest")
              .agg(F.min(F.struct(F.col("turn").isNotNull().alias("known"), "turn")).alias("place"), F.first("text").alias("text")))
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    firsts = firsts.select("conv_id", "place.turn", "role", "digest", F.lit(0).alias("kind"), "text", (~last.isin(".", "!", "?")).alias("truncated"),
                           F.lit(0).cast("bigint").alias("copies"), F.lit(False).alias("blank"))
    gone = F.col("copies") == 0
    counts = keyed.groupBy("conv_id", F.when(~gone, F.col("turn")).alias("turn"), F.when(gone, "").otherwise(F.col("role")).alias("role"),
                           F.when(gone, "").otherwise(F.col("digest")).alias("digest")).agg(
        F.sum("copies").alias("copies"), F.first("blank").alias("blank"))
    counts = counts.select("conv_id", "turn", "role", "digest", F.lit(1).alias("kind"), none.alias("text"), F.lit(False).alias("truncated"), "copies", "blank")
    return firsts.unionByName(counts)


RESULT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
COLUMNS = [c.split()[0] for c in RESULT.split(", ")]
ARROW = [pa.int64()] * 7 + [pa.string()] * 2 + [pa.int64(), pa.string()]


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Chunk, bool]]:
    """(chunk, whether it ends its conversation in this task) for events in order."""
    chunk, before = None, False  # before: the row in hand came with its text
    for batch in batches:
        for conv, turn, role, _, kind, text, truncated, copies, blank in zip(*(batch.column(i).to_pylist() for i in range(9)), strict=True):
            if chunk is None or conv != chunk.conv:
                if chunk is not None:
                    yield chunk.end(), True
                chunk, before = Chunk(conv), False
            elif not before and (len(chunk.rows) >= CHUNK or chunk.chars >= CHUNK_CHARS):
                yield chunk.end(), False
                chunk = Chunk(conv)
            if kind == 0:
                chunk.turn(turn)
                chunk.keep(role, text, truncated)
                before = True
                continue
            if copies:
                chunk.turn(turn)
            if copies > before:
                chunk.drop(role, copies - before, blank)
            before = False
    if chunk is not None:
        yield chunk.end(), True


def repairs(rows: DataFrame) -> DataFrame:
    """The repair of every conversation of rows (conv_id, turn, role, text, copies); see `damaged`."""
    def batch_of(found: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*found, strict=True), ARROW, strict=False)],
                               names=[*COLUMNS, "place", "chunk"][:len(found[0])])

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, found, size = TaskContext.get().partitionId(), 0, [], 0
        held, alone, edge, starts = None, True, True, True

        def settle(last: bool) -> None:
            # What begins or ends the task may go on in a neighbouring one, and a long conversation has more chunks.
            nonlocal number, size
            if held is not None and alone and not edge and not last:
                found.append((*whole(held), None, None))
            elif held is not None:
                found.append((held.conv, *[None] * (len(COLUMNS) - 1), part << 32 | number, held.written()))
                number, size = number + 1, size + held.chars
            size += 200

        for chunk, ends in _chunks(batches):
            settle(False)
            edge = held is None or not starts and edge
            held, alone, starts = chunk, starts and ends, ends
            if size > 1 << 22 and found:
                yield batch_of(found)
                found, size = [], 0
        settle(True)
        if found:
            yield batch_of(found)

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, found = None, []
        for batch in batches:
            for conv, data in zip(batch.column("conv_id").to_pylist(), batch.column("chunk").to_pylist(), strict=True):
                if one is None or one.conv != conv:
                    found += [one.result()] if one else []
                    one = Conversation(conv)
                one.add(Chunk.read(conv, data))
            if found:
                yield batch_of(found)
                found = []
        if one is not None:
            yield batch_of([one.result()])

    count = parts(rows)
    dealt = (_events(rows).repartitionByRange(count, "conv_id", "turn", "role", "digest")
             .sortWithinPartitions("conv_id", "turn", "role", "digest", "kind"))
    found = stored(dealt.mapInArrow(first, RESULT + ", place bigint, chunk string"), "conversations")
    chunks = found.where("chunk IS NOT NULL").select("conv_id", "place", "chunk")
    ends = chunks.repartition(count, "conv_id").sortWithinPartitions("conv_id", "place").mapInArrow(rest, RESULT)
    return found.where("chunk IS NULL").select(*COLUMNS).unionByName(ends)
