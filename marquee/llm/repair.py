"""Conversation structure repair by weighted CYK interval parsing (operator 13).

Method.  Repaired conversations read ``(s?(ua)+)?`` in role initials, an automaton of four states.  The repair grammar
in Chomsky normal form has one symbol per pair of states, [p,q] -> [p,r] [r,q]; a row derives [p,q] by an edit, an
insertion derives [p,q] from nothing, and the insertions' closure stands before every row.  A span's cell holds, per
symbol, the cheapest derivation and its audit (the edits' initials), the least one of equal cost.  Every derivation of
a span by such symbols passes some state at each of its split points, so all split points of a span give the same cell
and one is enough: cells are combined bottom-up by span length, spans of one row, two, four and so on.  Within one
span and pair of states no audit of equal cost is a prefix of another (the rest would be insertions, which cost), so
least parts make least wholes.

Rows get their place by a range sort.  Blocks of at most ``BLOCK`` neighbouring rows are parsed in parallel, also those
of one conversation; the blocks' cells of a conversation are then combined in the same way.  The repaired text is
hashed while its rows stream by; no conversation's texts are brought together.  Audits are one value per conversation,
so a task must hold those of its longest conversation (one byte per row, by eleven symbols).

Defined results: a null role or text is one space; rows of one turn are in order of role and text; repeated rows are
counted; a null turn comes first, a null conv_id is one conversation of its own; roles of other initials than s, u, a
are reroled or deleted; very long texts are only read by Spark's own functions and a running hash; an empty table
gives no rows; other columns do not matter.
"""

from __future__ import annotations

import functools
import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import parallelism, stored
from .line_dedup import BLANKS

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
BLOCK = 1024                 # rows that a task parses at once, of one conversation
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
FINAL = (START, ASSISTANT)
LEGAL = ("su", "ua", "au")
#: The symbols that derive anything: pairs of states with a way from the first to the second.
SYMBOLS = [(p, q) for p in range(4) for q in range(4) if p == q or (q >= USER or (p, q) == (START, SYSTEM))]
_INDEX = {s: k for k, s in enumerate(SYMBOLS)}
_RULES = [[(_INDEX[p, r], _INDEX[r, q]) for r in range(4) if (p, r) in _INDEX and (r, q) in _INDEX] for p, q in SYMBOLS]

# A cell is a tuple over SYMBOLS of (cost, audit) or None.


def combine(left: tuple, right: tuple) -> tuple:
    """The cell of two neighbouring spans."""
    out = []
    for rules in _RULES:
        best = None
        for i, j in rules:
            x, y = left[i], right[j]
            if x is not None and y is not None and (best is None or x[0] + y[0] <= best[0]):
                new = (x[0] + y[0], x[1] + y[1])
                best = new if best is None or new < best else best
        out.append(best)
    return tuple(out)


def _cell(derived: dict) -> tuple:
    return tuple(derived.get(s) for s in SYMBOLS)


@functools.lru_cache(maxsize=1)
def insertions() -> tuple:
    """The closure of insertions: the cell of the empty span."""
    cell = _cell({(p, p): (0, "") for p in range(4)})
    once = _cell({(p, p): (0, "") for p in range(4)} | {(p, q): (INSERT, "I") for (p, x), q in STEPS.items() if x != "s"})
    while (more := combine(cell, once)) != cell:
        cell = more
    return cell


@functools.lru_cache(maxsize=1024)
def row_cell(initial: str, truncated: bool, deleted: bool) -> tuple:
    """The cell of one row, with the insertions before it; ``deleted``: it must go."""
    derived = {(p, p): (DELETE, "D") for p in range(4)}
    extra = TRUNCATED if truncated else 0
    for (p, x), q in () if deleted else STEPS.items():
        ways = [(extra, "K")] if x == initial else []
        ways += [(REROLE + extra, "R")] if x != "s" else []
        derived.update({(p, q): min(ways)} if ways else {})
    return combine(insertions(), _cell(derived))


@functools.lru_cache(maxsize=1024)
def copies_cell(n: int) -> tuple:
    """The cell of ``n`` rows that must go, by halves."""
    return row_cell("", False, True) if n == 1 else combine(copies_cell(n // 2), copies_cell(n - n // 2))


class Spans:
    """Spans of a conversation in order: neighbours of equal level are combined, so a cell meets log(n) others."""

    def __init__(self):
        self.stack: list[tuple[int, tuple]] = []

    def add(self, cell: tuple) -> None:
        level = 0
        while self.stack and self.stack[-1][0] == level:
            cell, level = combine(self.stack.pop()[1], cell), level + 1
        self.stack.append((level, cell))

    def whole(self) -> tuple:
        cells = [c for _, c in self.stack]
        out = cells.pop()
        while cells:
            out = combine(cells.pop(), out)
        return out


def cheapest(cell: tuple) -> tuple[int, str]:
    """Cost and audit of a whole conversation's cell (insertions after its last row included)."""
    whole = combine(cell, insertions())
    return min(whole[_INDEX[START, q]] for q in FINAL if whole[_INDEX[START, q]] is not None)


# ------------------------------------------------------------------ damage and faults

def damaged(turns: DataFrame) -> DataFrame:
    """(conv, turn, role, text, copies) of the rows after damage; ``conv`` is a string key that null has as well."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))) % 20
    rows = turns.select(conv_key(F.col("conv_id")).alias("conv"), F.col("turn").cast("long").alias("turn"),
                        blank("role").alias("role"), blank("text").alias("text"), kind.alias("kind")).where("kind != 0")
    return rows.select(
        "conv", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(
            F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, 2).otherwise(1).alias("copies"))


def conv_key(conv: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv.cast("string")), F.lit(""))


def ordered(rows: DataFrame) -> DataFrame:
    """The distinct ``rows(conv, turn, role, text, copies)`` with ``seq``, ascending by conversation, turn, role, text."""
    n = parallelism(rows.sparkSession)
    rows = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.repartitionByRange(n, "conv", F.asc_nulls_first("turn"), "role", "text")
    rows = rows.sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    return stored(rows.withColumn("seq", F.monotonically_increasing_id()), "ordered")


def faults(rows: DataFrame) -> DataFrame:
    """(conv, seq, copies, initial, blank, truncated, repeated) of ``ordered`` rows: the first copy's faults.

    A text's first place in a conversation is a minimum over salted parts, so a text that one conversation repeats
    without end stays spread.
    """
    n = parallelism(rows.sparkSession)
    bare = F.rtrim("text", F.lit(BLANKS))
    thin = rows.select(
        "conv", "seq", "copies", F.substring("role", 1, 1).alias("initial"), (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("truncated"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit("second"), "text", "role").alias("h2"),
        F.pmod(F.xxhash64("seq"), F.lit(n)).alias("salt"))
    keys = ["conv", "h1", "h2"]
    part = thin.where("not blank").groupBy(*keys, "salt").agg(F.min("seq").alias("least"))
    first = part.select(*keys, "salt", F.min("least").over(Window.partitionBy(*keys)).alias("first"))
    return thin.join(first, [*keys, "salt"], "left").select(
        "conv", "seq", "copies", "initial", "blank", "truncated",
        F.coalesce(F.col("seq") > F.col("first"), F.lit(False)).alias("repeated"))


# ------------------------------------------------------------------ parsing

_CELL = "costs array<long>, audits array<string>"
_BLOCKS = f"conv string, block long, blank long, duplicate long, truncated long, illegal long, first string, last string, {_CELL}"
_PARSED = "conv string, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _runs(batches, names, key):
    """Consecutive rows (tuples of ``names``) of equal first ``key`` values, as (key, rows) pieces; a run may come in several."""
    for batch in batches:
        rows = list(zip(*(batch.column(c).to_pylist() for c in names)))
        at = 0
        for k in range(1, len(rows) + 1):
            if k == len(rows) or rows[k][:key] != rows[at][:key]:
                yield rows[at][:key], rows[at:k]
                at = k


class _Part:
    """Counts and cells of neighbouring rows of a conversation, or of neighbouring parts."""

    def __init__(self):
        self.spans, self.counts, self.first, self.last = Spans(), [0, 0, 0, 0], None, None

    def _meet(self, first: str, last: str) -> None:
        if self.first is None:
            self.first = first
        elif self.last + first not in LEGAL:
            self.counts[3] += 1
        self.last = last

    def row(self, copies: int, initial: str, blank: bool, truncated: bool, repeated: bool) -> None:
        again = copies if blank or repeated else copies - 1
        self._meet(initial, initial)
        if not (blank or repeated):
            self.counts[2] += truncated
            self.spans.add(row_cell(initial, truncated, False))
        if again:
            self.counts[0 if blank else 1] += again
            self.spans.add(copies_cell(again))
        self.counts[3] += copies - 1                       # uu, aa, ss and others are all illegal

    def part(self, counts, first: str, last: str, cell: tuple) -> None:
        self._meet(first, last)
        self.counts = [a + b for a, b in zip(self.counts, counts)]
        self.spans.add(cell)


def _pack(cell: tuple) -> tuple[list, list]:
    return [x and x[0] for x in cell], [x and x[1] for x in cell]


def block_cells(thin: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per block: ``seq`` runs on within a partition of the range sort, so a block's rows are neighbours."""
    rows = thin.withColumn("block", F.col("seq") - F.col("seq") % block)
    rows = rows.repartition("conv", "block").sortWithinPartitions("conv", "block", "seq")

    def run(batches):
        key, part, out = None, None, []

        def finished():
            costs, audits = _pack(part.spans.whole())
            out.append((*key, *part.counts, part.first, part.last, costs, audits))

        for name, found in _runs(batches, ("conv", "block", "copies", "initial", "blank", "truncated", "repeated"), 2):
            if name != key:
                if key is not None:
                    finished()
                key, part = name, _Part()
            for r in found:
                part.row(*r[2:])
            if len(out) >= 1000:
                yield _batch(out, _BLOCKS)
                out = []
        if key is not None:
            finished()
        yield _batch(out, _BLOCKS)

    return rows.mapInArrow(run, _BLOCKS)


_KINDS = {"string": pa.string(), "long": pa.int64(), "array<long>": pa.list_(pa.int64()),
          "array<string>": pa.list_(pa.string())}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")))
    cols = zip(*rows) if rows else ((),) * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, _KINDS[k]) for c, k in zip(cols, kinds)], list(names))


def parsed(blocks: DataFrame) -> DataFrame:
    """One row per conversation from its blocks' cells."""

    def run(batches):
        key, part, out = None, None, []

        def finished():
            out.append((*key, *part.counts, *cheapest(part.spans.whole())))

        names = ("conv", "blank", "duplicate", "truncated", "illegal", "first", "last", "costs", "audits")
        for name, found in _runs(batches, names, 1):
            if name != key:
                if key is not None:
                    finished()
                key, part = name, _Part()
            for r in found:
                cell = tuple(None if a is None else (c, a) for c, a in zip(r[7], r[8]))
                part.part(r[1:5], r[5], r[6], cell)
            if len(out) >= 1000:
                yield _batch(out, _PARSED)
                out = []
        if key is not None:
            finished()
        yield _batch(out, _PARSED)

    return blocks.repartition("conv").sortWithinPartitions("conv", "block").mapInArrow(run, _PARSED)


# ------------------------------------------------------------------ repaired conversations

def repaired_hashes(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv, sha256): rows and audits meet by conversation, the audit first, and stream through a running hash."""
    told = audits.select("conv", F.lit(-1).cast("long").alias("seq"), F.lit(0).cast("long").alias("copies"),
                         F.lit("").alias("role"), F.col("audit").alias("text"))
    both = rows.select("conv", "seq", "copies", "role", "text").unionByName(told)
    both = both.repartition("conv").sortWithinPartitions("conv", "seq")

    def run(batches):
        key, tape, out = None, None, []
        for name, found in _runs(batches, ("conv", "seq", "copies", "role", "text"), 1):
            if name != key:
                if key is not None:
                    out.append((*key, tape.finished()))
                key, tape = name, Tape()
            for _, seq, copies, role, text in found:
                if seq < 0:
                    tape.audit = text
                else:
                    tape.row(copies, role, text)
            if len(out) >= 1000:
                yield _batch(out, "conv string, sha string")
                out = []
        if key is not None:
            out.append((*key, tape.finished()))
        yield _batch(out, "conv string, sha string")

    return both.mapInArrow(run, "conv string, sha string")


class Tape:
    """Plays an audit over a conversation's rows in order and hashes the repaired rows."""

    def __init__(self, audit: str = "", say=None):
        self.audit, self.at, self.last, self.empty = audit, 0, "", True
        self.hash, self.say = hashlib.sha256(), say

    def _write(self, role: str, text: str) -> None:
        self.hash.update((("" if self.empty else "\n") + f"{role}:{text}").encode())
        self.empty, self.last = False, role[:1]
        if self.say is not None:
            self.say.append((role, text))

    def _next(self) -> str:
        return "assistant" if self.last == "u" else "user"

    def _insert(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self._write(self._next(), "")
            self.at += 1

    def row(self, copies: int, role: str, text: str) -> None:
        for _ in range(copies):
            self._insert()
            edit, self.at = self.audit[self.at], self.at + 1
            if edit != "D":
                self._write(role if edit == "K" else self._next(), text)

    def finished(self) -> str:
        self._insert()
        return self.hash.hexdigest()


def repair_conversations(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation of
    ``turns(conv_id, turn, role, text)``."""
    rows = ordered(damaged(turns))
    per_turn = rows.groupBy("conv", "turn").agg(F.count(F.lit(1)).alias("_n"))
    gaps = per_turn.groupBy("conv").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))
    found = stored(parsed(stored(block_cells(faults(rows), block), "cells")), "parsed")
    hashes = repaired_hashes(rows, found.select("conv", "audit"))
    every = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).select(
        "conv_id", conv_key(F.col("conv_id")).alias("conv"))
    out = every.join(found, "conv", "left").join(gaps, "conv", "left").join(hashes, "conv", "left")
    zero = F.lit(0).cast("long")
    return out.select("conv_id", *(F.coalesce(c, zero).alias(c) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
