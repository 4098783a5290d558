"""Repair of conversations by weighted interval parsing with a Chomsky-normal-form grammar.

A repaired conversation is empty, or pairs of a user's and an assistant's turn, possibly after one turn of the system. The
four states of such a text (nothing, system, user spoke last, assistant spoke last) give the nonterminals: (p, q) derives a
span of turns that leads from state p to q. Terminals are the edits of one turn (keep, change of role, delete), (p, q) ->
(p, r) (r, q) are the binary rules, and insertions are closed over every span of one turn, so that later spans need no more
of them. A cell holds the least (cost, audit) of its span, the audit being the edits' letters in order. Cells are combined
bottom-up by span length, each length from the halves below it: every split of a span gives the same cell, since binary
rules are associative, and audits of equal cost and span are never prefixes of each other, so least audits join to least ones.

Turns are dealt by ranges of (conversation, turn), so that one conversation of any length is spread over many tasks. A task
parses the conversations that lie inside its range. Those at its ends, at most two, may go on elsewhere: their duplicates
are found by grouping, every range gives the cells of its part, the parts are combined, and the edits are applied in a
stream of the sorted turns which holds one turn at a time. Only that last step, whose result is one digest or one ordered
text, takes a conversation in one task.

Defined results: null roles and texts are one space; turns without a number come first; rows of one turn are ordered by role,
then by the digest of the text; rows without a conv_id are one conversation; rows that repeat another are duplicates; texts
may be of any length; without rows there are no conversations; other columns, whatever their names, are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ouvidoria.llm.common import partitions, staged

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
_SPACE = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")
_ROLES = {"u": "user", "a": "assistant"}

# States: 0 nothing said yet, 1 system, 2 a user spoke last, 3 an assistant spoke last.
_STATES = range(4)
_STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_NEXT_ROLE = {0: "u", 1: "u", 2: "a", 3: "u"}
_FINAL = (0, 3)

# A cell: for every (from, to), at 4 * from + to, the least (cost, audit), or None.
Cell = tuple


# --- the grammar ------------------------------------------------------------------------------------------------------


def joined(left: Cell, right: Cell) -> Cell:
    """Binary rules: the cell of two spans that follow each other."""
    out = [None] * 16
    for p in _STATES:
        for r in _STATES:
            a = left[4 * p + r]
            if a is None:
                continue
            for q in _STATES:
                b = right[4 * r + q]
                if b is not None:
                    found = (a[0] + b[0], a[1] + b[1])
                    if out[4 * p + q] is None or found < out[4 * p + q]:
                        out[4 * p + q] = found
    return tuple(out)


def _insertions() -> Cell:
    """What insertions alone derive: the cell of the empty span."""
    step = [None] * 16
    for p in _STATES:
        step[5 * p] = (0, "")
        for role in "ua":
            if (p, role) in _STEP:
                step[4 * p + _STEP[p, role]] = (INSERT, "I")
    cell = tuple(step)
    while (more := joined(cell, cell)) != cell:
        cell = more
    return cell


EMPTY = _insertions()


def terminal(initial: str, must_go: bool, truncated: bool) -> Cell:
    """The edits of one turn, with insertions around it."""
    out = [None] * 16
    for p in _STATES:
        out[5 * p] = (DELETE, "D")
        if must_go:
            continue
        extra = TRUNCATED if truncated else 0
        for role in "ua":
            if (p, role) in _STEP:
                out[4 * p + _STEP[p, role]] = (REROLE + extra, "R")
        if (p, initial) in _STEP:
            out[4 * p + _STEP[p, initial]] = (KEEP + extra, "K")
    return joined(joined(EMPTY, tuple(out)), EMPTY)


class Parser:
    """Cells by number; joins of short spans are remembered, since most conversations have the same few shapes."""

    REMEMBERED = 200_000
    SHORT = 16

    def __init__(self):
        self._forget()

    def _forget(self) -> None:
        self.cells: list[tuple[Cell, int]] = []
        self.number: dict[Cell, int] = {}
        self.known: dict[tuple[int, int], int] = {}
        self.leaves: dict[tuple, int] = {}

    def _add(self, cell: Cell, size: int) -> int:
        if cell not in self.number:
            self.number[cell] = len(self.cells)
            self.cells.append((cell, size))
        return self.number[cell]

    def _join(self, a: int, b: int) -> int:
        found = self.known.get((a, b))
        if found is None:
            (x, m), (y, n) = self.cells[a], self.cells[b]
            found = self.known[a, b] = self._add(joined(x, y), m + n)
        return found

    def span(self, turns: list[tuple[str, bool, bool]]) -> Cell:
        """The cell of turns (initial, must go, truncated), by doubling span lengths."""
        if len(self.cells) + len(self.known) > self.REMEMBERED:
            self._forget()
        level = []
        for t in turns:
            at = self.leaves.get(t)
            if at is None:
                at = self.leaves[t] = self._add(terminal(*t), 1)
            level.append(at)
        length = 1
        while len(level) > 1 and length < self.SHORT:
            pairs = [self._join(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
            level = pairs + level[2 * len(pairs) :]
            length *= 2
        return combined([self.cells[i][0] for i in level])


def combined(cells: list[Cell]) -> Cell:
    """The cell of spans that follow each other, by doubling span lengths."""
    while len(cells) > 1:
        pairs = [joined(a, b) for a, b in zip(cells[::2], cells[1::2], strict=False)]
        cells = pairs + cells[2 * len(pairs) :]
    return cells[0] if cells else EMPTY


def repeated(cell: Cell, times: int) -> Cell:
    """The cell of a span that stands ``times`` times, in as many joins as the number has bits."""
    out = None
    while times:
        if times & 1:
            out = cell if out is None else joined(out, cell)
        times >>= 1
        if times:
            cell = joined(cell, cell)
    return out or EMPTY


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the best whole conversation."""
    return min(found for q in _FINAL if (found := cell[q]) is not None)


def edited(audit: str, turns: Iterable[tuple]) -> Iterator[tuple]:
    """(edit, role, text, turn) of what stays, from turns (turn, role, text) in order; inserted turns have no number."""
    state, rows = 0, iter(turns)
    for edit in audit:
        if edit == "I":
            role = _NEXT_ROLE[state]
            yield edit, _ROLES[role], "", None
        else:
            turn, own, text = next(rows)
            if edit == "D":
                continue
            role = own[:1] if edit == "K" else _NEXT_ROLE[state]
            yield edit, own if edit == "K" else _ROLES[role], text, turn
        state = _STEP[state, role]


# --- faults -----------------------------------------------------------------------------------------------------------


class Report:
    """Counts over a part of a conversation, turn by turn; parts that follow each other can be added."""

    FIELDS = (
        "gap_low gap_high first_turn last_turn turns blank duplicate truncated illegal first_initial last_initial".split()
    )

    def __init__(self):
        self.gap_low = self.gap_high = self.first_turn = self.last_turn = self.first_initial = self.last_initial = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0

    def add(self, turn: int | None, role: str, fault: str | None, times: int = 1) -> None:
        initial = role[:1]
        if self.last_initial is not None:
            self.illegal += self.last_initial + initial not in ("su", "ua", "au")
        else:
            self.first_initial = initial
        self.illegal += times - 1
        self.last_initial = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            if self.first_turn is None:
                self.first_turn = self.gap_low = turn
            self.last_turn = self.gap_high = turn
        if fault:
            setattr(self, fault, getattr(self, fault) + times)

    def extend(self, later: dict) -> None:
        if later["first_initial"] is not None:
            if self.last_initial is None:
                self.first_initial = later["first_initial"]
            else:
                self.illegal += self.last_initial + later["first_initial"] not in ("su", "ua", "au")
            self.last_initial = later["last_initial"]
        if later["first_turn"] is not None:
            self.turns -= later["first_turn"] == self.last_turn
            if self.first_turn is None:
                self.first_turn = self.gap_low = later["first_turn"]
            self.last_turn = self.gap_high = later["last_turn"]
        for name in ("turns", "blank", "duplicate", "truncated", "illegal"):
            setattr(self, name, getattr(self, name) + later[name])

    @property
    def gaps(self) -> int:
        return 0 if self.gap_low is None else self.gap_high - self.gap_low + 1 - self.turns

    def values(self) -> dict:
        return {name: getattr(self, name) for name in self.FIELDS}


def faults_of(text: str) -> tuple[bool, bool]:
    """Whether a text is blank, and whether it ends without a mark."""
    bare = text.rstrip(_SPACE)
    return not bare, bare[-1:] not in _ENDS


# --- Spark ------------------------------------------------------------------------------------------------------------

_COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
REPORT = f"conv_id long, {_COUNTS}, repaired_sha256 string"
_PARTS = (
    "conv_id long, part int, gap_low long, gap_high long, first_turn long, last_turn long, turns long, blank long, "
    "duplicate long, truncated long, illegal long, first_initial string, last_initial string, costs array<long>, "
    "audits array<string>"
)
_TURNS = "conv_id long, position long, edit string, turn long, role string, text string"
_KEY = ("conv_id", "turn", "role", "digest")


def prepared(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, turn, role, text, copies and the digest of the text; a row of no copies only names its conversation."""
    return turns.select(
        F.col("conv_id").cast("long"),
        F.col("turn").cast("long"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.lit(1) if copies is None else copies).cast("long").alias("copies"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))


def damaged(conversations: DataFrame) -> DataFrame:
    """Turns with the faults that the checksum of ``conv_id:turn`` decides on; ``copies`` says how often each one stands."""
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate <= 1, F.lit("")).when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(fate == 0, F.lit(0)).when(fate == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def _groups(batches, names: list[str]) -> Iterator[tuple[int | None, Iterator[tuple]]]:
    """Runs of rows with one conv_id, as (conv_id, rows without it); a run must be read before the next."""
    rows = (r for b in batches for r in zip(*(b.column(n).to_pylist() for n in ("conv_id", *names)), strict=True))
    ahead = next(rows, None)
    while ahead is not None:
        conv_id = ahead[0]

        def run(conv_id=conv_id):
            nonlocal ahead
            while ahead is not None and ahead[0] == conv_id:
                yield ahead[1:]
                ahead = next(rows, None)

        current = run()
        yield conv_id, current
        for _ in current:  # whatever was left unread
            pass


def _batch(rows: list[dict], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    kinds |= {"array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    names = [part.split(" ") for part in schema.split(", ")]
    return pa.record_batch([pa.array([r.get(n) for r in rows], kinds[k]) for n, k in names], names=[n for n, _ in names])


def _batches(rows: Iterator[dict], schema: str, at_once: int = 1000, chars: int = 4_000_000):
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, str))
        if len(held) >= at_once or size >= chars:
            yield _batch(held, schema)
            held, size = [], 0
    yield _batch(held, schema)


def digest_of(pairs: Iterable[tuple[str, str]]) -> str:
    """SHA-256 of ``role:text`` lines."""
    sha, first = hashlib.sha256(), True
    for role, text in pairs:
        sha.update(("" if first else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        first = False
    return sha.hexdigest()


def whole_report(conv_id, rows: list[tuple], parser: Parser) -> dict:
    """Counts, cost, audit and digest of a conversation from its rows (turn, role, text) in order."""
    report, seen, units = Report(), set(), []
    for turn, role, text in rows:
        blank, truncated = faults_of(text)
        fault = "blank" if blank else "duplicate" if (role, text) in seen else "truncated" if truncated else None
        seen.add((role, text))
        report.add(turn, role, fault)
        units.append((role[:1] if role[:1] in ("s", "u", "a") else "", fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = cheapest(parser.span(units))
    out = {name: getattr(report, name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal")}
    digest = digest_of((role, text) for _, role, text, _ in edited(audit, rows))
    return out | {"conv_id": conv_id, "cost": cost, "audit": audit, "repaired_sha256": digest}


def _range_reports(dealt: DataFrame) -> DataFrame:
    """Reports of the conversations inside each range; those at its ends come without a digest, as open ones."""

    def run(batches):
        parser = Parser()

        def rows():
            last, first = None, True
            for conv_id, turns in _groups(batches, ["turn", "role", "text", "copies"]):
                if last is not None:
                    yield whole_report(*last, parser)
                if first:  # it may have begun elsewhere, so its turns aren't held
                    first = False
                    yield {"conv_id": conv_id}
                    continue
                last = (conv_id, [(turn, role, text) for turn, role, text, n in turns for _ in range(n)])
            if last is not None:
                yield {"conv_id": last[0]}

        yield from _batches(rows(), REPORT)

    return dealt.mapInArrow(run, REPORT)


def _units(rows: DataFrame) -> DataFrame:
    """One row for equal rows of a turn, with their number and whether the first of them is the first of its conversation."""
    alike = rows.groupBy(*_KEY).agg(F.sum("copies").alias("n"), F.first("text").alias("text"))
    alike = staged(alike.filter("n > 0"), "turns-of-open")
    order = F.struct(F.col("turn").isNotNull().alias("numbered"), "turn")
    firsts = alike.groupBy("conv_id", "role", "digest").agg(F.min(order).alias("f"), F.count(F.lit(1)).alias("places"))
    firsts = firsts.filter("places > 1").select(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("f.turn").alias("first_turn"), F.lit(True).alias("again")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    original = F.col("again").isNull() | F.col("turn").eqNullSafe(F.col("first_turn"))
    return alike.join(firsts, same, "left").select(*_KEY, "n", "text", original.alias("original"))


def _part_reports(units: DataFrame) -> DataFrame:
    """Counts and cells of the part of each conversation that lies in a range."""
    spark = units.sparkSession
    bare = F.rtrim(F.col("text"), F.lit(_SPACE))
    light = units.select(*_KEY, "n", "original", (bare == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(*_ENDS)).alias("truncated"))
    dealt = light.repartitionByRange(partitions(spark), *_KEY).sortWithinPartitions(*_KEY)

    def run(batches):
        parser, gone = Parser(), terminal("", True, False)
        part = TaskContext.get().partitionId()

        def rows():
            for conv_id, turns in _groups(batches, ["turn", "role", "n", "original", "blank", "truncated"]):
                report, cells, held = Report(), [], []
                for turn, role, n, original, blank, truncated in turns:
                    own = original and not blank
                    if own:
                        report.add(turn, role, "truncated" if truncated else None)
                        held.append((role[:1] if role[:1] in ("s", "u", "a") else "", False, truncated))
                        n -= 1
                    if n:
                        report.add(turn, role, "blank" if blank else "duplicate", n)
                        cells += [parser.span(held), repeated(gone, n)]
                        held = []
                    if len(held) >= 4096:
                        cells.append(parser.span(held))
                        held = []
                cell = combined([*cells, parser.span(held)])
                costs = [-1 if c is None else c[0] for c in cell]
                audits = ["" if c is None else c[1] for c in cell]
                yield report.values() | {"conv_id": conv_id, "part": part, "costs": costs, "audits": audits}

        yield from _batches(rows(), _PARTS)

    return dealt.mapInArrow(run, _PARTS)


def _combined_parts(parts: DataFrame) -> DataFrame:
    """Counts, cost and audit of conversations from their parts, which have no texts."""
    names = [part.split(" ")[0] for part in _PARTS.split(", ")][1:]

    def run(batches):
        def rows():
            for conv_id, found in _groups(batches, names):
                report, cells = Report(), []
                for row in found:
                    values = dict(zip(names, row, strict=True))
                    report.extend(values)
                    cells.append(tuple(None if c < 0 else (c, a) for c, a in zip(values["costs"], values["audits"], strict=True)))
                cost, audit = cheapest(combined(cells))
                out = {name: getattr(report, name) for name in ("gaps", "blank", "duplicate", "truncated", "illegal")}
                yield out | {"conv_id": conv_id, "cost": cost, "audit": audit}

        yield from _batches(rows(), f"conv_id long, {_COUNTS}")

    dealt = parts.repartition(partitions(parts.sparkSession), "conv_id").sortWithinPartitions("conv_id", "part")
    return dealt.mapInArrow(run, f"conv_id long, {_COUNTS}")


def _streamed(reports: DataFrame, units: DataFrame, emit, schema: str) -> DataFrame:
    """``emit(report, edited turns)`` for every conversation, whose turns stream by in order."""
    names = [part.split(" ")[0] for part in _COUNTS.split(", ")]
    nothing = {"turn": "long", "role": "string", "digest": "binary", "text": "string", "n": "long"}
    heads = reports.select("conv_id", F.lit(0).alias("kind"), *[F.lit(None).cast(k).alias(c) for c, k in nothing.items()], *names)
    kinds = dict(part.split(" ") for part in _COUNTS.split(", "))
    rows = units.select("conv_id", F.lit(1).alias("kind"), *nothing, *[F.lit(None).cast(kinds[c]).alias(c) for c in names])
    n = partitions(reports.sparkSession)
    order = ("conv_id", "kind", "turn", "role", "digest")
    dealt = heads.unionAll(rows).repartition(n, "conv_id").sortWithinPartitions(*order).drop("digest", "kind")

    def run(batches):
        def out():
            for conv_id, found in _groups(batches, ["turn", "role", "text", "n", *names]):
                head = {"conv_id": conv_id} | dict(zip(names, next(found)[4:], strict=True))
                turns = ((turn, role, text) for turn, role, text, n, *_ in found for _ in range(n))
                yield from emit(head, edited(head["audit"], turns))

        yield from _batches(out(), schema)

    return dealt.mapInArrow(run, schema)


def _digested(head: dict, turns: Iterator[tuple]) -> Iterator[dict]:
    yield head | {"repaired_sha256": digest_of((role, text) for _, role, text, _ in turns)}


def _listed(head: dict, turns: Iterator[tuple]) -> Iterator[dict]:
    for position, (edit, role, text, turn) in enumerate(turns):
        yield {"conv_id": head["conv_id"], "position": position, "edit": edit, "turn": turn, "role": role, "text": text}


def _reports(rows: DataFrame) -> DataFrame:
    spark = rows.sparkSession
    dealt = rows.repartitionByRange(partitions(spark), *_KEY).sortWithinPartitions(*_KEY)
    found = staged(_range_reports(dealt.drop("digest")), "range-reports")
    closed = found.filter(F.col("repaired_sha256").isNotNull())
    # At most two conversations a range.
    open_ = found.filter(F.col("repaired_sha256").isNull()).select(F.col("conv_id").alias("o")).distinct()
    open_ = staged(open_, "open-conversations")
    units = staged(_units(rows.join(open_, F.col("conv_id").eqNullSafe(F.col("o")), "left_semi")), "open-units")
    parts = _combined_parts(staged(_part_reports(units), "parts"))
    # Conversations whose rows are all dropped have no parts.
    known = parts.join(open_, F.col("conv_id").eqNullSafe(F.col("o")), "right")
    zero = {n: F.coalesce(n, F.lit(0)).alias(n) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    heads = known.select(F.col("o").alias("conv_id"), *zero.values(), F.coalesce("audit", F.lit("")).alias("audit"))
    return closed.unionByName(_streamed(staged(heads, "open-reports"), units, _digested, REPORT))


def reports(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    ``turns`` has conv_id, turn, role and text; ``copies`` says how often a row stands (not at all: 0).
    """
    return _reports(prepared(turns, copies))


def repaired_turns(turns: DataFrame, copies: Column | None = None) -> DataFrame:
    """conv_id, position, edit, turn, role, text of the turns of every repaired conversation."""
    rows = prepared(turns, copies)
    heads = staged(_reports(rows), "reports")
    return _streamed(heads, _units(rows), _listed, _TURNS)
