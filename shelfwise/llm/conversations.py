"""Conversation structure repair: weighted CYK interval parsing of the roles of a conversation.

The repaired roles have the initials ``(s?(ua)+)?``. The grammar that accepts them is in Chomsky
normal form over spans: its symbols ``[p,q]`` stand for "leads the roles from p to q" (p and q are
places of the pattern), with the rules ``[p,q] -> [p,r] [r,q]``. A cell holds for each symbol the
cheapest (cost, audit) that its span of rows derives; the cell of one row is what keeping, reroling
or deleting it gives, closed under insertions before and behind it. Cells are combined bottom-up by
span length, at doubling lengths: joining cells is associative (two audits of one span, symbol and
cost never begin with one another, since more letters would be more insertions and thus dearer), so
every split of a span gives the same cell and one split is enough. n rows take n - 1 joins.

On Spark: rows are described in short (no text), ordered over the whole table by a range sort, and
parsed in segments of at most ``SEGMENT`` rows; so a conversation that holds a third of all rows is
many segments in many tasks. The segments of a conversation are joined where its texts pass by, in
order, into the hash. That hash and the audit are one value of a conversation each, so that last
step is one task for one conversation: it streams the texts and holds the audits only.

Damage: nulls read as one space, in the hashed ``conv_id:turn`` as well. Defined results: rows are
taken by turn (nulls first), rows of one turn by role and the MD5 of the text; equal rows are next
to each other. A row is a duplicate if an earlier row has its role and its text (by MD5). An empty
role has no initial: keeping such a row is not possible, and next to it no pair is legal. Rows with
a null conv_id are one conversation. Further columns and their names do not matter. No rows: an
empty table. A conversation of which all rows were dropped has zeros, no audit and the hash of
nothing. Turns are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.session import written

#: So many rows are parsed to one cell before it is passed on.
SEGMENT = 4096
#: Cells of spans up to this length are remembered by a task, so many of them.
REMEMBERED_SPAN, REMEMBERED = 8, 50_000

# Costs of the edits, by the letter of the audit, and of a truncated row that stays.
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
SPACES = " \t\n\x0b\x0c\r"
LEGAL_PAIRS = frozenset(("su", "ua", "au"))

# The places of the pattern: 0 at the start, 1 behind s, 2 behind u, 3 behind a; the roles may end at
# ENDS. ARCS[p] is what each initial leads to.
ARCS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
ENDS = (0, 3)
SYMBOLS = ((0, 0), (0, 1), (0, 2), (0, 3), (1, 1), (1, 2), (1, 3), (2, 2), (2, 3), (3, 2), (3, 3))
_AT = {symbol: k for k, symbol in enumerate(SYMBOLS)}
_RULES = tuple(
    tuple((_AT[p, r], _AT[r, q]) for r in range(4) if (p, r) in _AT and (r, q) in _AT)
    for p, q in SYMBOLS
)

Cell = tuple  # for each symbol (cost, audit), or None


def join(left: Cell, right: Cell) -> Cell:
    """The cell of two neighbouring spans."""
    out = []
    for rules in _RULES:
        best = None
        for i, k in rules:
            a, b = left[i], right[k]
            if a is None or b is None:
                continue
            cost = a[0] + b[0]
            if best is None or cost < best[0]:
                best = (cost, a[1] + b[1])
            elif cost == best[0]:
                audit = a[1] + b[1]
                if audit < best[1]:
                    best = (cost, audit)
        out.append(best)
    return tuple(out)


def _insertions() -> Cell:
    """What insertions alone derive: the empty span."""
    step: list = [None] * len(SYMBOLS)
    for p, q in SYMBOLS:
        if p == q:
            step[_AT[p, q]] = (0, "")
        elif any(to == q and role != "s" for role, to in ARCS[p].items()):
            step[_AT[p, q]] = (COST["I"], "I")
    cell = tuple(step)
    while (closed := join(cell, cell)) != cell:
        cell = closed
    return cell


EMPTY = _insertions()


def one_row(kind: str) -> Cell:
    """The cell of a row: ``d`` must go; otherwise its initial (``x``: any other), in upper case if
    the row is truncated."""
    cell: list = [None] * len(SYMBOLS)
    for p, arcs in enumerate(ARCS):
        options = [(COST["D"], "D", p)]
        if kind != "d":
            more = TRUNCATED if kind.isupper() else 0
            for role, q in arcs.items():
                if role == kind.lower():
                    options.append((COST["K"] + more, "K", q))
                if role != "s":
                    options.append((COST["R"] + more, "R", q))
        for cost, edit, q in options:
            at = _AT[p, q]
            if cell[at] is None or (cost, edit) < cell[at]:
                cell[at] = (cost, edit)
    return join(join(EMPTY, tuple(cell)), EMPTY)


@lru_cache(REMEMBERED)
def _short_span(kinds: str) -> Cell:
    if len(kinds) == 1:
        return one_row(kinds)
    half = 1 << (len(kinds) - 1).bit_length() - 1
    return join(_short_span(kinds[:half]), _short_span(kinds[half:]))


def upwards(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans, combined in rounds of doubling length."""
    while len(cells) > 1:
        joined = [join(a, b) for a, b in zip(cells[::2], cells[1::2], strict=False)]
        cells = joined + cells[len(joined) * 2 :]
    return cells[0] if cells else EMPTY


def parse(kinds: str) -> Cell:
    """The cell of a span of rows."""
    size = REMEMBERED_SPAN
    return upwards([_short_span(kinds[i : i + size]) for i in range(0, len(kinds), size)])


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the whole conversation."""
    return min(cell[_AT[0, q]] for q in ENDS if cell[_AT[0, q]] is not None)


class Repair:
    """Replays an audit over the rows, in order, and hashes what it gives."""

    def __init__(self, audit: str):
        self.audit, self.at, self.place = audit, 0, 0
        self.hash, self.first = hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.first else chr(10)}{role}:{text}".encode("utf-8", "replace"))
        self.first = False

    def _next_role(self) -> str:
        role = "assistant" if self.place == 2 else "user"
        self.place = ARCS[self.place][role[0]]
        return role

    def inserted(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._line(self._next_role(), "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self.place = ARCS[self.place][role[0]]
            self._line(role, text)
        elif edit == "R":
            self._line(self._next_role(), text)

    def digest(self) -> str:
        self.inserted()
        return self.hash.hexdigest()


# --- rows -----------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage."""

    def or_space(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat(or_space("conv_id"), F.lit(":"), or_space("turn"))) % 20
    text = or_space("text")
    row = F.struct(
        F.when(fate == 4, "user").otherwise(or_space("role")).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.translate(text, ".!?", "")).otherwise(text)
        .alias("text"),
    )
    rows = F.when(fate == 3, F.array(row, row)).when(fate != 0, F.array(row))
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.inline(rows))


def described(rows: DataFrame) -> DataFrame:
    """The rows with the MD5 of their text."""
    return rows.withColumn("digest", F.md5("text"))


def kinds_of_rows(rows: DataFrame) -> DataFrame:
    """One row for each group of equal rows of a turn: their number, and whether they are blank,
    truncated, or seen at an earlier turn. Counted before the shuffle; no texts."""
    end = F.rtrim(F.col("text"), F.lit(SPACES))
    last = F.right(end, F.lit(1))
    key = ["conv_id", "role", "digest"]
    short = written(
        described(rows).select(
            *key, "turn", (end == "").alias("blank"),
            ((end != "") & ~last.isin(".", "!", "?")).alias("truncated"),
        )
        .groupBy(*key, "turn").agg(
            F.count(F.lit(1)).alias("copies"), F.any_value("blank").alias("blank"),
            F.any_value("truncated").alias("truncated")),
        "conversation_rows")
    order = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn"))
    again = (
        short.filter(~F.col("blank")).groupBy(*key)
        .agg(F.count(F.lit(1)).alias("turns"), F.min(order).alias("earliest"))
        .filter(F.col("turns") > 1)
        .select(*(F.col(k).alias(f"{k}_again") for k in key), "earliest")
    )
    same = F.lit(True)
    for k in key:
        same = same & F.col(k).eqNullSafe(F.col(f"{k}_again"))
    seen = F.coalesce(~order.eqNullSafe(F.col("earliest")), F.lit(False))
    return short.join(again, same, "left").select(
        *short.columns, (F.col("earliest").isNotNull() & seen).alias("seen"))


_ORDER = ("conv_id", "turn", "role", "digest")
_STATS = ("blank", "duplicate", "truncated", "illegal")
_SEGMENT_FIELDS = (
    *((name, pa.int64()) for name in (*_STATS, "turns", "least_turn", "first_turn", "last_turn")),
    ("first_initial", pa.string()), ("last_initial", pa.string()),
    ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())),
)
_SEGMENT_DDL = (
    "blank long, duplicate long, truncated long, illegal long, turns long, least_turn long, "
    "first_turn long, last_turn long, first_initial string, last_initial string, "
    "costs array<long>, audits array<string>"
)


class _Segment:
    """Neighbouring rows of one conversation."""

    def __init__(self, key: tuple):
        self.key = key
        self.kinds: list[str] = []
        self.rows = 0
        self.stats = dict.fromkeys(_STATS, 0)
        self.turns = 0
        self.least_turn = self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = None

    def add(self, turn, role: str, copies: int, blank: bool, truncated: bool, seen: bool) -> None:
        initial = role[:1]
        kind = "d"
        if blank:
            self.stats["blank"] += copies
        else:
            self.stats["duplicate"] += copies if seen else copies - 1
            if not seen:
                kind = initial if initial in ("s", "u", "a") else "x"
                if truncated:
                    self.stats["truncated"] += 1
                    kind = kind.upper()
        self.kinds.append(kind + "d" * (copies - 1))
        self.rows += copies
        if self.first_initial is None:
            self.first_initial = initial
        else:
            self.stats["illegal"] += self.last_initial + initial not in LEGAL_PAIRS
        self.stats["illegal"] += copies - 1
        self.last_initial = initial
        if turn is not None:
            self.turns += turn != self.last_turn
            self.last_turn = turn
            if self.first_turn is None:
                self.first_turn = turn

    def row(self) -> dict:
        cell = parse("".join(self.kinds))
        return {
            **dict(zip(_ORDER, self.key, strict=True)), **self.stats, "turns": self.turns,
            "least_turn": self.first_turn, "first_turn": self.first_turn,
            "last_turn": self.last_turn, "first_initial": self.first_initial,
            "last_initial": self.last_initial,
            "costs": [x and x[0] for x in cell], "audits": [x and x[1] for x in cell],
        }


def segments(kinds: DataFrame) -> DataFrame:
    """Parsed segments of conversations, each with the place of its first row and its counts."""
    ordered = kinds.repartitionByRange(*_ORDER).sortWithinPartitions(*_ORDER)
    schema = kinds.select(*_ORDER).schema
    ddl = f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in schema)}, {_SEGMENT_DDL}"
    names = ("copies", "blank", "truncated", "seen")

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Segment | None = None
        arrow: pa.Schema | None = None
        done: list[dict] = []
        for batch in batches:
            if arrow is None:
                arrow = pa.schema([*(batch.schema.field(n) for n in _ORDER), *_SEGMENT_FIELDS])
            columns = [batch.column(n).to_pylist() for n in (*_ORDER, *names)]
            for conv_id, turn, role, digest, copies, blank, truncated, seen in zip(
                    *columns, strict=True):
                if now is not None and (now.key[0] != conv_id or now.rows >= SEGMENT):
                    done.append(now.row())
                    now = None
                if now is None:
                    now = _Segment((conv_id, turn, role, digest))
                now.add(turn, role, copies, blank, truncated, seen)
            if len(done) >= 1024:
                yield pa.RecordBatch.from_pylist(done, schema=arrow)
                done = []
        if now is not None:
            done.append(now.row())
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=arrow)

    return ordered.select(*_ORDER, *names).mapInArrow(parsed, ddl)


class _Conversation:
    """One conversation while its segments and then its texts pass by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.cells: list[Cell] = []
        self.stats = dict.fromkeys(_STATS, 0)
        self.turns, self.least_turn, self.last_turn, self.last_initial = 0, None, None, None
        self.cost, self.repair = 0, None

    def segment(self, s: dict) -> None:
        for name in _STATS:
            self.stats[name] += s[name]
        if self.last_initial is not None:
            self.stats["illegal"] += self.last_initial + s["first_initial"] not in LEGAL_PAIRS
        self.last_initial = s["last_initial"]
        if s["first_turn"] is not None:
            self.turns += s["turns"] - (s["first_turn"] == self.last_turn)
            self.last_turn = s["last_turn"]
            if self.least_turn is None:
                self.least_turn = s["least_turn"]
        self.cells.append(tuple(
            None if cost is None else (cost, audit)
            for cost, audit in zip(s["costs"], s["audits"], strict=True)))

    def start(self) -> None:
        if self.repair is None:
            self.cost, audit = cheapest(upwards(self.cells))
            self.cells = []
            self.repair = Repair(audit)

    def result(self) -> dict:
        self.start()
        gaps = 0 if self.least_turn is None else self.last_turn - self.least_turn + 1 - self.turns
        return {"conv_id": self.conv_id, "gaps": gaps, **self.stats, "cost": self.cost,
                "audit": self.repair.audit, "repaired_sha256": self.repair.digest()}


_NUMBERS = ("gaps", *_STATS, "cost")


def repair(conversations: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every
    conv_id: ``conversations`` is damaged, then repaired at least cost."""
    rows = damage(conversations)
    parsed = segments(kinds_of_rows(rows))
    parts = F.struct(*(F.col(name) for name in parsed.columns[len(_ORDER):])).alias("part")
    empty = F.lit(None).cast(parsed.select(parts).schema["part"].dataType).alias("part")
    no_text = F.lit(None).cast("string").alias("text")
    id_type = conversations.schema["conv_id"].dataType.simpleString()
    named = conversations.select("conv_id").distinct().select(
        "conv_id", F.lit(0).alias("step"), F.lit(None).cast("long").alias("turn"),
        no_text.alias("role"), no_text.alias("digest"), no_text, empty)
    cells = parsed.select("conv_id", F.lit(1).alias("step"), "turn", "role", "digest", no_text, parts)
    texts = described(rows).select("conv_id", F.lit(2).alias("step"), "turn", "role", "digest", "text", empty)
    together = (
        named.unionByName(cells).unionByName(texts).repartition("conv_id")
        .sortWithinPartitions("conv_id", "step", "turn", "role", "digest")
        .select("conv_id", "step", "role", "text", "part")
    )

    def replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        schema: pa.Schema | None = None
        done: list[dict] = []
        for batch in batches:
            if schema is None:
                schema = pa.schema([
                    batch.schema.field("conv_id"), *((n, pa.int64()) for n in _NUMBERS),
                    ("audit", pa.string()), ("repaired_sha256", pa.string())])
            for start in range(0, batch.num_rows, 1024):
                piece = batch.slice(start, 1024)
                for conv_id, step, role, text, part in zip(
                        *(c.to_pylist() for c in piece.columns), strict=True):
                    if step == 0:
                        if now is not None:
                            done.append(now.result())
                        now = _Conversation(conv_id)
                    elif step == 1:
                        now.segment(part)
                    else:
                        now.start()
                        now.repair.row(role, text)
            if len(done) >= 1024:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if now is not None:
            done.append(now.result())
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    ddl = f"conv_id {id_type}, {', '.join(f'{n} long' for n in _NUMBERS)}, audit string, repaired_sha256 string"
    return together.mapInArrow(replay, ddl)
