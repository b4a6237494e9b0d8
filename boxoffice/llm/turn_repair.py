"""Repair of conversations by run-length dynamic programming over role and fault symbols.

Turns are edited at least cost until the first letters of their roles read ``(s?(ua)+)?``: Keep 0,
Rerole to user or assistant 1, Delete 2, Insert an empty user or assistant turn 5, and 5 more for a
truncated turn that is not deleted. Blank and duplicate turns must be deleted. Of edits of equal
cost those with the ASCII-least string of initials (D, I, K, R) are taken. After what stays so far,
every edit has one outcome only (the role of a reroled or inserted turn follows from its place),
so four states and the initials describe a repair completely.

A turn is one of nine symbols: the initial of its role (u, s, a, other) with or without
truncation, or "must go". Equal neighbours are a run, and costs to the end cross a run by the
binary powers of the symbol's 4 x 4 min-plus matrix, which are cached, as is what each power does to
a vector. The choices are then unrolled from the start.

Rows are taken by turn (null first), then role, then MD5 of the text; equal rows are one row with
a count. They go to ranges of that order, so one conversation may fill many tasks. A conversation
that lies within one range and within ``PIECE_ROWS`` and ``PIECE_BYTES`` is repaired at once. Of
others only the runs meet (a few bytes a run; the audit of a conversation is as long, and one
string); their texts stay in pieces.

Null roles, texts, ids and turns: a null role or text counts as one space, null ids are one
conversation, null turns come first. A role that begins with another letter, or is empty, can not
be kept. Only the four named columns are read, so others may have any name. An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_type

from boxoffice.llm.scratch import BROADCAST_ROWS, stored

# A longer conversation is handled in pieces of about this size.
PIECE_ROWS = 4096
PIECE_BYTES = 1 << 20
# Sub-keys of repeated texts where there are too many to broadcast.
SALTS = 8

SPACES = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, UNFINISHED = 2, 5, 1, 5
INITIALS = "usa"  # any other initial is number 3
GONE = 8  # the symbol of blank and duplicate turns; others are twice the initial, plus 1 if truncated
START, SYSTEM, USER, ASSISTANT = range(4)  # what the last turn that stays is
_NEXT = (USER, USER, ASSISTANT, USER)  # the state after a turn that fits by its place
_ROLE = {USER: "user", ASSISTANT: "assistant"}
_KEPT = {("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT, ("s", START): SYSTEM}
END = (0, 2 * INSERT, INSERT, 0)  # cost from each state when no turn is left
_TAIL = ("", "II", "I", "")
_FAR = 1 << 60

Vector = tuple[int, int, int, int]
Run = tuple[int, int]


def _edits(symbol: int, state: int) -> list[tuple[str, int, int]]:
    """(initial, cost, next state) of the edits that use a turn up, in ASCII order."""
    found = [("D", DELETE, state)]
    if symbol != GONE:
        extra = UNFINISHED if symbol % 2 else 0
        kept = _KEPT.get(((INITIALS + "x")[symbol // 2], state))
        if kept is not None:
            found.append(("K", extra, kept))
        found.append(("R", REROLE + extra, _NEXT[state]))
    return found


@lru_cache(maxsize=None)
def _power(symbol: int, bit: int) -> tuple[Vector, ...]:
    """Least cost from state to state over 2^bit turns of one symbol; 9 symbols, so few entries."""
    if bit:
        half = _power(symbol, bit - 1)
        return tuple(tuple(min(half[i][k] + half[k][j] for k in range(4)) for j in range(4)) for i in range(4))
    rows = []
    for state in range(4):
        row, at, paid = [_FAR] * 4, state, 0
        for _ in range(3):  # a third insertion would come back to a state seen
            for _, cost, after in _edits(symbol, at):
                row[after] = min(row[after], paid + cost)
            at, paid = _NEXT[at], paid + INSERT
        rows.append(tuple(row))
    return tuple(rows)


@lru_cache(maxsize=1 << 16)
def _across(symbol: int, bit: int, costs: Vector) -> tuple[Vector, int]:
    """Costs before 2^bit turns of a symbol from those behind them: a vector whose least is 0, and what was taken off."""
    power = _power(symbol, bit)
    found = [min(power[i][j] + costs[j] for j in range(4)) for i in range(4)]
    least = min(found)
    return tuple(c - least for c in found), least


@lru_cache(maxsize=1 << 16)
def _choice(symbol: int, state: int, costs: Vector) -> tuple[str, int]:
    """The first-choice initials up to and with the one that uses the turn up, and the state behind it."""

    def best(at: int, inserts: int) -> int:
        spent = min(cost + costs[after] for _, cost, after in _edits(symbol, at))
        return min(spent, INSERT + best(_NEXT[at], inserts - 1)) if inserts else spent

    least = best(state, 2)
    found = {name: (cost + costs[after], after) for name, cost, after in _edits(symbol, state)}
    if found["D"][0] == least:
        return "D", state
    if INSERT + best(_NEXT[state], 2) == least:
        rest, after = _choice(symbol, _NEXT[state], costs)
        return "I" + rest, after
    name = "K" if "K" in found and found["K"][0] == least else "R"
    return name, found[name][1]


def solve(runs: Sequence[Run], state: int = START, behind: Vector = END) -> tuple[int, str, int]:
    """Least cost, the ASCII-least initials of its edits, and the last state, without insertions at the very end."""
    costs, total = behind, 0
    after: list[Vector] = []
    for symbol, count in reversed(runs):
        after.append(costs)
        bit = 0
        while count >> bit:
            if count >> bit & 1:
                costs, less = _across(symbol, bit, costs)
                total += less
            bit += 1
    total += costs[state]
    audit: list[str] = []
    for (symbol, count), costs in zip(runs, reversed(after)):
        line = [costs]  # costs behind the last turn of the run, the one before it, ... until they repeat
        seen = {costs: 0}
        while len(line) < count:
            following = _across(symbol, 0, line[-1])[0]
            if following in seen:
                break
            seen[following] = len(line)
            line.append(following)
        first = seen[_across(symbol, 0, line[-1])[0]] if len(line) < count else 0
        period = len(line) - first
        for left in range(count - 1, -1, -1):
            at = left if left < len(line) else first + (left - first) % period
            initials, state = _choice(symbol, state, line[at])
            audit.append(initials)
    return total, "".join(audit), state


def _render(rows: Iterable[tuple[str, str, int]], audit: str, state: int) -> list[dict]:
    """The turns that stay, from (role, text, times) of a piece, its initials and the state before it."""
    out: list[dict] = []
    at = 0

    def inserted() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = _NEXT[state], at + 1
            out.append({"role": _ROLE[state], "text": ""})

    for role, text, times in rows:
        for _ in range(times):
            inserted()
            edit, at = audit[at], at + 1
            if edit == "K":
                state = _KEPT[role[:1], state]
                out.append({"role": role, "text": text})
            elif edit == "R":
                state = _NEXT[state]
                out.append({"role": _ROLE[state], "text": text})
    inserted()
    return out


class _Piece:
    """What the rows of one conversation in one place add up to."""

    def __init__(self, conv, part: int, no: int) -> None:
        self.conv, self.part, self.no = conv, part, no
        self.rows: list[tuple[str, str, int]] = []
        self.runs: list[list[int]] = []
        self.size = 0
        self.low = self.high = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None  # initials of the roles at both ends

    def add(self, turn, role: str, text: str, times: int, empty: bool, repeated: bool, cut: bool) -> None:
        if not times:  # only says that the conversation exists
            return
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high = turn
            self.turns += 1
        initial = role[:1]
        if self.first is None:
            self.first = initial
        else:
            self.illegal += not fits(self.last, initial)
        self.illegal += times - 1  # a role never fits itself
        self.last = initial
        if empty:
            self.blank += times
            self._push(GONE, times)
        else:
            kind = INITIALS.index(initial) if initial and initial in INITIALS else len(INITIALS)
            symbol = GONE if repeated else 2 * kind + cut
            self.duplicate += times - 1 + repeated
            self.truncated += cut and not repeated
            self._push(symbol, 1)
            if times > 1:
                self._push(GONE, times - 1)
        self.rows.append((role, text, times))
        self.size += len(role) + len(text)

    def _push(self, symbol: int, count: int) -> None:
        if self.runs and self.runs[-1][0] == symbol:
            self.runs[-1][1] += count
        else:
            self.runs.append([symbol, count])

    def is_full(self) -> bool:
        return len(self.rows) >= PIECE_ROWS or self.size >= PIECE_BYTES

    def record(self, whole: bool) -> dict:
        found = {
            "conv": self.conv, "part": self.part, "no": self.no, "whole": whole, "low": self.low, "high": self.high,
            "turns": self.turns, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated,
            "illegal": self.illegal, "first": self.first, "last": self.last,
        }
        if whole:
            cost, audit, state = solve(self.runs)
            audit += _TAIL[state]
            gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
            return {**found, "gaps": gaps, "cost": cost, "audit": audit, "kept": _render(self.rows, audit, START)}
        rows = [{"role": role, "text": text, "times": times} for role, text, times in self.rows]
        return {**found, "runs": b"".join(struct.pack("<Bq", *run) for run in self.runs), "rows": rows}


def fits(before: str | None, after: str) -> bool:
    return (before or "") + after in ("su", "ua", "au")


_TURN = pa.struct([("role", pa.string()), ("text", pa.string())])
_COUNTS = ["turns", "blank", "duplicate", "truncated", "illegal"]
_TALLY = [("low", pa.int64()), ("high", pa.int64()), *[(name, pa.int64()) for name in _COUNTS]]
_RESULT = [("gaps", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("kept", pa.list_(_TURN))]


def _piece_schema(conv: pa.DataType) -> pa.Schema:
    row = pa.struct([("role", pa.string()), ("text", pa.string()), ("times", pa.int64())])
    ends = [("first", pa.string()), ("last", pa.string())]
    place = [("conv", conv), ("part", pa.int64()), ("no", pa.int64()), ("whole", pa.bool_())]
    return pa.schema([*place, *_TALLY, *ends, *_RESULT, ("runs", pa.binary()), ("rows", pa.list_(row))])


def _batches(records: Iterable[dict], schema: pa.Schema, size) -> Iterator[pa.RecordBatch]:
    """Record batches of about a piece's size each."""
    held: list[dict] = []
    volume = 0
    for record in records:
        held.append(record)
        volume += size(record)
        if volume >= PIECE_BYTES or len(held) >= PIECE_ROWS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, volume = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _volume(record: dict) -> int:
    return 64 + sum(len(r["role"]) + len(r["text"]) + 32 for r in record.get("kept") or record.get("rows") or ())


def _pieces(ordered: DataFrame, conv: pa.DataType) -> DataFrame:
    """Every conversation of the sorted ranges, repaired where it is whole, else as pieces of rows."""
    schema = _piece_schema(conv)
    names = ["conv", "turn", "role", "text", "times", "blank", "repeated", "cut"]

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        part, number = TaskContext.get().partitionId(), 0
        piece: _Piece | None = None
        # The first and the last conversation of a range may go on in its neighbours.
        whole = False
        for batch in batches:
            for conv_id, *row in zip(*(batch.column(name).to_pylist() for name in names)):
                if piece is None or piece.conv != conv_id:
                    if piece is not None:
                        yield piece.record(whole)
                        number, whole = number + 1, True
                    piece = _Piece(conv_id, part, number)
                elif piece.is_full():
                    yield piece.record(False)
                    number, whole = number + 1, False
                    piece = _Piece(conv_id, part, number)
                piece.add(*row)
        if piece is not None:
            yield piece.record(False)

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(records(batches), schema, _volume)

    return ordered.select(*names).mapInArrow(make, from_arrow_schema(schema))


def _conclusions(pieces: DataFrame, conv: pa.DataType) -> DataFrame:
    """(part, no, state, audit, figures) of all pieces of a conversation, from its runs in order."""
    schema = pa.schema([("part", pa.int64()), ("no", pa.int64()), ("state", pa.int64()), ("gaps", pa.int64()),
                        ("cost", pa.int64()), ("audit", pa.string()), *[(name, pa.int64()) for name in _COUNTS[1:]]])
    facts = ["part", "no", *[name for name, _ in _TALLY], "first", "last", "runs"]
    gathered = pieces.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*facts))).alias("all"))

    def conclude(found: list[dict]) -> Iterator[dict]:
        runs = [[(s, n) for s, n in struct.iter_unpack("<Bq", piece["runs"])] for piece in found]
        cost, audit, state = solve([run for each in runs for run in each])
        audit += _TAIL[state]
        sums = {name: sum(piece[name] for piece in found) for name in _COUNTS}
        filled = [piece for piece in found if piece["first"] is not None]
        for one, two in zip(filled, filled[1:]):
            sums["illegal"] += not fits(one["last"], two["first"])
        dated = [piece for piece in found if piece["low"] is not None]
        sums["turns"] -= sum(one["high"] == two["low"] for one, two in zip(dated, dated[1:]))
        gaps = dated[-1]["high"] - dated[0]["low"] + 1 - sums.pop("turns") if dated else 0
        at, state = 0, START
        for number, (piece, each) in enumerate(zip(found, runs)):
            start, before = at, state
            left = sum(count for _, count in each)
            # The initials of a piece end with the edit of its last turn, those of the last piece with all that is left.
            while left or (number == len(found) - 1 and at < len(audit)):
                left -= audit[at] != "I"
                at += 1
            state = _state_after(audit[start:at], each, before)
            figures = {"gaps": gaps, "cost": cost, **sums} if number == 0 else {}
            yield {"part": piece["part"], "no": piece["no"], "state": before, "audit": audit[start:at], **figures}

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = (row for found in batch.column("all") for row in conclude(found.as_py()))
            yield from _batches(records, schema, lambda record: len(record["audit"]))

    return gathered.select("all").mapInArrow(make, from_arrow_schema(schema))


def _state_after(audit: str, runs: Sequence[Run], state: int) -> int:
    symbols = (symbol for symbol, count in runs for _ in range(count))
    for edit in audit:
        symbol = None if edit == "I" else next(symbols)
        if edit == "K":
            state = _KEPT[INITIALS[symbol // 2], state]
        elif edit != "D":
            state = _NEXT[state]
    return state


def _rendered(pieces: DataFrame, conclusions: DataFrame, conv: pa.DataType) -> DataFrame:
    schema = pa.schema([("conv", conv), ("part", pa.int64()), ("no", pa.int64()), *_RESULT,
                        *[(name, pa.int64()) for name in _COUNTS[1:]]])
    joined = pieces.select("conv", "part", "no", "rows").join(conclusions, ["part", "no"])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                rows = [(r["role"], r["text"], r["times"]) for r in row.pop("rows")]
                row["kept"] = _render(rows, row["audit"], row.pop("state"))
                yield pa.RecordBatch.from_pylist([row], schema)

    return joined.mapInArrow(make, from_arrow_schema(schema))


def repair(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Every conversation repaired, as one row, or as several pieces where it is long or lies across ranges.

    Columns: the id, ``piece`` (ascending within a conversation), ``whole`` (there is no other piece),
    ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost`` (of the whole
    conversation; null but on its first piece), ``audit`` (initials of the piece's edits) and
    ``turns`` (the role and text of what stays). A row may carry its number of copies in a column
    ``copies``; 0 stands for a conversation whose rows are all gone.
    """
    space = F.lit(" ")
    copies = F.col("copies").cast("long") if "copies" in rows.columns else F.lit(1).cast("long")
    plain = rows.select(
        F.col(id_col).alias("conv"),
        F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), space).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), space).alias("text"),
        copies.alias("times"),
    )
    same = plain.groupBy("conv", "turn", "role", "text").agg(F.sum("times").alias("times"))
    same = stored(same.withColumn("digest", F.md5("text")), "turn-rows")
    ended = F.rtrim("text", F.lit(SPACES))
    marked = _repeats(same.withColumn("blank", ended == ""))
    marked = marked.withColumn("cut", ~F.right(ended, F.lit(1)).isin(".", "!", "?"))
    order = ["conv", "turn", "role", "digest"]
    ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order)
    conv = _arrow_type(plain)
    found = stored(_pieces(ordered, conv), "turn-pieces")
    figures = ["gaps", *_COUNTS[1:], "cost", "audit", "kept"]
    parted = found.where(~F.col("whole"))
    parted = stored(_rendered(parted, _conclusions(parted, conv), conv), "turn-rendered")
    # A conversation may touch the edge of its range and still be whole.
    single = parted.groupBy("conv").agg(F.count("*").alias("n")).where("n = 1").select(F.col("conv").alias("alone"))
    single = single.withColumn("whole", F.lit(True))
    edges = parted.join(single, F.col("conv").eqNullSafe(F.col("alone")) & F.col("whole"), "left")
    edges = edges.withColumn("whole", F.coalesce("whole", F.lit(False)))
    every = found.where("whole").select("conv", "part", "no", "whole", *figures)
    every = every.unionByName(edges.select("conv", "part", "no", "whole", *figures))
    piece = F.shiftleft(F.col("part"), 32) + F.col("no")
    return every.select(
        F.col("conv").alias(id_col), piece.alias("piece"), "whole", *figures[:-1], F.col("kept").alias("turns")
    )


def _arrow_type(df: DataFrame) -> pa.DataType:
    return to_arrow_type(df.schema["conv"].dataType)


def _repeats(rows: DataFrame) -> DataFrame:
    """Marks rows whose role and text an earlier turn of the conversation has.

    Only texts of several turns are looked up. Where they are too many to broadcast, both sides
    are salted by the turn, so a text that fills much of the table is spread.
    """
    turn = F.struct(F.col("turn").isNotNull().alias("given"), F.col("turn").alias("turn"))
    counted = rows.where(~F.col("blank")).where("times > 0").groupBy("conv", "role", "digest")
    several = counted.agg(F.min(turn).alias("earliest"), F.count("*").alias("n")).where("n > 1")
    several = stored(several.toDF("conv_", "role_", "digest_", "earliest", "n").drop("n"), "turn-repeats")
    same = F.col("conv").eqNullSafe(F.col("conv_")) & (F.col("role") == F.col("role_")) & (F.col("digest") == F.col("digest_"))
    if several.count() <= BROADCAST_ROWS:
        joined = rows.join(F.broadcast(several), same, "left")
    else:
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("turn"), F.lit(SALTS)))
        several = several.withColumn("salt_", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)).cast("array<bigint>")))
        joined = rows.join(several, same & (F.col("salt") == F.col("salt_")), "left")
    later = F.coalesce(turn > F.col("earliest"), F.lit(False)) & ~F.col("blank")
    return joined.select("conv", "turn", "role", "text", "times", "digest", "blank", later.alias("repeated"))


def digests(pieces: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """One row a conversation with its figures, the whole ``audit`` and ``repaired_sha256`` of ``role:text`` lines.

    The lines of a conversation in pieces are hashed one after another as they stream by.
    """
    figures = ["gaps", *_COUNTS[1:], "cost"]
    line = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit(":"), turn["text"]))
    whole = pieces.where("whole").select(
        id_col, *figures, "audit", F.sha2(F.array_join(line, "\n"), 256).alias("repaired_sha256")
    )
    parts = pieces.where(~F.col("whole")).select(F.col(id_col).alias("conv"), "piece", *figures, "audit", line.alias("lines"))
    # The row of a piece that has its figures and initials comes before its lines.
    headed = F.concat(F.array(F.lit(None).cast("string")), "lines")
    rows = parts.select("conv", "piece", *figures, "audit", F.posexplode(headed).alias("at", "line"))
    head = F.col("at") == 0
    rows = rows.select(
        "conv", "piece", "at", "line", *[F.when(head, F.col(name)).alias(name) for name in (*figures, "audit")]
    )
    ordered = rows.repartition(F.col("conv")).sortWithinPartitions("conv", "piece", "at")
    conv = _arrow_type(rows)
    schema = pa.schema([("conv", conv), *[(name, pa.int64()) for name in figures], ("audit", pa.string()), ("sha", pa.string())])

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        names = ["conv", "line", "audit", *figures]
        rows = (row for batch in batches for row in zip(*(batch.column(name).to_pylist() for name in names)))
        for conv_id, group in groupby(rows, key=lambda row: row[0]):
            sha, audit, values, empty = hashlib.sha256(), [], None, True
            for _, said, initials, *numbers in group:
                if said is None:
                    audit.append(initials)
                    values = numbers if values is None else values
                else:
                    sha.update(said.encode() if empty else b"\n" + said.encode())
                    empty = False
            yield {"conv": conv_id, **dict(zip(figures, values)), "audit": "".join(audit), "sha": sha.hexdigest()}

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(stream(batches), schema, lambda record: len(record["audit"]))

    streamed = ordered.mapInArrow(make, from_arrow_schema(schema))
    return whole.unionByName(
        streamed.select(F.col("conv").alias(id_col), *figures, "audit", F.col("sha").alias("repaired_sha256"))
    )


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by the crc32 of ``conv_id:turn``, a null as one space, divided by 20.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 doubles the row, 4 makes its role
    user. ``copies`` counts a row; a dropped one is left with 0 copies and nothing else but its id.
    """

    def given(column: Column) -> Column:
        return F.coalesce(column.cast("string"), F.lit(" "))

    key = F.concat(given(F.col("conv_id")), F.lit(":"), given(F.col("turn")))
    fault = F.crc32(key.cast("binary")) % 20
    role, text = given(F.col("role")), given(F.col("text"))
    gone = fault == 0
    return conversations.select(
        "conv_id",
        F.when(~gone, F.col("turn").cast("long")).alias("turn"),
        F.when(gone, F.lit("")).when(fault == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(gone | (fault == 1), F.lit("")).when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(gone, F.lit(0)).when(fault == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"),
    )
