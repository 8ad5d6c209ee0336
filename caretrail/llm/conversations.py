"""Repair of the turn structure of conversations by the cheapest edits.

A row has a symbol: its role's initial and its first fault. Which initials may come next is a machine of four states, so a symbol is
a 4 x 4 min-plus matrix of least costs (inserts before the row included), a run of equal symbols its power, and a block of rows a
product. Powers of two are cached. Going back over the runs gives the cost still to come behind each; going forward from
there, taking the least letter that keeps that cost, gives the edits.

No conversation is held in one place. Equal rows of a turn are counted first, rows are sorted by ranges over (conversation, turn, role,
text), and a task finishes the conversations that lie inside its range. Others are blocks of at most `BLOCK_ROWS` rows or
`BLOCK_BYTES` of text: their matrices are multiplied along the conversation, which gives the cost behind each block; each block tells where it ends from
each state, which gives the state before each; then blocks are unrolled each on its own. Only the hash and the audit of
a conversation, one cell each, are put together in one task, as a stream of the finished blocks.

Defined results: a null role or text is one space; an empty role has no initial, which is neither s, u nor a. Null turns come first and are no
part of the gaps; the null conv_id is a conversation like others. Rows of one turn are ordered by role, then text. Equal rows of one turn are
copies: the first may stay, the others are duplicates. Rows that share conversation, turn and the first `PREFIX` characters of role and text
lie in one range, which is read as a stream. An empty table gives no rows. Only the four named columns are read, so further ones cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, LongType, StringType, StructType

from caretrail.llm.stored import Scratch, tidy

BLOCK_ROWS, BLOCK_BYTES, PREFIX = 50_000, 8 << 20, 32
CHUNK = 1 << 16
SPACE = r"\x20\x09-\x0D"  # fixed: characters that do not make a text
INFINITE = 1 << 60

# States: nothing yet, behind s, behind u, behind a. What may be put in next is one role only.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
KEPT = ({START: SYSTEM}, {START: USER, SYSTEM: USER, ASSISTANT: USER}, {USER: ASSISTANT}, {})  # by s, u, a, other
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5
DROPPED = 8  # the symbol of a row that must go; others are the initial, and 4 more if the row is cut off

Vector = tuple[int, ...]
Matrix = tuple[Vector, ...]


def after(matrix: Matrix, v: Vector) -> Vector:
    return tuple([min([m + x for m, x in zip(row, v, strict=True)]) for row in matrix])


def product(a: Matrix, b: Matrix) -> Matrix:
    columns = list(zip(*b, strict=True))
    return tuple([tuple([min(INFINITE, *[x + y for x, y in zip(row, c, strict=True)]) for c in columns]) for row in a])


NONE: Matrix = tuple([tuple([0 if s == t else INFINITE for t in range(4)]) for s in range(4)])


def _inserts() -> Matrix:
    one = tuple([tuple([0 if s == t else INSERT if NEXT[s] == t else INFINITE for t in range(4)]) for s in range(4)])
    return product(one, one)  # more than two never pay


INSERTS = _inserts()
END: Vector = after(INSERTS, (0, INFINITE, INFINITE, 0))


def _row(symbol: int) -> Matrix:
    cost = [[DELETE if s == t else INFINITE for t in range(4)] for s in range(4)]
    if symbol != DROPPED:
        stays = CUT_OFF * (symbol >= 4)
        for s in range(4):
            cost[s][NEXT[s]] = min(cost[s][NEXT[s]], REROLE + stays)
        for s, t in KEPT[symbol % 4].items():
            cost[s][t] = min(cost[s][t], KEEP + stays)
    return tuple([tuple(r) for r in cost])


@lru_cache(maxsize=None)  # symbols times the digits of a length
def squared(symbol: int, digit: int) -> Matrix:
    """The transition of 2 ** digit rows of the symbol."""
    if not digit:
        return product(INSERTS, _row(symbol))
    half = squared(symbol, digit - 1)
    return product(half, half)


@lru_cache(maxsize=4096)
def power(symbol: int, n: int) -> Matrix:
    out, digit = NONE, 0
    while n >> digit:
        if n >> digit & 1:
            out = product(out, squared(symbol, digit))
        digit += 1
    return out


def collapsed(symbols: Iterable[tuple[int, int]]) -> list[list[int]]:
    """Runs [symbol, length] of (symbol, times)."""
    runs: list[list[int]] = []
    for symbol, n in symbols:
        if runs and runs[-1][0] == symbol:
            runs[-1][1] += n
        elif n:
            runs.append([symbol, n])
    return runs


def transition(runs: list[list[int]]) -> Matrix:
    out = NONE
    for symbol, n in runs:
        out = product(out, power(symbol, n))
    return out


@lru_cache(maxsize=4096)  # few differences between the states occur
def _step(symbol: int, behind: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    """Costs before a row from the costs behind it, and for each state the least letters of cheapest cost with the state behind."""
    here, moves = after(squared(symbol, 0), behind), []
    row, stays = _row(symbol), CUT_OFF * (symbol >= 4)
    for s in range(4):
        letters, left = "", here[s]
        while True:
            kept = KEPT[symbol % 4].get(s) if symbol != DROPPED else None
            if DELETE + behind[s] == left:
                letters += "D"
            elif INSERT + here[NEXT[s]] == left:
                letters, s, left = letters + "I", NEXT[s], left - INSERT
                continue
            elif kept is not None and KEEP + stays + behind[kept] == left:
                letters, s = letters + "K", kept
            else:
                assert row[s][NEXT[s]] + behind[NEXT[s]] == left
                letters, s = letters + "R", NEXT[s]
            break
        moves.append((letters, s))
    return here, tuple(moves)


def step(symbol: int, behind: Vector) -> tuple[Vector, tuple[tuple[str, int], ...]]:
    least = min(behind)
    here, moves = _step(symbol, tuple([b - least for b in behind]))
    return tuple([h + least for h in here]), moves


def unrolled(runs: list[list[int]], behind: Vector, state: int) -> Iterator[tuple[str, int, int]]:
    """(letters, times, state behind) along the runs from a state, given the costs behind the last of them.

    A run of rows that must go is one item; other rows are one item each: inserts, then the row's own letter.
    """
    ends = [behind]
    for symbol, n in reversed(runs):
        ends.append(after(power(symbol, n), ends[-1]))
    ends = ends[-2::-1]
    for (symbol, n), end in zip(runs, ends, strict=True):
        if symbol == DROPPED:
            yield "D", n, state  # D is the least letter, and inserts cost the same behind it
            continue
        moves = []
        for _ in range(n):
            end, move = step(symbol, end)
            moves.append(move)
        for move in reversed(moves):
            letters, state = move[state]
            yield letters, 1, state


def closing(state: int) -> str:
    """Inserts behind the last row."""
    return "I" * (END[state] // INSERT)


class Block:
    """Rows of a conversation, in order: their runs, counts and texts."""

    def __init__(self, conv):
        self.conv, self.rows, self.bytes = conv, [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = None
        self.initials: list[str] = []  # first and last
        self.symbols: list[tuple[int, int]] = []

    def add(self, turn: int | None, role: str, text: str, blank: bool, cut: bool, first: bool, n: int) -> None:
        if not n:  # only says that there is such a conversation
            return
        initial = role[:1]
        self.rows.append((turn, role, text, n, blank, cut, first))
        self.bytes += len(role) + len(text)
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.initials:
            self.illegal += self.initials[-1] + initial not in ("su", "ua", "au")
        self.illegal += n - 1
        self.initials = [self.initials[0] if self.initials else initial, initial]
        stays = int(first and not blank)
        if stays:
            self.symbols.append((("sua".index(initial) if initial and initial in "sua" else 3) + 4 * cut, 1))
        if n > stays:
            self.symbols.append((DROPPED, n - stays))
        self.blank += n * blank
        self.duplicate += 0 if blank else n - stays
        self.truncated += stays * cut

    def edits(self, behind: Vector, state: int, last: bool) -> Iterator[tuple[str, int, int | None, str | None, str | None]]:
        """(letter, times, turn, role, text) of every edit; deleted rows have no text."""
        items = unrolled(collapsed(self.symbols), behind, state)
        gone = 0  # rows left of the run of deleted ones at hand
        for turn, role, text, n, blank, _, first in self.rows:
            stays = int(first and not blank)
            if stays:
                letters, _, now = next(items)
                for letter in letters[:-1]:
                    state = NEXT[state]
                    yield letter, 1, None, ROLE[state], ""
                state = now
                if letters[-1] == "D":
                    yield "D", 1, turn, role, None
                else:
                    yield letters[-1], 1, turn, role if letters[-1] == "K" else ROLE[state], text
            if n > stays:
                gone = gone or next(items)[1]
                gone -= n - stays
                yield "D", n - stays, turn, role, None
        if last:
            for letter in closing(state):
                state = NEXT[state]
                yield letter, 1, None, ROLE[state], ""


class Rows:
    """Output rows as dicts, given out in batches."""

    def __init__(self, schema: pa.Schema):
        self.schema, self.rows, self.size = schema, [], 0

    def add(self, size: int, **row) -> None:
        self.rows.append(row)
        self.size += size

    def full(self) -> bool:
        return len(self.rows) >= 2000 or self.size > 4 << 20

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in self.rows], f.type) for f in self.schema], schema=self.schema)
        self.rows, self.size = [], 0
        return out


def _tuples(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[c.to_pylist() for c in batch.columns], strict=True)


def _packed(numbers: list[list[int]]) -> bytes:
    return np.array(numbers, np.int64).reshape(-1, 2).tobytes()


def _unpacked(raw: bytes) -> list[list[int]]:
    return np.frombuffer(raw, np.int64).reshape(-1, 2).tolist()


SUMS = ("blank", "duplicate", "truncated", "illegal", "turns", "cost")
COUNTS = (*SUMS, "low", "high")
EDIT = ("edit", "times", "turn", "role", "text")


class Shapes:
    """Schemas of the rows that pass between the steps, for a type of conv_id."""

    def __init__(self, conv):
        self.conv = conv
        flat = lambda names, kind: [(n, kind) for n in names]
        self.edit = self.of([("block", LongType()), ("seq", LongType()), ("edit", StringType()), *flat(("times", "turn"), LongType()), *flat(("role", "text"), StringType())])
        self.chunk = self.of([("block", LongType()), ("seq", LongType()), ("audit", StringType()), ("raw", BinaryType()), *flat(COUNTS, LongType())])
        self.block = self.of([("block", LongType()), ("runs", BinaryType()), ("matrix", ArrayType(LongType())), ("initials", ArrayType(StringType())), *flat(COUNTS, LongType())])
        self.turn = self.of([("block", LongType()), ("seq", LongType()), *flat(("turn", "n"), LongType()), *flat(("role", "text"), StringType()), *flat(("is_blank", "is_cut", "is_first"), BooleanType())])
        self.behind = self.of([("block", LongType()), ("behind", ArrayType(LongType())), ("whole_cost", LongType())])
        self.done = self.of([("gaps", LongType()), *flat(("blank", "duplicate", "truncated", "illegal", "cost"), LongType()), *flat(("audit", "repaired_sha256"), StringType())])

    def of(self, fields) -> StructType:
        out = StructType().add("conv_id", self.conv)
        for name, kind in fields:
            out.add(name, kind)
        return out

    def first(self, results: StructType) -> StructType:
        """Rows of the first pass: of finished conversations, of blocks, and of rows of blocks."""
        out = StructType().add("kind", "string")
        for shape in (results, self.block, self.turn):
            for field in shape:
                if field.name not in out.names:
                    out.add(field)
        return out


def gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


class Pieces:
    """Puts the edits of a conversation or block together: letters, and a stream of `role:text` lines, each with its newline in front."""

    def __init__(self):
        self.letters, self.lines, self.size = [], [], 0

    def add(self, letter: str, times: int, role: str | None, text: str | None) -> None:
        self.letters.append(letter * times)
        if letter != "D":
            self.lines.append(f"\n{role}:{text}")
            self.size += len(role) + len(text)
        self.size += times

    def taken(self) -> tuple[str, bytes]:
        out = "".join(self.letters), "".join(self.lines).encode("utf-8", "replace")
        self.__init__()
        return out


def counted(block: Block, cost: int = 0) -> dict:
    return {name: getattr(block, name) for name in COUNTS if name != "cost"} | {"cost": cost}


def _first_pass(results: str, schema: StructType, block_rows: int):
    """Finish the conversations inside the range of a task; give out the blocks and rows of the others."""
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, block = Rows(shape), TaskContext.get().partitionId() << 32
        held: Block | None = None
        split = True  # the first conversation may have begun in the range before

        def close(split: bool) -> None:
            nonlocal block
            block += 1
            runs = collapsed(held.symbols)
            if split:
                matrix = [x for row in transition(runs) for x in row]
                out.add(16 * len(runs), kind="block", conv_id=held.conv, block=block, runs=_packed(runs), matrix=matrix, initials=held.initials, **counted(held))
                for seq, (turn, role, text, n, blank, cut, first) in enumerate(held.rows):
                    out.add(len(role) + len(text), kind="turn", conv_id=held.conv, block=block, seq=seq, turn=turn, n=n, role=role, text=text, is_blank=blank, is_cut=cut, is_first=first)
                return
            if results == "edits":
                for seq, edit in enumerate(held.edits(END, START, True)):
                    out.add(len(edit[4] or ""), kind="result", conv_id=held.conv, block=block, seq=seq, **dict(zip(EDIT, edit, strict=True)))
                return
            cost, pieces = END, Pieces()
            for symbol, n in reversed(runs):
                cost = after(power(symbol, n), cost)
            for letter, times, _, role, text in held.edits(END, START, True):
                pieces.add(letter, times, role, text)
            audit, raw = pieces.taken()
            counts = {name: getattr(held, name) for name in ("blank", "duplicate", "truncated", "illegal")}
            sha = hashlib.sha256(raw[1:]).hexdigest()
            out.add(len(audit), kind="result", conv_id=held.conv, gaps=gaps(held.low, held.high, held.turns), cost=cost[START], audit=audit, repaired_sha256=sha, **counts)

        for conv, *row in _tuples(batches):
            if held is None or held.conv != conv:
                if held is not None:
                    close(split)
                    split = False
                held = Block(conv)
            elif len(held.rows) >= block_rows or held.bytes >= BLOCK_BYTES:
                split = True
                close(split)
                held = Block(conv)
            held.add(*row)
            if out.full():
                yield out.batch()
        if held is not None:
            close(True)  # may go on in the range behind
        yield out.batch()

    return run


def _backward(schema: StructType):
    """Costs behind each block, from the blocks of a conversation in falling order."""
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, v = Rows(shape), (), END
        for conv, block, matrix in _tuples(batches):
            if at != (conv,):
                at, v = (conv,), END
            behind, v = v, after(tuple([tuple(matrix[i : i + 4]) for i in range(0, 16, 4)]), v)
            out.add(64, conv_id=conv, block=block, behind=list(behind), whole_cost=v[START])
            if out.full():
                yield out.batch()
        yield out.batch()

    return run


def _ends(schema: StructType, place: int):
    """Adds to each block the state behind it from each state before it."""
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for raw, behind in zip(batch.column(place).to_pylist(), batch.column(place + 1).to_pylist(), strict=True):
                runs, own = _unpacked(raw), []
                for state in range(4):
                    end = state
                    for _, _, end in unrolled(runs, tuple(behind), state):
                        pass
                    own.append(end)
                ends.append(own)
            columns = [c for i, c in enumerate(batch.columns) if i != place]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ends, pa.list_(pa.int64()))], schema=shape)

    return run


def _forward(schema: StructType):
    """State before each block, from the blocks of a conversation in order; what meets at a seam goes into the later block's counts."""
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at, waiting = Rows(shape), (), None
        for batch in batches:
            for row in batch.to_pylist():
                conv, ends = row["conv_id"], row.pop("ends")
                if waiting:
                    out.add(200, **waiting, last=at != (conv,))
                if at != (conv,):
                    at, state, high, initial = (conv,), START, None, None
                    row["cost"] = row["whole_cost"]
                if row["initials"]:
                    if initial is not None:
                        row["illegal"] += initial + row["initials"][0] not in ("su", "ua", "au")
                    initial = row["initials"][-1]
                if row["low"] is not None:
                    row["turns"] -= row["low"] == high
                    high = row["high"]
                row["state"], state = state, ends[state]
                waiting = row
                if out.full():
                    yield out.batch()
        if waiting:
            out.add(200, **waiting, last=True)
        yield out.batch()

    return run


def _unroll(results: str, schema: StructType):
    """The edits of one block, or chunks of its audit and lines; the first chunk carries the block's counts."""
    shape = to_arrow_schema(schema)

    def run(turns: pa.Table, blocks: pa.Table) -> pa.Table:
        out, pieces = Rows(shape), Pieces()
        (info,) = blocks.to_pylist()
        block = Block(info["conv_id"])
        for row in turns.sort_by("seq").to_pylist():
            block.add(row["turn"], row["role"], row["text"], row["is_blank"], row["is_cut"], row["is_first"], row["n"])
        same, seq, counts = {"conv_id": info["conv_id"], "block": info["block"]}, 0, {name: info[name] for name in COUNTS}
        for edit in block.edits(tuple(info["behind"]), info["state"], info["last"]):
            if results == "edits":
                out.add(0, **same, seq=seq, **dict(zip(EDIT, edit, strict=True)))
                seq += 1
                continue
            pieces.add(edit[0], edit[1], edit[3], edit[4])
            if pieces.size > CHUNK:
                audit, raw = pieces.taken()
                out.add(0, **same, seq=seq, audit=audit, raw=raw, **(counts if not seq else {}))
                seq += 1
        if results != "edits":
            audit, raw = pieces.taken()
            out.add(0, **same, seq=seq, audit=audit, raw=raw, **(counts if not seq else {}))
        return pa.Table.from_batches([out.batch()])

    return run


def _joined(schema: StructType):
    """One row per conversation from its chunks in order; holds the letters and the state of the hash."""
    shape = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, at = Rows(shape), ()
        letters, sha, began, sums = [], hashlib.sha256(), False, {}

        def close() -> None:
            audit, span = "".join(letters), gaps(sums["low"], sums["high"], sums["turns"])
            own = {n: sums[n] for n in SUMS if n != "turns"}
            out.add(len(audit), conv_id=at[0], gaps=span, audit=audit, repaired_sha256=sha.hexdigest(), **own)

        for batch in batches:
            for row in batch.to_pylist():
                if at != (row["conv_id"],):
                    if at:
                        close()
                    at, letters, sha, began = (row["conv_id"],), [], hashlib.sha256(), False
                    sums = {n: 0 for n in SUMS} | {"low": None, "high": None}
                letters.append(row["audit"])
                raw = row["raw"]
                sha.update(raw if began else raw[1:])
                began = began or bool(raw)
                for name in SUMS:
                    sums[name] += row[name] or 0
                if row["low"] is not None:
                    sums["low"], sums["high"] = row["low"] if sums["low"] is None else sums["low"], row["high"]
                if out.full():
                    yield out.batch()
        if at:
            close()
        yield out.batch()

    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows after damage and how often each is there; a dropped row is left as one of no times."""
    space = F.lit(" ")
    mark = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(mark.cast("binary")) % 20).alias("harm"))
    harm = F.col("harm")
    gone = harm == 0
    return rows.select(
        "conv_id",
        F.when(~gone, F.col("turn")).alias("turn"),
        F.when(gone, "").when(harm == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(gone | (harm == 1), "").when(harm == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(gone, 0).when(harm == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def _ordered(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows with their faults, each equal row of a turn once, in ranges by conversation and order."""
    n = F.col("n").cast("long") if "n" in turns.columns else F.lit(1).cast("long")
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), n.alias("n"))
    rows = scratch.store(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")), "turns")
    # A row is a duplicate unless its turn is the first with this role and text. Few texts come at several turns: only those are looked up.
    key = ["conv_id", "role", F.sha2("text", 256).alias("text_hash")]
    several = rows.where("n > 0").groupBy(*key).agg(F.count("*").alias("rows"), F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("nulls"))
    several = scratch.store(several.where("rows > 1").select("conv_id", "role", "text_hash", F.when(~F.col("nulls"), F.col("least")).alias("first_turn"), F.lit(True).alias("again")), "first-turns")
    r, s = rows.withColumn("text_hash", F.sha2("text", 256)).alias("r"), several.alias("s")
    same = F.col("r.conv_id").eqNullSafe(F.col("s.conv_id")) & (F.col("r.role") == F.col("s.role")) & (F.col("r.text_hash") == F.col("s.text_hash"))
    first = F.col("again").isNull() | F.col("turn").eqNullSafe(F.col("first_turn"))
    judged = r.join(s, same, "left").select(
        "r.conv_id",
        "turn",
        "r.role",
        "text",
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"),
        first.alias("first"),
        "n",
    )
    ranges = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), F.substring("role", 1, PREFIX), F.substring("text", 1, PREFIX)]
    return judged.repartitionByRange(*ranges).sortWithinPartitions(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")


def _in_order(df: DataFrame, *order) -> DataFrame:
    return df.repartition("conv_id").sortWithinPartitions("conv_id", *order)


def _repaired(turns: DataFrame, results: str, block_rows: int) -> DataFrame:
    scratch, shapes = Scratch(turns.sparkSession, "conversations"), Shapes(turns.schema["conv_id"].dataType)
    result = shapes.edit if results == "edits" else shapes.done
    schema = shapes.first(result)
    found = scratch.store(_ordered(turns, scratch).mapInArrow(tidy(_first_pass(results, schema, block_rows)), schema), "first-pass")
    blocks = found.where("kind = 'block'").select(*shapes.block.names)
    rows = found.where("kind = 'turn'").select(*shapes.turn.names)

    behind = _in_order(blocks.select("conv_id", "block", "matrix"), F.desc("block")).mapInArrow(_backward(shapes.behind), shapes.behind)
    facts = blocks.drop("matrix", "runs").join(behind.drop("conv_id"), "block")
    facts = facts.join(blocks.select("block", "runs"), "block").select("conv_id", "block", "initials", *COUNTS, "whole_cost", "runs", "behind")
    place = facts.columns.index("runs")
    told = facts.drop("runs").schema.add("ends", ArrayType(LongType()))
    known = facts.drop("runs").schema.add("state", "long").add("last", "boolean")
    blocks = _in_order(facts.mapInArrow(_ends(told, place), told), "block").mapInArrow(_forward(known), known)

    unrolled_to = shapes.edit if results == "edits" else shapes.chunk
    parts = rows.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(_unroll(results, unrolled_to), unrolled_to)
    split = parts if results == "edits" else _in_order(parts, "block", "seq").mapInArrow(_joined(result), result)
    return found.where("kind = 'result'").select(*result.names).unionByName(split)


def repaired_turns(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The cheapest edits of conversations (conv_id, turn, role, text, and n for how often a row is there, if there is such a column).

    conv_id, block, seq (the order within a conversation is by both), edit (K, R, D or I), times (equal rows deleted together), turn,
    role and text after the edit; a deleted row has no text, an inserted one no turn.
    """
    return _repaired(turns, "edits", block_rows)


def repaired_conversations(turns: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per conversation: gaps, faults, illegal neighbours, cost, the letters of the edits, and the hash of what is left."""
    return _repaired(turns, "digest", block_rows)


def conversation_digest(conversations: DataFrame) -> DataFrame:
    return repaired_conversations(damaged(conversations))
