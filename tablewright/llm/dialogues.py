"""Repair of the structure of conversations at least cost.

A repaired conversation has the roles `(system? (user assistant)+)?`, told by their initials.  Each row is kept
(K, free), given another role (R, 3) or deleted (D, 4), and rows with empty text may be inserted anywhere (I, 3);
a truncated row that stays costs 3 more, blank and duplicate rows must go.  Of the cheapest edits the one
whose letters are least in ASCII wins.

The method: one integer weighs a whole way of editing.  Its high digits are the cost; behind them stand the
letters in digits of three bits, the first letter highest, D < I < K < R, and zeros where the letters end, so
that a beginning of another audit is the lesser one.  From the last row to the first, the least weight of
what follows is kept for each of the four places in the pattern, and a plain integer minimum over the edges of
that acyclic graph decides cost and ties at once.  Long conversations need no long integers: after `BLOCK` rows the
four weights become their cost differences and one digit with the rank of their letters.  No way up to there is
the beginning of another one (all end with the letter of the same row), so every later comparison falls as it
would with all letters.

In Spark: one shuffle by conversation.  Duplicates are counted there by a window; then rows stream backwards
through the search, which notes for each row and place the best edit, and forwards through the repair, which
follows those notes and feeds digest and audit.  All sorts are local and can spill; Python holds one block and one row,
however long a conversation is.  One conversation is one stream, because its digest is one value.

Nulls count as one blank in role, text and in the key of the damage; a null turn comes first.  Rows with the same turn
follow by role, text and copy.  Roles that begin with no letter of the pattern can only be changed or deleted.
Null conversation ids are one conversation.  Empty tables give empty results; further columns are left behind.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from .frames import arrow_stage

BLOCK = 256
# Places in the pattern: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, PAIR = range(4)
PLACES = (START, SYSTEM, USER, PAIR)
NEXT = {
    START: {"s": SYSTEM, "u": USER},
    SYSTEM: {"u": USER},
    USER: {"a": PAIR},
    PAIR: {"u": USER},
}
ENDS = (START, PAIR)
NEW_ROLE = {"u": "user", "a": "assistant"}
TURN = {q: next(c for c in "ua" if c in NEXT[q]) for q in PLACES}  # the role that an inserted or changed row gets
MOST_INSERTED = 2  # a third one in a row would come back to an earlier place
DELETE, INSERT, KEEP, REROLE = 1, 2, 3, 4  # digits
LETTER = {DELETE: "D", INSERT: "I", KEEP: "K", REROLE: "R"}
PRICE = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED = 3
DIGIT = 3  # bits
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)  # the first fault of a row
LEGAL = {"su", "ua", "au"}


class Search:
    """Least weights from the rows read so far, last row first, and the best edit of each row."""

    def __init__(self, block: int = BLOCK) -> None:
        self.block = block
        self.width = DIGIT * ((1 + MOST_INSERTED) * block + MOST_INSERTED + 1)
        self.low = (1 << self.width) - 1
        self.rows = 0
        ends = {q: 0 for q in ENDS}
        self.best, _ = self.with_inserts(ends)

    def before(self, digit: int, cost: int, weight: int) -> int:
        """The weight with one more letter in front."""
        letters = weight & self.low
        return weight - letters + (cost << self.width) + (digit << self.width - DIGIT) + (letters >> DIGIT)

    def with_inserts(self, base: dict[int, int]) -> tuple[dict[int, int], dict[int, int]]:
        """Least weights if rows may be inserted first, and how many are."""
        best, number, latest = dict(base), dict.fromkeys(base, 0), base
        for n in range(1, MOST_INSERTED + 1):
            ways = {q: self.before(INSERT, PRICE[INSERT], latest[p]) for q in PLACES if (p := NEXT[q][TURN[q]]) in latest}
            for q, weight in ways.items():
                if q not in best or weight < best[q]:
                    best[q], number[q] = weight, n
            latest = ways
        return best, number

    def add(self, initial: str, fault: int) -> int:
        """Put a row in front; its best edits for all places, as one number."""
        if self.rows and self.rows % self.block == 0:
            self.shorten()
        self.rows += 1
        base, moves = {}, {}
        extra = TRUNCATED if fault == CUT_OFF else 0
        for q in PLACES:
            ways = [(DELETE, q)]
            if fault not in (BLANK, DUPLICATE):
                ways.append((REROLE, NEXT[q][TURN[q]]))
                if initial in NEXT[q]:
                    ways.append((KEEP, NEXT[q][initial]))
            found = [
                (self.before(digit, PRICE[digit] + (digit != DELETE) * extra, self.best[p]), digit, p)
                for digit, p in ways
                if p in self.best
            ]
            base[q], *moves[q] = min(found)
        self.best, number = self.with_inserts(base)
        return packed(number, moves)

    def shorten(self) -> None:
        """Letters become ranks and the least cost is taken off; no comparison changes."""
        ranks = {letters: r for r, letters in enumerate(sorted({w & self.low for w in self.best.values()}), 1)}
        least = min(self.best.values()) >> self.width
        self.best = {
            q: ((w >> self.width) - least << self.width) + (ranks[w & self.low] << self.width - DIGIT)
            for q, w in self.best.items()
        }


def packed(number: dict[int, int], moves: dict[int, list[int]]) -> int:
    """Seven bits a place: rows to insert, the letter of the row, the place behind it."""
    out = 0
    for q in PLACES:
        digit, after = moves[q]
        out |= (number[q] | digit << 2 | after << 5) << 7 * q
    return out


def unpacked(moves: int, place: int) -> tuple[int, int, int]:
    part = moves >> 7 * place
    return part & 3, part >> 2 & 7, part >> 5 & 3


class Repair:
    """A conversation from its first row to its last, by the noted edits."""

    def __init__(self) -> None:
        self.place, self.cost, self.audit, self.lines, self.digest = START, 0, [], 0, hashlib.sha256()
        self.faults = [0] * 4
        self.illegal, self.last = 0, None
        self.lowest = self.highest = self.seen_turn = None
        self.turns = 0

    def write(self, role: str, text: str) -> None:
        self.digest.update(f"{chr(10) if self.lines else ''}{role}:{text}".encode())
        self.lines += 1

    def insert(self, number: int) -> None:
        for _ in range(number):
            turn = TURN[self.place]
            self.write(NEW_ROLE[turn], "")
            self.place = NEXT[self.place][turn]
            self.audit.append(LETTER[INSERT])
            self.cost += PRICE[INSERT]

    def add(self, turn: int | None, role: str, text: str, fault: int, moves: int) -> None:
        self.faults[fault] += 1
        initial = role[:1]
        if self.last is not None and self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial
        if turn is not None and (self.turns == 0 or turn != self.seen_turn):  # turns come in order
            self.lowest = turn if self.turns == 0 else self.lowest
            self.highest = self.seen_turn = turn
            self.turns += 1
        number, digit, after = unpacked(moves, self.place)
        self.insert(number)
        number, digit, after = unpacked(moves, self.place) if number else (number, digit, after)
        self.audit.append(LETTER[digit])
        self.cost += PRICE[digit]
        if digit != DELETE:
            self.cost += TRUNCATED * (fault == CUT_OFF)
            self.write(role if digit == KEEP else NEW_ROLE[TURN[self.place]], text)
        self.place = after

    def finish(self) -> dict:
        self.insert({START: 0, PAIR: 0, USER: 1, SYSTEM: 2}[self.place])
        return {
            "gaps": min(self.highest - self.lowest + 1 - self.turns, 2**63 - 1) if self.turns else 0,
            "blank": self.faults[BLANK],
            "duplicate": self.faults[DUPLICATE],
            "truncated": self.faults[CUT_OFF],
            "illegal": self.illegal,
            "cost": self.cost,
            "audit": "".join(self.audit),
            "repaired_sha256": self.digest.hexdigest(),
        }


def damaged(rows: DataFrame) -> DataFrame:
    """The damage of the contract: `conv_id, turn, role, text, copy`; a dropped row stays as `copy` -1."""
    shown = {c: F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text")}
    kind = F.pmod(F.crc32(F.concat(shown["conv_id"], F.lit(":"), shown["turn"])), F.lit(20))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(shown["text"], "[.!?]", "")).otherwise(shown["text"])
    role = F.when(kind == 4, "user").otherwise(shown["role"])
    copies = F.when(kind == 0, F.array(F.lit(-1))).when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")
    )


def faults(rows: DataFrame) -> DataFrame:
    """Rows by conversation (one shuffle) with `fault`, the number of their first fault."""
    print128 = F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text")))
    known = rows.withColumn("print", F.when(F.col("copy") >= 0, print128)).repartition("conv_id")
    seen = Window.partitionBy("conv_id", "print").orderBy(F.col("turn").asc_nulls_first(), "copy")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    fault: Column = (
        F.when(last == "", BLANK)
        .when(F.row_number().over(seen) > 1, DUPLICATE)
        .when(~last.isin(".", "!", "?"), CUT_OFF)
        .otherwise(FINE)
    )
    return known.withColumn("fault", F.when(F.col("copy") < 0, FINE).otherwise(fault)).drop("print")


def _streamed(rows: DataFrame, backwards: bool) -> DataFrame:
    """Sorted where they are; whole conversations stay together because nothing is moved."""
    keys = [F.col("turn"), F.col("role"), F.col("text"), F.col("copy"), F.col("fault") == DUPLICATE]
    order = [k.desc_nulls_last() if backwards else k.asc_nulls_first() for k in keys]
    return rows.sortWithinPartitions("conv_id", *order)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def edits(rows: DataFrame) -> DataFrame:
    """Rows of `faults` with `moves`, their best edits, in the partitions in which they are."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current, state = object(), None
        for batch in batches:
            conv, role, copy, fault = (batch.column(c).to_pylist() for c in ("conv_id", "role", "copy", "fault"))
            moves = []
            for i in range(len(batch)):
                if state is None or conv[i] != current:
                    current, state = conv[i], Search()
                moves.append(0 if copy[i] < 0 else state.add(role[i][:1], fault[i]))
            yield dict(zip(batch.schema.names, batch.columns, strict=True)) | {"moves": moves}

    schema = StructType([*rows.schema.fields, StructField("moves", IntegerType())])
    return arrow_stage(_streamed(rows, True), schema, search, whole=True)


COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cheapest edits, and the digest of the repaired rows."""

    def repair(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        current, state = None, None

        def result() -> dict:
            return {"conv_id": [current]} | {name: [v] for name, v in state.finish().items()}

        for batch in batches:
            done = []
            for conv, turn, role, text, copy, fault, moves in _rows(batch):
                if state is None or conv != current:
                    if state is not None:
                        done.append(result())
                    current, state = conv, Repair()
                if copy >= 0:
                    state.add(turn, role, text, fault, moves)
            if done:
                yield {name: [v for d in done for v in d[name]] for name in done[0]}
        if state is not None:
            yield result()

    schema = StructType(
        [
            StructField("conv_id", rows.schema["conv_id"].dataType),
            *[StructField(c, LongType()) for c in COUNTS],
            StructField("audit", StringType()),
            StructField("repaired_sha256", StringType()),
        ]
    )
    ready = _streamed(edits(faults(rows)), False).select("conv_id", "turn", "role", "text", "copy", "fault", "moves")
    return arrow_stage(ready, schema, repair, whole=True)
