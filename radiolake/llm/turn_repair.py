"""Repair of the turns of conversations by a generalised LR parse with weighted edits.

The grammar over role initials is S -> empty | s P | P, P -> u a | P u a. Each turn may be kept,
reroled or deleted, and turns may be inserted. All ways are followed at once: the stacks share their
lower parts, and when two ways reach the same stack the one with the least (cost, audit) stays. The
audit is the string of the edits' initials, so the least in ASCII wins a tie. Of two different audits
of equal cost for the same turns none begins with the other, so that choice holds whatever follows.

A conversation may hold a third of all rows. Turns are range-sorted, ranges cut through
conversations, and a range is parsed in blocks of BLOCK turns: a fragment tells, for each stack below
a block, the stacks it can leave on top, each with its cost and audit. Fragments are joined in rounds,
first within a range, then FAN ranges at a time. Texts take no part in this; they are met again when
the edits are replayed, as a stream in the order of the turns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from radiolake.llm.text import SPACES, join_same
from radiolake.session import stage

#: Turns parsed at once, and fragments joined at once.
BLOCK = 512
FAN = 64

#: What an edit costs; a truncated turn that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
NAMES = {"u": "user", "a": "assistant"}

# The LR(0) table of the grammar. After a shift that ends a right side the reduction follows at once.
_SHIFT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 5, (3, "u"): 6, (4, "u"): 6, (6, "a"): 7}
_REDUCE = {5: 2, 7: 3}  # state -> length of the right side; all of them reduce to P
_GOTO = {0: 3, 1: 4}
_ACCEPT = {0, 3, 4}


def _push(stack: tuple[int, ...], symbol: str) -> tuple[int, ...] | None:
    """The stack after a shift and the reductions that follow; None where the table has no shift."""
    state = _SHIFT.get((stack[-1], symbol))
    if state is None:
        return None
    stack = (*stack, state)
    while stack[-1] in _REDUCE:
        stack = stack[: -_REDUCE[stack[-1]]]
        stack = (*stack, _GOTO[stack[-1]])
    return stack


def _all_stacks() -> list[tuple[int, ...]]:
    found, todo = [(0,)], [(0,)]
    while todo:
        stack = todo.pop()
        for symbol in "sua":
            after = _push(stack, symbol)
            if after and after not in found:
                found.append(after)
                todo.append(after)
    return found


STACKS = _all_stacks()
_NUMBER = {stack: i for i, stack in enumerate(STACKS)}
#: Stack -> symbol -> stack, by number.
_MOVES = [{x: _NUMBER[t] for x in "sua" if (t := _push(s, x))} for s in STACKS]
_ENDS = {i for i, s in enumerate(STACKS) if s[-1] in _ACCEPT}

# A turn as one letter: its initial, upper case if truncated, x for any other, d if it has to go.
_MUST_GO = "d"

Tops = dict[int, tuple[int, str]]


def _offer(tops: Tops, stack: int, cost: int, audit: str) -> bool:
    held = tops.get(stack)
    if held is None or (cost, audit) < held:
        tops[stack] = (cost, audit)
        return True
    return False


def _with_inserts(tops: Tops) -> Tops:
    todo = list(tops)
    while todo:
        stack = todo.pop()
        cost, audit = tops[stack]
        for symbol in "ua":
            after = _MOVES[stack].get(symbol)
            if after is not None and _offer(tops, after, cost + INSERT, audit + "I"):
                todo.append(after)
    return tops


@lru_cache(maxsize=65_536)
def _steps(letter: str) -> tuple[tuple[tuple[int, str, int], ...], ...]:
    """Per stack the (cost, initial of the edit, stack after) that a turn allows."""
    steps = []
    for stack, moves in enumerate(_MOVES):
        own = [(DELETE, "D", stack)]
        if letter != _MUST_GO:
            more = TRUNCATED if letter.isupper() else 0
            kept = moves.get(letter.lower())
            if kept is not None:
                own.append((more, "K", kept))
            own += [(more + REROLE, "R", moves[x]) for x in "ua" if x in moves]
        steps.append(tuple(own))
    return tuple(steps)


def _parse(letters: str, entry: int) -> Tops:
    tops = _with_inserts({entry: (0, "")})
    for letter in letters:
        steps, after = _steps(letter), {}
        for stack, (cost, audit) in tops.items():
            for price, edit, top in steps[stack]:
                _offer(after, top, cost + price, audit + edit)
        tops = _with_inserts(after)
    return tops


@lru_cache(maxsize=65_536)
def _short(letters: str, entry: int) -> tuple:
    return tuple((entry, top, *w) for top, w in _parse(letters, entry).items())


def _paths(letters: str, whole: bool) -> list[tuple]:
    """(entry, exit, cost, audit) from the empty stack, and from all if the block may not be the first."""
    entries = range(len(STACKS)) if whole else (0,)
    run = _short if len(letters) <= 16 else _short.__wrapped__
    return [p for e in entries for p in run(letters, e)]


def _legal(pair: str) -> bool:
    return pair in ("su", "ua", "au")


def _joined(left: dict, right: dict) -> dict:
    """Two fragments as one; where ways meet in a stack, the least (cost, audit) stays."""
    best: dict[tuple[int, int], tuple[int, str]] = {}
    onward: dict[int, list] = {}
    for p in right["paths"]:
        onward.setdefault(p["entry"], []).append(p)
    for p in left["paths"]:
        for q in onward.get(p["exit"], ()):
            way, offer = (p["entry"], q["exit"]), (p["cost"] + q["cost"], p["audit"] + q["audit"])
            if way not in best or offer < best[way]:
                best[way] = offer
    return {
        "first": left["first"],
        "last": right["last"],
        "illegal": left["illegal"] + right["illegal"] + (not _legal(left["last"] + right["first"])),
        "paths": [{"entry": e, "exit": x, "cost": c, "audit": a} for (e, x), (c, a) in best.items()],
    }


_PATH = T.StructType(
    [
        T.StructField("entry", T.IntegerType()),
        T.StructField("exit", T.IntegerType()),
        T.StructField("cost", T.LongType()),
        T.StructField("audit", T.StringType()),
    ]
)
FRAGMENT = T.StructType(
    [
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("illegal", T.LongType()),
        T.StructField("paths", T.ArrayType(_PATH)),
    ]
)
REPAIR = T.StructType(
    [T.StructField("illegal", T.LongType()), T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())]
)


@F.arrow_udf(FRAGMENT)
def _fragment(letters: pa.Array, initials: pa.Array, whole: pa.Array) -> pa.Array:
    rows = []
    for block, seen, every in zip(letters.to_pylist(), initials.to_pylist(), whole.to_pylist()):
        names = _PATH.fieldNames()
        rows.append(
            {
                "first": seen[0],
                "last": seen[-1],
                "illegal": sum(not _legal(seen[i : i + 2]) for i in range(len(seen) - 1)),
                "paths": [dict(zip(names, p)) for p in _paths(block, every)],
            }
        )
    return pa.array(rows, to_arrow_type(FRAGMENT))


@F.arrow_udf(FRAGMENT)
def _join_fragments(ordered: pa.Array) -> pa.Array:
    rows = []
    for parts in ordered.to_pylist():
        while len(parts) > 1:  # by pairs, so that a long audit is copied a few times only
            pairs = [_joined(a, b) for a, b in zip(parts[::2], parts[1::2])]
            parts = pairs + parts[len(parts) - len(parts) % 2 :]
        rows.append(parts[0])
    return pa.array(rows, to_arrow_type(FRAGMENT))


@F.arrow_udf(REPAIR)
def _best(fragments: pa.Array) -> pa.Array:
    rows = []
    for f in fragments.to_pylist():
        ends = [(p["cost"], p["audit"]) for p in f["paths"] if p["entry"] == 0 and p["exit"] in _ENDS]
        cost, audit = min(ends)
        rows.append({"illegal": f["illegal"], "cost": cost, "audit": audit})
    return pa.array(rows, to_arrow_type(REPAIR))


def _sorted_turns(turns: DataFrame) -> DataFrame:
    """Staged turns with `pos`, a number in the order conv_id, turn, role, digest.

    Turns equal in all of these are dealt to any number of tasks.
    """
    order = ["conv_id", "turn", "role", "digest", "_uid"]
    named = turns.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        F.monotonically_increasing_id().alias("_uid"),
    ).withColumn(
        "digest", F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    )
    ranges = named.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(ranges.drop("_uid").withColumn("pos", F.monotonically_increasing_id()), "sorted_turns")


def _faults(rows: DataFrame) -> DataFrame:
    """pos, conv_id, turn, initial and the first fault of each turn, NULL for none."""
    ending = F.rtrim("text", F.lit(SPACES))
    firsts = rows.groupBy("conv_id", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    slim = rows.select(
        "pos",
        "conv_id",
        "turn",
        F.substring("role", 1, 1).alias("initial"),
        (ending == "").alias("blank"),
        F.right(ending, F.lit(1)).isin(".", "!", "?").alias("ended"),
    )
    fault = (
        F.when(F.col("blank"), F.lit("blank"))
        .when(F.col("first").isNull(), F.lit("duplicate"))
        .when(~F.col("ended"), F.lit("truncated"))
    )
    return slim.join(firsts, "pos", "left").select("pos", "conv_id", "turn", "initial", fault.alias("fault"))


def _counts(faults: DataFrame) -> DataFrame:
    """Faults and gaps of each conversation."""
    kinds = ("blank", "duplicate", "truncated")
    by_turn = faults.groupBy("conv_id", "turn").agg(*[F.count_if(F.col("fault") == k).alias(k) for k in kinds])
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return by_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("long").alias("gaps"), *[F.sum(k).cast("long").alias(k) for k in kinds]
    )


def _letters(faults: DataFrame) -> DataFrame:
    known = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise(F.lit("x"))
    letter = (
        F.when(F.col("fault").isin("blank", "duplicate"), F.lit(_MUST_GO))
        .when(F.col("fault") == "truncated", F.upper(known))
        .otherwise(known)
    )
    return faults.select("conv_id", "pos", letter.alias("letter"), known.alias("initial"))


def _repairs(faults: DataFrame) -> DataFrame:
    """conv_id, illegal, cost, audit."""
    place = F.col("pos").bitwiseAND(F.lit((1 << 33) - 1))
    parsed = _letters(faults).withColumns({"range": F.shiftright("pos", 33), "block": F.floor(place / BLOCK)})
    # A block that begins inside a block of places is the first of its conversation.
    blocks = (
        parsed.groupBy("conv_id", "range", "block")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "letter", "initial"))).alias("turns"))
        .select(
            "conv_id",
            "range",
            F.col("block").cast("long").alias("place"),
            _fragment(
                F.array_join(F.col("turns.letter"), ""),
                F.array_join(F.col("turns.initial"), ""),
                F.col("turns")[0]["pos"].bitwiseAND(F.lit((1 << 33) - 1)) % BLOCK == 0,
            ).alias("fragment"),
        )
    )
    ranges = blocks.agg(F.max("range")).first()[0] or 0
    joined = stage(_join_round(blocks, "range"), "fragments")
    while True:
        merged = joined.select(
            "conv_id", F.floor(F.col("place") / FAN).alias("range"), "place", "fragment"
        )
        joined = _join_round(merged, "range")
        ranges //= FAN
        if ranges == 0:
            break
        joined = stage(joined, "fragments")
    return joined.select("conv_id", _best("fragment").alias("r")).select("conv_id", "r.*")


def _join_round(fragments: DataFrame, group: str) -> DataFrame:
    """conv_id, place (the group) and the joined fragment of each conversation and group."""
    gathered = fragments.groupBy("conv_id", group).agg(
        F.sort_array(F.collect_list(F.struct("place", "fragment"))).alias("parts")
    )
    return gathered.select(
        "conv_id", F.col(group).alias("place"), _join_fragments(F.col("parts.fragment")).alias("fragment")
    )


class _Replay:
    """The edits of one conversation, applied to its turns as they come."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.last = audit, 0, ""

    def _next(self) -> str:
        return "a" if self.last == "u" else "u"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at, self.last = self.at + 1, self._next()
            yield NAMES[self.last], ""

    def turn(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        yield from self.inserted()
        edit, self.at = self.audit[self.at], self.at + 1
        if edit == "K":
            self.last = role[0]
            yield role, text
        elif edit == "R":
            self.last = self._next()
            yield NAMES[self.last], text


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, Iterator[tuple[str, str]]]]:
    """Per row, in order, the row and the repaired turns that it gives. Rows: conv_id, kind, pos, role,
    text; kind 0 opens a conversation and has its audit, 1 is a turn, 2 closes it."""
    replay = None
    for batch in batches:
        for row in zip(*(column.to_pylist() for column in batch.columns)):
            if row[1] == 0:
                replay = _Replay(row[4])
                yield row, iter(())
            else:
                yield row, replay.inserted() if row[1] == 2 else replay.turn(row[3], row[4])


def _rows_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])
    held: list[tuple] = []
    position = 0
    for row, repaired in _stream(batches):
        if row[1] == 0:
            position = 0
        for role, text in repaired:
            held.append((row[0], position, role, text))
            position += 1
        if len(held) >= _ROWS_AT_ONCE:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _digests_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("conv_id", pa.int64()), ("repaired_sha256", pa.string())])
    held: list[tuple] = []
    digest, begun = hashlib.sha256(), False
    for row, repaired in _stream(batches):
        if row[1] == 0:
            digest, begun = hashlib.sha256(), False
        for role, text in repaired:
            digest.update(("\n" if begun else "").encode() + f"{role}:{text}".encode())
            begun = True
        if row[1] == 2:
            held.append((row[0], digest.hexdigest()))
        if len(held) >= _ROWS_AT_ONCE:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, field.type) for values, field in zip(zip(*rows), schema)], schema=schema
    )


def _replayed(rows: DataFrame, repairs: DataFrame, out, schema: str) -> DataFrame:
    """Streams each conversation through `out`, its turns in order between its opening and its end."""
    kind = lambda n: F.lit(n).alias("kind")
    none = F.lit(None).cast("string")
    turns = rows.select("conv_id", kind(1), "pos", "role", "text")
    edges = repairs.select("conv_id", F.explode(F.array(F.lit(0), F.lit(2))).alias("kind"), "audit").select(
        "conv_id", "kind", F.lit(0).cast("long").alias("pos"), none.alias("role"), F.col("audit").alias("text")
    )
    ordered = turns.unionByName(edges).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "pos")
    return ordered.mapInArrow(out, schema)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Faults and repairs per conversation, and the turns in order, as `repaired` needs them.

    `turns` has conv_id bigint, turn bigint, role, text; other columns are not read. Turns are ordered
    by turn, NULL first, then by role and digest; a NULL role or text is one space, a NULL conv_id is a
    conversation of its own. A turn's first fault counts: blank, duplicate (role and text of an earlier
    turn of the conversation), truncated. Blank and duplicate turns must go. Of equal turns any one is
    the first. Texts of any length count whole. No turns give no rows.

    The first frame has conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit; illegal
    counts neighbours as they were, before any edit.
    """
    rows = _sorted_turns(turns)
    faults = stage(_faults(rows), "faults")
    repairs = stage(join_same(_counts(faults), _repairs(faults), ["conv_id"]), "repairs")
    return repairs, rows


def repaired(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """conv_id, position, role, text: the turns that the edits leave, inserted ones with empty text."""
    return _replayed(rows, repairs, _rows_out, "conv_id bigint, position bigint, role string, text string")


def digests(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """conv_id, repaired_sha256 over `role:text` of the repaired turns, joined by newlines.

    SHA-256 reads a conversation from its first byte to its last, so one task streams each; it holds
    an Arrow batch of turns and the audit.
    """
    return _replayed(rows, repairs, _digests_out, "conv_id bigint, repaired_sha256 string")


#: Rows a task sends at once.
_ROWS_AT_ONCE = 4_096


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults planted by crc32 of `conv_id:turn`, NULLs being one space, modulo 20.

    0 drops the turn, 1 empties its text, 2 removes its full stops, exclamation and question marks,
    3 repeats it, 4 makes it the user's.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(shown("conv_id"), F.lit(":"), shown("turn"))) % 20
    role = F.when(F.col("_fate") == 4, F.lit("user")).otherwise(shown("role"))
    text = (
        F.when(F.col("_fate") == 1, F.lit(""))
        .when(F.col("_fate") == 2, F.translate(shown("text"), ".!?", ""))
        .otherwise(shown("text"))
    )
    copies = F.array_repeat(F.lit(0), F.when(F.col("_fate") == 3, 2).otherwise(1))
    named = turns.select("conv_id", "turn", "role", "text").withColumn("_fate", fate).filter("_fate <> 0")
    return named.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("_copy")).drop("_copy")


def repair_report(turns: DataFrame) -> DataFrame:
    """The damaged turns repaired: a row for every conv_id of `turns`, also where no turn is left."""
    repairs, rows = repair(damaged(turns))
    told = join_same(repairs, digests(rows, repairs), ["conv_id"])
    every = join_same(turns.select("conv_id").distinct(), told, ["conv_id"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return every.select(
        "conv_id",
        *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )
