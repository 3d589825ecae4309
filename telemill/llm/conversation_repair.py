"""Structure of conversations: faults counted, and the cheapest edits that repair them.

Rows of a conversation are taken by turn (nulls first), rows of one turn by role and text. Faults
and costs are those of ``edit_paths``. Equal rows of a turn are one row with a count from the
first shuffle on. A row is a duplicate if its role and text stood at an earlier turn: the first
turns come from an aggregate that is joined back, so no conversation is gathered for it.

Rows are then dealt by ranges of (conversation, turn) and read in order. A conversation that ends
within its task is solved there. Others, and very long ones, are cut into fragments of bounded size,
each solved from every state that may precede it; the solutions of a conversation's fragments are
put together in a second, narrow step, and its text is read in order, never held.

Defined results: a null role or text counts as one space; a null conv_id is a conversation of its
own; an empty table gives an empty table. ``times`` (a column of the rows, 1 if it is absent) says
how often a row stands there; a conversation of rows that stand nowhere has zeros, no edits and
the hash of the empty string. Further columns are not read. Texts are compared by two 64-bit hashes
where a duplicate is sought. The gap count is held at the largest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import chain, repeat

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemill.llm.common import blocks, written
from telemill.llm.edit_paths import ACCEPTED, NOTHING, STATES, Turn, replay, solve

WHITE = " \t\n\x0b\x0c\r"
ORDERED = ("su", "ua", "au")
FRAGMENT_ROWS, FRAGMENT_CHARS, MOST = 4_096, 4 << 20, (1 << 63) - 1
KEY = ("turn", "role", "text")

_COUNTS = "blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_FRAGMENT = (
    f"piece bigint, closed boolean, gaps bigint, lo bigint, hi bigint, turns bigint, {_COUNTS}, first string, last string, "
    "solutions array<struct<start:int,end:int,cost:bigint,edits:string>>, roles array<string>, texts array<string>, times array<bigint>"
)
_CHOICE = f"piece bigint, start int, edits string, ends boolean, gaps bigint, {_COUNTS}, cost bigint, audit string"


def damage(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text, times) after damage that a crc32 of ``conv_id:turn`` deals out."""
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", spaced("conv_id"), spaced("turn"))) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.translate(spaced("text"), ".!?", "")).otherwise(spaced("text"))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(spaced("role")).alias("role"),
        text.alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("times"),
    )


def _counted(rows: DataFrame) -> DataFrame:
    """One row per (conv_id, turn, role, text) with the number of times it stands there.

    Rows that stand nowhere only say that there is such a conversation: they lose all but its id.
    """
    times = F.col("times") if "times" in rows.columns else F.lit(1)
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    there = lambda value: F.when(times > 0, value)
    cells = [there(F.col("turn").cast("bigint")).alias("turn"), there(spaced("role")).alias("role"), there(spaced("text")).alias("text")]
    return rows.select("conv_id", *cells, times.cast("bigint").alias("times")).groupBy("conv_id", *KEY).agg(F.sum("times").alias("times"))


def _place(turn: Column) -> Column:
    """Turns in order, nulls first, as a value that is never null."""
    return F.struct(turn.isNotNull().alias("known"), turn.alias("turn"))


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows in order over ranges of (conversation, turn), with what decides their faults."""
    content = [F.xxhash64("role", "text").alias("a"), F.xxhash64(F.lit("second"), "role", "text").alias("b")]
    counted = _counted(rows).withColumns({"a": content[0], "b": content[1]})
    spaced = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    there = rows.filter("times > 0") if "times" in rows.columns else rows
    seen = there.select("conv_id", _place(F.col("turn").cast("bigint")).alias("at"), spaced("role").alias("role"), spaced("text").alias("text"))
    seen = seen.select("conv_id", "at", *content).groupBy("conv_id", "a", "b").agg(F.min("at").alias("first"), F.max("at").alias("final"))
    again = seen.filter("first < final").select(F.col("conv_id").alias("again_id"), F.col("a").alias("again_a"), F.col("b").alias("again_b"), "first")
    same = F.col("conv_id").eqNullSafe(F.col("again_id")) & (F.col("a") == F.col("again_a")) & (F.col("b") == F.col("again_b"))
    joined = counted.join(again, same, "left")
    shown = F.rtrim(F.col("text"), F.lit(WHITE))
    marked = joined.select(
        "conv_id",
        *KEY,
        "times",
        F.left("role", F.lit(1)).alias("initial"),
        (shown == "").alias("blank"),
        F.coalesce(_place(F.col("turn")) > F.col("first"), F.lit(False)).alias("earlier"),
        (~F.right(shown, F.lit(1)).isin(".", "!", "?")).alias("cut"),
    )
    # beginnings of role and text keep the order of the whole ones and the sampled bounds small
    ranges = ["conv_id", "turn", F.left("role", F.lit(16)), F.left("text", F.lit(64))]
    return marked.repartitionByRange(*ranges).sortWithinPartitions("conv_id", *KEY)


class _Fragment:
    """Consecutive rows of one conversation."""

    def __init__(self, conv: object, opened: bool) -> None:
        self.conv, self.starts, self.chars = conv, STATES if opened else (NOTHING,), 0
        self.turns: list[Turn] = []
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.times: list[int] = []
        self.lo = self.hi = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, row: dict) -> None:
        times = row["times"]
        if not times:
            return
        if (turn := row["turn"]) is not None:
            self.distinct += turn != self.hi
            self.lo, self.hi = turn if self.lo is None else self.lo, turn
        initial, fresh = row["initial"], not (row["blank"] or row["earlier"])
        self.illegal += (self.last is not None and self.last + initial not in ORDERED) + times - 1
        self.first, self.last = initial if self.first is None else self.first, initial
        self.blank += times if row["blank"] else 0
        self.duplicate += 0 if row["blank"] else times - fresh
        self.truncated += fresh and row["cut"]
        self.turns.append(Turn(initial, not fresh, fresh and row["cut"]))
        self.turns.extend(repeat(Turn(initial, True, False), times - 1))
        self.roles.append(row["role"])
        self.texts.append(row["text"])
        self.times.append(times)
        self.chars += len(row["text"])

    def full(self) -> bool:
        return len(self.turns) >= FRAGMENT_ROWS or self.chars >= FRAGMENT_CHARS

    def row(self, piece: int, closed: bool) -> dict:
        solutions = [s._asdict() for start in self.starts for s in solve(self.turns, start)]
        if closed:  # only the way that is taken
            solutions = [min((s for s in solutions if s["end"] in ACCEPTED), key=lambda s: (s["cost"], s["edits"]))]
        return {
            "conv_id": self.conv, "piece": piece, "closed": closed, "gaps": _gaps(self.lo, self.hi, self.distinct), "lo": self.lo, "hi": self.hi, "turns": self.distinct,
            "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "first": self.first, "last": self.last, "solutions": solutions,
            "roles": self.roles, "texts": self.texts, "times": self.times,
        }


def _fragments(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Fragments of the conversations of one task, in order; the first and the last may go on in another task."""
    part = TaskContext.get().partitionId() << 32
    held: _Fragment | None = None
    made, out, chars = 0, [], 0
    for row in chain.from_iterable(batch.to_pylist() for batch in blocks(batches)):
        if held is not None and (ended := row["conv_id"] != held.conv or held.full()):
            same = row["conv_id"] == held.conv
            out.append(held.row(part + made, not same and held.starts == (NOTHING,)))
            chars, made = chars + held.chars, made + 1
            held = _Fragment(row["conv_id"], same)
            if chars >= FRAGMENT_CHARS or len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, chars = [], 0
        elif held is None:
            held = _Fragment(row["conv_id"], True)
        held.add(row)
    if held is not None:
        yield pa.RecordBatch.from_pylist([*out, held.row(part + made, False)], schema)


def _gaps(lo: int | None, hi: int | None, distinct: int) -> int:
    return 0 if lo is None else min(hi - lo + 1 - distinct, MOST)


class _Way:
    """The cheapest way through the fragments so far to one state: a link back and the edits of a fragment."""

    def __init__(self, cost: int, before: "_Way | None", start: int, edits: str) -> None:
        self.cost, self.before, self.start, self.edits = cost, before, start, edits

    def pieces(self) -> list["_Way"]:
        out, way = [], self
        while way.before is not None:
            out.append(way)
            way = way.before
        return out[::-1]

    def less(self, other: "_Way") -> bool:
        mine, theirs = self.pieces(), other.pieces()
        shared = next((i for i, (a, b) in enumerate(zip(mine, theirs)) if a is not b), 0)
        return "".join(w.edits for w in mine[shared:]) < "".join(w.edits for w in theirs[shared:])


def _choices(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """For each fragment of a conversation the state it starts in and its edits; the last carries the totals."""
    conv: object = None
    pieces: list[dict] = []
    ways: dict[int, _Way] = {}
    rows = chain.from_iterable(batch.slice(i, 1).to_pylist() for batch in batches for i in range(batch.num_rows))

    def chosen() -> pa.RecordBatch:
        best = None
        for state in ACCEPTED:
            way = ways.get(state)
            if way and (best is None or way.cost < best.cost or (way.cost == best.cost and way.less(best))):
                best = way
        lo = hi = last = None
        distinct = illegal = 0
        for p in pieces:
            distinct += p["turns"] - (hi is not None and hi == p["lo"])
            lo, hi = p["lo"] if lo is None else lo, hi if p["hi"] is None else p["hi"]
            illegal += p["illegal"] + (last is not None and p["first"] is not None and last + p["first"] not in ORDERED)
            last = last if p["last"] is None else p["last"]
        steps = best.pieces()
        out = [
            {"conv_id": conv, "piece": p["piece"], "start": w.start, "edits": w.edits, "ends": False} for p, w in zip(pieces, steps)
        ]
        total = {name: sum(p[name] for p in pieces) for name in ("blank", "duplicate", "truncated")}
        out[-1] |= total | {"ends": True, "gaps": _gaps(lo, hi, distinct), "illegal": illegal, "cost": best.cost, "audit": "".join(w.edits for w in steps)}
        return pa.RecordBatch.from_pylist(out, schema)

    for row in rows:
        if not pieces or row["conv_id"] != conv:
            if pieces:
                yield chosen()
            conv, pieces, ways = row["conv_id"], [], {NOTHING: _Way(0, None, NOTHING, "")}
        solutions = row.pop("solutions")
        found: dict[int, _Way] = {}
        for s in solutions:
            if (before := ways.get(s["start"])) is not None:
                way = _Way(before.cost + s["cost"], before, s["start"], s["edits"])
                held = found.get(s["end"])
                if held is None or way.cost < held.cost or (way.cost == held.cost and way.less(held)):
                    found[s["end"]] = way
        ways = found
        pieces.append(row)
    if pieces:
        yield chosen()


def _repeated(row: dict) -> Iterator[tuple[str, str]]:
    return chain.from_iterable(repeat((role, text), n) for role, text, n in zip(row["roles"], row["texts"], row["times"]))


def _digests(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Verdicts: fragments come in order, the hash of a conversation's repaired text goes on from one to the next."""
    state, begun = hashlib.sha256(), False
    for batch in batches:
        out = []
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            for _, role, text in replay(_repeated(row), row["start"], row["edits"]):
                state.update((f"\n{role}:{text}" if begun else f"{role}:{text}").encode())
                begun = True
            if row["ends"]:
                out.append({name: row[name] for name in schema.names[:-1]} | {"repaired_sha256": state.hexdigest()})
                state, begun = hashlib.sha256(), False
        yield pa.RecordBatch.from_pylist(out, schema)


def _turns(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            new = replay(_repeated(row), row["start"], row["edits"])
            out = [{"conv_id": row["conv_id"], "piece": row["piece"], "line": k, "edit": e, "role": r, "text": t} for k, (e, r, t) in enumerate(new)]
            yield pa.RecordBatch.from_pylist(out, schema)


class Repair:
    """The repaired form of conversations; the fragments are computed once, into the shared folder."""

    def __init__(self, rows: DataFrame) -> None:
        self.kind = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType)])
        made = self._mapped(_ordered(rows), _fragments, _FRAGMENT)
        self.fragments = written(made, "conversation-fragments")
        parts = self.fragments.filter("not closed").drop("closed", "roles", "texts", "times")
        parts = parts.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
        self.choices = written(self._mapped(parts, _choices, _CHOICE), "conversation-choices")

    def _mapped(self, frame: DataFrame, function, columns: str) -> DataFrame:
        from pyspark.sql.pandas.types import to_arrow_schema

        kind = T.StructType([*self.kind.fields, *T.StructType.fromDDL(columns).fields])
        return frame.mapInArrow(partial(function, schema=to_arrow_schema(kind)), kind)

    def _decided(self) -> tuple[DataFrame, DataFrame]:
        """Fragments with their edits: whole conversations, and pieces of the others in order."""
        edits = F.col("solutions")[0]
        content = ("roles", "texts", "times")
        counts = ("blank", "duplicate", "truncated", "illegal")
        whole = self.fragments.filter("closed").select(
            "conv_id", "piece", edits["start"].alias("start"), edits["edits"].alias("edits"), F.lit(True).alias("ends"),
            "gaps", *counts, edits["cost"].alias("cost"), edits["edits"].alias("audit"), *content,
        )
        pieces = self.fragments.filter("not closed").select("conv_id", "piece", *content)
        # a piece number names one fragment of one conversation
        pieces = pieces.join(self.choices.drop("conv_id"), "piece").select(whole.columns)
        return whole, pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")

    def verdicts(self) -> DataFrame:
        """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation."""
        columns = f"gaps bigint, {_COUNTS}, cost bigint, audit string, repaired_sha256 string"
        whole, pieces = [self._mapped(frame, _digests, columns) for frame in self._decided()]
        return whole.unionByName(pieces)

    def turns(self) -> DataFrame:
        """(conv_id, piece, line, edit, role, text): the rows that are left or added, ordered by piece and line."""
        columns = "piece bigint, line bigint, edit string, role string, text string"
        whole, pieces = [self._mapped(frame, _turns, columns) for frame in self._decided()]
        return whole.unionByName(pieces)
