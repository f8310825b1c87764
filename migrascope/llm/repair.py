"""Conversation structure repair: the cheapest edits that give each conversation a legal run of roles.

A legal conversation is empty, or an optional system turn and then user and assistant turns in pairs. Edits: keep a
row (0), set its role to user or assistant (``Rerole``, 1), delete it (2; blank and repeated rows must go), insert a
user or assistant turn without text anywhere (5). A truncated row that stays adds 5. Of the cheapest edits those
are taken whose initials, in order, come first in ASCII order.

Costs are found by rank-convergence parallel Viterbi. The rows of a conversation are cut into chunks that tasks work
on at once. Each chunk runs backwards over its rows from a speculative vector of costs to the end, one cost for each
role state; only differences between the costs matter, so vectors are kept less their least entry. Then fix-up
passes: a chunk whose right neighbour's vector is not the one it started from runs again from the true one, until it
meets the vector it had at some row (the same up to a constant); nothing to the left of that changes. Passes end when
every chunk started from its neighbour's vector, which makes all vectors exact. The trace forward is chunked the same
way: a chunk starts in a guessed role state and is redone if the one before it ends in another.

There are few distinct vectors and row kinds, so a step is one lookup in a table that fills as it goes. Rows that must
be deleted leave every state as it is; a chunk of nothing else takes no part in the passes.

A pass is needed only where a conversation crosses chunks, and usually one or two do. The worst case, one role
repeated without end in one conversation, takes a pass per chunk of ``CHUNK`` rows.

Defined cases: a null conversation is one of its own; a null role or text is one space; rows of one turn sort by role,
then text; a null turn comes first; repeated rows are repeated turns; an empty table gives no rows; an empty role has
no initial and can't be kept; other columns are left out, whatever their names. The audit and the digest of a
conversation are one value each, so one task streams its rows in the end, holding a chunk's edits and the audit.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from migrascope.llm.common import arrow_type, written
from migrascope.llm.ordered import in_order

CHUNK = 8192
RAW, NONE = r"[^\x20\x09-\x0D]", r"[\x20\x09-\x0D]"

# States of the role sequence: nothing yet, after a system, a user, an assistant turn.
EMPTY, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = (EMPTY, ASSISTANT)
FOLLOWS = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # the state after the one turn that fits
KEPT = {(EMPTY, "s"): SYSTEM} | {(state, "ua"[after - USER]): after for state, after in FOLLOWS.items()}
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5

# A row's kind: its role's initial (o: any other) and what ails it (-: nothing, t: truncated, x: must go).
Vector = tuple[int, ...]


@functools.cache
def opened(vector: Vector) -> Vector:
    """Costs to the end when turns may be inserted first."""
    costs = list(vector)
    for _ in range(3):
        costs = [min(c, INSERT + costs[FOLLOWS[state]]) for state, c in enumerate(costs)]
    return tuple(costs)


def levelled(costs: list[int]) -> Vector:
    least = min(costs)
    return tuple(c - least for c in costs)


FAR = 1000  # stands for no way to the end; every state has one of at most two insertions
END = levelled(list(opened(tuple(0 if state in ACCEPTING else FAR for state in range(4)))))


def ways(vector: Vector, initial: str, ail: str, state: int) -> list[tuple[int, str, int]]:
    """(cost to the end, edit, next state) of the edits of one row; ``vector`` holds the costs after it."""
    out = [(DELETE + vector[state], "D", state)]
    if ail != "x":
        more = TRUNCATED if ail == "t" else 0
        if (state, initial) in KEPT:
            after = KEPT[state, initial]
            out.append((more + vector[after], "K", after))
        out.append((REROLE + more + vector[FOLLOWS[state]], "R", FOLLOWS[state]))
    return out


@functools.cache
def back(vector: Vector, kind: str) -> Vector:
    """Costs before a row of this kind, insertions before it included."""
    initial, ail = kind
    return levelled(list(opened(tuple(min(ways(vector, initial, ail, state))[0] for state in range(4)))))


@functools.cache
def forward(vector: Vector, kind: str, state: int) -> tuple[str, int]:
    """The first cheapest edits in ASCII order up to and with this row, and the state after it."""
    initial, ail = kind
    costs = opened(tuple(min(ways(vector, initial, ail, s))[0] for s in range(4)))
    edits = ""
    while True:
        fitting = [(edit, after) for cost, edit, after in ways(vector, initial, ail, state) if cost == costs[state]]
        if INSERT + costs[FOLLOWS[state]] == costs[state]:
            fitting.append(("I", FOLLOWS[state]))
        edit, state = min(fitting)
        edits += edit
        if edit != "I":
            return edits, state


def kinds_of(codes: str) -> list[str]:
    return [codes[i : i + 2] for i in range(0, len(codes), 2)]


def backward(codes: str, start: Vector) -> list[Vector]:
    """Costs after each row and before the first one, from the last row to the first."""
    out = [start]
    for kind in reversed(kinds_of(codes)):
        out.append(back(out[-1], kind))
    return out


def repaired_left(codes: str, old: Vector, new: Vector) -> Vector | None:
    """The left vector when the chunk starts from ``new``; None if it meets the run from ``old`` on the way."""
    for kind in reversed(kinds_of(codes)):
        old, new = back(old, kind), back(new, kind)
        if old == new:
            return None
    return new


def trace(codes: str, end: Vector, state: int) -> tuple[list[str], int]:
    """Edits of each row from the given state on, and the state after the last row."""
    vectors = backward(codes, end)
    edits = []
    for kind, vector in zip(kinds_of(codes), vectors[-2::-1], strict=True):
        done, state = forward(vector, kind, state)
        edits.append(done)
    return edits, state


def coded(vector: Vector) -> str:
    return ",".join(map(str, vector))


def decoded(text: str) -> Vector:
    return tuple(map(int, text.split(",")))


def blank(text: Column) -> Column:
    return ~text.rlike(RAW)


def truncated(text: Column) -> Column:
    """Whether the last character that is no white space is not the end of a sentence."""
    return ~text.rlike(rf"[.!?]{NONE}*\z")


def turns_of(rows: DataFrame) -> DataFrame:
    """(cid, turn, role, text): ``cid`` is the id as text, empty for a null one."""
    filled = [F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]
    return rows.select(F.coalesce(F.col("conv_id").cast("string"), F.lit("")).alias("cid"), F.col("turn").cast("long"), *filled)


def damaged(rows: DataFrame, parts: int = 20) -> DataFrame:
    """The rows with the faults that their ids' checksums name: dropped, emptied, cut, repeated or set to user."""
    turns = turns_of(rows)
    name = F.concat(F.when(F.col("cid") == "", " ").otherwise(F.col("cid")), F.lit(":"), F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    fault = F.crc32(name) % parts
    text = F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(fault == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(fault == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return turns.filter(fault != 0).select("cid", "turn", role.alias("role"), text.alias("text"), times.alias("time")).drop("time")


def same(chunk: bool = False) -> list[str]:
    return ["cid", "part", "chunk"] if chunk else ["cid", "role", "digest"]


def chunks_of(ordered: DataFrame) -> DataFrame:
    """A row for each chunk: its rows' kinds in order, and how many copies stand behind each."""
    text = F.col("text")
    initial = F.substring("role", 1, 1)
    plain = ordered.select(
        "cid", "role", "part", "idx", "chunk", "copies",
        F.md5("text").alias("digest"),
        F.when(initial.isin("s", "u", "a"), initial).otherwise("o").alias("initial"),
        F.when(blank(text), "x").when(truncated(text), "t").otherwise("-").alias("ail"),
    )
    place = F.struct("part", "idx")
    said = plain.groupBy(*same()).agg(F.min(place).alias("first"), F.count("*").alias("n"))
    again = said.filter("n > 1").drop("n")  # the few texts that a conversation says twice
    marked = plain.join(again, same(), "left")
    ail = F.when(place > F.col("first"), "x").otherwise(F.col("ail"))
    row = F.struct("idx", F.concat("initial", ail).alias("kind"), "copies")
    found = marked.groupBy(*same(chunk=True)).agg(F.array_sort(F.collect_list(row)).alias("rows"))
    return found.select(
        *same(chunk=True),
        F.concat_ws("", "rows.kind").alias("codes"),
        F.col("rows.copies").alias("copies"),
    )


def linked(chunks: DataFrame) -> DataFrame:
    """The chunks of conversations that have several, numbered so that neighbours differ by one.

    Chunks of rows that must go are left out. Numbers run inside a partition; what is before a partition comes
    from a table of one row each.
    """
    live = chunks.filter(F.col("codes").rlike("[suao][-t]")).select("cid", "part", "chunk", "codes")
    crossing = live.groupBy("cid").agg(F.count("*").alias("n")).filter("n > 1").select("cid")
    own = live.join(crossing, "cid")
    inside = own.withColumn("local", F.row_number().over(Window.partitionBy("part").orderBy("chunk", "cid")))
    sizes = inside.groupBy("part").agg(F.max("local").alias("size"))  # a row for each partition
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("part", F.coalesce(before, F.lit(0)).alias("offset"))
    return inside.join(offsets, "part").withColumn("g", F.col("local") + F.col("offset")).drop("local", "offset")


def mapped(df: DataFrame, schema: str, function: Callable[[dict], dict]) -> DataFrame:
    """``function`` on each row, in Arrow batches; rows are chunks, not turns."""
    kind_of = StructType.fromDDL(schema)
    kind = arrow_type(kind_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_pylist([function(row) for row in batch.to_pylist()], schema=kind)

    return df.mapInArrow(run, kind_of)


def settled(chunks: DataFrame, step: int, guess: str, start: Callable[[str, str], str], again: Callable[[str, str, str], str | None]) -> DataFrame:
    """(g, used, gave) of every chunk after fix-up passes.

    The neighbour that a chunk depends on is ``step`` numbers away. A first run uses ``guess``; a chunk whose
    neighbour of the same conversation gave something else is run again from that. ``again`` returns None where
    the result stays.
    """
    first = mapped(
        chunks.select("g", "cid", "codes"), "g long, cid string, used string, gave string",
        lambda r: {"g": r["g"], "cid": r["cid"], "used": guess, "gave": start(r["codes"], guess)},
    )
    state = written(first, "runs")
    while True:
        beside = state.select((F.col("g") - step).alias("g"), F.col("cid").alias("cid_"), F.col("gave").alias("given"))
        stale = state.join(beside, "g").filter("cid = cid_ AND given <> used").select("g", "used", "gave", "given")
        stale = written(stale, "stale")
        if stale.isEmpty():
            return state
        redone = mapped(
            stale.join(chunks.select("g", "codes"), "g"), "g long, used2 string, gave2 string",
            lambda r: {"g": r["g"], "used2": r["given"], "gave2": again(r["codes"], r["used"], r["given"]) or r["gave"]},
        )
        both = state.join(redone, "g", "left")
        state = written(both.select("g", "cid", F.coalesce("used2", "used").alias("used"), F.coalesce("gave2", "gave").alias("gave")), "runs")


def _start_cost(codes: str, guess: str) -> str:
    return coded(backward(codes, decoded(guess))[-1])


def _again_cost(codes: str, old: str, new: str) -> str | None:
    left = repaired_left(codes, decoded(old), decoded(new))
    return None if left is None else coded(left)


def edits_of(chunks: DataFrame) -> DataFrame:
    """(cid, part, chunk, codes, copies, edits): the edits of every row of every chunk."""
    several = written(linked(chunks), "linked")
    plain = chunks.select("*", F.lit(None).cast("string").alias("end"), F.lit(None).cast("int").alias("state"))
    if not several.isEmpty():
        costs = settled(several, 1, coded(END), _start_cost, _again_cost)
        ends = several.join(costs.select("g", F.col("used").alias("end")), "g")
        states = _traced(ends)
        marks = ends.select("g", "cid", "part", "chunk", "end").join(states, "g").select("cid", "part", "chunk", "end", "state")
        plain = chunks.join(marks, same(chunk=True), "left")
    return mapped(plain, "cid string, part int, chunk long, codes string, copies array<long>, edits array<string>", _edited)


def _traced(ends: DataFrame) -> DataFrame:
    """(g, state): the role state in which each chunk begins; the first of a conversation begins empty."""
    firsts = ends.groupBy("cid").agg(F.min("g").alias("g")).select("g", F.lit(True).alias("first"))
    runs = ends.join(firsts, "g", "left").select("g", "cid", "codes", "end", F.coalesce("first", F.lit(False)).alias("first"))
    schema = "g long, cid string, state int, leaves array<int>"
    # What a chunk makes of each state it may begin in; most chunks forget it after a few rows.
    table = mapped(
        runs, schema,
        lambda r: {"g": r["g"], "cid": r["cid"], "state": EMPTY if r["first"] else ASSISTANT,
                   "leaves": [trace(r["codes"], decoded(r["end"]), s)[1] for s in ([EMPTY] if r["first"] else range(4))]},
    )
    state = written(table, "traces")
    while True:
        leaves = F.when(F.size("leaves") == 1, F.col("leaves")[0]).otherwise(F.col("leaves")[F.col("state")])
        beside = state.select((F.col("g") + 1).alias("g"), F.col("cid").alias("cid_"), leaves.alias("given"))
        both = state.join(beside, "g", "left")
        moved = F.coalesce((F.col("cid") == F.col("cid_")) & (F.col("given") != F.col("state")), F.lit(False))
        after = written(both.select("g", "cid", F.when(moved, F.col("given")).otherwise(F.col("state")).alias("state"), "leaves", moved.alias("moved")), "traces")
        state = after.drop("moved")
        if after.filter("moved").isEmpty():
            return state.select("g", "state")


def _edited(row: dict) -> dict:
    codes = row["codes"]
    if re.search("[suao][-t]", codes):
        end = END if row["end"] is None else decoded(row["end"])
        edits = trace(codes, end, row["state"] or EMPTY)[0]
    else:
        edits = ["D"] * (len(codes) // 2)
    return {n: row[n] for n in ("cid", "part", "chunk", "codes", "copies")} | {"edits": edits}


RESULT = StructType(
    [
        StructField("conv_id", LongType()),
        *(StructField(n, LongType()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        StructField("audit", StringType()),
        StructField("repaired_sha256", StringType()),
    ]
)
STREAM = StructType(
    [
        StructField("cid", StringType()),
        StructField("part", LongType()),
        StructField("chunk", LongType()),
        StructField("idx", LongType()),
        StructField("turn", LongType()),
        StructField("role", StringType()),
        StructField("text", StringType()),
        StructField("copies", LongType()),
        StructField("codes", StringType()),
        StructField("edits", ArrayType(StringType())),
    ]
)
INITIALS = {SYSTEM: "s", USER: "u", ASSISTANT: "a"}
ROLES = {USER: "user", ASSISTANT: "assistant"}


class _Conversation:
    """What is told of one conversation while its rows stream by in order."""

    def __init__(self, cid: str) -> None:
        self.cid, self.audit, self.state, self.said = cid, [], EMPTY, False
        self.counts = dict.fromkeys(RESULT.names[1:7], 0)
        self.digest, self.initial = hashlib.sha256(), None
        self.low = self.high = None
        self.turns, self.edits, self.kinds = 0, [], []

    def turn(self, role: str, text: str) -> None:
        self.digest.update(("\n" if self.said else "").encode() + f"{role}:{text}".encode())
        self.said = True

    def next_turn(self) -> str:
        self.state = FOLLOWS[self.state]
        return ROLES[self.state]

    def chunk(self, codes: str, edits: list[str]) -> None:
        self.kinds, self.edits = kinds_of(codes)[::-1], edits[::-1]

    def row(self, turn: int | None, role: str, text: str, copies: int) -> None:
        kind, edits = self.kinds.pop(), self.edits.pop()
        bare = not text.strip(" \t\n\v\f\r")
        again = kind[1] == "x" and not bare
        self.counts["blank"] += copies * bare
        self.counts["duplicate"] += 0 if bare else copies - (not again)
        self.counts["truncated"] += kind[1] == "t"
        initial = role[:1]
        legal = (self.initial, initial) in {("s", "u"), ("u", "a"), ("a", "u")}
        self.counts["illegal"] += (self.initial is not None and not legal) + copies - 1
        self.initial = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        for edit in edits:
            self.counts["cost"] += {"D": DELETE, "I": INSERT, "R": REROLE, "K": 0}[edit]
            if edit == "I":
                self.turn(self.next_turn(), "")
            elif edit != "D":
                self.counts["cost"] += TRUNCATED if kind[1] == "t" else 0
                if edit == "R":
                    self.turn(self.next_turn(), text)
                else:
                    self.state = KEPT[self.state, initial]
                    self.turn(role, text)
        self.counts["cost"] += DELETE * (copies - 1)
        self.audit.append(edits + "D" * (copies - 1))

    def result(self) -> dict:
        while self.state not in ACCEPTING:
            self.turn(self.next_turn(), "")
            self.audit.append("I")
            self.counts["cost"] += INSERT
        if self.low is not None:
            self.counts["gaps"] = self.high - self.low + 1 - self.turns
        named = {"conv_id": int(self.cid) if self.cid else None, "audit": "".join(self.audit)}
        return named | self.counts | {"repaired_sha256": self.digest.hexdigest()}


def streamed(rows: DataFrame) -> DataFrame:
    """The result of each conversation from its rows and its chunks' edits, sorted as they belong."""
    kind = arrow_type(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: _Conversation | None = None
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if now is None or now.cid != row["cid"]:
                    if now is not None:
                        done.append(now.result())
                    now = _Conversation(row["cid"])
                if row["edits"] is not None:
                    now.chunk(row["codes"], row["edits"])
                elif row["copies"] is not None:
                    now.row(row["turn"], row["role"], row["text"], row["copies"])
            yield pa.RecordBatch.from_pylist(done, schema=kind)
        if now is not None:
            yield pa.RecordBatch.from_pylist([now.result()], schema=kind)

    return rows.mapInArrow(run, RESULT)


def repair(turns: DataFrame, ids: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Faults, edits and repaired text's digest of each conversation.

    ``turns`` as from ``turns_of`` or ``damaged``; ``ids`` holds every ``cid`` to report, also those without rows.
    """
    ordered = in_order(turns, "cid", ["turn", "role"], "text")
    ordered = ordered.withColumn("chunk", F.floor(F.col("idx") / chunk))
    chunks = written(chunks_of(ordered), "chunks")
    none = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in STREAM}

    def shaped(df: DataFrame) -> DataFrame:
        return df.select([F.col(f.name).cast(f.dataType) if f.name in df.columns else none[f.name] for f in STREAM])

    every = ids.select("cid").distinct().select("cid", F.lit(-1).alias("part"))
    union = shaped(every).unionByName(shaped(edits_of(chunks).drop("copies"))).unionByName(shaped(ordered))
    sorted_ = union.repartition("cid").sortWithinPartitions("cid", "part", "chunk", F.col("idx").asc_nulls_first())
    return streamed(sorted_)
