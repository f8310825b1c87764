"""Conversation prefix trie: every distinct opening of the conversations, with members, children and savings.

Each conversation is a word whose letters are its turns (a digest of role and text, and the text's bytes). Equal words
are one class. The classes are sorted, and the longest common prefix (LCP) of each with the one before is taken. A
candidate prefix is a class and a depth. Over the LCPs lies a sparse table of minima of runs of 1, 2, 4 ... places, and
each candidate searches the first and the last class that share its prefix by halving steps, independently of all
others; no stack is kept. A candidate whose interval begins at its own class stands for the node. Sums over an interval
are differences of running sums: members, leaves, bytes.

The sort is by ranges, so a prefix that a third of all conversations share spans many tasks. A task finds the part of a
node's interval that lies in its range; only nodes that touch a range's ends (at most two paths a task) are added up
afterwards. Bytes count as new in the first range that holds a node, which the LCP across the border tells.

Long conversations are cut into segments of ``SEGMENT`` turns. A segment is sorted among those with the same turns
before them (told by a 128-bit digest), so no row grows with a conversation. What hangs below a segment's last turn
is summed up over the segment groups by pointer doubling and then enters the running sums.

Defined cases: rows without a conversation id belong to no conversation and are left out; a null role or text is empty;
a null turn comes first; rows of one turn sort by role, the first 64 characters of the text, then by a digest; repeated
rows are repeated turns; an empty table gives no rows, not even a root; other columns are left out, whatever their names.
Turns are told apart by 128-bit digests. The digest of a node's ended conversations is one value, so the ids that end
at one node stream through one task, in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from migrascope.llm.common import arrow_type, saved, written
from migrascope.llm.ordered import in_order, positions

SEGMENT = 256  # turns of a conversation that are one word
LETTER = 20  # bytes of a turn: 16 of its digest, 4 of its text's length
TASK_TURNS = 200_000  # turns that a task holds at once, about
TEXT_PREFIX = 64  # characters that sort rows of one turn
FAMILY = 5
MOST_SHARED = 9


def shared_turns(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string")) % MOST_SHARED


def turns_of(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, letter): the turns of each conversation in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.lpad(F.lower(F.hex(F.octet_length(text).cast("long"))), 8, "0")
    letter = F.concat(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, F.lit(":"), text)), size)
    known = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), role.alias("role"),
        F.concat(F.rpad(F.substring(text, 1, TEXT_PREFIX), TEXT_PREFIX, "\0"), letter).alias("said"),
    )
    ordered = positions(in_order(known, "conv_id", ["turn", "role"], "said"), "conv_id", F.col("copies"))
    place = F.explode(F.sequence(F.col("pos"), F.col("pos") + F.col("copies") - 1)).alias("pos")
    return ordered.select("conv_id", F.expr(f"right(said, {2 * LETTER})").alias("letter"), place)


def rebuilt(turns: DataFrame) -> DataFrame:
    """The turns after each conversation's first ones are those of its family's first conversation.

    Conversation c takes the first h turns of conversation c - c % 5 and its own after its first h.
    """
    sizes = turns.groupBy("conv_id").agg(F.count("*").alias("size"))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    ids = sizes.select("conv_id", base.alias("base"), shared_turns(F.col("conv_id")).alias("h"))
    lent = ids.join(sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("has")), "base", "left")
    lent = written(lent.withColumn("taken", F.least("h", F.coalesce("has", F.lit(0)))), "families")
    firsts = turns.filter((F.col("pos") < MOST_SHARED) & (F.col("conv_id") % FAMILY == 0))
    heads = lent.join(firsts.withColumnRenamed("conv_id", "base"), "base").filter("pos < taken")
    own = turns.join(lent.select("conv_id", "h", "taken"), "conv_id").filter("pos >= h")
    tails = own.select("conv_id", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "letter")
    return heads.select("conv_id", "pos", "letter").unionByName(tails)


def words_of(turns: DataFrame, segment: int) -> DataFrame:
    """(conv_id, seg, word, w1, w2, p1, p2, n1, n2, ends): each conversation's segments as words.

    ``w1`` and ``w2`` are a digest of the word, ``p1`` and ``p2`` of what stands before a segment, ``n1`` and
    ``n2`` the same for the one after it.
    """
    seg = F.floor(F.col("pos") / segment)
    letters = F.array_sort(F.collect_list(F.struct("pos", "letter")))
    found = turns.groupBy("conv_id", seg.alias("seg")).agg(letters.alias("letters"))
    words = found.select("conv_id", "seg", F.unhex(F.concat_ws("", "letters.letter")).alias("word"))
    words = written(words.select("*", *(F.xxhash64(F.lit(salt), "seg", "word").alias(f"w{salt}") for salt in (1, 2))), "words")
    whole = F.octet_length("word") == segment * LETTER
    short = words.filter((F.col("seg") == 0) & ~whole)
    zero = F.lit(0).cast("long")
    short = short.select("*", zero.alias("p1"), zero.alias("p2"), zero.alias("n1"), zero.alias("n2"), F.lit(True).alias("ends"))
    # Conversations of a full segment or more: what is before is folded together along the conversation's segments.
    along = Window.partitionBy("conv_id").orderBy("seg")
    upto = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    long_ = words.filter((F.col("seg") > 0) | whole).withColumns({"n1": F.bit_xor("w1").over(upto), "n2": F.bit_xor("w2").over(upto)})
    long_ = long_.withColumns({"p1": F.lag("n1", 1, 0).over(along), "p2": F.lag("n2", 1, 0).over(along), "ends": F.lead("seg").over(along).isNull()})
    return short.unionByName(long_.select(short.columns))


def digest_of_ids(members: DataFrame, key: list[str]) -> DataFrame:
    """``key`` and ``ends_sha256`` over the decimal ids in ascending order, joined by commas; each key streams."""
    kind_of = StructType([*members.select(key).schema.fields, *StructType.fromDDL("ends_sha256 string").fields])
    kind = arrow_type(kind_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest = None, None
        for batch in batches:
            done = []
            for *at, conv_id in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if at != now:
                    if now is not None:
                        done.append([*now, digest.hexdigest()])
                    now, digest = at, hashlib.sha256(str(conv_id).encode())
                else:
                    digest.update(f",{conv_id}".encode())
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, d, strict=True)) for d in done], schema=kind)
        if now is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(kind.names, [*now, digest.hexdigest()], strict=True))], schema=kind)

    ordered = members.select(*key, "conv_id").repartition(*key).sortWithinPartitions(*key, "conv_id")
    return ordered.mapInArrow(run, kind_of)


CLASS = ["seg", "p1", "p2", "word"]
BRIEF = ["seg", "p1", "p2", "w1", "w2"]


def classes_of(words: DataFrame) -> DataFrame:
    """Each distinct word with its members, whether any goes on, and the digest of those that end there."""
    ends = F.col("ends")
    found = words.groupBy(*CLASS, "w1", "w2").agg(
        F.min("conv_id").alias("least"), F.count("*").alias("n"), F.min(F.when(ends, F.col("conv_id"))).alias("one"),
        F.count(F.when(ends, 1)).alias("ended"), F.max("n1").alias("n1"), F.max("n2").alias("n2"),
    )
    several = words.filter(ends).groupBy(*BRIEF).agg(F.count("*").alias("k")).filter("k > 1").select(BRIEF)
    listed = digest_of_ids(words.filter(ends).select(*BRIEF, "conv_id").join(several, BRIEF), BRIEF)
    own = F.when(F.col("ended") == 1, F.sha2(F.col("one").cast("string"), 256)).otherwise(F.col("ends_sha256"))
    return found.join(listed, BRIEF, "left").select(
        *CLASS, "least", "n", "n1", "n2", (F.col("n") > F.col("ended")).alias("on"), own.alias("ends_sha256")
    )


class SparseTable:
    """Minima of runs of 1, 2, 4 ... entries, and how far from a place all entries stay at or over a bound."""

    def __init__(self, values: np.ndarray) -> None:
        self.rows = [values]
        while len(self.rows[-1]) > 1 << (len(self.rows) - 1):
            last, step = self.rows[-1], 1 << (len(self.rows) - 1)
            self.rows.append(np.minimum(last[:-step], last[step:]))

    def right(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The last place r from which on back to ``at + 1`` no entry is under the bound."""
        out = at.copy()
        for k in reversed(range(len(self.rows))):
            row = self.rows[k]
            fits = out + 1 < len(row)
            fits[fits] = row[out[fits] + 1] >= bound[fits]
            out[fits] += 1 << k
        return out

    def left(self, at: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The first place l such that from ``l + 1`` to ``at`` no entry is under the bound."""
        out = at.copy()
        for k in reversed(range(len(self.rows))):
            start = out - (1 << k) + 1
            fits = start >= 0
            fits[fits] = self.rows[k][start[fits]] >= bound[fits]
            out[fits] -= 1 << k
        return out

    def least(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The least entry from ``low`` to ``high``, both included."""
        k = np.frexp(high - low + 1)[1] - 1
        out = np.empty(len(low), self.rows[0].dtype)
        for step in np.unique(k):
            here = k == step
            out[here] = np.minimum(self.rows[step][low[here]], self.rows[step][high[here] - (1 << int(step)) + 1])
        return out


def common(a: bytes, b: bytes) -> int:
    """Letters at the beginning that two words share."""
    n = min(len(a), len(b)) // LETTER
    if a[: n * LETTER] == b[: n * LETTER]:
        return n
    x, y = (np.frombuffer(w, f"V{LETTER}", n) for w in (a, b))
    return int(np.argmax(x != y))


def shares(a: dict | None, b: dict | None) -> int:
    """LCP of two classes; different segments share nothing, not even what comes before them."""
    return common(a["word"], b["word"]) if a and b and all(a[c] == b[c] for c in CLASS[:3]) else 0


NODE = (
    "digest binary, parent binary, seg long, p1 long, p2 long, depth long, conv_id long, above long, n_convs long, n_children long,"
    " n_leaves long, saved_tokens long, ends_sha256 string, open boolean, parent_open boolean"
)
NOBODY = hashlib.sha256(b"").hexdigest()


def _nodes(t: pa.Table, before: int, after: int, segment: int, kind: pa.Schema) -> pa.RecordBatch:
    """Nodes of one range of sorted classes; ``before`` and ``after`` are the LCPs across its ends."""
    rows = t.select(CLASS).to_pylist()
    m = len(rows)
    column = {n: t.column(n).to_numpy() for n in ("least", "n", "under_leaves", "under_saved", "under_children", "top")}
    on = np.array(t.column("on").to_pylist(), bool)
    size = np.array([len(r["word"]) // LETTER for r in rows])
    lcp = np.array([0, *(shares(a, b) for a, b in zip(rows, rows[1:], strict=False))])
    follows = np.append(lcp[1:], after)
    new_from = lcp.copy()
    new_from[0] = before
    offset = np.concatenate([[0], np.cumsum(size)])
    letters = np.frombuffer(b"".join(r["word"] for r in rows), np.uint8).reshape(-1, LETTER)
    bytes_ = letters[:, 16:].astype(np.int64) @ (256 ** np.arange(3, -1, -1, dtype=np.int64))
    upto = np.concatenate([[0], np.cumsum(bytes_)])  # bytes before each letter of all words in a row

    i = np.repeat(np.arange(m), size)
    d = np.arange(offset[-1]) - offset[i] + 1
    lcps, ids = SparseTable(lcp), SparseTable(column["least"])
    own = lcps.left(i, d) == i  # the candidates that begin their interval
    flat = np.flatnonzero(own)
    i, d = i[own], d[own]
    right = lcps.right(i, d)

    def running(x: np.ndarray) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(x)])

    members, leaf = running(column["n"]), (follows < size) & ~on
    leaves = running(leaf + column["under_leaves"])
    whole = upto[offset[1:]] - upto[offset[:-1]]  # bytes of each word
    fresh = upto[offset[1:]] - upto[np.minimum(offset[:-1] + new_from, offset[1:])]  # of its new letters
    all_bytes, new_bytes, under = running(column["n"] * whole), running(fresh), running(column["under_saved"])
    n_convs = members[right + 1] - members[i]
    ahead = upto[offset[i] + d - 1] - upto[offset[i]]
    total = all_bytes[right + 1] - all_bytes[i] - n_convs * ahead
    once = new_bytes[right + 1] - new_bytes[i + 1] + upto[offset[i + 1]] - upto[offset[i] + np.maximum(d - 1, np.minimum(new_from[i], size[i]))]
    saved_tokens = total - once + under[right + 1] - under[i]

    parent_left = lcps.left(i, d - 1)
    parent_left[d == 1] = i[d == 1]
    parent_right = lcps.right(i, np.maximum(d - 1, 1))
    is_new = d > new_from[i]
    children = np.zeros(offset[-1], np.int64)
    inner = (d > 1) & is_new
    np.add.at(children, offset[parent_left[inner]] + d[inner] - 2, 1)
    n_children = children[flat] + np.where(d == size[i], column["under_children"][i], 0)
    above = np.where(d == 1, column["top"][i], ids.least(parent_left, np.maximum(parent_right, parent_left)))

    def touches(left: np.ndarray, right_: np.ndarray, depth: np.ndarray) -> np.ndarray:
        return (depth > 0) & (((left == 0) & (depth <= before)) | ((right_ == m - 1) & (depth <= after)))

    open_ = touches(i, right, d)
    parent_open = (d > 1) & touches(parent_left, parent_right, d - 1)

    def digests(where: np.ndarray, at: np.ndarray, depth: np.ndarray) -> list[bytes | None]:
        out: list[bytes | None] = [None] * len(where)
        for k in np.flatnonzero(where):
            r = rows[at[k]]
            head = f"{r['seg']}:{r['p1']}:{r['p2']}:".encode()
            out[k] = hashlib.blake2b(head + r["word"][: depth[k] * LETTER], digest_size=16).digest()
        return out

    said = t.column("ends_sha256").to_pylist()
    at = [rows[k] for k in i]
    arrays = [
        digests(open_, i, d), digests(parent_open, i, d - 1),
        *([r[c] for r in at] for c in CLASS[:3]),
        d + np.array([r["seg"] for r in at], np.int64) * segment,
        ids.least(i, right), above, n_convs, n_children, leaves[right + 1] - leaves[i], saved_tokens,
        [said[k] if full and said[k] else NOBODY for k, full in zip(i, d == size[i], strict=True)],
        open_, parent_open,
    ]
    return pa.RecordBatch.from_arrays([pa.array(a, f.type) for a, f in zip(arrays, kind, strict=True)], schema=kind)


def arranged(classes: DataFrame, turns: int) -> DataFrame:
    """Classes in word order, spread over ranges of bounded size, kept so that ranges stay as they are."""
    own = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = classes.repartitionByRange(max(own, turns // TASK_TURNS + 1), *CLASS)
    return saved(ranged.sortWithinPartitions(*CLASS))


def borders(classes: DataFrame) -> dict[int, tuple[int, int]]:
    """LCPs across the ends of each range; a row per range is all that reaches the driver."""
    named = f"part int, {', '.join(f'{side}_{c} {k}' for side in ('first', 'last') for c, k in zip(CLASS, ('long', 'long', 'long', 'binary'), strict=True))}"
    kind = arrow_type(StructType.fromDDL(named))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        for batch in batches:
            if batch.num_rows:
                first = first or batch.slice(0, 1).to_pylist()[0]
                last = batch.slice(batch.num_rows - 1).to_pylist()[0]
        if first is not None:
            row = {"part": TaskContext.get().partitionId()}
            row |= {f"first_{c}": first[c] for c in CLASS} | {f"last_{c}": last[c] for c in CLASS}
            yield pa.RecordBatch.from_pylist([row], schema=kind)

    found = classes.select(CLASS).mapInArrow(ends, StructType.fromDDL(named))
    over = Window.orderBy("part")  # a row for each range
    met = found.select("part", *(F.lag(f"last_{c}").over(over).alias(f"a_{c}") for c in CLASS), *(F.col(f"first_{c}").alias(f"b_{c}") for c in CLASS))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pylist()
            sides = [[None if r[f"{s}_seg"] is None else {c: r[f"{s}_{c}"] for c in CLASS} for s in "ab"] for r in rows]
            yield pa.RecordBatch.from_pydict({"part": [r["part"] for r in rows], "lcp": [shares(a, b) for a, b in sides]}, schema=pa.schema([("part", pa.int32()), ("lcp", pa.int64())]))

    lcps = [(r["part"], r["lcp"]) for r in met.mapInArrow(measure, "part int, lcp long").orderBy("part").collect()]
    after = [lcp for _, lcp in [*lcps[1:], (None, 0)]][: len(lcps)]
    return {part: (lcp, behind) for (part, lcp), behind in zip(lcps, after, strict=True)}


def partial_nodes(classes: DataFrame, segment: int) -> DataFrame:
    """Nodes as each range of ``arranged`` classes sees them."""
    at = borders(classes)
    kind = arrow_type(StructType.fromDDL(NODE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [b for b in batches if b.num_rows]
        if held:
            yield _nodes(pa.Table.from_batches(held), *at[TaskContext.get().partitionId()], segment, kind)

    return classes.mapInArrow(run, StructType.fromDDL(NODE))


GROUP = ["seg", "p1", "p2"]
SUMS = ("n_convs", "n_children", "n_leaves", "saved_tokens")


def groups_of(nodes: DataFrame, segment: int) -> DataFrame:
    """Children of the top, leaves and saved bytes of all segments with the same turns before.

    Sums are of the nodes at the groups' first depth, each of which holds a subtree; a node that spans ranges is
    counted once.
    """
    first = nodes.filter(F.col("depth") == F.col("seg") * segment + 1)
    partly = first.groupBy(*GROUP, "open", F.when(F.col("open"), F.col("digest")).alias("digest")).agg(
        F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    return partly.groupBy(*GROUP).agg(
        F.sum(F.when(F.col("open"), 1).otherwise(F.col("n"))).alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")
    )


def below(groups: DataFrame, classes: DataFrame) -> DataFrame:
    """``groups`` with leaves and saved bytes of all groups below each, by pointer doubling up the segments.

    After k rounds a group holds the sums of what is less than 2^k segments below it.
    """
    up = classes.filter("on").select((F.col("seg") + 1).alias("seg"), F.col("n1").alias("p1"), F.col("n2").alias("p2"), *(F.col(c).alias(f"up_{c}") for c in GROUP))
    now = written(groups.join(up, GROUP, "left"), "groups")
    levels = now.agg(F.max("seg")).first()[0] or 0
    for _ in range(int(levels).bit_length()):
        lifted = now.filter("up_seg IS NOT NULL").groupBy(*(F.col(f"up_{c}").alias(c) for c in GROUP)).agg(
            F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved")
        )
        far = now.select(*(F.col(c).alias(f"up_{c}") for c in GROUP), *(F.col(f"up_{c}").alias(f"far_{c}") for c in GROUP))
        grown = now.join(lifted, GROUP, "left").join(far, [f"up_{c}" for c in GROUP], "left")
        now = written(
            grown.select(
                *GROUP, "children",
                *((F.col(c) + F.coalesce(f"more_{c}", F.lit(0))).alias(c) for c in ("leaves", "saved")),
                *(F.col(f"far_{c}").alias(f"up_{c}") for c in GROUP),
            ),
            "groups",
        )
    return now


def hung(classes: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Classes with what hangs below their last turn and the least member of the node above their first one."""
    zero = F.lit(0).cast("long")
    if groups is None:
        return classes.select("*", *(zero.alias(c) for c in ("under_leaves", "under_saved", "under_children")), zero.alias("top"))
    first, second = F.col("n1").alias("p1"), F.col("n2").alias("p2")
    own = classes.filter("on").select((F.col("seg") + 1).alias("seg"), first, second, F.col("least").alias("top"))
    next_ = groups.select(
        (F.col("seg") - 1).alias("seg"), F.col("p1").alias("n1"), F.col("p2").alias("n2"), F.lit(True).alias("on"),
        F.col("leaves").alias("under_leaves"), F.col("saved").alias("under_saved"), F.col("children").alias("under_children"),
    )
    joined = classes.join(next_, ["seg", "n1", "n2", "on"], "left").join(own, GROUP, "left")
    return joined.select(*classes.columns, *(F.coalesce(c, zero).alias(c) for c in ("under_leaves", "under_saved", "under_children")), F.coalesce("top", zero).alias("top"))


def trie(turns: DataFrame, ids: DataFrame, segment: int = SEGMENT) -> DataFrame:
    """A row per node. ``turns`` as from ``turns_of`` or ``rebuilt``; ``ids`` holds every conversation, each once."""
    words = words_of(turns, segment)
    classes = written(classes_of(words), "classes")
    n_turns = classes.agg(F.sum(F.octet_length("word"))).first()[0] or 0
    long_ = not classes.filter("on").isEmpty()
    plain = arranged(hung(classes, None), n_turns // LETTER)
    nodes = written(partial_nodes(plain, segment), "nodes")
    groups = groups_of(nodes, segment)
    if long_:
        groups = below(groups, classes)
        nodes = written(partial_nodes(arranged(hung(classes, groups), n_turns // LETTER), segment), "nodes")
    return finished(nodes, groups, words, ids)


def finished(nodes: DataFrame, groups: DataFrame, words: DataFrame, ids: DataFrame) -> DataFrame:
    """Whole nodes: those that span ranges added up, parents' least members filled in, and the root."""
    bare = ids.join(words.filter("seg = 0").select("conv_id"), "conv_id", "left_anti")
    ended = digest_of_ids(bare.select(F.lit(0).cast("long").alias("seg"), "conv_id"), ["seg"])
    all_ = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    top = groups.filter("seg = 0").select("seg", "children", "leaves", "saved")
    root = all_.withColumn("seg", F.lit(0).cast("long")).join(top, "seg", "left").join(ended, "seg", "left").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs",
        F.coalesce("children", F.lit(0)).alias("n_children"), F.coalesce("leaves", F.lit(1)).alias("n_leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(NOBODY)).alias("ends_sha256"),
    )
    smallest = all_.first()
    if smallest is None:
        return root
    nodes = nodes.withColumn("above", F.when(F.col("depth") == 1, F.lit(smallest["conv_id"])).otherwise(F.col("above")))
    parts = nodes.filter("open").groupBy("digest").agg(
        F.first("parent").alias("parent"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.max("above").alias("above"),
        *(F.sum(c).alias(c) for c in SUMS),
        F.coalesce(F.max(F.when(F.col("ends_sha256") != NOBODY, F.col("ends_sha256"))), F.lit(NOBODY)).alias("ends_sha256"),
        F.max("parent_open").alias("parent_open"),
    )
    spanning = written(parts, "spanning")
    columns = ["depth", "conv_id", "above", *SUMS, "ends_sha256", "parent", "parent_open"]
    both = nodes.filter("NOT open").select(columns).unionByName(spanning.select(columns))
    wholes = spanning.select(F.col("digest").alias("parent"), F.col("conv_id").alias("whole"))
    found = both.filter("parent_open").join(wholes, "parent").drop("above").withColumnRenamed("whole", "above")
    every = both.filter("NOT parent_open").unionByName(found)
    return every.select("conv_id", "depth", F.col("above").alias("parent_conv_id"), *SUMS, "ends_sha256").unionByName(root)
