"""N-gram Jaccard join: exact links between documents whose shingle sets overlap enough, as components.

1. Documents with equal sets are one class; everything below handles each class once.
2. Families: classes with alike sketches (a few least hashes) are grouped, loosely and cheaply, by ids alone.
   Each family is settled completely where its texts meet once: a signature tree over its classes, then exact
   set comparisons of what the tree leaves, skipping what is connected already.
3. The rest, completely: sets that overlap enough share a shingle within their prefixes (the first
   n - ceil(t n) + 1 of n shingles in one order for all). The order puts long shingles first and frequent
   ones last. Classes of different families that share a prefix shingle meet in signature trees again, and
   pairs that are left are compared by their sets.

The nodes of a signature tree hold OR-combined token bitmaps, size ranges and least bit counts. The dual
traversal drops pairs of nodes whose greatest possible overlap is too small, or that are connected.

No set of links is lost: what families miss, the prefix rule of step 3 finds, which is exact. A family or prefix
group beyond ``GROUP`` members is cut into blocks; blocks of a family are settled alone first, then every two
that are not wholly connected meet in a task of their own, so that memory is bounded however large it is. The list of frequent shingles is bounded by ``FREQUENT`` and only
decides the order, never a result.

Defined cases: null text has no words; a document without words has no shingles and no links, one with fewer
words than a shingle has one, all its words; a row without id is linked with nothing and has no component;
rows that repeat an id are one document; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from migrascope.llm import words
from migrascope.llm.common import arrow_type, slices, written
from migrascope.llm.graph import components

LEAST = 8  # least mixed shingle hashes of a class: a sketch of its set
MEET = 3  # of them that near copies meet on
ALIKE = 4  # of them that members of a family share
BAND = 1.4  # ratio of sizes that families are looked for in
FREQUENT = 65_536  # bound of the list of frequent shingles
FREQUENT_SHARE = 0.005  # of the documents of a task
BUCKET = 1 << 18  # prefix shingles that one group of a task holds
HOT = 0.25  # of a bucket that one shingle may fill
FLUSH = 1 << 20  # prefix shingles a task holds before it passes them on
GROUP = 1024  # members of a block
BLOCK_SHINGLES = 1 << 20  # and their shingles
LEAF = 8
MAX_BITS = 1 << 16
BITS_EACH = 8  # bits a shingle where sets are at hand; one where bitmaps are shuffled

PROFILE = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n", IntegerType()),
        StructField("cls", LongType()),
        StructField("check", LongType()),
        StructField("least", ArrayType(LongType())),
        StructField("bits", BinaryType()),
        StructField("frequent", LongType()),
        StructField("times", LongType()),
    ]
)
PACKED = StructType(
    [
        StructField("bucket", LongType()),
        StructField("classes", BinaryType()),
        StructField("counts", BinaryType()),
        StructField("tokens", BinaryType()),
    ]
)
SHARED = StructType([StructField("token", LongType()), StructField("cls", LongType())])
PAIRS = StructType([StructField("a", LongType()), StructField("b", LongType())])


@dataclass(frozen=True)
class Rule:
    """Documents link when ``100 * intersection >= percent * union`` of their sets of ``shingle`` words."""

    shingle: int
    percent: int

    def prefix(self, n: int) -> int:
        return n - -(-self.percent * n // 100) + 1

    def links(self, x: np.ndarray, y: np.ndarray) -> bool:
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= self.percent * (len(x) + len(y) - common)


def shingle_sets(column: pa.Array, k: int) -> list[np.ndarray]:
    """The distinct shingles of each text, A-Z lower-cased, as sorted numbers.

    A number starts with the complement of the shingle's length in letters and ends with 56 bits of its hash.
    So the order, which is the one of the prefixes, begins with the longest shingles, that is the rarest.
    """
    found = words.split(column, lower=True)
    hashes, _ = words.grams(found, k)
    letters = np.concatenate([np.zeros(1, np.int64), np.cumsum(found.end - found.start)])

    def numbered(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        rank = (255 - np.minimum(sizes, 255)).astype(np.uint64)
        return (rank << np.uint64(56)) | (values >> np.uint64(8))

    tokens = numbered(hashes, letters[k:] - letters[:-k]) if len(hashes) else hashes
    sets = []
    for first, last in zip(found.first[:-1].tolist(), found.first[1:].tolist(), strict=True):
        if 0 < last - first < k:
            whole = (found.hash[first:last] * words.powers(last - first)).sum(dtype=np.uint64, keepdims=True)
            sets.append(numbered(words.mix(whole + np.uint64(last - first)), letters[last : last + 1] - letters[first]))
        else:
            sets.append(np.unique(tokens[first : max(first, last - k + 1)]))
    return sets


def class_of(tokens: np.ndarray) -> tuple[np.int64, np.int64]:
    """Two independent digests of a set."""
    one = words.mix(tokens * words.BASE + np.uint64(len(tokens))).sum(dtype=np.uint64)
    two = words.mix(tokens ^ np.uint64(0xD6E8FEB86659FD93)).sum(dtype=np.uint64)
    return one.astype(np.int64), two.astype(np.int64)


def bitmap(tokens: np.ndarray, bits_each: int = 1) -> bytes:
    """Bits of the tokens, in a power of two of bits that follows the size of the set."""
    width = 64
    while width < min(bits_each * len(tokens), MAX_BITS):
        width *= 2
    bits = np.zeros(width, dtype=bool)
    bits[(tokens >> np.uint64(40)).astype(np.int64) & (width - 1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def sketch(tokens: np.ndarray) -> list[int]:
    """The least hashes of the set, mixed anew so that they don't follow the order of the prefixes."""
    mixed = words.mix(tokens)
    if len(mixed) > LEAST:
        mixed = np.partition(mixed, LEAST)[:LEAST]
    return words.signed(np.sort(mixed)).tolist()


def profiles(docs: DataFrame, rule: Rule) -> DataFrame:
    """A row for each document, and rows (doc_id null) of shingles that are frequent in a task."""
    kind = arrow_type(PROFILE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counted, seen = [], set()
        for part in slices(batches, "text"):
            rows = []
            for doc_id, tokens in zip(part.column("doc_id").to_pylist(), shingle_sets(part.column("text"), rule.shingle), strict=True):
                if not len(tokens):
                    rows.append({"doc_id": doc_id, "n": 0})
                    continue
                cls, check = class_of(tokens)
                least = sketch(tokens)
                rows.append({"doc_id": doc_id, "n": len(tokens), "cls": int(cls), "check": int(check), "least": least, "bits": bitmap(tokens)})
                if int(cls) not in seen:
                    seen.add(int(cls))
                    counted.append(tokens[: rule.prefix(len(tokens))].copy())
            yield pa.RecordBatch.from_pylist(rows, schema=kind)
        if counted:
            tokens, times = np.unique(np.concatenate(counted), return_counts=True)
            often = times >= max(4, FREQUENT_SHARE * len(seen))
            found = zip(words.signed(tokens[often]).tolist(), times[often].tolist(), strict=True)
            yield pa.RecordBatch.from_pylist([{"frequent": t, "times": n} for t, n in found], schema=kind)

    return docs.mapInArrow(run, PROFILE)


def shared_prefixes(docs: DataFrame, rule: Rule, frequent: np.ndarray, times: np.ndarray, total: int) -> DataFrame:
    """(token, cls): prefix shingles that at least two classes have; ``total`` of them set the number of buckets.

    Tasks pass on packed arrays instead of a row a shingle. A shingle goes to the bucket that its hash names,
    where 32 more bits of the hash tell shingles apart; should two agree in all, that adds a candidate.

    A shingle that would fill much of a bucket (``HOT`` of its size, by the counted ``times`` of the frequent ones)
    goes to none: its classes are spread over ``salts`` buckets by their own hash, and the shingle by its number.
    """
    buckets = 1
    while buckets * BUCKET < total:
        buckets *= 2
    hot = frequent[times >= HOT * BUCKET]
    salts = np.uint64(1 + int(times[times >= HOT * BUCKET].sum()) // BUCKET)
    packed_kind, kind = arrow_type(PACKED), arrow_type(SHARED)

    def parted(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The tokens of ordinary buckets, and the numbers of the hot ones."""
        if not len(hot):
            return tokens, np.zeros(0, np.int64)
        at = np.minimum(np.searchsorted(hot, tokens), len(hot) - 1)
        is_hot = hot[at] == tokens
        return tokens[~is_hot], at[is_hot]

    def pack(parts: list[tuple[np.ndarray, np.ndarray]], classes: list[int]) -> pa.RecordBatch:
        mixed = words.mix(np.concatenate([p for p, _ in parts]))
        own = np.array(classes, np.int64)
        cls, of_hot = (np.repeat(own, [len(p[k]) for p in parts]) for k in range(2))
        salt = (words.mix(of_hot.view(np.uint64)) % salts).astype(np.int64)
        bucket = np.concatenate([(mixed & np.uint64(buckets - 1)).astype(np.int64), buckets + salt])
        token = np.concatenate([(mixed >> np.uint64(32)).astype(np.uint32), *(p.astype(np.uint32) for _, p in parts)])
        cls = np.concatenate([cls, of_hot])
        order = np.lexsort((cls, bucket))
        bucket, cls, token = bucket[order], cls[order], token[order]
        new = np.append(True, (bucket[1:] != bucket[:-1]) | (cls[1:] != cls[:-1]))
        first = np.flatnonzero(new)
        counts = np.diff(np.append(first, len(cls))).astype(np.uint32)
        rows, ends = [], np.append(np.flatnonzero(np.append(True, np.diff(bucket[first]) != 0)), len(first))
        for x, y in zip(ends[:-1], ends[1:], strict=True):
            low, high = first[x], first[y] if y < len(first) else len(cls)
            rows.append((int(bucket[low]), cls[first[x:y]].tobytes(), counts[x:y].tobytes(), token[low:high].tobytes()))
        return pa.RecordBatch.from_pylist([dict(zip(PACKED.names, r, strict=True)) for r in rows], schema=packed_kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[np.ndarray] = []
        classes: list[int] = []
        held = 0
        for part in slices(batches, "text"):
            for tokens in shingle_sets(part.column("text"), rule.shingle):
                if not len(tokens) or (cls := int(class_of(tokens)[0])) in seen:
                    continue
                seen.add(cls)
                length = rule.prefix(len(tokens))
                if len(frequent):
                    often = frequent[np.minimum(np.searchsorted(frequent, tokens), len(frequent) - 1)] == tokens
                    tokens = np.concatenate([tokens[~often], tokens[often]])
                parts.append(parted(tokens[:length].copy()))
                classes.append(cls)
                held += length
            if held > FLUSH:
                yield pack(parts, classes)
                parts, classes, held = [], [], 0
        if held:
            yield pack(parts, classes)

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pa.Table.from_batches(list(batches))
        get = lambda name, kind: np.concatenate([np.frombuffer(b, kind) for b in found.column(name).to_pylist()])
        cls, token = np.repeat(get("classes", np.int64), get("counts", np.uint32)), get("tokens", np.uint32)
        order = np.lexsort((cls, token))
        cls, token = cls[order], token[order]
        new = np.append(True, (token[1:] != token[:-1]) | (cls[1:] != cls[:-1]))
        cls, token = cls[new], token[new].astype(np.int64)
        bucket = key[0].as_py()
        if bucket >= buckets:  # classes of hot shingles; others of these may be in other salts
            named = (buckets + token) << 32
        else:
            same = token[1:] == token[:-1]
            several = np.append(same, False) | np.append(False, same)
            named, cls = (bucket << 32) | token[several], cls[several]
        yield pa.RecordBatch.from_arrays([pa.array(named), pa.array(cls)], schema=kind)

    return docs.select("text").mapInArrow(run, PACKED).groupBy("bucket").applyInArrow(meet, SHARED)


class Tree:
    """Signature tree of some classes: each level ORs ``LEAF`` nodes of the one below.

    All bitmaps are folded to the least width among them; ``likely_pairs`` keeps like widths together.
    """

    def __init__(self, n: np.ndarray, comp: np.ndarray, bits: list[bytes]) -> None:
        self.order = np.lexsort((comp, n))
        self.n, self.comp = n[self.order], comp[self.order]
        width = min(len(b) for b in bits)
        self.bits = np.stack([_fold(bits[i], width) for i in self.order])
        self.levels = [(self.bits, self.n, self.n, np.bitwise_count(self.bits).sum(axis=1), self.comp, self.comp)]
        while len(self.levels[-1][0]) > 1:
            bits_, low, high, least, first, last = self.levels[-1]
            cut = np.arange(0, len(bits_), LEAF)
            self.levels.append(
                (
                    np.bitwise_or.reduceat(bits_, cut),
                    np.minimum.reduceat(low, cut),
                    np.maximum.reduceat(high, cut),
                    np.minimum.reduceat(least, cut),
                    np.minimum.reduceat(first, cut),
                    np.maximum.reduceat(last, cut),
                )
            )

    def possible(self, level: int, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
        """Which node pairs may hold a link between different components."""
        bits, low, high, least, first, last = self.levels[level]
        sizes = (100 * high[x] >= percent * low[y]) & (100 * high[y] >= percent * low[x])
        apart = ~((first[x] == last[x]) & (first[y] == last[y]) & (first[x] == first[y]))
        both = np.bitwise_count(bits[x] & bits[y]).sum(axis=1, dtype=np.int64)
        most = np.minimum(
            np.minimum(high[x] - np.maximum(0, least[x] - both), high[y] - np.maximum(0, least[y] - both)),
            np.minimum(high[x], high[y]),
        )
        # a link of sizes p and q needs an overlap of at least percent (p + q) / (100 + percent)
        return sizes & apart & ((100 + percent) * most >= percent * (low[x] + low[y]))

    def pairs(self, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Dual traversal from the root; places of the classes that may link."""
        level = len(self.levels) - 1
        x = y = np.zeros(1, np.int64)
        while level:
            level -= 1
            size = len(self.levels[level][0])
            inner = np.arange(LEAF)
            cx = np.repeat(x[:, None] * LEAF + inner, LEAF, axis=1).ravel()
            cy = np.tile(y[:, None] * LEAF + inner, (1, LEAF)).ravel()
            fine = (cx < size) & (cy < size) & ((cx < cy) if level == 0 else (cx <= cy))
            cx, cy = cx[fine], cy[fine]
            kept = [self.possible(level, cx[i : i + 65_536], cy[i : i + 65_536], percent) for i in range(0, len(cx), 65_536)]
            keep = np.concatenate(kept) if kept else np.zeros(0, bool)
            x, y = cx[keep], cy[keep]
        return (self.order[x], self.order[y]) if len(self.n) > 1 else (np.zeros(0, int), np.zeros(0, int))


def likely_pairs(n: np.ndarray, comp: np.ndarray, bits: list[bytes], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the classes that may link: a tree for each width, with wider bitmaps folded in.

    Sets that link differ in size by a factor of 100 / ``percent`` at most, and so in width by that many doublings.
    """
    reach = 1 << np.arange(max(1, math.ceil(math.log2(100 / percent))) + 1)
    widths = np.array([len(b) for b in bits])
    ones, twos = [np.zeros(0, int)], [np.zeros(0, int)]
    for width in np.unique(widths):
        own = np.flatnonzero(np.isin(widths, width * reach))
        x, y = Tree(n[own], comp[own], [bits[i] for i in own]).pairs(percent)
        x, y = own[x], own[y]
        least = np.minimum(widths[x], widths[y]) == width
        ones.append(x[least])
        twos.append(y[least])
    return np.concatenate(ones), np.concatenate(twos)


def _fold(bits: bytes, width: int) -> np.ndarray:
    """The bitmap in ``width`` bytes: bits that fall together are ORed."""
    return np.bitwise_or.reduce(np.frombuffer(bits, np.uint8).reshape(-1, width), axis=0)


def candidates(members: DataFrame, rule: Rule) -> DataFrame:
    """Pairs of classes of different families with a token in common that the tree cannot rule out.

    ``members``: (token, i, j, side, cls, n, comp, bits); groups with i < j hold two blocks of a token.
    """
    kind = arrow_type(PAIRS)

    def group(rows: list[tuple]) -> pa.RecordBatch | None:
        cls, n, comp, side = (np.array([r[k] for r in rows], dtype=np.int64) for k in (0, 1, 2, 4))
        if len(cls) < 2 or comp.min() == comp.max():
            return None
        a, b = likely_pairs(n, comp, [r[3] for r in rows], rule.percent)
        fine = (comp[a] != comp[b]) & (cls[a] != cls[b])
        if side.min() != side.max():
            fine &= side[a] != side[b]
        one, two = cls[a[fine]], cls[b[fine]]
        return pa.RecordBatch.from_arrays([pa.array(np.minimum(one, two)), pa.array(np.maximum(one, two))], schema=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rows = None, []
        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("token", "i", "j")), strict=True)
            values = zip(*(batch.column(c).to_pylist() for c in ("cls", "n", "comp", "bits", "side")), strict=True)
            for now, value in zip(keys, values, strict=True):
                if now != key:
                    if len(rows) > 1 and (found := group(rows)) is not None:
                        yield found
                    key, rows = now, []
                rows.append(value)
        if len(rows) > 1 and (found := group(rows)) is not None:
            yield found

    ordered = members.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "cls")
    return ordered.mapInArrow(run, PAIRS).distinct()


def blocks(groups: DataFrame) -> DataFrame:
    """Cuts groups beyond ``GROUP`` members; each member goes to every task its block takes part in."""
    parts = F.ceil(F.col("size") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    spread = groups.withColumn("parts", parts).withColumn("side", own)
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return spread.withColumns({"i": F.least("side", "other"), "j": F.greatest("side", "other")}).drop("other", "parts", "size")


def by_key(df: DataFrame) -> DataFrame:
    """For the smaller side of a join that grows with the corpus: never to be broadcast, at any size."""
    return df.hint("merge")


def fetched(docs: DataFrame, wanted: DataFrame, rule: Rule) -> DataFrame:
    """The wanted classes (doc_id, cls and other columns) with the text of one document of each.

    A class comes twice if its document's row is repeated, which does no harm to links.
    """
    joined = docs.join(wanted, "doc_id").drop("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            sets = shingle_sets(part.column("text"), rule.shingle)
            pairs = zip(part.column("cls").to_pylist(), sets, strict=True)
            own = [len(s) > 0 and int(class_of(s)[0]) == c for c, s in pairs]
            yield part.filter(pa.array(own, pa.bool_()))

    return joined.mapInArrow(run, joined.schema)


def linked(pairs: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """Those of the pairs (a, b) whose sets overlap enough; an exact count of common shingles."""
    kind = arrow_type(PAIRS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "one", 500_000):
            keep = []
            ones, twos = (shingle_sets(part.column(c), rule.shingle) for c in ("one", "two"))
            keep += [rule.links(x, y) for x, y in zip(ones, twos, strict=True)]
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([part.column(c).filter(mask) for c in PAIRS.names], schema=kind)

    left = found.select(F.col("cls").alias("a"), F.col("text").alias("one"))
    right = found.select(F.col("cls").alias("b"), F.col("text").alias("two"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "one", "two").mapInArrow(run, PAIRS)


def near(classes: DataFrame) -> DataFrame:
    """A few pairs a class: with the smallest and the next smaller class of those with alike sketches."""
    band = F.floor(F.log("n") / F.log(F.lit(BAND)))
    met = classes.select("cls", "n", "least", band.alias("band"), F.explode(F.slice("least", 1, MEET)).alias("token"))
    order = Window.partitionBy("token", "band").orderBy("n", "cls")
    own = F.struct("cls", "n", "least")
    placed = met.withColumns({"hub": F.first(own).over(order), "last": F.lag(own).over(order)})
    beside = placed.select("cls", "least", F.explode(F.array("hub", "last")).alias("other"))
    alike = F.size(F.array_intersect("least", "other.least")) >= F.least(F.lit(ALIKE), F.size("least"))
    found = beside.filter((F.col("cls") != F.col("other.cls")) & alike)
    return found.select(F.least("cls", "other.cls").alias("a"), F.greatest("cls", "other.cls").alias("b")).distinct()


def settled(rows: DataFrame, rule: Rule) -> DataFrame:
    """Links (a, b) that connect what can be connected within each group (family, i, j).

    ``rows``: family, i, j, side, cls, n, comp, text. Where i < j, only links between sides are looked for.
    A link between classes that are connected already is left out.
    """
    kind = arrow_type(PAIRS)

    def group(members: list[tuple]) -> list[tuple[int, int]]:
        cls, n, comp, side = (np.array([m[k] for m in members], dtype=np.int64) for k in range(4))
        if len(cls) < 2 or comp.min() == comp.max():
            return []
        sets = shingle_sets(pa.array([m[4] for m in members], pa.string()), rule.shingle)
        parent = {c: c for c in comp.tolist()}

        def find(x: int) -> int:
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        found = []
        both = side.min() != side.max()
        likely = likely_pairs(n, comp, [bitmap(t, BITS_EACH) for t in sets], rule.percent)
        for a, b in zip(*(x.tolist() for x in likely), strict=True):
            if both and side[a] == side[b]:
                continue
            x, y = find(int(comp[a])), find(int(comp[b]))
            if x != y and rule.links(sets[a], sets[b]):
                parent[max(x, y)] = min(x, y)
                found.append((int(cls[a]), int(cls[b])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, members = None, []

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in group(members)], schema=kind)

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("family", "i", "j")), strict=True)
            values = zip(*(batch.column(c).to_pylist() for c in ("cls", "n", "comp", "side", "text")), strict=True)
            for now, value in zip(keys, values, strict=True):
                if now != key:
                    yield done()
                    key, members = now, []
                members.append(value)
        yield done()

    used = rows.select("family", "i", "j", "cls", "n", "comp", "side", "text")
    ordered = used.repartition("family", "i", "j").sortWithinPartitions("family", "i", "j", "cls")
    return ordered.mapInArrow(run, PAIRS)


def family_links(classes: DataFrame, families: DataFrame, rows: DataFrame, rule: Rule) -> DataFrame:
    """All links within the families (v, least), as far as components need them."""
    named = families.select(F.col("v").alias("cls"), F.col("least").alias("family"))
    placed = classes.select("cls", "doc_id", "n").join(by_key(named), "cls")
    parts = F.ceil(F.greatest(F.count("*") / GROUP, F.sum("n") / BLOCK_SHINGLES)).cast("int")
    sizes = placed.groupBy("family").agg(parts.alias("parts"))
    side = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    wanted = written(placed.join(by_key(sizes), "family").withColumn("side", side), "family")
    texts_ = written(fetched(rows, by_key(wanted), rule), "fetched")
    alone = texts_.withColumns({"i": F.col("side"), "j": F.col("side"), "comp": F.col("cls")})
    first = written(settled(alone, rule), "links")
    connected = components(first).withColumnRenamed("v", "cls")
    several = texts_.filter("parts > 1").drop("parts")
    open_ = several.join(by_key(connected), "cls", "left").withColumn("comp", F.coalesce("least", "cls")).drop("least")
    open_ = written(open_, "open")
    ends = open_.groupBy("family", "side").agg(F.min("comp").alias("low"), F.max("comp").alias("high"))
    one, two = (ends.select("family", *(F.col(c).alias(f"{c}_{k}") for c in ("side", "low", "high"))) for k in "ij")
    wholly = (F.col("low_i") == F.col("high_i")) & (F.col("low_j") == F.col("high_j")) & (F.col("low_i") == F.col("low_j"))
    meet = one.join(two, "family").filter("side_i < side_j").filter(~wholly)
    met = meet.select("family", F.col("side_i").alias("i"), F.col("side_j").alias("j"), F.explode(F.array("side_i", "side_j")).alias("side"))
    between = settled(open_.join(met, ["family", "side"]), rule)
    return written(first.unionByName(between), "links")


def join(docs: DataFrame, rule: Rule, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    profile = written(profiles(rows, rule), "profiles")
    documents = profile.filter("n IS NOT NULL")
    sound = F.assert_true(F.min("check") == F.max("check"), F.lit("two sets share a digest"))
    classes = written(
        documents.filter("doc_id IS NOT NULL AND n > 0")
        .groupBy("cls")
        .agg(F.min("doc_id").alias("doc_id"), F.first("n").alias("n"), F.first("least").alias("least"), sound.alias("sound"))
        .drop("sound"),
        "classes",
    )
    top = (
        profile.filter("frequent IS NOT NULL")
        .groupBy("frequent")
        .agg(F.sum("times").alias("times"))
        .orderBy(F.desc("times"), "frequent")
        .limit(FREQUENT)
        .collect()
    )
    often = np.array([r["frequent"] for r in top], dtype=np.int64).view(np.uint64)
    order = np.argsort(often)
    often, times = often[order], np.array([r["times"] for r in top], dtype=np.int64)[order]
    total = classes.agg(F.sum("n")).first()[0] or 0

    families = written(components(near(classes)), "families")
    links = family_links(classes, families, rows, rule)
    placed = shared_prefixes(rows.filter("doc_id IS NOT NULL"), rule, often, times, total * (100 - rule.percent) // 100)
    left = written(candidates(members(written(placed, "placed"), families, classes, documents), rule), "candidates")
    used = left.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = written(classes.select("cls", "doc_id").join(used, "cls"), "wanted")
    more = linked(left, written(fetched(rows, wanted, rule), "fetched"), rule)
    final = components(links.unionByName(more))

    named = classes.select("cls", "doc_id").join(by_key(final.withColumnRenamed("v", "cls")), "cls", "left")
    named = named.select("cls", "doc_id", F.coalesce("least", "cls").alias("comp"))
    smallest = named.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    labelled = by_key(named.join(by_key(smallest), "comp").select("cls", "component_id"))
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    joined = documents.select("doc_id", "n", "cls").join(labelled, "cls", "left")
    return joined.select("doc_id", F.col("n").cast("long").alias("n_shingles"), own.alias("component_id"))


def members(placed: DataFrame, families: DataFrame, classes: DataFrame, documents: DataFrame) -> DataFrame:
    """Classes that share a prefix shingle with one of another family, in groups of bounded size."""
    named = placed.join(by_key(families.withColumnRenamed("v", "cls")), "cls", "left")
    named = named.select("token", "cls", F.coalesce("least", "cls").alias("comp"))
    who = [F.min("cls").alias("low"), F.max("cls").alias("high"), F.bit_xor(F.xxhash64("cls")).alias("all")]
    groups = named.groupBy("token").agg(F.min("comp").alias("p"), F.max("comp").alias("q"), F.count("*").alias("size"), *who)
    # shingles that run together are shared by the same classes: one of them is enough
    once = groups.filter("p <> q").groupBy("size", "low", "high", "all").agg(F.min("token").alias("token"))
    open_ = written(named.join(by_key(once.select("token", "size")), "token"), "open")
    used = open_.select("cls").distinct()
    own = classes.select("cls", "doc_id").join(by_key(used), "cls")
    bits = documents.join(by_key(own), ["cls", "doc_id"]).select("cls", "n", "bits").dropDuplicates(["cls"])
    return blocks(open_).join(by_key(bits), "cls")
