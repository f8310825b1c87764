"""Benchmark decontamination: latent semantic retrieval, then common subsequences and answer checks.

1. Fit, over all passages of the corpus (blocks of ``PASSAGE`` words): passage frequencies of hashed terms, then
   a randomised SVD of the TF-IDF matrix A. Each task multiplies its passages with a random matrix and back
   (A'A times a random matrix, a Nystroem sketch), the sums are aggregated by term, and a small factorisation
   of the sketch gives the latent axes. Only terms that the benchmark has take part, and of its common words
   (``COMMON`` of the passages and more) only the ``RAREST`` rarest of each item. Terms are also divided by the
   square root of their frequency, the metric of correspondence analysis, or common words would take all axes.
   What leaves the tasks is ``TERMS`` rows of ``SKETCH`` numbers at most, and the same on the driver, whatever
   the corpus holds.
2. Search: benchmark passages are a stated query set, taken in blocks of ``ITEM_BLOCK`` items; every window of
   every document (a passage long, half a passage apart) is compared with all of a block by cosine.
3. Anchors: latent vectors miss items that stand among other rare words, so windows are candidates also by words.
   The check allows an item to lack a share of its words; of its rarest words, more than that share, some must
   stand around the window therefore. Windows are looked up by these words, which leaves out none that could pass:
   the result is that of the check over every window and item.
4. Check: candidates are compared word by word: the longest common subsequence of the item and the words
   around the window, and whether the item's answer stands there too. Most of an item is a leak; a smaller
   share (a paraphrase) is one only together with the answer.

Words are runs of letters and digits, A-Z lower-cased, so punctuation put between or after words changes nothing.

Defined cases: null and empty texts leak nothing; items without words are passed over; an item without answer
column has its last sentence as answer; several items can leak into one document and each is reported;
repeated rows are reported alike; an empty benchmark or corpus gives no rows. Filtering keeps all columns and
takes a longer name for its own where needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from migrascope.llm import words
from migrascope.llm.common import arrow_type, slices

TERMS = 1 << 16
RANK = 64
SKETCH = 72
COMMON = 0.02
RAREST = 16
PASSAGE = 32
ITEM_BLOCK = 2048
ANCHORED = 256  # items whose anchors are looked up at once
SLICE = 1_000_000  # bytes of text whose words are projected at once
MIN_COSINE = 0.55
VERBATIM = 0.8  # share of an item's words in order that is a leak by itself
PARAPHRASE = 0.6  # share that is one together with the answer
ANSWER = 0.8  # share of the answer's words that must be there

COUNTS = StructType([StructField("term", IntegerType()), StructField("n", LongType())])
SKETCHED = StructType([StructField("term", IntegerType()), StructField("row", ArrayType(FloatType()))])
LEAK = StructType(
    [
        StructField("item_id", LongType()),
        StructField("cosine", DoubleType()),
        StructField("lcs", IntegerType()),
        StructField("coverage", DoubleType()),
        StructField("answer_found", IntegerType()),
    ]
)


def plain(column: pa.Array) -> words.Words:
    return words.split(column, lower=True, separators=words.PLAIN)


def terms_of(found: words.Words) -> np.ndarray:
    return (found.hash & np.uint64(TERMS - 1)).astype(np.int64)


def runs_of(found: words.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ``size`` words of a row: first word and row of each run, and the run of each word."""
    counts = -(-np.diff(found.first) // size)
    row = np.repeat(np.arange(len(counts)), counts)
    inner = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = found.first[row] + inner * size
    return starts, row, np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(found.hash))))


def distinct_terms(benchmark: DataFrame) -> np.ndarray:
    """Which terms the benchmark has; ``TERMS`` flags."""
    return _flags(benchmark, lambda terms: terms)


def needed_terms(benchmark: DataFrame, frequency: np.ndarray) -> np.ndarray:
    """Terms that take part: rare ones, and the rarest of each item."""

    def pick(terms: np.ndarray) -> np.ndarray:
        terms = np.unique(terms)
        terms = terms[np.argsort(frequency[terms], kind="stable")]
        return terms[(frequency[terms] < COMMON) | (np.arange(len(terms)) < RAREST)]

    return _flags(benchmark, pick)


def _flags(benchmark: DataFrame, pick: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    kind = arrow_type(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(TERMS, bool)
        for part in slices(batches, "text", SLICE):
            found = plain(part.column("text"))
            terms = terms_of(found)
            for first, last in zip(found.first[:-1], found.first[1:], strict=True):
                held[pick(terms[first:last])] = True
        term = np.flatnonzero(held).astype(np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(np.ones(len(term), np.int64))], schema=kind)

    flags = np.zeros(TERMS, bool)
    for r in benchmark.select("text").mapInArrow(run, COUNTS).select("term").distinct().collect():
        flags[r["term"]] = True
    return flags


def passage_frequency(docs: DataFrame, terms: np.ndarray) -> tuple[np.ndarray, float]:
    """Share of all passages that hold each of the flagged terms, and the number of passages."""
    kind = arrow_type(COUNTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, counts = 0, np.zeros(TERMS, dtype=np.int64)
        for part in slices(batches, "text", SLICE):
            found = plain(part.column("text"))
            starts, _, passage = runs_of(found, PASSAGE)
            total += len(starts)
            own = terms_of(found)
            taken = terms[own]
            counts += np.bincount(np.unique(passage[taken] * TERMS + own[taken]) % TERMS, minlength=TERMS)
        term = np.append(-1, np.flatnonzero(counts)).astype(np.int32)
        values = np.append(total, counts[counts > 0])
        yield pa.RecordBatch.from_arrays([pa.array(term), pa.array(values)], schema=kind)

    counts, total = np.zeros(TERMS), 1.0
    summed = docs.select("text").mapInArrow(run, COUNTS).groupBy("term").agg(F.sum("n").alias("n"))
    for r in summed.collect():  # TERMS rows at most
        if r["term"] < 0:
            total = max(1.0, float(r["n"]))
        else:
            counts[r["term"]] = r["n"]
    return np.maximum(counts, 0.5) / total, total


@dataclass(frozen=True)
class Projection:
    """Takes the counts of terms to rows of ``matrix``; ``place`` is a term's row, or -1.

    The first ``common`` rows are those of common terms, at most ``PASSAGE / COMMON``. They make up
    most words, so they are counted per run and multiplied at once; the others are looked up.
    """

    place: np.ndarray
    matrix: np.ndarray
    common: int = 0
    share: np.ndarray | None = None  # of the passages, that hold a term

    def taken(self, found: words.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """First word and row of each run of ``size`` words; run and matrix row of each word that takes part."""
        starts, row, run = runs_of(found, size)
        at = self.place[terms_of(found)]
        words_ = np.flatnonzero(at >= 0)
        return starts, row, run[words_], at[words_]

    def sums(self, runs: int, of: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Projected sum of each run."""
        out = self.counts(runs, of, at) @ self.matrix[: self.common]
        of, at = of[at >= self.common], at[at >= self.common]
        if len(of):
            first = np.flatnonzero(np.append(True, of[1:] != of[:-1]))
            out[of[first]] += np.add.reduceat(self.matrix[at], first, axis=0)
        return out

    def counts(self, runs: int, of: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each common term stands in each run."""
        often = at < self.common
        found = np.bincount(of[often] * self.common + at[often], minlength=runs * self.common)
        return found.reshape(runs, self.common).astype(np.float32)


def sketch(docs: DataFrame, projection: Projection) -> np.ndarray:
    """Term counts of all passages, transposed, times their projections: A'A omega but for the left weights."""
    kind = arrow_type(SKETCHED)
    shape, common = projection.matrix.shape, projection.common

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(shape, dtype=np.float64)
        for part in slices(batches, "text", SLICE):
            found = plain(part.column("text"))
            starts, _, of, at = projection.taken(found, PASSAGE)
            if len(at):
                projected = projection.sums(len(starts), of, at)
                sums[:common] += projection.counts(len(starts), of, at).T @ projected
                of, at = of[at >= common], at[at >= common]
                order = np.argsort(at, kind="stable")
                ordered = at[order]
                first = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(at) else order
                sums[ordered[first]] += np.add.reduceat(projected[of[order]], first, axis=0) if len(at) else 0.0
        held = np.flatnonzero(sums.any(axis=1))
        rows = sums[held].astype(np.float32)
        offsets = pa.array(np.arange(len(held) + 1) * rows.shape[1], pa.int32())
        lists = pa.ListArray.from_arrays(offsets, pa.array(rows.ravel()), type=kind.field("row").type)
        yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), lists], schema=kind)

    parts = docs.select("text").mapInArrow(run, SKETCHED)
    sums = [F.sum(F.get("row", F.lit(i)).cast("double")).alias(f"s{i}") for i in range(shape[1])]
    out = np.zeros(shape)
    for r in parts.groupBy("term").agg(*sums).collect():  # TERMS rows at most
        out[r["term"]] = r[1:]
    return out


def axes(sketched: np.ndarray, omega: np.ndarray, rank: int) -> np.ndarray:
    """Latent axes of the terms, from the sketch A'A omega."""
    if not sketched.any():
        return np.zeros((len(sketched), 1))
    shift = 1e-9 * np.linalg.norm(sketched)
    moved = sketched + shift * omega
    core = omega.T @ moved
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    fine = values > values[-1] * 1e-10
    left, sizes, _ = np.linalg.svd(moved @ (vectors[:, fine] / np.sqrt(values[fine])), full_matrices=False)
    kept = sizes[:rank] > sizes[0] * 1e-6
    return left[:, :rank][:, kept]


def fit(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, seed: int = 1) -> Projection:
    """Latent space of the benchmark's terms over all passages of the documents."""
    frequency, total = passage_frequency(docs, distinct_terms(benchmark))
    needed = np.flatnonzero(needed_terms(benchmark, frequency))
    needed = needed[np.argsort(frequency[needed] < COMMON, kind="stable")]  # common terms first
    common = int((frequency[needed] >= COMMON).sum())
    place = np.full(TERMS, -1, dtype=np.int64)
    place[needed] = np.arange(len(needed))
    share = frequency[needed]
    weight = np.maximum(-np.log(np.minimum(share, 1.0)), 0.01) / np.sqrt(share)
    weight = weight[:, None] / weight.max(initial=1.0)
    omega = np.random.default_rng(seed).standard_normal((len(needed), SKETCH))
    sketched = sketch(docs, Projection(place, (weight * omega).astype(np.float32), common)) * weight
    matrix = (weight * axes(sketched, omega, rank)).astype(np.float32)
    return Projection(place, matrix, common, frequency.astype(np.float32))


@dataclass(frozen=True)
class Item:
    item_id: int
    size: int
    masks: dict[int, int]  # places of each word, as bits
    answer_size: int
    answer_masks: dict[int, int]


def masks_of(hashes: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, h in enumerate(hashes.tolist()):
        out[h] = out.get(h, 0) | (1 << i)
    return out


def common(masks: dict[int, int], size: int, text: list[int]) -> int:
    """Length of the longest common subsequence, all places of the item at once as bits of a number."""
    full = (1 << size) - 1
    state = full
    for word in text:
        places = masks.get(word)
        if places:
            met = state & places
            state = ((state + met) | (state - met)) & full
    return size - state.bit_count()


def last_sentence(text: Column) -> Column:
    return F.regexp_extract(text, r"([^.!?\n]+)[.!?\s]*$", 1)


class Anchors:
    """Where some items can stand at all, told by their rarest words.

    An item of n words may lack m of them, so of its m + k rarest at least k stand in the words that a window
    is checked with. All words below ``COMMON`` are taken, and m + 1 at least.
    """

    def __init__(self, items: list[np.ndarray], share: np.ndarray) -> None:
        self.size = np.array([len(own) for own in items], dtype=np.int64)
        self.least = np.ones(len(items), dtype=np.int64)
        keys: list[tuple[int, int]] = []
        for i, own in enumerate(items):
            rarity = share[(own & np.uint64(TERMS - 1)).astype(np.int64)]
            lacking = int(len(own) * (1 - PARAPHRASE) + 1e-9)
            taken = max(min(lacking + 1, len(own)), int((rarity < COMMON).sum()))
            self.least[i] = taken - lacking
            rarest = own[np.argsort(rarity, kind="stable")[:taken]]
            keys.extend((h, i) for h in np.unique(rarest).tolist())
        keys.sort()
        self.word, self.first = np.unique(np.array([h for h, _ in keys], dtype=np.uint64), return_index=True)
        self.first = np.append(self.first, len(keys))
        self.item = np.array([i for _, i in keys], dtype=np.uint16)
        self.flags = np.zeros(TERMS, bool)
        self.flags[(self.word & np.uint64(TERMS - 1)).astype(np.int64)] = True

    def windows(self, found: words.Words, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of every window that is checked with enough of the item's rarest words."""
        at = np.flatnonzero(self.flags[terms_of(found)])
        place = np.minimum(np.searchsorted(self.word, found.hash[at]), max(len(self.word) - 1, 0))
        if not len(at):
            return at, at
        exact = self.word[place] == found.hash[at]
        at, place = at[exact], place[exact]
        times = self.first[place + 1] - self.first[place]
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        item = self.item[np.repeat(self.first[place], times) + inner]
        order = np.argsort(item, kind="stable")  # by item, then place
        item, word = item[order].astype(np.int64), np.repeat(at, times)[order]
        last = np.arange(len(item)) + self.least[item] - 1
        held = np.flatnonzero(last < len(item))
        last, reach = last[held], PASSAGE + 2 * self.size[item[held]]
        near = (item[last] == item[held]) & (word[last] - word[held] < reach)
        item, low, high = item[held[near]], word[held[near]], word[last[near]]
        row = np.searchsorted(found.first, low, side="right") - 1
        inside = high < found.first[row + 1]
        item, low, high, row = item[inside], low[inside], high[inside], row[inside]
        opens = np.searchsorted(starts, np.maximum(high - PASSAGE - self.size[item] + 1, found.first[row]))
        closes = np.searchsorted(starts, np.minimum(low + self.size[item], found.first[row + 1] - 1), side="right")
        times = np.maximum(closes - opens, 0)
        inner = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
        pairs = np.unique((np.repeat(opens, times) + inner) * len(self.size) + np.repeat(item, times))
        return pairs // max(len(self.size), 1), pairs % max(len(self.size), 1)


class Search:
    """One block of benchmark items, ready to be held against documents."""

    def __init__(self, rows: list[tuple[int, str, str]], latent: Projection) -> None:
        self.latent, self.items = latent, []
        texts_ = plain(pa.array([r[1] for r in rows], pa.string()))
        answers = plain(pa.array([r[2] for r in rows], pa.string()))
        held = []
        for i, r in enumerate(rows):
            own = texts_.hash[texts_.first[i] : texts_.first[i + 1]]
            answer = answers.hash[answers.first[i] : answers.first[i + 1]]
            self.items.append(Item(r[0], len(own), masks_of(own), len(answer), masks_of(answer)))
            held.append(own)
        vectors, self.owner, _ = self.windows(texts_)
        self.queries = self.unit(vectors)
        self.query = np.searchsorted(self.owner, np.arange(len(rows) + 1))  # first query of each item
        share = latent.share if latent.share is not None else np.zeros(TERMS)
        self.anchors = [Anchors(held[i : i + ANCHORED], share) for i in range(0, len(held), ANCHORED)]

    def windows(self, found: words.Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Latent vector, row and first word (in the buffer) of each window."""
        starts, row, of, at = self.latent.taken(found, PASSAGE // 2)
        halves = self.latent.sums(len(starts), of, at)
        if not len(starts):
            return halves, row, starts
        joined = np.append(row[1:] == row[:-1], False)
        lone = np.append(True, row[1:] != row[:-1]) & ~joined
        vectors = halves.copy()
        vectors[:-1][joined[:-1]] += halves[1:][joined[:-1]]
        kept = joined | lone
        return vectors[kept], row[kept], starts[kept]

    @staticmethod
    def unit(vectors: np.ndarray) -> np.ndarray:
        return vectors / np.maximum(np.sqrt((vectors * vectors).sum(axis=1, keepdims=True)), 1e-12)

    def candidates(self, found: words.Words, starts: np.ndarray, cosine: np.ndarray) -> Iterator[tuple[int, int]]:
        """(window, item) to be checked, by cosine or by anchors, each once."""
        window, query = np.nonzero(cosine >= MIN_COSINE)
        pairs = [window * len(self.items) + self.owner[query]]
        for k, anchors in enumerate(self.anchors):
            window, item = anchors.windows(found, starts)
            pairs.append(window * len(self.items) + item + k * ANCHORED)
        for pair in np.unique(np.concatenate(pairs)).tolist():
            yield divmod(pair, len(self.items))

    def leaks(self, column: pa.Array) -> Iterator[tuple[int, list[dict]]]:
        """(row, leaks) for each row that leaks."""
        found = plain(column)
        vectors, row, starts = self.windows(found)
        if not len(row) or not len(self.queries):
            return
        cosine = self.unit(vectors) @ self.queries.T
        best: dict[tuple[int, int], dict] = {}
        for w, i in self.candidates(found, starts, cosine):
            r, item = int(row[w]), self.items[i]
            low = max(int(found.first[r]), int(starts[w]) - item.size)
            high = min(int(found.first[r + 1]), int(starts[w]) + PASSAGE + item.size)
            text = found.hash[low:high].tolist()
            lcs = common(item.masks, item.size, text)
            coverage = lcs / item.size
            if coverage < PARAPHRASE:
                continue
            answered = item.answer_size > 0 and common(item.answer_masks, item.answer_size, text) >= ANSWER * item.answer_size
            if coverage < VERBATIM and not answered:
                continue
            alike = float(cosine[w, self.query[i] : self.query[i + 1]].max())
            hit = (item.item_id, alike, lcs, coverage, int(answered))
            known = best.get((r, i))
            if known is None or (lcs, alike) > (known["lcs"], known["cosine"]):
                best[r, i] = dict(zip(LEAK.names, hit, strict=True))
        rows: dict[int, list[dict]] = {}
        for (r, _), hit in sorted(best.items()):
            rows.setdefault(r, []).append(hit)
        yield from rows.items()


def blocks(benchmark: DataFrame, answer: Column | None = None) -> Iterator[list[tuple[int, str, str]]]:
    """Items in blocks of ``ITEM_BLOCK``, one block at a time on the driver."""
    said = F.coalesce(answer if answer is not None else last_sentence(F.col("text")), F.lit(""))
    rows = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL")
    rows = rows.select(F.col("item_id").cast("long").alias("item_id"), "text", said.alias("answer"))
    block: list[tuple[int, str, str]] = []
    for r in rows.dropDuplicates().toLocalIterator():
        block.append((r["item_id"], r["text"], r["answer"]))
        if len(block) == ITEM_BLOCK:
            yield block
            block = []
    if block:
        yield block


def add_leaks(docs: DataFrame, search: Search, leaks: str, text: str = "text") -> DataFrame:
    """All rows and columns, with the list of leaks of one block of items."""
    schema = StructType([*docs.schema.fields, StructField(leaks, ArrayType(LEAK))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = arrow_type(schema)
        for part in slices(batches, text, SLICE):
            found = dict(search.leaks(part.column(text)))
            listed = pa.array([found.get(i, []) for i in range(part.num_rows)], kind.field(leaks).type)
            yield pa.RecordBatch.from_arrays([*part.columns, listed], names=kind.names)

    return docs.mapInArrow(run, schema)


def leaks(docs: DataFrame, benchmark: DataFrame, answer: Column | None = None) -> DataFrame:
    """(doc_id, item_id, cosine, lcs, coverage, answer_found) of every leak."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    latent, out = fit(rows, benchmark), None
    for block in blocks(benchmark, answer):
        found = add_leaks(rows, Search(block, latent), "leaks").select("doc_id", F.inline("leaks"))
        out = found if out is None else out.unionByName(found)
    if out is None:
        schema = StructType([StructField("doc_id", LongType()), *LEAK.fields])
        return docs.sparkSession.createDataFrame([], schema)
    return out
