"""Toxicity: a learned lexicon, matched by Levenshtein automata intersected with its trie, weighed by context.

Learning takes a bounded, documented sample of labelled rows (``LABELLED_ROWS``, near copies once): terms that
mark label 1 become the lexicon, either whole words or stems (beginnings of compounds). Scoring covers every
row and its whole text. The trie of the lexicon and the Levenshtein automaton run as one product automaton,
made deterministic as words reach its states, so that most words die after a few letters. A word without a hit
is cut at its inner punctuation, and its pieces are matched. A hit counts by the window of words around it:
inside quotation marks or near a verb of saying it counts less, near an address (you) or other hits more. A
logistic regression on the weighed counts gives the score.

Neighbours of a term are judged by the sample too (``permitted``): words near a term that clean documents use are
innocent and never hits. A short word or a stem allows an edit only where, those apart, hardly any clean document
holds a neighbour of it.

Defined cases: null and empty texts have no hits and get the score of such texts; repeated rows are scored
alike; null labels teach nothing, of several labels of a document the highest counts; without labelled rows
(or with one class only) the score is the share of label 1, or 0; an empty table gives no rows. Columns pass
through; a result column takes a longer name if its own is taken.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType

from migrascope.llm import words
from migrascope.llm.common import arrow_type, saved, slices, texts

LABELLED_ROWS = 6000  # bound of the labelled sample that lexicon and regression are learned from
LEXICON_SIZE = 200
RANKED = 4000  # best terms that the lexicon is chosen from; bound of the innocent words as well
MIN_SHARE = 0.02  # of the toxic sample a term must occur in
MIN_DOCS = 5
MIN_LOG_ODDS = 1.5
MIN_GAIN = 20.0  # likelihood ratio of a term
STEM_LETTERS = range(3, 9)
SHORT = 5  # letters from which a word or a stem is not short
INNOCENT_DOCS = 2  # clean documents of the sample that make a neighbour of a term innocent
STRAY_SHARE = 0.002  # of the clean sample that may hold other neighbours of a short word or a stem
WINDOW = 8  # words of context on each side
KNOWN_WORDS = 300_000  # size of the memo of a task
EDGES = ".,;:!?\"'`“”„«»‘’()[]{}<>*#$%&|~^=+-_/\\…"
INNER = re.compile(f"[{re.escape(EDGES)}]+")
QUOTES = frozenset("\"“”„«»")
SAYING = frozenset("said says say saying wrote writes called calls quote quotes quoted word words term dit dijo sagte".split())
ADDRESS = frozenset("you your you're youre yours u ur du dich dein ihr tu toi vous usted tú".split())


def edits(term: str) -> int:
    """Edits allowed in a word of the lexicon, unless its neighbours forbid them."""
    return 0 if len(term) < SHORT - 1 else 1 if len(term) < 9 else 2


@dataclass(frozen=True)
class Entry:
    term: str
    stem: bool  # matches the beginning of longer words
    edits: int = 0


def entry(term: str, stem: bool = False) -> Entry:
    """An entry with all edits its length allows; one at most in a stem."""
    return Entry(term, stem, int(len(term) >= SHORT) if stem else edits(term))


class Automaton:
    """Product of the lexicon's trie and the Levenshtein automaton, made deterministic state by state."""

    def __init__(self, entries: list[Entry]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.words: dict[int, Entry] = {}
        self.stems: dict[int, Entry] = {}
        self.room: list[int] = [0]  # most edits any entry below a node allows
        for own in entries:
            node = 0
            self.room[0] = max(self.room[0], own.edits)
            for letter in own.term:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.room.append(0)
                node = self.children[node][letter]
                self.room[node] = max(self.room[node], own.edits)
            (self.stems if own.stem else self.words)[node] = own
        self.steps: list[dict[str, int]] = []
        self.sets: list[tuple[tuple[int, int], ...]] = []
        self.number: dict[tuple[tuple[int, int], ...], int] = {}
        self.verdicts: list[tuple[tuple[int, str] | None, tuple[int, str] | None]] = []
        self.first = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """Number of the state that holds the least edits for each trie node; skipped letters are added."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                cost = reached[node] + 1
                if cost <= self.room[child] and cost < reached.get(child, 99):
                    reached[child] = cost
                    todo.append(child)
        key = tuple(sorted(reached.items()))
        if key not in self.number:
            self.number[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            self.verdicts.append((self._best(key, self.stems), self._best(key, self.words)))
        return self.number[key]

    @staticmethod
    def _best(key: tuple[tuple[int, int], ...], ends: dict[int, Entry]) -> tuple[int, str] | None:
        """Fewest edits and the term, of the entries that end in a state."""
        return min(((cost, ends[n].term) for n, cost in key if n in ends and cost <= ends[n].edits), default=None)

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}
        for node, cost in self.sets[state]:
            for known, child in self.children[node].items():
                now = cost + (known != letter)
                if now <= (self.room[child] if now else 99) and now < reached.get(child, 99):
                    reached[child] = now
            if cost < self.room[node] and cost + 1 < reached.get(node, 99):
                reached[node] = cost + 1
        to = self._state(reached) if reached else -1
        self.steps[state][letter] = to
        return to

    def find(self, word: str) -> tuple[str, str] | None:
        """Kind and term: ``exact``, ``stem``, ``near`` or ``near stem``, the first of these that fits.

        A stem is followed by a letter at least, a misspelled one by two.
        """
        state, stem = self.first, None
        for i, letter in enumerate(word):
            to = self.steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if state < 0:
                break
            here = self.verdicts[state][0]
            if here and i + 1 + (here[0] > 0) < len(word) and (stem is None or here < stem):
                stem = here
        whole = self.verdicts[state][1] if state >= 0 else None
        if whole and whole[0] == 0:
            return "exact", whole[1]
        if stem and stem[0] == 0:
            return "stem", stem[1]
        return ("near", whole[1]) if whole else ("near stem", stem[1]) if stem else None

    def match(self, word: str) -> str | None:
        found = self.find(word)
        return found and found[0]


@dataclass(frozen=True)
class Model:
    entries: list[Entry] = field(default_factory=list)
    weights: list[float] = field(default_factory=list)
    intercept: float = -math.inf
    innocent: frozenset[str] = frozenset()  # words near a term that are no hits

    def score(self, features: np.ndarray) -> np.ndarray:
        logits = np.full(len(features), self.intercept)
        if self.weights:
            logits = logits + features @ np.array(self.weights)
        return 1 / (1 + np.exp(-np.clip(logits, -700, 700))) if math.isfinite(self.intercept) else np.zeros(len(features))


FEATURES = 4


def pieces(word: str) -> list[str]:
    """A word without punctuation at its ends, cut at that inside it."""
    bare = word.strip(EDGES)
    return [bare] if bare.isalnum() else [p for p in INNER.split(bare) if p]


WEIGHTS = {"exact": 1.0, "near": 0.5, "stem": 1.0, "near stem": 0.5}


class Scorer:
    """Features of texts, with a bounded memo of the words seen so far."""

    def __init__(self, entries: list[Entry], innocent: frozenset[str] = frozenset()) -> None:
        self.automaton = Automaton(entries)
        self.innocent = innocent
        self.known: set[str] = set()
        self.hits: dict[str, list[str]] = {}

    def found(self, raw: str) -> list[tuple[str, str, str]]:
        """Kind, term and word of the hits in a word: in the whole of it, or else in its pieces."""
        bare = raw.strip(EDGES)
        for parts in ([bare], () if bare.isalnum() else pieces(bare)):
            hits = [(*hit, part) for part in parts if (hit := self.automaton.find(part)) is not None]
            hits = [h for h in hits if h[2] not in self.innocent or h[0] in ("exact", "stem")]
            if hits:
                return hits
        return []

    def features(self, text: str) -> list[float]:
        low = text.lower()
        tokens = low.split()
        distinct = set(tokens)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
            self.hits.clear()
        for raw in distinct.difference(self.known):
            self.known.add(raw)
            found = self.found(raw)
            if found:
                self.hits[raw] = [kind for kind, _, _ in found]
        if self.hits.keys().isdisjoint(distinct):
            return [0.0] * FEATURES
        places = [i for i, raw in enumerate(tokens) if raw in self.hits]
        whole = stems = quoted = 0.0
        for n, i in enumerate(places):
            weight, quote = self._context(tokens, i, places, n)
            quoted += quote
            for kind in self.hits[tokens[i]]:
                if kind in ("stem", "near stem"):
                    stems += weight * WEIGHTS[kind]
                else:
                    whole += weight * WEIGHTS[kind]
        return [math.log1p(whole), math.log1p(stems), stems / math.sqrt(len(tokens)), math.log1p(quoted)]

    def _context(self, tokens: list[str], i: int, places: list[int], n: int) -> tuple[float, bool]:
        """Weight of a hit by the window around it, and whether it looks like a quotation."""
        before, after = tokens[max(0, i - WINDOW) : i], tokens[i + 1 : i + 1 + WINDOW]
        marks = lambda part: sum(c in QUOTES for w in part for c in (w[:1], w[-1:] if len(w) > 1 else ""))
        own = tokens[i]
        enclosed = own[:1] in QUOTES and own.rstrip(".,;:!?")[-1:] in QUOTES
        open_quote = (marks(before) + (own[:1] in QUOTES)) % 2 == 1 and marks([own, *after]) > 0
        around = {w.strip(EDGES) for w in (*before, *after)}
        quote = enclosed or open_quote or not SAYING.isdisjoint(around)
        weight = 0.25 if quote else 1.0
        if not ADDRESS.isdisjoint(around):
            weight *= 1.5
        near = (n > 0 and i - places[n - 1] <= WINDOW) + (n + 1 < len(places) and places[n + 1] - i <= WINDOW)
        return weight * (1 + 0.1 * near), quote


def add_score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """All rows and columns, with the score from 0 to 1."""
    schema = StructType([*docs.schema.fields, StructField(score, DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model.entries, model.innocent)
        kind = arrow_type(schema)
        for part in slices(batches, text):
            features = np.array([scorer.features(t) for t in texts(part, text)]).reshape(-1, FEATURES)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.score(features))], names=kind.names)

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    """Rows no label is learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, toxic) of at most ``rows`` labelled documents, chosen by a hash of the id."""
    known = (
        labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id")  # the bound is ``rows``


LEARNED = StructType(
    [
        StructField("toxic", LongType()),
        StructField("group", LongType()),
        StructField("text", StringType()),
        StructField("terms", ArrayType(StringType())),
    ]
)


def _with_terms(sample: DataFrame) -> DataFrame:
    """Terms of each sampled document: words as ``=word``, beginnings of words as they are.

    ``group`` is the smallest hash of five words running, which near copies mostly share.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = arrow_type(LEARNED)
        for part in slices(batches, "text"):
            rows = []
            found = words.split(part.column("text"), lower=True)
            hashes, inside = words.grams(found, 5)
            for i, (text, toxic) in enumerate(zip(texts(part, "text"), part.column("toxic").to_pylist(), strict=True)):
                own = slice(found.first[i], found.first[i + 1])
                kept = hashes[own][inside[own]]
                group = kept.min() if len(kept) else words.mix(found.hash[own]).sum(dtype=np.uint64)
                raw = set(text.lower().split())
                distinct = ({w.strip(EDGES) for w in raw} | {p for w in raw for p in pieces(w)}) - {""}
                terms = {f"={w}" for w in distinct}
                terms.update(w[:n] for w in distinct for n in STEM_LETTERS if n < len(w))
                rows.append({"toxic": toxic, "group": int(np.int64(np.uint64(group).view(np.int64))), "text": text, "terms": list(terms)})
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    picked = sample.select(F.col("toxic").cast("long").alias("toxic"), "text")
    return picked.mapInArrow(run, LEARNED)


def learn(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Model:
    """Lexicon and regression from the labelled sample; what reaches the driver is bounded by ``rows``."""
    sample = saved(_with_terms(labelled_sample(docs, labels, rows)).dropDuplicates(["group", "toxic"]))
    size = {int(r["toxic"] > 0): r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = size.get(1, 0), size.get(0, 0)
    if not toxic or not clean:
        return Model() if not toxic else Model(intercept=30.0)
    spread = sample.select("toxic", F.explode("terms").alias("term"))
    counts = spread.groupBy("term").agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
    bad, all_ = F.col("bad"), F.col("all")
    odds = F.log(((bad + 0.5) / (toxic + 1)) / ((all_ - bad + 0.5) / (clean + 1)))
    strong = counts.filter((bad >= max(MIN_DOCS, MIN_SHARE * toxic)) & (odds >= MIN_LOG_ODDS))
    found = strong.withColumn("gain", _gain(bad, all_, toxic, clean)).filter(F.col("gain") >= MIN_GAIN)
    best = found.orderBy(F.desc("gain"), F.desc(F.length("term")), "term").limit(RANKED)
    entries, innocent = permitted(sample, choose([r["term"] for r in best.collect()]), toxic, clean)
    rows_ = _features(sample, entries, innocent).collect()
    x = np.array([r["features"] for r in rows_], dtype=float).reshape(-1, FEATURES)
    y = np.array([r["toxic"] > 0 for r in rows_], dtype=float)
    weights, intercept = regress(x, y)
    return Model(entries, weights, intercept, innocent)


def _gain(bad: Column, all_: Column, toxic: int, clean: int) -> Column:
    """Likelihood ratio of term and label."""
    n = float(toxic + clean)

    def cell(k: Column, row: Column, column: int) -> Column:
        return F.when(k > 0, k * F.log(k * n / (row * column))).otherwise(0.0)

    none = n - all_
    return 2 * (
        cell(bad, all_, toxic) + cell(all_ - bad, all_, clean) + cell(toxic - bad, none, toxic) + cell(clean - all_ + bad, none, clean)
    )


def choose(ranked: list[str]) -> list[Entry]:
    """Best terms first; a term that begins with a chosen one, or the other way round, adds nothing."""
    chosen: list[Entry] = []
    for term in ranked:
        plain = term.removeprefix("=")
        if len(plain) < 3 or any(plain.startswith(e.term) or e.term.startswith(plain) for e in chosen):
            continue
        chosen.append(entry(plain, stem=not term.startswith("=")))
        if len(chosen) == LEXICON_SIZE:
            break
    return chosen


NEIGHBOURS = StructType(
    [
        StructField("toxic", LongType()),
        StructField("term", StringType()),
        StructField("stem", BooleanType()),
        StructField("word", StringType()),
    ]
)


def permitted(sample: DataFrame, entries: list[Entry], toxic: int, clean: int) -> tuple[list[Entry], frozenset[str]]:
    """The entries with the edits that their neighbours in the sample permit, and the innocent neighbours.

    A neighbour is innocent if at least ``INNOCENT_DOCS`` clean documents hold it and it is no mark of label 1.
    """
    kind = arrow_type(NEIGHBOURS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(entries)
        for part in slices(batches, "text"):
            rows = []
            for text, label in zip(texts(part, "text"), part.column("toxic").to_pylist(), strict=True):
                hits = {hit for raw in set(text.lower().split()) for hit in scorer.found(raw)}
                near = [h for h in hits if h[0].startswith("near")]
                rows += [{"toxic": label, "term": t, "stem": k == "near stem", "word": w} for k, t, w in near]
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    near = sample.select("toxic", "text").mapInArrow(run, NEIGHBOURS)
    counts = near.groupBy("term", "stem", "word").agg(F.sum("toxic").alias("bad"), F.count("*").alias("all"))
    bad, good = F.col("bad"), F.col("all") - F.col("bad")
    odds = F.log(((bad + 0.5) / (toxic + 1)) / ((good + 0.5) / (clean + 1)))
    used = (good >= INNOCENT_DOCS) & (odds < MIN_LOG_ODDS)
    judged = saved(counts.select("term", "stem", "word", good.alias("good"), used.alias("innocent")))
    first = judged.filter("innocent").orderBy(F.desc("good"), "word").select("word").limit(RANKED)
    innocent = frozenset(r["word"] for r in first.collect())
    others = judged.withColumn("stray", F.when(F.col("innocent") & ~F.col("stem"), 0).otherwise(F.col("good")))
    stray = {(r["term"], r["stem"]): r["n"] for r in others.groupBy("term", "stem").agg(F.sum("stray").alias("n")).collect()}

    def short(e: Entry) -> bool:
        return e.stem or len(e.term) < SHORT

    kept = [replace(e, edits=0) if short(e) and stray.get((e.term, e.stem), 0) > STRAY_SHARE * clean else e for e in entries]
    return kept, innocent


def _features(sample: DataFrame, entries: list[Entry], innocent: frozenset[str]) -> DataFrame:
    schema = StructType([StructField("toxic", LongType()), StructField("features", ArrayType(DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(entries, innocent)
        for part in slices(batches, "text"):
            values = pa.array([scorer.features(t) for t in texts(part, "text")], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([part.column("toxic"), values], names=schema.names)

    return sample.select("toxic", "text").mapInArrow(run, schema)


def regress(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 40) -> tuple[list[float], float]:
    """Logistic regression by Newton steps; the weights of the four features are small and well scaled."""
    design = np.column_stack([x, np.ones(len(x))])
    beta, penalty = np.zeros(design.shape[1]), np.full(design.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (p - y) + penalty * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty + 1e-9)
        step = np.linalg.solve(hessian, gradient)
        beta -= np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return [float(b) for b in beta[:-1]], float(beta[-1])
