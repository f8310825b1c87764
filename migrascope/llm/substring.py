"""Substring dedup: windows of words that also start in a document with a smaller id are removed.

Seed: each window of ``length`` words has an anchor, its least hashed run of ``SEED`` words (winnowing), so
equal windows have equal anchors and consecutive windows mostly share one. An anchor occurrence stands for the
run of windows it anchors, and its extent is all their words.

Extend: occurrences are grouped by anchor. Those with equal extents form a class, of which only the least
document keeps its windows; this settles copies, however many, with one row each and no pairs. Only where an
anchor has several classes, one occurrence of each is extended to both sides of the anchor, window by window
inside its extent, by the hashes of the windows. Repeated windows that overlap or touch are united to maximal
spans, each at least ``length`` words long, and the words of the spans are removed.

No step compares pairs of documents, so a passage in a third of all documents costs as many rows as it has
occurrences. Counts are aggregated before shuffling; joins are plain equi-joins that adaptive execution may
split.

Defined cases: null text has no words; fewer words than a window: nothing is removed; a row without id is
neither compared nor changed; rows that repeat an id are one document, each judged by its own text; an empty
table gives no rows; other columns are left out, also such as clash with result columns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from migrascope.llm import words
from migrascope.llm.common import arrow_type, slices, texts, written

SEED = 10
INVERSE = np.uint64(pow(int(words.BASE), -1, 1 << 64))

OCCURRENCE = StructType(
    [
        StructField("anchor", LongType()),
        StructField("extent", LongType()),
        StructField("doc_id", LongType()),
        StructField("fp", LongType()),
        StructField("lo", IntegerType()),
        StructField("hi", IntegerType()),
    ]
)
WINDOWS = StructType(
    [
        StructField("window", LongType()),
        StructField("doc_id", LongType()),
        StructField("fp", LongType()),
        StructField("lo", IntegerType()),
    ]
)
RESULT = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("n_words", LongType()),
        StructField("n_removed", LongType()),
        StructField("kept_sha256", StringType()),
    ]
)


def identified(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, fp, text): fp tells rows of one id apart by their text."""
    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("fp"),
        F.col(text).alias("text"),
    )


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the least value (the first of equal ones) in each run of ``width`` values."""
    at, span = np.arange(len(values)), 1
    while span < width:
        step = min(span, width - span)
        left, right = at[: len(at) - step], at[step:]
        at = np.where(values[left] <= values[right], left, right)
        span += step
    return at


def occurrences(found: words.Words, length: int) -> tuple[np.ndarray, ...]:
    """Row, anchor, extent, first and last window (as word places in the row) of each anchor occurrence."""
    n = len(found.hash) - length + 1
    if n <= 0:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    seeds, _ = words.grams(found, SEED)
    sizes = np.diff(found.first)
    row = np.repeat(np.arange(len(sizes)), sizes)
    starts = np.flatnonzero(np.arange(n) + length <= found.first[row[:n] + 1])
    if not len(starts):
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    anchors = _least(seeds, length - SEED + 1)[starts]
    new = np.ones(len(starts), bool)
    new[1:] = (np.diff(anchors) != 0) | (row[starts[1:]] != row[starts[:-1]])
    opens = np.flatnonzero(new)
    lo, hi = starts[opens], starts[np.append(opens[1:], len(starts)) - 1]
    power = words.powers(len(found.hash) + 1)
    inverse = np.full(len(found.hash) + 1, INVERSE, np.uint64)
    inverse[0] = 1
    inverse = np.cumprod(inverse, dtype=np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(found.hash * power[:-1], dtype=np.uint64)])
    extent = (sums[hi + length] - sums[lo]) * inverse[lo]
    shape = ((hi - lo).astype(np.uint64) << np.uint64(32)) + (anchors[opens] - lo).astype(np.uint64)
    own = row[lo]
    return own, seeds[anchors[opens]], words.mix(extent ^ words.mix(shape)), lo - found.first[own], hi - found.first[own]


def _anchored(docs: DataFrame, length: int) -> DataFrame:
    kind = arrow_type(OCCURRENCE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            row, anchor, extent, lo, hi = occurrences(words.split(part.column("text")), length)
            ids = [part.column(c).take(pa.array(row)) for c in ("doc_id", "fp")]
            hashes = [pa.array(words.signed(h.astype(np.uint64))) for h in (anchor, extent)]
            ends = [pa.array(x.astype(np.int32)) for x in (lo, hi)]
            yield pa.RecordBatch.from_arrays([*hashes, *ids, *ends], schema=kind)

    return docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(run, OCCURRENCE)


def _extended(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Hashes of the windows in the given runs, taken from the texts."""
    kind = arrow_type(WINDOWS)
    listed = runs.groupBy("doc_id", "fp").agg(F.collect_set(F.struct("lo", "hi")).alias("runs"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            found = words.split(part.column("text"))
            hashes, _ = words.grams(found, length)
            row, places = [], []
            for i, own in enumerate(part.column("runs").to_pylist()):
                for r in own:
                    places.append(np.arange(r["lo"], r["hi"] + 1))
                    row.append(np.full(len(places[-1]), i))
            at, own = np.concatenate(places), np.concatenate(row)
            ids = [part.column(c).take(pa.array(own)) for c in ("doc_id", "fp")]
            window = words.signed(hashes[found.first[own] + at])
            yield pa.RecordBatch.from_arrays([pa.array(window), *ids, pa.array(at.astype(np.int32))], schema=kind)

    joined = docs.join(listed, ["doc_id", "fp"]).dropDuplicates(["doc_id", "fp"])
    return joined.select("doc_id", "fp", "text", "runs").mapInArrow(run, WINDOWS)


def repeated(docs: DataFrame, length: int) -> DataFrame:
    """(doc_id, fp, lo, hi): runs of windows of ``identified`` rows that also start in a smaller document."""
    found = written(_anchored(docs, length), "anchors")
    classes = found.groupBy("anchor", "extent").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most"))
    anchors = classes.groupBy("anchor").agg(F.count("*").alias("classes"), F.min("least").alias("first"), F.max("most").alias("last"))
    shared = (
        classes.join(anchors.filter("first < last"), "anchor")
        .select("anchor", "extent", "least", F.expr("classes > 1").alias("several"))
    )
    settled = written(found.join(shared, ["anchor", "extent"]).drop("anchor", "extent"), "shared")
    copies = settled.filter("doc_id > least").select("doc_id", "fp", "lo", "hi")
    windows = written(_extended(docs, settled.filter("several AND doc_id = least"), length), "windows")
    least = windows.groupBy("window").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("most")).filter("least < most")
    more = windows.join(least, "window").filter("doc_id > least").select("doc_id", "fp", "lo", F.col("lo").alias("hi"))
    return copies.unionByName(more)


def spans(runs: DataFrame, length: int) -> DataFrame:
    """(doc_id, fp, start, end): maximal repeated spans of words, from runs of windows."""
    own = Window.partitionBy("doc_id", "fp").orderBy("lo", "hi")
    reach = F.max(F.col("hi") + length).over(own.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(reach >= F.col("lo"), 0).otherwise(1)
    numbered = runs.withColumn("opens", opens).withColumn("span", F.sum("opens").over(own))
    ends = [F.min("lo").alias("start"), (F.max("hi") + length).alias("end")]
    return numbered.groupBy("doc_id", "fp", "span").agg(*ends).drop("span")


def kept(docs: DataFrame, runs: DataFrame, length: int) -> DataFrame:
    """Counts and digest of the words outside the maximal spans of the runs, for every row of ``identified``."""
    kind = arrow_type(RESULT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            rows = []
            for doc_id, text, own in zip(
                part.column("doc_id").to_pylist(), texts(part, "text"), part.column("spans").to_pylist(), strict=True
            ):
                found = text.encode().split()  # bytes split on exactly 0x20 and 0x09-0x0D
                keep = np.ones(len(found), bool)
                for span in own or ():
                    keep[span["start"] : span["end"]] = False
                stay = [w for w, k in zip(found, keep, strict=True) if k] if own else found
                digest = hashlib.sha256(b" ".join(stay)).hexdigest()
                rows.append((doc_id, len(found), len(found) - len(stay), digest))
            yield pa.RecordBatch.from_pylist([dict(zip(RESULT.names, r, strict=True)) for r in rows], schema=kind)

    listed = spans(runs, length).groupBy("doc_id", "fp").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    joined = docs.join(listed, ["doc_id", "fp"], "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(run, RESULT)
