"""Secret scan: patterns find candidates, corpus-wide ownership tells examples from live credentials.

Every candidate's hash is counted by distinct repositories and owners over the whole corpus. A candidate looks live
if it was seen with at most ``MAX_OWNERS`` owners, in at most ``MAX_REPOSITORIES`` repositories for each of them, and is
varied enough in its letters. One that many owners copied, or one owner into many repositories, is an example. The base spans stay whatever the counts say; the method adds a span of kind ``live`` over the
secret of each live-looking candidate, and candidates of further patterns (``EXTRA``) if they look live.

Counting first reduces to distinct (hash, repository, owner), in each task before the shuffle, so that an
example copied a billion times is a few rows. Texts are scanned once; only spans are shuffled.

Defined cases: null text is empty and has no spans; null repository or owner counts as one of its own kind;
repeated rows give a result row each, and their candidates count once per owner; an empty table gives no
rows; other columns are left out of the scan.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from migrascope.llm.common import arrow_type, fresh, saved, slices, texts

ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")  # the whole run: [0-9a-f]+ of 16 and more
EXTRA = re.compile(r"gh[pousr]_[A-Za-z0-9]{20,}|sk-[A-Za-z0-9]{20,}|eyJ[\w-]+\.eyJ[\w-]+\.[\w-]+|://[^\s/:@]+:([^\s/@]{8,})@")
BASE_KINDS = ("assign", "access", "hex")
MAX_OWNERS = 2
MAX_REPOSITORIES = 3  # for each owner
MIN_BITS = 2.5  # of entropy a letter

SPAN = StructType(
    [
        StructField("kind", StringType()),
        StructField("start", IntegerType()),
        StructField("end", IntegerType()),
        StructField("inner_start", IntegerType()),
        StructField("inner_end", IntegerType()),
        StructField("secret", StringType()),
        StructField("bits", DoubleType()),
    ]
)
SCANNED = StructType(
    [
        StructField("row", StringType()),
        StructField("doc_id", LongType()),
        StructField("repo", StringType()),
        StructField("owner", StringType()),
        StructField("spans", ArrayType(SPAN)),
    ]
)


def spans_of(text: str) -> list[tuple[str, int, int, int, int]]:
    """(kind, start, end, inner start, inner end) of all candidates, by start and kind."""
    found = []
    low = text.lower()
    if any(w in low for w in ASSIGN_WORDS):
        found += [("assign", *m.span(), *m.span(2)) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [("access", *m.span(), *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [("hex", *m.span(), *m.span()) for m in HEX.finditer(text)]
    if any(w in text for w in ("_", "sk-", "eyJ", "://")):
        found += [("extra", *m.span(), *m.span(1 if m[1] else 0)) for m in EXTRA.finditer(text)]
    order = {k: i for i, k in enumerate((*BASE_KINDS, "extra"))}
    return sorted(found, key=lambda s: (s[1], order[s[0]], s[2]))


def entropy(value: str) -> float:
    counts = Counter(value).values()
    return -sum(n / len(value) * math.log2(n / len(value)) for n in counts)


def scan(docs: DataFrame) -> DataFrame:
    """Candidates of each row of (row, doc_id, repo, owner, text); a secret is kept as its digest only."""
    kind = arrow_type(SCANNED)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            spans = []
            for text in texts(part, "text"):
                own = []
                for k, a, b, c, d in spans_of(text):
                    value = text[c:d]
                    digest = hashlib.sha256(value.encode()).hexdigest()
                    own.append(dict(zip(SPAN.names, (k, a, b, c, d, digest, entropy(value)), strict=True)))
                spans.append(own)
            columns = [part.column(c) for c in ("row", "doc_id", "repo", "owner")]
            arrays = [c.cast(f.type) for c, f in zip(columns, kind, strict=False)]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(spans, kind.field("spans").type)], schema=kind)

    return docs.select("row", "doc_id", "repo", "owner", "text").mapInArrow(find, SCANNED)


def ownership(found: DataFrame) -> DataFrame:
    """Distinct repositories and owners of each candidate."""
    seen = found.select("repo", "owner", F.explode("spans.secret").alias("secret"))
    marked = [F.coalesce(F.concat(F.lit("="), c), F.lit("")).alias(c) for c in ("repo", "owner")]
    once = seen.select("secret", *marked).distinct()
    return once.groupBy("secret").agg(
        F.count_distinct("repo").alias("repositories"), F.count_distinct("owner").alias("owners")
    )


def judged(
    docs: DataFrame, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES, min_bits: float = MIN_BITS
) -> DataFrame:
    """Each scanned row with its base spans and, as ``live``, the spans of live-looking secrets."""
    found = saved(scan(docs))
    few = (F.col("owners") <= max_owners) & (F.col("repositories") <= F.col("owners") * max_repositories)
    owned = ownership(found).filter(few)
    spread = found.select("row", "doc_id", F.explode("spans").alias("s")).select("row", "s.*")
    live = (
        spread.filter(F.col("bits") >= min_bits)
        .join(owned, "secret")
        .groupBy("row")
        .agg(F.collect_set(F.struct("inner_start", "inner_end")).alias("live"))
    )
    return found.join(live, "row", "left").withColumn(
        "live", F.coalesce(F.array_sort("live"), F.array().cast("array<struct<inner_start:int,inner_end:int>>"))
    )


def report(rows: DataFrame) -> DataFrame:
    """Counts, the digest of the base spans and the list of all spans, for each row of ``judged``."""

    def listed(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    live = F.transform(
        "live",
        lambda s: F.struct(
            s["inner_start"].alias("start"), F.lit(len(BASE_KINDS)).alias("rank"), F.lit("live").alias("kind"), s["inner_end"].alias("end")
        ),
    )
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(BASE_KINDS) for x in (k, i)])
    ranked = F.transform(
        base, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))
    )

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    counts = [count(k).alias(f"n_{k}") for k in BASE_KINDS]
    return rows.select(
        "doc_id",
        *counts,
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.array_sort(F.concat(ranked, live))).alias("spans"),
        F.size("live").cast("long").alias("n_live"),
    )


def redact(text: str, spans: list[dict], mark: str = "[secret]") -> str:
    """The text with each span replaced; overlapping spans become one mark."""
    out, at = [], 0
    for s in sorted(spans, key=lambda s: (s["inner_start"], -s["inner_end"])):
        if s["inner_end"] <= at:
            continue
        if s["inner_start"] >= at:
            out += [text[at : s["inner_start"]], mark]
        at = max(at, s["inner_end"])
    return "".join(out) + text[at:]


def redacted(docs: DataFrame, judged_rows: DataFrame, key: Column, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs``; live-looking secrets in the text are replaced. ``key`` is the row's key."""
    names, row, spans = docs.columns, fresh(docs, "row"), fresh(docs, "live")
    live = judged_rows.filter(F.size("live") > 0).select(F.col("row").alias(row), F.col("live").alias(spans))
    marked = docs.withColumn(row, key).join(live.dropDuplicates([row]), row, "left").drop(row)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text):
            pairs = zip(part.column(text).to_pylist(), part.column(spans).to_pylist(), strict=True)
            plain = pa.array([redact(t, s) if s else t for t, s in pairs], part.column(text).type)
            yield pa.RecordBatch.from_arrays([plain if c == text else part.column(c) for c in names], names=names)

    return marked.mapInArrow(run, docs.schema)
