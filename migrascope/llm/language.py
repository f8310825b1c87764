"""Language ID by compression: the language whose sample helps most to compress a text.

For each language that the learning rows name, a bounded sample becomes a raw-content dictionary of zstandard. A
text is lower-cased, runs of anything but letters become one space, and it is cut into pieces of ``PIECE`` bytes;
every piece of the whole text is encoded with every dictionary, and the sizes are summed. The smallest sum wins,
ties go to the language with more learning rows, then by name. ``score`` is how much smaller the winner's sum is
than the runner-up's (a share, 0 to 1); below ``MARGIN`` the text counts as rejected (``accepted`` false), though
its best language is still told.

Pieces keep the dictionaries near: in one long frame only the first kilobytes would be told by them, the rest by the
text itself. Dictionaries are cut to one length, since places in a shorter one take fewer bits. The sample is at most ``BUCKETS`` excerpts a language, those with the least hash in their bucket; what
reaches the driver is bounded by the number of languages times ``BUCKETS * EXCERPT`` characters.

Defined cases: a null text or one without a letter is ``und`` with score 0 and rejected, as is every text when
nothing was learned; with one learned language the score is 1; a learning row without text or letters adds nothing
to the sample; a null id is not held out; equal texts get equal answers; an empty table gives no
rows; a column that is there already keeps its name, the result's takes a longer one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from migrascope.llm.common import arrow_type, fresh, slices

UNDETERMINED = "und"
BUCKETS = 1024  # excerpts of a language
EXCERPT = 1024  # characters of an excerpt before it is cleaned
DICTIONARY = 131_072  # bytes of a dictionary at most
LEAST_DICTIONARY = 8192  # dictionaries are cut to the shortest one, but not below this
PIECE = 256  # bytes encoded at a time
LEVEL = 6  # searches thoroughly enough that sizes tell the dictionaries and not the luck of a hash
TABLES = 18  # bits of window and match tables, the same for every dictionary
MARGIN = 0.01
OTHER = re.compile(r"[\W\d_]+")


def cleaned(text: str) -> bytes:
    """Letters of the text, lower-cased, runs of anything else as one space."""
    return OTHER.sub(" ", text.lower()).strip().encode()


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Rows that learning never sees."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == 0, F.lit(False))


@dataclass(frozen=True)
class Model:
    """Learned languages, those with more rows first, each with the content of its dictionary."""

    samples: tuple[tuple[str, bytes], ...] = ()

    def encoders(self) -> list[tuple[str, zstandard.ZstdCompressor]]:
        plain = {"write_content_size": 0, "write_checksum": 0, "write_dict_id": 0}
        parameters = zstandard.ZstdCompressionParameters.from_level(LEVEL, window_log=TABLES, hash_log=TABLES, chain_log=TABLES, **plain)
        out = []
        for language, content in self.samples:
            known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=parameters)
            out.append((language, zstandard.ZstdCompressor(compression_params=parameters, dict_data=known)))
        return out


def learn(rows: DataFrame, text: str = "text", lang: str = "lang") -> Model:
    """Dictionaries from labelled rows. The least hashes are found per task first, so a hot language costs no more."""
    known = rows.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang IS NOT NULL")
    digest = F.xxhash64(F.coalesce("text", F.lit("")))
    excerpts = known.select("lang", digest.alias("h"), F.substring("text", 1, EXCERPT).alias("excerpt"))
    picked = excerpts.groupBy("lang", F.pmod("h", F.lit(BUCKETS)).alias("bucket")).agg(
        F.min(F.struct("h", "excerpt")).alias("least"), F.count("*").alias("n")
    )
    found: dict[str, list] = {}
    for r in picked.select("lang", "least.*", "n").collect():  # bounded: BUCKETS rows a language
        found.setdefault(r["lang"], []).append((r["h"], r["excerpt"] or "", r["n"]))
    rows_of = {language: sum(n for *_, n in parts) for language, parts in found.items()}
    samples = []
    for language in sorted(found, key=lambda x: (-rows_of[x], x)):
        content = b" ".join(filter(None, (cleaned(excerpt) for _, excerpt, _ in sorted(found[language]))))[:DICTIONARY]
        if content:
            samples.append((language, content))
    length = max(LEAST_DICTIONARY, min((len(content) for _, content in samples), default=0))
    return Model(tuple((language, content[:length]) for language, content in samples))


def sizes(text: bytes, encoders: list[tuple[str, zstandard.ZstdCompressor]]) -> list[int]:
    """Bytes that the pieces of a cleaned text take with each dictionary."""
    pieces = [text[i : i + PIECE] for i in range(0, len(text), PIECE)]
    return [sum(len(encoder.compress(p)) for p in pieces) for _, encoder in encoders]


def choose(sums: list[int]) -> tuple[int, float]:
    """Place of the least sum (the first of equal ones) and its margin as a share of the next one."""
    best = min(range(len(sums)), key=lambda i: (sums[i], i))
    rest = [s for i, s in enumerate(sums) if i != best]
    return best, 1 - sums[best] / min(rest) if rest else 1.0


ANSWER = [StructField("lang_pred", StringType()), StructField("score", DoubleType())]


def predict(docs: DataFrame, model: Model, margin: float = MARGIN, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``accepted``. Only the text is read for the answer."""
    names = [fresh(docs, n) for n in ("lang_pred", "score", "accepted")]
    schema = StructType([*docs.schema.fields, *(StructField(n, f.dataType) for n, f in zip(names, ANSWER, strict=False))])
    kind = arrow_type(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = model.encoders()
        for part in slices(batches, text):
            told, scores = [], []
            for said in part.column(text).to_pylist():
                plain = cleaned(said) if said is not None and encoders else b""
                best, score = choose(sizes(plain, encoders)) if plain else (None, 0.0)
                told.append(UNDETERMINED if best is None else encoders[best][0])
                scores.append(score)
            columns = [*part.columns, pa.array(told, pa.string()), pa.array(scores, pa.float64())]
            arrays = [c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, kind, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=kind)

    told, score = F.col(names[0]), F.col(names[1])
    return docs.mapInArrow(run, schema).withColumn(names[2], (told != UNDETERMINED) & (score >= margin))
