"""Chat formatting: records of unlike layouts become canonical turns, then one template text.

The layout of a record is told by its schema fingerprint, the hash of its nested field paths. A registry
maps fingerprints to declarative mappings (which paths hold which role); unknown layouts are reported, not
guessed. The template of a turn is

    <turn ROLE>
    TEXT</turn>

Inside role and text a backslash becomes ``\\\\`` and the ``<`` of ``<turn`` and ``</turn`` becomes ``\\l``, in
a role also a line feed becomes ``\\n``; so a control string never occurs inside a text and every text is read
back exactly. The loss mask covers the escaped texts of the assistant. A conversation is the run of its
segments in order, and reading back streams over them, so that memory is bounded by one turn.

Defined cases: null text and null role are empty; a null conversation id is a conversation of its own; turns
sort by number (null first), ties by their content, repeated rows count as often as they occur; an empty
table gives no rows; other columns are left out, also such as clash with result columns.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, LongType, StringType, StructField, StructType

from migrascope.llm.common import arrow_type

LEARNED_ROLE = "assistant"
SEGMENT = re.compile(r"<turn ([^\n]*)\n(.*?)</turn>\n", re.DOTALL)
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Mapping:
    """Where a layout keeps its turns.

    ``single``: (path, role) pairs, one turn each, in order, absent or null ones skipped. ``repeated``: path of
    a list of turns with the names of the fields that hold role and text.
    """

    single: tuple[tuple[str, str], ...] = ()
    repeated: tuple[str, str, str] | None = None


def paths_of(value: object, at: str = "") -> Iterator[str]:
    """Nested field paths of a parsed record; a list adds ``[]``."""
    if isinstance(value, dict):
        for name in value:
            yield from paths_of(value[name], f"{at}.{name}" if at else name)
    elif isinstance(value, list):
        for item in value or [None]:
            yield from paths_of(item, f"{at}[]")
    else:
        yield at


def schema_paths(kind: DataType, at: str = "") -> Iterator[str]:
    """Nested field paths of a table's schema, written as those of a record."""
    if isinstance(kind, StructType):
        for f in kind.fields:
            yield from schema_paths(f.dataType, f"{at}.{f.name}" if at else f.name)
    elif isinstance(kind, ArrayType):
        yield from schema_paths(kind.elementType, f"{at}[]")
    else:
        yield at


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(set(paths))).encode()).hexdigest()[:16]


LAYOUTS: dict[tuple[str, ...], Mapping] = {
    ("prompt", "completion"): Mapping(single=(("prompt", "user"), ("completion", "assistant"))),
    ("prompt", "response"): Mapping(single=(("prompt", "user"), ("response", "assistant"))),
    ("system", "prompt", "response"): Mapping(
        single=(("system", "system"), ("prompt", "user"), ("response", "assistant"))
    ),
    ("instruction", "output"): Mapping(single=(("instruction", "user"), ("output", "assistant"))),
    ("instruction", "input", "output"): Mapping(
        single=(("instruction", "user"), ("input", "user"), ("output", "assistant"))
    ),
    ("messages[].role", "messages[].content"): Mapping(repeated=("messages", "role", "content")),
    ("conversations[].from", "conversations[].value"): Mapping(repeated=("conversations", "from", "value")),
    ("data.turns[].speaker", "data.turns[].text"): Mapping(repeated=("data.turns", "speaker", "text")),
}
REGISTRY = {fingerprint(paths): mapping for paths, mapping in LAYOUTS.items()}
TURN_TABLE = fingerprint(("conv_id", "turn", "role", "text"))

TURNS = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("turn", LongType()),
        StructField("role", StringType()),
        StructField("text", StringType()),
    ]
)


def turns_of_records(
    records: DataFrame, conv_id: str, record: str, registry: dict[str, Mapping] = REGISTRY
) -> DataFrame:
    """Canonical turns of JSON records, with column ``layout``.

    A record that is no JSON object or has an unknown layout gives one row with the fingerprint (or null) and
    no role, so that nothing goes unseen.
    """
    schema = StructType([*TURNS.fields, StructField("layout", StringType())])
    kind = arrow_type(schema)

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[dict] = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                print_, turns = _record_turns(text, registry)
                found = turns if turns is not None else [(None, None)]
                for i, (role, said) in enumerate(found):
                    rows.append({"conv_id": key, "turn": i, "role": role, "text": said, "layout": print_})
            yield pa.RecordBatch.from_pylist(rows, schema=kind)

    picked = records.select(F.col(conv_id).cast("long").alias("conv_id"), F.col(record).cast("string").alias("record"))
    return picked.mapInArrow(convert, schema)


def _record_turns(text: str | None, registry: dict[str, Mapping]) -> tuple[str | None, list | None]:
    try:
        record = json.loads(text) if text is not None else None
    except ValueError:
        record = None
    if not isinstance(record, dict):
        return None, None
    print_ = fingerprint(paths_of(record))
    mapping = registry.get(print_)
    if mapping is None:
        return print_, None
    if mapping.repeated:
        path, role, said = mapping.repeated
        return print_, [(_role(t.get(role)), _text(t.get(said))) for t in _at(record, path) or []]
    found = [(role, _at(record, path)) for path, role in mapping.single]
    return print_, [(role, _text(value)) for role, value in found if value not in (None, "")]


def _at(record: object, path: str) -> object:
    for name in path.split("."):
        record = record.get(name) if isinstance(record, dict) else None
    return record


def _role(value: object) -> str:
    return ROLE_NAMES.get(str(value), str(value)) if value is not None else ""


def _text(value: object) -> str:
    return "" if value is None else value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)


def turns_of_table(rows: DataFrame) -> DataFrame:
    """Canonical turns of a table that holds a turn a row; its layout is told by its schema's fingerprint."""
    known = rows.select([c for c in rows.columns if c in TURNS.names])
    if fingerprint(schema_paths(known.schema)) != TURN_TABLE:
        raise ValueError(f"no mapping for the layout {rows.columns}")
    return known.select([F.col(f.name).cast(f.dataType) for f in TURNS.fields])


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in ("<turn", "</turn"):
        out = F.replace(out, F.lit(control), F.lit("\\l" + control[1:]))
    return out


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {"l": "<", "n": "\n"}.get(m[1], m[1]), text)


def segments(turns: DataFrame, learned_role: str = LEARNED_ROLE) -> DataFrame:
    """Each turn as template text, with the span [loss_start, loss_end) of the loss mask in it (code points)."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    head = F.concat(F.lit("<turn "), F.replace(escape(role), F.lit("\n"), F.lit("\\n")), F.lit("\n"))
    body = escape(text)
    learned = role == learned_role
    return turns.select(
        "conv_id",
        "turn",
        F.concat(head, body, F.lit("</turn>\n")).alias("segment"),
        F.when(learned, F.length(head)).alias("loss_start"),
        F.when(learned, F.length(head) + F.length(body)).alias("loss_end"),
    )


DIGEST = StructType(
    [
        StructField("conv_id", LongType()),
        StructField("n_turns", LongType()),
        StructField("turns_sha256", StringType()),
        StructField("loss_chars", LongType()),
        StructField("loss_sha256", StringType()),
        StructField("formatted_chars", LongType()),
    ]
)


class _Reader:
    """What one conversation's formatted text says, taken segment by segment."""

    def __init__(self, conv_id: int | None) -> None:
        self.conv_id, self.n, self.loss, self.chars = conv_id, 0, 0, 0
        self.turns, self.learned = hashlib.sha256(), hashlib.sha256()

    def add(self, segment: str, start: int | None, end: int | None) -> None:
        for role, text in SEGMENT.findall(segment):
            self.n += 1
            self.turns.update(f"{unescape(role)}\n{unescape(text)}\n".encode())
        if start is not None:
            plain = unescape(segment[start:end])
            self.loss += len(plain)
            self.learned.update(plain.encode())
        self.chars += len(segment)

    def row(self) -> dict:
        values = (self.conv_id, self.n, self.turns.hexdigest(), self.loss, self.learned.hexdigest(), self.chars)
        return dict(zip(DIGEST.names, values, strict=True))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest of each conversation, parsed from its segments as they stream by in order."""
    kind = arrow_type(DIGEST)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader: _Reader | None = None
        for batch in batches:
            done = []
            for conv_id, *parts in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if reader is None or reader.conv_id != conv_id:
                    if reader is not None:
                        done.append(reader.row())
                    reader = _Reader(conv_id)
                reader.add(*parts)
            yield pa.RecordBatch.from_pylist(done, schema=kind)
        if reader is not None:
            yield pa.RecordBatch.from_pylist([reader.row()], schema=kind)

    ordered = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "segment")
    return ordered.select("conv_id", "segment", "loss_start", "loss_end").mapInArrow(read, DIGEST)
