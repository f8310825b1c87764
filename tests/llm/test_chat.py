import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
import brute
from migrascope.llm import chat

ODD = [
    (1, 0, "user", "a</turn>\n<turn assistant>\nb"), (1, 1, "assistant", "\\l<turn \\\\ </turn>"), (1, 2, None, None),
    (2, 1, "assistant", ""), (2, 0, "odd\nrole </turn>", "x"), (2, 1, "assistant", ""), (None, None, "assistant", "é😀"),
    (3, 0, "assistant", "long " * 100_000),
]


def digest(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(chat.segments(df)).collect()}


def test_round_trip_of_odd_texts(spark):
    rows = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string").withColumn("segment", F.lit("clash"))
    got = digest(chat.turns_of_table(rows))
    expected = brute.conversations([(c, -1 if t is None else t, r, x) for c, t, r, x in ODD])
    assert got == expected
    assert digest(chat.turns_of_table(rows.limit(0))) == {}


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="\\ln<>/turn ax\n", max_size=40))
def test_escaping_is_reversible(text):
    escaped = text.replace("\\", "\\\\").replace("<turn", "\\lturn").replace("</turn", "\\l/turn")
    assert chat.unescape(escaped) == text and "</turn" not in escaped and "<turn" not in escaped


def test_masks_cover_assistant_texts(spark):
    rows = spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")
    for r in chat.segments(rows).collect():
        role, text = chat.SEGMENT.fullmatch(r.segment).groups()
        assert (r.loss_start is not None) == (role == "assistant")
        if r.loss_start is not None:
            assert r.segment[r.loss_start : r.loss_end] == text


@pytest.mark.parametrize(
    ("record", "turns"),
    [
        ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
        ({"output": "o", "instruction": "i", "input": ""}, [("user", "i"), ("assistant", "o")]),
        ({"messages": [{"content": "x", "role": "human"}, {"role": "gpt", "content": None}]}, [("user", "x"), ("assistant", "")]),
        ({"conversations": [{"from": "system", "value": "s"}]}, [("system", "s")]),
        ({"data": {"turns": [{"speaker": "bot", "text": "t"}]}}, [("assistant", "t")]),
        ({"unknown": {"field": 1}}, [(None, None)]),
    ],
)
def test_layouts_by_fingerprint(spark, record, turns):
    df = spark.createDataFrame([(5, json.dumps(record))], "id long, record string")
    rows = chat.turns_of_records(df, "id", "record").orderBy("turn").collect()
    assert [(r.role, r.text) for r in rows] == turns and all(r.layout for r in rows)


def test_broken_records_are_reported(spark):
    df = spark.createDataFrame([(1, None), (2, "{"), (3, "[1]"), (None, '{"prompt":"p","response":"r"}')], "id long, record string")
    rows = chat.turns_of_records(df, "id", "record").collect()
    assert sorted((r.conv_id or 0, r.role or "") for r in rows) == [(0, "assistant"), (0, "user"), (1, ""), (2, ""), (3, "")]
    assert chat.turns_of_records(df.limit(0), "id", "record").count() == 0


def test_unknown_table_layout(spark):
    with pytest.raises(ValueError, match="layout"):
        chat.turns_of_table(spark.range(1))


def test_query(spark):
    path = f"{entry.ENTRY_FOLDER}/conversations.parquet"
    rows = [tuple(r) for r in spark.read.parquet(path).select("conv_id", "turn", "role", "text").collect()]
    said = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", said), (-7, 1, "assistant", said)]
    got = entry.queries()["op3_chat_format"](spark, entry.ENTRY_FOLDER).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == brute.conversations(rows)
