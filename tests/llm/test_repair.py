import random

import pytest

import __spark_entry__ as entry
import brute
from migrascope.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
ROLES = ["user", "assistant", "system", "tool", "", "ux", "User", None]
TEXTS = ["Yes.", "No", "", " \t\n", "What? ", "Stop!\r", "é…", None, "Yes."]


def rows_of(seed, convs=40, longest=14):
    r = random.Random(seed)
    out = []
    for c in [None, -3, 0, *range(10, convs)]:
        weights = r.choice([(4, 4, 1, 0, 0, 0, 0, 0), (1,) * 8, (5, 0, 1, 0, 0, 0, 0, 0)])
        for t in range(r.randrange(longest)):
            turn = r.choice([t, t, t, t + 2, None, 5])
            out.append((c, turn, r.choices(ROLES, weights)[0], r.choice(TEXTS) or r.choice([None, f"{t}.", f"so {t}"])))
    return out + out[:5]


def got(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def shape(report):
    return {c: (g, b, d, t, i, cost, audit, sha) for c, (g, b, d, t, i, cost, audit, sha) in report.items()}


@pytest.mark.parametrize(("seed", "chunk"), [(1, 8192), (2, 3), (3, 1)])
def test_against_brute_force(spark, seed, chunk):
    """Also with chunks of a few rows, so that costs and states cross chunks and ranges."""
    data = rows_of(seed)
    rows = spark.createDataFrame(data, SCHEMA).repartition(5)
    result = got(repair.repair(repair.damaged(rows), repair.turns_of(rows), chunk))
    assert result == brute.repairs({c for c, *_ in data}, brute.damage(data))


def test_one_long_conversation_in_many_chunks(spark):
    """Runs of one role take a fix-up pass a chunk; rows that must go do not."""
    r = random.Random(7)
    data = [(1, t, "user" if t < 40 else r.choice(["user", "assistant", "tool"]), f"{t}." if t % 9 else f"{t}") for t in range(120)]
    data += [(1, t, "user", "same.") for t in range(120, 200)] + [(1, None, "system", "first.")]
    rows = spark.createDataFrame(data, SCHEMA).repartition(3)
    turns = repair.turns_of(rows)
    assert got(repair.repair(turns, turns, 4)) == brute.repairs({1}, data)


def test_speculation_meets_the_true_costs():
    codes = "u-a-u-a-" * 30
    other = repair.back(repair.END, "ot")
    assert other != repair.END and repair.repaired_left(codes, repair.END, other) is None
    run = "u-" * 41
    left = repair.repaired_left(run, repair.END, other)
    assert left is None or left == repair.backward(run, other)[-1]


def test_edge_cases(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert got(repair.repair(repair.damaged(empty), repair.turns_of(empty))) == {}
    data = [(1, 0, "user", "word " * 200_000 + "."), (2, None, None, None), (2, None, None, None), (3, 9, "system", "x.")]
    rows = spark.createDataFrame([(*d, "a", 1) for d in data], SCHEMA + ", cid string, idx int")
    turns = repair.turns_of(rows)
    result = got(repair.repair(turns, turns))
    assert result == brute.repairs({1, 2, 3}, data)
    assert result[3][6] == "D" and result[2][1] == 2
    gone = next(c for c in range(1000) if not brute.damage([(c, 0, "user", "x.")]))
    rows = spark.createDataFrame([(gone, 0, "user", "x.")], SCHEMA)
    assert got(repair.repair(repair.damaged(rows), repair.turns_of(rows)))[gone][:7] == (0, 0, 0, 0, 0, 0, "")


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{entry.ENTRY_FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    result = got(entry.queries()["op11_structure_repair"](spark, entry.ENTRY_FOLDER))
    assert result == brute.repairs({c for c, *_ in rows}, brute.damage(rows))
