import random

import numpy as np
import pytest

import __spark_entry__ as entry
import brute
from migrascope.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string"


def got(df):
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in df.select(columns).collect()), key=str)


def run(spark, data, segment=prefix_trie.SEGMENT):
    rows = spark.createDataFrame(data, SCHEMA).repartition(3)
    turns = prefix_trie.turns_of(rows)
    return got(prefix_trie.trie(prefix_trie.rebuilt(turns), turns.select("conv_id").distinct(), segment))


def rows_of(seed, convs=60, longest=12, words=2):
    r = random.Random(seed)
    out = []
    for c in [-9, -5, -4, *range(convs), 1000, 1003]:
        if c % 7 == 3:
            continue
        for t in range(r.randrange(1, longest)):
            said = "opening" if r.random() < 0.7 else r.choice(["é", "b", None, "", "opening more"][: words + 3])
            out.append((c, r.choice([t, t, t, None, 2]), r.choice(["user", "user", "user", None]), said))
    return out + [(None, 0, "user", "no conversation")] + out[:3]


@pytest.mark.parametrize(("seed", "segment"), [(1, 256), (2, 3), (3, 1)])
def test_against_brute_force(spark, seed, segment):
    """Also with segments of a few turns, so that subtrees cross segments."""
    data = rows_of(seed)
    assert run(spark, data, segment) == brute.trie(data)


def test_copies_over_many_ranges(spark):
    data = [(c, t, "user", f"{t}" if t < 3 else f"{c % 4}") for c in range(0, 400, 5) for t in range(2 + c % 3)]
    assert run(spark, data, 2) == brute.trie(data)


def test_long_conversations(spark):
    data = [(c, t, "user", "x" * (t % 4)) for c in (0, 5, 10) for t in range(70 - c)] + [(15, 0, "user", "y" * 2_000_000)]
    assert run(spark, data, 4) == brute.trie(data)


def test_edge_cases(spark):
    assert run(spark, [(None, 0, "user", "x")]) == [] and got(prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns_of(empty := spark.createDataFrame([], SCHEMA))), empty.select("conv_id"))) == []
    alone = next(c for c in range(1, 1000) if c % 5 and brute.zlib.crc32(str(c).encode()) % 9 > 2)
    data = [(alone, 0, None, None), (alone, None, None, None)]  # takes from a conversation that is not there
    found = run(spark, data)
    assert found == brute.trie(data) and len(found) == 1
    rows = spark.createDataFrame([(0, 0, "user", "x", "clash", 1)], SCHEMA + ", letter string, part int")
    turns = prefix_trie.turns_of(rows)
    assert got(prefix_trie.trie(turns, turns.select("conv_id").distinct())) == brute.trie([(0, 0, "user", "x")])


def test_sparse_table():
    r = np.random.default_rng(5)
    values = r.integers(0, 5, 50)
    values[0] = 0
    table = prefix_trie.SparseTable(values)
    at, bound = r.integers(0, 50, 200), r.integers(1, 6, 200)
    for i, b, low, high in zip(at, bound, table.left(at, bound), table.right(at, bound), strict=True):
        assert all(values[low + 1 : high + 1] >= b)
        assert values[low] < b and (high == 49 or values[high + 1] < b) or low == i and values[i] < b
    low = r.integers(0, 50, 100)
    high = r.integers(low, 50)
    assert [values[a : b + 1].min() for a, b in zip(low, high, strict=True)] == table.least(low, high).tolist()


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{entry.ENTRY_FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(entry.queries()["op12_prefix_trie"](spark, entry.ENTRY_FOLDER)) == brute.trie(rows)
