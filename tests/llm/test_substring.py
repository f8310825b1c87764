import random

import pytest

import __spark_entry__ as entry
import brute
from migrascope.llm import substring


def run(frame, length):
    docs = substring.identified(frame)
    return substring.kept(docs, substring.repeated(docs, length), length).collect()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(30 if seed == 1 else 3000)]
    passages = [[rng.choice(words) for _ in range(rng.randrange(10, 60))] for _ in range(6)]
    rows = []
    for i in range(60):
        text = []
        for _ in range(rng.randrange(4)):
            text += [rng.choice(words) for _ in range(rng.randrange(20))]
            text += rng.choice(passages)[: rng.choice([8, 25, 60])]
        rows.append((i * 7 % 61, rng.choice([" ", "\n", " \t "]).join(text)))
    rows += [(200 + i, rows[5][1]) for i in range(20)]  # copies
    rows += [(300, "x " * 500), (301, "x " * 700), (302, None), (303, ""), (304, "é　ß " * 40)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(spark.createDataFrame(rows, "doc_id long, text string"), 15)}
    assert got == brute.repeats(rows, 15)


def test_repeated_rows_and_missing_ids(spark):
    long = " ".join(f"a{i}" for i in range(40))
    rows = [(1, long), (1, long), (2, long), (2, "short"), (None, long)]
    frame = spark.createDataFrame([(d, t, 5) for d, t in rows], "doc_id long, text string, fp int")
    got = sorted(((r.doc_id or 0, r.n_words, r.n_removed) for r in run(frame, 20)))
    assert got == [(0, 40, 0), (1, 40, 0), (1, 40, 0), (2, 1, 0), (2, 40, 40)]
    assert run(frame.limit(0), 20) == []


def test_maximal_spans(spark):
    runs = spark.createDataFrame([(1, 0, 0, 3), (1, 0, 4, 4), (1, 0, 30, 30), (2, 0, 5, 5)], "doc_id long, fp long, lo int, hi int")
    got = {(r.doc_id, r.start, r.end) for r in substring.spans(runs, 10).collect()}
    assert got == {(1, 0, 14), (1, 30, 40), (2, 5, 15)}


def test_query(spark):
    rows = spark.read.parquet(f"{entry.ENTRY_FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = entry.queries()["op6_substring_dedup"](spark, entry.ENTRY_FOLDER).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == brute.repeats([tuple(r) for r in rows], 50)


def test_very_long_texts_and_clashing_columns(spark):
    rng = random.Random(8)
    long = [f"w{rng.randrange(400)}" for _ in range(120_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[500:560])), (3, " ".join(["x"] * 30 + long[90_000:] + ["y"] * 30)), (4, "x" * 300_000)]
    names = ("fp", "lo", "hi", "runs", "spans", "start", "anchor", "n_words", "kept_sha256")
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", *(f"'mine' AS {n}" for n in names))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in run(frame, 50)}
    assert got == brute.repeats(rows, 50) and got[2][1] == 60 and got[3][1] == 30_000
