import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__ as entry
import brute
from migrascope.llm import graph, jaccard
from migrascope.llm.jaccard import Rule


def corpus(seed, groups=12):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    rows = []
    passage = [rng.choice(words) for _ in range(25)]
    for g in range(groups):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 120))]
        for _ in range(rng.randrange(1, 9)):
            own = list(base)
            for _ in range(rng.randrange(4)):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own += passage
            rows.append((rng.randrange(10**6), " ".join(own)))
    return list(dict(rows).items())


@pytest.mark.parametrize(("k", "percent", "group"), [(4, 85, 1024), (5, 80, 1024), (4, 85, 3), (2, 30, 4)])
def test_equals_all_pairs(spark, monkeypatch, k, percent, group):
    monkeypatch.setattr(jaccard, "GROUP", group)
    rows = corpus(k * percent + group)
    rows += [(-1, None), (-2, ""), (-3, "one two"), (-4, "ONE two"), (-5, "one\n two "), (-6, "x " * 30_000), (-7, "x " * 20_000)]
    frame = spark.createDataFrame([(d, t, 1) for d, t in rows], "doc_id long, text string, cls int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame, Rule(k, percent)).collect()}
    assert got == brute.components(rows, k, percent)


def test_without_first_pass_the_prefix_join_is_still_complete(spark, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(jaccard, "near", lambda classes: classes.sparkSession.createDataFrame([], "a long, b long"))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame, Rule(4, 85)).collect()}
    assert got == brute.components(rows, 4, 85)


def test_repeated_rows_missing_ids_and_empty_table(spark):
    text = "a b c d e f g"
    frame = spark.createDataFrame([(3, text), (3, text), (9, text), (None, text), (None, None)], "doc_id long, text string")
    got = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.join(frame, Rule(4, 85)).collect()), key=str)
    assert got == [(0, 0, None), (0, 4, None), (3, 4, 3), (3, 4, 3), (9, 4, 3)]
    assert jaccard.join(frame.limit(0), Rule(4, 85)).count() == 0


def test_prefix_lengths_hold_for_every_size():
    for percent in (80, 85):
        rule = Rule(4, percent)
        for n in range(1, 300):
            needed = -(-percent * n // 100)
            assert rule.prefix(n) == n - needed + 1 >= 1


def test_components(spark):
    rng = random.Random(6)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1200)]
    parent = {v: v for pair in links for v in pair}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    got = {r.v: r.least for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {v: find(v) for v in parent if any(v in p and p[0] != p[1] for p in links)}
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{entry.ENTRY_FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    got = entry.queries()["op9_ngram_jaccard"](spark, entry.ENTRY_FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute.components(rows, 4, 85)


def test_sets_of_unlike_sizes_link_at_a_low_percentage(spark, docs):
    rows = [(1, " ".join(f"w{i}" for i in range(61))), (2, " ".join(f"w{i}" for i in range(201))), (3, " ".join(f"v{i}" for i in range(61)))]
    got = {r.doc_id: r.component_id for r in jaccard.join(docs(rows), jaccard.Rule(shingle=2, percent=30)).collect()}
    assert got == {1: 1, 2: 1, 3: 3}


def test_hot_shingles_are_spread_over_salts(spark, monkeypatch):
    """With buckets of a few shingles the frequent ones are salted; the groups of classes stay the same."""
    rng = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(240):
        own = list(base)
        for _ in range(rng.randrange(1, 12)):
            own[rng.randrange(60)] = f"v{rng.randrange(200)}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    rule = Rule(4, 85)
    shingles = [s for _, t in rows for s in jaccard.shingle_sets(pa.array([t]), 4)[0].tolist()]
    counts = Counter(shingles).most_common(40)
    order = sorted(range(40), key=lambda i: counts[i][0])
    often, times = (np.array([counts[i][k] for i in order], t) for k, t in ((0, np.uint64), (1, np.int64)))

    def groups(bucket):
        monkeypatch.setattr(jaccard, "BUCKET", bucket)
        members = {}
        for r in jaccard.shared_prefixes(frame, rule, often, times, len(shingles) // 6).collect():
            members.setdefault(r.token, []).append(r.cls)
        assert all(len(m) == len(set(m)) for m in members.values())
        return sorted(sorted(m) for m in members.values() if len(m) > 1)

    assert groups(64) == groups(1 << 18)
    monkeypatch.setattr(jaccard, "BUCKET", 64)
    monkeypatch.setattr(jaccard, "near", lambda classes: classes.sparkSession.createDataFrame([], "a long, b long"))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.join(frame, rule).collect()}
    assert got == brute.components(rows, 4, 85)


def test_a_round_of_stars_is_no_single_plan(spark, monkeypatch, capsys):
    """One plan of both stars reads the links a dozen times, which fills the driver."""
    leaves, written = [], graph.written

    def seen(df, name):
        capsys.readouterr()
        df.explain()
        leaves.append(capsys.readouterr().out.count("Scan "))
        return written(df, name)

    monkeypatch.setattr(graph, "written", seen)
    links = spark.createDataFrame([(i, i + 1) for i in range(9)], "a long, b long")
    assert {r.least for r in graph.components(links).collect()} == {0}
    assert leaves and max(leaves) <= 4
