import math

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from migrascope.llm import hnsw

SCHEMA = "vec_id long, embedding array<double>, score string"


def exact(vectors, queries, k):
    """Ids of the k nearest by cosine, ties to the smaller id."""
    out = {}
    ids = sorted(vectors)
    for q in queries:
        own = np.array(vectors[q], float)
        scored = []
        for i in ids:
            if i != q and len(vectors[i]) == len(own):
                v = np.array(vectors[i], float)
                scored.append((-(v * own).sum() / (math.sqrt((v * v).sum()) * math.sqrt((own * own).sum())), i))
        out[q] = [(i, -s) for s, i in sorted(scored)[:k]]
    return out


def search(df, k=5, every=10):
    got = {}
    for r in hnsw.nearest(df, F.col("vec_id") % every == 0, k).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(got[r.query_id])
    return got


@pytest.mark.parametrize(("rows", "shard", "block"), [(900, 200, 7), (900, 4096, 512)])
def test_recall_against_brute_force(spark, monkeypatch, rows, shard, block):
    """Also with several shards, and blocks of queries in several groups."""
    monkeypatch.setattr(hnsw.index, "__defaults__", (shard,))
    monkeypatch.setattr(hnsw.query_blocks, "__defaults__", (block,))
    monkeypatch.setattr(hnsw, "GROUP_BLOCKS", 3)
    rng = np.random.default_rng(rows + shard)
    centres = rng.standard_normal((12, 24))
    vectors = {i: (centres[i % 12] + 0.7 * rng.standard_normal(24)).tolist() for i in range(rows)}
    df = spark.createDataFrame([(i, v, "clash") for i, v in vectors.items()], SCHEMA)
    got, best = search(df), exact(vectors, range(0, rows, 10), 5)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in best[q]}) for q in best)
    assert set(got) == set(best) and hits / (5 * len(best)) >= 0.9
    for q, found in got.items():
        for i, score in found:
            a, b = np.array(vectors[q]), np.array(vectors[i])
            assert score == pytest.approx((a * b).sum() / math.sqrt((a * a).sum() * (b * b).sum()), abs=1e-12)


def test_many_equal_vectors_tie_to_the_smaller_id(spark):
    rows = [(i, [1.0, 2.0, 2.0], None) for i in range(400)] + [(i, [1.0, float(i), 0.0], None) for i in range(400, 430)]
    got = search(spark.createDataFrame(rows, SCHEMA), every=50)
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[350]] == [0, 1, 2, 3, 4]
    assert all(s == pytest.approx(1.0) for _, s in got[0])


def test_vectors_that_take_no_part(spark):
    rows = [
        (0, [1.0, 0.0], None), (1, [0.0, 1.0], None), (2, None, None), (3, [0.0, 0.0], None), (4, [1.0, None], None), (5, [float("nan"), 1.0], None),
        (6, [float("inf"), 1.0], None), (7, [], None), (None, [1.0, 1.0], None), (10, [1.0, 1.0, 1.0], None), (20, None, None), (30, [3.0, 0.0], None), (30, [3.0, 0.0], None),
        (40, [1e300, 1e300], None),
    ]
    got = search(spark.createDataFrame(rows, SCHEMA))
    assert set(got) == {0, 30, 40} and [i for i, _ in got[0]][:1] == [30] and {i for i, _ in got[30]} == {0, 1, 40}
    assert search(spark.createDataFrame([], SCHEMA)) == {}


def test_links_are_flat_arrays_of_bounded_degree():
    rng = np.random.default_rng(4)
    graph = hnsw.build(hnsw.normalised(rng.standard_normal((1500, 16))))
    assert [links.shape[1] for links in graph.levels] == [32, *[16] * (len(graph.levels) - 1)]
    found, _ = graph.search(graph.unit, 32, 0, graph.descend(graph.unit, 0))
    assert (found[:, 0] == np.arange(1500)).mean() > 0.99
    assert hnsw.build(hnsw.normalised(np.ones((1, 3)))).levels[0].shape == (1, 32)


def test_query(spark):
    rows = spark.read.parquet(f"{entry.ENTRY_FOLDER}/embeddings.parquet").collect()
    vectors = {r.vec_id: r.embedding for r in rows}
    best = exact(vectors, [i for i in vectors if i % 50 == 0], 5)
    got = {}
    for r in entry.queries()["op8_nearest_neighbours"](spark, entry.ENTRY_FOLDER).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    hits = sum(len(got[q] & {i for i, _ in best[q]}) for q in best)
    assert set(got) == set(best) and hits >= 0.9 * 5 * len(best)
