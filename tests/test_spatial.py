import pytest
from pyspark.sql import functions as F

from migrascope.operators import spatial


@pytest.fixture
def grid(spark):
    rows = []
    for i in range(25):
        x, y = float(i % 5), float(i // 5)
        rows.append((f"{i:02d}", [(x, y), (x + 1, y), (x + 1, y + 1), (x, y + 1), (x, y)], x + y))
    return spark.createDataFrame(
        rows, "tract_geoid string, ring array<struct<x: double, y: double>>, v double"
    )


def test_contiguity_counts(grid):
    kinds = {r.kind: r["count"] for r in spatial.contiguity_edges(grid).groupBy("kind").count().collect()}
    assert kinds == {"queen": 144, "rook": 80}


def test_morans_i_of_a_gradient(grid):
    rook = spatial.contiguity_edges(grid).filter("kind = 'rook'")
    row = spatial.morans_i(grid, rook, "v").first()
    assert (row.n, row.weights) == (25, 80) and row.morans_i == pytest.approx(0.75)


def test_lags_and_islands(spark):
    panel = spark.createDataFrame(
        [("a", 1, 1.0), ("b", 1, 2.0), ("c", 1, 4.0), ("i", 1, 9.0)],
        "tract_geoid string, year int, india_density double",
    )
    edges = spark.createDataFrame(
        [("a", "b", "rook"), ("a", "b", "queen"), ("a", "c", "queen")], "src string, dst string, kind string"
    )
    total = {r.tract_geoid: r for r in spatial.spatial_lag(panel, edges, ["india_density", "absent"]).collect()}
    assert total["a"].india_density_lag_queen == 6.0 and total["a"].india_density_lag_rook == 2.0
    assert total["a"].india_density_lag_same_origin == 6.0 and total["i"].india_density_lag_queen == 0.0
    mean = {r.tract_geoid: r for r in spatial.spatial_lag(panel, edges, ["india_density"], how="mean").collect()}
    assert mean["a"].india_density_lag_queen == 3.0 and mean["i"].india_density_lag_queen is None


def test_points_at_one_place_are_one_site(spark):
    points = spark.range(100).select(
        F.col("id").cast("string").alias("tract_geoid"), F.lit(1.0).alias("latitude"),
        F.when(F.col("id") < 99, 1.0).otherwise(1.01).alias("longitude"),
    )
    edges = sorted((r.src, r.dst, r.dst_members) for r in spatial.distance_band_edges(points, 5.0).collect())
    assert edges == [("0", "99", 1), ("99", "0", 99)]
