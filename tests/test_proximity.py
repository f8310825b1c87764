import math
import random

import pytest
from pyspark.sql import functions as F

from migrascope.operators import matching, proximity, skew
from migrascope.operators.proximity import pairs_within, top_places, within_point


def km(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.0 * math.asin(math.sqrt(min(1.0, a)))


def test_known_distances(spark):
    d = proximity.geo.haversine_km
    row = spark.range(1).select(
        d(F.lit(37.7749), F.lit(-122.4194), F.lit(37.8044), F.lit(-122.2712)).alias("a"),
        d(F.lit(37.7749), F.lit(-122.4194), F.lit(34.0522), F.lit(-118.2437)).alias("b"),
    ).first()
    assert row.a == pytest.approx(13.429625, abs=1e-5) and row.b == pytest.approx(559.120577, abs=1e-5)


def scattered(seed, n):
    """Points near the poles, across the 180th meridian, around the equator and in one crowd."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        kind = i % 5
        if kind == 0:
            out.append((rng.choice([-1, 1]) * rng.uniform(89.5, 90.0), rng.uniform(-180, 180)))
        elif kind == 1:
            out.append((rng.uniform(-1, 1), rng.choice([-1, 1]) * rng.uniform(179.6, 180.0)))
        elif kind == 2:
            out.append((rng.uniform(-1, 1), rng.uniform(-1, 1)))
        elif kind == 3:
            out.append((round(rng.uniform(40, 40.3), 1), round(rng.uniform(-100.3, -100), 1)))
        else:
            out.append((rng.uniform(60, 60.4), rng.uniform(10, 10.6)))
    return out


def frames(spark, left, right):
    a = spark.createDataFrame(
        [(f"l{i:03d}", *p) for i, p in enumerate(left)] + [("none", None, 1.0)],
        "id string, latitude double, longitude double",
    )
    b = spark.createDataFrame(
        [(f"r{i:03d}", *p) for i, p in enumerate(right)] + [("none", 0.0, None)],
        "place_id string, place_latitude double, place_longitude double",
    )
    return a, b


@pytest.mark.parametrize("radius", [5.0, 50.0, 500.0])
@pytest.mark.parametrize("heavy", [skew.HEAVY_KEY_PAIRS, 4])
def test_pairs_equal_brute_force(spark, radius, heavy):
    left, right = scattered(1, 100), scattered(2, 120)
    a, b = frames(spark, left, right)
    out = [(r.id, r.place_id) for r in pairs_within(a, b, radius, "id", "place_id", heavy).collect()]
    expected = {
        (f"l{i:03d}", f"r{j:03d}")
        for i, p in enumerate(left) for j, q in enumerate(right) if km(*p, *q) <= radius
    }
    assert len(out) == len(set(out)) and set(out) == expected and expected


@pytest.mark.parametrize("heavy", [skew.HEAVY_KEY_PAIRS, 1])
def test_top_places_equal_brute_force(spark, heavy):
    left, right = scattered(3, 60), scattered(4, 250)
    a, b = frames(spark, left, right)
    score = (F.xxhash64("place_id") % 3).cast("double") / 10
    places = b.select(
        "*",
        F.array(
            F.struct(F.lit(7).alias("taste"), score.alias("score"))
        ).alias("offers"),
    )
    radius, k = 40.0, 3
    spots = a.select(
        "*", F.lit(7).alias("taste"), F.lit(radius).alias("radius_km"), F.lit(radius).alias("grid_km"), F.lit(k).alias("k")
    )
    got = top_places(spots, places, [radius], k, heavy).collect()
    scores = {r.place_id: round(r.score, 6) for r in places.select("place_id", score.alias("score")).collect()}
    expected = set()
    for lat, lon in set(left):
        near = [
            (-scores[f"r{j:03d}"], round(km(lat, lon, *q), 6), f"r{j:03d}")
            for j, q in enumerate(right) if km(lat, lon, *q) <= radius
        ]
        expected |= {(lat, lon, pid, rank) for rank, (_, _, pid) in enumerate(sorted(near)[:k], 1)}
    assert {(r.latitude, r.longitude, r.place_id, r["rank"]) for r in got} == expected
    assert len(got) == len(expected)


def test_crowded_coordinate_keeps_only_k_per_site(spark):
    """A third of all places at one point: only k of them go into the join."""
    places = spark.range(3000).select(
        F.col("id").cast("string").alias("place_id"),
        F.when(F.col("id") % 3 == 0, F.lit(40.0)).otherwise(F.lit(40.0) + F.col("id") / 1e5).alias("place_latitude"),
        F.lit(-100.0).alias("place_longitude"),
        F.array(F.struct(F.lit(0).alias("taste"), F.lit(0.5).alias("score"))).alias("offers"),
    )
    kept = proximity._best_per_coordinate(places, 5)
    assert kept.filter("place_latitude = 40.0").count() == 5
    assert kept.count() == 2000 + 5


def test_split_join_is_whole(spark):
    left = spark.range(300).select((F.col("id") % 3 % 2).alias("k"), F.col("id").alias("a"))
    right = spark.range(90).select((F.col("id") % 2).alias("k"), F.col("id").alias("b"))
    split = skew.split_join(left, right, ["k"], "a", "b", heavy=50)
    plain = left.join(right, "k")
    assert split.count() == plain.count()
    assert split.exceptAll(plain.select(split.columns)).count() == 0


@pytest.mark.parametrize("lat, lon", [(0.0, 179.95), (0.0, -179.95), (89.8, 30.0), (40.1, -100.1)])
def test_one_point(spark, lat, lon):
    right = scattered(5, 300)
    _, b = frames(spark, [], right)
    got = {r.place_id for r in within_point(b, lat, lon, 60.0, "place_latitude", "place_longitude").collect()}
    assert got == {f"r{j:03d}" for j, q in enumerate(right) if km(lat, lon, *q) <= 60.0}


@pytest.fixture
def shops(spark):
    return spark.createDataFrame(
        [
            ("b1", "Curry", "food_services", 0.0, 0.01, 15.0, 8.5, 1 / 44),
            ("b2", "Bolt", "other", 0.0, 0.02, 0.0, None, 0.0),
            ("b3", "Bolt", "other", 0.0, 0.02, 0.0, None, 0.0),
            ("b4", "Away", "food_services", 5.0, 5.0, 1.0, 9.0, 0.0),
        ],
        "business_id string, business_name string, business_category string, latitude double, "
        "longitude double, employees double, business_age double, indian_score double",
    )


def test_relevance(shops):
    scored = {r.business_id: r.relevance_score for r in matching.score_businesses(shops, "india").collect()}
    assert scored["b1"] == pytest.approx(0.511364, abs=1e-6) and scored["b2"] == 0.0
    parity = matching.Tastes(cuisines={})
    assert matching.score_businesses(shops, "india", parity).first().relevance_score == pytest.approx(0.5)


def test_match_order_and_ties(spark, shops):
    spots = spark.createDataFrame(
        [("t1", 0.0, 0.0, "india", 0.9), ("t2", 0.0, 0.0, "peru", 0.8), ("t3", 0.0, 0.0, "india", 0.5)],
        "tract_geoid string, latitude double, longitude double, origin_group string, hotspot_prob double",
    )
    out = matching.match_hotspots(spots, shops, max_businesses=2)
    got = sorted((r.tract_geoid, r["rank"], r.business_id, r.cuisine_score) for r in out.collect())
    assert got == [("t1", 1, "b1", 1 / 44), ("t1", 2, "b2", 0.0), ("t2", 1, "b1", None), ("t2", 2, "b2", None)]
    none = matching.match_hotspots(spots, shops.limit(0))
    assert none.count() == 0 and none.columns == out.columns


def test_category_filter_after_the_cut(shops):
    after = matching.recommend(shops, 0.0, 0.0, "india", max_recommendations=1, business_categories=["other"])
    before = matching.recommend(
        shops, 0.0, 0.0, "india", max_recommendations=1, business_categories=["other"], filter_before_topk=True
    )
    assert after.count() == 0 and [r.business_id for r in before.collect()] == ["b2"]


def test_radii_share_grids(spark):
    radii = [0.1, 0.2, 12.5, 12.6, 50.0, 99.0, 100.0]
    df = spark.createDataFrame([(r,) for r in radii], "r double").select("r", matching.grid_size(F.col("r")).alias("g"))
    for row in df.collect():
        assert row.r <= row.g <= max(2 * row.r, matching.GRID_SIZES_KM[-1]) and row.g in matching.GRID_SIZES_KM


def test_match_plan_has_no_nested_loop(spark, shops):
    spots = spark.createDataFrame(
        [("t1", 0.0, 0.0, "india", 0.9)],
        "tract_geoid string, latitude double, longitude double, origin_group string, hotspot_prob double",
    )
    plan = matching.match_hotspots(spots, shops)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "WindowGroupLimit" in plan


def test_places_of_one_task_are_spread_before_they_are_ranked(spark, monkeypatch):
    monkeypatch.setattr(proximity, "PLACES_PER_TASK", 50)
    offer = F.struct(F.lit(0).alias("taste"), (F.col("id") % 7 / 7.0).alias("score"))
    places = spark.range(400).coalesce(1).select(
        F.col("id").cast("string").alias("place_id"),
        F.lit(1.0).alias("place_latitude"),
        F.lit(2.0).alias("place_longitude"),
        F.array(offer).alias("offers"),
    )
    sizes = proximity._spread(places).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) > 4 and sum(r["count"] for r in sizes) == 400
    best = proximity._best_per_coordinate(places, 3).collect()
    expected = sorted((str(i) for i in range(400) if i % 7 == 6))[:3]
    assert sorted(r.place_id for r in best) == expected
    monkeypatch.setattr(proximity, "PLACES_PER_TASK", 400)
    assert proximity._spread(places) is places


def test_details_are_spread_before_they_are_made_distinct(spark, shops, capsys):
    best = shops.select(
        F.col("business_id").alias("place_id"), matching._row_hash(shops).alias("place_row"), F.lit(1).alias("rank")
    )
    out = matching.with_details(best, shops.unionByName(shops))
    assert out.count() == shops.dropDuplicates().count()
    out.explain()
    assert "REPARTITION_BY_COL" in capsys.readouterr().out
