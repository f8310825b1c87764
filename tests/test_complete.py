"""Results are whole: no cap, no layout by position, no stale or mixed folders."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.operators import matching, models, skew, spatial
from migrascope.sources import readers, writers


def places(spark, n):
    return spark.range(n).select(
        F.col("id").cast("string").alias("business_id"),
        (37.0 + F.col("id") / 80.0).alias("latitude"),
        F.lit(-120.0).alias("longitude"),
        F.concat(F.lit("b"), "id").alias("business_name"),
        F.lit("retail_trade").alias("business_category"),
        (F.col("id") % 3).alias("employees"),
        F.lit(7.0).alias("business_age"),
    )


def test_batch_answers_many_recommendations_and_wide_radii(spark):
    businesses = places(spark, 100)
    requests = spark.createDataFrame(
        [("far", 37.0, -120.0, "india", 150.0, 60, None), ("all", 37.0, -120.0, "india", 30_000.0, 100, None)],
        "request_id string, latitude double, longitude double, origin_group string, max_distance double, "
        "max_recommendations int, business_categories array<string>",
    )
    found = matching.recommend_batch(requests, businesses)
    got = {k: [] for k in ("far", "all")}
    for r in found.orderBy("request_id", "rank").collect():
        got[r.request_id].append((r.business_id, r.relevance_score, r.distance_km))
    assert len(got["far"]) == 60 and len(got["all"]) == 100
    for name, radius, k in (("far", 150.0, 60), ("all", 30_000.0, 100)):
        single = matching.recommend(businesses, 37.0, -120.0, "india", radius, k)
        assert got[name] == [(r.business_id, r.relevance_score, r.distance_km) for r in single.collect()]


def test_points_at_one_place_are_neighbours(spark):
    points = spark.createDataFrame(
        [("a", 1.0, 1.0, 2.0), ("b", 1.0, 1.0, 3.0), ("c", 1.0, 1.01, 5.0), ("d", None, 1.0, 7.0), ("e", 9.0, 9.0, 1.0)],
        "tract_geoid string, latitude double, longitude double, v double",
    )
    got = {r.tract_geoid: (r.neighbours, r.v_band) for r in spatial.distance_band_lag(points, 5.0, ["v"]).collect()}
    assert got == {"a": (2, 8.0), "b": (2, 7.0), "c": (2, 5.0), "d": (0, 0.0), "e": (0, 0.0)}


def test_multipart_polygons_touch_through_any_ring(spark):
    square = lambda x, y: [(x, y), (x + 1.0, y), (x + 1.0, y + 1.0), (x, y + 1.0), (x, y)]
    geometry = spark.createDataFrame(
        [("a", [square(0.0, 0.0), square(10.0, 0.0)]), ("b", [square(11.0, 0.0)]), ("c", [square(1.0, 1.0)])],
        "tract_geoid string, rings array<array<struct<x double, y double>>>",
    )
    edges = {(r.src, r.dst, r.kind) for r in spatial.contiguity_edges(geometry).collect()}
    assert {e for e in edges if e[0] == "a"} == {("a", "b", "queen"), ("a", "b", "rook"), ("a", "c", "queen")}


@pytest.mark.parametrize("limit", [0, 100_000])
def test_split_join_beyond_the_broadcast_bound(spark, monkeypatch, limit):
    monkeypatch.setattr(skew, "BROADCAST_KEYS", limit)
    left = spark.range(60).select((F.col("id") % 3).alias("k"), F.col("id").alias("a"))
    right = spark.range(60).select((F.col("id") % 2).alias("k"), F.col("id").alias("b"))
    got = skew.split_join(left, right, ["k"], "a", "b", heavy=50)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, left.join(right, "k").collect()))


def test_county_files_of_different_layouts(spark, tmp_path):
    for year, text in ((2017, "fipstate,fipscty,naics,empflag,emp,ap,est\n01,003,722,A,5,50,2\n"), (2018, "FIPSTATE,FIPSCTY,NAICS,EMP,AP,EST\n01,003,722,60,800,9\n")):
        (tmp_path / f"year={year}").mkdir()
        (tmp_path / f"year={year}" / "part.csv").write_text(text)
    got = {r.year: (r.fipstate, r.est, r.emp, r.ap) for r in readers.read_county_industry(spark, str(tmp_path)).collect()}
    assert got == {2017: ("01", 2, 5, 50), 2018: ("01", 9, 60, 800)}


def test_many_small_files_are_planned_in_one_scan(spark, tmp_path):
    """Headers in other orders, a space in a name, a file without rows, and header words in the middle of a file."""
    for i in range(60):
        head = "FIPSTATE,fipscty,naics,est" if i % 2 else "est,naics,fipscty,fipstate"
        row = f"01,00{i % 10},722,{i}" if i % 2 else f"{i},722,00{i % 10},01"
        (tmp_path / f"part {i}+a.csv").write_text(f"{head}\n{row}\n" if i else f"{head}\n")
    (tmp_path / "odd.csv").write_text("fipscty,fipstate,naics,est\n1,fipstate naics,722,999\n")
    found = readers.layouts(spark, str(tmp_path), ["fipstate", "naics"])
    assert sorted(len(f) for f in found.values()) == [1, 30, 30]
    got = readers.read_county_industry(spark, str(tmp_path)).collect()
    assert sorted(r.est for r in got) == [*range(1, 60), 999] and {r.fipstate for r in got} == {"01", "fipstate naics"}


def test_absent_industry_layer_is_empty(spark, tmp_path):
    path = str(tmp_path / "none")
    got = readers.read_years(spark, path, [2018], required=False)
    assert got.count() == 0 and got.columns == ["county_fips", "year"]
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        readers.read_years(spark, path, [2018])


def test_horizons_live_side_by_side_and_matches_are_replaced(spark, tmp_path):
    scores = spark.createDataFrame(
        [("t1", 2020, 0.9, 1, "india", 2)], "tract_geoid string, year int, hotspot_prob double, hotspot_pred int, origin_group string, horizon int"
    )
    path = str(tmp_path / "scores")
    writers.write_scores(scores, path)
    writers.write_scores(scores.withColumns({"horizon": F.lit(5), "hotspot_prob": F.lit(0.1)}), path)
    points = spark.createDataFrame([("t1", 1.0, 1.0)], "tract_geoid string, latitude double, longitude double")
    for horizon, prob in ((2, 0.9), (5, 0.1)):
        rows = readers.read_hotspot_scores(spark, path, "india", points, horizon).collect()
        assert [(r.horizon, r.hotspot_prob) for r in rows] == [(horizon, prob)]
    matches = str(tmp_path / "matches")
    both = spark.createDataFrame([("t1", "india"), ("t1", "peru")], "tract_geoid string, origin_group string")
    writers.write_matches(both, matches)
    writers.write_matches(both.filter("origin_group = 'india'"), matches)
    assert [r.origin_group for r in spark.read.parquet(matches).collect()] == ["india"]


@pytest.fixture(scope="module")
def trained(spark):
    columns = ["total_pop", "india_density", "median_rent"]
    rows = spark.range(240).select(
        F.col("id").cast("string").alias("tract_geoid"),
        F.lit(2018).alias("year"),
        *[(F.xxhash64("id", F.lit(i)) % 100).cast("double").alias(c) for i, c in enumerate(columns)],
    )
    growth = F.col("india_density") * 3 + F.col("median_rent") * 0.01
    labelled = rows.withColumn("label_india_growth_2yr", growth).withColumn("label_india_hotspot_2yr", (growth > 0).cast("int"))
    return labelled


def test_permutation_importance_covers_all_rows(spark, trained):
    frame = trained.withColumn("target", F.col("label_india_growth_2yr"))
    inputs = ["india_density", "median_rent", "total_pop"]
    model = models.regressor(inputs, models.small(models.REGRESSOR, trees=10, depth=3)).fit(frame)
    error = lambda: F.abs(F.col("target") - F.col("prediction"))
    got = {r.feature: r.importance for r in models.permutation_importance(frame, model, error, "tract_geoid").collect()}
    assert set(got) == set(inputs) and max(got, key=got.get) == "india_density"
    assert abs(got["total_pop"]) < got["india_density"] / 10


def test_stored_classifier_scores_as_the_one_in_memory(spark, trained, tmp_path):
    from migrascope.operators.panel import hotspot_label

    label = hotspot_label("india", 2)
    labelled = trained.withColumnRenamed("label_india_hotspot_2yr", label) if label not in trained.columns else trained
    small = models.small(models.CLASSIFIER, trees=2)
    model = models.train_classifier(labelled, "india", 2, small, folds=2)
    models.save_trained(model, str(tmp_path))
    loaded = models.load_trained(spark, str(tmp_path), "india", 2)
    assert loaded.inputs == model.inputs and loaded.fold_scores.count() == 2
    one = models.score_hotspots(trained, model).select("tract_geoid", "year", "hotspot_prob", "hotspot_pred", "origin_group", "horizon")
    both = models.score_all(trained, [loaded, replace(loaded, horizon=5)])
    for horizon in (2, 5):
        own = both.filter(F.col("horizon") == horizon).withColumn("horizon", F.lit(2)).select(*one.columns)
        assert own.exceptAll(one).count() == 0 and own.count() == 240


def test_default_settings_follow_the_family(spark, trained, monkeypatch):
    seen = []

    def fake(labelled, origin, horizon, settings, folds):
        seen.append(settings)
        raise ValueError("x" * 2000)

    monkeypatch.setattr(models, "train_regressor", fake)
    _, status = models.train_all(trained, models.train_regressor, ["india"])
    assert seen == [models.REGRESSOR] and len(status.first().error) > 2000
    assert dims.CV_FOLDS == 5
