"""Stored layers, requests, and the whole chain on a small made-up country."""

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from migrascope import schemas
from migrascope.operators import models, panel, rollup, serving
from migrascope.plans import layers
from migrascope.sources import readers, writers

YEARS = [2018, 2019, 2020, 2021, 2022]


def test_rewriting_one_year_keeps_the_others(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(2018, 1), (2019, 2)], "year int, v int")
    writers.write_by_year(df, path)
    writers.write_by_year(spark.createDataFrame([(2019, 3)], "year int, v int"), path)
    assert {(r.year, r.v) for r in readers.read_years(spark, path, [2018, 2019, 2030]).collect()} == {(2018, 1), (2019, 3)}
    with pytest.raises(FileNotFoundError):
        readers.read_years(spark, path, [2030])
    empty = readers.read_years(spark, path, [2030], required=False)
    assert empty.count() == 0 and set(empty.columns) == {"year", "v"}


def test_year_and_state_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "acs")
    row = {f.name: ("06037000100" if f.name == "tract_geoid" else 2018) for f in schemas.ACS_RAW.fields}
    df = spark.range(1).select(*[F.lit(v).cast(schemas.ACS_RAW[k].dataType).alias(k) for k, v in row.items()])
    writers.write_by_year(df, path)
    scan = readers.read_acs(spark, path, [2018], ["06", "48"]).select("tract_geoid", "B01003_001E")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(tract_geoid,06)" in plan and "year#" in plan.split("PartitionFilters")[1][:40]
    assert "B25064_001E" not in plan.split("ReadSchema")[1]
    assert scan.count() == 1 and readers.read_acs(spark, path, [2018], ["48"]).count() == 0


def test_county_files_keep_leading_zeros(spark, tmp_path):
    folder = tmp_path / "year=2020"
    folder.mkdir()
    (folder / "c.txt").write_text("FIPSTATE,fipscty,naics,emp_nf,emp,ap,est\n06,037,7225//,G,40,x,4\n1,3,4451//,G,,5,2\n")
    df = readers.read_county_industry(spark, str(tmp_path), [2020])
    got = sorted((r.fipstate, r.fipscty, r.emp, r.ap, r.est, r.year) for r in df.collect())
    assert got == [("06", "037", 40, None, 4, 2020), ("1", "3", None, 5, 2, 2020)]
    county = {r.county_fips: r for r in layers.build_county_table(df).collect()}
    assert county["06037"].food_services_emp == 40 and county["01003"].retail_trade_est == 2
    assert set(county["06037"].asDict()) == {"county_fips", "year", *schemas.county_wide_columns(rollup.INDUSTRY_CATEGORIES)}


def test_directory_json(spark, tmp_path):
    page = {"features": [
        {"attributes": {"BUSINESS_NAME": "A", "STATE": "CA", "LATITUDE": "1.0"}, "geometry": {"x": 2.0, "y": 3.0}},
        {"attributes": {"BUSINESS_NAME": "B", "STATE": "CA", "LATITUDE": "1.0", "LONGITUDE": "4"}},
        {"attributes": {"BUSINESS_NAME": "C", "STATE": "TX"}},
    ]}
    (tmp_path / "p.json").write_text(json.dumps(page, indent=1))
    df = readers.read_business_directory(spark, str(tmp_path), "CA")
    assert sorted((r.BUSINESS_NAME, r.LATITUDE, r.LONGITUDE) for r in df.collect()) == [("A", 3.0, 2.0), ("B", 1.0, 4.0)]
    assert readers.read_business_directory(spark, str(tmp_path)).count() == 3


def test_request_rules(spark):
    df = spark.createDataFrame(
        [("ok", 1.0, 2.0, "india", None, None, None), ("far", 1.0, 2.0, "india", 500.0, 5, None),
         ("nan", float("nan"), 2.0, "india", 5.0, 5, None), ("anon", 1.0, 2.0, None, 5.0, 5, None)],
        schemas.RECOMMENDATION_REQUESTS,
    )
    valid, rejected = serving.split_valid(serving.validate_recommendations(df))
    row = valid.first()
    assert (row.request_id, row.max_distance, row.max_recommendations) == ("ok", 15.0, 10) and valid.count() == 1
    assert {r.request_id: r.reason for r in rejected.collect()} == {
        "far": "max_distance out of range", "nan": "latitude out of range", "anon": "origin_group missing",
    }
    hotspots = spark.createDataFrame([("a", "india", None, None, 0), ("b", "india", 6, 0.1, 5)], schemas.HOTSPOT_REQUESTS)
    assert {r.request_id: r.reason for r in serving.validate_hotspots(hotspots).collect()} == {
        "a": "limit out of range", "b": "horizon out of range",
    }
    growth = spark.createDataFrame([("a", "india", None, None)], schemas.GROWTH_REQUESTS)
    assert serving.validate_growth(growth).first().reason is None


def test_feature_order_and_no_labels():
    columns = ["year_2018", "total_pop", "india_density", "india_density_lag_queen", "median_rent_lag_queen",
               "food_services_est", "income_growth_1yr", "label_india_growth_2yr", "year", "india_growth_1yr"]
    listed = models.feature_columns(columns)
    assert listed == ["total_pop", "india_density", "food_services_est", "income_growth_1yr", "median_rent_lag_queen",
                      "india_growth_1yr", "year_2018", "india_density_lag_queen"]
    assert models.feature_columns(columns, business_last=True)[:3] == ["total_pop", "income_growth_1yr", "india_density"]
    assert len(set(listed)) == len(listed)


@pytest.fixture(scope="module")
def country(spark, tmp_path_factory):
    """40 square tracts in 2 counties x 5 years, industry files and a directory, run through every layer."""
    root = tmp_path_factory.mktemp("country")
    tract = F.concat(F.when(F.col("id") % 2 == 0, "06001").otherwise("06003"), F.lpad(F.col("id").cast("string"), 6, "0"))
    base = spark.range(40).crossJoin(spark.createDataFrame([(y,) for y in YEARS], "year int"))
    acs = base.select(
        tract.alias("tract_geoid"), "year",
        *[
            (F.when(F.lit(f.name == "B01003_001E"), F.lit(2000)).otherwise(F.lit(20))
             + F.pmod(F.xxhash64("id", "year", F.lit(i)), F.lit(200))).cast(f.dataType).alias(f.name)
            for i, f in enumerate(schemas.ACS_RAW.fields[2:])
        ],
    )
    acs.write.partitionBy("year").parquet(str(root / "acs"))
    for y in YEARS:
        folder = root / "cbp" / f"year={y}"
        folder.mkdir(parents=True)
        folder.joinpath("c.txt").write_text("fipstate,fipscty,naics,est,emp,ap\n6,1,722511,5,50,500\n6,3,4451,2,8,80\n")
    features = [
        {"attributes": {"BUSINESS_NAME": n, "NAICS_CODE": "7225", "STATE": "CA", "EMPLOYEES": "3", "YEAR_ESTABLISHED": "2000",
                        "ADDRESS": str(i)}, "geometry": {"x": -120 + i / 100, "y": 37.0}}
        for i, n in enumerate(["Taco Hut", "Curry Point", "Pho Bar", "Plain Shop"] * 5)
    ]
    (root / "sba").mkdir()
    (root / "sba" / "p.json").write_text(json.dumps({"features": features}))
    landing = {k: str(root / k) for k in ("acs", "cbp", "sba")}
    out = str(root / "out")
    layers.run_etl(spark, landing, out, YEARS, as_of_year=2022)
    ring = F.array(*[
        F.struct((F.col("id") % 8 + dx).cast("double").alias("x"), (F.floor(F.col("id") / 8) + dy).cast("double").alias("y"))
        for dx, dy in ((0, 0), (1, 0), (1, 1), (0, 1), (0, 0))
    ])
    geometry = spark.range(40).select(tract.alias("tract_geoid"), ring.alias("ring"))
    return out, layers.run_features(spark, out, YEARS, geometry, origins=["india", "mexico"]), spark.range(40).select(
        tract.alias("tract_geoid"), F.lit(37.0).alias("latitude"), (F.col("id") / 100 - 120).alias("longitude")
    )


def test_stored_features(country):
    _, features, _ = country
    assert features.count() == 200
    expected = {"food_services_est", "india_growth_5yr", "india_density_ma5", "rent_income_interaction", "year_2020",
                "india_density_lag_same_origin", "median_rent_lag_rook", "covid_period", "language_diversity"}
    assert expected <= set(features.columns)
    assert features.filter("food_services_est IS NULL").count() == 0


def test_train_score_match(spark, country, tmp_path):
    out, features, centroids = country
    tiny_r = models.small(models.REGRESSOR, 2, 2)
    tiny_c = models.small(models.CLASSIFIER, 2, 2)
    trained = layers.run_modeling(features, str(tmp_path), 2, ["india", "atlantis"], tiny_r, tiny_c, folds=2)
    for family, (found, status) in trained.items():
        done = {r.origin_group: (r.succeeded, r.error) for r in status.collect()}
        assert done["india"][0] and not done["atlantis"][0] and "label_atlantis" in done["atlantis"][1], family
        assert found["india"].fold_scores.count() == 2
    regressor = trained["regression"][0]["india"]
    shares = models.feature_importance(regressor.model)
    assert sum(s for _, s in shares) == pytest.approx(1.0) and len(shares) == len(regressor.inputs)
    back = models.load_model(str(tmp_path / "regression"), "india", 2)
    again = models.score_growth(features, replace(regressor, model=back))
    assert again.exceptAll(models.score_growth(features, regressor)).count() == 0
    labelled = panel.growth_labels(features, 2)
    evaluated = models.evaluate_regressor(labelled, regressor)
    assert evaluated["error_by_population"].count() == 5 and evaluated["metrics"].first().n == 120

    grown = layers.run_growth(spark, out, str(tmp_path), "india").collect()
    predicted = {(r.tract_geoid, r.year): r.predicted_growth for r in again.collect()}
    assert len(grown) == 200 and all(r.predicted_growth == predicted[r.tract_geoid, r.year] for r in grown)
    assert all(r.confidence_interval.upper - r.confidence_interval.lower == pytest.approx(10) for r in grown)

    classifier = trained["classification"][0]["india"]
    loaded = models.CalibratedClassifier.load(str(tmp_path / "classification/origin=india/horizon=2/calibrated"))
    scored = models.score_hotspots(features, classifier, threshold=0.1)
    assert scored.filter("hotspot_prob < 0 OR hotspot_prob > 1").count() == 0
    assert scored.filter("(hotspot_prob >= 0.1) <> (hotspot_pred = 1)").count() == 0
    reloaded = models.score_hotspots(features, replace(classifier, calibrated=loaded), threshold=0.1)
    assert reloaded.exceptAll(scored).count() == 0
    raw = classifier.calibrated.transform(panel.sanitize(features, classifier.inputs)).select("raw_0", "calibrated_0")
    pairs = sorted((r.raw_0, r.calibrated_0) for r in raw.collect())
    assert all(a[1] <= b[1] + 1e-12 for a, b in zip(pairs, pairs[1:]))
    checked = models.evaluate_classifier(panel.hotspot_labels(features, 2), classifier)
    assert checked["confusion_matrix"].agg(F.sum("n")).first()[0] == 120
    assert 0 <= checked["brier_score"].first().brier_score <= 1

    layers.run_scoring(features, trained["classification"][0], out)
    matches = layers.run_matching(spark, out, centroids, min_probability=-1.0, max_businesses=3)
    assert matches.filter("rank = 1").count() == 31 and set(matches.columns) >= {"origin_group", "distance_km", "cuisine_score"}
    top, nearby = layers.run_inference(spark, out, centroids, "india", 37.0, -119.95)
    assert top.columns[:3] == ["tract_geoid", "latitude", "longitude"] and nearby.first().business_name == "Curry Point"
