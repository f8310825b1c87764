"""The layers from raw tables to matches, as plain functions over DataFrames and folders."""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

from migrascope import dims
from migrascope.operators import clean, matching, models, panel, rollup, serving, spatial
from migrascope.operators.matching import Tastes
from migrascope.sources import readers, writers

log = logging.getLogger(__name__)


def build_county_table(industry_raw: DataFrame, **options) -> DataFrame:
    return rollup.county_wide(rollup.county_rollup(clean.process_cbp(industry_raw, **options)))


def build_businesses(directory_raw: DataFrame, as_of_year: int | None = None, **options) -> DataFrame:
    return clean.tag_cuisines(clean.process_businesses(directory_raw, as_of_year, **options))


def build_features(
    acs: DataFrame,
    county: DataFrame | None = None,
    edges: DataFrame | None = None,
    origins: list[str] | None = None,
    years: list[int] | None = None,
    pad: bool = False,
    calendar: bool = False,
    lag: str = "mean",
) -> DataFrame:
    """Processed survey rows to model features.

    Without industry rows the industry columns are absent; without edges the spatial lags are.
    """
    origins = origins or dims.ORIGINS
    df = panel.require_unique(acs, panel.KEYS)
    if county is not None and not county.isEmpty():
        df = panel.join_industry(df, panel.require_unique(county, ["county_fips", "year"]))
    df = panel.growth_rates(df, origins, pad, calendar)
    df = panel.rolling_means(df, origins)
    df = panel.interaction_features(df, origins)
    df = panel.period_dummies(df, years)
    if edges is not None:
        variables = [*dims.SPATIAL_LAG_VARIABLES, *[f"{o}_density" for o in origins]]
        df = spatial.spatial_lag(df, edges, variables, how=lag, origins=origins)
    return df


def run_etl(
    spark: SparkSession, landing: dict[str, str], out: str, years: list[int], as_of_year: int | None = None
) -> None:
    """Raw folders (``acs``, ``cbp``, ``sba``) to the processed survey, county and business layers."""
    acs = clean.process_acs(readers.read_acs(spark, landing["acs"], years))
    writers.write_by_year(acs, f"{out}/acs")
    if "cbp" in landing:
        raw = readers.read_county_industry(spark, landing["cbp"], years)
        writers.write_by_year(build_county_table(raw), f"{out}/cbp")
    if "sba" in landing:
        raw = readers.read_business_directory(spark, landing["sba"])
        writers.write_businesses(build_businesses(raw, as_of_year), f"{out}/businesses")
        # Read back rather than score every name twice.
        stored = readers.read_table(spark, f"{out}/businesses")
        writers.write_locations(rollup.aggregate_by_location(stored), f"{out}/locations")


def run_features(
    spark: SparkSession, out: str, years: list[int], geometry: DataFrame | None = None,
    has_county: bool = True, origins: list[str] | None = None,
) -> DataFrame:
    acs = readers.read_years(spark, f"{out}/acs", years)
    county = readers.read_years(spark, f"{out}/cbp", years, required=False) if has_county else None
    edges = spatial.contiguity_edges(geometry) if geometry is not None else None
    features = build_features(acs, county, edges, origins, sorted(years))
    writers.write_by_year(features, f"{out}/features")
    return readers.read_table(spark, f"{out}/features")


def run_modeling(
    features: DataFrame,
    path: str,
    horizon: int = 2,
    origins: list[str] | None = None,
    regression: models.TreeSettings = models.REGRESSOR,
    classification: models.TreeSettings = models.CLASSIFIER,
    folds: int = dims.CV_FOLDS,
) -> dict[str, tuple[dict[str, models.TrainedModel], DataFrame]]:
    """Both model families for every origin group; the status tables tell which failed."""
    growth = panel.growth_labels(features, horizon)
    hotspots = panel.hotspot_labels(features, horizon)
    return {
        "regression": models.train_all(
            growth, models.train_regressor, origins, horizon, regression, folds, f"{path}/regression"
        ),
        "classification": models.train_all(
            hotspots, models.train_classifier, origins, horizon, classification, folds,
            f"{path}/classification",
        ),
    }


def run_scoring(features: DataFrame, trained: dict[str, models.TrainedModel], out: str) -> None:
    """Hotspot scores of all trained origin groups in one pass, one folder per group and horizon."""
    if trained:
        writers.write_scores(models.score_all(features, list(trained.values())), f"{out}/hotspot_scores")


def run_stored_scoring(
    spark: SparkSession, out: str, path: str, horizon: int = 2, origins: list[str] | None = None
) -> None:
    """Scores the stored features with stored classifiers, as a session of its own would."""
    features = readers.read_table(spark, f"{out}/features")
    names = origins or dims.ORIGINS
    trained = {o: models.load_trained(spark, f"{path}/classification", o, horizon) for o in names}
    run_scoring(features, trained, out)


def run_matching(
    spark: SparkSession, out: str, centroids: DataFrame, tastes: Tastes | None = None,
    year: int | None = None, horizon: int = 2, **options,
) -> DataFrame:
    """Match the stored scores of one year (the latest by default) and horizon with the stored businesses.

    The stored matches are replaced as a whole.
    """
    scores = readers.read_table(spark, f"{out}/hotspot_scores")
    scores = scores.filter(scores.horizon == horizon)
    if year is None:
        year = scores.agg({"year": "max"}).first()[0]
    points = centroids.select("tract_geoid", "latitude", "longitude")
    hotspots = scores.filter(scores.year == year).join(points, "tract_geoid")
    businesses = readers.read_table(spark, f"{out}/businesses")
    writers.write_matches(matching.match_hotspots(hotspots, businesses, tastes, **options), f"{out}/matches")
    return readers.read_table(spark, f"{out}/matches")


def run_inference(
    spark: SparkSession, out: str, centroids: DataFrame, origin: str, latitude: float, longitude: float,
    horizon: int = 2, tastes: Tastes | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Top hotspots of an origin group and the best businesses around one place."""
    scores = readers.read_hotspot_scores(spark, f"{out}/hotspot_scores", origin, centroids, horizon)
    latest = scores.agg({"year": "max"}).first()[0]
    scores = scores.filter(scores.year == latest)
    businesses = readers.read_table(spark, f"{out}/businesses")
    return (
        serving.predict_hotspots(scores, origin, horizon),
        matching.recommend(businesses, latitude, longitude, origin, tastes=tastes),
    )


def run_growth(
    spark: SparkSession, out: str, path: str, origin: str, horizon: int = 2, tract_geoids: list[str] | DataFrame | None = None
) -> DataFrame:
    """Growth that the stored regressor of an origin group predicts for the stored features, with its interval."""
    features = readers.read_table(spark, f"{out}/features")
    trained = models.load_trained(spark, f"{path}/regression", origin, horizon)
    return serving.predict_growth(features, models.score_growth(features, trained), origin, horizon, tract_geoids)
