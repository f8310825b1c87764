"""Requests and the responses to them, as table operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migrascope import dims

# --- Fixed values: accepted ranges and defaults of the request fields. ---
HOTSPOT_RANGES = {"horizon": (1, 5), "min_probability": (0.0, 1.0), "limit": (1, 1000)}
HOTSPOT_DEFAULTS = {"horizon": 2, "min_probability": 0.5, "limit": 100}
RECOMMENDATION_RANGES = {
    "latitude": (-90.0, 90.0),
    "longitude": (-180.0, 180.0),
    "max_distance": (0.1, 100.0),
    "max_recommendations": (1, 50),
}
RECOMMENDATION_DEFAULTS = {"max_distance": 15.0, "max_recommendations": 10}
GROWTH_RANGES = {"horizon": (1, 5)}
GROWTH_DEFAULTS = {"horizon": 2}


def validate(
    requests: DataFrame,
    ranges: dict[str, tuple[float, float]],
    defaults: dict[str, float],
    required: tuple[str, ...] = ("origin_group",),
) -> DataFrame:
    """Fill defaults and add ``reason``: the first broken rule, NULL for a valid request."""
    filled = requests.na.fill(defaults)
    rules: list[tuple[Column, str]] = [(F.col(c).isNull(), f"{c} missing") for c in required]
    for column, (low, high) in ranges.items():
        if column not in defaults:
            rules.append((F.col(column).isNull(), f"{column} missing"))
        value = F.col(column)
        bad = ~value.between(low, high)
        if dict(requests.dtypes)[column] in ("double", "float"):
            bad = bad | F.isnan(value)
        rules.append((bad, f"{column} out of range"))
    reason = F.coalesce(*[F.when(broken, name) for broken, name in rules])
    return filled.withColumn("reason", reason)


def validate_recommendations(requests: DataFrame) -> DataFrame:
    return validate(requests, RECOMMENDATION_RANGES, RECOMMENDATION_DEFAULTS)


def validate_hotspots(requests: DataFrame) -> DataFrame:
    return validate(requests, HOTSPOT_RANGES, HOTSPOT_DEFAULTS)


def validate_growth(requests: DataFrame) -> DataFrame:
    return validate(requests, GROWTH_RANGES, GROWTH_DEFAULTS)


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid requests, rejected requests with their reason)"""
    return validated.filter("reason IS NULL").drop("reason"), validated.filter("reason IS NOT NULL")


def predict_hotspots(
    scores: DataFrame,
    origin_group: str,
    horizon: int = HOTSPOT_DEFAULTS["horizon"],
    min_probability: float = HOTSPOT_DEFAULTS["min_probability"],
    limit: int = HOTSPOT_DEFAULTS["limit"],
) -> DataFrame:
    """The likeliest hotspots of one origin group; the growth figure is the probability in percent."""
    rows = scores.filter(
        (F.col("origin_group") == origin_group) & (F.col("hotspot_prob") >= min_probability)
    )
    top = rows.orderBy(F.desc("hotspot_prob"), "tract_geoid").limit(limit)
    return top.select(
        "tract_geoid",
        "latitude",
        "longitude",
        F.col("hotspot_prob").alias("hotspot_probability"),
        (F.col("hotspot_prob") * 100).alias("growth_prediction"),
        "origin_group",
        F.lit(horizon).alias("horizon"),
    )


def predict_growth(
    features: DataFrame,
    predictions: DataFrame,
    origin_group: str,
    horizon: int = GROWTH_DEFAULTS["horizon"],
    tract_geoids: list[str] | DataFrame | None = None,
) -> DataFrame:
    """Current density, predicted growth and its interval per tract-year.

    ``predictions``: tract_geoid, year, predicted_growth from the trained regressor. ``tract_geoids``
    may be a list or, when long, a one-column table; none or an empty list means all tracts.
    """
    if isinstance(tract_geoids, DataFrame):
        features = features.join(tract_geoids.select("tract_geoid").distinct(), "tract_geoid", "left_semi")
    elif tract_geoids:
        features = features.filter(F.col("tract_geoid").isin(tract_geoids))
    density = f"{origin_group}_density"
    current = F.col(density) if density in features.columns else F.lit(0.0)
    predicted = F.col("predicted_growth")
    return (
        features.select("tract_geoid", "year", current.alias("current_density"))
        .join(predictions.select("tract_geoid", "year", "predicted_growth"), ["tract_geoid", "year"])
        .select(
            "tract_geoid",
            "year",
            "current_density",
            "predicted_growth",
            F.struct(
                (predicted - dims.INTERVAL_POINTS).alias("lower"),
                (predicted + dims.INTERVAL_POINTS).alias("upper"),
            ).alias("confidence_interval"),
            F.lit(origin_group).alias("origin_group"),
            F.lit(horizon).alias("horizon"),
        )
    )


def score_threshold(scored: DataFrame, prob: Column, threshold: float = 0.5) -> DataFrame:
    """Probability and 0/1 flag keyed by tract and year."""
    return scored.select(
        "tract_geoid",
        "year",
        prob.alias("hotspot_prob"),
        F.when(prob >= threshold, 1).otherwise(0).alias("hotspot_pred"),
    )
