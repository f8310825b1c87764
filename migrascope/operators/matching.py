"""Businesses near hotspots and users, ranked by relevance to an origin group.

Relevance depends on the business and on the group's tastes (its preferred categories and its
cuisine), not on the group itself. Groups with equal tastes share one search.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.operators.proximity import DIGITS, LOOKUP, top_places, within_point

DETAILS = ["business_name", "business_category", "employees", "business_age"]
CONTACT = ["address", "phone"]
GRID_SIZES_KM = [25_600.0 / 2**i for i in range(18)]  # more than half way round the earth down to 0.2 km


@dataclass(frozen=True)
class Tastes:
    """Preferred categories and cuisine of each origin group."""

    preferences: dict[str, list[str]] = field(default_factory=lambda: dict(dims.ORIGIN_PREFERENCES))
    cuisines: dict[str, str] = field(default_factory=lambda: dict(dims.ORIGIN_CUISINE))

    def of(self, origin: str) -> tuple[tuple[str, ...], str | None]:
        return tuple(self.preferences.get(origin, [])), self.cuisines.get(origin)

    def numbered(self) -> dict[tuple[tuple[str, ...], str | None], int]:
        """Every distinct taste and its number; 0 is the taste of an unknown group."""
        found = {((), None): 0}
        for origin in sorted({*self.preferences, *self.cuisines}):
            found.setdefault(self.of(origin), len(found))
        return found

    def number(self, origin: Column) -> Column:
        numbers = self.numbered()
        known = [o for o in {**self.preferences, **self.cuisines} if numbers[self.of(o)] != 0]
        chosen = F.lit(0)
        for taste, n in numbers.items():
            members = [o for o in known if self.of(o) == taste]
            if members:
                chosen = F.when(origin.isin(members), n).otherwise(chosen)
        return chosen


def relevance(
    preferred: tuple[str, ...] | list[str], cuisine: str | None, columns: list[str]
) -> Column:
    """Category, cuisine, staff and age terms, capped at 1."""
    score = F.lit(0.0)
    if preferred:
        score = score + _points(F.col("business_category").isin(list(preferred)), dims.SCORE_CATEGORY)
    if cuisine and f"{cuisine}_score" in columns:
        score = score + F.coalesce(F.col(f"{cuisine}_score"), F.lit(0.0)) * dims.SCORE_CUISINE
    score = score + _points(F.col("employees") > 0, dims.SCORE_EMPLOYEES)
    score = score + _points(F.col("business_age") > dims.ESTABLISHED_AFTER_YEARS, dims.SCORE_AGE)
    return F.least(F.lit(1.0), score)


def _points(condition: Column, points: float) -> Column:
    return F.when(condition, F.lit(points)).otherwise(F.lit(0.0))


def score_businesses(businesses: DataFrame, origin: str, tastes: Tastes | None = None) -> DataFrame:
    preferred, cuisine = (tastes or Tastes()).of(origin)
    return businesses.withColumn("relevance_score", relevance(preferred, cuisine, businesses.columns))


def tasted_places(businesses: DataFrame, tastes: Tastes, wanted: list[int] | None = None) -> DataFrame:
    """Businesses with their score for each taste, for ``top_places``. Of what else is known of a business only a
    hash goes through the search (``place_row``); ``with_details`` joins the rest to the chosen ones."""
    columns = businesses.columns
    offers = []
    for (preferred, cuisine), n in tastes.numbered().items():
        if wanted is not None and n not in wanted:
            continue
        own = F.col(f"{cuisine}_score") if cuisine and f"{cuisine}_score" in columns else F.lit(None)
        offers.append(
            F.struct(
                F.lit(n).alias("taste"),
                relevance(preferred, cuisine, columns).alias("score"),
                own.cast("double").alias("cuisine_score"),
            )
        )
    return businesses.select(
        F.col("business_id").alias("place_id"),
        F.col("latitude").alias("place_latitude"),
        F.col("longitude").alias("place_longitude"),
        _row_hash(businesses).alias("place_row"),
        F.array(*offers).alias("offers"),
    )


def _row_hash(businesses: DataFrame) -> Column:
    """Tells rows of one business id apart, should there be several."""
    known = [c for c in (*DETAILS, *CONTACT) if c in businesses.columns]
    return F.xxhash64("latitude", "longitude", *known)


def with_details(best: DataFrame, businesses: DataFrame) -> DataFrame:
    """Chosen places with name, category and contact of their business."""
    extra = [c for c in (*DETAILS, *CONTACT) if c in businesses.columns]
    rows = businesses.select(F.col("business_id").alias("__id"), _row_hash(businesses).alias("__row"), *extra)
    # Spread by the key before rows are made distinct: a task of the scan would sort all it reads.
    rows = rows.repartition("__id", "__row").dropDuplicates(["__id", "__row"])
    same = F.col("place_id").eqNullSafe(F.col("__id")) & (F.col("place_row") == F.col("__row"))
    return best.join(rows, same).drop("__id", "__row", "place_row")


def match_hotspots(
    hotspots: DataFrame,
    businesses: DataFrame,
    tastes: Tastes | None = None,
    origins: list[str] | None = None,
    max_distance: float = dims.MATCH_RADIUS_KM,
    max_businesses: int = dims.MATCH_TOP_K,
    min_probability: float = 0.5,
    **limits,
) -> DataFrame:
    """The best businesses around every likely hotspot, for all origin groups in one plan.

    ``hotspots``: tract_geoid, latitude, longitude, origin_group, hotspot_prob. ``origins`` limits
    the run to some groups.
    """
    tastes = tastes or Tastes()
    spots = hotspots.filter(F.col("hotspot_prob") > min_probability)
    wanted = None
    if origins is not None:
        spots = spots.filter(F.col("origin_group").isin(origins))
        wanted = [tastes.numbered()[tastes.of(o)] for o in origins]
    spots = spots.select(
        "tract_geoid",
        "latitude",
        "longitude",
        "origin_group",
        "hotspot_prob",
        tastes.number(F.col("origin_group")).alias("taste"),
        F.lit(float(max_distance)).alias("grid_km"),
        F.lit(float(max_distance)).alias("radius_km"),
        F.lit(max_businesses).alias("k"),
    )
    places = tasted_places(businesses, tastes, wanted)
    best = top_places(spots, places, [float(max_distance)], max_businesses, **limits)
    return spots.join(with_details(best, businesses), LOOKUP).select(
        "tract_geoid",
        F.col("latitude").alias("hotspot_latitude"),
        F.col("longitude").alias("hotspot_longitude"),
        F.col("hotspot_prob").alias("hotspot_probability"),
        F.col("place_id").alias("business_id"),
        "business_name",
        "business_category",
        F.col("place_latitude").alias("business_latitude"),
        F.col("place_longitude").alias("business_longitude"),
        "distance_km",
        F.col("score").alias("relevance_score"),
        F.col("employees").alias("business_employees"),
        "business_age",
        "origin_group",
        "cuisine_score",
        "rank",
    )


def hotspot_coverage(
    hotspots: DataFrame,
    businesses: DataFrame,
    max_distance: float = dims.MATCH_RADIUS_KM,
    min_probability: float = 0.5,
) -> DataFrame:
    """Share of likely hotspots with at least one business in reach."""
    spots = hotspots.filter(F.col("hotspot_prob") > min_probability).select(
        "latitude",
        "longitude",
        F.lit(0).alias("taste"),
        F.lit(float(max_distance)).alias("grid_km"),
        F.lit(float(max_distance)).alias("radius_km"),
        F.lit(1).alias("k"),
    )
    only = F.struct(F.lit(0).alias("taste"), F.lit(0.0).alias("score"))
    places = businesses.select(
        F.col("business_id").alias("place_id"),
        F.col("latitude").alias("place_latitude"),
        F.col("longitude").alias("place_longitude"),
        F.array(only).alias("offers"),
    )
    nearest = top_places(spots, places, [float(max_distance)], 1).select(*LOOKUP, "place_id")
    joined = spots.join(nearest, LOOKUP, "left")
    return joined.agg(
        F.count(F.lit(1)).alias("hotspots"),
        F.count("place_id").alias("covered"),
        F.avg(F.col("place_id").isNotNull().cast("double")).alias("coverage"),
    )


def _recommendation(
    name, category, lat, lon, distance, score, employees, age, cuisine, address, phone
) -> list[Column]:
    return [
        name.alias("business_name"),
        category.alias("business_category"),
        lat.alias("latitude"),
        lon.alias("longitude"),
        distance.alias("distance_km"),
        score.alias("relevance_score"),
        F.coalesce(employees.cast("int"), F.lit(0)).alias("employees"),
        F.coalesce(age.cast("double"), F.lit(0.0)).alias("business_age"),
        cuisine.cast("double").alias("cuisine_score"),
        address.cast("string").alias("address"),
        phone.cast("string").alias("phone"),
    ]


def recommend(
    businesses: DataFrame,
    latitude: float,
    longitude: float,
    origin_group: str,
    max_distance: float = dims.RECOMMEND_RADIUS_KM,
    max_recommendations: int = dims.RECOMMEND_TOP_K,
    business_categories: list[str] | None = None,
    filter_before_topk: bool = False,
    tastes: Tastes | None = None,
) -> DataFrame:
    """The best businesses near one user. By default categories are filtered after the cut to k."""
    tastes = tastes or Tastes()
    cuisine = tastes.of(origin_group)[1]
    near = within_point(businesses, latitude, longitude, max_distance)
    scored = score_businesses(near, origin_group, tastes).select(
        "*",
        F.round("relevance_score", DIGITS).alias("__score"),
        F.round("distance_km", DIGITS).alias("__km"),
    )
    in_categories = F.lit(True)
    if business_categories:
        in_categories = F.col("business_category").isin(business_categories)
    if filter_before_topk:
        scored = scored.filter(in_categories)
    best = scored.orderBy(F.desc("__score"), "__km", "business_id").limit(max_recommendations)
    if not filter_before_topk:
        best = best.filter(in_categories)

    def known(column: str | None) -> Column:
        return F.col(column) if column and column in businesses.columns else F.lit(None)

    own = known(f"{cuisine}_score" if cuisine else None)
    return best.select(
        "business_id",
        *_recommendation(
            F.col("business_name"), F.col("business_category"), F.col("latitude"),
            F.col("longitude"), F.col("__km"), F.col("__score"), F.col("employees"),
            F.col("business_age"), own, known("address"), known("phone"),
        ),
        F.lit(float(latitude)).alias("user_latitude"),
        F.lit(float(longitude)).alias("user_longitude"),
        F.lit(origin_group).alias("origin_group"),
    )


def grid_size(radius: Column) -> Column:
    """Smallest grid that holds the radius, so that many radii share few grids."""
    fitting = [F.when(radius <= size, F.lit(size)) for size in reversed(GRID_SIZES_KM)]
    return F.coalesce(*fitting, F.when(radius.isNotNull(), F.lit(GRID_SIZES_KM[0])))


def recommend_batch(
    requests: DataFrame,
    businesses: DataFrame,
    tastes: Tastes | None = None,
    **limits,
) -> DataFrame:
    """``recommend`` for a table of valid requests at once (see ``serving.validate_*``).

    Any radius and any number of recommendations is answered in full.
    """
    tastes = tastes or Tastes()
    spots = requests.select(
        "request_id",
        "latitude",
        "longitude",
        "origin_group",
        "business_categories",
        tastes.number(F.col("origin_group")).alias("taste"),
        grid_size(F.col("max_distance")).alias("grid_km"),
        F.col("max_distance").alias("radius_km"),
        F.col("max_recommendations").alias("k"),
    )
    known_radius = spots.filter("grid_km IS NOT NULL")
    used = known_radius.groupBy("grid_km", "taste").agg(F.max("k").alias("k")).collect()
    sizes = sorted({r.grid_km for r in used})  # at most the grid sizes times the tastes
    places = tasted_places(businesses, tastes, sorted({r.taste for r in used}))
    best = top_places(known_radius, places, sizes, max((r.k or 0 for r in used), default=0), **limits)
    best = with_details(best, businesses)

    def known(column: str) -> Column:
        return F.col(column) if column in best.columns else F.lit(None)

    joined = spots.withColumnRenamed("latitude", "user_latitude").withColumnRenamed(
        "longitude", "user_longitude"
    )
    keys = ["taste", "grid_km", "radius_km", "k", "user_latitude", "user_longitude"]
    found = best.withColumnRenamed("latitude", "user_latitude").withColumnRenamed(
        "longitude", "user_longitude"
    )
    wanted = F.coalesce(F.size("business_categories"), F.lit(0)) <= 0
    chosen = wanted | F.array_contains("business_categories", F.col("business_category"))
    return joined.join(found, keys).filter(chosen).select(
        "request_id",
        F.col("place_id").alias("business_id"),
        *_recommendation(
            F.col("business_name"), F.col("business_category"), F.col("place_latitude"),
            F.col("place_longitude"), F.col("distance_km"), F.col("score"), F.col("employees"),
            F.col("business_age"), F.col("cuisine_score"), known("address"), known("phone"),
        ),
        "user_latitude",
        "user_longitude",
        "origin_group",
        "rank",
    )
