"""Points within a radius of other points, and the best-ranked few of them.

Both operators bucket points into the grid of ``functions.geo`` and join on (band, cell), then
check the exact distance. Points with a NULL or NaN coordinate never match.

``top_places`` must not touch every pair in a crowded cell. It uses three facts, all exact:

* places at the same coordinates are equally far from anything, so only the best ``max_k`` of
  each coordinate can ever be chosen; the same coordinate is looked up once;
* the score does not depend on the spot, so once ``k`` places of score ``s`` or better are sure to
  lie within distance ``d`` of every spot in a box, places with a lower score, or with score ``s``
  but farther than ``d``, are out for the whole box;
* such boxes can be compared by counts and extents alone, and split further only where the
  surviving pairs of boxes still hold too many pairs of points.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from migrascope.dims import EARTH_RADIUS_KM
from migrascope.functions import geo
from migrascope.operators.skew import HEAVY_KEY_PAIRS, split_join
from migrascope.session import ensure_checkpoint_dir

DIGITS = 6  # scores and distances are ranked and reported to this many decimals
FANOUT = 8  # boxes per side when a box is split; a power of two keeps boxes exactly nested
PLACES_PER_TASK = 50_000  # places whose offers one task sorts at once
MAX_LEVEL = 12  # boxes are then smaller than the spacing of coordinates: each holds one coordinate
TIE_SLACK_KM = 2 * 10.0**-DIGITS  # distances this close may round to the same value
LOOKUP = ["taste", "grid_km", "radius_km", "k", "latitude", "longitude"]
BOX_KEYS = ["taste", "grid_km", "radius_km", "k"]


def located(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    known = F.lit(True)
    for c in (lat, lon):
        known = known & F.col(c).isNotNull() & ~F.isnan(c)
    return df.filter(known)


def pairs_within(
    left: DataFrame,
    right: DataFrame,
    radius_km: float,
    left_id: str,
    right_id: str,
    heavy: int = HEAVY_KEY_PAIRS,
) -> DataFrame:
    """All (left, right) pairs at most ``radius_km`` apart, with ``distance_km``.

    Coordinates are ``latitude, longitude`` on the left and ``place_latitude, place_longitude``
    on the right. Each pair appears once, because a right point has exactly one cell.
    """
    radius = F.lit(float(radius_km))
    near = _nearby_cells(located(left).withColumn("grid_km", radius)).drop("grid_km")
    band = geo.band_of(F.col("place_latitude"), radius)
    keyed = located(right, "place_latitude", "place_longitude").select(
        "*",
        band.alias("band"),
        geo.cell_of(F.col("place_longitude"), geo.cells_in_band(band, radius)).alias("cell"),
    )
    joined = split_join(near, keyed, ["band", "cell"], left_id, right_id, heavy)
    return joined.withColumn("distance_km", _distance()).filter(F.col("distance_km") <= radius).drop(
        "band", "cell"
    )


def top_places(
    spots: DataFrame,
    places: DataFrame,
    grid_sizes: list[float],
    max_k: int,
    heavy: int = HEAVY_KEY_PAIRS,
) -> DataFrame:
    """The ``k`` best places within ``radius_km`` of each spot: score desc, distance asc, id asc.

    ``spots``: taste, latitude, longitude, radius_km, k (at most ``max_k``) and grid_km, one of
    ``grid_sizes`` and at least radius_km. ``places``: place_id, place_latitude, place_longitude,
    ``offers``, an array of structs that begin with taste and score, and any columns to carry
    along. A place is compared with the spots of the tastes it has an offer for.

    Returns one row per distinct spot (the ``LOOKUP`` columns) and chosen place with the place's
    columns, ``distance_km`` and ``rank``; join it back to the spots on ``LOOKUP``.
    """
    lookups = located(spots).select(*LOOKUP).distinct()
    known = located(places, "place_latitude", "place_longitude")
    near = _nearby_cells(lookups)
    sites = _in_grid(_best_per_coordinate(known, max_k), grid_sizes)
    carried = [c for c in sites.columns if c not in ("taste", "grid_km", "band", "cell")]
    pairs = _pruned_pairs(lookups, near, sites, heavy)
    ranked = Window.partitionBy(*LOOKUP).orderBy(F.desc("score"), "distance_km", "place_id")
    # A degree of latitude alone may already be too far; that is cheaper to see than the distance.
    apart = F.radians(F.abs(F.col("place_latitude") - F.col("latitude"))) * EARTH_RADIUS_KM
    return (
        pairs.filter(apart <= F.col("radius_km") + geo.BOUND_SLACK_KM)
        .withColumn("exact_km", _distance())
        .filter(F.col("exact_km") <= F.col("radius_km"))
        .withColumn("distance_km", F.round("exact_km", DIGITS))
        .withColumn("rank", F.row_number().over(ranked))
        .filter(F.col("rank") <= max_k)
        .filter(F.col("rank") <= F.col("k"))
        .select(*LOOKUP, *carried, "distance_km", "rank")
    )


def _nearby_cells(points: DataFrame) -> DataFrame:
    """One row per point and grid cell (band, cell) that can hold something within ``grid_km``."""
    size = F.col("grid_km")
    here = geo.band_of(F.col("latitude"), size)
    banded = points.select("*", F.explode_outer(F.array(here - 1, here, here + 1)).alias("band"))
    counted = banded.withColumn("__n", geo.cells_in_band(F.col("band"), size))
    placed = counted.withColumn("__own", geo.cell_of(F.col("longitude"), F.col("__n")))
    n, own = F.col("__n"), F.col("__own")
    cells = F.array_distinct(F.array(F.pmod(own - 1, n), own, F.pmod(own + 1, n)))
    return placed.select(*points.columns, "band", F.explode_outer(cells).alias("cell"))


def _distance() -> Column:
    return geo.haversine_km(
        F.col("latitude"), F.col("longitude"), F.col("place_latitude"), F.col("place_longitude")
    )


def _best_per_coordinate(places: DataFrame, max_k: int) -> DataFrame:
    """The best ``max_k`` places of each coordinate and taste.

    Spark prunes each task to ``max_k`` rows per coordinate before the shuffle. For that a task sorts
    its offers, so the places are spread first: few files or row groups make few and large tasks.
    """
    places = _spread(places)
    best = Window.partitionBy("taste", "place_latitude", "place_longitude").orderBy(
        F.desc("score"), "place_id"
    )
    # The outer form: for the plain one Spark would push a test of the array's size, and with it
    # all the scoring, a second time into the scan.
    offered = places.select(*[c for c in places.columns if c != "offers"], F.inline_outer("offers"))
    return (
        offered.withColumn("score", F.round("score", DIGITS))
        .withColumn("__n", F.row_number().over(best))
        .filter(F.col("__n") <= max_k)
        .drop("__n")
    )


def _spread(places: DataFrame) -> DataFrame:
    """The places in tasks of about ``PLACES_PER_TASK``, however they were read.

    By id and coordinate: a crowded coordinate is spread as well. Reads the coordinates once more, to count.
    """
    tasks = math.ceil(places.count() / PLACES_PER_TASK)
    if tasks <= 1:
        return places
    return places.repartition(tasks, "place_id", "place_latitude", "place_longitude")


def _in_grid(places: DataFrame, grid_sizes: list[float]) -> DataFrame:
    """Add the grid cell, once per grid size in use."""
    sizes = F.array(*[F.lit(float(s)) for s in grid_sizes])
    sized = places.select("*", F.explode(sizes).alias("grid_km"))
    band = geo.band_of(F.col("place_latitude"), F.col("grid_km"))
    cells = geo.cells_in_band(band, F.col("grid_km"))
    return sized.select(
        "*", band.alias("band"), geo.cell_of(F.col("place_longitude"), cells).alias("cell")
    )


def _box(lat: str, lon: str, scale: int) -> Column:
    """Grid cell cut into scale x scale boxes; scale 1 is the cell itself."""
    size = F.col("grid_km")
    cells = geo.cells_in_band(geo.band_of(F.col(lat), size), size) * scale
    row = F.floor((F.col(lat) + 90.0) / geo.band_height(size) * scale)
    column = F.pmod(F.floor(geo.turn_fraction(F.col(lon)) * cells), cells)
    return F.struct(row.alias("band"), column.alias("cell"))


def _extent(lat: str, lon: str, prefix: str) -> list[Column]:
    """Centre and reach of the points of a box: every point is within ``reach`` km of the centre."""
    turned = geo.turn_fraction(F.col(lon)) * 360.0 - 180.0
    lat_mid, lon_mid = (F.max(lat) + F.min(lat)) / 2, (F.max(turned) + F.min(turned)) / 2
    half_lat, half_lon = (F.max(lat) - F.min(lat)) / 2, (F.max(turned) - F.min(turned)) / 2
    widest = F.cos(F.radians(F.greatest(F.lit(0.0), F.abs(lat_mid) - half_lat)))
    # First along the meridian, then along a parallel: no shorter than the great circle.
    reach = (F.radians(half_lat) + widest * F.radians(half_lon)) * EARTH_RADIUS_KM
    return [
        lat_mid.alias(f"{prefix}_lat"),
        lon_mid.alias(f"{prefix}_lon"),
        reach.alias(f"{prefix}_reach"),
        F.count(F.lit(1)).alias(f"{prefix}_n"),
    ]


def _pruned_pairs(lookups: DataFrame, near: DataFrame, sites: DataFrame, heavy: int) -> DataFrame:
    """Candidate pairs after comparing boxes, split until no pair of boxes is too heavy."""
    ensure_checkpoint_dir(lookups.sparkSession)
    lookups, sites = lookups.checkpoint(), sites.checkpoint()
    own_cell = _box("latitude", "longitude", 1).alias("l_box")
    keep = near.select(*BOX_KEYS, own_cell, F.struct("band", "cell").alias("p_box")).distinct()
    scale, place_keys = 1, ["taste", "grid_km", "p_box"]
    for _ in range(MAX_LEVEL):
        parents = (_box("latitude", "longitude", scale), _box("place_latitude", "place_longitude", scale))
        scale *= FANOUT
        l_boxes = lookups.groupBy(
            *BOX_KEYS,
            parents[0].alias("l_box"),
            _box("latitude", "longitude", scale).alias("l_child"),
        ).agg(*_extent("latitude", "longitude", "l"))
        p_boxes = sites.groupBy(
            "taste", "grid_km", "score",
            parents[1].alias("p_box"),
            _box("place_latitude", "place_longitude", scale).alias("p_child"),
        ).agg(*_extent("place_latitude", "place_longitude", "p"))
        compared = keep.join(l_boxes, [*BOX_KEYS, "l_box"]).join(p_boxes, place_keys)
        # The surviving boxes decide whether to go on; checkpointing keeps them from being redone.
        keep = _best_boxes(compared).checkpoint()
        if (keep.agg(F.max(F.col("l_n").cast("double") * F.col("p_n"))).first()[0] or 0) <= heavy:
            break
        keep = keep.drop("l_n", "p_n")
        place_keys = ["taste", "grid_km", "p_box", "score"]
    keep = keep.select(*BOX_KEYS, "l_box", "p_box", "score")
    boxed_lookups = lookups.withColumn("l_box", _box("latitude", "longitude", scale))
    boxed_sites = sites.withColumn("p_box", _box("place_latitude", "place_longitude", scale))
    return keep.join(boxed_lookups, [*BOX_KEYS, "l_box"]).join(
        boxed_sites, ["taste", "grid_km", "p_box", "score"]
    )


def _best_boxes(compared: DataFrame) -> DataFrame:
    """Drop pairs of boxes that cannot hold a chosen place.

    In order of score and farthest distance, count places that are within the radius for sure.
    Where the count reaches ``k``, everything strictly worse is out.
    """
    apart = geo.haversine_km(F.col("l_lat"), F.col("l_lon"), F.col("p_lat"), F.col("p_lon"))
    spread = F.col("l_reach") + F.col("p_reach") + F.lit(geo.BOUND_SLACK_KM)
    possible = compared.select(
        "*", (apart - spread).alias("nearest"), (apart + spread).alias("farthest")
    ).filter(F.col("nearest") <= F.col("radius_km"))
    box = [*BOX_KEYS, "l_child"]
    in_order = Window.partitionBy(*box).orderBy(F.desc("score"), "farthest").rowsBetween(
        Window.unboundedPreceding, 0
    )
    sure = F.sum(F.when(F.col("farthest") <= F.col("radius_km"), F.col("p_n")).otherwise(0))
    worst = F.min(
        F.when(F.col("sure") >= F.col("k"), F.struct((-F.col("score")).alias("s"), F.col("farthest")))
    ).over(Window.partitionBy(*box))
    bounded = possible.withColumn("sure", sure.over(in_order)).withColumn("cut", worst)
    in_reach = F.col("nearest") <= F.col("cut.farthest") + F.lit(TIE_SLACK_KM)
    tied = (-F.col("score") == F.col("cut.s")) & in_reach
    kept = bounded.filter(F.col("cut").isNull() | (-F.col("score") < F.col("cut.s")) | tied)
    return kept.select(
        *BOX_KEYS, F.col("l_child").alias("l_box"), F.col("p_child").alias("p_box"), "score", "l_n", "p_n"
    )


def within_point(
    places: DataFrame, lat: float, lon: float, radius_km: float,
    lat_col: str = "latitude", lon_col: str = "longitude",
) -> DataFrame:
    """Places at most ``radius_km`` from one point, with ``distance_km``.

    The bounding box comes first: it consists of comparisons the scan can use to skip row groups.
    """
    boxed = located(places, lat_col, lon_col).filter(
        geo.bounding_box(lat, lon, radius_km, F.col(lat_col), F.col(lon_col))
    )
    away = geo.haversine_km(F.lit(float(lat)), F.lit(float(lon)), F.col(lat_col), F.col(lon_col))
    return boxed.withColumn("distance_km", away).filter(F.col("distance_km") <= float(radius_km))
