"""Neighbouring tracts and what they say about each other."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import values
from migrascope.operators.proximity import DIGITS, located, pairs_within
from migrascope.operators.skew import split_join
from migrascope.session import ensure_checkpoint_dir

SNAP_DIGITS = 7  # vertices closer than this many decimals are the same corner


def contiguity_edges(geometry: DataFrame, id_col: str = "tract_geoid") -> DataFrame:
    """Edges (src, dst, kind): queen neighbours share a corner, rook neighbours a side.

    ``geometry`` has one ring of points per tract (``ring``) or all rings of its parts and holes
    (``rings``). Corners and sides are join keys, so no polygon is compared with one it does not
    touch. A corner used by very many polygons is split over tasks.
    """
    rings = F.col("rings") if "rings" in geometry.columns else F.array("ring")
    parted = geometry.select(F.col(id_col).alias("id"), F.explode(rings).alias("ring"))
    rounded = parted.select("id", F.transform("ring", _corner).alias("ring"))
    sides = F.transform(
        F.filter(F.sequence(F.lit(0), F.size("ring")), lambda i: i < F.size("ring") - 1),
        lambda i: F.array_sort(F.array(F.get("ring", i), F.get("ring", i + 1))),
    )
    corners = F.transform("ring", lambda c: F.struct(F.lit("queen").alias("kind"), F.array(c).alias("part")))
    sides = F.transform(
        F.filter(sides, lambda s: s[0] != s[1]), lambda s: F.struct(F.lit("rook").alias("kind"), s.alias("part"))
    )
    ensure_checkpoint_dir(geometry.sparkSession)
    parts = rounded.select("id", F.inline(F.concat(corners, sides))).distinct().checkpoint()
    left, right = parts.withColumnRenamed("id", "a"), parts.withColumnRenamed("id", "b")
    met = split_join(left, right, ["kind", "part"], "a", "b").filter("a < b").select("kind", "a", "b").distinct()
    both = F.array(
        F.struct(F.col("a").alias("src"), F.col("b").alias("dst")),
        F.struct(F.col("b").alias("src"), F.col("a").alias("dst")),
    )
    return met.select(F.inline(both), "kind")


def _corner(point):
    return F.struct(F.round(point["x"], SNAP_DIGITS).alias("x"), F.round(point["y"], SNAP_DIGITS).alias("y"))


def point_sites(points: DataFrame, id_col: str = "tract_geoid") -> DataFrame:
    """One row per coordinate: the smallest id stands for all points there, ``members`` counts them."""
    return located(points).groupBy("latitude", "longitude").agg(
        F.min(id_col).alias("site"), F.count(F.lit(1)).alias("members")
    )


def distance_band_edges(
    points: DataFrame, radius_km: float = dims.DISTANCE_BAND_KM, id_col: str = "tract_geoid"
) -> DataFrame:
    """Edges (src, dst, dst_members, distance_km) between distinct sites in the distance band.

    Points at the same coordinates are one site, so a crowd at one place adds no pairs.
    ``distance_band_lag`` gives each point its neighbours, those at its own place included.
    """
    sites = point_sites(points, id_col)
    left = sites.select(F.col("site").alias("src"), "latitude", "longitude")
    right = sites.select(
        F.col("site").alias("dst"),
        F.col("members").alias("dst_members"),
        F.col("latitude").alias("place_latitude"),
        F.col("longitude").alias("place_longitude"),
    )
    pairs = pairs_within(left, right, radius_km, "src", "dst").filter("src <> dst")
    return pairs.select("src", "dst", "dst_members", F.round("distance_km", DIGITS).alias("distance_km"))


def distance_band_lag(
    points: DataFrame,
    radius_km: float = dims.DISTANCE_BAND_KM,
    variables: list[str] | None = None,
    id_col: str = "tract_geoid",
) -> DataFrame:
    """Per point: ``neighbours`` in the distance band and, as ``{variable}_band``, the sum over them.

    Points at the same coordinates are neighbours too. Points are summed per coordinate, the sums
    go over pairs of coordinates, and each point takes its own share out again, so a crowd at one
    place costs a row, not its square. A point without coordinates has no neighbours.
    """
    variables = variables or []
    known = {v: F.coalesce(F.col(v).cast("double"), F.lit(0.0)) for v in variables}
    ensure_checkpoint_dir(points.sparkSession)
    sites = (
        located(points)
        .groupBy("latitude", "longitude")
        .agg(
            F.count(F.lit(1)).alias("members"),
            *[F.sum(c).alias(f"__{v}") for v, c in known.items()],
        )
        .checkpoint()
    )
    site = F.struct("latitude", "longitude")
    left = sites.select("latitude", "longitude", site.alias("src"))
    right = sites.select(
        F.col("latitude").alias("place_latitude"),
        F.col("longitude").alias("place_longitude"),
        site.alias("dst"),
        "members",
        *[f"__{v}" for v in variables],
    )
    pairs = pairs_within(left, right, radius_km, "src", "dst")
    sums = pairs.groupBy("latitude", "longitude").agg(
        F.sum("members").alias("__n"), *[F.sum(f"__{v}").alias(f"__{v}") for v in variables]
    )
    joined = points.join(sums, ["latitude", "longitude"], "left")
    own = [
        F.coalesce(F.col(f"__{v}") - c, F.lit(0.0)).alias(f"{v}_band") for v, c in known.items()
    ]
    return joined.select(
        id_col, *variables, F.coalesce(F.col("__n") - 1, F.lit(0)).alias("neighbours"), *own
    )


def lag_names(variable: str, origins: list[str]) -> dict[str, str]:
    """Output columns of a variable and the kind of neighbour each is taken over."""
    names = {f"{variable}_lag_queen": "queen", f"{variable}_lag_rook": "rook"}
    if "density" in variable and any(origin in variable for origin in origins):
        names[f"{variable}_lag_same_origin"] = "queen"
    return names


def spatial_lag(
    df: DataFrame,
    edges: DataFrame,
    variables: list[str],
    id_col: str = "tract_geoid",
    time_col: str | None = "year",
    how: str = "sum",
    origins: list[str] | None = None,
) -> DataFrame:
    """Sum or mean of each variable over the neighbours in the same year.

    All variables and both kinds of neighbour come out of one join and one aggregation. A row
    whose neighbours have no value gets 0 as a sum and NULL as a mean.
    """
    if how not in ("sum", "mean"):
        raise ValueError(f"how must be sum or mean, not {how!r}")
    variables = [v for v in variables if v in df.columns]
    if not variables:
        return df
    aggregate = F.sum if how == "sum" else F.avg
    moment = [time_col] if time_col else []
    neighbours = df.select(F.col(id_col).alias("dst"), *moment, *variables)
    lags = {}
    for variable in variables:
        for name, kind in lag_names(variable, origins or dims.ORIGINS).items():
            lags[name] = aggregate(F.when(F.col("kind") == kind, F.col(variable).cast("double")))
    summed = (
        edges.join(neighbours, "dst")
        .groupBy(F.col("src").alias(id_col), *moment)
        .agg(*[c.alias(n) for n, c in lags.items()])
    )
    joined = df.join(summed, [id_col, *moment], "left")
    return joined.na.fill(0.0, list(lags)) if how == "sum" else joined


def morans_i(residuals: DataFrame, edges: DataFrame, value: str, id_col: str = "tract_geoid") -> DataFrame:
    """Spatial autocorrelation of one value per tract over the given directed edges."""
    known = residuals.filter(F.col(value).isNotNull()).select(id_col, F.col(value).cast("double"))
    mean = known.agg(F.avg(value)).first()[0]  # one number
    centred = known.select(id_col, (F.col(value) - F.lit(mean).cast("double")).alias("z"))
    around = (
        edges.join(centred.withColumnRenamed(id_col, "dst"), "dst")
        .groupBy(F.col("src").alias(id_col))
        .agg(F.sum("z").alias("lag"), F.count(F.lit(1)).alias("links"))
    )
    joined = centred.join(around, id_col, "left").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("links", F.lit(0))).alias("weights"),
        F.sum(F.col("z") * F.coalesce("lag", F.lit(0.0))).alias("cross"),
        F.sum(F.col("z") * F.col("z")).alias("squares"),
    )
    scale = values.ratio(F.col("n"), F.col("weights"))
    return joined.select(
        F.col("n"), F.col("weights"), (scale * values.ratio(F.col("cross"), F.col("squares"))).alias("morans_i")
    )
