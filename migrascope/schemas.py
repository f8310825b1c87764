"""Column names and types of the storage layers."""

from __future__ import annotations

from pyspark.sql import types as T

from migrascope import dims

STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


def _count_or_median(name: str) -> T.DataType:
    return DOUBLE if name in dims.MEDIAN_COLUMNS else LONG


# Raw survey table: two keys, then one column per survey code.
ACS_RAW = struct(
    tract_geoid=STRING,
    year=INT,
    **{code: _count_or_median(name) for name, code in dims.DEMOGRAPHIC_CODES.items()},
    **{code: LONG for code in dims.LANGUAGE_CODES.values()},
    **{code: LONG for codes in dims.ORIGIN_CODES.values() for code in codes},
)

CBP_RAW = struct(fipstate=STRING, fipscty=STRING, naics=STRING, est=LONG, emp=LONG, ap=LONG)

POINT = struct(x=DOUBLE, y=DOUBLE)
FEATURE = struct(attributes=struct(**{f: STRING for f in dims.DIRECTORY_FIELDS}), geometry=POINT)
DIRECTORY_JSON = struct(features=T.ArrayType(FEATURE))

TRACT_GEOMETRY = struct(tract_geoid=STRING, ring=T.ArrayType(POINT))
TRACT_PARTS = struct(tract_geoid=STRING, rings=T.ArrayType(T.ArrayType(POINT)))
EDGES = struct(src=STRING, dst=STRING, kind=STRING)

HOTSPOT_SCORES = struct(
    tract_geoid=STRING, year=INT, origin_group=STRING, horizon=INT, hotspot_prob=DOUBLE, hotspot_pred=INT
)

RECOMMENDATION_REQUESTS = struct(
    request_id=STRING, latitude=DOUBLE, longitude=DOUBLE, origin_group=STRING, max_distance=DOUBLE,
    max_recommendations=INT, business_categories=T.ArrayType(STRING),
)
HOTSPOT_REQUESTS = struct(
    request_id=STRING, origin_group=STRING, horizon=INT, min_probability=DOUBLE, limit=INT
)
GROWTH_REQUESTS = struct(
    request_id=STRING, origin_group=STRING, horizon=INT, tract_geoids=T.ArrayType(STRING)
)


def county_wide_columns(categories: list[str]) -> list[str]:
    """Columns of the wide county industry table."""
    return [f"{c}_{m}" for c in categories for m in ("est", "emp", "ap")]
