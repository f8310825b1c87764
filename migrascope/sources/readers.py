"""Readers. Every schema is explicit; filters are written so that the scan can use them."""

from __future__ import annotations

import logging
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from migrascope import dims, schemas
from migrascope.functions.text import any_of

log = logging.getLogger(__name__)


def read_acs(
    spark: SparkSession,
    path: str,
    years: list[int] | None = None,
    states: list[str] | None = None,
    fmt: str = "parquet",
) -> DataFrame:
    """Raw tract table, optionally only some years and states (by the first two GEOID digits)."""
    if fmt == "parquet":
        df = spark.read.schema(schemas.ACS_RAW).parquet(path)
    else:
        df = typed(read_delimited(spark, path, marks=["tract_geoid", "year"]), schemas.ACS_RAW)
    if years:
        df = df.filter(F.col("year").isin(years))
    if states:
        df = df.filter(in_states(F.col("tract_geoid"), states))
    return df


def in_states(geoid, states: list[str]):
    """Prefix test per state, which parquet can use to skip row groups."""
    return any_of([geoid.startswith(state) for state in states])


def read_county_industry(
    spark: SparkSession, path: str, years: list[int] | None = None, sep: str = ","
) -> DataFrame:
    """Delimited county files in ``year=YYYY`` folders; columns are found by each file's own header.

    FIPS parts and NAICS stay text so that leading zeros survive.
    """
    raw = read_delimited(spark, path, sep, ["fipstate", "naics"])
    fields = [f for f in schemas.CBP_RAW.fields if f.name in raw.columns]
    missing = {"fipstate", "fipscty", "naics", "est"} - {f.name for f in fields}
    if missing:
        raise ValueError(f"columns missing in {path}: {sorted(missing)}")
    columns = [F.col(f.name).try_cast(f.dataType.simpleString()).alias(f.name) for f in fields]
    if "year" in raw.columns:
        columns.append(F.col("year").cast("int").alias("year"))
    df = raw.select(*columns)
    return df.filter(F.col("year").isin(years)) if years else df


def layouts(spark: SparkSession, path: str, marks: list[str]) -> dict[str, list[str]]:
    """Header line -> files that have it, found in one distributed scan; headers hold all of ``marks``.

    A line counts only where it begins its file, so the same words further down are no header.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    place = F.monotonically_increasing_id()  # grows along a file's first block
    opening = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), place.alias("place"))
    opening = opening.filter("block = 0")
    firsts = opening.groupBy("file").agg(F.min("place").alias("place"))  # a short row per delivered file
    marked = opening.filter(" AND ".join(f"contains(lower(value), '{m}')" for m in marks)) if marks else opening
    heads = marked.join(firsts, ["file", "place"]).groupBy("value").agg(F.sort_array(F.collect_list("file")).alias("files"))
    plain = {r["value"]: [unquote(f) for f in r["files"]] for r in heads.collect()}  # a row per layout
    return dict(sorted(plain.items(), key=lambda kv: kv[1][0]))


def read_delimited(spark: SparkSession, path: str, sep: str = ",", marks: list[str] | None = None) -> DataFrame:
    """Text columns of delimited files, named in lower case by each file's own header.

    Layouts change between deliveries. Files with the same header are one scan, and the scans are
    put together by name; a column that a file does not have is NULL for it. Headers are found by one
    distributed scan, whatever the number of files; ``marks`` are words that every header holds.
    """
    frames = []
    for paths in layouts(spark, path, marks or []).values():
        reader = spark.read.option("header", True).option("sep", sep).option("basePath", path)
        frame = reader.csv(paths)
        frames.append(frame.select([F.col(f"`{c}`").cast("string").alias(c.lower()) for c in frame.columns]))
    if not frames:
        raise FileNotFoundError(f"no files in {path}")
    return concat_years(frames)


def typed(df: DataFrame, schema) -> DataFrame:
    """Text columns as the types of a schema, in its order; an absent column is NULL."""
    return df.select(
        *[
            (F.col(f.name.lower()) if f.name.lower() in df.columns else F.lit(None))
            .try_cast(f.dataType.simpleString())
            .alias(f.name)
            for f in schema.fields
        ]
    )


def read_business_directory(spark: SparkSession, path: str, state: str | None = None) -> DataFrame:
    """JSON responses ``{features: [{attributes, geometry}]}``, one row per feature."""
    pages = spark.read.schema(schemas.DIRECTORY_JSON).option("multiLine", True).json(path)
    return flatten_directory(pages, state)


def flatten_directory(pages: DataFrame, state: str | None = None) -> DataFrame:
    """One row per feature. The geometry, where present, overrides the coordinate attributes."""
    rows = pages.select(F.explode("features").alias("f"))
    if state:
        rows = rows.filter(F.col("f.attributes.STATE") == state)
    plain = [
        F.col(f"f.attributes.{field}").alias(field)
        for field in dims.DIRECTORY_FIELDS
        if field not in ("LATITUDE", "LONGITUDE")
    ]
    return rows.select(
        *plain,
        F.coalesce("f.geometry.y", F.col("f.attributes.LATITUDE").try_cast("double")).alias("LATITUDE"),
        F.coalesce("f.geometry.x", F.col("f.attributes.LONGITUDE").try_cast("double")).alias("LONGITUDE"),
    )


def read_years(
    spark: SparkSession, root: str, years: list[int], required: bool = True,
    schema: str = "county_fips string, year int",
) -> DataFrame:
    """Rows of the requested years from a table partitioned by ``year``.

    A missing year is reported and skipped. With none found: an error if ``required``, else an
    empty table with the same columns; an absent layer then is an empty table of ``schema``.
    """
    try:
        df = spark.read.parquet(root).filter(F.col("year").isin(years))
    except AnalysisException as error:
        if required or error.getCondition() != "PATH_NOT_FOUND":
            raise
        log.warning("no table in %s", root)
        return spark.createDataFrame([], schema)
    found = {row.year for row in df.select("year").distinct().collect()}  # at most len(years) rows
    for year in sorted(set(years) - found):
        log.warning("no rows for year %s in %s", year, root)
    if required and not found:
        raise FileNotFoundError(f"none of the years {years} found in {root}")
    return df


def concat_years(frames: list[DataFrame]) -> DataFrame:
    """Union by name of separately stored years; a column absent in one is NULL there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stored layer; Spark's path error names the folder when it is absent."""
    return spark.read.parquet(path)


def read_hotspot_scores(
    spark: SparkSession, path: str, origin_group: str, centroids: DataFrame, horizon: int = 2
) -> DataFrame:
    """Stored scores of one origin group and horizon (pruned by partition) with tract coordinates."""
    own = (F.col("origin_group") == origin_group) & (F.col("horizon") == horizon)
    scores = spark.read.parquet(path).filter(own)
    points = centroids.select("tract_geoid", "latitude", "longitude")
    return scores.join(points, "tract_geoid")
