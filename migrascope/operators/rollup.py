"""County rollups of industry rows and directory rows, long and wide.

All sums are combined on the map side, so a county holding a large share of the rows sends one
partial row per task. Pivots list their values, which saves a job and fixes the output columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import values

INDUSTRY_CATEGORIES = [*dims.INDUSTRY_RULES, dims.OTHER_CATEGORY]
DIRECTORY_CATEGORIES = [*dims.DIRECTORY_RULES, dims.OTHER_CATEGORY]


def county_rollup(industry: DataFrame) -> DataFrame:
    """Establishments, employees and payroll per county, year and category, with ratios."""
    keys = ["county_fips", "year", "business_category"]
    sums = industry.dropna(subset=keys).groupBy(*keys).agg(
        *[F.sum(m).alias(m) for m in ("est", "emp", "ap")]
    )
    return sums.select("*", *industry_ratios())


def industry_ratios() -> list:
    est, emp, ap = F.col("est"), F.col("emp"), F.col("ap")
    return [
        values.per_thousand(est, emp).alias("establishments_per_1000"),
        values.ratio(emp, est).alias("avg_employees_per_establishment"),
        values.ratio(ap, emp).alias("avg_annual_payroll"),
    ]


def county_wide(rollup: DataFrame, categories: list[str] | None = None) -> DataFrame:
    """One row per county and year with ``{category}_{est|emp|ap}`` columns, 0 where absent."""
    wide = (
        rollup.groupBy("county_fips", "year")
        .pivot("business_category", categories or INDUSTRY_CATEGORIES)
        .agg(*[F.sum(m).alias(m) for m in ("est", "emp", "ap")])
    )
    return wide.na.fill(0)


def location_rollup(businesses: DataFrame) -> DataFrame:
    """Business count, employees, sales and mean age per county and category."""
    keys = ["county_fips", "business_category"]
    return businesses.dropna(subset=keys).groupBy(*keys).agg(
        F.count("business_name").alias("business_count"),
        F.sum("employees").alias("total_employees"),
        F.sum("annual_sales").alias("total_sales"),
        F.avg("business_age").alias("avg_business_age"),
    )


def location_wide(rollup: DataFrame, categories: list[str] | None = None) -> DataFrame:
    wide = (
        rollup.groupBy("county_fips")
        .pivot("business_category", categories or DIRECTORY_CATEGORIES)
        .agg(*[F.sum(m).alias(m) for m in ("business_count", "total_employees", "total_sales")])
    )
    return wide.na.fill(0)


def cuisine_rollup(tagged: DataFrame) -> DataFrame:
    """Count and employees of tagged businesses per county and primary cuisine.

    The tag and the cuisine are tested within the sums. Spark would push a filter on them below the
    tagging, with the search for keywords written out anew for every use of every score.
    """
    tag, cuisine = F.col("has_cuisine_tag"), F.col("primary_cuisine")
    sums = tagged.dropna(subset=["county_fips"]).groupBy("county_fips", "primary_cuisine").agg(
        F.count(F.when(tag, F.col("business_name"))).alias("business_count"),
        F.sum(F.when(tag, F.col("employees"))).alias("employees"),
        F.count(F.when(tag & cuisine.isNotNull(), 1)).alias("__tagged"),
    )
    return sums.filter("__tagged > 0").drop("__tagged")


def cuisine_wide(rollup: DataFrame, cuisines: list[str] | None = None) -> DataFrame:
    wide = (
        rollup.groupBy("county_fips")
        .pivot("primary_cuisine", cuisines or dims.CUISINES)
        .agg(F.sum("business_count").alias("business_count"), F.sum("employees").alias("employees"))
    )
    return wide.na.fill(0)


def aggregate_by_location(tagged: DataFrame) -> DataFrame:
    """Category and cuisine tables side by side; a county in only one keeps NULLs for the other."""
    categories = location_wide(location_rollup(tagged))
    cuisines = cuisine_wide(cuisine_rollup(tagged))
    return categories.join(cuisines, "county_fips", "full")
