"""Scans, cleaning, categories and rollups."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import functions as F

from checks import proxies as P
from checks.registry import query, r, rs
from migrascope import dims
from migrascope.functions import text, values
from migrascope.operators import clean, rollup, serving
from migrascope.sources import readers, writers

STATES = ["00", "01"]
NATIONS = ["NATION_3", "NATION_7"]


@query(
    "scan_filter_state",
    """SELECT n_name, c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
       FROM customer JOIN nation ON c_nationkey = n_nationkey
       WHERE starts_with(n_name, 'NATION_1') OR starts_with(n_name, 'NATION_2')
       GROUP BY ALL""",
)
def scan_filter_state(spark, folder):
    nation = P.table(spark, folder, "nation").filter(
        readers.in_states(F.col("n_name"), ["NATION_1", "NATION_2"])
    )
    customer = P.table(spark, folder, "customer")
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.groupBy("n_name", "c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )


@query(
    "multi_year_union",
    f"""SELECT tract_geoid, year, total_pop, CASE WHEN year >= 1997 THEN foreign_born_total END AS foreign_born_total
        FROM ({P.RAW_PANEL_SQL}) WHERE year IN (1995, 1996, 1997, 1998)""",
)
def multi_year_union(spark, folder):
    """Two stored spans with different columns, put together by name."""
    panel = P.raw_panel(spark, folder)
    early = panel.filter("year IN (1995, 1996)").select("tract_geoid", "year", "total_pop")
    late = panel.filter("year IN (1997, 1998)").select(
        "tract_geoid", "year", "total_pop", "foreign_born_total"
    )
    return readers.concat_years([early, late])


def scratch_folder(spark, name: str) -> str:
    """A new folder that every executor can reach."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is not None:
        return f"{shared}/{name}-{spark.sparkContext.applicationId}"
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder")
    return tempfile.mkdtemp(prefix=f"{name}-")


@query("parquet_roundtrip", P.RAW_PANEL_SQL)
def parquet_roundtrip(spark, folder):
    """Write by year, rewrite one year, read the years back."""
    path = f"{scratch_folder(spark, 'roundtrip')}/panel"
    panel = P.raw_panel(spark, folder)
    writers.write_by_year(panel, path)
    writers.write_by_year(panel.filter("year = 1997"), path)
    return readers.read_years(spark, path, list(range(1990, 2010))).select(panel.columns)


CSV_SQL = """
SELECT lpad(cast(l_suppkey % 50 AS varchar), 2, '0') AS fipstate, lpad(cast(l_partkey % 999 AS varchar), 3, '0') AS fipscty,
       cast(l_orderkey AS varchar) AS naics, cast(l_linenumber AS bigint) AS est, cast(l_quantity AS bigint) AS emp,
       CASE WHEN year(l_shipdate) % 2 = 0 THEN cast(l_quantity AS bigint) * 10 END AS ap, cast(year(l_shipdate) AS integer) AS year
FROM lineitem
"""


@query("csv_layouts", CSV_SQL)
def csv_layouts(spark, folder):
    """Odd and even years are delivered with other columns, orders and cases; each file's header counts."""
    year = F.year("l_shipdate")
    rows = P.table(spark, folder, "lineitem").select(
        F.lpad((F.col("l_suppkey") % 50).cast("string"), 2, "0").alias("fipstate"),
        F.lpad((F.col("l_partkey") % 999).cast("string"), 3, "0").alias("fipscty"),
        F.col("l_orderkey").cast("string").alias("naics"),
        F.col("l_linenumber").cast("long").alias("est"),
        F.col("l_quantity").cast("long").alias("emp"),
        (F.col("l_quantity").cast("long") * 10).alias("ap"),
        year.alias("year"),
    )
    path = f"{scratch_folder(spark, 'layouts')}/{uuid.uuid4().hex}"
    even = rows.filter("year % 2 = 0").select("fipstate", "fipscty", "naics", "emp", "ap", "est", "year")
    odd = rows.filter("year % 2 = 1").select("EST", "naics", "FIPSTATE", "fipscty", "Emp", "year")
    for part in (even, odd):
        part.write.mode("append").option("header", True).partitionBy("year").csv(path)
    return readers.read_county_industry(spark, path)


@query(
    "json_flatten",
    "SELECT event_id, event_type, cast(json_extract(props, '$.k') AS integer) AS k, "
    "cast(value AS double) AS longitude, cast(NULL AS double) AS latitude FROM events",
)
def json_flatten(spark, folder):
    """Event properties parsed with an explicit schema, nested as features and flattened again."""
    events = P.table(spark, folder, "events")
    parsed = F.from_json("props", "k int")
    point = F.struct(F.col("value").alias("x"), F.lit(None).cast("double").alias("y"))
    pages = events.select(
        F.array(
            F.struct(
                F.struct("event_id", "event_type", parsed["k"].alias("k")).alias("attributes"),
                point.alias("geometry"),
            )
        ).alias("features")
    )
    return pages.select(F.explode("features").alias("f")).select(
        "f.attributes.*", F.col("f.geometry.x").alias("longitude"), F.col("f.geometry.y").alias("latitude")
    )


@query(
    "directory_flatten",
    f"""SELECT business_id AS "PHONE", business_name AS "BUSINESS_NAME", state AS "STATE",
              latitude AS "LATITUDE",
              CASE WHEN cast(business_id AS bigint) % 3 = 0 THEN longitude + 1 ELSE longitude END AS "LONGITUDE"
        FROM ({P.BUSINESS_SQL}) WHERE state = 'NATION_3'""",
)
def directory_flatten(spark, folder):
    """Directory responses: geometry wins over coordinate attributes, a null geometry does not."""
    raw = P.directory(spark, folder)
    moved = F.col("business_id").cast("long") % 3 == 0
    attributes = F.struct(
        *[
            F.col("business_id").alias(c) if c == "PHONE" else F.col(c).cast("string").alias(c)
            for c in dims.DIRECTORY_FIELDS
        ]
    )
    geometry = F.when(
        moved, F.struct((F.col("LONGITUDE") + 1).alias("x"), F.col("LATITUDE").alias("y"))
    )
    pages = raw.select(
        F.array(F.struct(attributes.alias("attributes"), geometry.alias("geometry"))).alias("features")
    )
    return readers.flatten_directory(pages, "NATION_3").select(
        "PHONE", "BUSINESS_NAME", "STATE", "LATITUDE", "LONGITUDE"
    )


@query(
    "business_clean",
    f"""SELECT cast(c_custkey AS varchar) AS business_id,
              concat(upper(substr(c_mktsegment, 1, 1)), lower(substr(c_mktsegment, 2))) AS business_name,
              naics_code, substr(naics_code, 1, 2) AS naics_2digit, substr(naics_code, 1, 3) AS naics_3digit,
              substr(naics_code, 1, 4) AS naics_4digit, substr(naics_code, 1, 5) AS naics_5digit,
              {P.category_case("naics_code", dims.DIRECTORY_RULES)} AS business_category,
              concat(n_name, '000') AS county_fips,
              CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey % 7 END::double AS employees,
              c_acctbal AS annual_sales,
              CASE WHEN c_custkey % 11 = 0 THEN 0 ELSE 1990 + c_custkey % 40 END::double AS year_established,
              CASE WHEN c_custkey % 11 = 0 THEN NULL
                   ELSE greatest({P.AS_OF_YEAR} - (1990 + c_custkey % 40), 0) END::double AS business_age
       FROM (SELECT *, {P.sql_list(P.NAICS)}[cast(c_custkey % {len(P.NAICS)} AS integer) + 1] AS naics_code
             FROM customer JOIN nation ON c_nationkey = n_nationkey)""",
)
def business_clean(spark, folder):
    """Names with blanks around them, unreadable numbers and missing years."""
    customer = P.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("business_id"), "c_mktsegment"
    )
    raw = P.directory(spark, folder).join(customer, "business_id")
    key = F.col("business_id").cast("long")
    dirty = raw.withColumns(
        {
            "BUSINESS_NAME": F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")),
            "EMPLOYEES": F.when(key % 5 == 0, "abc").otherwise(F.concat(F.lit(" "), "EMPLOYEES", F.lit(" "))),
            "YEAR_ESTABLISHED": F.when(key % 11 != 0, F.col("YEAR_ESTABLISHED")),
        }
    )
    return clean.process_businesses(dirty, P.AS_OF_YEAR).select(
        "business_id", "business_name", "naics_code", "naics_2digit", "naics_3digit", "naics_4digit",
        "naics_5digit", "business_category", "county_fips", "employees", "annual_sales",
        "year_established", "business_age",
    )


@query(
    "fips_build",
    """SELECT s_suppkey, concat(CASE WHEN length(a) < 2 THEN lpad(a, 2, '0') ELSE a END,
                                CASE WHEN length(b) < 3 THEN lpad(b, 3, '0') ELSE b END) AS county_fips
       FROM (SELECT s_suppkey, cast(s_nationkey AS varchar) AS a, cast(s_suppkey AS varchar) AS b FROM supplier)""",
)
def fips_build(spark, folder):
    supplier = P.table(spark, folder, "supplier")
    state, county = F.col("s_nationkey").cast("string"), F.col("s_suppkey").cast("string")
    return supplier.select("s_suppkey", text.county_fips(state, county).alias("county_fips"))


@query(
    "validate_requests",
    """SELECT request_id, latitude, longitude, origin_group, max_distance, max_recommendations,
              CASE WHEN origin_group IS NULL THEN 'origin_group missing'
                   WHEN latitude IS NULL THEN 'latitude missing'
                   WHEN latitude NOT BETWEEN -90 AND 90 THEN 'latitude out of range'
                   WHEN longitude IS NULL THEN 'longitude missing'
                   WHEN longitude NOT BETWEEN -180 AND 180 THEN 'longitude out of range'
                   WHEN max_distance NOT BETWEEN 0.1 AND 100 THEN 'max_distance out of range'
                   WHEN max_recommendations NOT BETWEEN 1 AND 50 THEN 'max_recommendations out of range' END AS reason
       FROM (SELECT cast(c_custkey AS varchar) AS request_id,
                    cast(c_custkey % 211 - 100 AS double) AS latitude,
                    CASE WHEN c_custkey % 17 <> 0 THEN cast(c_custkey % 401 - 190 AS double) END AS longitude,
                    CASE WHEN c_custkey % 13 <> 0 THEN c_mktsegment END AS origin_group,
                    CASE WHEN c_custkey % 7 <> 0 THEN cast(c_custkey % 113 AS double) ELSE 15 END AS max_distance,
                    CASE WHEN c_custkey % 9 <> 0 THEN cast(c_custkey % 60 AS integer) ELSE 10 END AS max_recommendations
             FROM customer)""",
)
def validate_requests(spark, folder):
    key = F.col("c_custkey")
    requests = P.table(spark, folder, "customer").select(
        key.cast("string").alias("request_id"),
        (key % 211 - 100).cast("double").alias("latitude"),
        F.when(key % 17 != 0, (key % 401 - 190).cast("double")).alias("longitude"),
        F.when(key % 13 != 0, F.col("c_mktsegment")).alias("origin_group"),
        F.when(key % 7 != 0, (key % 113).cast("double")).alias("max_distance"),
        F.when(key % 9 != 0, (key % 60).cast("int")).alias("max_recommendations"),
    )
    return serving.validate_recommendations(requests)


@query(
    "naics_filter",
    f"SELECT naics, count(*) AS n FROM ({P.INDUSTRY_CLEAN_SQL}) GROUP BY naics",
)
def naics_filter(spark, folder):
    kept = P.industry(spark, folder).filter(text.relevant_industry(F.col("naics"), dims.INDUSTRY_RULES))
    return kept.groupBy("naics").agg(F.count(F.lit(1)).alias("n"))


MOST_SPECIFIC_SQL = "CASE " + " ".join(
    f"WHEN starts_with(naics, '{code}') THEN '{name}'"
    for code, name in sorted(
        ((c, n) for n, codes in dims.INDUSTRY_RULES.items() for c in codes), key=lambda x: -len(x[0])
    )
) + " ELSE 'other' END"


@query(
    "naics_category",
    f"""SELECT naics, {P.category_case("naics", dims.INDUSTRY_RULES)} AS business_category,
              {MOST_SPECIFIC_SQL} AS specific_category, count(*) AS n
       FROM ({P.INDUSTRY_SQL}) GROUP BY ALL""",
)
def naics_category(spark, folder):
    code = F.col("naics")
    return (
        P.industry(spark, folder)
        .select(
            "naics",
            text.category(code, dims.INDUSTRY_RULES).alias("business_category"),
            text.category(code, dims.INDUSTRY_RULES, "most_specific").alias("specific_category"),
        )
        .groupBy("naics", "business_category", "specific_category")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query(
    "business_category",
    f"SELECT business_id, naics_code, business_category FROM ({P.BUSINESS_SQL})",
)
def business_category(spark, folder):
    return clean.process_businesses(P.directory(spark, folder), P.AS_OF_YEAR).select(
        "business_id", "naics_code", "business_category"
    )


SCORES = [f"{c}_score" for c in dims.CUISINES]


@query("keyword_score", f"SELECT business_id, business_name, {rs(SCORES)} FROM ({P.BUSINESS_SQL})")
def keyword_score(spark, folder):
    return P.businesses(spark, folder).select("business_id", "business_name", *[r(c) for c in SCORES])


_WORDS = dims.CUISINE_KEYWORDS["caribbean"]
_WORD_HITS = " + ".join(
    "cast(regexp_matches(lower(business_name), '\\b{}\\b') AS integer)".format(w.replace("'", "''")) for w in _WORDS
)


@query(
    "keyword_score_words",
    f"SELECT business_id, round(cast({_WORD_HITS} AS double) / {len(_WORDS)}, 6) AS caribbean_score FROM ({P.BUSINESS_SQL})",
)
def keyword_score_words(spark, folder):
    """Whole words only, so that a drum shop sells no rum."""
    named = clean.process_businesses(P.directory(spark, folder), P.AS_OF_YEAR)
    found = text.keywords_found(F.col("business_name"), _WORDS, word_boundary=True)
    score = text.keyword_score(found, _WORDS)
    return named.select("business_id", F.round(score, 6).alias("caribbean_score"))


@query(
    "primary_cuisine",
    f"""SELECT primary_cuisine, has_cuisine_tag, count(*) AS businesses FROM ({P.TAGGED_SQL}) GROUP BY ALL""",
)
def primary_cuisine(spark, folder):
    return (
        P.businesses(spark, folder)
        .groupBy("primary_cuisine", "has_cuisine_tag")
        .agg(F.count(F.lit(1)).alias("businesses"))
    )


@query(
    "tagged_count",
    f"""SELECT count(*) AS businesses, cast(count(*) FILTER (has_cuisine_tag) AS bigint) AS tagged
        FROM ({P.TAGGED_SQL})""",
)
def tagged_count(spark, folder):
    return clean.count_tagged(P.businesses(spark, folder))


# --- survey ratios ---

RATIOS_SQL = f"""
SELECT tract_geoid, year,
       cast(median_rent * 12 AS double) / nullif(median_household_income, 0) AS rent_income_ratio,
       cast(owner_occupied AS double) / nullif(occupied_housing_units, 0) AS homeownership_rate,
       cast(bachelor_degree + graduate_degree AS double) / nullif(total_education, 0) AS college_educated_rate,
       cast(vehicles_available - no_vehicles AS double) / nullif(vehicles_available, 0) AS vehicle_access_rate
FROM ({P.PANEL_SQL})
"""


@query(
    "origin_density",
    f"""SELECT tract_geoid, year, {", ".join(f"{o}_count" for o in P.ORIGINS)},
              {", ".join(f"{o}_density" for o in [*P.ORIGINS, "foreign_born"])}
       FROM ({P.PANEL_SQL})""",
)
def origin_density(spark, folder):
    return P.panel(spark, folder).select(
        "tract_geoid",
        "year",
        *[f"{o}_count" for o in P.ORIGINS],
        *[f"{o}_density" for o in P.ORIGINS],
        "foreign_born_density",
    )


@query("demographic_ratios", RATIOS_SQL)
def demographic_ratios(spark, folder):
    panel = P.panel(spark, folder).drop("college_educated_rate")
    return panel.select("tract_geoid", "year", *clean.demographic_ratios())


@query(
    "language_diversity",
    f"""SELECT tract_geoid, year, {" + ".join(f"cast({o}_people > 0 AS integer)" for o in P.ORIGINS)} AS language_diversity
        FROM ({P.RAW_PANEL_SQL})""",
)
def language_diversity(spark, folder):
    panel = P.raw_panel(spark, folder)
    return panel.select(
        "tract_geoid", "year", clean.language_diversity([f"{o}_people" for o in P.ORIGINS])
    )


ACS_FIELDS = {
    "total_pop": "total_pop",
    "foreign_born_total": "foreign_born_total",
    "median_household_income": "median_household_income",
    "median_rent": "median_rent",
    "occupied_housing_units": "total_pop",
    "owner_occupied": "owner_occupied",
    "bachelor_degree": "partial",
    "graduate_degree": "owner_occupied",
    "total_education": "total_pop",
    "vehicles_available": "total_pop",
    "no_vehicles": "vietnam_people",
    "spanish_at_home": "mexico_people",
    "chinese_at_home": "china_people",
}


@query(
    "process_acs",
    f"""SELECT tract_geoid, year, india_people AS india_count,
              cast(india_people AS double) / nullif(total_pop, 0) * 1000 AS india_density,
              cast(0 AS double) AS peru_density,
              cast(foreign_born_total AS double) / nullif(total_pop, 0) * 1000 AS foreign_born_density,
              cast(owner_occupied AS double) / nullif(total_pop, 0) AS homeownership_rate,
              cast(mexico_people > 0 AS integer) + cast(china_people > 0 AS integer) AS language_diversity
       FROM ({P.RAW_PANEL_SQL})""",
)
def process_acs(spark, folder):
    """The whole survey step on coded columns: rename, counts, densities, ratios, diversity."""
    panel = P.raw_panel(spark, folder)
    codes = {**dims.DEMOGRAPHIC_CODES, **dims.LANGUAGE_CODES}
    demographic = [
        (F.col(ACS_FIELDS[n]) if n in ACS_FIELDS else F.lit(None).cast("long")).alias(code)
        for n, code in codes.items()
    ]
    origin = [
        (F.col(f"{o}_people") if o in P.ORIGINS else F.lit(None).cast("long")).alias(code)
        for o, (code,) in dims.ORIGIN_CODES.items()
    ]
    done = clean.process_acs(panel.select("tract_geoid", "year", *demographic, *origin))
    return done.select(
        "tract_geoid", "year", "india_count", "india_density", "peru_density",
        "foreign_born_density", "homeownership_rate", "language_diversity",
    )


# --- rollups ---

ROLLUP_SQL = f"""
SELECT county_fips, year, business_category, cast(sum(est) AS bigint) AS est,
       cast(sum(emp) AS bigint) AS emp, cast(sum(ap) AS bigint) AS ap
FROM ({P.INDUSTRY_CLEAN_SQL}) GROUP BY ALL
"""
LOCATION_SQL = f"""
SELECT county_fips, business_category, count(business_name) AS business_count,
       sum(employees) AS total_employees, sum(annual_sales) AS total_sales,
       avg(business_age) AS avg_business_age
FROM ({P.BUSINESS_SQL}) GROUP BY ALL
"""
CUISINE_SQL = f"""
SELECT county_fips, primary_cuisine, count(business_name) AS business_count, sum(employees) AS employees
FROM ({P.TAGGED_SQL}) WHERE has_cuisine_tag GROUP BY ALL
"""


def pivot_sql(source: str, keys: str, column: str, names: list[str], measures: dict[str, tuple[str, str]]) -> str:
    """Conditional sums: measure -> (SQL type, rounding)."""
    parts = []
    for name in names:
        for measure, (kind, digits) in measures.items():
            total = f"coalesce(sum({measure}) FILTER ({column} = '{name}'), 0)"
            total = f"round({total}, {digits})" if digits else total
            parts.append(f"cast({total} AS {kind}) AS {name}_{measure}")
    return f"SELECT {keys}, {', '.join(parts)} FROM ({source}) GROUP BY {keys}"


def county_table(spark, folder):
    return rollup.county_rollup(clean.process_cbp(P.industry(spark, folder)))


@query(
    "county_rollup",
    f"SELECT county_fips, year, business_category, est, emp, ap FROM ({ROLLUP_SQL})",
)
def county_rollup(spark, folder):
    return county_table(spark, folder).select(
        "county_fips", "year", "business_category", "est", "emp", "ap"
    )


@query(
    "industry_ratios",
    f"""SELECT county_fips, year, business_category,
              cast(est AS double) / nullif(emp, 0) * 1000 AS establishments_per_1000,
              cast(emp AS double) / nullif(est, 0) AS avg_employees_per_establishment,
              cast(ap AS double) / nullif(emp, 0) AS avg_annual_payroll
       FROM ({ROLLUP_SQL})""",
)
def industry_ratios(spark, folder):
    return county_table(spark, folder).select(
        "county_fips", "year", "business_category", "establishments_per_1000",
        "avg_employees_per_establishment", "avg_annual_payroll",
    )


INDUSTRY_MEASURES = {"est": ("bigint", None), "emp": ("bigint", None), "ap": ("bigint", None)}
COUNTY_WIDE_SQL = pivot_sql(
    ROLLUP_SQL, "county_fips, year", "business_category", rollup.INDUSTRY_CATEGORIES, INDUSTRY_MEASURES
)


def county_wide_table(spark, folder):
    return rollup.county_wide(county_table(spark, folder))


@query("county_wide", COUNTY_WIDE_SQL)
def county_wide(spark, folder):
    return county_wide_table(spark, folder)


@query(
    "location_rollup",
    f"""SELECT county_fips, business_category, business_count, total_employees,
              round(total_sales, 2) AS total_sales, round(avg_business_age, 6) AS avg_business_age
       FROM ({LOCATION_SQL})""",
)
def location_rollup(spark, folder):
    return rollup.location_rollup(P.businesses(spark, folder)).select(
        "county_fips", "business_category", "business_count", "total_employees", r("total_sales", 2),
        r("avg_business_age"),
    )


LOCATION_MEASURES = {
    "business_count": ("bigint", None), "total_employees": ("double", None), "total_sales": ("double", 2),
}
CUISINE_MEASURES = {"business_count": ("bigint", None), "employees": ("double", None)}
LOCATION_WIDE_SQL = pivot_sql(
    LOCATION_SQL, "county_fips", "business_category", rollup.DIRECTORY_CATEGORIES, LOCATION_MEASURES
)
CUISINE_WIDE_SQL = pivot_sql(
    CUISINE_SQL, "county_fips", "primary_cuisine", dims.CUISINES, CUISINE_MEASURES
)


@query("location_wide", LOCATION_WIDE_SQL)
def location_wide(spark, folder):
    wide = rollup.location_wide(rollup.location_rollup(P.businesses(spark, folder)))
    return wide.select(*[r(c, 2) if c.endswith("_sales") else c for c in wide.columns])


@query("cuisine_rollup", CUISINE_SQL)
def cuisine_rollup(spark, folder):
    return rollup.cuisine_rollup(P.businesses(spark, folder))


@query(
    "location_aggregate",
    f"SELECT * FROM ({LOCATION_WIDE_SQL}) FULL JOIN ({CUISINE_WIDE_SQL}) USING (county_fips)",
)
def location_aggregate(spark, folder):
    wide = rollup.aggregate_by_location(P.businesses(spark, folder))
    return wide.select(*[r(c, 2) if c.endswith("_sales") else c for c in wide.columns])


@query(
    "acs_cbp_join",
    f"""SELECT p.tract_geoid, p.year, substr(p.tract_geoid, 1, 5) AS county_fips, p.total_pop,
              w.* EXCLUDE (county_fips, year)
       FROM ({P.RAW_PANEL_SQL}) p
       LEFT JOIN ({COUNTY_WIDE_SQL}) w ON w.county_fips = substr(p.tract_geoid, 1, 5) AND w.year = p.year""",
)
def acs_cbp_join(spark, folder):
    from migrascope.operators import panel

    tracts = P.raw_panel(spark, folder).select("tract_geoid", "year", "total_pop")
    return panel.join_industry(tracts, county_wide_table(spark, folder))


@query(
    "row_ratios",
    f"""SELECT naics, est, emp, cast(est AS double) / nullif(emp, 0) * 1000 AS establishments_per_1000,
              cast(emp AS double) / nullif(est, 0) AS avg_employees_per_establishment, count(*) AS n
       FROM ({P.INDUSTRY_CLEAN_SQL}) GROUP BY ALL""",
)
def row_ratios(spark, folder):
    rows = clean.process_cbp(P.industry(spark, folder)).select(
        "naics", "est", "emp", "establishments_per_1000", "avg_employees_per_establishment"
    )
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "sanitize_features",
    f"""SELECT tract_geoid, year,
              CASE WHEN india_people = 0 THEN 0 ELSE cast(1000 AS double) / india_people END AS a,
              cast(CASE WHEN year = 1995 THEN 0 ELSE total_pop END AS double) AS b
       FROM (SELECT tract_geoid, year, india_people, total_pop FROM ({P.RAW_PANEL_SQL}))""",
)
def sanitize_features(spark, folder):
    """Infinities, NaN and NULL all become 0."""
    from migrascope.operators import panel

    infinite = F.when(F.col("india_people") == 0, F.lit(float("inf"))).otherwise(
        values.ratio(F.lit(1000), F.col("india_people"))
    )
    missing = F.when(F.col("year") == 1995, F.lit(float("nan"))).otherwise(F.col("total_pop").cast("double"))
    rows = P.raw_panel(spark, folder).select(
        "tract_geoid", "year", infinite.alias("a"), missing.alias("b")
    )
    return panel.sanitize(rows, ["a", "b"])
