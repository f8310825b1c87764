"""The engine's inputs, derived from the given tables by the same rule in Spark and in SQL.

Each proxy has a Spark builder and a SQL text (a common table expression body).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions.text import text_array
from migrascope.operators import clean

# The five order priorities stand for five origin groups.
PANEL_ORIGINS = {
    "india": "1-URGENT",
    "mexico": "2-HIGH",
    "china": "3-MEDIUM",
    "philippines": "4-NOT SPECIFIED",
    "vietnam": "5-LOW",
}
ORIGINS = list(PANEL_ORIGINS)
PANEL_MIN_POPULATION = 15
AS_OF_YEAR = 2022

NAICS = [
    "7225", "4451", "4452", "4481", "8121", "8123", "4853", "2361", "6211", "5411", "7211", "4841",
    "4411", "4231", "3111", "1111", "8129", "9211", "7223",
]
NAMES = [
    "Pho Hanoi", "Seoul Korean Bbq", "Saigon Taco Naan House", "Namaste Beauty Salon",
    "Bombay Garden Restaurant", "Drum Shop", "Indiana Hardware", "Water Works", "Photo Lab",
    "Joe's O'neil Bbq-2go", "Taco Loco Mexican Grill", "Great China Dim Sum",
    "Little Ethiopian Injera", "Island Jerk House", "Main Street Laundry",
    "Za'atar Pita And Kebab", "Spring Roll Thai Kitchen",
]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def sql_list(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def _pick(values: list[str], index) -> F.Column:
    return F.get(text_array(values), (index % len(values)).cast("int"))


# --- tract x year panel ---


def raw_panel(spark: SparkSession, folder: str) -> DataFrame:
    """Survey-like counts per customer nation and segment (the tract) and order year."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("o_custkey"), "c_nationkey", "c_mktsegment", "c_acctbal"
    )
    rows = orders.join(customer, "o_custkey")
    tract = F.concat(F.lpad(F.col("c_nationkey").cast("string"), 5, "0"), "c_mktsegment")

    def times(condition):
        return F.sum(F.when(condition, 1).otherwise(0))

    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    return rows.groupBy(
        tract.alias("tract_geoid"), F.year("o_orderdate").alias("year")
    ).agg(
        F.count(F.lit(1)).alias("total_pop"),
        *[times(priority == p).alias(f"{o}_people") for o, p in PANEL_ORIGINS.items()],
        times(status == "F").alias("foreign_born_total"),
        times(status == "O").alias("owner_occupied"),
        times(status == "P").alias("partial"),
        whole_mean(F.round(F.col("o_totalprice") * 100)).alias("median_rent"),
        whole_mean(F.round(F.col("c_acctbal") * 100) + 100000).alias("median_household_income"),
    )


def whole_mean(cents) -> F.Column:
    """Mean of whole cents, cut to whole cents: exact, so every ratio of it is too."""
    return F.floor(F.sum(cents.cast("long")) / F.count(F.lit(1))).cast("long")


RAW_PANEL_SQL = f"""
SELECT concat(lpad(cast(c_nationkey AS varchar), 5, '0'), c_mktsegment) AS tract_geoid,
       cast(year(o_orderdate) AS integer) AS year,
       count(*) AS total_pop,
       {", ".join(f"count(*) FILTER (o_orderpriority = '{p}') AS {o}_people" for o, p in PANEL_ORIGINS.items())},
       count(*) FILTER (o_orderstatus = 'F') AS foreign_born_total,
       count(*) FILTER (o_orderstatus = 'O') AS owner_occupied,
       count(*) FILTER (o_orderstatus = 'P') AS partial,
       cast(floor(cast(sum(cast(round(o_totalprice * 100) AS bigint)) AS double) / count(*)) AS bigint) AS median_rent,
       cast(floor(cast(sum(cast(round(c_acctbal * 100) AS bigint) + 100000) AS double) / count(*)) AS bigint) AS median_household_income
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY 1, 2
"""


def panel(spark: SparkSession, folder: str) -> DataFrame:
    """Panel with densities and the survey columns the ratios need."""
    raw = raw_panel(spark, folder)
    population = F.col("total_pop")
    return raw.select(
        "tract_geoid",
        "year",
        "total_pop",
        "foreign_born_total",
        "median_rent",
        "median_household_income",
        (F.col("owner_occupied") + F.col("partial")).alias("total_housing_units"),
        population.alias("occupied_housing_units"),
        "owner_occupied",
        F.col("partial").alias("bachelor_degree"),
        F.col("owner_occupied").alias("graduate_degree"),
        population.alias("total_education"),
        population.alias("vehicles_available"),
        F.col("vietnam_people").alias("no_vehicles"),
        *[F.col(f"{o}_people") for o in ORIGINS],
        *clean.origin_densities({o: [F.col(f"{o}_people")] for o in ORIGINS}, population),
        clean.values.per_thousand(F.col("foreign_born_total"), population).alias("foreign_born_density"),
        clean.values.ratio(F.col("partial") + F.col("owner_occupied"), population).alias(
            "college_educated_rate"
        ),
    )


PANEL_SQL = f"""
SELECT tract_geoid, year, total_pop, foreign_born_total, median_rent, median_household_income,
       owner_occupied + partial AS total_housing_units,
       total_pop AS occupied_housing_units, owner_occupied,
       partial AS bachelor_degree, owner_occupied AS graduate_degree, total_pop AS total_education,
       total_pop AS vehicles_available, vietnam_people AS no_vehicles,
       {", ".join(f"{o}_people, {o}_people AS {o}_count, cast({o}_people AS double) / nullif(total_pop, 0) * 1000 AS {o}_density" for o in ORIGINS)},
       cast(foreign_born_total AS double) / nullif(total_pop, 0) * 1000 AS foreign_born_density,
       cast(partial + owner_occupied AS double) / nullif(total_pop, 0) AS college_educated_rate
FROM ({RAW_PANEL_SQL})
"""


# --- county industry rows ---


def industry(spark: SparkSession, folder: str) -> DataFrame:
    """One industry row per line item, in the layout of the landed county files."""
    lineitem = table(spark, folder, "lineitem")
    supplier = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), "s_nationkey"
    )
    return lineitem.join(supplier, "l_suppkey").select(
        F.lit("0").alias("fipstate"),
        F.col("s_nationkey").cast("string").alias("fipscty"),
        _pick(NAICS, F.col("l_partkey")).alias("naics"),
        F.lit(1).cast("long").alias("est"),
        F.col("l_quantity").cast("long").alias("emp"),
        F.round(F.col("l_extendedprice") * 100).cast("long").alias("ap"),
        F.year("l_shipdate").alias("year"),
    )


INDUSTRY_SQL = f"""
SELECT lpad(cast(s_nationkey AS varchar), 5, '0') AS county_fips,
       cast(year(l_shipdate) AS integer) AS year,
       {sql_list(NAICS)}[cast(l_partkey % {len(NAICS)} AS integer) + 1] AS naics,
       cast(1 AS bigint) AS est, cast(l_quantity AS bigint) AS emp,
       cast(round(l_extendedprice * 100) AS bigint) AS ap
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
"""


def category_case(column: str, rules: dict[str, list[str]]) -> str:
    """SQL CASE for last-rule-wins categories."""
    whens = [
        f"WHEN {' OR '.join(f'starts_with({column}, {chr(39)}{c}{chr(39)})' for c in codes)} THEN '{name}'"
        for name, codes in reversed(list(rules.items()))
    ]
    return f"CASE {' '.join(whens)} ELSE 'other' END"


RELEVANT_PREFIXES = sorted({c[:2] for codes in dims.INDUSTRY_RULES.values() for c in codes})

INDUSTRY_CLEAN_SQL = f"""
SELECT county_fips, year, naics, {category_case("naics", dims.INDUSTRY_RULES)} AS business_category,
       est, emp, ap
FROM ({INDUSTRY_SQL})
WHERE substr(naics, 1, 2) IN ({", ".join(f"'{p}'" for p in RELEVANT_PREFIXES)})
"""


# --- business directory ---


def directory(spark: SparkSession, folder: str, name: F.Column | None = None) -> DataFrame:
    """Customers in the layout of the flattened directory response."""
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    key = F.col("c_custkey")
    empty = {
        c: F.lit(None).cast("string").alias(c)
        for c in dims.DIRECTORY_FIELDS
    }
    filled = {
        "BUSINESS_NAME": name if name is not None else _pick(NAMES, key),
        "NAICS_CODE": _pick(NAICS, key),
        "STATE": F.col("n_name"),
        "LATITUDE": F.lit(37.0) + (key * 7919 % 2000) / 1000.0,
        "LONGITUDE": F.lit(-122.0) + (key * 104729 % 2000) / 1000.0,
        "YEAR_ESTABLISHED": (key % 40 + 1990).cast("string"),
        "EMPLOYEES": (key % 7).cast("string"),
        "ANNUAL_SALES": F.col("c_acctbal").cast("string"),
        "PHONE": F.concat(F.lit("555-"), key.cast("string")),
    }
    return customer.join(nation, "c_nationkey").select(
        key.cast("string").alias("business_id"),
        *[filled[c].alias(c) if c in filled else empty[c] for c in dims.DIRECTORY_FIELDS],
    )


def businesses(spark: SparkSession, folder: str) -> DataFrame:
    """Cleaned and tagged directory."""
    return clean.tag_cuisines(clean.process_businesses(directory(spark, folder), AS_OF_YEAR))


def keyword_share(column: str, words: list[str]) -> str:
    hits = " + ".join(
        "cast(contains(lower({}), '{}') AS integer)".format(column, w.replace("'", "''")) for w in words
    )
    return f"cast({hits} AS double) / {len(words)}"


BUSINESS_SQL = f"""
SELECT cast(c_custkey AS varchar) AS business_id, business_name, naics_code, state,
       latitude, longitude, phone, employees, annual_sales, business_age, business_category,
       concat(state, '000') AS county_fips,
       {", ".join(f"{keyword_share('business_name', words)} AS {c}_score" for c, words in dims.CUISINE_KEYWORDS.items())}
FROM (
  SELECT c_custkey, n_name AS state,
         {sql_list(NAMES)}[cast(c_custkey % {len(NAMES)} AS integer) + 1] AS business_name,
         naics_code, {category_case("naics_code", dims.DIRECTORY_RULES)} AS business_category,
         cast(37 AS double) + cast(c_custkey * 7919 % 2000 AS double) / 1000 AS latitude,
         cast(-122 AS double) + cast(c_custkey * 104729 % 2000 AS double) / 1000 AS longitude,
         concat('555-', cast(c_custkey AS varchar)) AS phone,
         cast(c_custkey % 7 AS double) AS employees,
         c_acctbal AS annual_sales,
         cast(greatest({AS_OF_YEAR} - (1990 + c_custkey % 40), 0) AS double) AS business_age
  FROM (SELECT *, {sql_list(NAICS)}[cast(c_custkey % {len(NAICS)} AS integer) + 1] AS naics_code
        FROM customer JOIN nation ON c_nationkey = n_nationkey)
)
"""
_BEST = f"greatest({', '.join(f'{c}_score' for c in dims.CUISINES)})"
TAGGED_SQL = f"""
SELECT *, CASE {" ".join(f"WHEN {c}_score = {_BEST} THEN '{c}'" for c in dims.CUISINES)} END AS primary_cuisine,
       {_BEST} > 0 AS has_cuisine_tag
FROM ({BUSINESS_SQL})
"""


# --- hotspots ---


def hotspots(spark: SparkSession, folder: str, origins: list[str] | None = None) -> DataFrame:
    """Suppliers as tracts with a probability per origin group."""
    key = F.col("s_suppkey")
    groups = F.array(
        *[
            F.struct(F.lit(o).alias("origin_group"), F.lit(131 * i).cast("long").alias("shift"))
            for i, o in enumerate(origins or ["india"])
        ]
    )
    rows = table(spark, folder, "supplier").select("s_suppkey", F.inline(groups))
    return rows.select(
        F.lpad(key.cast("string"), 11, "0").alias("tract_geoid"),
        (F.lit(37.0) + (key * 7919 % 2000) / 1000.0).alias("latitude"),
        (F.lit(-122.0) + (key * 104729 % 2000) / 1000.0).alias("longitude"),
        "origin_group",
        ((key * 7919 + F.col("shift")) % 1000 / 1000.0).alias("hotspot_prob"),
    )


def hotspots_sql(origins: list[str] | None = None) -> str:
    groups = ", ".join(f"('{o}', {131 * i})" for i, o in enumerate(origins or ["india"]))
    return f"""
SELECT lpad(cast(s_suppkey AS varchar), 11, '0') AS tract_geoid,
       cast(37 AS double) + cast(s_suppkey * 7919 % 2000 AS double) / 1000 AS latitude,
       cast(-122 AS double) + cast(s_suppkey * 104729 % 2000 AS double) / 1000 AS longitude,
       origin_group, cast((s_suppkey * 7919 + shift) % 1000 AS double) / 1000 AS hotspot_prob
FROM supplier, (VALUES {groups}) g(origin_group, shift)
"""


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return (
        f"2 * 6371.0::double * asin(sqrt(least(1.0::double, "
        f"power(sin(radians({lat2} - {lat1}) / 2), 2) + cos(radians({lat1})) * cos(radians({lat2}))"
        f" * power(sin(radians({lon2} - {lon1}) / 2), 2))))"
    )


# --- grid of unit squares ---


def squares(spark: SparkSession, folder: str) -> DataFrame:
    """Nations as the cells of a 5 x 5 grid."""
    key = F.col("n_nationkey")
    x, y = (key % 5).cast("double"), F.floor(key / 5).cast("double")
    corners = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
    ring = F.array(*[F.struct((x + dx).alias("x"), (y + dy).alias("y")) for dx, dy in corners])
    return table(spark, folder, "nation").select(
        F.lpad(key.cast("string"), 5, "0").alias("tract_geoid"), ring.alias("ring")
    )


SQUARES_EDGES_SQL = """
SELECT lpad(cast(a.n_nationkey AS varchar), 5, '0') AS src,
       lpad(cast(b.n_nationkey AS varchar), 5, '0') AS dst, k.kind
FROM nation a JOIN nation b ON a.n_nationkey <> b.n_nationkey,
     (VALUES ('queen'), ('rook')) k(kind)
WHERE abs(a.n_nationkey % 5 - b.n_nationkey % 5) <= 1
  AND abs(a.n_nationkey // 5 - b.n_nationkey // 5) <= 1
  AND (k.kind = 'queen' OR a.n_nationkey % 5 = b.n_nationkey % 5 OR a.n_nationkey // 5 = b.n_nationkey // 5)
"""


# --- labelled scores ---


def scores(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "lang", "n_chars")
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        "lang",
        "n_chars",
        F.col("quality").alias("y"),
        ((F.col("n_chars") % 1000).cast("double") / 1000.0).alias("p"),
    )


SCORES_SQL = """
SELECT doc_id, lang, n_chars, quality AS y, cast(n_chars % 1000 AS double) / 1000 AS p
FROM documents JOIN labels USING (doc_id)
"""
