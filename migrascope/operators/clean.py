"""From raw survey, industry and directory rows to typed, derived columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import text, values


def survey_names() -> dict[str, str]:
    codes = {**dims.DEMOGRAPHIC_CODES, **dims.LANGUAGE_CODES}
    return {code: name for name, code in codes.items()}


def origin_densities(
    components: dict[str, list[Column]], population: Column
) -> list[Column]:
    """``{origin}_count`` and ``{origin}_density`` (per 1,000 people) for every origin."""
    out = []
    for origin, parts in components.items():
        count = values.null_skipping_sum(parts).cast("long")
        out.append(count.alias(f"{origin}_count"))
        out.append(values.per_thousand(count, population).alias(f"{origin}_density"))
    return out


def demographic_ratios() -> list[Column]:
    """Housing, education and vehicle ratios over the renamed survey columns."""
    c = F.col
    return [
        values.ratio(c("median_rent") * 12, c("median_household_income")).alias("rent_income_ratio"),
        values.ratio(c("owner_occupied"), c("occupied_housing_units")).alias("homeownership_rate"),
        values.ratio(c("bachelor_degree") + c("graduate_degree"), c("total_education")).alias(
            "college_educated_rate"
        ),
        values.ratio(c("vehicles_available") - c("no_vehicles"), c("vehicles_available")).alias(
            "vehicle_access_rate"
        ),
    ]


def language_diversity(columns: list[str]) -> Column:
    """Number of languages spoken by anyone in the tract."""
    return values.count_positive([F.col(c) for c in columns]).cast("int").alias("language_diversity")


def process_acs(raw: DataFrame, origins: dict[str, list[str]] | None = None) -> DataFrame:
    """Rename survey codes, then add counts, densities, ratios and language diversity."""
    origins = origins or dims.ORIGIN_CODES
    components = {o: [F.col(code) for code in codes] for o, codes in origins.items()}
    renamed = raw.withColumnsRenamed(survey_names())
    origin_codes = {code for codes in origins.values() for code in codes}
    kept = [F.col(c) for c in renamed.columns if c not in origin_codes]
    population = F.col("total_pop")
    return renamed.select(
        *kept,
        *origin_densities(components, population),
        values.per_thousand(F.col("foreign_born_total"), population).alias("foreign_born_density"),
        *demographic_ratios(),
        language_diversity(dims.LANGUAGES_AT_HOME),
    )


def process_cbp(
    raw: DataFrame,
    rules: dict[str, list[str]] | None = None,
    precedence: str = "last_wins",
    naics_level: int | None = None,
) -> DataFrame:
    """Keep relevant industries and add county code, category and row ratios.

    ``naics_level`` keeps only codes of that many digits, for files that list totals next to
    their detail rows. The year must be a column (a partition of the landed files).
    """
    rules = rules or dims.INDUSTRY_RULES
    if "year" not in raw.columns:
        raise ValueError("industry rows need a year column; land the files in year=YYYY folders")
    df = raw.filter(text.relevant_industry(F.col("naics"), rules))
    if naics_level is not None:
        digits = F.regexp_extract(F.col("naics"), r"^(\d*)", 1)
        df = df.filter(F.length(digits) == naics_level)
    measures = {m: F.col(m) if m in df.columns else F.lit(None).cast("long") for m in ("est", "emp", "ap")}
    per_thousand = (
        values.per_thousand(measures["est"], measures["emp"])
        if "emp" in df.columns
        else measures["est"].cast("double")
    )
    per_site = values.ratio(measures["emp"], measures["est"]) if "emp" in df.columns else F.lit(0.0)
    return df.select(
        text.county_fips(F.col("fipstate"), F.col("fipscty")).alias("county_fips"),
        F.col("year").cast("int").alias("year"),
        "naics",
        text.category(F.col("naics"), rules, precedence).alias("business_category"),
        *[F.coalesce(measure, F.lit(0)).alias(name) for name, measure in measures.items()],
        per_thousand.alias("establishments_per_1000"),
        per_site.alias("avg_employees_per_establishment"),
    )


def business_age(year_established: Column, as_of_year: Column, unknown_is_old: bool = False) -> Column:
    """Years since founding, not below 0. An unknown year gives NULL.

    ``unknown_is_old=True`` counts an unknown year as year 0 instead.
    """
    age = F.greatest(as_of_year - year_established, F.lit(0.0))
    return age if unknown_is_old else F.when(year_established > 0, age)


def process_businesses(
    raw: DataFrame,
    as_of_year: int | None = None,
    rules: dict[str, list[str]] | None = None,
    precedence: str = "last_wins",
    unknown_is_old: bool = False,
    state_fips: DataFrame | None = None,
) -> DataFrame:
    """Clean the flattened directory: names, category, county key, numbers, age.

    The county key is the padded state followed by 000. ``state_fips(state, fips)`` replaces the
    state text by its numeric code so that the key joins to other county tables.
    """
    df = raw.withColumnsRenamed(dims.DIRECTORY_FIELDS)
    as_of = F.lit(float(as_of_year)) if as_of_year is not None else F.year(F.current_date()).cast("double")
    founded = values.number_or_zero(F.col("year_established"))
    naics = F.col("naics_code").cast("string")
    state = F.col("state")
    if state_fips is not None:
        df = df.join(state_fips.select("state", "fips"), "state", "left")
        state = F.coalesce("fips", "state")
    replaced = {
        "business_name": text.display_name(F.col("business_name")),
        "latitude": F.col("latitude").cast("double"),
        "longitude": F.col("longitude").cast("double"),
        "employees": values.number_or_zero(F.col("employees")),
        "annual_sales": values.number_or_zero(F.col("annual_sales")),
        "year_established": founded,
    }
    kept = [replaced.get(c, F.col(c)).alias(c) for c in df.columns if c not in ("fips", "business_id")]
    if "business_id" in df.columns:
        identity = F.col("business_id").cast("string")
    else:  # no id in the source: a digest of the identifying fields, stable across runs
        parts = ["business_name", "address", "city", "state", "zip_code", "phone"]
        identity = F.md5(F.concat_ws("␟", *[F.coalesce(p, F.lit("")) for p in parts]))
    return df.select(
        identity.alias("business_id"),
        *kept,
        *[F.substring(naics, 1, n).alias(f"naics_{n}digit") for n in (2, 3, 4, 5)],
        text.category(naics, rules or dims.DIRECTORY_RULES, precedence).alias("business_category"),
        F.concat(text.zero_pad(state, 2), F.lit("000")).alias("county_fips"),
        business_age(founded, as_of, unknown_is_old).alias("business_age"),
    )


def tag_cuisines(
    businesses: DataFrame,
    keywords: dict[str, list[str]] | None = None,
    word_boundary: bool = False,
) -> DataFrame:
    """Keyword score per cuisine, the best cuisine, and whether any keyword was found."""
    keywords = keywords or dims.CUISINE_KEYWORDS
    every_word = [word for words in keywords.values() for word in words]
    found = text.keywords_found(F.col("business_name"), every_word, word_boundary)
    scored = businesses.withColumn("__found", found).select(
        *businesses.columns,
        *[
            text.keyword_score(F.col("__found"), words).alias(f"{cuisine}_score")
            for cuisine, words in keywords.items()
        ],
    )
    scores = [F.col(f"{cuisine}_score") for cuisine in keywords]
    return scored.select(
        "*",
        text.first_best(list(keywords), scores).alias("primary_cuisine"),
        (F.greatest(*scores) > 0).alias("has_cuisine_tag"),
    )


def count_tagged(tagged: DataFrame) -> DataFrame:
    """Businesses in all and with a cuisine tag."""
    return tagged.agg(
        F.count(F.lit(1)).alias("businesses"),
        F.coalesce(F.sum(F.col("has_cuisine_tag").cast("int")), F.lit(0)).cast("long").alias("tagged"),
    )
