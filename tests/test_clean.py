import pytest
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import text, values
from migrascope.operators import clean, rollup


def one(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()["x"]


def test_undefined_ratio_is_null(spark):
    assert one(spark, values.per_thousand(F.lit(120), F.lit(4000))) == 30.0
    assert one(spark, values.per_thousand(F.lit(120), F.lit(0))) is None


@pytest.mark.parametrize("state, county, fips", [("6", "37", "06037"), ("123", "4", "123004")])
def test_padding_never_cuts(spark, state, county, fips):
    assert one(spark, text.county_fips(F.lit(state), F.lit(county))) == fips


def test_category_rules(spark, rows):
    codes = ["7225", "4451", "4853", "7211", "8129", "3111", "722511", None]
    df = spark.createDataFrame([(c,) for c in codes], "c string").select(
        "c",
        text.category(F.col("c"), dims.INDUSTRY_RULES).alias("last"),
        text.category(F.col("c"), dims.INDUSTRY_RULES, "most_specific").alias("specific"),
    )
    found = {r.c: (r["last"], r.specific) for r in df.collect()}
    assert found["7225"][0] == found["722511"][0] == "food_services"
    assert found["4451"] == ("retail_trade", "grocery_stores")
    assert found["4853"] == ("transportation", "taxi_services")
    assert found["7211"][0] == "accommodation"
    assert found["8129"][0] == "other"
    assert found["3111"][0] == "manufacturing"
    assert found[None] == ("other", "other")


def test_codes_longer_than_five_match_whole(spark):
    rules = {"exact": ["722511"]}
    assert one(spark, text.category(F.lit("722511"), rules)) == "exact"
    assert one(spark, text.category(F.lit("7225112"), rules)) == "other"


def test_text_cleaning(spark):
    assert one(spark, text.display_name(F.lit(" joe's o'NEIL bbq-2go "))) == "Joe's O'neil Bbq-2go"
    for given, number in (("abc", 0.0), (" 5 ", 5.0), (None, 0.0)):
        assert one(spark, values.number_or_zero(F.lit(given).cast("string"))) == number


def tagged(spark, names, **options):
    df = spark.createDataFrame([(n,) for n in names], "business_name string")
    return {r.business_name: r for r in clean.tag_cuisines(df, **options).collect()}


def test_keyword_scores(spark):
    found = tagged(
        spark,
        ["Pho Hanoi", "Seoul Korean Bbq", "Saigon Taco Naan House", "Namaste Beauty Salon",
         "Bombay Garden Restaurant", "Drum Shop", "Peking Duck Palace", None],
    )
    assert found["Pho Hanoi"].korean_score == 1 / 22 and found["Pho Hanoi"].vietnamese_score == 2 / 20
    assert found["Pho Hanoi"].primary_cuisine == "vietnamese"
    assert found["Seoul Korean Bbq"].korean_score == 4 / 22
    mixed = found["Saigon Taco Naan House"]
    assert (mixed.indian_score, mixed.mexican_score, mixed.middle_eastern_score) == (1 / 44, 1 / 28, 1 / 26)
    assert mixed.primary_cuisine == "middle_eastern"
    plain = found["Namaste Beauty Salon"]
    assert plain.primary_cuisine == "indian" and not plain.has_cuisine_tag
    assert found["Bombay Garden Restaurant"].indian_score == 1 / 44
    assert found["Drum Shop"].caribbean_score == 1 / 20
    assert found["Peking Duck Palace"].chinese_score == 2 / 29
    assert not found[None].has_cuisine_tag and found[None].indian_score == 0.0


def test_keywords_found_equal_plain_search(spark):
    words = [w for ws in dims.CUISINE_KEYWORDS.values() for w in ws]
    names = [f"{a} {b}{c}" for a, b, c in zip(words, reversed(words), words[7:] + words[:7])]
    df = spark.createDataFrame([(n,) for n in names], "name string")
    found = df.select("name", text.keywords_found(F.col("name"), words).alias("found"))
    for row in found.collect():
        assert set(row.found) == {w for w in words if w in row.name}


def test_word_mode(spark):
    assert tagged(spark, ["Drum Shop"], word_boundary=True)["Drum Shop"].caribbean_score == 0.0
    bunny = tagged(spark, ["Bunny Chow Bar"], word_boundary=True)["Bunny Chow Bar"]
    assert bunny.african_score == 1 / 21 and bunny.korean_score == 0.0


def directory(spark, *, year="1990", employees="3", name="Pho Hanoi", state="CA"):
    blank = {f: None for f in dims.DIRECTORY_FIELDS}
    row = {**blank, "BUSINESS_NAME": name, "NAICS_CODE": "7225", "STATE": state, "EMPLOYEES": employees,
           "YEAR_ESTABLISHED": year, "LATITUDE": "1.5", "LONGITUDE": "2.5"}
    schema = ", ".join(f"{f} string" for f in dims.DIRECTORY_FIELDS)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_unknown_founding_year(spark):
    row = clean.process_businesses(directory(spark, year=None), 2022).first()
    assert row.business_age is None and row.county_fips == "CA000" and row.latitude == 1.5
    old = clean.process_businesses(directory(spark, year=None), 2022, unknown_is_old=True).first()
    assert old.business_age == 2022.0
    future = clean.process_businesses(directory(spark, year="2030"), 2022).first()
    assert future.business_age == 0.0


def test_state_dimension_and_stable_id(spark):
    fips = spark.createDataFrame([("CA", "06")], "state string, fips string")
    first = clean.process_businesses(directory(spark), 2022, state_fips=fips).first()
    again = clean.process_businesses(directory(spark), 2022).first()
    assert first.county_fips == "06000"
    assert first.business_id == again.business_id


def test_naics_level_avoids_double_counting(spark):
    raw = spark.createDataFrame(
        [("6", "37", "72----", 10, 100, 5), ("6", "37", "7225//", 4, 40, 2), ("6", "37", "722511", 4, 40, 2)],
        "fipstate string, fipscty string, naics string, est long, emp long, ap long",
    ).withColumn("year", F.lit(2020))
    rules = {"food": ["72"]}
    everything = rollup.county_rollup(clean.process_cbp(raw, rules)).first()
    detail = rollup.county_rollup(clean.process_cbp(raw, rules, naics_level=6)).first()
    assert (everything.est, detail.est) == (18, 4)
    with pytest.raises(ValueError, match="year"):
        clean.process_cbp(raw.drop("year"))


def test_wide_table_equals_long_sums(spark):
    rollup_rows = spark.createDataFrame(
        [("01", 2020, "food_services", 1, 2, 3.0), ("01", 2020, "other", 4, 5, 6.0), ("02", 2020, "other", 7, 8, 9.0)],
        "county_fips string, year int, business_category string, est long, emp long, ap double",
    )
    wide = {r.county_fips: r for r in rollup.county_wide(rollup_rows).collect()}
    assert wide["01"].food_services_est == 1 and wide["02"].food_services_est == 0
    assert sum(v for k, v in wide["01"].asDict().items() if k.endswith("_emp")) == 7


def test_county_in_one_table_only_keeps_nulls(spark):
    businesses = spark.createDataFrame(
        [("A", "x", "other", 1.0, 2.0, 3.0, "indian", False), ("B", "y", "other", 1.0, 2.0, 3.0, "thai", True)],
        "county_fips string, business_name string, business_category string, employees double, "
        "annual_sales double, business_age double, primary_cuisine string, has_cuisine_tag boolean",
    )
    out = {r.county_fips: r for r in rollup.aggregate_by_location(businesses).collect()}
    assert out["A"].thai_business_count is None and out["B"].thai_business_count == 1


def test_cuisine_rollup_searches_each_name_once(spark, capsys):
    """A filter on the tag would be pushed below the tagging, with the search repeated for every use of a score."""
    name = F.when(F.col("id") % 3 == 0, "Pho Hanoi").when(F.col("id") % 3 == 1, "Main Street Laundry")
    rows = spark.range(9).select(
        name.alias("business_name"),
        F.when(F.col("id") < 6, "A").alias("county_fips"),
        F.col("id").cast("double").alias("employees"),
    )
    out = rollup.cuisine_rollup(clean.tag_cuisines(rows))
    out.explain()
    assert capsys.readouterr().out.count("regexp_extract_all(") == 1
    assert [tuple(r) for r in out.collect()] == [("A", "vietnamese", 2, 3.0)]


def test_cuisine_rollup_leaves_out_null_keys_and_tags(spark):
    rows = spark.createDataFrame(
        [("A", "x", 1.0, None, True), (None, "x", 1.0, "thai", True), ("A", "x", 1.0, "thai", None),
         ("B", None, None, "thai", True), ("B", "y", 2.0, "thai", False), ("C", "y", 2.0, "thai", False)],
        "county_fips string, business_name string, employees double, primary_cuisine string, has_cuisine_tag boolean",
    )
    assert [tuple(r) for r in rollup.cuisine_rollup(rows).collect()] == [("B", "thai", 0, None)]
