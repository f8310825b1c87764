"""Distances, neighbours, matching and serving."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from checks import proxies as P
from checks.etl import scratch_folder
from checks.registry import query, r
from migrascope import dims
from migrascope.functions.text import text_array
from migrascope.operators import matching, proximity, serving, spatial
from migrascope.operators.panel import growth_rates
from migrascope.sources import readers, writers

USER = (37.5, -121.5)
RANK = "ORDER BY relevance_score DESC, distance_km, business_id"


def scored_sql(origin: str | None = None) -> str:
    """Businesses with their relevance, per origin group or for one."""
    cuisine = "NULL::double"
    if origin is None:
        whens = " ".join(f"WHEN '{o}' THEN {c}_score" for o, c in dims.ORIGIN_CUISINE.items())
        cuisine = f"CASE origin_group {whens} END"
        source = f"({P.BUSINESS_SQL}), (SELECT unnest({P.sql_list(dims.ORIGINS)}) AS origin_group)"
    else:
        if origin in dims.ORIGIN_CUISINE:
            cuisine = f"{dims.ORIGIN_CUISINE[origin]}_score"
        source = f"(SELECT *, '{origin}' AS origin_group FROM ({P.BUSINESS_SQL}))"
    liked = ", ".join(f"'{c}'" for c in dims.PREFERRED_CATEGORIES)
    return f"""
SELECT *, round(least(1, CASE WHEN business_category IN ({liked}) THEN 0.3::double ELSE 0 END
       + coalesce(cuisine_score, 0) * 0.5::double
       + CASE WHEN employees > 0 THEN 0.1::double ELSE 0 END
       + CASE WHEN business_age > 5 THEN 0.1::double ELSE 0 END), 6) AS relevance_score
FROM (SELECT *, {cuisine} AS cuisine_score FROM {source})
"""


@query(
    "haversine_distance",
    f"""SELECT c_custkey, round({P.haversine_sql("37.5", "-121.5", "lat", "lon")}, 6) AS distance_km
        FROM (SELECT c_custkey, cast(c_custkey % 181 - 90 AS double) AS lat, cast(c_custkey % 361 - 180 AS double) AS lon FROM customer)""",
)
def haversine_distance(spark, folder):
    key = F.col("c_custkey")
    away = proximity.geo.haversine_km(
        F.lit(USER[0]), F.lit(USER[1]), (key % 181 - 90).cast("double"), (key % 361 - 180).cast("double")
    )
    return P.table(spark, folder, "customer").select("c_custkey", F.round(away, 6).alias("distance_km"))


USER_KM = P.haversine_sql("37.5::double", "-121.5::double", "latitude", "longitude")


@query(
    "radius_lookup",
    f"""SELECT business_id, latitude, longitude, round(km, 6) AS distance_km
        FROM (SELECT business_id, latitude, longitude, {USER_KM} AS km FROM ({P.BUSINESS_SQL})) WHERE km <= 15""",
)
def radius_lookup(spark, folder):
    cleaned = P.businesses(spark, folder).select("business_id", "latitude", "longitude")
    near = proximity.within_point(cleaned, *USER, 15.0)
    return near.select("business_id", "latitude", "longitude", r("distance_km"))


@query("contiguity_edges", P.SQUARES_EDGES_SQL)
def contiguity_edges(spark, folder):
    return spatial.contiguity_edges(P.squares(spark, folder))


# Orders per nation and year, as the panel the neighbours are summed over.
NATION_PANEL_SQL = """
SELECT lpad(cast(c_nationkey AS varchar), 5, '0') AS tract_geoid, cast(year(o_orderdate) AS integer) AS year,
       cast(count(*) AS double) AS india_density, avg(o_totalprice) AS median_rent
FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""


def nation_panel(spark, folder):
    customer = P.table(spark, folder, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    rows = P.table(spark, folder, "orders").join(customer, "o_custkey")
    return rows.groupBy(
        F.lpad(F.col("c_nationkey").cast("string"), 5, "0").alias("tract_geoid"),
        F.year("o_orderdate").alias("year"),
    ).agg(
        F.count(F.lit(1)).cast("double").alias("india_density"),
        F.avg("o_totalprice").alias("median_rent"),
    )


def lag_sql(function: str, empty: str) -> str:
    lags = []
    for variable in ("india_density", "median_rent"):
        for name, kind in spatial.lag_names(variable, dims.ORIGINS).items():
            total = f"{function}(n.{variable}) FILTER (e.kind = '{kind}')"
            lags.append(f"round({empty.format(total)}, 4) AS {name}")
    return f"""
WITH panel AS ({NATION_PANEL_SQL}), edges AS ({P.SQUARES_EDGES_SQL})
SELECT p.tract_geoid, p.year, {", ".join(lags)}
FROM panel p LEFT JOIN edges e ON e.src = p.tract_geoid
LEFT JOIN panel n ON n.tract_geoid = e.dst AND n.year = p.year
GROUP BY p.tract_geoid, p.year
"""


def lagged(spark, folder, how):
    edges = spatial.contiguity_edges(P.squares(spark, folder))
    df = spatial.spatial_lag(nation_panel(spark, folder), edges, ["india_density", "median_rent"], how=how)
    return df.select("tract_geoid", "year", *[r(c, 4) for c in df.columns if "_lag_" in c])


@query("spatial_lag", lag_sql("sum", "coalesce({}, 0)"))
def spatial_lag(spark, folder):
    return lagged(spark, folder, "sum")


@query("spatial_lag_mean", lag_sql("avg", "{}"))
def spatial_lag_mean(spark, folder):
    return lagged(spark, folder, "mean")


BIZ_POINTS_SQL = f"SELECT business_id AS tract_geoid, latitude, longitude FROM ({P.BUSINESS_SQL})"


@query(
    "distance_band_edges",
    f"""WITH sites AS (SELECT min(tract_geoid) AS site, count(*) AS members, latitude, longitude
                       FROM ({BIZ_POINTS_SQL}) GROUP BY latitude, longitude),
        pairs AS (SELECT a.site AS src, b.site AS dst, b.members AS dst_members,
                         {P.haversine_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude")} AS km
                  FROM sites a JOIN sites b ON a.site <> b.site AND abs(a.latitude - b.latitude) < 0.1)
        SELECT src, dst, dst_members, round(km, 6) AS distance_km FROM pairs WHERE km <= 5""",
)
def distance_band_edges(spark, folder):
    points = P.directory(spark, folder).select(
        F.col("business_id").alias("tract_geoid"),
        F.col("LATITUDE").alias("latitude"),
        F.col("LONGITUDE").alias("longitude"),
    )
    return spatial.distance_band_edges(points, 5.0)


@query(
    "distance_band_neighbours",
    f"""WITH pts AS (SELECT tract_geoid, latitude, longitude, length(tract_geoid) AS weight FROM ({BIZ_POINTS_SQL})),
        sites AS (SELECT latitude, longitude, count(*) AS members, sum(weight) AS w FROM pts GROUP BY ALL),
        near AS (SELECT a.latitude, a.longitude, sum(b.members) AS n, sum(b.w) AS w
                 FROM sites a JOIN sites b ON abs(a.latitude - b.latitude) < 0.1
                  AND {P.haversine_sql("a.latitude", "a.longitude", "b.latitude", "b.longitude")} <= 5
                 GROUP BY ALL)
        SELECT tract_geoid, cast(weight AS double) AS weight, cast(n - 1 AS bigint) AS neighbours,
               cast(w - weight AS double) AS weight_band
        FROM pts JOIN near USING (latitude, longitude)""",
)
def distance_band_neighbours(spark, folder):
    """Neighbours of every point, those at its own place included, and a sum over them."""
    points = P.directory(spark, folder).select(
        F.col("business_id").alias("tract_geoid"),
        F.col("LATITUDE").alias("latitude"),
        F.col("LONGITUDE").alias("longitude"),
        F.length("business_id").cast("double").alias("weight"),
    )
    return spatial.distance_band_lag(points, 5.0, ["weight"])


@query(
    "radius_join",
    f"""SELECT tract_geoid, business_id, round(km, 6) AS distance_km FROM (
          SELECT h.tract_geoid, b.business_id,
                 {P.haversine_sql("h.latitude", "h.longitude", "b.latitude", "b.longitude")} AS km
          FROM ({P.hotspots_sql()}) h JOIN ({P.BUSINESS_SQL}) b ON abs(h.latitude - b.latitude) < 0.2
          WHERE h.hotspot_prob > 0.5) WHERE km <= 10""",
)
def radius_join(spark, folder):
    spots = P.hotspots(spark, folder).filter("hotspot_prob > 0.5")
    places = P.directory(spark, folder).select(
        "business_id",
        F.col("LATITUDE").alias("place_latitude"),
        F.col("LONGITUDE").alias("place_longitude"),
    )
    pairs = proximity.pairs_within(spots, places, 10.0, "tract_geoid", "business_id")
    return pairs.select("tract_geoid", "business_id", r("distance_km"))


@query(
    "relevance_score",
    f"SELECT business_id, business_category, cuisine_score, relevance_score FROM ({scored_sql('india')})".replace(
        " cuisine_score,", " round(cuisine_score, 6) AS cuisine_score,", 1
    ),
)
def relevance_score(spark, folder):
    scored = matching.score_businesses(P.businesses(spark, folder), "india")
    return scored.select(
        "business_id", "business_category", F.round("indian_score", 6).alias("cuisine_score"),
        r("relevance_score"),
    )


def match_sql(hotspots: str, scored: str, k: int) -> str:
    km = P.haversine_sql("h.latitude", "h.longitude", "b.latitude", "b.longitude")
    return f"""
SELECT tract_geoid, hotspot_latitude, hotspot_longitude, hotspot_probability, business_id, business_name,
       business_category, business_latitude, business_longitude, distance_km, relevance_score,
       business_employees, business_age, origin_group, round(cuisine_score, 6) AS cuisine_score,
       cast(row_number() OVER (PARTITION BY tract_geoid, origin_group {RANK}) AS integer) AS rank
FROM (
  SELECT h.tract_geoid, h.latitude AS hotspot_latitude, h.longitude AS hotspot_longitude,
         h.hotspot_prob AS hotspot_probability, b.business_id, b.business_name, b.business_category,
         b.latitude AS business_latitude, b.longitude AS business_longitude, {km} AS km,
         round({km}, 6) AS distance_km, b.relevance_score, b.employees AS business_employees,
         b.business_age, h.origin_group, b.cuisine_score
  FROM ({hotspots}) h JOIN ({scored}) b
    ON h.origin_group = b.origin_group AND abs(h.latitude - b.latitude) < 0.2
  WHERE h.hotspot_prob > 0.5)
WHERE km <= 10
QUALIFY rank <= {k}
"""


def matched(spark, folder, origins, k, **limits):
    df = matching.match_hotspots(
        P.hotspots(spark, folder, origins), P.businesses(spark, folder), origins=origins,
        max_businesses=k, **limits,
    )
    return df.select(*[r(c) if c == "cuisine_score" else c for c in df.columns])


@query("match_hotspots", match_sql(P.hotspots_sql(), scored_sql("india"), dims.MATCH_TOP_K))
def match_hotspots(spark, folder):
    return matched(spark, folder, ["india"], dims.MATCH_TOP_K)


@query("match_all_origins", match_sql(P.hotspots_sql(dims.ORIGINS), scored_sql(), 5))
def match_all_origins(spark, folder):
    return matched(spark, folder, dims.ORIGINS, 5)


@query("match_crowded", match_sql(P.hotspots_sql(["india", "peru"]), scored_sql(), 5))
def match_crowded(spark, folder):
    """The same matches by way of box pruning, as used where cells are crowded."""
    return matched(spark, folder, ["india", "peru"], 5, heavy=2)


@query("match_all_origins_full", match_sql(P.hotspots_sql(dims.ORIGINS), scored_sql(), dims.MATCH_TOP_K))
def match_all_origins_full(spark, folder):
    """All groups with as many businesses as the matches are made for."""
    return matched(spark, folder, dims.ORIGINS, dims.MATCH_TOP_K)


@query("match_crowded_full", match_sql(P.hotspots_sql(dims.ORIGINS), scored_sql(), dims.MATCH_TOP_K))
def match_crowded_full(spark, folder):
    """The same by way of box pruning."""
    return matched(spark, folder, dims.ORIGINS, dims.MATCH_TOP_K, heavy=2)


RECOMMENDATION = """
business_id, business_name, business_category, latitude, longitude, distance_km, relevance_score,
cast(employees AS integer) AS employees, business_age, round(cuisine_score, 6) AS cuisine_score,
cast(NULL AS varchar) AS address, phone"""


@query(
    "recommend_businesses",
    f"""SELECT {RECOMMENDATION}, 37.5::double AS user_latitude, -121.5::double AS user_longitude, origin_group
        FROM (SELECT *, round({USER_KM}, 6) AS distance_km FROM ({scored_sql("mexico")}) WHERE {USER_KM} <= 15
              {RANK} LIMIT 10)
        WHERE business_category IN ('food_services', 'retail_trade', 'other')""",
)
def recommend_businesses(spark, folder):
    df = matching.recommend(
        P.businesses(spark, folder), *USER, "mexico",
        business_categories=["food_services", "retail_trade", "other"],
    )
    return df.select(*[r(c) if c == "cuisine_score" else c for c in df.columns])


@query(
    "recommend_filter_first",
    f"""SELECT {RECOMMENDATION}, 37.5::double AS user_latitude, -121.5::double AS user_longitude, origin_group
        FROM (SELECT *, round({USER_KM}, 6) AS distance_km FROM ({scored_sql("mexico")}) WHERE {USER_KM} <= 15
              AND business_category IN ('food_services', 'construction') {RANK} LIMIT 10)""",
)
def recommend_filter_first(spark, folder):
    df = matching.recommend(
        P.businesses(spark, folder), *USER, "mexico",
        business_categories=["food_services", "construction"], filter_before_topk=True,
    )
    return df.select(*[r(c) if c == "cuisine_score" else c for c in df.columns])


# Every supplier asks, with its own radius, count, group and categories.
REQUESTS_SQL = f"""
SELECT cast(s_suppkey AS varchar) AS request_id,
       cast(37 AS double) + cast(s_suppkey * 7919 % 2000 AS double) / 1000 AS user_latitude,
       cast(-122 AS double) + cast(s_suppkey * 104729 % 2000 AS double) / 1000 AS user_longitude,
       {P.sql_list(dims.ORIGINS)}[cast(s_suppkey % 20 AS integer) + 1] AS origin_group,
       cast(5 + s_suppkey % 40 AS double) AS max_distance, cast(1 + s_suppkey % 12 AS integer) AS k,
       s_suppkey % 3 = 0 AS choosy
FROM supplier
"""


@query(
    "recommend_batch",
    f"""SELECT request_id, {RECOMMENDATION}, user_latitude, user_longitude, origin_group, cast(rn AS integer) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY request_id {RANK}) AS rn FROM (
                SELECT q.*, b.* EXCLUDE (origin_group), {P.haversine_sql("user_latitude", "user_longitude", "latitude", "longitude")} AS km,
                       round(km, 6) AS distance_km
                FROM ({REQUESTS_SQL}) q JOIN ({scored_sql()}) b USING (origin_group)
                WHERE abs(user_latitude - latitude) < 0.6) WHERE km <= max_distance)
        WHERE rn <= k AND (NOT choosy OR business_category IN ('food_services', 'other'))""",
)
def recommend_batch(spark, folder):
    key = F.col("s_suppkey")
    origins = text_array(dims.ORIGINS)
    requests = P.table(spark, folder, "supplier").select(
        key.cast("string").alias("request_id"),
        (F.lit(37.0) + (key * 7919 % 2000) / 1000.0).alias("latitude"),
        (F.lit(-122.0) + (key * 104729 % 2000) / 1000.0).alias("longitude"),
        F.get(origins, (key % 20).cast("int")).alias("origin_group"),
        (key % 40 + 5).cast("double").alias("max_distance"),
        (key % 12 + 1).cast("int").alias("max_recommendations"),
        F.when(key % 3 == 0, F.array(F.lit("food_services"), F.lit("other"))).alias("business_categories"),
    )
    valid, _ = serving.split_valid(serving.validate_recommendations(requests))
    df = matching.recommend_batch(valid, P.businesses(spark, folder))
    return df.select(*[r(c) if c == "cuisine_score" else c for c in df.columns])


@query(
    "predict_hotspots",
    f"""SELECT tract_geoid, latitude, longitude, hotspot_prob AS hotspot_probability,
              round(hotspot_prob * 100, 6) AS growth_prediction, origin_group, 2 AS horizon
       FROM ({P.hotspots_sql(dims.ORIGINS)}) WHERE origin_group = 'korea' AND hotspot_prob >= 0.6
       ORDER BY hotspot_prob DESC, tract_geoid LIMIT 25""",
)
def predict_hotspots(spark, folder):
    top = serving.predict_hotspots(
        P.hotspots(spark, folder, dims.ORIGINS), "korea", min_probability=0.6, limit=25
    )
    return top.select(*[r(c) if c == "growth_prediction" else c for c in top.columns])


@query(
    "predict_growth",
    f"""WITH g AS (SELECT tract_geoid, year, india_density,
                     india_density / nullif(lag(india_density) OVER (PARTITION BY tract_geoid ORDER BY year), 0) - 1 AS growth
                   FROM ({P.PANEL_SQL}))
       SELECT tract_geoid, year, round(india_density, 6) AS current_density, round(growth * 100, 6) AS predicted_growth,
              round(growth * 100 - 5, 6) AS lower, round(growth * 100 + 5, 6) AS upper, 'india' AS origin_group, 2 AS horizon
       FROM g WHERE growth IS NOT NULL AND cast(substr(tract_geoid, 1, 5) AS integer) IN
            (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name IN ('AMERICA', 'ASIA'))""",
)
def predict_growth(spark, folder):
    """All tracts of two regions; last year's growth stands in for the trained regressor's prediction."""
    features = P.panel(spark, folder)
    known = growth_rates(features, ["india"]).filter("india_growth_1yr IS NOT NULL")
    predictions = known.select("tract_geoid", "year", (F.col("india_growth_1yr") * 100).alias("predicted_growth"))
    region = P.table(spark, folder, "region").filter(F.col("r_name").isin("AMERICA", "ASIA"))
    nation = P.table(spark, folder, "nation").join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    county = nation.select(F.lpad(F.col("n_nationkey").cast("string"), 5, "0").alias("county_fips"))
    tracts = features.select("tract_geoid", F.substring("tract_geoid", 1, 5).alias("county_fips"))
    wanted = tracts.join(county, "county_fips", "left_semi").select("tract_geoid")
    df = serving.predict_growth(features, predictions, "india", tract_geoids=wanted)
    return df.select(
        "tract_geoid", "year", r("current_density"), r("predicted_growth"),
        F.round("confidence_interval.lower", 6).alias("lower"),
        F.round("confidence_interval.upper", 6).alias("upper"), "origin_group", "horizon",
    )


@query(
    "hotspot_coverage",
    f"""SELECT count(*) AS hotspots, cast(sum(CASE WHEN hit THEN 1 ELSE 0 END) AS bigint) AS covered,
              round(avg(CASE WHEN hit THEN 1 ELSE 0 END), 6) AS coverage
       FROM (SELECT h.tract_geoid, EXISTS (SELECT 1 FROM ({P.BUSINESS_SQL}) b
               WHERE abs(b.latitude - h.latitude) < 0.1
                 AND {P.haversine_sql("h.latitude", "h.longitude", "b.latitude", "b.longitude")} <= 3) AS hit
             FROM ({P.hotspots_sql()}) h WHERE hotspot_prob > 0.5)""",
)
def hotspot_coverage(spark, folder):
    businesses = P.directory(spark, folder).select(
        "business_id", F.col("LATITUDE").alias("latitude"), F.col("LONGITUDE").alias("longitude")
    )
    df = matching.hotspot_coverage(P.hotspots(spark, folder), businesses, max_distance=3.0)
    return df.select("hotspots", "covered", r("coverage"))


_MORAN = f"""
WITH v AS (SELECT tract_geoid, avg(india_density) AS x FROM ({NATION_PANEL_SQL}) GROUP BY 1),
z AS (SELECT tract_geoid, x - (SELECT avg(x) FROM v) AS z FROM v),
e AS (SELECT * FROM ({P.SQUARES_EDGES_SQL}) WHERE kind = 'rook')
SELECT count(*) AS n, (SELECT count(*) FROM e) AS weights,
       round(count(*) * 1.0::double / (SELECT count(*) FROM e)
             * (SELECT sum(a.z * b.z) FROM e JOIN z a ON a.tract_geoid = e.src JOIN z b ON b.tract_geoid = e.dst)
             / sum(z * z), 6) AS morans_i
FROM z
"""


@query("morans_i", _MORAN)
def morans_i(spark, folder):
    mean = nation_panel(spark, folder).groupBy("tract_geoid").agg(F.avg("india_density").alias("x"))
    rook = spatial.contiguity_edges(P.squares(spark, folder)).filter("kind = 'rook'")
    return spatial.morans_i(mean, rook, "x").select("n", "weights", r("morans_i"))




# --- stored layers, written and read back ---


@query("business_roundtrip", f"SELECT business_id, business_name, business_category, employees, latitude, longitude FROM ({P.BUSINESS_SQL})")
def business_roundtrip(spark, folder):
    """The business layer written twice, the second time as a whole, and read back."""
    path = f"{scratch_folder(spark, 'businesses')}/{uuid.uuid4().hex}"
    businesses = P.businesses(spark, folder)
    writers.write_businesses(businesses.limit(3), path)
    writers.write_businesses(businesses, path)
    stored = readers.read_table(spark, path)
    return stored.select("business_id", "business_name", "business_category", "employees", "latitude", "longitude")


@query(
    "score_roundtrip",
    f"SELECT tract_geoid, latitude, longitude, hotspot_prob, 'peru' AS origin_group, 2::INTEGER AS horizon "
    f"FROM ({P.hotspots_sql(['india', 'peru'])}) WHERE origin_group = 'peru'",
)
def score_roundtrip(spark, folder):
    """Scores of two groups and horizons; one of them is written anew, and the others stay."""
    path = f"{scratch_folder(spark, 'scores')}/{uuid.uuid4().hex}"
    spots = P.hotspots(spark, folder, ["india", "peru"])
    scores = spots.select("tract_geoid", "origin_group", "hotspot_prob", F.lit(2).alias("horizon"))
    writers.write_scores(scores.unionByName(scores.withColumn("horizon", F.lit(5))), path)
    writers.write_scores(scores.filter("origin_group = 'india'").withColumn("hotspot_prob", F.lit(0.0)), path)
    found = readers.read_hotspot_scores(spark, path, "peru", spots.filter("origin_group = 'peru'"), 2)
    return found.select("tract_geoid", "latitude", "longitude", "hotspot_prob", "origin_group", F.col("horizon").cast("int").alias("horizon"))


@query(
    "match_roundtrip",
    f"SELECT tract_geoid, business_id, origin_group, rank FROM ({match_sql(P.hotspots_sql(['india', 'peru']), scored_sql(), dims.MATCH_TOP_K)})",
)
def match_roundtrip(spark, folder):
    """Matches replace what an older run stored, other groups included."""
    path = f"{scratch_folder(spark, 'matches')}/{uuid.uuid4().hex}"
    found = matched(spark, folder, ["india", "peru"], dims.MATCH_TOP_K)
    writers.write_matches(found.limit(5).withColumn("origin_group", F.lit("gone")), path)
    writers.write_matches(found, path)
    return readers.read_table(spark, path).select("tract_geoid", "business_id", "origin_group", "rank")
