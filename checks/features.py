"""Panel features, labels and time flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import proxies as P
from checks.registry import query, r
from migrascope import dims
from migrascope.operators import metrics, panel

KEYS = ["tract_geoid", "year"]
GROWTH = [
    (name, column, step)
    for name, column, steps in (
        *[(o, f"{o}_density", (1, 3, 5)) for o in P.ORIGINS],
        ("foreign_born", "foreign_born_density", (1, 3)),
        ("pop", "total_pop", (1, 3)),
        ("income", "median_household_income", (1,)),
        ("rent", "median_rent", (1,)),
    )
    for step in steps
]
GROWTH_COLUMNS = [f"{name}_growth_{step}yr" for name, _, step in GROWTH]
BY_TRACT = "PARTITION BY tract_geoid ORDER BY year"


def growth_sql(source: str, before: str) -> str:
    changes = ", ".join(
        f"cast({c} AS double) / nullif({before.format(c=c, n=n)}, 0) - 1 AS {name}_growth_{n}yr"
        for name, c, n in GROWTH
    )
    return f"SELECT tract_geoid, year, {changes} FROM ({source})"


# Known values only where the year is not 1997 and the count is not a multiple of seven.
GAPPED = [f"{o}_density" for o in P.ORIGINS]
GAPPED_SQL = f"""
SELECT * REPLACE ({", ".join(f"CASE WHEN year <> 1997 AND total_pop % 7 <> 0 THEN {c} END AS {c}" for c in GAPPED)})
FROM ({P.PANEL_SQL})
"""
PADDED_SQL = f"""
SELECT * REPLACE ({", ".join(f"last_value({c} IGNORE NULLS) OVER ({BY_TRACT} ROWS UNBOUNDED PRECEDING) AS {c}" for c in GAPPED)})
FROM ({GAPPED_SQL})
"""


def gapped(spark, folder):
    known = (F.col("year") != 1997) & (F.col("total_pop") % 7 != 0)
    df = P.panel(spark, folder)
    return df.select(*[F.when(known, F.col(c)).alias(c) if c in GAPPED else c for c in df.columns])


def growth(df, **options):
    return panel.growth_rates(df, P.ORIGINS, **options).select(*KEYS, *GROWTH_COLUMNS)


@query("growth_rates", growth_sql(P.PANEL_SQL, f"lag({{c}}, {{n}}) OVER ({BY_TRACT})"))
def growth_rates(spark, folder):
    return growth(P.panel(spark, folder))


@query("growth_rates_padded", growth_sql(PADDED_SQL, f"lag({{c}}, {{n}}) OVER ({BY_TRACT})"))
def growth_rates_padded(spark, folder):
    return growth(gapped(spark, folder), pad=True)


@query(
    "growth_rates_calendar",
    growth_sql(
        f"SELECT * FROM ({P.PANEL_SQL}) WHERE year <> 1997",
        f"any_value({{c}}) OVER ({BY_TRACT} RANGE BETWEEN {{n}} PRECEDING AND {{n}} PRECEDING)",
    ),
)
def growth_rates_calendar(spark, folder):
    """A year is missing: compare by year, not by row."""
    return growth(P.panel(spark, folder).filter("year <> 1997"), calendar=True)


ROLLING = [(f"{o}_density", span) for o in P.ORIGINS for span in (3, 5)]


@query(
    "rolling_means",
    "SELECT tract_geoid, year, "
    + ", ".join(
        f"round(CASE WHEN count({c}) OVER w{n} = {n} THEN avg({c}) OVER w{n} END, 6) AS {c}_ma{n}"
        for c, n in ROLLING
    )
    + f" FROM ({GAPPED_SQL}) WINDOW w3 AS ({BY_TRACT} ROWS 2 PRECEDING), w5 AS ({BY_TRACT} ROWS 4 PRECEDING)",
)
def rolling_means(spark, folder):
    means = panel.rolling_means(gapped(spark, folder), P.ORIGINS)
    return means.select(*KEYS, *[r(f"{c}_ma{n}") for c, n in ROLLING])


INTERACTIONS = {
    "rent_income_interaction": "median_rent * median_household_income",
    "pop_housing_ratio": "cast(total_pop AS double) / nullif(total_housing_units, 0)",
    **{f"{o}_income_interaction": f"{o}_density * median_household_income" for o in P.ORIGINS},
    **{f"{o}_rent_interaction": f"{o}_density * median_rent" for o in P.ORIGINS},
    **{f"{o}_education_interaction": f"{o}_density * college_educated_rate" for o in P.ORIGINS},
}


@query(
    "interaction_features",
    "SELECT tract_geoid, year, "
    + ", ".join(f"{e} AS {n}" for n, e in INTERACTIONS.items())
    + f" FROM ({P.PANEL_SQL})",
)
def interaction_features(spark, folder):
    return panel.interaction_features(P.panel(spark, folder), P.ORIGINS).select(*KEYS, *INTERACTIONS)


SHIFTED_YEARS = list(range(2016, 2023))


@query(
    "period_dummies",
    f"""SELECT tract_geoid, year, {", ".join(f"cast(year = {y} AS integer) AS year_{y}" for y in SHIFTED_YEARS)},
              cast(year >= 2020 AS integer) AS covid_period, cast(year >= 2022 AS integer) AS post_covid_period,
              cast(year BETWEEN 2010 AND 2019 AS integer) AS decade_2010s, cast(year >= 2020 AS integer) AS decade_2020s
       FROM (SELECT tract_geoid, cast(year + 21 AS integer) AS year FROM ({P.RAW_PANEL_SQL}))""",
)
def period_dummies(spark, folder):
    shifted = P.raw_panel(spark, folder).select("tract_geoid", (F.col("year") + 21).alias("year"))
    return panel.period_dummies(shifted)


@query(
    "quarter_dummies",
    """SELECT event_id, cast(month(ts) AS integer) AS month,
              """
    + ", ".join(f"cast(quarter(ts) = {q} AS integer) AS quarter_{q}" for q in (1, 2, 3, 4))
    + " FROM events",
)
def quarter_dummies(spark, folder):
    events = P.table(spark, folder, "events").select("event_id", F.month("ts").alias("month"))
    return events.select("*", *panel.quarter_dummies(F.col("month")))


# Price per order is clipped: every order of the table takes part in the percentiles.
@query(
    "winsorize",
    """SELECT o_orderkey, round(least(greatest(o_totalprice, lo), hi), 6) AS o_totalprice
       FROM orders, (SELECT quantile_cont(o_totalprice, 0.01) AS lo, quantile_cont(o_totalprice, 0.99) AS hi FROM orders)""",
)
def winsorize(spark, folder):
    orders = P.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return metrics.winsorize(orders, "o_totalprice").select("o_orderkey", r("o_totalprice"))


HORIZON = 2
LABELLED = [*P.ORIGINS, "foreign_born"]


def future(c: str) -> str:
    return f"lead({c}_density, {HORIZON}) OVER ({BY_TRACT})"


def rate(c: str) -> str:
    return f"({future(c)} - {c}_density) / ({c}_density + 1e-8) * 100"


GROWTH_LABELS_SQL = f"""
SELECT * FROM (SELECT tract_geoid, year, {", ".join(f"{rate(c)} AS label_{c}_growth_2yr" for c in LABELLED)}
FROM ({P.PANEL_SQL})) WHERE label_foreign_born_growth_2yr IS NOT NULL
"""


@query("growth_labels", GROWTH_LABELS_SQL)
def growth_labels(spark, folder):
    df = panel.growth_labels(P.panel(spark, folder), HORIZON, P.ORIGINS)
    return df.select(*KEYS, *[panel.growth_label(c, HORIZON) for c in LABELLED])


HOTSPOT_LABELS_SQL = f"""
SELECT * FROM (SELECT tract_geoid, year, total_pop, {", ".join(
    f"CASE WHEN {future(c)} IS NOT NULL THEN CASE WHEN {future(c)} >= 50 AND {rate(c)} >= 25 "
    f"AND total_pop >= {P.PANEL_MIN_POPULATION} THEN 1 ELSE 0 END END AS label_{c}_hotspot_2yr"
    for c in LABELLED)}
FROM ({P.PANEL_SQL})) WHERE label_foreign_born_hotspot_2yr IS NOT NULL
"""


def labelled(spark, folder):
    return panel.hotspot_labels(
        P.panel(spark, folder), HORIZON, P.ORIGINS, min_population=P.PANEL_MIN_POPULATION
    )


@query("hotspot_labels", HOTSPOT_LABELS_SQL)
def hotspot_labels(spark, folder):
    return labelled(spark, folder).select(
        *KEYS, "total_pop", *[panel.hotspot_label(c, HORIZON) for c in LABELLED]
    )


@query(
    "hotspot_labels_long",
    " UNION ALL ".join(
        f"SELECT tract_geoid, year, '{c}' AS origin_group, label_{c}_hotspot_2yr AS hotspot FROM ({HOTSPOT_LABELS_SQL})"
        for c in LABELLED
    ),
)
def hotspot_labels_long(spark, folder):
    columns = {c: panel.hotspot_label(c, HORIZON) for c in LABELLED}
    return panel.unpivot_labels(labelled(spark, folder), columns, "hotspot")


@query(
    "positive_rate",
    " UNION ALL ".join(
        f"SELECT '{c}' AS origin_group, round(avg(label_{c}_hotspot_2yr), 6) AS positive_rate, "
        f"avg(label_{c}_hotspot_2yr) < {dims.LOW_POSITIVE_RATE} AS very_low FROM ({HOTSPOT_LABELS_SQL})"
        for c in LABELLED
    ),
)
def positive_rate(spark, folder):
    rates = panel.positive_rates(labelled(spark, folder), HORIZON, P.ORIGINS)
    return rates.select("origin_group", r("positive_rate"), "very_low")


