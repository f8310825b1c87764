"""Tract-year features. Every window shares one partitioning, so there is one shuffle by tract.

A window holds the years of one tract, one row each (``require_unique`` checks that), so its
size is bounded by the number of survey years however many tracts there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import values

KEYS = ["tract_geoid", "year"]
ORIGIN_GROWTH_STEPS = (1, 3, 5)
ROLLING_SPANS = (3, 5)
# Other columns with growth rates: output prefix, source column, steps.
OTHER_GROWTH = [
    ("foreign_born", "foreign_born_density", (1, 3)),
    ("pop", "total_pop", (1, 3)),
    ("income", "median_household_income", (1,)),
    ("rent", "median_rent", (1,)),
]


def by_tract():
    return Window.partitionBy("tract_geoid").orderBy("year")


def require_unique(df: DataFrame, keys: list[str]) -> DataFrame:
    """Fail on a repeated key: row-based lags and county joins would silently go wrong."""
    repeated = df.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if repeated:
        raise ValueError(f"keys {keys} repeat, e.g. {[r.asDict() for r in repeated]}")
    return df


def join_industry(panel: DataFrame, wide: DataFrame) -> DataFrame:
    """Attach the county's industry columns to each tract-year; unmatched rows keep NULLs.

    No broadcast hint: Spark broadcasts the county side when its measured size allows and
    otherwise shuffles, splitting a county with very many tracts.
    """
    keyed = panel.withColumn("county_fips", F.substring("tract_geoid", 1, 5))
    return keyed.join(wide, ["county_fips", "year"], "left")


def _growth_sources(df: DataFrame, origins: list[str]) -> list[tuple[str, str, tuple[int, ...]]]:
    sources = [(o, f"{o}_density", ORIGIN_GROWTH_STEPS) for o in origins] + OTHER_GROWTH
    return [s for s in sources if s[1] in df.columns]


def growth_rates(
    df: DataFrame, origins: list[str] | None = None, pad: bool = False, calendar: bool = False
) -> DataFrame:
    """Relative change against the row 1, 3 or 5 places earlier in the tract.

    ``pad`` fills gaps with the last known value first. ``calendar`` compares with the row of
    exactly that many years earlier instead of counting rows.
    """
    sources = _growth_sources(df, origins or dims.ORIGINS)
    window = by_tract()
    read = df
    filled = {source: source for _, source, _ in sources}
    if pad:
        so_far = window.rowsBetween(Window.unboundedPreceding, 0)
        filled = {source: f"__{source}" for source in filled}
        read = df.select(
            "*", *[F.last(s, ignorenulls=True).over(so_far).alias(f) for s, f in filled.items()]
        )

    def change(column: str, step: int) -> Column:
        now = F.col(column)
        if calendar:
            before = F.first(column).over(window.rangeBetween(-step, -step))
        else:
            before = F.lag(column, step).over(window)
        return values.ratio(now, before) - F.lit(1.0)

    rates = [
        change(filled[source], step).alias(f"{name}_growth_{step}yr")
        for name, source, steps in sources
        for step in steps
    ]
    return read.select(*df.columns, *rates)


def rolling_means(df: DataFrame, origins: list[str] | None = None) -> DataFrame:
    """Mean over the last 3 and 5 rows; NULL until the span is full of known values."""
    window = by_tract()
    means = []
    for origin in origins or dims.ORIGINS:
        column = f"{origin}_density"
        if column not in df.columns:
            continue
        for span in ROLLING_SPANS:
            frame = window.rowsBetween(1 - span, 0)
            full = F.count(column).over(frame) == span
            means.append(F.when(full, F.avg(column).over(frame)).alias(f"{column}_ma{span}"))
    return df.select("*", *means)


def interaction_features(df: DataFrame, origins: list[str] | None = None) -> DataFrame:
    """Products of income, rent, education and origin densities; people per housing unit."""
    have = set(df.columns)
    out = []
    if {"median_rent", "median_household_income"} <= have:
        out.append(
            (F.col("median_rent") * F.col("median_household_income")).alias("rent_income_interaction")
        )
    if {"total_pop", "total_housing_units"} <= have:
        out.append(
            values.ratio(F.col("total_pop"), F.col("total_housing_units")).alias("pop_housing_ratio")
        )
    partners = {
        "income": "median_household_income",
        "rent": "median_rent",
        "education": "college_educated_rate",
    }
    for origin in origins or dims.ORIGINS:
        density = f"{origin}_density"
        for label, partner in partners.items():
            if {density, partner} <= have:
                out.append((F.col(density) * F.col(partner)).alias(f"{origin}_{label}_interaction"))
    return df.select("*", *out)


def period_dummies(df: DataFrame, years: list[int] | None = None) -> DataFrame:
    """One column per year plus pandemic and decade flags; quarters too when there is a month."""
    if years is None:
        years = sorted(r.year for r in df.select("year").distinct().collect() if r.year is not None)
    year = F.col("year")
    out = [values.flag(year == y).alias(f"year_{y}") for y in years]
    out += [
        values.flag(year >= 2020).alias("covid_period"),
        values.flag(year >= 2022).alias("post_covid_period"),
        values.flag((year >= 2010) & (year < 2020)).alias("decade_2010s"),
        values.flag(year >= 2020).alias("decade_2020s"),
    ]
    if "month" in df.columns:
        out += quarter_dummies(F.col("month"))
    return df.select("*", *out)


def quarter_dummies(month: Column) -> list[Column]:
    return [
        values.flag(month.between(3 * q - 2, 3 * q)).alias(f"quarter_{q}") for q in (1, 2, 3, 4)
    ]


def sanitize(df: DataFrame, columns: list[str]) -> DataFrame:
    """Model inputs as doubles with NULL, NaN and infinities set to 0."""
    chosen = set(columns)
    return df.select(
        *[values.finite_or_zero(F.col(c)).alias(c) if c in chosen else F.col(c) for c in df.columns]
    )


def _future_growth(column: str, horizon: int) -> tuple[Column, Column]:
    future = F.lead(column, horizon).over(by_tract())
    now = F.col(column)
    return future, values.ratio(future - now, now + F.lit(dims.LABEL_EPSILON)) * F.lit(100.0)


def _label_sources(df: DataFrame, origins: list[str]) -> dict[str, str]:
    names = {o: f"{o}_density" for o in [*origins, "foreign_born"]}
    return {name: column for name, column in names.items() if column in df.columns}


def growth_label(name: str, horizon: int) -> str:
    return f"label_{name}_growth_{horizon}yr"


def hotspot_label(name: str, horizon: int) -> str:
    return f"label_{name}_hotspot_{horizon}yr"


def growth_labels(df: DataFrame, horizon: int = 2, origins: list[str] | None = None) -> DataFrame:
    """Percent growth to the row ``horizon`` places ahead; rows without a future are dropped."""
    labels = [
        _future_growth(column, horizon)[1].alias(growth_label(name, horizon))
        for name, column in _label_sources(df, origins or dims.ORIGINS).items()
    ]
    return df.select("*", *labels).filter(F.col(growth_label("foreign_born", horizon)).isNotNull())


def hotspot_labels(
    df: DataFrame,
    horizon: int = 2,
    origins: list[str] | None = None,
    density: float = dims.HOTSPOT_DENSITY,
    growth: float = dims.HOTSPOT_GROWTH,
    min_population: int = dims.HOTSPOT_MIN_POPULATION,
) -> DataFrame:
    """1 where the future density, its growth and the population all reach their thresholds.

    The label is NULL without a future row, and rows whose overall label is NULL are dropped.
    """
    labels = []
    for name, column in _label_sources(df, origins or dims.ORIGINS).items():
        future, rate = _future_growth(column, horizon)
        reached = (future >= density) & (rate >= growth) & (F.col("total_pop") >= min_population)
        labels.append(F.when(future.isNotNull(), values.flag(reached)).alias(hotspot_label(name, horizon)))
    return df.select("*", *labels).filter(F.col(hotspot_label("foreign_born", horizon)).isNotNull())


def unpivot_labels(
    df: DataFrame, columns: dict[str, str], value: str, name: str = "origin_group"
) -> DataFrame:
    """Long form: one row per tract, year and origin group."""
    pairs = ", ".join(f"'{group}', `{column}`" for group, column in columns.items())
    return df.select(*KEYS, F.expr(f"stack({len(columns)}, {pairs}) as (`{name}`, `{value}`)"))


def positive_rates(df: DataFrame, horizon: int = 2, origins: list[str] | None = None) -> DataFrame:
    """Share of positive hotspot labels per origin group, with a flag for very rare ones.

    All groups are averaged in one pass over the wide table; only the one result row is unpivoted.
    """
    names = [*(origins or dims.ORIGINS), "foreign_born"]
    columns = {n: hotspot_label(n, horizon) for n in names if hotspot_label(n, horizon) in df.columns}
    rates = df.agg(*[F.avg(c).alias(n) for n, c in columns.items()])
    pairs = ", ".join(f"'{n}', `{n}`" for n in columns)
    long = rates.select(F.expr(f"stack({len(columns)}, {pairs}) as (origin_group, positive_rate)"))
    return long.select("*", (F.col("positive_rate") < dims.LOW_POSITIVE_RATE).alias("very_low"))
