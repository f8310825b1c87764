import pytest

from migrascope.operators import metrics, panel


@pytest.fixture
def gaps(spark):
    series = [1.0, None, 0.0, 2.0, 4.0]
    return spark.createDataFrame(
        [("t", 2000 + i, v) for i, v in enumerate(series)], "tract_geoid string, year int, india_density double"
    )


def in_order(df, column):
    return [r[column] for r in df.orderBy("year").collect()]


def test_growth_plain_and_padded(gaps):
    plain = panel.growth_rates(gaps, ["india"])
    assert in_order(plain, "india_growth_1yr") == [None, None, None, None, 1.0]
    padded = panel.growth_rates(gaps, ["india"], pad=True)
    assert in_order(padded, "india_growth_1yr") == [None, 0.0, -1.0, None, 1.0]
    assert in_order(padded, "india_density") == [1.0, None, 0.0, 2.0, 4.0]


def test_rolling_mean_needs_a_full_window(gaps):
    assert in_order(panel.rolling_means(gaps, ["india"]), "india_density_ma3") == [None, None, None, None, 2.0]


def test_calendar_lag_skips_missing_years(spark):
    df = spark.createDataFrame(
        [("t", 2000, 1.0), ("t", 2002, 3.0), ("t", 2003, 6.0)], "tract_geoid string, year int, india_density double"
    )
    assert in_order(panel.growth_rates(df, ["india"]), "india_growth_1yr") == [None, 2.0, 1.0]
    assert in_order(panel.growth_rates(df, ["india"], calendar=True), "india_growth_1yr") == [None, None, 1.0]


def test_growth_names_do_not_collide_with_labels(gaps):
    df = gaps.withColumnRenamed("india_density", "foreign_born_density")
    both = panel.growth_labels(panel.growth_rates(df, []), 1, [])
    assert {"foreign_born_growth_1yr", "label_foreign_born_growth_1yr"} <= set(both.columns)


@pytest.mark.parametrize(
    "now, then, population, label", [(40.0, 60.0, 1000, 1), (49.0, 61.0, 1000, 0), (40.0, 60.0, 999, 0)]
)
def test_hotspot_thresholds(spark, now, then, population, label):
    df = spark.createDataFrame(
        [("t", 2000, now, population), ("t", 2001, then, population)],
        "tract_geoid string, year int, foreign_born_density double, total_pop int",
    )
    out = panel.hotspot_labels(df, 1, []).collect()
    assert [(r.year, r.label_foreign_born_hotspot_1yr) for r in out] == [(2000, label)]


def test_repeated_key_is_refused(spark, gaps):
    assert panel.require_unique(gaps, panel.KEYS) is gaps
    with pytest.raises(ValueError, match="repeat"):
        panel.require_unique(gaps.union(gaps), panel.KEYS)


def test_winsorize_bounds(spark):
    df = spark.createDataFrame([(float(i),) for i in range(10)], "y double")
    out = sorted(r.y for r in metrics.winsorize(df, "y").collect())
    assert out[0] == pytest.approx(0.09) and out[-1] == pytest.approx(8.91)


def test_one_shuffle_for_all_growth_windows(gaps):
    plan = panel.rolling_means(panel.growth_rates(gaps, ["india"]), ["india"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
