import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from migrascope.operators import folds, metrics, order_stats


@pytest.fixture
def four(spark):
    return spark.createDataFrame(
        [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "y int, p double"
    ).withColumn("g", F.lit("all"))


def test_known_scores(four):
    row = metrics.classification_metrics(four, "y", "p").first()
    assert row.roc_auc == 0.75 and row.pr_auc == pytest.approx(5 / 6) and row.brier_score == pytest.approx(0.158125)
    assert metrics.roc_auc(four, "y", "p", ["g"]).first().roc_auc == 0.75
    assert metrics.average_precision(four, "y", "p").first().average_precision == pytest.approx(5 / 6)


def test_one_class_gives_null(four):
    assert metrics.roc_auc(four.filter("y = 1"), "y", "p").first().roc_auc is None


@pytest.mark.parametrize("range_rows", [3, 10_000])
def test_auc_with_hot_value_equals_pair_count(spark, range_rows):
    rng = random.Random(1)
    data = [(rng.randint(0, 1), 0.5 if i % 3 == 0 else round(rng.random(), 2)) for i in range(400)]
    df = spark.createDataFrame(data, "y int, p double")
    pos = [p for y, p in data if y]
    neg = [p for y, p in data if not y]
    wins = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    assert metrics.roc_auc(df, "y", "p", range_rows=range_rows).first().roc_auc == pytest.approx(wins)
    curve = metrics.pr_curve(df, "y", "p", range_rows=range_rows).collect()
    assert len(curve) == len({p for _, p in data}) + 1
    assert min(r.recall for r in curve) == 0.0 and max(r.recall for r in curve) == 1.0


@pytest.mark.parametrize("range_rows", [2, 7, 10_000])
def test_quantiles_equal_numpy(spark, range_rows):
    rng = random.Random(2)
    values = [rng.choice([1.0, 2.0, rng.gauss(0, 5)]) for _ in range(500)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),)], "v double")
    probs = [0.0, 0.01, 0.2, 0.5, 0.99, 1.0]
    assert order_stats.quantiles(df, "v", probs, range_rows) == pytest.approx(list(np.quantile(values, probs)))
    assert order_stats.quantiles(df.limit(0), "v", probs) is None


def test_running_totals_per_group(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), (F.col("id") % 7).cast("double").alias("v"))
    out = order_stats.running_totals(df, "v", {"n": F.count(F.lit(1))}, ["g"], range_rows=4)
    for g in range(3):
        rows = sorted((r.v, r.n, r.n_below, r.n_total) for r in out.filter(F.col("g") == g).collect())
        below = 0
        for _, n, n_below, total in rows:
            assert n_below == below
            below += n
        assert below == total == len(range(g, 100, 3))


def test_equal_values_share_a_bucket(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 2, 3, 4, 5, 6, 7, 8, 9)], "v double")
    rows = metrics.quantile_buckets(df, "v", list("abcde"), "b").orderBy("v").collect()
    assert "".join(r.b for r in rows) == "aaabccddee"


def test_report_of_an_empty_class_is_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "y int, p int")
    rows = {r["class"]: r for r in metrics.classification_report(df, "y", "p").collect()}
    assert rows["1"].precision == 0.0 and rows["1"].f1 == 0.0 and rows["0"].recall == 1.0
    assert rows["accuracy"].f1 == pytest.approx(2 / 3) and rows["macro avg"].support == 3
    cells = {(r.actual, r.predicted): r.n for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 2, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0), (4.0, None)], "y double, p double")
    row = metrics.regression_metrics(df, "y", "p").first()
    assert row.n == 3 and row.mae == pytest.approx(1 / 3) and row.r2 == pytest.approx(0.5)


def test_folds_keep_groups_together_and_balanced(spark):
    df = spark.range(2000).select(
        (F.col("id") % 500).alias("tract"), F.when(F.col("id") % 500 < 58, 1).otherwise(0).alias("y")
    )
    plain = folds.group_folds(df, "tract").groupBy("tract").agg(F.countDistinct("fold").alias("n"))
    assert plain.filter("n > 1").count() == 0
    table = folds.stratified_fold_table(df, "tract", "y")
    sizes = {}
    for r in table.groupBy("stratum", "fold").count().collect():
        sizes.setdefault(r.stratum, []).append(r["count"])
    assert sorted(sizes[1]) == [11, 11, 12, 12, 12] and max(sizes[0]) - min(sizes[0]) <= 1
    assert folds.stratified_group_folds(df, "tract", "y").count() == 2000


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 58 + [(1,)] * 341, "y int")
    found = {r.label: r.weight for r in folds.balanced_weights(df, "y").collect()}
    assert found[0] == pytest.approx(3.439655, abs=1e-6) and found[1] == pytest.approx(0.585044, abs=1e-6)


def test_sample_is_repeatable_and_bounded(spark):
    df = spark.range(50)
    first = [r.id for r in order_stats.sample_rows(df, "id", 10).collect()]
    again = [r.id for r in order_stats.sample_rows(df.repartition(7), "id", 10).collect()]
    assert first == again and len(set(first)) == 10
    assert order_stats.sample_rows(df, "id", 100).count() == 50
