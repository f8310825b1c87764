"""Boosting over histograms: against a fit that tries every split of every leaf, in both ways of running it."""

import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from migrascope.operators import attribution, boosting, isotonic, models
from migrascope.operators.boosting import Settings, Spec

SMALL = Settings(trees=6, learning_rate=0.3, leaves=5, min_rows=4, row_share=1.0, feature_share=1.0, bins=200, loss="squared", patience=3)


def data(n=90, seed=3):
    r = np.random.default_rng(seed)
    x = np.round(r.normal(size=(3, n)), 1)
    y = 3 * x[0] + np.where(x[1] > 0.4, 2.0, -1.0) * x[2] + r.normal(size=n) * 0.3
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, *(float(v) for v in x[:, i]), float(y[i]), i % 3) for i in range(len(y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, y double, fold int").repartition(parts)


def brute(x, y, settings, loss="squared", delta=math.inf, weights=(1.0, 1.0), start=None):
    """Scores after all trees: the best leaf and split of all is taken, one after another."""
    score = np.full(len(y), y.mean() if start is None else start)
    for _ in range(settings.trees):
        if loss == "logistic":
            p = 1 / (1 + np.exp(-score))
            w = np.where(y > 0, weights[1], weights[0])
            g, h = w * (p - y), w * p * (1 - p)
        else:
            g, h = np.clip(score - y, -delta, delta), np.ones(len(y))
        shrink = lambda s: math.copysign(max(abs(s) - settings.l1, 0), s)
        worth = lambda rows: shrink(g[rows].sum()) ** 2 / (h[rows].sum() + settings.l2)
        leaves = [np.arange(len(y))]
        while len(leaves) < settings.leaves:
            best = None
            for k, rows in enumerate(leaves):
                for f in range(len(x)):
                    for cut in np.unique(x[f, rows])[:-1]:
                        low, high = rows[x[f, rows] <= cut], rows[x[f, rows] > cut]
                        if min(len(low), len(high)) < settings.min_rows:
                            continue
                        gain = worth(low) + worth(high) - worth(rows)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = gain, k, low, high
            if best is None:
                break
            leaves[best[1] : best[1] + 1] = best[2:]
        for rows in leaves:
            score[rows] -= settings.learning_rate * shrink(g[rows].sum()) / (h[rows].sum() + settings.l2)
    return score


def fitted(df, settings, specs=None, **options):
    return boosting.fit(df, ["a", "b", "c"], ["y"], ["fold"], "id", specs or [Spec("m", 0)], settings, **options)


@pytest.mark.parametrize("gathered", [0, 10**9])
@pytest.mark.parametrize("loss", ["squared", "huber", "logistic"])
def test_against_brute_force(spark, loss, gathered):
    x, y = data()
    options = {}
    if loss == "logistic":
        y = (y > 0.7).astype(float)
        options = {"weights": (len(y) / (2 * (y == 0).sum()), len(y) / (2 * y.sum())), "start": 0.0}
    if loss == "huber":
        options = {"delta": 1.5}
    settings = replace(SMALL, loss=loss)
    forest, _ = fitted(frame(spark, x, y), settings, deltas=[1.5], gathered_bytes=gathered)["m"]
    assert forest.trees == 6 and max(np.diff(forest.offset)) == 2 * SMALL.leaves - 1
    assert np.allclose(forest.margin(x), brute(x, y, settings, loss, **options), atol=1e-9)


def test_both_ways_give_the_same_trees(spark):
    x, y = data(300)
    settings = replace(SMALL, trees=12, leaves=9, row_share=0.7, feature_share=0.7, bins=16, loss="huber")
    specs = [Spec("all", 0), *(Spec(f"{k}", 0, 0, k, early=True) for k in range(3))]
    one = fitted(frame(spark, x, y), settings, specs, deltas=[2.0], gathered_bytes=0)
    two = fitted(frame(spark, x, y, 1), settings, specs, deltas=[2.0])
    for name in one:
        (a, curve_a), (b, curve_b) = one[name], two[name]
        assert (a.feature == b.feature).all() and (a.threshold == b.threshold).all() and np.allclose(a.value, b.value)
        assert np.allclose(curve_a, curve_b)
        assert sum(a.cover[a.offset[i]] for i in range(a.trees)) < a.trees * 300


def test_patience_outlasts_a_rise(spark):
    """The error on the left-out fold rises and then falls: more than one tree stays."""
    spec, settings = Spec("m", 0, 0, 1, early=True), replace(SMALL, trees=50, patience=4)
    out, errors = boosting.Fitted(spec), [5, 6, 7, 4, 3, 4, 5, 6, 7]
    goes = [out.add(None, e, 1, settings) for e in errors]
    assert goes == [True] * 8 + [False] and len(out.trees) == 5 and out.curve == errors


def test_fold_models_keep_the_best_trees(spark):
    x, y = data(300)
    settings = replace(SMALL, trees=200, patience=10)
    specs = [Spec(f"{k}", 0, 0, k, early=True) for k in range(3)]
    for k, (forest, curve) in fitted(frame(spark, x, y), settings, specs).items():
        held = np.arange(300) % 3 == int(k)
        assert 5 < forest.trees < 200 and forest.trees == int(np.argmin(curve)) + 1 and len(curve) == forest.trees + 10
        assert abs(np.abs(forest.margin(x[:, held]) - y[held]).mean() - min(curve)) < 1e-9


def test_nulls_few_rows_and_one_class(spark):
    x, y = data(20)
    df = frame(spark, x, y).withColumn("y", F.when(F.col("id") > 2, F.col("y")))
    forest, curve = fitted(df, replace(SMALL, min_rows=50))["m"]
    assert forest.trees == 6 and curve == [] and set(forest.left) == {-1}
    one = fitted(frame(spark, x, np.ones(20)), replace(SMALL, loss="logistic"))["m"][0]
    assert (one.predict(x) > 0.99).all()
    with pytest.raises(ValueError, match="no rows"):
        fitted(df.limit(0), SMALL)


def test_attributions_against_all_subsets(spark):
    r = np.random.default_rng(1)
    x = r.normal(size=(4, 120))
    y = x[0] * x[1] + np.where(x[2] > 0, x[3], -x[0])
    rows = [(i, *(float(v) for v in x[:, i]), float(y[i])) for i in range(120)]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, d double, y double")
    names = ["a", "b", "c", "d"]
    forest = boosting.fit(df, names, ["y"], [], "id", [Spec("m", 0)], replace(SMALL, trees=8, leaves=12, bins=30))["m"][0]

    def expected(row, known):
        total = forest.start
        for i in range(forest.trees):
            tree, cuts = forest.tree(i)

            def value(node):
                if tree.left[node] < 0:
                    return tree.value[node]
                children = tree.left[node], tree.right[node]
                if tree.feature[node] in known:
                    return value(children[0] if row[tree.feature[node]] <= cuts[node] else children[1])
                covers = [tree.cover[c] for c in children]
                return sum(value(c) * w for c, w in zip(children, covers)) / sum(covers)

            total += value(0)
        return total

    base, parts = attribution.explained(forest, x)
    assert np.allclose(base + parts.sum(axis=0), forest.margin(x))
    for k in range(0, 120, 17):
        for f in range(4):
            others = [g for g in range(4) if g != f]
            own = 0.0
            for mask in range(8):
                some = {g for j, g in enumerate(others) if mask >> j & 1}
                weight = math.factorial(len(some)) * math.factorial(3 - len(some)) / 24
                own += weight * (expected(x[:, k], some | {f}) - expected(x[:, k], some))
            assert abs(own - parts[f, k]) < 1e-9
    rows = attribution.attributions(df, forest, ["id"]).orderBy("id").collect()
    assert np.allclose([r["shap_b"] for r in rows], parts[1]) and np.allclose(rows[0]["base"], base)


def test_stored_forest_and_wide_scoring(spark, tmp_path):
    x, y = data()
    df = frame(spark, x, y)
    forest = fitted(df, replace(SMALL, loss="logistic"))["m"][0]
    forest.save(spark, str(tmp_path / "m"))
    again = boosting.Forest.load(spark, str(tmp_path / "m"))
    scored = boosting.add_scores(df.withColumn("a", F.when(F.col("id") != 5, F.col("a"))), {f"p{i}": f for i, f in enumerate([forest, again] * 10)})
    x[0, 5] = 0.0  # a null counts as 0
    for r in scored.collect():
        assert abs(r["p0"] - forest.predict(x)[r["id"]]) < 1e-12 and r["p19"] == r["p0"]


@pytest.mark.parametrize("pool_rows", [10**6, 7])
def test_isotonic_equals_the_fit_of_the_engine(spark, pool_rows):
    from pyspark.ml.regression import IsotonicRegression

    r = np.random.default_rng(2)
    x = np.round(r.uniform(size=300), 2)
    rows = [(g, float(v), float(v * g + r.normal() * 0.4), float(r.integers(1, 4))) for g in (0, 1) for v in x]
    rows += [(2, float(i), float(-i), 1.0) for i in range(100)] + [(0, None, 1.0, 1.0)]
    df = spark.createDataFrame(rows, "g int, x double, y double, w double")
    pools = isotonic.pools(df, ["g"], "x", "y", "w", pool_rows)
    grid = spark.range(-20, 121).select((F.col("id") / 100).alias("x"))
    for g in (0, 1, 2):
        own = df.filter((F.col("g") == g) & F.col("x").isNotNull())
        points = own.groupBy("x").agg((F.sum(F.col("y") * F.col("w")) / F.sum("w")).alias("y"), F.sum("w").alias("w"))
        model = IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w").fit(points)
        wanted = {r.x: r.prediction for r in model.transform(grid).collect()}
        mine = pools.filter(F.col("g") == g).select("lo", "hi", "value")
        for shared in (10**6, 0):
            fit = isotonic.IsotonicMap.of(mine, shared)
            got = {r.x: r.out for r in isotonic.add_mapped(grid, {"out": ("x", fit)}).collect()}
            assert got.keys() == wanted.keys() and all(abs(got[k] - wanted[k]) < 1e-9 for k in got)


def test_folds_are_balanced(spark):
    from migrascope.operators import folds

    r = np.random.default_rng(4)
    sizes = [400, 90, 90, 1] + r.integers(1, 30, 60).tolist()
    df = spark.createDataFrame([(g, int(i < s * 0.3)) for g, s in enumerate(sizes) for i in range(s)], "g int, y int")
    loads = [0] * 5
    for s in sorted(sizes, reverse=True):
        loads[loads.index(min(loads))] += s
    got = folds.balanced_group_folds(df, "g")
    assert sorted(r["count"] for r in got.groupBy("fold").count().collect()) == sorted(loads)
    assert got.groupBy("g").agg(F.count_distinct("fold").alias("k")).filter("k > 1").isEmpty() and got.count() == sum(sizes)
    table = folds.label_fold_table(df.filter("g <> 0"), "g", "y")
    shares = df.join(table, "g").groupBy("fold").agg(F.avg("y").alias("rate"), F.sum("y").alias("ones")).collect()
    total = df.filter("g <> 0 AND y = 1").count()
    assert len(shares) == 5 and all(abs(s.ones - total / 5) <= 27 for s in shares)


@pytest.mark.parametrize(("size", "groups"), [(3, 0), (3, 2), (7, 100), (1, 10**6), (5, 12)])
def test_bulk_filling_is_the_greedy_one(size, groups):
    from migrascope.operators import folds

    start = [0, 11, 500, 3, 11]
    loads = list(start)
    for _ in range(min(groups, 20_000)):
        loads[loads.index(min(loads))] += size
    taken = folds.fill(start, size, groups)
    assert sum(taken) == groups
    if groups <= 20_000:
        assert [a + size * n for a, n in zip(start, taken)] == loads


def test_many_columns_quantiles(spark):
    from migrascope.operators.metrics import winsorize, winsorize_many
    from migrascope.operators.order_stats import quantiles, quantiles_of_many

    r = np.random.default_rng(5)
    rows = [(float(r.integers(0, 20)), float(r.normal()), None if i % 3 else float(i), None) for i in range(211)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    found = quantiles_of_many(df, ["a", "b", "c", "d"], [0.01, 0.5, 0.99], 50)
    assert set(found) == {"a", "b", "c"} and all(np.allclose(found[c], quantiles(df, c, [0.01, 0.5, 0.99])) for c in found)
    both = winsorize_many(df, ["a", "b"])
    for c in ("a", "b"):
        assert sorted(r[c] for r in both.collect()) == sorted(r[c] for r in winsorize(df, c).collect())
    assert both.select("c").exceptAll(df.select("c")).isEmpty() and quantiles_of_many(df, [], [0.5]) == {}


def test_settings_are_the_documented_ones():
    assert (models.REGRESSOR.trees, models.CLASSIFIER.trees) == (1200, 1000) and models.REGRESSOR.leaves == 64
    assert models.REGRESSOR.patience == models.CLASSIFIER.patience == 100 and models.REGRESSOR.loss == "huber"
