"""The registered training queries do the whole job; run here with small trees."""

import __spark_entry__ as entry
from checks import proxies as P
from checks import training
from migrascope import dims
from migrascope.operators import models


def test_settings_are_the_documented_ones():
    assert training.REGRESSION == models.REGRESSOR and training.CLASSIFICATION == models.CLASSIFIER


def test_every_origin_is_trained(spark, monkeypatch):
    monkeypatch.setattr(training, "REGRESSION", models.small(models.REGRESSOR, trees=1, depth=2))
    found = entry.queries()["feature_importance"](spark, entry.ENTRY_FOLDER)
    assert {r[0] for r in found.select("origin_group").distinct().collect()} == set(P.ORIGINS)


def test_every_fold_of_every_origin_keeps_its_best_trees(spark):
    small = models.replace(models.REGRESSOR, trees=40, patience=8, learning_rate=0.3)
    scores = models.cross_validate(training.growth(spark, entry.ENTRY_FOLDER), models.GROWTH, P.ORIGINS, training.HORIZON, small)
    rows = scores.collect()
    assert {(r.origin_group, r.fold) for r in rows} == {(o, k + 1) for o in P.ORIGINS for k in range(dims.CV_FOLDS)}
    assert all(r.trees_grown == min(r.trees_kept + 8, 40) for r in rows) and max(r.trees_kept for r in rows) > 1


def test_whole_matches_are_registered(spark):
    for name in ("match_all_origins_full", "match_crowded_full"):
        assert f"rank <= {dims.MATCH_TOP_K}" in entry.oracle_sql()[name]
