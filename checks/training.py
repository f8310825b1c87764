"""Models on the panel, with the documented settings, for every origin group.

SQL gives what does not hang on the trees: rows, clipped targets, folds, and that predictions lie where they must. The
trees themselves are tested against a brute-force fit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks import features as feature_checks
from checks import proxies as P
from checks.registry import query
from migrascope import dims
from migrascope.operators import attribution, isotonic, models, panel, serving
from migrascope.operators import folds as fold_ops
from migrascope.operators import metrics as metric_ops
from migrascope.plans import layers

HORIZON = 2
REGRESSION = models.REGRESSOR
CLASSIFICATION = models.CLASSIFIER
KEYS = models.KEYS
HOTSPOT_GROUPS = [*P.ORIGINS, "foreign_born"]
# Of the targets' span by which a prediction may lie outside it: later trees, fitted for other rows, may push a row
# over its end. Measured: 0.10 on sf0.001 (targets of 0 and 1e13), 0.02 on sf0.01.
SLACK = 0.25


def features(spark, folder):
    """Model features of the whole panel, stored once so that training does not redo the joins."""
    models.ensure_checkpoint_dir(spark)
    built = layers.build_features(P.panel(spark, folder), origins=P.ORIGINS)
    return built.checkpoint()


def growth(spark, folder) -> DataFrame:
    return panel.growth_labels(features(spark, folder), HORIZON, P.ORIGINS)


def hotspots(spark, folder) -> DataFrame:
    return panel.hotspot_labels(features(spark, folder), HORIZON, P.ORIGINS, min_population=P.PANEL_MIN_POPULATION)


def final_models(labelled: DataFrame, family: models.Family, origins: list[str], settings: models.TreeSettings):
    """The training rows of all groups and the model of each group that is fitted on all of them."""
    models.ensure_checkpoint_dir(labelled.sparkSession)
    inputs = models.feature_columns(labelled.columns, family.business_last)
    frame = models.training_frame(labelled, family, origins, HORIZON, inputs, dims.CV_FOLDS)
    specs = [s for s in models.specs_of(family, origins, 0) if s.name.endswith("/all")]
    fitted = models._fit(frame, family, origins, inputs, specs, settings)
    return frame, {o: fitted[f"{o}/all"][0] for o in origins}


def long_rows(frame: DataFrame, origins: list[str], *values: str) -> DataFrame:
    """A row for each group, tract and year with a target; ``values`` are prefixes of a column per group."""
    rows = F.array(*[
        F.struct(F.lit(o).alias("origin_group"), F.col(f"__y_{o}").alias("target"), *(F.col(f"{v}{o}").alias(v.strip("_")) for v in values))
        for o in origins
    ])
    return frame.select(*KEYS, F.inline(rows)).filter("target IS NOT NULL")


def clipped_sql(group: str) -> str:
    column = f"label_{group}_growth_2yr"
    return f"""
    SELECT tract_geoid, year, '{group}' AS origin_group, least(greatest(y, low), high) AS target
    FROM (SELECT *, coalesce(quantile_cont(y, 0.01) OVER (), 0) AS low, coalesce(quantile_cont(y, 0.99) OVER (), 0) AS high
          FROM (SELECT tract_geoid, year, {column} AS y FROM ({feature_checks.GROWTH_LABELS_SQL})) WHERE y IS NOT NULL)"""


GROWTH_ROWS_SQL = " UNION ALL ".join(f"({clipped_sql(o)})" for o in P.ORIGINS)
HOTSPOT_ROWS_SQL = " UNION ALL ".join(
    f"SELECT tract_geoid, year, '{o}' AS origin_group, label_{o}_hotspot_2yr AS target FROM ({feature_checks.HOTSPOT_LABELS_SQL})"
    for o in HOTSPOT_GROUPS
)


@query("train_growth_regressor", f"SELECT tract_geoid, year, origin_group, round(sign(target) * ln(1 + abs(target)), 6) AS log_target, true AS in_range FROM ({GROWTH_ROWS_SQL})")
def train_growth_regressor(spark, folder):
    """All groups' final models; ``in_range``: the prediction lies in the span of the group's targets, or near it."""
    frame, forests = final_models(growth(spark, folder), models.GROWTH, P.ORIGINS, REGRESSION)
    scored = models.boosting.add_scores(frame, {f"__p_{o}": f for o, f in forests.items()})
    rows = long_rows(scored, P.ORIGINS, "__p_").checkpoint()
    spans = rows.groupBy("origin_group").agg(F.min("target").alias("low"), F.max("target").alias("high"))
    slack = (F.col("high") - F.col("low")) * SLACK
    inside = (F.col("p") >= F.col("low") - slack) & (F.col("p") <= F.col("high") + slack)
    log_target = F.round(F.signum("target") * F.log(1 + F.abs("target")), 6).alias("log_target")  # targets reach 1e12
    return rows.join(spans, "origin_group").select(*KEYS, "origin_group", log_target, inside.alias("in_range"))


@query("train_growth_huber")
def train_growth_huber(spark, folder):
    """The robust linear alternative."""
    labelled = growth(spark, folder)
    inputs = models.feature_columns(labelled.columns)
    frame = models.training_frame(labelled, models.GROWTH, P.ORIGINS, HORIZON, inputs, dims.CV_FOLDS)
    out = None
    for o in P.ORIGINS:
        rows = frame.withColumn("target", F.col(f"__y_{o}")).filter("target IS NOT NULL")
        scored = models.linear_huber(inputs).fit(rows).transform(rows)
        part = scored.select(F.lit(o).alias("origin_group"), *KEYS, "target", "prediction")
        out = part if out is None else out.unionByName(part)
    return out


@query("train_hotspot_classifier", f"SELECT tract_geoid, year, origin_group, target, true AS in_range FROM ({HOTSPOT_ROWS_SQL})")
def train_hotspot_classifier(spark, folder):
    """Final models of all foreign-born and of every group; ``in_range``: the probability lies between 0 and 1."""
    frame, forests = final_models(hotspots(spark, folder), models.HOTSPOT, HOTSPOT_GROUPS, CLASSIFICATION)
    scored = models.boosting.add_scores(frame, {f"__p_{o}": f for o, f in forests.items()})
    rows = long_rows(scored, HOTSPOT_GROUPS, "__p_")
    return rows.select(*KEYS, "origin_group", F.col("target").cast("int").alias("target"), F.col("p").between(0.0, 1.0).alias("in_range"))


FOLD_ROWS_SQL = f"""
WITH RECURSIVE sizes AS (SELECT tract_geoid, count(*) AS n FROM ({feature_checks.GROWTH_LABELS_SQL}) GROUP BY 1),
placed AS (SELECT *, row_number() OVER (ORDER BY n DESC) AS i FROM sizes),
dealt AS (
  SELECT 0::BIGINT AS i, [0::BIGINT FOR k IN range({dims.CV_FOLDS})] AS loads
  UNION ALL
  SELECT p.i, list_transform(loads, lambda x, k: CASE WHEN k = list_position(loads, list_min(loads)) THEN x + n ELSE x END)
  FROM dealt d JOIN placed p ON p.i = d.i + 1)
"""


@query(
    "cross_validate",
    f"""{FOLD_ROWS_SQL}
    SELECT o.origin_group, f.k::INTEGER AS fold, l.loads[f.k]::BIGINT AS rows_in_fold, true AS scored, true AS kept_within
    FROM (SELECT unnest({P.ORIGINS!r}) AS origin_group) o, (SELECT loads FROM dealt ORDER BY i DESC LIMIT 1) l,
         range(1, {dims.CV_FOLDS} + 1) f(k)""",
)
def cross_validate(spark, folder):
    """Tract-disjoint folds of every group: rows of the fold, whether all its scores are there and fit together, and
    whether the trees kept are those up to the least error, patience later than which growth ended."""
    labelled = growth(spark, folder)
    scores = models.cross_validate(labelled, models.GROWTH, P.ORIGINS, HORIZON, REGRESSION)
    sizes = fold_ops.balanced_group_folds(labelled.select("tract_geoid"), "tract_geoid").groupBy((F.col("fold") + 1).alias("fold")).agg(
        F.count(F.lit(1)).alias("rows_in_fold")
    )
    fits = (F.col("mae") >= 0) & (F.col("rmse") >= F.col("mae") - 1e-6) & (F.coalesce("r2", F.lit(0.0)) <= 1)
    last = F.least(F.col("trees_kept") + REGRESSION.patience, F.lit(REGRESSION.trees))
    kept = (F.col("trees_kept") >= 1) & (F.col("trees_grown") == last)
    return scores.join(sizes, "fold").select("origin_group", "fold", "rows_in_fold", fits.alias("scored"), kept.alias("kept_within"))


@query(
    "calibrate_isotonic",
    f"SELECT tract_geoid, year, origin_group, target, true AS in_range, true AS rising FROM ({HOTSPOT_ROWS_SQL})",
)
def calibrate_isotonic(spark, folder):
    """Calibrated probabilities of all groups: between 0 and 1, and rising with each member's own probability."""
    frame, calibrated = models.calibrate(hotspots(spark, folder), HOTSPOT_GROUPS, HORIZON, CLASSIFICATION)
    scored = models.add_probabilities(frame, {f"__p_{o}": c for o, c in calibrated.items()}, {f"__p_{o}": f"{o}_" for o in HOTSPOT_GROUPS}).checkpoint()
    members = range(dims.CALIBRATION_FOLDS)
    pairs = F.array(*[
        F.struct(F.lit(o).alias("origin_group"), F.lit(i).alias("member"), F.col(f"{o}_raw_{i}").alias("raw"), F.col(f"{o}_calibrated_{i}").alias("mapped"))
        for o in HOTSPOT_GROUPS for i in members
    ])
    points = scored.select(F.inline(pairs)).groupBy("origin_group", "member", "raw").agg(F.min("mapped").alias("low"), F.max("mapped").alias("high"))
    before = F.lag("high").over(models.Window.partitionBy("origin_group", "member").orderBy("raw"))
    falls = points.withColumn("falls", F.coalesce(before > F.col("low") + 1e-12, F.lit(False))).groupBy("origin_group").agg(F.max("falls").alias("falls"))
    rows = long_rows(scored, HOTSPOT_GROUPS, "__p_").join(falls, "origin_group")
    return rows.select(*KEYS, "origin_group", F.col("target").cast("int").alias("target"), F.col("p").between(0.0, 1.0).alias("in_range"), (~F.col("falls")).alias("rising"))


@query("feature_importance")
def feature_importance(spark, folder):
    """Share of the gain of each input, per group."""
    _, forests = final_models(growth(spark, folder), models.GROWTH, P.ORIGINS, REGRESSION)
    return spark.createDataFrame(
        [(o, *pair) for o, f in forests.items() for pair in models.feature_importance(f)], "origin_group string, feature string, importance double"
    )


@query("permutation_importance")
def permutation_importance(spark, folder):
    frame, forests = final_models(growth(spark, folder), models.GROWTH, P.ORIGINS, REGRESSION)
    out = None
    for o, forest in forests.items():
        keyed = frame.withColumns({"target": F.col(f"__y_{o}"), "row_key": F.concat_ws("|", *KEYS)}).filter("target IS NOT NULL")
        found = models.permutation_importance(keyed, forest, lambda: F.abs(F.col("target") - F.col("prediction")), "row_key")
        part = found.select(F.lit(o).alias("origin_group"), "*")
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "tree_attributions",
    " UNION ALL ".join(
        f"SELECT '{o}' AS origin_group, tract_geoid, year, true AS adds_up FROM ({feature_checks.GROWTH_LABELS_SQL}) QUALIFY "
        f"row_number() OVER (ORDER BY md5(concat(tract_geoid, '|', year)), tract_geoid, year) <= {models.ATTRIBUTED_ROWS}"
        for o in P.ORIGINS
    ),
)
def tree_attributions(spark, folder):
    """Attributions of the sampled rows of every group: a row's add up to its prediction less the mean."""
    frame, forests = final_models(growth(spark, folder), models.GROWTH, P.ORIGINS, REGRESSION)
    sample = models.sample_rows(frame.withColumn("__key", F.concat_ws("|", *KEYS)), "__key", models.ATTRIBUTED_ROWS)
    out = None
    for o, forest in forests.items():
        parts = attribution.attributions(forest.transform(sample, "__p"), forest, [*KEYS, "__p"])
        total = sum((F.col(f"shap_{c}") for c in forest.inputs), F.col("base"))
        near = F.abs(total - F.col("__p")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs(F.col("__p")))
        part = parts.select(F.lit(o).alias("origin_group"), *KEYS, near.alias("adds_up"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    "predict_growth_model",
    f"""SELECT tract_geoid, year, round(india_density, 6) AS current_density, true AS centred, 'india' AS origin_group, 2::INTEGER AS horizon
       FROM ({P.PANEL_SQL}) WHERE cast(substr(tract_geoid, 1, 5) AS integer) % 2 = 0""",
)
def predict_growth_model(spark, folder):
    """The trained regressor's growth of every second county's tracts; ``centred``: five points to either side of it."""
    built = features(spark, folder)
    _, forests = final_models(panel.growth_labels(built, HORIZON, P.ORIGINS), models.GROWTH, ["india"], REGRESSION)
    trained = models.TrainedModel("india", HORIZON, forests["india"], forests["india"].inputs, None)
    wanted = built.filter(F.substring("tract_geoid", 1, 5).cast("int") % 2 == 0).select("tract_geoid")
    found = serving.predict_growth(built, models.score_growth(built, trained), "india", HORIZON, wanted)
    away = [F.abs(F.col(f"confidence_interval.{side}") - F.col("predicted_growth")) for side in ("lower", "upper")]
    near = 1e-9 * (1 + F.abs("predicted_growth"))
    centred = (F.abs(away[0] - 5) <= near) & (F.abs(away[1] - 5) <= near)
    return found.select("tract_geoid", "year", F.round("current_density", 6).alias("current_density"), centred.alias("centred"), "origin_group", "horizon")


@query(
    "train_all_origins",
    "SELECT unnest({names}) AS origin_group, 2::INTEGER AS horizon, unnest({done}) AS succeeded, unnest({errors}) AS error".format(
        names=[*P.ORIGINS, "atlantis"],
        done=[True] * len(P.ORIGINS) + [False],
        errors="[{}, 'ValueError: no column label_atlantis_growth_2yr']".format(", ".join(["NULL"] * len(P.ORIGINS))),
    ),
)
def train_all_origins(spark, folder):
    """All groups and one that does not exist: its failure is reported, the others are trained."""
    _, status = models.train_all(growth(spark, folder), models.train_regressor, [*P.ORIGINS, "atlantis"], HORIZON, REGRESSION, dims.CV_FOLDS)
    return status


# --- Parts of training over whole tables ---

ISOTONIC_SQL = f"""
WITH points AS (
  SELECT lang, floor(n_chars / 25) AS x, count(*)::DOUBLE AS w, avg(y)::DOUBLE AS y
  FROM ({P.SCORES_SQL}) WHERE y IS NOT NULL GROUP BY 1, 2),
upto AS (SELECT *, sum(w) OVER o AS cw, sum(w * y) OVER o AS cy FROM points WINDOW o AS (PARTITION BY lang ORDER BY x)),
spans AS (
  SELECT a.lang, a.x AS lo, b.x AS hi, (b.cy - a.cy + a.w * a.y) / (b.cw - a.cw + a.w) AS mean
  FROM upto a JOIN upto b ON a.lang = b.lang AND a.x <= b.x),
lows AS (SELECT lang, lo, hi, min(mean) OVER (PARTITION BY lang, lo ORDER BY hi DESC) AS least FROM spans),
fits AS (SELECT p.lang, p.x, p.w, round(max(l.least), 9) AS fitted
         FROM points p JOIN lows l ON l.lang = p.lang AND l.lo <= p.x AND l.hi = p.x GROUP BY 1, 2, 3)
SELECT lang, fitted, min(x) AS lo, max(x) AS hi, sum(w) AS weight FROM fits GROUP BY 1, 2
"""


@query("isotonic_regression", ISOTONIC_SQL)
def isotonic_regression(spark, folder):
    """Pools of the isotonic regression of a label by text length, per language, next to the min-max formula."""
    points = P.scores(spark, folder).filter("y IS NOT NULL").select("lang", F.floor(F.col("n_chars") / 25).cast("double").alias("x"), "y")
    found = isotonic.pools(points, ["lang"], "x", "y")
    return found.select("lang", F.round("value", 9).alias("fitted"), "lo", "hi", "weight")
