"""Boosted-tree models per origin group: growth regression and hotspot classification.

All groups, folds and calibration folds of a family are fitted together over one table of binned inputs
(``boosting``). Scoring walks the trees of all groups in one narrow pass.
"""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.ml import Pipeline
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import values
from migrascope.operators import attribution, boosting, isotonic, metrics
from migrascope.operators import folds as fold_ops
from migrascope.operators.boosting import Forest, Spec
from migrascope.operators.isotonic import IsotonicMap
from migrascope.operators.order_stats import quantiles_of_many, sample_rows
from migrascope.operators.panel import growth_label, hotspot_label, sanitize
from migrascope.operators.serving import score_threshold
from migrascope.session import ensure_checkpoint_dir

log = logging.getLogger(__name__)

TreeSettings = boosting.Settings

# --- Fixed values: tree counts, rates, leaves, shares, penalties and minimum leaf rows of the two model families. ---
REGRESSOR = TreeSettings(
    trees=1200, learning_rate=0.03, leaves=64, min_rows=40, row_share=0.8, feature_share=0.8, l1=0.1, l2=0.2,
    patience=100, loss="huber", huber_quantile=0.85, seed=dims.CV_SEED,
)
CLASSIFIER = TreeSettings(
    trees=1000, learning_rate=0.05, leaves=64, min_rows=50, row_share=0.8, feature_share=0.8, l1=0.1, l2=0.2,
    patience=100, loss="logistic", seed=dims.CV_SEED,
)
ATTRIBUTED_ROWS = 1000  # rows whose predictions are attributed to inputs when a model is trained


SHUFFLE_ROWS = 10_000  # rows among which an input is permuted
KEYS = ["tract_geoid", "year"]


def feature_columns(columns: list[str], business_last: bool = False) -> list[str]:
    """Model inputs among the given columns, each once, in a fixed order.

    The regressor lists business columns before the growth rates; the classifier after the
    per-origin columns.
    """
    origin_columns = [o + s for o in dims.ORIGINS for s in dims.ORIGIN_SUFFIXES]
    densities = [f"{o}_density" for o in dims.ORIGINS]
    if business_last:
        wanted = [
            *dims.BASE_FEATURES, *dims.LANGUAGE_FEATURES, *dims.TEMPORAL_FEATURES,
            *dims.PERIOD_FEATURES, *origin_columns, *dims.BUSINESS_FEATURES,
        ]
    else:
        lagged = [f"{v}_lag_{k}" for v, k in (
            ("foreign_born_density", "queen"), ("foreign_born_density", "rook"),
            ("median_household_income", "queen"), ("median_rent", "queen"),
        )]
        wanted = [
            *dims.BASE_FEATURES, *densities, *dims.LANGUAGE_FEATURES, *dims.BUSINESS_FEATURES,
            *dims.TEMPORAL_FEATURES, *lagged, *dims.INTERACTION_FEATURES, *dims.PERIOD_FEATURES,
            *origin_columns,
        ]
    have = set(columns)
    listed = [c for c in wanted if c in have]
    years = [c for c in columns if c.startswith("year_")]
    lags = [c for c in columns if "_lag_" in c]
    return [c for c in dict.fromkeys([*listed, *years, *lags]) if not c.startswith("label_")]


def row_key(df: DataFrame, inputs: list[str]) -> Column:
    """What tells rows apart when trees sample them: tract and year, or else all inputs."""
    keys = [c for c in KEYS if c in df.columns] or inputs
    return F.struct(*[F.col(c) for c in keys])


def deltas_of(frame: DataFrame, targets: list[str], settings: TreeSettings) -> list[float] | None:
    """Huber threshold of each target: a quantile of the distances from the mean, all from one range sort."""
    if settings.loss != "huber":
        return None
    means = frame.agg(*[F.avg(t).alias(t) for t in targets]).first()
    away = frame.select(*[F.abs(F.col(t) - F.lit(means[t])).alias(t) for t in targets])
    found = quantiles_of_many(away, targets, [settings.huber_quantile])
    return [found[t][0] if t in found else 0.0 for t in targets]


@dataclass(frozen=True)
class Booster:
    """One model over a frame with a ``target`` column."""

    inputs: list[str]
    settings: TreeSettings

    def fit(self, frame: DataFrame) -> Forest:
        ensure_checkpoint_dir(frame.sparkSession)
        keyed = frame.withColumn("__row", row_key(frame, self.inputs))
        deltas = deltas_of(frame, ["target"], self.settings)
        spec = Spec("model", 0)
        return boosting.fit(keyed, self.inputs, ["target"], [], "__row", [spec], self.settings, deltas)["model"][0]


def regressor(inputs: list[str], settings: TreeSettings = REGRESSOR) -> Booster:
    return Booster(list(inputs), settings)


def classifier(inputs: list[str], settings: TreeSettings = CLASSIFIER) -> Booster:
    return Booster(list(inputs), settings)


def linear_huber(inputs: list[str]) -> Pipeline:
    """The robust linear alternative to the boosted regressor."""
    assembler = VectorAssembler(inputCols=inputs, outputCol="inputs")
    model = LinearRegression(featuresCol="inputs", labelCol="target", loss="huber", predictionCol="prediction")
    return Pipeline(stages=[assembler, model])


def feature_importance(model: Forest) -> list[tuple[str, float]]:
    """(input, share of the total gain), largest first; one entry per input column."""
    return model.importance()


def importance_table(spark: SparkSession, model: Forest) -> DataFrame:
    return spark.createDataFrame(feature_importance(model), "feature string, importance double")


def permutation_importance(
    frame: DataFrame,
    model: Forest,
    error: Callable[[], Column],
    key: str,
    rows: int | None = None,
) -> DataFrame:
    """Rise of the mean error when one input is shuffled, over all rows, or a sample of ``rows``.

    Rows are dealt to groups of about ``SHUFFLE_ROWS`` by a digest of their key. Within a group each
    row takes its inputs from the next one in the order of another digest, the last from the first:
    a random permutation that needs one shuffle. Copies of a row, one per input with that input
    replaced, are scored where they arise and leave the task as sums only.
    """
    names = model.inputs
    used = frame if rows is None else sample_rows(frame, key, rows)
    text = F.col(key).cast("string")
    groups = max(1, used.count() // SHUFFLE_ROWS)
    dealt = used.withColumn("__group", F.pmod(F.xxhash64(F.lit("group"), text), F.lit(groups)))
    order = Window.partitionBy("__group").orderBy(F.md5(text), key)
    own = F.struct(*names)
    first = F.first(own).over(order)
    donor = F.coalesce(F.lead(own).over(order), first)
    feature = F.explode(F.array(*[F.lit(n) for n in ["", *names]])).alias("__feature")
    copies = dealt.withColumn("__donor", donor).select("*", feature)
    shuffled = copies.select(
        *[c for c in frame.columns if c not in names],
        "__feature",
        *[F.when(F.col("__feature") == n, F.col(f"__donor.{n}")).otherwise(F.col(n)).alias(n) for n in names],
    )
    by_feature = model.transform(shuffled).groupBy(F.col("__feature").alias("feature")).agg(
        F.avg(error()).alias("mean_error")
    )
    means = {r["feature"]: r["mean_error"] for r in by_feature.collect()}  # one row per input
    base = means.pop("", None)
    return frame.sparkSession.createDataFrame(
        [(n, None if m is None or base is None else m - base) for n, m in sorted(means.items())],
        "feature string, importance double",
    )


@dataclass(frozen=True)
class CalibratedClassifier:
    """Classifiers of the calibration folds, each with its isotonic map; probabilities are averaged."""

    members: tuple[tuple[Forest, IsotonicMap], ...]

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` plus ``raw_i`` and ``calibrated_i`` per member and their mean ``hotspot_prob``."""
        return add_probabilities(df, {"hotspot_prob": self}, {"hotspot_prob": ""})

    def save(self, path: str) -> None:
        for i, (model, isotonic_map) in enumerate(self.members):
            model.save(isotonic_map.pools.sparkSession, f"{path}/member={i}/model")
            isotonic_map.save(f"{path}/member={i}/isotonic")

    @staticmethod
    def load(path: str, members: int = dims.CALIBRATION_FOLDS) -> "CalibratedClassifier":
        spark = SparkSession.getActiveSession()
        return CalibratedClassifier(
            tuple(
                (Forest.load(spark, f"{path}/member={i}/model"), IsotonicMap.load(spark, f"{path}/member={i}/isotonic"))
                for i in range(members)
            )
        )


def add_probabilities(df: DataFrame, models: dict[str, CalibratedClassifier], marks: dict[str, str]) -> DataFrame:
    """A probability per classifier; all their trees in one pass, all their isotonic maps in the next.

    ``marks``: what stands before the names of a classifier's ``raw_i`` and ``calibrated_i``.
    """
    raw = {f"{marks[n]}raw_{i}": f for n, c in models.items() for i, (f, _) in enumerate(c.members)}
    scored = boosting.add_scores(df, raw)
    maps = {f"{marks[n]}calibrated_{i}": (f"{marks[n]}raw_{i}", m) for n, c in models.items() for i, (_, m) in enumerate(c.members)}
    mapped = isotonic.add_mapped(scored, maps)
    means = {}
    for name, c in models.items():
        members = [F.col(f"{marks[name]}calibrated_{i}") for i in range(len(c.members))]
        mean = sum(members, F.lit(0.0)) / max(len(members), 1)
        means[name] = F.least(F.lit(1.0), F.greatest(F.lit(0.0), mean))
    return mapped.withColumns(means)


@dataclass
class TrainedModel:
    origin: str
    horizon: int
    model: Forest
    inputs: list[str]
    fold_scores: DataFrame
    calibrated: CalibratedClassifier | None = None
    attributions: DataFrame | None = None  # tract, year, base value and an attribution per input
    curves: tuple[tuple[float, ...], ...] = ()  # error on the left-out fold after each tree, per fold


@dataclass(frozen=True)
class Family:
    """What sets the two kinds of models apart."""

    label: Callable[[str, int], str]
    business_last: bool
    calibrated: bool


GROWTH = Family(growth_label, business_last=False, calibrated=False)
HOTSPOT = Family(hotspot_label, business_last=True, calibrated=True)


def training_frame(labelled: DataFrame, family: Family, origins: list[str], horizon: int, inputs: list[str], folds: int) -> DataFrame:
    """Keys, clean inputs, a target per group (``__y_…``), fold columns and a row key, stored once.

    Growth is clipped to its percentiles, all groups in one range sort, and groups share one fold column; hotspot
    folds even out each group's own labels.
    """
    kept = [c for c in (*KEYS, "total_pop") if c not in inputs]
    targets = {o: F.col(family.label(o, horizon)).cast("double").alias(f"__y_{o}") for o in origins}
    frame = sanitize(labelled.select(*kept, *inputs, *targets.values()), inputs)
    if family is GROWTH:
        frame = metrics.winsorize_many(frame, [f"__y_{o}" for o in origins]).checkpoint()
        frame = fold_ops.balanced_group_folds(frame, "tract_geoid", folds, "__fold")
    else:
        frame = frame.checkpoint()
        tables = None
        for o in origins:
            one = fold_ops.label_fold_table(frame, "tract_geoid", f"__y_{o}", folds).withColumn("__of", F.lit(o))
            tables = one if tables is None else tables.unionByName(one)
        wide = tables.groupBy(F.col("tract_geoid").alias("__group")).agg(
            *[F.max(F.when(F.col("__of") == o, F.col("fold"))).alias(f"__fold_{o}") for o in origins]
        )
        frame = frame.join(wide, F.col("tract_geoid").eqNullSafe(F.col("__group"))).drop("__group")
        frame = frame.withColumn("__calibration", fold_ops.hash_fold(F.col("tract_geoid"), dims.CALIBRATION_FOLDS))
    return frame.withColumn("__row", row_key(frame, inputs)).checkpoint()


def fold_columns(family: Family, origins: list[str]) -> list[str]:
    return ["__fold"] if family is GROWTH else [*(f"__fold_{o}" for o in origins), "__calibration"]


def specs_of(family: Family, origins: list[str], folds: int) -> list[Spec]:
    """The models of all groups: one on all rows, one without each fold, and those to calibrate."""
    out = []
    for t, o in enumerate(origins):
        fold = 0 if family is GROWTH else t
        out.append(Spec(f"{o}/all", t))
        out += [Spec(f"{o}/{k}", t, fold, k, early=True) for k in range(folds)]
        if family.calibrated:
            out += [Spec(f"{o}/calibration{k}", t, len(origins), k) for k in range(dims.CALIBRATION_FOLDS)]
    return out


def held_out_scores(frame: DataFrame, family: Family, origins: list[str], folds: int, fitted: dict, column: str | None = None, prefix: str = "") -> DataFrame:
    """(origin_group, fold, tract_geoid, year, target, prediction): each row scored by the model that did not see it."""
    parts = {}
    for o in origins:
        fold = column or ("__fold" if family is GROWTH else f"__fold_{o}")
        parts[f"__p_{o}"] = (fold, [fitted[f"{o}/{prefix}{k}"][0] for k in range(folds)])
    scored = boosting.add_fold_scores(frame, parts)
    rows = F.array(*[
        F.struct(
            F.lit(o).alias("origin_group"), F.col(parts[f"__p_{o}"][0]).cast("int").alias("fold"),
            F.col(f"__y_{o}").alias("target"), F.col(f"__p_{o}").alias("prediction"),
        )
        for o in origins
    ])
    return scored.select(*KEYS, F.inline(rows)).filter("target IS NOT NULL")


def evaluate_folds(scored: DataFrame, family: Family) -> DataFrame:
    """Scores per group and fold, numbered from 1, in one pass over all groups' held-out rows."""
    groups = ["origin_group", "fold"]
    if family is GROWTH:
        found = metrics.regression_metrics(scored, "target", "prediction", groups).drop("n")
    else:
        rows = scored.select(*groups, F.col("target").cast("int").alias("y"), F.col("prediction").alias("p"))
        found = metrics.classification_metrics(rows, "y", "p", groups)
    return found.withColumn("fold", F.col("fold") + 1)


def cross_validate(labelled: DataFrame, family: Family, origins: list[str], horizon: int, settings: TreeSettings, folds: int = dims.CV_FOLDS) -> DataFrame:
    """Scores of every group and fold, with the trees that patience kept.

    Boosting stops when the error on the left-out fold has not fallen for ``settings.patience`` trees, keeps the
    trees of its least error, and the same fold is then scored.
    """
    ensure_checkpoint_dir(labelled.sparkSession)
    inputs = feature_columns(labelled.columns, family.business_last)
    frame = training_frame(labelled, family, origins, horizon, inputs, folds)
    specs = [s for s in specs_of(family, origins, folds) if s.early]
    fitted = _fit(frame, family, origins, inputs, specs, settings)
    scores = evaluate_folds(held_out_scores(frame, family, origins, folds, fitted), family)
    kept = [(o, k + 1, fitted[f"{o}/{k}"][0].trees, len(fitted[f"{o}/{k}"][1])) for o in origins for k in range(folds)]
    trees = labelled.sparkSession.createDataFrame(kept, "origin_group string, fold int, trees_kept int, trees_grown int")
    return scores.join(trees, ["origin_group", "fold"])


def _fit(frame: DataFrame, family: Family, origins: list[str], inputs: list[str], specs: list[Spec], settings: TreeSettings) -> dict:
    targets = [f"__y_{o}" for o in origins]
    deltas = deltas_of(frame, targets, settings)
    return boosting.fit(frame, inputs, targets, fold_columns(family, origins), "__row", specs, settings, deltas)


def calibrators(frame: DataFrame, family: Family, origins: list[str], fitted: dict) -> dict[str, CalibratedClassifier]:
    """Per group: the models that left a calibration fold out, and the isotonic maps of the probabilities they give
    that fold. All groups' and folds' maps are pooled in one job; equal probabilities are one weighted point."""
    n = dims.CALIBRATION_FOLDS
    scored = held_out_scores(frame, family, origins, n, fitted, "__calibration", "calibration")
    found = isotonic.pools(scored, ["origin_group", "fold"], "prediction", "target").checkpoint()
    out = {}
    for o in origins:
        maps = [IsotonicMap.of(found.filter((F.col("origin_group") == o) & (F.col("fold") == k)).select("lo", "hi", "value")) for k in range(n)]
        out[o] = CalibratedClassifier(tuple((fitted[f"{o}/calibration{k}"][0], m) for k, m in enumerate(maps)))
    return out


def calibrate(labelled: DataFrame, origins: list[str], horizon: int, settings: TreeSettings = CLASSIFIER) -> tuple[DataFrame, dict[str, CalibratedClassifier]]:
    """The training rows of all groups and their calibrated classifiers."""
    ensure_checkpoint_dir(labelled.sparkSession)
    inputs = feature_columns(labelled.columns, business_last=True)
    frame = training_frame(labelled, HOTSPOT, origins, horizon, inputs, dims.CV_FOLDS)
    specs = [s for s in specs_of(HOTSPOT, origins, 0) if "calibration" in s.name]
    return frame, calibrators(frame, HOTSPOT, origins, _fit(frame, HOTSPOT, origins, inputs, specs, settings))


def warn_if_rare(frame: DataFrame, origins: list[str]) -> None:
    rates = frame.agg(*[F.avg(f"__y_{o}").alias(o) for o in origins]).first()
    for o in origins:
        if rates[o] is not None and rates[o] < dims.LOW_POSITIVE_RATE:
            log.warning("%s: positive rate %.4f", o, rates[o])


def train_together(labelled: DataFrame, family: Family, origins: list[str], horizon: int, settings: TreeSettings, folds: int) -> dict[str, TrainedModel]:
    """Cross-validation, final fits, calibration and attributions of all groups over one binned table."""
    spark = labelled.sparkSession
    ensure_checkpoint_dir(spark)
    for o in origins:
        if family.label(o, horizon) not in labelled.columns:
            raise ValueError(f"no column {family.label(o, horizon)}")
    inputs = feature_columns(labelled.columns, family.business_last)
    frame = training_frame(labelled, family, origins, horizon, inputs, folds)
    if family.calibrated:
        warn_if_rare(frame, origins)
    fitted = _fit(frame, family, origins, inputs, specs_of(family, origins, folds), settings)
    scored = evaluate_folds(held_out_scores(frame, family, origins, folds, fitted), family)
    scores = spark.createDataFrame(scored.collect(), scored.schema)  # a row for each group and fold
    calibrated = calibrators(frame, family, origins, fitted) if family.calibrated else {}
    sample = sample_rows(frame.withColumn("__key", F.concat_ws("|", *KEYS)), "__key", ATTRIBUTED_ROWS)
    out = {}
    for o in origins:
        forest = fitted[f"{o}/all"][0]
        own = scores.filter(F.col("origin_group") == o).drop("origin_group")
        curves = tuple(tuple(fitted[f"{o}/{k}"][1]) for k in range(folds))
        out[o] = TrainedModel(o, horizon, forest, inputs, own, calibrated.get(o), attribution.attributions(sample, forest, KEYS), curves)
    return out


def train_regressor(
    labelled: DataFrame, origin: str, horizon: int = 2, settings: TreeSettings = REGRESSOR,
    folds: int = dims.CV_FOLDS,
) -> TrainedModel:
    """Grouped cross-validation, then a fit on all rows."""
    return train_together(labelled, GROWTH, [origin], horizon, settings, folds)[origin]


def train_classifier(
    labelled: DataFrame, origin: str, horizon: int = 2, settings: TreeSettings = CLASSIFIER,
    folds: int = dims.CV_FOLDS,
) -> TrainedModel:
    """Stratified grouped cross-validation, a fit on all rows, and isotonic calibration."""
    return train_together(labelled, HOTSPOT, [origin], horizon, settings, folds)[origin]


train_regressor.family = GROWTH
train_classifier.family = HOTSPOT


def score_hotspots(
    features: DataFrame, trained: TrainedModel, threshold: float = 0.5
) -> DataFrame:
    """Calibrated probability and flag per tract-year, with the origin group."""
    kept = [c for c in ("tract_geoid", "year") if c not in trained.inputs]
    clean = sanitize(features.select(*kept, *trained.inputs), trained.inputs)
    scored = trained.calibrated.transform(clean)
    flagged = score_threshold(scored, F.col("hotspot_prob"), threshold)
    return flagged.withColumns({"origin_group": F.lit(trained.origin), "horizon": F.lit(trained.horizon)})


def score_all(features: DataFrame, trained: list[TrainedModel], threshold: float = 0.5) -> DataFrame:
    """``score_hotspots`` of several models, in one pass over the features: a row per model and tract-year."""
    inputs = list(dict.fromkeys(c for t in trained for c in t.inputs))
    kept = [c for c in KEYS if c not in inputs]
    clean = sanitize(features.select(*kept, *inputs), inputs)
    names = {f"__prob_{i}": t.calibrated for i, t in enumerate(trained)}
    out = add_probabilities(clean, names, {n: f"{n}_" for n in names})
    own = [
        F.struct(F.col(f"__prob_{i}").alias("hotspot_prob"), F.lit(t.origin).alias("origin_group"), F.lit(t.horizon).alias("horizon"))
        for i, t in enumerate(trained)
    ]
    rows = out.select(*KEYS, F.inline(F.array(*own)))
    return rows.withColumn("hotspot_pred", values.flag(F.col("hotspot_prob") >= threshold))


def score_growth(features: DataFrame, trained: TrainedModel) -> DataFrame:
    kept = [c for c in ("tract_geoid", "year") if c not in trained.inputs]
    clean = sanitize(features.select(*kept, *trained.inputs), trained.inputs)
    return trained.model.transform(clean).select(
        "tract_geoid", "year", F.col("prediction").alias("predicted_growth")
    )


def train_all(
    labelled: DataFrame,
    train: Callable[..., TrainedModel],
    origins: list[str] | None = None,
    horizon: int = 2,
    settings: TreeSettings | None = None,
    folds: int = dims.CV_FOLDS,
    path: str | None = None,
) -> tuple[dict[str, TrainedModel], DataFrame]:
    """Models of every origin group; a failure is recorded and does not stop the others.

    Returns the models and a status row per group. Groups with a label and rows are trained together; should that
    fail, or for a ``train`` of the caller's own, one after another.
    """
    spark = labelled.sparkSession
    names = origins or dims.ORIGINS
    settings = settings or (REGRESSOR if train is train_regressor else CLASSIFIER)
    errors: dict[str, str | None] = dict.fromkeys(names)
    trained: dict[str, TrainedModel] = {}
    family = getattr(train, "family", None)
    together: list[str] = []
    if family:
        together = usable(labelled, family, names, horizon, errors)
        try:
            trained = train_together(labelled, family, together, horizon, settings, folds) if together else {}
            together = []
        except Exception:  # tried again one by one, to tell whose fault it is
            log.exception("training together failed")
    for origin in together if family else names:
        try:
            trained[origin] = train(labelled, origin, horizon, settings, folds)
        except Exception as error:  # recorded in the status table
            log.exception("training failed for %s", origin)
            errors[origin] = f"{type(error).__name__}: {error}"
    if path:
        for t in trained.values():
            save_trained(t, path)
    status = spark.createDataFrame(
        [(origin, horizon, origin in trained, errors[origin]) for origin in names],
        "origin_group string, horizon int, succeeded boolean, error string",
    )
    return trained, status


def usable(labelled: DataFrame, family: Family, names: list[str], horizon: int, errors: dict[str, str | None]) -> list[str]:
    """Groups whose label column is there and holds a value; what is wrong with the others goes into ``errors``."""
    there = [o for o in names if family.label(o, horizon) in labelled.columns]
    for o in names:
        if o not in there:
            errors[o] = f"ValueError: no column {family.label(o, horizon)}"
    counts = labelled.agg(*[F.count(family.label(o, horizon)).alias(o) for o in there]).first() if there else {}
    for o in there:
        if not counts[o]:
            errors[o] = f"ValueError: no value in {family.label(o, horizon)}"
    return [o for o in there if counts[o]]


def save_trained(trained: TrainedModel, path: str) -> None:
    """Model, calibration, fold scores, importances and attributions under ``origin=…/horizon=…``."""
    root = f"{path}/origin={trained.origin}/horizon={trained.horizon}"
    spark = trained.fold_scores.sparkSession
    trained.model.save(spark, f"{root}/model")
    if trained.calibrated is not None:
        trained.calibrated.save(f"{root}/calibrated")
    trained.fold_scores.coalesce(1).write.mode("overwrite").parquet(f"{root}/fold_scores")
    importance_table(spark, trained.model).coalesce(1).write.mode("overwrite").parquet(f"{root}/importance")
    if trained.attributions is not None:
        trained.attributions.write.mode("overwrite").parquet(f"{root}/attributions")


def load_model(path: str, origin: str, horizon: int) -> Forest:
    return Forest.load(SparkSession.getActiveSession(), f"{path}/origin={origin}/horizon={horizon}/model")


def load_trained(spark: SparkSession, path: str, origin: str, horizon: int) -> TrainedModel:
    """What ``save_trained`` stored: enough to score and evaluate in another session."""
    root = f"{path}/origin={origin}/horizon={horizon}"
    model = Forest.load(spark, f"{root}/model")
    scores = spark.read.parquet(f"{root}/fold_scores")
    calibrated = CalibratedClassifier.load(f"{root}/calibrated") if model.loss == "logistic" else None
    return TrainedModel(origin, horizon, model, model.inputs, scores, calibrated, spark.read.parquet(f"{root}/attributions"))


def evaluate_regressor(labelled: DataFrame, trained: TrainedModel) -> dict[str, DataFrame]:
    """Predictions with residuals, metrics, and the error per population quintile."""
    target = growth_label(trained.origin, trained.horizon)
    kept = [c for c in ("tract_geoid", "year", "total_pop") if c not in trained.inputs]
    clean = sanitize(
        labelled.select(*kept, *trained.inputs, F.col(target).alias("actual")), trained.inputs
    )
    scored = trained.model.transform(clean).withColumn("residual", F.col("actual") - F.col("prediction"))
    return {
        "predictions": scored.select("tract_geoid", "year", "actual", "prediction", "residual"),
        "metrics": metrics.regression_metrics(scored, "actual", "prediction"),
        "error_by_population": metrics.error_by_bucket(scored, "actual", "prediction"),
    }


def evaluate_classifier(labelled: DataFrame, trained: TrainedModel) -> dict[str, DataFrame]:
    """Calibrated predictions and every classification metric over them.

    The features are scored once and stored; the metrics come from one table of counts by score, stored too.
    """
    ensure_checkpoint_dir(labelled.sparkSession)
    target = hotspot_label(trained.origin, trained.horizon)
    kept = [c for c in KEYS if c not in trained.inputs]
    clean = sanitize(
        labelled.select(*kept, *trained.inputs, F.col(target).cast("int").alias("actual")),
        trained.inputs,
    )
    scored = trained.calibrated.transform(clean).withColumn(
        "hotspot_pred", values.flag(F.col("hotspot_prob") >= 0.5)
    )
    rows = scored.select(*KEYS, "actual", "hotspot_prob", "hotspot_pred").checkpoint()
    totals = metrics.class_totals(rows, "actual", "hotspot_prob", None, None).checkpoint()
    return {"predictions": rows, **metrics.totals_report(totals, "hotspot_prob")}


def small(settings: TreeSettings, trees: int, depth: int = 3, min_rows: int = 5) -> TreeSettings:
    """Cheaper settings for trials and checks: trees of at most 2 ** ``depth`` leaves."""
    return replace(settings, trees=trees, leaves=2**depth, min_rows=min_rows)
