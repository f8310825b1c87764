"""Folds, weights, samples and evaluation metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks import proxies as P
from checks.registry import query, r, rs
from migrascope import dims
from migrascope.operators import folds, metrics, order_stats, serving

FOLD = "cast(cast('0x' || substr(md5(cast({} AS varchar)), 1, 8) AS bigint) % {} AS integer)"
FLAGGED_SQL = f"SELECT *, cast(p >= 0.5 AS integer) AS pred FROM ({P.SCORES_SQL})"


def flagged(spark, folder):
    return P.scores(spark, folder).withColumn("pred", F.when(F.col("p") >= 0.5, 1).otherwise(0))


@query(
    "group_folds",
    f"SELECT tract_geoid, year, {FOLD.format('tract_geoid', 5)} AS fold FROM ({P.RAW_PANEL_SQL})",
)
def group_folds(spark, folder):
    return folds.group_folds(P.raw_panel(spark, folder).select("tract_geoid", "year"), "tract_geoid")


@query(
    "balanced_group_folds",
    f"""WITH RECURSIVE sizes AS (SELECT tract_geoid, count(*) AS n FROM ({P.RAW_PANEL_SQL}) GROUP BY 1),
    placed AS (SELECT n, row_number() OVER (ORDER BY n DESC) AS i FROM sizes),
    dealt AS (
      SELECT 0::BIGINT AS i, [0::BIGINT FOR k IN range(5)] AS loads, [0::BIGINT FOR k IN range(5)] AS members
      UNION ALL
      SELECT p.i, list_transform(loads, lambda x, k: CASE WHEN k = list_position(loads, list_min(loads)) THEN x + n ELSE x END),
             list_transform(members, lambda x, k: CASE WHEN k = list_position(loads, list_min(loads)) THEN x + 1 ELSE x END)
      FROM dealt d JOIN placed p ON p.i = d.i + 1)
    SELECT (k - 1)::INTEGER AS fold, loads[k] AS rows_in_fold, members[k] AS tracts, 0::BIGINT AS split_tracts
    FROM (SELECT * FROM dealt ORDER BY i DESC LIMIT 1), range(1, 6) f(k)""",
)
def balanced_group_folds(spark, folder):
    """Folds of nearly equal rows, the largest tract first: rows and tracts of each, and tracts in two folds (none)."""
    folded = folds.balanced_group_folds(P.raw_panel(spark, folder).select("tract_geoid", "year"), "tract_geoid")
    tracts = folded.groupBy("tract_geoid").agg(F.min("fold").alias("fold"), F.count(F.lit(1)).alias("n"), F.count_distinct("fold").alias("k"))
    return tracts.groupBy("fold").agg(
        F.sum("n").alias("rows_in_fold"), F.count(F.lit(1)).alias("tracts"), F.count_if(F.col("k") > 1).alias("split_tracts")
    )


@query(
    "label_group_folds",
    f"""WITH counts AS (
      SELECT lang, sum((y = 1)::INT) AS ones, sum((y = 0)::INT) AS zeros FROM ({P.SCORES_SQL}) GROUP BY doc_id // 10, lang),
    most AS (SELECT max(ones) AS a, max(zeros) AS b, sum(ones) AS c, sum(zeros) AS d FROM counts)
    SELECT k::INTEGER AS fold, c::BIGINT AS ones, d::BIGINT AS zeros, true AS even FROM most, range(5) f(k)""",
)
def label_group_folds(spark, folder):
    """Folds with even label shares over groups of documents: all labels of the table, and whether the fold's share of
    either label is within one group's share of a fifth."""
    group = F.concat_ws("|", F.floor(F.col("doc_id") / 10), "lang")
    rows = P.scores(spark, folder).withColumn("__group_key", group).select("__group_key", "y")
    table = folds.label_fold_table(rows, "__group_key", "y")
    folded = rows.join(table, "__group_key")
    one, zero = (F.sum((F.col("y") == k).cast("long")) for k in (1, 0))
    groups = folded.groupBy("__group_key").agg(one.alias("ones"), zero.alias("zeros")).agg(
        F.max("ones").alias("a"), F.max("zeros").alias("b"), F.sum("ones").alias("c"), F.sum("zeros").alias("d")
    )
    shares = folded.groupBy("fold").agg(one.alias("mine"), zero.alias("others")).crossJoin(F.broadcast(groups))  # five rows, one row
    even = (F.abs(F.col("mine") - F.col("c") / 5) <= F.col("a")) & (F.abs(F.col("others") - F.col("d") / 5) <= F.col("b"))
    return shares.select("fold", F.col("c").alias("ones"), F.col("d").alias("zeros"), even.alias("even"))


@query(
    "stratified_group_folds",
    f"""SELECT doc_id, y, cast((row_number() OVER (PARTITION BY y ORDER BY md5('42|' || cast(doc_id AS varchar)), doc_id) - 1) % 5 AS integer) AS fold
        FROM ({P.SCORES_SQL})""",
)
def stratified_group_folds(spark, folder):
    rows = P.scores(spark, folder).select("doc_id", "y")
    return folds.stratified_group_folds(rows, "doc_id", "y")


@query(
    "balanced_weights",
    f"""SELECT y AS label, count(*) AS n, round(sum(count(*)) OVER () / (2.0::double * count(*)), 6) AS weight
        FROM ({P.SCORES_SQL}) GROUP BY y""",
)
def balanced_weights(spark, folder):
    return folds.balanced_weights(P.scores(spark, folder), "y").select("label", "n", r("weight"))


@query(
    "sample_rows",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY md5(cast(o_orderkey AS varchar)), o_orderkey LIMIT 1000",
)
def sample_rows(spark, folder):
    orders = P.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return order_stats.sample_rows(orders, "o_orderkey", dims.ATTRIBUTION_ROWS)


# --- regression: this year's overall density is predicted by last year's ---

RESIDUALS_SQL = f"""
SELECT * FROM (SELECT tract_geoid, year, total_pop, foreign_born_density AS y,
       lag(foreign_born_density) OVER (PARTITION BY tract_geoid ORDER BY year) AS p,
       {FOLD.format('tract_geoid', 5)} AS fold FROM ({P.PANEL_SQL})) WHERE p IS NOT NULL
"""


def residuals(spark, folder):
    from pyspark.sql import Window

    before = F.lag("foreign_born_density").over(Window.partitionBy("tract_geoid").orderBy("year"))
    rows = P.panel(spark, folder).select(
        "tract_geoid", "year", "total_pop", F.col("foreign_born_density").alias("y"), before.alias("p")
    )
    return folds.group_folds(rows.filter("p IS NOT NULL"), "tract_geoid")


REGRESSION_SQL = """
count(*) AS n, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
1 - sum((y - p) * (y - p)) / (var_pop(y) * count(*)) AS r2"""


@query(
    "regression_metrics",
    f"SELECT fold, n, {rs(['mae', 'rmse', 'r2'])} FROM (SELECT fold, {REGRESSION_SQL} FROM ({RESIDUALS_SQL}) GROUP BY fold)",
)
def regression_metrics(spark, folder):
    scored = metrics.regression_metrics(residuals(spark, folder), "y", "p", ["fold"])
    return scored.select("fold", "n", r("mae"), r("rmse"), r("r2"))


@query(
    "mean_fold_scores",
    f"""SELECT {", ".join(f"round(avg({m}), 6) AS {m}" for m in ("mae", "rmse", "r2"))}
        FROM (SELECT fold, {REGRESSION_SQL} FROM ({RESIDUALS_SQL}) GROUP BY fold)""",
)
def mean_fold_scores(spark, folder):
    scored = metrics.regression_metrics(residuals(spark, folder), "y", "p", ["fold"])
    return metrics.mean_scores(scored, ["mae", "rmse", "r2"]).select(r("mae"), r("rmse"), r("r2"))


def bucket_sql(column: str, table: str, names: list[str]) -> str:
    """Right-closed equal-frequency buckets as a CASE over scalar quantiles."""
    parts = len(names)
    whens = " ".join(
        f"WHEN {column} <= (SELECT quantile_cont({column}, {(i + 1) / parts}) FROM {table}) THEN '{name}'"
        for i, name in enumerate(names[:-1])
    )
    return f"CASE {whens} ELSE '{names[-1]}' END"


@query(
    "error_by_quintile",
    f"""WITH t AS ({RESIDUALS_SQL})
        SELECT bucket, count(*) AS n, round(avg(abs(y - p)), 6) AS mae
        FROM (SELECT *, {bucket_sql("total_pop", "t", dims.POPULATION_BUCKETS)} AS bucket FROM t) GROUP BY bucket""",
)
def error_by_quintile(spark, folder):
    by_size = metrics.error_by_bucket(residuals(spark, folder), "y", "p")
    return by_size.select("bucket", "n", r("mae"))


@query(
    "quantiles",
    "SELECT " + ", ".join(f"quantile_cont(l_extendedprice, {p}) AS q{i}" for i, p in enumerate((0.01, 0.25, 0.5, 0.99)))
    + " FROM lineitem",
)
def quantiles(spark, folder):
    """Exact quantiles of the largest table, in ranges of at most 20,000 distinct values."""
    prices = P.table(spark, folder, "lineitem").select("l_extendedprice")
    found = order_stats.quantiles(prices, "l_extendedprice", [0.01, 0.25, 0.5, 0.99], range_rows=20_000)
    return spark.createDataFrame([tuple(found)], "q0 double, q1 double, q2 double, q3 double")


# --- classification over labelled scores, overall and per language ---

# Totals per distinct score: positives and negatives at it, above it, and in all.
RANKED_SQL = f"""
SELECT lang, p, pos, neg, sum(pos) OVER up AS hits, sum(neg) OVER up AS misses,
       sum(pos) OVER (PARTITION BY lang) AS all_pos, sum(neg) OVER (PARTITION BY lang) AS all_neg
FROM (SELECT lang, p, sum(y) AS pos, sum(1 - y) AS neg FROM ({P.SCORES_SQL}) GROUP BY lang, p)
WINDOW up AS (PARTITION BY lang ORDER BY p DESC)
"""
AUC = "sum(pos * (all_neg - misses + neg * 0.5::double)) / nullif(max(all_pos) * max(all_neg), 0)"
AP = "sum(pos / nullif(all_pos, 0)::double * hits / (hits + misses))"


@query("roc_auc", f"SELECT lang, round({AUC}, 6) AS roc_auc FROM ({RANKED_SQL}) GROUP BY lang")
def roc_auc(spark, folder):
    by_language = metrics.roc_auc(P.scores(spark, folder), "y", "p", ["lang"])
    return by_language.select("lang", r("roc_auc"))


@query(
    "average_precision",
    f"SELECT lang, round({AP}, 6) AS average_precision FROM ({RANKED_SQL}) GROUP BY lang",
)
def average_precision(spark, folder):
    by_language = metrics.average_precision(P.scores(spark, folder), "y", "p", ["lang"], range_rows=50)
    return by_language.select("lang", r("average_precision"))


ALL_RANKED_SQL = RANKED_SQL.replace("lang, p, pos", "p, pos").replace("SELECT lang, p, sum", "SELECT p, sum").replace(
    "GROUP BY lang, p", "GROUP BY p").replace("PARTITION BY lang ORDER", "ORDER").replace("(PARTITION BY lang)", "()")


@query(
    "classification_metrics",
    f"""SELECT round({AUC}, 6) AS roc_auc, round({AP}, 6) AS pr_auc,
              round((SELECT avg((p - y) * (p - y)) FROM ({P.SCORES_SQL})), 6) AS brier_score FROM ({ALL_RANKED_SQL})""",
)
def classification_metrics(spark, folder):
    """All three at once, with the running totals cut into many ranges."""
    one = metrics.classification_metrics(P.scores(spark, folder), "y", "p", range_rows=40)
    return one.select(r("roc_auc"), r("pr_auc"), r("brier_score"))


@query(
    "brier_score",
    f"SELECT lang, round(avg((p - y) * (p - y)), 6) AS brier_score FROM ({P.SCORES_SQL}) GROUP BY lang",
)
def brier_score(spark, folder):
    return metrics.brier_score(P.scores(spark, folder), "y", "p", ["lang"]).select("lang", r("brier_score"))


@query(
    "pr_curve",
    f"""SELECT p AS threshold, round(hits / (hits + misses)::double, 6) AS precision, round(hits / all_pos::double, 6) AS recall
        FROM ({ALL_RANKED_SQL}) UNION ALL SELECT NULL, 1, 0""",
)
def pr_curve(spark, folder):
    curve = metrics.pr_curve(P.scores(spark, folder), "y", "p")
    return curve.select("threshold", r("precision"), r("recall"))


@query(
    "confusion_matrix",
    f"""SELECT a.actual, b.predicted, count(s.y) AS n
        FROM (VALUES (0), (1)) a(actual), (VALUES (0), (1)) b(predicted)
        LEFT JOIN ({FLAGGED_SQL}) s ON s.y = a.actual AND s.pred = b.predicted GROUP BY ALL""",
)
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(flagged(spark, folder), "y", "pred")


REPORT_SQL = f"""
WITH s AS ({FLAGGED_SQL}),
c AS (SELECT k, count(*) FILTER (y = k AND pred = k)::double AS hit, count(*) FILTER (pred = k)::double AS said,
             count(*) FILTER (y = k)::double AS support FROM s, (VALUES (0), (1)) v(k) GROUP BY k),
m AS (SELECT k, support, coalesce(hit / nullif(said, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall FROM c),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m),
total AS (SELECT count(*) AS n, avg(CASE WHEN y = pred THEN 1.0::double ELSE 0 END) AS accuracy FROM s)
SELECT class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, cast(support AS bigint) AS support FROM (
  SELECT cast(k AS varchar) AS class, precision, recall, f1, support FROM f
  UNION ALL SELECT 'accuracy', accuracy, accuracy, accuracy, n FROM total
  UNION ALL SELECT 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) FROM f
  UNION ALL SELECT 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
                   sum(f1 * support) / sum(support), sum(support) FROM f)
"""


@query("classification_report", REPORT_SQL)
def classification_report(spark, folder):
    report = metrics.classification_report(flagged(spark, folder), "y", "pred")
    return report.select("class", r("precision"), r("recall"), r("f1"), "support")


@query(
    "score_threshold",
    f"""SELECT tract_geoid, year, round(foreign_born_density / 1000, 6) AS hotspot_prob,
              cast(foreign_born_density / 1000 >= 0.5 AS integer) AS hotspot_pred FROM ({P.PANEL_SQL})""",
)
def score_threshold(spark, folder):
    flags = serving.score_threshold(P.panel(spark, folder), F.col("foreign_born_density") / 1000)
    return flags.select("tract_geoid", "year", r("hotspot_prob"), "hotspot_pred")


@query(
    "calibration_by_decile",
    f"""WITH t AS ({P.SCORES_SQL})
        SELECT cast(decile AS integer) AS decile, count(*) AS n, round(avg(p), 6) AS mean_predicted, round(avg(y), 6) AS observed_rate
        FROM (SELECT *, {bucket_sql("n_chars", "t", [str(i) for i in range(1, 11)])} AS decile FROM t) GROUP BY decile""",
)
def calibration_by_decile(spark, folder):
    deciles = metrics.calibration_by_decile(P.scores(spark, folder), "y", "p", "n_chars")
    return deciles.select("decile", "n", r("mean_predicted"), r("observed_rate"))


ODDS_SQL = f"""
SELECT lang, avg(pred) FILTER (y = 1) AS tpr, avg(pred) FILTER (y = 0) AS fpr FROM ({FLAGGED_SQL}) GROUP BY lang
"""


@query("equalized_odds", f"SELECT lang, {rs(['tpr', 'fpr'])} FROM ({ODDS_SQL})")
def equalized_odds(spark, folder):
    return metrics.equalized_odds(flagged(spark, folder), "y", "pred", "lang").select("lang", r("tpr"), r("fpr"))


@query(
    "equalized_odds_gap",
    f"SELECT round(max(tpr) - min(tpr), 6) AS max_tpr_gap, round(max(fpr) - min(fpr), 6) AS max_fpr_gap FROM ({ODDS_SQL})",
)
def equalized_odds_gap(spark, folder):
    gap = metrics.equalized_odds_gap(metrics.equalized_odds(flagged(spark, folder), "y", "pred", "lang"))
    return gap.select(r("max_tpr_gap"), r("max_fpr_gap"))


@query(
    "evaluation_bundle",
    f"""SELECT 'roc_auc' AS metric, '' AS part, round({AUC}, 6) AS value FROM ({ALL_RANKED_SQL})
        UNION ALL SELECT 'average_precision', '', round({AP}, 6) FROM ({ALL_RANKED_SQL})
        UNION ALL SELECT 'brier_score', '', round(avg((p - y) * (p - y)), 6) FROM ({P.SCORES_SQL})
        UNION ALL SELECT 'confusion', concat(y, '/', pred), count(*)::double FROM ({FLAGGED_SQL}) GROUP BY y, pred
        UNION ALL SELECT 'accuracy', '', round(avg((y = pred)::integer), 6) FROM ({FLAGGED_SQL})
        UNION ALL SELECT 'curve_points', '', count(DISTINCT p)::double + 1 FROM ({P.SCORES_SQL})""",
)
def evaluation_bundle(spark, folder):
    """All classification metrics from one stored table of counts by score; the scored rows are read once."""
    order_stats.ensure_checkpoint_dir(spark)
    totals = metrics.class_totals(P.scores(spark, folder), "y", "p", None, None).checkpoint()
    found = metrics.totals_report(totals, "p")
    blank = F.lit("")
    parts = [found[m].select(F.lit(m).alias("metric"), blank.alias("part"), r(m).alias("value")) for m in ("roc_auc", "average_precision", "brier_score")]
    cells = found["confusion_matrix"].filter("n > 0")
    parts.append(cells.select(F.lit("confusion").alias("metric"), F.concat("actual", F.lit("/"), "predicted").alias("part"), F.col("n").cast("double").alias("value")))
    accuracy = found["classification_report"].filter(F.col("class") == "accuracy")
    parts.append(accuracy.select(F.lit("accuracy").alias("metric"), blank.alias("part"), F.round("precision", 6).alias("value")))
    parts.append(found["pr_curve"].agg(F.count(F.lit(1)).cast("double").alias("value")).select(F.lit("curve_points").alias("metric"), blank.alias("part"), "value"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
