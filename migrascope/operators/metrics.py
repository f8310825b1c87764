"""Model evaluation, exact and distributed. Every metric can be taken per group.

Undefined values (a metric of an empty class) are NULL, except in the classification report,
where 0/0 counts as 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import values
from migrascope.operators.order_stats import RANGE_ROWS, quantiles, quantiles_of_many, running_totals


def _grouped(df: DataFrame, groups: list[str] | None, *aggregates: Column) -> DataFrame:
    return df.groupBy(*groups).agg(*aggregates) if groups else df.agg(*aggregates)


def regression_metrics(
    df: DataFrame, actual: str, predicted: str, groups: list[str] | None = None
) -> DataFrame:
    """Row count, MAE, RMSE and R squared; rows with a NULL on either side are left out."""
    rows = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    error = F.col(actual) - F.col(predicted)
    spread = F.var_pop(actual) * F.count(F.lit(1))
    return _grouped(
        rows,
        groups,
        F.count(F.lit(1)).alias("n"),
        F.avg(F.abs(error)).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.lit(1.0) - values.ratio(F.sum(error * error), spread)).alias("r2"),
    )


def mean_scores(folds: DataFrame, metrics: list[str]) -> DataFrame:
    return folds.agg(*[F.avg(m).alias(m) for m in metrics])


def brier_score(df: DataFrame, label: str, prob: str, groups: list[str] | None = None) -> DataFrame:
    gap = F.col(prob) - F.col(label)
    return _grouped(df, groups, F.avg(gap * gap).alias("brier_score"))


def class_totals(
    df: DataFrame, label: str, prob: str, groups: list[str] | None, range_rows: int | None
) -> DataFrame:
    """Positives and negatives at and below every distinct score."""
    counts = {
        "pos": F.sum(values.flag(F.col(label) == 1)),
        "neg": F.sum(values.flag(F.col(label) == 0)),
    }
    rows = df.filter(F.col(label).isNotNull())
    return running_totals(rows, prob, counts, groups, range_rows)


def roc_auc(
    df: DataFrame, label: str, prob: str, groups: list[str] | None = None, range_rows: int | None = RANGE_ROWS
) -> DataFrame:
    """Area under the ROC curve: the chance that a positive outranks a negative, ties half."""
    totals = class_totals(df, label, prob, groups, range_rows)
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    return _grouped(totals, groups, values.ratio(won, pairs).alias("roc_auc"))


def _from_above() -> tuple[Column, Column]:
    """Positives and negatives with a score at or above the row's."""
    return (
        F.col("pos_total") - F.col("pos_below"),
        F.col("neg_total") - F.col("neg_below"),
    )


def average_precision(
    df: DataFrame, label: str, prob: str, groups: list[str] | None = None, range_rows: int | None = RANGE_ROWS
) -> DataFrame:
    """Precision at each distinct threshold, weighted by the recall gained there."""
    totals = class_totals(df, label, prob, groups, range_rows)
    hits, misses = _from_above()
    gained = values.ratio(F.col("pos"), F.col("pos_total"))
    return _grouped(
        totals, groups, F.sum(gained * values.ratio(hits, hits + misses)).alias("average_precision")
    )


def classification_metrics(
    df: DataFrame, label: str, prob: str, groups: list[str] | None = None, range_rows: int | None = RANGE_ROWS
) -> DataFrame:
    """ROC-AUC, average precision and Brier score out of the same class totals."""
    totals = class_totals(df, label, prob, groups, range_rows)
    hits, misses = _from_above()
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    gained = values.ratio(F.col("pos"), F.col("pos_total"))
    p = F.col(prob)
    squares = F.col("pos") * (1 - p) * (1 - p) + F.col("neg") * p * p
    return _grouped(
        totals,
        groups,
        values.ratio(won, pairs).alias("roc_auc"),
        F.sum(gained * values.ratio(hits, hits + misses)).alias("pr_auc"),
        values.ratio(F.sum(squares), F.sum(F.col("pos") + F.col("neg"))).alias("brier_score"),
    )


def pr_curve(
    df: DataFrame, label: str, prob: str, groups: list[str] | None = None, range_rows: int | None = RANGE_ROWS
) -> DataFrame:
    """Precision and recall at every distinct threshold, plus the end point (1, 0)."""
    totals = class_totals(df, label, prob, groups, range_rows)
    hits, misses = _from_above()
    keys = groups or []
    curve = totals.select(
        *keys,
        F.col(prob).alias("threshold"),
        values.ratio(hits, hits + misses).alias("precision"),
        values.ratio(hits, F.col("pos_total")).alias("recall"),
    )
    ends = _grouped(df.filter(F.col(label).isNotNull()), groups, F.count(F.lit(1)).alias("n"))
    end = ends.filter("n > 0").select(
        *keys,
        F.lit(None).cast("double").alias("threshold"),
        F.lit(1.0).alias("precision"),
        F.lit(0.0).alias("recall"),
    )
    return curve.unionByName(end)


def _cells(label: str, predicted: str, count: str | None = None) -> dict[tuple[int, int], Column]:
    n = F.col(count) if count else F.lit(1)
    return {
        (y, p): F.coalesce(
            F.sum(values.flag((F.col(label) == y) & (F.col(predicted) == p)) * n), F.lit(0)
        )
        for y in (0, 1)
        for p in (0, 1)
    }


def confusion_matrix(df: DataFrame, label: str, predicted: str, count: str | None = None) -> DataFrame:
    """Four rows (actual, predicted, n), empty cells included; ``count``: how many rows each row stands for."""
    cells = _cells(label, predicted, count)
    one = df.agg(*[c.alias(f"c{y}{p}") for (y, p), c in cells.items()])
    rows = F.array(
        *[
            F.struct(
                F.lit(y).alias("actual"),
                F.lit(p).alias("predicted"),
                F.col(f"c{y}{p}").cast("long").alias("n"),
            )
            for y, p in cells
        ]
    )
    return one.select(F.inline(rows))


def classification_report(df: DataFrame, label: str, predicted: str, count: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted means."""
    one = df.agg(*[c.cast("double").alias(f"c{y}{p}") for (y, p), c in _cells(label, predicted, count).items()])

    def share(a: Column, b: Column) -> Column:
        return F.coalesce(F.try_divide(a, b), F.lit(0.0))

    total = F.col("c00") + F.col("c01") + F.col("c10") + F.col("c11")
    per_class = []
    for k in (0, 1):
        right = F.col(f"c{k}{k}")
        support = F.col(f"c{k}0") + F.col(f"c{k}1")
        precision = share(right, F.col(f"c0{k}") + F.col(f"c1{k}"))
        recall = share(right, support)
        per_class.append((precision, recall, share(precision * recall * 2, precision + recall), support))
    accuracy = share(F.col("c00") + F.col("c11"), total)

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            precision.alias("precision"),
            recall.alias("recall"),
            f1.alias("f1"),
            support.cast("long").alias("support"),
        )

    zero, one_class = per_class
    macro = [(zero[i] + one_class[i]) / 2.0 for i in range(3)]
    weighted = [share(zero[i] * zero[3] + one_class[i] * one_class[3], total) for i in range(3)]
    rows = F.array(
        row("0", *zero),
        row("1", *one_class),
        row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", *macro, total),
        row("weighted avg", *weighted, total),
    )
    return one.select(F.inline(rows))


def bucket_by_cuts(column: Column, cuts: list[float], names: list[str]) -> Column:
    """Right-closed buckets between ascending cut points, the lowest included.

    Equal cut points leave a bucket empty: a value goes to the first bucket that reaches it.
    """
    bucket = F.lit(None).cast("string")
    for upper, name in reversed(list(zip(cuts[1:], names, strict=True))):
        bucket = F.when(column <= upper, name).otherwise(bucket)
    return F.when(column.isNotNull() & (column >= cuts[0]), bucket)


def quantile_buckets(
    df: DataFrame, column: str, names: list[str], out: str, range_rows: int | None = RANGE_ROWS
) -> DataFrame:
    """Equal-frequency buckets; equal values share a bucket, unlike ntile."""
    parts = len(names)
    cuts = quantiles(df, column, [i / parts for i in range(parts + 1)], range_rows)
    if cuts is None:
        return df.withColumn(out, F.lit(None).cast("string"))
    return df.withColumn(out, bucket_by_cuts(F.col(column), cuts, names))


def error_by_bucket(
    df: DataFrame, actual: str, predicted: str, size: str = "total_pop", names: list[str] | None = None
) -> DataFrame:
    """MAE per population quintile."""
    bucketed = quantile_buckets(df, size, names or dims.POPULATION_BUCKETS, "bucket")
    error = F.abs(F.col(actual) - F.col(predicted))
    return bucketed.filter(F.col("bucket").isNotNull()).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"), F.avg(error).alias("mae")
    )


def winsorize(
    df: DataFrame, column: str, probs: tuple[float, float] = dims.WINSOR_PROBS, out: str | None = None
) -> DataFrame:
    """Clip a column to its 1st and 99th percentile. Undefined values are set to 0 first."""
    clean = df.withColumn(out or column, values.finite_or_zero(F.col(column)))
    bounds = quantiles(clean, out or column, list(probs))
    if bounds is None:
        return clean
    return clean.withColumn(out or column, values.clip(F.col(out or column), *bounds))


def winsorize_many(
    df: DataFrame, columns: list[str], probs: tuple[float, float] = dims.WINSOR_PROBS, range_rows: int | None = RANGE_ROWS
) -> DataFrame:
    """Clip each column to its own percentiles, all bounds from one range sort. NULL stays NULL; other undefined
    values are set to 0 first."""
    clean = df.withColumns({c: F.when(F.col(c).isNotNull(), values.finite_or_zero(F.col(c))) for c in columns})
    bounds = quantiles_of_many(clean, columns, list(probs), range_rows)
    return clean.withColumns({c: values.clip(F.col(c), *b) for c, b in bounds.items()})


def totals_report(totals: DataFrame, prob: str, threshold: float = 0.5) -> dict[str, DataFrame]:
    """Every classification metric from stored ``class_totals`` alone, at a decision threshold where one is needed.

    Counts per score hold all that area, precision, Brier score, curve, cells and report need, so the rows are not
    read again.
    """
    hits, misses = _from_above()
    won = F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))
    pairs = F.max(F.col("pos_total").cast("double") * F.col("neg_total"))
    gained = values.ratio(F.col("pos"), F.col("pos_total"))
    p = F.col(prob)
    squares = F.col("pos") * (1 - p) * (1 - p) + F.col("neg") * p * p
    curve = totals.select(
        p.alias("threshold"), values.ratio(hits, hits + misses).alias("precision"), values.ratio(hits, F.col("pos_total")).alias("recall")
    )
    end = totals.limit(1).select(F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    # A row per class and decision, which stands for as many rows as its count.
    cell = F.struct(F.lit(1).alias("y"), F.col("pos").alias("n")), F.struct(F.lit(0).alias("y"), F.col("neg").alias("n"))
    decided = totals.select(values.flag(p >= threshold).alias("d"), F.inline(F.array(*cell)))
    cells = decided.groupBy("y", "d").agg(F.sum("n").alias("n"))
    return {
        "roc_auc": totals.agg(values.ratio(won, pairs).alias("roc_auc")),
        "average_precision": totals.agg(F.sum(gained * values.ratio(hits, hits + misses)).alias("average_precision")),
        "brier_score": totals.agg(values.ratio(F.sum(squares), F.sum(F.col("pos") + F.col("neg"))).alias("brier_score")),
        "classification_report": classification_report(cells, "y", "d", "n"),
        "confusion_matrix": confusion_matrix(cells, "y", "d", "n"),
        "pr_curve": curve.unionByName(end),
    }


def calibration_by_decile(
    df: DataFrame, label: str, prob: str, size: str, deciles: int = 10
) -> DataFrame:
    """Mean predicted and observed rate per decile of another column (e.g. income)."""
    names = [str(i) for i in range(1, deciles + 1)]
    bucketed = quantile_buckets(df, size, names, "decile").filter(F.col("decile").isNotNull())
    return bucketed.groupBy(F.col("decile").cast("int").alias("decile")).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(prob).alias("mean_predicted"),
        F.avg(F.col(label).cast("double")).alias("observed_rate"),
    )


def equalized_odds(df: DataFrame, label: str, predicted: str, group: str) -> DataFrame:
    """True and false positive rate per group."""
    hit = F.col(predicted).cast("double")
    return df.groupBy(group).agg(
        F.avg(F.when(F.col(label) == 1, hit)).alias("tpr"),
        F.avg(F.when(F.col(label) == 0, hit)).alias("fpr"),
    )


def equalized_odds_gap(rates: DataFrame) -> DataFrame:
    """Largest difference of either rate between groups."""
    return rates.agg(
        (F.max("tpr") - F.min("tpr")).alias("max_tpr_gap"),
        (F.max("fpr") - F.min("fpr")).alias("max_fpr_gap"),
    )
