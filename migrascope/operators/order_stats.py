"""Exact running totals and quantiles over the whole table without a one-task window.

Rows are first summed per distinct value, so a value shared by a third of the table is one row.
Distinct values are then range-partitioned and saved once. A window runs inside each range, and the
totals of the ranges below are added on top.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from migrascope.session import ensure_checkpoint_dir


RANGE_ROWS: int | None = None  # distinct values of a range; None: as many ranges as shuffle partitions


def _ranges(distinct: DataFrame, keys: list[str], range_rows: int | None) -> DataFrame:
    """Add ``__range``, a number of the range (one Spark partition) that keeps the order of the keys.

    The result is saved, so that every use of it sees the same ranges.
    """
    ensure_checkpoint_dir(distinct.sparkSession)
    if range_rows is None:
        parts = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    else:
        parts = max(1, math.ceil(distinct.count() / range_rows))
    ranged = distinct.repartitionByRange(parts, *keys)
    return ranged.withColumn("__range", F.spark_partition_id()).checkpoint()


def running_totals(
    df: DataFrame,
    value: str,
    sums: dict[str, Column],
    groups: list[str] | None = None,
    range_rows: int | None = RANGE_ROWS,
) -> DataFrame:
    """One row per group and distinct value, ascending.

    For each name in ``sums``: the sum at that value (``name``), the sum over all smaller values
    (``name_below``) and the group's total (``name_total``). NULL and NaN values are left out.
    """
    groups = groups or []
    ordered = df.withColumn(value, F.col(value).cast("double")).filter(
        F.col(value).isNotNull() & ~F.isnan(value)
    )
    distinct = ordered.groupBy(*groups, value).agg(*[c.alias(n) for n, c in sums.items()])
    ranged = _ranges(distinct, [*groups, value], range_rows)
    totals = ranged.groupBy(*groups, "__range").agg(*[F.sum(n).alias(n) for n in sums])
    lower = Window.partitionBy(*groups).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = totals.select(  # a row per range and group
        *groups,
        "__range",
        *[F.coalesce(F.sum(n).over(lower), F.lit(0)).alias(f"__{n}_offset") for n in sums],
        *[F.sum(n).over(whole).alias(f"{n}_total") for n in sums],
    )
    inside = (
        Window.partitionBy(*groups, "__range")
        .orderBy(value)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    partial = ranged.select(
        "*", *[F.coalesce(F.sum(n).over(inside), F.lit(0)).alias(f"__{n}_inside") for n in sums]
    )
    return partial.join(offsets, [*groups, "__range"]).select(
        *groups,
        value,
        *sums,
        *[(F.col(f"__{n}_inside") + F.col(f"__{n}_offset")).alias(f"{n}_below") for n in sums],
        *[f"{n}_total" for n in sums],
    )


def quantiles(
    df: DataFrame, column: str, probs: list[float], range_rows: int | None = RANGE_ROWS
) -> list[float] | None:
    """Exact quantiles with linear interpolation between neighbours; None for an empty column.

    Returns plain numbers (one per probability) for use as literals in later plans.
    """
    totals = running_totals(df, column, {"n": F.count(F.lit(1))}, range_rows=range_rows)
    first, last = F.col("n_below"), F.col("n_below") + F.col("n")  # ranks [first, last)
    found = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        for side, rank in (("lo", F.floor(position)), ("hi", F.ceil(position))):
            found.append(F.max(F.when((first <= rank) & (rank < last), F.col(column))).alias(f"{side}{i}"))
    row = totals.agg(F.max("n_total").alias("n"), *found).first()
    if row is None or row["n"] is None:
        return None
    out = []
    for i, p in enumerate(probs):
        position = p * (row["n"] - 1)
        low, high = row[f"lo{i}"], row[f"hi{i}"]
        out.append(low + (high - low) * (position - math.floor(position)))
    return out


def quantiles_of_many(
    df: DataFrame, columns: list[str], probs: list[float], range_rows: int | None = RANGE_ROWS
) -> dict[str, list[float]]:
    """``quantiles`` of many columns at once; a column without values is left out.

    All columns' values share one range sort by (column, value). A value answers the ranks that fall among its
    copies, so two rows a column and probability come back, whatever the size of the table.
    """
    if not columns:
        return {}
    pair = [F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns]
    stacked = df.select(F.explode(F.array(*pair)).alias("pair")).select("pair.*")
    totals = running_totals(stacked, "value", {"n": F.count(F.lit(1))}, ["column"], range_rows)
    asked = []
    for i, p in enumerate(probs):
        position = F.lit(float(p)) * (F.col("n_total") - 1)
        for side, rank in ((0, F.floor(position)), (1, F.ceil(position))):
            mine = (F.col("n_below") <= rank) & (rank < F.col("n_below") + F.col("n"))
            asked.append(F.when(mine, F.struct(F.lit(i).alias("i"), F.lit(side).alias("side"))))
    found = totals.select("column", "value", "n_total", F.explode(F.array_compact(F.array(*asked))).alias("a"))
    ends: dict[str, dict] = {}
    for r in found.select("column", "value", "n_total", "a.*").collect():
        ends.setdefault(r["column"], {})[r["i"], r["side"]] = (r["value"], r["n_total"])
    out = {}
    for column, sides in ends.items():
        out[column] = []
        for i, p in enumerate(probs):
            (low, n), (high, _) = sides[i, 0], sides[i, 1]
            position = p * (n - 1)
            out[column].append(low + (high - low) * (position - math.floor(position)))
    return out


def sample_rows(df: DataFrame, key: str, n: int, seed: int | None = None) -> DataFrame:
    """At most ``n`` rows in the order of a digest of the key: a repeatable random sample."""
    text = F.col(key).cast("string")
    digest = F.md5(text if seed is None else F.concat(F.lit(f"{seed}|"), text))
    return df.orderBy(digest, key).limit(n)
