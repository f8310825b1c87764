"""Cross-validation folds that never split a tract, and class weights.

Two kinds of folds: by hash (no shuffle), and balanced by what groups hold (rows, or rows of each label). Balanced folds
go over the groups from the largest on, and each goes to the fold that it suits best. Groups that hold the same are one
class, so the driver sees the classes and not the groups: for rows at most the square root of twice the number of rows.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from migrascope import dims
from migrascope.functions import values


def hash_fold(key: Column, folds: int) -> Column:
    """Fold number from the key alone: no shuffle, and the same on every run."""
    head = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("long")
    return F.pmod(head, F.lit(folds)).cast("int")


def group_folds(df: DataFrame, group: str, folds: int = dims.CV_FOLDS, out: str = "fold") -> DataFrame:
    return df.withColumn(out, hash_fold(F.col(group), folds))


def stratified_fold_table(
    df: DataFrame, group: str, label: str, folds: int = dims.CV_FOLDS, seed: int = dims.CV_SEED
) -> DataFrame:
    """(group, stratum, fold): groups with and without a positive are dealt out evenly.

    Within a stratum, groups are numbered in the order of a seeded digest, and the number modulo
    ``folds`` is the fold. The numbering runs inside slices of the digest space (its first three
    digits), plus the sizes of the slices before, so no task sees a whole stratum.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(group).cast("string")))
    strata = (
        df.groupBy(group)
        .agg(F.max(values.flag(F.col(label) == 1)).alias("stratum"))
        .withColumn("__digest", digest)
        .withColumn("__slice", F.substring("__digest", 1, 3))
    )
    sizes = strata.groupBy("stratum", "__slice").agg(F.count(F.lit(1)).alias("__n"))
    earlier = (
        Window.partitionBy("stratum").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = sizes.select(  # at most 2 x 4096 rows
        "stratum", "__slice", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before")
    )
    inside = Window.partitionBy("stratum", "__slice").orderBy("__digest", group)
    numbered = strata.withColumn("__row", F.row_number().over(inside))
    position = F.col("__before") + F.col("__row") - 1
    return numbered.join(F.broadcast(offsets), ["stratum", "__slice"]).select(
        group, "stratum", F.pmod(position, F.lit(folds)).cast("int").alias("fold")
    )


def stratified_group_folds(
    df: DataFrame, group: str, label: str, folds: int = dims.CV_FOLDS, seed: int = dims.CV_SEED
) -> DataFrame:
    table = stratified_fold_table(df, group, label, folds, seed).select(group, "fold")
    return df.join(table, group)


def fill(loads: list[int], size: int, groups: int) -> list[int]:
    """How many of ``groups`` groups of one size each fold takes, if each goes to the lightest fold (the first of
    equal ones). Most are dealt in bulk: no fold is filled over the level that all groups together reach."""
    low, high = 0, max(loads) + size * groups + 1  # the highest level up to which the groups suffice
    while high - low > 1 and size:
        level = (low + high) // 2
        low, high = (level, high) if sum(max(0, level - load) // size for load in loads) <= groups else (low, level)
    taken = [max(0, low - load) // size if size else 0 for load in loads]
    heap = [(load + size * n, i) for i, (load, n) in enumerate(zip(loads, taken, strict=True))]
    heapq.heapify(heap)
    for _ in range(groups - sum(taken)):
        load, i = heapq.heappop(heap)
        taken[i] += 1
        heapq.heappush(heap, (load + size, i))
    return taken


def fill_labels(held: np.ndarray, labels: tuple[int, ...], groups: int, total: np.ndarray) -> list[int]:
    """How many groups with these label counts each fold takes.

    A group goes to the fold for which the labels' shares then differ least between folds (of equal ones, to the one
    with fewer rows, then the first). Whole rounds over all folds change no difference and are dealt in bulk.
    """
    folds = len(held)
    taken = [groups // folds] * folds
    now = held + np.outer(taken, labels)
    for _ in range(groups % folds):
        spread = []
        for i in range(folds):
            after = now.copy()
            after[i] += labels
            spread.append((round(float((after / total).std(axis=0).mean()), 12), int(now[i].sum()), i))
        i = min(spread)[2]
        now[i] += labels
        taken[i] += 1
    return taken


def _dealt(classes: list[tuple[tuple, list[int]]], groups: DataFrame, key: list[str], group: str, out: str, seed: int) -> DataFrame:
    """(group, fold): within a class, groups are numbered by a digest and cut into the folds' shares.

    Numbers run inside slices of the digest space, plus the sizes of the slices before, so no task sees a class.
    """
    spark = groups.sparkSession
    rows = []
    for counts, taken in classes:
        ends = np.cumsum([0, *taken]).tolist()
        rows += [(*counts, fold, ends[fold], ends[fold + 1]) for fold in range(len(taken)) if taken[fold]]
    schema = ", ".join([*(f"{k} long" for k in key), f"{out} int", "__from long", "__to long"])
    shares = spark.createDataFrame(rows, schema)
    digest = F.md5(F.concat(F.lit(f"{seed}|"), F.col(group).cast("string")))
    sliced = groups.withColumn("__digest", digest).withColumn("__slice", F.substring("__digest", 1, 3))
    sizes = sliced.groupBy(*key, "__slice").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*key).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*key, "__slice", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    number = F.row_number().over(Window.partitionBy(*key, "__slice").orderBy("__digest", group))
    numbered = sliced.withColumn("__row", number).join(offsets, [*key, "__slice"])
    place = F.col("__before") + F.col("__row") - 1
    return numbered.withColumn("__place", place).join(shares, key).filter("__from <= __place AND __place < __to").select(group, out)


def balanced_fold_table(df: DataFrame, group: str, folds: int = dims.CV_FOLDS, out: str = "fold", seed: int = dims.CV_SEED) -> DataFrame:
    """(group, fold) with folds of nearly equal rows, the largest group first, each to the lightest fold.

    Folds differ by no more rows than the largest group has. Rows without a group are a group.
    """
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__size"))
    loads, classes = [0] * folds, []
    for r in sizes.groupBy("__size").agg(F.count(F.lit(1)).alias("m")).orderBy(F.desc("__size")).collect():
        taken = fill(loads, r["__size"], r["m"])
        loads = [load + r["__size"] * n for load, n in zip(loads, taken, strict=True)]
        classes.append(((r["__size"],), taken))
    return _dealt(classes, sizes, ["__size"], group, out, seed)


def balanced_group_folds(df: DataFrame, group: str, folds: int = dims.CV_FOLDS, out: str = "fold") -> DataFrame:
    table = balanced_fold_table(df, group, folds, out).withColumnRenamed(group, "__group")
    return df.join(table, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")


def label_fold_table(
    df: DataFrame, group: str, label: str, folds: int = dims.CV_FOLDS, out: str = "fold", seed: int = dims.CV_SEED
) -> DataFrame:
    """(group, fold) with nearly equal shares of label 0 and 1 in all folds; rows without a label do not count.

    Groups with the most uneven label counts come first, as they are the hardest to even out.
    """
    flags = {f"__{k}": F.sum(values.flag(F.col(label) == k)) for k in (0, 1)}
    counts = df.groupBy(group).agg(*[c.alias(n) for n, c in flags.items()])
    found = [((r["__0"], r["__1"]), r["m"]) for r in counts.groupBy("__0", "__1").agg(F.count(F.lit(1)).alias("m")).collect()]
    total = np.maximum(np.array([sum(c[k] * m for c, m in found) for k in (0, 1)], float), 1.0)
    held, classes = np.zeros((folds, 2)), []
    for labels, m in sorted(found, key=lambda x: (-abs(x[0][0] - x[0][1]) / 2, -sum(x[0]), x[0])):
        taken = fill_labels(held, labels, m, total)
        held = held + np.outer(taken, labels)
        classes.append((labels, taken))
    return _dealt(classes, counts, ["__0", "__1"], group, out, seed)


def balanced_weights(df: DataFrame, label: str) -> DataFrame:
    """(label, n, weight) with weight = rows / (2 x rows of the class)."""
    counts = df.filter(F.col(label).isNotNull()).agg(
        F.sum(values.flag(F.col(label) == 0)).alias("c0"),
        F.sum(values.flag(F.col(label) == 1)).alias("c1"),
    )
    total = F.col("c0") + F.col("c1")
    rows = F.array(
        *[
            F.struct(
                F.lit(k).alias("label"),
                F.col(f"c{k}").alias("n"),
                values.ratio(total, F.col(f"c{k}") * 2).alias("weight"),
            )
            for k in (0, 1)
        ]
    )
    return counts.select(F.inline(rows)).filter("n > 0")
