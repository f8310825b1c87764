"""Isotonic regression over a whole table: pools of points that the adjacent-violators rule has merged.

Points are sorted by range. Inside a range neighbours that fall are merged into pools; a pool (span, weight, sum) stands
for its points from then on, so the next pass works on pools. Passes move the ranges' borders until no pool is under the
one before it. Pooling of pools gives the pools of all points, in any order of merging, so the result is that of one
pass over the sorted table. Points at one place are merged first.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from migrascope.session import ensure_checkpoint_dir

POOL_ROWS = 1_000_000  # pools that a task merges at once
SHARED_POOLS = 200_000  # pools of a map up to which it is sent to every task; beyond, rows are sorted among the pools


def merged(df: DataFrame, groups: list[str]) -> DataFrame:
    """Pools of each partition of sorted (groups, lo, hi, total, weight), with the partition's number."""
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = [*(df.schema[g] for g in groups), *(StructField(n, DoubleType()) for n in ("lo", "hi", "total", "weight"))]
    schema = StructType([*fields, StructField("part", IntegerType())])
    kind, columns = to_arrow_schema(schema), [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        group, stack = None, []
        for batch in batches:
            done = []
            for *at, lo, hi, total, weight in zip(*(batch.column(c).to_pylist() for c in columns), strict=True):
                if at != group:
                    done += [(*group, *pool, part) for pool in stack]
                    group, stack = at, []
                while stack and stack[-1][2] * weight >= total * stack[-1][3]:
                    lo, _, more, heavier = stack.pop()
                    total, weight = total + more, weight + heavier
                stack.append((lo, hi, total, weight))
            if done:
                yield _batch(done, kind)
        if stack:
            yield _batch([(*group, *pool, part) for pool in stack], kind)

    return df.select(columns).mapInArrow(run, schema)


def _batch(rows: list[tuple], kind: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), kind, strict=True)], schema=kind)


def pools(points: DataFrame, groups: list[str], x: str, y: str, weight: str | None = None, pool_rows: int = POOL_ROWS) -> DataFrame:
    """(groups, lo, hi, value, weight): the fitted steps of each group. Rows with a null are left out."""
    ensure_checkpoint_dir(points.sparkSession)
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    known = points.select(*groups, F.col(x).cast("double").alias("lo"), (F.col(y).cast("double") * w).alias("total"), w.alias("weight")).dropna()
    found = known.groupBy(*groups, "lo").agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"))
    found = found.filter("weight > 0").withColumn("hi", F.col("lo")).checkpoint()
    moved = 0
    while True:
        parts = max(1, math.ceil(found.count() / pool_rows))
        parts += moved if parts > 1 else 0
        ranged = found.repartitionByRange(parts, *groups, "lo").sortWithinPartitions(*groups, "lo")
        found = merged(ranged, groups).checkpoint()
        if parts == 1 or not _falls(found, groups):
            return found.select(*groups, "lo", "hi", (F.col("total") / F.col("weight")).alias("value"), "weight")
        moved = (moved + 1) % 3


def _falls(found: DataFrame, groups: list[str]) -> bool:
    """Whether a pool is not over the last one of the range before; a row for each range and group is looked at."""
    value = F.col("total") / F.col("weight")
    ends = found.groupBy(*groups, "part").agg(F.min_by(value, "lo").alias("first"), F.max_by(value, "lo").alias("last"))
    before = F.lag("last").over(Window.partitionBy(*groups).orderBy("part"))
    return not ends.withColumn("before", before).filter("before >= first").isEmpty()


@dataclass
class IsotonicMap:
    """A fitted map: level inside a pool, straight between pools, level beyond the ends."""

    pools: DataFrame  # lo, hi, value
    steps: tuple[np.ndarray, np.ndarray] | None = None  # the same as arrays, if they are few

    @staticmethod
    def of(pools: DataFrame, shared: int = SHARED_POOLS) -> IsotonicMap:
        if pools.count() > shared:
            return IsotonicMap(pools)
        rows = pools.orderBy("lo").collect()  # at most ``shared``
        x = np.array([e for r in rows for e in ((r["lo"], r["hi"]) if r["hi"] > r["lo"] else (r["lo"],))])
        y = np.array([r["value"] for r in rows for _ in range(2 if r["hi"] > r["lo"] else 1)])
        return IsotonicMap(pools, (x, y))

    def save(self, path: str) -> None:
        self.pools.select("lo", "hi", "value").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> IsotonicMap:
        return IsotonicMap.of(spark.read.parquet(path))


def add_mapped(df: DataFrame, maps: dict[str, tuple[str, IsotonicMap]]) -> DataFrame:
    """``df`` with a column for each map: name -> (column it reads, map). Small maps take one narrow pass together."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small = {n: (c, m.steps) for n, (c, m) in maps.items() if m.steps is not None}
    for name, (column, m) in maps.items():
        if m.steps is None:
            df = _sorted_among(df, column, m.pools, name)
    if not small:
        return df
    schema = StructType([*df.schema.fields, *(StructField(n, DoubleType()) for n in small)])
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            for column, (x, y) in small.values():
                at = batch.column(batch.schema.get_field_index(column)).to_numpy(zero_copy_only=False)
                columns.append(pa.array(np.interp(at, x, y) if len(x) else np.full(len(at), np.nan), pa.float64()))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, kind, strict=True)], schema=kind)

    return df.mapInArrow(run, schema)


def _sorted_among(df: DataFrame, column: str, pools: DataFrame, name: str) -> DataFrame:
    """For maps of any size: rows and pools are sorted together by range; a row takes the pool before and after it.

    Inside a range windows find them; across ranges a row for each range tells the nearest pool.
    """
    ensure_checkpoint_dir(df.sparkSession)
    pool = F.struct("lo", "hi", "value")
    steps = pools.select(F.col("lo").alias("__x"), pool.alias("__pool"))
    rows = df.select(F.col(column).cast("double").alias("__x"), F.lit(None).cast(steps.schema["__pool"].dataType).alias("__pool"), F.struct("*").alias("__row"))
    both = rows.unionByName(steps, allowMissingColumns=True).repartitionByRange("__x")
    both = both.withColumn("__part", F.spark_partition_id()).checkpoint()
    near = Window.partitionBy("__part").orderBy("__x", F.col("__pool").isNull())
    back = F.last("__pool", ignorenulls=True).over(near.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first("__pool", ignorenulls=True).over(near.rowsBetween(1, Window.unboundedFollowing))
    ends = both.groupBy("__part").agg(F.min("__pool").alias("first"), F.max("__pool").alias("last"))
    order = Window.orderBy("__part")  # a row for each range
    beside = ends.select(
        "__part",
        F.last("last", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)).alias("__under"),
        F.first("first", ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)).alias("__over"),
    )
    found = both.withColumns({"__back": back, "__ahead": ahead}).filter("__row IS NOT NULL").join(beside, "__part")
    under, over, x = F.coalesce("__back", "__under"), F.coalesce("__ahead", "__over"), F.col("__x")
    found = found.select("__row", x, under.alias("u"), over.alias("o"))
    between = F.col("u.value") + (F.col("o.value") - F.col("u.value")) * (x - F.col("u.hi")) / (F.col("o.lo") - F.col("u.hi"))
    value = F.when(F.col("u").isNull(), F.col("o.value")).when((x <= F.col("u.hi")) | F.col("o").isNull(), F.col("u.value")).otherwise(between)
    return found.select("__row.*", value.alias(name))
