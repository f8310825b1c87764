"""An inner equi-join that stays balanced when few keys hold many rows on both sides."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migrascope.session import ensure_checkpoint_dir

HEAVY_KEY_PAIRS = 4_000_000  # row pairs of one key that a single task may produce
BROADCAST_KEYS = 100_000  # up to so many split keys go to every task; more are joined by key


def split_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    left_id: str,
    right_id: str,
    heavy: int = HEAVY_KEY_PAIRS,
) -> DataFrame:
    """Inner join on ``on``; a key with more than ``heavy`` pairs is cut into blocks.

    Each side of such a key is divided by a hash of its id, and every left part meets every right
    part exactly once. Keys are counted with partial aggregation. The inputs are read for the count and
    again for the join: pass saved frames where they are dear to compute.
    """
    ensure_checkpoint_dir(left.sparkSession)
    side = max(1, math.isqrt(heavy))
    counted = left.groupBy(*on).agg(F.count(F.lit(1)).alias("__nl")).join(
        right.groupBy(*on).agg(F.count(F.lit(1)).alias("__nr")), on
    )
    pairs = F.col("__nl").cast("double") * F.col("__nr")
    cut = counted.filter(pairs > heavy).select(
        *on,
        F.ceil(F.col("__nl") / side).alias("__pl"),
        F.ceil(F.col("__nr") / side).alias("__pr"),
    )
    parts = cut.checkpoint()
    split_keys = parts.count()
    if not split_keys:
        return left.join(right, on)
    if split_keys <= BROADCAST_KEYS:
        parts = F.broadcast(parts)

    def block(df: DataFrame, row_id: str, own: str, other: str) -> DataFrame:
        own_count, other_count = (F.coalesce(c, F.lit(1)) for c in (f"__p{own}", f"__p{other}"))
        keyed = df.join(parts, on, "left").select(
            *df.columns,
            F.pmod(F.xxhash64(row_id), own_count).alias(f"__{own}"),
            F.explode(_upto(other_count)).alias(f"__{other}"),
        )
        return keyed

    return (
        block(left, left_id, "l", "r")
        .join(block(right, right_id, "r", "l"), [*on, "__l", "__r"])
        .drop("__l", "__r")
    )


def _upto(count: Column) -> Column:
    return F.sequence(F.lit(0).cast("long"), count.cast("long") - 1)
