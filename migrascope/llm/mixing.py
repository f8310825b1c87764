"""Mixing sources to target weights: iterative proportional fitting over cells, then calibrated sampling.

Documents are summed to cells (one per combination of margin values) with partial aggregation; everything
iterative runs on the cells, as joins and sums that stay distributed however many sources there are. A round
scales the cells to each margin in turn; rounds end when every value's share is within ``TOLERANCE`` of its own goal
or after ``ROUNDS``; the greatest error left goes with every drawn document. A cell's probability is its weight over its tokens, times one factor that meets the token budget
with no probability above 1. A document is drawn if a hash of its id falls below its cell's probability, so a
draw is repeatable and does not depend on partitions.

Defined cases: null margin values are a value of their own; a value without target keeps its natural share
and the targets share the rest; a target without documents is left out; documents without words weigh nothing
and are drawn like the others of their cell; rows with the same id are drawn together, rows without id by a
hash of their content columns; margins that cannot be met together end at the last round, as the error column
shows; an empty table gives no rows. Other columns pass through; added columns take longer names where theirs
are taken.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from migrascope.llm.common import fresh, saved, written

ROUNDS = 40
TOLERANCE = 1e-6  # of each goal, however small
WORD = r"[^\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Margin:
    """Targets of one column: given shares, or natural shares raised to ``power`` (1 keeps, 0 levels them)."""

    column: str
    shares: tuple[tuple[str, float], ...] = ()
    power: float = 1.0


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cells_of(docs: DataFrame, margins: list[Margin], tokens: str) -> DataFrame:
    """Tokens and documents of each cell."""
    names = [m.column for m in margins]
    return docs.groupBy(*names).agg(F.sum(tokens).cast("double").alias("tokens"), F.count("*").alias("documents"))


def targets(cells: DataFrame, margin: Margin) -> DataFrame:
    """(value, goal): the share of all tokens that each value is to have."""
    sums = cells.groupBy(F.col(margin.column).alias("value")).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0")
    sums = saved(sums)
    total = sums.agg(F.sum("tokens")).first()[0] or 1.0
    natural = sums.select("value", (F.col("tokens") / total).alias("natural"))
    if not margin.shares:
        raised = F.pow("natural", F.lit(margin.power))
        whole = natural.agg(F.sum(raised)).first()[0] or 1.0
        return natural.select("value", (raised / whole).alias("goal"))
    listed = F.create_map(*[F.lit(x) for pair in margin.shares for x in pair])
    marked = natural.withColumn("share", F.try_element_at(listed, F.col("value").cast("string")))
    free = F.sum(F.when(F.col("share").isNull(), F.col("natural")).otherwise(0.0))
    row = marked.agg(free.alias("free"), F.sum("share").alias("asked")).first()
    open_ = 1 - (row["free"] or 0.0)
    return marked.select("value", F.coalesce(F.col("share") / (row["asked"] or 1.0) * open_, "natural").alias("goal"))


def rake(cells: DataFrame, margins: list[Margin], rounds: int = ROUNDS, tolerance: float = TOLERANCE) -> DataFrame:
    """Adds the raked token weight of each cell (their sum is the tokens') and the greatest error of a margin."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0.0
    goals = [saved(targets(cells, m)) for m in margins]
    now = saved(cells.withColumn("weight", F.col("tokens")))
    error = 0.0
    for _ in range(rounds if total else 0):
        for margin, goal in zip(margins, goals, strict=True):
            sums = now.groupBy(F.col(margin.column).alias("value")).agg(F.sum("weight").alias("sum"))
            same = sums["value"].eqNullSafe(goal["value"])
            factor = sums.join(goal, same).select(sums["value"], (F.col("goal") * total / F.col("sum")).alias("factor"))
            scaled = now.join(factor, now[margin.column].eqNullSafe(factor["value"]), "left")
            now = scaled.select(*cells.columns, (F.col("weight") * F.coalesce("factor", F.lit(1.0))).alias("weight"))
            # Each margin is a table: the next one reads it twice, so that one plan of all would double with each
            # margin; a checkpoint keeps what the plan knew, which piles up.
            now = written(now, "raked")
        off = None
        for margin, goal in zip(margins, goals, strict=True):
            sums = now.groupBy(F.col(margin.column).alias("value")).agg(F.sum("weight").alias("sum"))
            met = sums.join(goal, sums["value"].eqNullSafe(goal["value"]))
            one = met.select(F.abs(F.col("sum") / total / F.col("goal") - 1).alias("off"))
            off = one if off is None else off.unionByName(one)
        error = off.agg(F.max("off")).first()[0] or 0.0
        if error <= tolerance:
            break
    return now.withColumn("error", F.lit(float(error)))


def calibrate(raked: DataFrame, fraction: float) -> DataFrame:
    """Adds each cell's probability, at most 1, so that ``fraction`` of all tokens is expected to be drawn.

    Cells that would need more than all their documents give all; the rest is shared among the others.
    """
    budget = fraction * (raked.agg(F.sum("tokens")).first()[0] or 0.0)
    factor = None
    while True:
        full = F.lit(False) if factor is None else F.col("weight") * factor >= F.col("tokens")
        row = raked.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0.0)).alias("given"),
            F.sum(F.when(full, 0.0).otherwise(F.col("weight"))).alias("open"),
        ).first()
        now = max(0.0, budget - (row["given"] or 0.0)) / row["open"] if row["open"] else factor
        if now is None or now == factor or (factor is not None and now <= factor * (1 + 1e-12)):
            factor = factor if now is None else max(now, factor or 0.0)
            break
        factor = now
    wanted = F.col("weight") * F.lit(float(factor or 0.0)) / F.col("tokens")
    return raked.withColumn("probability", F.when(F.col("tokens") > 0, F.least(F.lit(1.0), wanted)).otherwise(fraction))


def uniform(seed: int, *columns: Column) -> Column:
    """A number from 0 up to 1 that follows from the columns."""
    bits = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *columns), 11)
    return bits / F.lit(float(1 << 53))


def sample(docs: DataFrame, calibrated: DataFrame, margins: list[Margin], doc_id: str, content: list[str], seed: int = 1) -> DataFrame:
    """The drawn documents, with ``weight`` (of their cell), ``probability`` and ``error``, the margins' greatest
    relative error when raking ended (over ``TOLERANCE``: the margins can't be met together in ``ROUNDS``)."""
    weight, probability, error = (fresh(docs, n) for n in ("weight", "probability", "error"))
    keys = [F.col(m.column).alias(f"__{i}") for i, m in enumerate(margins)]
    chosen = calibrated.select(*keys, F.col("weight").alias(weight), F.col("probability").alias(probability), F.col("error").alias(error))
    odds = written(chosen, "odds")  # a table of known size: Spark broadcasts it if it is small enough
    same = F.lit(True)
    for i, m in enumerate(margins):
        same &= docs[m.column].eqNullSafe(odds[f"__{i}"])
    key = F.when(F.col(doc_id).isNull(), F.xxhash64(*content)).otherwise(F.xxhash64(F.col(doc_id)))
    draw = fresh(docs, "draw")
    joined = docs.withColumn(draw, uniform(seed, key)).join(odds, same)
    return joined.filter(F.col(draw) < F.col(probability)).drop(draw, *(f"__{i}" for i in range(len(margins))))
