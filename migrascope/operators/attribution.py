"""Per-row attributions of a forest: how much each input moved a prediction from the mean, as Shapley values.

What an absent input does is told by the trees themselves: a row without it goes both ways at a split, in the shares of
the training rows that went there. For each leaf, only the inputs on its path matter. A path is a list of (input, share
of rows that stay on it, whether this row stays on it). The sum over all subsets of the path's inputs is a polynomial:
one factor an input, whose coefficients count subsets by size; an input's own part is the polynomial without its factor.
A leaf's paths of equal inputs are merged first. All rows of a batch are handled at once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from migrascope.operators.boosting import Forest, Tree, matrix


def paths(tree: Tree, cuts: np.ndarray) -> Iterator[tuple[int, dict[int, tuple[float, float, float]]]]:
    """Each leaf with the inputs on its path: share of rows that stay, and the values (low, high] that stay."""
    stack: list[tuple[int, dict]] = [(0, {})]
    while stack:
        node, path = stack.pop()
        if tree.left[node] < 0:
            yield node, path
            continue
        f, cut, total = int(tree.feature[node]), float(cuts[node]), tree.cover[tree.left[node]] + tree.cover[tree.right[node]]
        share, low, high = path.get(f, (1.0, -math.inf, math.inf))
        for child, bounds in ((tree.left[node], (low, min(high, cut))), (tree.right[node], (max(low, cut), high))):
            stack.append((int(child), path | {f: (share * tree.cover[child] / total, *bounds)}))


def shapley(tree: Tree, cuts: np.ndarray, table: np.ndarray, out: np.ndarray) -> float:
    """Adds the tree's attributions to ``out`` (inputs x rows); returns the tree's mean value."""
    mean = 0.0
    for leaf, path in paths(tree, cuts):
        value = tree.value[leaf]
        mean += value * math.prod(share for share, _, _ in path.values())
        d = len(path)
        if not d or not value:
            continue
        inputs = list(path)
        zero = np.array([path[f][0] for f in inputs])
        low, high = (np.array([path[f][i] for f in inputs])[:, None] for i in (1, 2))
        at = table[inputs]
        one = ((at > low) & (at <= high)).astype(float)  # inputs of the path x rows
        weight = np.array([math.factorial(k) * math.factorial(d - 1 - k) / math.factorial(d) for k in range(d)])
        for i, f in enumerate(inputs):
            poly = np.zeros((d, table.shape[1]))  # by how many of the other inputs are there
            poly[0] = 1.0
            for j in range(d):
                if j != i:
                    grown = poly * zero[j]
                    grown[1:] += poly[:-1] * one[j]
                    poly = grown
            out[f] += value * (one[i] - zero[i]) * (weight @ poly)
    return mean


def explained(forest: Forest, table: np.ndarray) -> tuple[float, np.ndarray]:
    """Mean margin and attributions (inputs x rows): their sum over the inputs is the row's margin less the mean."""
    out, base = np.zeros((len(forest.inputs), table.shape[1])), forest.start
    for i in range(forest.trees):
        base += shapley(*forest.tree(i), table, out)
    return base, out


def attributions(df: DataFrame, forest: Forest, keys: list[str]) -> DataFrame:
    """``keys``, ``base`` and a column per input; of a classifier in log odds. A narrow pass over any number of rows."""
    from pyspark.sql.pandas.types import to_arrow_schema

    kept = df.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)], *forest.inputs)
    schema = StructType([*(df.schema[k] for k in keys), *(StructField(n, DoubleType()) for n in ("base", *(f"shap_{c}" for c in forest.inputs)))])
    kind = to_arrow_schema(schema)
    shared = df.sparkSession.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, parts = explained(shared.value, matrix(batch, shared.value.inputs))
            columns = [*batch.columns[: len(keys)], pa.array(np.full(batch.num_rows, base)), *(pa.array(p) for p in parts)]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, kind, strict=True)], schema=kind)

    return kept.mapInArrow(run, schema)
