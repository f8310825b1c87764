"""Boosted trees over histograms, many models at once.

Inputs are cut into at most ``bins`` bins by quantiles, once, and rows are stored as blocks of binned inputs with all
targets and fold numbers. A model is a key: a target, the fold it leaves out, and its loss. All models share the blocks.

A tree grows leaf by leaf, the leaf with the largest gain first, to ``leaves`` leaves. What a leaf needs is a table of
gradient, curvature and rows per input and bin. One round asks for the tables of all leaves that may be next, of all
models: blocks make partial tables, the shuffle adds them up per (model, leaf), the best split is found where a table
ends up, and only splits come back to the driver. So the number of jobs does not grow with the number of models.

Where the stored blocks are small (``GATHERED_BYTES``, measured), a round as a job would be all overhead; then blocks
are broadcast and a task trains a model with the same functions. Both ways give the same trees.

After each tree the error on the left-out fold is taken. A model with patience stops when the error has not fallen for so
many trees, and is cut back to its best length.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from migrascope.session import ensure_checkpoint_dir

BLOCK_ROWS = 4096
GATHERED_BYTES = 4_000_000  # of stored blocks up to which a task holds all of them
SKETCH = 10_000  # accuracy of the quantiles that bins are cut at; exact up to about so many distinct values
CHECKPOINT_TREES = 10  # after so many trees the scores of all rows are stored anew
LEAST_CURVATURE = 1e-3


@dataclass(frozen=True)
class Settings:
    """What a model is grown by. ``loss`` is huber, squared or logistic."""

    trees: int
    learning_rate: float
    leaves: int
    min_rows: int
    row_share: float = 0.8
    feature_share: float = 0.8
    l1: float = 0.1
    l2: float = 0.2
    patience: int = 100
    bins: int = 63
    loss: str = "huber"
    huber_quantile: float = 0.85
    seed: int = 42


@dataclass(frozen=True)
class Spec:
    """A model to fit: its target's place, and the fold of a fold column that it does not see (-1: none)."""

    name: str
    target: int
    fold_column: int = 0
    held: int = -1
    early: bool = False  # stop by the error on the fold that is left out
    start: float = 0.0
    delta: float = math.inf
    weights: tuple[float, float] = (1.0, 1.0)


@dataclass
class Tree:
    """Flat arrays, a place per node; a leaf has no left child. Rows go left up to and with ``cut``."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray

    def leaves_of(self, table: np.ndarray, cuts: np.ndarray | None = None) -> np.ndarray:
        """The leaf of each column of ``table``, whose rows are inputs: bins, or values with ``cuts`` per node."""
        limit = self.cut if cuts is None else cuts
        at = np.zeros(table.shape[1], np.int32)
        live = np.arange(table.shape[1]) if self.left[0] >= 0 else np.zeros(0, np.int64)
        while len(live):
            node = at[live]
            low = table[self.feature[node], live] <= limit[node]
            node = np.where(low, self.left[node], self.right[node])
            at[live] = node
            live = live[self.left[node] >= 0]
        return at


@dataclass
class Block:
    """Rows: bins (inputs x rows), targets (NaN: none), fold numbers and a hash of each row's key."""

    bins: np.ndarray
    targets: np.ndarray
    folds: np.ndarray
    key: np.ndarray

    def parts(self, spec: Spec) -> tuple[np.ndarray, np.ndarray]:
        """Rows to learn from and rows left out."""
        known = ~np.isnan(self.targets[spec.target])
        held = self.folds[spec.fold_column] == spec.held
        return known & ~held, known & held


def joined(blocks: list[Block]) -> Block:
    return Block(*(np.concatenate([getattr(b, n) for b in blocks], axis=-1) for n in ("bins", "targets", "folds", "key")))


# --- Losses ---


def gradients(settings: Settings, spec: Spec, y: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the loss at each row's score."""
    if settings.loss == "logistic":
        p = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
        weight = np.where(y > 0, spec.weights[1], spec.weights[0])
        return weight * (p - y), weight * p * (1 - p)
    gap = score - y
    return (np.clip(gap, -spec.delta, spec.delta) if settings.loss == "huber" else gap), np.ones(len(y))


def error(settings: Settings, y: np.ndarray, score: np.ndarray) -> float:
    """Sum over rows of what patience watches: absolute error, or negative log likelihood."""
    if settings.loss != "logistic":
        return float(np.abs(y - score).sum())
    return float(np.logaddexp(0, np.where(y > 0, -score, score)).sum())


# --- One tree ---


def features_of(settings: Settings, tree: int, n: int) -> np.ndarray:
    """The inputs that a tree may split by."""
    picked = max(1, round(settings.feature_share * n))
    return np.sort(np.random.default_rng([settings.seed, tree]).permutation(n)[:picked])


def sampled(settings: Settings, tree: int, key: np.ndarray) -> np.ndarray:
    """Rows that a tree learns from, by a hash of row and tree."""
    if settings.row_share >= 1:
        return np.ones(len(key), bool)
    x = key + np.uint64((0x9E3779B97F4A7C15 * (tree + 1 + settings.seed)) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(31))) < np.uint64(int(settings.row_share * 2**64))


def tables(bins: np.ndarray, slot: np.ndarray, slots: int, g: np.ndarray, h: np.ndarray, width: int) -> np.ndarray:
    """(slot, 3, input, bin): sums of gradient, curvature and rows; a negative slot is left out."""
    rows = np.flatnonzero(slot >= 0)
    n = len(bins)
    place = bins[:, rows].astype(np.int64) + np.arange(n)[:, None] * width + (slot[rows] * (n * width))[None, :]
    size, place = slots * n * width, place.ravel()
    out = [np.bincount(place, np.tile(x[rows], n), size) for x in (g, h)]
    out.append(np.bincount(place, minlength=size).astype(float))
    return np.stack(out).reshape(3, slots, n, width).swapaxes(0, 1)


def shrunk(g: np.ndarray, l1: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - l1, 0)


Split = tuple[float, int, int, tuple, tuple]  # gain, place among the inputs, bin, sums left and right


def best_split(table: np.ndarray, settings: Settings) -> tuple[tuple, Split | None]:
    """Sums of a leaf and its best split; of equal gains the first input and bin."""
    upto = table.cumsum(-1)
    total = upto[:, :1, -1:]
    left = upto[:, :, :-1]
    right = total - left

    def worth(s: np.ndarray) -> np.ndarray:
        return shrunk(s[0], settings.l1) ** 2 / (s[1] + settings.l2)

    gain = worth(left) + worth(right) - worth(total)
    fits = np.minimum(left[2], right[2]) >= max(settings.min_rows, 1)
    gain = np.where(fits & (np.minimum(left[1], right[1]) >= LEAST_CURVATURE), gain, -np.inf)
    sums = tuple(float(x) for x in total.ravel())
    if not gain.size:
        return sums, None
    # Sums reach here in any order of the blocks: gains that differ by rounding only count as equal.
    top = gain.max()
    if not top > 1e-9 * max(1.0, float(worth(total)[0, 0])):
        return sums, None
    at = int(np.argmax(gain >= top - 1e-9 * abs(top)))
    f, b = divmod(at, gain.shape[1])
    return sums, (float(gain[f, b]), f, b, tuple(left[:, f, b].tolist()), tuple(right[:, f, b].tolist()))


@dataclass
class Growth:
    """A tree while it grows. Splits are taken by gain, the largest first, once all that may matter are known."""

    settings: Settings
    features: np.ndarray
    split: list = field(default_factory=lambda: [None])
    sums: list = field(default_factory=lambda: [None])
    child: list = field(default_factory=lambda: [-1])  # the left one; the right one is next to it
    wanted: list = field(default_factory=lambda: [0])  # nodes whose tables are asked for

    def learn(self, found: dict[int, tuple[tuple, Split | None]]) -> None:
        for node, (sums, split) in found.items():
            self.sums[node], self.split[node] = sums, split
        self.wanted = []
        for node in self._order()[1]:
            self.child[node] = len(self.child)
            for sums in self.split[node][3:]:
                if sums[2] >= 2 * self.settings.min_rows:
                    self.wanted.append(len(self.child))
                self.child.append(-1)
                self.split.append(None)
                self.sums.append(sums)

    def _order(self) -> tuple[list[int], list[int]]:
        """Splits in the order they are taken, and those of them whose children are not there yet."""
        heap = [(-self.split[0][0], 0)] if self.split[0] else []
        taken, new = [], []
        while heap and len(taken) < self.settings.leaves - 1:
            _, node = heapq.heappop(heap)
            taken.append(node)
            if self.child[node] < 0:
                new.append(node)
                continue
            for child in (self.child[node], self.child[node] + 1):
                if self.split[child]:
                    heapq.heappush(heap, (-self.split[child][0], child))
        return taken, new

    def tree(self, final: bool = True) -> Tree:
        """The finished tree; or, to sort rows into nodes meanwhile, all nodes under their own numbers."""
        taken = set(self._order()[0])
        if final:
            kept, queue = [], [0]
            while queue:
                node = queue.pop(0)
                kept.append(node)
                if node in taken:
                    queue += [self.child[node], self.child[node] + 1]
        else:
            taken = {n for n, c in enumerate(self.child) if c >= 0}
            kept = list(range(len(self.child)))
        place = {node: i for i, node in enumerate(kept)}
        s, inner = self.settings, [n in taken for n in kept]
        sums = np.array([self.sums[n] or (0.0, 0.0, 0.0) for n in kept])
        value = -shrunk(sums[:, 0], s.l1) / np.maximum(sums[:, 1] + s.l2, 1e-300) * s.learning_rate
        return Tree(
            np.array([self.features[self.split[n][1]] if i else 0 for n, i in zip(kept, inner, strict=True)], np.int32),
            np.array([self.split[n][2] if i else -1 for n, i in zip(kept, inner, strict=True)], np.int32),
            np.array([place[self.child[n]] if i else -1 for n, i in zip(kept, inner, strict=True)], np.int32),
            np.array([place[self.child[n] + 1] if i else -1 for n, i in zip(kept, inner, strict=True)], np.int32),
            np.where(inner, 0.0, value),
            np.array([self.split[n][0] if i else 0.0 for n, i in zip(kept, inner, strict=True)]),
            sums[:, 2],
        )


def partial_tables(block: Block, spec: Spec, settings: Settings, number: int, growth: Growth, score: np.ndarray) -> np.ndarray:
    """What a block adds to the tables that the growing tree asks for."""
    rows = np.flatnonzero(block.parts(spec)[0] & sampled(settings, number, block.key))
    g, h = gradients(settings, spec, block.targets[spec.target, rows], score[rows])
    node = growth.tree(final=False).leaves_of(block.bins[:, rows]) if growth.child[0] >= 0 else np.zeros(len(rows), np.int32)
    slot_of = np.full(len(growth.child), -1)
    slot_of[growth.wanted] = np.arange(len(growth.wanted))
    return tables(block.bins[growth.features][:, rows], slot_of[node], len(growth.wanted), g, h, settings.bins)


@dataclass
class Fitted:
    """Trees of a model, and the mean error on its left-out fold after each (empty without one)."""

    spec: Spec
    trees: list[Tree] = field(default_factory=list)
    curve: list[float] = field(default_factory=list)

    def add(self, tree: Tree, wrong: float, rows: int, settings: Settings) -> bool:
        """Whether the model goes on after this tree."""
        self.trees.append(tree)
        if rows:
            self.curve.append(wrong / rows)
        if self.spec.early and self.curve:
            best = int(np.argmin(self.curve))
            if len(self.curve) - 1 - best >= settings.patience or len(self.trees) == settings.trees:
                del self.trees[best + 1 :]
                return False
        return len(self.trees) < settings.trees


def fit_in_task(block: Block, spec: Spec, settings: Settings) -> Fitted:
    """A model from blocks that are all here."""
    out, score = Fitted(spec), np.full(len(block.key), spec.start)
    held = block.parts(spec)[1]
    y = block.targets[spec.target]
    going = settings.trees > 0
    while going:
        number = len(out.trees)
        growth = Growth(settings, features_of(settings, number, len(block.bins)))
        while growth.wanted:
            found = partial_tables(block, spec, settings, number, growth, score)
            growth.learn({node: best_split(t, settings) for node, t in zip(growth.wanted, found, strict=True)})
        tree = growth.tree()
        score += tree.value[tree.leaves_of(block.bins)]
        going = out.add(tree, error(settings, y[held], score[held]), int(held.sum()), settings)
    return out


# --- Over Spark ---


def cut_points(frame: DataFrame, inputs: list[str], bins: int) -> list[np.ndarray]:
    """Ascending cuts per input, fewer than ``bins``: quantiles from one pass over all inputs."""
    shares = [i / bins for i in range(1, bins)]
    row = frame.agg(*[F.percentile_approx(c, shares, SKETCH).alias(f"c{i}") for i, c in enumerate(inputs)]).first()
    return [np.unique(np.array(row[i] or [], float)) for i in range(len(inputs))]


BLOCKS = "n int, bins binary, targets binary, folds binary, key binary"


def block_table(frame: DataFrame, inputs: list[str], cuts: list[np.ndarray], targets: list[str], folds: list[str], key: str) -> DataFrame:
    """The rows as stored blocks. Inputs have no nulls; a target may be null; a fold is a number or null."""
    ensure_checkpoint_dir(frame.sparkSession)
    picked = frame.select(
        *inputs, *(F.coalesce(F.col(t).cast("double"), F.lit(float("nan"))).alias(f"__t{i}") for i, t in enumerate(targets)),
        *(F.coalesce(F.col(f).cast("int"), F.lit(-2)).alias(f"__f{i}") for i, f in enumerate(folds)),
        F.xxhash64(key).alias("__key"),
    )
    kind = pa.schema([("n", pa.int32()), *((c, pa.binary()) for c in ("bins", "targets", "folds", "key"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                columns = [c.to_numpy(zero_copy_only=False) for c in part.columns]
                n = len(inputs)
                binned = np.stack([np.searchsorted(c, x, side="left") for c, x in zip(cuts, columns, strict=False)])
                row = {
                    "n": part.num_rows,
                    "bins": binned.astype(np.uint8).tobytes(),
                    "targets": np.stack(columns[n : n + len(targets)]).tobytes(),
                    "folds": np.stack([*columns[n + len(targets) : -1], np.full(part.num_rows, -2)]).astype(np.int16).tobytes(),
                    "key": columns[-1].astype(np.int64).tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row], schema=kind)

    return picked.mapInArrow(run, BLOCKS).checkpoint()


def block_of(row: dict) -> Block:
    def shaped(name: str, kind: type) -> np.ndarray:
        return np.frombuffer(row[name], kind).reshape(-1, row["n"])

    return Block(shaped("bins", np.uint8), shaped("targets", np.float64), shaped("folds", np.int16), shaped("key", np.uint64)[0])


FITTED = "name string, sizes array<int>, feature array<int>, cut array<int>, left array<int>, right array<int>, value array<double>, gain array<double>, cover array<double>, curve array<double>"
ARRAYS = ("feature", "cut", "left", "right", "value", "gain", "cover")


def fit_gathered(blocks: DataFrame, specs: list[Spec], settings: Settings) -> dict[str, Fitted]:
    """A task for each model; every task holds all blocks, which are small here."""
    spark = blocks.sparkSession
    held = spark.sparkContext.broadcast([r.asDict() for r in blocks.collect()])  # at most GATHERED_BYTES
    by_name = {s.name: s for s in specs}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = None
        for batch in batches:
            for name in batch.column(0).to_pylist():
                block = block or joined([block_of(r) for r in held.value])
                done = fit_in_task(block, by_name[name], settings)
                row = {"name": name, "sizes": [len(t.left) for t in done.trees], "curve": done.curve}
                row |= {a: np.concatenate([getattr(t, a) for t in done.trees] or [np.zeros(0)]).tolist() for a in ARRAYS}
                columns = {"name": pa.string(), "sizes": pa.list_(pa.int32()), "curve": pa.list_(pa.float64())}
                columns |= {a: pa.list_(pa.int32() if a in ARRAYS[:4] else pa.float64()) for a in ARRAYS}
                yield pa.RecordBatch.from_pydict({n: pa.array([row[n]], columns[n]) for n in FITTED_NAMES})

    listed = spark.createDataFrame([(s.name,) for s in specs], "name string").repartition(len(specs))
    out = {}
    for row in listed.mapInArrow(run, FITTED).collect():  # trees: their number and size are bounded by the settings
        ends = np.cumsum([0, *row["sizes"]])
        kinds = {a: np.array(row[a], np.int32 if a in ARRAYS[:4] else float) for a in ARRAYS}
        trees = [Tree(*(kinds[a][i:j] for a in ARRAYS)) for i, j in zip(ends, ends[1:], strict=False)]
        out[row["name"]] = Fitted(by_name[row["name"]], trees, list(row["curve"]))
    held.destroy()
    return out


FITTED_NAMES = [f.split()[0] for f in FITTED.split(", ")]


def fit_spread(blocks: DataFrame, specs: list[Spec], settings: Settings, inputs: int) -> dict[str, Fitted]:
    """All models, a job for each round of all their trees; rows' scores stay with the blocks."""
    out = {s.name: Fitted(s) for s in specs}
    going = list(specs) if settings.trees else []
    tasks = blocks.rdd.getNumPartitions()

    def opened(row: dict) -> tuple[dict, dict[str, np.ndarray]]:
        stored = row.asDict()
        return stored, {s.name: np.full(stored["n"], s.start) for s in specs}

    state = blocks.rdd.map(opened).persist(StorageLevel.MEMORY_AND_DISK)
    number = 0
    while going:
        features = features_of(settings, number, inputs)
        grown = {s.name: Growth(settings, features) for s in going}
        while asked := [(s, grown[s.name]) for s in going if grown[s.name].wanted]:
            for name, found in _round(state, asked, settings, number, tasks).items():
                grown[name].learn(found)
        trees = {s.name: grown[s.name].tree() for s in going}
        older, state = state, state.map(_raised(trees, {s.name: s for s in going}, settings))
        state = state.persist(StorageLevel.MEMORY_AND_DISK)
        if number % CHECKPOINT_TREES == CHECKPOINT_TREES - 1:
            state.checkpoint()
        wrong = {s.name: [0.0, 0] for s in going}
        for part in state.map(lambda s: {n: s[1][n, "error"] for n in trees}).reduce(_added).items():
            wrong[part[0]] = part[1]
        older.unpersist()
        going = [s for s in going if out[s.name].add(trees[s.name], *wrong[s.name], settings)]
        number += 1
    state.unpersist()
    return out


def _round(state, asked: list[tuple[Spec, Growth]], settings: Settings, number: int, tasks: int) -> dict[str, dict[int, tuple]]:
    """Best splits of all leaves that are asked for."""

    def partial(rows: Iterator) -> Iterator[tuple[tuple[str, int], np.ndarray]]:
        sums: dict[tuple[str, int], np.ndarray] = {}
        for stored, scores in rows:
            block = block_of(stored)
            for spec, growth in asked:
                for node, t in zip(growth.wanted, partial_tables(block, spec, settings, number, growth, scores[spec.name]), strict=True):
                    at = spec.name, node
                    sums[at] = sums[at] + t if at in sums else t
        yield from sums.items()

    found: dict[str, dict[int, tuple]] = {s.name: {} for s, _ in asked}
    added = state.mapPartitions(partial).reduceByKey(lambda a, b: a + b, tasks)
    for (name, node), split in added.mapValues(lambda t: best_split(t, settings)).collect():
        found[name][node] = split
    none = (0.0, 0.0, 0.0), None
    return {s.name: {node: found[s.name].get(node, none) for node in g.wanted} for s, g in asked}


def _raised(trees: dict[str, Tree], specs: dict[str, Spec], settings: Settings) -> Callable:
    """Adds the new trees to the scores of a block, and takes the error on each left-out fold."""

    def raise_(part: tuple) -> tuple:
        stored, scores = part
        block, new = block_of(stored), {k: v for k, v in scores.items() if isinstance(k, str)}
        for name, tree in trees.items():
            new[name] = new[name] + tree.value[tree.leaves_of(block.bins)]
            held = block.parts(specs[name])[1]
            new[name, "error"] = [error(settings, block.targets[specs[name].target, held], new[name][held]), int(held.sum())]
        return stored, new

    return raise_


def _added(a: dict, b: dict) -> dict:
    return {n: [a[n][0] + b[n][0], a[n][1] + b[n][1]] for n in a}


def started(blocks: DataFrame, specs: list[Spec], settings: Settings, deltas: list[float] | None = None) -> list[Spec]:
    """The models with their first score, class weights and Huber threshold, from the rows each one sees."""
    kind = pa.schema([("name", pa.string()), ("n", pa.int64()), ("total", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = block_of(row)
                seen = [block.targets[s.target, block.parts(s)[0]] for s in specs]
                yield pa.RecordBatch.from_pydict({"name": [s.name for s in specs], "n": [len(y) for y in seen], "total": [float(y.sum()) for y in seen]}, schema=kind)

    sums = blocks.mapInArrow(run, "name string, n long, total double").groupBy("name").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))
    seen = {r["name"]: (r["n"], r["total"]) for r in sums.collect()}  # a row for each model
    out = []
    for s in specs:
        n, total = seen.get(s.name, (0, 0.0))
        changes: dict = {"start": total / n if n else 0.0}
        if settings.loss == "logistic":
            changes = {"start": 0.0}  # balanced weights make both classes equally heavy
            if 0 < total < n:
                changes["weights"] = (n / (2 * (n - total)), n / (2 * total))
            else:
                changes["start"] = 10.0 if total else -10.0  # one class only
        elif settings.loss == "huber" and deltas:
            changes["delta"] = deltas[s.target] or math.inf
        out.append(Spec(**{**s.__dict__, **changes}))
    return out


def fit(
    frame: DataFrame, inputs: list[str], targets: list[str], folds: list[str], key: str, specs: list[Spec],
    settings: Settings, deltas: list[float] | None = None, gathered_bytes: int = GATHERED_BYTES,
) -> dict[str, tuple[Forest, list[float]]]:
    """Every model's forest and its error curve. ``deltas``: the Huber threshold of each target."""
    cuts = cut_points(frame, inputs, settings.bins)
    blocks = block_table(frame, inputs, cuts, targets, folds, key)
    size = blocks.agg(F.sum(F.octet_length("bins") + F.octet_length("targets") + F.octet_length("folds") + F.octet_length("key"))).first()[0]
    if not size:
        raise ValueError("no rows to learn from")
    specs = started(blocks, specs, settings, deltas)
    done = fit_gathered(blocks, specs, settings) if size <= gathered_bytes else fit_spread(blocks, specs, settings, len(inputs))
    return {n: (Forest.of(f, inputs, cuts, settings.loss), f.curve) for n, f in done.items()}


# --- Fitted models ---

NODES = "tree int, node int, feature int, threshold double, left int, right int, value double, gain double, cover double"


@dataclass
class Forest:
    """A fitted model: trees that compare input values, in flat arrays; ``offset`` is each tree's first place."""

    inputs: list[str]
    start: float
    loss: str
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    cover: np.ndarray
    offset: np.ndarray

    @staticmethod
    def of(fitted: Fitted, inputs: list[str], cuts: list[np.ndarray], loss: str) -> Forest:
        flat = {a: np.concatenate([getattr(t, a) for t in fitted.trees] or [np.zeros(0, np.int32)]) for a in ARRAYS}
        threshold = np.array([cuts[f][c] if c >= 0 else 0.0 for f, c in zip(flat["feature"], flat["cut"], strict=True)], float)
        offset = np.cumsum([0, *(len(t.left) for t in fitted.trees)])
        rest = (flat[a] for a in ("left", "right", "value", "gain", "cover"))
        return Forest(list(inputs), fitted.spec.start, loss, flat["feature"], threshold, *rest, offset)

    @property
    def trees(self) -> int:
        return len(self.offset) - 1

    def tree(self, i: int) -> tuple[Tree, np.ndarray]:
        """A tree and the thresholds of its nodes."""
        at = slice(self.offset[i], self.offset[i + 1])
        rest = (self.left[at], self.right[at], self.value[at], self.gain[at], self.cover[at])
        return Tree(self.feature[at], np.zeros(0, np.int32), *rest), self.threshold[at]

    def margin(self, table: np.ndarray) -> np.ndarray:
        """Scores of the columns of ``table`` (inputs x rows), all trees walked for all rows at once."""
        out = np.full(table.shape[1], self.start)
        for i in range(self.trees):
            tree, cuts = self.tree(i)
            out += tree.value[tree.leaves_of(table, cuts)]
        return out

    def predict(self, table: np.ndarray) -> np.ndarray:
        score = self.margin(table)
        return 1 / (1 + np.exp(-np.clip(score, -500, 500))) if self.loss == "logistic" else score

    def importance(self) -> list[tuple[str, float]]:
        """(input, share of the total gain), largest first."""
        inner = self.left >= 0
        gains = np.bincount(self.feature[inner], self.gain[inner], len(self.inputs))
        total = gains.sum() or 1.0
        return sorted(((n, float(g / total)) for n, g in zip(self.inputs, gains, strict=True)), key=lambda p: (-p[1], p[0]))

    def transform(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        return add_scores(df, {out: self})

    def nodes(self) -> list[tuple]:
        tree = np.repeat(np.arange(self.trees), np.diff(self.offset))
        columns = (tree, np.arange(len(tree)) - self.offset[tree], self.feature, self.threshold, self.left, self.right, self.value, self.gain, self.cover)
        return list(zip(*(c.tolist() for c in columns), strict=True))

    def save(self, spark: SparkSession, path: str) -> None:
        """The nodes as a table, and one row with inputs, first score and loss."""
        spark.createDataFrame(self.nodes(), NODES).coalesce(1).write.mode("overwrite").parquet(f"{path}/nodes")
        head = spark.createDataFrame([(self.inputs, self.start, self.loss, self.trees)], "inputs array<string>, start double, loss string, trees int")
        head.coalesce(1).write.mode("overwrite").parquet(f"{path}/head")

    @staticmethod
    def load(spark: SparkSession, path: str) -> Forest:
        head = spark.read.parquet(f"{path}/head").first()
        rows = spark.read.parquet(f"{path}/nodes").orderBy("tree", "node").collect()  # bounded by the settings
        column = {n: np.array([r[n] for r in rows]) for n in ("tree", "feature", "threshold", "left", "right", "value", "gain", "cover")}
        offset = np.concatenate([[0], np.cumsum(np.bincount(column["tree"].astype(int), minlength=head["trees"]))])
        whole = {n: column[n].astype(np.int32) for n in ("feature", "left", "right")}
        real = {n: column[n].astype(float) for n in ("threshold", "value", "gain", "cover")}
        return Forest(list(head["inputs"]), head["start"], head["loss"], offset=offset.astype(int), **whole, **real)


def matrix(batch: pa.RecordBatch, inputs: list[str]) -> np.ndarray:
    """Inputs x rows; a null counts as 0, as in training."""
    columns = (batch.column(batch.schema.get_field_index(c)).cast(pa.float64()).fill_null(0).to_numpy(zero_copy_only=False) for c in inputs)
    return np.stack(list(columns)) if inputs else np.zeros((0, batch.num_rows))


def add_scores(df: DataFrame, forests: dict[str, Forest]) -> DataFrame:
    """``df`` with a prediction column per forest, in one narrow pass. The trees are broadcast: their size is
    bounded by the settings and the number of models."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = df.sparkSession.sparkContext.broadcast(forests)
    schema = StructType([*(f for f in df.schema.fields if f.name not in forests), *(StructField(n, DoubleType()) for n in forests)])
    kind = to_arrow_schema(schema)
    kept = [f.name for f in df.schema.fields if f.name not in forests]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pa.array(f.predict(matrix(batch, f.inputs)), pa.float64()) for f in shared.value.values()]
            columns = [*(batch.column(c) for c in kept), *found]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, kind, strict=True)], schema=kind)

    return df.mapInArrow(run, schema)


def add_fold_scores(df: DataFrame, parts: dict[str, tuple[str, list[Forest]]]) -> DataFrame:
    """A prediction column for each name: (fold column, a forest per fold). A row is scored by its own fold's forest."""
    from pyspark.sql.pandas.types import to_arrow_schema

    shared = df.sparkSession.sparkContext.broadcast(parts)
    schema = StructType([*df.schema.fields, *(StructField(n, DoubleType()) for n in parts)])
    kind = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            for fold_column, forests in shared.value.values():
                fold = batch.column(batch.schema.get_field_index(fold_column)).to_numpy(zero_copy_only=False)
                out = np.full(batch.num_rows, np.nan)
                for k, forest in enumerate(forests):
                    here = np.flatnonzero(fold == k)
                    if len(here):
                        out[here] = forest.predict(matrix(batch, forest.inputs)[:, here])
                columns.append(pa.array(out, pa.float64()))
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if c.type != f.type else c for c, f in zip(columns, kind, strict=True)], schema=kind)

    return df.mapInArrow(run, schema)
