"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Equal vectors are indexed once; of each, the least ids that any answer can need are kept, found by a ranking
that Spark limits in each task before the shuffle. Distinct vectors are dealt to shards of about ``SHARD_ROWS`` by a
hash. Each shard's graph is built in one task and stored as flat neighbour arrays, a row a shard. A shard travels
once for every ``GROUP_BLOCKS`` blocks of ``QUERY_BLOCK`` queries: the blocks follow it in the same task, which holds one
shard and one block at a time; the shards' results are merged by exact scores. Inside a shard all points of a batch, or all queries of a block, walk the graph
side by side in numpy.

Scores are cosines in double precision on the original vectors. Ties go to the smaller id.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components takes no part;
vectors are compared with those of the same length only; rows that repeat an id with the same vector are one,
with different vectors the id has its best; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DoubleType, IntegerType, LongType, StructField, StructType

from migrascope.llm.common import arrow_type, written

SHARD_ROWS = 4096
QUERY_BLOCK = 512
GROUP_BLOCKS = 64  # blocks that meet a shard one after another in a task
DEGREE = 16  # links of a point on the upper levels; twice as many on the lowest
BUILD_WIDTH = 64
SEARCH_WIDTH = 96
BATCH = 256

SHARD = StructType(
    [
        StructField("dim", IntegerType()),
        StructField("shard", IntegerType()),
        StructField("rows", IntegerType()),
        StructField("vectors", BinaryType()),
        StructField("ids", ArrayType(ArrayType(LongType()))),
        StructField("neighbours", ArrayType(BinaryType())),
        StructField("entry", IntegerType()),
    ]
)
BLOCK = StructType(
    [
        StructField("dim", IntegerType()),
        StructField("block", LongType()),
        StructField("query_ids", ArrayType(LongType())),
        StructField("queries", BinaryType()),
    ]
)
HITS = StructType(
    [StructField("query_id", LongType()), StructField("vec_id", LongType()), StructField("score", DoubleType())]
)


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(vec_id, v, dim) of the vectors that take part."""
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(math.inf)))
    rows = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    return (
        rows.filter("vec_id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
        .filter(~F.coalesce(bad, F.lit(True)))
        .filter(F.exists("v", lambda x: x != 0))
        .withColumn("dim", F.size("v"))
    )


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(dim, h, v, ids): each vector with its ``k + 1`` least ids; ``k`` of them answer any query but its own."""
    same = Window.partitionBy("dim", "h", "v").orderBy("vec_id")
    keyed = rows.withColumn("h", F.xxhash64("v")).dropDuplicates(["dim", "h", "v", "vec_id"])
    ranked = keyed.withColumn("rank", F.row_number().over(same)).filter(F.col("rank") <= k + 1)
    return ranked.groupBy("dim", "h", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


class Graph:
    """Levels of flat neighbour arrays over unit vectors; -1 stands for no neighbour."""

    def __init__(self, unit: np.ndarray, levels: list[np.ndarray], entry: int) -> None:
        self.unit, self.levels, self.entry = unit, levels, entry

    def search(self, queries: np.ndarray, width: int, level: int, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best ``width`` points of each query on one level, nearest first; -1 pads.

        ``entries`` holds start points (queries x any number). All queries expand their nearest open point
        at the same time, until no query has an open point among its best.
        """
        links, n = self.levels[level], len(self.unit)
        m = len(queries)
        seen = np.zeros((m, n + 1), dtype=bool)
        best = np.full((m, width), -1, dtype=np.int32)
        score = np.full((m, width), -np.inf, dtype=np.float32)
        done = np.ones((m, width), dtype=bool)
        entries = entries[:, :width]
        count = entries.shape[1]
        best[:, :count] = entries
        score[:, :count] = np.where(entries >= 0, np.einsum("md,mcd->mc", queries, self.unit[entries]), -np.inf)
        done[:, :count] = entries < 0
        np.put_along_axis(seen, np.where(entries >= 0, entries, n), True, axis=1)
        live = np.arange(m)
        while len(live):
            open_score = np.where(done[live], -np.inf, score[live])
            pick = open_score.argmax(axis=1)
            some = open_score[np.arange(len(live)), pick] > -np.inf
            live, pick = live[some], pick[some]
            if not len(live):
                break
            done[live, pick] = True
            near = links[best[live, pick]]
            fresh = (near >= 0) & ~seen[live[:, None], near]
            seen[live[:, None], np.where(near >= 0, near, n)] = True
            got = np.einsum("md,mcd->mc", queries[live], self.unit[near])
            got = np.where(fresh, got, -np.inf)
            all_score = np.concatenate([score[live], got], axis=1)
            all_best = np.concatenate([best[live], near], axis=1)
            all_done = np.concatenate([done[live], ~fresh], axis=1)
            top = np.argpartition(-all_score, width - 1, axis=1)[:, :width]
            score[live] = np.take_along_axis(all_score, top, axis=1)
            best[live] = np.take_along_axis(all_best, top, axis=1)
            done[live] = np.take_along_axis(all_done, top, axis=1)
        order = np.argsort(-score, axis=1, kind="stable")
        score = np.take_along_axis(score, order, axis=1)
        return np.where(score > -np.inf, np.take_along_axis(best, order, axis=1), -1), score

    def descend(self, queries: np.ndarray, to: int) -> np.ndarray:
        """Start points on level ``to``: the greedy walk over the levels above."""
        entries = np.full((len(queries), 1), self.entry)
        for level in range(len(self.levels) - 1, to, -1):
            entries = self.search(queries, 4, level, entries)[0][:, :1]
        return entries


def diverse(unit: np.ndarray, owners: np.ndarray, found: np.ndarray, degree: int) -> np.ndarray:
    """Of each row's candidates (nearest first), those nearer to the owner than to any chosen one, then the rest."""
    m, width = found.shape
    chosen = np.full((m, degree), -1, dtype=np.int32)
    count = np.zeros(m, dtype=np.int64)
    own = np.einsum("md,mcd->mc", unit[owners], unit[found])
    covered = np.full((m, width), -np.inf, dtype=np.float32)
    valid = (found >= 0) & (found != owners[:, None])
    taken = np.zeros((m, width), dtype=bool)
    for c in range(width):
        fine = valid[:, c] & (own[:, c] > covered[:, c]) & (count < degree)
        rows = np.flatnonzero(fine)
        if not len(rows):
            continue
        chosen[rows, count[rows]] = found[rows, c]
        count[rows] += 1
        taken[rows, c] = True
        between = np.einsum("md,mcd->mc", unit[found[rows, c]], unit[found[rows]])
        covered[rows] = np.maximum(covered[rows], between)
    for c in range(width):  # room that is left goes to the nearest others
        rows = np.flatnonzero(valid[:, c] & ~taken[:, c] & (count < degree))
        chosen[rows, count[rows]] = found[rows, c]
        count[rows] += 1
    return chosen


def build(unit: np.ndarray, seed: int = 1) -> Graph:
    """Inserts the points level by level in batches; the first points are linked with all before them."""
    n = len(unit)
    rng = np.random.default_rng(seed)
    height = np.minimum((-np.log(1 - rng.random(n)) / math.log(DEGREE)).astype(np.int64), 8)
    order = np.argsort(-height, kind="stable")  # higher points come first and make the entry
    unit = unit[order]
    height = height[order]
    levels = [np.full((n, 2 * DEGREE if lv == 0 else DEGREE), -1, dtype=np.int32) for lv in range(int(height[0]) + 1)]
    graph = Graph(unit, levels, 0)
    at = 1
    while at < n:
        to = min(n, at + min(BATCH, max(1, at // 2)))
        batch = np.arange(at, to)
        queries = unit[batch]
        for level in range(len(levels)):
            members = batch[height[batch] >= level]
            if not len(members):
                continue
            own = queries[members - at]
            starts = graph.descend(own, level)
            found, _ = graph.search(own, BUILD_WIDTH, level, starts)
            within = own @ own.T
            np.fill_diagonal(within, -np.inf)
            near = min(DEGREE, len(members))
            beside = np.argpartition(-within, near - 1, axis=1)[:, :near]
            both = np.concatenate([found, members[beside].astype(np.int32)], axis=1)
            scores = np.where(both >= 0, np.einsum("md,mcd->mc", own, unit[both]), -np.inf)
            both = np.take_along_axis(both, np.argsort(-scores, axis=1, kind="stable"), axis=1)
            links = diverse(unit, members, both, DEGREE)
            levels[level][members, :DEGREE] = links
            _link_back(unit, levels[level], members, links)
        at = to
    place = np.argsort(order)  # back to the order of the caller
    renamed = [np.where(links >= 0, order[links], -1).astype(np.int32)[place] for links in levels]
    return Graph(unit[place], renamed, int(order[0]))


def _link_back(unit: np.ndarray, links: np.ndarray, members: np.ndarray, chosen: np.ndarray) -> None:
    """Adds the reverse links; a full list keeps its most diverse neighbours."""
    target = chosen.ravel()
    source = np.repeat(members, chosen.shape[1])[target >= 0]
    target = target[target >= 0]
    order = np.argsort(target, kind="stable")
    target, source = target[order], source[order]
    points, first, counts = np.unique(target, return_index=True, return_counts=True)
    most = int(counts.max(initial=0))
    added = np.full((len(points), most), -1, dtype=np.int32)
    column = np.arange(len(target)) - np.repeat(first, counts)
    added[np.repeat(np.arange(len(points)), counts), column] = source
    both = np.concatenate([links[points], added], axis=1)
    both = np.sort(both, axis=1)[:, ::-1]
    both[:, 1:][both[:, 1:] == both[:, :-1]] = -1
    scores = np.where(both >= 0, np.einsum("md,mcd->mc", unit[points], unit[both]), -np.inf)
    both = np.take_along_axis(both, np.argsort(-scores, axis=1, kind="stable"), axis=1)
    links[points] = diverse(unit, points, both, links.shape[1])


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each vector times a power of two, so that nothing overflows; exact, and no matter to a cosine."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(axis=1, keepdims=True))[1])


def normalised(vectors: np.ndarray) -> np.ndarray:
    vectors = scaled(vectors)
    return (vectors / np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))).astype(np.float32)


def index(vectors: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Shards of ``distinct_vectors`` rows, each with its graph, as stored rows."""
    sizes = vectors.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).cast("int").alias("shards"))
    total = sizes.agg(F.sum("shards")).first()[0] or 1
    dealt = vectors.join(F.broadcast(sizes), "dim").withColumn("shard", F.pmod("h", F.col("shards")).cast("int"))
    dealt = dealt.repartition(int(total), "dim", "shard")  # a given number: building is worth a task a shard
    kind = arrow_type(SHARD)

    def make(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pa.Table.from_batches(list(batches))
        order = np.argsort(np.array(tables.column("h").to_pylist()), kind="stable")
        tables = tables.take(pa.array(order))
        dim = key[0].as_py()
        values = tables.column("v").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        graph = build(normalised(values))
        row = (
            dim,
            key[1].as_py(),
            len(values),
            values.tobytes(),
            tables.column("ids").to_pylist(),
            [links.tobytes() for links in graph.levels],
            graph.entry,
        )
        yield pa.RecordBatch.from_pylist([dict(zip(SHARD.names, row, strict=True))], schema=kind)

    return dealt.select("dim", "shard", "h", "v", "ids").groupBy("dim", "shard").applyInArrow(make, SHARD)


def query_blocks(queries: DataFrame, size: int = QUERY_BLOCK) -> DataFrame:
    """Queries (vec_id, v, dim) in rows of up to about ``size``."""
    sizes = queries.groupBy("dim").agg(F.ceil(F.count("*") / size).cast("long").alias("blocks"))
    dealt = queries.join(F.broadcast(sizes), "dim").withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.col("blocks")))
    kind = arrow_type(BLOCK)

    def pack(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = pa.Table.from_batches(list(batches))
        values = tables.column("v").combine_chunks().flatten().to_numpy()
        row = (key[0].as_py(), key[1].as_py(), tables.column("vec_id").to_pylist(), values.tobytes())
        yield pa.RecordBatch.from_pylist([dict(zip(BLOCK.names, row, strict=True))], schema=kind)

    return dealt.select("dim", "block", "vec_id", "v").groupBy("dim", "block").applyInArrow(pack, BLOCK)


def search(shards: DataFrame, blocks: DataFrame, k: int, width: int = SEARCH_WIDTH) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of all shards for each query."""
    kind = arrow_type(HITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard: _Shard | None = None
        for batch in batches:
            for row in batch.to_pylist():
                at = row["dim"], row["shard"], row["group"]
                if row["vectors"] is not None:
                    shard = _Shard(at, row)
                elif shard is not None and shard.at == at:
                    yield shard.answers(row, k, width, kind)

    # How many shards and groups of blocks there are, a row for each length of vectors.
    counted = shards.groupBy("dim").agg((F.max("shard") + 1).alias("n_shards"))
    grouped = blocks.groupBy("dim").agg((F.max("block") + 1).alias("n_blocks"))
    last = F.floor((F.col("n_blocks") - 1) / GROUP_BLOCKS)
    counts = counted.join(grouped, "dim").withColumn("last", last)
    sizes = F.broadcast(counts)
    tasks = counts.agg(F.sum(F.col("n_shards") * (F.col("last") + 1))).first()[0] or 1
    groups = F.explode(F.sequence(F.lit(0).cast("long"), F.col("last")))
    left = shards.join(sizes, "dim").select(*SHARD.names, groups.alias("group"), F.lit(-1).cast("long").alias("block"))
    own = F.floor(F.col("block") / GROUP_BLOCKS).alias("group")
    right = blocks.join(sizes, "dim").select(*BLOCK.names, F.explode(F.sequence(F.lit(0), F.col("n_shards") - 1)).alias("shard"), own)
    both = left.unionByName(right, allowMissingColumns=True)
    met = both.repartition(int(tasks), "dim", "shard", "group")  # a given number: a shard's walk is worth a task
    met = met.sortWithinPartitions("dim", "shard", "group", "block")
    hits = met.mapInArrow(run, HITS).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


class _Shard:
    """A shard that answers blocks of queries."""

    def __init__(self, at: tuple, row: dict) -> None:
        vectors = np.frombuffer(row["vectors"], np.float64).reshape(-1, row["dim"])
        levels = [np.frombuffer(b, np.int32).reshape(len(vectors), -1) for b in row["neighbours"]]
        self.at, self.ids = at, row["ids"]
        self.graph = Graph(normalised(vectors), levels, row["entry"])
        self.vectors = scaled(vectors)
        self.length = np.sqrt((self.vectors * self.vectors).sum(axis=1))

    def answers(self, row: dict, k: int, width: int, kind: pa.Schema) -> pa.RecordBatch:
        """The shard's best for each query of the block, by exact cosine; of equal vectors the least ids."""
        queries = np.frombuffer(row["queries"], np.float64).reshape(-1, row["dim"])
        unit, queries = normalised(queries), scaled(queries)
        found, _ = self.graph.search(unit, width, 0, self.graph.descend(unit, 0))
        out: list[dict] = []
        for i, query_id in enumerate(row["query_ids"]):
            near = found[i][found[i] >= 0]
            query = queries[i]
            score = (self.vectors[near] * query).sum(axis=1) / (self.length[near] * np.sqrt((query * query).sum()))
            pairs = [(-s, v) for s, j in zip(score.tolist(), near.tolist(), strict=True) for v in self.ids[j] if v != query_id]
            out += [{"query_id": query_id, "vec_id": v, "score": -s} for s, v in sorted(pairs)[:k]]
        return pa.RecordBatch.from_pylist(out, schema=kind)


def nearest(
    vectors: DataFrame, is_query: Column, k: int, vec_id: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """Index of all vectors, searched with those that ``is_query`` (over vec_id) picks."""
    rows = usable(vectors, vec_id, vector)
    shards = written(index(written(distinct_vectors(rows, k), "vectors")), "shards")
    queries = rows.filter(is_query).dropDuplicates(["vec_id", "v"])
    return search(shards, written(query_blocks(queries), "blocks"), k)
