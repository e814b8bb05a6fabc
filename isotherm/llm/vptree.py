"""Nearest neighbours by inner product: a vantage-point tree per shard, queries in blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.llm.batches import in_order
from isotherm.sources.scratch import staged

#: Vectors of a shard (on average), of a leaf, and shards that one task searches in turn.
SHARD_ROWS = 16_384
LEAF_ROWS = 256
TASK_SHARDS = 16

#: Bytes of the queries that are broadcast at once.
QUERY_BYTES = 16 << 20

#: Found pairs that wait before they are merged into the best ones.
PAIRS_HELD = 1 << 18

#: Below any difference of two ways to sum up one inner product of unit-sized vectors.
SLACK = 1e-9

TREE = "shard int, ids binary, vectors binary, width int, nodes binary, order binary"


class Tree:
    """Vantage-point tree over vectors lifted to one length, where a larger product is nearer.

    With M the longest vector, |lift(x)| = M for all x, and the squared distance from a query q is
    |q|^2 + M^2 - 2 q.x. An inner node holds a vantage point and, for each side, the least and the
    greatest distance from it; leaves are runs of `order`.
    """

    FIELDS = np.dtype(
        [("point", "<i4"), ("left", "<i4"), ("right", "<i4"), ("begin", "<i4"), ("end", "<i4"), ("near", "<f8", 4)]
    )

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, nodes: np.ndarray | None = None, order=None):
        self.ids, self.vectors = ids, vectors
        squares = np.einsum("ij,ij->i", vectors, vectors)
        self.longest = float(squares.max())
        self.lift = np.sqrt(np.maximum(self.longest - squares, 0.0))
        if nodes is None:
            order = np.argsort(ids, kind="stable")
            rows: list[tuple] = []
            self._grow(order, 0, rows)
            nodes = np.array(rows, self.FIELDS)
        self.nodes, self.order = nodes, order

    def _from_point(self, point: int, rows: np.ndarray) -> np.ndarray:
        products = self.vectors[rows] @ self.vectors[point] + self.lift[rows] * self.lift[point]
        return np.sqrt(np.maximum(2 * self.longest - 2 * products, 0.0))

    def _grow(self, order: np.ndarray, begin: int, rows: list[tuple]) -> int:
        """Sorts the view `order` into the tree's order; returns the number of the node."""
        place = len(rows)
        rows.append(())
        n = len(order)
        if n <= LEAF_ROWS:
            rows[place] = (-1, -1, -1, begin, begin + n, (0.0, 0.0, 0.0, 0.0))
            return place
        # the farthest from the first one: a vantage point at the border splits best
        point = int(order[self._from_point(int(order[0]), order).argmax()])
        distance = self._from_point(point, order)
        by = np.argsort(distance, kind="stable")
        order[:], distance = order[by], distance[by]
        half = n // 2
        bounds = (distance[0], distance[half - 1], distance[half], distance[-1])
        left = self._grow(order[:half], begin, rows)
        right = self._grow(order[half:], begin + half, rows)
        rows[place] = (point, left, right, begin, begin + n, bounds)
        return place

    def distances(self, queries: np.ndarray, lengths: np.ndarray, point: int) -> np.ndarray:
        return np.sqrt(np.maximum(lengths + self.longest - 2 * (queries @ self.vectors[point]), 0.0))


class Best:
    """The k best (score, id) of each query so far; ties go to the smaller id."""

    def __init__(self, query_ids: np.ndarray, queries: np.ndarray, k: int):
        self.query_ids, self.queries, self.k = query_ids, queries, k
        self.lengths = np.einsum("ij,ij->i", queries, queries)
        self.scores = np.full((len(queries), k), -np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.wait: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.waiting = 0

    def add(self, rows: np.ndarray, ids: np.ndarray, vectors: np.ndarray) -> None:
        """Rows of queries against all `vectors`; what can be among the best is scored exactly."""
        rough = self.queries[rows] @ vectors.T
        close = rough >= self.scores[rows, -1][:, None] - SLACK * (1 + np.abs(rough))
        close &= self.query_ids[rows][:, None] != ids[None, :]
        if close.sum() > 4 * self.k * len(rows) and rough.shape[1] > 2 * self.k:
            rough[~close] = -np.inf
            least = np.partition(rough, -self.k, axis=1)[:, -self.k]
            least = np.where(np.isfinite(least), least - SLACK * (1 + np.abs(least)), least)
            close &= rough >= least[:, None]
        q, x = np.nonzero(close)
        if not len(q):
            return
        # one product after another in the same order for all: equal vectors have equal scores
        exact = (self.queries[rows[q]] * vectors[x]).sum(axis=1)
        self.wait.append((rows[q], ids[x], exact))
        self.waiting += len(q)
        if self.waiting > PAIRS_HELD:
            self.merge()

    def merge(self) -> None:
        if not self.wait:
            return
        rows, ids, scores = map(np.concatenate, zip(*self.wait))
        self.wait, self.waiting = [], 0
        changed = np.unique(rows)
        rows = np.concatenate([rows, np.repeat(changed, self.k)])
        ids = np.concatenate([ids, self.ids[changed].ravel()])
        scores = np.concatenate([scores, self.scores[changed].ravel()])
        order = np.lexsort((ids, -scores, rows))
        rows = rows[order]
        heads = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        take = order[(heads[:, None] + np.arange(self.k)[None, :]).ravel()]
        self.ids[changed] = ids[take].reshape(-1, self.k)
        self.scores[changed] = scores[take].reshape(-1, self.k)

    def radius(self, rows: np.ndarray, longest: float) -> np.ndarray:
        """Distance of each query's k-th best in a tree; infinite while there are fewer."""
        return np.sqrt(np.maximum(self.lengths[rows] + longest - 2 * self.scores[rows, -1], 0.0))


def search(tree: Tree, best: Best, relax: float) -> None:
    """Add the tree's vectors to the best ones of all queries.

    First each query goes down to the leaf on its own side, which gives a radius. Then the tree is
    walked once with all queries together; a query leaves where the triangle inequality puts a
    side's least possible distance, times `relax`, beyond its radius. With `relax` 1 nothing is lost.
    """
    nodes, everyone = tree.nodes, np.arange(len(best.queries))
    own: list[tuple[int, np.ndarray]] = []
    stack = [(0, everyone)]
    while stack:
        node, rows = stack.pop()
        if not len(rows):
            continue
        if nodes[node]["point"] < 0:
            own.append((node, rows))
            continue
        near = nodes[node]["near"]
        d = tree.distances(best.queries[rows], best.lengths[rows], nodes[node]["point"])
        left = d <= (near[1] + near[2]) / 2
        stack += [(nodes[node]["left"], rows[left]), (nodes[node]["right"], rows[~left])]
    seen = np.full(len(everyone), -1)
    for node, rows in own:
        _scan(tree, best, node, rows)
        seen[rows] = node
    best.merge()
    stack = [(0, everyone)]
    while stack:
        node, rows = stack.pop()
        if not len(rows):
            continue
        if nodes[node]["point"] < 0:
            rows = rows[seen[rows] != node]
            if len(rows):
                _scan(tree, best, node, rows)
            continue
        near = nodes[node]["near"]
        d = tree.distances(best.queries[rows], best.lengths[rows], nodes[node]["point"])
        radius = best.radius(rows, tree.longest) + 1e-7 * (1 + d)
        for side, low, high in (("left", near[0], near[1]), ("right", near[2], near[3])):
            least = np.maximum(np.maximum(low - d, d - high), 0.0)
            stack.append((nodes[node][side], rows[least * relax <= radius]))
    best.merge()


def _scan(tree: Tree, best: Best, node: int, rows: np.ndarray) -> None:
    at = tree.order[tree.nodes[node]["begin"] : tree.nodes[node]["end"]]
    step = max(1, PAIRS_HELD * 4 // len(at))
    for begin in range(0, len(rows), step):
        best.add(rows[begin : begin + step], tree.ids[at], tree.vectors[at])


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id and embedding of the rows that take part.

    Not: null ids, null or empty vectors, vectors with null or non-finite components, zero
    vectors, and vectors of another length than most have.
    """
    element = F.col("embedding")
    sound = vectors.select("vec_id", "embedding").where(
        F.col("vec_id").isNotNull()
        & (F.size(element) > 0)
        & ~F.exists(element, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
        & F.exists(element, lambda x: x != 0)
    )
    lengths = sound.groupBy(F.size(element).alias("width")).count()
    width = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    return sound.where(F.size(element) == (width["width"] if width else 0))


def build_trees(vectors: DataFrame, rows: int) -> DataFrame:
    """One row per shard with its vectors and tree; every vector is in the tree of its id's shard."""
    shards = max(1, -(-rows // SHARD_ROWS))

    def build(part: pa.Table) -> pa.Table:
        ids = part.column("vec_id").to_numpy()
        flat = pc.list_flatten(part.column("embedding")).to_numpy()
        given = flat.reshape(len(ids), -1)
        tree = Tree(ids, given.astype(np.float64))
        return pa.table(
            {
                "shard": pa.array([part.column("shard")[0].as_py()], pa.int32()),
                "ids": [ids.astype("<i8").tobytes()],
                "vectors": [given.tobytes()],
                "width": pa.array([given.shape[1]], pa.int32()),
                "nodes": [tree.nodes.tobytes()],
                "order": [tree.order.astype("<i8").tobytes()],
            }
        )

    dealt = vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(build, TREE)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int = 20, relax: float = 1.0
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest rows by inner product.

    `vectors` and `queries` have vec_id and embedding; a row is no neighbour of a query with its
    own id. Scores are products of the given vectors in double precision; ties go to the smaller
    id. Fewer candidates than k: all of them. Unusable rows (see `usable`) take no part; repeated
    rows count each; other columns are not read; empty tables give an empty result.

    Vectors are hashed into shards of bounded size, each stored with its tree. Queries come in
    blocks of QUERY_BYTES, broadcast one after another; a task searches several shards with one list
    of best ones for each query, so later shards are pruned by earlier ones, and sends only the
    k best of each query. `relax` above 1 prunes more than the triangle inequality allows.
    """
    spark = vectors.sparkSession
    vectors = usable(vectors)
    element = vectors.schema["embedding"].dataType.elementType
    dtype = np.float32 if element.simpleString() == "float" else np.float64
    rows = vectors.count()
    schema = "query_id bigint, vec_id bigint, score double"
    if not rows:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    trees = staged(build_trees(vectors, rows), "trees")
    width = trees.select("width").first()["width"]
    tasks = max(1, -(-rows // (SHARD_ROWS * TASK_SHARDS)), min(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // (4 * SHARD_ROWS)))
    trees = trees.repartition(tasks) if tasks > 1 else trees.coalesce(1)
    asked = usable(queries).where(F.size("embedding") == width).withColumn("one", F.lit(1).cast("bigint"))
    size = max(1, QUERY_BYTES // (8 * width))
    placed = staged(
        in_order(asked, ["vec_id"], ["one"]).withColumn("block", F.floor(F.col("one_before") / size)), "queries"
    )
    blocks = placed.agg(F.max("block")).first()[0]

    def searched(number: int) -> DataFrame:
        # at most `size` queries
        found = placed.where(F.col("block") == number).select("vec_id", "embedding").toArrow()
        flat = pc.list_flatten(found.column("embedding")).to_numpy().reshape(-1, width)
        block = spark.sparkContext.broadcast((found.column("vec_id").to_numpy(), flat))

        def run(batches):
            query_ids, given = block.value
            best = Best(query_ids, given.astype(np.float64), k)
            for batch in batches:
                for row in range(batch.num_rows):
                    r = batch.slice(row, 1).to_pylist()[0]
                    tree = Tree(
                        np.frombuffer(r["ids"], "<i8"),
                        np.frombuffer(r["vectors"], dtype).reshape(-1, r["width"]).astype(np.float64),
                        np.frombuffer(r["nodes"], Tree.FIELDS),
                        np.frombuffer(r["order"], "<i8"),
                    )
                    search(tree, best, relax)
            some = np.isfinite(best.scores)
            yield pa.RecordBatch.from_pydict(
                {
                    "query_id": pa.array(np.repeat(query_ids, some.sum(axis=1))),
                    "vec_id": pa.array(best.ids[some]),
                    "score": pa.array(best.scores[some]),
                }
            )

        return trees.mapInArrow(run, schema)

    if blocks is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    found = searched(0)
    for number in range(1, blocks + 1):
        found = found.unionByName(searched(number))
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
