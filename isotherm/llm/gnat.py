"""Hard negatives by integer inner product: multiway hyperplane trees with ranges between siblings."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from isotherm.sources.scratch import staged

#: Vectors of a shard (on average) and of a leaf, split points of a node, shards that one task searches in turn.
SHARD_ROWS = 8_192
LEAF_ROWS = 256
FAN = 12
TASK_SHARDS = 16

#: Bytes of the anchors that one task searches for.
BLOCK_BYTES = 8 << 20

#: Scores that a step holds at once.
STEP_SCORES = 1 << 20

#: Components from here on would give products that a double does not hold exactly.
LARGEST = float(1 << 12)

#: Part of the longest vector by which computed distances may be off; ranges are widened by it.
SLACK = 1e-6

TREE = (
    "team int, shard int, ids binary, labels binary, points binary, width int, nodes binary, order binary, "
    "splits binary, ranges binary"
)
NODE = np.dtype([("begin", "<i4"), ("end", "<i4"), ("split", "<i4"), ("fan", "<i4"), ("child", "<i4"), ("range", "<i4")])
NOTHING = np.iinfo(np.int64).min


class Tree:
    """A tree over integer vectors, lifted to one length so that a larger product is nearer.

    With M the longest vector, the squared distance of a query q and x is |q|^2 + M^2 - 2 q.x. A
    node's rows go to their nearest split point; for split point i and subtree j the node holds the
    least and the greatest distance from i to the rows of j. Leaves are runs of `order`.
    """

    def __init__(self, ids, labels, points, stored=None):
        self.ids, self.labels, self.points = ids, labels, points
        squares = np.einsum("ij,ij->i", points, points)
        self.longest = float(squares.max())
        self.lift = np.sqrt(self.longest - squares)
        self.slack = SLACK * np.sqrt(max(1.0, self.longest))
        self.nodes, self.order, self.splits, self.ranges = stored or self._grown()

    def _between(self, rows: np.ndarray, split: np.ndarray) -> np.ndarray:
        products = self.points[rows] @ self.points[split].T + np.outer(self.lift[rows], self.lift[split])
        return np.sqrt(np.maximum(2 * self.longest - 2 * products, 0.0))

    def _chosen(self, rows: np.ndarray) -> np.ndarray:
        """Split points far from each other: from evenly spaced rows and the row farthest from the first."""
        some = rows[np.linspace(0, len(rows) - 1, min(len(rows), 3 * FAN)).astype(np.int64)]
        away = self._between(rows, rows[:1])[:, 0]
        some = np.unique(np.append(some, rows[away.argmax()]))
        found = [int(rows[0])]
        distance = self._between(some, np.array(found))[:, 0]
        while len(found) < FAN and distance.max() > self.slack:
            found.append(int(some[distance.argmax()]))
            distance = np.minimum(distance, self._between(some, np.array(found[-1:]))[:, 0])
        return np.array(found, np.int32)

    def _grown(self):
        order = np.argsort(self.ids, kind="stable").astype(np.int32)
        nodes, splits, ranges, n_splits, n_ranges = [[0, len(order), 0, 0, 0, 0]], [], [], 0, 0
        for node in nodes:  # grows while it is read
            begin, end = node[:2]
            if end - begin <= LEAF_ROWS:
                continue
            rows = order[begin:end]
            split = self._chosen(rows)
            if len(split) < 2:  # all rows are equal
                continue
            distance = self._between(rows, split)
            owner = distance.argmin(axis=1)
            own = np.flatnonzero(np.isin(rows, split))  # a split point stays with itself
            owner[own] = [int(np.flatnonzero(split == r)[0]) for r in rows[own]]
            by = np.argsort(owner, kind="stable")
            order[begin:end], distance = rows[by], distance[by]
            borders = np.searchsorted(owner[by], np.arange(len(split) + 1))
            node[2:] = [n_splits, len(split), len(nodes), n_ranges]
            low = np.minimum.reduceat(distance, borders[:-1], axis=0)  # [subtree, split point]
            high = np.maximum.reduceat(distance, borders[:-1], axis=0)
            splits.append(split)
            ranges.append(np.stack([low, high]).ravel())
            n_splits, n_ranges = n_splits + len(split), n_ranges + 2 * len(split) ** 2
            nodes += [[begin + int(a), begin + int(b), 0, 0, 0, 0] for a, b in zip(borders, borders[1:])]
        table = np.array([tuple(n) for n in nodes], NODE)
        return table, order, np.concatenate(splits or [np.zeros(0, np.int32)]), np.concatenate(ranges or [np.zeros(0)])


class Search:
    """The first `k` rows of each query: score in its window, label equal to the query's or different.

    Higher scores come first, ties go to smaller ids. `low` and `high` bound the scores; a query's
    window is an annulus around it, whose outer radius shrinks to the k-th score found.
    """

    def __init__(self, numbers, ids, labels, points, low, high, k: int, same: bool):
        self.numbers, self.own, self.labels, self.points = numbers, ids, labels, points
        self.low, self.high, self.k, self.same = low, high, k, same
        self.lengths = np.einsum("ij,ij->i", points, points)
        self.scores = np.full((len(ids), k), NOTHING)
        self.ids = np.full((len(ids), k), np.iinfo(np.int64).max)

    def _radii(self, tree: Tree, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner and outer radius of the annulus in which a row can still be wanted."""
        reach = self.lengths[rows] + tree.longest
        least = np.maximum(self.low[rows], self.scores[rows, -1])
        inner = np.sqrt(np.maximum(reach - 2.0 * self.high[rows], 0.0))
        return inner, np.sqrt(np.maximum(reach - 2.0 * least, 0.0))

    def over(self, tree: Tree) -> None:
        """Walk the tree with all queries together.

        First each query goes down by the split point nearest to its inner radius, which gives it
        scores to prune by. Then it leaves a subtree j when the distances from some split point i to j's
        rows miss what the triangle inequality leaves of the annulus.
        """
        seen = np.full(len(self.own), -1)
        for first in (True, False):
            stack = [(0, np.arange(len(self.own)))]
            while stack:
                at, rows = stack.pop()
                if not first:
                    rows = rows[seen[rows] != at]
                if not len(rows):
                    continue
                node = tree.nodes[at]
                if not node["fan"]:
                    self._leaf(tree, rows, tree.order[node["begin"] : node["end"]])
                    if first:
                        seen[rows] = at
                    continue
                stack += self._below(tree, node, rows, first)

    def _below(self, tree: Tree, node, rows: np.ndarray, first: bool) -> list[tuple[int, np.ndarray]]:
        fan, child = int(node["fan"]), int(node["child"])
        split = tree.splits[node["split"] : node["split"] + fan]
        low, high = tree.ranges[node["range"] : node["range"] + 2 * fan * fan].reshape(2, fan, fan)
        products = self.points[rows] @ tree.points[split].T
        distance = np.sqrt(np.maximum(self.lengths[rows][:, None] + tree.longest - 2 * products, 0.0))
        inner, outer = self._radii(tree, rows)
        if first:
            own = np.abs(distance - inner[:, None]).argmin(axis=1)
            return [(child + j, rows[own == j]) for j in range(fan)]
        slack = tree.slack + SLACK * distance
        nearest = np.maximum(distance - outer[:, None], inner[:, None] - distance) - slack
        farthest = distance + outer[:, None] + slack
        out = []
        for j in range(fan):
            alive = ((low[j] <= farthest) & (high[j] >= nearest)).all(axis=1)
            out.append((child + j, rows[alive]))
        return out

    def _leaf(self, tree: Tree, rows: np.ndarray, members: np.ndarray) -> None:
        """Exact scores of the leaf's rows, in steps; the k best stay."""
        for begin in range(0, len(members), LEAF_ROWS):
            part = members[begin : begin + LEAF_ROWS]
            width = max(1, STEP_SCORES // len(part))
            for at in range(0, len(rows), width):
                self._scored(tree, rows[at : at + width], part)

    def _scored(self, tree: Tree, rows: np.ndarray, part: np.ndarray) -> None:
        ids = tree.ids[part]
        scores = (self.points[rows] @ tree.points[part].T).astype(np.int64)
        last, last_id = self.scores[rows, -1][:, None], self.ids[rows, -1][:, None]
        wanted = (self.labels[rows][:, None] == tree.labels[part][None, :]) == self.same
        wanted &= self.own[rows][:, None] != ids[None, :]
        wanted &= (scores >= self.low[rows][:, None]) & (scores <= self.high[rows][:, None])
        wanted &= (scores > last) | ((scores == last) & (ids[None, :] < last_id))
        some = np.flatnonzero(wanted.any(axis=1))
        if not len(some):
            return
        rows = rows[some]
        every = np.concatenate([self.scores[rows], np.where(wanted[some], scores[some], NOTHING)], axis=1)
        names = np.concatenate([self.ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
        names = np.where(every == NOTHING, np.iinfo(np.int64).max, names)
        best = np.lexsort((names, -every.astype(np.float64)), axis=-1)[:, : self.k]
        self.scores[rows] = np.take_along_axis(every, best, axis=1)
        self.ids[rows] = np.take_along_axis(names, best, axis=1)


def quantized(vectors: DataFrame) -> DataFrame:
    """number, vec_id, label and point (floor(256 x) of each component) of the rows that take part.

    Not: null ids, labels or vectors; empty vectors; null or non-finite components, or some of 2 ** 12 or more, whose
    products a double would not hold; vectors of another length than most have. Where the id is
    divisible by 7 the label is another one, (label + 1) % 10.
    """
    x = F.col("embedding")
    sound = vectors.where(
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & (F.size(x) > 0)
        & ~F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) >= LARGEST))
    )
    lengths = sound.groupBy(F.size(x).alias("width")).count()
    width = lengths.orderBy(F.desc("count"), F.desc("width")).first()
    label = F.col("label").cast("bigint")
    return sound.where(F.size(x) == (width["width"] if width else 0)).select(
        F.monotonically_increasing_id().alias("number"),
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label).alias("label"),
        F.transform(x, lambda v: F.floor(v.cast("double") * 256).cast("int")).alias("point"),
    )


def _matrix(table: pa.Table, column: str = "point") -> np.ndarray:
    flat = pc.list_flatten(table.column(column)).to_numpy()
    return flat.astype(np.float64).reshape(table.num_rows, -1)


def build_trees(points: DataFrame, rows: int, groups: int) -> DataFrame:
    """One row a shard, with its rows and their tree; shards are dealt to `groups`, rows to shards by number."""
    shards = max(1, -(-rows // SHARD_ROWS))

    def build(part: pa.Table) -> pa.Table:
        matrix = _matrix(part)
        tree = Tree(part.column("vec_id").to_numpy(), part.column("label").to_numpy(), matrix)
        shard = part.column("shard")[0].as_py()
        return pa.table(
            {
                "team": pa.array([shard % groups], pa.int32()),
                "shard": pa.array([shard], pa.int32()),
                "ids": [tree.ids.astype("<i8").tobytes()],
                "labels": [tree.labels.astype("<i8").tobytes()],
                "points": [matrix.astype("<i4").tobytes()],
                "width": pa.array([matrix.shape[1]], pa.int32()),
                "nodes": [tree.nodes.tobytes()],
                "order": [tree.order.astype("<i4").tobytes()],
                "splits": [tree.splits.astype("<i4").tobytes()],
                "ranges": [tree.ranges.astype("<f8").tobytes()],
            }
        )

    dealt = points.withColumn("shard", F.pmod(F.xxhash64("number"), F.lit(shards)).cast("int"))
    return dealt.groupBy("shard").applyInArrow(build, TREE)


def _stored_tree(row: dict) -> Tree:
    points = np.frombuffer(row["points"], "<i4").reshape(-1, row["width"]).astype(np.float64)
    stored = (
        np.frombuffer(row["nodes"], NODE),
        np.frombuffer(row["order"], "<i4"),
        np.frombuffer(row["splits"], "<i4"),
        np.frombuffer(row["ranges"], "<f8"),
    )
    return Tree(np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8"), points, stored)


_FOUND = "query bigint, vec_id bigint, score bigint"


def _first(trees: DataFrame, queries: DataFrame, groups: int, k: int, same: bool) -> DataFrame:
    """query, rank, vec_id, score: each query's first k rows among all trees.

    `queries` has query (unique), vec_id, label, point, low and high. It is a stated set; its blocks
    of `BLOCK_BYTES` and the groups of trees meet in one task each, which sends k rows of a query.
    """
    spark = queries.sparkSession
    size = queries.agg(F.count("*"), F.max(F.size("point"))).first()
    blocks = max(1, -(-(size[0] * (size[1] or 1) * 8) // BLOCK_BYTES))
    numbers = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asked = queries.withColumn("block", F.pmod(F.xxhash64("query"), F.lit(blocks)).cast("int"))
    asked = asked.withColumn("team", numbers(groups))
    searched = trees.withColumn("block", numbers(blocks))

    def run(own: pa.Table, forest: pa.Table) -> pa.Table:
        if not own.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        columns = [own.column(c).to_numpy() for c in ("query", "vec_id", "label")]
        search = Search(*columns, _matrix(own), own.column("low").to_numpy(), own.column("high").to_numpy(), k, same)
        for row in range(forest.num_rows):
            search.over(_stored_tree(forest.slice(row, 1).to_pylist()[0]))
        some = search.scores != NOTHING
        return pa.table(
            {"query": np.repeat(search.numbers, some.sum(axis=1)), "vec_id": search.ids[some], "score": search.scores[some]}
        )

    found = asked.groupBy("block", "team").cogroup(searched.groupBy("block", "team")).applyInArrow(run, _FOUND)
    by = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def hard_negatives(
    vectors: DataFrame,
    anchors: str = "vec_id % 100 = 0",
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    `vectors` has vec_id, embedding and label; see `quantized` for the rows that take part. The anchors
    are the rows that satisfy `anchors`. An anchor's positives are its first rows of the same label,
    its negatives for each of them the first rows of other labels whose score is `window` per cent of
    the positive's; a positive with a negative score has none. Higher scores come first, ties go to
    smaller ids. Rows with the anchor's own id are neither. Fewer rows than asked for: all. Repeated rows count each, also as
    anchors; other columns are not read; an empty table gives an empty result.

    Rows are dealt to shards by number, each stored with its tree, whatever their labels; so a label
    or a vector with a third of all rows spreads over all shards. Positives and negatives are two
    searches over the same trees, exact both.
    """
    spark = vectors.sparkSession
    points = staged(quantized(vectors), "points")
    rows = points.count()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    shards = max(1, -(-rows // SHARD_ROWS))
    groups = max(-(-shards // TASK_SHARDS), min(shards, parts))
    trees = staged(build_trees(points, rows, groups), "forest")
    chosen = points.where(anchors)
    top, bottom = F.lit(np.iinfo(np.int64).max), F.lit(NOTHING + 1)
    asked = chosen.select(F.col("number").alias("query"), "vec_id", "label", "point", bottom.alias("low"), top.alias("high"))
    near = staged(_first(trees, asked, groups, positives, same=True), "positives")
    windows = (
        near.where("score >= 0")
        .select(F.col("query").alias("number"), "score")
        .distinct()
        .withColumn("low", F.expr(f"({window[0]} * score + 99) div 100"))
        .withColumn("high", F.expr(f"({window[1]} * score) div 100"))
        .join(chosen, "number")
        .withColumn("query", F.monotonically_increasing_id())
    )
    windows = staged(windows, "windows")
    far = _first(trees, windows, groups, negatives, same=False).withColumnsRenamed(
        {"vec_id": "negative_id", "score": "negative_score"}
    )
    far = far.join(windows.select("query", F.col("vec_id").alias("anchor_id"), "number", "score"), "query").drop("query")
    pairs = near.select(F.col("query").alias("number"), F.col("vec_id").alias("positive_id"), "score")
    return far.join(pairs, ["number", "score"]).select(
        "anchor_id",
        "positive_id",
        F.col("rank").cast("int").alias("rank"),
        "negative_id",
        F.col("score").alias("positive_score"),
        "negative_score",
    )
