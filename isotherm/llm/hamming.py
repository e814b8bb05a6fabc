"""Self-join of 64-bit fingerprints by a binary trie, and components of its links."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.sources.scratch import staged

#: Values that a task joins at once; larger buckets are cut into parts that meet in pairs.
BUCKET_ROWS = 8192

#: Node pairs that are expanded at once.
FRONTIER = 1 << 18

#: Links that a task holds before it reduces them to stars.
LINKS_HELD = 1 << 21

_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def components(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """The smallest node that each of `n` nodes reaches over the links u-v."""
    label = np.arange(n)
    while True:
        a, b = label[u], label[v]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_links = low != high
        if not open_links.any():
            return label
        np.minimum.at(label, high[open_links], low[open_links])
        while True:
            shorter = label[label]
            if (shorter == label).all():
                break
            label = shorter


def _length(x: np.ndarray) -> np.ndarray:
    """Number of leading bits before the highest set bit of x; 64 if none is set."""
    out = np.full(len(x), 64, np.int64)
    rest = x.copy()
    some = rest > 0
    for shift in (32, 16, 8, 4, 2, 1):
        big = rest >= (np.uint64(1) << np.uint64(shift))
        out[big] -= shift
        rest[big] >>= np.uint64(shift)
    out[some] -= 1
    return out


def _mask(length: np.ndarray) -> np.ndarray:
    """The first `length` bits."""
    length = length.astype(np.uint64)
    return np.where(length > 0, _ALL << (np.uint64(64) - np.maximum(length, 1)), np.uint64(0))


class Trie:
    """Path-compressed binary trie over values that are sorted and different within each group.

    A node is a run of values with a common prefix of `length` bits; `spread` has the bits in which
    its values differ from its first one. Nodes below `leaves` are the values themselves.
    """

    def __init__(self, values: np.ndarray, groups: np.ndarray):
        n = len(values)
        self.values, self.leaves = values, n
        starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if n else np.zeros(0, np.int64)
        low, high = starts, np.append(starts[1:], n)
        lows, lengths, lefts, rights = [np.arange(n)], [np.full(n, 64)], [np.full(n, -1)], [np.full(n, -1)]
        highs = [np.arange(n) + 1]
        count = n
        many = high - low > 1
        self.roots = count + np.arange(int(many.sum()))
        low, high = low[many], high[many]
        while len(low):
            length = _length(values[low] ^ values[high - 1])
            bit = np.uint64(1) << (np.uint64(63) - length.astype(np.uint64))
            cut = self._first_with(bit, low, high)
            ids = count + np.arange(len(low))
            count += len(low)
            lows.append(low)
            highs.append(high)
            lengths.append(length)
            one_left, one_right = cut - low == 1, high - cut == 1
            left, right = low.copy(), cut.copy()
            new_left = np.flatnonzero(~one_left)
            new_right = np.flatnonzero(~one_right)
            left[new_left] = count + np.arange(len(new_left))
            right[new_right] = count + len(new_left) + np.arange(len(new_right))
            lefts.append(left)
            rights.append(right)
            low, high = np.append(low[new_left], cut[new_right]), np.append(cut[new_left], high[new_right])
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.length = np.concatenate(lengths)
        self.left, self.right = np.concatenate(lefts), np.concatenate(rights)
        self.spread = np.zeros(count, np.uint64)
        for node in _levels_upwards(lows, n):
            a, b = self.left[node], self.right[node]
            gap = values[self.low[a]] ^ values[self.low[b]]
            self.spread[node] = self.spread[a] | self.spread[b] | gap

    def _first_with(self, bit: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The first place in each run whose value has the bit set (binary search, all at once)."""
        a, b = low + 1, high - 1  # the first value lacks it, the last one has it
        while True:
            open_runs = a < b
            if not open_runs.any():
                return b
            middle = (a + b) >> 1
            has = (self.values[middle] & bit) > 0
            b = np.where(open_runs & has, middle, b)
            a = np.where(open_runs & ~has, middle + 1, a)


def _levels_upwards(lows: list[np.ndarray], n: int):
    ends = np.cumsum([len(x) for x in lows])
    for level in range(len(lows) - 1, 0, -1):
        yield np.arange(ends[level - 1], ends[level])


def linked(values: np.ndarray, groups: np.ndarray, budget: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect exactly what the pairs within `budget` bits in each group connect.

    Node pairs go down together. The bits in which their common prefixes differ are counted; a pair
    over the budget is dropped, and a pair whose values cannot differ in more bits than the budget
    is linked as a whole. Only stars come out, at most one link for each value and group.
    """
    trie = Trie(values, groups)
    found_u: list[np.ndarray] = []
    found_v: list[np.ndarray] = []
    held = 0
    stack = [(trie.roots, trie.roots)] if len(trie.roots) else []
    while stack:
        a, b = stack.pop()
        if len(a) > FRONTIER:
            stack.append((a[FRONTIER:], b[FRONTIER:]))
            a, b = a[:FRONTIER], b[:FRONTIER]
        gap = values[trie.low[a]] ^ values[trie.low[b]]
        shared = _mask(np.minimum(trie.length[a], trie.length[b]))
        near = np.bitwise_count(gap & shared) <= budget
        a, b, gap = a[near], b[near], gap[near]
        most = np.bitwise_count(gap | trie.spread[a] | trie.spread[b])
        whole = most <= budget
        if whole.any():
            for x, y in ((a[whole], b[whole]), (b[whole], a[whole])):
                size = trie.high[y] - trie.low[y]
                at = np.arange(int(size.sum())) + np.repeat(trie.low[y] - (np.cumsum(size) - size), size)
                found_u.append(np.repeat(trie.low[x], size))
                found_v.append(at)
                held += len(at)
            a, b = a[~whole], b[~whole]
        same = a == b
        if same.any():
            left, right = trie.left[a[same]], trie.right[a[same]]
            inner_l, inner_r = left[left >= trie.leaves], right[right >= trie.leaves]
            stack.append((np.concatenate([left, inner_l, inner_r]), np.concatenate([right, inner_l, inner_r])))
            a, b = a[~same], b[~same]
        if len(a):
            swap = trie.length[a] > trie.length[b]
            a, b = np.where(swap, b, a), np.where(swap, a, b)  # a branches first
            stack.append((np.concatenate([trie.left[a], trie.right[a]]), np.concatenate([b, b])))
        if held > LINKS_HELD:
            label = components(len(values), np.concatenate(found_u), np.concatenate(found_v))
            other = np.flatnonzero(label != np.arange(len(values)))
            found_u, found_v, held = [label[other]], [other], len(other)
    if not found_u:
        none = np.zeros(0, np.int64)
        return none, none
    label = components(len(values), np.concatenate(found_u), np.concatenate(found_v))
    other = np.flatnonzero(label != np.arange(len(values)))
    return label[other], other


def _block_bits(blocks: int) -> list[tuple[int, int]]:
    edges = [64 * i // blocks for i in range(blocks + 1)]
    return [(edges[i], edges[i + 1] - edges[i]) for i in range(blocks)]


def hamming_links(values: DataFrame, budget: int, rows: int) -> DataFrame:
    """Links (u, v) that connect what the pairs of different `value`s within `budget` bits connect.

    `values` has one bigint column `value`, each value once; `rows` is their number. Of
    budget + k blocks of bits, k agree in any such pair, so for every choice of k blocks the values
    meet in buckets that share those bits: the upper part of the trie, where no bit may differ.
    Below, the trie is searched with the whole budget. k follows from the number of values; a
    bucket of more than BUCKET_ROWS values is cut into parts, and each pair of parts is a bucket of
    its own, so no bucket grows with the data.
    """
    agree = 1
    while rows >> (64 * agree // (budget + agree)) > BUCKET_ROWS // 2:
        agree += 1
    blocks = _block_bits(budget + agree)
    keys = []
    for number, chosen in enumerate(combinations(blocks, agree)):
        mask = sum(((1 << width) - 1) << low for low, width in chosen)
        signed = mask - (1 << 64) if mask >= 1 << 63 else mask
        keys.append(
            F.struct(
                F.lit(number).alias("choice"),
                F.col("value").bitwiseAND(F.lit(signed).cast("bigint")).alias("key"),
            )
        )
    dealt = values.select("value", F.explode(F.array(*keys)).alias("b")).select("value", "b.choice", "b.key")
    crowded = (
        dealt.groupBy("choice", "key")
        .count()
        .where(F.col("count") > BUCKET_ROWS)
        .select("choice", "key", F.ceil(F.col("count") / BUCKET_ROWS).cast("int").alias("parts"))
    )
    crowded = staged(crowded, "crowded")
    own = F.pmod(F.xxhash64("value"), F.col("parts")).cast("int")
    dealt = dealt.join(crowded, ["choice", "key"], "left").withColumn(
        "pair",
        F.explode(
            F.when(F.col("parts").isNull(), F.array(F.struct(F.lit(0).alias("i"), F.lit(0).alias("j")))).otherwise(
                F.transform(
                    F.sequence(F.lit(0), F.col("parts") - 1),
                    lambda k: F.struct(F.least(k, own).alias("i"), F.greatest(k, own).alias("j")),
                )
            )
        ),
    )
    dealt = dealt.select("choice", "key", "pair.i", "pair.j", "value")
    at = ["choice", "key", "i", "j"]

    def run(batches):
        held: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= 4 * BUCKET_ROWS:
                done, rest = _complete(held)
                if done is not None:
                    yield _stars(done, budget)
                held, count = ([rest], rest.num_rows) if rest is not None else ([], 0)
        if held:
            yield _stars(pa.Table.from_batches(held), budget)

    return dealt.repartition(*at).sortWithinPartitions(*at, "value").mapInArrow(run, "u bigint, v bigint")


def _groups(rows: pa.Table) -> np.ndarray:
    """Numbers the buckets of sorted rows."""
    new = np.zeros(rows.num_rows, bool)
    for name in ("choice", "key", "i", "j"):
        column = rows.column(name).to_numpy()
        new[1:] |= column[1:] != column[:-1]
    return np.cumsum(new)


def _complete(held: list[pa.RecordBatch]) -> tuple[pa.Table | None, pa.RecordBatch | None]:
    """The rows before the last bucket, and those of the last, which may go on in the next batch."""
    rows = pa.Table.from_batches(held).combine_chunks()
    groups = _groups(rows)
    cut = int(np.searchsorted(groups, groups[-1]))
    rest = rows.slice(cut).combine_chunks().to_batches()[0]
    return (rows.slice(0, cut) if cut else None), rest


def _stars(rows: pa.Table, budget: int) -> pa.RecordBatch:
    groups = _groups(rows)
    signed = rows.column("value").to_numpy()
    values = signed.view(np.uint64)
    order = np.lexsort((values, groups))  # Spark sorts signed
    groups, values, signed = groups[order], values[order], signed[order]
    first = np.r_[True, (groups[1:] != groups[:-1]) | (values[1:] != values[:-1])]
    groups, values, signed = groups[first], values[first], signed[first]
    u, v = linked(values, groups, budget)
    return pa.RecordBatch.from_pydict({"u": pa.array(signed[u]), "v": pa.array(signed[v])})


def connected(links: DataFrame) -> DataFrame:
    """One row (node, root) for each node of `links` (u, v): root is the smallest node it reaches.

    Large-star and small-star steps in turn: each node's neighbours move to its smallest one, until
    only stars are left. A node's smallest neighbour is a partial aggregate, and the join back to
    its links can be split, so a star's hub is no hot spot. Every round is stored.
    """
    edges = staged(
        links.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "links",
    )
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = staged(large.where("u <> v").distinct(), "large")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        small = staged(small.where("u <> v").distinct(), "small")
        left = small.exceptAll(edges).limit(1).count() + edges.exceptAll(small).limit(1).count()
        edges = small
        if not left:
            break
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
