"""Strong links of a fleet without looking at all pairs of cities.

Signs of random projections: a city's standardized series, and its copies shifted by each lag, are
projected on random directions. Two series with correlation r agree in one sign with probability
1 - arccos(r) / pi, so those with a strong link meet in some of many tables of a few signs each.
What meets is a candidate; its correlations are then computed exactly.

Cities that follow one climate meet in many tables, and their links are a part of all pairs. So buckets are
not rows: series meet in pairs of blocks, as in `telecon`, and each task takes the signs of its cities, marks
who meets and computes what is marked. What is shuffled grows with the cities, not with their links.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.config import ClimateConfig
from isotherm.operators.telecon import (
    LAG_SCHEMA,
    LINK_SCHEMA,
    TILE,
    _arrow_schema,
    _Block,
    _moments,
    _moments_of,
    _pair_columns,
    _Strongest,
    _strongest,
    blocks_for,
    city_series,
    of_block_pairs,
)
from isotherm.sources.scratch import staged

# The task functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SEED = 20_011

# Series and shifts that share a bucket of one table by chance, on average.
BUCKET_ROWS = 4

# Bounds of the signs in a bucket and of the tables; what a task draws for a month is bounded by both.
LEAST_SIGNS, MOST_SIGNS, MOST_TABLES = 4, 24, 512

# Cities whose projections a task holds at once.
CITIES_AT_ONCE = 32

# Blocks of a fleet whose blocks hold no more than `telecon.LARGEST_BLOCK` cities; larger blocks have fuller tiles.
MOST_BLOCKS = 16

# Cities that others are compared with to put those alike into one tile, and how many alike get tiles of their own.
LEADERS, LEAST_ALIKE = 32, 64

# The share of two tiles' pairs from which all of them are computed.
ENOUGH = 1 / 32

# Tables that are looked at, and meetings that are marked, at once.
TABLES_AT_ONCE, MEETINGS_AT_ONCE = 16, 1 << 18


def _plan(n_cities: int, max_lag: int, threshold: float, recall: float) -> tuple[int, int]:
    """Signs of a bucket and number of tables that find a link at the threshold with the wanted chance."""
    signs = math.ceil(math.log2(max(2, n_cities * (max_lag + 1) / BUCKET_ROWS)))
    signs = min(MOST_SIGNS, max(LEAST_SIGNS, signs))
    together = (1 - math.acos(threshold) / math.pi) ** signs
    tables = math.ceil(math.log(1 - recall) / math.log(1 - together)) if together < 1 else 1
    return signs, min(MOST_TABLES, tables)


def _directions(months: np.ndarray, size: int) -> np.ndarray:
    """Random directions by month alone, so that every task and every run draws the same."""
    rows = [np.random.default_rng([SEED, int(m) % 2**32]).standard_normal(size, np.float32) for m in months]
    return np.stack(rows)


def _standardized(batch: pa.RecordBatch, months: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the cities with two different values, and their values less the mean in one unit; 0 where there is none."""
    series = batch.column("series")
    points, lengths = series.flatten(), pc.list_value_length(series).to_numpy(zero_copy_only=False)
    place = np.searchsorted(months, pc.struct_field(points, "t").to_numpy(zero_copy_only=False))
    x = pc.struct_field(points, "x").to_numpy(zero_copy_only=False).astype(float)
    city = np.repeat(np.arange(batch.num_rows), lengths.astype(np.int64))
    known = np.isfinite(x)
    place, x, city = place[known], x[known], city[known]
    size = batch.num_rows
    n = np.maximum(np.bincount(city, minlength=size), 1)
    centred = x - (np.bincount(city, x, size) / n)[city]
    norm = np.sqrt(np.bincount(city, centred**2, size))
    varied = norm > 1e-6 * np.sqrt(np.bincount(city, x**2, size))
    unit = centred / np.where(norm > 0, norm, 1.0)[city]
    grid = np.bincount(city * len(months) + place, unit, size * len(months)).reshape(size, len(months))
    return np.flatnonzero(varied), grid.astype(np.float32)


def _buckets(unit: np.ndarray, directions: np.ndarray, signs: int) -> np.ndarray:
    """The bucket of each row in every table; a bucket and its complement are one."""
    bits = (unit @ directions).reshape(len(unit), -1, signs) > 0
    bits ^= bits[:, :, :1]
    return bits.astype(np.float32) @ (1 << np.arange(signs)).astype(np.float32)  # exact up to `MOST_SIGNS`


def signatures(anomaly: DataFrame, max_lag: int, signs: int, tables: int) -> DataFrame:
    """(table_id, bucket, shift, city_id): a row for every table and shift of 0 to `max_lag` months.

    A bucket and its complement are one, so that opposite series meet as well. Cities without two
    different values have no row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drawn, directions = np.zeros(0, np.int64), np.zeros((0, tables * signs), np.float32)
        for whole in batches:
            for begin in range(0, whole.num_rows, CITIES_AT_ONCE):
                batch = whole.slice(begin, CITIES_AT_ONCE)
                points = batch.column("series").flatten()
                months = np.unique(pc.struct_field(points, "t").to_numpy(zero_copy_only=False))
                wanted = np.unique(np.add.outer(months, -np.arange(max_lag + 1)))
                new = np.setdiff1d(wanted, drawn)
                if len(new):
                    drawn = np.concatenate([drawn, new])
                    directions = np.concatenate([directions, _directions(new, tables * signs)])
                    by = np.argsort(drawn)
                    drawn, directions = drawn[by], directions[by]
                varied, grid = _standardized(batch, months)
                if not len(varied):
                    continue
                ids = batch.column("city_id").to_numpy(zero_copy_only=False)[varied]
                for shift in range(max_lag + 1):
                    at = np.searchsorted(drawn, months - shift)
                    buckets = _buckets(grid[varied], directions[at], signs)
                    yield pa.RecordBatch.from_pydict(
                        {
                            "table_id": pa.array(np.tile(np.arange(tables, dtype=np.int32), len(varied))),
                            "bucket": pa.array(buckets.ravel().astype(np.int64)),
                            "shift": pa.array(np.full(len(varied) * tables, shift, np.int32)),
                            "city_id": pa.array(np.repeat(ids.astype(np.int64), tables)),
                        }
                    )

    schema = "table_id int, bucket long, shift int, city_id long"
    return city_series(anomaly).select("city_id", "series").mapInArrow(run, schema)


def _unit(block: _Block) -> np.ndarray:
    """The deviations from its mean of each city that has two different values, in one unit."""
    return (block.total / np.sqrt(block.square.sum(axis=1))[:, None]).astype(np.float32)


class _Codes:
    """The buckets of one tile's cities and of their shifted copies, taken some tables at a time when asked for."""

    def __init__(self, tile: _Block, directions: np.ndarray, max_lag: int, signs: int):
        self.unit, self.directions, self.max_lag, self.signs = _unit(tile), directions, max_lag, signs
        self.parts: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}

    def part(self, begin: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets of the series, those of all copies in order, and the copies' cities; `TABLES_AT_ONCE` tables from `begin`."""
        if begin not in self.parts:
            (n, width), signs = self.unit.shape, self.signs
            drawn = self.directions[:, begin * signs : (begin + TABLES_AT_ONCE) * signs]
            tables = drawn.shape[1] // signs
            codes = np.empty((tables, self.max_lag + 1, n), np.int32)
            for shift in range(self.max_lag + 1):
                codes[:, shift] = _buckets(self.unit, drawn[self.max_lag - shift :][:width], signs).T
            codes += (np.arange(tables, dtype=np.int32) << signs)[:, None, None]
            own, far = codes[:, 0].ravel(), codes.reshape(tables, -1)
            order = np.argsort(far, axis=1)
            self.parts[begin] = own, np.take_along_axis(far, order, axis=1).ravel(), (order % n).astype(np.int16).ravel()
        return self.parts[begin]


def _mark(own: np.ndarray, far: np.ndarray, city: np.ndarray, met: np.ndarray) -> None:
    """Marks in `met` whose bucket is one of the other tile's copies', some meetings at a time."""
    low, high = np.searchsorted(far, own, "left"), np.searchsorted(far, own, "right")
    some = np.flatnonzero(high > low)
    ends = np.cumsum(high[some] - low[some])
    begin, done = 0, 0
    while begin < len(some):
        end = max(begin + 1, int(np.searchsorted(ends, done + MEETINGS_AT_ONCE, "right")))
        at = some[begin:end]
        each = high[at] - low[at]
        k = np.arange(each.sum()) + np.repeat(low[at] - (np.cumsum(each) - each), each)
        met[np.repeat(at % len(met), each), city[k]] = True
        begin, done = end, int(ends[end - 1])


def _met(a: _Codes, b: _Codes, tables: int, enough: float) -> tuple[np.ndarray, bool]:
    """Who of two tiles shares a bucket, and whether that is, or after all tables would be, `enough` of their pairs.

    If so it is cheaper to compute all of them, and the other tables are not looked at.
    """
    met = np.zeros((len(a.unit), len(b.unit)), bool)
    for begin in range(0, tables, TABLES_AT_ONCE):
        (one, one_far, one_city), (two, two_far, two_city) = a.part(begin), b.part(begin)
        _mark(one, two_far, two_city, met)
        _mark(two, one_far, one_city, met.T)
        seen = min(tables, begin + TABLES_AT_ONCE) / tables
        if 1 - (1 - met.mean()) ** (1 / seen) >= enough:
            return met, True
    return met, False


def _alike(block: _Block, max_lag: int, threshold: float) -> np.ndarray:
    """A number for each city, the same for those that follow the same one of `LEADERS` cities at some lag; else -1.

    It only puts cities into tiles, so that links fill some tiles instead of a part of every one.
    """
    unit = _unit(block)
    width, label = unit.shape[1], np.full(len(unit), -1)
    for leader in range(LEADERS):
        left = np.flatnonzero(label < 0)
        if not len(left):
            break
        padded = np.pad(unit[left[0]], max_lag)
        copies = np.stack([padded[k : k + width] for k in range(2 * max_lag + 1)])
        label[left[np.abs(unit[left] @ copies.T).max(axis=1) >= threshold]] = leader
        label[left[0]] = leader
    return np.where(np.bincount(label + 1)[label + 1] < LEAST_ALIKE, -1, label)


def _tiles(block: _Block, max_lag: int, threshold: float) -> list[_Block]:
    """The cities with two different values in tiles of cities that are alike and, where many do, have the same months."""
    rows = np.flatnonzero(block.varied)
    if not len(rows):
        return []
    block = block._some(rows, False)
    label = _alike(block, max_lag, threshold)
    shown = np.concatenate([np.packbits(grid > 0, axis=1) for grid in (block.rows, block.count)], axis=1)
    months = _numbers(shown)
    group = _numbers(np.stack([label, months], axis=1))
    many = np.bincount(group)[group] >= LEAST_ALIKE
    group = _numbers(np.stack([label, np.where(many, months, -1)], axis=1))
    sides = [np.flatnonzero(group == g) for g in range(group.max() + 1)]
    return [block.tile(side[k : k + TILE]) for side in sides for k in range(0, len(side), TILE)]


def _numbers(rows: np.ndarray) -> np.ndarray:
    """A number for each row, the same for equal rows."""
    return np.unique(rows, axis=0, return_inverse=True)[1].ravel()


def _per_met_tiles(
    anomaly: DataFrame,
    config: ClimateConfig,
    threshold: float,
    recall: float,
    enough: float,
    task: Callable[[_Block, _Block, bool, np.ndarray | None], Iterator[pa.Table]],
    schema: str,
) -> DataFrame:
    """The tables of `task(a, b, same, met)` for every two tiles with candidates; `met` marks them, or is None if they are `enough`.

    Signatures are taken where a pair of blocks meets, and a pair of cities is marked once however many
    buckets it shares. So a series is shuffled once a block, and no bucket and no pair is.
    """
    n_cities = anomaly.where(F.col("city_id").isNotNull()).agg(F.count_distinct("city_id")).first()[0]
    signs, tables = _plan(n_cities, config.max_lag, threshold, recall)
    max_lag, drawn = config.max_lag, {}

    def codes(tile: _Block) -> _Codes:
        width = tile.rows.shape[1]
        if width not in drawn:
            drawn.clear()
            drawn[width] = _directions(np.arange(-max_lag, width), tables * signs)
        return _Codes(tile, drawn[width], max_lag, signs)

    def tiles(low: _Block, high: _Block | None) -> Iterator[pa.Table]:
        b_side = [(b, codes(b)) for b in _tiles(low if high is None else high, max_lag, threshold)]
        for k, a in enumerate([a for a, _ in b_side] if high is None else _tiles(low, max_lag, threshold)):
            own = b_side[k][1] if high is None else codes(a)
            for n, (b, far) in enumerate(b_side[k:] if high is None else b_side):
                met, whole = _met(own, far, tables, enough)
                met &= a.id_values[:, None] != b.id_values[None, :]
                if whole or met.any():
                    yield from task(a, b, high is None and n == 0, None if whole else met)

    n_blocks = blocks_for(n_cities, config.block_size, MOST_BLOCKS)
    return of_block_pairs(anomaly, config, n_cities, n_blocks, tiles, schema)


def _strong(a: _Block, b: _Block, met: np.ndarray | None, max_lag: int, threshold: float) -> Iterator[tuple]:
    """For each lag, months in common and correlation of the marked pairs with `threshold` or more; NaN for the others.

    Without marks the tiles are multiplied as a whole, which also finds links that no bucket showed.
    """
    other = a.id_values[:, None] != b.id_values[None, :]
    i, j = (None, None) if met is None else np.nonzero(met)
    for lag in range(-max_lag, max_lag + 1):
        if met is None:
            rows, r = _moments(a, b, lag)
        else:
            rows, r = np.zeros(met.shape), np.full(met.shape, np.nan)
            rows[i, j], r[i, j] = _moments_of(a, i, j, lag, b)
        yield lag, rows, np.where(other & (rows > 0) & (np.abs(r) >= threshold), r, np.nan)


def candidate_links(
    anomaly: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    threshold: float = 0.8,
    recall: float = 0.999,
) -> DataFrame:
    """Pairs (city_id < other_city_id) that may be correlated by `threshold` or more at some lag.

    A pair that is, without gaps, is among them with probability `recall` or more; others come in by
    chance, about `BUCKET_ROWS` a city and table. Shifts of one side are enough: the pair at a
    negative lag is the other order at the positive one.
    """

    def task(a: _Block, b: _Block, same: bool, met: np.ndarray) -> Iterator[pa.Table]:
        i, j = np.nonzero(met)
        ends = np.sort(np.stack([a.id_values[i], b.id_values[j]]), axis=0)
        yield pa.table([pa.array(x) for x in ends], names=["city_id", "other_city_id"])

    pairs = _per_met_tiles(anomaly, config, threshold, recall, 2.0, task, "city_id long, other_city_id long")
    return pairs.distinct()  # an id may have several names


def similar_links(
    anomaly: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    threshold: float = 0.8,
    recall: float = 0.999,
) -> DataFrame:
    """`lag_correlations` of `threshold` or more in size, found as `candidate_links` finds them and computed exactly.

    Candidates are computed where they are found, so that links are given out and nothing else is moved.
    """
    max_lag, schema = config.max_lag, _arrow_schema(LAG_SCHEMA)

    def task(a: _Block, b: _Block, same: bool, met: np.ndarray | None) -> Iterator[pa.Table]:
        for lag, rows, r in _strong(a, b, met, max_lag, threshold):
            i, j = np.nonzero(~np.isnan(r))
            if not len(i):
                continue
            n, found = np.rint(rows[i, j]).astype(np.int64), r[i, j]
            for x, y, own, other, sign in ((a, b, i, j, 1),) if same else ((a, b, i, j, 1), (b, a, j, i, -1)):
                columns = _pair_columns(x, y, own, other, n, found)
                columns.insert(4, pa.array(np.full(len(i), sign * lag, dtype=np.int64)))
                yield pa.Table.from_arrays(columns, schema=schema)

    return _per_met_tiles(anomaly, config, threshold, recall, ENOUGH, task, LAG_SCHEMA)


def twins(anomaly: DataFrame) -> DataFrame:
    """city_id, and `first` and `last`: the smallest and largest id of the cities with the very same series."""
    series = city_series(anomaly).select("city_id", F.array_sort("series").alias("series"))
    content = series.select("city_id", F.sha2(F.to_json(F.struct("series")), 256).alias("content"))
    ends = content.groupBy("content").agg(F.min("city_id").alias("first"), F.max("city_id").alias("last"))
    return content.join(ends, "content").select("city_id", "first", "last")


def strongest_similar(
    anomaly: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    threshold: float = 0.8,
    recall: float = 0.999,
) -> DataFrame:
    """`best_lag(similar_links(anomaly))`: the strongest link of the cities that have one of `threshold` or more.

    Two tiles emit one candidate per city instead of their links.

    Of cities with the very same series two take part, which gives both their strongest link; the
    others share it. So a third of the fleet may be copies of one series. The exact form for all
    cities, at the cost of all pairs, is `telecon.strongest_links`.
    """
    same = staged(twins(anomaly), "twins")
    shown = same.where("city_id = first OR city_id = last").select("city_id")

    def task(a: _Block, b: _Block, same: bool, met: np.ndarray | None) -> Iterator[pa.Table]:
        sides = ((_Strongest(len(a.id_values)), a, 1, 1), (_Strongest(len(b.id_values)), b, 0, -1))[: 1 if same else 2]
        for lag, _, r in _strong(a, b, met, config.max_lag, threshold):
            for best, _, axis, sign in sides:
                top = np.fmax.reduce(np.abs(r), axis=axis, initial=-1.0)
                best.add(sign * lag, top >= 0, top)
        schema = _arrow_schema(LINK_SCHEMA)
        yield from (pa.Table.from_arrays(best.columns(tile), schema=schema) for best, tile, *_ in sides)

    some = staged(anomaly.join(shown, "city_id", "left_semi"), "shown")
    found = _strongest(_per_met_tiles(some, config, threshold, recall, ENOUGH, task, LINK_SCHEMA))
    found = found.withColumnRenamed("city_id", "first")
    return same.select("city_id", "first").join(found, "first").drop("first")
