"""Cross-station correlations of monthly anomalies, contemporaneous and lagged.

A join of the monthly rows on time would ship (pairs x months) rows through a shuffle. Here each
city becomes one compact series (bounded by the calendar), cities are hashed into blocks, and every
pair of blocks is one group that gets its Pearson sums from matrix products, tile by tile. The shuffle
carries each series once per block instead of once per partner and month; a large fleet gets larger
blocks rather than more of them, so what is shuffled grows with the cities.

With candidate pairs, a task holds the candidates of one pair of blocks and only the series that they
name, and takes only their sums. `similar.py` finds candidates.
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
from isotherm.functions.columns import month_index
from isotherm.sources.scratch import staged

# The task functions travel with the job, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Blocks of a fleet whose blocks hold no more than `LARGEST_BLOCK` cities; a larger fleet has more.
MOST_BLOCKS = 32
LARGEST_BLOCK = 16_384

# The same for all pairs of a fleet: a series is shuffled once for each block, and fuller tiles take less time.
PAIR_BLOCKS = 16

# Cities on each side of a tile, the part of a pair of blocks that is computed and given out at once.
TILE = 512

# Cities of a block with the same months from which they get tiles of their own.
LEAST_ALIKE = 64

# Pairs of cities that a task takes on average.
PAIRS_PER_TASK = 1 << 18

# One month of a packed series.
POINT = np.dtype([("t", "<i8"), ("x", "<f8")])

# Words in front of a packed series.
HEAD = 3

# Candidates that a task takes on average, and grid cells it gathers at once for them.
CANDIDATES_PER_TASK = 4_096
GATHERED_CELLS = 1 << 21

# A variance this far below its sum of squares is rounding noise: the input was constant.
CONSTANT_TOLERANCE = 1e-12

# Rounding error of single precision; two strengths less than `NEAR` apart may be equal to nine decimals.
SHORT = 2.0**-24
NEAR = 1e-9

# Two tiles are computed in full where more than this share of their pairs may be a city's strongest, or sizes are less sure than this.
MOST_NEAR, MOST_ERROR = 1 / 32, 1e-2

# Bytes of series in single precision that a task holds.
MOST_SHORT = 128 << 20

PAIR_SCHEMA = (
    "city_id_1 long, city_name_1 string, city_id_2 long, city_name_2 string, "
    "n_observations long, anomaly_correlation double"
)
LAG_SCHEMA = (
    "city_id long, city_name string, other_city_id long, other_city_name string, "
    "lag_months long, n_observations long, anomaly_correlation double"
)
PACKED_SCHEMA = "city_id long, city_name string, points binary"
LINK_SCHEMA = "city_id long, strength double, strength_9 long, lag_months long"
SIZE_SCHEMA = "city_id long, lag_months long, anomaly_correlation double"


# --------------------------------------------------------------------------------------
# Spark side: series, blocks, block pairs
# --------------------------------------------------------------------------------------

def _until(anomaly: DataFrame, as_of: tuple[int, int] | None) -> DataFrame:
    """The months up to `as_of` (year, month), itself included."""
    if as_of is None:
        return anomaly
    last = month_index(F.lit(as_of[0]), F.lit(as_of[1]))
    return anomaly.where(month_index(F.col("year"), F.col("month")) <= last)


def city_series(anomaly: DataFrame) -> DataFrame:
    """city_id, city_name and `series`, the points (t, x) of a city; at most one city's calendar a row."""
    point = F.struct(
        month_index(F.col("year"), F.col("month")).alias("t"),
        F.col("anomaly_tmean_c").alias("x"),
    )
    known = anomaly.where(F.col("city_id").isNotNull())
    return known.groupBy("city_id", "city_name").agg(F.collect_list(point).alias("series"))


def packed(batches: Iterator[pa.RecordBatch], point: np.dtype = POINT) -> Iterator[pa.RecordBatch]:
    """Series as one binary value a city, which shuffles and crosses to Python without a step for each month.

    It holds the number of months, marks of the fields that have one value all along, the month before the first,
    and then field by field that value or all of them, for the months the steps between them. A month takes
    8 bytes for its value, and 8 more for each field that is not the same throughout.
    """
    for batch in batches:
        series = batch.column("series")
        points, lengths = series.flatten(), pc.list_value_length(series).to_numpy(zero_copy_only=False).astype(np.int64)
        columns = [pc.struct_field(points, n).to_numpy(zero_copy_only=False).astype(point[n]) for n in point.names]
        city, begin = np.repeat(np.arange(len(lengths)), lengths), np.cumsum(lengths) - lengths
        order = np.lexsort((columns[0], city))
        t, *values = (column[order] for column in columns)
        step = np.diff(t, prepend=t[:1])
        step[begin] = np.where(lengths > 1, step[np.minimum(begin + 1, len(t) - 1)], 1)
        words = [step, *(value.view("<i8") for value in values)]
        alike = [np.logical_and.reduceat(word == word[begin][city], begin) for word in words] if len(t) else []
        sizes = [np.where(one, 1, lengths) for one in alike]
        ends = np.cumsum(HEAD + sum(sizes, np.zeros(len(lengths), np.int64)))
        start = np.concatenate([[0], ends])
        out = np.empty(start[-1], "<i8")
        out[start[:-1]], out[start[:-1] + 2] = lengths, t[begin] - step[begin]
        out[start[:-1] + 1] = sum((one.astype(np.int64) << k for k, one in enumerate(alike)), np.zeros(len(lengths), np.int64))
        at, within = start[:-1] + HEAD, np.arange(len(t)) - begin[city]
        for word, one, size in zip(words, alike, sizes):
            kept = ~one[city]
            out[at[one]] = word[begin[one]]
            out[(at[city] + within)[kept]] = word[kept]
            at = at + size
        offsets = (start * out.itemsize).astype(np.int32)
        binary = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(offsets), pa.py_buffer(out)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("city_id"), batch.column("city_name"), binary], ["city_id", "city_name", "points"]
        )


def unpacked(table: pa.Table, point: np.dtype = POINT) -> pa.Table:
    """`series` as it was, in the order of the months, for packed cities."""
    packed = table["points"].combine_chunks()
    start = np.concatenate([[0], np.cumsum(pc.binary_length(packed).to_numpy(zero_copy_only=False).astype(np.int64) // 8)])
    words = np.frombuffer(b"".join(packed.to_pylist()), "<i8")
    lengths, marks, before = (words[start[:-1] + k] for k in range(HEAD))
    city, ends = np.repeat(np.arange(len(lengths)), lengths), np.concatenate([[0], np.cumsum(lengths)])
    within, at, columns = np.arange(ends[-1]) - ends[city], start[:-1] + HEAD, []
    for k, name in enumerate(point.names):
        one = (marks >> k & 1).astype(bool)
        columns.append(words[at[city] + np.where(one[city], 0, within)].view(point[name]))
        at = at + np.where(one, 1, lengths)
    past = np.concatenate([[0], np.cumsum(columns[0])])
    columns[0] = before[city] + past[1:] - past[ends[city]]
    months = pa.StructArray.from_arrays([pa.array(column) for column in columns], point.names)
    return table.drop_columns("points").append_column("series", pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), months))


def blocks_for(n_cities: int, block_size: int, most: int = MOST_BLOCKS) -> int:
    """Blocks of `block_size` cities, or `most` larger ones; none is larger than `LARGEST_BLOCK` on average."""
    return max(1, min(most, -(-n_cities // block_size)), -(-n_cities // LARGEST_BLOCK))


def tasks_for(n_cities: int, n_blocks: int) -> int:
    """Tasks of about `PAIRS_PER_TASK` pairs of cities, no more than there are pairs of blocks."""
    return max(1, min(n_blocks * (n_blocks + 1) // 2, -(-(n_cities**2) // (2 * PAIRS_PER_TASK))))


def _block_pairs(anomaly: DataFrame, n_blocks: int) -> DataFrame:
    """Each city's series, once for every block pair it takes part in."""
    block = F.pmod(F.xxhash64("city_id"), F.lit(n_blocks)).cast("int")
    series = city_series(anomaly).mapInArrow(packed, PACKED_SCHEMA).withColumn("block", block)
    partner = F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))).alias("partner")
    return series.select("city_id", "city_name", "points", "block", partner).select(
        F.least("block", "partner").alias("block_lo"),
        F.greatest("block", "partner").alias("block_hi"),
        "block",
        "city_id",
        "city_name",
        "points",
    )


def _candidate_blocks(anomaly: DataFrame, pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Candidates (smaller id first) under the blocks of their cities, and the series that each pair of blocks names.

    The blocks are as many as give a task `CANDIDATES_PER_TASK` candidates; a city with many candidates
    meets the blocks of their other ends, so it spreads over as many tasks.
    """
    ends = pairs.where("city_id <> other_city_id").select(
        F.least("city_id", "other_city_id").alias("city_id"),
        F.greatest("city_id", "other_city_id").alias("other_city_id"),
    )
    ends = staged(ends.distinct(), "candidates")
    n_blocks = ends.select(
        F.greatest(F.lit(1), F.ceil(F.sqrt(F.count(F.lit(1)) / CANDIDATES_PER_TASK)).cast("int")).alias("n")
    ).scalar()
    block = [
        F.pmod(F.xxhash64(c), F.col("n_blocks")).cast("int").alias(b)
        for c, b in (("city_id", "block_lo"), ("other_city_id", "block_hi"))
    ]
    placed = ends.withColumn("n_blocks", n_blocks).select(*block, "city_id", "other_city_id")
    named = placed.select(
        F.col("block_lo").alias("of_lo"), F.col("block_hi").alias("of_hi"), F.explode(F.array("city_id", "other_city_id")).alias("city_id")
    )
    return placed, named.distinct().join(city_series(anomaly), "city_id")


def _per_candidate(
    anomaly: DataFrame,
    config: ClimateConfig,
    pairs: DataFrame,
    task: Callable[[_Block, np.ndarray, np.ndarray], pa.Table],
    schema: str,
) -> DataFrame:
    """`task(block, i, j)` for the candidates of each pair of blocks, as rows of one block of series."""
    max_lag, empty = config.max_lag, _arrow_schema(schema).empty_table()

    def run(wanted: pa.Table, members: pa.Table) -> pa.Table:
        if not wanted.num_rows or not members.num_rows:
            return empty
        block = _Block(members, *_time_axis(members, max_lag))
        i, j = _rows_of(block, *[wanted[c].to_numpy() for c in ("city_id", "other_city_id")])
        return task(block, i, j) if len(i) else empty

    placed, members = _candidate_blocks(anomaly, pairs)
    wanted, series = placed.groupBy("block_lo", "block_hi"), members.groupBy("of_lo", "of_hi")
    return wanted.cogroup(series).applyInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))])


def _per_block_pair(
    anomaly: DataFrame,
    config: ClimateConfig,
    task: Callable[[_Block, _Block, bool], pa.Table],
    schema: str,
) -> DataFrame:
    """`task(a, b, same)` for every pair of tiles of every pair of blocks, given out one by one."""

    def tiles(low: _Block, high: _Block | None) -> Iterator[pa.Table]:
        a_side = low.tiles(TILE)
        if high is None:
            met = ((a, b, a is b) for k, a in enumerate(a_side) for b in a_side[k:])
        else:
            b_side = high.tiles(TILE)
            met = ((a, b, False) for a in a_side for b in b_side)
        return (task(*pair) for pair in met)

    return _of_fleet(anomaly, config, tiles, schema)


def _of_fleet(
    anomaly: DataFrame, config: ClimateConfig, task: Callable[[_Block, _Block | None], Iterator[pa.Table]], schema: str
) -> DataFrame:
    """`of_block_pairs` in as many blocks as all pairs of the fleet take."""
    n_cities = anomaly.where(F.col("city_id").isNotNull()).agg(F.count_distinct("city_id")).first()[0]
    return of_block_pairs(anomaly, config, n_cities, blocks_for(n_cities, config.block_size, PAIR_BLOCKS), task, schema)


def of_block_pairs(
    anomaly: DataFrame,
    config: ClimateConfig,
    n_cities: int,
    n_blocks: int,
    task: Callable[[_Block, _Block | None], Iterator[pa.Table]],
    schema: str,
) -> DataFrame:
    """The tables of `task(low, high)` for every pair of blocks, given out one by one; `high` is None for a block with itself."""
    max_lag, kind = config.max_lag, _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = unpacked(pa.Table.from_batches(batches))
        lo, hi = table["block_lo"][0], table["block_hi"][0]
        axis = _time_axis(table, max_lag)
        low, high = (
            _Block(table.filter(pc.equal(table["block"], x)), *axis) if side == 0 or lo != hi else None
            for side, x in enumerate((lo, hi))
        )
        del table
        for part in task(low, high):
            yield from part.cast(kind).combine_chunks().to_batches()

    blocks = _block_pairs(anomaly, n_blocks)
    blocks = blocks.repartition(config.pair_partitions or tasks_for(n_cities, n_blocks), "block_lo", "block_hi")
    return blocks.groupBy("block_lo", "block_hi").applyInArrow(run, schema)


def pair_correlations(
    anomaly: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    pairs: DataFrame | None = None,
    as_of: tuple[int, int] | None = None,
) -> DataFrame:
    """Pearson correlation of same-month anomalies for every pair of cities, smaller id first.

    `pairs` (city_id, other_city_id, either order) restricts the result, and the work, to these
    candidates. `as_of` (year, month) leaves later months out.

    `n_observations` counts shared months, also those with a missing value; the correlation
    uses complete pairs only and is NULL where it is undefined.
    """

    def task(a: _Block, b: _Block, same: bool) -> pa.Table:
        i, j, n, r = _correlate(a, b, 0)
        first = a.id_values[i] < b.id_values[j]
        parts = [_pair_columns(a, b, i[first], j[first], n[first], r[first])]
        if not same:
            back = a.id_values[i] > b.id_values[j]
            parts.append(_pair_columns(b, a, j[back], i[back], n[back], r[back]))
        names = ["city_id_1", "city_name_1", "city_id_2", "city_name_2",
                 "n_observations", "anomaly_correlation"]
        return pa.concat_tables([pa.table(p, names=names) for p in parts])

    def among(block: _Block, i: np.ndarray, j: np.ndarray) -> pa.Table:
        rows, r = _moments_of(block, i, j, 0)
        met = rows > 0
        columns = _pair_columns(block, block, i[met], j[met], rows[met], r[met])
        return pa.Table.from_arrays(columns, schema=_arrow_schema(PAIR_SCHEMA))

    anomaly = _until(anomaly, as_of)
    if pairs is None:
        return _per_block_pair(anomaly, config, task, PAIR_SCHEMA)
    return _per_candidate(anomaly, config, pairs, among, PAIR_SCHEMA)


def lag_correlations(
    anomaly: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    pairs: DataFrame | None = None,
    as_of: tuple[int, int] | None = None,
) -> DataFrame:
    """Pearson correlation per ordered city pair and lag; lag = other month - own month.

    `pairs` and `as_of` as in `pair_correlations`; each candidate comes in both orders.
    """
    max_lag = config.max_lag

    def task(a: _Block, b: _Block, same: bool) -> pa.Table:
        names = ["city_id", "city_name", "other_city_id", "other_city_name",
                 "lag_months", "n_observations", "anomaly_correlation"]
        parts = []

        def keep(x: _Block, y: _Block, i, j, lag: int, n, r) -> None:
            columns = _pair_columns(x, y, i, j, n, r)
            columns.insert(4, pa.array(np.full(len(i), lag, dtype=np.int64)))
            parts.append(pa.table(columns, names=names))

        for lag in range(-max_lag, max_lag + 1):
            i, j, n, r = _correlate(a, b, lag)
            other = a.id_values[i] != b.id_values[j]
            i, j, n, r = i[other], j[other], n[other], r[other]
            keep(a, b, i, j, lag, n, r)
            if not same:
                keep(b, a, j, i, -lag, n, r)
        return pa.concat_tables(parts)

    def among(block: _Block, i: np.ndarray, j: np.ndarray) -> pa.Table:
        parts = []
        for lag in range(-max_lag, max_lag + 1):
            rows, r = _moments_of(block, i, j, lag)
            met = rows > 0
            for own, other, sign in ((i, j, 1), (j, i, -1)):
                columns = _pair_columns(block, block, own[met], other[met], rows[met], r[met])
                columns.insert(4, pa.array(np.full(int(met.sum()), sign * lag, dtype=np.int64)))
                parts.append(pa.Table.from_arrays(columns, schema=_arrow_schema(LAG_SCHEMA)))
        return pa.concat_tables(parts)

    anomaly = _until(anomaly, as_of)
    if pairs is None:
        return _per_block_pair(anomaly, config, task, LAG_SCHEMA)
    return _per_candidate(anomaly, config, pairs, among, LAG_SCHEMA)


def best_lag(lags: DataFrame) -> DataFrame:
    """Strongest lagged correlation per city and its lag.

    Ties (to nine decimals) go to the lag nearest zero, then to the negative one. The ordering
    key is one long, so the aggregate is a hash aggregate with map-side combine.
    """
    strength = F.abs("anomaly_correlation")
    return _strongest(
        lags.select(
            "city_id",
            strength.alias("strength"),
            F.round(strength * 1e9).cast("long").alias("strength_9"),
            "lag_months",
        )
    )


def strongest_links(
    anomaly: DataFrame,
    config: ClimateConfig = ClimateConfig(),
    pairs: DataFrame | None = None,
    as_of: tuple[int, int] | None = None,
) -> DataFrame:
    """`best_lag(lag_correlations(anomaly))` without ever writing out the pairs.

    Each pair of blocks emits one candidate per city rather than one row per pair, and computes a pair
    once for both of its cities. Use it when only the feature table is wanted.
    """
    if pairs is not None:  # the candidates bound what is written out
        return best_lag(lag_correlations(anomaly, config, pairs, as_of))
    anomaly = _until(anomaly, as_of)
    max_lag = config.max_lag

    def task(low: _Block, high: _Block | None) -> Iterator[pa.Table]:
        for best, tile in strongest_of(low, high, max_lag):
            yield pa.Table.from_arrays(best.columns(tile), schema=_arrow_schema(LINK_SCHEMA))

    return _strongest(_of_fleet(anomaly, config, task, LINK_SCHEMA))


def _strongest(candidates: DataFrame) -> DataFrame:
    lag = F.col("lag_months")
    preference = F.abs(lag) * 2 + F.when(lag > 0, 1).otherwise(0)
    order = F.shiftleft(F.col("strength_9"), 22) - preference
    return candidates.groupBy("city_id").agg(
        F.max("strength").alias("max_lagged_corr"),
        F.max_by("lag_months", F.when(F.col("strength").isNotNull(), order)).alias(
            "lead_lag_months"
        ),
    )


# --------------------------------------------------------------------------------------
# Task side: one pair of blocks
# --------------------------------------------------------------------------------------

def _time_axis(table: pa.Table, max_lag: int) -> tuple[np.ndarray, np.ndarray]:
    """The months that occur, and their places on the grid.

    A gap longer than any lag shrinks to one that no lag can bridge, so that one stray date
    does not stretch the grid over centuries.
    """
    points = table["series"].combine_chunks().flatten()
    months = np.unique(pc.struct_field(points, "t").to_numpy(zero_copy_only=False))
    steps = np.minimum(np.diff(months, prepend=months[:1]), max_lag + 1)
    return months, np.cumsum(steps)


class _Block:
    """Cities of one block on a dense (city x month) grid of counts, sums and squares."""

    def __init__(self, table: pa.Table, months: np.ndarray, places: np.ndarray):
        self.ids = table["city_id"].combine_chunks()
        self.names = table["city_name"].combine_chunks()
        self.id_values = self.ids.to_numpy(zero_copy_only=False)
        series = table["series"].combine_chunks()
        lengths = pc.fill_null(pc.list_value_length(series), 0).to_numpy(zero_copy_only=False)
        points = series.flatten()
        month = pc.struct_field(points, "t").to_numpy(zero_copy_only=False)
        value = pc.struct_field(points, "x").to_numpy(zero_copy_only=False).astype(float)
        n_months = int(places[-1]) + 1
        place = places[np.searchsorted(months, month)]
        cell = np.repeat(np.arange(table.num_rows), lengths) * n_months + place
        known = ~np.isnan(value)
        shape, size = (table.num_rows, n_months), table.num_rows * n_months

        def grid(where, weights=None):
            return np.bincount(where, weights, size).reshape(shape).astype(float)

        self.rows = grid(cell)
        self.count = grid(cell[known])
        # Centre each series: correlation is unchanged and the sums lose no digits.
        level = grid(cell[known], value[known]).sum(axis=1) / np.maximum(self.count.sum(axis=1), 1)
        centred = value[known] - level[cell[known] // n_months]
        plain = np.bincount(cell[known] // n_months, value[known] ** 2, table.num_rows)
        self.total = grid(cell[known], centred)
        self.square = grid(cell[known], centred * centred)
        size = self.square.sum(axis=1)
        self.varied = np.isfinite(size) & (size > CONSTANT_TOLERANCE * plain)
        self.months = np.bincount(places, minlength=n_months).astype(float)
        self.whole = False

    @classmethod
    def of(cls, ids: pa.Array, names: pa.Array, grids: list[np.ndarray], months: np.ndarray) -> _Block:
        """A block of grids of rows, counts, sums and squares that are there already."""
        block = object.__new__(cls)
        block.ids, block.names, block.id_values = ids, names, ids.to_numpy(zero_copy_only=False)
        block.rows, block.count, block.total, block.square = grids
        block.varied, block.months, block.whole = np.ones(len(ids), bool), months, False
        return block

    def _some(self, rows: np.ndarray, whole: bool) -> _Block:
        part = object.__new__(_Block)
        at = pa.array(rows)
        part.ids, part.names, part.id_values = self.ids.take(at), self.names.take(at), self.id_values[rows]
        part.rows, part.count, part.total, part.square = (
            grid[rows] for grid in (self.rows, self.count, self.total, self.square)
        )
        part.varied, part.months, part.whole = self.varied[rows], self.months, whole
        return part

    def tiles(self, size: int) -> list[_Block]:
        """The cities in tiles of about `size`; many with one value in each of the same months, and all without gaps, have tiles of their own.

        The others come last, in the order of their months, so that few different ones share a tile.
        """
        single = ((self.rows == self.count) & (self.rows <= 1)).all(axis=1)
        shown = np.concatenate([np.packbits(self.rows > 0, axis=1), ~single[:, None]], axis=1)
        _, kind, many = np.unique(shown, axis=0, return_inverse=True, return_counts=True)
        kind = kind.ravel()
        alike = single & ((many[kind] >= min(LEAST_ALIKE, size)) | (self.rows == self.months).all(axis=1))
        sides = [np.flatnonzero(alike & (kind == k)) for k in np.unique(kind[alike])]
        others = np.flatnonzero(~alike)
        sides.append(others[np.argsort(kind[others], kind="stable")])
        return [self.tile(rows) for side in sides if len(side) for rows in np.array_split(side, max(1, round(len(side) / size)))]

    def tile(self, rows: np.ndarray) -> _Block:
        """Some of the cities; whole if all have one value in each of the same months, which are then the tile's months."""
        part = self._some(rows, False)
        part.whole = bool(((part.rows == part.rows[:1]) & (part.count == part.rows) & (part.rows <= 1)).all())
        if part.whole:
            part.months = part.rows[0]
        return part


def _windows(width: int, lag: int) -> tuple[slice, slice]:
    """The places of the months that meet `lag` months apart, on the own side and on the other one."""
    return slice(max(0, -lag), width - max(0, lag)), slice(max(0, lag), width + min(0, lag))


def _moments(a: _Block, b: _Block, lag: int):
    width = a.rows.shape[1]
    if abs(lag) >= width:
        empty = np.zeros((a.rows.shape[0], b.rows.shape[0]))
        return empty, np.full_like(empty, np.nan)
    own, far = _windows(width, lag)

    if a.whole and b.whole:
        met = a.months[own] * b.months[far]
        rows = np.full((a.rows.shape[0], b.rows.shape[0]), met.sum())
        r = _units(a, own, met) @ _units(b, far, met).T
        return rows, np.clip(r, -1.0, 1.0, out=r)

    def product(x, y):
        return x[:, own] @ y[:, far].T

    return product(a.rows, b.rows), correlation(*_sums(a, b, product))


def _units(block: _Block, cut: slice, met: np.ndarray) -> np.ndarray:
    """Deviations from the mean of the months in `met`, of length 1; NaN for a constant series or one month.

    Cities that have the same months as all of their tile share theirs with any city of another such tile, so
    their sums belong to the city instead of the pair, and the product of two of these rows is the correlation.
    """
    n = met.sum()
    total = block.total[:, cut] * met
    with np.errstate(divide="ignore", invalid="ignore"):
        mean = total.sum(axis=1) / n
        square = (block.square[:, cut] * met).sum(axis=1)
        spread = square - mean * mean * n
        defined = (n > 1) & (spread > CONSTANT_TOLERANCE * square)
        scale = np.where(defined, 1 / np.sqrt(spread), np.nan)
        return (total - mean[:, None] * met) * scale[:, None]


def _sums(a: _Block, b: _Block, product) -> tuple[np.ndarray, ...]:
    """Shared values, sums and squares of both sides, and the sum of products."""
    return (
        product(a.count, b.count),
        product(a.total, b.count),
        product(a.count, b.total),
        product(a.square, b.count),
        product(a.count, b.square),
        product(a.total, b.total),
    )


def correlation(n, sum_a, sum_b, square_a, square_b, both) -> np.ndarray:
    """Pearson's r from sums over complete pairs; NaN where fewer than two or a constant side."""
    with np.errstate(divide="ignore", invalid="ignore"):
        spread_a = square_a - sum_a * sum_a / n
        spread_b = square_b - sum_b * sum_b / n
        r = (both - sum_a * sum_b / n) / np.sqrt(spread_a * spread_b)
    defined = (
        (n > 1)
        & (spread_a > CONSTANT_TOLERANCE * square_a)
        & (spread_b > CONSTANT_TOLERANCE * square_b)
    )
    return np.where(defined, np.clip(r, -1.0, 1.0), np.nan)


def _rows_of(block: _Block, first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the block for pairs of ids; an id with several names has several rows, an unknown one none."""
    order = np.argsort(block.id_values, kind="stable")
    ids = block.id_values[order]
    (low, high), (other_low, other_high) = (
        [np.searchsorted(ids, wanted, side) for side in ("left", "right")] for wanted in (first, second)
    )
    width = other_high - other_low
    each = (high - low) * width
    k = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    width = np.repeat(np.maximum(width, 1), each)
    return order[np.repeat(low, each) + k // width], order[np.repeat(other_low, each) + k % width]


def _moments_of(block: _Block, i: np.ndarray, j: np.ndarray, lag: int, other: _Block | None = None):
    """`_moments` for the pairs (i, j) of rows alone, j in `other` if given, in steps of bounded size."""
    width, other = block.rows.shape[1], block if other is None else other
    rows, r = np.zeros(len(i), np.int64), np.full(len(i), np.nan)
    if abs(lag) >= width:
        return rows, r
    own, far = _windows(width, lag)
    step = max(1, GATHERED_CELLS // width)
    for begin in range(0, len(i), step):
        part = slice(begin, begin + step)

        def product(x, y):
            return np.einsum("nt,nt->n", x[i[part], own], y[j[part], far])

        rows[part] = np.rint(product(block.rows, other.rows))
        r[part] = correlation(*_sums(block, other, product))
    return rows, r


def _correlate(a: _Block, b: _Block, lag: int):
    """Index pairs that share at least one month, with their row count and correlation."""
    rows, r = _moments(a, b, lag)
    i, j = np.nonzero(rows > 0)
    return i, j, np.rint(rows[i, j]).astype(np.int64), r[i, j]


def _pair_columns(a: _Block, b: _Block, i, j, n, r) -> list[pa.Array]:
    i, j = pa.array(i), pa.array(j)
    return [
        a.ids.take(i),
        a.names.take(i),
        b.ids.take(j),
        b.names.take(j),
        pa.array(n),
        pa.array(r, from_pandas=True),
    ]


class _Strongest:
    """The best link so far of each city of one tile; a later lag wins only if it comes first in tie order."""

    def __init__(self, size: int):
        self.linked = np.zeros(size, dtype=bool)
        self.strength = np.full(size, -1.0)
        self.rounded = np.full(size, -1, dtype=np.int64)
        self.lag = np.zeros(size, dtype=np.int64)
        self.found = np.full(size, -1.0)
        self.top_lag = np.zeros(size, dtype=np.int64)
        self.place = np.full(size, np.iinfo(np.int64).max)

    def add(self, lag: int, linked: np.ndarray, top: np.ndarray) -> None:
        self.linked |= linked
        place = 2 * abs(lag) + (lag > 0)
        top_9 = np.where(top < 0, -1, np.rint(np.maximum(top, 0) * 1e9)).astype(np.int64)
        better = (top_9 > self.rounded) | ((top_9 == self.rounded) & (place < self.place))
        self.lag[better], self.rounded[better], self.place[better] = lag, top_9[better], place
        self.found[better] = top[better]
        self.top_lag[top > self.strength] = lag
        self.strength = np.maximum(self.strength, top)

    def columns(self, block: _Block) -> list[pa.Array]:
        keep = np.nonzero(self.linked)[0]
        missing = self.strength[keep] < 0
        return [
            block.ids.take(pa.array(keep)),
            *[pa.array(x[keep], mask=missing) for x in (self.strength, self.rounded, self.lag)],
        ]

    def sizes(self, block: _Block) -> list[pa.Array]:
        """City, lag and size of the link chosen, and of the strongest one where nine decimals do not tell the two apart."""
        keep, more = np.flatnonzero(self.linked), np.flatnonzero(self.linked & (self.strength > self.found))
        size = np.concatenate([self.found[keep], self.strength[more]])
        return [
            block.ids.take(pa.array(np.concatenate([keep, more]))),
            pa.array(np.concatenate([self.lag[keep], self.top_lag[more]])),
            pa.array(size, mask=size < 0),
        ]


class _Short:
    """Standardized series of tiles in single precision, for the lag that is at hand, and room for their products."""

    def __init__(self):
        self.held: dict[tuple, tuple] = {}
        self.kinds: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.room = np.empty(0, np.float32)

    def product(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """`one @ two.T`, which holds until the next product."""
        shape = len(one), len(two)
        if math.prod(shape) > len(self.room):
            self.room = np.empty(math.prod(shape), np.float32)
        return np.matmul(one, two.T, out=self.room[: math.prod(shape)].reshape(shape))

    def _kept(self, key: tuple, made: Callable[[], tuple]) -> tuple:
        if key not in self.held:
            if sum(found[0].nbytes for found in self.held.values()) > MOST_SHORT:
                self.held.clear()
            self.held[key] = made()
        return self.held[key]

    def units(self, tile: _Block, cut: slice, met: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """`_units`, and the rows that have none; these are 0."""

        def made() -> tuple:
            unit = _units(tile, cut, met)
            none = np.flatnonzero(np.isnan(unit).any(axis=1))
            unit[none] = 0
            return unit.astype(np.float32), none

        return self._kept((id(tile), "units", cut.start, met.tobytes()), made)

    def scaled(self, tile: _Block, cut: slice) -> tuple[np.ndarray, np.ndarray]:
        """The values in length 1, as they are, and their length."""

        def made() -> tuple:
            length = np.sqrt(tile.square[:, cut].sum(axis=1))
            length = np.where(length > 0, length, 1.0)
            return (tile.total[:, cut] / length[:, None]).astype(np.float32), length

        return self._kept((id(tile), "scaled", cut.start), made)

    def among(self, tile: _Block, cut: slice, months: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, np.ndarray, np.ndarray]:
        """Deviations in one unit of the values in `months`, any repeats included; rows that have none; the greatest length.

        And the different rows of counts, and which of them each city has.
        """

        def made() -> tuple:
            count, total, square = (grid[:, cut] * months for grid in (tile.count, tile.total, tile.square))
            n, size = count.sum(axis=1), square.sum(axis=1)
            with np.errstate(divide="ignore", invalid="ignore"):
                mean = total.sum(axis=1) / n
                spread = size - mean * mean * n
                defined = (n > 1) & (spread > CONSTANT_TOLERANCE * size)
                unit = (total - mean[:, None] * count) / np.sqrt(spread)[:, None]
            unit[~defined] = 0
            length = float(np.sqrt((unit * unit).sum(axis=1).max(initial=0)))
            if id(tile) not in self.kinds:
                self.kinds[id(tile)] = np.unique(tile.count, axis=0, return_inverse=True)
            kinds, kind = self.kinds[id(tile)]
            return unit.astype(np.float32), np.flatnonzero(~defined), length, kinds[:, cut] * months, kind.ravel()

        return self._kept((id(tile), "among", cut.start, months.tobytes()), made)


def _sizes(a: _Block, b: _Block, lag: int, short: _Short) -> tuple[np.ndarray | None, float, np.ndarray]:
    """Sizes of the correlations of all pairs, -1 where there is none, and their greatest error; and who shares a month.

    The sizes of tiles of which one is whole are taken in single precision from one product; None if no pair has one.
    """
    width = a.rows.shape[1]
    nobody = np.zeros((1, 1), bool)
    if abs(lag) >= width:
        return None, 0.0, nobody
    own, far = _windows(width, lag)
    if a.whole and b.whole:
        met = a.months[own] * b.months[far]
        n = met.sum()
        if n < 2:
            return None, 0.0, nobody | (n > 0)
        (one, none_one), (two, none_two) = short.units(a, own, met), short.units(b, far, met)
        size = short.product(one, two)
        np.abs(size, out=size)
        size[none_one] = -1
        size[:, none_two] = -1
        return size, (width + 4) * SHORT, ~nobody
    if b.whole:
        size, error, shared = _sizes(b, a, -lag, short)
        return None if size is None else size.T, error, shared.T
    if a.whole:
        months = a.months[own]
        shared = (b.rows[:, far] @ months > 0)[None, :]
        (two, none, length, kinds, kind), (one, own_length) = short.among(b, far, months), short.scaled(a, own)
        n = kinds.sum(axis=1)
        with np.errstate(divide="ignore", invalid="ignore"):
            total, square = a.total[:, own] @ kinds.T, a.square[:, own] @ kinds.T
            spread = square - total * total / n
            scale = np.where((n > 1) & (spread > CONSTANT_TOLERANCE * square), own_length[:, None] / np.sqrt(spread), np.nan)
        error = (width + 8) * SHORT * length * np.nanmax(scale, initial=1.0)
        if error < MOST_ERROR and np.isfinite(own_length).all():
            size = short.product(one, two)
            known = np.isfinite(scale)
            size *= np.where(known, scale, 0).astype(np.float32)[:, kind]  # 0 is seen to be undefined in full precision
            np.abs(size, out=size)
            size[~known.any(axis=1)] = -1
            size[:, none] = -1
            return size, error, shared
    rows, r = _moments(a, b, lag)
    np.abs(r, out=r)
    r[np.isnan(r)] = -1
    return r, NEAR, rows > 0


def strongest_of(low: _Block, high: _Block | None, max_lag: int) -> Iterator[tuple[_Strongest, _Block]]:
    """The tiles of two blocks with the best link of each city to the other block, or to its own if `high` is None.

    All pairs of tiles are multiplied, in single precision first. A pair that is weaker by more than the
    error than another one of the same city, at this lag or before, is not its strongest; the others are computed in full.
    """
    a_side, b_side = (
        [(_Strongest(len(tile.id_values)), tile) for tile in block.tiles(TILE)] if block is not None else None for block in (low, high)
    )
    common: dict[tuple, np.ndarray | None] = {}
    short = _Short()
    for lag in sorted(range(-max_lag, max_lag + 1), key=abs):
        short.held.clear()
        for k, (one, a) in enumerate(a_side):
            for m, (two, b) in enumerate(a_side[k:] if b_side is None else b_side):
                if (k, m) not in common:
                    met = np.isin(a.id_values, b.id_values).any()
                    common[k, m] = a.id_values[:, None] == b.id_values[None, :] if met else None
                _strongest_of_tiles((one, a), (two, b), lag, common[k, m], short)
    yield from a_side
    yield from b_side or []


def _strongest_of_tiles(
    one_side: tuple[_Strongest, _Block], two_side: tuple[_Strongest, _Block], lag: int, own: np.ndarray | None, short: _Short
) -> None:
    """Takes the links of two tiles at one lag, from both sides unless they are the same; `own` marks pairs of one id."""
    (one, a), (two, b) = one_side, two_side
    size, error, shared = _sizes(a, b, lag, short)
    if own is not None:
        shared = shared & ~own
        if size is not None:
            size[own] = -1
    sides = ((one, 1, lag), (two, 0, -lag))[: 1 if one is two else 2]
    for best, axis, _ in sides:
        best.linked |= shared.any(axis=axis)
    if size is None:
        return
    found = []
    for best, axis, _ in sides:
        top = size.max(axis=axis, initial=-1).astype(float)
        some = np.flatnonzero((top >= 0) & (top >= best.strength - NEAR - error))
        least = np.maximum(np.maximum(top - 2 * error, best.strength - NEAR - error), 0)[some]
        at, other = np.nonzero((size if axis else size.T)[some] >= least[:, None])
        found.append((some[at], other) if axis else (other, some[at]))
    if sum(len(i) for i, _ in found) > MOST_NEAR * size.size:
        r = np.abs(_moments(a, b, lag)[1])
        r[np.isnan(r)] = -1
        if own is not None:
            r[own] = -1
        for best, axis, at_lag in sides:
            best.add(at_lag, best.linked, r.max(axis=axis, initial=-1))
        return
    i, j = (np.concatenate(ends) for ends in zip(*found))
    if not len(i):
        return
    r = np.abs(_moments_of(a, i, j, lag, b)[1])
    parts = np.split(np.where(np.isnan(r), -1, r), [len(found[0][0])])
    for (best, axis, at_lag), (i, j), strength in zip(sides, found, parts):
        top = np.full(len(best.strength), -1.0)
        np.maximum.at(top, i if axis else j, strength)
        best.add(at_lag, best.linked, top)
