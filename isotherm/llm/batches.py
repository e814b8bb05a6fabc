"""What the operators share: Arrow batches cut by bytes, ragged arrays, order ranks, table access."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isotherm.sources.scratch import staged

#: Text bytes that a step inside a task holds at once. One longer text is a step of its own.
STEP_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spare_names(columns: list[str], *wanted: str) -> list[str]:
    """The wanted names, each with as many underscores as set it apart from all `columns`, whatever their case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def pieces(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no piece holds more than `limit` bytes of `column`, unless one row does."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if row > first and held + size > limit:
            yield batch.slice(first, row - first)
            first, held = row, 0
        held += int(size)
    if first < batch.num_rows:
        yield batch.slice(first)


def map_pieces(
    frame: DataFrame,
    column: str,
    step: Callable[[pa.RecordBatch], pa.RecordBatch],
    schema: str,
) -> DataFrame:
    """Run `step` over the batches of a frame, cut by the bytes of `column`. Nothing is shuffled."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch, column):
                yield step(piece)

    return frame.mapInArrow(run, schema)


def offsets_of(lengths: np.ndarray) -> np.ndarray:
    """Start of each run of a ragged array, and the end of the last."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each run; an empty run gives 0."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs `values[start : start + length]`, one after another."""
    ends = np.cumsum(lengths)
    if not len(ends) or not ends[-1]:
        return values[:0]
    at = np.arange(ends[-1], dtype=np.int64)
    at += np.repeat(starts - (ends - lengths), lengths)
    return values[at]


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: spreads integers over all bits."""
    x = values.astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def in_order(frame: DataFrame, order: list[str], totals: list[str], group: str | None = None) -> DataFrame:
    """Add `<name>_before` for each of `totals`: its sum over the earlier rows in `order`.

    `order` is unique, and leads with `group` when sums restart there. Rows are dealt by ranges of
    `order`, so a group that owns a third of the rows spans a third of the partitions. Each range
    adds up in one pass; only one sum for each range and group goes on, and its running total comes
    back by a join. The rows are stored once, which also fixes the ranges for the join.
    """
    spark = frame.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = frame.schema
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    fields += ", _range int" + "".join(f", `{t}_before` double" if dict(frame.dtypes)[t] == "double" else f", `{t}_before` bigint" for t in totals)

    def run(batches):
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        last, held = None, dict.fromkeys(totals, 0)
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            if group is None:
                fresh = np.zeros(n, bool)
            else:
                codes = batch.column(group).dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
                fresh = np.ones(n, bool)
                fresh[1:] = codes[1:] != codes[:-1]
                fresh[0] = (batch.column(group)[0].as_py(),) != last
                last = (batch.column(group)[n - 1].as_py(),)
            starts = np.flatnonzero(fresh)
            new = []
            for t in totals:
                values = batch.column(t).to_numpy(zero_copy_only=False)
                before = np.zeros(n + 1, values.dtype)
                np.cumsum(values, out=before[1:])
                base = np.zeros(n, values.dtype)
                base[: starts[0] if len(starts) else n] = held[t]
                if len(starts):
                    base[starts[0] :] = np.repeat(-before[starts], np.diff(np.append(starts, n)))
                out = before[:-1] + base
                held[t] = out[-1] + values[-1]
                new.append(out)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(np.full(n, part, np.int32)), *map(pa.array, new)],
                names=[*batch.schema.names, "_range", *[f"{t}_before" for t in totals]],
            )

    keys = [F.col(c).asc_nulls_last() for c in order]
    local = staged(
        frame.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).mapInArrow(run, fields),
        "ranges",
    )
    by = ["_range"] if group is None else ["_range", group]
    from pyspark.sql import Window

    earlier = Window.orderBy("_range") if group is None else Window.partitionBy(group).orderBy("_range")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    # one row for each range and group: bounded by the number of partitions and of groups
    offsets = local.groupBy(*by).agg(*[F.sum(t).alias(t) for t in totals])
    offsets = offsets.select(
        *[F.col(c).alias(f"_o{c}") for c in by],
        *[F.coalesce(F.sum(t).over(earlier), F.lit(0)).alias(f"_off_{t}") for t in totals],
    )
    match = F.lit(True)
    for c in by:
        match = match & F.col(c).eqNullSafe(F.col(f"_o{c}"))
    joined = local.join(offsets, match)
    return joined.select(
        *frame.columns,
        *[(F.col(f"{t}_before") + F.col(f"_off_{t}")).alias(f"{t}_before") for t in totals],
    )
