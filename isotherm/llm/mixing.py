"""Mixing sources to target weights by entropy balancing, rounded into whole copies."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.batches import in_order, spare_names
from isotherm.sources.scratch import cleared, staged

WEIGHTS = (5, 2, 1)
MAX_COPIES = 3

#: Fixed-point digits of a rate, so that running totals are exact in any order.
RATE_BITS = 28

#: Roundings that compete in each half of a source.
OFFSETS = 64

#: A document is heavy if it has more than this part of its source's target.
HEAVY = 0.02

#: The tilt of documents that are not taken at all.
NEVER = -1e18

TOLERANCE = 1e-7
MOST_ROUNDS = 60

WORD = r"[^\x20\x09-\x0D]+"


def sizes_of(documents: DataFrame) -> DataFrame:
    """doc_id, source and the number of words; null text has none."""
    return documents.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint").alias("size")
    )


def targets_of(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES) -> DataFrame:
    """One row per source: number, source, source_size, widest (longest document) and target.

    Sources in code point order, null last, take the weights in turn. A target stops at `most`
    times its source's size; what is over goes to the others by weight until none is above. The
    open sources share by one level per unit of weight, so a round needs two sums.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").alias("source_size"), F.max("size").alias("widest"), F.lit(1).cast("bigint").alias("one")
    )
    weight = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("one_before") % len(weights) + 1).cast("int")
    )
    sources = staged(
        in_order(totals, ["source"], ["one"]).select(
            F.col("one_before").alias("number"), "source", "source_size", "widest", weight.alias("weight")
        ),
        "sources",
    )
    cap = most * F.col("source_size").cast("double")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = 0.0, -1
    while total:
        row = sources.agg(
            F.coalesce(F.sum(F.when(level * F.col("weight") > cap, F.col("source_size"))), F.lit(0)).alias("size"),
            F.sum(F.when(level * F.col("weight") > cap, 0.0).otherwise(F.col("weight"))).alias("weight"),
            F.count(F.when(level * F.col("weight") > cap, 1)).alias("n"),
        ).first()
        if row["n"] == full:
            break
        full, level = row["n"], (total - most * row["size"]) / row["weight"]
    return sources.select(
        "number", "source", "source_size", "widest", F.least(cap, level * F.col("weight")).alias("target")
    )


def _rate(most: int):
    """exp(tilt x size / longest size), at most `most`; a source at its limit has that rate."""
    tilted = F.exp(F.col("tilt") * F.col("size") / F.col("widest"))
    return F.when(F.col("limit"), F.lit(float(most))).otherwise(F.least(F.lit(float(most)), tilted))


def balanced(sizes: DataFrame, targets: DataFrame, most: int = MAX_COPIES) -> DataFrame:
    """The targets with each source's `tilt`, the dual variable of its token constraint.

    `sizes` has the number of each document's source and its size.

    Rates closest in entropy to one copy of each document, under the constraint that the expected
    words of a source are its target, are exponentials of the document's words: the dual is convex,
    with one variable for each source. Newton steps (on the logarithm of the expected words) run on
    the counts of each source and size; a step that leaves the bracket becomes a bisection. One
    aggregate serves all sources in a round, and every round's small table is stored.
    """
    counts = staged(sizes.where("size > 0").groupBy("number", "size").agg(F.count("*").alias("n")), "size_counts")
    full = F.col("target") >= most * F.col("source_size").cast("double") * (1 - 1e-9)
    nothing = F.col("target") <= 0
    state = staged(
        targets.select(
            "*",
            (full & ~nothing).alias("limit"),
            F.when(nothing, NEVER).otherwise(0.0).alias("tilt"),
            F.lit(float("-inf")).alias("low"),
            F.lit(float("inf")).alias("high"),
            F.lit(1.0).alias("error"),
        ),
        "dual",
    )
    rate = _rate(most)
    words = F.col("n") * F.col("size") * rate
    for _ in range(MOST_ROUNDS):
        at = counts.join(state.where(~F.col("limit") & (F.col("tilt") > NEVER)), "number")
        sums = at.groupBy("number").agg(
            F.sum(words).alias("g"),
            F.sum(F.when(rate < most, words * F.col("size") / F.col("widest")).otherwise(0.0)).alias("slope"),
        )
        gap = F.log(F.col("target") / F.col("g"))
        low = F.when(gap > 0, F.greatest("low", "tilt")).otherwise(F.col("low"))
        high = F.when(gap < 0, F.least("high", "tilt")).otherwise(F.col("high"))
        newton = F.col("tilt") + gap * F.col("g") / F.col("slope")
        middle = (
            F.when(F.isnan(F.col("low") + F.col("high")) | (F.col("low") == float("-inf")), F.least(2 * F.col("high"), F.lit(-1.0)))
            .when(F.col("high") == float("inf"), F.greatest(2 * F.col("low"), F.lit(1.0)))
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        inside = (F.col("slope") > 0) & (newton > F.col("low")) & (newton < F.col("high"))
        moved = (
            state.join(sums, "number", "left")
            .withColumns({"low": low, "high": high})
            .withColumn("step", F.when(inside, newton).otherwise(middle))
            .withColumn("error", F.when(F.col("g").isNull(), 0.0).otherwise(F.abs(F.col("g") / F.col("target") - 1)))
        )
        # the tilt is rounded, so that the order of summation does not show
        state = staged(
            moved.withColumn(
                "tilt", F.when(F.col("error") <= TOLERANCE, F.col("tilt")).otherwise(F.round("step", 10))
            ).select(*state.columns),
            "dual",
        )
        if (state.agg(F.max("error")).first()[0] or 0.0) <= TOLERANCE:
            break
    return state


def _with_units(sizes: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Documents with their rate in fixed point, and as a key that puts the largest first."""
    keys = state.select("number", "tilt", "limit", "widest")
    rate = F.when(F.col("size") > 0, F.round(_rate(most) * (1 << RATE_BITS))).otherwise(0.0)
    return sizes.join(keys, "number").withColumns({"units": rate.cast("bigint"), "descending": -F.col("size")})


def _copies(start):
    """Whole numbers that the running total of the rates passes in this row."""
    passed = F.shiftright(F.col("units_before") + F.col("units") + start, RATE_BITS)
    return passed - F.shiftright(F.col("units_before") + start, RATE_BITS)


_STARTS = [(2 * k + 1) * (1 << RATE_BITS) // (2 * OFFSETS) for k in range(OFFSETS)]


def _start_at(place):
    return F.element_at(F.array(*map(F.lit, _STARTS)), place + 1).cast("bigint")


def _taken_by_start():
    return F.array(*[F.sum(_copies(F.lit(s)) * F.col("size")) for s in _STARTS])


def _heavy_copies(heavy: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Copies of the heavy documents: the rounding that leaves the others a target they can meet,
    and of those the one nearest to the expectation."""
    ordered = staged(
        in_order(_with_units(heavy, state, most), ["number", "descending", "doc_id"], ["units"], "number"), "heavy"
    )
    taken = ordered.groupBy("number").agg(
        _taken_by_start().alias("taken"),
        (F.sum(F.col("size") * F.col("units")) / (1 << RATE_BITS)).alias("expected"),
        F.sum("size").alias("own"),
    )
    room = most * (F.col("source_size") - F.col("own"))
    best = F.array_min(
        F.transform(
            "taken",
            lambda t, k: F.struct(
                F.greatest(F.lit(0.0), t - F.col("target"), F.col("target") - t - room).alias("beyond"),
                F.abs(t - F.col("expected")).alias("miss"),
                k.alias("k"),
            ),
        )
    )
    starts = taken.join(state.select("number", "target", "source_size"), "number").select(
        "number", _start_at(best["k"]).alias("start")
    )
    return ordered.join(starts, "number").select("doc_id", "number", "size", _copies(F.col("start")).alias("copies"))


def _light_copies(light: DataFrame, state: DataFrame, most: int) -> DataFrame:
    """Copies of the other documents, rounded in two halves of each source.

    Of all pairs of starting points the one with the smallest miss is used.
    """
    half = 2 * F.col("number") + F.pmod(F.xxhash64("doc_id"), F.lit(2))
    rates = _with_units(light, state, most).withColumn("half", half)
    ordered = staged(in_order(rates, ["half", "descending", "doc_id"], ["units"], "half"), "light")
    taken = ordered.groupBy("number", "half").agg(_taken_by_start().alias("taken"))
    nothing = F.array_repeat(F.lit(0).cast("bigint"), OFFSETS)
    sides = taken.groupBy("number").agg(
        *[
            F.coalesce(F.max(F.when(F.pmod("half", F.lit(2)) == k, F.col("taken"))), nothing).alias(f"side_{k}")
            for k in (0, 1)
        ]
    )
    misses = F.transform(
        "side_0",
        lambda a, i: F.array_min(
            F.transform(
                "side_1",
                lambda b, j: F.struct(F.abs(a + b - F.col("target")).alias("miss"), i.alias("i"), j.alias("j")),
            )
        ),
    )
    chosen = sides.join(state.select("number", "target"), "number").select("number", F.array_min(misses).alias("best"))
    starts = staged(
        chosen.select("number", F.posexplode(F.array("best.i", "best.j")).alias("side", "place")).select(
            (2 * F.col("number") + F.col("side")).alias("half"), _start_at(F.col("place")).alias("start")
        ),
        "starts",
    )
    return ordered.join(starts, "half").select("doc_id", "number", "size", _copies(F.col("start")).alias("copies"))


def mix_sources(
    documents: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES
) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (words, repeats counted) for each row.

    The rates of `balanced` become copies by systematic rounding, largest documents first: copies
    are the whole numbers that the running total of the rates passes, so the words taken miss their
    expectation by less than the longest document, and several starting points compete. Heavy
    documents (more than HEAVY of their source's target) are rounded first; the others are then
    balanced again for what is left of the target. No document has more than `most` copies.

    Null text has no words and takes none. A null source is a source, the last one. A source without
    words has target 0. Null ids and repeated rows are mixed row by row. An empty table gives an
    empty result. Running totals are taken over ranges of rows, so a source with a third of all rows
    spans many tasks; only sums for each source, source and size, or range are aggregated.
    """
    sizes = staged(sizes_of(documents), "sizes")
    targets = staged(targets_of(sizes, weights, most), "targets")
    numbers = targets.select("number", F.col("source").alias("_source"), (HEAVY * F.col("target")).alias("_heavy"))
    numbered = staged(
        sizes.join(numbers, F.col("source").eqNullSafe(F.col("_source"))).select(
            "doc_id", "number", "size", (F.col("size") > F.col("_heavy")).alias("is_heavy")
        ),
        "numbered_sizes",
    )
    heavy = numbered.where("is_heavy").drop("is_heavy")
    light = numbered.where("NOT is_heavy").drop("is_heavy")
    heavy_copies = staged(
        _heavy_copies(heavy, balanced(numbered.drop("is_heavy"), targets, most), most), "heavy_copies"
    )
    used = heavy_copies.groupBy("number").agg(
        F.sum(F.col("copies") * F.col("size")).alias("used"), F.sum("size").alias("own")
    )
    longest = light.groupBy("number").agg(F.max("size").alias("longest"))
    left = staged(
        targets.join(used, "number", "left")
        .join(longest, "number", "left")
        .select(
            "number",
            (F.col("source_size") - F.coalesce("own", F.lit(0))).alias("source_size"),
            F.coalesce("longest", F.lit(0)).alias("widest"),
            F.greatest(F.lit(0.0), F.col("target") - F.coalesce("used", F.lit(0))).alias("target"),
        ),
        "left",
    )
    copies = heavy_copies.unionByName(_light_copies(light, balanced(light, left, most), most))
    return copies.join(targets.select("number", "source_size", "target"), "number").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        F.col("copies").cast("int").alias("copies"),
        (F.col("copies") * F.col("size")).alias("taken"),
    )


def mixed_documents(
    documents: DataFrame, weights: Sequence[float] = WEIGHTS, most: int = MAX_COPIES
) -> DataFrame:
    """Each row of `documents` as often as `mix_sources` takes it, with all its columns.

    Rows without words stay once; column names of any kind pass through. Rows are numbered and stored first, so null and repeated ids are
    mixed like others; the numbers, not the ids, bring the copies back.
    """
    row, times, copy = spare_names(documents.columns, "row_number", "times", "copy")
    numbered = staged(documents.withColumn(row, F.monotonically_increasing_id()), "numbered")
    with cleared(documents.sparkSession):
        mixed = mix_sources(numbered.select(F.col(row).alias("doc_id"), "text", "source"), weights, most)
        taken = mixed.select(
            F.col("doc_id").alias(row), F.when(F.col("size") > 0, F.col("copies")).otherwise(1).alias(times)
        ).where(F.col(times) > 0)
        taken = staged(taken, "taken", lasting=True)
    # most documents are in `taken`, so it grows with them and is no side to broadcast at any size
    met = numbered.join(taken.hint("merge"), row)
    repeated = met.withColumn(copy, F.explode(F.sequence(F.lit(1), times)))
    return repeated.select(*[F.col(f"`{c}`") for c in documents.columns])
