"""Global order without a single-partition sort: dense positions and exact medians."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, functions as F

from hubcat.session import stored

#: Probes on both sides of a rank, as shares of the rows, and the accuracy of the sketch that they are drawn from.
PROBE_STEPS, SKETCH_ACCURACY = (0.0, 0.0005, 0.002, 0.01, 0.05, 0.2), 10_000
#: So few rows left are counted by value.
LAST_ROWS = 10_000

_ID, _PART, _SOURCE = "__id", "__part", "__source"


def popularity_order(score: str = "paper_upvotes", key: str = "paper_id") -> list[Column]:
    """Highest score first, nulls last, ties by key."""
    return [F.col(score).desc_nulls_last(), F.col(key).asc()]


def range_sorted(df: DataFrame, order: list[Column]) -> DataFrame:
    """Globally sorted copy with ``__id`` = partition and row number inside it.

    The sorted rows and their ids are written to the shared folder: positions depend on how
    rows fell into partitions, and a lost executor must not change that. The source partition
    is the last sort key, so that copies of one row can be split over partitions. All columns
    of ``df`` move, so callers pass the narrow ones that they need.
    """
    ranged = (
        df.withColumn(_SOURCE, F.spark_partition_id())
        .repartitionByRange(*order, F.col(_SOURCE))
        .sortWithinPartitions(*order, F.col(_SOURCE))
        .drop(_SOURCE)
    )
    return stored(ranged.withColumn(_ID, F.monotonically_increasing_id()), "sorted")


def _partition_of(c: Column) -> Column:
    return F.shiftright(c, 33).cast("int")


def dense_index(df: DataFrame, order: list[Column], name: str = "position") -> DataFrame:
    """0-based position of every row in the global order; runs a sort and a count at once.

    The one thing that reaches the driver is a row count per partition.
    """
    ranged = range_sorted(df, order)
    sizes = sorted(
        (r[_PART], r["n"])
        for r in ranged.groupBy(_partition_of(F.col(_ID)).alias(_PART))
        .agg(F.count(F.lit(1)).alias("n")).collect()
    )
    before = [0, *accumulate(n for _, n in sizes)]
    offsets = df.sparkSession.createDataFrame(
        [(part, start) for (part, _), start in zip(sizes, before)],
        f"{_PART} int, __before long",
    )
    inside = F.col(_ID).bitwiseAND(F.lit((1 << 33) - 1))
    return (
        ranged.withColumn(_PART, _partition_of(F.col(_ID)))
        .join(F.broadcast(offsets), _PART)
        .select(*(F.col(f"`{c}`") for c in df.columns),
                (F.col("__before") + inside).alias(name))
    )


def _value_at(rows: DataFrame, rank: int, total: int) -> float:
    """The value of a column ``v`` at a 0-based rank.

    A round draws probes from a sketch of the values that are still possible, counts the exact rows below and up to
    each, and keeps what lies between the two probes around the rank: about a thousandth of them. The driver sees one row of
    counts a round, and the last few distinct values.
    """
    above, below, before, left = None, None, 0, total
    while True:
        inside = rows
        if above is not None:
            inside = inside.where(F.col("v") > above)
        if below is not None:
            inside = inside.where(F.col("v") < below)
        if left <= LAST_ROWS:
            for r in sorted(inside.groupBy("v").agg(F.count(F.lit(1)).alias("n")).collect()):
                before += r["n"]
                if before > rank:
                    return r["v"]
        aim = (rank - before + 0.5) / left
        shares = sorted({min(1.0, max(0.0, aim + side * step)) for step in PROBE_STEPS for side in (-1, 1)})
        probes = sorted(set(inside.agg(F.percentile_approx("v", shares, SKETCH_ACCURACY)).first()[0]))
        counts = inside.agg(*(F.count_if(test).alias(f"{name}{i}") for i, p in enumerate(probes)
                              for name, test in (("under", F.col("v") < p), ("upto", F.col("v") <= p)))).first()
        ends = [(above, before)] + [(p, before + counts[f"upto{i}"]) for i, p in enumerate(probes)]
        starts = [(p, before + counts[f"under{i}"]) for i, p in enumerate(probes)] + [(below, before + left)]
        for i, p in enumerate(probes):
            if starts[i][1] <= rank < ends[i + 1][1]:
                return p
        at = next(i for i, (_, n) in enumerate(starts) if rank < n)
        (above, before), (below, upto) = ends[at], starts[at]
        left = upto - before


def exact_median(df: DataFrame, column: str) -> float | None:
    """Exact median of a numeric column; null when it has no value. Nothing is sorted or moved: values are counted."""
    value = F.col(column).cast("double")
    rows = df.where(F.col(column).isNotNull() & ~F.isnan(value)).select(value.alias("v"))
    total = rows.count()
    if not total:
        return None
    low = _value_at(rows, (total - 1) // 2, total)
    if total % 2:
        return low
    upto = rows.agg(F.count_if(F.col("v") <= low).alias("n"), F.min(F.when(F.col("v") > low, F.col("v"))).alias("next")).first()
    return low if upto["n"] > total // 2 else (low + upto["next"]) / 2
