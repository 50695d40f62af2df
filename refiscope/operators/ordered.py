"""Ordered aggregates that never put a whole group into one task.

A window ordered over few keys (all scores, four tiers, eight scenarios) would sort
one huge group in a single task. Here equal values are combined first and the rows are
dealt out by ranges of (key, value) of about equal size, whose number follows from the
row count: a heavy key takes many ranges and small ones share one, however far apart
their values lie. Each (key, range) is summed on its own, and the totals of a key's
lower ranges are added; where these are many, they are scanned the same way. The
result is exact; the cuts only decide how evenly the work is spread.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import release, stage

#: Rows of one range.
ROWS = 1 << 18
#: Ranges whose totals one window adds up per key; more are scanned in ranges themselves.
SCANNED = 4096


def _null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def _dealt(combined: DataFrame, keys: Sequence[str], order: str, ranges: int) -> tuple[DataFrame, int]:
    """Rows with ``_range``, the number of their range of (key, value), written so that it stays theirs."""
    n = combined.count()
    parts = max(1, min(ranges, n), math.ceil(n / ROWS))
    if parts == 1:
        return combined.withColumn("_range", F.lit(0)), 1
    dealt = combined.repartitionByRange(parts, *[F.col(k) for k in keys], F.col(order)).withColumn("_range", F.spark_partition_id())
    out = stage(dealt, "ordered-ranges")
    release(combined)
    return out, parts


def running_totals(
    df: DataFrame,
    order: str,
    measures: dict[str, Column],
    keys: Sequence[str] = (),
    ranges: int = 1,
) -> DataFrame:
    """Per distinct (keys, order): each measure ``m``, its inclusive running total
    ``m_cum`` in ascending ``order``, and its key total ``m_all``.

    Rows whose ``order`` is null are left out. ``order`` must be numeric. ``ranges``: at least so many.
    """
    keys, names = list(keys), list(measures)
    combined = (
        df.where(F.col(order).isNotNull())
        .withColumn(order, F.col(order).cast("double"))
        .groupBy(*keys, order)
        .agg(*[F.sum(expr).alias(name) for name, expr in measures.items()])
    )
    dealt, parts = _dealt(stage(combined, "ordered"), keys, order, ranges)
    per_range = dealt.groupBy(*keys, "_range").agg(*[F.sum(n).alias(f"_t_{n}") for n in names])
    if parts > SCANNED:
        scanned = running_totals(per_range.withColumnRenamed("_range", "_place"), "_place", {n: F.col(f"_t_{n}") for n in names}, keys)
        offsets = scanned.withColumn("_range", F.col("_place").cast("int"))
        before = {n: F.col(f"{n}_cum") - F.col(n) for n in names}
        whole = {n: F.col(f"{n}_all") for n in names}
    else:
        offsets = per_range
        in_key = Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))
        lower = in_key.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        before = {n: F.coalesce(F.sum(f"_t_{n}").over(lower), F.lit(0)) for n in names}
        whole = {n: F.sum(f"_t_{n}").over(in_key) for n in names}
    offsets = offsets.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        F.col("_range").alias("_k_range"),
        *[before[n].alias(f"_o_{n}") for n in names],
        *[whole[n].alias(f"{n}_all") for n in names],
    )
    cond = F.col("_range") == F.col("_k_range")
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    within = (
        Window.partitionBy(*keys, "_range")
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    local = dealt.select(*keys, order, "_range", *names, *[F.sum(n).over(within).alias(f"_l_{n}") for n in names])
    return local.join(offsets, cond, "inner").select(
        *keys,
        order,
        *names,
        *[(F.col(f"_l_{n}") + F.col(f"_o_{n}")).alias(f"{n}_cum") for n in names],
        *[f"{n}_all" for n in names],
    )


def exact_median(
    df: DataFrame, value: str, keys: Sequence[str] = (), out: str = "median", ranges: int = 1
) -> DataFrame:
    """Interpolating median per key from running counts of distinct values."""
    keys = list(keys)
    counted = running_totals(df, value, {"n": F.lit(1)}, keys, ranges)
    lower = F.floor((F.col("n_all") + 1) / 2)
    upper = F.floor(F.col("n_all") / 2) + 1
    grouped = counted.groupBy(*keys) if keys else counted.groupBy()
    return grouped.agg(
        (
            (
                F.min(F.when(F.col("n_cum") >= lower, F.col(value)))
                + F.min(F.when(F.col("n_cum") >= upper, F.col(value)))
            )
            / 2.0
        ).alias(out)
    )


def top_per_group(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, rank: str) -> DataFrame:
    """First ``k`` rows per key. Catalyst limits each group before the shuffle
    (WindowGroupLimit), so a hot key sends at most ``k`` rows per map task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep one row per key by an explicit order."""
    return top_per_group(df, keys, order, 1, "_rank").drop("_rank")
