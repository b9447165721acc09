"""Ranks and exact quantiles of groups of any size, without a group in one task.

Equal values of a group are one row with their number, so ties cannot pile up. The distinct values are dealt by range; what stands
before a range comes from sums per range, of which a group has no more than there are partitions, and what stands before a
value within its range from a window over that range.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotalake.session import stored


def positions(df: DataFrame, group: str, value: str, descending: bool = False) -> DataFrame:
    """(group, value, ``_n``, ``_before``): distinct values, their number, and how many values of the group stand before them."""
    counts = df.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    order = F.desc(value) if descending else F.asc(value)
    ranges = stored(counts.repartitionByRange(group, order).withColumn("_range", F.spark_partition_id()), "value_ranges")
    earlier = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy(group, "_range").agg(F.sum("_n").alias("_here"))
    sums = sums.withColumn("_far", F.coalesce(F.sum("_here").over(earlier), F.lit(0))).drop("_here")
    sums = sums.withColumnsRenamed({group: "_group", "_range": "_own"})
    joined = ranges.join(sums, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_range") == F.col("_own")))
    within = Window.partitionBy(group, "_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_far") + F.coalesce(F.sum("_n").over(within), F.lit(0))
    return joined.withColumn("_before", before).select(group, value, "_n", "_before")


def ranked(df: DataFrame, group: str, value: str, out: str) -> DataFrame:
    """Adds the rank of each row's value within its group, largest first; equal values have equal ranks."""
    ranks = positions(df, group, value, descending=True).select(
        F.col(group).alias("_group"), F.col(value).alias("_value"), (F.col("_before") + 1).cast("int").alias(out)
    )
    return df.join(ranks, F.col(group).eqNullSafe(F.col("_group")) & F.col(value).eqNullSafe(F.col("_value"))).drop("_group", "_value")


def quantiles(df: DataFrame, group: str, value: str, shares: dict[str, float]) -> DataFrame:
    """One row per group: exact quantiles of the values that are not null, interpolated between neighbours."""
    placed = positions(df.filter(F.col(value).isNotNull()), group, value)

    def at(place: Column) -> Column:
        inside = (F.col("_before") <= place) & (place < F.col("_before") + F.col("_n"))
        return F.max(F.when(inside, F.col(value)))

    sizes = placed.groupBy(group).agg(F.sum("_n").alias("_total")).withColumnRenamed(group, "_group")
    joined = placed.join(sizes, F.col(group).eqNullSafe(F.col("_group")))
    place = {name: (F.col("_total") - 1) * F.lit(float(p)) for name, p in shares.items()}
    found: Sequence[Column] = [
        c for name, p in place.items() for c in (at(F.floor(p)).alias(f"_low_{name}"), at(F.ceil(p)).alias(f"_high_{name}"))
    ]
    wide = joined.groupBy(group, "_total").agg(*found)

    def between(name: str) -> Column:
        low, high, p = F.col(f"_low_{name}"), F.col(f"_high_{name}"), place[name]
        return F.when(low == high, low).otherwise((F.ceil(p) - p) * low + (p - F.floor(p)) * high)

    return wide.select(group, *[between(name).alias(name) for name in shares])
