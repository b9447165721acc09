"""Day-over-day change within a fund, padded over gaps.

Two forms with the same result:

* :func:`padded_change` - one window per key. For input that holds at most one
  row per key and day, so that a key's group is bounded by the calendar.
* :func:`padded_change_split` - for raw reports, where one fund may hold any
  share of the rows. The input is read twice: to count rows per fund, and to
  order them. Funds of up to ``max_rows`` rows are a window group each. A larger
  fund is cut into ordered chunks - runs of days, and slices of a large day -
  and the last known value before a chunk is carried into it, by a scan over
  days and a scan of two levels over a day's slices.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotalake.functions.numbers import ratio_change
from cotalake.session import stored

MAX_CHUNK_ROWS = 1_000_000
BEFORE_ALL = -(1 << 62)
#: Slices of a day that the upper level of the scan takes as one.
SCAN_BLOCK = 1024


def _change(df: DataFrame, window, values: Mapping[str, str], scale: float, repeated: bool = False) -> DataFrame:
    """Window columns first, arithmetic after: each window function is evaluated once.

    ``repeated`` adds the change of a further copy of the row, from the row's value to itself.
    """
    upto = window.rowsBetween(Window.unboundedPreceding, 0)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    found = {}
    for value in values:
        found[f"_now_{value}"] = F.last(value, ignorenulls=True).over(upto)
        found[f"_was_{value}"] = F.last(value, ignorenulls=True).over(before)
    changes = {out: ratio_change(F.col(f"_now_{v}"), F.col(f"_was_{v}"), scale) for v, out in values.items()}
    if repeated:
        changes |= {f"_again_{out}": ratio_change(F.col(f"_now_{v}"), F.col(f"_now_{v}"), scale) for v, out in values.items()}
    return df.withColumns(found).withColumns(changes).drop(*found)


def padded_change(
    df: DataFrame, key: str, day: str, values: Mapping[str, str], scale: float = 100.0
) -> DataFrame:
    """``values`` maps a value column to its output column. A null takes the last known value."""
    return _change(df, Window.partitionBy(key).orderBy(day), values, scale)


def chunk_order(day: Column, tie: Column) -> Column:
    """Day and tie number as one long: cheap to compare, and usable in a hash aggregate."""
    return F.unix_date(day).cast("long") * F.lit(1 << 32) + tie


def _on(left: DataFrame, right: DataFrame, columns: list[str], how: str) -> DataFrame:
    """A join on equal or both null columns; the right side's are dropped."""
    renamed = right.withColumnsRenamed({c: f"_right_{c}" for c in columns})
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in columns]
    return left.join(renamed, same, how).drop(*[f"_right_{c}" for c in columns])


def chunk_days(df: DataFrame, key: str, day: str, values: Sequence[str] = (), max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """One row per key and day: the chunk it belongs to, its number of slices, and the values known before the day.

    Days of up to half of ``max_rows`` rows are packed in order, without stepping over a larger day. A larger day is cut by
    the leading part of the tie number into as many slices as its rows call for, with room for the spread of a hash.
    ``df`` has ``_order``. All windows are over days, which the calendar bounds.
    """
    half = max(max_rows / 2, 0.5)
    room = max(int(max_rows - 6 * math.sqrt(max_rows)), max_rows // 2, 1)
    last = [F.max_by(v, F.when(F.col(v).isNotNull(), F.col("_order"))).alias(v) for v in values]
    daily = df.groupBy(key, day).agg(F.count(F.lit(1)).alias("_n"), *last)
    upto = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    large = F.col("_n") > half
    marked = daily.withColumn("_large", large).withColumns(
        {
            "_wall": F.count_if("_large").over(upto),
            "_pack": F.floor(F.coalesce(F.sum(F.when(~F.col("_large"), F.col("_n"))).over(before), F.lit(0)) / F.lit(half)),
            **{v: F.last(v, ignorenulls=True).over(before) for v in values},
        }
    )
    run = Window.partitionBy(key, "_large", "_wall", "_pack")
    slices = F.when(F.col("_large"), F.ceil(F.col("_n") / F.lit(room))).otherwise(F.lit(1)).cast("long")
    return marked.withColumn("_chunk_day", F.when(F.col("_large"), F.col(day)).otherwise(F.min(day).over(run))).select(
        key, day, "_n", "_chunk_day", slices.alias("_slices"), *values
    )


def _tagged(df: DataFrame, days: DataFrame, key: str, day: str, tie: str) -> DataFrame:
    tagged = _on(df, days.select(key, day, "_chunk_day", "_slices"), [key, day], "inner")
    return tagged.withColumn("_chunk_slice", F.call_function("shiftright", F.col(tie) * F.col("_slices"), F.lit(32)))


def mark_chunks(df: DataFrame, key: str, day: str, tie: str, max_rows: int = MAX_CHUNK_ROWS) -> DataFrame:
    """Add ``_chunk_day``, ``_chunk_slice`` and ``_order``: no chunk has more than ``max_rows`` rows, but for rows of equal tie numbers."""
    ordered = df.withColumn("_order", chunk_order(F.col(day), F.col(tie)))
    return _tagged(ordered, chunk_days(ordered, key, day, (), max_rows), key, day, tie).drop("_slices")


def _slice_seeds(rows: DataFrame, days: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Values known before each slice of a large day: within its block of slices, before the block, or before the day."""
    group = [key, "_chunk_day"]
    last = lambda order: [F.max_by(v, F.when(F.col(v).isNotNull(), F.col(order))).alias(v) for v in values]
    slices = rows.groupBy(*group, "_chunk_slice").agg(*last("_order")).withColumn("_block", F.floor(F.col("_chunk_slice") / SCAN_BLOCK))
    blocks = slices.groupBy(*group, "_block").agg(*last("_chunk_slice"))
    earlier_block = Window.partitionBy(*group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    earlier_slice = Window.partitionBy(*group, "_block").orderBy("_chunk_slice").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*group, "_block", *[F.last(v, ignorenulls=True).over(earlier_block).alias(f"_far_{v}") for v in values])
    near = slices.select(*group, "_block", "_chunk_slice", *[F.last(v, ignorenulls=True).over(earlier_slice).alias(f"_near_{v}") for v in values])
    known = days.select(*group, *values)
    found = _on(_on(near, blocks, [*group, "_block"], "inner"), known, group, "inner")
    return found.select(*group, "_chunk_slice", *[F.coalesce(f"_near_{v}", f"_far_{v}", v).alias(v) for v in values])


def _split(hot: DataFrame, key: str, day: str, tie: str, values: Mapping[str, str], scale: float, max_rows: int) -> DataFrame:
    """The change of keys with more than ``max_rows`` rows. Equal rows of a large day travel as one, with their number."""
    columns = hot.columns
    days = stored(chunk_days(hot, key, day, list(values), max_rows), "chunk_days")
    first = days.filter((F.col("_slices") == 1) & F.col(day).eqNullSafe(F.col("_chunk_day")))
    seeds = first.select(key, "_chunk_day", F.lit(0).cast("long").alias("_chunk_slice"), *values)
    tagged = _tagged(hot, days, key, day, tie)
    large = days.filter("_slices > 1")
    cut = not large.isEmpty()
    rows = tagged.drop("_slices").withColumn("_copies", F.lit(1).cast("long"))
    if cut:
        places = [*columns, "_chunk_day", "_chunk_slice"]
        distinct = stored(tagged.filter("_slices > 1").groupBy(*places).agg(F.count(F.lit(1)).alias("_copies")), "chunk_rows")
        rows = tagged.filter("_slices = 1").drop("_slices").withColumn("_copies", F.lit(1).cast("long")).unionByName(distinct)
        seeds = seeds.unionByName(_slice_seeds(distinct, large, key, list(values)))
    seeds = seeds.dropna(how="all", subset=list(values)).withColumn("_order", F.lit(BEFORE_ALL).cast("long"))
    window = Window.partitionBy(key, "_chunk_day", "_chunk_slice").orderBy("_order")
    changed = _change(rows.unionByName(seeds, allowMissingColumns=True), window, values, scale, repeated=cut)
    changed = changed.filter(F.col("_order") != BEFORE_ALL)
    if cut:
        changed = _copies(changed, list(values.values()), max_rows)
    return changed.select(*columns, *values.values())


def _copies(changed: DataFrame, outs: Sequence[str], max_rows: int) -> DataFrame:
    """Each row as often as it occurred. More copies than ``max_rows`` are made by several tasks."""
    few, many = changed.filter(F.col("_copies") <= max_rows), changed.filter(F.col("_copies") > max_rows)
    parts = F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / max_rows))
    spread = many.withColumn("_part", F.explode(parts)).repartition("_part", "_order")
    both = few.withColumn("_part", F.lit(0).cast("long")).unionByName(spread)
    begin = F.col("_part") * max_rows + 1
    each = both.withColumn("_copy", F.explode(F.sequence(begin, F.least(F.col("_copies"), begin + max_rows - 1))))
    return each.withColumns({out: F.when(F.col("_copy") == 1, F.col(out)).otherwise(F.col(f"_again_{out}")) for out in outs})


def padded_change_split(
    df: DataFrame,
    key: str,
    day: str,
    tie: str,
    values: Mapping[str, str],
    scale: float = 100.0,
    max_rows: int = MAX_CHUNK_ROWS,
    history: DataFrame | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """The same change for rows of any distribution.

    ``tie`` is a hash in [0, 2^32) that orders rows of one key and day.
    ``history`` may bring the last known values (key, ``_chunk_day``, values)
    of spans of days that ``df`` does not hold; they take part as rows do.
    ``sizes`` (key, ``_n``) may bring the rows per key, history included, where they are known; else the rows are read once more to be counted.
    """
    rows = df.withColumn("_known", F.lit(True))
    if history is not None:
        spans = history.select(key, F.col("_chunk_day").alias(day), F.lit(0).cast("long").alias(tie), *values, F.lit(False).alias("_known"))
        rows = rows.unionByName(spans, allowMissingColumns=True)
    rows = rows.withColumn("_order", chunk_order(F.col(day), F.col(tie)))
    counted = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")) if sizes is None else sizes
    large = stored(counted.filter(F.col("_n") > max_rows).select(key, F.lit(True).alias("_hot")), "large_keys")
    window = Window.partitionBy(key).orderBy("_order")
    if large.isEmpty():
        changed = _change(rows, window, values, scale)
    else:
        marked = _on(rows, large, [key], "left").withColumn("_hot", F.coalesce("_hot", F.lit(False)).cast("int"))
        copy = stored(marked, "split_rows", by="_hot")
        hot = copy.filter("_hot = 1").drop("_hot")
        rest = _change(copy.filter("_hot = 0").drop("_hot"), window, values, scale)
        changed = rest.unionByName(_split(hot, key, day, tie, values, scale, max_rows))
    return changed.filter("_known").drop("_known", "_order")
