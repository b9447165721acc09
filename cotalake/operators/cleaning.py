"""Trim, dedupe, null handling, coercion and registry rules."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotalake import schemas
from cotalake.functions import dates, numbers, text


def trim_text(df: DataFrame) -> DataFrame:
    """Strip every text column; other types pass through."""
    return df.select(
        *[
            text.strip_blanks(F.col(f"`{f.name}`")).alias(f.name)
            if isinstance(f.dataType, T.StringType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row dedupe, nulls equal. Map-side combine leaves one copy per task before the shuffle."""
    return df.dropDuplicates()


def drop_all_null(df: DataFrame) -> DataFrame:
    return df.na.drop("all")


def drop_critical_nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(columns))


def basic_clean(df: DataFrame) -> DataFrame:
    return df.transform(trim_text).transform(distinct_rows).transform(drop_all_null)


def clean_filter_clean(df: DataFrame, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Clean, apply ``rule``, then clean again.

    The second dedupe matters only when ``rule`` changes values (coercion can
    make rows equal). Filters should use :func:`clean_filter`.
    """
    return df.transform(basic_clean).transform(rule).transform(basic_clean)


def clean_filter(df: DataFrame, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Same rows as clean, filter, clean: a pure row filter commutes with dedupe.

    Filtering first means that only the surviving rows are shuffled, once.
    """
    return df.transform(trim_text).transform(rule).transform(distinct_rows).transform(drop_all_null)


def filter_by_rules(df: DataFrame, rules: Mapping[str, Sequence[str] | None]) -> DataFrame:
    """Keep rows meeting every rule whose column exists; ``None`` asks for a value that is present."""
    tests = [
        F.col(f"`{name}`").isNotNull() if allowed is None else F.col(f"`{name}`").isin(list(allowed))
        for name, allowed in rules.items()
        if name in df.columns
    ]
    return df.filter(reduce(lambda a, b: a & b, tests)) if tests else df


def filter_fund_registry(df: DataFrame) -> DataFrame:
    return filter_by_rules(df, schemas.FUND_RULES)


def filter_class_registry(df: DataFrame) -> DataFrame:
    return filter_by_rules(df, schemas.CLASS_RULES)


def filter_subclass_registry(df: DataFrame) -> DataFrame:
    return filter_by_rules(df, schemas.SUBCLASS_RULES)


def coerce_daily_report(
    df: DataFrame, date_column: str = "DT_COMPTC", numeric: Sequence[str] = tuple(schemas.REPORT_NUMERIC)
) -> DataFrame:
    """Date and number columns that are present get their type; unparsable values become null."""
    changes = {}
    types = dict(df.dtypes)
    if date_column in df.columns:
        source = F.col(f"`{date_column}`")
        changes[date_column] = source.cast("date") if types[date_column] != "string" else dates.parse_report_date(source)
    for name in numeric:
        if name in df.columns:
            source = F.col(f"`{name}`")
            changes[name] = numbers.to_number(source) if types[name] == "string" else source.cast("double")
    return df.withColumns(changes) if changes else df


def distinct_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in the given order.

    ``row_number() = 1`` lets Spark keep one row per key and task before the
    shuffle (WindowGroupLimit), so a hot key sends at most one row per task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_place", F.row_number().over(first)).filter("_place = 1").drop("_place")


def row_counts(df: DataFrame, by: str = "origem") -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("registros"))


def month_counts(df: DataFrame, key: str = "sk_data") -> DataFrame:
    return df.groupBy(dates.month_key(F.col(key)).alias("ano_mes")).agg(F.count(F.lit(1)).alias("registros"))


def union_all_by_name(*tables: DataFrame) -> DataFrame:
    """Append by column name; a column absent from one table is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
