"""Locating source columns by alias, whatever the file calls them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def resolve_optional_column(columns: Sequence[str], aliases: Sequence[str]) -> str | None:
    """First alias that is present, ignoring case, spelled as in the data.

    Of two columns that differ only in case the last one is taken.
    """
    spelled = {name.lower(): name for name in columns}
    return next((spelled[a.lower()] for a in aliases if a.lower() in spelled), None)


def resolve_column(columns: Sequence[str], aliases: Sequence[str]) -> str:
    found = resolve_optional_column(columns, aliases)
    if found is None:
        raise KeyError(f"none of {list(aliases)} is among {list(columns)}")
    return found


@dataclass(frozen=True)
class Wanted:
    """One standard output column and where it may come from."""

    name: str
    aliases: Sequence[str]
    required: bool = True
    type: str = "string"
    keep_source_name: bool = False


def _pick(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """Columns addressable by exact spelling, also when two differ only in case."""
    lowered = [c.lower() for c in df.columns]
    if len(set(lowered)) == len(lowered):
        return df, {c: c for c in df.columns}
    safe = [f"_col{i}" for i in range(len(df.columns))]
    return df.toDF(*safe), dict(zip(df.columns, safe))


def project_adaptive(df: DataFrame, wanted: Sequence[Wanted], fill_absent: bool = True) -> DataFrame:
    """Select the wanted columns under their standard names.

    An absent optional column becomes a typed null (``fill_absent``) or is left
    out. An absent required column is a ``KeyError`` before any data is read.
    """
    addressable, spelled = _pick(df)
    selected: list[Column] = []
    for item in wanted:
        if item.required:
            source: str | None = resolve_column(df.columns, item.aliases)
        else:
            source = resolve_optional_column(df.columns, item.aliases)
        if source is not None:
            name = source if item.keep_source_name else item.name
            selected.append(F.col(f"`{spelled[source]}`").alias(name))
        elif fill_absent:
            selected.append(F.lit(None).cast(item.type).alias(item.name))
    return addressable.select(*selected)


def rename_standard(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Source names to standard names; names that are absent are ignored."""
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def column_mapping(
    columns: Sequence[str], wanted: Sequence[Wanted], overrides: Mapping[str, str] | None = None
) -> list[tuple[str, str | None, str]]:
    """(standard name, chosen source column, rule) for every wanted column."""
    rows: list[tuple[str, str | None, str]] = []
    for item in wanted:
        forced = (overrides or {}).get(item.name)
        if forced is not None:
            rows.append((item.name, resolve_column(columns, [forced]), "override"))
            continue
        found = resolve_optional_column(columns, item.aliases)
        rows.append((item.name, found, "absent" if found is None else "alias"))
    return rows


def column_mapping_report(
    df: DataFrame, wanted: Sequence[Wanted], overrides: Mapping[str, str] | None = None
) -> DataFrame:
    """The mapping above with how well each chosen column is filled, in one pass over ``df``."""
    mapping = column_mapping(df.columns, wanted, overrides)
    addressable, spelled = _pick(df)
    counts = [F.count(F.lit(1)).alias("_rows")]
    for position, (_, source, _rule) in enumerate(mapping):
        filled = F.lit(0).cast("long") if source is None else F.count(F.col(f"`{spelled[source]}`"))
        counts.append(filled.alias(f"_filled{position}"))
    entries = [
        F.struct(
            F.lit(name).alias("coluna_padrao"),
            F.lit(source).cast("string").alias("coluna_origem"),
            F.lit(rule).alias("regra"),
            F.col("_rows").alias("registros"),
            F.col(f"_filled{position}").alias("preenchidos"),
        )
        for position, (name, source, rule) in enumerate(mapping)
    ]
    return addressable.agg(*counts).select(F.inline(F.array(*entries)))


def inspect_schema(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table and column: position, type, rows and filled rows. One pass per table."""
    profile: DataFrame | None = None
    for table, df in tables.items():
        safe = df.toDF(*[f"_col{i}" for i in range(len(df.columns))])
        counts = [F.count(F.lit(1)).alias("_rows")] + [F.count(c).alias(c) for c in safe.columns]
        entries = [
            F.struct(
                F.lit(table).alias("tabela"),
                F.lit(position).alias("posicao"),
                F.lit(field.name).alias("coluna"),
                F.lit(field.dataType.simpleString()).alias("tipo"),
                F.col("_rows").alias("registros"),
                F.col(f"_col{position}").alias("preenchidos"),
            )
            for position, field in enumerate(df.schema.fields)
        ]
        rows = safe.agg(*counts).select(F.inline(F.array(*entries)))
        profile = rows if profile is None else profile.unionByName(rows)
    if profile is None:
        raise ValueError("no table given")
    return profile


def conform(df: DataFrame, schema) -> DataFrame:
    """Cast to a declared schema; undeclared columns go, absent ones become null, bad values null."""
    present = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(f"`{present[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in present
             else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def empty_table(spark: SparkSession, schema) -> DataFrame:
    return spark.createDataFrame([], schema)
