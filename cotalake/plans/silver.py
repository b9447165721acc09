"""Bronze to silver: registries and daily reports."""

from __future__ import annotations

from pyspark.sql import DataFrame

from cotalake.operators import cleaning

REGISTRY_FILTERS = {
    "registro_fundo": cleaning.filter_fund_registry,
    "registro_classe": cleaning.filter_class_registry,
    "registro_subclasse": cleaning.filter_subclass_registry,
}


def clean_registry(raw: DataFrame, kind: str) -> DataFrame:
    return cleaning.clean_filter(raw, REGISTRY_FILTERS[kind])


def clean_daily_report(raw: DataFrame, **coercion) -> DataFrame:
    """Coercion can make rows equal or empty, so the second cleaning counts here.

    One dedupe after coercion gives the rows that two would: rows that were
    equal before it are equal after it. Dropping empty rows once, last, is
    likewise the same.
    """
    return (
        raw.transform(cleaning.trim_text)
        .transform(lambda df: cleaning.coerce_daily_report(df, **coercion))
        .transform(cleaning.distinct_rows)
        .transform(cleaning.drop_all_null)
    )
