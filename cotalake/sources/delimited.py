"""Delimited files: separator sniffing, mixed headers, malformed rows."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cotalake import schemas

LATIN1 = "ISO-8859-1"
BROKEN = "_linha_invalida"
# A separator that no text file holds makes the CSV reader return whole lines.
NO_SEPARATOR = "\x01"


def _quoting(sep: str, encoding: str) -> dict[str, str]:
    return {"sep": sep, "encoding": encoding, "quote": '"', "escape": '"', "maxCharsPerColumn": "-1"}


def _text_columns(names: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _or_null(name: str, texts: Sequence[str] = tuple(schemas.NA_TEXTS)) -> Column:
    value = F.col(f"`{name}`")
    return F.when(~value.isin(list(texts)), value).alias(name)


def scan_delimited(
    spark: SparkSession, path: str | Sequence[str], sep: str = ";", encoding: str = LATIN1,
    names: Sequence[str] | None = None, skip_unreadable: bool = False, file_name_as: str | None = None,
    multiline: bool = False,
) -> DataFrame:
    """All-string scan of files with one common header. No inference pass over the data.

    ``file_name_as`` adds the name of the file each row came from.
    ``multiline`` allows line breaks inside quoted fields, but then a file
    cannot be split and is read by one task; leave it off for large files.
    """
    reader = spark.read.options(
        header=True, multiLine=multiline, ignoreCorruptFiles=skip_unreadable, ignoreMissingFiles=skip_unreadable, **_quoting(sep, encoding)
    )
    if names is not None:
        reader = reader.schema(_text_columns(names))
    scanned = reader.csv(path if isinstance(path, str) else list(path))
    origin = [F.col("_metadata.file_name").alias(file_name_as)] if file_name_as else []
    return scanned.select(*[_or_null(c) for c in scanned.columns], *origin)


def first_lines(spark: SparkSession, path: str | Sequence[str], encoding: str = LATIN1) -> DataFrame:
    """(arquivo, linha): the first line of each file.

    Only the block at offset 0 of a file contributes rows, and each task keeps
    one row per file before the shuffle.
    """
    lines = (
        spark.read.schema("linha string")
        .options(sep=NO_SEPARATOR, quote="", encoding=encoding, maxCharsPerColumn="-1", header=False)
        .csv(path if isinstance(path, str) else list(path))
    )
    return (
        lines.select("linha", F.col("_metadata.file_path").alias("arquivo"), F.col("_metadata.file_block_start").alias("_at"))
        .filter("_at = 0")
        .withColumn("_line", F.monotonically_increasing_id())
        .groupBy("arquivo")
        .agg(F.min_by("linha", "_line").alias("linha"))
    )


def separator_of(line: Column) -> Column:
    """``;`` only if strictly more frequent than ``,``; a tie or a missing line gives ``,``."""
    return F.when(F.regexp_count(line, F.lit(";")) > F.regexp_count(line, F.lit(",")), ";").otherwise(",")


def sniff_separator(spark: SparkSession, path: str | Sequence[str], encoding: str = LATIN1) -> DataFrame:
    """(arquivo, linha, separador) per file."""
    return first_lines(spark, path, encoding).withColumn("separador", separator_of(F.col("linha")))


def header_names(line: str, sep: str) -> list[str]:
    """Column names of a header line; a repeated name gets a numbered suffix.

    Of names that differ in case only, the last keeps its name, as the lookup of columns finds that one, and the others get a suffix.
    """
    names: list[str] = []
    for name in next(csv.reader([line], delimiter=sep)):
        copies = sum(1 for n in names if n == name or n.rsplit(".", 1)[0] == name and n.rsplit(".", 1)[-1].isdigit())
        names.append(f"{name}.{copies}" if copies else name)
    taken = {n.lower() for n in names}
    for place, name in enumerate(names):
        if any(n.lower() == name.lower() for n in names[place + 1 :]):
            number = next(k for k in range(1, len(names) + 1) if f"{name}.{k}".lower() not in taken)
            names[place] = f"{name}.{number}"
            taken.add(names[place].lower())
    return names


def scan_union_by_name(
    spark: SparkSession, path: str | Sequence[str], encoding: str = LATIN1, skip_unreadable: bool = False,
    file_name_as: str | None = None, sep: str | None = None, keep_broken: bool = False,
) -> DataFrame:
    """Files with their own separators (or all with ``sep``) and column orders, appended by column name.

    One reader per distinct header. The driver handles file names only, as any Spark file scan does; no data row passes
    through it. An unreadable file fails the job: Spark can skip it (``skip_unreadable``), but then keeps the rows read
    before the fault and does not say so. ``keep_broken`` adds the raw line of each row with more fields than its header.
    """
    groups: dict[tuple[str, str], list[str]] = {}
    for row in sniff_separator(spark, path, encoding).collect():
        groups.setdefault((row["linha"], sep or row["separador"]), []).append(row["arquivo"])
    if not groups:
        raise FileNotFoundError(f"no readable file under {path}")
    union: DataFrame | None = None
    for (line, own), files in sorted(groups.items()):
        names = header_names(line, own)
        if keep_broken:
            part = scan_tolerant(spark, files, names, own, encoding, file_name_as)
        else:
            part = scan_delimited(spark, files, own, encoding, names, skip_unreadable, file_name_as)
        union = part if union is None else union.unionByName(part, allowMissingColumns=True)
    return union


def _too_many_fields(line: Column, sep: str, count: int) -> Column:
    """More fields than the header. A doubled quote inside a quoted field ends one quoted stretch and begins the next."""
    unquoted = F.regexp_replace(line, '"[^"]*"', "")
    return F.length(unquoted) - F.length(F.replace(unquoted, F.lit(sep), F.lit(""))) + 1 > count


def parse_lines(lines: DataFrame, text: str, names: Sequence[str], sep: str, *keep: str) -> DataFrame:
    """Whole lines to all-string columns; ``keep`` columns pass through.

    ``_linha_invalida`` is the raw line where it has more fields than the header, as in :func:`scan_tolerant`.
    """
    places = [f"_c{i}" for i in range(len(names))]
    fields = F.from_csv(F.col(text), ", ".join(f"{c} string" for c in places), {"sep": sep, "quote": '"', "escape": '"'})
    broken = F.when(_too_many_fields(F.col(text), sep, len(names)), F.col(text)).alias(BROKEN)
    split = lines.select(*keep, fields.alias("_fields"), broken).select(*keep, *[F.col(f"_fields.{c}") for c in places], BROKEN)
    return split.toDF(*keep, *names, BROKEN).select(*keep, *[_or_null(n) for n in names], BROKEN)


def scan_tolerant(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], sep: str = ";", encoding: str = LATIN1,
    file_name_as: str | None = None,
) -> DataFrame:
    """Every row, with the raw line in ``_linha_invalida`` where it has more fields than the header.

    Short rows are padded with nulls and count as good. The permissive reader
    flags both kinds; only flagged lines have their fields counted.
    """
    schema = _text_columns(names).add(BROKEN, T.StringType())
    rows = (
        spark.read.schema(schema)
        .options(
            header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=BROKEN, columnPruning=False, **_quoting(sep, encoding)
        )
        .csv(path if isinstance(path, str) else list(path))
    )
    # Spark refuses plans that read the raw line alone; looking at a data column as well keeps counts possible.
    looked_at = F.coalesce(F.length(F.col(f"`{names[0]}`")), F.lit(0)) >= 0
    broken = F.when(_too_many_fields(F.col(BROKEN), sep, len(names)) & looked_at, F.col(BROKEN)).alias(BROKEN)
    origin = [F.col("_metadata.file_name").alias(file_name_as)] if file_name_as else []
    return rows.select(*[_or_null(c) for c in names], *origin, broken)


def good_rows(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col(BROKEN).isNull()).drop(BROKEN)


def quarantine(scanned: DataFrame) -> DataFrame:
    return scanned.filter(F.col(BROKEN).isNotNull())
