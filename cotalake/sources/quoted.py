"""Delimited files with line breaks inside quoted fields, read by many tasks.

Whether a line break ends a row depends on all quotes before it. Each block of a file counts its
own, in runs of 65,536 lines; the number of quotes before a run, odd or even, then comes from one row per run, and every task knows
where rows begin. Rows of one line stay where they are; only the lines of the others are brought together.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cotalake.functions import text as texts
from cotalake.session import stored
from cotalake.sources import delimited

FILE, BLOCK, PLACE, TEXT = "_arquivo", "_bloco", "_lugar", "_texto"
#: Consecutive lines of a block, 2^16 at most: what a window or a sort has to hold together, however large a block is.
RUN, RUN_BITS = "_trecho", 16


def _lines(spark: SparkSession, path: str | Sequence[str], encoding: str) -> DataFrame:
    """Lines as Spark splits the files, with their block, their run and order in it and the quotes before them in the run."""
    read = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    text = F.col("value") if encoding.upper() == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = read.select(
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(PLACE),
        text.alias(TEXT),
    ).withColumns({"_aspas": _quotes(F.col(TEXT)).cast("bigint"), RUN: F.shiftright(PLACE, RUN_BITS)})
    return lines.mapInPandas(
        _counted, f"{FILE} string, {BLOCK} bigint, {PLACE} bigint, {TEXT} string, _aspas bigint, {RUN} bigint, _antes bigint"
    )


def _counted(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the number of quotes on earlier lines of the run; a task reads its blocks in order, one after the other."""
    at, before = None, 0
    for frame in frames:
        parts = []
        for run, rows in frame.groupby([FILE, BLOCK, RUN], sort=False):
            if run != at:
                at, before = run, 0
            upto = rows["_aspas"].cumsum() + before
            parts.append(rows.assign(_antes=upto - rows["_aspas"]))
            before = int(upto.iloc[-1])
        if parts:
            yield pd.concat(parts)


def _quotes(line: Column) -> Column:
    return F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))


def records(
    spark: SparkSession, path: str | Sequence[str], encoding: str = delimited.LATIN1, header: bool = False
) -> DataFrame:
    """(_arquivo, _bloco, _lugar, _texto): one row per record, its line breaks kept; block and place order a file's records.

    With ``header`` the record that starts on a file's first line with any text is left out.

    Quotes stand around fields, and twice inside them. The files are read once and their lines written, so that all that
    follows sees the same blocks. Lines are not shuffled to be counted, as a task holds its blocks in order; they are joined
    with one row per run, which Spark broadcasts while that is small. A quote that is never closed makes the rest of
    its file one record, as it does for a reader that goes through the file in order.
    """
    lines = stored(_lines(spark, path, encoding), "quoted")
    filled = F.when(~F.col(TEXT).isin("", "\r"), F.struct(BLOCK, PLACE))
    runs = lines.groupBy(FILE, BLOCK, RUN).agg(F.sum("_aspas").alias("_total"), F.min(filled).alias("_cheia"))
    # One row per run from here to the join.
    of_file = Window.partitionBy(FILE).orderBy(BLOCK, RUN).rowsBetween(Window.unboundedPreceding, -1)
    opened = runs.select(
        FILE, BLOCK, RUN, F.coalesce(F.sum("_total").over(of_file), F.lit(0)).alias("_fora"),
        F.min("_cheia").over(Window.partitionBy(FILE)).alias("_cheia"),
    )
    placed = lines.join(opened, [FILE, BLOCK, RUN]).withColumns(
        {
            "_inicio": (F.col("_antes") + F.col("_fora")) % 2 == 0,
            "_titulo": F.lit(header) & F.coalesce(F.struct(BLOCK, PLACE) == F.col("_cheia"), F.lit(False)),
        }
    )
    even = F.col("_aspas") % 2 == 0
    single = placed.filter(F.col("_inicio") & even & ~F.col("_titulo")).select(FILE, BLOCK, PLACE, TEXT)
    # A record of several lines opens with an odd line, goes on over even ones and closes with an odd one.
    parts = stored(placed.filter(~(F.col("_inicio") & even)).select(FILE, BLOCK, RUN, PLACE, TEXT, "_inicio", "_titulo"), "quoted")
    start = F.when(F.col("_inicio"), F.struct(BLOCK, PLACE))
    within = Window.partitionBy(FILE, BLOCK, RUN).orderBy(PLACE).rowsBetween(Window.unboundedPreceding, 0)
    own = parts.withColumn("_registro", F.last(start, ignorenulls=True).over(within))
    last = parts.groupBy(FILE, BLOCK, RUN).agg(F.max(start).alias("_ultimo"))
    carried = last.select(FILE, BLOCK, RUN, F.last("_ultimo", ignorenulls=True).over(of_file).alias("_anterior"))
    joined = own.join(carried, [FILE, BLOCK, RUN]).withColumn("_registro", F.coalesce("_registro", "_anterior"))
    whole = joined.groupBy(FILE, "_registro").agg(
        F.array_sort(F.collect_list(F.struct(BLOCK, PLACE, TEXT))).alias("_linhas"), F.bool_or("_titulo").alias("_titulo")
    )
    several = whole.filter(~F.col("_titulo")).select(
        FILE, F.col(f"_registro.{BLOCK}").alias(BLOCK), F.col(f"_registro.{PLACE}").alias(PLACE),
        F.array_join(F.transform("_linhas", lambda line: line[TEXT]), "\n").alias(TEXT),
    )
    ended = single.unionByName(several)
    return ended.withColumn(TEXT, F.regexp_replace(TEXT, r"\r$", ""))


def scan_quoted(
    spark: SparkSession, path: str | Sequence[str], names: Sequence[str], sep: str = ";",
    encoding: str = delimited.LATIN1, file_name_as: str | None = None,
) -> DataFrame:
    """All-string scan of files with one header, ``names``, whose quoted fields may hold line breaks.

    Equals :func:`delimited.scan_delimited` with ``multiline``, which reads a file by one task, but that breaks inside
    fields stand as in the file, where that one turns CRLF into LF in files whose lines end so. Empty lines between
    records are skipped, records with more fields than the header keep the first ones.
    """
    body = records(spark, path, encoding, header=True).filter(F.col(TEXT) != "")
    origin = "_origem" if file_name_as is None else file_name_as
    named = body.withColumn(origin, texts.last_path_segment(F.col(FILE)))
    fields = delimited.parse_lines(named, TEXT, names, sep, *([origin] if file_name_as else []))
    return fields.drop(delimited.BROKEN).select(*[F.col(f"`{n}`") for n in names], *([origin] if file_name_as else []))
