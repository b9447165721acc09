"""Lines of the CSV members of zip archives.

An archive is opened once: its directory is read and the members go on as they are, compressed. They are then dealt out, so that
members of one archive are inflated by as many tasks as they have bytes for, each once and in pieces.
"""

from __future__ import annotations

import bz2
import codecs
import io
import zipfile
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.session import stored
from cotalake.sources import delimited

LINES = "arquivo string, membro string, linha_no bigint, texto string, tipo string, erro string"
MEMBERS = "arquivo string, membro string, metodo int, crc bigint, tamanho bigint, conteudo binary, tipo string, erro string"
BATCH_LINES = 20_000
#: Compressed bytes inflated at a time.
PIECE = 1 << 18

_HEADER, _NAME_AT = 30, 26
_ENCRYPTED = 1


def _frame(rows: list[tuple], schema: str) -> pd.DataFrame:
    columns = [c.split()[0] for c in schema.split(", ")]
    whole = {c.split()[0]: "Int64" for c in schema.split(", ") if c.split()[1] in ("bigint", "int")}
    return pd.DataFrame(rows, columns=columns).astype(whole)


def _problem(fault: Exception) -> str:
    return f"{type(fault).__name__}: {fault}"


def _compressed(content: memoryview, member: zipfile.ZipInfo) -> bytes:
    """The bytes of a member as they are stored, behind its local header."""
    at = member.header_offset
    header = content[at : at + _HEADER]
    if len(header) < _HEADER or bytes(header[:4]) != b"PK\x03\x04":
        raise zipfile.BadZipFile(f"no header of member {member.filename}")
    start = at + _HEADER + sum(int.from_bytes(header[k : k + 2], "little") for k in (_NAME_AT, _NAME_AT + 2))
    stored_bytes = content[start : start + member.compress_size]
    if len(stored_bytes) < member.compress_size:
        raise zipfile.BadZipFile(f"truncated member {member.filename}")
    if member.flag_bits & _ENCRYPTED:
        raise zipfile.BadZipFile(f"encrypted member {member.filename}")
    return bytes(stored_bytes)


def _open_archive(name: str, content: bytes) -> Iterator[pd.DataFrame]:
    """One row per member, the CSV ones with their compressed bytes; for an archive that cannot be read only its error."""
    try:
        archive = zipfile.ZipFile(io.BytesIO(content))
        members = [m for m in archive.infolist() if not m.is_dir()]
        view = memoryview(content)
        for member in members:
            if member.filename.lower().endswith(".csv"):
                _compressed(view, member)
    except Exception as fault:  # a bad archive is reported, the others go on
        yield _frame([(name, None, None, None, None, None, "erro", _problem(fault))], MEMBERS)
        return
    for member in members:
        if member.filename.lower().endswith(".csv"):
            row = (name, member.filename, member.compress_type, member.CRC, member.file_size, _compressed(view, member), "membro", None)
        else:
            row = (name, member.filename, None, None, None, None, "ignorado", None)
        yield _frame([row], MEMBERS)
    yield _frame([(name, None, None, None, None, None, "arquivo", None)], MEMBERS)


def _inflated(content: bytes, method: int, crc: int, size: int) -> Iterator[bytes]:
    """The member's bytes in pieces; its check sum is compared at the end."""
    if method == zipfile.ZIP_STORED:
        inflate, rest = (lambda piece: piece), (lambda: b"")
    elif method == zipfile.ZIP_DEFLATED:
        opened = zlib.decompressobj(-15)
        inflate, rest = opened.decompress, opened.flush
    elif method == zipfile.ZIP_BZIP2:
        inflate, rest = bz2.BZ2Decompressor().decompress, (lambda: b"")
    else:
        raise NotImplementedError(f"compression method {method}")
    found, total = 0, 0
    for at in range(0, len(content), PIECE):
        piece = inflate(content[at : at + PIECE])
        found, total = zlib.crc32(piece, found), total + len(piece)
        yield piece
    piece = rest()
    found, total = zlib.crc32(piece, found), total + len(piece)
    yield piece
    if (found, total) != (crc, size):
        raise zipfile.BadZipFile("damaged member")


def _lines(name: str, member: str, pieces: Iterator[bytes], encoding: str) -> Iterator[pd.DataFrame]:
    """Lines in batches, so that memory does not grow with the member; a fault ends them with an error row."""
    decoder = codecs.getincrementaldecoder(encoding)()
    rows: list[tuple] = []
    number, open_line = 0, ""
    try:
        for piece in _and_end(pieces):
            *whole, open_line = (open_line + (decoder.decode(b"", True) if piece is None else decoder.decode(piece))).split("\n")
            for line in whole:
                rows.append((name, member, number, line.rstrip("\r\n"), "linha", None))
                number += 1
            if len(rows) >= BATCH_LINES:
                yield _frame(rows, LINES)
                rows = []
        if open_line:
            rows.append((name, member, number, open_line.rstrip("\r\n"), "linha", None))
    except Exception as fault:
        rows.append((name, member, None, None, "erro", f"{_problem(fault)} ({member})"))
    if rows:
        yield _frame(rows, LINES)


def _and_end(pieces: Iterator[bytes]) -> Iterator[bytes | None]:
    yield from pieces
    yield None


def archive_members(archives: DataFrame, name: str = "path", content: str = "content") -> DataFrame:
    """One row per member of each archive, CSV members compressed as they are, and a row per archive read or not readable."""

    def open_all(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, blob in zip(batch["_name"], batch["_content"]):
                yield from _open_archive(path, bytes(blob))

    return archives.select(F.col(name).alias("_name"), F.col(content).alias("_content")).mapInPandas(open_all, MEMBERS)


def inflate_members(members: DataFrame, encoding: str = "latin-1") -> DataFrame:
    """The lines of CSV members, dealt out by member, and an error row for each one that is damaged."""

    def inflate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                pieces = _inflated(bytes(row.conteudo), int(row.metodo), int(row.crc), int(row.tamanho))
                yield from _lines(row.arquivo, row.membro, pieces, encoding)

    return members.filter("tipo = 'membro'").repartition("arquivo", "membro").mapInPandas(inflate, LINES)


def expand_archives(archives: DataFrame, name: str = "path", content: str = "content", encoding: str = "latin-1") -> DataFrame:
    """One row per line of every CSV member, plus marker rows in ``tipo``.

    ``linha``: a line; ``ignorado``: a member that is not CSV; ``arquivo``: an
    archive that was read; ``erro``: one that could not be, of which nothing
    else is kept. Lines are written once and read back, as a member found
    damaged takes all of its archive with it.
    """
    members = stored(archive_members(archives, name, content), "archive_members", by="tipo")
    columns = [c.split()[0] for c in LINES.split(", ")]
    markers = members.filter("tipo <> 'membro'").withColumns({"linha_no": F.lit(None).cast("long"), "texto": F.lit(None).cast("string")})
    lines = stored(inflate_members(members, encoding), "archive_lines", by="tipo")
    every = lines.select(*columns).unionByName(markers.select(*columns))
    failed = every.filter("tipo = 'erro'").groupBy("arquivo").agg(F.min("erro").alias("erro"))
    kept = every.filter("tipo <> 'erro'").join(failed.select("arquivo"), "arquivo", "left_anti")
    missing = {c: F.lit(None).cast(t) for c, t in (("membro", "string"), ("linha_no", "long"), ("texto", "string"))}
    return kept.select(*columns).unionByName(failed.withColumns(missing).withColumn("tipo", F.lit("erro")).select(*columns))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every ``*.zip`` below a folder, one task per group of archives."""
    return (
        spark.read.format("binaryFile")
        .options(recursiveFileLookup=True, pathGlobFilter="*.[zZ][iI][pP]")
        .load(path)
        .select("path", "content")
    )


def csv_lines(expanded: DataFrame) -> DataFrame:
    return expanded.filter("tipo = 'linha'").select("arquivo", "membro", "linha_no", "texto")


def archive_counters(expanded: DataFrame) -> DataFrame:
    """Archives read, archives that failed, members that are not CSV."""
    return expanded.agg(
        F.count_if(F.col("tipo") == "arquivo").alias("arquivos_lidos"),
        F.count_if(F.col("tipo") == "erro").alias("arquivos_invalidos"),
        F.count_if(F.col("tipo") == "ignorado").alias("membros_ignorados"),
    )


def member_table(lines: DataFrame, term: str, file_name_as: str | None = None) -> DataFrame | None:
    """The members whose name contains ``term`` as one all-string table, or None without any.

    Line 0 of a member is its header, and the members of one header are parsed
    together. The driver sees the header lines only, one per member.
    """
    chosen = lines.filter(F.contains(F.lower("membro"), F.lit(term.lower())))
    groups: dict[tuple[str, str], list[str]] = {}
    headers = chosen.filter("linha_no = 0").select(
        "membro", "texto", delimited.separator_of(F.col("texto")).alias("separador")
    )
    for row in headers.distinct().collect():
        groups.setdefault((row["texto"], row["separador"]), []).append(row["membro"])
    table: DataFrame | None = None
    for (header, sep), members in sorted(groups.items()):
        rows = chosen.filter(F.col("membro").isin(members) & (F.col("linha_no") > 0) & (F.length("texto") > 0))
        part = delimited.parse_lines(rows, "texto", delimited.header_names(header, sep), sep, "membro")
        if file_name_as:
            part = part.withColumnRenamed("membro", file_name_as)
        else:
            part = part.drop("membro")
        table = part if table is None else table.unionByName(part, allowMissingColumns=True)
    return table
