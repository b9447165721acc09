"""Files, listings, archives and sinks."""

import random
import datetime as dt
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from cotalake.operators.cleaning import basic_clean
from cotalake.session import scratch_path, shared_dir
from cotalake.sinks import publish, writers
from cotalake.sources import archives, delimited, listing, objects, quoted


def test_line_breaks_inside_fields(spark, tmp_path, rows):
    df = spark.createDataFrame([("a\nb", "1"), ("c", "2")], "t string, v string")
    writers.sink_csv(df, str(tmp_path / "x"))
    assert rows(delimited.scan_delimited(spark, str(tmp_path / "x"), encoding="UTF-8", multiline=True)) == rows(df)


def test_line_breaks_inside_fields_read_by_many_tasks(spark, tmp_path, rows):
    """Two files cut every 1,000 bytes: fields of many lines and blocks, quotes, empty lines, both line ends, equal rows."""
    draw = random.Random(3)
    pieces = ["a", ";", '""', "\n", "\r\n", "ção", " ", "\n\n"]
    folder = tmp_path / "q"
    folder.mkdir()
    for name, end in (("um.csv", "\n"), ("dois +.csv", "\r\n")):
        lines = ["nome;v;w"]
        for i in range(300):
            field = "".join(draw.choice(pieces) for _ in range(draw.choice([1, 3, 40 if i % 50 else 400])))
            lines.append(f'"{field}";{i % 7};"x{i}"' if draw.random() < 0.6 else f"simples;{i % 7};")
            lines += [""] * (i % 9 == 0)
        (folder / name).write_bytes((end.join(lines) + (end if end == "\n" else "")).encode("latin-1"))
    (folder / "vazio.csv").write_bytes(b"nome;v;w\n")
    (folder / "titulo.csv").write_bytes(b'\n"no\nme";v;w\nz;1;2\n')
    names = ["nome", "v", "w"]
    whole = delimited.scan_delimited(spark, str(folder), names=names, multiline=True, file_name_as="origem")
    sizes = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for setting in sizes:
            spark.conf.set(setting, "1000" if setting.endswith("PartitionBytes") else "0")
        blocks = quoted.records(spark, str(folder)).select(quoted.BLOCK).distinct().count()
        got = rows(quoted.scan_quoted(spark, str(folder), names, file_name_as="origem"))
    finally:
        for setting, value in sizes.items():
            spark.conf.set(setting, value)
    assert blocks > 5 and len(got) == 601

    def plain(found):
        return sorted(tuple(None if c is None else c.replace("\r\n", "\n") for c in r) for r in found)

    assert plain([[c or "" for c in r] for r in got]) == plain([[c or "" for c in r] for r in rows(whole)])
    # The one-task reader writes the breaks of a file with CRLF as LF; here they stand as in the file.
    assert any("\r\n" in (r[0] or "") for r in got if r[3].startswith("dois"))


def test_quoted_records_across_runs_of_lines(spark, tmp_path, rows, monkeypatch):
    """A block is held in runs: records over several runs, over all of them, and the header's own are put together all the same."""
    monkeypatch.setattr(quoted, "RUN_BITS", 2)
    draw = random.Random(5)
    lines = ['"no', 'me";v']
    for i in range(200):
        breaks = "\n" * draw.choice([0, 1, 2, 3, 9, 30])
        lines.append(f'"a{breaks}""{i}""";{i}' if draw.random() < 0.7 else f"s;{i}")
    folder = tmp_path / "q"
    folder.mkdir()
    (folder / "a.csv").write_text("\n".join(lines) + "\n")
    runs = quoted._lines(spark, str(folder), "UTF-8").groupBy(quoted.FILE, quoted.BLOCK, quoted.RUN).count()
    assert runs.agg(F.max("count")).first()[0] == 4
    whole = delimited.scan_delimited(spark, str(folder), names=["nome", "v"], encoding="UTF-8", multiline=True)
    got = rows(quoted.scan_quoted(spark, str(folder), ["nome", "v"], encoding="UTF-8"))
    assert len(got) == 200 and got == rows(whole)


@pytest.mark.parametrize("line, sep", [("A;B", ";"), ("A,B", ","), ("A", ","), ("A;B,C", ","), ("", ","), (None, ",")])
def test_separator(spark, line, sep):
    df = spark.createDataFrame([(line,)], "l string")
    assert df.select(delimited.separator_of(F.col("l"))).first()[0] == sep


def test_latin1_quotes_and_missing_texts(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_bytes('nome;v\nAções;"x;""y"""\nNA;\n"";0\n'.encode("latin-1"))
    assert rows(delimited.scan_delimited(spark, str(tmp_path))) == [(None, None), (None, "0"), ("Ações", 'x;"y"')]


def test_mixed_headers_and_separators(spark, tmp_path, rows):
    (tmp_path / "inf_1_clean.csv").write_text("A;B\n1;2\n")
    (tmp_path / "inf_2_clean.csv").write_text("B,A,C\n3,4,5\n")
    (tmp_path / "outro.csv").write_text("Z\n9\n")
    got = delimited.scan_union_by_name(spark, str(tmp_path / "inf_*_clean.csv"))
    assert rows(got, "A", "B", "C") == [("1", "2", None), ("4", "3", "5")]
    with pytest.raises(Exception):
        delimited.scan_union_by_name(spark, str(tmp_path / "nada_*.csv"))


def test_header_names():
    assert delimited.header_names('a;"b;c";a;a', ";") == ["a", "b;c", "a.1", "a.2"]
    assert delimited.header_names("DT;v;dt;Dt;DT.1", ";") == ["DT.2", "v", "dt.3", "Dt", "DT.1"]


def test_ragged_rows(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text('A;B\n1;2\n3\n4;5;6;7\n8;9;\n"x;y";10\n"a;b";c;d\n')
    scanned = delimited.scan_tolerant(spark, str(tmp_path), ["A", "B"])
    assert rows(delimited.good_rows(scanned)) == [("1", "2"), ("3", None), ("x;y", "10")]
    assert rows(delimited.quarantine(scanned), delimited.BROKEN) == [('"a;b";c;d',), ("4;5;6;7",), ("8;9;",)]


def test_object_listing(spark, tmp_path, rows):
    (tmp_path / "sub").mkdir()
    for name in ("a_registro_classe.csv", "sub/B.CSV", "sub/c.txt"):
        (tmp_path / name).write_text("x")
    assert rows(objects.list_csv_objects(spark, str(tmp_path)), "nome", "tamanho") == [("B.CSV", 1), ("a_registro_classe.csv", 1)]
    assert objects.single_file_by_pattern(spark, str(tmp_path), "REGISTRO_classe").first()["caminho"].endswith("a_registro_classe.csv")
    assert objects.single_file_by_pattern(spark, str(tmp_path), "nada").first()["caminho"] is None


LISTING = """<html><a href="../">../</a> 01-Feb-2024 08:30
<a href="HIST/">HIST/</a>   01-Feb-2024 08:30
<a href="inf_diario_fi_202401.zip">inf</a>   01-Feb-2024 08:30
<A HREF="/abs/registro_fundo_classe.ZIP">reg</A> 31-XXX-2024 00:00
<a href="inf_diario_fi_202401.zip">again</a> 02-Feb-2024 08:30
<a href="leia.html">x</a> 01-Feb-2024 08:30 <a href="sem_data.csv">y</a> sem data
<a href="https://outro.example/z.xml?v=1">z</a> 05-mar-2024 10:00</html>"""


def test_listing_links(spark):
    pages = spark.createDataFrame([(1, "https://x.example/dados/FI/", LISTING)], "page_id int, url string, html string")
    got = [tuple(r) for r in listing.extract_listing_links(pages).collect()]
    assert got == [
        ("https://x.example/dados/FI/inf_diario_fi_202401.zip", "inf_diario_fi_202401.zip", dt.datetime(2024, 2, 1, 8, 30)),
        ("https://x.example/abs/registro_fundo_classe.ZIP", "registro_fundo_classe.ZIP", None),
        ("https://outro.example/z.xml?v=1", "z.xml", dt.datetime(2024, 3, 5, 10, 0)),
    ]


def test_join_url_like_the_standard_library(spark):
    from urllib.parse import urljoin

    bases = ["http://h/a/b/c", "http://h/a/b/", "https://h", "http://h/a?q=1#f"]
    hrefs = ["x.csv", "/x", "../x", "./x/y", "../../x", "//o/x", "https://o/x", "?q=2", "#f", "a/../b.zip", "x?y=../z", ".."]
    df = spark.createDataFrame([(b, h) for b in bases for h in hrefs], "b string, h string")
    wrong = [
        (r["b"], r["h"], r["u"], urljoin(r["b"], r["h"]))
        for r in df.select("b", "h", listing.join_url(F.col("b"), F.col("h")).alias("u")).collect()
        if r["u"] != urljoin(r["b"], r["h"])
    ]
    assert not wrong


def test_relevance_and_first_source_wins(spark, rows):
    names = spark.createDataFrame([("Registro_Fundo_Classe.zip",), ("registro_fundo_classe.csv",), ("x_INF_DIARIO.txt",)], "n string")
    assert [r[0] for r in names.select(listing.classify_resource(F.col("n"))).collect()] == [True, False, True]
    schema = "url string, nome string, modificado timestamp, posicao int"
    a = spark.createDataFrame([("u1", "inf_diario_b", None, 0)], schema)
    b = spark.createDataFrame([("u1", "inf_diario_b", dt.datetime(2024, 1, 1), 0), ("u2", "inf_diario_a", None, 1), ("u3", "outro", None, 2)], schema)
    got = [(r["url"], r["fonte"]) for r in listing.consolidate_sources([a, b]).collect()]
    assert got == [("u2", 1), ("u1", 0)]


def test_archives(spark, tmp_path, rows):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as z:
        z.writestr("d/um.csv", "A;B\r\nAção;2\n".encode("latin-1"))
        z.writestr("DOIS.CSV", "x")
        z.writestr("nota.txt", "y")
    (tmp_path / "bom.zip").write_bytes(buffer.getvalue())
    (tmp_path / "ruim.zip").write_bytes(b"isto nao e um zip")
    expanded = archives.expand_archives(archives.read_archives(spark, str(tmp_path)))
    assert rows(archives.csv_lines(expanded), "membro", "linha_no", "texto") == [
        ("DOIS.CSV", 0, "x"), ("d/um.csv", 0, "A;B"), ("d/um.csv", 1, "Ação;2"),
    ]
    assert tuple(archives.archive_counters(expanded).first()) == (1, 1, 1)
    assert expanded.filter("tipo = 'erro'").first()["erro"].startswith("BadZipFile")


def test_sinks_round_trip(spark, tmp_path, rows):
    df = spark.createDataFrame([("Ações; \"x\"", 20240131), (None, 20240201)], "t string, sk_data int")
    assert writers.sink_csv(df, str(tmp_path / "c")) == 2
    back = delimited.scan_delimited(spark, str(tmp_path / "c"), encoding="UTF-8")
    assert rows(back) == [(None, "20240201"), ("Ações; \"x\"", "20240131")]
    assert writers.sink_dual(spark, df, str(tmp_path / "d")) == 2
    assert rows(spark.read.parquet(str(tmp_path / "d/parquet"))) == rows(df)
    assert writers.sink_partitioned_month(df, str(tmp_path / "m")) == 2
    assert sorted(p.name for p in (tmp_path / "m").iterdir() if p.is_dir()) == ["ano_mes=202401", "ano_mes=202402"]
    writers.sink_partitioned_month(df.filter("sk_data = 20240201").withColumn("t", F.lit("n")), str(tmp_path / "m"), only_touched=True)
    assert rows(spark.read.parquet(str(tmp_path / "m")), "sk_data", "t") == [(20240131, "Ações; \"x\""), (20240201, "n")]
    writers.overwrite_full_load(df.limit(1), str(tmp_path / "m"))
    assert spark.read.parquet(str(tmp_path / "m")).count() == 1


def test_a_failed_publication_leaves_the_table_readable(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        publish.published_table(spark, path)
    assert publish.publish_table(spark.range(5), path) == 5
    held = publish.published_table(spark, path)
    breaks = spark.range(4).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("lost")).cast("long")).alias("id"))
    for _ in range(2):
        with pytest.raises(Exception, match="lost"):
            publish.publish_table(breaks, path)
        assert publish.published_table(spark, path).count() == 5
    # A table made of itself; who opened the one before still reads it.
    assert publish.publish_table(publish.published_table(spark, path).filter("id > 1"), path) == 3
    assert (publish.published_table(spark, path).count(), held.count()) == (3, 5)
    assert publish.publish_table(spark.range(0), path) == 0 and publish.published_table(spark, path).count() == 0
    assert [r["registros"] for r in publish.commits(spark, path).orderBy("versao").collect()] == [5, 3, 0]


def test_large_month_is_written_by_several_tasks(spark, tmp_path):
    """A third of all rows in one month, and far more of it than one task should write."""
    df = spark.range(400_000).select(
        F.when(F.col("id") % 3 == 0, 20240101).otherwise((202402 + F.col("id") % 10).cast("int") * 100 + 1).cast("int").alias("sk_data"),
        F.sha2(F.col("id").cast("string"), 256).alias("t"),
    )
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        writers.sink_partitioned_month(df, str(tmp_path / "m"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    files = list((tmp_path / "m" / "ano_mes=202401").glob("*.parquet"))
    assert len(files) > 1 and spark.read.parquet(str(tmp_path / "m")).count() == 400_000


def test_each_file_is_cleaned_apart(spark, tmp_path, rows):
    for name in ("inf_1", "inf_2"):
        (tmp_path / f"{name}.csv").write_text("A;B\n1; x\n1;x \n")
    raw = writers.with_output_name(spark.read.options(header=True, sep=";").csv(str(tmp_path / "inf_*.csv")))
    out = str(tmp_path / "clean")
    assert writers.per_file_output(basic_clean(raw), out) == 2
    back = spark.read.options(header=True, sep=";").csv(out)
    assert rows(back, "A", "B", "origem") == [("1", "x", "inf_1_clean.csv"), ("1", "x", "inf_2_clean.csv")]


def test_manifest(spark, tmp_path, rows):
    df = spark.range(10).toDF("i")
    n = writers.sink_parquet(df, str(tmp_path / "t"))
    manifest = writers.run_manifest(spark, [writers.Produced("t", str(tmp_path / "t"), n), writers.Produced("u", str(tmp_path / "t"), n)])
    assert rows(manifest, "nome", "quantidade_registros") == [("t", 10), ("total", 20), ("u", 10)]
    size = {r["nome"]: r["tamanho_mb"] for r in manifest.collect()}
    assert 0 < size["t"] < 1 and size["total"] == pytest.approx(2 * size["t"])


def test_scratch_follows_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark) + "/")
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def _zip(members, method=zipfile.ZIP_DEFLATED):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", method) as z:
        for name, content in members.items():
            z.writestr(name, content)
    return buffer.getvalue()


def _lines_of(expanded):
    found = {}
    for r in archives.csv_lines(expanded).collect():
        found.setdefault((r["arquivo"], r["membro"]), {})[r["linha_no"]] = r["texto"]
    return {k: [v[n] for n in sorted(v)] for k, v in found.items()}


@pytest.mark.parametrize("method", [zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2])
def test_members_are_inflated_apart(spark, monkeypatch, method):
    """Each member in its own task, whatever its method, also lines longer than a piece and an end without a line break."""
    contents = {f"p/{i}.csv": f"linha {i};ação\r\n{'x' * 700_000}\n\nfim {i}".encode("latin-1") for i in range(30)}
    packed = spark.createDataFrame([("a.zip", _zip({**contents, "vazio.csv": b"", "leia.txt": b"x"}, method))], "path string, content binary")
    expanded = archives.expand_archives(packed)
    lines = _lines_of(expanded)
    assert lines == {("a.zip", f"p/{i}.csv"): [f"linha {i};ação", "x" * 700_000, "", f"fim {i}"] for i in range(30)}
    assert tuple(archives.archive_counters(expanded).first()) == (1, 0, 1)
    members = archives.archive_members(packed)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        tasks = archives.inflate_members(members.repartition(1)).select(F.spark_partition_id().alias("t"), "membro").distinct()
        assert tasks.select("t").distinct().count() > 1 and tasks.count() == 30
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_a_damaged_member_takes_its_archive(spark):
    good = _zip({"a.csv": b"1\n2\n", "b.csv": b"3\n"})
    body = b"\n".join(b"%d" % (i * i) for i in range(5000))
    whole = _zip({"c.csv": b"4\n", "d.csv": body})
    at = whole.index(b"d.csv") + 2000
    damaged = whole[:at] + bytes([whole[at] ^ 0xFF]) + whole[at + 1 :]
    packed = spark.createDataFrame([("g.zip", good), ("d.zip", damaged), ("t.zip", good[:40]), ("e.zip", b"")], "path string, content binary")
    expanded = archives.expand_archives(packed)
    assert _lines_of(expanded) == {("g.zip", "a.csv"): ["1", "2"], ("g.zip", "b.csv"): ["3"]}
    assert tuple(archives.archive_counters(expanded).first()) == (1, 3, 0)
    errors = {r["arquivo"]: r["erro"] for r in expanded.filter("tipo = 'erro'").collect()}
    assert set(errors) == {"d.zip", "t.zip", "e.zip"} and "d.csv" in errors["d.zip"]
