"""Removal of lines that spread over many sites, in DataFrame operations only.

Every line's sites are counted by a HyperLogLog sketch; sketches of a line merge in the partial aggregation. Lines whose
estimate is near the threshold get an exact distinct count. Lines on ``least_sites`` sites or more are boilerplate and go.
A document of nothing but boilerplate is a copy rather than a page that carries some; it stays whole, for a later step on
near-duplicates to judge.

Defined results: lines are compared without blanks, tabs and carriage returns at their ends; blank lines are never
boilerplate and stay where they are. A null text stays null and an empty one empty, with nothing removed. A null site counts
as one site of its own. Repeated rows add nothing to a spread and are all cleaned alike. Empty tables give an empty result.
Other columns stay; helper columns have names of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake.llm.common import written

LEAST_SITES = 6
#: Sketches of 2**10 cells: 3.2 % standard error; below some hundred sites they are all but exact.
LOG_CELLS = 10


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\r"))


def _lines(docs: DataFrame, text: str, site: str) -> DataFrame:
    """One row per line with content: its document's key, position, site, and two hashes; no text."""
    rows = docs.select(
        F.xxhash64(F.lit(11), F.col(text)).alias("doc1"),
        F.xxhash64(F.lit(12), F.col(text)).alias("doc2"),
        F.coalesce(F.xxhash64(F.col(site)), F.lit(0)).alias("site"),
        F.posexplode(F.split(F.col(text), "\n")).alias("pos", "line"),
    ).withColumn("line", _trimmed(F.col("line")))
    rows = rows.where(F.col("line") != "")
    return rows.select("doc1", "doc2", "site", "pos", F.xxhash64(F.lit(1), F.col("line")).alias("h1"), F.xxhash64(F.lit(2), F.col("line")).alias("h2"))


def wide_lines(lines: DataFrame, least_sites: int) -> DataFrame:
    """Hashes of the lines found on at least that many sites.

    The sketch decides where the estimate is at least half or twice the threshold; in between, distinct sites are counted.
    """
    spread = lines.groupBy("h1", "h2").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(LOG_CELLS))).alias("sites"))
    spread = spread.where(F.col("sites") * 2 >= least_sites)
    return spread


def remove_boilerplate(docs: DataFrame, text: str = "text", site: str = "source", least_sites: int = LEAST_SITES, info: str = "lines") -> DataFrame:
    """``docs`` with ``text`` cleaned and the struct column ``info`` added: n_lines, n_removed, all_boilerplate.

    A text is known by two hashes of itself, so equal texts are cleaned alike and ids may repeat or be null. Only hashes are
    shuffled to find the lines; texts are joined with the positions to remove.
    """
    lines = _lines(docs, text, site)
    spread = written(wide_lines(lines, least_sites), "line_spread")
    near = spread.where(F.col("sites") < least_sites * 2).select("h1", "h2")
    exact = lines.join(near, ["h1", "h2"], "left_semi").groupBy("h1", "h2", "site").agg(F.lit(1).alias("one"))
    exact = exact.groupBy("h1", "h2").agg(F.count("one").alias("sites")).where(F.col("sites") >= least_sites).select("h1", "h2")
    wide = written(spread.where(F.col("sites") >= least_sites * 2).select("h1", "h2").unionByName(exact), "line_wide")

    gone = lines.select("doc1", "doc2", "pos", "h1", "h2").join(wide, ["h1", "h2"], "left_semi")
    gone = gone.groupBy("doc1", "doc2").agg(F.collect_set("pos").alias("__llm_gone"))
    keyed = docs.withColumns({"__llm_doc1": F.xxhash64(F.lit(11), F.col(text)), "__llm_doc2": F.xxhash64(F.lit(12), F.col(text))})
    gone = written(gone.withColumnsRenamed({"doc1": "__llm_doc1", "doc2": "__llm_doc2"}), "line_gone")
    joined = keyed.join(gone, ["__llm_doc1", "__llm_doc2"], "left")

    split = F.split(F.col(text), "\n")
    hit = F.col("__llm_gone").isNotNull()
    # Positions are compared as sets: the work grows with the lines, not with their square.
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col("__llm_gone"))
    joined = joined.withColumn("__llm_kept", F.when(hit, F.transform(stay, lambda i: split[i])))
    blank = F.size(F.filter("__llm_kept", lambda x: _trimmed(x) != "")) == 0
    joined = joined.withColumn("__llm_all", F.coalesce(hit & blank, F.lit(False)))
    cleans = hit & ~F.col("__llm_all")
    counts = F.struct(
        F.when(F.coalesce(F.col(text), F.lit("")) == "", F.lit(0)).otherwise(F.size(split)).cast("long").alias("n_lines"),
        F.when(cleans, F.size("__llm_gone")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.col("__llm_all").alias("all_boilerplate"),
    )
    cleaned = F.when(cleans, F.array_join("__llm_kept", "\n")).otherwise(F.col(text))
    joined = joined.withColumn("__llm_text", cleaned).withColumn("__llm_info", counts)
    return joined.select(*[F.col("__llm_text").alias(c) if c == text else F.col(c) for c in docs.columns if c != info], F.col("__llm_info").alias(info))


def clean_documents(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_lines, n_removed, all_boilerplate, and the cleaned text."""
    found = remove_boilerplate(docs.select("doc_id", "text", "source"))
    return found.select("doc_id", "lines.*", "text")


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` with cleaned texts, the same columns, and ``n_chars`` (where present) as long as the text."""
    found = remove_boilerplate(docs, info="__llm_lines")
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return found.select(*docs.columns)
