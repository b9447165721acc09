"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are added as logarithms: the text's likelihood under each language's model of byte triples, the
declared markup language, the suffix of the address, and a prior of the host. The model and all priors come from grouped
aggregation over all rows. A host's prior is smoothed towards its parent domain's, that towards its suffix's, and that
towards the whole corpus. A row's own text is taken out of the counts of its host, domain and suffix, as it is evidence already.

Defined results: null and empty texts, and texts without letters, have no text evidence; their language follows from the
rest and they are not accepted. A null declaration, host or label is no evidence, and labels of white space or ``und`` are none. Labels count in lower
case; of more than ``MAX_LANGUAGES`` the ones with fewest rows are one language, ``other``. Repeated rows each count. Empty tables
give an empty result; with no labelled text every row is ``und``. Other columns are kept; helper columns have names of
their own. Equal posteriors go to the language that comes first by name.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake.llm import text as T
from cotalake.llm.common import written

BUCKETS = 1 << 14
#: Triples that a text counts as at most; neighbouring triples are not independent.
EFFECTIVE = 40.0
#: Prior weight of text in none of the known languages.
UNKNOWN = 0.01
#: Pseudo-counts with which each level of hosts leans on the one above.
LEAN = 5.0
#: Languages told apart.
MAX_LANGUAGES = 400
UNDETERMINED, REST = "und", "other"
#: Declarations of no known language, and none at all; labels have no white space around them.
_FOREIGN, _NOTHING = " other", ""

_LETTER = np.where(T.LETTERS & ~((T.LOWER >= 0x30) & (T.LOWER <= 0x39)), T.LOWER, 0).astype(np.uint32)


def _triples(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, triples per row, and their buckets. A triple is centred on a letter; other bytes count as one blank."""
    data, offsets = T.utf8(column)
    for first, last in T.groups(offsets, T.CHUNK // 4):
        part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        codes = np.zeros(len(part) + 2, np.uint32)
        codes[1:-1] = _LETTER[part]
        left, right = codes[:-2].copy(), codes[2:].copy()
        edge = bounds[:-1][np.diff(bounds) > 0]
        left[edge] = 0
        right[edge[1:] - 1] = 0
        at = np.flatnonzero(codes[1:-1])
        mixed = left[at] * np.uint32(0x9E3779B1) + codes[1:-1][at] * np.uint32(0x85EBCA77) + right[at] * np.uint32(0xC2B2AE3D)
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        yield first, np.diff(np.searchsorted(at, bounds)), (mixed >> np.uint32(18)).astype(np.int64)


@dataclass(frozen=True)
class TextModel:
    """log P(triple | language); the last row is text in none of them, spread evenly."""

    languages: tuple[str, ...]
    logs: np.ndarray


def train(labelled: DataFrame, text: str = "text", lang: str = "lang") -> TextModel:
    """Triple counts per language over all labelled rows; the driver gets one count per language and bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            labels = np.array(batch.column(1).to_pylist(), object)
            for first, sizes, buckets in _triples(batch.column(0)):
                owner = np.repeat(labels[first : first + len(sizes)], sizes)
                for label in set(labels[first : first + len(sizes)]):
                    found = np.bincount(buckets[owner == label], minlength=BUCKETS)
                    totals[label] = totals.get(label, 0) + found
        for label, found in totals.items():
            at = np.flatnonzero(found)
            yield pa.RecordBatch.from_arrays([pa.array([label] * len(at), pa.string()), pa.array(at, pa.int32()), pa.array(found[at], pa.int64())], ["lang", "bucket", "n"])

    label = _label(F.col(lang))
    known = [r["lang"] for r in labelled.select(label.alias("lang")).where("lang is not null").groupBy("lang").count().orderBy(F.col("count").desc(), "lang").limit(MAX_LANGUAGES + 1).collect()]
    if len(known) > MAX_LANGUAGES:
        label = F.when(label.isNotNull() & ~label.isin(known[: MAX_LANGUAGES - 1]), REST).otherwise(label)
    rows = labelled.select(F.col(text), label.alias("lang")).where("lang is not null")
    counts = rows.mapInArrow(count, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    found = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("cells")).orderBy("lang").collect()
    table = np.full((len(found) + 1, BUCKETS), 0.5)
    for row, counted in zip(table, found):
        for bucket, n in counted["cells"]:
            row[bucket] += n
    logs = np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32)
    return TextModel(tuple(r["lang"] for r in found), logs)


def _label(lang: Column) -> Column:
    """A label in lower case; null where it says nothing."""
    plain = F.lower(F.trim(lang.cast("string")))
    return F.when(~plain.isin("", UNDETERMINED), plain)


def text_evidence(model: TextModel) -> object:
    """A function of a text column: the number of triples, then each language's log-likelihood (undetermined last)."""
    logs, width = np.ascontiguousarray(model.logs.T), len(model.logs)

    @F.arrow_udf("array<double>")
    def evidence(column: pa.Array) -> pa.Array:
        out = np.zeros((len(column), width + 1))
        for first, sizes, buckets in _triples(column):
            total = T.sums(logs[buckets].astype(np.float64), sizes)
            scale = np.minimum(1.0, EFFECTIVE / np.maximum(sizes, 1))
            out[first : first + len(sizes), 1:] = total * scale[:, None]
            out[first : first + len(sizes), 0] = sizes
        return _lists(out)

    # Costly to repeat: so marked, no filter or later column evaluates it again.
    return evidence.asNondeterministic()


def _lists(rows: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1], pa.array(rows.ravel()))


def _softmax(logs: np.ndarray) -> np.ndarray:
    raised = np.exp(logs - logs.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


def _text_only(logs: np.ndarray) -> np.ndarray:
    """Posterior by the text and the weight of unknown languages alone."""
    logs = logs.copy()
    logs[:, -1] += np.log(UNKNOWN)
    return _softmax(logs)


def fusion(corpus: np.ndarray, marks: dict[str, np.ndarray]) -> object:
    """A function of text evidence, the counts of suffix, domain and host, and the declaration: the fused posterior, then the text's own.

    From the suffix to the host, counts without the row's own are mixed with ``LEAN`` more spread as the level above.
    """
    keys = sorted(marks)
    table = np.array([marks[k] for k in keys])
    width = len(corpus)

    @F.arrow_udf("array<double>")
    def fused(evidence: pa.Array, suffix: pa.Array, domain: pa.Array, host: pa.Array, declared: pa.Array) -> pa.Array:
        seen = evidence.flatten().to_numpy().reshape(-1, width + 1)
        text = _text_only(seen[:, 1:])
        own = np.where(seen[:, :1] > 0, text, 0.0)
        share = np.repeat(corpus[None, :], len(seen), axis=0)
        for level in (suffix, domain, host):
            known = ~level.is_null().to_numpy(zero_copy_only=False)
            counts = level.flatten().to_numpy().reshape(-1, width)
            mixed = np.maximum(counts - own[known], 0.0) + LEAN * share[known]
            share[known] = mixed / mixed.sum(axis=1, keepdims=True)
        given = table[np.searchsorted(keys, np.array(declared.to_pylist(), object).astype(str))] if len(seen) else np.zeros((0, width))
        return _lists(np.hstack([_softmax(seen[:, 1:] + np.log(share) + given), text]))

    return fused.asNondeterministic()


def host_of(url: Column) -> Column:
    """Host name in lower case; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def parent_of(host: Column) -> Column:
    """The last two labels of a host."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def declared_in(html: Column) -> Column:
    """Primary language of the ``lang`` attribute of the html element; empty where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,8})", 1)), F.lit(""))


def visible_text(html: Column) -> Column:
    """Text between tags, without scripts, styles, comments and entities."""
    plain = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    return F.regexp_replace(plain, r"<[^>]*>|&#?\w{1,10};", " ")


def _log_share(counts: Column, total: Column, index: int) -> Column:
    return F.log(F.element_at(counts, index) / total)


def identify(df: DataFrame, model: TextModel, text: Column, declared: Column, host: Column, least: float = 0.5) -> DataFrame:
    """Adds the struct column ``language``: lang, confidence, text_lang, declared, host, suffix, n_triples, accepted.

    A row is accepted if its text has letters, its language is known, and the posterior is at least ``least``. The priors are
    aggregated first; the second pass joins a host's priors to its rows and scores the text again, so no text is shuffled
    where the host table is small, and none is stored.
    """
    width = len(model.languages) + 1
    evidence = text_evidence(model)
    names = F.array(*[F.lit(n) for n in (*model.languages, UNDETERMINED)])
    mark = _label(declared)
    known = mark.isin(*model.languages) if model.languages else F.lit(False)
    clean = F.when(mark.isNull(), _NOTHING).when(known, mark).otherwise(F.lit(_FOREIGN))

    @F.arrow_udf("array<double>")
    def text_only(column: pa.Array) -> pa.Array:
        return _lists(_text_only(column.flatten().to_numpy().reshape(-1, width + 1)[:, 1:]))

    seen = df.select(evidence(text).alias("ev"), clean.alias("declared"), F.coalesce(F.lower(host), F.lit("")).alias("host")).where(F.col("ev")[0] > 0)
    sums = [F.sum(F.col("p")[i]).alias(f"c{i}") for i in range(width)]
    grouped = written(seen.select("declared", "host", text_only(F.col("ev")).alias("p")).groupBy("host", "declared").agg(*sums), "language_counts")
    cells = [f"c{i}" for i in range(width)]

    def level(source: DataFrame, key: str) -> DataFrame:
        return source.groupBy(key).agg(*[F.sum(c).alias(c) for c in cells])

    hosts = level(grouped, "host")
    whole = hosts.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in cells]).first()
    corpus = np.array([whole[c] for c in cells]) + 1.0
    corpus = corpus / corpus.sum()

    # P(declared | language): at most one row per language, and two more.
    marks = {r["declared"]: np.array([r[c] for c in cells]) for r in level(grouped, "declared").collect()}
    keys = [*model.languages, _FOREIGN, _NOTHING]
    given = np.array([marks.get(k, np.zeros(width)) for k in keys]) + np.array([[3.0 if k == n else 0.3 for n in (*model.languages, UNDETERMINED)] for k in keys])
    given = np.log(given / given.sum(axis=0, keepdims=True))
    given[-1] = 0.0  # nothing declared

    # Counts of a host, and of the domain and the suffix it belongs to.
    hosts = hosts.withColumn("domain", parent_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    packed = F.array(*cells)
    domains = level(hosts, "domain").select("domain", packed.alias("__llm_domain"))
    suffixes = level(hosts, "suffix").select("suffix", packed.alias("__llm_suffix"))
    counted = hosts.select(F.col("host").alias("__llm_host"), "domain", "suffix", packed.alias("__llm_counts")).join(domains, "domain").join(suffixes, "suffix")
    counted = written(counted.select("__llm_host", "__llm_counts", "__llm_domain", "__llm_suffix"), "language_priors")

    rows = df.withColumn("__llm_host", F.coalesce(F.lower(host), F.lit(""))).withColumn("__llm_mark", clean)
    rows = rows.join(counted, "__llm_host", "left").withColumn("__llm_ev", evidence(text))
    fused = fusion(corpus, dict(zip(keys, given)))
    rows = rows.withColumn("__llm_both", fused("__llm_ev", "__llm_suffix", "__llm_domain", "__llm_counts", "__llm_mark"))
    rows = rows.withColumns({"__llm_post": F.slice("__llm_both", 1, width), "__llm_text": F.slice("__llm_both", width + 1, width)})

    def best(p: Column) -> Column:
        return F.element_at(names, F.array_position(p, F.array_max(p)).cast("int"))

    triples = F.col("__llm_ev")[0]
    lang = best(F.col("__llm_post"))
    confidence = F.array_max("__llm_post")
    found = F.struct(
        lang.alias("lang"),
        confidence.alias("confidence"),
        F.when(triples > 0, best(F.col("__llm_text"))).alias("text_lang"),
        F.nullif(F.trim("__llm_mark"), F.lit(_NOTHING)).alias("declared"),
        F.nullif(F.col("__llm_host"), F.lit("")).alias("host"),
        F.nullif(suffix_of(F.col("__llm_host")), F.lit("")).alias("suffix"),
        triples.cast("long").alias("n_triples"),
        ((triples > 0) & (lang != UNDETERMINED) & (confidence >= least)).alias("accepted"),
    )
    return rows.select(*[F.col(c) for c in df.columns if c != "language"], found.alias("language"))


def identify_pages(pages: DataFrame, labelled: DataFrame) -> DataFrame:
    """Language of every web page, by models of the labelled documents."""
    model = train(labelled)
    page = pages.select("page_id", "url", "html")
    found = identify(page, model, visible_text(F.col("html")), declared_in(F.col("html")), host_of(F.col("url")))
    return found.select("page_id", "language.*")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents whose language is accepted; ``lang`` becomes the language found.

    The declared language is the column ``lang``, the host is ``source``. Columns and their order stay.
    """
    model = train(docs)
    if not model.languages:
        return docs.limit(0)
    marked = docs.withColumn("__llm_row", F.struct(*docs.columns))
    found = identify(marked, model, F.col("text"), F.col("lang"), F.col("source"))
    kept = found.where("language.accepted")
    return kept.select(*[F.col("language.lang").alias(c) if c == "lang" else F.col("__llm_row")[c].alias(c) for c in docs.columns])
