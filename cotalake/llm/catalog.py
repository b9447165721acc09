"""Registered queries of this package, each next to its reference SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cotalake.llm import (
    decontamination,
    language_id,
    license_scan,
    line_dedup,
    lm_scoring,
    mixing,
    near_dedup,
    quality_rules,
    repeated_spans,
    token_alignment,
    topk,
    toxicity,
    vector_codes,
)
from cotalake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify_pages(table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_documents(table(spark, sf_dir, "documents"))


def op6_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), 4)


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.clean_documents(table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_repeated_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeated_spans.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_language_id, op2_source_mixing, op3_decontamination, op4_quality_rules, op5_license_scan,
        op6_minhash_near_dedup, op7_line_dedup, op8_toxicity, op9_exact_topk, op10_lm_scoring,
        op11_vector_codes, op12_repeated_spans, op13_token_alignment,
    )
}

# Shares of one level: children in the order in which they are full, what is left when each comes, and who is full.
def _level(path: list[str], budget: str) -> str:
    depth = len(path)
    level, parents = path[-1], path[:-1]
    keys, part = ", ".join(path), f"PARTITION BY {', '.join(parents)}" if parents else ""
    weights = mixing.WEIGHTS.get(level, {})
    weight = f"CASE {level} {' '.join(f"WHEN '{k}' THEN {v}" for k, v in weights.items())} ELSE 1 END" if weights else "1"
    source = f"(SELECT c.*, p.share AS budget FROM c{depth} c JOIN share{depth - 1} p USING ({', '.join(parents)}))" if parents else f"(SELECT *, ({budget}) AS budget FROM c{depth})"
    return f"""c{depth} AS (SELECT {keys}, sum(capacity)::HUGEINT AS cap, ({weight})::HUGEINT AS w FROM leaves GROUP BY {keys}),
    o{depth} AS (SELECT *, greatest(budget - coalesce(sum(cap) OVER (x ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0), 0)::HUGEINT AS lft,
      (sum(w) OVER (x ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::HUGEINT AS shared
      FROM {source} WINDOW x AS ({part} ORDER BY cap::DOUBLE / w::DOUBLE, {level})),
    f{depth} AS (SELECT *, cap * shared <= lft * w AS filled FROM o{depth}),
    share{depth} AS (SELECT {keys}, CASE WHEN filled THEN cap ELSE
      greatest(budget - coalesce(sum(cap) FILTER (filled) OVER ({part}), 0), 0)::HUGEINT * w // (sum(w) FILTER (NOT filled) OVER ({part}))::HUGEINT END AS share FROM f{depth})"""


_MIX = rf"""WITH counted AS (SELECT doc_id, coalesce('d' || (nullif(regexp_extract(source, '([0-9]{{1,9}})$', 1), '')::BIGINT % 4), '') AS domain,
      coalesce(lang, '') AS lang, coalesce(source, '') AS source, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n_tokens FROM documents),
    live AS (SELECT * FROM counted WHERE n_tokens > 0),
    leaves AS (SELECT domain, lang, source, sum(n_tokens) AS once, 2 * sum(n_tokens) AS capacity FROM live GROUP BY ALL),
    {_level(["domain"], "SELECT sum(once) // 2 FROM leaves")},
    {_level(["domain", "lang"], "")},
    {_level(["domain", "lang", "source"], "")},
    plan AS (SELECT domain, lang, source, (share // once)::BIGINT AS whole, (share % once)::BIGINT AS part FROM leaves JOIN share3 USING (domain, lang, source)),
    planned AS (SELECT * FROM live JOIN plan USING (domain, lang, source)),
    epochs AS (SELECT doc_id, domain, lang, source, n_tokens, unnest(range(1, whole + 1)) AS epoch FROM planned),
    ordered AS (SELECT *, coalesce(sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY md5('mix|' || (whole + 1) || '|' || doc_id), doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM planned WHERE part > 0)
    SELECT doc_id, domain, lang, source, n_tokens, epoch, n_tokens AS taken FROM epochs
    UNION ALL SELECT doc_id, domain, lang, source, n_tokens, whole + 1 AS epoch, least(n_tokens, part - start) AS taken FROM ordered WHERE start < part"""

_LINES = r"""WITH line AS (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
    trimmed AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS bare FROM line),
    wide AS (SELECT bare FROM trimmed WHERE bare <> '' GROUP BY bare HAVING count(DISTINCT coalesce(source, chr(0))) >= 6),
    marked AS (SELECT t.*, w.bare IS NOT NULL AS gone FROM trimmed t LEFT JOIN wide w USING (bare)),
    doc AS (SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS removed, bool_and(gone OR bare = '') AND bool_or(gone) AS all_boilerplate,
      string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone) AS cleaned FROM marked GROUP BY doc_id)
    SELECT doc_id, CASE WHEN text = '' THEN 0 ELSE n END AS n_lines, CASE WHEN all_boilerplate THEN 0 ELSE removed END AS n_removed,
      all_boilerplate, CASE WHEN all_boilerplate OR removed = 0 THEN text ELSE cleaned END AS text FROM documents JOIN doc USING (doc_id)"""

# Sets of four-word shingles, links by all shared shingles, and everything reachable.
_NEAR = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
    g AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')]
      ELSE list_distinct([array_to_string(ws[i:i + 3], ' ') FOR i IN range(1, len(ws) - 2)]) END AS items FROM w),
    s AS (SELECT doc_id, unnest(items) AS item FROM g),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.item = b.item AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
    l AS (SELECT a, b FROM p JOIN g x ON x.doc_id = a JOIN g y ON y.doc_id = b WHERE 100 * shared >= 80 * (len(x.items) + len(y.items) - shared)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b AS a, a AS b FROM l),
    r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
    c AS (SELECT a, min(b) AS b FROM r GROUP BY a)
    SELECT doc_id, len(items)::BIGINT AS n_shingles, least(doc_id, coalesce(c.b, doc_id)) AS component_id, doc_id <= coalesce(c.b, doc_id) AS kept
    FROM g LEFT JOIN c ON c.a = doc_id"""

_TOPK = """WITH v AS (SELECT vec_id, [floor(256 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""



# One round: the nearest entry of each part (ties to the lower one), then the floored means; unused entries stay.
def _round(n: int) -> str:
    return f"""a{n} AS (SELECT p.k, p.vec_id, any_value(p.c) AS c, min(256 * (list_inner_product(p.c, p.c) - 2 * list_inner_product(p.c, b.c) + list_inner_product(b.c, b.c))::BIGINT + b.entry) AS best
      FROM p JOIN b{n} b USING (k) GROUP BY p.k, p.vec_id),
    m{n} AS (SELECT k, best % 256 AS entry, i, floor(sum(c[i]) / count(*)) AS mean FROM a{n}, d GROUP BY k, best % 256, i),
    b{n + 1} AS (SELECT b.k, b.entry, coalesce(n.c, b.c) AS c FROM b{n} b LEFT JOIN (SELECT k, entry, list(mean ORDER BY i) AS c FROM m{n} GROUP BY k, entry) n USING (k, entry))"""


_CODES = f"""WITH v AS MATERIALIZED (SELECT vec_id, label, [floor(1024 * x::DOUBLE) FOR x IN embedding] AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    size AS (SELECT max(len(e)) // 4 AS n FROM v),
    d AS (SELECT unnest(range(1, n + 1)) AS i FROM size),
    p AS MATERIALIZED (SELECT vec_id, r.k, e[r.k * n + 1:r.k * n + n] AS c FROM v, size, (SELECT unnest(range(4)) AS k) r),
    o AS (SELECT k, (row_number() OVER (PARTITION BY k ORDER BY vec_id) - 1)::BIGINT AS entry, c FROM p),
    b0 AS MATERIALIZED (SELECT k, entry, c FROM o WHERE entry < 256),
    {_round(0)}, {_round(1)}, {_round(2)}, {_round(3)},
    f AS (SELECT p.k, p.vec_id, min(256 * (list_inner_product(p.c, p.c) - 2 * list_inner_product(p.c, b.c) + list_inner_product(b.c, b.c))::BIGINT + b.entry) AS best
      FROM p JOIN b4 b USING (k) GROUP BY p.k, p.vec_id),
    coded AS (SELECT vec_id, string_agg(lower(lpad(to_hex(best % 256), 2, '0')), '' ORDER BY k) AS code, sum(best // 256)::BIGINT AS error FROM f GROUP BY vec_id),
    books AS (SELECT sha256(string_agg(b.c[d.i]::BIGINT::VARCHAR, ',' ORDER BY b.k, b.entry, d.i)) AS codebooks_sha256 FROM b4 b, d)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM coded JOIN v USING (vec_id), books"""


# Every string of 100 bytes by its hash; bytes as pairs of hexadecimal digits.
_REPEATS = """WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
    s AS (SELECT doc_id, unnest(range(0, len(h) // 2 - 99)) AS i, h FROM d WHERE len(h) >= 200),
    w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 200)) AS m FROM s),
    again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY m ORDER BY doc_id, i) AS r FROM w) WHERE r > 1),
    runs AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run
      FROM (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 100 THEN 0 ELSE 1 END AS new FROM again)),
    gone AS (SELECT doc_id, run, min(i) AS a, max(i) + 100 AS b FROM runs GROUP BY doc_id, run),
    cut AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM gone),
    parts AS (SELECT doc_id, sum(b - a) AS removed, count(*) AS spans, max(b) AS tail, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS body
      FROM cut JOIN d USING (doc_id) GROUP BY doc_id)
    SELECT doc_id, len(h) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed, coalesce(spans, 0) AS n_spans,
      sha256(unhex(coalesce(body, '') || substr(h, 2 * coalesce(tail, 0) + 1))) AS kept_sha256 FROM d LEFT JOIN parts USING (doc_id)"""

SQL: dict[str, str] = {"op2_source_mixing": _MIX, "op6_minhash_near_dedup": _NEAR, "op7_line_dedup": _LINES, "op9_exact_topk": _TOPK, "op11_vector_codes": _CODES, "op12_repeated_spans": _REPEATS}
