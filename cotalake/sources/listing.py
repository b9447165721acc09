"""Links of web directory listings, as expressions over a table of landed pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake.functions import text
from cotalake.operators.cleaning import distinct_by_key

# A dated listing entry and the file kinds of interest.
DATED_LINK = r'(?i)<a\s+href="([^"]+)">[^<]*</a>\s+(\d{2}-[A-Za-z]{3}-\d{4}\s+\d{2}:\d{2})'
PLAIN_LINK = r'(?i)<a\s+href="([^"]+)">[^<]*</a>()'
FILE_SUFFIXES = (".zip", ".csv", ".txt", ".xml")

ORIGIN = r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)"


def _resolve_dots(path: Column) -> Column:
    """Apply ``.`` and ``..`` segments; paths without them are returned untouched."""
    kept = F.aggregate(
        F.split(path, "/"),
        F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1))))
        .when(part == ".", done)
        .otherwise(F.concat(done, F.array(part))),
    )
    ends_open = path.rlike(r"/\.\.?$")
    joined = F.array_join(kept, "/")
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.when(ends_open, F.concat(joined, F.lit("/"))).otherwise(joined)).otherwise(
        path
    )


def join_url(base: Column, href: Column) -> Column:
    """A link as seen from its page: absolute, scheme-relative, root-relative, or relative."""
    origin = F.regexp_extract(base, ORIGIN, 1)
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    bare = F.regexp_replace(base, r"[?#].*$", "")
    path = F.substring(bare, F.length(origin) + 1, F.length(bare))
    folder = F.when(path.contains("/"), F.regexp_replace(path, r"[^/]*$", "")).otherwise(F.lit("/"))
    target = F.regexp_extract(href, r"^([^?#]*)", 1)
    rest = F.substring(href, F.length(target) + 1, F.length(href))
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(scheme, href))
        .when(href.startswith("/"), F.concat(origin, _resolve_dots(target), rest))
        .when(href.startswith("#"), F.concat(F.regexp_replace(base, r"#.*$", ""), href))
        .when(href.startswith("?"), F.concat(bare, href))
        .otherwise(F.concat(origin, _resolve_dots(F.concat(folder, target)), rest))
    )


def url_path(url: Column) -> Column:
    """The path of a URL, without query, fragment and trailing parameters."""
    bare = F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r";[^/]*$", "")
    return F.regexp_replace(bare, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")


def find_links(
    pages: DataFrame, page: str, base: str, html: str,
    pattern: str = DATED_LINK, suffixes: Sequence[str] | None = FILE_SUFFIXES,
) -> DataFrame:
    """Every wanted link, repeated ones included: (pagina, posicao, url, nome, modificado).

    Pages unfold row by row with no shuffle. Folder links and other suffixes go; without ``suffixes`` all others stay.
    """
    entries = F.posexplode(F.regexp_extract_all(html, F.lit(pattern), 0)).alias("posicao", "_entry")
    found = pages.select(F.col(page).alias("pagina"), F.col(base).alias("_base"), entries)
    # Only the short entry is matched a second time, not the page.
    href = F.regexp_extract("_entry", pattern, 1)
    when = F.regexp_replace(F.regexp_extract("_entry", pattern, 2), r"\s+", " ")
    linked = found.withColumn("_href", href).filter(~F.endswith("_href", F.lit("/"))).select(
        "pagina",
        "posicao",
        join_url(F.col("_base"), F.col("_href")).alias("url"),
        F.try_to_timestamp(F.initcap(when), F.lit("dd-MMM-yyyy HH:mm")).alias("modificado"),
    )
    path = url_path(F.col("url"))
    wanted = F.lit(suffixes is None)
    for suffix in suffixes or ():
        wanted = wanted | F.endswith(F.lower(path), F.lit(suffix))
    return linked.filter(wanted).withColumn("nome", text.last_path_segment(path))


def distinct_by_url(links: DataFrame, order: Sequence[str] = ("pagina", "posicao")) -> DataFrame:
    """First mention of each URL; a URL that every page carries sends one row per task."""
    return distinct_by_key(links, ["url"], order)


def sort_by_name(links: DataFrame) -> DataFrame:
    """By name; the unique URL breaks ties, so equal names still spread over the range partitions."""
    return links.orderBy("nome", "url")


def extract_listing_links(
    pages: DataFrame, page: str = "page_id", base: str = "url", html: str = "html",
    pattern: str = DATED_LINK, suffixes: Sequence[str] = FILE_SUFFIXES,
) -> DataFrame:
    links = find_links(pages, page, base, html, pattern, suffixes)
    return sort_by_name(distinct_by_url(links)).select("url", "nome", "modificado")


# Fixed values: (required suffix, required part) pairs; one match is enough.
RELEVANT = ((".zip", "registro_fundo_classe"), ("", "inf_diario"))


def classify_resource(name: Column, rules: Sequence[tuple[str, str]] = RELEVANT) -> Column:
    lowered = F.lower(name)
    relevant = F.lit(False)
    for suffix, part in rules:
        relevant = relevant | (F.endswith(lowered, F.lit(suffix)) & F.contains(lowered, F.lit(part)))
    return relevant


def consolidate_sources(sources: Sequence[DataFrame], rules: Sequence[tuple[str, str]] = RELEVANT) -> DataFrame:
    """Append listings, keep the first source's row per URL, keep relevant ones, sort by name.

    Each source brings url, nome, modificado and ``posicao`` within the source.
    """
    union: DataFrame | None = None
    for ordinal, source in enumerate(sources):
        part = source.withColumn("fonte", F.lit(ordinal))
        union = part if union is None else union.unionByName(part)
    relevant = union.filter(classify_resource(F.col("nome"), rules))
    unique = distinct_by_url(relevant, ["fonte", "posicao", "nome"])
    return sort_by_name(unique).select("url", "nome", "modificado", "fonte")
