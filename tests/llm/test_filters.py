"""Language ID, line dedup, mixing, licenses: small cases, ties, nulls, empty tables, clashing names."""

import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cotalake.llm import language_id, license_scan, line_dedup, mixing

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
ENGLISH = "the cat and the dog went to the house and they were there with the other children of the village"
GERMAN = "der hund und die katze gingen nicht in das haus weil sie schon lange auf der strasse waren"


def _docs(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="module")
def bilingual(spark):
    rows = [(i, ENGLISH + f" number {i}", "en", "a", None) for i in range(30)]
    rows += [(100 + i, GERMAN + f" nummer {i}", "de", "b", None) for i in range(30)]
    return _docs(spark, rows)


def test_text_outweighs_a_wrong_declaration(spark, bilingual):
    model = language_id.train(bilingual)
    asked = _docs(spark, [(1, GERMAN, "en", "x", 0), (2, ENGLISH, None, None, 0), (3, "", "de", "b", 0), (4, None, None, None, 0), (5, "123 !!", "en", "a", 0)])
    found = {r.doc_id: r.language for r in language_id.identify(asked, model, F.col("text"), F.col("lang"), F.col("source")).collect()}
    assert found[1].lang == "de" and found[1].accepted and found[1].declared == "en"
    assert found[2].lang == "en" and found[2].accepted and found[2].declared is None
    assert found[3].n_triples == 0 and not found[3].accepted and found[3].text_lang is None
    assert not found[4].accepted and not found[5].accepted


def test_host_prior_decides_short_texts(spark, bilingual):
    model = language_id.train(bilingual)
    rows = [(i, GERMAN, None, "h.one.example", 0) for i in range(20)] + [(99, "x", None, "h.one.example", 0), (98, "x", None, "new.one.example", 0)]
    found = {r.doc_id: r.language for r in language_id.identify(_docs(spark, rows), model, F.col("text"), F.col("lang"), F.col("source")).collect()}
    assert found[99].lang == "de" and found[98].lang == "de" and found[99].confidence > found[98].confidence


def test_foreign_script_is_undetermined(spark, bilingual):
    model = language_id.train(bilingual)
    rows = [(1, "これは日本語の文章であり、学習した言語ではありません。" * 4, None, None, 0)]
    found = language_id.identify(_docs(spark, rows), model, F.col("text"), F.col("lang"), F.col("source")).first().language
    assert found.lang == "und" and not found.accepted


def test_kept_documents_keep_columns_and_repeats(spark, bilingual):
    extra = bilingual.unionByName(bilingual.where("doc_id = 1")).unionByName(_docs(spark, [(7000, None, "en", "a", None), (7001, "12", "en", "a", None)]))
    extra = extra.withColumn("language", F.lit("own")).withColumn("host", F.lit(1))
    kept = language_id.keep_identified(extra)
    assert kept.columns == extra.columns and kept.count() == 61
    assert {r.language for r in kept.collect()} == {"own"}


def test_language_of_empty_tables(spark, bilingual):
    none = bilingual.limit(0)
    assert language_id.keep_identified(none).count() == 0
    model = language_id.train(bilingual.withColumn("lang", F.lit(None).cast("string")))
    assert model.languages == ()
    found = language_id.identify(bilingual, model, F.col("text"), F.col("lang"), F.col("source"))
    assert {r.language.lang for r in found.collect()} == {"und"}


def test_odd_labels(spark, bilingual, monkeypatch):
    marks = [(200 + i, ENGLISH if i % 2 else GERMAN, m, "c", 0) for i, m in enumerate(["", "other", " ", "und", "UND", " EN ", "De", "xx"] * 2)]
    kept = language_id.keep_identified(bilingual.unionByName(_docs(spark, marks)))
    assert {r.lang for r in kept.where("doc_id < 200").collect()} == {"en", "de"} and kept.count() > 60
    # The rarest of too many languages are one, whatever else is called so.
    monkeypatch.setattr(language_id, "MAX_LANGUAGES", 4)
    many = [(300 + i, f"w{i} " * 20, f"l{i:03}", "d", 0) for i in range(500)] + [(900, "qq zz " * 30, "other", "d", 0), (901, "qq zz " * 30, "other", "d", 0)]
    model = language_id.train(bilingual.unionByName(_docs(spark, many)))
    assert model.languages == ("de", "en", "other") or model.languages == ("de", "en", "l000", "other")
    found = language_id.identify(_docs(spark, many), model, F.col("text"), F.col("lang"), F.col("source"))
    assert found.count() == 502


def test_fusion_matches_brute_force(spark, bilingual):
    """Posterior of each row from the model's table alone: priors without the row's own text, level by level."""
    model = language_id.train(bilingual)
    rows = [(1, ENGLISH, "en", "a.one.example", 0), (2, GERMAN, "de", "a.one.example", 0), (3, "das haus", None, "b.one.example", 0), (4, "of the", "fr", "alone.test", 0),
            (5, "die", "other", "a.one.example", 0), (6, "", "de", "empty.one.example", 0), (7, "und die und", "", None, 0), (7, "und die und", "", None, 0)]
    docs = _docs(spark, rows)
    found = {r.doc_id: r.language for r in language_id.identify(docs, model, F.col("text"), F.col("lang"), F.col("source")).collect()}
    width = len(model.languages) + 1
    texts = [r[1] for r in rows]
    logs, sizes = np.zeros((len(rows), width)), np.zeros(len(rows))
    for first, n, buckets in language_id._triples(pa.array(texts)):
        for k, own in enumerate(np.split(buckets, np.cumsum(n)[:-1])):
            logs[first + k] = model.logs[:, own].astype(float).sum(axis=1) * min(1, language_id.EFFECTIVE / max(len(own), 1))
            sizes[first + k] = len(own)
    soft = lambda x: np.exp(x - x.max()) / np.exp(x - x.max()).sum()
    prior = np.zeros(width)
    prior[-1] = np.log(language_id.UNKNOWN)
    own = np.array([soft(x + prior) if n else np.zeros(width) for x, n in zip(logs, sizes)])
    hosts = [(r[3] or "").lower() for r in rows]
    levels = [[".".join(h.split(".")[-1:]) for h in hosts], [".".join(h.split(".")[-2:]) for h in hosts], hosts]
    corpus = own.sum(axis=0) + 1
    corpus = corpus / corpus.sum()
    marks = [(r[2] if r[2] in model.languages else " other") if r[2] else "" for r in rows]
    keys = [*model.languages, " other", ""]
    given = np.array([sum((p for p, m in zip(own, marks) if m == k), np.zeros(width)) + [3.0 if k == n else 0.3 for n in (*model.languages, "und")] for k in keys])
    given = given / given.sum(axis=0)
    known = {h for h, n in zip(hosts, sizes) if n}
    for k, (doc_id, *_) in enumerate(rows):
        share = corpus
        for level in levels:
            if hosts[k] in known:
                others = np.maximum(sum((p for p, name in zip(own, level) if name == level[k]), np.zeros(width)) - own[k], 0) + language_id.LEAN * share
                share = others / others.sum()
        total = soft(logs[k] + np.log(share) + (np.log(given[keys.index(marks[k])]) if marks[k] else 0))
        names = [*model.languages, "und"]
        assert found[doc_id].lang == names[int(total.argmax())]
        assert abs(found[doc_id].confidence - total.max()) < 1e-6
    # A host's only page is judged by its text and the levels above, not by itself once more.
    assert found[4].host == "alone.test" and found[4].declared == "other"


def test_language_of_very_long_text(spark, bilingual):
    model = language_id.train(bilingual)
    long = (ENGLISH + " ") * 20_000
    found = language_id.identify(_docs(spark, [(1, long, None, None, 0)]), model, F.col("text"), F.col("lang"), F.col("source")).first().language
    assert found.lang == "en" and found.n_triples > 1_000_000


def test_parts_of_pages(spark):
    html = '<html lang="de-AT"><head><style>p{}</style><script>var x="<p>";</script></head><body><!-- no --><p>Guten&nbsp;Tag</p></body></html>'
    row = spark.createDataFrame([(html, "HTTPS://user@Blog.Example.Co.UK:8080/a?b#c")], "html string, url string").select(
        language_id.declared_in(F.col("html")).alias("d"), language_id.visible_text(F.col("html")).alias("t"), language_id.host_of(F.col("url")).alias("h")
    ).first()
    assert row.d == "de" and row.t.split() == ["Guten", "Tag"] and row.h == "blog.example.co.uk"


def _cleaned(spark, rows, **kw):
    return {r.doc_id: r for r in line_dedup.remove_boilerplate(_docs(spark, rows), **kw).select("doc_id", "text", "lines.*").collect()}


def test_lines_on_many_sites_go(spark):
    rows = [(i, f"own line {i}\n  Read more \nend {i}", "en", f"s{i}", 0) for i in range(6)]
    rows += [(10, "seen\nonly", "en", "s0", 0), (11, "seen\nhere", "en", "s1", 0)]
    found = _cleaned(spark, rows)
    assert found[0].text == "own line 0\nend 0" and found[0].n_lines == 3 and found[0].n_removed == 1
    assert found[10].text == "seen\nonly" and found[10].n_removed == 0


def test_threshold_is_exact(spark):
    for sites in (5, 6, 7):
        rows = [(i, f"a{i}\nfooter", "en", f"s{i % sites}", 0) for i in range(40)]
        assert _cleaned(spark, rows)[0].n_removed == (1 if sites >= 6 else 0)


def test_copies_stay_whole_and_odd_texts_are_defined(spark):
    rows = [(i, "copied\n\nwhole", "en", f"s{i}", 0) for i in range(8)]
    rows += [(20, None, "en", "s1", 0), (21, "", "en", "s1", 0), (22, "copied\nbut more", "en", None, 0), (22, "copied\nbut more", "en", None, 0), (None, "copied\nx", None, None, 0)]
    cleaned = line_dedup.remove_boilerplate(_docs(spark, rows)).select("doc_id", "text", "lines.*").collect()
    by = {r.doc_id: r for r in cleaned}
    assert by[0].text == "copied\n\nwhole" and by[0].all_boilerplate and by[0].n_removed == 0
    assert by[20].text is None and by[20].n_lines == 0 and by[21].text == "" and by[21].n_lines == 0
    assert [r.text for r in cleaned if r.doc_id == 22] == ["but more"] * 2
    assert by[None].text == "x"


def test_cleaned_keeps_columns_whatever_their_names(spark):
    rows = [(i, f"own {i}\nfooter", "en", f"s{i}", 99) for i in range(6)]
    docs = _docs(spark, rows).withColumn("lines", F.lit("kept")).withColumn("pos", F.lit(3))
    out = line_dedup.cleaned(docs)
    assert out.columns == docs.columns
    assert {(r.text, r.n_chars, r.lines) for r in out.collect()} == {(f"own {i}", 5, "kept") for i in range(6)}
    assert line_dedup.cleaned(docs.limit(0)).count() == 0


def _mixture(spark, rows, **kw):
    return mixing.mix(_docs(spark, rows), mixing.domain_of(F.col("source")), **kw)


def test_shortage_goes_to_siblings_before_ancestors(spark):
    rows = [(1, "w " * 10, "en", "s0", 0)]  # a small leaf in domain d0
    rows += [(100 + i, "w " * 10, "en", "s4", 0) for i in range(100)]  # its sibling
    rows += [(300 + i, "w " * 10, "en", "s1", 0) for i in range(100)]  # another domain
    taken = {r.source: r.t for r in _mixture(spark, rows, max_epochs=1).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    budget = 2010 // 2
    assert taken["s0"] == 10 and taken["s1"] == budget // 2
    assert taken["s4"] == budget // 2 - 10


def test_shortage_of_a_subtree_goes_up(spark):
    rows = [(1, "w " * 10, "en", "s0", 0), (2, "w " * 10, "de", "s4", 0)]
    rows += [(300 + i, "w " * 10, "en", "s1", 0) for i in range(100)]
    taken = {r.source: r.t for r in _mixture(spark, rows, max_epochs=2).groupBy("source").agg(F.sum("taken").alias("t")).collect()}
    assert taken == {"s0": 20, "s4": 20, "s1": 1020 // 2 - 40}


def test_prefix_cuts_inside_a_document_and_is_seeded(spark):
    rows = [(i, "w " * 7, "en", "s0", 0) for i in range(50)]
    out = _mixture(spark, rows, budget_share=(1, 3)).collect()
    assert sum(r.taken for r in out) == 350 // 3
    assert sorted(r.taken for r in out)[:-1][-1] == 7 and sum(r.taken < 7 for r in out) == 1
    again = {r.doc_id for r in _mixture(spark, rows, budget_share=(1, 3)).collect()}
    other = {r.doc_id for r in _mixture(spark, rows, budget_share=(1, 3), seed="else").collect()}
    assert again == {r.doc_id for r in out} and other != again


def test_mixture_of_odd_rows(spark):
    rows = [(1, None, "en", "s0", 0), (2, "", "en", "s0", 0), (3, " \n", None, None, 0), (4, "a b", None, None, 0), (4, "a b", None, None, 0), (None, "c d", "en", "none", 0)]
    out = _mixture(spark, rows, budget_share=(1, 1), max_epochs=1).collect()
    assert sorted((r.doc_id or 0, r.domain, r.taken) for r in out) == [(0, "", 2), (4, "", 2), (4, "", 2)]
    assert _mixture(spark, []).count() == 0
    assert _mixture(spark, rows, budget_share=(0, 1)).count() == 0
    assert _mixture(spark, rows, weights={"lang": {"en": 0, "": 0}}).count() == 0


def test_rows_without_id_spread_over_the_ranges_of_a_leaf(spark, monkeypatch):
    """Equal seeded keys are told apart by text, so the documents sorted at the cut are few."""
    rows = [(None, f"w{i} x y", "en", "s0", 0) for i in range(3000)] + [(None, "same one here", "en", "s0", 0)] * 500
    docs = _docs(spark, rows)
    out = mixing.mix(docs, mixing.domain_of(F.col("source")), budget_share=(1, 3), max_epochs=1, with_text=True).collect()
    assert sum(r.taken for r in out) == 3500 * 3 // 3 and all(1 <= r.taken <= 3 for r in out)
    assert all(len(r.text.split()) == r.taken for r in out) and sum(r.taken < 3 for r in out) <= 1
    counted = mixing.written(mixing._rows(docs, F.lit("d")), "t")
    plan = counted.select("domain", "lang", "source").distinct().withColumns({"whole": F.lit(0).cast("long"), "part": F.lit(3500).cast("long")})
    ordered = mixing._ordered(counted, plan, "mix")
    prefix, before = mixing._cuts(ordered).select("prefix", "before").first()
    at_cut = ordered.where(F.startswith("place", F.lit(prefix)))
    assert at_cut.count() <= 510 and at_cut.select("place").distinct().count() <= 5 and before <= 3500


def test_mixture_yields_its_tokens(spark):
    rows = [(i, f"Tok{i}  b{i}\tc{i}\n d{i}", "en", "s0", 0) for i in range(7)] + [(9, "", "en", "s0", 0), (10, None, "en", "s0", 0)]
    plain = _mixture(spark, rows, budget_share=(5, 14)).drop("text")
    out = _mixture(spark, rows, budget_share=(5, 14), with_text=True)
    assert sorted(map(tuple, out.drop("text").collect())) == sorted(map(tuple, plain.collect()))
    texts = {i: t for i, t, *_ in rows}
    taken = out.collect()
    assert sum(r.taken for r in taken) == 10 and sorted(r.taken for r in taken) == [2, 4, 4]
    for r in taken:
        assert r.text == texts[r.doc_id] if r.taken == 4 else r.text.split() == texts[r.doc_id].split()[: r.taken]


def test_equal_rows_at_the_cut_count_each(spark):
    rows = [(1, "a b c", "en", "s0", 0)] * 5
    out = _mixture(spark, rows, budget_share=(7, 15), max_epochs=1).collect()
    assert sorted(r.taken for r in out) == [1, 3, 3] and {r.epoch for r in out} == {1}
    out = _mixture(spark, rows, budget_share=(20, 15), max_epochs=2).collect()
    assert sorted((r.epoch, r.taken) for r in out) == [(1, 3)] * 5 + [(2, 2), (2, 3)]


def _scan(spark, texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in license_scan.scan_documents(docs).collect()}


def test_base_phrases_and_labels(spark):
    found = _scan(spark, ["Released UNDER the MIT-License. under the mit license", "CC BY-NC 4.0", None, "", "under the mitt license", "apache license, version 2.0!"])
    assert (found[0].n_words, found[0].n_base, found[0].first_word, found[0].last_word, found[0].base_labels) == (9, 2, 1, 5, "mit")
    assert found[1].base_labels == found[1].labels == "cc-by-nc"
    for k in (2, 3):
        assert (found[k].n_words, found[k].n_base, found[k].first_word, found[k].labels, found[k].score) == (0, 0, None, "", 0.0)
    assert found[4].n_base == 0 and found[5].base_labels == "apache-2" and 0.9 < found[5].score <= 1


def test_rules_name_more_licenses_and_longer_intervals_win():
    scanner = license_scan.Scanner()
    assert len(scanner.rules) >= 300
    _, found = scanner.scan(b"this work is licensed under the gnu general public license, version 3.")
    assert [f["label"] for f in found] == ["gpl-3"]  # the bare mention inside is suppressed
    _, found = scanner.scan(b"licensed under the apache license, version 2.0. all rights reserved")
    assert [f["label"] for f in found] == ["apache-2", "all-rights-reserved"]
    _, found = scanner.scan(b"spdx-license-identifier: mpl-2.0")
    assert [(f["label"], f["first_word"], f["last_word"]) for f in found][0][0] == "mpl-2"


def test_containment_matches_brute_force():
    scanner = license_scan.Scanner()
    text = b"released under the terms of the mit license mit license apache license version 2 0 license cc by sa 4 0 gnu gpl v3 licensed under gpl v3 or later " * 5
    words = b" " + b" ".join(re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)) + b" "
    hits = sorted((-r.priority, m.start() - m.end(), k, m.start(), m.end()) for k, r in enumerate(scanner.rules) for m in r.pattern.finditer(words))
    kept = []
    for h in hits:
        if not any(s <= h[3] and e >= h[4] for s, e in kept):
            kept.append((h[3], h[4]))
    assert len(scanner.scan(text)[1]) == len(kept)
