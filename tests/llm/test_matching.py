"""Near-dedup, decontamination, top-k and the pipeline against brute force, with odd rows."""

import itertools
import os
import re

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cotalake.llm import catalog, decontamination, near_dedup, topk
from cotalake.llm import text as T

SF = "/root/testdata/sf0.001"


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def _groups(texts, width, percent=80):
    """Components by comparing all pairs of sets."""
    sets = {}
    for i, t in texts.items():
        w = _words(t)
        sets[i] = {tuple(w[a : a + width]) for a in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    label = {i: i for i in sets}

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            label[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def _copies(seed, groups, size, words=40):
    random = np.random.default_rng(seed)
    texts = []
    for g in range(groups):
        base = [f"g{g}w{random.integers(0, 10_000)}" for _ in range(words)]
        for _ in range(size):
            text = list(base)
            for _ in range(int(random.integers(0, 4))):
                text[int(random.integers(0, words))] = f"x{random.integers(0, 1 << 30)}"
            texts.append(" ".join(text))
    return dict(enumerate(random.permutation(texts).tolist()))


@pytest.mark.parametrize("width", [4, 5])
def test_components_match_brute_force(spark, width):
    texts = _copies(1, 6, 25) | _copies(2, 1, 5) | {900: None, 901: "", 902: " \n", 903: "one two", 904: "One TWO", 905: "one"}
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in texts.items()], "doc_id long, text string, n int, component_id string")
    found = {r.doc_id: r for r in near_dedup.near_duplicates(docs, width).collect()}
    for i, (n, component) in _groups(texts, width).items():
        assert (found[i].n_shingles, found[i].component_id, found[i].kept) == (n, component, i == component)


def test_a_common_passage_does_not_link(spark):
    random = np.random.default_rng(5)
    passage = " ".join(f"p{i}" for i in range(30))
    texts = {i: passage + " " + " ".join(f"w{random.integers(0, 1 << 40)}" for _ in range(12)) for i in range(60)}
    texts |= {100 + i: passage + f" tail{i}" for i in range(20)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dedup.near_duplicates(docs, 4).collect()}
    assert found == _groups(texts, 4)


def test_near_copies_of_any_text_of_an_id_are_linked(spark):
    a = " ".join(f"a{i}" for i in range(40))
    b = " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(5, a), (5, b), (6, b + " more"), (7, "more " + a), (8, b), (9, "c d e f g h")], "doc_id long, text string")
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, 4).collect()}
    assert found == {(5, 5, True), (6, 5, False), (7, 5, False), (8, 5, False), (9, 9, True)}


def test_repeated_and_null_ids(spark):
    a, b, c = ("a b c d e f g h", "q r s t u v w x", "k l m n o p a b")
    docs = spark.createDataFrame([(5, a), (5, b), (6, b), (7, a), (8, c), (8, c), (None, a)], "doc_id long, text string")
    found = {(r.doc_id, r.component_id, r.kept) for r in near_dedup.near_duplicates(docs, 4).collect()}
    assert found == {(5, 5, True), (6, 5, False), (7, 5, False), (8, 8, True), (None, None, True)}
    kept = near_dedup.drop_near_duplicates(docs.withColumn("node", F.lit(1)), 4)
    assert kept.columns == ["doc_id", "text", "node"] and sorted(str(r.doc_id) for r in kept.collect()) == ["5", "5", "8", "8", "None"]
    assert near_dedup.near_duplicates(docs.limit(0), 4).count() == 0


def test_estimate_is_corrected_for_chance():
    random = np.random.default_rng(7)
    share, whole = [], []
    for _ in range(60):
        common = random.integers(0, 1 << 63, 400, np.uint64)
        a, b = (np.unique(np.concatenate([common, random.integers(0, 1 << 63, 50, np.uint64)])) for _ in range(2))
        low = (near_dedup._minima([a, b]) >> np.uint64(20)) & np.uint64(3)
        share.append(((low[0] == low[1]).mean() - 0.25) / 0.75)
        whole.append(400 / 500)
    assert abs(np.mean(share) - np.mean(whole)) < 0.02


def test_components_of_chains(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 99), (99, 98), (7, 3)], "a long, b long")
    found = dict(near_dedup.components(links).collect())
    assert found == {**{i: 1 for i in range(1, 41)}, 98: 98, 99: 98, 100: 98}


def _bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.fixture(scope="module")
def corpus():
    random = np.random.default_rng(11)
    vocabulary = [f"v{chr(97 + i % 26)}{i}" for i in range(900)]
    draw = lambda n: [vocabulary[min(int(x), 899)] for x in random.exponential(150, n)]
    items = {i: draw(20 + 3 * i) for i in range(12)}
    docs = {i: draw(int(random.integers(10, 400))) for i in range(150)}
    docs[200] = draw(90) + items[3] + draw(71)
    docs[201] = [w.upper() for w in items[9]]
    swapped = [w if i % 5 else "other" for i, w in enumerate(items[6])]
    docs[202] = draw(33) + swapped + draw(150)
    return {k: " ".join(v) for k, v in docs.items()}, {k: " ".join(v) for k, v in items.items()}


def test_leaks_are_found_and_clean_documents_left(spark, corpus):
    texts, items = corpus
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in texts.items()] + [(None, items[1], 0.1), (203, None, 0.1), (204, "", 0.1)], "doc_id long, text string, cosine double")
    bench = _bench(spark, [*items.items(), (50, None), (51, "too short"), (None, items[2]), (3, items[3])])
    pairs = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(docs, bench).collect()}
    assert set(pairs) == {(200, 3), (201, 9), (202, 6), (None, 1)}
    assert pairs[(200, 3)].common == 1.0 and pairs[(202, 6)].common < 0.85
    kept = decontamination.drop_leaks(docs, bench)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {*texts, 203, 204, None} - {200, 201, 202}
    assert decontamination.find_leaks(docs.limit(0), bench).count() == 0
    assert decontamination.find_leaks(docs, bench.limit(0)).count() == 0


def test_items_without_id_short_items_and_scripts_without_spaces(spark, corpus):
    texts, items = corpus
    chinese = "机器学习模型需要大量高质量的训练数据才能取得良好的效果"
    short = "what is the capital of france"
    docs = [*texts.items(), (300, "so " + items[1] + " it is"), (301, "先前" * 30 + chinese + "之后" * 30), (302, f"quiz: What is\nthe capital of France? {texts[0]}"), (303, "the capital of france is what is")]
    bench = [(None, items[1]), (None, items[4]), (60, chinese), (61, short), (62, "of france"), (63, short)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(frame, _bench(spark, bench)).collect()}
    assert set(found) == {(300, None), (301, 60), (302, 61), (302, 63)}
    assert found[302, 61].route == "verbatim" and found[302, 61].cosine is None and found[300, None].route in ("both", "words")
    assert decontamination.drop_leaks(frame, _bench(spark, bench)).count() == len(docs) - 3


def test_rows_of_one_item_beyond_a_block(spark, corpus, monkeypatch):
    texts, items = corpus
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 4)
    rows = [(7, items[k]) for k in range(12)] + [(None, items[k]) for k in (3, 6)]
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = sorted((r.doc_id, r.item_id or 0) for r in decontamination.find_leaks(frame, _bench(spark, rows)).collect())
    assert found == [(200, 0), (200, 7), (201, 7), (202, 0), (202, 7)]
    long = " ".join(f"q{i}" for i in range(3000))
    part = " ".join(f"q{i}" for i in range(2000, 2040))
    frame = spark.createDataFrame([(1, part), (1, "else")], "doc_id long, text string")
    assert [(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame, _bench(spark, [(5, long)])).collect()] == [(1, 5)]


def test_both_routes_find_close_copies(spark, corpus):
    """Whole items within other text are near by cosine; each route alone finds them too."""
    texts, items = corpus
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: r for r in decontamination.find_leaks(frame, _bench(spark, list(items.items()))).collect()}
    assert {found[d].route for d in (200, 201)} == {"both"} and found[201].cosine > decontamination.NEAR


def test_nearness_decides_about_words_in_another_order(spark, corpus):
    texts, items = corpus
    frame = spark.createDataFrame([*texts.items(), (210, " ".join(reversed(items[7].split())))], "doc_id long, text string")
    bench = _bench(spark, list(items.items()))
    found = {(r.doc_id, r.item_id): r for r in decontamination.find_leaks(frame, bench).collect()}
    assert set(found) == {(200, 3), (201, 9), (202, 6), (210, 7)}
    assert found[210, 7].route == "cosine" and found[210, 7].common < decontamination.PARAPHRASE and found[210, 7].cosine > decontamination.NEAR
    assert 210 not in {r.doc_id for r in decontamination.drop_leaks(frame, bench).collect()}


def test_very_long_document_holds_a_leak(spark, corpus):
    texts, items = corpus
    long = " ".join(list(texts.values()) * 40)
    frame = spark.createDataFrame([(1, long + " " + items[5] + " " + long), (2, long)], "doc_id long, text string")
    leak = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(frame, _bench(spark, [(5, items[5])])).collect()}
    assert leak == {(1, 5)}


def test_items_in_blocks_give_the_same(spark, corpus, monkeypatch):
    texts, items = corpus
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    monkeypatch.setattr(decontamination, "ITEM_BLOCK", 5)
    pairs = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(docs, _bench(spark, list(items.items()))).collect()}
    assert pairs == {(200, 3), (201, 9), (202, 6)}


def _subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before, row = row, [0] * (len(b) + 1)
        for j, y in enumerate(b):
            row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
    return row[-1]


def test_short_and_changed_excerpts_in_long_documents_match_brute_force(spark):
    random = np.random.default_rng(31)
    vocabulary = np.array([f"w{i}" for i in range(3000)])
    chance = 1 / np.arange(3, 3003)
    draw = lambda n: random.choice(vocabulary, n, p=chance / chance.sum()).tolist()
    items = {i: draw(n) for i, n in enumerate([8, 8, 10, 10, 12, 12, 15, 15, 18, 18, 25, 32] * 3)}
    docs = {}
    for i, words in items.items():
        for k, changed in enumerate((0.0, 0.2, 0.35)):
            excerpt = [draw(1)[0] if random.random() < changed else w for w in words]
            at = int(random.integers(0, 300))
            text = draw(300)
            docs[i * 10 + k] = text[:at] + excerpt + text[at:]
    found = {
        (r.doc_id, r.item_id)
        for r in decontamination.find_leaks(
            spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()], "doc_id long, text string"),
            _bench(spark, [(i, " ".join(w)) for i, w in items.items()]),
        ).collect()
    }
    copies = set()
    for d, words in docs.items():
        for left in range(-16, len(words) - 16, 16):
            window = words[max(left, 0) : left + 64]
            held = set(window)
            for i, item in items.items():
                if sum(w in held for w in item) >= 0.8 * len(item) and _subsequence(item, window) >= 0.8 * len(item):
                    copies.add((d, i))
    assert copies >= {(i * 10, i) for i in items} and copies <= found


def test_block_sums_and_word_codes_match_brute_force(monkeypatch):
    random = np.random.default_rng(5)
    terms, counts = random.integers(0, 40, 700) * 37, np.array([0, 1, 15, 16, 17, 600, 0, 51])
    probe = np.vstack([random.integers(-9, 9, (decontamination.TERMS, decontamination.RANK)), np.zeros((1, decontamination.RANK))]).astype(np.float32)
    monkeypatch.setattr(decontamination, "TOGETHER", 7)
    blocks, runs = decontamination._blocks(counts, terms)
    cut = [own[at : at + decontamination.STEP] for own in np.split(terms, np.cumsum(counts)[:-1]) for at in range(0, len(own), decontamination.STEP)]
    assert runs.sum() == len(cut)
    assert (decontamination._project(blocks, probe) == [probe[c].sum(axis=0) for c in cut]).all()
    total, held = np.zeros((decontamination.RANK, decontamination.TERMS + 1)), np.zeros(decontamination.TERMS + 1, np.int64)
    expected, blocks_with = np.zeros((decontamination.TERMS, decontamination.RANK)), np.zeros(decontamination.TERMS, np.int64)
    for c in cut:
        np.add.at(expected, c, probe[c].sum(axis=0))
        blocks_with[np.unique(c)] += 1
    decontamination._add_products(total, held, blocks, probe)
    assert (total.T[:-1] == expected).all() and (held[:-1] == blocks_with).all() and held[-1] == len(cut)

    # Words that share their first bits with one of an item are searched, all others are not.
    items = decontamination.cut_items(["one two three four five six seven eight nine ten"])
    space = decontamination.Space(np.ones(decontamination.TERMS, np.float32), probe[:-1])
    latent = decontamination._Latent(items, space)
    own = np.concatenate(items.words)
    hashes = np.concatenate([own, own + np.uint64(1), own - np.uint64(1), random.integers(0, 2**63, 5000).astype(np.uint64) * np.uint64(2), np.array([0, 2**64 - 1], np.uint64)])
    place = {h: i for i, h in enumerate(latent.vocabulary.tolist())}
    assert latent.codes(hashes).tolist() == [place.get(h, latent.none) for h in hashes.tolist()]
    searched = []
    monkeypatch.setattr(np, "searchsorted", lambda a, v, find=np.searchsorted: searched.append(len(v)) or find(a, v))
    latent.codes(hashes)
    assert sum(searched) < 100


def test_common_subsequence_matches_dynamic_programming():
    random = np.random.default_rng(3)
    for _ in range(20):
        a, b = random.integers(0, 6, 20), random.integers(0, 6, 30)
        table = np.zeros((21, 31), int)
        for i in range(20):
            for j in range(30):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        places = decontamination.Places.of([np.array([1, 2]), a], [np.ones(2), np.arange(20.0)], 8)
        bits, held = places.found(np.array([1]), b[None, :])
        assert decontamination._common(bits)[0] == table[-1, -1]
        rarest = list(dict.fromkeys(a[::-1].tolist()))[:4]
        assert np.bitwise_count(held)[0] == len(set(rarest) & set(b.tolist()))


def _best(rows, queries, k):
    out = set()
    for q, v in rows:
        if q not in queries:
            continue
        scored = sorted({(-sum(x * y for x, y in zip(v, c)), i) for i, c in rows if i != q})[:k]
        out |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)}
    return out


@pytest.mark.parametrize("scale", [1.0, 3e5])
def test_top_k_matches_brute_force(spark, scale, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    monkeypatch.setattr(topk, "DIMENSIONS", 4)
    random = np.random.default_rng(4)
    vectors = [(i, [float(x) for x in random.standard_normal(14) * scale]) for i in range(70)]
    vectors += [(100 + i, vectors[3][1]) for i in range(8)]  # ties
    odd = [(200, None), (201, [float("nan")] * 14), (202, [1.0, None] * 7), (203, []), (None, [1.0] * 14), (204, [float("inf")] * 14)]
    df = spark.createDataFrame([(i, v, 1) for i, v in vectors + odd], "vec_id long, embedding array<double>, rank int").repartition(3)
    found = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 10 == 0, 5).collect()}
    ints = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in vectors]
    assert found == _best(ints, {i for i, _ in vectors if i % 10 == 0}, 5)


def test_top_k_counts_repeated_rows_once(spark, monkeypatch):
    monkeypatch.setattr(topk, "DIMENSIONS", 2)
    random = np.random.default_rng(8)
    vectors = [(i, [float(x) for x in random.integers(-3, 4, 6)]) for i in range(12)]
    vectors += [(7, [9.0] * 6)] * 8  # one row many times
    vectors += [(5, [9.0, 9.0, 9.0, 9.0, 9.0, 9.0][: 6 - z] + [0.0] * z) for z in range(6)]  # one id, several vectors
    df = spark.createDataFrame([(i, v) for i, v in vectors] + [(0, [1.0, 1.0, 0.0, 0.0, 0.0, 0.0])], "vec_id long, embedding array<double>").coalesce(1)
    ints = [(i, [int(256 * x) for x in v]) for i, v in [*vectors, (0, [1.0, 1.0, 0.0, 0.0, 0.0, 0.0])]]
    found = {tuple(r) for r in topk.top_k(df, F.col("vec_id") == 0, 5).collect()}
    scored = sorted({(-sum(x * y for x, y in zip(q, c)), i) for j, q in ints if j == 0 for i, c in ints if i != 0})[:5]
    assert found == {(0, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)}
    copies = spark.createDataFrame([(7, [9.0, 9.0])] * 6 + [(i, [1.0, float(i)]) for i in range(4)], "vec_id long, embedding array<double>").coalesce(1)
    assert topk.top_k(copies, F.col("vec_id") == 0, 5).count() == 4


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (50, [2.0, 1.0]), (50, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 50 == 0).collect()} == {(0, 1, 50, 131072), (50, 1, 0, 131072)}
    assert topk.top_k(df.limit(0), F.lit(True)).count() == 0
    assert topk.top_k(df, F.lit(False)).count() == 0


def test_top_k_broadcasts_no_vectors(spark, monkeypatch):
    """Queries were copied once per block of candidates before a join that Spark took for small and broadcast."""
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 32)
    random = np.random.default_rng(12)
    vectors = [(i, [float(x) for x in random.integers(-2, 3, 32)]) for i in range(1200)]
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(3)
    name = "spark.sql.maxBroadcastTableSize"
    before = spark.conf.get(name)
    spark.conf.set(name, "4m")
    try:
        found = {tuple(r) for r in topk.top_k(df, F.lit(True), 3).collect()}
    finally:
        spark.conf.set(name, before)
    assert len(found) == 3600
    ints = [(i, [int(256 * x) for x in v]) for i, v in vectors]
    assert {r for r in found if r[0] % 100 == 0} == _best(ints, set(range(0, 1200, 100)), 3)


@pytest.mark.parametrize("kinds", ["few", "wide"])
def test_top_k_in_groups_and_slices(spark, kinds, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK", 8)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    monkeypatch.setattr(topk, "SLICE", 1)
    monkeypatch.setattr(topk, "BLOCK_VALUES", 40)
    monkeypatch.setattr(topk, "GROUP_VALUES", 100)
    random = np.random.default_rng(13)
    scales = [1.0] if kinds == "few" else [1.0, 300.0, 1e9, 1e14]
    vectors = [(i // 2, [float(x) for x in random.integers(-3, 4, 1 + i % 9) * scales[i % len(scales)]]) for i in range(90)]
    vectors += [(500, [1.0] * 300)]  # longer than a block
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<double>").repartition(2)
    found = {tuple(r) for r in topk.top_k(df, F.col("vec_id") % 3 != 0, 4).collect()}
    least, most = -(1 << 63), (1 << 63) - 1
    ints = [(i, [int(256 * x) for x in v]) for i, v in vectors]
    expected = set()
    for q in {i for i, _ in ints if i % 3}:
        scored = {(-max(least, min(most, sum(x * y for x, y in zip(v, c)))), i) for j, v in ints if j == q for i, c in ints if i != q}
        expected |= {(q, rank + 1, i, -s) for rank, (s, i) in enumerate(sorted(scored)[:4])}
    assert found == expected


def test_top_k_bounds_drop_no_result(monkeypatch):
    """Blocks pass one after another; survivors of two dimensions are finished one by one."""
    monkeypatch.setattr(topk, "DIMENSIONS", 2)
    monkeypatch.setattr(topk, "FEW", 1.0)
    monkeypatch.setattr(topk, "TILE", 3)
    random = np.random.default_rng(14)
    for scale in (5, 3000, 1 << 30, 1 << 45):
        rows = [(int(i), [int(x) for x in random.integers(-scale, scale + 1, 11) // [1, 1, 1, *[4] * 8]]) for i in random.integers(0, 90, 300)]
        matrix = np.array([v for _, v in rows])
        ids = np.array([i for i, _ in rows])
        group = topk.Group(ids[:8], matrix[:8], 4)
        for lo in range(0, 300, 70):
            group.search(ids[lo : lo + 70], np.ascontiguousarray(matrix[lo : lo + 70].T))
        for row in range(8):
            scored = {(-max(-(1 << 63), min((1 << 63) - 1, sum(x * int(y) for x, y in zip(c, group.vectors[row])))), i) for i, c in rows if i != group.ids[row]}
            assert list(zip((-x for x in group.scores[row].tolist()), group.found[row].tolist())) == sorted(scored)[:4]


def test_words_hash_to_what_the_operators_see():
    assert T.hash_word("abc") == T.hash_word("ABC") != T.hash_word("abd")


@pytest.mark.skipif(not os.path.isdir(SF), reason="no supplied tables")
@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_queries_match_their_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = catalog.QUERIES[name](spark, SF)
    result = con.execute(catalog.SQL[name])
    columns = [c[0] for c in result.description]
    pick = [columns.index(c) for c in df.columns]
    assert sorted(map(str, ([r[c] for c in df.columns] for r in df.collect()))) == sorted(map(str, ([r[i] for i in pick] for r in result.fetchall())))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no supplied tables")
def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    texts = dict(docs.select("doc_id", "text").collect())
    at = docs
    for name, stage in corpus_pipeline.STAGES[:3]:
        at = corpus_pipeline.written(stage(spark, at, SF), name)
        assert at.columns == docs.columns
        if name == "language_id":
            assert at.count() >= 0.99 * len(ids)
        if name == "line_dedup":
            texts = dict(at.select("doc_id", "text").collect())
    expected = {i for i, (_, c) in _groups(texts, 5).items() if i == c}
    assert {r.doc_id for r in at.collect()} == expected
    run = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "epoch", "taken"} <= set(run.columns)
    assert {r.doc_id for r in run.collect()} <= expected
    assert corpus_pipeline.ORACLE_SQL is None and 4 <= len(corpus_pipeline.STAGES) <= 5
