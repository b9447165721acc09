"""Text helpers, quality rules, toxicity, LM scoring: brute force, gradients, held-out accuracy, odd rows."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cotalake.llm import lm_scoring, quality_rules, toxicity
from cotalake.llm import text as T

SF = "/root/testdata/sf0.01"


def _lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


@pytest.mark.parametrize("table, pattern", [(T.VISIBLE, r"[^\x20\x09-\x0D]+"), (T.LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words_match_regular_expressions(table, pattern):
    texts = ["Hello World", None, "", " a  b\tHello x", "ÀB é-É " * 3, "x" * 50 + " hello", "a1b2 c_d", "\x0b\x0c"]
    seen = {}
    for first, counts, hashes in T.words(pa.array(texts), table, 16):
        at = 0
        for k, n in enumerate(counts.tolist()):
            words = re.findall(pattern, _lower(texts[first + k]))
            assert len(words) == n
            for word, value in zip(words, hashes[at : at + n].tolist()):
                assert seen.setdefault(word, value) == value
            at += n
    assert len(set(seen.values())) == len(seen)


def test_characters_of_unspaced_scripts_are_words():
    texts = ["日本 abc日本x", "ภาษา is", "日本", "é日", "𠀀a", "", "日"]
    (_, counts, hashes), = T.words(pa.array(texts), T.LETTERS, apart=True)
    assert counts.tolist() == [6, 5, 2, 2, 2, 0, 1]
    (_, _, plain), = T.words(pa.array(["日", "本", "abc", "x"]), T.LETTERS)
    assert hashes[:6].tolist() == [plain[0], plain[1], plain[2], plain[0], plain[1], plain[3]]
    assert hashes[11] == hashes[0] and next(T.words(pa.array(texts), T.LETTERS))[1].tolist() == [2, 2, 1, 1, 1, 0, 1]


def test_long_texts_are_cut_between_words(monkeypatch):
    long = " ".join(f"w{i % 9}" for i in range(400)) + " " + "z" * 300 + " end"
    whole = next(T.words(pa.array([long]), T.VISIBLE))
    monkeypatch.setattr(T, "CHUNK", 64)
    cut = next(T.words(pa.array([long]), T.VISIBLE, 64))
    assert cut[1].tolist() == whole[1].tolist() and (cut[2] == whole[2]).all()


def test_shingles_are_distinct_sets():
    texts = ["a b c d e", "a b c d e a b c d e", "a b", "b a", "", "a b c d"]
    _, counts, hashes = next(T.words(pa.array(texts), T.VISIBLE))
    sets = [set(s.tolist()) for s in T.shingles(hashes, counts, 4)]
    assert [len(s) for s in sets] == [2, 5, 1, 1, 0, 1]
    assert sets[0] < sets[1] and sets[2] != sets[3] and sets[5] < sets[0]


def test_statistics_of_odd_texts():
    rows = quality_rules.statistics_of(pa.array(["", None, "AB ab", "a|b|c d", "é é é"]))
    assert (rows[0] == 0).sum() >= len(quality_rules.STATISTICS) - 1 and (rows[0] == rows[1]).all()
    name = quality_rules.STATISTICS.index
    assert rows[2][name("upper")] == 0.4 and rows[3][name("pipe")] == 2 / 7
    assert rows[4][name("distinct")] == 1 / 3 and rows[4][name("top_repeat")] == 1.0


def test_rules_compile_to_the_same_scores(spark):
    random = np.random.default_rng(0)
    x = random.random((600, len(quality_rules.STATISTICS)))
    y = ((x[:, 3] > 0.5) & (x[:, 5] <= 0.7)).astype(float)
    model = quality_rules.fit(x, y)
    assert 0 < len(model.rules) < 120 and model.describe()
    total = np.full(len(x), model.bias)
    for rule, weight in zip(model.rules, model.weights):
        total += weight * np.all([(x[:, i] <= b) if low else (x[:, i] > b) for i, low, b in rule], axis=0)
    expected = 1 / (1 + np.exp(-total))
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "i int, s array<double>")
    got = [r.p for r in df.select("i", model.score(F.col("s")).alias("p")).orderBy("i").collect()]
    assert np.allclose(got, expected) and ((expected >= 0.5) == (y == 1)).mean() > 0.98


def _labelled(spark, column, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t, _ in rows], "doc_id long, text string, lang string, source string, score long")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows if y is not None], f"doc_id long, {column} int")
    return docs, labels


def test_quality_on_held_out_rows(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    scored = {r.doc_id: r for r in quality_rules.score_documents(docs, labels).collect()}
    held = [(scored[r.doc_id].predicted, r.quality) for r in labels.collect() if scored[r.doc_id].held_out]
    assert len(scored) == docs.count() and np.mean([a == b for a, b in held]) > 0.9
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and r.predicted == (r.score >= 0.5) for r in scored.values())


def test_held_out_labels_change_nothing(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    crc = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(3))
    flipped = labels.withColumn("quality", F.when(crc == 1, 1 - F.col("quality")).otherwise(F.col("quality")))
    renamed = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    a = {r.doc_id: r.score for r in quality_rules.score_documents(docs, labels).collect()}
    assert a == {r.doc_id: r.score for r in quality_rules.score_documents(renamed, flipped).collect()}


@pytest.mark.parametrize("module, column", [(quality_rules, "quality"), (toxicity, "toxic")])
def test_classifiers_without_labels_and_with_odd_rows(spark, module, column):
    docs, labels = _labelled(spark, column, [(1, None, 1), (1, None, 0), (2, "", None), (None, "x", None), (3, "y " * 5000, None)])
    out = module.score_documents(docs, labels).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out)
    assert module.score_documents(docs.limit(0), labels).count() == 0
    empty = module.score_documents(docs, labels.limit(0)).collect()
    assert {r.score for r in empty} == {0.5}


def test_toxicity_finds_planted_words(spark):
    random = np.random.default_rng(1)
    common = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(700):
        words = list(random.choice(common, random.integers(5, 60)))
        bad = i % 6 == 0
        if bad:
            words.insert(int(random.integers(0, len(words))), str(random.choice(["vile", "foulish", "foulness"])))
        rows.append((i, " ".join(words), int(bad)))
    rows.append((5000, "w1 " * 70_000 + "vile" + " w2" * 70_000, None))
    docs, labels = _labelled(spark, "toxic", rows)
    scored = {r.doc_id: r for r in toxicity.score_documents(docs, labels).collect()}
    held = [(r.predicted, rows[r.doc_id][2]) for r in scored.values() if r.held_out and r.doc_id < 5000]
    assert np.mean([a == b for a, b in held]) > 0.95
    assert scored[5000].predicted == 1  # deep inside a long text, across pieces


def test_toxicity_learns_from_every_labelled_row(spark, monkeypatch):
    random = np.random.default_rng(5)
    common = [f"w{i}" for i in range(200)]
    texts = [" ".join(random.choice(common, 2100 if i < 4 else 30)) + (" vile" if i % 2 else "") for i in range(120)]
    docs, labels = _labelled(spark, "toxic", [(i, t, i % 2) for i, t in enumerate(texts)])
    rows = toxicity.labelled_rows(docs, labels, 4, 2).collect()
    known = {i for i in range(120) if zlib.crc32(str(i).encode()) % 4 != 2}
    assert {r.doc_id for r in rows} == known and {len(r.ids) // 2 // toxicity.PARTS for r in rows} >= {30, 31, 2100 + (min(known & {0, 1, 2, 3}) % 2)}
    seen = []
    monkeypatch.setattr(toxicity, "PART_ROWS", 16)  # several parts
    monkeypatch.setattr(toxicity, "_epoch", lambda net, rows, epoch, run=toxicity._epoch: (seen.append(rows.select("doc_id", "part").collect()), run(net, rows, epoch)))
    net = toxicity.train(docs, labels, 4, 2)
    kept = {r.doc_id for r in rows if r.kept}
    assert len(seen) == toxicity.EPOCHS and all(sorted(r.doc_id for r in part) == sorted(known - kept) for part in seen)
    assert len({r.part for r in seen[0]}) > 3
    again = toxicity.train(docs.repartition(7), labels, 4, 2)
    assert (net.embedding == again.embedding).all() and (net.scale, net.shift, net.bias) == (again.scale, again.shift, again.bias)
    scores = {r.doc_id: r.score for r in toxicity.score_documents(docs, labels).collect()}
    assert min(scores[i] for i in scores if i % 2) > max(scores[i] for i in scores if not i % 2)


def test_filters_of_long_texts_find_their_place_across_pieces(monkeypatch):
    random = np.random.default_rng(6)
    net = toxicity.start(np.zeros(toxicity.BUCKETS), 1, 2)
    texts = [random.integers(0, 1000, (n, toxicity.PARTS)).astype(np.int32) for n in (40, 3, 0, 17)]
    whole = toxicity._tops(net, texts)
    top, _ = net.pooled(*toxicity._flat(texts))
    assert np.allclose(whole[0], top, atol=1e-5) and (whole[1][0, 0, 0] == texts[0]).all(axis=1).any()


def test_pooling_matches_row_by_row():
    net = toxicity.fit([np.full((3, toxicity.PARTS), 7, np.int32)], np.array([1.0]), ["en"])
    random = np.random.default_rng(2)
    texts = [random.integers(0, 1000, (n, toxicity.PARTS)).astype(np.int32) for n in (1, 2, 5, 0, 9)]
    together, at = net.pooled(*toxicity._flat(texts), where=True)
    for k, text in enumerate(texts):
        alone, _ = net.pooled(*toxicity._flat([text]))
        assert np.allclose(alone[0], together[k], atol=1e-5)
    assert at.shape == together.shape


def test_attention_gradients():
    random = np.random.default_rng(3)
    inputs, targets = lm_scoring.windows(random.integers(0, lm_scoring.VOCABULARY, 41).astype(np.int32))
    net = lm_scoring.Attention.start(np.ones(lm_scoring.VOCABULARY))
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    loss = lambda: -net.log_probabilities(inputs, targets).sum() / (targets >= 0).sum()
    gradients = net.gradients(inputs, targets)
    for name, weight in net.weights.items():
        flat = np.argsort(-np.abs(gradients[name]).ravel())[:3]
        for i in flat:
            keep, step = weight.ravel()[i], 1e-5
            weight.ravel()[i] = keep + step
            up = loss()
            weight.ravel()[i] = keep - step
            down = loss()
            weight.ravel()[i] = keep
            assert math.isclose((up - down) / (2 * step), gradients[name].ravel()[i], rel_tol=2e-2, abs_tol=1e-6), name


def test_attention_needs_no_keys_and_values_of_its_own(monkeypatch):
    random = np.random.default_rng(8)
    ids = [np.append(random.integers(0, lm_scoring.END, n), lm_scoring.END).astype(np.int32) for n in (0, 1, 15, 16, 60)]
    inputs, targets = (np.concatenate(c) for c in zip(*map(lm_scoring.windows, ids)))
    pairs = random.integers(0, 5, (lm_scoring.VOCABULARY, lm_scoring.VOCABULARY)).astype(float)
    net = lm_scoring.Attention.start(pairs.sum(axis=0), pairs)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    w, found = net.weights, net.forward(inputs)
    assert not {"k", "v"} & set(found)
    x = w["embed"][inputs] + w["place"]
    for n in range(len(inputs)):
        q, k, v = x[n, lm_scoring.CONTEXT :] @ w["query"], x[n] @ w["key"], x[n] @ w["value"]
        for i in range(lm_scoring.STEP):
            at = lm_scoring.CONTEXT + i
            seen = [j for j in range(at + 1) if inputs[n, j] != lm_scoring.VOCABULARY]
            share = np.exp(k[seen] @ q[i] / math.sqrt(lm_scoring.SIZE))
            hidden = np.tanh(share / max(share.sum(), 1e-30) @ v[seen] @ w["mixed"] + x[n, at])
            assert np.allclose(found["hidden"].reshape(-1, lm_scoring.STEP, lm_scoring.SIZE)[n, i], hidden, rtol=1e-6)
    # Bounded logits need no shift; the gradient is the same with one.
    assert net.tame()
    bounded = net.gradients(inputs, targets)
    monkeypatch.setattr(lm_scoring.Attention, "tame", lambda self: False)
    shifted = net.gradients(inputs, targets)
    assert all(np.allclose(bounded[k], shifted[k], rtol=1e-9, atol=1e-12) for k in w)


def test_attention_is_causal_and_a_distribution():
    net = lm_scoring.Attention.start(np.ones(lm_scoring.VOCABULARY))
    ids = np.arange(1, 60, dtype=np.int32)
    x, y = lm_scoring.windows(ids)
    first = net.log_probabilities(x, y).ravel()[: len(ids)]
    changed = ids.copy()
    changed[40:] = 5
    x2, y2 = lm_scoring.windows(changed)
    assert np.allclose(first[:40], net.log_probabilities(x2, y2).ravel()[:40])
    inputs = np.repeat(x[1:2], lm_scoring.VOCABULARY, axis=0)
    targets = np.full((lm_scoring.VOCABULARY, lm_scoring.STEP), -1, np.int32)
    targets[:, 0] = np.arange(lm_scoring.VOCABULARY)
    assert math.isclose(np.exp(net.log_probabilities(inputs, targets)[:, 0]).sum(), 1, rel_tol=1e-4)


@pytest.mark.parametrize("scale", [1, 30])
def test_scorer_with_tables_agrees_with_the_layer(scale):
    random = np.random.default_rng(4)
    pairs = random.integers(0, 5, (lm_scoring.VOCABULARY, lm_scoring.VOCABULARY)).astype(float)
    net = lm_scoring.Attention.start(pairs.sum(axis=0), pairs)
    for name in net.weights:
        net.weights[name] = (net.weights[name] * scale).astype(np.float32)
    net = net.fold()
    texts = [np.append(random.integers(0, lm_scoring.END, n), lm_scoring.END).astype(np.int32) for n in (0, 1, 7, 8, 15, 16, 17, 400, 3)]
    scorer = lm_scoring.Scorer(net)
    assert scorer.calm == (scale == 1)
    plain = [net.log_probabilities(*lm_scoring.windows(t)).sum() / math.log(10) for t in texts]
    assert np.allclose(lm_scoring._score(scorer, texts), plain, rtol=1e-5)
    assert np.allclose(lm_scoring._score(net, texts), plain, rtol=1e-9)
    assert len(lm_scoring._score(scorer, [])) == 0


def test_descent_agrees_with_plain_adam_in_few_operations(monkeypatch):
    random = np.random.default_rng(6)
    cells = [lm_scoring.windows(np.append(random.integers(0, lm_scoring.END, n), lm_scoring.END).astype(np.int32)) for n in (0, 5, 300, 90, 16)]
    inputs, targets = (np.concatenate(c) for c in zip(*cells))
    pairs = random.integers(0, 5, (lm_scoring.VOCABULARY, lm_scoring.VOCABULARY)).astype(float)
    monkeypatch.setattr(lm_scoring, "BATCH", 8)
    plain, net = (lm_scoring.Attention.start(pairs.sum(axis=0), pairs) for _ in range(2))
    first, second = ({k: np.zeros_like(v) for k, v in plain.weights.items()} for _ in range(2))
    order, turn = np.random.default_rng(lm_scoring.SEED).permutation(len(inputs)), 0
    steps = -(-len(inputs) // 8)
    for lo in range(0, len(order), 8):
        turn += 1
        part, rate = order[lo : lo + 8], 0.01 * (1 - 0.9 * turn / steps)
        for k, gradient in plain.gradients(inputs[part], targets[part]).items():
            first[k] += 0.1 * (gradient - first[k])
            second[k] += 0.01 * (gradient**2 - second[k])
            plain.weights[k] -= (rate * (first[k] / (1 - 0.9**turn)) / (np.sqrt(second[k] / (1 - 0.99**turn)) + 1e-8)).astype(np.float32)
    roots = []
    monkeypatch.setattr(np, "sqrt", lambda *a, root=np.sqrt, **named: roots.append(1) or root(*a, **named))
    lm_scoring.descend(net, inputs, targets, 1, 0.01)
    assert all(np.allclose(net.weights[k], plain.weights[k], rtol=1e-6, atol=1e-7) for k in plain.weights)
    # All weights move together, not one matrix after the other.
    assert len(roots) == steps


def test_sample_takes_the_same_text_of_a_repeated_id(spark):
    docs = spark.createDataFrame([(1, "b" * 40), (1, "a" * 40), (1, None), (2, None)], "doc_id long, text string")
    there, back = (lm_scoring.sample_windows(d, lm_scoring.TOKENIZER) for d in (docs, docs.orderBy(F.col("text").desc())))
    assert all((x == y).all() for x, y in zip(there, back))
    expected = [lm_scoring.windows(lm_scoring.subwords(t, lm_scoring.TOKENIZER)) for t in ("a" * 40, "")]
    assert (there[0] == np.concatenate([x for x, _ in expected])).all()


def test_every_id_is_scored_once():
    for n in (1, 15, 16, 17, 100):
        _, targets = lm_scoring.windows(np.arange(n, dtype=np.int32))
        assert targets[targets >= 0].tolist() == list(range(n))


@pytest.mark.parametrize("frequent", [lm_scoring.FREQUENT, 8])
def test_unigram_scores_match_brute_force(spark, monkeypatch, frequent):
    monkeypatch.setattr(lm_scoring, "FREQUENT", frequent)
    texts = {i: f"a b c {'d ' * (i % 4)} e{i % 5}" for i in range(40)} | {50: None, 51: "", 52: "Zz zZ  "}
    docs = spark.createDataFrame([(i, t, 1) for i, t in texts.items()], "doc_id long, text string, score int")
    out = {r.doc_id: r for r in lm_scoring.score_documents(docs).collect()}
    tokens = {i: re.findall(r"[^\x20\x09-\x0D]+", _lower(t)) + ["\0end"] for i, t in texts.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    c = collections.Counter(w for i, ws in tokens.items() if not held[i] for w in ws)
    n, v = sum(c.values()), len(c)
    assert len(out) == len(texts)
    for i, ws in tokens.items():
        assert (out[i].held_out, out[i].n_tokens, out[i].n_known, out[i].train_tokens) == (held[i], len(ws), sum(c[w] > 0 for w in ws), n)
        assert math.isclose(out[i].base_score, sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert out[i].score < 0 and math.isfinite(out[i].score)
    assert lm_scoring.score_documents(docs.limit(0)).count() == 0


def test_network_learns_from_all_training_windows(spark):
    random = np.random.default_rng(7)
    phrases = ["red green blue", "one two three", "cat dog bird"]
    texts = [" ".join(random.choice(phrases, 150)) for _ in range(30)]
    ids = [lm_scoring.subwords(t, lm_scoring.TOKENIZER) for t in texts]
    frame = spark.createDataFrame([(i, bytearray(x.astype(np.int16).tobytes())) for i, x in enumerate(ids)], "doc_id long, ids binary")
    start = lm_scoring.Attention.start(np.ones(lm_scoring.VOCABULARY))
    net = lm_scoring.learned(start, frame)
    score = lambda n: lm_scoring._score(n, ids).sum()
    assert score(net) > score(start)
    again = lm_scoring.learned(start, frame.repartition(5))
    assert all((net.weights[k] == again.weights[k]).all() for k in net.weights)
    # Texts beyond the sample, and windows beyond those drawn, change the weights.
    more = lm_scoring.learned(start, frame.union(spark.createDataFrame([(99, bytearray(ids[0][:17].astype(np.int16).tobytes()))], "doc_id long, ids binary")))
    assert (more.weights["query"] != net.weights["query"]).any()
    assert lm_scoring.learned(start, frame.limit(0)) is start


def test_trained_model_beats_subword_frequencies(monkeypatch):
    monkeypatch.setattr(lm_scoring, "BATCH", 16)
    monkeypatch.setattr(lm_scoring, "EPOCHS", 10)
    random = np.random.default_rng(0)
    pairs = np.array([[1, 2, 3], [4, 5, 6], [7, 8, 9]], np.int32)
    ids = [np.append(pairs[random.integers(0, 3, 40)].ravel(), lm_scoring.END).astype(np.int32) for _ in range(80)]
    cells = [lm_scoring.windows(x) for x in ids]
    x, y = np.concatenate([c[0] for c in cells]), np.concatenate([c[1] for c in cells])
    net = lm_scoring.fit(x[:-40], y[:-40])
    logs = net.log_probabilities(x[-40:], y[-40:])
    assert logs.sum() / (y[-40:] >= 0).sum() > -1.2  # ln 9 = 2.2 without context


def test_subword_counts_of_all_training_text_reach_the_model(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "SAMPLE", 0)  # the counts alone
    texts = {i: f"the cat {i} sat on the mat. " * 200 for i in range(12)} | {50: None, 51: ""}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    brute = np.zeros((lm_scoring.VOCABULARY, lm_scoring.VOCABULARY))
    packed = []
    for i, t in texts.items():
        ids = lm_scoring.subwords(t or "", lm_scoring.TOKENIZER)
        packed.append((bytearray(ids.astype(np.int16).tobytes()), held[i]))
        np.add.at(brute, (np.append(lm_scoring.END, ids[:-1]), ids), 0 if held[i] else 1)
    rows = spark.createDataFrame(packed, "ids binary, held_out boolean")
    assert (lm_scoring.subword_pairs(rows.where("not held_out").select("ids")) == brute).all()
    out = {r.doc_id: r for r in lm_scoring.score_documents(docs).collect()}
    for i in range(12):
        n = len(lm_scoring.subwords(texts[i], lm_scoring.TOKENIZER))
        assert out[i].score / n > -1  # a uniform guess: -3
    net = lm_scoring.Attention.start(brute.sum(axis=0), brute)
    random = np.random.default_rng(1)
    net.weights["lower_bias"] += random.standard_normal((lm_scoring.HALF, lm_scoring.HALF)).astype(np.float32)
    x, y = lm_scoring.windows(random.integers(0, lm_scoring.END, 100).astype(np.int32))
    assert np.allclose(net.log_probabilities(x, y), net.fold().log_probabilities(x, y), atol=1e-3)
    inputs = np.repeat(x[1:2], lm_scoring.VOCABULARY, axis=0)
    targets = np.full((lm_scoring.VOCABULARY, lm_scoring.STEP), -1, np.int32)
    targets[:, 0] = np.arange(lm_scoring.VOCABULARY)
    assert math.isclose(np.exp(net.log_probabilities(inputs, targets)[:, 0]).sum(), 1, rel_tol=1e-4)
