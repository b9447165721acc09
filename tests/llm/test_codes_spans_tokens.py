"""Vector codes, repeated spans and token alignment against brute force, with odd rows."""

import collections
import hashlib
import itertools
import os
import random

import numpy as np
import pytest

from cotalake.llm import collection_index, repeated_spans, token_alignment, vector_codes
from cotalake.llm import text as T


# Vector codes


def _codes(vectors, parts, entries, rounds):
    """Plain product codes of integer rows: codes, errors, codebooks."""
    size = len(vectors[0]) // parts
    codes, errors, books = [""] * len(vectors), [0] * len(vectors), []
    for k in range(parts):
        own = [v[k * size : (k + 1) * size] for v in vectors]
        book = [list(p) for p in own[:entries]]

        def nearest(p, book=book):
            return min((sum((a - b) ** 2 for a, b in zip(p, e)), n) for n, e in enumerate(book))

        for _ in range(rounds):
            chosen = [nearest(p)[1] for p in own]
            for n in range(len(book)):
                mine = [p for p, c in zip(own, chosen) if c == n]
                if mine:
                    book[n] = [sum(c) // len(mine) for c in zip(*mine)]
        for row, p in enumerate(own):
            error, n = nearest(p)
            codes[row] += f"{n:02x}"
            errors[row] += error
        books.append(np.array(book, object))
    return codes, errors, vector_codes.digest(books)


@pytest.mark.parametrize("kind", ["spread", "repeated"])
def test_codes_match_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(vector_codes, "SUBTREE", 5)
    draw = random.Random(7)
    value = (lambda: draw.uniform(-2, 2)) if kind == "spread" else (lambda: draw.choice([-0.25, 0.0, 0.5]))
    rows = [(i, [value() for _ in range(8)], draw.choice([1, 2, None])) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in vector_codes.compress(df, entries=12, rounds=3).collect()}
    codes, errors, sha = _codes([[int(np.floor(1024 * x)) for x in v] for _, v, _ in rows], 4, 12, 3)
    by_label = collections.Counter()
    for (_, _, label), e in zip(rows, errors):
        by_label[label] += e
    for (i, _, label), code, error in zip(rows, codes, errors):
        assert (found[i].code, found[i].error, found[i].label_error, found[i].codebooks_sha256) == (code, error, by_label[label], sha)


def test_trie_ties_and_repeats_go_to_the_first_entry():
    rows = np.array([[0, 0], [2, 0], [0, 0], [1, 0], [9, 9]])
    entry, distance = vector_codes.Trie(rows).nearest(np.array([[0, 0], [2, 0], [0, 0]]))
    assert entry.tolist() == [0, 1, 0, 0, 1] and distance.tolist() == [0, 0, 0, 1, 130]
    assert vector_codes.Trie(rows[:0]).nearest(rows)[0].tolist() == []


def test_codes_of_odd_rows(spark):
    schema = "vec_id long, embedding array<double>, label int, code string, cells int"
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0, 3.0, 4.0], None, "x", 1), (1, [1.0, 2.0, 3.0, 4.0], None, "x", 1), (2, [1.0], 5, "x", 1), (None, [0.5] * 4, 5, "x", 1),
            (3, None, 1, "x", 1), (4, [1.0, None], 1, "x", 1), (5, [nan], 1, "x", 1), (6, [inf], 1, "x", 1), (7, [], 1, "x", 1), (8, [1e300, -1e300], 1, "x", 1)]
    found = sorted((r.vec_id if r.vec_id is not None else 99, r.code, r.error, r.codebooks_sha256) for r in vector_codes.compress(spark.createDataFrame(rows, schema), entries=2).collect())
    most = (1 << 63) - 1
    kept = [(1, [1024, 2048, 3072, 4096]), (1, [1024, 2048, 3072, 4096]), (2, [1024, 0, 0, 0]), (7, [0] * 4), (8, [most, -most - 1, 0, 0]), (99, [512] * 4)]
    codes, errors, sha = _codes([v for _, v in kept], 4, 2, 4)
    assert found == sorted((i, c, min(e, most), sha) for (i, _), c, e in zip(kept, codes, errors))
    assert vector_codes.compress(spark.createDataFrame([], schema)).count() == 0
    assert [r.code for r in vector_codes.compress(spark.createDataFrame(rows[8:9], schema)).collect()] == ["00000000"]


# Index of a collection


def _suffixes(texts, least):
    return sorted((s[k:], i) for i, s in enumerate(texts) for k in range(len(s) - least + 1))


@pytest.mark.parametrize("block", [7, 1 << 20])
def test_index_matches_sorted_suffixes(monkeypatch, block):
    monkeypatch.setattr(collection_index, "BLOCK", block)
    draw = random.Random(3)
    for _ in range(60):
        texts = [bytes(draw.choice(b"abAB\xff"[: draw.randint(1, 5)]) for _ in range(draw.choice([0, 1, 3, 10, 30]))) for _ in range(draw.randint(0, 9))]
        starts = np.cumsum([0, *map(len, texts)])
        index = collection_index.Collection(np.frombuffer(b"".join(texts), np.uint8), starts, 20)
        for least in (1, 4):
            owner, length, common = index.suffixes(least)
            found = [texts[i][len(texts[i]) - n :] for i, n in zip(owner, length)]
            assert list(zip(found, owner.tolist())) == _suffixes(texts, least)
            for k in range(1, len(found)):
                shared = len(os.path.commonprefix([found[k - 1], found[k]]))
                assert common[k] == min(shared, 20)
        index.close()


def test_index_of_all_byte_values():
    texts = [bytes(range(256)), bytes(range(255, -1, -1))]
    index = collection_index.Collection(np.frombuffer(b"".join(texts), np.uint8), np.array([0, 256, 512]), 5)
    owner, length, _ = index.suffixes(1)
    assert [(texts[i][256 - n :], i) for i, n in zip(owner.tolist(), length.tolist())] == _suffixes(texts, 1)


# Repeated spans


def _cleaned(texts, length):
    """Per text: bytes, removed, spans, what stays; texts in the order of their documents."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for i in range(len(raw) - length + 1):
            cell = raw[i : i + length]
            if cell in seen:
                gone[i : i + length] = True
            seen.add(cell)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), int(gone.sum()), int((gone[:-1] & ~gone[1:]).sum()), hashlib.sha256(kept).hexdigest()))
    return out


def _found(df, **options):
    return {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in repeated_spans.remove_repeats(df, **options).collect()}


def _passages(seed, n):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6)))
    shared = [" ".join(word() for _ in range(draw.choice([8, 20, 60]))) for _ in range(6)]
    texts = []
    for _ in range(n):
        parts = [draw.choice(shared) if draw.random() < 0.4 else " ".join(word() for _ in range(draw.randint(1, 30))) for _ in range(draw.randint(0, 6))]
        texts.append(" ".join(parts))
    return [*texts, "a" * 300, "ab" * 200, "a" * 99, "a" * 100, None, "", texts[0], texts[0] + "x"]


@pytest.mark.parametrize("paths", ["plain", "small", "apart", "sampled"])
def test_repeats_match_brute_force(spark, monkeypatch, paths):
    if paths == "small":
        # Pieces, blocks, collections and files of a few entries.
        monkeypatch.setattr(T, "CHUNK", 512)
        monkeypatch.setattr(repeated_spans, "TOGETHER", 2_000)
        monkeypatch.setattr(repeated_spans, "COLLECTION", 700)
        monkeypatch.setattr(collection_index, "BLOCK", 64)
    if paths == "apart":
        monkeypatch.setattr(repeated_spans, "GATHERED", 1)
    if paths == "sampled":
        monkeypatch.setattr(repeated_spans, "SAMPLED", 1)
        monkeypatch.setattr(repeated_spans, "MANY", 2)
    texts = _passages(11, 60)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    assert _found(df) == dict(enumerate(_cleaned(texts, 100)))


def test_repeats_of_other_lengths(spark):
    texts = _passages(5, 25)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert _found(df, length=40, gram=16) == dict(enumerate(_cleaned(texts, 40)))


def test_repeats_with_equal_and_null_ids(spark):
    a, b = "x" * 50 + "y" * 80, "z" * 120
    rows = [(2, a), (None, a), (1, b), (1, b), (2, b + "tail")]
    out = repeated_spans.remove_repeats(spark.createDataFrame([(i, t, 7, "s") for i, t in rows], "doc_id long, text string, place int, doc string")).collect()
    removed = collections.Counter((r.doc_id, r.n_bytes, r.n_removed) for r in out)
    # Order: null, 1, 1, 2 (a), 2 (b + tail).
    first_b = _cleaned([b], 100)[0][1]
    assert removed == {(None, 130, 0): 1, (1, 120, first_b): 1, (1, 120, 120): 1, (2, 130, 130): 1, (2, 124, 120): 1}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeated_spans.remove_repeats(empty).columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept"]
    assert repeated_spans.remove_repeats(empty).count() == 0


def test_span_places_and_kept_text(spark):
    base = "".join(chr(97 + (i * i) % 23) for i in range(150))
    df = spark.createDataFrame([("k1", base), ("k2", "head " + base + " tail")], "doc_id string, text string")
    found = {r.doc_id: r for r in repeated_spans.remove_repeats(df).collect()}
    assert found["k1"].spans == [] or found["k1"].n_removed > 0
    assert found["k2"].spans == [[5, 155]] and bytes(found["k2"].kept) == b"head  tail"


# Token alignment


def _aligned(text):
    """Ids, groups and links of one whole text, token by token."""
    t = token_alignment.Tokenizers.get(token_alignment.BYTE_MODEL, token_alignment.PIECE_MODEL)
    raw = (" " + text).encode()
    a, b = t.a.encode(" " + text, add_special_tokens=False).ids, t.b.encode(text)
    tokens_a, tokens_b = [t.a_bytes[i] for i in a], [t.b_bytes[i] for i in b]
    if not text or b"".join(tokens_a) != raw or b"".join(tokens_b) != raw:
        return None
    ends_a, ends_b = list(itertools.accumulate(map(len, tokens_a))), list(itertools.accumulate(map(len, tokens_b)))
    groups, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        i2, j2 = ends_a.index(end) + 1, ends_b.index(end) + 1
        groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
        i, j = i2, j2
    spans_b = list(zip([0, *ends_b], ends_b, b))
    links = [(x, y) for lo, hi, x in zip([0, *ends_a], ends_a, a) for lo2, hi2, y in spans_b if lo < hi2 and lo2 < hi]
    return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()


def _odd_texts():
    draw = random.Random(2)
    cells = [" ", "  ", "\n", "a", "b", "é", "日", "☃", "😀", "\t", " ", "　", "'s", "<s>", "<|endoftext|>", "<0x0A>", "1", "23", "!!", "\x00",
             "᠎", "​", "\x1c", "\x85", "ß", "the", "\r\n", "é", "▁", "ﬁ", "⁠"]
    return ["".join(draw.choice(cells[:-3] if draw.random() < 0.9 else cells) for _ in range(draw.randint(0, 25))) for _ in range(400)]


def test_alignment_matches_whole_texts(monkeypatch):
    monkeypatch.setattr(token_alignment, "BUNDLE", 4)
    texts = ["The quick brown fox's 1234 jumps.\n\n  Über naïve café  日本語 😀 x", *_odd_texts()]
    memory = token_alignment.Memory(token_alignment.Tokenizers.get(token_alignment.BYTE_MODEL, token_alignment.PIECE_MODEL))
    counts, shas, owner, pairs, times = token_alignment._documents(memory, texts)
    size = len(memory.t.b_bytes)
    missing = 0
    for k, text in enumerate(texts):
        expected = _aligned(text)
        own = dict(zip(pairs[owner == k].tolist(), times[owner == k].tolist()))
        if expected is None:
            missing += 1
            assert counts[k].tolist() == [0, 0, 0, 0] and shas[k] == "" and not own
        else:
            n_a, n_b, n_groups, links, sha = expected
            assert (counts[k].tolist(), shas[k]) == ([n_a, n_b, n_groups, len(links)], sha)
            assert own == collections.Counter(a * size + b for a, b in links)
    assert 0 < missing < len(texts) / 2


@pytest.mark.parametrize("frequent", [1 << 19, 10])
def test_alignment_counts(spark, monkeypatch, frequent):
    monkeypatch.setattr(token_alignment, "FREQUENT", frequent)
    monkeypatch.setattr(token_alignment, "REMEMBERED", 50)
    monkeypatch.setattr(token_alignment, "TOGETHER", 100)
    texts = [None, "", "the cat sat", "the cat sat", "a ▁ b", *_odd_texts()[:60], "The cats sat on " * 30]
    rows = [(None if k == 7 else k // 2, t, k, "r") for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, row int, pairs string").repartition(2)
    found = collections.Counter(tuple(r) for r in token_alignment.align_documents(df).collect())
    plain = [_aligned(t or "") for t in texts]
    counts = collections.Counter(p for x in plain if x for p in set(x[3]))
    most = collections.defaultdict(int)
    for (a, _), c in counts.items():
        most[a] = max(most[a], c)
    expected = collections.Counter()
    for (i, _, _, _), x in zip(rows, plain):
        if x is None:
            expected[i, 0, 0, 0, 0, 0, 0, ""] += 1
        else:
            best = sum(counts[p] == most[p[0]] for p in x[3])
            expected[i, x[0], x[1], x[2], len(x[3]), best, sum(counts[p] for p in x[3]), x[4]] += 1
    assert found == expected
    assert token_alignment.align_documents(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_repeats_in_very_long_texts(spark):
    draw = random.Random(9)
    long = " ".join(f"{draw.randrange(1 << 40):x}" for _ in range(60_000))
    texts = [long[260_000:262_500], long, long[5_000:5_400] + "é" * 70 + long[-300:]]
    assert len(long) > 2 * T.CHUNK
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert _found(df) == dict(enumerate(_cleaned(texts, 100)))
