"""Benchmark decontamination by latent semantic retrieval.

Documents and benchmark items are cut into passages. A randomised singular value decomposition of the passages' TF-IDF matrix over
hashed words gives a latent space: term frequencies and the matrix sketch are summed over all documents by grouped aggregation.
Every document passage that holds enough words of the items is compared with all item passages, and those near by cosine are
candidates.

The cosine of short or changed excerpts within other text can be low. So there is a second route beside it: what holds a given share
of an item passage's words holds some of its rarest ones, and every passage with enough of those is a candidate too; no copy or
paraphrase is left out. The same bound rules out near passages that hold too few. For all others the longest common subsequence of words is
computed exactly, and paraphrases must also hold the item's answer words. Words in another order say little by themselves: a passage that holds
a copy's share of words, and all answer words, in any order is a leak only where the latent space finds it near. ``route`` says what found a pair:
``both``, ``words`` where the cosine is low, or ``cosine`` for words in another order.

Items below ``LEAST_WORDS`` words are searched word for word (``verbatim``; no cosine), those below ``LEAST_BYTES`` bytes of text are too
short to tell. A character of a script without spaces is a word.

Defined results: null and empty texts hold nothing and match nothing; an item without id is an item, reported with a null id; rows of one
id are one item; items with equal words are all reported; repeated documents are reported each (once for an item so long that it takes several blocks). Empty tables give an empty
result. Letters of every script are lower-cased first. Other columns are ignored. Ties of the best passage go to the earlier one.
Texts of any length are read whole; an item longer than a block is searched part by part, and its best part counts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotalake.llm import text as T
from cotalake.llm.common import written

#: Hashed vocabulary of the matrix (numbers of 16 bits), and dimensions of the latent space.
TERMS = 1 << 13
RANK = 64
#: Words of a document passage, and of the step to the next one.
STEP = 16
PASSAGE = 2 * STEP
#: Longest item passage; a longer item is cut into even parts.
ITEM_PASSAGE = 32
LEAST_WORDS = 8
#: Share of an item passage's words in common order that is a copy; from the lower share on, a paraphrase if answers match.
COPY, PARAPHRASE = 0.8, 0.55
#: Rare places of an item passage that a document passage must share to be a candidate.
SHARED = 3
#: Rarest words of an item passage that count as its answer, and how many of them a paraphrase must hold.
ANSWER_WORDS, ANSWER_NEEDED = 4, 2
#: Cosine from which a passage is a candidate.
NEAR = 0.45
#: Bytes of words that a short item must have.
LEAST_BYTES = 16
#: Item passages handled at a time, so that what executors hold is bounded whatever the benchmark's size and the items' length.
ITEM_BLOCK = 4096
#: Pairs verified, and passages compared, at a time.
PAIRS, WINDOWS = 1 << 13, 1 << 12
#: Blocks projected at a time: their sums stay in a core's cache.
TOGETHER = 512
#: Bits of a word's hash looked up before it is searched.
FIRST_BITS = 18
SEED = 20


@dataclass(frozen=True)
class Items:
    """Item passages: number of the item of each, word hashes. Short items, whole, apart from the others."""

    item: np.ndarray
    words: list[np.ndarray]
    short: dict[int, list[np.ndarray]]

    def terms(self) -> list[np.ndarray]:
        return [_terms(w) for w in self.words]


@dataclass(frozen=True)
class Space:
    """idf and latent basis of the terms (idf included, scaled by the singular values)."""

    idf: np.ndarray
    basis: np.ndarray


def _terms(words: np.ndarray) -> np.ndarray:
    return (words >> np.uint64(51)).astype(np.int64)


def cut_items(texts: list[str | None]) -> Items:
    item, found, short = [], [], {}
    for first, counts, hashes in T.words(pa.array(texts, pa.string()), T.LETTERS, apart=True):
        at = 0
        for k, n in enumerate(counts.tolist()):
            own = hashes[at : at + n]
            if n >= LEAST_WORDS:
                for piece in np.array_split(own, -(-n // ITEM_PASSAGE)):
                    item.append(first + k)
                    found.append(piece)
            elif n and int(T.LETTERS[np.frombuffer(texts[first + k].encode(), np.uint8)].sum()) >= LEAST_BYTES:
                short.setdefault(first + k, []).append(own)
            at += n
    return Items(np.array(item, np.int64), found, short)


def _blocks(counts: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms in rows of ``STEP``, and the blocks per row of texts; the last block of a text is filled up with ``TERMS``."""
    runs = -(-counts // STEP)
    first = np.cumsum(runs) - runs
    starts = np.cumsum(counts) - counts
    out = np.full(int(runs.sum()) * STEP, TERMS, np.int16)
    out[np.arange(len(terms)) + np.repeat(first * STEP - starts, counts)] = terms
    return out.reshape(-1, STEP), runs


def _project(blocks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of each block's rows of a matrix (one row more than terms, 0 for the filling), added up in pairs."""
    out = np.empty((len(blocks), rows.shape[1]), rows.dtype)
    for lo in range(0, len(blocks), TOGETHER):
        terms = blocks[lo : lo + TOGETHER].T.astype(np.intp)
        parts = [np.take(rows, terms[k], axis=0, mode="clip") for k in range(STEP // 2)]
        for k, part in enumerate(parts):
            part += np.take(rows, terms[k + STEP // 2], axis=0, mode="clip")
        while len(parts) > 1:
            parts = [np.add(one, other, out=one) for one, other in zip(parts[::2], parts[1::2])]
        out[lo : lo + TOGETHER] = parts[0]
    return out


def _add_products(total: np.ndarray, held: np.ndarray, blocks: np.ndarray, probe: np.ndarray) -> None:
    """Add to each term's column of ``total`` the projections of its places' blocks, and to ``held`` the blocks that hold it.

    The last entry of ``held`` counts all blocks.
    """
    ordered = np.sort(blocks, axis=1)
    new = ordered < TERMS
    new[:, 1:] &= ordered[:, 1:] != ordered[:, :-1]
    held[:TERMS] += np.bincount(ordered[new], minlength=TERMS)
    held[TERMS] += len(blocks)
    flat = blocks.ravel().astype(np.intp)
    for own, sums in zip(total, np.ascontiguousarray(_project(blocks, probe).T, float)):
        own += np.bincount(flat, np.repeat(sums, STEP), TERMS + 1)


def latent_space(docs: DataFrame, guess: np.ndarray, text: str = "text") -> Space:
    """Randomised SVD of the TF-IDF matrix A of blocks of words: S = A'A W for a random W, then the exact SVD within its range.

    With A = C D (counts, inverse frequencies), S = D (C'C (D W)). Any random matrix may stand for D W, so one reading gives both
    the frequencies that make D and the product: each partition adds up its part, one row per term, and rows are summed by term.
    ``guess`` scales the random matrix; it changes how well the range is found, not what is counted.
    """
    random = np.random.default_rng(SEED).standard_normal((TERMS, RANK)) * guess[:, None]
    probe = np.vstack([random, np.zeros((1, RANK))]).astype(np.float32)
    names = [f"c{i}" for i in range(RANK)]

    def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((RANK, TERMS + 1))
        held = np.zeros(TERMS + 1, np.int64)
        for batch in batches:
            for _, counts, hashes in T.words(batch.column(0), T.LETTERS, apart=True):
                blocks, _ = _blocks(counts, _terms(hashes))
                _add_products(total, held, blocks, probe)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(held[at]), *[pa.array(total[i, at]) for i in range(RANK)]], ["term", "n", *names])

    schema = "term int, n long, " + ", ".join(f"{n} double" for n in names)
    summed = docs.select(F.lower(text)).mapInArrow(product, schema).groupBy("term").agg(F.sum("n").alias("n"), *[F.sum(n).alias(n) for n in names])
    product_sum = np.zeros((TERMS, RANK))
    held, passages = np.zeros(TERMS), 0
    for row in summed.collect():
        if row[0] == TERMS:
            passages = row[1]
        else:
            held[row[0]], product_sum[row[0]] = row[1], row[2:]
    idf = np.maximum(np.log((1.0 + passages) / (1.0 + held)), 0.05)
    sketch = product_sum * idf[:, None]
    test = random / idf[:, None]
    basis, _ = np.linalg.qr(sketch)
    # A'A is about Q (Q' A'A Q) Q'; from S = A'A W: Q'S = (Q'A'AQ)(Q'W).
    inner = np.linalg.lstsq((basis.T @ test).T, (basis.T @ sketch).T, rcond=None)[0].T
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    scale = 1.0 / np.sqrt(np.maximum(values, max(values.max(initial=0.0), 1e-9) * 1e-6))
    return Space(idf.astype(np.float32), (idf[:, None] * (basis @ vectors) * scale).astype(np.float32))


def _frequencies_guess(items: Items) -> np.ndarray:
    """Inverse frequencies of terms among the item passages."""
    held = np.zeros(TERMS)
    for terms in items.terms():
        held[np.unique(terms)] += 1
    return np.log((2.0 + len(items.words)) / (1.0 + held))


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-9)


@dataclass(frozen=True)
class Places:
    """Where the words of each item passage stand in it, as bits, and which of them are answers; one row per passage and distinct word."""

    words: int
    keys: np.ndarray
    bits: np.ndarray
    answers: np.ndarray

    @classmethod
    def of(cls, codes: list[np.ndarray], rarity: list[np.ndarray], words: int) -> Places:
        lengths = [len(c) for c in codes]
        owner = np.repeat(np.arange(len(codes)), lengths)
        places = np.concatenate([np.arange(n) for n in lengths]).astype(np.uint64)
        keys, back = np.unique(owner * words + np.concatenate(codes), return_inverse=True)
        bits, answers = np.zeros(len(keys), np.uint64), np.zeros(len(keys), np.uint8)
        np.bitwise_or.at(bits, back, np.uint64(1) << places)
        for k, (own, rare) in enumerate(zip(codes, rarity)):
            chosen = list(dict.fromkeys(own[np.argsort(-rare, kind="stable")].tolist()))[:ANSWER_WORDS]
            answers[np.searchsorted(keys, k * words + np.array(chosen))] = 1 << np.arange(len(chosen))
        return cls(words, keys, bits, answers)

    def found(self, items: np.ndarray, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per pair of item passage and window of codes: the places of each word of the window, and which answers it holds.

        The last code stands for words of no item.
        """
        bits = np.zeros(windows.shape, np.uint64)
        held = np.zeros(windows.shape, np.uint8)
        flat = windows.ravel()
        place = np.flatnonzero(flat < self.words - 1)
        wanted = items[place // windows.shape[1]] * self.words + flat[place]
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        hit = self.keys[at] == wanted
        place, at = place[hit], at[hit]
        bits.ravel()[place], held.ravel()[place] = self.bits[at], self.answers[at]
        return bits, np.bitwise_or.reduce(held, axis=1)


def _common(bits: np.ndarray) -> np.ndarray:
    """Longest common subsequence of item passages and windows, given the places of each word of a window; all pairs at once."""
    open_bits = np.full(len(bits), ~np.uint64(0), np.uint64)
    for match in bits.T:
        hit = open_bits & match
        open_bits = (open_bits + hit) | (open_bits & ~match)
    return np.bitwise_count(~open_bits).astype(np.int64)


@dataclass(frozen=True)
class RarePlaces:
    """The rarest places of each item passage, by word.

    A paraphrase leaves at most n - need of n places out. Of any n - need + k places, it holds k or more.
    """

    first: np.ndarray
    size: np.ndarray
    item: np.ndarray
    times: np.ndarray
    least: np.ndarray

    @classmethod
    def of(cls, codes: list[np.ndarray], rarity: list[np.ndarray], words: int) -> RarePlaces:
        """``codes`` below ``words`` for each place of each item passage, and how rare they are."""
        lengths = np.array([len(c) for c in codes])
        need = np.maximum(np.ceil(PARAPHRASE * lengths - 1e-9).astype(np.int64), 1)
        least = np.minimum(SHARED, need)
        rarest = [c[np.argsort(-r, kind="stable")][:n] for c, r, n in zip(codes, rarity, (lengths - need + least).tolist())]
        keys = np.concatenate(rarest).astype(np.int64) * len(codes) + np.repeat(np.arange(len(codes)), [len(r) for r in rarest])
        found, times = np.unique(keys, return_counts=True)
        size = np.bincount(found // len(codes), minlength=words)
        return cls(np.cumsum(size) - size, size, found % len(codes), times, least)

    def candidates(self, codes: np.ndarray, runs: np.ndarray, runs_of: np.ndarray) -> np.ndarray:
        """window * items + item wherever a window holds enough rare places of the item passage.

        ``codes`` and ``runs`` (block of ``STEP`` words) of each word; window r holds the blocks r - 1 to r + 2 of its text.
        """
        items = len(self.least)
        hit = np.flatnonzero(self.size[codes])
        reach = self.size[codes[hit]]
        at = np.arange(int(reach.sum())) + np.repeat(self.first[codes[hit]] - (np.cumsum(reach) - reach), reach)
        keys, times = _added(np.repeat(runs[hit], reach) * items + self.item[at], self.times[at])
        run, item = keys // items, keys % items
        near = []
        for shift in (-2, -1, 0, 1):
            window = run + shift
            inside = (window >= 0) & (window < len(runs_of))
            inside[inside] = runs_of[window[inside]] == runs_of[run[inside]]
            near.append((window[inside] * items + item[inside], times[inside]))
        keys, times = _added(np.concatenate([k for k, _ in near]), np.concatenate([t for _, t in near]))
        return keys[times >= self.least[keys % items]]


def _added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys and the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(values, starts) if len(keys) else values


_FOUND = "doc_id long, item_id long, cosine double, common double, answers double, route string"


def _item_blocks(benchmark: DataFrame) -> Iterator[tuple[list[int | None], list[str], bool]]:
    """Ids and texts of items, in blocks of about ``ITEM_BLOCK`` passages; the last value tells whether an id goes on in another block."""
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.lower("text").alias("text")).orderBy("item_id", "text")
    ids: list[int | None] = []
    texts: list[str] = []
    # A word has a byte and a blank at least, or is a character.
    size, most = 0, 2 * ITEM_BLOCK * ITEM_PASSAGE
    goes_on = False
    for row in rows.toLocalIterator():
        text, own = row["text"] or "", row["item_id"]
        for at in range(0, max(len(text), 1), most):
            # The parts of a long item overlap by a passage of long words.
            part = text[at : at + most + 16 * ITEM_PASSAGE]
            if size and size + len(part) > most:
                same = at > 0 or own is not None and ids[-1] == own
                yield ids, texts, goes_on or same
                ids, texts, size, goes_on = [], [], 0, same
            ids.append(own)
            texts.append(part)
            size += len(part)
    if ids:
        yield ids, texts, goes_on


def find_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """Pairs (doc_id, item_id, cosine, common, answers, route) of documents that hold a copy or paraphrase of an item passage.

    ``common`` is the share of the passage's words found in order (small where ``route`` is ``cosine``), ``answers`` the share of its rarest words found there.
    Documents are read in any number of tasks; each holds the space and one block of item passages.
    """
    spark = docs.sparkSession
    space = found = parts = None
    for ids, texts, goes_on in _item_blocks(benchmark):
        items = cut_items(texts)
        if not len(items.words) and not items.short:
            continue
        if len(items.words):
            space = space or latent_space(docs, _frequencies_guess(items), text)
        part = _search(docs.select("doc_id", F.lower(text)), items, ids, space)
        if goes_on:
            parts = part if parts is None else parts.unionByName(part)
        else:
            found = part if found is None else found.unionByName(part)
    if parts is not None:
        # The best passage of items whose id is in several blocks.
        best = F.max(F.struct("common", F.coalesce("cosine", F.lit(-1.0)).alias("order"), "cosine", "answers", "route")).alias("best")
        parts = parts.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.cosine", "best.common", "best.answers", "best.route")
        found = parts if found is None else found.unionByName(parts)
    return found if found is not None else spark.createDataFrame([], _FOUND)


def _sequences(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash of every run of so many words."""
    total = np.full(max(len(hashes) - width + 1, 0), width, np.uint64)
    for k in range(width):
        total += T.mix(hashes[k : k + len(total)] + np.uint64(k))
    return T.mix(total)


class _Latent:
    """Both routes to candidates, and the check of candidates, for one block of item passages."""

    def __init__(self, items: Items, space: Space):
        terms = items.terms()
        self.item, self.idf = items.item, space.idf
        self.lengths = np.array([len(t) for t in terms])
        self.latent = _unit(T.sums(space.basis[np.concatenate(terms)], self.lengths)).astype(np.float32)
        # One more term for words that no item has: a window's words become places in the items' own vocabulary.
        self.vocabulary, coded = np.unique(np.concatenate(items.words), return_inverse=True)
        self.none = len(self.vocabulary)
        self.rows = np.vstack([space.basis, np.zeros((1, RANK), np.float32)])
        # The first bits of the vocabulary's hashes: most other words are told apart without a search.
        self.first_bits = np.zeros(1 << FIRST_BITS, bool)
        self.first_bits[(self.vocabulary >> np.uint64(64 - FIRST_BITS)).astype(np.intp)] = True
        each = np.split(coded, np.cumsum(self.lengths)[:-1])
        rarity = [self.idf[t] for t in terms]
        self.places = Places.of(each, rarity, self.none + 1)
        self.rare = RarePlaces.of(each, rarity, self.none + 1)
        self.wanted = np.minimum(np.array([len(np.unique(c)) for c in each]), ANSWER_WORDS)
        self.least = int(np.ceil(PARAPHRASE * self.lengths - 1e-9).min())

    def codes(self, hashes: np.ndarray) -> np.ndarray:
        """Place of each word in the items' vocabulary; ``none`` for words of no item."""
        codes = np.full(len(hashes), self.none)
        maybe = np.flatnonzero(np.take(self.first_bits, (hashes >> np.uint64(64 - FIRST_BITS)).view(np.int64)))
        wanted = hashes[maybe]
        at = np.minimum(np.searchsorted(self.vocabulary, wanted), self.none - 1)
        hit = self.vocabulary[at] == wanted
        codes[maybe[hit]] = at[hit]
        return codes

    def passages(self, cut: np.ndarray, runs_of: np.ndarray, windows: np.ndarray) -> np.ndarray:
        """Unit vectors of the blocks ``windows`` and those after them in the same text."""
        out = _project(cut[windows], self.rows)
        after = np.minimum(windows + 1, len(cut) - 1)
        joins = np.flatnonzero((after > windows) & (runs_of[after] == runs_of[windows]))
        out[joins] += _project(cut[after[joins]], self.rows)
        return _unit(out)

    def near(self, cut: np.ndarray, codes: np.ndarray, run_of_word: np.ndarray, runs_of: np.ndarray) -> np.ndarray:
        """Keys (window, item) by cosine, of windows that hold as many words of the items as the shortest paraphrase calls for."""
        held = np.bincount(run_of_word[codes < self.none], minlength=len(runs_of))
        around = held.copy()
        for shift in (-1, 1, 2):
            other = np.arange(len(held)) + shift
            inside = (other >= 0) & (other < len(held))
            inside[inside] = runs_of[other[inside]] == runs_of[inside]
            around[inside] += held[other[inside]]
        windows = np.flatnonzero(around >= self.least)
        keys = [np.zeros(0, np.int64)]
        for lo in range(0, len(windows), WINDOWS):
            some = windows[lo : lo + WINDOWS]
            near = self.passages(cut, runs_of, some) @ self.latent.T >= NEAR
            row, item = np.divmod(np.flatnonzero(near), len(self.lengths))
            keys.append(some[row] * len(self.lengths) + item)
        return np.concatenate(keys)

    def search(self, counts: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Row, item, cosine, share in order, share of answers and route of passages that are copies or paraphrases."""
        cut, runs = _blocks(counts, _terms(hashes))
        runs_of = np.repeat(np.arange(len(counts)), runs)
        codes = self.codes(hashes)
        # The passage and the step before and after it, within its own document.
        starts = np.cumsum(counts) - counts
        run_of_word = np.repeat(np.cumsum(runs) - runs, counts) + (np.arange(len(codes)) - np.repeat(starts, counts)) // STEP
        by_cosine = self.near(cut, codes, run_of_word, runs_of)
        # What lacks the rare places fails the subsequence check for certain, near or not: the bound spares it the check.
        keys = self.rare.candidates(codes, run_of_word, runs_of)
        window, item = np.divmod(keys, len(self.lengths))
        route = 1 + 2 * np.isin(keys, by_cosine)
        run_no = np.arange(len(runs_of)) - (np.cumsum(runs) - runs)[runs_of]
        left = starts[runs_of] + run_no * STEP - STEP
        for lo in range(0, len(window), PAIRS):
            w, i, r = (x[lo : lo + PAIRS] for x in (window, item, route))
            span = left[w][:, None] + np.arange(PASSAGE + 2 * STEP)
            own = runs_of[w]
            outside = (span < starts[own][:, None]) | (span >= (starts + counts)[own][:, None])
            spread = np.where(outside, self.none, codes[np.clip(span, 0, len(codes) - 1)])
            bits, held = self.places.found(i, spread)
            # The words in common, in any order, bound the subsequence from above.
            some = np.bitwise_count(np.bitwise_or.reduce(bits, axis=1))
            able = np.flatnonzero(some >= PARAPHRASE * self.lengths[i])
            if not len(able):
                continue
            w, i, r, held, some = w[able], i[able], r[able], np.bitwise_count(held[able]), some[able]
            share = _common(bits[able]) / self.lengths[i]
            in_order = (share >= COPY) | (share >= PARAPHRASE) & (held >= np.minimum(ANSWER_NEEDED, self.wanted[i]))
            # Nearness decides about words in another order.
            near = (r == 3) & (some >= COPY * self.lengths[i]) & (held >= self.wanted[i])
            leak = in_order | near
            r = np.where(in_order, r, 2)
            w, i, r, held, share = w[leak], i[leak], r[leak], held[leak], share[leak]
            if len(w):
                cosine = (self.passages(cut, runs_of, w) * self.latent[i]).sum(axis=1)
                yield runs_of[w], self.item[i], cosine, share, held / self.wanted[i], r


_ROUTES = ("", "words", "cosine", "both", "verbatim")


def _search(docs: DataFrame, items: Items, ids: list[int | None], space: Space | None) -> DataFrame:
    latent = _Latent(items, space) if len(items.words) else None
    first_of: dict[int, int] = {}
    one_item = np.array([k if i is None else first_of.setdefault(i, k) for k, i in enumerate(ids)])
    by_width: dict[int, tuple[list[int], list[int]]] = {}
    for number, texts in items.short.items():
        for words in texts:
            value, owner = by_width.setdefault(len(words), ([], []))
            value.append(int(_sequences(words, len(words))[0]))
            owner.append(number)
    short = {n: (np.sort(np.array(v, np.uint64)), np.array(o)[np.argsort(np.array(v, np.uint64), kind="stable")]) for n, (v, o) in by_width.items()}
    item_ids = pa.array(ids, pa.int64())

    def verbatim(counts: np.ndarray, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        owner = np.repeat(np.arange(len(counts)), counts)
        for width, (values, numbers) in short.items():
            every = _sequences(hashes, width)
            whole = owner[: len(every)] == owner[width - 1 :][: len(every)]
            lo, hi = np.searchsorted(values, every, "left"), np.searchsorted(values, every, "right")
            at = np.flatnonzero(whole & (hi > lo))
            for p in at.tolist():
                found = numbers[lo[p] : hi[p]]
                one = np.ones(len(found))
                yield np.full(len(found), owner[p]), found, one * np.nan, one, one, np.full(len(found), 4)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best: dict[tuple[int, int], tuple[float, float, float, int]] = {}
            for first, counts, hashes in T.words(batch.column(1), T.LETTERS, apart=True):
                if not len(hashes):
                    continue
                routes = [verbatim(counts, hashes)] if short else []
                routes += [latent.search(counts, hashes)] if latent else []
                for found in (x for route in routes for x in route):
                    for row, number, cosine, share, answered, route in zip(found[0].tolist(), one_item[found[1]].tolist(), *(c.tolist() for c in found[2:])):
                        key, old = (first + row, number), best.get((first + row, number))
                        if old is None or (share, cosine) > (old[1], old[0]):
                            best[key] = (cosine, share, answered, route | (old[3] if old else 0) if route < 4 else route)
                        elif route < 4:
                            best[key] = (*old[:3], old[3] | route)
            if best:
                rows, numbers = (pa.array(x, pa.int64()) for x in zip(*best))
                cosine, share, answered, route = zip(*best.values())
                values = [pa.array([None if c != c else c for c in cosine], pa.float64()), pa.array(share, pa.float64()), pa.array(answered, pa.float64()), pa.array([_ROUTES[r] for r in route])]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows).cast(pa.int64()), item_ids.take(numbers), *values], ["doc_id", "item_id", "cosine", "common", "answers", "route"])

    return docs.mapInArrow(search, _FOUND)


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that hold no benchmark passage, in order or near by cosine, with all their columns; rows of a leaking id all go, a null id stays."""
    leaks = written(find_leaks(docs, benchmark).select("doc_id").distinct(), "leaks")
    return docs.join(leaks, "doc_id", "left_anti").select(*docs.columns)
