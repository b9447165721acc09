"""Toxicity by a convolutional text classifier.

A word's embedding is the sum of three hashed ones: of the word and of its first four and five bytes, so that inflected forms
share what their stem tells. Filters of several widths run over the word sequence, the maximum of each filter over the whole
text feeds a logistic output. Forward and backward passes are numpy; the score is scaled on rows kept out of the training, and
a threshold for every language is chosen there.

All labelled rows outside the held-out remainder take part, with their whole texts. Word evidence is counted by grouped aggregation over the rows
trained on. Every epoch each part of them (at most ``PART_ROWS`` rows, about ``PART_WORDS`` words) is trained from the same weights, side by side with others, and what the
parts changed is averaged, each embedding over the parts that hold it, in whole numbers, so that no order of tasks matters. A fifth of the ids, by
their hash, are kept out; their logits, rounded to ``GRID``, are counted by language and label, and these counts give the
scaling and the thresholds. Letters of every script are lower-cased. Texts are read in pieces that overlap by the widest filter, so memory does not grow with a text.

Defined results: null and empty texts are one padding word, and score like it; null ids belong to the remainder of the empty
text and are never trained on. Of several labels of one id the highest counts. With no labels, or one class only, every score is
the smoothed share of label 1. A language without enough labelled rows has the common threshold. Repeated rows are scored each.
Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from cotalake.llm import text as T
from cotalake.llm.common import remainder, written

#: Rows and words that one task trains on in an epoch.
PART_ROWS, PART_WORDS = 8_000, 4_000_000
BUCKETS, SIZE = 1 << 16, 12
#: First bytes of a word that are hashed beside the word.
HEADS = (4, 5)
PARTS = 1 + len(HEADS)
WIDTHS, FILTERS = (1, 2, 3), 8
EPOCHS, BATCH, RATE = 4, 64, 0.01
#: One id of so many is kept out for scaling and thresholds; rows that a language needs there for a threshold of its own.
KEPT_OUT, LEAST_ROWS = 5, 60
#: Logits are rounded to so much where they are counted, and lie within the bound.
GRID, MOST = 1e-3, 50.0
#: Bits that mark the ids of labelled rows, a multiple of 2^15.
MARKS = 1 << 25
#: Changes of weights are added as whole numbers of this fraction.
FRACTION = 2.0**20
COMMON = 0.3
#: Labelled rows from which a network is trained.
LEAST_TRAINED = 20
SEED = 8
PAD = BUCKETS - 1
REACH = max(WIDTHS) - 1


def _ids(hashes: np.ndarray) -> np.ndarray:
    return (hashes % np.uint64(BUCKETS - 1)).astype(np.int32)


@dataclass
class Network:
    """Embeddings, one filter bank per width, and the output layer; ``scale`` and ``shift`` map the logit to a probability."""

    embedding: np.ndarray
    banks: list[np.ndarray]
    biases: list[np.ndarray]
    out: np.ndarray
    bias: float
    scale: float = 1.0
    shift: float = 0.0
    thresholds: dict[str, float] = field(default_factory=dict)
    common: float = COMMON

    def pooled(self, ids: np.ndarray, counts: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """The maximum of every filter over each row, and (``where``) the position it comes from.

        Rows are padded to the widest filter, so that no filter sees two rows.
        """
        rows = len(counts)
        lengths = np.maximum(counts, 1) + REACH
        starts = np.cumsum(lengths) - lengths
        padded = _padded(ids, counts)
        vectors = _embedded(self.embedding, padded)
        n = len(padded) - REACH
        tops, places = [], []
        for width, bank, bias in zip(WIDTHS, self.banks, self.biases):
            heat = vectors[:n] @ bank[0]
            for k in range(1, width):
                heat += vectors[k : k + n] @ bank[k]
            # A filter may begin at any word of the row; the padding after it belongs to no row's start.
            live = np.repeat(np.arange(rows), lengths)
            offset = np.arange(n) - starts[live]
            heat[offset >= np.maximum(counts, 1)[live]] = -np.inf
            top = np.maximum.reduceat(heat, starts, axis=0)
            tops.append(top + bias)
            if where:
                at = np.empty((rows, heat.shape[1]), np.int64)
                for f in range(heat.shape[1]):
                    hit = np.flatnonzero(heat[:, f] >= top[live, f])
                    at[live[hit][::-1], f] = hit[::-1]
                places.append(at)
        return np.concatenate(tops, axis=1), (np.concatenate(places, axis=1) if where else None)

    def logits(self, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        top, _ = self.pooled(ids, counts)
        return np.maximum(top, 0) @ self.out + self.bias

    def probability(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * logits + self.shift, -50, 50)))


class _Adam:
    def __init__(self, value: np.ndarray) -> None:
        self.value, self.first, self.second, self.turn = value, np.zeros_like(value), np.zeros_like(value), 0

    def step(self, gradient: np.ndarray, rows: np.ndarray | None = None) -> None:
        self.turn += 1
        part = slice(None) if rows is None else rows
        self.first[part] = 0.9 * self.first[part] + 0.1 * gradient
        self.second[part] = 0.99 * self.second[part] + 0.01 * gradient**2
        step = RATE * (self.first[part] / (1 - 0.9**self.turn)) / (np.sqrt(self.second[part] / (1 - 0.99**self.turn)) + 1e-7)
        self.value[part] -= step


def _flat(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return (np.concatenate(texts) if texts else np.zeros((0, PARTS), np.int32)), np.array([len(t) for t in texts], np.int64)


def _embedded(embedding: np.ndarray, ids: np.ndarray) -> np.ndarray:
    vectors = embedding[ids[..., 0]]
    for part in range(1, PARTS):
        vectors += embedding[ids[..., part]]
    return vectors


def start(evidence: np.ndarray | None, positive: float, rows: float) -> Network:
    """Seeded weights that carry word evidence; without it (too few rows, or one class only) every score is the smoothed share."""
    random = np.random.default_rng(SEED)
    embedding = (random.standard_normal((BUCKETS, SIZE)) * 0.1).astype(np.float32)
    banks = [(random.standard_normal((w, SIZE, FILTERS)) * 0.3 / np.sqrt(w)).astype(np.float32) for w in WIDTHS]
    biases = [np.zeros(FILTERS, np.float32) for _ in WIDTHS]
    net = Network(embedding, banks, biases, (random.standard_normal(FILTERS * len(WIDTHS)) * 0.1).astype(np.float32), 0.0)
    share = (positive + 1.0) / (rows + 2.0)
    if evidence is None:
        net.scale, net.shift = 0.0, float(np.log(share / (1 - share)))
        return net
    # Start from word evidence: how much oftener rows of label 1 hold a word's bucket; the first dimension carries it.
    embedding[:, 0] = evidence
    embedding[PAD, 0] = 0
    for bank in banks:
        bank[:, 0, : FILTERS // 2] += 1.0 / len(bank)
    net.out[np.concatenate([np.arange(FILTERS) < FILTERS // 2 for _ in WIDTHS])] = 0.5
    net.bias = float(np.log(share / (1 - share)))
    return net


def evidence_of(seen: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Evidence of each bucket from the rows of either label that hold it, and all rows of either label."""
    seen = seen + 0.5
    totals = rows[:, None] + 1.0
    evidence = np.log(seen[1] / totals[1]) - np.log(seen[0] / totals[0])
    certain = 1 - np.exp(-(seen.sum(axis=0) - 1) / 8)
    return np.clip(evidence * certain, -4, 4) / 8


def _tops(net: Network, texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The maximum of every filter over each whole text, and the words from its place on."""
    ids, counts = _flat(texts)
    tops = np.full((len(texts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
    words = np.full((*tops.shape, REACH + 1, PARTS), PAD, np.int32)
    for owner, piece, lengths in _pieces(ids, counts):
        top, at = net.pooled(piece, lengths, where=True)
        found = _padded(piece, lengths)[at[..., None] + np.arange(REACH + 1)]
        if len(owner) == len(np.unique(owner)):
            higher = top > tops[owner]
            tops[owner] = np.where(higher, top, tops[owner])
            words[owner] = np.where(higher[..., None, None], found, words[owner])
            continue
        for k, row in enumerate(owner.tolist()):
            higher = top[k] > tops[row]
            tops[row, higher], words[row, higher] = top[k, higher], found[k, higher]
    return tops, words


def train_on(net: Network, texts: list[np.ndarray], y: np.ndarray, epochs: int, seed: int = SEED) -> np.ndarray:
    """Adam on rows of hashed words, in place; the embeddings touched."""
    random = np.random.default_rng(seed)
    embedding, banks, biases = net.embedding, net.banks, net.biases
    order = np.arange(len(y))
    held = np.zeros(BUCKETS, bool)
    moments = {"e": _Adam(embedding), "o": _Adam(net.out), **{f"b{i}": _Adam(b) for i, b in enumerate(banks)}, **{f"c{i}": _Adam(b) for i, b in enumerate(biases)}}
    bias = _Adam(np.array([net.bias], np.float32))
    for _ in range(epochs):
        random.shuffle(order)
        for lo in range(0, len(order), BATCH):
            chosen = order[lo : lo + BATCH]
            top, found = _tops(net, [texts[i] for i in chosen])
            active = np.maximum(top, 0)
            p = 1 / (1 + np.exp(-np.clip(active @ net.out + bias.value[0], -50, 50)))
            error = ((p - y[chosen]) / len(chosen)).astype(np.float32)
            back = error[:, None] * net.out[None, :] * (top > 0)
            rows, grads = [], []
            f0 = 0
            for i, width in enumerate(WIDTHS):
                own, place = back[:, f0 : f0 + FILTERS], found[:, f0 : f0 + FILTERS]
                d_bank = np.zeros_like(banks[i])
                for k in range(width):
                    words = place[:, :, k]
                    d_bank[k] = np.einsum("rf,rfd->df", own, _embedded(embedding, words))
                    gradient = (own[:, :, None] * banks[i][k].T[None]).reshape(-1, SIZE)
                    for part in range(PARTS):
                        rows.append(words[..., part].ravel())
                        grads.append(gradient)
                moments[f"b{i}"].step(d_bank)
                moments[f"c{i}"].step(own.sum(axis=0))
                f0 += FILTERS
            moments["o"].step(active.T @ error + 1e-4 * net.out)
            bias.step(error.sum(keepdims=True))
            net.bias = float(bias.value[0])
            touched, inverse = np.unique(np.concatenate(rows), return_inverse=True)
            total = np.zeros((len(touched), SIZE), np.float32)
            np.add.at(total, inverse, np.concatenate(grads))
            total[touched == PAD] = 0
            moments["e"].step(total, touched)
            held[touched] = True
    return np.flatnonzero(held)


def fit(texts: list[np.ndarray], y: np.ndarray, langs: list[str]) -> Network:
    """Train on rows of hashed words in memory; the last fifth, in a seeded order, scales the scores and sets the thresholds."""
    if len(y) < LEAST_TRAINED or y.min() == y.max():
        return start(None, float(y.sum()), len(y))
    order = np.random.default_rng(SEED).permutation(len(y))
    cut = len(y) - len(y) // KEPT_OUT
    seen = np.zeros((2, BUCKETS))
    for i in order[:cut]:
        seen[int(y[i]), np.unique(texts[i])] += 1
    rows = np.array([(y[order[:cut]] == label).sum() for label in (0, 1)], float)
    net = start(evidence_of(seen, rows), float(y.sum()), len(y))
    train_on(net, [texts[i] for i in order[:cut]], y[order[:cut]], EPOCHS)
    kept = order[cut:]
    logits = [float(net.logits(*_flat([texts[i]]))[0]) for i in kept]
    _calibrate(net, np.array(logits), y[kept], np.ones(len(kept)), [langs[i] for i in kept])
    return net


def _padded(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    lengths = np.maximum(counts, 1) + REACH
    starts = np.cumsum(lengths) - lengths
    padded = np.full((int(lengths.sum()) + REACH, PARTS), PAD, np.int32)
    owner = np.repeat(np.arange(len(counts)), counts)
    padded[starts[owner] + np.arange(len(ids)) - (np.cumsum(counts) - counts)[owner]] = ids
    return padded


def _calibrate(net: Network, logits: np.ndarray, y: np.ndarray, n: np.ndarray, langs: list[str | None]) -> None:
    """Scale and shift by logistic regression on the logit; thresholds at the best F1, for a language with enough rows. ``n`` rows each."""
    positive, negative = float(n[y == 1].sum()), float(n[y == 0].sum())
    if not positive or not negative:
        return
    target = np.where(y == 1, (positive + 1) / (positive + 2), 1 / (negative + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * logits + b, -50, 50)))
        w, g = n * np.maximum(p * (1 - p), 1e-9), n * (p - target)
        hessian = np.array([[(w * logits**2).sum() + 1e-3, (w * logits).sum()], [(w * logits).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hessian, np.array([(g * logits).sum() + 1e-3 * (a - 1), g.sum()]))
        a, b = a - float(np.clip(step[0], -1, 1)), b - float(np.clip(step[1], -1, 1))
    net.scale, net.shift = max(a, 0.05), b
    p = net.probability(logits)

    def best(p: np.ndarray, y: np.ndarray, n: np.ndarray) -> float:
        tried = np.linspace(0.05, 0.95, 19)
        f1 = [2 * n[(p >= t) & (y == 1)].sum() / max(n[p >= t].sum() + n[y == 1].sum(), 1) for t in tried]
        top = np.flatnonzero(np.array(f1) >= max(f1) - 1e-9)
        return float(round(tried[top[len(top) // 2]], 2))

    net.common = best(p, y, n)
    named = np.array(langs, object)
    for lang in sorted({x for x in langs if x}):
        own = named == lang
        if n[own].sum() >= LEAST_ROWS and 0 < n[own & (y == 1)].sum() < n[own].sum():
            net.thresholds[lang] = best(p[own], y[own], n[own])


def hashed_words(text: Column) -> Column:
    """Hashed words of a text, as bytes; for the training."""

    @F.arrow_udf("binary")
    def run(column: pa.Array) -> pa.Array:
        out: list[bytes] = []
        for _, counts, hashes in T.words(column, T.LETTERS, heads=HEADS):
            ids, at = _ids(hashes).astype(np.uint16), 0
            for n in counts.tolist():
                out.append(ids[at : at + n].tobytes())
                at += n
        return pa.array(out, pa.binary())

    return run(F.lower(text))


def _unpacked(cells: pa.Array | pa.ChunkedArray) -> list[np.ndarray]:
    return [np.frombuffer(c.as_buffer(), np.uint16).astype(np.int32).reshape(-1, PARTS) for c in cells]


#: Words scored at a time.
PIECE = 1 << 16


def _pieces(ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Parts of rows: owner of each part, its words and their number; long rows are cut with an overlap."""
    owners, lengths, chosen, size, at = [], [], [], 0, 0
    for row, n in enumerate(counts.tolist()):
        for lo in range(0, max(n, 1), PIECE):
            part = ids[at + lo : at + min(n, lo + PIECE + REACH)]
            owners.append(row)
            lengths.append(len(part))
            chosen.append(part)
            size += len(part)
            if size >= PIECE:
                yield np.array(owners), np.concatenate(chosen), np.array(lengths)
                owners, lengths, chosen, size = [], [], [], 0
        at += n
    if owners:
        yield np.array(owners), np.concatenate(chosen), np.array(lengths)


def _logits(net: Network, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Logits of whole rows."""
    tops = np.full((len(counts), FILTERS * len(WIDTHS)), -np.inf, np.float32)
    for owner, piece, lengths in _pieces(ids, counts):
        top, _ = net.pooled(piece, lengths)
        np.maximum.at(tops, owner, top)
    return np.maximum(tops, 0) @ net.out + net.bias


def score(net: Network, text: Column) -> Column:
    """Probability of label 1 for whole texts."""

    @F.arrow_udf("double")
    def run(column: pa.Array) -> pa.Array:
        out = np.empty(len(column))
        for first, counts, hashes in T.words(column, T.LETTERS, heads=HEADS):
            out[first : first + len(counts)] = net.probability(_logits(net, _ids(hashes), counts))
        return pa.array(out)

    return run(F.lower(text))


def labelled_rows(docs: DataFrame, labels: DataFrame, divisor: int, held: int) -> DataFrame:
    """(part, doc_id, toxic, lang, ids, kept): every row of ``docs`` with a label outside the held-out remainder, its whole text as hashed words.

    Rows of a part stand together, in the order of their ids.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (remainder(F.col("doc_id"), divisor) != held))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = written(known, "toxic_known")
    parts = F.lit(known.count() // PART_ROWS + 1)
    # Few of the texts without a label pass the marks; the join settles the rest, and moves words of labelled texts only.
    rows = docs.where(_marked(known, docs.schema["doc_id"].dataType)).select("doc_id", hashed_words(F.col("text")).alias("ids"), F.col("lang").cast("string").alias("lang"))
    rows = rows.join(known.hint("merge"), "doc_id")
    kept = F.pmod(F.xxhash64(F.lit(SEED), "doc_id"), F.lit(KEPT_OUT)) == 0
    part = F.pmod(F.xxhash64(F.lit(SEED + 1), "doc_id"), parts)
    rows = rows.select(part.alias("part"), "doc_id", "toxic", "lang", "ids", kept.alias("kept"))
    return rows.repartition("part").sortWithinPartitions("part", "doc_id", "toxic", "ids")


def _marked(known: DataFrame, kind: DataType) -> Column:
    """True for every id of ``known``, and for few others: ids are marked by a hash in ``MARKS`` bits."""
    place = lambda key: F.pmod(F.xxhash64(key.cast("string")), F.lit(MARKS))
    # Ids of both tables may differ in type; they are compared in the documents' type.
    at = known.select(place(F.col("doc_id").cast(kind)).alias("at"))
    found = at.groupBy((F.col("at") / 32768).cast("int").alias("block")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(F.col("at") + 1)).alias("bits"))
    marks = np.zeros(MARKS // 8, np.uint8)
    for r in found.toLocalIterator():
        own = np.frombuffer(r["bits"], np.uint8)
        marks[r["block"] * 4096 : r["block"] * 4096 + len(own)] = own

    @F.arrow_udf("boolean")
    def marked(places: pa.Array) -> pa.Array:
        at = places.to_numpy(zero_copy_only=False)
        return pa.array((marks[at >> 3] >> (at & 7)) & 1 == 1)

    return F.col("doc_id").isNotNull() & marked(F.coalesce(place(F.col("doc_id")), F.lit(0).cast("long")))


def _seen(rows: DataFrame) -> np.ndarray:
    """How many rows of either label hold each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            for y, ids in zip(batch.column(0).to_pylist(), _unpacked(batch.column(1))):
                seen[y, np.unique(ids)] += 1
        at = np.flatnonzero(seen.ravel())
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(seen.ravel()[at])], ["at", "n"])

    found = rows.select("toxic", "ids").mapInArrow(count, "at int, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    seen = np.zeros(2 * BUCKETS)
    seen[found.column(0).to_numpy()] = found.column(1).to_numpy()
    return seen.reshape(2, BUCKETS)


def _small(net: Network) -> np.ndarray:
    """All weights but the embeddings, in rows as long as theirs."""
    flat = np.concatenate([w.ravel() for w in (*net.banks, *net.biases, net.out, np.array([net.bias]))]).astype(float)
    return np.append(flat, np.zeros(-len(flat) % SIZE)).reshape(-1, SIZE)


def _moved(net: Network, change: np.ndarray, at: np.ndarray) -> None:
    """Add the changes of rows ``at``: embeddings, and the other weights after them."""
    own = at < BUCKETS
    net.embedding[at[own]] += change[own].astype(np.float32)
    small = _small(net)
    small[at[~own] - BUCKETS] += change[~own]
    flat, place = small.ravel(), 0
    for w in (*net.banks, *net.biases, net.out):
        w.ravel()[:] = flat[place : place + w.size]
        place += w.size
    net.bias = float(flat[place])


def _epoch(net: Network, rows: DataFrame, epoch: int) -> None:
    """One epoch over all parts side by side; the weights move by the mean of what the parts changed."""
    names = [f"v{i}" for i in range(SIZE)]

    def trained(texts: list[np.ndarray], y: list[int]) -> pa.RecordBatch:
        own = Network(net.embedding.copy(), [b.copy() for b in net.banks], [b.copy() for b in net.biases], net.out.copy(), net.bias)
        at = train_on(own, texts, np.array(y, float), 1, SEED + epoch)
        change = np.concatenate([own.embedding[at] - net.embedding[at], _small(own) - _small(net)])
        at = np.append(at, BUCKETS + np.arange(len(change) - len(at)))
        whole = np.rint(np.clip(change.astype(float), -MOST, MOST) * FRACTION).astype(np.int32)
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), *[pa.array(c) for c in np.ascontiguousarray(whole.T)]], ["at", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, y, size, now = [], [], 0, None
        for batch in batches:
            for part, label, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), _unpacked(batch.column(2))):
                if y and (part != now or len(y) >= PART_ROWS or size >= PART_WORDS):
                    yield trained(texts, y)
                    texts, y, size = [], [], 0
                texts.append(ids)
                y.append(label)
                size, now = size + len(ids), part
        if y:
            yield trained(texts, y)

    moved = rows.select("part", "toxic", "ids").mapInArrow(run, "at int, " + ", ".join(f"{n} int" for n in names))
    moved = moved.groupBy("at").agg(F.count(F.lit(1)).alias("n"), *[F.sum(n).alias(n) for n in names]).toArrow()
    change = np.stack([moved.column(n).to_numpy() for n in names], axis=1) / FRACTION / moved.column("n").to_numpy()[:, None]
    _moved(net, change, moved.column("at").to_numpy())


def _calibrate_all(net: Network, kept: DataFrame) -> None:
    """Scaling and thresholds from all rows kept out, counted by language, label and rounded logit."""

    @F.arrow_udf("long")
    def logit(cells: pa.Array) -> pa.Array:
        some = _unpacked(cells)
        logits = [_logits(net, *_flat(some[lo : lo + 256])) for lo in range(0, len(some), 256)]
        found = np.concatenate(logits) if logits else np.zeros(0)
        return pa.array(np.rint(np.clip(found.astype(float), -MOST, MOST) / GRID).astype(np.int64))

    counted = written(kept.select("lang", "toxic", logit(F.col("ids")).alias("logit")).groupBy("lang", "toxic", "logit").agg(F.count(F.lit(1)).alias("n")), "toxic_logits")
    # Languages with a threshold of their own; the others' rows count for the common one only.
    named = counted.groupBy("lang").agg(F.sum("n").alias("rows")).where(F.col("rows") >= LEAST_ROWS).select("lang", F.col("lang").alias("own"))
    found = counted.join(named, "lang", "left").groupBy("own", "toxic", "logit").agg(F.sum("n").alias("n")).orderBy("own", "toxic", "logit").toArrow()
    values = [found.column(c).to_numpy().astype(float) for c in ("logit", "toxic", "n")]
    _calibrate(net, values[0] * GRID, values[1], values[2], found.column("own").to_pylist())


def train(docs: DataFrame, labels: DataFrame, divisor: int, held: int) -> Network:
    rows = written(labelled_rows(docs, labels, divisor, held), "toxic_rows")
    sums = {(r["toxic"], r["kept"]): r["n"] for r in rows.groupBy("toxic", "kept").agg(F.count(F.lit(1)).alias("n")).collect()}
    positive, every = sum(n for (y, _), n in sums.items() if y), sum(sums.values())
    trained = [sums.get((y, False), 0) for y in (0, 1)]
    if every < LEAST_TRAINED or positive in (0, every) or not all(trained):
        return start(None, positive, every)
    own = rows.where("not kept")
    net = start(evidence_of(_seen(own), np.array(trained, float)), positive, every)
    for epoch in range(EPOCHS):
        _epoch(net, own, epoch)
    _calibrate_all(net, rows.where("kept"))
    return net


def score_documents(docs: DataFrame, labels: DataFrame, divisor: int = 4, held: int = 2) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted (score >= 0.3), and flagged by the language's own threshold.

    The language decides the threshold only, never the score; labels of held-out rows are never read.
    """
    net = train(docs, labels, divisor, held)
    limit = F.lit(net.common)
    if net.thresholds:
        own = F.create_map(*[x for k, v in net.thresholds.items() for x in (F.lit(k), F.lit(v))])
        limit = F.coalesce(F.element_at(own, F.col("lang")), limit)
    scored = docs.select("doc_id", "lang", score(net, F.col("text")).alias("score"))
    return scored.select(
        "doc_id",
        (remainder(F.col("doc_id"), divisor) == held).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
        limit.alias("threshold"),
        (F.col("score") >= limit).alias("flagged"),
    )
