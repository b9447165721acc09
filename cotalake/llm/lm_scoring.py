"""Language-model scoring of whole texts.

The model is a causal self-attention layer over subword ids, trained in numpy. Texts become ids of a public byte-level vocabulary
(only its first ``VOCABULARY`` merges, so any text can be written), ended by one end id. Windows overlap: each holds ``CONTEXT``
ids that only give context and ``STEP`` ids that are scored, so every id is scored once, with batched masked attention. An id's
probability is that of its upper half times that of its lower half given the upper, and all probabilities sum to 1.

Beside it stands a smoothed unigram score over words. Word counts of the whole training part come from grouped aggregation; the
most frequent words (a bounded number) are looked up where the text is read, all other words by a join.

The network stands on bigrams: how often each id follows each other one, counted over every id of all training texts by grouped
aggregation, gives its output biases (smoothed by the unigram counts), and the network learns what to add to them.

It learns from every window of all training texts. It starts from a sample (``SAMPLE`` training rows, chosen by a hash of their id, with at most
``SAMPLE_WINDOWS`` windows each, drawn from all over the text); from there parts of ``PART`` windows are learned side by side, each from the same weights, and
the weights move by the mean of what the parts changed, added up in whole numbers.

Defined results: null and empty texts consist of the end alone. A null id belongs to the remainder of the empty text. Repeated
rows count and are scored each. Without training rows the counts are 0, all ids are as likely, and the network keeps its first, random weights. Empty
tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake.llm import text as T
from cotalake.llm.common import bounded_sample, remainder, written

#: Ranks of a public byte-level vocabulary: base64 of the bytes, a blank, the id. Every worker must be able to read the file; ``path`` names another one.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Runs that merges stay within: words with the blank before them, figures, marks, white space; no run is long.
PIECES = r" ?[^\s\p{N}\p{P}\p{S}]{1,40}| ?\p{N}{1,3}| ?[\p{P}\p{S}]{1,8}|\s{1,8}"
HALF = 32
VOCABULARY = HALF * HALF
END = VOCABULARY - 1
CONTEXT, STEP = 8, 16
WINDOW = CONTEXT + STEP
SIZE = 16
SAMPLE, SAMPLE_WINDOWS = 4_000, 24
EPOCHS, BATCH, RATE = 4, 128, 0.01
#: Windows of all training text that are learned together, and the fraction in whole numbers of which their changes are added.
PART, FRACTION = 96_000, 2.0**20
#: Windows scored at a time: their intermediate values stay in a core's cache.
TOGETHER = 384
#: Ids of texts whose windows are laid out together.
SPREAD = 1 << 18
#: Words whose counts travel with the task; all others are joined.
FREQUENT = 1 << 16
SEED = 10

#: 1 where a scored place may look: itself and earlier places.
_CAUSAL = (np.arange(WINDOW)[None, :] <= np.arange(CONTEXT, WINDOW)[:, None]).astype(np.float32)

_encoders: dict[str, object] = {}


def encoder(path: str):
    """The vocabulary's encoder, once per process."""
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding("subwords", pat_str=PIECES, mergeable_ranks={k: v for k, v in ranks.items() if v < END}, special_tokens={})
    return _encoders[path]


def subwords(text: str, path: str) -> np.ndarray:
    """Ids of a text and the end."""
    return np.append(encoder(path).encode_to_numpy(text, disallowed_special=()).astype(np.int32), np.int32(END))


def windows(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Inputs (windows x WINDOW; ``VOCABULARY`` where nothing stands) and targets (windows x STEP; -1 beyond the end).

    The input at a place is the id before it; before the first one stands the end id.
    """
    count = -(-len(ids) // STEP)
    before = np.full(CONTEXT + count * STEP, VOCABULARY, np.int32)
    before[CONTEXT] = END
    before[CONTEXT + 1 : CONTEXT + len(ids)] = ids[:-1]
    targets = np.full(count * STEP, -1, np.int32)
    targets[: len(ids)] = ids
    return np.lib.stride_tricks.sliding_window_view(before, WINDOW)[::STEP], targets.reshape(count, STEP)


@dataclass
class Attention:
    """Weights of one causal self-attention layer and the two output layers.

    ``prior`` holds the logarithms of an upper half's probability after each id and of a lower half's after id and upper half.
    """

    weights: dict[str, np.ndarray]
    prior: tuple[np.ndarray, np.ndarray] | None = None
    #: Whether the prior includes the biases.
    folded: bool = False

    def __post_init__(self) -> None:
        self.reach = [0.0 if self.prior is None else float(np.abs(p).max()) for p in self.prior or (0, 0)]

    @classmethod
    def start(cls, counts: np.ndarray, pairs: np.ndarray | None = None) -> Attention:
        random = np.random.default_rng(SEED)
        near = lambda *shape, scale: (random.standard_normal(shape) * scale).astype(np.float32)
        smooth = counts.reshape(HALF, HALF) + 0.1
        weights = {
            "embed": near(VOCABULARY + 1, SIZE, scale=0.3),
            "place": near(WINDOW, SIZE, scale=0.1),
            **{n: near(SIZE, SIZE, scale=SIZE**-0.5) for n in ("query", "key", "value", "mixed")},
            "upper": near(SIZE, HALF, scale=0.1),
            "lower": near(SIZE, HALF, scale=0.1),
            "upper_bias": np.log(smooth.sum(axis=1) / smooth.sum()).astype(np.float32),
            "lower_bias": np.log(smooth / smooth.sum(axis=1, keepdims=True)).astype(np.float32),
        }
        weights["embed"][VOCABULARY] = 0
        if pairs is None:
            return cls(weights)
        for bias in ("upper_bias", "lower_bias"):
            weights[bias][:] = 0
        return cls(weights, bigrams(pairs))

    def fold(self) -> Attention:
        """The same model with its biases within the prior."""
        if self.prior is None:
            return self
        upper, lower = self.prior
        lower = (lower.reshape(-1, HALF, HALF) + self.weights["lower_bias"]).reshape(-1, HALF)
        return Attention(self.weights, (upper + self.weights["upper_bias"], lower), True)

    def _biases(self, inputs: np.ndarray, upper: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Output biases of each scored place, given the id before it and the upper half of its target."""
        w = self.weights
        if self.prior is None:
            return w["upper_bias"], w["lower_bias"][upper]
        before = inputs[:, CONTEXT:].ravel()
        first, second = (np.take(p, at, axis=0, mode="clip") for p, at in zip(self.prior, (before, before * HALF + upper)))
        if not self.folded:
            first += w["upper_bias"]
            second += np.take(w["lower_bias"], upper, axis=0)
        return first, second

    def products(self) -> tuple[np.ndarray, np.ndarray]:
        """Queries times keys, scaled, and values times what mixes them: all that the layer needs of its four square matrices."""
        w = self.weights
        return (w["query"] @ w["key"].T) * np.float32(SIZE**-0.5), w["value"] @ w["mixed"]

    def forward(self, inputs: np.ndarray) -> dict[str, np.ndarray]:
        w, (heated, mixed) = self.weights, self.products()
        x = np.take(w["embed"], inputs, axis=0)
        x += w["place"]
        own = x[:, CONTEXT:]
        # One product of large matrices for all windows; keys and values are the places' own rows, the products hold the rest.
        flat_own = own.reshape(-1, SIZE)
        q = (flat_own @ heated).reshape(own.shape)
        share = q @ x.transpose(0, 2, 1)
        np.clip(share, -40, 40, out=share)
        np.exp(share, out=share)
        # A scored place looks at itself and earlier places that hold an id.
        share *= _CAUSAL
        empty = inputs == VOCABULARY
        if empty.any():
            share *= ~empty[:, None, :]
        share /= np.maximum(share @ np.ones(WINDOW, share.dtype), 1e-30)[:, :, None]
        seen = (share @ x).reshape(-1, SIZE)
        hidden = seen @ mixed
        hidden += flat_own
        np.tanh(hidden, out=hidden)
        return {"heated": heated, "mixed": mixed, "x": x, "own": flat_own, "q": q, "share": share, "seen": seen, "hidden": hidden}

    def tame(self) -> bool:
        """Whether exponentials need no shift: hidden values lie within 1, so weights bound the logits."""
        w = self.weights
        return all(float(np.abs(w[h]).sum(axis=0).max() + np.abs(w[h + "_bias"]).max()) + r < 60 for h, r in zip(("upper", "lower"), self.reach))

    def log_probabilities(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's probability; 0 beyond the end."""
        w = self.weights
        hidden = self.forward(inputs)["hidden"]
        flat = np.maximum(targets.ravel(), 0)
        rows, total = np.arange(len(flat)), np.zeros(len(flat))
        tame = self.tame()
        biases = self._biases(inputs, flat // HALF)
        for half, place, bias in (("upper", flat // HALF, biases[0]), ("lower", flat % HALF, biases[1])):
            logits = hidden @ w[half]
            logits += bias
            total += logits[rows, place]
            if not tame:
                top = logits.max(axis=1, keepdims=True)
                total -= top[:, 0]
                logits -= top
            np.exp(logits, out=logits)
            total -= np.log(logits.sum(axis=1))
        return np.where(targets.ravel() >= 0, total, 0.0).reshape(targets.shape)

    def gradients(self, inputs: np.ndarray, targets: np.ndarray) -> dict[str, np.ndarray]:
        w, f = self.weights, self.forward(inputs)
        n, hidden, x, share = len(inputs), f["hidden"], f["x"], f["share"]
        flat = np.maximum(targets.ravel(), 0)
        live = (targets.ravel() >= 0).astype(hidden.dtype) / max(int((targets >= 0).sum()), 1)
        rows = np.arange(len(flat)) * HALF
        ones = np.ones(HALF, hidden.dtype)
        out: dict[str, np.ndarray] = {}
        d_hidden = None
        tame = self.tame()
        biases = self._biases(inputs, flat // HALF)
        for half, place, bias in (("upper", flat // HALF, biases[0]), ("lower", flat % HALF, biases[1])):
            p = hidden @ w[half]
            p += bias
            if not tame:
                p -= p.max(axis=1, keepdims=True)
            np.exp(p, out=p)
            p *= (live / (p @ ones))[:, None]
            p.ravel()[rows + place] -= live
            out[half] = hidden.T @ p
            if half == "upper":
                out["upper_bias"] = p.sum(axis=0)
            else:
                out["lower_bias"] = np.take(np.eye(HALF, dtype=p.dtype), flat // HALF, axis=0).T @ p
            back = p @ w[half].T
            d_hidden = back if d_hidden is None else np.add(d_hidden, back, out=back)
        np.multiply(hidden, hidden, out=hidden)
        np.subtract(1, hidden, out=hidden)
        d_hidden *= hidden
        # Of the two products first, then of their factors.
        d_mixed = f["seen"].T @ d_hidden
        out["value"], out["mixed"] = d_mixed @ w["mixed"].T, w["value"].T @ d_mixed
        d_seen = d_hidden @ f["mixed"].T
        d_heat = d_seen.reshape(n, STEP, SIZE) @ x.transpose(0, 2, 1)
        # What all of a place's shares lose together is its row's product with what it saw.
        d_heat -= ((d_seen * f["seen"]) @ ones[:SIZE]).reshape(n, STEP, 1)
        d_heat *= share
        d_q = (d_heat @ x).reshape(-1, SIZE)
        d_heated = (f["own"].T @ d_q) * np.float32(SIZE**-0.5)
        out["query"], out["key"] = d_heated @ w["key"], d_heated.T @ w["query"]
        d_x = d_heat.transpose(0, 2, 1) @ f["q"]
        d_x += share.transpose(0, 2, 1) @ d_seen.reshape(n, STEP, SIZE)
        d_own = d_q @ f["heated"].T
        d_own += d_hidden
        d_x[:, CONTEXT:] += d_own.reshape(n, STEP, SIZE)
        out["place"] = d_x.sum(axis=0)
        out["embed"] = np.zeros_like(w["embed"])
        _add_rows(out["embed"], inputs.ravel(), d_x.reshape(-1, SIZE))
        out["embed"][VOCABULARY] = 0
        return out


def _add_rows(to: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Add rows to those of a matrix; several may go to one."""
    # Short whole numbers are sorted by digits, in time that grows with their number alone.
    at = at.astype(np.int16)
    order = np.argsort(at, kind="stable")
    at = at[order]
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    to[at[starts]] += np.add.reduceat(np.take(rows, order, axis=0), starts, axis=0)


class Scorer:
    """The model's log probabilities with what depends on an id or a place alone worked out beforehand.

    Queries, and the rows that are keys and values at once, are sums of a row per id and a row per place. The latter carry a 1 that
    the same product adds up to the attention's denominator, and are 0 where nothing stands, so such places need no mask.
    """

    def __init__(self, net: Attention):
        w = net.weights
        embed, place, own = w["embed"], w["place"], w["place"][CONTEXT:]
        heated, self.mixed = net.products()
        one = lambda rows, x: np.hstack([rows, np.full((len(rows), 1), x, np.float32)])
        self.net = net
        self.queries, self.places = (embed @ heated, own @ heated), (one(embed, 1), one(place, 0))
        self.heads = w["upper"], w["lower"]
        self.ones = np.ones(HALF, np.float32)
        # Within these bounds no exponential leaves the numbers of its kind.
        longest = lambda *rows: float(sum(np.linalg.norm(r, axis=1).max() for r in rows))
        apart = longest(embed @ w["query"], own @ w["query"]) * longest(embed @ w["key"], place @ w["key"]) * SIZE**-0.5
        self.calm = min(longest(*self.queries) * longest(embed, place), apart) < 40 and net.tame()

    def log_probabilities(self, inputs: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Natural logarithm of each target's probability; 0 beyond the end."""
        if not self.calm:
            return self.net.log_probabilities(inputs, targets)
        n = len(inputs)
        every, before = inputs.ravel(), inputs[:, CONTEXT:].ravel()
        q, x = self._rows(self.queries, before, n), self._rows(self.places, every, n)
        empty = every == VOCABULARY
        if empty.any():
            x.reshape(-1, SIZE + 1)[empty] = 0
        heat = q @ x[:, :, :SIZE].transpose(0, 2, 1)
        np.exp(heat, out=heat)
        heat *= _CAUSAL
        seen = (heat @ x).reshape(-1, SIZE + 1)
        hidden = (seen[:, :SIZE] / np.maximum(seen[:, SIZE:], np.float32(1e-30))) @ self.mixed
        hidden.reshape(n, STEP, SIZE)[:] += x[:, CONTEXT:, :SIZE]
        np.tanh(hidden, out=hidden)
        flat = np.maximum(targets.ravel(), 0)
        upper, lower = flat // HALF, flat % HALF
        rows, total = np.arange(len(flat)) * HALF, np.zeros(len(flat))
        for half, place, bias in zip(self.heads, (upper, lower), self.net._biases(inputs, upper)):
            logits = hidden @ half
            logits += bias
            total += logits.ravel()[rows + place]
            np.exp(logits, out=logits)
            total -= np.log(logits @ self.ones)
        return np.where(targets.ravel() >= 0, total, 0.0).reshape(targets.shape)

    @staticmethod
    def _rows(tables: tuple[np.ndarray, np.ndarray], ids: np.ndarray, n: int) -> np.ndarray:
        out = np.take(tables[0], ids, axis=0, mode="clip").reshape(n, *tables[1].shape)
        out += tables[1]
        return out


def bigrams(pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log probabilities of halves after each id, and after no id: counts, and as many more from the unigrams as an id has followers."""
    single = pairs.sum(axis=0) + 0.1
    single /= single.sum()
    followers = np.maximum((pairs > 0).sum(axis=1, keepdims=True), 1)
    share = (pairs + followers * single) / (pairs.sum(axis=1, keepdims=True) + followers)
    cells = np.vstack([share, single]).reshape(-1, HALF, HALF)
    upper = cells.sum(axis=2)
    lower = np.log(cells / upper[:, :, None]).reshape(-1, HALF)
    return np.log(upper).astype(np.float32), lower.astype(np.float32)


def fit(inputs: np.ndarray, targets: np.ndarray, pairs: np.ndarray | None = None) -> Attention:
    """Adam on windows, in a seeded order; ``pairs`` counts how often each id follows each other one."""
    net = Attention.start(np.bincount(targets[targets >= 0].ravel(), minlength=VOCABULARY).astype(float), pairs)
    descend(net, inputs, targets, EPOCHS, RATE)
    return net


def descend(net: Attention, inputs: np.ndarray, targets: np.ndarray, epochs: int, most: float) -> None:
    """Adam on windows, in place; rates fall from ``most`` to a tenth of it."""
    names, shapes = list(net.weights), [w.shape for w in net.weights.values()]
    bounds = np.cumsum([0, *(w.size for w in net.weights.values())])
    # All weights in one row: a step takes as many array operations as one matrix would.
    flat = np.concatenate([w.ravel() for w in net.weights.values()])
    net.weights = {name: flat[a:b].reshape(shape) for name, a, b, shape in zip(names, bounds, bounds[1:], shapes)}
    first, second, gradient, step = np.zeros_like(flat), np.zeros_like(flat), np.empty_like(flat), np.empty_like(flat)
    random, turn = np.random.default_rng(SEED), 0
    steps = max(epochs * -(-len(inputs) // BATCH), 1)
    for _ in range(epochs):
        order = random.permutation(len(inputs))
        for lo in range(0, len(order), BATCH):
            part = order[lo : lo + BATCH]
            turn += 1
            rate = most * (1 - 0.9 * turn / steps)
            found = net.gradients(inputs[part], targets[part])
            np.concatenate([found[name].ravel() for name in names], out=gradient)
            np.subtract(gradient, first, out=step)
            step *= 0.1
            first += step
            np.multiply(gradient, gradient, out=gradient)
            gradient -= second
            gradient *= 0.01
            second += gradient
            np.divide(second, 1 - 0.99**turn, out=gradient)
            np.sqrt(gradient, out=gradient)
            gradient += 1e-8
            np.divide(first, 1 - 0.9**turn, out=step)
            step *= rate
            step /= gradient
            flat -= step


def learned(net: Attention, ids: DataFrame) -> Attention:
    """The network after one pass over every window of all texts, given by (doc_id, ids) with packed ids.

    Parts are dealt by a hash and ordered, so neither files nor tasks change the result.
    """
    total = ids.agg(F.sum(F.octet_length("ids"))).first()[0]
    if not total:
        return net
    parts = F.lit(total // (2 * STEP * PART) + 1)
    placed = ids.select(F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "ids"), parts).alias("part"), "doc_id", "ids")
    placed = placed.repartition("part").sortWithinPartitions("part", "doc_id", "ids")

    def trained(cells: np.ndarray) -> pa.RecordBatch:
        own = Attention({k: v.copy() for k, v in net.weights.items()}, net.prior)
        descend(own, cells[:, :WINDOW], cells[:, WINDOW:], 1, RATE / 4)
        change = np.concatenate([(own.weights[k] - v).ravel() for k, v in net.weights.items()]).astype(float)
        whole = np.rint(change * FRACTION).astype(np.int64)
        # What a part does not hold, it says nothing of.
        at = np.flatnonzero(whole)
        n = len(cells)
        return pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(whole[at] * n), pa.array(np.full(len(at), n, np.int64))], ["at", "moved", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, now = [], 0, None
        for batch in batches:
            for part, cell in zip(batch.column(0).to_pylist(), batch.column(1)):
                if size and part != now:
                    yield trained(np.concatenate(waiting))
                    waiting, size = [], 0
                now = part
                inputs, targets = windows(np.frombuffer(cell.as_buffer(), np.int16).astype(np.int32))
                for lo in range(0, len(inputs), PART):
                    waiting.append(np.concatenate([inputs[lo : lo + PART], targets[lo : lo + PART]], axis=1))
                    size += len(waiting[-1])
                    if size >= PART:
                        yield trained(np.concatenate(waiting))
                        waiting, size = [], 0
        if size:
            yield trained(np.concatenate(waiting))

    moved = placed.select("part", "ids").mapInArrow(run, "at int, moved long, n long").groupBy("at").agg(F.sum("moved").alias("moved"), F.sum("n").alias("n")).toArrow()
    change = np.zeros(sum(w.size for w in net.weights.values()))
    change[moved.column("at").to_numpy()] = moved.column("moved").to_numpy() / moved.column("n").to_numpy() / FRACTION
    bounds = np.cumsum([w.size for w in net.weights.values()])[:-1]
    return Attention({k: (w + c.reshape(w.shape)).astype(w.dtype) for (k, w), c in zip(net.weights.items(), np.split(change, bounds))}, net.prior)


def sample_windows(docs: DataFrame, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Windows of the training sample: at most ``SAMPLE`` x ``SAMPLE_WINDOWS``, drawn from whole texts by a seeded choice."""

    @F.arrow_udf("array<int>")
    def draw(column: pa.Array) -> pa.Array:
        out = []
        for text in column:
            inputs, targets = windows(subwords(text.as_py() or "", path))
            chosen = np.arange(len(inputs))
            if len(chosen) > SAMPLE_WINDOWS:
                chosen = np.random.default_rng([SEED, len(inputs)]).choice(chosen, SAMPLE_WINDOWS, replace=False)
            out.append(np.concatenate([inputs[chosen], targets[chosen]], axis=1).ravel().astype(np.int32))
        return pa.array(out, pa.list_(pa.int32()))

    ids = bounded_sample(docs.select("doc_id").where("doc_id is not null").distinct(), "doc_id", SAMPLE, SEED)
    # Of several texts of one id the first in order, the same at every run.
    texts = docs.join(ids, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"))
    rows = texts.select("doc_id", draw(F.col("text")).alias("cells")).orderBy("doc_id").toArrow()
    cells = pc.list_flatten(rows.column("cells").combine_chunks()).to_numpy().astype(np.int32).reshape(-1, WINDOW + STEP)
    return cells[:, :WINDOW], cells[:, WINDOW:]


def word_counts(train: DataFrame) -> DataFrame:
    """(word, c): occurrences of every word's hash; each task adds up its own words before the shuffle."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "c"])

        for batch in batches:
            for _, _, hashes in T.words(batch.column(0), T.VISIBLE):
                waiting.append(hashes)
                size += len(hashes)
                if size >= 1 << 23:
                    yield flush()
                    waiting, size = [], 0
        if size:
            yield flush()

    return train.select("text").mapInArrow(count, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


@dataclass(frozen=True)
class Frequent:
    """Hashes of frequent words, sorted, and their counts."""

    words: np.ndarray
    counts: np.ndarray


def subword_pairs(ids: DataFrame) -> np.ndarray:
    """How often each id follows each other one in all texts, given by their packed ids; the end stands before the first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(VOCABULARY**2, np.int64)
        for batch in batches:
            for cell in batch.column(0):
                after = np.frombuffer(cell.as_buffer(), np.int16).astype(np.int32)
                before = np.concatenate([[END], after[:-1]])
                found, n = np.unique(before * VOCABULARY + after, return_counts=True)
                total[found] += n
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], ["pair", "c"])

    rows = ids.mapInArrow(count, "pair int, c long").groupBy("pair").agg(F.sum("c").alias("c")).toArrow()
    pairs = np.zeros(VOCABULARY**2)
    pairs[rows.column(0).to_numpy()] = rows.column(1).to_numpy()
    return pairs.reshape(VOCABULARY, VOCABULARY)


def _score(net: Attention | Scorer, texts: list[np.ndarray]) -> np.ndarray:
    """log10 probability of each text, given by its ids."""
    total = np.zeros(len(texts))
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and size < SPREAD:
            size += len(texts[last])
            last += 1
        some = texts[first:last]
        lengths = np.array([len(t) for t in some])
        counts = -(-lengths // STEP)
        # All windows of these texts: each text's ids from a multiple of STEP on, with room for the context before them.
        begins = np.cumsum(counts) - counts
        ids = np.concatenate(some)
        within = np.arange(len(ids)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        targets = np.full((int(counts.sum()), STEP), -1, np.int32)
        targets.ravel()[np.repeat(begins * STEP, lengths) + within] = ids
        room = np.arange(len(some)) * CONTEXT + begins * STEP
        before = np.full(len(targets) * STEP + len(some) * CONTEXT, VOCABULARY, np.int32)
        before[room + CONTEXT] = END
        follows = within < np.repeat(lengths, lengths) - 1
        before[(np.repeat(room, lengths) + within)[follows] + CONTEXT + 1] = ids[follows]
        owner = np.repeat(np.arange(len(some)), counts)
        starts = np.arange(len(targets)) * STEP + owner * CONTEXT
        logs = np.empty(len(targets))
        for lo in range(0, len(targets), TOGETHER):
            inputs = before[starts[lo : lo + TOGETHER, None] + np.arange(WINDOW)]
            logs[lo : lo + TOGETHER] = net.log_probabilities(inputs, targets[lo : lo + TOGETHER]).sum(axis=1)
        total[first:last] = T.sums(logs, counts)
        first = last
    return total / np.log(10)


def _read(docs: DataFrame, frequent: Frequent, path: str) -> DataFrame:
    """One row per document: sums over frequent words, packed subword ids, and the other words with their numbers."""
    schema = "row long, doc_id long, held_out boolean, n_words long, known long, logs double, ids binary, rest array<long>, times array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 40
        logs_of = np.log10(frequent.counts + 1.0)
        last = max(len(frequent.words) - 1, 0)
        for batch in batches:
            for first, counts, hashes in T.words(batch.column(2), T.VISIBLE):
                owner = np.repeat(np.arange(len(counts)), counts)
                if len(frequent.words):
                    place = np.minimum(np.searchsorted(frequent.words, hashes), last)
                    hit = frequent.words[place] == hashes
                else:
                    place, hit = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
                known = np.bincount(owner[hit], minlength=len(counts))
                logs = np.bincount(owner[hit], logs_of[place[hit]], minlength=len(counts)) if hit.any() else np.zeros(len(counts))
                rest, times, ends, at = [], [], [0], 0
                for n in counts.tolist():
                    found, k = np.unique(hashes[at : at + n][~hit[at : at + n]], return_counts=True)
                    rest.append(found.view(np.int64))
                    times.append(k.astype(np.int32))
                    ends.append(ends[-1] + len(found))
                    at += n
                ids = [subwords(t.as_py() or "", path).astype(np.int16).tobytes() for t in batch.column(2).slice(first, len(counts))]
                bounds = pa.array(ends, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(number + np.arange(len(counts))),
                        batch.column(0).slice(first, len(counts)).cast(pa.int64()),
                        batch.column(1).slice(first, len(counts)),
                        pa.array(counts.astype(np.int64)),
                        pa.array(known.astype(np.int64)),
                        pa.array(logs),
                        pa.array(ids, pa.binary()),
                        pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(rest))),
                        pa.ListArray.from_arrays(bounds, pa.array(np.concatenate(times))),
                    ],
                    ["row", "doc_id", "held_out", "n_words", "known", "logs", "ids", "rest", "times"],
                )
                number += len(counts)

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def _scored(read: DataFrame, net: Attention) -> DataFrame:
    """Rows with the model's score in place of their ids."""
    columns = ["row", "doc_id", "held_out", "n_words", "known", "logs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(net)
        for batch in batches:
            texts = [np.frombuffer(c.as_buffer(), np.int16).astype(np.int32) for c in batch.column(len(columns))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(columns)], pa.array(_score(scorer, texts))], [*columns, "score"])

    schema = "row long, doc_id long, held_out boolean, n_words long, known long, logs double, score double"
    return read.select(*columns, "ids").mapInArrow(run, schema)


def score_documents(docs: DataFrame, divisor: int = 7, held: int = 2, path: str = TOKENIZER) -> DataFrame:
    """Per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    out: Column = remainder(F.col("doc_id"), divisor) == held
    rows = docs.select("doc_id", out.alias("held_out"), F.col("text").cast("string").alias("text"))
    train = rows.where("not held_out")
    counts = written(word_counts(train), "lm_counts")
    ends = train.select("held_out").count()
    size = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = size["n"] + ends, size["v"] + (1 if ends else 0)
    top = counts.orderBy(F.col("c").desc(), "word").limit(FREQUENT).collect()
    words = np.array([r["word"] for r in top], np.int64).view(np.uint64)
    order = np.argsort(words)
    frequent = Frequent(words[order], np.array([r["c"] for r in top], float)[order])
    least = int(frequent.counts.min()) if len(top) == FREQUENT else 0

    read = written(_read(rows, frequent, path), "lm_read")
    texts = read.where("not held_out").select("doc_id", "ids")
    pairs = subword_pairs(texts.select("ids"))
    net = learned(fit(*sample_windows(train, path), pairs), texts).fold()
    scored = written(_scored(read, net), "lm_scored")
    rest = read.select("row", F.explode(F.arrays_zip("rest", "times")).alias("x")).select("row", F.col("x.rest").alias("word"), F.col("x.times").alias("times"))
    # Words above the least frequent of the travelling ones are never asked for here.
    found = rest.join(counts.where(F.col("c") <= least), "word") if least else None
    if found is not None:
        found = found.groupBy("row").agg(F.sum(F.col("times") * F.log10(F.col("c") + 1.0)).alias("more_logs"), F.sum("times").alias("more_known"))
        scored = scored.join(found, "row", "left")
    else:
        scored = scored.withColumns({"more_logs": F.lit(None).cast("double"), "more_known": F.lit(None).cast("long")})
    n_tokens = F.col("n_words") + 1
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + F.lit(float(np.log10(ends + 1.0)))
    return scored.select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("known") + F.coalesce("more_known", F.lit(0)) + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (logs - n_tokens * F.lit(float(np.log10(total + distinct + 1.0)))).alias("base_score"),
        "score",
    )
