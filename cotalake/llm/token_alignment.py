"""Alignment of two tokenizers: which tokens of the one cover which tokens of the other.

A is a byte-level BPE (its character offsets), B a sentencepiece model with byte fallback (the spans of its serialised form; the
immutable form of older releases is this one now). The spans give coarse cuts: a token that ends where the next one starts, with no
character shared, ends at that character. Tokens within one character (parts of multibyte characters in A, byte tokens in B) are
refined by their decoded bytes, counted from the last coarse cut.

Where a space stands between a character other than a space and a visible one, both tokenizers start a token: A's pattern takes the space to
what follows, and no piece of B holds a space behind another character (checked when the model is read). So texts are cut there, and
each distinct chunk is encoded and aligned once per task, however often it occurs; a document's result is put together from its chunks.

Counts of id pairs (documents that hold a pair) come from one grouped aggregation, added up within tasks first. The most
frequent pairs, a bounded number, travel with the tasks of the second reading; all others are joined.

Defined results: null and empty texts, and texts that either tokenizer does not give back byte by byte, have no tokens: zeros, and no
groups (''). Repeated rows count as documents each; a null id is an id. Texts of any length are taken whole. An empty table gives an
empty result. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cotalake.llm.common import written

#: Vocabulary files; every worker must be able to read them.
BYTE_MODEL, PIECE_MODEL = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs whose counts travel with the tasks; all others are joined.
FREQUENT = 1 << 19
#: Characters of distinct chunks a task remembers before it starts anew.
REMEMBERED = 3 << 20
#: Chunks encoded as one text.
BUNDLE = 512
#: Bytes of text aligned at a time.
TOGETHER = 1 << 22

_SPACE = "▁"
#: A space between a character other than a space and a visible one; the marks named are no white space for every library.
_CUT = re.compile("(?<! ) (?=[^\\s᠎​⁠﻿])")


def chunks(text: str) -> list[str]:
    """Pieces of space + text, each without the space it starts with."""
    parts = _CUT.split(" " + text)
    return parts[1:] if parts[0] == "" else [parts[0][1:], *parts[1:]]


def _byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: visible ones for themselves, the rest from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class Tokenizers:
    """Both tokenizers with the bytes of each of their ids."""

    _loaded: dict[tuple[str, str], Tokenizers] = {}

    def __init__(self, a: str, b: str):
        # Spark deals out the cores; a worker keeps to one.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a)
        self.a.encode_special_tokens = True
        alphabet = _byte_alphabet()
        names = {i: t for t, i in self.a.get_vocab().items()}
        self.a_bytes = [bytes(alphabet.get(c, 0) for c in names.get(i, "")) for i in range(max(names) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_byte = np.array([self.b.is_byte(i) for i in range(len(pieces))])
        self.b_bytes = [bytes([int(p[3:5], 16)]) if byte else p.replace(_SPACE, " ").encode() for p, byte in zip(pieces, self.b_byte)]
        # Chunks may be encoded one by one only if no piece runs across their bounds.
        self.separable = not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        self.a_length, self.b_length = (np.array([len(x) for x in t], np.int64) for t in (self.a_bytes, self.b_bytes))
        # The digest's words: an id and what follows it, one of nothing , | and ;
        self.words = [np.array([f"{i}{mark}" for i in range(n) for mark in ("", ",", "|", ";")], object) for n in (len(self.a_bytes), len(self.b_bytes))]

    @classmethod
    def get(cls, a: str, b: str) -> Tokenizers:
        """Read once per process."""
        if (a, b) not in cls._loaded:
            cls._loaded[a, b] = cls(a, b)
        return cls._loaded[a, b]


@dataclass
class Aligned:
    """Alignments of pieces of text, as columns; ``links`` and ``times`` hold distinct pairs of ids from ``starts`` on."""

    whole: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[str]
    starts: np.ndarray
    links: np.ndarray
    times: np.ndarray


def _flat(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((x for part in lists for x in part), np.int64, int(counts.sum())), counts


def _last_true(flags: np.ndarray) -> np.ndarray:
    """Per place, the last earlier place whose flag is set; -1 where none is."""
    at = np.where(flags, np.arange(len(flags)), -1)
    return np.concatenate([[-1], np.maximum.accumulate(at)[:-1]]) if len(flags) else at


def refined(coarse: np.ndarray, sure: np.ndarray, lengths: np.ndarray, counts: np.ndarray, bases: np.ndarray) -> np.ndarray:
    """Byte ends of tokens: the coarse cut where it is sure, else the last sure one of the piece and the decoded bytes since."""
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(counts)), counts)
    run = np.cumsum(lengths)
    before = _last_true(sure)
    inside = before >= first[owner]
    start = np.where(inside, coarse[before], bases[owner])
    behind = np.where(inside, run[before], run[first[owner]] - lengths[first[owner]] if len(owner) else 0)
    return np.where(sure, coarse, start + run - behind)


def ends_a(t: Tokenizers, texts: list[str], data: np.ndarray, bases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of A, their numbers per text, and byte ends over all texts; a text starts at its base."""
    encoded = t.a.encode_batch(texts, add_special_tokens=False)
    ids, counts = _flat([e.ids for e in encoded])
    spans = np.array([x for e in encoded for x in e.offsets], np.int64).reshape(-1, 2)
    owner = np.repeat(np.arange(len(counts)), counts)
    # Characters to bytes: where each character starts, over all texts.
    places = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    first = np.searchsorted(places, bases)[owner]
    last = np.ones(len(ids), bool)
    last[:-1] = owner[1:] != owner[:-1]
    sure = last.copy()
    sure[:-1] |= spans[:-1, 1] <= spans[1:, 0]
    return ids, counts, refined(places[first + spans[:, 1]], sure, t.a_length[ids], counts, bases)


def ends_b(t: Tokenizers, texts: list[str], bases: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``ends_a`` for B, whose texts lack the space at the start."""
    encoded = t.b.encode(texts, return_type="proto", num_threads=1)
    cells = [(p.id, p.end) for e in encoded for p in e.pieces]
    counts = np.fromiter((len(e.pieces) for e in encoded), np.int64, len(encoded))
    flat = np.array(cells, np.int64).reshape(-1, 2)
    ids, stops = flat[:, 0], flat[:, 1]
    owner = np.repeat(np.arange(len(counts)), counts)
    return ids, counts, refined(bases[owner] + 1 + stops, ~t.b_byte[ids], t.b_length[ids], counts, bases)


def align(t: Tokenizers, texts: list[str]) -> Aligned:
    """Tokens, groups and links of each text; the texts lack the space that both tokenizers get before them.

    Texts that neither start nor end in white space are encoded many at once, with a space between: tokens start there.
    """
    bundles, open_until = [], 0
    for k, x in enumerate(texts):
        if not t.separable or x[-1:].isspace() or not _CUT.match(" " + x):
            bundles.append([k])
            open_until = 0
        elif open_until:
            bundles[-1].append(k)
            open_until -= 1
        else:
            bundles.append([k])
            open_until = BUNDLE - 1
    sizes = np.fromiter(map(len, map(str.encode, texts)), np.int64, len(texts)) + 1
    return _aligned(t, texts, sizes, bundles)


def _aligned(t: Tokenizers, texts: list[str], sizes: np.ndarray, bundles: list[list[int]]) -> Aligned:
    joined = [" ".join(map(texts.__getitem__, b)) for b in bundles]
    raw = [(" " + x).encode() for x in joined]
    data = np.frombuffer(b"".join(raw), np.uint8)
    bases = np.cumsum(sizes) - sizes
    starts = bases[[b[0] for b in bundles]]
    ids_a, of_a, cut_a = ends_a(t, [" " + x for x in joined], data, starts)
    ids_b, of_b, cut_b = ends_b(t, joined, starts)
    right = _same(ids_a, of_a, t.a_bytes, raw) & _same(ids_b, of_b, t.b_bytes, raw)
    if any(len(b) > 1 and not ok for b, ok in zip(bundles, right)):
        # Some text is not given back: its bundle goes again, one by one.
        return _aligned(t, texts, sizes, [c for b, ok in zip(bundles, right) for c in ([b] if ok else [[k] for k in b])])
    whole = np.repeat(right, [len(b) for b in bundles])
    keep_a, keep_b = np.repeat(right, of_a), np.repeat(right, of_b)
    ids_a, cut_a, ids_b, cut_b = ids_a[keep_a], cut_a[keep_a], ids_b[keep_b], cut_b[keep_b]
    n = len(texts)
    # Every end belongs to one interval, which lies in one token of each side: one link.
    every, sides = np.unique(np.concatenate([cut_a, cut_b]), return_counts=True)
    both = every[sides == 2]
    at_a, at_b = np.searchsorted(cut_a, every), np.searchsorted(cut_b, every)
    own = np.searchsorted(bases, every - 1, "right") - 1
    n_groups, n_links = np.bincount(own[sides == 2], minlength=n), np.bincount(own, minlength=n)
    n_a, n_b = (np.bincount(np.searchsorted(bases, cut - 1, "right") - 1, minlength=n) for cut in (cut_a, cut_b))
    pair = ids_a[at_a] * len(t.b_bytes) + ids_b[at_b]
    span = len(t.a_bytes) * len(t.b_bytes)
    found, times = np.unique(own * span + pair, return_counts=True)
    return Aligned(whole, n_a, n_b, n_groups, n_links, _digests(t, ids_a, cut_a, ids_b, cut_b, both, n_groups),
                   np.searchsorted(found, np.arange(n + 1) * span), found % span, times)


def _same(ids: np.ndarray, counts: np.ndarray, table: list[bytes], raw: list[bytes]) -> np.ndarray:
    tokens = [table[i] for i in ids.tolist()]
    stops = np.cumsum(counts).tolist()
    return np.fromiter((b"".join(tokens[lo:hi]) == x for lo, hi, x in zip([0, *stops], stops, raw)), bool, len(raw))


def _digests(t: Tokenizers, ids_a, cut_a, ids_b, cut_b, both, n_groups) -> list[str]:
    """Per text its groups as text: A's ids, then B's, group by group."""
    # What follows a token: , within a side, | at the end of A's, ; at the end of B's.
    end_a, end_b = np.isin(cut_a, both, assume_unique=True), np.isin(cut_b, both, assume_unique=True)
    words = np.concatenate([t.words[0][ids_a * 4 + np.where(end_a, 2, 1)], t.words[1][ids_b * 4 + np.where(end_b, 3, 1)]])
    group = np.concatenate([np.searchsorted(both, cut_a), np.searchsorted(both, cut_b)])
    order = np.argsort(group, kind="stable")
    words, sizes = words[order].tolist(), np.bincount(group, minlength=len(both))
    stops = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(n_groups)])].tolist()
    return ["".join(words[lo:hi])[:-1] for lo, hi in zip(stops, stops[1:])]


class Memory:
    """Alignments of the distinct chunks seen by a task; emptied when it has grown to ``REMEMBERED`` characters."""

    def __init__(self, t: Tokenizers):
        self.t = t
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[str, int] = {}
        self.size = 0
        self.parts: list[Aligned] = []

    def number(self, found: list[list[str]]) -> list[np.ndarray]:
        """The numbers of each text's chunks; unseen ones are aligned."""
        if self.size > REMEMBERED:
            self.clear()
        known = self.numbers
        new = [c for c in dict.fromkeys(c for text in found for c in text) if c not in known]
        for c in new:
            known[c] = len(known)
        if new:
            self.size += sum(map(len, new))
            self.parts.append(align(self.t, new))
            self._join()
        return [np.fromiter(map(known.__getitem__, text), np.int64, len(text)) for text in found]

    def _join(self) -> None:
        parts = self.parts
        if len(parts) > 1:
            merged = {n: np.concatenate([getattr(p, n) for p in parts]) for n in ("whole", "n_a", "n_b", "n_groups", "n_links", "links", "times")}
            shift = len(parts[0].links)
            self.parts = [Aligned(groups=parts[0].groups + parts[1].groups, starts=np.concatenate([parts[0].starts[:-1], parts[1].starts + shift]), **merged)]

    @property
    def all(self) -> Aligned:
        return self.parts[0]


def _documents(memory: Memory, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text: counts (a, b, groups, links), digest; and the distinct pairs of all with owner and number."""
    found = [chunks(x) if memory.t.separable and x else [x] if x else [] for x in texts]
    lists = memory.number(found)
    counts = np.zeros((len(texts), 4), np.int64)
    if not memory.parts:
        return counts, [""] * len(texts), *(np.zeros(0, np.int64) for _ in range(3))
    known = memory.all
    flat = np.concatenate(lists)
    owner = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    good = np.bincount(owner[~known.whole[flat]], minlength=len(texts)) == 0
    table = np.column_stack([known.n_a, known.n_b, known.n_groups, known.n_links])
    np.add.at(counts, owner, table[flat])
    counts[~good] = 0
    shas = [hashlib.sha256(";".join(map(known.groups.__getitem__, x.tolist())).encode()).hexdigest() if ok and len(x) else "" for x, ok in zip(lists, good)]
    use = good[owner]
    # Distinct chunks of each document, then their pairs.
    cells, often = np.unique(owner[use] * len(known.n_a) + flat[use], return_counts=True)
    chunk, doc = cells % len(known.n_a), cells // len(known.n_a)
    sizes = known.starts[chunk + 1] - known.starts[chunk]
    place = np.repeat(known.starts[chunk] - (np.cumsum(sizes) - sizes), sizes) + np.arange(int(sizes.sum()))
    span = len(memory.t.a_bytes) * len(memory.t.b_bytes)
    keys = np.repeat(doc, sizes) * span + known.links[place]
    pairs, back = np.unique(keys, return_inverse=True)
    times = np.bincount(back, np.repeat(often, sizes) * known.times[place], len(pairs)).astype(np.int64)
    return counts, shas, pairs // span, pairs % span, times


def _grouped(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """Rows in groups of about ``TOGETHER`` bytes; null counts as empty."""
    at, size, texts = 0, 0, []
    for k, cell in enumerate(column):
        texts.append(cell.as_py() or "")
        size += len(texts[-1])
        if size >= TOGETHER:
            yield at, texts
            at, size, texts = k + 1, 0, []
    if texts:
        yield at, texts


def _planes(values: np.ndarray, kind: type) -> bytes:
    """Integers as planes of bytes, which compress well."""
    return np.ascontiguousarray(values.astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()


def _from_planes(cell: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(cell, np.uint8).reshape(size, -1).T).view(kind).ravel()


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_READ = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"


def read_tokens(docs: DataFrame, doc_id: str, text: str, a: str, b: str) -> DataFrame:
    """Per document its numbers and groups, and its distinct pairs packed as differences."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, number = Memory(Tokenizers.get(a, b)), TaskContext.get().partitionId() << 40
        for batch in batches:
            for first, texts in _grouped(batch.column(1)):
                counts, shas, owner, pairs, times = _documents(memory, texts)
                cuts = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
                packed = [_planes(np.diff(pairs[lo:hi], prepend=0), np.int64) for lo, hi in zip(cuts, cuts[1:])]
                often = [_planes(times[lo:hi], np.int64) for lo, hi in zip(cuts, cuts[1:])]
                rows = [pa.array(number + np.arange(len(texts))), batch.column(0).slice(first, len(texts))]
                rows += [pa.array(counts[:, k]) for k in range(4)]
                rows += [pa.array(shas, pa.string()), pa.array(packed, pa.binary()), pa.array(often, pa.binary())]
                yield pa.RecordBatch.from_arrays(rows, ["row", "doc_id", *_COUNTS, "groups_sha256", "pairs", "times"])
                number += len(texts)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(run, _READ)


def pair_counts(read: DataFrame) -> DataFrame:
    """(pair, c): documents that hold a pair."""
    return read.select("pairs").mapInArrow(_count_pairs, "pair long, c long").groupBy("pair").agg(F.sum("c").alias("c"))


def _count_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: list[np.ndarray] = []
    size, kept, times = 0, np.zeros(0, np.int64), np.zeros(0, np.int64)

    def merged() -> tuple[np.ndarray, np.ndarray]:
        found, n = np.unique(np.concatenate(waiting), return_counts=True)
        every, back = np.unique(np.concatenate([kept, found]), return_inverse=True)
        return every, np.bincount(back, np.concatenate([times, n]), len(every)).astype(np.int64)

    for batch in batches:
        for cell in batch.column(0):
            waiting.append(np.cumsum(_from_planes(cell.as_py(), np.int64)))
            size += len(waiting[-1])
        if size >= 1 << 22:
            kept, times = merged()
            waiting, size = [], 0
            if len(kept) >= 1 << 22:
                yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(times)], ["pair", "c"])
                kept, times = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if size:
        kept, times = merged()
    if len(kept):
        yield pa.RecordBatch.from_arrays([pa.array(kept), pa.array(times)], ["pair", "c"])


def _with_best(counts: DataFrame, size_b: int) -> DataFrame:
    """Also whether no pair of the same A id is in more documents."""
    marked = counts.withColumn("a", F.floor(F.col("pair") / size_b))
    highest = marked.groupBy("a").agg(F.max("c").alias("most"))
    return marked.join(highest, "a").select("pair", "c", (F.col("c") == F.col("most")).alias("best"))


def align_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", a: str = BYTE_MODEL, b: str = PIECE_MODEL) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    read = written(read_tokens(docs, doc_id, text, a, b), "align_read")
    size_b = len(Tokenizers.get(a, b).b_bytes)
    counts = written(_with_best(pair_counts(read), size_b), "align_counts")
    top = counts.orderBy(F.col("c").desc(), "pair").limit(FREQUENT).toArrow()
    pairs, c, best = (top.column(k).to_numpy() for k in range(3))
    order = np.argsort(pairs)
    pairs, c, best = pairs[order].astype(np.int64), c[order].astype(np.int64), best[order].astype(np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = max(len(pairs) - 1, 0)
        for batch in batches:
            n = batch.num_rows
            sums, more = np.zeros((n, 2), np.int64), []
            for k in range(n):
                own = np.cumsum(_from_planes(batch.column("pairs")[k].as_py(), np.int64))
                times = _from_planes(batch.column("times")[k].as_py(), np.int64)
                place = np.minimum(np.searchsorted(pairs, own), last)
                hit = pairs[place] == own if len(pairs) else np.zeros(len(own), bool)
                sums[k] = (best[place[hit]] * times[hit]).sum(), (c[place[hit]] * times[hit]).sum()
                more.append([{"pair": p, "times": t} for p, t in zip(own[~hit].tolist(), times[~hit].tolist())])
            out = batch.drop_columns(["pairs", "times"])
            out = out.append_column("n_best", pa.array(sums[:, 0])).append_column("count_sum", pa.array(sums[:, 1]))
            yield out.append_column("rest", pa.array(more, pa.list_(pa.struct([("pair", pa.int64()), ("times", pa.int64())]))))

    schema = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long, rest array<struct<pair:long,times:long>>"
    scored = read.mapInArrow(run, schema)
    columns = ["doc_id", *_COUNTS, "n_best", "count_sum", "groups_sha256"]
    if len(pairs) < FREQUENT:
        return scored.select(*columns)
    scored = written(scored, "align_scored")
    rest = scored.select("row", F.explode("rest").alias("x")).select("row", "x.pair", "x.times").join(counts.where(F.col("c") <= int(c.min())), "pair")
    sums = rest.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("c") * F.col("times")).alias("more_sum"))
    joined = scored.join(sums, "row", "left")
    joined = joined.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))})
    return joined.select(*columns)
