"""Removal of repeated passages: every byte within a string of ``LENGTH`` bytes that also starts earlier.

Equal strings must meet, unequal ones need not. Of the grams of ``GRAM`` bytes in a string of ``LENGTH`` bytes, the one with the least
hash (the first of several) is its anchor: equal strings have equal anchors. Neighbouring strings mostly share theirs, so the strings of one anchor occurrence are one
stretch of text, a segment. A row per segment, with hashes of anchor and segment, is shuffled by anchor:

* equal segments: all but the earliest are repeats (those of one block of text are settled before the shuffle);
* an anchor with one segment holds no repeat;
* the first segments of an anchor with several different ones fetch their text and are indexed, in collections of bounded size, by a Burrows-Wheeler
  transform with common prefixes, built column by column (``collection_index``). Where neighbouring suffixes share ``LENGTH`` bytes, all but
  the earliest are repeats.

Anchors with very many different segments (a heading before ever new text) are not gathered: their strings go each under its own hash, of
128 bits, all rows. A sample of documents tells which anchors to treat so from the start, so that no task gets too many rows; those it misses are
counted and treated so later. The result does not depend on the sample.

Order is by document (ids ascending, nulls first, then texts), then by place. Spans found anywhere meet again by document, and are cut out.

Defined results: null texts are empty. Texts below ``LENGTH`` bytes stay whole. Rows with equal or null ids, or ids that are not whole numbers, are documents of
their own, of which equal ones are kept in any order. Texts of any length are read whole, in pieces that overlap. An empty table gives an empty result. Other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from cotalake.llm import text as T
from cotalake.llm.collection_index import Collection
from cotalake.llm.common import written

#: Bytes of a string that counts as repeated, and of the grams that are its anchors.
LENGTH, GRAM = 100, 40
#: Text, and rows, whose equal segments are settled together, before the shuffle.
TOGETHER, ROWS = 1 << 23, 1 << 19
#: Share of the documents read for anchors with many different segments, and how many segments there make an anchor one of these.
SAMPLED, MANY = 64, 24
#: Such anchors that travel with the tasks; the others are found by counting.
LISTED = 1 << 16
#: Different segments of one anchor that are indexed together at most.
GATHERED = 1 << 14
#: Bytes of segments in one collection.
COLLECTION = 1 << 20
#: Places within a piece of text, in the low bits of a hash.
_PLACE = np.uint64((1 << 20) - 1)
_SALTS = (np.uint64(0x9FB21C651E98DF25), np.uint64(0xC2B2AE3D27D4EB4F))


class Prefixes:
    """Hashes of any stretch of some bytes."""

    def __init__(self, data: np.ndarray):
        T._powers_to(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * T._powers[: len(data)], out=self.sums[1:])

    def every(self, width: int) -> np.ndarray:
        n = max(len(self.sums) - width, 0)
        return T.mix((self.sums[width:] - self.sums[:n]) * T._inverses[:n]) if n else np.zeros(0, np.uint64)

    def of(self, starts: np.ndarray, ends: np.ndarray, salt: int = 0) -> np.ndarray:
        return T.mix((self.sums[ends] - self.sums[starts]) * T._inverses[starts] + (ends - starts).astype(np.uint64) * _SALTS[salt])


def least_in_windows(values: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span < width and len(values) > 1:
        step = min(span, width - span)
        values, span = np.minimum(values[:-step], values[step:]), span + step
    return values


def segments(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Anchor hash, segment hash, first and last string start of every segment, in texts that lie one after the other."""
    none = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(data) < length:
        return none
    sums = Prefixes(data)
    hashes = sums.every(gram)
    # The place in the low bits: of equal hashes the first one counts, and the least value tells where it is.
    least = least_in_windows((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), length - gram + 1)
    anchor = (least & _PLACE).astype(np.int64)
    inside = np.arange(len(anchor)) + length <= np.repeat(offsets[1:], np.diff(offsets))[: len(anchor)]
    turn = anchor[1:] != anchor[:-1]
    first, last = inside.copy(), inside.copy()
    first[1:] &= turn | ~inside[:-1]
    last[:-1] &= turn | ~inside[1:]
    f, l = np.flatnonzero(first), np.flatnonzero(last)
    return hashes[anchor[f]], sums.of(f, l + length), f, l


def strings_of(data: np.ndarray, first: np.ndarray, last: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The strings of some segments one by one: two hashes, the start, and which segment."""
    counts = last - first + 1
    owner = np.repeat(np.arange(len(first)), counts)
    starts = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts) + first[owner]
    sums = Prefixes(data)
    return sums.of(starts, starts + length, 1), sums.of(starts, starts + length), starts, owner


def may_share(anchor: np.ndarray, data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> np.ndarray:
    """Which segments can share a string with another one of their anchor.

    The string holds the anchor and ``length - gram`` bytes around it, half of them before it or half of them behind it: so the anchor
    with that many bytes on one side is shared too.
    """
    sums, n = Prefixes(data), len(anchor)
    starts, ends = offsets[:-1], offsets[1:]
    owner = np.repeat(np.arange(n), ends - starts)[: max(len(data) - gram + 1, 0)]
    at = np.flatnonzero((sums.every(gram) == anchor[owner]) & (np.arange(len(owner)) + gram <= ends[owner]))
    place = np.full(n, -1, np.int64)
    place[owner[at][::-1]] = at[::-1]
    half = (length - gram + 1) // 2
    # Where an anchor is not found again, nothing is ruled out.
    shared = place < 0
    for before, behind in ((half, 0), (0, half)):
        lo, hi = place - before, place + gram + behind
        some = np.flatnonzero((place >= 0) & (lo >= starts) & (hi <= ends))
        key = sums.of(lo[some], hi[some])
        order = np.lexsort((key, anchor[some]))
        a, k, rows = anchor[some][order], key[order], some[order]
        same = (a[1:] == a[:-1]) & (k[1:] == k[:-1])
        shared[rows[1:][same]] = True
        shared[rows[:-1][same]] = True
    return shared


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans as maximal runs per document."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    if not len(doc):
        return doc, start, stop
    other = np.concatenate([[True], doc[1:] != doc[:-1]])
    # The furthest end so far, kept apart by document.
    rank = np.cumsum(other) - 1
    reach = int(stop.max()) + 1
    furthest = np.maximum.accumulate(rank * reach + stop) - rank * reach
    new = other.copy()
    new[1:] |= start[1:] > furthest[:-1]
    heads = np.flatnonzero(new)
    return doc[heads], start[heads], np.maximum.reduceat(stop, heads)


def _pieces(column: pa.Array, length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Bytes, bounds, row and place within the row of texts handled together; a long text comes in pieces that share ``length - 1`` bytes."""
    data, offsets = T.utf8(column)
    for first, last in T.groups(offsets):
        part, bounds = data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        if last - first > 1 or len(part) <= T.CHUNK:
            yield part, bounds, np.arange(first, last), np.zeros(last - first, np.int64)
        else:
            for at in range(0, max(len(part) - length + 1, 1), T.CHUNK):
                piece = part[at : at + T.CHUNK + length - 1]
                yield piece, np.array([0, len(piece)]), np.array([first]), np.array([at])


_ROWS = "a long, d long, doc long, place long, strings int"


def _batch(a, d, doc, place, strings) -> pa.RecordBatch:
    arrays = [pa.array(np.asarray(x).astype(np.uint64).view(np.int64)) if k < 2 else pa.array(np.asarray(x), pa.int64() if k < 4 else pa.int32()) for k, x in enumerate((a, d, doc, place, strings))]
    return pa.RecordBatch.from_arrays(arrays, ["a", "d", "doc", "place", "strings"])


def segment_rows(docs: DataFrame, many: np.ndarray, length: int, gram: int) -> DataFrame:
    """One row per different segment of a block of text, the earliest; and, with 0 strings, the spans of its repeats (their length in ``d``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[np.ndarray, ...]] = []
        size = 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for data, bounds, rows, at in _pieces(batch.column(1), length):
                a, d, f, l = segments(data, bounds, length, gram)
                own = np.searchsorted(bounds, f, "right") - 1
                base = at[own] - bounds[own]
                if len(many) and len(a):
                    hot = many[np.minimum(np.searchsorted(many, a), len(many) - 1)] == a
                    if hot.any():
                        a2, d2, start, of = strings_of(data, f[hot], l[hot], length)
                        waiting.append((a2, d2, ids[rows[own[hot][of]]], start + base[hot][of], np.ones(len(a2), np.int64)))
                        a, d, f, l, own, base = a[~hot], d[~hot], f[~hot], l[~hot], own[~hot], base[~hot]
                waiting.append((a, d, ids[rows[own]], f + base, l - f + 1))
                size += len(data)
                # Strings of their own, a row each, may be many times the segments.
                if size >= TOGETHER or sum(len(w[0]) for w in waiting) >= ROWS:
                    yield from settle(waiting)
                    waiting, size = [], 0
        yield from settle(waiting)

    def settle(waiting: list[tuple[np.ndarray, ...]]) -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        a, d, doc, place, strings = (np.concatenate(c) for c in zip(*waiting))
        order = np.lexsort((place, doc, d, a))
        a, d, doc, place, strings = a[order], d[order], doc[order], place[order], strings[order]
        new = np.ones(len(a), bool)
        new[1:] = (a[1:] != a[:-1]) | (d[1:] != d[:-1])
        yield _batch(a[new], d[new], doc[new], place[new], strings[new])
        spans = merged(doc[~new], place[~new], place[~new] + strings[~new] + length - 1)
        key = T.mix(spans[0].astype(np.uint64) * _SALTS[0])
        yield _batch(key, spans[2] - spans[1], spans[0], spans[1], np.zeros(len(key), np.int64))

    return docs.select("doc", "text").mapInArrow(run, _ROWS)


_FOUND = "a long, doc long, place long, stop long"


def repeats(rows: DataFrame, length: int) -> DataFrame:
    """Spans of repeats (a null), and first segments of anchors with several different ones."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[np.ndarray, ...] | None = None
        told = False
        for batch in batches:
            a, d, doc, place, strings = (batch.column(k).to_numpy() for k in range(5))
            span = strings == 0
            if span.any():
                yield found(None, doc[span], place[span], place[span] + d[span])
            cells = [x[~span] for x in (a, d, doc, place, strings)]
            if not len(cells[0]):
                continue
            # The last first segment of the batch before goes ahead, as its group may go on.
            if held is not None:
                cells = [np.concatenate([h, x]) for h, x in zip(held, cells)]
            a, d, doc, place, strings = cells
            other = np.concatenate([[True], a[1:] != a[:-1]])
            new = other.copy()
            new[1:] |= d[1:] != d[:-1]
            yield found(None, doc[~new], place[~new], place[~new] + strings[~new] + length - 1)
            heads = np.flatnonzero(new)
            same = a[heads[1:]] == a[heads[:-1]]
            several = np.zeros(len(heads), bool)
            several[1:] |= same
            several[:-1] |= same
            tell = several.copy()
            if held is not None:
                tell[0] &= not told
                told = told if len(heads) == 1 else bool(several[-1])
            else:
                told = bool(several[-1])
            chosen = heads[tell]
            yield found(a[chosen], doc[chosen], place[chosen], place[chosen] + strings[chosen] + length - 1)
            held = tuple(x[heads[-1:]] for x in cells)

    def found(a, doc, place, stop) -> pa.RecordBatch:
        first = pa.nulls(len(doc), pa.int64()) if a is None else pa.array(a)
        return pa.RecordBatch.from_arrays([first, *(pa.array(np.asarray(x), pa.int64()) for x in (doc, place, stop))], ["a", "doc", "place", "stop"])

    return rows.repartition("a").sortWithinPartitions("a", "d", "doc", "place").mapInArrow(run, _FOUND)


def many_segments(docs: DataFrame, length: int, gram: int) -> np.ndarray:
    """Anchors of very many different segments in a sample of documents: hashes, sorted."""
    sample = docs.where(F.pmod(F.xxhash64("doc"), F.lit(SAMPLED)) == 0)
    rows = segment_rows(sample, np.zeros(0, np.uint64), length, gram).where("strings > 0")
    counts = rows.select("a", "d").distinct().groupBy("a").count().where(F.col("count") >= MANY)
    top = counts.orderBy(F.col("count").desc(), "a").limit(LISTED).toArrow()
    return np.sort(top.column(0).to_numpy().astype(np.int64).view(np.uint64))


def segment_texts(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The found segments with their bytes."""
    own = found.groupBy("doc").agg(F.collect_list(F.struct("a", "place", "stop", "large")).alias("segments"))
    joined = docs.join(own, "doc").select("doc", "text", "segments")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.utf8(batch.column(1))
            lists = batch.column(2)
            counts = lists.value_lengths().to_numpy()
            cells = lists.flatten()
            a, place, stop, large = (cells.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            owner = np.repeat(np.arange(batch.num_rows), counts)
            starts, sizes = offsets[owner] + place, stop - place
            for lo in range(0, len(a), 1 << 14):
                part = slice(lo, lo + (1 << 14))
                n = sizes[part]
                bounds = np.concatenate([[0], np.cumsum(n)])
                at = np.repeat(starts[part] - bounds[:-1], n) + np.arange(bounds[-1])
                text = pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(bounds.astype(np.int32).tobytes()), pa.py_buffer(data[at].tobytes())])
                yield pa.RecordBatch.from_arrays([pa.array(a[part]), pa.array(batch.column(0).to_numpy()[owner[part]]), pa.array(place[part]), pa.array(large[part]), text], ["a", "doc", "place", "large", "cell"])

    return joined.mapInArrow(run, "a long, doc long, place long, large boolean, cell binary")


def _cells(batch: pa.RecordBatch | pa.Table, name: str) -> tuple[np.ndarray, np.ndarray]:
    column = batch.column(name)
    return T.utf8(column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column)


def single_strings(texts: DataFrame, length: int) -> DataFrame:
    """The strings of segments one by one, as rows for ``repeats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = _cells(batch, "cell")
            doc, place = batch.column("doc").to_numpy(), batch.column("place").to_numpy()
            for first, last in T.groups(offsets):
                bounds = offsets[first : last + 1] - offsets[first]
                a, d, start, owner = strings_of(data[offsets[first] : offsets[last]], bounds[:-1], bounds[1:] - length, length)
                yield _batch(a, d, doc[first + owner], place[first + owner] + start - bounds[owner], np.ones(len(a), np.int64))

    return texts.select("doc", "place", "cell").mapInArrow(run, _ROWS)


def indexed_repeats(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """Spans of repeats among the segments of each anchor, by the index of collections of whole groups."""

    def search(group: pa.Table) -> pa.RecordBatch:
        data, offsets = _cells(group, "cell")
        shared = may_share(group.column("a").to_numpy().view(np.uint64), data, offsets, length, gram)
        group = group.filter(pa.array(shared)).combine_chunks()
        data, offsets = _cells(group, "cell")
        doc, place = group.column("doc").to_numpy(), group.column("place").to_numpy()
        index = Collection(data, offsets, length)
        owner, left, common = index.suffixes(length)
        index.close()
        start = place[owner] + np.diff(offsets)[owner] - left
        # The rank of (document, place): the earliest of a run of equal strings stays.
        order = np.lexsort((start, doc[owner]))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        if not len(rank):
            return spans(doc[:0], start, start)
        new = common < length
        new[0] = True
        earliest = np.minimum.reduceat(rank, np.flatnonzero(new))[np.cumsum(new) - 1]
        again = rank != earliest
        return spans(*merged(doc[owner[again]], start[again], start[again] + length))

    def spans(doc, start, stop) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.asarray(x), pa.int64()) for x in (doc, start, stop)], ["doc", "place", "stop"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            waiting.append(batch)
            size += batch.column("cell").nbytes
            if size < COLLECTION:
                continue
            table = pa.Table.from_batches(waiting).combine_chunks()
            # All but the last group, which may go on.
            keys = table.column("a").to_numpy()
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole:
                yield from search_all(table.slice(0, whole))
                table = table.slice(whole)
            waiting = table.combine_chunks().to_batches()
            size = sum(b.column("cell").nbytes for b in waiting)
        if waiting:
            yield from search_all(pa.Table.from_batches(waiting).combine_chunks())

    def search_all(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = table.column("a").to_numpy()
        _, offsets = _cells(table, "cell")
        heads = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        at = 0
        while at < len(keys):
            # Whole groups up to the size of a collection; a larger group stands alone.
            fits = heads[(heads > at) & (offsets[heads] <= offsets[at] + COLLECTION)]
            later = heads[heads > at]
            stop = len(keys) if offsets[-1] <= offsets[at] + COLLECTION or not len(later) else int(fits[-1]) if len(fits) else int(later[0])
            yield search(table.slice(at, stop - at).combine_chunks())
            at = stop

    return texts.repartition("a").sortWithinPartitions("a").mapInArrow(run, "doc long, place long, stop long")


def numbered(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, id, text): rows with a number that has the order of documents; unique whole ids serve themselves."""
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text"))
    if isinstance(rows.schema["id"].dataType, (ST.LongType, ST.IntegerType, ST.ShortType, ST.ByteType)):
        repeated = rows.groupBy("id").count().where("id is null or count > 1")
        if repeated.isEmpty():
            return rows.select(F.col("id").cast("long").alias("doc"), "id", "text")
    order = [F.col("id").asc_nulls_first(), F.col("text").asc_nulls_first()]
    return written(rows.orderBy(*order).withColumn("doc", F.monotonically_increasing_id()).select("doc", "id", "text"), "repeats_numbered")


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """(doc, place, stop): bytes of repeats; spans of one document may overlap. ``docs`` is as ``numbered`` gives it."""
    many = many_segments(docs, length, gram)
    found = written(repeats(segment_rows(docs, many, length, gram), length), "repeats_found")
    spans = found.where("a is null").select("doc", "place", "stop")
    several = found.where("a is not null")
    large = several.groupBy("a").count().where(F.col("count") > GATHERED).select("a", F.lit(True).alias("large"))
    several = several.join(large, "a", "left").withColumn("large", F.coalesce("large", F.lit(False)))
    texts = written(segment_texts(docs, several), "repeats_texts")
    spans = spans.unionByName(written(indexed_repeats(texts.where("not large"), length, gram), "repeats_indexed"))
    apart = texts.where("large")
    if not apart.isEmpty():
        spans = spans.unionByName(repeats(single_strings(apart, length), length).where("a is null").select("doc", "place", "stop"))
    return spans


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Per document: its id, n_bytes, n_removed, n_spans, spans (start, stop) and the kept bytes."""
    rows = numbered(docs, doc_id, text)
    spans = repeated_spans(rows, length, gram).groupBy("doc").agg(F.collect_list(F.struct("place", "stop")).alias("spans"))
    joined = rows.join(spans, "doc", "left").select("id", "text", "spans")
    schema = joined.select(F.col("id").alias(doc_id)).schema
    for name, kind in (("n_bytes", "long"), ("n_removed", "long"), ("n_spans", "long"), ("spans", ST.ArrayType(ST.ArrayType(ST.LongType()))), ("kept", "binary")):
        schema = schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = T.utf8(batch.column(1))
            counts = batch.column(2).value_lengths().fill_null(0).to_numpy()
            cells = batch.column(2).flatten()
            place, stop = (cells.field(k).to_numpy() for k in range(2))
            owner, start, end = merged(np.repeat(np.arange(batch.num_rows), counts), place, stop)
            gone = np.zeros(len(data) + 1, np.int8)
            # Spans of one document do not touch, but one may end where the next document's first begins.
            np.add.at(gone, offsets[owner] + start, 1)
            np.add.at(gone, offsets[owner] + end, -1)
            stays = np.cumsum(gone[:-1], dtype=np.int8) == 0
            kept = np.concatenate([[0], np.cumsum(stays)])[offsets]
            removed = np.diff(offsets) - np.diff(kept)
            bodies = pa.Array.from_buffers(pa.large_binary(), batch.num_rows, [None, pa.py_buffer(kept.astype(np.int64).tobytes()), pa.py_buffer(data[stays].tobytes())])
            ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=batch.num_rows))])
            pairs = pa.ListArray.from_arrays(pa.array(np.arange(len(owner) + 1) * 2, pa.int32()), pa.array(np.column_stack([start, end]).ravel()))
            out = [batch.column(0), pa.array(np.diff(offsets)), pa.array(removed), pa.array(np.diff(ends)), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs), bodies.cast(pa.binary())]
            yield pa.RecordBatch.from_arrays(out, [doc_id, "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    return joined.mapInArrow(run, schema)

