"""Product codes of vectors: a lexicographic trie over the distinct parts.

Vectors become integers and are cut into equal consecutive parts; each position has a codebook. The parts of a position, sorted,
form a trie with one dimension per level. It is walked depth-first with the vector of squared distances to all entries: what a
common prefix adds is computed once and handed down, and a leaf takes the nearest entry and adds its components, weighted by how
often the part occurs, to that entry's sums. A subtree of few leaves is walked level by level, all its nodes at once.

Training: the distinct parts and their numbers come from one grouped aggregation, dealt by range so that each task has a slice of the
trie; a round sends one row of sums per entry and dimension and task, and entries x dimensions of them to the driver.
Codes are then assigned where the vectors are read, by tries over each batch, without a shuffle.

Defined results: rows whose vector is null or holds a null or non-finite component go. Other vectors count as filled with
zeros up to the longest one's length and on to a multiple of the number of parts. Components beyond a long are cut to its range, and so are errors;
between, all arithmetic is exact. Null ids come last among the first entries, rows of one id in the order of their vectors; repeated rows count
each. Null labels are one label. Fewer rows than entries give fewer entries. An empty table gives an empty result.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cotalake.llm.common import written

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Leaves of a subtree walked at once: its distances stay in a core's cache.
SUBTREE = 256
#: Rows a task sorts into one trie.
ROWS = 1 << 15
#: Components below this leave every distance within a long.
SMALL = 1 << 26
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~bad


def integers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of integers, shorter ones filled with zeros; exact Python integers where a long could overflow."""
    offsets, values = np.asarray(lists.offsets), np.asarray(lists.flatten())
    lengths = np.diff(offsets)
    out = np.zeros((len(lengths), width), np.int64)
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[rows, np.arange(len(values)) - (offsets[:-1] - offsets[0])[rows]] = values
    return out


class Trie:
    """The trie over the rows of a matrix; equal rows share a leaf."""

    def __init__(self, rows: np.ndarray):
        self.order = np.lexsort(rows.T[::-1]) if rows.shape[1] else np.arange(len(rows))
        rows = rows[self.order]
        differs = rows[1:] != rows[:-1]
        # The level at which a row leaves the path of the row before it; the number of levels where they are equal.
        turn = np.where(differs.any(axis=1), differs.argmax(axis=1), rows.shape[1]) if rows.shape[1] else np.zeros(len(rows) - 1, int)
        new = np.concatenate([[True], turn < rows.shape[1]])[: len(rows)]
        self.leaf = np.cumsum(new) - 1
        self.rows, self.turns = rows[new], np.concatenate([[0], turn])[: len(rows)][new]

    def nearest(self, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per given row: its nearest entry (the first of several) and the squared distance."""
        wide = max(int(np.abs(m.astype(float)).max(initial=0)) for m in (self.rows, book)) >= SMALL
        kind = object if wide else np.int64
        rows, book = self.rows.astype(kind), book.astype(kind)
        entry, distance = np.zeros(len(rows), np.int64), np.zeros(len(rows), kind)
        levels = rows.shape[1]
        stack = [(0, len(rows), 0, np.zeros(len(book), kind))] if len(rows) else []
        while stack:
            first, last, level, added = stack.pop()
            if last - first <= SUBTREE or level == levels:
                self._subtree(rows, book, first, last, level, added, entry, distance)
                continue
            cuts = first + np.flatnonzero(self.turns[first + 1 : last] == level) + 1
            bounds = [first, *cuts.tolist(), last]
            start = first
            below: list[tuple[int, int, int, np.ndarray]] = []
            for a, b in zip(bounds, bounds[1:]):
                # Small children in a row go together, from their parent's distances.
                if start < a and b - start > SUBTREE:
                    below.append((start, a, level, added))
                    start = a
                if b - a > SUBTREE:
                    below.append((a, b, level + 1, added + (rows[a, level] - book[:, level]) ** 2))
                    start = b
            if start < last:
                below.append((start, last, level, added))
            stack.extend(reversed(below))
        back = np.empty(len(self.order), np.int64)
        back[self.order] = self.leaf
        return entry[back], distance[back]

    def _subtree(self, rows, book, first, last, level, added, entry, distance) -> None:
        turns = self.turns[first:last].copy()
        turns[0] = 0
        sums, parent = added[None, :], np.zeros(last - first, np.int64)
        for depth in range(level, rows.shape[1]):
            starts = turns <= depth
            nodes = np.flatnonzero(starts)
            step = rows[first + nodes, depth][:, None] - book[:, depth][None, :]
            step *= step
            sums = sums + step if len(sums) in (1, len(nodes)) else sums[parent[nodes]] + step
            parent = np.cumsum(starts) - 1
        best = sums.argmin(axis=1)
        entry[first:last] = best
        distance[first:last] = sums[np.arange(len(best)), best]


def _sums(parts: DataFrame, books: list[np.ndarray], size: int) -> DataFrame:
    """(part, entry, place, total): components of the parts nearest to each entry, added up; place -1 has their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros((len(b), size + 1), object) for b in books]
        for table in _bundles(batches, ROWS):
            where = table.column(0).to_numpy()
            rows, times = matrix(table.column(1).combine_chunks(), size), table.column(2).to_numpy()
            for k in np.unique(where).tolist():
                own, n = rows[where == k], times[where == k]
                entry, _ = Trie(own).nearest(books[k])
                exact = int(np.abs(own.astype(float)).max(initial=0)) * int(n.sum()) < 1 << 62
                kind = np.int64 if exact else object
                more = np.zeros(totals[k].shape, kind)
                np.add.at(more, entry, np.column_stack([n, own.astype(kind) * n.astype(kind)[:, None]]).astype(kind))
                totals[k] += more.astype(object)
        for k, total in enumerate(totals):
            used = np.flatnonzero(total[:, 0] != 0)
            if len(used):
                cells = total[used].ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(cells), k, np.int32)),
                        pa.array(np.repeat(used, size + 1).astype(np.int32)),
                        pa.array(np.tile(np.arange(-1, size, dtype=np.int32), len(used))),
                        pa.array([str(x) for x in cells]),
                    ],
                    ["part", "entry", "place", "total"],
                )

    found = parts.select("part", "cells", "times").mapInArrow(run, "part int, entry int, place int, total string")
    return found.groupBy("part", "entry", "place").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def _bundles(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    waiting: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        waiting.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(waiting)
            waiting, size = [], 0
    if size:
        yield pa.Table.from_batches(waiting)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Codebooks, one per part position; ``vectors`` has the columns id and cells (integers)."""
    longest = vectors.agg(F.max(F.size("cells"))).first()[0]
    size = -(-(longest or 0) // parts)
    head = vectors.orderBy(F.col("id").asc_nulls_last(), "cells").limit(entries).select("cells").toArrow()
    first = matrix(head.column(0).combine_chunks() if head.num_rows else pa.array([], pa.list_(pa.int64())), size * parts)
    books = [first[:, k * size : (k + 1) * size] for k in range(parts)]
    if not size or not len(first):
        return books
    filled = F.concat("cells", F.array_repeat(F.lit(0).cast("long"), F.lit(size * parts) - F.size("cells")))
    cut = F.array(*[F.struct(F.lit(k).alias("part"), F.slice(F.col("filled"), k * size + 1, size).alias("cells")) for k in range(parts)])
    each = vectors.select(filled.alias("filled")).select(F.explode(cut).alias("p")).select("p.part", "p.cells")
    distinct = each.groupBy("part", "cells").agg(F.count(F.lit(1)).alias("times"))
    sorted_parts = written(distinct.repartitionByRange("part", "cells").sortWithinPartitions("part", "cells"), "codes_parts")
    for _ in range(rounds):
        found = _sums(sorted_parts, books, size).collect()
        totals = {(r["part"], r["entry"], r["place"]): int(r["total"]) for r in found}
        wider = [b.astype(object) for b in books]
        for (k, entry, place), total in totals.items():
            if place >= 0:
                wider[k][entry, place] = total // totals[k, entry, -1]
        books = [b.astype(np.int64) for b in wider]
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """The rows of ``vectors`` (columns cells and others) with code and error in place of cells."""
    size = books[0].shape[1]
    others = [c for c in vectors.columns if c != "cells"]
    schema = vectors.select(*others).schema.add("code", "string").add("error", "long")
    digits = np.array([f"{k:02x}" for k in range(max(len(books[0]), 1))], object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _bundles(batches, ROWS):
            table = table.combine_chunks()
            rows = matrix(table.column("cells").combine_chunks(), size * len(books))
            code, error = np.full(len(rows), "", object), np.zeros(len(rows), object)
            for k, book in enumerate(books):
                entry, distance = Trie(rows[:, k * size : (k + 1) * size]).nearest(book)
                code, error = code + digits[entry], error + distance
            out = table.drop_columns(["cells"])
            out = out.append_column("code", pa.array(code, pa.string()))
            yield from out.append_column("error", pa.array([min(int(x), _MOST) for x in error], pa.int64())).to_batches()

    return vectors.select(*others, "cells").mapInArrow(run, schema)


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """Per usable row: vec_id, label, code, error, label_error (over all rows of the label), codebooks_sha256."""
    kept = rows.where(usable(F.col(vector)))
    vectors = kept.select(F.col(vec_id).alias("id"), F.col(label).alias("label"), integers(F.col(vector)).alias("cells"))
    books = train(vectors, parts, entries, rounds)
    coded = written(encode(vectors, books), "codes")
    most = F.lit(_MOST).cast("decimal(38,0)")
    total = F.least(F.sum(F.col("error").cast("decimal(38,0)")), most).cast("long")
    totals = coded.groupBy("label").agg(total.alias("label_error")).withColumnRenamed("label", "of")
    out = coded.join(totals, F.col("label").eqNullSafe(F.col("of")))
    return out.select(F.col("id").alias(vec_id), "label", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))
