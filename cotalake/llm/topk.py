"""Exact top-k by inner product: columnar branch-and-bound.

Vectors are quantised to integers and packed into blocks that store each dimension as one column, in the smallest integers that
hold them. A tile of queries adds up its products dimension block by dimension block, the dimensions of most mass first. What the
remaining dimensions can still add is bounded by the product of the remaining norms; candidates whose upper bound is below the k-th
best score so far are dropped and the survivors compacted. A few candidates of each block say after how many dimensions that leaves
so few that finishing them one by one is cheaper than going on with all. All arithmetic that decides is exact.

Queries are held in groups that fit a worker, candidates are dealt into slices, and every group meets every slice in one task that
keeps the group's k best while the blocks of the slice pass. A query is sent once per slice, a candidate once per group, and only k
rows per query and slice leave a task; they are merged by partial top-k.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part, nor do rows with a null id.
Shorter vectors count as filled with zeros. Rows of one id are candidates and queries each, but never of their own id; equal
(query, candidate, score) rows count once, however many there are, before anything is cut to k. Ties go to the smaller id. Scores beyond a long are cut to its range. Empty tables
give an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotalake.llm.common import written

#: Candidates and queries in a block, and values in it (a block of one vector may hold more).
BLOCK, QUERY_BLOCK, BLOCK_VALUES = 8192, 512, 1 << 22
#: Values in a group of queries; blocks of candidates in a slice, at least.
GROUP_VALUES, SLICE = 1 << 23, 4
#: Dimensions added before candidates are looked at again.
DIMENSIONS = 16
#: Queries and candidates whose scores are held at once.
TILE, CHUNK = 512, 2048
#: Candidates of a block that are tried first; the share of pairs up to which survivors are finished one by one.
TRIED, FEW = 128, 1 / 512
#: Range of a long.
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def quantised(vector: Column, scale: int = 256) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * scale))


def _usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & ~bad


def _matrix(lengths: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Rows of numbers as a matrix, shorter rows filled with zeros, in the smallest integers that hold them."""
    low, high = int(values.min(initial=0)), int(values.max(initial=0))
    kind = next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max)
    out = np.zeros((len(lengths), int(lengths.max(initial=0))), kind)
    out[np.arange(out.shape[1]) < lengths[:, None]] = values
    return out


def _top(vectors: np.ndarray) -> float:
    return max(float(vectors.max(initial=0)), -float(vectors.min(initial=0)))


class Group:
    """Queries, and for each the k best distinct (id, score) of other ids among the candidates that have passed."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        # Queries of the same leading dimension stand together, so that a tile's order of dimensions suits them.
        order = np.argsort(np.argmax(np.abs(vectors.astype(np.float32)), axis=1), kind="stable")
        self.ids, self.vectors, self.k = ids[order], vectors[order], k
        n = len(ids)
        self.scores, self.found, self.held = np.full((n, k), _LEAST), np.zeros((n, k), np.int64), np.zeros(n, np.int64)
        self.top, self.norms, self.seen, self.room = _top(vectors), np.zeros(n), 0, None
        for lo in range(0, n, TILE):
            self.norms[lo : lo + TILE] = np.sqrt((self.vectors[lo : lo + TILE].astype(np.float64) ** 2).sum(axis=1))

    def floors(self, rows: slice | np.ndarray) -> np.ndarray:
        """What a score must reach to be among the k best."""
        return np.where(self.held[rows] == self.k, self.scores[rows, -1].astype(np.float64), -np.inf)

    def keep(self, rows: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Takes scored candidates, each for a query given by its row."""
        last, tie = self.scores[rows, -1], self.found[rows, -1]
        good = (self.ids[rows] != ids) & ((self.held[rows] < self.k) | (scores > last) | (scores == last) & (ids < tie))
        rows, ids, scores = rows[good], ids[good], scores[good]
        if not len(rows):
            return
        touched = np.unique(rows)
        old = np.arange(self.k) < self.held[touched, None]
        rows = np.concatenate([rows, np.repeat(touched, self.held[touched])])
        ids = np.concatenate([ids, self.found[touched][old]])
        scores = np.concatenate([scores, self.scores[touched][old]])
        best = np.lexsort((ids, ~scores, rows))  # ~x falls as x grows, for the least long too
        rows, ids, scores = rows[best], ids[best], scores[best]
        new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (ids[1:] != ids[:-1]) | (scores[1:] != scores[:-1])])
        rows, ids, scores = rows[new], ids[new], scores[new]
        place = np.arange(len(rows)) - np.searchsorted(rows, rows)
        first = place < self.k
        rows, place = rows[first], place[first]
        self.found[rows, place], self.scores[rows, place] = ids[first], scores[first]
        self.held[touched] = np.bincount(np.searchsorted(touched, rows), minlength=len(touched))

    def search(self, ids: np.ndarray, columns: np.ndarray) -> None:
        """A block of candidates passes: their ids, and one row of ``columns`` per dimension."""
        # Dimensions that one side lacks add nothing.
        columns = columns[: self.vectors.shape[1]]
        norms = np.zeros(columns.shape[1])
        for column in columns:
            norms += column.astype(np.float64) ** 2
        norms = np.sqrt(norms)
        # Every sum of products, in any order, is an integer that the kind holds exactly.
        reach = min(self.norms.max(initial=0.0) * norms.max(initial=0.0) * (1 + 1e-9), self.top * _top(columns) * len(columns))
        kind = np.float32 if reach < 2.0**23 else np.float64 if reach < 2.0**52 else object
        columns = columns.astype(kind)
        for lo in range(0, len(self.ids), TILE):
            self._tile(slice(lo, min(lo + TILE, len(self.ids))), ids, columns, norms)
        self.seen += len(ids)

    def _tile(self, rows: slice, ids: np.ndarray, columns: np.ndarray, norms: np.ndarray) -> None:
        queries = self.vectors[rows, : len(columns)].astype(columns.dtype)
        lo, order = 0, None
        while lo < len(ids):
            # The first candidates raise what later ones must reach.
            hi = min(lo + min(CHUNK, max(64, 3 * (self.seen + lo))), len(ids))
            alive = slice(lo, hi)
            floors = self.floors(rows)
            lo = hi
            if np.isneginf(floors).any():
                self._end(rows, np.arange(len(queries)).repeat(hi - alive.start), np.tile(np.arange(alive.start, hi), len(queries)), (queries @ columns[:, alive]).ravel(), ids)
                continue
            # No dimension added yet: candidates that reach no query's k-th best with their whole norm.
            with np.errstate(divide="ignore", invalid="ignore"):
                least = np.where(self.norms[rows] > 0, (floors - 2 - np.abs(floors) * 1e-5) / (self.norms[rows] * (1 + 1e-5)), np.where(floors > 2, np.inf, -np.inf)).min()
            if floors.min() > float(_LEAST) and (stay := norms[alive] >= least).mean() < 0.9:
                alive = alive.start + np.flatnonzero(stay)
                if not len(alive):
                    continue
            if order is None:
                order = np.argsort(-(queries.astype(np.float64) ** 2).sum(axis=0), kind="stable")
                rests = _rests(queries.T[order].astype(np.float64))
                depth = self._depth(queries[:, order], columns[:, :: max(1, len(ids) // TRIED)][order], rests, floors)
            places = np.arange(alive.start, alive.stop) if isinstance(alive, slice) else alive
            if depth == len(columns):
                scores, at = self._dense(queries, columns[:, alive], floors[:, None])
                self._end(rows, at // len(places), places[at % len(places)], scores.ravel()[at], ids)
                continue
            some = columns[:, alive][order]
            rest = _rests(some.astype(np.float64))
            scores = queries[:, order[:depth]] @ some[:depth]
            row, column = np.nonzero(_reaches(scores, (rests[depth][:, None], rest[depth]), floors[:, None]))
            score = scores[row, column]
            for d in range(depth, len(columns), DIMENSIONS):
                for x in range(d, min(d + DIMENSIONS, len(columns))):
                    score = score + queries[row, order[x]] * some[x, column]
                end = min(d + DIMENSIONS, len(columns))
                stay = _reaches(score, (rests[end][row], rest[end][column]), floors[row])
                row, column, score = row[stay], column[stay], score[stay]
            self._end(rows, row, places[column], score, ids)

    def _dense(self, queries: np.ndarray, columns: np.ndarray, floors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores over all dimensions, and the flat places of those that reach the floor."""
        if queries.dtype == object:
            scores = queries @ columns
            return scores, np.flatnonzero(_reaches(scores, None, floors))
        # Memory for a tile's scores is taken once, and eight answers are looked at together.
        n = len(queries) * columns.shape[1]
        if self.room is None or self.room[0].dtype != queries.dtype or len(self.room[0]) < n:
            self.room = np.empty(n, queries.dtype), np.zeros(-(-n // 8) * 8, bool)
        shape = len(queries), columns.shape[1]
        scores = np.matmul(queries, columns, out=self.room[0][:n].reshape(shape))
        np.greater_equal(scores, floors.astype(queries.dtype), out=self.room[1][:n].reshape(shape))
        self.room[1][n:] = False
        some = np.flatnonzero(self.room[1].view(np.uint64))
        at = (some[:, None] * 8 + np.arange(8)).ravel()
        return scores, at[self.room[1][at]]

    def _depth(self, queries: np.ndarray, tried: np.ndarray, rests: np.ndarray, floors: np.ndarray) -> int:
        """After how many dimensions few enough of the tried candidates are left; all dimensions if that is never so."""
        rest, score = _rests(tried.astype(np.float64)), 0
        for lo in range(0, len(tried) - DIMENSIONS, DIMENSIONS):
            hi = lo + DIMENSIONS
            score = score + queries[:, lo:hi] @ tried[lo:hi]
            if _reaches(score, (rests[hi][:, None], rest[hi]), floors[:, None]).mean() <= FEW:
                return hi
        return len(tried)

    def _end(self, rows: slice, row: np.ndarray, places: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if scores.dtype == object:
            scores = np.array([max(_LEAST, min(_MOST, int(x))) for x in scores], np.int64)
        self.keep(rows.start + row, ids[places], scores.astype(np.int64))

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, id, score) of what is held."""
        held = np.arange(self.k) < self.held[:, None]
        return np.repeat(self.ids, self.held), self.found[held], self.scores[held]


def _padded(vectors: np.ndarray, size: int) -> np.ndarray:
    return vectors if vectors.shape[1] == size else np.pad(vectors, ((0, 0), (0, size - vectors.shape[1])))


def _groups(blocks: list[tuple[np.ndarray, np.ndarray]], k: int) -> list[Group]:
    """Blocks of queries as one group; as several where filling all up to the longest would take too much."""
    parts: list[list[tuple[np.ndarray, np.ndarray]]] = []
    for block in sorted(blocks, key=lambda b: b[1].shape[1]):
        if not parts or sum(len(i) for i, _ in [*parts[-1], block]) * block[1].shape[1] > 2 * GROUP_VALUES:
            parts.append([])
        parts[-1].append(block)
    return [Group(np.concatenate([i for i, _ in p]), np.concatenate([_padded(v, p[-1][1].shape[1]) for _, v in p]), k) for p in parts]


def _rests(columns: np.ndarray) -> np.ndarray:
    """Row d: the norms of dimensions d and after; the last row is 0."""
    squares = np.zeros((len(columns) + 1, columns.shape[1]))
    squares[:-1] = columns**2
    return np.sqrt(np.cumsum(squares[::-1], axis=0)[::-1])


def _reaches(scores: np.ndarray, rests: tuple[np.ndarray, np.ndarray] | None, floors: np.ndarray) -> np.ndarray:
    """Whether scores can reach the floor with what two norms may still add; a little more than the bound, for rounding."""
    if scores.dtype != object:
        mine, theirs = ((x * (1 + 1e-5)).astype(scores.dtype) for x in rests)
        upper = mine * theirs
        upper += scores
        return upper >= (floors - 2).astype(scores.dtype)
    known = scores.astype(np.float64)
    more = rests[0] * rests[1] * (1 + 1e-9) if rests else 0.0
    # Scores are cut to the range of a long, so that all below it are equal.
    upper = np.maximum(known + more + np.abs(known) * 1e-12 + 2, float(_LEAST))
    return upper >= floors - np.abs(floors) * 1e-12


def _packed(rows: DataFrame, size: int, values: int, label: str) -> DataFrame:
    """Blocks of at most ``size`` rows and ``values`` values: ids, and one column of numbers per dimension."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        count = width = 0
        for batch in batches:
            ids, lists = np.asarray(batch.column(0)), batch.column(1)
            offsets, flat = np.asarray(lists.offsets), np.asarray(lists.values)
            lengths, lo = np.diff(offsets), 0
            while lo < len(ids):
                widths = np.maximum.accumulate(np.maximum(lengths[lo:], width))
                counts = count + np.arange(1, len(widths) + 1)
                full = np.flatnonzero((counts > 1) & ((counts > size) | (counts * widths > values)))
                hi = lo + int(full[0]) if len(full) else len(ids)
                if hi > lo:
                    waiting.append((ids[lo:hi], lengths[lo:hi], flat[offsets[lo] : offsets[hi]]))
                    count, width, lo = count + hi - lo, int(widths[hi - lo - 1]), hi
                if len(full):
                    yield block(waiting, mark)
                    waiting, count, width, mark = [], 0, 0, mark + 1
        if waiting:
            yield block(waiting, mark)

    def block(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]], mark: int) -> pa.RecordBatch:
        ids, lengths, flat = (np.concatenate(x) for x in zip(*parts))
        matrix = _matrix(lengths, flat)
        row = [mark, len(ids), matrix.shape[1], matrix.itemsize, ids.astype("<i8").tobytes(), np.ascontiguousarray(matrix.T).tobytes()]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(row, kinds)], ["mark", "n", "width", "item", "ids", "columns"])

    return written(rows.mapInArrow(pack, "mark long, n int, width int, item int, ids binary, columns binary"), label)


def _numbered(blocks: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """Blocks with their number from 0 and the values before them, how many there are, and their rows."""
    # Only numbers of blocks pass through one task and are broadcast, hundreds of vectors stand behind each.
    order = Window.orderBy("mark")
    before = F.sum(F.col("n").cast("long") * F.col("width")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    numbers = written(blocks.select("mark", (F.row_number().over(order) - 1).alias("block"), F.coalesce(before, F.lit(0)).alias("before"), "n"), label)
    total, rows = numbers.agg(F.count("*"), F.sum("n")).first()
    return blocks.join(F.broadcast(numbers.drop("n")), "mark"), total, rows or 0


def top_k(rows: DataFrame, is_query: Column, k: int = 5, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best other rows."""
    usable = rows.where(F.col(vec_id).isNotNull() & _usable(F.col(vector)))
    # Equal rows are one, so that copies of a row neither fill a block's k places nor cost work.
    ints = [F.col(vec_id).cast("long").alias("id"), quantised(F.col(vector)).alias("v")]
    candidates, blocks, n = _numbered(_packed(usable.select(*ints).distinct(), BLOCK, BLOCK_VALUES, "topk_candidates"), "topk_numbers")
    queries, _, m = _numbered(_packed(usable.where(is_query).select(*ints).distinct(), QUERY_BLOCK, min(BLOCK_VALUES, GROUP_VALUES), "topk_queries"), "topk_query_numbers")
    if not n or not m or k < 1:
        return rows.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    queries = queries.withColumn("group", F.floor(F.col("before") / GROUP_VALUES).cast("int"))
    groups = queries.agg(F.max("group")).first()[0] + 1
    # So many slices that all copies of the queries weigh about as much as the candidates. Each slice finds its k-th best anew,
    # which costs about as much as two more blocks.
    slices = min(-(-blocks // SLICE), max(-(-n // m), groups))
    sent = ["cell", "side", "block", "n", "width", "item", "ids", "columns"]
    asked = queries.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))).withColumn("side", F.lit(0))
    passing = candidates.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("slice", F.col("block") % slices).withColumn("side", F.lit(1))
    cells = asked.unionByName(passing).withColumn("cell", F.col("group") * slices + F.col("slice")).select(*sent)
    cells = cells.repartitionById(groups * slices, "cell").sortWithinPartitions("cell", "side", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, waiting, groups = None, [], []
        for batch in batches:
            for row in range(batch.num_rows):
                cell, side, _, n, width, item = (batch.column(c)[row].as_py() for c in range(6))
                ids = np.frombuffer(batch.column(6)[row].as_buffer(), "<i8")
                columns = np.frombuffer(batch.column(7)[row].as_buffer(), f"<i{item}").reshape(width, n)
                if cell != now:
                    yield from found(groups)
                    now, waiting, groups = cell, [], []
                if side == 0:
                    waiting.append((ids.copy(), columns.T.copy()))
                    continue
                if waiting:
                    groups, waiting = _groups(waiting, k), []
                for group in groups:
                    group.search(ids, columns)
        yield from found(groups)

    def found(groups: list[Group]) -> Iterator[pa.RecordBatch]:
        for group in groups:
            whole = pa.Table.from_arrays([pa.array(c, pa.int64()) for c in group.rows()], ["query_id", "vec_id", "score"])
            yield from whole.to_batches(max_chunksize=65_536)

    best = cells.mapInArrow(run, "query_id long, vec_id long, score long")
    # Equal rows have one rank, and are one row in the end.
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score").distinct()
