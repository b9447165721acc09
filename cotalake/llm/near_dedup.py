"""Near-duplicate detection by b-bit MinHash.

Every document's distinct word shingles give ``HASHES`` minima. Bands of ``ROWS`` minima put documents into buckets; of every
minimum only its low ``BITS`` bits are kept, packed into words, and bit counts of two documents' words estimate their
similarity, corrected for chance agreement. Candidates whose estimate is far below the threshold are left out (six standard
errors); the others are confirmed on their full shingle sets, and links are joined into components.

Equal sets are one node from the start. Within a bucket, all nodes are first compared with one pivot, so a large group of copies
costs one comparison per member. Buckets that still hold several components are finished exactly: small ones by comparing nodes
of different components; the nodes of larger ones by prefix filtering: two sets as similar as asked share one of their rarest
shingles, so only nodes with a rare shingle in common are compared. No bucket is capped and no pair of a bucket is left open.

Defined results: null and empty texts, and texts of white space, have no shingles, are linked with nothing and are kept. Rows of
one id are one document, linked by the set of each of its rows. A row with null id takes no part: no component, kept. Empty tables give an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotalake.llm import text as T
from cotalake.llm.common import written

HASHES, ROWS = 128, 4
BANDS = HASHES // ROWS
BITS = 2
PACKED = HASHES * BITS // 64
#: Candidates below this estimate are left out: 0.8 less six standard errors of the estimate.
LEAST_ESTIMATE = 0.55
#: In buckets of at most so many nodes, those of different components are compared directly.
SMALL = 12
SEED = 6

_random = np.random.default_rng(SEED)
_TIMES = _random.integers(1, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
_PLUS = _random.integers(0, 1 << 63, HASHES, np.uint64)


def _minima(sets: list[np.ndarray]) -> np.ndarray:
    """The minimum of each hash function over each set (none empty)."""
    joined = np.concatenate(sets)
    sizes = np.array([len(s) for s in sets])
    starts = np.cumsum(sizes) - sizes
    out = np.empty((len(sets), HASHES), np.uint64)
    buffer = np.empty_like(joined)
    for k in range(HASHES):
        np.multiply(joined, _TIMES[k], out=buffer)
        buffer += _PLUS[k]
        out[:, k] = np.minimum.reduceat(buffer, starts)
    return out


def signatures(docs: DataFrame, width: int, text: str = "text") -> DataFrame:
    """doc_id, n_shingles, two sums that tell sets apart, packed low bits, and one key per band."""
    packed = [f"s{i}" for i in range(PACKED)]
    schema = "doc_id long, n long, f1 long, f2 long, " + ", ".join(f"{p} long" for p in packed) + ", bands array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).cast(pa.int64())
            for first, counts, hashes in T.words(batch.column(1), T.VISIBLE):
                sets = T.shingles(hashes, counts, width)
                n, f1, f2 = _sums(sets)
                used = np.flatnonzero(n)
                bits = np.zeros((len(n), PACKED), np.uint64)
                bands = np.zeros((len(n), BANDS), np.uint64)
                if len(used):
                    some = [sets[i] for i in used]
                    minima = _minima(some)
                    low = (minima >> np.uint64(20)) & np.uint64((1 << BITS) - 1)
                    shifts = np.arange(HASHES // PACKED, dtype=np.uint64) * np.uint64(BITS)
                    bits[used] = np.bitwise_or.reduce(low.reshape(len(used), PACKED, -1) << shifts, axis=2)
                    keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (len(used), BANDS)).copy()
                    for r in range(ROWS):
                        keys = T.mix(keys * np.uint64(0x9E3779B97F4A7C15) + minima[:, r::ROWS][:, :BANDS])
                    bands[used] = keys
                lists = pa.ListArray.from_arrays((np.concatenate([[0], np.cumsum(np.where(n > 0, BANDS, 0))])).astype(np.int32), pa.array(bands[used].ravel().view(np.int64)))
                columns = [ids.slice(first, len(n)), pa.array(n), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64))]
                columns += [pa.array(np.ascontiguousarray(bits[:, i]).view(np.int64)) for i in range(PACKED)]
                yield pa.RecordBatch.from_arrays([*columns, lists], ["doc_id", "n", "f1", "f2", *packed, "bands"])

    return docs.select("doc_id", text).mapInArrow(sign, schema)


def _sums(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Size and two sums of each set: what tells sets apart."""
    n = np.array([len(s) for s in sets], np.int64)
    f1, f2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    for k in np.flatnonzero(n):
        f1[k], f2[k] = sets[k].sum(dtype=np.uint64), T.mix(sets[k].copy()).sum(dtype=np.uint64)
    return n, f1, f2


def _sets(docs: DataFrame, width: int, text: str) -> DataFrame:
    """(node, items) of texts that come with a node and its sums (node, n, f1, f2); a text with other sums is not the node's."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, *wanted = (batch.column(k).to_numpy() for k in range(1, 5))
            for first, counts, hashes in T.words(batch.column(0), T.VISIBLE):
                sets = T.shingles(hashes, counts, width)
                rows = slice(first, first + len(sets))
                n, f1, f2 = _sums(sets)
                own = np.flatnonzero((n == wanted[0][rows]) & (f1.view(np.int64) == wanted[1][rows]) & (f2.view(np.int64) == wanted[2][rows]))
                ends = np.concatenate([[0], np.cumsum(n[own])]).astype(np.int32)
                joined = np.concatenate([sets[k] for k in own]).view(np.int64) if len(own) else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(node[rows][own]), pa.ListArray.from_arrays(ends, pa.array(joined))], ["node", "items"])

    return docs.select(text, "node", "n", "f1", "f2").mapInArrow(cut, "node long, items array<long>")


def estimate(a: str, b: str) -> Column:
    """Similarity from the packed bits of two signatures, corrected for minima that agree in their low bits by chance."""
    differ = F.lit(0)
    for i in range(PACKED):
        x = F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(x)
    chance = 1.0 / (1 << BITS)
    return ((1.0 - differ / float(HASHES)) - chance) / (1.0 - chance)


def _alike(a: str, b: str, percent: int) -> Column:
    """Whether sets of these sizes can be as similar as asked."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _open_pair(together: Column, percent: int) -> Column:
    """A join condition: nodes x and y belong to different components and may be a link; only such pairs leave the join."""
    apart = (F.col("x.node") < F.col("y.node")) & (F.col("x.component") != F.col("y.component"))
    return together & apart & _alike("x.n", "y.n", percent) & (estimate("x.bits", "y.bits") >= LEAST_ESTIMATE)


def _rare_shingles(many: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rarest shingles of each node and their places, so many that two sets as similar as asked must share one of them.

    Rarity is counted among these nodes. Shingles that only one node holds come first and pair with nothing. If the first shingle
    that two nodes share stands at places i and j, they share no more than what follows it on either side; the join that uses
    these rows asks for that as well.
    """
    cells = sets.join(many.select("node"), "node", "left_semi").select("node", F.explode("items").alias("item"))
    often = cells.groupBy("item").agg(F.count(F.lit(1)).alias("often")).where("often > 1")
    order = Window.partitionBy("node").orderBy("often", "item")
    held = cells.join(often, "item").withColumns({"place": F.row_number().over(order), "held": F.count(F.lit(1)).over(Window.partitionBy("node"))})
    held = held.join(many, "node").withColumn("place", F.col("n") - F.col("held") + F.col("place"))
    places = F.col("n") - F.floor(F.col("n") * percent / 100) + 1
    return written(held.where(F.col("place") <= places).select("item", "place", "node", "component", "n", "bits"), "near_rare")


def components(links: DataFrame, label: str = "components") -> DataFrame:
    """(node, component) of all nodes of the links (a, b): the smallest node reachable.

    Every round takes the smallest label among the neighbours, then the label of that label; both are joins and partial
    minima, so no node's neighbours meet in one task.
    """
    links = written(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), label)
    state = written(links.groupBy(F.col("a").alias("node")).agg(F.least(F.col("a"), F.min("b")).alias("component")), label)
    while True:
        near = links.join(state.withColumnsRenamed({"node": "b", "component": "seen"}), "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        moved = state.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "seen").alias("component"))
        jump = state.select(F.col("node").alias("component"), F.col("component").alias("further"))
        following = moved.join(jump, "component").select("node", F.least("component", "further").alias("component"), "was")
        following = written(following, label)
        changed = following.where("component < was").limit(1).count()
        state = following.drop("was")
        if not changed:
            return state


def near_duplicates(docs: DataFrame, width: int, text: str = "text", percent: int = 80) -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, kept.

    Two documents are linked if the shared shingles make up ``percent`` of all theirs.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias(text))
    signed = written(signatures(rows, width, text), "near_signatures")
    packed = [f"s{i}" for i in range(PACKED)]
    usable = signed.where("n > 0 and doc_id is not null")
    # Equal sets are one node, numbered once and for all when written; its first document stands for it.
    classes = usable.groupBy("n", "f1", "f2").agg(F.min("doc_id").alias("first"))
    nodes = written(classes.withColumn("node", F.monotonically_increasing_id()), "near_classes")
    signature = usable.join(nodes, ["n", "f1", "f2"]).where("doc_id = first")
    signature = written(signature.groupBy("node", "n", "f1", "f2").agg(*[F.min(p).alias(p) for p in packed], F.min("bands").alias("bands")), "near_nodes")
    cells = signature.select("node", F.explode("bands").alias("bucket"))
    buckets = cells.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(cells.join(buckets, "bucket"), "near_members")
    # The pivot is the member with most company in all its buckets: the text that the others are copies of, if there is one.
    company = members.groupBy("node").agg(F.sum("size").alias("company"))
    pivots = members.join(company, "node").groupBy("bucket").agg(F.max(F.struct("company", "node"))["node"].alias("pivot"))
    members = written(members.join(pivots, "bucket"), "near_members")

    same_id = usable.join(nodes, ["n", "f1", "f2"]).select("node", "doc_id").distinct()
    several = same_id.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    by_id = same_id.join(several.select("doc_id", "a"), "doc_id").where("node <> a").select("a", F.col("node").alias("b"))

    repeated = bool(usable.groupBy("doc_id").agg(F.count(F.lit(1)).alias("k")).where("k > 1").limit(1).count())

    # The shingles of all nodes that share a bucket, read again from their texts; the only time that texts are shuffled.
    wanted = written(members.select("node").distinct().join(nodes, "node").withColumnRenamed("first", "doc_id"), "near_wanted")
    sets = _sets(rows.join(wanted.hint("merge"), "doc_id"), width, text)
    if repeated:
        sets = sets.dropDuplicates(["node"])
    sets = written(sets, "near_sets")

    def confirmed(pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) of nodes that are links."""
        bits = signature.select("node", "n", F.struct(*packed).alias("bits"))
        pairs = pairs.distinct().join(bits.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("bits").alias("x")), "a")
        pairs = pairs.join(bits.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("bits").alias("y")), "b")
        pairs = written(pairs.where(_alike("na", "nb", percent) & (estimate("x", "y") >= LEAST_ESTIMATE)).select("a", "b", "na", "nb"), "near_pairs")
        both = pairs.join(sets.select(F.col("node").alias("a"), F.col("items").alias("left")), "a")
        both = both.join(sets.select(F.col("node").alias("b"), F.col("items").alias("right")), "b")
        shared = F.size(F.array_intersect("left", "right"))
        return written(both.where(shared * 100 >= (F.col("na") + F.col("nb") - shared) * percent).select("a", "b"), "near_links")

    links = confirmed(members.where("node <> pivot").select(F.least("pivot", "node").alias("a"), F.greatest("pivot", "node").alias("b")))
    if repeated:
        links = written(links.unionByName(by_id), "near_links")
    joined = components(links)

    now = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = now.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("bucket")
    now = written(now.join(mixed, "bucket").join(signature.select("node", "n", F.struct(*packed).alias("bits")), "node"), "near_open")
    if now.limit(1).count():
        few = now.where(F.col("size") <= SMALL).select("bucket", "node", "component", "n", "bits")
        small = few.alias("x").join(few.alias("y"), _open_pair(F.col("x.bucket") == F.col("y.bucket"), percent))
        many = now.where(F.col("size") > SMALL).groupBy("node").agg(F.first("component").alias("component"), F.first("n").alias("n"), F.first("bits").alias("bits"))
        rare = _rare_shingles(written(many, "near_many"), sets, percent)
        within = F.least(F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) + 1
        enough = within * 100 >= (F.col("x.n") + F.col("y.n") - within) * percent
        large = rare.alias("x").join(rare.alias("y"), _open_pair(F.col("x.item") == F.col("y.item"), percent) & enough)
        more = [p.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")) for p in (small, large)]
        links = written(links.unionByName(confirmed(more[0].unionByName(more[1]))), "near_links")
        joined = components(links)

    # A component is named after the first of all its documents.
    named = joined.join(nodes.select("node", "first"), "node").groupBy("component").agg(F.min("first").alias("name"))
    named = joined.join(named, "component").select("node", "name")
    belongs = nodes.join(named, "node", "left").select("n", "f1", "f2", F.coalesce("name", "first").alias("component"))
    out = signed.select("doc_id", "n", "f1", "f2").join(belongs, ["n", "f1", "f2"], "left")
    own = F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, width: int = 5) -> DataFrame:
    """Documents that stand for their group, with all their columns."""
    gone = written(near_duplicates(docs, width).where("not kept").select(F.col("doc_id").alias("__llm_gone")).distinct(), "near_gone")
    return docs.join(gone, F.col("doc_id") == F.col("__llm_gone"), "left_anti").select(*docs.columns)
