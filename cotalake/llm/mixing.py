"""Mixing sources to target weights by hierarchical budgeting, in DataFrame operations only.

Documents form a tree domain - language - source. A token budget goes down the tree: children share their parent's budget by
weight; a child that cannot use its share (all its documents, ``max_epochs`` times over) takes what it can, and the shortage
goes to its siblings by weight. As a subtree never gets more than it can use, a shortage leaves it only when all its leaves
are full: siblings come before ancestors. Each leaf then takes whole epochs of its documents, and of the last epoch the first
tokens in an order seeded by epoch; the document at the cut gives its leading tokens only.

Defined results: null domain, language and source count as empty names; documents without words, null texts included, take
no part; repeated rows each count; rows of one id, or without one, are ordered by a hash of their text, and equal rows are as one with a number of
copies; an empty table, a budget of 0 or weights of 0 give no rows. Shares are rounded down, so fewer tokens than a parent has children stay unused.
Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cotalake.llm.common import written

LEVELS = ("domain", "lang", "source")
#: The order of a leaf's documents is a text: 32 digits of the seeded key of the id, 16 of the text's hash. A leaf's cut is narrowed down by
#: prefixes of these lengths: 4,096 ranges, as many within the range at the cut, and the ids there with 4,096 ranges of their texts.
PREFIXES = (3, 6, 35)
#: Words as the mixture counts them.
WORDS = r"[^\x20\x09-\x0D]+"
_WIDE = "decimal(38,0)"


def _weight(column: Column, weights: Mapping[str, int]) -> Column:
    if not weights:
        return F.lit(1)
    known = F.create_map(*[x for k, v in weights.items() for x in (F.lit(k), F.lit(int(v)))])
    return F.coalesce(F.element_at(known, column), F.lit(1))


def allocate(leaves: DataFrame, budget: Column, weights: Mapping[str, Mapping[str, int]]) -> DataFrame:
    """``leaves`` (one row per domain, lang, source with ``capacity``) plus ``allocation``, whole tokens.

    One row per name and level takes part in the windows, not one per document. Shares are exact integer fractions.
    """
    nodes = leaves
    parents: list[str] = []
    for depth, level in enumerate(LEVELS):
        path = list(LEVELS[: depth + 1])
        weight = _weight(F.col(level), weights.get(level, {})).cast(_WIDE)
        children = nodes.groupBy(*path).agg(F.sum("capacity").cast(_WIDE).alias("cap")).withColumn("w", weight).where("w > 0")
        if parents:
            children = children.join(shares, parents)  # noqa: F821  the level above
        else:
            children = children.withColumn("budget", budget.cast(_WIDE))
        # By how soon a child is full: those before it have taken all they can. Sums before a child come from one window.
        nothing = F.lit(0).cast(_WIDE)
        group = Window.partitionBy(*parents)
        before = group.orderBy((F.col("cap") / F.col("w")).cast("double"), level).rowsBetween(Window.unboundedPreceding, -1)
        children = children.withColumns({
            "left": F.greatest(F.col("budget") - F.coalesce(F.sum("cap").over(before).cast(_WIDE), nothing), nothing),
            "passed": F.coalesce(F.sum("w").over(before).cast(_WIDE), nothing),
            "all": F.sum("w").over(group).cast(_WIDE),
        })
        full = (F.col("cap") * (F.col("all") - F.col("passed"))).cast(_WIDE) <= (F.col("left") * F.col("w")).cast(_WIDE)
        children = children.withColumn("full", full)
        children = children.withColumns({
            "rest": F.greatest(F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(group).cast(_WIDE), nothing), nothing).cast(_WIDE),
            "open": F.sum(F.when(~F.col("full"), F.col("w"))).over(group).cast(_WIDE),
        })
        share = F.when(F.col("full"), F.col("cap").cast("long")).otherwise(F.expr("(rest * w) div open"))
        shares = written(children.select(*path, share.cast(_WIDE).alias("budget")), "mix_shares")
        parents = path
    return leaves.join(shares.withColumnRenamed("budget", "allocation"), list(LEVELS)).withColumn("allocation", F.col("allocation").cast("long"))


def _rows(docs: DataFrame, domain: Column, *more: Column) -> DataFrame:
    name = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return docs.select(
        F.col("doc_id"),
        name(domain).alias("domain"),
        name(F.col("lang")).alias("lang"),
        name(F.col("source")).alias("source"),
        F.regexp_count(F.col("text"), F.lit(WORDS)).cast("long").alias("n_tokens"),
        F.lpad(F.lower(F.hex(F.xxhash64("text"))), 16, "0").alias("text_hash"),
        *more,
    ).where("n_tokens > 0")


def _ordered(rows: DataFrame, plan: DataFrame, seed: str) -> DataFrame:
    """Rows of leaves that give tokens, with the plan of their leaf and, where it has a last, partial epoch, their place in it."""
    key = F.md5(F.concat_ws("|", F.lit(seed), F.col("whole") + 1, F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    return rows.join(plan, list(LEVELS)).withColumn("place", F.when(F.col("part") > 0, F.concat(key, "text_hash"))).drop("text_hash")


def _cuts(rows: DataFrame) -> DataFrame:
    """Per leaf with a partial epoch: the prefix of the places at which its tokens end, and the tokens before that prefix."""
    cut = None
    for length in PREFIXES:
        some = rows.where("part > 0").withColumn("prefix", F.substring("place", 1, length))
        if cut is not None:
            narrowed = cut.select(*LEVELS, F.col("prefix").alias("within"), F.col("before").alias("begin"))
            some = some.join(narrowed, list(LEVELS)).where(F.startswith("place", "within"))
        else:
            some = some.withColumn("begin", F.lit(0).cast("long"))
        sums = some.groupBy(*LEVELS, "prefix").agg(F.sum("n_tokens").alias("here"), F.first("part").alias("limit"), F.first("begin").alias("begin"))
        running = Window.partitionBy(*LEVELS).orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
        before = F.col("begin") + F.coalesce(F.sum("here").over(running), F.lit(0))
        sums = sums.withColumn("before", before).where((F.col("before") <= F.col("limit")) & (F.col("limit") < F.col("before") + F.col("here")))
        cut = written(sums.select(*LEVELS, "prefix", "before"), "mix_cuts")
    return cut


def mix(
    docs: DataFrame,
    domain: Column,
    budget_share: tuple[int, int] = (1, 2),
    weights: Mapping[str, Mapping[str, int]] | None = None,
    max_epochs: int = 2,
    seed: str = "mix",
    with_text: bool = False,
) -> DataFrame:
    """Rows (doc_id, domain, lang, source, n_tokens, epoch, taken): tokens taken from a document in an epoch.

    The budget is the given fraction of all tokens of one epoch. What a leaf takes of its last epoch is a threshold in the order of its documents; it is
    found by sums over ranges, and only documents in the last range are sorted. ``with_text`` adds the tokens taken: the text, or of
    the document at the cut its first words, joined by blanks; texts are then read once more, and no text is shuffled but those at a cut.
    """
    counted = written(_rows(docs, domain), "mix_tokens")
    leaves = counted.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("once")).withColumn("capacity", F.col("once") * F.lit(max_epochs))
    leaves = written(leaves, "mix_leaves")
    total = leaves.agg(F.coalesce(F.sum("once"), F.lit(0))).first()[0]
    budget = total * budget_share[0] // budget_share[1]
    plan = allocate(leaves, F.lit(budget), weights or {})
    plan = plan.select(*LEVELS, F.expr("allocation div once").alias("whole"), F.expr("allocation % once").alias("part"))
    plan = written(plan.where("whole > 0 or part > 0"), "mix_plan")
    cuts = _cuts(_ordered(counted, plan, seed))
    plan = written(plan.join(cuts, list(LEVELS), "left"), "mix_thresholds")

    text = [F.col("text")] if with_text else []
    rows = _ordered(_rows(docs, domain, *text) if with_text else counted, plan, seed)
    at_cut = F.substring("place", 1, PREFIXES[-1])
    # Epochs taken whole, and the last one where the document stands before the cut.
    none = F.array().cast("array<bigint>")
    last = F.when(at_cut < F.col("prefix"), F.array(F.col("whole") + 1)).otherwise(none)
    epochs = F.concat(F.when(F.col("whole") > 0, F.sequence(F.lit(1).cast("long"), F.col("whole"))).otherwise(none), last)
    out = ["doc_id", *LEVELS, "n_tokens", "epoch", "taken", *(["text"] if with_text else [])]
    taken = rows.withColumn("epoch", F.explode(epochs)).withColumn("taken", F.col("n_tokens")).select(*out)
    # The documents at the cut, equal ones as one, are sorted.
    equal = [*LEVELS, "doc_id", "n_tokens", "place", "whole", "part", "before"]
    same = [F.max("text").alias("text")] if with_text else []
    cut = rows.where(at_cut == F.col("prefix")).groupBy(*equal).agg(F.count(F.lit(1)).alias("copies"), *same)
    within = Window.partitionBy(*LEVELS).orderBy("place", "n_tokens").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("before") + F.coalesce(F.sum(F.col("n_tokens") * F.col("copies")).over(within), F.lit(0))
    cut = cut.withColumn("left", F.col("part") - start).where("left > 0")
    used = F.least(F.col("copies"), F.expr("(left + n_tokens - 1) div n_tokens"))
    cut = cut.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), used)))
    cut = cut.withColumns({"epoch": F.col("whole") + 1, "taken": F.least(F.col("n_tokens"), F.col("left") - (F.col("copy") - 1) * F.col("n_tokens"))})
    if with_text:
        words = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORDS), F.lit(0)), 1, F.col("taken").cast("int")), " ")
        cut = cut.withColumn("text", F.when(F.col("taken") < F.col("n_tokens"), words).otherwise(F.col("text")))
    return taken.unionByName(cut.select(*out))


WEIGHTS = {"domain": {"d0": 4, "d1": 3, "d2": 2, "d3": 1}, "lang": {"en": 4, "de": 2, "fr": 2, "es": 2}}


def domain_of(source: Column) -> Column:
    """Sources are dealt to four domains by the last digits of their name; others have no domain."""
    return F.concat(F.lit("d"), (F.regexp_extract(source, r"([0-9]{1,9})$", 1).try_cast("long") % 4).cast("string"))


def mix_documents(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """The mixture with production weights: half of the corpus's tokens, no document more than twice."""
    return mix(docs, domain_of(F.col("source")), weights=WEIGHTS, with_text=with_text)
