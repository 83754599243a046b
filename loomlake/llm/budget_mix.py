"""Mixing sources to target weights by hierarchical budgeting.

A tree domain > language > source carries weights; a node's budget in tokens goes down to its children in proportion.
A leaf can give at most its tokens times ``max_epochs``. What a child can't use goes first to its siblings, in
proportion to their weights and as far as they have room; only what a whole subtree can't use goes up to the siblings
of its ancestor. Each leaf's documents are put in an order seeded by leaf and epoch, and the leaf takes the prefix of
that stream, epoch after epoch, that fills its budget.

The prefix sums run in two levels: each leaf is cut by the seeded order into slices of about ``SLICE`` documents, the
slices' sums are added up, then each slice on its own, so a source with a third of all rows is no single task's work.
Only the leaves' sums come to the driver; their number is that of (domain, language, source) and is checked against
``MAX_LEAVES``.

Defined results: null language or source is a leaf of its own, "null"; null or blank text has 0 tokens and is taken
when the stream passes its place; a null doc_id is a value like any other; repeated rows are streamed one by one, and
:func:`mixed` keeps as many of them as were taken; the document at a budget's edge is taken in part, and kept whole by
:func:`mixed`; an empty table gives an empty result; extra columns are ignored by :func:`select` and kept by
:func:`mixed`.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._shared import cut, documents

SEED, SLICE, MAX_LEAVES = 20, 2048, 100_000
#: Production weights; children not named share DEFAULT each.
DOMAIN_WEIGHTS = {"web": 0.6, "books": 0.25, "forum": 0.15}
LANGUAGE_WEIGHTS = {"en": 0.55, "de": 0.15, "fr": 0.15, "es": 0.15}
DEFAULT = 0.1
#: Tokens to take, as a share of all there are.
TAKE = 0.7


@dataclass
class Node:
    """A node of the weight tree; a leaf has a supply of tokens (with all epochs counted)."""

    weight: float = 1.0
    supply: int = 0
    children: dict[str, Node] = field(default_factory=dict)
    budget: int = 0

    def room(self) -> int:
        return self.supply if not self.children else sum(c.room() for c in self.children.values())


def share_out(total: int, weights: list[float], rooms: list[int]) -> list[int]:
    """Whole numbers adding up to min(total, sum of rooms), none over its room, as near to the weights as that allows.

    A full child's surplus goes to the others by weight, again and again; remainders go by largest fraction, then order.
    """
    given, open_ = [0] * len(weights), [i for i, r in enumerate(rooms) if r > 0]
    left = min(total, sum(rooms))
    while left and open_:
        sum_w = sum(weights[i] for i in open_)
        part = {i: left * weights[i] / sum_w if sum_w > 0 else left / len(open_) for i in open_}
        full = [i for i in open_ if part[i] >= rooms[i] - given[i]]
        if full:
            for i in full:
                left -= rooms[i] - given[i]
                given[i] = rooms[i]
            open_ = [i for i in open_ if i not in full]
            continue
        floors = {i: int(part[i]) for i in open_}
        rest = left - sum(floors.values())
        for i in sorted(open_, key=lambda i: (floors[i] - part[i], i))[:rest]:
            floors[i] += 1
        for i in open_:
            given[i] += floors[i]
        return given
    return given


def budget(node: Node, total: int) -> None:
    """Set the budgets of a tree: siblings take up a shortage before anything goes up."""
    node.budget = min(total, node.room())
    names = sorted(node.children)
    parts = share_out(node.budget, [node.children[n].weight for n in names], [node.children[n].room() for n in names])
    for name, part in zip(names, parts, strict=True):
        budget(node.children[name], part)


def domain_of(source: Column) -> Column:
    """The domain a source belongs to: by hash of its name, in the proportions 3 : 1 : 1."""
    return F.element_at(F.array(*map(F.lit, ("web", "web", "web", "books", "forum"))), (F.pmod(F.xxhash64(source), F.lit(5)) + 1).cast("int"))


def n_tokens(text: Column) -> Column:
    """Words between blanks: the measure of supply and budget."""
    return F.when(text.isNull(), F.lit(0)).otherwise(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))).cast("long")


def leaves(counted: DataFrame) -> dict[tuple[str, str, str], tuple[int, int]]:
    """{(domain, lang, source): (documents, tokens)}."""
    rows = counted.groupBy("domain", "lang", "source").agg(F.count(F.lit(1)).alias("n"), F.sum("n_tokens").alias("t")).limit(MAX_LEAVES + 1).collect()
    if len(rows) > MAX_LEAVES:
        raise ValueError(f"over {MAX_LEAVES} leaves; group the sources first")
    return {(r["domain"], r["lang"], r["source"]): (r["n"], r["t"]) for r in rows}


def plan(found: dict[tuple[str, str, str], tuple[int, int]], take: float, max_epochs: int, weights: tuple[dict, dict, dict]) -> dict[tuple[str, str, str], int]:
    """Each leaf's budget in tokens; ``take`` is a share of all tokens."""
    root = Node()
    for path, (_, tokens) in found.items():
        node = root
        for level, name in enumerate(path):
            node = node.children.setdefault(name, Node(weights[level].get(name, DEFAULT)))
        node.supply = tokens * max_epochs
    budget(root, int(take * sum(t for _, t in found.values())))
    return {(d, a, s): leaf.budget for d, x in root.children.items() for a, y in x.children.items() for s, leaf in y.children.items()}


def select(docs: DataFrame, take: float = TAKE, max_epochs: int = 2, seed: int = SEED, weights: tuple[dict, dict, dict] = (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, {})) -> DataFrame:
    """One row for each row of ``docs``: doc_id, domain, lang, source, n_tokens, epochs (how often it is taken whole or
    in part), tokens_taken (of all epochs) and text_key, a hash of the text that tells rows of one id apart."""
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    counted = cut(
        docs.select(F.col("doc_id"), name("lang").alias("lang"), name("source").alias("source"), n_tokens(F.col("text")).alias("n_tokens"), F.xxhash64("text").alias("text_key"))
        .withColumn("domain", domain_of(F.col("source")))
    )
    found = leaves(counted)
    budgets = plan(found, take, max_epochs, weights)
    table = docs.sparkSession.createDataFrame(
        [(*k, n, t, budgets[k]) for k, (n, t) in found.items()], "domain string, lang string, source string, leaf_docs long, leaf_tokens long, budget long"
    )
    leaf = ["domain", "lang", "source"]
    held = counted.join(F.broadcast(table), leaf)  # at most MAX_LEAVES rows
    total = None
    for epoch in range(max_epochs):
        taken = _prefix(held, leaf, epoch, seed)
        total = taken if total is None else total.unionByName(taken)
    key = ["doc_id", "text_key", *leaf, "n_tokens", "nth"]
    if max_epochs > 1:
        total = total.groupBy(*key).agg(F.sum("taken").alias("taken"), F.sum("epochs").alias("epochs"))
    return total.select("doc_id", *leaf, "n_tokens", F.col("epochs").cast("int").alias("epochs"), F.col("taken").alias("tokens_taken"), "text_key")


def _prefix(held: DataFrame, leaf: list[str], epoch: int, seed: int) -> DataFrame:
    """What one epoch takes: documents in seeded order, each with the tokens that the budget still covers."""
    order = F.xxhash64(F.lit(seed), F.lit(epoch), "source", "doc_id", "text_key").bitwiseXOR(F.lit(-(1 << 63)).cast("long"))  # ascends as the unsigned hash
    slices = F.greatest(F.lit(1), F.ceil(F.col("leaf_docs") / SLICE))
    cut_ = held.withColumn("order", order).withColumn("slice", F.floor((F.shiftright("order", 11) / float(1 << 53) + 0.5) * slices))
    sums = cut_.groupBy(*leaf, "slice").agg(F.sum("n_tokens").alias("sum"))
    before = Window.partitionBy(*leaf).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(*leaf, "slice", F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy(*leaf, "slice").orderBy("order", "doc_id", "text_key", "n_tokens")
    ranked = cut_.withColumn("here", F.sum("n_tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("n_tokens"))
    ranked = ranked.withColumn("nth", F.row_number().over(Window.partitionBy(*leaf, "slice", "order", "doc_id", "text_key", "n_tokens").orderBy("here")))
    at = F.col("here") + F.col("start")
    left = F.col("budget") - F.lit(epoch) * F.col("leaf_tokens") - at
    taken = F.least(F.greatest(left, F.lit(0)), F.col("n_tokens"))
    return ranked.join(starts, [*leaf, "slice"]).select(
        "doc_id", "text_key", *leaf, "n_tokens", "nth", taken.cast("long").alias("taken"), F.when(left > 0, F.lit(1)).otherwise(F.lit(0)).alias("epochs")
    )


def mixed(docs: DataFrame, take: float = TAKE, seed: int = SEED, weights: tuple[dict, dict, dict] = (DOMAIN_WEIGHTS, LANGUAGE_WEIGHTS, {})) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that one epoch takes whole or in part.

    Rows alike in id, text and leaf lie side by side in the seeded order, so only those at a leaf's edge are taken some
    and left some: at most one set of copies a leaf, counted instead of numbered.
    """
    key = ["doc_id", "text_key", "lang", "source"]
    told = select(docs, take, 1, seed, weights).groupBy(*key).agg(F.sum("epochs").alias("taken"), F.count(F.lit(1)).alias("copies")).where("taken > 0")
    told = cut(told.select(F.struct(*key).alias("of"), "taken", "copies"))
    name = lambda c: F.coalesce(docs[c].cast("string"), F.lit("null"))
    own = F.struct(docs["doc_id"], F.xxhash64(docs["text"]).alias("text_key"), name("lang").alias("lang"), name("source").alias("source"))
    rows = docs.select(F.struct(*(docs[f"`{c}`"] for c in docs.columns)).alias("row"), own.alias("of"))
    same = [rows["of"][c].eqNullSafe(told["of"][c]) for c in key]
    whole = rows.join(told.where("taken = copies"), same, "left_semi").select("row.*")
    edge = told.where("taken < copies")
    if edge.isEmpty():
        return whole
    alike = rows.join(F.broadcast(edge), same).groupBy(edge["of"], "taken", "row").agg(F.count(F.lit(1)).alias("n"))  # a row a leaf
    before = F.coalesce(F.sum("n").over(Window.partitionBy("of").orderBy("row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    kept = alike.withColumn("kept", F.least("n", F.greatest(F.col("taken") - before, F.lit(0)))).where("kept > 0")
    some = kept.select("row", F.explode(F.sequence(F.lit(1), F.col("kept").cast("int")))).select("row.*")
    return whole.unionByName(some)


def op5_budget_mix(spark, sf_dir: str) -> DataFrame:
    return select(documents(spark, sf_dir)).drop("text_key")
