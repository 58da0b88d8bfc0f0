"""Mixing sources to target weights: a token budget is handed down a tree of domains,
languages and sources, and each leaf fills its share from seeded epochs.

Every node of the tree gets its siblings' parent budget in proportion to their weights
(equal where none is given) but no more than its leaves can supply in ``max_epochs``
epochs.  What a child cannot use goes to its siblings with room, by their weights,
before any of it leaves the parent: a parent's supply is the sum of its leaves', so a
shortage only rises a level when all siblings are full.

A leaf's documents are ordered anew in each epoch by md5(seed, epoch, doc_id, md5 of the
text) and taken until the leaf's budget is reached: the longest prefix whose tokens
do not exceed it, whole epochs first.  A leaf falls short by less than the tokens of one
document.

Everything is DataFrame expressions.  A leaf may hold a third of all rows, so running
sums are not taken over its rows: rows are summed per leaf and slice of the hash, the
slice in which the budget ends is found among these sums and sliced again (``SLICES``),
and only the last slice's rows are ordered.

Tokens are the runs of characters other than ASCII white space.  Null texts and texts without tokens
have zero tokens and are never chosen; null keys form leaves of their own.  Rows that are
equal in id and text have the same place and are taken one by one; of those among which
the budget ends, as many as fit.  An empty table gives an empty result.  Texts are read
whole, but only their tokens' number and their hash leave the row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written
from ledgerlake.operators.windows import global_position, join_null_safe

#: Hexadecimal digits of the hash that name a slice, level by level: 256 slices of a leaf,
#: then 256 of the one in which its budget ends.
SLICES = (2, 4)
ADDED = ("domain", "tokens", "epoch", "place")


def n_tokens(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[^ \t\n\x0B\f\r]+")).cast("long")


def _weights(given: dict[str, float], key: Column) -> Column:
    """Weight of a node: the given one, else 1.0."""
    if not given:
        return F.lit(1.0)
    table = F.create_map(*[F.lit(x) for pair in given.items() for x in (pair[0], float(pair[1]))])
    return F.coalesce(F.try_element_at(table, F.coalesce(key, F.lit(""))), F.lit(1.0))


def shares(nodes: DataFrame, parent: list[str], node: str, out: str) -> DataFrame:
    """Share of each node in its parent's ``budget`` by ``weight``, capped by ``supply``;
    what is capped goes to the siblings with room.

    With siblings in the order of supply / weight, the level if the first i are full is
    (budget - their supply) / (weight of the rest).  It rises while the next one is full
    too and falls afterwards, so its largest value is the level at which all is given
    out, and every node takes the smaller of its supply and level * weight.  Siblings
    without weight get nothing.
    """
    siblings = Window.partitionBy(*parent)
    order = siblings.orderBy((F.col("supply") / F.col("weight")).asc_nulls_last(), F.col(node).asc_nulls_first())
    full = F.coalesce(F.sum("supply").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rest = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    leveled = nodes.where("weight > 0 AND supply > 0").withColumn("_level", (F.col("budget") - full) / rest)
    return leveled.withColumn("_top", F.max("_level").over(siblings)).select(
        *[c for c in nodes.columns if c not in ("budget", out)], F.least(F.col("supply").cast("double"), F.greatest(F.lit(0.0), F.col("_top") * F.col("weight"))).alias(out))


def leaf_budgets(leaves: DataFrame, budget: float | None, weights: dict[str, dict[str, float]], max_epochs: int) -> DataFrame:
    """Leaves (domain, lang, source, tokens) with ``budget``: tokens to take, whole numbers.
    Without a budget, all tokens of the leaves are the budget."""
    leaf = leaves.withColumn("w3", _weights(weights.get("source", {}), F.col("source"))).withColumn("w2", _weights(weights.get("lang", {}), F.col("lang"))).withColumn("w1", _weights(weights.get("domain", {}), F.col("domain")))
    leaf = leaf.withColumn("supply", F.when((F.col("w1") > 0) & (F.col("w2") > 0) & (F.col("w3") > 0), F.col("tokens") * max_epochs).otherwise(F.lit(0)))
    lang = leaf.groupBy("domain", "lang", "w1", "w2").agg(F.sum("supply").alias("supply"))
    domain = lang.groupBy("domain", "w1").agg(F.sum("supply").alias("supply"))
    whole = float(budget if budget is not None else leaves.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0])  # one number
    top = shares(domain.withColumn("budget", F.lit(whole)).withColumn("weight", F.col("w1")).withColumn("root", F.lit(0)), ["root"], "domain", "share")
    top = top.select(F.col("domain").alias("_d"), F.col("share").alias("budget"))
    mid = shares(lang.join(top, F.col("domain").eqNullSafe(F.col("_d"))).drop("_d").withColumn("weight", F.col("w2")), ["domain"], "lang", "share")
    mid = mid.select(F.col("domain").alias("_d"), F.col("lang").alias("_l"), F.col("share").alias("budget"))
    low = shares(leaf.join(mid, F.col("domain").eqNullSafe(F.col("_d")) & F.col("lang").eqNullSafe(F.col("_l"))).drop("_d", "_l").withColumn("weight", F.col("w3")), ["domain", "lang"], "source", "share")
    return low.select("domain", "lang", "source", "tokens", F.floor(F.col("share") + F.lit(1e-6)).cast("long").alias("budget"))


def _same_leaf(leaves: DataFrame) -> tuple[DataFrame, Column]:
    """Leaves with their keys renamed, and the condition that joins rows to them."""
    named = leaves.withColumnsRenamed({"domain": "_d", "lang": "_l", "source": "_s"})
    return named, F.col("domain").eqNullSafe(F.col("_d")) & F.col("lang").eqNullSafe(F.col("_l")) & F.col("source").eqNullSafe(F.col("_s"))


def place_of(seed: str, epoch: Column, doc_id: Column, text: Column) -> Column:
    """Where an epoch's order puts a document."""
    return F.md5(F.concat_ws(":", F.lit(seed), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit("")), F.md5(F.coalesce(text, F.lit("")))))


def mix(docs: DataFrame, domain: Column, budget: float | None = None, weights: dict[str, dict[str, float]] | None = None,
        max_epochs: int = 4, seed: str = "mix", text: str = "text") -> DataFrame:
    """The chosen rows of ``docs``, once per epoch that takes them, with the columns of
    ADDED; input columns of these names are replaced.  ``domain`` may use any column."""
    kept = [c for c in docs.columns if c not in ADDED]
    rows = docs.withColumn("domain", domain).select(*kept, "domain")
    count = written(rows.select("doc_id", "domain", "lang", "source", F.col(text).alias("text")).select(
        "doc_id", "domain", "lang", "source", n_tokens(F.col("text")).alias("tokens"), F.md5(F.coalesce("text", F.lit(""))).alias("h")).where("tokens > 0"), "mix-rows")
    totals = written(count.groupBy("domain", "lang", "source").agg(F.sum("tokens").alias("tokens")), "mix-totals")
    leaves = written(leaf_budgets(totals, budget, weights or {}, max_epochs).select(
        "domain", "lang", "source", F.floor(F.col("budget") / F.col("tokens")).alias("whole"), F.expr("budget - floor(budget / tokens) * tokens").alias("rest")), "mix-leaves")
    named, same = _same_leaf(leaves)
    place = F.md5(F.concat_ws(":", F.lit(seed), F.col("whole").cast("string"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("h")))
    ordered = count.join(named, same).where("rest > 0").select("domain", "lang", "source", "tokens", "rest", place.alias("place"))
    key = ["domain", "lang", "source"]
    # The slice in which the budget ends, found level by level; ``before``: tokens ahead of it.
    inside, before = ordered, F.lit(0).cast("long")
    for digits in SLICES:
        sums = inside.groupBy(*key, "rest", before.alias("ahead"), F.substring("place", 1, digits).alias("slice")).agg(F.sum("tokens").alias("t"))
        sums = sums.withColumn("upto", F.col("ahead") + F.sum("t").over(Window.partitionBy(*key).orderBy("slice"))).where("upto > rest")
        last = written(sums.groupBy(*key).agg(F.min(F.struct("slice", (F.col("upto") - F.col("t")).alias("before"))).alias("c")).select(*key, "c.slice", "c.before"), "mix-slices")
        named_cut, same_cut = _same_leaf(last)
        inside = ordered.join(named_cut, same_cut & F.col("place").startswith(F.col("slice"))).select(*ordered.columns, "before")
        before = F.col("before")
    # Rows of one place have the same text: they are one row here, with the tokens of each.
    inside = inside.groupBy(*key, "rest", "before", "place", "tokens").agg(F.sum("tokens").alias("t"))
    inside = inside.withColumn("upto", F.col("before") + F.sum("t").over(Window.partitionBy(*key).orderBy("place")))
    over = F.col("upto") > F.col("rest")
    cut = inside.groupBy(*key).agg(
        F.max(F.when(~over, F.col("place"))).alias("cut_place"),
        F.min(F.when(over, F.struct("place", F.floor((F.col("rest") - F.col("upto") + F.col("t")) / F.col("tokens")).alias("copies")))).alias("tie"))
    # Without a row of the slice that fits, the prefix ends where the slice begins.
    ends = last.join(cut.withColumnsRenamed({"domain": "_d", "lang": "_l", "source": "_s"}), same, "left").select(
        *key, F.coalesce("cut_place", "slice").alias("end"), F.when(F.col("tie.copies") > 0, F.col("tie.place")).alias("tie"), F.col("tie.copies").alias("copies"))
    named_end, same_end = _same_leaf(ends)
    plan = written(leaves.join(named_end, same_end, "left").select(*key, "whole", "rest", "end", "tie", "copies"), "mix-plan")
    named_plan, same_plan = _same_leaf(plan)
    full = rows.withColumn("tokens", n_tokens(F.col(text))).where("tokens > 0").join(named_plan, same_plan)
    full = full.withColumn("at", place_of(seed, F.col("whole"), F.col("doc_id"), F.col(text)))

    def taken(some: DataFrame, epochs: Column) -> DataFrame:
        out = some.withColumn("epoch", F.explode(epochs))
        return out.withColumn("place", place_of(seed, F.col("epoch"), F.col("doc_id"), F.col(text))).select(*kept, *ADDED)

    part = (F.col("rest") > 0) & (F.col("at") <= F.coalesce("end", F.lit("g")))
    epochs = F.when(part, F.sequence(F.lit(0), F.col("whole").cast("int"))).when(F.col("whole") > 0, F.sequence(F.lit(0), F.col("whole").cast("int") - 1))
    out = taken(full, epochs)
    if not plan.where("tie IS NOT NULL").isEmpty():
        # Some of the rows of a place: they are numbered, spread over tasks however many there are.
        ties = full.where("at = tie").withColumn("_tie", F.monotonically_increasing_id())
        ties = global_position(ties, [*key, "_tie"], "_pos")
        start = written(ties.groupBy(*key).agg(F.min("_pos").alias("_start")), "mix-ties")
        some = join_null_safe(ties, start, key, "inner").where(F.col("_pos") - F.col("_start") < F.col("copies"))
        out = out.unionByName(taken(some, F.array(F.col("whole").cast("int"))))
    return out
