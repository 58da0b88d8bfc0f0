"""Merkle manifest of a dataset by a butterfly exchange.

Every row is a leaf.  The leaves of a source stand in the order of doc_id; runs of
``FANOUT`` nodes are hashed into their parent until one node, the source's subroot, is
left.  The subroots in the order of the sources give the root in the same way.

A *block* is an aligned stretch of FANOUT ** 6 leaves (a parameter) of a source, the partition
of the exchange.  A block hashes its own levels by itself.  Then, round by round, aligned
groups of FANOUT blocks swap the roots of the subtrees they stand for: in round r block i
meets those that differ from it in the r-th digit of i to base FANOUT.  All members hash
the same parent, so every block knows the root of its ever larger subtree and the
siblings met on the way; no pass leads back down.  The blocks of a source are filled up
with empty ones to a power of FANOUT, so that every group is whole and has FANOUT rows.
Above the subroots the groups are FANOUT neighbouring subtrees of sources: these swap one
row for each subtree, which Spark joins to all blocks of the group (and may split).

Defined results: null ids come first, rows that share an id stand in the order of their
leaf digests, rows equal in all five columns are separate leaves (each is given its own
place).  A null source is a source, before all others.  A null or empty text is a leaf like any
other; a text of any length is hashed by the JVM where it is read and never shuffled.
Extra columns of the input, whatever their names, are neither hashed nor returned.  An
empty table gives an empty manifest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm.tables import written
from ledgerlake.operators.windows import global_position, join_null_safe

#: Fixed value: children of a node.
FANOUT = 3
#: Levels that a block hashes by itself: 729 leaves.
BLOCK_LEVELS = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def leaf_digest(fields: dict[str, Column]) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its text, or a dash."""
    parts = []
    for name in FIELDS:
        value = fields[name].cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.sha2(F.concat(*parts), 256)


def _digest(nodes: list[str]) -> str:
    return hashlib.sha256("".join(nodes).encode()).hexdigest()


def levels_of(leaves: list[str], fixed: int | None = None) -> list[list[str]]:
    """Nodes of all levels of a tree, leaves first: ``fixed`` levels above them, or as
    many as it takes until one node is left."""
    out = [leaves]
    while (len(out[-1]) > 1) if fixed is None else (len(out) <= fixed):
        below = out[-1]
        out.append([_digest(below[i:i + FANOUT]) for i in range(0, len(below), FANOUT)])
    return out


def _siblings(level: list[str], i: int) -> tuple[str, str]:
    """The other nodes of a node's run: those to its left and those to its right."""
    start = i - i % FANOUT
    return "".join(level[start:i]), "".join(level[i + 1:start + FANOUT])


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Row by row: a row is a whole block, a batch of them may be large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _add_roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        roots = [levels_of([x["leaf"] for x in r["leaves"]], r["depth"])[-1][0] for r in _rows(batch)]
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(roots, pa.string())], [*batch.schema.names, "node"])


def _prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per leaf: its whole proof and the root folded from it or its tampered form."""
    names = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    for batch in batches:
        for r in _rows(batch):
            levels = levels_of([x["leaf"] for x in r["leaves"]], r["depth"])
            upper = [(u["left"], u["right"]) for u in r["upper"]]
            above = "".join(a + b for a, b in upper)
            rows = []
            for i, x in enumerate(r["leaves"]):
                path = []
                for level in levels[:-1]:
                    path.append(_siblings(level, i))
                    i //= FANOUT
                proof = hashlib.sha256(("".join(a + b for a, b in path) + above).encode()).hexdigest()
                node = x["tampered"]
                for a, b in path + upper:
                    node = _digest([a, node, b])
                rows.append((x["doc_id"], x["leaf"], r["subroot"], r["node"], proof, node, node == r["node"]))
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if n == "doc_id" else pa.bool_() if n == "verified" else pa.string()) for n, c in zip(names, zip(*rows))], names)


def _width(blocks: Column) -> Column:
    """The least power of FANOUT that is no smaller."""
    steps = F.sequence(F.lit(1), F.lit(40))
    return F.aggregate(steps, F.lit(1).cast("long"), lambda width, _: F.when(width < blocks, width * FANOUT).otherwise(width))


def _rounds(nodes: int) -> int:
    count, width = 0, 1
    while width < nodes:
        count, width = count + 1, width * FANOUT
    return count


def _meet(rows: DataFrame, active: Column, others: list[tuple[Column, Column]]) -> DataFrame:
    """After a swap: the parent and the siblings on either side.  ``others`` are the
    FANOUT roots of the group, left to right (null for an empty subtree), each with the
    condition that it stands left of the row's own; its own is neither left nor right."""
    parent = F.concat(*[F.coalesce(root, F.lit("")) for root, _ in others])
    left = F.concat(*[F.when(side < 0, F.coalesce(root, F.lit(""))).otherwise(F.lit("")) for root, side in others])
    right = F.concat(*[F.when(side > 0, F.coalesce(root, F.lit(""))).otherwise(F.lit("")) for root, side in others])
    return rows.withColumns({
        "node": F.when(active & (parent != ""), F.sha2(parent, 256)).otherwise(F.col("node")),
        "upper": F.when(active, F.array_append("upper", F.struct(left.alias("left"), right.alias("right")))).otherwise(F.col("upper")),
    })


def _swap_blocks(rows: DataFrame, r: int) -> DataFrame:
    """Round r among the blocks of a source: every group is FANOUT rows."""
    step = FANOUT ** r
    digit = F.floor(F.col("block") / F.lit(step)) % FANOUT
    group = Window.partitionBy("rank", F.floor(F.col("block") / F.lit(step * FANOUT)), F.col("block") % step)
    roots = [F.max(F.when(digit == d, F.col("node"))).over(group) for d in range(FANOUT)]
    seen = rows.withColumns({f"root{d}": root for d, root in enumerate(roots)}).withColumn("digit", digit)
    met = _meet(seen, F.col("width") > step, [(F.col(f"root{d}"), F.lit(d) - F.col("digit")) for d in range(FANOUT)])
    return met.drop("digit", *[f"root{d}" for d in range(FANOUT)])


def _swap_sources(rows: DataFrame, r: int) -> DataFrame:
    """Round r among the sources: each group of FANOUT subtrees swaps one row of roots."""
    step = FANOUT ** r
    digit = F.floor(F.col("rank") / F.lit(step)) % FANOUT
    group = F.floor(F.col("rank") / F.lit(step * FANOUT))
    swapped = rows.groupBy(group.alias("g")).agg(*[F.max(F.when(digit == d, F.col("node"))).alias(f"root{d}") for d in range(FANOUT)])
    seen = rows.join(swapped, group == F.col("g")).withColumn("digit", digit)
    met = _meet(seen, F.lit(True), [(F.col(f"root{d}"), F.lit(d) - F.col("digit")) for d in range(FANOUT)])
    return met.drop("g", "digit", *[f"root{d}" for d in range(FANOUT)])


def manifest(docs: DataFrame, tampered_text: Column | None = None, block_levels: int = BLOCK_LEVELS) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, and the root
    folded from ``tampered_text`` (default: the text itself) and the original siblings.
    A block has FANOUT ** ``block_levels`` leaves."""
    size = FANOUT ** block_levels
    fields = {n: F.col(n) for n in FIELDS}
    leaf = leaf_digest(fields)
    tampered = leaf if tampered_text is None else leaf_digest({**fields, "text": tampered_text})
    # Only digests are kept of a row.  The tie gives each of several equal rows its own place.
    leaves = written(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), leaf.alias("leaf"), tampered.alias("tampered"),
                                 F.monotonically_increasing_id().alias("tie")), "manifest-leaves")
    placed = global_position(leaves, ["source", "doc_id", "leaf", "tie"], "position")
    sources = placed.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.min("position").alias("start"))
    blocks_of = F.ceil(F.col("n") / F.lit(size)).cast("long")
    sources = global_position(sources.withColumn("blocks", blocks_of).withColumn("width", _width(F.col("blocks"))), ["source"], "rank")
    sources = written(sources, "manifest-sources")
    most = sources.agg(F.count(F.lit(1)).alias("sources"), F.max("width").alias("width")).first()

    block = F.floor((F.col("position") - F.col("start")) / F.lit(size)).cast("long")
    blocks = (join_null_safe(placed, sources, ["source"], "inner")
              .groupBy("rank", block.alias("block"), "blocks", "width", F.when(F.col("blocks") > 1, F.lit(block_levels)).alias("depth"))
              .agg(F.sort_array(F.collect_list(F.struct("position", "doc_id", "leaf", "tampered"))).alias("leaves")))
    blocks = written(blocks.mapInArrow(_add_roots, blocks.withColumn("node", F.lit("")).schema), "manifest-blocks")

    # Empty blocks up to the width, dealt to the existing ones (width < FANOUT * blocks).
    copies = F.filter(F.array(*[F.struct((F.col("block") + k * F.col("blocks")).alias("block"), F.when(F.lit(k == 0), F.col("node")).alias("node")) for k in range(FANOUT)]), lambda x: x["block"] < F.col("width"))
    rows = (blocks.select("rank", "blocks", "width", F.explode(copies).alias("x"))
            .select("rank", "blocks", "width", "x.block", "x.node", F.array().cast("array<struct<left:string,right:string>>").alias("upper")))
    for r in range(_rounds(most["width"] or 0)):
        rows = _swap_blocks(rows, r)
    rows = rows.where("block < blocks").withColumn("subroot", F.col("node"))
    for r in range(_rounds(most["sources"] or 0)):
        rows = _swap_sources(written(rows, "manifest-round"), r)

    upper = rows.select(F.col("rank").alias("k"), F.col("block").alias("b"), "upper", "subroot", "node")
    whole = blocks.drop("node").join(upper, (F.col("rank") == F.col("k")) & (F.col("block") == F.col("b"))).select("leaves", "depth", "upper", "subroot", "node")
    return whole.mapInArrow(_prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
