"""N-gram Jaccard join by MinHash banding, verified on full shingle sets.

A document is the set of its five-word shingles (words: letters, digits and non-ASCII
characters, A-Z lower-cased; fewer than five words are one shingle).  Documents with
equal sets are copies and handled as one.  Of the others, a signature of bands * rows
minima is cut into bands; two documents that agree in a band are candidates.  Bands and
rows are chosen so that a pair at the threshold is a candidate with the wanted recall.

Candidates are never listed as pairs.  Each member of a band bucket is tied to the
bucket's first, and the connected components of these ties, which hold all pairs that
share a band, are the clusters.  A cluster is cut into blocks of bounded size; each pair
of blocks is one piece of work, which compares all its documents' full sets and returns
one row per document: how many partners it has there and the first document it is
connected with.  Components of these rows are the classes.

Texts without words are alike only if they are the same text (null and "" are).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.graph import components
from ledgerlake.llm.tables import LAST_ID, order_id, row_key, written

THRESHOLD, SHINGLE, RECALL = 0.8, 5, 0.999
#: A block has about so many documents and shingles at most; two of them meet in a task.
BLOCK_DOCS, BLOCK_SHINGLES = 1024, 1 << 20
#: ... and a cluster is cut into up to SPREAD blocks of SMALL_BLOCK documents, so that its
#: work is shared by many tasks; a document is sent once for each block of its cluster.
SMALL_BLOCK, SPREAD = 128, 12
_COLUMNS = 4096  # shingles compared at a time
U = W.U


def bands_and_rows(threshold: float = THRESHOLD, recall: float = RECALL, most: int = 20) -> tuple[int, int]:
    """The most rows per band whose bands, as many as the recall at the threshold needs,
    are no more than ``most``: more rows mean fewer false candidates."""
    for rows in range(12, 1, -1):
        chance = threshold ** rows
        need = math.ceil(math.log(1 - recall) / math.log(1 - chance)) if chance < 1 else 1
        if need <= most:
            return need, rows
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold)), 1


def _multipliers(n: int) -> np.ndarray:
    return W.mix(np.arange(1, n + 1, dtype=U) * U(0xA0761D6478BD642F)) | U(1)


def signatures(texts: pa.Array, bands: int, rows: int, size: int = SHINGLE) -> tuple[list, list, list, list]:
    """Per text: two 64-bit hashes of the shingle set, its size, and the band hashes."""
    words = W.of_texts(texts, "alnum")
    values, owner = W.shingles(words, words.hashes(), size)
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    if len(values):
        new = np.ones(len(values), bool)
        new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
        values, owner = values[new], owner[new]
    count = np.bincount(owner, minlength=len(texts))
    some = np.flatnonzero(count)
    start = np.concatenate([[0], np.cumsum(count)])[:-1][some]
    h1, h2 = np.zeros(len(texts), U), np.zeros(len(texts), U)
    minima = np.zeros((len(texts), bands * rows), U)
    if len(values):
        h1[some] = np.add.reduceat(W.mix(values ^ U(0x5851F42D4C957F2D)), start)
        h2[some] = np.add.reduceat(W.mix(values * U(0xDA942042E4DD58B5) + U(0x14057B7EF767814F)), start)
        for k, a in enumerate(_multipliers(bands * rows)):
            minima[some, k] = np.minimum.reduceat(values * a, start)
    keys = np.zeros((len(texts), bands), U)
    for j in range(rows):
        keys = W.mix(keys + minima[:, j::rows][:, :bands] * U(0x9E3779B97F4A7C15))
    return h1.view(np.int64).tolist(), h2.view(np.int64).tolist(), count.tolist(), [k.tolist() if n else [] for k, n in zip(keys.view(np.int64), count)]


def _sets(texts: list[str], size: int) -> list[np.ndarray]:
    words = W.of_texts(pa.array(texts, pa.large_string()), "alnum")
    values, owner = W.shingles(words, words.hashes(), size)
    order = np.argsort(owner, kind="stable")
    cuts = np.searchsorted(owner[order], np.arange(1, len(texts)))
    return [np.unique(s) for s in np.split(values[order], cuts)]


def linked(sets: list[np.ndarray], threshold: float) -> np.ndarray:
    """Which of the sets have a Jaccard similarity of the threshold or more (n x n).

    Only shingles of two sets or more can be shared; they are compared some thousands at
    a time, as the product of the 0/1 matrix of sets and shingles with itself.
    """
    n = len(sets)
    size = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    keys, place, often = np.unique(flat, return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), size)
    shared = often[place] > 1
    number = np.cumsum(often > 1) - 1
    column, owner = number[place[shared]], owner[shared]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    both = np.zeros((n, n), np.float64)
    for first in range(0, int((often > 1).sum()), _COLUMNS):
        a, b = np.searchsorted(column, [first, first + _COLUMNS])
        part = np.zeros((n, _COLUMNS), np.float32)
        part[owner[a:b], column[a:b] - first] = 1
        both += part @ part.T
    union = size[:, None] + size[None, :] - both
    out = both >= threshold * union - 1e-9
    np.fill_diagonal(out, False)
    return out


def _firsts(links: np.ndarray) -> np.ndarray:
    """Index of the first member of each one's connected component."""
    label = np.full(len(links), -1)
    for i in range(len(links)):
        if label[i] < 0:
            label[i] = i
            edge = [i]
            while edge:
                more = np.flatnonzero(links[edge].any(axis=0) & (label < 0))
                label[more] = i
                edge = more.tolist()
    return label


def _work(group: list[tuple], same_block: bool, threshold: float, size: int) -> list[tuple[int, int, int]]:
    """(node, partners, first connected node) of one pair of blocks."""
    group.sort()
    nodes = [g[0] for g in group]
    block = np.array([g[1] for g in group])
    many = np.array([g[2] for g in group])
    links = linked(_sets([g[3] for g in group], size), threshold)
    if not same_block:
        links &= block[:, None] != block[None, :]
    partners = (links * many[None, :]).sum(axis=1)
    label = _firsts(links)
    return [(nodes[i], int(partners[i]), nodes[label[i]]) for i in range(len(nodes)) if partners[i]]


def near_duplicates(docs: DataFrame, threshold: float = THRESHOLD, size: int = SHINGLE, recall: float = RECALL, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, _key (``row_key``), class_id, the smallest
    doc_id of its class (null if none has one), n_links, how many other rows have a
    similarity of the threshold or more, and first, whether the row (with its equals in
    doc_id and text) is the one that stands for its class.

    Rows of one doc_id and different texts are different documents; repeated rows are
    copies.  Columns other than doc_id and the text are not looked at.
    """
    bands, rows = bands_and_rows(threshold, recall)
    plain = docs.select(order_id().alias("id"), row_key("doc_id", text).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            h1, h2, count, keys = signatures(batch.column("text"), bands, rows, size)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), batch.column("t"), pa.array(h1, pa.int64()), pa.array(h2, pa.int64()),
                                              pa.array(count, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["id", "key", "t", "h1", "h2", "n", "bands"])

    signed = plain.select("id", "key", F.xxhash64("text").alias("t"), "text").mapInArrow(sign, "id long, key long, t long, h1 long, h2 long, n long, bands array<long>")
    # A text without words is its own set.
    signed = signed.withColumn("h1", F.when(F.col("n") == 0, F.col("t")).otherwise(F.col("h1"))).drop("t")
    signed = written(signed, "signatures")
    reps = signed.groupBy("h1", "h2", "n").agg(F.min(F.struct("id", "key")).alias("rep"), F.count(F.lit(1)).alias("many"), F.first("bands").alias("bands"))
    reps = written(reps.select(F.monotonically_increasing_id().alias("node"), "h1", "h2", "n", "rep.id", "rep.key", "many", "bands"), "sets")

    keys = reps.select("node", F.posexplode("bands").alias("band", "hash"))
    buckets = keys.groupBy("band", "hash").agg(F.min("node").alias("lead"), F.count(F.lit(1)).alias("size")).where("size > 1").select("band", "hash", "lead")
    ties = keys.join(written(buckets, "buckets"), ["band", "hash"]).where("node != lead").select(F.col("node").alias("u"), F.col("lead").alias("v"))
    clusters = written(components(ties).select("node", F.col("root").alias("cluster")), "clusters")

    members = clusters.join(reps.select("node", "id", "key", "n", "many"), "node")
    members = written(members, "members")
    cut = members.groupBy("cluster").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_DOCS), F.ceil(F.sum("n") / BLOCK_SHINGLES), F.least(F.ceil(F.count(F.lit(1)) / SMALL_BLOCK), F.lit(SPREAD))).cast("int").alias("blocks"))
    placed = members.join(written(cut, "blocks"), "cluster").select("cluster", "node", "id", "key", "many", "blocks", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block"))
    full = placed.join(plain, ["id", "key"]).select("cluster", "node", "many", "blocks", "block", "text")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    dealt = full.withColumn("other", other).select("cluster", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "node", "block", "many", "text")
    # By range, so that tasks get equal numbers of rows: a key is never cut, and by hash
    # several pairs of blocks of one large cluster would meet in a task.
    dealt = dealt.repartitionByRange("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "node")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        at, out = None, []

        def flush() -> None:
            if len(group) > 1:
                out.extend(_work(group, at[1] == at[2], threshold, size))
            group.clear()

        for batch in W.pieces(batches):
            for c, i, j, node, block, many, t in zip(*(batch.column(x).to_pylist() for x in ("cluster", "i", "j", "node", "block", "many", "text"))):
                if (c, i, j) != at:
                    flush()
                    at = (c, i, j)
                if not group or group[-1][0] != node:  # repeated rows of one id and text
                    group.append((node, block, many, t))
            if len(out) > 10_000:
                yield _rows(out)
                out = []
        if at:
            flush()
        yield _rows(out)

    def _rows(out: list[tuple[int, int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.int64()) for k in range(3)], ["node", "partners", "lead"])

    found = written(dealt.mapInArrow(verify, "node long, partners long, lead long"), "links")
    partners = found.groupBy("node").agg(F.sum("partners").alias("partners"))
    roots = components(found.select(F.col("node").alias("u"), F.col("lead").alias("v")))
    graded = reps.select("node", "h1", "h2", "n", "id", "key", "many").join(partners, "node", "left").join(roots, "node", "left")
    graded = graded.withColumn("root", F.coalesce("root", "node")).withColumn("links", F.col("many") - 1 + F.coalesce("partners", F.lit(0)))
    graded = written(graded.drop("partners", "node", "many"), "graded")
    classes = graded.groupBy("root").agg(F.min(F.struct("id", "key")).alias("head"))
    final = written(graded.drop("id", "key").join(written(classes, "classes"), "root").select("h1", "h2", "n", "links", "head"), "class-of-set")
    return signed.join(final, ["h1", "h2", "n"]).select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), F.col("key").alias("_key"), F.when(F.col("head.id") != LAST_ID, F.col("head.id")).alias("class_id"),
        F.col("links").alias("n_links"), ((F.col("id") == F.col("head.id")) & (F.col("key") == F.col("head.key"))).alias("first"))


def deduplicated(docs: DataFrame, threshold: float = THRESHOLD, text: str = "text") -> DataFrame:
    """One document of each class: the one with the smallest doc_id."""
    stay = near_duplicates(docs, threshold, text=text).where("first").select(F.coalesce("doc_id", F.lit(LAST_ID)).alias("_id"), F.col("_key").alias("_k")).distinct()
    stay = written(stay, "stay")
    rows = docs.withColumn("_id", order_id()).withColumn("_k", row_key("doc_id", text))
    return rows.join(stay, ["_id", "_k"], "left_semi").dropDuplicates(["_id", "_k"]).drop("_id", "_k")
