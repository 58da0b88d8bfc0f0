"""Document fingerprints by one-permutation MinHash.

Each five-word shingle is hashed once; the hash's top bits choose one of ``BINS`` bins,
which keeps its smallest value.  An empty bin copies another bin chosen by its own
sequence of pseudo-random probes (optimal densification), so equal sets still agree in
every bin.  Only the ``BITS`` low-order bits of each bin are kept, packed; the share of
equal bins is corrected for chance agreement.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased.  A text of
fewer than five words is one shingle; a text without words, or null, has the empty
fingerprint "": alike (1.0) to another empty one and unlike (0.0) every other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W

BINS, BITS, SHINGLE = 512, 4, 5
U = W.U
_NONE = U(0xFFFFFFFFFFFFFFFF)


def _probe(bins: np.ndarray, attempts: np.ndarray, n_bins: int) -> np.ndarray:
    """Bin looked at by each empty bin (rows) in each attempt (columns)."""
    seed = bins.astype(U)[:, None] * U(0xD1342543DE82EF95) + attempts.astype(U)[None, :] * U(0xAEF17502108EF2D9)
    return (W.mix(seed + U(0x2545F4914F6CDD1D)) % U(n_bins)).astype(np.int64)


def densify(minima: np.ndarray) -> np.ndarray:
    """Fill the empty bins of each row from its other bins; rows without any stay empty."""
    n_bins = minima.shape[1]
    filled = minima != _NONE
    out = minima.copy()
    some = filled.any(axis=1)
    row, empty = np.nonzero(~filled & some[:, None])
    first, width = 0, 8
    while len(row):
        probes = _probe(np.arange(n_bins), np.arange(first, first + width), n_bins)[empty]
        good = filled[row[:, None], probes]
        found = good.any(axis=1)
        at = good.argmax(axis=1)
        out[row[found], empty[found]] = minima[row[found], probes[found, at[found]]]
        row, empty = row[~found], empty[~found]
        first, width = first + width, 64
    return out


def sketches(texts: pa.Array, bins: int = BINS, bits: int = BITS, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Low-order bits of each text's bins (texts x bins), and which texts have words."""
    words = W.of_texts(texts, "alnum")
    values, owner = W.shingles(words, words.hashes(), size)
    minima = np.full(len(texts) * bins, _NONE, U)
    shift = U(64 - int(bins).bit_length() + 1)
    np.minimum.at(minima, owner * bins + (values >> shift).astype(np.int64), values & ((U(1) << shift) - U(1)))
    minima = densify(minima.reshape(len(texts), bins))
    return (minima & U((1 << bits) - 1)).astype(np.uint8), words.counts() > 0


def packed(low: np.ndarray, some: np.ndarray, bits: int = BITS) -> list[str]:
    """Hexadecimal text of each row's bits; "" for a text without words."""
    flat = np.unpackbits(low[:, :, None], axis=2)[:, :, 8 - bits:].reshape(len(low), -1)
    return [row.tobytes().hex() if ok else "" for row, ok in zip(np.packbits(flat, axis=1), some)]


def likeness(a: np.ndarray, b: np.ndarray, some_a: np.ndarray, some_b: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Estimated Jaccard similarity: the share of equal bins less the chance of 2**-bits."""
    chance = 2.0 ** -bits
    raw = (a == b).mean(axis=1) if len(a) else np.empty(0)
    est = np.clip((raw - chance) / (1 - chance), 0.0, 1.0)
    return np.where(some_a & some_b, est, np.where(some_a == some_b, 1.0, 0.0))


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the column ``fingerprint``.  Any other columns pass through; an
    input column of that name is replaced."""
    keep = [c for c in docs.columns if c != "fingerprint"]
    schema = docs.select(*keep).withColumn("fingerprint", F.lit("").cast("string")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, text):
            prints = packed(*sketches(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(prints, pa.string())], [*keep, "fingerprint"])

    return docs.select(*keep).mapInArrow(run, schema)


def _cells(docs: DataFrame, outer: int, target_rows: int) -> Column:
    """Number of a row's cell, falling with doc_id: consecutive ids share a cell.

    Cells come from ``outer`` quantiles of doc_id, each cut into equal widths, so the
    driver holds only the quantiles and a cell has about ``target_rows`` rows (the
    number of cells is at most ``outer`` * 1024, whatever the size of the table).
    """
    ids = docs.select("doc_id")
    got = ids.agg(F.percentile_approx("doc_id", [i / outer for i in range(outer + 1)], 10000).alias("q"), F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).first()
    if got["q"] is None:
        return F.lit(0).cast("long")
    cuts = sorted({got["lo"], *got["q"], got["hi"] + 1})
    inner = max(1, min(1024, got["n"] // (outer * target_rows)))

    def tree(a: int, b: int) -> Column:
        if b - a == 1:
            width = max(1, -(-(cuts[b] - cuts[a]) // inner))
            return F.lit(a * inner) + F.floor((F.col("doc_id") - F.lit(cuts[a])) / F.lit(width)).cast("long")
        mid = (a + b) // 2
        return F.when(F.col("doc_id") < F.lit(cuts[mid]), tree(a, mid)).otherwise(tree(mid, b))

    n = (len(cuts) - 1) * inner
    return F.when(F.col("doc_id").isNull(), F.lit(n)).otherwise(F.lit(n - 1) - tree(0, len(cuts) - 1)).cast("long")


def edited_neighbours(docs: DataFrame, outer: int = 64, target_rows: int = 64) -> DataFrame:
    """Fingerprints of every text and of its edited text.

    The edited text has its last floor(n / 2) code points replaced by the first as many
    (or all) of the next document in descending doc_id; after the last comes the first.
    Null ids come last, rows of one id follow in the order of their text's hash, and a
    single row is its own next.  A null text counts as empty.

    Rows are dealt once, by cell of consecutive ids, and sorted within their task; the
    first row of each cell also goes to the cell before it, which needs its text.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cell = _cells(docs, outer, target_rows)
    rows = docs.withColumn("cell", cell).withColumn("tie", F.xxhash64("text"))
    first = rows.groupBy("cell").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("k"), F.col("doc_id").alias("i"), F.col("tie").alias("t"))).alias("m"))
    # One row per cell (at most outer * 1024 of them): small enough for one task and a broadcast.
    heads = [(r["cell"], r["m"]["i"], r["m"]["t"]) for r in first.orderBy("cell").collect()]
    spark = docs.sparkSession
    before = [(h[0], h[1], h[2], heads[k - 1][0]) for k, h in enumerate(heads)]
    ahead = spark.createDataFrame(before, "cell long, i long, t long, target long")
    rows = rows.join(F.broadcast(ahead.withColumnRenamed("cell", "c")), (F.col("cell") == F.col("c")) & F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("tie") == F.col("t")), "left")
    dealt = rows.select(
        "doc_id", "text", "tie",
        F.explode(F.when(F.col("target").isNull(), F.array(F.struct(F.col("cell").alias("cell"), F.lit(False).alias("extra"))))
                  .otherwise(F.array(F.struct(F.col("cell").alias("cell"), F.lit(False).alias("extra")), F.struct(F.col("target").alias("cell"), F.lit(True).alias("extra"))))).alias("p"),
    ).select(F.col("p.cell").alias("cell"), F.col("p.extra").alias("extra"), "doc_id", "tie", "text")
    dealt = dealt.repartition("cell").sortWithinPartitions("cell", "extra", F.col("doc_id").desc_nulls_last(), F.col("tie").desc())
    schema = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"

    def finish(chunk: list[tuple], following: tuple) -> pa.RecordBatch:
        """Results of a few consecutive rows; ``following`` is the row after them."""
        texts = [t for _, t in chunk]
        after = texts[1:] + [following[1]]
        edited = [t[:len(t) - len(t) // 2] + u[:len(t) // 2] for t, u in zip(texts, after)]
        low, some = sketches(pa.array([*texts, following[1]], pa.large_string()))
        low_e, some_e = sketches(pa.array(edited, pa.large_string()))
        own, own_some = low[:-1], some[:-1]
        return pa.RecordBatch.from_arrays([
            pa.array([i for i, _ in chunk], pa.int64()), pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited], pa.string()),
            pa.array(packed(own, own_some), pa.string()), pa.array(packed(low_e, some_e), pa.string()),
            pa.array(likeness(own, low_e, own_some, some_e)), pa.array(likeness(own, low[1:], own_some, some[1:])),
        ], ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row is open until the row after it is known.  The rows of a cell end with
        the copies of the next cell's first row, whose texts are all equal."""
        chunk: list[tuple] = []
        size = 0
        for batch in W.pieces(batches):
            for cell, extra, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("cell", "extra", "doc_id", "text"))):
                if chunk and (extra or size >= W.PIECE):
                    yield finish(chunk, (doc_id, text))
                    chunk, size = [], 0
                if not extra:
                    chunk.append((doc_id, text))
                    size += len(text)

    return dealt.mapInArrow(run, schema)
