"""Phrase collocations by top-order marginalisation.

A text is cut into pieces at . , ; : ! ? and line breaks, a piece into words at blanks and
tabs (A-Z lower-cased).  Every word begins one window: itself and the words that follow it
in its piece, ``LONGEST`` in all, side by side in the columns w1, w2, ... (null behind the
end of the piece).  Only these longest windows are counted, once each.  Spark's ROLLUP
over (w1, w2, ...) then sums them by ever shorter prefixes: the windows that begin with a
phrase are its occurrences, and those of a language are its words.

Words behind a prefix that cannot reach ``least`` occurrences are left out of the windows
(null) before they are shuffled.  A pass over the texts counts words and pairs, by hash, in
two tables of ``cells`` counters; a second one counts longer n-grams in two others, where
all pairs inside may be frequent.  A counter is never below the count of an n-gram in it,
and a phrase of at least ``least`` occurrences has only such phrases inside it, so no
occurrence that matters is lost and all counts of the result are exact.  A rare n-gram
passes only if it shares a counter in both tables.  The tables grow with the texts,
``BYTES`` of text to a counter, up to ``CELLS`` counters; on a corpus too large for that
fewer windows are shortened, the results are the same.

Each of these passes runs in one task per core, however many files or splits the texts
have: a task sends each different window and each counter once, so what is sent grows
with the number of different frequent windows and not also with that of the splits.

Candidates are phrases of 2 to LONGEST words with at least ``least`` occurrences.  A cut
into two parts with l and r occurrences scores floor(1000 * a * n / (l * r)), in exact
decimals; the lowest cut counts, of equal ones that with the shorter first part.
A candidate is dropped if a longer one contains it and occurs as often.

A null language is ``und``.  Null and empty texts have no words.  Texts are read whole, in
parts of about 1 MB of several texts; a longer text is a part of its own.  Repeated rows
count each time.  Ties are broken by the phrase.  Other columns of the input are not
read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.tables import written

#: Words of the longest phrase, occurrences of a candidate, rows per language.
LONGEST, LEAST, TOP = 5, 100, 2000
#: A counter for so many bytes of text; the most in one of the two tables of a task, of a byte each.
BYTES, CELLS = 128, 1 << 27
#: Words and pairs are counted before longer n-grams.
FIRST = 2
#: Counters are sent in pieces of so many, and stop at CEILING.
CHUNK, CEILING = 1 << 14, 255

_BREAK = np.isin(np.arange(256), [ord(c) for c in ".,;:!?\n\x0b\x0c\r"])
_GAP = _BREAK | np.isin(np.arange(256), [32, 9])


#: Orders of n-grams, and for each of their counters, in one bit, whether it may reach ``least``.
Table = tuple[range, np.ndarray]


class Piece:
    """Words of a batch: their ``hashes``, languages ``lang`` (numbers into ``langs``, which
    are hashed to ``seeds``), and ``room``: how many words from each one on belong to its
    piece, ``longest`` at most."""

    def __init__(self, batch: pa.RecordBatch, longest: int):
        data, offsets = W.buffers(batch.column("text"))
        found = W.Words(data, offsets, "spaced", inside=~_GAP, lower=True)
        count = len(found)
        owner = np.repeat(np.arange(batch.num_rows), found.counts())
        breaks = np.concatenate([[0], np.cumsum(_BREAK[data])])[found.start]
        joined = (breaks[1:] == breaks[:-1]) & (owner[1:] == owner[:-1]) if count else np.empty(0, bool)
        self.room = np.ones(count, np.int8)
        for _ in range(longest - 1):
            self.room[:-1] = np.where(joined, np.minimum(self.room[1:] + 1, longest), 1)
        self.hashes = found.hashes()
        langs = batch.column("lang").dictionary_encode()
        self.langs = langs.dictionary.to_pylist()
        self.seeds = np.array([xxhash.xxh64_intdigest(x) for x in self.langs], W.U)
        self.lang = np.asarray(langs.indices).astype(np.int64)[owner]
        self._spelled = W.LOWER[data[(~_GAP)[data]]]
        self._ends = np.concatenate([[0], np.cumsum(found.end - found.start)]).astype(np.int64)

    def __len__(self) -> int:
        return len(self.hashes)

    def cells(self, order: int, cells: int, places: np.ndarray) -> np.ndarray:
        """The counters of the n-grams of this order at these places: a row for each table,
        the second table's behind the first's."""
        mixed = W.mix(W.grams(self.hashes, order)[places] ^ self.seeds[self.lang[places]] ^ W.U(order))
        return (np.stack([mixed, mixed >> W.U(32)]) & W.U(cells - 1)).astype(np.int64) + [[0], [cells]]

    def reach(self, longest: int, tables: list[Table]) -> np.ndarray:
        """How many words from each one on may be a frequent phrase by the tables.  Orders
        behind the last table are only held to what stands inside their n-grams."""
        if not tables:
            return self.room
        length, order = np.zeros(len(self), np.int8), 0
        for orders, bits in tables:
            for order in orders:
                places = np.flatnonzero((length == order - 1) & (self.room >= order))
                cell = self.cells(order, 4 * len(bits), places)
                length[places[((bits[cell >> 3] << (cell & 7).astype(np.uint8)) & 128 > 0).all(axis=0)]] = order
        for _ in range(order - 1):  # what stands inside a frequent phrase is frequent
            length[:-1] = np.minimum(length[:-1], length[1:] + 1)
        for known in range(order, longest):
            more = (length[:-1] == known) & (length[1:] >= known) & (self.room[:-1] > known)
            length[:-1][more] = known + 1
        return length

    def coded(self) -> tuple[np.ndarray, pa.Array]:
        """The words as numbers of an array of distinct words, compared by their bytes."""
        spelled = pa.Array.from_buffers(pa.large_string(), len(self), [None, pa.py_buffer(self._ends), pa.py_buffer(self._spelled)]).dictionary_encode()
        return np.asarray(spelled.indices).astype(np.int64), spelled.dictionary


def packed(tables: list[Table]) -> list[tuple[range, bytes]]:
    return [(orders, zstandard.ZstdCompressor(3).compress(bits.tobytes())) for orders, bits in tables]


def unpacked(tables: list[tuple[range, bytes]]) -> list[Table]:
    return [(orders, np.frombuffer(zstandard.ZstdDecompressor().decompress(bits), np.uint8)) for orders, bits in tables]


def by_core(docs: DataFrame) -> DataFrame:
    """The same rows in no more partitions than the cluster has cores."""
    return docs.coalesce(max(1, docs.sparkSession.sparkContext.defaultParallelism))


def room_for(docs: DataFrame) -> int:
    """The number of counters in a table for these texts, a power of two."""
    size = docs.agg(F.sum(F.octet_length("text")).alias("size")).first()["size"] or 0
    return min(CELLS, max(CHUNK, 1 << (int(size) // BYTES).bit_length()))


def bound(docs: DataFrame, orders: range, longest: int, least: int, cells: int, tables: list[Table]) -> np.ndarray:
    """For each counter, in one bit, whether the n-grams in it may reach ``least``; n-grams
    that cannot by the tables of lower orders are not counted."""
    if least > CEILING:
        raise ValueError(f"counters stop at {CEILING}")
    size, chunks, known = 2 * cells, max(1, 2 * cells // CHUNK), packed(tables)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, lower = np.zeros(size, np.uint8), unpacked(known)
        for batch in W.pieces(batches):
            piece = Piece(batch, longest)
            reach = piece.reach(longest, lower)
            for order in orders:
                cell, times = np.unique(piece.cells(order, cells, np.flatnonzero(reach >= order)), return_counts=True)
                counters[cell] = np.minimum(counters[cell] + times, CEILING)
        pack = zstandard.ZstdCompressor(1)
        for chunk, values in enumerate(np.split(counters, chunks)):
            if values.any():
                yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), pa.array([pack.compress(values.tobytes())], pa.binary())], ["chunk", "counters"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums the sorted rows of one chunk after the other."""
        unpack, now, total = zstandard.ZstdDecompressor(), None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([np.packbits(total >= least).tobytes()], pa.binary())], ["chunk", "bits"])

        for batch in batches:
            for chunk, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
                if chunk != now:
                    if now is not None:
                        yield done()
                    now, total = chunk, np.zeros(size // chunks, np.uint16)
                total = np.minimum(total + np.frombuffer(unpack.decompress(packed.as_py()), np.uint8), CEILING).astype(np.uint16)
        if now is not None:
            yield done()

    counted = by_core(docs).mapInArrow(count, "chunk int, counters binary")
    summed = counted.repartition("chunk").sortWithinPartitions("chunk").mapInArrow(add, "chunk int, bits binary")
    out = np.zeros((chunks, size // chunks // 8), np.uint8)
    for r in summed.collect():  # size / 8 bytes in all, CELLS / 4 at most
        out[r["chunk"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def windows(docs: DataFrame, longest: int, least: int, cells: int, held: int = 500_000) -> DataFrame:
    """lang, w1, w2, ..., times: the longest windows of every word, cut before a prefix that
    is too rare, summed in the tasks while they hold no more than ``held`` different ones."""
    tables: list[Table] = []
    for orders in (range(1, min(FIRST, longest) + 1), range(FIRST + 1, longest + 1)):
        if orders:
            tables.append((orders, bound(docs, orders, longest, least, cells, tables)))
    known = packed(tables)
    keys = ["lang", *[f"w{k + 1}" for k in range(longest)]]
    schema = ", ".join([f"{k} string" for k in keys] + ["times long"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[pa.RecordBatch] = []

        def summed() -> pa.Table:
            out = pa.Table.from_batches(waiting).group_by(keys, use_threads=False).aggregate([("times", "sum")]).rename_columns([*keys, "times"])
            waiting.clear()
            return out

        lower = unpacked(known)
        for batch in W.pieces(batches, limit=4 * W.PIECE):
            piece = Piece(batch, longest)
            n = len(piece)
            if not n:
                continue
            length = piece.reach(longest, lower)
            words, distinct = piece.coded()
            # Equal windows get equal numbers, built up word by word; a missing word is 0.
            size = len(distinct) + 1
            number, ids = piece.lang, np.concatenate([words + 1, np.zeros(longest, np.int64)])
            for k in range(longest):
                number = np.unique(number * size + np.where(length > k, ids[k:k + n], 0), return_inverse=True)[1]
            _, first, times = np.unique(number, return_index=True, return_counts=True)
            columns = [pa.array(piece.langs, pa.string()).take(pa.array(piece.lang[first]))]
            for k in range(longest):
                index = pa.array(ids[k:k + n][first] - 1, mask=length[first] <= k)
                columns.append(distinct.take(index).cast(pa.string()))
            waiting.append(pa.RecordBatch.from_arrays([*columns, pa.array(times, pa.int64())], [*keys, "times"]))
            if sum(x.num_rows for x in waiting) > 2 * held:
                waiting += summed().combine_chunks().to_batches()
                if sum(x.num_rows for x in waiting) > held:
                    yield from waiting
                    waiting = []
        if waiting:
            yield from summed().to_batches()

    return by_core(docs).mapInArrow(run, schema)


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, cells: int | None = None) -> DataFrame:
    """lang, words, phrase, f: all phrases of up to ``longest`` words with at least ``least``
    occurrences; with words 0 and an empty phrase the number of all words of the language."""
    docs = docs.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    names = [f"w{k + 1}" for k in range(longest)]
    counted = windows(docs, longest, least, cells or room_for(docs)).groupBy("lang", *names).agg(F.sum("times").alias("times"))
    level = F.grouping_id()
    sums = counted.rollup("lang", *names).agg(F.sum("times").alias("f"), level.alias("level"))
    # The grouping id has a one for each column that is summed away.
    order = sum((F.when(F.col("level") == (1 << (longest - k)) - 1, k).otherwise(0) for k in range(1, longest + 1)), F.lit(0))
    sums = sums.where(F.col("level") < (1 << longest)).withColumn("words", order)
    last = F.when(F.col("words") == 0, F.lit("")).otherwise(F.get(F.array(*names), F.col("words") - 1))
    return sums.where(last.isNotNull() & ((F.col("words") == 0) | (F.col("f") >= least))).select("lang", "words", F.concat_ws(" ", *names).alias("phrase"), "f")


def collocations(docs: DataFrame, longest: int = LONGEST, least: int = LEAST, top: int = TOP, cells: int | None = None) -> DataFrame:
    """The ``top`` collocations of every language: lang, rank, phrase, a, l, r, n, score."""
    counts = written(phrase_counts(docs, longest, least, cells), "phrases")
    phrases = counts.where("words > 0")
    parts = F.split("phrase", " ")
    candidates = phrases.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), parts.alias("w"))

    def joined(first, size):
        return F.array_join(F.slice("w", first, size), " ")

    cuts = candidates.select("lang", "phrase", "words", "a", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", joined(F.lit(1), F.col("k")).alias("head"), joined(F.col("k") + 1, F.col("words") - F.col("k")).alias("tail"))
    heads = phrases.select(F.col("lang").alias("lang1"), F.col("phrase").alias("head1"), F.col("f").alias("l"))
    tails = phrases.select(F.col("lang").alias("lang2"), F.col("phrase").alias("tail2"), F.col("f").alias("r"))
    totals = counts.where("words = 0").select(F.col("lang").alias("lang0"), F.col("f").alias("n"))
    cuts = (cuts.join(heads, (F.col("lang") == F.col("lang1")) & (F.col("head") == F.col("head1")))
                .join(tails, (F.col("lang") == F.col("lang2")) & (F.col("tail") == F.col("tail2")))
                .join(totals, F.col("lang") == F.col("lang0")))
    # Exact: 38 digits hold 1000 * a * n for more than 10 ** 17 words.
    score = F.expr("CAST(1000 AS DECIMAL(4, 0)) * CAST(a AS DECIMAL(17, 0)) * CAST(n AS DECIMAL(17, 0)) div (CAST(l AS DECIMAL(19, 0)) * CAST(r AS DECIMAL(19, 0)))")
    best = cuts.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))

    inner = F.sequence(F.lit(2), F.col("words") - 1)
    spans = F.flatten(F.transform(inner, lambda size: F.transform(F.sequence(F.lit(1), F.col("words") - size + 1), lambda at: F.array_join(F.slice("w", at, size), " "))))
    inside = (candidates.where("words > 2").select("lang", "a", F.explode(spans).alias("part"))
              .groupBy(F.col("lang").alias("lang1"), F.col("part").alias("part1")).agg(F.max("a").alias("longer")))
    kept = (best.join(inside, (F.col("lang") == F.col("lang1")) & (F.col("phrase") == F.col("part1")), "left")
            .where("longer IS NULL OR longer < a").select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score"))
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc())
    ranked = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
