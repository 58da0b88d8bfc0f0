"""Duplicate passages by relative Lempel-Ziv parsing.

A document is factored greedily against the collection's reference: at each word the
factor is the longest run that also stands in the reference, in a document with a
smaller id.  Factors of ``WINDOW`` words or more are duplicate spans.  The reference is
every place where a passage occurs first; it is indexed by windows of ``WINDOW`` words, so
a factor begins where a window is found and goes on while the next window is found at
the next place of the same reference document.  Where a factor ends, parsing does not
jump behind it: the windows that reach over the boundary are looked up as well, so a
passage that continues in another document is not lost.

The index is not one block but dealt over the cluster by window, and a document meets
exactly those parts of it that hold one of its passages:

1. Every window has an anchor, the smallest hash of its ``GRAM``-word pieces, which is
   the same wherever the window stands.  Anchors (one in some twenty words) that occur
   in one document only are ruled out by one aggregation.
2. Documents with other anchors give the windows of these anchors; the first place of
   each window that occurs in several documents is the index.
3. A document's windows are joined with the index, and it is parsed.

Whole copies of a document are found by one hash of all its words and are not parsed.
Windows and whole documents are compared by 128-bit hashes.

Words are runs of characters other than ASCII white space, unchanged.  A null text has
none.  Rows without an id come behind all ids; rows of one id are not sources of each
other.  A document of fewer than ``WINDOW`` words keeps all.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm import words as W
from ledgerlake.llm.tables import LAST_ID, order_id, row_key, written

WINDOW, GRAM = 50, 12
U = W.U
_SECOND = U(0x632BE59BD9B4E019)


def _anchors(hashes: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Anchor of the window that starts at each word (also of those that leave a text)."""
    return W.sliding_min(W.grams(hashes, gram), window - gram + 1)


def _windows(hashes: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    return W.rolling(hashes, window), W.rolling(W.mix(hashes ^ _SECOND), window)


def _plain(words: W.Words, i: int) -> list[bytes]:
    data = words.data
    return [data[a:b].tobytes() for a, b in zip(words.start[words.first[i]:words.first[i + 1]], words.end[words.first[i]:words.first[i + 1]])]


def _joined(words: W.Words, i: int) -> bytes:
    """All words of a text joined by one space."""
    a, b = int(words.offsets[i]), int(words.offsets[i + 1])
    return b" ".join(words.data[a:b].tobytes().split())


def profiles(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Per row: number of words, hash of all words, their digest, and its anchors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            words = W.of_texts(batch.column("text"), "spaced")
            hashes = words.hashes()
            counts = words.counts()
            anchors = _anchors(hashes, window, gram)
            out, w1, w2, digest = [], [], [], []
            second = W.mix(hashes ^ _SECOND)
            for i in range(batch.num_rows):
                a, b = int(words.first[i]), int(words.first[i + 1])
                out.append(np.unique(anchors[a:b - window + 1]).view(np.int64) if b - a >= window else np.empty(0, np.int64))
                w1.append(int(W.rolling(hashes[a:b], b - a)[0].view(np.int64)) if b > a else 0)
                w2.append(int(W.rolling(second[a:b], b - a)[0].view(np.int64)) if b > a else 0)
                digest.append(hashlib.sha256(_joined(words, i)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(counts.astype(np.int64)), pa.array(w1, pa.int64()), pa.array(w2, pa.int64()),
                                              pa.array(digest, pa.string()), pa.array(out, pa.list_(pa.int64()))], ["id", "key", "n_words", "w1", "w2", "digest", "anchors"])

    return docs.mapInArrow(run, "id long, key long, n_words long, w1 long, w2 long, digest string, anchors array<long>")


def candidate_windows(docs: DataFrame, window: int, gram: int) -> DataFrame:
    """Distinct windows of each document that have one of its listed anchors, with their
    first place, and the text, packed."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=3)
        for batch in W.pieces(batches):
            words = W.of_texts(batch.column("text"), "spaced")
            hashes = words.hashes()
            anchors = _anchors(hashes, window, gram)
            h1, h2 = _windows(hashes, window)
            rows = []
            for i in range(batch.num_rows):
                a, b = int(words.first[i]), int(words.first[i + 1])
                listed = np.sort(np.asarray(batch.column("listed")[i].values).view(U))
                at = a + np.flatnonzero(np.isin(anchors[a:b - window + 1], listed))
                _, first = np.unique(h1[at], return_index=True)
                at = at[np.sort(first)]
                rows.append((h1[at].view(np.int64), h2[at].view(np.int64), at - a, pack.compress(_joined(words, i))))
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), *(pa.array([r[k] for r in rows], pa.list_(pa.int64())) for k in range(3)),
                                              pa.array([r[3] for r in rows], pa.binary())], ["id", "key", "h1", "h2", "place", "packed"])

    return docs.mapInArrow(run, "id long, key long, h1 array<long>, h2 array<long>, place array<long>, packed binary")


def factors(hashes: np.ndarray, places: np.ndarray, source: np.ndarray, source_place: np.ndarray, window: int) -> list[tuple[int, int, int, int]]:
    """Greedy factors (start, words, source id, place in it) of a document's windows.

    ``places`` are first places of windows that the index has; an equal window further
    on has the same source.
    """
    windows = W.rolling(hashes, window)
    order = np.argsort(windows[places])
    keys = windows[places][order]
    spot = np.minimum(np.searchsorted(keys, windows), max(len(keys) - 1, 0))
    found = keys[spot] == windows if len(keys) else np.zeros(len(windows), bool)
    starts = np.flatnonzero(found)
    if not len(starts):
        return []
    src, at = source[order][spot[starts]], source_place[order][spot[starts]]
    # A factor goes on while the next window stands next (or, in a run of one repeated
    # word, at the same place) in the same source; else a new factor begins there.
    step = at[1:] - at[:-1]
    on = (starts[1:] == starts[:-1] + 1) & (src[1:] == src[:-1]) & ((step == 1) | (step == 0))
    heads = np.concatenate([[0], np.flatnonzero(~on) + 1])
    tails = np.concatenate([heads[1:] - 1, [len(starts) - 1]])
    return [(int(starts[h]), int(starts[t] - starts[h]) + window, int(src[h]), int(at[h])) for h, t in zip(heads, tails)]


def parsed(docs: DataFrame, window: int) -> DataFrame:
    """The parse of documents with ``packed`` text and ``sources``."""
    factor = pa.list_(pa.struct([("start", pa.int64()), ("n_words", pa.int64()), ("source_id", pa.int64()), ("source_start", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in W.pieces(batches, "packed", W.PIECE >> 2):
            texts = [unpack.decompress(p) for p in batch.column("packed").to_pylist()]
            words = W.of_texts(pa.array(texts, pa.large_binary()), "spaced")
            hashes = words.hashes()
            found, removed, digest = [], [], []
            for i in range(batch.num_rows):
                a, b = int(words.first[i]), int(words.first[i + 1])
                listed = batch.column("sources")[i].values
                place, source, at = (np.asarray(listed.field(k)) for k in range(3))
                own = factors(hashes[a:b], place, source, at, window)
                cover = np.zeros(b - a + 1, np.int64)
                for start, n, _, _ in own:
                    cover[start] += 1
                    cover[start + n] -= 1
                gone = np.cumsum(cover)[:-1] > 0
                kept = [w for w, g in zip(_plain(words, i), gone) if not g]
                found.append([{"start": s, "n_words": n, "source_id": d, "source_start": p} for s, n, d, p in own])
                removed.append(int(gone.sum()))
                digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("key"), pa.array(removed, pa.int64()), pa.array(digest, pa.string()), pa.array(found, factor)],
                                             ["id", "key", "removed", "left", "factors"])

    return docs.mapInArrow(run, "id long, key long, removed long, left string, factors array<struct<start: long, n_words: long, source_id: long, source_start: long>>")


def duplicate_passages(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, text: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 (SHA-256 of the words
    that are left, joined by one space) and factors, the duplicate spans with their
    sources.  Other columns are not looked at."""
    plain = docs.select(order_id().alias("id"), row_key("doc_id", text).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    prof = written(profiles(plain, window, gram), "profiles")

    long = prof.where(F.col("n_words") >= window).select("id", "key", "w1", "w2", "n_words")
    whole = long.groupBy("w1", "w2").agg(F.min("id").alias("source"), F.max("id").alias("last")).where("source < last").drop("last")
    copies = written(long.join(written(whole, "copied"), ["w1", "w2"]).where("source < id").select("id", "key", "source").distinct(), "copies")

    anchors = prof.select("id", "key", F.explode("anchors").alias("anchor"))
    shared = anchors.groupBy("anchor").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("anchor")
    listed = anchors.join(written(shared, "anchors"), "anchor").groupBy("id", "key").agg(F.collect_set("anchor").alias("listed"))  # of one document
    listed = listed.join(copies.select("id", "key"), ["id", "key"], "left_anti")
    found = written(candidate_windows(plain.join(listed, ["id", "key"]).select("id", "key", "text", "listed"), window, gram), "windows")

    windows = found.select("id", "key", F.explode(F.arrays_zip("h1", "h2", "place")).alias("w")).select("id", "key", "w.h1", "w.h2", "w.place")
    index = windows.groupBy("h1", "h2").agg(F.min(F.struct("id", "place")).alias("first"), F.max("id").alias("hi")).where("first.id < hi")
    index = written(index.select("h1", "h2", F.col("first.id").alias("source"), F.col("first.place").alias("at")), "index")
    sources = windows.join(index, ["h1", "h2"]).where("source < id").groupBy("id", "key").agg(F.collect_set(F.struct("place", "source", "at")).alias("sources"))  # of one document
    done = parsed(found.select("id", "key", "packed").join(sources, ["id", "key"]), window).dropDuplicates(["id", "key"])

    rows = prof.select("id", "key", "n_words", "digest").join(copies, ["id", "key"], "left").join(done, ["id", "key"], "left")
    copy = F.col("source").isNotNull()
    all_of_it = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words"), F.col("source").alias("source_id"), F.lit(0).cast("long").alias("source_start")))
    return rows.select(
        F.when(F.col("id") != LAST_ID, F.col("id")).alias("doc_id"), "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("left", "digest")).alias("kept_sha256"),
        F.when(copy, all_of_it).otherwise(F.col("factors")).alias("factors"))
