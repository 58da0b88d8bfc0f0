"""Benchmark decontamination by a prefix-filtered set join.

Every window of ``WINDOW`` consecutive item words (a shorter item is one window) is a
sequence of shingles.  Containment of a window means that all its shingles occur, so
one shingle is a sufficient prefix: the rarest one in the corpus.  Documents are joined
with the windows on that shingle alone; a candidate must then have room for the whole
window before and behind the shingle's place (positional and length bounds) and is
verified word by word.

Rarity is counted over all documents.  The items are the bounded side: they are read
in blocks of at most ``BLOCK_WORDS`` words, each broadcast to one pass over the
documents, so a benchmark of any size is compared whole.

Nulls and texts without words have no words and no hits.  Repeated items, and rows of
one item_id, count as one item in ``n_items``; a null item_id is left out of the list
of items but its words are still hit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import words as W
from ledgerlake.llm.tables import written

WINDOW, SHINGLE, BLOCK_WORDS = 13, 4, 200_000
U = W.U
OUT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
])


class Lookup:
    """Places of hashes in a sorted array of distinct keys, -1 where there is none.  A
    table of the keys' top bits settles most hashes at once."""

    def __init__(self, keys: np.ndarray, bits: int = 22):
        self.keys, self.shift = np.unique(keys.astype(U)), U(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.keys >> self.shift).astype(np.int64)] = True

    def places(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``hashes`` that are keys, and which keys they are."""
        at = np.flatnonzero(self.table[(hashes >> self.shift).astype(np.int64)])
        key = np.searchsorted(self.keys, hashes[at])
        good = key < len(self.keys)
        good[good] = self.keys[key[good]] == hashes[at][good]
        return at[good], key[good]


def windows_of(items: list[tuple], window: int) -> list[tuple[object, np.ndarray]]:
    """Distinct (item_id, word hashes) of all windows of the items."""
    words = W.of_texts(pa.array([t for _, t in items], pa.large_string()), "alnum")
    hashes, out = words.hashes(), {}
    for i, (item, _) in enumerate(items):
        own = hashes[words.first[i]:words.first[i + 1]]
        for a in range(max(1, len(own) - window + 1) if len(own) else 0):
            part = own[a:a + window]
            out.setdefault((item, part.tobytes()), (item, part))
    return list(out.values())


def _shingles(part: np.ndarray) -> np.ndarray:
    return W.grams(part, min(SHINGLE, len(part)))


def _counted(docs: DataFrame, sizes_keys: dict[int, np.ndarray]) -> dict[tuple[int, int], int]:
    """How often each of the given shingles occurs in all documents."""
    sent = docs.sparkSession.sparkContext.broadcast(sizes_keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looks = {s: Lookup(k) for s, k in sent.value.items()}
        counts = {s: np.zeros(len(look.keys), np.int64) for s, look in looks.items()}
        for batch in W.pieces(batches):
            hashes = W.of_texts(batch.column("text"), "alnum").hashes()
            for s, look in looks.items():
                _, key = look.places(W.grams(hashes, s))
                counts[s] += np.bincount(key, minlength=len(look.keys))
        for s, n in counts.items():
            some = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), s, np.int64)), pa.array(some.astype(np.int64)), pa.array(n[some])], ["size", "key", "n"])

    found = docs.select("text").mapInArrow(run, "size long, key long, n long").groupBy("size", "key").agg(F.sum("n").alias("n"))
    return {(r["size"], r["key"]): r["n"] for r in found.collect()}  # at most one row per shingle of the block


def _index(docs: DataFrame, items: list[tuple], window: int) -> dict:
    """The block's windows by the shingle each must contain, rarest in the corpus first."""
    parts = windows_of(items, window)
    by_size: dict[int, set] = {}
    for _, part in parts:
        by_size.setdefault(min(SHINGLE, len(part)), set()).update(_shingles(part).tolist())
    keys = {s: np.unique(np.array(sorted(k), U)) for s, k in by_size.items()}
    seen = _counted(docs, keys) if keys else {}
    index: dict[int, dict] = {}
    for item, part in parts:
        s = min(SHINGLE, len(part))
        own = _shingles(part)
        place = np.searchsorted(keys[s], own)
        rarest = min(range(len(own)), key=lambda j: (seen.get((s, int(place[j])), 0), int(own[j])))
        index.setdefault(s, {}).setdefault(int(own[rarest]), []).append((rarest, part, item))
    return index


def _hits(texts: pa.Array, index: dict, looks: dict) -> Iterator[tuple[int, np.ndarray, set]]:
    """Number of words, hit words and items of each text of the batch."""
    words = W.of_texts(texts, "alnum")
    hashes = words.hashes()
    hit, items = np.zeros(len(hashes) + 1, np.int64), [set() for _ in range(len(texts))]
    for s, look in looks.items():
        at, key = look.places(W.grams(hashes, s))
        doc = np.searchsorted(words.first, at, side="right") - 1
        for p, k, d in zip(at.tolist(), key.tolist(), doc.tolist()):
            for before, part, item in index[s][int(look.keys[k])]:
                a, b = p - before, p - before + len(part)
                if a >= words.first[d] and b <= words.first[d + 1] and np.array_equal(hashes[a:b], part):
                    hit[a] += 1
                    hit[b] -= 1
                    items[d].add(item)
    covered = np.cumsum(hit)[:-1] > 0
    for i in range(len(texts)):
        yield int(words.first[i + 1] - words.first[i]), covered[words.first[i]:words.first[i + 1]], items[i]


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, text: str = "text",
                  block_words: int = BLOCK_WORDS, share: int = 20) -> DataFrame:
    """All columns of ``docs`` with n_words, n_hit, n_items, items_sha256 and contaminated
    (n_hit > 0 and share * n_hit >= n_words); input columns of these names are replaced."""
    added = [f.name for f in OUT.fields]
    state = docs.select(*[c for c in docs.columns if c not in added and c not in ("_hit", "_items")])
    keep = state.columns
    plain = docs.select(F.col(text).cast("string").alias("text"))
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (2 * block_words)))  # a word and its space are two characters at least
    block_no = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks))
    for n in range(blocks):
        block = [(r["item_id"], r["text"]) for r in items.where(block_no == n).distinct().collect()]
        state = _one_pass(state, keep, text, _index(plain, block, window), n == blocks - 1, share)
        if n < blocks - 1:
            state = written(state, "decontaminate")
    return state


def _one_pass(state: DataFrame, keep: list[str], text: str, index: dict, last: bool, share: int) -> DataFrame:
    """Compare all documents with one block of items; the last pass adds the results."""
    sent = state.sparkSession.sparkContext.broadcast(index)
    before = "_hit" in state.columns
    fields = [f for f in state.schema.fields if f.name in keep]
    schema = T.StructType([*fields, *(OUT.fields if last else [T.StructField("_hit", T.ArrayType(T.LongType())), T.StructField("_items", T.ArrayType(T.StringType()))])])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        looks = {s: Lookup(np.array(list(k), U)) for s, k in sent.value.items()}
        for batch in W.pieces(batches, text):
            rows = []
            for i, (words, hit, found) in enumerate(_hits(batch.column(text), sent.value, looks)):
                places = set(np.flatnonzero(hit).tolist())
                if before:
                    places |= set(batch.column("_hit")[i].as_py())
                    found |= set(batch.column("_items")[i].as_py())
                rows.append((words, places, sorted(found - {None})))
            if last:
                more = [pa.array([w for w, _, _ in rows], pa.int64()), pa.array([len(p) for _, p, _ in rows], pa.int64()),
                        pa.array([len(f) for _, _, f in rows], pa.int64()),
                        pa.array([hashlib.sha256(",".join(f).encode()).hexdigest() for _, _, f in rows], pa.string()),
                        pa.array([len(p) > 0 and share * len(p) >= w for w, p, _ in rows], pa.bool_())]
            else:
                more = [pa.array([sorted(p) for _, p, _ in rows], pa.list_(pa.int64())), pa.array([f for _, _, f in rows], pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), *more], schema.names)

    return state.mapInArrow(run, schema)
