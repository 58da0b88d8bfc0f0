"""Word spans and word hashes of many texts at once, with numpy.

The functions work on an Arrow string column as Spark hands it to ``mapInArrow``: one
byte buffer and the offsets of the texts in it.  Both word definitions only separate
at ASCII bytes, and every byte of a longer UTF-8 character is 0x80 or more, so words
can be found in the bytes without decoding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
#: Texts are hashed in pieces of about this many bytes: it bounds the memory of a task.
PIECE = 1 << 20
_BASE = U(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)

_BYTES = np.arange(256, dtype=np.uint8)
LOWER = _BYTES.copy()
LOWER[65:91] += 32
#: [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
ALNUM = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122))
#: [^\x20\x09-\x0D]+
SPACED = ~((_BYTES == 32) | ((_BYTES >= 9) & (_BYTES <= 13)))
_ALNUM_ANY_CASE = ALNUM[LOWER]


def _inverse(odd: int) -> int:
    return pow(odd, -1, 1 << 64)


_POWERS = np.ones(1, U)
_INVERSES = np.ones(1, U)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """_BASE ** i and _BASE ** -i modulo 2**64 for i below n."""
    global _POWERS, _INVERSES
    if len(_POWERS) < n:
        _POWERS = np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, _BASE, U)]), dtype=U)
        _INVERSES = np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, U(_inverse(int(_BASE))), U)]), dtype=U)
    return _POWERS, _INVERSES


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: spreads every bit over the whole word."""
    x = (x ^ (x >> U(30))) * _MIX1
    x = (x ^ (x >> U(27))) * _MIX2
    return x ^ (x >> U(31))


class Words:
    """Words of consecutive texts: ``start`` and ``end`` byte positions in ``data``, and
    ``first[i]:first[i + 1]`` the words of text i."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, kind: str, inside: np.ndarray | None = None, lower: bool | None = None):
        """``inside`` and ``lower`` override the kind's bytes of words and lower-casing."""
        self.data, self.offsets, self.lower = data, offsets, kind == "alnum" if lower is None else lower
        inside = (inside if inside is not None else _ALNUM_ANY_CASE if self.lower else SPACED)[data]
        n = len(data)
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            heads = offsets[:-1][offsets[:-1] < n]
            begins[heads] = inside[heads]
            tails = offsets[1:][offsets[1:] > 0] - 1
            ends[tails] = inside[tails]
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.start, offsets)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes (A-Z lower-cased for "alnum")."""
        out = np.empty(len(self.start), U)
        i = 0
        while i < len(self.start):
            lo = self.start[i]
            j = max(i + 1, int(np.searchsorted(self.end, lo + PIECE)))
            part = self.data[lo:self.end[j - 1]]
            part = LOWER[part] if self.lower else part
            power, inverse = _powers(len(part) + 1)
            total = np.zeros(len(part) + 1, U)
            np.cumsum((part.astype(U) + U(1)) * power[:len(part)], out=total[1:])
            s, e = self.start[i:j] - lo, self.end[i:j] - lo
            out[i:j] = (total[e] - total[s]) * inverse[s]
            i = j
        return mix(out)


def grams(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` hashes that begin at each position; the last ``size - 1``
    positions have none.  Order matters: position j is scaled by its own odd number."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, U)
    total = np.zeros(n, U)
    scale = 1
    for j in range(size):
        scale = scale * int(_BASE) % (1 << 64)
        total += hashes[j:j + n] * U(scale)
    return mix(total)


def shingles(words: Words, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of all texts and the index of the text each belongs to.  A text of
    fewer words, but not none, has one shingle of all its words."""
    counts = words.counts()
    which = np.repeat(np.arange(len(counts)), counts)
    all_grams = grams(hashes, size)
    inside = which[:len(all_grams)] == which[size - 1:] if len(all_grams) else np.empty(0, bool)
    values, owner = all_grams[inside], which[:len(all_grams)][inside]
    short = np.flatnonzero((counts > 0) & (counts < size))
    if len(short):
        extra = np.array([whole(hashes[words.first[i]:words.first[i + 1]]) for i in short], U)
        values, owner = np.concatenate([values, extra]), np.concatenate([owner, short])
    return values, owner


def whole(hashes: np.ndarray) -> np.uint64:
    """One hash for a whole sequence of word hashes."""
    return grams(hashes, len(hashes))[0] if len(hashes) else U(0)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column and the offsets of its texts in them; a null is empty."""
    if pa.types.is_string(texts.type) or pa.types.is_binary(texts.type):
        texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null("" if pa.types.is_large_string(texts.type) else b"")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1] if offsets else np.zeros(1, np.int64)
    lo, hi = int(offsets[0]), int(offsets[-1])
    raw = np.frombuffer(data, np.uint8)[lo:hi] if data is not None and hi > lo else np.empty(0, np.uint8)
    return raw, offsets - lo


def of_texts(texts: pa.Array, kind: str) -> Words:
    """Words of an Arrow string column; a null has none."""
    return Words(*buffers(texts), kind)


def pieces(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = PIECE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0)).astype(np.int64)
        group = np.cumsum(sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)


def rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Like ``grams`` at a cost that does not depend on the size (other hash values)."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, U)
    power, inverse = _powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * power[:len(hashes)], out=total[1:])
    return mix((total[size:] - total[:n]) * inverse[:n])


def sliding_min(values: np.ndarray, size: int) -> np.ndarray:
    """Smallest of each ``size`` consecutive values, by minima from both ends of blocks."""
    n = len(values) - size + 1
    if n <= 0:
        return np.empty(0, values.dtype)
    blocks = -(-len(values) // size)
    padded = np.full(blocks * size, np.iinfo(values.dtype).max, values.dtype)
    padded[:len(values)] = values
    grid = padded.reshape(blocks, size)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[size - 1:size - 1 + n])
