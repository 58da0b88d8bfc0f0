"""Secret scans: a trigram inverted index says which texts a rule's regex has to read.

Each rule's regex is read as a Boolean query over trigrams, an OR of ANDs that every match
must satisfy.  Each piece of the table (about 1 MB of text, or one longer text) gets an
inverted index: for every trigram that some query asks for, the list of texts that hold
it, A-Z lower-cased.  A query intersects and unites these lists, and the regex verifies
the texts that remain.  A rule without a mandatory trigram scans all texts.  The index
lives in the task that reads the piece; nothing is shuffled, and a lost task is redone.

``scan`` adds ``secrets``, the matches of all rules as (kind, start, end) in code points, end
exclusive, by start, then in the order of the rules.  A rule's matches are leftmost and do
not overlap each other; those shorter than its bound are dropped after matching.

Nulls and empty texts have no secrets.  Texts are read whole, however long; the index of a
long text is built in parts.  Every row, repeated ones too, gets its own result; there are
no ties.  An empty table gives an empty result.  An input column ``secrets`` is replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ledgerlake.llm import words as W


def either_case(word: str) -> str:
    """A pattern for the word with each ASCII letter in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() else re.escape(c) for c in word)


@dataclass(frozen=True)
class Rule:
    """What ``pattern`` matches is a secret of this kind if its ``group`` has at least
    ``least`` characters."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


_NAMED = "|".join([*(either_case(w) for w in ("password", "passwd", "secret", "token")), either_case("api") + "_?" + either_case("key")])
#: The base rules.
BASE_RULES = (
    Rule("assign", f"({_NAMED})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]{32,}"),  # the runs [0-9a-f]+ of 32 characters or more
)
#: Formats that services document for their own keys.
MORE_RULES = (
    Rule("private_key", "-----BEGIN (RSA |EC |DSA |OPENSSH |ENCRYPTED |PGP )?PRIVATE KEY( BLOCK)?-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("gitlab", "glpat-[A-Za-z0-9_-]{20,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("npm", "npm_[A-Za-z0-9]{36}"),
    Rule("jwt", "eyJ[A-Za-z0-9_-]{8,1000}\\.eyJ[A-Za-z0-9_-]{8,}\\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", either_case("bearer") + "\\x20+[A-Za-z0-9+/_.=~-]{20,}"),
    Rule("url_login", "://[A-Za-z0-9._~%+-]{1,100}:[A-Za-z0-9._~%!$&*+=-]{1,200}@"),
    Rule("storage_key", either_case("accountkey") + "=[A-Za-z0-9+/]{40,}={0,2}"),
)
RULES = BASE_RULES + MORE_RULES

# ------------------------------------------------------------------ trigram queries

#: A query is a set of clauses; a text satisfies it if it holds all trigrams of one clause.
Query = frozenset[frozenset[int]]
ALWAYS: Query = frozenset([frozenset()])
#: Larger sets of strings and of clauses are given up for weaker conditions.
MOST_STRINGS, MOST_CLAUSES, WIDEST_CLASS = 64, 64, 8


def _least(clauses: Iterable[frozenset[int]]) -> Query:
    """Without clauses that another one implies."""
    kept: list[frozenset[int]] = []
    for c in sorted(set(clauses), key=len):
        if not any(k <= c for k in kept):
            kept.append(c)
    return frozenset(kept)


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > MOST_CLAUSES:
        return min(a, b, key=len)
    return _least(x | y for x in a for y in b)


def _either(parts: Iterable[Query]) -> Query:
    out = _least(c for q in parts for c in q)
    return out if len(out) <= MOST_CLAUSES else ALWAYS


def _fold(c: int) -> str:
    return chr(c + 32) if 65 <= c <= 90 else chr(c)


def trigrams(text: str) -> frozenset[int]:
    b = text.encode()
    return frozenset(b[i] << 16 | b[i + 1] << 8 | b[i + 2] for i in range(len(b) - 2))


def _strings(item) -> set[str] | None:
    """The folded strings that an item of a parsed pattern can match, if they are few."""
    kind, arg = item
    if kind is op.LITERAL:
        return {_fold(arg)}
    if kind in (op.AT, op.ASSERT, op.ASSERT_NOT):
        return {""}
    if kind is op.IN:
        out: set[str] = set()
        for k, v in arg:
            codes = [v] if k is op.LITERAL else range(v[0], v[1] + 1) if k is op.RANGE else None
            if codes is None or len(codes) > 2 * WIDEST_CLASS:
                return None
            out |= {_fold(c) for c in codes}
        return out if len(out) <= WIDEST_CLASS else None
    if kind is op.SUBPATTERN:
        return _product(arg[3])
    if kind is op.ATOMIC_GROUP:
        return _product(arg)
    if kind is op.BRANCH:
        parts = [_product(p) for p in arg[1]]
        return None if None in parts else set().union(*parts)
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
        low, high, body = arg
        one = _product(body)
        if one is None or high is op.MAXREPEAT or high > 4:
            return None
        times: list[set[str]] = [{""}]
        for _ in range(high):
            times.append({a + b for a in times[-1] for b in one})
        return set().union(*times[low:])
    return None


def _product(items) -> set[str] | None:
    out = {""}
    for item in items:
        more = _strings(item)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _of_item(item) -> Query:
    kind, arg = item
    if kind is op.SUBPATTERN:
        return _of_items(arg[3])
    if kind is op.ATOMIC_GROUP:
        return _of_items(arg)
    if kind is op.BRANCH:
        return _either(_of_items(p) for p in arg[1])
    return ALWAYS


_ANYTHING = (op.ANY, None)


def _spelled_out(items) -> Iterator:
    """With the demanded copies of a repetition in its place, followed by anything."""
    for item in items:
        if item[0] in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT) and item[1][0] and _strings(item) is None:
            for _ in range(min(item[1][0], 4)):
                yield from _spelled_out(item[1][2])
            yield _ANYTHING
        else:
            yield item


def _of_items(items) -> Query:
    """All strings that a run of items can be give one clause each; an item with too many
    strings ends the run and adds what must stand inside itself."""
    query, run = ALWAYS, {""}
    for item in _spelled_out(items):
        more = _strings(item)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        query = _both(query, _either([frozenset([trigrams(s)]) for s in run]))
        query, run = _both(query, _of_item(item)), {""}
    return _both(query, _either([frozenset([trigrams(s)]) for s in run]))


def query_of(pattern: str) -> Query:
    """Trigrams that a text must hold to match; ALWAYS if the pattern demands none."""
    return _of_items(_parser.parse(pattern, re.ASCII))


# ------------------------------------------------------------------ inverted index


class Index:
    """Postings of a piece: for each wanted trigram the ascending numbers of the texts that
    hold it.  ``wanted`` is a table over all 2**24 trigrams."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, wanted: np.ndarray, part: int = W.PIECE):
        keys = []
        for at in range(0, max(len(data) - 2, 0), part):
            low = W.LOWER[data[at:at + part + 2]].astype(np.uint32)
            codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:]
            hits = np.flatnonzero(wanted[codes])
            text = np.searchsorted(offsets, hits + at, "right") - 1
            inside = hits + at + 2 < offsets[text + 1]
            keys.append(np.unique(codes[hits[inside]].astype(np.int64) << 32 | text[inside]))
        every = np.unique(np.concatenate(keys)) if keys else np.empty(0, np.int64)
        codes, first = np.unique(every >> 32, return_index=True)
        self.lists = dict(zip(codes.tolist(), np.split(every & 0xFFFFFFFF, first[1:])))

    def texts(self, query: Query) -> np.ndarray:
        """Numbers of the texts that satisfy the query."""
        none = np.empty(0, np.int64)
        found = []
        for clause in query:
            lists = sorted((self.lists.get(t, none) for t in clause), key=len)
            found.append(reduce(lambda a, b: np.intersect1d(a, b, assume_unique=True) if len(a) else a, lists))
        return np.unique(np.concatenate(found)) if found else none


def wanted_by(queries: Iterable[Query]) -> np.ndarray:
    table = np.zeros(1 << 24, bool)
    for query in queries:
        for clause in query:
            table[list(clause)] = True
    return table


FOUND = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_FOUND = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``secrets``."""
    kept = docs.select(*[c for c in docs.columns if c != "secrets"])
    schema = T.StructType([*kept.schema.fields, T.StructField("secrets", FOUND)])
    rules = tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        patterns = [re.compile(r.pattern, re.ASCII) for r in rules]
        queries = [query_of(r.pattern) for r in rules]
        wanted = wanted_by(queries)
        for batch in W.pieces(batches, text):
            data, offsets = W.buffers(batch.column(text))
            index = Index(data, offsets, wanted)
            texts = batch.column(text)
            found: list[list] = [[] for _ in range(batch.num_rows)]
            for rank, (rule, pattern, query) in enumerate(zip(rules, patterns, queries)):
                for i in range(batch.num_rows) if query == ALWAYS else index.texts(query).tolist():
                    found[i] += [(m.start(), rank, m.end()) for m in pattern.finditer(texts[i].as_py() or "") if m.end(rule.group) - m.start(rule.group) >= rule.least]
            rows = [[{"kind": rules[rank].kind, "start": start, "end": end} for start, rank, end in sorted(one)] for one in found]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, _FOUND)], schema.names)

    return kept.mapInArrow(run, schema)
