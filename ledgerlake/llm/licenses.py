"""Licence scans: an Aho-Corasick automaton finds identifier tags and notice phrases, a
shunting-yard parser evaluates the tags' and/or/with expressions.

Phrases are looked up in the text's words (letters, digits and non-ASCII characters,
A-Z lower-cased) joined by single spaces, so punctuation and line breaks between their
words do not matter and all places are found, overlapping ones too.  A tag is the text
"SPDX-License-Identifier:" and the rest of its line.

``score`` says how freely the text may be used: each licence has a value, OR (also written
as a slash between two identifiers) takes the larger, AND the smaller, WITH (an exception
that grants more) adds a tenth; notices and tags of one text all hold, so the smallest
counts.  A phrase inside a longer one that was found ("general public license" in "lesser
general public license") keeps its label but has no say in the score.  A text without any
is 1.0.

Null counts as an empty text: no words, no labels, null first and last word, score 1.0.
Whole texts are read, a very long one in one piece.  Repeated rows are each scanned; an
empty table gives an empty result; input columns named like results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import words as W

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "mit license": "mit",
    "licensed under the apache license": "apache",
    "apache license version 2 0": "apache",
    "redistribution and use in source and binary forms": "bsd",
    "permission to use copy modify and or distribute this software": "isc",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nc": "cc-by-nc",
    "cc0 1 0 universal": "cc0",
    "released into the public domain": "public-domain",
    "dedicated to the public domain": "public-domain",
    "proprietary and confidential": "proprietary",
    "do not redistribute": "proprietary",
}
#: How freely text under a licence may be used; the longest prefix of an identifier counts.
FREEDOM = {
    "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "0bsd": 1.0, "mit": 0.95, "bsd": 0.95, "isc": 0.95, "zlib": 0.95, "apache": 0.9,
    "cc-by": 0.85, "mpl": 0.7, "epl": 0.7, "lgpl": 0.6, "cc-by-sa": 0.6, "gpl": 0.4, "agpl": 0.3, "cc-by-nc": 0.2, "cc-by-nd": 0.2,
    "reserved": 0.1, "proprietary": 0.0,
}
UNKNOWN = 0.5
#: The automaton finds a tag's words, which tells what texts to search for whole tags.
TAG_WORDS = "spdx license identifier"
_TAG = re.compile(r"spdx-license-identifier:", re.ASCII | re.IGNORECASE)
ADDED = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
_TOKEN = re.compile(r"[()]|(?<=[A-Za-z0-9.+-])/(?=[A-Za-z0-9])|[A-Za-z0-9.+-]+(?::[A-Za-z0-9.+-]+)?")
_RANK = {"or": 1, "and": 2, "with": 3}


def postfix(expression: str) -> list[str] | None:
    """The expression's tokens in postfix order (with before and before or), None where
    it is not well formed; words after a complete expression are not part of it."""
    out, stack, operand = [], [], False
    for token in _TOKEN.findall(expression):
        low = "or" if token == "/" else token.lower()
        if low in _RANK:
            if not operand:
                return None
            while stack and stack[-1] != "(" and _RANK[stack[-1]] >= _RANK[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = False
        elif low == "(":
            if operand:
                break
            if stack and stack[-1] == "with":
                return None  # an exception is a name
            stack.append(low)
        elif low == ")":
            if not operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            if operand:
                break
            out.append(low)
            operand = True
    while stack:
        if stack[-1] == "(":
            return None
        out.append(stack.pop())
    return out if operand else None


def freedom(label: str) -> float:
    while label:
        if label in FREEDOM:
            return FREEDOM[label]
        label = label.rpartition("-")[0]
    return UNKNOWN


def evaluate(tokens: list[str]) -> tuple[float, set[str]]:
    """Freedom of a postfix expression and the identifiers it names."""
    stack: list[tuple[float, set[str]]] = []
    for token in tokens:
        if token not in _RANK:
            stack.append((freedom(token.removeprefix("licenseref-").rstrip("+")), {token}))
            continue
        (b, right), (a, left) = stack.pop(), stack.pop()
        if token == "with":
            stack.append((min(1.0, a + 0.1), left | {f"{x}-with-{y}" for x in left for y in right}))
        else:
            stack.append(((max if token == "or" else min)(a, b), left | right))
    return stack[0]


def automaton(base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> ahocorasick.Automaton:
    found: dict[str, list] = {}
    for phrase, label in base.items():
        found.setdefault(f" {phrase} ", []).append((True, label))
    for phrase, label in notices.items():
        found.setdefault(f" {phrase} ", []).append((False, label))
    found.setdefault(f" {TAG_WORDS} ", [])
    auto = ahocorasick.Automaton()
    for phrase, what in found.items():
        auto.add_word(phrase, (len(phrase), what))
    auto.make_automaton()
    return auto


def joined(words: W.Words) -> Iterator[str]:
    """The words of each text joined by single spaces, with a space at either end."""
    inside = W._ALNUM_ANY_CASE[words.data]
    plain = np.where(inside, W.LOWER[words.data], 32).astype(np.uint8)
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    for a, b in zip(words.offsets, words.offsets[1:]):
        k = keep[a:b].copy()
        if len(k) and not inside[a]:
            k[0] = False  # the space after the last word of the text before
        text = plain[a:b][k].tobytes().decode("utf-8", "surrogatepass")
        yield f" {text.rstrip(' ')} " if text else " "


def decisive(hits: list[tuple]) -> set[tuple[int, int]]:
    """Places (end, size) of the phrases that lie inside no longer one that was found."""
    out, reach = set(), -1
    for start, end in sorted(((end - size + 1, end) for end, (size, _) in hits), key=lambda p: (p[0], -p[1])):
        if end > reach:
            out.add((end, end - start + 1))
            reach = end
    return out


def tags(text: str) -> Iterator[str]:
    """What follows each identifier tag on its line."""
    for found in _TAG.finditer(text):
        end = text.find("\n", found.end())
        yield text[found.end():end if end >= 0 else len(text)]


def scan(docs: DataFrame, text: str = "text", base: dict[str, str] = BASE, notices: dict[str, str] = NOTICES) -> DataFrame:
    """All columns of ``docs`` with those of ADDED; input columns of these names are replaced."""
    kept = docs.select(*[c for c in docs.columns if c not in ADDED])
    schema = T.StructType([*kept.schema.fields, *(T.StructField(n, T.LongType()) for n in ADDED[:4]), *(T.StructField(n, T.StringType()) for n in ADDED[4:6]), T.StructField("score", T.DoubleType())])

    def row(n_words: int, line: str, raw: str, auto: ahocorasick.Automaton) -> tuple:
        starts, own, labels, score = [], set(), set(), 1.0
        hits = list(auto.iter(line))
        if hits:
            spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32) == 32)
            deciding = decisive(hits)
            for end, (size, what) in hits:
                word = int(np.searchsorted(spaces, end - size + 1))
                for is_base, label in what:
                    labels.add(label)
                    if (end, size) in deciding:
                        score = min(score, freedom(label))
                    if is_base:
                        own.add(label)
                        starts.append(word)
        for expression in tags(raw) if any(not what for _, (_, what) in hits) else ():
            tokens = postfix(expression)
            if tokens:
                value, names = evaluate(tokens)
                score = min(score, value)
                labels |= {f"spdx:{x}" for x in names}
        return n_words, len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(own)), ",".join(sorted(labels)), score

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton(base, notices)
        for batch in W.pieces(batches, text):
            words = W.of_texts(batch.column(text), "alnum")
            rows = [row(int(n), line, raw or "", auto) for n, line, raw in zip(words.counts(), joined(words), batch.column(text).to_pylist())]
            more = [pa.array(v, schema[n].dataType.typeName() == "long" and pa.int64() or (pa.float64() if n == "score" else pa.string())) for n, v in zip(ADDED, zip(*rows))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], schema.names)

    return kept.mapInArrow(run, schema)
