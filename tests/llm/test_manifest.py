import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import manifest as M
from tests.llm.cases import DOCS, docs, empty  # noqa: F401


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


class Tree:
    def __init__(self, nodes):
        self.levels = [list(nodes)]
        while len(self.levels[-1]) > 1:
            last = self.levels[-1]
            self.levels.append([H(*last[i:i + 3]) for i in range(0, len(last), 3)])
        self.root = self.levels[-1][0]

    def path(self, i):
        for level in self.levels[:-1]:
            a = i - i % 3
            yield level[a:i], level[i + 1:a + 3]
            i //= 3


def brute(rows, tamper):
    """rows: (doc_id, source, lang, n_chars, text)."""
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = Tree([leaf(r) for r in by[s]])
    top = Tree([trees[s].root for s in sources])
    for k, s in enumerate(sources):
        for i, r in enumerate(by[s]):
            path = [*trees[s].path(i), *top.path(k)]
            node = leaf((*r[:4], tamper(r)))
            for a, b in path:
                node = H(*a, node, *b)
            yield r[0], leaf(r), trees[s].root, top.root, H(*(x for a, b in path for x in [*a, *b])), node, node == top.root


def fields(df):
    return [(r["doc_id"], r["source"], r["lang"], r["n_chars"], r["text"]) for r in df.collect()]


def cut(r):
    return r[4] and (r[4].replace("\n", "") if r[0] is not None and r[0] % 2 == 0 else r[4])


def tampered():
    return F.when(F.col("doc_id") % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))


@pytest.mark.parametrize("levels", [2, 6])
def test_against_brute_force(spark, docs, levels):
    df = docs.select("doc_id", "text", "lang", "source", "n_chars", F.lit("x").alias("leaf"), F.lit(1).alias("block"), F.lit(2).alias("rank"))
    rows = fields(df)
    got = [tuple(r) for r in M.manifest(df, tampered(), levels).collect()]
    assert sorted(got, key=str) == sorted(brute(rows, cut), key=str)
    assert 0 < sum(r[-1] for r in got) < len(got)


@pytest.mark.parametrize("sizes", [[1], [4], [28], [82, 1, 5, 2], [30, 3, 3, 3, 3, 3, 3, 3, 3, 1]])
def test_shapes(spark, sizes):
    """Sources of few and many blocks, groups with one and two missing members."""
    rows = [(100 * s + i, f"a\n{i}", None, f"s{s}", i) for s, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, DOCS).repartition(3)
    assert sorted((tuple(r) for r in M.manifest(df, tampered(), 1).collect()), key=str) == sorted(brute(fields(df), cut), key=str)


def test_untampered_and_repeated_rows(spark):
    rows = [(None, None, None, None, None)] * 7 + [(5, "", "en", "s", 0)] * 5 + [(5, "é𝒳", "en", "s", 2), (-3, "x", "de", "", 1)]
    df = spark.createDataFrame(rows, DOCS)
    got = M.manifest(df, block_levels=1).collect()
    assert all(r["verified"] for r in got)
    assert sorted(map(tuple, got), key=str) == sorted(brute(fields(df), lambda r: r[4]), key=str)


def test_empty_table(spark):
    out = M.manifest(empty(spark))
    assert out.count() == 0 and out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
