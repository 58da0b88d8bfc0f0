import collections
import random
import re

import pytest

from ledgerlake.llm.collocations import CHUNK, collocations, phrase_counts, room_for, windows
from tests.llm.cases import DOCS, LOWER, docs, empty  # noqa: F401


def counts(rows, longest=5):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    return f, n


def brute(rows, least, top):
    f, n = counts(rows)
    found = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    kept = collections.defaultdict(list)
    for (lang, w), a in found.items():
        inside = [b for (other, v), b in found.items() if other == lang and len(v) > len(w) and b >= a and any(v[i:i + len(w)] == w for i in range(len(v) - len(w) + 1))]
        if not inside:
            score, k = min((1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w)))
            kept[lang].append((-score, -a, " ".join(w).encode(), " ".join(w), f[lang, w[:k]], f[lang, w[k:]]))
    for lang, rows in kept.items():
        for rank, (score, a, _, phrase, l, r) in enumerate(sorted(rows)[:top], 1):
            yield lang, rank, phrase, -a, l, r, n[lang], -score


SOME = ["of the of the of the", "a b c d e f", "A\tB  c,d e f", "x.x.x x x x x x x", "é 𝒳 ẞ é 𝒳 ẞ", "", None, "!!!", "one", "a b\x0bc d\x0ce f\rx x", "z\x00 z\x00 z\x00", "a b a b c", "the end " * 3000]


@pytest.fixture(scope="module")
def texts(spark, docs):
    rng = random.Random(5)
    rows = [(i, SOME[i % len(SOME)], rng.choice(["en", "de", None, "und", ""]), "s", 1) for i in range(60)]
    return docs.union(spark.createDataFrame(rows, DOCS))


@pytest.mark.parametrize("least, top, cells", [(4, 2000, 1 << 20), (12, 9, 1 << 14), (100, 2000, 1 << 17)])
def test_against_brute_force(spark, texts, least, top, cells):
    """The smallest table has far fewer counters than n-grams: nothing is cut, and all is right."""
    df = texts.selectExpr("doc_id", "text", "lang", "1 AS w1", "'x' AS phrase", "2 AS f", "3 AS rank")
    rows = [(r["text"], r["lang"]) for r in texts.collect()]
    got = [tuple(r) for r in collocations(df, least=least, top=top, cells=cells).collect()]
    assert sorted(got) == sorted(brute(rows, least, top)) and got


def test_counts(spark, texts):
    f, n = counts([(r["text"], r["lang"]) for r in texts.collect()])
    got = {(r["lang"], r["words"], r["phrase"]): r["f"] for r in phrase_counts(texts, least=3, cells=1 << 18).collect()}
    expected = {(lang, len(w), " ".join(w)): c for (lang, w), c in f.items() if c >= 3} | {(lang, 0, ""): c for lang, c in n.items() if c}
    assert got == expected


def test_empty_tables(spark):
    assert collocations(empty(spark)).count() == 0
    assert collocations(spark.createDataFrame([(1, None, None, None, None), (2, " ,. ", "en", None, 3)], DOCS), least=1).count() == 0


def uniform(spark, words=300, rows=400, length=250):
    """Texts of words drawn at random: hardly a pair is frequent, and no longer phrase."""
    rng = random.Random(8)
    texts = [" ".join(f"w{rng.randrange(words)}" for _ in range(length)) for _ in range(rows)]
    return texts, spark.createDataFrame([(x, "en") for x in texts], "text string, lang string")


def test_rare_windows_are_cut_with_few_counters(spark):
    """Counted all together, 500,000 n-grams fill 2 ** 14 counters beyond 20 each: 86,143 windows were made."""
    texts, df = uniform(spark)
    made = windows(df.coalesce(1), 5, 20, 1 << 14).select("w2", "w3").collect()
    f, _ = counts([(x, "en") for x in texts])
    assert not [k for k, a in f.items() if len(k[1]) > 1 and a >= 20]
    assert len(made) < 5000 and not [r for r in made if r["w3"] is not None]


def test_windows_do_not_grow_with_the_splits(spark):
    _, df = uniform(spark, words=50)
    cores = spark.sparkContext.defaultParallelism
    made = windows(df.repartition(8 * cores), 5, 20, 1 << 18)
    rows = made.count()
    distinct = made.drop("times").distinct().count()
    assert made.rdd.getNumPartitions() <= cores and distinct > 50 and rows <= cores * distinct
    assert made.agg({"times": "sum"}).first()[0] == 400 * 250


def test_counters_grow_with_the_texts(spark):
    row = spark.createDataFrame([("x" * 100_000, "en"), (None, "en")], "text string, lang string")
    many = row.crossJoin(spark.range(400))
    assert [room_for(x) for x in (row.limit(0), row, many)] == [CHUNK, CHUNK, 1 << 19]
