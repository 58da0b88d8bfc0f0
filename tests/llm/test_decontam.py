import hashlib

import pytest

from ledgerlake.llm.decontam import decontaminate
from tests.conftest import SMALL_SF
from tests.llm.cases import docs, empty, words  # noqa: F401


def brute(texts, items):
    grams = {}
    for item, t in items:
        w = words(t)
        for a in range(max(1, len(w) - 12) if w else 0):
            grams.setdefault(tuple(w[a:a + 13]), set()).add(item)
    sizes = {len(g) for g in grams}
    for i, t in texts:
        w = words(t)
        hit, found = set(), set()
        for n in sizes:
            for a in range(len(w) - n + 1):
                own = grams.get(tuple(w[a:a + n]))
                if own:
                    hit |= set(range(a, a + n))
                    found |= own
        found = sorted(str(x) for x in found if x is not None)
        yield i, len(w), len(hit), len(found), hashlib.sha256(",".join(found).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


@pytest.mark.parametrize("block_words", [200_000, 700])
def test_against_brute_force(spark, docs, block_words):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SMALL_SF}/benchmark.parquet").collect()]
    some = docs.where("doc_id IS NOT NULL").select("doc_id", "text").collect()
    items += [(900, None), (901, ""), (902, "One two"), (903, "TWO"), (None, "word " * 13), (902, some[3]["text"] or "x y"), (904, "word " * 40), (904, "word " * 40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = decontaminate(docs.select("doc_id", "text", "lang").withColumnRenamed("lang", "n_hit"), bench, block_words=block_words)
    assert got.columns == ["doc_id", "text", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    expected = sorted(brute([(r["doc_id"], r["text"]) for r in docs.collect()], items), key=str)
    assert sorted((tuple(r) for r in got.drop("text").collect()), key=str) == expected
    assert any(r[-1] for r in expected)


def test_empty_tables(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate(docs, bench).where("contaminated").count() == 0
    assert decontaminate(empty(spark), spark.createDataFrame([(1, "a b")], "item_id long, text string")).count() == 0
