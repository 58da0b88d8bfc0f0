import hashlib
import random
from collections import defaultdict

from pyspark.sql import functions as F

from ledgerlake.llm import mixing
from tests.llm.cases import SPACED, docs, empty, words  # noqa: F401


def fill(budget, nodes):
    """Shares by repeated proportional rounds: (key, weight, supply) -> {key: share}."""
    share, left, open_ = {k: 0.0 for k, _, _ in nodes}, budget, {k: (w, s) for k, w, s in nodes if w > 0 and s > 0}
    while open_ and left > 1e-9:
        total = sum(w for w, _ in open_.values())
        full = {k for k, (w, s) in open_.items() if s - share[k] <= left * w / total + 1e-12}
        if not full:
            for k, (w, _) in open_.items():
                share[k] += left * w / total
            break
        for k in full:
            left -= open_[k][1] - share[k]
            share[k] = open_.pop(k)[1]
    return share


def test_shares_against_rounds(spark):
    rng = random.Random(5)
    for _ in range(4):
        nodes = [(f"n{k}", float(rng.choice([0, 1, 2, 5])), rng.randrange(0, 100)) for k in range(9)]
        budget = float(rng.randrange(1, 400))
        df = spark.createDataFrame([(0, k, w, s, budget) for k, w, s in nodes], "root int, node string, weight double, supply long, budget double")
        got = {r["node"]: r["share"] for r in mixing.shares(df, ["root"], "node", "share").collect()}
        for k, s in fill(budget, nodes).items():
            assert abs(got.get(k, 0.0) - s) < 1e-6


def brute(rows, domain, budget, weights, max_epochs, seed):
    leaves = defaultdict(list)
    for i, text, lang, source in rows:
        n = len(words(text, SPACED))
        if n:
            leaves[domain(source), lang, source].append((i, text, n))
    weight = lambda level, key: weights.get(level, {}).get(key or "", 1.0)
    supply = {k: sum(n for *_, n in v) * max_epochs if weight("domain", k[0]) > 0 and weight("lang", k[1]) > 0 and weight("source", k[2]) > 0 else 0 for k, v in leaves.items()}
    budget = sum(n for v in leaves.values() for *_, n in v) if budget is None else budget
    top = fill(budget, [(d, weight("domain", d), sum(s for k, s in supply.items() if k[0] == d)) for d in {k[0] for k in leaves}])
    out = []
    for d in top:
        mid = fill(top[d], [(m, weight("lang", m), sum(s for k, s in supply.items() if k[:2] == (d, m))) for m in {k[1] for k in leaves if k[0] == d}])
        for m in mid:
            low = fill(mid[m], [(k, weight("source", k[2]), supply[k]) for k in leaves if k[:2] == (d, m)])
            for k, share in low.items():
                left, epoch = int(share + 1e-6), 0
                total = sum(n for *_, n in leaves[k])
                while left > 0:
                    if left >= total:
                        out += [(i, epoch) for i, *_ in leaves[k]]
                        left, epoch = left - total, epoch + 1
                        continue
                    def place(row):
                        i, t, n = row
                        return hashlib.md5(":".join([seed, str(epoch), "" if i is None else str(i), hashlib.md5(t.encode()).hexdigest()]).encode()).hexdigest()
                    for i, t, n in sorted(leaves[k], key=place):
                        left -= n
                        if left < 0:
                            break
                        out.append((i, epoch))
                    break
    return sorted(out, key=str)


def test_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in docs.collect()]
    domain = F.when(F.col("source").isin("src0", "src1", "src2"), F.lit("low")).otherwise(F.lit("high"))
    plain = lambda s: "low" if s in ("src0", "src1", "src2") else "high"
    for budget, weights in ((None, {}), (30_000.0, {"domain": {"low": 1, "high": 9}, "lang": {"en": 3, "fr": 0}, "source": {"src3": 5}}), (10.0, {}), (1e9, {"domain": {"low": 0}})):
        got = mixing.mix(docs.withColumn("epoch", F.lit("clash")), domain, budget, weights, 3, "s").select("doc_id", "epoch").collect()
        assert sorted((tuple(r) for r in got), key=str) == brute(rows, plain, budget, weights, 3, "s")


def test_a_short_leaf_gives_to_its_siblings_first(spark):
    rows = [(k, "w " * 10, lang, source) for k, (lang, source) in enumerate([("en", "a")] * 1 + [("en", "b")] * 40 + [("de", "c")] * 40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = mixing.mix(df, F.lit("d"), 400.0, {}, 1).groupBy("lang", "source").agg(F.sum("tokens").alias("t")).collect()
    assert {(r["lang"], r["source"]): r["t"] for r in got} == {("en", "a"): 10, ("en", "b"): 190, ("de", "c"): 200}


def test_no_budget_is_lost_on_equal_ids_and_lengths(spark):
    """Texts of one length without ids, one repeated id, and copies of one row."""
    rows = [(None, f"{k:04d} b c d", "x") for k in range(300)] + [(7, f"{k:04d} b c d", "y") for k in range(300)] + [(9, "e f g h", "z")] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, extra string").selectExpr("*", "'en' AS lang", "extra AS source").repartition(4)
    got = mixing.mix(df, F.lit("d"), 1801.0, {}, 1)
    taken = {r["source"]: r["t"] for r in got.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}
    assert all(600 - 4 < t <= 600 for t in taken.values()) and len(taken) == 3
    assert got.where("source <> 'z'").select("source", "text").distinct().count() == 300


def test_empty_table(spark):
    assert mixing.mix(empty(spark), F.lit("d")).count() == 0
