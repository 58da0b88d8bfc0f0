import hashlib

import numpy as np
import pyarrow as pa
import pytest

from ledgerlake.llm import fingerprint as fp
from tests.llm.cases import docs, edge_rows, empty, words  # noqa: F401


def jaccard(a, b):
    sets = []
    for t in (a, b):
        w = words(t)
        sets.append({tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1]) if sets[0] | sets[1] else 1.0


def test_edited_neighbours_against_brute_force(spark, docs):
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    got = fp.edited_neighbours(docs, outer=4, target_rows=8).collect()
    assert len(got) == len(rows)
    unique = {i for i, _ in rows if i is not None and [j for j, _ in rows].count(i) == 1}
    order = sorted((r for r in rows if r[0] is not None), key=lambda r: -r[0])
    following = {a[0]: b[1] for a, b in zip(order, order[1:]) if a[0] in unique and b[0] in unique}
    text, by = dict(r for r in rows if r[0] in unique), {r["doc_id"]: r for r in got}
    errors = []
    for i, after in following.items():
        t, r = text[i], by[i]
        edited = t[:len(t) - len(t) // 2] + after[:len(t) // 2]
        assert r["n_chars"] == len(t)
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        errors += [abs(r["near_edited"] - jaccard(t, edited)), abs(r["near_next"] - jaccard(t, after))]
    assert len(following) > 200 and np.mean(errors) < 0.02 and max(errors) < 0.2
    last = min(unique)
    assert by[last]["n_chars"] == len(text[last])
    same = {}
    for r in got:
        if r["doc_id"] in unique:
            same.setdefault(text[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(v) == 1 for v in same.values())


def test_last_document_is_followed_by_the_first(spark):
    df = spark.createDataFrame([(i, t) for i, t in ((5, "fünf " * 9), (3, "three " * 8), (9, "nine " * 7))], "doc_id long, text string")
    got = {r["doc_id"]: r["edited_sha256"] for r in fp.edited_neighbours(df).collect()}
    t, first = "three " * 8, "nine " * 7
    assert got[3] == hashlib.sha256((t[:len(t) - len(t) // 2] + first[:len(t) // 2]).encode()).hexdigest()


def test_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(1, "only one text here now", 5)], "doc_id long, text string, cell int")
    r = fp.edited_neighbours(one).first()
    assert r["near_next"] == 1.0
    assert fp.edited_neighbours(empty(spark)).count() == 0


def test_estimate_is_unbiased_and_densified_bins_agree():
    rng = np.random.default_rng(1)
    for share in (0.0, 0.2, 0.5, 0.8, 1.0):
        n = 2000
        both = [f"w{x}" for x in rng.integers(0, 1 << 40, int(n * share * 2 / (1 + share)))]
        a = both + [f"a{x}" for x in rng.integers(0, 1 << 40, n - len(both))]
        b = both + [f"b{x}" for x in rng.integers(0, 1 << 40, n - len(both))]
        low, some = fp.sketches(pa.array([" ".join(a), " ".join(b)]), size=1)
        assert fp.likeness(low[:1], low[1:], some[:1], some[1:])[0] == pytest.approx(len(set(a) & set(b)) / len(set(a) | set(b)), abs=0.08)
    low, some = fp.sketches(pa.array(["two words", "TWO  words!", "", None, "?"]))
    assert (low[0] == low[1]).all() and some.tolist() == [True, True, False, False, False]
    assert fp.packed(low, some)[2:] == ["", "", ""] and len(fp.packed(low, some)[0]) == fp.BINS * fp.BITS // 4


def test_fingerprints_keep_other_columns(spark):
    df = spark.createDataFrame([(1, "a b c", "x"), (2, None, "y")], "doc_id long, text string, fingerprint string")
    got = fp.fingerprints(df).orderBy("doc_id").collect()
    assert got[0]["fingerprint"] not in ("x", "") and got[1]["fingerprint"] == ""
