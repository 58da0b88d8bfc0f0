"""Small tables with nulls, empty and long texts, ties, repeated rows and clashing columns."""

import random
import re

import pytest

from tests.conftest import SMALL_SF

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def words(text, pattern=ALNUM):
    return pattern.findall((text or "").translate(LOWER) if pattern is ALNUM else text or "")


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(["Alpha", "beta,", "gamma", "délta", "x1", "Öl", "the", "of", "eta.", "theta\n", "iota", "kappa", "lambda", "mü"]) + str(rng.randrange(60)) for _ in range(n))


def edge_rows():
    base = prose(1, 400)
    near = base.split(" ")
    near[200] = "changed"
    passage = prose(2, 70)
    rows = [
        (1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, "   \n\t "), (7, "!!! ??? ---"), (8, "one two"), (9, "One, TWO"),
        (10, "word " * 300), (11, "word " * 120), (12, prose(3, 60) + " " + passage + " " + prose(4, 60)), (13, prose(5, 30) + " " + passage + " tail"),
        (14, passage), (15, prose(6, 20_000)), (16, "tie"), (16, "tie"), (16, "another with the same id"), (None, base), (None, "no id here"), (17, "a\x00b 　 İstanbul ẞ ǆ 𝒳 mixed"),
        (18, prose(7, 49)), (19, prose(7, 49) + " end"), (20, prose(7, 49) + " end more"),
    ]
    return [(i, t, "en" if k % 3 else None, f"src{k % 5}" if k % 7 else None, None if t is None else len(t)) for k, (i, t) in enumerate(rows)]


@pytest.fixture(scope="module")
def docs(spark):
    small = [tuple(r) for r in spark.read.parquet(f"{SMALL_SF}/documents.parquet").orderBy("doc_id").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    return spark.createDataFrame(edge_rows() + [(r[0] + 100, *r[1:]) for r in small], DOCS).repartition(5)


def empty(spark):
    return spark.createDataFrame([], DOCS)
