"""Quality classifier by compression.

Two zstandard dictionaries are trained, one from good and one from bad labelled text.
A text that compresses better with the good dictionary resembles good text: the
difference of its two compressed sizes, over the larger of them, is the main feature;
the same difference and the compressed size per byte are the others, since repetitive
junk shrinks under any dictionary.  A logistic curve fitted on labelled rows that the
dictionaries have not seen turns the features into a calibrated score.

Training reads at most ``PER_CLASS`` rows of each label, chosen by the hash of doc_id;
class shares are counted over all labels.  A label's dictionary is trained on all pieces
of its texts: groups of about ``GROUP`` bytes each train one in a task, and where there are
several groups, the dictionaries' own pieces are trained on again, until one is left.  Only
that one reaches the driver.  The curve's features are those of whole texts, computed in
tasks, and every text is scored whole, a very long one too.

Nulls count as empty texts and get a score like any other.  Of rows that share an id, one
text (the smallest) is learned and each is scored.  A document with labels of both kinds
counts as one row of either.  If only one label occurs, every score is that label's share
(0.5 without any labels).  An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.llm import words as W
from ledgerlake.llm.tables import written

#: Labelled rows of either kind learned from, at most; bytes of text that one task trains on.
PER_CLASS, GROUP = 3000, 16 << 20
DICTIONARY, LEVEL, SAMPLE = 1 << 16, 3, 2048
FOLDS, HELD, CUT = 5, 0, 0.3
ADDED = ("held_out", "score", "predicted")


def fold(doc_id: str = "doc_id"):
    """crc32 of the id as text, modulo FOLDS; rows of fold HELD are never learned from."""
    return F.crc32(F.col(doc_id).cast("string")) % FOLDS


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> tuple[DataFrame | None, dict[int, int]]:
    """Rows to learn from (id, quality and the whole text; written), and how many labels of
    each kind there are."""
    known = labels.where("doc_id IS NOT NULL AND quality IN (0, 1)").where(fold() != HELD).select("doc_id", F.col("quality").cast("int").alias("quality"))
    counts = {r["quality"]: r["n"] for r in known.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    chosen = []
    for label in (0, 1):
        chosen += known.where(F.col("quality") == label).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()
    if not chosen:
        return None, counts
    ids = docs.sparkSession.createDataFrame([(r["doc_id"], r["quality"]) for r in chosen], "id long, quality int")  # 2 * per_class rows at most
    texts = docs.join(F.broadcast(ids), docs["doc_id"] == ids["id"]).groupBy("id", "quality").agg(F.min(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("text"))
    return written(texts, "labelled-texts"), counts


def _pieces(text: bytes) -> list[bytes]:
    return [text[i:i + SAMPLE] for i in range(0, len(text), SAMPLE)]


def _dictionary(pieces: list[bytes]) -> bytes:
    size = min(DICTIONARY, max(1024, sum(map(len, pieces)) // 8))
    if len(pieces) < 64:
        return b"".join(pieces)[-size:]  # too few to train on: their text itself serves
    return zstandard.train_dictionary(size, pieces).as_bytes()


class Model:
    """Both dictionaries and the curve: what a task needs, about 130 kB."""

    def __init__(self, good: bytes, bad: bytes):
        self.good, self.bad, self.constant = good, bad, None

    def features(self, texts: list[bytes]) -> np.ndarray:
        made = [zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False)
                for d in (self.good, self.bad)]
        sizes = np.array([[len(c.compress(t)) for c in made] for t in texts], float).reshape(-1, 2)
        n = np.array([len(t) for t in texts], float)
        good, bad = sizes[:, 0], sizes[:, 1]
        return np.column_stack([(bad - good) / np.maximum(good, bad), good / (n + 20), (bad - good) / (n + 20), np.log1p(n)])

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-2) -> None:
        """Weighted logistic regression by Newton steps."""
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        a = np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])
        w = np.zeros(a.shape[1])
        keep = ridge * np.diag([0.0] + [1.0] * (a.shape[1] - 1))
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
            step = np.linalg.solve(a.T @ (a * (weight * p * (1 - p))[:, None]) + keep + 1e-9 * np.eye(len(w)), a.T @ (weight * (y - p)) - keep @ w)
            w = w + step
            if np.abs(step).max() < 1e-9:
                break
        self.weights = w

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.constant is not None or not texts:
            return np.full(len(texts), self.constant if self.constant is not None else 0.5)
        a = np.column_stack([np.ones(len(texts)), (self.features(texts) - self.mean) / self.scale])
        return 1 / (1 + np.exp(-np.clip(a @ self.weights, -30, 30)))


def _roles(n: int) -> tuple[list[int], list[int]]:
    """Two of three rows of a label make its dictionary, the third fits the curve."""
    return [i for i in range(n) if i % 3 or n < 3], [i for i in range(n) if not i % 3]


def _constant(counts: dict[int, int]) -> float:
    return counts.get(1, 0) / sum(counts.values()) if counts else 0.5


def _fit(model: Model, x: np.ndarray, n: tuple[int, int], counts: dict[int, int]) -> Model:
    """The curve on the features of n[0] bad rows, then n[1] good ones."""
    total = sum(counts.values())
    model.fit(x, np.repeat([0.0, 1.0], n), np.repeat([counts[k] / total / n[k] for k in (0, 1)], n) * sum(n))
    return model


def train(rows: list[tuple[str, int]], counts: dict[int, int]) -> Model:
    """A model from texts at hand."""
    by = {label: [t.encode("utf-8", "surrogatepass") for t, y in rows if y == label] for label in (0, 1)}
    made = {label: [p for i in _roles(len(ts))[0] for p in _pieces(ts[i])] for label, ts in by.items()}
    model = Model(*(_dictionary(made[k]) if made[k] else b"" for k in (1, 0)))
    if not (any(by[0]) and any(by[1])):
        model.constant = _constant(counts)
        return model
    fit = [[by[k][i] for i in _roles(len(by[k]))[1]] for k in (0, 1)]
    return _fit(model, model.features(fit[0] + fit[1]), (len(fit[0]), len(fit[1])), counts)


def _groups(size: int, group_bytes: int) -> int:
    """How many groups to deal ``size`` bytes into: one, or enough for their dictionaries to be trained on."""
    return 1 if size <= group_bytes else max(10, -(-size // group_bytes))


def _dictionaries(pieces: DataFrame, groups: dict[int, int]) -> dict[int, bytes]:
    """One dictionary per label from all its ``pieces`` (quality, id, at, piece), which are
    dealt by a hash into as many ``groups``."""
    schema = pa.schema([("quality", pa.int32()), ("id", pa.int64()), ("at", pa.int64()), ("piece", pa.binary())])

    def train_group(table: pa.Table) -> pa.Table:
        rows = sorted(zip(*(table.column(c).to_pylist() for c in ("id", "at", "piece"))))
        return pa.Table.from_pylist([{"quality": table.column("quality")[0].as_py(), "id": table.column("part")[0].as_py(), "at": 0, "piece": _dictionary([p for _, _, p in rows])}], schema)

    done: dict[int, bytes] = {}
    while True:
        of = F.lit(0).cast("long")
        for label, n in groups.items():
            of = F.when(F.col("quality") == label, F.pmod(F.xxhash64("id", "at"), F.lit(n))).otherwise(of)
        made = pieces.withColumn("part", of).groupBy("quality", "part").applyInArrow(train_group, "quality int, id long, at long, piece binary")
        made = written(made.select("quality", "id", F.col("piece").alias("text")), "dictionaries")
        last = [k for k, n in groups.items() if n == 1]
        done |= {r["quality"]: bytes(r["text"]) for r in made.where(F.col("quality").isin(last)).collect()}       # one row a label
        groups = {k: _groups(n * DICTIONARY, GROUP) for k, n in groups.items() if n > 1}
        if not groups:
            return done
        # A dictionary begins with tables of its own; the text is behind them.
        text, more = F.expr("substring(text, 513, length(text))"), made.where(F.col("quality").isin(list(groups)))
        at = F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.length(text) - 1) / SAMPLE)).cast("int")))
        cut = more.select("quality", "id", text.alias("text"), at.alias("at"))
        pieces = cut.select("quality", "id", F.col("at").cast("long").alias("at"), F.expr(f"substring(text, at * {SAMPLE} + 1, {SAMPLE})").alias("piece"))


def learned(texts: DataFrame | None, counts: dict[int, int], group_bytes: int = GROUP) -> Model:
    """A model from a table of labelled texts, which are cut and measured in tasks: two
    dictionaries and one row of features per text reach the driver."""
    model = Model(b"", b"")
    sizes = texts.select("quality", "id", F.octet_length("text").alias("n")).orderBy("quality", "id").collect() if texts is not None else []
    by = {label: [r for r in sizes if r["quality"] == label] for label in (0, 1)}
    if not all(any(r["n"] for r in by[k]) for k in (0, 1)):
        model.constant = _constant(counts)
        return model
    making, fitting = ({(k, by[k][i]["id"]) for k in (0, 1) for i in _roles(len(by[k]))[role]} for role in (0, 1))
    groups = {k: _groups(sum(r["n"] for r in by[k] if (k, r["id"]) in making), group_bytes) for k in (0, 1)}

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            rows = [(i, k, at, p) for i, k, t in zip(*(batch.column(c).to_pylist() for c in ("id", "quality", "text"))) if (k, i) in making
                    for at, p in enumerate(_pieces(t.encode("utf-8", "surrogatepass")))]
            yield pa.RecordBatch.from_pylist([dict(zip(("id", "quality", "at", "piece"), r)) for r in rows],
                                             pa.schema([("id", pa.int64()), ("quality", pa.int32()), ("at", pa.int64()), ("piece", pa.binary())]))

    made = _dictionaries(texts.mapInArrow(cut, "id long, quality int, at long, piece binary"), groups)
    model = Model(*(made.get(k, b"") for k in (1, 0)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches):
            rows = [r for r in zip(*(batch.column(c).to_pylist() for c in ("quality", "id", "text"))) if r[:2] in fitting]
            x = model.features([t.encode("utf-8", "surrogatepass") for _, _, t in rows]).tolist() if rows else []
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()), pa.array(x, pa.list_(pa.float64()))], ["quality", "id", "x"])

    measured = sorted(texts.mapInArrow(measure, "quality int, id long, x array<double>").collect(), key=lambda r: (r["quality"], r["id"]))
    n = [sum(r["quality"] == k for r in measured) for k in (0, 1)]
    return _fit(model, np.array([r["x"] for r in measured]), (n[0], n[1]), counts)


def classify(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with held_out, score and predicted (score >= CUT); input
    columns of these names are replaced and never used."""
    texts, counts = sample(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")), labels, per_class)
    model = learned(texts, counts)
    kept = docs.select(*[c for c in docs.columns if c not in ADDED])
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in W.pieces(batches, text):
            scores = model.scores([(t or "").encode("utf-8", "surrogatepass") for t in batch.column(text).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores)], schema.names)

    scored = kept.mapInArrow(run, schema)
    return scored.select(*kept.columns, F.coalesce(fold() == HELD, F.lit(False)).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"))
