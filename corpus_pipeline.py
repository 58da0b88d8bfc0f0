"""The corpus pipeline: five stages over the table ``documents``, each calling one operator
of ``ledgerlake.llm`` on everything its predecessor kept.

All stages but the last return the columns of ``documents``.  Nulls, empty texts, repeated
rows and extra columns are handled as the operators' docstrings say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm.decontam import decontaminate
from ledgerlake.llm.jaccard import deduplicated
from ledgerlake.llm.mixing import mix
from ledgerlake.llm.pii import pseudonymise
from ledgerlake.llm.quality import classify
from ledgerlake.llm.queries import PII_KEY, WEIGHTS, domain_of_source
from ledgerlake.llm.tables import read
from ledgerlake.session import scratch_dir, scratch_scope
from ledgerlake.sources.tables import delete_path


#: Columns of documents; others are only carried along.
USED = ("doc_id", "text", "lang", "source", "n_chars")


def _carrying(docs: DataFrame, decide: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """``decide`` of the documents, with all columns as they came: while it runs, columns that
    might be named like its results have other names."""
    aside = {c: f"_carried_{i}" for i, c in enumerate(docs.columns) if c not in USED}
    return decide(docs.withColumnsRenamed(aside)).select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return _carrying(docs, lambda d: classify(d, read(spark, sf_dir, "labels")).where("predicted = 1"))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, that with the smallest id."""
    return _carrying(docs, deduplicated)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    return _carrying(docs, lambda d: decontaminate(d, read(spark, sf_dir, "benchmark")).where("NOT contaminated"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by pseudonyms; n_chars follows the text."""
    def hide(d: DataFrame) -> DataFrame:
        hidden = pseudonymise(d, PII_KEY)
        if "n_chars" in d.columns:
            hidden = hidden.withColumn("n_chars", F.when(F.col("n_found") > 0, F.length("text").cast(d.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
        return hidden

    return _carrying(docs, hide)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many tokens as there are, in the wanted mixture: each chosen document once per
    epoch, with its domain, tokens, epoch and place in the epoch's order."""
    return mix(docs, domain_of_source(), weights=WEIGHTS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", keep_one_of_each),
    ("benchmark decontamination", keep_uncontaminated),
    ("PII", hide_personal_data),
    ("mixing sources to target weights", mix_sources),
]

#: No stage but the last can be written in SQL alone.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; each result is written as Parquet and read by the next.  What a
    stage wrote on its way is deleted at its end, its input once its result is complete."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        path = scratch_dir(spark, name.replace(" ", "-"))
        with scratch_scope(spark):
            result = stage(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before:
            delete_path(spark, before)
        before = path
    return docs
