import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerlake.llm import queries, tables
from tests.conftest import SMALL_SF
from tests.llm.cases import docs, empty  # noqa: F401


def test_stages_and_columns(spark):
    docs = spark.read.parquet(f"{SMALL_SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = tables.written(stage(spark, docs, SMALL_SF), "test")
        assert docs.columns == columns and 0.6 * before < docs.count() <= before
        before = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL_SF)
    tokens = docs.select(mix_tokens().alias("t")).agg({"t": "sum"}).first()[0]
    assert last.agg({"tokens": "sum"}).first()[0] <= tokens
    assert last.join(docs, "doc_id", "left_anti").count() == 0


@pytest.mark.parametrize("at", range(5))
def test_each_stage_on_odd_rows(spark, docs, at):  # noqa: F811
    """Null ids and texts, empty and long texts, ties, repeated rows, and columns named like results."""
    odd = tables.written(docs.withColumns({"score": F.lit("x"), "tokens": F.lit("y"), "n_found": F.lit("z"), "class_id": F.lit("c"), "epoch": F.lit("e")}), "test")
    got = corpus_pipeline.STAGES[at][1](spark, odd, SMALL_SF)
    if at < 4:
        assert got.columns == odd.columns and set(got.select("score", "tokens", "class_id").distinct().collect()) <= {("x", "y", "c")}
        known = {(r["doc_id"], r["lang"], r["source"]) for r in odd.collect()}
        assert 0 < got.count() <= odd.count() and {(r["doc_id"], r["lang"], r["source"]) for r in got.collect()} <= known
    else:
        assert got.count() > 0


def test_each_stage_on_an_empty_table(spark):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty(spark), SMALL_SF).count() == 0


def test_a_run_leaves_only_its_result(spark):
    from ledgerlake import session
    before = len(session._SCRATCH)
    got = corpus_pipeline.run(spark, SMALL_SF)
    assert got.count() > 0
    left = [p for p in session._SCRATCH[before:] if tables_exist(spark, p)]
    assert len(left) == 1 and left[0].rsplit("/", 1)[-1].startswith("mixing")


def tables_exist(spark, path):
    from ledgerlake.sources.tables import path_exists
    return path_exists(spark, path)


def mix_tokens():
    from pyspark.sql import functions as F

    from ledgerlake.llm.mixing import n_tokens
    return n_tokens(F.col("text"))


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in names) == 1
    assert "pipeline" in names and set(queries.ORACLE) <= set(entry.oracle_sql())
