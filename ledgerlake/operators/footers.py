"""Counts and extremes of stored Parquet tables from the files' footers.

Spark answers COUNT, MIN and MAX of a table read through its DataSource V2 Parquet reader
from the footers alone, grouped by partition columns if asked, for the types whose footer
statistics are exact.  Of other types (timestamps, texts, decimals) the column itself
is read; a coarser stored column that never falls where they rise (a timestamp's date)
tells first which rows can hold the largest value, and row groups without such rows are
skipped by their statistics.
"""

from __future__ import annotations

import contextlib
from collections.abc import Callable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.sources.tables import DEFAULT_FORMAT, read_table

#: Types whose smallest and largest values are taken from footers.  Not those of
#: fractions: a file with a NaN has no such statistics.
EXACT = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType)


@contextlib.contextmanager
def footer_reads(spark: SparkSession):
    """Parquet tables opened and aggregated inside the block can be answered by footers;
    the session's settings are put back at its end."""
    v1 = spark.conf.get("spark.sql.sources.useV1SourceList")
    ours = {"spark.sql.parquet.aggregatePushdown": "true",
            "spark.sql.sources.useV1SourceList": ",".join(x for x in v1.split(",") if x.strip() not in ("", "parquet"))}
    old = {k: spark.conf.get(k, None) for k in ours}
    try:
        for k, v in ours.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


#: What Spark's error names where a file has no value or no statistics of a column.
UNANSWERED = "spark.sql.parquet.aggregatePushdown"


def _collected(spark: SparkSession, ask: Callable[[], DataFrame]) -> list:
    """The rows of a small aggregate, from footers; from the columns if some file's footer
    cannot tell (all its values are NULL, or it was written without statistics)."""
    try:
        with footer_reads(spark):
            return ask().collect()
    except (Py4JJavaError, PySparkException) as e:
        if UNANSWERED not in str(e):
            raise
    return ask().collect()


def extremes(table: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Row count (n) and min_c, max_c of ``columns``, per value of ``by``."""
    ends = [f(c).alias(f"{name}_{c}") for c in columns for name, f in (("min", F.min), ("max", F.max))]
    return table.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *ends)


def stored_extremes(spark: SparkSession, path: str, columns: Sequence[str], by: Sequence[str] = ()) -> list:
    """``extremes`` of a stored Parquet table per value of partition columns: one row each
    reaches the driver, as many as there are partitions."""
    rows = _collected(spark, lambda: extremes(spark.read.parquet(path), columns, by))
    return [Row(**{**r.asDict(), "n": r["n"] or 0}) for r in rows]      # footers without rows count to NULL


def stored_max(spark: SparkSession, path: str, column: str, coarse: str | None = None, fmt: str = DEFAULT_FORMAT):
    """The largest value of a stored column; NULL for an empty table or one of NULLs.

    ``coarse``: a stored column with exact statistics that never falls where ``column``
    rises and is NULL only where it is NULL, such as the date of a timestamp.
    """
    table = read_table(spark, path, fmt)
    if fmt != "parquet":
        return table.agg(F.max(column).alias("m")).first()["m"]
    kind = {f.name: f.dataType for f in table.schema.fields}
    if isinstance(kind[column], EXACT):
        return _collected(spark, lambda: spark.read.parquet(path).agg(F.max(column).alias("m")))[0]["m"]
    if coarse and isinstance(kind.get(coarse), T.DateType):
        last = stored_max(spark, path, coarse)
        if last is None:
            return None
        table = table.where(F.col(coarse) >= F.lit(last))
    return table.agg(F.max(column).alias("m")).first()["m"]
