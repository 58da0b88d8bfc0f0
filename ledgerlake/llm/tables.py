"""Small helpers shared by the operators: input columns, row keys and written steps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir

#: Rows without an id are ordered behind all others.
LAST_ID = (1 << 63) - 1


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """Write a step to the shared folder of ``spark.checkpoint.dir`` and read it back:
    it is computed once, its lineage ends there, and executors may be lost afterwards."""
    path = scratch_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def order_id(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.col(doc_id), F.lit(LAST_ID))


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """Tells apart rows that share an id; rows equal in id and text share a key."""
    return F.xxhash64(F.col(doc_id).isNull(), F.col(text).isNull(), F.col(text))
