"""Load metrics.  Counts of a write are collected by ``observe`` while it runs;
``load_counts`` grades a whole table in one scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Attach a row counter; read ``obs.get["rows"]`` after the action that runs df."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def load_counts(graded: DataFrame, key: str, table: str) -> DataFrame:
    """One row per table: raw rows, valid rows, rejected rows and silver rows (distinct
    keys of the valid rows; a NULL key is one key), from one pass."""
    ok = F.col("reject_reason").isNull()
    return graded.agg(
        F.count(F.lit(1)).alias("raw_rows"),
        F.count_if(ok).alias("valid_rows"),
        F.count_if(~ok).alias("rejected_rows"),
        (F.count_distinct(F.when(ok, F.col(key))) + F.max(F.when(ok & F.col(key).isNull(), 1).otherwise(0))).cast("bigint").alias("_keys"),
    ).select(F.lit(table).alias("table_name"), "raw_rows", "valid_rows", "rejected_rows",
             F.coalesce("_keys", F.lit(0)).alias("silver_rows"))


def reject_counts(graded: DataFrame, table: str) -> DataFrame:
    """Rejected rows per reason."""
    return (graded.where("reject_reason IS NOT NULL").groupBy("reject_reason")
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(table).alias("table_name"), "reject_reason", "rows"))
