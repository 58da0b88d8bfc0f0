"""Running sums and previous values (W3, W4, W6) carried from load to load.

``extend`` adds a delivery to a table of rows that each know the running sum of their key
(RANGE frame: rows of one day share it) and the value of the key's row before.  Beside the rows
stands one carry row per key: its last day, the running sum and the last value there.

A key whose new rows all come after its last day is on time: only the new rows are looked at,
and the carry is added to them.  A key with a new row on or before its last day is late: its
rows from the first such day on are derived again, from its history; all others keep
theirs.  Rows are stored by month and by hash bucket of the key, so only the partitions
that hold changed rows are rewritten, and history is read of the late keys' buckets only.

Rows are told apart by ``tie_col``, which no two rows of the table share; a row that is
delivered again, unchanged, replaces itself, so a load that was interrupted is completed by
repeating it: the carry is written last.  (Versions of a row are resolved before, by the
upsert of the silver table.)
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.windows import join_null_safe, materialize, with_running_and_previous
from ledgerlake.session import step_scope
from ledgerlake.sources import tables

MONTH, BUCKET = "month", "bucket"


@dataclass
class CarryResult:
    new_rows: int = 0
    late_keys: int = 0
    rewritten_rows: int = 0        # rows of late keys that were there before and changed
    partitions: int = 0            # (month, bucket) partitions written


def read_carried(spark: SparkSession, path: str) -> DataFrame:
    return tables.read_table(spark, f"{path}/rows").drop(MONTH, BUCKET)


def _null_safe(left: DataFrame, right: DataFrame, cols: list[str], how: str) -> DataFrame:
    """Semi and anti joins in which NULL meets NULL."""
    other = right.select(*[F.col(c).alias(f"_o_{c}") for c in cols])
    return left.join(other, [F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in cols], how)


def _last(rows: DataFrame, key: str, order_col: str, tie_col: str, value_col: str, running_col: str) -> DataFrame:
    """The carry of every key in ``rows``, which hold its last day's rows."""
    at = F.struct(F.col(order_col), F.col(tie_col).isNotNull().alias("k"), F.col(tie_col).alias("t"))
    best = F.max_by(F.struct(F.col(order_col).alias("d"), F.col(running_col).alias("r"), F.col(value_col).alias("v")), at)
    return (rows.groupBy(key, BUCKET).agg(best.alias("b"))
            .select(key, BUCKET, F.col("b.d").alias("last_day"), F.col("b.r").alias("running"), F.col("b.v").alias("last_value")))


def extend(spark: SparkSession, delivery: DataFrame, path: str, *, key: str, order_col: str, tie_col: str, value_col: str,
           running_col: str = "running", previous_col: str = "previous", buckets: int = 16) -> CarryResult:
    """Add ``delivery`` (with a date ``order_col`` that is never NULL) to the table at ``path``."""
    with step_scope(spark):
        return _extend(spark, delivery, path, key, order_col, tie_col, value_col, running_col, previous_col, buckets)


def _extend(spark: SparkSession, delivery: DataFrame, path: str, key: str, order_col: str, tie_col: str, value_col: str,
            running_col: str, previous_col: str, buckets: int) -> CarryResult:
    inputs = list(dict.fromkeys([key, order_col, tie_col, value_col]))
    month: Column = (F.year(order_col) * 100 + F.month(order_col)).cast("int")
    new = materialize(delivery.select(*inputs, month.alias(MONTH), F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias(BUCKET)), "carry-new")
    out = CarryResult(new.count())
    if not out.new_rows:
        return out
    names = [key, order_col, tie_col, value_col, running_col, previous_col]

    def derive(rows: DataFrame, counted: DataFrame = new) -> DataFrame:
        return with_running_and_previous(rows, [key], order_col, tie_col, value_col, running_col, previous_col, counted.select(key))

    if not tables.path_exists(spark, f"{path}/carry"):
        tables.write_table(derive(new).select(*names, MONTH, BUCKET), f"{path}/rows", mode="overwrite", partition_by=[MONTH, BUCKET])
        rows = tables.read_table(spark, f"{path}/rows")
        tables.write_table(_last(rows, key, order_col, tie_col, value_col, running_col), f"{path}/carry", mode="overwrite", partition_by=[BUCKET])
        out.partitions = rows.select(MONTH, BUCKET).distinct().count()
        return out

    carry, there = tables.read_table(spark, f"{path}/carry"), tables.read_table(spark, f"{path}/rows")
    kind = carry.schema["running"].dataType
    place = F.struct(F.col(order_col), F.col(tie_col).isNotNull().alias("k"), F.col(tie_col).alias("t"))
    first = new.groupBy(key, BUCKET).agg(F.min(order_col).alias("first_day"), F.min(place)["t"].alias("first_tie"))
    known = materialize(join_null_safe(first, carry.drop(BUCKET), [key], "left").withColumn("late", F.coalesce(F.col("first_day") <= F.col("last_day"), F.lit(False))), "carry-known")
    late = known.where("late").select(key, "first_day")

    # On time: the carry is what came before the new rows.
    rest = known.where("NOT late").select(key, "first_day", "first_tie", F.col("running").alias("_before"), F.col("last_value").alias("_last"))
    on_time = join_null_safe(derive(_null_safe(new, rest, [key], "left_semi")), rest, [key], "left")
    begins = (F.col(order_col) == F.col("first_day")) & F.col(tie_col).eqNullSafe(F.col("first_tie"))
    on_time = on_time.select(key, order_col, tie_col, value_col, F.coalesce(F.col(running_col) + F.col("_before"), F.col(running_col), F.col("_before")).cast(kind).alias(running_col),
                             F.when(begins, F.col("_last")).otherwise(F.col(previous_col)).alias(previous_col), MONTH, BUCKET)

    # Late: their history (without rows that come again) and the new rows, derived anew.
    held = [r[BUCKET] for r in known.where("late").select(BUCKET).distinct().collect()]     # at most ``buckets``
    history = _null_safe(there.where(F.col(BUCKET).isin(held)).select(*inputs, MONTH, BUCKET), late, [key], "left_semi")
    history = _null_safe(history, new, [tie_col], "left_anti")
    again = derive(history.unionByName(_null_safe(new, late, [key], "left_semi")), there.where(F.col(BUCKET).isin(held)).select(key).unionByName(new.select(key)))
    again = join_null_safe(again, late, [key], "left").where(F.col(order_col) >= F.col("first_day")).drop("first_day")
    changed = materialize(on_time.select(*names, MONTH, BUCKET).unionByName(again.select(*names, MONTH, BUCKET)), "carry-changed")

    out.late_keys, parts = late.count(), materialize(changed.select(MONTH, BUCKET).distinct(), "carry-parts")
    out.rewritten_rows, out.partitions = changed.count() - out.new_rows, parts.count()
    # The partitions that receive rows: their other rows stay as they are.
    name = F.col(MONTH).cast("long") * buckets + F.col(BUCKET)
    touched = [r["p"] for r in parts.select(name.alias("p")).collect()]                     # months times buckets at most
    stay = _null_safe(there.where(name.isin(touched)).select(*names, MONTH, BUCKET), changed, [tie_col], "left_anti")
    staged = materialize(stay.unionByName(changed), "carry-staged")
    tables.write_table(staged, f"{path}/rows", mode="overwrite", partition_by=[MONTH, BUCKET], dynamic_overwrite=True)

    fresh = _last(changed, key, order_col, tie_col, value_col, running_col)
    old = carry.where(F.col(BUCKET).isin([r[BUCKET] for r in known.select(BUCKET).distinct().collect()]))
    # Whichever is later: a late row may lie before the key's last day, whose sum then changed too.
    both = materialize(_null_safe(old, fresh, [key], "left_anti").unionByName(fresh), "carry-last")
    tables.write_table(both, f"{path}/carry", mode="overwrite", partition_by=[BUCKET], dynamic_overwrite=True)
    spark.catalog.refreshByPath(f"{path}/rows")
    spark.catalog.refreshByPath(f"{path}/carry")
    return out

