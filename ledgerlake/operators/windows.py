"""Window operators that stay balanced when one partition key holds a large share of
all rows.

A plain ``Window.partitionBy(k)`` sends every row of a key to one task, and
``Window.orderBy`` with no partition sends *all* rows to one task.  The operators here
give the same results with work spread by data volume:

* ``running_total`` — RANGE-frame running sum.  Rows are first summed per
  (key, order value) with map-side partial aggregation, and the window runs over those
  sums, so a key's window holds one row per distinct order value (for dates: at most
  one row per day), however many rows the key has.
* ``global_position`` — position of every row in a total order.  A range shuffle
  spreads rows by value; within each partition the position is the partition's offset
  plus the row's index.  Offsets come from a table with one row per partition, the only
  broadcast, whose size is bounded by the partition count.
* ``row_number_by`` — segmented row numbers derived from the global position.
* ``with_running_and_previous`` — running sum and previous value: keys of few rows in one
  window, the others by way of one row per (key, order value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlake.session import scratch_dir, shuffles_released


#: Scratch files are written and read once or twice, through the network.
SCRATCH_CODEC = "zstd"


def _sort_cols(order: Sequence) -> list[Column]:
    """Columns as they are; names ascending, NULLs first; (name, ascending) pairs, NULLs
    first if ascending, else last."""
    out = []
    for c in order:
        if isinstance(c, tuple):
            c = F.col(c[0]).asc_nulls_first() if c[1] else F.col(c[0]).desc_nulls_last()
        out.append(F.col(c).asc_nulls_first() if isinstance(c, str) else c)
    return out


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str],
                   how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL; keeps one copy of each key."""
    renamed = right
    for k in keys:
        renamed = renamed.withColumnRenamed(k, f"_r_{k}")
    cond = [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys]
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_total(df: DataFrame, partition_cols: Sequence[str], order_col: str,
                  value_col: str, out_col: str = "running_total") -> DataFrame:
    """One row per (partition key, order value) with the RANGE-frame running sum
    ``sum(value) over (partition by keys order by order_col range between unbounded
    preceding and current row)``.  NULL keys form one partition, as in a window."""
    daily = df.groupBy(*partition_cols, order_col).agg(F.sum(value_col).alias("_part"))
    w = (Window.partitionBy(*partition_cols).orderBy(F.col(order_col).asc_nulls_first())
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    single_level = df.select(F.sum(value_col)).schema.fields[0].dataType
    return daily.select(*partition_cols, order_col,
                        F.sum("_part").over(w).cast(single_level).alias(out_col))


def running_over(partition_cols: Sequence[str], order_col: str, value_col: str) -> Column:
    """The RANGE-frame running sum, as a column of rows that are few per key."""
    w = (Window.partitionBy(*partition_cols).orderBy(F.col(order_col).asc_nulls_first())
         .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return F.sum(value_col).over(w)


def with_running_total(df: DataFrame, partition_cols: Sequence[str], order_col: str,
                       value_col: str, out_col: str = "running_total") -> DataFrame:
    """``df`` plus its RANGE-frame running sum (joined back on key + order value)."""
    totals = running_total(df, partition_cols, order_col, value_col, out_col)
    return join_null_safe(df, totals, [*partition_cols, order_col], "left")


def materialize(df: DataFrame, purpose: str) -> DataFrame:
    """Write ``df`` as parquet under the shared checkpoint folder and read it back:
    cuts lineage, fixes non-deterministic columns, survives executor loss."""
    spark = SparkSession.getActiveSession() or df.sparkSession
    path = scratch_dir(spark, purpose)
    with shuffles_released(df.sparkSession):
        df.write.mode("errorifexists").option("compression", SCRATCH_CODEC).parquet(path)
    return spark.read.parquet(path)


def global_position(df: DataFrame, order: Sequence, pos_col: str = "_pos",
                    num_partitions: int | None = None) -> DataFrame:
    """Add ``pos_col``: 0-based position of each row in ``order`` (which must be a
    total order: end it with a unique column)."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sort = _sort_cols(order)
    tagged = (df.repartitionByRange(n, *sort).sortWithinPartitions(*sort)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id()))
    tagged = materialize(tagged, "position")
    # One row per partition: bounded by the partition count, never by the data.
    per_part = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"),
                                          F.min("_mid").alias("_first"))
    w = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", "_first",
                              F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_off"))
    return (tagged.join(F.broadcast(offsets), "_pid")
                  .withColumn(pos_col, F.col("_off") + F.col("_mid") - F.col("_first"))
                  .drop("_pid", "_mid", "_first", "_off"))


def row_number_by(df: DataFrame, partition_cols: Sequence[str], order: Sequence,
                  out_col: str = "row_number") -> DataFrame:
    """``row_number() over (partition by partition_cols order by order)`` without
    gathering a partition key in one task.  ``order`` must break all ties."""
    pos = global_position(df, [*partition_cols, *order], "_pos")
    # Written, so its size is known when the join is planned: few keys are broadcast and
    # the rows are not dealt out again; very many are joined by shuffles Spark can split.
    starts = materialize(pos.groupBy(*partition_cols).agg(F.min("_pos").alias("_start")), "starts")
    return (join_null_safe(pos, starts, list(partition_cols), "inner")
            .withColumn(out_col, F.col("_pos") - F.col("_start") + 1)
            .drop("_pos", "_start"))


#: A key with more rows is hot: they are not gathered in one task.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame | None:
    """Keys with more than ``HOT_ROWS`` rows, stored (at most one for so many rows); None if there are none."""
    hot = materialize(df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > HOT_ROWS).select(*cols), "hot-keys")
    return None if hot.isEmpty() else hot


def with_running_and_previous(df: DataFrame, partition_cols: Sequence[str], order_col: str, tie_col: str,
                              value_col: str | Column, running_col: str, previous_col: str, counted: DataFrame | None = None) -> DataFrame:
    """``df`` plus the RANGE-frame running sum of ``value_col`` and
    ``lag(value_col) over (partition by keys order by order_col, tie_col)``.

    The rows of a key that has few are dealt by key, once.  Those of a hot key, if there is any, go by way
    of its order values (``running_by_steps``).  Rows are counted in ``counted`` (default: ``df``), which may hold more of
    them.  ``tie_col`` must not repeat within an order value."""
    hot = hot_keys(df if counted is None else counted, partition_cols)
    of = (partition_cols, order_col, tie_col, value_col, running_col, previous_col)
    if hot is None:
        return running_by_key(df, *of)
    apart = hot.select(*[F.col(k).alias(f"_h_{k}") for k in partition_cols])
    same = [F.col(k).eqNullSafe(F.col(f"_h_{k}")) for k in partition_cols]
    return running_by_key(df.join(apart, same, "left_anti"), *of).unionByName(running_by_steps(df.join(apart, same, "left_semi"), *of))


def running_by_key(df: DataFrame, partition_cols: Sequence[str], order_col: str, tie_col: str,
                   value_col: str | Column, running_col: str, previous_col: str) -> DataFrame:
    """The plain windows: one shuffle by key, one sort."""
    value = F.col(value_col) if isinstance(value_col, str) else value_col
    w = Window.partitionBy(*partition_cols)
    first = F.col(order_col).asc_nulls_first()
    rows = df.withColumn(previous_col, F.lag(value).over(w.orderBy(first, F.col(tie_col).asc_nulls_first())))
    return rows.withColumn(running_col, F.sum(value).over(w.orderBy(first).rangeBetween(Window.unboundedPreceding, Window.currentRow)))


def running_by_steps(df: DataFrame, partition_cols: Sequence[str], order_col: str, tie_col: str,
                     value_col: str | Column, running_col: str, previous_col: str) -> DataFrame:
    """``df`` plus the RANGE-frame running sum of ``value_col`` and
    ``lag(value_col) over (partition by keys order by order_col, tie_col)``.  A value that is
    an expression over ``df`` is derived where it is needed and not shuffled.

    Rows are first reduced to one per (key, order value): its sum and its last value in
    ``tie_col`` order.  A window over these gives the running sum and the last value
    before; the lag among rows of one order value is a window dealt by key *and* order
    value, like the join just before it.  So a key's rows are spread over its order
    values (for dates: its days).  ``tie_col`` must not repeat within an order value.
    """
    value = F.col(value_col) if isinstance(value_col, str) else value_col
    last = F.max(F.struct(F.col(tie_col).isNotNull().alias("k"), F.col(tie_col).alias("t"), value.alias("v")))["v"]
    steps = df.groupBy(*partition_cols, order_col).agg(F.sum(value).alias("_sum"), last.alias("_last"))
    w = Window.partitionBy(*partition_cols).orderBy(F.col(order_col).asc_nulls_first())
    single_level = df.select(F.sum(value)).schema.fields[0].dataType
    running = F.sum("_sum").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    steps = steps.select(*partition_cols, order_col, running.cast(single_level).alias(running_col), F.lag("_last").over(w).alias("_before"))
    rows = join_null_safe(df, steps, [*partition_cols, order_col], "left")
    inner = Window.partitionBy(*partition_cols, order_col).orderBy(F.col(tie_col).asc_nulls_first())
    previous = F.when(F.row_number().over(inner) == 1, F.col("_before")).otherwise(F.lag(value).over(inner))
    return rows.withColumn(previous_col, previous).drop("_before")
