"""Incremental loads into a table directory.

``late`` says which delivered rows are read:

* ``"upsert"`` (default): all of them;
* ``"drop"``: only rows whose event time is after the target's high-water mark; the
  others are left out and counted (``LoadResult.late_rows``).

What is read is upserted by key: the newest version of every key wins (the table's
survivor order), so a target holds each key once, however the rows were split into
deliveries.  ``write="append"`` adds the rows as they are, for a layer that keeps every
delivered row.  A table without an event-time column has no late rows.

Only partitions whose rows change are rewritten: those that receive rows and those
that hold an older version of a delivered key are merged, compared with what is
there, and overwritten where they differ.  A load that changes nothing writes nothing.
If a load is interrupted, repeating it completes it.  Formats that bring their own
MERGE and log are refused; use theirs.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake.operators import key_index as ki
from ledgerlake.operators.dedup import append_new_keys, latest_per_key
from ledgerlake.operators.footers import stored_max
from ledgerlake.operators.metrics import observed
from ledgerlake.operators.windows import materialize
from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.session import step_scope
from ledgerlake.sources.tables import (DEFAULT_FORMAT, declare_table, delete_path, move_directory, path_exists, read_declared,
                                       read_raw_csv, read_table, replace_directory, table_exists, write_raw_csv, write_table)

FILE_FORMATS = ("parquet", "orc")

#: A stored partition is copied where it lies if at most this share of its rows meet a delivered key and it is
#: in at most so many files; so many keys are broadcast at once.
MOST_MET, MOST_FILES, KEYS_AT_ONCE = 0.5, 8, 1_000_000
#: Splits the staged rows by whether they meet a delivered key.
MEETS = "_meets"


@dataclass
class LoadResult:
    path: str
    written_rows: int = 0
    skipped: bool = False
    high_water_mark: object = None
    rewritten_partitions: list = field(default_factory=list)
    late_rows: int = 0
    #: Partitions whose keys were read to find delivered ones; None: all of them.
    searched_partitions: list | None = None
    rejected: dict = field(default_factory=dict)


def high_water_mark(target: DataFrame, ts_col: str):
    """Max of the event-time column; one scalar reaches the driver."""
    return target.agg(F.max(ts_col).alias("m")).first()["m"]


def newer_than(df: DataFrame, ts_col: str, mark) -> DataFrame:
    """Rows strictly after the mark (a row equal to the mark is skipped)."""
    return df if mark is None else df.filter(F.col(ts_col) > F.lit(mark))


def partition_name(cols: Sequence[str]) -> Column:
    """One text per partition.  A filter on it uses partition columns only, so it prunes
    partitions, and takes any number of names as one list."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _digests(df: DataFrame, columns: list[str], name: Column) -> DataFrame:
    """Row count and combined hash of each partition."""
    return df.groupBy(name.alias("part")).agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*columns)).alias("x"))


def _changed(old: DataFrame, new: DataFrame, columns: list[str], name: Column) -> list:
    """Partitions that differ, one row each: part, whether the new rows have it, and how many."""
    both = [d.select(*[F.col(c) if c in d.columns else F.lit(None).alias(c) for c in columns]) for d in (old, new)]
    a, b = (_digests(d, columns, name) for d in both)
    b = b.withColumnsRenamed({"part": "p2", "n": "n2", "x": "x2"})
    differ = ~(F.col("n").eqNullSafe(F.col("n2")) & F.col("x").eqNullSafe(F.col("x2")))
    return a.join(b, F.col("part") == F.col("p2"), "full").where(differ).select(
        F.coalesce("part", "p2").alias("part"), F.col("n2").isNotNull().alias("kept"), F.col("n2").alias("n")).collect()


def upsert(spark: SparkSession, rows: DataFrame, target_path: str, *, keys: Sequence[str], order: Sequence,
           fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] | None = None, key_index: bool = False,
           declared: str | None = None, stored: bool = False) -> LoadResult:
    """Merge ``rows`` into the target, newest version of every key first in ``order``.

    ``rows`` may hold several versions of a key: they meet each other and those of the target
    in one shuffle.  They are written aside first, since they are read more than once;
    ``stored`` says that they are read from files already.
    With ``key_index`` a Bloom filter per partition is kept beside the table
    (``operators.key_index``), and only partitions that may hold a delivered key are searched.
    With ``declared`` a catalog table of that name holds the target's schema: files are read
    with it instead of a merge of their footers, and columns that a load adds are added to it.
    """
    if fmt not in FILE_FORMATS:
        raise ValueError(f"upserts rewrite files of {FILE_FORMATS}; {fmt!r} has its own MERGE")
    pcols = list(partition_by or ())
    if not path_exists(spark, target_path, fmt):
        counted, obs = observed(latest_per_key(rows, keys, order), "load")
        write_table(counted, target_path, fmt, "append", pcols)
        if key_index and pcols:
            stored = read_table(spark, target_path, fmt)
            ki.update(spark, stored, target_path, keys, pcols, partition_name(pcols), fmt)
        if declared:
            declare_table(spark, declared, target_path, rows.schema, pcols, fmt)
        return LoadResult(target_path, obs.get["rows"])

    existing = read_declared(spark, declared, target_path, fmt)
    # Columns new on either side are kept; the other side gets NULLs.
    cols = existing.columns + [c for c in rows.columns if c not in existing.columns]
    merge = lambda old: latest_per_key(old.unionByName(rows, allowMissingColumns=True).select(*cols), keys, order)
    if not pcols:
        staged = materialize(merge(existing), "upsert")
        if not _changed(existing, staged, cols, F.lit("")):
            return LoadResult(target_path, 0, True)
        counted, obs = observed(staged, "load")
        replace_directory(spark, counted, target_path, fmt)
        if declared:
            declare_table(spark, declared, target_path, staged.schema, pcols, fmt)
        return LoadResult(target_path, obs.get["rows"])

    name, staging = partition_name(pcols), f"{target_path.rstrip('/')}/_staged-{uuid.uuid4().hex}"
    with step_scope(spark):
        rows = rows if stored else materialize(rows, "delivery")
        # Which partitions hold a delivered key: reads the key and partition columns only, of the
        # partitions that the key index leaves; a delivery that is small when measured is
        # broadcast, so the target is not shuffled.  A NULL key is a key: it meets the NULL key that is there.
        searched = ki.may_hold(spark, existing, rows, target_path, keys, pcols, name, fmt) if key_index else None
        candidates = existing if searched is None else existing.where(name.isin(searched))
        delivered = rows.select(*[F.col(k).alias(f"_d_{k}") for k in keys])
        holding = candidates.select(*keys, *pcols).join(delivered, [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys], "left_semi")
        holding = materialize(holding.withColumn("part", name), "upsert")
        held = {r["part"]: r["count"] for r in holding.groupBy("part").count().collect()}
        touched = sorted({r["part"] for r in rows.select(name.alias("part")).distinct().collect()} | set(held))
        old = existing.where(name.isin(touched))
        try:
            apart = _in_place(old, rows, holding, held, cols, keys, name, pcols, f"{staging}/old", fmt)
            together = merge(_laid_out(spark, f"{staging}/old/{MEETS}=true", old, rows, cols, fmt).unionByName(old.where(~name.isin(apart)), allowMissingColumns=True) if apart else old)
            fresh = f"{staging}/old/{MEETS}=false"
            write_table(together, fresh, fmt, "append", pcols)
            staged = _laid_out(spark, fresh, old, rows, cols, fmt)
            changed = _changed(old, staged, cols, name)
            kept = [r["part"] for r in changed if r["kept"]]
            emptied = [r["part"] for r in changed if not r["kept"]]
            # Directories of partitions, as Spark lists them.
            folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("f")
            gone = [r["f"] for r in existing.where(name.isin(emptied)).select(folder).distinct().collect()] if emptied else []
            come = [r["f"] for r in staged.where(name.isin(kept)).select(folder).distinct().collect()] if kept else []
            for f in come:
                move_directory(spark, unquote(f), "/".join([target_path.rstrip("/"), *unquote(f).rsplit("/", len(pcols))[1:]]))
            for f in gone:
                delete_path(spark, unquote(f))
        finally:
            delete_path(spark, staging)
        spark.catalog.refreshByPath(target_path)
        if declared and (changed or not table_exists(spark, declared)):
            declare_table(spark, declared, target_path, staged.schema, pcols, fmt)
        if key_index and kept:
            ki.update(spark, read_declared(spark, declared, target_path, fmt).where(name.isin(kept)), target_path, keys, pcols, name, fmt)
    return LoadResult(target_path, sum(r["n"] for r in changed if r["kept"]), not changed, rewritten_partitions=kept + emptied, searched_partitions=searched)


def _laid_out(spark: SparkSession, path: str, old: DataFrame, rows: DataFrame, cols: list[str], fmt: str) -> DataFrame:
    """The rows staged below ``path``, with the types of the table and of the delivery; none if there are none."""
    schema = T.StructType([(old if c in old.columns else rows).schema[c] for c in cols])
    return spark.read.format(fmt).schema(schema).load(path).select(*cols) if path_exists(spark, path, fmt) else spark.createDataFrame([], schema)


def _in_place(old: DataFrame, rows: DataFrame, holding: DataFrame, held: dict, cols: list[str], keys: Sequence[str], name: Column,
              pcols: list[str], path: str, fmt: str) -> list:
    """Copies partitions of ``old`` without a shuffle of their rows, below ``path`` by whether a row
    meets a delivered key; their names.  The keys met (``holding``, counted in ``held``) are broadcast, for some
    partitions at a time.  Partitions most of whose rows meet one, or that lie in many files, are left to the merge."""
    if any(rows.schema[c].dataType != old.schema[c].dataType for c in rows.columns if c in old.columns):
        return []
    found = old.select(name.alias("part"), F.col("_metadata.file_path").alias("f")).groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("f").alias("files"))
    fit = sorted(r["part"] for r in found.collect() if held.get(r["part"], 0) <= MOST_MET * r["n"] and r["files"] <= MOST_FILES and held.get(r["part"], 0) <= KEYS_AT_ONCE)
    batches, size = [], 0
    for p in fit:
        if not batches or size + held.get(p, 0) > KEYS_AT_ONCE:
            batches.append([])
            size = 0
        batches[-1].append(p)
        size += held.get(p, 0)
    whole = [F.col(c) if c in old.columns else F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in cols]
    for batch in batches:
        met = holding.where(F.col("part").isin(batch)).select(*[F.col(k).alias(f"_d_{k}") for k in keys]).distinct().withColumn("_met", F.lit(True))
        both = old.where(name.isin(batch)).join(F.broadcast(met), [F.col(k).eqNullSafe(F.col(f"_d_{k}")) for k in keys], "left")
        write_table(both.select(*whole, F.col("_met").isNotNull().alias(MEETS)), path, fmt, "append", [MEETS, *pcols], one_partition=True)
    return fit


def incremental_load(spark: SparkSession, incoming: DataFrame, target_path: str, *,
                     keys: Sequence[str], ts_col: str | None, order: Sequence,
                     late: str = "upsert", transform: Callable[[DataFrame], DataFrame] | None = None,
                     fmt: str = DEFAULT_FORMAT, partition_by: Sequence[str] | None = None,
                     write: str = "upsert", key_index: bool = False, declared: str | None = None,
                     day_col: str | None = None) -> LoadResult:
    """Load ``incoming`` (optionally transformed, e.g. to silver) into ``target_path``.

    ``day_col``: a column of the target that holds the date of ``ts_col``; footers then tell
    which rows can hold the high-water mark (``footers.stored_max``).
    """
    if late not in ("drop", "upsert") or write not in ("upsert", "append"):
        raise ValueError(f"unknown policy late={late!r}, write={write!r}")
    mark, late_rows = None, 0
    if late == "drop" and ts_col and path_exists(spark, target_path, fmt):
        mark = stored_max(spark, target_path, ts_col, day_col, fmt)
        if mark is not None:
            late_rows = incoming.where(~F.coalesce(F.col(ts_col) > F.lit(mark), F.lit(False))).count()
        incoming = newer_than(incoming, ts_col, mark)
    if incoming.isEmpty():                               # S8: nothing new, no write
        return LoadResult(target_path, 0, True, mark, late_rows=late_rows)
    rows = transform(incoming) if transform else incoming
    if write == "append":
        counted, obs = observed(rows, "load")
        write_table(counted, target_path, fmt, "append", partition_by)
        result = LoadResult(target_path, obs.get["rows"])
    else:
        result = upsert(spark, rows, target_path, keys=keys, order=order, fmt=fmt, partition_by=partition_by, key_index=key_index, declared=declared)
    result.high_water_mark, result.late_rows = mark, late_rows
    return result


def append_new_rows(spark: SparkSession, incoming: DataFrame, target_path: str, *,
                    keys: Sequence[str], order: Sequence, table: str | None = None,
                    fmt: str = "csv") -> LoadResult:
    """Raw append with key dedup.  In-batch copies keep the first row in
    ``order``; keys already in the target are left out; the target is created if
    missing.  Only the key column of the target is read."""
    exists = path_exists(spark, target_path, fmt)
    existing = None
    if exists:
        existing = (read_raw_csv(spark, target_path, table or _raw_table_name(incoming))
                    if fmt == "csv" else read_table(spark, target_path, fmt))
    fresh = (append_new_keys(existing, incoming, keys, order) if existing is not None
             else latest_per_key(incoming, keys, order))
    fresh, obs = observed(fresh, "append")
    if fmt == "csv":
        write_raw_csv(fresh, target_path, "append")
    else:
        write_table(fresh, target_path, fmt, "append")
    return LoadResult(target_path, obs.get["rows"], False)


def _raw_table_name(df: DataFrame) -> str:
    cols = df.columns
    for name, schema in RAW_SCHEMAS.items():
        if [f.name for f in schema.fields] == cols:
            return name
    raise ValueError("incoming columns match no raw table schema")
