"""Catalog tables bucketed by a join key, so joins on it need no shuffle of their rows.

A bucketed table holds the rows of a bucket in files of their own and stays bucketed when
partitions of it are replaced.  A bucket is one task of a join, so a hot key makes a hot
task that Spark cannot split; ``joinable`` measures the buckets' files first and, where
one is much larger than the others, reads the table as plain files, whose join shuffles
and is split by AQE.
"""

from __future__ import annotations

import contextlib
import json
from collections.abc import Sequence
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.operators.incremental import partition_name
from ledgerlake.sources.tables import delete_path, table_exists, table_location

#: A bucket of so many times the mean size is hot, if it also has so many bytes.
HOT_FACTOR, HOT_BYTES = 4.0, 1 << 30


def _dealt(rows: DataFrame, key: str, buckets: int, partition_by: Sequence[str]) -> DataFrame:
    """Rows of a partition and bucket together, for one file each; AQE splits those of a
    hot key over several tasks and files."""
    bucket = F.pmod(F.hash(key), F.lit(buckets))                # how Spark numbers buckets
    return rows.withColumn("_bucket", bucket).hint("rebalance", *partition_by, "_bucket").drop("_bucket")


def save_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int, partition_by: Sequence[str] = ()) -> None:
    """Replace the catalog table ``name`` (external, at ``path``)."""
    w = _dealt(df, key, buckets, partition_by).write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path)
    (w.partitionBy(*partition_by) if partition_by else w).saveAsTable(name)


@contextlib.contextmanager
def _dynamic_overwrite(spark: SparkSession):
    conf = "spark.sql.sources.partitionOverwriteMode"
    old = spark.conf.get(conf, None)
    spark.conf.set(conf, "dynamic")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(conf)
        else:
            spark.conf.set(conf, old)


def refresh_bucketed(spark: SparkSession, source: DataFrame, name: str, path: str, key: str, buckets: int,
                     partition_by: Sequence[str], changed: Sequence[str] | None) -> None:
    """Bring a bucketed copy of ``source`` up to date after a load that rewrote the
    partitions ``changed`` (as ``LoadResult`` names them; None: all): only these are read
    and written, partitions that no row stays in are dropped, and all stay bucketed."""
    if changed is None or not table_exists(spark, name):
        save_bucketed(source, name, path, key, buckets, partition_by)
        return
    if not changed:
        return
    part, table = partition_name(partition_by), spark.table(name)
    rows = source.where(part.isin(list(changed))).select(*table.columns)
    stay = {r["part"] for r in rows.select(part.alias("part")).distinct().collect()}      # some of ``changed``
    gone = [x for x in changed if x not in stay]
    folders = [r["f"] for r in table.where(part.isin(gone)).select(
        F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("f")).distinct().collect()] if gone else []
    with _dynamic_overwrite(spark):
        _dealt(rows, key, buckets, partition_by).write.mode("overwrite").insertInto(name)
    for spec in map(json.loads, gone):
        quoted = ("null" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'" for v in spec.values())
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({', '.join(f'`{c}` = {v}' for c, v in zip(spec, quoted))})")
    for folder in folders:
        delete_path(spark, unquote(folder))
    spark.catalog.refreshTable(name)


def bucket_sizes(spark: SparkSession, name: str) -> DataFrame:
    """bucket and bytes, from the listing of the table's files: Spark ends the name of a
    bucket's file with its number.  No content is read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(table_location(spark, name))
    bucket = F.regexp_extract("path", r"_([0-9]{5,})(?:\.c[0-9]+)?(?:\.[a-z0-9]+)?\.parquet$", 1)
    return files.select(F.when(bucket != "", bucket.cast("int")).alias("bucket"), "length").groupBy("bucket").agg(F.sum("length").alias("bytes"))


def is_hot(spark: SparkSession, name: str, buckets: int, factor: float = HOT_FACTOR, least: int = HOT_BYTES) -> bool:
    """Does one bucket hold far more than its share?  Two numbers reach the driver."""
    r = bucket_sizes(spark, name).agg(F.max("bytes").alias("most"), F.sum("bytes").alias("all")).first()
    return r["most"] is not None and r["most"] >= least and r["most"] * buckets > factor * r["all"]


def joinable(spark: SparkSession, name: str, buckets: int, factor: float = HOT_FACTOR, least: int = HOT_BYTES) -> DataFrame:
    """The table for a join on its bucket key; as plain files if a bucket is hot."""
    if not table_exists(spark, name):
        raise ValueError(f"no table {name}")
    table = spark.table(name)
    if not is_hot(spark, name, buckets, factor, least):
        return table
    return spark.read.schema(table.schema).parquet(table_location(spark, name)).select(*table.columns)
