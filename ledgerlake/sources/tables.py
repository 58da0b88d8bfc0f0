"""Table I/O: raw CSV scans, format-neutral reads and writes, catalog tables.

Tables are directories of Parquet (or another Spark file format).  Paths are plain strings:
object-store settings belong in the Spark configuration (``spark.hadoop.*``), not in code.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.session import shuffles_released

DEFAULT_FORMAT = "parquet"
CORRUPT_COLUMN = "_corrupt_record"


def raw_schema(table: str, keep_unreadable: bool = False) -> T.StructType:
    """The raw columns; with ``keep_unreadable`` also one for the text of a record that
    has a field of the wrong type (such a field itself is NULL)."""
    fields = list(RAW_SCHEMAS[table].fields)
    return T.StructType(fields + ([T.StructField(CORRUPT_COLUMN, T.StringType())] if keep_unreadable else []))


def read_raw_csv(spark: SparkSession, path: str, table: str, keep_unreadable: bool = False) -> DataFrame:
    """Headered CSV with the table's declared schema (no inference pass)."""
    return (spark.read.schema(raw_schema(table, keep_unreadable)).option("header", True)
                 .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT_COLUMN).csv(path))


#: A compressed CSV file is read by one task, so files end after so many rows.
CSV_ROWS_PER_FILE = 500_000


def write_raw_csv(df: DataFrame, path: str, mode: str = "append") -> None:
    """Headered CSV, compressed."""
    df.write.mode(mode).option("header", True).option("compression", "gzip").option("maxRecordsPerFile", CSV_ROWS_PER_FILE).csv(path)


def read_table(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT,
               merge_schema: bool = False) -> DataFrame:
    """Open a table directory as a DataFrame.  ``merge_schema`` unions the
    schemas of files written before and after a column was added (S11)."""
    reader = spark.read.format(fmt)
    if merge_schema and fmt == "parquet":
        reader = reader.option("mergeSchema", "true")
    return reader.load(path)


def declare_table(spark: SparkSession, name: str, path: str, schema: T.StructType, partition_by: Sequence[str] | None = None,
                  fmt: str = DEFAULT_FORMAT) -> None:
    """The catalog holds the schema of the table at ``path``.  Columns it does not know
    are added; none is dropped or retyped.  Partitions that came or went are told to the
    catalog too, so the table can be queried by name."""
    column = lambda f: f"`{f.name}` {f.dataType.simpleString()}"
    if not table_exists(spark, name):
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {name} ({', '.join(column(f) for f in schema.fields)}) USING {fmt}{parts} LOCATION '{path}'")
    else:
        known = {f.name: f.dataType for f in spark.table(name).schema.fields}
        other = [f.name for f in schema.fields if f.name in known and known[f.name] != f.dataType]
        if other:
            raise ValueError(f"{name} declares other types for {other}")
        more = [f for f in schema.fields if f.name not in known]
        if more:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(map(column, more))})")
    if partition_by:
        spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)


def read_declared(spark: SparkSession, name: str | None, path: str, fmt: str = DEFAULT_FORMAT) -> DataFrame:
    """The table at ``path`` with the schema declared for it: no footer is read to find it.
    Without a declaration the files' schemas are merged (S11)."""
    if not name or not table_exists(spark, name):
        return read_table(spark, path, fmt, merge_schema=True)
    return spark.read.format(fmt).schema(spark.table(name).schema).load(path)


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str, fmt: str = DEFAULT_FORMAT) -> bool:
    """S3 for paths: is there a data file below the path?  Asked of the file system, so an
    absent table costs no failed read; one that is there but unreadable fails when read."""
    p, fs = _file_system(spark, path)
    if not fs.exists(p):
        return False
    files, root = fs.listFiles(p, True), fs.makeQualified(p).toString().rstrip("/")
    while files.hasNext():
        below = files.next().getPath().toString()[len(root) + 1:]
        # Hidden for Spark: names that start with a dot or, unless a partition's, an underscore.
        if not any(n.startswith(".") or n.startswith("_") and "=" not in n for n in below.split("/")):
            return True
    return False


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a directory through the file system that Spark reads it with."""
    p, fs = _file_system(spark, path)
    return fs.delete(p, True)


def move_directory(spark: SparkSession, fresh: str, path: str) -> None:
    """Put the directory ``fresh`` in place of ``path``, on the same file system."""
    (p, fs), (new, _) = (_file_system(spark, x) for x in (path, fresh))
    fs.delete(p, True)
    fs.mkdirs(p.getParent())
    if not fs.rename(new, p):
        raise OSError(f"cannot move {fresh} to {path}")


def replace_directory(spark: SparkSession, df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Write ``df`` beside ``path`` and then swap the two by renaming: the old table stays
    until the new one is complete."""
    token = uuid.uuid4().hex
    fresh, gone = f"{path}.new-{token}", f"{path}.old-{token}"
    with shuffles_released(df.sparkSession):
        df.write.format(fmt).save(fresh)
    (p, fs), (new, _), (old, _) = (_file_system(spark, x) for x in (path, fresh, gone))
    if fs.exists(p) and not fs.rename(p, old):
        raise OSError(f"cannot set {path} aside")
    if not fs.rename(new, p):
        raise OSError(f"cannot move {fresh} to {path}")
    fs.delete(old, True)
    spark.catalog.refreshByPath(path)


def table_exists(spark: SparkSession, name: str) -> bool:
    """S3 for catalog tables."""
    return spark.catalog.tableExists(name)


def write_table(df: DataFrame, path: str, fmt: str = DEFAULT_FORMAT, mode: str = "append",
                partition_by: Sequence[str] | None = None,
                dynamic_overwrite: bool = False, one_partition: bool = False) -> None:
    """Write a table directory, optionally partitioned.  With
    ``dynamic_overwrite`` an overwrite replaces only the partitions that receive rows.

    A partitioned write is preceded by a ``rebalance`` on the partition columns: rows
    of a table partition are grouped into few files instead of one file per task and
    partition, and AQE still splits a partition that is much larger than the rest.  Rows
    that all belong to ``one_partition`` are written where they are.
    """
    if partition_by and not one_partition:
        df = df.hint("rebalance", *partition_by)
    w = df.write.format(fmt).mode(mode)
    if fmt == "parquet":
        w = w.option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    with shuffles_released(df.sparkSession):
        w.save(path)


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    """S13."""
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`{loc}")


def table_location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else ""


def save_as_table(df: DataFrame, name: str, path: str, fmt: str = DEFAULT_FORMAT) -> None:
    """Replace a catalog table stored below ``path`` (its schema may change).

    Each version is written to a folder of its own; when it is complete, one change of the
    table's location publishes it.  Until then, and if the write fails, readers see the
    old version.  The version before is kept for those still reading it, older ones go.  New columns
    are declared first, so the table can be read at any moment; only a schema that loses or
    retypes a column drops the table and creates it again.  The table is EXTERNAL: its
    files survive a DROP.
    """
    spark = df.sparkSession
    fresh = f"{path.rstrip('/')}/version-{uuid.uuid4().hex}"
    with shuffles_released(spark):
        df.write.format(fmt).save(fresh)
    before = ""
    if table_exists(spark, name):
        before = table_location(spark, name)
        new, old = spark.read.format(fmt).load(fresh).schema, spark.table(name).schema
        now = {f.name: f.dataType for f in new.fields}
        if all(now.get(f.name) == f.dataType for f in old.fields):
            more = [f for f in new.fields if f.name not in old.names]
            if more:
                spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in more)})")
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{fresh}'")
        else:
            spark.sql(f"DROP TABLE {name}")
            before = ""
    if not table_exists(spark, name):
        spark.sql(f"CREATE TABLE {name} USING {fmt} LOCATION '{fresh}'")
    spark.catalog.refreshTable(name)
    kept = {x.rstrip("/").rsplit("/", 1)[-1] for x in (fresh, before)}
    p, fs = _file_system(spark, path)
    for entry in fs.listStatus(p):
        if entry.getPath().getName().startswith("version-") and entry.getPath().getName() not in kept:
            fs.delete(entry.getPath(), True)


def preview(df: DataFrame, n: int = 5) -> list:
    """The first rows, for logs."""
    return df.limit(n).collect()
