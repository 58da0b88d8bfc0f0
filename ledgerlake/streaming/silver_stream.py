"""Streaming raw transactions -> silver transactions.

readStream (CSV or parquet files, declared schema) -> event time as TIMESTAMP and
``withWatermark`` -> the validity rules of the batch silver job -> drop of exact copies
within the watermark -> batches, written beside the checkpoint -> upsert by key into the partitioned
silver table when the query has stopped (a run that was interrupted before leaves its batches to the next).  ``trigger(availableNow=True)`` processes what is there and stops, so
a scheduled job resumes from its checkpoint: a rerun over the same files adds nothing.

A copy is a row equal in all columns (the state keeps a 128-bit digest of each); two versions
of a key are not copies, the upsert keeps the newer one, in whatever order they arrive.
Rows that fail a rule go, as they were delivered and with the reason, to the quarantine,
by a second query over the same files with a checkpoint of its own.  Rows older than the watermark are
late: the stateful step drops them, and their number is in the result.  The state is kept
by RocksDB, not in the executors' heap.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.functions.rules import STREAM_WATERMARK
from ledgerlake.operators.incremental import upsert
from ledgerlake.operators.metrics import reject_counts
from ledgerlake.operators.windows import materialize
from ledgerlake.plans import quarantine
from ledgerlake.plans.silver import DERIVED, derived, total_order_for, valid
from ledgerlake.schemas import RAW_SCHEMAS
from ledgerlake.session import RELEASE, step_scope
from ledgerlake.sources.tables import delete_path, path_exists, read_table, write_table

#: Set while a query starts.  All progress reports are kept, to count late rows in them.
STREAM_CONF = {
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.numRecentProgressUpdates": "1000000",
    # A row count would cost a look-up per row; a commit writes what changed, not all of the state.
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # The shuffle files of a batch go when it ends.
    RELEASE: "true",
}

PARTITION_COLS = ["txn_year", "txn_month"]


def raw_transaction_stream(spark: SparkSession, source_dir: str, fmt: str = "parquet",
                           max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(RAW_SCHEMAS["transactions"]).format(fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(source_dir)


def silver_transaction_stream(raw: DataFrame, as_of=None,
                              watermark: str = STREAM_WATERMARK) -> DataFrame:
    """T-1/T-2: event time as TIMESTAMP, watermark, validation, drop of copies."""
    timed = (raw.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
                .withWatermark("timestamp", watermark))
    rows = valid("transactions", timed, as_of)
    digest = F.unhex(F.md5(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"})))
    # Derived columns are not shuffled: they are derived again.
    told = rows.select(*[c for c in rows.columns if c not in DERIVED["transactions"]], digest.alias("_copy"))
    told = told.dropDuplicatesWithinWatermark(["_copy"])
    made = derived("transactions", told, as_of)
    return told.select(*[made[c].alias(c) if c in made else F.col(c) for c in rows.columns])


def _keep_rejects(spark: SparkSession, raw: DataFrame, path: str, checkpoint_dir: str, as_of) -> dict:
    """The rows that fail a rule, one quarantine partition per batch; their number by reason."""
    counts: dict = {}

    def add(batch: DataFrame, batch_id: int) -> None:
        with step_scope(spark):
            rows = materialize(batch.withColumn(quarantine.LOAD_ID, F.lit(batch_id).cast("long")), "stream-rejects")
            for r in reject_counts(rows, "transactions").collect():
                counts[r["reject_reason"]] = counts.get(r["reject_reason"], 0) + r["rows"]
            quarantine.keep(rows, path, "stream")

    timed = raw.withColumn("timestamp", F.col("timestamp").try_cast("timestamp"))
    q = (quarantine.grade("transactions", timed, as_of, keep=()).where("reject_reason IS NOT NULL")
         .writeStream.foreachBatch(add).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return counts


def _merge_pending(spark: SparkSession, pending: str, sink_dir: str) -> None:
    """Upsert the batches that wait, those that an interrupted run left too.  By now the shuffle files of the batches
    are gone.  They go when they are merged; merged twice, they change nothing."""
    if not path_exists(spark, pending):
        return
    with step_scope(spark):
        rows = read_table(spark, pending).drop("batch_id")
        if not rows.isEmpty():
            upsert(spark, rows, sink_dir, keys=["txn_id"], order=total_order_for("transactions"), partition_by=PARTITION_COLS, stored=True)
    delete_path(spark, pending)


@dataclass
class StreamResult:
    path: str
    batches: int = 0
    read_rows: int = 0
    late_rows: int = 0
    rejected: dict = field(default_factory=dict)


def run_silver_stream(spark: SparkSession, source_dir: str, sink_dir: str,
                      checkpoint_dir: str, *, as_of=None, fmt: str = "parquet",
                      watermark: str = STREAM_WATERMARK,
                      max_files_per_trigger: int | None = None,
                      quarantine_dir: str | None = None) -> StreamResult:
    """T-3: run to the end of the available input and stop.  Rejected rows are kept below
    ``quarantine_dir`` if it is given."""
    raw = raw_transaction_stream(spark, source_dir, fmt, max_files_per_trigger)
    stream = silver_transaction_stream(raw, as_of, watermark)

    pending = f"{checkpoint_dir.rstrip('/')}-pending"

    def keep(batch: DataFrame, batch_id: int) -> None:
        # Written first: a batch of a stateful query can be read once only.  A repeated batch replaces itself.
        write_table(batch, f"{pending}/batch_id={batch_id}", mode="overwrite")

    before = {k: spark.conf.get(k, None) for k in STREAM_CONF}
    for k, v in STREAM_CONF.items():
        spark.conf.set(k, v)
    try:
        q = (stream.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint_dir)
                   .outputMode("append").trigger(availableNow=True).start())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    _merge_pending(spark, pending, sink_dir)
    out = StreamResult(sink_dir)
    if quarantine_dir:
        out.rejected = _keep_rejects(spark, raw, quarantine_dir, f"{checkpoint_dir.rstrip('/')}-rejects", as_of)
    for p in q.recentProgress:
        out.batches += 1
        out.read_rows += p["numInputRows"]
        out.late_rows += sum(op["numRowsDroppedByWatermark"] for op in p["stateOperators"])
    return out
