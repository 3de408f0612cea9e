"""Staging of landed events as a stream: the same rows as the batch, file by file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from forecourt.operators.upsert import upsert_partitions
from forecourt.plans.staging import STAGES, stage
from forecourt.schemas import RAW_EVENTS
from forecourt.sources.raw import LINES_FILES, either_name, with_source_file

ROCKS_DB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SPEC = STAGES["stg_engagement_events"]


def read_event_stream(
    spark: SparkSession,
    path: str,
    files: str = LINES_FILES,
    files_per_batch: int | None = None,
) -> DataFrame:
    """New event files below day folders, as raw rows."""
    reader = (
        spark.readStream.schema(f"{RAW_EVENTS}, `timestamp` string, event_date string")
        .option("pathGlobFilter", files)
    )
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return either_name(with_source_file(reader.json(path)), "event_timestamp", "timestamp")


def append_once(
    raw: DataFrame,
    out: str,
    checkpoint: str,
    keys: Sequence[str] = ("event_id", "event_timestamp"),
) -> StreamingQuery:
    """Append each event to ``out`` the first time it comes, then stop when all is read.

    The keys seen so far are Spark's keyed state, on disk beside the executors
    (RocksDB) and in the checkpoint: a micro-batch looks up its own keys and reads
    no earlier batch, so its cost does not grow with their number. There is no
    watermark, so an event counts as new however late it is and no key is ever
    forgotten; the state grows with the distinct keys. Rows with a NULL in a key
    are told apart like others. A micro-batch owns one folder, which a repetition
    writes again from the same files and the state before it, so a crash neither
    loses nor doubles rows. The number of state partitions is that of the shuffle
    when the checkpoint is made.
    """
    spark = raw.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKS_DB)

    def append(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return (
        raw.dropDuplicates(list(keys))
        .writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stage_event_stream(
    raw: DataFrame, table_root: str, checkpoint: str, staged_at: str | None = None
) -> StreamingQuery:
    """Upsert every micro-batch into the staged events, then stop when all is read.

    The checkpoint remembers which files are done. A batch repeated after a
    crash meets its own rows again and leaves the table as it is.
    """
    spark = raw.sparkSession
    guard = ("event_timestamp", "event_date")

    def upsert(batch: DataFrame, _: int) -> None:
        rows = stage(SPEC, batch, staged_at=staged_at)
        upsert_partitions(
            spark,
            table_root,
            SPEC.table,
            rows,
            SPEC.partition_column,
            by_month=False,
            guard=guard,
            verify_keys=False,
        )

    return (
        raw.writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
