"""Streaming load: every new day file is merged into the lake.

A record that cannot be used is stored as a reject and does not stop the stream; a batch that was merged is
known by its number, which the lake keeps with the version; what a run did becomes a run record.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from listlake.operators.rejects import records, split_rejects, store_rejects
from listlake.operators.runs import append_run, run_record
from listlake.schemas import LAKE
from listlake.session import discard
from listlake.sources.daily_csv import LENIENT, MIN_BYTES, REJECT, with_rejects
from listlake.sources.lake import LakeTable

FILES_PER_BATCH = 1000
SEEN = "day_files"
ORDER = ["_modified", "_file"]


def stream_day_files(
    spark: SparkSession,
    raw_root: str,
    schema: T.StructType = LAKE,
    files_per_batch: int = FILES_PER_BATCH,
    min_bytes: int = MIN_BYTES,
) -> DataFrame:
    """Stream of records of new files below ``raw_root``, with the file they came from.

    Headers and records that cannot be read are among them, see ``sources.daily_csv.LENIENT``. A rewritten
    day has new file names, so it is picked up again; other objects in the bucket are outside the path.
    """
    return (
        spark.readStream.schema(with_rejects(schema))
        .options(**LENIENT)
        .option("maxFilesPerTrigger", files_per_batch)
        .option("pathGlobFilter", "*.csv")
        .csv(raw_root)
        .select(
            *schema.names,
            REJECT,
            F.col("_metadata.file_modification_time").alias("_modified"),
            F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_size").alias("_bytes"),
        )
        .where(F.col("_bytes") >= min_bytes)
        .drop("_bytes")
    )


class RunRecorder(StreamingQueryListener):
    """Writes a run record for each batch of one stream: what its plan observed, less the rejects that were
    stored; and one more when the stream fails."""

    def __init__(self, spark: SparkSession, name: str, path: str) -> None:
        self.spark, self.name, self.path = spark, name, path
        self.rejected: dict[int, int] = {}
        self.query: str | None = None
        self.ended = threading.Event()

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.query = str(event.id)

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name != self.name or SEEN not in progress.observedMetrics:
            return
        seen = progress.observedMetrics[SEEN]["records"]
        lost = self.rejected.pop(progress.batchId, 0)
        if seen:
            self._write(f"{self.query}/{progress.batchId}", "success", f"{seen} records read, {lost} rejected", seen - lost, lost)

    def onQueryTerminated(self, event):
        if str(event.id) != self.query:
            return
        try:
            if event.exception:
                self._write(f"{self.query}/{event.runId}", "error", event.exception[:1000], None, None)
        finally:
            self.ended.set()

    def _write(self, run_id: str, status: str, message: str, loaded: int | None, lost: int | None) -> None:
        append_run(run_record(self.spark, run_id, status, message, loaded, rejected_rows=lost), self.path)


def stream_file_ingest(
    spark: SparkSession,
    raw_root: str,
    lake: LakeTable,
    checkpoint: str,
    schema: T.StructType = LAKE,
    after_merge: Callable[[DataFrame, int], None] | None = None,
    files_per_batch: int = FILES_PER_BATCH,
    once: bool = True,
    rejects: str | None = None,
    recorder: RunRecorder | None = None,
) -> StreamingQuery:
    """Merge new files batch by batch; ``once`` handles what is there and stops.

    A batch may hold several days with the same listing, the later file wins. Rejects go to
    ``<rejects>/query=<id>/batch=<n>`` (default ``<lake>-rejects``). A batch that is replayed after a failure
    stores the same rejects again; if the lake has it already, its rows are not merged a second time.
    """
    lake.create_if_absent()
    beside = rejects or f"{lake.root}-rejects"

    def merge(batch: DataFrame, batch_id: int) -> None:
        query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        # Files are parsed once; the records are read several times, so they are stored.
        batch, aside = lake.set_aside(batch)
        try:
            good, bad = split_rejects(batch, schema, lake.key, ORDER, "_file", files_per_batch)
            lost = store_rejects(bad, f"{beside}/query={query}/batch={batch_id}")
            if recorder:
                recorder.rejected[batch_id] = lost
            lake.merge(good, on_duplicate="last", order=ORDER, batch=(query, batch_id) if query else None)
            if after_merge:
                after_merge(good, batch_id)
        finally:
            discard(spark, aside)

    rows = stream_day_files(spark, raw_root, schema, files_per_batch).observe(SEEN, *records(schema))
    writer = rows.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    if recorder:
        writer = writer.queryName(recorder.name)
    return (writer.trigger(availableNow=True) if once else writer).start()


def ingest_and_record(
    spark: SparkSession, raw_root: str, lake: LakeTable, checkpoint: str, runs: str, wait: float = 120, **options
) -> None:
    """Merge the new files and append a run record per batch below ``runs``; returns when they are written."""
    recorder = RunRecorder(spark, f"ingest-{uuid.uuid4().hex}", runs)
    spark.streams.addListener(recorder)
    try:
        query = stream_file_ingest(spark, raw_root, lake, checkpoint, recorder=recorder, **options)
        try:
            query.awaitTermination()
        finally:
            recorder.ended.wait(wait)
    finally:
        spark.streams.removeListener(recorder)
