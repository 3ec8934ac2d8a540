"""Incremental raw ingest as an available-now stream.

The stream's checkpoint remembers which files were processed, so a rerun
only sees new files.  ``foreachBatch`` is at-least-once: a batch is committed
under the stream's and its own number, so one replayed after a failure does not
land twice.  Each batch is also anti-joined against the target, which other
jobs may have written to.
"""

from __future__ import annotations

import threading
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from matchlake.plans.ingest import IngestReport, ensure_tables, mark_known_bad, new_documents, write_batch
from matchlake.sources import loaded_keys
from matchlake.sources.files import JSON_NAME_GLOB, relative_name


def json_file_stream(spark: SparkSession, root: str, name_glob: str = JSON_NAME_GLOB,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming ``(file_name, content)``: one row per new file under ``root``."""
    # a back-filled file keeps its old time: no age is too old (the anti-join guards against repeats)
    reader = spark.readStream.option("maxFileAge", "36500d")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.text(root, wholetext=True, pathGlobFilter=name_glob, recursiveFileLookup=True)
    return raw.select(relative_name(F.col("_metadata.file_path"), root, spark).alias("file_name"),
                      F.col("value").alias("content"))


class BatchTotals(StreamingQueryListener):
    """What the batches of streams have observed, by (stream, batch); ``wait``
    returns one stream's rows once it has ended."""

    def __init__(self):
        self._rows: dict[tuple[str, int], dict] = {}
        self._ended: dict[str, threading.Event] = {}
        self._lock = threading.Lock()

    def _event(self, stream: str) -> threading.Event:
        with self._lock:
            return self._ended.setdefault(stream, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802 - the listener's interface
        pass

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        seen = {k: v for row in p.observedMetrics.values() for k, v in row.asDict().items()}
        if seen:
            self._rows[str(p.id), p.batchId] = seen

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._event(str(event.id)).set()

    def wait(self, stream: str, seconds: float = 60) -> dict[int, dict]:
        if not self._event(stream).wait(seconds):
            raise TimeoutError(f"no end of stream {stream} was reported")
        return {batch: row for (own, batch), row in sorted(self._rows.items()) if own == stream}


@dataclass
class StreamReport(IngestReport):
    """Counts of all batches of a run, and of each: batch, received, loaded, quarantined."""
    batches: list[dict] = field(default_factory=list)


def ingest_stream(spark: SparkSession, candidates: DataFrame, target: str, quarantine: str,
                  checkpoint: str) -> StreamReport:
    """Run the stream of candidate documents until the available input is done;
    returns the counts of its batches: rows received as the stream's listener
    reports them, rows loaded and quarantined as their writes counted them.

    A file fixed under the same name is not read again by the stream, whose
    checkpoint knows the name; the batch ingest reads it again.
    """
    total, totals = StreamReport(0, 0), BatchTotals()
    ensure_tables(spark, target, quarantine)

    def land(batch: DataFrame, epoch_id: int) -> None:
        stream = spark.read.json(f"{checkpoint}/metadata", schema="id string").first()["id"]
        fresh = mark_known_bad(new_documents(batch, loaded_keys(spark, target)), quarantine)
        report = write_batch(fresh, target, quarantine, f"{stream}-{epoch_id}")
        total.loaded += report.loaded
        total.quarantined += report.quarantined
        total.batches.append({"batch": epoch_id, "loaded": report.loaded, "quarantined": report.quarantined})

    spark.streams.addListener(totals)
    try:
        q = (candidates.observe("ingest", F.count(F.lit(1)).alias("received")).writeStream.foreachBatch(land)
             .option("checkpointLocation", checkpoint)
             .trigger(availableNow=True)
             .start())
        q.awaitTermination()
        received = totals.wait(str(q.id))
    finally:
        spark.streams.removeListener(totals)
    for row in total.batches:
        row["received"] = received.get(row["batch"], {}).get("received", 0)
    return total
