"""A folder of arriving CSV files, kept in the fact table and its summaries."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.cleaning import judged
from ..operators.sinks import (
    IngestionResult,
    Sink,
    append_new,
    fact_rows,
    rejects_of,
    store_judged,
)
from ..plans.state import refresh_changes
from ..session import scratch
from ..sources.commits import commits, try_commit
from ..sources.csv_lines import MAX_BATCH_BYTES, POSITION, drop_header, stream_lines, with_fields


def start_ingest(
    spark: SparkSession,
    directory: str,
    table: str,
    rejects: str,
    checkpoint: str,
    skip_header: bool = True,
    max_files_per_trigger: int | None = None,
    every: str | None = None,
    sink: Sink | None = None,
    after_batch: Callable[[SparkSession], object] | None = None,
    truncate: bool = False,
    max_bytes_per_trigger: int = MAX_BATCH_BYTES,
    metrics: str | None = None,
) -> StreamingQuery:
    """Clean each batch of new files and insert its new keys.

    The fact table is the state: a key seen in any earlier file is ignored,
    however long ago, and a replayed batch adds nothing twice. Older files come
    first within and between batches, so the size of a batch changes no result.
    Rejects of a batch replace those of its earlier attempt. ``metrics`` names a folder that
    gets one entry per batch, see ``stream_metrics``. With ``every`` the query keeps
    running at that pace; without it, it stops when the folder is read.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        session, written = batch.sparkSession, 0
        with scratch(session):
            lines = drop_header(batch) if skip_header else batch
            stored, read, turned_away = store_judged(lines, truncate)
            rejects_of(stored).write.mode("overwrite").parquet(f"{rejects}/batch={batch_id}")
            if sink is None:
                written = append_new(fact_rows(stored), table, POSITION, read - turned_away)
            else:  # from the files, which a sink may read later than the stored lines
                rows = fact_rows(judged(with_fields(lines), POSITION, truncate))
                sink(rows.drop(*POSITION))
            if metrics is not None:
                counts = {"rows_read": read, "rows_rejected": turned_away}
                seconds = time.monotonic() - started
                note = counts | {"rows_written": written, "elapsed_ms": int(seconds * 1000)}
                try_commit(session, metrics, batch_id + 1, "", **note)
            if after_batch is not None:
                after_batch(session)

    lines = stream_lines(spark, directory, max_files_per_trigger, max_bytes_per_trigger)
    writer = lines.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    if every is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=every).start()


def stream_metrics(spark: SparkSession, metrics: str) -> list[IngestionResult]:
    """What each batch read, rejected and wrote, in order.

    A batch that is tried again keeps the entry it has; one that failed between its rows and
    its entry counts its rows as known, since they are.
    """
    results, before = [], 0
    for entry in commits(spark, metrics):
        result = IngestionResult(**entry.note, rows_before=before)
        results.append(result)
        before = result.rows_after
    return results


def refreshing(table: str, folder: str, variant: str = "service") -> Callable[[SparkSession], None]:
    """For ``after_batch``: bring the summaries up to the rows that the batch has added."""

    def run(session: SparkSession) -> None:
        refresh_changes(session, table, folder, variant)

    return run
