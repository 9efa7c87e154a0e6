"""The ingest job: message stream to raw table, rollups, quarantine and metrics."""

from __future__ import annotations

import time

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from filetide.operators.normalize import normalize_records
from filetide.operators.rollup import RollupSpec
from filetide.session import prepare
from filetide.storage import layout, numbers, tables
from filetide.streaming import metrics
from filetide.streaming.maintain import AS_INSERTED, EXACT, SPECS, maintain_rollups, refresh


def commit_batch(rows: DataFrame, batch_id: int, root: str, mode: str | None = EXACT,
                 specs: tuple[RollupSpec, ...] = SPECS, refresh_every: int = 1,
                 max_days: int | None = None, owner: str = "upkeep", on_step: numbers.Step | None = None) -> None:
    """Stores one batch of normalised, versioned rows everywhere it belongs.

    Every step replaces what the same batch wrote before, so a batch that failed half way is
    simply done again. ``refresh_every`` spreads the cost of exact rollups over several batches.
    A batch may have any number of days, unless ``max_days`` sets a limit.
    """
    spark = prepare(rows.sparkSession)
    step = on_step or (lambda name: None)
    # Streams run with adaptive execution off; the writes below rely on it to balance days.
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    started = time.monotonic()
    kept = tables.as_raw(rows).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        days = tables.touched_days(kept, limit=max_days)
        tables.append_raw(kept, root, batch_id)
        step("written")
        numbers.note_stored(spark, root, batch_id)
        numbers.renew(spark, root, batch_id)
        step("stored")
        tables.write_quarantine(kept, root, batch_id)
        if mode == AS_INSERTED:
            maintain_rollups(kept, batch_id, root, mode, specs, days)
        elif mode == EXACT and refresh_every == 1:
            refresh(spark, root, days, specs, batch_id, owner)
        elif mode == EXACT and (batch_id + 1) % refresh_every == 0:
            refresh(spark, root, None, specs, batch_id, owner)
        step("counted")
        metrics.record_batch(kept, batch_id, root)
        metrics.record_commit(spark, batch_id, root, time.monotonic() - started, True)
    except Exception:
        metrics.record_commit(spark, batch_id, root, time.monotonic() - started, False)
        raise
    finally:
        kept.unpersist()


def store_batch(rows: DataFrame, batch_id: int, root: str, checkpoint: str, on_step: numbers.Step | None = None,
                **options) -> int:
    """Stores a checkpoint's micro-batch under a number of its own, which it returns. If that was taken over
    meanwhile by others, who thought the job lost, the batch is stored again under another."""
    spark = rows.sparkSession
    while True:
        number = numbers.claim(spark, root, checkpoint, batch_id, on_step)
        commit_batch(rows, number, root, owner=numbers.owner_of(checkpoint), on_step=on_step, **options)
        if numbers.release(spark, root, number) or number not in layout.voided(spark, root):
            return number


def write_raw(messages: DataFrame, root: str, checkpoint: str, trigger: dict | None = None,
              **options) -> StreamingQuery:
    """Starts the job on a stream of messages. The stream's offsets are committed only after a
    batch is stored, which is the acknowledgement.

    ``trigger`` takes what ``DataStreamWriter.trigger`` takes; the default is one second. Several
    checkpoints may feed one table: each batch claims a number of its own, and keeps it over restarts.
    """
    spark = prepare(messages.sparkSession)
    rows = tables.with_version(normalize_records(messages, observed="messages"), F.current_timestamp())

    def commit(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, root, checkpoint, **options)

    return (
        rows.writeStream.foreachBatch(commit)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "1 second"}))
        .start()
    )
