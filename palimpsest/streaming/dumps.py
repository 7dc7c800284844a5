"""Incremental loading of a directory of dump files, and streaming counterparts of the time-based operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from palimpsest.ingest import merge_pages
from palimpsest.runs import SUCCESS, RunLog
from palimpsest.sources.dump import read_namespaces, stream_dump
from palimpsest.sources.store import Store


def load_directory(spark: SparkSession, directory: str, root: str, checkpoint: str, files_per_trigger: int = 1) -> StreamingQuery:
    """Merge every new file of ``directory`` into the store, then stop; the files' namespaces first, and a run in the log per batch.

    The checkpoint remembers the files of finished batches.  A batch that is replayed after a failure merges the same pages again,
    which adds nothing; so each page is loaded exactly once.
    """
    store = Store(spark, root)
    log = RunLog(store)
    store.append_missing("namespace", read_namespaces(spark, directory), ["namespace_id"])

    def merge(batch: DataFrame, number: int) -> None:
        if not batch.take(1):
            return
        run, result = log.start(f"{directory}#{number}", 0, dt.datetime(1970, 1, 1)), SUCCESS
        try:
            merge_pages(store, batch, log=log, run=run)
        except Exception as e:
            result = str(e) or type(e).__name__
            raise
        finally:
            log.flush()
            log.complete(run, result)

    pages = stream_dump(spark, directory, files_per_trigger)
    return pages.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_sessions(events: DataFrame, *, actor: str, when: str, gap: str = "60 minutes", late: str = "1 day") -> DataFrame:
    """Sessions of a stream by session windows: (actor, start, end, events), each when the watermark has passed it.

    The window's end lies one gap after the last event; it is moved back to that event.  A step of exactly the gap stays in the session.
    """
    reach = f"{gap} 1 microsecond"  # a window does not hold its end
    grouped = events.withWatermark(when, late).groupBy(F.session_window(when, reach).alias("w"), F.col(actor).alias("actor"))
    counted = grouped.agg(F.count(F.lit(1)).alias("events"))
    return counted.select("actor", F.col("w.start").alias("start"), (F.col("w.end") - F.expr(f"INTERVAL {reach}")).alias("end"), "events")
