"""The run log: runs, forward-only progress, timed activities, and from where a run resumes."""

from __future__ import annotations

import datetime as dt
import os
import socket
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.commits import Conflict
from palimpsest.schemas import RESULT_CAP, TABLES
from palimpsest.sources.store import Snapshot, Store

SUCCESS, CANCELED = "Success", "Canceled"
#: Names of the timed steps of a load.
ACTIVITIES = (
    "Read Page", "Insert Page", "Check existing PageRevisions", "Bulk Insert Users", "Merge Users", "Bulk Insert PageRevisions",
    "Merge PageRevisions", "Bulk Insert Text", "Merge Text", "Insert Namespaces",
)


class AlreadyLoaded(Exception):
    """The same edition of the file was loaded by an earlier run."""


class Canceled(Exception):
    """Raised to stop a load; the run ends with the result 'Canceled'."""


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class RunLog:
    """Run bookkeeping in the tables run, run_progress and activity of a store.  These tables have a few rows per run."""

    def __init__(self, store: Store):
        self.store, self.spark, self._steps = store, store.spark, []

    def _again(self, change) -> object:
        """Call ``change`` with a snapshot until no other writer comes in between; what it returns."""
        while True:
            try:
                return change(self.store.snapshot())
            except Conflict:
                continue

    def _row(self, table: str, row: tuple) -> DataFrame:
        return self.spark.createDataFrame([row], TABLES[table])

    def start(self, file_name: str, file_size: int, file_time: dt.datetime) -> int:
        """Record a new run and return its number; two runs that start at once get two numbers."""

        def add(base: Snapshot) -> int:
            run = (base.read("run").agg(F.max("run_id")).first()[0] or 0) + 1
            row = self._row("run", (run, socket.gethostname(), os.getpid(), file_name, file_size, file_time, _now(), None, None))
            self.store.commit(append={"run": row}, base=base, reads=["run"])
            return run

        return self._again(add)

    def complete(self, run_id: int, result: str | None) -> None:
        """Set the run's end and the first 1024 characters of its result."""
        mine, end = F.col("run_id") == run_id, F.lit(_now()).cast("timestamp")
        text = F.lit(None if result is None else result[:RESULT_CAP]).cast("string")

        def close(base: Snapshot) -> None:
            run = base.read("run").withColumns({"end_time": F.when(mine, end).otherwise(F.col("end_time")), "result": F.when(mine, text).otherwise(F.col("result"))})
            self.store.commit(replace={"run": run}, base=base)

        self._again(close)

    def report(self, run_id: int, position: int, page_id: int | None = None) -> None:
        """Raise the run's high-water mark; a position that is not higher changes nothing."""

        def raise_mark(base: Snapshot) -> None:
            progress = base.read("run_progress")
            known = progress.where(F.col("run_id") == run_id).agg(F.max("file_position")).first()[0]
            if known is not None and known >= position:
                return
            row = self._row("run_progress", (run_id, _now(), position, page_id))
            self.store.commit(replace={"run_progress": progress.where(F.col("run_id") != run_id).unionByName(row)}, base=base)

        self._again(raise_mark)

    def resume_position(self, run_id: int, file_name: str, file_size: int, file_time: dt.datetime) -> int:
        """Where to go on: the furthest report of all other runs of this edition (file name, size and time), 0 without one.

        Any successful run of the edition raises ``AlreadyLoaded``.
        """
        same = (F.col("source_file_name") == file_name) & (F.col("source_file_size") == file_size)
        same = same & (F.col("source_file_timestamp") == F.lit(file_time).cast("timestamp"))
        runs = self.store.read("run").where(same & (F.col("run_id") != run_id))
        if runs.where(F.col("result").startswith(SUCCESS)).take(1):
            raise AlreadyLoaded(os.path.basename(file_name))
        return runs.join(self.store.read("run_progress"), "run_id").agg(F.max("file_position")).first()[0] or 0

    @contextmanager
    def activity(self, run_id: int, name: str, work: int | None = None):
        """Time a step, also where it fails; ``flush`` writes the steps of a run at once.  Yields a dict for 'completed'."""
        began, clock, result, done = _now(), time.monotonic(), SUCCESS, {}
        try:
            yield done
        except BaseException as e:
            result = str(e)[:RESULT_CAP]
            raise
        finally:
            millis = int((time.monotonic() - clock) * 1000)
            self._steps.append((run_id, None, None, name, began, None, None, work, done.get("completed", work), _now(), millis, result))

    def flush(self) -> None:
        """Append the timed steps so far to the activity table."""
        steps, self._steps = self._steps, []
        if not steps:
            return

        def add(base: Snapshot) -> None:
            last = dict(map(tuple, base.read("activity").groupBy("run_id").agg(F.max("activity_id")).collect()))
            rows = []
            for step in steps:
                last[step[0]] = (last.get(step[0]) or 0) + 1
                rows.append((step[0], last[step[0]], *step[2:]))
            self.store.commit(append={"activity": self.spark.createDataFrame(rows, TABLES["activity"])}, base=base, reads=["activity"])

        self._again(add)

    def runs(self) -> DataFrame:
        return self.store.read("run").orderBy(F.desc("run_id"))
