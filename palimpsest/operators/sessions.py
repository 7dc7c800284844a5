"""Grouping activity into sessions, incrementally.

A session is a run of one actor's events in which no step is longer than the gap.  Events and sessions are both *spans* (an event
has no length), so one primitive, ``merge_spans``, builds sessions from events and merges sessions that a late event bridges.  It
never puts an actor into one task: spans are chained inside (actor, time cell), where a hot actor is as spread as its activity;
what crosses cells goes through one summary row per actor and cell.

``SessionStore`` keeps the sessions of all batches so far.  A new batch's local sessions are compared with the stored sessions within
the gap, bridged ones merge, and only the periods that hold affected rows are rewritten and published by one rename.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest import commits
from palimpsest.functions.address import canonical_ip
from palimpsest.operators.common import micros, require_columns
from palimpsest.scratch import Scratch, delete_path

SPAN = ["actor", "start", "end", "events", "first_id", "last_id"]
SPAN_SCHEMA = "actor string, start long, end long, events long, first_id long, last_id long"
_AGGREGATES = (
    ("start", F.min), ("end", F.max), ("events", F.sum), ("first_id", F.min), ("last_id", F.max),
)


def _aggregates() -> list[Column]:
    return [f(name).alias(name) for name, f in _AGGREGATES]


def actor_of(contributor: str, address: str) -> Column:
    """The actor: the contributor, else the address however it is spelled, else null."""
    anonymous = F.concat(F.lit("ip:"), canonical_ip(F.col(address)))
    return F.when(F.col(contributor).isNotNull(), F.concat(F.lit("id:"), F.col(contributor).cast("string"))).otherwise(anonymous)


def event_spans(events: DataFrame, *, actor: Column, when: str, event_id: str) -> DataFrame:
    """Spans of single events; those without actor or time are left out.  Each row counts as one event."""
    require_columns(events, when, event_id)
    at = micros(F.col(when))
    spans = events.select(
        actor.alias("actor"), at.alias("start"), at.alias("end"), F.lit(1).cast("long").alias("events"),
        F.col(event_id).cast("long").alias("first_id"), F.col(event_id).cast("long").alias("last_id"),
    )
    return spans.where(F.col("actor").isNotNull() & F.col("start").isNotNull())


def merge_spans(spans: DataFrame, gap: int, cell: int, scratch: Scratch) -> DataFrame:
    """Merge spans of one actor that are at most ``gap`` microseconds apart; ``cell`` is the length of a time cell.

    Inside a cell at most ``cell / gap + 1`` chains remain, so every later step works on bounded groups.
    """
    in_cell = Window.partitionBy("actor", "cell")
    ordered = in_cell.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.col("start") > F.max("end").over(ordered) + gap, F.lit(True))
    local = (
        spans.withColumn("cell", F.floor(F.col("start") / cell).cast("long"))
        .withColumn("opens", opens.cast("int"))
        .withColumn("chain", F.sum("opens").over(in_cell.orderBy("start", "end").rowsBetween(Window.unboundedPreceding, Window.currentRow)))
        .groupBy("actor", "cell", "chain")
        .agg(*_aggregates())
    )
    local = scratch.write(local.drop("chain"), "chains")

    before = Window.partitionBy("actor").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = local.groupBy("actor", "cell").agg(F.max("end").alias("cell_end"), F.min("start").alias("cell_start"))
    reach = cells.withColumn("carry", F.max("cell_end").over(before)).where(F.col("cell_start") <= F.col("carry") + gap)
    marked = scratch.write(
        local.join(reach.select("actor", "cell", "carry"), ["actor", "cell"], "left").withColumn(
            "linked", F.coalesce(F.col("start") <= F.col("carry") + gap, F.lit(False))
        ).drop("carry"),
        "marked",
    )
    heads = marked.groupBy("actor", "cell").agg(
        F.max(F.when(~F.col("linked"), F.col("start"))).alias("head"), F.max("linked").alias("has_linked")
    )
    heads = heads.withColumn("last_head", F.last("head", ignorenulls=True).over(before)).where("has_linked")
    linked = marked.where("linked").join(heads.select("actor", "cell", "last_head"), ["actor", "cell"])
    linked = linked.select(*SPAN, F.col("last_head").alias("head"))
    whole = marked.where(~F.col("linked")).select(*SPAN, F.col("start").alias("head")).unionByName(linked)
    merged = whole.groupBy("actor", "head").agg(*_aggregates()).drop("head").select(*SPAN)
    out = scratch.write(merged, "merged")
    scratch.drop(local)
    scratch.drop(marked)
    return out


class SessionStore:
    """Sessions of all batches so far, below ``root``, partitioned by the period of their start.

    A version lists the directory of every period, with the first start and the last end in it.  A batch reads only periods whose
    sessions its own can meet, writes new directories for those it changes, and publishes one new version: readers see all of a batch or
    nothing, a batch that fails midway is simply applied again, and of two batches at a time the second fails with ``Conflict``.
    Events of a batch must not have been in an earlier one (drop redeliveries first).
    """

    def __init__(
        self, spark: SparkSession, root: str, gap_seconds: int = 3600, cell_seconds: int = 86_400, period: str = "yyyy-MM", rows_per_file: int = 2_000_000
    ):
        self.spark, self.root, self.period, self.rows_per_file = spark, root.rstrip("/"), period, rows_per_file
        self.gap, self.cell = gap_seconds * 1_000_000, cell_seconds * 1_000_000

    def _read(self, periods: list[dict]) -> DataFrame:
        paths = sorted(f"{self.root}/{p['path']}" for p in periods)
        return self.spark.read.schema(SPAN_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], SPAN_SCHEMA)

    def sessions(self) -> DataFrame:
        """The published sessions: actor, start and end (microseconds), events, first_id, last_id."""
        return self._read(list(commits.latest(self.spark, self.root)[1].values()))

    def _cells(self, spans: DataFrame, pad: int) -> DataFrame:
        first, last = F.floor((F.col("start") - pad) / self.cell), F.floor((F.col("end") + pad) / self.cell)
        return spans.withColumn("cell", F.explode(F.sequence(first.cast("long"), last.cast("long"))))

    def _extents(self, spans: DataFrame) -> dict[str, tuple[int, int, int]]:
        """Per period of the start: first start, last end, and number of spans; one row per period."""
        period = F.date_format(F.timestamp_micros("start"), self.period).alias("period")
        found = spans.groupBy(period).agg(F.min("start"), F.max("end"), F.count(F.lit(1))).collect()
        return {r[0]: (r[1], r[2], r[3]) for r in found}

    def apply(self, batch: DataFrame) -> None:
        """Merge one batch of event spans into the store and publish."""
        scratch = Scratch(self.spark, "sessions")
        base, stored = commits.latest(self.spark, self.root)
        merged = merge_spans(batch, self.gap, self.cell, scratch)
        extents = self._extents(merged)
        met = {
            n: p for n, p in stored.items()
            if any(p["first"] <= last + self.gap and first - self.gap <= p["last"] for first, last, _ in extents.values())
        }
        touched, affected = None, set(extents)
        if met:
            near = self._cells(merged, self.gap).select("actor", "cell").distinct()
            old = self._cells(self._read(list(met.values())), 0)
            touched = scratch.write(old.join(near, ["actor", "cell"], "left_semi").select(*SPAN).distinct(), "touched")
            merged = merge_spans(merged.unionByName(touched), self.gap, self.cell, scratch)
            affected = set(self._extents(merged.unionByName(touched)))
        changed = affected & set(stored)
        if changed:  # the other sessions of these periods are written again beside the new ones
            kept = self._read([stored[n] for n in changed])
            if touched is not None:
                kept = kept.join(touched.select("actor", "start"), ["actor", "start"], "left_anti")
            merged = scratch.write(merged.unionByName(kept), "whole")
            extents = self._extents(merged)
        version = f"data-{uuid.uuid4().hex}"
        files = {n: -(-size // self.rows_per_file) for n, (_, _, size) in extents.items()}
        out = merged.withColumn("period", F.date_format(F.timestamp_micros("start"), self.period))
        salt = F.pmod(F.xxhash64("actor", "start"), F.lit(max(files.values(), default=1)))
        out.repartition(max(1, sum(files.values())), "period", salt).write.partitionBy("period").parquet(f"{self.root}/{version}")
        content = {n: p for n, p in stored.items() if n not in changed}  # one whose sessions all moved gets no rows
        content |= {n: {"path": f"{version}/period={n}", "first": a, "last": z} for n, (a, z, _) in extents.items()}
        commits.publish(self.spark, self.root, base, content)
        delete_path(self.spark, scratch.base)

    def expire(self, keep: int = 2) -> list[str]:
        """Remove the versions before the last ``keep`` and what only they hold."""
        return commits.expire(self.spark, self.root, lambda s: [p["path"] for p in s.values()], keep)
