"""Loading a dump: parse, derive, find what is needed, write users, pages, revisions and texts, publish together.

The load is idempotent: rows that are there are not written again, and nothing is visible before the commit.  A run that died is
simply repeated; resuming at a file position only saves reading.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import nullcontext
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.curate import RETAIN_EVERY, distinct_users, flag_where_staged, missing_rows, needed_revisions, upsert
from palimpsest.operators.common import is_short
from palimpsest.operators.derive import corrupt_pages, ingest_statistics, pages_table, revisions_table
from palimpsest.runs import CANCELED, SUCCESS, Canceled, RunLog
from palimpsest.scratch import Scratch
from palimpsest.sources.dump import file_status, read_dump, read_namespaces, read_range
from palimpsest.sources.store import Store

REVISION_KEYS = ["namespace_id", "page_id", "page_revision_id"]


@dataclass(frozen=True)
class Loaded:
    """What a load added: counts, pages without news, the report per page, and statistics over all that was parsed (one row)."""

    pages: int
    users: int
    revisions: int
    texts: int
    idle_pages: int = 0
    report: DataFrame | None = field(default=None, compare=False)
    statistics: DataFrame | None = field(default=None, compare=False)

    def plus(self, other: Loaded) -> Loaded:
        """Both loads together; the statistics have one row per range."""
        counts = (getattr(self, n) + getattr(other, n) for n in ("pages", "users", "revisions", "texts", "idle_pages"))
        return Loaded(*counts, self.report.unionByName(other.report), self.statistics.unionByName(other.statistics))


def page_report(needed: DataFrame, revisions: DataFrame, users: DataFrame) -> DataFrame:
    """Per page: revisions that a load added, completed and found unchanged, and users it added, pages without news included."""
    news = needed.join(F.broadcast(users.select("user_id")) if is_short(users) else users.select("user_id"), needed["contributor_id"] == users["user_id"], "left")
    fresh = news.groupBy("namespace_id", "page_id").agg(
        F.count_if("is_new").alias("revisions_added"), F.count_if(~F.col("is_new")).alias("revisions_completed"), F.count_distinct("user_id").alias("users_added")
    )
    total = revisions.groupBy("namespace_id", "page_id").agg(F.count(F.lit(1)).alias("revisions"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    joined = total.join(fresh, ["namespace_id", "page_id"], "left")
    counts = [zero(c) for c in ("revisions_added", "revisions_completed", "users_added")]
    existing = (F.col("revisions") - F.coalesce("revisions_added", F.lit(0)) - F.coalesce("revisions_completed", F.lit(0))).alias("revisions_existing")
    return joined.select("namespace_id", "page_id", *counts, existing)


def merge_pages(
    store: Store, pages: DataFrame, *, every: int = RETAIN_EVERY, compat: bool = False, log: RunLog | None = None, run: int | None = None
) -> Loaded:
    """Merge parsed pages into the store: users, pages, revisions and texts in one commit.

    Unknown revisions are appended; known ones that lacked their text get it, with length and flags.  A page's name and redirect are
    those of the last load.  Users keep the name they came with first.  Corrupt pages stop the load before anything is written.  The pages
    are parsed once.  A load that another one overtakes fails with ``Conflict`` and may be repeated.  Lengths of ``compat`` are UTF-16 units.
    """
    spark = store.spark
    scratch = Scratch(spark, "ingest")
    step = (lambda name: log.activity(run, name)) if log is not None else (lambda name: nullcontext({}))
    base = store.snapshot()
    with step("Read Page"):
        pages = scratch.write(pages, "pages")
        bad = corrupt_pages(pages).limit(5).collect()
    if bad:
        raise ValueError(f"corrupt pages: {[tuple(r) for r in bad]}")
    with step("Check existing PageRevisions") as done:
        revisions = scratch.write(revisions_table(pages, every=every, compat=compat, utf16=compat), "revisions")
        known = base.read("page_revision")
        columns = known.columns
        here = revisions.select("page_id").distinct()  # the store's rows of other pages are not grouped
        mine = known.join(here, "page_id", "left_semi")
        needed = scratch.write(needed_revisions(revisions, mine), "needed")
        done["completed"] = needed.count()
    with step("Merge Users") as done:
        users = missing_rows(distinct_users(needed.withColumnRenamed("contributor_id", "user_id"), user="user_id"), base.read("user"), ["user_id"])
        users = scratch.write(users, "users")
        done["completed"] = users.count()
    with step("Merge Text") as done:
        texts = needed.where(F.col("article_text").isNotNull()).select(*REVISION_KEYS, "article_text")
        texts = scratch.write(missing_rows(texts, base.read("page_revision_text"), REVISION_KEYS), "texts")
        done["completed"] = texts.count()
    fresh = needed.where("is_new").select(*columns)
    upgraded = needed.where(~F.col("is_new"))
    append = {"user": users, "page_revision_text": texts}
    replace = {}
    if upgraded.take(1):
        fields = ["text_available", "article_text_length", "text_deleted"]
        new = upgraded.select("page_revision_id", *[F.col(c).alias(f"__{c}") for c in fields], F.lit(True).alias("__up"))
        merged = known.join(new, "page_revision_id", "left")
        for c in fields:
            merged = merged.withColumn(c, F.when(F.col("__up"), F.col(f"__{c}")).otherwise(F.col(c)))
        replace["page_revision"] = flag_where_staged(merged.select(*columns), texts).unionByName(fresh)
    else:
        append["page_revision"] = fresh
    with step("Insert Page") as done:
        old_pages = base.read("page")
        incoming = scratch.write(pages_table(pages), "pages-table")
        new_pages = missing_rows(incoming, old_pages, ["page_id"]).count()
        changed = incoming.join(
            old_pages.select("page_id", F.col("page_name").alias("n"), F.col("redirect_title").alias("t")), "page_id"
        ).where(~(F.col("n").eqNullSafe(F.col("page_name")) & F.col("t").eqNullSafe(F.col("redirect_title"))))
        if new_pages or changed.take(1):
            values = ["namespace_id", "page_name", "redirect_title"]
            replace["page"] = upsert(old_pages, incoming, ["page_id"], values).select(*old_pages.columns)
        done["completed"] = new_pages
    with step("Merge PageRevisions") as done:
        report = scratch.write(page_report(needed, revisions, users), "report")
        idle = report.where("revisions_added = 0 AND revisions_completed = 0 AND users_added = 0").count()
        loaded = Loaded(new_pages, users.count(), fresh.count(), texts.count(), idle, report, ingest_statistics(pages))
        store.commit(replace=replace, append=append, base=base, reads=["page", "page_revision", "page_revision_text", "user"])
        done["completed"] = loaded.revisions
    return loaded


def _ranges(size: int, parts: int) -> list[tuple[int, int]]:
    step = max(1, -(-size // max(1, parts)))
    return [(a, min(a + step, size)) for a in range(0, size, step)] or [(0, 0)]


def ingest(
    spark: SparkSession, path: str, root: str, *, every: int = RETAIN_EVERY, compat: bool = False, chunk_bytes: int | None = None,
    progress: Callable[[float], None] | None = None,
) -> Loaded:
    """Load one dump file into the store below ``root``, with a run in its log; namespaces first.

    The file is known by its full path, size and time, on any file system.  With ``chunk_bytes`` it is loaded range by range: after each
    range the run's position is reported and ``progress`` called with the percentage, and a run that dies is resumed by the next one at
    the last position that was reported.  Ranges overlap by nothing: a page belongs to the range in which its entry begins.  The run's
    result is 'Success', 'Canceled' or the error's text; an error is raised again, and a cancelled load's jobs are stopped.  A file
    that was loaded is refused.
    """
    store = Store(spark, root)
    log = RunLog(store)
    files = file_status(spark, path)
    if len(files) != 1:
        raise FileNotFoundError(f"{path} names {len(files)} files; one is loaded at a time")
    name, (size, when) = next(iter(files.items()))
    run = log.start(name, size, when)
    result, group = SUCCESS, f"ingest-{uuid.uuid4().hex}"
    spark.sparkContext.setJobGroup(group, f"load {name}", interruptOnCancel=True)
    try:
        begin = log.resume_position(run, name, size, when)
        with log.activity(run, "Insert Namespaces"):
            store.append_missing("namespace", read_namespaces(spark, name), ["namespace_id"])
        splittable = not name.endswith((".gz", ".bz2", ".zst", ".xz"))
        ranges = _ranges(size, -(-size // chunk_bytes)) if chunk_bytes and splittable else [(0, size)]
        total = None
        for low, high in ranges:
            if high <= begin and high < size:
                continue
            pages = read_dump(spark, name) if len(ranges) == 1 else read_range(spark, name, low, high)
            loaded = merge_pages(store, pages, every=every, compat=compat, log=log, run=run)
            total = loaded if total is None else total.plus(loaded)
            log.report(run, high)
            if progress is not None:
                progress(round(100.0 * high / size, 4) if size else 100.0)
        return total
    except (KeyboardInterrupt, Canceled):
        result = CANCELED
        spark.sparkContext.cancelJobGroup(group)
        raise
    except Exception as e:
        result = str(e) or type(e).__name__
        raise
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        log.flush()
        log.complete(run, result)
