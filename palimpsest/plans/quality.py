"""Queries of the general data operators (problems 3 to 7) over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.changes import done_entries, pages_to_load
from palimpsest.operators.common import first_delivery
from palimpsest.operators.hierarchy import ancestor_pairs, hierarchy
from palimpsest.operators.orphans import Reference, orphan_references, orphan_report
from palimpsest.operators.sessions import SessionStore, actor_of, event_spans
from palimpsest.operators.weighted import compress, heavy_keys, weighted_percentile, weighted_totals
from palimpsest.plans.tables import table
from palimpsest.scratch import Scratch

SESSION_GAP_SECONDS = 3600
HEAVY_SHARE = 0.01
SESSION_BATCHES = 3


# --- Problem 3: references to records that do not exist -------------------------------------------------------------------------
def _orphans(spark: SparkSession, d: str) -> DataFrame:
    references = [
        Reference("PageID", "page_id", table(spark, d, "wiki_page"), "page_id", "loaded_at", "deleted_at"),
        Reference("ContributorID", "contributor_id", table(spark, d, "wiki_user"), "user_id", "loaded_at", "deleted_at"),
        Reference("NamespaceID", "namespace_id", table(spark, d, "wiki_namespace"), "namespace_id"),
    ]
    revisions = table(spark, d, "page_revision")
    return orphan_references(revisions, references, child_id="page_revision_id", keep=["revision_when"])


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("page_revision_id", "ref_field", "ref_status")


def p3_orphans_by_month(spark: SparkSession, d: str) -> DataFrame:
    return orphan_report(_orphans(spark, d), "revision_when")


# --- Problem 4: histories ------------------------------------------------------------------------------------------------------
def _history(spark: SparkSession, d: str, with_paths: bool) -> DataFrame:
    return hierarchy(
        table(spark, d, "page_revision"), node="page_revision_id", parent="parent_page_revision_id", order="loaded_at",
        locality=["page_id"], with_paths=with_paths,
    )


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    nodes = _history(spark, d, False)
    return nodes.where(F.col("cycle_id").isNotNull()).select(F.col("node").alias("page_revision_id"), "cycle_id")


def p4_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    nodes = _history(spark, d, True)
    path = F.when(F.col("path").isNotNull(), F.array_join(F.col("path").cast("array<string>"), "/"))
    return nodes.select(F.col("node").alias("page_revision_id"), "root", "depth", path.alias("path"), "cycle_id")


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    return ancestor_pairs(_history(spark, d, True))


# --- Problem 5: a few keys hold most rows --------------------------------------------------------------------------------------
KEY_FIELDS = (("PageID", "page_id"), ("ContributorID", "contributor_id"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    revisions = table(spark, d, "page_revision")
    total = revisions.count()
    found = []
    for field, column in KEY_FIELDS:
        weights = compress(revisions, column, "article_text_length")
        keys = heavy_keys(weights, total, HEAVY_SHARE)
        found.append(keys.select(F.lit(field).alias("key_field"), F.col("key").cast("long").alias("key_value")))
    return found[0].unionByName(found[1])


def _key_results(spark: SparkSession, d: str, column: str) -> DataFrame:
    """Per key of ``column``: revisions (each once), first and last time, and mean, median and commonest text length."""
    revisions = table(spark, d, "page_revision").select(
        "page_revision_id", "loaded_at", "page_id", "contributor_id", "revision_when", "article_text_length"
    )
    rows = first_delivery(revisions, "page_revision_id")
    when = {"first_when": F.min("revision_when"), "last_when": F.max("revision_when")}
    weights = Scratch(spark, "weighted").write(compress(rows, column, "article_text_length", when), "weights")
    totals = weighted_totals(weights, [F.min("first_when").alias("first_when"), F.max("last_when").alias("last_when")])
    median = weighted_percentile(weights, 0.5, "median_length")
    return totals.join(median, "key", "left").select(
        F.col("key").alias(column),
        F.col("rows").alias("revisions"),
        "first_when",
        "last_when",
        F.round("value_mean", 6).alias("mean_length"),
        "median_length",
        F.col("value_mode").alias("mode_length"),
        F.col("distinct_values").alias("distinct_lengths"),
    )


def p5_page_results(spark: SparkSession, d: str) -> DataFrame:
    return _key_results(spark, d, "page_id")


def p5_contributor_results(spark: SparkSession, d: str) -> DataFrame:
    return _key_results(spark, d, "contributor_id")


# --- Problem 6: only new or changed records ------------------------------------------------------------------------------------
def _dump_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, d, "dump_page"), table(spark, d, "load_run"), table(spark, d, "run_progress")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return pages_to_load(*_dump_tables(spark, d))


def p6_editions(spark: SparkSession, d: str) -> DataFrame:
    """Per edition: distinct entries, how many are done, and the first position that is not."""
    entries, runs, reports = _dump_tables(spark, d)
    flagged = done_entries(entries, runs, reports)
    keys = ["source_file_name", "source_file_timestamp", "file_position"]
    return (
        flagged.groupBy(*keys).agg(F.max("done").alias("done"))
        .groupBy("source_file_name", "source_file_timestamp")
        .agg(
            F.count(F.lit(1)).alias("entries"),
            F.count_if("done").alias("done_entries"),
            F.min(F.when(~F.col("done"), F.col("file_position"))).alias("resume_position"),
        )
    )


# --- Problem 7: sessions -------------------------------------------------------------------------------------------------------
def _sessions(spark: SparkSession, d: str) -> DataFrame:
    """The deliveries in order of arrival, cut into batches that a session store takes one after another."""
    scratch = Scratch(spark, "events")
    revisions = table(spark, d, "page_revision").select(
        "page_revision_id", "loaded_at", "contributor_id", "ip_address", "revision_when"
    )
    rows = first_delivery(revisions, "page_revision_id")
    arrived = F.unix_micros(F.col("loaded_at").cast("timestamp")).alias("arrived")
    events = scratch.write(
        rows.select(actor_of("contributor_id", "ip_address").alias("actor"), "revision_when", "page_revision_id", arrived), "events"
    )
    cuts = events.agg(F.percentile_approx("arrived", [i / SESSION_BATCHES for i in range(1, SESSION_BATCHES)]).alias("c")).first()[0]
    store = SessionStore(spark, scratch.path("store"), SESSION_GAP_SECONDS)
    edges = [None, *sorted(set(cuts or [])), None]
    for low, high in zip(edges[:-1], edges[1:]):
        batch = events
        if low is not None:
            after = F.col("arrived") > low
            batch = batch.where(after if high is not None else after | F.col("arrived").isNull())  # of unknown arrival: in the last batch
        if high is not None:
            batch = batch.where(F.col("arrived") <= high)
        store.apply(event_spans(batch, actor=F.col("actor"), when="revision_when", event_id="page_revision_id"))
    return store.sessions()


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _sessions(spark, d).select(F.col("first_id").alias("min_revision_id"), F.col("last_id").alias("max_revision_id"))


def p7_sessions(spark: SparkSession, d: str) -> DataFrame:
    ntz = lambda c: F.timestamp_micros(c).cast("timestamp_ntz")
    return _sessions(spark, d).select(
        "actor",
        ntz("start").alias("session_start"),
        ntz("end").alias("session_end"),
        F.expr("(end - start) div 1000000").alias("duration_seconds"),
        F.col("events").alias("revisions"),
        F.col("first_id").alias("min_revision_id"),
        F.col("last_id").alias("max_revision_id"),
    )


QUERIES = {
    f.__name__: f
    for f in (
        p3_found, p3_orphans_by_month, p4_found, p4_hierarchy, p4_descendants, p5_found, p5_page_results, p5_contributor_results,
        p6_found, p6_editions, p7_found, p7_sessions,
    )
}

_REVISIONS = """
  revs AS (SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY page_revision_id ORDER BY loaded_at) AS rn FROM page_revision) WHERE rn = 1)
"""

_ORPHANS = f"""
WITH {_REVISIONS},
  pages AS (SELECT page_id AS k, arg_min(loaded_at, loaded_at) AS l, first(deleted_at ORDER BY loaded_at) AS x FROM wiki_page GROUP BY 1),
  users AS (SELECT user_id AS k, arg_min(loaded_at, loaded_at) AS l, first(deleted_at ORDER BY loaded_at) AS x FROM wiki_user GROUP BY 1),
  spaces AS (SELECT DISTINCT namespace_id AS k, CAST(NULL AS TIMESTAMP) AS l, CAST(NULL AS TIMESTAMP) AS x FROM wiki_namespace),
  refs AS (
    SELECT r.page_revision_id, r.revision_when, r.loaded_at AS seen, 'PageID' AS ref_field, p.k, p.l, p.x
      FROM revs r LEFT JOIN pages p ON p.k = r.page_id WHERE r.page_id IS NOT NULL
    UNION ALL SELECT r.page_revision_id, r.revision_when, r.loaded_at, 'ContributorID', p.k, p.l, p.x
      FROM revs r LEFT JOIN users p ON p.k = r.contributor_id WHERE r.contributor_id IS NOT NULL
    UNION ALL SELECT r.page_revision_id, r.revision_when, r.loaded_at, 'NamespaceID', p.k, p.l, p.x
      FROM revs r LEFT JOIN spaces p ON p.k = r.namespace_id WHERE r.namespace_id IS NOT NULL),
  bad AS (
    SELECT page_revision_id, revision_when, ref_field, 'missing' AS ref_status FROM refs WHERE k IS NULL
    UNION ALL SELECT page_revision_id, revision_when, ref_field, 'late' FROM refs WHERE l > seen
    UNION ALL SELECT page_revision_id, revision_when, ref_field, 'deleted' FROM refs WHERE x <= seen)
"""

_TREE = f"""
WITH RECURSIVE {_REVISIONS},
  e AS (SELECT r.page_revision_id AS node, p.page_revision_id AS parent
        FROM revs r LEFT JOIN revs p ON p.page_revision_id = r.parent_page_revision_id AND r.parent_page_revision_id <> 0),
  t(node, root, depth, path) AS (
    SELECT node, node, CAST(0 AS BIGINT), CAST(node AS VARCHAR) FROM e WHERE parent IS NULL
    UNION ALL SELECT e.node, t.root, t.depth + 1, t.path || '/' || CAST(e.node AS VARCHAR) FROM t JOIN e ON e.parent = t.node),
  loose AS (SELECT * FROM e WHERE node NOT IN (SELECT node FROM t)),
  walk(node, hop) AS (SELECT node, parent FROM loose UNION SELECT w.node, l.parent FROM walk w JOIN loose l ON l.node = w.hop),
  looped AS (SELECT node FROM walk WHERE node = hop),
  cyc AS (SELECT w.node, min(w.hop) AS cycle_id FROM walk w WHERE w.hop IN (SELECT node FROM looped) GROUP BY 1)
"""

_EDITIONS = """
WITH reports AS (
    SELECT r.source_file_name AS f, r.source_file_timestamp AS ts, p.file_position AS pos, p.page_id AS pid
    FROM run_progress p JOIN load_run r USING (run_id)),
  reach AS (
    SELECT f, ts, max(pos) AS reach FROM (
      SELECT f, ts, pos FROM reports
      UNION ALL SELECT q.f, q.ts, d.file_position FROM reports q JOIN dump_page d
        ON d.source_file_name = q.f AND d.source_file_timestamp = q.ts AND d.page_id = q.pid) GROUP BY 1, 2),
  ok AS (SELECT DISTINCT source_file_name AS f, source_file_timestamp AS ts FROM load_run WHERE result LIKE 'Success%'),
  flagged AS (
    SELECT d.*, (ok.f IS NOT NULL OR coalesce(d.file_position <= reach.reach, FALSE)) AS done
    FROM dump_page d
    LEFT JOIN reach ON reach.f = d.source_file_name AND reach.ts = d.source_file_timestamp
    LEFT JOIN ok ON ok.f = d.source_file_name AND ok.ts = d.source_file_timestamp)
"""

_SESSIONS = f"""
WITH {_REVISIONS},
  addr AS (SELECT page_revision_id, revision_when, contributor_id, lower(trim(ip_address)) AS a FROM revs),
  parts AS (SELECT *,
      list_filter(string_split(string_split(a, '::')[1], ':'), lambda x: x <> '') AS h,
      CASE WHEN contains(a, '::') THEN list_filter(string_split(string_split(a, '::')[2], ':'), lambda x: x <> '') ELSE [] END AS t
    FROM addr),
  named AS (SELECT page_revision_id, revision_when,
      CASE WHEN contributor_id IS NOT NULL THEN 'id:' || CAST(contributor_id AS VARCHAR)
        WHEN a IS NULL OR a = '' THEN NULL
        WHEN contains(a, ':') THEN 'ip:' || array_to_string(list_transform(
          CASE WHEN contains(a, '::') THEN list_concat(h, list_concat(list_transform(range(8 - len(h) - len(t)), lambda x: '0'), t)) ELSE h END,
          lambda x: regexp_replace(x, '^0+(.)', '\\1')), ':')
        ELSE 'ip:' || array_to_string(list_transform(string_split(a, '.'), lambda x: regexp_replace(x, '^0+(.)', '\\1')), '.')
      END AS actor FROM parts),
  steps AS (SELECT *, CASE WHEN revision_when - lag(revision_when) OVER w <= INTERVAL 60 MINUTE THEN 0 ELSE 1 END AS opens
    FROM named WHERE actor IS NOT NULL AND revision_when IS NOT NULL
    WINDOW w AS (PARTITION BY actor ORDER BY revision_when)),
  numbered AS (SELECT *, sum(opens) OVER (PARTITION BY actor ORDER BY revision_when ROWS UNBOUNDED PRECEDING) AS s FROM steps)
"""


def _key_results_sql(column: str) -> str:
    return f"""
WITH {_REVISIONS},
  w AS (SELECT {column} AS k, article_text_length AS v, count(*) AS n FROM revs WHERE {column} IS NOT NULL GROUP BY 1, 2),
  c AS (SELECT *, sum(n) OVER (PARTITION BY k ORDER BY v) AS cum, sum(n) OVER (PARTITION BY k) AS total FROM w),
  med AS (SELECT k, min(v) AS median_length FROM c WHERE cum >= greatest(1, ceil(0.5 * total)) GROUP BY 1),
  mode AS (SELECT k, first(v ORDER BY n DESC, v) AS mode_length, count(*) AS distinct_lengths FROM w GROUP BY 1)
SELECT r.{column}, count(*) AS revisions, min(r.revision_when) AS first_when, max(r.revision_when) AS last_when,
  round(CAST(sum(r.article_text_length) AS DOUBLE) / count(*), 6) AS mean_length,
  CAST(any_value(med.median_length) AS BIGINT) AS median_length, CAST(any_value(mode.mode_length) AS BIGINT) AS mode_length,
  any_value(mode.distinct_lengths) AS distinct_lengths
FROM revs r JOIN med ON med.k = r.{column} JOIN mode ON mode.k = r.{column} GROUP BY 1
"""


ORACLE = {
    "p3_found": _ORPHANS + "SELECT page_revision_id, ref_field, ref_status FROM bad",
    "p3_orphans_by_month": _ORPHANS
    + "SELECT ref_field, ref_status, strftime(revision_when, '%Y-%m') AS month, count(*) AS \"references\" FROM bad GROUP BY 1, 2, 3",
    "p4_found": _TREE + "SELECT node AS page_revision_id, cycle_id FROM cyc",
    "p4_hierarchy": _TREE
    + "SELECT node AS page_revision_id, root, depth, path, CAST(NULL AS BIGINT) AS cycle_id FROM t"
    + " UNION ALL SELECT node, NULL, NULL, NULL, cycle_id FROM cyc",
    "p4_descendants": _TREE
    + ", up(node, ancestor, distance) AS (SELECT node, parent, CAST(1 AS BIGINT) FROM e WHERE parent IS NOT NULL AND node IN (SELECT node FROM t)"
    + " UNION ALL SELECT up.node, e.parent, up.distance + 1 FROM up JOIN e ON e.node = up.ancestor WHERE e.parent IS NOT NULL)"
    + " SELECT ancestor, node AS descendant, distance FROM up",
    "p5_found": " UNION ALL ".join(
        f"SELECT '{f}' AS key_field, CAST({c} AS BIGINT) AS key_value FROM page_revision WHERE {c} IS NOT NULL GROUP BY {c}"
        f" HAVING count(*) >= {HEAVY_SHARE} * (SELECT count(*) FROM page_revision)"
        for f, c in KEY_FIELDS
    ),
    "p5_page_results": _key_results_sql("page_id"),
    "p5_contributor_results": _key_results_sql("contributor_id"),
    "p6_found": _EDITIONS
    + "SELECT page_id, max(latest_revision_id) AS latest_revision_id FROM flagged GROUP BY 1"
    + " HAVING max(latest_revision_id) > coalesce(max(latest_revision_id) FILTER (WHERE done), -1)",
    "p6_editions": _EDITIONS
    + "SELECT source_file_name, source_file_timestamp, count(*) AS entries, count(*) FILTER (WHERE done) AS done_entries,"
    + " min(file_position) FILTER (WHERE NOT done) AS resume_position FROM (SELECT source_file_name, source_file_timestamp,"
    + " file_position, bool_or(done) AS done FROM flagged GROUP BY 1, 2, 3) GROUP BY 1, 2",
    "p7_found": _SESSIONS
    + "SELECT min(page_revision_id) AS min_revision_id, max(page_revision_id) AS max_revision_id FROM numbered GROUP BY actor, s",
    "p7_sessions": _SESSIONS
    + "SELECT actor, min(revision_when) AS session_start, max(revision_when) AS session_end,"
    + " CAST(datediff('microsecond', min(revision_when), max(revision_when)) // 1000000 AS BIGINT) AS duration_seconds, count(*) AS revisions,"
    + " min(page_revision_id) AS min_revision_id, max(page_revision_id) AS max_revision_id FROM numbered GROUP BY actor, s",
}
