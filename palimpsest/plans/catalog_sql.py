"""The catalogue's queries in DuckDB's SQL, written from the statements' meaning rather than from the plans."""

from __future__ import annotations

from palimpsest.plans.catalog import BOUNDS, CONTRIBUTOR, DISCUSSION_NAMESPACE, DISCUSSION_PREFIX, FROM, NAMES, PAGE, PHRASE, PROJECT_NAMESPACE, ROBOTS, RUN_KEY, STRICT_BOUNDS, TO

_ACTIVITY = """(SELECT user_id AS "RunID", event_id AS "ActivityID", event_type AS "Activity", ts AS "StartTime", event_id % 997 AS "TargetPageID",
  CAST(round(value * 1000) AS BIGINT) AS "DurationMillis", CAST(event_id % 7 + 1 AS BIGINT) AS "WorkCount" FROM events)"""
_MINE = f"contributor_id = {CONTRIBUTOR} AND comment ILIKE '{PHRASE}'"
_ROBOTS = ", ".join(map(str, ROBOTS))
_TIMED = "SELECT *, CAST(datediff('millisecond', start_time, end_time) AS BIGINT) AS \"DurationMillis\" FROM load_run"
_RANGES = """SELECT namespace_id AS "NamespaceID", min(page_id) AS "Min", max(page_id) AS "Max", count(page_revision_id) AS "Count"
  FROM page_revision GROUP BY 1"""
_PERIODS = f"""SELECT page_id AS "PageID", min(revision_when) AS "RevLow", max(revision_when) AS "RevHigh" FROM page_revision
  WHERE {_MINE} AND revision_when >= TIMESTAMP '{FROM}' AND revision_when <= TIMESTAMP '{TO}' AND namespace_id = 0 GROUP BY 1"""
_NAMED_PERIODS = f"""SELECT x.*, p.page_name AS "PageName" FROM ({_PERIODS}) x JOIN (SELECT DISTINCT page_id, page_name FROM wiki_page) p ON p.page_id = x."PageID" """
_BOUNDED = f"""SELECT r.page_revision_id, r.page_id,
  (SELECT min(revision_when) FROM page_revision q WHERE q.page_id = r.page_id AND q.contributor_id NOT IN ({_ROBOTS})) AS "MinRevWhen",
  (SELECT max(revision_when) FROM page_revision q WHERE q.page_id = r.page_id AND q.contributor_id NOT IN ({_ROBOTS})) AS "MaxRevWhen"
  FROM page_revision r WHERE {_MINE} AND namespace_id = {PROJECT_NAMESPACE}"""
_LONGEST = """SELECT page_id AS "PageID", page_revision_id AS "PageRevisionID", length(rtrim(article_text)) AS "ArticleLength"
  FROM (SELECT DISTINCT page_id, page_revision_id, article_text FROM page_revision_text WHERE namespace_id = 0) ORDER BY 3 DESC, 2 LIMIT 10"""
_ISO = "'%Y-%m-%dT%H:%M:%S'"
_ISO12 = "'%Y-%m-%dT%I:%M:%S'"


def _histogram(bounds, strict: bool) -> str:
    low, high = (">", "<") if strict else (">=", "<=")
    values = ", ".join(f"({lo}, {'NULL' if hi is None else hi})" for lo, hi in bounds)
    return f"""WITH b(lo, hi) AS (VALUES {values}),
  c AS (SELECT page_id, count(page_revision_id) AS n FROM page_revision WHERE namespace_id = 0 GROUP BY 1)
SELECT CAST(lo AS INTEGER) AS "LowBound", CAST(hi AS INTEGER) AS "HighBound", count(*) AS "PagesInBucket"
FROM c JOIN b ON n {low} lo AND (hi IS NULL OR n {high} hi) GROUP BY 1, 2"""


def _discussion(name: str, namespace: int = DISCUSSION_NAMESPACE) -> str:
    return f"""(SELECT min(q.page_name) FROM wiki_page q WHERE q.namespace_id = {namespace}
    AND starts_with(lower(q.page_name), lower('{DISCUSSION_PREFIX}' || {name})))"""


def _top_pages(on: str) -> str:
    return f"""SELECT s.namespace_name AS "NamespaceName", p.page_name AS "PageName", t.n AS "RevisionCount" FROM (
    SELECT namespace_id, page_id, count(page_revision_id) AS n FROM page_revision GROUP BY 1, 2 ORDER BY 3 DESC, 2, 1 LIMIT 100) t
  JOIN (SELECT DISTINCT page_id, namespace_id AS ns, page_name FROM wiki_page) p ON {on} JOIN wiki_namespace s ON s.namespace_id = t.namespace_id"""


ORACLE = {
    "scan_1_namespaces": "SELECT * FROM wiki_namespace",
    "scan_2_runs": "SELECT * FROM load_run",
    "scan_3_runs_timed": _TIMED,
    "scan_3_runs_by_duration": _TIMED,
    "scan_4_activity_by_duration": f'SELECT * FROM {_ACTIVITY} WHERE "RunID" = 50',
    "scan_4_activity_by_page": f'SELECT * FROM {_ACTIVITY} WHERE "RunID" = 50',
    "scan_5_recent_steps": f"SELECT * FROM {_ACTIVITY} WHERE \"Activity\" = 'view'",
    "scan_5_longest_steps": f"SELECT * FROM {_ACTIVITY} WHERE \"Activity\" = 'view'",
    "scan_5_longest_merges": f"SELECT * FROM {_ACTIVITY} WHERE \"Activity\" = 'purchase'",
    "scan_6_contribution_revisions": f"SELECT namespace_id, page_id, page_revision_id FROM page_revision WHERE contributor_id = {CONTRIBUTOR}",
    "scan_6_user_by_name": "SELECT * FROM wiki_user WHERE lower(rtrim(user_name)) = 'orsolin'",
    "scan_6_contributions": f"SELECT * FROM page_revision WHERE contributor_id = {CONTRIBUTOR}",
    "scan_6_contribution_keys": f"SELECT contributor_id, namespace_id, page_id, page_revision_id FROM page_revision WHERE contributor_id = {CONTRIBUTOR}",
    "scan_7_deleted_users": "SELECT * FROM page_revision WHERE user_deleted",
    "scan_7_null_comments": "SELECT * FROM page_revision WHERE comment IS NULL",
    "scan_8_with_text": "SELECT * FROM page_revision WHERE text_available",
    "scan_8_longest_with_text": "SELECT DISTINCT page_revision_id, page_id, article_text_length FROM page_revision WHERE text_available ORDER BY 3 DESC, 1 LIMIT 10",
    "scan_9_revisions_of_page": f"SELECT page_revision_id FROM page_revision WHERE page_id = {PAGE}",
    "scan_10_newest_pages": "SELECT DISTINCT namespace_id, page_id, page_name, redirect_title FROM wiki_page ORDER BY page_id DESC LIMIT 1000",
    "scan_11_named_users": "SELECT DISTINCT user_id, user_name FROM wiki_user WHERE lower(rtrim(user_name)) IN ("
    + ", ".join(f"'{n.lower()}'" for n in NAMES)
    + ") ORDER BY 1, 2 LIMIT 10",
    "scan_12_run_minutes": f"""SELECT source_file_name AS "SourceFileName", CAST(datediff('minute', start_time, end_time) AS BIGINT) AS "DurationMinutes",
  start_time AS "StartTime", end_time AS "EndTime" FROM load_run WHERE run_id >= {RUN_KEY}""",
    "agg_1_users": 'SELECT count(*) AS "CountUsers" FROM wiki_user',
    "agg_1_revisions": 'SELECT count(*) AS "CountRevisions" FROM page_revision',
    "agg_1_pages": 'SELECT count(*) AS "CountPages" FROM wiki_page',
    "agg_1_activity": f'SELECT count(*) AS "CountActivity" FROM {_ACTIVITY}',
    "agg_2_work_per_run": f"SELECT \"RunID\", CAST(sum(\"WorkCount\") AS BIGINT) AS \"WorkCount\" FROM {_ACTIVITY} WHERE \"Activity\" = 'view' GROUP BY 1",
    "agg_3_text_states": """SELECT namespace_id AS "NamespaceID", CAST(sum(CASE WHEN text_available THEN 1 ELSE 0 END) AS BIGINT) AS "TextAvailable",
  CAST(sum(CASE WHEN NOT text_available THEN 1 ELSE 0 END) AS BIGINT) AS "TextNotAvailable",
  CAST(sum(CASE WHEN text_available IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS "TextAvailableNull" FROM page_revision GROUP BY 1""",
    "agg_4_id_ranges": _RANGES,
    "agg_5_id_ranges_texts": f"""SELECT r.*, (SELECT count(*) FROM page_revision_text t WHERE t.namespace_id = r."NamespaceID") AS "Texts" FROM ({_RANGES}) r""",
    "agg_6_revisions_per_page": """SELECT p.page_id AS "PageID", p.page_name AS "PageName", t.n AS "PageRevisionCount" FROM (
  SELECT page_id, count(page_revision_id) AS n FROM page_revision GROUP BY 1) t JOIN wiki_page p ON p.page_id = t.page_id""",
    "agg_7_totals_per_namespace": """SELECT s.namespace_name AS "NamespaceName", count(DISTINCT r.page_id) AS "DistinctPages", count(r.page_revision_id) AS "PageRevisions"
  FROM page_revision r JOIN wiki_namespace s USING (namespace_id) GROUP BY s.namespace_id, s.namespace_name""",
    "agg_8_pages_per_namespace": """SELECT s.namespace_id AS "NamespaceID", s.namespace_name AS "NamespaceName", count(*) AS "PageCount"
  FROM wiki_page p JOIN wiki_namespace s ON s.namespace_id = p.namespace_id GROUP BY 1, 2""",
    "agg_9_anonymous": 'SELECT ip_address AS "IPAddress", count(ip_address) AS "Contributions" FROM page_revision WHERE contributor_id IS NULL GROUP BY 1',
    "agg_10_texts_per_page": """SELECT page_id AS "PageID", count(page_id) AS "TotalRevisions",
  CAST(sum(CASE WHEN text_available THEN 1 ELSE 0 END) AS BIGINT) AS "RevisionsWithText" FROM page_revision GROUP BY 1""",
    "agg_11_text_lengths": """SELECT s.namespace_id AS "NamespaceID", s.namespace_name AS "NamespaceName", count(t.page_id) AS "PageCount",
  min(length(rtrim(article_text))) AS "MinLength", CAST(sum(length(rtrim(article_text))) // count(article_text) AS BIGINT) AS "AverageLength",
  max(length(rtrim(article_text))) AS "MaxLength" FROM page_revision_text t JOIN wiki_namespace s ON s.namespace_id = t.namespace_id GROUP BY 1, 2""",
    "agg_12_histogram_strict": _histogram(STRICT_BOUNDS, True),
    "agg_12_histogram": _histogram(BOUNDS, False),
    "agg_13_page_periods": _PERIODS,
    "agg_14_null_keys": "SELECT CASE WHEN a IS NULL THEN 5 ELSE a END AS value FROM (VALUES (3), (NULL), (NULL)) AS x(a) GROUP BY a",
    "agg_15_page_contributors": f'SELECT contributor_id AS "ContributorID", count(*) AS "ContributorCount" FROM page_revision WHERE page_id = {PAGE} GROUP BY 1',
    "join_6_text_missing": """SELECT namespace_id AS "NamespaceID", page_id AS "PageID", page_revision_id AS "PageRevisionID" FROM page_revision r
  WHERE text_available AND NOT EXISTS (SELECT 1 FROM page_revision_text t
    WHERE t.page_id = r.page_id AND t.namespace_id = r.namespace_id AND t.page_revision_id = r.page_revision_id)""",
    "join_7_no_page": "SELECT * FROM page_revision WHERE page_id NOT IN (SELECT page_id FROM wiki_page)",
    "join_8_unknown_users": "SELECT * FROM page_revision WHERE contributor_id NOT IN (SELECT user_id FROM wiki_user) AND contributor_id <> 0",
    "join_9_unknown_users_sample": "SELECT * FROM page_revision WHERE contributor_id NOT IN (SELECT user_id FROM wiki_user) AND contributor_id <> 0"
    " ORDER BY page_revision_id, loaded_at, run_id LIMIT 10",
    "join_10_page_bounds": _BOUNDED,
    "join_11_discussion_page": f"""SELECT p.page_id, p.page_name AS "PageName", {_discussion("p.page_name")} AS "DiscussionPage"
  FROM (SELECT DISTINCT page_id, page_name FROM wiki_page WHERE namespace_id = 0) p""",
    "join_14_sizes": """SELECT source_file_name AS "SourceFileName",
  round(sum(CASE WHEN coalesce(result LIKE 'Success%', FALSE) THEN source_file_size * 8.0::DOUBLE / 1024 END), 3) AS "LoadedMB",
  round(sum(CASE WHEN NOT coalesce(result LIKE 'Success%', FALSE) THEN source_file_size * 8.0::DOUBLE / 1024 END), 3) AS "OtherMB" FROM load_run GROUP BY 1""",
    "top_1_pages": _top_pages("p.page_id = t.page_id").replace("SELECT DISTINCT page_id, namespace_id AS ns, page_name", "SELECT DISTINCT page_id, page_name"),
    "top_2_pages_two_keys": _top_pages("p.page_id = t.page_id AND p.ns = t.namespace_id"),
    "top_3_contributors": """SELECT u.user_id AS "UserID", u.user_name AS "UserName", t.n AS "Contributions" FROM (
  SELECT contributor_id, count(contributor_id) AS n FROM page_revision WHERE contributor_id IS NOT NULL GROUP BY 1) t
  JOIN (SELECT DISTINCT user_id, user_name FROM wiki_user) u ON u.user_id = t.contributor_id ORDER BY 3 DESC, 1, 2 LIMIT 1000""",
    "top_4_contributors": """SELECT contributor_id AS "ContributorID", u.user_name AS "UserName", count(contributor_id) AS "ContribCount" FROM page_revision r
  JOIN (SELECT DISTINCT user_id, user_name FROM wiki_user) u ON u.user_id = r.contributor_id WHERE contributor_id <> 0
  GROUP BY 1, 2 ORDER BY 3 DESC, 1, 2 LIMIT 10""",
    "top_5_longest_lengths": _LONGEST,
    "comp_1_contributions": f"""SELECT r.*, p.page_name AS "PageName" FROM page_revision r JOIN (SELECT DISTINCT namespace_id, page_id, page_name FROM wiki_page) p
  ON p.namespace_id = r.namespace_id AND p.page_id = r.page_id WHERE {_MINE} AND p.namespace_id = {PROJECT_NAMESPACE}""",
    "comp_2_table_rows": f"""SELECT strftime("MinRevWhen", {_ISO12}) AS "FirstWhen",
  '|| [[' || substr(p.page_name, strpos(p.page_name, '/') + 1, 99) || ']] || [[' || p.page_name || '| link]] || ||' AS "Row",
  strftime("MaxRevWhen", {_ISO12}) AS "LastWhen" FROM ({_BOUNDED}) b
  JOIN (SELECT DISTINCT namespace_id, page_id, page_name FROM wiki_page) p ON p.page_id = b.page_id AND p.namespace_id = {PROJECT_NAMESPACE}""",
    "comp_3_period_rows": f"""SELECT '| ' || strftime("RevLow", {_ISO}) || ' || [' || "PageName" || '] || || || ' || strftime("RevHigh", {_ISO}) AS "Row" FROM ({_NAMED_PERIODS})""",
    "comp_4_period_discussions": f"""SELECT "RevLow", "PageName", strftime("RevHigh", {_ISO}) AS "RevHigh", {_discussion('x."PageName"', 0)} AS "DiscussionPage"
  FROM ({_NAMED_PERIODS}) x""",
    "comp_5_text_restored": "SELECT DISTINCT page_revision_id, md5(article_text) AS \"TextHash\" FROM page_revision_text ORDER BY 1 LIMIT 1",
    "str_3_after_slash": "SELECT page_revision_id, substr(comment, strpos(comment, '/') + 1, 99) AS \"Rest\" FROM page_revision WHERE strpos(comment, '/') > 0",
    "dt_5_day_number": "SELECT CAST(datediff('day', DATE '1970-01-01', DATE '2024-08-01') AS INTEGER) AS \"DayNumber\"",
    "utf_16_lengths": """SELECT DISTINCT page_revision_id, length(article_text) AS "Characters",
  length(article_text) + length(article_text) - length(regexp_replace(article_text, '[\\x{10000}-\\x{10FFFF}]', '', 'g')) AS "Units" FROM page_revision_text""",
    "comp_6_page_users": f"""SELECT u.user_id AS "UserID", u.user_name AS "UserName", x.n AS "ContributorCount" FROM (SELECT DISTINCT user_id, user_name FROM wiki_user) u
  LEFT JOIN (SELECT contributor_id, count(1) AS n FROM page_revision WHERE page_id = {PAGE} GROUP BY 1) x ON x.contributor_id = u.user_id
  ORDER BY 3 DESC NULLS LAST, 1, 2 LIMIT 100""",
    "cur_1_retention": """SELECT page_id, page_revision_id, ordinal FROM (
  SELECT page_id, page_revision_id, row_number() OVER (PARTITION BY page_id ORDER BY page_revision_id) - 1 AS ordinal,
    count(*) OVER (PARTITION BY page_id) AS n FROM (SELECT DISTINCT page_id, page_revision_id FROM page_revision))
  WHERE ordinal % 100 = 0 OR ordinal = n - 1""",
    "cur_3_delta": """SELECT t.page_id, t.page_revision_id, k.page_id IS NULL AS is_new FROM (SELECT DISTINCT page_id, page_revision_id FROM page_revision_text) t
  LEFT JOIN (SELECT page_id, page_revision_id, bool_or(text_available) AS had FROM page_revision GROUP BY 1, 2) k
    ON k.page_id = t.page_id AND k.page_revision_id = t.page_revision_id WHERE k.page_id IS NULL OR NOT k.had""",
    "cur_6_merge_counts": """SELECT count(DISTINCT contributor_id) FILTER (WHERE contributor_id NOT IN (SELECT user_id FROM wiki_user)) AS added,
  count(*) - count(DISTINCT contributor_id) FILTER (WHERE contributor_id NOT IN (SELECT user_id FROM wiki_user)) AS already
  FROM page_revision WHERE contributor_id IS NOT NULL""",
    "cur_12_page_upsert": """SELECT page_id, arg_max(page_name, loaded_at) AS page_name, last(redirect_title ORDER BY loaded_at) AS redirect_title
  FROM wiki_page GROUP BY 1""",
    "stat_1_totals": """SELECT count(DISTINCT page_id) AS "Pages", count(*) AS "Revisions", count(*) FILTER (WHERE is_minor) AS "MinorRevisions",
  count(*) FILTER (WHERE contributor_id IS NULL AND ip_address IS NOT NULL) AS "AnonymousRevisions", max(article_text_length) AS "LongestText" FROM page_revision""",
    "stat_3_contributors": """SELECT n.user_name AS "UserName", count(*) AS "Contributions" FROM page_revision r
  JOIN (SELECT user_id, first(user_name ORDER BY loaded_at, user_name) AS user_name FROM wiki_user GROUP BY 1) n ON n.user_id = r.contributor_id GROUP BY 1""",
    "stat_4_longest_comment": """SELECT length(comment) AS "Length", comment AS "Comment" FROM page_revision WHERE comment IS NOT NULL
  ORDER BY length(comment) DESC, page_revision_id LIMIT 1""",
    "stat_6_pages_per_namespace": 'SELECT namespace_id AS "NamespaceID", count(DISTINCT page_id) AS "Pages" FROM page_revision GROUP BY 1',
    "set_1_counts_union": """SELECT 'Pages' AS "What", count(*) AS "Count" FROM wiki_page UNION ALL SELECT 'Revisions', count(*) FROM page_revision""",
    "ing_1_round_trip": """SELECT doc_id, title, md5(text) AS text_hash, n_chars, 'A & B' AS user_name,
  date_trunc('second', fetched_at) AS fetched_second FROM documents""",
    "ing_2_edge_cases": """SELECT user_id AS page_id, CAST(CASE c WHEN 0 THEN 77 ELSE 0 END AS BIGINT) AS parent_page_revision_id,
  CAST(CASE WHEN c = 2 THEN 0 WHEN c > 2 THEN user_id END AS BIGINT) AS contributor_id, CASE c WHEN 0 THEN '192.0.2.7' END AS ip_address,
  CASE c WHEN 5 THEN 800 END AS comment_length, c <> 3 AS text_available, c = 2 AS is_minor,
  CAST(CASE WHEN c IN (3, 4) THEN 0 ELSE length(user_name) END AS INTEGER) AS article_text_length, c = 3 AS text_deleted, c = 1 AS user_deleted,
  CASE WHEN c > 1 THEN user_name END AS user_name, CASE c WHEN 3 THEN NULL WHEN 4 THEN '' ELSE user_name END AS article_text,
  TIMESTAMP '2020-01-02 03:04:05' AS revision_when
  FROM (SELECT user_id, min(user_name) AS user_name, user_id % 6 AS c FROM wiki_user GROUP BY 1)""",
    "ing_3_redirects": """SELECT DISTINCT user_id AS page_id, 'T' || user_id AS page_name, CASE user_id % 6 WHEN 1 THEN 'Another page' END AS redirect_title
  FROM wiki_user""",
}
