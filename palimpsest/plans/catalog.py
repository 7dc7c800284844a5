"""The analyst and data-quality queries over the loaded tables, as DataFrame plans.

Every query takes (spark, directory); its parameters have defaults.  Columns are those of the reference's statements.  Where it left
the order of ties open, a key decides.  Aggregates run before dimension joins, and limits before expensive columns.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.functions.tsql import (
    after_first, avg_int, ci_in, ci_like, datediff_boundaries, gunzip, gzip_bytes, gzip_length, iso_seconds, tsql_len, utf16_len,
)
from palimpsest.operators.common import salted_lookup, spread
from palimpsest.operators.curate import merge_counts, needed_revisions, ordinal_in_group, retained, upsert
from palimpsest.operators.derive import pages_table, revisions_table
from palimpsest.plans.tables import table
from palimpsest.sources.dump import escape_xml, parse_page, to_page_xml, to_revision_xml

#: Bounds of the histogram of revisions per page; null: no upper bound.
STRICT_BOUNDS = (
    (1, 10), (11, 100), (101, 500), (501, 1000), (1001, 2500), (2501, 5000), (5001, 10000), (10001, 15000), (15001, 20000),
    (20000, 30000), (30001, 50000), (50001, 100000), (100001, None),
)
BOUNDS = tuple((20001 if lo == 20000 else lo, hi) for lo, hi in STRICT_BOUNDS)

CONTRIBUTOR = 8113
ROBOTS = (502, 13377, 4096, 27140)
PHRASE = "%article%"
PROJECT_NAMESPACE = 4
#: Where the discussion of an article is found, and how its title begins before the article's name.
DISCUSSION_NAMESPACE, DISCUSSION_PREFIX = 1, ""
FROM, TO = "2016-01-02", "2017-10-01"
NAMES = ("TIDYBOT", "orsolin", "LinkMender", "PatrolFox", "nobody")
PAGE = 4417
RUN_KEY = 1002


def _revisions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_revision")


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wiki_page")


def _spaces(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "wiki_namespace")


def _activity(spark: SparkSession, d: str) -> DataFrame:
    """The step log; the event table stands in for it."""
    e = table(spark, d, "events")
    return e.select(
        F.col("user_id").alias("RunID"), F.col("event_id").alias("ActivityID"), F.col("event_type").alias("Activity"),
        F.col("ts").alias("StartTime"), (F.col("event_id") % 997).alias("TargetPageID"),
        F.round(F.col("value") * 1000).cast("long").alias("DurationMillis"), (F.col("event_id") % 7 + 1).cast("long").alias("WorkCount"),
    )


def _some_activity(activity: DataFrame) -> Column:
    return activity["Activity"] == F.lit("view")


# --- Scans ---------------------------------------------------------------------------------------------------------------------
def scan_1_namespaces(spark, d):
    return _spaces(spark, d)


def scan_2_runs(spark, d):
    return table(spark, d, "load_run").orderBy(F.desc("run_id"))


def _timed(spark, d):
    run = table(spark, d, "load_run")
    return run.withColumn("DurationMillis", datediff_boundaries("MILLISECOND", F.col("start_time"), F.col("end_time")))


def scan_3_runs_timed(spark, d):
    return _timed(spark, d).orderBy(F.desc("run_id"))


def scan_3_runs_by_duration(spark, d):
    return _timed(spark, d).orderBy(F.desc("DurationMillis"), F.desc("run_id"))


def scan_4_activity_by_duration(spark, d, run=50):
    a = _activity(spark, d)
    return a.where(a["RunID"] == run).orderBy(F.desc("DurationMillis"), "ActivityID")


def scan_4_activity_by_page(spark, d, run=50):
    a = _activity(spark, d)
    return a.where(a["RunID"] == run).orderBy("TargetPageID", "ActivityID")


def scan_5_recent_steps(spark, d):
    a = _activity(spark, d)
    return a.where(_some_activity(a)).orderBy(F.desc("ActivityID"))


def scan_5_longest_steps(spark, d):
    a = _activity(spark, d)
    return a.where(_some_activity(a)).orderBy(F.desc("DurationMillis"), "ActivityID")


def scan_5_longest_merges(spark, d):
    a = _activity(spark, d)
    return a.where(a["Activity"] == "purchase").orderBy(F.desc("DurationMillis"), "ActivityID")


def scan_6_user_by_name(spark, d, name="orsolin"):
    users = table(spark, d, "wiki_user")
    return users.where(ci_in(F.col("user_name"), [name]))


def scan_6_contributions(spark, d, contributor=CONTRIBUTOR):
    r = _revisions(spark, d)
    return r.where(r["contributor_id"] == contributor).orderBy(F.desc("revision_when"), "page_revision_id")


def scan_6_contribution_keys(spark, d, contributor=CONTRIBUTOR):
    return scan_6_contributions(spark, d, contributor).select("contributor_id", "namespace_id", "page_id", "page_revision_id")


def scan_6_contribution_revisions(spark, d, contributor=CONTRIBUTOR):
    return scan_6_contributions(spark, d, contributor).select("namespace_id", "page_id", "page_revision_id")


def scan_7_deleted_users(spark, d):
    return _revisions(spark, d).where("user_deleted")


def scan_7_null_comments(spark, d):
    return _revisions(spark, d).where(F.col("comment").isNull())


def scan_8_with_text(spark, d):
    return _revisions(spark, d).where("text_available")


def scan_8_longest_with_text(spark, d):
    keys = ["page_revision_id", "page_id", "article_text_length"]
    return scan_8_with_text(spark, d).select(*keys).distinct().orderBy(F.desc("article_text_length"), "page_revision_id").limit(10)


def scan_9_revisions_of_page(spark, d, page=PAGE):
    return _revisions(spark, d).where(F.col("page_id") == page).select("page_revision_id")


def scan_10_newest_pages(spark, d):
    return _pages(spark, d).select("namespace_id", "page_id", "page_name", "redirect_title").distinct().orderBy(F.desc("page_id")).limit(1000)


def scan_11_named_users(spark, d, names=NAMES):
    users = table(spark, d, "wiki_user").select("user_id", "user_name").distinct()
    return users.where(ci_in(F.col("user_name"), list(names))).orderBy("user_id", "user_name").limit(10)


def scan_12_run_minutes(spark, d, first=RUN_KEY):
    minutes = datediff_boundaries("MINUTE", F.col("start_time"), F.col("end_time")).alias("DurationMinutes")
    run = table(spark, d, "load_run").where(F.col("run_id") >= first)
    return run.select(
        F.col("source_file_name").alias("SourceFileName"), minutes, F.col("start_time").alias("StartTime"), F.col("end_time").alias("EndTime")
    ).orderBy(F.desc("StartTime"), "SourceFileName")


# --- Aggregates ----------------------------------------------------------------------------------------------------------------
def agg_1_users(spark, d):
    return table(spark, d, "wiki_user").agg(F.count(F.lit(1)).alias("CountUsers"))


def agg_1_revisions(spark, d):
    return _revisions(spark, d).agg(F.count(F.lit(1)).alias("CountRevisions"))


def agg_1_pages(spark, d):
    return _pages(spark, d).agg(F.count(F.lit(1)).alias("CountPages"))


def agg_1_activity(spark, d):
    return _activity(spark, d).agg(F.count(F.lit(1)).alias("CountActivity"))


def agg_2_work_per_run(spark, d):
    a = _activity(spark, d)
    return a.where(_some_activity(a)).groupBy("RunID").agg(F.sum("WorkCount").alias("WorkCount")).orderBy("RunID")


def agg_3_text_states(spark, d):
    available = F.col("text_available")
    return (
        _revisions(spark, d).groupBy(F.col("namespace_id").alias("NamespaceID"))
        .agg(
            F.count_if(available).alias("TextAvailable"),
            F.count_if(~available).alias("TextNotAvailable"),
            F.count_if(available.isNull()).alias("TextAvailableNull"),
        )
        .orderBy("NamespaceID")
    )


def agg_4_id_ranges(spark, d):
    return (
        _revisions(spark, d).groupBy(F.col("namespace_id").alias("NamespaceID"))
        .agg(F.min("page_id").alias("Min"), F.max("page_id").alias("Max"), F.count("page_revision_id").alias("Count"))
        .orderBy("NamespaceID")
    )


def agg_5_id_ranges_texts(spark, d):
    texts = table(spark, d, "page_revision_text").groupBy(F.col("namespace_id").alias("NamespaceID")).agg(F.count(F.lit(1)).alias("Texts"))
    joined = agg_4_id_ranges(spark, d).join(texts, "NamespaceID", "left")
    return joined.withColumn("Texts", F.coalesce("Texts", F.lit(0))).orderBy("NamespaceID")


def agg_6_revisions_per_page(spark, d):
    totals = _revisions(spark, d).groupBy("page_id").agg(F.count("page_revision_id").alias("PageRevisionCount"))
    joined = totals.join(_pages(spark, d).select("page_id", F.col("page_name").alias("PageName")), "page_id")
    return joined.select(F.col("page_id").alias("PageID"), "PageName", "PageRevisionCount").orderBy(F.desc("PageRevisionCount"), "PageID")


def agg_7_totals_per_namespace(spark, d):
    totals = (
        _revisions(spark, d).groupBy("namespace_id", "page_id").agg(F.count("page_revision_id").alias("n"))
        .groupBy("namespace_id").agg(F.count("page_id").alias("DistinctPages"), F.sum("n").alias("PageRevisions"))
    )
    joined = totals.join(_spaces(spark, d), "namespace_id")
    return joined.select(F.col("namespace_name").alias("NamespaceName"), "DistinctPages", "PageRevisions").orderBy("NamespaceName")


def agg_8_pages_per_namespace(spark, d):
    counts = _pages(spark, d).groupBy("namespace_id").agg(F.count(F.lit(1)).alias("PageCount"))
    joined = counts.join(_spaces(spark, d), "namespace_id")
    return joined.select(
        F.col("namespace_id").alias("NamespaceID"), F.col("namespace_name").alias("NamespaceName"), "PageCount"
    ).orderBy(F.desc("PageCount"), "NamespaceID")


def agg_9_anonymous(spark, d):
    anonymous = _revisions(spark, d).where(F.col("contributor_id").isNull())
    counts = anonymous.groupBy(F.col("ip_address").alias("IPAddress")).agg(F.count("ip_address").alias("Contributions"))
    return counts.orderBy(F.desc("Contributions"), "IPAddress")


def agg_10_texts_per_page(spark, d):
    return (
        _revisions(spark, d).groupBy(F.col("page_id").alias("PageID"))
        .agg(F.count("page_id").alias("TotalRevisions"), F.count_if("text_available").alias("RevisionsWithText"))
        .orderBy(F.desc("TotalRevisions"), "PageID")
    )


def agg_11_text_lengths(spark, d):
    size = tsql_len(F.col("article_text"))
    texts = table(spark, d, "page_revision_text").groupBy("namespace_id").agg(
        F.count("page_id").alias("PageCount"), F.min(size).alias("MinLength"), F.sum(size).alias("__sum"), F.count(size).alias("__n"),
        F.max(size).alias("MaxLength"),
    )
    joined = texts.withColumn("AverageLength", avg_int(F.col("__sum"), F.col("__n"))).join(_spaces(spark, d), "namespace_id")
    return joined.select(
        F.col("namespace_id").alias("NamespaceID"), F.col("namespace_name").alias("NamespaceName"), "PageCount", "MinLength",
        "AverageLength", "MaxLength",
    ).orderBy("NamespaceID")


def _histogram(spark, d, bounds, strict):
    counts = _revisions(spark, d).where("namespace_id = 0").groupBy("page_id").agg(F.count("page_revision_id").alias("n"))
    ladder = None
    for i, (low, high) in enumerate(bounds):
        inside = (F.col("n") > low) if strict else (F.col("n") >= low)
        if high is not None:
            inside = inside & ((F.col("n") < high) if strict else (F.col("n") <= high))
        ladder = F.when(inside, i) if ladder is None else ladder.when(inside, i)
    rows = spark.createDataFrame([(i, lo, hi) for i, (lo, hi) in enumerate(bounds)], "bucket int, LowBound int, HighBound int")
    buckets = counts.groupBy(ladder.alias("bucket")).agg(F.count(F.lit(1)).alias("PagesInBucket"))
    return buckets.join(F.broadcast(rows), "bucket").select("LowBound", "HighBound", "PagesInBucket").orderBy("LowBound")  # 13 rows


def agg_12_histogram_strict(spark, d):
    """Both bounds exclusive, as in the reference: a page with exactly a bound's count is in no bucket."""
    return _histogram(spark, d, STRICT_BOUNDS, True)


def agg_12_histogram(spark, d):
    """Both bounds inclusive: every page is in one bucket."""
    return _histogram(spark, d, BOUNDS, False)


def _phrase_revisions(spark, d, contributor, phrase):
    r = _revisions(spark, d)
    return r.where((r["contributor_id"] == contributor) & ci_like(r["comment"], phrase))


def agg_13_page_periods(spark, d, contributor=CONTRIBUTOR, phrase=PHRASE, since=FROM, until=TO):
    r = _phrase_revisions(spark, d, contributor, phrase)
    when = F.col("revision_when")
    r = r.where((when >= F.lit(since).cast("timestamp_ntz")) & (when <= F.lit(until).cast("timestamp_ntz")) & (F.col("namespace_id") == 0))
    return r.groupBy(F.col("page_id").alias("PageID")).agg(F.min(when).alias("RevLow"), F.max(when).alias("RevHigh"))


def agg_14_null_keys(spark, d):
    values = spark.createDataFrame([(3,), (None,), (None,)], "a int")
    return values.groupBy("a").agg(F.count(F.lit(1)).alias("n")).select(F.coalesce("a", F.lit(5)).alias("value"))


def agg_15_page_contributors(spark, d, page=PAGE):
    r = _revisions(spark, d).where(F.col("page_id") == page)
    return r.groupBy(F.col("contributor_id").alias("ContributorID")).agg(F.count(F.lit(1)).alias("ContributorCount"))


# --- Joins ---------------------------------------------------------------------------------------------------------------------
def join_6_text_missing(spark, d):
    keys = ["namespace_id", "page_id", "page_revision_id"]
    texts = table(spark, d, "page_revision_text").select(*keys)
    flagged = _revisions(spark, d).where("text_available").select(*keys)
    out = flagged.join(texts, keys, "left_anti")
    return out.toDF("NamespaceID", "PageID", "PageRevisionID").orderBy("NamespaceID", "PageID", "PageRevisionID")


def _rows_without(rows, known, key):
    """``rows`` whose ``key`` is not among ``known``: keys are reduced before they meet, so a hot key crosses the shuffle once."""
    absent = rows.select(key).distinct().join(known.select(key), key, "left_anti")
    return salted_lookup(rows, absent, key, "inner").select(*rows.columns)


def join_7_no_page(spark, d):
    """Revisions of unknown pages.  Page ids are never null, so NOT IN is a plain anti join that drops null left sides."""
    r = _revisions(spark, d).where(F.col("page_id").isNotNull())
    return _rows_without(r, _pages(spark, d), "page_id")


def join_8_unknown_users(spark, d):
    """Revisions credited to an id other than 0 that is no user; anonymous revisions are left out, as NOT IN does."""
    r = _revisions(spark, d).where(F.col("contributor_id").isNotNull() & (F.col("contributor_id") != 0))
    return _rows_without(r, table(spark, d, "wiki_user").withColumnRenamed("user_id", "contributor_id"), "contributor_id")


def join_9_unknown_users_sample(spark, d):
    return join_8_unknown_users(spark, d).orderBy("page_revision_id", "loaded_at", "run_id").limit(10)


def join_10_page_bounds(spark, d, contributor=CONTRIBUTOR, phrase=PHRASE, namespace=PROJECT_NAMESPACE, skip=ROBOTS):
    """Per revision of the contributor in a namespace with the phrase: first and last time of its page, skipping some users."""
    wanted = _phrase_revisions(spark, d, contributor, phrase).where(F.col("namespace_id") == namespace)
    others = _revisions(spark, d).where(~F.col("contributor_id").isin(list(skip)))  # null contributors drop out
    needed = wanted.select("page_id").distinct()
    bounds = others.join(needed, "page_id", "left_semi").groupBy("page_id").agg(
        F.min("revision_when").alias("MinRevWhen"), F.max("revision_when").alias("MaxRevWhen")
    )
    return wanted.join(bounds, "page_id", "left").select("page_revision_id", "page_id", "MinRevWhen", "MaxRevWhen")


def first_with_prefix(names: DataFrame, titles: DataFrame, prefix: str) -> DataFrame:
    """(PageName, DiscussionPage): of each name the first of ``titles`` (column title) that begins with ``prefix`` and the name.

    Case does not count, wildcards in a name are plain characters.  Every title is joined by the beginnings it has after the prefix,
    so the work is linear in the text of the titles, and a name keeps one title before anything is joined to it.
    """
    rest = F.lower(F.substring("title", len(prefix) + 1, 1 << 30))
    fitting = titles.where(F.startswith(F.lower("title"), F.lit(prefix.lower()))).select("title", rest.alias("rest"))
    starts = fitting.select("title", F.explode(F.transform(F.sequence(F.lit(0), F.length("rest")), lambda n: F.substring(F.col("rest"), F.lit(1), n))).alias("start"))
    asked = names.select(F.col("PageName"), F.lower("PageName").alias("start")).distinct()
    firsts = starts.join(asked.select("start").distinct(), "start", "left_semi").groupBy("start").agg(F.min("title").alias("DiscussionPage"))
    return asked.join(firsts, "start").select("PageName", "DiscussionPage")


def _discussions(spark, d, names, namespace, prefix):
    titles = _pages(spark, d).where(F.col("namespace_id") == namespace).select(F.col("page_name").alias("title")).distinct()
    return names.join(first_with_prefix(names, titles, prefix), "PageName", "left")


def join_11_discussion_page(spark, d, namespace=DISCUSSION_NAMESPACE, prefix=DISCUSSION_PREFIX):
    """Per article, the first title of the discussion namespace that begins with a fixed prefix and the article's name."""
    names = _pages(spark, d).where("namespace_id = 0").select("page_id", F.col("page_name").alias("PageName")).distinct()
    return _discussions(spark, d, names, namespace, prefix).select("page_id", "PageName", "DiscussionPage")


def join_14_sizes(spark, d):
    """Per source file, bytes of runs that succeeded and of the others, in MB; correlated sums as one aggregate."""
    ok = F.coalesce(F.col("result").startswith("Success"), F.lit(False))
    mb = F.col("source_file_size").cast("decimal(20,0)") * F.lit(Decimal("8.0")) / F.lit(Decimal(1024))
    sums = table(spark, d, "load_run").groupBy(F.col("source_file_name").alias("SourceFileName")).agg(
        F.round(F.sum(F.when(ok, mb)), 3).cast("double").alias("LoadedMB"), F.round(F.sum(F.when(~ok, mb)), 3).cast("double").alias("OtherMB")
    )
    return sums.orderBy(F.desc("LoadedMB"), "SourceFileName")


# --- Top k ---------------------------------------------------------------------------------------------------------------------
def _page_names(spark, d, *keys):
    return _pages(spark, d).select(*keys, F.col("page_name").alias("PageName")).distinct()


def top_1_pages(spark, d, k=100):
    counts = _revisions(spark, d).groupBy("namespace_id", "page_id").agg(F.count("page_revision_id").alias("RevisionCount"))
    top = counts.orderBy(F.desc("RevisionCount"), "page_id", "namespace_id").limit(k)
    joined = top.join(_page_names(spark, d, "page_id"), "page_id").join(F.broadcast(_spaces(spark, d)), "namespace_id")  # 24 rows
    return joined.select(F.col("namespace_name").alias("NamespaceName"), "PageName", "RevisionCount").orderBy(F.desc("RevisionCount"), "PageName")


def top_2_pages_two_keys(spark, d, k=100):
    counts = _revisions(spark, d).groupBy("namespace_id", "page_id").agg(F.count("page_revision_id").alias("RevisionCount"))
    top = counts.orderBy(F.desc("RevisionCount"), "page_id", "namespace_id").limit(k)
    joined = top.join(_page_names(spark, d, "page_id", "namespace_id"), ["page_id", "namespace_id"])
    joined = joined.join(F.broadcast(_spaces(spark, d)), "namespace_id")  # 24 rows
    return joined.select(F.col("namespace_name").alias("NamespaceName"), "PageName", "RevisionCount").orderBy(F.desc("RevisionCount"), "PageName")


def _users(spark, d):
    return table(spark, d, "wiki_user").select("user_id", F.col("user_name").alias("UserName")).distinct()


def top_3_contributors(spark, d, k=1000):
    tally = _revisions(spark, d).where(F.col("contributor_id").isNotNull()).groupBy("contributor_id").agg(
        F.count("contributor_id").alias("Contributions")
    )
    joined = tally.join(_users(spark, d), F.col("contributor_id") == F.col("user_id"))
    return joined.select(F.col("user_id").alias("UserID"), "UserName", "Contributions").orderBy(
        F.desc("Contributions"), "UserID", "UserName"
    ).limit(k)


def top_4_contributors(spark, d, k=10):
    tally = _revisions(spark, d).where(F.col("contributor_id") != 0).groupBy("contributor_id").agg(F.count("contributor_id").alias("ContribCount"))
    joined = tally.join(_users(spark, d), F.col("contributor_id") == F.col("user_id"))
    return joined.select(F.col("contributor_id").alias("ContributorID"), "UserName", "ContribCount").orderBy(
        F.desc("ContribCount"), "ContributorID", "UserName"
    ).limit(k)


def _longest_texts(spark, d, k):
    texts = table(spark, d, "page_revision_text").where("namespace_id = 0")
    sizes = texts.select("page_id", "page_revision_id", tsql_len(F.col("article_text")).alias("ArticleLength")).distinct()
    return sizes.orderBy(F.desc("ArticleLength"), "page_revision_id").limit(k)


def top_5_longest_texts(spark, d, k=10):
    """Only keys and lengths are ranked; the k texts are fetched after that."""
    top = _longest_texts(spark, d, k)
    texts = table(spark, d, "page_revision_text").where("namespace_id = 0").select("page_revision_id", "article_text")
    found = texts.join(F.broadcast(top), "page_revision_id").dropDuplicates(["page_id", "page_revision_id"])  # k rows
    return found.select(
        F.col("page_id").alias("PageID"), F.col("page_revision_id").alias("PageRevisionID"), "ArticleLength",
        gzip_length(F.col("article_text")).alias("CompressedLength"),
    ).orderBy(F.desc("ArticleLength"), "PageRevisionID")


def top_5_longest_lengths(spark, d, k=10):
    return _longest_texts(spark, d, k).withColumnsRenamed({"page_id": "PageID", "page_revision_id": "PageRevisionID"})


# --- Composite statements ------------------------------------------------------------------------------------------------------
def comp_1_contributions(spark, d, contributor=CONTRIBUTOR, phrase=PHRASE, namespace=PROJECT_NAMESPACE):
    r = _phrase_revisions(spark, d, contributor, phrase).where(F.col("namespace_id") == namespace)
    pages = _page_names(spark, d, "page_id", "namespace_id")
    return r.join(pages, ["page_id", "namespace_id"]).select(*r.columns, "PageName")


def comp_2_table_rows(spark, d, contributor=CONTRIBUTOR, phrase=PHRASE, namespace=PROJECT_NAMESPACE, skip=ROBOTS):
    bounds = join_10_page_bounds(spark, d, contributor, phrase, namespace, skip)
    names = _page_names(spark, d, "page_id", "namespace_id").where(F.col("namespace_id") == namespace)
    joined = bounds.join(names, "page_id")
    row = F.concat(F.lit("|| [["), after_first(F.col("PageName"), "/"), F.lit("]] || [["), F.col("PageName"), F.lit("| link]] || ||"))
    return joined.select(
        iso_seconds(F.col("MinRevWhen"), True).alias("FirstWhen"), row.alias("Row"), iso_seconds(F.col("MaxRevWhen"), True).alias("LastWhen")
    ).orderBy("FirstWhen")


def _period_names(spark, d, **kw):
    return agg_13_page_periods(spark, d, **kw).join(_page_names(spark, d, "page_id").withColumnRenamed("page_id", "PageID"), "PageID")


def comp_3_period_rows(spark, d, **kw):
    x = _period_names(spark, d, **kw)
    row = F.concat(F.lit("| "), iso_seconds(F.col("RevLow")), F.lit(" || ["), F.col("PageName"), F.lit("] || || || "), iso_seconds(F.col("RevHigh")))
    return x.orderBy("RevLow", "PageID").select(row.alias("Row"))


def comp_4_period_discussions(spark, d, namespace=0, prefix=DISCUSSION_PREFIX, **kw):
    """Of a contributor's pages the period and the first title of a namespace that begins with a prefix and the page's name."""
    joined = _discussions(spark, d, _period_names(spark, d, **kw), namespace, prefix)
    return joined.orderBy("RevLow", "PageID").select("RevLow", "PageName", iso_seconds(F.col("RevHigh")).alias("RevHigh"), "DiscussionPage")


def _one_text(spark, d, revision):
    texts = table(spark, d, "page_revision_text")
    wanted = texts.agg(F.min("page_revision_id").alias("page_revision_id")) if revision is None else spark.createDataFrame([(revision,)], "page_revision_id long")
    return texts.join(F.broadcast(wanted), "page_revision_id").dropDuplicates(["page_revision_id"])  # one row


def comp_5_one_text(spark, d, revision=None):
    """The compressed bytes of one text."""
    one = _one_text(spark, d, revision)
    return one.select("page_revision_id", gzip_bytes(F.col("article_text")).alias("Compressed"))


def comp_5_text_restored(spark, d, revision=None):
    """The same text after compression and decompression, as its hash."""
    return comp_5_one_text(spark, d, revision).select("page_revision_id", F.md5(gunzip(F.col("Compressed"))).alias("TextHash"))


def comp_6_page_users(spark, d, page=PAGE, k=100):
    counts = agg_15_page_contributors(spark, d, page).where(F.col("ContributorID").isNotNull())
    joined = _users(spark, d).join(counts, F.col("user_id") == F.col("ContributorID"), "left")
    return joined.select(F.col("user_id").alias("UserID"), "UserName", "ContributorCount").orderBy(
        F.desc_nulls_last("ContributorCount"), "UserID", "UserName"
    ).limit(k)


# --- Curation over the tables --------------------------------------------------------------------------------------------------
def cur_1_retention(spark, d):
    """Revisions whose text retention keeps: first, last and every hundredth of each page."""
    distinct = _revisions(spark, d).select("page_id", "page_revision_id").distinct()
    ranked = ordinal_in_group(distinct, "page_id", "page_revision_id")
    return ranked.where(retained(F.col("ordinal"), F.col("group_size"))).select("page_id", "page_revision_id", "ordinal")


def cur_3_delta(spark, d):
    """Texts on hand against the revision table: revisions unknown there, or flagged there as without text."""
    texts = table(spark, d, "page_revision_text").select("page_id", "page_revision_id", F.lit(True).alias("text_available")).distinct()
    return needed_revisions(texts, _revisions(spark, d)).select("page_id", "page_revision_id", "is_new")


def cur_6_merge_counts(spark, d):
    """Contributors of the revisions merged into the users: how many would be added, how many rows are already there."""
    incoming = _revisions(spark, d).where(F.col("contributor_id").isNotNull()).select(F.col("contributor_id").alias("user_id"))
    return merge_counts(incoming, table(spark, d, "wiki_user"), ["user_id"])


def cur_12_page_upsert(spark, d):
    """The latest delivery of each page merged over the earliest: one row per page with the latest redirect."""
    pages = _pages(spark, d)
    ends = lambda f: pages.groupBy("page_id").agg(f(F.struct("redirect_title", "page_name"), "loaded_at").alias("r"))
    old = ends(F.min_by).select("page_id", "r.page_name", "r.redirect_title")
    new = ends(F.max_by).select("page_id", "r.page_name", "r.redirect_title")
    return upsert(old, new, ["page_id"], ["page_name", "redirect_title"]).select("page_id", "page_name", "redirect_title")


# --- Ingest statistics ---------------------------------------------------------------------------------------------------------
def stat_1_totals(spark, d):
    r = _revisions(spark, d)
    anonymous = r["contributor_id"].isNull() & r["ip_address"].isNotNull()
    return r.agg(
        F.count_distinct("page_id").alias("Pages"), F.count(F.lit(1)).alias("Revisions"), F.count_if("is_minor").alias("MinorRevisions"),
        F.count_if(anonymous).alias("AnonymousRevisions"), F.max("article_text_length").alias("LongestText"),
    )


def stat_3_contributors(spark, d):
    """Contributions per user name; names are those of the user table."""
    counts = _revisions(spark, d).where(F.col("contributor_id").isNotNull()).groupBy("contributor_id").agg(F.count(F.lit(1)).alias("n"))
    names = table(spark, d, "wiki_user").groupBy("user_id").agg(F.min_by("user_name", F.struct("loaded_at", "user_name")).alias("UserName"))
    joined = counts.join(names, F.col("contributor_id") == F.col("user_id"))
    return joined.groupBy("UserName").agg(F.sum("n").alias("Contributions"))


def stat_4_longest_comment(spark, d):
    r = _revisions(spark, d).where(F.col("comment").isNotNull())
    best = F.max(F.struct(F.length("comment").alias("size"), (-F.col("page_revision_id")).alias("id"), F.col("comment")))
    return r.agg(best.alias("b")).select(F.col("b.size").cast("long").alias("Length"), F.col("b.comment").alias("Comment"))


def stat_6_pages_per_namespace(spark, d):
    r = _revisions(spark, d).select("namespace_id", "page_id").distinct()
    return r.groupBy(F.col("namespace_id").alias("NamespaceID")).agg(F.count(F.lit(1)).alias("Pages"))


def _written_pages(spark, d):
    """Every document written as a one-revision page of a dump and parsed back."""
    docs = table(spark, d, "documents")
    revision = to_revision_xml(F.col("doc_id"), F.col("fetched_at"), F.lit("A & B"), F.col("text"))
    xml = to_page_xml(F.col("title"), F.lit(0), F.col("doc_id"), revision)
    return spread(docs.select(xml.alias("xml"))).select(parse_page(F.col("xml")).alias("page")).select("page.*")


def ing_1_round_trip(spark, d):
    """Id, title, time, user, text hash and length of the documents parsed back."""
    rows = revisions_table(_written_pages(spark, d), keep=["title"])
    return rows.select(
        F.col("page_id").alias("doc_id"), "title", F.md5("article_text").alias("text_hash"), F.col("article_text_length").cast("long").alias("n_chars"),
        "user_name", F.date_trunc("second", F.col("revision_when")).cast("timestamp_ntz").alias("fetched_second"),
    )


def _edge_pages(spark, d):
    """Every user as a page whose one revision shows a different edge case of a dump, by the user's id."""
    users = table(spark, d, "wiki_user").groupBy("user_id").agg(F.min("user_name").alias("user_name"))
    case = F.col("user_id") % 6
    name = F.concat(F.lit("<username>"), escape_xml(F.col("user_name")), F.lit("</username>"))
    contributor = (
        F.when(case == 0, F.lit("<contributor><ip>192.0.2.7</ip></contributor>"))
        .when(case == 1, F.lit('<contributor deleted="deleted" />'))
        .when(case == 2, F.concat(F.lit("<contributor>"), name, F.lit("<id>0</id></contributor>")))
        .otherwise(F.concat(F.lit("<contributor>"), name, F.lit("<id>"), F.col("user_id").cast("string"), F.lit("</id></contributor>")))
    )
    text = F.when(case == 3, F.lit("<text />")).when(case == 4, F.lit("<text></text>")).otherwise(F.concat(F.lit("<text>"), escape_xml(F.col("user_name")), F.lit("</text>")))
    comment = F.when(case == 5, F.concat(F.lit("<comment>"), F.repeat(F.lit("c"), 900), F.lit("</comment>"))).when(case == 4, F.lit("<comment/>")).otherwise(F.lit(""))
    extra = F.concat(F.when(case == 2, F.lit("<minor />")).otherwise(F.lit("")), F.when(case == 0, F.lit("<parentid>77</parentid>")).otherwise(F.lit("")))
    redirect = F.when(case == 1, F.lit('<redirect title="Another page" />')).otherwise(F.lit(""))
    revision = F.concat(F.lit("<revision><id>"), F.col("user_id").cast("string"), F.lit("</id>"), extra, F.lit("<timestamp>2020-01-02T03:04:05Z</timestamp>"), contributor, comment, text, F.lit("</revision>"))
    xml = F.concat(F.lit("<page><title>T"), F.col("user_id").cast("string"), F.lit("</title><ns>0</ns><id>"), F.col("user_id").cast("string"), F.lit("</id>"), redirect, revision, F.lit("</page>"))
    return users.select(parse_page(xml).alias("page")).select("page.*")


def ing_2_edge_cases(spark, d):
    """The revisions of ``_edge_pages``: contributor kinds, named user 0, deleted and empty texts, capped comments, parents, minor edits."""
    return revisions_table(_edge_pages(spark, d)).select(
        "page_id", "parent_page_revision_id", "contributor_id", "ip_address", F.length("comment").alias("comment_length"), "text_available", "is_minor",
        "article_text_length", "text_deleted", "user_deleted", "user_name", "article_text", F.col("revision_when").cast("timestamp_ntz").alias("revision_when"),
    )


def ing_3_redirects(spark, d):
    return pages_table(_edge_pages(spark, d)).select("page_id", "page_name", "redirect_title")


# --- Expressions of the dialect ------------------------------------------------------------------------------------------------
def str_3_after_slash(spark, d):
    """Of every comment with a slash, up to 99 characters after the first."""
    r = _revisions(spark, d).where(F.instr("comment", "/") > 0)
    return r.select("page_revision_id", after_first(F.col("comment"), "/").alias("Rest"))


def dt_5_day_number(spark, d):
    """A date as a number of days."""
    return spark.range(1).select(F.unix_date(F.lit("2024-08-01").cast("date")).alias("DayNumber"))


def utf_16_lengths(spark, d):
    """Length of every text in characters and in UTF-16 units."""
    texts = table(spark, d, "page_revision_text").select("page_revision_id", F.length("article_text").alias("Characters"), utf16_len(F.col("article_text")).alias("Units"))
    return texts.distinct()


def set_1_counts_union(spark, d):
    """The one set operation of the reference: named counts, one below the other."""
    return (
        agg_1_pages(spark, d).select(F.lit("Pages").alias("What"), F.col("CountPages").alias("Count"))
        .unionByName(agg_1_revisions(spark, d).select(F.lit("Revisions").alias("What"), F.col("CountRevisions").alias("Count")))
    )


QUERIES = {
    name: f for name, f in list(globals().items())
    if name.split("_")[0] in ("scan", "agg", "join", "top", "comp", "cur", "stat", "set", "ing", "str", "dt", "utf") and callable(f)
}
