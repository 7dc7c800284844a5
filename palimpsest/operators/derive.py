"""From parsed dump pages to rows of the loaded tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.functions.tsql import utf16_len
from palimpsest.operators.curate import RETAIN_EVERY, retained
from palimpsest.schemas import COMMENT_CAP, REDIRECT_CAP
from palimpsest.sources.dump import BLANK_MARK


def element_value(element: Column) -> Column:
    """Null for an absent or self-closing element, '' for an empty one, else its text."""
    closed = element["_selfclosed"]
    return F.when(element.isNull() | F.coalesce(closed == 1, F.lit(False)), F.lit(None).cast("string")).otherwise(
        F.regexp_replace(F.coalesce(element["_VALUE"], F.lit("")), rf"^{BLANK_MARK}(?=\s+$)", "")
    )


def contributor_kind(contributor: Column) -> Column:
    """'registered' (a name is given, even with id 0), 'anonymous' (an address only) or 'deleted' (neither name nor address)."""
    name, ip = contributor["username"], contributor["ip"]
    number = F.coalesce(contributor["id"], F.lit(0))
    return (
        F.when(name.isNotNull(), F.lit("registered"))
        .when((number == 0) & ip.isNotNull(), F.lit("anonymous"))
        .otherwise(F.lit("deleted"))
    )


def corrupt_pages(pages: DataFrame) -> DataFrame:
    """(page_id, problem) of pages that must not be loaded.

    ``no title``; ``no contributor``: a contributor element that is neither self-closing nor marked deleted and names nobody;
    ``repeated revision``: a revision id occurs twice in the page.
    """
    bare = F.exists(
        "revision",
        lambda r: r["contributor"].isNotNull() & r["contributor"]["_selfclosed"].isNull() & r["contributor"]["_deleted"].isNull()
        & r["contributor"]["username"].isNull() & r["contributor"]["ip"].isNull() & r["contributor"]["id"].isNull(),
    )
    ids = F.transform("revision", lambda r: r["id"])
    problems = F.array_compact(
        F.array(
            F.when(F.col("title").isNull(), F.lit("no title")),
            F.when(bare, F.lit("no contributor")),
            F.when(F.size(F.array_distinct(ids)) < F.size(ids), F.lit("repeated revision")),
        )
    )
    return pages.select(F.col("id").alias("page_id"), F.explode(problems).alias("problem"))


def pages_table(pages: DataFrame) -> DataFrame:
    """One row per page, pages without revisions included."""
    return pages.select(
        F.col("ns").alias("namespace_id"), F.col("id").alias("page_id"), F.col("title").alias("page_name"),
        F.substring(F.col("redirect._title"), 1, REDIRECT_CAP).alias("redirect_title"),
    )


def revisions_table(pages: DataFrame, *, every: int = RETAIN_EVERY, compat: bool = False, utf16: bool = False, keep: list[str] | None = None) -> DataFrame:
    """Rows of all revisions with ``user_name`` and the retained ``article_text``.

    Flags follow the parsed text, availability the retained one.  The order of a page's revisions is that of their ids, whatever
    their order in the file.  No shuffle: a page is one row.  ``compat`` sets the length of a dropped text to 0, as the reference
    does; by default the true length stays.  A first revision without parent has parent 0.  Comments keep their first 800 characters.
    ``utf16`` counts lengths in UTF-16 units instead of characters; ``keep`` names columns of ``pages`` to repeat on every row.
    """
    extra = list(keep or [])
    ordered = F.array_sort("revision", lambda a, b: F.when(a["id"] < b["id"], -1).when(a["id"] > b["id"], 1).otherwise(0))
    flat = pages.withColumn("n", F.size("revision")).select("ns", F.col("id").alias("page_id"), "n", *extra, F.posexplode(ordered).alias("i", "r"))
    text = element_value(F.col("r.text"))
    kind = contributor_kind(F.col("r.contributor"))
    held = retained(F.col("i"), F.col("n"), every)
    length = F.coalesce(utf16_len(text) if utf16 else F.length(text), F.lit(0))
    if compat:
        length = F.when(held, length).otherwise(F.lit(0))
    kept = F.when(held, text)
    return flat.select(
        F.col("ns").alias("namespace_id"),
        "page_id",
        F.col("r.id").alias("page_revision_id"),
        F.coalesce("r.parentid", F.lit(0)).cast("long").alias("parent_page_revision_id"),
        F.col("r.timestamp").alias("revision_when"),
        F.when(kind == "registered", F.coalesce("r.contributor.id", F.lit(0))).cast("long").alias("contributor_id"),
        F.when(kind == "anonymous", F.col("r.contributor.ip")).alias("ip_address"),
        F.substring(element_value(F.col("r.comment")), 1, COMMENT_CAP).alias("comment"),
        kept.isNotNull().alias("text_available"),
        F.col("r.minor").isNotNull().alias("is_minor"),
        length.cast("int").alias("article_text_length"),
        text.isNull().alias("text_deleted"),
        (kind == "deleted").alias("user_deleted"),
        F.when(kind == "registered", F.col("r.contributor.username")).alias("user_name"),
        kept.alias("article_text"),
        *extra,
    )


def ingest_statistics(pages: DataFrame) -> DataFrame:
    """One row: pages, revisions, minor and anonymous revisions, distinct contributor names, longest comment and text.

    Lengths are those of the parsed values, before retention and caps; of equally long comments the one of the smallest id counts.
    """
    flat = pages.select(F.col("id").alias("page_id"), F.explode_outer("revision").alias("r"))
    comment, kind = element_value(F.col("r.comment")), contributor_kind(F.col("r.contributor"))
    longest = F.max(F.when(comment.isNotNull(), F.struct(F.length(comment).alias("n"), (-F.col("r.id")).alias("i"), comment.alias("c"))))
    return flat.agg(
        F.count_distinct("page_id").alias("pages"),
        F.count("r").alias("revisions"),
        F.count_if(F.col("r.minor").isNotNull()).alias("minor_revisions"),
        F.count_if(F.col("r").isNotNull() & (kind == "anonymous")).alias("anonymous_revisions"),
        F.count_distinct("r.contributor.username").alias("contributors"),
        longest.alias("b"),
        F.max(F.length(element_value(F.col("r.text")))).alias("longest_text"),
    ).select("pages", "revisions", "minor_revisions", "anonymous_revisions", "contributors", F.col("b.n").alias("longest_comment_length"),
             F.col("b.c").alias("longest_comment"), "longest_text")


def contributor_counts(pages: DataFrame) -> DataFrame:
    """(user_name, revisions) over all revisions with a name."""
    return pages.select(F.explode("revision.contributor.username").alias("user_name")).where("user_name IS NOT NULL").groupBy("user_name").agg(
        F.count(F.lit(1)).alias("revisions")
    )


def pages_per_namespace(pages: DataFrame) -> DataFrame:
    return pages.groupBy(F.col("ns").alias("namespace_id")).agg(F.count(F.lit(1)).alias("pages"))
