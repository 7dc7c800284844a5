"""Curation: text retention, delta detection, insert-only merges and upserts, all as set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RETAIN_EVERY = 100


def ordinal_in_group(df: DataFrame, group: str, order: str, *, name: str = "ordinal", size: str = "group_size", width: int = 50_000) -> DataFrame:
    """``df`` with each row's 0-based ordinal by ``order`` (an integer) in its group, and the group's size.

    Rows are ranked inside ranges of ``width`` order values; the ranges' counts give the offsets.  A group of any size is spread over
    its ranges.  Rows of equal order are ranked arbitrarily among each other; null orders come first.
    """
    cell = F.coalesce(F.floor(F.col(order) / width), F.lit(-(1 << 40))).cast("long")
    celled = df.withColumn("__cell", cell)
    counts = celled.groupBy(group, "__cell").agg(F.count(F.lit(1)).alias("__n"))
    by_group = Window.partitionBy(group)
    before = by_group.orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(group).alias("__group"), F.col("__cell").alias("__at"), F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__base"),
        F.sum("__n").over(by_group).alias(size),
    )
    inside = F.row_number().over(Window.partitionBy(group, "__cell").orderBy(F.col(order).asc_nulls_first()))
    ranked = celled.withColumn("__inside", inside - 1)
    joined = ranked.join(offsets, F.col(group).eqNullSafe(F.col("__group")) & (F.col("__cell") == F.col("__at")))
    return joined.withColumn(name, (F.col("__inside") + F.col("__base")).cast("long")).drop(
        "__cell", "__at", "__group", "__inside", "__base"
    )


def retained(ordinal: Column, size: Column, every: int = RETAIN_EVERY) -> Column:
    """Whether retention keeps a text: the first, the last and every ``every``-th of a page's revisions."""
    return (ordinal % every == 0) | (ordinal == size - 1)


def thin_texts(revisions: DataFrame, *, page: str, revision: str, text: str, length: str | None = None, every: int = RETAIN_EVERY, compat: bool = False) -> DataFrame:
    """``revisions`` with the texts nulled that retention drops.

    Only (page, revision) is ranked and joined back, so dropped texts are never shuffled.  The true length stays; ``compat`` sets the
    ``length`` column to 0 for a dropped text.  (page, revision) must be distinct.
    """
    keys = ordinal_in_group(revisions.select(F.col(page).alias("__p"), F.col(revision).alias("__r")), "__p", "__r")
    keys = keys.select("__p", "__r", retained(F.col("ordinal"), F.col("group_size"), every).alias("__keep"))
    out = revisions.join(keys, F.col(page).eqNullSafe(F.col("__p")) & (F.col(revision) == F.col("__r"))).drop("__p", "__r")
    if compat and length:
        dropped = ~F.col("__keep") & F.col(text).isNotNull()
        out = out.withColumn(length, F.when(dropped, F.lit(0)).otherwise(F.col(length)))
    return out.withColumn(text, F.when(F.col("__keep"), F.col(text))).drop("__keep")


def thin_nested(revisions: Column, every: int = RETAIN_EVERY) -> Column:
    """Retention inside one page's array of revision structs (fields ``id``, ``text``): no shuffle, the page is one row."""
    ordered = F.array_sort(revisions)
    return F.transform(
        ordered, lambda r, i: r.withField("text", F.when((i % every == 0) | (i == F.size(ordered) - 1), r["text"]))
    )


def needed_revisions(incoming: DataFrame, known: DataFrame, *, page: str = "page_id", revision: str = "page_revision_id", text: str = "text_available") -> DataFrame:
    """Incoming rows that are unknown, or known without text while they bring one; ``is_new`` tells which."""
    have = known.groupBy(F.col(page).alias("__p"), F.col(revision).alias("__r")).agg(F.max(text).alias("__had"))
    joined = incoming.join(have, (F.col(page) == F.col("__p")) & (F.col(revision) == F.col("__r")), "left")
    upgrade = ~F.col("__had") & F.col(text)
    return joined.where(F.col("__r").isNull() | upgrade).withColumn("is_new", F.col("__r").isNull()).drop("__p", "__r", "__had")


def distinct_users(revisions: DataFrame, *, user: str = "contributor_id", name: str = "user_name", revision: str = "page_revision_id") -> DataFrame:
    """(user, name): of each registered user the name with the smallest revision id."""
    named = revisions.where(F.col(user).isNotNull() & F.col(name).isNotNull())
    return named.groupBy(user).agg(F.min_by(name, revision).alias(name))


def missing_rows(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Insert-only merge: one row per key of ``incoming`` that ``existing`` lacks."""
    return incoming.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti")


def merge_counts(incoming: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """One row (added, already): keys that an insert-only merge adds, and rows it does not."""
    counted = incoming.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))  # first, so that no hot key crosses the join
    seen = counted.join(existing.select(*keys).distinct().withColumn("there", F.lit(True)), keys, "left")
    added = F.coalesce(F.count_if(F.col("there").isNull()), F.lit(0))
    return seen.agg(added.alias("added"), (F.coalesce(F.sum("n"), F.lit(0)) - added).alias("already"))


def flag_where_staged(revisions: DataFrame, staged: DataFrame, *, revision: str = "page_revision_id", flag: str = "text_available") -> DataFrame:
    """``revisions`` with ``flag`` set for the staged ids."""
    ids = staged.select(F.col(revision).alias("__r")).distinct().withColumn("__hit", F.lit(True))
    joined = revisions.join(ids, F.col(revision) == F.col("__r"), "left")
    return joined.withColumn(flag, F.col(flag) | F.col("__hit").isNotNull()).drop("__r", "__hit")


def upsert(existing: DataFrame, incoming: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """All keys of both sides; ``values`` come from ``incoming`` where it has the key (null included), else from ``existing``."""
    new = incoming.dropDuplicates(keys).select(*keys, *[F.col(v).alias(f"__{v}") for v in values], F.lit(True).alias("__new"))
    joined = existing.join(new, keys, "full")
    for v in values:
        joined = joined.withColumn(v, F.when(F.col("__new"), F.col(f"__{v}")).otherwise(F.col(v)))
    return joined.drop("__new", *[f"__{v}" for v in values])
