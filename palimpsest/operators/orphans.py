"""Orphan references: keys that name a parent which is missing, deleted or loaded later.

A Bloom filter over the parent keys is sent to every task; a reference it rejects is a definite orphan and takes no part in any
join.  The filter's size is a parameter, so what is broadcast does not grow with the data: beyond it the false-positive rate rises
and the exact join verifies more, the result stays the same.  Positive references are compressed to one row per key before the
join, so a key that a third of all rows name costs one row.  Only keys with at least one bad reference are joined back to the
rows; of these the heavy ones (bounded in number by ``1 / heavy_share``) by broadcast.  From the rows for the others heavy keys, bad or
sound, are taken out and a second filter, over the light bad keys, takes out most that are sound: what is shuffled has no hot key.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.common import first_delivery, require_columns
from palimpsest.scratch import Scratch

MISSING, LATE, DELETED = "missing", "late", "deleted"


@dataclass(frozen=True)
class Reference:
    """A child column that names a parent key.  ``loaded``/``deleted`` are parent columns; None: parents can only be missing."""

    field: str
    column: str
    parent: DataFrame
    key: str
    loaded: str | None = None
    deleted: str | None = None


def bloom_filter(keys: DataFrame, key: str, max_bits: int = 1 << 26, bits_per_key: int = 10) -> tuple[DataFrame | None, int]:
    """One-row table with the serialised Bloom filter of a key column, and the number of keys.  None for no keys."""
    count = keys.count()
    if count == 0:
        return None, 0
    spark = keys.sparkSession
    bits = int(min(max_bits, max(1024, count * bits_per_key)))
    jfilter = keys.select(F.xxhash64(F.col(key).cast("long")).alias("h"))._jdf.stat().bloomFilter("h", int(count), bits)
    out = spark.sparkContext._jvm.java.io.ByteArrayOutputStream()
    jfilter.writeTo(out)
    return spark.createDataFrame([(bytearray(out.toByteArray()),)], "bloom binary"), count


def might_contain(bloom: DataFrame | Column, key: Column) -> Column:
    """Bloom test inside whole-stage codegen; a table's filter enters the plan as a scalar subquery, else it is a binary literal."""
    jvm = SparkContext._active_spark_context._jvm
    utils = jvm.org.apache.spark.sql.classic.ExpressionUtils
    bits = bloom if isinstance(bloom, Column) else bloom.scalar()
    test = jvm.org.apache.spark.sql.catalyst.expressions.BloomFilterMightContain(
        utils.expression(bits._jc), utils.expression(F.xxhash64(key.cast("long"))._jc)
    )
    return Column(utils.column(test))


def orphan_references(
    child: DataFrame,
    references: list[Reference],
    *,
    child_id: str,
    child_loaded: str = "loaded_at",
    keep: list[str] | None = None,
    bloom_max_bits: int = 1 << 26,
    heavy_share: float = 0.001,
) -> DataFrame:
    """(child_id, *keep, ref_field, ref_key, ref_status) for every bad reference.

    Of several rows of one child or parent key the earliest ``loaded`` counts.  A null reference is none, a child without id is
    left out.  A target can be late and deleted for one reference; both rows are returned.  A null time on either side makes
    neither late nor deleted.  Empty children give no rows; an empty parent table makes all its references missing.
    """
    keep = [c for c in dict.fromkeys(keep or []) if c != child_id]
    columns = [r.column for r in references]
    require_columns(child, child_id, child_loaded, *columns, *keep)
    spark = child.sparkSession
    scratch = Scratch(spark, "orphans")
    narrow = child.select(*dict.fromkeys([child_id, child_loaded, *columns, *keep]))
    rows = scratch.write(first_delivery(narrow, child_id, child_loaded), "children")
    total = rows.count()
    found: list[DataFrame] = []
    for ref in references:
        require_columns(ref.parent, ref.key, *[c for c in (ref.loaded, ref.deleted) if c])
        loaded = F.col(ref.loaded) if ref.loaded else F.lit(None).cast("timestamp_ntz")
        deleted = F.col(ref.deleted) if ref.deleted else F.lit(None).cast("timestamp_ntz")
        parents = ref.parent.select(F.col(ref.key).cast("long").alias("__key"), loaded.alias("__loaded"), deleted.alias("__deleted"))
        parents = scratch.write(first_delivery(parents, "__key", "__loaded"), f"parents-{ref.column}")
        refs = rows.where(F.col(ref.column).isNotNull()).select(
            child_id, F.col(child_loaded).alias("__at"), F.col(ref.column).cast("long").alias("__key"), *keep
        )
        shape = [child_id, *keep, F.lit(ref.field).alias("ref_field"), F.col("__key").alias("ref_key")]
        bloom, _ = bloom_filter(parents, "__key", bloom_max_bits)
        if bloom is None:
            found.append(refs.select(*shape, F.lit(MISSING).alias("ref_status")))
            continue
        hit = might_contain(bloom, F.col("__key"))
        found.append(refs.where(~hit).select(*shape, F.lit(MISSING).alias("ref_status")))
        positive = refs.where(hit)
        by_key = positive.groupBy("__key").agg(
            F.count(F.lit(1)).alias("__n"), F.min("__at").alias("__first"), F.max("__at").alias("__last")
        )
        joined = by_key.join(parents.withColumn("__there", F.lit(True)), "__key", "left")
        heavy_at = max(1, int(total * heavy_share))
        wrong = F.col("__there").isNull() | (F.col("__loaded") > F.col("__first")) | (F.col("__deleted") <= F.col("__last"))
        flagged = joined.select(
            "__key", (F.col("__n") >= heavy_at).alias("__heavy"), "__loaded", "__deleted", F.col("__there").isNull().alias("__missing"),
            F.coalesce(wrong, F.lit(False)).alias("__bad"),
        )
        keys = scratch.write(flagged.where("__bad OR __heavy"), f"keys-{ref.column}")
        bad = keys.where("__bad").drop("__bad")
        found.append(_labelled(positive.join(F.broadcast(bad.where("__heavy")), "__key"), shape))
        few, _ = bloom_filter(bad.where("NOT __heavy"), "__key", bloom_max_bits)
        if few is None:
            continue
        rest = positive.join(F.broadcast(keys.where("__heavy").select("__key")), "__key", "left_anti")
        light = rest.where(might_contain(few, F.col("__key"))).join(bad.where("NOT __heavy"), "__key")
        found.append(_labelled(light, shape))
    out = found[0]
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _labelled(rows: DataFrame, shape: list) -> DataFrame:
    """``shape`` and every status of references joined to their bad keys."""
    statuses = F.array_compact(
        F.array(
            F.when(F.col("__missing"), F.lit(MISSING)),
            F.when(F.col("__loaded") > F.col("__at"), F.lit(LATE)),
            F.when(F.col("__deleted") <= F.col("__at"), F.lit(DELETED)),
        )
    )
    return rows.select(*shape, F.explode(statuses).alias("ref_status"))


def orphan_report(orphans: DataFrame, when: str) -> DataFrame:
    """Number of bad references per field, status and month of ``when`` (a null time gives a null month)."""
    month = F.date_format(F.col(when).cast("timestamp"), "yyyy-MM")
    return orphans.groupBy("ref_field", "ref_status", month.alias("month")).agg(F.count(F.lit(1)).alias("references"))
