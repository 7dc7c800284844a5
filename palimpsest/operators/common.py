"""Small building blocks shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def require_columns(df: DataFrame, *names: str) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing column(s) {missing}; have {df.columns}")


def first_by(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark plans a group limit before the shuffle, so a key with very many copies sends one row per input partition, not all.
    """
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).where("__rank = 1").drop("__rank")


def first_delivery(df: DataFrame, key: str, loaded: str = "loaded_at") -> DataFrame:
    """The row with the earliest ``loaded_at`` of each key; null keys are left out; ties fall to the smallest row hash."""
    rest = [c for c in df.columns if c not in (key, loaded)]
    tie = F.xxhash64(*[F.col(c) for c in rest]) if rest else F.lit(0)
    return first_by(df.where(F.col(key).isNotNull()), [key], [F.col(loaded).asc_nulls_last(), tie])


def utc_seconds(ts: Column) -> Column:
    """Whole seconds since the epoch of a TIMESTAMP_NTZ or TIMESTAMP column read as UTC."""
    return F.unix_micros(ts.cast("timestamp")) / F.lit(1_000_000)


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; the session runs in UTC."""
    return F.unix_micros(ts.cast("timestamp"))


#: A lookup table of at most so many rows and bytes is broadcast; both are measured first.
BROADCAST_ROWS = 10_000
BROADCAST_BYTES = 8 << 20


def is_short(df: DataFrame) -> bool:
    """Whether a table may be broadcast: few rows, and few bytes as JSON, which no column's value is longer than."""
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*"))).cast("long")), F.lit(0))
    rows, size = df.limit(BROADCAST_ROWS + 1).agg(F.count(F.lit(1)), size).first()
    return rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES


def salted_lookup(df: DataFrame, lookup: DataFrame, keys: str | list[str], how: str = "left", salts: int = 8) -> DataFrame:
    """Join (``left`` or ``inner``) to a lookup table of one row per key; a hot key's rows, null keys too, are spread over ``salts`` tasks.

    A lookup that ``is_short`` is broadcast as it is.  A longer one is copied to every salt and joined by a shuffle; the hint keeps
    Spark, whose size estimate does not see the copies, from broadcasting them.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if is_short(lookup):
        return df.join(F.broadcast(lookup), keys, how)
    rest = [c for c in df.columns if c not in keys]
    salt = F.pmod(F.xxhash64(*rest), F.lit(salts)).cast("int") if rest else F.lit(0)
    copies = lookup.withColumn("__salt", F.explode(F.lit(list(range(salts)))))
    return df.withColumn("__salt", salt).join(copies.hint("merge"), [*keys, "__salt"], how).drop("__salt")


def spread(df: DataFrame, per_core: int = 4) -> DataFrame:
    """``df`` in enough partitions to keep all cores busy with work that costs far more than its bytes suggest.

    Rows straight from a scan of two partitions a core or more stay where they are, so large inputs are not shuffled.  The number is
    read from the plan; nothing runs for it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    shuffled = "Exchange" in df._jdf.queryExecution().executedPlan().toString()
    return df if not shuffled and df.rdd.getNumPartitions() >= 2 * cores else df.repartition(per_core * cores)
