"""Per-key results without hot tasks, by value-frequency compression.

Rows are grouped by (key, value) first.  That grouping spreads a hot key over as many reducers as it has values and shrinks it to
its distinct values; what follows works on (key, value, weight).  Sums, extremes, distinct counts and modes are then partial
aggregates; exact percentiles go through a two-level histogram whose levels are bounded by the value range, never by the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.operators.common import require_columns


def compress(df: DataFrame, key: str, value: str, extra: dict[str, Column] | None = None) -> DataFrame:
    """(key, value, weight, *extra): ``extra`` maps names to decomposable aggregates (min, max, sum).  Null keys are left out."""
    require_columns(df, key, value)
    aggs = [F.count(F.lit(1)).alias("weight")] + [c.alias(n) for n, c in (extra or {}).items()]
    return df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"), F.col(value).alias("value")).agg(*aggs)


def weighted_totals(weights: DataFrame, extra: list[Column] | None = None) -> DataFrame:
    """Per key: rows, distinct values, sum, mean, min, max and mode (ties: smallest value) of the weighted values.

    Null values count as rows but as no value.  A key with null values only has null sum, mean, extremes and mode.
    """
    weight = F.when(F.col("value").isNotNull(), F.col("weight")).otherwise(F.lit(0))
    mode = F.max(F.when(F.col("value").isNotNull(), F.struct(F.col("weight"), (-F.col("value").cast("long")).alias("neg"))))
    return (
        weights.groupBy("key")
        .agg(
            F.sum("weight").alias("rows"),
            F.count("value").alias("distinct_values"),
            F.sum(F.col("value").cast("long") * F.col("weight")).alias("value_sum"),
            F.sum(weight).alias("__n"),
            F.min("value").alias("value_min"),
            F.max("value").alias("value_max"),
            mode.alias("__mode"),
            *(extra or []),
        )
        .withColumn("value_mean", F.col("value_sum").cast("double") / F.nullif(F.col("__n"), F.lit(0)))
        .withColumn("value_mode", -F.col("__mode.neg"))
        .drop("__n", "__mode")
    )


def weighted_percentile(weights: DataFrame, q: float, name: str, cell: int = 256) -> DataFrame:
    """(key, name): the lower exact ``q``-percentile of integer values, the first whose cumulative weight reaches ``ceil(q * n)``.

    Level one sums weights per cell of ``cell`` neighbouring values and finds the cell that holds the rank; level two orders the
    values of that one cell.  A window partition is bounded by ``range / cell`` and by ``cell``.
    """
    w = weights.where(F.col("value").isNotNull()).select("key", F.col("value").cast("long").alias("value"), "weight")
    w = w.withColumn("cell", F.floor(F.col("value") / F.lit(cell)).cast("long"))
    cells = w.groupBy("key", "cell").agg(F.sum("weight").alias("cw"))
    by_key = Window.partitionBy("key")
    upto = by_key.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cells = cells.withColumn("cum", F.sum("cw").over(upto)).withColumn(
        "rank", F.greatest(F.lit(1), F.ceil(F.lit(q) * F.sum("cw").over(by_key)))
    )
    pick = cells.where((F.col("cum") >= F.col("rank")) & (F.col("cum") - F.col("cw") < F.col("rank")))
    pick = pick.select("key", "cell", (F.col("rank") - F.col("cum") + F.col("cw")).alias("rest"))
    inside = w.join(pick, ["key", "cell"])
    run = Window.partitionBy("key", "cell").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inside = inside.groupBy("key", "cell", "value", "rest").agg(F.sum("weight").alias("weight"))
    inside = inside.withColumn("cum", F.sum("weight").over(run)).where(F.col("cum") >= F.col("rest"))
    return inside.groupBy("key").agg(F.min("value").alias(name))


def heavy_keys(weights: DataFrame, total_rows: int, share: float) -> DataFrame:
    """(key, rows) of the keys that hold at least ``share`` of ``total_rows``: at most ``1 / share`` rows."""
    rows = weights.groupBy("key").agg(F.sum("weight").alias("rows"))
    return rows.where(F.col("rows") >= F.lit(share) * F.lit(total_rows))
