"""Filling fixed-capacity containers: hierarchical multi-length packing.

Every item goes to the tier of the smallest capacity that holds it.  Tiers are packed from the widest down: first a tier's own
items, longest first, each into the fullest container that still takes it; then the gaps are filled with items of shorter tiers,
again longest first, so only what no gap takes opens containers further down.  An item longer than the widest capacity is cut into
full pieces and a rest.

Packing decides on the *histogram* of lengths, at most ``max(capacity)`` rows however many items there are; equal lengths are
placed in blocks.  The plan is a list of segments (length, first rank, count, tier, first container, offset); an item finds its
container by its rank among the items of its length, computed from salted windows and per-salt offsets.  No task sees all items.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.scratch import Scratch


@dataclass(frozen=True)
class Tier:
    """A container size."""

    tier_id: int
    capacity: int


def plan_tiers(histogram: dict[int, int], tiers: list[Tier]) -> tuple[list[tuple[int, int, int, int, int, int]], dict[int, int]]:
    """Segments (length, first rank, count, tier, first container, offset) and the number of containers per tier.

    ``histogram`` maps lengths from 1 to the widest capacity to their number of items.
    """
    left = {n: c for n, c in histogram.items() if c > 0}
    taken = dict.fromkeys(left, 0)
    ordered = sorted(tiers, key=lambda t: -t.capacity)
    segments: list[tuple[int, int, int, int, int, int]] = []
    containers: dict[int, int] = {}
    for i, tier in enumerate(ordered):
        floor = ordered[i + 1].capacity if i + 1 < len(ordered) else 0
        gaps: dict[int, list[tuple[int, int]]] = {}  # free space -> blocks (first container, number)
        free = 0  # bit set of the free spaces that have blocks
        opened = 0
        for length in sorted((n for n in left if n <= tier.capacity), reverse=True):
            while left.get(length):
                fitting = free >> length
                if fitting:
                    space = length + (fitting & -fitting).bit_length() - 1
                    first, number = gaps[space].pop()
                    used = min(number, left[length])
                    if used < number:
                        gaps[space].append((first + used, number - used))
                    if not gaps[space]:
                        free &= ~(1 << space)
                elif length > floor:
                    space, first, used = tier.capacity, opened, left[length]
                    opened += used
                else:
                    break
                segments.append((length, taken[length], used, tier.tier_id, first, tier.capacity - space))
                taken[length] += used
                left[length] -= used
                if space > length:
                    gaps.setdefault(space - length, []).append((first, used))
                    free |= 1 << (space - length)
            if not left.get(length):
                left.pop(length, None)
        containers[tier.tier_id] = opened
    return segments, containers


def cut_items(items: DataFrame, item_id: str, size: str, widest: int) -> DataFrame:
    """(item_id, piece, tokens): whole items, or full pieces and a rest of those longer than ``widest``."""
    pieces = F.explode(F.sequence(F.lit(0), ((F.col(size) - 1) / widest).cast("int")))
    tokens = F.least(F.lit(widest).cast("long"), F.col(size) - F.col("piece").cast("long") * widest)
    return items.where(F.col(size) > 0).select(F.col(item_id), F.col(size), pieces.alias("piece")).select(item_id, "piece", tokens.alias("tokens"))


def _locate(segments: list[tuple[int, int, int, int, int, int]], steps: dict[int, int]):
    table = np.array(sorted(segments), dtype=np.int64).reshape(-1, 6)
    starts = table[:, 0] * (1 << 42) + table[:, 1]
    step_of = dict(steps)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("tokens", "rank"))
            at = np.searchsorted(starts, length * (1 << 42) + rank, side="right") - 1
            row = table[at]
            container = row[:, 4] + rank - row[:, 1]
            group = np.array([step_of[t] for t in row[:, 3]], dtype=np.int64)
            yield pa.RecordBatch.from_pydict(
                {
                    "item": b.column("item"),
                    "piece": b.column("piece"),
                    "tokens": b.column("tokens"),
                    "spec_id": pa.array(row[:, 3].astype(np.int32)),
                    "container_id": pa.array(container),
                    "start": pa.array(row[:, 5]),
                    "step_group": pa.array(container % np.maximum(group, 1)),
                }
            )

    return locate


def pack(items: DataFrame, tiers: list[Tier], *, item_id: str, size: str, group_size: int = 64, rows_per_salt: int = 50_000) -> DataFrame:
    """(item, piece, tokens, spec_id, container_id, start, step_group) for every piece of every item.

    ``start`` is the piece's offset in its container; container ids count up from 0 within a tier.  A step group holds up to about
    ``group_size`` containers of a tier; neighbouring containers are filled alike and go to different groups, which balances them.
    Items of null or no size need no container and are left out; ids must be distinct.  No tiers is an error.
    """
    if not tiers or any(t.capacity < 1 for t in tiers):
        raise ValueError("capacities must be positive")
    spark = items.sparkSession
    scratch = Scratch(spark, "packing")
    widest = max(t.capacity for t in tiers)
    pieces = cut_items(items.select(F.col(item_id).cast("long").alias("item"), size), "item", size, widest)
    pieces = scratch.write(pieces, "pieces")
    histogram = {int(n): int(c) for n, c in pieces.groupBy("tokens").count().collect()}  # at most ``widest`` rows
    segments, containers = plan_tiers(histogram, tiers)
    steps = {t: -(-n // group_size) for t, n in containers.items()}
    salts = max(1, -(-max(histogram.values(), default=1) // rows_per_salt))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("item", "piece"), F.lit(salts)))
    counts = salted.groupBy("tokens", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("tokens").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("tokens", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("tokens", "salt").orderBy("item", "piece")
    ranked = salted.withColumn("inside", F.row_number().over(inside) - 1).join(offsets, ["tokens", "salt"])
    ranked = ranked.select("item", "piece", "tokens", (F.col("inside") + F.col("base")).cast("long").alias("rank"))
    schema = "item long, piece int, tokens long, spec_id int, container_id long, start long, step_group long"
    return ranked.mapInArrow(_locate(segments, steps), schema)


def packing_report(packed: DataFrame, specs: DataFrame) -> DataFrame:
    """Per container size: containers, pieces, tokens and the share of capacity in use."""
    filled = packed.groupBy("spec_id", "container_id").agg(F.sum("tokens").alias("used"), F.count(F.lit(1)).alias("pieces"))
    used = filled.groupBy("spec_id").agg(
        F.count(F.lit(1)).alias("containers"), F.sum("pieces").alias("pieces"), F.sum("used").alias("tokens"), F.max("used").alias("fullest")
    )
    rows = specs.select("spec_id", "spec_name", "capacity_tokens").join(used, "spec_id", "left")
    share = F.round(F.col("tokens") / (F.col("containers") * F.col("capacity_tokens")), 6)
    return rows.select("spec_id", "spec_name", "capacity_tokens", "containers", "pieces", "tokens", "fullest", share.alias("fill"))
