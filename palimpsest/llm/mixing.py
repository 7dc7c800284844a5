"""Mixing sources to target weights by min-cost flow over membership patterns.

A text that lies in several sources may serve any of them.  Distinct texts are grouped by their *pattern*, the set of target sources
that hold them; the flow runs over patterns, whose number is bounded by the subsets of the target sources, not over documents.  The
network is: tokens of a pattern, one arc per repetition at rising (convex) cost; a pattern to each of its sources, at most that
source's repetitions; a source to its quota.  The cheapest flow therefore repeats evenly and only where a quota needs it.  Documents
are then chosen in a seeded order: each (pattern, source) flow is an interval on the line of a pattern's cumulated tokens, laid out
once per repetition, and a document is used once for every time its start falls into the interval.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.scratch import Scratch

#: More distinct membership patterns than this are refused; with n target sources there are at most ``2**n - 1``.
MAX_PATTERNS = 20_000


@dataclass(frozen=True)
class Target:
    source: str
    share: float
    max_repeats: int


class _Flow:
    """Successive shortest paths with potentials on a small network of integer capacities and non-negative costs."""

    def __init__(self, nodes: int):
        self.arcs: list[list[int]] = []  # head, capacity, cost
        self.out: list[list[int]] = [[] for _ in range(nodes)]

    def add(self, a: int, b: int, capacity: int, cost: int) -> int:
        self.out[a].append(len(self.arcs))
        self.arcs.append([b, capacity, cost])
        self.out[b].append(len(self.arcs))
        self.arcs.append([a, 0, -cost])
        return len(self.arcs) - 2

    def run(self, s: int, t: int, wanted: int) -> int:
        sent, potential = 0, [0] * len(self.out)
        while sent < wanted:
            far = [float("inf")] * len(self.out)
            via = [-1] * len(self.out)
            far[s], queue = 0, [(0, s)]
            while queue:
                d, a = heapq.heappop(queue)
                if d > far[a]:
                    continue
                for e in self.out[a]:
                    b, capacity, cost = self.arcs[e]
                    if capacity > 0 and (nd := d + cost + potential[a] - potential[b]) < far[b]:
                        far[b], via[b] = nd, e
                        heapq.heappush(queue, (nd, b))
            if via[t] < 0:
                break
            reach = max(d for d in far if d < float("inf"))
            potential = [p + min(d, reach) for p, d in zip(potential, far)]
            push, b = wanted - sent, t
            while b != s:
                push = min(push, self.arcs[via[b]][1])
                b = self.arcs[via[b] ^ 1][0]
            b = t
            while b != s:
                self.arcs[via[b]][1] -= push
                self.arcs[via[b] ^ 1][1] += push
                b = self.arcs[via[b] ^ 1][0]
            sent += push
        return sent


def route(patterns: dict[tuple[str, ...], int], quotas: dict[str, int], repeats: dict[str, int]) -> tuple[dict[tuple[tuple[str, ...], str], int], int]:
    """Cheapest flow of tokens from patterns to source quotas: ({(pattern, source): tokens}, tokens sent)."""
    names, keys = sorted(quotas), sorted(patterns)
    net = _Flow(len(names) + len(keys) + 2)
    source_node = {n: i + 2 for i, n in enumerate(names)}
    for n in names:
        net.add(source_node[n], 1, quotas[n], 0)
    arcs = {}
    for i, key in enumerate(keys):
        node, members = len(names) + 2 + i, [n for n in key if n in quotas]
        for copy in range(1, max((repeats[n] for n in members), default=0) + 1):
            net.add(0, node, patterns[key], copy * copy)
        for n in members:
            arcs[key, n] = net.add(node, source_node[n], patterns[key] * repeats[n], 0)
    sent = net.run(0, 1, sum(quotas.values()))
    return {k: net.arcs[e ^ 1][1] for k, e in arcs.items() if net.arcs[e ^ 1][1]}, sent


def quotas_for(patterns: dict[tuple[str, ...], int], targets: list[Target], total: int | None) -> dict[str, int]:
    """Tokens per source.  Sources without any document get none and the others share the total in the ratio of their targets.

    With no total given it is the largest at which every quota can be met under the repetition caps.
    """
    there = [t for t in targets if t.share > 0 and t.max_repeats > 0 and any(t.source in k and v for k, v in patterns.items())]
    weight = sum(t.share for t in there)
    split = lambda whole: {t.source: int(whole * t.share / weight) for t in there}
    if not there:
        return {}
    if total is not None:
        return split(total)
    repeats = {t.source: t.max_repeats for t in there}
    low, high = 0, sum(v * max([repeats.get(n, 0) for n in k], default=0) for k, v in patterns.items())
    while low < high:
        middle = (low + high + 1) // 2
        q = split(middle)
        low, high = (middle, high) if route(patterns, q, repeats)[1] == sum(q.values()) else (low, middle - 1)
    return split(low)


def mix(
    docs: DataFrame, targets: list[Target], *, doc_id: str = "doc_id", text: str = "text", source: str = "source", size: str = "tokens",
    total: int | None = None, seed: int = 17, rows_per_bucket: int = 50_000,
) -> tuple[DataFrame, dict[str, int]]:
    """(doc_id, source, tokens, repeats) of the chosen documents, and the quotas.

    Rows with equal text are one document, named by its smallest id, and a member of all sources that hold it; it is used at most a
    source's ``max_repeats`` times for that source.  Rows of null text, id, source or size, of no tokens, or of sources without
    target take no part.  Documents are whole, so a source misses its quota by less than one document per flow.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "mixing")
    names = [t.source for t in targets]
    own = docs.where(F.col(source).isin(names) & F.col(text).isNotNull() & F.col(doc_id).isNotNull() & (F.col(size) > 0))
    units = (
        own.select(F.md5(text).alias("unit"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(size).cast("long").alias("tokens"))
        .groupBy("unit")
        .agg(F.min("doc_id").alias("doc_id"), F.min("tokens").alias("tokens"), F.array_join(F.sort_array(F.collect_set("source")), "\x1f").alias("pattern"))
    )
    units = scratch.write(units.select("doc_id", "tokens", "pattern"), "units")
    sizes = units.groupBy("pattern").agg(F.sum("tokens").alias("tokens")).limit(MAX_PATTERNS + 1).collect()
    if len(sizes) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} membership patterns; mix fewer sources at once")
    patterns = {tuple(r[0].split("\x1f")): int(r[1]) for r in sizes}
    quotas = quotas_for(patterns, targets, total)
    flows, _ = route(patterns, quotas, {t.source: t.max_repeats for t in targets})
    rows, used = [], dict.fromkeys(patterns, 0)
    for (key, name), tokens in sorted(flows.items()):
        rows.append(("\x1f".join(key), name, patterns[key], used[key], used[key] + tokens))
        used[key] += tokens
    schema = "pattern string, source string, layer long, low long, high long"
    intervals = spark.createDataFrame(rows, schema)  # at most MAX_PATTERNS x sources rows

    buckets = max(16, -(-units.count() // rows_per_bucket))
    ordered = units.withColumn("draw", F.xxhash64("doc_id", F.lit(seed)))
    ordered = ordered.withColumn("bucket", F.pmod(F.shiftright("draw", 32), F.lit(buckets)))
    inside = Window.partitionBy("pattern", "bucket").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = ordered.groupBy("pattern", "bucket").agg(F.sum("tokens").alias("t"))
    before = Window.partitionBy("pattern").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    base = sums.select("pattern", "bucket", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("base"))
    placed = ordered.withColumn("at", F.sum("tokens").over(inside) - F.col("tokens")).join(base, ["pattern", "bucket"])
    placed = placed.withColumn("at", F.col("at") + F.col("base")).join(F.broadcast(intervals), "pattern")
    # Starts at + k * layer (k = 0, 1, ...) inside [low, high).
    upto = lambda edge: F.greatest(F.lit(0), F.ceil((F.col(edge) - F.col("at")) / F.col("layer")))
    chosen = placed.withColumn("repeats", (upto("high") - upto("low")).cast("int")).where("repeats > 0")
    return chosen.select("doc_id", "source", "tokens", "repeats"), quotas


def mixing_report(chosen: DataFrame, targets: list[Target], quotas: dict[str, int]) -> DataFrame:
    """Per target source: wanted and reached tokens and shares, documents used and the most uses of one."""
    rows = [(t.source, float(t.share), int(t.max_repeats), int(quotas.get(t.source, 0))) for t in targets]
    wanted = chosen.sparkSession.createDataFrame(rows, "source string, target_share double, max_repeats int, quota_tokens long")
    got = chosen.groupBy("source").agg(
        F.sum(F.col("tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("most_repeats")
    )
    everything = Window.partitionBy(F.lit(0))  # one row per target source
    out = wanted.join(got, "source", "left").withColumn("whole", F.sum("tokens").over(everything))
    return out.select(
        "source", "target_share", "max_repeats", "quota_tokens", F.coalesce("tokens", F.lit(0)).alias("tokens"),
        F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("most_repeats", F.lit(0)).alias("most_repeats"),
        F.round(F.coalesce(F.col("tokens") / F.col("whole"), F.lit(0.0)), 6).alias("actual_share"),
    )
