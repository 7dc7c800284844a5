"""Parent links to full hierarchies: path, depth, root, descendants and cycles of parent-child rows of unknown depth.

The method is frontier joins, level by level, from the roots.  Joining once per generation would take as many jobs as the deepest
history, so a level here is one *segment* of a chain: rows are range-partitioned by locality (for revisions: page, then id), every
partition follows links as far as it can by vectorised pointer doubling, and only links that leave a partition remain.  Those form
a contracted graph whose frontier joins extend paths and depths from roots downwards; the links of segments not yet reached double
meanwhile, so a chain of n segments takes about log2(n) rounds.  Range partitioning splits a hot page into
as many partitions as it needs.  Segments that no frontier reaches lie on or lead to a cycle across partitions; pointer doubling
over them alone finds its smallest member.  Cycles inside a partition show as nodes that return to themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest.operators.common import first_delivery, require_columns, salted_lookup
from palimpsest.scratch import Scratch

#: Path elements per Arrow batch that a task sends back.
_FLAT_ELEMENTS = 4_000_000


def follow_links(node: np.ndarray, parent: np.ndarray) -> tuple[np.ndarray, ...]:
    """Follow links inside one set of rows.

    ``node`` is unique; a parent outside the set ends the chain.  Returns (parent index or -1, top index, hops to the top, smallest
    id from the row up to its top, cycle id or -1); for rows that reach a cycle the top and hops mean nothing.
    """
    n = len(node)
    order = np.argsort(node, kind="stable")
    at = np.searchsorted(node[order], parent)
    at[at == n] = 0
    up = np.where(node[order][at] == parent, order[at], -1) if n else np.empty(0, np.int64)
    is_root = up < 0
    jump = np.where(is_root, np.arange(n), up)
    hops = (~is_root).astype(np.int64)
    low = node.astype(np.int64).copy()
    for _ in range(max(1, int(n).bit_length() + 1)):
        low = np.minimum(low, low[jump])
        hops = hops + hops[jump]
        jump = jump[jump]
        if is_root[jump].all():
            break
    low = np.minimum(low, low[jump])
    cyclic = ~is_root[jump] if n else np.empty(0, bool)
    cycle = np.where(cyclic, low[jump], -1)
    return up, jump, hops, low, cycle


def _paths(node: np.ndarray, up: np.ndarray, hops: np.ndarray, rows: np.ndarray) -> pa.Array:
    """Lists of ids from the top to each of ``rows`` (never rows of a cycle)."""
    lengths = hops[rows] + 1
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    flat = np.empty(int(offsets[-1]), np.int64)
    place, current = offsets[1:] - 1, rows.copy()
    alive = np.arange(len(rows))
    while len(alive):
        flat[place[alive]] = node[current[alive]]
        current[alive] = up[current[alive]]
        place[alive] -= 1
        alive = alive[current[alive] >= 0]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))


def _segments(with_paths: bool):
    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node_parts, parent_parts = [], []
        for b in batches:
            node_parts.append(b.column("node").to_numpy(zero_copy_only=False))
            parent_parts.append(b.column("parent").to_numpy(zero_copy_only=False))
        if not node_parts or not sum(map(len, node_parts)):
            return
        node, parent = np.concatenate(node_parts), np.concatenate(parent_parts)
        up, top, hops, low, cycle = follow_links(node, parent)
        weight = np.where(cycle >= 0, 1, hops + 1) if with_paths else np.ones(len(node), np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(weight) // _FLAT_ELEMENTS)) + 1
        step = 1_000_000
        bounds = np.unique(np.concatenate([[0], cuts, np.arange(step, len(node), step), [len(node)]]))
        for a, z in zip(bounds[:-1], bounds[1:]):
            rows = np.arange(a, z)
            loops = cycle[a:z] >= 0
            exits = parent[top[a:z]]
            columns = {
                "node": pa.array(node[a:z]),
                "top": pa.array(node[top[a:z]], mask=loops),
                "hops": pa.array(hops[a:z], mask=loops),
                "leaves_to": pa.array(exits, mask=loops | (exits == 0)),
                "low": pa.array(low[a:z]),
                "cycle_id": pa.array(cycle[a:z], mask=~loops),
            }
            if with_paths:
                good = rows[~loops]
                lists = _paths(node, up, hops, good)
                if loops.any():
                    take = np.zeros(len(rows), np.int64)
                    take[~loops] = np.arange(len(good))
                    lists = lists.take(pa.array(take, mask=loops))
                columns["path"] = lists
            yield pa.RecordBatch.from_pydict(columns)

    return solve


def hierarchy(
    df: DataFrame,
    *,
    node: str,
    parent: str,
    order: str | None = None,
    locality: list[str] | None = None,
    with_paths: bool = True,
    rows_per_partition: int = 200_000,
    salts: int = 16,
) -> DataFrame:
    """(node, root, depth, cycle_id[, path]) for every distinct node.

    ``depth`` is the number of links to the root (a root has 0), ``path`` the ids from the root to the node.  A parent that is
    null, 0 or no node ends the chain.  A node on a cycle, or one whose links lead to a cycle, has ``cycle_id``, the smallest id on
    that cycle, and null root, depth and path.  Of several rows of one node the first by ``order`` counts, ties by content.  Rows
    with a null node are left out; an empty table gives none.  ``locality`` names columns that tend to be equal along a chain;
    they only decide how few links leave a partition, never the result.
    """
    locality = list(locality or [])
    require_columns(df, node, parent, *locality, *([order] if order else []))
    spark = df.sparkSession
    scratch = Scratch(spark, "hierarchy")
    edges = df.select(
        F.col(node).cast("long").alias("node"),
        F.coalesce(F.col(parent).cast("long"), F.lit(0)).alias("parent"),
        *[F.col(c).alias(f"__loc{i}") for i, c in enumerate(locality)],
        (F.col(order) if order else F.lit(0)).alias("__order"),
    )
    near = [f"__loc{i}" for i in range(len(locality))] + ["node"]
    edges = scratch.write(first_delivery(edges, "node", "__order").drop("__order"), "edges")
    parts = max(1, -(-edges.count() // rows_per_partition))
    schema = "node long, top long, hops long, leaves_to long, low long, cycle_id long" + (", path array<long>" if with_paths else "")
    placed = edges.repartitionByRange(parts, *near).select("node", "parent")
    segments = scratch.write(placed.mapInArrow(_segments(with_paths), schema), "segments")
    scratch.drop(edges)

    # The contracted graph: one row per segment top whose parent is outside its partition, with where that parent's segment leads.
    path_columns = ["path"] if with_paths else []
    crossing = segments.where("node = top AND leaves_to IS NOT NULL").select(F.col("top").alias("seg"), F.col("leaves_to").alias("exit"))
    target = segments.select(
        F.col("node").alias("exit"), F.col("top").alias("via"), F.col("hops").alias("via_hops"),
        F.col("leaves_to").alias("via_leaves"), "low", "cycle_id", *path_columns,
    )
    # Many segments may leave to one parent: look every parent up once, then spread the segments over its copies.
    met = scratch.write(target.join(crossing.select("exit").distinct(), "exit"), "exits")
    links = scratch.write(salted_lookup(crossing, met, "exit"), "links")
    known = F.col("low").isNull() | F.col("cycle_id").isNotNull() | F.col("via_leaves").isNull()
    first = links.where(known).select(
        "seg",
        F.when(F.col("low").isNull(), F.col("seg")).otherwise(F.when(F.col("cycle_id").isNull(), F.col("via"))).alias("root"),
        F.when(F.col("low").isNull(), F.lit(0)).otherwise(F.col("via_hops") + 1).cast("long").alias("above"),
        "cycle_id",
    )
    waiting = links.where(~known).select("seg", "via", (F.col("via_hops") + 1).alias("above"), "low")
    resolved = _frontiers(scratch, scratch.write(first, "frontier"), scratch.write(waiting, "waiting"))
    if with_paths:
        chained = first.select("seg", "cycle_id", F.when(F.col("above") > 0, F.array("seg")).otherwise(F.array().cast("array<long>")).alias("chain"))
        pieces = links.select(F.col("seg").alias("link"), "path")
        resolved = _with_prefixes(scratch, resolved, chained, waiting.select("seg", "via"), pieces)
    resolved = scratch.write(resolved, "resolved")

    own = segments.where(F.col("leaves_to").isNull()).select(
        "node", F.col("top").alias("root"), F.col("hops").alias("depth"), "cycle_id", *path_columns
    )
    # Many nodes may hang below one segment top: spread them, and copy the (short) table of segment tops to every salt.
    deep = segments.where(F.col("leaves_to").isNotNull()).drop("cycle_id", "low")
    deep = salted_lookup(deep, resolved.withColumnRenamed("seg", "top"), "top", "inner", salts).select(
        "node",
        "root",
        (F.col("above") + F.col("hops")).alias("depth"),
        "cycle_id",
        *([F.when(F.col("cycle_id").isNull(), F.concat("prefix", "path")).alias("path")] if with_paths else []),
    )
    return own.unionByName(deep)


def _frontiers(scratch: Scratch, done: DataFrame, waiting: DataFrame) -> DataFrame:
    """(seg, root, above, cycle_id) of all segments.  ``done`` are known, ``waiting`` (seg, via, above, low) hang below others.

    Every round joins the waiting ones to what they hang below: below the frontier they become known, below a waiting segment they take
    over its link.  So the reach of a round doubles and a chain of n segments takes about log2(n) rounds.  What no frontier has
    reached by then lies on or leads to a cycle of segments.
    """
    state = waiting.select("seg", F.col("via").alias("far"), "above", "low")
    left, reached, frontier = state.count(), [done], done
    doubled = 0
    while left and doubled <= left.bit_length() + 1:
        known = frontier if doubled == 0 else scratch.write(_union(reached), "known")
        ahead = known.select(F.col("seg").alias("far"), "root", F.col("above").alias("up"), "cycle_id", F.lit(None).cast("long").alias("further"), F.lit(True).alias("known"))
        hanging = state.select(F.col("seg").alias("far"), F.lit(None).cast("long").alias("root"), F.col("above").alias("up"), F.lit(None).cast("long").alias("cycle_id"), F.col("far").alias("further"), F.lit(False).alias("known"))
        grown = scratch.write(salted_lookup(state, ahead.unionByName(hanging), "far", "inner"), "grown")
        above = F.when(F.col("cycle_id").isNull(), F.col("above") + F.col("up"))
        frontier = grown.where("known").select("seg", "root", above.alias("above"), "cycle_id")
        reached.append(frontier)
        state = grown.where("NOT known").select("seg", F.col("further").alias("far"), (F.col("above") + F.col("up")).alias("above"), "low")
        left_now = state.count()
        doubled += 1
        if left_now == 0:
            left = 0
            break
    if left:
        loops = waiting.select("seg", "via", "low").join(state.select("seg"), "seg", "left_semi")
        loops = _cycle_ids(scratch, scratch.write(loops, "unreached"), state.count())
        null = F.lit(None).cast("long")
        reached.append(loops.select("seg", null.alias("root"), null.alias("above"), "cycle_id"))
    return _union(reached)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _with_prefixes(scratch: Scratch, resolved: DataFrame, chained: DataFrame, links: DataFrame, pieces: DataFrame) -> DataFrame:
    """``resolved`` with ``prefix``, the path down to where a segment's top hangs; null for segments that lead to a cycle.

    Only ids of segments are doubled along the links (``chain``), a short list even for long paths; the pieces of path are put together
    once at the end.
    """
    sound = scratch.write(resolved.where(F.col("cycle_id").isNull()), "sound")
    state = scratch.write(links.join(sound.select("seg"), "seg", "left_semi").select("seg", F.col("via").alias("far"), F.array("seg").alias("chain")), "chains")
    done = [chained.where(F.col("cycle_id").isNull()).select("seg", "chain")]
    while state.take(1):
        known = scratch.write(_union(done), "known-chains")
        ahead = known.select(F.col("seg").alias("far"), F.col("chain").alias("up"), F.lit(None).cast("long").alias("further"), F.lit(True).alias("known"))
        hanging = state.select(F.col("seg").alias("far"), F.col("chain").alias("up"), F.col("far").alias("further"), F.lit(False).alias("known"))
        grown = scratch.write(salted_lookup(state, ahead.unionByName(hanging), "far", "inner"), "grown-chains")
        longer = F.concat("up", "chain").alias("chain")
        done.append(grown.where("known").select("seg", longer))
        state = grown.where("NOT known").select("seg", F.col("further").alias("far"), longer)
    steps = _union(done).select("seg", F.posexplode("chain").alias("at", "link"))
    joined = salted_lookup(scratch.write(steps, "steps"), scratch.write(pieces, "pieces"), "link", "inner")
    whole = joined.groupBy("seg").agg(F.sort_array(F.collect_list(F.struct("at", "path"))).alias("p"))  # a group is one path
    prefixes = whole.select("seg", F.flatten(F.col("p.path")).alias("prefix"))
    empty = F.when(F.col("cycle_id").isNull(), F.coalesce("prefix", F.array().cast("array<long>")))
    return resolved.join(prefixes, "seg", "left").withColumn("prefix", empty)


def _cycle_ids(scratch: Scratch, loops: DataFrame, count: int) -> DataFrame:
    """Smallest id on the cycle that each unreached segment leads to; every chain among them ends in a cycle."""
    state = loops.select("seg", F.col("via").alias("far"), "low")
    for _ in range(max(1, int(count).bit_length())):
        ahead = state.select(F.col("seg").alias("far"), F.col("far").alias("far2"), F.col("low").alias("low2"))
        state = scratch.write(
            salted_lookup(state, ahead, "far", "inner").select("seg", F.col("far2").alias("far"), F.least("low", "low2").alias("low")), "doubling"
        )
    on_cycle = state.select(F.col("seg").alias("far"), F.col("low").alias("cycle_id"))
    return salted_lookup(state.select("seg", "far"), on_cycle, "far", "inner").select("seg", "cycle_id")


def ancestor_pairs(nodes: DataFrame) -> DataFrame:
    """(ancestor, descendant, distance) from the paths of ``hierarchy``: every node's descendants; nodes of cycles have none."""
    depth = F.size("path")
    return (
        nodes.where(F.col("path").isNotNull() & (depth > 1))
        .select(F.col("node").alias("descendant"), F.posexplode(F.slice("path", F.lit(1), depth - 1)).alias("at", "ancestor"), depth.alias("size"))
        .select("ancestor", "descendant", (F.col("size") - 1 - F.col("at")).cast("long").alias("distance"))
    )
