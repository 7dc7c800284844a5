"""Processing only new or changed records: a Merkle tree over key-range hashes.

Keys fall into ranges of equal width, the leaves.  A leaf's digest combines the hashes of its (key, version) rows; the digest of a node
above combines those of the leaves below it.  The current tree is compared with the one saved by the last successful run from the
root downwards, descending only where digests differ; only rows of the changed leaves are compared one by one, and only the parts of the
saved rows that hold such leaves are read and rewritten.  Output, rows and tree are published together by one rename, so a run that
dies leaves the previous state and is simply repeated.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from palimpsest import commits
from palimpsest.operators.common import require_columns
from palimpsest.scratch import Scratch, delete_path, hadoop_fs

TREE_SCHEMA = "level int, node long, digest long, rows long"


def merkle_tree(rows: DataFrame, key: str, version: list[str], leaf_width: int = 1024, fanout: int = 64, levels: int = 3) -> DataFrame:
    """(level, node, digest, rows); level 0 holds the leaves, ``levels`` the topmost nodes.

    A leaf's digest combines the 64-bit hashes of its rows as exact sums, so it does not depend on row order and is partly combined
    before the shuffle; a hot range sends one partial sum per task.  A node above combines the digests of the leaves below it, all
    levels in one grouping of the short table of leaves.  Null keys take no part.
    """
    require_columns(rows, key, *version)
    leaf = F.floor(F.col(key).cast("long") / F.lit(leaf_width)).cast("long")
    halves = lambda h: (h.bitwiseAND(F.lit(0xFFFFFFFF)).alias("low"), F.shiftright(h, 32).alias("high"))
    own = F.xxhash64(F.col(key).cast("long"), *[F.col(c) for c in version])
    leaves = (
        rows.where(F.col(key).isNotNull())
        .select(leaf.alias("node"), *halves(own))
        .groupBy("node")
        .agg(F.xxhash64(F.sum("low"), F.sum("high"), F.count(F.lit(1))).alias("digest"), F.count(F.lit(1)).alias("rows"))
    )
    above = F.explode(F.array(*[F.struct(F.lit(n).alias("level"), F.lit(fanout**n).alias("span")) for n in range(levels + 1)]))
    spread = leaves.select(above.alias("up"), "node", "digest", "rows")
    node = F.floor(F.col("node") / F.col("up.span")).cast("long")
    return (
        spread.select(F.col("up.level").alias("level"), node.alias("node"), *halves(F.xxhash64("node", "digest")), "rows")
        .groupBy("level", "node")
        .agg(F.xxhash64(F.sum("low"), F.sum("high")).alias("digest"), F.sum("rows").alias("rows"))
    )


def changed_leaves(current: DataFrame, saved: DataFrame, scratch: Scratch, fanout: int = 64, levels: int = 3) -> DataFrame:
    """(leaf) of the key ranges whose digests differ; both trees must be materialised.

    From the topmost level down, only children of differing nodes are compared; each level's differing nodes are a short table.
    """
    frontier: DataFrame | None = None
    for n in range(levels, -1, -1):
        sides = []
        for tree, name in ((current, "digest"), (saved, "old")):
            side = tree.where(F.col("level") == n).select("node", F.col("digest").alias(name))
            if frontier is not None:
                up = F.floor(F.col("node") / fanout).cast("long")
                side = side.withColumn("up", up).join(frontier, "up", "left_semi").drop("up")
            sides.append(side)
        differ = sides[0].join(sides[1], "node", "full").where(~F.col("digest").eqNullSafe(F.col("old")))
        frontier = scratch.write(differ.select(F.col("node").alias("up")), f"level-{n}")
    return frontier.withColumnRenamed("up", "leaf")


def _with_leaf(rows: DataFrame, key: str, leaf_width: int) -> DataFrame:
    return rows.withColumn("leaf", F.floor(F.col(key) / F.lit(leaf_width)).cast("long"))


def _different(now: DataFrame, before: DataFrame, key: str, version: list[str]) -> DataFrame:
    """(key, *version) of ``now`` for keys that ``before`` lacks or has with another version; one row per key on either side."""
    old = before.select(key, *[F.col(c).alias(f"__old_{c}") for c in version], F.lit(True).alias("__had"))
    same = F.col("__had").isNotNull()
    for c in version:
        same = same & F.col(c).eqNullSafe(F.col(f"__old_{c}"))
    return now.join(old, key, "left").where(~same).select(key, *version)


def changed_rows(current: DataFrame, saved: DataFrame, key: str, version: list[str], leaf_width: int = 1024) -> DataFrame:
    """(key, *version) of ``current`` for keys that are new or whose version differs from ``saved``.

    One row per key on either side.  Keys that only ``saved`` has are no change to load.  With no saved rows every key is returned.
    """
    scratch = Scratch(current.sparkSession, "changes")
    state = MerkleState(current.sparkSession, scratch.path("state"), key, version, leaf_width)
    state.run(saved)
    return state.run(current)


class MerkleState:
    """The saved rows, tree and output of the last successful run, in ``root``; published together or not at all.

    Rows lie in parts of ``part_width`` neighbouring leaves.  A run evaluates its input once, into a snapshot from which output, rows
    and tree are all made: a row that arrives meanwhile is in none of them and is found by the next run.  Of two runs at a time the
    one that publishes second fails with ``Conflict`` and is to be repeated.
    """

    def __init__(self, spark, root: str, key: str, version: list[str], leaf_width: int = 1024, part_width: int = 1024):
        self.spark, self.root, self.key, self.version = spark, root.rstrip("/"), key, list(version)
        self.leaf_width, self.part_width = leaf_width, part_width

    def read(self, name: str) -> DataFrame | None:
        """Table 'rows', 'tree' or 'output' of the published state; none before the first run."""
        number, state = commits.latest(self.spark, self.root)
        if not number:
            return None
        return self._rows(state, None) if name == "rows" else self.spark.read.parquet(f"{self.root}/{state[name]}")

    def _rows(self, state: dict, parts: list[int] | None) -> DataFrame:
        paths = [f"{self.root}/{p}" for n, p in sorted(state.get("parts", {}).items()) if parts is None or int(n) in parts]
        schema = state["schema"]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def run(self, current: DataFrame) -> DataFrame:
        """Compare, write output, changed parts and tree of this run, then publish; returns the published output."""
        scratch, key = Scratch(self.spark, "merkle"), self.key
        base, state = commits.latest(self.spark, self.root)
        shape = [F.col(key).cast("long").alias(key), *self.version]
        now = scratch.write(current.where(F.col(key).isNotNull()).select(*shape), "snapshot")
        name = f"v-{uuid.uuid4().hex}"
        at = f"{self.root}/{name}"
        merkle_tree(now, key, self.version, self.leaf_width).write.parquet(f"{at}/tree")
        tree = self.spark.read.schema(TREE_SCHEMA).parquet(f"{at}/tree")
        if base:
            leaves = changed_leaves(tree, self.spark.read.schema(TREE_SCHEMA).parquet(f"{self.root}/{state['tree']}"), scratch)
        else:  # nothing is saved: every leaf is new
            leaves = tree.where("level = 0").select(F.col("node").alias("leaf"))
        part = F.floor(F.col("leaf") / F.lit(self.part_width)).cast("long")
        touched = leaves.select(part.alias("part")).distinct()
        numbers = {r[0] for r in touched.collect()}  # one per part_width x leaf_width keys
        state = state or {"parts": {}, "schema": now._jdf.schema().toDDL()}

        located = _with_leaf(now, key, self.leaf_width)
        fresh = located.join(leaves, "leaf", "left_semi").select(key, *self.version)
        before = _with_leaf(self._rows(state, numbers), key, self.leaf_width).join(leaves, "leaf", "left_semi").select(key, *self.version)
        _different(fresh, before, key, self.version).write.parquet(f"{at}/output")
        rewritten = located.withColumn("part", part).join(touched, "part", "left_semi").select("part", key, *self.version)
        rewritten.repartition("part", F.pmod(F.xxhash64(key), F.lit(4))).write.partitionBy("part").parquet(f"{at}/rows")
        kept = {n: p for n, p in state["parts"].items() if int(n) not in numbers}
        parts = kept | {str(n): f"{name}/rows/part={n}" for n in self._written(f"{at}/rows")}
        commits.publish(self.spark, self.root, base, {"parts": parts, "schema": state["schema"], "tree": f"{name}/tree", "output": f"{name}/output"})
        delete_path(self.spark, scratch.base)
        return self.spark.read.schema(state["schema"]).parquet(f"{at}/output")

    def _written(self, path: str) -> list[int]:
        fs, jpath = hadoop_fs(self.spark, path)
        names = (s.getPath().getName() for s in fs.listStatus(jpath))
        return [int(n[len("part=") :]) for n in names if n.startswith("part=")]

    def expire(self, keep: int = 2) -> list[str]:
        """Remove the versions before the last ``keep`` and what only they hold."""
        return commits.expire(self.spark, self.root, lambda s: [*s["parts"].values(), s["tree"], s["output"]], keep)


def done_entries(entries: DataFrame, runs: DataFrame, reports: DataFrame, salts: int = 8) -> DataFrame:
    """``entries`` with ``done``: whether a run of the entry's edition (file name and timestamp) has loaded it.

    An edition's reach is the furthest position that its runs reported, directly or by the page just written; a successful run
    reaches every entry.  The reach has one row per edition and is copied to every salt, so one edition may hold most entries.
    """
    edition = ["source_file_name", "source_file_timestamp"]
    success = F.coalesce(F.col("result").startswith("Success"), F.lit(False))
    own = runs.where(F.col("run_id").isNotNull()).select("run_id", *edition, success.alias("success"))
    told = reports.join(own, "run_id").select(*edition, "file_position", "page_id")
    by_page = told.where(F.col("page_id").isNotNull()).select(*edition, "page_id").distinct()
    at_page = entries.select(*edition, "page_id", "file_position").join(by_page, [*edition, "page_id"]).select(*edition, "file_position")
    reach = (
        told.select(*edition, "file_position", F.lit(False).alias("success"))
        .unionByName(at_page.withColumn("success", F.lit(False)))
        .unionByName(own.select(*edition, F.lit(None).cast("long").alias("file_position"), "success"))
        .groupBy(*edition)
        .agg(F.max("file_position").alias("reach"), F.max("success").alias("success"))
        .withColumn("__salt", F.explode(F.lit(list(range(salts)))))
    )
    salted = entries.withColumn("__salt", F.pmod(F.xxhash64("file_position", "page_id"), F.lit(salts)).cast("int"))
    done = F.coalesce(F.col("success"), F.lit(False)) | F.coalesce(F.col("file_position") <= F.col("reach"), F.lit(False))
    return salted.join(reach, [*edition, "__salt"], "left").withColumn("done", done).drop("reach", "success", "__salt")


def pages_to_load(entries: DataFrame, runs: DataFrame, reports: DataFrame, leaf_width: int = 1024) -> DataFrame:
    """(page_id, latest_revision_id) that the next run still has to load, each page once.

    A page's current version is the highest ``latest_revision_id`` of all its entries, its saved version the highest of those done.
    """
    require_columns(entries, "source_file_name", "source_file_timestamp", "file_position", "page_id", "latest_revision_id")
    flagged = done_entries(entries, runs, reports).where(F.col("page_id").isNotNull() & F.col("latest_revision_id").isNotNull())
    scratch = Scratch(entries.sparkSession, "pages")
    pages = flagged.groupBy("page_id").agg(
        F.max("latest_revision_id").alias("latest_revision_id"),
        F.max(F.when(F.col("done"), F.col("latest_revision_id"))).alias("saved"),
    )
    pages = scratch.write(pages, "pages")
    current = pages.select("page_id", "latest_revision_id")
    saved = pages.where(F.col("saved").isNotNull()).select("page_id", F.col("saved").alias("latest_revision_id"))
    return changed_rows(current, saved, "page_id", ["latest_revision_id"], leaf_width)
