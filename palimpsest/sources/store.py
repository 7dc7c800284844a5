"""A snapshot store of Parquet tables with atomic publication.

Parquet knows no MERGE.  A commit writes the directories of the tables it changes under a new name, then publishes one numbered version
that lists the directories of all tables: readers see the whole commit or none of it.  Appends keep the old directories and add one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from palimpsest import commits
from palimpsest.operators.curate import missing_rows
from palimpsest.schemas import TABLES
from palimpsest.scratch import delete_path


class Snapshot:
    """One version of a store: what it lists does not change."""

    def __init__(self, store: Store, number: int, tables: dict[str, list[str]]):
        self.store, self.number, self.tables = store, number, tables

    def read(self, table: str) -> DataFrame:
        """The rows of a table; a table never written is empty."""
        store = self.store
        paths = [f"{store.root}/{p}" for p in self.tables.get(table, [])]
        if not paths:
            return store.spark.createDataFrame([], store.schemas[table])
        reader = store.spark.read.schema(store.schemas[table]) if table in store.schemas else store.spark.read
        return reader.parquet(*paths)


class Store:
    """Tables below ``root``; their schemas are those of ``palimpsest.schemas`` or the ones first written."""

    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str] | None = None):
        self.spark, self.root = spark, root.rstrip("/")
        self.schemas = dict(TABLES if schemas is None else schemas)

    def snapshot(self) -> Snapshot:
        return Snapshot(self, *commits.latest(self.spark, self.root))

    def exists(self) -> bool:
        """Whether anything was published: the smoke test before a load."""
        return bool(commits.versions(self.spark, self.root))

    def read(self, table: str) -> DataFrame:
        """The published rows of a table; a table never written is empty."""
        return self.snapshot().read(table)

    def commit(
        self, *, replace: dict[str, DataFrame] | None = None, append: dict[str, DataFrame] | None = None, base: Snapshot | None = None,
        reads: list[str] | None = None,
    ) -> None:
        """Write whole new contents (``replace``) and additional rows (``append``) of tables and publish them together.

        ``base`` is the snapshot that the rows were made from, ``reads`` the tables they depend on (those replaced always count).  Where
        another writer has published meanwhile, the commit is put on top of that version if it left these tables alone, else it fails
        with ``Conflict`` and the caller starts again.
        """
        base = base or self.snapshot()
        depends = {*(reads or []), *(replace or {})}
        name = uuid.uuid4().hex
        written: dict[str, str] = {}
        for table, df in (replace or {}).items():
            written[table] = f"{name}/{table}"
            df.write.parquet(f"{self.root}/{written[table]}")
        added: dict[str, str] = {}
        for table, df in (append or {}).items():
            added[table] = f"{name}/{table}-new"
            df.write.parquet(f"{self.root}/{added[table]}")
        now = base
        while True:
            tables = {t: list(p) for t, p in now.tables.items()}
            tables |= {t: [p] for t, p in written.items()}
            for table, path in added.items():
                tables[table] = [*tables.get(table, []), path]
            try:
                commits.publish(self.spark, self.root, now.number, tables)
                return
            except commits.Conflict:
                now = self.snapshot()
                if any(now.tables.get(t) != base.tables.get(t) for t in depends):
                    raise

    def expire(self, keep: int = 2) -> list[str]:
        """Remove the versions before the last ``keep`` and the directories only they name."""
        return commits.expire(self.spark, self.root, lambda tables: [p for paths in tables.values() for p in paths], keep)

    def append_missing(self, table: str, rows: DataFrame, keys: list[str]) -> None:
        """Insert-only merge on ``keys``; rows that are there stay as they are."""
        base = self.snapshot()
        self.commit(append={table: missing_rows(rows, base.read(table), keys)}, base=base, reads=[table])

    def truncate(self, table: str) -> None:
        """Make a table empty."""
        base = self.snapshot()
        self.commit(replace={table: base.read(table).limit(0)}, base=base)

    def drop(self) -> None:
        """Remove the store with all its versions."""
        delete_path(self.spark, self.root)

    def compact(self, table: str, files: int) -> None:
        """Rewrite a table in ``files`` files, in place of the small ones that appends leave."""
        base = self.snapshot()
        self.commit(replace={table: base.read(table).repartition(files)}, base=base)

    def file_report(self, table: str) -> DataFrame:
        """(path, bytes) of a table's files: the sizes that tell when to compact."""
        paths = [f"{self.root}/{p}" for p in self.snapshot().tables.get(table, [])]
        if not paths:
            return self.spark.createDataFrame([], "path string, bytes long")
        files = self.spark.read.format("binaryFile").load(paths).selectExpr("path", "length AS bytes")
        return files.where("path LIKE '%.parquet'")


def read_jdbc(spark: SparkSession, url: str, table: str, *, key: str, low: int, high: int, partitions: int, **options: str) -> DataFrame:
    """A table of a relational database, read in parallel by ranges of an integer key; the driver's jar must be on the class path."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    reader = reader.option("partitionColumn", key).option("lowerBound", low).option("upperBound", high).option("numPartitions", partitions)
    return reader.options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, *, partitions: int, batch: int = 10_000, **options: str) -> None:
    """Append to a table of a relational database over a bounded number of connections."""
    writer = df.coalesce(partitions).write.format("jdbc").mode("append")
    writer.option("url", url).option("dbtable", table).option("batchsize", batch).options(**options).save()
