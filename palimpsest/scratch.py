"""Intermediate tables in the folder all executors share.

Iterative operators cut their lineage by writing a table and reading it back: the written files survive the loss of any executor,
and the read plan has exact sizes for the planner.  The folder is the cluster's ``spark.checkpoint.dir``; only a local master
(tests) may fall back to a temporary directory.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL_FALLBACK: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder from the session; a temporary one only on a local master where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        set_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = set_dir.get() if set_dir.isDefined() else None
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        app = spark.sparkContext.applicationId
        root = _LOCAL_FALLBACK.setdefault(app, "") or tempfile.mkdtemp(prefix="palimpsest-")
        _LOCAL_FALLBACK[app] = root
    return root.rstrip("/")


class Scratch:
    """Written intermediate tables of one operator call.

    ``write`` materialises a DataFrame; ``drop`` deletes a table that no later plan reads.  Tables that the returned DataFrame
    still reads stay until the session ends (they are removed at interpreter exit, best effort).
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/palimpsest/{name}-{uuid.uuid4().hex}"
        self._next = 0
        self._paths: dict[int, str] = {}
        atexit.register(self._remove_quietly)

    def path(self, label: str) -> str:
        self._next += 1
        return f"{self.base}/{self._next:04d}-{label}"

    def write(self, df: DataFrame, label: str = "table", partition_by: list[str] | None = None) -> DataFrame:
        path = self.path(label)
        writer = df.write.mode("overwrite").option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self._paths[id(out)] = path
        out._scratch_path = path  # type: ignore[attr-defined]
        return out

    def drop(self, df: DataFrame | None) -> None:
        path = getattr(df, "_scratch_path", None)
        if path:
            delete_path(self.spark, path)

    def _remove_quietly(self) -> None:
        try:
            delete_path(self.spark, self.base)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            pass


def hadoop_fs(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the JVM Path object."""
    jvm = spark.sparkContext._jvm
    jpath = jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jpath


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = hadoop_fs(spark, path)
    fs.delete(jpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = hadoop_fs(spark, path)
    return bool(fs.exists(jpath))
