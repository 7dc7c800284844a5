"""Numbered commits below a folder: the one place where a store's version is read and published.

A version is a small JSON document ``commit-<number>``.  It is written aside and renamed to the number after the one it was made from;
the rename fails if that number is taken.  So of two writers that start from one version the second is told, and no commit is lost.
Readers take the highest number and see all of a commit or nothing.  This needs a file system whose rename is atomic.
"""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import SparkSession

from palimpsest.scratch import delete_path, hadoop_fs

_NAME = re.compile(r"commit-(\d{10})\.json")


class Conflict(Exception):
    """Another writer has published since the version that this commit was made from."""


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file through Hadoop's file system."""
    fs, jpath = hadoop_fs(spark, path)
    out = fs.create(jpath, True)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = hadoop_fs(spark, path)
    stream = fs.open(jpath)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of all commits, ascending."""
    fs, jpath = hadoop_fs(spark, root)
    if not fs.exists(jpath):
        return []
    found = (_NAME.fullmatch(s.getPath().getName()) for s in fs.listStatus(jpath))
    return sorted(int(m[1]) for m in found if m)


def latest(spark: SparkSession, root: str) -> tuple[int, dict]:
    """Number and content of the published version; (0, {}) where there is none."""
    known = versions(spark, root)
    return (known[-1], read(spark, root, known[-1])) if known else (0, {})


def read(spark: SparkSession, root: str, number: int) -> dict:
    return json.loads(read_text(spark, f"{root}/commit-{number:010d}.json"))


def publish(spark: SparkSession, root: str, base: int, content: dict) -> int:
    """Publish ``content`` as the version after ``base``; raises ``Conflict`` if that number is taken."""
    aside, target = f"{root}/.commit-{uuid.uuid4().hex}", f"{root}/commit-{base + 1:010d}.json"
    write_text(spark, aside, json.dumps(content))
    jvm = spark.sparkContext._jvm
    source, goal = jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(target)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    options[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(source, goal, options)
    except Exception as e:
        delete_path(spark, aside)
        if "FileAlreadyExists" in str(e):
            raise Conflict(f"version {base + 1} of {root} was published by another writer") from e
        raise
    return base + 1


def expire(spark: SparkSession, root: str, referenced, keep: int = 2) -> list[str]:
    """Remove all but the last ``keep`` versions and the directories only they name; returns what was removed.

    ``referenced`` gives the paths below ``root`` that a version's content names.  Readers of a removed version fail.
    """
    known = versions(spark, root)
    old, kept = known[:-keep] if keep else known, known[-keep:] if keep else []
    needed = {p for n in kept for p in referenced(read(spark, root, n))}
    gone = sorted({p for n in old for p in referenced(read(spark, root, n))} - needed)
    for path in gone:
        delete_path(spark, f"{root}/{path}")
    for n in old:
        delete_path(spark, f"{root}/commit-{n:010d}.json")
    return gone
