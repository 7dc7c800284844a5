"""Reading XML page dumps in parallel.

The file is cut at ``</page>`` by the text source, which splits one file over many tasks; every piece is parsed by ``from_xml``
against a declared schema.  A pre-pass marks self-closing elements, because parsed values do not tell ``<text/>`` (no text) from
``<text></text>`` (an empty one).
"""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.schemas import DUMP_NAMESPACE, DUMP_PAGE
from palimpsest.scratch import hadoop_fs

_OPTIONS = {"mode": "FAILFAST", "ignoreSurroundingSpaces": "false", "timeZone": "UTC"}
_SELF_CLOSING = r"<(text|comment|contributor)((?:\s[^<>]*?)?)\s*/>"
#: Parsing drops the value of an element of white space only; this private character in front keeps it.
BLANK_MARK = "\ue000"
_BLANK = r"<(text|comment)((?:\s[^<>]*?)?)>(\s+)</\1>"
_PAGE = r"(?s)(<page[\s>].*)$"


def parse_page(xml: Column) -> Column:
    """Struct of one ``<page>`` element; malformed XML fails the query."""
    marked = F.regexp_replace(xml, _SELF_CLOSING, r'<$1$2 selfclosed="1"></$1>')
    marked = F.regexp_replace(marked, _BLANK, f"<$1$2>{BLANK_MARK}$3</$1>")
    return F.from_xml(marked, DUMP_PAGE, {**_OPTIONS, "attributePrefix": "_", "valueTag": "_VALUE"})


def pages_of(pieces: DataFrame) -> DataFrame:
    """Page structs of text pieces that end before ``</page>`` (column ``value``); pieces without a page are dropped."""
    start = F.regexp_extract("value", _PAGE, 1)
    xml = F.concat(start, F.lit("</page>"))
    return pieces.where(start != "").select(parse_page(xml).alias("page")).select("page.*")


def read_dump(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per page with its nested revisions; compressed files are read as well, but not split."""
    return pages_of(spark.read.option("lineSep", "</page>").text(path))


def read_range(spark: SparkSession, path: str, low: int, high: int, split_bytes: int = 64 << 20) -> DataFrame:
    """The pages of one plain file whose entries begin in bytes ``low`` to ``high`` (exclusive): a page is in one range of any cut.

    Each task reads one split of the range and the rest of the entry at its end, as the text source does for a whole file.
    """
    jobs = [(path, a, min(a + split_bytes, high)) for a in range(low, high, split_bytes)]
    splits = spark.createDataFrame(jobs, "path string, low long, high long").repartition(max(1, len(jobs)))
    return pages_of(splits.mapInArrow(_entries, "value string"))


def _entries(batches):
    """Pieces from ``<page`` to before ``</page>`` whose entry begins in the split."""
    import pyarrow as pa
    from pyarrow import fs

    for b in batches:
        for path, low, high in zip(*(b.column(c).to_pylist() for c in ("path", "low", "high"))):
            files, inner = fs.FileSystem.from_uri(path)
            with files.open_input_file(inner) as f:
                f.seek(low)
                held, at, mark = b"", low, re.compile(rb"<page[\s>]")
                done = False
                while not done:
                    data = f.read(1 << 20)
                    held += data
                    out = []
                    while True:
                        start = mark.search(held)
                        if start is None:
                            keep = max(0, len(held) - 5)
                            at, held = at + keep, held[keep:]
                            done = at >= high
                            break
                        if at + start.start() >= high:
                            done = True
                            break
                        end = held.find(b"</page>", start.start())
                        if end < 0:
                            at, held = at + start.start(), held[start.start() :]
                            break
                        out.append(held[start.start() : end].decode())
                        at, held = at + end + 7, held[end + 7 :]
                    if out:
                        yield pa.RecordBatch.from_pydict({"value": pa.array(out, pa.string())})
                    if not data:
                        break


def stream_dump(spark: SparkSession, path: str, files_per_trigger: int = 1) -> DataFrame:
    """The same as a stream over a directory of dump files."""
    reader = spark.readStream.option("lineSep", "</page>").option("maxFilesPerTrigger", files_per_trigger)
    return pages_of(reader.text(path))


#: A file's head, which names the namespaces, is far shorter than this.
HEAD_BYTES = 4 << 20


def file_heads(spark: SparkSession, path: str | list[str], size: int = HEAD_BYTES) -> list[str]:
    """The first ``size`` bytes of every file of ``path`` as text, read on the driver; .gz and .bz2 files are unpacked."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)
    heads = []
    for name in file_status(spark, path):
        jpath = jvm.org.apache.hadoop.fs.Path(name)
        stream = jpath.getFileSystem(conf).open(jpath)
        codec = codecs.getCodec(jpath)
        data = codec.createInputStream(stream) if codec is not None else stream
        try:
            heads.append(bytes(data.readNBytes(size)).decode(errors="replace"))
        finally:
            data.close()
    return heads


def file_status(spark: SparkSession, path: str | list[str]) -> dict[str, tuple[int, dt.datetime]]:
    """{full path: (bytes, time of change)} of the files that a path, folder or glob names, on any file system Hadoop knows."""
    found: dict[str, tuple[int, dt.datetime]] = {}
    for one in [path] if isinstance(path, str) else path:
        fs, jpath = hadoop_fs(spark, one)
        for status in fs.globStatus(jpath) or []:
            for f in fs.listStatus(status.getPath()) if status.isDirectory() else [status]:
                if not f.isDirectory() and f.getPath().getName()[0] not in "._":
                    when = dt.datetime.fromtimestamp(f.getModificationTime() // 1000, dt.timezone.utc).replace(tzinfo=None)
                    found[f.getPath().toString()] = (f.getLen(), when)
    return dict(sorted(found.items()))


def read_namespaces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(namespace_id, namespace_name) of the files' heads; an unnamed namespace has an empty name.  Only the heads are read."""
    heads = [(h.partition("</namespaces>")[0],) for h in file_heads(spark, path)]
    head = spark.createDataFrame(heads, "value string").where(F.col("value").contains("<namespaces"))
    elements = F.regexp_extract_all(F.col("value"), F.lit(r"(<namespace [^<>]*?(?:/>|>[^<]*</namespace>))"), 1)
    one = F.from_xml(F.col("element"), DUMP_NAMESPACE, _OPTIONS)
    parsed = head.select(F.explode(elements).alias("element")).select(one.alias("n"))
    return parsed.select(
        F.col("n._key").alias("namespace_id"), F.trim(F.coalesce("n._VALUE", F.lit(""))).alias("namespace_name")
    ).distinct()


def pages_after(pages: DataFrame, done: DataFrame) -> DataFrame:
    """Pages whose id no earlier run has finished: resuming by key, which no reordering of the file can fool."""
    return pages.join(done.select(F.col("page_id").alias("id")).distinct(), "id", "left_anti")


def to_page_xml(title: Column, ns: Column, page_id: Column, revisions: Column) -> Column:
    """XML of one page from its parts; ``revisions`` is the XML of its revisions."""
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c.cast("string"), F.lit(f"</{name}>"))
    return F.concat(F.lit("<page>"), tag("title", escape_xml(title)), tag("ns", ns), tag("id", page_id), revisions, F.lit("</page>"))


def to_revision_xml(revision_id: Column, when: Column, user: Column, text: Column) -> Column:
    tag = lambda name, c: F.concat(F.lit(f"<{name}>"), c.cast("string"), F.lit(f"</{name}>"))
    return F.concat(
        F.lit("<revision>"), tag("id", revision_id), tag("timestamp", F.date_format(when, "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.lit("<contributor>"), tag("username", escape_xml(user)), tag("id", F.lit(1)), F.lit("</contributor>"),
        F.lit('<text xml:space="preserve">'), escape_xml(text), F.lit("</text></revision>"),
    )


def escape_xml(text: Column) -> Column:
    """Character data with markup characters escaped and the carriage return kept."""
    out = text
    for raw, escaped in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("\r", "&#13;")):
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return out
