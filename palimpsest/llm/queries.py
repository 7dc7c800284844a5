"""Queries of the text operators (problems 1, 2, 8, 9 and 10) over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.markup import clean_markup
from palimpsest.llm.mixing import Target, mix, mixing_report
from palimpsest.llm.packing import Tier, pack, packing_report
from palimpsest.llm.residue import residue_documents, without_residue
from palimpsest.llm.tokens import token_count
from palimpsest.llm.truncation import cut_titles, truncated_values, truncation_report
from palimpsest.operators.common import first_delivery, salted_lookup, spread
from palimpsest.plans.tables import table
from palimpsest.scratch import Scratch


# --- Problem 1 -----------------------------------------------------------------------------------------------------------------
def p1_clean(spark: SparkSession, d: str) -> DataFrame:
    """Per distinct revision with a text: the kinds of markup, the clean text and its structure."""
    texts = table(spark, d, "page_revision_text").select("page_revision_id", "article_text")
    texts = texts.dropDuplicates(["page_revision_id"])
    return clean_markup(texts, id_column="page_revision_id", text="article_text")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    cleaned = clean_markup(table(spark, d, "page_revision_text"), id_column="page_revision_id", text="article_text")
    return cleaned.where(F.col("markup") != "").select("page_revision_id").distinct()


# --- Problem 2 -----------------------------------------------------------------------------------------------------------------
def _sent_values(spark: SparkSession, d: str) -> DataFrame:
    """(record_table, record_id, value, source): the earliest delivery of every comment and redirect title, with its host."""
    revisions = table(spark, d, "page_revision").select("page_revision_id", "run_id", "loaded_at", "comment")
    pages = table(spark, d, "wiki_page").select("page_id", "run_id", "loaded_at", "redirect_title")
    shape = lambda df, name, key, value: first_delivery(df, key).select(
        F.lit(name).alias("record_table"), F.col(key).alias("record_id"), F.col(value).alias("value"), "run_id"
    )
    values = shape(revisions, "page_revision", "page_revision_id", "comment").unionByName(
        shape(pages, "wiki_page", "page_id", "redirect_title")
    )
    hosts = table(spark, d, "load_run").select("run_id", F.col("host_name").alias("source")).dropDuplicates(["run_id"])
    return salted_lookup(values.where(F.length("value") > 0), hosts, "run_id").drop("run_id")


def _marked(spark: SparkSession, d: str) -> DataFrame:
    scratch = Scratch(spark, "sent")
    values = scratch.write(_sent_values(spark, d), "values")
    marked = truncated_values(values, column="record_table")
    redirects = values.where(F.col("record_table") == "wiki_page")
    fronts = cut_titles(redirects, table(spark, d, "wiki_page"), title="value", name="page_name")
    fronts = fronts.select("value", F.lit("wiki_page").alias("record_table"), F.lit(True).alias("front"))
    fronts = scratch.write(fronts, "fronts")
    cut = F.coalesce(F.col("cut"), F.when(F.col("front"), F.lit("transfer")))
    return salted_lookup(marked, fronts, ["record_table", "value"]).withColumn("cut", cut).drop("front")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _marked(spark, d).where(F.col("cut").isNotNull()).select("record_table", "record_id")


def p2_sources(spark: SparkSession, d: str) -> DataFrame:
    return truncation_report(_marked(spark, d), column="record_table")


# --- Problem 8 -----------------------------------------------------------------------------------------------------------------
def _sized(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "source", "text")
    return spread(docs).withColumn("tokens", token_count(F.col("text")))


def _tiers(spark: SparkSession, d: str) -> list[Tier]:
    rows = table(spark, d, "container_spec").select("spec_id", "capacity_tokens").collect()  # a handful of container sizes
    return [Tier(r[0], r[1]) for r in rows]


def p8_packing(spark: SparkSession, d: str) -> DataFrame:
    """Every document in a container of the smallest size that holds it, or in the gap of a larger one."""
    sized = Scratch(spark, "sized").write(_sized(spark, d).select("doc_id", "tokens"), "tokens")
    return pack(sized, _tiers(spark, d), item_id="doc_id", size="tokens").withColumnRenamed("item", "doc_id")


def p8_packing_each(spark: SparkSession, d: str) -> DataFrame:
    """All documents once per container size."""
    sized = Scratch(spark, "sized").write(_sized(spark, d).select("doc_id", "tokens"), "tokens")
    out = None
    for tier in _tiers(spark, d):
        packed = pack(sized, [tier], item_id="doc_id", size="tokens").withColumnRenamed("item", "doc_id")
        out = packed if out is None else out.unionByName(packed)
    return out


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    return packing_report(p8_packing(spark, d), table(spark, d, "container_spec"))


def p8_fill_each(spark: SparkSession, d: str) -> DataFrame:
    return packing_report(p8_packing_each(spark, d), table(spark, d, "container_spec"))


# --- Problem 9 -----------------------------------------------------------------------------------------------------------------
def _mixture(spark: SparkSession, d: str) -> tuple[DataFrame, list[Target], dict[str, int]]:
    rows = table(spark, d, "mix_target").collect()  # one row per target source
    targets = [Target(r["source"], r["target_share"], r["max_repeats"]) for r in rows if r["source"] is not None]
    # Hashes instead of texts: equal texts are one document, and each is tokenized once, before anything is filtered by its size.
    sized = _sized(spark, d).select("doc_id", "source", "tokens", F.md5("text").alias("text"))
    chosen, quotas = mix(Scratch(spark, "sized").write(sized, "tokens"), targets)
    return chosen, targets, quotas


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return _mixture(spark, d)[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing_report(*_mixture(spark, d))


# --- Problem 10 ----------------------------------------------------------------------------------------------------------------
def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return residue_documents(table(spark, d, "documents"))


def p10_clean(spark: SparkSession, d: str) -> DataFrame:
    return without_residue(table(spark, d, "documents").select("doc_id", "title", "source", "lang", "text"))


QUERIES = {
    f.__name__: f
    for f in (
        p1_found, p1_clean, p2_found, p2_sources, p8_packing, p8_packing_each, p8_fill, p8_fill_each, p9_mixture, p9_shares, p10_found,
        p10_clean,
    )
}

#: Parsing, tokenizers, packing, flows and similarity are no SQL; these queries are tested against brute force and fixtures.
ORACLE: dict[str, str] = {}
