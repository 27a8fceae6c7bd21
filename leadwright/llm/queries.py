"""The queries of the text operators, one per operator, over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadwright.llm import (
    brown_lm, decontaminate, jaccard_join, lexical_search, licenses, line_dedup, oracles, packing, pii_contexts, quality_rules, tools,
    toxicity, url_lists, vector_codes, warc_zip,
)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, and where."""
    return decontaminate.matches(tools.documents(spark, sf_dir), tools.documents(spark, sf_dir, "benchmark")).drop("distance")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its component of near duplicates."""
    return jaccard_join.near_duplicates(tools.documents(spark, sf_dir))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the text that is left of it."""
    return line_dedup.dedup(tools.documents(spark, sf_dir), carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_removed", "n_chunks_removed")


def op4_brown_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model of those that are not held out."""
    docs = tools.documents(spark, sf_dir)
    return brown_lm.score(docs, brown_lm.fit(docs.filter(~brown_lm.held_out(F.col("doc_id")))))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return quality_rules.verdicts(tools.documents(spark, sf_dir), carry=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "removed_words")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a sequence."""
    return packing.pack(tools.documents(spark, sf_dir))


def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts of every page's record, as read back from archives that hold all of them."""
    return warc_zip.payload_facts(warc_zip.read_records(warc_zip.write_archives(tools.documents(spark, sf_dir, "pages"))))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every licence in every document."""
    return licenses.scan(tools.documents(spark, sf_dir))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a model learned from the labels that are not held out."""
    docs = tools.documents(spark, sf_dir)
    return toxicity.score(docs, toxicity.fit(docs, tools.documents(spark, sf_dir, "labels")))


def dated_captures(pages: DataFrame) -> DataFrame:
    """Pages carry no crawl time; one in January 2024 is derived from the page_id."""
    return pages.select(F.col("page_id").alias("id"), "url", F.expr(
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(int(page_id % 30), 0, 0, int(page_id * 7919 % 86400))").alias("fetch_time"))


def dated_entries(pages: DataFrame, events: DataFrame) -> DataFrame:
    """List entries, one for each signup, purchase, error and click of any user: the first two add, the others remove.

    A user follows the page whose page_id is the user's number, counted round: a third of the users lists that page's
    parent domain, a third its host with the first folder of the path, a third its host.
    """
    n_pages = (pages.agg(F.max("page_id")).first()[0] or 0) + 1
    place = pages.groupBy("page_id").agg(F.max("url").alias("url"))
    host, user = url_lists.host_of(F.col("url")), F.col("user_id") % 3
    pattern = F.when(user == 0, F.regexp_replace(host, r"^[^.]*\.", "")).when(
        user == 1, F.concat(host, F.regexp_extract(url_lists.path_of(F.col("url")), "^/[^/]+/", 0))).otherwise(host)
    found = events.filter(F.col("event_type").isin("signup", "purchase", "error", "click")).join(
        place, F.pmod("user_id", F.lit(n_pages)) == F.col("page_id"))
    return found.select(
        F.when(F.col("event_type").isin("signup", "error"), "block").otherwise("allow").alias("list"), pattern.alias("pattern"),
        F.when(F.col("event_type").isin("signup", "purchase"), "add").otherwise("remove").alias("action"), F.col("ts").alias("at"))


def op10_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the verdict of the list entries that held when it was fetched."""
    pages = tools.documents(spark, sf_dir, "pages")
    found = url_lists.judge(dated_captures(pages), dated_entries(pages, tools.documents(spark, sf_dir, "events")))
    return found.withColumnRenamed("id", "page_id")


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return lexical_search.search(tools.documents(spark, sf_dir), tools.documents(spark, sf_dir, "benchmark"))


def op12_pii_contexts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii_contexts.span_facts(tools.documents(spark, sf_dir))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every whole vector."""
    return vector_codes.coded_vectors(tools.documents(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontaminate, op2_jaccard_join, op3_line_dedup, op4_brown_lm, op5_quality_rules, op6_best_fit_packing,
    op7_warc_zip, op8_license_scan, op9_toxicity, op10_url_lists, op11_lexical_search, op12_pii_contexts, op13_vector_codes)}

#: By query; those of packing, line dedup, licences, toxicity and the language model are tested by brute force.
ORACLES = oracles.ORACLES
