"""Quality rules: line frequency across the documents of a host, beside in-document repetition rules.

A line that many different texts of one host carry is boilerplate. Lines are normalised (lower case, white
space folded) and hashed; for each host and line the different texts with it are counted, so that exact
copies of one document count once. A line is over the limit when more than ``min_docs`` texts and more than
``max_share`` of the host's texts carry it. Lines over the limit are removed from the texts; a document that keeps less
than ``min_left`` of its words is depleted and rejected. DataFrame functions only.

A text, not a row, is the document that is counted: a page that is stored a hundred times would otherwise make all of its own lines
boilerplate, and be rejected with all of its copies. The limit is a share as well as a number for the same reason: on a large host
a few hundred near copies of one text must not take each other's lines away.

Defined cases: a null or empty text has no words and fails the base rules; a null host is a host of its own;
rows with equal host and text share one verdict, so repeated rows and null ids need no key; an empty table
gives an empty result; further columns are carried along and cannot clash with the computed ones.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools

MIN_DOCS, MAX_SHARE, MIN_LEFT = 5, 0.10, 0.20
MIN_WORDS, MAX_REPEATED_PERCENT, WINDOW = 10, 20, 5
_SYMBOLS = r"[#*$%&|<>]"
_HAS_WORD = f"[^{tools.SPACES}]"


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda x: x.rlike(_HAS_WORD))


def _normal(line: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(line, f"[{tools.SPACES}]+", " ")))


def _keyed(docs: DataFrame, host: str, carry: list[str]) -> DataFrame:
    """The columns to carry as one column ``row``, with host, text and a hash of the text."""
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), F.coalesce(F.col(host), F.lit("")).alias("host"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    ).withColumn("text_hash", F.xxhash64("text"))


def _with_counts(keyed: DataFrame) -> DataFrame:
    """The base counts. Each step is a column of its own, so that no lambda evaluates an array twice."""
    step = keyed.withColumn("words", tools.words(F.col("text"))).withColumn("lines", _lines(F.col("text")))
    step = step.withColumn("n_words", F.size("words").cast("long")).withColumn(
        "windows", F.when(F.col("n_words") < WINDOW, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(0), F.greatest(F.size("words") - WINDOW, F.lit(0))),
            lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(WINDOW)]))))
    # Sorted (hash, place) pairs, only for the texts in which some window occurs twice.
    step = step.withColumn("pairs", F.when(
        F.size(F.array_distinct("windows")) < F.size("windows"),
        F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    step = step.withColumn("places", F.array_sort(F.transform(F.filter(
        "pairs", lambda p, j: (p["h"] == F.get("pairs", j + 1)["h"]) | ((j > 0) & (
            p["h"] == F.get("pairs", F.greatest(j - 1, F.lit(0)))["h"]))), lambda p: p["i"])))
    # Each repeated window covers its words up to the next repeated window, five at most.
    covered = F.aggregate(F.transform(
        "places", lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get("places", j + 1) - p, F.lit(WINDOW)))),
        F.lit(0), lambda a, x: a + x)
    return step.select(
        "row", "host", "text_hash", "n_words", F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", _SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
    ).withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")))


def line_rows(keyed: DataFrame) -> DataFrame:
    """One row per host, different text and line with a word: its place, hash and number of words."""
    lines = keyed.select("host", "text_hash", F.posexplode(F.split("text", "\n", -1)).alias("place", "line")).filter(F.col("line").rlike(_HAS_WORD))
    return lines.select(
        "host", "text_hash", "place", F.xxhash64(_normal(F.col("line"))).alias("line_hash"),
        F.size(tools.words(F.col("line"))).cast("long").alias("n"),
    ).groupBy("host", "text_hash", "place").agg(F.max("line_hash").alias("line_hash"), F.max("n").alias("n"))


def frequent_lines(lines: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE) -> DataFrame:
    """Lines over the limit: host, line_hash. A text counts once for a line, however often it has the line."""
    hosts = lines.select("host", "text_hash").distinct().groupBy("host").agg(F.count("*").alias("host_docs"))
    counted = lines.select("host", "line_hash", "text_hash").distinct().groupBy("host", "line_hash").agg(
        F.count("*").alias("docs"))
    return counted.filter(F.col("docs") > min_docs).join(hosts, "host").filter(
        F.col("docs") > max_share * F.col("host_docs")).select("host", "line_hash")


def _judged(keyed: DataFrame, min_docs: int, max_share: float, min_left: float) -> DataFrame:
    lines = tools.materialise(line_rows(keyed), "quality-lines")
    removed = lines.join(frequent_lines(lines, min_docs, max_share), ["host", "line_hash"]).groupBy(
        "host", "text_hash").agg(F.sum("n").alias("removed_words"), F.collect_list("place").alias("removed_lines"))
    found = _with_counts(keyed).join(removed, ["host", "text_hash"], "left").withColumn(
        "removed_words", F.coalesce("removed_words", F.lit(0)))
    depleted = F.col("n_words") - F.col("removed_words") < min_left * F.col("n_words")
    return found.withColumn("kept", ~F.col("base_failed") & ~depleted)


def verdicts(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
             min_left: float = MIN_LEFT, carry: list[str] | None = None) -> DataFrame:
    """Every input row as ``row`` (its columns ``carry``, or all) with its counts, ``removed_words`` and ``kept``.

    The line rows are written once and read for the counts and for the removal. Rows of a hot host are spread by
    text and line; the join back on (host, text) can be split on the document side. Write the result before filtering
    on it: a filter moves down into the counts and repeats their array work.
    """
    keyed = _keyed(docs, host, docs.columns if carry is None else carry)
    return _judged(keyed, min_docs, max_share, min_left).drop("text_hash", "removed_lines")


def kept_documents(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE,
                   min_left: float = MIN_LEFT) -> DataFrame:
    """The documents that the rules keep, without the lines over the limit, and with the columns of the input (``n_chars`` counted anew)."""
    judged = _judged(_keyed(docs, host, ["text"]), min_docs, max_share, min_left).select("host", "text_hash", "kept", "removed_lines")
    kept = tools.materialise(judged, "quality-verdicts").filter("kept").dropDuplicates(["host", "text_hash"]).drop("kept")
    rows = _keyed(docs, host, docs.columns).select("row", "host", "text_hash").join(kept, ["host", "text_hash"])
    # The lines are split once, in a struct of their own, and those that stay are put together again.
    split = F.struct(F.split("row.text", "\n", -1).alias("lines"), F.col("removed_lines").alias("removed"))
    shorter = F.element_at(F.transform(F.array(split), lambda x: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(x["lines"]) - 1), x["removed"]), lambda i: F.get(x["lines"], i)), "\n")), 1)
    cut = F.size("removed_lines") > 0
    rows = rows.withColumn("left", F.when(cut, shorter).otherwise(F.col("row.text")))
    new = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(cut, F.length("left").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return rows.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])
