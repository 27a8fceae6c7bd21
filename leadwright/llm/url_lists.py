"""URL filter with dated lists: every capture is judged by the list entries that held when it was fetched.

An entry says that from a moment on a pattern is on a list (``add``) or no longer on it (``remove``). Entries of one list
and pattern become disjoint validity intervals: each holds until the next one. A capture looks up the patterns that can
match it (its host and every parent domain, and these hosts with every leading part of the path) and takes of each
the interval that holds its fetch time. An active ``allow`` entry outweighs ``block``; the longest pattern is
reported.

The next entry is found within a day and then over the days of a pattern, so a pattern with a third of all entries is
spread over its days. Intervals are filed under the ``bucket_days`` periods they touch and joined on pattern and period:
a host with a third of all captures is spread over periods, and skewed parts can be split. Nothing is broadcast by
force. DataFrame functions only.

Defined cases: a capture with a null or unusual url or without a fetch time matches nothing and is not blocked; entries
with a null list, pattern, action or moment are ignored; of entries with the same list, pattern and moment ``remove``
wins; an entry holds from its moment (included) to that of the next (excluded); patterns are compared in lower
case, a trailing dot of a host is ignored; equal captures share one verdict, so repeated rows and null ids need no
key; without entries nothing is blocked; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leadwright.llm import tools

BUCKET_DAYS = 30
_DAY = 86_400


def host_of(url: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:@]+)", 1)), r"\.$", "")


def path_of(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^[^/?#]*//[^/?#]*([^?#]*)", 1))


def patterns_of(url: Column) -> Column:
    """The patterns that match a url: ``a.b.c``, ``b.c``, ``c`` and each of them with ``/x/``, ``/x/y/``, ``/x/y/z``."""
    labels = F.split(host_of(url), r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    parts = F.split(path_of(url), "/")
    # Leading folders end in a slash; the whole path stands for itself.
    folders = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.concat(
        F.array_join(F.slice(parts, 1, i), "/"), F.when(i < F.size(parts), "/").otherwise("")))
    tails = F.array_distinct(F.concat(F.array(F.lit("")), F.filter(folders, lambda x: ~x.isin("", "/"))))
    return F.when(host_of(url) != "", F.flatten(F.transform(hosts, lambda h: F.transform(tails, lambda t: F.concat(h, t)))))


def intervals(entries: DataFrame) -> DataFrame:
    """list, pattern, valid_from, valid_to (null: still valid) of the times in which a pattern was on a list."""
    clean = entries.select("list", F.lower("pattern").alias("pattern"), "action", "at").dropna()
    # One entry a moment: "remove" sorts after "add".
    clean = clean.groupBy("list", "pattern", "at").agg(F.max("action").alias("action")).withColumn("day", F.to_date("at"))
    inside = Window.partitionBy("list", "pattern", "day").orderBy("at")
    days = clean.groupBy("list", "pattern", "day").agg(F.min("at").alias("first")).withColumn(
        "later", F.lead("first").over(Window.partitionBy("list", "pattern").orderBy("day"))).drop("first")
    return clean.withColumn("next", F.lead("at").over(inside)).join(days, ["list", "pattern", "day"]).filter("action = 'add'").select(
        "list", "pattern", F.col("at").alias("valid_from"), F.coalesce("next", "later").alias("valid_to"))


def _bucket(moment: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(moment.cast("timestamp")) / (_DAY * days))


def judge(captures: DataFrame, entries: DataFrame, bucket_days: int = BUCKET_DAYS) -> DataFrame:
    """id, url, fetch_time of every capture with blocked, n_active, decided_by (list), pattern and valid_from."""
    held = captures.select("id", "url", "fetch_time")
    entries = entries.withColumn("at", F.col("at").cast(dict(held.dtypes)["fetch_time"]))
    # Dealt out again: each capture becomes a row per pattern, so few small partitions would be a few large ones.
    asked = held.filter("url IS NOT NULL AND fetch_time IS NOT NULL").select("url", "fetch_time").distinct().repartition(
        tools.partitions(held.sparkSession))
    # Open intervals reach to the last fetch.
    last = asked.agg(F.max(_bucket(F.col("fetch_time"), bucket_days)).alias("last"))
    spans = intervals(entries).crossJoin(F.broadcast(last)).withColumn("low", _bucket(F.col("valid_from"), bucket_days)).withColumn(
        "high", F.least(F.coalesce(_bucket(F.col("valid_to"), bucket_days), "last"), F.col("last"))).filter("low <= high")
    filed = spans.withColumn("bucket", F.explode(F.sequence("low", "high"))).drop("low", "high", "last")
    keys = asked.select("url", "fetch_time", _bucket(F.col("fetch_time"), bucket_days).alias("bucket"),
                        F.explode(patterns_of(F.col("url"))).alias("pattern"))
    active = keys.join(filed, ["pattern", "bucket"]).filter(
        "fetch_time >= valid_from AND (valid_to IS NULL OR fetch_time < valid_to)")
    rank = F.struct((F.col("list") == "allow").alias("allowed"), F.length("pattern").alias("size"), "pattern", "list", "valid_from")
    verdict = active.groupBy("url", "fetch_time").agg(F.count("*").alias("n_active"), F.max(rank).alias("top"))
    return held.join(verdict, ["url", "fetch_time"], "left").select(
        "id", "url", "fetch_time", F.coalesce(~F.col("top.allowed"), F.lit(False)).alias("blocked"),
        F.coalesce("n_active", F.lit(0)).cast("long").alias("n_active"), F.col("top.list").alias("decided_by"),
        F.col("top.pattern").alias("pattern"), F.col("top.valid_from").alias("valid_from"))
