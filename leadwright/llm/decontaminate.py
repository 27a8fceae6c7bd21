"""Benchmark decontamination by SimHash over item-sized windows.

1. Shingles of five words of all documents meet those of the items; a shared shingle at place p of a document and q of
   an item of L words proposes the window of L words that begins at p - q (moved inside the text where it would
   stick out). A window without a shared shingle has similarity 0, so none is missed, and no fingerprint is made of
   text that shares nothing.
2. Each proposed window and each item gets a 64-bit SimHash of its weighted shingles (weight: how often it occurs).
3. Fingerprints are cut into eight blocks of eight bits. Two that differ in at most 23 bits differ in at most two bits
   in some block, so the items are indexed under every block value within two bits, and windows of the items' length
   look up their eight blocks. All pairs within the radius are found; pairs beyond it are dropped by true distance.
4. Candidates are verified by the exact weighted Jaccard similarity: sum of the lesser over sum of the greater weights.

The expected distance at similarity 0.75 is 11 bits of 64, with a standard deviation of 3. DataFrame functions only.
The item side is broadcast only when a count shows at most ``broadcast_rows`` rows; beyond that it is joined by shuffle.

Defined cases: texts are compared in lower case; null and empty texts and items match nothing; an item of fewer than
five words is one shingle of all its words; a document shorter than an item is one window; equal texts are searched
once and share the result; rows with one doc_id (or none) and one item give their best window; of equally good
windows the first is returned; empty tables give an empty result; further columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools

K, SIMILARITY = 5, 0.75
BLOCKS, BLOCK_BITS, NEAR_BITS = 8, 8, 2
RADIUS = BLOCKS * (NEAR_BITS + 1) - 1
BROADCAST_ROWS = 1_000_000


def _grams(k: Column | int) -> Column:
    """Hashes of the ``k``-word shingles of the array column ``words``, in order."""
    k = F.lit(k) if isinstance(k, int) else k
    return F.when(F.size("words") >= k, F.transform(
        F.sequence(F.lit(0), F.greatest(F.size("words") - k, F.lit(0))),
        lambda i: F.xxhash64(*[F.when(k > j, F.get("words", i + j)) for j in range(K)])))


def _sign(grams: str) -> Column:
    """SimHash: a bit is set when shingles of more than half the weight have it; a repeated shingle weighs more."""
    count = lambda b: F.aggregate(
        grams, F.lit(0).cast("long"), lambda a, h: a + F.expr("1L").bitwiseAND(F.call_function("shiftright", h, b)))
    bits = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda b: (2 * count(b) > F.size(grams)).cast("long"))
    return F.aggregate(bits, F.lit(0).cast("long"), lambda a, bit: F.shiftleft(a, 1).bitwiseOR(bit))


def _blocks(sign: str) -> Column:
    """The blocks of a fingerprint: array of (block number, value)."""
    return F.array(*[F.struct(F.lit(b).alias("block"), F.shiftrightunsigned(sign, BLOCK_BITS * b).bitwiseAND(
        F.lit(2 ** BLOCK_BITS - 1)).cast("int").alias("value")) for b in range(BLOCKS)])


def _overlap(a: str, b: str) -> Column:
    """Sum over shingles of the lesser of their weights in two arrays."""
    times = lambda grams, h: F.size(F.filter(grams, lambda x: x == h))
    plain = (F.size(F.array_distinct(a)) == F.size(a)) | (F.size(F.array_distinct(b)) == F.size(b))
    return F.when(plain, F.size(F.array_intersect(a, b))).otherwise(F.aggregate(
        F.array_distinct(b), F.lit(0), lambda s, h: s + F.least(times(a, h), times(b, h))))


def items_table(benchmark: DataFrame) -> DataFrame:
    """item_id, item_key, n (words), k (words per shingle), grams, sign."""
    cut = benchmark.select("item_id", tools.words(F.lower("text")).alias("words")).filter(F.size("words") > 0)
    cut = cut.withColumn("n", F.size("words")).withColumn("k", F.least(F.lit(K), F.size("words")))
    cut = cut.withColumn("grams", _grams(F.col("k"))).drop("words")
    return cut.withColumn("item_key", F.xxhash64("n", "grams")).withColumn("sign", _sign("grams"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("text_key"))


def windows_table(docs: DataFrame, items: DataFrame, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """text_key, n, starts: the windows of ``n`` words of each different text that share a shingle with an item of ``n`` words."""
    places = items.select("k", "n", F.posexplode("grams").alias("q", "h")).groupBy("k", "h", "n").agg(
        F.collect_set("q").alias("qs")).groupBy("k", "h").agg(F.collect_list(F.struct("n", "qs")).alias("found"))
    places = tools.materialise(places, "benchmark-shingles")
    if places.count() <= broadcast_rows:
        places = F.broadcast(places)
    words = _keyed(docs).select("text_key", tools.words(F.lower("text")).alias("words"))
    kinds = [r["k"] for r in items.select("k").distinct().collect()]  # at most five values
    grams = [words.select("text_key", F.size("words").alias("size"), F.lit(k).alias("k"), F.posexplode(_grams(k)).alias("p", "h"))
             for k in sorted(kinds) or [K]]
    hits = reduce(DataFrame.unionByName, grams).join(places, ["k", "h"]).select(
        "text_key", "size", "p", F.explode("found").alias("found"))
    start = lambda q: F.greatest(F.lit(0), F.least(F.col("p") - q, F.col("size") - F.col("found.n")))
    return hits.select("text_key", F.col("found.n").alias("n"), F.explode(F.transform("found.qs", start)).alias("start")).groupBy(
        "text_key", "n").agg(F.collect_set("start").alias("starts"))


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
                       broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """The best window of every different text and item: text_key, item_id, start, n_words, distance, similarity."""
    if radius > RADIUS:
        raise ValueError(f"the blocks find all fingerprints within {RADIUS} bits, not {radius}")
    items = tools.materialise(items_table(benchmark), "benchmark-items")
    windows = tools.materialise(windows_table(docs, items, broadcast_rows), "benchmark-windows")
    texts = _keyed(docs).join(windows.select("text_key").distinct(), "text_key", "left_semi").groupBy("text_key").agg(
        F.min("text").alias("text"))
    cut = texts.join(windows, "text_key").withColumn("all", tools.words(F.lower("text"))).select(
        "text_key", "n", F.explode(F.transform("starts", lambda s: F.struct(
            s.alias("start"), F.slice("all", s + 1, F.col("n")).alias("words")))).alias("w")).select("text_key", "n", "w.start", "w.words")
    cut = cut.withColumn("grams", _grams(F.least(F.lit(K), F.col("n")))).filter("grams IS NOT NULL")
    cut = tools.materialise(cut.withColumn("n_words", F.size("words")).drop("words").withColumn("sign", _sign("grams")), "benchmark-cuts")

    near = F.array(*[F.lit(m) for m in range(2 ** BLOCK_BITS) if m.bit_count() <= NEAR_BITS])
    index = items.select("item_key", "n", F.explode(_blocks("sign")).alias("b")).select(
        "item_key", "n", "b.block", F.explode(F.transform(near, lambda m: F.col("b.value").bitwiseXOR(m))).alias("value")).distinct()
    if items.count() * BLOCKS * 37 <= broadcast_rows:  # 37 values lie within two bits of a block's own
        index = F.broadcast(index)
    probes = cut.select("text_key", "n", "start", F.explode(_blocks("sign")).alias("b")).select("text_key", "n", "start", "b.block", "b.value")
    pairs = probes.join(index, ["n", "block", "value"]).select("text_key", "n", "start", "item_key").distinct()

    sides = items.select("item_id", "item_key", F.col("grams").alias("item_grams"), F.col("sign").alias("item_sign"))
    found = pairs.join(cut, ["text_key", "n", "start"]).join(sides, "item_key").withColumn(
        "distance", F.bit_count(F.col("sign").bitwiseXOR(F.col("item_sign")))).filter(F.col("distance") <= radius)
    found = found.withColumn("shared", _overlap("grams", "item_grams")).withColumn(
        "similarity", F.col("shared") / (F.size("grams") + F.size("item_grams") - F.col("shared"))).filter(F.col("similarity") >= similarity)
    return _best(found.select("text_key", "item_id", "start", "n_words", "distance", "similarity"), "text_key")


def _best(found: DataFrame, key: str) -> DataFrame:
    best = F.max(F.struct("similarity", (-F.col("start")).alias("back"), "n_words", "distance"))
    return found.groupBy(key, "item_id").agg(best.alias("b")).select(
        key, "item_id", (-F.col("b.back")).alias("start"), "b.n_words", "b.distance", "b.similarity")


def matches(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """doc_id, item_id, start (word), n_words, distance, similarity: what each contaminated document holds of which item."""
    found = contaminated_texts(docs, benchmark, **options)
    held = docs.select("doc_id", F.xxhash64("text").alias("text_key")).join(found, "text_key")
    return _best(held.select("doc_id", "item_id", "start", "n_words", "distance", "similarity"), "doc_id")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no item, with the columns of the input."""
    dirty = contaminated_texts(docs, benchmark, **options).select("text_key").distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.xxhash64("text").alias("text_key"))
    return rows.join(dirty, "text_key", "left_anti").select("row.*")
