"""Ranked lexical search turned round: the items are indexed, and every document streams through the index.

The items (queries) are few and the documents many, so the inverted index is built over the items' terms and broadcast.
A first pass counts documents, terms and, for the items' terms only, the documents that hold them. In the second pass
each task sends the term counts of its documents through the index and keeps one bounded heap of the ``k`` best
documents per item; the heaps of all tasks are merged in two steps. No posting of a document leaves its task, so nothing
that is shuffled depends on how frequent a word is.

The score of a document is ``sum w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` over the item's terms, repeats
included, with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 25 + (75 * n * N) div L``; N documents have terms, L
terms in all, n in the document, df documents hold the term. Terms are runs of ASCII letters and digits and of all characters
beyond ASCII, A-Z lower-cased. They meet by a 64-bit hash.

The index holds at most ``block_bytes`` of item texts, counted before anything is collected (an item that is larger stands alone);
more items are taken block by block, each against all documents.

Defined cases: a null or empty text has no terms, counts for nothing and is found by nothing; an item without terms has
no rows; items with equal item_id and text are one, with one item_id and two texts each is ranked for itself; repeated
documents are all ranked; ties fall to the smaller doc_id, a null doc_id last; no documents or no items give no
rows; further columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from leadwright.llm import tools

TOP, BLOCK_BYTES = 10, 4 << 20
#: Cells of the score table of one step (documents x items), and the slices in which heaps are merged first.
CELLS, SLICES = 2 << 20, 16
_DOCS, _TERMS = -1, -2
_NO_ID = np.int64(2**63 - 1)

_BREAKS = np.ones(256, dtype=bool)
for _low, _high in ((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)):
    _BREAKS[_low:_high + 1] = False


def _terms(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First text, term hashes and bounds of each text, for runs of texts."""
    data, bounds = tools.doc_texts(texts)
    for a, b in tools.wide_texts(bounds):
        yield (a, *tools.word_hashes(data, bounds[a:b + 1], breaks=_BREAKS))


def _hits(vocabulary: np.ndarray, hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Document, term number and frequency, for every term of the vocabulary in every document."""
    place = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    known = np.flatnonzero(vocabulary[place] == hashes)
    docs = np.searchsorted(at, known, "right") - 1
    cells, tf = np.unique(docs * len(vocabulary) + place[known], return_counts=True)
    return cells // len(vocabulary), cells % len(vocabulary), tf


class Index:
    """Postings of some items: for each term (by number) the items that hold it, and how often."""

    def __init__(self, texts: list[str]):
        items, hashes = [], []
        for first, found, at in _terms(pa.array(texts, pa.string())):
            hashes.append(found)
            items.append(np.repeat(np.arange(first, first + len(at) - 1), np.diff(at)))
        hashes, items = tools.concat(hashes, np.uint64), tools.concat(items, np.int64)
        self.n_items = len(texts)
        self.vocabulary, term = np.unique(hashes, return_inverse=True)
        cells, self.repeats = np.unique(term * max(self.n_items, 1) + items, return_counts=True)
        self.items = cells % max(self.n_items, 1)
        self.bounds = np.searchsorted(cells // max(self.n_items, 1), np.arange(len(self.vocabulary) + 1))


def _count(vocabulary: np.ndarray):
    """Documents that hold each term, and under _DOCS and _TERMS the documents with terms and all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, terms = np.zeros(len(vocabulary), np.int64), 0, 0
        for batch in batches:
            for _, hashes, at in _terms(batch.column("text")):
                docs += int((np.diff(at) > 0).sum())
                terms += len(hashes)
                df += np.bincount(_hits(vocabulary, hashes, at)[1], minlength=len(vocabulary))
        held = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(held, (_DOCS, _TERMS)), pa.int64()),
                                          pa.array(np.append(df[held], (docs, terms)), pa.int64())], ["term", "n"])

    return run


class _Heaps:
    """The k best (score, doc_id) of each item, best first within an item."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)
        self.items, self.scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, bool)

    def push(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        doc, item = np.nonzero(scores >= self.least)
        if not len(doc):
            return
        items = np.concatenate((self.items, item))
        found = np.concatenate((self.scores, scores[doc, item]))
        ids, missing = np.concatenate((self.ids, ids[doc])), np.concatenate((self.missing, missing[doc]))
        order = np.lexsort((ids, missing, -found, items))
        items = items[order]
        rank = np.arange(len(items)) - np.searchsorted(items, items)
        order, items, rank = order[rank < self.k], items[rank < self.k], rank[rank < self.k]
        self.items, self.scores, self.ids, self.missing = items, found[order], ids[order], missing[order]
        full = rank == self.k - 1
        self.least[items[full]] = self.scores[full]


def _score(index: Index, weights: np.ndarray, docs: int, terms: int, k: int):
    def scores(doc, term, tf, m, first: int, last: int) -> np.ndarray:
        table = np.zeros((last - first, index.n_items), np.int64)
        inside = slice(*np.searchsorted(doc, (first, last)))
        doc, term, tf = doc[inside] - first, term[inside], tf[inside].astype(np.int64)
        gain = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc + first]))
        order = np.argsort(term, kind="stable")
        doc, term, gain = doc[order], term[order], gain[order]
        for a, b in zip(*_runs(term)):
            post = slice(index.bounds[term[a]], index.bounds[term[a] + 1])
            table[doc[a:b, None], index.items[post]] += gain[a:b, None] * index.repeats[post]
        return table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps, step = _Heaps(index.n_items, k), max(1, CELLS // index.n_items)
        for batch in batches:
            column = batch.column("doc_id")
            ids, missing = column.fill_null(_NO_ID).to_numpy(), column.is_null().to_numpy(zero_copy_only=False)
            for a, hashes, at in _terms(batch.column("text")):
                m = 25 + 75 * np.diff(at).astype(np.int64) * docs // max(terms, 1)
                hits = _hits(index.vocabulary, hashes, at)
                for first in range(0, len(at) - 1, step):
                    last = min(first + step, len(at) - 1)
                    heaps.push(scores(*hits, m, first, last), ids[a + first:a + last], missing[a + first:a + last])
        yield pa.RecordBatch.from_arrays([pa.array(heaps.items, pa.int64()), pa.array(heaps.ids, pa.int64(), mask=heaps.missing),
                                          pa.array(heaps.scores, pa.int64())], ["item", "doc_id", "score"])

    return run


def _runs(values: np.ndarray) -> tuple[list[int], list[int]]:
    starts = np.flatnonzero(np.diff(values, prepend=values[:1] - 1)) if len(values) else np.zeros(0, int)
    return starts.tolist(), [*starts[1:].tolist(), len(values)][:len(starts)]


def _blocks(items: DataFrame, block_bytes: int) -> list[DataFrame]:
    """The items in blocks of at most ``block_bytes`` of text, or of one item."""
    n, spread = 1, F.xxhash64("item_id", "text")
    while True:
        dealt = items.withColumn("block", F.pmod(spread, F.lit(n)))
        sizes = dealt.groupBy("block").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("rows"))
        worst = sizes.filter((F.col("rows") > 1) & (F.col("bytes") > block_bytes)).agg(F.max("bytes").alias("b")).first()["b"]
        if worst is None:
            return [dealt.filter(F.col("block") == i).drop("block") for i in range(n)]
        n *= max(2, -(-worst // block_bytes))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank (int, from 1), doc_id, score: the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    asked = tools.materialise(items.select("item_id", F.col("text").cast("string").alias("text")).filter("text <> ''").distinct(), "items")
    found = None
    for block in _blocks(asked, block_bytes):
        rows = block.collect()  # at most block_bytes of text
        index = Index([r["text"] for r in rows])
        if not len(index.vocabulary):
            continue
        counts = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(_count(index.vocabulary), "term long, n long").groupBy(
            "term").agg(F.sum("n").alias("n")).collect()}  # one row per term of the block
        n_docs, n_terms = counts.get(_DOCS, 0), counts.get(_TERMS, 0)
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counts.get(t, 0) + 1)))
                            for t in range(len(index.vocabulary))], np.int64)
        heaps = docs.mapInArrow(_score(index, weights, n_docs, n_terms, k), "item long, doc_id long, score long")
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {asked.schema['item_id'].dataType.simpleString()}")
        best = _best(_best(heaps.withColumn("slice", F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))), ["item", "slice"], k), ["item"], k)
        best = best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        found = best if found is None else found.unionByName(best)
    if found is None:
        return asked.limit(0).select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score"))
    return found


def _best(rows: DataFrame, keys: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
