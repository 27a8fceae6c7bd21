"""Toxicity by non-negative positive-unlabelled learning.

Linear classifiers over hashed words and word beginnings learn from confirmed toxic texts and from texts without a label.
With class prior ``p`` the risk of calling unlabelled texts clean counts the toxic ones among them; subtracting
``p`` times the risk of calling confirmed toxic texts clean corrects for it. Where the corrected part falls below
zero, which only overfitting can bring about, the step goes the other way instead (the non-negative estimator).

``fit`` draws a bounded sample by hash (``max_positive`` and ``max_unlabelled`` documents in expectation, taken over all
partitions). The features that tell confirmed from unlabelled texts are found by counts over the sample; numpy
classifiers, each with all confirmed and a part of the unlabelled texts, are trained in ``shards`` tasks and their
weights averaged. The prior is the share of toxic rows among the labelled ones, and the score's scale is set on the
labelled rows of the sample, each weighted by the inverse of the rate at which its kind was drawn, so that 0.7 lies where
toxic and clean part best among all labelled rows, however many there are. ``score`` reads whole texts in a projection with the weights (2 ** 18
numbers) in the closure. Inputs are texts only; labels of held-out documents are never read.

Defined cases: null and empty texts get the score of a text without features; rows of labels with nulls are ignored and
of several labels of a document the largest counts; without any toxic label every score is 0; a null doc_id is not
held out, has no label and is scored; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools

BITS, PREFIXES = 18, (4, 5, 6, 7, 8)
MAX_POSITIVE, MAX_UNLABELLED, SHARDS = 20_000, 40_000, 4
MIN_TEXTS, LIFT, SIGMA = 3, 3.0, 4.0
STEPS, RATE, DECAY = 150, 0.3, 1e-3
THRESHOLD = 0.7

_BREAKS = np.ones(256, dtype=bool)
_BREAKS[97:123] = _BREAKS[65:91] = _BREAKS[128:] = False


@dataclass(frozen=True)
class Model:
    """Feature weights with the constant last; ``scale`` and ``shift`` turn a margin into the score."""

    weights: np.ndarray
    scale: float
    shift: float


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def features(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct feature numbers of each text: its words and the first bytes of its words."""
    data, bounds = tools.doc_texts(texts)
    out = []
    for a, b in tools.wide_texts(bounds):
        hashes, at, *cut = tools.word_hashes(data, bounds[a:b + 1], breaks=_BREAKS, prefixes=PREFIXES)
        every = np.stack([hashes, *cut]) >> np.uint64(64 - BITS)
        out += [np.unique(every[:, i:j]).astype(np.int32) for i, j in zip(at[:-1], at[1:])]
    return out


def margins(rows: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    lens = np.array([len(r) for r in rows], np.int64)
    sums = np.concatenate(([0.0], np.cumsum(weights[np.concatenate(rows)] if rows else [], dtype=np.float64)))
    ends = np.cumsum(lens)
    return sums[ends] - sums[ends - lens] + weights[-1]


def train(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> np.ndarray:
    """Weights that minimise the non-negative risk with logistic loss, by full steps scaled per feature."""
    sides = []
    for rows in (positive, unlabelled):
        sides.append((np.concatenate([*rows, np.zeros(0, np.int32)]), np.repeat(np.arange(len(rows)), [len(r) for r in rows])))
    weights, squares = np.zeros(2 ** BITS + 1), np.full(2 ** BITS + 1, 1e-8)
    chance = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def gradient(side, per_text: np.ndarray) -> np.ndarray:
        flat, of = side
        return np.append(np.bincount(flat, per_text[of], 2 ** BITS), per_text.sum())

    n, m = len(positive), len(unlabelled)
    for _ in range(STEPS):
        zp, zu = margins(positive, weights), margins(unlabelled, weights)
        corrected = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        clean = gradient(sides[1], chance(zu) / m) - gradient(sides[0], prior * chance(zp) / n)
        step = gradient(sides[0], -prior * chance(-zp) / n) + clean if corrected >= 0 else -clean
        step += DECAY * weights
        squares += step ** 2
        weights -= RATE * step / np.sqrt(squares)
    return weights


def telling(positive: np.ndarray, unlabelled: np.ndarray, n: int, m: int) -> np.ndarray:
    """Numbers of the features that confirmed texts have far more often than unlabelled ones.

    ``positive`` and ``unlabelled`` say in how many of the ``n`` and ``m`` texts each feature is. It must be in
    ``MIN_TEXTS`` confirmed texts, ``LIFT`` times as frequent there, and beyond chance by ``SIGMA`` deviations.
    """
    p, u = positive / n, unlabelled / m
    both = (positive + unlabelled) / (n + m)
    spread = np.sqrt(both * (1 - both) * (1 / n + 1 / m))
    return np.flatnonzero((positive >= MIN_TEXTS) & (p >= LIFT * u) & (p - u > SIGMA * spread)).astype(np.int32)


def calibrate(z: np.ndarray, toxic: np.ndarray, threshold: float = THRESHOLD, weight: np.ndarray | None = None) -> tuple[float, float]:
    """Scale and shift so that the margin with the best F1 gets the score ``threshold``.

    ``weight`` says how many labelled rows each row of the sample stands for (1 if not given).
    """
    if not len(z) or not toxic.any():
        return 1.0, 0.0
    order = np.argsort(-z, kind="stable")
    weight = (np.ones(len(z)) if weight is None else weight)[order]
    hits = np.cumsum(weight * toxic[order])
    measure = 2 * hits / (np.cumsum(weight) + hits[-1])
    best = int(np.argmax(measure))
    below = z[order[best + 1]] if best + 1 < len(z) else z[order[best]] - 1
    edge = (z[order[best]] + below) / 2
    spread = np.sqrt(np.average((z[order] - np.average(z[order], weights=weight)) ** 2, weights=weight))
    scale = 1 / max(float(spread), 1e-6)
    return scale, float(np.log(threshold / (1 - threshold)) - scale * edge)


_SAMPLE = "shard int, positive boolean, toxic int, features binary"


def _features_of(chosen: np.ndarray):
    """The chosen features of each sampled text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told = np.zeros(2 ** BITS, bool)
        told[chosen] = True
        for batch in batches:
            rows = [r[told[r]].tobytes() for r in features(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("shard", "positive", "toxic")), pa.array(rows, pa.binary())],
                                             ["shard", "positive", "toxic", "features"])

    return run


def _unpack(column) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), np.int32) for x in column]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many confirmed and other texts of this task each feature is; the row -1 counts the texts."""
    counts = np.zeros((2, 2 ** BITS + 1), np.int64)
    for batch in batches:
        for row, positive in zip(features(batch.column("text")), batch.column("positive").to_pylist()):
            counts[0 if positive else 1][row] += 1
            counts[0 if positive else 1][-1] += 1
    at = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(np.where(at == 2 ** BITS, -1, at)), pa.array(counts[0][at]), pa.array(counts[1][at])],
                                     ["feature", "positive", "unlabelled"])


def _trainer(chosen: np.ndarray, prior: float):
    def run(table: pa.Table) -> pa.Table:
        rows = _unpack(table.column("features"))
        positive = table.column("positive").to_pylist()
        # Sorted, so that sums do not depend on the order in which rows arrive.
        first = sorted((r for r, p in zip(rows, positive) if p), key=bytes)
        other = sorted((r for r, p in zip(rows, positive) if not p), key=bytes)
        found = [train(first, other, prior)[np.append(chosen, -1)].astype("<f8").tobytes()] if first and other else []
        return pa.table({"weights": pa.array(found, pa.binary())})

    return run


def fit(docs: DataFrame, labels: DataFrame, max_positive: int = MAX_POSITIVE, max_unlabelled: int = MAX_UNLABELLED,
        shards: int = SHARDS) -> Model | None:
    """Learn from the labels that are not held out; None when none of them is toxic."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).dropna().filter(
        ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("toxic")).first()
    total = docs.count()
    if not total or not counts["toxic"]:
        return None
    draw = F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(2 ** 30)) / 2 ** 30
    # The labelled part is drawn before the join, so only the sample's texts are shuffled.
    rates = [min(1.0, max_unlabelled / counts["n"]), min(1.0, max_positive / counts["toxic"])]
    picked = known.filter(((F.col("toxic") == 1) & (draw < rates[1])) | ((F.col("toxic") == 0) & (draw < rates[0])))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).filter(
        ~held_out(F.col("doc_id")))
    shard = F.pmod(F.xxhash64(F.lit(11), "doc_id"), F.lit(shards)).cast("int").alias("shard")
    # A text counts as unlabelled whatever its label: the sample stands for all texts.
    free = texts.filter(draw < max_unlabelled / total).select(shard, F.lit(False).alias("positive"), F.lit(None).cast("int").alias("toxic"), "text")
    marked = texts.join(F.broadcast(picked) if max_positive + max_unlabelled <= 200_000 else picked, "doc_id").select(
        shard, (F.col("toxic") == 1).alias("positive"), "toxic", "text")
    sample = tools.materialise(marked.unionByName(free), "toxicity-sample")
    counted = sample.filter("positive OR toxic IS NULL").select("positive", "text").mapInArrow(_counts, "feature long, positive long, unlabelled long").groupBy("feature").agg(
        F.sum("positive").alias("positive"), F.sum("unlabelled").alias("unlabelled")).filter(
        (F.col("feature") < 0) | (F.col("positive") >= MIN_TEXTS)).toPandas().sort_values("feature")  # 2 ** BITS rows at most
    sizes = counted[counted["feature"] < 0].sum()
    if not sizes["positive"] or not sizes["unlabelled"]:
        return None
    listed = counted[counted["feature"] >= 0]
    told = telling(listed["positive"].to_numpy(float), listed["unlabelled"].to_numpy(float), int(sizes["positive"]), int(sizes["unlabelled"]))
    chosen = listed["feature"].to_numpy()[told]
    told_of = tools.materialise(sample.mapInArrow(_features_of(chosen), _SAMPLE), "toxicity-features")
    parts = told_of.filter("positive OR toxic IS NULL").withColumn("shard", F.explode(F.when(F.col("positive"), F.sequence(F.lit(0), F.lit(shards - 1))).otherwise(F.array("shard"))))
    found = parts.groupBy("shard").applyInArrow(_trainer(chosen, counts["toxic"] / counts["n"]), "weights binary").collect()
    if not found:
        return None
    weights = np.zeros(2 ** BITS + 1)
    weights[np.append(chosen, -1)] = np.mean([np.frombuffer(w, "<f8") for w in sorted(r["weights"] for r in found)], axis=0)

    def known_margins(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(margins(_unpack(batch.column("features")), weights)), batch.column("toxic")], ["z", "toxic"])

    rows = told_of.filter("toxic IS NOT NULL").mapInArrow(known_margins, "z double, toxic int").toPandas()
    toxic = rows["toxic"].to_numpy() == 1
    return Model(weights.astype(np.float32), *calibrate(rows["z"].to_numpy(), toxic, weight=1 / np.where(toxic, rates[1], rates[0])))


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                scores = np.zeros(batch.num_rows)
            else:
                z = margins(features(batch.column("text")), model.weights)
                scores = 1 / (1 + np.exp(-np.clip(model.scale * z + model.shift, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(scores)], ["doc_id", "held_out", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, held_out boolean, score double")
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
