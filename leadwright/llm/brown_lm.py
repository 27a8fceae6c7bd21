"""Class-based language model after Brown et al.: exchange clustering, class transitions and word emissions.

``fit`` learns from the documents given to it, all of their words:

1. Words (64-bit hashes) are counted over the corpus; tasks add up their own counts first.
2. Frequent words (at least ``CORE_SHARE`` of all tokens each, so 100,000 at most) are clustered. Counts of neighbouring
   pairs are gathered over the corpus; then rounds of exchange give every word the class under which its left and
   right neighbours' classes are likeliest, with its own counts taken out of its present class. Half of the words
   may move in a round, as otherwise neighbours would swap for ever; the classes of the best round stay. All other
   words form one class of rare words, the end of a text another.
3. P(text) = product of P(class | class before) * P(word | class), a text beginning after an end. Transitions are
   smoothed towards the classes' own frequencies; emissions add 0.1 to each count and give an unseen word 0.1, so that
   for single tokens the model and the unigram base have the same chances.

``score`` reads whole texts once. Counts of words with at least ``HEAD_SHARE`` of all tokens (4 million at most) travel in
a broadcast; rarer words are joined with the vocabulary by shuffle, where no word can be hot. The driver holds the
frequent words, their classes and the class matrix.

Defined cases: a null or empty text is its end token; without training documents every word is unseen; rows with
equal doc_id are scored each; a null doc_id is not held out; an empty table gives an empty result; further columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadwright.llm import tools

CLASSES, ROUNDS = 48, 10
CORE_SHARE, HEAD_SHARE = 1e-5, 2.5e-7
ADD, TOWARDS_CLASS = 0.1, 20.0
END = np.uint64(0x5E17E1D0F7E87000)
#: Distinct words or pairs that a task adds up before it passes them on.
HELD = 2_000_000
CHUNK = 4096  # words whose counts one group of the exchange handles


@dataclass(frozen=True)
class Model:
    """head: sorted hashes; counts: of each; classes: of each, the last but one class is rare, the last the end."""

    vocabulary: DataFrame
    tokens: int
    types: int
    head: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    transitions: np.ndarray
    rare_mass: float
    class_mass: np.ndarray

    @property
    def mass(self) -> float:
        return self.tokens + ADD * (self.types + 1)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


def _tokens(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, hashes of words and ends, place of each end) of runs of texts."""
    data, bounds = tools.doc_texts(batch.column("text"))
    for a, b in tools.wide_texts(bounds):
        hashes, at = tools.word_hashes(data, bounds[a:b + 1])
        yield a, np.insert(hashes, at[1:], END), at[1:] + np.arange(b - a)


def _lookup(hashes: np.ndarray, sorted_hashes: np.ndarray) -> np.ndarray:
    """Place of each hash, or -1."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == hashes, at, -1)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(counts), len(distinct)).astype(np.int64)


def _counted(runs: Iterator[np.ndarray], name: str) -> Iterator[pa.RecordBatch]:
    """Counts of the keys in runs of keys, added up while they fit."""
    keys, counts, held = [], [], 0
    for run in runs:
        k, c = np.unique(run, return_counts=True)
        keys.append(k), counts.append(c)
        held += len(k)
        if held >= HELD:
            k, c = _summed(keys, counts)
            keys, counts, held = [k], [c], len(k)
            if held >= HELD // 2:
                yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], [name, "n"])
                keys, counts, held = [], [], 0
    if keys:
        k, c = _summed(keys, counts)
        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], [name, "n"])


def word_counts(docs: DataFrame) -> DataFrame:
    """h (hash of a word or the end), n."""
    def run(batches):
        return _counted((t for batch in batches for _, t, _ in _tokens(batch)), "h")

    return docs.select("text").mapInArrow(run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def pair_counts(docs: DataFrame, core: np.ndarray) -> DataFrame:
    """a, b (numbers of core words; their number stands for rare words, the next for the end), n."""
    shared = docs.sparkSession.sparkContext.broadcast(core)
    wide = len(core) + 2

    def pairs(batches):
        for batch in batches:
            for _, hashes, ends in _tokens(batch):
                ids = _lookup(hashes, shared.value)
                ids[ids < 0] = wide - 2
                ids[ends] = wide - 1
                before = np.append(wide - 1, ids[:-1])
                yield before.astype(np.int64) * wide + ids

    counted = docs.select("text").mapInArrow(lambda batches: _counted(pairs(batches), "pair"), "pair long, n long")
    return counted.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.expr(f"pair div {wide}").cast("int").alias("a"), F.expr(f"pair % {wide}").cast("int").alias("b"), "n")


def _class_sums(classes, n_classes: int):
    """Counts of every word with the classes after and before it, in chunks of words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = classes.value
        sums = np.zeros((2, len(of), n_classes))
        for batch in batches:
            a, b, n = (batch.column(c).to_numpy() for c in ("a", "b", "n"))
            for side, word, other in ((0, a, b), (1, b, a)):
                sums[side] += np.bincount(word.astype(np.int64) * n_classes + of[other], n, len(of) * n_classes).reshape(len(of), n_classes)
        starts = [s for s in range(0, len(of), CHUNK) if sums[:, s:s + CHUNK].any()]
        yield pa.RecordBatch.from_arrays([
            pa.array([s // CHUNK for s in starts], pa.int32()), pa.array([sums[:, s:s + CHUNK].astype("<f4").tobytes() for s in starts], pa.binary())], ["chunk", "sums"])

    return run


def _exchange(classes, logs, totals, n_classes: int, round_: int, moving: bool):
    """For a chunk of words: their new classes, and what the present classes of the chunk add to the class matrix."""
    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk")[0].as_py()
        own = classes.value[chunk * CHUNK:(chunk + 1) * CHUNK]
        sums = sum(np.frombuffer(x.as_py(), "<f4").astype(np.float64) for x in table.column("sums")).reshape(2, len(own), n_classes)
        matrix = np.zeros((n_classes, n_classes))
        np.add.at(matrix, own, sums[0])
        new = own.copy()
        if moving:
            follow, lead = logs.value
            n = sums[1].sum(axis=1)
            value = sums[0] @ follow.T + sums[1] @ lead
            # log of the share of the word in a class, the word itself taken out of its present class first
            rest = np.maximum(totals.value[None, :] - np.where(np.arange(n_classes)[None, :] == own[:, None], n[:, None], 0), 1.0)
            value -= n[:, None] * np.log(rest + n[:, None])
            value[:, n_classes - 2:] = -np.inf
            free = (own < n_classes - 2) & ((np.arange(len(own)) + chunk * CHUNK) * 2654435761 // 65536 % 2 == round_ % 2)
            new[free] = value[free].argmax(axis=1)
        return pa.table({"chunk": pa.array([chunk], pa.int32()), "classes": pa.array([new.astype("<i4").tobytes()], pa.binary()),
                         "matrix": pa.array([matrix.astype("<f8").tobytes()], pa.binary())})

    return run


def _likelihood(matrix: np.ndarray) -> float:
    """Log-likelihood of the classes up to what the words themselves add."""
    log = lambda x: np.sum(x * np.log(np.maximum(x, 1)))
    return float(log(matrix) - log(matrix.sum(axis=1)) - log(matrix.sum(axis=0)))


def cluster(pairs: DataFrame, n_words: int, n_classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Classes of the core words, the rare words and the end, and the matrix of class pairs."""
    sc, wide = pairs.sparkSession.sparkContext, n_classes + 2
    classes = np.append(np.arange(n_words) % n_classes, [n_classes, n_classes + 1]).astype(np.int32)
    best, logs, totals = None, None, None
    for round_ in range(rounds + 1):
        held = sc.broadcast(classes)
        sums = pairs.mapInArrow(_class_sums(held, wide), "chunk int, sums binary")
        moving = logs is not None
        found = sums.groupBy("chunk").applyInArrow(
            _exchange(held, sc.broadcast(logs), sc.broadcast(totals), wide, round_, moving), "chunk int, classes binary, matrix binary").collect()
        matrix = sum((np.frombuffer(r["matrix"], "<f8").reshape(wide, wide) for r in found), np.zeros((wide, wide)))
        value = _likelihood(matrix)
        if best is None or value > best[0]:
            best = (value, classes, matrix)
        new = classes.copy()
        for r in found:
            new[r["chunk"] * CHUNK:r["chunk"] * CHUNK + len(r["classes"]) // 4] = np.frombuffer(r["classes"], "<i4")
        if moving and (new == classes).all():
            break
        smooth = matrix + 0.5 * matrix.sum(axis=0) / max(matrix.sum(), 1) + 1e-9
        follow = np.log(smooth / smooth.sum(axis=1, keepdims=True))
        logs, totals, classes = (follow, follow), matrix.sum(axis=0), new
    return best[1], best[2]


def fit(docs: DataFrame, n_classes: int = CLASSES, rounds: int = ROUNDS) -> Model:
    """Learn from all the documents."""
    vocabulary = tools.materialise(word_counts(docs), "words")
    sums = vocabulary.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    tokens, types = sums["n"], sums["v"]
    table = vocabulary.filter(F.col("n") >= HEAD_SHARE * tokens).toArrow()
    head = table.column("h").to_numpy().view(np.uint64)
    order = np.argsort(head)
    head, counts = head[order], table.column("n").to_numpy()[order].astype(np.float64)
    core = (counts >= CORE_SHARE * tokens) & (head != END)
    n_core = int(core.sum())
    pairs = tools.materialise(pair_counts(docs, head[core]), "word-pairs")
    classes, matrix = cluster(pairs, n_core, n_classes, rounds)
    of_head = np.full(len(head), n_classes, np.int32)
    of_head[core], of_head[head == END] = classes[:n_core], n_classes + 1
    share = (matrix.sum(axis=0) + 1) / (matrix.sum() + len(matrix))
    transitions = np.log10((matrix + TOWARDS_CLASS * share) / (matrix.sum(axis=1, keepdims=True) + TOWARDS_CLASS))
    mass = tokens + ADD * (types + 1)
    class_mass = np.bincount(of_head, counts + ADD, n_classes + 2).astype(np.float64)
    # All that is neither a core word nor the end is rare, an unseen word included.
    class_mass[n_classes] = mass - class_mass.sum() + class_mass[n_classes]
    if not types:
        class_mass[n_classes] = class_mass[n_classes + 1] = mass
    return Model(vocabulary, tokens, types, head, counts, of_head, transitions, float(class_mass[n_classes]), class_mass)


_SCORED = "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, score double, n_tail long, tail array<long>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity of every document."""
    n_classes = len(model.class_mass)
    shared = docs.sparkSession.sparkContext.broadcast((model.head, model.counts, model.classes, model.transitions, model.class_mass))
    mass = model.mass

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, counts, classes, transitions, class_mass = shared.value
        base_of = np.append(np.log10((counts + ADD) / mass), 0.0)
        emit_of = np.append(np.log10((counts + ADD) / class_mass[classes]), 0.0)
        if not len(head):
            classes = np.zeros(0, np.int32)
        class_of = np.append(classes, n_classes - 2).astype(np.int64)
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            parts: list[list] = [[] for _ in range(6)]
            for _, hashes, ends in _tokens(batch):
                at = _lookup(hashes, head)
                kind = class_of[at]
                kind[ends] = n_classes - 1
                before = np.append(n_classes - 1, kind[:-1])
                total = np.cumsum(np.append(0.0, emit_of[at] + transitions[before, kind]))
                base, tail = np.cumsum(np.append(0.0, base_of[at])), np.cumsum(np.append(0, at < 0))
                starts = np.append(0, ends[:-1] + 1)
                rare = hashes[at < 0].view(np.int64)
                for column, values in zip(parts, (ends + 1 - starts, base[ends + 1] - base[starts], total[ends + 1] - total[starts],
                                                  tail[ends + 1] - tail[starts])):
                    column.append(values)
                parts[4].append(rare)
            sizes, base, total, tail = (tools.concat(parts[i], np.float64) for i in range(4))
            offsets = np.append(0, np.cumsum(tail)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([
                pa.array(row + np.arange(batch.num_rows)), batch.column("doc_id"), batch.column("held_out"), pa.array(sizes.astype(np.int64)),
                pa.array((sizes - tail).astype(np.int64)), pa.array(base), pa.array(total), pa.array(tail.astype(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(tools.concat(parts[4], np.int64)))], [f.split()[0] for f in _SCORED.split(", ")])
            row += batch.num_rows

    scored = tools.materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"),
                                           F.col("text").cast("string").alias("text")).mapInArrow(run, _SCORED), "scored")
    seen = scored.select("row", F.explode("tail").alias("h")).groupBy("row", "h").agg(F.count("*").alias("times"))
    n = F.coalesce("n", F.lit(0))
    tails = seen.join(model.vocabulary, "h", "left").groupBy("row").agg(
        F.sum(F.col("times") * F.log10((n + ADD) / mass)).alias("tail_base"), F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    rare = float(np.log10(mass / model.rare_mass))
    joined = scored.drop("tail").join(tails, "row", "left").withColumn("tail_base", F.coalesce("tail_base", F.lit(0.0)))
    # For a rare word P(word | rare) is its base chance times mass / rare_mass.
    return joined.select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base") + F.col("tail_base")).alias("base_score"),
        (F.col("score") + F.col("tail_base") + rare * F.col("n_tail")).alias("score")).withColumn(
        "perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))
