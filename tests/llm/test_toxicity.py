import math
import zlib

import numpy as np
import pytest

from leadwright.llm import tools, toxicity
from text_fixtures import awkward, make  # noqa: F401


def fold(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 3 == 1


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = tools.documents(spark, folder), tools.documents(spark, folder, "labels")
    got = {r["doc_id"]: r for r in toxicity.score(docs, toxicity.fit(docs, labels)).collect()}
    assert len(got) == docs.count() and all(r["held_out"] == fold(d) and 0 <= r["score"] <= 1 for d, r in got.items())
    assert all(r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    known = [(got[r["doc_id"]]["predicted"], r["toxic"]) for r in labels.collect() if fold(r["doc_id"])]
    assert np.mean([p for p, t in known if t == 0]) < 0.03  # of the clean held-out documents
    assert np.mean([p for p, t in known if t == 1]) > 0.5


def test_labels_of_held_out_documents_are_not_read(spark, make):
    rows = [(i, f"plain words number {i % 17} of text" + (" nasty insult" if i % 4 == 0 else "")) for i in range(300)]
    labels = [(i, 1, int(i % 4 == 0)) for i in range(300)]
    turned = [(i, 1, 1 - t if fold(i) else t) for i, _, t in labels]
    docs = make(rows, clash=True)
    got = [{r["doc_id"]: r["score"] for r in toxicity.score(docs, toxicity.fit(docs, spark.createDataFrame(x, "doc_id long, quality int, toxic int"))).collect()}
           for x in (labels, turned)]
    assert got[0] == got[1]
    assert all((s >= 0.7) == (i % 4 == 0) for i, s in got[0].items())


def test_awkward_rows(spark, make, awkward):
    labels = spark.createDataFrame([(4, 1), (5, 0), (5, 1), (None, 1), (6, None), (7, 0), (8, 0)], "doc_id long, toxic int")
    for rows in (awkward, []):
        docs = make(rows, clash=True)
        for known in (labels, labels.limit(0)):
            got = toxicity.score(docs, toxicity.fit(docs, known)).collect()
            assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)


def test_risk_never_rewards_calling_everything_toxic():
    """With few confirmed texts that can be told apart by noise, unlabelled ones of the same kind stay toxic, others clean."""
    rng = np.random.default_rng(1)
    noise = lambda: rng.choice(np.arange(10, 400), 12, replace=False).astype(np.int32)
    positive = [np.unique(np.append(noise(), 1)).astype(np.int32) for _ in range(40)]
    hidden = [np.unique(np.append(noise(), 1)).astype(np.int32) for _ in range(60)]
    clean = [noise() for _ in range(540)]
    count = lambda rows: np.bincount(np.concatenate(rows), minlength=2 ** toxicity.BITS)
    told = toxicity.telling(count(positive), count(hidden + clean), 40, 600)
    assert 1 in told and len(told) < 10
    cut = lambda rows: [r[np.isin(r, told)] for r in rows]
    weights = toxicity.train(cut(positive), cut(hidden + clean), 0.1)
    assert toxicity.margins(cut(hidden), weights).min() > toxicity.margins(cut(clean), weights).max()


def plain_training(positive, unlabelled, prior):
    """The non-negative risk and its gradient written out text by text, feature by feature."""
    weights, squares, free, free_square = {}, {}, 0.0, 1e-8
    chance = lambda z: 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))
    loss = lambda z: math.log1p(math.exp(-abs(z))) + max(z, 0)  # noqa: E731  of calling a text with margin z clean
    n, m, corrected = len(positive), len(unlabelled), []
    for _ in range(toxicity.STEPS):
        margin = lambda row: sum(weights.get(f, 0.0) for f in row) + free
        zp, zu = [margin(r) for r in positive], [margin(r) for r in unlabelled]
        corrected.append(sum(map(loss, zu)) / m - prior * sum(map(loss, zp)) / n)
        pulls = [(r, chance(z) / m) for r, z in zip(unlabelled, zu)] + [(r, -prior * chance(z) / n) for r, z in zip(positive, zp)]
        if corrected[-1] >= 0:
            pulls += [(r, -prior * chance(-z) / n) for r, z in zip(positive, zp)]
        else:
            pulls = [(r, -p) for r, p in pulls]
        step = {f: toxicity.DECAY * w for f, w in weights.items()}
        for row, pull in pulls:
            for f in row:
                step[f] = step.get(f, 0.0) + pull
        rest = sum(p for _, p in pulls) + toxicity.DECAY * free
        for f, s in step.items():
            squares[f] = squares.get(f, 1e-8) + s * s
            weights[f] = weights.get(f, 0.0) - toxicity.RATE * s / math.sqrt(squares[f])
        free_square += rest * rest
        free -= toxicity.RATE * rest / math.sqrt(free_square)
    return weights, free, corrected


@pytest.mark.parametrize("prior", [0.1, 0.4, 0.9])
def test_training_against_the_written_out_risk(prior):
    rng = np.random.default_rng(int(10 * prior))
    texts = lambda n, low, high: [np.unique(rng.integers(low, high, 5)).astype(np.int32) for _ in range(n)]
    positive, unlabelled = texts(12, 0, 8), texts(20, 4, 20) + texts(4, 0, 8) + [np.zeros(0, np.int32)]
    weights, free, corrected = plain_training([r.tolist() for r in positive], [r.tolist() for r in unlabelled], prior)
    got = toxicity.train(positive, unlabelled, prior)
    assert np.allclose(got[-1], free, rtol=1e-6, atol=1e-9)
    assert np.allclose([got[f] for f in weights], list(weights.values()), rtol=1e-6, atol=1e-9)
    assert not np.delete(got, [*weights, len(got) - 1]).any()
    assert prior < 0.9 or min(corrected) < 0  # the correction has been at work
