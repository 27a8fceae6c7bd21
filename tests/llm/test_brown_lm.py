import collections
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from leadwright.llm import brown_lm, tools
from text_fixtures import awkward, make  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), None]


def out(doc):
    return doc is not None and zlib.crc32(str(doc).encode()) % 10 == 0


def base(rows):
    """n_tokens, n_known, N and base score per row."""
    counts = collections.Counter(t for doc, text in rows if not out(doc) for t in tokens(text))
    n, v = sum(counts.values()), len(counts)
    return [(doc, out(doc), len(tokens(text)), sum(counts[t] > 0 for t in tokens(text)), n,
             sum(math.log10((counts[t] + 0.1) / (n + 0.1 * (v + 1))) for t in tokens(text))) for doc, text in rows]


def scored(docs):
    return brown_lm.score(docs, brown_lm.fit(docs.filter(~brown_lm.held_out(F.col("doc_id"))))).collect()


def same(got, want):
    key = lambda r: tuple(str(x) for x in r[:5]) + (round(r[5], 3),)
    got = sorted(((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in got), key=key)
    want = sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in got], [r[5] for r in want], rtol=1e-9, atol=1e-6)


@pytest.mark.parametrize("head", [brown_lm.HEAD_SHARE, 1e-3])
def test_base_and_gain_on_given_documents(spark, monkeypatch, head):
    """Also with most words left to the join."""
    monkeypatch.setattr(brown_lm, "HEAD_SHARE", head)
    monkeypatch.setattr(brown_lm, "CORE_SHARE", max(head, brown_lm.CORE_SHARE))
    docs = tools.documents(spark, "/root/testdata/sf0.01")
    got = scored(docs)
    same(got, base([(r["doc_id"], r["text"]) for r in docs.collect()]))
    held = [r for r in got if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_chances_sum_to_one(make):
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 23}" for j in range(1 + i % 9))) for i in range(80)]
    model = brown_lm.fit(make(rows), n_classes=4)
    assert np.allclose((10 ** model.transitions).sum(axis=1), 1)
    # Emissions: all words of a class, the unseen word with the rare ones.
    total = np.bincount(model.classes, (model.counts + 0.1) / model.class_mass[model.classes], 6)
    assert np.allclose(total[[c for c in range(6) if c in model.classes and c != 4]], 1)
    assert math.isclose(model.class_mass.sum(), model.mass)


def test_exchange_finds_the_languages(make):
    """Words of two vocabularies that never meet end in different classes."""
    rng = np.random.default_rng(1)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{rng.integers(30)}" for _ in range(40))) for i in range(300)]
    docs = make(rows)
    pairs_core = brown_lm.fit(docs, n_classes=6)
    of = {}
    data, bounds = tools.doc_texts(__import__("pyarrow").array([f"{c}{j}" for c in "ab" for j in range(30)]))
    hashes = tools.word_hashes(data, bounds)[0]
    for h, word in zip(hashes, [f"{c}{j}" for c in "ab" for j in range(30)]):
        of.setdefault(word[0], set()).add(int(pairs_core.classes[np.searchsorted(pairs_core.head, h)]))
    assert not of["a"] & of["b"]


def test_awkward_rows_and_clashing_columns(make, awkward):
    rows = [(r[0], r[1]) for r in awkward] + [(i, f"some words w{i % 5} here") for i in range(20, 60)]
    same(scored(make(rows, clash=True)), base(rows))
    assert scored(make([])) == []
    only = [(d, "a b") for d in range(200) if out(d)]  # nothing to learn from
    got = scored(make(only))
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and math.isfinite(r["score"]) for r in got)
