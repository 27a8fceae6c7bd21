"""Reversed search against a plain ranking of every document for every item."""

import math
import re
from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from text_fixtures import awkward, make  # noqa: F401

from leadwright.llm import lexical_search

ITEMS = "item_id long, text string"
TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, k=10):
    held = [(i, Counter(terms(t)), len(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(n > 0 for _, _, n in held), sum(n for _, _, n in held)
    out = []
    for item, text in {(i, t) for i, t in items}:
        scores = []
        for doc, tf, n in held:
            score = 0
            for term in terms(text):
                if tf[term]:
                    df = sum(c[term] > 0 for _, c, _ in held)
                    m = 100 - 75 + (75 * n * n_docs) // n_terms
                    score += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) * ((1000000000 * tf[term]) // (1000 * tf[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, r, doc, -s) for r, (s, _, _, doc) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def found(docs, items, **options):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in lexical_search.search(docs, items, **options).collect()), key=str)


def test_awkward_rows_against_brute_force(spark, make, awkward):  # noqa: F811
    items = [(1, "One TWO two three"), (1, "a line of the same"), (2, None), (3, ""), (4, "?!"), (5, "w17 W17 w29999"), (None, "copies and more"),
             (6, "nowhere"), (7, "Short"), (7, "Short")]
    table = spark.createDataFrame(items, ITEMS)
    want = plain([r[:2] for r in awkward], [x for x in items])
    assert found(make(awkward), table) == want
    assert found(make(awkward, clash=True), table.withColumns({c: F.lit(3) for c in ("rank", "score", "doc_id", "block", "term")})) == want
    assert found(make(awkward), table, block_bytes=12) == want  # many blocks, some of one large item
    assert found(make(awkward), table, k=2) == plain([r[:2] for r in awkward], items, 2)


def test_many_documents_and_ties_over_tasks(spark, make):  # noqa: F811
    docs = [(i % 90, f"word{i % 7} common common{i % 3} été{i % 5}") for i in range(400)]
    items = [(i, f"word{i} common été{i % 5} Été1 word{i}") for i in range(9)]
    table = spark.createDataFrame(items, ITEMS)
    assert found(make(docs).repartition(13), table) == plain(docs, items)


def test_small_steps_give_the_same(spark, make, monkeypatch):  # noqa: F811
    docs = [(i, f"a{i % 4} b{i % 3} c c{i % 2} d") for i in range(120)]
    items = [(i, f"a{i % 4} b{i % 3} c") for i in range(12)]
    monkeypatch.setattr(lexical_search, "CELLS", 40)
    assert found(make(docs), spark.createDataFrame(items, ITEMS)) == plain(docs, items)


@settings(max_examples=100, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.integers(0, 9), st.integers(0, 4)), max_size=30), min_size=1, max_size=6))
def test_heaps_keep_the_best(batches):
    import numpy as np
    heaps, every = lexical_search._Heaps(1, 3), []
    for batch in batches:
        ids, scores = np.array([b[0] for b in batch], np.int64), np.array([[b[1]] for b in batch], np.int64).reshape(-1, 1)
        heaps.push(scores, ids, np.zeros(len(ids), bool))
        every += [(-s, i) for i, s in batch if s > 0]
    assert [(-s, i) for s, i in zip(heaps.scores.tolist(), heaps.ids.tolist())] == sorted(every)[:3]


def test_empty_tables(spark, make):  # noqa: F811
    items = spark.createDataFrame([(1, "word")], ITEMS)
    assert found(make([]), items) == []
    assert found(make([(1, "word")]), items.limit(0)) == []
    assert found(make([(1, None), (2, "")]), items) == []
    assert found(make([(1, "word")]), items) == [(1, 1, 1, plain([(1, "word")], [(1, "word")])[0][3])]
