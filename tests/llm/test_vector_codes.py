"""Active-entry rounds against full scans in plain integers."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from leadwright.llm import vector_codes

SHAPE = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    first = min(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(first[1])
    kept = [r for r in kept if len(r[1]) == length]
    size = -(-length // parts)
    cut = lambda v: [tuple((v + [0] * (size * parts - length))[p * size:(p + 1) * size]) for p in range(parts)]
    starts = {}
    for i, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1])):
        starts.setdefault(i, v)
    starts = [cut(v) for v in list(starts.values())[:entries]] or [cut(first[1])]
    book = [[s[p] for s in starts] for p in range(parts)]
    near = lambda part, p: min((sum((a - b) ** 2 for a, b in zip(part, c)), e) for e, c in enumerate(book[p]))
    cuts = [cut(v) for _, v, _ in kept]
    for _ in range(rounds):
        where = [[near(v[p], p)[1] for p in range(parts)] for v in cuts]
        for p in range(parts):
            for e in range(len(book[p])):
                own = [v[p] for v, w in zip(cuts, where) if w[p] == e]
                if own:
                    book[p][e] = tuple(sum(x) // len(own) for x in zip(*own))
    sha = hashlib.sha256(",".join(str(x) for p in book for c in p for x in c).encode()).hexdigest()
    out = []
    for (i, _, lab), v in zip(kept, cuts):
        found = [near(v[p], p) for p in range(parts)]
        out.append([i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), lab])
    total = {lab: sum(r[2] for r in out if r[3] == lab) for lab in {r[3] for r in out}}
    return sorted(((i, code, err, total[lab], sha) for i, code, err, lab in out), key=str)


def coded(df, **options):
    return sorted((tuple(r) for r in vector_codes.coded_vectors(df, **options).collect()), key=str)


def test_awkward_vectors_against_full_scans(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-3, 4, 16) / 4], int(i % 3) if i % 5 else None) for i in rng.integers(0, 60, 150)]
    rows += [(3, None, 1), (4, [], 1), (5, [1.0] * 15 + [None], 1), (6, [float("nan")] * 16, 1), (7, [float("inf")] * 16, 1),
             (None, [0.5] * 16, None), (8, [0.25] * 24, 2), (9, rows[0][1], 2), (9, rows[0][1], 2)]
    df = spark.createDataFrame(rows, SHAPE)
    assert coded(df) == plain(rows)
    clash = df.withColumns({c: F.lit(1) for c in ("vector", "codes", "kept", "partial", "code", "error", "of", "label_error")})
    assert coded(clash.repartition(5)) == plain(rows)


def test_few_ids_odd_lengths_and_no_ids(spark):
    rows = [(i % 3, [float(i), -float(i) / 7, 0.1 * i], i % 2) for i in range(40)]
    assert coded(spark.createDataFrame(rows, SHAPE)) == plain(rows)
    rows = [(None, [float(i % 4)] * 8, 0) for i in range(12)]
    assert coded(spark.createDataFrame(rows, SHAPE)) == plain(rows)


def test_hot_vector_and_hot_id(spark):
    rows = [(0, [0.5] * 8, 1)] * 300 + [(i, [i / 10, 0.5, 0.0, 0.0, i / 3, 0.0, 1.0, 2.0], 1) for i in range(1, 50)]
    assert coded(spark.createDataFrame(rows, SHAPE).repartition(7)) == plain(rows)


def test_empty_table(spark):
    assert coded(spark.createDataFrame([], SHAPE)) == []
    assert coded(spark.createDataFrame([(1, None, 2)], SHAPE)) == []


def test_large_components_are_clipped(spark):
    rows = [(i, [1e30 if i == 1 else -1e30] * 8, 0) for i in range(3)]
    got = coded(spark.createDataFrame(rows, SHAPE))
    assert [r[2] for r in got] == [0, 0, 0] and len({r[1] for r in got}) == 2


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6))
def test_active_entries_equal_a_full_scan(seed):
    rng = np.random.default_rng(seed)
    part, old = rng.integers(-3, 4, (40, 2)), rng.integers(-3, 4, (6, 2))
    every = np.ones(6, bool)
    codes, kept = vector_codes.assign(part, old, None, None, every)
    moved = rng.random(6) < 0.4
    new = np.where(moved[:, None], rng.integers(-3, 4, (6, 2)), old)
    got = vector_codes.assign(part, new, codes, kept, moved)
    want = vector_codes.assign(part, new, None, None, every)
    assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


@pytest.mark.parametrize("rounds", [0, 1])
def test_rounds(spark, rounds):
    rows = [(i, [float(i % 7), float(i % 5)] * 4, 0) for i in range(40)]
    assert coded(spark.createDataFrame(rows, SHAPE), rounds=rounds) == plain(rows, rounds=rounds)
