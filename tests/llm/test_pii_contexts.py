"""Strict spans against the plain expressions, learned spans against a plain bootstrapping."""

import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
import regex
from pyspark.sql import functions as F
from text_fixtures import awkward, make  # noqa: F401

from leadwright.llm import pii_contexts

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def good(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 16 <= len(digits) <= 19 and luhn(digits)
    return kind != "phone" or 8 <= len(digits) <= 15


def strict(text):
    return [(k, m.start(), m.end()) for k, p in PLAIN.items() for m in re.finditer(p, text) if good(k, m[0])]


def contexts(before, after):
    tokens = lambda s: regex.findall(r"[\p{L}\p{M}0]+|[^\s\p{L}\p{M}0]+", regex.sub(r"\p{N}+", "0", s.lower()))
    left = ["^", "^", *tokens(before[-pii_contexts.BEFORE:])][-2:]
    right = [*tokens(after[:pii_contexts.AFTER]), "^"][0]
    return [f"2: {left[0]} {left[1]}", f"1: {left[1]} _ {right}"]


def with_contexts(kind, text, shape, engine):
    """(kind, start, end, contexts) of all matches of a shape; contexts end at the matches around it."""
    found = list(engine.finditer(shape, text))
    edges = [0, *[e for m in found for e in m.span()], len(text)]
    return [(kind, m.start(), m.end(), contexts(text[edges[2 * i]:m.start()], text[m.end():edges[2 * i + 3]])) for i, m in enumerate(found)]


def plain(docs, rounds=3, support=5, least=0.7):
    seen = defaultdict(list)
    for doc in set(docs):
        text = doc[1] or ""
        base = [x for kind, shape in PLAIN.items() for x in with_contexts(kind, text, shape, re) if good(kind, text[x[1]:x[2]])]
        seen[doc] += [(*x, True) for x in base]
        for kind, shape in pii_contexts.LOOSE.items():
            seen[doc] += [(*x, False) for x in with_contexts(kind, text, shape, regex) if not any(a < x[2] and x[1] < b for _, a, b, _ in base)]
    edges, trust = defaultdict(set), {}
    for doc, places in seen.items():
        for kind, a, b, found, seed in places:
            trust[kind, doc[1][a:b]] = max(trust.get((kind, doc[1][a:b]), 0.0), float(seed))
            for c in found:
                edges[c].add((kind, doc[1][a:b]))
    seeds = {i for i, t in trust.items() if t == 1}

    def scored():
        out = {}
        for c, instances in edges.items():
            for kind in pii_contexts.KINDS:
                own = [trust[i] for i in instances if i[0] == kind]
                score = sum(own) / (sum(trust[i] for i in instances) + sum(1 - t for t in own) / 2 + 1)
                if sum(t >= 0.5 for t in own) >= support and score >= least:
                    out[c, kind] = score
        return out

    for _ in range(rounds):
        good_contexts, lent = scored(), defaultdict(lambda: 1.0)
        for (c, kind), score in good_contexts.items():
            for i in edges[c]:
                if i[0] == kind:
                    lent[i] *= 1 - score
        trust = {i: 1.0 if i in seeds else 1 - lent[i] for i in trust}
    good_contexts = scored()
    names, out = list(pii_contexts.KINDS), []
    for doc in docs:
        text = doc[1] or ""
        found = []
        for kind, a, b, where, seed in seen[doc]:
            scores = [good_contexts[c, kind] for c in where if (c, kind) in good_contexts] if not seed else []
            if scores:
                found.append((-max(scores), names.index(kind), a, b))
        kept = []
        for _, kind, a, b in sorted(set(found)):
            if not any(x < b and a < y for _, x, y in kept):
                kept.append((kind, a, b))
        base = [(names.index(k), a, b) for k, a, b in strict(text)]
        write = lambda spans: ",".join(f"{names[k]}:{a}:{b}" for k, a, b in sorted(spans))
        out.append((doc[0], *[sum(k == i for k, _, _ in base) for i in range(4)], hashlib.sha256(write(base).encode()).hexdigest(), write(base + kept)))
    return sorted(out, key=str)


def found(df, **options):
    return sorted((tuple(r) for r in pii_contexts.span_facts(df, **options).collect()), key=str)


STRANGE = [
    "a@b.c.%d@e.f x@y @z. p@q.r@s.t.u é@b.com a..@b-.c-d", "1.2.3.4.5.6.7.8 256.1.1.1 001.002.000255.4 1.2.3 9.9.9.9. 0.0.0.0",
    "4111111111111111 4111-1111-1111-1111 4111 1111 1111 1111 2 41111111111111112 1  2 4111--111111111111",
    "+1 (988) 555-2485 +1 2 +49-(0)30/123 +1234567 +12345678 +1 234 567 890 123 456 78 ++1 555 555 5555 +1",
    "+1 4111111111111111 mail a@1.2.3.4 😀 x@y.zz 😀😀 10.0.0.1 \x00 ١٢٣٤٥٦٧٨ ١.١.١.١",
    "john (at) example (dot) com call (988) 555-2485 or 988.555.2485; fe80::1:2 12:30:45 300.1.1.1 4111 1111 1111 1112",
]


def planted(n, seed):
    """Numbers in fixed phrases: some in strict shapes, some in loose ones; and the same loose shapes in other places."""
    rng, docs = random.Random(seed), []
    number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    for i in range(n):
        loose, say = f"({number(3)}) 555-{number(4)}", rng.choice(["call me at", "my phone is", "phone :"])
        text = f"word{rng.randint(0, 50)} {say} +1 {loose} now. " if i % 3 else f"{say} {loose} now, "
        text += rng.choice(["order 12345678 came", f"invoice {number(9)} of", f"server 10.{i % 200}.0.{i % 9} up", f"server {300 + i % 90}.1.2.3 up",
                            f"write to u{i}@mail.com today", f"write to u{i} (at) mail.com today", f"total {number(7)} now"])
        docs.append((i, text))
    return docs


def test_strict_shapes_on_strange_texts(make):  # noqa: F811
    docs = [*enumerate(STRANGE), (90, "".join(STRANGE)), (91, "\n".join(STRANGE * 3)), (92, "9" * 19), (93, "4" + "1 " * 400), (94, "x a@b.c, " * 300)]
    assert found(make(docs)) == plain(docs)


def test_random_texts(make):  # noqa: F811
    rng = random.Random(5)
    docs = [(i, "".join(rng.choice("01 925.@+-()ab%:é😀\n") for _ in range(rng.randint(0, 120)))) for i in range(400)]
    assert found(make(docs)) == plain(docs)


@pytest.mark.parametrize("options", [{}, {"rounds": 1, "min_support": 3, "min_score": 0.5}])
def test_learned_contexts_against_plain_bootstrapping(make, options):  # noqa: F811
    docs = planted(150, 3)
    docs += docs[:7]
    names = {"rounds": "rounds", "min_support": "support", "min_score": "least"}
    want = plain(docs, **{names[k]: v for k, v in options.items()})
    assert found(make(docs), **options) == want
    learned = [r for r in want if r[-1].count("phone") > r[4]]
    assert len(learned) >= 30  # numbers without a plus sign are found by what stands before them


def test_numbers_in_other_places_stay(make):  # noqa: F811
    got = {r[0]: r[-1] for r in found(make(planted(150, 3)))}
    for i, text in planted(150, 3):
        for m in re.finditer(r"order 12345678|invoice [0-9]{9}|total [0-9]{7}", text):
            spans = [s.split(":") for s in got[i].split(",") if s]
            assert not any(int(a) < m.end() and m.start() < int(b) for _, a, b in spans)


def test_awkward_rows(make, awkward):  # noqa: F811
    docs = [r[:2] for r in awkward] + [(50, "mail a@b.com " * 300), (50, "mail a@b.com " * 300), (None, "call +1 (988) 555-2485")]
    assert found(make(docs)) == plain(docs)
    assert found(make(docs, clash=True).withColumns({c: F.lit(1) for c in ("base", "seen", "kind", "context", "trust", "h", "strict0")})) == plain(docs)
    assert found(make([])) == []


def test_long_runs_and_many_matches_stay_cheap(make):  # noqa: F811
    docs = [(1, "a" * 200_000), (2, "1" * 200_000), (3, "1.1.1.1 " * 5_000), (4, "+1" + " 1" * 50_000), (5, "a.b@c" + ".d" * 50_000),
            (6, "é" * 100_000 + "@"), (7, "call +1 (988) 555-2485 or (988) 555-2485, " * 2_000)]
    counts = {r[0]: r[1:5] for r in found(make(docs))}
    assert counts == {1: (0, 0, 0, 0), 2: (0, 0, 0, 0), 3: (0, 5_000, 0, 0), 4: (0, 0, 0, 0), 5: (1, 0, 0, 0), 6: (0, 0, 0, 0), 7: (0, 0, 0, 2_000)}


def test_trust_is_never_certain_without_a_seed(spark):
    seen = spark.createDataFrame([(3, f"v{i}", i < 6, ["c"]) for i in range(8)], "kind int, value string, seed boolean, contexts array<string>")
    (row,) = pii_contexts.trusted_contexts(seen, min_score=0.5).collect()
    lent = 6 / (6 + 2 / 2 + 1)
    for _ in range(2):
        known = 6 + 2 * lent
        lent = known / (known + 2 * (1 - lent) / 2 + 1)
    known = 6 + 2 * lent
    assert math.isclose(row["score"], known / (known + 2 * (1 - lent) / 2 + 1))
