"""Chunks against a plain definition of them, and against all windows of lines."""

import collections
import random
import zlib

import pytest

from leadwright.llm import line_dedup, queries, tools
from text_fixtures import awkward, make  # noqa: F401

BASE, PRIME = 1_000_003, (1 << 61) - 1


def marks(lines, window, spread):
    out = []
    for i in range(window - 1, len(lines)):
        h = sum((zlib.crc32(lines[i - k].encode()) + 1) * BASE ** k for k in range(window)) % PRIME
        if (h * 0x9E3779B97F4A7C15 >> 32) % spread:
            out.append(i)
    return out


def chunks(lines, window, spread, min_chars):
    """first, last, low, high of all chunks, by trying every pair of boundaries."""
    at = marks(lines, window, spread)
    able = lambda i, j: j >= i and at[j] > at[i] - window + 1 and len("\n".join(lines[at[i] - window + 1:at[j] + 1])) >= min_chars
    pairs = set()
    for i in range(len(at)):
        pairs |= {(i, j) for j in range(i, len(at)) if able(i, j) and not any(able(i, k) for k in range(i, j))}
        pairs |= {(h, i) for h in range(i + 1) if able(h, i) and not any(able(k, i) for k in range(h + 1, i + 1))}
    return [(at[i] - window + 1, at[j], at[i - 1] + 1 if i else 0, at[j + 1] - window if j + 1 < len(at) else len(lines) - 1) for i, j in sorted(pairs)]


def grown(lines, place, before, after):
    first, last, low, high = place
    while before and first > low and lines[first - 1] == before[-1]:
        first, before = first - 1, before[:-1]
    while after and last < high and lines[last + 1] == after[0]:
        last, after = last + 1, after[1:]
    return first, last


def brute(rows, window=line_dedup.WINDOW, spread=line_dedup.SPREAD, min_chars=line_dedup.MIN_CHARS):
    found = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        found.append((doc, text, lines, [("\n".join(lines[p[0]:p[1] + 1]), p) for p in chunks(lines, window, spread, min_chars)]))
    keeper, sides = {}, collections.defaultdict(list)
    for doc, _, _, parts in found:
        for part, _ in parts if doc is not None else []:
            keeper[part] = min(keeper.get(part, doc), doc)
    for doc, _, lines, parts in found:
        for part, (first, last, low, high) in dict(reversed(parts)).items():
            if keeper.get(part) == doc and (lines[low:first] or lines[last + 1:high + 1]):
                sides[part].append((lines[low:first], lines[last + 1:high + 1]))
    out = []
    for doc, text, lines, parts in found:
        gone, seen = set(), {}
        for part, place in parts:
            own = seen.setdefault(part, place)
            if doc is not None and doc > keeper[part]:
                a, b = grown(lines, place, *min(sides[part], default=([], [])))
            elif own[1] < place[0]:
                a, b = grown(lines, place, lines[own[2]:own[0]], lines[own[1] + 1:min(own[3] + 1, place[0])])
                a = max(a, own[1] + 1)
            else:
                continue
            gone |= set(range(a, b + 1))
        out.append((doc, None if text is None else "\n".join(x for i, x in enumerate(lines) if i not in gone), len(gone)))
    return collections.Counter(out)


def all_windows(rows, min_chars=line_dedup.MIN_CHARS):
    """Lines removed where every window of two or more lines with enough characters is compared, at every place."""
    def windows(lines):
        return [(a, b, "\n".join(lines[a:b + 1])) for a in range(len(lines)) for b in range(a + 1, len(lines))
                if len("\n".join(lines[a:b + 1])) >= min_chars]

    keeper, out = {}, []
    for doc, text in rows:
        for _, _, w in windows((text or "").split("\n")):
            keeper[w] = min(keeper.get(w, doc), doc)
    for doc, text in rows:
        gone, seen = set(), {}
        for a, b, w in sorted(windows((text or "").split("\n"))):
            if seen.setdefault(w, b) < a or doc > keeper[w]:
                gone |= set(range(a, b + 1))
        out.append(len(gone))
    return out


def found(docs, **options):
    return collections.Counter((r["row"]["doc_id"], r["text"], r["n_removed"]) for r in line_dedup.dedup(docs, **options).collect())


def test_given_documents(spark, small):
    docs = tools.documents(spark, small)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    want = brute(rows)
    assert found(docs) == want
    assert sum(n for _, _, n in want) > 0
    query = collections.Counter((r["doc_id"], r["text"], r["n_removed"]) for r in queries.op3_line_dedup(spark, small).collect())
    assert query == want


@pytest.mark.parametrize("window,spread", [(1, 2), (1, 3), (2, 2), (3, 32), (1, 32)])
def test_random_texts_against_the_definition(make, window, spread):
    rng = random.Random(3)
    pool = ["", "}", "short", "a line of some length", "a rather long line that reaches the limit by itself", "x" * 19, "y" * 20, "é" * 12, "z", "w" * 30]
    rows = [(i if i % 9 else None, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for i in range(200)]
    rows += rows[:20]
    assert found(make(rows).repartition(7), window=window, spread=spread) == brute(rows, window, spread)


def test_awkward_rows_and_clashing_columns(make, awkward):
    assert found(make(awkward, clash=True)) == brute([(r[0], r[1]) for r in awkward])
    assert found(make([])) == collections.Counter()


def planted(seed):
    """Passages of 2 to 10 lines, each in two documents of other lines, at different places."""
    rng, rows, block = random.Random(seed), [], []
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 9)))
    for k in range(2, 11):
        for n in range(120):
            block.append([" ".join(word() for _ in range(rng.randint(4, 9))) for _ in range(k)])
            for d in (0, 1):
                own = [" ".join(word() for _ in range(6)) for _ in range(8)]
                rows.append((len(rows), "\n".join(own[:n % 5 + d] + block[-1] + own[n % 5 + d:])))
    return rows, block


def test_recall_of_planted_passages(make):
    rows, block = planted(7)
    left = {r["row"]["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup(make(rows)).collect()}
    whole, lines, of = collections.Counter(), collections.Counter(), collections.Counter()
    for at, passage in enumerate(block):
        assert left[2 * at] == rows[2 * at][1].split("\n")
        rest = [x for x in rows[2 * at + 1][1].split("\n") if x not in passage]
        assert [x for x in left[2 * at + 1] if x not in passage] == rest  # own lines stay
        of[len(passage)] += 1
        whole[len(passage)] += left[2 * at + 1] == rest
        lines[len(passage)] += sum(x not in left[2 * at + 1] for x in passage) / len(passage)
    print({k: (round(whole[k] / of[k], 3), round(lines[k] / of[k], 3)) for k in of})
    assert all(whole[k] >= 0.9 * of[k] and lines[k] >= 0.9 * of[k] for k in of)


def test_against_all_windows(spark, small):
    docs = tools.documents(spark, small)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["text"] is not None and r["text"].count("\n") < 60]
    ids = [r[0] for r in rows]
    got = sum(r["n_removed"] for r in line_dedup.dedup(docs.filter(docs["doc_id"].isin(ids))).collect())
    assert 0.9 * sum(all_windows(rows)) <= got <= sum(all_windows(rows))


def test_shifted_block_goes_whole_and_others_stay(make):
    block = [f"common line number {i} with some words" for i in range(30)]
    own = lambda d, n: [f"own line {d} {i} of this document" for i in range(n)]
    rows = [(d, "\n".join(own(d, d % 7) + block + own(-d - 1, 3))) for d in range(60)]
    left = {r["row"]["doc_id"]: r["text"].split("\n") for r in line_dedup.dedup(make(rows)).collect()}
    assert left[0] == rows[0][1].split("\n")
    for d in range(1, 60):
        assert left[d] == own(d, d % 7) + own(-d - 1, 3)
