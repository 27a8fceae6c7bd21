import collections
import itertools
import random
import re

import pytest

from leadwright.llm import components, jaccard_join, tools
from text_fixtures import awkward, make  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(rows):
    """(doc_id, set size, smallest doc_id of the component) per row; rows are nodes."""
    sets, have = [shingles(r[1]) for r in rows], collections.defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            have[g].append(i)
    shared = collections.Counter(p for ids in have.values() for p in itertools.combinations(ids, 2))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), c in shared.items():
        if 100 * c >= 75 * (len(sets[a]) + len(sets[b]) - c):
            root[max(find(a), find(b))] = min(find(a), find(b))
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return collections.Counter((r[0], len(sets[i]), low.get(find(i))) for i, r in enumerate(rows))


def found(docs):
    return collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.near_duplicates(docs).collect())


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10 ** 6)}"
    return " ".join(words)


def test_given_documents(spark, small):
    docs = tools.documents(spark, small)
    assert found(docs) == brute([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_awkward_rows_and_clashing_columns(make, awkward):
    docs = make(awkward, clash=True)
    assert found(docs) == brute([(r[0], r[1]) for r in awkward])
    assert jaccard_join.one_per_group(docs).columns == docs.columns
    assert found(make([])) == collections.Counter()


@pytest.mark.parametrize("node_rows,hot,block", [(256, 64, 2_000_000), (4, 3, 2_000)])
def test_group_of_near_copies_chains_and_shared_passages(make, monkeypatch, node_rows, hot, block):
    """A third of the documents near copies of one, chains, and a passage in every document; also with tiny nodes and blocks."""
    for name, value in (("NODE_ROWS", node_rows), ("HOT", hot), ("BLOCK_SHINGLES", block)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(5)
    text = lambda n: [f"w{rng.randrange(3000)}" for _ in range(n)]
    passage, base = text(20), text(120)
    rows = [(i, edited(base + passage, rng, rng.choice([0, 1, 2, 3, 4, 5, 6]))) for i in range(150)]
    rows += [(1000 + i, " ".join(text(rng.randrange(3, 60)) + passage)) for i in range(200)]
    for c in range(10):  # each step drops and adds some words, so that ends are far apart
        words = text(200)
        for step in range(12):
            rows.append((2000 + 100 * c + step, " ".join(words[6 * step:6 * step + 110])))
    rng.shuffle(rows)
    want = brute(rows)
    assert found(make(rows).repartition(5)) == want
    assert len({c for _, _, c in want}) < len(rows) - 150


def test_threshold_is_exact(make):
    words = [f"w{i}" for i in range(32)]  # 28 shingles; 24 of 32 in common is exactly three quarters
    rows = [(1, " ".join(words)), (2, " ".join(words[:28] + [f"x{i}" for i in range(4)])), (3, " ".join(words[:27] + [f"y{i}" for i in range(5)]))]
    assert found(make(rows)) == brute(rows)
    assert found(make(rows))[(2, 28, 1)] == 1


def test_components(spark):
    rng = random.Random(3)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(60)]
    got = {r["key"]: r["comp"] for r in components.component_labels(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for p in links for x in p}
    for _ in range(400):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert got == {x: r for x, r in root.items() if any(x in p and p[0] != p[1] for p in links)}


def test_one_row_of_each_group_by_id_and_text(make):
    """Rows of one id and text are one; a text that shares its id with a copy stays; a null id is the last choice."""
    same, near = " ".join(f"w{i}" for i in range(60)), " ".join(f"w{i}" for i in range(59)) + " x"
    alone = [" ".join(f"{c}{i}" for i in range(40)) for c in "pqr"]
    rows = [(1, same), (1, same), (2, near), (2, alone[0]), (3, same), (None, same), (None, alone[1]), (None, alone[1]), (4, None), (4, None), (5, ""), (6, alone[2])]
    docs = make(rows)
    got = collections.Counter((r["doc_id"], r["text"]) for r in jaccard_join.one_per_group(docs).collect())
    assert got == collections.Counter([(1, same), (2, alone[0]), (None, alone[1]), (4, None), (5, ""), (6, alone[2])])
    assert jaccard_join.one_per_group(docs.limit(0)).count() == 0


def test_pairs_under_many_tops_meet_once(make, monkeypatch):
    """Near copies that are not linked with one another share many tops; the answer does not depend on how many a leaf remembers."""
    rng = random.Random(9)
    base = [f"w{rng.randrange(10 ** 6)}" for _ in range(150)]
    rows = [(i, edited(base, rng, 7)) for i in range(60)]
    want = brute(rows)
    for earlier, guides in ((8, 2), (1, 0)):
        monkeypatch.setattr(jaccard_join, "EARLIER", earlier)
        monkeypatch.setattr(jaccard_join, "GUIDES", guides)
        assert found(make(rows)) == want
