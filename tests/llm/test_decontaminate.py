import collections
import random

from leadwright.llm import decontaminate, tools
from text_fixtures import awkward, make  # noqa: F401


def grams(words):
    k = min(5, len(words))
    return collections.Counter(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if words else collections.Counter()


def brute(docs, items, least=0.75):
    """Pairs for which some window of the item's size is similar enough."""
    out = set()
    for item, text in items:
        want = (text or "").lower().split()
        size, bag = len(want), grams(want)
        k = min(5, size)
        for doc, body in docs:
            words = (body or "").lower().split()
            if not bag or not any(tuple(words[i:i + k]) in bag for i in range(len(words) - k + 1)):
                continue
            for start in range(max(1, len(words) - size + 1)):
                cut = words[start:start + size]
                have = collections.Counter(tuple(cut[i:i + k]) for i in range(len(cut) - k + 1))
                total = sum((have | bag).values())
                if total and sum((have & bag).values()) >= least * total:
                    out.add((doc, item))
                    break
    return out


def found(docs, items):
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(docs, items).collect()}


def test_given_documents(spark, small):
    docs, items = tools.documents(spark, small), tools.documents(spark, small, "benchmark")
    want = brute([(r["doc_id"], r["text"]) for r in docs.collect()], [tuple(r) for r in items.collect()])
    assert found(docs, items) == want and want


def test_altered_passages_are_found_and_clean_texts_stay(spark, make):
    rng = random.Random(2)
    text = lambda n: [f"w{rng.randrange(800)}" for _ in range(n)]
    bench = [(i, text(rng.choice([3, 20, 40, 60]))) for i in range(40)]
    rows = []
    for d in range(150):
        words = text(rng.randrange(5, 200))
        if d % 3 == 0:
            passage = list(rng.choice(bench)[1])
            for _ in range(rng.randrange(0, 3)):  # change or drop a word
                at = rng.randrange(len(passage))
                passage[at:at + 1] = rng.choice([[], ["z"]])
            at = rng.randrange(len(words))
            words[at:at] = passage
        rows.append((d, " ".join(words)))
    items = spark.createDataFrame([(i, " ".join(w)) for i, w in bench], "item_id long, text string")
    want, got = brute(rows, [(i, " ".join(w)) for i, w in bench]), found(make(rows), items)
    assert got <= want
    # Where words are dropped the best window can lie between the proposed ones; all others are found.
    assert len(got) >= 0.97 * len(want)
    clean = {r["doc_id"] for r in decontaminate.clean_documents(make(rows), items).collect()}
    assert clean == {d for d, _ in rows} - {d for d, _ in got}


def test_repeats_weigh(spark, make):
    items = spark.createDataFrame([(1, "a b c d e a b c d e a b c d e f g")], "item_id long, text string")
    rows = [(1, "x a b c d e a b c d e a b c d e f g y"), (2, "a b c d e f g"), (3, "a a a a a a a a a a a a a a a a a")]
    assert found(make(rows), items) == {(1, 1)}


def test_all_pairs_within_the_radius_share_a_block():
    rng = random.Random(4)
    for _ in range(300):
        sign = rng.getrandbits(64)
        other = sign
        for bit in rng.sample(range(64), decontaminate.RADIUS):
            other ^= 1 << bit
        assert any(((sign ^ other) >> 8 * b & 255).bit_count() <= decontaminate.NEAR_BITS for b in range(8))


def test_awkward_rows_and_clashing_columns(spark, make, awkward):
    same = awkward[4][1]
    items = spark.createDataFrame([(1, None), (2, ""), (3, same), (3, same), (4, "short"), (None, same)], "item_id long, text string")
    for rows in (awkward, []):
        docs = make(rows, clash=True)
        want = brute([(r[0], r[1]) for r in rows], [(1, None), (2, ""), (3, same), (4, "short"), (None, same)])
        assert found(docs, items) == want
        assert decontaminate.clean_documents(docs, items).columns == docs.columns
    assert found(make(awkward), items.limit(0)) == set()
    # Joined by shuffle when the item side is not small.
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.matches(make(awkward), items, broadcast_rows=0).collect()} == found(make(awkward), items)
