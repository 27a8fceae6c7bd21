import collections
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from leadwright.llm import packing, tools
from text_fixtures import awkward, make  # noqa: F401


def expected(rows, tokenizer, size=packing.SIZE):
    out = collections.Counter()
    for doc, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        for piece, at in enumerate(range(0, len(ids), size)):
            part = ids[at:at + size]
            out[doc, piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def check(spark_rows, rows, tokenizer, size=packing.SIZE):
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in spark_rows) == expected(rows, tokenizer, size)
    slots = collections.defaultdict(list)
    for r in spark_rows:
        slots[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in slots.values():  # gapless from 0, none beyond the size
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= size
    return len(slots)


def plain_best_fit(lengths, size):
    """Best-fit decreasing, one piece after the other."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= length]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(size - length)
    return len(rooms)


def test_given_documents(spark, small):
    docs = tools.documents(spark, small)
    found = packing.pack(docs).collect()
    words = packing.WordIds(packing.tokenizer_path())
    n = check(found, [(r["doc_id"], r["text"]) for r in docs.collect()], words.tokenizer)
    assert n <= plain_best_fit([r["length"] for r in found], packing.SIZE)


def test_awkward_rows_and_clashing_columns(make, awkward):
    words = packing.WordIds(packing.tokenizer_path())
    check(packing.pack(make(awkward, clash=True).repartition(4)).collect(), [(r[0], r[1]) for r in awkward], words.tokenizer)
    assert packing.pack(make([])).collect() == []
    check(packing.pack(make(awkward), size=7).collect(), [(r[0], r[1]) for r in awkward], words.tokenizer, 7)


def test_one_length_fills_sequences(make):
    found = packing.pack(make([(i, "a b c d") for i in range(1000)]).repartition(7), size=12).collect()
    assert len({r["sequence_id"] for r in found}) == 500


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 40), max_size=120))
def test_plan_is_best_fit_over_counts(lengths):
    rows = packing.plan_slots(dict(collections.Counter(lengths)), 40)
    placed = collections.defaultdict(list)
    for length, first, following, sequence, offset in rows:
        for r in range(first, following):
            placed[sequence + r - first].append((offset, length))
    assert sorted(x for held in placed.values() for _, x in held) == sorted(lengths)
    for held in placed.values():
        assert [o for o, _ in sorted(held)] == list(np.cumsum([0] + [x for _, x in sorted(held)])[:-1]) and sum(x for _, x in held) <= 40
    assert len(placed) <= max(plain_best_fit(lengths, 40), -(-sum(lengths) * 11 // 360) + 1)  # never beyond 11/9 of the bound


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("abzAZéßÿŒİıΣς'’.,;!?%&$#*-_<|>1² \t\n\x1c\x85́"), st.characters(codec="utf-8")), max_size=40))
def test_words_have_the_ids_of_the_tokenizer(text):
    words = test_words_have_the_ids_of_the_tokenizer.__dict__.setdefault("words", packing.WordIds(packing.tokenizer_path()))
    got = np.frombuffer(b"".join(map(words.__getitem__, text.encode().split())), "<u4").tolist()
    assert got == words.tokenizer.encode(text, add_special_tokens=False).ids


def test_words_of_a_task_stay_in_the_cache():
    """A task's worth of different words is tokenised once, not once per pass over them."""
    class Counted(packing.WordIds):
        calls = 0

        def ids(self, word):
            self.calls += 1
            return [7, 300_000]

    words = Counted(packing.tokenizer_path())
    vocabulary = [str(i).encode() for i in range(300_000)]
    for _ in range(2):
        assert {words[w] for w in vocabulary} == {bytes([7, 0, 0, 0]) + (300_000).to_bytes(4, "little")}
    assert words.calls == len(vocabulary)
