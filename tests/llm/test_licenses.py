import random
import re
import textwrap

import pytest

from leadwright.llm import licenses, tools
from text_fixtures import awkward, make  # noqa: F401


def names(text):
    return [m[0] for m in licenses.apply_rules(licenses.known_sentences(text))]


def full(*ids):
    return ". ".join(licenses.SENTENCES[i][0] for i in ids) + "."


def test_every_sentence_has_a_stem_and_is_known():
    for identifier, texts in licenses.SENTENCES.items():
        for text in texts:
            assert any(s in text.lower() for s in licenses.STEMS)
            assert [x[2] for x in licenses.known_sentences(f"Some words before.\n{text}.\nAnd after.")] == [identifier]
    assert {i for _, ids in licenses.RULES for i in ids} <= set(licenses.SENTENCES)


def test_every_rule_matches_its_sentences():
    for name, ids in licenses.RULES:
        assert names(full(*ids)) == [name]


def test_wrapped_and_indented_texts():
    for width in (30, 72):
        for name, ids in licenses.RULES:
            text = "\n".join(textwrap.wrap(full(*ids), width, break_long_words=False, break_on_hyphens=False, initial_indent=" * ", subsequent_indent=" * "))
            assert names(text) == [name], (name, width)


def test_order_ties_and_others():
    assert names("Released under the MIT Licence.\nfoo\nLicensed under CC BY-NC 4.0.\nReleased under the MIT License") == ["MIT", "CC-BY-NC-4.0", "MIT"]
    assert names(full("mit-warranty")) == ["unknown"]
    assert names("This text tells of a license and of copyright.") == []
    assert names("") == []


def test_scan_finds_every_rule_at_every_width(make):
    rows, want = [], []
    for width in range(1, 100):
        for name, ids in licenses.RULES:
            margin = ("", " * ", "# ", "\t")[width % 4]
            lines = textwrap.wrap(full(*ids), width, break_long_words=False, break_on_hyphens=False)
            rows.append((len(rows), "Own words before.\n\n" + "\n".join(margin + x for x in lines)))
            want.append((len(want), name))
    assert sorted((r["doc_id"], r["license"]) for r in licenses.scan(make(rows)).collect()) == want


def plain_rules(ids):
    """The rules as one expression over the identifiers: the first listed rule wins at each place."""
    shape = re.compile("|".join("(" + re.escape(",".join(r) + ",") + ")" for _, r in licenses.RULES) + "|([^,]+,)")
    found = [(m.lastindex - 1, m[0].rstrip(",").split(",")) for m in shape.finditer("".join(f"{i}," for i in ids))]
    return [(licenses.RULES[n][0] if n < len(licenses.RULES) else "unknown", part) for n, part in found]


def test_random_sentence_sequences_against_a_plain_matcher(make):
    rng, rows, want = random.Random(11), [], []
    noise = ["This table lists copyright years.", "Some own words here.", "", "See the license file for more words."]
    for doc in range(400):
        ids, text = [], ""
        while len(ids) < 12 and rng.random() < 0.9:
            part = rng.choice(licenses.RULES)[1] if rng.random() < 0.6 else [rng.choice(sorted(licenses.SENTENCES))]
            for i in part:
                text += f"{rng.choice(noise)}\n{rng.choice(licenses.SENTENCES[i])}.\n"
                ids.append(i)
        rows.append((doc, text))
        want += [(doc, name, part) for name, part in plain_rules(ids)]
    got = sorted(((r["doc_id"], r["first_line"], r["license"], r["sentences"]) for r in licenses.scan(make(rows)).collect()))
    assert [(d, name, ids) for d, _, name, ids in got] == want


def test_line_alone_wrapped_and_in_a_bsd_header(make):
    bsd = ". ".join(licenses.SENTENCES[i][0] for i in ("bsd-grant", "bsd-source", "bsd-binary", "bsd-warranty"))
    rows = [(1, "All rights reserved."), (2, "Own words.\nAll rights\nreserved.\n"), (3, "A table is reserved."),
            (4, f"Copyright (c) 2001, Someone.\nAll rights reserved.\n\n{bsd}.")]
    got = sorted((r["doc_id"], r["license"]) for r in licenses.scan(make(rows)).collect())
    assert got == [(1, "All-rights-reserved"), (2, "All-rights-reserved"), (4, "BSD-2-Clause")]


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_given_documents(spark, folder):
    docs = tools.documents(spark, f"/root/testdata/{folder}")
    known = {"All rights reserved.": "All-rights-reserved", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
             "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0-only", "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0"}
    want = sorted((r["doc_id"], known[x], i) for r in docs.collect() for i, x in enumerate((r["text"] or "").split("\n")) if x in known)
    got = sorted((r["doc_id"], r["license"], r["first_line"]) for r in licenses.scan(docs).collect())
    assert got == want and want
    assert folder == "sf0.001" or {x[1] for x in want} == set(known.values())


def test_awkward_rows_and_clashing_columns(make, awkward):
    rows = [(r[0], None if r[1] is None else r[1] + "\nMIT License\n") for r in awkward]
    got = [r["doc_id"] for r in licenses.scan(make(rows, clash=True)).collect()]
    assert sorted(map(str, got)) == sorted(str(r[0]) for r in rows if r[1] is not None)
    assert licenses.scan(make([])).collect() == []
