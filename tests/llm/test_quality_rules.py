import collections
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from leadwright.llm import quality_rules, tools
from text_fixtures import awkward, make  # noqa: F401

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    text = text or ""
    words = WORD.findall(text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    often = collections.Counter(grams)
    covered = {j for i, g in enumerate(grams) if often[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed)


def over_limit(rows, min_docs, max_share):
    """Whether a line of a host is over the limit."""
    have, texts = collections.defaultdict(set), collections.defaultdict(set)
    cut = lambda t: [x for x in (t or "").split("\n") if WORD.search(x)]
    norm = lambda x: re.sub(r"[\x20\x09-\x0D]+", " ", x).strip(" ").lower()
    for _, text, host in rows:
        for line in cut(text):
            have[host or "", norm(line)].add(text)
            texts[host or ""].add(text)
    return lambda host, x: len(have[host or "", norm(x)]) > max(min_docs, max_share * len(texts[host or ""]))


def left(rows, min_docs=quality_rules.MIN_DOCS, max_share=quality_rules.MAX_SHARE):
    """The texts without the lines over the limit."""
    over = over_limit(rows, min_docs, max_share)
    return [None if text is None else "\n".join(x for x in text.split("\n") if not (WORD.search(x) and over(host, x))) for _, text, host in rows]


def brute(rows, min_docs, max_share, min_left):
    """Verdict per row, from the definition."""
    over, out = over_limit(rows, min_docs, max_share), []
    for _, text, host in rows:
        removed = sum(len(WORD.findall(x)) for x in (text or "").split("\n") if WORD.search(x) and over(host, x))
        c = counts(text)
        out.append((*c, removed, not c[5] and not c[0] - removed < min_left * c[0]))
    return out


def found(docs, **options):
    rows = quality_rules.verdicts(docs, **options).collect()
    return collections.Counter((r["row"]["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"],
                                r["removed_words"], r["kept"]) for r in rows)


def test_given_documents(spark, small):
    docs = tools.documents(spark, small)
    rows = [(r["doc_id"], r["text"], r["source"]) for r in docs.collect()]
    want = collections.Counter((r[0], *b) for r, b in zip(rows, brute(rows, 2, 0.05, 0.5)))
    assert found(docs, min_docs=2, max_share=0.05, min_left=0.5) == want


def test_awkward_rows_and_clashing_columns(make, awkward):
    rows = [(r[0], r[1], r[2] if len(r) > 2 else "s") for r in awkward]
    want = collections.Counter((r[0], *b) for r, b in zip(rows, brute(rows, 1, 0.0, 0.9)))
    assert found(make(awkward, clash=True), min_docs=1, max_share=0.0, min_left=0.9) == want
    docs = make(awkward, clash=True)
    assert quality_rules.kept_documents(docs).columns == docs.columns
    assert found(make([])) == collections.Counter()


def test_hot_host_and_depleted_documents(make):
    body = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    banner = "subscribe to the daily letter of this site for more news"
    rows = [(i, f"{body(i)}\n{banner}", "hot" if i % 3 else f"host{i}") for i in range(300)]
    rows += [(1000 + i, f"{banner}\nx{i} y", "hot") for i in range(5)] + [(2000 + i, body(-1), "hot") for i in range(120)]
    kept = {r["doc_id"]: (r["text"], r["n_chars"]) for r in quality_rules.kept_documents(make(rows)).collect()}
    assert set(kept) == {r[0] for r in rows} - {1000 + i for i in range(5)}  # 120 copies count as one text, so they stay
    for i, text, host in rows:
        if i in kept:
            want = body(i) if host == "hot" and i < 1000 else text
            assert kept[i] == (want, len(want) if want != text else None)


def test_lines_over_the_limit_are_removed(make):
    banner, other = "subscribe to the  daily letter", "all rights of this page\tare ours"
    body = lambda i: "\n".join(" ".join(f"w{i}x{j}{c}" for c in "abcdef") for j in range(5))
    rows = [(i, f"{banner.upper()}\n\n{body(i)}\n{other}\n{banner}", "h") for i in range(20)] + [(50, f"{body(50)}\n{banner}", "other"), (50, f"{body(50)}\n{banner}", "other")]
    got = collections.Counter((r["doc_id"], r["text"]) for r in quality_rules.kept_documents(make(rows).repartition(4)).collect())
    assert got == collections.Counter((r[0], t) for r, t in zip(rows, left(rows)))
    assert got[3, "\n" + body(3)] == 1 and got[50, f"{body(50)}\n{banner}"] == 2


@settings(max_examples=15, deadline=None)
@given(texts=st.lists(st.text(alphabet="ab \n\t#é", max_size=60), min_size=1, max_size=12))
def test_counts_of_any_text(make, texts):
    rows = list(enumerate(texts))
    got = {r["row"]["doc_id"]: (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"])
           for r in quality_rules.verdicts(make(rows)).collect()}
    assert got == {i: counts(t) for i, t in rows}
