import collections

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from compare import duck, duck_rows, spark_rows
from leadwright.llm import tools
from leadwright.llm.queries import ORACLES, QUERIES
from test_decontaminate import brute as leaks
from test_jaccard_join import brute as components
from test_line_dedup import brute as shortened
from test_packing import check
from test_quality_rules import brute as verdicts, left
from text_fixtures import awkward, make  # noqa: F401


def test_stages_against_brute_force(spark, small):
    from leadwright.llm import packing, quality_rules

    docs = tools.documents(spark, small)
    items = [tuple(r) for r in tools.documents(spark, small, "benchmark").collect()]
    given = docs
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"], r["source"]) for r in given.collect()]
        texts = [(d, t) for d, t, _ in before]
        result = tools.materialise(stage(spark, given, small), "stage")
        if name == "best-fit packing":
            check(result.collect(), texts, packing.WordIds(packing.tokenizer_path()).tokenizer)
            break
        assert result.columns == docs.columns and dict(result.dtypes) == dict(docs.dtypes)
        got = {r["doc_id"]: r["text"] for r in result.collect()}
        if name == "quality rules":
            judged = verdicts(before, quality_rules.MIN_DOCS, quality_rules.MAX_SHARE, quality_rules.MIN_LEFT)
            want = {r[0]: t for r, t, v in zip(before, left(before), judged) if v[-1]}
        elif name == "line dedup":
            want = {d: t for (d, t, n) in shortened(texts) if t or not n}
        elif name == "near duplicates":
            keep = {d for d, _, c in components(texts) if d == c}
            want = {d: t for d, t in texts if d in keep}
        else:
            dirty = {d for d, _ in leaks(texts, items)}
            want = {d: t for d, t in texts if d not in dirty}
        assert got == want, name
        given = result
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "line dedup", "near duplicates", "benchmark decontamination", "best-fit packing"]


def test_run_gives_the_last_stage(spark, small):
    rows = corpus_pipeline.run(spark, small).collect()
    assert rows and max(collections.Counter((r["doc_id"], r["piece"]) for r in rows).values()) == 1


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, small, name):
    assert spark_rows(QUERIES[name](spark, small)) == duck_rows(duck(small), ORACLES[name])


def test_stages_survive_nulls_and_empty_tables(spark, small, make, awkward):
    for rows in (awkward, []):
        docs = make(rows, clash=True)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, small)
            assert name == "best-fit packing" or out.columns == docs.columns
            assert out.count() >= 0


def test_entry_registers_the_text_queries():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
