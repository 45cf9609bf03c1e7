"""The registered queries against their SQL, and the pipeline's stages."""

import inspect

import pytest

from conftest import SF_CHECK, SF_SMALL
from oracle_compare import compare, duck

import corpus_pipeline
from promoscope.llm.queries import ORACLES, QUERIES

from __spark_entry__ import oracle_sql, queries


def test_registration():
    assert set(QUERIES) <= set(queries()) and set(ORACLES) <= set(oracle_sql())
    assert "pipeline" in queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES) + ["pipeline"])
def test_query_matches_sql(spark, name):
    problems = compare(spark, duck(SF_CHECK), name, queries()[name], oracle_sql()[name], SF_CHECK)
    assert not problems, problems


def test_stages_on_awkward_rows(spark):
    text = "a clean text of some twenty words that no rule has any reason to turn away from the pipeline at all " * 1
    rows = [(1, text, "en", "s", 5, "x"), (1, text, "en", "s", 5, "x"), (None, text, None, None, None, None),
            (2, None, "en", "s", 0, "y"), (3, "", None, "s", 0, "z"), (4, "# $ % & | < >" * 30, "en", "t", 9, "q")]
    cols = "doc_id long, text string, lang string, source string, n_chars long, copies string"
    docs = spark.createDataFrame(rows, cols)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        if name != "shard":
            assert out.columns == docs.columns, name
        docs = out
    got = docs.collect()
    assert {r["doc_id"] for r in got} == {1} and {r["copies"] for r in got} == {"x"}
    empty = spark.createDataFrame([], cols)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_SMALL).collect() == []


def test_nothing_else_imports_the_subpackage():
    import promoscope.jobs
    import promoscope.plans.catalog
    for module in (promoscope.jobs, promoscope.plans.catalog):
        assert "llm" not in inspect.getsource(module)
