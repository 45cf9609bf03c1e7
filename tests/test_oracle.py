"""Every query with an oracle matches DuckDB on the whole sf0.01 tables."""

import pytest

from conftest import SF_CHECK
from oracle_compare import compare, duck

from __spark_entry__ import queries
from promoscope.plans.catalog import ORACLES

NAMES = sorted(ORACLES)


def oracle_sql():
    return ORACLES


@pytest.fixture(scope="module")
def con():
    return duck(SF_CHECK)


def test_every_oracle_has_a_query():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    problems = compare(spark, con, name, queries()[name], oracle_sql()[name], SF_CHECK)
    assert not problems, problems


def test_entry_smoke(spark):
    from __spark_entry__ import entry
    rows = entry(spark).collect()
    assert len(rows) == 100
    assert [r["rank"] for r in rows] == list(range(1, 101))


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "FLOAT": "float", "BOOLEAN": "boolean"}


def test_column_types_match_oracle(spark):
    from conftest import SF_SMALL
    con = duck(SF_SMALL)
    bad = {}
    for name, text in oracle_sql().items():
        spark_types = dict(queries()[name](spark, SF_SMALL).dtypes)
        rel = con.sql(text)
        duck_types = {c: DUCK_TO_SPARK.get(str(t), str(t)) for c, t in zip(rel.columns, rel.types)}
        if spark_types != duck_types:
            bad[name] = (spark_types, duck_types)
    assert not bad, bad
