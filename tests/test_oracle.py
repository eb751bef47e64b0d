"""Every registered query against its DuckDB oracle on the small tables
(brute force over the whole sf0.001 tables)."""
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(ROOT, "scripts"))

import __spark_entry__ as E  # noqa: E402
from docrank.plans.catalog import QUERIES  # noqa: E402
from docrank.plans.oracle import oracle_sql  # noqa: E402
from check_oracle import compare, duck_connection  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck_connection(SF)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(oracle_sql())
    assert set(QUERIES) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, con, name):
    r = compare(spark, con, name, SF)
    assert r["match"], r


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["doc_id", "score"]
    assert len(df.collect()) == 5
