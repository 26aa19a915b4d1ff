"""Every registered query with a DuckDB text must give exactly its rows."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle.registry import ORACLES
from plantline.registry import QUERIES
from tests.compare import differences, open_duck

FOLDER = "/root/testdata/sf0.001"
MODEL_KEYS = {"risk_supplier_model", "risk_stockout_model", "eval_report"}


@pytest.fixture(scope="module")
def duck():
    return open_duck(FOLDER)


def test_only_model_queries_lack_a_text():
    assert set(QUERIES) - set(ORACLES) == MODEL_KEYS
    assert set(ORACLES) <= set(QUERIES) <= set(queries())
    assert set(oracle_sql()) <= set(queries())


def test_entry_has_rows(spark):
    assert entry(spark).count() == 10


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_matches_oracle(spark, duck, key):
    got = queries()[key](spark, FOLDER).toPandas()
    assert differences(got, duck.execute(oracle_sql()[key]).df()) == []
