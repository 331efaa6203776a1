"""Every registered query equals its DuckDB oracle on the smallest test tables."""

import pytest

from candela.checks.compare import compare
from candela.checks.registry import oracle_sql, queries
from tests.conftest import SF_SMALL

NAMES = sorted(queries())


def test_every_query_has_an_oracle():
    assert set(oracle_sql()) == set(queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    res = compare(spark, SF_SMALL, [name], verbose=False)[name]
    assert res.startswith("OK"), res


def test_entry_smoke(spark):
    import importlib.util
    import os

    spec = importlib.util.spec_from_file_location(
        "spark_entry", os.path.join(os.path.dirname(os.path.dirname(__file__)), "__spark_entry__.py")
    )
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    df = mod.entry(spark)
    assert df.count() > 0
    assert "market_sentiment" in df.columns
