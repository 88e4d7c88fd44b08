"""Every registered query against its independent SQL on the small tables."""

import pytest

from tidemark.plans.oracle_sql import ORACLES
from tidemark.plans.queries import QUERIES
from tools.compare import compare

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, sf_dir, name):
    result = compare(spark, sf_dir, [name], verbose=False)[name]
    assert result[0] == "OK", result


def test_entry_runs(spark):
    from __spark_entry__ import entry
    df = entry(spark)
    assert "OpenToCloseChange" in df.columns
    assert df.count() > 0
