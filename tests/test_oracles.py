"""Every registered query against its DuckDB oracle on the sf0.001 tables (layer 1 of
SURVEY §5); queries without an oracle must at least run and keep a stable schema."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

from conftest import SMALL  # noqa: E402
from oracle_check import rows_of  # noqa: E402

import __spark_entry__ as entry  # noqa: E402
from slotcast.plans import registry  # noqa: E402

registry.load_all()
QUERIES, ORACLES = dict(registry.QUERIES), dict(registry.ORACLES)      # optional queries have their own tests


def no_cross_products(df):
    """Every query's final plan; each is run once, so the check rides on the run."""
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SMALL)
    no_cross_products(sdf)
    srows = [tuple(r) for r in sdf.collect()]
    res = duck.execute(ORACLES[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only_queries_run(spark, name):
    df = QUERIES[name](spark, SMALL)
    no_cross_products(df)
    assert df.count() > 0
    assert df.columns


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "date" in df.columns and "TOTAL_SALES" in df.columns
