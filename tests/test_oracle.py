"""Every registered query against its DuckDB oracle at sf0.01 (the driver's correctness gate)."""

import pytest

from candor.plans.registry import load_all
from core_data import SF001, SF01
from oracle_check import compare

REG = load_all()
WITH_SQL = [n for n, q in REG.items() if q.sql is not None]
ROWS_ONLY = [n for n, q in REG.items() if q.sql is None]


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_oracle(spark, name):
    assert compare(spark, name, SF01, verbose=True)


@pytest.mark.parametrize("name", WITH_SQL)
def test_matches_oracle_smallest_scale(spark, name):
    # tiny cells (one or two posts) exercise the degenerate ranges and empty groups
    assert compare(spark, name, SF001, verbose=True)


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_runs(spark, name):
    assert REG[name].run(spark, SF01).count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
    assert set(REG) <= set(e.queries())
