"""Checked queries agree with DuckDB at the smallest scale and have plans without cross products.

By default the headline queries of the bench and the streaming, feed and terrain
queries run; TIDELINE_ALL=1 runs every checked query (about seven minutes).
"""
import os

import pytest

import __spark_entry__ as entry
from compare import check, duck
from tideline.plans.catalog import everything

CHECKS = entry.oracle_sql()
QUERIES = entry.queries()
if os.environ.get("TIDELINE_ALL") == "1":
    CHOSEN = sorted(set(CHECKS) & set(everything().queries))
else:
    from bench import HEADLINE
    CHOSEN = sorted({n for n in CHECKS if n[0] in "SXUG"} | (set(HEADLINE) & set(CHECKS)))


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_names_and_coverage():
    assert set(CHECKS) <= set(QUERIES) and len(CHECKS) >= 150


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "is_flood" in df.columns


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, con, small, name):
    plans = []

    def watched(s, d):
        df = QUERIES[name](s, d)
        plans.append(df)
        return df

    state, note, _ = check(spark, con, small, name, watched, CHECKS[name])
    assert state == "ok", note
    plan = plans[0]._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
