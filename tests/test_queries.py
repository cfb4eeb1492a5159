"""Registered queries against DuckDB at the smallest scale. ``FITMESH_ALL_QUERIES=1`` runs every one."""

import importlib.util
import os

import pandas as pd
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
FEW = ["ols_repeated_cv", "align_by_position", "robust_scaling", "quantile_transform", "feature_engineering", "ordered_rank", "keep_inliers",
       "gradient_boosting_two_rounds", "linear_stack"]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="benchmark tables not present")


def entry_module():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    return module


ENTRY = entry_module()


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(ENTRY.oracle_sql()) if os.environ.get("FITMESH_ALL_QUERIES") else FEW)
def test_query_matches_sql(spark, duck, name):
    got = ENTRY.queries()[name](spark, DATA).toPandas()
    want = duck.sql(ENTRY.oracle_sql()[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    frames = [f[columns].sort_values(columns).reset_index(drop=True) for f in (got, want)]
    pd.testing.assert_frame_equal(*frames, check_dtype=False, rtol=1e-9, atol=1e-9)


def test_every_oracle_has_a_query():
    assert set(ENTRY.oracle_sql()) <= set(ENTRY.queries())
    assert ENTRY.FLAGSHIP in ENTRY.oracle_sql()


def test_flagship_uses_no_row_shuffle(spark):
    """The scoring plan exchanges partial aggregates only."""
    plan = ENTRY.queries()["ols_repeated_cv"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 2  # fold scores, then their summary
