"""Every query with an oracle against DuckDB on the smallest tables."""

import datetime
import decimal
import glob
import os

import duckdb
import pytest

from quorumlake.plans.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.execute(f"create view {os.path.basename(f)[:-8]} as select * from read_parquet('{f}')")
    return c


def plain(v):
    if isinstance(v, (decimal.Decimal, float)):
        return float(f"{float(v):.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None)
    return tuple(map(plain, v)) if isinstance(v, (list, tuple)) else v


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    mine = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr)
    rel = duck.sql(ORACLES[name])
    assert sorted(rel.columns) == cols
    at = [rel.columns.index(c) for c in cols]
    theirs = sorted((tuple(plain(r[i]) for i in at) for r in rel.fetchall()), key=repr)
    assert mine == theirs


def test_plans_stay_native(spark):
    for name in ("contest_topk", "contest_winner_margin", "turnover", "block_pairs", "bbox_join", "token_df", "html_row_extract", "nearest_seed", "longest_careers"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Arrow")), name
    plan = QUERIES["contest_topk"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
    scan = QUERIES["name_search"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<p_partkey:bigint,p_name:string>" in scan


def exchanges(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_plans_shuffle_no_more_than_needed(spark):
    """Token counts are summed up before one shuffle, the nearest of few anchors needs none, spans collect no histories."""
    assert exchanges(spark, "token_df") <= 1 and exchanges(spark, "nearest_seed") == 0
    assert "collect_list" not in QUERIES["longest_careers"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "percentile" not in QUERIES["quantiles"](spark, SF)._jdf.queryExecution().executedPlan().toString()
