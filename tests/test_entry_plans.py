"""Driver contract, plans (broadcast, pushdown, no Python), and every query
against its DuckDB oracle on the smallest scale."""

import math
import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__)))
from conftest import SF001  # noqa: E402

import __spark_entry__ as entry_mod  # noqa: E402
from oracle_check import digest, duck  # noqa: E402


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["intersection", "latitude", "longitude", "unique_sign_count", "raw_sign_count"]


def test_every_query_has_sql_or_is_rows_only():
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())
    rows_only = set(entry_mod.QUERIES) - set(entry_mod.ORACLE)
    assert rows_only == {"training_log", "score_bags", "fit_head_metrics", "compare_models",
                         "compare_baselines", "sign_bags_to_errors"}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_lookup_join_is_broadcast_and_scan_pruned(spark):
    from waymark.plans.pipeline import attached_df
    plan = _plan(attached_df(spark, SF001))
    assert "BroadcastHashJoin" in plan
    assert "Python" not in plan
    ln = [line for line in plan.splitlines() if "lineitem" in line and "ReadSchema" in line][0]
    assert "l_quantity" not in ln and "l_orderkey" in ln


def test_filter_reaches_the_scan(spark):
    from waymark.operators.cities import cities_in_country
    from waymark.sources.tables import table
    sup = table(spark, SF001, "supplier").where("s_nationkey = 3")
    assert "PushedFilters: [IsNotNull(s_nationkey), EqualTo(s_nationkey,3)]" in _plan(sup)


def test_top_k_is_limited_before_shuffle(spark):
    from waymark.operators.bags import street_signs_topk
    from waymark.plans.pipeline import raw_signs_df
    from waymark.plans.fixtures import SIGN_ORDER
    plan = _plan(street_signs_topk(raw_signs_df(spark, SF001), 8, SIGN_ORDER))
    assert "WindowGroupLimit" in plan


NAMES = sorted(entry_mod.ORACLE)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_sf0001(spark, name):
    df = entry_mod.queries()[name](spark, SF001)
    rows = [tuple(r) for r in df.collect()]
    rel = duck(SF001).sql(entry_mod.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    drows = rel.fetchall()
    assert len(rows) == len(drows)
    assert digest(df.columns, rows)[0] == digest(rel.columns, drows)[0]
