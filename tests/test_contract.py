import __spark_entry__ as contract
from terrafold.plans.oracles import ORACLES
from terrafold.plans.queries import QUERIES


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry_runs(spark):
    df = contract.entry(spark)
    assert df.columns == ["fid", "hilbert_key"] and df.count() > 0


def test_entry_scans_two_columns(spark, sf):
    df = contract.queries()["hilbert_order"](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReadSchema: struct<event_id:bigint,user_id:bigint>") == 2
    # The total extent is a subquery, not a join.
    assert "Join" not in plan and "CartesianProduct" not in plan


def test_no_query_joins_without_a_key(spark, sf):
    for name in ("track_wkt", "hilbert_position", "asset_diff", "ring_assembly", "table_equality"):
        plan = contract.queries()[name](spark, sf)._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan, name
