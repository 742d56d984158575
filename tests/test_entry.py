import __spark_entry__ as entry
from partflow.plans import queries as plans

SF = "/root/testdata/sf0.001"


def test_every_oracle_belongs_to_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship_runs(spark):
    assert entry.entry(spark).count() > 0


def test_batch_plans_stay_on_the_jvm(spark):
    for name in ("aog_risk", "supplier_scorecard", "part_master", "demand_features", "blocked_work_orders"):
        plan = plans.queries()[name](spark, SF)._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan, name
