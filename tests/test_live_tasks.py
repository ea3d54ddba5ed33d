"""The state of a live table is updated by many tasks."""

from tonegauge.plans import streams
from tonegauge.sources import storage


def test_monthly_state_is_not_updated_by_one_task(spark, folder, monkeypatch):
    plans, real = [], storage.replace_table

    def replace(df, *args):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        real(df, *args)

    monkeypatch.setattr(storage, "replace_table", replace)
    assert streams.r4_live_monthly(spark, folder).count() > 0
    assert plans and all("Repartition 1, true" in p and "Repartition 1, false" not in p for p in plans)
