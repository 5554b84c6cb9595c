"""Plan-shape guard for every registered query (except those that train a
model): no cartesian product, no row-at-a-time Python UDF, no sort-based
aggregate, no nested-loop join. Jobs that run while a query is built (written
tables, checkpoints, scalars) are recorded and held to the first two."""

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql.classic.dataframe import DataFrame

from conftest import SF_SMOKE
from provisio.queries import queries

TRAINED = ("m4_", "m5_", "m11_", "m13_shapley_gbt", "j2_", "m7_auc_trained", "m8_confusion_trained", "m9_report_trained",
           "flow_", "r7_factor_table_trees", "r9_memo_trees", "r16_chart_trees", "e7_backtest_report", "e7_rolling_backtest", "e11_model_vote")
KEYS = sorted(k for k in queries() if not k.startswith(TRAINED))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def built(monkeypatch):
    """Plans of the frames that are run while a query is built."""
    plans = []

    def record(owner, name, frame):
        original = getattr(owner, name)

        def run(self, *args, **kwargs):
            plans.append(plan_of(frame(self)))
            return original(self, *args, **kwargs)

        monkeypatch.setattr(owner, name, run)

    for name in ("collect", "count", "first", "checkpoint"):
        record(DataFrame, name, lambda df: df)
    record(DataFrameWriter, "parquet", lambda writer: writer._df)
    return plans


@pytest.mark.parametrize("key", KEYS)
def test_plan_shape(spark, key, built):
    plan = plan_of(queries()[key](spark, SF_SMOKE))
    for banned in ("CartesianProduct", "BatchEvalPython", "SortAggregate", "BroadcastNestedLoopJoin"):
        assert banned not in plan, f"{key}: {banned}"
    for early in built:
        for banned in ("CartesianProduct", "BatchEvalPython"):
            assert banned not in early, f"{key} while it is built: {banned}"


def test_median_and_split_read_their_input_once_or_twice(spark, built):
    """The slim columns of the medians and of the split are written once; no
    later job goes back to the source tables but the split's flag of the wide rows."""
    from provisio.operators import clean
    from provisio.plans import book_b

    clean.loader_a(book_b.landing(spark, SF_SMOKE))
    assert sum("orders.parquet" in p for p in built) == 1


def test_market_window_reaches_the_scan(spark):
    from provisio.plans import market

    plan = plan_of(market.prices(spark, SF_SMOKE, months=1))
    scans = [line for line in plan.split("\n") if "events.parquet" in line and "value#" in line]
    assert len(scans) == 1 and "GreaterThanOrEqual(ts" in scans[0]
