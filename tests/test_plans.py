"""Shapes of the physical plans."""

from panelwright.operators import metrics, profile, temporal
from panelwright.plans.panel import FEATURES, order_panel, scored_panel
from panelwright.plans.catalog import CATALOG
from panelwright.plans.registry import table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_windows_share_one_sort(spark, sf):
    base = order_panel(spark, sf)
    df = temporal.rolling_features(base, "entity", "period", FEATURES, 3, 1, temporal.AGGREGATIONS, bounded_entities=True)
    text = plan(df)
    assert text.count("Window ") <= 2                       # row frame and lag share one sort
    assert "Python" not in text
    assert text.count("Exchange hashpartitioning(entity") <= plan(base).count("Exchange hashpartitioning(entity") + 1


def test_filters_and_columns_reach_the_scan(spark, sf):
    text = plan(CATALOG["scan_projection"].run(spark, sf))
    assert "PushedFilters: [IsNotNull(l_quantity)" in text and "GreaterThanOrEqual(l_quantity,10.0)" in text
    assert "l_comment" not in text and "l_extendedprice" not in text
    assert "o_clerk" not in plan(order_panel(spark, sf)) and "c_name" not in plan(order_panel(spark, sf))


def test_metric_plans_have_no_sort_of_rows(spark, sf):
    text = plan(metrics.confusion(scored_panel(spark, sf)))
    assert "Sort [" not in text.replace("SortAggregate", "") or "Window" not in text
    text = plan(profile.correlation_pairs(table(spark, sf, "lineitem"), ["l_quantity", "l_tax", "l_discount"]))
    assert text.count("Exchange") == 1 and "SinglePartition" in text and "Window" not in text


def test_native_queries_use_no_python(spark, sf):
    for name in ("rolling_all", "request_violations", "risk_score", "scored_bands", "label_crosstab", "period_trend", "quality_report"):
        assert "Python" not in plan(CATALOG[name].run(spark, sf)), name
