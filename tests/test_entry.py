import pytest

import __spark_entry__ as driver

CHEAP = (
    "event_summary", "log_counters", "result_diff", "validate_text", "validation_errors", "window_features",
    "incidents", "incident_causes", "clean_sales", "sales_pivot", "lookup_join", "chi_square", "pr_curve", "etl_summary",
)


def test_registered_queries_and_twins():
    queries, twins = driver.queries(), driver.oracle_sql()
    assert set(twins) <= set(queries)
    assert len(queries) > 90 and len(set(queries) - set(twins)) <= 10


def test_flagship(spark):
    assert "excess_errors" in driver.entry(spark).columns


@pytest.mark.parametrize("name", CHEAP)
def test_query_equals_its_sql_twin(spark, sf, name):
    from tools.check_queries import compare

    assert compare(spark, name, sf).startswith("ok"), name


def test_bench_holds_the_longest_queries():
    import bench

    assert {"churn_grid", "churn_oof"} <= set(bench.HEADLINE) <= set(driver.queries())
