import pytest

from compare import same
from tidemark.plans.catalogue import QUERIES, SQL


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, sf_dir, name):
    same(QUERIES[name](spark, sf_dir), sf_dir, SQL[name])


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


def test_plans_keep_filters_early(spark, sf_dir):
    plan = QUERIES["snapshot_lineitem"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    read = plan[plan.index("ReadSchema") :]
    assert "l_tax" not in read and "l_shipdate" not in read
    assert "Exchange" not in plan


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


def test_log_side_is_never_moved_for_small_tables(spark, sf_dir):
    """Specs and offsets are joined by broadcasting their side; the path from log to events adds no shuffle to the log's own two."""
    plan = QUERIES["log_offset_filter"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BuildLeft" not in plan and plan.count(" Exchange") == 2


def test_local_frame(spark):
    from tidemark.spec import local_frame

    rows = [("it's \\ here", 1, True), (None, None, None)]
    assert [tuple(r) for r in local_frame(spark, rows, "a string, b bigint, c boolean").collect()] == rows
    assert local_frame(spark, [], "a string, b bigint").count() == 0
