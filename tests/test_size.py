"""Work per task and moved rows do not grow faster than the tables."""

import pytest

from checks import adapter
from checks import queries as Q
from seriesloom.plans import core, modality

D = "/root/testdata/sf0.01"


def nodes(node):
    """All operators of an executed or planned query, a reused exchange not followed."""
    found = [node]
    if node.nodeName() == "AdaptiveSparkPlan":
        found += nodes(node.executedPlan())
    elif "QueryStage" in node.nodeName():
        found += nodes(node.plan())
    elif node.nodeName() != "ReusedExchange":
        children = node.children()
        for i in range(children.size()):
            found += nodes(children.apply(i))
    return found


def exchanges(df):
    return [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.nodeName() == "Exchange"]


@pytest.fixture()
def fixed(spark):
    kept = {c: spark.conf.get(c) for c in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    for c, v in kept.items():
        spark.conf.set(c, v)


@pytest.mark.parametrize("builder, columns", [(modality.pt_index, Q.PT_COLUMNS), (modality.ct_index, Q.CT_COLUMNS)])
def test_grouping_by_series_moves_no_row_again(fixed, builder, columns):
    rows = adapter.instances(fixed, D, columns)
    assert len(exchanges(builder(rows))) == len(exchanges(rows)) == 2


def test_series_attributes_move_no_row_again_without_broadcasts(fixed):
    """Parts that are too many to be broadcast are joined before the rows are dealt by series."""
    fixed.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    rows = adapter.instances(fixed, D, Q.SERIES_COLUMNS, parts_first=True)
    attributes = core._series_attributes(rows, core.SOP_CLASS_NAMES, core.TRANSFER_SYNTAX_NAMES)
    assert len(exchanges(attributes)) == len(exchanges(rows))


def test_tasks_of_the_join_follow_the_stored_bytes(fixed, tmp_path, monkeypatch):
    d = str(tmp_path)
    lines = fixed.range(4000).selectExpr("id % 1000 as l_orderkey", "cast(id % 7 as int) as l_linenumber")
    orders = fixed.range(1000).selectExpr("id as o_orderkey", "id as o_custkey")
    lines.unionByName(lines.limit(10)).write.parquet(f"{d}/lineitem.parquet")
    orders.unionByName(orders.limit(1)).write.parquet(f"{d}/orders.parquet")
    few = adapter.lines_with_orders(fixed, d)
    assert adapter._pieces(fixed, d) == [] and few.rdd.getNumPartitions() == 8
    monkeypatch.setattr(adapter, "MANY_MB", 0)
    monkeypatch.setattr(adapter, "TASK_MB", 0.001)
    more = adapter.lines_with_orders(fixed, d)
    assert more.rdd.getNumPartitions() == adapter._pieces(fixed, d)[0] > 8
    assert sorted(map(tuple, more.collect())) == sorted(map(tuple, few.collect()))
