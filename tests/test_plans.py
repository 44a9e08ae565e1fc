"""Plan-shape checks: the physical plans we rely on for scale."""

import contextlib
import io

import pytest

import __spark_entry__ as E
from oracle import SMALL
from rxlake.operators import series
from rxlake.sources import adapters
from rxlake.sources.tables import Tables

NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1",
                "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


@pytest.fixture()
def cluster_shape(spark):
    """Disable size-based broadcasts to see the large-data plan shape."""
    old = {k: spark.conf.get(k) for k in NO_BROADCAST}
    for k, v in NO_BROADCAST.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def test_case_dedup_rides_the_orderkey_join(cluster_shape):
    p = plan(E.queries()["a6_dedup_adverse_events"](cluster_shape, SMALL))
    assert "SortAggregate" in p and "SortMergeJoin" in p
    # the dedup groups on the lineage keys without an exchange of its own
    assert "Exchange hashpartitioning(src_orderkey" not in p


def test_trial_counts_are_broadcast_after_size_check(cluster_shape):
    p = plan(E.queries()["j1_curated_adverse_events"](cluster_shape, SMALL))
    assert "BroadcastHashJoin LeftOuter" in p


def test_filters_and_columns_reach_the_scan(spark):
    rows = adapters.shipment_units(Tables(spark, SMALL))
    assert "LessThan(l_shipdate" in plan(series.monthly_units(rows, complete_through="1998-08-01"))
    p = plan(E.queries()["a5_monthly_units"](spark, SMALL))
    assert "LessThan(l_shipdate" not in p  # no date cut of its own: all months are summed
    scan = [ln for ln in p.splitlines() if ln.startswith("ReadSchema: struct<l_")][0]
    fields = scan.split("struct<", 1)[1].rstrip(">").split(",")
    assert [f.split(":")[0] for f in fields] == ["l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


@pytest.mark.parametrize("name", [n for n in sorted(E.queries()) if n[:2] not in ("m5", "m7", "a9", "d4")
                                  and n not in ("a10_classification_report", "x1_daily_audit")])
def test_no_python_or_cartesian_operators(spark, name):
    p = plan(E.queries()[name](spark, SMALL))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p, f"{name}: {bad}"
