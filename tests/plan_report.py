"""Write PLANS.md: physical plan trees of the headline queries in the
cluster shape (size-based broadcasts off), from explain("formatted").

    python tests/plan_report.py [sf_dir] > PLANS.md
"""

import contextlib
import io
import re
import sys

sys.path.insert(0, ".")

import __spark_entry__ as E  # noqa: E402
from rxlake.session import get_spark  # noqa: E402

NOTES = {
    "a3_fct_adverse_events_monthly":
        "Case feed: lineitem joins part (partkey) first and the order context (orderkey) last; the case "
        "dedup (the SortAggregate pair) runs on the orderkey join's partitioning with no exchange of its own. "
        "No trial join: A3 reads no trial context. One small exchange after the partial monthly aggregate.",
    "j1_curated_adverse_events":
        "Same case pipeline plus a BroadcastHashJoin LeftOuter against the per-drug counts, read back from the "
        "checkpoint folder (Scan ExistingRDD) after their row count was checked.",
    "j2_curated_supply_demand":
        "Shipments: partial SortAggregate, exchange on the lineage keys, final dedup, then partial/final "
        "monthly sums. Sales: brand x region x month sums, exact-duplicate removal without a new exchange, "
        "monthly re-aggregation. The FULL OUTER SortMergeJoin consumes both aggregates' hash partitioning.",
    "a7_load_audit":
        "One grouped pass per feed on its dedup key (partial aggregation before each exchange), unioned.",
    "ts7_demand_forecast":
        "One linear plan: monthly sums, calendar explode + LeftOuter join, interpolation windows partitioned "
        "by series, ordered arrays, grid explode (Generate), least-SSE SortAggregate with no exchange (input "
        "already partitioned by series), horizon explode. No self-join; each (series, parameter) fold runs once.",
    "m6_stratified_split":
        "The cut of each class is selected by digits: counts per six-digit prefix (the labels and ids alone), "
        "their sums by three digits, the counts inside the chosen prefix and the keys of one six-digit prefix. "
        "Each selection is one row per class and broadcast; the rows are compared with their class's cut, no window "
        "runs over them.",
    "p15_alert_messages":
        "Narrow: one scan with project/filter in whole-stage codegen, no exchange.",
}
QUERIES = list(NOTES)


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n")[0]
    scans = re.findall(r"Location: InMemoryFileIndex \[file:[^\]]*/(\w+)\.parquet\]\n(PushedFilters: .*)\n"
                       r"ReadSchema: (.*)", text)
    return head, scans


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark(master="local[8]", shuffle_partitions=8, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plans (cluster shape)\n")
    print("Generated by `tests/plan_report.py` with size-based broadcasts disabled, i.e. the plan shape when "
          "every table is too large to broadcast.  Only `bounded_broadcast` sides (checked row bound) are "
          "broadcast.  Trees are the `explain(\"formatted\")` headers; scan lines list the pushed filters and "
          "the pruned read schema.\n")
    for name in QUERIES:
        head, scans = tree(E.queries()[name](spark, sf))
        print(f"## {name}\n\n{NOTES[name]}\n\n```\n{head.strip()}\n```\n")
        for table, pushed, schema in scans:
            print(f"- `{table}`: {pushed}; ReadSchema {schema}")
        print()


if __name__ == "__main__":
    main()
