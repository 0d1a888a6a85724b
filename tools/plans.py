"""Print the physical plans of the key operators (markdown) at a scale factor.

    python tools/plans.py /root/testdata/sf0.01 > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from critiq.operators import duplicate_rows, history_view, invalid_rows, quality_summary  # noqa: E402
from critiq.schema import UNIFIED_SCHEMA  # noqa: E402
from critiq.session import scratch_path  # noqa: E402
from critiq.plans import queries as Q  # noqa: E402
from critiq.session import build_session  # noqa: E402
from critiq.sources.feeds import read_feed  # noqa: E402

NOTES = {
    "dedup_by_key": "Partial WindowGroupLimit before the exchange: at most one row per key and map task crosses the shuffle.",
    "gold_rollup": "Partial HashAggregate before the exchange on the four keys; scans read only the needed columns.",
    "quality_summary (un-deduplicated input)": "Per-key partial aggregation before the shuffle on id, then one global aggregation.",
    "duplicate_rows": "One inner join above the union: the feeds are read once for their keys and once for their rows.",
    "history_view": "Distinct as a partial + final HashAggregate over all columns.",
    "invalid rows from the stage table": "The IS NULL predicates reach the Parquet scan (PushedFilters), so row groups without NULLs can be skipped.",
    "scan with load-date range": "PartitionFilters on odate: only the matching directories are listed and read.",
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffle_table(spark, sf: str) -> None:
    """Shuffles, broadcasts and file scans planned by every registered query
    (before AQE re-planning; eager queries show the plan of their read-back)."""

    print("## Shuffles per registered query\n")
    print("| query | shuffles (Exchange hashpartitioning / rangepartitioning / single) | broadcasts | file scans |")
    print("|---|---|---|---|")
    for name, query in Q.queries().items():
        text = plan(query(spark, sf))
        hashed = text.count("Exchange hashpartitioning")
        ranged = text.count("Exchange rangepartitioning")
        single = text.count("Exchange SinglePartition")
        rebalance = text.count("Exchange RoundRobinPartitioning")
        parts = [f"{hashed} hash"] + [f"{n} {kind}" for n, kind in ((ranged, "range"), (single, "single"), (rebalance, "round-robin")) if n]
        print(f"| `{name}` | {', '.join(parts)} | {text.count('BroadcastExchange')} | {text.count('FileScan')} |")
    print(
        "\nCounts are taken from the plan before AQE runs. At run time identical exchanges are reused: "
        "`duplicate_rows` and `invalid_rows_with_dups` get the semi join pushed into each union branch, "
        "but compute the repeated-key aggregation once (`ReusedExchange`). AQE also turns a sort-merge join "
        "whose small side measures under the broadcast threshold into a broadcast join. Queries that write "
        "and read back (scan, sink and pipeline queries) show only the read-back plan; their jobs ran when "
        "the query was built.\n"
    )


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session("local[8]", shuffle_partitions=16)
    landing = Q.landing_zone(spark, sf)
    stage = scratch_path(spark, "plans-stage")
    Q.deduped(spark, sf).write.parquet(stage)
    frames = {
        "dedup_by_key": Q.deduped(spark, sf),
        "gold_rollup": Q.gold(spark, sf),
        "quality_summary (un-deduplicated input)": quality_summary(Q.unified(spark, sf)),
        "duplicate_rows": duplicate_rows(Q.unified(spark, sf)),
        "history_view": history_view(Q.valid(spark, sf)),
        "invalid rows from the stage table": invalid_rows(spark.read.schema(UNIFIED_SCHEMA).parquet(stage)),
        "scan with load-date range": read_feed(
            spark, landing["apple_store"], odate_from="20240110", odate_to="20240120"
        ).select("id", "odate"),
    }
    print(f"# Physical plans ({os.path.basename(sf)}, before AQE re-planning)\n")
    print("Generated by `python tools/plans.py`. Long expressions are cut at 160 characters.\n")
    shuffle_table(spark, sf)
    for name, df in frames.items():
        print(f"## {name}\n\n{NOTES[name]}\n\n```")
        for line in plan(df).splitlines():
            print(line if len(line) <= 160 else line[:157] + "...")
            if "FileScan" in line:
                pad = " " * (len(line) - len(line.lstrip(" :+-")) + 4)
                for pattern in (r"PartitionFilters: \[[^\]]*\]", r"PushedFilters: \[.*?\](?=, ReadSchema)", r"ReadSchema: \S+"):
                    found = re.search(pattern, line)
                    if found and found.group(0) not in ("PartitionFilters: []", "PushedFilters: []"):
                        text = found.group(0)
                        print(pad + (text if len(text) <= 150 else text[:147] + "..."))
        print("```\n")
    spark.stop()


if __name__ == "__main__":
    main()
