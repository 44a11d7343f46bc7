"""Time the headline queries and print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from vintagelake import session
from vintagelake.checks import registry

HEADLINE = [
    "asof_bars",
    "asof_bars_latest",
    "asof_fundamentals",
    "asof_member_bars",
    "id_resolve_ticker",
    "id_symbol_of_bar",
    "action_precedence",
    "adj_bars_split",
    "adj_bars_total_return",
    "feat_sma50",
    "feat_ema20",
    "gold_wide",
    "flagship_member_features",
    "dq_run_all",
    "dq_gaps",
    "dq_batch_verdict",
    "rebuild_report",
    "fund_map",
    "fund_chosen",
    "fund_conflicts",
    "macro_revised",
    "univ_membership_load",
    "ingest_replay",
    "validate_self_contained",
]


def split(spark, sf_dir: str, parts: int) -> str:
    """A folder with the same tables, where the fact tables are several files: here each is one file with one row
    group, which one task would read. Done once, before anything is timed."""
    out = tempfile.mkdtemp(prefix="bench-", dir="/tmp")
    for name in os.listdir(sf_dir):
        if name.removesuffix(".parquet") in ("lineitem", "orders", "events"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(parts).write.parquet(f"{out}/{name}")
        else:
            os.symlink(f"{os.path.abspath(sf_dir)}/{name}", f"{out}/{name}")
    return out


def main() -> None:
    given = sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session.build(f"local[{cpus}]", "bench", shuffle_partitions=int(cpus))
    sf_dir = split(spark, sf_dir, int(cpus))
    queries = registry.queries()

    def run(name: str) -> float:
        t = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    run("asof_bars")  # start the JVM's compilers and the file cache
    times = {name: round(run(name), 3) for name in HEADLINE}
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(given.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
