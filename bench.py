"""Time the workload; print one JSON line.

Two parts, both at BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[BENCH_CPUS] (default 8):

* ``layers_*``: the layered table graph as it runs in production: bronze
  ingest of the six raw tables, the silver layer (6 cleaned tables + 2
  domains), and the gold layer (7 tables, job list, delay alerts), each step
  reading the tables of the previous one.
* the headline queries, each planned against the stored silver tables (the
  way each gold step runs) and run into the ``noop`` sink, which produces
  every row and column and writes nothing.

Every item runs twice; ``queries`` holds the warm (second) seconds and
``cold`` the first. ``value`` is the warm total of everything.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stockflow.operators import demand, inventory, production  # noqa: E402
from stockflow.plans.layered import Layout, LayeredRun  # noqa: E402
from stockflow.plans.registry import ENTRY_AS_OF, MAX_HOURS_DAY, StoredLayers  # noqa: E402
from stockflow.session import build_session, scratch_path  # noqa: E402
from stockflow.sources import fixtures  # noqa: E402

AS_OF = ENTRY_AS_OF

HEADLINE = {
    "orders_by_customer": lambda l: demand.orders_by_customer(l.demand_domain()),
    "orders_by_month": lambda l: demand.orders_by_month(l.demand_domain()),
    "processing_time_by_product": lambda l: inventory.processing_time_by_product(l.manufacturing_domain()),
    "missing_inventory": lambda l: l.missing_inventory(),
    "inventory_rundown": lambda l: l.rundown(),
    "job_list": lambda l: l.jobs(),
    "job_schedule": lambda l: l.schedule(AS_OF),
    "delay_alerts": lambda l: l.alerts(AS_OF),
    "process_numbering": lambda l: inventory.process_numbering(l.goods()),
    "top_processing_time": lambda l: inventory.top_processing_time(l.manufacturing_domain()),
}

# Reported beside the workload, not part of it: the single-window schedule
# (one task per facility), for comparison with the block scan.
COMPARISONS = {
    "job_schedule_window": lambda l: l.schedule(AS_OF, method="window"),
}


def timed(fn) -> float:
    start = time.perf_counter()
    fn()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    spark = build_session(
        f"local[{cpus}]",
        shuffle_partitions=cpus * 2,
        app_name="stockflow-bench",
        extra_conf={"spark.driver.memory": "16g", "spark.local.dir": tempfile.mkdtemp(prefix="bench-")},
    )
    pipe = LayeredRun(spark, Layout(root=scratch_path(spark, "bench"), prefix="stockflow_bench_"))
    source = lambda t: fixtures.RAW_TABLES[t](spark, sf_dir)
    cold, warm = {}, {}
    steps = {
        "layers_bronze": lambda: pipe.bronze(source),
        "layers_silver": pipe.silver,
        "layers_gold": lambda: pipe.gold(AS_OF, MAX_HOURS_DAY),
    }
    for name, step in steps.items():
        cold[name] = timed(step)
        warm[name] = timed(step)
    for name, build in HEADLINE.items():
        if only and name not in only:
            continue
        run = lambda: build(StoredLayers(spark, pipe)).write.format("noop").mode("overwrite").save()
        cold[name] = timed(run)
        warm[name] = timed(run)
    compared = {}
    for name, build in COMPARISONS.items():
        if only and name not in only:
            continue
        run = lambda: build(StoredLayers(spark, pipe)).write.format("noop").mode("overwrite").save()
        timed(run)
        compared[name] = timed(run)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "layers_and_headline_queries_total_warm",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "comparisons_warm": compared,
                "sf": float(match.group(1)) if match else sf_dir,
                "cpus": cpus,
                "spark": spark.version,
                "settings": {
                    k: spark.conf.get(k)
                    for k in (
                        "spark.driver.memory",
                        "spark.sql.shuffle.partitions",
                        "spark.sql.adaptive.enabled",
                        "spark.sql.ansi.enabled",
                        "spark.sql.files.maxPartitionBytes",
                    )
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
