"""The table graph, run layer by layer: bronze -> silver -> gold.

Each step reads the tables of the previous layer from the catalog and writes
its own, so every written table cuts the lineage: a lost executor only
recomputes work since the last table, and each gold query plans against
stored, column-pruned Parquet instead of re-running the joins upstream.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from stockflow import schemas
from stockflow.operators import demand, inventory, production, silver
from stockflow.sources.bronze import BRONZE_TABLES, bronze_ingest
from stockflow.sources.catalog import ensure_database, read_table, write_table


@dataclass(frozen=True)
class Layout:
    """Where the three layers live: databases and a shared storage root."""

    root: str
    prefix: str = "stockflow_"
    fmt: str = "parquet"

    def db(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"


SILVER_CLEANERS = {
    "customers": silver.silver_customers,
    "customer_orders": silver.silver_customer_orders,
    "finished_goods": silver.silver_finished_goods,
    "manufacturing_processes": silver.silver_manufacturing_processes,
    "manufacturing_process_parts": silver.silver_manufacturing_process_parts,
    "material_master": silver.silver_material_master,
}


# Tables whose files are sorted by a column: later steps read only the open
# orders of the demand tables, so the pushed status filter skips row groups by
# their statistics. (Not a partition column: Spark stores an empty partition
# value as null, and an empty status is a value of its own here.)
SORTED = {
    ("silver", "demand_domain"): ["status"],
    ("gold", "current_demand"): ["status"],
}


def _declared(layer: str) -> dict[str, str]:
    return {"silver": schemas.SILVER, "gold": schemas.GOLD}.get(layer, {})


class LayeredRun:
    def __init__(self, spark: SparkSession, layout: Layout):
        self.spark = spark
        self.layout = layout

    def table(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, f"{self.layout.db(layer)}.{name}")

    def save(self, df: DataFrame, layer: str, name: str) -> str:
        declared = _declared(layer)
        if name in declared:
            schemas.check_schema(df, declared[name], f"{layer}.{name}")
        ensure_database(self.spark, self.layout.db(layer), f"{self.layout.root}/{layer}")
        if (layer, name) in SORTED:
            df = df.sortWithinPartitions(*SORTED[layer, name])
        return write_table(df, f"{self.layout.db(layer)}.{name}", self.layout.path(layer, name), self.layout.fmt)

    def bronze(self, read_source: Callable[[str], DataFrame], check: bool = True) -> dict[str, str]:
        return bronze_ingest(
            self.spark, read_source, self.layout.db("bronze"), f"{self.layout.root}/bronze", BRONZE_TABLES,
            self.layout.fmt, schemas=schemas.INPUTS if check else None,
        )

    def silver(self) -> dict[str, str]:
        out = {}
        for name, clean in SILVER_CLEANERS.items():
            raw = self.table("bronze", name)
            out[name] = self.save(clean(raw, rows=raw.count()), "silver", name)
        t = lambda n: self.table("silver", n)
        out["demand_domain"] = self.save(
            silver.demand_domain(t("customer_orders"), t("customers"), rows=t("customer_orders").count()), "silver", "demand_domain"
        )
        out["manufacturing_domain"] = self.save(
            silver.manufacturing_domain(
                t("finished_goods"), t("manufacturing_processes"), t("manufacturing_process_parts"),
                t("material_master"),
            ),
            "silver",
            "manufacturing_domain",
        )
        return out

    def gold(
        self,
        as_of: dt.date | str | Column | None = None,
        max_hours_day: int = 8,
        safety_reserve: int = 50,
    ) -> dict[str, str]:
        dd = self.table("silver", "demand_domain")
        md = self.table("silver", "manufacturing_domain")
        out = {
            "orders_by_customer": self.save(demand.orders_by_customer(dd), "gold", "orders_by_customer"),
            "orders_by_product": self.save(demand.orders_by_product(dd), "gold", "orders_by_product"),
            "orders_by_month": self.save(demand.orders_by_month(dd), "gold", "orders_by_month"),
            "orders_by_status": self.save(demand.orders_by_status(dd), "gold", "orders_by_status"),
            "current_demand": self.save(demand.current_demand(dd), "gold", "current_demand"),
            "inventory_table": self.save(inventory.inventory_table(md), "gold", "inventory_table"),
            "missing_inventory": self.save(
                inventory.missing_inventory(dd, md, safety_reserve), "gold", "missing_inventory"
            ),
        }
        g = lambda n: self.table("gold", n)
        per_day = production.open_orders_by_product_day(g("current_demand"))
        deltas = production.production_deltas(production.inventory_rundown(per_day, g("missing_inventory")))
        out["manufacturing_job_list"] = self.save(
            production.job_list(deltas, g("inventory_table")), "gold", "manufacturing_job_list"
        )
        # the jobs of the list just written, scheduled from the days and parts it lists
        schedule = production.schedule_jobs(production.JobParts(deltas, g("inventory_table")), max_hours_day, as_of=as_of)
        out["manufacturing_delay_alerts"] = self.save(
            production.delay_alerts(schedule), "gold", "manufacturing_delay_alerts"
        )
        return out

    def run(self, read_source: Callable[[str], DataFrame], as_of=None, max_hours_day: int = 8) -> dict[str, str]:
        tables = self.bronze(read_source)
        tables.update({f"silver.{k}": v for k, v in self.silver().items()})
        tables.update({f"gold.{k}": v for k, v in self.gold(as_of, max_hours_day).items()})
        return tables
