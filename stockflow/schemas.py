"""Declared schemas of the six inputs and of every silver and gold table.

``check_schema`` compares names and types (not nullability) and raises on
any difference, so a source that changes shape fails at the read, not three
layers later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

INPUTS = {
    "customers": "CustomerID string, Address string, CompanyName string",
    "customer_orders": "OrderID bigint, CustomerID string, productID bigint, demandCategory string, "
    "OrderDate timestamp_ntz, status string, max_delivery_date string, Date string",
    "finished_goods": "productID bigint, productSKU string, inventory bigint, demandCategory string",
    "manufacturing_processes": "ProcessID int, productID bigint, FacilityID string, processing_time int",
    "material_master": "MaterialID bigint, SKU string, MaterialInventory bigint",
    "manufacturing_process_parts": "ProcessID bigint, ProcessPartID string, MaterialID bigint, Quantity bigint",
}

SILVER = {
    "customers": "CustomerID string, CompanyName string, Street string, ZipCode string, City string",
    "customer_orders": "OrderID int, CustomerID string, productID int, demandCategory string, OrderDate date, "
    "status string, max_delivery_date date",
    "finished_goods": "productID int, productSKU string, Product_Inventory int, Demand string",
    "manufacturing_processes": "ProcessID int, productID int, FacilityID string, ProcessingTime int, Plant string",
    "manufacturing_process_parts": "ProcessID string, ProcessPartID string, MaterialID string, Req_Prod_Quant int",
    "material_master": "MaterialID string, Mat_SKU string, Mat_Inv int",
    "demand_domain": "CustomerID string, OrderID int, productID int, OrderDate date, status string, "
    "max_delivery_date date, CompanyName string, Street string, ZipCode string, City string",
    "manufacturing_domain": "MaterialID string, ProcessID int, ProcessPartID string, Req_Prod_Quant int, "
    "productID int, productSKU string, Product_Inventory int, FacilityID string, ProcessingTime int, "
    "Plant string, Mat_SKU string, Mat_Inv int",
}

GOLD = {
    "orders_by_customer": "CustomerID string, OrderCount bigint",
    "orders_by_product": "productID int, OrderCount bigint",
    "orders_by_month": "Month int, count bigint",
    "orders_by_status": "status string, OrderCount bigint",
    "current_demand": SILVER["demand_domain"] + ", OrderYearMonth string",
    "inventory_table": SILVER["manufacturing_domain"],
    "missing_inventory": "productID int, ProductsOrdered bigint, Product_Inventory int, Difference bigint",
    "manufacturing_job_list": "ProductID int, OrderYearMonth date, Delta_produced bigint, MaterialID string, "
    "ProcessPartID string, Req_Prod_Quant int, FacilityID string, ProcessingTime int",
    "manufacturing_delay_alerts": "ProductID int, OrderYearMonth date, Delta_produced bigint, FacilityID string, "
    "OrderDeadline date, ExpectedDelay bigint, DelayCategory string",
}


def struct(ddl: str) -> StructType:
    return StructType.fromDDL(ddl)


def _kind(dtype: str) -> str:
    """Timestamps with and without time zone are one kind: Parquet files hold
    the latter, a database read gives the former, and both become dates."""
    return "timestamp" if dtype == "timestamp_ntz" else dtype


def schema_differences(df: DataFrame, ddl: str) -> list[str]:
    """Human-readable differences between ``df``'s schema and ``ddl``."""
    want = [(f.name, f.dataType.simpleString()) for f in struct(ddl).fields]
    have = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    if [(n, _kind(t)) for n, t in want] == [(n, _kind(t)) for n, t in have]:
        return []
    out = []
    want_d, have_d = dict(want), dict(have)
    for name, t in want:
        if name not in have_d:
            out.append(f"missing {name} {t}")
        elif _kind(have_d[name]) != _kind(t):
            out.append(f"{name}: {have_d[name]} instead of {t}")
    out += [f"unexpected {n} {t}" for n, t in have if n not in want_d]
    if not out:
        out.append(f"column order {[n for n, _ in have]} instead of {[n for n, _ in want]}")
    return out


def check_schema(df: DataFrame, ddl: str, what: str = "table") -> DataFrame:
    """Return ``df`` unchanged if it has exactly the declared columns and types."""
    diffs = schema_differences(df, ddl)
    if diffs:
        raise ValueError(f"{what} does not match its declared schema: " + "; ".join(diffs))
    return df
