"""Side-by-side check of a Spark query against its DuckDB oracle SQL."""

from __future__ import annotations

import math

import duckdb

VIEWS = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
         "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duckdb_for(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{sf_dir}/{v}.parquet')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return ("nan",)
        return round(v, 9)
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i].lower())
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=repr)
    return [cols[i] for i in order], out


# What the sorted queries are sorted by, as DuckDB is to sort them: nulls are
# the smallest values, as in Spark.
ORDERED = {
    "orders_by_demand_category": "count DESC NULLS LAST, demandCategory NULLS FIRST",
    "orders_by_year_month": "Year NULLS FIRST, Month NULLS FIRST",
    "open_orders_by_month": "Month NULLS FIRST",
    "orders_latest_first": "OrderDate DESC NULLS LAST, OrderID NULLS FIRST",
    "top_processing_time": "TotalProcessingTime DESC NULLS LAST, productID NULLS FIRST",
    "top_facilities": "AvgProcessingTime DESC NULLS LAST, FacilityID NULLS FIRST",
    "top_missing_inventory": "productID DESC NULLS LAST, ProductsOrdered NULLS FIRST, Product_Inventory NULLS FIRST",
    "delay_alerts": "FacilityID NULLS FIRST, OrderYearMonth NULLS FIRST, ProductID NULLS FIRST",
}


def compare_order(columns: list[str], rows: list[tuple], sql: str, order: str, con) -> tuple[bool, str]:
    """Whether the rows' sort keys come in DuckDB's order of the same rows."""
    keys = [part.split()[0] for part in order.split(",")]
    quoted = ", ".join(f'"{k}"' for k in keys)
    by = ", ".join(f'"{part.split()[0]}" {" ".join(part.split()[1:])}' for part in order.split(","))
    want = [tuple(map(_norm, r)) for r in con.execute(f"SELECT {quoted} FROM ({sql}) ORDER BY {by}").fetchall()]
    at = [columns.index(k) for k in keys]
    got = [tuple(_norm(r[i]) for i in at) for r in rows]
    first = next((i for i, (a, b) in enumerate(zip(got, want)) if a != b), None)
    if first is not None:
        return False, f"order differs at row {first}: spark={got[first]} duckdb={want[first]}"
    return True, f"{len(got)} rows in order"


def compare(spark_df, sql: str, con, order: str | None = None) -> tuple[bool, str]:
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    if sc != dc:
        return False, f"columns differ: spark={sc} duckdb={dc}"
    if len(sr) != len(dr):
        return False, f"row count differs: spark={len(sr)} duckdb={len(dr)}"
    if sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        return False, f"values differ ({len(sr)} rows), e.g. {diff}"
    if order:
        ok, msg = compare_order(s_cols, s_rows, sql, order, con)
        if not ok:
            return False, msg
    return True, f"{len(sr)} rows"
