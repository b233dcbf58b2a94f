"""DuckDB SQL for every query in the registry (the correctness oracle).

Written by hand against the raw views ``customer nation part supplier orders
lineitem`` so that it checks the Spark code instead of restating it. Shared
steps are CTEs; each query text carries the CTEs it needs.

DuckDB notes: ``sum(bigint)`` is HUGEINT (cast back to BIGINT); integer
date parts are BIGINT (cast to INTEGER); window ORDER BY sorts nulls last by
default, Spark sorts them first, so window orders say NULLS FIRST.
"""

from __future__ import annotations

import re

from stockflow import schemas

NL = "chr(10)"


def _category(size: str) -> str:
    return (
        f"CASE {size} % 5 WHEN 0 THEN 'Very' || {NL} || 'High' WHEN 1 THEN 'High' "
        f"WHEN 2 THEN 'Medium' WHEN 3 THEN 'Low' WHEN 4 THEN 'Very Low' END"
    )


def _plant(col: str) -> str:
    return (
        f"CASE WHEN {col} = 'Facility 1' THEN 'Plant Chur' WHEN {col} = 'Facility 2' THEN 'Plant Chur' "
        f"WHEN {col} = 'Facility 3' THEN 'Plant Basel-Therwil' WHEN {col} = 'Facility 4' "
        f"THEN 'Plant Basel-Therwil' ELSE {col} END"
    )


ORACLE_AS_OF = "DATE '1995-01-01'"

# (name, sql) in dependency order.
CTES: list[tuple[str, str]] = [
    # ---- raw inputs (FIXTURES.md section 2) ----
    (
        "cust_base",
        "SELECT c.c_custkey, c.c_name, c.c_nationkey, c.c_mktsegment, n.n_name "
        "FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey",
    ),
    (
        "raw_customers",
        f"""SELECT CAST(c_custkey AS VARCHAR) AS CustomerID,
                  CASE WHEN c_custkey % 13 = 0 THEN 'POSTBOX'
                       ELSE c_mktsegment || ' ' || CAST(c_custkey % 200 AS VARCHAR) || {NL}
                            || CAST(c_nationkey + 1000 AS VARCHAR) || ' ' || n_name END AS Address,
                  CASE WHEN c_custkey % 11 = 0 THEN NULL
                       WHEN c_custkey % 10 = 0 THEN c_name || {NL} || 'AG'
                       ELSE c_name END AS CompanyName
           FROM (SELECT * FROM cust_base UNION ALL SELECT * FROM cust_base WHERE c_custkey % 7 = 0)""",
    ),
    (
        "raw_goods",
        f"""SELECT CAST(p_partkey AS BIGINT) AS productID,
                  upper(substr(p_type, 1, 2)) || printf('%06d', p_partkey) AS productSKU,
                  CAST(p_size * 2 + 20 AS BIGINT) AS inventory,
                  {_category('p_size')} AS demandCategory
           FROM part""",
    ),
    (
        "raw_orders",
        f"""SELECT l.l_orderkey AS OrderID, CAST(o.o_custkey AS VARCHAR) AS CustomerID,
                  l.l_partkey AS productID, {_category('p.p_size')} AS demandCategory,
                  o.o_orderdate AS OrderDate,
                  CASE WHEN l.l_linestatus = 'O' THEN 'open' ELSE 'closed' END AS status,
                  strftime(CAST(o.o_orderdate AS DATE) + 90, '%Y-%m-%d') AS max_delivery_date,
                  strftime(CAST(o.o_orderdate AS DATE), '%Y-%m-%d') AS Date
           FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
           LEFT JOIN part p ON l.l_partkey = p.p_partkey""",
    ),
    (
        "raw_processes",
        """SELECT CAST(p_partkey + 1 AS INTEGER) AS ProcessID, CAST(p_partkey AS BIGINT) AS productID,
                  'Facility ' || CAST(p_partkey % 4 + 1 AS VARCHAR) AS FacilityID,
                  CAST(p_size % 3 + 3 AS INTEGER) AS processing_time
           FROM part""",
    ),
    (
        "raw_materials",
        """SELECT CAST(s_suppkey AS BIGINT) AS MaterialID, 'M' || printf('%07d', s_suppkey) AS SKU,
                  CAST(greatest(0, floor(s_acctbal)) AS BIGINT) AS MaterialInventory
           FROM supplier""",
    ),
    (
        "raw_parts",
        """SELECT CAST(l_partkey + 1 AS BIGINT) AS ProcessID,
                  CAST(l_partkey + 1 AS VARCHAR) || '_' || CAST(n AS VARCHAR) AS ProcessPartID,
                  CAST(l_suppkey AS BIGINT) AS MaterialID,
                  CAST((l_partkey + l_suppkey) % 5 + 1 AS BIGINT) AS Quantity
           FROM (SELECT l_partkey, l_suppkey,
                        row_number() OVER (PARTITION BY l_partkey ORDER BY l_suppkey) AS n
                 FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem))""",
    ),
    # ---- silver ----
    (
        "silver_customers",
        f"""SELECT coalesce(CustomerID, '') AS CustomerID, coalesce(CompanyName, '') AS CompanyName,
                  concat_ws(' ', a[1], a[2]) AS Street, a[-2] AS ZipCode, a[-1] AS City
           FROM (SELECT CustomerID, CompanyName, string_split(coalesce(Address, ''), ' ') AS a
                 FROM (SELECT DISTINCT CustomerID, replace(Address, {NL}, ' ') AS Address,
                              replace(CompanyName, {NL}, ' ') AS CompanyName
                       FROM raw_customers))""",
    ),
    (
        "silver_orders",
        """SELECT coalesce(CAST(OrderID AS INTEGER), 0) AS OrderID, coalesce(CustomerID, '') AS CustomerID,
                  coalesce(CAST(productID AS INTEGER), 0) AS productID,
                  coalesce(demandCategory, '') AS demandCategory, CAST(OrderDate AS DATE) AS OrderDate,
                  coalesce(status, '') AS status, CAST(max_delivery_date AS DATE) AS max_delivery_date
           FROM (SELECT DISTINCT * FROM raw_orders)""",
    ),
    (
        "silver_goods",
        f"""SELECT coalesce(CAST(productID AS INTEGER), 0) AS productID, coalesce(productSKU, '') AS productSKU,
                  coalesce(CAST(inventory AS INTEGER), 0) AS Product_Inventory,
                  coalesce(demandCategory, '') AS Demand
           FROM (SELECT DISTINCT productID, productSKU, inventory,
                        replace(demandCategory, {NL}, ' ') AS demandCategory FROM raw_goods)""",
    ),
    (
        "silver_processes",
        f"""SELECT ProcessID, productID, FacilityID, ProcessingTime, {_plant('FacilityID')} AS Plant
           FROM (SELECT coalesce(ProcessID, 0) AS ProcessID, coalesce(CAST(productID AS INTEGER), 0) AS productID,
                        coalesce(FacilityID, '') AS FacilityID, coalesce(processing_time, 0) AS ProcessingTime
                 FROM (SELECT DISTINCT * FROM raw_processes))""",
    ),
    (
        "silver_parts",
        """SELECT CAST(coalesce(CAST(ProcessID AS INTEGER), 0) AS VARCHAR) AS ProcessID,
                  coalesce(ProcessPartID, '') AS ProcessPartID,
                  CAST(coalesce(CAST(MaterialID AS INTEGER), 0) AS VARCHAR) AS MaterialID,
                  coalesce(CAST(Quantity AS INTEGER), 0) AS Req_Prod_Quant
           FROM (SELECT DISTINCT * FROM raw_parts)""",
    ),
    (
        "silver_materials",
        """SELECT CAST(coalesce(CAST(MaterialID AS INTEGER), 0) AS VARCHAR) AS MaterialID,
                  coalesce(SKU, '') AS Mat_SKU, coalesce(CAST(MaterialInventory AS INTEGER), 0) AS Mat_Inv
           FROM (SELECT DISTINCT * FROM raw_materials)""",
    ),
    (
        "demand_domain",
        """SELECT o.CustomerID, o.OrderID, o.productID, o.OrderDate, o.status, o.max_delivery_date,
                  c.CompanyName, c.Street, c.ZipCode, c.City
           FROM silver_orders o LEFT JOIN silver_customers c ON o.CustomerID = c.CustomerID""",
    ),
    (
        "manufacturing_domain",
        """SELECT pt.MaterialID, gp.ProcessID, pt.ProcessPartID, pt.Req_Prod_Quant, gp.productID,
                  gp.productSKU, gp.Product_Inventory, gp.FacilityID, gp.ProcessingTime, gp.Plant,
                  m.Mat_SKU, m.Mat_Inv
           FROM (SELECT g.productID, g.productSKU, g.Product_Inventory, pr.ProcessID, pr.FacilityID,
                        pr.ProcessingTime, pr.Plant
                 FROM silver_goods g LEFT JOIN silver_processes pr ON g.productID = pr.productID) gp
           LEFT JOIN silver_parts pt ON gp.ProcessID = TRY_CAST(pt.ProcessID AS INTEGER)
           LEFT JOIN silver_materials m ON pt.MaterialID = m.MaterialID""",
    ),
    # ---- gold ----
    (
        "missing_inventory",
        """SELECT DISTINCT productID, ProductsOrdered, Product_Inventory,
                  Product_Inventory - ProductsOrdered AS Difference
           FROM (SELECT coalesce(d.productID, 0) AS productID, coalesce(o.ProductsOrdered, 0) AS ProductsOrdered,
                        coalesce(d.Product_Inventory, 0) AS Product_Inventory
                 FROM (SELECT productID,
                              CASE WHEN Product_Inventory - 50 < 0 THEN 0 ELSE Product_Inventory - 50 END
                                AS Product_Inventory
                       FROM manufacturing_domain) d
                 LEFT JOIN (SELECT productID, count(productID) AS ProductsOrdered FROM demand_domain
                            WHERE status = 'open' GROUP BY productID) o
                 ON d.productID = o.productID)""",
    ),
    (
        "per_day",
        """SELECT productID AS ProductID, OrderDate AS OrderYearMonth, count(*) AS count
           FROM demand_domain WHERE status = 'open' GROUP BY productID, OrderDate""",
    ),
    (
        "rd0",
        """SELECT p.ProductID, p.OrderYearMonth, p.count, m.Product_Inventory,
                  CAST(sum(p.count) OVER (PARTITION BY p.ProductID ORDER BY p.OrderYearMonth) AS BIGINT)
                    AS running_total
           FROM per_day p LEFT JOIN (SELECT productID, Product_Inventory FROM missing_inventory) m
           ON p.ProductID = m.productID""",
    ),
    (
        "rd1",
        """SELECT ProductID, OrderYearMonth, count, Product_Inventory, running_total,
                  CASE WHEN Product_Inventory - running_total < 0 THEN 0
                       ELSE Product_Inventory - running_total END AS end_inventory,
                  CASE WHEN Product_Inventory - running_total < 0 THEN running_total - Product_Inventory
                       ELSE 0 END AS Total_produced
           FROM rd0""",
    ),
    (
        "rundown",
        """SELECT ProductID, OrderYearMonth, count, Product_Inventory, running_total, end_inventory,
                  coalesce(lag(end_inventory) OVER w, Product_Inventory) AS start_inventory,
                  Total_produced, lag(Total_produced) OVER w AS Total_produced_before,
                  coalesce(Total_produced - lag(Total_produced) OVER w, Total_produced) AS Delta_produced
           FROM rd1 WINDOW w AS (PARTITION BY ProductID ORDER BY OrderYearMonth)""",
    ),
    (
        "deltas",
        "SELECT ProductID, OrderYearMonth, Delta_produced FROM rundown WHERE Delta_produced > 0",
    ),
    (
        "jobs",
        """SELECT d.ProductID, d.OrderYearMonth, d.Delta_produced, m.MaterialID, m.ProcessPartID,
                  m.Req_Prod_Quant, m.FacilityID, m.ProcessingTime
           FROM deltas d LEFT JOIN manufacturing_domain m ON d.ProductID = m.productID""",
    ),
    (
        "sch0",
        f"""SELECT *, CAST(OrderYearMonth + INTERVAL 3 MONTH AS DATE) AS OrderDeadline,
                  {ORACLE_AS_OF} AS CurrentDate,
                  CAST(date_diff('day', {ORACLE_AS_OF}, CAST(OrderYearMonth + INTERVAL 3 MONTH AS DATE)) * 8
                       AS INTEGER) AS DiffHours,
                  right(ProcessPartID, 1) AS ProductCategory
           FROM jobs""",
    ),
    (
        "sch1",
        """SELECT *, coalesce(lag(ProductCategory) OVER (PARTITION BY FacilityID
                    ORDER BY OrderYearMonth NULLS FIRST, ProductID NULLS FIRST,
                             ProcessPartID NULLS FIRST, MaterialID NULLS FIRST), ProductCategory)
                    AS PreviousProductCat
           FROM sch0""",
    ),
    (
        "sch2",
        """SELECT *, CASE WHEN PreviousProductCat = ProductCategory THEN ProcessingTime * Delta_produced
                          ELSE ProcessingTime * Delta_produced + 1 END AS TotalProcessingTime
           FROM sch1""",
    ),
    (
        "schedule",
        """SELECT ProductID, OrderYearMonth, Delta_produced, MaterialID, ProcessPartID, Req_Prod_Quant,
                  FacilityID, ProcessingTime, OrderDeadline, CurrentDate, DiffHours, ProductCategory,
                  PreviousProductCat, TotalProcessingTime,
                  CAST(sum(TotalProcessingTime) OVER (PARTITION BY FacilityID
                       ORDER BY OrderYearMonth NULLS FIRST, ProductID NULLS FIRST) AS BIGINT) AS Running_Total
           FROM sch2""",
    ),
    (
        "late",
        """SELECT *, Running_Total - DiffHours AS ExpectedDelay FROM schedule
           WHERE Running_Total > DiffHours""",
    ),
    (
        "alerts",
        """SELECT DISTINCT ProductID, OrderYearMonth, Delta_produced, FacilityID, OrderDeadline, ExpectedDelay,
                  CASE WHEN ExpectedDelay <= lo + 0.2::DOUBLE * (hi - lo) THEN 'Category_1'
                       WHEN ExpectedDelay > lo + 0.2::DOUBLE * (hi - lo)
                            AND ExpectedDelay <= lo + 0.4::DOUBLE * (hi - lo) THEN 'Category_2'
                       WHEN ExpectedDelay > lo + 0.4::DOUBLE * (hi - lo)
                            AND ExpectedDelay <= lo + 0.6::DOUBLE * (hi - lo) THEN 'Category_3'
                       WHEN ExpectedDelay > lo + 0.6::DOUBLE * (hi - lo)
                            AND ExpectedDelay <= lo + 0.8::DOUBLE * (hi - lo) THEN 'Category_4'
                       ELSE 'Category_5' END AS DelayCategory
           FROM late, (SELECT min(ExpectedDelay) AS lo, max(ExpectedDelay) AS hi FROM late) b""",
    ),
]

_CTE_SQL = dict(CTES)
_CTE_ORDER = [name for name, _ in CTES]


def _deps(sql: str) -> set[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", sql))
    return {name for name in _CTE_SQL if name in words}


def with_ctes(body: str) -> str:
    """Prefix ``body`` with the CTEs it uses, transitively, in definition order."""
    needed: set[str] = set()
    todo = list(_deps(body))
    while todo:
        name = todo.pop()
        if name in needed:
            continue
        needed.add(name)
        todo.extend(_deps(_CTE_SQL[name]) - needed)
    parts = [f"{name} AS ({_CTE_SQL[name]})" for name in _CTE_ORDER if name in needed]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body


_NULLIF_FAC = (
    "CASE WHEN productID % 50 = 0 THEN NULL WHEN productID % 50 = 1 THEN 'Facility 9' ELSE FacilityID END"
)
_NULLIF_TIME = "CASE WHEN productID % 50 = 0 THEN NULL WHEN productID % 50 = 1 THEN 9 ELSE processing_time END"

def _content_sql() -> str:
    """Row count, non-null count and order-free checksum of every raw column."""
    raw = {
        "customers": "raw_customers", "customer_orders": "raw_orders", "finished_goods": "raw_goods",
        "manufacturing_processes": "raw_processes", "manufacturing_process_parts": "raw_parts",
        "material_master": "raw_materials",
    }
    selects = []
    for table, cte in raw.items():
        for field in schemas.INPUTS[table].split(", "):
            name = field.strip().split()[0].strip("`")
            selects.append(
                f"""SELECT '{table}' AS table_name, '{name}' AS column_name, count(*) AS row_count,
        count("{name}") AS non_nulls,
        coalesce(sum(('0x' || substr(md5("{name}"::VARCHAR), 1, 8))::BIGINT), 0)::BIGINT AS checksum FROM {cte}"""
            )
    return " UNION ALL ".join(selects)


BODIES: dict[str, str] = {
    # cleaning
    "replace_newlines": f"SELECT CustomerID, replace(Address, {NL}, ' ') AS Address, "
    f"replace(CompanyName, {NL}, ' ') AS CompanyName FROM raw_customers",
    "dedupe_rows": "SELECT DISTINCT * FROM raw_customers",
    "narrow_types": """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, CAST(l_partkey AS INTEGER) AS l_partkey,
        CAST(l_suppkey AS INTEGER) AS l_suppkey, l_linenumber, CAST(l_quantity AS REAL) AS l_quantity,
        CAST(l_extendedprice AS REAL) AS l_extendedprice, CAST(l_discount AS REAL) AS l_discount,
        CAST(l_tax AS REAL) AS l_tax, l_returnflag, l_linestatus, l_shipdate FROM lineitem""",
    "dates_to_date": """SELECT OrderID, CustomerID, productID, demandCategory, CAST(OrderDate AS DATE) AS OrderDate,
        status, max_delivery_date, Date FROM raw_orders""",
    "fill_empty": """SELECT CAST(l_orderkey AS INTEGER) AS l_orderkey, l_linenumber,
        coalesce(CASE WHEN l_linenumber = 1 THEN NULL ELSE l_linenumber END, 0) AS line_no,
        coalesce(CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_returnflag END, '') AS flag,
        coalesce(CAST(CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS REAL), CAST(0 AS REAL)) AS discount,
        coalesce(CAST(CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS REAL), CAST(0 AS REAL)) AS tax
        FROM lineitem""",
    "map_values": f"""SELECT ProcessID, productID, fac AS FacilityID, processing_time, {_plant('fac')} AS Plant
        FROM (SELECT *, {_NULLIF_FAC} AS fac FROM raw_processes)""",
    "map_values_typed": """SELECT ProcessID, productID, FacilityID,
        CASE WHEN t = 3 THEN 'low' WHEN t = 4 THEN 'medium' WHEN t = 5 THEN 'high'
             ELSE CAST(t AS VARCHAR) END AS processing_time
        FROM (SELECT *, """
    + _NULLIF_TIME
    + """ AS t FROM raw_processes)""",
    "split_address": f"""SELECT CustomerID, CompanyName, concat_ws(' ', a[1], a[2]) AS Street, a[-2] AS ZipCode,
        a[-1] AS City
        FROM (SELECT CustomerID, replace(CompanyName, {NL}, ' ') AS CompanyName,
                     string_split(replace(Address, {NL}, ' '), ' ') AS a FROM raw_customers)""",
    # silver
    "silver_customers": "SELECT * FROM silver_customers",
    "silver_customer_orders": "SELECT * FROM silver_orders",
    "silver_finished_goods": "SELECT * FROM silver_goods",
    "silver_processes": "SELECT * FROM silver_processes",
    "silver_process_parts": "SELECT * FROM silver_parts",
    "silver_materials": "SELECT * FROM silver_materials",
    "demand_domain": "SELECT * FROM demand_domain",
    "manufacturing_domain": "SELECT * FROM manufacturing_domain",
    # demand
    "orders_by_customer": "SELECT CustomerID, count(OrderID) AS OrderCount FROM demand_domain GROUP BY CustomerID",
    "orders_by_product": "SELECT productID, count(OrderID) AS OrderCount FROM demand_domain GROUP BY productID",
    "orders_by_month": "SELECT CAST(month(OrderDate) AS INTEGER) AS Month, count(*) AS count "
    "FROM demand_domain GROUP BY 1",
    "orders_by_status": "SELECT status, count(OrderID) AS OrderCount FROM demand_domain GROUP BY status",
    "current_demand": "SELECT *, strftime(OrderDate, '%Y-%m') AS OrderYearMonth FROM demand_domain",
    "orders_by_demand_category": "SELECT demandCategory, count(*) AS count FROM raw_orders GROUP BY 1",
    "orders_by_year_month": """SELECT CAST(year(CAST(Date AS DATE)) AS INTEGER) AS Year,
        CAST(month(CAST(Date AS DATE)) AS INTEGER) AS Month, count(OrderID) AS OrderCount
        FROM raw_orders GROUP BY 1, 2""",
    "open_orders_by_month": """SELECT CAST(month(CAST(Date AS DATE)) AS INTEGER) AS Month, status, count(*) AS count
        FROM raw_orders WHERE status = 'open' GROUP BY 1, 2""",
    "orders_latest_first": "SELECT * FROM raw_orders",
    "max_delivery_date": """SELECT OrderID, productID, OrderDate, max_delivery_date,
        OrderDate + 90 AS MaxDeliveryDate FROM silver_orders""",
    "demand_share": """SELECT productID, Demand, CAST(CASE Demand WHEN 'Very High' THEN 5 WHEN 'High' THEN 4
        WHEN 'Medium' THEN 3 WHEN 'Low' THEN 2 WHEN 'Very Low' THEN 1 END::DOUBLE / 15 AS REAL) AS saleProbability
        FROM silver_goods""",
    "closure_probability": f"""SELECT OrderID, productID, OrderDate, status,
        CAST(least(10 + 30 * ((year({ORACLE_AS_OF}) - year(OrderDate)) * 12
                              + month({ORACLE_AS_OF}) - month(OrderDate)), 100) AS INTEGER) AS ClosureProbability
        FROM silver_orders""",
    # inventory
    "processing_time_by_product": """SELECT productID, CAST(sum(ProcessingTime) AS BIGINT) AS TotalProcessingTime
        FROM manufacturing_domain GROUP BY productID""",
    "avg_processing_time_by_facility": """SELECT FacilityID, avg(ProcessingTime) AS AvgProcessingTime
        FROM manufacturing_domain GROUP BY FacilityID""",
    "inventory_levels": "SELECT DISTINCT MaterialID, Mat_SKU, Mat_Inv FROM manufacturing_domain",
    "inventory_level_count": """SELECT count(*) AS InventoryLevelCount
        FROM (SELECT DISTINCT MaterialID, Mat_SKU, Mat_Inv FROM manufacturing_domain)""",
    "inventory_table": "SELECT * FROM manufacturing_domain",
    "missing_inventory": "SELECT * FROM missing_inventory",
    "top_processing_time": """SELECT productID, CAST(sum(ProcessingTime) AS BIGINT) AS TotalProcessingTime
        FROM manufacturing_domain GROUP BY productID
        ORDER BY TotalProcessingTime DESC NULLS LAST, productID ASC NULLS FIRST LIMIT 100""",
    "top_facilities": """SELECT FacilityID, avg(ProcessingTime) AS AvgProcessingTime
        FROM manufacturing_domain GROUP BY FacilityID
        ORDER BY AvgProcessingTime DESC NULLS LAST, FacilityID ASC NULLS FIRST LIMIT 100""",
    "top_missing_inventory": """SELECT * FROM missing_inventory
        ORDER BY productID DESC NULLS LAST, ProductsOrdered NULLS FIRST, Product_Inventory NULLS FIRST,
                 Difference NULLS FIRST LIMIT 100""",
    "process_numbering": """SELECT CAST(row_number() OVER (ORDER BY productID) AS INTEGER) AS ProcessID, productID
        FROM raw_goods""",
    "bom_part_ids": """SELECT ProcessID, MaterialID, CAST(ProcessID AS VARCHAR) || '_'
        || CAST(row_number() OVER (PARTITION BY ProcessID ORDER BY MaterialID) AS VARCHAR) AS ProcessPartID
        FROM raw_parts""",
    # production
    "open_orders_by_product_day": "SELECT * FROM per_day",
    "inventory_rundown": "SELECT * FROM rundown",
    "production_deltas": "SELECT * FROM deltas",
    "job_list": "SELECT * FROM jobs",
    "job_schedule": "SELECT * FROM schedule",
    "delay_alerts": "SELECT * FROM alerts",
    "catalog_roundtrip": "SELECT * FROM demand_domain",
    "bronze_ingest": _content_sql(),
    "layered_delay_alerts": "SELECT * FROM alerts",
    "delay_summary": """SELECT DelayCategory, count(*) AS AlertCount, min(ExpectedDelay) AS MinExpectedDelay,
        max(ExpectedDelay) AS MaxExpectedDelay FROM alerts GROUP BY DelayCategory""",
}

ORACLE_SQL: dict[str, str] = {name: with_ctes(body) for name, body in BODIES.items()}
