"""The six raw input tables, derived from the driver's TPC-H-style Parquet files.

The planning pipeline reads six operational tables (customers, customer
orders, finished goods, manufacturing processes, process parts, materials).
The test data holds none of them, so each is derived here by a fixed,
deterministic rule (FIXTURES.md section 2) that the DuckDB oracle repeats in
SQL. Every function is a lazy DataFrame over whole source tables: the scans
prune to the columns used, and all joins are left to the planner (AQE picks
broadcast or sort-merge from runtime sizes).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockflow.functions.cleaning import remove_duplicate_rows
from stockflow.operators.ranking import sequence_number
from stockflow.session import tasks_for

# Fixed values of the derivation rule (FIXTURES.md section 2).
# demandCategory by p_size % 5; the newline in "Very\nHigh" is deliberate, it
# exercises newline cleaning on finished goods.
DEMAND_BY_SIZE_MOD5 = ["Very\nHigh", "High", "Medium", "Low", "Very Low"]
DUPLICATE_CUSTOMER_EVERY = 7
POSTBOX_CUSTOMER_EVERY = 13
NULL_COMPANY_EVERY = 11
MULTILINE_COMPANY_EVERY = 10
DELIVERY_DAYS = 90


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _demand_category(size: Column) -> Column:
    mod = F.pmod(size, F.lit(5))
    expr = F.when(mod == 0, F.lit(DEMAND_BY_SIZE_MOD5[0]))
    for i, label in enumerate(DEMAND_BY_SIZE_MOD5[1:], start=1):
        expr = expr.when(mod == i, F.lit(label))
    return expr


def raw_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CustomerID, Address, CompanyName; every 7th customer appears twice."""
    cust = _table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    nation = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    base = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    doubled = base.unionByName(
        base.where(F.col("c_custkey") % DUPLICATE_CUSTOMER_EVERY == 0)
    )
    key = F.col("c_custkey")
    address = F.when(key % POSTBOX_CUSTOMER_EVERY == 0, F.lit("POSTBOX")).otherwise(
        F.concat(
            F.col("c_mktsegment"),
            F.lit(" "),
            (key % 200).cast("string"),
            F.lit("\n"),
            (F.col("c_nationkey") + 1000).cast("string"),
            F.lit(" "),
            F.col("n_name"),
        )
    )
    company = (
        F.when(key % NULL_COMPANY_EVERY == 0, F.lit(None).cast("string"))
        .when(key % MULTILINE_COMPANY_EVERY == 0, F.concat(F.col("c_name"), F.lit("\nAG")))
        .otherwise(F.col("c_name"))
    )
    return doubled.select(
        key.cast("string").alias("CustomerID"),
        address.alias("Address"),
        company.alias("CompanyName"),
    )


def raw_finished_goods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """productID bigint, productSKU, inventory bigint, demandCategory."""
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_size")
    return part.select(
        F.col("p_partkey").cast("bigint").alias("productID"),
        F.concat(
            F.upper(F.substring("p_type", 1, 2)),
            F.format_string("%06d", F.col("p_partkey")),
        ).alias("productSKU"),
        (F.col("p_size") * 2 + 20).cast("bigint").alias("inventory"),
        _demand_category(F.col("p_size")).alias("demandCategory"),
    )


def raw_customer_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: OrderID, CustomerID, productID, demandCategory,
    OrderDate (timestamp), status, max_delivery_date (text), Date (text)."""
    line = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linestatus")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_size")
    # the part first: a line is at its narrowest before it has its order's columns
    sized = line.join(part, line.l_partkey == part.p_partkey, "left")
    # the lines of a join task are bounded (line.count() reads the Parquet footers only)
    sized = sized.repartition(tasks_for(spark, line.count()), "l_orderkey")
    joined = sized.join(orders, sized.l_orderkey == orders.o_orderkey)
    order_day = F.to_date("o_orderdate")
    return joined.select(
        F.col("l_orderkey").alias("OrderID"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.col("l_partkey").alias("productID"),
        _demand_category(F.col("p_size")).alias("demandCategory"),
        F.col("o_orderdate").alias("OrderDate"),
        F.when(F.col("l_linestatus") == "O", F.lit("open")).otherwise(F.lit("closed")).alias("status"),
        # a date cast to text is yyyy-MM-dd, without a per-row formatter
        F.date_add(order_day, DELIVERY_DAYS).cast("string").alias("max_delivery_date"),
        order_day.cast("string").alias("Date"),
    )


def order_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CustomerID, _rows: each order's customer and how many raw orders (lines)
    it has. Counts a customer's raw orders without building them."""
    line = _table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_rows"))
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    joined = line.join(orders, line.l_orderkey == orders.o_orderkey)
    return joined.select(F.col("o_custkey").cast("string").alias("CustomerID"), "_rows")


def raw_manufacturing_processes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ProcessID int, productID bigint, FacilityID, processing_time int."""
    part = _table(spark, sf_dir, "part").select("p_partkey", "p_size")
    return part.select(
        (F.col("p_partkey") + 1).cast("int").alias("ProcessID"),
        F.col("p_partkey").cast("bigint").alias("productID"),
        F.concat(F.lit("Facility "), (F.pmod("p_partkey", F.lit(4)) + 1).cast("string")).alias(
            "FacilityID"
        ),
        (F.pmod("p_size", F.lit(3)) + 3).cast("int").alias("processing_time"),
    )


def raw_material_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MaterialID bigint, SKU, MaterialInventory bigint."""
    supp = _table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    return supp.select(
        F.col("s_suppkey").cast("bigint").alias("MaterialID"),
        F.concat(F.lit("M"), F.format_string("%07d", F.col("s_suppkey"))).alias("SKU"),
        F.greatest(F.lit(0).cast("bigint"), F.floor("s_acctbal").cast("bigint")).alias(
            "MaterialInventory"
        ),
    )


def raw_manufacturing_process_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ProcessID bigint, ProcessPartID, MaterialID bigint, Quantity bigint.

    Each part's suppliers become its materials: every distinct supplier key,
    numbered from 1 in key order.
    """
    line = _table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey")
    rows = line.count()
    # at most one part per line: the pairs of a task are bounded, before and after they are numbered
    numbered = sequence_number(
        remove_duplicate_rows(line, rows),
        ["l_suppkey"],
        segment=["l_partkey"],
        name="n",
        partitions=tasks_for(spark, rows),
        drop_shuffles=True,
    )
    process = F.col("l_partkey") + 1
    return numbered.select(
        process.cast("bigint").alias("ProcessID"),
        F.concat_ws("_", process.cast("string"), F.col("n").cast("string")).alias("ProcessPartID"),
        F.col("l_suppkey").cast("bigint").alias("MaterialID"),
        (F.pmod(F.col("l_partkey") + F.col("l_suppkey"), F.lit(5)) + 1).cast("bigint").alias(
            "Quantity"
        ),
    )


RAW_TABLES = {
    "customers": raw_customers,
    "customer_orders": raw_customer_orders,
    "finished_goods": raw_finished_goods,
    "manufacturing_processes": raw_manufacturing_processes,
    "manufacturing_process_parts": raw_manufacturing_process_parts,
    "material_master": raw_material_master,
}
