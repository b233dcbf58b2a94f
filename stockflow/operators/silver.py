"""Silver layer: one cleaner per raw table, then the demand and manufacturing domains.

The cleaning steps run in a fixed order per table. Order matters:
duplicates go before timestamps are cut to dates (rows that become equal
later stay), newline replacement goes before dedupe, and narrowing goes
before filling (bigint is not filled). ``rows``, about how many rows the raw
table has, bounds the rows of a dedupe task (``remove_duplicate_rows``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.cleaning import (
    convert_column_types,
    convert_date_format,
    fill_empty_fields,
    map_column_values,
    remove_duplicate_rows,
    replace_newlines,
    split_address_column,
)
from stockflow.operators.joins import left_join_hot_left, left_join_skew_safe

# Facility -> plant.
PLANT_MAPPING = {
    "Facility 1": "Plant Chur",
    "Facility 2": "Plant Chur",
    "Facility 3": "Plant Basel-Therwil",
    "Facility 4": "Plant Basel-Therwil",
}


def _standard(df: DataFrame, on_error: str = "fail", rows: int | None = None) -> DataFrame:
    return fill_empty_fields(convert_column_types(remove_duplicate_rows(df, rows), on_error))


def silver_customers(raw: DataFrame, on_error: str = "fail", rows: int | None = None) -> DataFrame:
    """CustomerID, CompanyName, Street, ZipCode, City."""
    df = replace_newlines(raw, "Address", "CompanyName")
    return split_address_column(_standard(df, on_error, rows), "Address")


def silver_customer_orders(raw: DataFrame, on_error: str = "fail", rows: int | None = None) -> DataFrame:
    """OrderID, CustomerID, productID, demandCategory, OrderDate (date), status,
    max_delivery_date (date)."""
    df = convert_column_types(remove_duplicate_rows(raw, rows), on_error)
    text = F.col("max_delivery_date")
    as_date = F.try_to_date(text) if on_error == "null" else F.to_date(text)
    df = df.withColumn("max_delivery_date", as_date).drop("Date")
    return fill_empty_fields(convert_date_format(df))


def silver_finished_goods(raw: DataFrame, on_error: str = "fail", rows: int | None = None) -> DataFrame:
    """productID, productSKU, Product_Inventory, Demand."""
    df = _standard(replace_newlines(raw, "demandCategory"), on_error, rows)
    return df.withColumnsRenamed({"demandCategory": "Demand", "inventory": "Product_Inventory"})


def silver_manufacturing_processes(raw: DataFrame, on_error: str = "fail", rows: int | None = None) -> DataFrame:
    """ProcessID, productID, FacilityID, ProcessingTime, Plant."""
    df = _standard(raw, on_error, rows).withColumnRenamed("processing_time", "ProcessingTime")
    return map_column_values(df, "FacilityID", PLANT_MAPPING, "Plant")


def silver_manufacturing_process_parts(raw: DataFrame, on_error: str = "fail", rows: int | None = None) -> DataFrame:
    """ProcessID (string), ProcessPartID, MaterialID (string), Req_Prod_Quant."""
    df = _standard(raw, on_error, rows).withColumnRenamed("Quantity", "Req_Prod_Quant")
    return df.withColumns(
        {"MaterialID": F.col("MaterialID").cast("string"), "ProcessID": F.col("ProcessID").cast("string")}
    )


def silver_material_master(raw: DataFrame, on_error: str = "fail", rows: int | None = None) -> DataFrame:
    """MaterialID (string), Mat_SKU, Mat_Inv."""
    df = _standard(raw, on_error, rows).withColumnRenamed("MaterialInventory", "Mat_Inv")
    return df.withColumn("MaterialID", F.col("MaterialID").cast("string")).withColumnRenamed(
        "SKU", "Mat_SKU"
    )


def demand_domain(
    orders: DataFrame,
    customers: DataFrame,
    hot_rows: int = 1_000_000,
    counted: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Orders with their customer's columns; orders of unknown customers stay
    (customer columns null). The demand category is dropped.

    One customer may place a large share of all orders: the join cuts such a
    customer's orders into pieces explicitly (``left_join_hot_left``) rather
    than relying on AQE's skew handling to notice it. Hot customers are counted
    in ``counted`` (the raw orders, say) if given, so that orders that are still
    to be cleaned are planned once. ``rows``, about how many orders there are,
    bounds the orders of a join task.
    """
    right = customers.withColumnRenamed("CustomerID", "_customer")
    output = (
        ["CustomerID"]
        + [c for c in orders.columns if c not in ("CustomerID", "demandCategory")]
        + [c for c in customers.columns if c != "CustomerID"]
    )
    return left_join_hot_left(orders, right, ["CustomerID"], ["_customer"], output, hot_rows, counted, rows)


MANUFACTURING_DOMAIN_COLUMNS = [
    "MaterialID",
    "ProcessID",
    "ProcessPartID",
    "Req_Prod_Quant",
    "productID",
    "productSKU",
    "Product_Inventory",
    "FacilityID",
    "ProcessingTime",
    "Plant",
    "Mat_SKU",
    "Mat_Inv",
]


def manufacturing_domain(
    goods: DataFrame,
    processes: DataFrame,
    parts: DataFrame,
    materials: DataFrame,
    hot_rows: int = 1_000_000,
    counted_parts: DataFrame | None = None,
    rows: int | None = None,
) -> DataFrame:
    """One row per product and process part, with process and material columns.

    Products without a process and processes without parts are kept (nulls);
    parts of unknown materials are kept; materials no part uses are absent.
    Part keys are text while process keys are int: the text is read as int
    with ``try_cast``, so a non-numeric key matches nothing instead of failing.
    Both the parts join (hot process on the right) and the material join (hot
    material on the left) split hot keys explicitly (``operators.joins``). Both
    count their keys in the parts table, not in the joins' results, so each
    join is planned once; ``counted_parts`` (the raw parts, say) may stand in
    for parts that are still to be cleaned. ``rows``, about how many parts there
    are, bounds the parts of a task of the parts join.
    """
    counted = parts if counted_parts is None else counted_parts
    part_keys = counted.select(
        F.col("MaterialID").cast("string").alias("MaterialID"), F.col("ProcessID").try_cast("int").alias("_part_process_int")
    )
    # a product may have very many processes: split it as well
    product_process = left_join_skew_safe(
        goods,
        processes.withColumnRenamed("productID", "_process_product"),
        ["productID"],
        ["_process_product"],
        goods.columns + [c for c in processes.columns if c != "productID"],
        hot_rows,
    )
    parts_keyed = parts.withColumnRenamed("ProcessID", "_part_process").withColumn(
        "_part_process_int", F.col("_part_process").try_cast("int")
    )
    # one process may own a large share of all parts: keep its rows splittable
    with_parts = left_join_skew_safe(
        product_process,
        parts_keyed,
        ["ProcessID"],
        ["_part_process_int"],
        product_process.columns + ["ProcessPartID", "MaterialID", "Req_Prod_Quant"],
        hot_rows,
        part_keys,
        rows,
    )
    # one material may be used by a large share of all parts: split it explicitly
    materials_keyed = materials.withColumnRenamed("MaterialID", "_material")
    with_materials = left_join_hot_left(
        with_parts,
        materials_keyed,
        ["MaterialID"],
        ["_material"],
        with_parts.columns + [c for c in materials.columns if c != "MaterialID"],
        hot_rows,
        part_keys,
    )
    return with_materials.select(*MANUFACTURING_DOMAIN_COLUMNS)
