"""Gold inventory views over the manufacturing domain."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.functions.cleaning import fill_numeric_zero
from stockflow.functions.derived import safety_stock
from stockflow.operators.ranking import sequence_number

TOP_N = 100


def inventory_table(domain: DataFrame) -> DataFrame:
    """The manufacturing domain as published in the gold layer (same rows)."""
    return domain


def processing_time_by_product(domain: DataFrame) -> DataFrame:
    """productID, TotalProcessingTime: the process time summed over the
    product's part rows (each part counts the time again)."""
    return domain.groupBy("productID").agg(F.sum("ProcessingTime").alias("TotalProcessingTime"))


def avg_processing_time_by_facility(domain: DataFrame) -> DataFrame:
    """FacilityID, AvgProcessingTime over the same part rows."""
    return domain.groupBy("FacilityID").agg(F.avg("ProcessingTime").alias("AvgProcessingTime"))


def inventory_levels(domain: DataFrame) -> DataFrame:
    """Distinct (MaterialID, Mat_SKU, Mat_Inv) of the materials in use."""
    return domain.select("MaterialID", "Mat_SKU", "Mat_Inv").dropDuplicates()


def inventory_level_count(domain: DataFrame) -> DataFrame:
    """One row: the number of distinct inventory levels."""
    return inventory_levels(domain).agg(F.count(F.lit(1)).alias("InventoryLevelCount"))


def missing_inventory(demand: DataFrame, domain: DataFrame, reserve: int = 50) -> DataFrame:
    """productID, ProductsOrdered, Product_Inventory, Difference.

    Stock is the product inventory above a safety reserve; ProductsOrdered
    counts the product's open order rows; Difference = stock - ordered
    (negative means a shortage). Missing counts and stocks become 0.

    The domain has one row per part, but only product-level columns are used,
    so it is reduced to distinct (product, stock) rows before the join rather
    than joined at part grain and deduplicated after.
    """
    stock = domain.select(
        "productID", safety_stock(F.col("Product_Inventory"), reserve).alias("Product_Inventory")
    ).dropDuplicates()
    ordered = (
        demand.where(F.col("status") == "open")
        .groupBy("productID")
        .agg(F.count("productID").alias("ProductsOrdered"))
    )
    joined = stock.join(ordered, "productID", "left").select(
        "productID", "ProductsOrdered", "Product_Inventory"
    )
    filled = fill_numeric_zero(joined)
    return filled.withColumn(
        "Difference", F.col("Product_Inventory") - F.col("ProductsOrdered")
    ).dropDuplicates()


def top_processing_time(domain: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n products with the most processing time (ties by productID)."""
    return (
        processing_time_by_product(domain)
        .orderBy(F.desc("TotalProcessingTime"), F.asc("productID"))
        .limit(n)
    )


def top_facilities(domain: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n facilities with the highest average processing time."""
    return (
        avg_processing_time_by_facility(domain)
        .orderBy(F.desc("AvgProcessingTime"), F.asc("FacilityID"))
        .limit(n)
    )


def top_missing_inventory(missing: DataFrame, n: int = TOP_N) -> DataFrame:
    """The n rows with the highest productID."""
    return missing.orderBy(
        F.desc("productID"),
        F.asc("ProductsOrdered"),
        F.asc("Product_Inventory"),
        F.asc("Difference"),
    ).limit(n)


def process_numbering(goods: DataFrame, partitions: int | None = None) -> DataFrame:
    """ProcessID = 1.. in productID order, productID. One process per product."""
    numbered = sequence_number(goods.select("productID"), ["productID"], name="ProcessID", partitions=partitions)
    return numbered.select(F.col("ProcessID").cast("int").alias("ProcessID"), "productID")


def bom_part_ids(parts: DataFrame, partitions: int | None = None) -> DataFrame:
    """ProcessID, MaterialID, ProcessPartID = '{ProcessID}_{n}' where n = 1..
    numbers the process's materials in MaterialID order."""
    numbered = sequence_number(
        parts.select("ProcessID", "MaterialID"),
        ["MaterialID"],
        segment=["ProcessID"],
        name="_n",
        partitions=partitions,
    )
    return numbered.select(
        "ProcessID",
        "MaterialID",
        F.concat_ws("_", F.col("ProcessID").cast("string"), F.col("_n").cast("string")).alias(
            "ProcessPartID"
        ),
    )
