"""Gold demand views over the demand domain (and the raw order reports).

All counts are hash aggregates with map-side partial aggregation, so a hot
key (one customer or product with a large share of orders) is combined on
the map side before the shuffle.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockflow.functions.derived import closure_probability, demand_share, max_delivery_date


def orders_by_customer(demand: DataFrame) -> DataFrame:
    """CustomerID, OrderCount (non-null OrderIDs)."""
    return demand.groupBy("CustomerID").agg(F.count("OrderID").alias("OrderCount"))


def orders_by_product(demand: DataFrame) -> DataFrame:
    """productID, OrderCount."""
    return demand.groupBy("productID").agg(F.count("OrderID").alias("OrderCount"))


def orders_by_status(demand: DataFrame) -> DataFrame:
    """status, OrderCount."""
    return demand.groupBy("status").agg(F.count("OrderID").alias("OrderCount"))


def orders_by_month(demand: DataFrame) -> DataFrame:
    """Month (1-12, all years merged; null dates form their own group), count."""
    return demand.groupBy(F.month("OrderDate").alias("Month")).count()


#: Table name, group column as the table names it, and what is counted: the
#: four order counts of the gold layer.
ORDER_COUNTS = {
    "orders_by_customer": ("CustomerID", "OrderCount"),
    "orders_by_product": ("productID", "OrderCount"),
    "orders_by_month": ("Month", "count"),
    "orders_by_status": ("status", "OrderCount"),
}


def order_counts(demand: DataFrame) -> DataFrame:
    """The four order counts in one pass over the demand domain, as grouping
    sets: a column per group column, ``OrderCount`` (non-null OrderIDs),
    ``count`` (rows) and ``table``, the name of the table a row belongs to.

    Every order enters the map-side hash aggregate once per grouping set, so a
    hot key is combined before the shuffle, which moves groups and no orders.
    The layered run keeps the four single counts: Parquet gives each of them
    its own column, and they were faster (README).
    """
    columns = [column for column, _ in ORDER_COUNTS.values()]
    groups = demand.select("CustomerID", "productID", F.month("OrderDate").alias("Month"), "status", "OrderID")
    counted = groups.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.count("OrderID").alias("OrderCount"), F.count(F.lit(1)).alias("count"), F.grouping_id().alias("_set")
    )
    # a set's number has a bit for each column that it leaves out, the first column's the highest
    every = (1 << len(columns)) - 1
    name = F.coalesce(
        *[F.when(F.col("_set") == every - (1 << (len(columns) - 1 - i)), t) for i, t in enumerate(ORDER_COUNTS)]
    )
    return counted.withColumn("table", name).drop("_set")


def order_count_table(counts: DataFrame, table: str) -> DataFrame:
    """One of the ``ORDER_COUNTS`` tables out of a materialised ``order_counts``."""
    return counts.where(F.col("table") == table).select(*ORDER_COUNTS[table])


def current_demand(demand: DataFrame) -> DataFrame:
    """The demand domain plus OrderYearMonth, the order date as 'yyyy-MM' text
    (the first seven characters of the date's text; no per-row formatter)."""
    return demand.withColumn("OrderYearMonth", F.substring(F.col("OrderDate").cast("string"), 1, 7))


def orders_by_demand_category(orders: DataFrame) -> DataFrame:
    """demandCategory, count; largest first."""
    return orders.groupBy("demandCategory").count().orderBy(F.desc("count"), "demandCategory")


def orders_by_year_month(orders: DataFrame, date_col: str = "OrderDate") -> DataFrame:
    """Year, Month, OrderCount (non-null OrderIDs), in calendar order."""
    d = F.col(date_col)
    return (
        orders.groupBy(F.year(d).alias("Year"), F.month(d).alias("Month"))
        .agg(F.count("OrderID").alias("OrderCount"))
        .orderBy("Year", "Month")
    )


def open_orders_by_month(orders: DataFrame, date_col: str = "OrderDate") -> DataFrame:
    """Month, status, count for open orders, all years merged.

    Filtering before grouping gives the same rows as grouping by (Month,
    status) and keeping 'open', and lets the filter reach the scan.
    """
    return (
        orders.where(F.col("status") == "open")
        .groupBy(F.month(date_col).alias("Month"), "status")
        .count()
        .orderBy("Month")
    )


def orders_latest_first(orders: DataFrame, date_col: str = "OrderDate") -> DataFrame:
    """All orders, newest first (a global range-partitioned sort)."""
    return orders.orderBy(F.col(date_col).desc(), "OrderID")


def with_max_delivery_date(orders: DataFrame, date_col: str = "OrderDate", days: int = 90) -> DataFrame:
    """Adds MaxDeliveryDate = order day + ``days``."""
    return orders.withColumn("MaxDeliveryDate", max_delivery_date(F.col(date_col), days))


def with_demand_share(goods: DataFrame, category_col: str = "Demand") -> DataFrame:
    """Adds saleProbability: the category's weight over the weight total."""
    return goods.withColumn("saleProbability", demand_share(F.col(category_col)))


def with_closure_probability(
    orders: DataFrame, as_of: dt.date | str | Column | None = None, date_col: str = "OrderDate"
) -> DataFrame:
    """Adds ClosureProbability: 10 + 30 per calendar month since the order,
    capped at 100 (percent)."""
    return orders.withColumn("ClosureProbability", closure_probability(F.col(date_col), as_of))
