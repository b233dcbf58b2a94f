"""Bronze ingest: copy each operational table, unchanged, into a catalog table."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stockflow.schemas import check_schema
from stockflow.sources.catalog import ensure_database, read_table, write_table

BRONZE_TABLES = [
    "customers",
    "customer_orders",
    "finished_goods",
    "manufacturing_processes",
    "manufacturing_process_parts",
    "material_master",
]


def content_checks(columns: Sequence[str]) -> list[Column]:
    """Aggregates that tell a table's content whatever the order of its rows:
    the row count and, per column, the non-null count and the sum of the first
    32 bits of the values' MD5 (of their text)."""
    checks = [F.count(F.lit(1)).alias("rows")]
    for k, name in enumerate(columns):
        value = F.col(f"`{name}`").cast("string")
        bits = F.conv(F.substring(F.md5(value), 1, 8), 16, 10).cast("long")
        checks += [F.count(value).alias(f"non_nulls_{k}"), F.coalesce(F.sum(bits), F.lit(0)).alias(f"checksum_{k}")]
    return checks


def content(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, row_count, non_nulls, checksum), one row per column."""
    rows = [
        F.struct(
            F.lit(name).alias("column_name"), F.col("rows").alias("row_count"),
            F.col(f"non_nulls_{k}").alias("non_nulls"), F.col(f"checksum_{k}").alias("checksum"),
        )
        for k, name in enumerate(df.columns)
    ]
    checked = df.agg(*content_checks(df.columns)).select(F.explode(F.array(*rows)).alias("c"))
    return checked.select(F.lit(table_name).alias("table_name"), "c.*")


def bronze_ingest(
    spark: SparkSession,
    read: Callable[[str], DataFrame],
    database: str,
    location: str,
    tables: Sequence[str] = BRONZE_TABLES,
    fmt: str = "parquet",
    schemas: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """For each table name: ``read(name)`` (e.g. a JDBC read) and save it as
    ``database.name`` under ``location/name``. Returns name -> table.

    With ``schemas`` (name -> DDL, e.g. ``stockflow.schemas.INPUTS``) each
    source is checked against its declared schema before anything is written.

    The content (``content_checks``) is observed while a table is written and
    held against the table as read back; lost or changed values are an error.
    """
    ensure_database(spark, database, location)
    written = {}
    for name in tables:
        df = read(name)
        if schemas and name in schemas:
            check_schema(df, schemas[name], f"source table {name}")
        seen = Observation(f"ingest {name} {uuid.uuid4().hex}")
        observed = df.observe(seen, *content_checks(df.columns))
        written[name] = write_table(observed, f"{database}.{name}", f"{location}/{name}", fmt)
        back = read_table(spark, written[name])
        stored = back.agg(*content_checks(df.columns)).first().asDict() if back.columns == df.columns else back.columns
        if stored != seen.get:
            raise ValueError(f"table {written[name]} does not hold what was read: {seen.get} written, {stored} found")
    return written
