"""Catalog databases and tables (managed-by-path tables, full overwrite by versions).

Tables are written with an explicit path, like external tables, so data lands
in shared storage chosen by the caller; the catalog only records the name.
Parquet is the default format (``fmt`` selects another installed source).
"""

from __future__ import annotations

import re
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*$")


def _ident(name: str) -> str:
    parts = name.split(".")
    for p in parts:
        if not _IDENT.match(p):
            raise ValueError(f"not a plain identifier: {name!r}")
    return ".".join(f"`{p}`" for p in parts)


def ensure_database(spark: SparkSession, name: str, location: str | None = None) -> str:
    """CREATE DATABASE IF NOT EXISTS, optionally at a storage location."""
    sql = f"CREATE DATABASE IF NOT EXISTS {_ident(name)}"
    if location:
        sql += " LOCATION '" + location.replace("'", "''") + "'"
    spark.sql(sql)
    return name


def drop_database(spark: SparkSession, name: str, *, confirm: bool = False) -> None:
    """DROP DATABASE IF EXISTS ... CASCADE: removes every table in it.
    Runs only with ``confirm=True``."""
    if not confirm:
        raise ValueError("drop_database removes all tables; pass confirm=True")
    spark.sql(f"DROP DATABASE IF EXISTS {_ident(name)} CASCADE")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table as a DataFrame (filters and projections reach the scan)."""
    return spark.table(_ident(name))


#: Folder name of one written version of a table, and how many of them stay.
VERSION = "v-"
KEPT_VERSIONS = 2


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The version folders under a table's path, oldest first."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    return sorted(x.getPath().toString() for x in fs.listStatus(folder) if x.getPath().getName().startswith(VERSION))


def drop_old_versions(spark: SparkSession, path: str, keep: int = KEPT_VERSIONS) -> list[str]:
    """Remove all but the newest ``keep`` versions; what was removed. A plan
    made while a version was the newest can be run as long as it is kept."""
    if keep < 1:
        raise ValueError("the newest version must stay")
    removed = _versions(spark, path)[:-keep]
    for old in removed:
        folder = spark._jvm.org.apache.hadoop.fs.Path(old)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    return removed


def _switch(spark: SparkSession, name: str, location: str, fmt: str, df: DataFrame, partition_by: list[str]) -> None:
    """Let the catalog's table ``name`` name the written version."""
    ident = _ident(name)
    old = spark.table(ident).schema if spark.catalog.tableExists(name) else None
    shape = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema]
    if old is not None and not partition_by and shape(old) == shape(df.schema):
        spark.sql(f"ALTER TABLE {ident} SET LOCATION '{location.replace(chr(39), chr(39) * 2)}'")
    else:
        # external: dropping the entry leaves the old version's files alone
        spark.sql(f"DROP TABLE IF EXISTS {ident}")
        columns = ", ".join(f"`{f.name.replace('`', '``')}` {f.dataType.simpleString()}" for f in df.schema)
        parts = f" PARTITIONED BY ({', '.join(f'`{c}`' for c in partition_by)})" if partition_by else ""
        spark.sql(f"CREATE TABLE {ident} ({columns}) USING {fmt}{parts} LOCATION '{location.replace(chr(39), chr(39) * 2)}'")
        if partition_by:
            spark.sql(f"ALTER TABLE {ident} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def write_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    fmt: str = "parquet",
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    keep: int = KEPT_VERSIONS,
) -> str:
    """Save ``df`` as table ``name`` (schema replaced on overwrite).

    With a path, an overwrite is written as a new version in a folder of its
    own under it, and only when that is complete does the catalog's entry
    change to it. A failed write leaves the table as it was; a plan that reads
    the version before goes on reading it (``keep`` versions stay), so a table
    may even be overwritten from a plan that reads it. With an unchanged schema
    the switch is one catalog operation; a changed schema replaces the entry.

    Formats with transactions of their own (delta) and tables without a path
    are left to Spark's writer.
    """
    spark = df.sparkSession
    writer = df.write.format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path and mode == "overwrite" and fmt != "delta":
        version = f"{path}/{VERSION}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
        writer.mode("error").save(version)
        _switch(spark, name, version, fmt, df, list(partition_by or ()))
        drop_old_versions(spark, path, keep)
        return name
    writer = writer.mode(mode)
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(_ident(name))
    return name
