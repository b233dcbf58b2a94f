"""JDBC source and sink.

A plain JDBC read is one query on one connection, so one task reads the
whole table. With ``partition_column`` and bounds the read is split into
``num_partitions`` range queries run in parallel (the column must be numeric,
date or timestamp; the bounds only set the stride, no row is filtered out).
Writes use one connection per partition; ``num_partitions`` caps them.
Credentials are passed by the caller, never read from files here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def jdbc_options(
    url: str,
    table: str,
    user: str | None = None,
    password: str | None = None,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int | None = None,
    fetch_size: int | None = None,
    batch_size: int | None = None,
    extra: dict[str, str] | None = None,
) -> dict[str, str]:
    opts: dict[str, str] = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
        )
    if num_partitions:
        opts["numPartitions"] = str(num_partitions)
    if fetch_size:
        opts["fetchsize"] = str(fetch_size)
    if batch_size:
        opts["batchsize"] = str(batch_size)
    opts.update(extra or {})
    return opts


def check_predicates(predicates: Sequence[str] | None, options: dict[str, str]) -> list[str] | None:
    """The predicates as a list; they exclude a split by column."""
    if predicates is None:
        return None
    if "partitionColumn" in options:
        raise ValueError("give either predicates or partition_column, not both")
    if isinstance(predicates, str) or not predicates:
        raise ValueError("predicates must be a non-empty list of conditions, one per task")
    return list(predicates)


def read_jdbc(
    spark: SparkSession, url: str, table: str, predicates: Sequence[str] | None = None, **kwargs
) -> DataFrame:
    """Read a whole database table (see ``jdbc_options`` for parallel reads).
    ``predicates`` splits a table by any key, text too: one task per SQL
    condition. The conditions must cover every row once (mind null keys)."""
    options = jdbc_options(url, table, **kwargs)
    conditions = check_predicates(predicates, options)
    if conditions:
        rest = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
        return spark.read.jdbc(url, table, predicates=conditions, properties=rest)
    return spark.read.format("jdbc").options(**options).load()


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", **kwargs) -> None:
    """Write ``df`` to a database table, replacing it by default."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **kwargs)).mode(mode).save()
