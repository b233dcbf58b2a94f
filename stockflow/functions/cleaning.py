"""Column cleaning functions, each ``DataFrame -> DataFrame`` for ``.transform``.

Every function adds at most one projection: type-driven rules read
``df.schema`` once and emit a single ``select``/``withColumns``, so the
analyzer runs once per call rather than once per column.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockflow.session import tasks_for

WIDE_INTEGRAL = (T.LongType, T.ByteType, T.ShortType)
WIDE_FRACTIONAL = (T.DecimalType, T.DoubleType)
CHAR_TYPES = (T.CharType, T.VarcharType)
DATE_LIKE = (T.DateType, T.TimestampType, T.TimestampNTZType)


def replace_newlines(df: DataFrame, *columns: str) -> DataFrame:
    """Every newline in the named columns becomes one space; null stays null."""
    return df.withColumns({c: F.regexp_replace(F.col(c), "\n", " ") for c in columns})


def remove_duplicate_rows(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Distinct over all columns (a two-phase hash aggregate).

    With ``rows``, about how many rows there are, the rows are dealt by a hash
    of all columns to tasks of a bounded number of rows before they are
    aggregated. Without it they are combined map-side first: most rows being
    distinct, a task then holds nearly all rows of its split, and a split grows
    with the input.
    """
    if rows is not None:
        df = df.repartition(tasks_for(df.sparkSession, rows), *df.columns)
    return df.dropDuplicates()


def _cast(column: str, to: T.DataType, on_error: str) -> Column:
    c = F.col(column)
    return c.try_cast(to) if on_error == "null" else c.cast(to)


def convert_column_types(df: DataFrame, on_error: str = "fail") -> DataFrame:
    """Narrow types: bigint/tinyint/smallint -> int, decimal/double -> float,
    char/varchar -> string; other columns untouched.

    A value that does not fit (bigint beyond int) fails the query under ANSI
    mode; ``on_error="null"`` turns it into null instead.
    """
    casts: dict[str, Column] = {}
    for field in df.schema.fields:
        dtype = field.dataType
        if isinstance(dtype, WIDE_INTEGRAL):
            casts[field.name] = _cast(field.name, T.IntegerType(), on_error)
        elif isinstance(dtype, WIDE_FRACTIONAL):
            casts[field.name] = _cast(field.name, T.FloatType(), on_error)
        elif isinstance(dtype, CHAR_TYPES):
            casts[field.name] = F.col(field.name).cast(T.StringType())
    return df.withColumns(casts) if casts else df


def convert_date_format(df: DataFrame) -> DataFrame:
    """Date, timestamp and timestamp_ntz columns become dates (time of day dropped)."""
    casts = {
        f.name: F.col(f.name).cast(T.DateType())
        for f in df.schema.fields
        if isinstance(f.dataType, DATE_LIKE) and not isinstance(f.dataType, T.DateType)
    }
    return df.withColumns(casts) if casts else df


def fill_empty_fields(df: DataFrame) -> DataFrame:
    """Nulls become '' in string columns, 0 in int columns and 0.0 in float
    columns (float NaN too). bigint, double, date and boolean keep their nulls."""
    defaults: dict[str, object] = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StringType) and not isinstance(f.dataType, CHAR_TYPES):
            defaults[f.name] = ""
        elif isinstance(f.dataType, T.IntegerType):
            defaults[f.name] = 0
        elif isinstance(f.dataType, T.FloatType):
            defaults[f.name] = 0.0
    return df.fillna(defaults) if defaults else df


def fill_numeric_zero(df: DataFrame) -> DataFrame:
    """Nulls become 0 in every numeric column; strings and dates untouched."""
    return df.fillna(0)


def map_column_values(
    df: DataFrame, column_name: str, mapping: Mapping[object, object], new_column_name: str
) -> DataFrame:
    """``new_column_name`` = mapping[value] when the value is a key, else the value."""
    source = F.col(column_name)
    expr: Column = source
    if mapping:
        items = list(mapping.items())
        expr = F.when(source == F.lit(items[0][0]), F.lit(items[0][1]))
        for key, value in items[1:]:
            expr = expr.when(source == F.lit(key), F.lit(value))
        expr = expr.otherwise(source)
    return df.withColumn(new_column_name, expr)


def map_column_values_typed(df: DataFrame, column_name: str, mapping: Mapping[object, object]) -> DataFrame:
    """Replace values in place. The column becomes int when every mapped value
    is an int, else string; unmapped values keep their text (9 -> '9')."""
    all_int = all(isinstance(v, int) and not isinstance(v, bool) for v in mapping.values())
    out_type = T.IntegerType() if all_int else T.StringType()
    source = F.col(column_name)
    if not mapping:
        return df.withColumn(column_name, source.cast(out_type))
    items = list(mapping.items())
    expr = F.when(source == F.lit(items[0][0]), F.lit(items[0][1]).cast(out_type))
    for key, value in items[1:]:
        expr = expr.when(source == F.lit(key), F.lit(value).cast(out_type))
    return df.withColumn(column_name, expr.otherwise(source.cast(out_type)))


def split_address_column(df: DataFrame, address_column: str) -> DataFrame:
    """Split an address on single spaces: Street = first two tokens,
    ZipCode = next-to-last token, City = last token; the address is dropped.

    The rule is naive on purpose (multi-word cities split wrongly). Short
    addresses give null tokens rather than errors.
    """
    parts = F.split(F.col(address_column), " ")
    n = F.size(parts)
    return df.withColumns(
        {
            "Street": F.concat_ws(" ", F.get(parts, 0), F.get(parts, 1)),
            "ZipCode": F.get(parts, n - 2),
            "City": F.get(parts, n - 1),
        }
    ).drop(address_column)
