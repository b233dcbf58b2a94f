import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from stockflow.functions import cleaning


def test_replace_newlines(spark):
    df = spark.createDataFrame([("a\nb\nc",), (None,)], "s string")
    out = [r.s for r in cleaning.replace_newlines(df, "s").collect()]
    assert out == ["a b c", None]


def test_remove_duplicate_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a")], "k int, v string")
    assert sorted(cleaning.remove_duplicate_rows(df).collect()) == [(1, "a"), (2, "a")]


def test_narrowing_types(spark):
    schema = "b bigint, d decimal(4,2), x double, s smallint, f boolean, day date"
    df = spark.createDataFrame([(5, Decimal("1.10"), 2.5, 3, True, dt.date(2024, 1, 1))], schema)
    out = cleaning.convert_column_types(df)
    assert out.dtypes == [("b", "int"), ("d", "float"), ("x", "float"), ("s", "int"), ("f", "boolean"), ("day", "date")]
    row = out.first()
    assert row.b == 5 and abs(row.d - 1.1) < 1e-6 and row.x == 2.5 and row.s == 3


def test_narrowing_overflow(spark):
    df = spark.createDataFrame([(2**40,)], "b bigint")
    with pytest.raises(Exception):
        cleaning.convert_column_types(df).collect()
    assert cleaning.convert_column_types(df, on_error="null").first().b is None


def test_fill_empty_fields(spark):
    schema = "s string, i int, f float, n float, b bigint, d double, day date, flag boolean"
    df = spark.createDataFrame([(None, None, None, float("nan"), None, None, None, None)], schema)
    row = cleaning.fill_empty_fields(df).first()
    assert (row.s, row.i, row.f, row.n) == ("", 0, 0.0, 0.0)
    assert row.b is None and row.d is None and row.day is None and row.flag is None


def test_fill_numeric_zero(spark):
    df = spark.createDataFrame([(None, None, None, None)], "b bigint, d double, s string, day date")
    row = cleaning.fill_numeric_zero(df).first()
    assert row.b == 0 and row.d == 0.0 and row.s is None and row.day is None


def test_convert_date_format(spark):
    schema = T.StructType([
        T.StructField("ts", T.TimestampType()), T.StructField("ntz", T.TimestampNTZType()),
        T.StructField("day", T.DateType()), T.StructField("s", T.StringType()),
    ])
    moment = dt.datetime(2024, 3, 4, 13, 30)
    df = spark.createDataFrame([(moment, moment, dt.date(2024, 3, 4), "2024-03-04")], schema)
    out = cleaning.convert_date_format(df)
    assert out.dtypes == [("ts", "date"), ("ntz", "date"), ("day", "date"), ("s", "string")]
    assert out.first().ntz == dt.date(2024, 3, 4)


def test_map_column_values(spark):
    df = spark.createDataFrame([("Facility 1",), ("Facility 9",), (None,)], "f string")
    mapping = {"Facility 1": "Plant Chur", "Facility 2": "Plant Chur"}
    out = [r.p for r in cleaning.map_column_values(df, "f", mapping, "p").collect()]
    assert out == ["Plant Chur", "Facility 9", None]


def test_map_column_values_typed(spark):
    df = spark.createDataFrame([(3,), (9,), (None,)], "t int")
    out = cleaning.map_column_values_typed(df, "t", {3: "low"})
    assert out.dtypes == [("t", "string")]
    assert [r.t for r in out.collect()] == ["low", "9", None]
    ints = cleaning.map_column_values_typed(df, "t", {3: 30})
    assert ints.dtypes == [("t", "int")] and [r.t for r in ints.collect()] == [30, 9, None]


@pytest.mark.parametrize(
    "address, expected",
    [
        ("Weg 1 8000 Zurich", ("Weg 1", "8000", "Zurich")),
        ("X", ("X", None, "X")),
        ("", ("", None, "")),
        ("Rue de la Gare 5 1200 La Chaux", ("Rue de", "La", "Chaux")),
    ],
)
def test_split_address(spark, address, expected):
    df = spark.createDataFrame([(1, address)], "id int, a string")
    out = cleaning.split_address_column(df, "a")
    assert out.columns == ["id", "Street", "ZipCode", "City"]
    r = out.first()
    assert (r.Street, r.ZipCode, r.City) == expected
