import pytest
from pyspark.sql import functions as F

from stockflow.session import scratch_path
from stockflow.sources import catalog, jdbc
from stockflow.sources.bronze import bronze_ingest


def test_catalog_roundtrip(spark):
    root = scratch_path(spark, "test_catalog")
    db = catalog.ensure_database(spark, "stockflow_test_db", root)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    catalog.write_table(df, f"{db}.t", f"{root}/t")
    assert sorted(catalog.read_table(spark, f"{db}.t").collect()) == [(1, "a"), (2, "b")]
    # overwrite replaces rows and schema
    catalog.write_table(spark.createDataFrame([(3.5,)], "x double"), f"{db}.t", f"{root}/t")
    back = catalog.read_table(spark, f"{db}.t")
    assert back.columns == ["x"] and back.collect()[0].x == 3.5


def _folders(spark, path):
    return [x.rsplit("/", 1)[1] for x in catalog._versions(spark, path)]


def test_a_failing_write_leaves_the_table_as_it_was(spark):
    root = scratch_path(spark, "test_versions_fail")
    db = catalog.ensure_database(spark, "stockflow_test_versions_fail", root)
    good = spark.range(4).selectExpr("id AS k", "cast(id AS string) AS v")
    catalog.write_table(good, f"{db}.t", f"{root}/t")
    # one of four tasks fails while others have written their files
    bad = spark.range(0, 400, 1, 4).selectExpr("id AS k", "if(id > 390, cast(raise_error('lost') AS string), 'x') AS v")
    with pytest.raises(Exception, match="lost"):
        catalog.write_table(bad, f"{db}.t", f"{root}/t")
    assert sorted(catalog.read_table(spark, f"{db}.t").collect()) == [(k, str(k)) for k in range(4)]


def test_a_reader_of_the_version_before_goes_on(spark):
    root = scratch_path(spark, "test_versions_read")
    db = catalog.ensure_database(spark, "stockflow_test_versions_read", root)
    name, path = f"{db}.t", f"{root}/t"
    catalog.write_table(spark.range(3), name, path)
    before = catalog.read_table(spark, name)
    # even a plan that reads the table may replace it
    catalog.write_table(before.selectExpr("id + 10 AS id"), name, path)
    assert sorted(r.id for r in before.collect()) == [0, 1, 2]
    assert sorted(r.id for r in catalog.read_table(spark, name).collect()) == [10, 11, 12]
    catalog.write_table(spark.range(1), name, path)
    assert len(_folders(spark, path)) == catalog.KEPT_VERSIONS
    catalog.write_table(spark.createDataFrame([("a", 1.5)], "s string, x double"), name, path, keep=1)
    assert catalog.read_table(spark, name).collect() == [("a", 1.5)] and len(_folders(spark, path)) == 1


def test_partitioned_and_empty_tables_are_versions_too(spark):
    root = scratch_path(spark, "test_versions_parts")
    db = catalog.ensure_database(spark, "stockflow_test_versions_parts", root)
    for n in (3, 2):
        rows = spark.range(n).selectExpr("id", "id % 2 AS p")
        catalog.write_table(rows, f"{db}.t", f"{root}/t", partition_by=["p"])
        assert sorted(catalog.read_table(spark, f"{db}.t").select("id").collect()) == [(k,) for k in range(n)]
    catalog.write_table(spark.range(0), f"{db}.e", f"{root}/e")
    assert catalog.read_table(spark, f"{db}.e").count() == 0


def test_ingest_notices_lost_and_changed_values(spark, monkeypatch):
    from stockflow.sources import bronze

    source = spark.createDataFrame([(1, "a", None), (2, None, "x"), (2, None, "x")], "k bigint, v string, `w v` string")
    found = {r.column_name: (r.row_count, r.non_nulls) for r in bronze.content(source, "t").collect()}
    assert found == {"k": (3, 3), "v": (3, 1), "w v": (3, 2)}
    root = scratch_path(spark, "test_ingest_content")
    run = lambda: bronze_ingest(spark, lambda t: source, "stockflow_test_content", root, tables=["t"])
    run()
    read = catalog.read_table
    for broken in (lambda df: df.limit(2), lambda df: df.withColumn("v", F.lit("b")), lambda df: df.drop("v")):
        monkeypatch.setattr(bronze, "read_table", lambda s, n, broken=broken: broken(read(s, n)))
        with pytest.raises(ValueError, match="does not hold"):
            run()


def test_drop_database_needs_confirmation(spark):
    with pytest.raises(ValueError):
        catalog.drop_database(spark, "stockflow_test_drop")
    catalog.ensure_database(spark, "stockflow_test_drop", scratch_path(spark, "test_drop"))
    catalog.drop_database(spark, "stockflow_test_drop", confirm=True)
    assert "stockflow_test_drop" not in [d.name for d in spark.catalog.listDatabases()]


def test_identifiers_are_checked(spark):
    with pytest.raises(ValueError):
        catalog.read_table(spark, "x; DROP TABLE y")


def test_bronze_ingest_copies_tables(spark):
    sources = {
        "a": spark.createDataFrame([(1,)], "k bigint"),
        "b": spark.createDataFrame([("x",), ("y",)], "s string"),
    }
    root = scratch_path(spark, "test_bronze")
    written = bronze_ingest(spark, sources.__getitem__, "stockflow_test_bronze", root, tables=["a", "b"])
    assert catalog.read_table(spark, written["b"]).count() == 2
    assert catalog.read_table(spark, written["a"]).dtypes == [("k", "bigint")]


def test_bronze_accepts_a_database_timestamp(spark):
    from stockflow import schemas

    ddl = schemas.INPUTS["customer_orders"].replace("timestamp_ntz", "timestamp")
    source = spark.createDataFrame([], ddl)
    schemas.check_schema(source, schemas.INPUTS["customer_orders"])
    with pytest.raises(ValueError, match="OrderDate"):
        schemas.check_schema(source.withColumn("OrderDate", source["Date"]), schemas.INPUTS["customer_orders"])


def test_jdbc_predicates():
    assert jdbc.check_predicates(None, {}) is None
    assert jdbc.check_predicates(("k < 'm'", "k >= 'm' OR k IS NULL"), {}) == ["k < 'm'", "k >= 'm' OR k IS NULL"]
    for wrong in ("k = 1", []):
        with pytest.raises(ValueError):
            jdbc.check_predicates(wrong, {})
    with pytest.raises(ValueError):
        jdbc.check_predicates(["k = 1"], {"partitionColumn": "k"})


def test_cluster_without_checkpoint_dir_is_refused():
    from types import SimpleNamespace

    from stockflow.session import checkpoint_dir

    context = SimpleNamespace(
        getCheckpointDir=lambda: None, master="spark://host:7077", getConf=lambda: SimpleNamespace(get=lambda k, d: d)
    )
    session = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d: d))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


def test_empty_status_is_the_same_lazily_and_stored(spark):
    from stockflow.operators import demand, silver
    from stockflow.plans.layered import Layout, LayeredRun

    raw = spark.createDataFrame(
        [(1, "C", 1, "High", None, None, "2024-01-01", "2024-01-01"), (2, "C", 1, "High", None, "open", "2024-01-01", "2024-01-01"),
         (3, "C", 1, "High", None, "closed", "2024-01-01", "2024-01-01")],
        "OrderID bigint, CustomerID string, productID bigint, demandCategory string, OrderDate timestamp_ntz,"
        " status string, max_delivery_date string, Date string",
    )
    customers = spark.createDataFrame([("C", "Co", "S 1", "1", "X")], "CustomerID string, CompanyName string, Street string, ZipCode string, City string")
    domain = silver.demand_domain(silver.silver_customer_orders(raw), customers)
    run = LayeredRun(spark, Layout(root=scratch_path(spark, "test_status"), prefix="stockflow_test_status_"))
    run.save(domain, "silver", "demand_domain")
    stored = demand.orders_by_status(run.table("silver", "demand_domain")).collect()
    assert sorted(stored) == sorted(demand.orders_by_status(domain).collect()) == [("", 1), ("closed", 1), ("open", 1)]


def test_jdbc_options_plain_and_partitioned():
    plain = jdbc.jdbc_options("jdbc:x://h/db", "orders", user="u", password="p")
    assert plain == {"url": "jdbc:x://h/db", "dbtable": "orders", "user": "u", "password": "p"}
    split = jdbc.jdbc_options(
        "jdbc:x://h/db", "orders", partition_column="OrderID", lower_bound=1, upper_bound=10_000,
        num_partitions=8, fetch_size=10_000,
    )
    assert split["partitionColumn"] == "OrderID" and split["numPartitions"] == "8"
    assert split["lowerBound"] == "1" and split["upperBound"] == "10000" and split["fetchsize"] == "10000"
    with pytest.raises(ValueError):
        jdbc.jdbc_options("jdbc:x://h/db", "orders", partition_column="OrderID")
