import datetime as dt

from stockflow.operators import silver


def test_silver_customers_pipeline(spark):
    raw = spark.createDataFrame(
        [("1", "Weg 1\n8000 Zurich", "A\nAG"), ("1", "Weg 1\n8000 Zurich", "A\nAG"), ("2", None, None)],
        "CustomerID string, Address string, CompanyName string",
    )
    out = silver.silver_customers(raw)
    assert out.columns == ["CustomerID", "CompanyName", "Street", "ZipCode", "City"]
    rows = sorted(out.collect())
    assert rows == [("1", "A AG", "Weg 1", "8000", "Zurich"), ("2", "", "", None, "")]


def test_silver_orders_dedupes_before_truncating(spark):
    raw = spark.createDataFrame(
        [
            (1, "c", 7, "High", dt.datetime(2024, 1, 1, 8), "open", "2024-03-31", "2024-01-01"),
            (1, "c", 7, "High", dt.datetime(2024, 1, 1, 9), "open", "2024-03-31", "2024-01-01"),
        ],
        "OrderID bigint, CustomerID string, productID bigint, demandCategory string, OrderDate timestamp_ntz,"
        " status string, max_delivery_date string, Date string",
    )
    out = silver.silver_customer_orders(raw)
    assert out.dtypes == [
        ("OrderID", "int"), ("CustomerID", "string"), ("productID", "int"), ("demandCategory", "string"),
        ("OrderDate", "date"), ("status", "string"), ("max_delivery_date", "date"),
    ]
    # the two rows differ only in time of day: both stay
    assert out.count() == 2


def _domain_inputs(spark):
    goods = spark.createDataFrame(
        [(1, "AA000001", 10, "High"), (2, "AA000002", 20, "Low"), (3, "AA000003", 30, "Low")],
        "productID int, productSKU string, Product_Inventory int, Demand string",
    )
    processes = spark.createDataFrame(
        [(2, 1, "Facility 1", 3, "Plant Chur"), (3, 2, "Facility 3", 4, "Plant Basel-Therwil")],
        "ProcessID int, productID int, FacilityID string, ProcessingTime int, Plant string",
    )
    parts = spark.createDataFrame(
        [("2", "2_1", "10", 1), ("2", "2_2", "99", 2)],
        "ProcessID string, ProcessPartID string, MaterialID string, Req_Prod_Quant int",
    )
    materials = spark.createDataFrame(
        [("10", "M0000010", 5), ("11", "M0000011", 6)], "MaterialID string, Mat_SKU string, Mat_Inv int"
    )
    return goods, processes, parts, materials


def test_manufacturing_domain_keeps_and_drops(spark):
    out = silver.manufacturing_domain(*_domain_inputs(spark))
    assert out.columns == silver.MANUFACTURING_DOMAIN_COLUMNS
    rows = {(r.productID, r.ProcessPartID): r for r in out.collect()}
    assert set(rows) == {(1, "2_1"), (1, "2_2"), (2, None), (3, None)}
    assert rows[(1, "2_1")].Mat_SKU == "M0000010"
    assert rows[(1, "2_2")].Mat_SKU is None  # unknown material: kept with nulls
    assert rows[(2, None)].ProcessID == 3  # process without parts: kept
    assert rows[(3, None)].ProcessID is None  # product without process: kept
    assert "11" not in {r.MaterialID for r in out.collect()}  # unused material: absent


def test_demand_domain_keeps_unknown_customer(spark):
    orders = spark.createDataFrame(
        [(1, "c1", 5, "High", dt.date(2024, 1, 1), "open", dt.date(2024, 3, 31)),
         (2, "zz", 5, "High", dt.date(2024, 1, 2), "open", dt.date(2024, 4, 1))],
        "OrderID int, CustomerID string, productID int, demandCategory string, OrderDate date, status string,"
        " max_delivery_date date",
    )
    customers = spark.createDataFrame(
        [("c1", "Co", "Weg 1", "8000", "Zurich")], "CustomerID string, CompanyName string, Street string,"
        " ZipCode string, City string"
    )
    out = silver.demand_domain(orders, customers)
    assert out.columns == ["CustomerID", "OrderID", "productID", "OrderDate", "status", "max_delivery_date",
                           "CompanyName", "Street", "ZipCode", "City"]
    rows = {r.OrderID: r for r in out.collect()}
    assert rows[1].City == "Zurich" and rows[2].City is None
