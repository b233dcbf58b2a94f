"""Every input, silver and gold frame has its declared schema."""

import pytest

from small_data import SF_SMALL
from stockflow import schemas
from stockflow.operators import demand, inventory, production
from stockflow.plans.registry import ENTRY_AS_OF, Layers
from stockflow.sources import fixtures


@pytest.fixture(scope="module")
def layers(spark):
    return Layers(spark, SF_SMALL)


@pytest.mark.parametrize("name", sorted(schemas.INPUTS))
def test_inputs(spark, name):
    schemas.check_schema(fixtures.RAW_TABLES[name](spark, SF_SMALL), schemas.INPUTS[name], name)


def test_silver(layers):
    frames = {
        "customers": layers.customers(), "customer_orders": layers.orders(), "finished_goods": layers.goods(),
        "manufacturing_processes": layers.processes(), "manufacturing_process_parts": layers.parts(),
        "material_master": layers.materials(), "demand_domain": layers.demand_domain(),
        "manufacturing_domain": layers.manufacturing_domain(),
    }
    for name, df in frames.items():
        schemas.check_schema(df, schemas.SILVER[name], name)


def test_gold(layers):
    dd = layers.demand_domain()
    frames = {
        "orders_by_customer": demand.orders_by_customer(dd), "orders_by_product": demand.orders_by_product(dd),
        "orders_by_month": demand.orders_by_month(dd), "orders_by_status": demand.orders_by_status(dd),
        "current_demand": layers.current_demand(), "inventory_table": layers.manufacturing_domain(),
        "missing_inventory": layers.missing_inventory(), "manufacturing_job_list": layers.jobs(),
        "manufacturing_delay_alerts": production.delay_alerts(layers.schedule(ENTRY_AS_OF)),
    }
    for name, df in frames.items():
        schemas.check_schema(df, schemas.GOLD[name], name)


def test_mismatch_is_reported(spark):
    df = spark.createDataFrame([(1, "a")], "a bigint, b string")
    with pytest.raises(ValueError, match="a: bigint instead of int"):
        schemas.check_schema(df, "a int, b string")
    assert schemas.schema_differences(df, "b string, a bigint")[0].startswith("column order")
