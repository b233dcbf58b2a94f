"""Physical plan checks: the plans we want at scale, not just right answers."""

from small_data import SF_SMALL
from stockflow.operators.ranking import range_blocks
from stockflow.plans.registry import Layers
from stockflow.session import scratch_path
from stockflow.sources.catalog import ensure_database, read_table, write_table
from pyspark.sql import functions as F


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_plans(spark):
    l = Layers(spark, SF_SMALL)
    for df in (l.missing_inventory(), l.rundown(), l.jobs()):
        plan = _plan(df)
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_schedule_shuffles_and_sorts_the_jobs_once(spark):
    from stockflow.operators import production

    l = Layers(spark, SF_SMALL)
    jobs = production._schedule_base(l.jobs(), 8, "1998-01-01", 3)
    plan = _plan(production.block_pass(production.assign_schedule_blocks(jobs, 100), 1))
    assert "SinglePartition" not in plan
    # one exchange, by facility, day and product range, not by facility alone; the busy days are broadcast
    assert plan.count("Exchange hashpartitioning(") == 1 and plan.count("+- Sort ") == 1
    assert "hashpartitioning(FacilityID#" in plan and "_sub#" in plan
    # the carry reaches the rows without another shuffle or sort of them
    final = _plan(l.schedule())
    assert "BroadcastHashJoin" in final and "Exchange hashpartitioning" not in final and "Sort " not in final


def test_carry_merges_month_by_month(spark):
    from stockflow.operators import production

    schema = "FacilityID string, OrderYearMonth date, _sub long, _first_cat string, _has boolean, _hours long, _last_cat string"
    one = spark.createDataFrame([], schema)
    plan = _plan(production.merge_carry(one, 1))
    assert "hashpartitioning(FacilityID#" in plan and "_month#" in plan and "SinglePartition" not in plan


def test_numbering_is_range_partitioned(spark):
    blocked = range_blocks(Layers(spark, SF_SMALL).raw("finished_goods"), ["productID"], 8)
    plan = _plan(blocked)
    assert "rangepartitioning(productID" in plan and "SinglePartition" not in plan


def test_filter_and_columns_reach_parquet_scan(spark):
    root = scratch_path(spark, "test_plans")
    db = ensure_database(spark, "stockflow_test_plans", root)
    write_table(Layers(spark, SF_SMALL).orders(), f"{db}.orders", f"{root}/orders")
    q = read_table(spark, f"{db}.orders").where(F.col("status") == "open").groupBy("productID").count()
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,open)]" in plan
    assert "ReadSchema: struct<productID:int,status:string>" in plan


def test_delay_bounds_subquery_runs_once(spark):
    df = Layers(spark, SF_SMALL).alerts()
    df.collect()
    assert _plan(df).count("scalar-subquery") == 1


def test_open_orders_filter_reaches_the_stored_table(spark):
    from stockflow.operators import production
    from stockflow.plans.layered import Layout, LayeredRun
    from stockflow.sources import fixtures

    run = LayeredRun(spark, Layout(root=scratch_path(spark, "test_prune"), prefix="stockflow_test_prune_"))
    run.bronze(lambda t: fixtures.RAW_TABLES[t](spark, SF_SMALL))
    run.silver()
    run.gold("1998-01-01")
    current = run.table("gold", "current_demand")
    assert current.columns[-1] == "OrderYearMonth"
    plan = production.open_orders_by_product_day(current)._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    # stored unpartitioned, because an empty status would come back as null;
    # the filter skips row groups of the files sorted by status instead
    assert "PushedFilters: [IsNotNull(status), EqualTo(status,open)]" in plan


def test_demand_join_splits_hot_customers_by_piece(spark):
    from stockflow.operators import silver

    l = Layers(spark, SF_SMALL)
    joined = silver.demand_domain(l.orders(), l.customers())
    joined.collect()
    plan = _plan(joined)
    assert "BroadcastExchange" in plan  # the bounded hot-key table
    assert "_piece" in plan  # the join runs on (customer, piece)


def test_domains_plan_their_joins_once(spark):
    from stockflow.operators import silver
    from stockflow.session import materialize

    l = Layers(spark, SF_SMALL)
    goods, processes, parts, materials, orders, customers, raw_orders = (
        materialize(x) for x in (l.goods(), l.processes(), l.parts(), l.materials(), l.orders(), l.customers(), l.raw("customer_orders"))
    )
    scans = lambda plan, first: plan.count(f"Scan ExistingRDD[{first}#")
    plan = _plan(silver.manufacturing_domain(goods, processes, parts, materials))
    assert scans(plan, goods.columns[0]) == 1 and scans(plan, materials.columns[0]) == 1
    # each hot-key table stands on both sides of its join (one exchange, reused); it reads the processes, and the parts twice
    assert plan.count("Scan ExistingRDD[") == 1 + (1 + 2) + (1 + 2 * 2) + 1
    plan = _plan(silver.demand_domain(orders, customers, counted=raw_orders))
    assert plan.count("Scan ExistingRDD[") == 1 + 1 + 2


def test_parts_of_idle_products_are_dropped_before_the_shuffle(spark):
    from stockflow.operators import inventory, production

    l = Layers(spark, SF_SMALL)
    parts = inventory.inventory_table(l.manufacturing_domain())
    few = l.deltas().where("ProductID % 7 = 0")
    jobs = production.job_list(few, parts)
    lines = _plan(jobs).splitlines()
    semi = next(i for i, x in enumerate(lines) if "LeftSemi" in x)
    assert "BroadcastHashJoin" in lines[semi]
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    above = [x for x in lines[:semi] if depth(x) < depth(lines[semi])]
    assert any("Exchange hashpartitioning(" in x for x in above)
    # the same jobs when the ids are too many to be broadcast
    plain = production.job_list(few, parts, broadcast_products=0)
    assert "LeftSemi" not in _plan(plain)
    assert sorted(jobs.collect(), key=repr) == sorted(plain.collect(), key=repr)
