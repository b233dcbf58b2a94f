"""Production planning: inventory run-down, job list, schedule and delay alerts.

Scale notes
-----------
* The run-down windows are partitioned by product over (product, day)
  aggregates, so a product's partition holds at most one row per calendar
  day however many orders it has.
* The schedule is a running total per facility, and there are only a few
  facilities. A plain window would put each facility in one task. The block
  method cuts each facility's queue into day blocks (busy days into
  product-id ranges), solves each block locally with windows, then merges the
  blocks' carry elements (first and last category, hours) in a tree over
  months and facilities and hands back what each block takes over.
* Delay categories need the global min and max delay; they enter the plan as
  one scalar subquery (a one-row aggregate), not as a driver round trip.
"""

from __future__ import annotations

import datetime as dt
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions.derived import as_of_date, product_category
from stockflow.operators.joins import join_null_safe, left_join_skew_safe
from stockflow.session import materialize as checkpoint_once

PEER_ORDER = ["OrderYearMonth", "ProductID"]
# Parts of one product and day tie on PEER_ORDER; the previous-category lag
# needs one fixed order, so part and material break the tie.
ROW_ORDER = ["OrderYearMonth", "ProductID", "ProcessPartID", "MaterialID"]

SCHEDULE_COLUMNS = [
    "ProductID",
    "OrderYearMonth",
    "Delta_produced",
    "MaterialID",
    "ProcessPartID",
    "Req_Prod_Quant",
    "FacilityID",
    "ProcessingTime",
    "OrderDeadline",
    "CurrentDate",
    "DiffHours",
    "ProductCategory",
    "PreviousProductCat",
    "TotalProcessingTime",
    "Running_Total",
]

ALERT_COLUMNS = [
    "ProductID",
    "OrderYearMonth",
    "Delta_produced",
    "FacilityID",
    "OrderDeadline",
    "ExpectedDelay",
    "DelayCategory",
]

# Delay categories and their upper cut points as fractions of
# the (max - min) delay range above the minimum; the last category is open.
DELAY_CATEGORIES = ["Category_1", "Category_2", "Category_3", "Category_4", "Category_5"]
DELAY_CUTS = [0.2, 0.4, 0.6, 0.8]


def open_orders_by_product_day(current: DataFrame) -> DataFrame:
    """ProductID, OrderYearMonth, count: open order rows per product and day.

    The day column is named OrderYearMonth although it holds the order day.
    """
    return (
        current.where(F.col("status") == "open")
        .groupBy("ProductID", "OrderDate")
        .count()
        .withColumnRenamed("OrderDate", "OrderYearMonth")
    )


def inventory_rundown(per_day: DataFrame, missing: DataFrame) -> DataFrame:
    """Day-by-day stock per product and the production it forces.

    In day order per product: running_total of ordered units; end_inventory =
    stock - running_total, floored at 0; start_inventory = previous day's end
    (the stock on the first day); Total_produced = the shortfall below 0;
    Delta_produced = today's shortfall minus yesterday's (the first day: the
    shortfall). A product without stock never produces (its shortfall test is
    null, so it falls to 0).
    """
    stock = missing.select("ProductID", "Product_Inventory")
    df = per_day.join(stock, "ProductID", "left")
    w = Window.partitionBy("ProductID").orderBy("OrderYearMonth")
    remaining = F.col("Product_Inventory") - F.col("running_total")
    df = df.withColumn("running_total", F.sum("count").over(w))
    df = df.withColumns(
        {
            "end_inventory": F.when(remaining < 0, F.lit(0)).otherwise(remaining),
            "Total_produced": F.when(remaining < 0, -remaining).otherwise(F.lit(0)),
        }
    )
    df = df.withColumns(
        {
            "start_inventory": F.coalesce(F.lag("end_inventory").over(w), F.col("Product_Inventory")),
            "Total_produced_before": F.lag("Total_produced").over(w),
        }
    )
    delta = F.col("Total_produced") - F.col("Total_produced_before")
    df = df.withColumn("Delta_produced", F.when(delta.isNull(), F.col("Total_produced")).otherwise(delta))
    return df.select(
        "ProductID",
        "OrderYearMonth",
        "count",
        "Product_Inventory",
        "running_total",
        "end_inventory",
        "start_inventory",
        "Total_produced",
        "Total_produced_before",
        "Delta_produced",
    )


def production_deltas(rundown: DataFrame) -> DataFrame:
    """ProductID, OrderYearMonth, Delta_produced for days that need production."""
    return rundown.where(F.col("Delta_produced") > 0).select(
        "ProductID", "OrderYearMonth", "Delta_produced"
    )


JOB_COLUMNS = [
    "ProductID",
    "OrderYearMonth",
    "Delta_produced",
    "MaterialID",
    "ProcessPartID",
    "Req_Prod_Quant",
    "FacilityID",
    "ProcessingTime",
]


#: What the jobs take from the inventory table.
PART_COLUMNS = ["productID", "MaterialID", "ProcessPartID", "Req_Prod_Quant", "FacilityID", "ProcessingTime"]

#: Most producing products whose ids are broadcast to reduce the parts.
BROADCAST_PRODUCTS = 1_000_000


class JobParts(NamedTuple):
    """A job list that is still to be listed: the production days (one row per
    product and day) and the parts, as ``job_list`` takes them."""

    deltas: DataFrame
    inventory: DataFrame


def _parts_of_producing(deltas: DataFrame, inventory: DataFrame, broadcast_products: int) -> DataFrame:
    producing = deltas.select(F.col("ProductID").alias("_producing")).where("_producing is not null").distinct()
    if producing.count() <= broadcast_products:
        return inventory.join(F.broadcast(producing), F.col("productID") == F.col("_producing"), "left_semi")
    return inventory


def job_list(
    deltas: DataFrame,
    inventory: DataFrame,
    hot_rows: int = 1_000_000,
    broadcast_products: int = BROADCAST_PRODUCTS,
    rows: int | None = None,
) -> DataFrame:
    """One job per production day and process part of the product (a day
    of a product without parts stays, with null part columns).

    Written as a skew-safe left join: a product with a very large parts list
    would otherwise keep all its jobs in one task. Only parts of products that
    have production days can match, so the others are dropped where they are
    read, before the parts are shuffled: the ids of the producing products are
    broadcast if they are at most ``broadcast_products`` (the production days
    are checkpointed to count them); with more, all parts are shuffled. With
    ``rows``, about how many parts there are, the shuffled ones are dealt to
    tasks of a bounded number of rows.
    """
    deltas = checkpoint_once(deltas, drop_shuffles=True)
    parts = _parts_of_producing(deltas, inventory, broadcast_products).select(
        "MaterialID",
        "ProcessPartID",
        "Req_Prod_Quant",
        F.col("productID").alias("_part_product"),
        "FacilityID",
        "ProcessingTime",
    )
    return left_join_skew_safe(deltas, parts, ["ProductID"], ["_part_product"], JOB_COLUMNS, hot_rows, rows=rows)


def _switched(total: Column, previous: Column, current: Column, switch_cost: int) -> Column:
    """Add the switch cost unless the previous category equals this one
    (a null comparison counts as a switch)."""
    return F.when(previous == current, total).otherwise(total + F.lit(switch_cost))


def _schedule_base(jobs: DataFrame, max_hours_day: int, as_of, deadline_months: int) -> DataFrame:
    return (
        jobs.withColumn("OrderDeadline", F.add_months("OrderYearMonth", deadline_months))
        .withColumn("CurrentDate", as_of_date(as_of))
        .withColumn("DiffHours", F.date_diff("OrderDeadline", "CurrentDate") * F.lit(max_hours_day))
        .withColumn("ProductCategory", product_category(F.col("ProcessPartID")))
    )


def _schedule_window(df: DataFrame, switch_cost: int) -> DataFrame:
    """Reference form: one window per facility (parallelism = facilities)."""
    w_row = Window.partitionBy("FacilityID").orderBy(*ROW_ORDER)
    w_peer = Window.partitionBy("FacilityID").orderBy(*PEER_ORDER)
    cat = F.col("ProductCategory")
    df = df.withColumn("PreviousProductCat", F.coalesce(F.lag(cat).over(w_row), cat))
    base = F.col("ProcessingTime") * F.col("Delta_produced")
    df = df.withColumn(
        "TotalProcessingTime", _switched(base, F.col("PreviousProductCat"), cat, switch_cost)
    )
    return df.withColumn("Running_Total", F.sum("TotalProcessingTime").over(w_peer))


#: Most facility-days that are cut into ranges (their table is broadcast), and
#: most blocks whose carry table is broadcast; beyond that it is shuffled.
BUSY_DAYS = 100_000
BROADCAST_BLOCKS = 1_000_000
#: Most parts that are broadcast to the scheduled days.
BROADCAST_PARTS = 100_000
BLOCK_KEYS = ["FacilityID", "OrderYearMonth", "_sub"]


def assign_schedule_blocks(df: DataFrame, rows_per_block: int) -> DataFrame:
    """Adds ``_sub``: the product-id range of the row within its facility-day.

    A facility-day with n jobs, more than a block's, is cut into
    ceil(n / rows_per_block) equal product-id ranges; all others are one
    block. The table of busy days is broadcast and has at most ``BUSY_DAYS``
    rows: on more jobs than BUSY_DAYS x rows_per_block the blocks get larger.
    """
    seg, day = "FacilityID", "OrderYearMonth"
    day_stats = checkpoint_once(
        df.groupBy(seg, day).agg(
            F.count(F.lit(1)).alias("_n"),
            F.min("ProductID").alias("_pmin"),
            F.max("ProductID").alias("_pmax"),
        )
    )
    total = day_stats.agg(F.sum("_n")).first()[0] or 0
    limit = max(rows_per_block, -(-total // BUSY_DAYS))
    ranges = F.ceil(F.col("_n") / F.lit(limit))
    busy = F.broadcast(day_stats.where(F.col("_n") > limit).withColumn("_ranges", ranges))
    span = F.col("_pmax").cast("long") - F.col("_pmin") + 1
    sub = F.coalesce(F.floor((F.col("ProductID") - F.col("_pmin")) * F.col("_ranges") / span), F.lit(0))
    return join_null_safe(df, busy, [seg, day]).withColumn("_sub", sub).drop("_n", "_pmin", "_pmax", "_ranges")


def _entry_cost(previous: Column, first: Column, switch_cost: int) -> Column:
    """What switching to the first category costs (as ``_switched`` counts it)."""
    return F.when(F.coalesce(previous, first) == first, F.lit(0)).otherwise(F.lit(switch_cost))


def _plus(a: Column, b: Column) -> Column:
    """Sum in which a null counts nothing; null if both are."""
    return F.coalesce(a + b, a, b)


def _scan_group(elements: DataFrame, group: list[str], order: list[str], switch_cost: int) -> DataFrame:
    """Carry elements in order within their group.

    An element stands for a stretch of the queue: its first category, whether
    its first job has hours (``_has``), its hours without the switch into it,
    and its last category. Added are ``_start`` (first of its group), ``_prev``
    (last category before it), ``_entry`` (the switch into it; 0 at the
    group's start, which is settled one level up), ``_own`` (hours with that)
    and ``_before`` (hours of the group before it).
    """
    w = Window.partitionBy(*group).orderBy(*order)
    entry = F.when(F.col("_start"), F.lit(0)).otherwise(_entry_cost(F.col("_prev"), F.col("_first_cat"), switch_cost))
    scanned = (
        elements.withColumn("_start", F.lag(F.lit(True)).over(w).isNull())
        .withColumn("_prev", F.lag("_last_cat").over(w))
        .withColumn("_entry", entry)
        .withColumn("_own", F.col("_hours") + F.when(F.col("_has"), F.col("_entry")).otherwise(F.lit(0)))
    )
    return scanned.withColumn("_before", F.sum("_own").over(w.rowsBetween(Window.unboundedPreceding, -1)))


def _merge_group(scanned: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """One element per group: the merge of its elements."""
    rows = F.struct(*[F.col(c) for c in order], F.col("_last_cat").alias("_value"))
    return scanned.groupBy(*group).agg(
        F.max(F.when(F.col("_start"), F.struct("_first_cat", "_has"))).alias("_head"),
        F.sum("_own").alias("_hours"),
        F.max(rows).alias("_tail"),
    ).select(
        *group, F.col("_head._first_cat").alias("_first_cat"), F.col("_head._has").alias("_has"),
        "_hours", F.col("_tail._value").alias("_last_cat"),
    )


def merge_carry(blocks: DataFrame, switch_cost: int) -> DataFrame:
    """What every block of a facility's queue takes over from those before it:
    ``_prev``, ``_entry`` and ``_before`` (hours; null while there are none).

    Merging carry elements is associative, so it runs as a tree: blocks are
    scanned within the months of a facility, the months' elements within the
    facility, and what a month takes over is handed down to its blocks. No
    task holds more than a facility's months or a month's blocks.
    """
    seg, day = "FacilityID", "OrderYearMonth"
    blocks = blocks.withColumn("_month", F.trunc(day, "MM"))
    month = [seg, "_month"]
    inner = _scan_group(blocks, month, [day, "_sub"], switch_cost)
    outer = _scan_group(_merge_group(inner, month, [day, "_sub"]), [seg], ["_month"], switch_cost)
    settled = F.when(F.col("_start"), _entry_cost(F.lit(None).cast("string"), F.col("_first_cat"), switch_cost))
    outer = outer.withColumn("_entry", settled.otherwise(F.col("_entry")))
    # the facility's first switch belongs to its first month's first block
    first = F.sum(F.when(F.col("_start") & F.col("_has"), F.col("_entry"))).over(Window.partitionBy(seg))
    taken = outer.select(
        *month,
        F.col("_prev").alias("_m_prev"),
        F.col("_entry").alias("_m_entry"),
        F.when(F.col("_has"), F.col("_entry")).otherwise(F.lit(0)).alias("_m_added"),
        F.when(F.col("_start"), F.lit(None)).otherwise(F.col("_before") + F.coalesce(first, F.lit(0))).alias("_m_before"),
    )
    joined = join_null_safe(inner, taken, month)
    start = F.col("_start")
    return joined.select(
        *BLOCK_KEYS,
        "_has",
        F.when(start, F.col("_m_prev")).otherwise(F.col("_prev")).alias("_prev"),
        F.when(start, F.col("_m_entry")).otherwise(F.col("_entry")).alias("_entry"),
        _plus(F.col("_m_before"), F.col("_before") + F.col("_m_added")).alias("_before"),
    )


def block_pass(keyed: DataFrame, switch_cost: int) -> DataFrame:
    """The windows inside blocks: one shuffle and one sort of the jobs.

    Adds ``_first`` (first row of its block), ``_lag``, ``_base`` (hours with
    the switches inside the block), ``_run`` (their running total) and, on the
    first row, the block's ``_hours`` and ``_last_cat``.
    """
    cat = F.col("ProductCategory")
    base = F.col("ProcessingTime") * F.col("Delta_produced")
    w_row = Window.partitionBy(*BLOCK_KEYS).orderBy(*ROW_ORDER)
    w_peer = Window.partitionBy(*BLOCK_KEYS).orderBy(*PEER_ORDER)
    w_all = w_row.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    inside = F.when(F.col("_first"), base).otherwise(
        # the first row's switch depends on the previous block: added later
        _switched(base, F.coalesce(F.col("_lag"), cat), cat, switch_cost)
    )
    return (
        keyed.withColumn("_first", F.lag(F.lit(True)).over(w_row).isNull())
        .withColumn("_lag", F.lag(cat).over(w_row))
        .withColumn("_base", inside)
        .withColumn("_run", F.sum("_base").over(w_peer))
        .withColumn("_hours", F.when(F.col("_first"), F.sum("_base").over(w_all)))
        .withColumn("_last_cat", F.when(F.col("_first"), F.last(cat).over(w_all)))
    )


def _schedule_blocks(df: DataFrame, switch_cost: int, rows_per_block: int) -> DataFrame:
    """Same result as ``_schedule_window`` with the work spread over blocks.

    A block is a slice of one facility's queue: one day, cut into product-id
    ranges when the day holds more than ``rows_per_block`` jobs (a busy day
    gets proportionally more ranges). The jobs are shuffled and sorted into
    blocks once, their windows run once, and the result is checkpointed; the
    blocks' carry elements (one row per block) are read from it, merged in a
    tree and handed back to the rows by a join. The parts of one product and
    day (a group of window peers) always share a block.
    """
    cat = F.col("ProductCategory")
    with_category = df.withColumn("ProductCategory", product_category(F.col("ProcessPartID")))
    local = block_pass(assign_schedule_blocks(with_category, rows_per_block), switch_cost)
    # what a row's own columns give is computed again rather than stored
    local = checkpoint_once(local.drop("ProductCategory")).withColumn(
        "ProductCategory", product_category(F.col("ProcessPartID"))
    )
    blocks = local.where(F.col("_first")).select(
        *BLOCK_KEYS, cat.alias("_first_cat"), F.col("_base").isNotNull().alias("_has"), "_hours", "_last_cat"
    )
    rows = join_null_safe(local.drop("_hours", "_last_cat"), _carried(blocks, switch_cost), BLOCK_KEYS)
    first = F.col("_first")
    previous = F.when(first, F.coalesce(F.col("_prev"), cat)).otherwise(F.coalesce(F.col("_lag"), cat))
    total = F.when(first, F.col("_base") + F.col("_entry")).otherwise(F.col("_base"))
    run_local = F.col("_run") + F.when(F.col("_has"), F.col("_entry")).otherwise(F.lit(0))
    return (
        rows.withColumn("PreviousProductCat", previous)
        .withColumn("TotalProcessingTime", total)
        .withColumn("Running_Total", _plus(F.col("_before"), run_local))
    )


def _carried(blocks: DataFrame, switch_cost: int) -> DataFrame:
    """``merge_carry``, broadcast up to ``BROADCAST_BLOCKS`` blocks."""
    carried = checkpoint_once(merge_carry(blocks, switch_cost))
    return F.broadcast(carried) if carried.count() <= BROADCAST_BLOCKS else carried


def _queued_parts(parts: DataFrame, switch_cost: int) -> DataFrame:
    """The parts of each product and facility in queue order: ``_head`` and
    ``_tail`` (first and last), ``_lag`` (category before) and ``_switch``
    (hours for switching into the part; 0 for the first)."""
    w = Window.partitionBy("productID", "FacilityID").orderBy("ProcessPartID", "MaterialID")
    cat = F.col("_cat")
    switch = _switched(F.lit(0), F.coalesce(F.col("_lag"), cat), cat, switch_cost)
    return (
        parts.select("productID", "MaterialID", "ProcessPartID", "Req_Prod_Quant", "FacilityID", "ProcessingTime")
        .withColumn("_cat", product_category(F.col("ProcessPartID")))
        .withColumn("_head", F.lag(F.lit(True)).over(w).isNull())
        .withColumn("_tail", F.lead(F.lit(True)).over(w).isNull())
        .withColumn("_lag", F.lag("_cat").over(w))
        .withColumn("_switch", F.when(F.col("_head"), F.lit(0)).otherwise(switch))
    )


def _product_days(deltas: DataFrame, queued: DataFrame) -> DataFrame:
    """A carry element (see ``_scan_group``) per production day and facility of
    its product: the day's jobs are the product's parts there, so their hours
    are the units times the parts' hours plus the switches among the parts."""
    timed = F.col("ProcessingTime").isNotNull()
    lists = queued.groupBy(F.col("productID").alias("_list_product"), "FacilityID").agg(
        F.sum("ProcessingTime").alias("_unit"),
        F.sum(F.when(timed, F.col("_switch"))).alias("_switches"),
        F.max(F.when(F.col("_head"), F.struct("_cat", timed.alias("_has")))).alias("_h"),
        F.max(F.when(F.col("_tail"), F.struct("_cat"))).alias("_t"),
    )
    return deltas.join(lists, F.col("ProductID") == F.col("_list_product"), "left").select(
        *deltas.columns,
        "FacilityID",
        F.col("_h._cat").alias("_first_cat"),
        F.coalesce(F.col("_h._has"), F.lit(False)).alias("_has"),
        (F.col("_unit") * F.col("Delta_produced") + F.coalesce(F.col("_switches"), F.lit(0))).alias("_hours"),
        F.col("_t._cat").alias("_last_cat"),
    )


def _schedule_parts(jobs: JobParts, switch_cost: int, rows_per_block: int, hot_rows: int = 1_000_000) -> DataFrame:
    """Same result as ``_schedule_blocks(job_list(*jobs))`` without a shuffle or
    sort of the jobs, of which there are far more than days and parts.

    The parts of a product follow each other in the same order on each of its
    days, so the order, the switches and the hours among them are found once
    per parts list; the blocks hold product days and are scanned as such. The
    jobs are listed last, as in ``job_list``, from the days that have their
    running totals: a short parts list is broadcast, a long one joined with hot
    products cut. They are neither shuffled nor stored.
    """
    deltas = checkpoint_once(jobs.deltas.select("ProductID", "OrderYearMonth", "Delta_produced"), drop_shuffles=True)
    parts = _parts_of_producing(deltas, jobs.inventory, BROADCAST_PRODUCTS)
    queued = checkpoint_once(_queued_parts(parts, switch_cost))
    # a block's scan order is the product: one element per product, day and facility
    keyed = assign_schedule_blocks(checkpoint_once(_product_days(deltas, queued)), rows_per_block)
    days = checkpoint_once(_scan_group(keyed, BLOCK_KEYS, ["ProductID"], switch_cost))
    blocks = _merge_group(days, BLOCK_KEYS, ["ProductID"])

    first = F.col("_start")
    carried = _carried(blocks, switch_cost).withColumnsRenamed({c: f"_c{c}" for c in ("_has", "_prev", "_entry", "_before")})
    run_local = _plus(F.col("_before"), F.col("_own")) + F.when(F.col("_c_has"), F.col("_c_entry")).otherwise(F.lit(0))
    # a product without a process has no facility: matched as a value, like any other
    facility = F.coalesce(F.concat(F.lit("="), F.col("FacilityID")), F.lit(""))
    left = join_null_safe(days, carried, BLOCK_KEYS).select(
        "ProductID", "OrderYearMonth", "Delta_produced", "FacilityID", facility.alias("_facility"),
        F.when(first, F.col("_c_prev")).otherwise(F.col("_prev")).alias("_day_prev"),
        F.when(first, F.col("_c_entry")).otherwise(F.col("_entry")).alias("_day_entry"),
        _plus(F.col("_c_before"), run_local).alias("Running_Total"),
    )
    right = queued.select(
        F.col("productID").alias("_part_product"), facility.alias("_part_facility"),
        "MaterialID", "ProcessPartID", "Req_Prod_Quant", "ProcessingTime", "_head", "_lag", "_switch",
    )
    keys, part_keys = ["ProductID", "_facility"], ["_part_product", "_part_facility"]
    output = [*JOB_COLUMNS, "_day_prev", "_day_entry", "Running_Total", "_head", "_lag", "_switch"]
    if queued.count() <= BROADCAST_PARTS:
        on = [left[a] == right[b] for a, b in zip(keys, part_keys, strict=True)]
        listed = left.join(F.broadcast(right), on, "left").select(*output)
    else:
        listed = left_join_skew_safe(left, right, keys, part_keys, output, hot_rows)
    head = F.coalesce(F.col("_head"), F.lit(True))
    cat = F.col("ProductCategory")
    return listed.select(
        *JOB_COLUMNS,
        product_category(F.col("ProcessPartID")).alias("ProductCategory"),
        F.when(head, F.col("_day_prev")).otherwise(F.col("_lag")).alias("_lag"),
        F.when(head, F.col("_day_entry")).otherwise(F.col("_switch")).alias("_added"),
        "Running_Total",
    ).select(
        "*",
        F.coalesce(F.col("_lag"), cat).alias("PreviousProductCat"),
        (F.col("ProcessingTime") * F.col("Delta_produced") + F.col("_added")).alias("TotalProcessingTime"),
    )


def schedule_jobs(
    jobs: DataFrame | JobParts,
    max_hours_day: int = 8,
    as_of: dt.date | str | Column | None = None,
    switch_cost: int = 1,
    deadline_months: int = 3,
    method: str = "blocks",
    rows_per_block: int = 1_000_000,
) -> DataFrame:
    """Queue each facility's jobs in (day, product) order and total the hours.

    OrderDeadline = job day + ``deadline_months``; DiffHours = working hours
    left until the deadline as of ``as_of`` (today by default);
    ProductCategory = last character of the part id; switching category from
    the previous job costs ``switch_cost`` hours; Running_Total = the
    facility's hours up to and including this (day, product).

    ``method="blocks"`` (default) spreads each facility's queue over blocks of
    about ``rows_per_block`` jobs; ``"window"`` is the single-window form.
    ``jobs`` may be given as the ``JobParts`` they are listed from: the blocks
    then hold product days, and the jobs are listed with their hours, without
    being shuffled and sorted.
    """
    base = (max_hours_day, as_of, deadline_months)
    if isinstance(jobs, JobParts) and method == "blocks":
        out = _schedule_base(_schedule_parts(jobs, switch_cost, rows_per_block), *base)
        return out.select(*SCHEDULE_COLUMNS)
    if isinstance(jobs, JobParts):
        jobs = job_list(*jobs)
    if method == "window":
        out = _schedule_window(_schedule_base(jobs, *base), switch_cost)
    elif method == "blocks":
        out = _schedule_base(_schedule_blocks(jobs.select(*JOB_COLUMNS), switch_cost, rows_per_block), *base)
    else:
        raise ValueError(f"unknown schedule method {method!r}")
    return out.select(*SCHEDULE_COLUMNS)


def delay_alerts(schedule: DataFrame, materialize: bool = True) -> DataFrame:
    """Jobs that finish after their deadline, graded in five categories.

    ExpectedDelay = Running_Total - DiffHours. Cut points split the range
    between the smallest and largest delay into fifths (upper bounds
    inclusive); equal delays are all Category_1; no late job gives no rows.

    The late rows are projected and deduplicated first (duplicates change
    neither the min and max nor any category), then read twice: once by the
    one-row min/max aggregate (a scalar subquery) and once for the rows. With
    ``materialize`` they are checkpointed in between, so the schedule behind
    them runs once instead of once per branch.
    """
    keep = [c for c in ALERT_COLUMNS if c != "DelayCategory"]
    late = (
        schedule.where(F.col("Running_Total") > F.col("DiffHours"))
        .withColumn("ExpectedDelay", F.col("Running_Total") - F.col("DiffHours"))
        .select(*keep)
        .dropDuplicates()
    )
    if materialize:
        late = checkpoint_once(late)
    bounds = late.agg(
        F.struct(F.min("ExpectedDelay").alias("lo"), F.max("ExpectedDelay").alias("hi")).alias("b")
    ).scalar()
    # attach the one-row aggregate once; every cut point reads this column,
    # so the subquery runs once rather than once per reference
    late = late.withColumn("_b", bounds)
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    cuts = [lo + F.lit(frac) * (hi - lo) for frac in DELAY_CUTS]
    delay = F.col("ExpectedDelay")
    category = F.when(delay <= cuts[0], F.lit(DELAY_CATEGORIES[0]))
    for i in range(1, len(cuts)):
        category = category.when((delay > cuts[i - 1]) & (delay <= cuts[i]), F.lit(DELAY_CATEGORIES[i]))
    category = category.otherwise(F.lit(DELAY_CATEGORIES[-1]))
    return (
        late.withColumn("DelayCategory", category)
        .select(*ALERT_COLUMNS)
        # ProductID refines the order so a busy facility-day can be range-split
        .orderBy("FacilityID", "OrderYearMonth", "ProductID")
    )


def delay_summary(alerts: DataFrame) -> DataFrame:
    """DelayCategory, AlertCount, MinExpectedDelay, MaxExpectedDelay."""
    return alerts.groupBy("DelayCategory").agg(
        F.count(F.lit(1)).alias("AlertCount"),
        F.min("ExpectedDelay").alias("MinExpectedDelay"),
        F.max("ExpectedDelay").alias("MaxExpectedDelay"),
    )
