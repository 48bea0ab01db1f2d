"""Registered queries: each reads the parquet folder it is given and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from contextlib import nullcontext
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from oracles import ORACLES, PART_CATEGORIES
from shelfwise.functions import line_amount
from shelfwise.operators import history, incremental, observability, quality
from shelfwise.operators import replenishment as planning
from shelfwise.operators import usage
from shelfwise.plans import marts, pipeline, quarantine, serving, staging
from shelfwise.plans.contract import full_contract
from shelfwise.plans.pipeline import Models
from shelfwise.session import OPEN_FILES, new_folder, stored_meanwhile
from shelfwise.session import stored as written
from shelfwise.sources import landing, sinks, tables
from shelfwise.sources import zone as zone_files
from shelfwise.sources.schemas import DIMENSIONS, FACTS, LOADED_AT, RAW_COLUMNS, SOURCE_FILE
from shelfwise.sources.standin import SNAPSHOT_DAYS, StandIn
from shelfwise.sources.versions import ROWS, VersionedTable
from shelfwise.streaming import ingest

try:  # the document operators are optional; a broken import inside them is not hidden
    import corpus_pipeline
    from shelfwise.llm import oracles as document_oracles
    from shelfwise.llm import queries as document_queries
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "shelfwise.llm"):
        raise
    corpus_pipeline = document_oracles = document_queries = None

Query = Callable[[SparkSession, str], DataFrame]

FIRST_SNAPSHOT, SECOND_SNAPSHOT = "2026-07-18", "2026-07-19"
TWO_STORES = ("STO-003", "STO-007")
WIDE_THRESHOLD = 21
#: Letters of a date that name its month.
MONTH = 7
#: Snapshots lie by part, with all their days in every task; only many days are dealt to tasks.
DEAL_SNAPSHOTS = SNAPSHOT_DAYS > OPEN_FILES
# Malformed sale rows, one broken rule each.
BAD_SALES = (
    ("SAL-BAD-001", "2026-07-18", "STO-001", "SKU-00001", "0", "10.00", "0.0", "0.00"),
    ("SAL-BAD-002", "2026-07-18", "STO-001", "SKU-00002", "-3", "10.00", "0.0", "30.00"),
    ("SAL-BAD-003", "2026-07-18", "STO-002", "SKU-00003", "2", "10.00", "0.0", "abc"),
    ("SAL-BAD-004", "2026-07-18", "STO-002", "SKU-00004", "2", "10.00", "1.5", "20.00"),
    ("SAL-BAD-005", "", "STO-003", "SKU-00005", "2", "10.00", "0.0", "20.00"),
)
# One supplier's renegotiated terms.
SUPPLIER_CHANGE = {"nominal_lead_time_days": 5, "reliability_score": 0.9,
                   "valid_from": SECOND_SNAPSHOT}


def _models(spark: SparkSession, folder: str) -> Models:
    return Models(StandIn(spark, folder), store=written)


def _model(name: str) -> Query:
    return lambda spark, folder: getattr(_models(spark, folder), name)


def _raw(name: str) -> Query:
    return lambda spark, folder: StandIn(spark, folder)[name]


def _with(build: Callable[[Models], DataFrame]) -> Query:
    return lambda spark, folder: build(_models(spark, folder))


def _at(day: str):
    return F.to_timestamp(F.lit(f"{day} 00:00:00"))


# --- stored tables and loads ----------------------------------------------------------


def _stored(name: str, stored_by: str | None = None, gather: bool = True) -> Query:
    """A model written as a table of its own and read back."""

    def query(spark: SparkSession, folder: str) -> DataFrame:
        warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
        df = getattr(_models(spark, folder), name)
        warehouse.replace("marts", name, df, stored_by, gather)
        return warehouse.read("marts", name)

    return query


def _prior_sales(sales: DataFrame) -> DataFrame:
    """Where an earlier load left off: two weeks back, with holes in every day, and amounts one
    off so that replacing a row shows. Holes in older days must stay holes."""
    last = F.date_sub(sales.agg(F.max("sale_date")).scalar(), 14)
    return sales.filter((F.col("sale_date") <= last) & (F.col("quantity") % 7 != 3)).withColumn(
        "amount_eur", F.col("amount_eur") + 1
    )


def _partial_sales(sales: DataFrame) -> DataFrame:
    """The same with all older rows, its last day only partly arrived."""
    last = F.date_sub(sales.agg(F.max("sale_date")).scalar(), 14)
    arrived = (F.col("sale_date") < last) | (
        (F.col("sale_date") == last) & (F.col("quantity") <= 25)
    )
    return sales.filter(arrived).withColumn("amount_eur", F.col("amount_eur") + 1)


def _incremental(m: Models, prior: Callable[[DataFrame], DataFrame] = _prior_sales) -> DataFrame:
    sales = written(marts.fct_sales(m.stg_sales), "sales")
    return incremental.incremental_merge(sales, written(prior(sales), "prior"))


def _table_load(spark: SparkSession, folder: str) -> DataFrame:
    sales = written(marts.fct_sales(_models(spark, folder).stg_sales), "sales")
    fact = incremental.DailyFact(VersionedTable(spark, new_folder(spark, "fct_sales")))
    fact.load(_prior_sales(sales))
    fact.load(sales)
    return fact.read()


def _pipeline_build(spark: SparkSession, folder: str) -> DataFrame:
    raw = StandIn(spark, folder)
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    return _fingerprint_of(pipeline.build(raw, warehouse, _at(FIRST_SNAPSHOT)))


def _fingerprint_of(t) -> DataFrame:
    return observability.build_fingerprint(
        t["fct_sales"], t["fct_inventory"], t["fct_purchase_orders"], t["dim_suppliers"],
        t["dim_products"], t["dim_stores"], t["dim_date"],
    )


def _contract(spark: SparkSession, folder: str) -> DataFrame:
    """All checks of the contract on one build; what several checks read is stored first."""
    m = _models(spark, folder).keep(
        "stg_suppliers", "stg_products", "stg_stores", "stg_sales", "stg_inventory_snapshots",
        "stg_purchase_orders", "fct_inventory", "fct_purchase_orders",
    )
    contract = full_contract(PART_CATEGORIES)
    return quality.run_checks({name: getattr(m, name) for name in contract}, contract)


# --- raw zone -------------------------------------------------------------------------


def _orders_zone(spark: SparkSession, folder: str) -> tuple[str, DataFrame]:
    """Purchase orders as CSV by day, delivered and open orders in files whose columns are
    ordered differently."""
    orders = written(StandIn(spark, folder)["purchase_orders"], "orders")
    zone = new_folder(spark, "zone")
    is_open = F.col("actual_delivery_date") == ""
    reordered = sorted(RAW_COLUMNS["purchase_orders"])
    sinks.write_partitioned(orders.filter(~is_open), f"{zone}/delivered", "order_date")
    sinks.write_partitioned(
        orders.filter(is_open).select(*reordered), f"{zone}/open", "order_date"
    )
    return zone, orders


def _union_by_name(spark: SparkSession, folder: str) -> DataFrame:
    zone, orders = _orders_zone(spark, folder)
    loaded = landing.read_union_by_name(
        spark, f"{zone}/*/dt=*/*.csv", RAW_COLUMNS["purchase_orders"]
    )
    return loaded.select(*orders.columns)


def _positional(spark: SparkSession, folder: str) -> DataFrame:
    orders = StandIn(spark, folder)["purchase_orders"]
    zone = new_folder(spark, "zone")
    sinks.write_partitioned(orders, f"{zone}/purchase_orders", "order_date")
    loaded = landing.load_raw(spark, zone, "purchase_orders", positional=True)
    return loaded.select(*orders.columns)


def _partitioned_sink(spark: SparkSession, folder: str) -> DataFrame:
    zone = new_folder(spark, "zone")
    inventory = StandIn(spark, folder)["inventory_snapshots"]
    sinks.write_partitioned(
        inventory, f"{zone}/inventory", "snapshot_date", gather=DEAL_SNAPSHOTS, gzip=True)
    loaded = landing.load_raw(spark, zone, "inventory_snapshots")
    return sinks.partition_count(loaded, "snapshot_date")


def _changed_files(spark: SparkSession, folder: str) -> DataFrame:
    """Days of files to upload and of files to skip, by a manifest of an earlier listing that was
    taken when the open orders had not arrived yet."""
    from shelfwise.sources import manifest

    zone, _ = _orders_zone(spark, folder)
    now = written(manifest.listing(spark, zone), "listing")
    changed = manifest.changed_files(now, now.filter(F.startswith("key", F.lit("delivered/"))))
    day = F.regexp_extract("key", "dt=([^/]*)", 1)
    return now.join(changed.select("key", F.lit(True).alias("new")), "key", "left").agg(
        F.count_distinct(F.when(F.col("new"), day)).alias("uploaded_days"),
        F.count_distinct(F.when(F.col("new").isNull(), day)).alias("skipped_days"),
    )


def _stream_load(spark: SparkSession, folder: str) -> DataFrame:
    zone, out = new_folder(spark, "zone"), new_folder(spark, "stream")
    sinks.write_partitioned(StandIn(spark, folder)["sales"], f"{zone}/sales", "sale_date")
    ingest.run_available(spark, zone, out, files_per_trigger=100_000)
    fact, *_ = ingest.sales_tables(spark, out)
    return fact.read()


def _appended_bad_rows(spark: SparkSession, folder: str) -> DataFrame:
    raw = StandIn(spark, folder)["sales"]
    bad = tables.literal_rows(spark, BAD_SALES, "sales", "simulated-bad-data")
    typed = staging.typed_sales(raw.unionByName(bad.select(*raw.columns)))
    return quarantine.quarantine_sales(typed).select("sale_id", "quarantine_reason")


def _keyed_update(spark: SparkSession, folder: str) -> DataFrame:
    raw = StandIn(spark, folder)["suppliers"]
    return staging.stg_suppliers(
        tables.update_by_key(raw, "supplier_id", "SUP-0002", SUPPLIER_CHANGE)
    )


def _stored_raw_append(spark: SparkSession, folder: str) -> DataFrame:
    """The hand-written rows appended to a stored RAW table."""
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    raw = StandIn(spark, folder)["sales"]
    warehouse.replace("raw", "sales", raw)
    bad = tables.literal_rows(spark, BAD_SALES, "sales", "simulated-bad-data")
    warehouse.append("raw", "sales", bad.select(*raw.columns))
    typed = staging.typed_sales(warehouse.read("raw", "sales"))
    return quarantine.quarantine_sales(typed).select("sale_id", "quarantine_reason")


def _stored_raw_update(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    warehouse.replace("raw", "suppliers", StandIn(spark, folder)["suppliers"])
    changed = tables.update_by_key(
        warehouse.read("raw", "suppliers"), "supplier_id", "SUP-0002", SUPPLIER_CHANGE)
    warehouse.replace("raw", "suppliers", changed)
    return staging.stg_suppliers(warehouse.read("raw", "suppliers"))


def _zone(spark: SparkSession, folder: str) -> str:
    """The six raw tables as files: facts by month in gzip, dimensions as they stand."""
    raw, zone = StandIn(spark, folder), new_folder(spark, "zone")
    for name, (where, date) in FACTS.items():
        gather = name != "inventory_snapshots" or DEAL_SNAPSHOTS
        with stored_meanwhile(raw[name], name) if gather else nullcontext(raw[name]) as rows:
            sinks.write_partitioned(
                rows, f"{zone}/{where}", date, letters=MONTH, gather=gather, gzip=True)
    for name in DIMENSIONS:
        sinks.write_current_state(raw[name], f"{zone}/{name}")
    return zone


def _raw_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    """All six tables landed from files and stored, twice; the second replaces the first, whose files
    go as soon as nothing names them."""
    zone = _zone(spark, folder)
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    for _ in range(2):
        for name, rows in landing.load_zone(spark, zone, _at(FIRST_SNAPSHOT)).items():
            warehouse.replace("raw", name, rows)
            warehouse.table("raw", name).expire(keep=1)
    return warehouse.row_counts(dict.fromkeys(RAW_COLUMNS, "raw"))


def _raw_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Landed sales by the folder of the file they name, and how many carry the load time."""
    zone = new_folder(spark, "zone")
    sinks.write_partitioned(StandIn(spark, folder)["sales"], f"{zone}/sales", "sale_date", letters=MONTH)
    table = VersionedTable(spark, new_folder(spark, "raw_sales"))
    zone_files.land(spark, zone, "sales", table, loaded_at=_at(FIRST_SNAPSHOT))
    return table.read().groupBy(
        F.regexp_extract(SOURCE_FILE, "/dt=([^/]*)/[^/]+[.]csv$", 1).alias("folder")
    ).agg(F.count(F.lit(1)).alias("n_rows"),
          F.count_if(F.col(LOADED_AT) == _at(FIRST_SNAPSHOT)).alias("n_stamped"))


def _dimension_typed_read(spark: SparkSession, folder: str) -> DataFrame:
    where = new_folder(spark, "suppliers")
    sinks.write_current_state(StandIn(spark, folder)["suppliers"], where)
    return landing.read_dimension_csv(spark, f"{where}/*.csv", "suppliers")


def _zone_to_marts(spark: SparkSession, folder: str) -> DataFrame:
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    built, _ = pipeline.build_from_zone(_zone(spark, folder), warehouse, _at(FIRST_SNAPSHOT))
    return _fingerprint_of(built)


def _zone_second_build(spark: SparkSession, folder: str) -> DataFrame:
    """A build, then another after the last month of sales was sent again, without its even
    quantities and with other amounts, and after a supplier changed."""
    raw, zone = StandIn(spark, folder), _zone(spark, folder)
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    built, _ = pipeline.build_from_zone(zone, warehouse, _at(FIRST_SNAPSHOT))
    month = str(built["fct_sales"].agg(F.max("sale_date")).first()[0])[:MONTH]
    even = F.coalesce(F.col("quantity").try_cast("int") % 2 == 0, F.lit(False))
    again = raw["sales"].filter(F.startswith("sale_date", F.lit(month)) & ~even).withColumn(
        "amount_eur", F.lit("1.00"))
    again.write.mode("overwrite").options(**sinks.CSV).csv(f"{zone}/sales/dt={month}")
    sinks.write_current_state(
        tables.update_by_key(raw["suppliers"], "supplier_id", "SUP-0002", SUPPLIER_CHANGE),
        f"{zone}/suppliers")
    built, landed = pipeline.build_from_zone(zone, warehouse, _at(SECOND_SNAPSHOT))
    demand = warehouse.read("intermediate", "daily_demand")
    rows = F.count(F.lit(1)).cast("double")
    parts = [
        built["fct_sales"].agg(rows.alias("fct_sales.n_rows"), F.round(F.sum("amount_eur")).alias("fct_sales.revenue")),
        demand.agg(F.sum("units_last_28d").cast("double").alias("demand.units")),
        built["quarantine_sales"].agg(rows.alias("quarantine.n_rows")),
        built["suppliers_snapshot"].agg(
            rows.alias("suppliers.n_versions"),
            F.count_if(F.col(history.VALID_TO).isNull()).cast("double").alias("suppliers.n_open")),
        spark.range(1).select(
            F.lit(float(len(landed["sales"].days))).alias("landed.sales_folders"),
            F.lit(float(len(landed["purchase_orders"].days))).alias("landed.order_folders"),
            F.lit(float(landed["suppliers"].rows)).alias("landed.supplier_rows"),
            F.lit(float(landed["products"].rows)).alias("landed.product_rows")),
    ]
    metrics = [
        part.select(F.inline(F.array(*(
            F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").alias("value")) for c in part.columns))))
        for part in parts
    ]
    return reduce(DataFrame.unionByName, metrics)


def _sql_serving(spark: SparkSession, folder: str) -> DataFrame:
    """A stored query over stored tables, asked for by name."""
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"), catalog=True)
    m = _models(spark, folder)
    warehouse.replace("marts", "fct_sales", m.fct_sales)
    warehouse.replace("marts", "dim_stores", m.dim_stores)
    warehouse.create_view("staging", "store_units", """
        SELECT store_name, COUNT(*) AS n_sales, SUM(quantity) AS units
        FROM {marts}.fct_sales JOIN {marts}.dim_stores USING (store_id) GROUP BY store_name""")
    return warehouse.query("SELECT * FROM {staging}.store_units WHERE units > 0")


# --- history --------------------------------------------------------------------------


def _supplier_history_table(spark: SparkSession, folder: str) -> DataFrame:
    """The history as a stored table that saw two snapshots; stamps as text, in all columns."""
    m = _models(spark, folder)
    kept = history.SupplierHistory(VersionedTable(spark, new_folder(spark, "suppliers_snapshot")))
    for source, day in ((m.stg_suppliers, FIRST_SNAPSHOT), (_second_suppliers(m), SECOND_SNAPSHOT)):
        kept.observe(source, _at(day), label=day)
    stamps = (history.UPDATED_AT, history.VALID_FROM, history.VALID_TO)
    return kept.read().withColumns(
        {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in stamps})


def _supplier_history(m: Models) -> DataFrame:
    """Two snapshots: some lead times shortened, some scores lost, some suppliers gone."""
    opened = written(history.snapshot(m.stg_suppliers, None, _at(FIRST_SNAPSHOT)), "snapshot")
    return history.snapshot(_second_suppliers(m), opened, _at(SECOND_SNAPSHOT))


def _second_suppliers(m: Models) -> DataFrame:
    lead = F.col("nominal_lead_time_days")
    return (
        m.stg_suppliers.filter(lead != 11)
        .withColumn("reliability_score", F.when(lead != 9, F.col("reliability_score")))
        .withColumn("nominal_lead_time_days", F.when(lead == 6, 5).otherwise(lead))
    )


def _by_day(versions: DataFrame) -> DataFrame:
    return versions.select(
        *RAW_COLUMNS["suppliers"],
        F.col(history.VALID_FROM).cast("date").alias("valid_from_day"),
        F.col(history.VALID_TO).cast("date").alias("valid_to_day"),
    )


def _orders_with_terms(m: Models) -> DataFrame:
    """Orders shifted so that the last one is placed on the day of the second snapshot."""
    orders = m.stg_purchase_orders
    last = orders.agg(F.max("order_date")).scalar()
    shift = F.datediff(F.lit(SECOND_SNAPSHOT).cast("date"), last)
    shifted = orders.select(
        "po_id", F.date_add("order_date", shift).alias("order_date"), "supplier_id"
    )
    return history.with_terms(
        shifted, written(_supplier_history(m), "history"), "order_date",
        terms=("nominal_lead_time_days", "reliability_score"),
    )


# --- quality --------------------------------------------------------------------------


def _dq_unique(m: Models) -> DataFrame:
    line = F.regexp_substr("sale_id", F.lit("^SAL-[0-9]+-[0-9]+")).alias("sale_line")
    return quality.unique(m.typed_sales.select(line), "sale_line")


def _dq_delivery(m: Models) -> DataFrame:
    """A load that dropped the received quantity of every short shipment."""
    kept = F.when(~F.coalesce(F.col("received_qty") < F.col("ordered_qty"), F.lit(False)),
                  F.col("received_qty"))
    orders = m.fct_purchase_orders.withColumn("received_qty", kept)
    return orders.filter(quality.delivery_fields_disagree()).select("po_id")


def _dq_late(m: Models) -> DataFrame:
    """A flag that forgives the first day."""
    orders = m.fct_purchase_orders.withColumn("is_late", F.col("delay_days") > 1)
    return orders.filter(quality.lateness_disagrees()).select("po_id")


def _run_history(spark: SparkSession, folder: str) -> DataFrame:
    """Null checks on sales before and after the validity split, as two recorded runs."""
    m = _models(spark, folder)
    checks = {"sales": quality.TableChecks(not_null=[
        "sale_date", "store_id", "product_id", "quantity", "amount_eur", "discount_pct"])}
    recorded = VersionedTable(spark, new_folder(spark, "check_results"))
    runs = {"before": m.typed_sales, "after": m.stg_sales}
    for run, sales in runs.items():
        results = quality.run_checks_measured({"sales": sales}, checks)
        recorded.append(observability.stamped(results, run, _at(FIRST_SNAPSHOT)), label=run)
    return observability.regressions(recorded.read(), "before", "after")


def _measured_run(spark: SparkSession, folder: str) -> DataFrame:
    """The run history of one build: every table written, its rows, and that it was timed."""
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    pipeline.build(StandIn(spark, folder), warehouse, _at(FIRST_SNAPSHOT))
    recorded = pipeline.record_steps(warehouse, "night", _at(FIRST_SNAPSHOT))
    return recorded.select(
        "run_id", "layer", "table_name", "n_rows", (F.col("seconds") > 0).alias("timed"))


def _stored_contract(spark: SparkSession, folder: str) -> DataFrame:
    """The whole contract, checked on what a build stored."""
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    pipeline.build(StandIn(spark, folder), warehouse, _at(FIRST_SNAPSHOT))
    return pipeline.check(warehouse, "night", _at(FIRST_SNAPSHOT), PART_CATEGORIES).select(
        "check_name", "table_name", "column_name", "failures", "passed")


def _compare_builds(spark: SparkSession, folder: str) -> DataFrame:
    """Two builds of the sales fact of which the second raised some amounts of the last day and
    lost some of its rows: the rows in which they differ."""
    table = VersionedTable(spark, new_folder(spark, "fct_sales"))
    table.replace(marts.fct_sales(_models(spark, folder).stg_sales), "sale_date")
    last = table.version().areas[ROWS].days()[-1]
    day = table.read(parts=[last])
    raised = F.when(F.col("quantity") % 2 == 0, F.col("amount_eur") + 1).otherwise(F.col("amount_eur"))
    changed = day.filter(F.col("quantity") % 5 != 0).withColumn("amount_eur", raised)
    table.replace_parts(changed, "sale_date", [last])
    return observability.differing_versions(table, 1, 2, ["sale_id"]).select(
        "sale_id", "sale_date", "quantity", "amount_eur", "n_left", "n_right")


def _schema_diff(spark: SparkSession, folder: str) -> DataFrame:
    """Columns that changed between two stored builds of the dimensions."""
    m = _models(spark, folder)
    warehouse = tables.Warehouse(spark, new_folder(spark, "warehouse"))
    first = {"dim_suppliers": m.dim_suppliers, "dim_stores": m.dim_stores, "dim_products": m.dim_products}
    second = {
        "dim_suppliers": m.dim_suppliers.drop("city").withColumn(
            "nominal_lead_time_days", F.col("nominal_lead_time_days").cast("double")),
        "dim_stores": m.dim_stores.withColumn("opened_on", F.current_date()),
        "dim_products": m.dim_products,
    }
    seen = []
    for build in (first, second):
        for name, df in build.items():
            warehouse.replace("marts", name, df)
        seen.append(observability.capture_schema(
            spark, {name: warehouse.read("marts", name) for name in build}))
    return observability.schema_changes(*seen)


# --- usage ----------------------------------------------------------------------------


def _usage(report: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: report(StandIn(spark, folder).usage_log())


def _storage(log: DataFrame) -> DataFrame:
    sized = log.select(
        "usage_date",
        (F.col("amount") * 1e9).alias("storage_bytes"),
        (F.col("amount") * 1e8).alias("stage_bytes"),
    )
    return usage.storage_average(sized, today=log.agg(F.max("usage_date")).scalar())


# --------------------------------------------------------------------------------------


def _at_risk(m: Models, **choice) -> DataFrame:
    return serving.at_risk(
        m.fct_inventory, m.dim_products, m.dim_stores, m.dim_suppliers, **choice
    )


def _kpis(m: Models, **choice) -> DataFrame:
    return serving.kpis(m.fct_inventory, m.fct_purchase_orders, m.sales_measures, **choice)


def _policy(m: Models) -> DataFrame:
    return planning.reorder_policy(m.daily_demand, m.stg_products, m.stg_suppliers)


NARROW = {"store_ids": TWO_STORES, "threshold": WIDE_THRESHOLD}


def queries() -> dict[str, Query]:
    return _warehouse_queries() | _document_queries()


def _document_queries() -> dict[str, Query]:
    if document_queries is None:
        return {}
    return {**document_queries.queries(), "pipeline": corpus_pipeline.run}


def _warehouse_queries() -> dict[str, Query]:
    return {
        # landing and staging
        "raw_sales_landing": _raw("sales"),
        "raw_inventory_landing": _raw("inventory_snapshots"),
        "raw_purchase_orders_landing": _raw("purchase_orders"),
        "stg_suppliers": _model("stg_suppliers"),
        "stg_products": _model("stg_products"),
        "stg_stores": _model("stg_stores"),
        "stg_sales_typed": _model("typed_sales"),
        "stg_sales": _model("stg_sales"),
        "stg_inventory_snapshots": _model("stg_inventory_snapshots"),
        "stg_purchase_orders": _model("stg_purchase_orders"),
        "quarantine_sales": _with(lambda m: m.quarantine_sales.drop("quarantined_at")),
        "quarantine_by_reason": _with(
            lambda m: quarantine.quarantine_by_reason(m.quarantine_sales)),
        "quarantine_count": _with(lambda m: quarantine.quarantine_count(m.quarantine_sales)),
        # intermediate and marts
        "daily_demand": _model("daily_demand"),
        "stock_status": _model("stock_status"),
        "po_delays": _model("po_delays"),
        "dim_suppliers": _model("dim_suppliers"),
        "dim_products": _model("dim_products"),
        "dim_stores": _model("dim_stores"),
        "dim_date": _model("dim_date"),
        "dim_suppliers_masked_analyst": _with(
            lambda m: marts.dim_suppliers_secure(m.dim_suppliers, "ANALYST")),
        "dim_suppliers_masked_transformer": _with(
            lambda m: marts.dim_suppliers_secure(m.dim_suppliers, "TRANSFORMER")),
        "fct_sales": _model("fct_sales"),
        "fct_inventory": _stored("fct_inventory", "snapshot_date", gather=DEAL_SNAPSHOTS),
        "fct_purchase_orders": _stored("fct_purchase_orders"),
        "fct_sales_incremental": _with(_incremental),
        "fct_sales_partial_day": _with(lambda m: _incremental(m, _partial_sales)),
        "fct_sales_table_load": _table_load,
        "pipeline_build": _pipeline_build,
        # history
        "suppliers_scd2": _with(lambda m: _by_day(_supplier_history(m))),
        "supplier_history_table": _supplier_history_table,
        "suppliers_as_of": _with(
            lambda m: _by_day(history.as_of(_supplier_history(m), _at(FIRST_SNAPSHOT)))),
        "orders_with_supplier_terms": _with(_orders_with_terms),
        # serving
        "kpis": _with(_kpis),
        "kpis_two_stores": _with(lambda m: _kpis(m, **NARROW)),
        "at_risk": _with(_at_risk),
        "at_risk_two_stores": _with(lambda m: _at_risk(m, **NARROW)),
        "supplier_lateness": _with(
            lambda m: serving.supplier_lateness(m.fct_purchase_orders, m.dim_suppliers)),
        "stockout_rate_by_tier": _with(
            lambda m: serving.stockout_rate_by_tier(
                m.fct_inventory, m.dim_products, m.dim_suppliers)),
        "revenue_by_day": _with(lambda m: serving.revenue_by_day(m.fct_sales)),
        "revenue_by_day_two_stores": _with(
            lambda m: serving.revenue_by_day(m.fct_sales, TWO_STORES)),
        "store_list": _with(lambda m: serving.store_list(m.dim_stores)),
        "data_as_of": _with(lambda m: serving.data_as_of(m.stg_inventory_snapshots)),
        # quality and observability
        "dq_unique": _with(_dq_unique),
        "dq_not_null": _with(lambda m: quality.not_null(m.typed_sales, "quantity")),
        "dq_accepted_values": _with(
            lambda m: quality.accepted_values(
                m.stg_products, "category", [c for c in PART_CATEGORIES if c != "PROMO"])),
        "dq_relationships": _with(
            lambda m: quality.relationships(m.fct_sales, "sale_date", m.dim_date, "date_day")),
        "dq_range": _with(lambda m: quality.accepted_range(m.typed_sales, "discount_pct", 0, 1)),
        "dq_unique_combo": _with(
            lambda m: quality.unique_combination(
                m.typed_sales, ["sale_date", "store_id", "product_id"])),
        "dq_expression": _with(
            lambda m: quality.expression_is_true(m.typed_sales, "amount_eur >= unit_price_eur")),
        "dq_delivery_agree": _with(_dq_delivery),
        "dq_late_agree": _with(_dq_late),
        "dq_revenue_reconciles": _with(
            lambda m: _incremental(m).filter(quality.revenue_drifts()).select("sale_id")),
        "dq_contract": _contract,
        "dq_summary": lambda spark, folder: quality.summarize(_contract(spark, folder)),
        "run_history": _run_history,
        "measured_run": _measured_run,
        "stored_contract": _stored_contract,
        "compare_builds": _compare_builds,
        "schema_diff": _schema_diff,
        "line_amounts": _with(lambda m: m.stg_sales.select(
            "sale_id", line_amount("quantity", "unit_price_eur", "discount_pct").alias("computed_eur"))),
        "build_fingerprint": _with(
            lambda m: _fingerprint_of({t: getattr(m, t) for t in (
                "fct_inventory", "fct_purchase_orders", "dim_suppliers", "dim_products",
                "dim_stores", "dim_date")} | {"fct_sales": m.sales_measures})),
        # raw zone
        "union_by_name_load": _union_by_name,
        "positional_load": _positional,
        "partitioned_sink": _partitioned_sink,
        "changed_files": _changed_files,
        "appended_bad_rows": _appended_bad_rows,
        "keyed_update": _keyed_update,
        "stored_raw_append": _stored_raw_append,
        "stored_raw_update": _stored_raw_update,
        "raw_row_counts": _raw_row_counts,
        "raw_lineage": _raw_lineage,
        "dimension_typed_read": _dimension_typed_read,
        "zone_to_marts": _zone_to_marts,
        "zone_second_build": _zone_second_build,
        "sql_serving": _sql_serving,
        "stream_load": _stream_load,
        # usage
        "usage_by_group": _usage(usage.usage_by_group),
        "usage_total": _usage(lambda log: usage.usage_total(log, "purchase")),
        "usage_7day_avg": _usage(_storage),
        "usage_top5": _usage(usage.busiest_types),
        "usage_top2_of_two": _usage(
            lambda log: usage.busiest_types(log, only=("purchase", "view"))),
        "usage_top5_of_a_warehouse": _usage(
            lambda log: usage.busiest_types(log, where={"warehouse": "WH-1"})),
        # planning
        "weekday_profile": _with(lambda m: planning.weekday_profile(m.stg_sales)),
        "reorder_policy": _with(_policy),
        "replenishment_orders": _with(
            lambda m: planning.replenishment_orders(
                serving.latest_snapshot(m.stg_inventory_snapshots), _policy(m))),
        "stock_ledger": _with(
            lambda m: planning.stock_ledger(
                m.keep("stg_inventory_snapshots").stg_inventory_snapshots, m.stg_sales, m.stg_purchase_orders)),
        "fill_rate": _with(lambda m: planning.fill_rate(m.stg_purchase_orders)),
        "in_transit": _with(
            lambda m: planning.in_transit(
                m.keep("stg_inventory_snapshots").stg_inventory_snapshots, m.stg_purchase_orders)),
    }


def oracle_sql() -> dict[str, str]:
    return ORACLES | (document_oracles.oracle_sql() if document_oracles else {})


def entry(spark: SparkSession) -> DataFrame:
    """The flagship question: which products are about to run out, and whose are they?"""
    return queries()["at_risk"](spark, "/root/testdata/sf0.001")
