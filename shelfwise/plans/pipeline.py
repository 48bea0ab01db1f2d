"""The ordered build: RAW to staging, quarantine, marts, history and checks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cached_property
from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators import history
from shelfwise.operators.incremental import DailyFact
from shelfwise.operators.observability import stamped, steps_table
from shelfwise.operators.quality import run_checks_measured
from shelfwise.plans import intermediate, marts, quarantine, staging
from shelfwise.plans.contract import CATEGORIES, full_contract
from shelfwise.session import OPEN_FILES
from shelfwise.sources import zone as zone_files
from shelfwise.sources.schemas import RAW_COLUMNS
from shelfwise.sources.tables import Warehouse
from shelfwise.sources.versions import Version

#: Loads from landed sales carry the RAW version that they were made from.
RAW_LABEL = "raw-v"
#: The area of a landed RAW table with its typed rows.
TYPED = "typed"
# Layer of every stored table.
STORED = {
    "dim_suppliers": "marts", "dim_products": "marts", "dim_stores": "marts",
    "dim_date": "marts", "fct_sales": "marts", "fct_inventory": "marts",
    "fct_purchase_orders": "marts", "quarantine_sales": "quarantine",
    "suppliers_snapshot": "snapshots",
}


class RawTables(Protocol):
    """Raw tables by name: a dict, or anything that plans them when asked."""

    def __getitem__(self, name: str) -> DataFrame: ...


def as_plan(df: DataFrame, label: str) -> DataFrame:
    """Store nothing: every reader of a model repeats its plan."""
    return df


@dataclass(frozen=True, eq=False)
class Models:
    """Every model as a plan over the six raw tables; nothing runs until it is asked for.

    ``store`` is applied to results that one query reads more than once. ``session.written``
    puts them into the shared work folder, so that joins below them run once.
    """

    raw: RawTables
    store: Callable[[DataFrame, str], DataFrame] = as_plan
    kept: set[str] = field(default_factory=set)

    def keep(self, *names: str) -> Models:
        """Store these models now; models asked for later read the stored results."""
        for name in names:
            self.__dict__[name] = self.store(getattr(self, name), name)
            self.kept.add(name)
        return self

    @cached_property
    def stg_suppliers(self) -> DataFrame:
        return staging.stg_suppliers(self.raw["suppliers"])

    @cached_property
    def stg_products(self) -> DataFrame:
        return staging.stg_products(self.raw["products"])

    @cached_property
    def stg_stores(self) -> DataFrame:
        return staging.stg_stores(self.raw["stores"])

    @cached_property
    def typed_sales(self) -> DataFrame:
        return staging.typed_sales(self.raw["sales"])

    @cached_property
    def stg_sales(self) -> DataFrame:
        return staging.stg_sales(self.typed_sales)

    @cached_property
    def stg_inventory_snapshots(self) -> DataFrame:
        return staging.stg_inventory_snapshots(self.raw["inventory_snapshots"])

    @cached_property
    def stg_purchase_orders(self) -> DataFrame:
        return staging.stg_purchase_orders(self.raw["purchase_orders"])

    @cached_property
    def quarantine_sales(self) -> DataFrame:
        return quarantine.quarantine_sales(self.typed_sales)

    @cached_property
    def sales_measures(self) -> DataFrame:
        """The columns of valid sales that the measures need, read more than once."""
        measures = self.stg_sales.select(
            "sale_date", "store_id", "product_id", "quantity", "amount_eur"
        )
        return measures if "stg_sales" in self.kept else self.store(measures, "sales_measures")

    @cached_property
    def daily_demand(self) -> DataFrame:
        return intermediate.daily_demand(self.sales_measures)

    @cached_property
    def stock_status(self) -> DataFrame:
        """Demand is stored first: the planner then knows its size, and a join of two shuffled
        scans is one that adaptive execution can split where a key is hot."""
        demand = self.store(self.daily_demand, "daily_demand")
        return intermediate.stock_status(self.stg_inventory_snapshots, demand)

    @cached_property
    def po_delays(self) -> DataFrame:
        return intermediate.purchase_order_delays(self.stg_purchase_orders)

    @cached_property
    def dim_suppliers(self) -> DataFrame:
        return marts.dim_suppliers(self.stg_suppliers)

    @cached_property
    def dim_products(self) -> DataFrame:
        return marts.dim_products(self.stg_products)

    @cached_property
    def dim_stores(self) -> DataFrame:
        return marts.dim_stores(self.stg_stores)

    @cached_property
    def dim_date(self) -> DataFrame:
        return marts.dim_date(self.stg_inventory_snapshots)

    @cached_property
    def fct_sales(self) -> DataFrame:
        return marts.fct_sales(self.stg_sales)

    @cached_property
    def fct_inventory(self) -> DataFrame:
        return self.stock_status

    @cached_property
    def fct_purchase_orders(self) -> DataFrame:
        return self.po_delays


# Staging and intermediate models, which are views and not stored tables.
VIEWS = (
    "stg_suppliers", "stg_products", "stg_stores", "stg_sales", "stg_inventory_snapshots",
    "stg_purchase_orders", "daily_demand", "stock_status", "po_delays",
)


def create_views(models: Models, names=VIEWS) -> None:
    """Name these models for ``spark.sql``; nothing is stored."""
    for name in names:
        getattr(models, name).createOrReplaceTempView(name)


def sales_fact(warehouse: Warehouse) -> DailyFact:
    return DailyFact(warehouse.table("marts", "fct_sales"))


def build(raw: RawTables, warehouse: Warehouse, as_of: Column | None = None
          ) -> dict[str, DataFrame]:
    """One nightly run: every layer written, each stored table returned for reading.

    Raw sales are parsed once, into a typed table by day that tells valid from rejected rows; the
    fact, the quarantine and the demand rates read the columns and days they need from it, and a
    lost executor costs a re-read. ``fct_sales`` is loaded incrementally; the other tables are
    rebuilt. Tables change by commits, so a run that dies leaves readable tables.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    models = Models(raw)

    typed = models.typed_sales
    warehouse.replace("staging", "typed_sales",
                      typed.withColumn("is_valid", staging.sales_row_is_valid()), "sale_date")
    stored = warehouse.read("staging", "typed_sales")
    sales = stored.filter("is_valid").select(*typed.columns)
    rejected = stored.filter("NOT is_valid").select(*typed.columns)
    with warehouse.measured("marts", "fct_sales") as report:
        report["rows"] = sales_fact(warehouse).load(marts.fct_sales(sales), by_day=True)["rows"]
    return build_marts(models, warehouse, sales, rejected, as_of)


class ZoneTables:
    """Raw tables landed from a zone, and what is typed from them, kept up file day by file day."""

    def __init__(self, warehouse: Warehouse):
        self.warehouse = warehouse
        self.raw = {name: warehouse.table("raw", name) for name in RAW_COLUMNS}
        # Typed sales go by file day, the key, and are stored by sale day; so a file that is sent
        # again takes its former rows away wherever they were, and units add up by sale day.
        self.sales = DailyFact(
            warehouse.table("staging", "typed_sales"), key=zone_files.DAY, date="sale_date",
            sums=lambda rows: marts.daily_sums(rows.filter("is_valid")))

    def land(self, zone: str, loaded_at: Column | None = None) -> dict[str, zone_files.Landed]:
        """Read what changed in the zone; returns what was read for each table."""
        def typed(name):
            return lambda rows: staging.stage(rows, name, zone_files.DAY)

        landed = {}
        for name, table in self.raw.items():
            derived = {} if name == "sales" else {TYPED: typed(name)}
            landed[name] = zone_files.land(
                self.warehouse.spark, zone, name, table, derived, loaded_at)
            self.warehouse.register("raw", name)
        self._stage_sales()
        return landed

    def days_since(self, done: Version | None) -> tuple[set[str], set[str]]:
        """File days of raw sales that are new or changed since the state that a table was loaded
        from, and those that are gone. All are new where that state is not known any more."""
        raw = self.raw["sales"]
        now = raw.version().areas["rows"].parts
        before: dict = {}
        numbers = [int(x.removeprefix(RAW_LABEL)) for x in (done.labels if done else ())
                   if x.startswith(RAW_LABEL)]
        if numbers and raw.knows(max(numbers)):
            before = dict(raw.version(max(numbers)).areas["rows"].parts)
        return {d for d, load in now.items() if before.get(d) != load}, set(before) - set(now)

    def raw_label(self) -> str:
        return f"{RAW_LABEL}{self.raw['sales'].version().number}"

    def _stage_sales(self) -> None:
        """Type the file days that staging does not hold in RAW's state yet; a run that died
        between the two is made up for."""
        staged = self.sales.table.version()
        if staged is not None and self.raw_label() in staged.labels:
            return
        new, lost = self.days_since(staged)
        raw = self.raw["sales"]
        rows = raw.read_area("rows", raw.version().areas["rows"], new)
        typed = staging.typed_sales(rows, zone_files.DAY).withColumn(
            "is_valid", staging.sales_row_is_valid())
        gone = self.warehouse.spark.createDataFrame(
            [(day,) for day in sorted(lost | new)], f"{zone_files.DAY} string")
        self.sales.load(typed, self.raw_label(), only_newer=False, gone=gone)

    def __getitem__(self, name: str) -> DataFrame:
        return self.raw[name].read()

    def typed(self, name: str) -> DataFrame:
        if name == "sales":
            return self.sales.read().filter("is_valid").select(*RAW_COLUMNS["sales"])
        return self.raw[name].read(TYPED).select(*RAW_COLUMNS[name])


def build_from_zone(zone: str, warehouse: Warehouse, as_of: Column | None = None,
                    late_rows: bool = False) -> tuple[dict[str, DataFrame], dict]:
    """One nightly run on files: land what changed, type it, and build everything behind it.

    The sales fact is loaded from the file days that changed only. Like the load of whole raw tables
    it ignores rows older than its last day, unless ``late_rows``. Returns the stored tables and
    what was landed.
    """
    as_of = F.current_timestamp() if as_of is None else as_of
    tables = ZoneTables(warehouse)
    landed = tables.land(zone, as_of)
    models = Models(tables)
    for name in RAW_COLUMNS:
        if name != "sales":
            models.__dict__[f"stg_{name}"] = tables.typed(name)
            models.kept.add(f"stg_{name}")
    stored = tables.sales.read()
    rejected = stored.filter("NOT is_valid").select(*RAW_COLUMNS["sales"])
    fact = sales_fact(warehouse)
    loaded = fact.table.version()
    if loaded is None or tables.raw_label() not in loaded.labels:
        days, _ = tables.days_since(loaded)
        valid = stored.filter("is_valid")
        changed = valid if loaded is None else valid.filter(F.col(zone_files.DAY).isin(sorted(days)))
        fact.load(marts.fct_sales(changed), tables.raw_label(), only_newer=not late_rows)
    return build_marts(models, warehouse, tables.sales.read_sums(), rejected, as_of), landed


def build_marts(models: Models, warehouse: Warehouse, daily_sales: DataFrame,
                rejected: DataFrame, as_of: Column) -> dict[str, DataFrame]:
    """Everything behind typed sales and the sales fact. ``daily_sales`` are valid sales, or their
    sums by day, stored by day. The other staging tables are stored once and read from there."""
    out = warehouse.replace
    for name in VIEWS:
        if name.startswith("stg_") and name != "stg_sales" and name not in models.kept:
            out("staging", name, getattr(models, name))
            models.__dict__[name] = warehouse.read("staging", name)
    out("quarantine", "quarantine_sales", quarantine.quarantine_sales(rejected, as_of))
    out("marts", "dim_suppliers", models.dim_suppliers)
    out("marts", "dim_products", models.dim_products)
    out("marts", "dim_stores", models.dim_stores)
    warehouse.register("marts", "fct_sales")
    # Stored, so that the planner knows its size and can split a hot key of the join below.
    out("intermediate", "daily_demand", intermediate.daily_demand(daily_sales))
    demand = warehouse.read("intermediate", "daily_demand")
    snapshots = models.stg_inventory_snapshots
    days = snapshots.select("snapshot_date").distinct().limit(OPEN_FILES + 1).count()
    # The join deals rows by series, so each task has all days: few of them are not dealt again.
    out("marts", "fct_inventory", intermediate.stock_status(snapshots, demand), "snapshot_date",
        gather=days > OPEN_FILES)
    inventory = warehouse.read("marts", "fct_inventory")
    out("marts", "dim_date", marts.dim_date(inventory))
    out("marts", "fct_purchase_orders", models.fct_purchase_orders)

    with warehouse.measured("snapshots", "suppliers_snapshot") as report:
        report["rows"] = supplier_history(warehouse).observe(models.stg_suppliers, as_of)["open"]
    return stored_tables(warehouse)


def supplier_history(warehouse: Warehouse) -> history.SupplierHistory:
    return history.SupplierHistory(warehouse.table("snapshots", "suppliers_snapshot"))


def stored_tables(warehouse: Warehouse) -> dict[str, DataFrame]:
    """Every stored table of a build, for reading."""
    tables = {t: warehouse.read(layer, t) for t, layer in STORED.items() if layer != "snapshots"}
    return {**tables, "suppliers_snapshot": supplier_history(warehouse).read()}


def record_steps(warehouse: Warehouse, run_id: str, at: Column) -> DataFrame:
    """Append the writes of a run, with rows and seconds, to the run history; return it."""
    steps = steps_table(warehouse.spark, warehouse.steps)
    warehouse.append("observability", "model_runs", stamped(steps, run_id, at))
    return warehouse.read("observability", "model_runs")


def check(warehouse: Warehouse, run_id: str, at: Column, categories=CATEGORIES,
          zone_tables: ZoneTables | None = None) -> DataFrame:
    """Run the whole contract on a stored build, append the outcome with its durations to the
    history, return it. Staging is read as the build stored it, or as it was landed from a zone."""
    names = [n for n in VIEWS if n.startswith("stg_") and n != "stg_sales"]
    staged = {
        n: zone_tables.typed(n.removeprefix("stg_")) if zone_tables else warehouse.read("staging", n)
        for n in names
    }
    valid = warehouse.read("staging", "typed_sales").filter("is_valid").select(*RAW_COLUMNS["sales"])
    tables = {
        **staged, "stg_sales": valid,
        **{t: warehouse.read(layer, t) for t, layer in STORED.items() if layer == "marts"},
    }
    results = run_checks_measured(tables, full_contract(categories))
    warehouse.append("observability", "check_results", stamped(results, run_id, at))
    recorded = warehouse.read("observability", "check_results")
    return recorded.filter(F.col("run_id") == run_id)
