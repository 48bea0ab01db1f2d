"""RAW from files: what changed is read again, and nothing else."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from shelfwise.operators import incremental
from shelfwise.plans import intermediate, pipeline
from shelfwise.sources import landing, zone
from shelfwise.sources.schemas import RAW_COLUMNS, RAW_PATHS, SOURCE_FILE
from shelfwise.sources.tables import Warehouse
from shelfwise.sources.versions import VersionedTable

HEADERS = {name: ",".join(columns) for name, columns in RAW_COLUMNS.items()}


class Files:
    def __init__(self, root):
        self.root = root

    def put(self, name: str, *lines: str) -> None:
        path = Path(self.root.removeprefix("file:").removeprefix("//")) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("\n".join(lines) + "\n")

    def take(self, name: str) -> None:
        (Path(self.root.removeprefix("file:").removeprefix("//")) / name).unlink()


def sale(key, day, quantity=1, product="P1", amount="10.0"):
    return f"{key},{day},S1,{product},{quantity},10.0,0.0,{amount}"


@pytest.fixture
def files(folder):
    f = Files(f"{folder}/zone")
    f.put("suppliers/suppliers.csv", HEADERS["suppliers"], "U1,Un,FR,Lyon,5,0.9,2020-01-01")
    f.put("products/products.csv", HEADERS["products"], "P1,x,c,U1,1.0,2.0", "P2,y,c,U1,1.0,2.0")
    f.put("stores/stores.csv", HEADERS["stores"], "S1,a,Lyon,Sud")
    f.put("inventory/dt=2026-07-03/i.csv", HEADERS["inventory_snapshots"],
          "2026-07-03,S1,P1,5,3,0", "2026-07-03,S1,P2,0,3,0")
    f.put("purchase_orders/dt=2026-07-01/o.csv", HEADERS["purchase_orders"],
          "O1,2026-07-01,U1,P1,S1,5,2026-07-05,,")
    f.put("sales/dt=2026-07-01/s.csv", HEADERS["sales"], sale("a", "2026-07-01"), sale("b", "2026-07-01", 2))
    f.put("sales/dt=2026-07-02/s.csv", HEADERS["sales"], sale("c", "2026-07-02", 3), sale("bad", "2026-07-02", 0))
    f.put("sales/dt=2026-07-02/s2.csv", "amount_eur,discount_pct,unit_price_eur,quantity,product_id,store_id,sale_date,sale_id",
          "7.0,0.0,10.0,4,P2,S1,2026-07-01,late")
    return f


def content(df, *columns):
    return sorted((tuple(map(str, r)) for r in df.select(*columns).collect()))


def test_only_changed_days_are_read_again(spark, files, folder):
    table = VersionedTable(spark, f"{folder}/raw_sales")
    land = lambda: zone.land(spark, files.root, "sales", table)
    assert land() == zone.Landed(("d-2026-07-01", "d-2026-07-02"), (), 5)
    first = table.version().areas["rows"].parts
    assert land() == zone.Landed((), (), 0) and table.version().number == 1
    files.put("sales/dt=2026-07-02/s.csv", HEADERS["sales"], sale("c", "2026-07-02", 9))
    files.put("sales/dt=2026-07-03/s.csv", HEADERS["sales"] + ",note", sale("d", "2026-07-03") + ",new")
    assert land() == zone.Landed(("d-2026-07-02", "d-2026-07-03"), (), 3)
    assert table.version().areas["rows"].parts["d-2026-07-01"] == first["d-2026-07-01"]
    assert content(table.read(), "sale_id", "quantity", "note") == [
        ("a", "1", "None"), ("b", "2", "None"), ("c", "9", "None"), ("d", "1", "new"), ("late", "4", "None")]
    files.take("sales/dt=2026-07-01/s.csv")
    files.take("sales/dt=2026-07-03/s.csv")
    assert land() == zone.Landed((), ("d-2026-07-01", "d-2026-07-03"), 0)
    assert content(table.read(), "sale_id", "note") == [("c", "None"), ("late", "None")]
    whole = landing.read_union_by_name(spark, f"{files.root}/{RAW_PATHS['sales']}", RAW_COLUMNS["sales"])
    assert content(whole, *RAW_COLUMNS["sales"]) == content(table.read(), *RAW_COLUMNS["sales"])


def test_a_malformed_file_leaves_raw_as_it_was(spark, files, folder):
    table = VersionedTable(spark, f"{folder}/raw_sales")
    zone.land(spark, files.root, "sales", table)
    files.put("sales/dt=2026-07-02/s.csv", HEADERS["sales"], "too,few")
    with pytest.raises(Exception, match="MALFORMED"):
        zone.land(spark, files.root, "sales", table)
    assert table.read().count() == 5 and table.version().number == 1
    files.put("sales/dt=2026-07-02/s.csv", HEADERS["sales"], sale("c", "2026-07-02", 3))
    assert zone.land(spark, files.root, "sales", table).rows == 2


def demand(tables):
    return content(tables.sales.read_sums().transform(intermediate.daily_demand),
                   "store_id", "product_id", "units_last_28d")


def full_demand(tables):
    return content(tables.typed("sales").transform(intermediate.daily_demand),
                   "store_id", "product_id", "units_last_28d")


def at():
    return F.to_timestamp(F.lit("2026-07-18 00:00:00"))


def test_builds_on_a_zone_that_changes(spark, files, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    built, landed = pipeline.build_from_zone(files.root, warehouse, at())
    assert landed["sales"].rows == 5 and landed["stores"].rows == 1
    assert content(built["fct_sales"], "sale_id", "quantity") == [
        ("a", "1"), ("b", "2"), ("c", "3"), ("late", "4")]
    assert built["quarantine_sales"].count() == 1
    tables = pipeline.ZoneTables(warehouse)
    assert demand(tables) == full_demand(tables) == [("S1", "P1", "6"), ("S1", "P2", "4")]

    # The second day is sent again: one row replaced, one gone from the file, one moved, one late.
    files.put("sales/dt=2026-07-02/s.csv", HEADERS["sales"], sale("c", "2026-07-02", 5),
              sale("b", "2026-07-02", 7), sale("older", "2026-06-01", 1))
    built, landed = pipeline.build_from_zone(files.root, warehouse, at())
    assert landed["sales"].days == ("d-2026-07-02",) and landed["products"].rows == 0
    assert demand(tables) == full_demand(tables) == [("S1", "P1", "15"), ("S1", "P2", "4")]
    # The fact follows the high-water mark: the older row is not loaded; staging holds it.
    assert content(built["fct_sales"], "sale_id", "sale_date", "quantity") == [
        ("a", "2026-07-01", "1"), ("b", "2026-07-02", "7"), ("c", "2026-07-02", "5"),
        ("late", "2026-07-01", "4")]
    assert tables.typed("sales").count() == 6 and built["quarantine_sales"].count() == 0
    assert built["fct_inventory"].filter("product_id = 'P1'").first()["avg_daily_units"] == 15 / 28

    before = {t: x.table.version().number for t, x in (
        ("fact", pipeline.sales_fact(warehouse)), ("staged", tables.sales))}
    pipeline.build_from_zone(files.root, warehouse, at())
    assert before == {t: x.table.version().number for t, x in (
        ("fact", pipeline.sales_fact(warehouse)), ("staged", tables.sales))}


def test_demand_reads_the_last_days_of_the_sums_only(spark, files, folder):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    tables = pipeline.ZoneTables(warehouse)
    tables.land(files.root)
    plan = intermediate.daily_demand(tables.sales.read_sums())._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    filters = [x for x in plan.splitlines() if "PartitionFilters" in x]
    assert any("sale_date" in x and "subquery" in x for x in filters)
    assert "/typed_sales/sums" in plan and "/typed_sales/rows" not in plan


@pytest.mark.parametrize("dies", ["staging", "fact", "marts"])
def test_a_run_that_dies_is_made_up_for_by_the_next(spark, files, folder, dies, monkeypatch):
    warehouse = Warehouse(spark, f"{folder}/warehouse")
    pipeline.build_from_zone(files.root, warehouse, at())
    files.put("sales/dt=2026-07-02/s.csv", HEADERS["sales"], sale("c", "2026-07-02", 8))

    def lost(*a, **k):
        raise OSError("driver lost")

    where = {"staging": (pipeline.ZoneTables, "_stage_sales"), "fact": (pipeline, "sales_fact"),
             "marts": (pipeline, "build_marts")}[dies]
    monkeypatch.setattr(*where, lost)
    with pytest.raises(OSError):
        pipeline.build_from_zone(files.root, warehouse, at())
    monkeypatch.undo()
    built, landed = pipeline.build_from_zone(files.root, warehouse, at())
    assert landed["sales"].rows == 0  # landed before
    assert ("c", "8") in content(built["fct_sales"], "sale_id", "quantity")
    assert ("S1", "P1", "11") in full_demand(pipeline.ZoneTables(warehouse))
    assert demand(pipeline.ZoneTables(warehouse)) == full_demand(pipeline.ZoneTables(warehouse))


def test_typed_dimension_files(spark, files):
    files.put("stores2/s.csv", HEADERS["suppliers"], "U1,Un,FR,Lyon,many,0.9,2020-01-01")
    df = landing.read_dimension_csv(spark, f"{files.root}/suppliers/*.csv", "suppliers")
    assert df.first()["nominal_lead_time_days"] == 5
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        landing.read_dimension_csv(spark, f"{files.root}/stores2/*.csv", "suppliers").collect()


def test_days_of_rows_are_those_of_their_files(spark):
    paths = ["/z/sales/dt=2026-07-01/a.csv", "dt=x y/a.csv", "/z/dt=/dt=b/a.csv", "/z/dt=a/dt=b/c.csv",
             "/z/dt=a.csv", "/z/mydt=a/b.csv", "", None, "/z/dt=é%/n/a.csv", "dt=//dt=q/"]
    rows = zone.with_file_day(spark.createDataFrame([(p,) for p in paths], f"{SOURCE_FILE} string"))
    got = rows.withColumn("own", zone.file_day(F.col(SOURCE_FILE))).collect()
    assert [r[zone.DAY] for r in got] == [r["own"] for r in got]
    assert [r[zone.DAY] for r in got][:4] == ["d-2026-07-01", "d-x_y", "d-b", "d-a"]


def test_landing_and_a_first_load_move_no_row_twice(spark, files, folder, monkeypatch):
    """Files lie by day already, and nothing has to be taken away from an empty table."""
    stored, plain = [], incremental.written
    monkeypatch.setattr(incremental, "written", lambda df, label, *p: stored.append(label) or plain(df, label, *p))
    gathered, write = [], VersionedTable.write

    def noted(self, area, load, df, stored_by=None, sorted_by=(), gather=True):
        gathered.append((area, stored_by, gather))
        return write(self, area, load, df, stored_by, sorted_by, gather)

    monkeypatch.setattr(VersionedTable, "write", noted)
    pipeline.ZoneTables(Warehouse(spark, f"{folder}/w")).land(files.root)
    assert "batch" not in stored
    assert all(not gather for area, by, gather in gathered if by == zone.DAY)


@pytest.mark.parametrize(("days", "gathered"), [(7, False), (17, True)])
def test_few_snapshot_days_are_not_dealt_again(spark, files, folder, monkeypatch, days, gathered):
    """The join deals inventory by series, so few days are written from there; many are gathered."""
    for n in range(days):
        day = f"2026-06-{n + 1:02d}"
        files.put(f"inventory/dt={day}/i.csv", HEADERS["inventory_snapshots"], f"{day},S1,P1,3,5,0")
    seen, write = {}, VersionedTable.write

    def noted(self, area, load, df, stored_by=None, sorted_by=(), gather=True):
        seen[self.path.rsplit("/", 1)[1], area] = gather
        return write(self, area, load, df, stored_by, sorted_by, gather)

    monkeypatch.setattr(VersionedTable, "write", noted)
    # One day is in the files already.
    warehouse = Warehouse(spark, f"{folder}/w")
    built, _ = pipeline.build_from_zone(files.root, warehouse)
    assert seen["fct_inventory", "rows"] is gathered
    n = built["fct_inventory"].select("snapshot_date").distinct().count()
    assert (n > 16) is gathered and n == days + 1
