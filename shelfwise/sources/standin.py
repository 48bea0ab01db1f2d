"""The six raw text tables, derived from a TPC-H-like parquet folder.

Every raw table is a plain DataFrame over the given parquet files: defects, late deliveries
and short shipments follow from the keys, so results are the same on every run and engine.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.keys import business_key

SNAPSHOT_DAYS = 7
# Which residue of (7 * order + part) mod 400 plants which defect.
DEFECT_MODULUS = 400


@dataclass(frozen=True, eq=False)
class StandIn:
    spark: SparkSession
    folder: str

    @cache  # one schema lookup per table
    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def row_count(self, name: str) -> Column:
        """Row count as a scalar subquery; parquet answers it from file footers."""
        return self.table(name).agg(F.count(F.lit(1))).scalar()

    def last_ship_date(self) -> Column:
        return self.table("lineitem").agg(F.max(F.col("l_shipdate").cast("date"))).scalar()

    def suppliers(self) -> DataFrame:
        key = F.col("s_suppkey")
        return (
            self.table("supplier")
            .join(self.table("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                business_key("supplier", key).alias("supplier_id"),
                F.col("s_name").alias("supplier_name"),
                F.col("n_name").alias("country"),
                F.col("r_name").alias("city"),
                (4 + key % 17).cast("string").alias("nominal_lead_time_days"),
                ((75 + (key * 37) % 25) / 100.0).cast("string").alias("reliability_score"),
                F.lit("1995-01-01").alias("valid_from"),
            )
        )

    def products(self) -> DataFrame:
        key = F.col("p_partkey")
        cost = F.floor(F.col("p_retailprice") * (50 + (key * 7) % 30)) / 100.0
        return self.table("part").select(
            business_key("product", key).alias("product_id"),
            F.col("p_name").alias("product_name"),
            F.col("p_type").alias("category"),
            business_key("supplier", key % self.row_count("supplier")).alias("supplier_id"),
            cost.cast("string").alias("unit_cost_eur"),
            F.col("p_retailprice").cast("string").alias("unit_price_eur"),
        )

    def stores(self) -> DataFrame:
        return (
            self.table("nation")
            .join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                business_key("store", "n_nationkey").alias("store_id"),
                F.col("n_name").alias("store_name"),
                F.col("n_name").alias("city"),
                F.col("r_name").alias("region"),
            )
        )

    def sales(self) -> DataFrame:
        lines = self.table("lineitem")
        order_store = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .select("o_orderkey", "c_nationkey")
        )
        prices = self.table("part").select("p_partkey", "p_retailprice")
        # Two facts that grow together: neither side is ever broadcast.
        joined = lines.join(
            order_store.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")
        ).join(prices, F.col("l_partkey") == F.col("p_partkey"))
        defect, day, quantity = F.col("defect"), F.col("day"), F.col("units")
        amount = (
            F.round(
                F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount")) * 100
            )
            / 100.0
        )
        sale_parts = [F.col(c).cast("string") for c in
                      ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
        return joined.withColumns({
            "defect": (F.col("l_orderkey") * 7 + F.col("l_partkey")) % DEFECT_MODULUS,
            "day": F.col("l_shipdate").cast("date").cast("string"),
            "units": F.col("l_quantity").cast("int").cast("string"),
        }).select(
            F.concat_ws("-", F.lit("SAL"), *sale_parts, day).alias("sale_id"),
            F.when(defect == 1, "").when(defect == 8, "not-a-date").otherwise(day)
            .alias("sale_date"),
            F.when(defect != 9, business_key("store", "c_nationkey")).alias("store_id"),
            F.when(defect != 11, business_key("product", "l_partkey")).alias("product_id"),
            F.when(defect == 2, "0").when(defect == 3, "-3").when(defect == 4, " ")
            .when(defect == 10, F.concat(F.lit("  "), quantity, F.lit(" ")))
            .otherwise(quantity).alias("quantity"),
            F.col("p_retailprice").cast("string").alias("unit_price_eur"),
            F.when(defect == 5, "1.5").when(defect == 12, "")
            .otherwise(F.col("l_discount").cast("string")).alias("discount_pct"),
            F.when(defect == 6, "abc").when(defect == 7, "-30.0")
            .otherwise(amount.cast("string")).alias("amount_eur"),
        )

    def inventory_snapshots(self) -> DataFrame:
        part, store, back = F.col("p_partkey"), F.col("store.key"), F.col("day.back")
        supplier = part % self.row_count("supplier")
        score = 75 + (supplier * 37) % 25
        penalty = F.when(score >= 95, 0).when(score >= 85, 2).otherwise(5)
        stock = F.col("base") + (store * 17 + back * 7)
        tasks = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        key = F.col("n_nationkey")
        stores = self.table("nation").filter(key.isNotNull()).agg(F.collect_set(
            F.struct(key.alias("key"), business_key("store", key).alias("store_id")))).scalar()
        last = self.last_ship_date()
        days = F.array(*(
            F.struct(F.lit(x).alias("back"), F.date_sub(last, x).cast("string").alias("snapshot_date"))
            for x in range(SNAPSHOT_DAYS)))
        return (
            # Each part fans out to all stores and 7 days, so the keys are dealt out first, and
            # texts are made once a part, store and day.
            self.table("part").select("p_partkey").repartition(tasks, "p_partkey")
            .withColumns({
                "product_id": business_key("product", part), "base": part * 31, "penalty": penalty,
                "reorder_point": (10 + part % 20).cast("string"), "days": days,
            })
            .withColumn("store", F.explode(stores))
            .withColumn("day", F.explode("days"))
            .select(
                "day.snapshot_date", "store.store_id", "product_id",
                F.greatest(F.lit(0), stock % 61 - F.col("penalty")).cast("string").alias("on_hand_qty"),
                "reorder_point",
                F.when((part + store + back) % 3 == 0, "20").otherwise("0")
                .alias("in_transit_qty"),
            )
        )

    def purchase_orders(self) -> DataFrame:
        key = F.col("o_orderkey")
        joined = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .withColumn("supplier", key % self.row_count("supplier"))
            .withColumn("product", key % self.row_count("part"))
            .withColumn("ordered", 1 + key % 40)
            .withColumn("day", F.col("o_orderdate").cast("date"))
        )
        supplier, ordered = F.col("supplier"), F.col("ordered")
        promised = F.date_add("day", (4 + supplier % 17).cast("int"))
        slips = (key * 13) % 101 >= 75 + (supplier * 37) % 25
        arrived = F.date_add(promised, F.when(slips, 1 + key % 7).otherwise(0).cast("int"))
        received = F.when(key % 11 == 0, F.floor(ordered * 0.8)).otherwise(ordered)
        is_open = F.col("o_orderstatus") == "O"
        return joined.select(
            business_key("purchase_order", key).alias("po_id"),
            F.col("day").cast("string").alias("order_date"),
            business_key("supplier", supplier).alias("supplier_id"),
            business_key("product", "product").alias("product_id"),
            business_key("store", "c_nationkey").alias("store_id"),
            ordered.cast("string").alias("ordered_qty"),
            promised.cast("string").alias("promised_date"),
            F.when(is_open, "").otherwise(arrived.cast("string")).alias("actual_delivery_date"),
            F.when(is_open, "").otherwise(received.cast("string")).alias("received_qty"),
        )

    @cache
    def __getitem__(self, name: str) -> DataFrame:
        """A raw table by name, planned when it is first asked for."""
        return getattr(self, name)()

    def usage_log(self) -> DataFrame:
        """A usage log: what was used, where, when, how much."""
        return self.table("events").select(
            F.concat(F.lit("WH-"), F.col("user_id") % 3).alias("warehouse"),
            F.col("event_type").alias("resource"),
            F.col("ts").cast("date").alias("usage_date"),
            F.col("value").alias("amount"),
        )
