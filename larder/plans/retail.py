"""The twelve domain tables as views over the star-schema Parquet files.

Every expression is a deterministic function of the source row. Money is computed in
whole cents, so sums are exact and repeatable.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values
ITEM_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
UNITS = ("portion", "plate", "bowl", "glass", "piece")
WASTE_REASONS = ("expired", "overproduction", "spoiled", "returned", "damaged")
PROMO_COUNT = 24
PROMO_START = "1995-03-01"
PROMO_EVERY_DAYS = 90
PROMO_LENGTH_DAYS = 30
PERIOD_START = "1995-01-01"


def _every(key: str, n: int) -> Column:
    return F.col(key) % n == 0


def _cents(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def _money(cents: Column, type_: str) -> Column:
    return (cents.cast("decimal(18,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(type_)


def _pick(values: tuple[str, ...], position: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), position.cast("int") + 1)


# fixed values: table name to the property that builds it
TABLE_VIEWS = {
    "Customers": "customers",
    "Restaurants": "restaurants",
    "Menu_Categories": "categories",
    "Menu_Items": "menu",
    "Pricing_History": "pricing",
    "Promotions": "promotions",
    "Promotion_Items": "promotion_items",
    "Orders": "orders",
    "Order_Items": "lines",
    "Ratings": "ratings",
    "Inventory": "inventory",
    "Wastage": "wastage",
}


class Retail(Mapping[str, DataFrame]):
    """Table name to DataFrame; a table's plan is built when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir
        self._files: dict[str, DataFrame] = {}

    def __getitem__(self, table: str) -> DataFrame:
        return getattr(self, TABLE_VIEWS[table])

    def __iter__(self) -> Iterator[str]:
        return iter(TABLE_VIEWS)

    def __len__(self) -> int:
        return len(TABLE_VIEWS)

    def _read(self, name: str) -> DataFrame:
        if name not in self._files:
            self._files[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._files[name]

    def _part(self) -> DataFrame:
        type_idx = F.array_position(F.array(*[F.lit(t) for t in ITEM_TYPES]), F.col("p_type")) - 1
        brand = F.substring_index("p_brand", "#", -1).cast("bigint")
        return self._read("part").select(
            F.col("p_partkey").alias("l_partkey"),
            (25 * type_idx + brand).cast("bigint").alias("item"),
            (type_idx + 1).cast("bigint").alias("category_id"),
            "p_type",
            F.concat_ws(" ", "p_type", "p_brand").alias("item_name"),
            _cents("p_retailprice").alias("retail_c"),
        )

    def _sold(self) -> DataFrame:
        """Line items with item number and cent amounts."""
        qty = F.col("l_quantity").cast("bigint")
        price = F.floor((2 * _cents("l_extendedprice") + qty) / (2 * qty)).cast("bigint")
        gross = F.col("qty") * F.col("price_c")
        disc = F.floor((gross * F.round(F.col("l_discount") * 100).cast("bigint") + 50) / 100).cast("bigint")
        return (
            self._read("lineitem")
            .join(self._part().select("l_partkey", "item", "retail_c"), "l_partkey")
            .select(
                "l_orderkey",
                "l_partkey",
                "l_linenumber",
                "l_discount",
                "l_returnflag",
                "l_shipdate",
                "item",
                "retail_c",
                qty.alias("qty"),
                price.alias("price_c"),
                (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_id"),
            )
            .withColumn("disc_c", F.when(_every("l_partkey", 503), gross + 500).otherwise(disc))
        )

    def _placed(self) -> DataFrame:
        """Which restaurant took which order."""
        return (
            self._read("orders")
            .select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
            .join(self._read("customer").select("c_custkey", "c_nationkey"), "c_custkey")
            .select("l_orderkey", F.col("c_nationkey").cast("bigint").alias("restaurant_id"))
        )

    @cached_property
    def categories(self) -> DataFrame:
        return self._part().select("category_id", F.col("p_type").alias("category_name")).distinct()

    @cached_property
    def menu(self) -> DataFrame:
        items = self._part().groupBy(F.col("item").alias("menu_item_id"), "category_id", "item_name").agg(
            F.max("retail_c").alias("c")
        )
        k = "menu_item_id"
        price = (
            F.when(_every(k, 47), F.lit(None))
            .when(_every(k, 53), F.lit(-1000))
            .when(_every(k, 59), F.lit(9_999_999))
            .otherwise(F.col("c"))
        )
        return items.select(
            k,
            "category_id",
            "item_name",
            F.concat(F.lit("Menu item "), F.col("item_name")).alias("description"),
            _money(price, "decimal(10,2)").alias("base_price"),
            _money(F.col("c"), "decimal(10,2)").alias("standard_cost"),
            (F.col(k) % 10 != 0).alias("availability"),
            _pick(UNITS, F.col(k) % 5).alias("unit_of_measure"),
            F.date_add(F.lit(PERIOD_START).cast("date"), (F.col(k) % 30).cast("int")).alias("launch_date"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        return self._read("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.date_add(F.lit(PERIOD_START).cast("date"), (F.col("c_custkey") % 365).cast("int")).alias(
                "registration_date"
            ),
        )

    @cached_property
    def restaurants(self) -> DataFrame:
        return (
            self._read("nation")
            .join(self._read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
            .select(
                F.col("n_nationkey").cast("bigint").alias("restaurant_id"),
                F.col("n_name").alias("restaurant_name"),
                F.col("r_name").alias("city"),
            )
        )

    @cached_property
    def orders(self) -> DataFrame:
        k = "o_orderkey"
        since = F.datediff("o_orderdate", F.lit(PROMO_START).cast("date"))
        campaign = F.floor(since / PROMO_EVERY_DAYS).cast("bigint")
        in_window = (
            _every(k, 4) & campaign.between(0, PROMO_COUNT - 1) & (F.pmod(since, F.lit(PROMO_EVERY_DAYS)) <= PROMO_LENGTH_DAYS)
        )
        total = _cents("o_totalprice")
        disc = F.floor(total * (F.col(k) % 11) / 100).cast("bigint")
        sub = total + disc
        placed = self._read("customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
        return (
            self._read("orders")
            .join(placed, "o_custkey", "left")
            .select(
                F.col(k).alias("order_id"),
                F.when(~_every(k, 331), F.col("o_custkey")).alias("customer_id"),
                F.when(_every(k, 499), F.lit(-999)).otherwise(F.col("c_nationkey")).cast("bigint").alias("restaurant_id"),
                F.when(in_window, campaign).alias("promotion_id"),
                F.timestamp_add(
                    "MINUTE",
                    ((8 + F.col(k) % 16) * 60 + (F.col(k) * 7) % 60).cast("int"),
                    F.col("o_orderdate").cast("timestamp"),
                ).alias("order_timestamp"),
                F.col("o_orderpriority").alias("order_channel"),
                F.when(F.col("o_orderstatus").isin("F", "O"), "completed")
                .when(_every(k, 2), "cancelled")
                .otherwise("pending")
                .alias("order_status"),
                F.when(~_every(k, 467), _money(sub, "decimal(12,2)")).alias("subtotal"),
                _money(F.when(_every(k, 397), sub + 100).otherwise(disc), "decimal(12,2)").alias("discount_total"),
                _money(total, "decimal(12,2)").alias("total_amount"),
            )
        )

    @cached_property
    def lines(self) -> DataFrame:
        gross = F.col("qty") * F.col("price_c")
        return self._sold().select(
            F.col("line_id").alias("order_item_id"),
            F.col("l_orderkey").alias("order_id"),
            F.when(~_every("l_partkey", 307), F.col("item")).alias("menu_item_id"),
            F.when(_every("l_partkey", 401), -F.col("qty")).otherwise(F.col("qty")).cast("decimal(10,2)").alias("quantity"),
            _money(F.col("price_c"), "decimal(10,2)").alias("unit_price"),
            _money(2 * F.col("retail_c"), "decimal(10,2)").alias("unit_cost"),
            _money(F.col("disc_c"), "decimal(12,2)").alias("discount_amount"),
            _money(gross - F.col("disc_c"), "decimal(12,2)").alias("line_total"),
        )

    @cached_property
    def promotions(self) -> DataFrame:
        return self.promotion_items.select("promotion_id").distinct().select(
            "promotion_id",
            F.concat(F.lit("Campaign "), F.col("promotion_id").cast("string")).alias("promotion_name"),
            F.when(_every("promotion_id", 2), "percent").otherwise("fixed").alias("discount_type"),
            (5 + F.col("promotion_id") % 4).cast("decimal(10,2)").alias("discount_value"),
            F.concat(F.lit("C"), F.col("promotion_id").cast("string")).alias("coupon_code"),
            F.date_add(F.lit(PROMO_START).cast("date"), (F.col("promotion_id") * PROMO_EVERY_DAYS).cast("int")).alias(
                "start_date"
            ),
            F.date_add(
                F.lit(PROMO_START).cast("date"),
                (F.col("promotion_id") * PROMO_EVERY_DAYS + PROMO_LENGTH_DAYS).cast("int"),
            ).alias("end_date"),
        )

    @cached_property
    def promotion_items(self) -> DataFrame:
        return self._part().select(
            (F.col("item") % PROMO_COUNT).alias("promotion_id"), F.col("item").alias("menu_item_id")
        ).distinct()

    @cached_property
    def events(self) -> DataFrame:
        """The raw event log, for operators the orders of the driver data cannot exercise."""
        return self._read("events").select("event_id", "user_id", "event_type", "ts", "value")

    @cached_property
    def ratings(self) -> DataFrame:
        return self._read("events").select(
            F.col("event_id").alias("rating_id"),
            F.col("user_id").alias("customer_id"),
            F.get_json_object("props", "$.k").cast("bigint").alias("menu_item_id"),
            (F.col("event_id") % 25).alias("restaurant_id"),
            (F.floor("value").cast("int") % 7).alias("rating_value"),
            F.when(~_every("event_id", 521), F.col("ts").cast("timestamp")).alias("rating_timestamp"),
        )

    @cached_property
    def wastage(self) -> DataFrame:
        unit = F.when(_every("l_partkey", 409), F.lit("kg")).otherwise(_pick(UNITS, F.col("item") % 5))
        return (
            self._sold()
            .where(F.col("l_returnflag") == "R")
            .join(self._placed(), "l_orderkey")
            .select(
                F.col("line_id").alias("wastage_id"),
                F.col("item").alias("menu_item_id"),
                "restaurant_id",
                F.when(~_every("l_partkey", 461), F.to_date("l_shipdate")).alias("wastage_date"),
                F.col("qty").cast("decimal(12,3)").alias("quantity_wasted"),
                unit.alias("unit_of_measure"),
                _money(F.col("qty") * 2 * F.col("retail_c"), "decimal(10,2)").alias("wastage_cost"),
                _pick(WASTE_REASONS, F.col("l_linenumber") % 5).alias("wastage_reason"),
            )
        )

    @cached_property
    def inventory(self) -> DataFrame:
        monthly = (
            self._sold()
            .where(F.col("l_returnflag") != "R")
            .join(self._placed(), "l_orderkey")
            .groupBy(
                F.col("item").alias("menu_item_id"),
                "restaurant_id",
                F.trunc(F.to_date("l_shipdate"), "month").alias("inventory_date"),
            )
            .agg(F.sum("qty").alias("used"))
        )
        month_no = F.year("inventory_date") * 12 + F.month("inventory_date")
        inv_id = (F.col("menu_item_id") * 100 + F.col("restaurant_id")) * 100_000 + month_no
        tenth = F.lit("0.1").cast("decimal(2,1)")
        used = F.col("used").cast("decimal(12,0)")
        return monthly.withColumn("inventory_id", inv_id.cast("bigint")).select(
            "inventory_id",
            "menu_item_id",
            "restaurant_id",
            "inventory_date",
            (used * 12 * tenth).cast("decimal(12,3)").alias("opening_quantity"),
            (used * 3 * tenth).cast("decimal(12,3)").alias("replenishment_quantity"),
            F.when(_every("inventory_id", 401), -used).otherwise(used).cast("decimal(12,3)").alias(
                "consumption_quantity"
            ),
            (used * 5 * tenth).cast("decimal(12,3)").alias("closing_quantity"),
            F.when(_every("menu_item_id", 29), F.lit("kg"))
            .otherwise(_pick(UNITS, F.col("menu_item_id") % 5))
            .alias("unit_of_measure"),
        )

    @cached_property
    def pricing(self) -> DataFrame:
        yearly = self._sold().groupBy(
            F.col("item").alias("menu_item_id"), F.year("l_shipdate").alias("y")
        ).agg(F.sum("price_c").alias("s"), F.count("*").alias("n"))
        key = (F.col("menu_item_id") * 10_000 + F.col("y")).cast("bigint")
        avg_c = F.floor((2 * F.col("s") + F.col("n")) / (2 * F.col("n"))).cast("bigint")
        return yearly.withColumn("pricing_history_id", key).select(
            "pricing_history_id",
            "menu_item_id",
            F.make_date(F.col("y"), F.lit(1), F.lit(1)).alias("effective_date"),
            _money(F.when(_every("pricing_history_id", 97), F.lit(-1000)).otherwise(avg_c), "decimal(10,2)").alias(
                "unit_price"
            ),
        )
