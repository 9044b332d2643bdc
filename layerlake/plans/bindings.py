"""The raw retail tables, derived by Spark from the star-schema test tables.

Column names are those the cleaning plans expect. Prices stay floating point,
names keep their noise and dates of collection stay text, as raw data would.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import first_by_key
from ..operators.joins import with_registration_flags
from .cleaning import (
    clean_customers,
    clean_offers,
    clean_products,
    priced,
    priced_sales,
    unflagged_offers,
)

# thresholds that suit these tables
PRICE_BANDS = [(Decimal("975"), "PREMIUM"), (Decimal("925"), "MEDIO")]
SEGMENTS = [(Decimal("2100000"), "VIP"), (Decimal("1280000"), "TOP_TIER")]
MIN_COMPETITORS = 20
CHANNELS = ["F", "O"]
LINE_KEY = ["order_id", "line_no", "product_id", "supplier_id"]
UNKNOWN_PRODUCT = 10_000_000


class Tables:
    """The test tables of one folder and the retail tables made from them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # -- raw ---------------------------------------------------------------

    def raw_lines(self) -> DataFrame:
        """Order lines as they arrive: those of every tenth order come twice."""
        lines = self.single_lines()
        return lines.unionByName(lines.where(F.col("order_id") % 10 == 0))

    def single_lines(self) -> DataFrame:
        """Every order line once. Sales of some products name an id that no catalog holds."""
        product = F.col("l_partkey")
        cents = F.floor(F.rint(F.col("l_extendedprice") * 100) / F.col("l_quantity"))
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_linenumber").alias("line_no"),
            F.when(product % 150 == 7, product + UNKNOWN_PRODUCT).otherwise(product).alias("product_id"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_linestatus").alias("channel"),
            F.col("l_quantity").cast("bigint").alias("quantity"),
            (cents / 100).alias("unit_price"),
        )

    def raw_orders(self) -> DataFrame:
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderdate").alias("sold_at"),
        )

    def raw_sales(self) -> DataFrame:
        """Every raw line with its order, duplicates included."""
        return self.raw_lines().join(self.raw_orders(), "order_id")

    def raw_products(self) -> DataFrame:
        """The whole catalog."""
        part = self.table("part")
        named = F.when(F.col("p_size") == 7, "Brand#3").otherwise(F.col("p_brand"))
        created = F.date_add(F.lit("1995-01-01").cast("date"), F.col("p_size") * 4)
        return part.select(
            F.col("p_partkey").alias("product_id"),
            F.concat(F.lit("  "), "p_name", F.lit(" "), named, F.lit(" ")).alias("product_name"),
            F.col("p_type").alias("category"),
            F.col("p_brand").alias("brand"),
            F.col("p_retailprice").alias("list_price"),
            created.cast("timestamp_ntz").alias("created_at"),
        )

    def raw_customers(self) -> DataFrame:
        """Customers with titles and padding in some names and untidy state codes."""
        title = (
            F.when(F.col("c_mktsegment") == "MACHINERY", " Dr. ")
            .when(F.col("c_mktsegment") == "BUILDING", "Sra.   ")
            .when(F.col("c_mktsegment") == "FURNITURE", "Dr ")
            .otherwise("")
        )
        return self.table("customer").select(
            F.col("c_custkey").alias("customer_id"),
            F.concat(title, F.lower("c_name"), F.lit(" ")).alias("customer_name"),
            F.concat(F.lit(" nation_"), F.col("c_nationkey").cast("string"), F.lit(" ")).alias("state"),
        )

    def states(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
            F.col("n_name").alias("state"),
            F.concat(F.lit("State of "), "n_name").alias("state_name"),
            F.col("r_name").alias("region"),
        )

    def raw_offers(self) -> DataFrame:
        """Prices seen at suppliers, who act as competitors; pairs repeat.

        They are percentages of the list price: below it for some products,
        above it or equal for others, and on both sides for most.
        """
        spread = (F.col("l_suppkey") * 13 + F.col("l_orderkey") * 7) % 90
        kind = F.col("l_partkey") % 10
        percent = F.when(kind == 0, 70 + spread % 25).when(kind == 1, 105 + spread % 25).when(kind == 2, 100)
        cents = F.floor(F.rint(F.col("p_retailprice") * 100) * percent.otherwise(55 + spread) / 100)
        part = self.table("part").select("p_partkey", "p_retailprice")
        lines = self.table("lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
        return lines.select(
            F.col("l_partkey").alias("product_id"),
            F.col("l_suppkey").alias("competitor"),
            (cents / 100).alias("competitor_price"),
            F.col("l_shipdate").cast("string").alias("collected_at"),
        )

    def raw_event_sales(self) -> DataFrame:
        """Events as sales with a time of day: the type is the channel, ``k`` the quantity."""
        k = F.from_json("props", "k bigint")["k"]
        return self.table("events").select(
            F.col("event_id").alias("sale_id"),
            F.col("ts").alias("sold_at"),
            F.col("user_id").alias("customer_id"),
            F.col("event_type").alias("channel"),
            k.alias("quantity"),
            F.col("value").alias("unit_price"),
        )

    # -- cleaned -----------------------------------------------------------

    def products(self) -> DataFrame:
        return clean_products(self.raw_products(), bands=PRICE_BANDS)

    def customers(self) -> DataFrame:
        return clean_customers(self.raw_customers(), self.states())

    def offers(self) -> DataFrame:
        return clean_offers(self.raw_offers(), self.products())

    def unflagged_offers(self) -> DataFrame:
        return unflagged_offers(self.raw_offers())

    def sales(self) -> DataFrame:
        """Each order line once, with price, revenue and calendar, without catalog flags.

        Lines are de-duplicated before the orders are joined: repeated lines of
        one order collapse map-side and never meet in one join task.
        """
        lines = first_by_key(self.raw_lines(), LINE_KEY)
        return priced_sales(lines.join(self.raw_orders(), "order_id"))

    def line_sales(self) -> DataFrame:
        """Each order line once with its revenue, for questions that need no order."""
        return priced(first_by_key(self.raw_lines(), LINE_KEY))

    def order_sales(self) -> DataFrame:
        """De-duplicated sales totalled per order, with customer and day.

        For questions about customers: each order is one narrow row before the
        orders are joined, whatever its number of lines.
        """
        return self._per_order(self.line_sales()).withColumn("sale_date", F.to_date("sold_at"))

    def raw_priced(self) -> DataFrame:
        """Raw lines, repeats included, with exact revenue."""
        return priced(self.raw_lines())

    def single_priced(self) -> DataFrame:
        """Every order line once, as stored, with exact revenue."""
        return priced(self.single_lines())

    def raw_order_totals(self) -> DataFrame:
        """Raw lines totalled per order, with customer and time."""
        return self._per_order(self.raw_priced())

    def _per_order(self, lines: DataFrame) -> DataFrame:
        totals = lines.groupBy("order_id").agg(
            F.count("*").alias("n_sales"), F.sum("revenue_cents").alias("revenue_cents")
        )
        return totals.join(self.raw_orders(), "order_id")

    def flagged_sales(self) -> DataFrame:
        return with_registration_flags(self.sales(), self.products(), "product_id", "sold_at", "created_at")

    def sales_by_registration(self) -> DataFrame:
        """is_registered and n_sales of each sold product id.

        Sales are counted per id before the catalog is joined. The distinct
        keys are all that is needed of them, and orders are not.
        """
        counts = self.raw_lines().select(*LINE_KEY).distinct().groupBy("product_id").agg(F.count("*").alias("n_sales"))
        known = self.products().select("product_id", F.lit(True).alias("_known"))
        joined = counts.join(known, "product_id", "left")
        return joined.select(F.coalesce("_known", F.lit(False)).alias("is_registered"), "n_sales")

    def event_sales(self) -> DataFrame:
        return priced_sales(self.raw_event_sales(), keys=["sale_id"])
