"""The given tables in the shape of raw marketplace extracts: text only, with realistic dirt.

Padding, mixed case, blanks, unreadable numbers, duplicate keys, unresolvable customers and
unknown products are spread over all rows by arithmetic on their keys, so that the cleaning rules
have work to do and an independent SQL text can state the same input.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

# One state code per nation, by nation key.
STATE_CODES = [
    "AC", "AL", "AM", "AP", "BA", "CE", "DF", "ES", "GO", "MA", "MG", "MS", "MT", "PA",
    "PB", "PE", "PI", "PR", "RJ", "RN", "RO", "RR", "RS", "SC", "SE", "SP", "TO",
]


def money_text(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.cast("decimal(12,2)").cast("string")


def _zip(nation_key: str) -> Column:
    return F.lpad(F.col(nation_key).cast("string"), 5, "0")


def _state(nation_key: str) -> Column:
    codes = F.array(*[F.lit(code) for code in STATE_CODES])
    return F.element_at(codes, F.col(nation_key) + 1)


class Extracts:
    """Raw extracts over one folder of given tables, each composed when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._given: dict[str, DataFrame] = {}

    def given(self, table: str) -> DataFrame:
        """A given table; zone-less timestamps are read as UTC instants."""
        if table not in self._given:
            df = self.spark.read.parquet(f"{self.folder}/{table}.parquet")
            zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, TimestampNTZType)]
            self._given[table] = df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})
        return self._given[table]

    @cached_property
    def orders(self) -> DataFrame:
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        bought = F.col("o_orderdate") + F.make_dt_interval(F.lit(0), key % 24, key % 60)
        delivered = bought + F.make_dt_interval(key % 30, key % 24)
        shipped = F.col("o_orderstatus").isin("F", "O")
        arrived = (F.col("o_orderstatus") == "F") & (key % 71 != 0)
        status = (
            F.when(key % 89 == 0, "  ")
            .when(F.col("o_orderstatus") == "F", " delivered")
            .when(F.col("o_orderstatus") == "O", "Shipped ")
            .otherwise("canceled")
        )
        promised = F.date_trunc("day", bought) + F.make_dt_interval(10 + customer % 15)
        blank = F.lit("")
        return self.given("orders").select(
            key.cast("string").alias("order_id"),
            F.concat_ws("-", customer, key).alias("customer_id"),
            status.alias("order_status"),
            F.when(key % 401 == 0, blank).otherwise(bought.cast("string")).alias("order_purchase_timestamp"),
            F.when(key % 17 == 0, "n/a")
            .otherwise((bought + F.make_dt_interval(F.lit(0), key % 5)).cast("string"))
            .alias("order_approved_at"),
            F.when(shipped, (bought + F.make_dt_interval(1 + key % 3)).cast("string"))
            .otherwise(blank)
            .alias("order_delivered_carrier_date"),
            F.when(arrived, delivered.cast("string")).otherwise(blank).alias("order_delivered_customer_date"),
            promised.cast("string").alias("order_estimated_delivery_date"),
        )

    @cached_property
    def customers(self) -> DataFrame:
        """One row per order, as the source mints a customer id with every order."""
        key, customer = F.col("o_orderkey"), F.col("o_custkey")
        bought_by = F.when(customer % 97 == 0, F.concat_ws("-", F.lit("lost"), customer, key)).otherwise(
            F.concat_ws("-", customer, key)
        )
        city = F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit("  \t"), (key % 5).cast("string"))
        orders = self.given("orders").select("o_orderkey", "o_custkey")
        people = self.given("customer").select("c_custkey", "c_nationkey", "c_mktsegment")
        return orders.join(people, customer == F.col("c_custkey")).select(
            bought_by.alias("customer_id"),
            customer.cast("string").alias("customer_unique_id"),
            _zip("c_nationkey").alias("customer_zip_code_prefix"),
            F.when(customer % 13 == 0, "   ").otherwise(city).alias("customer_city"),
            F.concat(F.lower(_state("c_nationkey")), F.lit(" ")).alias("customer_state"),
        )

    @cached_property
    def order_items(self) -> DataFrame:
        """One row per order line; lines delivered in several parts are added up."""
        key = F.col("l_orderkey")
        lines = (
            self.given("lineitem")
            .groupBy("l_orderkey", "l_linenumber")
            .agg(
                F.min("l_partkey").alias("part"),
                F.min("l_suppkey").alias("supplier"),
                F.max("l_shipdate").alias("limit"),
                # Eight digits leave the sum within 64 bits, which Spark adds as plain longs.
                F.sum(F.col("l_extendedprice").cast("decimal(8,2)")).alias("price"),
                F.sum(F.col("l_quantity").cast("decimal(8,2)")).alias("freight"),
            )
        )
        product = F.when(key % 151 == 0, F.concat(F.lit("x"), F.col("part"))).otherwise(F.col("part").cast("string"))
        return lines.select(
            key.cast("string").alias("order_id"),
            F.concat(F.lit(" "), F.col("l_linenumber")).alias("order_item_id"),
            product.alias("product_id"),
            F.col("supplier").cast("string").alias("seller_id"),
            F.col("limit").cast("string").alias("shipping_limit_date"),
            F.col("price").cast("string").alias("price"),
            F.when(key % 211 == 0, "s/d").otherwise(F.col("freight").cast("string")).alias("freight_value"),
        )

    @cached_property
    def payments(self) -> DataFrame:
        key = F.col("o_orderkey")
        kinds = F.array(*[F.lit(kind) for kind in ("Credit_Card", " boleto", "VOUCHER  ", "debit  card")])
        return (
            self.given("orders")
            .select("o_orderkey", "o_totalprice", F.explode(F.sequence(F.lit(1), 1 + key % 3)).alias("n"))
            .select(
                key.cast("string").alias("order_id"),
                F.col("n").cast("string").alias("payment_sequential"),
                F.element_at(kinds, (1 + key % 4).cast("int")).alias("payment_type"),
                F.when(key % 23 == 0, "").otherwise((1 + key % 12).cast("string")).alias("payment_installments"),
                money_text("o_totalprice").alias("payment_value"),
            )
        )

    @cached_property
    def reviews(self) -> DataFrame:
        """Some rows come twice; a review id covers two orders."""
        key = F.col("doc_id")
        created = F.lit("1995-06-01").cast("timestamp") + F.make_dt_interval((key % 2000).cast("int"))
        answered = created + F.make_dt_interval(F.lit(0), F.col("n_chars") % 100, key % 60)
        return (
            self.given("documents")
            .select("*", F.explode(F.sequence(F.lit(1), F.when(key % 50 == 0, 2).otherwise(1))))
            .select(
                F.concat(F.lit("r"), F.floor(key / 2)).alias("review_id"),
                (key * 7).cast("string").alias("order_id"),
                (1 + key * 7 % 5).cast("string").alias("review_score"),
                F.when(key % 3 == 0, "   ").otherwise(F.col("lang")).alias("review_comment_title"),
                F.col("text").alias("review_comment_message"),
                created.cast("string").alias("review_creation_date"),
                F.when(key % 37 == 0, "").otherwise(answered.cast("string")).alias("review_answer_timestamp"),
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        key, size = F.col("p_partkey"), F.col("p_size")
        category = F.when(key % 50 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("p_type")))
        grams = (size * 100).cast("string")
        return self.given("part").select(
            key.cast("string").alias("product_id"),
            category.alias("product_category_name"),
            F.length("p_name").cast("string").alias("product_name_lenght"),
            F.length("p_brand").cast("string").alias("product_description_lenght"),
            F.when(key % 19 == 0, "").otherwise((size % 5).cast("string")).alias("product_photos_qty"),
            F.when(key % 41 == 0, "?").when(key % 3 == 0, F.concat(grams, F.lit(".0"))).otherwise(grams)
            .alias("product_weight_g"),
            size.cast("string").alias("product_length_cm"),
            (size + 1).cast("string").alias("product_height_cm"),
            (size + 2).cast("string").alias("product_width_cm"),
        )

    @cached_property
    def categories(self) -> DataFrame:
        """Category catalogue with conflicting translations; one category is missing from it."""
        return (
            self.given("part")
            .where("p_type <> 'SMALL'")
            .select(
                F.col("p_type").alias("product_category_name"),
                F.concat(F.lit("EN  "), "p_type", F.lit(" "), (F.col("p_size") % 2).cast("string")).alias(
                    "product_category_name_english"
                ),
            )
            .distinct()
        )

    @cached_property
    def sellers(self) -> DataFrame:
        suppliers = self.given("supplier").select("s_suppkey", "s_nationkey")
        nations = self.given("nation").select("n_nationkey", "n_name")
        return suppliers.join(nations, F.col("s_nationkey") == F.col("n_nationkey")).select(
            F.col("s_suppkey").cast("string").alias("seller_id"),
            _zip("s_nationkey").alias("seller_zip_code_prefix"),
            F.concat(F.col("n_name"), F.lit("   city ")).alias("seller_city"),
            F.lower(_state("s_nationkey")).alias("seller_state"),
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        """One observation per customer; some coordinates are unreadable."""
        key = F.col("c_custkey")
        return self.given("customer").select(
            _zip("c_nationkey").alias("geolocation_zip_code_prefix"),
            F.when(key % 31 == 0, "").otherwise(money_text("c_acctbal")).alias("geolocation_lat"),
            money_text(-F.col("c_acctbal")).alias("geolocation_lng"),
            F.when(key % 11 == 0, " ").otherwise(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("geolocation_city"),
            _state("c_nationkey").alias("geolocation_state"),
        )

    def as_clicks(self, events: DataFrame) -> DataFrame:
        """Events, stored or streamed, in the terms of the purchase funnel."""
        steps = F.create_map(
            *[F.lit(v) for v in ("view", "view", "click", "cart", "signup", "checkout", "purchase", "payment")]
        )
        return events.select(
            "event_id",
            "user_id",
            F.col("ts").cast("timestamp").alias("ts"),
            F.element_at(steps, F.col("event_type")).alias("step"),
            "value",
            "props",
        )

    @cached_property
    def clicks(self) -> DataFrame:
        return self.as_clicks(self.given("events"))
