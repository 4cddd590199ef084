"""Binds order-line tables (lineitem, part, events) to the raw schemas of the lake.

Each order line is one price observation of a part on its ship day. Facts violate the contracts on
purpose here and there, and keys repeat, so the whole path from raw to marts has work to do.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelake.functions import dates
from pricelake.operators import features
from pricelake.operators.conform import conform_products
from pricelake.operators.contracts import PRICE_FACTS, PRODUCTS
from pricelake.operators.dedup import keep_last
from pricelake.operators.observations import daily_observations, normalise_time
from pricelake.operators.scd2 import snapshot
from pricelake.fixed_values import SNAPSHOT_CHECK_COLUMNS
from pricelake.packaging import ship
from pricelake.plans import warehouse
from pricelake.session import cut

# Conformance rules for part names.
RULES = [
    ("Hardware", "Fasteners", ["bolt", "ring"]),
    ("Hardware", "Bar stock", ["rod", "plate"]),
    ("Gadgets", "Gadgets", ["gizmo", "widget"]),
]
LEXICON = ["Red", "Blue", "Hot", "Cold", "Old"]

AS_OF = dt.date(2001, 11, 5)
FIRST_SNAPSHOT = dt.datetime(1995, 1, 1)
SECOND_SNAPSHOT = dt.datetime(1998, 7, 1)
ORDINAL = ["_day", "_part", "_list", "_supplier", "_quantity", "_discount", "_tax", "_flag"]


class TradeFeed:
    """The tables of one folder as lake layers.

    Steps up to silver are lazy plans over the given tables. The layers that several queries share
    (silver and warehouse tables) are written once per session below the shared folder, as the daily run
    does, and read back with pruning and real file sizes.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    # ---- raw ----
    def raw_facts(self) -> DataFrame:
        """Facts with the ordinal columns that define which duplicate came last."""
        line = F.col
        day = line("l_shipdate").cast("date")
        return self.table("lineitem").select(
            (line("l_orderkey") * 10 + line("l_linenumber")).alias("fact_id"),
            line("l_partkey").alias("product_id"),
            dates.day_key(day).cast("bigint").alias("time_id"),
            F.round(line("l_extendedprice") * (1 - line("l_discount")), 4).alias("price"),
            line("l_extendedprice").alias("original_price"),
            F.round(line("l_discount") * 500, 4).alias("discount_percentage"),
            F.when(line("l_orderkey") % 97 == 5, "Maybe")
            .when(line("l_returnflag") == "R", "Out of Stock")
            .when(line("l_returnflag") == "N", "Low Stock")
            .otherwise("In Stock").alias("availability"),
            line("l_quantity").cast("int").alias("stock_level"),
            F.when(line("l_linenumber") != 7,
                   1 + (line("l_suppkey") % 41).cast("double") / 10).alias("rating"),
            (line("l_orderkey") % 500).alias("review_count"),
            F.round(line("l_quantity") * (1 + line("l_tax")), 4).alias("sales_velocity"),
            (line("l_returnflag") == "R").alias("is_trending"),
            day.alias("_day"),
            line("l_partkey").alias("_part"),
            line("l_extendedprice").alias("_list"),
            line("l_suppkey").alias("_supplier"),
            line("l_quantity").alias("_quantity"),
            line("l_discount").alias("_discount"),
            line("l_tax").alias("_tax"),
            line("l_returnflag").alias("_flag"),
        )

    def raw_products(self) -> DataFrame:
        part = F.col
        quoted = [F.concat(F.lit("'"), part(c), F.lit("'")) for c in ("p_brand", "p_type")]
        return self.table("part").select(
            part("p_partkey").alias("product_id"),
            part("p_name").alias("name"),
            part("p_type").alias("category"),
            F.concat(F.lit("["), quoted[0], F.lit(", "), quoted[1], F.lit("]")).alias("subcategory"),
            part("p_brand").alias("brand"),
            part("p_retailprice").alias("base_price"),
            (part("p_size").cast("double") / 10).alias("base_rating"),
            F.concat(F.lit("https://img.example/"), part("p_partkey").cast("string"))
            .alias("image_url"),
        )

    def raw_time(self) -> DataFrame:
        """The days on record, full_date still a timestamp text as sources ship it."""
        days = self.table("lineitem").select(F.col("l_shipdate").cast("date").alias("d")).distinct()
        return days.select(
            dates.day_key(F.col("d")).cast("bigint").alias("time_id"),
            F.concat(F.col("d").cast("string"), F.lit(" 18:38:42.334901")).alias("full_date"))

    # ---- bronze ----
    def last_facts(self) -> DataFrame:
        """The last duplicate of each fact.

        A fact has few duplicates, so reducing before the shuffle gains little, while its sort of a whole scan task grows
        with the split. Facts are dealt by key first and sorted in the shuffle's partitions; what is an ordinal under
        another name travels once.
        """
        facts = self.raw_facts()
        twice = {"product_id": F.col("_part"), "original_price": F.col("_list")}
        last = keep_last(facts.drop(*twice).repartition("fact_id"), ["fact_id"], ORDINAL)
        return last.withColumns(twice).select(*[c for c in facts.columns if c not in ORDINAL])

    @cached_property
    def time(self) -> DataFrame:
        return cut(normalise_time(self.raw_time()), "time")

    def bronze_facts(self) -> tuple[DataFrame, DataFrame]:
        return PRICE_FACTS.split(self.last_facts(), check_unique=False)

    def bronze_products(self) -> tuple[DataFrame, DataFrame]:
        return PRODUCTS.split(self.raw_products())

    # ---- silver ----
    def conformed(self) -> DataFrame:
        return conform_products(self.bronze_products()[0], RULES, LEXICON)

    def observed(self) -> DataFrame:
        return daily_observations(self.bronze_facts()[0], self.time)

    @cached_property
    def products(self) -> DataFrame:
        return cut(self.conformed(), "products")

    @cached_property
    def observations(self) -> DataFrame:
        """Silver observations below month=yyyy-MM; a range partitioning keeps any month in several
        tasks and sorts rows by product."""
        placed = self.observed().withColumn("month", dates.month_label(F.col("observed_date")))
        placed = placed.repartitionByRange("month", "product_id").sortWithinPartitions(
            "month", "product_id", "observed_date")
        return cut(placed, "observations", ["month"])

    # ---- gold ----
    def computed_features(self) -> DataFrame:
        """The feature table as a plan: a reader of few columns computes and moves those only."""
        return features.daily_features(self.observations.drop("month"))

    @cached_property
    def features(self) -> DataFrame:
        return cut(self.computed_features(), "features")

    # ---- warehouse ----
    def changed_products(self) -> DataFrame:
        """The second delivery: every tenth product has another brand."""
        tenth = F.col("product_id") % 10 == 0
        return self.products.withColumn(
            "brand", F.when(tenth, "Brand#99").otherwise(F.col("brand")))

    def history(self) -> DataFrame:
        first = snapshot(None, warehouse.stage_products(self.products), "product_id",
                         SNAPSHOT_CHECK_COLUMNS, FIRST_SNAPSHOT)
        return snapshot(first, warehouse.stage_products(self.changed_products()), "product_id",
                        SNAPSHOT_CHECK_COLUMNS, SECOND_SNAPSHOT)

    @cached_property
    def dim_product(self) -> DataFrame:
        return cut(warehouse.dim_product(self.history()), "dim_product")

    @cached_property
    def dim_date(self) -> DataFrame:
        return cut(warehouse.dim_date(self.observations), "dim_date")

    @cached_property
    def facts(self) -> DataFrame:
        return cut(warehouse.fact_price_observation(
            warehouse.stage_observations(self.observations), self.dim_product), "facts")

    @cached_property
    def performance(self) -> DataFrame:
        return cut(warehouse.product_performance(self.facts, self.dim_product), "performance")

    @cached_property
    def deals(self) -> DataFrame:
        return cut(warehouse.trending_deals(self.facts, self.dim_product, self.dim_date), "deals")

    @cached_property
    def rollup(self) -> DataFrame:
        return cut(warehouse.category_daily(self.facts, self.dim_product, self.dim_date), "rollup")

    # ---- events as price records ----
    def records(self) -> DataFrame:
        """Events in the landed shape of price records: id, created, and a nested JSON text."""
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("ts").cast("timestamp").alias("created"),
            "user_id", "event_type", "value", "props")


_feeds: dict[tuple[str, str], TradeFeed] = {}


def feed_of(spark: SparkSession, folder: str) -> TradeFeed:
    """One feed per session and folder, so that shared layers are written once."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _feeds:
        _feeds[key] = TradeFeed(ship(spark), folder)
    return _feeds[key]
