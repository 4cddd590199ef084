"""Onboarding of a marketplace export into the product catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelake import fixed_values as fixed
from pricelake.functions import numbers, text
from pricelake.operators import ranks
from pricelake.session import cut


def price_of(final: Column, initial: Column) -> Column:
    return F.coalesce(numbers.clean_price(final), numbers.clean_price(initial))


def category_path(raw: Column) -> tuple[Column, Column]:
    """(department, most specific node) of a JSON array of names.

    Only non-blank strings count as nodes; other JSON, or none, gives the defaults.
    """
    nodes = F.filter(
        F.try_parse_json(raw).try_cast("array<variant>"),
        lambda node: (F.schema_of_variant(node) == "STRING"))
    names = F.filter(F.transform(nodes, lambda node: node.cast("string")),
                     lambda name: text.strip(name) != "")
    first = F.coalesce(F.try_element_at(names, F.lit(1)), F.lit(fixed.NO_CATEGORY))
    last = F.coalesce(F.try_element_at(names, F.lit(-1)), F.lit(fixed.NO_SUBCATEGORY))
    return first, last


def brand_of(brand: Column, manufacturer: Column) -> Column:
    name = text.strip(F.coalesce(brand, manufacturer, F.lit(fixed.NO_BRAND)))
    return F.when(name.isin("", "nan"), fixed.NO_BRAND).otherwise(name)


def impute(products: DataFrame) -> DataFrame:
    """Fill missing prices and ratings with the exact median; ratings to 1..5, one place. NaN is missing.

    `products` is read once for each pass that narrows a median and should be a stored table.
    """
    products = products.withColumns({c: F.nullif(c, F.lit(float("nan"))) for c in ("base_price", "base_rating")})
    price = ranks.median(products, "base_price")
    rating = ranks.median(products, "base_rating")
    filled_price = F.coalesce("base_price", F.lit(price).cast("double"))
    filled_rating = F.coalesce("base_rating", F.lit(rating).cast("double"))
    return products.withColumns({
        "base_price": F.round(filled_price, 2),
        "base_rating": F.round(numbers.clip(filled_rating, 1.0, 5.0), 1),
    })


def onboard(export: DataFrame, order: str = "row") -> DataFrame:
    """The catalog from an export with columns title, brand, manufacturer, categories, final_price,
    initial_price, rating, image_url, asin, url and a unique numeric input position `order`."""
    department, node = category_path(F.col("categories"))
    rows = export.select(
        order,
        text.strip(F.col("title")).alias("name"),
        department.alias("category"),
        node.alias("subcategory"),
        brand_of(F.col("brand"), F.col("manufacturer")).alias("brand"),
        price_of(F.col("final_price"), F.col("initial_price")).alias("base_price"),
        F.col("rating").try_cast("double").alias("base_rating"),
        "image_url",
        F.col("asin").alias("source_asin"),
        F.col("url").alias("source_url"),
    )
    complete = impute(cut(rows, "onboarding")).dropna(subset=["name", "base_price"])
    return ranks.dense_ids(complete, order, "product_id").drop(order)


def profile(products: DataFrame) -> DataFrame:
    """Products per category, most first, with the number of distinct brands of the catalog."""
    brands = products.agg(F.count_distinct("brand").alias("brands"))
    return products.groupBy("category").agg(F.count("*").alias("products")).withColumn(
        "catalog_brands", brands.scalar()).orderBy(F.desc("products"), "category")
