"""Product conformance: governed attributes derived from names, source values kept for lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelake.functions import text


def conform_products(products: DataFrame, rules=None, lexicon=None,
                     word_boundary: bool = False) -> DataFrame:
    """One projection; `rules` and `lexicon` replace the built-in word lists."""
    name = F.col("name")
    category, subcategory = text.category_of(name, rules, word_boundary=word_boundary)
    return products.select(
        "product_id",
        text.strip(name).alias("product_name"),
        category.alias("category"),
        subcategory.alias("subcategory"),
        text.brand_of(name, lexicon).alias("brand"),
        text.audience_of(name).alias("audience"),
        text.color_options(F.col("subcategory")).alias("color_options"),
        "base_price",
        "base_rating",
        "image_url",
        F.col("category").alias("source_category"),
        F.col("brand").alias("source_brand"),
    )
