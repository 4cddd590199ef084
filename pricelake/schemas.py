"""Explicit schemas of the landed and conformed tables. Nothing in the lake relies on inference."""

from __future__ import annotations

from pyspark.sql.types import StructType

_DDL = {
    "products": "product_id bigint, name string, category string, subcategory string, brand string, "
                "base_price double, base_rating double, image_url string",
    "price_facts": "fact_id bigint, product_id bigint, time_id bigint, price double, "
                   "original_price double, discount_percentage double, availability string, "
                   "stock_level bigint, rating double, review_count bigint, sales_velocity double, "
                   "is_trending boolean",
    "time": "time_id bigint, full_date string, day_of_week string, day_of_month bigint, month bigint, "
            "month_name string, quarter bigint, year bigint, is_weekend boolean",
    "open_prices": "id bigint, product_code string, product_name string, category_tag string, "
                   "price double, currency string, date string, location_osm_display_name string, "
                   "created string",
    "open_prices_nested": "id bigint, product_code string, product struct<product_name: string>, "
                          "category_tag string, price double, currency string, date string, "
                          "location_osm_display_name string, created string",
    "ingestion_state": "source string, watermark string, updated_at timestamp",
    "manifests": "source string, dataset string, load_date string, rows bigint, schema_hash string, "
                 "extracted_at timestamp, params map<string,string>",
    "runs": "run_id string, experiment string, logged_at timestamp, params map<string,string>, "
            "metrics map<string,double>, tags map<string,string>",
}

OBSERVATION_COLUMNS = [
    "product_id", "observed_date", "price", "original_price", "discount_percentage", "availability",
    "stock_level", "rating", "review_count", "sales_velocity", "is_trending",
]
STAGED_PRODUCT_COLUMNS = [
    "product_id", "product_name", "category", "subcategory", "brand", "audience", "color_options",
    "base_price", "base_rating", "image_url",
]


def schema(name: str) -> StructType:
    return StructType.fromDDL(_DDL[name])
