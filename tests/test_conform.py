import pytest
from pyspark.sql import functions as F

from pricelake.functions import text
from pricelake.operators.conform import conform_products


def derive(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column(F.col("x")).alias("y")).first()[0]


@pytest.mark.parametrize("name, expected", [
    ("Mens Bogs Bozeman Boots, Tall", ("Footwear", "Boots")),
    ("Boot Pack Carrier", ("Footwear", "Boots")),
    ("Mystery Widget", ("General Merchandise", "General")),
    ("Laptop Sleeve", ("Apparel", "Tops")),
])
def test_category_first_rule_wins(spark, name, expected):
    got = tuple(derive(spark, name, lambda c, i=i: text.category_of(c)[i]) for i in (0, 1))
    assert got == expected


def test_whole_words_on_request(spark):
    assert derive(spark, "Laptop Sleeve", lambda c: text.category_of(c, word_boundary=True)[0]) == \
        "General Merchandise"
    assert derive(spark, "Wool top", lambda c: text.category_of(c, word_boundary=True)[1]) == "Tops"


@pytest.mark.parametrize("name, brand", [
    ("Womens Teva Hurricane XLT2 Sandals", "Teva"),
    ("Wicked Good Camp Moccasins", "House Brand"),
])
def test_brand(spark, name, brand):
    assert derive(spark, name, text.brand_of) == brand


@pytest.mark.parametrize("name, audience", [
    ("Womens Trail Shoes", "Womens"), ("Infant Booties", "Infants"), ("Infants Booties", "Infants"),
    ("Allagash Pack Basket", "Unisex"), ("womens shoes", "Unisex"),
])
def test_audience(spark, name, audience):
    assert derive(spark, name, text.audience_of) == audience


@pytest.mark.parametrize("raw, colours", [
    ("['Grey/White', 'Navy']", "Grey/White|Navy"), ("no colors here", None), (None, None),
    ("[' Sand ']", "Sand"),
])
def test_colours(spark, raw, colours):
    assert derive(spark, raw, text.color_options) == colours


def test_conform_keeps_lineage(spark, sample_products):
    rows = conform_products(sample_products, lexicon=["Pump", "Brake"]).orderBy("product_id").collect()
    assert [(r["source_category"], r["source_brand"]) for r in rows] == [
        ("Spares", "Nordwind"), ("Spares", "Nordwind"), ("Tools", None)]
    assert [r["brand"] for r in rows] == ["Brake", "House Brand", "Pump"]
    assert [r["audience"] for r in rows] == ["Kids", "Unisex", "Unisex"]
    assert [r["color_options"] for r in rows] == ["Red|Matt Black", None, "Olive"]


def test_conform_trims_all_white_space(spark, sample_products):
    padded = sample_products.withColumn("name", F.concat(F.lit("\t "), "name", F.lit(" \n")))
    assert conform_products(padded).filter(F.col("product_name").rlike(r"^\s|\s$")).isEmpty()
