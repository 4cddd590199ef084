import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pricelake.session import build_session  # noqa: E402
from pricelake.sources.lake import Lake  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("local[4]", "pricelake-tests", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "4g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"))


@pytest.fixture
def sample_products(spark):
    """Three parts of a bicycle shop: one red brake with colours, one without, one pump."""
    return spark.createDataFrame([
        (7, "Kids Red Brake Lever", "Spares", "['Red', 'Matt Black']", "Nordwind", 18.4, 3.9, None),
        (8, "Steel Chain 9 Speed", "Spares", None, "Nordwind", 27.15, 4.2, "https://img.example/8"),
        (12, "Floor Pump", "Tools", "['Olive']", None, 34.0, 4.9, "https://img.example/12"),
    ], "product_id bigint, name string, category string, subcategory string, brand string, "
       "base_price double, base_rating double, image_url string")
