"""Faults of the fourth review: each test fails on the code it was written against."""

from types import SimpleNamespace

from pyspark.sql import functions as F

from pricelake.ml import neighbours
from pricelake.plans import serving
from pricelake.session import cut


def plan_of(frame) -> str:
    return frame._jdf.queryExecution().executedPlan().toString()


def broadcast_rows(frame) -> list[int]:
    """The number of rows of every broadcast that was run for a collected frame."""
    def below(node):
        yield node
        if "AdaptiveSparkPlan" in node.nodeName():
            yield from below(node.executedPlan())
        elif "QueryStage" in node.nodeName():
            yield from below(node.plan())
        children = node.children()
        for i in range(children.size()):
            yield from below(children.apply(i))

    plan = frame._jdf.queryExecution().executedPlan()
    return [x.metrics().apply("numOutputRows").value() for x in below(plan) if x.nodeName() == "BroadcastExchange"]


def test_a_page_takes_its_own_segments_only(spark):
    """Segments of one value are a small file however many there are; a page must not gather all of them."""
    ids = spark.range(1, 20_001).withColumnRenamed("id", "product_id")
    performance = cut(ids.filter("product_id < 3000").withColumn("avg_price", F.col("product_id") / 10), "performance")
    segments = cut(ids.filter("product_id <> 2").withColumn("segment_name", F.lit("Value")), "segments")
    both = segments.unionByName(segments.filter("product_id = 3"))
    page = serving.list_after(performance, both, None, 5)
    assert [(r["product_id"], r["segment_name"]) for r in page.collect()] == [
        (1, "Value"), (2, None), (3, "Value"), (3, "Value"), (4, "Value"), (5, "Value")]
    found = broadcast_rows(page)
    assert found and max(found) <= 6
    for frame in (serving.list_products(performance, segments, page=2, page_size=5), serving.product(performance, segments, 7)):
        frame.collect()
        assert max(broadcast_rows(frame)) <= 5


def test_profiles_and_products_are_not_broadcast(spark):
    """Both have a row for every product; files of few distinct values say little about it."""
    from pricelake.registered import model_queries

    ids = spark.range(1, 2001)
    observations = cut(ids.selectExpr(
        "id as product_id", "cast(id as double) as price", "1d as discount_percentage", "2d as rating", "3d as sales_velocity"), "observed")
    products = cut(ids.selectExpr("id as product_id", "'Hardware' as category", "if(id % 2 = 0, 950d, 900d) as base_price"), "products")
    banded = model_queries.banded(SimpleNamespace(observations=observations, products=products))
    assert "BroadcastHashJoin" not in plan_of(banded)
    assert {(r["product_id"] % 2, r["segment_name"]) for r in banded.collect()} == {(0, "Premium"), (1, "Value")}
    assert banded.count() == 2000 and broadcast_rows(banded) == []


def test_neighbours_do_not_broadcast_products(spark, monkeypatch):
    """Few distinct vectors with many products each: as files both tables are small."""
    gathered = []
    monkeypatch.setattr(neighbours, "LEAF", 16)
    monkeypatch.setattr(neighbours, "cut", lambda frame, name: (gathered.append((name, plan_of(frame))), cut(frame, name))[1])
    axes = [f"cast(hash({i}, id % 100) % 1000 as double) as {c}" for i, c in enumerate(neighbours.AXES)]
    products = cut(spark.range(3000).selectExpr("id as product_id", "'c' as category", "'s' as segment_name", *axes), "segments")
    found = neighbours.recommend(products, 3)
    assert found.count() == 9000 and "BroadcastHashJoin [vector" not in plan_of(found)
    asked = dict(gathered)["other_cells"]
    assert "SortMergeJoin [vector" in asked and "BroadcastHashJoin" not in asked
    copies = {r["product_id"]: r["recommended_product_id"] for r in found.filter("rank = 1").collect()}
    assert len(copies) == 3000 and all((a - b) % 100 == 0 for a, b in copies.items())


def test_pivots_are_drawn_without_a_broadcast_of_vectors(spark, monkeypatch):
    plans = []
    vectors = neighbours._vectors(spark.range(600).selectExpr(
        "id as product_id", "'c' as category", "'s' as segment_name", *[f"cast(hash({i}, id) % 1000 as double) as {c}" for i, c in enumerate(neighbours.AXES)]))
    placed = cut(vectors.withColumns(neighbours._root()), "placed")
    to_pandas = type(placed).toPandas
    monkeypatch.setattr(type(placed), "toPandas", lambda frame: (plans.append(frame), to_pandas(frame))[1])
    pivots = neighbours._pivots(placed, {0: 600}, 1)
    assert len(pivots) == 24 and pivots["cell"].tolist() == list(range(1, 25))
    found = plans[0]
    found.collect()
    assert max(broadcast_rows(found)) == 1
