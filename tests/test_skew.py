"""Hot keys are split by AQE: the plans of the hot joins allow it."""

import pytest
from conftest import box, polygons

from arcrelief.operators import spatial, topology

CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture()
def tight(spark):
    old = {k: spark.conf.get(k, None) for k in CONF}
    for k, v in CONF.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def was_split(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


def test_a_third_of_the_points_in_one_cell(tight):
    points = tight.range(300000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 5 + id % 7 ELSE id % 100000 END AS x",
        "CASE WHEN id % 3 = 0 THEN 5 + id % 11 ELSE id % 90000 END AS y", "id")
    features = polygons(tight, [
        ("a", i, "k", [box(i * 100, 0, i * 100 + 100, 100)]) for i in range(300)])
    per_polygon = spatial.points_in_polygons(points, features).groupBy("gid").count()
    assert was_split(per_polygon)
    hot = 100000
    assert per_polygon.filter("gid = 0").first()["count"] >= hot


def test_a_third_of_the_vertices_in_one_position(tight):
    entities = tight.range(30000).selectExpr(
        "id AS entity_id",
        "array(array(named_struct('x', 0L, 'y', 0L), named_struct('x', 10L + id, 'y', 1L),"
        " named_struct('x', 10L + id, 'y', 2L + id))) AS rings")
    pieces = topology._pieces(entities).groupBy("n").count()
    assert was_split(pieces)
    assert [tuple(r) for r in pieces.collect()] == [(4, 30000)]
