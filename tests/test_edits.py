"""Guarded simplification, factored neighbours, rejected documents and walls on real coordinates."""

import json

from conftest import box, polygons
from pyspark.sql import functions as F

from arcrelief.operators import assemble, edit, topology, walls
from arcrelief.sources import geojson


def rings_of(t):
    return {r.gid: [len(ring) for ring in r.rings] for r in assemble.polygons(t.ring_arcs, t.arcs).collect()}


def test_no_ring_collapses(spark):
    hole = list(reversed(box(40, 40, 60, 60)))
    t = topology.build_topology(polygons(spark, [
        ("a", 1, "k", [box(0, 0, 100, 100), hole]), ("b", 2, "pand", [box(40, 40, 60, 60)]),
        ("a", 3, "k", [[(100, 0), (150, 20), (200, 0), (200, 100), (100, 100)]]),
        ("a", 4, "k", [box(300, 0, 310, 10)])]))
    for area in (0.0, 300.0, 1e9):
        simple = edit.simplify_topology(t, area)
        found = rings_of(simple)
        assert all(n >= 3 for rings in found.values() for n in rings)
        if area == 1e9:
            assert found == {1: [3, 3], 2: [3], 3: [3], 4: [3]}
    assert rings_of(edit.simplify_topology(t, 0.0)) == rings_of(t)


def test_weights_keep_heights(spark):
    arcs = spark.createDataFrame(
        [(1, [(0.0, 0.0, 1.0), (5.0, 1.0, 2.0), (10.0, 0.0, 3.0)]), (2, [(0.0, 0.0, 4.0), (1.0, 1.0, None)])],
        "arc_id LONG, points ARRAY<STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>>")
    weights = {r.arc_id: r.weights for r in edit.weigh_arcs(arcs).collect()}
    assert weights[1][1] == 5.0 and weights[2] == [float("inf")] * 2
    kept = {r.arc_id: [tuple(p) for p in r.points] for r in edit.simplify_arcs(arcs, 6).collect()}
    assert kept == {1: [(0.0, 0.0, 1.0), (10.0, 0.0, 3.0)], 2: [(0.0, 0.0, 4.0), (1.0, 1.0, None)]}


def test_equal_polygons_are_one_class(spark):
    rows = [("a", i, "k", [box(0, 0, 10, 10)]) for i in range(400)]
    rows += [("b", i, "k", [box(10 + 10 * i, 0, 20 + 10 * i, 10)]) for i in range(2)]
    t = topology.build_topology(polygons(spark, rows))
    members, links = topology.neighbour_classes(t.ring_arcs)
    assert members.select("class_id").distinct().count() == 3
    assert links.count() == 5 and links.agg(F.sum("size")).first()[0] == 399 + 1 + 400 + 1 + 1
    counts = {r.entity_id: r.n_neighbours for r in topology.neighbour_counts(t.ring_arcs, t.entities).collect()}
    pairs = topology.neighbours(t.ring_arcs, t.entities).groupBy("entity_id").agg(F.count("neighbour_id").alias("n"))
    assert counts == {r.entity_id: r.n for r in pairs.collect()}


def test_rejected_documents(spark):
    ring = [[0, 0], [1, 0], [1, 1], [0, 0]]

    def feature(kind, coordinates, what="Feature"):
        return json.dumps({"type": what, "properties": {"gid": 1}, "geometry": {"type": kind, "coordinates": coordinates}})

    docs = {
        feature("Polygon", [ring]): None, feature("MultiPolygon", [[ring], [ring]]): None,
        feature("Polygon", [ring], "Topology"): "not a Feature but a Topology",
        feature("Point", [0, 0]): "not a polygon but a Point",
        feature("Polygon", [[[0, 0], ["x", 0], [1, 1], [0, 0]]]): "coordinates are not rings of numbers",
        feature("Polygon", []): "coordinates are not rings of numbers",
        feature("Polygon", [[[0], [1, 0], [1, 1], [0, 0]]]): "coordinates are not rings of numbers",
        feature("Polygon", [ring[:3]]): "a ring is not closed or has fewer than three points",
        feature("MultiPolygon", [[ring], [[[0, 0], [1, 0], [1, 1], [2, 2]]]]):
            "a ring is not closed or has fewer than three points",
        '{"type": "Feature", "properties": {"gid": 1}}': "no geometry", "nonsense": "not a JSON object with a type",
        "": "not a JSON object with a type", "[]": "not a JSON object with a type"}
    df = spark.createDataFrame([(d,) for d in [*docs, None]], "doc STRING")
    found = {r.document: r.reason for r in geojson.rejected_features(df, "doc", "gid BIGINT").collect()}
    assert found == {d: r for d, r in docs.items() if r} | {None: "not a JSON object with a type"}
    assert geojson.from_features(df, "doc", "gid BIGINT").count() == 3


def test_dropped_rings(spark):
    features = polygons(spark, [
        ("a", 1, "k", [box(0, 0, 1000, 1000), box(5, 5, 6, 6)]), ("a", 2, "k", [box(500, 500, 501, 501)])])
    found = {(r.gid, r.ring, r.n_vertices) for r in topology.dropped_rings(features, 11).collect()}
    assert found == {(1, 1, 4), (2, 0, 4)}
    assert topology.dropped_rings(features).count() == 0


def walls_found(spark, terrain, building, tolerance):
    def table(name, ring):
        points = [[{"x": float(x), "y": float(y)} for x, y in ring]]
        return spark.createDataFrame([(1, points)], f"{name} LONG, rings ARRAY<ARRAY<STRUCT<x: DOUBLE, y: DOUBLE>>>")

    found = walls.shared_walls(table("parcel", terrain), table("building", building), ["parcel"], ["building"], tolerance)
    return sorted((round(r.x1, 3), round(r.y1, 3), round(r.x2, 3), round(r.y2, 3)) for r in found.collect())


def test_walls_with_junctions_on_metres(spark):
    x, y = 93705.123, 463738.456
    terrain = [(x, y), (x + 30.1, y + 0.7), (x + 29, y - 20)]
    on = lambda t: (x + t * 30.1, y + t * 0.7)
    building = [on(0.2), (x + 10, y + 8), on(0.7), on(0.4)]  # a wall in two pieces, with a junction between
    assert len(walls_found(spark, terrain, building, 0.001)) == 2
    off = [(px + 0.0005, py - 0.0005) for px, py in building]
    assert len(walls_found(spark, terrain, off, 0.002)) == 2
    assert walls_found(spark, terrain, [(px, py + 0.5) for px, py in building], 0.002) == []
    across = [(x + 5, y - 5), (x + 5, y + 5), (x + 9, y + 5)]
    assert walls_found(spark, terrain, across, 0.002) == []
