"""Stored topologies: golden JSON, round trips, checks, and updates of single buckets."""

import os
import tempfile

from conftest import box, cloud, polygons
from pyspark.sql import functions as F

from arcrelief.operators import arcs as arc_ops
from arcrelief.operators import assemble, edit, heights, topology
from arcrelief.plans import pipeline
from arcrelief.sources import store

GOLDEN = [  # two squares with a common arc, heights on all points
    ("arc", 0, "[[0,100,0],[100,100,0]]"),
    ("arc", 1, "[[100,100,0],[100,0,0],[0,0,0],[0,100,0]]"),
    ("arc", 2, "[[0,100,0],[0,200,0],[100,200,0],[100,100,0]]"),
    ("entity", 1, '{"type":"Polygon","arcs":[[0,1]],"properties":{"gid":1,"type":"water"}}'),
    ("entity", 2, '{"type":"Polygon","arcs":[[2,-1]],"properties":{"gid":2,"type":"land"}}'),
    ("neighbours", 1, "[2]"), ("neighbours", 2, "[1]"),
]


def folder():
    return "file://" + tempfile.mkdtemp(prefix="arcrelief-store-") + "/t"


def stored(spark, rows, per_bucket=2):
    path = folder()
    store.write_topology(spark.createDataFrame(rows, "kind STRING, id LONG, data STRING"), path, per_bucket)
    return path


def line(ring):
    return [(p.x, p.y) for p in ring]


def test_golden_topology_from_json(spark):
    path = stored(spark, GOLDEN)
    assert store.problems(spark, path).count() == 0
    t = store.load_topology(spark, path, whole=True)
    solids = {r.gid: r.rings for r in assemble.polygons(t.ring_arcs, t.arcs).collect()}
    assert line(solids[2][0]) == [(0, 100), (0, 200), (100, 200), (100, 100)]
    merged = t.ring_arcs.withColumn("type", F.lit("x"))
    size = edit.boundary_size(edit.dissolve_boundary(merged, "type"), t.arcs, ["type"]).first()
    assert (size.n_arcs, size.double_area) == (2, 40000)
    points = cloud(spark, [(1, 50, 150, 5, 6)])
    raised, uses = heights.raise_entities(t, points, "type = 'land'", 1)
    assert {r.arc_id: r.z for r in raised.collect()} == {3: 5.0, 4: 5.0}
    refs = {(r.gid, r.pos): (r.arc_id, r.reversed) for r in uses.collect()}
    assert refs == {(1, 0): (0, False), (1, 1): (1, False), (2, 0): (3, False), (2, 1): (4, True)}


def test_multi_polygons_and_deltas(spark):
    path = stored(spark, [
        ("transform", 1, '{"scale":[0.5,2],"translate":[10,20]}'),
        ("arc", 0, "[[0,0],[4,0],[0,4],[-4,-4]]"), ("arc", 1, "[[10,10],[0,4],[4,0],[-4,-4]]"),
        ("entity", 7, '{"type":"MultiPolygon","arcs":[[[0]],[[-2]]],"properties":{"gid":3,"type":"a"}}'),
    ])
    assert store.problems(spark, path).count() == 0
    t = store.load_topology(spark, path)
    arcs = {r.arc_id: line(r.points) for r in t.arcs.collect()}
    assert arcs == {0: [(0, 0), (4, 0), (4, 4), (0, 0)], 1: [(10, 10), (10, 14), (14, 14), (10, 10)]}
    parts = {r.part: (r.gid, line(r.rings[0])) for r in
             assemble.polygons(t.ring_arcs, topology.real_arcs(t)).collect()}
    assert parts == {0: (3, [(10, 20), (12, 20), (12, 28)]), 1: (3, [(15, 40), (17, 48), (15, 48)])}
    sides = {(r.arc_id, r.reversed): r.interior_left for r in t.ring_arcs.collect()}
    assert sides == {(0, False): True, (1, True): True}


def test_findings(spark):
    path = stored(spark, [*GOLDEN[1:3], ("arc", 5, "nonsense"), ("arc", 6, "[[1,2]]"), ("arc", 2, "[[0,0],[1,1]]"),
                          ("entity", 1, GOLDEN[3][2]), ("entity", 2, '{"type":"Polygon","arcs":[[1,2]]}'),
                          ("entity", 3, '{"type":"LineString","arcs":[1]}'), ("entity", 4, None)])
    found = {(r.kind, r.id, r.reason) for r in store.problems(spark, path).collect()}
    assert {("arc", 2, "id occurs more than once"), ("arc", 5, "not an array of two points or more"),
            ("arc", 6, "not an array of two points or more"), ("entity", 1, "no arc 0"),
            ("entity", 3, "not a polygon"), ("entity", 4, "not a polygon")} <= found
    assert ("entity", 1, "ring 0 is broken") in found


def test_round_trip_with_heights_and_quantisation(spark):
    land = polygons(spark, [
        ("a", 1, "k", [box(0, 0, 100, 100), list(reversed(box(20, 20, 40, 40)))]),
        ("a", 2, "pand", [box(20, 20, 40, 40)]), ("b", 2, "m", [box(100, 0, 200, 100)])])
    points = cloud(spark, [(1, 5, 5, 2, 2), (1, 95, 95, 3, 2), (1, 30, 30, 9, 6)])
    for q in (0, 201):
        step = pipeline.build_step(land, points, erosion=2, q=q)
        arcs = pipeline.height_step(step, points)
        path = folder()
        pipeline.store_step(step, arcs, path, per_bucket=3)
        assert store.problems(spark, path).count() == 0
        t = store.load_topology(spark, path)

        def solids(uses, lines):
            return {(r.source, r.gid, r.part): [[(p.x, p.y, p.z) for p in ring] for ring in r.rings]
                    for r in assemble.polygons(uses, lines).collect()}

        assert solids(t.ring_arcs, topology.real_arcs(t)) == solids(step.ring_arcs, arcs)
        sides = lambda uses: {(r.entity_id, r.ring, r.pos): r.interior_left for r in uses.collect()}
        assert sides(t.ring_arcs) == sides(step.ring_arcs)


def test_update_rewrites_touched_buckets_only(spark):
    t = topology.build_topology(polygons(
        spark, [("a", i, "k", [box(10 * i, 0, 10 * i + 10, 10)]) for i in range(12)]))
    path = folder()
    store.write_topology(arc_ops.topology_rows(t, pipeline.STORED), path, per_bucket=4)

    def files():
        return {os.path.join(d, f) for d, _, names in os.walk(path.removeprefix("file://")) for f in names
                if f.startswith("part-")}

    before = files()
    at = lambda arc, z: heights.arc_vertices(t.arcs).where(f"arc_id = {arc}").selectExpr(
        "arc_id", "pos", "x", "y", f"double({z}) AS z")
    assert store.update_arcs(spark, path, at(1, 3), 4) == [0]
    assert store.update_arcs(spark, path, at(9, 4).unionByName(at(2, 5)), 4) == [0, 2]
    assert store.update_arcs(spark, path, at(999, 4), 4) == []
    after = files()
    gone = {f.split("bucket=")[1].split("/")[0] for f in before - after if "kind=arc" in f}
    assert gone == {"0", "2"} and all("kind=arc" in f for f in before - after)
    found = {r.arc_id: {p.z for p in r.points} for r in store.read_arcs(spark, path, None).collect()}
    assert {a: z for a, z in found.items() if z != {None}} == {1: {3.0}, 2: {5.0}, 9: {4.0}}
    assert len(found) == t.arcs.count()
    assert store.problems(spark, path).count() == 0


def test_scan_of_one_kind_prunes_partitions(spark):
    path = stored(spark, GOLDEN)
    plan = store.read_rows(spark, path, "entity")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
