"""Small topologies worked out by hand."""

from conftest import box, cloud, polygons
from pyspark.sql import functions as F

from arcrelief.operators import arcs as arc_ops
from arcrelief.operators import assemble, edit, heights, topology
from arcrelief.plans import pipeline
from arcrelief.sources import geojson, tables


def squares(spark):
    return polygons(spark, [
        ("a", 1, "water", [box(0, 0, 100, 100)]),
        ("a", 2, "land", [box(0, 100, 100, 200)]),
    ])


def test_features_from_envelopes_with_json_properties(spark):
    rows = spark.createDataFrame(
        [('{"gid": 1, "type": "water"}', 0, 0, 100, 100), ('{"gid": 2, "type": "land"}', 0, 100, 100, 200)],
        "properties STRING, xmin LONG, ymin LONG, xmax LONG, ymax LONG")
    t = topology.build_topology(tables.envelope_features(rows))
    assert t.arcs.count() == 3
    pairs = {tuple(r) for r in topology.neighbours(t.ring_arcs, t.entities).collect()}
    assert pairs == {(1, 2), (2, 1)}
    assert {(r.gid, r.type, r.source) for r in t.entities.collect()} == {(1, "water", "inline"), (2, "land", "inline")}


def uses(t):
    return {(r.entity_id, r.arc_id): r.reversed for r in t.ring_arcs.collect()}


def test_two_squares_share_one_arc(spark):
    t = topology.build_topology(squares(spark))
    arcs = {r.arc_id: [tuple(p) for p in r.points] for r in t.arcs.collect()}
    assert len(arcs) == 3
    shared = [i for i, p in arcs.items() if set(p) == {(0, 100), (100, 100)}]
    assert len(shared) == 1
    directions = {e: rev for (e, a), rev in uses(t).items() if a == shared[0]}
    assert sorted(directions) == [1, 2] and directions[1] != directions[2]
    pairs = {tuple(r) for r in topology.neighbours(t.ring_arcs, t.entities).collect()}
    assert pairs == {(1, 2), (2, 1)}
    assert t.transform is None


def test_rebuilt_rings_and_dissolve(spark):
    t = topology.build_topology(squares(spark))
    found = {r.gid: {tuple(p) for p in r.rings[0]}
             for r in assemble.polygons(t.ring_arcs, t.arcs).collect()}
    assert found == {1: set(box(0, 0, 100, 100)), 2: set(box(0, 100, 100, 200))}
    merged = t.ring_arcs.withColumn("type", F.lit("x"))
    boundary = edit.dissolve_boundary(merged, "type")
    size = edit.boundary_size(boundary, t.arcs, ["type"]).first()
    assert (size.n_arcs, size.double_area, size.length) == (2, 40000, 600.0)
    ring = edit.dissolve(merged, t.arcs, "type").collect()
    assert len({r.ring for r in ring}) == 1 and sorted(r.pos for r in ring) == [0, 1]


def test_dissolve_groups_null_keys(spark):
    t = topology.build_topology(squares(spark))
    keyless = t.ring_arcs.withColumn("type", F.lit(None).cast("string"))
    rings = edit.dissolve(keyless, t.arcs, "type").collect()
    assert len(rings) == 2 and {r.type for r in rings} == {None}


def test_dissolve_keeps_pieces_that_touch_in_a_point_apart(spark):
    t = topology.build_topology(polygons(spark, [
        ("a", 1, "k", [box(0, 0, 10, 10)]), ("a", 2, "k", [box(10, 10, 20, 20)]),
        ("a", 3, "o", [box(10, 0, 20, 10)]), ("a", 4, "o", [box(0, 10, 10, 20)]),
    ]))
    found = edit.dissolve(t.ring_arcs, t.arcs, "type")
    areas = edit.boundary_size(found, t.arcs, ["type", "ring"]).collect()
    assert sorted((r.type, r.double_area) for r in areas) == [("k", 200)] * 2 + [("o", 200)] * 2


def test_raise_leaves_the_neighbour_alone(spark):
    t = topology.build_topology(squares(spark))
    points = cloud(spark, [(1, 50, 150, 4, 6), (1, 60, 150, 6, 6), (1, 50, 50, 9, 6)])
    raised, ring_arcs = heights.raise_entities(t, points, "type = 'land'", 1)
    copies = {r.arc_id: r for r in raised.collect()}
    assert sorted(copies) == [3, 4]
    assert {p.z for r in copies.values() for p in r.points} == {5.0}
    before = {(r.entity_id, r.pos): (r.arc_id, r.reversed) for r in t.ring_arcs.collect()}
    after = {(r.entity_id, r.pos): (r.arc_id, r.reversed) for r in ring_arcs.collect()}
    assert {k: v for k, v in before.items() if k[0] == 1} == {
        k: v for k, v in after.items() if k[0] == 1
    }
    assert sorted(a for (e, _), (a, _) in after.items() if e == 2) == [3, 4]
    assert [v[1] for k, v in sorted(before.items())] == [v[1] for k, v in sorted(after.items())]


def test_hole_and_filling_share_a_closed_arc(spark):
    hole = box(30, 30, 70, 70)
    t = topology.build_topology(polygons(spark, [
        ("a", 1, "land", [box(0, 0, 100, 100), hole[::-1]]),
        ("b", 1, "pand", [hole[2:] + hole[:2]]),
    ]))
    assert t.arcs.count() == 2
    assert len({a for (e, a) in uses(t) if e == 2} & {a for (e, a) in uses(t) if e == 1}) == 1
    assert {r.interior_left for r in t.ring_arcs.collect()} == {True}


def test_repeated_vertices_and_small_rings(spark):
    t = topology.build_topology(polygons(spark, [
        ("a", 1, "k", [[(0, 0), (0, 0), (9, 0), (9, 9), (0, 0)], [(1, 1), (1, 1), (2, 2)]]),
        ("a", 2, "k", [[(5, 5), (5, 5), (5, 5)]]),
    ]))
    kept = t.entities.collect()
    assert [(r.gid, len(r.rings), len(r.rings[0]), r.n_dropped) for r in kept] == [(1, 1, 3, 1)]


def test_quantised_round_trip(spark):
    t = topology.build_topology(squares(spark), q=1e9)
    assert t.transform is not None
    real = heights.arc_vertices(t.arcs).selectExpr(
        "arc_id", "pos", f"round({t.transform.decode('x', 'x')}, 3) AS x",
        f"round({t.transform.decode('y', 'y')}, 3) AS y",
    )
    assert {r.x for r in real.collect()} == {0.0, 100.0}
    one = topology.Transform()
    deltas = arc_ops.delta_encode(t.arcs, one)
    same = arc_ops.delta_decode(deltas, one).join(heights.arc_vertices(t.arcs), ["arc_id", "pos", "x", "y"])
    assert same.count() == heights.arc_vertices(t.arcs).count()


def test_same_topology_for_any_number_of_partitions(spark, sf_dir):
    from arcrelief.sources import derived

    def run(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        t = topology.build_topology(derived.features(spark, sf_dir).repartition(n))
        return sorted(map(tuple, t.ring_arcs.collect()))

    try:
        assert run(1) == run(32)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)


def test_geojson_multi_polygons_and_other_kinds(spark):
    docs = spark.createDataFrame([
        ('{"type":"Feature","properties":{"gid":1},"geometry":{"type":"MultiPolygon","coordinates":'
         '[[[[0,0],[1,0],[1,1],[0,0]]],[[[5,5],[6,5],[6,6],[5,5]]]]}}',),
        ('{"type":"Feature","properties":{"gid":2},"geometry":{"type":"Point","coordinates":[1,2]}}',),
    ], "doc STRING")
    got = geojson.from_features(docs, "doc", "gid BIGINT").collect()
    assert [(r.gid, r.part, len(r.rings[0])) for r in got] == [(1, 0, 3), (1, 1, 3)]


def test_pipeline_end_to_end(spark):
    hole = box(30, 30, 70, 70)
    features = polygons(spark, [
        ("a", 1, "land", [box(0, 0, 100, 100), hole[::-1]]), ("b", 1, "pand", [hole]),
    ])
    points = cloud(spark, [(1, 1, 1, 3, 2), (1, 99, 99, 3, 2), (1, 50, 50, 8, 6)])
    step = pipeline.build_step(features, points, erosion=5, bounds=(10, 10, 20, 20))
    arcs = pipeline.height_step(step, points)
    solids = pipeline.polygons_step(step, arcs).collect()
    # the box touches the land only; the building lies in its hole
    assert [(r.gid, r.type) for r in solids] == [(1, "land")]
    step = pipeline.build_step(features, points, erosion=5)
    solids = {r.type: r for r in pipeline.polygons_step(step, pipeline.height_step(step, points)).collect()}
    assert {p.z for p in solids["pand"].rings[0]} == {8.0}
    assert {p.z for ring in solids["land"].rings for p in ring} == {3.0}


def test_topology_table_is_pruned_by_kind(spark, tmp_path):
    from arcrelief.sources import tables

    t = topology.build_topology(squares(spark), q=1e9)
    path = str(tmp_path / "topology")
    tables.replace_table(arc_ops.topology_rows(t), path, partition_by="kind")
    read = tables.read_topology_kind(spark, path, "arc")
    assert read.count() == 3
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(kind" in plan
    assert tables.read_topology_kind(spark, path, "transform").count() == 1


def test_source_scans(spark, tmp_path, sf_dir):
    from arcrelief.sources import derived, tables

    path = str(tmp_path / "points")
    derived.points(spark, sf_dir).write.parquet(path)
    ground = tables.read_points(spark, path, 2)
    plan = ground._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(classification,2)" in plan
    path = str(tmp_path / "polygons")
    squares(spark).write.parquet(path)
    scanned = tables.read_polygons(spark, path, "b", type_=F.lit("pand"))
    assert {(r.source, r.type) for r in scanned.collect()} == {("b", "pand")}


def solids_of(spark, q, features, points):
    step = pipeline.build_step(features, points, erosion=5, q=q)
    found = pipeline.polygons_step(step, pipeline.height_step(step, points)).collect()
    return {r.gid: sorted((round(p.x, 3), round(p.y, 3), p.z) for ring in r.rings for p in ring)
            for r in found}


def test_quantised_pipeline_gives_real_coordinates_and_heights(spark):
    hole = box(30, 30, 70, 70)
    land = polygons(spark, [
        ("a", 1, "land", [box(0, 0, 100, 100), hole[::-1]]), ("b", 2, "pand", [hole]),
    ])
    points = cloud(spark, [(1, 1, 1, 3, 2), (1, 99, 99, 3, 2), (1, 50, 50, 8, 6)])
    plain, fine = (solids_of(spark, q, land, points) for q in (0, 1e9))
    assert plain == fine and {z for _, _, z in fine[2]} == {8.0}
    points = cloud(spark, [(1, 1, 50, 2, 2), (1, 99, 99, 2, 2), (2, 50, 150, 5, 2), (2, 50, 199, 5, 2)])
    assert solids_of(spark, 0, squares(spark), points) == solids_of(spark, 1e9, squares(spark), points)


def test_quantised_empty_selection(spark):
    points = cloud(spark, [(1, 1, 1, 3, 2)])
    step = pipeline.build_step(squares(spark), points, erosion=5, bounds=(900, 900, 901, 901), q=1e9)
    assert pipeline.polygons_step(step, pipeline.height_step(step, points)).count() == 0


def test_second_update_keeps_earlier_heights(spark):
    arcs = topology.build_topology(squares(spark)).arcs
    at = lambda arc, z: heights.arc_vertices(arcs).where(f"arc_id = {arc}").selectExpr(
        "arc_id", "pos", "x", "y", f"double({z}) AS z")
    twice = heights.update_arcs(heights.update_arcs(arcs, at(0, 3)), at(1, 4))
    found = {r.arc_id: {p.z for p in r.points} for r in twice.collect()}
    assert found == {0: {3.0}, 1: {4.0}, 2: {None}}
    deltas = arc_ops.delta_encode(twice, topology.Transform())
    back = arc_ops.delta_decode(deltas, topology.Transform())
    assert {(r.arc_id, r.z) for r in back.collect()} == {(0, 3.0), (1, 4.0), (2, None)}


def test_dissolve_loses_no_arc_of_overlapping_polygons(spark):
    t = topology.build_topology(polygons(spark, [
        ("a", 1, "k", [box(0, 0, 100, 100)]),
        ("a", 2, "k", [[(0, 0), (100, 0), (100, 50), (0, 50)]]),
    ]))
    boundary = edit.dissolve_boundary(t.ring_arcs, "type")
    assert edit.dissolve(t.ring_arcs, t.arcs, "type").count() == boundary.count() > 0


def test_multi_part_building_has_one_height(spark):
    parts = polygons(spark, [("b", 1, "pand", [box(0, 0, 10, 10)]), ("b", 1, "pand", [box(20, 0, 30, 10)])])
    points = cloud(spark, [(1, 5, 5, 4, 6), (1, 25, 5, 8, 6)])
    rows = heights.roof_height(points, parts, 1).collect()
    assert [(r.gid, r.z, r.n_points) for r in rows] == [(1, 6.0, 2)]


def test_free_ring_of_many_vertices(spark):
    n = 3000
    ring = [(i, i * i) for i in range(n)]
    t = topology.build_topology(polygons(spark, [("a", 1, "k", [ring[7:] + ring[:7]])]))
    points = t.arcs.first().points
    assert len(points) == n + 1 and tuple(points[0]) == (0, 0) == tuple(points[-1])
