"""Spatial joins against brute force, with thresholds lowered so that every path runs."""

import math
import random

import pytest
from conftest import box, cloud, polygons

from arcrelief.functions import fragments, ids
from arcrelief.operators import edit, heights, mesh, nearest, spatial, topology, walls


def star(rng, n, cx, cy, r):
    angles = sorted(rng.random() * 2 * math.pi for _ in range(n))
    ring = [(cx + int(math.cos(a) * r * (0.3 + 0.7 * rng.random())),
             cy + int(math.sin(a) * r * (0.3 + 0.7 * rng.random()))) for a in angles]
    return [p for i, p in enumerate(ring) if p != ring[i - 1]]


def edges_of(rings):
    return [(r[i - 1], r[i]) for r in rings for i in range(len(r))]


def d2(p, a, b):
    vx, vy = b[0] - a[0], b[1] - a[1]
    t = ((p[0] - a[0]) * vx + (p[1] - a[1]) * vy) / (vx * vx + vy * vy)
    t = max(0.0, min(1.0, t))
    return (p[0] - a[0] - t * vx) ** 2 + (p[1] - a[1] - t * vy) ** 2


def inside(p, rings):
    odd = False
    for a, b in edges_of(rings):
        if (a[1] <= p[1]) != (b[1] <= p[1]):
            cross = (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
            odd ^= (cross > 0) == (b[1] > a[1])
    return odd


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(5)
    out = [(g, [star(rng, n, rng.randint(0, 900), rng.randint(0, 900), r)])
           for g, (n, r) in enumerate([(5, 40), (9, 200), (40, 300), (300, 500), (7, 3)])]
    out.append((9, [box(0, 0, 512, 512), box(128, 128, 384, 384)[::-1]]))
    return out


@pytest.fixture(scope="module")
def points():
    rng = random.Random(6)
    grid = [(x, y) for x in range(0, 513, 64) for y in range(0, 513, 64)]
    return [(rng.randint(-50, 1400), rng.randint(-50, 1400)) for _ in range(600)] + grid + grid[:5]


@pytest.mark.parametrize("small,run", [(64, 4096), (3, 4096), (3, 2)])
@pytest.mark.parametrize("erosion", [0, 15])
def test_points_in_polygons(spark, shapes, points, monkeypatch, small, run, erosion):
    monkeypatch.setattr(fragments, "SMALL", small)
    monkeypatch.setattr(fragments, "RUN", run)
    monkeypatch.setattr(fragments, "PER_CELL", 4)
    features = polygons(spark, [("s", gid, "k", rings) for gid, rings in shapes])
    pts = spark.createDataFrame(points, "x BIGINT, y BIGINT")
    got = sorted((r.gid, r.x, r.y) for r in
                 spatial.points_in_polygons(pts, features, erosion=erosion).collect())
    want = []
    for gid, rings in shapes:
        for p in points:
            near = min(d2(p, a, b) for a, b in edges_of(rings))
            ok = inside(p, rings) and near >= erosion ** 2 if erosion else inside(p, rings) or near < 1e-9
            if ok:
                want.append((gid, *p))
    assert got == sorted(want)


@pytest.mark.parametrize("small,run", [(64, 4096), (3, 2)])
def test_polygons_meeting_boxes(spark, shapes, monkeypatch, small, run):
    monkeypatch.setattr(fragments, "SMALL", small)
    monkeypatch.setattr(fragments, "RUN", run)
    monkeypatch.setattr(fragments, "PER_CELL", 4)
    rng = random.Random(7)
    boxes = []
    for i in range(80):
        x, y, w = rng.randint(-100, 1200), rng.randint(-100, 1200), rng.choice([0, 5, 60, 700])
        boxes.append((i, x, y, x + w, y + rng.randint(0, w)))
    boxes.append((99, 130, 130, 380, 380))  # inside the hole
    boxes.append((98, 512, 0, 600, 10))  # touches an edge
    features = polygons(spark, [("s", gid, "k", rings) for gid, rings in shapes])
    df = spark.createDataFrame(boxes, "bid BIGINT, xmin BIGINT, ymin BIGINT, xmax BIGINT, ymax BIGINT")
    got = {(r.gid, r.bid) for r in spatial.polygons_meeting_boxes(features, df, "bid").collect()}
    want = set()
    for gid, rings in shapes:
        for bid, x0, y0, x1, y1 in boxes:
            def meets(a, b):
                if max(min(a[0], b[0]), x0) > min(max(a[0], b[0]), x1): return False
                if max(min(a[1], b[1]), y0) > min(max(a[1], b[1]), y1): return False
                side = [(b[0]-a[0])*(y-a[1]) - (b[1]-a[1])*(x-a[0]) for x in (x0, x1) for y in (y0, y1)]
                return min(side) <= 0 <= max(side)
            if any(meets(a, b) for a, b in edges_of(rings)) or inside((x0, y0), rings):
                want.add((gid, bid))
    assert got == want
    clipped = {r.gid for r in spatial.in_box(features, (130, 130, 380, 380)).collect()}
    assert clipped == {g for g, b in want if b == 99}


def test_polygon_pairs(spark):
    a = polygons(spark, [("a", 1, "k", [box(0, 0, 100, 100), box(20, 20, 80, 80)[::-1]]),
                         ("a", 2, "k", [box(30, 30, 35, 35)]), ("a", 3, "k", [box(200, 0, 300, 100)])])
    b = polygons(spark, [("b", 1, "k", [box(5, 5, 10, 10)]), ("b", 2, "k", [box(30, 30, 40, 40)]),
                         ("b", 3, "k", [box(100, 100, 120, 120)]), ("b", 4, "k", [box(-50, -50, 500, 500)])])
    got = spatial.polygon_pairs(a.selectExpr("gid AS i", "rings"), b.selectExpr("gid AS j", "rings"),
                                ["i"], ["j"])
    assert {(r.i, r.j) for r in got.collect()} == {
        (1, 1), (1, 3), (1, 4), (2, 2), (2, 4), (3, 4)}


@pytest.mark.parametrize("cell", [5.0, 60.0, 5000.0])
def test_nearest_is_exact_at_any_distance(spark, cell):
    rng = random.Random(8)
    targets = [(i, rng.randint(0, 400), rng.randint(0, 400)) for i in range(150)]
    targets += [(500 + i, 20000, 20000) for i in range(3)]
    queries = list({(rng.randint(-5000, 21000), rng.randint(-300, 900)) for _ in range(120)} | {
        (t[1], t[2]) for t in targets[:10]})
    q = spark.createDataFrame(queries, "x BIGINT, y BIGINT")
    t = spark.createDataFrame(targets, "tid BIGINT, xmin BIGINT, ymin BIGINT").selectExpr(
        "*", "xmin AS xmax", "ymin AS ymax")
    got = {(r.x, r.y): (r.best.d2, r.best.tid) for r in nearest.nearest(q, t, cell, ("tid",)).collect()}
    want = {p: min(((p[0]-x)**2 + (p[1]-y)**2, i) for i, x, y in targets) for p in queries}
    assert got == want


@pytest.mark.parametrize("direct,hot", [(1024, 200000), (1024, 7), (10, 200000), (0, 200000)])
def test_nearest_in_patch(spark, monkeypatch, direct, hot):
    monkeypatch.setattr(nearest, "DIRECT", direct)
    monkeypatch.setattr(nearest, "HOT", hot)
    rng = random.Random(9)
    rows = [(rng.choice([1, 1, 1, 2]), rng.randint(0, 99), rng.randint(0, 99), rng.randint(0, 9), 2)
            for _ in range(300)] + [(3, 5, 5, 5, 1)] + [(1, 7, 7, z, 2) for z in (9, 8)] * 40
    points = cloud(spark, rows)
    queries = list({(rng.randint(-900, 900), rng.randint(0, 99), rng.choice([1, 2, 3])) for _ in range(60)})
    placed = spark.createDataFrame(queries, "x BIGINT, y BIGINT, patch_id BIGINT")
    got = {(r.x, r.y, r.patch_id): (r.d2, r.z) for r in heights.nearest_point_z(
        placed, heights.points_by_class(points, 2), spatial.patches_of(points)).collect()}
    want = {}
    for x, y, p in queries:
        best = [((x-a)**2 + (y-b)**2, z) for i, a, b, z, c in rows if i == p and c == 2]
        want[(x, y, p)] = min(best) if best else (None, None)
    assert got == want


def test_patch_without_ground_gives_zero_unless_class_is_required(spark):
    t = topology.build_topology(polygons(spark, [("a", 1, "k", [box(0, 0, 10, 10)])]))
    points = cloud(spark, [(1, 0, 0, 7, 1), (1, 10, 10, 7, 1), (2, 40, 40, 3, 2)])
    assert {r.z for r in heights.arc_heights(t, points, "type = 'k'", 2).collect()} == {0.0}
    other = heights.arc_heights(t, points, "type = 'k'", 2, require_class=True)
    assert {r.z for r in other.collect()} == {3.0}


def test_building_without_roof_point_and_equal_gids(spark):
    features = polygons(spark, [("a", 1, "pand", [box(0, 0, 100, 100)]),
                                ("b", 1, "pand", [box(200, 0, 300, 100)])])
    points = cloud(spark, [(1, 50, 50, 4, 6)] * 3 + [(1, 50, 50, 8, 6), (1, 1, 50, 99, 6)])
    got = {(r.source, r.gid): (r.z, r.n_points, r.has_roof)
           for r in heights.roof_height(points, features, 20).collect()}
    assert got == {("a", 1): (5.0, 4, True), ("b", 1): (0.0, 0, False)}


def test_dense_ids(spark):
    df = spark.range(1000).selectExpr("id * 7919 % 1000 AS v").repartition(13)
    got = sorted(map(tuple, ids.with_dense_id(df, ["v"], "n", start=5).collect()))
    assert got == [(v, v + 5) for v in range(1000)]


def test_walls_with_vertices_that_do_not_match(spark):
    terrain = polygons(spark, [("a", 1, "k", [box(0, 0, 100, 50)])]).selectExpr("gid AS i", "rings")
    building = polygons(spark, [("b", 1, "p", [box(20, 50, 40, 90)]),
                                ("b", 2, "p", [box(100, 50, 120, 70)])]).selectExpr("gid AS j", "rings")
    got = [tuple(r) for r in walls.shared_walls(terrain, building, ["i"], ["j"]).collect()]
    assert got == [(1, 1, 40, 50, 20, 50)]


def test_shared_walls_of_reversed_and_partial_edges_without_array_functions(spark):
    terrain = polygons(spark, [("a", 1, "k", [box(0, 0, 100, 50)])]).selectExpr("gid AS i", "rings")
    building = polygons(spark, [("b", 1, "p", [box(-20, 50, 40, 90)]), ("b", 2, "p", [box(20, 10, 30, 50)]),
                                ("b", 3, "p", [box(90, -50, 130, 0)[::-1]]), ("b", 4, "p", [box(-9, 50, 109, 60)])],
                        ).selectExpr("gid AS j", "rings")
    found = walls.shared_walls(terrain, building, ["i"], ["j"])
    assert sorted(tuple(r)[1:] for r in found.collect()) == [
        (1, 40, 50, 0, 50), (2, 30, 50, 20, 50), (3, 90, 0, 100, 0), (4, 100, 50, 0, 50)]
    # sorting arrays in the join's condition took most of the time
    assert "array_sort" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_simplify_keeps_ends_and_shared_borders(spark):
    rng = random.Random(3)
    ring = star(rng, 60, 500, 500, 400)
    t = topology.build_topology(polygons(spark, [
        ("a", 1, "k", [box(0, 0, 1000, 1000), ring[::-1]]), ("a", 2, "k", [ring])]))
    before = {r.arc_id: r.points for r in t.arcs.collect()}
    after = {r.arc_id: r.points for r in edit.simplify_arcs(t.arcs, 5000.0).collect()}
    assert set(before) == set(after)
    for i, points in after.items():
        assert (points[0], points[-1]) == (before[i][0], before[i][-1])
        assert set(points) <= set(before[i])
    assert sum(map(len, after.values())) < sum(map(len, before.values()))


def test_mesh_covers_the_polygon(spark):
    polys = polygons(spark, [("a", 1, "k", [box(0, 0, 90, 90), box(30, 30, 60, 60)[::-1]]),
                             ("a", 2, "k", [[(0, 0), (50, 10), (100, 0), (60, 50), (0, 60)]])])
    mesh_rows = mesh.polygon_mesh(polys, "gid").collect()
    area = {1: 0, 2: 0}
    for r in mesh_rows:
        (ax, ay), (bx, by), (cx, cy) = [tuple(p) for p in r.corners]
        area[r.gid] += abs((bx - ax) * (cy - ay) - (by - ay) * (cx - ax))
    assert area[1] == 2 * (8100 - 900)


def test_patch_on_the_border_of_the_box_only(spark):
    patches = spark.createDataFrame(
        [(1, 0, 0, 10, 10), (2, 10, 0, 10, 5), (3, 2, 2, 11, 5)],
        "patch_id BIGINT, xmin BIGINT, ymin BIGINT, xmax BIGINT, ymax BIGINT")
    assert [r.patch_id for r in spatial.patches_inside(patches, (0, 0, 10, 10)).collect()] == [1]


@pytest.mark.parametrize("direct", [1024, 0])
def test_closest_on_boundary(spark, monkeypatch, direct):
    monkeypatch.setattr(nearest, "DIRECT", direct)
    rng = random.Random(11)
    rings = {1: [box(0, 0, 50, 50), box(10, 10, 20, 20)[::-1]], 2: [star(rng, 40, 500, 0, 300)]}
    feats = polygons(spark, [("a", g, "p", r) for g, r in rings.items()])
    prints = feats.selectExpr("gid AS b", "posexplode(rings) AS (ring, line)")
    segments = [(i, rng.choice([1, 2]), *(rng.randint(-400, 900) for _ in range(4))) for i in range(40)]
    df = spark.createDataFrame(segments, "w BIGINT, b BIGINT, x1 BIGINT, y1 BIGINT, x2 BIGINT, y2 BIGINT")
    got = walls.closest_on_boundary(df, prints, ["w"], ["b"]).collect()
    assert len(got) == 40
    for r in got:
        for x, y, p in ((r.x1, r.y1, r.near_1), (r.x2, r.y2, r.near_2)):
            want = min(d2((x, y), a, b) for a, b in edges_of(rings[r.b]))
            assert abs((x - p.x) ** 2 + (y - p.y) ** 2 - want) < 1e-6


def test_hot_position_and_patch(spark):
    """A third of the points in one place and in one patch changes nothing."""
    features = polygons(spark, [("a", 1, "pand", [box(0, 0, 100, 100)]),
                                ("a", 2, "pand", [box(100, 0, 200, 100)])])
    rows = [(1, 50, 50, 7, 6)] * 3000 + [(1, i % 100, i // 100, 1, 6) for i in range(6000)]
    points = cloud(spark, rows)
    inside = [r for r in rows if 20 <= r[1] <= 80 and 20 <= r[2] <= 80]
    got = {r.gid: (r.n_points, r.z) for r in heights.roof_height(points, features, 20).collect()}
    assert got[1] == (len(inside), sum(r[3] for r in inside) / len(inside)) and got[2] == (0, 0.0)
    t = topology.build_topology(features)
    z = heights.arc_heights(t, points, "type = 'pand'", 6).collect()
    best = lambda x, y: min(((x - r[1]) ** 2 + (y - r[2]) ** 2, r[3]) for r in rows)[1]
    assert all(r.z == best(r.x, r.y) for r in z) and len(z) > 6
