"""Dissolving to polygons with holes: equal, overlapping and nested entities."""

from conftest import box, polygons

from arcrelief.operators import edit, topology


def dissolved(spark, rows, q=0):
    t = topology.build_topology(polygons(spark, rows), q)
    rings = edit.dissolve_polygons(t, "type")
    assert rings.where("polygon IS NULL").count() == 0
    found = edit.polygon_rows(rings, "type").collect()
    return sorted(((r.type, r.double_area / 2, len(r.rings)) for r in found), key=lambda x: (x[0] or "", x[1:]))


def test_equal_polygons(spark):
    rows = [("a", i, "k", [box(0, 0, 100, 100)]) for i in range(3)]
    assert dissolved(spark, rows) == [("k", 10000, 1)]
    # an equal pair beside a third one: both sides of the common border are covered
    rows += [("a", 9, "k", [box(100, 0, 200, 100)])]
    assert dissolved(spark, rows) == [("k", 20000, 1)]


def test_nested_polygons(spark):
    rows = [("a", 1, "k", [box(0, 0, 100, 100)]), ("a", 2, "k", [box(20, 20, 40, 40)])]
    assert dissolved(spark, rows) == [("k", 10000, 1)]
    rows = [("a", 1, "k", [box(0, 0, 100, 100)]), ("a", 2, "m", [box(20, 20, 40, 40)])]
    assert dissolved(spark, rows) == [("k", 10000, 1), ("m", 400, 1)]


def test_overlapping_polygons(spark):
    rows = [("a", 1, "k", [[(0, 0), (50, 0), (100, 0), (100, 100), (50, 100), (0, 100)]]),
            ("a", 2, "k", [[(50, 0), (100, 0), (150, 0), (150, 100), (100, 100), (50, 100)]])]
    assert dissolved(spark, rows) == [("k", 15000, 1)]


def test_islands_in_holes(spark):
    hole = list(reversed(box(20, 20, 80, 80)))
    rows = [("a", 1, "k", [box(0, 0, 100, 100), hole]), ("a", 2, "k", [box(40, 40, 60, 60)]),
            ("a", 3, "k", [box(200, 0, 300, 100)])]
    assert dissolved(spark, rows) == [("k", 400, 1), ("k", 6400, 2), ("k", 10000, 1)]
    # the hole filled by two entities of another key, which dissolve into one around the island
    other = [[(20, 20), (50, 20), (50, 40), (40, 40), (40, 60), (50, 60), (50, 80), (20, 80)],
             [(50, 20), (80, 20), (80, 80), (50, 80), (50, 60), (60, 60), (60, 40), (50, 40)]]
    rows += [("b", i, "m", [ring]) for i, ring in enumerate(other)]
    assert dissolved(spark, rows) == [
        ("k", 400, 1), ("k", 6400, 2), ("k", 10000, 1), ("m", 3200, 2)]


def test_null_key_and_quantised(spark):
    rows = [("a", i, None, [box(100 * i, 0, 100 * i + 100, 100)]) for i in range(3)]
    assert dissolved(spark, rows) == [(None, 30000, 1)]
    assert dissolved(spark, rows, q=301)[0][2] == 1


def test_corners_that_touch_stay_apart(spark):
    rows = [("a", 1, "k", [box(0, 0, 10, 10)]), ("a", 2, "k", [box(10, 10, 20, 20)])]
    assert dissolved(spark, rows) == [("k", 100, 1), ("k", 100, 1)]


def test_many_equal_polygons_keep_their_border(spark):
    rows = [("a", i, "k", [box(0, 0, 10, 10)]) for i in range(200)]
    t = topology.build_topology(polygons(spark, rows))
    boundary = edit.dissolve_boundary(t.ring_arcs, "type")
    assert boundary.count() == 1
    assert edit.uncovered(boundary, t, "type").count() == 1
