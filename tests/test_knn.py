"""The k nearest targets against brute force, on even, dense and degenerate targets."""

import random

import pytest
from conftest import cloud

from arcrelief.operators import heights, knn
from arcrelief.operators.knn import NEAREST, nearest_k
from arcrelief.operators.nearest import TO_BOX

TARGETS = "grp LONG, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE, id LONG"


def brute(queries, targets, k, grouped):
    out = {}
    for q in queries:
        grp, x, y = q
        found = []
        for t in targets:
            if grouped and (grp is None or t[0] != grp):
                continue
            dx, dy = max(t[1] - x, 0, x - t[3]), max(t[2] - y, 0, y - t[4])
            found.append((dx * dx + dy * dy, t[5]))
        out[q] = sorted(found)[:k]
    return out


def got(spark, queries, targets, k, grouped=True, leaf=4):
    q = spark.createDataFrame(queries, "grp LONG, x DOUBLE, y DOUBLE")
    t = spark.createDataFrame(targets, TARGETS)
    found = nearest_k(q, t, k, ("id",), ("grp",) if grouped else (), TO_BOX, leaf)
    rows = found.collect()
    assert len(rows) == len(queries)
    return {(r.grp, r.x, r.y): [(n.d2, n.id) for n in r[NEAREST]] for r in rows}


def point(grp, x, y, i):
    return (grp, float(x), float(y), float(x), float(y), i)


@pytest.mark.parametrize("k, grouped", [(1, False), (3, True)])
def test_half_of_the_targets_in_one_spot(spark, k, grouped):
    random.seed(1)
    targets = [point(1, random.uniform(0, 1e6), random.uniform(0, 1e6), i) for i in range(400)]
    targets += [point(1, 5e5 + random.random(), 5e5 + random.random(), 400 + i) for i in range(400)]
    queries = [(1, random.uniform(-1e5, 11e5), random.uniform(-1e5, 11e5)) for _ in range(60)]
    queries += [(1, 5e5 + random.uniform(-2, 3), 5e5 + random.uniform(-2, 3)) for _ in range(60)]
    assert got(spark, queries, targets, k, grouped) == brute(queries, targets, k, grouped)


def test_boxes_of_all_sizes_ties_and_groups(spark):
    random.seed(2)
    targets = []
    for i in range(300):
        x, y, w = random.randrange(100), random.randrange(100), random.choice([0, 1, 5, 60])
        targets.append((random.choice([1, 2, 3]), float(x), float(y), float(x + w), float(y + w), i))
    targets += [(9, -1e5, -1e5, 1e5, 1e5, 1000), *[point(9, i, i, i) for i in range(50)], point(4, 7, 7, 1)]
    queries = list({(random.choice([1, 2, 3, 4, 5, 9, None]), float(random.randrange(-5, 110)),
                     float(random.randrange(-5, 110))) for _ in range(150)})
    assert got(spark, queries, targets, 4) == brute(queries, targets, 4, True)


def test_equal_positions_and_copies(spark):
    targets = [point(1, 5, 5, i) for i in range(200)] + [point(1, 6, 5, 7)] * 50
    queries = [(1, 5.0, 5.0), (1, 6.0, 5.0), (1, 100.0, 100.0)]
    assert got(spark, queries, targets, 6) == brute(queries, targets, 6, True)
    assert got(spark, queries, [], 2) == {q: [] for q in queries}
    assert got(spark, [], targets, 2) == {}


def test_highest_of_the_nearest(spark):
    placed = spark.createDataFrame([(0, 0, 1), (10, 0, 1), (0, 0, 2)], "x LONG, y LONG, patch_id LONG")
    points = cloud(spark, [(1, 1, 0, 5, 2), (1, 2, 0, 9, 2), (1, 8, 0, 1, 2)])
    found = {(r.x, r.patch_id): (r.n, r.d2, r.z) for r in
             heights.highest_of_nearest(placed, points, 2).collect()}
    assert found == {(0, 1): (2, 4.0, 9), (10, 1): (2, 64.0, 9), (0, 2): (0, None, None)}


def test_small_groups_are_searched_without_a_tree(spark, monkeypatch):
    random.seed(4)
    targets = [point(grp, random.randrange(50), random.randrange(50), i) for i in range(300) for grp in [i % 30]]
    targets += [point(1, 7, 7, 9)] * 3 + [(2, None, 1.0, None, 1.0, 5), (None, 1.0, 1.0, 1.0, 1.0, 5)]
    queries = [(grp, float(random.randrange(60)), float(random.randrange(60))) for grp in [*range(32), None]]
    held = []
    tree = knn._tree
    monkeypatch.setattr(knn, "_tree", lambda rows, *rest: held.append(rows.count()) or tree(rows, *rest))
    known = [t for t in targets if t[1] is not None]
    assert got(spark, queries, targets, 5) == brute(queries, known, 5, True)
    assert held == []
    # of a mixture only the large group is cut into cells
    more = [point(77, i % 40, i // 40, i) for i in range(400)]
    queries += [(77, float(i), 3.5) for i in range(-3, 12)]
    assert got(spark, queries, targets + more, 5) == brute(queries, known + more, 5, True)
    assert held == [400]
