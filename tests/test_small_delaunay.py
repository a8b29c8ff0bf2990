"""Polygons and arcs computed with together give what each gives alone."""

import math
import random
import time

import numpy as np
from conftest import box

from arcrelief.operators import edit, small_delaunay
from arcrelief.operators.delaunay import triangles_within


def shapes(rng):
    """Grids full of points on one circle, stars, holes, bent sides and random rings."""
    grid = [(x, y) for x in range(4) for y in range(4)]
    rng.shuffle(grid)
    yield [grid[:rng.randrange(3, 16)]]
    yield [[(rng.randrange(9), rng.randrange(9)) for _ in range(rng.randrange(3, 14))]]
    n, r = rng.randrange(5, 28), rng.choice([5, 100, 9000])
    yield [[(round(r * f * math.cos(2 * math.pi * i / n)), round(r * f * math.sin(2 * math.pi * i / n)))
            for i in range(n) for f in [rng.choice([1, 1, 0.4])]]]
    yield [box(0, 0, 10, 10), box(3, 3, 7, 7)[::-1]]
    yield [[(0, 0), (500, rng.randrange(5)), (1000, 0), (1000 + rng.randrange(60), 500), (1000, 1000), (500, 1000),
            (0, 1000), (rng.randrange(60), 500)], box(300, 300, 700, 700)[::-1]]
    yield [[(x * 0.1, y * 0.3) for x, y in grid[:7]]]
    yield [[(x * 10**7, y) for x, y in grid[:7]]]


def numbered(rings):
    points = sorted({p for ring in rings for p in ring})
    number = {p: i for i, p in enumerate(points)}
    lines = [[number[p] for p in ring] for ring in rings]
    edges = [(a, b) for line in lines for a, b in zip(line, line[1:] + line[:1]) if a != b]
    return points, lines, (np.array(points, float), np.array(edges, int).reshape(-1, 2))


def test_triangles_together_are_those_of_each_alone():
    rng = random.Random(8)
    cases = [numbered(rings) for _ in range(150) for rings in shapes(rng)]
    found = small_delaunay.triangles_of([c[2] for c in cases])
    decided = 0
    for (points, lines, _), triangles in zip(cases, found):
        if triangles is not None and len(points) > 2:
            decided += 1
            assert triangles.tolist() == triangles_within(points, lines)
    assert decided > 0.6 * len(cases)


def test_small_polygons_take_little_time_each():
    rng = random.Random(2)
    cases = [numbered([[(rng.randrange(1000), rng.randrange(1000)) for _ in range(10)]]) for _ in range(2000)]
    start = time.process_time()
    found = small_delaunay.triangles_of([c[2] for c in cases])
    assert all(t is not None for t in found)
    together = time.process_time() - start
    start = time.process_time()
    for points, lines, _ in cases[:200]:
        triangles_within(points, lines)
    assert together < 5 * (time.process_time() - start)


def test_arcs_weighed_together_are_those_weighed_alone():
    rng = random.Random(4)
    sizes = np.array([rng.choice([0, 1, 2, 3, 3, 4, 7, 12, 40]) for _ in range(400)])
    xs, ys = (np.array([float(rng.choice([rng.randrange(6), rng.random() * 50])) for _ in range(sizes.sum())]) for _ in "xy")
    together, start = edit._weights_of(xs, ys, sizes).to_pylist(), 0
    for n, weights in zip(sizes.tolist(), together):
        assert weights == edit._weights(xs[start:start + n].tolist(), ys[start:start + n].tolist())
        start += n
