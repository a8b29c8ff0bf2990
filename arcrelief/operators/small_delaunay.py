"""Triangles of many small polygons at once, the same as ``delaunay.triangles_within`` gives each.

Polygons with equal numbers of vertices are computed with together, as arrays.  Each directed pair of
vertices looks for the vertex on its left whose circle is empty on that side; three vertices
that choose each other are a Delaunay triangle.  Of four vertices on one circle the one inserted
last by ``delaunay`` counts as a little outside, which is what insertion does.  What the arrays can't
decide for sure (rounding, very large whole numbers) is left to ``delaunay``.
"""

from __future__ import annotations

from functools import cache
from random import Random

import numpy as np

MOST = 32  # vertices; more are faster one polygon at a time
_CELLS = 1 << 18  # numbers in an array
_WHOLE = 20_000  # extent up to which products of four whole numbers fit into 64 bits


@cache
def _shuffled(n: int) -> np.ndarray:
    order = list(range(n))
    Random(1).shuffle(order)
    return np.array(order)


def triangles_of(polygons: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray | None]:
    """Triangles (rows of three point numbers) per polygon, or None where nothing is decided.

    A polygon is its distinct points, an array of rows (x, y), and its edges, an array of rows of two
    point numbers.
    """
    found: list[np.ndarray | None] = [None] * len(polygons)
    classes: dict[int, list[int]] = {}
    for i, (points, _) in enumerate(polygons):
        if len(points) < 3:
            found[i] = np.empty((0, 3), int)
        elif len(points) <= MOST and np.isfinite(points).all():
            classes.setdefault(len(points), []).append(i)
    for n, members in classes.items():
        step = max(1, _CELLS // n**2)
        for start in range(0, len(members), step):
            some = members[start:start + step]
            for i, triangles in zip(some, _lockstep([polygons[i] for i in some])):
                found[i] = triangles
    return found


def _lockstep(polygons: list[tuple[np.ndarray, np.ndarray]]) -> list[np.ndarray | None]:
    m, n = len(polygons), len(polygons[0][0])
    given = np.stack([p for p, _ in polygons])
    points = given - given.min(axis=1, keepdims=True)
    size = points.max(axis=(1, 2))
    whole = (given == np.floor(given)).all(axis=(1, 2)) & (np.abs(given) < 2.0**53).all(axis=(1, 2))
    twice = (points[:, :, None] == points[:, None, :]).all(axis=3).sum(axis=(1, 2)) > n
    sure = whole & (size <= _WHOLE) & ~twice
    out: list[np.ndarray | None] = [None] * m
    chosen = np.flatnonzero(sure)
    if not len(chosen):
        return out
    xy = points[chosen].astype(np.int64)
    m = len(xy)
    x, y = xy[..., 0], xy[..., 1]
    rank = _ranks(xy, size[chosen])
    owner, triangles = _delaunay(x, y, rank)
    lengths = [len(polygons[i][1]) for i in chosen]
    edges = np.zeros((m, max(lengths), 2), int)  # the rest are edges from a point to itself
    for row, i, length in zip(edges, chosen, lengths):
        row[:length] = polygons[i][1]
    owner, triangles = _within(x, y, edges, owner, triangles)
    # the corner inserted last comes last
    last = np.argmax(rank[owner[:, None], triangles], axis=1)
    turned = np.take_along_axis(triangles, (last[:, None] + np.array([1, 2, 3])) % 3, axis=1)
    order = np.lexsort((turned[:, 2], turned[:, 1], turned[:, 0], owner))
    owner, turned = owner[order], turned[order]
    for i, part in zip(chosen, np.split(turned, np.searchsorted(owner, np.arange(1, m)))):
        out[i] = part
    return out


def _ranks(xy: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Place of each point in the order of insertion."""
    m, n = xy.shape[:2]
    cells = (xy / np.where(size > 0, size, 1.0)[:, None, None] * 1023).astype(int)
    code = np.zeros((m, n), int)
    for bit in range(10):
        code |= (cells[..., 0] >> bit & 1) << 2 * bit | (cells[..., 1] >> bit & 1) << 2 * bit + 1
    shuffled = _shuffled(n)
    order = shuffled[np.argsort(code[:, shuffled], axis=1, kind="stable")]
    rank = np.empty((m, n), int)
    np.put_along_axis(rank, order, np.broadcast_to(np.arange(n), (m, n)), axis=1)
    return rank


def _delaunay(x: np.ndarray, y: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All Delaunay triangles, counter-clockwise: number of the polygon, point numbers."""
    m, n = x.shape
    # [polygon, i, j]: point j seen from point i
    dx, dy = x[:, None, :] - x[:, :, None], y[:, None, :] - y[:, :, None]
    far = dx * dx + dy * dy
    ri, rj = np.broadcast_to(rank[:, :, None], (m, n, n)), np.broadcast_to(rank[:, None, :], (m, n, n))
    best = np.full((m, n, n), -1)
    top, low = np.ones((m, n, n), np.int64), np.zeros((m, n, n), np.int64)  # infinite
    bx, by = np.zeros((m, n, n), np.int64), np.zeros((m, n, n), np.int64)
    br = np.full((m, n, n), -1)
    for k in range(n):
        kx, ky, k2 = dx[:, :, k:k + 1], dy[:, :, k:k + 1], far[:, :, k:k + 1]
        left = dx * ky - dy * kx
        # by ``left`` this is how far to the left the circle's centre is; the least one wins
        above = k2 - (dx * kx + dy * ky)
        ahead, behind = above * low, top * left
        better = ahead < behind
        level = (ahead == behind) & (best >= 0) & (left > 0)
        if level.any():
            rk = rank[:, k][:, None, None]
            turn = bx * ky - by * kx  # of k, seen from the best one so far
            latest = np.maximum(np.maximum(ri, rj), np.maximum(br, rk))
            better |= level & ((latest == br) | (latest == ri) & (turn > 0) | (latest == rj) & (turn < 0))
        better &= left > 0
        best = np.where(better, k, best)
        top, low = np.where(better, above, top), np.where(better, left, low)
        bx, by = np.where(better, kx, bx), np.where(better, ky, by)
        br = np.where(better, rank[:, k][:, None, None], br)
    owner, i, j = np.nonzero(best >= 0)
    k = best[owner, i, j]
    # each triangle once, from its smallest point
    kept = (best[owner, j, k] == i) & (best[owner, k, i] == j) & (i < j) & (i < k)
    return owner[kept], np.stack([i[kept], j[kept], k[kept]], axis=1)


def _within(x, y, edges, owner, triangles) -> tuple[np.ndarray, np.ndarray]:
    """The triangles that no edge crosses and whose centre is inside."""
    kept = []
    step = max(1, _CELLS // edges.shape[1])
    for start in range(0, len(owner), step):
        own, corners = owner[start:start + step], triangles[start:start + step]
        tx, ty = (v[own[:, None], corners][:, :, None] for v in (x, y))  # [triangle, corner, 1]
        x1, y1, x2, y2 = (v[own[:, None], edges[own, :, e]] for e in (0, 1) for v in (x, y))  # [triangle, edge]
        ex, ey = (x2 - x1)[:, None, :], (y2 - y1)[:, None, :]
        sides = ex * (ty - y1[:, None, :]) - ey * (tx - x1[:, None, :])
        crossed = (sides.max(axis=1) > 0) & (sides.min(axis=1) < 0)
        for a, b in ((0, 1), (1, 2), (2, 0)):
            ax, ay = tx[:, a], ty[:, a]
            sx, sy = tx[:, b] - ax, ty[:, b] - ay
            crossed &= (sx * (y1 - ay) - sy * (x1 - ax) > 0) | (sx * (y2 - ay) - sy * (x2 - ax) > 0)
        px, py = tx.sum(axis=1), ty.sum(axis=1)  # three times the centre
        spans = (3 * y1 <= py) != (3 * y2 <= py)
        left = (x2 - x1) * (py - 3 * y1) - (y2 - y1) * (px - 3 * x1) > 0
        inside = np.count_nonzero(spans & (left == (y2 > y1)), axis=1) % 2 == 1
        kept.append(inside & ~crossed.any(axis=1))
    chosen = np.concatenate(kept) if kept else np.zeros(0, bool)
    return owner[chosen], triangles[chosen]
