"""The same results in plain SQL, written independently of the Spark jobs.

Everything is brute force over the derived tables: window functions for neighbours, cross
joins with exact arithmetic for the spatial joins, recursion for stitching and simplifying.
Used only to check results.
"""

from __future__ import annotations

from ..sources.derived import BUILDINGS, CLIP_BOX, EROSION, HOLES, INSET
from .catalogue import COARSE, COLLAPSE_AREA, GROUND_BOX, SIMPLIFY_AREA, Q


def _shape_rows() -> str:
    rows = []
    for shape, hole in HOLES.items():
        for part, ring in enumerate([hole, *BUILDINGS[shape]]):
            rows += [f"('{shape}', {part}, {i}, {x}, {y})" for i, (x, y) in enumerate(ring)]
    return ", ".join(rows)


BASE = f"""
cell AS (
  SELECT p_partkey AS k, p_partkey % 50 AS c, CAST(floor(p_partkey / 50) AS BIGINT) AS r,
         lower(p_type) AS type,
         CASE WHEN p_size % 12 = 0 THEN 'split' WHEN p_size % 8 = 0 THEN 'L'
              WHEN p_size % 4 = 0 THEN 'sq' ELSE 'none' END AS shape
  FROM part),
shape(shape, part, pos, dx, dy) AS (VALUES {_shape_rows()}),
v AS (
  SELECT 'parcel' AS source, k AS gid, type, 0 AS ring, p.pos,
    c * 1000 + CASE p.pos WHEN 1 THEN 500 WHEN 2 THEN 1000
      WHEN 3 THEN 1000 + 10 * ((c + 1 + r) % 7) WHEN 4 THEN 1000 WHEN 5 THEN 500
      WHEN 7 THEN 10 * ((c + r) % 7) ELSE 0 END AS x,
    r * 1000 + CASE p.pos WHEN 1 THEN 10 * ((c + r) % 5) WHEN 3 THEN 500 WHEN 4 THEN 1000
      WHEN 5 THEN 1000 + 10 * ((c + r + 1) % 5) WHEN 6 THEN 1000 WHEN 7 THEN 500 ELSE 0 END AS y
  FROM cell CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6), (7)) AS p(pos)
  UNION ALL
  SELECT 'parcel', k, type, 1, s.pos, c * 1000 + s.dx, r * 1000 + s.dy
  FROM cell JOIN shape s ON s.shape = cell.shape AND s.part = 0
  UNION ALL
  SELECT 'pand', k + 1000000 * (s.part - 1), 'pand', 0, s.pos, c * 1000 + s.dx, r * 1000 + s.dy
  FROM cell JOIN shape s ON s.shape = cell.shape AND s.part > 0),
"""

POINTS = """
p AS (
  SELECT CAST(floor(x / 2000) AS BIGINT) * 100000 + CAST(floor(y / 2000) AS BIGINT) AS patch_id,
    x, y, z,
    CASE WHEN cls = 2 AND (CAST(floor(x / 2000) AS BIGINT) + CAST(floor(y / 2000) AS BIGINT)) % 7 = 0
         THEN 1 ELSE cls END AS classification
  FROM (
    SELECT (l_partkey % 50) * 1000 + (l_orderkey * 37 + l_linenumber * 101) % 1000 AS x,
      CAST(floor(l_partkey / 50) AS BIGINT) * 1000
        + (l_suppkey * 53 + CAST(l_quantity AS BIGINT) * 71 + l_orderkey * 13) % 1000 AS y,
      CAST(l_quantity AS BIGINT) * 10 AS z,
      CASE l_returnflag WHEN 'A' THEN 2 WHEN 'R' THEN 6 ELSE 1 END AS cls
    FROM lineitem) q),
pa AS (
  SELECT patch_id, min(x) AS xmin, min(y) AS ymin, max(x) AS xmax, max(y) AS ymax,
    count(*) AS n, count(*) FILTER (classification = 2) AS n_ground,
    count(*) FILTER (classification = 6) AS n_roof
  FROM p GROUP BY patch_id),
"""

# polygon edges with both neighbours; vq is v or its quantised form
EDGES = """
ent AS (
  SELECT row_number() OVER (ORDER BY source, gid) AS entity_id, source, gid, type
  FROM (SELECT DISTINCT source, gid, type FROM v)),
nb AS MATERIALIZED (
  SELECT e.entity_id, v.*, count(*) OVER w AS n,
    coalesce(lag(x) OVER o, last_value(x) OVER w2) AS px,
    coalesce(lag(y) OVER o, last_value(y) OVER w2) AS py,
    coalesce(lead(x) OVER o, first_value(x) OVER w2) AS nx,
    coalesce(lead(y) OVER o, first_value(y) OVER w2) AS ny
  FROM vq AS v JOIN ent e USING (source, gid)
  WINDOW w AS (PARTITION BY v.source, v.gid, v.ring),
    o AS (PARTITION BY v.source, v.gid, v.ring ORDER BY v.pos),
    w2 AS (PARTITION BY v.source, v.gid, v.ring ORDER BY v.pos
           ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
"""

TOPOLOGY = """
junc AS (
  SELECT x, y, count(*) AS n_uses FROM nb GROUP BY x, y
  HAVING count(DISTINCT CASE WHEN px > nx OR (px = nx AND py > ny)
    THEN concat_ws(',', nx, ny, px, py) ELSE concat_ws(',', px, py, nx, ny) END) > 1),
fl AS (
  SELECT nb.*, junc.x IS NOT NULL AS node,
    min(CASE WHEN junc.x IS NOT NULL THEN pos END) OVER (PARTITION BY entity_id, ring) AS fj
  FROM nb LEFT JOIN junc ON junc.x = nb.x AND junc.y = nb.y),
sq AS (
  SELECT *, sum(CASE WHEN node THEN 1 ELSE 0 END) OVER (
    PARTITION BY entity_id, ring ORDER BY (pos - fj + n) % n) - 1 AS seg
  FROM fl WHERE fj IS NOT NULL),
sl AS (
  SELECT entity_id, ring, seg, list({'x': x, 'y': y} ORDER BY (pos - fj + n) % n) AS l
  FROM sq GROUP BY entity_id, ring, seg),
cl AS (
  SELECT entity_id, ring, seg, list_append(l, coalesce(
    lead(l[1]) OVER (PARTITION BY entity_id, ring ORDER BY seg),
    first_value(l[1]) OVER (PARTITION BY entity_id, ring ORDER BY seg))) AS line
  FROM sl),
fr AS (
  SELECT *, first_value(pos) OVER (PARTITION BY entity_id, ring ORDER BY x, y) AS st
  FROM fl WHERE fj IS NULL),
fl2 AS (
  SELECT entity_id, ring, list({'x': x, 'y': y} ORDER BY (pos - st + n) % n) AS f,
    list({'x': x, 'y': y} ORDER BY (st - pos + n) % n) AS b
  FROM fr GROUP BY entity_id, ring),
piece AS MATERIALIZED (
  SELECT entity_id, ring, seg, line, least(line, list_reverse(line)) AS pts FROM cl
  UNION ALL
  SELECT entity_id, ring, 0, list_append(f, f[1]),
    least(list_append(f, f[1]), list_append(b, b[1])) FROM fl2),
arc AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY fu) - 1 AS arc_id, pts FROM (
    SELECT pts, min({'e': entity_id, 'r': ring, 's': seg}) AS fu FROM piece GROUP BY pts)),
ra AS MATERIALIZED (
  SELECT e.entity_id, e.source, e.gid, e.type, c.ring, c.seg AS pos, a.arc_id,
    c.line <> c.pts AS reversed, c.line
  FROM piece c JOIN arc a ON a.pts = c.pts JOIN ent e ON e.entity_id = c.entity_id),
av AS (
  SELECT arc_id, i - 1 AS pos, pts[i].x AS x, pts[i].y AS y, len(pts) AS n
  FROM (SELECT arc_id, pts, unnest(generate_series(1, len(pts))) AS i FROM arc)),
ae AS (
  SELECT arc_id, pos, x AS x1, y AS y1, lead(x) OVER o AS x2, lead(y) OVER o AS y2
  FROM av WINDOW o AS (PARTITION BY arc_id ORDER BY pos) QUALIFY x2 IS NOT NULL),
"""

PLAIN = "vq AS (SELECT * FROM v),"
TRANSFORM = """
tf AS (
  SELECT CASE WHEN max(x) = min(x) THEN 1.0::DOUBLE
      ELSE (max(x)::DOUBLE - min(x)::DOUBLE) / ({q}::DOUBLE - 1) END AS kx,
    CASE WHEN max(y) = min(y) THEN 1.0::DOUBLE
      ELSE (max(y)::DOUBLE - min(y)::DOUBLE) / ({q}::DOUBLE - 1) END AS ky,
    min(x)::DOUBLE AS dx, min(y)::DOUBLE AS dy FROM v),
"""
QUANTISED = """
vq AS (
  SELECT source, gid, type, ring, pos,
    CAST(floor((x - dx) / kx + 0.5) AS BIGINT) AS x, CAST(floor((y - dy) / ky + 0.5) AS BIGINT) AS y
  FROM v, tf),
"""


def _cross(a: str, b: str, px: str, py: str) -> str:
    ax, ay, bx, by = f"{a}.x", f"{a}.y", f"{b}.nx", f"{b}.ny"
    return f"(({bx} - {ax}) * ({py} - {ay}) - ({by} - {ay}) * ({px} - {ax}))"


def _dist2(e: str, px: str, py: str) -> str:
    dx, dy = f"({e}.nx - {e}.x)", f"({e}.ny - {e}.y)"
    dot = f"(({px} - {e}.x) * {dx} + ({py} - {e}.y) * {dy})"
    len2 = f"({dx} * {dx} + {dy} * {dy})"
    cross = f"CAST({_cross(e, e, px, py)} AS DOUBLE)"
    return f"""CASE
      WHEN {dot} <= 0 THEN (({px} - {e}.x) * ({px} - {e}.x) + ({py} - {e}.y) * ({py} - {e}.y))::DOUBLE
      WHEN {dot} >= {len2} THEN
        (({px} - {e}.nx) * ({px} - {e}.nx) + ({py} - {e}.ny) * ({py} - {e}.ny))::DOUBLE
      ELSE {cross} * {cross} / {len2}::DOUBLE END"""


INSIDE = f"""
ext AS (
  SELECT entity_id, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax
  FROM nb WHERE source = 'pand' GROUP BY entity_id),
pt AS (SELECT *, row_number() OVER () AS rid FROM p WHERE classification = 6),
cand AS (
  SELECT x.entity_id, pt.* FROM pt JOIN ext x
    ON pt.x BETWEEN x.xmin AND x.xmax AND pt.y BETWEEN x.ymin AND x.ymax),
pip AS (
  SELECT c.entity_id, c.rid, any_value(c.patch_id) AS patch_id, any_value(c.x) AS x,
    any_value(c.y) AS y, any_value(c.z) AS z, any_value(c.classification) AS classification,
    sum(CASE WHEN (e.y <= c.y) <> (e.ny <= c.y) AND ({_cross('e', 'e', 'c.x', 'c.y')} > 0) = (e.ny > e.y)
      THEN 1 ELSE 0 END) % 2 = 1 AS inside,
    min({_dist2('e', 'c.x', 'c.y')}) AS d2
  FROM cand c JOIN nb e ON e.entity_id = c.entity_id GROUP BY c.entity_id, c.rid),
"""
ROOF_Z = f"""
rz AS (
  SELECT entity_id, sum(z)::DOUBLE / count(*) AS z, count(*) AS n
  FROM pip WHERE inside AND d2 >= {EROSION * EROSION} GROUP BY entity_id),
"""

NEAREST = """
np AS MATERIALIZED (
  SELECT x, y, b.p AS patch_id, b.d AS d2 FROM (
    SELECT q.x, q.y, min({'d': (
        greatest(xmin - q.x, 0, q.x - xmax)::DOUBLE * greatest(xmin - q.x, 0, q.x - xmax)
        + greatest(ymin - q.y, 0, q.y - ymax)::DOUBLE * greatest(ymin - q.y, 0, q.y - ymax)),
        'p': patch_id}) AS b
    FROM (SELECT DISTINCT x, y FROM av) q, pa GROUP BY q.x, q.y)),
nz AS (
  SELECT n.x, n.y, n.patch_id, p.classification AS cls, min({'d':
      ((n.x - p.x) * (n.x - p.x) + (n.y - p.y) * (n.y - p.y))::DOUBLE, 'z': p.z}) AS b
  FROM np n JOIN p ON p.patch_id = n.patch_id GROUP BY n.x, n.y, n.patch_id, p.classification),
"""

HEIGHTS = """
tz AS (
  SELECT av.arc_id, av.pos, av.x, av.y, coalesce(nz.b.z::DOUBLE, 0) AS z
  FROM av LEFT JOIN nz ON nz.x = av.x AND nz.y = av.y AND nz.cls = 2
  WHERE arc_id IN (SELECT arc_id FROM ra WHERE type <> 'pand')),
"""

# arc edges against patch boxes: extents overlap and the corners are not all on one side
ARC_PATCH = """
ap AS (
  SELECT DISTINCT e.arc_id, pa.patch_id FROM ae e JOIN pa
    ON least(x1, x2) <= xmax AND greatest(x1, x2) >= xmin
   AND least(y1, y2) <= ymax AND greatest(y1, y2) >= ymin
  WHERE least((x2-x1)*(ymin-y1)-(y2-y1)*(xmin-x1), (x2-x1)*(ymin-y1)-(y2-y1)*(xmax-x1),
              (x2-x1)*(ymax-y1)-(y2-y1)*(xmin-x1), (x2-x1)*(ymax-y1)-(y2-y1)*(xmax-x1)) <= 0
    AND greatest((x2-x1)*(ymin-y1)-(y2-y1)*(xmin-x1), (x2-x1)*(ymin-y1)-(y2-y1)*(xmax-x1),
              (x2-x1)*(ymax-y1)-(y2-y1)*(xmin-x1), (x2-x1)*(ymax-y1)-(y2-y1)*(xmax-x1)) >= 0),
"""

RAISED = """
rn AS (
  SELECT ra.*, (SELECT count(*) FROM arc)
      + row_number() OVER (ORDER BY entity_id, ring, pos) - 1 AS new_id
  FROM ra WHERE type = 'pand'),
ru AS (
  SELECT entity_id, source, gid, ring, pos, arc_id, reversed, line, NULL::DOUBLE AS z
  FROM ra WHERE type <> 'pand'
  UNION ALL
  SELECT rn.entity_id, source, gid, ring, pos, new_id, reversed, line, coalesce(rz.z, 0)
  FROM rn LEFT JOIN rz ON rz.entity_id = rn.entity_id),
"""

# ring vertices from pieces: each piece without its last vertex, in piece order
RING_LINES = """
rv AS (
  SELECT entity_id, ring, seg, i, line[i].x AS x, line[i].y AS y,
    row_number() OVER (PARTITION BY entity_id, ring ORDER BY seg, i) - 1 AS pos
  FROM (SELECT *, unnest(generate_series(1, len(line) - 1)) AS i FROM piece)),
rc AS (
  SELECT entity_id, ring, pos, x, y FROM rv
  UNION ALL
  SELECT entity_id, ring, count(*) OVER (PARTITION BY entity_id, ring), x, y FROM rv
  QUALIFY pos = 0),
"""
SOLID = """
sv AS (
  SELECT u.entity_id, u.source, u.gid, v.ring, v.pos, v.x, v.y, coalesce(u.z, h.z) AS z
  FROM rv v JOIN ru u ON u.entity_id = v.entity_id AND u.ring = v.ring AND u.pos = v.seg
  LEFT JOIN (SELECT DISTINCT x, y, z FROM tz) h ON h.x = v.x AND h.y = v.y),
"""

# boundary arcs per type, walked with the inside on the left
BOUNDARY = """
area AS (
  SELECT entity_id, ring, sum(x * ny - nx * y) AS a2 FROM nb GROUP BY entity_id, ring),
bd AS MATERIALIZED (
  SELECT type, arc_id, any_value(reversed = ((a2 > 0) = (ra.ring = 0))) AS backward
  FROM ra JOIN area ON area.entity_id = ra.entity_id AND area.ring = ra.ring
  GROUP BY type, arc_id HAVING count(*) = 1),
am AS (
  SELECT arc_id, count(*) AS n_edges, sum(sqrt(((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2))::DOUBLE)) AS l,
    sum(x1 * y2 - x2 * y1) AS a2
  FROM ae GROUP BY arc_id),
"""
STITCH = """
dl AS (
  SELECT type, b.arc_id, backward, CASE WHEN backward THEN list_reverse(pts) ELSE pts END AS l
  FROM bd b JOIN arc a ON a.arc_id = b.arc_id),
ends AS (
  SELECT type, l[1].x AS x, l[1].y AS y, arc_id AS leaves, NULL::BIGINT AS arrives,
    atan2((l[2].y - l[1].y)::DOUBLE, (l[2].x - l[1].x)::DOUBLE) AS turn FROM dl
  UNION ALL
  SELECT type, l[-1].x, l[-1].y, NULL, arc_id,
    atan2((l[-2].y - l[-1].y)::DOUBLE, (l[-2].x - l[-1].x)::DOUBLE) FROM dl),
fo AS MATERIALIZED (
  SELECT a.type, a.arrives AS arc_id, arg_min(o.leaves,
    CASE WHEN o.turn < a.turn THEN a.turn - o.turn ELSE a.turn - o.turn + 2 * pi() END) AS nxt
  FROM ends a JOIN ends o ON o.type = a.type AND o.x = a.x AND o.y = a.y
  WHERE a.arrives IS NOT NULL AND o.leaves IS NOT NULL GROUP BY a.type, a.arrives),
walk AS (
  SELECT type, arc_id AS start, arc_id FROM fo
  UNION ALL
  SELECT w.type, w.start, f.nxt FROM walk w JOIN fo f ON f.type = w.type AND f.arc_id = w.arc_id
  WHERE f.nxt <> w.start),
nm AS (SELECT type, start AS arc_id, min(arc_id) AS ring FROM walk GROUP BY type, start),
"""

# repeated removal of the inner vertex with the least triangle
SIMPLIFY = """
sim AS (
  SELECT arc_id, list({'pos': pos, 'x': x, 'y': y} ORDER BY pos) AS l, NULL::BIGINT AS gone,
    0.0::DOUBLE AS w FROM av WHERE n > 2 GROUP BY arc_id
  UNION ALL
  SELECT arc_id, list_concat(l[1:k], l[k + 2:]), l[k + 1].pos, greatest(w, a) FROM (
    SELECT *, list_min(ar) AS a, list_position(ar, list_min(ar)) AS k FROM (
      SELECT *, list_transform(range(2, len(l)), lambda i:
        abs((l[i-1].x - l[i+1].x) * (l[i].y - l[i-1].y)
          - (l[i-1].x - l[i].x) * (l[i+1].y - l[i-1].y)) / 2) AS ar
      FROM sim WHERE len(l) > 2))),
"""

# of each ring left with fewer than three vertices the heaviest that would go
WEIGHT = f"""
weight AS MATERIALIZED (
  SELECT av.*, q.w, coalesce(q.w >= {COLLAPSE_AREA}, true) AS kept FROM av
  LEFT JOIN (SELECT arc_id, gone AS pos, w FROM sim WHERE gone IS NOT NULL) q USING (arc_id, pos)),
brief AS (
  SELECT entity_id, ring, sum(k - 1) AS n_left FROM ra
  JOIN (SELECT arc_id, count(*) FILTER (kept) AS k FROM weight GROUP BY arc_id) USING (arc_id)
  GROUP BY entity_id, ring HAVING sum(k - 1) < 3),
guard AS (
  SELECT arc_id, pos FROM (
    SELECT DISTINCT entity_id, ring, n_left, weight.arc_id, weight.pos, w
    FROM brief JOIN ra USING (entity_id, ring) JOIN weight ON weight.arc_id = ra.arc_id AND NOT kept)
  QUALIFY row_number() OVER (PARTITION BY entity_id, ring ORDER BY w DESC, arc_id, pos) <= 3 - n_left),
"""

TOPO = BASE + PLAIN + EDGES + TOPOLOGY
QTOPO = BASE + TRANSFORM.format(q=Q) + QUANTISED + EDGES + TOPOLOGY
WALLS = """
ws AS (
  SELECT a.arc_id, e.pos, a.entity_id AS entity_a, b.entity_id AS entity_b, x1, y1, x2, y2
  FROM ra a JOIN ra b ON b.arc_id = a.arc_id AND a.type <> 'pand' AND b.type = 'pand'
  JOIN ae e ON e.arc_id = a.arc_id),
"""
OFFSET = f"""
un AS (
  SELECT nb.*, CASE WHEN (a2 > 0) = (nb.ring = 0) THEN 1 ELSE -1 END * {INSET} AS s,
    (y - ny) / sqrt(((nx-x)*(nx-x) + (ny-y)*(ny-y))::DOUBLE) AS ubx,
    (nx - x) / sqrt(((nx-x)*(nx-x) + (ny-y)*(ny-y))::DOUBLE) AS uby,
    (py - y) / sqrt(((px-x)*(px-x) + (py-y)*(py-y))::DOUBLE) AS uax,
    (x - px) / sqrt(((px-x)*(px-x) + (py-y)*(py-y))::DOUBLE) AS uay
  FROM nb JOIN (SELECT entity_id, ring, sum(x * ny - nx * y) AS a2 FROM nb GROUP BY entity_id, ring) a
    ON a.entity_id = nb.entity_id AND a.ring = nb.ring),
inset AS (
  SELECT entity_id, source, gid, ring, pos, n,
    x + s * (uax + ubx) / (1 + uax * ubx + uay * uby) AS x,
    y + s * (uay + uby) / (1 + uax * ubx + uay * uby) AS y
  FROM un),
"""
CLOSEST = """
ie AS (
  SELECT a.entity_id, a.ring, a.pos, a.x AS ex1, a.y AS ey1, b.x AS ex2, b.y AS ey2
  FROM inset a JOIN inset b ON b.entity_id = a.entity_id AND b.ring = a.ring
    AND b.pos = (a.pos + 1) % a.n
  WHERE a.source = 'pand'),
we AS (
  SELECT arc_id, pos, entity_b, 1 AS which, x1 AS x, y1 AS y FROM ws
  UNION ALL SELECT arc_id, pos, entity_b, 2, x2, y2 FROM ws),
pr AS (
  SELECT w.*, ring, i.pos AS epos, ex1, ey1, ex2 - ex1 AS vx, ey2 - ey1 AS vy,
    greatest(0.0, least(1.0, ((w.x - ex1) * (ex2 - ex1) + (w.y - ey1) * (ey2 - ey1))
      / ((ex2 - ex1) * (ex2 - ex1) + (ey2 - ey1) * (ey2 - ey1)))) AS t
  FROM we w JOIN ie i ON i.entity_id = w.entity_b),
cp AS (
  SELECT arc_id, pos, entity_b, which, min({'d': (x - (ex1 + t * vx)) * (x - (ex1 + t * vx))
      + (y - (ey1 + t * vy)) * (y - (ey1 + t * vy)), 'r': ring, 'e': epos,
      'x': ex1 + t * vx, 'y': ey1 + t * vy}) AS b
  FROM pr GROUP BY arc_id, pos, entity_b, which),
cb AS (
  SELECT a.arc_id, a.pos, a.entity_b, a.b.x AS near_x1, a.b.y AS near_y1,
    c.b.x AS near_x2, c.b.y AS near_y2
  FROM cp a JOIN cp c ON c.arc_id = a.arc_id AND c.pos = a.pos AND c.entity_b = a.entity_b
  WHERE a.which = 1 AND c.which = 2),
"""



def _sql(ctes: str, select: str) -> str:
    return f"WITH RECURSIVE {ctes.strip().rstrip(',')}\n{select.strip()}"


def _i(*names: str) -> str:
    return ", ".join(f"{n}::BIGINT AS {n.split('.')[-1]}" for n in names)


def oracle_sql() -> dict[str, str]:
    clip = dict(zip(("x0", "y0", "x1", "y1"), CLIP_BOX))
    ground = dict(zip(("x0", "y0", "x1", "y1"), GROUND_BOX))
    closed = """closed AS (
      SELECT source, gid, type, ring, pos, x, y FROM nb
      UNION ALL SELECT source, gid, type, ring, n, x, y FROM nb WHERE pos = 0),"""
    box_corner_inside = (
        f"sum(CASE WHEN (y <= {{y}}) <> (ny <= {{y}}) AND"
        f" ({_cross('nb', 'nb', '{x}', '{y}')} > 0) = (ny > y) THEN 1 ELSE 0 END) % 2 = 1"
    )

    def edge_in_box(e: str, x0: str, y0: str, x1: str, y1: str) -> str:
        corners = ", ".join(
            _cross(e, e, x, y) for x in (x0, x1) for y in (y0, y1)
        )
        return (
            f"(least({e}.x, {e}.nx) <= {x1} AND greatest({e}.x, {e}.nx) >= {x0}"
            f" AND least({e}.y, {e}.ny) <= {y1} AND greatest({e}.y, {e}.ny) >= {y0}"
            f" AND least({corners}) <= 0 AND greatest({corners}) >= 0)"
        )

    plain_edges = BASE + PLAIN + EDGES
    roof = BASE + POINTS + PLAIN + EDGES + INSIDE
    near = BASE + POINTS + PLAIN + EDGES + TOPOLOGY + NEAREST
    raised = BASE + POINTS + PLAIN + EDGES + TOPOLOGY + INSIDE + ROOF_Z + RAISED
    solid = (BASE + POINTS + PLAIN + EDGES + TOPOLOGY + INSIDE + ROOF_Z + RAISED + NEAREST
             + HEIGHTS + RING_LINES + SOLID)
    polygon_patch = f"""
            SELECT DISTINCT source, gid, patch_id FROM (
              SELECT e.source, e.gid, patch_id FROM nb e JOIN pa
                ON least(e.x, e.nx) <= xmax AND greatest(e.x, e.nx) >= xmin
               AND least(e.y, e.ny) <= ymax AND greatest(e.y, e.ny) >= ymin
              WHERE {edge_in_box('e', 'xmin', 'ymin', 'xmax', 'ymax')}
              UNION ALL
              SELECT any_value(source), any_value(gid), patch_id FROM nb JOIN pa
                ON (nb.y <= ymin) <> (nb.ny <= ymin)
              WHERE ({_cross('nb', 'nb', 'xmin', 'ymin')} > 0) = (nb.ny > nb.y)
              GROUP BY entity_id, patch_id HAVING count(*) % 2 = 1)"""
    return {
        "points_by_class": _sql(
            POINTS, f"SELECT {_i('patch_id', 'x', 'y', 'z', 'classification')}"
            " FROM p WHERE classification = 2"),
        "patch_stats": _sql(
            POINTS, f"SELECT {_i('patch_id', 'xmin', 'ymin', 'xmax', 'ymax', 'n', 'n_ground', 'n_roof')} FROM pa"),
        "clip_features": _sql(
            plain_edges, f"""SELECT any_value(source) AS source, any_value(gid) AS gid,
              any_value(type) AS type FROM nb GROUP BY entity_id
            HAVING bool_or({edge_in_box('nb', *(str(clip[k]) for k in ('x0', 'y0', 'x1', 'y1')))})
              OR ({box_corner_inside.format(x=clip['x0'], y=clip['y0'])})"""),
        "ground_points_in_box": _sql(
            POINTS, f"""SELECT {_i('p.patch_id', 'x', 'y', 'z', 'classification')}
            FROM p JOIN pa ON pa.patch_id = p.patch_id
            WHERE classification = 2 AND xmin >= {ground['x0']} AND xmax <= {ground['x1']}
              AND ymin >= {ground['y0']} AND ymax <= {ground['y1']}
              AND xmax > {ground['x0']} AND xmin < {ground['x1']}
              AND ymax > {ground['y0']} AND ymin < {ground['y1']}"""),
        "points_in_polygon": _sql(
            roof, f"SELECT {_i('patch_id', 'x', 'y', 'z', 'classification')}, source, gid"
            " FROM pip JOIN ent USING (entity_id) WHERE inside OR d2 = 0"),
        "roof_points": _sql(
            roof, f"SELECT {_i('patch_id', 'x', 'y', 'z', 'classification')}, source, gid"
            f" FROM pip JOIN ent USING (entity_id) WHERE inside AND d2 >= {EROSION * EROSION}"),
        "roof_height": _sql(
            roof + ROOF_Z, """SELECT source, gid, round(coalesce(z, 0), 6) AS z,
              coalesce(n, 0)::BIGINT AS n_points, n IS NOT NULL AS has_roof
            FROM ent LEFT JOIN rz ON rz.entity_id = ent.entity_id WHERE source = 'pand'"""),
        "roof_height_rebuilt": _sql(
            roof + ROOF_Z, """SELECT ent.entity_id::BIGINT AS entity_id, gid,
              round(coalesce(z, 0), 6) AS z, coalesce(n, 0)::BIGINT AS n_points,
              n IS NOT NULL AS has_roof
            FROM ent LEFT JOIN rz ON rz.entity_id = ent.entity_id WHERE source = 'pand'"""),
        "polygon_patch_join": _sql(BASE + POINTS + PLAIN + EDGES, polygon_patch),
        "mixed_extent_pairs": _sql(
            BASE + POINTS + PLAIN + EDGES, f"""{polygon_patch}
            UNION ALL SELECT 'around', 0, patch_id FROM pa UNION ALL SELECT 'around', 0, -1
            UNION ALL SELECT source, gid, -1 FROM ent"""),
        "arc_patch_join": _sql(
            BASE + POINTS + PLAIN + EDGES + TOPOLOGY + ARC_PATCH,
            f"SELECT {_i('arc_id', 'patch_id')} FROM ap"),
        "polygon_polygon_join": _sql(
            plain_edges, f"""SELECT DISTINCT a.gid AS parcel, b.gid AS building FROM nb a JOIN nb b
              ON a.source = 'parcel' AND b.source = 'pand'
             AND least(a.x, a.nx) <= greatest(b.x, b.nx) AND greatest(a.x, a.nx) >= least(b.x, b.nx)
             AND least(a.y, a.ny) <= greatest(b.y, b.ny) AND greatest(a.y, a.ny) >= least(b.y, b.ny)
            WHERE sign({_cross('a', 'a', 'b.x', 'b.y')}) * sign({_cross('a', 'a', 'b.nx', 'b.ny')}) <= 0
              AND sign({_cross('b', 'b', 'a.x', 'a.y')}) * sign({_cross('b', 'b', 'a.nx', 'a.ny')}) <= 0"""),
        "quantize_transform": _sql(
            BASE + TRANSFORM.format(q=1e9), "SELECT kx, ky, dx, dy FROM tf"),
        "junctions": _sql(TOPO, f"SELECT {_i('x', 'y', 'n_uses')} FROM junc"),
        "topology_arcs": _sql(
            TOPO, """SELECT arc_id::BIGINT AS arc_id, pts[1].x::BIGINT AS x_start,
              pts[1].y::BIGINT AS y_start, pts[-1].x::BIGINT AS x_end, pts[-1].y::BIGINT AS y_end,
              len(pts)::BIGINT AS n_points, round(length, 6) AS length
            FROM arc JOIN (SELECT arc_id, sum(sqrt(((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2))::DOUBLE)) AS length
              FROM ae GROUP BY arc_id) USING (arc_id)"""),
        "arc_lines": _sql(
            TOPO, f"""SELECT {_i('arc_id', 'pos', 'x', 'y')}, round(length, 6) AS length
            FROM av JOIN (SELECT arc_id, sum(sqrt(((x1-x2)*(x1-x2) + (y1-y2)*(y1-y2))::DOUBLE)) AS length
              FROM ae GROUP BY arc_id) USING (arc_id)"""),
        "ring_arcs": _sql(
            TOPO, f"""SELECT {_i('entity_id')}, source, gid, type, {_i('ring', 'pos', 'arc_id')}, reversed,
              (CASE WHEN reversed THEN -arc_id - 1 ELSE arc_id END)::BIGINT AS ref FROM ra"""),
        "terrain_arc_ids": _sql(
            TOPO, "SELECT DISTINCT arc_id::BIGINT AS arc_id FROM ra WHERE type <> 'pand'"),
        "neighbours": _sql(
            TOPO, """SELECT ent.entity_id::BIGINT AS entity_id, nei::BIGINT AS neighbour_id
            FROM ent LEFT JOIN (SELECT DISTINCT a.entity_id, b.entity_id AS nei FROM ra a JOIN ra b
              ON b.arc_id = a.arc_id AND b.entity_id <> a.entity_id) q
            ON q.entity_id = ent.entity_id"""),
        "border_arcs_by_type": _sql(
            TOPO, """SELECT DISTINCT a.arc_id::BIGINT AS arc_id, a.entity_id::BIGINT AS entity_a,
              b.entity_id::BIGINT AS entity_b FROM ra a JOIN ra b
            ON b.arc_id = a.arc_id AND a.type <> 'pand' AND b.type = 'pand'"""),
        "arc_bbox": _sql(
            TOPO, """SELECT arc_id::BIGINT AS arc_id, min(x)::BIGINT AS xmin, min(y)::BIGINT AS ymin,
              max(x)::BIGINT AS xmax, max(y)::BIGINT AS ymax FROM av GROUP BY arc_id"""),
        "arc_delta_encode": _sql(
            TOPO + TRANSFORM.format(q=Q), f"""SELECT {_i('arc_id', 'pos')},
              (qx - lag(qx, 1, 0) OVER o)::BIGINT AS dx, (qy - lag(qy, 1, 0) OVER o)::BIGINT AS dy
            FROM (SELECT arc_id, pos, floor((x - dx) / kx + 0.5)::BIGINT AS qx,
                floor((y - dy) / ky + 0.5)::BIGINT AS qy FROM av, tf)
            WINDOW o AS (PARTITION BY arc_id ORDER BY pos)"""),
        "arc_delta_decode": _sql(
            TOPO + TRANSFORM.format(q=Q), f"""SELECT {_i('arc_id', 'pos')},
              round(floor((x - dx) / kx + 0.5) * kx + dx, 6) AS x,
              round(floor((y - dy) / ky + 0.5) * ky + dy, 6) AS y FROM av, tf"""),
        "nearest_patch": _sql(near, f"SELECT {_i('x', 'y', 'patch_id')}, d2 FROM np"),
        "nearest_point_z": _sql(
            near, f"""SELECT {_i('np.x', 'np.y', 'np.patch_id')}, nz.b.d AS d2, nz.b.z::DOUBLE AS z
            FROM np LEFT JOIN nz ON nz.x = np.x AND nz.y = np.y AND nz.cls = 2"""),
        "nearest_points_k": _sql(
            near, f"""SELECT {_i('np.x', 'np.y', 'np.patch_id')}, count(z)::BIGINT AS n, max(d) AS d2,
              max(z)::DOUBLE AS z FROM np LEFT JOIN (
              SELECT np.x, np.y, p.z, ((np.x - p.x) * (np.x - p.x) + (np.y - p.y) * (np.y - p.y))::DOUBLE AS d
              FROM np JOIN p ON p.patch_id = np.patch_id AND p.classification = 2
              QUALIFY row_number() OVER (PARTITION BY np.x, np.y ORDER BY d, z) <= 5) q
            ON q.x = np.x AND q.y = np.y GROUP BY np.x, np.y, np.patch_id"""),
        "terrain_arcs_z": _sql(near + HEIGHTS, f"SELECT {_i('arc_id', 'pos', 'x', 'y')}, z FROM tz"),
        "building_arcs_z": _sql(
            near, f"""SELECT {_i('arc_id', 'pos', 'av.x', 'av.y')}, coalesce(nz.b.z::DOUBLE, 0) AS z
            FROM av LEFT JOIN nz ON nz.x = av.x AND nz.y = av.y AND nz.cls = 6
            WHERE arc_id IN (SELECT arc_id FROM ra WHERE type = 'pand')"""),
        "arcs_collect": _sql(
            near + HEIGHTS, """SELECT arc_id::BIGINT AS arc_id, count(*) AS n_points,
              arg_min(z, pos) AS z_first, arg_max(z, pos) AS z_last, sum(z) AS z_sum
            FROM tz GROUP BY arc_id"""),
        "arcs_update": _sql(
            near + HEIGHTS, f"""SELECT {_i('av.arc_id', 'av.pos', 'av.x', 'av.y')}, tz.z AS z
            FROM av LEFT JOIN tz ON tz.arc_id = av.arc_id AND tz.pos = av.pos"""),
        "arc_z_from_patches": _sql(
            BASE + POINTS + PLAIN + EDGES + TOPOLOGY + ARC_PATCH, f"""
            SELECT {_i('arc_id', 'pos', 'x', 'y')}, b.z::DOUBLE AS z FROM (
              SELECT av.arc_id, av.pos, av.x, av.y, min({{'d':
                (av.x - p.x) * (av.x - p.x) + (av.y - p.y) * (av.y - p.y), 'z': p.z}}) AS b
              FROM av JOIN ap ON ap.arc_id = av.arc_id
              JOIN p ON p.patch_id = ap.patch_id AND p.classification = 2
              GROUP BY av.arc_id, av.pos, av.x, av.y)"""),
        "arc_ground_points": _sql(
            BASE + POINTS + PLAIN + EDGES + TOPOLOGY + ARC_PATCH, """
            SELECT arc_id::BIGINT AS arc_id, count(*)::BIGINT AS n_points, min(z)::BIGINT AS min_z,
              max(z)::BIGINT AS max_z
            FROM ap JOIN p ON p.patch_id = ap.patch_id AND p.classification = 2 GROUP BY arc_id"""),
        "raised_arcs": _sql(
            raised, f"""SELECT new_id::BIGINT AS arc_id, rn.arc_id::BIGINT AS source_arc_id,
              {_i('av.pos', 'x', 'y')}, round(coalesce(rz.z, 0), 6) AS z
            FROM rn JOIN av ON av.arc_id = rn.arc_id LEFT JOIN rz ON rz.entity_id = rn.entity_id"""),
        "raised_ring_arcs": _sql(
            raised, f"SELECT {_i('entity_id', 'gid', 'ring', 'pos', 'arc_id')}, reversed FROM ru"),
        "rings": _sql(
            TOPO + RING_LINES, f"SELECT {_i('entity_id', 'ring', 'pos', 'x', 'y')} FROM rv"),
        "topology_features": _sql(
            TOPO + RING_LINES, f"""SELECT {_i('entity_id')}, source, gid, type,
              {_i('ring', 'pos', 'x', 'y')} FROM rc JOIN ent USING (entity_id)"""),
        "outer_rings_geojson": _sql(
            TOPO + RING_LINES, f"""SELECT {_i('entity_id', 'gid', 'ring', 'pos')},
              x::DOUBLE AS x, y::DOUBLE AS y
            FROM rv JOIN ent USING (entity_id) WHERE ring = 0"""),
        "polygons3d": _sql(
            solid, f"""SELECT {_i('entity_id')}, source, {_i('gid', 'ring', 'pos', 'x', 'y')},
              round(z, 6) AS z FROM sv"""),
        "polygon_vertices": _sql(
            solid, f"""SELECT {_i('gid', 'x', 'y')}, round(z, 6) AS z FROM sv
            UNION ALL SELECT {_i('gid', 'x', 'y')}, round(z, 6) AS z FROM sv WHERE pos = 0"""),
        "features_geojson": _sql(
            plain_edges + closed, f"""SELECT source, gid, type, 0::BIGINT AS part,
              {_i('ring', 'pos')}, x::DOUBLE AS x, y::DOUBLE AS y FROM closed"""),
        "topology_rows": _sql(
            QTOPO, """
            SELECT 'arc' AS kind, arc_id::BIGINT AS id, '[' || string_agg('[' || dx || ',' || dy || ']',
              ',' ORDER BY pos) || ']' AS data
            FROM (SELECT arc_id, pos, x - lag(x, 1, 0) OVER o AS dx, y - lag(y, 1, 0) OVER o AS dy
              FROM av WINDOW o AS (PARTITION BY arc_id ORDER BY pos)) GROUP BY arc_id
            UNION ALL
            SELECT 'entity', entity_id, '{"type":"Polygon","arcs":[' || string_agg(l, ',' ORDER BY ring)
              || '],"properties":{"gid":' || any_value(gid) || ',"type":"' || any_value(type) || '"}}'
            FROM (SELECT entity_id, any_value(gid) AS gid, any_value(type) AS type, ring,
                '[' || string_agg(CASE WHEN reversed THEN -arc_id - 1 ELSE arc_id END, ',' ORDER BY pos)
                || ']' AS l FROM ra GROUP BY entity_id, ring) GROUP BY entity_id
            UNION ALL
            SELECT 'neighbours', ent.entity_id, '[' || coalesce(l, '') || ']' FROM ent LEFT JOIN (
              SELECT entity_id, string_agg(nei, ',' ORDER BY nei) AS l FROM (
                SELECT DISTINCT a.entity_id, b.entity_id AS nei FROM ra a JOIN ra b
                  ON b.arc_id = a.arc_id AND b.entity_id <> a.entity_id) GROUP BY entity_id) q
              ON q.entity_id = ent.entity_id
            UNION ALL
            SELECT 'transform', 1, '{"scale":[' || kx || ',' || ky || '],"translate":[' || dx || ','
              || dy || ']}' FROM tf"""),
        "topology_loaded": _sql(
            QTOPO + RING_LINES, f"""SELECT {_i('entity_id')}, source, gid, type, {_i('ring', 'pos')},
              round(x * kx + dx, 6) AS x, round(y * ky + dy, 6) AS y FROM rv JOIN ent USING (entity_id), tf"""),
        "topology_problems": _sql(
            raised, """SELECT kind, reason, count(*) AS n, sum(id)::BIGINT AS ids FROM (
              SELECT DISTINCT 'entity' AS kind, entity_id::BIGINT AS id, 'no arc ' || arc_id AS reason
              FROM ru WHERE arc_id % 50 = 7 OR arc_id % 70 = 9
              UNION ALL SELECT 'arc', id, 'not an array of two points or more'
              FROM range((SELECT count(*) FROM arc) + (SELECT count(*) FROM rn)) r(id)
              WHERE id % 70 = 9 AND id % 50 <> 7) GROUP BY kind, reason"""),
        "topology_rows_raised": _sql(
            solid, f"""SELECT {_i('av.arc_id', 'av.pos', 'av.x', 'av.y')}, round(tz.z, 6) AS z
            FROM av LEFT JOIN tz ON tz.arc_id = av.arc_id AND tz.pos = av.pos
            UNION ALL SELECT new_id, av.pos, x, y, round(coalesce(rz.z, 0), 6)
            FROM rn JOIN av ON av.arc_id = rn.arc_id LEFT JOIN rz ON rz.entity_id = rn.entity_id"""),
        "solids_loaded": _sql(
            solid, f"""SELECT {_i('entity_id')}, source, {_i('gid', 'ring', 'pos', 'x', 'y')},
              round(z, 6) AS z FROM sv"""),
        "arcs_update_twice": _sql(
            near + HEIGHTS, f"""SELECT {_i('av.arc_id', 'av.pos', 'av.x', 'av.y')},
              CASE WHEN av.arc_id IN (SELECT arc_id FROM ra WHERE type = 'pand')
                THEN coalesce(nz.b.z::DOUBLE, 0) ELSE tz.z END AS z
            FROM av LEFT JOIN tz ON tz.arc_id = av.arc_id AND tz.pos = av.pos
            LEFT JOIN nz ON nz.x = av.x AND nz.y = av.y AND nz.cls = 6"""),
        "dissolve_boundary": _sql(
            TOPO + BOUNDARY, """SELECT type, count(*) AS n_arcs, sum(n_edges)::BIGINT AS n_vertices,
              round(sum(l), 6) AS length,
              sum(CASE WHEN backward THEN -a2 ELSE a2 END)::BIGINT AS double_area
            FROM bd JOIN am USING (arc_id) GROUP BY type"""),
        "dissolve": _sql(
            TOPO + BOUNDARY + STITCH, """SELECT bd.type, ring::BIGINT AS ring, count(*) AS n_arcs,
              sum(n_edges)::BIGINT AS n_vertices,
              sum(CASE WHEN backward THEN -a2 ELSE a2 END)::BIGINT AS double_area
            FROM bd JOIN nm ON nm.type = bd.type AND nm.arc_id = bd.arc_id
            JOIN am ON am.arc_id = bd.arc_id GROUP BY bd.type, ring"""),
        "dissolve_polygons": _dissolve_polygons_sql(),
        "vertex_effective_area": _sql(
            TOPO, f"""SELECT {_i('arc_id', 'pos')}, area::DOUBLE AS area FROM (
              SELECT arc_id, pos, abs((lag(x) OVER o - lead(x) OVER o) * (y - lag(y) OVER o)
                - (lag(x) OVER o - x) * (lead(y) OVER o - lag(y) OVER o)) / 2 AS area
              FROM av WINDOW o AS (PARTITION BY arc_id ORDER BY pos)) WHERE area IS NOT NULL"""),
        "simplify_arcs": _sql(
            TOPO + SIMPLIFY, f"""SELECT arc_id::BIGINT AS arc_id,
              row_number() OVER (PARTITION BY arc_id ORDER BY pos) - 1 AS pos,
              x::BIGINT AS x, y::BIGINT AS y
            FROM av LEFT JOIN (SELECT arc_id, gone AS pos, w FROM sim WHERE gone IS NOT NULL) q
              USING (arc_id, pos)
            WHERE w IS NULL OR w >= {SIMPLIFY_AREA}"""),
        "simplify_rings": _sql(
            TOPO + SIMPLIFY + WEIGHT, f"""SELECT {_i('arc_id')},
              row_number() OVER (PARTITION BY arc_id ORDER BY pos) - 1 AS pos, {_i('x', 'y')}
            FROM weight WHERE kept OR (arc_id, pos) IN (SELECT (arc_id, pos) FROM guard)"""),
        "rejected_features": _sql(
            plain_edges, """SELECT CASE gid % 11 WHEN 1 THEN 'not a JSON object with a type'
              WHEN 2 THEN 'not a Feature but a Topology' WHEN 3 THEN 'not a polygon but a LineString'
              WHEN 4 THEN 'coordinates are not rings of numbers' WHEN 5 THEN 'no geometry'
              WHEN 6 THEN 'a ring is not closed or has fewer than three points'
              WHEN 7 THEN 'not a JSON object with a type' ELSE 'read' END AS reason,
              count(*) AS n, coalesce(sum(gid) FILTER (gid % 11 NOT IN (1, 7)), 0)::BIGINT AS gids FROM ent GROUP BY reason"""),
        "dropped_rings": _sql(
            BASE + TRANSFORM.format(q=COARSE) + QUANTISED + EDGES, """SELECT source, gid, ring::BIGINT AS ring,
              count(*) AS n_vertices, count(*) FILTER (x <> px OR y <> py) AS n_left
            FROM nb GROUP BY source, gid, ring HAVING count(*) FILTER (x <> px OR y <> py) < 3"""),
        "neighbour_counts": _sql(
            BASE.replace("v AS (", "v0 AS (") + """
            v AS (SELECT * FROM v0 UNION ALL SELECT source, gid + 5000000, type, ring, pos, x, y FROM v0
              WHERE gid % 5 = 0),""" + PLAIN + EDGES + TOPOLOGY,
            """SELECT ent.entity_id::BIGINT AS entity_id, count(nei) AS n_neighbours
            FROM ent LEFT JOIN (SELECT DISTINCT a.entity_id, b.entity_id AS nei FROM ra a JOIN ra b
              ON b.arc_id = a.arc_id AND b.entity_id <> a.entity_id) q
            ON q.entity_id = ent.entity_id GROUP BY ent.entity_id"""),
        "shared_walls": _sql(
            plain_edges, """SELECT a.gid AS parcel, b.gid AS building, a.x::BIGINT AS x1,
              a.y::BIGINT AS y1, a.nx::BIGINT AS x2, a.ny::BIGINT AS y2
            FROM nb a JOIN nb b ON a.source = 'parcel' AND b.source = 'pand'
             AND ((a.x = b.nx AND a.y = b.ny AND a.nx = b.x AND a.ny = b.y)
               OR (a.x = b.x AND a.y = b.y AND a.nx = b.nx AND a.ny = b.ny))"""),
        "shared_walls_metres": _sql(
            plain_edges, """SELECT a.gid AS parcel, b.gid AS building, 2 * count(*) AS n,
              round(sum(sqrt(((a.nx - a.x) * (a.nx - a.x) + (a.ny - a.y) * (a.ny - a.y))::DOUBLE)) / 100, 2) AS length
            FROM nb a JOIN nb b ON a.source = 'parcel' AND b.source = 'pand'
             AND ((a.x = b.nx AND a.y = b.ny AND a.nx = b.x AND a.ny = b.y)
               OR (a.x = b.x AND a.y = b.y AND a.nx = b.nx AND a.ny = b.ny)) GROUP BY a.gid, b.gid"""),
        "wall_segments": _sql(
            TOPO + WALLS,
            f"SELECT {_i('arc_id', 'entity_a', 'entity_b', 'pos', 'x1', 'y1', 'x2', 'y2')} FROM ws"),
        "inset_rings": _sql(
            plain_edges + OFFSET, f"""SELECT source, gid, {_i('ring', 'pos')}, round(x, 6) AS x,
              round(y, 6) AS y FROM inset"""),
        "closest_on_boundary": _sql(
            TOPO + WALLS + OFFSET + CLOSEST, f"""SELECT {_i('arc_id', 'pos', 'entity_b')},
              round(near_x1, 6) AS near_x1, round(near_y1, 6) AS near_y1,
              round(near_x2, 6) AS near_x2, round(near_y2, 6) AS near_y2 FROM cb"""),
        "wall_quads": _sql(
            TOPO + WALLS + OFFSET + CLOSEST, f"""
            SELECT {_i('arc_id', 'pos', 'entity_b', 'corner')}, round(x, 6) AS x, round(y, 6) AS y FROM (
              SELECT arc_id, pos, entity_b, unnest([0, 1, 2, 3, 4]) AS corner,
                unnest([near_x2, near_x1, x1, x2, near_x2]) AS x,
                unnest([near_y2, near_y1, y1, y2, near_y2]) AS y
              FROM cb JOIN ws USING (arc_id, pos, entity_b))"""),
        # a full triangulation has vertices + 2 * holes - 2 triangles and the polygon's area
        "polygon_mesh": _sql(
            plain_edges, """SELECT entity_id::BIGINT AS entity_id,
              (count(*) + 2 * max(ring) - 2)::BIGINT AS n_triangles,
              abs(sum(x * ny - nx * y))::BIGINT AS double_area
            FROM nb GROUP BY entity_id"""),
        "mesh_quality": _sql(
            plain_edges, """SELECT entity_id::BIGINT AS entity_id,
              (count(*) + 2 * max(ring) - 2)::BIGINT AS n_triangles, true AS all_empty, true AS all_carried
            FROM nb GROUP BY entity_id"""),
    }


def _dissolve_polygons_sql() -> str:
    """Unions as sets of unit squares: connected ones are a polygon, the Euler number counts holes."""
    return """
    WITH RECURSIVE cell AS (
      SELECT p_partkey AS k, p_partkey % 50 AS c, CAST(floor(p_partkey / 50) AS BIGINT) AS r FROM part),
    zone AS (SELECT *, 'zone ' || ((c // 3 + r // 2) % 3) AS type FROM cell),
    boxes AS (
      SELECT type, 4 * c AS x, 4 * r AS y, 4 AS w, 4 AS h FROM zone WHERE k % 13 <> 0 OR k % 5 = 0
      UNION ALL SELECT type, 4 * c + 2, 4 * r + 1, 1, 2 FROM zone WHERE k % 7 = 0
      UNION ALL SELECT type, 4 * c + 1, 4 * r, 4, 4 FROM zone WHERE k % 11 = 0),
    unit AS MATERIALIZED (
      SELECT DISTINCT type, x + i AS x, y + j AS y FROM boxes, range(4) a(i), range(4) b(j)
      WHERE i < w AND j < h),
    starts AS (SELECT *, CASE WHEN lag(x) OVER o = x - 1 THEN 0 ELSE 1 END AS s
      FROM unit WINDOW o AS (PARTITION BY type, y ORDER BY x)),
    named AS MATERIALIZED (SELECT type, x, y, sum(s) OVER (PARTITION BY type, y ORDER BY x) AS run FROM starts),
    runs AS MATERIALIZED (SELECT type, y, run, min(x) AS x0, max(x) AS x1,
      row_number() OVER (ORDER BY type, y, run) AS id FROM named GROUP BY type, y, run),
    beside AS MATERIALIZED (SELECT a.id AS a, b.id AS b FROM runs a JOIN runs b
      ON a.type = b.type AND abs(a.y - b.y) = 1 AND a.x0 <= b.x1 AND b.x0 <= a.x1),
    reach AS (SELECT id AS a, id AS b FROM runs
      UNION SELECT r.a, e.b FROM reach r JOIN beside e ON e.a = r.b),
    piece AS (SELECT a AS id, min(b) AS p FROM reach GROUP BY a),
    u AS MATERIALIZED (SELECT p, x, y FROM named n JOIN runs r USING (type, y, run) JOIN piece USING (id)),
    inner_edges AS (SELECT a.p, count(*) AS n FROM u a JOIN u b
      ON a.p = b.p AND (b.x = a.x + 1 AND b.y = a.y OR b.x = a.x AND b.y = a.y + 1) GROUP BY a.p),
    inner_corners AS (SELECT a.p, count(*) AS n FROM u a JOIN u b ON a.p = b.p AND b.x = a.x + 1 AND b.y = a.y
      JOIN u c ON a.p = c.p AND c.x = a.x AND c.y = a.y + 1
      JOIN u d ON a.p = d.p AND d.x = a.x + 1 AND d.y = a.y + 1 GROUP BY a.p),
    sizes AS (SELECT p, count(*) AS n, min(x) AS x, min(y) AS y FROM u GROUP BY p)
    SELECT (SELECT type FROM runs WHERE id = p) AS type, (2 * 62500 * s.n)::BIGINT AS double_area,
      (1 - (s.n - coalesce(e.n, 0) + coalesce(c.n, 0)))::BIGINT AS n_holes,
      (250 * s.x)::BIGINT AS xmin, (250 * s.y)::BIGINT AS ymin
    FROM sizes s LEFT JOIN inner_edges e USING (p) LEFT JOIN inner_corners c USING (p)
    """
