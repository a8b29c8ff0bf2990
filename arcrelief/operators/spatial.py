"""Spatial joins between polygons, arcs, points and patches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import grid
from ..functions.fragments import Fragments, fragments

KEYS = ["source", "gid"]


def points_in_polygons(
    points: DataFrame, features: DataFrame, keys: list[str] = KEYS, erosion: float = 0
) -> DataFrame:
    """Points (x, y, any other columns) joined to every polygon that contains them.

    Borders count as inside.  With ``erosion`` a point must instead lie at least that far
    from the border, which stands for shrinking the polygon first.
    """
    return _points_in(points, fragments(features, keys, halo=erosion), keys, erosion)


def _points_in(
    points: DataFrame, cut: Fragments, keys: list[str], erosion: float = 0
) -> DataFrame:
    hits = (
        grid.on_levels(points, cut.levels)
        .join(cut.on_cells().hint(*grid.SPREAD), ["level", "cx", "cy"])
        .filter("x BETWEEN f_xmin AND f_xmax AND y BETWEEN f_ymin AND f_ymax")
        .selectExpr(
            *points.columns, *keys, "base", "pieces",
            f"{g.crossings('edges', 'x', 'y', 'ref_x', 'ref_y')} AS _n",
            f"{g.min_edge_dist2('edges', 'x', 'y')} AS _d2",
        )
    )

    def accepted(crossed: str) -> str:
        # without an edge in reach of the cell the distance is NULL: far enough
        inside = f"({crossed} + base) % 2 = 1"
        if erosion:
            return f"{inside} AND coalesce(_d2, double('inf')) >= {float(erosion) ** 2}D"
        return f"{inside} OR coalesce(_d2, 1) = 0"

    out = [*points.columns, *keys]
    whole = hits.filter(f"pieces = 1 AND ({accepted('_n')})").select(*out)
    if not cut.in_pieces:
        return whole
    # add up the pieces per point; equal points are counted and spread out again
    pieced = (
        hits.filter("pieces > 1")
        .groupBy(*out, "base", "pieces")
        .agg(F.expr("sum(_n) AS _n"), F.expr("min(_d2) AS _d2"), F.expr("count(*) AS _rows"))
        .selectExpr("*", "int(_rows div pieces) AS _copies")
        .filter(accepted("_n div _copies"))
        .selectExpr("*", "explode_outer(sequence(1, _copies)) AS _copy")
        .select(*out)
    )
    return whole.unionByName(pieced)


def polygons_meeting_boxes(
    features: DataFrame, boxes: DataFrame, box_id: str, keys: list[str] = KEYS
) -> DataFrame:
    """Distinct (polygon, box) pairs that share a point."""
    cut = fragments(features, keys)
    b = g.box("r_")
    # if no edge meets the box it is all inside or all outside: one point decides
    x, y = "greatest(xmin, r_xmin)", "greatest(ymin, r_ymin)"
    extents = grid.extent_pairs(
        cut.rows.drop("level"), boxes.select(box_id, *g.SIDES), left_levels=cut.levels
    )
    pairs = extents.selectExpr(
        *keys, box_id, "xmin", "ymin", "base", "pieces",
        f"exists(edges, e -> {g.edge_meets_box('e', b)}) AS _touch",
        f"{g.crossings('edges', x, y, 'ref_x', 'ref_y')} AS _n",
    )
    out = [*keys, box_id]
    whole = pairs.filter("pieces = 1 AND (_touch OR (_n + base) % 2 = 1)").select(*out)
    if cut.in_pieces:
        pieced = (
            pairs.filter("pieces > 1")
            .groupBy(*out, "xmin", "ymin", "base")
            .agg(F.expr("max(_touch) AS _touch"), F.expr("sum(_n) AS _n"))
            .filter("_touch OR (_n + base) % 2 = 1")
            .select(*out)
        )
        whole = whole.unionByName(pieced)
    return whole.distinct()


def polygon_pairs(
    left: DataFrame, right: DataFrame, left_keys: list[str], right_keys: list[str]
) -> DataFrame:
    """Distinct pairs of polygons that share a point (borders included).

    Either two edges meet, or no edge does and one polygon lies inside the other.  Key
    names of the two sides must differ.
    """
    a, b = fragments(left, left_keys), fragments(right, right_keys)
    out = [*left_keys, *right_keys]
    borders = grid.extent_pairs(
        a.rows.select(*left_keys, *g.SIDES, "edges"),
        b.rows.select(*right_keys, *g.SIDES, F.col("edges").alias("r_edges")),
        a.levels, b.levels,
    ).filter(f"exists(edges, p -> exists(r_edges, q -> {g.edges_meet('p', 'q')}))")
    return (
        borders.select(*out)
        .unionByName(_points_in(_first_vertices(left, left_keys), b, right_keys).select(*out))
        .unionByName(_points_in(_first_vertices(right, right_keys), a, left_keys).select(*out))
        .distinct()
    )


def _first_vertices(features: DataFrame, keys: list[str]) -> DataFrame:
    return features.selectExpr(*keys, "rings[0][0].x AS x", "rings[0][0].y AS y")


def arcs_meeting_boxes(arcs: DataFrame, boxes: DataFrame, box_id: str) -> DataFrame:
    """Distinct (arc, box) pairs that share a point; ``arcs`` has arc_id and points."""
    edges = arcs.selectExpr("arc_id", f"explode_outer({g.path_edges('points')}) AS e").selectExpr(
        "*", *g.edge_bbox("e")
    )
    return (
        grid.extent_pairs(edges, boxes.select(box_id, *g.SIDES))
        .filter(g.edge_meets_box("e", g.box("r_")))
        .select("arc_id", box_id)
        .distinct()
    )


def patches_of(points: DataFrame) -> DataFrame:
    """Extent and counts per patch; map-side combined, so a big patch is no bottleneck."""
    return points.groupBy("patch_id").agg(
        F.min("x").alias("xmin"), F.min("y").alias("ymin"),
        F.max("x").alias("xmax"), F.max("y").alias("ymax"),
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("classification") == 2).alias("n_ground"),
        F.count_if(F.col("classification") == 6).alias("n_roof"),
    )


def in_box(features: DataFrame, bounds: tuple) -> DataFrame:
    """Whole features that share a point with a constant box (nothing is cut)."""
    b = g.constant_box(bounds)
    meets = f"exists({g.polygon_edges('rings')}, e -> {g.edge_meets_box('e', b)})"
    # no edge meets the box: all corners agree, so one of them decides
    inside = g.crossings(g.polygon_edges("rings"), b["xmin"], b["ymin"], "_xmin - 1", "_ymin - 1")
    return (
        features.selectExpr("*", "flatten(rings) AS _v")
        .selectExpr(*features.columns, *g.bbox("_v", "_"))
        .filter(g.boxes_overlap(g.box("_"), b))
        .filter(f"{meets} OR {inside} % 2 = 1")
        .select(*features.columns)
    )


def patches_inside(patches: DataFrame, bounds: tuple) -> DataFrame:
    """Patches wholly inside a constant box and not merely on its border."""
    b = g.constant_box(bounds)
    within = " AND ".join(
        [f"{a}min >= {b[a + 'min']} AND {a}max <= {b[a + 'max']}" for a in "xy"]
    )
    on_border = " OR ".join(
        [f"{a}max = {b[a + 'min']} OR {a}min = {b[a + 'max']}" for a in "xy"]
    )
    return patches.filter(f"{within} AND NOT ({on_border})")
