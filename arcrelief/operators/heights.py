"""Heights from the point cloud for arcs and buildings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import grid
from ..functions.ids import with_dense_id
from ..session import materialise
from .knn import NEAREST, nearest_k
from .nearest import BEST, TO_POINT, nearest, nearest_in_group
from .spatial import arcs_meeting_boxes, patches_of, points_in_polygons
from .topology import Topology, arc_ids_of, real_arcs, real_entities

GROUND, ROOF = 2, 6


def points_by_class(points: DataFrame, classification: int) -> DataFrame:
    return points.filter(F.col("classification") == classification)


def arc_vertices(arcs: DataFrame) -> DataFrame:
    """One row per arc vertex: arc_id, pos, x, y (and z when the points have one)."""
    return arcs.selectExpr("arc_id", "posexplode_outer(points) AS (pos, p)").selectExpr(
        "arc_id", "pos", "p.*"
    )


def collect_arcs(vertices: DataFrame) -> DataFrame:
    """Vertices back to one array per arc, in vertex order."""
    return vertices.groupBy("arc_id").agg(
        F.expr(
            "transform(array_sort(collect_list(struct(pos, x, y, z))),"
            " v -> named_struct('x', v.x, 'y', v.y, 'z', v.z)) AS points"
        )
    )


def nearest_patch(positions: DataFrame, patches: DataFrame, cell: float | None = None) -> DataFrame:
    """Adds patch_id (and d2 to its extent) of the nearest patch to distinct positions (x, y).

    The cell side defaults to the median patch extent.
    """
    if cell is None:
        row = grid.summary(
            patches, "percentile_approx(double(greatest(xmax - xmin, ymax - ymin)), 0.5) AS m"
        )
        cell = row.m or 1.0
    best = nearest(positions.select("x", "y"), patches, float(cell), ("patch_id",))
    return best.selectExpr("x", "y", f"{BEST}.patch_id AS patch_id", f"{BEST}.d2 AS d2")


def of_patches(points: DataFrame, patches: DataFrame) -> DataFrame:
    """Points of the given patches only; a semi join, so patches may repeat."""
    return points.join(patches.select("patch_id").distinct(), "patch_id", "left_semi")


def near_features(points: DataFrame, features: DataFrame, patches: DataFrame | None) -> DataFrame:
    """Points of the patches whose extent meets that of a feature; all points without ``patches``.

    ``patches`` is the stored table of extents, so the cloud itself is read once, and of a
    stored cloud only the chosen patches' rows go on.
    """
    if patches is None:
        return points
    boxes = features.selectExpr("flatten(rings) AS _v").selectExpr(*g.bbox("_v"))
    met = grid.extent_pairs(boxes, patches.select("patch_id", *g.SIDES))
    return of_patches(points, met)


def nearest_point_z(placed: DataFrame, points: DataFrame, patches: DataFrame) -> DataFrame:
    """Nearest given point of the same patch for rows (x, y, patch_id, ...): adds d2 and z.

    Rows must be distinct.  Only points of patches that some row has chosen are looked at.
    Equal distances take the lowest z; both are NULL when the patch has none of the points.
    Large patches are searched cell by cell, so the size of a patch does not matter.
    """
    chosen = placed.select("patch_id").distinct()
    targets = of_patches(points, chosen).selectExpr(
        "patch_id", "x AS xmin", "y AS ymin", "x AS xmax", "y AS ymax", "z"
    )
    sizes = of_patches(patches, chosen)
    best = nearest_in_group(placed, targets, sizes, ("patch_id",), ("z",), TO_POINT)
    return best.selectExpr(*placed.columns, f"{BEST}.d2 AS d2", f"{BEST}.z AS z")


def highest_of_nearest(placed: DataFrame, points: DataFrame, k: int) -> DataFrame:
    """Greatest z among the ``k`` nearest given points of the same patch, for rows (x, y, patch_id, ...).

    Adds n (points found, up to k), d2 (of the farthest of them) and z.  Rows must be distinct;
    equal distances take the lowest z first.
    """
    targets = of_patches(points, placed).selectExpr(
        "patch_id", "x AS xmin", "y AS ymin", "x AS xmax", "y AS ymax", "z")
    found = nearest_k(placed, targets, k, ("z",), ("patch_id",), TO_POINT)
    return found.selectExpr(
        *placed.columns, f"size({NEAREST}) AS n", f"get({NEAREST}, size({NEAREST}) - 1).d2 AS d2",
        f"array_max(transform({NEAREST}, t -> t.z)) AS z")


def arc_heights(
    topology: Topology,
    points: DataFrame,
    types: str,
    classification: int,
    require_class: bool = False,
    patches: DataFrame | None = None,
) -> DataFrame:
    """Heights for all vertices of the arcs of some entities: arc_id, pos, x, y, z.

    Every vertex takes the z of the nearest point of the class within its nearest patch.
    The patch is chosen first, so a patch without such a point gives z = 0;
    ``require_class`` chooses among patches that have one.  x and y are real coordinates.
    ``patches`` may be the stored extents of all patches, which saves a scan of the points.
    """
    wanted = points_by_class(points, classification)
    if patches is None or require_class:
        patches = materialise(patches_of(wanted if require_class else points))
    ids = arc_ids_of(topology.ring_arcs, types)
    vertices = arc_vertices(real_arcs(topology).join(ids, "arc_id", "left_semi"))
    placed = materialise(nearest_patch(vertices.select("x", "y").distinct(), patches).drop("d2"))
    heights = nearest_point_z(placed, wanted, patches).select("x", "y", "z")
    return vertices.join(heights, ["x", "y"], "left").selectExpr(
        "arc_id", "pos", "x", "y", "coalesce(double(z), 0.0D) AS z"
    )


def arc_heights_from_patches(
    arcs: DataFrame, points: DataFrame, classification: int, patches: DataFrame | None = None
) -> DataFrame:
    """Heights from all patches an arc meets: arc_id, pos, x, y, z.

    Arcs that meet no patch, or only patches without a point of the class, are left out.
    """
    patches = materialise(patches_of(points)) if patches is None else patches
    pairs = arcs_meeting_boxes(arcs, patches, "patch_id")
    wanted = points_by_class(points, classification)
    # a vertex needs no patch that begins farther away than another one with points must end
    counted = {GROUND: "n_ground", ROOF: "n_roof"}.get(classification)
    if counted is None:
        sizes = wanted.groupBy("patch_id").agg(F.count(F.lit(1)).alias("n_class"))
        extents = patches.join(sizes, "patch_id")
    else:
        extents = patches.withColumnRenamed(counted, "n_class").filter("n_class > 0")
    mine = Window.partitionBy("arc_id", "pos")
    vertices = arc_vertices(arcs)
    reached = (
        vertices.join(pairs, "arc_id").join(extents.select("patch_id", *g.SIDES), "patch_id")
        .withColumn("bound", F.min(F.expr(g.box_far2("x", "y", g.box()))).over(mine))
        .filter(f"{g.box_dist2('x', 'y', g.box())} <= bound")
    )
    # nearest point per vertex and patch first, then the best patch of each vertex
    placed = materialise(reached.select(*vertices.columns, "patch_id"))
    return (
        nearest_point_z(placed, wanted, patches)
        .filter("d2 IS NOT NULL")
        .groupBy("arc_id", "pos", "x", "y")
        .agg(F.expr("double(min(named_struct('d2', d2, 'z', z)).z) AS z"))
    )


def arc_ground_points(
    arcs: DataFrame, points: DataFrame, classification: int, patches: DataFrame | None = None
) -> DataFrame:
    """Number and height range of the points of a class in the patches an arc meets.

    Points are counted per patch first, so only one row per (arc, patch) is joined.
    """
    patches = materialise(patches_of(points)) if patches is None else patches
    pairs = materialise(arcs_meeting_boxes(arcs, patches, "patch_id"))
    per_patch = materialise(
        of_patches(points_by_class(points, classification), pairs)
        .groupBy("patch_id")
        .agg(F.expr("count(*) AS n"), F.expr("min(z) AS low"), F.expr("max(z) AS high"))
    )
    return (
        pairs.join(per_patch, "patch_id")
        .groupBy("arc_id")
        .agg(
            F.expr("sum(n) AS n_points"), F.expr("min(low) AS min_z"), F.expr("max(high) AS max_z")
        )
    )


def update_arcs(arcs: DataFrame, heights: DataFrame) -> DataFrame:
    """Arcs with 3D points where new heights exist; the others keep theirs (NULL if they have none)."""
    new = collect_arcs(heights).withColumnRenamed("points", "new_points")
    has_z = "z" in arcs.schema["points"].dataType.elementType.names
    z = "double(p.z)" if has_z else "CAST(NULL AS DOUBLE)"
    kept = f"transform(points, p -> named_struct('x', p.x, 'y', p.y, 'z', {z}))"
    return arcs.join(new, "arc_id", "left").selectExpr(
        "arc_id", f"coalesce(new_points, {kept}) AS points"
    )


def roof_points(
    points: DataFrame, features: DataFrame, erosion: float, patches: DataFrame | None = None
) -> DataFrame:
    """Roof points inside buildings, at least ``erosion`` from their border."""
    near = near_features(points_by_class(points, ROOF), features, patches)
    return points_in_polygons(near, features, erosion=erosion)


def roof_height(
    points: DataFrame, features: DataFrame, erosion: float, keys: tuple[str, ...] = ("source", "gid"),
    patches: DataFrame | None = None,
) -> DataFrame:
    """Mean roof height per building; 0 with has_roof = false when it has no roof point.

    Equal positions are added up before the spatial join, so copies cost one row, and each
    counts once for a building, also on the border between two of its parts.
    """
    summed = (
        near_features(points_by_class(points, ROOF), features, patches)
        .groupBy("x", "y")
        .agg(F.expr("sum(z) AS sum_z"), F.expr("count(*) AS n"))
    )
    inside = points_in_polygons(summed, features, list(keys), erosion=erosion).distinct()
    means = inside.groupBy(*keys).agg(F.expr("sum(sum_z) / sum(n) AS z"), F.expr("sum(n) AS n"))
    # the parts of a multi-part building are one building
    return features.select(*keys).distinct().join(means, list(keys), "left").selectExpr(
        *keys, "coalesce(z, 0.0D) AS z", "coalesce(n, 0L) AS n_points", "n IS NOT NULL AS has_roof"
    )


def raise_entities(
    topology: Topology, points: DataFrame, types: str, erosion: float, patches: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Lifts entities to their mean roof height on copies of their arcs.

    Returns (raised_arcs, ring_arcs).  Every arc use of such an entity gets a flat copy at
    its height (arc_id, source_arc_id, entity_id, z, points); the copies are numbered after
    the existing arcs by entity, ring and position.  ``ring_arcs`` is the whole table with
    the uses of these entities pointing to the copies, direction kept; all other uses still
    point to the original arcs.  Points are in real coordinates.
    """
    chosen = real_entities(topology).filter(types)
    heights = roof_height(points, chosen, erosion, ("entity_id",), patches).select("entity_id", "z")
    first = topology.arcs.agg(F.max("arc_id")).first()[0]
    uses = topology.ring_arcs.filter(types)
    numbered = with_dense_id(
        uses.withColumnRenamed("arc_id", "source_arc_id"), ["entity_id", "ring", "pos"],
        "arc_id", start=(-1 if first is None else first) + 1,
    )
    raised = (
        numbered.join(heights, "entity_id")
        .join(real_arcs(topology).withColumnRenamed("arc_id", "source_arc_id"), "source_arc_id")
        .selectExpr(
            "arc_id", "source_arc_id", "entity_id", "z",
            "transform(points, p -> named_struct('x', p.x, 'y', p.y, 'z', z)) AS points",
        )
    )
    others = topology.ring_arcs.filter(f"NOT coalesce({types}, false)")
    return raised, others.unionByName(numbered.drop("source_arc_id"))
