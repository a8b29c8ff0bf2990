"""Named queries over the derived tables; all results are flat scalar columns."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators import arcs as arc_ops
from ..operators import assemble, edit, heights, mesh, spatial, topology, walls
from ..session import materialise, scratch_path, stage_table
from ..sources import derived, geojson
from ..sources import store as stored
from . import pipeline

GROUND_BOX = (9500, 1500, 35500, 8500)
Q = 1e6
PER_BUCKET = 2_000  # arcs in a bucket of the stored test topologies
SIMPLIFY_AREA = 6000.0
COLLAPSE_AREA = 200_000.0  # more than the area of any triangle in a building
COARSE = 60  # steps of a quantisation that loses buildings
_stores: dict[tuple[str, str], Store] = {}


@dataclass
class Store:
    """The stage-to-stage tables of one data set, written once per session."""

    spark: SparkSession
    sf_dir: str

    @cached_property
    def features(self) -> DataFrame:
        return stage_table(derived.features(self.spark, self.sf_dir), "features", "source")

    @property
    def parcels(self) -> DataFrame:
        return self.features.filter("source = 'parcel'")

    @property
    def buildings(self) -> DataFrame:
        return self.features.filter("source = 'pand'")

    @cached_property
    def topology(self) -> topology.Topology:
        return topology.build_topology(self.features)

    def forget_results(self) -> None:
        """Drop the tables of the later steps, so that the next query computes them."""
        for name in ("terrain", "raised", "raised_path", "polygons3d"):
            self.__dict__.pop(name, None)

    @cached_property
    def terrain(self) -> DataFrame:
        return materialise(
            heights.arc_heights(
                self.topology, self.points, pipeline.TERRAIN, heights.GROUND, patches=self.patches)
        )

    @cached_property
    def raised(self) -> tuple[DataFrame, DataFrame]:
        arcs, uses = heights.raise_entities(
            self.topology, self.points, pipeline.BUILDING, derived.EROSION, self.patches
        )
        return materialise(arcs), materialise(uses)

    @property
    def points(self) -> DataFrame:
        return derived.points(self.spark, self.sf_dir)

    @cached_property
    def patches(self) -> DataFrame:
        return stage_table(spatial.patches_of(self.points), "patches")

    @cached_property
    def raised_path(self) -> str:
        """The raised 3D topology as a stored table."""
        arcs, uses = self.raised
        step = pipeline.Raised(self.topology, arcs, uses)
        solid = heights.update_arcs(self.topology.arcs, self.terrain).unionByName(arcs.select("arc_id", "points"))
        path = scratch_path(self.spark, "raised")
        pipeline.store_step(step, solid, path, PER_BUCKET)
        return path

    @cached_property
    def polygons3d(self) -> DataFrame:
        arcs, uses = self.raised
        flat = heights.update_arcs(self.topology.arcs, self.terrain)
        return materialise(
            assemble.polygons(uses, flat.unionByName(arcs.select("arc_id", "points")))
        )


def store(spark: SparkSession, sf_dir: str) -> Store:
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stores:
        _stores[key] = Store(spark, sf_dir)
    return _stores[key]


def forget() -> None:
    """Drop the remembered tables, so that the next query builds its own."""
    _stores.clear()


def _long(df: DataFrame) -> DataFrame:
    """Whole numbers as BIGINT, so that results do not depend on the engine's int sizes."""
    return df.select(
        *[F.col(c).cast("long").alias(c) if t in ("int", "smallint") else F.col(c)
          for c, t in df.dtypes]
    )


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def features_geojson(spark, d):
    keys = ["source", "gid", "type"]
    documents = geojson.to_features(store(spark, d).features, keys)
    parsed = geojson.from_features(documents, "feature", "source STRING, gid BIGINT, type STRING")
    return assemble.polygon_vertices(parsed, [*keys, "part"], closed=True)


def rejected_features(spark, d):
    """Feature documents, damaged by gid, that can't be read; by reason and type."""
    keys = ["source", "gid", "type"]
    documents = geojson.to_features(store(spark, d).features, keys)
    damaged = documents.withColumn("feature", F.expr("""CASE gid % 11
        WHEN 1 THEN substring(feature, 1, 60) WHEN 2 THEN replace(feature, 'Feature', 'Topology')
        WHEN 3 THEN replace(feature, '"Polygon"', '"LineString"') WHEN 4 THEN replace(feature, '[[[', '[[["a",')
        WHEN 5 THEN replace(feature, '"geometry"', '"shape"') WHEN 6 THEN replace(feature, '[[[', '[[[-1,-1],[')
        WHEN 7 THEN NULL ELSE feature END"""))
    properties = "source STRING, gid BIGINT, type STRING"
    bad = geojson.rejected_features(damaged, "feature", properties).groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("gid"), F.lit(0)).alias("gids"))
    good = geojson.from_features(damaged, "feature", properties)
    return bad.unionByName(good.selectExpr("'read' AS reason", "gid").groupBy("reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("gid").alias("gids")))


def dropped_rings(spark, d):
    return topology.dropped_rings(store(spark, d).features, COARSE).drop("part")


def neighbour_counts(spark, d):
    """Counts over the features and copies of every fifth one, in factored form."""
    features = store(spark, d).features
    copies = features.filter("gid % 5 = 0").withColumn("gid", F.expr("gid + 5000000"))
    t = topology.build_topology(features.unionByName(copies))
    return topology.neighbour_counts(t.ring_arcs, t.entities)


def topology_rows(spark, d):
    return arc_ops.topology_rows(topology.build_topology(store(spark, d).features, Q))


def topology_loaded(spark, d):
    """A quantised topology written, read back and rebuilt to polygons."""
    path = scratch_path(spark, "topology")
    built = topology.build_topology(store(spark, d).features, Q)
    stored.write_topology(arc_ops.topology_rows(built, pipeline.STORED), path, PER_BUCKET)
    t = stored.load_topology(spark, path)
    rebuilt = assemble.polygons(t.ring_arcs, topology.real_arcs(t))
    return _rounded(assemble.polygon_vertices(rebuilt, ["entity_id", "source", "gid", "type"]), "x", "y")


def topology_problems(spark, d):
    """Findings on the stored raised topology after every 50th arc is gone and every 70th broken."""
    path = scratch_path(spark, "damaged")
    rows = spark.read.schema(stored.SCHEMA).parquet(store(spark, d).raised_path)
    damaged = rows.where("kind != 'arc' OR id % 50 != 7").withColumn(
        "data", F.expr("if(kind = 'arc' AND id % 70 = 9, '[[1.0,2.0]]', data)"))
    stored.write_topology(damaged, path, PER_BUCKET)
    return stored.problems(spark, path).groupBy("kind", "reason").agg(
        F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids")).where("reason NOT LIKE 'ring%'")


def topology_rows_raised(spark, d):
    """Vertices of all arcs of the stored raised 3D topology."""
    arcs = stored.read_arcs(spark, store(spark, d).raised_path, None, whole=True)
    return _rounded(heights.arc_vertices(arcs), "z")


def solids_loaded(spark, d):
    """3D polygons rebuilt from the stored raised topology."""
    t = stored.load_topology(spark, store(spark, d).raised_path, whole=True)
    solids = assemble.polygons(t.ring_arcs, t.arcs)
    return _rounded(assemble.polygon_vertices(solids, ["entity_id", "source", "gid"]), "z")


def arcs_update_twice(spark, d):
    """A stored topology whose arcs get terrain heights, then those of buildings others."""
    s, path = store(spark, d), scratch_path(spark, "updated")
    stored.write_topology(arc_ops.topology_rows(s.topology, pipeline.STORED), path, PER_BUCKET)
    roofs = heights.arc_heights(s.topology, s.points, pipeline.BUILDING, heights.ROOF)
    for found in (s.terrain, roofs):
        stored.update_arcs(spark, path, found, PER_BUCKET)
    return heights.arc_vertices(stored.read_arcs(spark, path, None, whole=True))


def clip_features(spark, d):
    clipped = spatial.in_box(store(spark, d).features, derived.CLIP_BOX)
    return clipped.select("source", "gid", "type")


def points_by_class(spark, d):
    return heights.points_by_class(store(spark, d).points, heights.GROUND)


def patch_stats(spark, d):
    return spatial.patches_of(store(spark, d).points)


def ground_points_in_box(spark, d):
    points = store(spark, d).points
    ground = heights.points_by_class(points, heights.GROUND)
    return mesh.points_in_box(ground, store(spark, d).patches, GROUND_BOX)


def polygon_patch_join(spark, d):
    s = store(spark, d)
    return spatial.polygons_meeting_boxes(store(spark, d).features, s.patches, "patch_id")


def mixed_extent_pairs(spark, d):
    """Polygons and patches, with one polygon and one patch around everything."""
    s = store(spark, d)
    around = spark.range(1).selectExpr(
        "'around' AS source", "id AS gid", "0 AS part", "'around' AS type",
        "array(array(named_struct('x', -5000L, 'y', -5000L), named_struct('x', 90000L, 'y', -5000L),"
        " named_struct('x', 90000L, 'y', 90000000L), named_struct('x', -5000L, 'y', 90000000L))) AS rings")
    wide = spark.range(1).selectExpr(
        "-1L AS patch_id", "-4000L AS xmin", "-4000L AS ymin", "80000L AS xmax", "80000000L AS ymax")
    return spatial.polygons_meeting_boxes(
        s.features.unionByName(around), s.patches.select(*wide.columns).unionByName(wide), "patch_id")


def arc_patch_join(spark, d):
    s = store(spark, d)
    return spatial.arcs_meeting_boxes(s.topology.arcs, s.patches, "patch_id")


def polygon_polygon_join(spark, d):
    parcels = store(spark, d).parcels.selectExpr("gid AS parcel", "rings")
    buildings = store(spark, d).buildings.selectExpr("gid AS building", "rings")
    return spatial.polygon_pairs(parcels, buildings, ["parcel"], ["building"])


def points_in_polygon(spark, d):
    s = store(spark, d)
    roof = heights.points_by_class(s.points, heights.ROOF)
    near = heights.near_features(roof, s.buildings, s.patches)
    return spatial.points_in_polygons(near, s.buildings).select(*roof.columns, *spatial.KEYS)


def roof_points(spark, d):
    return heights.roof_points(
        store(spark, d).points, store(spark, d).buildings, derived.EROSION, store(spark, d).patches
    )


def roof_height(spark, d):
    return _rounded(
        heights.roof_height(
            store(spark, d).points, store(spark, d).buildings, derived.EROSION,
            patches=store(spark, d).patches,
        ), "z",
    )


def roof_height_rebuilt(spark, d):
    t = store(spark, d).topology
    rebuilt = assemble.polygons(t.ring_arcs.filter(pipeline.BUILDING), t.arcs)
    return _rounded(
        heights.roof_height(
            store(spark, d).points, rebuilt, derived.EROSION, ("entity_id", "gid"), store(spark, d).patches),
        "z",
    )


def quantize_transform(spark, d):
    return topology.quantize_transform(store(spark, d).features, 1e9)


def junctions(spark, d):
    entities = store(spark, d).features.selectExpr("*", "gid AS entity_id")
    return topology.junctions(entities)


def topology_arcs(spark, d):
    t = topology.build_topology(store(spark, d).features)
    return _rounded(arc_ops.arc_lines(t.arcs).drop("points"), "length")


def ring_arcs(spark, d):
    uses = store(spark, d).topology.ring_arcs.selectExpr(
        "entity_id", "source", "gid", "type", "ring", "pos", f"{topology.signed_ref()} AS ref"
    )
    return topology.decode_refs(uses, "ref")


def terrain_arc_ids(spark, d):
    return topology.arc_ids_of(store(spark, d).topology.ring_arcs, pipeline.TERRAIN)


def neighbours(spark, d):
    t = store(spark, d).topology
    return topology.neighbours(t.ring_arcs, t.entities)


def border_arcs_by_type(spark, d):
    return topology.border_arcs(
        store(spark, d).topology.ring_arcs, pipeline.TERRAIN, pipeline.BUILDING
    )


def arc_bbox(spark, d):
    return arc_ops.arc_bbox(store(spark, d).topology.arcs)


def arc_lines(spark, d):
    lines = arc_ops.arc_lines(store(spark, d).topology.arcs).select("arc_id", "length", "points")
    return _rounded(
        lines.selectExpr("arc_id", "length", "posexplode_outer(points) AS (pos, p)").selectExpr(
            "arc_id", "length", "pos", "p.x AS x", "p.y AS y"
        ), "length",
    )


def _transform(spark, d) -> topology.Transform:
    row = topology.quantize_transform(store(spark, d).features, Q).first()
    return topology.Transform(row.kx, row.ky, row.dx, row.dy)


def arc_delta_encode(spark, d):
    return arc_ops.delta_encode(store(spark, d).topology.arcs, _transform(spark, d))


def arc_delta_decode(spark, d):
    transform = _transform(spark, d)
    deltas = arc_ops.delta_encode(store(spark, d).topology.arcs, transform)
    return _rounded(arc_ops.delta_decode(deltas, transform), "x", "y")


def _positions(spark, d) -> DataFrame:
    arcs = store(spark, d).topology.arcs
    return heights.arc_vertices(arcs).select("x", "y").distinct()


def nearest_patch(spark, d):
    return heights.nearest_patch(_positions(spark, d), store(spark, d).patches)


def nearest_point_z(spark, d):
    s = store(spark, d)
    ground = heights.points_by_class(s.points, heights.GROUND)
    placed = nearest_patch(spark, d).drop("d2")
    found = heights.nearest_point_z(placed, ground, s.patches)
    return found.withColumn("z", F.col("z").cast("double"))


def nearest_points_k(spark, d):
    """The highest of the five nearest ground points in the nearest patch."""
    s = store(spark, d)
    ground = heights.points_by_class(s.points, heights.GROUND)
    found = heights.highest_of_nearest(materialise(nearest_patch(spark, d).drop("d2")), ground, 5)
    return found.withColumn("z", F.col("z").cast("double"))


def terrain_arcs_z(spark, d):
    s = store(spark, d)
    return heights.arc_heights(
        s.topology, s.points, pipeline.TERRAIN, heights.GROUND, patches=s.patches)


def building_arcs_z(spark, d):
    s = store(spark, d)
    return heights.arc_heights(
        s.topology, s.points, pipeline.BUILDING, heights.ROOF, patches=s.patches)


def arc_z_from_patches(spark, d):
    s = store(spark, d)
    return heights.arc_heights_from_patches(s.topology.arcs, s.points, heights.GROUND, s.patches)


def arc_ground_points(spark, d):
    s = store(spark, d)
    return heights.arc_ground_points(s.topology.arcs, s.points, heights.GROUND, s.patches)


def arcs_collect(spark, d):
    lines = heights.collect_arcs(store(spark, d).terrain)
    return lines.selectExpr(
        "arc_id", "size(points) AS n_points", "points[0].z AS z_first",
        "element_at(points, -1).z AS z_last", "aggregate(points, 0.0D, (a, p) -> a + p.z) AS z_sum",
    )


def arcs_update(spark, d):
    s = store(spark, d)
    return heights.arc_vertices(heights.update_arcs(s.topology.arcs, s.terrain))


def raised_arcs(spark, d):
    raised = store(spark, d).raised[0]
    return _rounded(
        raised.selectExpr("arc_id", "source_arc_id", "posexplode_outer(points) AS (pos, p)").selectExpr(
            "arc_id", "source_arc_id", "pos", "p.*"
        ), "z",
    )


def raised_ring_arcs(spark, d):
    return store(spark, d).raised[1].select("entity_id", "gid", "ring", "pos", "arc_id", "reversed")


def rings(spark, d):
    t = store(spark, d).topology
    return assemble.rings(t.ring_arcs, t.arcs).selectExpr(
        "entity_id", "ring", "posexplode_outer(line) AS (pos, p)"
    ).selectExpr("entity_id", "ring", "pos", "p.*")


def polygons3d(spark, d):
    vertices = assemble.polygon_vertices(
        store(spark, d).polygons3d, ["entity_id", "source", "gid"]
    )
    return _rounded(vertices, "z")


def polygon_vertices(spark, d):
    vertices = assemble.polygon_vertices(store(spark, d).polygons3d, ["gid"], closed=True)
    return _rounded(vertices.select("gid", "x", "y", "z"), "z")


def topology_features(spark, d):
    t = store(spark, d).topology
    return assemble.polygon_vertices(
        assemble.polygons(t.ring_arcs, t.arcs), ["entity_id", "source", "gid", "type"], closed=True
    )


def outer_rings_geojson(spark, d):
    t = store(spark, d).topology
    documents = geojson.to_features(
        assemble.outer_polygons(t.ring_arcs, t.arcs), ["entity_id", "gid"]
    )
    parsed = geojson.from_features(documents, "feature", "entity_id BIGINT, gid BIGINT")
    return assemble.polygon_vertices(parsed, ["entity_id", "gid"])


def dissolve_boundary(spark, d):
    t = store(spark, d).topology
    boundary = edit.dissolve_boundary(t.ring_arcs, "type")
    return _rounded(edit.boundary_size(boundary, t.arcs, ["type"]), "length")


def dissolve(spark, d):
    t = store(spark, d).topology
    found = edit.dissolve(t.ring_arcs, t.arcs, "type")
    return edit.boundary_size(found, t.arcs, ["type", "ring"]).drop("length")


def dissolve_polygons(spark, d):
    t = topology.build_topology(materialise(derived.overlapping(spark, d)))
    rings = edit.dissolve_polygons(t, "type")
    corner = rings.selectExpr(
        "type", "polygon", "is_hole", "double_area",
        "array_min(transform(line, p -> p.x)) AS x", "array_min(transform(line, p -> p.y)) AS y",
    )
    return corner.groupBy("type", "polygon").agg(
        F.expr("sum(double_area) AS double_area"), F.expr("count_if(is_hole) AS n_holes"),
        F.expr("min(x) AS xmin"), F.expr("min(y) AS ymin"),
    ).drop("polygon")


def vertex_effective_area(spark, d):
    return edit.vertex_effective_area(store(spark, d).topology.arcs)


def simplify_arcs(spark, d):
    return heights.arc_vertices(
        edit.simplify_arcs(store(spark, d).topology.arcs, SIMPLIFY_AREA)
    )


def simplify_rings(spark, d):
    """Arcs simplified so far that buildings would vanish, with each ring keeping three vertices."""
    return heights.arc_vertices(edit.simplify_topology(store(spark, d).topology, COLLAPSE_AREA).arcs)


def shared_walls(spark, d):
    parcels = store(spark, d).parcels.selectExpr("gid AS parcel", "rings")
    buildings = store(spark, d).buildings.selectExpr("gid AS building", "rings")
    return walls.shared_walls(parcels, buildings, ["parcel"], ["building"])


def shared_walls_metres(spark, d):
    """The same walls in metres, the buildings turned by a hair and without common vertices.

    Every corner of a building is off its place by up to 0.4 mm, and each of its edges has one more
    vertex, at 3/8 of its length, as a junction on the terrain's edge.
    """
    s = store(spark, d)
    metres = "transform(rings, ring -> transform(ring, p -> named_struct('x', p.x / 100D, 'y', p.y / 100D)))"
    moved = ("named_struct('x', p.x / 100D + 0.0001D * ((p.x + p.y + gid) % 4), 'y', p.y / 100D"
             " - 0.0001D * ((p.x + 3 * p.y + gid) % 4))")
    split = (
        f"transform(rings, ring -> flatten(zip_with({g.rotate('ring', '0')}, {g.rotate('ring', '1')}, (a, b) ->"
        " array(a, named_struct('x', a.x + (b.x - a.x) * 0.375D, 'y', a.y + (b.y - a.y) * 0.375D)))))")
    parcels = s.parcels.selectExpr("gid AS parcel", f"{metres} AS rings")
    buildings = s.buildings.selectExpr("gid", f"transform(rings, ring -> transform(ring, p -> {moved})) AS rings")
    walls_found = walls.shared_walls(
        parcels, buildings.selectExpr("gid AS building", f"{split} AS rings"), ["parcel"], ["building"], 0.002)
    length = "sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1))"
    return walls_found.groupBy("parcel", "building").agg(
        F.count(F.lit(1)).alias("n"), F.expr(f"round(sum({length}), 2) AS length"))


def _wall_segments(spark, d) -> DataFrame:
    t = store(spark, d).topology
    return walls.wall_segments(t.arcs, t.ring_arcs, pipeline.TERRAIN, pipeline.BUILDING)


def wall_segments(spark, d):
    return _wall_segments(spark, d)


def _footprints(spark, d) -> DataFrame:
    buildings = store(spark, d).topology.entities.filter(pipeline.BUILDING)
    # ids follow the source, so a few tasks read all buildings
    named = buildings.selectExpr("entity_id AS entity_b", "rings").repartition("entity_b")
    return walls.inset_rings(named, ["entity_b"], derived.INSET)


def inset_rings(spark, d):
    moved = walls.inset_rings(store(spark, d).features, ["source", "gid"], derived.INSET)
    flat = moved.selectExpr("source", "gid", "ring", "posexplode_outer(line) AS (pos, p)").selectExpr(
        "source", "gid", "ring", "pos", "p.*"
    )
    return _rounded(flat, "x", "y")


WALL = ["arc_id", "pos", "entity_a"]


def _closest(spark, d) -> DataFrame:
    return walls.closest_on_boundary(
        _wall_segments(spark, d), _footprints(spark, d), WALL, ["entity_b"]
    )


def closest_on_boundary(spark, d):
    flat = _closest(spark, d).selectExpr(
        "arc_id", "pos", "entity_b", "near_1.x AS near_x1", "near_1.y AS near_y1",
        "near_2.x AS near_x2", "near_2.y AS near_y2",
    )
    return _rounded(flat, "near_x1", "near_y1", "near_x2", "near_y2")


def wall_quads(spark, d):
    quads = walls.wall_quads(_closest(spark, d), ["arc_id", "pos", "entity_b"])
    flat = quads.selectExpr("arc_id", "pos", "entity_b", "posexplode_outer(wall) AS (corner, p)")
    return _rounded(flat.selectExpr("arc_id", "pos", "entity_b", "corner", "p.*"), "x", "y")


def polygon_mesh(spark, d):
    triangles = mesh.polygon_mesh(store(spark, d).polygons3d, "entity_id")
    return mesh.collect_mesh(triangles, "entity_id").selectExpr(
        "entity_id", "size(geom) AS n_triangles",
        f"aggregate(geom, 0L, (a, t) -> a + abs({g.double_area('t')})) AS double_area",
    )


def mesh_quality(spark, d):
    """Per polygon whether no triangle's circle holds a vertex and all corners are 3D vertices of it."""
    solids = store(spark, d).polygons3d
    triangles = mesh.polygon_mesh(solids, "entity_id").join(
        solids.selectExpr("entity_id", "flatten(rings) AS vs"), "entity_id")
    (ax, ay), (bx, by), (cx, cy) = ((f"(corners[{i}].x - v.x)", f"(corners[{i}].y - v.y)") for i in range(3))
    inside = (f"({ax} * {ax} + {ay} * {ay}) * ({bx} * {cy} - {cx} * {by})"
              f" - ({bx} * {bx} + {by} * {by}) * ({ax} * {cy} - {cx} * {ay})"
              f" + ({cx} * {cx} + {cy} * {cy}) * ({ax} * {by} - {bx} * {ay}) > 0")
    # a row for each triangle and vertex, as functions over arrays aren't compiled
    carried = " AND ".join(f"array_contains(vs, corners[{i}])" for i in range(3))
    met = triangles.selectExpr("entity_id", "corners", f"{carried} AS carried", "posexplode(vs) AS (i, v)")
    return met.groupBy("entity_id").agg(
        F.expr("count_if(i = 0) AS n_triangles"), F.expr(f"every(NOT ({inside})) AS all_empty"),
        F.expr("every(carried) AS all_carried"))


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    terrain_arcs_z, roof_height, roof_points, points_in_polygon, points_by_class, patch_stats,
    clip_features, ground_points_in_box, polygon_patch_join, mixed_extent_pairs, arc_patch_join,
    polygon_polygon_join, quantize_transform, junctions, topology_arcs, ring_arcs,
    terrain_arc_ids, neighbours, border_arcs_by_type, arc_bbox, arc_lines, arc_delta_encode,
    arc_delta_decode, nearest_patch, nearest_point_z, nearest_points_k, building_arcs_z, arc_z_from_patches,
    arc_ground_points, arcs_collect, arcs_update, raised_arcs, raised_ring_arcs, rings,
    polygons3d, polygon_vertices, topology_features, outer_rings_geojson, features_geojson,
    topology_rows, topology_loaded, topology_problems, topology_rows_raised, solids_loaded,
    arcs_update_twice, roof_height_rebuilt, dissolve_boundary, dissolve, dissolve_polygons, vertex_effective_area,
    simplify_arcs, simplify_rings, rejected_features, dropped_rings, neighbour_counts, shared_walls, shared_walls_metres, wall_segments, inset_rings, closest_on_boundary, wall_quads,
    polygon_mesh, mesh_quality,
]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def named(query):
        return lambda spark, sf_dir: _long(query(spark, sf_dir))

    return {query.__name__: named(query) for query in QUERIES}
