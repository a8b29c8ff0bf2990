"""A stored topology: rows by kind, arcs in id buckets, read back into typed tables.

The table has the rows of ``topology_rows`` (kind, id, data) and is partitioned by kind and by
bucket, a run of ``per_bucket`` ids.  A scan of one kind or bucket reads only its files, and an
update of some arcs rewrites only the buckets that hold them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..operators.assemble import polygons
from ..operators.heights import collect_arcs
from ..operators.topology import Topology, Transform, decode_refs
from ..session import materialise

PER_BUCKET = 100_000
SCHEMA = "id LONG, data STRING, kind STRING, bucket LONG"
_ENTITY = ("type STRING, arcs STRING, properties STRUCT<source: STRING, gid: BIGINT, part: INT,"
           " type: STRING>")
_RINGS = "array<array<bigint>>"
_ENTITY_KEYS = ["entity_id", "source", "gid", "part", "type"]


def write_topology(rows: DataFrame, path: str, per_bucket: int = PER_BUCKET) -> None:
    """Replaces the table at ``path``; only arcs are spread over buckets."""
    _bucketed(rows, per_bucket).write.mode("overwrite").partitionBy("kind", "bucket").parquet(path)


def _bucketed(rows: DataFrame, per_bucket: int) -> DataFrame:
    bucket = F.when(F.col("kind") == "arc", F.floor(F.col("id") / per_bucket)).otherwise(0)
    placed = rows.select("id", "data", "kind", bucket.cast("long").alias("bucket"))
    return placed.repartition("kind", "bucket")


def read_rows(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of one kind with their bucket; the files of other kinds are not read."""
    return spark.read.schema(SCHEMA).parquet(path).where(F.col("kind") == kind)


def stored_transform(spark: SparkSession, path: str) -> Transform | None:
    row = read_rows(spark, path, "transform").select(
        F.from_json("data", "scale ARRAY<DOUBLE>, translate ARRAY<DOUBLE>").alias("t")).first()
    return None if row is None else Transform(*row.t.scale, *row.t.translate)


def _absolute(batches: Iterator[pa.RecordBatch], summed: bool) -> Iterator[pa.RecordBatch]:
    """Arcs as flat arrays of coordinates; with ``summed``, x and y are differences along an arc."""
    for batch in batches:
        lists = batch.column(2)
        sizes = np.diff(lists.offsets.to_numpy())
        points = lists.flatten()
        # a point that isn't at least (x, y) is found by the checks, here it only has to be a number
        flat = [points.field(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if summed and len(points):
            first = np.repeat(np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes)
            for axis in (0, 1):
                # whole numbers, summed exactly; an arc's sums start anew
                steps = np.nan_to_num(flat[axis]).astype(np.int64)
                running = np.cumsum(steps)
                flat[axis] = (running - (running - steps)[first]).astype(np.float64)
        structs = pa.StructArray.from_arrays(
            [pa.array(v, pa.float64(), from_pandas=True) for v in flat], ["x", "y", "z"])
        offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.ListArray.from_arrays(offsets, structs)],
            ["arc_id", "bucket", "points"])


def read_arcs(spark: SparkSession, path: str, transform: Transform | None,
              buckets: list[int] | None = None, whole: bool = False) -> DataFrame:
    """arc_id, bucket and points (x, y and z, NULL where an arc has none) of the stored arcs.

    Quantised arcs are stored as differences and come back as whole numbers (long); others
    as double, or long with ``whole``.  Prefix sums run over whole Arrow batches, nothing is
    shuffled.  Arcs whose data can't be read are left to ``problems``.
    """
    rows = read_rows(spark, path, "arc")
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    # as the element of an array a row is parsed once, not again for the condition
    readable = "filter(array(from_json(data, 'array<array<double>>')), p -> size(p) > 1" \
        " AND forall(p, c -> size(c) BETWEEN 2 AND 3))"
    parsed = rows.selectExpr("id AS arc_id", "bucket", f"explode_outer({readable}) AS p").where(
        "p IS NOT NULL"
    ).selectExpr(
        "arc_id", "bucket",
        "transform(p, c -> named_struct('x', c[0], 'y', c[1], 'z', get(c, 2))) AS points")
    summed = transform is not None
    decoded = parsed.mapInArrow(
        lambda batches: _absolute(batches, summed),
        "arc_id LONG, bucket LONG, points ARRAY<STRUCT<x: DOUBLE, y: DOUBLE, z: DOUBLE>>")
    if not (summed or whole):
        return decoded
    return decoded.withColumn("points", F.expr(
        "transform(points, p -> named_struct('x', bigint(p.x), 'y', bigint(p.y), 'z', p.z))"))


def _parts(rows: DataFrame) -> DataFrame:
    """entity_id, source, gid, part, type and rings (arrays of signed references) of entity rows."""
    parsed = rows.select("id", "data", F.from_json("data", _ENTITY).alias("e"))
    parts = (f"CASE e.type WHEN 'Polygon' THEN array(from_json(e.arcs, '{_RINGS}'))"
             f" WHEN 'MultiPolygon' THEN from_json(e.arcs, 'array<{_RINGS}>') END")
    return parsed.selectExpr(
        "id AS entity_id", "e.properties.source AS source", "e.properties.gid AS gid",
        "e.properties.part AS own_part", "e.properties.type AS type",
        f"posexplode({parts}) AS (nth, rings)",
    ).selectExpr("entity_id", "source", "gid", "coalesce(own_part, nth) AS part", "type", "rings", "nth")


def _uses(parts: DataFrame) -> DataFrame:
    refs = parts.selectExpr(*_ENTITY_KEYS, "posexplode(rings) AS (ring, refs)").selectExpr(
        *_ENTITY_KEYS, "ring", "posexplode(refs) AS (pos, ref)")
    return decode_refs(refs, "ref").drop("ref")


def load_topology(spark: SparkSession, path: str, whole: bool = False) -> Topology:
    """The typed tables of a stored topology: arcs, ring_arcs, entities and the transform.

    Entity rows are Polygons or MultiPolygons; a MultiPolygon gives one entity row per part,
    told apart by ``part`` under one entity_id.  References to arcs that aren't stored are left out;
    ``problems`` names them.  The side of the inside comes from the rings' areas.
    """
    transform = stored_transform(spark, path)
    arcs = materialise(read_arcs(spark, path, transform, whole=whole).select("arc_id", "points"))
    if arcs.where("exists(points, p -> p.z IS NOT NULL)").isEmpty():
        arcs = arcs.withColumn("points", F.expr(
            "transform(points, p -> named_struct('x', p.x, 'y', p.y))"))
    uses = _uses(_parts(read_rows(spark, path, "entity")))
    # twice the area between an arc and the chord of its ends, then between chords and the ring's start
    head, x0, y0 = "points[0]", "double(points[0].x)", "double(points[0].y)"
    swept = arcs.selectExpr(
        "arc_id", f"{head} AS head", "element_at(points, -1) AS tail",
        f"aggregate({g.path_edges('points')}, 0.0D, (a, e) -> a"
        f" + (e.x1 - {x0}) * (e.y2 - {y0}) - (e.x2 - {x0}) * (e.y1 - {y0})) AS swept",
    )
    used = uses.join(swept, "arc_id").selectExpr(
        *uses.columns, "if(reversed, -swept, swept) AS swept",
        "if(reversed, tail, head) AS head", "if(reversed, head, tail) AS tail",
    )
    ring = Window.partitionBy("entity_id", "part", "ring")
    start = F.first("head").over(ring.orderBy("pos"))
    chord = "(head.x - start.x) * double(tail.y - start.y) - (tail.x - start.x) * double(head.y - start.y)"
    ring_arcs = materialise(
        used.withColumn("start", start).withColumn("swept", F.expr(f"swept + {chord}"))
        .withColumn("interior_left", (F.sum("swept").over(ring) > 0) == (F.col("ring") == 0))
        .select(*_ENTITY_KEYS, "ring", "pos", "arc_id", "reversed", "interior_left"))
    flat = arcs.withColumn("points", F.expr("transform(points, p -> named_struct('x', p.x, 'y', p.y))"))
    entities = polygons(ring_arcs, flat)
    return Topology(entities, arcs, ring_arcs, transform)


def problems(spark: SparkSession, path: str) -> DataFrame:
    """What is wrong with a stored topology: kind, id and reason, one row for each finding.

    Arcs that can't be read or have fewer than two points, ids that occur twice, entities of other
    kinds than polygons, references to arcs that aren't stored, and rings that are broken
    (an arc doesn't begin where the one before ends).
    """
    every = spark.read.schema(SCHEMA).parquet(path)
    twice = every.groupBy("kind", "id").count().where("count > 1").select(
        "kind", "id", F.lit("id occurs more than once").alias("reason"))
    transform = stored_transform(spark, path)
    arcs = materialise(read_arcs(spark, path, transform).selectExpr(
        "arc_id", "named_struct('x', points[0].x, 'y', points[0].y) AS head",
        "named_struct('x', element_at(points, -1).x, 'y', element_at(points, -1).y) AS tail"))
    unread = read_rows(spark, path, "arc").select("id").join(
        arcs.selectExpr("arc_id AS id"), "id", "left_anti").selectExpr(
        "'arc' AS kind", "id", "'not an array of two points or more' AS reason")
    entities = read_rows(spark, path, "entity")
    parts = _parts(entities)
    other = entities.select("id").join(parts.selectExpr("entity_id AS id").distinct(), "id", "left_anti").selectExpr(
        "'entity' AS kind", "id", "'not a polygon' AS reason")
    uses = materialise(_uses(parts))
    missing = uses.join(arcs, "arc_id", "left_anti").selectExpr(
        "'entity' AS kind", "entity_id AS id", "concat('no arc ', arc_id) AS reason").distinct()
    # the end of each use against the start of the next one around the ring
    ends = uses.join(arcs.dropDuplicates(["arc_id"]), "arc_id").selectExpr(
        "entity_id", "part", "ring", "pos", "if(reversed, tail, head) AS head", "if(reversed, head, tail) AS tail")
    ring = Window.partitionBy("entity_id", "part", "ring").orderBy("pos")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    broken = (
        ends.select("entity_id", "ring", "tail",
                    F.coalesce(F.lead("head").over(ring), F.first("head").over(whole)).alias("following"))
        .where("tail != following")
        .selectExpr("'entity' AS kind", "entity_id AS id", "concat('ring ', ring, ' is broken') AS reason").distinct())
    out = twice
    for part in (unread, other, missing, broken):
        out = out.unionByName(part)
    return out


def arc_rows(arcs: DataFrame, transform: Transform | None) -> DataFrame:
    """Stored rows of arcs (arc_id, points in real coordinates, perhaps with z)."""
    has_z = "z" in arcs.schema["points"].dataType.elementType.names
    z = ", double(p.z)" if has_z else ""
    if transform is None:
        item = f"array(double(p.x), double(p.y){z})"
    else:
        def step(axis: str) -> str:
            before = f"if(i = 0, 0L, {transform.encode(axis, f'points[i - 1].{axis}')})"
            return f"double({transform.encode(axis, f'p.{axis}')} - {before})"
        item = f"array({step('x')}, {step('y')}{z})"
    # an arc without heights has points of two numbers
    flat = f"transform(transform(points, (p, i) -> {item}), c -> filter(c, v -> v IS NOT NULL))"
    return arcs.selectExpr("'arc' AS kind", "arc_id AS id", f"to_json({flat}) AS data")


def update_arcs(spark: SparkSession, path: str, heights: DataFrame, per_bucket: int = PER_BUCKET) -> list[int]:
    """Gives stored arcs new points where ``heights`` (arc_id, pos, x, y, z: real coordinates) has
    some; returns the buckets that were rewritten.

    Only touched buckets are read, put together in the checkpoint folder and then overwritten,
    each as a whole; other files stay as they are.  Arcs that aren't stored are ignored.
    """
    transform = stored_transform(spark, path)
    new = materialise(arc_rows(collect_arcs(heights), transform))
    touched = sorted(
        r.b for r in new.select(F.floor(F.col("id") / per_bucket).alias("b")).distinct().collect())
    if not touched:
        return []
    old = read_rows(spark, path, "arc").where(F.col("bucket").isin(touched))
    updated = materialise(
        old.join(new.selectExpr("id", "data AS new_data"), "id", "left")
        .selectExpr("id", "coalesce(new_data, data) AS data", "kind", "bucket"))
    (updated.repartition("kind", "bucket").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("kind", "bucket").parquet(path))
    return touched
