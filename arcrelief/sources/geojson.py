"""GeoJSON at the edges: feature documents out, geometry documents in."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g

_POLYGON = "array<array<array<double>>>"


def to_features(df: DataFrame, properties: list[str], dims: str = "xy") -> DataFrame:
    """One GeoJSON Feature per polygon row with ``rings``; rings are closed."""
    coordinates = (
        f"transform(rings, ring -> transform({g.close_ring('ring')},"
        f" p -> array({', '.join(f'p.{d}' for d in dims)})))"
    )
    props = ", ".join(f"'{p}', {p}" for p in properties)
    return df.selectExpr(
        *properties,
        f"to_json(named_struct('type', 'Feature', 'properties', named_struct({props}),"
        f" 'geometry', named_struct('type', 'Polygon', 'coordinates', {coordinates}))) AS feature",
    )


def _parsed(df: DataFrame, column: str, properties: str) -> DataFrame:
    """The properties, ``parts`` (polygons as arrays of coordinates), and why a document is rejected."""
    schema = (
        f"type STRING, properties STRUCT<{properties}>,"
        " geometry STRUCT<type: STRING, coordinates: STRING>"
    )
    opened = df.withColumn("_f", F.from_json(column, schema)).selectExpr(
        f"{column} AS _document", "_f", "_f.properties.*", "_f.geometry.type AS _kind",
        "_f.geometry.coordinates AS _c"
    )
    kept = [c for c in opened.columns if c not in ("_document", "_f", "_kind", "_c")]
    parts = (
        f"CASE _kind WHEN 'Polygon' THEN array(from_json(_c, '{_POLYGON}'))"
        f" WHEN 'MultiPolygon' THEN from_json(_c, 'array<{_POLYGON}>') END"
    )
    unread = (
        "parts IS NULL OR size(parts) = 0 OR exists(parts, p -> p IS NULL OR size(p) = 0 OR exists(p,"
        " r -> r IS NULL OR exists(r, c -> c IS NULL OR size(c) < 2 OR c[0] IS NULL OR c[1] IS NULL)))"
    )
    is_open = (
        "exists(parts, p -> exists(p, r -> size(r) < 4 OR r[0][0] != element_at(r, -1)[0]"
        " OR r[0][1] != element_at(r, -1)[1]))"
    )
    return opened.selectExpr("*", f"{parts} AS parts").selectExpr(
        "_document", *kept, "parts",
        "CASE WHEN _f.type IS NULL THEN 'not a JSON object with a type'"
        " WHEN _f.type != 'Feature' THEN concat('not a Feature but a ', _f.type)"
        " WHEN _kind IS NULL THEN 'no geometry'"
        " WHEN _kind NOT IN ('Polygon', 'MultiPolygon') THEN concat('not a polygon but a ', _kind)"
        f" WHEN {unread} THEN 'coordinates are not rings of numbers'"
        f" WHEN {is_open} THEN 'a ring is not closed or has fewer than three points' END AS reason",
    )


def from_features(df: DataFrame, column: str, properties: str) -> DataFrame:
    """Parses Feature documents into rows with the given properties, part and rings.

    ``properties`` is a DDL list such as ``gid BIGINT, type STRING``.  Multi-polygons give
    one row per part.  What isn't a Feature with whole rings gives no row here but one of
    ``rejected_features``.
    """
    parsed = _parsed(df, column, properties).filter("reason IS NULL")
    ring = "transform(slice(ring, 1, size(ring) - 1), p -> named_struct('x', p[0], 'y', p[1]))"
    kept = [c for c in parsed.columns if c not in ("_document", "parts", "reason")]
    return parsed.selectExpr(*kept, "posexplode_outer(parts) AS (part, polygon)").selectExpr(
        *kept, "part", f"transform(polygon, ring -> {ring}) AS rings"
    )


def rejected_features(df: DataFrame, column: str, properties: str) -> DataFrame:
    """The documents that ``from_features`` leaves out: their properties as far as they can be read,
    the reason and the document."""
    parsed = _parsed(df, column, properties).filter("reason IS NOT NULL")
    kept = [c for c in parsed.columns if c not in ("_document", "parts", "reason")]
    return parsed.selectExpr(*kept, "reason", "_document AS document")
