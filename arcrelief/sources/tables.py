"""Reading and writing the engine's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FEATURE_COLUMNS = ["source", "gid", "part", "type", "rings"]


def read_polygons(
    spark: SparkSession, path: str, source: str, gid: str = "gid", type_: Column | None = None
) -> DataFrame:
    """Scan a polygon source: Parquet rows with an id, a type and nested rings.

    ``type_`` overrides the type column, e.g. ``lit('pand')`` for a building source.
    """
    return spark.read.parquet(path).select(
        F.lit(source).alias("source"),
        F.col(gid).cast("long").alias("gid"),
        F.lit(0).alias("part"),
        (F.col("type") if type_ is None else type_).alias("type"),
        "rings",
    )


def envelope_features(rows: DataFrame, properties: str = "properties") -> DataFrame:
    """Features from envelopes with JSON properties (``gid``, ``type``, perhaps ``source``, ``part``).

    ``rows`` has xmin, ymin, xmax, ymax and a column of JSON objects, such as the rows of
    ``createDataFrame`` or VALUES; each becomes one rectangle, counter-clockwise.
    """
    corners = [("xmin", "ymin"), ("xmax", "ymin"), ("xmax", "ymax"), ("xmin", "ymax")]
    ring = ", ".join(f"named_struct('x', {x}, 'y', {y})" for x, y in corners)
    read = F.from_json(properties, "source STRING, gid BIGINT, part INT, type STRING")
    return rows.withColumn("_p", read).selectExpr(
        "coalesce(_p.source, 'inline') AS source", "_p.gid AS gid", "coalesce(_p.part, 0) AS part",
        "_p.type AS type", f"array(array({ring})) AS rings")


def read_points(spark: SparkSession, path: str, classification: int | None = None) -> DataFrame:
    """Scan a point cloud; the class filter reaches the Parquet scan."""
    points = spark.read.parquet(path).select("patch_id", "x", "y", "z", "classification")
    return points if classification is None else points.filter(
        F.col("classification") == classification
    )


def replace_table(df: DataFrame, path: str, partition_by: str | None = None) -> None:
    """Replace a result table (drop and create in one step)."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)


def read_topology_kind(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Rows of one kind; ``kind`` is the partition column, so other kinds are not read."""
    return spark.read.parquet(path).filter(F.col("kind") == kind)
