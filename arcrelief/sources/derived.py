"""Spatial tables derived from the driver's ``part`` and ``lineitem`` tables.

Every cell of a 50-column grid is one parcel with bent borders; some cells hold one or
two buildings that exactly fill a hole of the parcel.  Coordinates are whole centimetres.
All steps are projections, so nothing is shuffled to build the nested polygons.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Hole (clockwise) and buildings (counter-clockwise) per cell shape, as
# offsets from the cell corner.
HOLES = {
    "sq": [(300, 300), (300, 700), (700, 700), (700, 300)],
    "L": [(300, 300), (300, 700), (500, 700), (500, 500), (700, 500), (700, 300)],
    "split": [(300, 300), (300, 700), (500, 700), (700, 700), (700, 300), (500, 300)],
}
BUILDINGS = {
    "sq": [[(300, 300), (700, 300), (700, 700), (300, 700)]],
    "L": [[(300, 300), (700, 300), (700, 500), (500, 500), (500, 700), (300, 700)]],
    "split": [
        [(300, 300), (500, 300), (500, 700), (300, 700)],
        [(500, 300), (700, 300), (700, 700), (500, 700)],
    ],
}
CELL = 1000
PATCH = 2000
CLIP_BOX = (10250, 1250, 30250, 3250)
EROSION = 20
INSET = 1


def _cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    # few bytes become many: the rows are spread before polygons are made of them
    return spark.read.parquet(f"{sf_dir}/part.parquet").selectExpr(
        "p_partkey AS k",
        "p_partkey % 50 AS c",
        "floor(p_partkey / 50) AS r",
        "lower(p_type) AS type",
        "CASE WHEN p_size % 12 = 0 THEN 'split' WHEN p_size % 8 = 0 THEN 'L'"
        " WHEN p_size % 4 = 0 THEN 'sq' ELSE 'none' END AS shape",
    ).repartition(spark.sparkContext.defaultParallelism, "k")


def _ring(offsets: list[tuple[str, str]]) -> str:
    points = [
        f"named_struct('x', c * {CELL} + {dx}, 'y', r * {CELL} + {dy})" for dx, dy in offsets
    ]
    return f"array({', '.join(points)})"


def _by_shape(values: dict[str, str]) -> str:
    return " ".join(f"WHEN '{shape}' THEN {value}" for shape, value in values.items())


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    outer = _ring([
        ("0", "0"), ("500", "10 * ((c + r) % 5)"),
        ("1000", "0"), ("1000 + 10 * ((c + 1 + r) % 7)", "500"),
        ("1000", "1000"), ("500", "1000 + 10 * ((c + r + 1) % 5)"),
        ("0", "1000"), ("10 * ((c + r) % 7)", "500"),
    ])
    with_hole = _by_shape({shape: f"array({outer}, {_ring(h)})" for shape, h in HOLES.items()})
    return _cells(spark, sf_dir).selectExpr(
        "'parcel' AS source", "k AS gid", "0 AS part", "type",
        f"CASE shape {with_hole} ELSE array({outer}) END AS rings",
    )


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_shape = {
        shape: f"array({', '.join(f'array({_ring(ring)})' for ring in rings)})"
        for shape, rings in BUILDINGS.items()
    }
    return (
        _cells(spark, sf_dir)
        .filter("shape != 'none'")
        .selectExpr("k", f"posexplode_outer(CASE shape {_by_shape(per_shape)} END) AS (i, rings)")
        .selectExpr(
            "'pand' AS source", "k + 1000000L * i AS gid", "0 AS part", "'pand' AS type", "rings"
        )
    )


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Terrain and building polygons in one frame, keyed by (source, gid, part)."""
    return parcels(spark, sf_dir).unionByName(buildings(spark, sf_dir))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevation points in 20 m patches; patches on every seventh diagonal have no ground."""
    px, py = f"floor(x / {PATCH})", f"floor(y / {PATCH})"
    return (
        spark.read.parquet(f"{sf_dir}/lineitem.parquet")
        .selectExpr(
            f"l_partkey % 50 * {CELL} + (l_orderkey * 37 + l_linenumber * 101L) % 1000 AS x",
            f"floor(l_partkey / 50) * {CELL} + "
            "(l_suppkey * 53 + bigint(l_quantity) * 71 + l_orderkey * 13) % 1000 AS y",
            "bigint(l_quantity) * 10 AS z",
            "CASE l_returnflag WHEN 'A' THEN 2 WHEN 'R' THEN 6 ELSE 1 END AS cls",
        )
        .selectExpr(
            f"{px} * 100000 + {py} AS patch_id", "x", "y", "z",
            f"if(cls = 2 AND ({px} + {py}) % 7 = 0, 1, cls) AS classification",
        )
    )


#: Fixed values of ``overlapping``: corners as offsets from the cell corner, all vertices on
#: common borders at multiples of 250.
ZONE_SHAPES = {
    "square": [(0, 0), (250, 0), (500, 0), (750, 0), (1000, 0),
               (1000, 1000), (750, 1000), (500, 1000), (250, 1000), (0, 1000)],
    "nested": [(500, 250), (750, 250), (750, 750), (500, 750)],
    "across": [(250, 0), (500, 0), (750, 0), (1000, 0), (1250, 0),
               (1250, 1000), (1000, 1000), (750, 1000), (500, 1000), (250, 1000)],
}


def overlapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Squares in three zones, some missing, with equal, nested and overlapping ones of their zone."""
    rings = {name: _ring([(str(x), str(y)) for x, y in shape]) for name, shape in ZONE_SHAPES.items()}
    chosen = [
        ("square", "k % 13 != 0", 0), ("square", "k % 5 = 0", 1_000_000),
        ("nested", "k % 7 = 0", 2_000_000), ("across", "k % 11 = 0", 3_000_000),
    ]
    parts = ", ".join(
        f"if({where}, named_struct('gid', k + {offset}L, 'rings', array({rings[name]})), NULL)"
        for name, where, offset in chosen
    )
    return (
        _cells(spark, sf_dir)
        .selectExpr("concat('zone ', (floor(c / 3) + floor(r / 2)) % 3) AS type",
                    f"explode(filter(array({parts}), f -> f IS NOT NULL)) AS f")
        .selectExpr("'zone' AS source", "f.gid AS gid", "0 AS part", "type", "f.rings AS rings")
    )
