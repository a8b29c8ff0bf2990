"""Topology of shared arcs built from polygons.

1. features get dense entity ids and, if asked, quantised coordinates;
2. a position is a junction when its uses have different neighbour pairs;
3. rings are cut at their junctions, each piece in its canonical direction;
4. equal pieces become one arc.  Pieces that share an edge are equal, as the inside of a
   piece has no junction, so the first edge of the canonical form (and the length) is an
   exact key and no coordinate arrays take part in joins.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from ..functions import grid
from ..functions.ids import with_dense_id
from ..session import materialise

ENTITY_KEYS = ["source", "gid", "part"]


@dataclass(frozen=True)
class Transform:
    """Quantisation: real = integer * scale + translate."""

    kx: float = 1.0
    ky: float = 1.0
    dx: float = 0.0
    dy: float = 0.0

    def encode(self, axis: str, value: str) -> str:
        k, d = (self.kx, self.dx) if axis == "x" else (self.ky, self.dy)
        return f"floor(({value} - {d!r}D) / {k!r}D + 0.5D)"

    def decode(self, axis: str, value: str) -> str:
        k, d = (self.kx, self.dx) if axis == "x" else (self.ky, self.dy)
        return f"({value} * {k!r}D + {d!r}D)"

    def decode_point(self, p: str, *others: str) -> str:
        """A point with real coordinates; ``others`` are further fields to keep."""
        kept = "".join(f", '{f}', {p}.{f}" for f in others)
        return (f"named_struct('x', {self.decode('x', f'{p}.x')},"
                f" 'y', {self.decode('y', f'{p}.y')}{kept})")


@dataclass(frozen=True)
class Topology:
    """Typed tables of one topology.

    ``entities``  entity_id, source, gid, part, type, rings (after quantisation)
    ``arcs``      arc_id, points
    ``ring_arcs`` entity_id, source, gid, part, type, ring, pos, arc_id, reversed,
                  interior_left (of the ring, walking along it)
    ``transform`` the quantisation, or None when coordinates are kept as they are
    """

    entities: DataFrame
    arcs: DataFrame
    ring_arcs: DataFrame
    transform: Transform | None = None


def real_arcs(topology: Topology) -> DataFrame:
    """arc_id and points in real coordinates; quantised integers only serve as join keys."""
    if topology.transform is None:
        return topology.arcs
    point = topology.transform.decode_point("p", *_more_fields(topology.arcs.schema["points"].dataType))
    return topology.arcs.withColumn("points", F.expr(f"transform(points, p -> {point})"))


def real_entities(topology: Topology) -> DataFrame:
    """Entities with their rings in real coordinates."""
    if topology.transform is None:
        return topology.entities
    point = topology.transform.decode_point("p")
    return topology.entities.withColumn(
        "rings", F.expr(f"transform(rings, ring -> transform(ring, p -> {point}))")
    )


def _more_fields(points) -> list[str]:
    return [f for f in points.elementType.names if f not in ("x", "y")]


def quantize_transform(features: DataFrame, q: float) -> DataFrame:
    """One row (kx, ky, dx, dy) for ``q`` steps per axis; scale 1 for an empty extent."""
    extent = features.selectExpr(*g.bbox("flatten(rings)")).selectExpr(
        "double(min(xmin)) AS x0", "double(max(xmax)) AS x1",
        "double(min(ymin)) AS y0", "double(max(ymax)) AS y1",
    )
    steps = f"{float(q - 1)!r}D"
    return extent.selectExpr(
        f"if(x1 = x0, 1.0D, (x1 - x0) / {steps}) AS kx",
        f"if(y1 = y0, 1.0D, (y1 - y0) / {steps}) AS ky",
        "x0 AS dx", "y0 AS dy",
    )


def quantize(features: DataFrame, transform: Transform) -> DataFrame:
    return features.withColumn(
        "rings",
        F.expr(
            "transform(rings, ring -> transform(ring, p -> named_struct("
            f"'x', {transform.encode('x', 'p.x')}, 'y', {transform.encode('y', 'p.y')})))"
        ),
    )


def clean_rings(features: DataFrame) -> DataFrame:
    """Drops repeated consecutive vertices (cyclically) and rings left with fewer than 3.

    A polygon whose outer ring goes is dropped; ``n_dropped`` counts the lost holes.
    ``dropped_rings`` lists them.
    """
    return (
        features.withColumn("rings", F.expr(f"transform(rings, ring -> {_distinct('ring')})"))
        .filter("size(rings[0]) >= 3")
        .withColumn("n_dropped", F.expr("size(filter(rings, ring -> size(ring) < 3))"))
        .withColumn("rings", F.expr("filter(rings, ring -> size(ring) >= 3)"))
    )


def dropped_rings(features: DataFrame, q: float = 0) -> DataFrame:
    """Rings that building a topology leaves out, with fewer than 3 vertices: keys, ring, n_vertices
    (as given), n_left.  A polygon whose ring 0 is among them is left out as a whole."""
    if q:
        row = quantize_transform(features, q).first()
        if row.dx is not None:
            features = quantize(features, Transform(row.kx, row.ky, row.dx, row.dy))
    return (
        features.selectExpr(*ENTITY_KEYS, "posexplode(rings) AS (ring, line)")
        .selectExpr(*ENTITY_KEYS, "ring", "size(line) AS n_vertices", f"size({_distinct('line')}) AS n_left")
        .filter("n_left < 3")
    )


def _distinct(ring: str) -> str:
    """A ring without vertices equal to the one before (cyclically)."""
    return f"filter({ring}, (p, i) -> p != if(i = 0, element_at({ring}, -1), {ring}[i - 1]))"


def ring_vertices(entities: DataFrame, *extra: str) -> DataFrame:
    """One row per ring vertex with its cyclic neighbours (px, py) and (nx, ny)."""
    return (
        entities.selectExpr("entity_id", *extra, "posexplode_outer(rings) AS (ring, line)")
        .selectExpr(
            "entity_id", *extra, "ring", "line",
            f"{g.rotate('line', '(size(line) - 1)')} AS before", f"{g.rotate('line', '1')} AS after",
        )
        .selectExpr(
            "entity_id", *extra, "ring", "posexplode_outer(arrays_zip(line, before, after)) AS (pos, v)"
        )
        .selectExpr(
            "entity_id", *extra, "ring", "pos", "v.line.x AS x", "v.line.y AS y",
            "v.before.x AS px", "v.before.y AS py", "v.after.x AS nx", "v.after.y AS ny",
        )
    )


def positions(vertices: DataFrame) -> DataFrame:
    """One row per distinct position with its junction flag.

    The neighbour pair is put in order; it is the same for all uses exactly when the
    minimum and maximum of each of its four numbers agree.  Minimum and maximum combine
    before the shuffle, so a position used very often costs no more than others.
    """
    swap = "(px > nx OR (px = nx AND py > ny))"
    parts = {
        "ax": f"if({swap}, nx, px)", "ay": f"if({swap}, ny, py)",
        "bx": f"if({swap}, px, nx)", "by": f"if({swap}, py, ny)",
    }
    differs = " OR ".join(f"min({v}) != max({v})" for v in parts)
    return (
        vertices.selectExpr("x", "y", *[f"{e} AS {v}" for v, e in parts.items()])
        .groupBy("x", "y")
        .agg(F.expr(f"{differs} AS is_junction"), F.expr("count(*) AS n_uses"))
    )


def junctions(entities: DataFrame) -> DataFrame:
    return positions(ring_vertices(entities)).filter("is_junction").select("x", "y", "n_uses")


def _pieces(entities: DataFrame) -> DataFrame:
    """Rings cut at junctions: one row per piece with its points in canonical direction."""
    # stored, so that the join below shuffles both sides and AQE can split a hot position
    nodes = materialise(junctions(entities).select("x", "y")).hint(*grid.SPREAD)
    keys = ["entity_id", "ring"]
    # only the junctions of a ring are gathered; its points stay together in their row
    lines = entities.selectExpr("entity_id", "posexplode_outer(rings) AS (ring, line)")
    vertices = lines.selectExpr(*keys, "posexplode_outer(line) AS (pos, p)").selectExpr(
        *keys, "pos", "p.x AS x", "p.y AS y")
    met = vertices.join(nodes, ["x", "y"]).groupBy(*keys).agg(F.expr("sort_array(collect_list(pos)) AS nodes"))
    rings = lines.join(met, keys, "left").selectExpr(
        *keys, "transform(line, p -> named_struct('x', p.x, 'y', p.y)) AS line",
        "coalesce(nodes, CAST(array() AS ARRAY<INT>)) AS nodes",
    )
    # from each junction to the next one around the ring, both included
    # a piece that runs over the ring's end goes on at its start; each copies its own points only
    stretch = (
        "transform(nodes, (n, i) -> if(i = size(nodes) - 1,"
        " concat(slice(line, n + 1, size(line) - n), slice(line, 1, nodes[0] + 1)),"
        " slice(line, n + 1, nodes[i + 1] - n + 1)))"
    )
    cut = f"transform({stretch}, l -> named_struct('line', l, 'points', least(l, reverse(l))))"
    # a ring without junctions is one closed arc starting at its least point
    def anchored(line: str) -> str:
        # the least point is found once, as the first field of the structs that are compared
        starts = (
            f"transform(array({line}), l -> aggregate(l, named_struct('m', l[0], 'i', 0,"
            " 'at', array_repeat(0, 0)), (s, p) -> named_struct('m', least(s.m, p), 'i', s.i + 1,"
            " 'at', if(p < s.m, array(s.i), if(p = s.m, concat(s.at, array(s.i)), s.at)))).at)[0]"
        )
        return f"array_min(transform({starts}, i -> {g.rotate(line, 'i')}))"

    free = (
        f"transform(array(named_struct('ahead', {anchored('line')}, 'back', {anchored('reverse(line)')})),"
        f" a -> named_struct('line', {g.close_ring('a.ahead')},"
        f" 'points', {g.close_ring('least(a.ahead, a.back)')}))"
    )
    # both kinds in one pass, so that rings are gathered once
    pieces = rings.selectExpr(*keys, f"posexplode_outer(if(size(nodes) > 0, {cut}, {free})) AS (pos, piece)")
    return pieces.selectExpr(*keys, "pos", "piece.line AS line", "piece.points AS points").selectExpr(
        *keys, "pos", "points", "points != line AS reversed",
        "points[0].x AS ax", "points[0].y AS ay", "points[1].x AS bx", "points[1].y AS by",
        "size(points) AS n",
    )


EDGE_KEY = ["ax", "ay", "bx", "by", "n"]


def build_topology(features: DataFrame, q: float = 0) -> Topology:
    """Topology of features (source, gid, part, type, rings).

    ``q`` > 1 quantises to q steps per axis, 0 keeps the coordinates.  Arc ids start at 0
    and entity ids at 1, both in order of first appearance by entity, ring and position.
    """
    transform = None
    if q:
        row = quantize_transform(features, q).first()
        # no features, no extent: the identity keeps the types of quantised tables
        transform = Transform() if row.dx is None else Transform(row.kx, row.ky, row.dx, row.dy)
        features = quantize(features, transform)
    entities = with_dense_id(clean_rings(features), ENTITY_KEYS, "entity_id", start=1)
    pieces = materialise(_pieces(entities))
    arcs = pieces.groupBy(*EDGE_KEY).agg(
        F.expr("min(named_struct('entity_id', entity_id, 'ring', ring, 'pos', pos)) AS first_use"),
        F.expr("any_value(points) AS points"),
    )
    arcs = with_dense_id(arcs, ["first_use"], "arc_id")
    sides = entities.selectExpr(
        "entity_id", *ENTITY_KEYS, "type", "posexplode_outer(rings) AS (ring, line)"
    ).selectExpr(
        "entity_id", *ENTITY_KEYS, "type", "ring",
        f"({g.double_area('line')} > 0) = (ring = 0) AS interior_left",
    )
    ring_arcs = (
        pieces.drop("points")
        .join(arcs.select(*EDGE_KEY, "arc_id"), EDGE_KEY)
        .join(sides, ["entity_id", "ring"])
        .select(
            "entity_id", *ENTITY_KEYS, "type", "ring", "pos", "arc_id", "reversed", "interior_left"
        )
    )
    return Topology(entities, materialise(arcs.select("arc_id", "points")),
                    materialise(ring_arcs), transform)


def signed_ref(arc_id: str = "arc_id", reverse: str = "reversed") -> str:
    """Arc reference as one integer: bitwise complement for a reversed arc."""
    return f"if({reverse}, ~{arc_id}, {arc_id})"


def decode_refs(df: DataFrame, ref: str) -> DataFrame:
    """Splits signed arc references into arc_id and reversed."""
    return df.selectExpr("*", f"if({ref} < 0, ~{ref}, {ref}) AS arc_id", f"{ref} < 0 AS reversed")


def arc_ids_of(ring_arcs: DataFrame, types: str) -> DataFrame:
    """Distinct arcs used by entities whose type meets a condition; NULL types never do."""
    return ring_arcs.filter(types).select("arc_id").distinct()


def neighbours(ring_arcs: DataFrame, entities: DataFrame) -> DataFrame:
    """Pairs of entities that share an arc; an entity without any keeps one NULL row."""
    uses = ring_arcs.select("arc_id", "entity_id").distinct()
    pairs = (
        uses.join(uses.withColumnRenamed("entity_id", "neighbour_id"), "arc_id")
        .filter("entity_id != neighbour_id")
        .select("entity_id", "neighbour_id")
        .distinct()
    )
    return entities.select("entity_id").join(pairs, "entity_id", "left")


def neighbour_classes(ring_arcs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Neighbours in factored form: (members, links).

    ``members`` (entity_id, class_id, size) puts entities with equal sets of arcs in one class,
    named by its smallest entity.  ``links`` (class_id, neighbour_class, n_arcs, size) has the
    pairs of classes that share arcs, with the number of shared arcs and the neighbours each member
    has there; a class of several is linked with itself.  Every pair of neighbours is one
    member of each side of a link, so copies of a polygon cost one row each and never a pair.
    """
    uses = materialise(ring_arcs.select("entity_id", "arc_id").distinct())
    # sets are told apart by their size and two sums of hashes, which combine before the shuffle
    sets = materialise(uses.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("arc_id")).alias("a"),
        F.bit_xor(F.xxhash64(F.lit(7), "arc_id")).alias("b")))
    classes = materialise(sets.groupBy("n", "a", "b").agg(
        F.min("entity_id").alias("class_id"), F.count(F.lit(1)).alias("size")))
    members = sets.join(classes, ["n", "a", "b"]).select("entity_id", "class_id", "size")
    named = materialise(uses.join(classes.select("class_id", "size"), uses["entity_id"] == classes["class_id"])
                        .select("arc_id", "class_id", "size"))
    others = named.selectExpr("arc_id", "class_id AS neighbour_class", "size AS other_size")
    links = (
        named.join(others, "arc_id").filter("class_id != neighbour_class OR size > 1")
        .groupBy("class_id", "neighbour_class")
        .agg(F.count(F.lit(1)).alias("n_arcs"),
             F.expr("max(if(class_id = neighbour_class, size - 1, other_size)) AS size"))
    )
    return members, links


def neighbour_counts(ring_arcs: DataFrame, entities: DataFrame) -> DataFrame:
    """Number of neighbours of each entity (entity_id, n_neighbours), without listing pairs."""
    members, links = neighbour_classes(ring_arcs)
    per_class = links.groupBy("class_id").agg(F.sum("size").alias("n_neighbours"))
    counted = members.join(per_class, "class_id", "left").select("entity_id", "n_neighbours")
    return entities.select("entity_id").join(counted, "entity_id", "left").select(
        "entity_id", F.coalesce("n_neighbours", F.lit(0)).alias("n_neighbours"))


def border_arcs(ring_arcs: DataFrame, type_a: str, type_b: str) -> DataFrame:
    """Arcs between an entity meeting condition ``type_a`` and one meeting ``type_b``."""
    a = ring_arcs.filter(type_a).selectExpr("arc_id", "entity_id AS entity_a").distinct()
    b = ring_arcs.filter(type_b).selectExpr("arc_id", "entity_id AS entity_b").distinct()
    return a.join(b, "arc_id").filter("entity_a != entity_b")
