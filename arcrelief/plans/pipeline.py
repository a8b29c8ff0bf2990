"""The three pipeline steps, and storing their result."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from ..operators import assemble, heights
from ..operators.arcs import other_rows
from ..operators.spatial import in_box
from ..operators.topology import Topology, build_topology, real_arcs
from ..sources import store

TERRAIN = "type != 'pand'"
BUILDING = "type = 'pand'"


@dataclass(frozen=True)
class Raised:
    """A topology whose buildings stand on flat copies of their arcs."""

    topology: Topology
    raised_arcs: DataFrame
    ring_arcs: DataFrame


def build_step(
    features: DataFrame, points: DataFrame, erosion: float, bounds: tuple | None = None, q: float = 0
) -> Raised:
    """Select by box, build the topology and raise the buildings."""
    selected = features if bounds is None else in_box(features, bounds)
    topology = build_topology(selected, q)
    raised, ring_arcs = heights.raise_entities(topology, points, BUILDING, erosion)
    return Raised(topology, raised, ring_arcs)


def height_step(step: Raised, points: DataFrame) -> DataFrame:
    """All arcs with 3D points: terrain arcs on the ground, raised arcs at roof height.

    Coordinates are real ones, also where the topology is quantised.
    """
    ground = heights.arc_heights(step.topology, points, TERRAIN, heights.GROUND)
    return heights.update_arcs(real_arcs(step.topology), ground).unionByName(
        step.raised_arcs.select("arc_id", "points")
    )


def polygons_step(step: Raised, arcs: DataFrame) -> DataFrame:
    """3D polygons from the arcs."""
    return assemble.polygons(step.ring_arcs, arcs)


STORED = ("source", "gid", "part", "type")  # the properties that a stored topology needs to be loaded


def store_step(step: Raised, arcs: DataFrame, path: str, per_bucket: int = store.PER_BUCKET) -> None:
    """Stores the topology with 3D arcs (as ``height_step`` returns them) and the raised buildings.

    Neighbours are those of the topology as it was built, where buildings share arcs.
    """
    kept = other_rows(step.topology, step.topology.ring_arcs, STORED).where("kind != 'entity'")
    entities = other_rows(step.topology, step.ring_arcs, STORED).where("kind = 'entity'")
    rows = store.arc_rows(arcs, step.topology.transform).unionByName(entities).unionByName(kept)
    store.write_topology(rows, path, per_bucket)
