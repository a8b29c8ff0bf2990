"""Walls: segments and footprints are made once, footprints by all tasks."""

from conftest import SF, box, polygons

from arcrelief.operators import topology, walls
from arcrelief.plans import catalogue


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_segments_and_footprints_are_made_once(spark, monkeypatch, capsys):
    chain = [(0.0, -2.0), (3.0, -2.0), (6.0, -2.0), (12.0, -2.0), (12.0, 4.0)]
    rows = [(1, i, 7, *a, *b) for i, (a, b) in enumerate(zip(chain, chain[1:]))]
    rows += [rows[0], (2, 0, 8, 1.0, 1.0, 2.0, 2.0), (3, 0, None, 1.0, 1.0, 2.0, 2.0)]
    segments = spark.createDataFrame(
        rows, "arc_id LONG, pos INT, entity_b LONG, x1 DOUBLE, y1 DOUBLE, x2 DOUBLE, y2 DOUBLE")
    footprint = polygons(spark, [("b", 7, "t", [box(0, 0, 10, 10)])]).selectExpr(
        "gid AS entity_b", "posexplode(rings) AS (ring, line)")
    held, search = [], walls.nearest_in_group

    def counted(queries, targets, *rest):
        held.append(("FileScan" in _plan(queries, capsys), "Generate" in _plan(targets, capsys)))
        return search(queries, targets, *rest)

    monkeypatch.setattr(walls, "nearest_in_group", counted)
    found = walls.closest_on_boundary(segments, footprint, ["arc_id", "pos"], ["entity_b"]).collect()
    assert held == [(True, False)]
    assert len(found) == 6
    near = {(r.arc_id, r.pos): (r.near_1 and tuple(r.near_1), r.near_2 and tuple(r.near_2)) for r in found}
    places = [(0, 0), (3, 0), (6, 0), (10, 0), (10, 4)]
    assert near == {**{(1, i): (places[i], places[i + 1]) for i in range(4)},
                    (2, 0): ((None, None), (None, None)), (3, 0): ((None, None), (None, None))}


def test_footprints_are_dealt_out(spark, capsys):
    assert "hashpartitioning(entity_b" in _plan(catalogue._footprints(spark, SF), capsys)


def test_rings_gather_their_junctions_only(spark, capsys):
    entities = polygons(spark, [("a", 1, "t", [box(0, 0, 4, 4)]), ("a", 2, "t", [box(4, 0, 8, 4)])])
    plan = _plan(topology._pieces(entities.withColumn("entity_id", entities.gid)), capsys)
    assert "collect_list(pos" in plan and "collect_list(named_struct" not in plan
