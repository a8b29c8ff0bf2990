"""Tables between steps: planned for their own size, and joins on cells that nothing is broadcast in."""

from arcrelief.functions import grid
from arcrelief.operators import topology
from arcrelief.session import materialise


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_a_table_that_grew_from_few_rows_is_not_broadcast(spark, tmp_path, capsys):
    path = str(tmp_path / "few")
    spark.range(40).write.parquet(path)
    # 800,000 equal values, which compress well, too
    grown = spark.read.parquet(path).selectExpr("id", "explode(sequence(1, 20000)) AS n", "7L AS a", "7L AS b")
    stage = materialise(grown)
    joined = spark.range(10**9).join(stage, "id")
    assert "Broadcast" not in _plan(joined, capsys)
    assert stage.count() == 800_000


def test_joins_on_cells_broadcast_nothing(spark, capsys):
    boxes = spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0)], "a LONG, xmin DOUBLE, ymin DOUBLE, xmax DOUBLE, ymax DOUBLE")
    pairs = grid.extent_pairs(boxes, boxes.withColumnRenamed("a", "b"))
    assert "Broadcast" not in _plan(pairs, capsys)
    assert [(r.a, r.b) for r in pairs.collect()] == [(1, 1)]


def test_rings_are_gathered_once(spark, capsys):
    rows = [("p", 1, 0, "a", [[(0, 0), (2, 0), (2, 2), (0, 2)]]), ("p", 2, 0, "a", [[(2, 0), (4, 0), (4, 2), (2, 2)]]),
            ("p", 3, 0, "b", [[(9, 9), (8, 9), (8, 8)]])]
    features = spark.createDataFrame(
        rows, "source STRING, gid LONG, part INT, type STRING, rings ARRAY<ARRAY<STRUCT<x: LONG, y: LONG>>>")
    pieces = topology._pieces(features.selectExpr("*", "gid AS entity_id"))
    assert "Union" not in _plan(pieces, capsys)
    got = sorted((r.entity_id, r.pos, [tuple(p) for p in r.points], r.reversed) for r in pieces.collect())
    assert got[-1] == (3, 0, [(8, 8), (8, 9), (9, 9), (8, 8)], True) or got[-1][2][0] == got[-1][2][-1] == (8, 8)
    assert sum(r[2] in ([(2, 0), (2, 2)],) for r in got) == 2
