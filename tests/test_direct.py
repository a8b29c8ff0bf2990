"""Nearest targets within small groups, found without gathering a group."""

from arcrelief.operators import nearest


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_direct_search_gathers_no_arrays(spark, capsys):
    queries = spark.createDataFrame([(0, 0, 1), (5, 5, 1), (9, 9, 2), (0, 0, None)], "x LONG, y LONG, g LONG")
    targets = spark.createDataFrame(
        [(1, 3, 4, 3, 4, 8), (1, 4, 3, 4, 3, 7), (1, 9, 9, 9, 9, 1), (1, 9, 9, 9, 9, 1)],
        "g LONG, xmin LONG, ymin LONG, xmax LONG, ymax LONG, z LONG")
    sizes = targets.groupBy("g").agg({"xmin": "min"}).selectExpr("g", "4L AS n")
    found = nearest.nearest_in_group(queries, targets, sizes, ("g",), ("z",), nearest.TO_POINT)
    assert "collect_list" not in _plan(found, capsys)
    got = {(r.x, r.y, r.g): r.best and (r.best.d2, r.best.z) for r in found.collect()}
    # 8 and 7 are equally far from both; the smaller z counts; no target, no best
    assert got == {(0, 0, 1): (25.0, 7), (5, 5, 1): (5.0, 7), (9, 9, 2): None, (0, 0, None): None}


def test_direct_search_takes_unknown_distances_first(spark):
    queries = spark.createDataFrame([(0, 0, 1)], "x LONG, y LONG, g LONG")
    targets = spark.createDataFrame(
        [(1, 0, 0, 0, 0, 8), (1, None, 3, None, 3, 9)],
        "g LONG, xmin LONG, ymin LONG, xmax LONG, ymax LONG, z LONG")
    best = nearest._direct(queries, targets, ("g",), ("z",), nearest.TO_POINT).first().best
    assert (best.d2, best.z) == (None, 9)
