"""Stored arcs are parsed once, and those that can't be read are left out."""

import pytest

from arcrelief.sources import store


def _plan(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


@pytest.mark.parametrize("whole", [True, False])
def test_stored_arcs_are_parsed_once(spark, tmp_path, capsys, whole):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame(
        [("arc", 1, "[[1.0,2.0],[3.0,4.0,5.0]]"), ("arc", 2, "[[1.0,2.0]]"), ("arc", 3, "no"), ("arc", 4, None),
         ("arc", 5, "[[1.0],[2.0,3.0]]")], "kind STRING, id LONG, data STRING")
    store.write_topology(rows, path)
    arcs = store.read_arcs(spark, path, None, whole=whole)
    assert _plan(arcs, capsys).lower().count("from_json") == 1
    assert [(r.arc_id, [tuple(p) for p in r.points]) for r in arcs.collect()] == [(1, [(1, 2, None), (3, 4, 5.0)])]
