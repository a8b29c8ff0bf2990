import numpy as np
import pytest
from pyspark.sql import functions as F

from arcrelief.llm import hilbert_search, queries
from arcrelief.llm.hilbert_search import hilbert_keys

SCHEMA = "vec_id LONG, embedding ARRAY<FLOAT>, rank STRING"


def brute(rows, k=5):
    """(query, rank, vec_id) by all pairs, rows being (vec_id, vector) that take part."""
    out = []
    for i, a in rows:
        if i % 50:
            continue
        a = np.array(a, float)
        near = sorted({(-round(float(a @ b / np.linalg.norm(a) / np.linalg.norm(b)), 9), j)
                       for j, b in ((j, np.array(b, float)) for j, b in rows if j != i)})
        out += [(i, r, j) for r, (_, j) in enumerate(near[:k], 1)]
    return sorted(out)


def found(spark, rows, **options):
    table = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    got = hilbert_search.search(table, F.col("vec_id") % 50 == 0, **options)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted((r.query_id, r["rank"], r.vec_id) for r in got.collect())


def test_neighbouring_keys_are_neighbouring_cells():
    cells = np.array([(a, b, c) for a in range(8) for b in range(8) for c in range(8)])
    keys = hilbert_keys(cells, 3)
    assert sorted(keys) == list(range(512))
    assert set(np.abs(np.diff(cells[np.argsort(keys)], axis=0)).sum(1)) == {1}


def test_bad_vectors_and_ties(spark):
    good = [(i, [1.0, float(i % 7), float(i % 3)]) for i in range(101)]
    bad = [(150, None), (200, [0.0, 0.0, 0.0]), (250, [1.0, None, 2.0]), (None, [1.0, 2.0, 3.0]),
           (300, [float("nan"), 1.0, 1.0]), (301, [float("inf"), 1.0, 1.0]), (350, [1.0, 2.0])]
    assert found(spark, good + bad + good[:3]) == brute(good)


@pytest.mark.parametrize("rows", [[], [(0, None)], [(1, [1.0, 2.0])]])
def test_nothing_to_search(spark, rows):
    assert found(spark, rows) == []


def test_few_candidates(spark):
    assert found(spark, [(0, [1.0, 0.0]), (1, [1.0, 1.0])]) == [(0, 1, 1)]


def test_small_blocks_and_hot_vectors(spark):
    random = np.random.default_rng(3)
    centres = random.normal(size=(40, 8))
    rows = [(i, (centres[i % 40] + 0.05 * random.normal(size=8)).tolist()) for i in range(1200)]
    rows += [(i, [1.0] * 8) for i in range(1200, 1800)]  # a third of all rows is one vector
    rows = [(i, np.array(v, np.float32).tolist()) for i, v in rows]
    got, want = found(spark, rows, block=64, least_window=32), brute(rows)
    assert len(got) == len(want)
    near = {(q, v) for q, _, v in got} & {(q, v) for q, _, v in want}
    assert len(near) >= 0.9 * len(want)
    hot = [x for x in want if x[0] >= 1200]
    assert [x for x in got if x[0] >= 1200] == hot


def test_recall_of_the_query(spark, sf_dir):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    got = {(r.query_id, r.vec_id) for r in queries.op9_nearest(spark, sf_dir).collect()}
    want = {(q, v) for q, _, v in brute(rows)}
    assert len(got & want) >= 0.9 * len(want)
