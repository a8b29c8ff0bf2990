import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from arcrelief.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, 4)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF


def polygons(spark, rows):
    """rows: (source, gid, type, [ring, ...]) with rings as lists of (x, y)."""
    data = [(s, g, 0, t, [[{"x": x, "y": y} for x, y in ring] for ring in rings])
            for s, g, t, rings in rows]
    return spark.createDataFrame(
        data,
        "source STRING, gid BIGINT, part INT, type STRING,"
        " rings ARRAY<ARRAY<STRUCT<x: BIGINT, y: BIGINT>>>",
    )


def cloud(spark, rows):
    """rows: (patch_id, x, y, z, classification)"""
    return spark.createDataFrame(
        rows, "patch_id BIGINT, x BIGINT, y BIGINT, z BIGINT, classification INT"
    )


def box(x0, y0, x1, y1):
    return [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
