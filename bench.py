"""Benchmark: prints one JSON line with the seconds of each headline query.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
The stored tables (features, patches, topology) are written first and timed as
``store_tables``, as each later step of the pipeline reads stored tables.  Each query runs
twice and the faster run counts, as the first one also compiles the generated code.
"""

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from arcrelief.plans import catalogue  # noqa: E402
from arcrelief.session import local_session  # noqa: E402

HEADLINE = [
    "topology_arcs", "terrain_arcs_z", "roof_height", "raised_arcs", "polygons3d",
    "points_in_polygon", "polygon_patch_join", "arc_patch_join", "polygon_polygon_join",
    "nearest_patch", "nearest_point_z", "arc_z_from_patches", "neighbours", "dissolve",
    "simplify_arcs", "shared_walls", "closest_on_boundary", "polygon_mesh", "features_geojson",
    "patch_stats",
]


def drain(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.queries()
    drain(queries["patch_stats"](spark, sf_dir))  # start the JVM and its workers
    seconds = {}
    start = time.time()
    tables = catalogue.store(spark, sf_dir)
    tables.features, tables.patches, tables.topology
    seconds["store_tables"] = round(time.time() - start, 3)
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            if name in ("raised_arcs", "polygons3d"):
                tables.forget_results()
            start = time.time()
            drain(queries[name](spark, sf_dir))
            runs.append(time.time() - start)
        seconds[name] = round(min(runs), 3)
    match = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": float(match.group(1)) if match else None, "cores": cores,
    }))


main()
