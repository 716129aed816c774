"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from checks import sample_layers as S  # noqa: E402
from checks.compare import session  # noqa: E402
from checks.queries import QUERIES  # noqa: E402
from stratalake.operators import raster, warp  # noqa: E402
from stratalake.operators.raster import RasterMeta  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = ["q_terrain_samples", "q_clip_points", "q_sample_elevation", "q_line_self_crossing", "q_node_lines",
            "q_clip_lines", "q_drape_lines", "q_geometry_validity", "q_repair_bowtie", "q_clip_polygons",
            "q_reproject_wgs84_to_utm", "q_terrain_mesh", "q_textured_terrain", "q_raster_mask", "q_raster_mosaic",
            "q_harmonize_schema", "q_qa_report"]


def large_warp(spark, sf):
    """Three bands of one value per order, warped from UTM to a six times finer grid in degrees: about
    36 output values per order and band."""
    orders = S.table(spark, sf, "orders")
    width = 400
    height = -(-orders.count() // width)
    key = F.col("o_orderkey")
    bands = F.array(*[F.struct(F.lit(b).alias("band"), v.cast("double").alias("v")) for b, v in (
        (1, F.col("o_totalprice")), (2, F.col("o_custkey")), (3, key % 256))])
    pixels = orders.select(
        F.floor(key / float(width)).alias("r"), (key % width).alias("c"), F.inline(bands))
    meta = RasterMeta("orders", 32642, 400000.0, 3970000.0, 250.0, 250.0, width, height, 3, None)
    source = raster.from_pixels(pixels, meta)
    grid = warp.target_meta(spark, meta, 4326)
    from dataclasses import replace
    fine = replace(grid, dx=grid.dx / 6, dy=grid.dy / 6, width=grid.width * 6, height=grid.height * 6)
    return warp.warp_tiles(spark, source, fine)


def run(df) -> float:
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = session(CPUS, CPUS)
    spark.sparkContext.setLogLevel("ERROR")
    run(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count())
    jobs = {name: QUERIES[name] for name in HEADLINE} | {"raster_warp_fine": large_warp}
    timings = {}
    for name, fn in jobs.items():
        start = time.perf_counter()
        df = fn(spark, SF)
        run(df)
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": SF.rstrip("/").rsplit("sf", 1)[-1]}))


if __name__ == "__main__":
    main()
