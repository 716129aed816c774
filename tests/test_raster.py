import math
from dataclasses import replace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stratalake.functions import tiles
from stratalake.operators import joins, mask, raster, terrain, warp
from stratalake.operators.raster import Raster, RasterMeta, from_pixels, pixels


def ramp(spark, width=150, height=130, nodata=None, epsg=4326, **kw):
    """v = 3 r + 2 c, over several tiles."""
    meta = RasterMeta("dem", epsg, kw.get("x0", 10.0), kw.get("y0", 45.0), kw.get("d", 0.01), kw.get("d", 0.01),
                      width, height, 1, nodata)
    r, c = F.floor(F.col("id") / width), F.col("id") % width
    return from_pixels(spark.range(width * height).select(
        F.lit(1).alias("band"), r.alias("r"), c.alias("c"), (3.0 * r + 2.0 * c).alias("v")), meta)


def test_pixels_round_trip(spark):
    got = pixels(ramp(spark))
    assert got.count() == 150 * 130
    assert got.filter("v <> 3 * r + 2 * c").count() == 0
    assert raster.raster_profile(ramp(spark)).first().asDict() == {
        "raster": "dem", "width": 150, "height": 130, "bands": 1, "epsg": 4326, "nodata": None}


def test_sampling_a_ramp_gives_the_ramp(spark, monkeypatch):
    r = ramp(spark)
    pts = spark.range(4000).select("id", (10.0 + (F.col("id") * 37 % 1490) / 1000.0).alias("x"),
                                   (45.0 - (F.col("id") * 53 % 1290) / 1000.0).alias("y"))
    want = 3 * (45.0 - F.col("y")) / 0.01 + 2 * (F.col("x") - 10.0) / 0.01
    assert raster.sample_bilinear(pts, "x", "y", r).filter(F.abs(F.col("elevation") - want) > 1e-8).count() == 0
    # The same through the shuffle join, with every point in one hot tile spread over tasks.
    hot = pts.withColumns({"x": F.lit(10.5) + F.col("id") / 1e6, "y": F.lit(44.5)})
    fast = raster.sample_bilinear(hot, "x", "y", r).agg(F.sum("elevation")).first()[0]
    monkeypatch.setattr(joins.sized_join, "__defaults__", ("inner", 0))
    spread = raster.sample_bilinear(hot, "x", "y", r).agg(F.sum("elevation"), F.count("elevation")).first()
    assert spread[1] == 4000 and abs(spread[0] - fast) < 1e-6


def test_edges_clamp_and_missing_neighbours_hide(spark):
    r = from_pixels(spark.createDataFrame([(1, 0, 0, 1.0), (1, 0, 1, 2.0), (1, 1, 0, 3.0), (1, 1, 1, -1.0)],
                                          "band int, r bigint, c bigint, v double"),
                    RasterMeta("d", 4326, 0.0, 2.0, 1.0, 1.0, 2, 2, 1, -1.0))
    pts = spark.createDataFrame([(1, -5.0, 2.0), (2, 9.0, 2.0), (3, 0.5, 1.5), (4, None, 1.0)], "id int, x double, y double")
    got = {v["id"]: v["elevation"] for v in raster.sample_bilinear(pts, "x", "y", r).collect()}
    # A missing neighbour hides the value even where its weight is zero.
    assert got[1] is None and got[3] is None and got[4] is None
    assert got[2] is None


def test_sparse_pixels_become_null(spark):
    r = from_pixels(spark.createDataFrame([(1, 0, 0, 1.0), (1, 2, 2, 9.0)], "band int, r bigint, c bigint, v double"),
                    RasterMeta("d", 4326, 0.0, 3.0, 1.0, 1.0, 3, 3))
    rows = {(p["r"], p["c"]): p["v"] for p in pixels(r).collect()}
    assert len(rows) == 9 and rows[(0, 0)] == 1.0 and rows[(2, 2)] == 9.0 and rows[(1, 1)] is None


def test_mosaic_first_valid_wins(spark):
    a = ramp(spark, 70, 70, nodata=0.0)
    b = ramp(spark, 70, 70, nodata=0.0, x0=10.0 + 0.01 * 60)
    out = raster.mosaic([a, b])
    assert (out.meta.width, out.meta.height) == (130, 70)
    got = {(p["r"], p["c"]): p["v"] for p in pixels(out).filter("r = 1").collect()}
    assert got[(1, 65)] == 133.0 and got[(1, 100)] == 3 + 2 * 40
    with pytest.raises(ValueError):
        raster.mosaic([a, Raster(replace(b.meta, epsg=3857), b.tiles)])


def test_mosaic_of_other_pixel_sizes_and_gaps(spark):
    a = ramp(spark, 70, 70, nodata=-1.0)
    coarse = ramp(spark, 40, 30, nodata=-1.0, x0=10.0 + 0.01 * 100, y0=45.0 + 0.05, d=0.03)
    out = raster.mosaic([a, coarse])
    assert (out.meta.width, out.meta.height, out.meta.dx) == (220, 90, 0.01) and abs(out.meta.y0 - 45.05) < 1e-9
    got = {(p["r"], p["c"]): p["v"] for p in pixels(out).collect()}
    assert len(got) == 220 * 90
    for (r, c), v in got.items():
        x, y = 10.0 + (c + .5) * 0.01, 45.05 - (r + .5) * 0.01
        if c < 70 and 5 <= r < 75:
            want = 3 * (r - 5) + 2 * c
        elif c >= 100:
            want = 3 * int((45.05 - y) / 0.03) + 2 * int((x - 11.0) / 0.03)
        else:
            want = -1.0  # a gap
        assert v == want, (r, c)
    assert raster.raster_profile(out).first()["width"] == 220


def test_no_pixel_is_shuffled(spark, make_layer):
    """What goes through an exchange are tiles, parts of tiles and cells of the mask."""
    ring = [(10.2 + .6 * k / 40, 44.2 + .3 * (k % 2)) for k in range(41)] + [(10.8, 44.8), (10.2, 44.8), (10.2, 44.2)]
    m = mask.build_mask(make_layer([(1, "Polygon", [[ring]])]))
    r = ramp(spark)
    outputs = {"crop": raster.crop(r, (10.21, 44.21, 10.79, 44.79)).tiles, "mask": raster.masked_tiles(r, m),
               "clip": raster.clip_raster(r, m).tiles, "mosaic": raster.mosaic([r, ramp(spark, x0=11.0)]).tiles,
               "warp": warp.warp_tiles(spark, replace_meta(r, 32633, 500000.0, 4649776.0, 10.0), warp.target_meta(
                   spark, replace_meta(r, 32633, 500000.0, 4649776.0, 10.0).meta, 4326))}
    source = r.tiles._jdf.queryExecution().executedPlan().toString().count("Exchange")
    for name, tiles in outputs.items():
        plan = tiles._jdf.queryExecution().optimizedPlan().toString()
        generators = [line for line in plan.splitlines() if "Generate" in line]
        assert not any("posexplode(data" in g for g in generators), name
    assert source >= 1


def replace_meta(r, epsg, x0, y0, d):
    return Raster(replace(r.meta, epsg=epsg, x0=x0, y0=y0, dx=d, dy=d), r.tiles)


def test_mask_by_tiles_is_the_mask_by_pixels(spark, make_layer):
    import random
    rng = random.Random(5)
    import math
    ring = [(10.75 + .7 * rng.uniform(.4, 1) * math.cos(k / 30), 44.35 + .6 * rng.uniform(.4, 1) * math.sin(k / 30)) for k in range(188)]
    hole = [(10.7, 44.3), (10.8, 44.3), (10.8, 44.4), (10.7, 44.4), (10.7, 44.3)]
    m = mask.build_mask(make_layer([(1, "Polygon", [[ring + ring[:1], hole]]), (2, "Polygon", [[[(10.1, 44.9), (10.3, 44.9), (10.3, 45.2), (10.1, 44.9)]]])]))
    r = ramp(spark, 200, 190)
    got = raster.mask_pixels(r, m)
    centres = pixels(r).withColumns({"x": r.meta.centre_x(F.col("c")), "y": r.meta.centre_y(F.col("r"))})
    want = mask.flag_inside(centres, "x", "y", m).select("r", "c", F.when(F.col("inside"), F.col("v")).alias("w"))
    joined = got.join(want, ["r", "c"])
    assert joined.count() == got.count() > 10_000 and joined.filter("not v <=> w").count() == 0
    assert 0 < got.filter("v is not null").count() < got.count()
    tiles = {(t["tile_r"], t["tile_c"]): t["position"] for t in raster._inside(
        spark.range(12).selectExpr("id div 4 as tile_r", "id % 4 as tile_c"), r.meta, m).collect()}
    assert len(tiles) == 12


def test_untouched_tiles_of_a_mask_keep_their_values(spark, make_layer):
    m = mask.build_mask(make_layer([(1, "Polygon", [[[(9, 40), (13, 40), (13, 46), (9, 46), (9, 40)]]])]))
    r = ramp(spark)
    plan = raster.masked_tiles(r, m)
    assert {t["position"] for t in raster._inside(spark.range(9).selectExpr("id div 3 as tile_r", "id % 3 as tile_c"), r.meta, m).collect()} == {"INSIDE"}
    assert plan.join(r.tiles, ["band", "tile_r", "tile_c", "data"]).count() == 9


def test_warp_of_sparse_tiles_and_gaps(spark):
    """Pixels whose source tiles are absent are NULL, not missing; all blocks and bands are there."""
    src = ramp(spark, 200, 200, epsg=32633, x0=500000.0, y0=4649776.0, d=10.0)
    sparse = Raster(src.meta, src.tiles.filter("not (tile_r = 1 and tile_c = 1)"))
    target = warp.target_meta(spark, src.meta, 4326)
    whole, part = (warp.warp_pixels(spark, r, target) for r in (src, sparse))
    assert part.count() == whole.count() == target.width * target.height
    lost = whole.filter("v is not null").count() - part.filter("v is not null").count()
    assert 3000 < lost < 4600
    same = part.filter("v is not null").join(whole.withColumnRenamed("v", "w"), ["band", "r", "c"])
    assert same.filter("abs(v - w) > 30").count() == 0


def test_arrays_project_like_columns(spark):
    from stratalake.functions import projection
    import numpy as np
    xs, ys = np.meshgrid(np.linspace(12.0, 18.0, 7), np.linspace(-70.0, 70.0, 9))
    for src, dst in ((4326, 32633), (4326, 3857), (4326, 32733)):
        x, y = projection.project_arrays(xs.ravel(), ys.ravel(), src, dst)
        df = spark.createDataFrame(list(zip(range(63), xs.ravel().tolist(), ys.ravel().tolist())), "k int, x double, y double")
        rows = projection.project_columns(df, "x", "y", src, dst).orderBy("k").collect()
        assert max(abs(r["x"] - a) + abs(r["y"] - b) for r, a, b in zip(rows, x, y)) < 1e-6
        bx, by = projection.project_arrays(x, y, dst, src)
        assert np.abs(bx - xs.ravel()).max() < 1e-9 and np.abs(by - ys.ravel()).max() < 1e-9


def test_mask_crop_and_no_overlap(spark, make_layer):
    square = [(10.2, 44.2), (10.8, 44.2), (10.8, 44.8), (10.2, 44.8), (10.2, 44.2)]
    m = mask.build_mask(make_layer([(1, "Polygon", [[square]])]))
    out = raster.clip_raster(ramp(spark), m)
    assert (out.meta.width, out.meta.height) == (60, 60) and abs(out.meta.x0 - 10.2) < 1e-9
    assert pixels(out).filter("v <> 3 * (r + 20) + 2 * (c + 20)").count() == 0
    with pytest.raises(ValueError):
        raster.clip_raster(ramp(spark, x0=80.0), m)


def test_warp_keeps_a_smooth_field(spark):
    src = ramp(spark, 100, 100, epsg=32633, x0=500000.0, y0=4649776.0, d=10.0)
    out = warp.warp_raster(spark, src, 4326)
    assert out.meta.epsg == 4326 and abs(out.meta.width - 100) < 40
    back = warp.warp_raster(spark, out, 4326)
    assert back is out
    mid = pixels(out).filter("v is not null").agg(F.min("v"), F.max("v"), F.count("v")).first()
    assert 0 <= mid[0] < 10 and 485 < mid[1] <= 495 and mid[2] > 9000


def exact_needs(blocks, block):
    """Source tiles that the neighbours of a block's covered pixels lie in, from every pixel."""
    fr, fc, covered = blocks.back(block)
    found = set()
    for r, c in zip(np.floor(fr[covered]).astype(int).tolist(), np.floor(fc[covered]).astype(int).tolist()):
        found |= {(i // tiles.TILE, j // tiles.TILE) for i in (r, r + 1) for j in (c, c + 1)
                  if 0 <= i < blocks.source.height and 0 <= j < blocks.source.width}
    return found


@pytest.mark.parametrize("source, target, edge", [
    (RasterMeta("narrow", 32642, 400000.0, 3970000.0, 5000.0, 2.0, 20, 5000), RasterMeta("t", 4326, 67.8, 35.87, 5e-4, 5e-4, 2300, 200), 512),
    (RasterMeta("wide", 32642, 300000.0, 3970000.0, 700.0, 900.0, 400, 300), RasterMeta("t", 4326, 66.5, 36.2, 0.02, 0.02, 250, 200), 64),
    (RasterMeta("part of the globe", 32642, 300000.0, 3970000.0, 700.0, 900.0, 400, 300), RasterMeta("t", 4326, -180.0, 90.0, 1.0, 1.0, 360, 180), 128),
    (RasterMeta("degrees", 4326, 60.0, 40.0, 0.01, 0.01, 900, 700), RasterMeta("t", 32642, 0.0, 4500000.0, 4000.0, 3000.0, 200, 300), 64),
    (RasterMeta("mercator", 3857, 7000000.0, 4500000.0, 900.0, 900.0, 500, 400), RasterMeta("t", 4326, 61.0, 38.0, 0.01, 0.01, 500, 300), 64)],
    ids=lambda m: getattr(m, "raster", None))
def test_few_pixels_find_all_tiles_of_a_block(monkeypatch, source, target, edge):
    blocks = tiles.WarpBlocks(source, target, edge)
    want = {(k, *t) for k in range(blocks.count) for t in exact_needs(blocks, k)}
    projected, project = [], tiles.project_arrays

    def counting(x, y, *codes):
        projected.append(np.broadcast(x, y).size)
        return project(x, y, *codes)

    monkeypatch.setattr(tiles, "project_arrays", counting)
    (found,) = blocks.needs([pa.RecordBatch.from_arrays([pa.array(range(blocks.count))], names=["id"])])
    rows = [tuple(r.values()) for r in found.to_pylist()]
    got = {r for r in rows if r[1] is not None}
    assert want and want <= got and {r[0] for r in rows} == set(range(blocks.count)) and len(rows) == len(set(rows))
    assert all(0 <= r < math.ceil(source.height / tiles.TILE) and 0 <= c < math.ceil(source.width / tiles.TILE) for _, r, c in got)
    assert sum(projected) <= target.width * target.height / 16


def test_blocks_are_not_put_into_few_tasks(spark):
    """What a block reads says little about its pixels: tasks must not be joined by the bytes they read."""
    meta = RasterMeta("narrow", 32642, 400000.0, 3970000.0, 5000.0, 20.0, 20, 5000)
    src = from_pixels(spark.range(100_000).select(F.lit(1).alias("band"), F.floor(F.col("id") / 20).alias("r"), (F.col("id") % 20).alias("c"),
                                                  F.col("id").cast("double").alias("v")), meta)
    out = warp.warp_tiles(spark, src, warp.target_meta(spark, meta, 4326))
    assert out.select(F.spark_partition_id()).distinct().count() > 1


def test_a_block_is_the_weighted_mean_of_neighbours_present():
    rng = np.random.default_rng(5)
    source = RasterMeta("s", 32642, 300000.0, 3970000.0, 700.0, 900.0, 100, 90, 2)
    target = RasterMeta("t", 4326, 66.7, 35.9, 0.008, 0.008, 150, 110, 2)
    image = rng.random((2, 90, 100))
    image[rng.random(image.shape) < 0.3] = np.nan
    blocks = tiles.WarpBlocks(source, target, 128)
    for block in range(blocks.count):
        (needs,) = blocks.needs([pa.RecordBatch.from_arrays([pa.array([block])], names=["id"])])
        parts = [(band + 1, r * 64, c * 64, image[band, r * 64:r * 64 + 64, c * 64:c * 64 + 64]) for _, r, c in map(dict.values, needs.to_pylist())
                 if r is not None for band in (0, 1)] or [(None, None, None, np.zeros((0, 0)))]
        table = pa.table({"band": [p[0] for p in parts], "r0": [p[1] for p in parts], "c0": [p[2] for p in parts], "h": [p[3].shape[0] for p in parts],
                          "w": [p[3].shape[1] for p in parts], "data": tiles.list_column([p[3] for p in parts])})
        fr, fc, covered = blocks.back(block)
        first_r, first_c, h, w = blocks.place(block)
        got = np.full((2, h, w), np.inf)
        for band, r0, c0, th, tw, data in zip(*blocks.warp([pa.scalar(block)], table).select(["band", "r0", "c0", "h", "w", "data"]).to_pydict().values()):
            got[band - 1, r0 - first_r:r0 - first_r + th, c0 - first_c:c0 - first_c + tw] = np.array(data, float).reshape(th, tw)
        for band, i, j in np.ndindex(2, h, w):
            near = [] if not covered[i, j] else [(abs(1 - dr - (fr[i, j] - r)) * abs(1 - dc - (fc[i, j] - c)), image[band, r + dr, c + dc])
                    for r, c in [(math.floor(fr[i, j]), math.floor(fc[i, j]))] for dr in (0, 1) for dc in (0, 1) if 0 <= r + dr < 90 and 0 <= c + dc < 100]
            near = [(p, v) for p, v in near if not np.isnan(v)]
            weight = sum(p for p, _ in near)
            assert np.isnan(got[band, i, j]) if not weight else math.isclose(got[band, i, j], sum(p * v for p, v in near) / weight, rel_tol=1e-9)


def test_terrain_guards_and_flat_grid(spark, make_layer):
    flat = Raster(ramp(spark, 5, 5).meta, ramp(spark, 5, 5).tiles.withColumn("data", F.transform("data", lambda v: F.lit(7.0))))
    assert terrain.terrain_mesh(flat).filter("z <> 0").count() == 0
    with pytest.raises(ValueError):
        terrain.build_terrain_model({}, {"other": flat})
    with pytest.raises(ValueError):
        terrain.build_terrain_model({}, {"dem": Raster(replace(flat.meta, epsg=32633), flat.tiles)})
    model = terrain.build_terrain_model({"p": make_layer([(1, "MultiLineString", [[[(10.01, 44.99)]], [[(10.02, 44.98)]]])])},
                                        {"dem": ramp(spark, 5, 5)})
    assert model["draped"].count() == 2 and model["terrain"].count() == 25


def test_skew_join_is_a_plain_join(spark):
    left = spark.range(5000).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400).alias("k"))
    right = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    for how in ("inner", "left"):
        want = left.join(right, "k", how).select("id", "w").collect()
        got = joins.skew_join(left, right, ["k"], how).select("id", "w").collect()
        assert sorted(want, key=str) == sorted(got, key=str)


def test_one_band_becomes_band_one(spark):
    r = ramp(spark, 5, 5)
    two = Raster(replace(r.meta, bands=2), r.tiles.unionByName(r.tiles.withColumn("band", F.lit(2))))
    assert terrain.dem_grid(two.band(2)).count() == 25


def test_missing_values_of_a_photo_have_no_colour(spark):
    rows = [(1, 0, c, float("nan") if c == 1 else 100.0 * c) for c in range(3)]
    photo = from_pixels(spark.createDataFrame(rows, "band int, r bigint, c bigint, v double"), RasterMeta("p", 4326, 0.0, 1.0, 1.0, 1.0, 3, 1))
    got = {p["c"]: p["red"] for p in terrain.ortho_rgb(photo).collect()}
    assert got == {0: 0, 1: None, 2: 255}
