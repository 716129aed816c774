"""The adaptive grid of mask cells: bounded leaves whatever the mask's shape, and clips that leave most rows untouched."""

import math
import random

from pyspark.sql import functions as F

from layer_cases import SQUARE
from stratalake.functions import geometry as G
from stratalake.operators import clip, mask
from stratalake.sources.readers import read_parquet_layer
from stratalake.sources.writers import write_parquet_layer


def ring_of(n, seed, r=10.0):
    rng = random.Random(seed)
    radii = [r * rng.uniform(.5, 1) for _ in range(n)]
    ring = [(d * math.cos(2 * math.pi * k / n), d * math.sin(2 * math.pi * k / n)) for k, d in enumerate(radii)]
    return ring + ring[:1]


def coast(n=1500):
    """All but four edges within a thousandth of the mask's extent."""
    rng = random.Random(4)
    shore = [(5 + .01 * k / n, 9 + .01 * rng.random()) for k in range(n)]
    return [(0, 0), (0, 9), *shore, (10, 9), (10, 0), (0, 0)]


def strips(n=300):
    return [[(k / 30, 0), (k / 30 + .02, 0), (k / 30 + .02, 10), (k / 30, 10), (k / 30, 0)] for k in range(n)]


MASKS = {"coast": [[coast()]], "strips": [[s] for s in strips()],
         "blocks": [[[(x, y), (x + .4, y), (x + .4, y + .4), (x, y + .4), (x, y)]] for x in [k * .3 for k in range(33)] for y in [k * .3 for k in range(33)]],
         "holes": [[[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)], *[[(x, y), (x + .3, y), (x + .3, y + .2), (x, y)] for x in range(1, 9) for y in range(1, 9)]]]}


def even_odd(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def test_leaves_are_bounded_and_right(spark, make_layer):
    rng = random.Random(9)
    for name, features in MASKS.items():
        m = mask.build_mask(make_layer([(k, "Polygon", [rings]) for k, rings in enumerate(features)]))
        listed = m.cells.select(F.aggregate("_groups", F.lit(0), lambda n, g: n + F.size(g["edges"])).alias("n"), "_level")
        worst = listed.agg(F.max("n"), F.max("_level")).first()
        assert worst[0] <= mask.EDGES_PER_CELL and worst[1] == m.depth, (name, worst)
        assert name != "coast" or m.depth > 3
        pts = [(k, rng.uniform(-1, 11), rng.uniform(-1, 11)) for k in range(400)]
        pts += [(400 + k, 5 + rng.uniform(-.002, .012), 9 + rng.uniform(-.002, .012)) for k in range(200)]
        want = {k for k, x, y in pts if any(even_odd(rings, x, y) for rings in features)}
        df = spark.createDataFrame(pts, "id bigint, x double, y double")
        assert {r["id"] for r in mask.points_inside(df, "x", "y", m).collect()} == want, name
        flags = mask.flag_inside(df, "x", "y", m).collect()
        assert len(flags) == 600 and {r["id"] for r in flags if r["inside"]} == want, name


def test_lines_and_polygons_over_many_edges(spark, make_layer):
    outline = ring_of(1100, 2)
    hole = [(-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1)]
    m = mask.build_mask(make_layer([(1, "Polygon", [[outline, hole]])]))
    rng = random.Random(6)
    lines = [(k, "LineString", [[[(rng.uniform(-12, 12), rng.uniform(-12, 12)) for _ in range(3)]]]) for k in range(12)]
    inside = lambda x, y: even_odd([outline, hole], x, y)
    got = {r["fid"]: r["geometry"] for r in clip.clip_lines(make_layer(lines), m).df.collect()}
    for fid, _, parts in lines:
        path, steps = parts[0][0], 4000
        want = sum(math.dist(a, b) / steps for a, b in zip(path, path[1:]) for k in range(steps)
                   if inside(a[0] + (k + .5) / steps * (b[0] - a[0]), a[1] + (k + .5) / steps * (b[1] - a[1])))
        kept = sum(math.dist((v["x"], v["y"]), (w["x"], w["y"])) for p in got[fid]["parts"] for v, w in zip(p[0], p[0][1:])) if fid in got else 0
        assert abs(kept - want) < .15, fid
    shapes = [(k, "Polygon", [[[(x + 2 * math.cos(t), y + 2 * math.sin(t)) for t in [2 * math.pi * j / 20 for j in range(20)] + [0]]]])
              for k, (x, y) in enumerate([(0, 0), (6, 0), (-5, 5), (3, -1)])]
    out = {r["fid"]: r["geometry"] for r in clip.clip_polygons(make_layer(shapes), m).df.collect()}
    for fid, _, parts in shapes:
        rings = [[(v["x"], v["y"]) for v in ring] for part in out[fid]["parts"] for ring in part]
        for _ in range(150):
            x, y = rng.uniform(-8, 8), rng.uniform(-8, 8)
            assert even_odd(rings, x, y) == (even_odd(parts[0], x, y) and inside(x, y)), (fid, x, y)


def test_untouched_features_stay_as_they_are(spark, make_layer):
    m = mask.build_mask(make_layer([(1, "Polygon", [[[(0, 0), (10, 0), (10, 10), (0, 10), (0, 0)]]])])).dissolved()
    odd_ring = [(4, 4), (4, 5), (4.5, 5.2), (5, 5), (5, 4), (4, 4)]  # clockwise: a rebuilt ring would be turned
    at_edge = [(0, 8), (0, 9), (1, 9), (1, 8), (0, 8)]
    cut = [(9, 1), (11, 1), (11, 2), (9, 2), (9, 1)]
    layer = make_layer([(1, "Polygon", [[odd_ring]]), (2, "Polygon", [[at_edge]]), (3, "Polygon", [[cut]]), (4, "Polygon", [[[(20, 20), (21, 20), (21, 21), (20, 20)]]]),
                        (5, "LineString", [[[(4, 4), (5, 5)]]])])
    before = {r["fid"]: r["geometry"] for r in layer.df.collect()}
    after = {r["fid"]: r["geometry"] for r in clip.clip_polygons(layer, m).df.collect()}
    assert set(after) == {1, 2, 3} and after[1] == before[1] and after[2] == before[2] and after[3] != before[3]
    assert clip.clip_lines(layer, m).df.first()["geometry"] == before[5]
    near = clip._candidates(layer, m, G.POLYGONS)
    positions = {r["fid"]: r["_position"] for r in near.collect()}
    assert positions == {1: "INSIDE", 2: "BOUNDARY", 3: "BOUNDARY"}
    shapes = near.filter("_position = 'BOUNDARY'").select("fid", "geometry")
    assert [r["fid"] for r in clip.overlay(shapes, "fid", m).changed.collect()] == [3]  # the only one that is stitched


def test_the_envelope_reaches_the_scan(spark, make_layer, tmp_path):
    layer = make_layer([(k, "Point", [[[(k / 10, k / 10)]]]) for k in range(500)])
    write_parquet_layer(layer, f"{tmp_path}/points")
    read = read_parquet_layer(spark, f"{tmp_path}/points", "points")
    assert not {*G.ENVELOPE} & {*read.df.columns}
    clipped = clip.clip_layer(read, mask.build_mask(make_layer([(1, "Polygon", [[SQUARE]])])))
    plan = clipped.df._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PushedFilters"):]
    assert "xmax" in filters and "ymin" in filters
    assert clipped.df.columns == read.df.columns and clipped.df.count() == 21
    assert read.with_df(read.df.filter("fid > 3")).boxed is None


def test_an_area_measured_anew_after_dissolving(make_layer):
    m = mask.build_mask(make_layer([(k, "Polygon", [rings]) for k, rings in enumerate(MASKS["blocks"])]))
    one = m.dissolved()
    assert one.n_features == 1 and 0 < one.n_edges < m.n_edges and 0 < one.cell_bytes < m.cell_bytes
    area = one.edges.selectExpr("sum(x1 * y2 - x2 * y1) / 2 as a").first()["a"]
    assert abs(area - 10.0 ** 2) < 1e-6
