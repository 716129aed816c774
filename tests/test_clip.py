import math
import random
from dataclasses import replace

from layer_cases import SQUARE
from stratalake.functions import geometry as G
from stratalake.operators import clip, mask


def star(n, cx=0.0, cy=0.0, r=10.0, seed=3):
    rng = random.Random(seed)
    radii = [r * rng.uniform(.5, 1) for _ in range(n)]
    ring = [(cx + d * math.cos(2 * math.pi * k / n), cy + d * math.sin(2 * math.pi * k / n)) for k, d in enumerate(radii)]
    return ring + ring[:1]


def parity(ring, x, y):
    inside = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def points(spark, n, seed=1, span=11):
    rng = random.Random(seed)
    return [(k, rng.uniform(-span, span), rng.uniform(-span, span)) for k in range(n)]


def test_many_bands_match_brute_force_broadcast_or_not(spark, make_layer):
    ring = star(400)
    m = mask.build_mask(make_layer([(1, "Polygon", [[ring]])]))
    assert m.cells.count() > 100
    pts = points(spark, 1500)
    df = spark.createDataFrame(pts, "id bigint, x double, y double")
    want = sorted(k for k, x, y in pts if parity(ring, x, y))
    assert sorted(r["id"] for r in mask.points_inside(df, "x", "y", m).collect()) == want
    large = replace(m, cell_bytes=1 << 50)
    assert sorted(r["id"] for r in mask.points_inside(df, "x", "y", large).collect()) == want
    flags = mask.flag_inside(df, "x", "y", m).collect()
    assert sorted(r["id"] for r in flags if r["inside"]) == want and len(flags) == len(pts)


def test_boundary_counts_and_holes_do_not(make_layer):
    m = mask.build_mask(make_layer([(1, "Polygon", [[SQUARE, [(.5, .5), (1.5, .5), (1.5, 1.5), (.5, 1.5), (.5, .5)]]])]))
    layer = make_layer([(k, "Point", [[[p]]]) for k, p in enumerate([(0, 0), (1, 0), (2, 1), (1, 1), (.5, 1), (3, 1), (.25, .25)])])
    assert sorted(r["fid"] for r in clip.clip_layer(layer, m).df.collect()) == [0, 1, 2, 4, 6]
    multi = make_layer([(1, "MultiPoint", [[[(1, 0)]], [[(9, 9)]], [[(.2, .2)]]])])
    assert len(clip.clip_layer(multi, m).df.first()["geometry"]["parts"]) == 2


def test_polygon_areas_match_sampling(spark, make_layer):
    outline = star(160)
    m = mask.build_mask(make_layer([(1, "Polygon", [[outline]])]))
    shapes = {k: star(30 + k, x, y, 6, seed=k) for k, (x, y) in enumerate([(0, 0), (7, 2), (-8, -3), (0, 9), (30, 0)])}
    shapes[9] = [(-50, -50), (50, -50), (50, 50), (-50, 50), (-50, -50)]
    layer = make_layer([(k, "Polygon", [[r]]) for k, r in shapes.items()])
    out = {r["fid"]: r["geometry"] for r in clip.clip_polygons(layer, m).df.collect()}
    areas = {r["fid"]: r["area"] for r in clip.clipped_area(layer, m).collect()}
    assert 4 not in out
    rng = random.Random(8)
    for fid, g in out.items():
        rings = [[(v["x"], v["y"]) for v in ring] for part in g["parts"] for ring in part]
        for _ in range(400):
            x, y = rng.uniform(-12, 12), rng.uniform(-12, 12)
            got = sum(parity(r, x, y) for r in rings) % 2 == 1
            assert got == (parity(shapes[fid], x, y) and parity(outline, x, y)), (fid, x, y)
        area = sum(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(r, r[1:])) / 2 for r in rings)
        assert abs(area - areas[fid]) < 1e-9
    assert abs(areas[9] - abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(outline, outline[1:])) / 2)) < 1e-9


def test_mask_within_polygon_and_same_outline(make_layer):
    small = [(.5, .5), (1.5, .5), (1.5, 1.5), (.5, 1.5), (.5, .5)]
    m = mask.build_mask(make_layer([(1, "Polygon", [[small]])]))
    layer = make_layer([(1, "Polygon", [[SQUARE]]), (2, "Polygon", [[small]]),
                        (3, "Polygon", [[[(1.5, .5), (3, .5), (3, 1.5), (1.5, 1.5), (1.5, .5)]]])])
    out = clip.clip_polygons(layer, m).df.select("fid", G.polygon_area("geometry").alias("a")).collect()
    assert {r["fid"]: round(r["a"], 12) for r in out} == {1: 1.0, 2: 1.0}
    assert {r["fid"]: r["position"] for r in clip.classify(layer, m).collect()}[1] == "BOUNDARY"


def test_lines_split_and_keep_their_vertices(make_layer):
    m = mask.build_mask(make_layer([(1, "Polygon", [[SQUARE]])]))
    layer = make_layer([(1, "LineString", [[[(-1, 1), (1, 1), (3, 1), (3, 0.5), (1, 0.5)]]]),
                        (2, "LineString", [[[(5, 5), (6, 6)]]]), (3, "LineString", [[[(.1, .1), (.2, .3), (1, 1)]]]),
                        (4, "LineString", [[[(0, 0), (2, 0)]]])])
    out = {r["fid"]: [[(v["x"], v["y"]) for v in p[0]] for p in r["geometry"]["parts"]]
           for r in clip.clip_lines(layer, m).df.collect()}
    assert out[1] == [[(0, 1), (1, 1), (2, 1)], [(2, .5), (1, .5)]]
    assert out[3] == [[(.1, .1), (.2, .3), (1, 1)]] and out[4] == [[(0, 0), (2, 0)]] and 2 not in out


def test_several_mask_features_act_as_one(make_layer):
    blocks = make_layer([(1, "Polygon", [[SQUARE]]), (2, "Polygon", [[[(2, 0), (4, 0), (4, 2), (2, 2), (2, 0)]]]),
                         (3, "Polygon", [[[(1, 1), (3, 1), (3, 3), (1, 3), (1, 1)]]])])
    m = mask.build_mask(blocks)
    outline = m.dissolved().edges.selectExpr("sum(x1 * y2 - x2 * y1) / 2 as a").first()["a"]
    assert abs(outline - 10) < 1e-12
    layer = make_layer([(1, "Polygon", [[[(-1, -1), (5, -1), (5, 5), (-1, 5), (-1, -1)]]])])
    row = clip.clip_polygons(layer, m).df.select("geometry.type", G.polygon_area("geometry").alias("a")).first()
    assert row["type"] == "Polygon" and abs(row["a"] - 10) < 1e-9


def test_empty_mask_keeps_nothing(make_layer):
    m = mask.build_mask(make_layer([]))
    assert clip.clip_layer(make_layer([(1, "Point", [[[(0, 0)]]])]), m).df.count() == 0


def test_mixed_layer_and_report(make_layer):
    m = mask.build_mask(make_layer([(1, "Polygon", [[SQUARE]])]))
    layer = make_layer([(1, "Point", [[[(1, 1)]]]), (2, "LineString", [[[(1, 1), (9, 9)]]]), (3, "Polygon", [[SQUARE]]),
                        (4, "Point", [[[(7, 7)]]])])
    assert sorted(r["fid"] for r in clip.clip_layer(layer, m).df.collect()) == [1, 2, 3]
    assert clip.clip_report(layer, m).first().asDict() == {"layer": "test", "n_before": 4, "n_after": 3}
