import random

import pytest
from pyspark.sql import functions as F

from layer_cases import BOWTIE, SF, SQUARE
from checks import sample_layers as S
from stratalake.functions import geometry as G
from stratalake.operators import noding, repair, validity
from stratalake.operators.layers import Layer, assemble_paths, path_vertices


def reasons(layer):
    return {r["fid"]: r["reason"] for r in validity.with_validity(layer).collect()}


def shifted(ring, dx, dy, scale=1.0):
    return [(x * scale + dx, y * scale + dy) for x, y in ring]


def test_reasons(make_layer):
    hole_in, hole_out = shifted(SQUARE, .5, .5, .25), shifted(SQUARE, 5, 5, .25)
    layer = make_layer([
        (1, "Polygon", [[SQUARE]]), (2, "Polygon", [[BOWTIE]]), (3, "Polygon", None),
        (4, "Polygon", [[SQUARE, hole_in]]), (5, "Polygon", [[SQUARE, hole_out]]),
        (6, "Polygon", [[SQUARE[:-1]]]), (7, "Polygon", [[[(0, 0), (1, 1), (0, 0)]]]),
        (8, "MultiPolygon", [[SQUARE], [shifted(SQUARE, 5, 0)]]), (9, "MultiPolygon", [[SQUARE], [hole_in]]),
        (10, "MultiPolygon", [[SQUARE], [shifted(SQUARE, 1, 1)]]), (11, "MultiPolygon", [[SQUARE], [shifted(SQUARE, 2, 2)]]),
        (12, "LineString", [[[(0, 0)]]]), (13, "LineString", [[[(0, 0), (2, 2), (2, 0), (0, 2)]]]),
        (14, "Polygon", [[[(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]]]),
        (15, "Point", [[[(float("nan"), 0)]]]),
    ])
    got = reasons(layer)
    valid = {1, 4, 8, 11, 13}
    assert {f for f, r in got.items() if r is None} == valid
    assert got[2] == got[10] == "Self-intersection" and got[3] == "Null geometry"
    assert got[5] == "Hole lies outside shell" and got[9] == "Nested shells"
    assert got[6] == "Ring is not closed" and got[7] == got[12] == "Too few points in geometry component"
    assert got[14] in ("Ring Self-intersection", "Self-intersection") and got[15] == "Invalid Coordinate"


def test_valid_rows_pass_and_null_rows_go(make_layer):
    out = repair.repair_layers({"t": make_layer([(1, "Polygon", [[SQUARE]]), (2, "Polygon", None)])})["t"]
    assert [r["fid"] for r in out.df.collect()] == [1]


def test_bowtie_becomes_two_valid_lobes(make_layer):
    layers = {"clean": make_layer([(1, "Polygon", [[SQUARE]])]), "broken": make_layer([(1, "Polygon", [[BOWTIE]])])}
    out = repair.repair_layers(layers, validity_threshold=0.0)
    assert set(out) == {"clean", "broken"}
    row = out["broken"].df.select("geometry.type", G.polygon_area("geometry").alias("a")).first()
    assert row["type"] == "MultiPolygon" and abs(row["a"] - 2) < 1e-12
    assert reasons(out["broken"]) == {1: None}


def test_refuses_when_repair_is_off(make_layer):
    with pytest.raises(ValueError):
        repair.repair_layers({"t": make_layer([(1, "Polygon", [[BOWTIE]])])}, auto_repair=False)


def test_threshold_gate(make_layer):
    layer = make_layer([(1, "LineString", [[[(0, 0)]]]), (2, "LineString", [[[(0, 0), (1, 1)]]])])
    with pytest.raises(ValueError):
        repair.repair_layers({"t": layer})
    empty = make_layer([])
    assert "t" in repair.repair_layers({"t": empty})


def even_odd(rings, x, y):
    inside = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:]):
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                inside = not inside
    return inside


def test_repair_keeps_even_odd_parity(make_layer):
    rng = random.Random(5)
    rings = {}
    for fid in range(12):
        ring = [(rng.randint(0, 20), rng.randint(0, 20)) for _ in range(6 + fid % 5)]
        rings[fid] = ring + ring[:1]
    fixed = repair.repair_polygons(make_layer([(f, "Polygon", [[r]]) for f, r in rings.items()])).df.collect()
    for row in fixed:
        parts = [[[(v["x"], v["y"]) for v in ring] for ring in part] for part in row["geometry"]["parts"]]
        for _ in range(150):
            x, y = rng.uniform(-1, 21), rng.uniform(-1, 21)
            assert even_odd([rings[row["fid"]]], x, y) == any(even_odd(p, x, y) for p in parts), (row["fid"], x, y)


def test_lines(make_layer):
    layer = make_layer([
        (1, "LineString", [[[(0, 0), (2, 2), (2, 0), (0, 2)]]]), (2, "LineString", [[[(0, 0), (1, 0), (1, 1)]]]),
        (3, "LineString", [[SQUARE]]), (4, "LineString", [[[(0, 0), (2, 0), (1, 0)]]]),
        (5, "MultiLineString", [[[(0, 0), (1, 1)]], [[(1, 1), (2, 0)]]]),
        (6, "MultiLineString", [[[(0, 0), (2, 2)]], [[(0, 2), (2, 0)]]]),
        (7, "LineString", [[[(0, 0), (0, 0), (1, 0), (1, 0), (1, 1)]]]),
    ])
    simple = {r["fid"]: r["simple"] for r in validity.line_faults(layer).collect()}
    assert simple == {1: False, 2: True, 3: True, 4: False, 5: True, 6: False, 7: True}
    noded = {r["fid"]: (len(r["geometry"]["parts"]), r["geometry"]["type"]) for r in noding.node_lines(layer).df.collect()}
    assert noded[1] == (3, "MultiLineString") and noded[2] == (1, "LineString")
    assert noded[6] == (4, "MultiLineString") and noded[4][0] == 2
    again = {r["simple"] for r in validity.line_faults(noding.node_lines(layer)).collect()}
    assert again == {True}


def test_paths_in_several_rows_behave_like_one(spark):
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    numbered = path_vertices(S.line_table(spark, SF), "fid", order)
    cut = Layer("lines", assemble_paths(numbered, rows=2), 4326, ("fid", "seq"), frozenset({"line"}))
    assert cut.df.agg(F.max(G.n_vertices("geometry"))).first()[0] == 3
    whole = {r["fid"]: r["simple"] for r in validity.line_faults(S.lines(spark, SF)).collect()}
    assert {r["fid"]: r["simple"] for r in validity.line_faults(cut).collect()} == \
        {f: s for f, s in whole.items()}
