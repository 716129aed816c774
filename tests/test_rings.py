import random
import time

import pytest
from pyspark.sql import functions as F

from layer_cases import SQUARE
from stratalake.operators import rings, validity
from stratalake.operators.graph import components


def shifted(dx, dy, scale=1.0):
    return [(x * scale + dx, y * scale + dy) for x, y in SQUARE]


def diamond(x, y, r=1.0):
    return [(x - r, y), (x, y - r), (x + r, y), (x, y + r), (x - r, y)]


def faults(layer):
    return {r["fid"]: (r["reason"], r["reason_x"], r["reason_y"]) for r in validity.with_validity(layer).collect()}


def reasons(layer):
    return {f: r[0] for f, r in faults(layer).items()}


def test_holes_touching_in_a_circle_cut_the_interior(make_layer):
    big = shifted(-10, -10, 10)
    chain = [diamond(-10 + 1 + 2 * k, 0) for k in range(10)]
    around = [diamond(2, 0), diamond(0, 2), diamond(-2, 0), diamond(0, -2)]
    layer = make_layer([
        (1, "Polygon", [[big, *chain]]),               # from one side of the shell to the other
        (2, "Polygon", [[big, *chain[:-1]]]),          # ends before the other side
        (3, "Polygon", [[big, *[diamond(-5 + 2 * k, 3) for k in range(3)]]]),  # open chain, free of the shell
        (4, "Polygon", [[big, diamond(-2, 0, 2), diamond(2, 0, 2), [(0, 0), (-1, 5), (1, 5), (0, 0)]]]),  # three at one place
        (5, "Polygon", [[big, diamond(-2, 0), diamond(0, 0), [(-2, 1), (-1, 4), (0, 1), (-1, 3), (-2, 1)]]]),  # closed circle
        (6, "MultiPolygon", [[diamond(0, 0)], [diamond(2, 0)], [[(0, 1), (1, 4), (2, 1), (1, 3), (0, 1)]]]),  # parts may do so
        (7, "Polygon", [[big, *around]]),              # four apart
    ])
    got = faults(layer)
    assert got.pop(1) == ("Interior is disconnected", -10.0, 0.0) and got.pop(5) == ("Interior is disconnected", -2.0, 1.0)
    assert {r for r, _, _ in got.values()} == {None}, got


def test_nested_rings(make_layer):
    big, inner = shifted(0, 0, 10), shifted(5, 5, 4)
    layer = make_layer([
        (1, "MultiPolygon", [[big, inner], [shifted(7, 7)]]),              # an island in a lake
        (2, "MultiPolygon", [[big, inner], [shifted(1, 1)]]),              # on the land
        (3, "MultiPolygon", [[shifted(7, 7)], [big]]),                     # the small one first
        (4, "Polygon", [[big, inner, shifted(6, 6, .5)]]), (5, "Polygon", [[big, shifted(1, 1), shifted(4, 1)]]),
        (6, "MultiPolygon", [[big], [shifted(30, 0), shifted(50, 0, .1)]]),
        (7, "Polygon", [[big, diamond(1, 5)]]),                            # a hole that touches the shell
        (8, "MultiPolygon", [[diamond(0, 0)], [diamond(2, 0)]]), (9, "MultiPolygon", [[big], [diamond(-1, 5)]]),
        (10, "MultiPolygon", [[big, inner], [diamond(9, 6)]]),             # touches its lake's shore from within
        (11, "Polygon", [[big, shifted(-5, 5)]]),
    ])
    got = reasons(layer)
    assert got[2] == got[3] == "Nested shells" and got[4] == "Holes are nested"
    assert got[6] == got[11] == "Hole lies outside shell"
    assert {f for f, r in got.items() if r is None} == {1, 5, 7, 8, 9, 10}


def test_containments_equal_brute_force(make_layer):
    rng = random.Random(3)
    boxes = []

    def fill(x, y, size, depth):
        boxes.append(shifted(x, y, size / 2))
        if depth:
            for i in range(2):
                for j in range(2):
                    if rng.random() < .7:
                        fill(x + size * (.1 + .45 * i), y + size * (.1 + .45 * j), size * .35, depth - 1)
    fill(0.0, 0.0, 100.0, 4)
    rng.shuffle(boxes)
    layer = make_layer([(1, "MultiPolygon", [[b] for b in boxes])])
    got = {(r["part"], r["in_part"]) for r in rings.containments(layer.df, "fid").collect()}
    holds = lambda a, b: b[0][0] < a[0][0] < b[2][0] and b[0][1] < a[0][1] < b[2][1]
    assert got == {(i, j) for i, a in enumerate(boxes) for j, b in enumerate(boxes) if i != j and holds(a, b)} and len(got) > 50


@pytest.mark.parametrize("holes", [False, True])
def test_ten_thousand_rings_in_a_feature(make_layer, holes):
    small = [shifted(3.0 * (k % 100), 3.0 * (k // 100)) for k in range(10_000)]
    parts = [[shifted(-1, -1, 200), *small]] if holes else [[s] for s in small]
    layer = make_layer([(1, "MultiPolygon", parts)])
    start = time.time()
    assert reasons(layer) == {1: None}
    assert time.time() - start < 120


def test_components_equal_brute_force(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(1000 + k, 1001 + k) for k in range(200)]
    parent = {n: n for p in pairs for n in p}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n
    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "a int, b int")).collect()}
    linked = {n for a, b in pairs if a != b for n in (a, b)}
    assert got == {n: root(n) for n in linked}


def test_no_loop_over_pairs_in_a_row(make_layer):
    layer = make_layer([(1, "MultiPolygon", [[SQUARE], [shifted(5, 5)]])])
    plan = rings.containments(layer.df, "fid")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" in plan and plan.count("exists(") == 0
    assert rings.containments(layer.df.filter(F.lit(False)), "fid").count() == 0
