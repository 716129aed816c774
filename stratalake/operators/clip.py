"""Clip layers to the study area: classify, and cut points, lines and polygons.

Features are classified first, by the cells under their envelope: most are proved inside or outside by FULL and EMPTY cells
alone, stay untouched or leave, and never meet an edge.  The segments of the others are cut at the mask's cells.  What lies
within one leaf only depends on the few edges listed there, so cutting and the inside test are expressions after one join
on the cell; the only shuffle regroups the kept pieces by feature.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.joins import sized_join
from stratalake.operators.layers import Layer, union_all
from stratalake.operators.lineage import materialize
from stratalake.operators.mask import (
    EDGES_PER_CELL, EMPTY, FULL, WHOLE, Mask, at_cells, cell_key, covered, odd_at, path_crosses, points_inside, whole_leaf, with_leaves)
from stratalake.operators.repair import stitch


def _let(value: Column, body) -> Column:
    """Bind an expression to a lambda variable, so that it is evaluated once."""
    return F.transform(F.array(value), body)[0]


def _near(e, x, y) -> Column:
    return G.near_segment(e["x1"], e["y1"], e["x2"], e["y2"], x, y)


def _meet(s, e) -> Column:
    """array<struct<ts, te, x, y>>: where segment s and mask edge e meet.  The location is computed
    from the mask edge, so both sides of a cut get the same coordinates."""
    none = F.array().cast("array<struct<ts:double,te:double,x:double,y:double>>")
    hit = lambda ts, te, x, y: F.named_struct(F.lit("ts"), ts, F.lit("te"), te, F.lit("x"), x, F.lit("y"), y)
    signs = F.named_struct(
        F.lit("s1"), G.orient(e["x1"], e["y1"], e["x2"], e["y2"], s["x1"], s["y1"]),
        F.lit("s2"), G.orient(e["x1"], e["y1"], e["x2"], e["y2"], s["x2"], s["y2"]),
        F.lit("e1"), G.orient(s["x1"], s["y1"], s["x2"], s["y2"], e["x1"], e["y1"]),
        F.lit("e2"), G.orient(s["x1"], s["y1"], s["x2"], s["y2"], e["x2"], e["y2"]))

    def along(a, x, y):
        dx, dy = a["x2"] - a["x1"], a["y2"] - a["y1"]
        return ((x - a["x1"]) * dx + (y - a["y1"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))

    def at(p):
        x = (F.when(p["ts"] == 0, s["x1"]).when(p["ts"] == 1, s["x2"]).when(p["te"] == 0, e["x1"])
             .when(p["te"] == 1, e["x2"]).otherwise(e["x1"] + p["te"] * (e["x2"] - e["x1"])))
        y = (F.when(p["ts"] == 0, s["y1"]).when(p["ts"] == 1, s["y2"]).when(p["te"] == 0, e["y1"])
             .when(p["te"] == 1, e["y2"]).otherwise(e["y1"] + p["te"] * (e["y2"] - e["y1"])))
        return hit(p["ts"], p["te"], x, y)

    def solve(d):
        flat = (d["s1"] == 0) & (d["s2"] == 0)
        crossing = (F.signum(d["s1"]) * F.signum(d["s2"]) <= 0) & (F.signum(d["e1"]) * F.signum(d["e2"]) <= 0)
        ts = F.when(d["s1"] == 0, 0.0).when(d["s2"] == 0, 1.0).otherwise(d["s1"] / (d["s1"] - d["s2"]))
        te = F.when(d["e1"] == 0, 0.0).when(d["e2"] == 0, 1.0).otherwise(d["e1"] / (d["e1"] - d["e2"]))
        ends = F.array(hit(along(s, e["x1"], e["y1"]), F.lit(0.0), e["x1"], e["y1"]),
                       hit(along(s, e["x2"], e["y2"]), F.lit(1.0), e["x2"], e["y2"]),
                       hit(F.lit(0.0), along(e, s["x1"], s["y1"]), s["x1"], s["y1"]),
                       hit(F.lit(1.0), along(e, s["x2"], s["y2"]), s["x2"], s["y2"]))
        shared = F.filter(ends, lambda p: p["ts"].between(0.0, 1.0) & p["te"].between(0.0, 1.0))
        one = F.array(_let(F.named_struct(F.lit("ts"), ts, F.lit("te"), te), at))
        return F.when(flat, shared).when(crossing, one).otherwise(none)
    apart = ((F.least(s["x1"], s["x2"]) > F.greatest(e["x1"], e["x2"])) | (F.least(e["x1"], e["x2"]) > F.greatest(s["x1"], s["x2"]))
             | (F.least(s["y1"], s["y2"]) > F.greatest(e["y1"], e["y2"])) | (F.least(e["y1"], e["y2"]) > F.greatest(s["y1"], s["y2"])))
    return F.when(apart, none).otherwise(_let(signs, solve))


def _stop(t, x, y, cut) -> Column:
    return F.named_struct(F.lit("t"), t, F.lit("x"), x, F.lit("y"), y, F.lit("cut"), cut)


def _end(s, t) -> Column:
    """Stop of segment s at t; its own ends are exact and no cuts."""
    own = (t <= 0) | (t >= 1)
    at = lambda a, b: F.when(t <= 0, s[a]).when(t >= 1, s[b]).otherwise(s[a] + t * (s[b] - s[a]))
    return _stop(t, at("x1", "x2"), at("y1", "y2"), ~own)


def _pieces(s, limits, hits, t_field: str) -> Column:
    """array<struct<a, b>>: consecutive stops of s between its limits, empty stretches left out."""
    inner = F.transform(F.filter(hits, lambda h: (h[t_field] > limits[0]["t"]) & (h[t_field] < limits[1]["t"])),
                        lambda h: _stop(h[t_field], h["x"], h["y"], F.lit(False)))
    ordered = F.concat(F.array(limits[0]), F.array_sort(inner), F.array(limits[1]))
    pair = lambda p: F.zip_with(
        F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1),
        lambda a, b: F.named_struct(F.lit("a"), a, F.lit("b"), b))
    return F.filter(_let(ordered, pair), lambda p: (p["a"]["x"] != p["b"]["x"]) | (p["a"]["y"] != p["b"]["y"]))


def _lattice_stops(c, base, level, a, b) -> Column:
    """Positions strictly between a and b where a segment crosses the lattice lines of a level, with a and b themselves, in order."""
    scale = F.pow(F.lit(2.0), level)

    def along(p, q):
        low, high = F.least(p, q), F.greatest(p, q)
        first = F.greatest(F.floor(low * scale) + 1, F.lit(0)).cast("long")
        last = F.least(F.ceil(high * scale) - 1, F.lit(base) * scale).cast("long")
        lines = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
        return F.transform(lines, lambda k: (k / scale - p) / (q - p))
    between = F.filter(F.concat(along(c["u1"], c["u2"]), along(c["v1"], c["v2"])), lambda t: (t > a) & (t < b))
    return F.concat(F.array(a), F.array_sort(F.array_distinct(between)), F.array(b))


def _pairs(stops) -> Column:
    n = F.size(stops) - 1
    return F.zip_with(F.slice(stops, F.lit(1), n), F.slice(stops, F.lit(2), n), lambda a, b: F.named_struct(F.lit("t0"), a, F.lit("t1"), b))


def to_cells(segments: DataFrame, mask: Mask, outside: bool = False) -> DataFrame:
    """Segments cut at the mask's cells: rows with ``t0, t1``, and ``_state`` and ``_key`` of the piece's cell.  No shuffle.

    A piece between two crossings of lattice lines lies in the cell of its middle, so pieces neither overlap nor leave
    gaps.  Below a quartered base cell a piece is cut on every level; those whose cell is no leaf find none.  Pieces in
    EMPTY cells are left out unless asked for ``outside``.
    """
    columns = segments.columns
    if not outside:
        segments = segments.filter(mask.meets_bounds(F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2")))
    ends = F.struct(mask.u(F.col("x1")).alias("u1"), mask.v(F.col("y1")).alias("v1"), mask.u(F.col("x2")).alias("u2"), mask.v(F.col("y2")).alias("v2"))
    middle = lambda c, p, a, b: c[a] + (p["t0"] + p["t1"]) / 2 * (c[b] - c[a])
    piece = lambda t0, t1, state: F.named_struct(F.lit("t0"), t0, F.lit("t1"), t1, F.lit("state"), state)
    c = F.col("_c")

    def stated(pairs):
        return F.transform(pairs, lambda p: piece(p["t0"], p["t1"], mask.state(middle(c, p, "u1", "u2"), middle(c, p, "v1", "v2"))))

    def merged(pieces):  # neighbours of one state that needs no leaf are one piece
        first = F.filter(pieces, lambda p, k: (k == 0) | (p["state"] >= 0) | (p["state"] != F.get(pieces, k - 1)["state"]))
        return _let(first, lambda f: F.transform(f, lambda p, k: piece(p["t0"], F.coalesce(F.get(f, k + 1)["t0"], F.lit(1.0)), p["state"])))
    # Most segments are shorter than a cell: they are one piece.
    one = (F.floor(c["u1"]) == F.floor(c["u2"])) & (F.floor(c["v1"]) == F.floor(c["v2"]))
    alone = F.array(piece(F.lit(0.0), F.lit(1.0), mask.state(c["u1"], c["v1"])))
    base = _let(_let(_lattice_stops(c, mask.base, F.lit(0.0), F.lit(0.0), F.lit(1.0)), lambda stops: stated(_pairs(stops))), merged)
    base = F.when(one, alone).otherwise(base)
    if not outside:
        base = F.filter(base, lambda p: p["state"] != EMPTY)
    # Outer generators: of others the optimizer asks beforehand whether the array is empty, and so works it out again.
    cut = segments.withColumn("_c", ends).withColumn("_p", F.explode_outer(base)).filter("_p is not null").withColumn("_state", F.col("_p.state"))
    keyed = lambda p, level: F.named_struct(
        F.lit("t0"), p["t0"], F.lit("t1"), p["t1"], F.lit("key"), cell_key(level, middle(c, p, "u1", "u2"), middle(c, p, "v1", "v2")))
    p = F.col("_p")
    own = F.named_struct(F.lit("t0"), p["t0"], F.lit("t1"), p["t1"], F.lit("key"), F.when(
        F.col("_state") == 0, cell_key(F.lit(0), middle(c, p, "u1", "u2"), middle(c, p, "v1", "v2"))))
    if mask.depth <= 0:
        cut = cut.withColumn("_p", own)
    else:
        below = F.flatten(F.transform(F.sequence(F.lit(1), F.col("_state")), lambda level: F.transform(
            _let(_lattice_stops(c, mask.base, level, p["t0"], p["t1"]), _pairs), lambda q: keyed(q, level))))
        cut = cut.withColumn("_p", F.explode_outer(F.when(F.col("_state") > 0, below).otherwise(F.array(own))))
    return cut.select(*columns, "_p.t0", "_p.t1", "_state", F.col("_p.key").alias("_key"))


def _uncut(segments: DataFrame, mask: Mask) -> DataFrame:
    """Rows like those of ``to_cells``, a piece for each whole segment that may meet the mask."""
    position = mask.box_position(F.least("x1", "x2"), F.least("y1", "y2"), F.greatest("x1", "x2"), F.greatest("y1", "y2"))
    state = F.when(position == "INSIDE", FULL).when(position == "OUTSIDE", EMPTY).otherwise(0)
    placed = segments.withColumns({"t0": F.lit(0.0), "t1": F.lit(1.0), "_state": state}).filter(F.col("_state") != EMPTY)
    return placed.withColumn("_key", F.when(F.col("_state") == 0, F.lit(WHOLE).cast("bigint")))


def _candidates(layer: Layer, mask: Mask, types: tuple[str, ...]) -> DataFrame:
    """Rows of the given types whose envelope may meet the mask, with their ``_position``: INSIDE where FULL cells prove it, else BOUNDARY."""
    df = near_mask(layer, mask).filter(F.col("geometry.type").isin(*types))
    box = G.envelope_columns("geometry")
    position = mask.box_position(box["xmin"], box["ymin"], box["xmax"], box["ymax"])
    # A shape without extent has no piece to keep; that shows when it is cut.
    position = F.when((position == "INSIDE") & (box["xmin"] == box["xmax"]) & (box["ymin"] == box["ymax"]), "BOUNDARY").otherwise(position)
    return G.settle(df.withColumn("_position", position), "_position").filter("_position != 'OUTSIDE'")


def near_mask(layer: Layer, mask: Mask) -> DataFrame:
    """The layer's rows; of one that stores envelopes, only those whose envelope meets the mask's, which its scan can tell."""
    if layer.boxed is None or mask.bounds is None:
        return layer.df
    near = layer.boxed.filter(mask.meets_bounds(*(F.col(c) for c in G.ENVELOPE)) | F.col("xmin").isNull())
    return near.select(*[F.col(f"`{c}`") for c in layer.df.columns])


_SEGMENT = ("x1", "y1", "x2", "y2")


def _cut_pieces(pieces: DataFrame, on: str = "ts") -> DataFrame:
    """Pieces of segments, joined with their leaves, as ``_cut``: their stretches between the mask's edges."""
    s = F.struct(*_SEGMENT)
    edges = F.flatten(F.coalesce(F.col("_groups"), F.array().cast(pieces.schema["_groups"].dataType)).getField("edges"))
    hits = F.flatten(F.transform(edges, lambda e: _meet(s, e)))
    limits = F.array(_end(s, F.col("t0")), _end(s, F.col("t1")))
    return pieces.withColumn("_cut", _let(limits, lambda r: _pieces(s, r, hits, on)))


def line_pieces(layer: Layer, mask: Mask, rows: DataFrame | None = None) -> DataFrame:
    """Stretches of lines inside the mask: ``key.., part, i, t0, t1, ax, ay, bx, by``.  No shuffle while the mask is small."""
    keys = list(layer.key)
    rows = _candidates(layer, mask, G.LINES) if rows is None else rows
    segments = G.explode_segments(rows, keys).drop("n", "ring", "cell")
    if mask.n_edges <= EDGES_PER_CELL:  # as few as a leaf holds: cutting at cells would only add pieces
        joined = with_leaves(_uncut(segments, mask), mask, whole_leaf(mask))
    else:
        joined = with_leaves(to_cells(segments, mask), mask)
    whole = (F.col("_state") == FULL) | F.coalesce(F.col("_full"), F.lit(False))
    inside = F.filter("_cut", lambda p: whole | covered((p["a"]["x"] + p["b"]["x"]) / 2, (p["a"]["y"] + p["b"]["y"]) / 2, G.near_segment))
    return _cut_pieces(joined).select(*keys, "part", "i", F.inline_outer(inside)).filter("a is not null").select(
        *keys, "part", "i", F.col("a.t").alias("t0"), F.col("b.t").alias("t1"),
        F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"), F.col("b.y").alias("by"))


def clip_lines(layer: Layer, mask: Mask) -> Layer:
    """Lines cut to the mask; a line may become several parts, lines outside disappear.  Rows that FULL cells prove inside stay as they are."""
    keys = list(layer.key)
    near = _candidates(layer, mask, G.LINES)
    along = Window.partitionBy(*keys).orderBy("part", "i", "t0")
    before = lambda c: F.lag(c).over(along)
    onward = ((before("i") == F.col("i")) | ((before("i") == F.col("i") - 1) & (before("t1") == 1) & (F.col("t0") == 0)))
    joined = ((before("part") == F.col("part")) & onward
              & (before("bx") == F.col("ax")) & (before("by") == F.col("ay")))
    runs = line_pieces(layer, mask, near.filter("_position = 'BOUNDARY'")).withColumn("_new", (~F.coalesce(joined, F.lit(False))).cast("int"))
    runs = runs.withColumn("run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    # Within a run a piece that starts inside a segment only continues a straight line.
    corner = F.filter("_p", lambda p, k: (k == 0) | (p["t0"] == 0))
    path = F.concat(F.transform(corner, lambda p: F.named_struct(F.lit("x"), p["ax"], F.lit("y"), p["ay"])),
                    F.array(G.vertex(F.element_at("_p", -1)["bx"], F.element_at("_p", -1)["by"])))
    paths = (runs.groupBy(*keys, "run").agg(F.array_sort(F.collect_list(F.struct("i", "t0", "ax", "ay", "bx", "by"))).alias("_p"))
             .select(*keys, "run", path.alias("_path")))
    clipped = (paths.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("run", "_path"))).alias("_r"))
               .select(*keys, G.from_parts(F.transform("_r", lambda r: F.array(r["_path"])), "LineString").alias("geometry")))
    inside = near.filter("_position = 'INSIDE'").select(*[F.col(f"`{c}`") for c in layer.df.columns])
    return layer.with_df(_rejoin(layer, clipped, keys).df.unionByName(inside))


def _rejoin(layer: Layer, clipped: DataFrame, keys: list[str]) -> Layer:
    """Attributes of the layer with the clipped geometries."""
    blank = {c: F.lit(None).cast(t) for c, t in layer.df.dtypes if c in ("seg_base", "seg_total", "seg_cell")}
    attributes = layer.df.drop("geometry").withColumns(blank) if blank else layer.df.drop("geometry")
    return layer.with_df(attributes.join(clipped, keys).select(*layer.df.columns))


@dataclass(frozen=True)
class Overlay:
    """What the outlines of some polygons and of the mask say about their intersection: directed ``pieces`` of its outline (``key, ax, ay,
    bx, by, cut``), and the keys ``changed``: polygons that lose part of their outline or get some of the mask's."""

    pieces: DataFrame
    changed: DataFrame


def overlay(shapes: DataFrame, key: str, mask: Mask) -> Overlay:
    """Outline of the polygons inside the mask, plus outline of the mask inside the polygons; a stretch on both outlines is kept
    once, and only where both interiors lie on the same side.  ``mask`` is dissolved.

    Pieces of both outlines meet in the mask's leaves, by equal key.  A polygon's parity at a leaf's corner and its edges in
    the leaf tell which of the mask's pieces there lie inside it; nothing is collected by polygon.
    """
    turned = F.transform("geometry.parts", lambda rings: F.transform(rings, lambda r, k: F.when(
        (G.ring_signed_area(r) > 0) != (k == 0), F.reverse(r)).otherwise(r)))
    outline = G.explode_segments(shapes.select(key, G.geometry(F.col("geometry.type"), turned).alias("geometry")), [key]).select(key, *_SEGMENT)
    placed = materialize(to_cells(outline, mask, outside=True))
    own = _own_pieces(placed, key, mask)
    theirs = materialize(_mask_pieces(shapes, outline, placed, key, mask))
    changed = own.filter("_changed").select(key).unionByName(theirs.select(key)).distinct()
    kept = own.select(key, F.inline_outer("_kept")).filter("a is not null").select(key, F.col("a.x").alias("ax"), F.col("a.y").alias("ay"), F.col("b.x").alias("bx"),
                                                     F.col("b.y").alias("by"), F.col("a.cut").alias("cut"))
    return Overlay(kept.unionByName(theirs), changed)


def _own_pieces(placed: DataFrame, key: str, mask: Mask) -> DataFrame:
    """``key, _kept, _changed``: stretches of the polygons' outlines that lie inside the mask, and whether some were dropped."""
    s = F.struct(*_SEGMENT)
    whole = (F.col("_state") == FULL) | F.coalesce(F.col("_full"), F.lit(False))
    cut = _cut_pieces(with_leaves(placed, mask))
    edges = F.flatten(F.col("_groups").getField("edges"))

    def keep(p):
        def test(m):
            onward = lambda e: (e["x2"] - e["x1"]) * (s["x2"] - s["x1"]) + (e["y2"] - e["y1"]) * (s["y2"] - s["y1"]) > 0
            on = F.exists(edges, lambda e: _near(e, m["x"], m["y"]))
            same = F.exists(edges, lambda e: _near(e, m["x"], m["y"]) & onward(e))
            inside = F.exists("_groups", lambda g: odd_at(g, m["x"], m["y"]))
            return F.coalesce(F.when(on, same).otherwise(inside), F.lit(False))
        return whole | _let(_middle(p), test)
    kept = cut.select(key, "_cut", F.filter("_cut", keep).alias("_kept"))
    return kept.select(key, "_kept", (F.size("_kept") < F.size("_cut")).alias("_changed"))


def _mask_pieces(shapes: DataFrame, outline: DataFrame, placed: DataFrame, key: str, mask: Mask) -> DataFrame:
    """``key, ax, ay, bx, by, cut``: stretches of the mask's outline strictly inside each polygon."""
    c = F.col
    whole = lambda x: F.least(F.greatest(F.floor(x), F.lit(0)), F.lit(mask.base - 1)).cast("int")
    boxes = G.with_envelope(shapes.select(key, "geometry")).select(
        key, mask.u(c("xmin")).alias("bu0"), mask.v(c("ymin")).alias("bv0"), mask.u(c("xmax")).alias("bu1"), mask.v(c("ymax")).alias("bv1"))
    near = (boxes.withColumn("bx", F.explode(F.sequence(whole(c("bu0")), whole(c("bu1")))))
            .withColumn("by", F.explode(F.sequence(whole(c("bv0")), whole(c("bv1")))))
            .filter(mask.state(c("bx") + 0.5, c("by") + 0.5) >= 0))
    scale = F.pow(F.lit(2.0), c("_level"))
    leaves = mask.cells.filter(~c("_full") & (F.size("_groups") > 0)).select(
        F.floor(c("_cx") / scale).cast("int").alias("bx"), F.floor(c("_cy") / scale).cast("int").alias("by"), "_key", "_x0", "_y0",
        (c("_cx") / scale).alias("lu0"), (c("_cy") / scale).alias("lv0"), (1 / scale).alias("lsize"))
    met = (sized_join(near, leaves, ["bx", "by"], mask.cell_bytes)
           .filter((c("bu1") >= c("lu0")) & (c("bu0") <= c("lu0") + c("lsize")) & (c("bv1") >= c("lv0")) & (c("bv0") <= c("lv0") + c("lsize")))
           .select(key, "_key", "_x0", "_y0", "by"))
    # Parity of the polygon at the leaf's corner: its edges to the right, found by the lattice row.
    rows = outline.withColumn("by", F.explode(F.sequence(whole(mask.v(F.least("y1", "y2")) - 1e-6), whole(mask.v(F.greatest("y1", "y2")) + 1e-6))))
    right = G.crosses_upward_ray(c("x1"), c("y1"), c("x2"), c("y2"), c("_x0"), c("_y0"))
    odd = (met.join(rows, [key, "by"]).filter(right).groupBy(key, "_key").agg((F.count(F.lit(1)) % 2 == 1).alias("_odd")))
    met = met.join(odd, [key, "_key"], "left").withColumn("_odd", F.coalesce("_odd", F.lit(False))).drop("by")
    e = F.struct(*[c(f"e_{x}").alias(x) for x in _SEGMENT])
    border = to_cells(mask.edges.select(*_SEGMENT), mask).filter(c("_key").isNotNull()).select("_key", "t0", "t1", *[c(x).alias(f"e_{x}") for x in _SEGMENT])
    pieces = met.join(border, "_key")
    here = placed.filter(c("_key").isNotNull()).select(key, "_key", *_SEGMENT)
    s = F.struct(*_SEGMENT)
    ident = [key, "_key", "_x0", "_y0", "_odd", "t0", "t1", *(f"e_{x}" for x in _SEGMENT)]
    stops = F.filter(_let(F.struct(s.alias("s"), e.alias("e")), lambda p: _meet(p["s"], p["e"])), lambda h: (h["te"] > c("t0")) & (h["te"] < c("t1")))
    hits = pieces.join(here, [key, "_key"], "left").select(*ident, F.explode_outer(F.when(c("x1").isNotNull(), stops)).alias("_h"))
    none = F.array().cast("array<struct<ts:double,te:double,x:double,y:double>>")
    cut = hits.groupBy(*ident).agg(F.coalesce(F.collect_set("_h"), none).alias("_hits"))
    limits = F.array(_end(e, c("t0")), _end(e, c("t1")))
    cut = cut.select(key, "_key", "_x0", "_y0", "_odd", F.inline_outer(_let(limits, lambda r: _pieces(e, r, c("_hits"), "te")))).filter("a is not null")
    cut = cut.withColumns({"mx": (c("a.x") + c("b.x")) / 2, "my": (c("a.y") + c("b.y")) / 2})
    seg = {x: c(x) for x in _SEGMENT}
    crosses = F.coalesce(path_crosses(seg, c("mx"), c("my"), c("_x0"), c("_y0")), F.lit(False))
    on = F.coalesce(G.near_segment(*(c(x) for x in _SEGMENT), c("mx"), c("my")), F.lit(False))
    judged = (cut.join(here, [key, "_key"], "left").groupBy(key, "_key", "a", "b", "_odd")
              .agg(F.count_if(crosses).alias("_n"), F.max(on).alias("_on")))
    inside = ((c("_n") % 2 == 1) != c("_odd")) & ~c("_on")
    return judged.filter(inside).select(key, c("a.x").alias("ax"), c("a.y").alias("ay"), c("b.x").alias("bx"), c("b.y").alias("by"), c("a.cut").alias("cut"))


def _middle(p) -> Column:
    return F.named_struct(F.lit("x"), (p["a"]["x"] + p["b"]["x"]) / 2, F.lit("y"), (p["a"]["y"] + p["b"]["y"]) / 2)


def clipped_area(layer: Layer, mask: Mask) -> DataFrame:
    """``key, area`` of polygon \u2229 mask: of polygons inside their own area, of others a plain sum over outline pieces; nothing is stitched."""
    key = layer.key[0]
    mask = mask.dissolved()
    if mask.bounds is None:
        return layer.df.filter(F.lit(False)).select(key, F.lit(0.0).alias("area"))
    x0, y0 = mask.bounds[:2]
    near = _candidates(layer, mask, G.POLYGONS)
    twice = ((F.col("ax") - x0) * (F.col("by") - y0) - (F.col("bx") - x0) * (F.col("ay") - y0))
    shapes = materialize(near.filter("_position = 'BOUNDARY'").select(key, "geometry"))
    cut = overlay(shapes, key, mask).pieces.groupBy(key).agg((F.sum(twice) / 2).alias("area"))
    return near.filter("_position = 'INSIDE'").select(key, G.polygon_area("geometry").alias("area")).unionByName(cut)


def clip_polygons(layer: Layer, mask: Mask) -> Layer:
    """Polygons cut to the mask; may become multi-polygons or get holes.  Polygons inside come back as they are: those that FULL
    cells prove inside at once, others when no piece of either outline says otherwise; only the rest is stitched."""
    key = layer.key[0]
    mask = mask.dissolved()
    near = materialize(_candidates(layer, mask, G.POLYGONS))  # read several times: what made the layer must not run again
    shapes = near.filter("_position = 'BOUNDARY'").select(key, "geometry")
    found = overlay(shapes, key, mask)
    cut = stitch(found.pieces.join(found.changed, key, "left_semi"), key).select(key, F.col("geometry").alias("_clipped"))
    judged = (shapes.select(key).join(found.changed.withColumn("_changed", F.lit(True)), key, "left").join(cut, key, "left")
              .select(key, F.coalesce("_changed", F.lit(False)).alias("_changed"), "_clipped"))
    out = near.join(judged, key, "left").filter("_position = 'INSIDE' or not _changed or _clipped is not null")
    columns = {c: F.col(f"`{c}`") for c in layer.df.columns} | {"geometry": F.coalesce("_clipped", "geometry").alias("geometry")}
    return layer.with_df(out.select(*columns.values()))


def clip_points(layer: Layer, mask: Mask) -> Layer:
    """Points inside the mask or on its boundary, unchanged; multi-points keep their inside members."""
    single = near_mask(layer, mask).filter(F.col("geometry.type") == "Point").withColumns(
        {"_x": G.point_x("geometry"), "_y": G.point_y("geometry")})
    kept = points_inside(single, "_x", "_y", mask).drop("_x", "_y")
    return layer.with_df(kept)


def clip_multipoints(layer: Layer, mask: Mask) -> Layer:
    keys = list(layer.key)
    several = near_mask(layer, mask).filter(F.col("geometry.type") == "MultiPoint").select(
        *keys, F.posexplode("geometry.parts").alias("_k", "_part"))
    placed = several.withColumns({"_x": F.col("_part")[0][0]["x"], "_y": F.col("_part")[0][0]["y"]})
    members = (points_inside(placed, "_x", "_y", mask).groupBy(*keys)
               .agg(F.array_sort(F.collect_list(F.struct("_k", "_part"))).alias("_m"))
               .select(*keys, G.geometry("MultiPoint", F.col("_m").getField("_part")).alias("geometry")))
    return _rejoin(layer, members, keys)


def clip_layer(layer: Layer, mask: Mask) -> Layer:
    """Clip every row by its own type; kinds the layer is known not to hold are left out."""
    if mask.bounds is None:
        return layer.with_df(layer.df.filter(F.lit(False)))
    steps = {"point": (clip_points, clip_multipoints), "line": (clip_lines,), "polygon": (clip_polygons,)}
    wanted = [step for kind, group in steps.items() if layer.may_hold(kind) for step in group]
    if not wanted:
        return layer.with_df(layer.df.filter(F.lit(False)))
    return layer.with_df(union_all([step(layer, mask).df for step in wanted]))


def classify(layer: Layer, mask: Mask) -> DataFrame:
    """``key.., position``: INSIDE, OUTSIDE or BOUNDARY for every feature of the layer.

    INSIDE features do not touch the mask's outline; BOUNDARY ones meet it or hold part of it.  The state of the cells under a
    feature's envelope decides most; only the others are cut into pieces.
    """
    keys = list(layer.key)
    if mask.bounds is None:
        return layer.df.filter(G.is_present("geometry")).select(*keys, F.lit("OUTSIDE").alias("position"))
    df = layer.df.filter(G.is_present("geometry"))
    base = df.select(*keys, F.lit(0).alias("_meets"), F.lit(0).alias("_in"))
    member = df.filter(F.col("geometry.type").isin(*G.POINTS)).select(*keys, F.explode(G.vertices("geometry")).alias("_v"))
    dots = with_leaves(at_cells(member, F.col("_v.x"), F.col("_v.y"), mask), mask)
    x, y = F.col("_v.x"), F.col("_v.y")
    on_edge = F.exists(_edges_here(), lambda e: G.on_segment(e["x1"], e["y1"], e["x2"], e["y2"], x, y))
    within = (F.col("_state") == FULL) | F.coalesce(F.col("_full") | covered(x, y), F.lit(False))
    dots = dots.select(*keys, F.coalesce(on_edge, F.lit(False)).cast("int").alias("_meets"), within.cast("int").alias("_in"))
    near = _candidates(layer.with_df(df), mask, G.LINES + G.POLYGONS)
    proved = near.filter("_position = 'INSIDE'").select(*keys, F.lit(0).alias("_meets"), F.lit(1).alias("_in"))
    open_ = near.filter("_position = 'BOUNDARY'")
    s = F.struct(*_SEGMENT)
    pieces = with_leaves(to_cells(G.explode_segments(open_, keys).select(*keys, *_SEGMENT), mask), mask)
    meets = F.coalesce(F.exists(_edges_here(), lambda e: F.size(_meet(s, e)) > 0), F.lit(False))
    mx, my = (_let(F.struct(_end(s, F.col("t0")).alias("a"), _end(s, F.col("t1")).alias("b")), lambda p: (p["a"][k] + p["b"][k]) / 2) for k in "xy")
    within = (F.col("_state") == FULL) | F.coalesce(F.col("_full") | covered(mx, my, G.near_segment), F.lit(False))
    cut = pieces.select(*keys, meets.cast("int").alias("_meets"), within.cast("int").alias("_in"))
    # A polygon that holds some of the mask's outline without meeting it holds the first vertex of a ring.
    key = keys[0]
    shapes = open_.filter(F.col("geometry.type").isin(*G.POLYGONS)).select(key, "geometry")
    outline = G.explode_segments(shapes, [key]).select(key, *_SEGMENT)
    held = (_mask_pieces(shapes, outline, to_cells(outline, mask), key, mask).select(key).distinct()
            .select(key, F.lit(1).alias("_meets"), F.lit(1).alias("_in")))
    if len(keys) == 1:
        cut = cut.unionByName(held)
    position = (F.when(F.max("_meets") == 1, "BOUNDARY").when(F.max("_in") == 1, "INSIDE").otherwise("OUTSIDE"))
    return base.unionByName(dots).unionByName(proved).unionByName(cut).groupBy(*keys).agg(position.alias("position"))


def _edges_here() -> Column:
    """The mask's edges in the joined leaf."""
    return F.flatten(F.col("_groups").getField("edges"))


def clip_report(layer: Layer, mask: Mask) -> DataFrame:
    """One row: feature counts before and after clipping."""
    before = layer.df.agg(F.count(F.lit(1)).alias("n_before"))
    after = clip_layer(layer, mask).df.agg(F.count(F.lit(1)).alias("n_after"))
    return before.select(F.lit(layer.name).alias("layer"), "n_before", after.scalar().alias("n_after"))
