"""Study-area mask: an adaptive grid over the mask's edges, and point-in-mask tests.

A lattice of at most ``MOST_BASE`` x ``MOST_BASE`` cells covers the mask.  A cell with more than ``EDGES_PER_CELL`` edges is quartered, and so on,
so a cell that is not quartered (a leaf) holds few edges however dense a coast, tall a strip or many the features.  A leaf
knows for each feature in it whether its lower left corner lies inside; a location of the leaf is inside if the path to
that corner, along the row and then down the column, crosses an odd number of the leaf's edges more or less.  Cells without edges
are FULL or EMPTY and need none.

The state of the base cells is a list of fixed length and goes into expressions, so most rows are decided without a join; the
others join one leaf each, by broadcast while the leaves' measured size is small, else by shuffle with hot cells spread.

Several mask features act as one: a location is inside when it is inside any of them.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.joins import sized_join
from stratalake.operators.layers import Layer
from stratalake.operators.lineage import materialize

#: Base cells along each side of the lattice: so many at least and at most, by the number of edges.
LEAST_BASE, MOST_BASE = 8, 64
EDGES_PER_CELL, DEEPEST = 24, 12
#: States of a base cell; others are the number of quarterings below it.
EMPTY, FULL = -1, -2
_LETTER = ord("C")
#: The lattice is a little larger than the mask, by fractions that keep its lines off round coordinates.
_MARGIN, _EXTENT = 0.01373, 1.02917
_EDGE_BYTES, _CELL_BYTES = 48, 96
#: Listing edges a little beyond a cell's limits, in cells, covers rounding.
_PAD = 1e-6
_LEVEL, _COLUMN = 1 << 54, 1 << 27
EDGE = ("x1", "y1", "x2", "y2")


@dataclass(frozen=True)
class Mask:
    """``cells(_key, _level, _cx, _cy, _x0, _y0, _full, _groups: array<struct<mid, odd, edges: array<struct<x1,y1,x2,y2>>>>)``: the
    leaves, with the mask's measured size and bounds.  Edges of shells run counter-clockwise, of holes clockwise."""

    cells: DataFrame | None
    edges: DataFrame
    epsg: int | None
    n_edges: int
    bounds: tuple[float, float, float, float] | None
    directory: tuple[int, ...] = ()
    cell_bytes: int = 0
    n_features: int = 1
    base: int = MOST_BASE

    @property
    def origin(self) -> tuple[float, float]:
        x0, y0, x1, y1 = self.bounds
        return x0 - _MARGIN * ((x1 - x0) or 1.0), y0 - _MARGIN * ((y1 - y0) or 1.0)

    @property
    def size(self) -> tuple[float, float]:
        """Width and height of a base cell."""
        x0, y0, x1, y1 = self.bounds
        return _EXTENT * ((x1 - x0) or 1.0) / self.base, _EXTENT * ((y1 - y0) or 1.0) / self.base

    @property
    def depth(self) -> int:
        return max(self.directory, default=0)

    def dissolved(self) -> Mask:
        """The same area as one feature."""
        return self if self.n_features <= 1 else _dissolve(self)

    def in_bounds(self, x: Column, y: Column) -> Column:
        x0, y0, x1, y1 = self.bounds
        return x.between(F.lit(x0), F.lit(x1)) & y.between(F.lit(y0), F.lit(y1))

    def meets_bounds(self, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
        x0, y0, x1, y1 = self.bounds
        return (xmax >= F.lit(x0)) & (xmin <= F.lit(x1)) & (ymax >= F.lit(y0)) & (ymin <= F.lit(y1))

    def u(self, x: Column) -> Column:
        """Column of the lattice, with its fraction."""
        return (x - F.lit(self.origin[0])) / F.lit(self.size[0])

    def v(self, y: Column) -> Column:
        return (y - F.lit(self.origin[1])) / F.lit(self.size[1])

    def states(self, at: Column, n: Column | int = 1) -> Column:
        """States of n base cells in a row from cell ``at`` on, one letter for each.  The list of all is a constant of bytes, of
        which a stretch is taken without looking at the rest."""
        letters = bytes(_LETTER + state for state in self.directory)
        return F.substring(F.lit(letters), at + 1, F.lit(n) if isinstance(n, int) else n).cast("string")

    def state(self, u: Column, v: Column) -> Column:
        """State of the base cell at a lattice position; EMPTY beyond the lattice and for NULL."""
        cx, cy = F.floor(u).cast("int"), F.floor(v).cast("int")
        known = cx.between(0, self.base - 1) & cy.between(0, self.base - 1)
        return F.when(known, F.ascii(self.states(cy * self.base + cx)) - _LETTER).otherwise(EMPTY)

    def box_position(self, xmin: Column, ymin: Column, xmax: Column, ymax: Column) -> Column:
        """INSIDE if FULL cells cover the box, OUTSIDE if EMPTY ones do, BOUNDARY if the box alone does not tell."""
        x0, x1, y0, y1 = (F.floor(c).cast("int") for c in (self.u(xmin), self.u(xmax), self.v(ymin), self.v(ymax)))
        within = (x0 >= 0) & (y0 >= 0) & (x1 < self.base) & (y1 < self.base)
        first, last = F.greatest(x0, F.lit(0)), F.least(x1, F.lit(self.base - 1))
        rows = F.sequence(F.greatest(y0, F.lit(0)), F.least(y1, F.lit(self.base - 1)))
        all_are = lambda state: F.forall(rows, lambda cy: (
            self.states(cy * self.base + first, last - first + 1) == F.repeat(F.lit(chr(_LETTER + state)), last - first + 1)))
        return (F.when(~self.meets_bounds(xmin, ymin, xmax, ymax), "OUTSIDE").when(within & all_are(FULL), "INSIDE")
                .when(all_are(EMPTY), "OUTSIDE").otherwise("BOUNDARY"))


def cell_key(level: Column, u: Column, v: Column) -> Column:
    """Key of the cell of a level at a lattice position."""
    scale = F.pow(F.lit(2.0), level)
    return level.cast("long") * _LEVEL + F.floor(u * scale).cast("long") * _COLUMN + F.floor(v * scale).cast("long")


def mask_edges(layer: Layer) -> DataFrame:
    """Directed edges ``mid, x1, y1, x2, y2`` with the interior on the left."""
    rings = (layer.df.filter(G.is_present("geometry") & F.col("geometry.type").isin(*G.POLYGONS))
             .select("fid", F.posexplode("geometry.parts").alias("part", "_rings"))
             .select("fid", "part", F.posexplode("_rings").alias("ring", "_path"))
             .withColumn("_path", G.without_repeats(F.col("_path"))))
    counter_clockwise = G.ring_signed_area(F.col("_path")) > 0
    turn = counter_clockwise != (F.col("ring") == 0)
    rings = rings.withColumn("_path", F.when(turn, F.reverse("_path")).otherwise(F.col("_path")))
    return (rings.select(F.struct("fid", "part").alias("mid"),
                         F.explode(G.path_segments(F.col("_path"))).alias("_s"))
                 .select("mid", F.col("_s.a.x").alias("x1"), F.col("_s.a.y").alias("y1"),
                         F.col("_s.b.x").alias("x2"), F.col("_s.b.y").alias("y2")))


def build_mask(layer: Layer) -> Mask:
    """Measure the study area and index its edges."""
    return _indexed(mask_edges(layer), layer.epsg)


def _indexed(edges: DataFrame, epsg: int | None) -> Mask:
    stat = edges.agg(F.count(F.lit(1)).alias("n"), F.min(F.least("x1", "x2")).alias("x0"),
                     F.min(F.least("y1", "y2")).alias("y0"), F.max(F.greatest("x1", "x2")).alias("x1"),
                     F.max(F.greatest("y1", "y2")).alias("y1"), F.countDistinct("mid").alias("features")).first()
    if stat["n"] == 0:
        return Mask(None, edges, epsg, 0, None)
    base = min(max(2 ** math.ceil(math.log2(2 * math.sqrt(stat["n"]))), LEAST_BASE), MOST_BASE)
    mask = Mask(None, edges, epsg, stat["n"], (stat["x0"], stat["y0"], stat["x1"], stat["y1"]), (), 0, stat["features"], base)
    placed = edges.withColumns({"u1": mask.u(F.col("x1")), "v1": mask.v(F.col("y1")), "u2": mask.u(F.col("x2")), "v2": mask.v(F.col("y2"))})
    listed, crossings = _base_cells(placed, base), _row_crossings(placed)
    # Two lists of at most a row for each base cell: edges in it, and how the number of features around its corner changes there.
    odd_here = F.sum("n").over(Window.partitionBy("mid", "row").orderBy(F.desc("col"))) % 2
    change = odd_here - F.coalesce(F.lag("odd").over(Window.partitionBy("mid", "row").orderBy(F.desc("col"))), F.lit(0))
    changes = (crossings.withColumn("odd", odd_here).withColumn("change", change).groupBy("row", "col").agg(F.sum("change").alias("n"))
               .select(F.lit(True).alias("changes"), F.col("row").alias("cy"), F.col("col").alias("cx"), "n"))
    counts = listed.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias("n")).select(F.lit(False).alias("changes"), "cy", "cx", "n")
    n_edges, around = [0] * base * base, [0] * base * base
    for r in changes.unionByName(counts).collect():
        (around if r["changes"] else n_edges)[r["cy"] * base + r["cx"]] = r["n"]
    for k in range(base * base - 2, -1, -1):  # features around a corner: the changes from there to the end of the row
        if k % base != base - 1:
            around[k] += around[k + 1]
    own = (listed.select("mid", "cx", "cy").distinct().join(crossings, (listed["mid"] == crossings["mid"]) & (F.col("row") == F.col("cy"))
                                                            & (F.col("col") >= F.col("cx")), "left")
           .groupBy(listed["mid"], "cx", "cy").agg((F.coalesce(F.sum("n"), F.lit(0)) % 2 == 1).alias("odd")))
    total = F.get(F.split(F.lit(",".join(map(str, around))), ",").cast("array<int>"), (F.col("cy") * base + F.col("cx")).cast("int"))
    others = own.groupBy("cx", "cy").agg(F.count_if("odd").alias("_odd")).select("cx", "cy", (total - F.col("_odd")).alias("others"))
    rows = listed.join(own, ["mid", "cx", "cy"]).join(others, ["cx", "cy"]).withColumn("level", F.lit(0))
    dense = [k for k, n in enumerate(n_edges) if n > EDGES_PER_CELL]
    leaves, blanks = [rows], []
    if dense:
        n_here = F.get(F.split(F.lit(",".join(map(str, n_edges))), ",").cast("array<int>"), (F.col("cy") * base + F.col("cx")).cast("int"))
        todo = (n_here > EDGES_PER_CELL) & (F.col("others") == 0)
        leaves, (more, blanks) = [rows.filter(~todo)], _quartered(rows.filter(todo), mask)
        leaves += more
    cells = materialize(_leaf_rows(leaves, blanks, mask))
    over = lambda c: F.floor(F.col(c) / F.pow(F.lit(2.0), F.col("_level"))).cast("int")
    found = (cells.groupBy(over("_cx").alias("cx"), over("_cy").alias("cy"))
             .agg(F.max("_level").alias("deepest"), F.count(F.lit(1)).alias("cells"),
                  F.sum(F.aggregate("_groups", F.lit(0), lambda n, g: n + F.size(g["edges"]))).alias("listed")).collect())
    directory = [FULL if n > 0 else EMPTY for n in around]
    for r in found:
        directory[r["cy"] * base + r["cx"]] = r["deepest"]
    size = sum(r["cells"] * _CELL_BYTES + r["listed"] * _EDGE_BYTES for r in found)
    return replace(mask, cells=cells, directory=tuple(directory), cell_bytes=size)


def _reach(a1, b1, a2, b2, low: Column, high: Column) -> tuple[Column, Column]:
    """Least and greatest b of an edge where low <= a <= high, whose ends need not lie there."""
    left, right = F.greatest(F.least(a1, a2), low), F.least(F.greatest(a1, a2), high)
    slope = F.when(a1 != a2, (b2 - b1) / F.nullif(a2 - a1, F.lit(0.0)))
    at = lambda a, end: F.coalesce(b1 + (a - a1) * slope, end)
    return F.least(at(left, b1), at(right, b2)), F.greatest(at(left, b1), at(right, b2))


def _base_cells(placed: DataFrame, base: int) -> DataFrame:
    """A row for each edge and base cell it meets."""
    c = F.col
    whole = lambda x: F.least(F.greatest(F.floor(x), F.lit(0)), F.lit(base - 1)).cast("int")
    out = placed.withColumn("cx", F.explode(F.sequence(whole(F.least("u1", "u2") - _PAD), whole(F.greatest("u1", "u2") + _PAD))))
    low, high = _reach(c("u1"), c("v1"), c("u2"), c("v2"), c("cx") - _PAD, c("cx") + (1 + _PAD))
    return out.withColumn("cy", F.explode(F.sequence(whole(low - _PAD), whole(high + _PAD))))


def _row_crossings(placed: DataFrame) -> DataFrame:
    """``mid, row, col, n``: how often a feature's edges cross the lower limit of a row of base cells, by column."""
    c = F.col
    low, high = F.ceil(F.least("v1", "v2")).cast("int"), F.ceil(F.greatest("v1", "v2")).cast("int") - 1
    rows = placed.filter(low <= high).withColumn("row", F.explode(F.sequence(low, high)))
    at = c("u1") + (c("row") - c("v1")) * (c("u2") - c("u1")) / (c("v2") - c("v1"))
    return rows.groupBy("mid", "row", F.floor(at).cast("int").alias("col")).agg(F.count(F.lit(1)).alias("n"))


def _corner(mask: Mask, level: Column, cx: Column, cy: Column) -> tuple[Column, Column]:
    scale = F.pow(F.lit(2.0), level)
    return F.lit(mask.origin[0]) + cx / scale * F.lit(mask.size[0]), F.lit(mask.origin[1]) + cy / scale * F.lit(mask.size[1])


def path_crosses(e, px: Column, py: Column, x0: Column, y0: Column) -> Column:
    """Whether the path from p along its row to x0 and then along that column to (x0, y0) crosses the edge an odd number
    of times.  Both legs take the side of the turning point from the same expression, so they agree on it."""
    side = lambda x, y: G.orient(e["x1"], e["y1"], e["x2"], e["y2"], x, y) > 0
    along = ((e["y1"] > py) != (e["y2"] > py)) & (side(px, py) != side(x0, py))
    down = ((e["x1"] > x0) != (e["x2"] > x0)) & (side(x0, py) != side(x0, y0))
    return along != down


def _quartered(rows: DataFrame, mask: Mask) -> tuple[list[DataFrame], list[DataFrame]]:
    """Leaves below the given cells, as rows of edges, and cells without edges, level by level."""
    c = F.col
    leaves, blanks = [], []
    for level in range(1, DEEPEST + 1):
        rows = materialize(rows)
        if rows.isEmpty():
            break
        quarter = F.explode(F.array(*[F.struct((c("cx") * 2 + a).alias("x"), (c("cy") * 2 + b).alias("y")) for a in (0, 1) for b in (0, 1)]))
        four = rows.withColumns({"_px": c("cx"), "_py": c("cy"), "_q": quarter}).withColumns({"cx": c("_q.x"), "cy": c("_q.y"), "level": F.lit(level)}).drop("_q")
        scale = 2.0 ** level
        low, high = _reach(c("u1") * scale, c("v1") * scale, c("u2") * scale, c("v2") * scale, c("cx") - _PAD, c("cx") + (1 + _PAD))
        meets = ((F.greatest("u1", "u2") * scale >= c("cx") - _PAD) & (F.least("u1", "u2") * scale <= c("cx") + (1 + _PAD))
                 & (high >= c("cy") - _PAD) & (low <= c("cy") + (1 + _PAD)))
        old = _corner(mask, F.lit(level - 1.0), c("_px"), c("_py"))
        new = _corner(mask, F.lit(float(level)), c("cx"), c("cy"))
        four = four.withColumns({"_meets": meets, "_crosses": path_crosses({k: c(k) for k in EDGE}, *new, *old)})
        cell = ["level", "cx", "cy"]
        per = four.groupBy(*cell, "mid").agg((F.any_value("odd") != (F.count_if("_crosses") % 2 == 1)).alias("odd"),
                                             F.any_value("others").alias("_others"), F.count_if("_meets").alias("_n"))
        whole = per.groupBy(*cell).agg(F.sum("_n").alias("n"), (F.any_value("_others") + F.count_if((c("_n") == 0) & c("odd"))).alias("others"))
        blanks.append(whole.filter("n = 0"))
        # The sums of a cell are read twice: by the rows that go on and for cells without edges.
        found = (four.filter("_meets").drop("odd", "others", "_meets", "_crosses", "_px", "_py")
                 .join(per.select(*cell, "mid", "odd"), [*cell, "mid"]).join(whole, cell))
        dense = (c("n") > EDGES_PER_CELL) & (c("others") == 0) if level < DEEPEST else F.lit(False)
        leaves.append(found.filter(~dense).drop("n"))
        rows = found.filter(dense).drop("n")
    return leaves, blanks


def _leaf_rows(leaves: list[DataFrame], blanks: list[DataFrame], mask: Mask) -> DataFrame:
    c = F.col
    cell = ["level", "cx", "cy"]
    edge = F.struct(*EDGE)
    frames = [f.select(*cell, "mid", "odd", "others", edge.alias("edge")) for f in leaves]
    rows = reduce(DataFrame.unionByName, frames)
    full = c("others") > 0
    # A cell inside a feature that has no edge there is full, whatever edges others have.
    cells = (rows.withColumn("edge", F.when(~full, c("edge"))).groupBy(*cell, "others", "mid").agg(F.any_value("odd").alias("odd"), F.collect_list("edge").alias("edges"))
             .groupBy(*cell, "others").agg(F.collect_list(F.struct("mid", "odd", "edges")).alias("_groups")))
    none = F.slice("_groups", F.lit(1), F.lit(0))
    cells = cells.withColumn("_groups", F.when(full, none).otherwise(c("_groups")))
    if blanks:
        kind = cells.schema["_groups"].dataType
        empty = reduce(DataFrame.unionByName, [b.select(*cell, "others", F.array().cast(kind).alias("_groups")) for b in blanks])
        cells = cells.unionByName(empty)
    x0, y0 = _corner(mask, c("level").cast("double"), c("cx"), c("cy"))
    return cells.select((c("level").cast("long") * _LEVEL + c("cx").cast("long") * _COLUMN + c("cy").cast("long")).alias("_key"),
                        c("level").cast("int").alias("_level"), c("cx").cast("int").alias("_cx"), c("cy").cast("int").alias("_cy"),
                        x0.alias("_x0"), y0.alias("_y0"), full.alias("_full"), "_groups")


def _dissolve(mask: Mask) -> Mask:
    """Outline of the union of the mask's features, as one group.

    Edges are cut where features meet; a piece inside another feature is dropped, a shared border is
    kept once when both interiors lie on the same side and dropped otherwise.
    """
    from stratalake.operators.contacts import grid_of, self_contacts
    from stratalake.operators.repair import split_segments
    own = F.xxhash64("mid")
    length = F.hypot(F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    size = mask.edges.agg(F.avg(length) * 2).first()[0]
    segments = mask.edges.select(
        F.lit(0).alias("one"), F.lit(size).alias("cell"), own.alias("part"), F.lit(0).alias("ring"),
        F.xxhash64("x1", "y1", "x2", "y2").alias("i"), F.lit(0).cast("long").alias("n"), "x1", "y1", "x2", "y2")
    pieces = split_segments(segments, self_contacts(segments, "one", grid_of(mask.epsg)), "one")
    pieces = pieces.withColumns({"mx": (F.col("ax") + F.col("bx")) / 2, "my": (F.col("ay") + F.col("by")) / 2})
    mx, my = F.col("mx"), F.col("my")

    def hidden(g):
        other = F.xxhash64(g["mid"])
        edges = g["edges"]
        along = lambda e: G.near_segment(e["x1"], e["y1"], e["x2"], e["y2"], mx, my)
        forward = lambda e: ((e["x2"] - e["x1"]) * (F.col("bx") - F.col("ax"))
                             + (e["y2"] - e["y1"]) * (F.col("by") - F.col("ay"))) > 0
        on = F.exists(edges, along)
        same = F.exists(edges, lambda e: along(e) & forward(e))
        return (other != F.col("part")) & F.when(on, ~same | (other < F.col("part"))).otherwise(odd_at(g, mx, my))
    outline = (with_leaves(at_cells(pieces, mx, my, mask), mask).filter(~F.col("_full") & ~F.exists("_groups", hidden))
               .select(F.struct(F.lit(0).cast("long").alias("fid"), F.lit(0).alias("part")).alias("mid"),
                       F.col("ax").alias("x1"), F.col("ay").alias("y1"), F.col("bx").alias("x2"), F.col("by").alias("y2")))
    return _indexed(materialize(outline), mask.epsg)


def odd_at(group, x: Column, y: Column) -> Column:
    """Parity of one feature of the joined leaf at a location in it."""
    return F.aggregate(group["edges"], group["odd"], lambda acc, e: acc != path_crosses(e, x, y, F.col("_x0"), F.col("_y0")))


def covered(x: Column, y: Column, on=G.on_segment) -> Column:
    """Whether a location lies inside any feature of the joined leaf, boundaries included."""
    return F.exists("_groups", lambda g: odd_at(g, x, y) | F.exists(g["edges"], lambda e: on(e["x1"], e["y1"], e["x2"], e["y2"], x, y)))


WHOLE = -1


def whole_leaf(mask: Mask) -> DataFrame:
    """All edges of a mask of at most ``EDGES_PER_CELL`` as one leaf, of key ``WHOLE``; its corner lies outside every feature."""
    groups = mask.edges.groupBy("mid").agg(F.collect_list(F.struct(*EDGE)).alias("edges"))
    # The key is an aggregate, as the optimizer would make a loop of a join on a constant.
    return groups.agg(F.max(F.lit(WHOLE).cast("bigint")).alias("_key"), F.collect_list(F.struct(
        "mid", F.lit(False).alias("odd"), "edges")).alias("_groups")).select(
        "_key", F.lit(False).alias("_full"), "_groups",
        F.lit(mask.origin[0] - mask.size[0]).alias("_x0"), F.lit(mask.origin[1] - mask.size[1]).alias("_y0"))


def at_cells(df: DataFrame, x: Column, y: Column, mask: Mask) -> DataFrame:
    """Rows with the ``_state`` of their base cell and the ``_key`` of the leaf they may lie in: none where the state decides, one
    row for each level below a quartered cell."""
    u, v = mask.u(x), mask.v(y)
    out = df.withColumn("_state", F.when(mask.in_bounds(x, y), mask.state(u, v)).otherwise(EMPTY))
    base = F.when(F.col("_state") == 0, cell_key(F.lit(0), u, v))
    if mask.depth <= 0:
        return out.withColumn("_key", base)
    below = F.transform(F.sequence(F.lit(1), F.col("_state")), lambda level: cell_key(level, u, v))
    return out.withColumn("_key", F.explode(F.when(F.col("_state") > 0, below).otherwise(F.array(base))))


def with_leaves(df: DataFrame, mask: Mask, leaves: DataFrame | None = None) -> DataFrame:
    """Attach ``_full, _groups, _x0, _y0`` of the leaf of each row's ``_key``.  Rows without a key stay, with NULLs; of a row at
    several levels, the one whose cell is a leaf."""
    leaves = mask.cells.select("_key", "_full", "_groups", "_x0", "_y0") if leaves is None else leaves
    return sized_join(df, leaves, ["_key"], mask.cell_bytes, "left").filter(F.col("_key").isNull() | F.col("_full").isNotNull())


def flag_inside(df: DataFrame, x: str, y: str, mask: Mask, flag: str = "inside") -> DataFrame:
    """Every row, with a flag telling whether its location is inside the mask, boundary included."""
    if mask.bounds is None:
        return df.withColumn(flag, F.lit(False))
    columns = [F.col(f"`{c}`") for c in df.columns]
    joined = with_leaves(at_cells(df, F.col(x), F.col(y), mask), mask)
    inside = (F.col("_state") == FULL) | F.coalesce(F.col("_full") | covered(F.col(x), F.col(y)), F.lit(False))
    return joined.select(*columns, inside.alias(flag))


def points_inside(df: DataFrame, x: str, y: str, mask: Mask) -> DataFrame:
    """Rows whose location is inside the mask, boundary included, unchanged."""
    if mask.bounds is None:
        return df.filter(F.lit(False))
    near = df.filter(mask.in_bounds(F.col(x), F.col(y)) & (mask.state(mask.u(F.col(x)), mask.v(F.col(y))) != EMPTY))
    return flag_inside(near, x, y, mask, "_inside").filter("_inside").drop("_inside")
