"""Where segments of one feature meet, with exact predicates: pairs within the row for features of few segments,
an equi-join on (feature, grid cell) for the others.

In the join a segment is listed in the cells it runs through, so a pair is only formed inside a shared
cell and a long feature is spread over many tasks.  A contact is reported in the one cell that holds its
location, so no ``distinct`` is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.lineage import materialize

_PAD = 1e-6
# Features of at most so many segments are paired within their row: 496 pairs.
ROW_SEGMENTS = 32
# So many keys of features that need the join are sent to every task; more are joined by shuffle.
_BROADCAST_KEYS = 200_000
_NAMES = ("part", "ring", "i", "n", "x1", "y1", "x2", "y2")


def with_cells(segments: DataFrame) -> DataFrame:
    """One row per segment and cell ``cx, cy`` it runs through, on the grid of size ``cell``."""
    out = segments
    size = F.col("cell")
    pad = size * _PAD
    lo, hi = F.least("x1", "x2"), F.greatest("x1", "x2")
    out = out.withColumn("cx", F.explode(F.sequence(F.floor((lo - pad) / size), F.floor((hi + pad) / size))))
    left = F.greatest(lo, F.col("cx") * size - pad)
    right = F.least(hi, (F.col("cx") + 1) * size + pad)
    steep = F.col("x1") == F.col("x2")
    slope = (F.col("y2") - F.col("y1")) / F.when(~steep, F.col("x2") - F.col("x1"))
    ya = F.when(steep, F.col("y1")).otherwise(F.col("y1") + (left - F.col("x1")) * slope)
    yb = F.when(steep, F.col("y2")).otherwise(F.col("y1") + (right - F.col("x1")) * slope)
    out = out.withColumns({"_ya": F.least(ya, yb) - pad, "_yb": F.greatest(ya, yb) + pad})
    return out.withColumn("cy", F.explode(F.sequence(F.floor(F.col("_ya") / size), F.floor(F.col("_yb") / size)))) \
              .drop("_ya", "_yb")


def _no_hits() -> Column:
    return F.array().cast("array<struct<kind:string,px:double,py:double,ta:double,tb:double>>")


def _hit(kind, px, py, ta, tb) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("kind"), px.alias("px"), py.alias("py"), ta.alias("ta"), tb.alias("tb"))


def grid_of(epsg: int | None) -> float:
    """Grid points in a unit, for computed crossings: a nanodegree, or a micrometre in projected systems."""
    return 1e9 if epsg in (None, 4326) else 1e6


def _snap(p: Column, grid: float) -> Column:
    """Computed crossings on the layer's fine grid, so that one place reached from several segment pairs is
    one vertex."""
    return F.floor(p * F.lit(grid) + 0.5) / F.lit(grid)


def with_hits(pairs: DataFrame, grid: float = 1e9) -> DataFrame:
    """Meeting points ``kind, px, py, ta, tb`` of the segments in ``a_x1 .. a_y2`` and ``b_x1 .. b_y2``.

    A pair that crosses or touches has one row, a collinear overlap two (its ends).  ``ta`` and ``tb``
    are the positions along either segment; vertices are returned exactly.
    """
    c = F.col
    a1, a2 = (c("a_x1"), c("a_y1")), (c("a_x2"), c("a_y2"))
    b1, b2 = (c("b_x1"), c("b_y1")), (c("b_x2"), c("b_y2"))
    boxes = ((F.least(a1[0], a2[0]) <= F.greatest(b1[0], b2[0])) & (F.least(b1[0], b2[0]) <= F.greatest(a1[0], a2[0]))
             & (F.least(a1[1], a2[1]) <= F.greatest(b1[1], b2[1])) & (F.least(b1[1], b2[1]) <= F.greatest(a1[1], a2[1])))
    out = pairs.filter(boxes).withColumns({
        "d1": G.orient(*a1, *a2, *b1), "d2": G.orient(*a1, *a2, *b2),
        "d3": G.orient(*b1, *b2, *a1), "d4": G.orient(*b1, *b2, *a2)})
    flat = (c("d1") == 0) & (c("d2") == 0)
    sides = (F.signum("d1") * F.signum("d2") <= 0) & (F.signum("d3") * F.signum("d4") <= 0)
    ta = F.when(c("d3") == 0, 0.0).when(c("d4") == 0, 1.0).when(~flat & sides, c("d3") / F.nullif(c("d3") - c("d4"), F.lit(0.0)))
    tb = F.when(c("d1") == 0, 0.0).when(c("d2") == 0, 1.0).when(~flat & sides, c("d1") / F.nullif(c("d1") - c("d2"), F.lit(0.0)))
    ux, uy = a2[0] - a1[0], a2[1] - a1[1]
    vx, vy = b2[0] - b1[0], b2[1] - b1[1]
    uu, vv = F.nullif(ux * ux + uy * uy, F.lit(0.0)), F.nullif(vx * vx + vy * vy, F.lit(0.0))
    along_a = lambda p: ((p[0] - a1[0]) * ux + (p[1] - a1[1]) * uy) / uu
    along_b = lambda p: ((p[0] - b1[0]) * vx + (p[1] - b1[1]) * vy) / vv
    out = out.withColumns({
        "ta": ta, "tb": tb, "flat": flat,
        "s1": F.when(flat, along_a(b1)), "s2": F.when(flat, along_a(b2)),
        "r1": F.when(flat, along_b(a1)), "r2": F.when(flat, along_b(a2))})
    # Collinear: the shared stretch runs from lo to hi along a.
    out = out.withColumns({"lo": F.greatest(F.lit(0.0), F.least("s1", "s2")),
                           "hi": F.least(F.lit(1.0), F.greatest("s1", "s2"))})

    def end(t, kind):
        at_a = F.when(t == 0, _hit(kind, *a1, t, c("r1"))).when(t == 1, _hit(kind, *a2, t, c("r2")))
        return at_a.when(t == c("s1"), _hit(kind, *b1, t, F.lit(0.0))).otherwise(_hit(kind, *b2, t, F.lit(1.0)))
    px = (F.when(c("ta") == 0, a1[0]).when(c("ta") == 1, a2[0]).when(c("tb") == 0, b1[0])
          .when(c("tb") == 1, b2[0]).otherwise(_snap(a1[0] + c("ta") * ux, grid)))
    py = (F.when(c("ta") == 0, a1[1]).when(c("ta") == 1, a2[1]).when(c("tb") == 0, b1[1])
          .when(c("tb") == 1, b2[1]).otherwise(_snap(a1[1] + c("ta") * uy, grid)))
    inner = (c("ta") > 0) & (c("ta") < 1) & (c("tb") > 0) & (c("tb") < 1)
    kind = F.when(inner, "cross").otherwise("touch")
    hits = (F.when(c("flat") & (c("lo") < c("hi")), F.array(end(c("lo"), "overlap"), end(c("hi"), "overlap")))
            .when(c("flat") & (c("lo") == c("hi")), F.array(end(c("lo"), "touch")))
            .when(~c("flat") & sides, F.array(_hit(kind, px, py, c("ta"), c("tb")))).otherwise(_no_hits()))
    # The generator takes the expression itself: on a named array column the optimizer would infer a
    # non-empty filter and push the whole computation into it.
    return out.select(*pairs.columns, F.inline(hits))


def self_contacts(segments: DataFrame, key: str = "fid", grid: float = 1e9) -> DataFrame:
    """Contacts between segments of the same feature, neighbours along a path excepted.

    Input ``key, cell, part, ring, i, n, x1, y1, x2, y2``; output ``key, part_a, ring_a, i_a, n_a, part_b,
    ring_b, i_b, n_b, kind, px, py, ta, tb`` with kind ``cross``, ``touch`` or ``overlap``.  Overlaps
    of neighbouring segments (spikes) are reported.
    """
    celled = with_cells(segments)
    a = celled.select(key, "cx", "cy", "cell", *[F.col(c).alias(f"a_{c}") for c in _NAMES])
    b = celled.select(key, "cx", "cy", *[F.col(c).alias(f"b_{c}") for c in _NAMES])
    c = F.col
    before = ((c("a_part") < c("b_part")) | ((c("a_part") == c("b_part")) & (
        (c("a_ring") < c("b_ring")) | ((c("a_ring") == c("b_ring")) & (c("a_i") < c("b_i"))))))
    pairs = a.join(b, [key, "cx", "cy"]).filter(before)
    here = (F.floor(c("px") / c("cell")) == c("cx")) & (F.floor(c("py") / c("cell")) == c("cy"))
    return _contacts(with_hits(pairs, grid).filter(here), key)


def _contacts(hits: DataFrame, key: str) -> DataFrame:
    """The hits that count as contacts, in the columns of ``self_contacts``."""
    c = F.col
    same_path = (c("a_part") == c("b_part")) & (c("a_ring") == c("b_ring"))
    wraps = ((c("a_i") == 0) & (c("b_i") == c("b_n") - 1) & (c("a_x1") == c("b_x2")) & (c("a_y1") == c("b_y2")))
    neighbours = same_path & ((c("b_i") == c("a_i") + 1) | wraps)
    return hits.filter(~(neighbours & (c("kind") != "overlap"))).select(
        key, *[c(f"{s}_{n}").alias(f"{n}_{s}") for s in "ab" for n in ("part", "ring", "i", "n")],
        "kind", "px", "py", "ta", "tb",
        *[c(f"{s}_{n}").alias(f"{n}_{s}") for s in "ab" for n in ("x1", "y1", "x2", "y2")])


def _row_pairs(features: DataFrame, key: str) -> DataFrame:
    """``key, a_part .. a_y2, b_part .. b_y2``: every two segments of a row, the earlier as ``a``."""
    based, parted = "seg_base" in features.columns, "part_base" in features.columns
    paths = F.col("geometry.parts")
    paths = paths if based else F.transform(paths, lambda rings: F.transform(rings, G.without_repeats))
    part_base = F.coalesce("part_base", F.lit(0)) if parted else F.lit(0)
    base = F.coalesce("seg_base", F.lit(0)).cast("long") if based else F.lit(0).cast("long")
    total = F.col("seg_total") if based else F.lit(None).cast("long")

    def of(path, p, r):
        n = F.coalesce(total, F.greatest(F.size(path) - 1, F.lit(0)).cast("long"))
        values = lambda s, i: (p + part_base, r, i.cast("long") + base, n, s["a"]["x"], s["a"]["y"], s["b"]["x"], s["b"]["y"])
        return F.transform(G.path_segments(path), lambda s, i: F.struct(*[v.alias(c) for v, c in zip(values(s, i), _NAMES)]))
    listed = F.flatten(F.flatten(F.transform("_paths", lambda rings, p: F.transform(rings, lambda path, r: of(path, p, r)))))
    # Generators of one row (see ``G.settle``): each list is made once.
    once = features.select(key, *[c for c in ("seg_base", "seg_total", "part_base") if c in features.columns],
                           F.inline(F.array(F.struct(paths.alias("_paths")))))
    once = once.select(key, F.inline(F.array(F.struct(listed.alias("_segs")))))
    first = once.select(key, "_segs", F.posexplode("_segs").alias("_k", "a"))
    both = first.select(key, "a", F.explode(F.slice("_segs", F.col("_k") + 2, F.size("_segs"))).alias("b"))
    return both.select(key, *[F.col(f"{s}.{n}").alias(f"{s}_{n}") for s in "ab" for n in _NAMES])


def feature_contacts(features: DataFrame, key: str, grid: float = 1e9) -> DataFrame:
    """``self_contacts`` of the features ``key, geometry`` and, where stored, the columns that place a row in its path.

    A feature in one row of at most ``ROW_SEGMENTS`` segments is paired there, with no shuffle.  Those with more,
    in several rows, or under a key that repeats are paired by the join.
    """
    features = features.filter(F.col(key).isNotNull()).select(
        key, "geometry", *[c for c in ("seg_base", "seg_total", "seg_cell", "part_base") if c in features.columns])
    size = F.aggregate(F.flatten("geometry.parts"), F.lit(0), lambda n, path: n + F.greatest(F.size(path) - 1, F.lit(0)))
    apart = materialize(features.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.max(size).alias("_size"))
                        .filter(f"_rows > 1 or _size > {ROW_SEGMENTS}").select(key))
    n_apart = apart.count()
    if n_apart == 0:
        return _contacts(with_hits(_row_pairs(features, key), grid), key)
    apart = F.broadcast(apart) if n_apart <= _BROADCAST_KEYS else apart
    short = _contacts(with_hits(_row_pairs(features.join(apart, key, "left_anti"), key), grid), key)
    return self_contacts(G.explode_segments(features.join(apart, key, "left_semi"), [key]), key, grid).unionByName(short)
