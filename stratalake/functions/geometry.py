"""Geometry as nested structs, and the Column expressions that build and read it.

A geometry is ``struct<type, parts>`` where ``parts`` is part -> ring/path -> vertex.  Points hold
one vertex, lines one path per part, polygons ``[shell, hole, ...]`` per part with closed rings.
Everything here is a plain expression: no shuffle, no Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

VERTEX = "struct<x:double,y:double>"
PATH = f"array<{VERTEX}>"
GEOMETRY = f"struct<type:string,parts:array<array<{PATH}>>>"

ENVELOPE = ("xmin", "ymin", "xmax", "ymax")
POINTS = ("Point", "MultiPoint")
LINES = ("LineString", "MultiLineString")
POLYGONS = ("Polygon", "MultiPolygon")


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vertex(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def geometry(kind: Column | str, parts: Column) -> Column:
    kind = F.lit(kind) if isinstance(kind, str) else kind
    return F.struct(kind.alias("type"), parts.alias("parts"))


def point(x: Column | str, y: Column | str) -> Column:
    """Point geometry; NULL when either coordinate is missing."""
    x, y = col(x).cast("double"), col(y).cast("double")
    built = geometry("Point", F.array(F.array(F.array(vertex(x, y)))))
    return F.when(x.isNotNull() & y.isNotNull(), built)


def linestring(path: Column) -> Column:
    return geometry("LineString", F.array(F.array(path)))


def polygon(*rings: Column) -> Column:
    return geometry("Polygon", F.array(F.array(*rings)))


def from_parts(parts: Column, single: str) -> Column:
    """Single or Multi type, whichever fits the number of parts; NULL when there is none."""
    kind = F.when(F.size(parts) == 1, F.lit(single)).otherwise(F.lit("Multi" + single))
    return F.when(F.size(parts) > 0, geometry(kind, parts))


def point_x(g: Column | str) -> Column:
    return col(g)["parts"][0][0][0]["x"]


def point_y(g: Column | str) -> Column:
    return col(g)["parts"][0][0][0]["y"]


def vertices(g: Column | str) -> Column:
    """All vertices of a geometry as one flat array."""
    return F.flatten(F.flatten(col(g)["parts"]))


def n_vertices(g: Column | str) -> Column:
    return F.size(vertices(g))


def is_present(g: Column | str) -> Column:
    """Not null and holding at least one vertex."""
    g = col(g)
    return F.coalesce(g.isNotNull() & (F.size(vertices(g)) > 0), F.lit(False))


def envelope_columns(g: Column | str = "geometry") -> dict[str, Column]:
    v = vertices(g)
    return {
        "xmin": F.array_min(v.getField("x")),
        "ymin": F.array_min(v.getField("y")),
        "xmax": F.array_max(v.getField("x")),
        "ymax": F.array_max(v.getField("y")),
    }


def with_envelope(df: DataFrame, g: str = "geometry") -> DataFrame:
    """Append xmin, ymin, xmax, ymax, the columns Parquet min/max pruning works on."""
    return df.withColumns(envelope_columns(g))


def without_repeats(path: Column) -> Column:
    """Path with consecutive equal vertices collapsed."""
    return F.filter(path, lambda v, i: (i == 0) | (v != F.get(path, i - 1)))


def path_segments(path: Column) -> Column:
    """array<struct<a, b>> of consecutive vertex pairs."""
    n = F.greatest(F.size(path) - 1, F.lit(0))
    return F.zip_with(F.slice(path, F.lit(1), n), F.slice(path, F.lit(2), n),
                      lambda a, b: F.named_struct(F.lit("a"), a, F.lit("b"), b))


def ring_signed_area(path: Column) -> Column:
    """Shoelace area, positive for counter-clockwise rings; taken about the first vertex so that
    large coordinates do not cancel."""
    o = path[0]
    return F.aggregate(
        path_segments(path),
        F.lit(0.0),
        lambda acc, s: acc
        + (s["a"]["x"] - o["x"]) * (s["b"]["y"] - o["y"])
        - (s["b"]["x"] - o["x"]) * (s["a"]["y"] - o["y"]),
        lambda acc: acc / 2,
    )


def polygon_area(g: Column | str) -> Column:
    """Shells minus holes, summed over parts."""
    return F.aggregate(
        col(g)["parts"],
        F.lit(0.0),
        lambda acc, rings: acc
        + F.aggregate(
            F.transform(rings, lambda r, i: F.when(i == 0, F.abs(ring_signed_area(r)))
                        .otherwise(-F.abs(ring_signed_area(r)))),
            F.lit(0.0), lambda a, v: a + v),
    )


def line_length(g: Column | str) -> Column:
    paths = F.flatten(col(g)["parts"])
    lengths = F.flatten(F.transform(paths, lambda p: F.transform(
        path_segments(p),
        lambda s: F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]))))
    return F.aggregate(lengths, F.lit(0.0), lambda a, v: a + v)


def settle(df: DataFrame, g: str = "geometry") -> DataFrame:
    """Compute a derived geometry once per row.

    Filters on a computed column are pushed below the projection that makes it, so the geometry would
    be rebuilt for every mention in them, inside lambdas for every vertex.  A generator over one
    element stops that.  Stored geometries need no such step.
    """
    others = [c for c in df.columns if c != g]
    return df.select(*others, F.inline(F.array(F.struct(F.col(g).alias(g))))).select(*df.columns)


def explode_vertices(df: DataFrame, keep: list[str], g: str = "geometry") -> DataFrame:
    """View ``keep..., part, ring, i, x, y``: three chained explodes, no shuffle."""
    out = df.select(*keep, F.posexplode(F.col(g)["parts"]).alias("part", "_rings"))
    out = out.select(*keep, "part", F.posexplode("_rings").alias("ring", "_path"))
    out = out.select(*keep, "part", "ring", F.posexplode("_path").alias("i", "_v"))
    return out.select(*keep, "part", "ring", "i", F.col("_v.x").alias("x"), F.col("_v.y").alias("y"))


def explode_segments(df: DataFrame, keep: list[str], g: str = "geometry") -> DataFrame:
    """View ``keep..., cell, part, ring, i, n, x1, y1, x2, y2`` without zero-length segments.

    ``i`` counts segments along the path and ``n`` is their number; ``cell`` is twice the feature's
    mean segment length, the grid size its segments are joined on.  A path stored in several rows
    (see ``operators.layers.assemble_paths``) brings ``seg_base``, ``seg_total`` and ``seg_cell``
    columns, which make ``i``, ``n`` and ``cell`` those of the whole path, and after noding ``part_base``,
    which does the same for ``part``.
    """
    based, parted = "seg_base" in df.columns, "part_base" in df.columns
    lengths = F.flatten(F.transform(F.flatten(F.col(g)["parts"]), lambda p: F.transform(
        path_segments(p), lambda s: F.hypot(s["b"]["x"] - s["a"]["x"], s["b"]["y"] - s["a"]["y"]))))
    total = F.aggregate(lengths, F.lit(0.0), lambda a, v: a + v)
    cell = F.coalesce(F.nullif(total * 2 / F.greatest(F.size(lengths), F.lit(1)), F.lit(0.0)), F.lit(1.0))
    cell = F.coalesce(F.col("seg_cell"), cell) if based else cell
    extra = ["seg_base", "seg_total"] if based else []
    # A generator of one row (see ``settle``): else the size would be worked out anew for every part.
    once = F.struct(cell.alias("cell"), F.col(g)["parts"].alias("_parts"))
    bases = [*extra, *(["part_base"] if parted else [])]
    out = df.select(*keep, *bases, F.inline(F.array(once)))
    out = out.select(*keep, *bases, "cell", F.posexplode("_parts").alias("part", "_rings"))
    if parted:
        out = out.withColumn("part", F.col("part") + F.coalesce("part_base", F.lit(0)))
    keep = [*keep, "cell"]
    out = out.select(*keep, *extra, "part", F.posexplode("_rings").alias("ring", "_path"))
    path = F.col("_path") if based else without_repeats(F.col("_path"))
    out = out.select(*keep, *extra, "part", "ring", path_segments(path).alias("_segs"))
    n = F.size("_segs").cast("long")
    n = F.coalesce(F.col("seg_total"), n) if based else n
    out = out.select(*keep, *extra, "part", "ring", n.alias("n"), F.posexplode("_segs").alias("i", "_s"))
    i = F.col("i").cast("long")
    i = i + F.coalesce(F.col("seg_base"), F.lit(0)) if based else i
    return out.select(*keep, "part", "ring", i.alias("i"), "n",
                      F.col("_s.a.x").alias("x1"), F.col("_s.a.y").alias("y1"),
                      F.col("_s.b.x").alias("x2"), F.col("_s.b.y").alias("y2"))


def orient(ax, ay, bx, by, px, py) -> Column:
    """Twice the signed area of triangle a, b, p: positive when p lies left of a->b."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def crosses_upward_ray(x1, y1, x2, y2, px, py) -> Column:
    """Does the ray from p towards +x meet the edge?  Half-open in y, so a shared vertex counts once."""
    return ((y1 > py) != (y2 > py)) & (px < (x2 - x1) * (py - y1) / (y2 - y1) + x1)


def on_segment(x1, y1, x2, y2, px, py) -> Column:
    return ((orient(x1, y1, x2, y2, px, py) == 0)
            & px.between(F.least(x1, x2), F.greatest(x1, x2))
            & py.between(F.least(y1, y2), F.greatest(y1, y2)))


def near_segment(x1, y1, x2, y2, px, py) -> Column:
    """On the segment within rounding of the coordinates, for locations that were computed."""
    slack = 1e-13 * (F.abs(px) + F.abs(py)) * (F.abs(x2 - x1) + F.abs(y2 - y1))
    pad = 1e-14 * (F.abs(px) + F.abs(py))
    return ((F.abs(orient(x1, y1, x2, y2, px, py)) <= slack)
            & px.between(F.least(x1, x2) - pad, F.greatest(x1, x2) + pad)
            & py.between(F.least(y1, y2) - pad, F.greatest(y1, y2) + pad))
