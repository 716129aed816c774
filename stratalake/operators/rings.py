"""How the rings of polygons lie to each other: which lie in which, and which touch in a circle.

Both are joins of rings, so a feature of many islands or holes is spread over tasks like any other rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.graph import components
from stratalake.operators.joins import skew_join
from stratalake.operators.lineage import materialize

#: Places along the first edge of a ring that tell on which side of another ring it lies.
_PROBES = (0.5, 0.382, 0.146)


def _band_height() -> Column:
    """Height of the bands a feature's edges are listed in: at least their mean height, so that an edge lies in
    two bands on average, and no more bands than rings."""
    rings = F.flatten("geometry.parts")
    heights = F.flatten(F.transform(rings, lambda r: F.transform(
        G.path_segments(r), lambda s: F.abs(s["b"]["y"] - s["a"]["y"]))))
    mean = F.aggregate(heights, F.lit(0.0), lambda t, h: t + h) / F.greatest(F.size(heights), F.lit(1))
    ys = G.vertices("geometry").getField("y")
    height = F.greatest(mean, (F.array_max(ys) - F.array_min(ys)) / F.size(rings))
    return F.coalesce(F.nullif(height, F.lit(0.0)), F.lit(1.0))


def containments(polygons: DataFrame, key: str) -> DataFrame:
    """``key, part, ring, in_part, in_ring``: every ring and each other ring of its feature that holds it.

    For rings that meet in single points at most.  A ring is tried by places on its first edge; a place on the other
    ring says nothing.  Edges and places meet in horizontal bands, and parity is summed over the bands' pairs.
    """
    return _held(materialize(polygons.select(key, "geometry", _band_height().alias("_band"))), key)


def _held(df: DataFrame, key: str) -> DataFrame:
    edges = G.explode_segments(df, [key, "_band"]).drop("cell", "n")
    along = lambda t: F.struct((F.col("x1") + t * (F.col("x2") - F.col("x1"))).alias("px"),
                               (F.col("y1") + t * (F.col("y2") - F.col("y1"))).alias("py"), F.lit(t).alias("_t"))
    places = edges.filter("i = 0").select(
        key, "_band", "part", "ring", F.inline(F.array(*[along(t) for t in _PROBES])))
    places = places.withColumn("_b", F.floor(F.col("py") / F.col("_band"))).drop("_band")
    banded = edges.select(
        key, F.col("part").alias("in_part"), F.col("ring").alias("in_ring"), "x1", "y1", "x2", "y2",
        F.explode(F.sequence(F.floor(F.least("y1", "y2") / F.col("_band")),
                             F.floor(F.greatest("y1", "y2") / F.col("_band")))).alias("_b"))
    ends = ("x1", "y1", "x2", "y2", "px", "py")
    crossed, on = G.crosses_upward_ray(*map(F.col, ends)), G.on_segment(*map(F.col, ends))
    other = (F.col("part") != F.col("in_part")) | (F.col("ring") != F.col("in_ring"))
    met = skew_join(banded, places, [key, "_b"]).filter(other & (crossed | on))
    pair = [key, "part", "ring", "in_part", "in_ring"]
    sides = met.groupBy(*pair, "_t").agg((F.count_if(crossed) % 2 == 1).alias("_odd"), F.bool_or(on).alias("_on"))
    return sides.groupBy(*pair).agg(F.bool_or(F.col("_odd") & ~F.col("_on")).alias("_in")).filter("_in").drop("_in")


def nesting_faults(polygons: DataFrame, key: str, stray: int, nested_holes: int, nested_shells: int) -> DataFrame:
    """``key, _nesting``: the least of the given codes that applies, for features whose rings lie wrongly: a hole out of
    its shell, a hole in another hole of the part, a shell inside another part."""
    parts = F.col("geometry.parts")
    several = polygons.filter((F.size(parts) > 1) | F.exists(parts, lambda rings: F.size(rings) > 1))
    several = materialize(several.select(key, "geometry", _band_height().alias("_band")))
    if several.isEmpty():
        return several.select(key, F.lit(None).cast("int").alias("_nesting")).limit(0)
    c = F.col
    held = _held(several, key)
    # One row for each ring, so that a hole that nothing holds is seen.
    rings = several.select(key, F.posexplode("geometry.parts").alias("part", "_rings")).select(
        key, "part", F.explode(F.sequence(F.lit(0), F.size("_rings") - 1)).alias("ring"),
        F.col("part").alias("in_part"), F.lit(None).cast("int").alias("in_ring"))
    own = c("part") == c("in_part")
    sums = held.unionByName(rings).groupBy(key, "part", "ring", "in_part").agg(
        F.count("in_ring").alias("_n"), F.count_if(own & (c("in_ring") == 0)).alias("_shell"),
        F.count_if(own & (c("in_ring") > 0)).alias("_holes"))
    code = (F.when(own & (c("ring") > 0) & (c("_shell") == 0), stray)
            .when(own & (c("ring") > 0) & (c("_holes") > 0), nested_holes)
            .when(~own & (c("ring") == 0) & (c("_n") % 2 == 1), nested_shells))
    return sums.withColumn("_nesting", code).filter("_nesting is not null").groupBy(key).agg(F.min("_nesting").alias("_nesting"))


def _touching(touches: DataFrame, key: str) -> DataFrame:
    """``key, part, ring, px, py`` without the rings and places that cannot be on a circle: those with one link."""
    pairs = touches.select(key, "part", F.explode(F.array("ring_a", "ring_b")).alias("ring"), "px", "py").distinct()
    for node in (["ring"], ["px", "py"], ["ring"]):
        named = [key, "part", *node]
        linked = pairs.groupBy(*named).count().filter("count > 1").select(*named)
        pairs = pairs.join(linked, named, "left_semi").select(key, "part", "ring", "px", "py")
    return materialize(pairs)


def circles(touches: DataFrame, key: str) -> DataFrame:
    """``key, px, py``: features whose rings touch in a circle, with the least place on the circle's component.

    Input ``key, part, ring_a, ring_b, px, py``, already stored.  Rings and places are the nodes of a graph, each
    place linked to the rings that meet there; such a graph has a circle if a component has as many links as nodes.
    """
    pairs = _touching(touches, key)
    none = touches.select(key, "px", "py").limit(0)
    if pairs.isEmpty():
        return none
    node = lambda kind, ring, x, y: F.struct(
        F.col(key).alias("key"), F.col("part").alias("part"), F.lit(kind).alias("kind"),
        ring.cast("int").alias("ring"), x.alias("x"), y.alias("y"))
    ring = node(1, F.col("ring"), F.lit(0.0), F.lit(0.0))
    place = node(0, F.lit(0), F.col("px"), F.col("py"))
    links = pairs.select(ring.alias("a"), place.alias("b"))
    # Places sort before rings, so a component's least node is its least place.
    rooted = components(links)
    nodes = rooted.groupBy("root").agg(F.count(F.lit(1)).alias("_nodes"))
    joined = links.select(F.col("b").alias("node")).join(rooted, "node").groupBy("root").agg(F.count(F.lit(1)).alias("_links"))
    return joined.join(nodes, "root").filter("_links >= _nodes").select(
        F.col("root.key").alias(key), F.col("root.x").alias("px"), F.col("root.y").alias("py"))
