"""Geometry validity with reasons, line simplicity, and the per-layer reports and gates on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.contacts import feature_contacts, grid_of
from stratalake.operators.layers import Layer
from stratalake.operators.lineage import materialize
from stratalake.operators.rings import circles, nesting_faults

# Reason texts, in the order in which they are reported.
REASONS = [
    "Null geometry",
    "Invalid Coordinate",
    "Too few points in geometry component",
    "Ring is not closed",
    "Self-intersection",
    "Ring Self-intersection",
    "Interior is disconnected",
    "Hole lies outside shell",
    "Holes are nested",
    "Nested shells",
]


def drop_missing(layer: Layer) -> Layer:
    """Remove rows whose geometry is null or empty."""
    return layer.with_df(layer.df.filter(G.is_present("geometry")))


def _is_polygon() -> Column:
    return F.col("geometry.type").isin(*G.POLYGONS)


def _is_line() -> Column:
    return F.col("geometry.type").isin(*G.LINES)


def _row_reason() -> Column:
    """Faults visible within one row."""
    g = F.col("geometry")
    paths = F.flatten(g["parts"])
    bad = F.exists(G.vertices(g), lambda v: v["x"].isNull() | v["y"].isNull() | F.isnan(v["x"]) | F.isnan(v["y"])
                   | (F.abs(v["x"]) == float("inf")) | (F.abs(v["y"]) == float("inf")))
    short_line = _is_line() & F.exists(paths, lambda p: F.size(G.without_repeats(p)) < 2)
    short_ring = _is_polygon() & F.exists(paths, lambda p: F.size(G.without_repeats(p)) < 4)
    unclosed = _is_polygon() & F.exists(paths, lambda p: F.element_at(p, 1) != F.element_at(p, -1))
    return (F.when(~G.is_present(g), 0).when(bad, 1).when(unclosed, 3).when(short_line | short_ring, 2))


def _contact_faults(polygons: DataFrame, key: str, grid: float) -> DataFrame:
    """Per feature the first fault found where ring segments meet: code and location.

    The contacts are worked out once and stored, reduced to one row for each kind of fault and one for each place
    where two rings of a part touch.  Rings that touch at two places, or in a circle of several rings, cut the
    interior.
    """
    hits = feature_contacts(polygons, key, grid)
    same_part = F.col("part_a") == F.col("part_b")
    same_ring = same_part & (F.col("ring_a") == F.col("ring_b"))
    code = F.when(F.col("kind").isin("cross", "overlap"), 4).when(same_ring, 5)
    touch = F.when(code.isNull() & same_part, F.struct(F.col("part_a").alias("part"), "ring_a", "ring_b", "px", "py"))
    met = hits.select(key, code.alias("code"), touch.alias("touch"), F.struct("px", "py").alias("place"))
    met = materialize(met.filter("code is not null or touch is not null")
                      .groupBy(key, "code", "touch").agg(F.min("place").alias("place")))
    fault = lambda code: F.struct(code.alias("code"), F.col("px"), F.col("py")).alias("_f")
    touches = met.filter("touch is not null").select(key, "touch.*")
    twice = (touches.groupBy(key, "part", "ring_a", "ring_b").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("px", "py")).alias("place"))
             .filter("n > 1").select(key, "place.*").select(key, fault(F.lit(6))))
    direct = met.filter("code is not null").select(key, "code", "place.*").select(key, fault(F.col("code"))).unionByName(twice)
    found = circles(touches.join(direct.select(key), key, "left_anti"), key).select(key, fault(F.lit(6)))
    return direct.unionByName(found).groupBy(key).agg(F.min("_f").alias("_fault"))


def _reason_text(code: str) -> Column:
    texts = F.array(*[F.lit(r) for r in REASONS])
    return F.when(F.col(code).isNotNull(), F.element_at(texts, F.col(code) + 1))


def with_validity(layer: Layer) -> DataFrame:
    """The layer with ``valid``, ``reason`` and the location ``reason_x, reason_y``.

    Row-local faults are found in place; only polygon rings without one take part in the segment
    join, and only the faults it finds come back.  Rings of one feature are compared by joins too.
    """
    key = layer.key[0]
    df = layer.df.withColumn("_row", _row_reason())
    if not layer.may_hold("polygon"):
        none = F.lit(None).cast("double")
        return df.select(*layer.df.columns, F.col("_row").isNull().alias("valid"), _reason_text("_row").alias("reason"),
                         none.alias("reason_x"), none.alias("reason_y"))
    # Dealt by key, which the contacts group by: a small file of many rows would be searched by one or two tasks.
    polygons = df.filter(F.col("_row").isNull() & _is_polygon()).select(key, "geometry").repartition(key)
    faults = _contact_faults(polygons, key, grid_of(layer.epsg))
    joined = df.join(faults, key, "left")
    joined = joined.join(nesting_faults(polygons, key, stray=7, nested_holes=8, nested_shells=9), key, "left")
    joined = joined.withColumn("_code", F.coalesce("_row", "_fault.code", "_nesting"))
    return joined.select(*layer.df.columns, F.col("_code").isNull().alias("valid"),
                         _reason_text("_code").alias("reason"),
                         F.col("_fault.px").alias("reason_x"), F.col("_fault.py").alias("reason_y"))


def invalid_reasons(layer: Layer) -> DataFrame:
    """Every invalid feature with its reason, the location where there is one."""
    return with_validity(layer).filter("not valid").select(*layer.key, "reason", "reason_x", "reason_y")


def line_faults(layer: Layer) -> DataFrame:
    """One row per line feature: ``key, simple``.

    A line is simple when its segments meet only between neighbours, where a closed line ends, and,
    between the parts of a multi-line, at ends of both.
    """
    key = layer.key[0]
    lines = layer.df.filter(G.is_present("geometry") & _is_line())
    hits = feature_contacts(lines, key, grid_of(layer.epsg))
    c = F.col
    end_a = ((c("i_a") == 0) & (c("ta") == 0)) | ((c("i_a") == c("n_a") - 1) & (c("ta") == 1))
    end_b = ((c("i_b") == 0) & (c("tb") == 0)) | ((c("i_b") == c("n_b") - 1) & (c("tb") == 1))
    allowed = (c("part_a") != c("part_b")) & (c("kind") == "touch") & end_a & end_b
    crossing = hits.filter(~allowed).select(key, F.lit(False).alias("simple"))
    every = lines.select(key, F.lit(True).alias("simple"))
    return every.unionByName(crossing).groupBy(key).agg(F.bool_and("simple").alias("simple"))


def validity_rate(layer: Layer) -> DataFrame:
    """One row: rows, valid rows and their share (NULL for an empty layer)."""
    return with_validity(layer).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("valid").alias("n_valid"),
        F.avg(F.col("valid").cast("double")).alias("rate")).select(F.lit(layer.name).alias("layer"), "*")
