"""Repair of invalid polygons by even-odd fill, and the whole repair stage with its gates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.functions.rings import stitch_batches
from stratalake.operators.contacts import feature_contacts, grid_of
from stratalake.operators.layers import Layer, union_all, with_kinds
from stratalake.operators.lineage import materialize
from stratalake.operators.noding import node_lines
from stratalake.operators.validity import drop_missing, line_faults, validity_rate, with_validity

# Shear that leaves (practically) no edge horizontal, so that one ray direction serves all edges.
_SHEAR = 0.38196601125010515


def split_segments(segments: DataFrame, hits: DataFrame, key: str) -> DataFrame:
    """Segments cut at their contacts: ``key, cell, part, ring, i, t0, ax, ay, bx, by``, no empty pieces."""
    sides = [F.struct(F.col(f"part_{s}").alias("part"), F.col(f"ring_{s}").alias("ring"),
                      F.col(f"i_{s}").alias("i"), F.col(f"t{s}").alias("t"), "px", "py") for s in "ab"]
    at = hits.select(key, F.inline(F.array(*sides))).filter((F.col("t") > 0) & (F.col("t") < 1))
    cuts = at.groupBy(key, "part", "ring", "i").agg(F.collect_set(F.struct("t", "px", "py")).alias("_cuts"))
    joined = segments.join(cuts, [key, "part", "ring", "i"], "left")
    none = F.array().cast("array<struct<t:double,px:double,py:double>>")
    start = F.struct(F.lit(0.0).alias("t"), F.col("x1").alias("px"), F.col("y1").alias("py"))
    stop = F.struct(F.lit(1.0).alias("t"), F.col("x2").alias("px"), F.col("y2").alias("py"))
    joined = joined.withColumn("_stops", F.concat(F.array(start), F.array_sort(F.coalesce("_cuts", none)), F.array(stop)))
    n = F.size("_stops") - 1
    pieces = joined.select(key, "cell", "part", "ring", "i", F.explode(F.arrays_zip(
        F.slice("_stops", F.lit(1), n).alias("a"), F.slice("_stops", F.lit(2), n).alias("b"))).alias("s"))
    pieces = pieces.select(key, "cell", "part", "ring", "i", F.col("s.a.t").alias("t0"), F.col("s.a.px").alias("ax"),
                           F.col("s.a.py").alias("ay"), F.col("s.b.px").alias("bx"), F.col("s.b.py").alias("by"))
    return pieces.filter((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")))


def cancel_doubled(pieces: DataFrame, key: str) -> DataFrame:
    """Keep, once, the pieces covered an odd number of times; ``id`` names a piece."""
    a = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y"))
    b = F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    grouped = (pieces.withColumns({"lo": F.least(a, b), "hi": F.greatest(a, b)})
               .groupBy(key, "lo", "hi").agg(F.count(F.lit(1)).alias("_n"), F.max("cell").alias("cell"),
                                              F.min(F.struct("part", "ring", "i", "t0")).alias("id")))
    return grouped.filter(F.col("_n") % 2 == 1).select(
        key, "cell", "id", F.col("lo.x").alias("ax"), F.col("lo.y").alias("ay"),
        F.col("hi.x").alias("bx"), F.col("hi.y").alias("by"))


def direct_pieces(pieces: DataFrame, key: str) -> DataFrame:
    """Turn every piece so that the even-odd interior lies on its left.

    The parity to the right of a piece is the number of other pieces of the feature met by the ray
    from its middle.  Only pieces listed in the ray's row of the feature are compared.
    """
    sheared = pieces.withColumns({"va": F.col("ay") + _SHEAR * F.col("ax"), "vb": F.col("by") + _SHEAR * F.col("bx")})
    others = sheared.select(key, F.col("id").alias("o_id"), F.col("ax").alias("o_ax"), F.col("va").alias("o_va"),
                            F.col("bx").alias("o_bx"), F.col("vb").alias("o_vb"), F.explode(F.sequence(
                                F.floor(F.least("va", "vb") / F.col("cell")),
                                F.floor(F.greatest("va", "vb") / F.col("cell")))).alias("row"))
    probes = sheared.withColumns({"mx": (F.col("ax") + F.col("bx")) / 2, "mv": (F.col("va") + F.col("vb")) / 2})
    probes = probes.withColumn("row", F.floor(F.col("mv") / F.col("cell")))
    met = (F.col("id") != F.col("o_id")) & G.crosses_upward_ray(
        F.col("o_ax"), F.col("o_va"), F.col("o_bx"), F.col("o_vb"), F.col("mx"), F.col("mv"))
    counted = (probes.join(others, [key, "row"])
               .groupBy(key, "id", "ax", "ay", "bx", "by", "va", "vb").agg(F.count_if(met).alias("_n")))
    # Interior on the right-hand side of the plane: the left of a descending piece.
    turn = (F.col("_n") % 2 == 1) != (F.col("vb") < F.col("va"))
    swap = lambda p, q: F.when(turn, F.col(q)).otherwise(F.col(p))
    return counted.select(key, swap("ax", "bx").alias("ax"), swap("ay", "by").alias("ay"),
                          swap("bx", "ax").alias("bx"), swap("by", "ay").alias("by"), F.lit(False).alias("cut"))


def stitch(pieces: DataFrame, key: str) -> DataFrame:
    """``key, geometry`` from directed pieces; a group is the outline of one feature."""
    kind = pieces.schema[key].dataType.simpleString()
    arrays = (pieces.groupBy(key).agg(F.sort_array(F.collect_list(F.struct("ax", "ay", "bx", "by", "cut"))).alias("_p"))
              .select(key, *[F.col("_p").getField(c).alias(c) for c in ("ax", "ay", "bx", "by", "cut")]))
    rings = arrays.mapInPandas(stitch_batches(key), f"{key} {kind}, xs array<array<array<double>>>, ys array<array<array<double>>>")
    vertex = lambda x, y: F.named_struct(F.lit("x"), x, F.lit("y"), y)
    parts = F.zip_with("xs", "ys", lambda px, py: F.zip_with(px, py, lambda rx, ry: F.zip_with(rx, ry, vertex)))
    return rings.select(key, G.from_parts(parts, "Polygon").alias("geometry"))


def repaired_pieces(invalid: DataFrame, key: str, grid: float = 1e9) -> DataFrame:
    """Directed outline pieces of the even-odd fill of each polygon in ``key, geometry``."""
    close = lambda r: F.when(F.element_at(r, 1) != F.element_at(r, -1), F.concat(r, F.array(r[0]))).otherwise(r)
    parts = F.transform("geometry.parts", lambda rings: F.filter(
        F.transform(rings, close), lambda r: F.size(r) >= 4))
    closed = invalid.select(key, G.geometry(F.lit("Polygon"), parts).alias("geometry"))
    segments = G.explode_segments(closed, [key])
    pieces = split_segments(segments, feature_contacts(closed, key, grid), key)
    return direct_pieces(cancel_doubled(pieces, key), key)


def repair_polygons(layer: Layer, broken: DataFrame | None = None) -> Layer:
    """Replace invalid polygons by their even-odd fill; every other row is kept as it is.  A polygon whose
    fill is empty (collapsed rings) gets a NULL geometry.

    The invalid polygons alone are checkpointed: the steps that follow read them several times and
    must not repeat the search for them.  Where they are known already, ``broken`` gives them as ``key, geometry``.
    """
    key = layer.key[0]
    if broken is None:
        polygons = layer.with_df(layer.df.filter(F.col("geometry.type").isin(*G.POLYGONS)).select(*layer.key, "geometry"))
        broken = with_validity(polygons).filter(~F.col("valid")).select(key, "geometry")
    broken = materialize(broken)
    fixed = stitch(repaired_pieces(broken, key, grid_of(layer.epsg)), key).withColumnRenamed("geometry", "_fixed")
    mended = broken.select(key).distinct().withColumn("_broken", F.lit(True)).join(fixed, key, "left")
    out = layer.df.join(mended, key, "left").withColumn("geometry", F.when(
        F.col("_broken") & F.col("geometry.type").isin(*G.POLYGONS), F.when(G.is_present("_fixed"), F.col("_fixed"))).otherwise(F.col("geometry")))
    return layer.with_df(out.select(*layer.df.columns))


def repair_layer(layer: Layer, drop_null: bool = True, broken: DataFrame | None = None) -> Layer:
    """Drop missing geometries, repair polygons, node self-crossing lines; steps for kinds the layer
    is known not to hold are left out."""
    layer = drop_missing(layer) if drop_null else layer
    if layer.may_hold("polygon"):
        layer = repair_polygons(layer, broken)
        layer = drop_missing(layer) if drop_null else layer
    if layer.may_hold("line"):
        layer = node_lines(layer)
    return layer


def repair_report(layer: Layer) -> DataFrame:
    """One row: rows before, missing rows dropped, invalid rows, self-crossing lines, rate after.

    The rows are stored with their validity: it is counted, and tells which polygons to repair.
    """
    flagged = materialize(with_validity(layer))
    layer = layer.with_df(flagged.select(*layer.df.columns))
    present = drop_missing(layer)
    before = flagged.agg(
        F.count(F.lit(1)).alias("rows_before"),
        F.count_if(F.col("reason") == "Null geometry").alias("n_dropped"),
        F.count_if(~F.col("valid") & (F.col("reason") != "Null geometry")).alias("n_invalid"))
    crossing = (line_faults(present).agg(F.count_if(~F.col("simple")).alias("n_crossing")).scalar()
                if layer.may_hold("line") else F.lit(0).cast("long"))
    broken = flagged.filter(~F.col("valid") & G.is_present("geometry") & F.col("geometry.type").isin(*G.POLYGONS))
    fixed = repair_layer(layer, broken=broken.select(layer.key[0], "geometry"))
    # Validity reads the repaired rows several times; unstored, each time would repair them again.
    after = validity_rate(fixed.with_df(materialize(fixed.df)))
    return before.select(
        F.lit(layer.name).alias("layer"), "rows_before", "n_dropped", "n_invalid",
        crossing.alias("n_crossing"), after.select("rate").scalar().alias("rate_after"))


def check_validity_rates(layers: dict[str, Layer], threshold: float) -> DataFrame:
    """Rows ``layer, n_rows, n_valid, rate, passed``; an empty layer passes."""
    report = union_all([validity_rate(layer) for layer in layers.values()])
    return report.withColumn("passed", ~F.coalesce(F.col("rate") < threshold, F.lit(False)))


def repair_layers(layers: dict[str, Layer], auto_repair: bool = True, drop_null_geometries: bool = True,
                  validity_threshold: float = 0.95, check: bool = True) -> dict[str, Layer]:
    """The repair stage over a layer set.  With ``check`` the gates run as one action for all layers."""
    if not layers:
        return {}
    layers = with_kinds(layers)
    if not auto_repair:
        kept = {n: drop_missing(v) if drop_null_geometries else v for n, v in layers.items()}
        counts = union_all([validity_rate(v) for v in kept.values()]).filter("n_valid < n_rows").collect()
        if counts:
            raise ValueError("; ".join(
                f"layer '{r['layer']}' has {r['n_rows'] - r['n_valid']} invalid geometries and auto_repair is off"
                for r in counts))
        layers = kept
    out = {n: repair_layer(v, drop_null_geometries) if auto_repair else node_lines(v) if v.may_hold("line") else v
           for n, v in layers.items()}
    # What was repaired or noded is read again by the gate and by the stages that follow.
    out = {n: v if v.kinds == {"point"} else v.with_df(materialize(v.df)) for n, v in out.items()}
    if check:
        low = check_validity_rates(out, validity_threshold).filter("not passed").collect()
        if low:
            raise ValueError("; ".join(
                f"layer '{r['layer']}' validity rate {r['rate']:.1%} is below {validity_threshold:.1%}" for r in low))
    return out
