"""Noding: split self-crossing lines at every crossing and dissolve doubled stretches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.contacts import feature_contacts, grid_of
from stratalake.operators.joins import spread
from stratalake.operators.layers import Layer
from stratalake.operators.lineage import materialize

_ROWKEY = "_seq"


def _stretches(layer: Layer) -> tuple[DataFrame, DataFrame]:
    """Non-simple lines cut at their nodes: ``key, _seq, run, i, t0, ax, ay, bx, by``, where the pieces
    of one ``run`` follow each other between two nodes, over the limits of rows too; and their keys."""
    key = layer.key[0]
    df = layer.df.filter(G.is_present("geometry") & F.col("geometry.type").isin(*G.LINES))
    df = df.withColumn(_ROWKEY, F.col("seq") if "seq" in df.columns else F.lit(0).cast("long"))
    segments = G.explode_segments(df, [key, _ROWKEY])
    hits = feature_contacts(df, key, grid_of(layer.epsg))
    at = hits.select(key, F.inline(F.array(
        F.struct(F.col("part_a").alias("part"), F.col("i_a").alias("i"), F.col("n_a").alias("n"), F.col("ta").alias("t"), "px", "py"),
        F.struct(F.col("part_b").alias("part"), F.col("i_b").alias("i"), F.col("n_b").alias("n"), F.col("tb").alias("t"), "px", "py"))))
    nodes = (at.groupBy(key, "part", "i")
             .agg(F.array_sort(F.collect_set(F.struct("t", "px", "py"))).alias("nodes"), F.max("n").alias("_n")))
    # The places found are few and read twice; searching for them again would cost another join.
    nodes = materialize(nodes)
    crossing = nodes.select(key).distinct()
    # About so many pieces: the segments of the paths that cross and the places on them.
    rows = (nodes.groupBy(key, "part").agg((F.max("_n") + F.sum(F.size("nodes"))).alias("_rows"))
            .agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0])
    place = [key, "part", "i"]
    cut = (spread(segments.join(crossing, key, "left_semi"), place, rows)
           .join(spread(nodes.drop("_n"), place, rows), place, "left"))
    mid = F.filter(F.coalesce("nodes", F.array().cast("array<struct<t:double,px:double,py:double>>")),
                   lambda n: (n["t"] > 0) & (n["t"] < 1))
    at_start = F.exists(F.coalesce("nodes", F.array().cast("array<struct<t:double,px:double,py:double>>")),
                        lambda n: n["t"] == 0)
    at_end = F.exists(F.coalesce("nodes", F.array().cast("array<struct<t:double,px:double,py:double>>")),
                      lambda n: n["t"] == 1)
    start = F.struct(F.lit(0.0).alias("t"), F.col("x1").alias("px"), F.col("y1").alias("py"))
    stop = F.struct(F.lit(1.0).alias("t"), F.col("x2").alias("px"), F.col("y2").alias("py"))
    cut = cut.withColumns({"_stops": F.concat(F.array(start), mid, F.array(stop)),
                           "_node_start": at_start, "_node_end": at_end})
    count = F.size("_stops") - 1
    pieces = cut.select(
        key, _ROWKEY, "part", "i", "_node_start", "_node_end", count.alias("_m"),
        F.posexplode(F.arrays_zip(F.slice("_stops", F.lit(1), count).alias("a"),
                                  F.slice("_stops", F.lit(2), count).alias("b"))).alias("k", "s"))
    pieces = pieces.select(
        key, _ROWKEY, "part", "i", F.col("s.a.t").alias("t0"),
        F.col("s.a.px").alias("ax"), F.col("s.a.py").alias("ay"), F.col("s.b.px").alias("bx"), F.col("s.b.py").alias("by"),
        ((F.col("k") > 0) | F.col("_node_start")).alias("_breaks"),
        ((F.col("k") < F.col("_m") - 1) | F.col("_node_end")).alias("_ends"))
    pieces = pieces.filter((F.col("ax") != F.col("bx")) | (F.col("ay") != F.col("by")))
    pieces = spread(pieces, [key], rows)
    along = Window.partitionBy(key).orderBy("part", "i", "t0")
    fresh = (F.lag("part").over(along).isNull() | (F.lag("part").over(along) != F.col("part"))
             | F.col("_breaks") | F.lag("_ends").over(along))
    pieces = pieces.withColumn("_new", fresh.cast("int"))
    return (pieces.withColumn("run", F.sum("_new").over(along.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("_new", "_breaks", "_ends"), crossing)


def _dissolved(pieces: DataFrame, key: str) -> DataFrame:
    """Of stretches covered twice, in either direction, keep the first.  The minimum combines before
    the shuffle, so a stretch with very many copies is one row per task."""
    a, b = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    ends = pieces.withColumns({"_lo": F.least(a, b), "_hi": F.greatest(a, b)})
    first = F.min(F.struct("run", "i", "t0", _ROWKEY, "ax", "ay", "bx", "by"))
    return ends.groupBy(key, "_lo", "_hi").agg(first.alias("_f")).select(key, "_f.*")


def noded_runs(layer: Layer) -> tuple[DataFrame, DataFrame]:
    """``key, _seq, run, length, path`` for the non-simple lines of the layer, and their keys.  A run belongs to
    the row (``_seq``) in which it starts."""
    key = layer.key[0]
    pieces, crossing = _stretches(layer)
    kept = _dissolved(pieces, key)
    runs = (kept.groupBy(key, "run")
            .agg(F.array_sort(F.collect_list(F.struct("i", "t0", "ax", "ay", "bx", "by"))).alias("_p"), F.min(_ROWKEY).alias(_ROWKEY),
                 F.sum(F.hypot(F.col("bx") - F.col("ax"), F.col("by") - F.col("ay"))).alias("length"))
            .select(key, _ROWKEY, "run", "length", F.concat(
                F.transform("_p", lambda p: F.named_struct(F.lit("x"), p["ax"], F.lit("y"), p["ay"])),
                F.array(G.vertex(F.element_at("_p", -1)["bx"], F.element_at("_p", -1)["by"]))).alias("path")))
    return runs, crossing


def node_lines(layer: Layer) -> Layer:
    """Self-crossing lines become multi-lines with a vertex at every crossing; others are untouched.

    Of a path stored in several rows, each noded row holds the parts that start in it and ``part_base``, the number
    of parts in the rows before; a row in which none starts goes.
    """
    key = layer.key[0]
    runs, crossing = noded_runs(layer)
    several = "seq" in layer.df.columns
    parts = (runs.groupBy(key, _ROWKEY)
             .agg(F.array_sort(F.collect_list(F.struct("run", "path"))).alias("_runs"))
             .select(key, _ROWKEY, F.size("_runs").alias("_n"), G.from_parts(F.transform("_runs", lambda r: F.array(r["path"])), "LineString")
                     .alias("_noded")))
    df = layer.df.withColumn(_ROWKEY, F.col("seq") if several else F.lit(0).cast("long"))
    if several:
        before = Window.partitionBy(key).orderBy(_ROWKEY).rowsBetween(Window.unboundedPreceding, -1)
        parts = parts.withColumn("part_base", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        df = df.drop("part_base").join(crossing.withColumn("_crossing", F.lit(True)), key, "left")
    out = df.join(parts, [key, _ROWKEY], "left")
    if several:
        out = out.filter(F.col("_crossing").isNull() | F.col("_noded").isNotNull())
    # A noded row no longer follows the numbering of the path it came from.
    for c in [c for c in ("seg_base", "seg_total", "seg_cell") if c in df.columns]:
        out = out.withColumn(c, F.when(F.col("_noded").isNull(), F.col(c)))
    out = out.withColumn("geometry", F.coalesce("_noded", "geometry"))
    return layer.with_df(out.select(*[c for c in layer.df.columns if c != "part_base"], *(["part_base"] if several else [])))
