"""Named layers: a lazy DataFrame with a geometry column, an EPSG code and a name."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.joins import spread

# Longest stretch of one path held in one row; longer paths continue in further rows.
PATH_ROWS = 65536


@dataclass(frozen=True)
class Layer:
    """One vector layer. ``key`` names the columns that identify a row; ``kinds`` (point, line,
    polygon) the kinds of geometry it holds, where known; ``boxed`` the same rows with stored envelope columns, where
    the source has them."""

    name: str
    df: DataFrame
    epsg: int | None = 4326
    key: tuple[str, ...] = ("fid",)
    kinds: frozenset[str] | None = None
    boxed: DataFrame | None = None

    def with_df(self, df: DataFrame) -> Layer:
        return replace(self, df=df, boxed=None)

    def may_hold(self, kind: str) -> bool:
        return self.kinds is None or kind in self.kinds

    @property
    def attributes(self) -> list[str]:
        return [c for c in self.df.columns if c != "geometry"]


def point_layer(name: str, df: DataFrame, x: str, y: str, fid: str, epsg: int | None = 4326) -> Layer:
    """Points from two coordinate columns; a missing coordinate gives a NULL geometry."""
    return Layer(name, df.withColumns({"fid": F.col(fid).cast("long"), "geometry": G.point(x, y)}), epsg,
                 kinds=frozenset({"point"}))


def registry(*groups: dict[str, Layer]) -> dict[str, Layer]:
    """Merge layer sets; a later layer replaces an earlier one of the same name."""
    out: dict[str, Layer] = {}
    for group in groups:
        out.update(group)
    return out


def feature_count(layer: Layer) -> Column:
    """Number of features: rows, but a path stored in several rows counts once."""
    return F.count_distinct(F.col(layer.key[0])) if "seq" in layer.df.columns else F.count(F.lit(1))


def inventory(layers: dict[str, Layer]) -> DataFrame:
    """One row per layer: name and number of features."""
    rows = [layer.df.agg(feature_count(layer).alias("n_rows")).select(F.lit(name).alias("layer"), "n_rows")
            for name, layer in layers.items()]
    return union_all(rows)


def union_all(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def stack_layers(layers: dict[str, Layer]) -> DataFrame:
    """All layers as one table with a ``layer`` column; columns a layer lacks become NULL."""
    frames = [layer.df.withColumn("layer", F.lit(name)) for name, layer in layers.items()]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def path_vertices(df: DataFrame, key: str, order: list[str], x: str = "x", y: str = "y") -> DataFrame:
    """Number the vertices of each path after dropping consecutive repeats: ``key, i, n, step, x, y``
    with the mean distance between neighbours as ``step``.

    All windows share one partitioning and order, so this is one shuffle; the sort and the window
    frames spill to disk, so a very long path costs time but not memory.  The rows are counted beforehand,
    so that the rows of a task do not grow with the table.
    """
    df = spread(df, [key], df.count())
    along = Window.partitionBy(key).orderBy(*order)
    whole = Window.partitionBy(key)
    kept = (df.withColumns({"_px": F.lag(x).over(along), "_py": F.lag(y).over(along)})
              .filter(F.col("_px").isNull() | (F.col("_px") != F.col(x)) | (F.col("_py") != F.col(y))))
    step = F.avg(F.hypot(F.col(x) - F.col("_px"), F.col(y) - F.col("_py"))).over(whole)
    return kept.select(key, (F.row_number().over(along) - 1).cast("long").alias("i"),
                       F.count(F.lit(1)).over(whole).alias("n"), step.alias("step"),
                       F.col(x).alias("x"), F.col(y).alias("y"))


def assemble_paths(vertices: DataFrame, key: str = "fid", rows: int = PATH_ROWS) -> DataFrame:
    """LineString rows from numbered vertices (``key, i, n, step, x, y``).

    A path is cut every ``rows`` segments into rows ``key, seq`` that share their joint vertex, so no
    group holds more than ``rows + 1`` vertices however long one path is.  ``seg_base``,
    ``seg_total`` and ``seg_cell`` place the segments of a row within the whole path.
    """
    seq = F.floor(F.col("i") / rows).cast("long")
    joint = (F.col("i") % rows == 0) & (F.col("i") > 0)
    seqs = F.when(joint & (F.col("i") == F.col("n") - 1), F.array(seq - 1)) \
            .when(joint, F.array(seq - 1, seq)).otherwise(F.array(seq))
    out = (vertices.withColumn("seq", F.explode(seqs))
           .groupBy(key, "seq")
           .agg(F.array_sort(F.collect_list(F.struct("i", "x", "y"))).alias("_v"), F.max("n").alias("_n"),
                F.max("step").alias("_step")))
    path = F.transform("_v", lambda v: G.vertex(v["x"], v["y"]))
    return G.settle(out.select(key, "seq", (F.col("seq") * rows).alias("seg_base"),
                      (F.col("_n") - 1).alias("seg_total"),
                      (F.col("_step") * 2).alias("seg_cell"), G.linestring(path).alias("geometry")))


def geometry_kinds(layer: Layer) -> DataFrame:
    """Row count per drawing kind, decided row by row: point, line, polygon, missing."""
    kind = kind_of(F.col("geometry"))
    return layer.df.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("n_rows"))


def with_kinds(layers: dict[str, Layer]) -> dict[str, Layer]:
    """Find out, in one action over all layers, which kinds those hold that do not say."""
    unknown = {n: v for n, v in layers.items() if v.kinds is None}
    if not unknown:
        return layers
    found = union_all([v.df.select(kind_of(F.col("geometry")).alias("kind")).distinct()
                       .select(F.lit(n).alias("layer"), "kind") for n, v in unknown.items()]).collect()
    return {n: v if v.kinds is not None else replace(v, kinds=frozenset(
        r["kind"] for r in found if r["layer"] == n and r["kind"] != "missing")) for n, v in layers.items()}


def kind_of(g: Column) -> Column:
    return (F.when(g["type"].isin(*G.POINTS), "point").when(g["type"].isin(*G.LINES), "line")
             .when(g["type"].isin(*G.POLYGONS), "polygon").otherwise("missing"))


def vector_profile(layer: Layer) -> DataFrame:
    """Feature count, sorted distinct geometry types, CRS and columns of a layer, as one row."""
    types = F.array_join(F.array_sort(F.collect_set(F.col("geometry.type"))), ",")
    return layer.df.agg(feature_count(layer).alias("features"), types.alias("geometry_types")).select(
        F.lit(layer.name).alias("layer"), "features",
        F.when(F.col("features") == 0, "empty").otherwise(F.col("geometry_types")).alias("geometry_types"),
        F.lit(layer.epsg).cast("int").alias("epsg"), F.lit(",".join(layer.df.columns)).alias("columns"))


def total_bounds(layer: Layer) -> DataFrame:
    """xmin, ymin, xmax, ymax over the layer; NULL for an empty one."""
    boxed = G.with_envelope(layer.df.select("geometry"))
    return boxed.agg(F.min("xmin").alias("xmin"), F.min("ymin").alias("ymin"),
                     F.max("xmax").alias("xmax"), F.max("ymax").alias("ymax"))
