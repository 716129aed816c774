"""Layers and rasters derived from the driver tables with the DataFrame API.

The same inputs are stated as SQL text in ``checks/oracle_views.py`` for the oracle side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.layers import Layer, assemble_paths, path_vertices, point_layer
from stratalake.operators.raster import Raster, RasterMeta, from_pixels


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _spread(key: str) -> tuple:
    lon = 70.0 + ((F.col(key) * 7919) % 10000) / F.lit(1e4)
    lat = 35.0 + ((F.col(key) * 104729) % 10007) / F.lit(10007.0)
    return lon, lat


def sample_table(spark: SparkSession, sf: str) -> DataFrame:
    lon, lat = _spread("event_id")
    return table(spark, sf, "events").select(
        F.col("event_id").alias("sample_id"), lon.alias("lon"), lat.alias("lat"),
        F.col("value").alias("assay"), F.col("event_type").alias("litho"))


def samples(spark: SparkSession, sf: str) -> Layer:
    return point_layer("samples", sample_table(spark, sf), "lon", "lat", "sample_id")


def utm_table(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("sample_id"),
        (400000.0 + (F.col("c_custkey") * 7919) % 200000).alias("easting"),
        (3870000.0 + (F.col("c_custkey") * 104729) % 100003).alias("northing"))


def samples_utm(spark: SparkSession, sf: str) -> Layer:
    return point_layer("samples_utm", utm_table(spark, sf), "easting", "northing", "sample_id", 32642)


def dem_meta(spark: SparkSession, sf: str, epsg: int = 4326) -> RasterMeta:
    n = table(spark, sf, "part").count()
    return RasterMeta("dem", epsg, 70.0, 36.0, 1.0 / 20, 20.0 / n, 20, -(-n // 20), 1, -9999.0, "float64")


def dem_pixels(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "part").select(
        F.lit(1).alias("band"), F.floor(F.col("p_partkey") / 20.0).alias("r"),
        (F.col("p_partkey") % 20).alias("c"),
        F.when(F.col("p_size") < 5, -9999.0).otherwise(F.col("p_retailprice")).alias("v"))


def dem(spark: SparkSession, sf: str) -> Raster:
    return from_pixels(dem_pixels(spark, sf), dem_meta(spark, sf))


def dem_utm(spark: SparkSession, sf: str) -> Raster:
    """The same grid placed in UTM zone 42: 5 km columns from 400 km east, rows filling 100 km."""
    n = table(spark, sf, "part").count()
    meta = RasterMeta("dem_utm", 32642, 400000.0, 3970000.0, 5000.0, 100000.0 / (n / 20), 20, -(-n // 20),
                      1, -9999.0, "float64")
    return from_pixels(dem_pixels(spark, sf), meta)


def ortho(spark: SparkSession, sf: str) -> Raster:
    meta = dem_meta(spark, sf)
    k = F.col("p_partkey")
    bands = F.array(
        F.struct(F.lit(1).alias("band"), (F.col("p_size") * 5).cast("double").alias("v")),
        F.struct(F.lit(2).alias("band"), (k % 256).cast("double").alias("v")),
        F.struct(F.lit(3).alias("band"), ((k * 7) % 256).cast("double").alias("v")))
    pixels = table(spark, sf, "part").select(
        F.floor(k / 20.0).alias("r"), (k % 20).alias("c"), F.inline(bands)).select("band", "r", "c", "v")
    return from_pixels(pixels, RasterMeta("ortho", meta.epsg, meta.x0, meta.y0, meta.dx, meta.dy,
                                          meta.width, meta.height, 3, None, "uint8"))


RING = [(70.2, 35.2), (70.8, 35.2), (70.8, 35.5), (70.5, 35.5), (70.5, 35.8), (70.2, 35.8), (70.2, 35.2)]
BLOCKS = [[(70.1, 35.1), (70.4, 35.1), (70.4, 35.4), (70.1, 35.4), (70.1, 35.1)],
          [(70.3, 35.3), (70.7, 35.3), (70.7, 35.6), (70.3, 35.6), (70.3, 35.3)]]
# In degrees, over the middle of the UTM samples.
WEST_RING = [(68.5, 35.2), (69.6, 35.1), (69.9, 35.7), (69.0, 35.8), (68.5, 35.2)]


def polygon_layer(spark: SparkSession, name: str, rings: list, epsg: int = 4326) -> Layer:
    """Small hand-written polygons, one feature per ring."""
    rows = [(i, ("Polygon", [[[(float(x), float(y)) for x, y in ring]]])) for i, ring in enumerate(rings)]
    return Layer(name, spark.createDataFrame(rows, f"fid bigint, geometry {G.GEOMETRY}"), epsg,
                 kinds=frozenset({"polygon"}))


def study_area(spark: SparkSession) -> Layer:
    return polygon_layer(spark, "study_area", [RING])


def study_blocks(spark: SparkSession) -> Layer:
    return polygon_layer(spark, "study_blocks", BLOCKS)


COAST_VERTICES = 2500


def coast(spark: SparkSession, sf: str) -> Layer:
    """A study area with a dense coast and an inland hole: a vertex for each size, brand and parity of part keys, of which there are at
    most ``COAST_VERTICES`` whatever the table's size."""
    k = ((F.col("p_size") - 1) * 25 + F.substring_index("p_brand", "#", -1).cast("int") - 1) * 2 + F.col("p_partkey") % 2
    shore = (table(spark, sf, "part").groupBy(k.alias("k")).agg((F.sum("p_partkey") % 97).alias("height"))
             .select("k", (70.1 + 0.8 * (F.col("k") + 0.5) / float(COAST_VERTICES)).alias("x"), (35.5 + 0.3 * F.col("height") / 97.0).alias("y")))
    ring = shore.agg(F.array_sort(F.collect_list(F.struct("k", "x", "y"))).alias("v")).select(
        F.transform("v", lambda v: G.vertex(v["x"], v["y"])).alias("v"))
    corner = lambda x, y: G.vertex(F.lit(x), F.lit(y))
    closed = F.concat(F.array(corner(70.1, 35.1)), F.col("v"), F.array(corner(70.9, 35.1), corner(70.1, 35.1)))
    hole = F.array(*[corner(x, y) for x, y in ((70.4, 35.2), (70.6, 35.2), (70.6, 35.4), (70.4, 35.4), (70.4, 35.2))])
    return Layer("coast", ring.select(F.lit(1).cast("long").alias("fid"), G.polygon(closed, hole).alias("geometry")), 4326,
                 kinds=frozenset({"polygon"}))


def line_table(spark: SparkSession, sf: str, scaled: bool = False) -> DataFrame:
    x = ((F.col("l_partkey") * 37) % 1000).cast("double")
    y = ((F.col("l_suppkey") * 91 + F.col("l_partkey") * 13) % 1000).cast("double")
    if scaled:
        x, y = 70.0 + x / 1e3, 35.0 + y / 1e3
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("fid"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        x.alias("x"), y.alias("y"))


def lines(spark: SparkSession, sf: str, scaled: bool = False) -> Layer:
    """One line per order; ``scaled`` places it in the study area's degree square."""
    order = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    numbered = path_vertices(line_table(spark, sf, scaled), "fid", order)
    return Layer("lines", assemble_paths(numbered), 4326, ("fid", "seq"), frozenset({"line"}))


def polygons(spark: SparkSession, sf: str) -> Layer:
    """Squares of side 0.02 per customer, every tenth a bowtie, every fiftieth without geometry."""
    x, y = _spread("c_custkey")
    square = [(0.0, 0.0), (2.0, 0.0), (2.0, 2.0), (0.0, 2.0), (0.0, 0.0)]
    bowtie = [(0.0, 0.0), (2.0, 2.0), (2.0, 0.0), (0.0, 2.0), (0.0, 0.0)]

    def ring(corners):
        return F.array(*[G.vertex(x + F.lit(a) * 0.01, y + F.lit(b) * 0.01) for a, b in corners])
    shape = F.when(F.col("c_custkey") % 10 == 3, ring(bowtie)).otherwise(ring(square))
    df = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("fid"), F.col("c_mktsegment").alias("segment"),
        F.when(F.col("c_custkey") % 50 != 7, G.polygon(shape)).alias("geometry"))
    return Layer("polygons", G.settle(df), 4326, kinds=frozenset({"polygon"}))


def messy(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    return table(spark, sf, "orders").select(
        key.alias("feature_no"), F.concat(F.lit("  "), "o_orderstatus", F.lit(" ")).alias("Name"),
        F.when(key % 17 == 0, "N/A").when(key % 19 == 0, None)
         .otherwise(F.col("o_custkey").cast("string")).alias("POP_2020"),
        F.when(key % 23 == 0, "unknown")
         .otherwise(F.substring(F.col("o_orderdate").cast("string"), 1, 10)).alias("seen"))
