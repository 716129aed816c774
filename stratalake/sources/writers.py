"""Writers: vector layers as Parquet or GeoJSON lines, rasters as Parquet tiles with their affine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.layers import Layer
from stratalake.operators.raster import Raster
from stratalake.sources.readers import META_SCHEMA


def write_parquet_layer(layer: Layer, path: str) -> str:
    """Envelope columns are added and rows sorted by them within each file, so that a later envelope
    filter skips row groups; the EPSG code goes into the column metadata."""
    df = G.with_envelope(layer.df).sortWithinPartitions("xmin", "ymin")
    df.withMetadata("geometry", {"epsg": layer.epsg}).write.mode("overwrite").parquet(path)
    return path


def geojson_coordinates(g: Column) -> Column:
    """Coordinates of a geometry as GeoJSON text."""
    pair = lambda v: F.array(v["x"], v["y"])
    path = lambda p: F.transform(p, pair)
    parts = g["parts"]
    return (F.when(g["type"] == "Point", F.to_json(pair(parts[0][0][0])))
            .when(g["type"] == "MultiPoint", F.to_json(F.transform(parts, lambda p: pair(p[0][0]))))
            .when(g["type"] == "LineString", F.to_json(path(parts[0][0])))
            .when(g["type"] == "MultiLineString", F.to_json(F.transform(parts, lambda p: path(p[0]))))
            .when(g["type"] == "Polygon", F.to_json(F.transform(parts[0], path)))
            .when(g["type"] == "MultiPolygon", F.to_json(F.transform(parts, lambda p: F.transform(p, path)))))


def geojson_features(layer: Layer) -> DataFrame:
    """One GeoJSON feature per row, as text column ``value``."""
    g = F.col("geometry")
    shape = F.when(G.is_present(g), F.concat(F.lit('{"type":"'), g["type"], F.lit('","coordinates":'),
                                             geojson_coordinates(g), F.lit("}"))).otherwise("null")
    properties = F.to_json(F.struct(*[F.col(c) for c in layer.attributes]), {"ignoreNullFields": "false"})
    return layer.df.select(F.concat(F.lit('{"type":"Feature","geometry":'), shape, F.lit(',"properties":'),
                                    properties, F.lit("}")).alias("value"))


def write_geojson_layer(layer: Layer, path: str) -> str:
    """Newline-delimited features, written in parallel."""
    if layer.epsg not in (None, 4326):
        raise ValueError(f"layer '{layer.name}' is in EPSG:{layer.epsg}; GeoJSON holds EPSG:4326")
    geojson_features(layer).write.mode("overwrite").text(path)
    return path


def save_vectors(layers: dict[str, Layer], directory: str, vector_format: str = "parquet") -> list[str]:
    write, suffix = {"parquet": (write_parquet_layer, "parquet"), "geojson": (write_geojson_layer, "geojsonl")}[vector_format]
    return [write(layer, f"{directory}/{name}_processed.{suffix}") for name, layer in layers.items()]


def write_raster(spark: SparkSession, raster: Raster, path: str) -> str:
    raster.tiles.sortWithinPartitions("tile_r", "tile_c").write.mode("overwrite").partitionBy("band").parquet(f"{path}/tiles")
    spark.createDataFrame([raster.meta.as_dict()], META_SCHEMA).coalesce(1).write.mode("overwrite").json(f"{path}/meta")
    return path


def save_rasters(spark: SparkSession, rasters: dict[str, Raster], directory: str) -> tuple[list[str], dict[str, str]]:
    """Paths written, and the reason for each raster that could not be written."""
    saved, failed = [], {}
    for name, raster in rasters.items():
        try:
            saved.append(write_raster(spark, raster, f"{directory}/{name}_processed.parquet"))
        except Exception as e:  # a raster that fails must not lose the other outputs
            failed[name] = str(e)
    return saved, failed
