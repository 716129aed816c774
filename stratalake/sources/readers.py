"""Readers: CSV points, GeoJSON, KML, Parquet layers and tiled rasters."""

from __future__ import annotations

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.layers import Layer
from stratalake.operators.raster import Raster, RasterMeta, mosaic
from stratalake.plans.config import RasterSource, RunConfig, TabularSource, VectorSource
from stratalake.sources.files import extension, path_size

# Texts read as missing in delimited files.
MISSING_TEXT = ["", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
                "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null"]

META_SCHEMA = ("raster string, epsg int, x0 double, y0 double, dx double, dy double, width int, height int, "
               "bands int, nodata double, dtype string")

_FEATURE = ("struct<type:string,geometry:struct<type:string,coordinates:string,"
            "geometries:array<struct<type:string,coordinates:string>>>,properties:map<string,string>>")


def require_columns(columns: list[str], lon_col: str, lat_col: str, name: str) -> None:
    missing = [f"{what} column '{c}'" for what, c in (("longitude", lon_col), ("latitude", lat_col)) if c not in columns]
    if missing:
        raise ValueError(f"[{name}] missing columns: {', '.join(missing)}; available columns: {columns}")


def points_from_table(df: DataFrame, lon_col: str, lat_col: str, name: str = "points") -> DataFrame:
    """Append point geometries.  Coordinates may be text; a missing one gives a NULL geometry, as does
    text that is not a number, which ``bad_coordinates`` counts."""
    require_columns(df.columns, lon_col, lat_col, name)
    lon, lat = F.col(lon_col).try_cast("double"), F.col(lat_col).try_cast("double")
    return df.withColumn("geometry", G.point(lon, lat))


def bad_coordinates(df: DataFrame, lon_col: str, lat_col: str) -> DataFrame:
    """One row: how many coordinates are present but not numbers."""
    bad = lambda c: F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()
    return df.agg(F.count_if(bad(lon_col) | bad(lat_col)).alias("n_bad"))


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, the usual missing markers as NULL."""
    raw = spark.read.option("header", True).csv(path)
    return raw.select(*[F.when(~F.col(f"`{c}`").isin(*MISSING_TEXT), F.col(f"`{c}`")).alias(c) for c in raw.columns])


def read_points(spark: SparkSession, src: TabularSource, check: bool = True) -> Layer:
    df = read_csv(spark, src.path)
    layer = points_from_table(df, src.lon_col, src.lat_col, src.name)
    if check:
        n_bad = bad_coordinates(df, src.lon_col, src.lat_col).first()["n_bad"]
        if n_bad:
            raise RuntimeError(f"[{src.name}] {n_bad} rows have coordinates that are not numbers")
    numeric = {c: F.col(c).cast("double") for c in (src.lon_col, src.lat_col)}
    return Layer(src.name, with_fid(layer.withColumns(numeric)), src.crs_epsg, kinds=frozenset({"point"}))


def with_fid(df: DataFrame) -> DataFrame:
    """Row id for sources without one; reading the same files again gives the same ids."""
    return df if "fid" in df.columns else df.withColumn("fid", F.monotonically_increasing_id())


def _vertex_of(p: Column) -> Column:
    return F.named_struct(F.lit("x"), p[0], F.lit("y"), p[1])


def geojson_geometry(kind: Column, coordinates: Column) -> Column:
    """Geometry from a GeoJSON type and its coordinates as text."""
    level = lambda n: F.from_json(coordinates, "array<" * n + "double" + ">" * n)
    path = lambda c: F.transform(c, _vertex_of)
    parts = (F.when(kind == "Point", F.array(F.array(F.array(_vertex_of(level(1))))))
             .when(kind == "MultiPoint", F.transform(level(2), lambda p: F.array(F.array(_vertex_of(p)))))
             .when(kind == "LineString", F.array(F.array(path(level(2)))))
             .when(kind == "MultiLineString", F.transform(level(3), lambda p: F.array(path(p))))
             .when(kind == "Polygon", F.array(F.transform(level(3), path)))
             .when(kind == "MultiPolygon", F.transform(level(4), lambda rings: F.transform(rings, path))))
    return F.when(kind.isNotNull() & parts.isNotNull(), G.geometry(kind, parts))


def geojson_pieces(g: Column) -> Column:
    """The geometry of a GeoJSON member as an array: one, or for a collection one for each kind it holds."""
    members = F.transform(g["geometries"], lambda m: geojson_geometry(m["type"], m["coordinates"]))
    return F.when(g["type"] == "GeometryCollection", by_kind(members)).otherwise(F.array(geojson_geometry(g["type"], g["coordinates"])))


def by_kind(members: Column) -> Column:
    """Points, lines and polygons among the members, each kind put together."""
    def of(types: tuple[str, str]) -> Column:
        own = F.filter(members, lambda m: m["type"].isin(*types))
        return G.from_parts(F.flatten(F.transform(own, lambda m: m["parts"])), types[0])
    return F.array_compact(F.array(*[of(t) for t in (G.POINTS, G.LINES, G.POLYGONS)]))


def read_geojson(spark: SparkSession, path: str, name: str, lines: bool = False,
                 properties: list[str] | None = None) -> Layer:
    """GeoJSON feature collections, or one feature per line (``lines``), the form that splits over
    tasks however large the file is.  Properties become text columns; name them to save the pass that
    looks for their names.  A geometry collection gives one row for each kind it holds.  A ``crs`` member naming an EPSG code is honoured.  Records that are no features, or
    files cut short, raise an error with their number."""
    epsg = 4326
    if lines:
        filled = spark.read.text(path).filter(F.trim("value") != "").select(F.from_json("value", _FEATURE).alias("f"))
        _require_readable(filled.agg(F.count_if(F.col("f.type").isNull())).first()[0], name)
        features = filled.select("f.*")
    else:
        raw = spark.read.option("multiLine", True).option("columnNameOfCorruptRecord", "_bad").schema(
            f"type string, crs struct<properties:struct<name:string>>, features array<{_FEATURE}>, _bad string").json(path)
        code = F.nullif(F.regexp_extract("crs.properties.name", "EPSG:+(\\d+)$", 1), F.lit(""))
        seen = raw.agg(F.max(code).alias("code"), F.count_if(F.col("_bad").isNotNull() | F.col("features").isNull()).alias("bad")).first()
        _require_readable(seen["bad"], name)
        epsg = int(seen["code"] or 4326)
        features = raw.select(F.inline("features"))
    if properties is None:
        keys = features.select(F.explode(F.map_keys("properties")).alias("k")).distinct().collect()
        properties = sorted(r["k"] for r in keys)
    df = features.select(*[F.col("properties")[p].alias(p) for p in properties],
                         F.explode_outer(geojson_pieces(F.col("geometry"))).alias("geometry"))
    return Layer(name, with_fid(_typed_fid(G.settle(df))), epsg)


def _require_readable(bad: int, name: str) -> None:
    if bad:
        raise ValueError(f"[{name}] {bad} record(s) that cannot be read")


def _typed_fid(df: DataFrame) -> DataFrame:
    """A source's own ``fid`` names its rows if it is a whole number in each and never repeated; otherwise it stays
    as ``source_fid`` and the rows are numbered."""
    if "fid" not in df.columns:
        return df
    number = F.col("fid").try_cast("long")
    seen = df.agg(F.count(F.lit(1)).alias("rows"), F.count(number).alias("numbers"), F.count_distinct(number).alias("distinct")).first()
    if seen["rows"] == seen["numbers"] == seen["distinct"]:
        return df.withColumn("fid", number)
    return df.withColumnRenamed("fid", "source_fid")


_KML_SHAPES = ("Point struct<coordinates:string>, LineString struct<coordinates:string>, "
               "Polygon struct<outerBoundaryIs:struct<LinearRing:struct<coordinates:string>>,"
               "innerBoundaryIs:array<struct<LinearRing:struct<coordinates:string>>>>, "
               "MultiGeometry struct<Point:array<struct<coordinates:string>>,"
               "LineString:array<struct<coordinates:string>>,"
               "Polygon:array<struct<outerBoundaryIs:struct<LinearRing:struct<coordinates:string>>,"
               "innerBoundaryIs:array<struct<LinearRing:struct<coordinates:string>>>>>>")


def _kml_path(text: Column) -> Column:
    """``lon,lat[,height]`` tuples separated by white space."""
    tuples = F.filter(F.split(text, "\\s+"), lambda t: t != "")
    return F.transform(tuples, lambda t: F.named_struct(
        F.lit("x"), F.split(t, ",")[0].cast("double"), F.lit("y"), F.split(t, ",")[1].cast("double")))


def _kml_rings(p: Column) -> Column:
    outer = F.array(_kml_path(p["outerBoundaryIs"]["LinearRing"]["coordinates"]))
    inner = F.coalesce(F.transform(p["innerBoundaryIs"], lambda r: _kml_path(r["LinearRing"]["coordinates"])),
                       F.array().cast(f"array<{G.PATH}>"))
    return F.concat(outer, inner)


def read_kml(spark: SparkSession, path: str, name: str) -> Layer:
    """Placemarks of KML files, always EPSG:4326.  A MultiGeometry gives one row for each kind it holds.  What is no XML
    raises an error."""
    rows = (spark.read.format("xml").option("rowTag", "Placemark").option("columnNameOfCorruptRecord", "_bad")
            .schema(f"name string, description string, _bad string, {_KML_SHAPES}").load(path))
    seen = rows.agg(F.count("name"), F.count("_bad").alias("bad")).first()
    _require_readable(seen["bad"], name)
    many = F.col("MultiGeometry")
    points = F.transform(many["Point"], lambda p: F.array(F.array(_kml_path(p["coordinates"])[0])))
    lines = F.transform(many["LineString"], lambda p: F.array(_kml_path(p["coordinates"])))
    polygons = F.transform(many["Polygon"], _kml_rings)
    shapes = F.array_compact(F.array(
        F.when(F.col("Point").isNotNull(), G.geometry("Point", F.array(F.array(_kml_path(F.col("Point.coordinates")))))),
        F.when(F.col("LineString").isNotNull(), G.linestring(_kml_path(F.col("LineString.coordinates")))),
        F.when(F.col("Polygon").isNotNull(), G.geometry("Polygon", F.array(_kml_rings(F.col("Polygon"))))),
        *[F.when(F.size(parts) > 0, G.geometry(kind, parts))
          for kind, parts in (("MultiPoint", points), ("MultiLineString", lines), ("MultiPolygon", polygons))]))
    pieces = rows.select(F.col("name").alias("Name"), "description", F.explode_outer(shapes).alias("geometry"))
    return Layer(name, with_fid(G.settle(pieces)), 4326)


def read_parquet_layer(spark: SparkSession, path: str, name: str, epsg: int | None = None,
                       layer: str | None = None, filter_expr: str | None = None) -> Layer:
    """Layer written by this package; the EPSG code is kept in the geometry column's metadata.

    Rows are selected before they are numbered, so that the filter reaches the scan.  A stored ``fid`` is tried
    in a pass over that column alone; lines stored in several rows are named by ``fid`` and ``seq``.  Stored envelopes
    stay with the layer as ``boxed``, for clips to push into the scan.
    """
    df = spark.read.parquet(path)
    stored = df.schema["geometry"].metadata.get("epsg")
    df = attribute_filter(select_layer(df, layer), filter_expr, name)
    in_rows = "seq" in df.columns and "fid" in df.columns
    df = df if in_rows else with_fid(_typed_fid(df))
    boxed = df if {*G.ENVELOPE} <= {*df.columns} else None
    return Layer(name, df.drop(*G.ENVELOPE), epsg or stored, ("fid", "seq") if in_rows else ("fid",), boxed=boxed)


def select_layer(df: DataFrame, layer: str | None) -> DataFrame:
    """Rows of one named layer of a multi-layer source; a partition filter when stored by layer."""
    return df if layer is None else df.filter(F.col("layer") == layer)


def attribute_filter(df: DataFrame, expression: str | None, name: str = "source") -> DataFrame:
    """Rows matching a SQL expression; it is pushed into the scan where the format allows."""
    if not expression:
        return df
    try:
        return df.filter(F.expr(expression))
    except (AnalysisException, ParseException) as e:
        raise ValueError(f"[{name}] filter failed: {expression}") from e


def ne_null_safe(c: Column | str, value) -> Column:
    """Different from the value, missing included."""
    return ~G.col(c).eqNullSafe(value)


def read_vector(spark: SparkSession, src: VectorSource) -> Layer:
    kind = extension(src.path)
    if kind in (".geojson", ".json"):
        layer = read_geojson(spark, src.path, src.name)
    elif kind == ".geojsonl":
        layer = read_geojson(spark, src.path, src.name, lines=True)
    elif kind == ".kml":
        layer = read_kml(spark, src.path, src.name)
    elif kind == ".parquet":
        return read_parquet_layer(spark, src.path, src.name, layer=src.layer, filter_expr=src.filter_expr)
    else:
        raise ValueError(f"[{src.name}] unsupported vector format '{kind}'")
    return layer.with_df(attribute_filter(select_layer(layer.df, src.layer), src.filter_expr, src.name))


def read_one_raster(spark: SparkSession, path: str, name: str) -> Raster:
    meta = spark.read.schema(META_SCHEMA).json(f"{path}/meta").first().asDict()
    meta["raster"] = name
    return Raster(RasterMeta(**meta), spark.read.parquet(f"{path}/tiles"))


def read_raster(spark: SparkSession, src: RasterSource) -> Raster:
    """One tiled raster, or several merged; ``band`` and ``nodata`` of the source override."""
    from dataclasses import replace
    paths = src.path if isinstance(src.path, list) else [src.path]
    parts = [read_one_raster(spark, p, src.name) for p in paths]
    if src.nodata is not None:  # before merging, so that its pixels don't hide those below
        parts = [Raster(replace(r.meta, nodata=src.nodata), r.tiles) for r in parts]
    raster = parts[0] if len(parts) == 1 else mosaic(parts, src.name)
    return raster if src.band is None else raster.band(src.band)


def present_paths(spark: SparkSession, src) -> bool:
    """True when all files of the source exist; False for a missing optional source; else an error."""
    paths = src.path if isinstance(src.path, list) else [src.path]
    missing = [p for p in paths if path_size(spark, p) is None]
    if missing and not src.optional:
        raise FileNotFoundError(f"[{src.name}] nothing to read at {missing}")
    return not missing


def load_all_sources(spark: SparkSession, config: RunConfig) -> tuple[dict, dict, dict]:
    """Lazy ``(vectors, rasters, tabulars)``; missing optional sources are left out."""
    vectors = {s.name: read_vector(spark, s) for s in config.vector_sources if present_paths(spark, s)}
    rasters = {s.name: read_raster(spark, s) for s in config.raster_sources if present_paths(spark, s)}
    tabulars = {s.name: read_points(spark, s) for s in config.tabular_sources if present_paths(spark, s)}
    return vectors, rasters, tabulars
