"""One query per operator: (spark, sf_dir) -> DataFrame, over the driver tables.

Floating-point results are returned as rounded integers so that both engines agree on them.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import sample_layers as S
from stratalake.functions import geometry as G
from stratalake.operators import audit, clip, crs, layers, mask, noding, qa, raster, repair, schema, terrain, validity, warp
from stratalake.operators.layers import Layer
from stratalake.plans.config import RunConfig, SpatialSettings, TabularSource, VectorSource
from stratalake.plans.run import run_pipeline
from stratalake.sources import readers, writers

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rnd(c: Column | str, scale: float = 1e6) -> Column:
    return F.floor(G.col(c) * F.lit(scale) + 0.5).cast("long")


def scratch(name: str) -> str:
    return scratch_folder(name) + "/out"


def scratch_folder(name: str) -> str:
    """A new folder that all executors see; only a local session may take a temporary one."""
    spark = SparkSession.getActiveSession()
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return f"{shared.rstrip('/')}/stratalake-{name}-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix=f"stratalake-{name}-")


# ---- sources -------------------------------------------------------------------------------------

@query
def q_points_from_table(spark: SparkSession, sf: str) -> DataFrame:
    sheet = S.sample_table(spark, sf).withColumns({
        "lon": F.when(F.col("sample_id") % 97 != 0, F.col("lon").cast("string")), "lat": F.col("lat").cast("string")})
    pts = readers.points_from_table(sheet, "lon", "lat")
    return pts.select("sample_id", F.col("geometry").isNotNull().alias("has_point"),
                      rnd(G.point_x("geometry")).alias("x6"), rnd(G.point_y("geometry")).alias("y6"))


def _sheets(spark, sf):
    lon, lat = S._spread("c_custkey")
    second = S.table(spark, sf, "customer").select(F.col("c_custkey").alias("sample_id"), lon.alias("lon"), lat.alias("lat"))
    return {"samples_0": S.samples(spark, sf), "samples_1": layers.point_layer("samples_1", second, "lon", "lat", "sample_id")}


@query
def q_multi_samples(spark, sf):
    both = layers.stack_layers(_sheets(spark, sf))
    return both.groupBy("layer").agg(F.count(F.lit(1)).alias("n"), F.count("assay").alias("n_assay"),
                                     F.sum(rnd("lon")).alias("lon6"))


@query
def q_geojson_read(spark, sf):
    path = scratch("geojson")
    writers.write_geojson_layer(S.samples(spark, sf).with_df(
        S.samples(spark, sf).df.select("fid", "litho", "geometry")), path)
    got = readers.read_geojson(spark, path, "samples", lines=True, properties=["fid", "litho"]).df
    return got.select("fid", "litho", rnd(G.point_x("geometry")).alias("x6"), rnd(G.point_y("geometry")).alias("y6"))


@query
def q_kml_read(spark, sf):
    path = scratch("kml")
    ring = F.array_join(F.transform("geometry.parts", lambda p: F.array_join(F.transform(
        p[0], lambda v: F.concat_ws(",", v["x"].cast("string"), v["y"].cast("string"))), " ")), " ")
    text = F.concat(F.lit("<Placemark><name>"), F.col("fid").cast("string"),
                    F.lit("</name><Polygon><outerBoundaryIs><LinearRing><coordinates>"), ring,
                    F.lit("</coordinates></LinearRing></outerBoundaryIs></Polygon></Placemark>"))
    # One document, and so one file, per thousand placemarks.
    marks = S.polygons(spark, sf).df.filter(G.is_present("geometry")).select(F.floor(F.col("fid") / 1000).alias("doc"), text.alias("t"))
    docs = marks.groupBy("doc").agg(F.concat(F.lit("<kml><Document>"), F.array_join(F.collect_list("t"), "\n"),
                                             F.lit("</Document></kml>")).alias("value"))
    docs.select("value").write.option("maxRecordsPerFile", 1).text(path)
    got = readers.read_kml(spark, path, "outlines").df
    flat = G.explode_vertices(got.withColumn("k", F.col("Name").cast("long")), ["k"])
    return flat.groupBy(F.col("k").alias("fid")).agg(F.count(F.lit(1)).alias("n"), F.sum(rnd("x")).alias("x6"),
                                                     F.sum(rnd("y")).alias("y6"))


@query
def q_layer_select(spark, sf):
    both = layers.stack_layers(_sheets(spark, sf))
    return readers.select_layer(both, "samples_1").select("sample_id", rnd("lat").alias("lat6"))


@query
def q_attribute_filter(spark, sf):
    df = readers.attribute_filter(S.sample_table(spark, sf), "assay > 50 and litho in ('click', 'purchase')")
    return df.filter(readers.ne_null_safe("sample_id", 10)).select("sample_id", "litho")


@query
def q_raster_pixels(spark, sf):
    return raster.pixels(S.dem(spark, sf), null_nodata=True).select(
        F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), rnd("v", 1e4).alias("v4"))


@query
def q_raster_mosaic(spark, sf):
    whole, meta = S.dem_pixels(spark, sf), S.dem_meta(spark, sf)
    upper, lower = meta.height * 6 // 10, meta.height * 4 // 10
    from dataclasses import replace
    first = raster.from_pixels(whole.filter(F.col("r") < upper), replace(meta, height=upper))
    second = raster.from_pixels(
        whole.filter(F.col("r") >= lower).withColumns({
            "r": F.col("r") - lower, "v": F.when(F.col("v") == -9999.0, F.col("v")).otherwise(F.col("v") + 1)}),
        replace(meta, y0=meta.y0 - lower * meta.dy, height=meta.height - lower))
    return raster.pixels(raster.mosaic([first, second])).select(
        F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), rnd("v", 1e4).alias("v4"))


@query
def q_layer_inventory(spark, sf):
    vectors = {"polygons": S.polygons(spark, sf), "samples": S.samples_utm(spark, sf)}
    return layers.inventory(layers.registry(vectors, {"samples": S.samples(spark, sf)}))


# ---- audit ---------------------------------------------------------------------------------------

@query
def q_source_audit(spark, sf):
    folder = scratch_folder("audit")
    S.sample_table(spark, sf).write.option("header", True).csv(f"{folder}/samples.csv")
    writers.write_parquet_layer(S.polygons(spark, sf), f"{folder}/outlines.parquet")
    writers.write_parquet_layer(S.study_area(spark), f"{folder}/study.parquet")
    config = RunConfig(
        vector_sources=[VectorSource("outlines", f"{folder}/outlines.parquet"),
                        VectorSource("tracks", f"{folder}/tracks.kml"),
                        VectorSource("faults", f"{folder}/faults.kml", optional=False)],
        tabular_sources=[TabularSource("samples", f"{folder}/samples.csv", "lon", "lat"),
                         TabularSource("assays", f"{folder}/samples.csv", "longitude", "lat"),
                         TabularSource("sheet", f"{folder}/outlines.parquet", "lon", "lat")],
        spatial=SpatialSettings(f"{folder}/study.parquet"))
    return audit.source_audit(spark, config).select("source", "kind", "status")


@query
def q_vector_profile(spark, sf):
    return layers.vector_profile(S.polygons(spark, sf)).select("layer", "features", "geometry_types", "epsg")


@query
def q_raster_profile(spark, sf):
    return raster.raster_profile(S.ortho(spark, sf)).select("raster", "width", "height", "bands", "epsg")


# ---- CRS -----------------------------------------------------------------------------------------

@query
def q_reproject_utm_to_wgs84(spark, sf):
    out = crs.harmonize_crs({"utm": S.samples_utm(spark, sf)}, 4326, check=False)["utm"].df
    return out.select("sample_id", rnd(G.point_x("geometry")).alias("lon6"), rnd(G.point_y("geometry")).alias("lat6"))


@query
def q_reproject_wgs84_to_utm(spark, sf):
    out = crs.reproject(S.samples(spark, sf), 32642).df
    return out.select("sample_id", rnd(G.point_x("geometry"), 1e3).alias("e3"), rnd(G.point_y("geometry"), 1e3).alias("n3"))


@query
def q_reproject_webmercator(spark, sf):
    out = crs.reproject(validity.drop_missing(S.polygons(spark, sf)), 3857).df
    return G.explode_vertices(out, ["fid"]).select("fid", F.col("i").cast("long").alias("i"),
                                                   rnd("x", 1e3).alias("x3"), rnd("y", 1e3).alias("y3"))


@query
def q_total_bounds(spark, sf):
    utm = crs.reproject(S.samples_utm(spark, sf), 4326)
    report = crs.wgs84_bounds({"samples": S.samples(spark, sf), "polygons": S.polygons(spark, sf), "utm": utm,
                               "raw": S.samples_utm(spark, sf)})
    return report.select("layer", *[rnd(c).alias(c + "6") for c in ("xmin", "ymin", "xmax", "ymax")], "in_range")


@query
def q_warp_grid(spark, sf):
    g = warp.warp_grid(spark, S.dem_utm(spark, sf).meta, 4326)
    return g.select(rnd("x0").alias("x6"), rnd("y0").alias("y6"), rnd("res", 1e9).alias("res9"), "width", "height")


@query
def q_raster_warp(spark, sf):
    src = S.dem_utm(spark, sf)
    target = warp.target_meta(spark, src.meta, 4326)
    out = warp.warp_pixels(spark, src, target).filter(F.col("v").isNotNull())
    return out.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), rnd("v", 1e3).alias("v3"))


# ---- validity and repair -------------------------------------------------------------------------

@query
def q_drop_null_geometry(spark, sf):
    return validity.drop_missing(S.polygons(spark, sf)).df.select("fid")


@query
def q_geometry_validity(spark, sf):
    return validity.with_validity(S.polygons(spark, sf)).select("fid", "valid")


@query
def q_invalid_reason(spark, sf):
    return validity.invalid_reasons(S.polygons(spark, sf)).select(
        "fid", "reason", rnd("reason_x").alias("x6"), rnd("reason_y").alias("y6"))


@query
def q_repair_bowtie(spark, sf):
    fixed = repair.repair_polygons(validity.drop_missing(S.polygons(spark, sf))).df
    return fixed.select("fid", F.size("geometry.parts").cast("long").alias("parts"),
                        rnd(G.polygon_area("geometry"), 1e10).alias("area10"))


@query
def q_line_self_crossing(spark, sf):
    return validity.line_faults(S.lines(spark, sf)).select("fid", "simple")


@query
def q_node_lines(spark, sf):
    noded = noding.node_lines(S.lines(spark, sf)).df
    return noded.select("fid", F.size("geometry.parts").cast("long").alias("parts"),
                        rnd(G.line_length("geometry"), 1e3).alias("length3"))


@query
def q_validity_rate(spark, sf):
    return validity.validity_rate(validity.drop_missing(S.polygons(spark, sf))).select(
        "layer", "n_rows", "n_valid", rnd("rate").alias("rate6"))


@query
def q_repair_report(spark, sf):
    return repair.repair_report(S.polygons(spark, sf)).select(
        "layer", "rows_before", "n_dropped", "n_invalid", "n_crossing", rnd("rate_after").alias("rate6"))


# ---- clip ----------------------------------------------------------------------------------------

@query
def q_clip_points(spark, sf):
    return clip.clip_points(S.samples(spark, sf), mask.build_mask(S.study_area(spark))).df.select(
        "sample_id", rnd("lon").alias("lon6"))


@query
def q_clip_points_utm(spark, sf):
    study = crs.reproject(S.polygon_layer(spark, "west", [S.WEST_RING]), 32642)
    return clip.clip_points(S.samples_utm(spark, sf), mask.build_mask(study)).df.select("sample_id")


@query
def q_clip_points_multimask(spark, sf):
    return clip.clip_points(S.samples(spark, sf), mask.build_mask(S.study_blocks(spark))).df.select("sample_id")


@query
def q_clip_points_coast(spark, sf):
    return clip.clip_points(S.samples(spark, sf), mask.build_mask(S.coast(spark, sf))).df.select("sample_id")


@query
def q_clip_classify(spark, sf):
    return clip.classify(S.polygons(spark, sf), mask.build_mask(S.study_area(spark))).select("fid", "position")


@query
def q_clip_lines(spark, sf):
    out = clip.clip_lines(S.lines(spark, sf, scaled=True), mask.build_mask(S.study_area(spark))).df
    return out.groupBy("fid").agg(F.sum(G.line_length("geometry")).alias("l")).select("fid", rnd("l").alias("length6"))


def _valid_polygons(spark, sf) -> Layer:
    return repair.repair_polygons(validity.drop_missing(S.polygons(spark, sf)))


@query
def q_clip_polygons(spark, sf):
    out = clip.clip_polygons(_valid_polygons(spark, sf), mask.build_mask(S.study_area(spark))).df
    return out.select("fid", rnd(G.polygon_area("geometry"), 1e10).alias("area10"))


@query
def q_clip_polygons_multimask(spark, sf):
    blocks = mask.build_mask(S.study_blocks(spark))
    return clip.clipped_area(_valid_polygons(spark, sf), blocks).select("fid", rnd("area", 1e10).alias("area10"))


@query
def q_clip_report(spark, sf):
    return clip.clip_report(S.samples(spark, sf), mask.build_mask(S.study_area(spark)))


@query
def q_raster_mask(spark, sf):
    out = raster.mask_pixels(S.dem(spark, sf), mask.build_mask(S.study_area(spark)))
    return out.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), rnd("v", 1e4).alias("v4"))


@query
def q_raster_crop(spark, sf):
    out = raster.pixels(raster.crop(S.dem(spark, sf), (70.2, 35.2, 70.8, 35.8)))
    return out.select(F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c"), rnd("v", 1e4).alias("v4"))


# ---- schema --------------------------------------------------------------------------------------

FIELD_MAP = {"Name": "status", "POP_2020": "population", "absent": "ignored"}


@query
def q_rename_fields(spark, sf):
    return schema.rename_fields(S.messy(spark, sf), FIELD_MAP)


@query
def q_normalize_text(spark, sf):
    return schema.normalize_text(S.messy(spark, sf))


@query
def q_normalize_text_nulltext(spark, sf):
    return schema.normalize_text(S.messy(spark, sf), null_text=True)


@query
def q_cast_int(spark, sf):
    return schema.cast_field(S.messy(spark, sf), "POP_2020", "int").select("feature_no", "POP_2020")


@query
def q_cast_failures(spark, sf):
    return schema.cast_failures(S.messy(spark, sf), {"POP_2020": "int", "feature_no": "float"})


@query
def q_cast_float(spark, sf):
    return schema.cast_field(S.messy(spark, sf), "POP_2020", "float").select("feature_no", rnd("POP_2020", 1e3).alias("pop3"))


@query
def q_cast_str(spark, sf):
    return schema.cast_field(S.messy(spark, sf), "feature_no", "str").select("feature_no", "seen")


@query
def q_cast_datetime(spark, sf):
    return schema.cast_field(S.messy(spark, sf), "seen", "datetime").select(
        "feature_no", F.date_format("seen", "yyyy-MM-dd").alias("seen"))


@query
def q_missing_field(spark, sf):
    out = schema.complete_fields(S.messy(spark, sf), {"depth": "float", "Name": "str"})
    return out.select("feature_no", F.col("depth").isNull().alias("no_depth"))


@query
def q_drop_extra_fields(spark, sf):
    df = S.samples(spark, sf).df
    out = schema.keep_fields(df, {"litho": "str", "sample_id": "int"})
    return out.select(*[c for c in out.columns if c != "geometry"], F.lit(len(out.columns)).cast("long").alias("n_columns"))


@query
def q_harmonize_schema(spark, sf):
    out = schema.harmonize_layer(S.messy(spark, sf), FIELD_MAP, {
        "status": "str", "population": "int", "seen": "datetime", "depth": "float"}, drop_extra=True, key=("feature_no",))
    return out.withColumn("seen", F.date_format("seen", "yyyy-MM-dd")).withColumn("depth", F.col("depth").isNull())


# ---- QA ------------------------------------------------------------------------------------------

def _qa(spark, sf):
    return qa.qa_report({"samples": S.samples(spark, sf), "polygons": S.polygons(spark, sf), "utm": S.samples_utm(spark, sf)},
                        4326, min_rows=1, max_rows=1_000_000_000_000, required=["sample_id"])


@query
def q_qa_report(spark, sf):
    return _qa(spark, sf)


@query
def q_qa_summary(spark, sf):
    return qa.qa_summary(_qa(spark, sf))


# ---- terrain -------------------------------------------------------------------------------------

def _cell(df: DataFrame) -> list[Column]:
    return [F.col("r").cast("long").alias("r"), F.col("c").cast("long").alias("c")]


@query
def q_dem_grid(spark, sf):
    g = terrain.dem_grid(S.dem(spark, sf))
    return g.select(*_cell(g), rnd("lon").alias("lon6"), rnd("lat").alias("lat6"), rnd("elevation", 1e4).alias("z4"))


@query
def q_sample_elevation(spark, sf):
    out = raster.sample_bilinear(S.sample_table(spark, sf), "lon", "lat", S.dem(spark, sf))
    return out.select("sample_id", rnd("elevation", 1e4).alias("z4"))


@query
def q_sample_elevation_center(spark, sf):
    out = raster.sample_bilinear(S.sample_table(spark, sf), "lon", "lat", S.dem(spark, sf), anchor="center")
    return out.select("sample_id", rnd("elevation", 1e4).alias("z4"))


def _draped(df: DataFrame) -> DataFrame:
    return df.select("fid", F.col("i").cast("long").alias("i"), rnd("lon").alias("lon6"), rnd("x").alias("x6"),
                     rnd("y").alias("y6"), rnd("z").alias("z6"))


@query
def q_drape_points(spark, sf):
    return _draped(terrain.drape(S.samples(spark, sf), S.dem(spark, sf), 2.0))


@query
def q_drape_lines(spark, sf):
    return _draped(terrain.drape(S.lines(spark, sf, scaled=True), S.dem(spark, sf), 2.0))


@query
def q_drape_polygons(spark, sf):
    return _draped(terrain.drape(S.polygons(spark, sf), S.dem(spark, sf), 2.0))


@query
def q_normalize_xy(spark, sf):
    out = terrain.normalize_xy(S.sample_table(spark, sf), S.dem_meta(spark, sf))
    return out.select("sample_id", rnd("x").alias("x6"), rnd("y").alias("y6"))


@query
def q_normalize_z(spark, sf):
    dem = S.dem(spark, sf)
    out = terrain.normalize_z(terrain.dem_grid(dem), dem, 1.5)
    return out.select(*_cell(out), rnd("z").alias("z6"))


@query
def q_terrain_mesh(spark, sf):
    out = terrain.terrain_mesh(S.dem(spark, sf), 2.0)
    return out.select(*_cell(out), rnd("x").alias("x6"), rnd("y").alias("y6"), rnd("z").alias("z6"),
                      rnd("elevation", 1e4).alias("e4"))


@query
def q_ortho_rgb(spark, sf):
    out = terrain.ortho_rgb(S.ortho(spark, sf))
    return out.select(*_cell(out), *[F.col(c).cast("long").alias(c) for c in ("red", "green", "blue")])


@query
def q_ortho_gray(spark, sf):
    out = terrain.ortho_rgb(S.ortho(spark, sf).band(2))
    return out.select(*_cell(out), *[F.col(c).cast("long").alias(c) for c in ("red", "green", "blue")])


@query
def q_texture_uv(spark, sf):
    out = terrain.texture_uv(terrain.dem_grid(S.dem(spark, sf)), S.ortho(spark, sf).meta)
    return out.select(*_cell(out), rnd("u").alias("u6"), rnd("v").alias("v6"))


@query
def q_textured_terrain(spark, sf):
    from dataclasses import replace
    photo = S.ortho(spark, sf)
    # The photo is shifted east by 4.25 pixels, so part of the terrain is off it.
    photo = raster.Raster(replace(photo.meta, x0=photo.meta.x0 + 4.25 * photo.meta.dx), photo.tiles)
    out = terrain.textured_terrain(terrain.terrain_mesh(S.dem(spark, sf)), photo)
    return out.select(*_cell(out), *[F.col(c).cast("long").alias(c) for c in ("red", "green", "blue")])


@query
def q_geometry_kinds(spark, sf):
    mixed = layers.Layer("mixed", S.samples(spark, sf).df.select("fid", "geometry").unionByName(
        S.polygons(spark, sf).df.select("fid", "geometry")))
    return layers.geometry_kinds(mixed)


@query
def q_terrain_model(spark, sf):
    model = terrain.build_terrain_model(
        {"samples": S.samples(spark, sf), "polygons": S.polygons(spark, sf)},
        {"dem": S.dem(spark, sf), "ortho": S.ortho(spark, sf)}, orthophoto_name="ortho", z_exaggeration=2.0)
    ground = model["terrain"].select(F.lit("terrain").alias("layer"), F.col("z"))
    return ground.unionByName(model["draped"].select("layer", "z")).groupBy("layer").agg(
        F.count(F.lit(1)).alias("n"), F.count("z").alias("n_z"), F.sum(rnd("z")).alias("z6"))


# ---- sinks and the whole run ---------------------------------------------------------------------

@query
def q_roundtrip_parquet(spark, sf):
    path = writers.write_parquet_layer(S.polygons(spark, sf), scratch("parquet"))
    got = readers.read_parquet_layer(spark, path, "polygons")
    return got.df.select("fid", F.lit(got.epsg).cast("long").alias("epsg"), G.is_present("geometry").alias("present"),
                         rnd(F.array_min(G.vertices("geometry").getField("x"))).alias("x6"))


@query
def q_to_geojson(spark, sf):
    text = writers.geojson_features(S.samples(spark, sf))
    get = lambda p: F.get_json_object("value", p)
    return text.select(get("$.properties.sample_id").cast("long").alias("sample_id"), get("$.type").alias("type"),
                       get("$.geometry.type").alias("kind"), rnd(get("$.geometry.coordinates[0]").cast("double")).alias("x6"),
                       rnd(get("$.geometry.coordinates[1]").cast("double")).alias("y6"), get("$.properties.litho").alias("litho"))


@query
def q_roundtrip_raster(spark, sf):
    path = writers.write_raster(spark, S.dem(spark, sf), scratch("raster"))
    got = raster.pixels(readers.read_one_raster(spark, path, "dem"), null_nodata=True)
    return got.select(*_cell(got), rnd("v", 1e4).alias("v4"))


@query
def q_samples_end_to_end(spark, sf):
    folder = scratch_folder("run")
    S.sample_table(spark, sf).write.option("header", True).csv(f"{folder}/samples.csv")
    writers.write_parquet_layer(S.study_area(spark), f"{folder}/study.parquet")
    dem_path = writers.write_raster(spark, S.dem(spark, sf), f"{folder}/dem.parquet")
    result = run_pipeline(spark, dem=dem_path, samples=f"{folder}/samples.csv", study_area=f"{folder}/study.parquet",
                          lon_col="lon", lat_col="lat", output_dir=f"{folder}/out",
                          field_map={"samples": {"litho": "rock"}}, canonical_fields={"rock": "str", "assay": "float"})
    saved = readers.read_parquet_layer(spark, f"{folder}/out/samples_processed.parquet", "samples").df
    assert all(r["passed"] for r in result["qa"].collect())
    return saved.select(F.col("sample_id").cast("long").alias("sample_id"), "rock", rnd("assay").alias("assay6"),
                        rnd(G.point_x("geometry")).alias("x6"))


@query
def q_terrain_samples(spark, sf):
    """Flagship: samples clipped to the study area, draped on the elevation grid, in display space."""
    inside = clip.clip_points(S.samples(spark, sf), mask.build_mask(S.study_area(spark)))
    return _draped(terrain.drape(inside, S.dem(spark, sf), 2.0))
