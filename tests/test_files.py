import json

import pytest

from checks import sample_layers as S
from layer_cases import SF
from stratalake.functions import geometry as G
from stratalake.operators.layers import Layer
from stratalake.operators.audit import audit_gate, source_audit
from stratalake.plans.config import RasterSource, RunConfig, SpatialSettings, TabularSource, VectorSource
from stratalake.plans.run import run_pipeline
from stratalake.sources import readers, writers


def area_file(tmp_path, features=True):
    feature = {"type": "Feature", "properties": {"zone": "north"}, "geometry": {"type": "Polygon", "coordinates": [
        [[70.2, 35.2], [70.8, 35.2], [70.8, 35.8], [70.2, 35.8], [70.2, 35.2]]]}}
    path = tmp_path / "area.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature] if features else []}))
    return str(path)


def test_geojson_types_and_crs(spark, tmp_path):
    shapes = [("Point", [1, 2]), ("MultiPoint", [[1, 2], [3, 4]]), ("LineString", [[1, 2], [3, 4]]),
              ("MultiLineString", [[[1, 2], [3, 4]], [[5, 6], [7, 8]]]), ("Polygon", [[[0, 0], [2, 0], [2, 2], [0, 0]]]),
              ("MultiPolygon", [[[[0, 0], [2, 0], [2, 2], [0, 0]]], [[[5, 5], [6, 5], [6, 6], [5, 5]]]])]
    features = [{"type": "Feature", "properties": {"k": i}, "geometry": {"type": t, "coordinates": c}}
                for i, (t, c) in enumerate(shapes)] + [{"type": "Feature", "properties": {"k": 9}, "geometry": None}]
    path = tmp_path / "all.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features,
                                "crs": {"type": "name", "properties": {"name": "urn:ogc:def:crs:EPSG::32642"}}}))
    layer = readers.read_geojson(spark, str(path), "all")
    rows = {int(r["k"]): r["geometry"] for r in layer.df.collect()}
    assert layer.epsg == 32642 and rows[9] is None
    assert [rows[i]["type"] for i in range(6)] == [t for t, _ in shapes]
    assert [len(rows[i]["parts"]) for i in range(6)] == [1, 2, 1, 2, 1, 2]
    out = str(tmp_path / "out.geojsonl")
    writers.write_geojson_layer(Layer("all", layer.df, 4326), out)
    again = {int(r["k"]): r["geometry"] for r in readers.read_geojson(spark, out, "all", lines=True).df.collect()}
    assert again == rows


def test_kml(spark, tmp_path):
    path = tmp_path / "a.kml"
    path.write_text("""<?xml version="1.0"?><kml xmlns="http://www.opengis.net/kml/2.2"><Document>
      <Placemark><name>hole</name><Polygon><outerBoundaryIs><LinearRing><coordinates>0,0,5 4,0,5 4,4,5 0,0,5</coordinates></LinearRing></outerBoundaryIs>
        <innerBoundaryIs><LinearRing><coordinates>2,1 3,1 3,2 2,1</coordinates></LinearRing></innerBoundaryIs></Polygon></Placemark>
      <Placemark><name>track</name><MultiGeometry><LineString><coordinates>0,0 1,1</coordinates></LineString>
        <LineString><coordinates>2,2 3,3</coordinates></LineString></MultiGeometry></Placemark>
      <Placemark><name>pt</name><Point><coordinates> 7,8 </coordinates></Point></Placemark></Document></kml>""")
    rows = {r["Name"]: r["geometry"] for r in readers.read_kml(spark, str(path), "a").df.collect()}
    assert len(rows["hole"]["parts"][0]) == 2 and rows["track"]["type"] == "MultiLineString"
    assert rows["pt"]["parts"][0][0][0]["x"] == 7.0


def test_csv_points(spark, tmp_path):
    path = tmp_path / "s.csv"
    path.write_text("id,longitude,latitude\n1,70.5,35.5\n2,N/A,35.1\n3,,\n")
    layer = readers.read_points(spark, TabularSource("s", str(path)))
    assert [r["geometry"] is not None for r in layer.df.orderBy("id").collect()] == [True, False, False]
    path.write_text("id,longitude,latitude\n1,east,35.5\n")
    with pytest.raises(RuntimeError):
        readers.read_points(spark, TabularSource("s", str(path)))
    with pytest.raises(ValueError, match="available columns"):
        readers.read_points(spark, TabularSource("s", str(path), lon_col="lon"))


def test_filter_error_names_the_expression(spark):
    with pytest.raises(ValueError, match="nothing > 3"):
        readers.attribute_filter(S.sample_table(spark, SF), "nothing > 3", "s")


def test_audit(spark, tmp_path):
    area = area_file(tmp_path)
    dem = writers.write_raster(spark, S.dem(spark, SF), str(tmp_path / "dem.parquet"))
    ok = RunConfig(raster_sources=[RasterSource("dem", dem, optional=False)],
                   vector_sources=[VectorSource("path", str(tmp_path / "missing.kml"))], spatial=SpatialSettings(area))
    audit_gate(source_audit(spark, ok))
    bad = RunConfig(raster_sources=[RasterSource("dem", str(tmp_path / "no.parquet"), optional=False)],
                    spatial=SpatialSettings(str(tmp_path / "no.geojson")))
    with pytest.raises(ValueError, match="2 problem"):
        audit_gate(source_audit(spark, bad))
    (tmp_path / "empty.csv").write_text("")
    empty = RunConfig(tabular_sources=[TabularSource("s", str(tmp_path / "empty.csv"))], spatial=SpatialSettings(area))
    with pytest.raises(ValueError, match="0 bytes"):
        audit_gate(source_audit(spark, empty))


def test_end_to_end(spark, tmp_path):
    S.sample_table(spark, SF).write.option("header", True).csv(str(tmp_path / "samples.csv"))
    S.utm_table(spark, SF).selectExpr("sample_id", "easting as lon", "northing as lat").write.option("header", True).csv(
        str(tmp_path / "none.csv"))
    polys = S.polygons(spark, SF)
    writers.write_parquet_layer(polys, str(tmp_path / "blocks.parquet"))
    dem = writers.write_raster(spark, S.dem(spark, SF), str(tmp_path / "dem.parquet"))
    result = run_pipeline(spark, dem=dem, samples=str(tmp_path / "samples.csv"), vectors={"blocks": str(tmp_path / "blocks.parquet")},
                          study_area=area_file(tmp_path), lon_col="lon", lat_col="lat", output_dir=str(tmp_path / "out"),
                          field_map={"samples": {"litho": "rock"}})
    assert set(result) == {"vectors", "rasters", "qa", "saved", "config", "report"}
    assert result["report"]["layers"] == 2 and len(result["saved"]) == 3
    assert result["qa"].filter("not passed").count() == 0
    assert "rock" in result["vectors"]["samples"].df.columns
    saved = readers.read_parquet_layer(spark, str(tmp_path / "out/blocks_processed.parquet"), "blocks")
    bounds = G.with_envelope(saved.df).selectExpr("min(xmin)", "max(ymax)").first()
    assert saved.epsg == 4326 and bounds[0] >= 70.2 and bounds[1] <= 35.8
