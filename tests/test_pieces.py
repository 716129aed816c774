"""Collections of several kinds, stored ids that name no rows, nested holes and shells."""

import json

import pytest
from pyspark.sql import functions as F

from layer_cases import SQUARE
from stratalake.functions import geometry as G
from stratalake.operators import validity
from stratalake.plans.config import VectorSource
from stratalake.sources import readers


def square(x, y, size):
    return [(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]


def kinds(layer):
    rows = layer.df.collect()
    assert len({r["fid"] for r in rows}) == len(rows)
    return sorted((r["geometry"]["type"], len(r["geometry"]["parts"])) if r["geometry"] else ("", 0) for r in rows)


@pytest.mark.parametrize("ending", ["geojson", "geojsonl"])
def test_geometry_collection(spark, tmp_path, ending):
    members = [{"type": "Point", "coordinates": [1, 2]}, {"type": "MultiPoint", "coordinates": [[3, 4], [5, 6]]},
               {"type": "LineString", "coordinates": [[0, 0], [1, 1]]}, {"type": "Polygon", "coordinates": [SQUARE]}]
    features = [{"type": "Feature", "properties": {"fid": k}, "geometry": g} for k, g in enumerate(
        [{"type": "GeometryCollection", "geometries": members}, {"type": "GeometryCollection", "geometries": []}, members[2], None])]
    path = tmp_path / f"x.{ending}"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}) if ending == "geojson" else "\n".join(map(json.dumps, features)))
    layer = readers.read_vector(spark, VectorSource("x", str(path)))
    assert kinds(layer) == [("", 0), ("", 0), ("LineString", 1), ("LineString", 1), ("MultiPoint", 3), ("Polygon", 1)]
    assert sorted(r["source_fid"] for r in layer.df.collect()) == ["0", "0", "0", "1", "2", "3"]


def test_kml_of_several_kinds(spark, tmp_path):
    ring = "<outerBoundaryIs><LinearRing><coordinates>0,0 4,0 4,4 0,0</coordinates></LinearRing></outerBoundaryIs>"
    path = tmp_path / "x.kml"
    path.write_text(f"""<kml><Document><Placemark><name>a</name><MultiGeometry><Point><coordinates>1,2</coordinates></Point>
      <LineString><coordinates>0,0 1,1</coordinates></LineString><Polygon>{ring}</Polygon><Point><coordinates>3,4</coordinates></Point>
      </MultiGeometry></Placemark><Placemark><name>b</name></Placemark></Document></kml>""")
    layer = readers.read_vector(spark, VectorSource("x", str(path)))
    assert kinds(layer) == [("", 0), ("MultiLineString", 1), ("MultiPoint", 2), ("MultiPolygon", 1)]
    assert sorted(r["Name"] for r in layer.df.collect()) == ["a", "a", "a", "b"]


@pytest.mark.parametrize("fids, named", [([1, 2, 3], True), ([1, 1, 2], False), ([1, None, 2], False), (["a", "b", "c"], False)])
def test_stored_ids(spark, tmp_path, fids, named):
    path = str(tmp_path / "x.parquet")
    kind = "string" if fids[0] == "a" else "long"
    spark.createDataFrame([(f, float(k)) for k, f in enumerate(fids)], f"fid {kind}, x double").select(
        "fid", "x", G.point("x", "x").alias("geometry")).write.parquet(path)
    rows = readers.read_vector(spark, VectorSource("x", path)).df.collect()
    assert len({r["fid"] for r in rows}) == 3 and None not in {r["fid"] for r in rows}
    assert ("source_fid" in rows[0].asDict()) != named
    assert {r["fid" if named else "source_fid"] for r in rows} == set(fids)


def test_lines_stored_in_several_rows(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.range(4).select(F.lit(7).cast("long").alias("fid"), F.col("id").alias("seq"), G.point("id", "id").alias("geometry")).write.parquet(path)
    layer = readers.read_vector(spark, VectorSource("x", path))
    assert layer.key == ("fid", "seq") and {r["fid"] for r in layer.df.collect()} == {7}


def test_nested_holes_and_shells(make_layer):
    big, hole, inner, aside = square(0, 0, 10), square(1, 1, 6), square(2, 2, 1), square(8, 8, 1)
    diamond = [(5, 0), (10, 5), (5, 10), (0, 5), (5, 0)]
    layer = make_layer([
        (1, "Polygon", [[big, hole, inner]]), (2, "Polygon", [[big, inner, hole]]), (3, "Polygon", [[big, inner, aside]]),
        (4, "Polygon", [[big, hole, [(1, 1), (3, 2), (2, 3), (1, 1)]]]), (5, "MultiPolygon", [[big, hole], [inner]]),
        (6, "MultiPolygon", [[big], [diamond]]), (7, "MultiPolygon", [[diamond], [big]]), (8, "MultiPolygon", [[square(0, 0, 2)], [square(2, 2, 2)]]),
        (9, "MultiPolygon", [[big, hole], [aside]]), (10, "MultiPolygon", [[square(20, 0, 2)], [big, hole]])])
    got = {r["fid"]: r["reason"] for r in validity.with_validity(layer).collect()}
    assert got == {1: "Holes are nested", 2: "Holes are nested", 3: None, 4: "Holes are nested", 5: None, 6: "Nested shells",
                   7: "Nested shells", 8: None, 9: "Nested shells", 10: None}
