import pytest
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.functions.projection import project_columns
from stratalake.operators.crs import harmonize_crs, reproject


def test_right_crs_is_left_alone(make_layer):
    layer = make_layer([(1, "Point", [[[(10.123456789012345, 45.1)]]])])
    out = harmonize_crs({"t": layer})["t"]
    assert out is layer


def test_utm_point_reaches_degrees(make_layer):
    out = harmonize_crs({"t": make_layer([(1, "Point", [[[(500000, 4649776)]]])], epsg=32633)})["t"]
    row = out.df.select(G.point_x("geometry").alias("x"), G.point_y("geometry").alias("y")).first()
    assert out.epsg == 4326 and abs(row["x"] - 15) < 1e-9 and abs(row["y"] - 41.999998) < 1e-6


def test_no_crs_is_refused(make_layer):
    with pytest.raises(ValueError):
        harmonize_crs({"t": make_layer([(1, "Point", [[[(1, 1)]]])], epsg=None)})
    with pytest.raises(ValueError):
        reproject(make_layer([(1, "Point", [[[(1, 1)]]])], epsg=27700), 4326)


def test_wrong_crs_is_noticed(make_layer):
    wild = make_layer([(1, "Point", [[[(1e7, 4e7)]]])], epsg=3857)
    assert harmonize_crs({"t": wild}, 4326)["t"].epsg == 4326
    degrees_called_utm = make_layer([(1, "Point", [[[(900, 45)]]])])
    with pytest.raises(ValueError):
        harmonize_crs({"t": degrees_called_utm}, 4326, check_skipped=True)


@pytest.mark.parametrize("epsg", [32633, 32733, 3857])
def test_round_trip(spark, epsg):
    df = spark.range(200).select((12.0 + F.col("id") / 40).alias("x"), (-60.0 + F.col("id") * 0.6).alias("y"))
    there = project_columns(df, "x", "y", 4326, epsg, "u", "v")
    back = project_columns(there, "u", "v", epsg, 4326)
    worst = back.agg(F.max(F.abs(F.col("u") - F.col("x"))), F.max(F.abs(F.col("v") - F.col("y")))).first()
    assert max(worst) < 1e-8


def test_nested_geometries_match_plain_columns(make_layer, spark):
    ring = [(14, 45), (16, 45), (16, 46), (14, 45)]
    out = reproject(make_layer([(1, "Polygon", [[ring]])]), 32633).df
    got = [(r["x"], r["y"]) for r in G.explode_vertices(out, ["fid"]).orderBy("i").collect()]
    plain = project_columns(spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(ring)],
                                                  "i int, x double, y double"), "x", "y", 4326, 32633)
    assert got == [(r["x"], r["y"]) for r in plain.orderBy("i").collect()]
