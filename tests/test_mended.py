"""NULL join keys spread, dates of many forms, NaN pixels, nodata before merging, filters that reach the scan,
paths in several rows, collapsed polygons, unreadable files."""

import datetime

import pytest
from pyspark.sql import functions as F

from stratalake.operators import audit, joins, layers, noding, raster, repair, schema, terrain, validity
from stratalake.operators.layers import Layer
from stratalake.operators.raster import RasterMeta
from stratalake.plans.config import RasterSource, VectorSource
from stratalake.sources import readers, writers


def test_null_keys_spread(spark):
    probe = spark.range(40_000).select("id", F.when(F.col("id") % 10 == 0, F.col("id") % 500).alias("k"))
    build = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.skew_join(probe, build, ["k"], "left")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 40_000 and max(sizes) < 0.6 * 40_000
        assert joined.filter("k is not null and v <> 2 * k or k is null and v is not null").count() == 0
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dates(spark):
    forms = ["2021-03-04T05:06:07Z", "2021-03-04 05:06:07.123", "2021-03-04 05:06", "03/04/2021", "04.03.2021", "2021/03/04", "soon", None]
    df = spark.createDataFrame([(x,) for x in forms], "d string")
    got = [r["d"] for r in schema.cast_field(df, "d", "datetime").collect()]
    day = datetime.datetime(2021, 3, 4)
    assert got == [day.replace(hour=5, minute=6, second=7), day.replace(hour=5, minute=6, second=7, microsecond=123000),
                   day.replace(hour=5, minute=6), day, day, day, None, None]
    assert schema.cast_failures(df, {"d": "datetime"}, ("datetime",)).first()["n_bad"] == 1
    exact = df.select(F.lit("2021-03-04 05:06:07.5").cast("timestamp").alias("d")).limit(1)
    assert schema.cast_field(exact, "d", "datetime").first()["d"] == day.replace(hour=5, minute=6, second=7, microsecond=500000)


def flat(spark, name, value):
    meta = RasterMeta(name, 4326, 0.0, 2.0, 1.0, 1.0, 2, 2, 1, None, "float64")
    rows = spark.range(4).select(F.lit(1).alias("band"), F.floor(F.col("id") / 2).alias("r"), (F.col("id") % 2).alias("c"), F.lit(value).alias("v"))
    return raster.from_pixels(rows, meta)


def test_nodata_is_known_before_merging(spark, tmp_path):
    paths = [writers.write_raster(spark, flat(spark, n, v), str(tmp_path / f"{n}.parquet")) for n, v in (("a", -32768.0), ("b", 5.0))]
    merged = readers.read_raster(spark, RasterSource("dem", paths, nodata=-32768))
    assert {r["v"] for r in raster.pixels(merged, null_nodata=True).collect()} == {5.0}


def test_nan_pixels_are_null(spark):
    assert {r["v"] for r in raster.pixels(flat(spark, "n", float("nan"))).collect()} == {None}


def test_filter_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "x.parquet")
    spark.range(10).select(F.col("id").alias("n"), F.lit(None).cast(
        "struct<type:string,parts:array<array<array<struct<x:double,y:double>>>>>").alias("geometry")).write.parquet(path)
    layer = readers.read_vector(spark, VectorSource("x", path, filter_expr="n > 7"))
    plan = layer.df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(n,7)" in plan and layer.df.count() == 2


@pytest.mark.parametrize("rows", [2, 3])
def test_a_path_in_several_rows_gives_the_same(spark, rows):
    points = {1: [(0, 0), (4, 4), (4, 0), (0, 4), (0, 6), (2, 6), (5, 6)], 2: [(0, 0), (1, 0), (2, 0), (3, 0), (4, 1), (5, 0)],
              3: [(0, 0), (1, 0), (2, 0), (3, 0), (2, 0), (1, 0), (0, 0)], 4: [(0, 0), (1, 1)]}
    vertices = spark.createDataFrame([(f, k, float(x), float(y)) for f, path in points.items() for k, (x, y) in enumerate(path)],
                                     "fid long, k long, x double, y double")
    numbered = layers.path_vertices(vertices, "fid", ["k"])

    def of(n):
        return Layer("lines", layers.assemble_paths(numbered, rows=n), 4326, ("fid", "seq"), frozenset({"line"}))

    def seen(layer):
        columns = ["fid", "part", "i", "lon", "lat"]
        noded = noding.node_lines(layer)
        return (sorted(map(tuple, terrain.drape_vertices(layer).select(*columns).collect())),
                sorted(map(tuple, terrain.drape_vertices(noded).select(*columns).collect())),
                sorted(map(tuple, validity.line_faults(noded).collect())),
                layers.inventory({"lines": layer}).first()["n_rows"], layers.vector_profile(noded).first()["features"])

    assert seen(of(rows)) == seen(of(1000))


def test_collapsed_polygons_leave(spark):
    shapes = [[(0, 0), (1, 1), (2, 2), (0, 0)], [(0, 0), (1, 1), (0, 0), (0, 0)], [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]
    df = spark.createDataFrame([(k, ("Polygon", [[[(float(x), float(y)) for x, y in ring]]])) for k, ring in enumerate(shapes)],
                               "fid long, geometry struct<type:string,parts:array<array<array<struct<x:double,y:double>>>>>")
    layer = Layer("p", df, 4326, kinds=frozenset({"polygon"}))
    assert {r["fid"]: r["geometry"] is None for r in repair.repair_polygons(layer).df.collect()} == {0: True, 1: True, 2: False, 3: False}
    rate = validity.validity_rate(repair.repair_layer(layer)).first()
    assert (rate["n_rows"], rate["rate"]) == (2, 1.0)


@pytest.mark.parametrize("ending, content", [
    ("geojson", '{"type":"FeatureCollection","features":[{"type":"Feature","geometry":null,"properties":{"a":"b"}},{"ty'),
    ("geojson", '{"type":"FeatureCollection"}'),
    ("geojsonl", '{"type":"Feature","geometry":null,"properties":{"a":"b"}}\n\n{"type":"Feat'), ("kml", "no xml at all")])
def test_bad_files_are_errors(spark, tmp_path, ending, content):
    path = tmp_path / f"x.{ending}"
    path.write_text(content)
    with pytest.raises(ValueError, match="cannot be read"):
        readers.read_vector(spark, VectorSource("x", str(path)))
    assert "cannot be read" in audit._readable(spark, "vector", VectorSource("x", str(path)), str(path))


@pytest.mark.parametrize("fids", ['"A-1", 2', "7, 7", "null, 1"])
def test_a_fid_that_names_no_rows_is_an_attribute(spark, tmp_path, fids):
    path = tmp_path / "x.geojsonl"
    path.write_text("\n".join('{"type":"Feature","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"fid":%s}}' % f
                              for f in fids.split(", ")))
    rows = readers.read_vector(spark, VectorSource("x", str(path))).df.collect()
    assert len({r["fid"] for r in rows}) == 2 and [r["source_fid"] for r in rows] == [None if f == "null" else f.strip('"') for f in fids.split(", ")]


def test_sample_raster_holds_a_part_row(spark, tmp_path):
    from checks import sample_layers

    spark.range(45).selectExpr("id as p_partkey", "cast(9 as int) as p_size", "cast(id as double) as p_retailprice").write.parquet(
        f"{tmp_path}/part.parquet")
    rows = {r["r"] for r in sample_layers.dem_pixels(spark, str(tmp_path)).select("r").collect()}
    for raster in (sample_layers.dem(spark, str(tmp_path)), sample_layers.dem_utm(spark, str(tmp_path))):
        assert raster.meta.height == max(rows) + 1 == 3
