import pytest
from pyspark.sql import functions as F

from layer_cases import BOWTIE, SQUARE
from stratalake.operators import qa, schema
from stratalake.operators.layers import Layer


@pytest.fixture()
def messy(spark):
    df = spark.createDataFrame([(1, " TEST_AREA\t", None, "2020-01-02", "1.5"), (2, "b ", "x", "bad", "4")],
                               "fid bigint, Name string, description string, seen string, n string")
    return df.withColumn("geometry", F.lit(None).cast("struct<type:string,parts:array<array<array<struct<x:double,y:double>>>>>"))


def test_rename_and_trim(messy):
    out = schema.harmonize_layer(messy, {"Name": "feature_name", "nope": "x"}, {})
    rows = {r["fid"]: r for r in out.collect()}
    assert rows[1]["feature_name"] == "TEST_AREA" and rows[2]["feature_name"] == "b" and rows[1]["description"] is None
    assert schema.normalize_text(messy, null_text=True).first()["description"] == "None"
    with pytest.raises(ValueError):
        schema.rename_fields(messy, {"Name": "description"})


def test_drop_extra_keeps_geometry(messy):
    out = schema.harmonize_layer(messy, {"Name": "feature_name"}, {"feature_name": "str"}, drop_extra=True)
    assert set(out.columns) == {"feature_name", "geometry"}
    out = schema.harmonize_layer(messy, {}, {"other": "str"}, drop_extra=True)
    assert set(out.columns) == {"other", "geometry"} and out.first()["other"] is None


def test_casts(messy):
    with pytest.raises(ValueError, match="column 'n' has 1 values"):
        schema.check_casts({"t": Layer("t", messy)}, {}, {"n": "int"})
    got = {r["fid"]: r for r in schema.harmonize_layer(messy, {}, {"n": "float", "seen": "datetime"}).collect()}
    assert got[1]["n"] == 1.5 and str(got[1]["seen"]) == "2020-01-02 00:00:00" and got[2]["seen"] is None
    with pytest.raises(ValueError):
        schema.harmonize_layer(messy, {}, {"n": "decimal"})


def report(layer, **kw):
    return {r["check"]: r for r in qa.qa_report({"test": layer}, kw.pop("epsg", 4326), **kw).collect()}


def test_qa_checks(make_layer):
    good = report(make_layer([(1, "Polygon", [[SQUARE]])]))
    assert len(good) == 5 and all(r["passed"] for r in good.values())
    empty = report(make_layer([]))
    assert not empty["row_count"]["passed"] and empty["geometry_validity"]["message"] == "empty layer, skipped"
    assert not report(make_layer([(1, "Polygon", [[SQUARE]])]), epsg=32633)["crs_match"]["passed"]
    assert not report(make_layer([(1, "Polygon", [[SQUARE]])], epsg=None))["crs_match"]["passed"]
    assert not report(make_layer([(1, "Polygon", None)]))["geometry_not_null"]["passed"]
    half = report(make_layer([(1, "Polygon", [[SQUARE]]), (2, "Polygon", [[BOWTIE]])]), max_rows=1)
    assert half["geometry_validity"]["message"] == "50.0% of geometries are valid (expected 100%)"
    assert half["row_count"]["message"] == "row count 2 exceeds maximum 1"


def test_qa_gate(make_layer):
    rows = qa.qa_report({"test": make_layer([(1, "Polygon", [[SQUARE]])])}, 4326, required=["population"])
    assert len(qa.qa_gate(rows, halt_on_failure=False)) == 1
    with pytest.raises(ValueError, match="population"):
        qa.qa_gate(rows)
    assert qa.qa_summary(rows).first().asDict() == {"n_passed": 4, "n_total": 5}
