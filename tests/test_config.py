import pytest

from stratalake.plans.config import (
    GeometrySettings, OutputSettings, QaSettings, RasterSource, RunConfig, SpatialSettings, VectorSource,
    config_from_arguments, sample_sources,
)


def test_needs_a_source():
    with pytest.raises(ValueError):
        RunConfig(spatial=SpatialSettings("area.geojson"))


def test_needs_a_study_area():
    with pytest.raises(ValueError):
        RunConfig(raster_sources=[RasterSource("dem", "dem.parquet", optional=False)])


def test_source_and_study_area_are_enough():
    config = RunConfig(raster_sources=[RasterSource("dem", "dem.parquet", optional=False)],
                       spatial=SpatialSettings("area.geojson"))
    assert len(config.raster_sources) == 1 and config.spatial.study_area_path == "area.geojson"


def test_defaults():
    assert GeometrySettings() == GeometrySettings(True, True, 0.95)
    assert QaSettings().halt_on_failure and QaSettings().min_row_count == 1 and QaSettings().max_row_count is None
    assert VectorSource("t", "t.geojson").optional and VectorSource("t", "t.geojson").field_map == {}


def test_arguments():
    config = config_from_arguments(dem=["a.parquet", "b.parquet"], samples=["x.csv", "y.csv"], study_area="s.kml",
                                   field_map={"samples_1": {"a": "b"}})
    assert config.raster_sources[0].path == ["a.parquet", "b.parquet"] and not config.raster_sources[0].optional
    assert [s.name for s in config.tabular_sources] == ["samples_0", "samples_1"]
    assert config.tabular_sources[1].field_map == {"a": "b"}
    assert not config.qa.halt_on_failure and config.terrain.z_exaggeration == 2.0
    with pytest.raises(ValueError):
        config_from_arguments(study_area="s.kml")
    with pytest.raises(ValueError):
        OutputSettings(vector_format="gpkg")


def test_sample_names():
    assert [s.name for s in sample_sources("x.csv", "lon", "lat", {})] == ["samples"]
    assert [s.name for s in sample_sources({"holes": "x.csv"}, "lon", "lat", {})] == ["holes"]
    assert sample_sources(None, "lon", "lat", {}) == []
