"""Run configuration as dataclasses, with the two checks every run needs."""

from __future__ import annotations

from dataclasses import dataclass, field

VECTOR_FORMATS = ("parquet", "geojson")


@dataclass
class VectorSource:
    name: str
    path: str
    layer: str | None = None
    field_map: dict[str, str] = field(default_factory=dict)
    filter_expr: str | None = None
    optional: bool = True


@dataclass
class RasterSource:
    """``path`` may be a list of rasters to be merged into one."""

    name: str
    path: str | list[str]
    band: int | None = None
    nodata: float | None = None
    optional: bool = True


@dataclass
class TabularSource:
    name: str
    path: str
    lon_col: str = "longitude"
    lat_col: str = "latitude"
    crs_epsg: int = 4326
    field_map: dict[str, str] = field(default_factory=dict)
    optional: bool = True


@dataclass
class CrsSettings:
    project_epsg: int = 4326


@dataclass
class GeometrySettings:
    auto_repair: bool = True
    drop_null_geometries: bool = True
    validity_threshold: float = 0.95


@dataclass
class SchemaSettings:
    canonical_fields: dict[str, str] = field(default_factory=dict)
    drop_extra_fields: bool = False


@dataclass
class SpatialSettings:
    study_area_path: str | None = None
    clip_to_study_area: bool = True


@dataclass
class QaSettings:
    min_row_count: int = 1
    max_row_count: int | None = None
    required_fields: list[str] = field(default_factory=list)
    halt_on_failure: bool = True


@dataclass
class OutputSettings:
    directory: str = "output"
    vector_format: str = "parquet"
    save_rasters: bool = True

    def __post_init__(self) -> None:
        if self.vector_format not in VECTOR_FORMATS:
            raise ValueError(f"vector format '{self.vector_format}' is not available; use one of {VECTOR_FORMATS}")


@dataclass
class TerrainSettings:
    dem_name: str = "dem"
    orthophoto_name: str | None = "orthophoto"
    z_exaggeration: float = 2.0


@dataclass
class RunConfig:
    name: str = "run"
    description: str = ""
    vector_sources: list[VectorSource] = field(default_factory=list)
    raster_sources: list[RasterSource] = field(default_factory=list)
    tabular_sources: list[TabularSource] = field(default_factory=list)
    crs: CrsSettings = field(default_factory=CrsSettings)
    geometry: GeometrySettings = field(default_factory=GeometrySettings)
    schema: SchemaSettings = field(default_factory=SchemaSettings)
    spatial: SpatialSettings = field(default_factory=SpatialSettings)
    qa: QaSettings = field(default_factory=QaSettings)
    output: OutputSettings = field(default_factory=OutputSettings)
    terrain: TerrainSettings = field(default_factory=TerrainSettings)

    def __post_init__(self) -> None:
        if not (self.vector_sources or self.raster_sources or self.tabular_sources):
            raise ValueError("no data sources: give at least one vector, raster or tabular source")
        if not self.spatial.study_area_path:
            raise ValueError("a study area is required: give the path of a boundary polygon")


def sample_sources(samples, lon_col: str, lat_col: str, field_map: dict[str, dict[str, str]]) -> list[TabularSource]:
    """One path -> ``samples``; a list -> ``samples_0 ..``; a dict keeps its names."""
    if samples is None:
        return []
    if isinstance(samples, dict):
        named = samples
    elif isinstance(samples, (list, tuple)):
        named = {f"samples_{i}": path for i, path in enumerate(samples)}
    else:
        named = {"samples": samples}
    return [TabularSource(name, str(path), lon_col, lat_col, field_map=field_map.get(name, {}))
            for name, path in named.items()]


def config_from_arguments(dem=None, orthophoto=None, samples=None, vectors=None, study_area=None,
                          lon_col="longitude", lat_col="latitude", project_crs=4326, output_dir="output",
                          vector_format="parquet", z_exaggeration=2.0, dem_name="dem",
                          orthophoto_name="orthophoto", field_map=None, canonical_fields=None,
                          drop_extra_fields=False) -> RunConfig:
    """Configuration from plain arguments.  A DEM is required once named; all else may be missing."""
    field_map = field_map or {}
    paths = lambda p: [str(x) for x in p] if isinstance(p, (list, tuple)) else str(p)
    rasters = []
    if dem:
        rasters.append(RasterSource(dem_name, paths(dem), optional=False))
    if orthophoto:
        rasters.append(RasterSource(orthophoto_name or "orthophoto", paths(orthophoto)))
    return RunConfig(
        vector_sources=[VectorSource(n, str(p), field_map=field_map.get(n, {})) for n, p in (vectors or {}).items()],
        raster_sources=rasters,
        tabular_sources=sample_sources(samples, lon_col, lat_col, field_map),
        crs=CrsSettings(project_crs),
        schema=SchemaSettings(canonical_fields or {}, drop_extra_fields),
        spatial=SpatialSettings(str(study_area) if study_area else None, study_area is not None),
        qa=QaSettings(halt_on_failure=False),
        output=OutputSettings(output_dir, vector_format),
        terrain=TerrainSettings(dem_name, orthophoto_name, z_exaggeration))
