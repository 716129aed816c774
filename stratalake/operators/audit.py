"""Pre-flight audit: every source is looked at before any is loaded, all faults are reported at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.plans.config import RunConfig, VectorSource
from stratalake.sources.files import extension, path_size
from stratalake.sources.readers import read_one_raster, read_vector, require_columns

# Accepted file name endings per kind of source.
EXTENSIONS = {
    "vector": [".geojson", ".json", ".geojsonl", ".kml", ".parquet"],
    "raster": [".parquet"],
    "tabular": [".csv"],
}

AUDIT_SCHEMA = "source string, kind string, path string, status string, message string"


ABSENT, OPTIONAL_ABSENT = "does not exist", "does not exist, may be left out"


def audit_path(spark: SparkSession, name: str, kind: str, path: str, optional: bool) -> tuple[str, str]:
    """Status ``ok``, ``skipped`` or ``error`` of a path: there, not empty, known ending."""
    size = path_size(spark, path)
    if size is None:
        return ("skipped", OPTIONAL_ABSENT) if optional else ("error", ABSENT)
    if size == 0:
        return "error", "has 0 bytes"
    if extension(path) not in EXTENSIONS[kind]:
        return "error", f"ending '{extension(path)}' is none of {EXTENSIONS[kind]}"
    return "ok", ""


def _readable(spark: SparkSession, kind: str, src, path: str) -> str:
    """Empty text, or why the source cannot be read.  Headers and schemas are read, GeoJSON and KML whole."""
    try:
        if kind == "tabular":
            require_columns(spark.read.option("header", True).csv(path).limit(5).columns, src.lon_col, src.lat_col, src.name)
        elif kind == "raster":
            read_one_raster(spark, path, src.name)
        else:
            read_vector(spark, VectorSource(src.name, path)).df.schema  # noqa: B018
        return ""
    except Exception as e:
        return str(e).splitlines()[0]


def _audit_source(spark: SparkSession, src, kind: str) -> list[tuple]:
    """Rows of one source; after its first fault the rest of the source is not looked at."""
    paths = src.path if isinstance(src.path, list) else [src.path]
    states = [(p, *audit_path(spark, src.name, kind, p, src.optional)) for p in paths]
    absent = [(p, s, m) for p, s, m in states if s == "skipped" or m == ABSENT]
    if absent:
        return [(src.name, kind, p, s, m) for p, s, m in absent]
    for path, status, message in states:
        message = message or _readable(spark, kind, src, path)
        if message:
            return [(src.name, kind, path, "error", message)]
    return [(src.name, kind, p, "ok", "") for p in paths]


def source_audit(spark: SparkSession, config: RunConfig) -> DataFrame:
    """``source, kind, path, status, message`` over all configured sources and the study area; a
    ``warning`` row tells when no raster carries the DEM's name."""
    rows: list[tuple] = []
    for kind, sources in (("vector", config.vector_sources), ("raster", config.raster_sources),
                          ("tabular", config.tabular_sources)):
        for src in sources:
            rows += _audit_source(spark, src, kind)
    rows += _audit_source(spark, VectorSource("study_area", config.spatial.study_area_path, optional=False), "vector")
    if config.terrain.dem_name not in [s.name for s in config.raster_sources]:
        rows.append((config.terrain.dem_name, "raster", "", "warning", "no raster source has the DEM's name; no terrain"))
    return spark.createDataFrame(rows, AUDIT_SCHEMA)


def audit_gate(report: DataFrame) -> None:
    """Raise once, naming all errors."""
    errors = report.filter(F.col("status") == "error").collect()
    if errors:
        raise ValueError(f"{len(errors)} problem(s) with sources: " + "; ".join(f"{e['source']} at '{e['path']}' {e['message']}" for e in errors))
