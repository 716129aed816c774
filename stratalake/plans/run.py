"""The end-to-end run: audit, load, CRS, repair, clip, schema, quality report, save."""

from __future__ import annotations

import time

from pyspark.sql import SparkSession

from stratalake.operators import crs, qa, repair, schema
from stratalake.operators.audit import audit_gate, source_audit
from stratalake.operators.clip import clip_layer
from stratalake.operators.layers import Layer, registry
from stratalake.operators.lineage import materialize
from stratalake.operators.mask import Mask, build_mask
from stratalake.operators.raster import Raster, clip_raster
from stratalake.operators.terrain import build_terrain_model
from stratalake.operators.warp import warp_rasters
from stratalake.plans.config import GeometrySettings, RunConfig, SpatialSettings, VectorSource, config_from_arguments
from stratalake.sources.readers import load_all_sources, read_vector
from stratalake.sources.writers import save_rasters, save_vectors


def load_study_area(spark: SparkSession, spatial: SpatialSettings, geometry: GeometrySettings) -> Layer:
    """The study area, repaired by the same rules as every other layer."""
    layer = read_vector(spark, VectorSource("study_area", spatial.study_area_path, optional=False))
    return repair.repair_layers({"study_area": layer}, geometry.auto_repair, geometry.drop_null_geometries,
                                geometry.validity_threshold)["study_area"]


def masks_by_crs(study: Layer, codes: set[int]) -> dict[int, Mask]:
    """The study area as a mask in each CRS that needs one."""
    return {code: build_mask(crs.reproject(study, code)) for code in codes}


def clip_set(layers: dict[str, Layer], rasters: dict[str, Raster], study: Layer) -> tuple[dict, dict]:
    masks = masks_by_crs(study, {v.epsg for v in layers.values()} | {r.meta.epsg for r in rasters.values()})
    return ({n: clip_layer(v, masks[v.epsg]) for n, v in layers.items()},
            {n: clip_raster(r, masks[r.meta.epsg]) for n, r in rasters.items()})


def run_config(spark: SparkSession, config: RunConfig) -> dict:
    """Run all stages; ``{"vectors", "rasters", "qa", "saved", "config", "report"}``.

    The clipped layers are checkpointed once: the quality report and the writer both read them.
    """
    start = time.perf_counter()
    audit_gate(source_audit(spark, config))
    vectors, rasters, tabulars = load_all_sources(spark, config)
    layers = registry(vectors, tabulars)
    epsg = config.crs.project_epsg
    layers = crs.harmonize_crs(layers, epsg)
    rasters = warp_rasters(spark, rasters, epsg)
    g = config.geometry
    layers = repair.repair_layers(layers, g.auto_repair, g.drop_null_geometries, g.validity_threshold)
    if config.spatial.clip_to_study_area:
        layers, rasters = clip_set(layers, rasters, load_study_area(spark, config.spatial, g))
    field_maps = {s.name: s.field_map for s in [*config.vector_sources, *config.tabular_sources]}
    layers = schema.harmonize_layers(layers, field_maps, config.schema.canonical_fields, config.schema.drop_extra_fields)
    layers = {name: layer.with_df(materialize(layer.df)) for name, layer in layers.items()}
    q = config.qa
    report = None
    if layers:
        report = qa.qa_report(layers, epsg, min_rows=q.min_row_count, max_rows=q.max_row_count, required=q.required_fields)
        qa.qa_gate(report, q.halt_on_failure)
    saved = save_vectors(layers, config.output.directory, config.output.vector_format)
    failed: dict[str, str] = {}
    if config.output.save_rasters:
        raster_paths, failed = save_rasters(spark, rasters, config.output.directory)
        saved += raster_paths
    summary = {"seconds": time.perf_counter() - start, "layers": len(layers), "rasters": len(rasters),
               "files": len(saved), "failed_rasters": failed}
    return {"vectors": layers, "rasters": rasters, "qa": report, "saved": saved, "config": config, "report": summary}


def terrain_model(result: dict, **changes) -> dict:
    """Terrain and draped layers of a run, with the elevation model, photo and exaggeration of its configuration."""
    t = result["config"].terrain
    photo = t.orthophoto_name if t.orthophoto_name in result["rasters"] else None
    settings = {"dem_name": t.dem_name, "orthophoto_name": photo, "z_exaggeration": t.z_exaggeration} | changes
    return build_terrain_model(result["vectors"], result["rasters"], **settings)


def run_pipeline(spark: SparkSession, **arguments) -> dict:
    """Run from plain arguments, see ``config_from_arguments``."""
    return run_config(spark, config_from_arguments(**arguments))
