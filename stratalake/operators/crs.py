"""CRS harmonisation of vector layers, and the check of the result."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.functions.projection import is_supported, project_geometry
from stratalake.operators.layers import Layer, total_bounds, union_all


def reproject(layer: Layer, epsg: int) -> Layer:
    """Layer in another CRS.  Already right: the very same rows.  No CRS: an error."""
    if layer.epsg is None:
        raise ValueError(f"layer '{layer.name}' has no CRS defined; set crs_epsg for this source")
    if layer.epsg == epsg:
        return layer
    if not is_supported(layer.epsg) or not is_supported(epsg):
        raise ValueError(f"layer '{layer.name}': cannot reproject EPSG:{layer.epsg} to EPSG:{epsg}")
    df = project_geometry(layer.df, layer.epsg, epsg)
    if "seg_cell" in df.columns:
        # The grid size of multi-row paths only steers how work is spread; keep it in the new unit.
        df = df.withColumn("seg_cell", F.col("seg_cell") * (_unit(layer.epsg) / _unit(epsg)))
    return replace(layer, df=df, epsg=epsg)


def _unit(epsg: int) -> float:
    """Metres per unit, roughly."""
    return 111320.0 if epsg == 4326 else 1.0


def wgs84_bounds(layers: dict[str, Layer]) -> DataFrame:
    """Total bounds per layer and whether they fit the globe; an empty layer passes."""
    reports = []
    for name, layer in layers.items():
        c = F.col
        bad = (c("xmin") < -180) | (c("xmax") > 180) | (c("ymin") < -90) | (c("ymax") > 90)
        reports.append(total_bounds(layer).select(
            F.lit(name).alias("layer"), "xmin", "ymin", "xmax", "ymax",
            (~F.coalesce(bad, F.lit(False))).alias("in_range")))
    return union_all(reports)


def harmonize_crs(layers: dict[str, Layer], epsg: int = 4326, check: bool = True,
                  check_skipped: bool = False) -> dict[str, Layer]:
    """All layers in one CRS.  With ``check`` the bounds of layers projected to degrees are verified in
    one action; ``check_skipped`` includes layers that were in degrees already."""
    out = {name: reproject(layer, epsg) for name, layer in layers.items()}
    suspect = {n: v for n, v in out.items() if check_skipped or layers[n].epsg != epsg}
    if check and epsg == 4326 and suspect:
        bad = wgs84_bounds(suspect).filter("not in_range").collect()
        if bad:
            raise ValueError("; ".join(
                f"layer '{r['layer']}' has coordinates outside degrees: "
                f"({r['xmin']:.2f}, {r['ymin']:.2f}, {r['xmax']:.2f}, {r['ymax']:.2f})" for r in bad))
    return out
