"""Geological and GIS layers harmonised, clipped, checked and draped on terrain, on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the workers whole: they need not find it on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from stratalake.operators.layers import Layer  # noqa: E402
from stratalake.operators.raster import Raster, RasterMeta  # noqa: E402
from stratalake.operators.terrain import build_terrain_model  # noqa: E402
from stratalake.plans.run import run_config, run_pipeline, terrain_model  # noqa: E402

__all__ = ["Layer", "Raster", "RasterMeta", "build_terrain_model", "run_config", "run_pipeline", "terrain_model"]
