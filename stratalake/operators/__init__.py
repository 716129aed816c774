"""DataFrame -> DataFrame operators over layers, rasters and reports."""
