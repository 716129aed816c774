import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from checks.compare import session
    s = session(partitions="4")
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def make_layer(spark):
    """Layer from ``(fid, type, parts)`` rows with parts as nested (x, y) tuples; parts None = no geometry."""
    from stratalake.functions.geometry import GEOMETRY
    from stratalake.operators.layers import Layer

    def build(rows, epsg=4326, name="test"):
        data = [(fid, "x", (kind, [[[(float(x), float(y)) for x, y in path] for path in part] for part in parts])
                 if parts is not None else None) for fid, kind, parts in rows]
        return Layer(name, spark.createDataFrame(data, f"fid bigint, name string, geometry {GEOMETRY}"), epsg)
    return build
