"""Terrain model: elevation grid, draped features, display coordinates, orthophoto colours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import geometry as G
from stratalake.operators.joins import sized_join
from stratalake.operators.layers import Layer, kind_of, union_all
from stratalake.operators.raster import TILE, TILE_KEY, Raster, RasterMeta, pixels, sample_bilinear


def dem_grid(dem: Raster, band: int = 1) -> DataFrame:
    """``r, c, lon, lat, elevation``: pixel centres, nodata as NULL."""
    m = dem.meta
    px = pixels(dem.band(band), null_nodata=True)
    return px.select("r", "c", m.centre_x(F.col("c")).alias("lon"), m.centre_y(F.col("r")).alias("lat"),
                     F.col("v").alias("elevation"))


def horizontal_scale(meta: RasterMeta) -> tuple[float, float, float]:
    """Smallest lon, smallest lat and the larger of the two ranges, of the pixel centres: known from
    the grid itself, no scan."""
    lon = meta.x0 + 0.5 * meta.dx
    lat = meta.y0 - (meta.height - 0.5) * meta.dy
    return lon, lat, max((meta.width - 1) * meta.dx, (meta.height - 1) * meta.dy)


def normalize_xy(df: DataFrame, meta: RasterMeta, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Append display ``x, y``; a grid of one pixel maps to zero."""
    lon0, lat0, span = horizontal_scale(meta)
    scale = (lambda c, o: (F.col(c) - F.lit(o)) / F.lit(span)) if span > 0 else (lambda c, o: F.lit(0.0))
    return df.withColumns({"x": scale(lon, lon0), "y": scale(lat, lat0)})


def elevation_range(dem: Raster, band: int = 1) -> DataFrame:
    """One row ``range: struct<lo, hi>`` over the valid pixels, from per-tile extremes."""
    from stratalake.operators.raster import null_nodata
    tiles = dem.band(band).tiles.select(null_nodata(F.col("data"), dem.meta).alias("_d"))
    return tiles.agg(F.struct(F.min(F.array_min("_d")).alias("lo"), F.max(F.array_max("_d")).alias("hi")).alias("range"))


def normalize_z(df: DataFrame, dem: Raster, z_exaggeration: float = 1.0, elevation: str = "elevation") -> DataFrame:
    """Append display ``z`` = (elevation - lowest) / range * exaggeration; a flat grid is not scaled.
    The range enters as a scalar subquery, evaluated once and joined to nothing."""
    range_ = elevation_range(dem).scalar()
    lo, hi = range_["lo"], range_["hi"]
    scale = F.when(hi > lo, 1.0 / (hi - lo)).otherwise(1.0)
    return df.withColumn("z", (F.col(elevation) - lo) * scale * F.lit(float(z_exaggeration)))


def terrain_mesh(dem: Raster, z_exaggeration: float = 1.0) -> DataFrame:
    """``r, c, lon, lat, elevation, x, y, z``."""
    return normalize_z(normalize_xy(dem_grid(dem), dem.meta), dem, z_exaggeration)


def texture_uv(df: DataFrame, ortho: RasterMeta, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Append ``u, v``: position within the orthophoto, 0..1 inside, not clamped."""
    left, bottom, right, top = ortho.bounds
    return df.withColumns({"u": (F.col(lon) - F.lit(left)) / F.lit(right - left),
                           "v": (F.col(lat) - F.lit(bottom)) / F.lit(top - bottom)})


def _rgb_tiles(ortho: Raster, ignore_nodata: bool = False) -> DataFrame:
    """``tile_r, tile_c, r0, c0, w, red, green, blue``: 8-bit arrays per tile.

    Bands of one tile are brought together as arrays; pixels are not shuffled.  The scale is joint
    over the three bands, a constant image is left unscaled, fractions are cut off.  NaN is a missing value: no colour.
    """
    used = (1, 2, 3) if ortho.meta.bands >= 3 else (1,)
    present = F.transform("data", lambda v: F.nanvl(v, F.lit(None).cast("double")))
    tiles = ortho.tiles.filter(F.col("band").isin(*used)).withColumn("data", present)
    nodata = ortho.meta.nodata
    valid = F.col("data")
    if ignore_nodata and nodata is not None:
        valid = F.transform("data", lambda v: F.nullif(v, F.lit(float(nodata))))
    range_ = tiles.select(valid.alias("_d")).agg(F.struct(
        F.min(F.array_min("_d")).alias("lo"), F.max(F.array_max("_d")).alias("hi")).alias("range")).scalar()
    tiles = tiles.withColumn("_range", range_)
    lo, hi = F.col("_range.lo"), F.col("_range.hi")
    eight_bit = F.transform("data", lambda v: F.when(hi > lo, (v - lo) / (hi - lo) * 255.0).otherwise(v)
                            .cast("int").cast("smallint"))
    tiles = tiles.select("band", *TILE_KEY, "r0", "c0", "w", eight_bit.alias("data"))
    pick = lambda band: F.any_value(F.when(F.col("band") == band, F.col("data")), True)
    names = ("red", "green", "blue")
    if len(used) == 1:
        return tiles.select(*TILE_KEY, "r0", "c0", "w", *[F.col("data").alias(n) for n in names])
    return tiles.groupBy(*TILE_KEY, "r0", "c0", "w").agg(*[pick(b).alias(n) for b, n in zip(used, names)])


def ortho_rgb(ortho: Raster, ignore_nodata: bool = False) -> DataFrame:
    """``r, c, red, green, blue`` per pixel; an image with fewer than three bands is shown in grey."""
    tiles = _rgb_tiles(ortho, ignore_nodata)
    px = tiles.select("r0", "c0", "w", F.posexplode(F.arrays_zip("red", "green", "blue")).alias("_k", "_p"))
    return px.select((F.col("r0") + F.floor(F.col("_k") / F.col("w"))).alias("r"),
                     (F.col("c0") + F.col("_k") % F.col("w")).alias("c"), "_p.red", "_p.green", "_p.blue")


def textured_terrain(mesh: DataFrame, ortho: Raster) -> DataFrame:
    """The mesh with ``u, v`` and the colour of the photo pixel each vertex falls on; vertices off the
    photo keep NULL colours."""
    m = ortho.meta
    columns = [*mesh.columns, "u", "v"]
    df = texture_uv(mesh, m)
    inside = F.col("u").between(0.0, 1.0) & F.col("v").between(0.0, 1.0)
    pc = F.least(F.floor(F.col("u") * m.width), F.lit(m.width - 1))
    pr = F.least(F.floor((1.0 - F.col("v")) * m.height), F.lit(m.height - 1))
    df = df.withColumns({"_pr": F.when(inside, pr), "_pc": F.when(inside, pc)})
    df = df.withColumns({"tile_r": F.floor(F.col("_pr") / TILE), "tile_c": F.floor(F.col("_pc") / TILE)})
    joined = sized_join(df, _rgb_tiles(ortho), TILE_KEY, m.width * m.height * 6, "left")
    k = ((F.col("_pr") - F.col("r0")) * F.col("w") + F.col("_pc") - F.col("c0")).cast("int")
    return joined.select(*columns, *[F.get(n, k).alias(n) for n in ("red", "green", "blue")])


def drape_vertices(layer: Layer, rings: str = "outer") -> DataFrame:
    """Ordered vertices to drape: ``key.., kind, part, ring, i, lon, lat``.  Of polygons the outer
    rings, or ``rings="all"``.  Vertices of a path stored in several rows are numbered along the whole
    path, and the vertex that two rows share is given once."""
    df = layer.df.filter(G.is_present("geometry")).withColumn("kind", kind_of(F.col("geometry")))
    bases = [c for c in ("seg_base", "part_base") if c in df.columns]
    out = G.explode_vertices(df, [*layer.key, "kind", *bases])
    if "seg_base" in bases:
        base = F.coalesce("seg_base", F.lit(0))
        out = out.filter((base == 0) | (F.col("i") > 0)).withColumn("i", F.col("i") + base)
    if "part_base" in bases:
        out = out.withColumn("part", F.col("part") + F.coalesce("part_base", F.lit(0)))
    out = out.drop(*bases)
    if rings == "outer":
        out = out.filter((F.col("kind") != "polygon") | (F.col("ring") == 0))
    return out.withColumnsRenamed({"x": "lon", "y": "lat"})


def drape(layer: Layer, dem: Raster, z_exaggeration: float = 1.0, anchor: str = "corner",
          rings: str = "outer") -> DataFrame:
    """Features on the terrain: their vertices with elevation and display ``x, y, z``."""
    sampled = sample_bilinear(drape_vertices(layer, rings), "lon", "lat", dem, anchor=anchor)
    return normalize_z(normalize_xy(sampled, dem.meta), dem, z_exaggeration)


def _require_degrees(raster: Raster, what: str) -> None:
    if raster.meta.epsg != 4326:
        raise ValueError(f"{what} '{raster.meta.raster}' is in EPSG:{raster.meta.epsg}, not EPSG:4326; "
                         "run the CRS stage first")


def build_terrain_model(layers: dict[str, Layer], rasters: dict[str, Raster], dem_name: str = "dem",
                        orthophoto_name: str | None = None, z_exaggeration: float = 1.0,
                        anchor: str = "corner") -> dict[str, DataFrame]:
    """``{"terrain": mesh (with colours when an orthophoto is named), "draped": all layers}``."""
    for name in [dem_name] + ([orthophoto_name] if orthophoto_name else []):
        if name not in rasters:
            raise ValueError(f"no raster named '{name}'; available: {list(rasters)}")
    dem = rasters[dem_name]
    _require_degrees(dem, "DEM")
    terrain = terrain_mesh(dem, z_exaggeration)
    if orthophoto_name:
        _require_degrees(rasters[orthophoto_name], "orthophoto")
        terrain = textured_terrain(terrain, rasters[orthophoto_name])
    draped = []
    for name, layer in layers.items():
        rows = drape(layer, dem, z_exaggeration, anchor)
        draped.append(rows.select(F.lit(name).alias("layer"), "fid", "kind", "part", "ring", "i",
                                  "lon", "lat", "elevation", "x", "y", "z"))
    return {"terrain": terrain, "draped": union_all(draped) if draped else None}
