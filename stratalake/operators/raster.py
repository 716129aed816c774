"""Tiled rasters: tiles <-> pixels, mosaic, study-area mask and crop, bilinear sampling.

A raster is a table of square tiles ``band, tile_r, tile_c, r0, c0, h, w, data`` (row-major values)
with its affine in a ``RasterMeta``.  Work that needs neighbours runs on tiles with a one-pixel halo
to the right and below, so every 2x2 block lies within one row and a lookup is one equi-join on the
tile key, by broadcast while the raster is small, by shuffle with hot tiles spread otherwise.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions import tiles as K
from stratalake.operators.joins import sized_join
from stratalake.operators.layers import union_all
from stratalake.operators.mask import EMPTY, FULL, Mask

TILE = K.TILE
TILE_KEY = ["tile_r", "tile_c"]


@dataclass(frozen=True)
class RasterMeta:
    """North-up affine: pixel (r, c) spans x0 + c*dx .. x0 + (c+1)*dx and y0 - r*dy .. y0 - (r+1)*dy."""

    raster: str
    epsg: int | None
    x0: float
    y0: float
    dx: float
    dy: float
    width: int
    height: int
    bands: int = 1
    nodata: float | None = None
    dtype: str = "float64"

    @property
    def bytes(self) -> int:
        return self.width * self.height * self.bands * 8

    @property
    def bounds(self) -> tuple[float, float, float, float]:
        return (self.x0, self.y0 - self.height * self.dy, self.x0 + self.width * self.dx, self.y0)

    def centre_x(self, c: Column) -> Column:
        return F.lit(self.x0) + (c + F.lit(0.5)) * F.lit(self.dx)

    def centre_y(self, r: Column) -> Column:
        return F.lit(self.y0) - (r + F.lit(0.5)) * F.lit(self.dy)

    def as_dict(self) -> dict:
        return asdict(self)


@dataclass(frozen=True)
class Raster:
    meta: RasterMeta
    tiles: DataFrame

    def band(self, band: int) -> Raster:
        """One band on its own, numbered 1."""
        chosen = self.tiles.filter(F.col("band") == band).withColumn("band", F.lit(1))
        return Raster(replace(self.meta, bands=1), chosen)


def from_pixels(pixels: DataFrame, meta: RasterMeta) -> Raster:
    """Tiles from ``band, r, c, v``; pixels that are absent become NULL.  Groups are one tile each."""
    w = F.least(F.lit(TILE), F.lit(meta.width) - F.col("tile_c") * TILE).cast("int")
    h = F.least(F.lit(TILE), F.lit(meta.height) - F.col("tile_r") * TILE).cast("int")
    keyed = pixels.select(
        F.col("band").cast("int").alias("band"), F.floor(F.col("r") / TILE).alias("tile_r"),
        F.floor(F.col("c") / TILE).alias("tile_c"), "r", "c", F.col("v").cast("double").alias("v"))
    place = (F.col("r") - F.col("tile_r") * TILE) * w + F.col("c") - F.col("tile_c") * TILE
    tiles = (keyed.select("band", *TILE_KEY, F.struct(place.cast("int").alias("k"), "v").alias("_p"))
             .groupBy("band", *TILE_KEY).agg(F.collect_list("_p").alias("_p"))
             .select("band", *TILE_KEY, (F.col("tile_r") * TILE).alias("r0"),
                     (F.col("tile_c") * TILE).alias("c0"), h.alias("h"), w.alias("w"), "_p"))
    absent = F.array_except(F.sequence(F.lit(0), F.col("h") * F.col("w") - 1), F.col("_p").getField("k"))
    blank = F.transform(absent, lambda k: F.named_struct(F.lit("k"), k, F.lit("v"), F.lit(None).cast("double")))
    full = F.when(F.size("_p") < F.col("h") * F.col("w"), F.concat("_p", blank)).otherwise(F.col("_p"))
    return Raster(meta, tiles.withColumn("data", F.array_sort(full).getField("v")).drop("_p"))


def pixels(raster: Raster, null_nodata: bool = False) -> DataFrame:
    """Pixel view ``band, r, c, v``, one narrow explode of the tiles."""
    out = raster.tiles.select("band", "r0", "c0", "w", F.posexplode("data").alias("_k", "v"))
    v = F.nanvl(F.col("v"), F.lit(None).cast("double"))
    if null_nodata and raster.meta.nodata is not None:
        v = F.nullif(v, F.lit(float(raster.meta.nodata)))
    return out.select("band", (F.col("r0") + F.floor(F.col("_k") / F.col("w"))).alias("r"),
                      (F.col("c0") + F.col("_k") % F.col("w")).alias("c"), v.alias("v"))


def null_nodata(data: Column, meta: RasterMeta) -> Column:
    """Values of a tile; nodata and NaN are NULL."""
    nothing = F.lit(None).cast("double")
    if meta.nodata is None:
        return F.transform(data, lambda v: F.nanvl(v, nothing))
    return F.transform(data, lambda v: F.nullif(F.nanvl(v, nothing), F.lit(float(meta.nodata))))


def raster_profile(raster: Raster) -> DataFrame:
    """Width, height and bands measured on the tiles, next to the declared CRS and nodata."""
    m = raster.meta
    return raster.tiles.agg(
        F.max(F.col("c0") + F.col("w")).cast("long").alias("width"),
        F.max(F.col("r0") + F.col("h")).cast("long").alias("height"),
        F.countDistinct("band").alias("bands")).select(
        F.lit(m.raster).alias("raster"), "width", "height", "bands",
        F.lit(m.epsg).cast("int").alias("epsg"), F.lit(m.nodata).cast("double").alias("nodata"))


def mosaic(rasters: list[Raster], name: str | None = None) -> Raster:
    """One seamless raster from several on the first one's grid; rasters of other pixel sizes give each pixel the value under
    its centre.  Where they overlap the first raster of the list with a value other than nodata wins; gaps between them
    are nodata.  Tiles are cut, moved and merged whole."""
    first = rasters[0].meta
    for other in rasters[1:]:
        if other.meta.epsg != first.epsg:
            raise ValueError(f"raster '{other.meta.raster}' differs from '{first.raster}' in CRS")
    x0, y0 = min(r.meta.x0 for r in rasters), max(r.meta.y0 for r in rasters)
    # Whole pixels to the left and above, so that the first raster's own pixels stay as they are.
    x0 = first.x0 - math.ceil((first.x0 - x0) / first.dx - 1e-6) * first.dx
    y0 = first.y0 + math.ceil((y0 - first.y0) / first.dy - 1e-6) * first.dy
    x1, y1 = max(r.meta.bounds[2] for r in rasters), min(r.meta.bounds[1] for r in rasters)
    meta = replace(first, raster=name or first.raster, x0=x0, y0=y0, bands=max(r.meta.bands for r in rasters),
                   width=math.ceil((x1 - x0) / first.dx - 1e-6), height=math.ceil((y0 - y1) / first.dy - 1e-6))
    pieces = union_all([_to_grid(raster, meta, order, raster.meta.nodata) for order, raster in enumerate(rasters)])
    return _assembled(pieces, meta, whole=True)


def _to_grid(raster: Raster, meta: RasterMeta, order: int = 0, nodata: float | None = None) -> DataFrame:
    """Pieces of tiles of another grid, one narrow pass over the tiles."""
    return raster.tiles.select("band", "r0", "c0", "h", "w", "data").mapInArrow(K.to_grid(raster.meta, meta, nodata, order), K.PIECES)


def _assembled(pieces: DataFrame, meta: RasterMeta, whole: bool = False) -> Raster:
    """Tiles from pieces: what is shuffled are parts of tiles as arrays, never pixels.  ``whole``: every tile of the grid, those without
    any piece too, and missing values as nodata."""
    grouped = pieces.groupBy("band", *TILE_KEY).agg(F.collect_list(F.struct("ord", "dr", "dc", "h", "w", "data")).alias("pieces"))
    if whole:
        spark = pieces.sparkSession
        across = -(-meta.width // TILE)
        n_tiles = across * -(-meta.height // TILE)
        grid = spark.range(n_tiles * meta.bands).select(
            (F.floor(F.col("id") / n_tiles) + 1).cast("int").alias("band"), F.floor(F.col("id") % n_tiles / across).alias("tile_r"),
            (F.col("id") % n_tiles % across).alias("tile_c"))
        grouped = grid.join(grouped, ["band", *TILE_KEY], "left")
    return Raster(meta, grouped.mapInArrow(K.assemble(meta.width, meta.height, meta.nodata if whole else None), K.TILES))


def crop_window(meta: RasterMeta, bounds: tuple[float, float, float, float]) -> tuple[int, int, int, int]:
    """Rows and columns (first, past-the-end) of the smallest pixel window around the bounds."""
    xmin, ymin, xmax, ymax = bounds
    c_lo = max(0, math.floor((xmin - meta.x0) / meta.dx + 1e-9))
    c_hi = min(meta.width, math.ceil((xmax - meta.x0) / meta.dx - 1e-9))
    r_lo = max(0, math.floor((meta.y0 - ymax) / meta.dy + 1e-9))
    r_hi = min(meta.height, math.ceil((meta.y0 - ymin) / meta.dy - 1e-9))
    return r_lo, r_hi, c_lo, c_hi


def _window_tiles(raster: Raster, window: tuple[int, int, int, int]) -> DataFrame:
    r_lo, r_hi, c_lo, c_hi = window
    return raster.tiles.filter(
        F.col("tile_r").between(r_lo // TILE, max(r_hi - 1, 0) // TILE)
        & F.col("tile_c").between(c_lo // TILE, max(c_hi - 1, 0) // TILE))


def crop(raster: Raster, bounds: tuple[float, float, float, float]) -> Raster:
    """Pixels of the window around the bounds, with rows, columns and origin re-based."""
    return _windowed(raster, crop_window(raster.meta, bounds))


def _windowed(raster: Raster, window: tuple[int, int, int, int]) -> Raster:
    """Tiles of the window.  One that starts at a tile's corner only needs its last tiles cut; else parts of up to four tiles
    make a new one."""
    meta = _cropped_meta(raster.meta, window)
    tiles = Raster(raster.meta, _window_tiles(raster, window))
    if window == (0, raster.meta.height, 0, raster.meta.width):
        return Raster(meta, raster.tiles)
    return _assembled(_to_grid(tiles, meta), meta)


def _cropped_meta(meta: RasterMeta, window: tuple[int, int, int, int]) -> RasterMeta:
    r_lo, r_hi, c_lo, c_hi = window
    if r_hi <= r_lo or c_hi <= c_lo:
        raise ValueError(f"raster '{meta.raster}' does not overlap the study area")
    return replace(meta, x0=meta.x0 + c_lo * meta.dx, y0=meta.y0 - r_lo * meta.dy,
                   width=c_hi - c_lo, height=r_hi - r_lo)


def masked_tiles(raster: Raster, mask: Mask, fill: float | None = None) -> DataFrame:
    """Tiles of the window around the mask; pixels whose centre lies outside get ``fill`` (default: the raster's nodata, NULL when it has none).

    The cells under a tile tell most tiles inside, which stay as they are, or outside, which are filled.  For the rest the
    leaves they meet are brought to the tile's number, not to its values: the flags of its pixels are worked out once for all
    bands and join the tiles as one array.
    """
    meta = raster.meta
    window = crop_window(meta, mask.bounds) if mask.bounds else (0, 0, 0, 0)
    _cropped_meta(meta, window)
    fill = F.lit(meta.nodata if fill is None else fill).cast("double")
    r_lo, r_hi, c_lo, c_hi = window
    first_r, first_c = r_lo // TILE, c_lo // TILE
    across = (c_hi - 1) // TILE - first_c + 1
    n_tiles = across * ((r_hi - 1) // TILE - first_r + 1)
    judged = _inside(raster.tiles.sparkSession.range(n_tiles).select(
        (F.floor(F.col("id") / across) + first_r).alias("tile_r"), (F.col("id") % across + first_c).alias("tile_c")), meta, mask)
    joined = sized_join(_window_tiles(raster, window), judged, TILE_KEY, n_tiles * TILE * TILE)
    masked = F.zip_with("data", "inside", lambda v, inside: F.when(inside, v).otherwise(fill))
    data = (F.when(F.col("position") == "INSIDE", F.col("data")).when(F.col("position") == "OUTSIDE", F.transform("data", lambda v: fill))
            .otherwise(masked))
    return joined.withColumn("data", data).select(*raster.tiles.columns)


def _inside(tiles: DataFrame, meta: RasterMeta, mask: Mask) -> DataFrame:
    """``tile_r, tile_c, position, inside`` of numbered tiles; flags only for those at the mask's boundary."""
    c = F.col
    last = lambda n, size: F.least((c(n) + 1) * TILE, F.lit(size)) - 1
    x0, x1 = meta.centre_x(c("tile_c") * TILE), meta.centre_x(last("tile_c", meta.width))
    y0, y1 = meta.centre_y(last("tile_r", meta.height)), meta.centre_y(c("tile_r") * TILE)
    placed = tiles.withColumn("position", mask.box_position(x0, y0, x1, y1))
    flags = F.lit(None).cast("array<boolean>").alias("inside")
    whole = lambda x: F.least(F.greatest(F.floor(x), F.lit(0)), F.lit(mask.base - 1)).cast("int")
    cells = (placed.filter("position = 'BOUNDARY'")
             .withColumn("bx", F.explode(F.sequence(whole(mask.u(x0)), whole(mask.u(x1)))))
             .withColumn("by", F.explode(F.sequence(whole(mask.v(y0)), whole(mask.v(y1)))))
             .withColumn("state", mask.state(c("bx") + 0.5, c("by") + 0.5)))
    scale = F.pow(F.lit(2.0), c("_level"))
    leaves = mask.cells.select(F.floor(c("_cx") / scale).cast("int").alias("bx"), F.floor(c("_cy") / scale).cast("int").alias("by"), F.struct(
        c("_full").alias("full"), c("_level").alias("level"), c("_cx").alias("cx"), c("_cy").alias("cy"), c("_x0").alias("x0"),
        c("_y0").alias("y0"), c("_groups").alias("groups")).alias("leaf"))
    nothing = F.lit(None)
    full = F.struct(F.lit(True).alias("full"), F.lit(0).alias("level"), c("bx").alias("cx"), c("by").alias("cy"), nothing.cast("double").alias("x0"),
                    nothing.cast("double").alias("y0"), nothing.cast(mask.cells.schema["_groups"].dataType).alias("groups"))
    met = sized_join(cells, leaves, ["bx", "by"], mask.cell_bytes, "left")
    cell = F.when(c("state") == FULL, full).otherwise(c("leaf"))
    edge = (met.groupBy(*TILE_KEY, "position").agg(F.collect_list(F.when(c("state") != EMPTY, cell)).alias("cells"))
            .mapInArrow(K.inside_tiles(meta, mask.origin, mask.size), "tile_r bigint, tile_c bigint, position string, inside array<boolean>"))
    return placed.filter("position <> 'BOUNDARY'").select(*TILE_KEY, "position", flags).unionByName(edge)


def mask_pixels(raster: Raster, mask: Mask, fill: float | None = None) -> DataFrame:
    """``band, r, c, v`` of the window around the mask, see ``masked_tiles``."""
    window = crop_window(raster.meta, mask.bounds) if mask.bounds else (0, 0, 0, 0)
    r_lo, r_hi, c_lo, c_hi = window
    masked = pixels(Raster(raster.meta, masked_tiles(raster, mask, fill)))
    return masked.filter(F.col("r").between(r_lo, r_hi - 1) & F.col("c").between(c_lo, c_hi - 1))


def clip_raster(raster: Raster, mask: Mask, fill: float | None = None) -> Raster:
    """Mask and crop to the study area."""
    window = crop_window(raster.meta, mask.bounds) if mask.bounds else (0, 0, 0, 0)
    return _windowed(Raster(raster.meta, masked_tiles(raster, mask, fill)), window)


def halo_tiles(raster: Raster) -> DataFrame:
    """Tiles (nodata as NULL) widened by the first column of the right neighbour and the first row
    of the lower one: ``band, tile_r, tile_c, r0, c0, hw, data``.  Only tiles and their border strips
    are shuffled; a raster of one tile needs no shuffle."""
    base = raster.tiles.withColumn("data", null_nodata(F.col("data"), raster.meta))
    if raster.meta.width <= TILE and raster.meta.height <= TILE:
        return base.select("band", *TILE_KEY, "r0", "c0", F.col("w").alias("hw"), "data")
    w, h = F.col("w"), F.col("h")
    column = F.transform(F.sequence(F.lit(0), h - 1), lambda k: F.element_at("data", (k * w + 1).cast("int")))
    row = F.slice("data", F.lit(1), w)
    none = F.lit(None).cast("array<double>")

    def piece(role, dr, dc, data, first):
        tile = F.when(F.lit(first), F.struct("r0", "c0", "h", "w"))
        return F.struct(F.lit(role).alias("role"), (F.col("tile_r") - dr).alias("tile_r"),
                        (F.col("tile_c") - dc).alias("tile_c"), tile.alias("tile"), data.alias("strip"))
    pieces = F.array(piece("own", 0, 0, F.col("data"), True), piece("right", 0, 1, column, False),
                     piece("below", 1, 0, row, False),
                     piece("corner", 1, 1, F.slice("data", F.lit(1), F.lit(1)), False))
    sent = base.select("band", F.inline(pieces)).filter((F.col("tile_r") >= 0) & (F.col("tile_c") >= 0))
    pick = lambda role: F.any_value(F.when(F.col("role") == role, F.col("strip")), True)
    got = sent.groupBy("band", *TILE_KEY).agg(
        F.any_value("tile", True).alias("tile"), pick("own").alias("own"), pick("right").alias("right"),
        pick("below").alias("below"), pick("corner").alias("corner"))
    got = got.filter(F.col("own").isNotNull()).select("band", *TILE_KEY, "tile.*", "own", "right", "below", "corner")
    rows = F.transform(F.sequence(F.lit(0), h - 1), lambda k: F.concat(
        F.slice("own", (k * w + 1).cast("int"), w),
        F.when(F.col("right").isNotNull(), F.array(F.get("right", k))).otherwise(F.array().cast("array<double>"))))
    last = F.concat(F.coalesce("below", F.array().cast("array<double>")),
                    F.when(F.col("right").isNotNull(), F.coalesce("corner", F.array(F.lit(None).cast("double"))))
                    .otherwise(F.array().cast("array<double>")))
    data = F.when(F.col("below").isNotNull(), F.concat(F.flatten(rows), last)).otherwise(F.flatten(rows))
    return got.select("band", *TILE_KEY, "r0", "c0",
                      F.when(F.col("right").isNotNull(), w + 1).otherwise(w).alias("hw"), data.alias("data"))


def halo_value(r: Column, c: Column) -> Column:
    """Value at global (r, c) of the joined halo tile."""
    k = (r - F.col("r0")) * F.col("hw") + c - F.col("c0")
    return F.get("data", k.cast("int"))


def sample_bilinear(df: DataFrame, x: str, y: str, raster: Raster, out: str = "elevation",
                    anchor: str = "corner", band: int = 1) -> DataFrame:
    """Append the bilinearly interpolated raster value at each location.

    Locations beyond the edge take the edge value; a missing neighbour makes the result NULL.
    ``anchor="corner"`` reads the pixel index straight from the inverse affine, ``"center"``
    interpolates between pixel centres.
    """
    m = raster.meta
    shift = {"corner": 0.0, "center": 0.5}[anchor]
    columns = df.columns
    fc = F.least(F.greatest((F.col(x) - m.x0) / m.dx - shift, F.lit(0.0)), F.lit(float(m.width - 1)))
    fr = F.least(F.greatest((m.y0 - F.col(y)) / m.dy - shift, F.lit(0.0)), F.lit(float(m.height - 1)))
    missing = F.col(x).isNull() | F.col(y).isNull()
    placed = df.withColumns({"_fc": F.when(~missing, fc), "_fr": F.when(~missing, fr)})
    placed = placed.withColumns({"_c": F.floor("_fc"), "_r": F.floor("_fr")})
    placed = placed.withColumns({"tile_r": F.floor(F.col("_r") / TILE), "tile_c": F.floor(F.col("_c") / TILE)})
    tiles = halo_tiles(raster.band(band)).drop("band")
    joined = sized_join(placed, tiles, TILE_KEY, raster.meta.width * raster.meta.height * 8, "left")
    r1 = F.least(F.col("_r") + 1, F.lit(m.height - 1))
    c1 = F.least(F.col("_c") + 1, F.lit(m.width - 1))
    wr, wc = F.col("_fr") - F.col("_r"), F.col("_fc") - F.col("_c")
    value = (halo_value(F.col("_r"), F.col("_c")) * (1 - wr) * (1 - wc)
             + halo_value(F.col("_r"), c1) * (1 - wr) * wc
             + halo_value(r1, F.col("_c")) * wr * (1 - wc)
             + halo_value(r1, c1) * wr * wc)
    return joined.select(*columns, value.alias(out))
