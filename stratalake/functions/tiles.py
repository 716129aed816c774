"""Numpy kernels on raster tiles: what a task does with the few tiles or mask cells that Spark has brought together.

Values are float64 with NaN for missing ones; tables hold NULL instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from stratalake.functions.projection import project_arrays

TILE = 64
# Of a block of a warped grid, one pixel in so many along an axis is projected to find its source tiles.
SAMPLED = 8
TILES = "band int, tile_r bigint, tile_c bigint, r0 bigint, c0 bigint, h int, w int, data array<double>"
PIECES = "band int, tile_r bigint, tile_c bigint, ord int, dr int, dc int, h int, w int, data array<double>"


def values(column) -> np.ndarray:
    """Elements of an Arrow list of doubles, NULL as NaN."""
    flat = column.values if hasattr(column, "values") else column
    return np.asarray(flat.to_numpy(zero_copy_only=False), float)


def tile_arrays(column) -> list[np.ndarray]:
    """One array for each row of a list column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    data, offsets = values(column), column.offsets.to_numpy()
    return [data[a:b] for a, b in zip(offsets[:-1], offsets[1:])]


def list_column(arrays: list[np.ndarray]) -> pa.ListArray:
    """A list column of arrays, NaN as NULL."""
    ends = np.cumsum([0, *(a.size for a in arrays)]).astype(np.int32)
    flat = np.concatenate([a.ravel() for a in arrays]) if arrays else np.zeros(0)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, mask=np.isnan(flat)))


def _batch(rows: list[tuple], arrays: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    kinds = {"band": pa.int32(), "ord": pa.int32(), "dr": pa.int32(), "dc": pa.int32(), "h": pa.int32(), "w": pa.int32()}
    columns = list(zip(*rows)) or [()] * (len(names) - 1)
    return pa.RecordBatch.from_arrays([*(pa.array(c, kinds.get(n, pa.int64())) for n, c in zip(names, columns)), list_column(arrays)], names=names)


def _sources(start: float, step: float, n: int, origin: float, size: float, first: int, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Cells of a target axis whose centres lie in ``count`` source cells from ``first`` on, and which of those each lies in.

    Axes run from ``start`` (``origin``) with cells of ``step`` (``size``)."""
    low = int(np.floor((origin + first * size - start) / step)) - 1
    high = int(np.ceil((origin + (first + count) * size - start) / step)) + 1
    cells = np.arange(max(low, 0), max(min(high, n), 0))
    at = np.floor((start - origin) / size + (cells + 0.5) * (step / size)).astype(np.int64) - first
    inside = (at >= 0) & (at < count)
    return cells[inside], at[inside]


def to_grid(source, target, nodata: float | None, order: int):
    """``mapInArrow`` function: tiles of one grid to pieces of tiles of another with the same axes, each target pixel with the
    value of the source pixel under its centre."""
    names = ["band", "tile_r", "tile_c", "ord", "dr", "dc", "h", "w", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            places = zip(*(batch.column(c).to_pylist() for c in ("band", "r0", "c0", "h", "w")))
            for (band, r0, c0, h, w), data in zip(places, tile_arrays(batch.column("data"))):
                data = data.reshape(h, w)
                if nodata is not None:
                    data = np.where(data == nodata, np.nan, data)
                # Rows run down, so both axes are measured from the upper left corner.
                r, sr = _sources(-target.y0, target.dy, target.height, -source.y0, source.dy, r0, h)
                c, sc = _sources(target.x0, target.dx, target.width, source.x0, source.dx, c0, w)
                for tr in np.unique(r // TILE).tolist():
                    rr = r // TILE == tr
                    for tc in np.unique(c // TILE).tolist():
                        cc = c // TILE == tc
                        part = data[np.ix_(sr[rr], sc[cc])]
                        rows.append((band, tr, tc, order, int(r[rr][0]) - tr * TILE, int(c[cc][0]) - tc * TILE, *part.shape))
                        out.append(part)
            yield _batch(rows, out, names)
    return run


def assemble(width: int, height: int, nodata: float | None):
    """``mapInArrow`` function: ``band, tile_r, tile_c, pieces`` to tiles; of pieces that overlap the first in order with a value wins."""
    names = ["band", "tile_r", "tile_c", "r0", "c0", "h", "w", "data"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, out = [], []
            column = batch.column("pieces")
            for k, (band, tr, tc) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("band", "tile_r", "tile_c")))):
                h, w = min(TILE, height - tr * TILE), min(TILE, width - tc * TILE)
                tile = np.full((h, w), np.nan)
                pieces = column[k].values
                if pieces is not None and len(pieces):
                    fields = {n: pieces.field(n).to_pylist() for n in ("ord", "dr", "dc", "h", "w")}
                    data = tile_arrays(pieces.field("data"))
                    for i in sorted(range(len(data)), key=lambda i: fields["ord"][i]):
                        dr, dc, ph, pw = (fields[n][i] for n in ("dr", "dc", "h", "w"))
                        part = tile[dr:dr + ph, dc:dc + pw]
                        part[...] = np.where(np.isnan(part), data[i].reshape(ph, pw), part)
                if nodata is not None:
                    tile[np.isnan(tile)] = nodata
                rows.append((band, tr, tc, tr * TILE, tc * TILE, h, w))
                out.append(tile)
            yield _batch(rows, out, names)
    return run


def _orient(e, x, y):
    return (e[2] - e[0]) * (y - e[1]) - (e[3] - e[1]) * (x - e[0])


def _inside_leaf(groups, x, y, x0, y0) -> np.ndarray:
    """Whether the locations (arrays of a row and a column) of one leaf lie inside a feature or on its outline."""
    found = np.zeros(np.broadcast(x, y).shape, bool)
    for group in groups:
        odd = np.full(found.shape, group["odd"])
        on = np.zeros(found.shape, bool)
        for edge in group["edges"]:
            e = edge["x1"], edge["y1"], edge["x2"], edge["y2"]
            here, turn = _orient(e, x, y), _orient(e, x0, y) > 0
            along = ((e[1] > y) != (e[3] > y)) & ((here > 0) != turn)
            down = ((e[0] > x0) != (e[2] > x0)) & (turn != (_orient(e, x0, y0) > 0))
            odd ^= along ^ down
            on |= (here == 0) & (x >= min(e[0], e[2])) & (x <= max(e[0], e[2])) & (y >= min(e[1], e[3])) & (y <= max(e[1], e[3]))
        found |= odd | on
    return found


def inside_tiles(meta, origin, size):
    """``mapInArrow`` function: ``tile_r, tile_c, position, cells`` to the same with ``inside``, a flag for each pixel centre of a tile,
    by row.  ``cells`` are the FULL cells and the leaves that the tile meets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flags = []
            for tr, tc, cells in zip(*(batch.column(c).to_pylist() for c in ("tile_r", "tile_c", "cells"))):
                h, w = min(TILE, meta.height - tr * TILE), min(TILE, meta.width - tc * TILE)
                x = meta.x0 + (tc * TILE + np.arange(w) + 0.5) * meta.dx
                y = meta.y0 - (tr * TILE + np.arange(h) + 0.5) * meta.dy
                u, v = (x - origin[0]) / size[0], (y - origin[1]) / size[1]
                inside = np.zeros((h, w), bool)
                for cell in cells or ():
                    scale = 2.0 ** cell["level"]
                    cols, rows = np.flatnonzero(np.floor(u * scale) == cell["cx"]), np.flatnonzero(np.floor(v * scale) == cell["cy"])
                    if len(cols) and len(rows):
                        inside[np.ix_(rows, cols)] = True if cell["full"] else _inside_leaf(
                            cell["groups"], x[cols][None, :], y[rows][:, None], cell["x0"], cell["y0"])
                flags.append(inside.ravel())
            ends = np.cumsum([0, *(f.size for f in flags)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("tile_r"), batch.column("tile_c"), batch.column("position"),
                 pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(flags) if flags else np.zeros(0, bool)))],
                names=["tile_r", "tile_c", "position", "inside"])
    return run


class WarpBlocks:
    """Square blocks of a warped grid, and where their pixels come from."""

    def __init__(self, source, target, edge: int):
        self.source, self.target, self.edge = source, target, edge
        self.across = -(-target.width // edge)
        self.count = self.across * -(-target.height // edge)

    def place(self, block: int) -> tuple[int, int, int, int]:
        """First row and column, height and width."""
        r0, c0 = block // self.across * self.edge, block % self.across * self.edge
        return r0, c0, min(self.edge, self.target.height - r0), min(self.edge, self.target.width - c0)

    def back(self, block: int, rows: np.ndarray | None = None, cols: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row and column of each pixel's centre on the source grid, between pixel centres, and whether the source covers it; of some rows and
        columns of the block, or of all."""
        t, s = self.target, self.source
        r0, c0, h, w = self.place(block)
        rows, cols = np.arange(h) if rows is None else rows, np.arange(w) if cols is None else cols
        # One row of x and one column of y: what a projection makes of one of them alone is worked out once.
        x, y = project_arrays((t.x0 + (c0 + cols + 0.5) * t.dx)[None, :], (t.y0 - (r0 + rows + 0.5) * t.dy)[:, None], t.epsg, s.epsg)
        fr, fc = np.broadcast_arrays((s.y0 - y) / s.dy - 0.5, (x - s.x0) / s.dx - 0.5)
        return fr, fc, (fc >= -0.5) & (fc <= s.width - 0.5) & (fr >= -0.5) & (fr <= s.height - 0.5)

    def _span(self, at: np.ndarray, size: int) -> tuple[int, int] | None:
        """First and last tile along an axis for places around samples ``at``; None if all lie off the source."""
        step = max((np.abs(np.diff(at, axis=k)).max() for k in (0, 1) if at.shape[k] > 1), default=0.0)
        low, high = at.min() - step, at.max() + step
        if high < -0.5 or low > size - 0.5:
            return None
        low, high = (int(np.clip(np.floor(v), -1, size)) for v in (low, high))
        return max(low, 0) // TILE, min(high + 1, size - 1) // TILE

    def spans(self, block: int) -> list[tuple[int, int]] | None:
        """First and last row and column of the source tiles that hold the neighbours of a block's pixels; None for no tile.

        Every ``SAMPLED``-th pixel is projected, and the last; the others lie within a step between samples of them.  Where the
        projection has no value, all pixels are."""
        s = self.source
        fr, fc, _ = self.back(block, *(np.unique(np.append(np.arange(0, n, SAMPLED), n - 1)) for n in self.place(block)[2:]))
        if np.isfinite(fr).all() and np.isfinite(fc).all():
            found = [self._span(fr, s.height), self._span(fc, s.width)]
            return None if None in found else found
        fr, fc, covered = self.back(block)
        if not covered.any():
            return None
        ends = ((np.floor(at[covered].min()), np.floor(at[covered].max()) + 1, n) for at, n in ((fr, s.height), (fc, s.width)))
        return [tuple(int(np.clip(v, 0, n - 1)) // TILE for v in (low, high)) for low, high, n in ends]

    def needs(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``id`` of blocks to ``block, tile_r, tile_c``: the source tiles that hold their pixels' neighbours; NULL for none."""
        for batch in batches:
            rows = []
            for block in batch.column("id").to_pylist():
                spans = self.spans(block)
                if spans is None:
                    rows.append((block, None, None))
                    continue
                (r, last_r), (c, last_c) = spans
                rows += [(block, i, j) for i in range(r, last_r + 1) for j in range(c, last_c + 1)]
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3,
                                             names=["block", "tile_r", "tile_c"])

    def warp(self, key, table: pa.Table) -> pa.Table:
        """Tiles of one block from the source tiles brought to it: of each pixel's neighbours the weighted mean of those that have a value."""
        block = key[0].as_py()
        r0, c0, h, w = self.place(block)
        lists = {n: table.column(n).to_pylist() for n in ("band", "r0", "c0", "h", "w")}
        known = [k for k, b in enumerate(lists["band"]) if b is not None]
        windows = {}
        if known:
            first_r, first_c = (min(lists[n][k] for k in known) for n in ("r0", "c0"))
            # A border of missing values stands for neighbours beyond the source and absent tiles.
            high = max(lists["r0"][k] + lists["h"][k] for k in known) - first_r + 2
            wide = max(lists["c0"][k] + lists["w"][k] for k in known) - first_c + 2
            data = tile_arrays(table.column("data"))
            for band in range(1, self.target.bands + 1):
                window = np.full((high, wide), np.nan)
                for k in known:
                    if lists["band"][k] == band:
                        a, b = lists["r0"][k] - first_r + 1, lists["c0"][k] - first_c + 1
                        window[a:a + lists["h"][k], b:b + lists["w"][k]] = data[k].reshape(lists["h"][k], lists["w"][k])
                there = ~np.isnan(window)
                windows[band] = np.where(there, window, 0.0).ravel(), there.astype(float).ravel()
        rows, arrays = [], []
        for a in range(0, h, TILE):  # a row of tiles at a time, whose arrays stay in the processor's cache
            n = min(TILE, h - a)
            out = {band: np.full((n, w), np.nan) for band in range(1, self.target.bands + 1)}
            if known:
                fr, fc, covered = self.back(block, np.arange(a, a + n))
                if covered.any():
                    row, col = np.floor(fr), np.floor(fc)
                    wr, wc = fr - row, fc - col
                    row = np.clip(np.where(covered, row, 0) - first_r + 1, 0, high - 2).astype(np.int64)
                    col = np.clip(np.where(covered, col, 0) - first_c + 1, 0, wide - 2).astype(np.int64)
                    at = row * wide + col
                    parts = [(at + shift, part) for shift, part in ((0, (1 - wr) * (1 - wc)), (1, (1 - wr) * wc), (wide, wr * (1 - wc)), (wide + 1, wr * wc))]
                    for band, (window, there) in windows.items():
                        total, weight = np.zeros((n, w)), np.zeros((n, w))
                        for near, part in parts:
                            total += window.take(near) * part
                            weight += there.take(near) * part
                        np.divide(total, weight, out=out[band], where=covered & (weight > 0))
            for band, values_ in out.items():
                for b in range(0, w, TILE):
                    part = values_[:, b:b + TILE]
                    rows.append((band, (r0 + a) // TILE, (c0 + b) // TILE, r0 + a, c0 + b, *part.shape))
                    arrays.append(part)
        return pa.Table.from_batches([_batch(rows, arrays, ["band", "tile_r", "tile_c", "r0", "c0", "h", "w", "data"])])
