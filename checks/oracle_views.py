"""Input views as SQL text for the oracle side; ``checks/sample_layers.py`` builds the same inputs with
the DataFrame API.  Small pieces of SQL shared by several oracles live here too."""

from __future__ import annotations

import math

VIEWS = {
    "fx_samples": """select event_id as sample_id,
       70e0 + ((event_id * 7919) % 10000) / 1e4 as lon,
       35e0 + ((event_id * 104729) % 10007) / 10007e0 as lat,
       value as assay, event_type as litho from events""",
    "fx_samples_utm": """select c_custkey as sample_id,
       400000e0 + (c_custkey * 7919) % 200000 as easting,
       3870000e0 + (c_custkey * 104729) % 100003 as northing from customer""",
    "fx_dem": """select cast(floor(p_partkey / 20e0) as bigint) as r, cast(p_partkey % 20 as bigint) as c,
       case when p_size < 5 then -9999e0 else p_retailprice end as v from part""",
    "fx_dem_meta": """select 70e0 as x0, 36e0 as y0, 1e0 / 20 as dx, 20e0 / count(*) as dy,
       cast(20 as bigint) as width, cast(floor(count(*) / 20e0) as bigint) as height, -9999e0 as nodata from part""",
    "fx_ortho": """select k.band as band, cast(floor(p_partkey / 20e0) as bigint) as r,
       cast(p_partkey % 20 as bigint) as c,
       cast(case k.band when 1 then p_size * 5 when 2 then p_partkey % 256
            else (p_partkey * 7) % 256 end as double) as v
       from part cross join (values (1), (2), (3)) k(band)""",
    "fx_ring": """select * from (values (0, 70.2e0, 35.2e0), (1, 70.8e0, 35.2e0), (2, 70.8e0, 35.5e0),
       (3, 70.5e0, 35.5e0), (4, 70.5e0, 35.8e0), (5, 70.2e0, 35.8e0), (6, 70.2e0, 35.2e0)) t(i, x, y)""",
    "fx_edge": """select a.x as x1, a.y as y1, b.x as x2, b.y as y2
       from fx_ring a join fx_ring b on b.i = a.i + 1""",
    "fx_line_raw": """select l_orderkey as fid,
       row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_suppkey, l_extendedprice) as k,
       cast((l_partkey * 37) % 1000 as double) as x,
       cast((l_suppkey * 91 + l_partkey * 13) % 1000 as double) as y from lineitem""",
    "fx_line_kept": """select * from (select *, lag(x) over (partition by fid order by k) as px,
       lag(y) over (partition by fid order by k) as py from fx_line_raw) t
       where px is null or px <> x or py <> y""",
    "fx_line": """select fid, cast(row_number() over (partition by fid order by k) - 1 as bigint) as i, x, y
       from fx_line_kept""",
    "fx_line_deg": """select fid, i, 70e0 + x / 1e3 as x, 35e0 + y / 1e3 as y from fx_line""",
    "fx_poly": """select c_custkey as fid, k.i as i,
       70e0 + ((c_custkey * 7919) % 10000) / 1e4
         + case when c_custkey % 10 = 3 then k.bx else k.sx end * 0.01e0 as x,
       35e0 + ((c_custkey * 104729) % 10007) / 10007e0
         + case when c_custkey % 10 = 3 then k.bt else k.sy end * 0.01e0 as y
       from customer cross join (values (0, 0e0, 0e0, 0e0, 0e0), (1, 2e0, 0e0, 2e0, 2e0),
         (2, 2e0, 2e0, 2e0, 0e0), (3, 0e0, 2e0, 0e0, 2e0), (4, 0e0, 0e0, 0e0, 0e0)) k(i, sx, sy, bx, bt)
       where c_custkey % 50 <> 7""",
    "fx_poly_edge": """select p.fid, p.i, p.x as x1, p.y as y1, q.x as x2, q.y as y2
       from fx_poly p join fx_poly q on q.fid = p.fid and q.i = p.i + 1""",
    # Proper crossings of two edges of one ring, with their location.
    "fx_poly_cross": """select fid, x1 + t * (x2 - x1) as px, y1 + t * (y2 - y1) as py, i, j from (
       select a.*, b.i as j,
         ((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1))
         / nullif(((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1))
           - ((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)), 0e0) as t,
         ((a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1))
         * ((a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1)) as s1,
         ((b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1))
         * ((b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1)) as s2
       from fx_poly_edge a join fx_poly_edge b on a.fid = b.fid and b.i > a.i + 1) u where s1 < 0 and s2 < 0""",
    # Valid outlines: squares as they are, the two lobes of each bowtie as triangles.
    "fx_outline": """select p.fid, 0 as part, p.i, p.x, p.y from fx_poly p
         where p.fid not in (select fid from fx_poly_cross)
       union all select c.fid, 0, k.i, case k.i when 1 then p.x when 2 then q.x else c.px end,
         case k.i when 1 then p.y when 2 then q.y else c.py end
         from fx_poly_cross c join fx_poly p on p.fid = c.fid and p.i = 1
         join fx_poly q on q.fid = c.fid and q.i = 2 cross join (values (0), (1), (2), (3)) k(i)
       union all select c.fid, 1, k.i, case k.i when 1 then p.x when 2 then q.x else c.px end,
         case k.i when 1 then p.y when 2 then q.y else c.py end
         from fx_poly_cross c join fx_poly p on p.fid = c.fid and p.i = 3
         join fx_poly q on q.fid = c.fid and q.i = 4 cross join (values (0), (1), (2), (3)) k(i)""",
    "fx_outline_edge": """select p.fid, p.part, p.i, p.x as x1, p.y as y1, q.x as x2, q.y as y2
       from fx_outline p join fx_outline q on q.fid = p.fid and q.part = p.part and q.i = p.i + 1""",
    "fx_messy": """select o_orderkey as feature_no, concat('  ', o_orderstatus, ' ') as Name,
       case when o_orderkey % 17 = 0 then 'N/A' when o_orderkey % 19 = 0 then null
            else cast(o_custkey as varchar(20)) end as POP_2020,
       case when o_orderkey % 23 = 0 then 'unknown'
            else substr(cast(o_orderdate as varchar(40)), 1, 10) end as seen from orders""",
}


def with_views(names: str, body: str, extra: dict[str, str] | None = None) -> str:
    """``with`` clause from view names (in order) and further named queries, then the body."""
    parts = [f"{n} as ({VIEWS[n]})" for n in names.split()]
    parts += [f"{n} as ({q})" for n, q in (extra or {}).items()]
    return "with " + ",\n".join(parts) + "\n" + body if parts else body


def rnd(expr: str, scale: str = "1e6") -> str:
    return f"cast(floor(({expr}) * {scale} + 0.5e0) as bigint)"


def parity(x: str, y: str, e: str = "e") -> str:
    """1 when the ray from (x, y) towards +x meets edge e."""
    return (f"case when ({e}.y1 > {y}) <> ({e}.y2 > {y}) and {x} < ({e}.x2 - {e}.x1) * ({y} - {e}.y1) "
            f"/ ({e}.y2 - {e}.y1) + {e}.x1 then 1 else 0 end")


def on_edge(x: str, y: str, e: str = "e") -> str:
    return (f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1) = 0 "
            f"and {x} between least({e}.x1, {e}.x2) and greatest({e}.x1, {e}.x2) "
            f"and {y} between least({e}.y1, {e}.y2) and greatest({e}.y1, {e}.y2))")


def inside(x: str, y: str, e: str = "e") -> str:
    """Aggregate over mask edges: boundary-inclusive point in polygon."""
    return f"(sum({parity(x, y, e)}) % 2 = 1 or bool_or({on_edge(x, y, e)}))"


def near_edge(x: str, y: str, e: str = "e") -> str:
    cross = f"(({e}.x2 - {e}.x1) * ({y} - {e}.y1) - ({e}.y2 - {e}.y1) * ({x} - {e}.x1))"
    return (f"(abs({cross}) <= 1e-11 * (abs({e}.x2 - {e}.x1) + abs({e}.y2 - {e}.y1)) "
            f"and {x} between least({e}.x1, {e}.x2) - 1e-12 and greatest({e}.x1, {e}.x2) + 1e-12 "
            f"and {y} between least({e}.y1, {e}.y2) - 1e-12 and greatest({e}.y1, {e}.y2) + 1e-12)")


def cut_params(a: str, b: str) -> str:
    """Positions along segment a where it meets segment b, as a list (empty when apart)."""
    def side(p, q):
        return f"(({q}.x2 - {q}.x1) * ({p[1]} - {q}.y1) - ({q}.y2 - {q}.y1) * ({p[0]} - {q}.x1))"
    a1, a2 = side((f"{a}.x1", f"{a}.y1"), b), side((f"{a}.x2", f"{a}.y2"), b)
    b1, b2 = side((f"{b}.x1", f"{b}.y1"), a), side((f"{b}.x2", f"{b}.y2"), a)
    dot = lambda x, y: (f"((({x}) - {a}.x1) * ({a}.x2 - {a}.x1) + (({y}) - {a}.y1) * ({a}.y2 - {a}.y1)) / "  # noqa: E731
                        f"(({a}.x2 - {a}.x1) * ({a}.x2 - {a}.x1) + ({a}.y2 - {a}.y1) * ({a}.y2 - {a}.y1))")
    return (f"case when {a1} = 0 and {a2} = 0 then [{dot(f'{b}.x1', f'{b}.y1')}, {dot(f'{b}.x2', f'{b}.y2')}] "
            f"when sign({a1}) * sign({a2}) <= 0 and sign({b1}) * sign({b2}) <= 0 then [{a1} / ({a1} - {a2})] "
            f"else [] end")


# Transverse Mercator by the Krueger series, written out for the oracle.
_F = 1 / 298.257223563
_N = _F / (2 - _F)
_E = 2 * math.sqrt(_N) / (1 + _N)
_A = 6378137.0 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64) * 0.9996
_AL = [_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180, 13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
       61 * _N**3 / 240 - 103 * _N**4 / 140, 49561 * _N**4 / 161280]
_BE = [_N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360, _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
       17 * _N**3 / 480 - 37 * _N**4 / 840, 4397 * _N**4 / 161280]
_DE = [2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45, 7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
       56 * _N**3 / 15 - 136 * _N**4 / 35, 4279 * _N**4 / 630]


def utm_forward(source: str, lon: str, lat: str, zone: int = 42) -> str:
    """Query over ``source`` adding ``ux, uy`` (northern zone)."""
    s = f"sin(radians({lat}))"
    east = " + ".join(f"{c!r} * cos({2 * j}e0 * xi) * sinh({2 * j}e0 * eta)" for j, c in enumerate(_AL, 1))
    north = " + ".join(f"{c!r} * sin({2 * j}e0 * xi) * cosh({2 * j}e0 * eta)" for j, c in enumerate(_AL, 1))
    return (f"select * exclude (t_, l_, xi, eta), 500000e0 + {_A!r} * (eta + {east}) as ux, {_A!r} * (xi + {north}) as uy "
            f"from (select *, atan2(t_, cos(l_)) as xi, atanh(sin(l_) / sqrt(1 + t_ * t_)) as eta from "
            f"(select *, sinh(atanh({s}) - {_E!r} * atanh({_E!r} * {s})) as t_, radians({lon} - {zone * 6 - 183}) as l_ "
            f"from {source}) p1) p2")


def utm_inverse(source: str, x: str, y: str, zone: int = 42) -> str:
    """Query over ``source`` adding ``lon, lat`` (northern zone)."""
    xi = " - ".join(["xi0"] + [f"{c!r} * sin({2 * j}e0 * xi0) * cosh({2 * j}e0 * eta0)" for j, c in enumerate(_BE, 1)])
    eta = " - ".join(["eta0"] + [f"{c!r} * cos({2 * j}e0 * xi0) * sinh({2 * j}e0 * eta0)" for j, c in enumerate(_BE, 1)])
    lat = " + ".join(["chi"] + [f"{c!r} * sin({2 * j}e0 * chi)" for j, c in enumerate(_DE, 1)])
    return (f"select * exclude (xi0, eta0, xi, eta, chi), {zone * 6 - 183} + degrees(atan2(sinh(eta), cos(xi))) as lon, degrees({lat}) as lat "
            f"from (select *, asin(sin(xi) / cosh(eta)) as chi from (select *, {xi} as xi, {eta} as eta from "
            f"(select *, {y} / {_A!r} as xi0, ({x} - 500000e0) / {_A!r} as eta0 from {source}) i1) i2) i3")


# Bilinear sampling of the elevation grid at ``pts(id.., x, y)``.
def bilinear(points: str, key: str, shift: str = "0e0", x: str = "x", y: str = "y") -> dict[str, str]:
    return {
        "pf": f"""select p.*, m.width, m.height, m.nodata,
          least(greatest(({x} - x0) / dx - {shift}, 0e0), cast(width - 1 as double)) as fc,
          least(greatest((y0 - {y}) / dy - {shift}, 0e0), cast(height - 1 as double)) as fr
          from {points} p cross join fx_dem_meta m""",
        "nb": """select pf.*, cast(least(floor(fc) + o.dc, width - 1) as bigint) as nc,
          cast(least(floor(fr) + o.dr, height - 1) as bigint) as nr,
          (case o.dc when 0 then 1 - (fc - floor(fc)) else fc - floor(fc) end)
          * (case o.dr when 0 then 1 - (fr - floor(fr)) else fr - floor(fr) end) as w
          from pf cross join (values (0, 0), (0, 1), (1, 0), (1, 1)) o(dr, dc)""",
        "zz": f"""select {key}, {x}, {y}, case when count(nullif(d.v, nb.nodata)) = 4 then sum(d.v * nb.w) end as z
          from nb join fx_dem d on d.r = nb.nr and d.c = nb.nc group by {key}, {x}, {y}""",
        "zr": """select min(nullif(v, -9999e0)) as lo, max(nullif(v, -9999e0)) as hi from fx_dem""",
        "sc": """select x0 + 0.5e0 * dx as lon0, y0 - (height - 0.5e0) * dy as lat0,
          greatest((width - 1) * dx, (height - 1) * dy) as span from fx_dem_meta""",
    }
