"""The expected result of each query as plain SQL on the driver tables."""

from __future__ import annotations

from checks.oracle_views import (
    bilinear, cut_params, inside, near_edge, on_edge, parity, rnd, utm_forward, utm_inverse, with_views,
)

ORACLES: dict[str, str] = {}


def oracle(name: str, views: str, body: str, extra: dict[str, str] | None = None) -> None:
    ORACLES[name] = with_views(views, body, extra)


# ---- sources -------------------------------------------------------------------------------------

oracle("q_points_from_table", "fx_samples", f"""select sample_id, sample_id % 97 <> 0 as has_point,
  case when sample_id % 97 <> 0 then {rnd('lon')} end as x6, case when sample_id % 97 <> 0 then {rnd('lat')} end as y6
  from fx_samples""")
SHEET2 = {"sheet2": """select c_custkey as sample_id, 70e0 + ((c_custkey * 7919) % 10000) / 1e4 as lon,
  35e0 + ((c_custkey * 104729) % 10007) / 10007e0 as lat from customer"""}
oracle("q_multi_samples", "fx_samples", f"""select 'samples_0' as layer, count(*) as n, count(assay) as n_assay,
  cast(sum({rnd('lon')}) as bigint) as lon6 from fx_samples union all
  select 'samples_1', count(*), cast(0 as bigint), cast(sum({rnd('lon')}) as bigint) from sheet2""", SHEET2)
oracle("q_geojson_read", "fx_samples", f"""select sample_id as fid, litho, {rnd('lon')} as x6,
  {rnd('lat')} as y6 from fx_samples""")
oracle("q_kml_read", "fx_poly", f"""select fid, count(*) as n, cast(sum({rnd('x')}) as bigint) as x6,
  cast(sum({rnd('y')}) as bigint) as y6 from fx_poly group by fid""")
oracle("q_layer_select", "", f"select sample_id, {rnd('lat')} as lat6 from sheet2", SHEET2)
oracle("q_attribute_filter", "fx_samples", """select sample_id, litho from fx_samples
  where assay > 50 and litho in ('click', 'purchase') and sample_id is distinct from 10""")
oracle("q_raster_pixels", "fx_dem", f"select r, c, {rnd('nullif(v, -9999e0)', '1e4')} as v4 from fx_dem")
oracle("q_raster_mosaic", "fx_dem fx_dem_meta", f"""select r, c, {rnd('''case when v = -9999e0 then v
  when r < cast(floor(height * 6 / 10) as bigint) then v else v + 1 end''', '1e4')} as v4 from fx_dem cross join fx_dem_meta""")
oracle("q_layer_inventory", "", """select 'polygons' as layer, count(*) as n_rows from customer
  union all select 'samples', count(*) from events""")

# ---- audit ---------------------------------------------------------------------------------------

oracle("q_source_audit", "", """select * from (values ('outlines', 'vector', 'ok'), ('tracks', 'vector', 'skipped'),
  ('faults', 'vector', 'error'), ('samples', 'tabular', 'ok'), ('assays', 'tabular', 'error'),
  ('sheet', 'tabular', 'error'), ('study_area', 'vector', 'ok'), ('dem', 'raster', 'warning')) t(source, kind, status)""")
oracle("q_vector_profile", "", """select 'polygons' as layer, count(*) as features, 'Polygon' as geometry_types,
  cast(4326 as integer) as epsg from customer""")
oracle("q_raster_profile", "fx_ortho", """select 'ortho' as raster, cast(max(c) + 1 as bigint) as width,
  cast(max(r) + 1 as bigint) as height, count(distinct band) as bands, cast(4326 as integer) as epsg from fx_ortho""")

# ---- CRS -----------------------------------------------------------------------------------------

oracle("q_reproject_utm_to_wgs84", "fx_samples_utm", f"select sample_id, {rnd('lon')} as lon6, {rnd('lat')} as lat6 from geo",
       {"geo": utm_inverse("fx_samples_utm", "easting", "northing")})
oracle("q_reproject_wgs84_to_utm", "fx_samples", f"select sample_id, {rnd('ux', '1e3')} as e3, {rnd('uy', '1e3')} as n3 from utm",
       {"utm": utm_forward("fx_samples", "lon", "lat")})
oracle("q_reproject_webmercator", "fx_poly", f"""select fid, cast(i as bigint) as i, {rnd('6378137e0 * radians(x)', '1e3')} as x3,
  {rnd('6378137e0 * ln(tan(pi() / 4 + radians(y) / 2))', '1e3')} as y3 from fx_poly""")
_bounds = lambda name, x, y, src, ok: (f"select '{name}' as layer, {rnd(f'min({x})')} as xmin6, {rnd(f'min({y})')} as ymin6, "  # noqa: E731
                                       f"{rnd(f'max({x})')} as xmax6, {rnd(f'max({y})')} as ymax6, {ok} as in_range from {src}")
oracle("q_total_bounds", "fx_samples fx_samples_utm fx_poly", " union all ".join([
    _bounds("samples", "lon", "lat", "fx_samples", "true"), _bounds("polygons", "x", "y", "fx_poly", "true"),
    _bounds("utm", "lon", "lat", "geo", "true"), _bounds("raw", "easting", "northing", "fx_samples_utm", "false")]),
    {"geo": utm_inverse("fx_samples_utm", "easting", "northing")})
_WARP = {
    "um": "select 400000e0 as x0, 3970000e0 as y0, 5000e0 as dx, 100000e0 / (count(*) / 20e0) as dy, cast(floor(count(*) / 20e0) as bigint) as h from part",
    "rim": """select x0 + t * 100000e0 as x, y0 as y from um cross join (select range / 20e0 as t from range(21)) k
      union all select x0 + t * 100000e0, y0 - h * dy from um cross join (select range / 20e0 as t from range(21)) k
      union all select x0, y0 - h * dy + t * (h * dy) from um cross join (select range / 20e0 as t from range(21)) k
      union all select x0 + 100000e0, y0 - h * dy + t * (h * dy) from um cross join (select range / 20e0 as t from range(21)) k""",
    "rimgeo": utm_inverse("rim", "x", "y"),
    "box": "select min(lon) as x0, max(lon) as x1, min(lat) as y0, max(lat) as y1 from rimgeo",
    "grid": """select b.x0, b.y1 as y0, sqrt((x1 - b.x0) * (x1 - b.x0) + (y1 - b.y0) * (y1 - b.y0)) / sqrt(cast(400 + h * h as double)) as res,
      x1 - b.x0 as wide, y1 - b.y0 as high from box b cross join um""",
    "gridn": """select x0, y0, res, cast(floor(wide / res + 0.5e0) as bigint) as width, cast(floor(high / res + 0.5e0) as bigint) as height from grid""",
}
oracle("q_warp_grid", "", f"select {rnd('x0')} as x6, {rnd('y0')} as y6, {rnd('res', '1e9')} as res9, width, height from gridn", _WARP)
oracle("q_raster_warp", "fx_dem", f"""select r, c, {rnd('sum(v * w) / sum(w)', '1e3')} as v3 from nbv
  where v is not null group by r, c having sum(w) > 0""", {
    **_WARP,
    "dst": """select cast(a.range as bigint) as r, cast(b.range as bigint) as c, x0 + (b.range + 0.5e0) * res as lon,
      y0 - (a.range + 0.5e0) * res as lat from gridn, range(0, (select height from gridn)) a, range(0, (select width from gridn)) b""",
    "dstu": utm_forward("dst", "lon", "lat"),
    "src": """select r, c, (ux - um.x0) / um.dx - 0.5e0 as fc, (um.y0 - uy) / um.dy - 0.5e0 as fr, um.h from dstu cross join um""",
    "nbs": """select src.r, src.c, cast(floor(fr) + o.dr as bigint) as nr, cast(floor(fc) + o.dc as bigint) as nc,
      (case o.dr when 0 then 1 - (fr - floor(fr)) else fr - floor(fr) end) * (case o.dc when 0 then 1 - (fc - floor(fc)) else fc - floor(fc) end) as w
      from src cross join (values (0, 0), (0, 1), (1, 0), (1, 1)) o(dr, dc)
      where fc between -0.5e0 and 19.5e0 and fr between -0.5e0 and h - 0.5e0""",
    "nbv": "select nbs.r, nbs.c, nullif(d.v, -9999e0) as v, w from nbs join fx_dem d on d.r = nbs.nr and d.c = nbs.nc",
})

# ---- validity and repair -------------------------------------------------------------------------

_CROSS = "fx_poly fx_poly_edge fx_poly_cross"
oracle("q_drop_null_geometry", "", "select c_custkey as fid from customer where c_custkey % 50 <> 7")
oracle("q_geometry_validity", _CROSS, """select c_custkey as fid, c_custkey in (select fid from fx_poly)
  and c_custkey not in (select fid from fx_poly_cross) as valid from customer""")
oracle("q_invalid_reason", _CROSS, f"""select fid, 'Self-intersection' as reason, {rnd('px')} as x6, {rnd('py')} as y6 from fx_poly_cross
  union all select c_custkey, 'Null geometry', null, null from customer where c_custkey not in (select fid from fx_poly)""")
_OUT = _CROSS + " fx_outline fx_outline_edge"
oracle("q_repair_bowtie", _OUT, f"""select fid, count(*) as parts, {rnd('sum(a)', '1e10')} as area10 from (
  select fid, part, abs(sum((x1 - 70) * (y2 - 35) - (x2 - 70) * (y1 - 35))) / 2 as a from fx_outline_edge group by fid, part) t group by fid""")

_SEG = {"seg": """select p.fid, p.i, p.x as x1, p.y as y1, q.x as x2, q.y as y2, m.n, m.fx, m.fy, m.lx, m.ly
  from fx_line p join fx_line q on q.fid = p.fid and q.i = p.i + 1
  join (select fid, max(i) as n, arg_min(x, i) as fx, arg_min(y, i) as fy, arg_max(x, i) as lx, arg_max(y, i) as ly from fx_line group by fid) m on m.fid = p.fid""",
        "pr": """select a.fid, a.i, b.i as j, a.x1, a.y1, a.x2, a.y2, b.x1 as u1, b.y1 as v1, b.x2 as u2, b.y2 as v2,
  (a.x2 - a.x1) * (b.y1 - a.y1) - (a.y2 - a.y1) * (b.x1 - a.x1) as d1, (a.x2 - a.x1) * (b.y2 - a.y1) - (a.y2 - a.y1) * (b.x2 - a.x1) as d2,
  (b.x2 - b.x1) * (a.y1 - b.y1) - (b.y2 - b.y1) * (a.x1 - b.x1) as d3, (b.x2 - b.x1) * (a.y2 - b.y1) - (b.y2 - b.y1) * (a.x2 - b.x1) as d4,
  b.i = a.i + 1 or (a.i = 0 and b.i = a.n - 1 and a.fx = a.lx and a.fy = a.ly) as adj
  from seg a join seg b on b.fid = a.fid and b.i > a.i""",
        "pt": """select *, ((u1 - x1) * (x2 - x1) + (v1 - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as s1,
  ((u2 - x1) * (x2 - x1) + (v2 - y1) * (y2 - y1)) / ((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as s2 from pr""",
        "meet": """select * from pt where (d1 = 0 and d2 = 0 and least(1e0, greatest(s1, s2)) > greatest(0e0, least(s1, s2)))
  or (not adj and d1 = 0 and d2 = 0 and least(1e0, greatest(s1, s2)) = greatest(0e0, least(s1, s2)))
  or (not adj and not (d1 = 0 and d2 = 0) and sign(d1) * sign(d2) <= 0 and sign(d3) * sign(d4) <= 0)"""}
_LINE = "fx_line_raw fx_line_kept fx_line"
oracle("q_line_self_crossing", _LINE, """select l.fid, l.fid not in (select fid from meet) as simple
  from (select distinct fid from fx_line) l""", _SEG)
_NODE = {
    **_SEG,
    # Every place where two segments meet, with the exact vertex where it is one.
    "spot": """select fid, i, j, case when d3 = 0 then x1 when d4 = 0 then x2 when d1 = 0 then u1 when d2 = 0 then u2
        else floor((x1 + d3 / (d3 - d4) * (x2 - x1)) * 1e9 + 0.5e0) / 1e9 end as px,
      case when d3 = 0 then y1 when d4 = 0 then y2 when d1 = 0 then v1 when d2 = 0 then v2
        else floor((y1 + d3 / (d3 - d4) * (y2 - y1)) * 1e9 + 0.5e0) / 1e9 end as py
      from meet where not (d1 = 0 and d2 = 0)
      union all select fid, i, j, u1, v1 from meet where d1 = 0 and d2 = 0 and s1 between 0 and 1
      union all select fid, i, j, u2, v2 from meet where d1 = 0 and d2 = 0 and s2 between 0 and 1
      union all select fid, i, j, x1, y1 from meet where d1 = 0 and d2 = 0 and 0 between least(s1, s2) and greatest(s1, s2)
      union all select fid, i, j, x2, y2 from meet where d1 = 0 and d2 = 0 and 1 between least(s1, s2) and greatest(s1, s2)""",
    "nodes": "select distinct fid, i as k, px, py from spot union select distinct fid, j, px, py from spot",
    "stops": """select n.fid, n.k, n.px, n.py, 1 as node, ((n.px - s.x1) * (s.x2 - s.x1) + (n.py - s.y1) * (s.y2 - s.y1))
        / ((s.x2 - s.x1) * (s.x2 - s.x1) + (s.y2 - s.y1) * (s.y2 - s.y1)) as t from nodes n join seg s on s.fid = n.fid and s.i = n.k
      union all select fid, i, x1, y1, 0, 0e0 from seg union all select fid, i, x2, y2, 0, 1e0 from seg""",
    "uniq": "select fid, k, px, py, max(node) as node, min(t) as t from stops group by fid, k, px, py",
    "steps": """select fid, k, t, node, px, py, lead(px) over w as qx, lead(py) over w as qy, lead(node) over w as qnode
      from uniq window w as (partition by fid, k order by t)""",
    "piece": """select *, lag(qnode) over (partition by fid order by k, t) as pnode,
      row_number() over (partition by fid, least([px, py], [qx, qy]), greatest([px, py], [qx, qy]) order by k, t) as dup
      from steps where qx is not null""",
    "runs": """select *, sum(case when pnode is null or pnode = 1 or node = 1 then 1 else 0 end) over (partition by fid order by k, t) as run from piece""",
}
oracle("q_node_lines", _LINE, f"""select l.fid, case when l.fid in (select fid from meet) then r.parts else 1 end as parts,
  {rnd('coalesce(r.len, 0e0)', '1e3')} as length3 from (select distinct fid from fx_line) l left join (
  select fid, count(distinct run) as parts, sum(sqrt((qx - px) * (qx - px) + (qy - py) * (qy - py))) as len
  from runs where dup = 1 or fid not in (select fid from meet) group by fid) r on r.fid = l.fid""", _NODE)
oracle("q_validity_rate", _CROSS, f"""select 'polygons' as layer, n as n_rows, n - b as n_valid, {rnd('(n - b) * 1e0 / n')} as rate6 from
  (select count(distinct fid) as n from fx_poly) cross join (select count(distinct fid) as b from fx_poly_cross)""")
oracle("q_repair_report", _CROSS, """select 'polygons' as layer, count(*) as rows_before,
  cast(sum(case when c_custkey in (select fid from fx_poly) then 0 else 1 end) as bigint) as n_dropped,
  cast(sum(case when c_custkey in (select fid from fx_poly_cross) then 1 else 0 end) as bigint) as n_invalid,
  cast(0 as bigint) as n_crossing, cast(1000000 as bigint) as rate6 from customer""")

# ---- clip ----------------------------------------------------------------------------------------

oracle("q_clip_points", "fx_samples fx_ring fx_edge", f"""select s.sample_id, {rnd('s.lon')} as lon6 from fx_samples s cross join fx_edge e
  group by s.sample_id, s.lon having {inside('s.lon', 's.lat')}""")
_UTMRING = {"west": """select * from (values (0, 68.5e0, 35.2e0), (1, 69.6e0, 35.1e0), (2, 69.9e0, 35.7e0),
              (3, 69.0e0, 35.8e0), (4, 68.5e0, 35.2e0)) t(i, x, y)""",
            "ringu": utm_forward("west", "x", "y"),
            "edgeu": "select a.ux as x1, a.uy as y1, b.ux as x2, b.uy as y2 from ringu a join ringu b on b.i = a.i + 1"}
oracle("q_clip_points_utm", "fx_samples_utm", f"""select s.sample_id from fx_samples_utm s cross join edgeu e
  group by s.sample_id having {inside('s.easting', 's.northing')}""", _UTMRING)
_BLOCKS = {"blk": """select * from (values (0, 70.1e0, 35.1e0, 70.4e0, 35.4e0), (1, 70.3e0, 35.3e0, 70.7e0, 35.6e0)) t(m, xa, ya, xb, yb)"""}
oracle("q_clip_points_multimask", "fx_samples", """select distinct sample_id from fx_samples join blk
  on lon between xa and xb and lat between ya and yb""", _BLOCKS)
_COAST = {"shore": """select ((p_size - 1) * 25 + cast(split_part(p_brand, '#', 2) as int) - 1) * 2 + p_partkey % 2 as k,
              sum(p_partkey) % 97 as height from part group by 1""",
          "coastline": """select k as i, 70.1e0 + 0.8e0 * (k + 0.5e0) / 2500e0 as x, 35.5e0 + 0.3e0 * cast(height as double) / 97e0 as y from shore
              union all select * from (values (-1, 70.1e0, 35.1e0), (9999, 70.9e0, 35.1e0), (10000, 70.1e0, 35.1e0)) t(i, x, y)""",
          "coast_edge": """select x1, y1, x2, y2 from (select x as x1, y as y1, lead(x) over (order by i) as x2, lead(y) over (order by i) as y2 from coastline) s
              where x2 is not null union all select * from (values (70.4e0, 35.2e0, 70.6e0, 35.2e0), (70.6e0, 35.2e0, 70.6e0, 35.4e0),
              (70.6e0, 35.4e0, 70.4e0, 35.4e0), (70.4e0, 35.4e0, 70.4e0, 35.2e0)) t(a, b, c, d)"""}
oracle("q_clip_points_coast", "fx_samples", f"""select s.sample_id from fx_samples s cross join coast_edge e
  group by s.sample_id having {inside('s.lon', 's.lat')}""", _COAST)
oracle("q_clip_classify", "fx_poly fx_poly_edge fx_ring fx_edge", f"""select fid, case when bool_or(meets) or bool_or(holds) then 'BOUNDARY'
  when bool_or(isin) then 'INSIDE' else 'OUTSIDE' end as position from (
  select s.fid, s.i, bool_or(len(list_filter({cut_params('s', 'e')}, lambda t: t between 0 and 1)) > 0) as meets,
    {inside('s.x1', 's.y1')} as isin, false as holds from fx_poly_edge s cross join fx_edge e group by s.fid, s.i, s.x1, s.y1
  union all select s.fid, 0, false, false, sum({parity('v.x', 'v.y', 's')}) % 2 = 1 from fx_poly_edge s cross join fx_ring v group by s.fid, v.i) t
  group by fid""")
_LSEG = {
    "lseg": "select p.fid, p.i, p.x as x1, p.y as y1, q.x as x2, q.y as y2 from fx_line_deg p join fx_line_deg q on q.fid = p.fid and q.i = p.i + 1",
    "cuts": f"select s.fid, s.i, unnest({cut_params('s', 'e')}) as t from lseg s cross join fx_edge e",
    "stops": "select fid, i, t from cuts where t > 0 and t < 1 union select fid, i, 0e0 from lseg union select fid, i, 1e0 from lseg",
    "parts": "select fid, i, t, lead(t) over (partition by fid, i order by t) as u from stops",
    "mid": """select p.fid, p.i, p.t, (u - t) * sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) as len,
      x1 + (t + u) / 2 * (x2 - x1) as mx, y1 + (t + u) / 2 * (y2 - y1) as my from parts p join lseg s on s.fid = p.fid and s.i = p.i where u > t""",
    "kept": f"""select m.fid, m.len from mid m cross join fx_edge e group by m.fid, m.i, m.t, m.len
      having sum({parity('m.mx', 'm.my')}) % 2 = 1 or bool_or({near_edge('m.mx', 'm.my')})""",
}
oracle("q_clip_lines", _LINE + " fx_line_deg fx_ring fx_edge", f"select fid, {rnd('sum(len)')} as length6 from kept group by fid having sum(len) > 1e-9", _LSEG)


# The mask as disjoint axis-parallel rectangles; a triangle or square is cut by one side after another.
def _cut(name: str, source: str, inside_expr: str, limit: str, axis: str) -> dict[str, str]:
    """One clipping step on convex outlines: keep vertices inside, add the crossings of the limit."""
    other = "y" if axis == "x" else "x"
    cross = f"{other} + ({limit} - {axis}) / nullif({axis}n - {axis}, 0e0) * ({other}n - {other})"
    new = (f"{limit} as x, {cross} as y" if axis == "x" else f"{cross} as x, {limit} as y")
    here, there = inside_expr.format(v=axis), inside_expr.format(v=axis + "n")
    return {
        f"{name}n": f"""select *, coalesce(lead(x) over w, first_value(x) over w) as xn, coalesce(lead(y) over w, first_value(y) over w) as yn
          from {source} window w as (partition by fid, part, m order by k rows between unbounded preceding and unbounded following)""",
        name: f"""select fid, part, m, xa, ya, xb, yb, row_number() over (partition by fid, part, m order by k, o) as k, x, y from (
          select fid, part, m, xa, ya, xb, yb, k, 0 as o, x, y from {name}n where {here}
          union all select fid, part, m, xa, ya, xb, yb, k, 1, {new} from {name}n where ({here}) <> ({there})) z""",
    }


def _rect_clip(rects: str) -> dict[str, str]:
    out = {"rect": rects,
           "c0": """select o.fid, o.part, r.m, r.xa, r.ya, r.xb, r.yb, o.i as k, o.x, o.y from fx_outline o cross join rect r
             where o.i < (select max(i) from fx_outline p where p.fid = o.fid and p.part = o.part)"""}
    out.update(_cut("c1", "c0", "{v} >= xa", "xa", "x"))
    out.update(_cut("c2", "c1", "{v} <= xb", "xb", "x"))
    out.update(_cut("c3", "c2", "{v} >= ya", "ya", "y"))
    out.update(_cut("c4", "c3", "{v} <= yb", "yb", "y"))
    out["ring"] = """select *, coalesce(lead(x) over w, first_value(x) over w) as xn, coalesce(lead(y) over w, first_value(y) over w) as yn
          from c4 window w as (partition by fid, part, m order by k rows between unbounded preceding and unbounded following)"""
    out["area"] = """select fid, sum(a) as area from (select fid, part, m,
          abs(sum((x - 70) * (yn - 35) - (xn - 70) * (y - 35))) / 2 as a from ring group by fid, part, m) t group by fid"""
    return out


oracle("q_clip_polygons", _OUT, f"select fid, {rnd('area', '1e10')} as area10 from area where area > 1e-13", _rect_clip(
    "select * from (values (0, 70.2e0, 35.2e0, 70.8e0, 35.5e0), (1, 70.2e0, 35.5e0, 70.5e0, 35.8e0)) t(m, xa, ya, xb, yb)"))
oracle("q_clip_polygons_multimask", _OUT, f"select fid, {rnd('area', '1e10')} as area10 from area where area > 1e-13", _rect_clip(
    """select * from (values (0, 70.1e0, 35.1e0, 70.4e0, 35.3e0), (1, 70.1e0, 35.3e0, 70.7e0, 35.4e0), (2, 70.3e0, 35.4e0, 70.7e0, 35.6e0))
       t(m, xa, ya, xb, yb)"""))
oracle("q_clip_report", "fx_samples fx_ring fx_edge", f"""select 'samples' as layer, (select count(*) from fx_samples) as n_before,
  count(*) as n_after from (select s.sample_id from fx_samples s cross join fx_edge e group by s.sample_id, s.lon, s.lat having {inside('s.lon', 's.lat')}) t""")
_PIX = {"px": """select r, c, v, x0 + (c + 0.5e0) * dx as x, y0 - (r + 0.5e0) * dy as y, x0, y0, dx, dy from fx_dem cross join fx_dem_meta""",
        "win": """select floor((70.2e0 - x0) / dx + 1e-9) as ca, ceil((70.8e0 - x0) / dx - 1e-9) as cb,
          floor((y0 - 35.8e0) / dy + 1e-9) as ra, ceil((y0 - 35.2e0) / dy - 1e-9) as rb from fx_dem_meta"""}
oracle("q_raster_mask", "fx_dem fx_dem_meta fx_ring fx_edge", f"""select r, c, {rnd(f'case when {inside("p.x", "p.y")} then v else -9999e0 end', '1e4')} as v4
  from px p cross join fx_edge e cross join win where r >= ra and r < rb and c >= ca and c < cb group by r, c, v""", _PIX)
oracle("q_raster_crop", "fx_dem fx_dem_meta", f"""select cast(r - ra as bigint) as r, cast(c - ca as bigint) as c, {rnd('v', '1e4')} as v4
  from px cross join win where r >= ra and r < rb and c >= ca and c < cb""", _PIX)

# ---- schema --------------------------------------------------------------------------------------

oracle("q_rename_fields", "fx_messy", "select feature_no, Name as status, POP_2020 as population, seen from fx_messy")
oracle("q_normalize_text", "fx_messy", "select feature_no, trim(Name) as Name, trim(POP_2020) as POP_2020, trim(seen) as seen from fx_messy")
oracle("q_normalize_text_nulltext", "fx_messy", "select feature_no, trim(Name) as Name, coalesce(trim(POP_2020), 'None') as POP_2020, trim(seen) as seen from fx_messy")
oracle("q_cast_int", "fx_messy", "select feature_no, try_cast(POP_2020 as bigint) as POP_2020 from fx_messy")
oracle("q_cast_failures", "fx_messy", """select 'POP_2020' as field, 'int' as target, count(*) as n_bad, min(POP_2020) as sample
  from fx_messy where POP_2020 is not null and try_cast(POP_2020 as bigint) is null
  union all select 'feature_no', 'float', cast(0 as bigint), null""")
oracle("q_cast_float", "fx_messy", f"select feature_no, {rnd('try_cast(POP_2020 as double)', '1e3')} as pop3 from fx_messy")
oracle("q_cast_str", "fx_messy", "select cast(feature_no as varchar) as feature_no, seen from fx_messy")
oracle("q_cast_datetime", "fx_messy", "select feature_no, strftime(try_cast(seen as timestamp), '%Y-%m-%d') as seen from fx_messy")
oracle("q_missing_field", "fx_messy", "select feature_no, true as no_depth from fx_messy")
oracle("q_drop_extra_fields", "fx_samples", "select sample_id, litho, cast(3 as bigint) as n_columns from fx_samples")
oracle("q_harmonize_schema", "fx_messy", """select feature_no, trim(Name) as status, try_cast(trim(POP_2020) as bigint) as population,
  strftime(try_cast(seen as timestamp), '%Y-%m-%d') as seen, true as depth from fx_messy""")

# ---- QA ------------------------------------------------------------------------------------------

_QA = {"n": """select (select count(*) from events) as s, (select count(*) from customer) as p,
         (select count(distinct fid) from fx_poly) - (select count(distinct fid) from fx_poly_cross) as ok""",
       "rep": """select * from (
  select 'samples' as layer, 'row_count' as "check", true as passed, 'row count ' || s || ' is within expected range' as message from n
  union all select 'samples', 'required_fields', true, 'all required fields present'
  union all select 'samples', 'geometry_validity', true, 'all geometries valid'
  union all select 'samples', 'geometry_not_null', true, 'geometry column has values'
  union all select 'samples', 'crs_match', true, 'CRS matches project CRS (EPSG:4326)'
  union all select 'polygons', 'row_count', true, 'row count ' || p || ' is within expected range' from n
  union all select 'polygons', 'required_fields', false, 'missing required fields: [''sample_id'']'
  union all select 'polygons', 'geometry_validity', false, printf('%.1f', ok * 100e0 / p) || '% of geometries are valid (expected 100%)' from n
  union all select 'polygons', 'geometry_not_null', true, 'geometry column has values'
  union all select 'polygons', 'crs_match', true, 'CRS matches project CRS (EPSG:4326)'
  union all select 'utm', 'row_count', true, 'row count ' || p || ' is within expected range' from n
  union all select 'utm', 'required_fields', true, 'all required fields present'
  union all select 'utm', 'geometry_validity', true, 'all geometries valid'
  union all select 'utm', 'geometry_not_null', true, 'geometry column has values'
  union all select 'utm', 'crs_match', false, 'CRS is EPSG:32642, expected EPSG:4326') t"""}
oracle("q_qa_report", _CROSS, "select * from rep", _QA)
oracle("q_qa_summary", _CROSS, "select cast(sum(case when passed then 1 else 0 end) as bigint) as n_passed, count(*) as n_total from rep", _QA)

# ---- terrain -------------------------------------------------------------------------------------

_D = "fx_dem fx_dem_meta"
oracle("q_dem_grid", _D, f"""select r, c, {rnd('x0 + (c + 0.5e0) * dx')} as lon6, {rnd('y0 - (r + 0.5e0) * dy')} as lat6,
  {rnd('nullif(v, -9999e0)', '1e4')} as z4 from fx_dem cross join fx_dem_meta""")
for _name, _shift in (("q_sample_elevation", "0e0"), ("q_sample_elevation_center", "0.5e0")):
    oracle(_name, "fx_samples " + _D, f"select sample_id, {rnd('z', '1e4')} as z4 from zz",
           bilinear("fx_samples", "sample_id", _shift, "lon", "lat"))


def _drape(points: str) -> dict[str, str]:
    return {"pts": points, **bilinear("pts", "fid, i")}


_DRAPED = (f"select fid, i, {rnd('x')} as lon6, {rnd('(x - lon0) / span')} as x6, {rnd('(y - lat0) / span')} as y6, "
           f"{rnd('(z - lo) * (1 / (hi - lo)) * 2')} as z6 from zz cross join zr cross join sc")
oracle("q_drape_points", "fx_samples " + _D, _DRAPED, _drape("select sample_id as fid, cast(0 as bigint) as i, lon as x, lat as y from fx_samples"))
oracle("q_drape_lines", _LINE + " fx_line_deg " + _D, _DRAPED, _drape("select fid, i, x, y from fx_line_deg"))
oracle("q_drape_polygons", "fx_poly " + _D, _DRAPED, _drape("select fid, cast(i as bigint) as i, x, y from fx_poly"))
oracle("q_terrain_samples", "fx_samples fx_ring fx_edge " + _D, _DRAPED, _drape(
    f"""select s.sample_id as fid, cast(0 as bigint) as i, s.lon as x, s.lat as y from fx_samples s cross join fx_edge e
    group by s.sample_id, s.lon, s.lat having {inside('s.lon', 's.lat')}"""))
_SC = {k: v for k, v in bilinear("fx_samples", "sample_id").items() if k in ("zr", "sc")}
oracle("q_normalize_xy", "fx_samples " + _D, f"""select sample_id, {rnd('(lon - lon0) / span')} as x6, {rnd('(lat - lat0) / span')} as y6
  from fx_samples cross join sc""", _SC)
oracle("q_normalize_z", _D, f"select r, c, {rnd('(nullif(v, -9999e0) - lo) * (1 / (hi - lo)) * 1.5e0')} as z6 from fx_dem cross join zr", _SC)
oracle("q_terrain_mesh", _D, f"""select r, c, {rnd('(x0 + (c + 0.5e0) * dx - lon0) / span')} as x6, {rnd('(y0 - (r + 0.5e0) * dy - lat0) / span')} as y6,
  {rnd('(nullif(v, -9999e0) - lo) * (1 / (hi - lo)) * 2')} as z6, {rnd('nullif(v, -9999e0)', '1e4')} as e4
  from fx_dem cross join fx_dem_meta cross join zr cross join sc""", _SC)
_RGB = {"rg": "select min(v) as lo, max(v) as hi from fx_ortho",
        "rgb": """select r, c, max(case when band = 1 then q end) as red, max(case when band = 2 then q end) as green,
          max(case when band = 3 then q end) as blue from (select band, r, c, cast(floor((v - lo) / (hi - lo) * 255e0) as bigint) as q
          from fx_ortho cross join rg) t group by r, c"""}
oracle("q_ortho_rgb", "fx_ortho", "select r, c, red, green, blue from rgb", _RGB)
oracle("q_ortho_gray", "fx_ortho", """select r, c, q as red, q as green, q as blue from (
  select r, c, cast(floor((v - lo) / (hi - lo) * 255e0) as bigint) as q from fx_ortho
  cross join (select min(v) as lo, max(v) as hi from fx_ortho where band = 2) g where band = 2) t""")
oracle("q_texture_uv", _D, f"""select r, c, {rnd('(x0 + (c + 0.5e0) * dx - x0) / (x0 + width * dx - x0)')} as u6,
  {rnd('(y0 - (r + 0.5e0) * dy - (y0 - height * dy)) / (y0 - (y0 - height * dy))')} as v6 from fx_dem cross join fx_dem_meta""")
oracle("q_textured_terrain", "fx_ortho fx_dem fx_dem_meta", """select d.r, d.c, o.red, o.green, o.blue from (
  select r, c, floor((c + 0.5e0 - 4.25e0)) as oc from fx_dem) d left join rgb o on o.r = d.r and o.c = d.oc""", _RGB)
oracle("q_geometry_kinds", "", """select 'point' as kind, count(*) as n_rows from events
  union all select 'polygon', count(*) from customer where c_custkey % 50 <> 7
  union all select 'missing', count(*) from customer where c_custkey % 50 = 7""")
oracle("q_terrain_model", "fx_samples fx_poly " + _D, f"""select layer, count(*) as n, count(z1) as n_z, cast(sum({rnd('z1')}) as bigint) as z6 from (
  select layer, (z - lo) * (1 / (hi - lo)) * 2 as z1 from (
    select layer, z from zz union all select 'terrain', nullif(v, -9999e0) from fx_dem) a cross join zr) t group by layer""",
       _drape("""select 'samples' as layer, sample_id as fid, cast(0 as bigint) as i, lon as x, lat as y from fx_samples
       union all select 'polygons', fid, cast(i as bigint), x, y from fx_poly"""))
ORACLES["q_terrain_model"] = ORACLES["q_terrain_model"].replace("select fid, i, x, y, case", "select layer, fid, i, x, y, case") \
    .replace("group by fid, i, x, y", "group by layer, fid, i, x, y")

# ---- sinks ---------------------------------------------------------------------------------------

oracle("q_roundtrip_parquet", "fx_poly", f"""select c_custkey as fid, cast(4326 as bigint) as epsg, count(p.fid) > 0 as present,
  {rnd('min(p.x)')} as x6 from customer left join fx_poly p on p.fid = c_custkey group by c_custkey""")
oracle("q_to_geojson", "fx_samples", f"""select sample_id, 'Feature' as type, 'Point' as kind, {rnd('lon')} as x6, {rnd('lat')} as y6, litho
  from fx_samples""")
oracle("q_roundtrip_raster", "fx_dem", f"select r, c, {rnd('nullif(v, -9999e0)', '1e4')} as v4 from fx_dem")
oracle("q_samples_end_to_end", "fx_samples fx_ring fx_edge", f"""select s.sample_id, s.litho as rock, {rnd('s.assay')} as assay6, {rnd('s.lon')} as x6
  from fx_samples s cross join fx_edge e group by s.sample_id, s.litho, s.assay, s.lon having {inside('s.lon', 's.lat')}""")
