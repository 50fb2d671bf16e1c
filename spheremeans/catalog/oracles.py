"""The same results in SQL, written independently of the DataFrame code."""

from __future__ import annotations

from spheremeans.catalog.fixtures import line_sql, point_view_sql


def _xyz(lat: str, lon: str) -> tuple[str, str, str]:
    return (
        f"6371e0 * cos(radians({lat})) * cos(radians({lon}))",
        f"6371e0 * cos(radians({lat})) * sin(radians({lon}))",
        f"6371e0 * sin(radians({lat}))",
    )


def _chord(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    pairs = zip(_xyz(lat1, lon1), _xyz(lat2, lon2), strict=True)
    return "sqrt(" + " + ".join(f"pow(({b}) - ({a}), 2)" for a, b in pairs) + ")"


def _haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"least(1e0, pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))"
    )
    return f"2 * 6371e0 * atan2(sqrt({a}), sqrt(1e0 - {a}))"


_DISTANCE = {"euclidean": _chord, "haversine": _haversine}


def _points(view: str) -> str:
    """CTE ``pts`` with a row key and the Cartesian position."""
    x, y, z = _xyz("latitude", "longitude")
    key = "row_number() over () as point_id, " if view == "lineitem_points" else ""
    if view == "located_event_points":
        return _points("event_points").replace(") v)", ") v where point_id % 10 <> 0)")
    return (
        f"pts as materialized (select {key}*, {x} as x, {y} as y, {z} as z"
        f" from ({point_view_sql(view)}) v)"
    )


def _drawn_seeds(k: int, seed: int = 1) -> str:
    return f"""seeds as materialized (
        select cast(rn - 1 as integer) as cluster_id, latitude, longitude
        from (select *, row_number() over (
                order by md5(concat('{seed}:', cast(point_id as string))), point_id) as rn from pts) s
        where rn <= {k})"""


def _table_seeds(view: str) -> str:
    return f"seeds as materialized ({point_view_sql(view)})"


def _ranked(centroids: str, columns: str = "", where: str = "true") -> str:
    """Every point against every centroid, ranked by distance then id."""
    cx, cy, cz = _xyz("c.latitude", "c.longitude")
    return f"""
        select d.*, row_number() over (partition by point_id order by km, cluster_id) as rn
        from (
            select p.point_id, p.latitude, p.longitude, c.cluster_id,
                   c.latitude as old_latitude, c.longitude as old_longitude, {columns}
                   sqrt(pow(x - cx, 2) + pow(y - cy, 2) + pow(z - cz, 2)) as km
            from pts p cross join (select c.*, {cx} as cx, {cy} as cy, {cz} as cz
                                   from {centroids} c where {where}) c) d"""


def _nearest(view: str, seeds: str) -> str:
    return (
        f"with {_points(view)}, {seeds}, "
        f"near as (select * from ({_ranked('seeds')}) r where rn = 1)"
    )


def _limbs(points: str) -> str:
    """``points`` with coordinates cut into whole degrees and three binary limbs, by repeated truncation."""
    out = points
    for i in range(4):
        rest = "{0}_rest" if i else "{0}"
        part = f"trunc({rest}) as {{0}}_{i}" + (f", ({rest} - trunc({rest})) * 1048576e0 as {{0}}_next" if i < 3 else "")
        parts = ", ".join(part.format(c) for c in ("latitude", "longitude"))
        out = f"(select * {'exclude (latitude_rest, longitude_rest)' if i else ''}, {parts} from {out})"
        if i < 3:
            out = f"(select * rename (latitude_next as latitude_rest, longitude_next as longitude_rest) from {out})"
    return out


def _exact_mean(column: str, where: str = "true") -> str:
    sums = [f"cast(sum(cast({column}_{i} as bigint)) filter (where {where}) as double)" for i in range(4)]
    return (
        f"({sums[0]} + ({sums[1]} + ({sums[2]} + {sums[3]} / 1048576e0) / 1048576e0) / 1048576e0)"
        f" / count(*) filter (where {where})"
    )


_LIMB_COLUMNS = ", ".join(f"p.{c}_{i}" for c in ("latitude", "longitude") for i in range(4)) + ","


def _loop(
    view: str,
    seeds: str,
    metric: str = "euclidean",
    tol: float = 1.0,
    max_iter: int = 100,
    kind: str = "double",
    exact: bool = False,
) -> str:
    """CTE ``fit``: one row per iteration and cluster until the movement is small."""
    mean = "coalesce(cast(cast(avg({0}) filter (where rn = 1) as " + kind + ") as double), any_value(old_{0})) as {0}"
    points, limbs = _points(view), ""
    if exact:
        mean = "coalesce(" + _exact_mean("{0}", "rn = 1") + ", any_value(old_{0})) as {0}"
        points, limbs = f"{points.replace('pts as', 'pts0 as')}, pts as materialized {_limbs('pts0')}", _LIMB_COLUMNS
    km = _DISTANCE[metric]("old_latitude", "old_longitude", "latitude", "longitude")
    going = f"c.moved > {tol}e0 and c.iteration < {max_iter}"
    return f"""with recursive {points}, {seeds},
    fit as (
        select 0 as iteration, cluster_id, cast(latitude as double) as latitude,
               cast(longitude as double) as longitude, cast(null as bigint) as n_points,
               cast(null as double) as km, cast(1e300 as double) as moved
        from seeds
        union all
        select iteration, cluster_id, latitude, longitude, n_points, km, sum(km) over () as moved
        from (
            select iteration, cluster_id, latitude, longitude, n_points, {km} as km
            from (
                select iteration + 1 as iteration, cluster_id,
                       {mean.format("latitude")},
                       {mean.format("longitude")},
                       any_value(old_latitude) as old_latitude,
                       any_value(old_longitude) as old_longitude,
                       count(*) filter (where rn = 1) as n_points
                from ({_ranked("fit", f"c.iteration, {limbs}", going)}) r
                group by iteration, cluster_id) m) n
    )"""


_PLACE = "round(latitude, 6) as latitude, round(longitude, 6) as longitude"


def _final(*args, **options) -> str:
    return f"""{_loop(*args, **options)}
        select iteration, cluster_id, n_points, {_PLACE} from fit
        where iteration = (select max(iteration) from fit)"""


def _keyless_seeds(rows: str, copy: str) -> str:
    """The first 40 by hash of the place, and of the copy's number if there is one."""
    part = "cast(floor(greatest(-4e9, least(4e9, {0})) * 1e9) as bigint)"
    name = f"concat('1:', {part.format('latitude')}, ':', {part.format('longitude')}{copy and ", ':', copy"})"
    order = f"cast(concat('0x', substr(md5({name}), 1, 15)) as bigint), latitude, longitude{copy and ', copy'}"
    return f"""
        select cast(row_number() over (order by {order}) - 1 as integer) as cluster_id, {_PLACE}
        from (select {rows} from ({point_view_sql('lineitem_points')}) v) r
        qualify row_number() over (order by {order}) <= 40"""


_GRID = " union all ".join(
    f"select *, {k} as k, '{metric}' as metric from ({_final('event_points', _drawn_seeds(k), metric=metric)})"
    for k in (2, 5, 6, 20)
    for metric in ("euclidean", "haversine")
)
_INDEXED = f"""with {_points("event_points")}, seeds as materialized (
        select cast(row_number() over (order by point_id) - 1 as integer) as cluster_id, latitude, longitude
        from ({point_view_sql("customer_points")}) v)
    select point_id, cluster_id, round(km, 6) as distance_km from ({_ranked("seeds")}) r where rn = 1"""
_SEEDS6 = _drawn_seeds(6)
_WITH_EMPTY = f"""seeds as materialized ({point_view_sql("region_seeds")}
        union all select cast((select count(*) from region) as integer), 89e0, 0e0)"""
_TIED = """(select cast(i * 4 + j as integer) as cluster_id, [20e0, -20e0, 40e0, -40e0][j + 1] as c_lat,
                   cast(-160 + 40 * i as double) as c_lon
            from range(9) a(i), range(4) b(j)
            union all select cast(36 + i as integer), 20e0, 0e0 from range(3) c(i))"""
_NEAR = _nearest("event_points", _SEEDS6)
_LABELLED = f"{_NEAR} select point_id, cluster_id, {_PLACE} from near"
_CHUNKED = f"""{_NEAR},
    sized as (select *, cast(ceil(count(*) over (partition by cluster_id) / 100e0) as bigint) as n from near),
    chunked as (select *, cast(concat('0x', substr(md5(cast(point_id as string)), 1, 8)) as bigint) % n as chunk
                from sized)"""
_STEP = f"""{_NEAR},
    means as (select cluster_id, avg(latitude) as latitude, avg(longitude) as longitude from near group by 1),
    pairs as (select cluster_id, o.latitude as old_latitude, o.longitude as old_longitude,
                     coalesce(m.latitude, o.latitude) as new_latitude,
                     coalesce(m.longitude, o.longitude) as new_longitude
              from seeds o full join means m using (cluster_id))"""
_PAIR = ("old_latitude", "old_longitude", "new_latitude", "new_longitude")


def _lines(layout: str) -> str:
    return (
        f"with lines as (select point_id, {line_sql(layout, 'duckdb')} as value"
        f" from ({point_view_sql('customer_points')}) v)"
    )


def _split(layout: str, pattern: str) -> str:
    return (
        f"{_lines(layout)}, split as (select value, regexp_split_to_array(value, '{pattern}') as f from lines)"
    )


_TYPED = "round(try_cast({0} as double), 6) as latitude, round(try_cast({1} as double), 6) as longitude"
_DEVICE = _split("device", "[,|/]")
_DECIMAL = "regexp_matches(f[{0}], '^-?[0-9]+\\.[0-9]+') and try_cast(f[{0}] as double) is not null"
_BOTH_DECIMAL = f"{_DECIMAL.format(1)} and {_DECIMAL.format(2)}"


_ZERO = """case when try_cast({0} as double) is null then 'latitude is no number'
                when try_cast({0} as double) = 0 then 'latitude is zero' end"""
_REASONS = {
    "space": (" +", "case when len(f) <> 3 then 'number of fields' end"),
    "device": ("[,|/]", _ZERO.format("f[13]")),
    "tab": (chr(92) + "t", _ZERO.format("f[1]")),
    "comma": (
        ",",
        f"""case when not ({_DECIMAL.format(1)}) then 'latitude is no decimal number'
                 when not ({_DECIMAL.format(2)}) then 'longitude is no decimal number' end""",
    ),
}
_REJECTED = " union all ".join(
    f"""select '{layout}' as layout, coalesce({reason}, 'kept') as reason, count(*) as n_lines
        from ({_split(layout, pattern)} select * from split) group by 2"""
    for layout, (pattern, reason) in _REASONS.items()
)


def _displacement(metric: str) -> str:
    return f"{_STEP} select round(sum({_DISTANCE[metric](*_PAIR)}), 6) as displacement_km from pairs"


def _to_hub(metric: str, name: str) -> str:
    km = _DISTANCE[metric]("latitude", "longitude", "48e0", "-157e0")
    return f"select point_id, round({km}, 6) as {name} from ({point_view_sql('event_points')}) v"


_NEAREST_KM = f"{_NEAR} select point_id, cluster_id, round(km, 6) as distance_km from near"

ORACLES: dict[str, str] = {
    "chord_distance": _to_hub("euclidean", "chord_km"),
    "haversine_distance": _to_hub("haversine", "haversine_km"),
    "seed_sample": f"with {_points('event_points')}, {_SEEDS6} select cluster_id, {_PLACE} from seeds",
    "seed_rows": _keyless_seeds("*, row_number() over (partition by latitude, longitude) as copy", "copy"),
    "seed_places": _keyless_seeds("distinct *", ""),
    "nearest_centroid_indexed": _INDEXED,
    "nearest_centroid": _NEAREST_KM,
    "nearest_centroid_array": _NEAREST_KM,
    "cluster_mean": f"""{_NEAR}
        select cluster_id, count(*) as n_points, round(avg(latitude), 6) as latitude,
               round(avg(longitude), 6) as longitude
        from near group by cluster_id order by cluster_id""",
    "lineitem_cluster_mean": f"""{_nearest("lineitem_points", _table_seeds("region_seeds"))}
        select cluster_id, count(*) as n_points, round(avg(latitude), 6) as latitude,
               round(avg(longitude), 6) as longitude
        from near group by cluster_id""",
    "cluster_lists": f"""{_CHUNKED}
        select cluster_id, chunk, count(*) as n_points,
               string_agg(printf('%.6f', latitude), ',' order by point_id) as lat_list,
               string_agg(printf('%.6f', longitude), ',' order by point_id) as long_list
        from chunked group by cluster_id, chunk order by cluster_id, chunk""",
    "cluster_lists_keyless": f"""{_nearest("lineitem_points", _table_seeds("region_seeds"))}
        select cluster_id, {_PLACE} from near""",
    "cluster_lists_repeated_key": f"{_NEAR} select cluster_id, {_PLACE} from near",
    "cluster_points_exploded": f"""{_CHUNKED}
        select cluster_id, chunk,
               row_number() over (partition by cluster_id, chunk order by point_id) - 1 as position, {_PLACE}
        from chunked""",
    "cluster_sizes": f"{_NEAR} select cluster_id, count(*) as n_points from near group by 1 order by 1",
    "centroid_ids": f"""{_nearest("lineitem_points", _table_seeds("nation_seeds"))},
        means as (select count(*) as n_points, avg(latitude) as latitude, avg(longitude) as longitude
                  from near group by cluster_id)
        select cast(row_number() over (order by latitude, longitude) - 1 as integer) as cluster_id,
               n_points, {_PLACE} from means""",
    "centroid_pairs": f"""{_STEP}
        select cluster_id, {', '.join(f'round({c}, 6) as {c}' for c in _PAIR)},
               round({_chord(*_PAIR)}, 6) as displacement_km from pairs""",
    "centroid_displacement_chord": _displacement("euclidean"),
    "centroid_displacement_haversine": _displacement("haversine"),
    "kmeans_3_iterations": _final("event_points", _SEEDS6, tol=-1.0, max_iter=3),
    "kmeans_converged": _final("event_points", _SEEDS6),
    "kmeans_converged_haversine": _final(
        "event_points", _drawn_seeds(5), metric="haversine", tol=5.0
    ),
    "kmeans_converged_customer": _final("customer_points", _SEEDS6),
    "kmeans_lineitem_regions": _final("lineitem_points", _table_seeds("region_seeds")),
    "kmeans_lineitem_nations": _final("lineitem_points", _table_seeds("nation_seeds")),
    "kmeans_tiles": _final("event_points", _SEEDS6),
    "kmeans_resumed": f"""{_loop("event_points", _SEEDS6)}
        select iteration, cluster_id, n_points, round(km, 6) as displacement_km, {_PLACE} from fit""",
    "kmeans_grid": _GRID,
    "kmeans_exact": f"""{_loop("event_points", _SEEDS6, exact=True)}
        select iteration, cluster_id, n_points, latitude, longitude from fit
        where iteration = (select max(iteration) from fit)""",
    "cluster_mean_exact": f"""{_nearest("lineitem_points", _table_seeds("region_seeds"))}
        select cluster_id, count(*) as n_points, {_exact_mean("latitude")} as latitude,
               {_exact_mean("longitude")} as longitude
        from {_limbs("near")} group by cluster_id""",
    "numbered_rows": f"""
        select row_number() over (order by latitude, longitude) - 1 as row_id, {_PLACE}
        from ({point_view_sql("lineitem_points")}) v""",
    "rejected_lines": _REJECTED,
    "box_points": f"""select point_id, {_PLACE} from ({point_view_sql("event_points")}) v
        where latitude between -20 and 30 and (longitude >= 100 or longitude <= -150)""",
    "map_pyramid": f"""{_NEAR},
    cells as (
        select zoom, cast(floor(greatest(0, least(63, floor((latitude + 90) / 180 * 64))) / pow(2, 6 - zoom)) as integer) as cell_row,
               cast(floor(greatest(0, least(63, floor((longitude + 180) / 360 * 64))) / pow(2, 6 - zoom)) as integer) as cell_column,
               cluster_id, latitude, longitude
        from near, (select cast(unnest(range(7)) as integer) as zoom) z)
    select zoom, cell_row, cell_column, cluster_id, count(*) as n_points,
           round(count(*) / sum(count(*)) over (partition by zoom, cell_row, cell_column), 6) as share,
           round(avg(latitude), 6) as latitude, round(avg(longitude), 6) as longitude
    from cells group by zoom, cell_row, cell_column, cluster_id""",
    "float32_centroids": _final("event_points", _SEEDS6, tol=-1.0, max_iter=2, kind="float"),
    "kmeans_many_centroids": _final("customer_points", _drawn_seeds(100), tol=-1.0, max_iter=2),
    "kmeans_predict": f"""{_loop("event_points", _SEEDS6)},
        last as (select cluster_id, latitude, longitude from fit
                 where iteration = (select max(iteration) from fit))
        select point_id, cluster_id, {_PLACE} from ({_ranked("last")}) r where rn = 1""",
    "kmeans_unlocated": f"""select f.*, n_unlocated
        from ({_final("located_event_points", _table_seeds("region_seeds"), tol=-1.0, max_iter=2)}) f,
             (select count(*) as n_unlocated from ({point_view_sql("event_points")}) v where point_id % 10 = 0) u""",
    "kmeans_empty_cluster": _final("event_points", _WITH_EMPTY, tol=-1.0, max_iter=2),
    "nearest_centroid_ties": f"""
        with pts as (select point_id, longitude as lon from ({point_view_sql("event_points")}) v),
        near as (select point_id, lon, cluster_id,
                        row_number() over (partition by point_id order by round(km, 5), cluster_id) as rn, km
                 from (select point_id, lon, cluster_id, {_chord("0e0", "lon", "c_lat", "c_lon")} as km
                       from pts, {_TIED}))
        select point_id, cluster_id as by_array, cluster_id, round(km, 6) as distance_km from near where rn = 1""",
    "kmeans_history": f"""{_loop("event_points", _SEEDS6)}
        select iteration, cluster_id, n_points, round(km, 6) as displacement_km, {_PLACE} from fit""",
    "kmeans_assignments": f"""{_loop("event_points", _SEEDS6)},
        last as (select cluster_id, latitude, longitude from fit
                 where iteration = (select max(iteration) - 1 from fit))
        select point_id, cluster_id, {_PLACE} from ({_ranked("last")}) r where rn = 1""",
    "scan_pipe": f"{_split('pipe', '[|]')} select {_TYPED.format('f[1]', 'f[2]')} from split",
    "scan_space": f"""{_split("space", " +")}
        select f[1] as latitude, f[2] as longitude from split where len(f) = 3""",
    "scan_multi_delim": f"""{_DEVICE} select f[1] as "date", f[2] as device, f[3] as "deviceId",
        f[13] as latitude, f[14] as longitude from split""",
    "scan_tab": f"{_split('tab', chr(92) + 't')} select f[1] as latitude, f[2] as longitude from split",
    "scan_comma": f"{_split('comma', ',')} select f[1] as latitude, f[2] as longitude from split",
    "line_count": f"{_lines('tab')} select count(*) as n_lines from lines",
    "arity_filter": f"""{_split("space", " +")}
        select value from split where len(f) = 3""",
    "scan_first_line": f"{_lines('space')} select value from lines",
    "decimal_filter": f"""{_split("comma", ",")}
        select f[1] as latitude, f[2] as longitude from split where {_BOTH_DECIMAL}""",
    "zero_lat_exact": f"""{_DEVICE} select f[3] as "deviceId", f[13] as latitude from split
        where try_cast(f[13] as double) <> 0""",
    "zero_lat_truncate": f"""{_DEVICE} select f[3] as "deviceId", f[13] as latitude from split
        where trunc(try_cast(f[13] as double)) <> 0""",
    "device_fields": f"""{_DEVICE}
        select f[1] as "date", f[3] as "deviceId", string_split(f[2], ' ')[1] as manufacturer,
               string_split(f[2], ' ')[2] as model, {_TYPED.format("f[13]", "f[14]")}
        from split where try_cast(f[13] as double) <> 0""",
    "clean_place_lines": f"""{_split("space", " +")}
        select {_TYPED.format("f[1]", "f[2]")} from split where len(f) = 3""",
    "clean_device_lines": f"""{_DEVICE} select {_TYPED.format("f[13]", "f[14]")} from split
        where try_cast(f[13] as double) <> 0""",
    "clean_tab_lines": f"""{_split("tab", chr(92) + "t")}
        select {_TYPED.format("f[1]", "f[2]")} from split where try_cast(f[1] as double) <> 0""",
    "clean_comma_lines": f"""{_split("comma", ",")}
        select {_TYPED.format("f[1]", "f[2]")} from split where {_BOTH_DECIMAL}""",
    "clean_points_roundtrip": f"select {_PLACE} from ({point_view_sql('event_points')}) v",
    "cluster_long_roundtrip": _LABELLED,
    "cluster_text_roundtrip": f"{_CHUNKED} select cluster_id, chunk, {_PLACE} from chunked",
    "cluster_csv_roundtrip": f"{_CHUNKED} select cluster_id, chunk, {_PLACE} from chunked",
}
