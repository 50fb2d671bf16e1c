"""Points and text lines derived from the given tables.

The tables hold no coordinates, so these expressions place each row near one of
25 hubs. They read the same in Spark SQL and in DuckDB, which lets a query and
its check start from equal points.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spheremeans.config import new_path

_LAT = "-50e0 + 4e0 * cast({hub} % 25 as double) + cast(({key} * 7919) % 2000 - 1000 as double) / 997e0"
_LON = "-170e0 + 13e0 * cast(({hub} * 7) % 25 as double) + cast(({key} * 104729) % 4000 - 2000 as double) / 997e0"

# view -> table, columns
POINT_VIEWS: dict[str, tuple[str, dict[str, str]]] = {
    "customer_points": (
        "customer",
        {
            "point_id": "c_custkey",
            "latitude": _LAT.format(hub="c_nationkey", key="c_custkey"),
            "longitude": _LON.format(hub="c_nationkey", key="c_custkey"),
        },
    ),
    "event_points": (
        "events",
        {
            "point_id": "event_id",
            "latitude": _LAT.format(hub="user_id", key="event_id"),
            "longitude": _LON.format(hub="user_id", key="event_id"),
        },
    ),
    # No key, and one place holds a third of the rows.
    "lineitem_points": (
        "lineitem",
        {
            "latitude": "case when l_orderkey % 3 = 0 then 10e0 else "
            + _LAT.format(hub="l_suppkey", key="l_partkey")
            + " end",
            "longitude": "case when l_orderkey % 3 = 0 then 20e0 else "
            + _LON.format(hub="l_suppkey", key="l_partkey")
            + " end",
        },
    ),
    "region_seeds": (
        "region",
        {
            "cluster_id": "r_regionkey",
            "latitude": "-40e0 + 20e0 * cast(r_regionkey as double)",
            "longitude": "-150e0 + 70e0 * cast(r_regionkey as double)",
        },
    ),
    "nation_seeds": (
        "nation",
        {
            "cluster_id": "n_nationkey",
            "latitude": "-48e0 + 3e0 * cast((n_nationkey * 3) % 25 as double)",
            "longitude": "-160e0 + 12e0 * cast(n_nationkey as double)",
        },
    ),
}

_SPOT = "fmt6(latitude)"
_ID = "cast(point_id as string)"

# Lines with some records spoilt: ragged, zero, near zero, whole or no numbers.
LINES: dict[str, str] = {
    "pipe": f"""concat(
        case point_id % 50 when 0 then '12.5d' when 1 then 'x' else {_SPOT} end, '|',
        case point_id % 50 when 2 then '3f' else fmt6(longitude) end, '|', {_ID})""",
    "space": f"""case point_id % 50
        when 0 then concat({_SPOT}, '  ', fmt6(longitude))
        when 1 then concat({_SPOT}, ' ', fmt6(longitude), ' http://x/', {_ID}, ' more')
        when 2 then concat(' ', {_SPOT}, ' ', fmt6(longitude))
        when 3 then concat({_SPOT}, ' ', fmt6(longitude), '  a b c  d')
        when 4 then concat({_SPOT}, ' ', fmt6(longitude), ' "a', soh, 'b')
        else concat({_SPOT}, '  ', fmt6(longitude), '   http://x/', {_ID}) end""",
    "device": f"""concat('2014-03-15:10:', {_ID}, ',',
        case when point_id % 50 = 4 then 'Solo' else concat('Maker', cast(point_id % 7 as string), ' M', cast(point_id % 11 as string)) end,
        '|dev-', {_ID}, '/1,2|3/4,5|6/7,8|9/',
        case point_id % 50 when 0 then '0' when 1 then '0.5' when 2 then '-0.9' when 3 then 'bad' else {_SPOT} end,
        ',', case when point_id % 50 = 5 then '12.5d' else fmt6(longitude) end)""",
    "tab": f"""concat(
        case point_id % 50 when 0 then '0' when 1 then '0.0' when 2 then '' when 3 then '-0.25' else {_SPOT} end,
        tab, fmt6(longitude), tab, {_ID})""",
    "comma": f"""concat(
        case point_id % 50 when 0 then '40' when 1 then '12.5abc' when 3 then '12.5d' when 4 then '12.5f' else {_SPOT} end, ',',
        case point_id % 50 when 2 then '' else fmt6(longitude) end, ',"red, used",', {_ID})""",
}

# Layouts whose files open with a line that is no record.
HEADED = {"pipe", "space", "tab", "comma"}


def point_view(spark: SparkSession, sf_dir: str, view: str) -> DataFrame:
    table, columns = POINT_VIEWS[view]
    source = spark.read.parquet(f"{sf_dir}/{table}.parquet")
    return source.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def point_view_sql(view: str) -> str:
    table, columns = POINT_VIEWS[view]
    return f"select {', '.join(f'{expr} as {name}' for name, expr in columns.items())} from {table}"


def line_sql(layout: str, engine: str) -> str:
    """The line expression in the dialect of ``spark`` or ``duckdb``."""
    fmt = {"spark": "format_string('%.6f', ", "duckdb": "printf('%.6f', "}[engine]
    return LINES[layout].replace("fmt6(", fmt).replace("tab,", "chr(9),").replace("soh,", "chr(1),")


def written_lines(spark: SparkSession, sf_dir: str, layout: str) -> str:
    """Write the lines of one layout as text files and return their folder."""
    points = point_view(spark, sf_dir, "customer_points")
    lines = points.selectExpr(f"{line_sql(layout, 'spark')} AS latitude_longitude")
    path = new_path(spark, f"lines-{layout}")
    if layout in HEADED:
        # A partition becomes a file, so its first row brings the heading.
        first = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1) == 0
        line = F.col("latitude_longitude")
        lines = lines.select(F.when(first, F.concat(F.lit("latitude_longitude\n"), line)).otherwise(line).alias("value"))
    lines.write.text(path)
    return path
