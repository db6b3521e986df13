"""Per-line alternatives from the nearest path rows.

One row per known line: the distinct affected station names, the distinct route
names, the first ``nearby_limit`` path rows as nested structs, and the gridlock
flag. With a path cap everything is computed from the capped rows, before any
distinct (D1).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from detour.operators.paths import PATH_COLUMNS, row_order
from detour.operators.sizing import MAX_BROADCAST_ROWS, row_count_at_most
from detour.params import DEFAULT, Params


def _distinct_keep_null(col: str) -> tuple[Column, Column]:
    """``collect_set`` drops nulls, but a null name is one element of a Python set."""
    return F.collect_set(col), F.max(F.col(col).isNull().cast("int"))


def _with_null(arr: Column, has_null: Column) -> Column:
    return F.sort_array(F.when(has_null == 1, F.concat(arr, F.array(F.lit(None).cast("string"))))
                        .otherwise(arr))


def line_options(nearest: DataFrame, lines: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """``nearest``: path rows of :func:`nearest_paths` (capped or not); ``lines``:
    (line_id, name).

    Aggregates are partial (map-side): sets are bounded by the distinct names of a
    line, the nested list by ``nearby_limit`` rows.
    """
    st_set, st_null = _distinct_keep_null("station_name")
    rt_set, rt_null = _distinct_keep_null("route_name")
    sets = [F.count(F.lit(1)).alias("n_path_rows"),
            st_set.alias("_st"), st_null.alias("_stn"), rt_set.alias("_rt"), rt_null.alias("_rtn")]
    nested = F.struct("rn", *PATH_COLUMNS)
    if "rn" in nearest.columns:
        # Capped rows carry their rank: one aggregate, the nested list keeps rn <= limit.
        per_line = nearest.groupBy("line_id").agg(
            *sets, F.sort_array(F.collect_list(F.when(F.col("rn") <= p.nearby_limit, nested))).alias("_near"))
    else:
        # Uncapped rows: rank only the nested top-N (a partial WindowGroupLimit), never
        # a whole line.
        w = Window.partitionBy("line_id").orderBy(*row_order())
        ranked = (nearest.withColumn("rn", F.row_number().over(w))
                  .filter(F.col("rn") <= p.nearby_limit))
        nested_rows = ranked.groupBy("line_id").agg(F.sort_array(F.collect_list(nested)).alias("_near"))
        per_line = nearest.groupBy("line_id").agg(*sets).join(nested_rows, "line_id", "left")
    per_line = per_line.select(
        "line_id", "n_path_rows",
        _with_null(F.col("_st"), F.col("_stn")).alias("affected_stations"),
        _with_null(F.col("_rt"), F.col("_rtn")).alias("available_routes"),
        F.transform(F.col("_near"),
                    lambda x: F.struct(*[x[c].alias(c) for c in PATH_COLUMNS])).alias("nearby_bus_stops"),
    )
    empty_s = F.array().cast("array<string>")
    out = lines.select("line_id", F.col("name").alias("graph_line_name")).join(per_line, "line_id", "left")
    return out.select(
        "line_id", "graph_line_name",
        F.coalesce("n_path_rows", F.lit(0)).alias("n_path_rows"),
        F.coalesce("affected_stations", empty_s).alias("affected_stations"),
        F.coalesce("available_routes", empty_s).alias("available_routes"),
        F.coalesce("nearby_bus_stops", F.array()).alias("nearby_bus_stops"),
    ).withColumn("n_stations", F.size("affected_stations")) \
     .withColumn("n_routes", F.size("available_routes")) \
     .withColumn("gridlock_alert", is_gridlock(F.col("n_routes"), p)) \
     .withColumn("display_routes", F.slice("available_routes", 1, p.display_routes))


def is_gridlock(n_routes: Column, p: Params = DEFAULT) -> Column:
    """A4: too few distinct alternative routes."""
    return n_routes < F.lit(p.min_routes)


def bounded_options(options: DataFrame, lines: DataFrame, p: Params = DEFAULT,
                    max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Mark ``options`` for broadcast when the line table proves it small.

    ``options`` has exactly one row per line, and with a path cap every row is
    bounded (at most ``path_limit`` names per list, ``nearby_limit`` nested rows),
    so its size is at most the number of lines times a constant. The count runs on
    the ``lines`` dimension table, not on the options plan. Without a cap, or beyond
    ``max_rows`` lines, the planner decides (a measured broadcast or a shuffle join).
    """
    if p.path_limit is None or not row_count_at_most(lines, max_rows):
        return options
    return F.broadcast(options)
