"""Every (station, stop) pair within a radius, with its distance.

A grid-cell equi-join instead of a cross product: points are keyed by a latitude band at
least ``radius`` high and a longitude cell of that band at least ``radius`` wide, the
query side is replicated into the 3 x 3 neighbourhood, the two sides are joined on the
cell key (a shuffle on the key, or a broadcast of a side of counted size) and the exact
haversine distance filters the candidates. Every true pair shares a neighbouring cell, so
the result equals the brute-force one. The number of cells follows each band's own
latitude, so points near a pole don't widen the cells of others. Rows without a valid
place (null, NaN, latitude beyond 90 degrees) pair with nothing.

Few bytes of points can make many pairs, so tasks are dealt by candidates, which are counted by cell first: beyond
``task_candidates`` both sides are shuffled into as many tasks as that takes, and a cell of more is dealt in slices of its
stops, each with all of the cell's stations. Stops that agree in key, place and plain carried columns share a slice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from detour.functions.geo import EARTH_RADIUS_M, haversine_m, is_point, lat_band, lat_step, lon_cell, lon_cells, maybe_within
from detour.operators.sizing import broadcast_if_bounded, row_count_at_most
from detour.session import fresh_path

TASK_CANDIDATES = 4_000_000
MAX_TASKS = 10_000
SLICES = 2              # a task takes about so many slices: tasks even out
SLICE_STOPS = 4_000     # and a slice holds at most about so many stops, which a join keeps at hand

CELL = ["_ci", "_cj"]


def _cells_around(lat: Column, lon: Column, points: DataFrame, dlat: float, radius_m: float, earth_radius_m: float) -> DataFrame:
    """``points`` once for each cell of their 3 x 3 neighbourhood."""
    offsets = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    return (points.withColumn("_ci", F.explode(F.transform(offsets, lambda d: lat_band(lat, dlat) + d)))
            .withColumn("_n", lon_cells(F.col("_ci"), dlat, radius_m, earth_radius_m))
            .withColumn("_cj", F.explode(F.array_distinct(F.transform(offsets, lambda d: F.pmod(lon_cell(lon, F.col("_n")) + d, F.col("_n"))))))
            .drop("_n"))


def _cell_of(lat: Column, lon: Column, points: DataFrame, dlat: float, radius_m: float, earth_radius_m: float) -> DataFrame:
    return (points.withColumn("_ci", lat_band(lat, dlat))
            .withColumn("_cj", lon_cell(lon, lon_cells(F.col("_ci"), dlat, radius_m, earth_radius_m))))


def _candidates(around: DataFrame, placed: DataFrame) -> DataFrame:
    """(_ci, _cj, _nl, _nr) of the cells with points of both sides: partial counts, a row for each cell of a task."""
    one = lambda df, n: df.groupBy(*CELL).agg(F.count(F.lit(1)).alias(n))
    return one(around, "_nl").join(one(placed, "_nr"), CELL)


def _total(cells: DataFrame) -> int:
    return int(cells.agg(F.coalesce(F.sum(F.col("_nl").cast("double") * F.col("_nr")), F.lit(0.0))).first()[0])


def candidate_count(left: DataFrame, right: DataFrame, radius_m: float, earth_radius_m: float = EARTH_RADIUS_M) -> int:
    """How many pairs :func:`radius_join` would test."""
    dlat, lat, lon = lat_step(radius_m, earth_radius_m), F.col("lat"), F.col("lon")
    L, R = (df.filter(is_point(lat, lon)).select("lat", "lon") for df in (left, right))
    return _total(_candidates(_cells_around(lat, lon, L, dlat, radius_m, earth_radius_m), _cell_of(lat, lon, R, dlat, radius_m, earth_radius_m)))


def _plain(df: DataFrame, columns: list[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, AtomicType)]


def _sliced(L: DataFrame, R: DataFrame, cells: DataFrame, total: int, task_candidates: int, carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides dealt into tasks by cell and ``_slice``."""
    most = max(task_candidates // SLICES, 1)
    slices = F.greatest(F.ceil(F.col("_nl").cast("double") * F.col("_nr") / F.lit(float(most))), F.ceil(F.col("_nr") / F.lit(SLICE_STOPS))).cast("long")
    cut = broadcast_if_bounded(cells.select(*CELL, F.least(slices, F.col("_nr")).alias("_slices")).filter(F.col("_slices") > 1))
    n = F.coalesce(F.col("_slices"), F.lit(1).cast("long"))
    L = L.join(cut, CELL, "left").withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("long"), n - 1))).drop("_slices")
    R = R.join(cut, CELL, "left").withColumn("_slice", F.pmod(F.xxhash64("_rk", "_rlat", "_rlon", *_plain(R, carry)), n)).drop("_slices")
    # A fixed number, and not below the session's own: else the planner deals anew, by bytes, into few.
    tasks = max(min(-(-total // task_candidates), MAX_TASKS), int(L.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return L.repartition(tasks, *CELL, "_slice"), R.repartition(tasks, *CELL, "_slice")


def celled(left: DataFrame, right: DataFrame, radius_m: float, left_key: str, right_key: str, earth_radius_m: float,
           left_carry: list[str], carry: list[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with their cells: partners share a ``CELL``, in which the left side stands once for each neighbourhood it is in."""
    dlat = lat_step(radius_m, earth_radius_m)
    cos = lambda c: F.cos(F.radians(c))
    L = left.filter(is_point(F.col("lat"), F.col("lon"))).select(
        F.col(left_key).alias("_lk"), F.col("lat").alias("_llat"), F.col("lon").alias("_llon"), cos("lat").alias("_lcos"), *left_carry)
    R = right.filter(is_point(F.col("lat"), F.col("lon"))).select(
        F.col(right_key).alias("_rk"), F.col("lat").alias("_rlat"), F.col("lon").alias("_rlon"), cos("lat").alias("_rcos"), *carry)
    return (_cells_around(F.col("_llat"), F.col("_llon"), L, dlat, radius_m, earth_radius_m),
            _cell_of(F.col("_rlat"), F.col("_rlon"), R, dlat, radius_m, earth_radius_m))


def matched(candidates: DataFrame, radius_m: float, left_key: str, right_key: str, earth_radius_m: float, out: str, carry: list[str]) -> DataFrame:
    """The pairs of joined :func:`celled` sides that lie within the radius."""
    d = haversine_m(F.col("_llat"), F.col("_llon"), F.col("_rlat"), F.col("_rlon"), earth_radius_m)
    near = maybe_within(F.col("_llat"), F.col("_lcos"), F.col("_llon"), F.col("_rlat"), F.col("_rcos"), F.col("_rlon"), radius_m, earth_radius_m)
    return (candidates.filter(near & (d <= F.lit(float(radius_m))))
            .select(F.col("_lk").alias(left_key), F.col("_rk").alias(right_key), d.alias(out), *carry))


def radius_join(left: DataFrame, right: DataFrame, radius_m: float,
                left_key: str = "station_id", right_key: str = "stop_id",
                earth_radius_m: float = EARTH_RADIUS_M, out: str = "distance_metres",
                max_broadcast_points: int = 100_000, carry: list[str] | None = None,
                task_candidates: int = TASK_CANDIDATES, left_carry: list[str] | None = None) -> DataFrame:
    """Pairs (left_key, right_key, distance) with distance <= radius_m, and the columns
    ``left_carry`` of the left side and ``carry`` of the right side.

    Both inputs need ``lat`` and ``lon`` in degrees. ``left`` is the side that is
    replicated nine times, so pass the smaller one there. Up to ``max_broadcast_points``
    left points the replicated side is broadcast, if one task's candidates are not exceeded.
    """
    carry, left_carry = carry or [], left_carry or []
    L, R = celled(left, right, radius_m, left_key, right_key, earth_radius_m, left_carry, carry)

    n_left, on = left.limit(max_broadcast_points + 1).count(), CELL
    joined = F.broadcast(L) if n_left <= max_broadcast_points else L.hint("merge")
    if n_left and not row_count_at_most(right, task_candidates // n_left):   # fewer pairs at all need no count by cell
        path = fresh_path(left.sparkSession, "radius_cells")
        _candidates(L, R).write.parquet(path)
        cells = left.sparkSession.read.parquet(path)
        total = _total(cells)
        if total > task_candidates:
            L, R = _sliced(L, R, cells, total, task_candidates, carry)
            joined, on = L.hint("merge"), [*CELL, "_slice"]
    return matched(joined.join(R, on), radius_m, left_key, right_key, earth_radius_m, out, [*left_carry, *carry])
