"""P12 by key: a clustered layout of the graph, in which the paths of one line are found without reading the tables.

Each table is dealt into ranges of the column by which it is looked up and sorted by it, so the minima and maxima of files, row
groups and pages leave out what can't hold a key; a Parquet Bloom filter of the column settles the row groups that could.
A lookup goes hop by hop: the line's stations, then their stops, each as a bounded list of keys that reaches the next scan as a
filter. A hop with more than ``MAX_KEYS`` keys is a join instead. The result is that of ``nearest_paths`` on the restricted graph.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.operators.graph import Graph
from detour.operators.paths import nearest_paths, restrict_line
from detour.params import DEFAULT, Params

CLUSTERED_BY = {"lines": "line_id", "stations": "station_id", "bus_stops": "stop_id", "bus_routes": "route_id",
                "serves": "line_id", "has_nearby_stop": "station_id", "served_by": "stop_id"}
MAX_KEYS = 256
ROW_GROUP_BYTES = 16 << 20   # small row groups: a lookup reads one of them for a key


def write_clustered_table(table: DataFrame, key: str, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    """``table`` sorted by ``key`` within ranges of it. A hot key's rows are split over ranges by all other columns."""
    others = [c for c in table.columns if c != key]
    (table.repartitionByRange(key, *others).sortWithinPartitions(key).write
          .option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.block.size", str(row_group_bytes)).parquet(path))


def write_clustered(g: Graph, path: str, row_group_bytes: int = ROW_GROUP_BYTES) -> None:
    for name, table in g.tables().items():
        write_clustered_table(table, CLUSTERED_BY[name], f"{path.rstrip('/')}/{name}", row_group_bytes)


def read_clustered(spark: SparkSession, path: str) -> Graph:
    return Graph(**{name: spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in CLUSTERED_BY})


def _any_of(column: str, keys: list) -> Column:
    """``column`` is one of ``keys``, as equalities: the scan asks for each by itself, not for the range they span."""
    terms = [F.col(column) == F.lit(k) for k in keys] or [F.lit(False)]
    while len(terms) > 1:
        terms = [terms[i] | terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def restrict_to(table: DataFrame, key: str, wanted: DataFrame, max_keys: int = MAX_KEYS) -> DataFrame:
    """The rows of ``table`` whose ``key`` occurs in ``wanted``."""
    found = [r[0] for r in wanted.select(key).filter(F.col(key).isNotNull()).distinct().limit(max_keys + 1).collect()]
    if len(found) > max_keys:
        return table.join(wanted.select(key).distinct(), key, "left_semi")
    return table.filter(_any_of(key, found))


def lookup_graph(g: Graph, line_id, max_keys: int = MAX_KEYS) -> Graph:
    """``g`` as seen from one line, every scan filtered by the keys that the line reaches."""
    g = restrict_line(g, line_id)
    near = restrict_to(g.has_nearby_stop, "station_id", g.serves, max_keys)
    return replace(g, stations=restrict_to(g.stations, "station_id", g.serves, max_keys), has_nearby_stop=near,
                   bus_stops=restrict_to(g.bus_stops, "stop_id", near, max_keys), served_by=restrict_to(g.served_by, "stop_id", near, max_keys))


def lookup_paths(spark: SparkSession, path: str, line_id, p: Params = DEFAULT, max_keys: int = MAX_KEYS) -> DataFrame:
    """The nearest path rows of ``line_id`` from the clustered tables at ``path``."""
    return nearest_paths(lookup_graph(read_clustered(spark, path), line_id, max_keys), p.path_limit)
