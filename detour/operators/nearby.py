"""J3 as a table that isn't stored: the edges between stations and the stops within a radius.

The edges grow with the product of both sides. Whoever joins them with columns of a station or a stop, or looks keys up among them,
would shuffle or write all of them; here the two sides are joined, dealt and tested instead, and an edge is made where it is used.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from detour.functions.geo import haversine_m, is_point
from detour.operators.geo_join import radius_join
from detour.operators.sizing import broadcast_if_bounded, row_count_at_most
from detour.operators.upsert import MadeRows, latest_per_key
from detour.session import fresh_path

PLACE = ["lat", "lon"]
MAX_BROADCAST_PLACES = 1_000_000     # rows of a key and two doubles


def same_key(a: DataFrame, b: DataFrame, keys: list[str]) -> Column:
    return reduce(Column.__and__, [a[k].eqNullSafe(b[f"_{k}"]) for k in keys])


def _renamed(df: DataFrame, keys: list[str], *others: str) -> DataFrame:
    return df.select(*[F.col(k).alias(f"_{k}") for k in keys], *others)


@dataclass(frozen=True)
class Nearby(MadeRows):
    """``stations`` (station_id, lat, lon) and ``stops`` (stop_id, lat, lon); the distance of an edge is rounded to ``digits``."""

    stations: DataFrame
    stops: DataFrame
    radius_m: float
    earth_radius_m: float
    digits: int

    keys = ["station_id", "stop_id"]

    @cached_property
    def edges(self) -> DataFrame:
        """(station_id, stop_id, distance_metres): one for each pair of rows within the radius."""
        return self.pairs(self.stations, self.stops)

    def rounded(self, pairs: DataFrame) -> DataFrame:
        return pairs.withColumn("distance_metres", F.round("distance_metres", self.digits))

    def pairs(self, stations: DataFrame, stops: DataFrame, left_carry: list[str] | None = None, carry: list[str] | None = None) -> DataFrame:
        """The edges of these stations and stops, with columns of both."""
        return self.rounded(radius_join(stations, stops, self.radius_m, earth_radius_m=self.earth_radius_m, left_carry=left_carry, carry=carry))

    def _places(self) -> tuple[DataFrame, DataFrame]:
        """(station_id, lat, lon) and (stop_id, lat, lon): rows that agree make the same edges."""
        one = lambda df, k: df.filter(is_point(F.col("lat"), F.col("lon"))).select(k, *PLACE).dropDuplicates([k, *PLACE])
        return one(self.stations, "station_id"), one(self.stops, "stop_id")

    def one_per_key(self) -> DataFrame:
        """A key comes again only where its station or its stop has several places; those alone are looked through."""
        sides = dict(zip(self.keys, self._places()))
        again = {k: s.groupBy(k).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(k) for k, s in sides.items()}
        if all(a.isEmpty() for a in again.values()):
            return self.pairs(*sides.values())
        part = lambda k, how: sides[k].join(r := _renamed(again[k], [k]), same_key(sides[k], r, [k]), how)
        (s1, s2), (t1, t2) = [(part(k, "left_anti"), part(k, "left_semi")) for k in self.keys]
        repeated = self.pairs(s2, sides["stop_id"]).unionByName(self.pairs(s1, t2))
        return self.pairs(s1, t1).unionByName(latest_per_key(repeated, self.keys, ["distance_metres"]))

    def unmatched(self, existing: DataFrame) -> DataFrame:
        """By the places of each row's station and stop; the edges aren't made."""
        stations, stops = self._places()
        stations = broadcast_if_bounded(_renamed(stations, ["station_id"], F.col("lat").alias("_lat"), F.col("lon").alias("_lon")), MAX_BROADCAST_PLACES)
        stops = _renamed(stops, ["stop_id"], *PLACE)
        rows = existing.select(*self.keys)
        d = haversine_m("_lat", "_lon", "lat", "lon", self.earth_radius_m)
        hit = (rows.join(stops, same_key(rows, stops, ["stop_id"])).join(stations, same_key(rows, stations, ["station_id"]))
               .filter(d <= F.lit(float(self.radius_m))))
        path = fresh_path(existing.sparkSession, "unmatched")
        _renamed(hit, self.keys).write.parquet(path)
        hit = existing.sparkSession.read.parquet(path)
        few = row_count_at_most(hit, MAX_BROADCAST_PLACES)
        null = not few and not hit.filter(F.col("_station_id").isNull() | F.col("_stop_id").isNull()).isEmpty()
        # Without null keys plain equality does, for which rows that are dealt by their key stay where they are.
        same = same_key(existing, hit, self.keys) if few or null else reduce(Column.__and__, [existing[k] == hit[f"_{k}"] for k in self.keys])
        return existing.join(F.broadcast(hit) if few else hit, same, "left_anti")
