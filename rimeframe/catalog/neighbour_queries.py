"""The nearest stations and what they report."""

from __future__ import annotations

from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import day, oracle, r6
from rimeframe.functions.space import EARTH_RADIUS_KM
from rimeframe.operators import neighbours
from rimeframe.storage import stage

K = 5

NEAREST = f"""
    select id, neighbour, km, row_number() over (partition by id order by km, neighbour) as rank
    from (
      select a.id, b.id as neighbour, round({2 * EARTH_RADIUS_KM}::double * asin(least(1.0::double, sqrt(
        pow(sin(radians(b.latitude - a.latitude) / 2), 2) + cos(radians(a.latitude))
        * cos(radians(b.latitude)) * pow(sin(radians(b.longitude - a.longitude) / 2), 2)))), 6) as km
      from stations a join stations b on a.id <> b.id
      where a.latitude is not null and b.latitude is not null)
    qualify rank <= {K}"""

MEANS = """
    select n.id, s.date, sum(s.tmin_c * w) / sum(w) as near_mean, count(*) as near_n, min(km) as near_km
    from (select *, 1.0::double / pow(greatest(km, 1.0::double), 2) as w from nearest) n
    join silver s on s.id = n.neighbour where s.tmin_c is not null group by 1, 2"""


@query("j4_nearest_stations", oracle(
    f"select id, neighbour, rank, {r6('km')} from ({NEAREST})", "stations"))
def nearest(spark, folder):
    return neighbours.nearest_stations(data.stations(spark, folder), K)


@query("j4_nearest_day_means", oracle(
    f"select s.id, {day('s.date')}, " + r6("near_mean") + ", coalesce(near_n, 0) as near_n, "
    + r6("near_km") + ", " + r6("tmin_c - near_mean", "tmin_c_minus_near")
    + f""" from silver s left join (
      with nearest as ({NEAREST}) {MEANS}) m on m.id = s.id and m.date = s.date""", "silver"))
def day_means(spark, folder):
    """Means of the nearest stations' minima, weighted by inverse squared distance."""
    days = stage(data.silver_days(spark, folder).select("id", "date", "tmin_c"), "days")
    return neighbours.with_neighbours(days, data.stations(spark, folder), K).select(
        "id", "date", "near_mean", "near_n", "near_km", "tmin_c_minus_near")
