"""Readings against the inventory of station elements, and sketches kept per year."""

from __future__ import annotations

from pyspark.sql import functions as F

from rimeframe.catalog import adapters as data
from rimeframe.catalog.registry import query
from rimeframe.catalog.sql import oracle
from rimeframe.operators import inventory, sketches
from rimeframe.storage import fresh_path

_INVENTORY = """
    select id, element, first_year, last_year from (
      select id, element, min(year(date)) as a, max(year(date)) as b, cast(substr(id, 2) as int) % 3 as k
      from readings group by id, element),
      (values (0, 1), (0, 2), (1, 1), (2, 1), (2, 2)) v(of, part),
      lateral (select
        case when k = 0 and part = 1 then a when k = 0 then b - 2 when k = 1 then a + 1 when part = 1 then null
          else a end as first_year,
        case when k = 0 and part = 1 then b - 1 when k = 0 then null when k = 1 then b - 1
          when part = 1 then a + 2 else a end as last_year)
    where of = k"""


def listed(spark, folder):
    """Intervals that overlap, have open ends or leave out years, by the number of the station."""
    k = F.substring("id", 2, 9).cast("int") % 3
    a, b, none = F.col("a"), F.col("b"), F.lit(None).cast("int")

    def interval(first, last):
        return F.struct(first.alias("first_year"), last.alias("last_year"))

    coverage = data.readings(spark, folder).groupBy("id", "element").agg(
        F.min(F.year("date")).alias("a"), F.max(F.year("date")).alias("b"))
    intervals = (
        F.when(k == 0, F.array(interval(a, b - 1), interval(b - 2, none)))
        .when(k == 1, F.array(interval(a + 1, b - 1)))
        .otherwise(F.array(interval(none, a + 2), interval(a, a)))
    )
    return coverage.select("id", "element", F.inline(intervals))


_LISTED = f"""
    select r.id, cast(r.date as varchar) as date, r.element, cast(own is not null as int) as is_listed,
      nullif(own[1], -9999) as listed_from, nullif(own[2], 9999) as listed_to
    from (
      select r.id, r.date, r.element, max(case when i.id is not null then [i.b, i.e] end) as own
      from bronze r left join (
        select id, element, coalesce(first_year, -9999) as b, coalesce(last_year, 9999) as e from ({_INVENTORY})
      ) i on i.id = r.id and i.element = r.element and r.year between i.b and i.e
      group by all) r"""


@query("j2_inventory_listing", oracle(_LISTED, "bronze"))
def j2_listing(spark, folder):
    """Each reading with the interval of the inventory that lists it, the one that began last."""
    days = data.bronze_readings(spark, folder)
    found = inventory.with_listing(days, listed(spark, folder))
    return found.select("id", "date", "element", "is_listed", "listed_from", "listed_to")


@query("s6_unlisted_readings", oracle(
    f"select element, count(*) as n, count(*) filter (where is_listed = 0) as n_unlisted from ({_LISTED}) "
    "group by element", "bronze"))
def s6_unlisted(spark, folder):
    return inventory.unlisted_readings(data.bronze_readings(spark, folder), listed(spark, folder))


SHARES = (0.05, 0.25, 0.5, 0.75, 0.95)


def merged_sketches(spark, folder):
    path = fresh_path(spark, "sketches")
    sketches.write_sketches(data.silver_days(spark, folder), path)
    return sketches.estimates(sketches.merged(sketches.read_sketches(spark, path)), SHARES)


@query("a4_sketched_stations", oracle(
    "select count(*) as n, count(distinct id) as n_stations, 1 as is_near from silver", "silver"))
def a4_sketched(spark, folder):
    """Stations counted from the years' sketches, held against the exact number."""
    days = data.silver_days(spark, folder)
    exact = days.agg(F.countDistinct("id").alias("exact"))
    near = F.abs(F.col("n_stations") - F.col("exact")) <= F.greatest(F.lit(1.0), 0.03 * F.col("exact"))
    both = merged_sketches(spark, folder).select("n", "n_stations").join(exact)
    return both.select("n", F.col("exact").alias("n_stations"), near.alias("is_near"))


@query("a7_sketched_quantiles", oracle(" union all ".join(
    f"select '{m}' as column_name, {s}::double as share, count({m}) as n, 1 as is_near from silver"
    for m in sketches.MEASURES for s in SHARES), "silver"))
def a7_sketched(spark, folder):
    """Quantiles from the years' sketches, whose exact ranks are looked up in the table."""
    days = data.silver_days(spark, folder)
    found = merged_sketches(spark, folder)
    guesses = F.array(*[
        F.struct(F.lit(m).alias("column_name"), F.lit(s).alias("share"), F.col(f"{m}_n").alias("n"),
                 F.col(f"{m}_quantiles")[i].alias("value"))
        for m in sketches.MEASURES for i, s in enumerate(SHARES)
    ])
    long = found.select(F.inline(guesses))  # a row for each measure and share
    exact = days.select(F.explode(F.array(*[
        F.struct(F.lit(m).alias("of"), F.col(m).alias("x")) for m in sketches.MEASURES])).alias("e")).select("e.*")
    ranks = exact.filter("x is not null").join(F.broadcast(long), F.col("of") == F.col("column_name")).groupBy(
        "column_name", "share", "n").agg(
        F.avg((F.col("x") <= F.col("value")).cast("double")).alias("upto"),
        F.avg((F.col("x") < F.col("value")).cast("double")).alias("below"))
    error = sketches.RANK_ERROR
    near = (F.col("upto") >= F.col("share") - error) & (F.col("below") <= F.col("share") + error)
    return ranks.select("column_name", "share", "n", near.alias("is_near"))
