import random
import shutil
from datetime import date, timedelta

import pytest
from helpers import rows_of, silver_row, silver_table
from pyspark.sql import functions as F

from rimeframe.operators import gold
from rimeframe.sources import versions
from rimeframe.sources.layers import write_years
from rimeframe.streaming import refresh

SPOTS = {"a": (40.1, -90.2), "b": (40.7, -90.9), "c": (41.5, -90.5), "d": (None, None), "e": (41.2, -90.1)}


def history(years=(2018, 2019, 2020, 2021), per_year=14, seed=3):
    """Gappy series: frames reach over several years; e has too short a history."""
    rng, rows = random.Random(seed), {}
    for id, (lat, lon) in SPOTS.items():
        for year in years:
            for k in range(per_year if id != "e" else 7):
                day = date(year, 1, 1) + timedelta(days=k * 25 + rng.randrange(20))
                tmin = None if rng.random() < 0.1 else round(rng.uniform(-9, 9), 1)
                rows[id, day] = silver_row(id, day, tmin, None if tmin is None else tmin + 6, rng.random(),
                                           lat=lat, lon=lon)
    return rows


class Lake:
    def __init__(self, spark, folder):
        self.spark, self.silver, self.gold = spark, f"{folder}/silver", f"{folder}/gold"
        self.rows = history()

    def put(self, years):
        rows = [r for (_, day), r in self.rows.items() if day.year in years]
        if rows:
            write_years(silver_table(self.spark, rows), self.silver)
        self.spark.catalog.refreshByPath(self.silver)

    def change(self, id, day, tmin=0.0, **more):
        lat, lon = SPOTS[id]
        self.rows[id, day] = silver_row(id, day, tmin, tmin + 6, **{"lat": lat, "lon": lon, **more})
        self.put({day.year})

    def refresh(self, **options):
        return refresh.refresh_gold(self.spark, self.silver, self.gold, **options)

    def check(self, index=None):
        built = gold.to_gold(silver_table(self.spark, list(self.rows.values())), index)
        kept = refresh.read_gold(self.spark, self.gold)
        assert set(kept.columns) == set(built.columns)
        assert rows_of(kept.select(*built.columns)) == rows_of(built)


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The silver rows, and gold built from them once."""
    folder = tmp_path_factory.mktemp("lake")
    lake = Lake(spark, folder)
    lake.put({day.year for _, day in lake.rows})
    assert lake.refresh().version == 1
    lake.check()
    return folder


@pytest.fixture
def lake(spark, built, tmp_path):
    """A copy of both layers; files keep their times."""
    shutil.copytree(built, tmp_path / "lake")
    return Lake(spark, tmp_path / "lake")


def days_of(lake, id, year):
    return sorted(day for (i, day) in lake.rows if i == id and day.year == year)


def test_nothing_to_do(lake):
    again = lake.refresh()
    assert (again.version, again.years, again.station_years) == (2, [], 0)
    lake.check()


def test_one_reading_changes_what_depends_on_it(lake):
    """b shares the cell of a; later years of a reach back 29 rows; other stations stay."""
    lake.change("a", days_of(lake, "a", 2018)[3], tmin=-20.0)
    done = lake.refresh()
    lake.check()
    assert done.years == [2018, 2019, 2020, 2021] and done.station_years == 5


def test_last_and_first_rows_of_a_year(lake):
    """A first row is the label of the row before, in the year before."""
    lake.change("c", days_of(lake, "c", 2021)[0], tmin=-30.0)
    done = lake.refresh()
    lake.check()
    assert done.years == [2020, 2021]
    lake.change("c", days_of(lake, "c", 2018)[-1], tmin=-30.0)
    lake.refresh()
    lake.check()


def test_rain_alone_leaves_the_cell_alone(lake):
    day = days_of(lake, "a", 2021)[5]
    old = lake.rows["a", day]
    lake.rows["a", day] = (*old[:9], 99.0, *old[10:])
    lake.put({2021})
    done = lake.refresh()
    lake.check()
    assert done.station_years == 2 and done.years == [2020, 2021]


def test_removed_years_rows_and_stations(lake, spark):
    for key in [k for k in lake.rows if k[0] == "b" or (k[0] == "a" and k[1].year == 2019)]:
        del lake.rows[key]
    lake.put({2018, 2019, 2020, 2021})
    lake.refresh()
    lake.check()
    for key in [k for k in lake.rows if k[1].year == 2021]:
        del lake.rows[key]
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{lake.silver}/year=2021")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    spark.catalog.refreshByPath(lake.silver)
    lake.refresh()
    lake.check()
    assert 2021 not in {r.year for r in refresh.read_gold(spark, lake.gold).select("year").collect()}
    versions.vacuum(spark, lake.gold)
    lake.check()


def test_minimum_history_turns(lake):
    """e gets its thirtieth day, which puts all of e into gold and into its cell's statistics; then loses it."""
    extra = [date(2020, 12, 28), date(2020, 12, 30)]
    for day in extra:
        lake.change("e", day, tmin=-1.0)
    done = lake.refresh()
    lake.check()
    assert done.years == [2018, 2019, 2020, 2021]
    del lake.rows["e", extra[0]]
    lake.put({2020})
    lake.refresh()
    lake.check()


def test_a_station_moves_and_a_year_is_new(lake):
    for key in [k for k in lake.rows if k[0] == "c" and k[1].year >= 2020]:
        old = lake.rows[key]
        lake.rows[key] = (*old[:15], 40.5, -90.5, *old[17:])
    lake.rows |= {k: r for k, r in history((2022,), seed=9).items()}
    lake.put({2020, 2021, 2022})
    lake.refresh()
    lake.check()


def test_null_and_value_change_places(lake):
    """A digest tells (null, 5) from (5, null)."""
    day = days_of(lake, "d", 2021)[2]
    lake.rows["d", day] = silver_row("d", day, None, None, 5.0)
    lake.put({2021})
    lake.refresh()
    old = lake.rows["d", day]
    lake.rows["d", day] = (*old[:9], None, 5.0, *old[11:])
    lake.put({2021})
    assert lake.refresh().station_years > 0
    lake.check()


def test_climate_index_changes(lake, spark):
    def index(value):
        return spark.createDataFrame([(2019, 1, 0.1), (2020, 2, value)], "year INT, month INT, oni_anom DOUBLE")

    assert lake.refresh(climate_index=index(0.9)).version == 2
    lake.check(index(0.9))
    done = lake.refresh(climate_index=index(-0.9))
    assert done.years == [2020]
    lake.check(index(-0.9))
    assert lake.refresh().years == [2018, 2019, 2020, 2021]
    lake.check()


def test_unchanged_years_are_not_read(lake, spark, monkeypatch):
    """Digests of years with the same files are taken over."""
    lake.change("d", days_of(lake, "d", 2018)[0], tmin=-4.0)
    seen = []
    inner = refresh.station_year_digests
    monkeypatch.setattr(refresh, "station_year_digests", lambda df: seen.append(
        {r.year for r in df.select("year").distinct().collect()}) or inner(df))
    lake.refresh()
    assert seen == [{2018}]
    lake.check()


def test_random_edits(lake):
    rng = random.Random(1)
    for _ in range(2):
        for _ in range(3):
            key = rng.choice(sorted(lake.rows))
            if rng.random() < 0.4:
                del lake.rows[key]
                lake.put({key[1].year})
            else:
                lake.change(key[0], key[1], tmin=round(rng.uniform(-9, 9), 1))
        lake.refresh()
        lake.check()


def test_within_reach(spark):
    rows = [("a", 2000 + i, n, i == 3) for i, n in enumerate([5, 20, 8, 1, 28, 0, 1, 7])]
    years = spark.createDataFrame(rows, "id STRING, year INT, n_days BIGINT, hit BOOLEAN")
    found = {r.year for r in refresh.within_reach(years, "hit", 1, 29).collect()}
    assert found == {2002, 2003, 2004, 2005, 2006}
    found = {r.year for r in refresh.within_reach(years, "hit", 28, 1).collect()}
    assert found == {2001, 2002, 2003, 2004}
    assert refresh.within_reach(years.filter(F.lit(False)), "hit", 1, 1).count() == 0


def test_gold_is_written_where_its_rows_lie(spark, tmp_path, monkeypatch):
    """Neither the first build nor a later one moves whole gold rows to other tasks before writing them."""
    plans = []

    def spied(rows, path, by=("year",), sort_by=(), in_place=False):
        plans.append(in_place)
        write_years(rows, path, by=by, sort_by=sort_by, in_place=in_place)

    monkeypatch.setattr(refresh, "write_years", spied)
    lake = Lake(spark, tmp_path)
    lake.put({2018, 2019, 2020, 2021})
    lake.refresh()
    lake.change("a", date(2020, 3, 3), tmin=-2.5)
    lake.refresh()
    assert plans == [True, True]
    lake.check()


def test_rows_in_place_give_a_file_for_each_task_and_year(spark, tmp_path):
    rows = spark.range(0, 40, 1, 4).selectExpr("id", "cast(2000 + id % 2 as int) as year").repartition(4, "id")
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # as many tasks as asked for
    try:
        write_years(rows, f"{tmp_path}/kept", sort_by=("id",), in_place=True)
        tasks = rows.selectExpr("spark_partition_id() as task", "year").distinct().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert len(list(tmp_path.glob("kept/year=*/*.parquet"))) == len(tasks)
    assert rows_of(spark.read.parquet(f"{tmp_path}/kept").select("id", "year")) == rows_of(rows)
