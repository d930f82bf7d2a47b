import gzip
from types import SimpleNamespace

import pytest
from helpers import D, column, daily, rows_of, silver_table
from pyspark.sql import functions as F

from rimeframe import fixed_values as fv
from rimeframe import storage
from rimeframe.operators import bronze
from rimeframe.plans import medallion
from rimeframe.plans.reports import reports
from rimeframe.sources import fixed_width, layers, readings


def put(path, text):
    path.write_text(text)
    return str(path)


def test_permissive_csv(spark, tmp_path):
    path = put(tmp_path / "r.csv", "\n".join([
        "A,20200101,TMAX,72,,,W,2400", "A,20200231,TMIN,5,,,W,", "B,20200101,TMIN,abc,,,W,",
        "B,20200102,TMIN,-7,,X,W,", "C,20200103,PRCP,3", ""]))
    raw = readings.read_readings(spark, path, keep_rejects=True).cache()
    assert raw.count() == 5
    assert raw.filter(F.col("value").isNull()).count() == 1
    assert {r[0] for r in raw.select(readings.CORRUPT).collect() if r[0]} == {
        "B,20200101,TMIN,abc,,,W,", "C,20200103,PRCP,3"}
    raw.unpersist()
    kept = bronze.to_bronze(readings.read_readings(spark, path))
    assert column(kept, "id", "value") == [("A", 72), ("B", None), ("C", 3)]
    assert "date_raw" not in kept.columns


def test_year_files_prefer_plain_and_warn(spark, tmp_path):
    put(tmp_path / "2000.csv", "A,20000101,TMAX,1,,,,\n")
    for year in (2000, 2001):
        with gzip.open(tmp_path / f"{year}.csv.gz", "wt") as f:
            f.write(f"A,{year}0101,TMIN,2,,,,\n")
    put(tmp_path / "notes.csv", "x")
    with pytest.warns(UserWarning, match="2002"):
        found = readings.resolve_year_files(spark, str(tmp_path), 2000, 2002)
    assert [p.rsplit("/", 1)[1] for p in found] == ["2000.csv", "2001.csv.gz"]
    read = bronze.to_bronze(readings.read_readings(spark, found))
    assert column(read, "element") == ["TMAX", "TMIN"]
    with pytest.warns(UserWarning), pytest.raises(FileNotFoundError):
        readings.resolve_year_files(spark, str(tmp_path), 1990, 1991)


def test_fixed_width_blanks_and_bad_numbers(spark, tmp_path):
    def line(id, lat, lon, elev, state, name):
        return f"{id:<11} {lat:>8} {lon:>9} {elev:>6} {state:<2} {name:<30} GSN     72503"

    path = put(tmp_path / "stations.txt", "\n".join([
        line("USW00094728", "40.7789", "-73.9692", "42.7", "NY", "NEW YORK CNTRL PK"),
        line("CA000000001", "bad", "", "", "", "NORTH"), "XX000000001"]))
    a, b, c = fixed_width.read_stations(spark, path).orderBy(F.desc("id")).collect()[::-1][:3]
    by_id = {r.id: r for r in (a, b, c)}
    ny = by_id["USW00094728"]
    assert (ny.latitude, ny.longitude, ny.elevation, ny.state) == (40.7789, -73.9692, 42.7, "NY")
    assert (ny.name, ny.gsn_flag, ny.hcn_crn_flag, ny.wmo_id, ny.country_code) == (
        "NEW YORK CNTRL PK", "GSN", None, "72503", "US")
    north = by_id["CA000000001"]
    assert (north.latitude, north.longitude, north.elevation, north.state) == (None,) * 4
    assert by_id["XX000000001"].name is None


def test_missing_climate_file(spark, tmp_path):
    with pytest.warns(UserWarning):
        assert readings.read_climate_index(spark, str(tmp_path / "none.csv")) is None
    path = put(tmp_path / "oni.csv", "year,month,oni_anom\n2020,1,0.6\n")
    assert tuple(readings.read_climate_index(spark, path).first()) == (2020, 1, 0.6)


def test_overwrite_replaces_only_its_years(spark, tmp_path):
    path = str(tmp_path / "t")
    days = silver_table(spark, daily("a", D(2019, 12, 30), [1.0] * 5))
    layers.write_years(days, path, sort_by=("id",))
    assert sorted(map(tuple, layers.partition_rows(spark, path).collect())) == [(2019, 2), (2020, 3)]
    newer = silver_table(spark, daily("b", D(2020, 5, 1), [1.0]))
    layers.write_years(newer, path)
    got = column(layers.read_layer(spark, path), "id")
    assert got == ["a", "a", "b"]
    layers.write_years(newer, path)
    assert layers.read_layer(spark, path).count() == 3


def test_report_of_an_empty_layer(spark):
    empty = silver_table(spark, daily("a", D(2020, 1, 1), [1.0])).limit(0)
    report = layers.layer_report(empty).first()
    assert (report.n_rows, report.n_stations, report.frost_pct) == (0, 0, None)


def test_shared_folder_is_taken_from_the_session():
    def session(master, **settings):
        conf = SimpleNamespace(get=lambda key, default=None: settings.get(key, default))
        context = SimpleNamespace(master=master, applicationId=f"app-{master}")
        return SimpleNamespace(conf=conf, sparkContext=context)

    named = {"spark.checkpoint.dir": "/shared/checkpoints/"}
    assert storage.shared_folder(session("spark://host", **named)) == "/shared/checkpoints"
    with pytest.raises(ValueError):
        storage.shared_folder(session("spark://host"))
    local = session("local[2]")
    assert storage.shared_folder(local) == storage.shared_folder(local)


def test_staging_writes_a_table(spark):
    staged = storage.stage(spark.range(5), "numbers")
    assert staged.count() == 5 and "numbers-" in staged.inputFiles()[0]


def test_layers_end_to_end(spark, tmp_path):
    """Raw text files to gold on disk, twice, and one year rebuilt."""
    landing, meta = tmp_path / "raw", tmp_path / "meta"
    landing.mkdir()
    meta.mkdir()
    for year in (2019, 2020):
        lines = []
        for s in range(3):
            for day in range(1, 29):
                for month in (1, 2, 3):
                    value = (day * 7 + s * 13 + month * 29 + year) % 200 - 90
                    date = f"{year}{month:02d}{day:02d}"
                    lines.append(f"US00000000{s},{date},TMIN,{value},,,W,")
                    lines.append(f"US00000000{s},{date},TMAX,{value + 80},,,W,")
        (landing / f"{year}.csv").write_text("\n".join(lines))
    stations = "\n".join(
        f"US00000000{s}  40.{s}000   -90.0000  100.0 KS STATION {s}" for s in range(3))
    files = {"stations": put(meta / "stations.txt", stations),
             "countries": put(meta / "countries.txt", "US United States\nCA Canada\n"),
             "states": put(meta / "states.txt", "KS KANSAS\n"),
             "inventory": put(meta / "inventory.txt",
                              "US000000000  40.0000   -90.0000 TMIN 2019 2020\n")}
    root = str(tmp_path / "lake")
    assert medallion.build_dimensions(spark, files, root) == {
        "stations": 3, "countries": 2, "states": 1, "inventory": 1}
    ids = layers.read_layer(spark, f"{root}/stations").select("id")
    for _ in range(2):
        assert medallion.build_bronze(
            spark, str(landing), f"{root}/bronze", 2019, 2020, tuple(fv.ELEMENTS), ids) == 1008
        assert medallion.build_silver(
            spark, f"{root}/bronze", f"{root}/stations", f"{root}/silver") == 504
        assert medallion.build_gold(spark, f"{root}/silver", f"{root}/gold") == 504
    full = rows_of(layers.read_layer(spark, f"{root}/gold"))
    assert medallion.build_gold(spark, f"{root}/silver", f"{root}/gold", 2020, 2020) == 252
    gold = layers.read_layer(spark, f"{root}/gold")
    assert rows_of(gold) == full
    assert gold.filter(F.col("name").isNull()).count() == 0
    tables = reports(layers.read_layer(spark, f"{root}/silver"), gold)
    assert tables["gold volumes"].first().n_rows == 504
    assert [r.month for r in tables["frost by month"].collect()] == [1, 2, 3]
    for table in tables.values():
        table.collect()
