import time

from helpers import column, rows_of

from rimeframe.operators import silver
from rimeframe.plans import medallion
from rimeframe.sources.layers import read_layer
from rimeframe.streaming.ingest import LOAD_ORDER, ingest_landed, loaded_rows


def put(folder, name, *lines):
    (folder / name).write_text("\n".join(lines) + "\n")


def test_ingest_is_incremental_and_idempotent(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()

    def run(checkpoint):
        ingest_landed(spark, str(landing), target, str(tmp_path / checkpoint), ("TMIN", "TMAX"))
        rows = loaded_rows(spark, target).collect()
        return {(r.year, r.source.rsplit("-", 1)[0]): r.n_rows for r in rows}

    put(landing, "2019.csv", "A,20190101,TMIN,10,,,W,", "A,20190101,AWND,5,,,W,",
        "A,20190102,TMIN,11,,Q,W,", "A,badday,TMIN,12,,,W,")
    put(landing, "2020.csv", "A,20200101,TMIN,20,,,W,", "A,20191231,TMAX,90,,,W,")
    first = {(2019, "2019.csv"): 1, (2020, "2020.csv"): 1, (2019, "2020.csv"): 1}
    assert run("c1") == first
    once = rows_of(read_layer(spark, target).drop(LOAD_ORDER))
    assert run("c1") == first
    assert run("c2") == first
    assert rows_of(read_layer(spark, target).drop(LOAD_ORDER)) == once
    put(landing, "2021.csv", "A,20210101,TMIN,30,,,W,")
    assert run("c1") == {**first, (2021, "2021.csv"): 1}
    table = read_layer(spark, target)
    assert column(table, "value", order=("date", "element")) == [10, 90, 20, 30]


def test_a_later_file_corrects_an_earlier_one(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    put(landing, "2019.csv", "A,20190101,TMIN,10,,,W,", "A,20190102,TMIN,11,,,W,")
    ingest_landed(spark, str(landing), target, str(tmp_path / "c"))
    time.sleep(1.1)
    put(landing, "2019-fix.csv", "A,20190101,TMIN,99,,,W,", "B,20190101,TMIN,5,,,W,")
    ingest_landed(spark, str(landing), target, str(tmp_path / "c"))
    wide = silver.widen(read_layer(spark, target))
    assert column(wide, "id", "TMIN") == [("A", 99), ("A", 11), ("B", 5)]


def test_ingest_keeps_listed_stations_only(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    put(landing, "2019.csv", "A,20190101,TMIN,10,,,W,", "B,20190101,TMIN,11,,,W,")
    ids = spark.createDataFrame([("B",), ("B",)], "id STRING")
    ingest_landed(spark, str(landing), target, str(tmp_path / "c"), None, ids)
    assert column(read_layer(spark, target), "id") == ["B"]


def test_files_of_one_name_keep_their_own_rows(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "bronze")
    for folder, station in (("a", "A"), ("b", "B")):
        (landing / folder).mkdir(parents=True)
        put(landing / folder, "2019.csv", f"{station},20190101,TMIN,10,,,W,")
    ingest_landed(
        spark, f"{landing}/*", target, str(tmp_path / "c"), files_per_batch=1)
    assert column(read_layer(spark, target), "id") == ["A", "B"]


def test_two_readings_of_one_file_are_told_apart(spark, tmp_path):
    landing, target = tmp_path / "landing", str(tmp_path / "bronze")
    landing.mkdir()
    put(landing, "2019.csv", *[f"A,20190101,TMIN,{v},,,W," for v in (10, 11, 12, 13)])
    ingest_landed(spark, str(landing), target, str(tmp_path / "c"))
    rows = read_layer(spark, target)
    assert rows.select(LOAD_ORDER).distinct().count() == 4
    chosen = {silver.widen(rows.repartition(n)).first().TMIN for n in (1, 2, 5)}
    assert len(chosen) == 1


def test_batch_ingest_leaves_neighbouring_years_alone(spark, tmp_path):
    raw, target = tmp_path / "raw", str(tmp_path / "bronze")
    raw.mkdir()
    put(raw, "2018.csv", *[f"A,201801{d:02d},TMIN,{d},,,W," for d in range(1, 21)])
    put(raw, "2019.csv", "A,20181231,TMIN,7,,,W,", "A,20190101,TMIN,8,,,W,")
    medallion.build_bronze(spark, str(raw), target, 2018, 2018)
    medallion.build_bronze(spark, str(raw), target, 2019, 2019)
    medallion.build_bronze(spark, str(raw), target, 2019, 2019)
    found = read_layer(spark, target).groupBy("year").count().collect()
    assert {r.year: r["count"] for r in found} == {2018: 21, 2019: 1}
