import os
import random

import pytest
from helpers import column, rows_of
from pyspark.sql import functions as F

from rimeframe.operators import silver
from rimeframe.sources import versions
from rimeframe.streaming import owned

TIME = [1_600_000_000]


def put(folder, name, *lines):
    """A file of its own time, as rewritten files of equal size need one to be told apart."""
    (folder / name).write_text("".join(x + "\n" for x in lines))
    TIME[0] += 10
    os.utime(folder / name, (TIME[0], TIME[0]))


def line(station, day, value, element="TMIN"):
    return f"{station},{day},{element},{value},,,W,"


@pytest.fixture
def places(tmp_path):
    (tmp_path / "landing").mkdir()
    return tmp_path / "landing", str(tmp_path / "bronze")


def values(spark, target):
    return column(owned.read_owned(spark, target), "date", "value", order=("date", "value"))


def test_a_file_that_lost_a_year_leaves_nothing_of_it(spark, places):
    landing, target = places
    put(landing, "a.csv", line("A", 20191231, 1), line("A", 20200101, 2))
    put(landing, "b.csv", line("B", 20200101, 7))
    assert owned.ingest_changed(spark, str(landing), target) == 1
    assert [v for _, v in values(spark, target)] == [1, 2, 7]
    put(landing, "a.csv", line("A", 20200101, 3))
    put(landing, "c.csv", line("C", 20210101, 9))
    assert owned.ingest_changed(spark, str(landing), target) == 2
    assert [v for _, v in values(spark, target)] == [3, 7, 9]
    old = versions.read_live(spark, target, owned.OWNER, 1)
    assert sorted(r.value for r in old.collect()) == [1, 2, 7]
    assert versions.vacuum(spark, target) == 2
    assert [v for _, v in values(spark, target)] == [3, 7, 9]
    with pytest.raises(Exception):
        versions.read_live(spark, target, owned.OWNER, 1).collect()


def test_unchanged_files_are_not_read(spark, places, monkeypatch):
    landing, target = places
    put(landing, "a.csv", line("A", 20191231, 1))
    put(landing, "b.csv", line("B", 20191231, 2))
    owned.ingest_changed(spark, str(landing), target)
    read = []
    inner = owned.read_readings
    monkeypatch.setattr(owned, "read_readings", lambda s, paths: read.extend(paths) or inner(s, paths))
    assert owned.ingest_changed(spark, str(landing), target) == 1 and read == []
    put(landing, "b.csv", line("B", 20191231, 5))
    assert owned.ingest_changed(spark, str(landing), target) == 2
    assert [x.rsplit("/", 1)[1] for x in read] == ["b.csv"]
    assert [v for _, v in values(spark, target)] == [1, 5]


def test_empty_and_missing_files(spark, places):
    landing, target = places
    put(landing, "a.csv", line("A", 20191231, 1))
    put(landing, "b.csv", line("B", 20191231, 2))
    owned.ingest_changed(spark, str(landing), target)
    put(landing, "a.csv", line("A", "badday", 1))
    assert owned.ingest_changed(spark, str(landing), target) == 2
    assert [v for _, v in values(spark, target)] == [2]
    os.remove(landing / "b.csv")
    put(landing, "c.csv", line("C", 20191231, 3))
    assert owned.ingest_changed(spark, str(landing), target) == 3
    assert [v for _, v in values(spark, target)] == [2, 3]
    assert owned.ingest_changed(spark, str(landing), target, drop_missing=True) == 4
    assert [v for _, v in values(spark, target)] == [3]
    assert owned.ingest_changed(spark, str(landing), target, drop_missing=True) == 4


def test_only_empty_files(spark, places):
    landing, target = places
    put(landing, "a.csv", line("A", "badday", 1))
    assert owned.ingest_changed(spark, str(landing), target) == 1
    assert versions.table(spark, target, owned.SOURCES).count() == 1
    assert values(spark, target) == [] and versions.vacuum(spark, target) == 0


def test_a_crash_before_the_commit_changes_nothing(spark, places, monkeypatch):
    landing, target = places
    put(landing, "a.csv", line("A", 20191231, 1), line("A", 20200101, 2))
    owned.ingest_changed(spark, str(landing), target)
    before = rows_of(owned.read_owned(spark, target))
    put(landing, "a.csv", line("A", 20200101, 3), line("A", 20200102, 4))
    with monkeypatch.context() as broken:
        def fail(*_):
            raise OSError("lost")
        broken.setattr(versions, "commit", fail)
        with pytest.raises(OSError):
            owned.ingest_changed(spark, str(landing), target)
    assert rows_of(owned.read_owned(spark, target)) == before
    owned.ingest_changed(spark, str(landing), target)
    assert [v for _, v in values(spark, target)] == [3, 4]


def test_the_second_of_two_writers_fails(spark, tmp_path):
    rows, path = spark.range(3), str(tmp_path / "layer")
    versions.commit(spark, path, 0, {"t": rows})
    with pytest.raises(RuntimeError):
        versions.commit(spark, path, 0, {"t": rows})
    assert versions.commit(spark, path, 1, {"t": rows.limit(1)}) == 2
    assert versions.table(spark, path, "t").count() == 1
    assert versions.table(spark, path, "t", 1).count() == 3


def test_equal_load_orders_are_parted_by_value(spark):
    rows = [("A", "2020-01-01", "TMIN", v, 5) for v in (127, 200, -3, 9)]
    for seed in range(4):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id STRING, d STRING, element STRING, value INT, load_order BIGINT")
        df = df.withColumn("date", F.to_date("d")).coalesce(1)
        assert silver.widen(df).first().TMIN == 200
        assert silver.widen(df, order_by="load_order").first().TMIN == -3
        stamped = df.withColumn("at", F.lit("2020-01-01").cast("timestamp"))
        assert silver.widen(stamped, "at", latest=True).first().TMIN == 200
