"""Small builders shared by the tests."""

from datetime import date, timedelta

from pyspark.sql import functions as F

SILVER_SCHEMA = """id STRING, date DATE, year INT, month INT, day_of_year INT, tmax_c DOUBLE,
    tmin_c DOUBLE, tavg_c DOUBLE, temp_range_c DOUBLE, prcp_mm DOUBLE, snow_mm DOUBLE,
    snwd_mm DOUBLE, is_frost_day BOOLEAN, is_heat_stress_day BOOLEAN, name STRING,
    latitude DOUBLE, longitude DOUBLE, elevation_m DOUBLE, state STRING, country_code STRING"""


def silver_row(id, day, tmin=None, tmax=None, prcp=None, lat=None, lon=None, elevation=None):
    known = tmin is not None and tmax is not None
    return (
        id, day, day.year, day.month, day.timetuple().tm_yday, tmax, tmin,
        (tmin + tmax) / 2.0 if known else None, tmax - tmin if known else None, prcp, None, None,
        None if tmin is None else tmin <= 0, None if tmax is None else tmax >= 30, id,
        lat, lon, elevation, "KS", "US",
    )


def silver_table(spark, rows):
    return spark.createDataFrame(rows, SILVER_SCHEMA)


def daily(id, start, values, **more):
    """Consecutive days from ``start`` with the given minima (maximum five degrees above)."""
    return [
        silver_row(id, start + timedelta(days=i), v, None if v is None else v + 5.0, **more)
        for i, v in enumerate(values)
    ]


def column(df, *names, order=("id", "date")):
    rows = df.orderBy(*[F.col(c) for c in order]).select(*names).collect()
    return [row[0] if len(names) == 1 else tuple(row) for row in rows]


def rows_of(df):
    """Order-free content with rounded numbers, columns sorted by name."""
    names = sorted(df.columns)
    return sorted(
        repr(tuple(round(v, 6) + 0.0 if isinstance(v, float) else v for v in row))
        for row in df.select(*names).collect()
    )


D = date
