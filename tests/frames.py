"""Small hand-made inputs."""

from datetime import date

SNAPSHOT = "release_id int, series_id string, date date, vintage_date date, value double"


def day(text):
    return date.fromisoformat(text)


V1, V2, V3 = day("2024-02-01"), day("2024-02-08"), day("2024-02-15")
D1, D2 = day("2024-01-01"), day("2024-01-08")


def snapshot(spark, *rows):
    """Snapshot rows (series, date, vintage, value), of release 1 unless a row ends in another."""
    full = [(row[4] if len(row) > 4 else 1, *row[:4]) for row in rows]
    return spark.createDataFrame(full, SNAPSHOT)


def log_rows(df):
    """(series, date, vintage, value, type) of change rows, sorted."""
    picked = df.select("series_id", "date", "vintage_date", "value", "_change_type")
    return sorted((tuple(r) for r in picked.collect()), key=lambda r: [str(c) for c in r])
