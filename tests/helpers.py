from datetime import datetime, timedelta

ORIGIN = datetime(2024, 1, 1)


def at(hours: float) -> datetime:
    return ORIGIN + timedelta(hours=hours)


def hour(moment: datetime) -> float:
    return (moment - ORIGIN).total_seconds() / 3600


def frame(spark, schema: str, rows):
    return spark.createDataFrame([tuple(r) for r in rows], schema)


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=lambda r: tuple((x is None, x) for x in r))
