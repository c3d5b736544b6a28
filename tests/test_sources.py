import math

from pyspark.sql import types as T

from tests.helpers import at, frame, rows
from wardline.sources import schemas, tables


def test_delimited_round_trip(spark):
    df = frame(spark, "stay_id long, starttime timestamp_ntz, endtime timestamp_ntz", [(1, at(0), at(1.5)), (2, None, at(3))])
    path = tables.shared_folder(spark)
    tables.write_delimited(df, path, sort=["stay_id"])
    assert rows(tables.read_delimited(spark, path, schemas.INTERVALS)) == rows(df)


def test_nan_becomes_null(spark):
    df = frame(spark, "x double, k int", [(math.nan, 1), (2.0, 2)])
    assert rows(tables.nan_to_null(df)) == [(2.0, 2), (None, 1)]


def test_predictions_replace_only_their_model(spark):
    path = tables.shared_folder(spark)
    make = lambda model, prob: frame(spark, "stay_id long, step int, model string, label int, prob double", [(1, 1, model, 0, prob)])
    tables.write_predictions(make("a", 0.1).union(make("b", 0.2)), path)
    tables.write_predictions(make("b", 0.3), path)
    assert rows(tables.read_predictions(spark, path), "model", "prob") == [("a", 0.1), ("b", 0.3)]
    assert rows(tables.read_predictions(spark, path, ["b"]), "model", "prob") == [("b", 0.3)]


def test_metrics_append(spark):
    path = tables.shared_folder(spark)
    for run in (1, 2):
        tables.append_metrics(frame(spark, "run int, params map<string,string>, metric string, value double", [(run, {"C": "1"}, "auc", 0.5)]), path)
    assert tables.read_table(spark, path, schemas.METRICS).count() == 2


def test_materialise_keeps_schema(spark):
    df = frame(spark, "stay_id long, v double", [(1, 1.0)])
    stored = tables.materialise(df, tables.shared_folder(spark))
    assert stored.schema.simpleString() == df.schema.simpleString() and stored.count() == 1


def test_schemas_cover_the_tables():
    assert len(schemas.LABS) == 42 and len(schemas.VITALS) == 28
    assert isinstance(schemas.STAGES["charttime"].dataType, T.TimestampNTZType)


def test_catalog_table_is_replaced_and_bucketed(spark):
    for value in (1.0, 2.0):
        df = frame(spark, "stay_id long, v double", [(1, value), (2, value)])
        stored = tables.materialise_table(df, "derived", bucket_by="stay_id", buckets=4)
    assert rows(stored) == [(1, 2.0), (2, 2.0)]
    assert rows(tables.read_named(spark, "derived", "default")) == rows(stored)
    spark.sql("DROP TABLE derived")


def test_bucketed_tables_need_no_shuffle_for_windows(spark, capsys):
    from wardline.operators.grid import step_index

    df = spark.range(100).selectExpr("id % 10 as stay_id", "timestamp_ntz'2024-01-01' + make_interval(0, 0, 0, 0, int(id)) as charttime")
    step_index(tables.materialise_table(df, "bucketed", "stay_id", 4), "stay_id", "charttime").explain()
    assert "Exchange" not in capsys.readouterr().out
    spark.sql("DROP TABLE bucketed")


def test_folder_is_new_each_time(spark):
    assert tables.shared_folder(spark) != tables.shared_folder(spark)
