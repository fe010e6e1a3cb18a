import json
import os

import pytest
from pyspark.sql import functions as F

from arbolytics.operators import clean, quality
from arbolytics.sinks import tables
from arbolytics.sources import files, forecasts, intake
from arbolytics.sources.schemas import FORECAST_METRICS, READING, TRAIT_COLUMNS
from arbolytics.sources.streams import envelope
from arbolytics.streaming.parse import parse_checked, parse_readings
from tests import fixtures as X


def test_json_objects_with_defects(spark, folder):
    good = X.reading_rows()[:2]
    for i, row in enumerate(good):
        with open(f"{folder}/{i}.json", "w") as f:
            json.dump(row | {"extra": 1}, f, indent=1)
    with open(f"{folder}/2.json", "w") as f:
        f.write('{"device_id": "cut", "li')
    with open(f"{folder}/3.json", "w") as f:
        json.dump({"device_id": "few", "temp": "warm"}, f)
    rows = files.read_reading_objects(spark, folder, whole_files=True)
    assert rows.schema.fieldNames() == [*READING.fieldNames(), files.CORRUPT]
    good, bad = files.split_landed(rows)
    assert sorted(r.plant_id for r in good.collect()) == sorted(r["plant_id"] for r in X.reading_rows()[:2])
    assert bad.count() == 2


def test_objects_per_line_and_intake_agree(spark, folder):
    rows = X.reading_rows()[:3]
    os.makedirs(f"{folder}/lines")
    os.makedirs(f"{folder}/whole")
    with open(f"{folder}/lines/a.json", "w") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + '\n{"device_id": "cut\n')
    for i, r in enumerate(rows):
        with open(f"{folder}/whole/{i}.json", "w") as f:
            json.dump(r, f, indent=2)
    for kind, whole, n_bad in (("lines", False, 1), ("whole", True, 0)):
        good, bad = files.split_landed(files.read_reading_objects(spark, f"{folder}/{kind}", whole_files=whole))
        assert good.count() == 3 and bad.count() == n_bad
        out = f"{folder}/{kind}-out"
        intake.take_new_files(spark, f"{folder}/{kind}", out, f"{out}-state", READING, whole_files=whole, rejects=f"{out}-bad")
        assert X.rows_of(spark.read.parquet(out).select(READING.fieldNames())) == X.rows_of(good)
        assert spark.read.schema("raw string").parquet(f"{out}-bad").count() == n_bad


def test_ids_in_folder_names(spark, folder):
    ids = ["aa:b c", "007", "1e3", "10", "x%+y", "2030-01-01"]
    tables.write_readings(spark.createDataFrame([(i, 1) for i in ids], "device_id string, v int"), f"{folder}/r")
    rows = files.with_source_file(files.read_sensor_readings(spark, f"{folder}/r"))
    from arbolytics.functions.scalars import partition_value
    back = rows.select("sensor_id", partition_value(F.col("source_file"), "device_id")).collect()
    assert sorted(map(tuple, back)) == sorted((i, i) for i in ids)


def test_csv_quotes(spark, folder):
    rows = spark.createDataFrame([('x "y", z', "a\nb", 1), ('"', ",", 2), (None, "'", 3)], "a string, b string, c int")
    tables.write_csv(rows, f"{folder}/q")
    assert X.rows_of(files.read_csv_by_header(spark, f"{folder}/q", rows.schema)) == X.rows_of(rows)


def test_csv_header(spark, folder):
    traits = X.traits(spark)
    tables.write_csv(traits.withColumn("More", F.lit(1)).select("More", *reversed(TRAIT_COLUMNS)), f"{folder}/t")
    back = files.read_traits_csv(spark, f"{folder}/t")
    assert X.rows_of(back) == X.rows_of(traits)
    tables.write_csv(traits.drop("Genus", "Family"), f"{folder}/u")
    with pytest.raises(ValueError, match="Genus.*Family"):
        files.read_traits_csv(spark, f"{folder}/u")


def test_partitions_and_sensor_id(spark, folder):
    readings = X.readings(spark)
    tables.write_readings(readings, f"{folder}/r")
    back = files.read_sensor_readings(spark, f"{folder}/r")
    assert {r[0] for r in back.select("sensor_id").collect()} == {r["device_id"] for r in X.reading_rows()}
    assert back.count() == readings.count()
    tables.write_traits(X.traits(spark), f"{folder}/f")
    some = files.read_trait_families(spark, f"{folder}/f", ["Solanaceae"])
    assert some.count() == 0
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "Family" in plan.split("PartitionFilters: [")[1].split("]")[0]
    tables.write_weather(X.weather(spark), f"{folder}/w")
    assert os.path.isdir(f"{folder}/w/pr_date=2030-05-02")


def test_dated_loads(spark, folder):
    rows = spark.range(3)
    tables.write_dated(rows, f"{folder}/d", "2030-05-01")
    tables.write_dated(rows.limit(2), f"{folder}/d", "2030-05-02")
    tables.write_dated(rows.limit(1), f"{folder}/d", "2030-05-02")
    assert files.read_table(spark, f"{folder}/d").count() == 4
    assert files.read_latest(spark, f"{folder}/d").count() == 1
    tables.write_parquet(rows, f"{folder}/p/2030-05-03", files=1)
    assert files.read_dated(spark, f"{folder}/p", "2030-05-03").count() == 3


def test_take_new_files_once(spark, folder):
    land, out, check = f"{folder}/land", f"{folder}/out", f"{folder}/check"
    schema = spark.range(1).schema
    spark.range(3).write.json(land)
    for _ in range(2):
        intake.take_new_files(spark, land, out, check, schema)
    spark.range(3, 5).write.mode("append").json(land)
    intake.take_new_files(spark, land, out, check, schema)
    assert sorted(r[0] for r in spark.read.schema(schema).parquet(out).collect()) == [0, 1, 2, 3, 4]
    assert intake.files_below(spark, land, ".json").count() >= 2


def test_forecasts(spark, folder):
    os.makedirs(f"{folder}/f")
    for city in ("Madrid", "Girona"):
        with open(f"{folder}/f/{city}.json", "w") as f:
            json.dump({"city": city, "daily": {m: [i + 0.5] for i, m in enumerate(FORECAST_METRICS)}}, f)
    rows = forecasts.flatten_forecasts(forecasts.label_forecasts(
        forecasts.read_forecasts(spark, f"{folder}/f"), "2030-12-31")).collect()
    assert {(r.city, r.prediction_date, r.temperature_2m_min) for r in rows} == {
        ("Madrid", "2031-01-01", 1.5), ("Girona", "2031-01-01", 1.5)}
    payload = forecasts.read_forecasts(spark, f"{folder}/f").select(F.create_map(
        F.lit("Lleida"), F.struct("city", "pr_date", "prediction_date", "daily")).alias("forecasts"))
    assert {r.city for r in forecasts.rows_of_city_map(payload).collect()} == {"Lleida"}


def test_empty_and_missing(spark, folder):
    with pytest.raises(ValueError, match="no rows in weather"):
        quality.require_non_empty(X.weather(spark).limit(0), "weather")
    assert quality.require_non_empty(X.weather(spark), "weather").count() == 5
    with pytest.raises(ValueError, match="a, b"):
        quality.require_columns(spark.range(1), ["a", "id", "b"])
    found, expected = (spark.createDataFrame([(n,) for n in names], "name string")
                       for names in (["a"], ["a", "b"]))
    assert [r[0] for r in intake.missing_inputs(found, expected, "name").collect()] == ["b"]


def test_copies(spark):
    two = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "x int, f string")
    assert clean.dedup(two).count() == 2
    assert clean.dedup_per_source(two, "f").collect() == [(1,), (1,)]
    assert clean.format_weather(X.weather(spark).unionByName(X.weather(spark))).count() == 5


def test_species_names(spark):
    out = clean.format_traits(X.traits(spark))
    assert {(r.Species_id, r.plant_name) for r in out.collect()} == {
        (1, "Spinach"), (2, "Green onion/Scallions"), (3, "Garlic")}
    assert "Family" not in out.columns
    named = clean.name_species(X.traits(spark), "Species_name_standardized_against_TPL", {"x": "y"})
    assert {r[0] for r in named.select("plant_name").collect()} == {"Unknown"}


def test_nullability_and_rounding(spark):
    df = spark.createDataFrame([(1.23456, 1)], "a double, b int").select(F.lit(2.00049).alias("a"), "b")
    nested = df.select("a", F.struct(F.lit(1).alias("x")).alias("s"), F.array(F.lit("y")).alias("r"))
    loose = clean.relax_nullability(nested)
    assert not nested.schema["s"].nullable
    assert all(f.nullable for f in loose.schema) and loose.schema["s"].dataType["x"].nullable
    assert loose.schema["r"].dataType.containsNull and X.rows_of(loose) == X.rows_of(nested)
    assert clean.round_doubles(df).first() == (2.0, 1)
    assert clean.all_text(df).schema.simpleString() == "struct<a:string,b:string>"


def test_mapping_checks(spark):
    rows = spark.createDataFrame(
        [("d1", "g", "x"), ("d1", "g", "y"), ("d2", "g", "x")], "d string, g string, l string")
    assert quality.mapping_conflicts(rows, "d", ["g", "l"]).collect() == [("d1", 1, 2)]
    plants = spark.createDataFrame([("d", f"p{i}", "small") for i in range(5)] * 2, "d string, p string, t string")
    assert quality.plants_over_cap(plants, "d", "p", "t", {"small": 4}).count() == 1
    assert quality.plants_over_cap(plants, "d", "p", "t", {"small": 5}).count() == 0
    assert quality.plants_over_cap(plants, "d", "p", "t", {"other": 5}).collect() == [("d", "small", 5, None)]
    nodes = spark.createDataFrame([("a", "1"), ("a", "1"), ("b", "1"), ("b", None)], "`:ID` string, value string")
    assert quality.id_conflicts(nodes).collect() == [("b", 2)]


def test_quarantine(spark):
    sent = envelope(X.readings(spark)).limit(3).select("value")
    bad = spark.createDataFrame([(b'{"device_id": "cut', ), (b'{"temp": "warm"}',), (b'{"device_id": "d", "timestamp": "x"}',),
                                 (None,)], "value binary")
    parsed = parse_checked(sent.unionByName(bad))
    good, rejected = quality.split_rejects(parsed)
    assert good.count() == 3 and rejected.count() == 4
    assert good.columns == [*READING.fieldNames(), "event_time"]
    assert parse_readings(sent.unionByName(bad)).count() == 7


def test_counts_while_writing(spark, folder):
    rows, seen = quality.counted(X.readings(spark), "readings", ["plant_id"])
    tables.write_parquet(rows, f"{folder}/t")
    assert seen.get == {"rows": 48, "plant_id": 48}


def test_folder_without_setting(monkeypatch):
    from types import SimpleNamespace

    from arbolytics import session

    def fake(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: None),
                               sparkContext=SimpleNamespace(master=master, applicationId=master))

    assert session.shared_folder(fake("local[2]")) == session.shared_folder(fake("local[2]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(fake("yarn"))
