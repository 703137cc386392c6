import json

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from meterwise.functions import calendar as cal
from meterwise.functions import geo
from meterwise.operators import enrich, spatial
from meterwise.sources import catalog, files
from meterwise.streaming.enrichment import append_to_files, enrich_readings

# a rectangle of 0.4 by 0.2 degrees
BOX = [[[x, y] for x, y in ((5.0, 44.8), (5.4, 44.8), (5.4, 45.0), (5.0, 45.0), (5.0, 44.8))]]


def shapes(spark, rings, label="mill quarter"):
    return spark.createDataFrame([(label, rings, 1)], "commune string, rings array<array<array<double>>>, ord long")


def test_calendar_across_the_clock_change(spark):
    df = spark.createDataFrame([("2022-03-26T02:10:00+0100",), ("2022-03-27T03:10:00+0200",)], "t string")
    found = cal.datetime_features(df, "t").collect()
    assert [(r.t_hour, r.t_year, r.t_day_of_year, r.t_dayname) for r in found] == [(2, 2022, 85, "Saturday"), (3, 2022, 86, "Sunday")]
    assert [r.t_day_of_week for r in found] == [5, 6]
    assert len(found[0]) == 12
    with pytest.raises(PySparkException):
        cal.datetime_features(spark.createDataFrame([("next spring",)], "t string"), "t").collect()


def test_colon_and_zulu_offsets(spark):
    df = spark.createDataFrame([("2022-03-27T01:10:00+00:00",), ("2022-03-27T01:10:00Z",)], "t string")
    assert {r.t_hour for r in cal.datetime_features(df, "t").collect()} == {3}


def test_holidays(spark):
    df = spark.sql("SELECT TIMESTAMP '2021-11-11 09:40:00' AS d UNION ALL SELECT TIMESTAMP '2021-11-12 09:40:00'")
    table = spark.createDataFrame([("metropole", "2021-11-11", "armistice"), ("elsewhere", "2021-11-12", "fair")], "country_code string, date string, name string")
    assert [r.jour_ferie for r in enrich.add_holiday_flag(df, "d", table).orderBy("d").collect()] == [1, 0]
    assert {r.jour_ferie for r in enrich.add_holiday_flag(df, "d", None).collect()} == {0}
    with pytest.raises(ValueError):
        enrich.add_holiday_flag(df.select(F.col("d").cast("string")), "d", table)


def test_school_vacations(spark):
    df = spark.sql("SELECT TIMESTAMP '2022-10-31 07:00:00' AS d")
    schema = "location string, zones string, start_date string, end_date string, description string, ord int"
    here = ("Paris", "Zone C")
    autumn = (*here, "2022-10-22T00:00:00+00:00", "2022-11-07", "autumn break", 5)

    def label(*periods):
        return enrich.add_school_vacation(df, "d", spark.createDataFrame(list(periods), schema)).first().vacances_scolaires

    assert label(autumn) == "autumn break"
    assert label(autumn, (*here, "2022-10-31", "2022-10-31", "bridge day", 4)) == "bridge day"
    assert label((*here, "2022-11-01", "2022-11-07", "not yet", 1)) == "aucune"
    assert label(("Paris", "Zone A", "2022-10-22", "2022-11-07", "another zone", 1)) == "aucune"
    assert label((*here, "sometime", "2022-11-07", "unreadable", 1), autumn) == "autumn break"
    assert enrich.add_school_vacation(df, "d", None).first().vacances_scolaires == "erreur_api"


def test_weather(spark):
    df = spark.sql("SELECT 44.9D AS latitude, 5.1D AS longitude, TIMESTAMP '2020-02-29 06:45:00' AS t")
    weather = spark.sql("SELECT 44.9000000001D AS latitude, 5.1D AS longitude, TIMESTAMP '2020-02-29 06:00:00' AS t, -3.25D AS temperature_2m_c")
    assert enrich.add_weather(df, weather, instant="t").first().temperature_2m_c == -3.25
    assert enrich.add_weather(df, weather.limit(0), instant="t").columns == df.columns


def test_point_in_polygon(spark):
    point = spark.createDataFrame([(5.11, 44.93)], "lon double, lat double")
    assert spatial.assign_polygons(point, shapes(spark, BOX), "lon", "lat").first().commune == "mill quarter"
    outside = spark.createDataFrame([(6.25, 43.10)], "lon double, lat double")
    assert spatial.assign_polygons(outside, shapes(spark, BOX), "lon", "lat").first().commune is None
    corner = spark.createDataFrame([(5.4, 45.0)], "lon double, lat double")
    assert spatial.assign_polygons(corner, shapes(spark, BOX, "fence"), "lon", "lat").first().commune == "fence"
    both = corner.union(point)
    assert rows(spatial.assign_polygons(both, shapes(spark, BOX), "lon", "lat"), "commune") == [("mill quarter",), (None,)]
    with pytest.raises(ValueError):
        spatial.assign_polygons(point, shapes(spark, BOX), "lon", "lat", label_column="absent")
    assert spatial.find_polygon(shapes(spark, BOX, "ferry"), 5.11, 44.93) == "ferry"
    assert spatial.find_polygon(shapes(spark, BOX, "ferry"), 6.25, 43.10) is None


def test_projections(spark):
    one = spark.range(1)
    lon, lat = one.select(geo.lambert93_to_lonlat(F.lit(700000.0), F.lit(6600000.0))).first()[0]
    assert lon == pytest.approx(3.0, abs=1e-9) and lat == pytest.approx(46.5, abs=1e-7)
    x, y = one.select(geo.lonlat_to_mercator(F.lit(180.0), F.lit(0.0))).first()[0]
    assert x == pytest.approx(20037508.342789244) and y == pytest.approx(0, abs=1e-6)
    # 800 m around the projection's origin, which is 3 degrees east, 46.5 degrees north
    metres = [[[700_000.0 + 800 * x, 6_600_000.0 + 800 * y] for x, y in ((-1, -1), (1, -1), (1, 1), (-1, 1), (-1, -1))]]
    point = spark.createDataFrame([(3.004, 46.497)], "lon double, lat double")
    assert spatial.assign_polygons(point, shapes(spark, metres, "origin"), "lon", "lat", crs="EPSG:2154").first().commune == "origin"


def test_polygon_file(spark, tmp_path):
    feature = {"type": "Feature", "properties": {"commune": "ferry"}, "geometry": {"type": "Polygon", "coordinates": BOX}}
    parts = {"type": "Feature", "properties": {"commune": "mill"}, "geometry": {"type": "MultiPolygon", "coordinates": [BOX, BOX]}}
    path = tmp_path / "zones.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": [feature, parts]}, indent=1))
    found = files.read_polygons(spark, str(path)).orderBy("ord").collect()
    assert [(r.commune, len(r.rings)) for r in found] == [("ferry", 1), ("mill", 2)]
    assert found[0].rings == BOX
    # the order is total over several files of several lines
    folder = tmp_path / "many"
    folder.mkdir()
    for name in "ab":
        lines = [json.dumps({"type": "FeatureCollection", "features": [{**feature, "properties": {"commune": f"{name}{i}{k}"}} for k in range(3)]}) for i in range(4)]
        (folder / f"{name}.json").write_text("\n".join(lines))
    many = files.read_polygons(spark, str(folder), lines=True)
    assert many.select("ord").distinct().count() == 24
    assert [r.commune for r in many.orderBy("ord").collect()] == [f"{n}{i}{k}" for n in "ab" for i in range(4) for k in range(3)]


def test_weather_blocks(spark, tmp_path):
    body = "location_id,latitude,elevation\n0,1.0,212.0\n1,2.0,8.5\n\nlocation_id,time,temperature_2m,weather_code\n0,2020-02-29T06:00,-3.25,71\n1,2020-02-29T06:00,7.0,2\n1,,1.0,0"
    (tmp_path / "w.csv").write_text(body)
    sites = files.site_positions(spark, [(44.9, 5.1), (43.6, 3.9)])
    found = files.read_weather_files(spark, str(tmp_path / "w.csv"), sites, "location_id BIGINT, time STRING, temperature_2m DOUBLE, weather_code INT")
    assert rows(found, "latitude", "elevation", "temperature_2m", "weather_code") == [(43.6, 8.5, 7.0, 2), (44.9, 212.0, -3.25, 71)]


def test_sources(spark, tmp_path):
    (tmp_path / "a.csv").write_text("col1;col2\n5;6\n7;8\n")
    (tmp_path / "b.json").write_text('[{"col1": 5, "col2": 6}, {"col1": 7, "col2": 8}]')
    (tmp_path / "bad.json").write_text('{"col1": 1}, oops')
    known = {"a": {"path": str(tmp_path / "a.csv"), "options": {"sep": ";"}}, "b": str(tmp_path / "b.json"), "x": "book.xlsx"}
    assert rows(catalog.open_dataset(spark, known, "a")) == [(5, 6), (7, 8)]
    assert rows(catalog.open_dataset(spark, known, "b")) == [(5, 6), (7, 8)]
    with pytest.raises(KeyError):
        catalog.open_dataset(spark, known, "unknown")
    with pytest.raises(ValueError):
        catalog.open_dataset(spark, known, "x")
    with pytest.raises(PySparkException):
        catalog.read_json_records(spark, str(tmp_path / "bad.json"), schema="col1 int").collect()
    (tmp_path / "loose.json").write_text('{"col1": 1}, {"col1": 2}')
    with pytest.raises(PySparkException):
        catalog.read_json_records(spark, str(tmp_path / "loose.json")).collect()
    assert catalog.file_format("data/test.JSON") == "json"
    (tmp_path / "config.json").write_text('{"data": {"input": {"a": "a.csv"}}}')
    assert catalog.load_catalog(str(tmp_path / "config.json")) == {"a": "a.csv"}


def test_enrichment_plan_is_one_broadcast_stage(spark):
    df = spark.range(1000).select(F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id")).alias("t"))
    table = spark.createDataFrame([("metropole", "2023-11-11", "x")], "country_code string, date string, name string")
    plan = enrich.add_holiday_flag(cal.datetime_features(df, "t"), "t", table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "Python" not in plan


def test_stream_gives_the_batch_result(spark, tmp_path):
    batch = spark.range(200).select("id", F.timestamp_seconds(F.lit(1_688_169_600) + F.col("id") * 7200).alias("t"))
    batch.write.parquet(str(tmp_path / "in"))
    table = spark.createDataFrame([("metropole", "2023-07-14", "x")], "country_code string, date string, name string")
    stream = spark.readStream.schema(batch.schema).parquet(str(tmp_path / "in"))
    job = append_to_files(enrich_readings(stream, "t", table), str(tmp_path / "out"), str(tmp_path / "cp"))
    job.awaitTermination(120)
    written = spark.read.parquet(str(tmp_path / "out"))
    assert rows(written) == rows(enrich_readings(batch, "t", table))
