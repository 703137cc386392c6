"""Sources and sinks: whole tables written to the shared folder and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterwise.plans.registry import Tables, long, query, r6, text_time
from meterwise.sources import catalog, files


@query("scan_delimited", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def scan_delimited(t: Tables) -> DataFrame:
    path = t.scratch("orders-csv")
    columns = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
    files.write_table(t.orders.select(*columns), path, "csv", sep=";")
    return catalog.read_delimited(
        t.spark, path, sep=";", schema="o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string"
    )


@query("scan_indexed_tab_file", "SELECT p_partkey AS part, p_brand, p_size FROM part")
def scan_indexed_tab_file(t: Tables) -> DataFrame:
    """The first column is a nameless index that becomes a key column."""
    path = t.scratch("part-tsv")
    files.write_table(t.part.select("p_partkey", "p_brand", "p_size"), path, "csv", sep="\t")
    return catalog.read_delimited(t.spark, path, sep="\t", schema="_c0 bigint, p_brand string, p_size int", index_name="part")


@query("scan_json_records", "SELECT event_id, user_id, event_type, value FROM events")
def scan_json_records(t: Tables) -> DataFrame:
    path = t.scratch("events-json")
    files.write_table(t.events.select("event_id", "user_id", "event_type", "value"), path, "json")
    return catalog.read_json_records(
        t.spark, path, schema="event_id bigint, user_id bigint, event_type string, value double", lines=True
    )


@query("scan_json_arrays", "SELECT user_id, event_id, value FROM events")
def scan_json_arrays(t: Tables) -> DataFrame:
    """One JSON array of records per file (several files), read by the strict reader."""
    path = t.scratch("events-json-arrays")
    # a file of at most 50 000 consecutive ids: bounded however large the table or one user is
    batch = F.floor(F.col("event_id") / 50_000)
    records = t.events.groupBy(batch.alias("b")).agg(
        F.to_json(F.collect_list(F.struct("user_id", "event_id", "value"))).alias("value")
    )
    records.write.partitionBy("b").text(path)
    return catalog.read_json_records(t.spark, path, schema="user_id bigint, event_id bigint, value double")


@query("catalog_open", "SELECT 'customer' AS dataset, count(*) AS n FROM customer UNION ALL SELECT 'supplier', count(*) FROM supplier")
def catalog_open(t: Tables) -> DataFrame:
    names = {
        "customer": f"{t.folder}/customer.parquet",
        "supplier": {"path": f"{t.folder}/supplier.parquet", "format": "parquet"},
    }
    counts = [
        catalog.open_dataset(t.spark, names, n).agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("dataset"), "n") for n in names
    ]
    return counts[0].unionByName(counts[1])


@query(
    "scan_weather_files",
    """SELECT user_id % 10 AS site, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:00') AS hour, round(value, 4) AS temperature_2m,
    CAST(100 + user_id % 10 AS DOUBLE) AS elevation, CAST(48 + 0.1 * (user_id % 10) AS DOUBLE) AS latitude FROM events WHERE event_id % 7 <> 0""",
)
def scan_weather_files(t: Tables) -> DataFrame:
    """Two-block files, one per day and 50 000 ids of the events, read back as hourly rows by the file reader."""
    path = t.scratch("weather")
    row = F.concat_ws(
        ",", F.col("user_id") % 10,
        F.when(F.col("event_id") % 7 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm")).otherwise(""), F.col("value"),
    )
    bodies = t.events.groupBy(F.to_date("ts").alias("day"), F.floor(F.col("event_id") / 50_000).alias("part")).agg(
        F.concat_ws("\n", F.collect_list(row)).alias("rows")
    )
    station_lines = "\n".join(f"{i},{48 + i / 10},{100 + i}.0" for i in range(10))
    head = f"location_id,latitude,elevation\n{station_lines}\n\nlocation_id,time,temperature_2m\n"
    bodies.select("day", "part", F.concat(F.lit(head), F.col("rows")).alias("value")).write.partitionBy("day", "part").text(path)
    sites = files.site_positions(t.spark, [(48 + i / 10, 2.0) for i in range(10)])
    read = files.read_weather_files(t.spark, path, sites, "location_id BIGINT, time STRING, temperature_2m DOUBLE", instant="at")
    site = F.round((F.col("latitude") - 48) * 10).cast("long")
    return read.select(
        site.alias("site"), text_time("at").alias("hour"), r6("temperature_2m", 4).alias("temperature_2m"), "elevation", r6("latitude").alias("latitude")
    )


@query(
    "scan_polygon_file",
    """SELECT CAST(user_id AS VARCHAR) AS commune, CAST(1 AS BIGINT) AS rings, round(user_id * CAST(0.01 AS DOUBLE), 6) AS min_x,
    round(user_id * CAST(0.01 AS DOUBLE) + 0.5, 6) AS max_x FROM (SELECT DISTINCT user_id FROM events)""",
)
def scan_polygon_file(t: Tables) -> DataFrame:
    """GeoJSON features, one square per user, one collection per file line batch."""
    from meterwise.functions import geo

    path = t.scratch("polygons")
    x = F.col("user_id") * F.lit(0.01)
    corner = [(x, F.lit(1.0)), (x + 0.5, F.lit(1.0)), (x + 0.5, F.lit(2.0)), (x, F.lit(2.0)), (x, F.lit(1.0))]
    ring = F.array(*[F.array(a, b) for a, b in corner])
    feature = F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("user_id").cast("string").alias("commune")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    users = t.events.select("user_id").distinct()
    batches = users.groupBy(F.floor(F.col("user_id") / 50).alias("b")).agg(F.collect_list(feature).alias("features"))
    batches.select(F.lit("FeatureCollection").alias("type"), "features").write.json(path)
    shapes = files.read_polygons(t.spark, path, "commune", lines=True)
    box = geo.bounding_box(F.col("rings"))
    return shapes.select(
        "commune", long(F.size("rings")).alias("rings"), r6(box["min_x"]).alias("min_x"), r6(box["max_x"]).alias("max_x")
    )


@query(
    "sink_partitioned",
    """SELECT CAST(year(o_orderdate) AS BIGINT) AS year, CAST(month(o_orderdate) AS BIGINT) AS month, count(*) AS n,
    round(sum(o_totalprice), 2) AS total FROM orders WHERE year(o_orderdate) = 1997 GROUP BY 1, 2""",
)
def sink_partitioned(t: Tables) -> DataFrame:
    """Partitioned parquet sink; the read prunes to one year."""
    path = t.scratch("orders-partitioned")
    dated = t.orders.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate"))
    # rows of one month may sit in several files, so a heavy month is not written by one task
    files.write_table(dated, path, "parquet", ["year", "month"])
    back = t.spark.read.parquet(path).filter("year = 1997")
    return back.groupBy(long("year").alias("year"), long("month").alias("month")).agg(
        F.count(F.lit(1)).alias("n"), r6(F.sum("o_totalprice"), 2).alias("total")
    )


@query("pixel_scan", "SELECT vec_id // 32 AS x, vec_id % 32 AS y, count(*) AS n, round(avg(CAST(embedding[1] AS DOUBLE) * 255), 4) AS r FROM embeddings GROUP BY 1, 2")
def pixel_scan(t: Tables) -> DataFrame:
    """Embedding rows as a pixel grid with three channels."""
    grid = t.embeddings.select(
        F.floor(F.col("vec_id") / 32).alias("x"), (F.col("vec_id") % 32).alias("y"),
        *[(F.col("embedding")[i].cast("double") * 255).alias(c) for i, c in enumerate("rgb")],
    )
    pixels = files.pixel_table(grid, "x", "y", list("rgb"))
    return pixels.groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("r"), 4).alias("r"))


@query("model_save_load", "SELECT count(*) AS n, round(avg(l_extendedprice), 2) AS mean_prediction FROM lineitem")
def model_save_load(t: Tables) -> DataFrame:
    """Fit, save, load and apply a regression; its mean prediction is the mean of the target."""
    from meterwise.operators import models

    table = models.with_features(t.lineitem.select("l_quantity", "l_tax", "l_extendedprice"), ["l_quantity", "l_tax"])
    path = t.scratch("model")
    files.save_model(models.linear_regression(table, "l_extendedprice"), path)
    loaded = files.load_model(t.spark, path)
    return loaded.transform(table).agg(F.count("prediction").alias("n"), r6(F.avg("prediction"), 2).alias("mean_prediction"))

