"""Scans, cleaning, joins and checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from arbolytics.functions.ids import register_id_function, uuid_id
from arbolytics.functions.scalars import (
    date_text, folder_date, format_reading_time, has_suffix, map_values, partition_value, plant_of_pair, species_of_pair)
from arbolytics.operators import clean, quality
from arbolytics.operators.ranking import count_per
from arbolytics.operators.wide import wide_table
from arbolytics.session import fresh_path, stage
from arbolytics.sinks import messages, published, tables
from arbolytics.sources import files, forecasts
from arbolytics.sources.schemas import FORECAST_METRICS
from arbolytics.streaming.parse import parse_checked
from arbolytics.workload import bindings as B
from arbolytics.workload import sql
from arbolytics.workload.registry import query

WIDE_COLUMNS = ["sensor_id", "garden_id", "garden_name", "location", "plant_id", "species_id",
                *B.METRICS]


@query("wide_join", sql.over_wide(
    "SELECT " + ", ".join(WIDE_COLUMNS) + ", prediction_date, temperature_2m_max, rain_sum, "
    "plant_name, Genus AS genus, Plant_height_m AS plant_height_m, today, event_id FROM wide"))
def wide_join(spark, folder):
    return B.wide_rows(spark, folder).select(
        *[F.col(f"iot_{c}").alias(c) for c in WIDE_COLUMNS],
        F.col("weather_prediction_date").alias("prediction_date"),
        F.col("weather_temperature_2m_max").alias("temperature_2m_max"),
        F.col("weather_rain_sum").alias("rain_sum"), F.col("plants_plant_name").alias("plant_name"),
        F.col("plants_Genus").alias("genus"), F.col("plants_Plant_height_m").alias("plant_height_m"),
        "today", "event_id")


# The weather feed spells one city in its own way, so its readings find no partner.
@query("unmatched_locations", f"""WITH {sql.READINGS}, {sql.WEATHER}
    SELECT location AS key, count(*) AS n_rows FROM readings
    WHERE NOT EXISTS (SELECT 1 FROM weather WHERE replace(city, ' ', '_') = location) GROUP BY location""")
def unmatched_locations(spark, folder):
    feed = B.weather(spark, folder).withColumn("city", F.replace("city", F.lit(" "), F.lit("_")))
    # Readings are counted per sensor before sensors are joined.
    per_sensor = count_per(B.table(spark, folder, "lineitem"), "l_suppkey").join(
        B.sensors(spark, folder).select("s_suppkey", "location"),
        F.col("l_suppkey") == F.col("s_suppkey"))
    return quality.unmatched_keys(per_sensor, feed, "location", "city", weight="number")


@query("alias_join_counts", f"""WITH {sql.READINGS}, {sql.WEATHER}, {sql.TRAIT_TABLE}
    SELECT replace(location, ' ', '_') AS city, count(*) AS n FROM readings
    JOIN weather ON replace(city, ' ', '_') = replace(location, ' ', '_')
    JOIN traits ON species_id = trait_species_id GROUP BY ALL""")
def alias_join_counts(spark, folder):
    feed = stage(B.weather(spark, folder).withColumn(
        "city", F.replace("city", F.lit(" "), F.lit("_"))), "weather")
    wide = wide_table(B.readings(spark, folder), feed, stage(B.traits(spark, folder), "traits"),
                      {"MIDDLE EAST": "MIDDLE_EAST"})
    return wide.groupBy(F.col("weather_city").alias("city")).agg(F.count(F.lit(1)).alias("n"))


@query("scan_latest_partition", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders "
       "WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def scan_latest_partition(spark, folder):
    return files.latest_partition(B.table(spark, folder, "orders"), "o_orderdate").select(
        "o_orderkey", "o_custkey", "o_totalprice")


@query("scan_partition_subset", "SELECT p_partkey, p_brand, p_type FROM part "
       "WHERE p_type IN ('ECONOMY', 'STANDARD')")
def scan_partition_subset(spark, folder):
    return files.partition_subset(B.table(spark, folder, "part"), "p_type", ["ECONOMY", "STANDARD"]).select(
        "p_partkey", "p_brand", "p_type")


@query("csv_round_trip", """SELECT *, c_name || ' "q", ' || chr(10) || '"' || c_mktsegment AS note FROM customer""")
def csv_round_trip(spark, folder):
    """Values with quotes, commas and line ends come back as they were."""
    note = F.concat("c_name", F.lit(' "q", \n"'), "c_mktsegment")
    source = B.table(spark, folder, "customer").withColumn("note", note)
    path = fresh_path(spark, "csv")
    tables.write_csv(source, path)
    return files.read_csv_by_header(spark, path, source.schema)


@query("json_round_trip", "SELECT event_id, user_id, event_type, value, props FROM events")
def json_round_trip(spark, folder):
    source = B.table(spark, folder, "events").drop("ts")
    path = fresh_path(spark, "json")
    messages.documents(source).write.text(path)
    return spark.read.schema(source.schema).json(path)


EVENT_COLUMNS = ["event_id", "user_id", "event_type", "micros", "value", "props"]


@query("landed_readings", "SELECT event_id, user_id, event_type, epoch_us(ts) AS micros, value, props, 4 AS n FROM events")
def landed_readings(spark, folder):
    """Events landed as lines and as arrays over many lines, read and taken in: each comes back four times, no text is rejected."""
    from arbolytics.sources.intake import take_new_files

    events = B.table(spark, folder, "events").withColumn(
        "micros", F.unix_micros(F.col("ts").cast("timestamp"))).select(EVENT_COLUMNS)
    lines, arrays = fresh_path(spark, "landed-lines"), fresh_path(spark, "landed-arrays")
    messages.documents(events).write.text(lines)
    # A file has the array of at most 2,000 events, over as many lines.
    text = F.concat(F.lit("[\n"), F.array_join(F.collect_list(F.to_json(F.struct(*EVENT_COLUMNS))), ",\n"), F.lit("\n]"))
    (events.groupBy(F.floor(F.col("event_id") / 2000).alias("file")).agg(text.alias("text"))
     .write.partitionBy("file").text(arrays))
    found = []
    for path, whole in ((lines, False), (f"{arrays}/*", True)):
        good, bad = files.split_landed(files.read_reading_objects(spark, path, "*", whole, events.schema))
        taken, rejects = fresh_path(spark, "taken"), fresh_path(spark, "rejects")
        take_new_files(spark, path, taken, fresh_path(spark, "intake"), events.schema, whole_files=whole, rejects=rejects)
        found += [good, spark.read.schema(events.schema).parquet(taken), bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema])]
    return clean.union_by_name(found).groupBy(*EVENT_COLUMNS).agg(F.count(F.lit(1)).cast("int").alias("n"))


SENSOR_IDS = """CASE l_suppkey % 4 WHEN 0 THEN 'aa:b c:' || l_suppkey WHEN 1 THEN '00' || l_suppkey WHEN 2 THEN l_suppkey || 'e3'
    ELSE 'x%+' || l_suppkey END"""


@query("sensor_partition_ids", f"""SELECT {SENSOR_IDS} AS sensor_id, {SENSOR_IDS} AS folder_id, count(*) AS n, round(sum(l_quantity), 4) AS total
    FROM lineitem GROUP BY ALL""")
def sensor_partition_ids(spark, folder):
    """Sensor ids that look like numbers or need escapes, through the partition folders."""
    path = fresh_path(spark, "readings")
    tables.write_readings(B.table(spark, folder, "lineitem").select(F.expr(SENSOR_IDS).alias("device_id"), "l_quantity"), path)
    rows = files.with_source_file(files.read_sensor_readings(spark, path))
    return rows.groupBy("sensor_id", partition_value(F.col("source_file"), "device_id").alias("folder_id")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 4).alias("total"))


@query("wide_join_history", sql.over_wide("SELECT city, prediction_date, plant_name, count(*) AS n FROM wide GROUP BY ALL"))
def wide_join_history(spark, folder):
    """A weather table with several forecast days: each reading meets the run's day only."""
    day = B.weather(spark, folder)
    later = [day.withColumn("prediction_date", date_text(F.lit(B.AS_OF), n)) for n in (2, 3)]
    history = stage(clean.union_by_name([day, *later]), "weather-history")
    wide = wide_table(B.readings(spark, folder), history, stage(B.traits(spark, folder), "traits"), forecast_day="1998-12-02")
    return wide.groupBy(F.col("weather_city").alias("city"), F.col("weather_prediction_date").alias("prediction_date"),
                        F.col("plants_plant_name").alias("plant_name")).agg(F.count(F.lit(1)).alias("n"))


@query("partitioned_round_trip", "SELECT l_orderkey, l_linenumber, l_quantity, l_returnflag, "
       "year(l_shipdate)::INTEGER AS ship_year FROM lineitem WHERE year(l_shipdate) IN (1996, 1998)")
def partitioned_round_trip(spark, folder):
    source = B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_returnflag", F.year("l_shipdate").alias("ship_year"))
    path = fresh_path(spark, "by-year")
    tables.write_partitioned(source, path, ["ship_year"])
    return files.partition_subset(files.read_table(spark, path), "ship_year", [1996, 1998])


@query("latest_ingest", "SELECT *, '1998-12-02' AS ingest_date FROM supplier WHERE s_suppkey % 3 > 0")
def latest_ingest(spark, folder):
    """Two dated loads with different rows; only the newer one is read back."""
    source = B.table(spark, folder, "supplier")
    path = fresh_path(spark, "dated")
    tables.write_dated(source.filter("s_suppkey % 3 < 2"), path, "1998-12-01")
    tables.write_dated(source.filter("s_suppkey % 3 > 0"), path, "1998-12-02")
    return files.read_latest(spark, path)


@query("partition_folder_column", "SELECT event_type AS sensor_id, count(*) AS n FROM events GROUP BY 1")
def partition_folder_column(spark, folder):
    """Partition value restored from the file path instead of partition discovery."""
    path = fresh_path(spark, "by-type")
    tables.write_partitioned(B.table(spark, folder, "events").select("event_id", "event_type"), path,
                             ["event_type"])
    rows = files.with_source_file(spark.read.option("recursiveFileLookup", True).parquet(path))
    return (rows.groupBy(partition_value(F.col("source_file"), "event_type").alias("sensor_id"))
            .agg(F.count("event_id").alias("n")))


@query("weather_flatten", f"""WITH {sql.WEATHER} SELECT city, prediction_date AS pr_date, prediction_date,
       {', '.join(FORECAST_METRICS)} FROM weather""")
def weather_flatten(spark, folder):
    daily = F.struct(*[F.array(F.round(m, 3)).alias(m) for m in FORECAST_METRICS]).alias("daily")
    payloads = B.weather(spark, folder).select("city", daily)
    return forecasts.flatten_forecasts(forecasts.label_forecasts(payloads, B.AS_OF))


@query("dedup_global", "SELECT DISTINCT user_id, event_type FROM (SELECT * FROM events UNION ALL SELECT * FROM events)")
def dedup_global(spark, folder):
    rows = B.table(spark, folder, "events").select("user_id", "event_type")
    return clean.dedup(rows.unionByName(rows))


@query("dedup_per_source", "SELECT l_suppkey, l_partkey FROM (SELECT DISTINCT 'a' AS f, l_suppkey, l_partkey "
       "FROM lineitem UNION ALL SELECT DISTINCT 'b', l_suppkey, l_partkey FROM lineitem)")
def dedup_per_source(spark, folder):
    rows = B.table(spark, folder, "lineitem").select("l_suppkey", "l_partkey")
    both = clean.union_by_name([rows.withColumn("f", F.lit(f)) for f in ("a", "b")])
    return clean.dedup_per_source(both, "f")


@query("union_by_name_missing", "SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, "
       "c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier")
def union_by_name_missing(spark, folder):
    a = B.table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = B.table(spark, folder, "supplier").select(
        F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name"), F.col("s_suppkey").alias("key"))
    return clean.union_by_name([a, b], fill_missing=True)


@query("union_distinct_dates", "SELECT CAST(o_orderdate AS DATE) AS day FROM orders UNION "
       "SELECT CAST(l_shipdate AS DATE) FROM lineitem")
def union_distinct_dates(spark, folder):
    a = B.table(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    b = B.table(spark, folder, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    return a.distinct().union(b.distinct()).distinct()


NAMES = {f"Brand#{i}": name for i, name in enumerate(
    ["Spinach", "Garlic", "Onion", "Carrot", "Parsley", "Arugula", "Kale", "Lettuce"], start=1)}


@query("species_filter_map", "SELECT p_partkey, p_brand, CASE p_brand " + " ".join(
    f"WHEN '{k}' THEN '{v}'" for k, v in NAMES.items()) + " ELSE 'Unknown' END AS plant_name FROM part "
    "WHERE p_brand IN ('Brand#1', 'Brand#3', 'Brand#5', 'Brand#7', 'Brand#9', 'Brand#11')")
def species_filter_map(spark, folder):
    rows = clean.keep_values(B.table(spark, folder, "part").select("p_partkey", "p_brand"), "p_brand",
                             [f"Brand#{i}" for i in (1, 3, 5, 7, 9, 11)])
    return clean.name_species(rows, "p_brand", NAMES)


@query("round_doubles", "SELECT l_orderkey, l_linenumber, round(l_extendedprice / 69827.0, 3) AS a, "
       "round(l_tax, 3) AS b FROM lineitem")
def round_doubles(spark, folder):
    return clean.round_doubles(B.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") / 69827.0).alias("a"),
        F.col("l_tax").alias("b")))


@query("event_ids", f"""SELECT DISTINCT l_suppkey, l_partkey,
    {sql.uuid_id('EVENT', 'CAST(l_suppkey AS VARCHAR)', f"'{B.AS_OF}'", 'CAST(l_partkey AS VARCHAR)')} AS event_id
    FROM lineitem""")
def event_ids(spark, folder):
    pairs = B.table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return pairs.withColumn("event_id", uuid_id("EVENT", "l_suppkey", F.lit(B.AS_OF), "l_partkey"))


@query("text_and_date_parts", """SELECT DISTINCT o_orderdate,
    strftime(o_orderdate, '%Y-%m-%d_%H-%M-%S') AS reading_time,
    strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day, CAST(o_orderdate AS DATE) AS folder_day,
    'S ' || o_orderstatus AS status FROM orders""")
def text_and_date_parts(spark, folder):
    path = F.concat(F.lit("root/"), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/status=S%20"),
                    F.col("o_orderstatus"), F.lit("/part.parquet"))
    return B.table(spark, folder, "orders").select("o_orderdate", "o_orderstatus").distinct().select(
        "o_orderdate", format_reading_time(F.col("o_orderdate")).alias("reading_time"),
        date_text(F.col("o_orderdate"), 1).alias("next_day"), folder_date(path).alias("folder_day"),
        partition_value(path, "status").alias("status"))


@query("numeric_casts", "SELECT p_partkey, TRY_CAST(substr(p_brand, 7) AS INTEGER) AS brand_number, "
       "TRY_CAST(p_name AS DOUBLE) AS no_number, p_retailprice AS price FROM part")
def numeric_casts(spark, folder):
    from arbolytics.functions.scalars import to_double, to_int

    return B.table(spark, folder, "part").select(
        "p_partkey", to_int(F.expr("substring(p_brand, 7)")).alias("brand_number"),
        to_double(F.col("p_name")).alias("no_number"),
        to_double(F.col("p_retailprice").cast("string")).alias("price"))


@query("device_mapping_check", """SELECT * FROM (SELECT l_orderkey, count(DISTINCT l_returnflag) AS n_l_returnflag,
    count(DISTINCT l_linestatus) AS n_l_linestatus FROM lineitem GROUP BY l_orderkey)
    WHERE n_l_returnflag > 1 OR n_l_linestatus > 1""")
def device_mapping_check(spark, folder):
    return quality.mapping_conflicts(B.table(spark, folder, "lineitem"), "l_orderkey",
                                     ["l_returnflag", "l_linestatus"])


CAPS = {"A": 150, "N": 180}  # the third group has none


@query("plants_per_device_cap", """SELECT * FROM (SELECT l_suppkey, l_returnflag,
    count(DISTINCT l_partkey) AS n_plants, CASE l_returnflag WHEN 'A' THEN 150 WHEN 'N' THEN 180 END AS cap
    FROM lineitem GROUP BY l_suppkey, l_returnflag) WHERE n_plants > cap OR cap IS NULL""")
def plants_per_device_cap(spark, folder):
    return quality.plants_over_cap(B.table(spark, folder, "lineitem"), "l_suppkey", "l_partkey",
                                   "l_returnflag", CAPS)


@query("missing_inputs", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def missing_inputs(spark, folder):
    from arbolytics.sources.intake import missing_inputs as missing

    found = B.table(spark, folder, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    return missing(found, B.table(spark, folder, "customer"), "c_custkey")


@query("process_once_intake", "SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY event_type")
def process_once_intake(spark, folder):
    """The same landing folder is taken three times, with one more file before the last."""
    from arbolytics.sources.intake import take_new_files

    events = B.table(spark, folder, "events").select("event_id", "event_type", "value")
    landing, target, checkpoint = (fresh_path(spark, n) for n in ("landing", "taken", "intake"))
    first = F.col("event_type").isin("click", "view")
    events.filter(first).write.json(landing)
    for _ in range(2):
        take_new_files(spark, landing, target, checkpoint, events.schema, rejects=f"{target}-rejects")
    events.filter(~first).write.mode("append").json(landing)
    take_new_files(spark, landing, target, checkpoint, events.schema, rejects=f"{target}-rejects")
    return (spark.read.schema(events.schema).parquet(target).groupBy("event_type")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total")))


# Every fifth user's messages are cut off, every seventh's time has another form.
@query("parse_quarantine", f"""WITH {sql.EVENT_READINGS}, bad AS (
    SELECT species_id, CAST(device_id AS BIGINT) % 5 = 0 AS cut, CAST(device_id AS BIGINT) % 7 = 0 AS other_time FROM er)
    SELECT species_id, false AS is_bad, count(*) AS n FROM bad WHERE NOT cut AND NOT other_time GROUP BY ALL
    UNION ALL SELECT species_id, true, count(*) FROM bad WHERE NOT cut AND other_time GROUP BY ALL
    UNION ALL SELECT NULL, true, count(*) FROM bad WHERE cut HAVING count(*) > 0""")
def parse_quarantine(spark, folder):
    readings = B.event_readings(B.table(spark, folder, "events"))
    user = F.col("device_id").cast("bigint")
    readings = readings.withColumn("timestamp", F.when(user % 7 == 0, F.replace(
        "timestamp", F.lit("_"), F.lit(" "))).otherwise(F.col("timestamp")))
    from arbolytics.sources.streams import envelope

    text = F.col("value").cast("string")
    cut = F.split_part(F.col("key").cast("string"), F.lit("_"), F.lit(1)).cast("bigint") % 5 == 0
    sent = envelope(readings).withColumn("value", F.when(cut, F.substring(text, 1, 20)).otherwise(text)
                                         .cast("binary"))
    parsed = parse_checked(sent)
    species = F.when(F.col("plant_id").isNotNull(), F.col("species_id")).alias("species_id")
    return parsed.groupBy(species, "is_bad").agg(F.count(F.lit(1)).alias("n"))


@query("message_keys", f"""WITH {sql.EVENT_READINGS}
    SELECT device_id || '_' || strftime(t, '%Y-%m-%d_%H-%M-%S') AS key, count(*) AS n FROM er GROUP BY 1""")
def message_keys(spark, folder):
    sent = B.event_messages(B.table(spark, folder, "events"))
    return sent.groupBy(F.col("key").cast("string").alias("key")).agg(F.count("value").alias("n"))


@query("value_mapping_chain", "SELECT event_type, CASE event_type WHEN 'click' THEN 'pointer' WHEN 'view' THEN 'page' "
       "END AS kind, count(*) AS n FROM events GROUP BY ALL")
def value_mapping_chain(spark, folder):
    kinds = {"click": "pointer", "view": "page"}
    counted = B.table(spark, folder, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    return counted.withColumn("kind", map_values(F.col("event_type"), kinds))


@query("event_ids_sql", f"""SELECT DISTINCT l_suppkey, l_partkey,
    {sql.uuid_id('EVENT', 'CAST(l_suppkey AS VARCHAR)', f"'{B.AS_OF}'", 'CAST(l_partkey AS VARCHAR)')} AS event_id
    FROM lineitem""")
def event_ids_sql(spark, folder):
    """The ids by the function that SQL text may call."""
    register_id_function(spark)
    pairs = B.table(spark, folder, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return pairs.withColumn("event_id", F.expr(
        f"uuid5_id('EVENT', array(CAST(l_suppkey AS STRING), '{B.AS_OF}', CAST(l_partkey AS STRING)))"))


@query("plant_pairs_split", "SELECT CAST(p_partkey AS VARCHAR) AS plant_id, substr(p_brand, 7) AS species_id, "
       "lower(p_brand) LIKE '%1' AS ends_in_one FROM part")
def plant_pairs_split(spark, folder):
    """Pairs written as ``plant:species`` and taken apart; a suffix test on both cases."""
    pairs = B.plants(spark, folder).select(F.concat_ws(":", "plant_id", "species_id").alias("pair"),
                                           F.concat(F.lit("BRAND#"), "species_id").alias("brand"))
    return pairs.select(plant_of_pair(F.col("pair")).alias("plant_id"), species_of_pair(F.col("pair")).alias("species_id"),
                        (has_suffix(F.col("brand"), "1")).alias("ends_in_one"))


@query("dated_folder", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders "
       "WHERE date_trunc('month', o_orderdate) = (SELECT max(date_trunc('month', o_orderdate)) FROM orders)")
def dated_folder(spark, folder):
    """All orders written to a folder per month, named by its first day; the newest folder read by itself."""
    root, orders = fresh_path(spark, "dated"), B.table(spark, folder, "orders")
    kept = orders.select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    first_day = date_text(F.trunc("o_orderdate", "month"))
    tables.write_partitioned(kept.withColumn("day", first_day), root, ["day"])
    newest = orders.agg(F.max(first_day)).first()[0]
    return files.read_dated(spark, root, f"day={newest}")


# Every fifth user's lines are cut off.
LINE_START = """substr('{"event_id":' || event_id || ',"user_id":' || user_id || ',', 1, 20)"""


@query("intake_two_outputs", f"""SELECT event_id, user_id, event_type, epoch_us(ts) AS micros, value, props, NULL AS raw, true AS read_once
    FROM events WHERE user_id % 5 <> 0
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, {LINE_START}, true FROM events WHERE user_id % 5 = 0""")
def intake_two_outputs(spark, folder):
    """All events landed in two lots and taken in three calls; readings and rejected lines from one reading of each file."""
    from arbolytics.sources import intake

    events = B.table(spark, folder, "events").withColumn("micros", F.unix_micros(F.col("ts").cast("timestamp"))).select(EVENT_COLUMNS)
    text = F.to_json(F.struct(*EVENT_COLUMNS))
    lines = events.select(F.when(F.col("user_id") % 5 == 0, F.substring(text, 1, 20)).otherwise(text).alias("line"), "event_id")
    landing, table, checkpoint = (fresh_path(spark, n) for n in ("landing", "taken", "intake"))
    n_read = 0
    for lot in (lines.filter("event_id % 2 = 0"), None, lines.filter("event_id % 2 <> 0")):
        if lot is not None:
            lot.select("line").write.mode("append").text(landing)
        query = intake.take_in_one_pass(spark, landing, table, checkpoint, events.schema)
        n_read += sum(p.numInputRows for p in query.recentProgress)
    good, bad = intake.taken(spark, table, events.schema), intake.rejected(spark, table, events.schema)
    none = [F.lit(None).cast(f.dataType).alias(f.name) for f in events.schema]
    return (good.withColumn("raw", F.lit(None).cast("string")).union(bad.select(*none, "raw"))
            .withColumn("read_once", F.lit(n_read == events.count())))


@query("gated_write", """SELECT *, (SELECT count(*) FROM orders) AS n_rows, (SELECT count(o_totalprice) FROM orders) AS n_prices, 3 AS refused
    FROM orders""")
def gated_write(spark, folder):
    """All orders published; an empty table, one without a column and one with nulls after it are refused, and the first stays."""
    orders, root = B.table(spark, folder, "orders"), fresh_path(spark, "gated")

    def write(df) -> bool:
        try:
            published.write_gated(df, root, orders.columns, ["o_orderkey", "o_totalprice"])
        except published.NotPublished:
            return False
        return True

    written = [write(df) for df in (orders, orders.filter("o_orderkey < 0"), orders.drop("o_custkey"),
                                    orders.withColumn("o_totalprice", F.nullif("o_totalprice", F.lit(0.0)) * F.lit(None)))]
    counts = published.manifest(spark, root)["counts"]
    return published.read_published(spark, root, orders.schema).select(
        "*", F.lit(counts["rows"]).alias("n_rows"), F.lit(counts["o_totalprice"]).alias("n_prices"), F.lit(written.count(False)).alias("refused"))


@query("scan_pruned_by_join", """SELECT l_orderkey, l_partkey, l_suppkey, l_quantity, n_name FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    WHERE r_name = 'ASIA'""")
def scan_pruned_by_join(spark, folder):
    """All readings written by garden; those of one city's gardens read by a join that opens only their folders."""
    root, sensors = fresh_path(spark, "by-garden"), B.sensors(spark, folder)
    rows = B.table(spark, folder, "lineitem").join(sensors.select("s_suppkey", "garden_id"), F.col("l_suppkey") == F.col("s_suppkey"))
    tables.write_partitioned(rows.select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "garden_id"), root, ["garden_id"])
    gardens = (B.table(spark, folder, "nation").join(B.table(spark, folder, "region").filter("r_name = 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"))
               .select(F.col("n_nationkey").cast("string").alias("garden_id"), "n_name"))
    return files.partitions_of(files.read_table(spark, root, text_partitions=["garden_id"]), gardens, "garden_id").drop("garden_id")
