"""Fleet-shaped raw tables, projected from the generic test tables.

Whole tables in, whole tables out; every value is integer arithmetic, or a
division that both engines round alike, so that SQL can restate it. Ids are
padded but never cut, so they stay unique however large the input is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that planning a query opens no file to infer a schema.
SOURCE_SCHEMAS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, value double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_size int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
}


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCE_SCHEMAS[table]).parquet(f"{sf_dir}/{table}.parquet")


def _id(prefix: str, number: Column, width: int) -> Column:
    text = number.cast("string")
    return F.concat(F.lit(prefix), F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0")))


def _pick(index: Column, values: list[str]) -> Column:
    out = F.lit(values[-1])
    for i, value in reversed(list(enumerate(values[:-1]))):
        out = F.when(index == i, value).otherwise(out)
    return out


def gps_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, user = F.col("event_id"), F.col("user_id")
    vehicle = user % 20
    return _read(spark, sf_dir, "events").select(
        _id("EV-", n, 7).alias("event_id"),
        _id("VH-", vehicle + 1, 6).alias("vehicle_id"),
        _id("RT-", (vehicle + (n % 3) * 9) % 27 + 1, 4).alias("route_id"),
        (F.lit(29.45) + (n * 7919 % 7001) / F.lit(10000.0)).alias("lat"),
        (F.lit(-95.85) + (n * 104729 % 8001) / F.lit(10000.0)).alias("lon"),
        (F.round(F.col("value") * 100).cast("bigint") % 801 / F.lit(10.0)).alias("speed_mph"),
        (n * 37 % 360).cast("int").alias("heading_deg"),
        F.col("ts").cast("timestamp_ntz").alias("event_ts"),
        F.col("ts").cast("date").alias("event_date"),
    )


def routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _read(spark, sf_dir, "nation"), _read(spark, sf_dir, "region")
    n = F.col("n_nationkey")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        _id("RT-", n + 1, 4).alias("route_id"),
        F.col("n_name").alias("route_name"),
        F.col("r_name").alias("zone"),
        F.concat(F.lit("District-"), (n % 5 + 1).cast("string")).alias("district"),
        (n % 17 + 4).cast("int").alias("total_stops"),
        F.to_timestamp_ntz(F.concat(F.date_add(F.lit("2023-01-01"), n).cast("string"),
                                    F.lit(" 06:00:00"))).alias("created_at"),
    )


def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("p_partkey")
    turn = n % 20
    status = F.when(turn < 15, "active").when(turn < 18, "inactive").otherwise("maintenance")
    return _read(spark, sf_dir, "part").select(
        _id("VH-", n + 1, 6).alias("vehicle_id"),
        F.col("p_brand").alias("make"),
        F.col("p_name").alias("model"),
        (F.col("p_size") % 10 + 2015).cast("int").alias("year"),
        _pick(n % 3, ["light", "medium", "heavy"]).alias("vehicle_class"),
        status.alias("status"),
        _id("VIN", n * 31 + 7, 12).alias("vin"),
        _id("TX-", n * 17 % 100000, 5).alias("license_plate"),
    )


def stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("s_suppkey")
    return _read(spark, sf_dir, "supplier").select(
        _id("ST-", n + 1, 5).alias("stop_id"),
        _id("RT-", F.col("s_nationkey") + 1, 4).alias("route_id"),
        F.col("s_name").alias("stop_name"),
        (n % 20 + 1).cast("int").alias("stop_sequence"),
        (F.lit(29.5) + (n * 37 % 600) / F.lit(1000.0)).alias("lat"),
        (F.lit(-95.8) + (n * 53 % 700) / F.lit(1000.0)).alias("lon"),
        _pick(n % 4, ["pickup", "dropoff", "transfer", "depot"]).alias("stop_type"),
    )


def maintenance_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.col("o_orderkey")
    return _read(spark, sf_dir, "orders").select(
        _id("ML-", n + 1, 6).alias("log_id"),
        _id("VH-", F.col("o_custkey") + 1, 6).alias("vehicle_id"),
        F.col("o_orderpriority").alias("service_type"),
        F.col("o_orderdate").cast("date").alias("service_date"),
        (F.col("o_totalprice") / F.lit(100.0)).alias("cost_usd"),
        (n * 41 % 245001 + 5000).cast("int").alias("mileage_at_service"),
        F.concat(F.lit("Tech-"), (n % 40 + 1).cast("string")).alias("technician"),
        F.concat(F.lit("order status "), F.col("o_orderstatus")).alias("notes"),
    )


RAW = {
    "routes": routes,
    "vehicles": vehicles,
    "stops": stops,
    "gps_events": gps_events,
    "maintenance_logs": maintenance_logs,
}


def _spoilt(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Columns replaced by rules that see the columns as they were."""
    return df.select(*[rules[c].alias(c) if c in rules else F.col(c) for c in df.columns])


def dirty(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The raw tables with missing, repeated, unknown and impossible values, by the numbers of their ids."""
    number = lambda c: F.substring(c, 4, 30).cast("bigint")
    hit = lambda c, every, bad, column: F.when(number(c) % every == 0, bad).otherwise(F.col(column))
    none = F.lit(None)
    return {
        "routes": _spoilt(routes(spark, sf_dir), {
            "route_id": hit("route_id", 12, "RT-0001", "route_id"),
            "zone": hit("route_id", 7, none, "zone"),
            "total_stops": hit("route_id", 5, 0, "total_stops"),
        }),
        "vehicles": _spoilt(vehicles(spark, sf_dir), {
            "vehicle_id": hit("vehicle_id", 97, "VH-000001", "vehicle_id"),
            "vehicle_class": hit("vehicle_id", 11, "tank", "vehicle_class"),
            "status": hit("vehicle_id", 13, none, "status"),
            "year": hit("vehicle_id", 17, 2009, "year"),
        }),
        "gps_events": _spoilt(gps_events(spark, sf_dir), {
            "event_id": F.when(number("event_id") % 101 == 0, none).otherwise(
                hit("event_id", 103, "EV-0000001", "event_id")),
            "vehicle_id": hit("event_id", 89, none, "vehicle_id"),
            "route_id": hit("event_id", 83, none, "route_id"),
            "speed_mph": F.when(number("event_id") % 79 == 0, none).otherwise(
                hit("event_id", 73, 150.0, "speed_mph")),
        }),
        "maintenance_logs": _spoilt(maintenance_logs(spark, sf_dir), {
            "log_id": hit("log_id", 29, none, "log_id"),  # never repeated: one uniqueness check that passes
            "vehicle_id": hit("log_id", 31, none, "vehicle_id"),
            "cost_usd": F.when(number("log_id") % 19 == 0, -F.col("cost_usd")).otherwise(
                hit("log_id", 23, none, "cost_usd")),
        }),
    }


def dirty_gps_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ping table as lines of a landed file, ``line``, with every fault that a load must tell.

    Missing values and keys, bad, non-finite and enormous numbers, quoted fields
    with doubled quotes, short and long lines, an id that is too long.
    """
    events = _read(spark, sf_dir, "events")
    n, text = F.col("event_id"), lambda c: c.cast("string")
    vehicle = F.col("user_id") % 20
    event_id = F.when(n % 40 == 7, "").otherwise(_id("EV-", n, 7))
    route_id = _id("RT-", (vehicle + (n % 3) * 9) % 27 + 1, 4)
    route_id = F.when(n % 70 == 11, F.concat(route_id, F.lit("-" + "9" * 20))).when(n % 70 == 12, '"RT-""7"" a, b"').otherwise(route_id)
    speed = F.concat(text(n % 80), F.lit(".5"))
    for rest, value in enumerate(["bad", "NULL", "", "null", "1e15", "NaN", "-Infinity", "1e300"]):
        speed = F.when(n % 50 == rest, value).otherwise(speed)
    fields = [
        event_id,
        F.when(n % 3 == 0, F.concat(F.lit('"'), _id("VH-", vehicle + 1, 6), F.lit('"'))).otherwise(_id("VH-", vehicle + 1, 6)),
        route_id,
        text(F.lit(29.45) + (n * 7919 % 7001) / F.lit(10000.0)),
        text(F.lit(-95.85) + (n * 104729 % 8001) / F.lit(10000.0)),
        speed,
        F.when(n % 60 == 5, "12.x").otherwise(text(n % 360)),
        text(F.col("ts").cast("timestamp_ntz")),
    ]
    day = F.when(n % 70 == 9, "").when(n % 70 == 10, F.concat(F.lit(","), text(F.col("ts").cast("date")), F.lit(",more"))).otherwise(
        F.concat(F.lit(","), text(F.col("ts").cast("date"))))
    return events.select(F.concat(F.concat_ws(",", *fields), day).alias("line"))


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The service logs as lines of files, ``file, split, at, line``, as a reader of many splits gets them.

    Notes hold newlines, commas, doubled and stray quotes; a split ends wherever it does, also within a note.
    """
    n, text = F.col("o_orderkey"), lambda c: F.col(c).cast("string")
    logs = maintenance_logs(spark, sf_dir).withColumn("o_orderkey", F.substring("log_id", 4, 30).cast("bigint") - 1)
    notes = _pick(n % 5, ["plain", '"first\nsecond ""line"", end"', '"\n,\n"', '"a, ""b"""', 'say "hi'])
    row = F.concat_ws(",", *[text(c) for c in ("log_id", "vehicle_id", "service_type", "service_date", "cost_usd", "mileage_at_service",
                                               "technician")], notes)
    lines = logs.select(n, F.posexplode(F.split(row, "\n")).alias("nth", "line"))
    at = n % 1000 * 4 + F.col("nth")  # a row has three lines at most
    return lines.select(F.concat(F.lit("file-"), F.floor(n / 1000).cast("string")).alias("file"),
                        F.floor(at / 101).alias("split"), at.alias("at"), "line")


def reloaded_pings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The spoilt pings in three batches (``unit``), and what batch 1 holds after it has landed anew."""
    pings = dirty(spark, sf_dir)["gps_events"].withColumn("unit", F.second("event_ts") % 3)
    minute = F.minute("event_ts")
    again = pings.where("unit = 1").where(minute % 5 != 0).withColumn(
        "event_id", F.when(minute % 7 == 0, "EV-0000002").otherwise(F.col("event_id")))
    return pings, again


def pings_without_speeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pings of which one route and two vehicles have no speed at all."""
    none = F.col("route_id").isin("RT-0003") | F.col("vehicle_id").isin("VH-000004", "VH-000009")
    return _spoilt(gps_events(spark, sf_dir), {"speed_mph": F.when(~none, F.col("speed_mph"))})
