"""The given tables, seen as transit data.

Apart from the stop and trip tables, every adapter is a projection row by row: no
grouping, so it scales like the scan below it.
"""

from __future__ import annotations

import io
import sys
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railstream import schemas

# Python workers get the packing function by value (see railstream.sources.archives).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """A table dealt out evenly, for work that is heavy per row."""
    return df.hint("rebalance")


def spread_finely(df: DataFrame) -> DataFrame:
    """The same in as many parts as a shuffle has, for narrow rows that become many. Parts of the
    advised size would be few then, and the last of them leave cores without work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a streaming source, a file to a batch; also fits a table in a single file."""
    schema = table(spark, sf_dir, name).schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .parquet(f"{sf_dir}/{name}.parque[t]"))


def instant(column: str) -> Column:
    return F.col(column).cast("timestamp")


def plain(df: DataFrame) -> DataFrame:
    """Instants as timestamps without a zone, as the other engine's tables have them."""
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name)
                       if f.dataType.typeName() == "timestamp" else F.col(f.name)
                       for f in df.schema.fields])


def _lat() -> Column:
    return F.lit(40.0) + F.length("event_type") * F.lit(0.5)


def _lon() -> Column:
    return F.lit(-74.0) - F.length("event_type") * F.lit(0.25)


def positions(events: DataFrame, *, hourly: bool = True) -> DataFrame:
    """Reports of ten trips at one station per event type; ``hourly`` makes equal times."""
    ts = instant("ts")
    return events.select(
        F.col("event_type").alias("stop_name"), _lat().alias("stop_lat"), _lon().alias("stop_lon"),
        (F.col("user_id") % 10).cast("string").alias("trip_id"),
        (F.date_trunc("hour", ts) if hourly else ts).alias("vehicle_timestamp"),
        F.when(F.col("event_id") % 2 == 1, "Southbound").otherwise("Northbound").alias("direction"))


def visits(events: DataFrame) -> DataFrame:
    """Reports of one trip per user at thirty stations."""
    return events.select(
        F.concat(F.lit("Station "), (F.col("user_id") % 30).cast("string")).alias("stop_name"),
        F.concat_ws("-", "event_type", "user_id").alias("trip_id"),
        instant("ts").alias("vehicle_timestamp"))


def raw_stop_id() -> Column:
    """Stop ids in the spellings the feed may use, by event id."""
    key = F.col("user_id").cast("string")
    forms = [F.concat(F.lit("A"), key), F.concat(F.lit("A"), key, F.lit("N")),
             F.concat(F.lit("a"), key), F.concat(F.lit("a"), key, F.lit("s")),
             F.concat(F.lit(" A"), key, F.lit("S "))]
    form = F.col("event_id") % 5
    return F.when(form == 0, forms[0]).when(form == 1, forms[1]).when(form == 2, forms[2]) \
            .when(form == 3, forms[3]).otherwise(forms[4])


def reports(events: DataFrame) -> DataFrame:
    """Flat reports (``schemas.POSITIONS``) before enrichment."""
    given = {
        "entity_id": F.col("event_id").cast("string"),
        "trip_id": F.col("user_id").cast("string"),
        "stop_id": raw_stop_id(),
        "vehicle_timestamp": F.timestamp_seconds(F.unix_seconds(instant("ts"))),
        "current_status": F.col("event_type"),
    }
    return events.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                           for f in schemas.POSITIONS.fields])


def messages(events: DataFrame) -> DataFrame:
    """One feed message per event: a vehicle, and a trip update with 0 to 3 stops."""
    second = F.unix_seconds(instant("ts"))
    trip = F.struct(F.col("user_id").cast("string").alias("trip_id"),
                    F.lit("E").alias("route_id"))
    vehicle = F.struct(trip.alias("trip"), raw_stop_id().alias("stop_id"),
                       F.col("event_type").alias("current_status"),
                       (F.col("event_id") % 40).alias("current_stop_sequence"),
                       second.cast("string").alias("timestamp"))
    stops = F.expr("filter(transform(array(1, 2, 3), i -> named_struct('stop_id', "
                   "concat('T', i))), (s, i) -> i < user_id % 4)")
    update = F.struct(trip.alias("trip"), stops.alias("stop_time_update"))
    entity = F.array(
        F.struct(F.concat(F.lit("v"), F.col("event_id")).alias("id"), vehicle.alias("vehicle"),
                 F.lit(None).cast(update_type()).alias("trip_update")),
        F.struct(F.concat(F.lit("t"), F.col("event_id")).alias("id"),
                 F.lit(None).cast(vehicle_type()).alias("vehicle"), update.alias("trip_update")))
    header = F.struct((F.floor(second / 30) * 30).cast("string").alias("timestamp"))
    return spread(events).select("event_id", F.to_json(F.struct(
        header.alias("header"), entity.alias("entity"),
        F.concat(F.lit("m"), F.col("event_id")).alias("unique_event_id"))).alias("value"))


def _once(value: Column, make) -> Column:
    """``make(value)`` with the value computed once, however often it is used."""
    return F.transform(F.array(value), make)[0]


def _number_bytes(number: Column) -> Column:
    """A whole number below 2^35 in seven bits a byte, the lowest first."""
    def all_bytes(n: Column) -> Column:
        def byte(i: int) -> Column:
            more = F.when(n >= F.lit(1 << 7 * (i + 1)), 128).otherwise(0)
            text = F.lpad(F.hex(F.shiftright(n, 7 * i).bitwiseAND(127) + more), 2, "0")
            return F.when((n >= F.lit(1 << 7 * i)) | F.lit(i == 0), text).otherwise("")
        return F.unhex(F.concat(*[byte(i) for i in range(5)]))
    return _once(number, all_bytes)


def _field(number: int, value: Column, *, of_bytes: bool = True) -> Column:
    """A field of a protocol buffer; none where the value is NULL."""
    tag = F.unhex(F.lit(f"{number << 3 | 2 * of_bytes:02X}"))

    def field(v: Column) -> Column:
        if of_bytes:
            return F.concat(tag, _number_bytes(F.octet_length(v).cast("bigint")), v)
        return F.concat(tag, _number_bytes(v))

    found = _once(value.cast("binary" if of_bytes else "bigint"), field)
    return F.coalesce(found, F.unhex(F.lit("")))


def binary_messages(events: DataFrame) -> DataFrame:
    """The vehicles and trip updates of ``messages`` as protocol buffers. Statuses are those of the
    format, by event id; every seventh report has none."""
    second = F.unix_seconds(instant("ts"))
    trip = F.concat(_field(1, F.col("user_id").cast("string")), _field(5, F.lit("E")))
    status = F.when(F.col("event_id") % 7 != 0, F.col("event_id") % 3)
    vehicle = F.concat(_field(1, trip), _field(3, F.col("event_id") % 40, of_bytes=False),
                       _field(4, status, of_bytes=False), _field(5, second, of_bytes=False),
                       _field(7, raw_stop_id()))
    stops = [F.when(F.col("user_id") % 4 >= i, F.concat(_field(1, F.lit(i), of_bytes=False),
                                                        _field(4, F.lit(f"T{i}")))) for i in (1, 2, 3)]
    update = F.concat(_field(1, trip), *[_field(2, stop) for stop in stops])
    header = F.concat(_field(1, F.lit("2.0")),
                      _field(3, F.floor(second / 30) * 30, of_bytes=False))
    entities = [F.concat(_field(1, F.concat(F.lit("v"), F.col("event_id"))), _field(4, vehicle)),
                F.concat(_field(1, F.concat(F.lit("t"), F.col("event_id"))), _field(3, update))]
    return spread(events).select("event_id", F.concat(
        _field(1, header), *[_field(2, e) for e in entities]).alias("value"))


def update_type() -> str:
    return ("struct<trip: struct<trip_id: string, route_id: string>, "
            "stop_time_update: array<struct<stop_id: string>>>")


def vehicle_type() -> str:
    return ("struct<trip: struct<trip_id: string, route_id: string>, stop_id: string, "
            "current_status: string, current_stop_sequence: bigint, timestamp: string>")


def trip_messages(lineitem: DataFrame) -> DataFrame:
    """One message per line item: a trip update with as many stops as its line number."""
    entity = F.array(F.struct(
        F.col("l_partkey").cast("string").alias("id"),
        F.struct(
            F.struct(F.col("l_orderkey").cast("string").alias("trip_id")).alias("trip"),
            F.expr("transform(sequence(1, l_linenumber), "
                   "i -> named_struct('stop_id', concat(l_suppkey, '-', i)))")
             .alias("stop_time_update")).alias("trip_update")))
    return spread_finely(lineitem).select(F.to_json(F.struct(
        F.struct(F.unix_seconds(instant("l_shipdate")).cast("string").alias("timestamp"))
         .alias("header"), entity.alias("entity"))).alias("value"))


def short_payloads(events: DataFrame) -> DataFrame:
    """Small payloads whose exact text another engine can rebuild."""
    return events.select("event_id", F.concat(
        F.lit('{"header":{"timestamp":"'), F.unix_seconds(instant("ts")).cast("string"),
        F.lit('"},"entity":[{"id":"'), F.col("event_id").cast("string"),
        F.lit('"}]}')).alias("value"))


def stops(supplier: DataFrame) -> DataFrame:
    """One stop per supplier."""
    return supplier.select(
        F.concat(F.lit("A"), F.col("s_suppkey").cast("string")).alias("stop_id"),
        F.concat(F.col("s_name"), F.lit(', "upper" level')).alias("stop_name"),
        (F.lit(40.0) + F.col("s_nationkey") * F.lit(0.5)).alias("stop_lat"),
        (F.lit(-74.0) - F.col("s_nationkey") * F.lit(0.25)).alias("stop_lon"),
        (F.col("s_suppkey") % 2).alias("location_type"),
        F.when(F.col("s_suppkey") % 3 == 0, F.lit(None))
         .otherwise(F.concat(F.lit("P"), F.col("s_nationkey").cast("string")))
         .alias("parent_station"))


def stop_times(events: DataFrame) -> DataFrame:
    """Stop times (``schemas.STOP_TIMES``): one trip per user, one stop per event type."""
    ts = instant("ts")
    return events.select(
        F.col("user_id").cast("string").alias("trip_uid"),
        F.date_trunc("day", ts).alias("start_time_dts"),
        F.lit("E").alias("route_id"), F.lit("S").alias("direction"),
        F.col("event_id").cast("string").alias("stop_id"),
        F.col("event_type").alias("stop_name"), _lat().alias("stop_lat"), _lon().alias("stop_lon"),
        ts.alias("arrival_time"),
        F.timestamp_seconds(F.unix_seconds(ts) + 30).alias("departure_time"))


def sensor_data(events: DataFrame) -> DataFrame:
    """Historical observations (``schemas.SENSOR_DATA``), stops named as in ``stops``."""
    ts = instant("ts")
    none = F.lit(None).cast("timestamp")
    return events.select(
        F.col("user_id").cast("string").alias("trip_uid"),
        F.concat(F.lit("A"), (F.col("event_id") % 120).cast("string")).alias("stop_id"),
        F.col("event_type").alias("track"), ts.alias("arrival_time"),
        F.timestamp_seconds(F.unix_seconds(ts) + 30).alias("departure_time"),
        none.alias("last_observed"), none.alias("marked_past"))


def trips(events: DataFrame) -> DataFrame:
    """One trip per user, starting with the user's first event."""
    return (events.groupBy("user_id").agg(F.min(instant("ts")).alias("start_time_dts"))
            .select(F.col("user_id").cast("string").alias("trip_uid"), "start_time_dts",
                    F.lit("E").alias("route_id"), F.lit("S").alias("direction")))


def order_lines(orders: DataFrame) -> DataFrame:
    """Orders as CSV text by month, with the flaws of real files.

    Low-priority orders lack the last field, urgent ones have a surplus one, and the price
    of a pending order over 450,000 is not a number. Each order also has a line in a
    trips file.
    """
    month = F.date_format("o_orderdate", "yyyy-MM")
    broken = (F.col("o_orderstatus") == "P") & (F.col("o_totalprice") > 450000)
    fields = [F.col("o_orderkey").cast("string"),
              F.concat(F.lit('"'), F.col("o_orderpriority"), F.lit(', ""x"""')),
              F.when(broken, "n/a").otherwise(F.col("o_totalprice").cast("string"))]
    when = F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    priority = F.col("o_orderpriority")
    line = F.when(priority == "5-LOW", F.concat_ws(",", *fields)) \
            .when(priority == "1-URGENT", F.concat_ws(",", *fields, when, F.lit("surplus"))) \
            .otherwise(F.concat_ws(",", *fields, when))
    name = F.concat(F.lit("feed_"), month)
    rows = F.array(
        F.struct(F.concat(name, F.lit("_stop_times.csv")).alias("file_name"), line.alias("value")),
        F.struct(F.concat(name, F.lit("_trips.csv")).alias("file_name"),
                 F.col("o_orderkey").cast("string").alias("value")))
    return orders.select(month.alias("year_month"), F.inline(rows))


_PACKED = pa.schema([("path", pa.string()), ("content", pa.binary())])


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        days: dict[str, list[str]] = {}
        for day, line in zip(batch.column("day").to_pylist(), batch.column("line").to_pylist()):
            days.setdefault(day, []).append(line)
        for day, lines in days.items():
            # The number of the batch's first row tells the archives of a day apart.
            path = f"raw/{batch.column('row')[0]}/feed_{day}_csv.tar.xz"
            packed = io.BytesIO()
            with tarfile.open(fileobj=packed, mode="w:xz", preset=0) as archive:
                for name, text in ((f"feed_{day}_stop_times.csv", ["id,kind", *lines]),
                                   (f"feed_{day}_trips.csv", ["id", "1"])):
                    body = ("\n".join(text) + "\n").encode()
                    member = tarfile.TarInfo(f"out/{name}")
                    member.size = len(body)
                    archive.addfile(member, io.BytesIO(body))
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([packed.getvalue()])], schema=_PACKED)


def packed_days(events: DataFrame) -> DataFrame:
    """Events as ``.tar.xz`` archives (``path``, ``content``), one per day and batch of rows, each
    under a path of its own."""
    return (spread(events).select(F.date_format("ts", "yyyy-MM-dd").alias("day"),
                          F.concat_ws(",", F.col("event_id").cast("string"), "event_type")
                           .alias("line"), F.monotonically_increasing_id().alias("row"))
            .mapInArrow(_pack, "path string, content binary"))
