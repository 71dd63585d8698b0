"""Archive and load queries over ``events``, ``lineitem`` and ``orders``."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from railstream import schemas
from railstream.constants import MAX_BAD_RECORDS
from railstream.plans import adapters
from railstream.plans.registry import nyc, query
from railstream.session import scratch_path
from railstream.sources import archives

_ORDER_FILE = T.StructType([
    T.StructField("order_id", T.LongType(), nullable=False),
    T.StructField("priority", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("ordered_at", T.TimestampType()),
])

# Bad records allowed per month in the strict queries; few enough for some months to fail.
_MAX_BAD = 5

_ORDER_ROWS = f"""WITH lines AS (SELECT *, strftime(o_orderdate, '%Y-%m') AS year_month,
    o_orderstatus = 'P' AND o_totalprice > 450000 AS bad FROM orders),
  counts AS (SELECT year_month, count(*) FILTER (NOT bad) AS good_rows,
    count(*) FILTER (bad) AS bad_rows FROM lines GROUP BY year_month)"""


def _order_files(spark, sf_dir):
    """Orders as month folders of CSV text without header lines."""
    root = scratch_path(spark, "months")
    lines = adapters.order_lines(adapters.table(spark, sf_dir, "orders"))
    lines.write.partitionBy("year_month", "file_name").text(root)
    return root


def _load_sql(max_bad: int) -> str:
    return _ORDER_ROWS + f"""
SELECT l.year_month, o_orderkey AS order_id, o_orderpriority || ', "x"' AS priority,
  o_totalprice AS price, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate END AS ordered_at
FROM lines l JOIN counts c ON l.year_month = c.year_month
WHERE NOT bad AND bad_rows <= {max_bad}"""


def _load(spark, sf_dir, max_bad):
    rows = archives.read_months(spark, _order_files(spark, sf_dir), _ORDER_FILE, header=False)
    target = scratch_path(spark, "loaded")
    archives.append_months(rows, target, max_bad=max_bad)
    stored = T.StructType([*_ORDER_FILE.fields, T.StructField("year_month", T.StringType())])
    return adapters.plain(spark.read.schema(stored).parquet(target))


@query("tolerant_csv_load", _load_sql(MAX_BAD_RECORDS))
def tolerant_csv_load(spark, sf_dir):
    return _load(spark, sf_dir, MAX_BAD_RECORDS)


@query("tolerant_csv_load_strict", _load_sql(_MAX_BAD))
def tolerant_csv_load_strict(spark, sf_dir):
    return _load(spark, sf_dir, _MAX_BAD)


_OUTCOMES = f"""{_ORDER_ROWS}, months AS (SELECT strftime(m, '%Y-%m') AS year_month FROM (
    SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)) - INTERVAL 3 MONTH,
      date_trunc('month', max(o_orderdate)) + INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS m FROM orders)),
  outcomes AS (SELECT m.year_month, CASE WHEN c.year_month IS NULL THEN 'empty'
      WHEN bad_rows > {_MAX_BAD} THEN 'failed' ELSE 'success' END AS status,
    CASE WHEN bad_rows > {_MAX_BAD} THEN 0 ELSE coalesce(good_rows, 0) END AS rows_loaded,
    coalesce(bad_rows, 0) AS bad_rows FROM months m LEFT JOIN counts c ON m.year_month = c.year_month)"""


def _outcomes(spark, sf_dir):
    orders = adapters.table(spark, sf_dir, "orders")
    root = _order_files(spark, sf_dir)
    first = orders.select(F.add_months(F.min("o_orderdate"), -3)).scalar()
    last = orders.select(F.add_months(F.max("o_orderdate"), 2)).scalar()
    return archives.month_outcomes(
        archives.month_spine(spark, first, last), archives.month_files(spark, root),
        archives.read_months(spark, root, _ORDER_FILE, header=False), max_bad=_MAX_BAD)


@query("month_outcomes", _OUTCOMES + " SELECT * FROM outcomes")
def month_outcomes(spark, sf_dir):
    return _outcomes(spark, sf_dir)


@query("month_load_report", _OUTCOMES + """ SELECT status, count(*) AS n_months,
  CAST(sum(rows_loaded) AS BIGINT) AS total_rows,
  string_agg(year_month, ', ' ORDER BY year_month) AS months FROM outcomes GROUP BY status""")
def month_load_report(spark, sf_dir):
    return archives.load_report(_outcomes(spark, sf_dir))


@query("month_files", """SELECT strftime(o_orderdate, '%Y-%m') AS year_month,
  'feed_' || strftime(o_orderdate, '%Y-%m') || '_stop_times.csv' AS file_name,
  CAST(sum(length(o_orderkey::VARCHAR) + 4) AS BIGINT) AS bytes FROM orders GROUP BY ALL""")
def month_files(spark, sf_dir):
    """Bytes of order keys alone: prices are written differently by the two engines."""
    root = scratch_path(spark, "keys")
    (adapters.order_lines(adapters.table(spark, sf_dir, "orders"))
     .where(archives.is_data_file(F.col("file_name")))
     .select("year_month", "file_name", F.concat(
         F.substring_index("value", ",", 1), F.lit(",x,")).alias("value"))
     .write.partitionBy("year_month", "file_name").text(root))
    return (archives.month_files(spark, root).groupBy("year_month", "file_name")
            .agg(F.sum("bytes").alias("bytes")))


@query("monthly_row_counts", """SELECT year(l_shipdate) AS year, month(l_shipdate) AS month,
  count(*) AS records FROM lineitem GROUP BY ALL""")
def monthly_row_counts(spark, sf_dir):
    return archives.monthly_counts(adapters.table(spark, sf_dir, "lineitem"), "l_shipdate")


@query("day_spine_missing", f"""WITH days AS (SELECT CAST(unnest(generate_series(
    CAST(min(ts) AS DATE) - 7, CAST(max(ts) AS DATE) + 7, INTERVAL 1 DAY)) AS DATE) AS service_date
  FROM events)
SELECT service_date FROM days WHERE service_date NOT IN (
  SELECT CAST({nyc("ts")} AS DATE) FROM events
  WHERE event_type = 'purchase' AND hour({nyc("ts")}) = 3)""", dates=("service_date",))
def day_spine_missing(spark, sf_dir):
    """Only some events stand for loaded days, so that there are gaps to find."""
    from railstream.functions import temporal

    events = adapters.table(spark, sf_dir, "events")
    first = events.select(F.date_sub(F.min("ts").cast("date"), 7)).scalar()
    last = events.select(F.date_add(F.max("ts").cast("date"), 7)).scalar()
    ts = adapters.instant("ts")
    night = (F.col("event_type") == "purchase") & (F.hour(temporal.wall_clock(ts)) == 3)
    loaded = events.where(night).select(temporal.local_date(ts).alias("service_date"))
    return archives.missing_days(archives.day_spine(spark, first, last), loaded)


@query("archive_expand", """SELECT CAST(ts AS DATE) AS service_date,
  strftime(ts, '%Y-%m') AS year_month, event_id, event_type FROM events""",
       dates=("service_date",))
def archive_expand(spark, sf_dir):
    packed = adapters.packed_days(adapters.table(spark, sf_dir, "events"))
    lines = archives.expand_archives(packed).where(
        archives.is_data_file(F.col("file_name")) & (F.col("line_no") > 1))
    fields = F.split("line", ",")
    return lines.select(F.col("service_date").cast("date").alias("service_date"), "year_month",
                        fields[0].cast("bigint").alias("event_id"), fields[1].alias("event_type"))


_DAYS = """SELECT CAST(ts AS DATE) AS service_date, count(*) AS n,
  CAST(sum(1 + length(concat_ws(',', event_id, event_type))) AS BIGINT) AS line_bytes
FROM events GROUP BY ALL"""


def _day_report(spark, sf_dir):
    packed = adapters.packed_days(adapters.table(spark, sf_dir, "events"))
    return archives.expansion_report(archives.expand_archives(packed))


@query("archive_status", f"""SELECT 'DECOMPRESSED' AS status, service_date,
  true AS two_members_each, line_bytes FROM ({_DAYS})""", dates=("service_date",))
def archive_status(spark, sf_dir):
    """A day may be split over several archives; each adds two members and twelve bytes of its own."""
    report = _day_report(spark, sf_dir)
    own = len("id,kind\n") + len("id\n1\n")
    return report.groupBy("status", F.col("service_date").cast("date").alias("service_date")).agg(
        (F.min("csv_files") == 2).alias("two_members_each"),
        (F.sum("bytes") - F.count("*") * F.lit(own)).alias("line_bytes"))


@query("archive_status_tally", f"""SELECT 'DECOMPRESSED' AS status, count(*) AS items,
  CAST(sum(line_bytes) AS BIGINT) AS bytes FROM ({_DAYS})""")
def archive_status_tally(spark, sf_dir):
    own = len("id,kind\n") + len("id\n1\n")
    days = (_day_report(spark, sf_dir).groupBy("service_date", "status")
            .agg((F.sum("bytes") - F.count("*") * F.lit(own)).alias("bytes")))
    return archives.status_tally(days, ["DECOMPRESSED"])


@query("archive_day_status", """SELECT CAST(ts AS DATE) AS service_date,
  CASE WHEN day(ts) % 2 = 0 THEN 'SKIPPED' ELSE 'DECOMPRESSED' END AS status FROM events GROUP BY ALL""",
       dates=("service_date",))
def archive_day_status(spark, sf_dir):
    """Archives of even days are there already: skipped, the others expanded."""
    packed = adapters.packed_days(adapters.table(spark, sf_dir, "events"))
    days = packed.select(F.col("path").alias("archive"),
                         archives.file_date(F.col("path")).alias("service_date"))
    even = F.day(F.col("service_date").cast("date")) % 2 == 0
    skipped = archives.skipped_archives(days, days.where(even).select("service_date"))
    new = packed.where(F.day(archives.file_date(F.col("path")).cast("date")) % 2 != 0)
    report = archives.expansion_report(archives.expand_archives(new)).unionByName(skipped)
    return report.select(F.col("service_date").cast("date").alias("service_date"), "status").distinct()


_FIELDS = """[{"name": "event_id", "type": "INTEGER", "mode": "REQUIRED", "description": "key"},
  {"name": "ts", "type": "TIMESTAMP"}, {"name": "event_type", "type": "STRING"}]"""


@query("schema_from_fields", """SELECT event_id, ts, event_type FROM events""")
def schema_from_fields(spark, sf_dir):
    """Events written as JSON text and read back with a schema made from a list of fields."""
    root = scratch_path(spark, "fields")
    schema = schemas.from_json_fields(_FIELDS)
    (adapters.table(spark, sf_dir, "events").withColumn("ts", adapters.instant("ts"))
     .select(*schema.fieldNames())
     .write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(root))
    return adapters.plain(spark.read.schema(schema).json(root))
