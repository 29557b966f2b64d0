"""Queries: event streams.  Each runs a stream over the whole table and reads its sink back."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.layout import total_bytes
from weftline.plans.registry import money, query, table
from weftline.streaming import feed, fraud, joins, profiles, run, sources, windows
from weftline.workspace import workspace

BATCH_BYTES = feed.BATCH_BYTES
GROUP_BYTES = 1 << 21
LEAST_GROUPS = 256
HOT_COPIES = 4  # groups that share the events of a driver
HOT_BATCH_BYTES = 1 << 27  # where a few keys have all events: a task holds those of a key in one batch


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    # In braces the file name is a pattern, so it may be one file or a folder of files.
    path = f"{sf_dir}/{{{name}}}.parquet"
    return sources.file_stream(spark, path, table(spark, sf_dir, name).schema)


def _result(
    spark: SparkSession, sf_dir: str, purpose: str, build: feed.Build, batch_bytes: int | None = None
) -> DataFrame:
    """The results of a query over the events, fed in order of their time; see ``feed.run_in_order``."""
    return feed.run_in_order(table(spark, sf_dir, "events"), "ts", build, purpose, batch_bytes or BATCH_BYTES)


def _rides(events: DataFrame) -> DataFrame:
    """events as rides; there are ten drivers."""
    return events.select(
        F.col("event_id").alias("ride_id"),
        F.col("user_id").alias("customer_id"),
        (F.col("user_id") % 10).alias("driver_id"),
        money("value").alias("fare"),
        F.col("ts").cast("timestamp").alias("event_time"),
    )


RIDES_SQL = """
    WITH rides AS (SELECT event_id AS ride_id, user_id AS customer_id, user_id % 10 AS driver_id,
                          CAST(value AS DECIMAL(18, 2)) AS fare, ts AS event_time FROM events)
"""


def closed_sql(delay: str) -> str:
    """The watermark after all rows; append mode has sent the windows that end by then."""
    return f", closed AS (SELECT max(event_time) - INTERVAL {delay} AS watermark FROM rides)"


def _plain(df: DataFrame) -> DataFrame:
    """Window bounds and event time without a zone, fares as stored."""
    plain = {
        c: F.col(c).cast("timestamp_ntz")
        for c in ("window_start", "window_end", "event_time")
        if c in df.columns
    }
    plain |= {c: F.col(c).cast("double") for c in ("fare", "total_fare") if c in df.columns}
    return df.withColumns(plain)


DECODED = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def _messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.encode_json(_stream(spark, sf_dir, "events"), "ts", "event_id")


DECODED_SQL = "SELECT event_id, user_id, event_type, value, props, ts AS event_time FROM events"


@query("stream_decode_json", DECODED_SQL)
def _decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return sources.decode_json(sources.encode_json(events, "ts", "event_id"), DECODED)

    return _plain(_result(spark, sf_dir, "decoded", build))


@query("stream_micro_batch", DECODED_SQL)
def _micro_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark, "micro-batch")
    decoded = sources.decode_json(_messages(spark, sf_dir), DECODED)
    started = run.start_micro_batch(decoded, path)
    try:
        started.processAllAvailable()
    finally:
        started.stop()
    return _plain(spark.read.schema(decoded.schema).parquet(path))


@query(
    "stream_sink_table",
    """SELECT 'customers' AS topic, count(*) AS n, sum(c_custkey)::BIGINT AS keys FROM customer
       UNION ALL SELECT 'drivers', count(*), sum(s_suppkey)::BIGINT FROM supplier
       UNION ALL SELECT 'rides', count(*), sum(event_id)::BIGINT FROM events""",
)
def _sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    streams = {
        "customers": _stream(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key")),
        "drivers": _stream(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key")),
        "rides": _stream(spark, sf_dir, "events").select(F.col("event_id").alias("key")),
    }
    root = workspace(spark, "topics")
    for started in run.start_tables(streams, root, available_now=True).values():
        run.drain(started)
    counts = [
        spark.read.schema("key BIGINT")
        .parquet(f"{root}/{name}")
        .agg(F.lit(name).alias("topic"), F.count("*").alias("n"), F.sum("key").alias("keys"))
        for name in streams
    ]
    return counts[0].union(counts[1]).union(counts[2])


SLIDING_SQL = (
    RIDES_SQL
    + closed_sql("1 minute")
    + """, starts AS (
        SELECT customer_id, event_time,
               time_bucket(INTERVAL 2 minute, event_time, TIMESTAMP '1970-01-01')
                   - to_minutes(CAST(2 * i AS INT)) AS window_start
        FROM rides, range(3) r(i))
    SELECT window_start, window_start + INTERVAL 5 minute AS window_end, customer_id,
           count(*) AS activity_count
    FROM starts, closed
    WHERE window_start + INTERVAL 5 minute > event_time
      AND window_start + INTERVAL 5 minute <= watermark
    GROUP BY window_start, customer_id"""
)


@query("stream_sliding_count", SLIDING_SQL)
def _sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        _result(
            spark, sf_dir, "sliding", lambda e: windows.sliding_count(_rides(e), "customer_id")
        )
    )


@query(
    "stream_session_count",
    RIDES_SQL
    + closed_sql("5 minute")
    + """, marked AS (
        SELECT *, CASE WHEN event_time - lag(event_time) OVER w <= INTERVAL 10 minute
                       THEN 0 ELSE 1 END AS starts
        FROM rides WINDOW w AS (PARTITION BY driver_id ORDER BY event_time)),
    numbered AS (
        SELECT *, sum(starts) OVER (PARTITION BY driver_id ORDER BY event_time
                                    ROWS UNBOUNDED PRECEDING) AS session FROM marked),
    sessions AS (
        SELECT driver_id, min(event_time) AS window_start,
               max(event_time) + INTERVAL 10 minute AS window_end, count(*) AS session_count
        FROM numbered GROUP BY driver_id, session)
    SELECT sessions.* FROM sessions, closed WHERE window_end <= watermark""",
)
def _sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain(
        _result(spark, sf_dir, "sessions", lambda e: windows.session_count(_rides(e), "driver_id"))
    )


@query(
    "stream_tumbling_agg",
    RIDES_SQL
    + closed_sql("1 minute")
    + """SELECT date_trunc('hour', event_time) AS window_start,
                date_trunc('hour', event_time) + INTERVAL 1 hour AS window_end, driver_id,
                CAST(sum(fare) AS DOUBLE) AS total_fare, count(ride_id) AS ride_count
         FROM rides, closed
         WHERE date_trunc('hour', event_time) + INTERVAL 1 hour <= watermark
         GROUP BY date_trunc('hour', event_time), driver_id""",
)
def _tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return windows.tumbling_agg(
            _rides(events), "driver_id", "fare", "ride_id", length="1 hour"
        )

    return _plain(_result(spark, sf_dir, "tumbling", build))


def _profiles(spark: SparkSession, sf_dir: str, name: str, columns: dict[str, str]) -> DataFrame:
    """A profile stream whose rows are valid from the first event on."""
    since = table(spark, sf_dir, "events").agg(F.min("ts")).first()[0]
    return _stream(spark, sf_dir, name).select(
        *[F.col(source).alias(target) for source, target in columns.items()],
        F.lit(since).cast("timestamp").alias("event_time"),
    )


def _groups(profiles: DataFrame) -> int:
    """Groups of keys of which each holds about GROUP_BYTES of profiles."""
    return max(LEAST_GROUPS, math.ceil(total_bytes(profiles) / GROUP_BYTES))


CUSTOMERS = {"c_custkey": "customer_id", "c_name": "customer_name"}
DRIVERS = {"s_suppkey": "driver_id", "s_name": "driver_name"}


@query(
    "stream_join_inner",
    RIDES_SQL
    + """SELECT ride_id, customer_id, driver_id, CAST(fare AS DOUBLE) AS fare, event_time,
                c_name AS customer_name
         FROM rides JOIN customer ON customer_id = c_custkey""",
)
def _join(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        customers = _profiles(spark, sf_dir, "customer", CUSTOMERS)
        return profiles.join_latest(_rides(events), customers, "customer_id")

    return _plain(_result(spark, sf_dir, "rides-customers", build))


@query(
    "stream_join_three_way",
    RIDES_SQL
    + """SELECT ride_id, customer_id, driver_id, CAST(fare AS DOUBLE) AS fare, event_time,
                c_name AS customer_name, s_name AS driver_name
         FROM rides JOIN customer ON customer_id = c_custkey
         JOIN supplier ON driver_id = s_suppkey""",
)
def _join_three(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        customers = _profiles(spark, sf_dir, "customer", CUSTOMERS)
        drivers = _profiles(spark, sf_dir, "supplier", DRIVERS)
        groups = {name: _groups(table(spark, sf_dir, name)) for name in ("customer", "supplier")}
        enriched = profiles.join_latest(_rides(events), customers, "customer_id", groups=groups["customer"])
        return profiles.join_latest(
            enriched, drivers, "driver_id", delays=(None, "1 minute"), groups=groups["supplier"], copies=HOT_COPIES
        )

    batch_bytes = min(BATCH_BYTES, HOT_BATCH_BYTES)
    return _plain(_result(spark, sf_dir, "rides-customers-drivers", build, batch_bytes))


def _enriched(spark: SparkSession, sf_dir: str, events: DataFrame) -> DataFrame:
    """Rides with customer and driver names from the tables."""
    customers = table(spark, sf_dir, "customer").select(
        *[F.col(source).alias(target) for source, target in CUSTOMERS.items()]
    )
    drivers = table(spark, sf_dir, "supplier").select(
        *[F.col(source).alias(target) for source, target in DRIVERS.items()]
    )
    with_customer = joins.join_static(_rides(events), customers, "customer_id", row_id="ride_id")
    return joins.join_static(with_customer, drivers, "driver_id", row_id="ride_id")


ENRICHED_SQL = (
    RIDES_SQL
    + closed_sql("1 minute")
    + """, enriched AS (SELECT rides.*, c_name, s_name FROM rides
                        JOIN customer ON customer_id = c_custkey
                        JOIN supplier ON driver_id = s_suppkey)
    """
)


@query(
    "stream_fraud_customer",
    ENRICHED_SQL
    + """SELECT date_trunc('day', event_time)::TIMESTAMP AS window_start,
                date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 day AS window_end,
                customer_id, CAST(sum(fare) AS DOUBLE) AS total_fare, count(ride_id) AS ride_count
         FROM enriched, closed
         WHERE date_trunc('day', event_time)::TIMESTAMP + INTERVAL 1 day <= watermark
         GROUP BY date_trunc('day', event_time), customer_id HAVING count(ride_id) > 5""",
)
def _fraud_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return fraud.busy_customers(_enriched(spark, sf_dir, events), length="1 day")

    return _plain(_result(spark, sf_dir, "busy-customers", build))


HOURLY_SQL = ENRICHED_SQL + """, hourly AS (
        SELECT date_trunc('hour', event_time)::TIMESTAMP AS window_start,
               date_trunc('hour', event_time)::TIMESTAMP + INTERVAL 1 hour AS window_end, enriched.*
        FROM enriched, closed
        WHERE date_trunc('hour', event_time)::TIMESTAMP + INTERVAL 1 hour <= watermark)
"""


@query(
    "stream_fraud_driver",
    HOURLY_SQL
    + """, ranked AS (
           SELECT window_start, window_end, driver_id, customer_id,
                  count(*) OVER w AS ride_count,
                  (row_number() OVER (PARTITION BY window_start, driver_id
                                      ORDER BY customer_id) - 1) // 3 AS part
           FROM hourly WINDOW w AS (PARTITION BY window_start, driver_id))
         SELECT window_start, window_end, driver_id, ride_count, CAST(part AS INTEGER) AS part,
                string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY customer_id) AS customer_ids
         FROM ranked WHERE ride_count > 1
         GROUP BY window_start, window_end, driver_id, ride_count, part""",
)
def _fraud_driver(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return fraud.driver_customers(_enriched(spark, sf_dir, events), length="1 hour")

    counts = _result(spark, sf_dir, "driver-customers", build)
    report = fraud.driver_report(counts, part_rows=3)
    text = F.transform("customer_ids", lambda key: key.cast("string"))
    return _plain(report.withColumn("customer_ids", F.array_join(text, ",")))


@query(
    "stream_fraud_driver_alerts",
    HOURLY_SQL
    + """SELECT window_start, window_end, driver_id, CAST(sum(fare) AS DOUBLE) AS total_fare,
                count(*) AS ride_count
         FROM hourly GROUP BY window_start, window_end, driver_id HAVING count(*) > 1""",
)
def _fraud_driver_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    def build(events: DataFrame) -> DataFrame:
        return fraud.busy_drivers(_enriched(spark, sf_dir, events), length="1 hour")

    return _plain(_result(spark, sf_dir, "busy-drivers", build))


@query(
    "stream_late_data",
    """WITH waves AS (SELECT event_type, ts, event_type = 'click' AS late,
                             date_trunc('day', ts)::TIMESTAMP AS window_start,
                             date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 day AS window_end
                      FROM events),
       first AS (SELECT max(ts) - INTERVAL 2 day AS watermark FROM waves WHERE NOT late),
       final AS (SELECT max(ts) - INTERVAL 2 day AS watermark FROM waves)
       SELECT window_start, window_end, event_type, count(*) AS n
       FROM waves, first, final
       WHERE (NOT late OR window_end > first.watermark) AND window_end <= final.watermark
       GROUP BY window_start, window_end, event_type""",
)
def _late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks arrive after everything else: those behind the watermark by then are dropped."""
    with _late_feed(spark, sf_dir) as late:
        return _plain(late.table())


def _late_feed(spark: SparkSession, sf_dir: str) -> feed.Feed:
    """A count per day and type to which all events but clicks came first, and clicks after them."""
    events = table(spark, sf_dir, "events").select("event_type", "ts")

    def build(arrived: DataFrame) -> DataFrame:
        timed = arrived.select("event_type", F.col("ts").cast("timestamp").alias("event_time"))
        return windows.window_agg(
            timed, F.window("event_time", "1 day"), ["event_type"], {"n": F.count("*")}, "2 days"
        )

    late = feed.Feed(spark, events.schema, build, "late-counts")
    is_late = F.col("event_type") == "click"
    for rows in (events.where(~is_late), events.where(is_late)):
        late.put(rows)
    return late


@query(
    "stream_late_totals",
    """WITH waves AS (SELECT ts, event_type = 'click' AS late,
                             date_trunc('day', ts)::TIMESTAMP + INTERVAL 1 day AS window_end
                      FROM events),
       first AS (SELECT max(ts) - INTERVAL 2 day AS watermark FROM waves WHERE NOT late),
       final AS (SELECT max(ts) - INTERVAL 2 day AS watermark FROM waves),
       told AS (SELECT CASE WHEN late AND window_end <= first.watermark THEN 'dropped'
                            WHEN window_end <= final.watermark THEN 'kept' ELSE 'open' END AS what
                FROM waves, first, final)
       SELECT count(*) AS arrived, count(*) FILTER (what = 'kept') AS kept,
              count(*) FILTER (what = 'open') AS open, count(*) FILTER (what = 'dropped') AS dropped
       FROM told""",
)
def _late_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every event of ``stream_late_data``."""
    with _late_feed(spark, sf_dir) as late:
        return late.totals(F.col("n"), F.col("value.count"))
