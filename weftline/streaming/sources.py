"""Stream sources and JSON decoding."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weftline.sources.files import TEXT_TIMES

# Message schemas of the ride topics.
CUSTOMER_SCHEMA = (
    "customer_id STRING, name STRING, email STRING, phone_number STRING, address STRING"
)
DRIVER_SCHEMA = "driver_id STRING, name STRING, license_number STRING, rating DOUBLE"
RIDE_SCHEMA = (
    "ride_id STRING, driver_id STRING, customer_id STRING,"
    " start_location STRUCT<lat: DOUBLE, lon: DOUBLE>,"
    " end_location STRUCT<lat: DOUBLE, lon: DOUBLE>,"
    " start_time BIGINT, end_time BIGINT, fare DOUBLE"
)


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options: str) -> DataFrame:
    """A Kafka topic from its earliest offset; needs the Kafka package on the cluster."""
    settings = {"startingOffsets": "earliest"} | options
    return (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .options(**settings)
        .load()
    )


def ride_topics(
    spark: SparkSession, servers: str, topics: Mapping[str, str]
) -> dict[str, DataFrame]:
    """The decoded customers, drivers and rides streams; ``topics`` names the topic of each."""
    schemas = {"customers": CUSTOMER_SCHEMA, "drivers": DRIVER_SCHEMA, "rides": RIDE_SCHEMA}
    return {
        name: decode_json(kafka_stream(spark, servers, topics[name]), schema)
        for name, schema in schemas.items()
    }


def file_stream(spark: SparkSession, path: str, schema: T.StructType, **options) -> DataFrame:
    """Parquet files as a stream; files that arrive later form later batches."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def encode_json(df: DataFrame, event_time: str, key: str) -> DataFrame:
    """Rows in the shape a Kafka topic delivers: key, value (JSON bytes), topic, timestamp."""
    payload = F.struct(*[F.col(c) for c in df.columns if c != event_time])
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(payload, TEXT_TIMES).cast("binary").alias("value"),
        F.lit("events").alias("topic"),
        F.col(event_time).cast("timestamp").alias("timestamp"),
    )


def decode_json(stream: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The JSON fields of ``value`` as columns, plus ``event_time`` from the message timestamp.

    A value that is no JSON object, or a field it lacks, gives NULL.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema, TEXT_TIMES)
    return stream.select(parsed.alias("data"), F.col("timestamp").alias("event_time")).select(
        "data.*", "event_time"
    )
