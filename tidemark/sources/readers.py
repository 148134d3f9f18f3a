"""Batch and stream readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timecols import utc_timestamps

# The raw event payload.
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("event_ts", T.TimestampType()),
    ]
)


def read_table(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    schema: T.StructType | None = None,
    partition_filter: str | None = None,
    utc: bool = True,
    **options: str,
) -> DataFrame:
    """Load parquet, csv, json, orc (or delta where its jar is present).

    ``partition_filter`` is SQL; on partition columns it prunes directories.  Zone-less timestamps
    become UTC timestamps.
    """
    reader = spark.read.format(format).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path)
    if partition_filter:
        df = df.where(partition_filter)
    return utc_timestamps(df) if utc else df


def load_training_data(spark: SparkSession, path: str) -> DataFrame:
    """Parquet or csv by suffix; ``scheme://`` folders without a csv suffix are parquet."""
    if path.endswith(".csv"):
        return read_table(spark, path, "csv", header="true", inferSchema="true")
    if path.endswith(".parquet") or "://" in path:
        return read_table(spark, path)
    raise ValueError(f"cannot tell the format of {path!r}; use read_table")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition_column: str | None = None,
    lower_bound: int | str | None = None,
    upper_bound: int | str | None = None,
    num_partitions: int = 8,
    fetch_size: int = 10_000,
    **options: str,
) -> DataFrame:
    """A table, or a parenthesised subquery, read over parallel connections when partitioned."""
    if partition_column and (lower_bound is None or upper_bound is None):
        raise ValueError("partition_column needs lower_bound and upper_bound")
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize=str(fetch_size), **options)
    if partition_column:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return reader.load()


#: Formats of a folder of files.
FILES = ("parquet", "json", "csv", "orc", "text", "avro")


def rate_options(format: str, records_per_second: int, trigger_seconds: int, record_bytes: int = 1_024) -> dict[str, str]:
    """A rate as the connector's own limit: Kinesis reads so many records a second and shard, Kafka so many a
    trigger.  Files are limited by bytes, of which a record takes about ``record_bytes``; a batch has one file at least."""
    if format in FILES:
        return {"maxBytesPerTrigger": str(records_per_second * trigger_seconds * record_bytes)}
    if format == "kinesis":
        return {"kinesis.executor.maxFetchRecordsPerShard": str(records_per_second)}
    if format == "kafka":
        return {"maxOffsetsPerTrigger": str(records_per_second * trigger_seconds)}
    return {}


def read_event_stream(
    spark: SparkSession,
    format: str,
    position: str = "LATEST",
    timestamp: str | None = None,
    records_per_second: int = 10_000,
    trigger_seconds: int = 30,
    schema: T.StructType | None = None,
    path: str | None = None,
    record_bytes: int = 1_024,
    **options: str,
) -> DataFrame:
    """A stream of raw events from a connector (kinesis, kafka) or a folder of files, no faster than the rate for a
    stream that is triggered every ``trigger_seconds``.

    A folder is read from its first file on, as it has no end to start behind; ``AT_TIMESTAMP`` leaves out files that were last
    changed before the time.  ``maxFilesPerTrigger`` or ``maxBytesPerTrigger`` of the caller take the rate's place.
    """
    if position not in ("LATEST", "TRIM_HORIZON", "AT_TIMESTAMP"):
        raise ValueError(f"unknown start position {position!r}")
    if position == "AT_TIMESTAMP" and not timestamp:
        raise ValueError("AT_TIMESTAMP needs a timestamp")
    reader = spark.readStream.format(format)
    if schema is not None:
        reader = reader.schema(schema)
    if format == "kinesis":
        reader = reader.option("startingPosition", position)
        if timestamp:
            reader = reader.option("startingTimestamp", timestamp)
    elif format == "kafka":
        if timestamp:
            reader = reader.option("startingTimestamp", timestamp)
        else:
            reader = reader.option("startingOffsets", "latest" if position == "LATEST" else "earliest")
    rate = rate_options(format, records_per_second, trigger_seconds, record_bytes)
    if "maxFilesPerTrigger" in options:
        rate.pop("maxBytesPerTrigger", None)
    reader = reader.options(**{**rate, **options})
    df = reader.load(path) if path else reader.load()
    if format in FILES and position == "AT_TIMESTAMP":
        df = df.where(F.col("_metadata.file_modification_time") >= F.lit(timestamp).cast("timestamp"))
    return df


def decode_events(
    raw: DataFrame,
    data: str = "data",
    arrival: str | None = "arrival_ts",
    base64: bool = True,
    schema: T.StructType = EVENT_SCHEMA,
    required: str = "user_id",
) -> DataFrame:
    """Payload bytes to an ``event`` struct, with ``is_valid``.

    A row is valid when it decodes to a JSON object that has the required field.  Malformed base64
    or JSON never fails the job.
    """
    payload = F.expr(f"try_to_binary(cast({data} AS string), 'base64')") if base64 else F.col(data)
    text = F.try_validate_utf8(payload.cast("string"))
    # As a generated column the event is parsed once: later filters on its fields would otherwise be
    # pushed below the projection, each with its own parse.
    event = F.explode(F.array(F.from_json(text, schema)))
    cols = [event.alias("event"), *([F.col(arrival)] if arrival else [])]
    return raw.select(*cols).withColumn("is_valid", F.coalesce(F.col(f"event.{required}").isNotNull(), F.lit(False)))


def valid_events(decoded: DataFrame) -> DataFrame:
    """Flattened valid events."""
    rest = [c for c in decoded.columns if c not in ("event", "is_valid")]
    return decoded.where("is_valid").select("event.*", *rest)


def quarantined_events(decoded: DataFrame) -> DataFrame:
    return decoded.where("NOT is_valid")
