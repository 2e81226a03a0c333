"""Topic records: read, write, encode, decode, offsets.

`format="kafka"` needs the connector on the session's class path; `format="json"`
is the same table as files below `topic=<name>/` folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..schema import TOPIC


def read_topic(
    spark: SparkSession,
    format: str,
    location: str,
    topics: Sequence[str],
    stream: bool = False,
    max_per_trigger: int | None = None,
    starting: str = "earliest",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Topic rows as a batch table or a stream.

    `location` is the broker list or the folder.  `max_per_trigger` bounds one
    micro-batch (offsets for Kafka, files for JSON).  Kafka's seek forms go in
    `options`: `startingOffsetsByTimestamp`, `startingOffsets`, `endingOffsets`.
    """
    reader = spark.readStream if stream else spark.read
    if format == "kafka":
        reader = reader.format("kafka").option("kafka.bootstrap.servers", location).option("subscribe", ",".join(topics))
        seeks = {k.lower() for k in (options or {})}
        if not seeks & {"startingoffsets", "startingoffsetsbytimestamp", "startingtimestamp"}:
            reader = reader.option("startingOffsets", starting)
        if stream and max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
        rows = reader.options(**(options or {})).load()
        return rows.select(
            "topic", "partition", "offset", "timestamp",
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
        )
    if format != "json":
        raise ValueError("format must be 'kafka' or 'json'")
    reader = reader.format("json").schema(TOPIC)
    if stream and max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_per_trigger)
    return reader.options(**(options or {})).load(location).where(F.col("topic").isin(list(topics)))


def encode(df: DataFrame, topic: str, key: str, fields: Sequence[str]) -> DataFrame:
    """Rows as topic messages: key column as text, the named fields as a JSON value."""
    return df.select(
        F.lit(topic).alias("topic"),
        F.col(key).cast("string").alias("key"),
        F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).alias("value"),
    )


def write_topic(df: DataFrame, format: str, location: str, options: dict[str, str] | None = None) -> None:
    """Append message rows (topic, key, value, …) to Kafka or to the file form."""
    if format == "kafka":
        writer = df.select("topic", "key", "value").write.format("kafka").option("kafka.bootstrap.servers", location)
        writer.options(**(options or {})).save()
    elif format == "json":
        df.write.mode("append").partitionBy("topic").options(**(options or {})).json(location)
    else:
        raise ValueError("format must be 'kafka' or 'json'")


def replace_messages(df: DataFrame, location: str, topic: str, batch: int) -> None:
    """Message rows of `topic` in the file form, in a folder of the micro-batch's own; a replay replaces it."""
    writer = df.drop("topic").write.mode("overwrite").option("partitionOverwriteMode", "static")
    writer.json(f"{location}/topic={topic}/batch={batch}")


def write_topic_stream(
    df: DataFrame, format: str, location: str, checkpoint: str, options: dict[str, str] | None = None, drain: bool = True
) -> StreamingQuery:
    """The same sink for a stream of message rows; `drain` stops it when the backlog is worked off."""
    if format == "kafka":
        writer = df.select("topic", "key", "value").writeStream.format("kafka")
        writer = writer.option("kafka.bootstrap.servers", location)
    elif format == "json":
        writer = df.writeStream.format("json").partitionBy("topic").option("path", location)
    else:
        raise ValueError("format must be 'kafka' or 'json'")
    writer = writer.outputMode("append").option("checkpointLocation", checkpoint).options(**(options or {}))
    return (writer.trigger(availableNow=True) if drain else writer).start()


def decoded(df: DataFrame, schema: T.StructType, required: Sequence[str] = (), value: str = "value") -> DataFrame:
    """Add `data` (the parsed value) and `error` (NULL when it parsed).

    An empty payload, broken JSON and a missing required field are error values.
    """
    bad = "_corrupt"
    wide = T.StructType([*schema.fields, T.StructField(bad, T.StringType())])
    text = F.col(value).cast("string")
    data = F.from_json(text, wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": bad})
    error = (
        F.when(F.col(value).isNull(), F.lit("empty payload"))
        .when(F.col("_data").isNull() | F.col(f"_data.{bad}").isNotNull(), F.lit("invalid json"))
    )
    for name in required:
        error = error.when(F.col(f"_data.{name}").isNull(), F.lit(f"missing {name}"))
    return (
        # Filters are not pushed below a generator, so the parser stands in the plan once.
        df.select("*", F.explode_outer(F.array(data)).alias("_data"))
        .withColumn("error", error)
        .withColumn("data", F.struct(*[F.col(f"_data.{f.name}").alias(f.name) for f in schema.fields]))
        .drop("_data")
    )


def decode(
    df: DataFrame, schema: T.StructType, required: Sequence[str] = (), value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """(good rows with `data`, dead letters with `error`); a payload is parsed once, whatever reads it."""
    rows = decoded(df, schema, required, value)
    return rows.where(F.col("error").isNull()).drop("error"), rows.where(F.col("error").isNotNull()).drop("data")


def next_offsets(df: DataFrame) -> DataFrame:
    """The offset to resume from per topic partition: last seen plus one."""
    return df.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))
