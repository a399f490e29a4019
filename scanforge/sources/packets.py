"""Packet sources: a message topic, a folder of packet files, and the envelope they come in."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanforge.config import ENVELOPE_FIELDS
from scanforge.functions.envelope import decode_envelopes
from scanforge.operators.select import with_experiment
from scanforge.schema import PACKET_SCHEMA

TEXT_FIELDS = ("filename", "subdir_str", "filename_append")


def topic_options(servers: str, topic: str, security: dict[str, str] | None = None) -> dict[str, str]:
    """Reader options: from the earliest message on, client settings passed through.

    Spark keeps offsets in its own checkpoint, so no consumer group commits anything.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
    }
    for key, value in (security or {}).items():
        options[key if key.startswith("kafka.") else f"kafka.{key}"] = value
    return options


def read_topic(
    spark: SparkSession,
    servers: str,
    topic: str,
    security: dict[str, str] | None = None,
    streaming: bool = True,
) -> DataFrame:
    """Messages of a topic with their arrival order. Needs Spark's Kafka connector on the class path."""
    reader = spark.readStream if streaming else spark.read
    messages = reader.format("kafka").options(**topic_options(servers, topic, security)).load()
    return messages.select("value", message_order().alias("arrival_order"), F.col("timestamp"))


def message_order():
    """Arrival order of a message: its time in milliseconds, then partition, then offset, exactly.

    One number of 122 bits: 42 for the time, 20 for the partition, 60 for the offset. Values beyond that fail the job.
    """
    fits = F.col("partition").between(0, (1 << 20) - 1) & F.col("offset").between(0, (1 << 60) - 1)
    wide = lambda c, bits: c.cast("decimal(13,0)") * F.lit(Decimal(1 << bits))
    order = wide(F.unix_millis("timestamp"), 80) + wide(F.col("partition"), 60) + F.col("offset")
    return F.when(fits, order.cast("decimal(38,0)")).otherwise(F.raise_error(F.lit("partition or offset out of range")).cast("decimal(38,0)"))


def read_packet_files(spark: SparkSession, path: str, schema: str = PACKET_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def stream_packet_files(
    spark: SparkSession, path: str, schema: str = PACKET_SCHEMA, files_per_trigger: int | None = None
) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def decode_packets(messages: DataFrame, experiment: str, on_error: str = "fail") -> DataFrame:
    """Messages (``value`` BINARY) to packet columns; other columns are passed on.

    A message that is no envelope fails the job, or with ``on_error="flag"`` gives a row whose
    ``decode_error`` says why.
    """
    if on_error not in ("fail", "flag"):
        raise ValueError("on_error must be fail or flag")
    types = {"chunk_hash": "binary", "data": "binary", **dict.fromkeys(TEXT_FIELDS, "string")}
    passed = [f for f in messages.schema.fields if f.name != "value"]
    schema = ", ".join(
        [f"`{f.name}` {f.dataType.simpleString()}" for f in passed]
        + [f"{name} {types.get(name, 'bigint')}" for name in ENVELOPE_FIELDS]
        + ["decode_error string"]
    )
    columns = [f.name for f in passed]
    ordered = messages.select(*columns, "value")
    decoded = ordered.mapInArrow(
        decode_envelopes(dict(ENVELOPE_FIELDS), TEXT_FIELDS, on_error == "flag"), schema
    )
    packets = with_experiment(decoded, experiment)
    return packets if on_error == "flag" else packets.drop("decode_error")
