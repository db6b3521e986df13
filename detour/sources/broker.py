"""Broker records in and out.

The job needs only ``value`` (bytes) and ``timestamp`` from the source, so any
stream with those two columns works; a Kafka source is one option.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from detour.fixed import BROKER_REQUEST_TIMEOUT_MS, BROKER_SESSION_TIMEOUT_MS
from detour.functions.columns import json_payload


def kafka_options(bootstrap: str, topic: str, sasl_jaas: str | None = None,
                  starting_offsets: str = "latest", for_sink: bool = False) -> dict:
    """Options of the original broker subscription (SASL_SSL / PLAIN, tolerate data
    loss, start at the latest offsets); ``for_sink=True`` gives the publishing side."""
    opts = {
        "kafka.bootstrap.servers": bootstrap,
        "kafka.request.timeout.ms": BROKER_REQUEST_TIMEOUT_MS,
    }
    if for_sink:
        opts["topic"] = topic
    else:
        opts.update({
            "subscribe": topic,
            "startingOffsets": starting_offsets,
            "failOnDataLoss": "false",
            "kafka.session.timeout.ms": BROKER_SESSION_TIMEOUT_MS,
        })
    if sasl_jaas:
        opts.update({
            "kafka.security.protocol": "SASL_SSL",
            "kafka.sasl.mechanism": "PLAIN",
            "kafka.sasl.jaas.config": sasl_jaas,
        })
    return opts


def read_broker(spark: SparkSession, options: dict) -> DataFrame:
    """Streaming broker records (needs the Kafka connector on the classpath)."""
    return spark.readStream.format("kafka").options(**options).load().select("value", "timestamp")


def to_broker_records(events: DataFrame, fields: list[str], timestamp_col=None) -> DataFrame:
    """K1: one UTF-8 JSON message per event, no key."""
    ts = F.current_timestamp() if timestamp_col is None else F.col(timestamp_col)
    return events.select(
        json_payload(*fields).cast("binary").alias("value"),
        ts.cast("timestamp").alias("timestamp"),
    )


def write_broker(records: DataFrame, options: dict) -> None:
    """K1 batch form: publish records to the topic in ``options['topic']``."""
    records.write.format("kafka").options(**options).save()
